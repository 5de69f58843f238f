"""Rule data of the document families whose score is additive: keywords, domains, penalties.

Fixed values: the word lists are those that the results depend on, in their natural order. They are compared after
:func:`evidentia.functions.text.normalize`, so marks and dashes don't matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from ..functions.text import MARKED, PLAIN
from .scoring import POINTS, Family

LOW_TRUST = ["scribd.com", "slideshare.net", "issuu.com"]
PRESS_RELEASE = ["press release", "communiqué de presse", "news release"]


def normal(words: Sequence[str]) -> list[str]:
    """The lists as the scorer's normalised text has them, once each."""
    table = str.maketrans(MARKED, PLAIN)
    out = (" ".join("".join(c if c.isascii() and c.isalnum() else " " for c in w.lower().translate(table)).split()) for w in words)
    return list(dict.fromkeys(w for w in out if w))


STRONG = {
    "annual": [
        "annual report", "annual financial report", "rapport annuel", "universal registration document", "document d'enregistrement universel", "document d enregistrement universel", "integrated report", "rapport intégré", "rapport integre",
    ],
    "agm": [
        "say on climate", "climate resolution", "shareholder resolution climate", "resolution on climate", "AGM resolutions", "annual general meeting resolutions", "proxy statement",
        "notice of annual general meeting", "notice of meeting", "assemblée générale résolutions", "résolutions assemblée générale", "avis de convocation assemblée", "convocation assemblée générale",
        "vote results AGM", "AGM voting results", "résultats vote assemblée générale", "procès-verbal assemblée générale", "AGM minutes", "shareholder vote results", "resolution results", "say on pay vote", "say on climate vote",
    ],
    "assurance": [
        "third party assurance report", "third-party assurance report", "independent verification statement", "independent assurance statement", "limited assurance report", "reasonable assurance report",
        "assurance report sustainability", "assurance report esg", "rapport assurance esg", "rapport vérification durabilité", "rapport assurance développement durable", "commissaire aux comptes informations durabilité",
        "isae 3000 assurance", "isae 3410 assurance", "aa1000 assurance", "independent assurance engagement", "sustainability assurance report", "esg verification report", "ghg verification statement", "ghg assurance report",
        "csrd assurance report", "csrd assurance tiers", "rapport du commissaire aux comptes sur les informations de durabilite",
    ],
    "cdp": [
        "cdp climate change response", "cdp questionnaire response", "cdp climate disclosure", "cdp water security response", "cdp forests response", "carbon disclosure project response", "cdp climate change questionnaire",
        "cdp response pdf", "réponse cdp changement climatique", "cdp water questionnaire", "cdp forests questionnaire", "cdp disclosure report", "cdp submission", "cdp climate questionnaire", "cdp reporting", "cdp score report",
    ],
    "sbti": [
        "science based targets", "science-based targets", "sbti", "sbti validated", "sbti approved", "sbti commitment", "sbti net zero", "sbti target", "sbti letter", "science based targets initiative", "sbti 1.5 degrees",
        "net zero standard sbti", "sbti near term target", "sbti long term target", "1.5 degree aligned target", "objectifs bases sur la science", "objectifs scientifiquement bases", "sbti commitment letter", "sbti validation letter",
    ],
    "earnings": [
        "earnings call transcript", "earnings transcript", "call transcript", "conference call transcript", "results call transcript", "quarterly earnings transcript", "annual earnings transcript", "q1 earnings transcript",
        "q2 earnings transcript", "q3 earnings transcript", "q4 earnings transcript", "full year results transcript", "transcription résultats", "transcript conférence analystes", "verbatim earnings call", "earnings call verbatim", "investor call transcript",
    ],
    "investor": [
        "capital markets day", "investor day", "esg day", "sustainability day", "investor presentation", "investor relations presentation", "roadshow presentation", "results presentation", "annual results presentation",
        "full year results presentation", "half year results presentation", "strategy presentation", "strategic update presentation", "journée investisseurs", "présentation investisseurs", "présentation résultats", "présentation stratégique",
        "cmd presentation", "cmd slides", "investor briefing", "earnings presentation", "financial results presentation",
    ],
    "half_year": [
        "half year report", "half-year report", "half year financial report", "semi-annual report", "semi annual report", "interim report", "half year results", "half-year results", "first half results", "six months results",
        "six-month results", "six months financial report", "rapport semestriel", "rapport financier semestriel", "résultats semestriels", "résultats du premier semestre", "résultats du deuxième semestre", "résultats premier semestre",
        "résultats s1", "comptes semestriels", "half year accounts", "interim financial statements", "rapport financier intermédiaire",
    ],
    "climate": [
        "climate report", "tcfd report", "climate transition plan", "transition plan", "net zero transition plan", "net zero report", "carbon report", "climate strategy", "cdp climate response", "ghg emissions report", "greenhouse gas report",
        "greenhouse gas emissions report", "climate action plan", "carbon neutrality report", "net zero strategy", "low carbon strategy", "carbon footprint report", "climate disclosure", "climate resilience report", "physical climate risk report",
        "rapport climat", "plan de transition", "plan de transition climatique", "rapport tcfd", "stratégie climat", "bilan carbone", "rapport émissions carbone", "stratégie carbone", "plan de neutralité carbone", "rapport de transition", "trajectoire carbone", "rapport risques climatiques",
    ],
    "sustainability": [
        "sustainability report", "esg report", "environmental social governance report", "corporate responsibility report", "corporate social responsibility report", "csr report", "social and environmental responsibility report", "environmental responsibility report",
        "responsibility report", "sustainable development report", "positive impact report", "rapport rse", "rapport esg", "rapport de durabilité", "rapport développement durable", "rapport de responsabilité sociale", "rapport responsabilité sociale et environnementale",
    ],
    "governance": [
        "corporate governance report", "governance report", "corporate governance statement", "governance statement", "corporate governance charter", "governance charter", "corporate governance framework", "governance framework", "corporate governance code", "board governance report",
        "corporate governance disclosure", "governance and remuneration report", "corporate governance practices", "corporate governance guidelines", "corporate governance policy", "rapport de gouvernance", "rapport gouvernance", "rapport de gouvernance d entreprise",
        "rapport sur la gouvernance", "déclaration de gouvernance", "charte de gouvernance", "code de gouvernance", "gouvernance d entreprise", "rapport du gouvernement d entreprise", "document de gouvernance",
    ],
    "remuneration": [
        "remuneration report", "directors remuneration report", "directors' remuneration report", "executive remuneration report", "compensation report", "executive compensation report", "pay report", "remuneration policy report", "directors pay report", "say on pay report",
        "remuneration committee report", "annual remuneration report", "executive pay report", "board remuneration report", "compensation and benefits report", "total compensation report", "rapport de rémunération", "rapport sur les rémunérations", "rapport rémunération dirigeants",
        "politique de rémunération", "rapport sur la politique de rémunération", "rémunération des mandataires sociaux", "rapport du comité des rémunérations", "éléments de rémunération",
    ],
    "vigilance": [
        "plan de vigilance", "devoir de vigilance", "rapport de vigilance", "plan vigilance", "loi de vigilance", "rapport sur le plan de vigilance", "vigilance raisonnée", "diligence raisonnée droits humains", "diligence raisonnable droits humains", "rapport diligence raisonnée",
        "rapport droits humains chaîne d approvisionnement", "modern slavery statement", "modern slavery act", "modern slavery report", "anti-slavery statement", "forced labour report", "forced labor report", "forced labour statement", "human trafficking statement",
        "human rights due diligence report", "human rights due diligence statement", "duty of vigilance report", "duty of vigilance plan", "vigilance plan", "supply chain transparency report", "supply chain human rights report", "supply chain due diligence", "human rights report", "responsible sourcing report",
    ],
    "policy": [
        "code of conduct", "code of ethics", "business conduct policy", "code éthique", "charte éthique", "charte de déontologie", "business ethics code", "code of business ethics", "code de conduite", "code de déontologie", "ethics and compliance code", "standards of business conduct",
        "règles de conduite", "global code of conduct", "anti-corruption policy", "anticorruption policy", "anti-bribery policy", "anti-bribery and corruption policy", "politique anticorruption", "politique anti-corruption", "corruption prevention policy", "bribery prevention policy",
        "fcpa compliance", "uk bribery act compliance", "anti-corruption compliance program", "lutte contre la corruption", "sapin ii compliance", "anti-facilitation of tax evasion", "human rights policy", "human rights commitment", "human rights statement", "politique droits humains",
        "droits de l'homme politique", "human rights framework", "human rights principles", "un guiding principles", "respect for human rights", "human rights due diligence policy", "charte droits humains", "engagements droits humains", "modern slavery and human trafficking policy",
        "diversity equity inclusion policy", "dei policy", "diversity and inclusion policy", "diversity policy", "politique diversité équité inclusion", "politique diversité inclusion", "equal opportunity policy", "politique égalité professionnelle", "inclusion policy", "diversity commitment",
        "gender equality policy", "politique parité", "charte diversité", "disability inclusion policy", "environmental policy", "politique environnementale", "environmental commitment", "climate policy", "politique climat", "environmental management policy", "environmental principles",
        "sustainability policy", "politique développement durable", "biodiversity policy", "net zero policy", "climate change policy", "politique eau", "water policy", "supplier code of conduct", "supplier code", "vendor code of conduct", "code fournisseurs", "responsible sourcing policy",
        "politique achats responsables", "supply chain code of conduct", "supplier ethics code", "supplier sustainability requirements", "supplier standards", "charte fournisseurs", "code achats", "supplier expectations", "responsible procurement policy",
    ],
}

SECONDARY = {
    "annual": [],
    "agm": ["AGM", "annual general meeting", "assemblée générale", "shareholder meeting", "extraordinary general meeting", "EGM", "proxy", "voting", "résolutions", "resolutions", "vote par correspondance", "electronic voting"],
    "assurance": [
        "assurance", "verification", "vérification", "audit ESG", "limited assurance", "reasonable assurance", "deloitte assurance", "pwc assurance", "kpmg assurance", "ey assurance", "bureau veritas", "rina", "dnv",
        "kpmg sustainability", "pwc sustainability", "deloitte sustainability", "independent reviewer", "tiers vérificateur", "assurance provider", "assurance scope",
    ],
    "cdp": ["cdp", "carbon disclosure project", "cdp score", "climate change questionnaire", "water security questionnaire", "forests questionnaire", "cdp rating", "cdp ranking", "a list cdp", "cdp gold", "scope 1", "scope 2", "scope 3"],
    "sbti": [
        "net zero commitment", "1.5 degrees", "paris agreement aligned", "science-aligned", "ghg reduction target", "carbon neutral target", "scope 1 2 3 target", "carbon neutrality commitment", "engagement net zero",
        "objectif neutralite carbone", "sciencebasedtargets.org", "sbti company",
    ],
    "earnings": ["earnings call", "conference call", "analyst call", "results call", "q&a transcript", "management commentary", "conférence analystes", "appel investisseurs", "seeking alpha transcript", "motley fool transcript"],
    "investor": ["slides", "slide deck", "webcast", "investor relations", "financial calendar", "ir presentation", "equity story", "pitch deck", "strategy day", "investor update"],
    "half_year": ["premier semestre", "deuxième semestre", "first semester", "second semester", "first half", "second half", "six months", "6 months"],
    "climate": [
        "task force on climate-related financial disclosures", "tcfd index", "tcfd disclosure", "tcfd alignment", "cdp disclosure", "carbon disclosure project", "decarbonization report", "decarbonisation report", "net zero pathway", "science based targets", "sbti",
        "indice tcfd", "divulgation tcfd", "rapport cdp", "décarbonation", "objectifs basés sur la science",
    ],
    "sustainability": ["sustainability statement", "csrd statement", "esrs statement", "csrd report", "esrs report", "non-financial statement", "nonfinancial statement", "déclaration de performance extra-financière", "dpef", "déclaration de durabilité"],
    "governance": [
        "afep medef", "uk corporate governance code", "say on pay", "board diversity", "board independence", "independent directors", "audit committee report", "nominations committee", "remuneration committee report", "corporate governance section", "comply or explain", "code afep medef",
        "administrateurs independants", "comité d audit", "comité des nominations", "composition du conseil", "indépendance des administrateurs", "rapport du conseil sur la gouvernance",
    ],
    "remuneration": [
        "long-term incentive plan", "long term incentive", "short-term incentive", "ltip", "stip", "equity compensation", "share-based payment", "deferred compensation", "golden parachute", "clawback policy", "pay ratio", "ceo pay ratio", "median employee pay",
        "plan d incitation à long terme", "rémunération variable", "rémunération fixe", "intéressement long terme", "stock options", "actions de performance", "ratio de rémunération", "vote say on pay",
    ],
    "vigilance": [
        "un guiding principles", "ungp", "oecd guidelines", "ocde guidelines", "national action plan on business and human rights", "plan d action national entreprises droits humains", "csddd", "corporate sustainability due diligence", "child labour", "travail des enfants", "travail forcé",
        "forced labour", "conflict minerals", "minerais de conflit", "responsible minerals", "responsible minerals initiative", "supplier code of conduct", "code conduite fournisseurs", "audit fournisseurs", "supplier audit", "grievance mechanism", "mécanisme d alerte",
    ],
    "policy": [
        "compliance", "integrity", "whistleblowing", "intégrité", "speak up", "alert mechanism", "alerte éthique", "deontology", "gifts and hospitality", "conflict of interest", "facilitation payment", "third party due diligence", "cadeaux et invitations", "conflits d'intérêts",
        "forced labor", "child labor", "travail forcé", "travail des enfants", "freedom of association", "right to organize", "supply chain", "gender", "race", "ethnicity", "disability", "lgbtq", "inclusion", "belonging", "representation", "pay equity",
        "carbon", "ghg", "emissions", "waste", "water", "biodiversity", "circular economy", "climate change", "energie", "ressources", "audit", "assessment", "screening", "corrective action", "supplier audit", "évaluation fournisseurs", "diligence",
    ],
}

WEAK = {
    "annual": ["urd", "deu"],
    "agm": ["assemblée", "general meeting", "shareholders", "actionnaires", "vote", "résolution", "resolution"],
    "assurance": ["verified", "certified", "audited", "vérifié", "certifié", "audité", "independent review", "external review"],
    "cdp": ["carbon disclosure", "climate disclosure", "water disclosure", "forests disclosure", "ghg disclosure"],
    "sbti": ["net zero", "carbon neutral", "climate target", "emission reduction target", "neutralite carbone", "objectif climatique"],
    "earnings": ["earnings", "transcript", "call recording", "webcast transcript", "résultats", "conférence", "analystes"],
    "investor": ["presentation", "présentation", "investor", "investisseur", "results", "résultats", "strategy", "stratégie"],
    "half_year": ["semestriel", "semestrial", "interim", "midyear", "mid-year", "half year", "half-year", "semi annual", "semi-annual"],
    "climate": ["climate", "carbon", "tcfd", "ghg", "net zero", "low carbon", "emissions", "greenhouse", "transition", "decarbonization", "decarbonisation", "climat", "carbone", "émissions", "neutralité carbone", "zéro net", "énergie renouvelable", "renewable energy", "fossil fuels"],
    "sustainability": ["sustainability", "sustainable", "esg", "csr", "rse", "csrd", "esrs", "climate", "environment", "environmental", "social responsibility", "responsible business", "durability", "durabilité", "développement durable"],
    "governance": ["governance", "gouvernance", "board of directors", "conseil d administration", "board composition", "directors", "administrateurs", "independent board", "non-executive", "chairman", "president du conseil", "comite d audit"],
    "remuneration": ["remuneration", "compensation", "executive pay", "pay policy", "salary", "bonus", "incentive", "mandataires sociaux", "dirigeants", "directors pay", "board pay"],
    "vigilance": ["vigilance", "human rights", "droits humains", "supply chain", "chaîne d approvisionnement", "due diligence", "diligence raisonnée", "diligence raisonnable", "modern slavery", "esclavage moderne", "responsible sourcing", "approvisionnement responsable"],
    "policy": ["policy", "politique", "commitment", "engagements", "charter", "charte", "principles", "principes", "guidelines", "framework", "standards", "normes"],
}

PLATFORMS = {
    "cdp": ["cdp.net", "cdp.org"],
    "sbti": ["sciencebasedtargets.org"],
    "earnings": ["seekingalpha.com", "motleyfool.com", "fool.com", "wsj.com", "businesswire.com"],
}

#: (keywords, points, cap) of classes that count against a document.
PENALTIES = {
    "annual": {
        "availability_notice": (
            [
                "availability of the", "availability of", "announces the availability", "announces the publication", "now available", "is now available", "available online", "available on", "available at", "has filed", "filed with",
                "registration document now", "urd now available", "document now available", "release of the english version", "release of the french version", "publication of the english version", "publication of the french version",
                "avis de mise à disposition", "avis de mise a disposition", "mise à disposition", "mise a disposition", "disponibilité", "disponibilite",
            ],
            -50,
            55,
        ),
        "amendment": (
            ["amendment", "amended", "1st amendment", "2nd amendment", "3rd amendment", "first amendment", "second amendment", "third amendment", "supplement", "supplementary", "amendement", "actualisation", "mise à jour", "mise a jour"],
            -45,
            55,
        ),
        "interim": (
            [
                "quarterly", "q1", "q2", "q3", "q4", "half year", "half-year", "h1", "interim report", "first half", "first half of the year", "premier semestre", "résultats semestriels", "resultats semestriels", "semestriel", "semestrielle",
                "half-year results", "half year results",
            ],
            -45,
            50,
        ),
        "meeting": (
            [
                "brochure d'avis de convocation", "avis de convocation", "convocation ag", "assemblée générale", "assemblee generale", "general meeting", "annual general meeting", "agm", "proxy statement", "shareholder meeting", "notice of meeting",
            ],
            -60,
            40,
        ),
        "subsidiary": (
            [
                "issuer", "other legal", "other-legal", "warrant", "warrants", "structured products", "produits de bourse", "derivative", "derivatives", "subsidiary", "filiale", "vehicle", "special purpose vehicle", "spv", "legal entity", "entity report",
            ],
            -35,
            100,
        ),
    },
    "earnings": {"press_release": (PRESS_RELEASE, -25, 100)},
    "investor": {
        "annual_report": (["annual report", "rapport annuel", "urd", "deu", "universal registration document", "integrated report"], -30, 100),
        "press_release": ([*PRESS_RELEASE, "profit warning", "trading update"], -30, 100),
    },
    "half_year": {
        "annual_report": (["annual report", "rapport annuel", "universal registration document", "document d'enregistrement universel", "integrated report", "urd", "deu", "20-f", "10-k"], -35, 60),
        "press_release": ([*PRESS_RELEASE, "earnings release", "profit warning", "trading update"], -35, 60),
        "presentation": (["investor presentation", "investor day", "capital markets day", "roadshow", "slide deck", "webcast slides"], -30, 60),
        "periodic": (["q1", "q3", "quarterly report", "rapport trimestriel"], -20, 60),
        "financial_only": (["financial statements only", "statutory accounts", "standalone financial"], -20, 60),
    },
}

#: Penalties that the families of standalone reports share; a financial document counts only without any keyword.
SHARED = {
    "financial_only": (["financial statements", "consolidated financial statements", "documents financiers", "financial results", "résultats financiers", "earnings", "annual financial report"], -45, 50),
    "presentation": (["presentation", "powerpoint", "slides", "investor presentation", "results presentation", "team presentation", "webcast", "transcript"], -40, 50),
    "meeting": (["brochure d'avis de convocation", "avis de convocation", "convocation ag", "assemblée générale", "general meeting", "annual general meeting", "agm", "proxy statement", "shareholder meeting", "notice of meeting"], -60, 40),
    "periodic": (["quarterly", "q1", "q2", "q3", "q4", "half year", "h1", "first half", "interim", "semestriel", "premier semestre", "t1", "t2", "t3", "t4", "quatrième trimestre", "troisième trimestre"], -30, 55),
    "press_release": (["press release", "communiqué", "now available", "availability of", "announces the availability", "publication of", "mise à disposition"], -35, 55),
}
STANDALONE = ["climate", "sustainability", "governance", "remuneration", "vigilance"]
PENALTIES |= {name: {k: v for k, v in SHARED.items() if (name, k) != ("vigilance", "meeting")} for name in STANDALONE}

#: (keywords, points) that count for a document with any keyword of its family.
ANNUAL_CONTEXT = (["annual report", "universal registration document", "document d'enregistrement universel", "integrated report", "rapport annuel", "urd", "deu"], 8)

#: (domains, points) of the standalone families.
ARCHIVES = (["annualreports.com", "sustainabilityreports.com", "publicnow.com", "ddd.uab.cat", "bnains.org", "cdp.net"], 3)
WIRES = (["live.euronext.com", "globenewswire.com", "businesswire.com", "prnewswire.com", "actusnews.com", "eqs-news.com"], -30)

FAMILIES = {
    name: Family(
        name,
        strong=normal(STRONG[name]),
        secondary=normal(SECONDARY[name]),
        weak=normal(WEAK[name]),
        points=POINTS[name],
        penalties={k: (normal(words), points, cap) for k, (words, points, cap) in PENALTIES.get(name, {}).items()},
        platforms=PLATFORMS.get(name, ()),
        low_trust=LOW_TRUST,
        unknown_cap=59.0 if name == "annual" or name in STANDALONE else 100.0,
        without_keyword=("financial_only",) if name in STANDALONE else (),
        bonuses={"annual_context": (normal(ANNUAL_CONTEXT[0]), ANNUAL_CONTEXT[1])} if name in STANDALONE else {},
        domains={"archive": ARCHIVES, "press_domain": WIRES} if name in STANDALONE else {},
    )
    for name in STRONG
}
