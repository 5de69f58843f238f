"""Blocks of a page and the headings among them: predicates, classes, scores and the evidence built from them.

All predicates are column expressions over one text. White space counts as single spaces, and comparisons of words are
without marks and case, as in :func:`matching`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import collapse, contains_any, first_case, fold_accents

#: Types of a section and the patterns of its title, in the order in which they are tried.
SECTION_TYPES = {
    "anti_corruption": [r"\banti[- ]?corruption\b", r"\bcorruption\b", r"\bbribery\b"],
    "health_safety": [r"\bhealth and safety\b", r"\bsante securite\b", r"\bsafety\b", r"\bsecurite au travail\b", r"\boccupational health\b", r"\bsante des salaries\b"],
    "risk_management": [r"\brisk factors?\b", r"\brisk management\b", r"\bmanagement of risks?\b", r"\bfacteurs? de risque\b", r"\bgestion des risques\b"],
    "human_rights": [r"\bhuman rights\b", r"\bdroits humains\b", r"\bdroits de l homme\b", r"\bdroits fondamentaux\b", r"\btravail force\b", r"\bforced labour\b"],
    "remuneration": [r"\bremuneration\b", r"\bcompensation\b", r"\bremuneration report\b", r"\bpolitique salariale\b", r"\bpay equity\b", r"\begalite salariale\b"],
    "biodiversity": [r"\bbiodiversity\b", r"\bbiodiversite\b", r"\bnature[- ]positive\b", r"\becosystem\b", r"\becosysteme\b", r"\bbiodiversity footprint\b"],
    "governance": [r"\bgovernance\b", r"\bgouvernance\b", r"\bboard of directors\b", r"\bconseil d administration\b", r"\badministrateurs\b"],
    "vigilance": [r"\bvigilance plan\b", r"\bplan de vigilance\b", r"\bduty of vigilance\b", r"\bdevoir de vigilance\b"],
    "assurance": [r"\bassurance\b", r"\bverification\b", r"\blimited assurance\b", r"\baudit independant\b", r"\btierce partie\b"],
    "emissions": [r"\bemissions\b", r"\bghg\b", r"\bscope 1\b", r"\bscope 2\b", r"\bscope 3\b", r"\bcarbone\b", r"\bco2\b", r"\bgreenhouse gas\b"],
    "taxonomy": [r"\btaxonomy\b", r"\btaxonomie\b", r"\bcsrd\b", r"\bdpef\b", r"\bsustainable finance\b", r"\bfinance durable\b"],
    "climate": [r"\bclimate\b", r"\bclimat\b", r"\btcfd\b", r"\btransition plan\b", r"\bnet[- ]zero\b", r"\bzero emission\b", r"\bneutralite carbone\b", r"\bcarbon neutral\b", r"\bclimat changement\b", r"\bchangement climatique\b", r"\btransition energetique\b"],
    "energy": [r"\benergy\b", r"\benergie\b", r"\bconsommation energetique\b", r"\brenewable energy\b", r"\benergie renouvelable\b", r"\belectricite\b"],
    "water": [r"\bwater\b", r"\bwater withdrawal\b", r"\beau\b", r"\bgestion de l eau\b", r"\bwater management\b", r"\bconsommation d eau\b", r"\bhydrique\b"],
    "waste": [r"\bwaste\b", r"\bdechets\b", r"\beconomie circulaire\b", r"\bcircular economy\b", r"\brecyclage\b", r"\brecycling\b", r"\bvalorisation\b"],
    "diversity": [r"\bdiversity\b", r"\binclusion\b", r"\bdiversite\b", r"\bdei\b", r"\bequite\b", r"\bparite\b", r"\bgender equality\b", r"\begalite femmes hommes\b"],
    "workforce": [r"\bworkforce\b", r"\bemployees\b", r"\beffectifs\b", r"\bsalaries\b", r"\bcollaborateurs\b", r"\bformation\b", r"\btalent\b", r"\bengagement employes\b"],
    "ethics": [r"\bethics\b", r"\bethical\b", r"\bethique\b", r"\bcode of conduct\b", r"\bcode de conduite\b", r"\bcompliance\b", r"\bconformite\b"],
    "supply_chain": [r"\bsupply chain\b", r"\bchaine d approvisionnement\b", r"\bachats responsables\b", r"\bresponsible sourcing\b", r"\bfournisseurs\b", r"\bsuppliers\b"],
    "community": [r"\bcommunity\b", r"\bcommunautes\b", r"\bterritoires\b", r"\bimpact local\b", r"\bengagement communautaire\b", r"\bfondation\b"],
    "reporting": [r"\breporting\b", r"\bindice gri\b", r"\bgri index\b", r"\bsasb\b", r"\bun sdg\b", r"\bods\b", r"\bindicateurs esg\b", r"\besg indicators\b"],
    "environment": [r"\benvironment\b", r"\benvironnement\b", r"\bpilier environnemental\b", r"\benvironmental performance\b"],
    "social": [r"\bsocial\b", r"\bpilier social\b", r"\bresponsabilite sociale\b", r"\bsocial performance\b"],
    "general": [r"\boverview\b", r"\bintroduction\b", r"\bprofile\b", r"\bgeneral\b", r"\bfinancial highlights\b", r"\bhighlights\b", r"\bperformance\b", r"\bchiffres cles\b", r"\bkey figures\b"],
}

#: Labels that a running footer may carry, titles of contents pages, and titles of the document itself.
FOOTER_LABELS = ["universal registration document", "annual report", "document d'enregistrement universel", "rapport annuel"]
CONTENTS_TITLES = ["contents", "table of contents", "sommaire", "table des matieres"]
DOCUMENT_TITLES = ["universal registration document", "annual report", "registration document", "document d enregistrement universel"]

#: Words of an organisation chart, of a sentence, and of titles that are surely sections.
CHART_WORDS = ["holding", "holdings", "companies", "company", "bv", "inc", "lvmh"]
VERBS = ["is", "are", "was", "were", "can", "be", "used", "proposed", "contains", "include", "includes"]
SURE_TITLES = ["risk", "climate", "environment", "social", "governance", "financial highlights", "overview", "remuneration", "ethics", "vigilance"]

#: Units that may stand in a bare number.
NUMBER_WORDS = ["eur", "usd", "millions", "million", "bn", "m", "kg", "tons", "tonnes"]

#: Limits of quotes, of short evidence, of a heading's score, and the zones of a page.
QUOTE_LIMIT, LEAST_EVIDENCE, SHORT_EVIDENCE, LEAST_SCORE = 800, 30, 60, 0.45
HEADER_ZONE, FOOTER_ZONE = 0.12, 0.88

_YEAR = r"\b(1[0-9]\d{2}|20\d{2})\b"


def clean(text: Column) -> Column:
    return collapse(F.coalesce(text, F.lit("")))


def matching(text: Column) -> Column:
    """Single spaces, no case, no marks."""
    return fold_accents(clean(text))


def _count(text: Column, kept: str) -> Column:
    """How many characters are of a class."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", ""))


def upper_ratio(text: Column) -> Column:
    """Capitals among letters; 0 without letters."""
    letters = _count(text, r"\p{L}")
    return F.when(letters > 0, _count(text, r"\p{Lu}") / letters).otherwise(0.0)


def digit_ratio(text: Column) -> Column:
    """Digits among letters and digits; NULL without either."""
    signs = _count(text, r"\p{L}\p{Nd}")
    return F.when(signs > 0, _count(text, r"\p{Nd}") / signs)


def years_in(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_YEAR), 1)


def block_class(text: Column) -> Column:
    """unknown without words; title if short and mostly capitals or with two digits in front; else paragraph."""
    t = clean(text)
    title = (F.length(t) <= 90) & ((upper_ratio(t) > 0.75) | t.rlike(r"^\p{Nd}{2}"))
    return F.when(t == "", F.lit("unknown")).when(title, F.lit("title")).otherwise(F.lit("paragraph"))


def is_list_item(text: Column) -> Column:
    return clean(text).rlike(r"^[-*•–]\s+|^\d+[.)]\s+|^\([a-zA-Z]\)\s+|^[a-zA-Z]\)\s+")


def is_caption(text: Column) -> Column:
    return clean(text).rlike(r"(?i)^(figure|fig\.|table|exhibit|chart|graph|tableau|graphique)\s+\d+")


def ends_with_number(text: Column) -> Column:
    return clean(text).rlike(r"(^|\s)\.*\d+\.*$")


def is_contents_entry(text: Column) -> Column:
    return ends_with_number(text) | clean(text).rlike(r"^[A-Z][A-Z0-9\s,&'/-]{4,}\s+\d+$")


def is_footnote(text: Column) -> Column:
    t = clean(text)
    return (F.length(t) >= 25) & t.rlike(r"^\((\d+|[a-zA-Z])\)\s+\S+|^\*\s+\S+")


def is_footer_label(text: Column) -> Column:
    return contains_any(F.lower(clean(text)), FOOTER_LABELS)


def is_footer_pattern(text: Column) -> Column:
    label = "20[0-9]{2} universal registration document"
    return F.lower(clean(text)).rlike(rf"^\d{{1,4}} {label}( \d{{1,4}})?$|^{label} \d{{1,4}}$")


def repeated_form(text: Column) -> Column:
    """The text by which repeats on other pages are known: numbers as one sign."""
    return F.regexp_replace(F.lower(clean(text)), r"\d+", "#")


def refined(blocks: DataFrame, document: str, page: str, text: str, kind: str, top: str, bottom: str, height: str, contents_page: str) -> DataFrame:
    """Adds block_type, block_type_confidence and reason, by the first rule that holds: footnote, list item, caption,
    contents entry, header, footer; else the type given. Repeats are counted once for each text and joined back."""
    form = repeated_form(F.col(text))
    spread = blocks.select(document, form.alias("_form"), page).groupBy(document, "_form").agg(F.count_distinct(page).alias("_pages"))
    rows = blocks.withColumn("_form", form).join(spread, [document, "_form"], "left")
    t, many = clean(F.col(text)), F.coalesce("_pages", F.lit(0)) >= 2
    known = F.col(height) > 0
    in_header, in_footer = known & (F.col(top) <= F.col(height) * HEADER_ZONE), known & (F.col(bottom) >= F.col(height) * FOOTER_ZONE)
    short, label, pattern = F.length(t) <= 90, is_footer_label(t), is_footer_pattern(t)
    cases = [
        (in_footer & is_footnote(t) & ~pattern & ~label, "footnote", 0.75),
        (is_list_item(t), "list_item", 0.85),
        (is_caption(t), "caption", 0.85),
        (F.col(contents_page) & (F.col(kind) == "title") & is_contents_entry(t), "toc_entry", 0.8),
        (short & in_header & many, "header", 0.75),
        (short & in_footer & pattern, "footer", 0.85),
        (short & in_footer & many & label, "footer", 0.78),
    ]
    which, sure = F.col(kind), F.lit(0.5)
    for cond, name, confidence in reversed(cases):
        hit = F.coalesce(cond, F.lit(False))
        which, sure = F.when(hit, F.lit(name)).otherwise(which), F.when(hit, F.lit(confidence)).otherwise(sure)
    return rows.withColumns({"_t": which, "block_type_confidence": sure}).drop("_form", "_pages", kind).withColumnRenamed("_t", kind)


def is_timeline(text: Column) -> Column:
    """A heading that is a date or a run of them."""
    t = clean(text)
    low, found = F.lower(t), years_in(t)
    dated = t.rlike(r"^(1[0-9]\d{2}|20\d{2})\s+[A-Z][A-Za-zÀ-ÖØ-öø-ÿ'’.-]+") & ~low.rlike(r"\b(highlights?|results?|performance)\b")
    dense = (F.length(t) > 45) & (_count(t, r"\p{Nd}") / F.greatest(F.length(t), F.lit(1)) > 0.18) & (F.size(found) > 0)
    return dated | (F.size(found) >= 2) | contains_any(low, ["century", "siècle", "siecle"]) | dense


def is_number_like(text: Column) -> Column:
    """No words but units, or mostly digits; an empty text counts."""
    t = clean(text)
    words = F.filter(F.regexp_extract_all(F.lower(t), F.lit("([a-z]+)"), 1), lambda w: ~w.isin(NUMBER_WORDS))
    bare = t.rlike(r"^[\d\s,.\-%€$£()A-Za-z]{1,40}$") & (_count(t, r"\p{Nd}") > 0) & (F.size(words) == 0)
    compact = F.regexp_replace(t, r"[\s,.\-%€$£()]", "")
    return (t == "") | bare | compact.rlike(r"^\p{Nd}+$") | F.coalesce(digit_ratio(t) > 0.65, F.lit(False))


def too_numeric(text: Column) -> Column:
    return F.coalesce(digit_ratio(clean(text)) > 0.45, F.lit(True))


def is_fragment(text: Column) -> Column:
    """A part of a heading rather than one."""
    return matching(text).rlike(r"^\((from|as of|at|for|since)\b.*\)$|^(of|as of|from|for|and|or|the)\b|^(companies|company|group)$")


def is_org_chart(text: Column) -> Column:
    t, m = clean(text), matching(text)
    words = F.regexp_extract_all(m, F.lit("([a-z0-9]+)"), 1)
    named = F.arrays_overlap(words, F.array(*map(F.lit, CHART_WORDS))) & (F.length(t) <= 70)
    shouted = (F.length(t) <= 24) & (upper_ratio(t) > 0.85) & ~m.rlike(r"\b(risk|climate|social|governance|environment|financial|highlights|overview|business)\b")
    return (t != "") & (m.isin("lvmh", "other holding", "companies") | (_count(t, "%") >= 2) | named | shouted)


def is_diagram(text: Column) -> Column:
    t = clean(text)
    return (_count(t, "%") >= 2) | ((F.size(years_in(t)) >= 2) & (F.size(F.split(t, " ")) <= 10))


def is_sentence(text: Column) -> Column:
    t, m = clean(text), matching(text)
    words = F.regexp_extract_all(m, F.lit("([a-z]+)"), 1)
    said = t.rlike(r"^\d[\d,.\s]*\s+[a-zA-Z]") | t.contains(".")
    verbal = F.arrays_overlap(words, F.array(*map(F.lit, VERBS))) & (F.length(t) > 45)
    return (t != "") & ~contains_any(m, SURE_TITLES) & ((said & (F.length(t) > 35)) | verbal)


def is_front_matter(text: Column) -> Column:
    m = matching(text)
    return m.contains("fiscal year ended") | m.isin(CONTENTS_TITLES)


def section_class(title: Column) -> Column:
    """The first type with a pattern in the title, else unknown. The title is put in its plain form once, and a text without
    any pattern is told by one expression, whose words are tried at the sides of words alone."""
    inner = {name: "|".join(p.removeprefix(r"\b").removesuffix(r"\b") for p in patterns) for name, patterns in SECTION_TYPES.items()}
    whole = lambda words: rf"\b(?:{words})\b"
    some = whole("|".join(inner.values()))
    chosen = lambda m: F.when(m.rlike(some), first_case(*((m.rlike(whole(words)), name) for name, words in inner.items()), otherwise="unknown")).otherwise(F.lit("unknown"))
    return F.element_at(F.transform(F.array(matching(title)), chosen), 1)


def heading_score(text: Column, confidence: Column) -> Column:
    """The block's confidence, more for capitals and a known type, less for a short text, a fragment or a sentence; 0 to 1."""
    t = clean(text)
    capitals = (upper_ratio(t) >= 0.65) & F.length(t).between(4, 120)
    one = lambda c, x: F.when(c, F.lit(x)).otherwise(0.0)
    raw = confidence + one(capitals, 0.12) + one(section_class(text) != "unknown", 0.18) - one(F.length(text) < 8, 0.15) - one(is_fragment(text), 0.25) - one(is_sentence(text), 0.25)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(raw, 6)))


def heading_status(text: Column, kind: Column, confidence: Column) -> Column:
    """accepted, or the first reason to reject a block as a section's heading."""
    t, m = F.trim(text), matching(text)
    return first_case(
        (kind == "toc_entry", "rejected_toc_entry"),
        (kind.isin("header", "footer"), "rejected_header_footer"),
        (kind == "footnote", "rejected_footnote"),
        (kind == "caption", "rejected_structural_block"),
        (kind == "list_item", "rejected_list_item"),
        (kind != "title", "rejected_low_confidence"),
        (t == "", "rejected_too_short"),
        (m.isin(CONTENTS_TITLES), "rejected_toc_heading"),
        (m.isin(DOCUMENT_TITLES), "rejected_document_title"),
        (is_front_matter(text), "rejected_front_matter"),
        (F.length(t) < 4, "rejected_too_short"),
        (is_number_like(text), "rejected_numeric_value"),
        (too_numeric(text), "rejected_too_numeric"),
        (is_timeline(text), "rejected_timeline_like"),
        (is_fragment(text), "rejected_heading_fragment"),
        (is_org_chart(text), "rejected_org_chart_like"),
        (is_diagram(text), "rejected_diagram_like"),
        (is_sentence(text), "rejected_sentence_like_heading"),
        (confidence < 0.45, "rejected_low_confidence"),
        (heading_score(text, confidence) < LEAST_SCORE, "rejected_low_confidence"),
        otherwise="accepted",
    )


def merged_headings(candidates: DataFrame, document: str, page: str, order: str, text: str, status: str) -> DataFrame:
    """Joins an accepted heading with the accepted one right behind it, if the first ends in a comma or colon or the second
    is a fragment. A heading that was merged away takes none itself, so in a run every second one does: it is told by its
    place in the run, without a loop. Adds heading_text, was_merged and the new status."""
    w = Window.partitionBy(document).orderBy(page, order)
    t, after = F.trim(text), F.lead(text).over(w)
    plain = lambda c: ~is_org_chart(c) & ~is_number_like(c)
    pair = (
        (F.col(status) == "accepted") & (F.lead(status).over(w) == "accepted") & (F.lead(page).over(w) == F.col(page)) & (F.lead(order).over(w) == F.col(order) + 1)
        & plain(F.col(text)) & plain(after) & (t.rlike("[,;:]$") | is_fragment(after))
    )
    rows = candidates.withColumn("_pair", F.coalesce(pair, F.lit(False))).withColumn("_at", F.row_number().over(w)).withColumn("_after", F.trim(after))
    # places since the last row that doesn't pair
    run = F.col("_at") - F.coalesce(F.max(F.when(~F.col("_pair"), F.col("_at"))).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    rows = rows.withColumn("_takes", F.col("_pair") & (run % 2 == 1))
    rows = rows.withColumn("_taken", F.coalesce(F.lag("_takes").over(w), F.lit(False)))
    whole = F.when(F.col("_takes"), F.replace(clean(F.concat_ws(" ", t, F.col("_after"))), F.lit(" ,"), F.lit(","))).otherwise(t)
    out = rows.withColumns({"heading_text": whole, "was_merged": F.col("_takes"), "_s": F.when(F.col("_taken"), F.lit("rejected_heading_fragment")).otherwise(F.col(status))})
    return out.drop("_pair", "_at", "_after", "_takes", "_taken", status).withColumnRenamed("_s", status)


def makes_evidence(text: Column, kind: Column) -> Column:
    """Paragraphs of some length that are no numbers."""
    return (kind == "paragraph") & (F.length(clean(text)) >= LEAST_EVIDENCE) & ~is_number_like(F.substring(clean(text), 1, QUOTE_LIMIT))


def paragraph_evidence(blocks: DataFrame, document: str, section: str, page: str, order: str, text: str, limit: int = QUOTE_LIMIT) -> DataFrame:
    """Evidence of neighbouring paragraphs: same section, the next in order, on the same page or the next, within ``limit``
    characters together, and where the first is short or unfinished or the second goes on in lower case.

    Where a run ends is a matter of rows side by side; only the length is carried. So runs are islands first, and each
    island of a document is folded in order, in one pass over its rows.

    A quote has at most ``limit`` characters of a block; ``characters`` counts all that the blocks have, and ``truncated`` tells
    whether some were left out. Rows without a document are one document.
    """
    w = Window.partitionBy(document).orderBy(order)
    gap = lambda c: F.col(c) - F.lag(c).over(w)
    joined = F.lag(section).over(w).eqNullSafe(F.col(section)) & (gap(order) == 1) & gap(page).isin(0, 1)
    rows = blocks.withColumn("_break", F.when(F.coalesce(joined, F.lit(False)), 0).otherwise(1))
    rows = rows.withColumn("island", F.sum("_break").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    whole = F.coalesce(F.length(clean(F.col(text))), F.lit(0)).cast("long").alias("characters")
    slim = rows.select(document, "island", section, page, order, F.coalesce(F.substring(clean(F.col(text)), 1, limit), F.lit("")).alias("quote"), whole)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import re

        unfinished, goes_on = re.compile(r"[.!?;:]$"), re.compile(r"^(and|or|to|of|in|with|for|as|that|which|while|including)\b", re.IGNORECASE)

        def follows(size: int, end: str, said: str) -> bool:
            return bool(size and said) and (size < 120 or not unfinished.search(end) or bool(goes_on.match(said)) or said[:1].islower())

        last: tuple | None = None
        parts: list[str] = []
        head: list = []
        size = all_of = 0
        cut = False
        columns = [document, section, page, order, "quote", "blocks", "characters", "truncated"]
        for pdf in batches:
            out = []
            for doc, island, sec, pg, at, quote, n in zip(*(pdf[c] for c in pdf.columns), strict=True):
                # pandas has NaN, which doesn't equal itself, for a missing number
                key = (None if doc is None or doc != doc else doc, island)
                if last == key and size + 1 + len(quote) <= limit and follows(size, parts[-1], quote):
                    parts.append(quote)
                    size += 1 + len(quote)
                else:
                    if parts:
                        out.append([*head, " ".join(parts), len(parts), all_of, cut])
                    head, parts, size, all_of, cut = [doc, sec, pg, at], [quote], len(quote), 0, False
                all_of, cut = all_of + n, cut or n > limit
                last = key
            yield pd.DataFrame(out, columns=columns)
        if parts:
            yield pd.DataFrame([[*head, " ".join(parts), len(parts), all_of, cut]], columns=columns)

    schema = T.StructType([*(blocks.schema[c] for c in (document, section, page, order)), T.StructField("quote", T.StringType()), T.StructField("blocks", T.LongType()), T.StructField("characters", T.LongType()), T.StructField("truncated", T.BooleanType())])
    dealt = slim.repartition(document, "island").sortWithinPartitions(document, "island", order)
    return dealt.mapInPandas(fold, schema).filter(F.length("quote") >= LEAST_EVIDENCE).withColumn("review_short", F.length("quote") < SHORT_EVIDENCE)


def evidence_store(headings: DataFrame, paragraphs: DataFrame, document: str, section: str, page: str, order: str) -> DataFrame:
    """Headings first, then paragraphs, numbered within their document."""
    titles = headings.select(document, section, page, order, F.lit("section_heading").alias("evidence_type"), F.substring(clean(F.col("quote")), 1, QUOTE_LIMIT).alias("quote"), F.lit(1).cast("long").alias("blocks"), F.lit(0.95).alias("evidence_confidence"), F.lit(False).alias("review_required"))
    said = paragraphs.select(document, section, page, order, F.lit("paragraph").alias("evidence_type"), "quote", "blocks", F.lit(0.88).alias("evidence_confidence"), F.col("review_short").alias("review_required"))
    out = titles.filter("quote <> ''").unionByName(said)
    place = F.row_number().over(Window.partitionBy(document).orderBy(F.desc("evidence_type"), order))
    return out.withColumn("evidence_id", F.concat(F.col(document).cast("string"), F.lit("_evidence_"), F.lpad(place.cast("string"), 6, "0")))


def table_like(text: Column, keywords: Sequence[str]) -> Column:
    """A page with two of the keywords, three percentages, or three lines of three numbers each."""
    words = F.size(F.filter(F.array(*map(F.lit, keywords)), lambda k: F.lower(text).contains(k)))
    lines = F.filter(F.split(text, r"\n"), lambda x: F.size(F.regexp_extract_all(x, F.lit(r"\b(\d[\d\s,.]*)\b"), 1)) >= 3)
    return (words >= 2) | (F.size(F.regexp_extract_all(text, F.lit(r"(\d[\d\s,]*%)"), 1)) >= 3) | (F.size(lines) >= 3)
