"""One generic scorer for candidates of all document families: weights, keywords and caps are data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import company_matches, contains_any, domain_matches, fold_accents, is_pdf_url, normalize, path_and_query, years


@dataclass(frozen=True)
class Family:
    """The rule data of a family; points of 0 switch a rule off."""

    name: str
    strong: Sequence[str]
    secondary: Sequence[str] = ()
    weak: Sequence[str] = ()
    points: Mapping[str, float] = field(default_factory=dict)
    #: keyword class: (keywords, points, cap of the score)
    penalties: Mapping[str, tuple[Sequence[str], float, float]] = field(default_factory=dict)
    #: penalties that count only where no keyword of the family is found
    without_keyword: Sequence[str] = ()
    #: keyword class: (keywords, points), for documents with any keyword of the family
    bonuses: Mapping[str, tuple[Sequence[str], float]] = field(default_factory=dict)
    #: domain class: (domains, points)
    domains: Mapping[str, tuple[Sequence[str], float]] = field(default_factory=dict)
    platforms: Sequence[str] = ()
    low_trust: Sequence[str] = ()
    unknown_cap: float = 59.0
    accept: float = 80.0
    review: float = 60.0


#: Points by family. Rules: year matches, another year only, no year; strong, secondary, weak keyword or
#: none; company found or not; official domain; platform domain; pdf or not; keyword in the file name; low-trust domain.
POINTS = {
    "annual": {"year": 30, "other_year": -35, "no_year": -5, "strong": 30, "weak": 15, "none": -20, "company": 20, "no_company": -30, "official": 20, "pdf": 12, "no_pdf": -8, "filename": 15, "low_trust": -45},
    "climate": {"year": 25, "other_year": -15, "strong": 35, "secondary": 35, "weak": 18, "none": -25, "company": 20, "no_company": -25, "official": 20, "pdf": 10, "no_pdf": -8, "filename": 15, "low_trust": -45},
    "sustainability": {"year": 25, "other_year": -15, "strong": 35, "secondary": 35, "weak": 18, "none": -25, "company": 20, "no_company": -25, "official": 20, "pdf": 10, "no_pdf": -8, "filename": 15, "low_trust": -45},
    "governance": {"year": 25, "other_year": -15, "strong": 35, "secondary": 35, "weak": 18, "none": -25, "company": 20, "no_company": -25, "official": 20, "pdf": 10, "no_pdf": -8, "filename": 15, "low_trust": -45},
    "remuneration": {"year": 25, "other_year": -15, "strong": 35, "secondary": 35, "weak": 18, "none": -25, "company": 20, "no_company": -25, "official": 20, "pdf": 10, "no_pdf": -8, "filename": 15, "low_trust": -45},
    "vigilance": {"year": 25, "other_year": -15, "strong": 35, "secondary": 35, "weak": 18, "none": -25, "company": 20, "no_company": -25, "official": 20, "pdf": 10, "no_pdf": -8, "filename": 15, "low_trust": -45},
    "agm": {"year": 20, "strong": 40, "secondary": 20, "weak": 8, "company": 20, "no_company": -40, "official": 20, "pdf": 10, "filename": 15, "low_trust": -45},
    "assurance": {"year": 20, "strong": 45, "secondary": 20, "weak": 8, "company": 15, "official": 20, "pdf": 10, "filename": 15, "low_trust": -45},
    "cdp": {"year": 20, "strong": 40, "secondary": 25, "weak": 8, "company": 15, "no_company": -40, "official": 15, "platform": 20, "pdf": 10, "filename": 10, "low_trust": -45},
    "sbti": {"year": 15, "strong": 45, "secondary": 20, "weak": 8, "company": 15, "no_company": -40, "official": 15, "platform": 20, "pdf": 10, "filename": 10, "low_trust": -45},
    "earnings": {"year": 20, "other_year": -10, "strong": 45, "secondary": 20, "weak": 8, "company": 15, "no_company": -40, "official": 15, "platform": 10, "pdf": 5, "filename": 10, "low_trust": -45},
    "investor": {"year": 20, "strong": 40, "secondary": 20, "weak": 8, "company": 20, "no_company": -40, "official": 20, "pdf": 10, "filename": 15, "low_trust": -45},
    "half_year": {"year": 25, "strong": 35, "secondary": 20, "weak": 10, "company": 20, "official": 20, "pdf": 10, "filename": 15, "low_trust": -45},
    "policy": {"year": 15, "strong": 40, "secondary": 20, "weak": 10, "company": 20, "official": 25, "pdf": 10, "filename": 15, "low_trust": -45},
}


#: So many distinct hits are scored once each and looked up by all others that repeat them; their scores are broadcast.
REPEATED = 100_000


def _with_features(candidates: DataFrame, title: str, url: str, snippet: str) -> DataFrame:
    """Adds what all families ask of a hit, each worked out once."""
    whole = F.concat_ws(" ", F.col(title), F.col(url), F.col(snippet))
    df = candidates.withColumns({
        "_text": normalize(F.concat_ws(" ", F.col(title), F.col(snippet), path_and_query(F.col(url)))),
        "_name": F.coalesce(normalize(F.element_at(F.split(F.col(url), "/"), -1)), F.lit("")),
        "_years": years(whole),
        "_company": F.coalesce(company_matches(whole, F.col("company")), F.lit(False)),
        "_official": F.coalesce(domain_matches(F.col("domain"), F.col("official_domain")), F.lit(False)),
        "_pdf": F.coalesce(is_pdf_url(F.col(url)), F.lit(False)),
    })
    return df.withColumn("_wanted", F.array_contains("_years", F.col("fiscal_year").cast("string")))


def _found(family: Family) -> dict[str, Column]:
    """Whether each of the family's lists has a keyword in the text; columns of their own, since many rules ask for them."""
    lists = {"strong": family.strong, "second": family.secondary, "weak": family.weak} | {f"is_{k}": x[0] for k, x in [*family.bonuses.items(), *family.penalties.items()]}
    out = {f"_{family.name}_{k}": contains_any(F.col("_text"), list(words)) if words else F.lit(False) for k, words in lists.items()}
    return out | {f"_{family.name}_file": contains_any(F.col("_name"), list(family.strong)) if family.strong else F.lit(False)}


def _judged(family: Family) -> tuple[list[tuple[str, Column, float]], Column, Column, Column]:
    """(rules that give or take points, score, has_keyword, decision) over the columns of ``_with_features`` and ``_found``."""
    p = lambda rule: float(family.points.get(rule, 0))
    hits = lambda k: F.col(f"_{family.name}_{k}")
    wanted, company, official, pdf = (F.col(c) for c in ("_wanted", "_company", "_official", "_pdf"))
    strong, second = hits("strong"), hits("second")
    weak = hits("weak") & ~strong
    any_keyword = strong | second | weak
    counts = lambda k: hits(f"is_{k}") & ~any_keyword if k in family.without_keyword else hits(f"is_{k}")
    rules: list[tuple[str, Column, float]] = [
        ("year", wanted, p("year")),
        ("other_year", ~wanted & (F.size("_years") > 0), p("other_year")),
        ("no_year", F.size("_years") == 0, p("no_year")),
        ("strong", strong, p("strong")),
        ("secondary", second & ~strong, p("secondary")),
        ("weak", weak, p("weak")),
        ("none", ~strong & ~second & ~weak, p("none")),
        ("company", company, p("company")),
        ("no_company", ~company, p("no_company")),
        ("official", official, p("official")),
        ("platform", F.col("domain").isin(list(family.platforms)) if family.platforms else F.lit(False), p("platform")),
        ("pdf", pdf, p("pdf")),
        ("no_pdf", ~pdf, p("no_pdf")),
        ("filename", hits("file") & pdf, p("filename")),
        ("low_trust", F.col("domain").isin(list(family.low_trust)) if family.low_trust else F.lit(False), p("low_trust")),
        *((k, hits(f"is_{k}") & any_keyword, points) for k, (_, points) in family.bonuses.items()),
        *((k, F.col("domain").isin(list(domains)), points) for k, (domains, points) in family.domains.items()),
        *((k, counts(k), points) for k, (_, points, _) in family.penalties.items()),
    ]
    rules = [r for r in rules if r[2]]
    total = sum((F.when(F.coalesce(c, F.lit(False)), F.lit(x)).otherwise(0.0) for _, c, x in rules), F.lit(0.0))
    # conditions are columns, so a cap is a term of its own rather than nested in the next
    caps = [F.when(counts(k), F.lit(float(most))) for k, (_, _, most) in family.penalties.items()] + [F.when(~strong & ~second & ~weak, F.lit(float(family.unknown_cap)))]
    value = F.greatest(F.lit(0.0), F.least(total, F.lit(100.0), *caps))
    return rules, value, strong | second, pdf


def _decided(family: Family, value: Column, has_keyword: Column, pdf: Column) -> Column:
    return (
        F.when(~has_keyword | (value < family.review), F.lit("reject"))
        .when(~pdf, F.lit("pdf_resolution_required"))
        .when(value >= family.accept, F.lit("auto_download"))
        .otherwise(F.lit("human_review_required"))
    )


def score(candidates: DataFrame, family: Family, title: str = "title", url: str = "url", snippet: str = "snippet") -> DataFrame:
    """Adds the score (0 to 100), the decision and the names of the rules that gave or took points.

    ``candidates`` also has company, official_domain, domain and fiscal_year. All rules are column expressions over one
    row, so a whole corpus of search hits is scored in one pass.
    """
    df = _with_features(candidates, title, url, snippet).withColumns(_found(family))
    rules, value, has_keyword, pdf = _judged(family)
    signals = lambda keep: F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c, x in rules if keep(x))))
    out = df.withColumns({"score": value, "positive_signals": signals(lambda x: x > 0), "negative_signals": signals(lambda x: x < 0), "is_pdf": pdf, "has_keyword": has_keyword})
    out = out.withColumn("decision", _decided(family, F.col("score"), F.col("has_keyword"), F.col("is_pdf")))
    return out.select(*(F.col(f"`{c}`") for c in candidates.columns), "score", "positive_signals", "negative_signals", "is_pdf", "has_keyword", "decision")


def scored_by_all(candidates: DataFrame, families: Mapping[str, Family], title: str = "title", url: str = "url", snippet: str = "snippet") -> DataFrame:
    """The candidates once for each family, with ``family``, ``score`` and ``decision``, as ``score`` gives them.

    One pass for all families. Hits recur: where there are few distinct ones, by an estimate that only chooses the way,
    each is scored once, and its scores are looked up.
    """
    inputs = list(dict.fromkeys([title, url, snippet, "company", "official_domain", "domain", "fiscal_year"]))

    def every(df: DataFrame) -> DataFrame:
        found = {k: c for f in families.values() for k, c in _found(f).items()}
        df = _with_features(df, title, url, snippet).withColumns(found)
        values = {f"_{name}_score": _judged(f)[1] for name, f in families.items()}
        one = lambda name, f: F.struct(F.lit(name).alias("family"), F.col(f"_{name}_score").alias("score"), _decided(f, F.col(f"_{name}_score"), *_judged(f)[2:]).alias("decision"))
        return df.withColumns(values).withColumn("_all", F.array(*(one(name, f) for name, f in families.items())))

    distinct = candidates.agg(F.approx_count_distinct(F.xxhash64(*inputs)).alias("n")).first()["n"]
    if distinct <= REPEATED:
        scores = every(candidates.select(*inputs).distinct()).select(*(F.col(c).alias(f"_of_{c}") for c in inputs), "_all")
        same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in inputs]
        full = candidates.join(F.broadcast(scores), same)
    else:
        full = every(candidates)
    # numbers are unnested, not the scores: Spark would filter by the size of their array, and work all of it out for that
    own = [F.col(f"`{c}`") for c in candidates.columns]
    full = full.select(*own, "_all", F.explode(F.array(*(F.lit(i) for i in range(len(families))))).alias("_i"))
    return full.select(*own, F.get("_all", F.col("_i")).alias("_one")).select(*own, "_one.*")


def classified(features: DataFrame, rules: Sequence[tuple[str, str]], unknown: str = "unknown") -> Column:
    """The document class of a candidate: the first of the ordered (class, condition over feature columns) that holds."""
    out = F.lit(unknown)
    for name, condition in reversed(rules):
        out = F.when(F.expr(condition), F.lit(name)).otherwise(out)
    return out


def class_decision(kind: Column, score: Column, is_pdf: Column, allowed: Sequence[str], blocked: Sequence[str], landing: Sequence[str] = (), accept: float = 80.0, review: float = 60.0) -> Column:
    """By class first: blocked ones are rejected, or reviewed from ``review`` on; landing pages are to be resolved; allowed
    ones are downloaded from ``accept`` on if they are a PDF."""
    high, middling = score >= accept, score >= review
    return (
        F.when(kind.isin(list(blocked)), F.when(middling, F.lit("human_review_required")).otherwise(F.lit("reject")))
        .when(kind.isin(list(landing)), F.when(middling, F.lit("pdf_resolution_required")).otherwise(F.lit("reject")))
        .when(kind.isin(list(allowed)) & high, F.when(is_pdf, F.lit("auto_download")).otherwise(F.lit("pdf_resolution_required")))
        .when(middling, F.when(is_pdf, F.lit("human_review_required")).otherwise(F.lit("pdf_resolution_required")))
        .otherwise(F.lit("reject"))
    )


def document_validation(text: Column, technical: Column, company_name: Column, company_slug: Column, fiscal_year: Column, keywords: Sequence[str]) -> Column:
    """struct<status, note>: whether a document is what it is filed as, by its text: the company's name, words of its kind, years.

    unreadable files first; without words needs_review; in a longer text without the company, likely_wrong_company unless
    words of the kind stand in it; with such words likely_valid, unless years are named and neither the fiscal year nor the
    one before is among them.
    """
    low = F.trim(F.regexp_replace(fold_accents(F.coalesce(text, F.lit(""))), r"(?U)\s+", " "))
    name = lambda c: F.trim(fold_accents(F.coalesce(c, F.lit(""))))
    said = lambda c: (F.length(c) >= 3) & low.contains(c)
    company = said(name(company_name)) | said(F.replace(name(company_slug), F.lit("-"), F.lit(" ")))
    kind = F.exists(F.array(*map(F.lit, keywords)), lambda k: low.contains(k))
    found = years(F.coalesce(text, F.lit("")))
    far = fiscal_year.isNotNull() & (F.size(found) > 0) & ~F.arrays_overlap(found, F.array(fiscal_year.cast("string"), (fiscal_year - 1).cast("string")))
    wrong = ~company & (F.length(low) > 500)
    cases = [
        (technical.isin("missing_file", "not_pdf", "unreadable_pdf"), "unreadable", "file"),
        (low == "", "needs_review", "no_text"),
        (wrong & kind, "needs_review", "company_not_found"),
        (wrong, "likely_wrong_company", "company_not_found"),
        (kind & F.coalesce(far, F.lit(False)), "needs_review", "other_years"),
        (kind, "likely_valid", "none"),
    ]
    status, note = F.lit("needs_review"), F.lit("no_keyword")
    for c, s, n in reversed(cases):
        hit = F.coalesce(c, F.lit(False))
        status, note = F.when(hit, F.lit(s)).otherwise(status), F.when(hit, F.lit(n)).otherwise(note)
    return F.struct(status.alias("status"), note.alias("note"))


def download_status(attempts: Column) -> Column:
    """From an array of attempts (struct<status_code, content_type>): ok, not_pdf, blocked, not_found or failed."""
    any_ = lambda cond: F.exists(attempts, cond)
    return (
        F.when(any_(lambda a: (a["status_code"] == 200) & F.lower(a["content_type"]).contains("pdf")), F.lit("ok"))
        .when(any_(lambda a: a["status_code"] == 200), F.lit("not_pdf"))
        .when(any_(lambda a: a["status_code"].isin(401, 403, 429)), F.lit("blocked"))
        .when(any_(lambda a: a["status_code"].isin(404, 410)), F.lit("not_found"))
        .otherwise(F.lit("failed"))
    )
