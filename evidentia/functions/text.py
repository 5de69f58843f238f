"""Text functions over columns. All are expressions of built-in functions, so they stay inside code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Latin letters with marks and their plain forms, in step.
MARKED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿāăąćčďđēėęěğģīįķļłńņňōőŕřśşšţťūůűųźżž"
PLAIN = "aaaaaaceeeeiiiinoooooouuuuyyaaaccddeeeeggiikllnnnoorrsssttuuuuzzz"


def missing(c: Column) -> Column:
    """NULL for a blank."""
    return F.nullif(F.trim(c), F.lit(""))


def fold_accents(c: Column) -> Column:
    """Lower case without marks on Latin letters."""
    return F.translate(F.lower(c), MARKED, PLAIN)


def normalize(c: Column) -> Column:
    """Lower case, no marks, runs of anything but a-z and 0-9 as one space, trimmed."""
    return F.trim(F.regexp_replace(fold_accents(c), "[^a-z0-9]+", " "))


def collapse(c: Column) -> Column:
    """White space as single spaces, trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def key_text(c: Column) -> Column:
    """Trimmed, lower case, single spaces; NULL as an empty text. For keys of duplicates."""
    return F.lower(collapse(F.coalesce(c, F.lit(""))))


def plain_key(c: Column) -> Column:
    """Lower case, everything but a-z and 0-9 as a space; marks are not folded."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def slug(c: Column, unknown: str = "unknown") -> Column:
    out = F.replace(normalize(c), F.lit(" "), F.lit("-"))
    return F.when(F.coalesce(out, F.lit("")) == "", F.lit(unknown)).otherwise(out)


def safe_filename(c: Column) -> Column:
    """Letters, digits, dots, dashes and underscores; anything else as one underscore."""
    return F.regexp_replace(F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "_"), "^_+|_+$", "")


def domain(url: Column) -> Column:
    """Lower-case host with its port, without a leading www."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1)), r"^www\.", "")


def path_and_query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)


def is_pdf_url(url: Column) -> Column:
    low = F.lower(url)
    path = F.regexp_extract(low, r"^([^?#]*)", 1)
    return path.endswith(".pdf") | low.contains(".pdf?") | low.contains(".pdf#") | F.regexp_extract(low, r"\?(.*)$", 1).contains(".pdf")


def years(c: Column) -> Column:
    """Distinct years 1900 to 2099 on word boundaries, ascending."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(r"\b((?:19|20)\d{2})\b"), 1)))


def years_relevant(c: Column, fiscal_year: Column) -> Column:
    """No year at all, or the fiscal year or the one before among them."""
    found = years(c)
    wanted = F.array(fiscal_year.cast("string"), (fiscal_year - 1).cast("string"))
    return (F.size(found) == 0) | F.arrays_overlap(found, wanted)


def found_keywords(normalized: Column, keywords: Sequence[str]) -> Column:
    """The keywords that the text contains, in catalog order."""
    return F.filter(F.array(*map(F.lit, keywords)), lambda k: normalized.contains(k))


def contains_any(text: Column, keywords: Sequence[str]) -> Column:
    return F.exists(F.array(*map(F.lit, keywords)), lambda k: text.contains(k))


def occurrences(text: Column, keyword: Column) -> Column:
    """How often a keyword stands in a text, without overlap."""
    return (F.length(text) - F.length(F.replace(text, keyword, F.lit("")))) / F.length(keyword)


def first_best(text: Column, catalog: Mapping[str, Sequence[str]], default: str = "general") -> Column:
    """The category with most of its keywords in the text; the first of the catalog on a tie; the default where none is."""
    scores = F.array(*(F.struct(F.size(found_keywords(text, k)).alias("n"), F.lit(-i).alias("early"), F.lit(name).alias("name")) for i, (name, k) in enumerate(catalog.items())))
    best = F.array_max(scores)
    return F.when(best["n"] > 0, best["name"]).otherwise(F.lit(default))


def marker_vote(text: Column, markers: Mapping[str, Sequence[str]], unknown: str = "unknown") -> Column:
    """The group with most markers in the text padded by spaces; ``unknown`` on a tie."""
    padded = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    names = list(markers)
    counts = {n: F.size(found_keywords(padded, [f" {m} " for m in markers[n]])) for n in names}
    out = F.lit(unknown)
    for n in names:
        ahead = F.lit(True)
        for m in names:
            if m != n:
                ahead &= counts[n] > counts[m]
        out = F.when(ahead, F.lit(n)).otherwise(out)
    return out


def company_matches(text: Column, company: Column) -> Column:
    """The compact name inside the compact text, or at least 60 % of its words of three letters and more."""
    t, c = normalize(text), normalize(company)
    words = F.filter(F.split(c, " "), lambda w: F.length(w) >= 3)
    hits = F.size(F.filter(words, lambda w: t.contains(w)))
    compact = F.replace(t, F.lit(" "), F.lit("")).contains(F.replace(c, F.lit(" "), F.lit("")))
    return (F.length(c) > 0) & (compact | ((F.size(words) > 0) & (hits * 10 >= F.size(words) * 6)))


def domain_matches(found: Column, official: Column) -> Column:
    """The official domain or one below it."""
    return (found == official) | found.endswith(F.concat(F.lit("."), official))


def not_negated(text: Column, keyword: str, negations: Sequence[str], window: int = 60) -> Column:
    """Whether some occurrence of the keyword has no negation among the characters before it."""
    low = F.lower(text)
    parts = F.split(low, "\\Q" + keyword + "\\E")
    before = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, 1, i), keyword))
    clear = F.exists(before, lambda b: ~contains_any(F.substring(b, F.greatest(F.length(b) - window + 1, F.lit(1)), F.lit(window)), negations))
    return low.contains(keyword) & clear


def short_quote(text: Column, limit: int = 300) -> Column:
    """At most ``limit`` characters, cut behind the last full stop or semicolon past the middle."""
    t = collapse(text)
    head = F.substring(t, 1, limit)
    back = F.reverse(head)
    stop = F.least(F.when(F.instr(back, ".") > 0, F.instr(back, ".")).otherwise(limit + 1), F.when(F.instr(back, ";") > 0, F.instr(back, ";")).otherwise(limit + 1))
    at = F.lit(limit + 1) - stop
    return F.when(F.length(t) <= limit, t).when(at > limit // 2, F.substring(head, F.lit(1), at)).otherwise(head)


def display(text: Column, width: int) -> Column:
    """One line of at most ``width`` characters, with dots where it is cut."""
    t = F.replace(text, F.lit("\n"), F.lit(" "))
    return F.when(F.length(t) <= width, t).otherwise(F.concat(F.substring(t, 1, width - 3), F.lit("...")))


def hash_id(prefix: str, *parts: Column, digits: int = 20, method: str = "md5") -> Column:
    """A prefix and the first digits of a hash over the parts, joined by bars; NULL parts count as empty."""
    joined = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.concat(F.lit(prefix), F.substring(F.md5(joined) if method == "md5" else F.sha2(joined, 256), 1, digits))


def flag(c: Column, true_words: Sequence[str] = ("true", "1", "yes", "y")) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin(list(true_words)), F.lit(False))


def mapped(c: Column, table: Mapping[str, str], default: Column | None = None) -> Column:
    """A lookup in a fixed table; the default, or the value itself, where it has no entry."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), c) if pairs else F.lit(None), c if default is None else default)


def reasons(*cases: tuple[Column, str], joint: str = "; ") -> Column:
    """The names of the cases that hold, joined; NULL if none does."""
    out = F.concat_ws(joint, *(F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for cond, name in cases))
    return F.nullif(out, F.lit(""))


def first_case(*cases: tuple[Column, str], otherwise: str | Column) -> Column:
    """The name of the first case that holds."""
    out = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    for cond, name in reversed(cases):
        out = F.when(cond, F.lit(name)).otherwise(out)
    return out
