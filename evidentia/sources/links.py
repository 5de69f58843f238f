"""Links in HTML, as column expressions over the page's text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse, domain, is_pdf_url

HREF = r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""
FRAME = r"""(?is)<(?:iframe|embed)\s[^>]*?src\s*=\s*["']([^"']*)["']"""


def absolute(base: Column, link: Column) -> Column:
    """A link against its page: whole URLs, protocol-relative, from the root, or from the page's folder."""
    scheme, root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1), F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(F.regexp_replace(base, r"[?#].*$", ""), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*(?:/.*)?)/[^/]*$", 1)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .otherwise(F.concat(F.when(folder == "", root).otherwise(folder), F.lit("/"), link))
    )


def page_links(pages: DataFrame, ident: str, url: str, html: str) -> DataFrame:
    """(ident, pos, href, link, title, is_pdf, domain): links and frames in order; a link's first place on the page stands."""
    anchors = F.zip_with(F.regexp_extract_all(html, F.lit(HREF), 1), F.regexp_extract_all(html, F.lit(HREF), 2), lambda h, t: F.struct(h.alias("href"), t.alias("title")))
    frames = F.transform(F.regexp_extract_all(html, F.lit(FRAME), 1), lambda h: F.struct(h.alias("href"), F.lit("").alias("title")))
    rows = pages.select(ident, url, F.posexplode(F.concat(anchors, frames)).alias("pos", "_a"))
    rows = rows.select(ident, "pos", F.col("_a.href").alias("href"), absolute(F.col(url), F.col("_a.href")).alias("link"), collapse(F.regexp_replace("_a.title", "<[^>]*>", " ")).alias("title"))
    firsts = rows.filter("link <> ''").groupBy(ident, "link").agg(F.min(F.struct("pos", "href", "title")).alias("_f"))
    out = firsts.select(ident, "_f.pos", "_f.href", "link", "_f.title")
    return out.withColumns({"is_pdf": is_pdf_url(F.col("link")), "domain": domain(F.col("link"))})
