"""Page facts that regular expressions can read, without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake.functions.links import posting_id
from vacancylake.functions.text import label_text, matched

_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""  # the three ways to write a value
_ANCHOR = r"(?is)<a\b(?:[^>]*?\s)?href" + _VALUE + r"[^>]*>([^<]*(?:<(?!/?a\b)[^<]*)*)"  # up to where any anchor begins or ends
_NUMBER_IN_PATH = r"^https?://[^/]+/[^?#]*?(\d+)"


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^https?://([^/?#]+)", 1)


def _valued(text: Column, pattern: str) -> Column:
    """The value that ``pattern`` finds in one of its first three groups; NULL if it is empty."""
    return F.coalesce(*[F.nullif(F.regexp_extract(text, pattern, k), F.lit("")) for k in (1, 2, 3)])


def page_fields(pages: DataFrame) -> DataFrame:
    """Host, id, language, title, heading and number of links of each page."""
    html = F.col("html")
    found = pages.select(  # one search of the page each; what follows reads only what was found
        "page_id",
        host(F.col("url")).alias("host"),
        posting_id(F.col("url"), [_NUMBER_IN_PATH]).alias("id"),
        F.regexp_extract(html, r"(?i)<html\b(?:[^>]*?\s)?lang" + _VALUE, 0).alias("lang"),
        matched(html, r"(?is)<title\b[^>]*>(.*?)</title").alias("title"),
        matched(html, r"(?is)<h1\b[^>]*>(.*?)</h1").alias("heading"),
        F.regexp_count(html, F.lit(r"(?i)<a\b[^>]*\bhref\s*=")).alias("link_count"),
    )
    return found.select(
        "page_id", "host", "id", _valued(F.col("lang"), r"(?i)^.*\slang" + _VALUE).alias("lang"),
        F.nullif(label_text(F.col("title")), F.lit("")).alias("title"),
        F.nullif(label_text(F.col("heading")), F.lit("")).alias("heading"), "link_count",
    )


def page_links(pages: DataFrame) -> DataFrame:
    """One row per link, in page order."""
    found = F.regexp_extract_all("html", F.lit(_ANCHOR), F.lit(0))  # one pass over the page, the rest over its links
    link = F.col("link")
    return pages.select("page_id", host(F.col("url")).alias("host"), F.posexplode(found).alias("pos", "link")).select(
        "page_id", "host", "pos", F.coalesce(_valued(link, _ANCHOR), F.lit("")).alias("href"),
        label_text(F.regexp_extract(link, _ANCHOR, 4)).alias("label"),
    )
