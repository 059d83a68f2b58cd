"""Boilerplate lines by site-relative frequency: lines that a large part of a host's pages share are dropped.

For every host, the pages that hold a line are divided by all pages of the host; a line above ``ratio`` that at least
``least_pages`` pages hold is boilerplate of that host and dropped from all its pages. DataFrame functions only.

A host can hold a third of all rows, so lines are counted inside the tasks before the shuffle, as 64-bit hashes, one per
page and distinct line. At most (lines per page / ratio) lines of a host can pass the ratio, so a host's list is short
whatever the host's size; it is joined to the pages under salted keys, which spread a large host over many tasks, row by row.

Cases: a null or empty text has no lines and stays as it is (null becomes empty); blank lines (spaces, tabs and other controls 9 to 13) are kept but never counted;
repeated rows count as pages of their own; a null host counts as the host with the empty name; no rows give no rows. All
columns of the input are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RATIO = 0.1
#: A line that one page alone holds is no boilerplate; without this, a host of fewer than 1 / ratio pages would lose every line.
LEAST_PAGES = 2
#: A line of these alone, or of none, is blank.
BLANKS = "\t\n\x0b\x0c\r "
#: A host's pages are spread over so many join keys.
SALTS = 32


def _blank(line: Column) -> Column:
    return F.trim(line, F.lit(BLANKS)) == ""


def drop_boilerplate(pages: DataFrame, host: Column, lines: Column, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``page`` (the whole input row as a struct, so no name can clash), host, lines, and kept (the lines that stay)."""
    marked = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("page"), F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(lines, F.array().cast("array<string>")).alias("lines"),
    )
    said = F.array_distinct(F.transform(F.filter("lines", lambda x: ~_blank(x)), lambda x: F.xxhash64(x)))
    counted = marked.select("host", F.explode(said).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") >= least_pages)
    totals = marked.groupBy("host").agg(F.count("*").alias("total"))
    common = counted.join(totals, "host").filter(F.col("n") > F.col("total") * ratio)
    listed = common.groupBy("host").agg(F.collect_list("line").alias("common"))
    salted = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # A row's own number, not its content: equal pages of a host are spread as well.
    dealt = marked.withColumn("salt", (F.monotonically_increasing_id() % SALTS).cast("int"))
    kept = F.when(F.col("common").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains("common", F.xxhash64(x)) | _blank(x))
    )
    return dealt.join(salted, ["host", "salt"], "left").select("page", "host", "lines", kept.alias("kept"))


def drop_document_lines(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``docs`` with the boilerplate lines of their ``host`` cut out of ``text``; all rows and columns stay."""
    cut = drop_boilerplate(docs, F.col(host).cast("string"), F.split(F.coalesce(text, F.lit("")), "\n"), ratio, least_pages)
    rest = [F.array_join("kept", "\n").alias(c) if c == text else F.col("page").getField(c).alias(c) for c in docs.columns]
    return cut.select(*rest)


UNSEEN = r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->"
BREAKS = r"(?i)</?(br|p|div|li|ul|ol|h[1-6]|nav|article|section|header|footer|tr|td|th|table|title|head|body)([ /][^>]*)?>"
TAGS = r"<[^>]*>"
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]*)"


def page_lines(html: Column) -> Column:
    """Lines a reader of the page sees: block tags end lines, other tags vanish, blanks at the ends go, empty lines go."""
    seen = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, UNSEEN, ""), BREAKS, "\n"), TAGS, "")
    return F.filter(F.transform(F.split(seen, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def op8_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages without the lines that over a tenth of their host's pages hold."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    cut = drop_boilerplate(pages, F.regexp_extract(F.lower("url"), HOST, 1), page_lines(F.coalesce("html", F.lit(""))))
    return cut.select(
        "page.page_id", "host", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("text"),
    )


OP8_SQL = f"""
WITH seen AS (
  SELECT page_id, coalesce(regexp_extract(lower(url), '{HOST}', 1), '') AS host, row_number() OVER () AS page,
         list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
           '{UNSEEN}', '', 'g'), '{BREAKS}', chr(10), 'g'), '{TAGS}', '', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS lines
  FROM pages
), often AS (
  SELECT host, line FROM (SELECT DISTINCT host, page, unnest(list_filter(lines, lambda x: trim(x, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') <> '')) AS line FROM seen)
  JOIN (SELECT host, count(*) AS total FROM seen GROUP BY host) USING (host)
  GROUP BY host, line, total HAVING count(*) >= {LEAST_PAGES} AND count(*) > total * CAST({RATIO} AS DOUBLE)
), listed AS (SELECT host, list(line) AS lines FROM often GROUP BY host)
SELECT page_id, s.host, CAST(len(s.lines) AS BIGINT) AS n_lines,
       CAST(len(s.lines) - len(list_filter(s.lines, lambda x: NOT list_contains(coalesce(l.lines, []), x))) AS BIGINT) AS n_dropped,
       array_to_string(list_filter(s.lines, lambda x: NOT list_contains(coalesce(l.lines, []), x)), chr(10)) AS text
FROM seen s LEFT JOIN listed l ON l.host = s.host
"""

QUERIES = {"op8_site_lines": (op8_site_lines, OP8_SQL)}
