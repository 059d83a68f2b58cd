"""Queries over functions called from SQL text, VARIANT bodies and merged sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacancylake.functions.markup import Page, Step
from vacancylake.operators import sketches
from vacancylake.plans import sql_functions
from vacancylake.plans.overview import run_sql
from vacancylake.plans.queries import Registered
from vacancylake.plans.queries.analytics import OVERVIEW, POSTINGS
from vacancylake.plans.queries.texts import QUERIES as _TEXTS
from vacancylake.sources import raw_pages
from vacancylake.sources.driver_tables import AS_OF, postings, table


def _sql_overview(spark, sf):
    sql_functions.register_scalar_functions(spark)
    postings(spark, sf).createOrReplaceTempView("raw_listings")
    return run_sql(
        spark,
        """SELECT platform, id, salary_range(salary_min, salary_max, salary_currency) AS salary_range,
                  location_display(is_remote, city, region) AS location_display,
                  whole_days_since(scraped_date, CAST(:now AS TIMESTAMP_NTZ)) AS days_since_scraped,
                  whole_days_since(published_date, CAST(:now AS TIMESTAMP_NTZ)) AS days_since_published FROM raw_listings""",
        now=AS_OF,
    )


def _sql_overview_of(spark, sf):
    sql_functions.register_overview_function(spark, postings(spark, sf), AS_OF)
    return run_sql(spark, """SELECT location_display, count(*) AS n, max(days_since_scraped) AS oldest, min(salary_range) AS first_range
                             FROM overview_of(:source) GROUP BY location_display""", source="site_b")


def _links_in_sql(spark, sf):
    sql_functions.register_link_function(spark, "links_of")
    table(spark, sf, "pages").createOrReplaceTempView("saved_pages_of_sql")
    return run_sql(spark, "SELECT p.page_id, l.pos, l.href, l.label FROM saved_pages_of_sql AS p, LATERAL links_of(p.html) AS l")


def list_entries(html):
    """A plugged-in reader: the entries of every list of a page, and one without a link as unusable."""
    page = Page(html)
    for row_no, entry in enumerate(page.select(Step("li"))):
        anchor = page.follow((Step("a"),), entry)
        yield {
            "row_no": row_no, "label": page.text(entry), "href": anchor.attrs.get("href") if anchor else None,
            "size": len(page.text(entry)), "problem": None if anchor else "no link",
        }


def _reader_in_sql(spark, sf):
    sql_functions.register_reader(spark, "entries_of", list_entries, {"label": "string", "href": "string", "size": "int"})
    table(spark, sf, "pages").createOrReplaceTempView("saved_pages_of_sql")
    return run_sql(spark, """SELECT e.href, count(*) AS n, max(e.size) AS longest, count(e.problem) AS problems
                             FROM saved_pages_of_sql AS p, LATERAL entries_of(p.html) AS e GROUP BY e.href""")


def _bodies(spark, sf):
    """Event properties, some with text after the value, some with a word where a number belongs, some without the field."""
    key = F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id",
        F.when(key % 50 == 0, F.concat(F.col("props"), F.lit("}"))).when(key % 49 == 0, F.regexp_replace("props", r"\d+", '"x"'))
        .when(key % 47 == 0, "{}").when(key % 43 == 0, F.lit(None).cast("string")).otherwise(F.col("props")).alias("body"),
    )


_BODY_KIND = """CASE WHEN event_id % 50 = 0 THEN 'not JSON' WHEN event_id % 49 = 0 THEN 'a field is not of its type'
WHEN event_id % 47 = 0 THEN NULL WHEN event_id % 43 = 0 THEN 'not JSON' END"""


def _order_bodies(spark, sf):
    """One JSON body per order with a list of its lines; some orders come without the list or with something else in its place."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(
        F.struct(F.col("l_linenumber").alias("line"), F.struct(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("flag")).alias("part")))).alias("lines"))
    key = F.col("l_orderkey")
    whole = F.to_json(F.struct(F.struct("lines").alias("data")))
    return lines.select(key.alias("order_key"), F.when(key % 11 == 0, '{"data": {}}').when(key % 13 == 0, '{"data": {"lines": 5}}').otherwise(whole).alias("body"))


_LINE_FIELDS = {"line": ("$.line", "int"), "part_id": ("$.part.id", "bigint"), "flag": ("$.part.flag", "string")}
_DISTINCT = ["company_name", "city"]


def _merged_sketches(spark, sf):
    """Quarters and sources from stored daily sketches, with what the exact figures say about their errors."""
    rows = postings(spark, sf, ["platform", "company_name", "city", "salary_min", "scraped_date"])
    quarter = F.date_trunc("quarter", F.col("day").cast("timestamp_ntz")).cast("string")
    found = sketches.figures(sketches.merged(sketches.daily_sketches(rows, _DISTINCT, "salary_min"), _DISTINCT, quarter, "quarter", ["platform"]), _DISTINCT, [0.5])
    exact = rows.withColumn("quarter", F.date_trunc("quarter", "scraped_date").cast("string"))
    keys = ["quarter", "platform"]
    median = found.select(*keys, F.element_at("quantiles", 1).alias("median"))
    ranks = exact.join(median, keys).groupBy(*keys).agg(
        F.count_distinct("company_name").alias("companies"), F.count_distinct("city").alias("cities"),
        F.count_if(F.col("salary_min") < F.col("median")).alias("below"), F.count_if(F.col("salary_min") <= F.col("median")).alias("upto"),
    )
    half, slack = F.col("n_amount") / 2, F.col("n_amount") * sketches.RANK_ERROR + 1
    return found.join(ranks, keys).select(
        *keys, "n", "n_amount", sketches.within(F.col("about_company_name"), F.col("companies")).alias("companies_within"),
        sketches.within(F.col("about_city"), F.col("cities")).alias("cities_within"),
        ((F.col("below") <= half + slack) & (F.col("upto") >= half - slack)).alias("median_within"),
    )


QUERIES: Registered = {
    "sql_overview": (
        _sql_overview,
        f"""{OVERVIEW} SELECT platform, id, salary_range, location_display, days_since_scraped, days_since_published FROM overview""",
    ),
    "sql_overview_of": (
        _sql_overview_of,
        f"""{OVERVIEW} SELECT location_display, count(*) AS n, max(days_since_scraped) AS oldest, min(salary_range) AS first_range
        FROM overview WHERE platform = 'site_b' GROUP BY location_display""",
    ),
    "links_in_sql": (_links_in_sql, _TEXTS["page_links"][1]),
    "reader_in_sql": (
        _reader_in_sql,
        """WITH e AS (SELECT unnest(regexp_extract_all(html, '(?is)<li>(.*?)</li>', 1)) AS entry FROM pages)
        SELECT regexp_extract(entry, '<a href="([^"]*)"', 1) AS href, count(*) AS n,
               CAST(max(length(trim(regexp_replace(entry, '<[^>]*>', '', 'g')))) AS INTEGER) AS longest,
               count(*) FILTER (NOT contains(entry, '<a')) AS problems FROM e GROUP BY 1""",
    ),
    "variant_fields": (
        lambda spark, sf: raw_pages.variant_fields(_bodies(spark, sf), "body", {"k": ("$.k", "int")})[0].select("event_id", "k"),
        f"""SELECT event_id, CASE WHEN event_id % 47 <> 0 THEN CAST(props->>'$.k' AS INTEGER) END AS k
        FROM events WHERE {_BODY_KIND} IS NULL""",
    ),
    "variant_rejects": (
        lambda spark, sf: raw_pages.variant_fields(_bodies(spark, sf), "body", {"k": ("$.k", "int")})[1].select("event_id", "error"),
        f"SELECT event_id, {_BODY_KIND} AS error FROM events WHERE {_BODY_KIND} IS NOT NULL",
    ),
    "variant_items": (
        lambda spark, sf: raw_pages.variant_fields(_order_bodies(spark, sf), "body", _LINE_FIELDS, "$.data.lines")[0]
        .select("order_key", "item_no", "line", "part_id", "flag"),
        """SELECT l_orderkey AS order_key, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_returnflag) - 1 AS INTEGER) AS item_no,
        CAST(l_linenumber AS INTEGER) AS line, l_partkey AS part_id, l_returnflag AS flag FROM lineitem
        WHERE l_orderkey % 11 <> 0 AND l_orderkey % 13 <> 0""",
    ),
    "merged_sketches": (
        _merged_sketches,
        f"""{POSTINGS} SELECT strftime(date_trunc('quarter', scraped_date), '%Y-%m-%d %H:%M:%S') AS quarter, platform, count(*) AS n,
        count(salary_min) AS n_amount, TRUE AS companies_within, TRUE AS cities_within, TRUE AS median_within
        FROM postings GROUP BY 1, 2""",
    ),
}
