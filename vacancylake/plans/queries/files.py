"""Queries that write files or tables, read them back and show what came out."""

from __future__ import annotations

import datetime as dt
from uuid import uuid4

from pyspark.sql import functions as F

from vacancylake import schemas
from vacancylake.operators import distributions
from vacancylake.plans import ingest, report
from vacancylake.plans.overview import overview
from vacancylake.plans.queries import Registered
from vacancylake.plans.queries.analytics import OVERVIEW, POSTINGS
from vacancylake.plans.queries.extraction import _LISTINGS_SQL, listing_pages
from vacancylake.session import new_shared_path
from vacancylake.sinks import exports
from vacancylake.sources import catalog
from vacancylake.sources.driver_tables import AS_OF, postings, table

_COLUMNS = ["platform", "id", "title", "city", "salary_min", "published_date", "is_remote"]
_ROWS_SQL = f"{POSTINGS} SELECT platform, id, title, city, CAST(salary_min AS DOUBLE) AS salary_min, published_date, is_remote FROM postings"
_STAMP = dt.datetime.fromisoformat(AS_OF)


def _written(spark, label, kind):
    return exports.export_path(new_shared_path(spark, label), "jobs", kind, _STAMP)


def _csv(spark, sf):
    """Quotes, separators, line breaks and missing values through a CSV export."""
    rows = postings(spark, sf, _COLUMNS).withColumn("title", F.concat("title", F.lit(', "x"\n')))
    path = _written(spark, "export-csv", "csv")
    exports.export_csv(rows, path)
    back = exports.read_csv(spark, path, rows.schema)
    return back.withColumns({"salary_min": F.col("salary_min").cast("double"), "title": F.regexp_replace("title", r', "x"\n$', "")})


def _json(spark, sf):
    """JSON lines with times as milliseconds; the moments come back from them."""
    rows = postings(spark, sf, _COLUMNS)
    path = _written(spark, "export-json", "json")
    exports.export_json(rows, path, epoch_ms=True)
    back = spark.read.schema("platform string, id string, title string, city string, salary_min decimal(10,2), published_date bigint, is_remote boolean").json(path)
    zero = F.lit("1970-01-01").cast("timestamp_ntz")
    return back.withColumns({
        "published_date": F.timestamp_add("MILLISECOND", F.col("published_date"), zero), "salary_min": F.col("salary_min").cast("double")})


def _feed(kind):
    def run(spark, sf):
        items = ingest.crawl_feed(listing_pages(spark, sf).withColumn("status", F.lit(200)), AS_OF).table
        items = items.select("platform", "id", "title", "url", F.col("published_date").cast("string").alias("published"))
        path = _written(spark, f"feed-{kind}", kind)
        exports.export(items, kind, path)
        reader = spark.read.schema(items.schema)
        return reader.option("rowTag", "job").xml(path) if kind == "xml" else reader.json(path)

    return run


_FEED_SQL = f"""WITH l AS ({_LISTINGS_SQL}) SELECT platform, id, title, url,
strftime(published, '%Y-%m-%d %H:%M:%S') AS published FROM l"""


def _counted(spark, sf):
    """Counts that an export saw on the way, beside those of its files."""
    rows = table(spark, sf, "events").select("event_id", F.when(F.col("event_type") == "error", F.col("props")).alias("problem"))
    path = _written(spark, "counted", "parquet")
    seen = exports.write_counted(rows, "parquet", path, "problem")
    return spark.read.parquet(path).agg(F.count("*").alias("in_files"), F.count("problem").alias("failed_in_files")).select(
        F.lit(seen["total"]).alias("total"), F.lit(seen["failed"]).alias("failed"), "in_files", "failed_in_files")


def _tables(spark, sf):
    """The stored tables created, one filled, listed and counted; then dropped."""
    database = f"made_{uuid4().hex}"
    home = new_shared_path(spark, "made-tables")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{home}/database'")
    try:
        schemas.create_tables(spark, database, f"{home}/tables")
        schemas.create_tables(spark, database, f"{home}/tables")  # again: nothing changes
        rows = postings(spark, sf)
        kinds = {name: kind for name, kind, *_ in schemas.TABLES["job_listings"]}
        full = rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()])
        full.write.insertInto(f"{database}.job_listings")
        counts = {r["table_name"]: spark.table(f"{database}.{r['table_name']}").count() for r in catalog.list_tables(spark, database).collect()}
        schemas.drop_tables(spark, database, confirm=True)
        left = catalog.list_tables(spark, database).count()
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.createDataFrame([(name, n, left) for name, n in counts.items()], "table_name string, n long, left_after long")


def _tables_sql():
    names = ", ".join(f"('{n}')" for n in schemas.TABLES)
    return f"""SELECT table_name, CASE WHEN table_name = 'job_listings' THEN (SELECT count(*) FROM orders) ELSE 0 END AS n, 0 AS left_after
    FROM (VALUES {names}) AS t(table_name)"""


def _report_files(spark, sf):
    """The report tables written as files: recent postings and statistics per source, from the files."""
    folder = new_shared_path(spark, "report")
    exports.write_report_tables(report.data_tables(overview(postings(spark, sf), AS_OF)), folder)
    recent = spark.read.parquet(f"{folder}/recent_postings").groupBy("platform").agg(F.count("*").alias("among_newest"))
    return spark.read.parquet(f"{folder}/platform_stats").join(recent, "platform", "left").select(
        "platform", "total_jobs", F.coalesce("among_newest", F.lit(0)).alias("among_newest"))


def _empty_reports(spark, sf):
    """Distributions and counts over postings of a source that is not there: no rows, and no failure."""
    none = postings(spark, sf, ["platform", "salary_min", "city"]).where("platform = 'nowhere'")
    found = {
        "histogram": distributions.histogram(none, "salary_min"), "density": distributions.density_curve(none, "salary_min"),
        "box": distributions.box_stats(none), "outliers": distributions.box_outliers(none),
    }
    out = None
    for name, df in found.items():
        one = df.agg(F.lit(name).alias("report"), F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


QUERIES: Registered = {
    "export_csv": (_csv, _ROWS_SQL),
    "export_json": (_json, _ROWS_SQL),
    "feed_json": (_feed("json"), _FEED_SQL),
    "feed_xml": (_feed("xml"), _FEED_SQL),
    "write_counts": (
        _counted,
        """SELECT count(*) AS total, count(*) FILTER (event_type = 'error') AS failed, count(*) AS in_files,
        count(*) FILTER (event_type = 'error') AS failed_in_files FROM events""",
    ),
    "made_tables": (_tables, _tables_sql()),
    "report_files": (
        _report_files,
        f"""{OVERVIEW}, r AS (SELECT platform FROM overview ORDER BY scraped_date DESC NULLS FIRST, platform, id LIMIT 10)
        SELECT platform, count(*) AS total_jobs, (SELECT count(*) FROM r WHERE r.platform = o.platform) AS among_newest
        FROM overview o GROUP BY platform""",
    ),
    "empty_reports": (
        _empty_reports,
        f"""{POSTINGS}, none AS (SELECT count(*) AS n FROM postings WHERE platform = 'nowhere')
        SELECT report, n FROM none, (VALUES ('histogram'), ('density'), ('box'), ('outliers')) AS t(report)""",
    ),
}
