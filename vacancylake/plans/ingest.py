"""Whole jobs: pages to listings, listings to details, pages to a feed."""

from __future__ import annotations

import datetime as dt
import operator
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake import schemas
from vacancylake.functions import dates
from vacancylake.operators import aggregates, children, extract, filters, joins, projections, quality, ranking, upsert
from vacancylake.operators.layouts import LISTING_LAYOUTS
from vacancylake.session import stored
from vacancylake.sources.raw_pages import CrawlConfig, asked_pages, crawl_ends, split_by_status


@dataclass
class IngestResult:
    """Frames over one stored extraction: pages are parsed once, however many frames are written."""

    table: DataFrame
    found: DataFrame  # the valid rows of this run, before they are folded into the table
    rejects: DataFrame
    children: dict[str, DataFrame] = field(default_factory=dict)


def ingest_listings(
    pages: DataFrame,
    current: DataFrame,
    as_of: str | dt.datetime,
    quota: int | None = None,
    location: str | None = None,
    query: str | None = None,
    has_salary: bool = False,
    key: list[str] | None = None,
    layouts: dict[str, extract.Reader] = LISTING_LAYOUTS,
    crawl: CrawlConfig | None = None,
    category: str | None = None,
    bucketed: bool = False,
) -> IngestResult:
    """Pages (schema ``RAW_PAGE_DDL``) written over ``current``.

    ``crawl`` takes only the pages that a crawl of that configuration reads: those at its addresses, within its page limits, before
    each source's first empty or failed page (a failed page that ends a source is among the rejects, what lies behind it is not
    part of the run). The other conditions are on the listings themselves.

    Within this run the first listing of a key, in page order, is the one that
    counts; against the stored table the upsert rule applies. ``bucketed`` says that ``current`` is a table in buckets of the key
    (``sinks.bucketed``): it is then read bucket by bucket, and the result lies in the same buckets.
    """
    pages = pages if crawl is None else asked_pages(pages, crawl)
    good, failed = split_by_status(pages)
    keep = ["page_no"] if "page_no" in pages.columns else []
    rows = stored(extract.extract_listings(good, as_of, layouts, keep=keep), "listing-rows")
    rows = rows.withColumns({c: F.col(c).cast("int") for c in keep})
    if crawl is not None:
        rows, failed = _before_the_end(pages, rows, failed, crawl)
    order = [*keep, "page_id", "row_no"]
    flat = projections.flatten_listing(extract.accepted(rows), as_of, keep=order)
    wanted = filters.filtered(flat, location=location, query=query, has_salary=has_salary, category=category)
    if quota is not None:
        wanted = ranking.quota_per_source(wanted, "platform", order, quota)
    valid, broken = quality.split_by_rules(wanted, quality.row_rules("job_listings"))
    write = upsert.upsert_bucketed if bucketed else upsert.upsert
    table = write(current, valid, as_of, order, key)
    rejects = (
        extract.rejects(rows)
        .unionByName(failed.select("page_id", "platform", F.lit(None).cast("int").alias("row_no"),
                                   F.col("error").alias("problem")))
        .unionByName(broken.select("page_id", "platform", "row_no",
                                   F.array_join("broken_rules", ", ").alias("problem")))
    )
    return IngestResult(table, valid, rejects)


def _before_the_end(pages: DataFrame, rows: DataFrame, failed: DataFrame, crawl: CrawlConfig) -> tuple[DataFrame, DataFrame]:
    """The rows of pages before each source's end, and the failed pages up to it."""
    found = rows.groupBy("page_id").agg(F.count_if(F.col("problem").isNull()).alias("n_rows"))
    read = pages.select("page_id", "platform", "page_no", "status").join(found, "page_id", "left")
    ends = crawl_ends(read.withColumn("n_rows", F.coalesce("n_rows", F.lit(0))), crawl)  # a row per source
    ends = ends.withColumnRenamed("platform", "ended")

    def kept(df: DataFrame, inside: Column) -> DataFrame:
        return df.join(ends, df["platform"] == ends["ended"], "left").where(F.col("stop").isNull() | inside).drop("ended", "stop")

    return kept(rows, F.col("page_no") < F.col("stop")), kept(failed, F.col("page_no") <= F.col("stop"))


REPEATED_PAGE = "another page of this posting was taken"


def ingest_details(
    listings: DataFrame, detail_pages: DataFrame, current: DataFrame, as_of: str | dt.datetime, mode: str = "last",
    current_children: dict[str, DataFrame] | None = None, bucketed: bool = False,
) -> IngestResult:
    """Detail pages of the given listings: parent rows and child tables.

    ``detail_pages`` carries ``id`` and ``platform`` next to ``page_id, html``, and
    may carry ``status`` and ``fetched_at``. Of several readable pages of a posting
    the one fetched last counts (by page id where times are equal or missing). A
    detail is saved with all its children or not at all: one that breaks a rule
    itself, or has a child that does, goes to the rejects, as do pages that failed,
    pages without content, pages not taken and listings without a page. Given the
    stored children, the result's children are the tables after the save. ``bucketed`` as for listings.
    """
    time = F.col("fetched_at") if "fetched_at" in detail_pages.columns else F.lit(None).cast("timestamp_ntz")
    status = F.col("status") if "status" in detail_pages.columns else F.lit(200)
    timed = detail_pages.withColumns({"status": status, "fetched_at": time})
    good_pages, failed = split_by_status(timed)
    fields = stored(extract.extract_details(good_pages, mode, keep=["id"]), "detail-fields")
    turn = F.struct(F.col("problem").isNull(), "fetched_at", "page_id")
    taken = (
        fields.select("platform", "id", "page_id", "problem").join(good_pages.select("page_id", "fetched_at"), "page_id")
        .groupBy("platform", "id").agg(F.max_by("page_id", turn).alias("page_id"))  # page ids alone, not the texts
    )
    page_key = ["platform", "id", "page_id"]
    repeated = fields.join(taken, page_key, "left_anti")
    errors = failed.groupBy("platform", "id").agg(F.max_by("error", F.struct("fetched_at", "page_id")).alias("failure"))
    both = joins.with_details(
        listings.select("platform", "id", "title", "url"), fields.join(taken, page_key, "left_semi"),
        ["platform", "id"], shared=["title"],
    ).join(errors, ["platform", "id"], "left")
    # A page that failed says more than that there is none.
    missing = F.when(F.col("error") == joins.NO_DETAIL, F.coalesce("failure", "error")).otherwise(F.col("error"))
    # Four tables, their children and the rejects are read from these rows.
    both = stored(both.withColumn("error", F.coalesce("problem", missing)).drop("failure"), "detail-rows")
    good, bad = filters.split_rejects(both)
    details = extract.details_from_fields(good, as_of)
    child_tables = {
        name: children.child_rows(details, values, value, as_of)
        for name, (values, value) in children.CHILD_LISTS.items()
    }
    child_tables["job_contacts"] = children.contact_rows(details, as_of)
    flat = projections.flatten_detail(details, as_of)
    valid, broken = quality.split_by_rules(flat, quality.row_rules("job_details"))
    key = list(children.PARENT_KEY.values())
    named = valid.withColumnsRenamed(children.PARENT_KEY)
    checked = [
        (rows, reduce(operator.or_, (c for r, c in quality.row_rules(name).items())))
        for name, rows in child_tables.items()
    ]
    whole, unsound = (df.withColumnsRenamed({new: old for old, new in children.PARENT_KEY.items()})
                      for df in children.accept_whole(named, checked, key))
    write = upsert.upsert_bucketed if bucketed else upsert.upsert
    table = write(current, whole.withColumn("_order", F.lit(0)), as_of, ["_order"], last_wins=upsert.DETAIL_LAST_WINS)
    saved = whole.select(*[F.col(old).alias(new) for old, new in children.PARENT_KEY.items()])
    child_tables = {name: rows.join(saved, key, "left_semi") for name, rows in child_tables.items()}
    for name, before in (current_children or {}).items():
        child_tables[name] = children.replace_children(before, child_tables[name], saved, key)
    rejects = bad.select("platform", "id", "url", F.col("error").alias("problem"))
    for left, problem in (
        (broken, F.array_join("broken_rules", ", ")), (unsound, F.lit("a child row breaks a rule")),
        (repeated.withColumn("url", F.lit(None).cast("string")), F.coalesce("problem", F.lit(REPEATED_PAGE))),
    ):
        rejects = rejects.unionByName(left.select("platform", "id", "url", problem.alias("problem")))
    return IngestResult(table, whole, rejects, child_tables)


def crawl_feed(pages: DataFrame, as_of: str | dt.datetime) -> IngestResult:
    """Pages to validated flat feed items; whatever is left out goes to the rejects with its reason."""
    good, failed = split_by_status(pages)
    rows = stored(extract.extract_listings(good, as_of), "feed-rows")
    items = projections.crawler_items(extract.accepted(rows), keep=["page_id", "row_no"])
    accepted, rejected = filters.validate_items(items, as_of)
    rejects = (
        extract.rejects(rows)
        .unionByName(failed.select("page_id", "platform", F.lit(None).cast("int").alias("row_no"), F.col("error").alias("problem")))
        .unionByName(rejected.select("page_id", "platform", "row_no", F.col("reason").alias("problem")))
    )
    accepted = accepted.drop("page_id", "row_no")
    return IngestResult(accepted, accepted, rejects)


def empty_table(spark, name: str) -> DataFrame:
    return spark.createDataFrame([], schemas.ddl(name))


def run_log(
    result: IngestResult, started: str | dt.datetime, ended: str | dt.datetime
) -> tuple[DataFrame, DataFrame]:
    """Rows of the run table (one per source) and of the run error table (one per reject)."""
    seen = result.found.select("platform", F.lit(None).cast("string").alias("error")).unionByName(
        result.rejects.select("platform", F.col("problem").alias("error")))
    seen = seen.withColumns({"started": dates.moment(started), "ended": dates.moment(ended)})
    runs = run_record(aggregates.run_summary(seen, "platform", "error", "started", "ended"), ended)
    problems = result.rejects.where(F.col("problem").isNotNull()).select("platform", "problem")
    errors = problems.join(runs.select("platform", F.col("id").alias("scraping_result_id")), "platform")
    return runs, errors.select(
        "scraping_result_id", F.col("problem").alias("error_message"), dates.moment(ended).alias("created_at"))


def run_record(results: DataFrame, as_of: str | dt.datetime) -> DataFrame:
    """Run summaries (from ``aggregates.run_summary`` by platform) as rows of the run table."""
    return results.select(
        F.sha2(F.concat_ws("|", "platform", "start_time", F.lit(str(as_of))), 256).alias("id"),
        "platform",
        F.col("total_found").alias("total_jobs_found"),
        F.col("succeeded").alias("successful_scrapes"),
        F.col("failed").alias("failed_scrapes"),
        "start_time", "end_time",
        dates.moment(as_of).alias("created_at"),
    )
