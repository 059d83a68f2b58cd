"""Fetched pages and API bodies as tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacancylake import fixed_values as fixed
from vacancylake import schemas
from vacancylake.functions.links import listing_url


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The raw page table, declared schema, nothing inferred."""
    return spark.read.schema(schemas.RAW_PAGE_DDL).parquet(path)


def read_page_files(spark: SparkSession, path: str, platform: str) -> DataFrame:
    """A folder of saved HTML files, one page per file."""
    return spark.read.text(path, wholetext=True).select(
        F.xxhash64(F.col("_metadata.file_path")).alias("page_id"),
        F.lit(platform).alias("platform"),
        F.col("_metadata.file_path").alias("url"),
        F.lit(None).cast("int").alias("page_no"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("fetched_at"),
        F.lit(200).alias("status"),
        F.col("value").alias("html"),
    )


def split_by_status(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages answered with 200, and the others with an error text."""
    good = pages.where(F.col("status") == 200)
    bad = pages.where(F.coalesce(F.col("status"), F.lit(0)) != 200).drop("html")
    return good, bad.withColumn("error", F.concat(F.lit("HTTP "), F.coalesce(F.col("status"), F.lit(0))))


def page_manifest(
    spark: SparkSession, platforms: list[str], last_page: int, **filters: str | bool | None
) -> DataFrame:
    """The listing addresses of pages 1..``last_page`` of each source."""
    plan = spark.createDataFrame([(p,) for p in platforms], "platform string").select(
        "platform", F.explode(F.sequence(F.lit(1), F.lit(last_page))).alias("page_no")
    )
    return plan.withColumn("url", listing_url(
        F.col("platform"), F.col("page_no"), **{k: F.lit(v) for k, v in filters.items() if v is not None}
    ))


@dataclass(frozen=True)
class CrawlConfig:
    """What a crawl asks its sources for, and where it ends.

    The filters are those that listing addresses carry; sources whose addresses carry none are asked without. ``page_limits``
    is the last page by source (None: no limit); sources that are not named have no limit. A source ends before its first page
    without a listing, and before its first page that failed.
    """

    category_id: str | None = None
    location_id: str | None = None
    query: str | None = None
    has_salary: bool = False
    locale: str | None = None
    page_limits: Mapping[str, int | None] = field(default_factory=lambda: dict(fixed.MAX_PAGES))
    stop_at_empty: bool = True
    stop_at_failed: bool = True

    @property
    def filters(self) -> dict[str, str | bool]:
        named = {"category_id": self.category_id, "location_id": self.location_id, "query": self.query, "locale": self.locale}
        return {k: v for k, v in named.items() if v is not None} | ({"has_salary": True} if self.has_salary else {})


def asked_pages(pages: DataFrame, config: CrawlConfig) -> DataFrame:
    """The pages that a crawl under ``config`` asks for: those at its listing addresses, up to the page limits."""
    address = listing_url(F.col("platform"), F.col("page_no"), **{k: F.lit(v) for k, v in config.filters.items()})
    limits = {p: n for p, n in config.page_limits.items() if n is not None}
    within = F.lit(True)
    for platform, last in limits.items():
        within &= (F.col("platform") != platform) | (F.col("page_no") <= last)
    return pages.where((F.col("url") == address) & within)


def crawl_ends(pages: DataFrame, config: CrawlConfig) -> DataFrame:
    """(platform, stop): the first page that ends each source's crawl; ``pages`` has platform, page_no, status, n_rows."""
    failed = F.coalesce(F.col("status"), F.lit(0)) != 200
    ends = (failed & F.lit(config.stop_at_failed)) | (~failed & (F.col("n_rows") == 0) & F.lit(config.stop_at_empty))
    return pages.where(ends).groupBy("platform").agg(F.min("page_no").alias("stop"))


def page_frontier(
    pages: DataFrame, source: str = "platform", page: str = "page_no", rows: str = "n_rows",
    max_page: int | None = None,
) -> DataFrame:
    """Pages a crawl would have read: those before the first empty page of their source."""
    if max_page is not None:
        pages = pages.where(F.col(page) <= max_page)
    stops = pages.where(F.col(rows) == 0).groupBy(source).agg(F.min(page).alias("_stop"))
    return pages.join(stops, source, "left").where(
        F.col("_stop").isNull() | (F.col(page) < F.col("_stop"))
    ).drop("_stop")


def _one_value(column: str) -> tuple[Column, Column]:
    """The body as VARIANT, and whether it is one JSON value.

    It is read as the only element of an array, so text after the value counts as an error instead of being ignored.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), F.col(column), F.lit("]")))
    body = F.try_variant_get(wrapped, "$[0]", "variant")
    more = F.try_variant_get(wrapped, "$[1]", "variant").isNotNull()
    return body, F.coalesce(body.isNotNull() & ~more, F.lit(False))


def parse_bodies(bodies: DataFrame, column: str, schema: str | T.StructType) -> tuple[DataFrame, DataFrame]:
    """JSON bodies to columns of a declared schema; bodies that are not one JSON value go to the rejects."""
    parsed = bodies.withColumn("_ok", _one_value(column)[1])
    good = parsed.where("_ok").drop("_ok").withColumn("body", F.from_json(column, schema))
    bad = parsed.where(~F.col("_ok")).drop("_ok").withColumn("error", F.lit("not JSON"))
    return good, bad


def variant_fields(
    bodies: DataFrame, column: str, fields: dict[str, tuple[str, str]], items: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """JSON bodies of any shape to columns, by path: ``fields`` is name -> (path, type).

    The body is parsed once, as VARIANT. ``items`` is the path of a list, whose entries become rows (``item_no`` from 0; paths of
    fields then start there); bodies without such a list, or with an empty one, give no rows. A missing or null field is NULL.
    Rejects carry the reason: bodies that are not one JSON value, bodies whose ``items`` is something else than a list, and
    bodies in which a field is there but not of its type (all its rows go, none is half read).
    """
    body, whole = _one_value(column)
    parsed = bodies.select("*", body.alias("_body"), whole.alias("_ok"))
    start = F.col("_body")
    if items is not None:
        listed = F.try_variant_get(start, items, "array<variant>")
        there = F.try_variant_get(start, items, "variant")
        entries = F.coalesce(listed, F.array().cast("array<variant>"))
        wrong_list = there.isNotNull() & ~F.is_variant_null(there) & listed.isNull()
    else:
        entries, wrong_list = F.array(start), F.lit(False)

    def misread(entry: Column) -> Column:
        wrong = F.lit(False)
        for path, kind in fields.values():
            there = F.try_variant_get(entry, path, "variant")
            wrong |= there.isNotNull() & ~F.is_variant_null(there) & F.try_variant_get(entry, path, kind).isNull()
        return wrong

    error = (
        F.when(~F.col("_ok"), "not JSON")
        .when(wrong_list, f"{items} is not a list")
        .when(F.exists(entries, misread), "a field is not of its type")
    )
    checked = parsed.withColumns({"_entries": entries, "_error": error})
    rows = checked.where(F.col("_error").isNull()).select("*", F.posexplode("_entries").alias("item_no", "_entry"))
    values = {name: F.try_variant_get("_entry", path, kind) for name, (path, kind) in fields.items()}
    good = rows.select(*bodies.columns, *(["item_no"] if items is not None else []), *[v.alias(n) for n, v in values.items()])
    bad = checked.where(F.col("_error").isNotNull()).select(*bodies.columns, F.col("_error").alias("error"))
    return good, bad
