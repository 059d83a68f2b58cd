"""Files for other tools. Every export is a folder written by all tasks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def export_path(folder: str, prefix: str, kind: str, as_of: dt.datetime) -> str:
    return f"{folder}/{prefix}_{as_of:%Y%m%d_%H%M%S}.{kind}"


#: Quotes inside values are doubled, and values keep the blanks and line breaks at their ends.
CSV_OPTIONS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def export_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """What ``export_csv`` wrote, line breaks in values included."""
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=True).csv(path)


def export_json(df: DataFrame, path: str, epoch_ms: bool = False, mode: str = "errorifexists") -> None:
    """JSON lines; times as ISO text, or as milliseconds with ``epoch_ms``."""
    if epoch_ms:
        zero = F.lit("1970-01-01").cast("timestamp_ntz")
        stamps = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
        df = df.withColumns({c: F.timestamp_diff("MILLISECOND", zero, F.col(c)) for c in stamps})
    df.write.mode(mode).option("ignoreNullFields", False).option(
        "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss").json(path)


def export_xml(df: DataFrame, path: str, row: str = "job", mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("rowTag", row).option("rootTag", row + "s").xml(path)


def export_parquet(
    df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "errorifexists"
) -> None:
    df.write.mode(mode).partitionBy(*(partition_by or [])).parquet(path)


def write_table(
    df: DataFrame, path: str, partition_by: str = "platform", sort_by: list[str] | None = None,
    parts: int | None = None, mode: str = "errorifexists",
) -> None:
    """A stored table: one folder per source, files cut and sorted by date.

    Rows are split by range over (source, date, id), not by source, so a source
    with most of the rows is written by many tasks, and each file covers a short
    span of dates that scans can skip.
    """
    order = [partition_by, *(sort_by or ["scraped_date", "id"])]
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid_out = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    laid_out.write.mode(mode).partitionBy(partition_by).parquet(path)


def export(df: DataFrame, kind: str, path: str, **options) -> None:
    writers = {"csv": export_csv, "json": export_json, "xml": export_xml, "parquet": export_parquet}
    if kind not in writers:
        raise ValueError(f"unknown format {kind!r}: one of {', '.join(writers)}")
    writers[kind](df, path, **options)


def write_counted(df: DataFrame, kind: str, path: str, problem: str | None = None, **options) -> dict[str, int]:
    """Export and return the row counts seen on the way, without a second pass."""
    seen = Observation("written")
    failed = F.count_if(F.col(problem).isNotNull()) if problem else F.lit(0).cast("bigint")
    failed = failed if problem else F.sum(failed)
    watched = df.observe(seen, F.count("*").alias("total"), failed.alias("failed"))
    export(watched, kind, path, **options)
    counts = seen.get
    return {"total": counts["total"], "failed": counts["failed"] or 0}


def write_report_tables(tables: dict[str, DataFrame], folder: str, kind: str = "parquet") -> None:
    for name, df in tables.items():
        export(df, kind, f"{folder}/{name}", mode="overwrite")
