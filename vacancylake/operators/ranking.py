"""Top-k, quotas, row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancylake.operators.aggregates import value_counts
from vacancylake.session import cut_lineage

QUOTA_SPREAD = 1024
#: Ranks up to here are cut inside the tasks, before rows are shuffled to their window.
_RANK_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values; equal counts are ordered by value."""
    return value_counts(df, column).orderBy(F.desc("n"), F.asc(column)).limit(k)


def latest(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Newest first, unknown dates at the top, ties by source and id."""
    ordered = df.orderBy(F.desc_nulls_first("scraped_date"), "platform", "id")
    return ordered.limit(limit) if limit else ordered


def quota_per_source(df: DataFrame, source: str, order: list[str], quota: int) -> DataFrame:
    """The first ``quota`` rows of each source in page order; of equal rows any.

    One source may hold most rows, so they are ranked twice: among the rows of its
    source in one of ``QUOTA_SPREAD`` groups of input tasks, then among what is left.
    A row among the first ``quota`` overall is also among the first of its group.
    Groups are of tasks, not of values, so rows that are equal in ``order`` spread as
    well. Spark cuts each task's rows to the quota before they are shuffled; it does
    so up to a threshold of the session, which is raised to the quota where it is less.
    """
    spark = df.sparkSession
    threshold = int(spark.conf.get(_RANK_LIMIT))
    if 0 <= threshold <= quota:
        spark.conf.set(_RANK_LIMIT, str(quota + 1))
    out = df.withColumn("_group", F.spark_partition_id() % QUOTA_SPREAD)
    for group in ([source, "_group"], [source]):
        within = Window.partitionBy(*group).orderBy(*order)
        out = out.withColumn("_rank", F.row_number().over(within)).where(F.col("_rank") <= quota).drop("_rank")
    return out.drop("_group")


def numbered(df: DataFrame, order: list[str | Column], name: str = "row_no") -> DataFrame:
    """Row numbers 1..n over the whole table without a single-task window.

    Rows are range-partitioned and sorted, that layout is fixed by a checkpoint,
    and each partition's start is the sum of the counts before it.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid_out = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    )
    fixed = cut_lineage(laid_out)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        fixed.groupBy("_part")
        .agg(F.count("*").alias("c"))
        .select("_part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("_start"))  # one row per partition
    )
    return fixed.join(starts, "_part").withColumn(name, F.col("_start") + F.col("_at") + 1).drop(
        "_part", "_at", "_start"
    )


def in_batches(df: DataFrame, order: list[str | Column], size: int) -> DataFrame:
    """Number rows in ``order`` and group them in batches of ``size``, counted from 0."""
    return numbered(df, order).withColumn("batch_no", F.floor((F.col("row_no") - 1) / size))
