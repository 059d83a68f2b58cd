"""Pages or ready rows arriving as files, written to a posting log batch by batch."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vacancylake import schemas
from vacancylake.functions import dates
from vacancylake.operators import extract
from vacancylake.operators.projections import flatten_listing
from vacancylake.operators.quality import row_rules, split_by_rules
from vacancylake.session import stored
from vacancylake.sources.raw_pages import split_by_status
from vacancylake.streaming.log import PostingLog


def page_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(schemas.RAW_PAGE_DDL).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


def seen_once(stream: DataFrame, key: list[str], moment: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within ``delay``; state older than that is forgotten."""
    timed = stream.withColumn(moment, dates.as_instant(F.col(moment)))
    once = timed.withWatermark(moment, delay).dropDuplicatesWithinWatermark(key)
    return once.withColumn(moment, dates.from_instant(F.col(moment)))


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that owns ``checkpoint``; it is there before the first batch."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def write_batches(
    stream: DataFrame,
    log: PostingLog,
    checkpoint: str,
    as_of: str | dt.datetime,
    order: list[str],
    prepare: Callable[[DataFrame], DataFrame | tuple[DataFrame, DataFrame]] = lambda batch: batch,
    compact_every: int = 100,
) -> StreamingQuery:
    """Read all that is there now, in batches, and append each to the log, which is compacted every so many batches.

    A batch that is run again after a lost executor overwrites its own folder. The
    run is the streaming query's own id, which its checkpoint keeps: a new
    checkpoint over an old log starts a new run and overwrites nothing. ``prepare``
    gives the writes of a batch, or the writes and what is left out of them.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        run = checkpoint_id(log.spark, checkpoint)
        ready = prepare(batch)
        writes, rejects = ready if isinstance(ready, tuple) else (ready, None)
        log.append(writes, batch_id, as_of, order, run)
        if rejects is not None:
            log.append_rejects(rejects, batch_id, run)
        if batch_id % compact_every == compact_every - 1:
            log.compact_beyond(compact_every - 1)

    return (
        stream.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def sorted_out(pages: DataFrame, as_of: str | dt.datetime, tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid flat listings with their page order, and everything left out with the reason; pages are parsed once.

    ``tasks`` deals the pages to so many tasks before they are parsed, for batches of fewer files than there are cores.
    """
    good, failed = split_by_status(pages)
    if tasks is not None:
        good = good.repartition(tasks)
    rows = stored(extract.extract_listings(good, as_of), "stream-rows")
    flat = flatten_listing(extract.accepted(rows), as_of, keep=["page_id", "row_no"])
    valid, broken = split_by_rules(flat, row_rules("job_listings"))
    rejects = (
        failed.select("page_id", "platform", F.lit(None).cast("int").alias("row_no"), F.col("error").alias("problem"))
        .unionByName(extract.rejects(rows))
        .unionByName(broken.select("page_id", "platform", "row_no", F.array_join("broken_rules", ", ").alias("problem")))
    )
    return valid, rejects


def listing_log(spark: SparkSession, path: str) -> PostingLog:
    kinds = {n: k for n, k, *_ in schemas.TABLES["job_listings"] if n not in ("created_at", "updated_at")}
    return PostingLog(spark, path, kinds)


def ingest_pages(
    spark: SparkSession, pages_path: str, log_path: str, checkpoint: str, as_of: str | dt.datetime,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Page files to the listing log; what is left out goes to the log's rejects.

    Where a batch has fewer files than the cluster has cores, its pages are dealt to all of them: parsing is the heavy part.
    """
    cores = spark.sparkContext.defaultParallelism
    tasks = 2 * cores if files_per_batch < cores else None
    return write_batches(
        page_stream(spark, pages_path, files_per_batch), listing_log(spark, log_path), checkpoint, as_of,
        ["page_id", "row_no"], lambda batch: sorted_out(batch, as_of, tasks),
    )
