"""Counters of every batch of a stream, kept by a query listener.

``counted`` lets Spark add up totals while a batch runs, without a second pass. When the batch is done, ``BatchCounters`` writes
them to a small file named by the streaming query's id and the batch's number: a batch that runs again after a failure replaces its
file, so the counters of all files are those of the stream, over restarts too. Events come after the batch is done; a driver that is
lost in between leaves a batch without a file, which ``uncounted`` names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

NAME = "batch_counters"
COUNTER_DDL = "run string, batch bigint, total bigint, failed bigint, finished string"


def counted(stream: DataFrame, failed: Column | None = None) -> DataFrame:
    """``stream`` with its rows, and those that ``failed``, counted on the way."""
    bad = F.lit(0).cast("bigint") if failed is None else F.when(failed, 1).otherwise(0).cast("bigint")
    return stream.observe(NAME, F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(bad), F.lit(0)).alias("failed"))


class BatchCounters(StreamingQueryListener):
    """Writes the counters of all queries of the session that are ``counted`` under ``path``, which all drivers see."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(NAME)
        if seen is None or not progress.numInputRows:
            return  # a batch without rows has nothing to count
        row = {"run": str(progress.id), "batch": progress.batchId, "total": seen["total"], "failed": seen["failed"], "finished": progress.timestamp}
        self._write(f"{self.path}/run={progress.id}/batch={progress.batchId}.json", json.dumps(row))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def _write(self, name: str, text: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(name)
        out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()


def wait_for_listeners(spark: SparkSession, seconds: int = 60) -> None:
    """Until all events so far are delivered."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(seconds * 1000)


def counters(spark: SparkSession, path: str) -> DataFrame:
    """One row per run and batch."""
    return spark.read.schema(COUNTER_DDL).option("recursiveFileLookup", True).option("pathGlobFilter", "batch=*.json").json(path)


def totals(counters: DataFrame) -> DataFrame:
    """One row per run: batches, total, failed."""
    return counters.groupBy("run").agg(F.count("*").alias("batches"), F.sum("total").alias("total"), F.sum("failed").alias("failed"))


def uncounted(batches: DataFrame, counters: DataFrame) -> DataFrame:
    """The (run, batch) rows of ``batches`` that have no counters."""
    return batches.select("run", "batch").distinct().join(counters.select("run", "batch"), ["run", "batch"], "left_anti")
