"""Activity over time windows. The same functions serve batch and streaming frames."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake.functions import dates


def _timed(df: DataFrame, moment: str, delay: str | None) -> tuple[DataFrame, Callable[[Column], Column]]:
    """The frame ready for windows over ``moment``, and how to show its times.

    A stream gets a watermark, which Spark keeps on instants only; a batch stays zone-less.
    """
    if not df.isStreaming:
        return df, lambda column: column
    df = df.withColumn(moment, dates.as_instant(F.col(moment)))
    return (df.withWatermark(moment, delay) if delay else df), dates.from_instant


def activity_windows(
    df: DataFrame, moment: str, by: str, length: str = "24 hours", step: str = "1 hour", delay: str | None = "1 hour"
) -> DataFrame:
    """Count and latest moment per source in sliding windows.

    A row lies in ``length / step`` windows. A batch is first counted per step, so
    only those counts, not the rows, are copied into the windows.
    """
    df, shown = _timed(df, moment, delay)
    count, last = F.count("*"), F.max(moment)
    if not df.isStreaming and pd.Timedelta(length) % pd.Timedelta(step) == pd.Timedelta(0):
        df = (
            df.groupBy(F.window(moment, step).alias("s"), by)
            .agg(count.alias("n"), last.alias("last_seen"))
            .select(F.col("s.start").alias(moment), by, "n", "last_seen")
        )
        count, last = F.sum("n"), F.max("last_seen")
    counted = df.groupBy(F.window(moment, length, step).alias("w"), by).agg(count.alias("n"), last.alias("last_seen"))
    return counted.select(
        shown(F.col("w.start")).alias("window_start"), shown(F.col("w.end")).alias("window_end"), by, "n",
        shown(F.col("last_seen")).alias("last_seen"),
    )


def daily_windows(df: DataFrame, moment: str, delay: str | None = "1 day") -> DataFrame:
    """Count per day."""
    df, shown = _timed(df, moment, delay)
    counted = df.groupBy(F.window(moment, "1 day").alias("w")).agg(F.count("*").alias("n"))
    return counted.select(shown(F.col("w.start")).alias("day"), "n")
