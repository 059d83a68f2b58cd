"""Category and region codes per source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vacancylake import fixed_values as fixed


def _codes(spark: SparkSession, per_platform: dict[str, dict[str, str]]) -> DataFrame:
    rows = [(p, name, code) for p, codes in per_platform.items() for name, code in codes.items()]
    return spark.createDataFrame(rows, "platform string, name string, code string")


def categories(spark: SparkSession) -> DataFrame:
    return _codes(spark, fixed.CATEGORY_CODES)


def locations(spark: SparkSession) -> DataFrame:
    return _codes(spark, fixed.LOCATION_CODES)
