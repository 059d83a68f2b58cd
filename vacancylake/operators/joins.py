"""Joins between listings, details and code tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_DETAIL = "no detail page"


def with_details(
    listings: DataFrame, details: DataFrame, key: list[str], shared: list[str] | None = None
) -> DataFrame:
    """Each listing with its detail; a listing without one gets an error text.

    Both sides hold one row per key, so the shuffle on the full key is even. With
    repeated listings adaptive execution splits a hot key's partition.
    """
    renamed = details.withColumnsRenamed({c: f"detail_{c}" for c in shared or []}).withColumn("_found", F.lit(True))
    return (
        listings.where(F.coalesce(F.col(key[-1]).cast("string"), F.lit("")) != "")
        .join(renamed, key, "left")
        .withColumn("error", F.when(F.col("_found").isNull(), F.lit(NO_DETAIL)))
        .drop("_found")
    )


def lookup_code(df: DataFrame, codes: DataFrame, on: list[str], code: str = "code") -> DataFrame:
    """Add the code of a name; unknown names get ''. Adaptive execution broadcasts the codes where their bytes allow it."""
    return df.join(codes.select(*on, code), on, "left").withColumn(code, F.coalesce(code, F.lit("")))
