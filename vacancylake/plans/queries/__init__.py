"""Every registered query with the SQL that must give the same rows.

A query is ``(spark, sf_dir) -> DataFrame`` over the given tables. ``None`` as SQL
means another engine cannot state it; such queries are tested on fixtures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
Registered = dict[str, tuple[Query, str | None]]


def registered() -> Registered:
    from vacancylake.plans.queries import analytics, extraction, files, sql_text, storage, streams, texts

    out: Registered = {}
    for module in (analytics, texts, extraction, storage, streams, sql_text, files):
        for name, entry in module.QUERIES.items():
            if name in out:
                raise ValueError(f"query {name} registered twice")
            out[name] = entry
    return out
