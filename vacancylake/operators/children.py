"""Child tables of a detail record, and parent/child integrity."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake.functions import dates
from vacancylake.functions.text import strip

CHILD_LISTS = {
    "job_requirements": ("requirements", "requirement"),
    "job_responsibilities": ("responsibilities", "responsibility"),
    "job_benefits": ("benefits", "benefit"),
    "job_skills": ("skills", "skill"),
}
PARENT_KEY = {"platform": "platform", "id": "job_id"}


def _keys(parent_key: dict[str, str]) -> list[Column]:
    return [F.col(old).alias(new) for old, new in parent_key.items()]


def child_rows(
    parents: DataFrame, values: str, value: str, as_of: str | dt.datetime, parent_key: dict[str, str] | None = None
) -> DataFrame:
    """One row per non-blank list entry, trimmed, in list order."""
    keys = list((parent_key or PARENT_KEY).values())
    return (
        parents.select(*_keys(parent_key or PARENT_KEY), F.posexplode(values).alias("position", value))
        .withColumn(value, strip(F.col(value)))
        .where(F.col(value) != "")
        .select(*keys, "position", value, dates.moment(as_of).alias("created_at"))
    )


def contact_rows(
    parents: DataFrame, as_of: str | dt.datetime, contacts: str = "contact_info",
    parent_key: dict[str, str] | None = None,
) -> DataFrame:
    """One row per non-blank ``(type, value)`` of the contact map."""
    keys = list((parent_key or PARENT_KEY).values())
    return (
        parents.select(*_keys(parent_key or PARENT_KEY), F.explode(contacts).alias("contact_type", "contact_value"))
        .withColumn("contact_value", strip(F.col("contact_value")))
        .where(F.col("contact_value") != "")
        .select(*keys, "contact_type", "contact_value", dates.moment(as_of).alias("created_at"))
    )


def error_rows(runs: DataFrame, as_of: str | dt.datetime, errors: str = "errors") -> DataFrame:
    """One row per non-blank error message of a run."""
    return child_rows(runs, errors, "error_message", as_of, {"id": "scraping_result_id"}).drop("position")


def replace_children(stored: DataFrame, fresh: DataFrame, parents: DataFrame, key: list[str]) -> DataFrame:
    """Children after saving ``parents`` again: theirs are replaced, others stay.

    ``parents`` carries the key columns under the child table's names.
    """
    kept = stored.join(parents.select(*key).distinct(), key, "left_anti")
    return kept.unionByName(fresh.select(*stored.columns))


def accept_whole(
    parents: DataFrame, children: list[tuple[DataFrame, Column]], key: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Parents all of whose children are valid, and the rest.

    Each child frame comes with its violation condition. Bad keys are reduced to
    one row per key before the join, so a parent with very many bad children
    weighs no more than any other.
    """
    bad = [c.where(violation).select(*key).distinct() for c, violation in children]
    bad_keys = reduce(lambda a, b: a.unionByName(b), bad).distinct()
    return parents.join(bad_keys, key, "left_anti"), parents.join(bad_keys, key, "left_semi")


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row counts.

    Children are counted per key first: the join sees one row per key.
    """
    counted = children.groupBy(child_key).agg(F.count("*").alias("n"))
    return counted.join(parents.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti")


def cascade_delete(children: DataFrame, deleted: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children that remain once the ``deleted`` parents are gone."""
    gone = deleted.select(F.col(parent_key).alias(child_key)).distinct()
    return children.join(gone, child_key, "left_anti")
