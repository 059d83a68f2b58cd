"""Declared constraints as data: one report, one rejects table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake import schemas


def row_rules(table: str) -> dict[str, Column]:
    """Violation conditions that need only the row: NOT NULL and text length."""
    return rules_for(schemas.not_null_columns(table), schemas.length_limits(table))


def rules_for(required: list[str], limits: dict[str, int]) -> dict[str, Column]:
    rules = {f"not_null:{c}": F.col(c).isNull() for c in required}
    rules |= {f"length:{c}<={n}": F.coalesce(F.length(c) > n, F.lit(False)) for c, n in limits.items()}
    return rules


def quality_report(
    df: DataFrame,
    rules: dict[str, Column],
    key: list[str] | None = None,
    parent: tuple[DataFrame, str, str] | None = None,
) -> DataFrame:
    """``(rule, row_count, violations)`` of all row rules, the key and the reference, in one pass over ``df``.

    ``parent`` is ``(parents, child column, parent column)``. One aggregate over grouping sets counts the whole table, every key
    and every child value. The parents' values join as rows of the same grouping, so a value is known if its group has one of them:
    nothing is joined, and a hot value leaves each task as one row.
    """
    key = key or []
    parents, child_column, parent_column = parent or (None, None, None)
    names = list(rules)
    keys = {f"_k{i}": F.col(c) for i, c in enumerate(key)}
    child = {"_child": F.col(child_column)} if parent else {}
    flags = {f"_v{i}": rules[r] for i, r in enumerate(names)}
    sets = [[], *([list(keys)] if key else []), *([["_child"]] if parent else [])]
    grouped = (
        df.select(*[c.alias(n) for n, c in (keys | child | flags).items()])
        .groupingSets(sets, *keys, *child)
        .agg(F.grouping_id().alias("_set"), F.count("*").alias("_n"), *[F.count_if(v).alias(f"_s{i}") for i, v in enumerate(flags)])
    )
    width = len(keys) + len(child)  # a bit of the set's number is 1 where the set leaves the column out
    whole, by_key, by_child = (1 << width) - 1, 1 if parent else 0, ((1 << len(keys)) - 1) << 1
    kind = (
        F.when(F.col("_set") == whole, "row") if not (key or parent)
        else F.when(F.col("_set") == whole, "row").when(F.col("_set") == (by_child if parent else -1), "child").otherwise("key")
    )
    counts = ["_n", *[f"_s{i}" for i in range(len(names))]]
    marked = grouped.select(kind.alias("_kind"), *child, *counts, F.lit(False).alias("_known"))
    if parent:
        zero = [F.lit(0).cast("bigint").alias(c) for c in counts]
        known = parents.select(F.lit("child").alias("_kind"), F.col(parent_column).alias("_child"), *zero, F.lit(True).alias("_known"))
        # Only groups of child values carry one, so all keys and the whole table leave a task as one row each.
        marked = marked.unionByName(known).groupBy("_kind", "_child").agg(
            *[F.sum(c).alias(c) for c in counts], F.max("_known").alias("_known"),
            F.count_if((F.col("_kind") == "key") & (F.col("_n") > 1)).alias("_repeated"),
        )
    else:
        marked = marked.withColumn("_repeated", ((F.col("_kind") == "key") & (F.col("_n") > 1)).cast("bigint"))
    missing = (F.col("_kind") == "child") & (F.col("_child").isNotNull() & ~F.col("_known")) if parent else F.lit(False)
    total = marked.agg(
        *[F.coalesce(F.sum(F.when(F.col("_kind") == "row", F.col(c))), F.lit(0)).alias(c) for c in counts],
        F.coalesce(F.sum("_repeated"), F.lit(0)).alias("_repeated"),
        F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("_missing"),
    )
    violations = {r: f"_s{i}" for i, r in enumerate(names)}
    if key:
        violations["unique:" + ",".join(key)] = "_repeated"
    if parent:
        violations[f"reference:{child_column}"] = "_missing"
    entries = F.array(*[F.struct(F.lit(r).alias("rule"), F.col("_n").alias("row_count"), F.col(c).alias("violations")) for r, c in violations.items()])
    return total.select(F.explode(entries).alias("e")).select("e.*")


def split_by_rules(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that break no rule, and the others with the list of broken rules."""
    broken = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    marked = df.withColumn("broken_rules", broken)
    return marked.where(F.size("broken_rules") == 0).drop("broken_rules"), marked.where(F.size("broken_rules") > 0)


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)
