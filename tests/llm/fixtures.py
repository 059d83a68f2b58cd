"""Small documents with every awkward case, and words without meaning to make more of them."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def babble(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    words = [f"{rng.choice('bdfgklmnprst')}{rng.choice('aeiouéü')}{rng.choice('bdklmnrst')}{k % 37}"[: 3 + k % 3] for k in range(vocabulary)]
    out = []
    for k in range(n):
        out.append(rng.choice(words) + (".\n" if k % 23 == 22 else ""))
    return " ".join(out)


LONG = babble(99, 30_000, 5_000)

AWKWARD = [
    (None, "a text without an id, long enough to have three words"), (900, None), (901, ""), (902, " \t\n "), (903, "x"), (904, "x"),
    (905, "two words"), (905, "two words"), (906, "Ünï çode ı́ 中文     x\u0000y"), (907, LONG), (908, "a" * 5_000),
    (909, "na " * 400), (910, "\n".join(["same line here"] * 30)),
]


def table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in rows], SCHEMA)


def clashing(docs: DataFrame) -> DataFrame:
    """The documents with columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ["key", "n", "host", "page", "lines", "kept", "line", "salt", "fp", "component_id", "item_id", "length", "rank", "copy", "bucket", "hash", "start", "rule", "low", "keep", "score", "gram", "part"]
    return docs.select("*", *[F.lit(f"own {c}").alias(c) for c in names])
