"""Quality rules: a decision list learned from labelled statistics, applied as one conditional expression.

1. Every text is measured inside its row (words, symbols, repeated lines, repeated three-word windows, ...).
2. Of the labelled rows each measure's quantiles give candidate thresholds; rows are counted per combination of threshold
   steps, label and fold. These counts are all that learning reads.
3. Sequential covering: a rule grows one threshold condition at a time, the one of the highest information gain for low
   quality on the growing fold; it is then pruned on the other fold to the prefix that is best there, and kept if it is
   precise enough. Rows that a rule covers leave, and the next rule is learned from the rest.
4. The list is emitted as ``when(rule 1).when(rule 2)...``: the first rule that fires rejects the document, none keeps it.

DataFrame functions only. The driver sees counts (measures x steps x labels), never rows.

Cases: a null or empty text has no words and fails the base rule; no labels, one kind of label or no precise rule give an
empty list, which keeps all that pass the base rule; labels without a document and null labels count nothing; a repeated
doc_id weighs as often as it is repeated; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylake.llm.texts import read_documents
from vacancylake.session import stored

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
STEPS = 24
MOST_RULES = 6
MOST_CONDITIONS = 3
#: A rule stays if it is at least this precise on both folds and covers so many low-quality rows on the pruning fold.
LEAST_PRECISION = 0.9
LEAST_SUPPORT = 5

_BREAK = r"[\x20\x09-\x0D]"
#: Positions of windows are kept in so many low bits of a packed hash.
_INDEX_BITS = 21

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = ["words", "word_length", "symbol_share", "repeated_line_share", "repeated_word_share", "capital_share", "shout_share", "digit_share"]


def _count(pattern: str) -> Column:
    """Characters of ``text`` that match a pattern of one character."""
    return F.size(F.split("text", pattern, -1)) - 1


def _repeated(sorted_: str, key, position) -> Column:
    """Words covered by windows whose key stands more than once in the sorted array ``sorted_``."""
    item = F.col(sorted_)
    last = F.size(sorted_) - 1
    at = F.filter(F.sequence(F.lit(0), last), lambda k: ((k > 0) & (key(item[k]) == key(item[k - 1]))) | ((k < last) & (key(item[k]) == key(item[k + 1]))))
    return F.sort_array(F.transform(at, lambda k: position(item[k])))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the counts in ``BASE``, ``base_failed`` and the shares in ``MEASURES``."""
    mask = (1 << _INDEX_BITS) - 1
    step = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    step = step.withColumn("parts", F.split("text", _BREAK, -1)).withColumn("lines", F.filter(F.split("text", "\n", -1), lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "    ")) != ""))
    step = step.select(
        "doc_id", F.array_remove("parts", "").alias("words"), (F.char_length("text") - F.size("parts") + 1).cast("long").alias("word_chars"),
        _count("[#*$%&|<>]").cast("long").alias("n_symbols"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").alias("n_lines"), _count(r"\p{Lu}").alias("n_capitals"), _count("[!?]").alias("n_shouts"), _count("[0-9]").alias("n_digits"),
    )
    w = F.col("words")
    windows = F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda k: F.xxhash64(w[k], w[k + 1], w[k + 2]))).otherwise(F.array().cast("array<bigint>"))
    step = step.withColumn("windows", windows).withColumn("n_words", F.size("words").cast("long")).drop("words")
    # Windows are sorted as one long each, hash above and position below; where cutting the hash merges two windows, or the
    # text is too long for the position, whole hashes are sorted.
    distinct = F.size(F.array_distinct("windows"))
    cut = F.transform("windows", lambda x: x.bitwiseAND(F.lit(~mask)))
    step = step.withColumn("n_distinct", distinct).withColumn("n_cut", F.when(F.col("n_distinct") < F.size("windows"), F.size(F.array_distinct(cut))).otherwise(0))
    exact = (F.col("n_cut") == F.col("n_distinct")) & (F.size("windows") <= mask)
    step = step.withColumn("packed", F.when(exact, F.sort_array(F.transform("windows", lambda x, k: x.bitwiseAND(F.lit(~mask)).bitwiseOR(k.cast("long"))))))
    whole = F.sort_array(F.transform("windows", lambda x, k: F.struct(x.alias("x"), k.alias("k"))))
    step = step.withColumn("whole", F.when((F.col("n_distinct") < F.size("windows")) & ~exact, whole))
    packed_at = _repeated("packed", lambda x: x.bitwiseAND(F.lit(~mask)), lambda x: x.bitwiseAND(F.lit(mask)))
    whole_at = _repeated("whole", lambda x: x["x"], lambda x: x["k"].cast("long"))
    step = step.withColumn("at", F.when(F.col("packed").isNotNull(), packed_at).when(F.col("whole").isNotNull(), whole_at).otherwise(F.array().cast("array<bigint>")))
    covered = F.aggregate("at", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last")), lambda acc, x: F.struct((acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n"), x.alias("last")))["n"]
    step = step.withColumn("n_repeat_words", covered)
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    shares = [
        F.col("n_words").cast("double"), F.col("word_chars") / words, F.col("n_symbols") / chars, F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        F.col("n_repeat_words") / words, F.col("n_capitals") / chars, F.col("n_shouts") / words, F.col("n_digits") / chars,
    ]
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return step.select("doc_id", *BASE, failed.alias("base_failed"), *[x.alias(m) for x, m in zip(shares, MEASURES)])


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool  # "greater than the threshold", else "at most"
    threshold: float

    def column(self) -> Column:
        return F.col(self.measure) > self.threshold if self.above else F.col(self.measure) <= self.threshold

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out &= c.column()
    return out


def _stepped(measure: str, cuts: list[float]) -> Column:
    """The least threshold at or above the value; infinity beyond the last."""
    out = F.lit(math.inf)
    for t in reversed(cuts):
        out = F.when(F.col(measure) <= t, F.lit(t)).otherwise(out)
    return out


def thresholds(rows: DataFrame, steps: int = STEPS) -> dict[str, list[float]]:
    """Candidate thresholds: each quantile, moved to the middle of the gap between the values beside it.

    A rule then stands off as far as it can from the rows on its other side.
    """
    points = [k / steps for k in range(1, steps)]
    row = rows.agg(*[F.percentile_approx(m, points, 10_000).alias(m) for m in MEASURES]).first()
    cuts = {m: sorted(set(row[m] or [])) for m in MEASURES}
    sides = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), _stepped(m, cuts[m]).alias("t"), F.col(m).alias("v")) for m in MEASURES]))
    found = rows.select(sides.alias("s")).groupBy("s.m", "s.t").agg(F.min("s.v").alias("low"), F.max("s.v").alias("high")).collect()
    ends = {m: sorted((r["t"], r["low"], r["high"]) for r in found if r["m"] == m) for m in MEASURES}
    return {m: [(a[2] + b[1]) / 2 for a, b in zip(e, e[1:])] for m, e in ends.items()}


def statistics(rows: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Counts of labelled ``rows`` (MEASURES, doc_id, low) per combination of threshold steps, label and fold.

    A measure's value is replaced by the threshold it just reaches, so the counts answer every threshold condition.
    """
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    table = rows.select(*[_stepped(m, cuts[m]).alias(m) for m in MEASURES], "low", fold.alias("prune"))
    return table.groupBy(*MEASURES, "low", "prune").agg(F.count("*").alias("n"))


def _grow(counts: DataFrame, rest: Column) -> Rule:
    rule: list[Condition] = []
    while len(rule) < MOST_CONDITIONS:
        here = counts.filter(~F.col("prune") & rest & _all(rule))
        sides = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).alias("t")) for m in MEASURES]))
        rows = here.select(sides.alias("s"), "low", "n").groupBy("s.m", "s.t").agg(F.sum(F.when(F.col("low"), F.col("n")).otherwise(0)).alias("p"), F.sum("n").alias("n")).collect()
        p0 = sum(r["p"] for r in rows if r["m"] == MEASURES[0])
        n0 = sum(r["n"] for r in rows if r["m"] == MEASURES[0])
        if not p0 or p0 == n0:
            break
        best, gain = None, 1e-9
        for m in MEASURES:
            at = sorted((r["t"], r["p"], r["n"]) for r in rows if r["m"] == m)
            p = n = 0
            for t, dp, dn in at[:-1]:
                p, n = p + dp, n + dn
                for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                    if pp and (g := pp * (math.log2(pp / nn) - math.log2(p0 / n0))) > gain:
                        best, gain = Condition(m, above, t), g
        if best is None:
            break
        rule.append(best)
    return tuple(rule)


def _prune(counts: DataFrame, rest: Column, rule: Rule) -> tuple[Rule, bool]:
    """The prefix of ``rule`` that is best on the pruning fold, and whether it is worth keeping."""
    sums = []
    for k in range(1, len(rule) + 1):
        for fold, where in (("prune", F.col("prune")), ("grow", ~F.col("prune"))):
            for name, more in (("p", F.col("low")), ("n", F.lit(True))):
                sums.append(F.sum(F.when(where & more & _all(rule[:k]), F.col("n")).otherwise(0)).alias(f"{fold}_{name}{k}"))
    row = counts.filter(rest).agg(*sums).first()
    worth = {k: (2 * row[f"prune_p{k}"] - row[f"prune_n{k}"]) / row[f"prune_n{k}"] for k in range(1, len(rule) + 1) if row[f"prune_n{k}"]}
    if not worth:
        return rule, False
    k = max(worth, key=lambda k: (worth[k], -k))
    precise = all(row[f"{f}_p{k}"] >= LEAST_PRECISION * row[f"{f}_n{k}"] for f in ("prune", "grow"))
    return rule[:k], precise and row[f"prune_p{k}"] >= LEAST_SUPPORT


def learn(rows: DataFrame) -> list[Rule]:
    """Rules for low quality, in order, from labelled ``rows`` (MEASURES, doc_id, low)."""
    rows = stored(rows, "quality-labelled")
    cuts = thresholds(rows)
    counts = stored(statistics(rows, cuts), "quality-counts")
    rules: list[Rule] = []
    rest = F.lit(True)
    while len(rules) < MOST_RULES:
        rule = _grow(counts, rest)
        if not rule:
            break
        rule, good = _prune(counts, rest, rule)
        if not good:
            break
        rules.append(rule)
        rest &= ~_all(rule)
    return rules


def fired(rules: list[Rule]) -> Column:
    """The first rule that covers the row, as text; null if none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(_all(rule), F.lit(" and ".join(map(str, rule)))).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, the rule that fired, and kept, for every row of ``docs``.

    ``labels`` has doc_id and quality (1 good, 0 low).
    """
    rows = stored(measured(docs), "measures")
    known = labels.filter("quality is not null").select(F.col("doc_id").cast("long"), (F.col("quality") == 0).alias("low"))
    rules = learn(rows.filter(~F.col("base_failed")).join(known, "doc_id"))
    return rows.select("doc_id", *BASE, "base_failed", fired(rules).alias("rule")).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def without_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without what ``judge`` rejects. Rows that share a doc_id are one document, which goes if any of them is rejected."""
    rejected = judge(docs, labels).filter(~F.col("kept")).select("doc_id").distinct()
    rejected = rejected.hint("shuffle_hash")  # the list grows with the documents: never broadcast, and no sort of whole texts
    return docs.join(rejected, docs["doc_id"].eqNullSafe(rejected["doc_id"]), "left_anti")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict for every document, with rules learned from all labels."""
    return judge(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op1_quality_rules": (op1_quality_rules, None)}
