"""Best-fit packing: token pieces into sequences, by a configuration linear program over the length histogram.

1. Texts become pieces of at most ``capacity`` ids; only longer documents are cut.
2. The histogram of piece lengths (at most ``capacity`` rows) is all that the driver sees.
3. Lengths are rounded up to classes. A configuration is a multiset of classes that fits one sequence. The covering program
   "fewest sequences such that every class is covered as often as it occurs" is solved by multiplicative weights: each round
   prices classes by how far they lag behind, and a knapsack over capacities finds the dearest configuration.
4. Every configuration is used a whole number of times, rounded down, with the longest lengths left in its classes; the room
   that rounding up leaves is filled by the same knapsack with the lengths themselves as prices. What no configuration took
   is packed the same way around its longest piece.
5. Pieces get ranks within their length, and rank ranges are mapped to places.

Cases: a null or empty text is one piece with the end id; no rows give no rows; equal doc_ids stay apart as rows (their
pieces carry the same doc_id); other columns are ignored. Every piece has exactly one place and sequences have no gaps.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vacancylake.llm.texts import read_documents
from vacancylake.llm.token_ids import encoded
from vacancylake.session import ship_package, stored

CAPACITY = 2048
#: Rounds of the multiplicative weights; each is one knapsack over the capacity.
ROUNDS = 200
#: Classes that lengths are rounded up to for the linear program.
CLASSES = 64
#: Pieces of one length are numbered in groups of about this size.
RANK_GROUP = 500

PIECES = "doc_id long, copy long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): its place in the document, its length and the checksum of its ids.

    ``copy`` tells rows with the same doc_id apart.
    """
    ship_package(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, at in encoded(batches, tokenizer, end_id):
            size = np.diff(at)
            n = -(-size // capacity)
            row = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(size[row] - start, capacity)
            begin = at[row] + start
            crc = [zlib.crc32(ids[b:e]) for b, e in zip(begin.tolist(), (begin + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "copy", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("copy"), "text").mapInArrow(cut, PIECES)


@dataclass
class Plan:
    """For every length, rank ranges and where their pieces go.

    Pieces of length ``length[k]`` with ranks from ``rank[k]`` on go ``each[k]`` to a sequence, the first one being
    ``sequence[k]``, side by side from ``offset[k]`` on. Rows are sorted by (length, rank).
    """

    length: np.ndarray
    rank: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    n_sequences: int
    bound: int  # no packing has fewer sequences


def _dearest(lengths: np.ndarray, most: np.ndarray, price: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack: how often to take each length (at most ``most``) for the highest total price within ``capacity``."""
    best = np.zeros(capacity + 1)
    taken = []
    for k, (size, limit, worth) in enumerate(zip(lengths.tolist(), most.tolist(), price.tolist())):
        left, step = min(limit, capacity // size), 1
        while left > 0 and worth > 0:
            m = min(step, left)
            cost = m * size
            better = best[:-cost] + m * worth > best[cost:] + 1e-12
            if better.any():
                best[cost:] = np.where(better, best[:-cost] + m * worth, best[cost:])
                taken.append((k, m, cost, better))
            left -= m
            step *= 2
    out = np.zeros(len(lengths), np.int64)
    room = int(np.argmax(best))
    for k, m, cost, better in reversed(taken):
        if room >= cost and better[room - cost]:
            out[k] += m
            room -= cost
    return out


def configurations(lengths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[list[np.ndarray], np.ndarray]:
    """Configurations, and how often to use each (fractional) so that together they cover the demand.

    Multiplicative weights for covering: a class's weight falls with every round that serves it, so that the next round's
    knapsack turns to those left behind; the sum of all rounds, scaled until the least covered class is whole, is the solution.
    """
    weight = np.ones(len(lengths))
    cover = np.zeros(len(lengths))
    found: dict[bytes, int] = {}
    configs: list[np.ndarray] = []
    used: list[float] = []
    for _ in range(rounds):
        config = _dearest(lengths, demand, weight / demand, capacity)
        share = config / demand
        amount = 1.0 / float(share.max())  # so that no class gains more than its demand
        k = found.setdefault(config.tobytes(), len(configs))
        if k == len(configs):
            configs.append(config)
            used.append(0.0)
        used[k] += amount
        cover += amount * share
        weight *= np.exp(-0.5 * amount * share)
        weight = np.maximum(weight / weight.max(), 1e-30)
    least = float(cover.min())
    return configs, np.array(used) / (least if least > 0 else float(rounds))


def _filled(taken: np.ndarray, lengths: np.ndarray, left: np.ndarray, capacity: int) -> np.ndarray:
    """``taken`` with the lengths that fill its room best.

    The knapsack whose prices are the lengths: the set of sums reachable so far is one integer, a bit for each sum. Longer
    lengths are tried first, so that short ones stay for later sequences.
    """
    room = capacity - int(taken @ lengths)
    reach, all_sums, steps = 1, (1 << room + 1) - 1, []
    fits = np.flatnonzero((lengths <= room) & (left > taken)) if room else []
    for k in fits:
        size = int(lengths[k])
        spare, step = min(int(left[k] - taken[k]), room // size), 1
        while spare > 0:
            m = min(step, spare)
            steps.append((k, m, m * size, reach))
            reach |= reach << m * size & all_sums
            spare -= m
            step *= 2
        if reach >> room:
            break
    best = reach.bit_length() - 1
    for k, m, cost, before in reversed(steps):
        if not before >> best & 1:
            taken[k] += m
            best -= cost
    return taken


def _rounded(configs, share, names, of_class, lengths, counts, capacity, whole: bool) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Whole uses of the configurations, then sequences around the longest pieces left, by the same knapsack.

    ``whole``: use a configuration only where it fills the sequence to the last id.
    """
    left, uses = counts.copy(), []
    for k in np.argsort(-share, kind="stable"):
        times = int(share[k])
        while times > 0 and (taken := _concrete(configs[k], names, of_class, lengths, left, capacity, whole)) is not None:
            times -= _use(taken, lengths, left, uses, times)
    while left.any():
        taken = np.zeros(len(lengths), np.int64)
        taken[int(np.flatnonzero(left)[0])] = 1  # the hardest to place goes first, then the best fit for the room beside it
        _use(_filled(taken, lengths, left, capacity), lengths, left, uses)
    return uses


def _concrete(config: np.ndarray, names: np.ndarray, of_class: np.ndarray, lengths: np.ndarray, left: np.ndarray, capacity: int, whole: bool) -> np.ndarray | None:
    """``config`` with the longest lengths its classes have left, and its room filled.

    None if a class has too few, or if ``whole`` and nothing is left that fills the room to the last id.
    """
    taken = np.zeros(len(lengths), np.int64)
    for c, m in zip(names[config > 0], config[config > 0].tolist()):
        for k in np.flatnonzero((of_class == c) & (left > 0)):
            taken[k] = min(m, int(left[k]))
            m -= int(taken[k])
            if not m:
                break
        if m:
            return None
    taken = _filled(taken, lengths, left, capacity)
    return taken if not whole or taken @ lengths == capacity else None


def _use(taken: np.ndarray, lengths: np.ndarray, left: np.ndarray, uses: list, most: int | None = None) -> int:
    """Use ``taken`` as often as there are lengths for it; how often that was."""
    some = taken > 0
    times = int((left[some] // taken[some]).min())
    times = times if most is None else min(times, most)
    uses.append((lengths[some], taken[some], times))
    left[some] -= times * taken[some]
    return times


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS, classes: int = CLASSES) -> Plan:
    """Places for all pieces of ``histogram`` (length: how many)."""
    full = [(s, n) for s, n in sorted(histogram.items()) if s >= capacity and n > 0]
    open_ = [(s, n) for s, n in sorted(histogram.items(), reverse=True) if s < capacity and n > 0]
    uses: list[tuple[np.ndarray, np.ndarray, int]] = [(np.array([s]), np.array([1]), n) for s, n in full]
    bound = sum(n for _, n in full)
    if open_:
        lengths, counts = (np.array(x, np.int64) for x in zip(*open_))
        bound += -(-int(lengths @ counts) // capacity)
        width = -(-capacity // classes)
        of_class = -(-lengths // width)
        names = np.unique(of_class)[::-1]
        demand = np.array([counts[of_class == c].sum() for c in names])
        solved = configurations(np.minimum(names * width, capacity), demand, capacity, rounds)
        ways = [_rounded(*solved, names, of_class, lengths, counts, capacity, **way) for way in ({"whole": True}, {"whole": False})]
        uses += min(ways, key=lambda way: sum(times for *_, times in way))
    rows = []
    ranked: dict[int, int] = {}
    first = 0
    for sizes, each, times in uses:
        offset = 0
        for s, m in zip(sizes.tolist(), each.tolist()):
            rows.append((s, ranked.get(s, 0), m, first, offset))
            ranked[s] = ranked.get(s, 0) + m * times
            offset += s * m
        first += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Plan(*table.T, n_sequences=first, bound=bound)


def pack(cut: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> tuple[DataFrame, Plan]:
    """``cut`` (rows of ``pieces``) with sequence_id and offset, and the plan behind them."""
    spark = cut.sparkSession
    ship_package(spark)
    cut = stored(cut, "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    plan = plan_packing(histogram, capacity, rounds)
    # Ranks in two steps: a length held by a third of all pieces is numbered group by group. One row per length, so broadcast.
    groups = spark.createDataFrame([(s, -(-n // RANK_GROUP)) for s, n in histogram.items()], "length long, groups long")
    dealt = cut.join(F.broadcast(groups), "length").withColumn("part", F.pmod(F.xxhash64("doc_id", "copy", "piece"), F.col("groups")))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = dealt.groupBy("length", "part").agg(F.count("*").alias("n")).withColumn("before", before).drop("n")
    inside = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "copy", "piece"))
    ranked = dealt.withColumn("rank", inside).join(sizes, ["length", "part"]).withColumn("rank", F.col("rank") - 1 + F.col("before"))
    # The plan has a few rows per length and configuration: its size depends on the capacity, not on the number of pieces.
    plan_of = spark.sparkContext.broadcast(plan)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan_of.value
        span = int(p.rank.max(initial=0)) + 1
        keys = p.length * span + p.rank
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            k = np.searchsorted(keys, length * span + np.minimum(rank, span - 1), side="right") - 1
            over = rank - p.rank[k]
            seq, off = p.sequence[k] + over // p.each[k], p.offset[k] + over % p.each[k] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(seq, pa.int64()), pa.array(off, pa.int64())], [*batch.schema.names[:-1], "sequence_id", "offset"])

    columns = ["doc_id", "copy", "piece", "start", "length", "ids_crc32"]
    return ranked.select(*columns, "rank").mapInArrow(place, f"{PIECES}, sequence_id long, offset long").drop("copy"), plan


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, tokenizer, end_id, capacity), capacity)[0]


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 ids."""
    import public_tokenizers

    return pack_documents(read_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op5_best_fit_packing": (op5_best_fit_packing, None)}
