"""Vector codes by product quantisation in whole numbers, nearest entries found through memoised grid cells.

A vector's components become integers, floor(``scale`` * x), and it is cut into equal parts, each with a codebook of its own.
A codebook starts as that part of the vectors with the smallest ids; each round gives every part to its nearest entry (squared
distance, of equal ones the lower index) and moves every entry to the floor of the mean of its parts. Codes are the indexes.

*Cells.* The integers' upper bits name a cell of a grid, a box of 2^``cell_bits`` integers along every component. For a cell that is new,
the smallest and greatest distance of every entry to the box are computed; an entry whose smallest distance exceeds some
other's greatest is dominated across the box and can't be nearest (nor tie) there. The rest is remembered under the cell, and
only these are evaluated exactly for its parts. The memory of cells is bounded; a forgotten cell is computed anew.

Integers are stored once in the shared folder; a round reads them, adds up per task, and brings the sums of all entries (parts x
entries rows, whatever the input) to the driver, which holds the codebooks. A lost executor costs its tasks of one round.

Cases: rows whose vector is null or holds null or non-finite components are dropped; the dimension is that of the vector with
the smallest id, rows of another dimension are dropped; a dimension that the parts don't divide is cut as evenly as can be; equal
ids and equal vectors are rows of their own (ties of the first ids go by vector); null ids come last; fewer vectors than
entries give smaller codebooks; integers beyond ±2^28 count as ±2^28, so that distances fit a long; no rows give no rows; columns other
than those named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylake.session import ship_package, stored

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
CELL_BITS = 7
#: Cells remembered for one codebook by a task; a few hundred bytes each.
KNOWN_CELLS = 50_000
#: Rows whose distances are computed together.
_ROWS = 8192
_LARGEST = 1 << 28
#: Rows of a label are spread over so many join keys.
SALTS = 32

Codebooks = list[np.ndarray]  # for each part: entries x components


class Cells:
    """Nearest entries of one codebook, by the grid cell of a point."""

    def __init__(self, entries: np.ndarray, cell_bits: int = CELL_BITS, known_cells: int = KNOWN_CELLS):
        self.entries, self.bits, self.known_cells = entries, cell_bits, known_cells
        self.known: dict[bytes, np.ndarray] = {}
        self.evaluated = self.points = 0

    def _candidates(self, cells: np.ndarray) -> np.ndarray:
        """For each cell, which entries are not dominated across its box."""
        low = (cells.astype(np.int64) << self.bits)[:, None, :]
        high = low + (1 << self.bits) - 1
        e = self.entries[None, :, :]
        outside = np.maximum(np.maximum(low - e, e - high), 0)
        across = np.maximum(np.abs(e - low), np.abs(e - high))
        least, most = (outside * outside).sum(axis=2), (across * across).sum(axis=2)
        return least <= most.min(axis=1, keepdims=True)

    def _masks(self, points: np.ndarray) -> np.ndarray:
        n, width = points.shape
        if not width:
            return np.ones((n, len(self.entries)), bool)
        cells = np.ascontiguousarray((points >> self.bits).astype("<i4"))
        packed = pa.Array.from_buffers(pa.binary(4 * width), n, [None, pa.py_buffer(cells)]).dictionary_encode()
        distinct = packed.dictionary.to_pylist()
        new = [c for c in distinct if c not in self.known]
        if len(self.known) + len(new) > self.known_cells:
            self.known.clear()
            new = distinct
        if new:
            found = self._candidates(np.frombuffer(b"".join(new), "<i4").reshape(-1, width))
            self.known.update(zip(new, found))
        return np.stack([self.known[c] for c in distinct])[np.asarray(packed.indices)]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of and squared distance to the nearest entry of each point, of equally near ones the lower index."""
        masks = self._masks(points)
        self.points += len(points)
        self.evaluated += int(masks.sum())
        best = np.zeros(len(points), np.int64)
        least = np.full(len(points), np.iinfo(np.int64).max)
        for k, entry in enumerate(self.entries):
            rows = np.flatnonzero(masks[:, k])
            away = points[rows] - entry
            distance = np.einsum("ij,ij->i", away, away)
            nearer = distance < least[rows]
            best[rows[nearer]], least[rows[nearer]] = k, distance[nearer]
        return best, least


def _bounds(dimension: int, parts: int) -> list[int]:
    return [k * dimension // parts for k in range(parts + 1)]


def whole_numbers(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str | None = "label", scale: int = SCALE) -> DataFrame:
    """vec_id, label and ``v`` (array of int) of the rows with a whole, finite vector, stored."""
    infinite = F.lit(float("inf"))
    usable = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))

    def whole(x: Column) -> Column:
        return F.greatest(F.lit(-_LARGEST), F.least(F.lit(_LARGEST), F.floor(x.cast("double") * scale))).cast("int")

    return stored(vectors.filter(F.coalesce(usable, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("vec_id"), (F.col(label) if label else F.lit(None).cast("int")).alias("label"), F.transform(vector, whole).alias("v"),
    ), "vectors")


def _batches(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of rows with their vectors as a matrix."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            flat = part.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield part, flat.reshape(part.num_rows, -1) if len(flat) else np.zeros((part.num_rows, 0), np.int64)


def _first(numbers: DataFrame, entries: int) -> list[list[int]]:
    """The vectors of the smallest ids, of the first one's dimension."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("v").asc()]
    one = numbers.orderBy(*order).select("v").first()
    if one is None:
        return []
    alike = numbers.filter(F.size("v") == len(one["v"]))
    return [r["v"] for r in alike.orderBy(*order).select("v").limit(entries).collect()]


def learn(numbers: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, cell_bits: int = CELL_BITS) -> Codebooks:
    """The codebooks of ``numbers`` (as ``whole_numbers`` gives them); none if there are no vectors."""
    first = _first(numbers, entries)
    if not first:
        return []
    dimension = len(first[0])
    bounds = _bounds(dimension, parts)
    matrix = np.array(first, np.int64).reshape(len(first), dimension)
    books = [matrix[:, a:b].copy() for a, b in zip(bounds, bounds[1:])]
    ship_package(numbers.sparkSession)
    vectors = numbers.filter(F.size("v") == dimension).select("v")
    sums = F.array(*[F.sum(F.get("sums", F.lit(k))) for k in range(max(len(b[0]) for b in books))]) if dimension else F.array().cast("array<long>")
    for _ in range(rounds):
        added = vectors.mapInArrow(_adder(books, bounds, cell_bits), "part int, entry int, n long, sums array<long>")
        for r in added.groupBy("part", "entry").agg(F.sum("n").alias("n"), sums.alias("sums")).collect():  # parts x entries rows
            book = books[r["part"]]
            book[r["entry"]] = [s // r["n"] for s in r["sums"][: book.shape[1]]]
    return books


def _adder(books: Codebooks, bounds: list[int], cell_bits: int):
    """Counts and sums of the parts given to each entry, once per task."""
    books = [b.copy() for b in books]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b, cell_bits) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros_like(b) for b in books]
        for _, points in _batches(batches, 0):
            for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                best, _ = cells[k].nearest(points[:, a:b])
                counts[k] += np.bincount(best, minlength=len(books[k]))
                np.add.at(sums[k], best, points[:, a:b])
        rows = [(k, e, int(n), sums[k][e].tolist()) for k in range(len(books)) for e, n in enumerate(counts[k]) if n]
        if rows:
            part, entry, n, total = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()), pa.array(total, pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    return add


def with_codes(numbers: DataFrame, books: Codebooks, cell_bits: int = CELL_BITS) -> DataFrame:
    """vec_id, label, ``codes`` (an index for each part) and ``error`` (squared distances summed over the parts)."""
    kind = numbers.schema["label"].dataType.simpleString()
    schema = f"vec_id long, label {kind}, codes array<int>, error long"
    if not books:
        return numbers.sparkSession.createDataFrame([], schema)
    ship_package(numbers.sparkSession)
    bounds = np.cumsum([0, *(b.shape[1] for b in books)]).tolist()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b, cell_bits) for b in books]
        for part, points in _batches(batches, 2):
            found = [c.nearest(points[:, a:b]) for c, a, b in zip(cells, bounds, bounds[1:])]
            codes = np.stack([best for best, _ in found], axis=1).astype(np.int32)
            error = np.sum([distance for _, distance in found], axis=0, dtype=np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, len(books), dtype=np.int32)), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists, pa.array(error)], ["vec_id", "label", "codes", "error"])

    return numbers.filter(F.size("v") == bounds[-1]).select("vec_id", "label", "v").mapInArrow(encode, schema)


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the error summed over equal labels (nulls together); a large label is spread over salted keys."""
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    salted = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("label", "total_label")
    dealt = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "codes"), F.lit(SALTS)).cast("int"))
    same = dealt["label"].eqNullSafe(salted["total_label"]) & (dealt["salt"] == salted["salt"])
    return dealt.join(salted, same).select(*[dealt[c] for c in coded.columns], "label_error")


def digest(books: Codebooks) -> str:
    """sha256 of all components in decimal by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings with their errors, and the codebooks' digest."""
    numbers = whole_numbers(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    books = learn(numbers)
    coded = with_label_error(stored(with_codes(numbers, books), "codes"))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return coded.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _rounds_sql() -> str:
    """A codebook and an assignment for each round."""
    out = []
    for k in range(ROUNDS + 1):
        out.append(f"""a{k} AS MATERIALIZED (
  SELECT r, vec_id, label, part, x, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT p.*, entry, CAST(list_sum(list_transform(list_zip(x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM parts p JOIN b{k} USING (part)) GROUP BY ALL)""")
        if k < ROUNDS:
            out.append(f"""b{k + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.e, b.e) AS e FROM b{k} b LEFT JOIN (
    SELECT part, entry, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY place) AS e FROM (
      SELECT part, entry, place, CAST(sum(c) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT part, entry, unnest(x) AS c, generate_subscripts(x, 1) AS place FROM a{k}) GROUP BY ALL)
    GROUP BY part, entry) m USING (part, entry))""")
    return ", ".join(out)


OP13_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT r, vec_id, label, part, v[part * len(v) // {PARTS} + 1 : (part + 1) * len(v) // {PARTS}] AS x FROM kept, (SELECT unnest(range({PARTS})) AS part)
), b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS e FROM parts WHERE r <= {ENTRIES}
), {_rounds_sql()}, coded AS (
  SELECT r, vec_id, label, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY r, vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM b{ROUNDS}) AS codebooks_sha256
FROM coded
"""

QUERIES = {"op13_vector_codes": (op13_vector_codes, OP13_SQL)}
