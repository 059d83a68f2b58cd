"""SimHash near-duplicates: fingerprints, links at few differing bits found with pivot distance tables, components.

Fingerprints of equal texts are equal, so everything after the first step works on distinct fingerprints, each standing for
its smallest doc_id; groups of copies never meet as pairs.

*Pivot tables.* Every fingerprint gets a table of Hamming distances to many reference fingerprints (pivots, fixed random bits),
over all bits and over each of ``2 * most`` blocks of bits. By the triangle inequality two fingerprints that differ in at most
``most`` bits differ by at most ``most`` in every coordinate; and as ``most`` bits leave at least ``most`` blocks untouched, their coordinates
on these are equal. So candidates are the pairs with equal coordinates on ``most`` blocks (every choice of them), of which those
with a coordinate over all bits that differs by more than ``most`` are discarded; the rest is verified on the fingerprints.

Components are the classes of the links' transitive closure, by alternating star steps on an edge table in the shared folder.

Cases: a null or empty text has fingerprint zero, which links like any other; fewer words than a shingle make one shingle;
ties between bits (exactly half) are 0; no rows give no rows; equal doc_ids give a row each and share a class; a null doc_id
is kept, its class being the smallest doc_id reachable (null if there is none); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vacancylake.llm.texts import read_documents, slices, text_bytes, words_of
from vacancylake.session import ship_package, stored

SHINGLE = 3
MOST_BITS = 2
PIVOTS = 16
_SEED = 42
#: Shingles whose bits are counted at once.
_CHUNK = 1 << 16


def _fingerprints(texts: pa.Array, shingle: int) -> np.ndarray:
    """A 64-bit fingerprint for each text."""
    data, at = text_bytes(texts, lower=True)
    start, end = words_of(data)
    first = np.searchsorted(start, at)
    # All words of all texts, each followed by one space, so that shingles are byte ranges of one buffer.
    size = end - start + 1
    where = np.zeros(len(start) + 1, np.int64)
    np.cumsum(size, out=where[1:])
    inside = np.zeros(len(data) + 2, np.int8)
    inside[start] += 1
    inside[end + 1] -= 1
    joined = data[np.cumsum(inside[: len(data)], dtype=np.int8) > 0] if len(start) else data[:0]
    joined = joined.copy()
    joined[where[1:] - 1] = 32
    joined = joined.tobytes()
    out = np.zeros(len(texts), np.uint64)
    powers = np.uint64(1) << np.arange(64, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    for k in np.flatnonzero(np.diff(first) > 0).tolist():
        a, b = int(first[k]), int(first[k + 1])
        n = max(1, b - a - shingle + 1)
        begin = where[a : a + n].tolist()
        stop = (where[a + shingle : a + shingle + n] - 1).tolist() if b - a >= shingle else [int(where[b]) - 1]
        ones = np.zeros(64, np.int64)
        for c in range(0, n, _CHUNK):
            h = np.array([digest(joined[i:j], _SEED) for i, j in zip(begin[c : c + _CHUNK], stop[c : c + _CHUNK])], "<u8")
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[k] = powers[2 * ones > n].sum(dtype=np.uint64)
    return out


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` (doc_id, text) reduced to doc_id, ``digest`` (a hash of the text) and ``fp``, the fingerprint's 64 bits as a long."""
    ship_package(docs.sparkSession)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                fp = _fingerprints(part.column(1), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(fp, pa.int64())], ["doc_id", "digest", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("digest")).mapInArrow(compute, "doc_id long, digest long, fp long")


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints: fixed pseudo-random bits, as signed longs."""
    return np.random.default_rng(64).integers(-(1 << 63), (1 << 63) - 1, n).tolist()


def _distance(fp: Column, pivot: int, mask: int) -> Column:
    """Hamming distance to ``pivot`` on the bits of ``mask``."""
    signed = mask - (1 << 64) if mask >> 63 else mask
    return F.bit_count(fp.bitwiseXOR(F.lit(pivot)).bitwiseAND(F.lit(signed)))


def _candidates(classes: DataFrame, most: int, n_pivots: int) -> tuple[Column, DataFrame, DataFrame]:
    """What pairs must have in common, and the two sides of the join: fp, distances p0.. over all bits, key."""
    blocks = 2 * most
    width = -(-64 // blocks)
    masks = [((1 << width) - 1) << (width * b) & (1 << 64) - 1 for b in range(blocks)]
    fp = F.col("fp")
    # Narrow rows, much work each: as many tasks as the session has shuffle partitions, not as few as their bytes suggest.
    # The hash is not the grouping key itself, whose (merged) partitions the planner would take over instead.
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    references = pivots(n_pivots)
    table = classes.repartition(tasks, F.xxhash64("fp")).select("fp", *[_distance(fp, p, (1 << 64) - 1).cast("byte").alias(f"p{j}") for j, p in enumerate(references)])
    coordinates = [F.concat(*[F.chr(_distance(fp, p, m)) for p in references]) for m in masks]
    keys = [F.struct(F.lit(k).cast("byte").alias("choice"), F.xxhash64(*[coordinates[b] for b in chosen]).alias("at")) for k, chosen in enumerate(combinations(range(blocks), most))]
    keyed = table.withColumn("key", F.explode(F.array(*keys))).select("key.choice", "key.at", *table.columns)
    a, b = keyed.alias("a"), keyed.alias("b")
    return (F.col("a.choice") == F.col("b.choice")) & (F.col("a.at") == F.col("b.at")) & (F.col("a.fp") < F.col("b.fp")), a, b


def links(classes: DataFrame, most: int = MOST_BITS, n_pivots: int = PIVOTS) -> DataFrame:
    """Pairs (a, b), a's fingerprint the smaller, of the distinct fingerprints ``fp`` that differ in at most ``most`` bits.

    ``n_pivots`` reference fingerprints serve the coordinates of the blocks, which bring pairs together, and those over all
    bits, which discard pairs before they are verified.
    """
    near, a, b = _candidates(classes, most, n_pivots)
    for j in range(n_pivots):
        near &= F.abs(F.col(f"a.p{j}") - F.col(f"b.p{j}")) <= most
    near &= F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= most
    return a.join(b, near).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Large star: every node links its larger neighbours to its smallest neighbour or itself. Small star: every node links its
    smaller neighbours and itself to the smallest. Both keep what is connected; when neither changes the edges, they are stars
    around the smallest nodes. The number of rounds grows with the logarithm of the longest chain.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    before = None
    while True:
        both = now.union(now.select("b", "a"))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
        now = stored(small.select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).filter("a != b").distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most: int = MOST_BITS) -> DataFrame:
    """doc_id, digest, fp, root and component_id of every row; component_id is the smallest doc_id of the row's component.

    ``root`` tells components apart also where ids repeat or are null.
    """
    marked = stored(with_fingerprints(docs, shingle), "fingerprints")
    # Copies fold into one row per fingerprint inside the tasks, before the shuffle.
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = components(links(classes.select("fp"), most))
    labels = classes.join(rooted, classes["fp"] == rooted["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = labels.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = labels.join(smallest, "root").select("fp", "root", "component_id")
    return marked.join(labels, "fp").select("doc_id", "digest", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, most: int = MOST_BITS) -> DataFrame:
    """One row of each component: that of the smallest doc_id (rows without one come last), of the texts with that id the one of
    the least hash, of rows equal in both the one of the least hash over all columns."""
    found = stored(near_duplicates(docs, shingle, most), "components")
    texts = found.groupBy("root", "doc_id", "digest").agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest", "n")
    kept = stored(texts.groupBy("root").agg(F.min(order).alias("k")).select("k.doc_id", "k.digest", "k.n"), "kept")

    def chosen(which: str) -> DataFrame:
        ids = kept.filter(which).hint("shuffle_hash")  # the list grows with the documents: never broadcast, and no sort of whole texts
        return docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]) & (F.xxhash64(docs["text"]) == ids["digest"]), "left_semi")

    out = chosen("n = 1")
    if not kept.filter("n > 1").limit(1).count():
        return out
    # Only where whole rows repeat is one to be chosen among them; that shuffles these rows alone.
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    again = chosen("n > 1").withColumn("__rank", F.row_number().over(same)).filter(F.col("__rank") == 1).drop("__rank")
    return out.unionByName(again)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(read_documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op10_simhash": (op10_simhash, None)}
