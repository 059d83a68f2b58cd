"""Trigram language model in an Elias-Fano trie: trained on Spark, stored in memory-mapped levels, searched in batches.

*Counts.* Words are 64-bit hashes; their counts, sorted by hash, are level 1, and a word's place is its id. Pairs and triples of
ids are counted inside each slice of text, packed into blocks by the pair's bucket, and summed per bucket. Pairs and triples
that occur fewer than ``least`` times enter the discounts and the back-off mass but not the trie; at 1 all are stored.

*Trie.* Level 2 holds the pairs (v, w) as the ascending numbers v * V + w. A pair's children are level 3: not by the child's id
but *relative to its context*: x after (v, w) is stored as the rank of x among the successors of w in level 2, a far smaller
number. All levels are cut into files by range, Elias-Fano coded, with probabilities and back-off weights on a logarithmic
scale of 16 bits. A context's first child is found as the successor of the least number it could have, so pointers cost
nothing beyond the coded numbers, which ascend.

*Probabilities.* Interpolated absolute discounting: p(x | c) = max(n(c, x) - D, 0) / n(c) + back-off(c) * p(x | shorter c), down to
words with one added to every count and one place for all unknown words. Stored numbers are already interpolated, so a
query reads one probability and the weights of the contexts that lack it.

Memory: a task holds one slice, one bucket or one file's share of a level; the levels grow with the corpus and are mapped, not
loaded. The driver sees the list of files and a few totals.

Cases: a null or empty text is its end token alone; repeated rows count as often as they stand; without training rows every
word is unknown and N is 0; rows with a null doc_id are held out like any other by the rule given; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylake.llm.elias_fano import Sequence, encode
from vacancylake.llm.texts import mix, read_documents, slices, text_bytes, word_hashes, words_of
from vacancylake.session import new_shared_path, ship_package, stored

#: Pairs and triples that occur so often are stored. Most occur once, and at 1 the levels grow several times over.
LEAST = 2
#: Pairs and triples in one counting bucket, about.
BUCKET_TOKENS = 2_000_000
#: Distinct words a task holds before it passes their counts on.
HELD_WORDS = 1_000_000
FOLDS, HELD_OUT = 7, 2
END = np.uint64(0x456E64)  # the end token's hash
_NONE = 0xFFFFFFFF
_SCALE = 2000.0  # steps of 1/2000 in log10, down to 10 ** -32


def _quantised(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 * _SCALE), 0, 65535).astype(np.uint16)


def _value(code: np.ndarray) -> np.ndarray:
    return code.astype(np.float64) / -_SCALE


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (lower-case words, then the end token) and where each text's begin, one entry more than texts."""
    data, at = text_bytes(texts, lower=True)
    start, end = words_of(data)
    words = word_hashes(data, start, end)
    first = np.searchsorted(start, at)
    return np.insert(words, first[1:], END), first + np.arange(len(first))


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers in ascending order and where each of ``x`` is among them; what ascends already is not sorted."""
    if len(x) and (x[1:] >= x[:-1]).all():
        new = np.append(True, x[1:] != x[:-1])
        return x[new], np.cumsum(new) - 1
    return np.unique(x, return_inverse=True)


def _preceding(x: np.ndarray, at: np.ndarray, first: int) -> np.ndarray:
    """For each token the one before it in its text; ``first`` where a text begins."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[at[:-1]] = first
    return out


def _write(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """One file with all arrays, each at a multiple of 8 bytes; the directory stands at the end."""
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    directory, at = [], 0
    with store.open_output_stream(f"{path}/{name}", compression=None) as out:
        for key, x in arrays.items():
            raw = np.ascontiguousarray(x).tobytes()
            out.write(raw + bytes(-len(raw) % 8))
            directory.append(f"{key} {x.dtype.str} {at} {len(x)}")
            at += len(raw) + -len(raw) % 8
        tail = "\n".join(directory).encode()
        out.write(tail + len(tail).to_bytes(8, "little"))


def _mapped(folder: str, name: str) -> dict[str, np.ndarray]:
    """The file's arrays; on a mounted folder they are mapped, so only the pages a query touches are read."""
    store, path = fs.FileSystem.from_uri(folder)
    if isinstance(store, fs.LocalFileSystem):
        buffer = pa.memory_map(f"{path}/{name}").read_buffer()
    else:
        with store.open_input_file(f"{path}/{name}") as source:
            buffer = source.read_buffer()
    raw = np.frombuffer(buffer, np.uint8)
    size = int.from_bytes(raw[-8:].tobytes(), "little")
    out = {}
    for line in raw[-8 - size : -8].tobytes().decode().split("\n"):
        key, kind, at, n = line.split(" ")
        kind = np.dtype(kind)
        out[key] = raw[int(at) : int(at) + int(n) * kind.itemsize].view(kind)
    return out


class Level:
    """A level cut into files by range. ``files`` are (name, first number, how many), in order; a place counts over all files."""

    def __init__(self, folder: str, files: list[tuple[str, int, int]]):
        self.folder, self.files = folder, files
        self.least = np.array([f[1] for f in files], np.uint64)
        self.offset = np.concatenate([[0], np.cumsum([f[2] for f in files])]).astype(np.int64)
        self.parts: dict[int, dict[str, np.ndarray]] = {}

    @property
    def n(self) -> int:
        return int(self.offset[-1])

    def part(self, k: int) -> dict[str, np.ndarray]:
        if k not in self.parts:
            self.parts[k] = _mapped(self.folder, self.files[k][0])
        return self.parts[k]

    def _by_file(self, which: np.ndarray) -> Iterator[tuple[int, np.ndarray | slice]]:
        """Each file with the places in ``which`` that name it: a slice if the files ascend, as for sorted targets."""
        if not len(which):
            return
        order = None if (which[1:] >= which[:-1]).all() else np.argsort(which, kind="stable")
        sorted_ = which if order is None else which[order]
        cuts = [0, *(np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1).tolist(), len(which)]
        for a, b in zip(cuts, cuts[1:]):
            yield int(sorted_[a]), slice(a, b) if order is None else order[a:b]

    def search(self, targets: np.ndarray, exact: bool = True) -> np.ndarray:
        """Places of ``targets`` (-1: not there), or with ``exact`` off, of the first number at or above each."""
        out = np.full(len(targets), -1 if exact else self.n, np.int64)
        if not self.files:
            return out
        which = np.searchsorted(self.least, targets, side="right") - 1
        if not exact:
            out[which < 0] = 0
        for k, some in self._by_file(which):
            if k < 0:
                continue
            part = self.part(k)
            if "hash" in part:
                place = np.searchsorted(part["hash"], targets[some])
                equal = part["hash"][np.minimum(place, len(part["hash"]) - 1)] == targets[some]
            else:
                place, equal = Sequence(part).successor(targets[some] - self.least[k])
            out[some] = np.where(equal, place + self.offset[k], -1) if exact else place + self.offset[k]
        return out

    def take(self, name: str, places: np.ndarray) -> np.ndarray:
        """Values of the column ``name`` at ``places``, none of them negative."""
        out = None
        which = np.searchsorted(self.offset, places, side="right") - 1
        for k, some in self._by_file(which):
            column = self.part(k)[name]
            if out is None:
                out = np.zeros(len(places), column.dtype)
            out[some] = column[places[some] - self.offset[k]]
        return out if out is not None else np.zeros(len(places), np.uint16)


class Model:
    """What a task needs to query the trie; levels open when first used."""

    def __init__(self, folder: str, tokens: int, texts: int, levels: list[list[tuple[str, int, int]]], back_off: list[tuple[str, int, int]], discounts: tuple[float, float]):
        self.tokens, self.texts, self.discounts = tokens, texts, discounts
        self.words, self.pairs, self.triples = (Level(folder, files) for files in [*levels, [], []][:3])
        self.back_off = Level(folder, back_off)
        self.v = self.words.n

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of the tokens, -1 for unknown ones; equal tokens are looked up once."""
        some, code = _distinct(hashes)
        return self.words.search(some)[code]

    def word_counts(self, ids: np.ndarray) -> np.ndarray:
        some, code = _distinct(ids)
        known = some >= 0
        out = np.zeros(len(some), np.int64)
        out[known] = self.words.take("count", some[known])
        return out[code]

    def word_log(self, counts: np.ndarray) -> np.ndarray:
        return np.log10(counts + 1.0) - np.log10(self.tokens + self.v + 1.0)

    def pair_keys(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Numbers of pairs; ``v`` is an id, or ``self.v`` for the beginning of a text."""
        return v.astype(np.uint64) * np.uint64(self.v + 1) + w.astype(np.uint64)

    def weights_of(self, ids: np.ndarray) -> np.ndarray:
        """Back-off weights (log10) of single-word contexts; those without kept pairs leave everything."""
        some, code = _distinct(ids)
        out = np.zeros(len(some))
        place = np.full(len(some), -1, np.int64)
        known = some >= 0
        place[known] = self.back_off.search(some[known].astype(np.uint64))
        has = place >= 0
        out[has] = _value(self.back_off.take("weight", place[has]))
        return out[code]

    def find_pairs(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        out = np.full(len(v), -1, np.int64)
        known = np.flatnonzero((v >= 0) & (w >= 0))
        some, code = _distinct(self.pair_keys(v[known], w[known]))
        out[known] = self.pairs.search(some)[code]
        return out

    def relative(self, w: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rank of the pairs at ``place`` among those that begin with ``w``."""
        some, code = _distinct(w)
        return place - self.pairs.search(self.pair_keys(some, np.zeros(len(some), np.int64)), exact=False)[code]

    def triple_keys(self, context: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return context.astype(np.uint64) * np.uint64(self.v + 1) + rank.astype(np.uint64)

    def score(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """For each text: tokens, known tokens, base score, score (log10).

        Distinct words, pairs and triples are numbered in the order of their keys, so each is looked up once, in ascending order.
        """
        hashes, at = token_hashes(texts)
        words, word = np.unique(hashes, return_inverse=True)
        n = len(words)
        ids = np.append(self.words.search(words), self.v)  # number n is the beginning, which every text has
        counts = self.word_counts(ids[:n])
        base = self.word_log(counts)[word]
        counts = counts[word]
        before = _preceding(word, at, n)
        log = base + self.weights_of(ids)[before]

        on = np.flatnonzero((ids[before] >= 0) & (ids[word] >= 0))
        pairs, code = np.unique(before[on] * n + word[on], return_inverse=True)
        first = ids[pairs // max(n, 1)]
        place = self.pairs.search(self.pair_keys(first, ids[pairs % max(n, 1)]))
        stored_ = place >= 0
        first, place = first[stored_], place[stored_]
        pair = np.full(len(word), -1, np.int64)
        pair[on] = np.where(stored_, np.cumsum(stored_) - 1, -1)[code]
        has = np.flatnonzero(pair >= 0)
        if len(has):
            log[has] = _value(self.pairs.take("log", place))[pair[has]]
            # The context of a triple is the pair one token earlier, which is at hand.
            context = _preceding(pair, at, -1)
            on = np.flatnonzero(context >= 0)
            log[on] += _value(self.pairs.take("weight", place))[context[on]]
            both = on[pair[on] >= 0]
            if len(both) and self.triples.files:
                triples, code = np.unique(context[both] * len(place) + pair[both], return_inverse=True)
                rank = self.relative(first, place)
                found = self.triples.search(self.triple_keys(place[triples // len(place)], rank[triples % len(place)]))
                hit = found >= 0
                value = np.zeros(len(found))
                value[hit] = _value(self.triples.take("log", found[hit]))
                hit = np.flatnonzero(hit[code])
                log[both[hit]] = value[code[hit]]
        tokens = np.diff(at)
        sums = [np.add.reduceat(x, at[:-1]) if len(tokens) else np.zeros(0) for x in ((counts > 0).astype(np.int64), base, log)]
        return (tokens, *sums)


@cache
def _opened(*args) -> Model:
    """One per Python worker and model."""
    folder, tokens, texts, levels, back_off, discounts = args
    return Model(folder, tokens, texts, [list(x) for x in levels], list(back_off), discounts)


FILES = "part long, name string, least decimal(20,0), n long, total long"


def _files(df: DataFrame) -> tuple[list[tuple[str, int, int]], int]:
    """Files in order and the sum of their totals; ``df`` is run once and its rows are one per file."""
    rows = sorted(stored(df, "files").collect(), key=lambda r: r["part"])
    return [(r["name"], int(r["least"]), r["n"]) for r in rows], sum(r["total"] for r in rows)


def _file_row(name: str, least: int, n: int, total: int) -> pa.RecordBatch:
    import decimal

    from pyspark import TaskContext

    kinds = [pa.int64(), pa.string(), pa.decimal128(20, 0), pa.int64(), pa.int64()]
    row = [TaskContext.get().partitionId(), name, decimal.Decimal(least), n, total]
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], ["part", "name", "least", "n", "total"])


def _name(level: str) -> str:
    import uuid

    return f"{level}-{uuid.uuid4().hex}"  # a repeated task writes a new file; only listed ones count


def _columns(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    """All columns of a task's share, as arrays; empty list without rows."""
    own = [b for b in batches if b.num_rows]
    return [c.combine_chunks().to_numpy(zero_copy_only=False) for c in pa.Table.from_batches(own).columns] if own else []


def _count_words(docs: DataFrame) -> DataFrame:
    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([p[0] for p in parts])
        some, code = np.unique(keys, return_inverse=True)
        return some, np.bincount(code, weights=np.concatenate([p[1] for p in parts]), minlength=len(some)).astype(np.int64)

    def batch_of(some: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(some.view(np.int64)), pa.array(n)], ["hash", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for part in slices(batch):
                held.append(np.unique(token_hashes(part.column(0))[0], return_counts=True))
                if sum(len(h[0]) for h in held) > HELD_WORDS:
                    held = [merged(held)]
                    if len(held[0][0]) > HELD_WORDS // 2:
                        yield batch_of(*held.pop())
        if held:
            yield batch_of(*merged(held))

    return docs.select("text").mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def _write_words(counts: DataFrame, folder: str) -> DataFrame:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if columns := _columns(batches):
            key, n = columns
            name = _name("words")
            hashes = key.view(np.uint64) ^ np.uint64(1 << 63)
            _write(folder, name, {"hash": hashes, "count": n})
            yield _file_row(name, int(hashes[0]), len(hashes), int(n.sum()))

    flipped = counts.select(F.col("hash").bitwiseXOR(F.lit(-(1 << 63))).alias("key"), "n")  # unsigned order of the hashes
    return flipped.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(write, FILES)


COUNTED = "v long, w long, x long, n long, children long, in_children long, n_one long, n_two long, n_one3 long, n_two3 long"


def _count_pairs(docs: DataFrame, model_of: tuple, buckets: int, least: int) -> DataFrame:
    """Rows of COUNTED: pairs (x is null; children: how many triples go on from it, in_children: their occurrences) and triples,
    each at least ``least`` times in the corpus; and a row per bucket of how many occur once and twice (v is null)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _opened(*model_of)
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in slices(batch):
                hashes, at = token_hashes(part.column(0))
                words, word = np.unique(hashes, return_inverse=True)
                own = len(words)
                ids = np.append(model.words.search(words), model.v).astype(np.uint64)
                pairs, code = np.unique(_preceding(word, at, own) * own + word, return_inverse=True)
                pair = ids[pairs // own] << np.uint64(32) | ids[pairs % own]
                bucket = (mix(pair) % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
                order = np.argsort(bucket, kind="stable")
                bucket, pair = bucket[order], pair[order]
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                following = np.full(len(word), own, np.int64)
                following[:-1] = word[1:]
                following[at[1:] - 1] = own
                # Numbers that ascend by bucket, pair and following word, of which no word is the last.
                whole = np.sort(rank[code] * (own + 1) + following)
                first = np.flatnonzero(np.append(True, whole[1:] != whole[:-1]))
                n = np.diff(first, append=len(whole)).astype(np.uint32)
                code, following = np.divmod(whole[first], own + 1)
                bucket, pair, x = bucket[code], pair[code], np.append(ids[:own], np.uint64(_NONE)).astype(np.uint32)[following]
                cuts = np.searchsorted(bucket, np.arange(buckets + 1))
                rows = []
                for b in np.flatnonzero(np.diff(cuts)).tolist():
                    p, q = cuts[b], cuts[b + 1]
                    # Bytes of equal weight side by side compress better.
                    planes = [np.diff(pair[p:q], prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T, x[p:q].view(np.uint8).reshape(-1, 4).T, n[p:q].view(np.uint8).reshape(-1, 4).T]
                    rows.append((b, int(q - p), packer.compress(b"".join(np.ascontiguousarray(y).tobytes() for y in planes))))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], ["bucket", "size", "block"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for b, size, block in zip(*(c.to_pylist() for c in batch.columns)):
                if b != bucket and held:
                    yield from summed(held)
                    held = []
                bucket = b
                held.append((size, block))
        if held:
            yield from summed(held)

    def summed(held: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        pairs, xs, ns = [], [], []
        for size, block in held:
            raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
            pairs.append(np.cumsum(np.ascontiguousarray(raw[: 8 * size].reshape(8, size).T).view(np.uint64).ravel(), dtype=np.uint64))
            xs.append(np.ascontiguousarray(raw[8 * size : 12 * size].reshape(4, size).T).view(np.uint32).ravel())
            ns.append(np.ascontiguousarray(raw[12 * size :].reshape(4, size).T).view(np.uint32).ravel())
        pair, x, n = np.concatenate(pairs), np.concatenate(xs), np.concatenate(ns).astype(np.int64)
        # Every block ascends by pair and following word, which stable sorting makes use of: first by pair, then by both as one number.
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        both = np.cumsum(np.append(True, pair[1:] != pair[:-1])).astype(np.uint64) << np.uint64(32) | x[order]
        again = np.argsort(both, kind="stable")
        order, both = order[again], both[again]
        x, n = x[order], n[order]
        at3 = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        n3, pair3, x3 = np.add.reduceat(n, at3), pair[at3], x[at3]
        at2 = np.flatnonzero(np.append(True, pair3[1:] != pair3[:-1]))
        n2, pair2 = np.add.reduceat(n3, at2), pair3[at2]
        real = x3 != _NONE
        often = real & (n3 >= least)
        children, inside = (np.add.reduceat(y, at2) for y in (often.astype(np.int64), np.where(often, n3, 0)))
        keep = n2 >= least
        v, w = (pair2 >> np.uint64(32)).astype(np.int64)[keep], (pair2 & np.uint64(_NONE)).astype(np.int64)[keep]
        yield _counted(len(v), v=v, w=w, n=n2[keep], children=children[keep], in_children=inside[keep])
        v, w = (pair3 >> np.uint64(32)).astype(np.int64)[often], (pair3 & np.uint64(_NONE)).astype(np.int64)[often]
        yield _counted(len(v), v=v, w=w, x=x3[often].astype(np.int64), n=n3[often])
        yield _counted(1, **{k: np.array([c]) for k, c in (("n_one", (n2 == 1).sum()), ("n_two", (n2 == 2).sum()), ("n_one3", (real & (n3 == 1)).sum()), ("n_two3", (real & (n3 == 2)).sum()))})

    def _counted(size: int, **columns: np.ndarray) -> pa.RecordBatch:
        names = [x.split()[0] for x in COUNTED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(columns[k], pa.int64()) if k in columns else pa.nulls(size, pa.int64()) for k in names], names)

    blocks = docs.select("text").mapInArrow(pack, "bucket int, size long, block binary")
    return blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(add_up, COUNTED)


def train(docs: DataFrame, least: int = LEAST) -> tuple:
    """The trie of ``docs`` (text), as the arguments of ``Model``; its files are in the shared folder.

    Pairs and triples that occur ``least`` times or more are stored.
    """
    if least < 1:
        raise ValueError("what never occurs cannot be stored")
    spark = docs.sparkSession
    ship_package(spark)
    folder = new_shared_path(spark, "language-model")
    words, tokens = _files(_write_words(_count_words(docs), folder))
    v = sum(f[2] for f in words)
    if v >= _NONE:
        raise ValueError("more distinct words than 32-bit ids")
    texts = docs.count()
    model = (folder, tokens, texts, (tuple(words),), (), (0.5, 0.5))
    if not tokens:
        return model
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = stored(_count_pairs(docs, model, max(tasks, -(-tokens // BUCKET_TOKENS)), least), "pairs")
    ones = counted.filter("v is null").agg(*[F.sum(c).alias(c) for c in ("n_one", "n_two", "n_one3", "n_two3")]).first()
    discount = tuple(min(0.95, max(0.05, a / max(a + 2 * b, 1))) for a, b in ((ones["n_one"], ones["n_two"]), (ones["n_one3"], ones["n_two3"])))
    pairs = counted.filter("v is not null and x is null")
    triples = counted.filter("x is not null")

    # Back-off weights of single words: what the kept pairs leave. Words with kept pairs alone have rows; the beginning is id v.
    left = pairs.groupBy("v").agg(F.count("*").alias("children"), F.sum("n").alias("inside"))

    def write_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if columns := _columns(batches):
            ids, children, inside = columns
            m = _opened(*model)
            total = np.where(ids == v, texts, m.word_counts(np.where(ids == v, -1, ids)))
            name = _name("weights")
            _write(folder, name, encode(ids - ids[0], int(ids[-1] - ids[0]) + 1) | {"weight": _quantised(np.log10(np.maximum(1 - (inside - discount[0] * children) / total, 1e-6)))})
            yield _file_row(name, int(ids[0]), len(ids), 0)

    weights, _ = _files(left.repartitionByRange("v").sortWithinPartitions("v").mapInArrow(write_weights, FILES))
    model = (folder, tokens, texts, (tuple(words),), tuple(weights), discount)

    def write_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if columns := _columns(batches):
            a, b, n, children, inside = columns
            m = _opened(*model)
            total = np.where(a == v, texts, m.word_counts(np.where(a == v, -1, a)))
            p = (n - discount[0]) / total + 10 ** (m.weights_of(a) + m.word_log(m.word_counts(b)))
            rest = np.where(children > 0, np.maximum(1 - (inside - discount[1] * children) / n, 1e-6), 1.0)
            keys = m.pair_keys(a, b)
            name = _name("pairs")
            _write(folder, name, encode(keys - keys[0], int(keys[-1] - keys[0]) + 1) | {"log": _quantised(np.log10(p)), "weight": _quantised(np.log10(rest)), "count": n.astype(np.uint32)})
            yield _file_row(name, int(keys[0]), len(keys), 0)

    level2, _ = _files(pairs.select("v", "w", "n", "children", "in_children").repartitionByRange("v", "w").sortWithinPartitions("v", "w").mapInArrow(write_pairs, FILES))
    model = (folder, tokens, texts, (tuple(words), tuple(level2)), tuple(weights), discount)

    def write_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if columns := _columns(batches):
            a, b, x, n = columns
            m = _opened(*model)
            context, pair = m.find_pairs(a, b), m.find_pairs(b, x)
            p = (n - discount[1]) / m.pairs.take("count", context) + 10 ** (_value(m.pairs.take("weight", context)) + _value(m.pairs.take("log", pair)))
            keys = m.triple_keys(context, m.relative(b, pair))
            name = _name("triples")
            _write(folder, name, encode(keys - keys[0], int(keys[-1] - keys[0]) + 1) | {"log": _quantised(np.log10(p))})
            yield _file_row(name, int(keys[0]), len(keys), 0)

    # Places of contexts and ranks in them ascend with the ids, so rows are dealt by ids: Spark runs what stands before a range twice.
    level3, _ = _files(triples.select("v", "w", "x", "n").repartitionByRange("v", "w", "x").sortWithinPartitions("v", "w", "x").mapInArrow(write_triples, FILES))
    return (folder, tokens, texts, (tuple(words), tuple(level2), tuple(level3)), tuple(weights), discount)


def score(docs: DataFrame, model: tuple, *keep: str) -> DataFrame:
    """(doc_id, ``keep`` ..., n_tokens, n_known, base_score, score) for every row of ``docs`` (doc_id, text)."""
    ship_package(docs.sparkSession)
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(["doc_id long", *[f"{k} {fields[k]}" for k in keep], "n_tokens long, n_known long, base_score double, score double"])

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _opened(*model)
        for batch in batches:
            for part in slices(batch):
                found = m.score(part.column(part.num_columns - 1))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *map(pa.array, found)], [*part.schema.names[:-1], "n_tokens", "n_known", "base_score", "score"])

    return docs.select(F.col("doc_id").cast("long"), *keep, "text").mapInArrow(rate, schema)


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of those outside the held-out fold."""
    held_out = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % FOLDS == HELD_OUT, F.lit(False))
    docs = read_documents(spark, sf_dir).withColumn("held_out", held_out)
    model = train(docs.filter("not held_out"))
    out = score(docs, model, "held_out")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model[1]).cast("long").alias("train_tokens"), "base_score", "score")


QUERIES = {"op6_language_model": (op6_language_model, None)}
