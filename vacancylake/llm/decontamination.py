"""Benchmark decontamination: BM25 retrieval of test items for every training passage, then a check of question and answer.

*Index.* Test items (segments of at most ``SEGMENT`` words) form an inverted index. A posting's impact is its BM25 weight over
the item's own total, so a passage's score is the share of the item's weight that the passage holds, and one threshold
serves all items. Items are cut into blocks; every term has its highest impact per block.

*Queries.* Every document is cut into passages of ``2 * SEGMENT`` words, one beginning every ``SEGMENT`` words, so that each
run of ``SEGMENT`` words lies whole in one of them. For all passages at once, block maxima are added up per block of items, and
blocks that can't reach the threshold are skipped; inside the others, WAND moves cursors from pivot to pivot and scores in full
only items whose terms' highest impacts reach the threshold. All items above it are retrieved; there is no top-k.

*Check.* A retrieved item counts if the document has, in order and close to the passage, enough of the words of its question
and of its answer (the longest common subsequence). An item's text is split into both at its last question mark if words
follow, else at its middle word. Every retrieved passage is checked; of those that pass, the one with the highest score is
reported.

Test items are indexed in shards of bounded size, each broadcast and searched by itself, so any number of them works.

Cases: a null or empty text matches nothing; items with fewer than ``LEAST_WORDS`` words match nothing; equal items are all
reported; repeated rows and doc_ids give rows each (they are told apart by nothing); no items or no rows give no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylake.llm.texts import read_documents, slices
from vacancylake.session import ship_package

SEGMENT = 64
LEAST_WORDS = 5
#: Share of an item's BM25 weight that a passage must hold.
THRESHOLD = 0.5
#: Share of the words of the question, and of the answer, that must stand in order.
OVERLAP = 0.8
#: Bytes of test items in one shard of the index.
SHARD_BYTES = 1 << 20
ITEM_BLOCK = 4
MOST_BLOCKS = 64
K1, B = 1.2, 0.75

_WORD = re.compile(r"\w+")


def words_of_text(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    head, mark, tail = text.rpartition("?")
    if mark and words_of_text(head) and words_of_text(tail):
        return words_of_text(head), words_of_text(tail)
    words = words_of_text(text)
    return words[: (len(words) + 1) // 2], words[(len(words) + 1) // 2 :]


class Index:
    """Postings of one shard of items [(item_id, text)], in blocks."""

    def __init__(self, items: list[tuple[int, str]], least_words: int = LEAST_WORDS):
        self.items = [(i, *question_and_answer(t)) for i, t in items if len(words_of_text(t)) >= max(1, least_words)]
        segments = [(k, (q + a)[s : s + SEGMENT]) for k, (_, q, a) in enumerate(self.items) for s in range(0, len(q + a), SEGMENT)]
        self.owner = [k for k, _ in segments]
        n = len(segments)
        block = max(ITEM_BLOCK, -(-n // MOST_BLOCKS))
        self.n_blocks = -(-n // block)
        df = Counter(w for _, words in segments for w in set(words))
        self.term = {w: k for k, w in enumerate(df)}
        idf = {w: math.log(1 + (n - d + 0.5) / (d + 0.5)) for w, d in df.items()}
        mean = sum(len(words) for _, words in segments) / max(n, 1)
        #: Per block and term the postings (segment, impact) in order of segments.
        self.postings: list[dict[int, list[tuple[int, float]]]] = [{} for _ in range(self.n_blocks)]
        self.block_max = np.zeros((len(self.term), self.n_blocks), np.float32)
        for s, (_, words) in enumerate(segments):
            weight = {w: idf[w] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean)) for w, tf in Counter(words).items()}
            total = sum(weight.values())
            for w, x in weight.items():
                t, b = self.term[w], s // block
                self.postings[b].setdefault(t, []).append((s, x / total))
                self.block_max[t, b] = max(self.block_max[t, b], x / total)

    def search(self, ids: np.ndarray, passage: np.ndarray, n_passages: int, threshold: float = THRESHOLD) -> Iterator[tuple[int, int, float]]:
        """(passage, segment, score) of all segments at or above ``threshold``.

        ``ids`` are the known terms of all texts, ``passage`` the strides they stand in; passage p is strides p and p + 1.
        """
        pairs = np.unique(passage.astype(np.int64) * len(self.term) + ids)
        stride, term = np.divmod(pairs, len(self.term))
        begin = np.searchsorted(stride, np.arange(n_passages + 2))
        # Sums of block maxima per stride; of two strides together, terms in both count twice, so this stays an upper bound.
        bound = np.zeros((n_passages + 1, self.n_blocks), np.float32)
        full = np.flatnonzero(np.diff(begin))
        for some in np.array_split(full, max(1, len(full) // 20_000)):
            if len(some):
                a, b = begin[some[0]], begin[some[-1] + 1]
                bound[some] = np.add.reduceat(self.block_max[term[a:b]], begin[some] - a, axis=0)
        last, terms = -1, []
        slack = threshold * (1 - 1e-4)  # single-precision sums
        for p, b in np.argwhere(bound[:-1] + bound[1:] >= slack).tolist():
            if p != last:
                terms = np.unique(term[begin[p] : begin[p + 2]])
                sums = self.block_max[terms].sum(axis=0)
                last = p
            if sums[b] >= slack:
                yield from ((p, s, x) for s, x in self._wand(terms, b, threshold))

    def _wand(self, terms: np.ndarray, block: int, threshold: float) -> Iterator[tuple[int, float]]:
        lists = self.postings[block]
        highest = self.block_max[:, block]
        # A cursor: current segment, place in its list, list, highest impact.
        cursors = [[own[0][0], 0, own, float(highest[t])] for t in terms.tolist() if (own := lists.get(t))]
        while cursors:
            cursors.sort(key=lambda c: c[0])
            total, pivot = 0.0, None
            for c in cursors:
                total += c[3]
                if total >= threshold * (1 - 1e-4):
                    pivot = c[0]
                    break
            if pivot is None:
                return
            if cursors[0][0] == pivot:
                score = 0.0
                for c in cursors:
                    if c[0] != pivot:
                        break
                    score += c[2][c[1]][1]
                    _advance(c, pivot + 1)
                if score >= threshold:
                    yield pivot, score
            else:
                for c in cursors:
                    if c[0] >= pivot:
                        break
                    _advance(c, pivot)
            cursors = [c for c in cursors if c[0] >= 0]


def _advance(cursor: list, least: int) -> None:
    """Move to the first posting at or after segment ``least``; -1 if there is none."""
    own, k = cursor[2], cursor[1]
    while k < len(own) and own[k][0] < least:
        k += 1
    cursor[1] = k
    cursor[0] = own[k][0] if k < len(own) else -1


def in_order(wanted: list[str], text: list[str]) -> float:
    """Share of ``wanted`` in its longest common subsequence with ``text`` (bit-parallel)."""
    if not wanted:
        return 1.0
    masks: dict[str, int] = {}
    for k, w in enumerate(wanted):
        masks[w] = masks.get(w, 0) | 1 << k
    full = (1 << len(wanted)) - 1
    v = full
    for w in text:
        if m := masks.get(w):
            u = v & m
            v = (v + u | v - u) & full
    return (len(wanted) - v.bit_count()) / len(wanted)


MATCHES = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"


def _matches(index: Index, batch: pa.RecordBatch, threshold: float, overlap: float) -> pa.RecordBatch:
    """Matches of all rows of ``batch`` (doc_id, text)."""
    get = index.term.get
    keys = batch.column(0).to_pylist()
    texts = batch.column(1).to_pylist()
    ids, strides, first = [], [], [0]
    for text in texts:
        code = np.array([get(w, -1) for w in words_of_text(text)], np.int64)
        known = np.flatnonzero(code >= 0)
        ids.append(code[known])
        strides.append(first[-1] + known // SEGMENT)
        first.append(first[-1] + -(-len(code) // SEGMENT) + 1)  # an empty stride keeps texts apart
    # Every passage that scores above the match found so far is checked: the best score alone may be words in another order.
    best: dict[tuple[int, int], tuple] = {}
    owner_of = np.repeat(np.arange(len(texts)), np.diff(first))
    last, words = -1, []
    if any(len(x) for x in ids):
        for p, s, score in index.search(np.concatenate(ids), np.concatenate(strides), first[-1], threshold):
            d, k = int(owner_of[p]), index.owner[s]
            if (d, k) in best and score <= best[d, k][2]:
                continue
            if d != last:  # passages come in order, so texts do
                last, words = d, words_of_text(texts[d])
            item_id, question, answer = index.items[k]
            at = (p - first[d]) * SEGMENT
            size = len(question) + len(answer)
            # The longest item reaches its own length to either side of the passage that holds one of its segments.
            near = words[max(0, at - size) : at + 2 * SEGMENT + size]
            q, a = in_order(question, near), in_order(answer, near)
            if q >= overlap and a >= overlap:
                best[d, k] = (keys[d], item_id, score, q, a, at)
    rows = list(best.values())
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
    columns = zip(*rows) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], [x.split()[0] for x in MATCHES.split(", ")])


def contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, shard_bytes: int = SHARD_BYTES,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """A row per document of ``docs`` (doc_id, text) and item of ``items`` (item_id, text) that it holds.

    Items of fewer than ``least_words`` words are not sought: common words alone are no test item. At 1 all are.
    """
    spark = docs.sparkSession
    ship_package(spark)
    items = items.filter("text is not null").select(F.col("item_id").cast("long"), "text")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_shards = max(1, -(-int(size) // shard_bytes))
    slim = docs.select(F.col("doc_id").cast("long"), "text")

    def searched(shard: int) -> DataFrame:
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_shards)) == shard).orderBy("item_id", "text")
        index = spark.sparkContext.broadcast(Index([(r["item_id"], r["text"]) for r in own.collect()], least_words))  # about shard_bytes

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    yield _matches(index.value, part, threshold, overlap)

        return slim.mapInArrow(search, MATCHES)

    out = searched(0)
    for shard in range(1, n_shards):
        out = out.union(searched(shard))
    return out


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id holds a test item; rows without a doc_id are judged by their text all the same."""
    found = contaminated(docs, items).select("doc_id").distinct().hint("shuffle_hash")  # grows with the documents
    return docs.join(found, docs["doc_id"].eqNullSafe(found["doc_id"]), "left_anti")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and test item that it holds."""
    return contaminated(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op2_decontamination": (op2_decontamination, None)}
