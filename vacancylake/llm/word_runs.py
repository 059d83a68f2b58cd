"""Periodic runs of words by recursive frequency splitting and a scan of lags.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) of at least max(``least``,
``times`` * q) words, ``times`` being 3 or more, that no neighbouring word extends with the same period.

*Splitting.* A word of a run stands in it once per period, so at least ``times`` times. Where a segment (at first a whole text)
holds a word more seldom, no run crosses that word: it splits the segment, short rests are dropped, and words are counted
anew in the rests, until nothing changes. Lags up to ``least // times`` are scanned word by word on what is left. In longer runs
the phrases of ``least // times`` words come back as well, which splits the rests once more by phrases seen once.

*Lags.* The surviving segments are scanned for lags in bands from a to 1.5 a. A run with its period in the band repeats its
windows of 2 a words at that lag, and no such window has a smallest period of a / 2 or less, as it would divide the run's own
period (Fine and Wilf). So the same window comes back at most twice within the band's lags, and for each place only its next two
occurrences can be a run's. Windows are told apart by ranks that double in length (no hashes), places with the same lag are joined to stretches, and stretches
whose period is a fraction of the lag are left out. All of it is sorting of arrays over many texts at once: n log n for a band,
however long the text, however few its words.

Cases: a null or empty text has no words and no runs; fewer words than ``least`` give no runs; equal rows and equal or null
doc_ids give a row each; runs may overlap, all are reported; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylake.llm.texts import WORD_BREAK, read_documents, slices, text_bytes, text_or_empty, words_of
from vacancylake.session import ship_package

LEAST = 24
TIMES = 3


def _segments(inside: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal stretches of True that stay within one text."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.zeros(len(inside) + 1, bool)
    same[1:-1] = text[1:] == text[:-1]
    before = np.concatenate([[False], inside[:-1]]) & same[:-1]
    after = np.concatenate([inside[1:], [False]]) & same[1:]
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def _spread(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All positions of the stretches, one after another."""
    size = end - start
    at = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start - at, size)


def _split(symbols: np.ndarray, start: np.ndarray, end: np.ndarray, seldom: int, reach: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments split at positions that no symbol seen ``seldom`` times or more in its segment covers, until all stay.

    The symbol at i covers positions i to i + reach - 1 and counts only where these are inside the segment.
    """
    while True:
        long = end - start >= least
        start, end = start[long], end[long]
        if not len(start):
            return start, end
        place = _spread(start, end - reach + 1)
        segment = np.repeat(np.arange(len(start)), end - start - reach + 1)
        key = segment * (int(symbols.max()) + 1) + symbols[place]
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        often = place[count[which] >= seldom]
        size = int(end[-1]) + 1
        covered = np.bincount(often, minlength=size) - np.bincount(often + reach, minlength=size)
        here = _spread(start, end)
        kept = np.cumsum(covered)[here] > 0
        if kept.all():
            return start, end
        first, last = _segments(kept, np.repeat(np.arange(len(start)), end - start))
        start, end = here[first], here[last - 1] + 1


def _ranks(pairs: np.ndarray) -> np.ndarray:
    return np.unique(pairs, return_inverse=True)[1].reshape(-1).astype(np.int64)


class _Windows:
    """Ranks of all windows of a length: equal ranks, equal words. Lengths must not fall from call to call."""

    def __init__(self, words: np.ndarray):
        self.rank, self.length = words, 1

    def of(self, length: int) -> np.ndarray:
        """A number for each place; windows beyond the end of the words have numbers of their own."""
        while self.length * 2 <= length:
            self.rank = _ranks(self._two(self.length))
            self.length *= 2
        return self.rank if length == self.length else self._two(length - self.length)

    def _two(self, shift: int) -> np.ndarray:
        later = np.full(len(self.rank), -1, np.int64)
        later[: max(0, len(self.rank) - shift)] = self.rank[shift:]
        return self.rank * (int(self.rank.max()) + 2) + later + 1


def _factors(n: int) -> list[int]:
    out, f = [], 2
    while f * f <= n:
        if n % f == 0:
            out.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return out + [n] * (n > 1)


def _primitive(words: np.ndarray, start: int, end: int, period: int) -> bool:
    """Whether no fraction of ``period`` is a period of words [start, end) too."""
    one = words[start : start + period]  # a fraction that is a period of the run turns its first period into itself
    return not any(np.array_equal(one[period // f :], one[: -(period // f)]) and np.array_equal(np.roll(one, period // f), one) for f in _factors(period))


def _stretches(place: np.ndarray, lag: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first, last, lag) of maximal runs of consecutive places with the same lag."""
    order = np.lexsort((place, lag))
    place, lag = place[order], lag[order]
    if len(place):
        new = np.concatenate([[True], (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(place)) - 1
        yield from zip(place[first].tolist(), place[last].tolist(), lag[first].tolist())


def find_runs(words: np.ndarray, text: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(start, length, period) of every run, by start, then period; ``text`` says which text each word belongs to.

    ``words`` are small numbers, equal for equal words; the words of a text stand together. No run crosses texts.
    """
    if times < 3 or least < times:
        raise ValueError("runs have three periods or more, and at least one word in each")
    found: list[tuple[int, int, int]] = []

    def take(first: int, stop: int, period: int) -> None:
        if stop - first >= max(least, times * period) and _primitive(words, first, stop, period):
            found.append((first, stop - first, period))

    words = words.astype(np.int64)
    start, end = _segments(np.ones(len(words), bool), text)
    start, end = _split(words, start, end, times, 1, least)
    phrase = max(1, least // times)
    if len(start):
        here = _spread(start, end)
        segment = np.repeat(np.arange(len(start)), end - start)
        for lag in range(1, phrase + 1):
            same = np.zeros(len(here), bool)
            if len(here) > lag:
                same[:-lag] = (words[here[:-lag]] == words[here[lag:]]) & (segment[:-lag] == segment[lag:])
            for a, b in zip(*_segments(same, segment)):
                take(int(here[a]), int(here[b - 1]) + 1 + lag, lag)
        # A longer period repeats phrases: each of its places is covered by a phrase that comes back in the segment.
        phrases = _Windows(words).of(phrase)
        start, end = _split(_ranks(phrases), start, end, 2, phrase, times * (phrase + 1))
    band, windows, held = phrase + 1, None, None
    while len(start) and int((end - start).max()) >= times * band:
        long = end - start >= times * band
        if windows is None or not long.all():
            # Only what is long enough for this band and all later ones is carried on.
            start, end = start[long], end[long]
            held = _spread(start, end)
            segment = np.repeat(np.arange(len(start)), end - start)
            windows = _Windows(_ranks(words[held]))
            stop = np.repeat(np.cumsum(end - start), end - start)
        beyond = band + max(1, band // 2)
        size = 2 * band
        place = np.flatnonzero(np.arange(len(held)) + size <= stop)
        number = windows.of(size)[place]
        order = np.lexsort((place, number))
        place, number = place[order], number[order]
        for ahead in (1, 2):
            lag = place[ahead:] - place[:-ahead]
            fits = (number[ahead:] == number[:-ahead]) & (lag >= band) & (lag < beyond) & (segment[place[ahead:]] == segment[place[:-ahead]])
            if ahead == 1:
                near, lags = place[:-1][fits], lag[fits]
            else:
                near, lags = np.concatenate([near, place[:-2][fits]]), np.concatenate([lags, lag[fits]])
        for a, b, lag in _stretches(near, lags):
            take(int(held[a]), int(held[b]) + size + lag, lag)
        band = beyond
    out = np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)
    return out


def _numbered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words."""
    offsets = np.zeros(len(start) + 1, np.int32)
    np.cumsum(end - start, out=offsets[1:])
    inside = np.zeros(len(data) + 1, np.int8)
    inside[start] = 1
    inside[end] -= 1
    body = data[np.cumsum(inside[:-1], dtype=np.int8) > 0] if len(data) else data
    words = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body)))
    return np.asarray(pc.dictionary_encode(words).indices).astype(np.int64)


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, at: np.ndarray) -> pa.Array:
    """Words joined by one space; text k has words at[k] to at[k + 1]."""
    size = end - start + 1
    where = np.zeros(len(start) + 1, np.int64)
    np.cumsum(size, out=where[1:])
    take = np.repeat(start - where[:-1], size)
    take += np.arange(where[-1])
    body = data[take]  # every word and the break behind it
    body[where[1:] - 1] = 32
    drop = where[at[1:]][at[1:] > at[:-1]] - 1
    inside = np.ones(len(body), bool)
    inside[drop] = False
    offsets = where[at] - np.concatenate([[0], np.cumsum(at[1:] > at[:-1])])
    return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(body[inside])))


RUNS = "array<struct<start:long,length:long,period:long>>"
_RUNS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _runs_of(part: pa.Array, least: int, times: int) -> tuple[pa.Array, pa.Array]:
    """Runs and the text without repeated periods, for each text."""
    data, at = text_bytes(part)
    start, end = words_of(data)
    first = np.searchsorted(start, at)
    text = np.repeat(np.arange(len(part)), np.diff(first))
    runs = find_runs(_numbered(data, start, end), text, least, times)
    of = text[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
    offsets = np.searchsorted(of, np.arange(len(part) + 1)).astype(np.int32)
    rows = pa.StructArray.from_arrays([pa.array(runs[:, 0] - first[of]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], ["start", "length", "period"])
    size = len(start) + 1
    again = np.bincount(runs[:, 0] + runs[:, 2], minlength=size) - np.bincount(runs[:, 0] + runs[:, 1], minlength=size)
    kept = np.cumsum(again[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(kept)])[first]
    collapsed = _joined(data, start[kept], end[kept], left)
    return pa.ListArray.from_arrays(pa.array(offsets), rows).cast(_RUNS_ARROW), collapsed


def with_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``docs`` (doc_id, text) reduced to doc_id, ``runs`` (by start, then period, in word numbers) and ``collapsed``.

    ``collapsed`` are the words joined by one space, without those that a run holds after its first period.
    """
    ship_package(docs.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), *_runs_of(part.column(1), least, times)], ["doc_id", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(find, f"doc_id long, runs {RUNS}, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, of equal ones the first, then that of the smallest period; null if none."""

    def better(one: Column, two: Column) -> Column:
        # Compared as products: quotients of long numbers would round.
        ahead = two["length"] * one["period"] - one["length"] * two["period"]
        return F.when(one["period"].isNull() | (ahead > 0), two).otherwise(one)

    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(runs, none, better)  # runs come by start, then period, so the first of equal ones stays


def planted(doc_id: Column, text: Column) -> Column:
    """The text with a repeated stretch in one of ten documents, chosen and shaped by the crc32 of its id; all others as they are."""
    words = F.filter(F.split(text, WORD_BREAK + "+"), lambda w: w != "")
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    n = F.size(words).cast("long")
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
    packed = F.struct(words.alias("words"), a.alias("a"), p.alias("p"))
    turned = F.transform(
        F.array(packed),  # one entry, so that words are split once
        lambda x: F.array_join(F.transform(x["words"], lambda w, i: F.when(i < x["a"], w).otherwise(F.element_at(x["words"], (x["a"] + F.pmod(i - x["a"], x["p"]) + 1).cast("int")))), " "),
    )[0]
    return F.when(F.pmod(h, F.lit(10)) == 0, F.when(n > 0, turned).otherwise(text)).otherwise(text)


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, after a repeated stretch was put into one of ten."""
    docs = read_documents(spark, sf_dir).select("doc_id", planted(F.col("doc_id"), text_or_empty()).alias("text"))
    best = F.col("best")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return with_runs(docs).withColumn("best", strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {"op12_word_runs": (op12_word_runs, None)}
