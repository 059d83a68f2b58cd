"""Repeated byte strings by suffix sorting: every 200-byte string that starts at two places is cut wherever it stands.

Suffixes can only share 200 bytes if they share what lies inside, so they are brought together by *anchors*: the anchor of a
200-byte window is its 50-byte gram of least hash. Equal windows have equal anchors at equal distances, and neighbouring
windows mostly share one, so a text is a sequence of *contexts*: a run of window starts with one anchor, with the bytes those
windows cover. Windows whose anchor's gram stands nowhere else repeat nowhere and go no further.

1. Contexts are listed per text as hashes (of the gram, of all bytes) and places; grams that occur once are dropped.
2. Contexts that are equal byte for byte (two 64-bit hashes) are folded with their count, inside the tasks first. All windows
   of a context that occurs twice repeat. Only contexts that occur once, in company of others with their gram, are open.
3. Those, with one of each folded kind, are fetched from the texts and grouped by gram; a gram with very many contexts is
   split by cells of neighbouring starts, which all contain the same 185 bytes. Groups are joined to blocks of bounded size.
4. In a block, the suffixes at all window starts are sorted by difference-cover blockwise construction: positions that are in a
   difference cover modulo 13 are ranked first, by doubling; then one bucket of suffixes at a time is sorted by its first
   16 bytes, and ties of any length are resolved by the ranks at an offset below 13 where both are in the cover. Neighbours in
   order are compared over 200 bytes.
5. Byte ranges go back to their texts.

Memory is bounded by the block and the longest text, not by the corpus. All shuffled rows are narrow but for the texts
themselves, which one exchange serves to both steps that need them.

Cases: a null or empty text has no bytes and is kept as it is; texts shorter than the length never match; overlapping
occurrences inside one text count; repeated rows are occurrences of their own, also with equal or null doc_ids; matches never
cross texts; other columns are ignored; no rows give no rows; a text of 256 MB or more raises ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylake.llm.texts import mix, prefix_hashes, read_documents, slices, span_hash, text_bytes
from vacancylake.session import ship_package, stored

LENGTH = 200
GRAM = 50
#: A gram with more distinct contexts than this is split by cells.
SPLIT_CONTEXTS = 2000
CELL = 16
#: Bytes of contexts sorted together, and suffixes sorted at a time.
BLOCK_BYTES = 2 << 20
BUCKET = 1 << 18

_PLACE_BITS = 28
#: A perfect difference set modulo 13: every difference occurs.
PERIOD = 13
COVER = (0, 1, 3, 9)
_SHIFT = np.array([[next(d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER) for b in range(PERIOD)] for a in range(PERIOD)])


def _least_in_window(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of every ``width`` consecutive ones, one result per first position that has so many."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def contexts_of(texts: pa.Array, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """All contexts of ``texts``: row, first window start in the text, number of starts, anchor's distance from the first
    start, hash of the gram, hash of the context."""
    data, at = text_bytes(texts)
    width = length - gram + 1
    none = {k: np.zeros(0, np.int64) for k in ("row", "start", "n", "anchor", "gram", "context")}
    if len(data) < length:
        return none
    if len(data) >> _PLACE_BITS:
        raise ValueError(f"a text of over {1 << _PLACE_BITS} bytes has no room for its positions")
    left = np.repeat(at[1:] - 1, np.diff(at)) - np.arange(len(data))  # bytes from here to the end of the text
    sums, inverse = prefix_hashes(data)
    place = np.arange(len(data) - gram + 1)
    hashes = span_hash(sums, inverse, place, place + gram)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    keys = np.where(left[: len(place)] >= gram, hashes & ~mask | place.astype(np.uint64), np.iinfo(np.uint64).max)
    starts = np.flatnonzero(left >= length)
    if not len(starts):
        return none
    anchor = (_least_in_window(keys, width)[starts] & mask).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(anchor) != 0) | (np.diff(starts) != 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(starts)))
    s, a = starts[first], anchor[first]
    row = np.searchsorted(at, s, side="right") - 1
    whole = mix(span_hash(sums, inverse, s, s + n - 1 + length) + (a - s).astype(np.uint64))
    return {"row": row, "start": s - at[row], "n": n, "anchor": a - s, "gram": hashes[a].view(np.int64), "context": whole.view(np.int64)}


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one number, in order of bytes; ``text`` has zeros behind it."""
    out = np.zeros(len(text) - 7, np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | text[k : len(text) - 7 + k]
    return out


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks of the rows of ``keys`` (first key first), equal rows sharing one, from 1."""
    order = np.lexsort(keys[::-1])
    step = np.zeros(len(order), bool)
    for k in keys:
        sorted_ = k[order]
        step[1:] |= sorted_[1:] != sorted_[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(step) + 1
    return out


def cover_ranks(text: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes at cover positions by ``depth`` bytes at least; other positions hold nothing of use."""
    n = len(words)
    residue = np.zeros(PERIOD, bool)
    residue[list(COVER)] = True
    sample = np.flatnonzero(residue[np.arange(n - 8) % PERIOD])
    ranks = np.zeros(n + 2 * depth + 64, np.int64)
    own = _dense(words[sample], words[sample + 8])
    known = PERIOD
    while True:
        ranks[sample] = own
        if known >= depth or own.max(initial=0) == len(own):
            return ranks
        own = _dense(own, ranks[sample + known])
        known *= 2


def repeated(text: np.ndarray, starts: np.ndarray, length: int = LENGTH, bucket: int = BUCKET) -> np.ndarray:
    """For every one of ``starts``, whether another of them begins the same ``length`` bytes of ``text``."""
    text = np.concatenate([text, np.zeros(length + 32, np.uint8)])
    words = _words(text)
    out = np.zeros(len(starts), bool)
    if len(starts) < 2:
        return out
    ranks = cover_ranks(text, words, length + PERIOD)
    by_word = np.argsort(words[starts], kind="stable")
    head = words[starts][by_word]
    # A bucket ends where the first eight bytes change, so equal suffixes never part.
    change = np.flatnonzero(np.append(head[1:] != head[:-1], True)) + 1
    begin = 0
    while begin < len(starts):
        end = int(change[np.searchsorted(change, min(begin + bucket, len(starts)))]) if begin + bucket < len(starts) else len(starts)
        some = by_word[begin:end]
        out[some] = _sorted_bucket(words, ranks, starts[some], length)
        begin = end
    return out


def _sorted_bucket(words: np.ndarray, ranks: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    group = _dense(words[at], words[at + 8])
    tied = np.bincount(group)[group] > 1
    out = np.zeros(len(at), bool)
    where = np.flatnonzero(tied)
    if not len(where):
        return out
    at, group = at[where], group[where]
    residue = at % PERIOD
    classes = [np.flatnonzero(residue == r) for r in range(PERIOD)]
    span = int(ranks.max()) + 1
    below = np.zeros(len(at), np.int64)  # members of the own group that come before
    for b, theirs in enumerate(classes):
        if not len(theirs):
            continue
        for shift in sorted(set(_SHIFT[:, b].tolist())):
            keys = np.sort(group[theirs] * span + ranks[at[theirs] + shift])
            mine = np.concatenate([classes[a] for a in range(PERIOD) if _SHIFT[a, b] == shift])
            if len(mine):
                low = np.searchsorted(keys, group[mine] * span)
                below[mine] += np.searchsorted(keys, group[mine] * span + ranks[at[mine] + shift]) - low
    order = np.lexsort((below, group))
    a, b = order[:-1], order[1:]
    same = np.flatnonzero(group[a] == group[b])
    for k in range(16, length, 8):
        k = min(k, length - 8)  # the last word ends where the length ends
        x, y = at[a[same]] + k, at[b[same]] + k
        same = same[words[x] == words[y]]
        if not len(same):
            break
    out[where[a[same]]] = True
    out[where[b[same]]] = True
    return out


PLACES = "key long, text_hash long, start int, n int, anchor int, gram long, context long"
CONTEXTS = "bucket long, key long, text_hash long, start int, n int, open boolean, bytes binary"
RANGES = "key long, text_hash long, start int, end int"


def _places(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                c = contexts_of(part.column(2), length, gram)
                row = pa.array(c["row"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(row), part.column(1).take(row), *[pa.array(c[k], pa.int32()) for k in ("start", "n", "anchor")], pa.array(c["gram"], pa.int64()), pa.array(c["context"], pa.int64())],
                    [x.split()[0] for x in PLACES.split(", ")],
                )

    return docs.select("key", "text_hash", "text").mapInArrow(find, PLACES)


def _fetched(joined: DataFrame, length: int, split_contexts: int) -> DataFrame:
    """Rows of CONTEXTS from texts with their list of wanted places."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in CONTEXTS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
        for batch in batches:
            for part in slices(batch):
                rows = []
                for row in part.to_pylist():
                    text = row["text"].encode()
                    for w in row["wanted"]:
                        s, n, gram, open_ = w["start"], w["n"], w["gram"], w["times"] == 1
                        if w["company"] <= split_contexts:
                            rows.append((gram, row["key"], row["text_hash"], s, n, open_, text[s : s + n - 1 + length]))
                            continue
                        place = s + w["anchor"]
                        for cell in range((w["anchor"] - n + 1) // CELL, w["anchor"] // CELL + 1):
                            a, b = max(s, place - cell * CELL - CELL + 1), min(s + n - 1, place - cell * CELL)
                            core = text[place - cell * CELL : place - cell * CELL - CELL + 1 + length]
                            name = int.from_bytes(hashlib.blake2b(core, digest_size=8, salt=cell.to_bytes(8, "little")).digest(), "little", signed=True)
                            rows.append((name, row["key"], row["text_hash"], a, b - a + 1, open_, text[a : b + length]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names)

    return joined.select("key", "text_hash", "text", "wanted").mapInArrow(cut, CONTEXTS)


def _suffix_sorted(contexts: DataFrame, length: int, block_bytes: int) -> DataFrame:
    """Byte ranges (RANGES) of open contexts whose windows repeat inside their bucket."""

    def settle(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        n = table["n"].to_numpy()
        data = table["bytes"].combine_chunks()
        raw = b"".join(x.as_py() for x in data)
        base = np.concatenate([[0], np.cumsum(n - 1 + length)])[:-1]
        starts = np.repeat(base - (np.cumsum(n) - n), n) + np.arange(n.sum())
        owner = np.repeat(np.arange(len(n)), n)
        hit = repeated(np.frombuffer(raw, np.uint8), starts, length) & table["open"].to_numpy(zero_copy_only=False)[owner]
        found = np.flatnonzero(hit)
        new = np.ones(len(found), bool)
        new[1:] = (np.diff(found) != 1) | (np.diff(owner[found]) != 0)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(found)) - 1 if len(found) else first
        who = owner[found[first]]
        begin = table["start"].to_numpy()[who] + starts[found[first]] - base[who]
        end = table["start"].to_numpy()[who] + starts[found[last]] - base[who] + length
        take = pa.array(who)
        return pa.RecordBatch.from_arrays([table["key"].combine_chunks().take(take), table["text_hash"].combine_chunks().take(take), pa.array(begin, pa.int32()), pa.array(end, pa.int32())], ["key", "text_hash", "start", "end"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), batch.num_rows]
            sizes = np.concatenate([[0], np.cumsum(batch.column(4).to_numpy().astype(np.int64) + length)])
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                # Blocks end between buckets only.
                if size >= block_bytes and held[-1].column(0)[-1].as_py() != int(bucket[a]):
                    yield settle(held)
                    held, size = [], 0
                held.append(batch.slice(a, b - a))
                size += int(sizes[b] - sizes[a])
        if held:
            yield settle(held)

    return contexts.mapInArrow(sort, RANGES)


def _joined_ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of covered bytes; ranges that touch are one run."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    first = np.flatnonzero(new)
    return starts[first], ends[np.append(first[1:], len(starts)) - 1]


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def cut_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, split_contexts: int = SPLIT_CONTEXTS, block_bytes: int = BLOCK_BYTES, digest: bool = False) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, and ``kept``, the bytes that stay.

    With ``digest`` the column is ``kept_sha256``, their SHA-256 in hex, and the bytes themselves are not produced.
    """
    spark = docs.sparkSession
    ship_package(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows with equal ids and equal texts share a key; they are copies, so what holds for one holds for the other.
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("key"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    places = _places(docs, length, gram)
    # Stored, so that the join shuffles both sides by itself and a gram that very many places share can be split.
    often = stored(places.groupBy("gram").agg(F.count("*").alias("n_gram")).filter("n_gram > 1").select("gram"), "grams")
    places = stored(places.join(often, "gram"), "places")
    folded = places.groupBy("gram", "context").agg(F.count("*").alias("times"), F.min(F.struct("key", "text_hash", "start", "n", "anchor")).alias("one"))
    folded = stored(folded, "contexts")
    whole = places.join(folded.filter("times > 1").select("gram", "context"), ["gram", "context"]).select("key", "text_hash", "start", (F.col("start") + F.col("n") - 1 + length).cast("int").alias("end"))
    company = folded.groupBy("gram").agg(F.count("*").alias("company"), F.min("times").alias("least")).filter("company > 1 and least = 1").select("gram", "company")
    company = stored(company, "company")
    wanted = folded.join(company, "gram").groupBy("one.key", "one.text_hash").agg(F.collect_list(F.struct("one.start", "one.n", "one.anchor", "gram", "times", "company")).alias("wanted"))
    texts = docs.repartition(tasks, "key", "text_hash")
    contexts = _fetched(texts.join(wanted, ["key", "text_hash"]), length, split_contexts)
    sorted_ = _suffix_sorted(contexts.repartition(tasks, "bucket").sortWithinPartitions("bucket"), length, block_bytes)
    ranges = sorted_.union(whole).groupBy("key", "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    joined = texts.join(ranges, ["key", "text_hash"], "left").select("doc_id", "text", "ranges.start", "ranges.end")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = []
                for doc_id, text, start, end in zip(*(c.to_pylist() for c in part.columns)):
                    text = text.encode()
                    if start:
                        a, b = _joined_ranges(np.array(start), np.array(end))
                        kept = b"".join(text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)]))
                        n = len(a)
                    else:
                        kept, n = text, 0
                    rows.append((doc_id, len(text), len(text) - len(kept), n, hashlib.sha256(kept).hexdigest() if digest else kept))
                kinds = [pa.int64()] * 4 + [pa.string() if digest else pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    result = joined.mapInArrow(cut, RESULT.replace("kept binary", "kept string") if digest else RESULT)
    return result.withColumnRenamed("kept", "kept_sha256") if digest else result


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their repeated 200-byte strings: sizes, spans and the digest of what is left."""
    return cut_repeats(read_documents(spark, sf_dir), digest=True)


QUERIES = {"op4_suffix_dedup": (op4_suffix_dedup, None)}
