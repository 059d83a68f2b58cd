"""Byte-level BPE by prefix dynamic programming: encoding, decoding, exact appends and edits.

The merges of a rank file leave every prefix of a byte string with one encoding, and all its tokens but the last are the
encoding of a shorter prefix. So it is enough to store, for every prefix, its last token: of the tokens that end there, the
one that the merges leave apart from the last token of the prefix before it. Whether two tokens stay apart is found by undoing
the merges that made them, latest first, and looking for a merge across their border that would have come earlier. Time is
linear in the string for any content; appended bytes need the last tokens near the old end alone, and an edit is over as soon as as
many last tokens as the longest token has bytes agree with those before the edit.

Texts are cut by a pattern first, each match being encoded by itself. A match never starts before and ends after a place
where white space follows something else, so a text is handled in stretches between such places; a stretch that is known
costs a look-up. A piece that is itself an entry of the rank file is that entry, as in the ``tiktoken`` library, also where no
merges lead to it.

Cases: a null text counts as empty, and an empty one has no ids; equal rows and equal or null doc_ids give a row each; other
columns are ignored; null ids decode to null; ids outside the rank file and rank files without every single byte, or with an
entry that ranks before its own halves, raise ValueError; no rows give no rows.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylake.llm.texts import read_documents, slices, text_bytes, words_of
from vacancylake.session import ship_package

#: Known stretches and pairs of tokens kept by a task.
KNOWN_TEXTS = 300_000
KNOWN_PAIRS = 300_000
#: Bytes of text whose distinct stretches are looked up together.
ENCODE_BYTES = 4 << 20
_NEVER = 1 << 62
#: Whether the machine's own unsigned integers are the ones written.
_NATIVE = sys.byteorder == "little" and array("I").itemsize == 4
#: White space other than space and the controls 9 to 13, as the last three bytes of its UTF-8 form (0: any byte).
_WIDE_SPACE = regex.compile(r"[^\S\x20\x09-\x0D]")
#: Between something that is no white space and plain white space.
_CUT = regex.compile(r"(?<=\S)(?=[\x20\x09-\x0D])")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _last_two(word: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """What plain merging (lowest rank first, then leftmost) makes of ``word`` before its last merge; None if it gets stuck."""
    parts = [word[k : k + 1] for k in range(len(word))]
    while len(parts) > 2:
        rank, at = min((ranks.get(parts[k] + parts[k + 1], _NEVER), k) for k in range(len(parts) - 1))
        if rank == _NEVER:
            return None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


class Merges:
    """What a rank file says about its tokens: the halves of each, and which tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the rank file lacks a single byte")
        self.ranks = ranks
        n = max(ranks.values()) + 1
        self.size = [0] * n
        self.halves: list[tuple[int, int] | None] = [None] * n
        self.made: dict[int, int] = {}  # halves to token, both halves in one number
        self.ending = ahocorasick.Automaton()
        for word, token in ranks.items():
            self.size[token] = len(word)
            if len(word) > 1:
                two = _last_two(word, ranks)
                if two is None:
                    continue
                left, right = ranks[two[0]], ranks[two[1]]
                if (len(two[0]) > 1 and left > token) or (len(two[1]) > 1 and right > token):
                    raise ValueError(f"token {token} ranks before its halves")
                self.halves[token] = left, right
                self.made[left << 32 | right] = token
            self.ending.add_word(word.decode("latin-1"), token)
        self.ending.make_automaton()
        self.longest = max(self.size)
        self.known: dict[int, bool] = {}

    def apart(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives just these two."""
        key = left << 32 | right
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= KNOWN_PAIRS:
                self.known.clear()
            found = self.known[key] = self._apart(left, right)
        return found

    def _apart(self, left: int, right: int) -> bool:
        # A merge across the border ranks below ``before`` if it would have come first. Equal ranks merge from the left.
        before = _NEVER
        while self.made.get(left << 32 | right, _NEVER) >= before:
            a, b = self.halves[left], self.halves[right]
            if a is not None and (b is None or left > right):
                before, left = left, a[1]
            elif b is not None:
                before, right = right + 1, b[0]
            else:
                return True
        return False


def last_tokens(merges: Merges, word: bytes) -> list[int]:
    """The tokens of ``word``; its prefixes' last tokens are not kept."""
    last = [-1] * (len(word) + 1)
    size, known, apart = merges.size, merges.known, merges.apart
    for end, token in merges.ending.iter(word.decode("latin-1")):
        if last[end + 1] < 0:
            first = end + 1 - size[token]
            if not first:
                last[end + 1] = token
            else:
                fits = known.get(last[first] << 32 | token)
                if fits is None:
                    fits = apart(last[first], token)
                if fits:
                    last[end + 1] = token
    out, at = [], len(word)
    while at:
        out.append(last[at])
        at -= size[out[-1]]
    return out[::-1]


class PrefixTokens:
    """A byte string and the last token of every prefix of it."""

    def __init__(self, merges: Merges, data: bytes = b""):
        self.merges = merges
        self.data = bytearray()
        self.last = array("i", [-1])
        self.append(data)

    def append(self, more: bytes) -> None:
        self.replace(len(self.data), len(self.data), more)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in the place of bytes [start, stop); returns how many prefixes were looked at."""
        merges, old = self.merges, self.last
        shift = len(new) - (stop - start)
        self.data[start:stop] = new
        n = len(self.data)
        last = old[: start + 1] + array("i", [-1]) * (n - start)
        begin = max(0, start + 1 - merges.longest)
        same, settled = 0, start + len(new)
        size, apart = merges.size, merges.apart
        done = n
        for end, token in merges.ending.iter(self.data[begin:].decode("latin-1")):
            at = begin + end + 1
            if at <= start or last[at] >= 0:
                continue
            first = at - size[token]
            if first and not apart(last[first], token):
                continue
            last[at] = token
            if at >= settled:
                same = same + 1 if at - shift < len(old) and old[at - shift] == token else 0
                if same >= merges.longest:
                    done = at
                    break
        if done < n:
            last[done + 1 :] = old[done + 1 - shift :]
        self.last = last
        return done - start

    def tokens(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            out.append(self.last[at])
            at -= self.merges.size[out[-1]]
        return out[::-1]


class Decoder:
    """The bytes of every id; all that decoding needs to hold."""

    def __init__(self, ranks: dict[bytes, int]):
        words = [b""] * (max(ranks.values()) + 1)
        for word, token in ranks.items():
            words[token] = word
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.bytes = np.frombuffer(b"".join(words), np.uint8)
        self.begin = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of ``ids`` one after another, and where each id's bytes start (one more entry than ids)."""
        if len(ids) and (int(ids.max()) >= len(self.sizes) or not self.sizes[ids].all()):
            raise ValueError("ids outside the rank file")
        return _gather(self.bytes, self.begin, self.sizes, ids)


class TextEncoder:
    """Ids of texts: cut by a pattern, each piece by its prefixes' last tokens, known stretches from memory."""

    def __init__(self, path: str, pattern: str, known_texts: int = KNOWN_TEXTS):
        ranks = read_ranks(path)
        self.merges = Merges(ranks)
        self.pieces = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.known_texts = known_texts
        self.decoder = Decoder(ranks)
        self.sizes = self.decoder.sizes

    def _piece(self, piece: str) -> bytes:
        ids = self.known.get(piece)
        if ids is None:
            word = piece.encode()
            whole = self.merges.ranks.get(word)
            ids = self._keep(piece, [whole] if whole is not None else last_tokens(self.merges, word))
        return ids

    def _stretch(self, text: str) -> bytes:
        ids = self.known.get(text)
        if ids is None:
            pieces = self.pieces.findall(text)
            if len(pieces) == 1:
                return self._piece(text)
            ids = b"".join([self._piece(p) for p in pieces])
            self._keep(text, ids)
        return ids

    def _keep(self, text: str, ids: list[int] | bytes) -> bytes:
        if not isinstance(ids, bytes):
            ids = array("I", ids).tobytes() if _NATIVE else np.array(ids, "<u4").tobytes()
        if len(text) <= 200:
            if len(self.known) >= self.known_texts:
                self.known.clear()
            self.known[text] = ids
        return ids

    def encode_text(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self._stretch(s) for s in _stretches(text)), "<u4")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another as ``<u4``, and where each text's ids start (one more entry than texts)."""
        data, at = text_bytes(texts)
        begin, end = _stretch_bounds(data, at)
        offsets = np.zeros(len(begin) + 1, np.int32)
        np.cumsum(end - begin, out=offsets[1:])
        inside = np.ones(len(data), bool)
        inside[at[1:] - 1] = False
        stretches = pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
        coded = pc.dictionary_encode(stretches)
        ids = [self._stretch(s) for s in coded.dictionary.to_pylist()]
        code = np.asarray(coded.indices)
        count = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, out_at = _gather(np.frombuffer(b"".join(ids), "<u4"), np.cumsum(count) - count, count, code)
        return flat, out_at[np.searchsorted(begin, at)]

    def edit(self, text: str, ids: np.ndarray, start: int, stop: int, new: str) -> tuple[str, np.ndarray]:
        """``text`` with code points [start, stop) replaced, and its ids: only stretches that the edit touches are encoded."""
        left = max((m.start() for m in _CUT.finditer(text, max(0, start - 4096), start) if m.start() < start), default=0)
        if left == 0 and start > 4096:
            left = max((m.start() for m in _CUT.finditer(text, 0, start) if m.start() < start), default=0)
        after = _CUT.search(text, min(stop + 1, len(text)))
        right = after.start() if after else len(text)
        lengths = np.cumsum(self.sizes[ids])
        head = int(np.searchsorted(lengths, len(text[:left].encode()), "right")) if left else 0
        tail = int(np.searchsorted(lengths, len(text[:right].encode()), "right")) if right else 0
        middle = text[left:start] + new + text[stop:right]
        return text[:left] + middle + text[right:], np.concatenate([ids[:head], self.encode_text(middle), ids[tail:]])


def _gather(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries ``chosen`` of lists laid out in ``flat``, one after another, and where each starts."""
    count = size[chosen]
    at = np.zeros(len(chosen) + 1, np.int64)
    np.cumsum(count, out=at[1:])
    take = np.repeat(begin[chosen] - at[:-1], count)
    take += np.arange(at[-1])
    return flat[take], at


def _stretches(text: str) -> list[str]:
    cuts = [0, *(m.start() for m in _CUT.finditer(text)), len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def _stretch_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of all stretches of the texts in ``data`` (as ``text_bytes`` gives them)."""
    first, end = words_of(data)
    stop = at[1:] - 1
    cut = end[end < stop[np.searchsorted(at, first, "right") - 1]]
    # A word that ends in white space of several bytes goes on in the white space behind it.
    one, two, three = (data[np.maximum(cut - k, 0)] for k in (1, 2, 3))
    wide = (one >= 0x80) & ((two == 0xC2) | (two == 0x9A) | (two == 0x80) | (two == 0x81))
    for k in np.flatnonzero(wide).tolist():
        tail = bytes([three[k], two[k], one[k]]).decode(errors="ignore")
        wide[k] = bool(tail) and _WIDE_SPACE.match(tail[-1]) is not None
    begin = np.sort(np.concatenate([at[:-1][stop > at[:-1]], cut[~wide]]))
    after = np.append(begin[1:], len(data))
    return begin, np.minimum(after, stop[np.searchsorted(at, begin, "right") - 1])


@cache
def text_encoder(path: str, pattern: str) -> TextEncoder:
    """One per Python worker, which serves task after task."""
    return TextEncoder(path, pattern)


@cache
def decoder(path: str) -> Decoder:
    return Decoder(read_ranks(path))


def _lists(flat: np.ndarray, at: np.ndarray) -> pa.Array:
    """Entries of ``flat`` from at[k] to at[k + 1] as one binary value each."""
    offsets = at * flat.itemsize
    if offsets[-1] >= 1 << 31:
        raise ValueError("a text has over 2 GB of ids")
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))])


def with_ids(docs: DataFrame, path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) reduced to doc_id and ``ids``: little-endian unsigned 32-bit integers as one binary value.

    ``decoded`` adds the bytes that the ids stand for, without another pass through Python workers.
    """
    ship_package(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path, pattern)
        for batch in batches:
            for part in slices(batch, most=ENCODE_BYTES):
                ids, at = encoder.encode(part.column(1))
                columns = {"doc_id": part.column(0), "ids": _lists(ids, at)}
                if decoded:
                    data, begin = encoder.decoder.decode(ids)
                    columns["decoded"] = _lists(data, begin[at])
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kinds = "doc_id long, ids binary" + (", decoded binary" if decoded else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, kinds)


def with_bytes(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` (doc_id, ids) with ``decoded``, the bytes that the ids stand for."""
    ship_package(tokens.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "ids", ENCODE_BYTES):
                ids = part.column(1)
                sizes = pc.fill_null(pc.binary_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64) // 4
                at = np.zeros(len(sizes) + 1, np.int64)
                np.cumsum(sizes, out=at[1:])
                flat = np.frombuffer(b"".join(x or b"" for x in ids.to_pylist()), "<u4")
                data, begin = decoder(path).decode(flat)
                out = pc.if_else(ids.is_null(), None, _lists(data, begin[at]))
                yield pa.RecordBatch.from_arrays([part.column(0), ids, out], ["doc_id", "ids", "decoded"])

    return tokens.select(F.col("doc_id").cast("long"), "ids").mapInArrow(decode, "doc_id long, ids binary, decoded binary")


def with_edits(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """Texts and ids after one edit of each row (doc_id, text, ids, start, stop, new), offsets in code points.

    Only what the edit touches is encoded again. An append is an edit at the end; a null start or stop means the end, a null
    ``new`` is empty, null ids are found from the text first, and offsets beyond the end mean the end.
    """
    ship_package(rows.sparkSession)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path, pattern)
        for batch in batches:
            for part in slices(batch, most=ENCODE_BYTES):
                texts, ids = [], []
                for _, text, known, start, stop, new in zip(*[c.to_pylist() for c in part.columns]):
                    text = text or ""
                    start = len(text) if start is None else min(max(start, 0), len(text))
                    stop = len(text) if stop is None else min(max(stop, start), len(text))
                    now = encoder.encode_text(text) if known is None else np.frombuffer(known, "<u4")
                    text, now = encoder.edit(text, now, start, stop, new or "")
                    texts.append(text)
                    ids.append(now.tobytes())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), pa.array(ids, pa.binary())], ["doc_id", "text", "ids"])

    columns = [F.col("doc_id").cast("long"), "text", "ids", F.col("start").cast("long"), F.col("stop").cast("long"), "new"]
    return rows.select(*columns).mapInArrow(edit, "doc_id long, text string, ids binary")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the bytes they decode to, as digests."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    found = with_ids(read_documents(spark, sf_dir), path, pattern, decoded=True)
    return found.select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op11_byte_bpe": (op11_byte_bpe, None)}
