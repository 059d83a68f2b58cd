"""Whole texts to token ids with the ``tokenizers`` library, word by word with a bounded memory of known words.

The vocabularies meant here drop white space and never join characters across it,
so the ids of a text are the ids of its words one after another. Invented or not,
words repeat, and one that is known costs a look-up instead of an encoding.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vacancylake.llm.texts import slices, text_bytes, words_of

#: Letters that are their own NFC form, with whatever ends a word in plain marks.
_LATIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!\"#$%&()*+,./:;=?@\\[\\\\\\]^_`{|}~-]*)")
#: Known words kept by a task; about 250 bytes each.
KNOWN_WORDS = 400_000
#: Bytes of text whose distinct words are looked up together.
ENCODE_BYTES = 12 << 20


def _byte_letters() -> list[str]:
    """The letter byte-level vocabularies write for each byte: itself if printable, else the next free one from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class WordEncoder:
    """Ids of many texts at once: distinct words are looked up, then the ids are laid out with numpy."""

    def __init__(self, path: str, known_words: int = KNOWN_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}
        self.known_words = known_words

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another as ``<u4``, and where each text's ids start (one more entry than texts).

        A null is an empty text. ``end`` is appended to every text.
        """
        data, at = text_bytes(texts)
        start, stop = words_of(data)
        offsets = np.zeros(len(start) + 1, np.int32)
        np.cumsum(stop - start, out=offsets[1:])
        inside = np.zeros(len(data) + 1, np.int8)
        inside[start] = 1
        inside[stop] -= 1
        body = data[np.cumsum(inside[:-1], dtype=np.int8).view(bool)] if len(data) else data
        words = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(body))
        coded = pc.dictionary_encode(words)
        ids = self._ids(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        code = np.asarray(coded.indices)
        first = np.searchsorted(start, at)  # the first word of each text
        if end is not None:
            flat, sizes = np.append(flat, np.uint32(end)), np.append(sizes, 1)
            code = np.insert(code, first[1:], len(ids))
            first = first + np.arange(len(first))
        begin = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=begin[1:])
        count = sizes[code]
        out_at = np.zeros(len(code) + 1, np.int64)
        np.cumsum(count, out=out_at[1:])
        take = np.repeat(begin[code] - out_at[:-1], count)
        take += np.arange(out_at[-1])
        return flat[take], out_at[first]

    def _ids(self, words: list[str]) -> list[bytes]:
        if len(self.known) > self.known_words:
            self.known.clear()
        found = list(map(self.known.get, words))
        return [self._word(w) if x is None else x for x, w in zip(found, words)]

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            m = _LATIN.fullmatch(word)
            if m is None or len(word) > 200:
                ids = self._plain(word)
            else:
                low = m[1].lower()
                ids = self._piece(low) + (self._piece(m[2]) if m[2] else b"")
            self.known[word] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        """Ids of letters alone or of marks alone, which the tokenizer never cuts further before merging."""
        ids = self.known.get(piece)
        if ids is None:
            shown = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])
            self.known[piece] = ids
        return ids


@cache
def word_encoder(path: str) -> WordEncoder:
    """One per Python worker, which serves task after task."""
    return WordEncoder(path)


def encoded(batches: Iterator[pa.RecordBatch], path: str, end: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the ids of their ``text`` column."""
    encoder = word_encoder(path)
    for batch in batches:
        for part in slices(batch, most=ENCODE_BYTES):
            yield part, *encoder.encode(part.column(part.schema.get_field_index("text")), end)
