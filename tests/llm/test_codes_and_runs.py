"""Byte-level BPE against tiktoken, word runs and vector codes against plain loops, on small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm.fixtures import AWKWARD, babble, clashing, table
from vacancylake.llm import byte_bpe, vector_codes, word_runs

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["a", "b", " ", "  ", "\n", "é", "中", "'s", "'", "1", "9", "!", "\x1c", "\x85", " ", "　", "ing", "the", "\t", "😀", "A", "Ù", "\u0080"]
BPE_ROWS = AWKWARD + [(1000 + k, "".join(random.Random(k).choice(ODD) for _ in range(40))) for k in range(60)] + [(2000, "ab" * 20_000 + " " * 3_000 + "<|endoftext|>")]


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def by_id(rows):
    return sorted(rows, key=str)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.text_encoder(PATH, PATTERN)


def test_bpe_query_as_the_library_does(spark, library, tmp_path):
    clashing(table(spark, BPE_ROWS)).write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for doc_id, text in BPE_ROWS:
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), digest(np.array(ids, "<u4").tobytes()), digest((text or "").encode())))
    found = byte_bpe.op11_byte_bpe(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert by_id(map(tuple, found.collect())) == by_id(want)
    apart = byte_bpe.with_bytes(byte_bpe.with_ids(table(spark, BPE_ROWS), PATH, PATTERN), PATH)
    assert by_id((r["doc_id"], bytes(r["decoded"])) for r in apart.collect()) == by_id((i, (t or "").encode()) for i, t in BPE_ROWS)


def test_bpe_of_no_rows_and_of_null_ids(spark):
    docs = table(spark, [(1, "some text")])
    assert byte_bpe.with_bytes(byte_bpe.with_ids(docs.limit(0), PATH, PATTERN), PATH).count() == 0
    odd = spark.createDataFrame([(1, None), (2, bytearray())], "doc_id long, ids binary")
    assert [tuple(r) for r in byte_bpe.with_bytes(odd, PATH).orderBy("doc_id").collect()] == [(1, None, None), (2, b"", b"")]


def test_edits_and_appends_give_the_ids_of_the_new_text(spark, library):
    rng = random.Random(3)
    rows, want = [(0, None, None, None, None, "added"), (1, "kept", None, 2, 1, None), (2, "beyond", None, 50, 90, "!")], {0: "added", 1: "kept", 2: "beyond!"}
    for k in range(3, 200):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 60)))
        a = rng.randint(0, len(text))
        b = rng.choice([a, len(text), rng.randint(a, len(text))])
        new = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 5)))
        rows.append((k, text, bytearray(np.array(library.encode_ordinary(text), "<u4").tobytes()), a, b, new))
        want[k] = text[:a] + new + text[b:]
    long = babble(4, 9_000)
    rows.append((500, long, bytearray(np.array(library.encode_ordinary(long), "<u4").tobytes()), 30_000, 30_010, " new words "))
    want[500] = long[:30_000] + " new words " + long[30_010:]
    given = spark.createDataFrame(rows, "doc_id long, text string, ids binary, start int, stop int, new string")
    for r in byte_bpe.with_edits(given, PATH, PATTERN).collect():
        assert r["text"] == want[r["doc_id"]]
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(want[r["doc_id"]])


def test_last_tokens_of_prefixes_survive_edits(encoder, library):
    rng = random.Random(8)
    for _ in range(600):
        data = bytes(rng.choice(b"aab \xc3\x82\x80ethingsr") for _ in range(rng.randint(1, 300)))
        held = byte_bpe.PrefixTokens(encoder.merges, data)
        assert held.tokens() == library._encode_single_piece(data) == byte_bpe.last_tokens(encoder.merges, data)
        a = rng.randint(0, len(data))
        b = rng.randint(a, len(data))
        new = bytes(rng.choice(b"aab ethi") for _ in range(rng.randint(0, 5)))
        held.replace(a, b, new)
        data = data[:a] + new + data[b:]
        assert held.tokens() == (library._encode_single_piece(data) if data else [])
        held.append(b"ing")
        assert held.tokens() == library._encode_single_piece(data + b"ing")


def test_an_edit_looks_at_few_prefixes_and_a_huge_piece_takes_linear_time(encoder):
    rng = random.Random(1)
    data = bytes(rng.choice(b"abcdefgh") for _ in range(400_000))
    began = time.perf_counter()
    held = byte_bpe.PrefixTokens(encoder.merges, data)
    assert time.perf_counter() - began < 10
    assert held.replace(200_000, 200_003, b"zz") < 1_000
    assert held.tokens() == byte_bpe.last_tokens(encoder.merges, data[:200_000] + b"zz" + data[200_003:])


def test_rank_files_that_the_method_cannot_take_are_refused():
    single = {bytes([b]): b for b in range(256)}
    with pytest.raises(ValueError, match="single byte"):
        byte_bpe.Merges({b"a": 0})
    with pytest.raises(ValueError, match="before its halves"):
        byte_bpe.Merges(single | {b"abc": 256, b"ab": 257})
    # an entry that no merges lead to is taken by a whole piece alone
    merges = byte_bpe.Merges(single | {b"ab": 256, b"bc": 257, b"xyz": 258, b"abcd": 259})
    assert merges.halves[258] is None and byte_bpe.last_tokens(merges, b"xyz") == [120, 121, 122]
    with pytest.raises(ValueError, match="outside"):
        byte_bpe.decoder(PATH).decode(np.array([60_000], "<u4"))


def plain_runs(words, least=24, times=3):
    out, n = [], len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            e = i + q
            if e - s >= max(least, times * q) and not any(q % f == 0 and words[s : e - f] == words[s + f : e] for f in range(1, q)):
                out.append((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(rng):
    words = [rng.randint(0, rng.choice([1, 2, 3, 30])) for _ in range(rng.randint(0, 120))]
    for _ in range(rng.randint(0, 3)):
        unit = [rng.randint(0, rng.choice([1, 2, 5, 40])) for _ in range(rng.randint(1, 30))]
        if rng.random() < 0.3:
            unit = unit * 2 + unit[: rng.randint(0, len(unit))]
        k = rng.randint(0, len(words))
        words = words[:k] + unit * rng.randint(2, 6) + unit[: rng.randint(0, len(unit))] + words[k:]
    return words


def test_runs_as_in_plain_loops():
    rng, total = random.Random(5), 0
    for _ in range(300):
        texts = [repetitive(rng) for _ in range(rng.randint(1, 4))]
        least, times = rng.choice([(24, 3), (24, 3), (6, 3), (3, 3), (24, 4), (10, 3)])
        at = np.cumsum([0, *map(len, texts)]).tolist()
        want = [(s + o, n, q) for w, o in zip(texts, at) for s, n, q in plain_runs(w, least, times)]
        found = word_runs.find_runs(np.array(sum(texts, []), np.int64), np.repeat(np.arange(len(texts)), [len(w) for w in texts]), least, times)
        assert list(map(tuple, found.tolist())) == want
        total += len(want)
    assert total > 500


def test_two_words_and_long_texts_take_little_time():
    one, two = [0], [0, 1]
    while len(two) < 200_000:
        one, two = two, two + one
    began = time.perf_counter()
    assert len(word_runs.find_runs(np.array(two), np.zeros(len(two), np.int64))) > 1_000
    noise = np.random.default_rng(1).integers(0, 2, 200_000)
    word_runs.find_runs(noise, np.zeros(len(noise), np.int64))
    assert time.perf_counter() - began < 30


RUN_ROWS = AWKWARD + [(k, babble(k, 20 + 3 * k, 60)) for k in range(120)] + [(300, "Tie " * 30 + "x " + "tie " * 30), (301, " ".join(babble(7, 11).split() * 5)), (302, "a b " * 20 + babble(2, 40) + " c d" * 20)]


def planted_words(doc_id, text):
    words = WORD.findall(text or "")
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_runs_query_as_in_plain_loops(spark, tmp_path):
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in RUN_ROWS) > 5
    rows = [(i, t) for i, t in RUN_ROWS if len(t or "") < 50_000]  # the plain loops are slow
    clashing(table(spark, rows)).write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for doc_id, text in rows:
        words = planted_words(doc_id, text)
        runs = plain_runs(words)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        left = " ".join(w for k, w in enumerate(words) if k not in gone)
        want.append((doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), digest(left.encode())))
    found = word_runs.op12_word_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert by_id(map(tuple, found.collect())) == by_id(want)
    assert word_runs.with_runs(table(spark, rows).limit(0)).count() == 0


def test_a_long_text_keeps_its_one_planted_run(spark):
    unit = babble(12, 4_000, 3_000).split()
    text = " ".join(babble(13, 10_000, 5_000).split() + unit * 3 + unit[:7] + ["end"])
    row = word_runs.with_runs(table(spark, [(1, text)])).first()
    longest = max(row["runs"], key=lambda r: r["length"])
    assert longest["period"] == 4_000 and longest["length"] >= 12_007
    assert len(row["collapsed"].split()) <= len(text.split()) - 8_000


def test_of_equally_strong_runs_the_first_counts(spark):
    runs = [(40, 24, 2), (5, 36, 3), (90, 12, 1), (7, 12, 1)]
    one = spark.createDataFrame([(sorted(runs),), ([],)], "runs array<struct<start:long,length:long,period:long>>")
    found = [r[0] for r in one.select(word_runs.strongest(F.col("runs"))).collect()]
    assert tuple(found[0]) == (5, 36, 3) and found[1] is None


def plain_codes(rows):
    rows = [(i, [math.floor(4096 * float(x)) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [r for r in rows if len(r[1]) == len(rows[0][1])]
    if not rows:
        return [], []
    width = len(rows[0][1]) // 8
    parts = [[r[1][k * width : (k + 1) * width] for r in rows] for k in range(8)]
    books = [[list(x) for x in p[:16]] for p in parts]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(6):
        for p, book in zip(parts, books):
            groups = {}
            for x in p:
                groups.setdefault(nearest(x, book)[1], []).append(x)
            for k, xs in groups.items():
                book[k] = [sum(c) // len(xs) for c in zip(*xs)]
    found = [[nearest(x, book) for x in p] for p, book in zip(parts, books)]
    errors = [sum(f[k][0] for f in found) for k in range(len(rows))]
    totals = {}
    for (_, _, lab), e in zip(rows, errors):
        totals[lab] = totals.get(lab, 0) + e
    text = digest(",".join(str(c) for book in books for e in book for c in e).encode())
    return [(r[0], "".join(f"{f[k][1]:02x}" for f in found), errors[k], totals[r[2]], text) for k, r in enumerate(rows)], books


def vectors(n, seed=1, width=16):
    rng = np.random.default_rng(seed)
    return [(int(k), [float(x) for x in rng.normal(0, 0.1, width).astype(np.float32)], int(k) % 3 if k % 7 else None) for k in rng.permutation(n)]


VECTOR_CASES = {
    "many": vectors(150) + [(200 + k, v, 1) for k, (_, v, _) in enumerate(vectors(150)[:40])],
    "odd": vectors(40) + [(41, None, 1), (42, [None] * 16, 1), (43, [float("nan")] * 16, 2), (44, [float("inf")] * 16, 2), (45, [0.5] * 8, 1), (None, [0.25] * 16, None), (3, [0.125] * 16, 5), (46, [], 1)],
    "few": vectors(5),
    "equal": [(k, [-0.3] * 16, 0) for k in range(30)],
    "none": [],
    "null": [(1, None, 1)],
    "large": vectors(30) + [(99, [3e4] * 16, 1), (98, [-3e4] * 16, 1)],
}


@pytest.mark.parametrize("case", VECTOR_CASES)
def test_vector_codes_as_in_plain_loops(spark, tmp_path, case):
    rows = VECTOR_CASES[case]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    given.select("*", *[F.lit("own").alias(c) for c in ("v", "codes", "error", "salt", "part", "n", "label_error")]).write.parquet(str(tmp_path / "embeddings.parquet"))
    found = vector_codes.op13_vector_codes(spark, str(tmp_path))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert by_id(map(tuple, found.collect())) == by_id(plain_codes(rows)[0])


def test_cells_leave_out_entries_and_never_the_nearest():
    rng = np.random.default_rng(4)
    points = rng.normal(0, 500, (3_000, 8)).astype(np.int64)
    entries = points[:16] // 64 * 64  # coarse entries make ties
    entries[5] = entries[3]
    distance = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    for bits in (3, 6, 7, 9):
        cells = vector_codes.Cells(entries, bits, known_cells=700)
        for a in range(0, len(points), 500):
            best, least = cells.nearest(points[a : a + 500])
            assert (best == distance[a : a + 500].argmin(axis=1)).all() and (least == distance[a : a + 500].min(axis=1)).all()
        assert len(cells.known) <= 700
        if bits <= 6:
            assert cells.evaluated < 0.4 * 16 * cells.points


def test_dimensions_that_parts_do_not_divide(spark):
    rows = [(k, [0.1 * k, 0.2, -0.3 * k], 0) for k in range(4)]
    numbers = vector_codes.whole_numbers(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    books = vector_codes.learn(numbers)
    assert [b.shape[1] for b in books] == [0, 0, 1, 0, 0, 1, 0, 1]
    assert {r["error"] for r in vector_codes.with_codes(numbers, books).collect()} == {0}
