"""Token files, packing, suffix dedup, language model, SimHash and the pipeline against brute force on small tables."""

from __future__ import annotations

import hashlib
import io
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.fixtures import AWKWARD, babble, clashing, table
from vacancylake.llm import elias_fano, language_model, packing, simhash, suffix_dedup, token_files, token_ids
from vacancylake.session import new_shared_path

PATH = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_word_encoder_equals_the_tokenizer(plain):
    odd = [t for _, t in AWKWARD[:-4]] + [
        "<|endoftext|> a<|startoftext|>b it's we'll I'd,. 12ab", "Σας ΟΔΟΣ İstanbul éa ́x", "a b　c\x1cd\x85e\x1c", "x" * 1000, "ÀÉß×÷ÿ! Straße's ''s --",
        "​zero ﬁ 中文字 12 ½", "don't'tree A.B.C o'clock 's't'x", "ª º µ `~^_", babble(3, 500),
    ]
    encoder = token_ids.WordEncoder(PATH, known_words=50)
    for _ in range(2):  # the second time with the memory of known words cleared in between
        ids, at = encoder.encode(pa.array(odd), 7)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [plain(t) + [7] for t in odd]
    assert encoder.encode(pa.array([], pa.string()))[1].tolist() == [0]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_word_encoder_on_any_text(plain, texts):
    ids, at = token_ids.word_encoder(PATH).encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [plain(t) for t in texts]


def written(frame_ids=50):
    out = io.BytesIO()
    writer = token_files.TokenFileWriter(out, pa.int64(), frame_ids=frame_ids)
    rng = np.random.default_rng(0)
    sizes = [0, 3, 120, 47, 50, 1, 0, 333]
    docs = [rng.integers(0, 60_000, n).astype("<u4") for n in sizes]
    writer.append(pa.array([None, 1, 2, 2]), np.concatenate(docs[:4]), np.cumsum([0, *sizes[:4]]))
    writer.append(pa.array([5, 7, 9, 9]), np.concatenate(docs[4:]), np.cumsum([0, *sizes[4:]]))
    writer.close()
    return out, docs


def test_a_reader_decompresses_only_what_it_needs():
    out, docs = written()
    file = token_files.TokenFile(out)
    assert [file.ids(k).tolist() for k in range(len(docs))] == [d.tolist() for d in docs]
    file = token_files.TokenFile(out)
    assert file.find([1]) == [1] and file.ids(1).tolist() == docs[1].tolist() and file.frames_read == 1
    assert file.find([9, 2, 6]) == [2, 3, 6, 7]
    # Plain zstandard readers see the ids alone.
    data = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(out.getvalue())
    assert np.frombuffer(data, "<u2").tolist() == np.concatenate(docs).tolist()


def test_a_changed_byte_is_noticed():
    out, docs = written()
    raw = bytearray(out.getvalue())
    raw[40] ^= 1
    file = token_files.TokenFile(io.BytesIO(bytes(raw)))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        file.ids(2)


def test_token_files_round_trip(spark, plain):
    rows = AWKWARD + [(k, babble(k, 40)) for k in range(50)]
    folder = "file://" + new_shared_path(spark, "ids").removeprefix("file://")
    token_files.write_token_files(clashing(table(spark, rows)), folder, PATH, 1)
    found = token_files.read_token_files(spark, folder).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids"]) for r in found) == Counter((i, len(x), np.array(x, "<u4").tobytes()) for i, t in rows for x in [plain(t) + [1]])
    at = 0
    for r in sorted(found, key=lambda r: r["start"] * 10**6 + r["n_tokens"]):
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert ids == sorted(ids)
    empty = folder + "-empty"
    token_files.write_token_files(table(spark, rows).limit(0), empty, PATH, 1)
    assert token_files.read_token_files(spark, empty).count() == 0


def placed(plan, histogram):
    sequences = defaultdict(list)
    for size, n in histogram.items():
        own = np.flatnonzero(plan.length == size)
        for rank in range(n):
            k = own[np.searchsorted(plan.rank[own], rank, side="right") - 1]
            over = rank - plan.rank[k]
            sequences[int(plan.sequence[k] + over // plan.each[k])].append((int(plan.offset[k] + over % plan.each[k] * size), size))
    return sequences


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 100), st.integers(1, 40), max_size=25))
def test_plans_place_every_piece_once_without_gaps(histogram):
    plan = packing.plan_packing(histogram, 100, rounds=40, classes=20)
    sequences = placed(plan, histogram)
    assert len(sequences) == plan.n_sequences >= plan.bound
    for own in sequences.values():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at <= 100
    bins: list[int] = []
    for size in sorted((s for s, n in histogram.items() for _ in range(n)), reverse=True):
        fit = max((b for b in range(len(bins)) if bins[b] + size <= 100), key=lambda b: bins[b], default=None)
        if fit is None:
            bins.append(size)
        else:
            bins[fit] += size
    assert plan.n_sequences <= math.ceil(1.06 * len(bins)) + 1


def test_many_short_pieces_reach_the_bound():
    rng = np.random.default_rng(3)
    histogram = Counter(np.minimum(rng.lognormal(5.5, 1, 30_000).astype(int) + 1, 2048).tolist())
    plan = packing.plan_packing(histogram)
    assert plan.n_sequences <= plan.bound + 3


def test_packing_rows(spark, plain):
    rows = AWKWARD + [(k, babble(k, 60 + 40 * (k % 9))) for k in range(40)] + [(950, babble(7, 3000))] * 2
    out = packing.pack_documents(clashing(table(spark, rows)), PATH).collect()
    want = Counter()
    for i, t in rows:
        ids = plain(t) + [0]
        want.update((i, k // 2048, k, len(ids[k : k + 2048]), crc(ids[k : k + 2048])) for k in range(0, len(ids), 2048))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    sequences = defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(own)]).tolist()]
        assert [o for o, _ in sorted(own)] == ends[:-1] and ends[-1] <= 2048
    assert packing.pack_documents(table(spark, rows).limit(0), PATH).count() == 0


def brute_cut(texts, length):
    seen = Counter(t[s : s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for t in texts:
        mask = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if seen[t[s : s + length]] > 1:
                mask[s : s + length] = True
        runs = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~mask].tobytes()
        out.append((len(t), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([24, 40, 64]), st.sampled_from([60, 1 << 18]))
def test_suffix_sorting_in_a_block(seed, length, bucket):
    rng = np.random.default_rng(seed)
    base = rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(80, 1500))).astype(np.uint8)
    parts = [base]
    for _ in range(4):
        a = int(rng.integers(0, len(base) - 40))
        parts += [base[a : a + int(rng.integers(20, 300))], rng.integers(97, 123, int(rng.integers(1, 30))).astype(np.uint8)]
    text = np.concatenate(parts)
    starts = np.flatnonzero(rng.random(len(text) - length + 1) < 0.7)
    windows = Counter(text[s : s + length].tobytes() for s in starts)
    assert suffix_dedup.repeated(text, starts, length, bucket).tolist() == [windows[text[s : s + length].tobytes()] > 1 for s in starts]


@pytest.mark.parametrize("split", [2000, 1])
def test_suffix_dedup_equals_brute_force(spark, split):
    base = [babble(k, 120) for k in range(6)]
    rows = [(k, b) for k, b in enumerate(base)] + [(20, base[0]), (20, base[0]), (None, base[1][100:420]), (21, base[2][:300] + "é" + base[2][301:]), (22, base[3][:250] + base[4][50:300])]
    rows += [(30 + k, f"{babble(40 + k, 20)} {base[5][60:330]} {babble(80 + k, 20)}") for k in range(12)]
    rows += [(k, t[:3000] if t else t) for k, t in AWKWARD]
    out = suffix_dedup.cut_repeats(clashing(table(spark, rows)), split_contexts=split, block_bytes=3000, digest=True).collect()
    want = brute_cut([(t or "").encode() for _, t in rows], 200)
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out)
    assert got == Counter((i, *w) for (i, _), w in zip(rows, want))
    assert suffix_dedup.cut_repeats(table(spark, rows).limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 10**13), st.integers(0, 10**6), st.integers(0, 3000))
def test_elias_fano_successors(universe, seed, n):
    rng = np.random.default_rng(seed)
    values = np.unique(rng.integers(0, universe, n))
    sequence = elias_fano.Sequence(elias_fano.encode(values, universe))
    targets = np.concatenate([values, rng.integers(0, universe + 5, 200), [0, universe - 1, universe]]).astype(np.int64)
    place, equal = sequence.successor(targets)
    assert (place == np.searchsorted(values, targets)).all() and (equal == np.isin(targets, values)).all()


@pytest.mark.parametrize("run", [1, 63, 64, 65, 500])
def test_elias_fano_successors_among_long_runs(run):
    # Numbers that stand together share their high part: many ones before the next zero.
    values = np.concatenate([np.arange(run) + k * 10**9 for k in range(1, 40)] + [np.arange(5) + 39 * 10**9 + 10**6])
    sequence = elias_fano.Sequence(elias_fano.encode(values, 41 * 10**9))
    targets = np.concatenate([values - 1, values, values + 1, [0, 41 * 10**9]])
    place, equal = sequence.successor(targets)
    assert (place == np.searchsorted(values, targets)).all() and (equal == np.isin(targets, values)).all()


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["\n"]


def plain_model(texts, least=2):
    """Interpolated absolute discounting with dictionaries; gives (counts, N, log10 probability of a text)."""
    words, pairs, triples = Counter(), Counter(), Counter()
    for t in texts:
        w = ["\t", *tokens(t)]
        words.update(w[1:])
        pairs.update(zip(w, w[1:]))
        triples.update(zip(w, w[1:], w[2:]))
    n, v = words.total(), len(words)

    def discount(c):
        one, two = (sum(x == k for x in c.values()) for k in (1, 2))
        return min(0.95, max(0.05, one / max(one + 2 * two, 1)))

    d2, d3 = discount(pairs), discount(triples)
    inside = defaultdict(lambda: [0, 0])
    for c in (pairs, triples):
        for k, x in c.items():
            if x >= least:
                inside[k[:-1]][0] += x
                inside[k[:-1]][1] += 1

    def p1(x):
        return (words[x] + 1) / (n + v + 1)

    def p2(b, x):
        total = len(texts) if b == "\t" else words[b]
        rest = 1 - (inside[b,][0] - d2 * inside[b,][1]) / total if (b,) in inside else 1
        return (pairs[b, x] - d2) / total * (pairs[b, x] >= least) + rest * p1(x) if total else p1(x)

    def p3(a, b, x):
        if pairs[a, b] < least:
            return p2(b, x)
        rest = 1 - (inside[a, b][0] - d3 * inside[a, b][1]) / pairs[a, b] if (a, b) in inside else 1
        return (triples[a, b, x] - d3) / pairs[a, b] * (triples[a, b, x] >= least) + rest * p2(b, x)

    def log(t):
        w = ["\t", *tokens(t)]
        return math.log10(p2(*w[:2])) + sum(math.log10(p3(*k)) for k in zip(w, w[1:], w[2:])), sum(math.log10(p1(x)) for x in w[1:])

    return words, n, log


@pytest.mark.parametrize("least", [1, 2, 3])
def test_language_model_equals_dictionaries(spark, least):
    # Sentences of one pool in ever new orders: what a model of word sequences can learn.
    pool = [babble(k, 8) for k in range(30)]
    mixed = lambda k: " ".join(pool[(k * k + 7 * j * j + j) % 30] for j in range(12))
    train = [(k, mixed(k)) for k in range(40)] + AWKWARD[1:]
    model = language_model.train(clashing(table(spark, train)), least)
    words, n, log = plain_model([t for _, t in train], least)
    held = [(100 + k, mixed(50 + k)) for k in range(15)] + AWKWARD + [(200, "Never SEEN these words")]
    found = language_model.score(clashing(table(spark, held)), model, "lang").collect()
    assert model[1] == n and len(found) == len(held)
    want = {}
    for i, t in held:
        want.setdefault(i, []).append((len(tokens(t)), sum(words[x] > 0 for x in tokens(t)), *log(t)))
    for r in found:
        near = [w for w in want[r["doc_id"]] if w[:2] == (r["n_tokens"], r["n_known"]) and abs(w[3] - r["base_score"]) < 1e-6 * (1 + abs(w[3])) and abs(w[2] - r["score"]) < 2e-3 * r["n_tokens"]]
        assert near, r
    fresh = [r for r in found if 100 <= (r["doc_id"] or 0) < 115]
    assert sum(r["score"] for r in fresh) > 0.6 * sum(r["base_score"] for r in fresh)


def test_long_words_that_sums_cannot_tell_apart_are_words_of_their_own(spark):
    one = "a"
    while len(one) < 4096:  # the Thue-Morse word and its complement agree in every sum modulo 2^64 by powers of an odd number
        one += one.translate(str.maketrans("ab", "ba"))
    two = one.translate(str.maketrans("ab", "ba"))
    model = language_model.train(table(spark, [(1, f"{one} x"), (2, one)]))
    rows = language_model.score(table(spark, [(3, one), (4, two)]), model).orderBy("doc_id").collect()
    assert [r["n_known"] for r in rows] == [2, 1]


def test_every_word_pair_and_triple_is_looked_up_once_and_in_order(spark, monkeypatch):
    pool = [babble(k, 8) for k in range(20)]
    texts = [" ".join(pool[(k * k + 7 * j * j + j) % 20] for j in range(12)) for k in range(40)]
    m = language_model.Model(*language_model.train(table(spark, list(enumerate(texts)))))
    search, take, seen = language_model.Level.search, language_model.Level.take, Counter()

    def searched(self, targets, exact=True):
        assert (targets[1:] > targets[:-1]).all()
        seen["search"] += 1
        return search(self, targets, exact)

    def taken(self, name, places):
        assert (places[1:] > places[:-1]).all()
        seen["take"] += 1
        return take(self, name, places)

    monkeypatch.setattr(language_model.Level, "search", searched)
    monkeypatch.setattr(language_model.Level, "take", taken)
    found = m.score(pa.array([*texts, None, "words never seen", *texts]))
    assert (found[0] > 0).all() and (found[3][:40] == found[3][42:]).all() and seen["search"] >= 5 and seen["take"] >= 5


def test_no_python_step_stands_before_the_ranges_of_pairs_and_triples(spark, monkeypatch):
    # Spark finds the bounds of ranges by running what stands before them, and then runs it again.
    ranged, before = type(spark.range(0)).repartitionByRange, {}

    def recorded(df, *columns):
        before[columns] = df._jdf.queryExecution().optimizedPlan().toString()
        return ranged(df, *columns)

    monkeypatch.setattr(type(spark.range(0)), "repartitionByRange", recorded)
    language_model.train(table(spark, [(k, babble(k % 5, 30)) for k in range(20)]))
    plans = [plan for columns, plan in before.items() if columns != ("key",)]
    assert len(plans) == 3 and not any("MapInArrow" in plan for plan in plans)


def test_language_model_without_training_rows(spark):
    docs = table(spark, AWKWARD)
    model = language_model.train(docs.limit(0))
    rows = language_model.score(docs, model).collect()
    assert len(rows) == len(AWKWARD) and all(r["n_known"] == 0 and r["score"] == 0 for r in rows)
    assert language_model.score(docs.limit(0), language_model.train(docs)).count() == 0


def plain_fingerprint(text, n=3):
    words = tokens(text)[:-1]
    shingles = [" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark):
    base = [babble(k, 300, 900) for k in range(30)]
    rows = [(10 * k, b) for k, b in enumerate(base)] + [(1000 + k, base[k % 30].replace(" ", "  ", 3) if k % 2 else base[k % 30].rsplit(" ", 1)[0]) for k in range(60)]
    rows += [(i, t if t is None else t[:20_000]) for i, t in AWKWARD]
    out = simhash.near_duplicates(clashing(table(spark, rows))).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(top(k), []).append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in least.items()}
    want = Counter((i, p, least[top(k)]) for k, ((i, _), p) in enumerate(zip(rows, prints)))
    assert Counter((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in out) == want
    docs = clashing(table(spark, rows))
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and Counter(r["doc_id"] for r in kept.collect()) == Counter(set(least.values()))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.one_of_each(docs.limit(0)).count() == 0


def test_links_lose_none(spark):
    rng = np.random.default_rng(5)
    prints = {int(x) for x in rng.integers(-(1 << 63), (1 << 63) - 1, 150)}
    for x in list(prints)[:60]:
        a, b = rng.choice(64, 2, replace=False)
        y = (x & (1 << 64) - 1) ^ (1 << int(a)) ^ ((1 << int(b)) if rng.random() < 0.7 else 0)
        prints.add(y - (1 << 64) if y >> 63 else y)
    found = {(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame([(x,) for x in prints], "fp long")).collect()}
    u = lambda x: x & (1 << 64) - 1
    assert found == {(a, b) for a in prints for b in prints if a < b and (u(a) ^ u(b)).bit_count() <= 2}


def test_components_of_chains_rings_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (102, 100)] + [(200, 201 + k) for k in range(30)] + [(-5, 300), (300, 0)]
    found = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: -5 for k in [*range(41), 300, -5]} | {k: 100 for k in (100, 101, 102)} | {k: 200 for k in range(200, 231)}


def test_pipeline_stages_follow_one_another(spark, tmp_path):
    import corpus_pipeline

    sf = str(tmp_path)
    item = babble(4000, 40, 3000)
    clean = [(k, babble(k, 160, 3000) + f"\nown line {k}") for k in range(30)]
    rows = clean + [(500, clean[3][1]), (501, "x " * 200), (502, "short"), (503, f"{babble(77, 90, 3000)} {item} {babble(78, 90, 3000)}"), (504, None)]
    table(spark, rows).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "simhash near-dedup", "benchmark decontamination", "best-fit packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, sf)
        docs.write.parquet(f"{sf}/{k}")
        docs = spark.read.parquet(f"{sf}/{k}")
        left.append(sorted({r["doc_id"] for r in docs.collect()}))
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = [i for i, _ in clean]
    assert left == [[*ids, 500, 503], [*ids, 500, 503], [*ids, 503], ids, ids]
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).select("doc_id", "piece", "length").collect())) == sorted(map(tuple, docs.select("doc_id", "piece", "length").collect()))


def test_every_query_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert "op8_site_lines" in entry.oracle_sql()
