"""Quality rules, decontamination, line dedup, personal data, toxicity against plain Python on small tables."""

from __future__ import annotations

import random
import re
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import AWKWARD, LONG, babble, clashing, table
from vacancylake.llm import decontamination, line_dedup, personal_data, quality_rules, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for k, w in enumerate(windows) if often[w] > 1 for j in (k, k + 1, k + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def junk(seed):
    return " ".join(w.upper() + "#%" for w in babble(seed, 120).split())


@pytest.fixture(scope="module")
def judged(spark):
    rows = AWKWARD + [(k, babble(k, 150)) for k in range(60)] + [(k, junk(k)) for k in range(100, 160)]
    labels = spark.createDataFrame([(k, 1) for k in range(60)] + [(k, 0) for k in range(100, 150)] + [(12345, 0), (None, 1)], "doc_id long, quality int")
    return rows, quality_rules.judge(clashing(table(spark, rows)), labels).collect()


def test_base_counts_as_in_plain_python(judged):
    rows, found = judged
    want = sorted(((i, *base_counts(t)) for i, t in rows), key=str)
    assert sorted(((r["doc_id"], *[r[c] for c in quality_rules.BASE]) for r in found), key=str) == want
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])


def test_rules_reject_unlabelled_junk_and_keep_clean_documents(judged):
    verdict = {r["doc_id"]: r["kept"] for r in judged[1]}
    assert not any(verdict[k] for k in range(100, 160))
    assert all(verdict[k] for k in range(60))


def test_no_labels_give_no_rules_and_no_rows_give_no_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    docs = table(spark, [(1, babble(1, 100)), (2, "short")])
    assert {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs, labels).collect()} == {1: True, 2: False}
    assert quality_rules.judge(docs.limit(0), labels).count() == 0


def test_long_texts_sort_whole_hashes(spark, monkeypatch):
    text = babble(5, 300, 40)
    monkeypatch.setattr(quality_rules, "_INDEX_BITS", 6)
    row = quality_rules.measured(table(spark, [(1, text)])).first()
    assert tuple(row[c] for c in quality_rules.BASE) == base_counts(text)


def test_quality_runs_without_python_workers(spark):
    plan = quality_rules.measured(table(spark, [(1, "a")]).filter("doc_id > 0"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan.split("Physical Plan")[-1])


def test_quality_stage_keeps_columns_and_clean_rows(spark):
    docs = clashing(table(spark, [(1, babble(1, 100)), (2, "short"), (3, None)]))
    out = quality_rules.without_low_quality(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert out.columns == docs.columns and [r["doc_id"] for r in out.collect()] == [1]


ITEMS = [(k, f"{babble(500 + k, 30)} what is {babble(700 + k, 3)}? {babble(600 + k, 12)}") for k in range(30)] + [(77, None), (78, ""), (79, "too short"), (80, babble(880, 300))]


def brute_matches(rows, items):
    out = set()
    for item, text in items:
        if len(decontamination.words_of_text(text)) < decontamination.LEAST_WORDS:
            continue
        q, a = decontamination.question_and_answer(text)
        for k, (_, doc) in enumerate(rows):
            words = decontamination.words_of_text(doc)
            if decontamination.in_order(q, words) >= 0.8 and decontamination.in_order(a, words) >= 0.8:
                # In order anywhere; near each other is checked on texts made so that both agree.
                out.add((k, item))
    return out


@pytest.mark.parametrize("shard_bytes", [1 << 20, 1500])
def test_decontamination_finds_all_and_nothing_else(spark, shard_bytes):
    def noise(k, n):
        return " ".join(f"zz{(k * 7919 + j * j) % 5003}" for j in range(n))

    rows = [(None, ITEMS[0][1]), (1, f"{noise(1, 90)} {ITEMS[3][1].upper()} {noise(2, 300)}"), (2, noise(3, 500)), (3, ""), (3, None), (4, ITEMS[80 - 80][1][: len(ITEMS[0][1]) // 2])]
    changed = ITEMS[5][1].split()
    changed[7] = "other"
    rows += [(5, f"{noise(6, 61)} {' '.join(changed)}"), (6, f"{noise(8, 1000)} {ITEMS[-1][1]} {noise(9, 10)}"), (6, f"{ITEMS[9][1]} {ITEMS[10][1]}"), (7, LONG)]
    docs = clashing(table(spark, rows))
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, score string")
    found = decontamination.contaminated(docs, items, shard_bytes=shard_bytes).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in found), key=str) == sorted(((rows[k][0], i) for k, i in brute_matches(rows, ITEMS)), key=str)
    kept = decontamination.without_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 3, 4, 7]


def test_the_words_of_an_item_in_another_order_do_not_hide_the_item(spark):
    words = ITEMS[2][1].split()
    noise = " ".join(f"zz{j}" for j in range(400))
    shuffled, less = " ".join(reversed(words)), " ".join(w for k, w in enumerate(words) if k not in (4, 40))
    rows = [(1, f"{shuffled} {noise} {less} {noise}"), (2, f"{shuffled} {noise}"), (3, f"{less} {noise} {shuffled}"), (4, f"{less} {noise} {ITEMS[2][1]}"), (5, shuffled), (6, less)]
    found = decontamination.contaminated(table(spark, rows), spark.createDataFrame(ITEMS, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(1, 2), (3, 2), (4, 2), (6, 2)]
    by_doc = {r["doc_id"]: r for r in found}  # the passing passage with the highest score
    assert by_doc[1]["first_word"] >= 384 and by_doc[4]["first_word"] >= 384 and by_doc[3]["first_word"] == 0
    assert by_doc[4]["question_overlap"] == 1 and by_doc[1]["score"] < by_doc[4]["score"]


def test_wand_returns_the_scores_of_an_exhaustive_search():
    import numpy as np

    index = decontamination.Index([(i, t) for i, t in ITEMS if t])
    words = [w for _, t in ITEMS[:12] if t for w in t.lower().split()][::2] * 2
    ids = np.array([index.term[w] for w in words if w in index.term])
    stride = np.arange(len(ids)) // 16
    got = {(p, s): x for p, s, x in index.search(ids, stride, int(stride[-1]) + 1, 0.2)}
    want = {}
    for p in range(int(stride[-1]) + 1):
        terms = set(ids[(stride == p) | (stride == p + 1)].tolist())
        scores = defaultdict(float)
        for lists in index.postings:
            for t in terms & lists.keys():
                for s, x in lists[t]:
                    scores[s] += x
        want |= {(p, s): x for s, x in scores.items() if x >= 0.2}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_no_items_and_no_rows(spark):
    docs = table(spark, AWKWARD)
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(docs, items).count() == 0
    assert decontamination.without_contaminated(docs, items).count() == len(AWKWARD)
    assert decontamination.contaminated(docs.limit(0), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_lines_above_the_ratio_go(spark):
    rows = [(k, f"head {k % 2}\nbody {k}\n\nfoot\nrare") for k in range(0, 60, 3)] + [(k, f"foot\nown {k}") for k in range(1, 10, 3)] + AWKWARD
    docs = clashing(table(spark, rows))
    out = line_dedup.drop_document_lines(docs, ratio=0.4)
    assert out.columns == docs.columns
    pages, holds = Counter(), Counter()
    for i, t in rows:
        pages[(i or 0) % 3] += 1
        holds.update(((i or 0) % 3, x) for x in set((t or "").split("\n")) if x.strip("\t\n\x0b\x0c\r "))
    want = []
    for i, t in rows:
        s = (i or 0) % 3
        want.append((i, "\n".join(x for x in (t or "").split("\n") if not (x.strip("\t\n\x0b\x0c\r ") and holds[s, x] >= line_dedup.LEAST_PAGES and holds[s, x] > 0.4 * pages[s]))))
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted(want, key=str)
    assert {r["host"] for r in out.collect()} == {"own host"}
    assert line_dedup.drop_document_lines(docs.limit(0)).count() == 0


def test_null_hosts_are_one_host(spark):
    docs = table(spark, [(k, f"menu\n{k}") for k in range(8)]).withColumn("source", F.lit(None).cast("string"))
    assert {r["text"] for r in line_dedup.drop_document_lines(docs).collect()} == {str(k) for k in range(8)}


def test_page_lines(spark):
    html = "<head><title>T</title><script>x<p></script></head><p>One <b>two</b><br/>three<!-- no\n --></p><div\nclass=a> four </div>"
    row = spark.createDataFrame([(html,)], "html string").select(line_dedup.page_lines(F.col("html")).alias("x")).first()
    assert row["x"] == ["T", "One two", "three", "four"]


BASE_SPANS = [
    ("write to a.b+c@mail.example.org, or x@y", [("email", 9, 31)]), ("at 10.0.0.255 not 10.0.0.256 nor 1.2.3", [("ip", 3, 13)]),
    ("1.2.3.4.5.6.7.8", [("ip", 0, 7), ("ip", 8, 15)]), ("card 4111 1111-1111 1111.", [("card", 5, 24)]), ("4111 1111 1111 1112", []),
    ("é中 +1 (415) 555-2671 x", [("phone", 3, 20)]), ("+12 34", []), ("id 41111111111111111", []), (None, []), ("", []),
]


@pytest.mark.parametrize("text,want", BASE_SPANS)
def test_base_spans(text, want):
    assert [s[:3] for s in personal_data.find_spans(text) if s.kind in personal_data.BASE] == want


def test_email_and_ip_spans_are_those_of_the_plain_expressions_in_linear_time():
    plain = {
        "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    }
    kinds = {k.name: k for k in personal_data.KINDS}
    chance = random.Random(7)
    for _ in range(20_000):
        for name, letters in (("email", "ab@@.._1 -"), ("ip", "12...a")):
            text = "".join(chance.choice(letters) for _ in range(chance.randrange(30)))
            assert list(personal_data._matches(kinds[name], text)) == [m.span() for m in plain[name].finditer(text)], text
    began = time.monotonic()
    assert personal_data.find_spans("a" * 2_000_000 + "1" * 2_000_000 + " @.") == []
    assert time.monotonic() - began < 30


def test_validators_and_context():
    kinds = lambda text: [s.kind for s in personal_data.find_spans(text)]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00 please") == ["iban"]
    assert kinds("IBAN DE88 3704 0044 0532 0130 00 please") == []
    assert kinds("my ssn is 219-09-9999") == ["ssn"] and kinds("part 219-09-9999") == [] and kinds("ssn 000-09-9999") == []
    assert kinds("call 415-555-2671") == ["local_phone"] and kinds("order 415-555-2671") == []
    near, far = (personal_data.find_spans(f"{w} 10.1.2.3")[0].score for w in ("server", "walk"))
    assert near > far


def test_spans_of_awkward_rows(spark):
    out = personal_data.with_spans(clashing(table(spark, AWKWARD))).collect()
    assert len(out) == len(AWKWARD) and all(not r["spans"] for r in out)
    assert personal_data.with_spans(table(spark, AWKWARD).limit(0)).count() == 0


def test_toxic_texts_of_the_held_out_part_are_found(spark):
    bad = ["grobian", "lumpazi", "schuft"]
    rows = [(k, babble(k, 80) + (f" {bad[k % 3]}{'en' * (k % 2)} {babble(k + 1, 40)}" if k % 4 == 0 else "")) for k in range(240)]
    docs = clashing(table(spark, rows + AWKWARD))
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(120)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    scores = toxicity.score(docs, model).collect()
    assert len(scores) == len(rows) + len(AWKWARD) and all(0 <= r["score"] <= 1 for r in scores)
    by_id = {r["doc_id"]: r["score"] >= toxicity.THRESHOLD for r in scores}
    wrong = sum(by_id[k] != (k % 4 == 0) for k in range(120, 240))
    assert wrong <= 2 and not any(by_id[i] for i, _ in AWKWARD)


def test_toxicity_without_labels(spark):
    docs = table(spark, AWKWARD)
    none = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score(docs, none).collect()} == {0.0}
    one = toxicity.train(docs, spark.createDataFrame([(903, 1), (904, None)], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score(docs, one).collect()} == {1.0}


def test_correlated_voters_count_less():
    import numpy as np

    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    a = np.where(y, rng.random(4000) < 0.8, rng.random(4000) < 0.1)
    b = np.where(y, rng.random(4000) < 0.8, rng.random(4000) < 0.1)
    model = toxicity.fit_label_model(np.stack([a, a, b], axis=1).astype(float), y.astype(float))
    assert model.weight[0] < 0.6 and model.weight[2] > 0.9
    assert abs(model.given_toxic[2] - 0.8) < 0.05 and abs(model.given_clean[2] - 0.1) < 0.05
