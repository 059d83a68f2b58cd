"""Upserts, the posting log, children, quality and skewed keys."""

import datetime as dt
import random

from pyspark.sql import functions as F

from vacancylake import schemas
from vacancylake.operators import children, filters, joins, quality, ranking, sets, upsert
from vacancylake.sources import catalog, dimensions, raw_pages
from vacancylake.streaming.log import PostingLog

T = [dt.datetime(2025, 9, d) for d in range(1, 10)]
WRITES = "platform string, id string, title string, description string, scraped_date timestamp_ntz, seq int"
STORED = WRITES + ", created_at timestamp_ntz, updated_at timestamp_ntz"


def golden(spark):
    return spark.createDataFrame(
        [("a", "1", "T1", "D1", T[0], 1), ("a", "1", "T2", "D2", T[1], 2), ("b", "1", "T3", "D3", T[2], 3)], WRITES)


def test_first_and_last_writes(spark):
    empty = spark.createDataFrame([], STORED)
    listing = {r.platform: r for r in upsert.upsert(empty, golden(spark), T[5], ["seq"]).collect()}
    assert (listing["a"].title, listing["a"].scraped_date, listing["b"].title) == ("T1", T[1], "T3")
    detail = {r.platform: r for r in upsert.upsert(
        empty, golden(spark), T[5], ["seq"], last_wins=["description"]).collect()}
    assert (detail["a"].title, detail["a"].description, detail["a"].scraped_date) == ("T1", "D2", T[1])
    single = upsert.upsert(empty, golden(spark), T[5], ["seq"], key=["id"], last_wins=["description"]).collect()
    assert [(r.platform, r.title, r.description, r.scraped_date) for r in single] == [("a", "T1", "D3", T[2])]


def test_null_in_the_winning_write_stays_null(spark):
    writes = spark.createDataFrame(
        [("a", "1", None, "D", T[0], 1), ("a", "1", "later", None, T[1], 2)], WRITES)
    row = upsert.upsert(spark.createDataFrame([], STORED), writes, T[5], ["seq"], last_wins=["description"]).first()
    assert row.title is None and row.description is None


def test_untouched_rows_keep_their_stamps(spark):
    empty = spark.createDataFrame([], STORED)
    day1 = upsert.upsert(empty, golden(spark), T[5], ["seq"])
    day2 = upsert.upsert(day1, golden(spark).where("platform = 'b'"), T[6], ["seq"])
    rows = {r.platform: r for r in day2.collect()}
    assert (rows["a"].updated_at, rows["b"].updated_at, rows["b"].created_at) == (T[5], T[6], T[5])


def skewed_writes(spark, n=3000):
    """One key with a third of all writes."""
    rng = random.Random(7)
    rows = []
    for seq in range(n):
        key = ("hot", "0") if rng.random() < 0.34 else (rng.choice("abc"), str(rng.randrange(200)))
        rows.append((*key, rng.choice(["x", None, f"t{seq}"]), f"d{seq}", T[0] + dt.timedelta(minutes=seq), seq))
    return rows, spark.createDataFrame(rows, WRITES)


def brute_force(rows):
    table = {}
    for platform, job_id, title, description, seen, seq in sorted(rows, key=lambda r: r[-1]):
        first = table.setdefault((platform, job_id), [title, description, seen, seq])
        first[1], first[2] = description, seen
    return {(*k, *v) for k, v in table.items()}


def test_skewed_upsert_equals_row_by_row(spark):
    rows, writes = skewed_writes(spark)
    got = upsert.upsert(spark.createDataFrame([], STORED), writes.repartition(7), T[5], ["seq"], last_wins=["description"])
    assert {tuple(r)[:6] for r in got.collect()} == brute_force(rows)


def test_log_equals_row_by_row_in_any_batches_with_replays_and_compaction(spark, tmp_path):
    rows, _ = skewed_writes(spark, 900)
    kinds = dict(f.split(" ") for f in WRITES.split(", "))
    cuts = [0, 10, 400, 401, 700, 900]
    log = PostingLog(spark, str(tmp_path / "log"), kinds, last_wins=["description"])
    assert log.current().count() == 0
    for batch, (start, end) in enumerate(zip(cuts, cuts[1:])):
        part = spark.createDataFrame(rows[start:end], WRITES)
        log.append(part, batch, T[batch], ["seq"])
        if batch == 2:
            log.append(part, batch, T[batch], ["seq"])  # a batch run twice
            log.compact()
    expected = brute_force(rows)
    current = log.current()
    assert {tuple(r)[:6] for r in current.collect()} == expected
    hot = current.where("platform = 'hot'").first()
    assert (hot.created_at, hot.updated_at) == (T[0], T[4])
    log.compact()
    log.compact()
    assert {tuple(r)[:6] for r in log.current().collect()} == expected


def test_runs_do_not_overwrite_each_other_also_after_compaction(spark, tmp_path):
    rows, _ = skewed_writes(spark, 900)
    kinds = dict(f.split(" ") for f in WRITES.split(", "))
    log = PostingLog(spark, str(tmp_path / "log"), kinds, last_wins=["description"])
    cuts = [0, 200, 450, 700, 900]
    for k, (start, end) in enumerate(zip(cuts, cuts[1:])):
        # Both runs count their batches from 0; the second run's are numbered no higher than the compacted ones.
        log.append(spark.createDataFrame(rows[start:end], WRITES), k % 2, T[k], ["seq"], run="one" if k < 2 else "another")
        if k == 1:
            log.compact()
    assert {tuple(r)[:6] for r in log.current().collect()} == brute_force(rows)
    log.compact()
    assert {tuple(r)[:6] for r in log.current().collect()} == brute_force(rows)


def test_incomplete_batches_are_not_read(spark, tmp_path):
    kinds = dict(f.split(" ") for f in WRITES.split(", "))
    log = PostingLog(spark, str(tmp_path / "log"), kinds)
    log.append(golden(spark), 0, T[0], ["seq"])
    broken = tmp_path / "log" / "batches" / "run=00000001-direct" / "batch=1"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"half")
    assert log.current().count() == 2


def test_children(spark):
    parents = spark.createDataFrame(
        [("a", "1", [" a ", "", " ", "b"], {"email": " a@b ", "phone": "", "fax": None}), ("a", "2", None, None)],
        "platform string, id string, skills array<string>, contact_info map<string,string>")
    skills = children.child_rows(parents, "skills", "skill", T[0])
    assert [(r.job_id, r.position, r.skill) for r in skills.collect()] == [("1", 0, "a"), ("1", 3, "b")]
    assert [(r.contact_type, r.contact_value) for r in children.contact_rows(parents, T[0]).collect()] == [("email", "a@b")]
    runs = spark.createDataFrame([("r", ["e1", " "])], "id string, errors array<string>")
    assert [(r.scraping_result_id, r.error_message) for r in children.error_rows(runs, T[0]).collect()] == [("r", "e1")]

    stored = skills.drop("position")
    fresh = children.child_rows(parents.withColumn("skills", F.array(F.lit("c"))).where("id = '1'"), "skills", "skill", T[1])
    saved = fresh.select("platform", "job_id").distinct()
    for _ in range(2):  # saving again changes nothing
        stored = children.replace_children(stored, fresh.drop("position"), saved, ["platform", "job_id"])
    assert [(r.job_id, r.skill) for r in stored.collect()] == [("1", "c")]


def test_accepted_and_rejected_are_everything(spark):
    items = spark.createDataFrame(
        [("1", "  ", "u", " c "), ("2", "t", "", None), (None, "t", "u", None), ("4", " t", "u", None)],
        "id string, title string, url string, company_name string"
    ).withColumn("scraped_date", F.lit(None).cast("timestamp_ntz"))
    good, bad = filters.validate_items(items, T[0])
    assert {(r.id, r.title, r.company_name, r.scraped_date) for r in good.collect()} == {
        ("1", "", "c", T[0]), ("4", "t", None, T[0])}
    assert {r.reason for r in bad.collect()} == {"Missing required field: url", "Missing required field: id"}
    assert good.count() + bad.count() == items.count()


def test_quality(spark):
    df = spark.createDataFrame([("a", "1", "x" * 51), ("a", "1", None), ("b", "2", "y")], "platform string, id string, name string")
    rules = quality.rules_for(["name"], {"name": 50})
    parents = spark.createDataFrame([("1",)], "key string")
    report = {r.rule: (r.row_count, r.violations) for r in quality.quality_report(
        df, rules, ["platform", "id"], (parents, "id", "key")).collect()}
    assert report == {"not_null:name": (3, 1), "length:name<=50": (3, 1), "unique:platform,id": (3, 1), "reference:id": (3, 1)}
    good, bad = quality.split_by_rules(df, rules)
    assert good.count() == 1 and sorted(r.broken_rules for r in bad.collect()) == [["length:name<=50"], ["not_null:name"]]
    assert [tuple(r) for r in quality.duplicate_keys(df, ["platform", "id"]).collect()] == [("a", "1", 2)]
    assert set(quality.row_rules("job_skills")) >= {"not_null:skill", "length:skill<=100"}


def test_quota_and_numbers_with_a_hot_source(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 5 + ["a", "b"]), page, pos) for page in range(200) for pos in range(10)]
    df = spark.createDataFrame(rows, "source string, page int, pos int").repartition(5)
    for quota in (1, 37, 1_300, 10_000):
        expected = set()
        for source in ("hot", "a", "b"):
            expected |= set(sorted(r for r in rows if r[0] == source)[:quota])
        got = [tuple(r) for r in ranking.quota_per_source(df, "source", ["page", "pos"], quota).collect()]
        assert len(got) == len(expected) and set(got) == expected
    numbered = ranking.in_batches(df, ["source", "page", "pos"], 7).collect()
    assert [(r.source, r.page, r.pos) for r in sorted(numbered, key=lambda r: r.row_no)] == sorted(rows)
    assert sorted(r.row_no for r in numbered) == list(range(1, len(rows) + 1))
    assert all(r.batch_no == (r.row_no - 1) // 7 for r in numbered)


def test_dedup_and_union(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("l", 3, None)], "key string, seq int, v string")
    assert {tuple(r) for r in sets.dedup_first(df, ["key"], ["seq"]).collect()} == {("k", 1, "a"), ("l", 3, None)}
    both = sets.union_sources([df, spark.createDataFrame([("m",)], "key string")])
    assert both.count() == 4 and both.where("v IS NULL").count() == 2


def test_lookup_and_join(spark):
    rows = spark.createDataFrame([("jobs_ge", "Law"), ("jobs_ge", "Nope"), ("ss_ge", "Marketing")], "platform string, name string")
    coded = joins.lookup_code(rows, dimensions.categories(spark), ["platform", "name"])
    assert {(r.name, r.code) for r in coded.collect()} == {("Law", "7"), ("Nope", ""), ("Marketing", "marketing")}
    places = dimensions.locations(spark)
    assert places.where("platform = 'jobs_ge' AND name = 'Tbilisi'").first().code == "1"


def test_page_manifest_and_frontier(spark):
    manifest = raw_pages.page_manifest(spark, ["jobs_ge", "cv_ge"], 3, query="cook", has_salary=True)
    assert manifest.count() == 6
    assert "https://jobs.ge/en?page=2&q=cook&has_salary=1" in {r.url for r in manifest.collect()}
    pages = manifest.withColumn("n_rows", F.when((F.col("platform") == "cv_ge") & (F.col("page_no") == 2), 0).otherwise(5))
    kept = raw_pages.page_frontier(pages)
    assert {(r.platform, r.page_no) for r in kept.collect()} == {("jobs_ge", 1), ("jobs_ge", 2), ("jobs_ge", 3), ("cv_ge", 1)}
    assert raw_pages.page_frontier(pages, max_page=1).count() == 2


def test_bodies(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": 1}}',), ("",), ("x",), (None,), ('{"a": 1},{"a": 2}',)], "b string")
    good, bad = raw_pages.parse_bodies(df, "b", "a int")
    assert [r.body.a for r in good.collect()] == [1] and bad.count() == 5


def test_page_files(spark, tmp_path):
    (tmp_path / "1.html").write_text("<h1>a</h1>\n<p>b", encoding="utf8")
    page = raw_pages.read_page_files(spark, str(tmp_path), "cv_ge").first()
    assert page.html == "<h1>a</h1>\n<p>b" and page.status == 200 and page.platform == "cv_ge"


def test_tables_are_created_once_and_dropped_only_on_demand(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS store")
    schemas.create_tables(spark, "store")
    schemas.create_tables(spark, "store")
    names = [r.table_name for r in catalog.list_tables(spark, "store").collect()]
    assert names == sorted(schemas.TABLES)
    profile = catalog.table_profile({"job_skills": spark.table("store.job_skills")}).collect()
    assert [(r.column_name, r.data_type, r.row_count) for r in profile][2] == ("skill", "VARCHAR", 0)
    try:
        schemas.drop_tables(spark, "store")
        raise AssertionError("dropped without confirmation")
    except ValueError:
        pass
    schemas.drop_tables(spark, "store", confirm=True)
    assert catalog.list_tables(spark, "store").count() == 0
