"""Saved pages, seen keys, batch counters, the posting log's ranges, crawls with limits."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from vacancylake.functions.markup import Page, Step
from vacancylake.plans import ingest as jobs
from vacancylake.schemas import RAW_PAGE_DDL
from vacancylake.sinks import exports
from vacancylake.sources import catalog, raw_pages
from vacancylake.sources.raw_pages import CrawlConfig
from vacancylake.sources.saved_pages import register_saved_pages
from vacancylake.streaming import ingest, progress
from vacancylake.streaming.log import PostingLog, _joined
from vacancylake.streaming.seen import seen_until


def saved(spark, folder, pages):
    """pages: (platform, number, html)"""
    register_saved_pages(spark)
    rows = spark.createDataFrame([(None, p, None, n, None, 200, h) for p, n, h in pages], RAW_PAGE_DDL)
    rows.write.format("saved_pages").option("path", folder).mode("append").save()


def loaded(spark, folder, **options):
    return spark.read.format("saved_pages").option("path", folder).options(**options).load()


def numbers(df):
    return sorted((r["platform"], r["page_no"]) for r in df.collect())


def test_saved_pages_within_limits_up_to_the_first_empty_one(spark, tmp_path):
    folder = str(tmp_path / "pages")
    saved(spark, folder, [("a", n, f"<p>é {n}") for n in range(1, 9)] + [("b", 2, "x"), ("b", 5, ""), ("b", 7, "y"), ("c", 1, None)])
    (tmp_path / "pages" / "a" / "notes.txt").write_text("not a page")
    (tmp_path / "pages" / "a" / "page-3.html").write_bytes(b"\xff broken")
    every = loaded(spark, folder)
    assert numbers(every) == [("a", n) for n in range(1, 9)] + [("b", 2)]
    texts = {(r["platform"], r["page_no"]): r["html"] for r in every.collect()}
    assert texts["a", 2] == "<p>é 2" and texts["a", 3] == "� broken"
    assert numbers(loaded(spark, folder, stop_at_empty="false")) == [("a", n) for n in range(1, 9)] + [("b", 2), ("b", 5), ("b", 7), ("c", 1)]
    assert numbers(loaded(spark, folder, platforms="a, c", first_page="3", last_page="5", pages_per_task="1")) == [("a", 3), ("a", 4), ("a", 5)]
    assert len({r["page_id"] for r in every.collect()}) == 9
    assert loaded(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="needs a path"):
        spark.read.format("saved_pages").load().count()


def test_conditions_choose_files_before_they_are_opened(spark, tmp_path):
    folder = str(tmp_path / "pages")
    saved(spark, folder, [(p, n, "x") for p in "ab" for n in range(1, 21)])
    (tmp_path / "pages" / "b" / "page-9.html").chmod(0)  # whoever is not root can't open it
    few = loaded(spark, folder).where("page_no > 3 and page_no <= 6 and platform = 'a' and page_no in (4, 6, 9)")
    assert numbers(few) == [("a", 4), ("a", 6)]
    assert numbers(loaded(spark, folder).where("page_no = 25")) == []
    assert numbers(loaded(spark, folder).where("page_no < 2 or platform = 'b' and page_no >= 20")) == [("a", 1), ("b", 1), ("b", 20)]


def test_a_stream_of_saved_pages_goes_on_where_it_stopped(spark, tmp_path):
    folder, out = str(tmp_path / "pages"), str(tmp_path / "out")

    def run():
        stream = spark.readStream.format("saved_pages").option("path", folder).load()
        write = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "checkpoint"))
        write.trigger(availableNow=True).start().awaitTermination()
        return numbers(spark.read.schema(RAW_PAGE_DDL).parquet(out))

    saved(spark, folder, [("a", 1, "x"), ("a", 2, "x"), ("b", 4, "x")])
    assert run() == [("a", 1), ("a", 2), ("b", 4)]
    assert run() == [("a", 1), ("a", 2), ("b", 4)]  # nothing new
    saved(spark, folder, [("a", 3, "x"), ("c", 1, "x"), ("b", 3, "late")])
    assert run() == [("a", 1), ("a", 2), ("a", 3), ("b", 4), ("c", 1)]
    assert run() == numbers(loaded(spark, folder).where("html <> 'late'"))


@pytest.mark.parametrize("row", [(None, 1), ("a", None), ("a/b", 1), ("a", -1)])
def test_pages_without_a_place_are_refused(spark, tmp_path, row):
    with pytest.raises(Exception, match="needs a platform"):
        saved(spark, str(tmp_path / "pages"), [(*row, "x")])
    with pytest.raises(Exception, match="append"):
        register_saved_pages(spark)
        spark.createDataFrame([], RAW_PAGE_DDL).write.format("saved_pages").option("path", str(tmp_path)).mode("overwrite").save()


def day(n):
    return dt.datetime(2025, 1, 1) + dt.timedelta(days=n)


def test_keys_stay_seen_until_their_own_expiry_over_restarts(spark, tmp_path):
    schema = "k string, v int, ts timestamp_ntz"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        once = seen_until(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), ["k"], "ts", dt.timedelta(days=10), order=["v"])
        write = once.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "checkpoint"))
        write.trigger(availableNow=True).start().awaitTermination()
        return sorted(r["v"] for r in spark.read.schema(schema).parquet(str(tmp_path / "out")).collect())

    assert arrive([("a", 2, day(0)), ("a", 1, day(0)), ("b", 3, day(5)), (None, 5, day(2)), ("c", 6, None)]) == [1, 3, 5]
    # the watermark has passed day 5; all three keys are still seen
    assert arrive([("a", 7, day(9)), ("b", 8, day(9)), (None, 9, day(9)), ("x", 10, day(9))]) == [1, 3, 5, 10]
    # day 12: a and the null key have expired, b (until day 15) has not
    assert arrive([("a", 11, day(12)), ("b", 12, day(14)), (None, 13, day(13))]) == [1, 3, 5, 10, 11, 13]
    assert arrive([("b", 14, day(15)), ("a", 15, day(16))]) == [1, 3, 5, 10, 11, 13, 14]


def test_counters_of_batches_are_those_of_the_log(spark, tmp_path):
    kinds = {"platform": "string", "id": "string", "title": "string", "scraped_date": "timestamp_ntz", "seq": "int"}
    schema = ", ".join(f"{k} {v}" for k, v in kinds.items())
    log = PostingLog(spark, str(tmp_path / "log"), kinds)
    listener = progress.BatchCounters(spark, str(tmp_path / "counters"))
    spark.streams.addListener(listener)
    try:
        for part in range(3):
            rows = [("a", str(k % 5), "x" if k % 4 else None, day(part), part * 100 + k) for k in range(10 + part)]
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = progress.counted(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), F.col("title").isNull())
            ingest.write_batches(stream, log, str(tmp_path / "checkpoint"), day(9), ["seq"], compact_every=2).awaitTermination()
            progress.wait_for_listeners(spark)
    finally:
        spark.streams.removeListener(listener)
    found = progress.counters(spark, str(tmp_path / "counters"))
    assert sorted((r["batch"], r["total"], r["failed"]) for r in found.collect()) == [(0, 10, 3), (1, 11, 3), (2, 12, 3)]
    assert tuple(progress.totals(found).first())[1:] == (3, 33, 9)
    batches = log.batch_counts()
    assert sorted((r["batch"], r["writes"]) for r in batches.collect()) == [(0, 10), (1, 11), (2, 12)]
    assert {r["run"].split("-", 1)[1] for r in batches.collect()} == {r["run"] for r in found.collect()}
    bare = batches.withColumn("run", F.substring_index("run", "-", -5))
    assert progress.uncounted(bare, found).count() == 0 and progress.uncounted(bare, found.where("batch < 2")).count() == 1
    assert log.current().count() == 5 and log._parts()[0] == 0  # compacted on the way


def test_covered_batches_are_kept_as_ranges():
    rng = random.Random(1)
    for _ in range(200):
        singles = {rng.randrange(40) for _ in range(rng.randrange(30))}
        joined = _joined([(k, k) for k in singles])
        assert {k for low, high in joined for k in range(low, high + 1)} == singles
        assert all(b[0] > a[1] + 1 for a, b in zip(joined, joined[1:]))


def test_runs_that_begin_together_are_ordered_by_name(spark, tmp_path):
    kinds = {"platform": "string", "id": "string", "scraped_date": "timestamp_ntz"}
    for names in (("x", "y"), ("y", "x")):
        log = PostingLog(spark, str(tmp_path / "-".join(names)), kinds)
        log._run = lambda name: f"00000001-{name}"  # both looked before either wrote
        for k, name in enumerate(names):
            rows = spark.createDataFrame([("a", "1", day(1 if name == "x" else 2))], ", ".join(f"{c} {t}" for c, t in kinds.items()))
            log.append(rows, 0, day(5), ["scraped_date"], name)
        assert log.current().first()["scraped_date"] == day(2)  # of y, whoever wrote first


def test_end_tags_without_a_beginning_cost_nothing():
    for piece in ("</b>", "<div><p></b>", "<b></div>", "<a></a></p>"):
        began = time.perf_counter()
        Page(piece * 50_000)
        assert time.perf_counter() - began < 3
    page = Page("<div><p>one</b></span><i>two</div>three</p><p>four")
    assert [page.text(e) for e in page.select(Step("p"))] == ["onetwo", "four"] and page.text(page.select(Step("div"))[0]) == "onetwo"


LISTING = "<div class='item-listing'><div class='list-item'><p class='list-item-title'><a class='announcement-list-item' href='/announcement/%s/x'>t%s</a></p></div></div>"


def crawl_pages(spark, rows):
    """(page number, id or None for a page without listings, status) of one source without filters in its addresses"""
    base = "https://www.cv.ge/announcements/all"
    data = [(n, "cv_ge", base + (f"?page={n}" if n > 1 else ""), n, day(0), status, LISTING % (i, i) if i else "<div class='item-listing'></div>") for n, i, status in rows]
    return spark.createDataFrame(data, RAW_PAGE_DDL)


@pytest.mark.parametrize(("config", "ids", "problems"), [
    (CrawlConfig(), ["1", "2"], ["HTTP 500"]),
    (CrawlConfig(stop_at_failed=False), ["1", "2", "4"], ["HTTP 500"]),
    (CrawlConfig(stop_at_failed=False, stop_at_empty=False), ["1", "2", "4", "6"], ["HTTP 500", "HTTP 404"]),
    (CrawlConfig(stop_at_failed=False, stop_at_empty=False, page_limits={}), ["1", "2", "4", "6", "25"], ["HTTP 500", "HTTP 404"]),
    (CrawlConfig(page_limits={"cv_ge": 1}), ["1"], []),
])
def test_a_crawl_ends_where_its_pages_do(spark, config, ids, problems):
    pages = crawl_pages(spark, [(1, 1, 200), (2, 2, 200), (3, None, 500), (4, 4, 200), (5, None, 200), (6, 6, 200), (7, None, 404), (25, 25, 200)])
    found = jobs.ingest_listings(pages, jobs.empty_table(spark, "job_listings"), day(3), crawl=config)
    assert sorted((r["id"] for r in found.table.collect()), key=int) == ids
    assert sorted(r["problem"] for r in found.rejects.collect()) == sorted(problems)


def test_a_crawl_reads_the_pages_at_its_own_addresses(spark):
    rows = spark.createDataFrame([(n, "jobs_ge", url, 1, day(0), 200, "") for n, url in enumerate([
        "https://jobs.ge/en?page=1&cid=3", "https://jobs.ge/ge?page=1&cid=3", "https://jobs.ge/en?page=1", "https://jobs.ge/en?page=1&cid=3&q=a+b&has_salary=1", None])], RAW_PAGE_DDL)
    asked = lambda **c: sorted(r["page_id"] for r in raw_pages.asked_pages(rows, CrawlConfig(**c)).collect())
    assert (asked(category_id="3"), asked(category_id="3", locale="ge"), asked(), asked(category_id="3", query="a b", has_salary=True)) == ([0], [1], [2], [3])


def test_csv_keeps_quotes_breaks_and_blanks(spark, tmp_path):
    values = ['a,"b"', " lead", "trail \n", "two\nlines", '"', "\\", "", None, "é;\t"]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v string")
    exports.export_csv(df, str(tmp_path / "csv"))
    # an empty value and a missing one are the same in a CSV file
    assert {r["k"]: r["v"] for r in exports.read_csv(spark, str(tmp_path / "csv"), df.schema).collect()} == {k: v or None for k, v in enumerate(values)}


def test_profile_names_column_defaults(spark, tmp_path):
    spark.sql(f"CREATE TABLE with_defaults (a INT DEFAULT 7, b STRING) USING parquet LOCATION '{tmp_path}/t'")
    try:
        rows = catalog.table_profile({"t": spark.table("with_defaults")}).orderBy("position").collect()
    finally:
        spark.sql("DROP TABLE with_defaults")
    assert [(r["column_name"], r["column_default"]) for r in rows] == [("a", "7"), ("b", None)]


def test_pages_of_a_batch_of_few_files_are_parsed_by_all_cores(spark, tmp_path, monkeypatch):
    html = "<div class='item-listing'><div class='list-item'><p class='list-item-title'><a class='announcement-list-item' href='/announcement/%d/x'>t</a></p></div></div>"
    rows = [(i, "cv_ge", None, 1, None, 200 if i % 10 else 500, html % i) for i in range(200)]
    spark.createDataFrame(rows, RAW_PAGE_DDL).coalesce(1).write.parquet(str(tmp_path / "pages"))
    tasks = []
    kept = ingest.stored

    def counted(df, label):
        tasks.append(df.rdd.getNumPartitions())
        return kept(df, label)

    monkeypatch.setattr(ingest, "stored", counted)
    ingest.ingest_pages(spark, str(tmp_path / "pages"), str(tmp_path / "log"), str(tmp_path / "c"), "2025-09-01 06:00:00", 1).awaitTermination()
    log = ingest.listing_log(spark, str(tmp_path / "log"))
    assert tasks and min(tasks) >= spark.sparkContext.defaultParallelism > 1
    assert log.current().count() == 180 and log.rejects().where("problem = 'HTTP 500'").count() == 20
