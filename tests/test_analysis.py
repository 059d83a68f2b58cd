"""Distributions against brute force, report and chart data, exports, streams, plans."""

import datetime as dt
import decimal
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacancylake.operators import aggregates, distributions, filters
from vacancylake.operators.projections import as_json
from vacancylake.operators.quantiles import exact_quantiles
from vacancylake.plans import report
from vacancylake.plans.overview import COLUMNS, overview, register_overview, run_sql
from vacancylake.plans.queries import registered
from vacancylake.sinks import exports
from vacancylake.sources.driver_tables import AS_OF, postings, table
from vacancylake.streaming import ingest, windows

SF = "/root/testdata/sf0.001"


def salaries(spark, seed=1, n=4000):
    """A hot source with a third of the rows, ties, negatives, outliers and NULLs."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        platform = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None])
        kind = rng.random()
        value = 500 if kind < 0.2 else rng.gauss(2000, 400) if kind < 0.9 else rng.choice([-3.5, 0, 99_999_999.99, 0.01])
        rows.append((platform, None if kind > 0.98 else decimal.Decimal(value).quantize(decimal.Decimal("0.01"))))
    return rows, spark.createDataFrame(rows, "platform string, salary_min decimal(10,2)").repartition(6)


def test_quantiles_are_exact(spark):
    rows, df = salaries(spark)
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    for r in exact_quantiles(df, "salary_min", probabilities, "platform").collect():
        values = [float(v) for p, v in rows if p == r.platform and v is not None]
        assert r.n == len(values)
        assert np.allclose(r.quantiles, np.quantile(values, probabilities), atol=1e-6)
    whole = exact_quantiles(df, "salary_min", [0.5]).first()
    assert whole.quantiles[0] == pytest.approx(np.median([float(v) for _, v in rows if v is not None]))


def test_quantiles_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([("a", decimal.Decimal("7.25"))], "platform string, salary_min decimal(10,2)")
    assert exact_quantiles(one, "salary_min", [0.25, 1.0], "platform").first().quantiles == [7.25, 7.25]
    assert exact_quantiles(one.where("false"), "salary_min", [0.5], "platform").count() == 0


def test_histogram_and_density(spark):
    rows, df = salaries(spark, 5)
    values = np.array([float(v) for _, v in rows if v is not None and v < 10_000])
    df = df.where("salary_min < 10000")
    got = distributions.histogram(df, "salary_min").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=20)
    assert [r.n for r in got] == counts.tolist()
    assert np.allclose([r.low_edge for r in got] + [got[-1].high_edge], edges)
    curve = distributions.density_curve(df, "salary_min").orderBy("point").collect()
    width = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 200)
    density = np.exp(-0.5 * ((grid[:, None] - values) / width) ** 2).sum(axis=1) / (len(values) * width * np.sqrt(2 * np.pi))
    assert np.allclose([r.density_count for r in curve], density * len(values) * (edges[1] - edges[0]))


def test_histogram_of_one_value_and_of_none(spark):
    same = spark.createDataFrame([(5,), (5,)], "v int")
    got = distributions.histogram(same, "v").orderBy("bin").collect()
    assert [r.n for r in got] == np.histogram([5, 5], bins=20)[0].tolist() and got[0].low_edge == 4.5
    assert distributions.histogram(same.where("false"), "v").count() == 0
    assert distributions.density_curve(same, "v").count() == 0  # no spread, no curve


def test_box(spark):
    rows, df = salaries(spark, 9)
    df = df.where("platform IS NOT NULL")
    for r in distributions.box_stats(df).collect():
        values = np.array(sorted(float(v) for p, v in rows if p == r.platform and v is not None))
        q1, median, q3 = np.quantile(values, [0.25, 0.5, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert np.allclose([r.q1, r.median, r.q3], [q1, median, q3])
        assert (r.whisker_low, r.whisker_high) == (values[values >= low].min(), values[values <= high].max())
        assert r.outliers == ((values < low) | (values > high)).sum()
    outliers = distributions.box_outliers(df).groupBy("platform").count().collect()
    assert {r.platform: r["count"] for r in outliers} == {r.platform: r.outliers for r in distributions.box_stats(df).collect()}
    assert distributions.box_stats(df.where("platform = 'a'")).count() == 0  # drawn only for several sources


def test_charts(spark):
    view = overview(postings(spark, SF), AS_OF)
    assert view.columns == COLUMNS and len(COLUMNS) == 24
    charts = report.chart_data("all", view, AS_OF, days=60)
    assert set(charts) == {"platform", "location", "remote", "timeline", "salary_histogram", "salary_density", "salary_box",
                           "category", "companies"}
    assert charts["salary_density"].count() == 200
    assert charts["platform"].agg(F.sum("n")).first()[0] == view.count()
    with pytest.raises(ValueError):
        report.chart_data("pie", view, AS_OF)
    empty = report.chart_data("remote", view.where("false"), AS_OF)["remote"].collect()
    assert [(r.n, r.percent) for r in empty] == [(0, None), (0, None)]


def test_parameters_are_values_not_sql(spark):
    register_overview(postings(spark, SF), AS_OF)
    trick = "x' OR '1'='1"
    assert run_sql(spark, "SELECT * FROM jobs_overview WHERE platform = :p", p=trick).count() == 0
    assert filters.filtered(spark.table("jobs_overview"), platform=trick).count() == 0
    assert filters.filtered(spark.table("jobs_overview")).count() == postings(spark, SF, ["id"]).count()


def test_exports_read_back(spark, tmp_path):
    df = postings(spark, SF, ["id", "platform", "city", "published_date", "is_remote"]).limit(50)
    df = df.orderBy("id").withColumn("title", F.lit("a, \"b\" <c> & დ"))
    exports.export(df, "csv", str(tmp_path / "csv"))
    back = exports.read_csv(spark, str(tmp_path / "csv"), df.schema)  # quotes are doubled, as other tools write them
    assert back.columns == df.columns and {r.title for r in back.collect()} == {"a, \"b\" <c> & დ"}
    exports.export(df, "json", str(tmp_path / "json"))
    rows = {r.id: r for r in df.collect()}
    for line in "".join(p.read_text(encoding="utf8") for p in (tmp_path / "json").glob("part-*")).splitlines():
        record = json.loads(line)
        row = rows.pop(record["id"])
        assert record["published_date"] == row.published_date.isoformat() and record["city"] == row.city
    assert not rows
    exports.export(df, "json", str(tmp_path / "ms"), epoch_ms=True)
    first = spark.read.json(str(tmp_path / "ms")).orderBy("id").first()
    stamp = df.orderBy("id").first().published_date
    assert first.published_date == int(stamp.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    exports.export(df, "xml", str(tmp_path / "xml"))
    assert spark.read.option("rowTag", "job").xml(str(tmp_path / "xml")).count() == 50
    exports.export(df, "parquet", str(tmp_path / "parquet"), partition_by=["platform"])
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 50
    with pytest.raises(ValueError):
        exports.export(df, "xlsx", str(tmp_path / "x"))
    marked = df.withColumn("problem", F.when(F.col("is_remote"), "x"))
    counts = exports.write_counted(marked, "parquet", str(tmp_path / "counted"), "problem")
    assert counts == {"total": 50, "failed": df.where("is_remote").count()}
    exports.write_report_tables(report.data_tables(overview(postings(spark, SF), AS_OF)), str(tmp_path / "tables"))
    assert spark.read.parquet(str(tmp_path / "tables" / "recent_postings")).count() == 10
    assert exports.export_path("data", "jobs", "csv", dt.datetime(2025, 1, 2, 3, 4, 5)) == "data/jobs_20250102_030405.csv"


def test_a_hot_source_is_written_by_many_tasks(spark, tmp_path):
    rows = [("hot" if i % 3 else "cold", str(i), dt.datetime(2025, 1, 1) + dt.timedelta(hours=i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "platform string, id string, scraped_date timestamp_ntz")
    exports.write_table(df, str(tmp_path / "t"), parts=6)
    back = spark.read.parquet(str(tmp_path / "t"))
    assert {tuple(r) for r in back.select("platform", "id", "scraped_date").collect()} == set(rows)
    spans = back.where("platform = 'hot'").groupBy(F.input_file_name().alias("f")).agg(
        F.min("scraped_date").alias("a"), F.max("scraped_date").alias("b")).orderBy("a").collect()
    assert len(spans) >= 3 and all(x.b < y.a for x, y in zip(spans, spans[1:]))


def test_records_as_json(spark):
    df = spark.createDataFrame([(1, None, dt.datetime(2025, 1, 2, 3, 4, 5))], "a int, b string, c timestamp_ntz")
    assert as_json(df).first().record == '{"a":1,"b":null,"c":"2025-01-02T03:04:05"}'


def split_events(spark, folder, parts=4):
    table(spark, SF, "events").repartition(parts, "event_id").write.parquet(folder)
    return spark.readStream.schema(table(spark, SF, "events").schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_streamed_windows_equal_batch_windows(spark, tmp_path):
    stream = split_events(spark, str(tmp_path / "in"))
    batch = table(spark, SF, "events")
    for name, job in {
        "daily": lambda df: windows.daily_windows(df, "ts", "40 days"),
        "activity": lambda df: windows.activity_windows(df, "ts", "event_type", delay="40 days"),
    }.items():
        query = (job(stream).writeStream.outputMode("complete").format("memory").queryName(f"w_{name}")
                 .option("checkpointLocation", str(tmp_path / f"c_{name}")).trigger(availableNow=True).start())
        query.awaitTermination()
        streamed = {tuple(r) for r in spark.table(f"w_{name}").collect()}
        assert streamed == {tuple(r) for r in job(batch).collect()} and streamed


def test_streamed_dedup_keeps_each_key_once(spark, tmp_path):
    stream = split_events(spark, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    query = (ingest.seen_once(stream, ["user_id", "event_type"], "ts", "40 days").writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination()
    got = spark.read.parquet(out).select("user_id", "event_type")
    assert got.count() == got.distinct().count() == table(spark, SF, "events").select("user_id", "event_type").distinct().count()


def test_streamed_pages_reach_the_log(spark, tmp_path):
    from tests.test_extraction import CARD, NOW, TABLE, pages

    folder = str(tmp_path / "pages")
    entries = [("jobs_ge", 200, TABLE.replace("id=123", f"id={i % 5}").replace("Driver", f"Driver {i}")) for i in range(20)]
    pages(spark, *entries, ("cv_ge", 200, CARD), ("cv_ge", 500, CARD)).repartitionByRange(3, "page_id").write.parquet(folder)
    for _ in range(2):  # a second run finds nothing new
        ingest.ingest_pages(spark, folder, str(tmp_path / "log"), str(tmp_path / "c"), NOW, 1).awaitTermination()
    current = ingest.listing_log(spark, str(tmp_path / "log")).current()
    assert {(r.platform, r.id) for r in current.collect()} == {("jobs_ge", str(i)) for i in range(5)} | {("cv_ge", "417196")}
    assert current.where("platform = 'jobs_ge'").count() == 5
    rejected = ingest.listing_log(spark, str(tmp_path / "log")).rejects()
    assert rejected.where("problem = 'HTTP 500'").count() == 1 and rejected.count() == 21


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(aggregates.count_by_platform(postings(spark, SF, ["platform"])))
    assert "ReadSchema: struct<o_orderstatus:string>" in plan and "Join" not in plan
    plan = plan_of(filters.filtered(postings(spark, SF, ["id", "is_remote", "title"]), remote=True))
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)]" in plan


HAS_PYTHON = {"links_in_sql", "reader_in_sql", "extract_listings", "extract_rejects", "extract_details", "ingest_listings", "ingest_rejects",
              "ingest_details", "ingest_children", "ingest_run_log", "ingest_run_errors", "detail_rejects", "crawl_feed", "page_texts"}


@pytest.mark.parametrize("name", [n for n in registered() if n not in HAS_PYTHON and n != "streamed_upsert"])
def test_plans_stay_in_the_jvm_without_cross_products(spark, name):
    plan = plan_of(registered()[name][0](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "ArrowEvalPython" not in plan and "MapInPandas" not in plan and "MapInArrow" not in plan


def test_top_values_need_no_full_sort(spark):
    view = overview(postings(spark, SF), AS_OF)
    assert "TakeOrderedAndProject" in plan_of(report.recent_postings(view))
