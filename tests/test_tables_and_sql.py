"""Bucketed tables, one-pass reports, quotas, SQL functions, VARIANT bodies and sketches."""

import datetime as dt
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacancylake.operators import distributions, quality, ranking, sketches, upsert
from vacancylake.operators.quantiles import exact_quantiles
from vacancylake.plans import report, sql_functions
from vacancylake.plans.overview import run_sql
from vacancylake.sinks import bucketed
from vacancylake.sources.driver_tables import postings, table
from vacancylake.sources.raw_pages import variant_fields

SF = "/root/testdata/sf0.001"
T = [dt.datetime(2025, 9, d) for d in range(1, 10)]
KEY = ["platform", "id"]
WRITES = "platform string, id string, title string, description string, scraped_date timestamp_ntz, seq int"
STORED = WRITES + ", created_at timestamp_ntz, updated_at timestamp_ntz"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def above(plan: str, leaf: str) -> list[str]:
    """The nodes between the leaf's line and the root, nearest first."""
    lines = plan.split("\n")
    at = next(k for k, line in enumerate(lines) if leaf in line)
    depth, out = len(lines[at]) - len(lines[at].lstrip(" :+-*()0123456789")), []
    for line in reversed(lines[:at]):
        own = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if line.strip() and own < depth:
            depth = own
            out.append(line.lstrip(" :+-*()0123456789").split(" ")[0])
    return out


def writes(spark, seed, n=400, keys=150):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        key = ("hot", "0") if rng.random() < 0.34 else (rng.choice("abc"), str(rng.randrange(keys)))
        rows.append((*key, rng.choice(["x", None, f"t{seq}"]), f"d{seq}", T[0] + dt.timedelta(minutes=seq), 1000 * seed + seq))
    return spark.createDataFrame(rows, WRITES)


@pytest.fixture
def stored_table(spark, tmp_path):
    first = upsert.upsert(spark.createDataFrame([], STORED), writes(spark, 1), T[5], ["seq"])
    name = f"stored_{random.randrange(10**9)}"
    yield name, str(tmp_path / "v1"), bucketed.write_bucketed(first, name, str(tmp_path / "v1"), KEY, 8)
    bucketed.forget(spark, name)


def test_bucketed_upsert_leaves_the_stored_rows_where_they_are(spark, stored_table, tmp_path):
    name, path, current = stored_table
    fresh = writes(spark, 2)
    out = upsert.upsert_bucketed(current, fresh, T[6], ["seq"], last_wins=["description"])
    over = above(plan_of(out), name)
    assert any("ShuffledHashJoin" in x for x in over)
    assert not any("Exchange" in x or "Sort" in x for x in over)
    want = upsert.upsert(spark.read.parquet(path), fresh, T[6], ["seq"], last_wins=["description"])
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    # the next version needs no shuffle either, and is read by bucket again
    second = bucketed.write_bucketed(out, name + "_next", str(tmp_path / "v2"), KEY, 8, dealt=True)
    assert "Bucketed: true" in plan_of(upsert.upsert_bucketed(second, fresh, T[7], ["seq"]))
    assert len(list((tmp_path / "v2").glob("*.parquet"))) == 8
    bucketed.forget(spark, name + "_next")


def test_a_forgotten_table_is_opened_from_its_folder(spark, stored_table):
    name, path, current = stored_table
    rows = sorted(map(str, current.collect()))
    bucketed.forget(spark, name)
    again = bucketed.open_bucketed(spark, name, path, KEY, 8)
    assert sorted(map(str, again.collect())) == rows
    out = upsert.upsert_bucketed(again, writes(spark, 3), T[6], ["seq"])
    assert not any("Exchange" in x for x in above(plan_of(out), name))
    with pytest.raises(Exception, match="exist"):
        bucketed.write_bucketed(current, name, path, KEY, 8)


def test_bucketed_upsert_of_nothing_and_of_rows_without_a_key(spark, stored_table):
    _, _, current = stored_table
    before = sorted(map(str, current.collect()))
    assert sorted(map(str, upsert.upsert_bucketed(current, writes(spark, 2).limit(0), T[6], ["seq"]).collect())) == before
    no_key = spark.createDataFrame([("a", None, "t", "d", T[0], 1), (None, "1", "t", "d", T[0], 2)], WRITES)
    assert sorted(map(str, upsert.upsert_bucketed(current, no_key, T[6], ["seq"]).collect())) == before


def test_reports_read_each_table_once(spark):
    counts = report.summary_counts(postings(spark, SF))
    assert plan_of(counts).count("orders.parquet") == 1 and "Expand" in plan_of(counts)
    view = postings(spark, SF, ["id", "platform", "company_name"])
    known = table(spark, SF, "supplier").select("s_name")
    plan = plan_of(quality.quality_report(view, quality.rules_for(["id"], {"platform": 5}), ["platform", "company_name"], (known, "company_name", "s_name")))
    assert plan.count("orders.parquet") == 1 and plan.count("supplier.parquet") == 1 and "Join" not in plan.replace("customer", "").split("orders")[0]


QUALITY_ROWS = [("a", "1", "x"), ("a", "1", "y"), ("a", "2", None), ("b", None, "z"), ("b", None, "z"), (None, "1", "x"), ("c", "3", "longer text")]


@pytest.mark.parametrize("rows", [QUALITY_ROWS, []])
@pytest.mark.parametrize("key", [None, ["p"], ["p", "i"], ["i"]])
@pytest.mark.parametrize("with_parent", [True, False])
def test_quality_report_as_counted_by_hand(spark, rows, key, with_parent):
    df = spark.createDataFrame(rows, "p string, i string, t string")
    known = spark.createDataFrame([("1",), ("1",), ("9",), (None,)], "k string")
    found = quality.quality_report(df, quality.rules_for(["p", "t"], {"t": 3}), key, (known, "i", "k") if with_parent else None)
    want = {
        "not_null:p": sum(r[0] is None for r in rows), "not_null:t": sum(r[2] is None for r in rows),
        "length:t<=3": sum(len(r[2] or "") > 3 for r in rows),
    }
    if key:
        groups = Counter(tuple(r["pit".index(k)] for k in key) for r in rows)
        want["unique:" + ",".join(key)] = sum(n > 1 for n in groups.values())
    if with_parent:
        want["reference:i"] = sum(r[1] is not None and r[1] != "1" for r in rows)
    assert {r["rule"]: (r["row_count"], r["violations"]) for r in found.collect()} == {k: (len(rows), v) for k, v in want.items()}


@pytest.mark.parametrize("quota", [1, 7, 2500])
def test_quota_in_page_order_with_ties_and_a_hot_source(spark, quota):
    rng = random.Random(quota)
    rows = [(rng.choice(["hot"] * 5 + ["a", "b", None]), rng.randrange(40), k) for k in range(6000)]
    df = spark.createDataFrame(rows, "source string, page int, pos int").repartition(9)
    found = ranking.quota_per_source(df, "source", ["page", "pos"], quota)
    want = []
    for source in {r[0] for r in rows}:
        want += sorted((r for r in rows if r[0] == source), key=lambda r: r[1:])[:quota]
    plan = plan_of(found)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("WindowGroupLimit") == 4
    tied = ranking.quota_per_source(df.withColumn("page", F.lit(1)), "source", ["page"], quota)
    sizes = Counter(r[0] for r in rows)
    assert {r["source"]: r["count"] for r in tied.groupBy("source").count().collect()} == {s: min(n, quota) for s, n in sizes.items()}


def test_density_curve_is_exact_and_stays_in_the_jvm(spark):
    values = [round(float(x), 2) for x in np.random.default_rng(3).lognormal(7, 0.4, 800)] * 2 + [1e6]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "salary double").repartition(5)
    found = distributions.density_curve(df, "salary").orderBy("point")
    assert "Python" not in plan_of(found) and "InPandas" not in plan_of(found)
    x = np.array(values)
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    want = np.exp(-0.5 * ((grid[:, None] - x[None]) / h) ** 2).sum(axis=1) * (x.max() - x.min()) / 20 / (h * math.sqrt(2 * math.pi))
    rows = found.collect()
    assert np.allclose([r["x"] for r in rows], grid) and np.allclose([r["density_count"] for r in rows], want)
    for few in ([], [5.0], [5.0, 5.0]):
        assert distributions.density_curve(spark.createDataFrame([(v,) for v in few], "salary double"), "salary").count() == 0


def test_histogram_of_one_value_and_of_none(spark):
    one = distributions.histogram(spark.createDataFrame([(4.0,), (4.0,)], "x double"), "x", 4).orderBy("bin").collect()
    assert [(r["low_edge"], r["n"]) for r in one] == [(3.5, 0), (3.75, 0), (4.0, 2), (4.25, 0)]
    assert distributions.histogram(spark.createDataFrame([(None,)], "x double"), "x").count() == 0


@pytest.mark.parametrize("kind", ["decimal(10,2)", "double"])
def test_weighted_quantiles_are_those_of_the_repeated_rows(spark, kind):
    rows = [("a", 10, 3), ("a", 20, 1), ("a", None, 9), ("b", 7, 2), ("b", 9, 2)]
    df = spark.createDataFrame(rows, "g string, v int, w long").withColumn("v", F.col("v").cast(kind))
    found = exact_quantiles(df, "v", [0.0, 0.5, 1.0], "g", weight="w")
    assert {r["g"]: (r["n"], r["quantiles"]) for r in found.collect()} == {"a": (4, [10.0, 10.0, 20.0]), "b": (4, [7.0, 8.0, 9.0])}


def test_scalar_and_table_functions_in_sql(spark):
    rows = spark.createDataFrame(
        [("s", "1", True, "c", "r", None, None, None, T[0], T[1]), ("s", "2", False, "it's", None, 1.5, 2.5, None, T[3], None), ("u", "3", None, None, "r", 1.0, None, "GEL", None, T[4])],
        "platform string, id string, is_remote boolean, city string, region string, low double, high double, salary_currency string, scraped_date timestamp_ntz, published_date timestamp_ntz")
    listings = rows.withColumns({"salary_min": F.col("low").cast("decimal(10,2)"), "salary_max": F.col("high").cast("decimal(10,2)"), "title": F.lit("t")})
    sql_functions.register_overview_function(spark, listings, "2025-09-03 12:00:00", "few_listings")
    found = {r["id"]: tuple(r)[3:] for r in run_sql(spark, "SELECT * FROM overview_of(CAST(NULL AS STRING))").collect()}
    assert found == {"1": ("Not specified", "Remote", 2, 1), "2": ("1.50-2.50 ", "it's", 0, None), "3": ("From 1.00 GEL", "Location not specified", None, -1)}
    assert run_sql(spark, "SELECT id FROM overview_of(:p)", p="u").collect()[0][0] == "3"


def test_readers_and_links_in_sql(spark):
    spark.createDataFrame([(1, "<p><a href='/a'> x <b>y</b></a><a>none</a><a href=b>z"), (2, ""), (3, None)], "k int, html string").createOrReplaceTempView("few_pages")
    sql_functions.register_link_function(spark, "few_links")
    found = run_sql(spark, "SELECT k, l.* FROM few_pages, LATERAL few_links(html) AS l ORDER BY k, pos").collect()
    assert [tuple(r) for r in found] == [(1, 0, "/a", "x y"), (1, 1, "b", "z")]

    def words(html):
        if not html:
            raise ValueError("empty page")
        return [{"word": w, "size": len(w)} for w in html.split()]

    sql_functions.register_reader(spark, "few_words", words, {"word": "string", "size": "int"})
    found = run_sql(spark, "SELECT k, w.row_no, w.size, w.problem FROM few_pages, LATERAL few_words(html) AS w").collect()
    assert [r["problem"] for r in found if r["k"] > 1] == ["ValueError: empty page"] * 2
    assert [r["row_no"] for r in sorted(found) if r["k"] == 1] == list(range(len([r for r in found if r["k"] == 1])))


def test_variant_bodies_are_read_whole_or_not_at_all(spark):
    bodies = [
        '{"a": 1, "items": [{"n": 1}, {"n": 2, "w": "x"}, {}]}', '{"a": "1", "items": []}', '{"a": [], "items": null}', '{"items": {"n": 1}}',
        '{"items": [{"n": "word"}, {"n": 2}]}', '{"a": 1} {"a": 2}', "", None, "[1]", '{"a": null}', '{"a": 1}, {"a": 2}', "{",
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "k int, body string")
    good, bad = variant_fields(df, "body", {"a": ("$.a", "int")})
    assert sorted((r["k"], r["a"]) for r in good.collect() if r["a"] is not None) == [(0, 1), (1, 1)]
    assert {r["k"] for r in good.collect()} == {0, 1, 3, 4, 8, 9}
    assert {r["k"]: r["error"] for r in bad.collect()} == {2: "a field is not of its type"} | {k: "not JSON" for k in (5, 6, 7, 10, 11)}
    good, bad = variant_fields(df, "body", {"n": ("$.n", "int"), "w": ("$.w", "string")}, "$.items")
    assert sorted((r["k"], r["item_no"], r["n"], r["w"]) for r in good.fillna("").fillna(-1).collect()) == [(0, 0, 1, ""), (0, 1, 2, "x"), (0, 2, -1, "")]
    assert {r["k"]: r["error"] for r in bad.collect() if r["k"] < 5} == {3: "$.items is not a list", 4: "a field is not of its type"}


def test_merged_sketches_keep_their_bounds(spark):
    n = 120_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("platform"), (F.xxhash64("id") % 30_000).cast("string").alias("company_name"),
        F.pow(F.rand(7), F.lit(3.0)).alias("salary"), F.timestamp_add("HOUR", F.col("id") % (24 * 70), F.lit("2025-01-01").cast("timestamp_ntz")).alias("scraped_date"))
    daily = sketches.daily_sketches(rows, ["company_name"], "salary")
    weekly = sketches.figures(sketches.merged(daily, ["company_name"], sketches.week_of(F.col("day")), "week"), ["company_name"], [0.1, 0.5, 0.9])
    exact = {r["week"]: r for r in rows.groupBy(sketches.week_of(F.col("scraped_date").cast("date")).alias("week")).agg(
        F.count("*").alias("n"), F.count_distinct("company_name").alias("companies"), F.sort_array(F.collect_list("salary")).alias("all")).collect()}
    found = weekly.collect()
    assert len(found) == len(exact) == 11
    for r in found:
        want = exact[r["week"]]
        assert r["n"] == want["n"] and abs(r["about_company_name"] - want["companies"]) <= want["companies"] * sketches.COUNT_ERROR
        for p, q in zip((0.1, 0.5, 0.9), r["quantiles"]):
            assert abs(np.searchsorted(want["all"], q) / want["n"] - p) <= 2 * sketches.RANK_ERROR + 2 / want["n"]


def test_sketches_of_nothing_and_replaced_days(spark):
    rows = spark.createDataFrame([("a", "x", None, T[0]), ("a", None, None, T[1]), ("b", "y", 5.0, None), ("a", "z", 1.0, T[1])], "platform string, company_name string, salary double, scraped_date timestamp_ntz")
    daily = sketches.daily_sketches(rows, ["company_name"], "salary")
    whole = sketches.figures(sketches.merged(daily, ["company_name"], F.lit(1)), ["company_name"], [0.5]).first()
    assert (whole["n"], whole["n_amount"], whole["about_company_name"]) == (4, 2, 3)
    none = sketches.figures(daily.where("n_amount = 0"), ["company_name"]).collect()
    assert none and all(r["quantiles"] is None for r in none)
    again = sketches.refreshed(daily, sketches.daily_sketches(rows.where("company_name = 'z'"), ["company_name"], "salary"), T[1].date())
    assert sorted((str(r["day"]), r["n"]) for r in again.collect()) == [("2025-09-01", 1), ("2025-09-02", 1), ("None", 1)]
    assert sketches.daily_sketches(rows.limit(0), ["company_name"], "salary").count() == 0
