"""Queries over the overview of postings."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacancylake.functions import dates
from vacancylake.operators import aggregates, distributions, filters, projections, ranking
from vacancylake.operators.quantiles import exact_quantiles
from vacancylake.plans import report
from vacancylake.plans.overview import overview, register_overview, run_sql
from vacancylake.plans.queries import Registered
from vacancylake.sources import catalog
from vacancylake.sources.driver_tables import AS_OF, POSTINGS_SQL, postings, table

TABLE_NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

POSTINGS = f"WITH postings AS ({POSTINGS_SQL})"
OVERVIEW = f"""{POSTINGS}, overview AS (
SELECT *,
       CASE WHEN salary_min IS NOT NULL AND salary_max IS NOT NULL
            THEN CAST(salary_min AS VARCHAR) || '-' || CAST(salary_max AS VARCHAR) || ' ' || coalesce(salary_currency, '')
            WHEN salary_min IS NOT NULL
            THEN 'From ' || CAST(salary_min AS VARCHAR) || ' ' || coalesce(salary_currency, '')
            ELSE 'Not specified' END AS salary_range,
       CASE WHEN is_remote THEN 'Remote'
            WHEN city IS NOT NULL AND region IS NOT NULL THEN city || ', ' || region
            WHEN city IS NOT NULL THEN city
            ELSE 'Location not specified' END AS location_display,
       CAST(trunc(epoch(TIMESTAMP '{AS_OF}' - scraped_date) / 86400) AS BIGINT) AS days_since_scraped,
       CAST(trunc(epoch(TIMESTAMP '{AS_OF}' - published_date) / 86400) AS BIGINT) AS days_since_published
FROM postings)"""

_ALL_COLUMNS = """id, platform, title, company_name, city, region, country, is_remote, job_type, category,
CAST(salary_min AS DOUBLE) AS salary_min, CAST(salary_max AS DOUBLE) AS salary_max, salary_currency,
published_date, scraped_date, url, short_description, has_salary_info, is_featured, is_new,
salary_range, location_display, days_since_scraped, days_since_published"""


def _overview(spark, sf):
    return overview(postings(spark, sf), AS_OF)


def _plain(df):
    """Salary columns as doubles, so that every engine prints them alike."""
    return df.withColumns({c: F.col(c).cast("double") for c in ("salary_min", "salary_max")})


def _top(column, k=15):
    return lambda spark, sf: ranking.top_values(postings(spark, sf, [column]), column, k)


def _top_sql(column, k=15):
    return f"""{POSTINGS} SELECT {column}, count(*) AS n FROM postings WHERE {column} IS NOT NULL
    GROUP BY {column} ORDER BY n DESC, {column} LIMIT {k}"""


def _salaries(spark, sf):
    return postings(spark, sf, ["platform", "salary_min", "has_salary_info"]).where("has_salary_info")


def _adhoc(spark, sf):
    register_overview(postings(spark, sf), AS_OF)
    return run_sql(
        spark,
        """SELECT category, location_display, count(*) AS n, max(days_since_scraped) AS oldest
           FROM jobs_overview WHERE platform = :platform AND is_new GROUP BY category, location_display""",
        platform="site_a",
    )


QUERIES: Registered = {
    "jobs_overview": (
        lambda spark, sf: _plain(_overview(spark, sf)),
        f"{OVERVIEW} SELECT {_ALL_COLUMNS} FROM overview",
    ),
    "filtered_overview": (
        lambda spark, sf: _plain(
            filters.filtered(_overview(spark, sf), platform="site_b", remote=True, has_salary=True)
        ),
        f"{OVERVIEW} SELECT {_ALL_COLUMNS} FROM overview WHERE platform = 'site_b' AND is_remote AND has_salary_info",
    ),
    "search_postings": (
        lambda spark, sf: filters.filtered(
            postings(spark, sf, ["id", "platform", "title", "city"]), location="TION_1", query="Mach"
        ),
        f"""{POSTINGS} SELECT id, platform, title, city FROM postings
        WHERE contains(lower(coalesce(city, '')), 'tion_1') AND contains(lower(title), 'mach')""",
    ),
    "show_projection": (
        lambda spark, sf: projections.show_columns(_overview(spark, sf)),
        f"""{OVERVIEW} SELECT platform, substr(title, 1, 25) AS title,
        substr(coalesce(company_name, 'N/A'), 1, 20) AS company, substr(location_display, 1, 15) AS location,
        substr(salary_range, 1, 15) AS salary, CAST(coalesce(days_since_scraped, 0) AS VARCHAR) AS days_ago,
        CASE WHEN is_remote THEN '✅' ELSE '❌' END AS remote FROM overview""",
    ),
    "display_cut": (
        lambda spark, sf: projections.display_cut(
            overview(postings(spark, sf), AS_OF).select("id", "title", "salary_range", "location_display")
        ),
        f"""{OVERVIEW} SELECT substr(id, 1, 20) AS id, substr(title, 1, 20) AS title,
        substr(salary_range, 1, 20) AS salary_range, substr(location_display, 1, 20) AS location_display FROM overview""",
    ),
    "latest_postings": (
        lambda spark, sf: _plain(ranking.latest(_overview(spark, sf), 50)),
        f"{OVERVIEW} SELECT {_ALL_COLUMNS} FROM overview ORDER BY scraped_date DESC NULLS FIRST, platform, id LIMIT 50",
    ),
    "recent_postings": (
        lambda spark, sf: report.recent_postings(_overview(spark, sf)),
        f"""{OVERVIEW} SELECT platform, title, company_name, location_display, salary_range, days_since_scraped
        FROM overview ORDER BY scraped_date DESC NULLS FIRST, platform, id LIMIT 10""",
    ),
    "count_by_platform": (
        lambda spark, sf: aggregates.count_by_platform(postings(spark, sf, ["platform"])),
        f"{POSTINGS} SELECT platform, count(*) AS n FROM postings GROUP BY platform",
    ),
    "overview_stats": (
        lambda spark, sf: aggregates.overview_stats(postings(spark, sf, ["is_remote", "has_salary_info"])),
        f"""{POSTINGS} SELECT count(*) AS total_jobs, count(*) FILTER (is_remote) AS remote_jobs,
        count(*) FILTER (has_salary_info) AS with_salary FROM postings""",
    ),
    "platform_stats": (
        lambda spark, sf: aggregates.platform_stats(
            postings(spark, sf, ["platform", "is_remote", "has_salary_info", "company_name"])
        ),
        f"""{POSTINGS} SELECT platform, count(*) AS total_jobs, count(*) FILTER (is_remote) AS remote_jobs,
        count(*) FILTER (has_salary_info) AS with_salary, count(DISTINCT company_name) AS unique_companies
        FROM postings GROUP BY platform""",
    ),
    "distinct_counts": (
        lambda spark, sf: aggregates.distinct_counts(
            postings(spark, sf, ["platform", "company_name", "city"]), ["platform", "company_name", "city"]
        ),
        f"""{POSTINGS} SELECT count(DISTINCT platform) AS unique_platform,
        count(DISTINCT company_name) AS unique_company_name, count(DISTINCT city) AS unique_city FROM postings""",
    ),
    "distinct_platforms": (
        lambda spark, sf: postings(spark, sf, ["platform"]).distinct(),
        f"{POSTINGS} SELECT DISTINCT platform FROM postings",
    ),
    "date_range": (
        lambda spark, sf: postings(spark, sf, ["scraped_date"]).agg(
            F.min("scraped_date").alias("earliest"), F.max("scraped_date").alias("latest")
        ),
        f"{POSTINGS} SELECT min(scraped_date) AS earliest, max(scraped_date) AS latest FROM postings",
    ),
    "key_check": (
        lambda spark, sf: aggregates.key_check(postings(spark, sf, ["id", "platform"]), ["id", "platform"]),
        f"{POSTINGS} SELECT count(*) AS total_rows, count(DISTINCT (id, platform)) AS unique_keys FROM postings",
    ),
    "id_ranges": (
        lambda spark, sf: aggregates.id_ranges(postings(spark, sf, ["id", "platform"])),
        f"""{POSTINGS} SELECT platform, min(id) AS min_id, max(id) AS max_id, count(*) AS n
        FROM postings GROUP BY platform""",
    ),
    "recent_activity": (
        lambda spark, sf: aggregates.recent_activity(
            postings(spark, sf, ["platform", "scraped_date"]), "2001-08-02 06:00:00", 24
        ),
        f"""{POSTINGS} SELECT platform, count(*) AS n, max(scraped_date) AS last_scraped FROM postings
        WHERE scraped_date >= TIMESTAMP '2001-08-02 06:00:00' - INTERVAL 24 HOUR GROUP BY platform""",
    ),
    "daily_counts": (
        lambda spark, sf: aggregates.daily_counts(postings(spark, sf, ["scraped_date"]), AS_OF, 90)
        .withColumn("day", F.col("day").cast("string")),
        f"""{POSTINGS} SELECT CAST(CAST(scraped_date AS DATE) AS VARCHAR) AS day, count(*) AS n FROM postings
        WHERE scraped_date >= TIMESTAMP '{AS_OF}' - to_days(90) GROUP BY 1""",
    ),
    "remote_share": (
        lambda spark, sf: aggregates.remote_share(postings(spark, sf, ["is_remote"])),
        f"""{POSTINGS}, c AS (SELECT count(*) FILTER (NOT is_remote) AS a, count(*) FILTER (is_remote) AS b FROM postings)
        SELECT 'Non-Remote' AS label, a AS n, round(100.0 * a / (a + b), 1) AS percent FROM c
        UNION ALL SELECT 'Remote', b, round(100.0 * b / (a + b), 1) FROM c""",
    ),
    "top_cities": (_top("city"), _top_sql("city")),
    "top_categories": (_top("category"), _top_sql("category")),
    "top_companies": (_top("company_name"), _top_sql("company_name")),
    "value_counts": (
        lambda spark, sf: aggregates.value_counts(postings(spark, sf, ["company_name"]), "company_name"),
        f"""{POSTINGS} SELECT company_name, count(*) AS n FROM postings
        WHERE company_name IS NOT NULL GROUP BY company_name""",
    ),
    "salary_mean": (
        lambda spark, sf: aggregates.salary_mean(postings(spark, sf, ["salary_min"])).select(
            F.round("avg_min_salary", 4).alias("avg_min_salary")
        ),
        f"{POSTINGS} SELECT round(avg(CAST(salary_min AS DOUBLE)), 4) AS avg_min_salary FROM postings",
    ),
    "salary_median": (
        lambda spark, sf: exact_quantiles(postings(spark, sf, ["platform", "salary_min"]), "salary_min", [0.5], "platform")
        .select("platform", "n", F.round(F.element_at("quantiles", 1), 4).alias("median_min_salary")),
        f"""{POSTINGS} SELECT platform, count(salary_min) AS n,
        round(median(CAST(salary_min AS DOUBLE)), 4) AS median_min_salary FROM postings GROUP BY platform""",
    ),
    "salary_histogram": (
        lambda spark, sf: distributions.histogram(_salaries(spark, sf), "salary_min").select(
            "bin", F.round("low_edge", 4).alias("low_edge"), F.round("high_edge", 4).alias("high_edge"), "n"
        ),
        f"""{POSTINGS}, x AS (SELECT CAST(salary_min AS DOUBLE) AS x FROM postings
                              WHERE has_salary_info AND salary_min IS NOT NULL),
        b AS (SELECT min(x) AS lo, max(x) AS hi FROM x),
        c AS (SELECT least(CAST(floor((x - lo) / ((hi - lo) / 20)) AS BIGINT) + 1, 20) AS bin, count(*) AS n
              FROM x, b GROUP BY 1)
        SELECT CAST(s.bin AS INTEGER) AS bin, round(lo + (s.bin - 1) * (hi - lo) / 20, 4) AS low_edge,
               round(lo + s.bin * (hi - lo) / 20, 4) AS high_edge, coalesce(n, 0) AS n
        FROM range(1, 21) AS s(bin) CROSS JOIN b LEFT JOIN c ON c.bin = s.bin""",
    ),
    "salary_kde": (
        lambda spark, sf: distributions.density_curve(_salaries(spark, sf), "salary_min").select(
            F.col("point").cast("int").alias("point"),
            F.round("x", 4).alias("x"), F.round("density_count", 6).alias("density_count"),
        ),
        f"""{POSTINGS}, x AS (SELECT CAST(salary_min AS DOUBLE) AS x FROM postings
                              WHERE has_salary_info AND salary_min IS NOT NULL),
        f AS (SELECT count(*) AS total, stddev_samp(x) * pow(count(*), -0.2) AS h, min(x) AS lo, max(x) AS hi FROM x),
        v AS (SELECT x, count(*) AS n FROM x GROUP BY x),
        g AS (SELECT i AS point, lo + i * (hi - lo) / 199 AS gx FROM range(200) AS r(i), f)
        SELECT CAST(point AS INTEGER) AS point, round(gx, 4) AS x,
               round(sum(n * exp(-0.5 * pow((gx - v.x) / h, 2))) * any_value((hi - lo) / 20 / (h * sqrt(2 * pi()))), 6)
               AS density_count
        FROM g, v, f GROUP BY point, gx""",
    ),
    "salary_box": (
        lambda spark, sf: distributions.box_stats(_salaries(spark, sf)).select(
            "platform", "n", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")],
            "outliers",
        ),
        f"""{POSTINGS}, x AS (SELECT platform, CAST(salary_min AS DOUBLE) AS x FROM postings
                              WHERE has_salary_info AND salary_min IS NOT NULL),
        q AS (SELECT platform, count(*) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
                     quantile_cont(x, 0.75) AS q3 FROM x GROUP BY platform)
        SELECT platform, any_value(n) AS n, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median,
               round(any_value(q3), 4) AS q3,
               round(least(min(x) FILTER (x >= q1 - 1.5 * (q3 - q1)), any_value(q1)), 4) AS whisker_low,
               round(greatest(max(x) FILTER (x <= q3 + 1.5 * (q3 - q1)), any_value(q3)), 4) AS whisker_high,
               count(*) FILTER (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS outliers
        FROM x JOIN q USING (platform) GROUP BY platform""",
    ),
    "salary_outliers": (
        # fourth powers have a long upper tail
        lambda spark, sf: distributions.box_outliers(
            table(spark, sf, "lineitem").select(
                F.col("l_returnflag").alias("platform"),
                F.pow("l_quantity", F.lit(4.0)).cast("decimal(10,2)").alias("salary_min"),
            )
        ),
        """WITH x AS (SELECT l_returnflag AS platform,
                             CAST(CAST(pow(l_quantity, 4) AS DECIMAL(10,2)) AS DOUBLE) AS x FROM lineitem),
        q AS (SELECT platform, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM x GROUP BY platform)
        SELECT platform, x AS salary_min FROM x JOIN q USING (platform)
        WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)""",
    ),
    "summary_stats": (
        lambda spark, sf: report.summary_stats(
            postings(spark, sf, ["platform", "is_remote", "has_salary_info", "company_name", "city", "category",
                                 "salary_min", "scraped_date"])
        ).withColumn("value", F.round("value", 4)),
        f"""{POSTINGS}
        SELECT metric, item, round(value, 4) AS value FROM (
        SELECT 'total_jobs' AS metric, '' AS item, CAST(count(*) AS DOUBLE) AS value FROM postings
        UNION ALL SELECT 'remote_jobs', '', count(*) FILTER (is_remote) FROM postings
        UNION ALL SELECT 'jobs_with_salary', '', count(*) FILTER (has_salary_info) FROM postings
        UNION ALL SELECT 'avg_min_salary', '', avg(CAST(salary_min AS DOUBLE)) FROM postings
        UNION ALL SELECT 'median_min_salary', '', median(CAST(salary_min AS DOUBLE)) FROM postings
        UNION ALL SELECT 'platforms', '', count(DISTINCT platform) FROM postings
        UNION ALL SELECT 'unique_companies', '', count(DISTINCT company_name) FROM postings
        UNION ALL SELECT 'unique_cities', '', count(DISTINCT city) FROM postings
        UNION ALL SELECT 'earliest', '', epoch(min(scraped_date)) FROM postings
        UNION ALL SELECT 'latest', '', epoch(max(scraped_date)) FROM postings
        UNION ALL SELECT 'platform_breakdown', platform, count(*) FROM postings GROUP BY platform
        UNION ALL SELECT * FROM (SELECT 'top_categories', category, count(*) FROM postings
                                 WHERE category IS NOT NULL GROUP BY category ORDER BY count(*) DESC, category LIMIT 5))""",
    ),
    "table_counts": (
        lambda spark, sf: aggregates.table_counts({n: table(spark, sf, n) for n in TABLE_NAMES}),
        " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in TABLE_NAMES),
    ),
    "table_profile": (
        lambda spark, sf: catalog.table_profile({n: table(spark, sf, n) for n in TABLE_NAMES}).select(
            "table_name", "position", "column_name", "data_type", "column_default", "row_count"
        ),
        "SELECT c.table_name, CAST(c.ordinal_position AS INTEGER) AS position, c.column_name, c.data_type, c.column_default, k.n AS row_count "
        "FROM information_schema.columns c JOIN ("
        + " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in TABLE_NAMES)
        + ") k ON k.table_name = c.table_name",
    ),
    "adhoc_sql": (
        _adhoc,
        f"""{OVERVIEW} SELECT category, location_display, count(*) AS n, max(days_since_scraped) AS oldest
        FROM overview WHERE platform = 'site_a' AND is_new GROUP BY category, location_display""",
    ),
    "op_counters": (
        lambda spark, sf: aggregates.operation_counters(
            table(spark, sf, "events").select(
                F.col("user_id").alias("platform"),
                F.when(F.col("value") > 20, "details").otherwise("listings").alias("operation"),
                F.when(F.col("event_type").isin("view", "signup", "purchase"), "success")
                .when(F.col("event_type") == "error", "error").otherwise("warning").alias("level"),
                "ts",
            ),
            ["platform", "operation"], "level", "ts",
        ).withColumn("duration_seconds", F.round("duration_seconds", 3)),
        """SELECT user_id AS platform, CASE WHEN value > 20 THEN 'details' ELSE 'listings' END AS operation,
        count(*) FILTER (event_type IN ('view', 'signup', 'purchase')) AS success_count,
        count(*) FILTER (event_type = 'error') AS error_count,
        count(*) FILTER (event_type = 'click') AS warning_count,
        round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS duration_seconds
        FROM events GROUP BY 1, 2""",
    ),
    "ingest_rate": (
        lambda spark, sf: aggregates.ingest_rate(table(spark, sf, "events"), "user_id", "ts").withColumn(
            "rows_per_second", F.round("rows_per_second", 9)
        ),
        """SELECT user_id, count(*) AS n, CASE WHEN max(ts) > min(ts) THEN
        round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 9) END AS rows_per_second
        FROM events GROUP BY user_id""",
    ),
    "progress": (
        lambda spark, sf: table(spark, sf, "orders").join(
            table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
                F.count("*").alias("total"), F.count_if(F.col("l_linestatus") == "F").alias("done")),
            "o_orderkey", "left",
        ).select(
            "o_orderkey",
            F.round(aggregates.progress_percent(
                F.coalesce("done", F.lit(0)), F.coalesce("total", F.lit(0))), 4).alias("percent"),
        ),
        """SELECT o_orderkey, round(CASE WHEN coalesce(total, 0) > 0 THEN 100.0 * done / total ELSE 0 END, 4) AS percent
        FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS total, count(*) FILTER (l_linestatus = 'F') AS done
                               FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
    ),
    "run_summary": (
        lambda spark, sf: aggregates.run_summary(
            table(spark, sf, "events").withColumn("error", F.when(F.col("event_type") == "error", F.col("props"))),
            "user_id", "error", "ts", "ts",
        ).select("user_id", "total_found", "succeeded", "failed", "start_time", "end_time",
                 F.round("duration_seconds", 3).alias("duration_seconds")),
        """SELECT user_id, count(*) AS total_found, count(*) FILTER (event_type <> 'error') AS succeeded,
        count(*) FILTER (event_type = 'error') AS failed, min(ts) AS start_time, max(ts) AS end_time,
        round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS duration_seconds FROM events GROUP BY user_id""",
    ),
    "last_days": (
        lambda spark, sf: filters.within_days(postings(spark, sf, ["id", "platform", "scraped_date"]),
                                              "scraped_date", AS_OF, 120),
        f"""{POSTINGS} SELECT id, platform, scraped_date FROM postings
        WHERE scraped_date >= TIMESTAMP '{AS_OF}' - to_days(120)""",
    ),
    "remote_labels": (
        lambda spark, sf: postings(spark, sf, ["id", "is_remote", "published_date"]).select(
            "id", F.when(F.col("is_remote"), "Remote").otherwise("Non-Remote").alias("label"),
            dates.iso_text(F.col("published_date")).alias("published"),
        ),
        f"""{POSTINGS} SELECT id, CASE WHEN is_remote THEN 'Remote' ELSE 'Non-Remote' END AS label,
        strftime(published_date, '%Y-%m-%dT%H:%M:%S') AS published FROM postings""",
    ),
}
