"""Queries over upserts, child tables, integrity, quality and code lookups."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from vacancylake import fixed_values as fixed
from vacancylake.functions import flags
from vacancylake.operators import aggregates, children, filters, joins, projections, quality, ranking, sets, upsert
from vacancylake.operators.aggregates import run_summary
from vacancylake.plans.ingest import run_record
from vacancylake.plans.queries import Registered
from vacancylake.plans.queries.analytics import POSTINGS
from vacancylake.session import new_shared_path
from vacancylake.sinks import bucketed
from vacancylake.sources import dimensions, raw_pages
from vacancylake.sources.driver_tables import AS_OF, postings, table

_DAY = "2024-02-01 00:00:00"
_SPLIT = "2024-01-15 00:00:00"


def sightings(spark, sf):
    """Events as writes of postings: source, id, text columns, moment seen."""
    return table(spark, sf, "events").select(
        F.concat(F.lit("site_"), F.col("user_id") % 3).alias("platform"),
        F.concat(F.col("user_id") % 50, F.lit("-"), F.lower("event_type")).alias("id"),
        F.col("props").alias("title"),
        F.when(F.col("event_id") % 4 != 0, F.concat(F.lit("text "), F.col("event_id"))).alias("description"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("experience_level"),
        F.lit(None).cast("string").alias("education_level"),
        F.col("ts").alias("scraped_date"),
        "event_id",
    )


SIGHTINGS = """WITH writes AS (SELECT 'site_' || (user_id % 3) AS platform,
  (user_id % 50) || '-' || lower(event_type) AS id, props AS title,
  CASE WHEN event_id % 4 <> 0 THEN 'text ' || event_id END AS description,
  CASE WHEN event_id % 3 <> 0 THEN event_type END AS experience_level, ts AS scraped_date, event_id FROM events)"""


def _stored_and_new(spark, sf, key, last_wins=None):
    writes = sightings(spark, sf)
    boundary = F.lit(_SPLIT).cast("timestamp_ntz")
    old = writes.where(F.col("scraped_date") < boundary)
    stored = upsert.fold_writes(old, key, ["event_id"], last_wins=last_wins).drop("writes")
    stored = stored.withColumns({"created_at": boundary, "updated_at": boundary})
    return stored, writes.where(F.col("scraped_date") >= boundary)


def _upserted(key, last_wins=None):
    def run(spark, sf):
        stored, fresh = _stored_and_new(spark, sf, key, last_wins)
        return upsert.upsert(stored, fresh, _DAY, ["event_id"], key, last_wins=last_wins)

    return run


def _upserted_in_buckets(key, last_wins=None, buckets=16):
    """The stored rows as a bucketed table, the run's writes folded into it bucket by bucket, and the new version stored likewise."""

    def run(spark, sf):
        stored, fresh = _stored_and_new(spark, sf, key, last_wins)
        before, after = f"postings_{uuid4().hex}", f"postings_{uuid4().hex}"
        current = bucketed.write_bucketed(stored, before, new_shared_path(spark, "bucketed"), key, buckets)
        table = upsert.upsert_bucketed(current, fresh, _DAY, ["event_id"], key, last_wins=last_wins)
        out = bucketed.write_bucketed(table, after, new_shared_path(spark, "bucketed"), key, buckets, dealt=True)
        for name in (before, after):
            bucketed.forget(spark, name)
        return out

    return run


def _upserted_sql(key, last_wins=()):
    def pick(c):
        return f"{'arg_max_null' if c in last_wins else 'arg_min_null'}({c}, event_id) AS {c}"

    firsts = [c for c in ("platform", "id", "title", "description", "experience_level") if c not in key]
    return f"""{SIGHTINGS} SELECT {', '.join(key)}, {', '.join(pick(c) for c in firsts)},
    CAST(NULL AS VARCHAR) AS education_level, min(event_id) AS event_id,
    arg_max(scraped_date, event_id) AS scraped_date,
    CASE WHEN arg_min(scraped_date, event_id) < TIMESTAMP '{_SPLIT}' THEN TIMESTAMP '{_SPLIT}' ELSE TIMESTAMP '{_DAY}' END
    AS created_at,
    CASE WHEN max(scraped_date) >= TIMESTAMP '{_SPLIT}' THEN TIMESTAMP '{_DAY}' ELSE TIMESTAMP '{_SPLIT}' END AS updated_at
    FROM writes GROUP BY {', '.join(key)}"""


def _changed_key(spark, sf):
    wide = upsert.fold_writes(sightings(spark, sf), ["platform", "id"], ["event_id"]).drop("writes")
    return upsert.change_key(wide, ["id"], ["event_id"]).select("id", "platform", "title", "event_id", "scraped_date")


def nested_listings(spark, sf):
    """Postings in the nested record shape, with some groups missing."""
    flat = postings(spark, sf)
    key = F.col("id").cast("bigint")
    no = F.lit(False)
    none = F.lit(None).cast("string")
    named = {"industry": none, "size": none, "location": none, "description": none, "website": none, "jobs_url": none}
    return flat.select(
        "id", "platform", "title",
        F.when(key % 9 != 0, F.struct("city", "region", "country", "is_remote")).alias("location"),
        F.when(key % 8 != 0, F.struct(
            F.col("company_name").alias("name"), F.lit("/l.png").alias("logo_url"),
            *[c.alias(n) for n, c in named.items()])).alias("company"),
        F.when(key % 10 != 0, F.struct(
            no.alias("is_expiring"), no.alias("was_recently_updated"), "has_salary_info", "is_new",
            no.alias("is_in_region"), "is_remote", "is_featured", no.alias("is_urgent"),
            F.when(key % 6 != 0, key % 4 == 0).alias("is_vip"))).alias("metadata"),
        F.struct(
            F.col("published_date").alias("published"), F.col("scraped_date").alias("deadline"),
            F.lit(None).cast("timestamp_ntz").alias("updated"), F.col("scraped_date").alias("scraped")).alias("dates"),
        F.when(F.col("salary_min").isNotNull(), F.struct(
            F.col("salary_min").cast("double").alias("min_amount"), F.col("salary_max").cast("double").alias("max_amount"),
            F.col("salary_currency").alias("currency"), F.lit("monthly").alias("period"),
            F.lit(True).alias("is_negotiable"))).alias("salary"),
        "job_type", "category", "url", "short_description",
    )


def _flat_listings(spark, sf):
    df = projections.flatten_listing(nested_listings(spark, sf), AS_OF)
    return df.withColumns({c: F.col(c).cast("double") for c in ("salary_min", "salary_max")})


_K = "CAST(id AS BIGINT)"
_FLAT_SQL = f"""{POSTINGS} SELECT id, platform, title, job_type, category, url, short_description,
CASE WHEN {_K} % 9 <> 0 THEN city END AS city, CASE WHEN {_K} % 9 <> 0 THEN region END AS region,
CASE WHEN {_K} % 9 <> 0 THEN country END AS country, CASE WHEN {_K} % 9 <> 0 THEN is_remote ELSE FALSE END AS is_remote,
CASE WHEN {_K} % 8 <> 0 THEN company_name END AS company_name, CAST(NULL AS VARCHAR) AS company_website,
CASE WHEN {_K} % 8 <> 0 THEN '/l.png' END AS company_logo_url,
CAST(salary_min AS DOUBLE) AS salary_min,
CASE WHEN salary_min IS NOT NULL THEN CAST(salary_max AS DOUBLE) END AS salary_max,
CASE WHEN salary_min IS NOT NULL THEN salary_currency END AS salary_currency,
CASE WHEN salary_min IS NOT NULL THEN 'monthly' END AS salary_period, salary_min IS NOT NULL AS salary_negotiable,
published_date, scraped_date AS deadline_date, CAST(NULL AS TIMESTAMP) AS updated_date,
TIMESTAMP '{AS_OF}' AS scraped_date, FALSE AS is_expiring, FALSE AS was_recently_updated,
{_K} % 10 <> 0 AND has_salary_info AS has_salary_info, {_K} % 10 <> 0 AND is_new AS is_new, FALSE AS is_in_region,
{_K} % 10 <> 0 AND is_featured AS is_featured, FALSE AS is_urgent,
CASE WHEN {_K} % 10 = 0 THEN FALSE WHEN {_K} % 6 <> 0 THEN {_K} % 4 = 0 END AS is_vip FROM postings"""


def _flat_details(spark, sf):
    listings = nested_listings(spark, sf)
    details = listings.withColumns({
        "description": F.when(F.col("id").cast("bigint") % 7 != 0, F.col("short_description")),
        "experience_level": F.col("job_type"), "education_level": F.lit(None).cast("string"),
        "application_url": F.concat(F.col("url"), F.lit("/apply")),
        "description_file_path": F.lit(None).cast("string"),
    })
    return projections.flatten_detail(details, AS_OF).select(
        "id", "platform", "description", "experience_level", "application_url", "company_name", "company_industry",
        "city", "is_remote", F.col("salary_min").cast("double").alias("salary_min"), "salary_negotiable",
        "published_date", "scraped_date", "is_vip",
    )


def items(spark, sf):
    """Feed items, some with an empty id, a missing title or no address."""
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.when(key % 10 == 0, "").otherwise(key.cast("string")).alias("id"),
        F.when(key % 11 == 0, F.lit(None).cast("string")).when(key % 13 == 0, "  ")
        .otherwise(F.concat(F.lit("\t Role "), key, F.lit(" "))).alias("title"),
        F.when(key % 12 != 0, F.concat(F.lit("/p/"), key)).alias("url"),
        F.concat(F.lit(" "), "o_orderpriority", F.lit("\n")).alias("company_name"),
        F.when(key % 3 != 0, F.col("o_orderdate")).alias("scraped_date"),
    )


def _item_problems(spark, sf):
    _, rejected = filters.validate_items(items(spark, sf), AS_OF)
    return rejected.groupBy("reason").agg(F.count("*").alias("n"))


def _quality(spark, sf):
    rules = quality.rules_for(["id", "city", "salary_currency"], {"title": 15, "company_name": 17, "city": 8})
    known = table(spark, sf, "customer").where("c_acctbal > 0").select("c_name")
    return quality.quality_report(
        postings(spark, sf, ["id", "platform", "title", "company_name", "city", "salary_currency", "category"]),
        rules, key=["platform", "company_name"], parent=(known, "company_name", "c_name"),
    )


def _broken(spark, sf):
    rules = quality.rules_for(["city", "salary_currency"], {"title": 15})
    _, bad = quality.split_by_rules(postings(spark, sf, ["id", "title", "city", "salary_currency"]), rules)
    return bad.select("id", F.array_join("broken_rules", ",").alias("broken"))


def _child_lines(spark, sf):
    parents = table(spark, sf, "documents").select(
        F.col("source").alias("platform"), F.col("doc_id").alias("id"), F.split("text", "\n").alias("requirements"))
    return children.child_rows(parents, "requirements", "requirement", AS_OF).select(
        "platform", "job_id", "position", F.md5("requirement").alias("requirement"), "created_at")


def _contacts(spark, sf):
    key = F.col("c_custkey")
    parents = table(spark, sf, "customer").select(
        F.lit("site_a").alias("platform"), key.alias("id"),
        F.create_map(
            F.lit("email"), F.when(key % 4 != 0, F.concat(F.lit(" "), "c_name", F.lit("@example.org "))),
            F.lit("phone"), F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("+"), key)),
            F.lit("person"), F.when(key % 5 == 0, " \t").otherwise(F.col("c_mktsegment")),
        ).alias("contact_info"),
    )
    return children.contact_rows(parents, AS_OF)


def _whole(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity", "l_tax")
    good, _ = children.accept_whole(
        table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"),
        [(lines, F.col("l_quantity") > 48), (lines, F.col("l_tax") >= 0.08)], ["o_orderkey"],
    )
    return good


def _replaced(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    saved = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    fresh = saved.select("l_orderkey", F.lit(0).alias("l_linenumber"), F.lit("new").alias("l_returnflag"))
    return children.replace_children(lines, fresh, saved, ["l_orderkey"])


def _lookup(spark, sf):
    names = [*fixed.CATEGORY_CODES["jobs_ge"], "Astronomy", "Sales"]
    rows = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 3 == 0, "ss_ge").otherwise("jobs_ge").alias("platform"),
        F.element_at(F.lit(names), (F.col("c_custkey") % len(names) + 1).cast("int")).alias("name"),
    )
    return joins.lookup_code(rows, dimensions.categories(spark), ["platform", "name"])


def _lookup_sql():
    names = [*fixed.CATEGORY_CODES["jobs_ge"], "Astronomy", "Sales"]
    values = ", ".join(f"('{p}', '{n}', '{c}')" for p in ("jobs_ge", "ss_ge") for n, c in fixed.CATEGORY_CODES[p].items())
    listed = ", ".join(f"'{n}'" for n in names)
    return f"""WITH codes(platform, name, code) AS (VALUES {values}),
    rows AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'ss_ge' ELSE 'jobs_ge' END AS platform,
             ([{listed}])[CAST(c_custkey % {len(names)} + 1 AS INTEGER)] AS name FROM customer)
    SELECT c_custkey, platform, name, coalesce(code, '') AS code FROM rows LEFT JOIN codes USING (platform, name)"""


def _united(spark, sf):
    a = postings(spark, sf, ["id", "platform", "title", "city"]).where("platform = 'site_a'")
    b = postings(spark, sf, ["id", "platform", "title", "salary_currency"]).where("platform = 'site_b'")
    c = postings(spark, sf, ["platform", "id"]).where("platform = 'site_c'")
    return sets.union_sources([a, b, c])


def _named_runs(spark, sf):
    events = table(spark, sf, "events").withColumn("error", F.when(F.col("event_type") == "error", F.col("props")))
    parts = []
    for name, chosen in {"small": F.col("value") < 10, "large": F.col("value") >= 10}.items():
        one = run_summary(events.where(chosen).withColumn("platform", F.lit("all")), "platform", "error", "ts", "ts")
        parts.append(one.select(F.lit(name).alias("run_name"), "total_found", "failed"))
    return sets.union_sources(parts)


def _run_rows(spark, sf):
    events = table(spark, sf, "events").select(
        F.concat(F.lit("site_"), F.col("user_id") % 3).alias("platform"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error"), "ts")
    return run_record(run_summary(events, "platform", "error", "ts", "ts"), AS_OF)


def _run_errors(spark, sf):
    runs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.split("text", r"\. ").alias("errors"))
    rows = children.error_rows(runs, AS_OF)
    return rows.groupBy("scraping_result_id").agg(F.count("*").alias("n"), F.sum(F.length("error_message")).alias("size"))


QUERIES: Registered = {
    "upsert_first_wins": (_upserted(["platform", "id"]), _upserted_sql(["platform", "id"])),
    "upsert_single_key": (_upserted(["id"]), _upserted_sql(["id"])),
    "upsert_mixed": (
        _upserted(["platform", "id"], upsert.DETAIL_LAST_WINS),
        _upserted_sql(["platform", "id"], upsert.DETAIL_LAST_WINS),
    ),
    "upsert_bucketed": (_upserted_in_buckets(["platform", "id"]), _upserted_sql(["platform", "id"])),
    "upsert_bucketed_mixed": (
        _upserted_in_buckets(["platform", "id"], upsert.DETAIL_LAST_WINS),
        _upserted_sql(["platform", "id"], upsert.DETAIL_LAST_WINS),
    ),
    "change_key": (
        _changed_key,
        # the narrowed table keeps the earliest wide row and the moment of the latest one
        f"""{SIGHTINGS}, wide AS (SELECT platform, id, arg_min(title, event_id) AS title, min(event_id) AS event_id,
            arg_max(scraped_date, event_id) AS scraped_date FROM writes GROUP BY platform, id)
        SELECT id, arg_min(platform, event_id) AS platform, arg_min(title, event_id) AS title,
               arg_max(scraped_date, event_id) AS scraped_date, min(event_id) AS event_id FROM wide GROUP BY id""",
    ),
    "flatten_listing": (_flat_listings, _FLAT_SQL),
    "flatten_detail": (
        _flat_details,
        f"""{POSTINGS} SELECT id, platform, CASE WHEN {_K} % 7 <> 0 THEN short_description ELSE '' END AS description,
        job_type AS experience_level, url || '/apply' AS application_url,
        CASE WHEN {_K} % 8 <> 0 THEN company_name END AS company_name, CAST(NULL AS VARCHAR) AS company_industry,
        CASE WHEN {_K} % 9 <> 0 THEN city END AS city, {_K} % 9 <> 0 AND is_remote AS is_remote,
        CAST(salary_min AS DOUBLE) AS salary_min, salary_min IS NOT NULL AS salary_negotiable, published_date,
        TIMESTAMP '{AS_OF}' AS scraped_date,
        CASE WHEN {_K} % 10 = 0 THEN FALSE WHEN {_K} % 6 <> 0 THEN {_K} % 4 = 0 END AS is_vip FROM postings""",
    ),
    "crawler_items": (
        lambda spark, sf: projections.crawler_items(nested_listings(spark, sf)).drop("scraped_date"),
        f"""{POSTINGS} SELECT id, platform, title, url, CASE WHEN {_K} % 8 <> 0 THEN company_name ELSE '' END AS company_name,
        CASE WHEN {_K} % 8 = 0 THEN '' END AS company_url,
        CASE WHEN {_K} % 8 <> 0 THEN '/l.png' ELSE '' END AS company_logo_url,
        CASE WHEN {_K} % 9 <> 0 THEN city ELSE '' END AS location_city,
        CASE WHEN {_K} % 9 <> 0 THEN country ELSE '' END AS location_country,
        {_K} % 9 <> 0 AND is_remote AS location_is_remote, FALSE AS is_expiring, FALSE AS was_recently_updated,
        {_K} % 10 <> 0 AND has_salary_info AS has_salary_info, {_K} % 10 <> 0 AND is_new AS is_new, FALSE AS is_in_region,
        CASE WHEN {_K} % 10 = 0 THEN FALSE WHEN {_K} % 6 <> 0 THEN {_K} % 4 = 0 END AS is_vip,
        published_date, scraped_date AS deadline_date FROM postings""",
    ),
    "record_json": (
        lambda spark, sf: projections.as_json(table(spark, sf, "orders").select(
            "o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("published"),
            F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("note"))),
        """SELECT '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","published":"'
        || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '","note":'
        || CASE WHEN o_orderkey % 3 = 0 THEN '"' || o_orderpriority || '"' ELSE 'null' END || '}' AS record FROM orders""",
    ),
    "lineage": (
        lambda spark, sf: projections.stamp_lineage(
            table(spark, sf, "pages").select("page_id", "url"), "site_a", "card", AS_OF),
        f"""SELECT page_id, url, 'site_a' AS _platform_type, 'card' AS _scraper_info, TIMESTAMP '{AS_OF}' AS _scraped_at
        FROM pages""",
    ),
    "platform_code": (
        lambda spark, sf: table(spark, sf, "customer").select(
            "c_custkey", flags.platform_code(
                F.element_at(F.lit(["Jobs.ge", "CV.ge", "jobs.ss.ge", "ss_ge", "elsewhere"]),
                             (F.col("c_custkey") % 5 + 1).cast("int"))).alias("platform")),
        """SELECT c_custkey, (['jobs_ge', 'cv_ge', 'ss_ge', 'ss_ge', 'elsewhere'])[CAST(c_custkey % 5 + 1 AS INTEGER)]
        AS platform FROM customer""",
    ),
    "validate_items": (
        lambda spark, sf: filters.validate_items(items(spark, sf), AS_OF)[0],
        f"""SELECT CAST(o_orderkey AS VARCHAR) AS id,
        CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE 'Role ' || o_orderkey END AS title, '/p/' || o_orderkey AS url,
        trim(o_orderpriority) AS company_name,
        CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate ELSE TIMESTAMP '{AS_OF}' END AS scraped_date
        FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 12 <> 0""",
    ),
    "rejected_items": (
        _item_problems,
        """SELECT 'Missing required field: ' || CASE WHEN o_orderkey % 10 = 0 THEN 'id' WHEN o_orderkey % 11 = 0 THEN 'title'
        ELSE 'url' END AS reason, count(*) AS n FROM orders
        WHERE o_orderkey % 10 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 12 = 0 GROUP BY 1""",
    ),
    "reject_split": (
        lambda spark, sf: filters.split_rejects(table(spark, sf, "events").withColumn(
            "error", F.when(F.col("event_type") == "error", F.col("props"))))[1].select("event_id", "error"),
        "SELECT event_id, props AS error FROM events WHERE event_type = 'error'",
    ),
    "quality_report": (
        _quality,
        f"""{POSTINGS}, known AS (SELECT c_name FROM customer WHERE c_acctbal > 0)
        SELECT 'not_null:id' AS rule, count(*) AS row_count, count(*) FILTER (id IS NULL) AS violations FROM postings
        UNION ALL SELECT 'not_null:city', count(*), count(*) FILTER (city IS NULL) FROM postings
        UNION ALL SELECT 'not_null:salary_currency', count(*), count(*) FILTER (salary_currency IS NULL) FROM postings
        UNION ALL SELECT 'length:title<=15', count(*), count(*) FILTER (length(title) > 15) FROM postings
        UNION ALL SELECT 'length:company_name<=17', count(*), count(*) FILTER (length(company_name) > 17) FROM postings
        UNION ALL SELECT 'length:city<=8', count(*), count(*) FILTER (length(city) > 8) FROM postings
        UNION ALL SELECT 'unique:platform,company_name', CAST(sum(c) AS BIGINT), count(*) FILTER (c > 1)
            FROM (SELECT count(*) AS c FROM postings GROUP BY platform, company_name)
        UNION ALL SELECT 'reference:company_name', count(*),
            count(*) FILTER (company_name IS NOT NULL AND company_name NOT IN (SELECT c_name FROM known)) FROM postings""",
    ),
    "broken_rows": (
        _broken,
        f"""{POSTINGS} SELECT id, concat_ws(',', CASE WHEN city IS NULL THEN 'not_null:city' END,
        CASE WHEN salary_currency IS NULL THEN 'not_null:salary_currency' END,
        CASE WHEN length(title) > 15 THEN 'length:title<=15' END) AS broken FROM postings
        WHERE city IS NULL OR salary_currency IS NULL OR length(title) > 15""",
    ),
    "duplicate_keys": (
        lambda spark, sf: quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"]),
        "SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    ),
    "child_rows": (
        _child_lines,
        f"""SELECT source AS platform, doc_id AS job_id, CAST(pos AS INTEGER) AS position, md5(line) AS requirement,
        TIMESTAMP '{AS_OF}' AS created_at FROM (
            SELECT source, doc_id, trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13) || chr(160)) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents) WHERE line <> ''""",
    ),
    "contact_rows": (
        _contacts,
        f"""SELECT 'site_a' AS platform, c_custkey AS job_id, contact_type, contact_value, TIMESTAMP '{AS_OF}' AS created_at
        FROM (SELECT c_custkey, 'email' AS contact_type, c_name || '@example.org' AS contact_value FROM customer
              WHERE c_custkey % 4 <> 0
              UNION ALL SELECT c_custkey, 'phone', '+' || c_custkey FROM customer WHERE c_custkey % 3 <> 0
              UNION ALL SELECT c_custkey, 'person', c_mktsegment FROM customer WHERE c_custkey % 5 <> 0)""",
    ),
    "run_rows": (
        _run_rows,
        f"""SELECT sha256('site_' || (user_id % 3) || '|' || rtrim(rtrim(strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') || '|{AS_OF}') AS id,
        'site_' || (user_id % 3) AS platform, count(*) AS total_jobs_found,
        count(*) FILTER (event_type <> 'error') AS successful_scrapes,
        count(*) FILTER (event_type = 'error') AS failed_scrapes, min(ts) AS start_time, max(ts) AS end_time,
        TIMESTAMP '{AS_OF}' AS created_at FROM events GROUP BY user_id % 3""",
    ),
    "run_errors": (
        _run_errors,
        f"""SELECT doc_id AS scraping_result_id, count(*) AS n, CAST(sum(length(m)) AS BIGINT) AS size FROM (
        SELECT doc_id, trim(unnest(string_split(text, '. ')), ' ' || chr(9) || chr(10) || chr(13) || chr(160)) AS m
        FROM documents) WHERE m <> '' GROUP BY doc_id""",
    ),
    "atomic_accept": (
        _whole,
        """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN
        (SELECT l_orderkey FROM lineitem WHERE l_quantity > 48 OR l_tax >= 0.08)""",
    ),
    "replace_children": (
        _replaced,
        """SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
        UNION ALL SELECT o_orderkey, 0, 'new' FROM orders WHERE o_orderstatus = 'P'""",
    ),
    "fk_orphans": (
        lambda spark, sf: children.orphans(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id", "doc_id"),
        "SELECT doc_id, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id",
    ),
    "cascade_delete": (
        lambda spark, sf: children.cascade_delete(
            table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"),
            table(spark, sf, "orders").where("o_orderstatus = 'F'"), "l_orderkey", "o_orderkey"),
        """SELECT l_orderkey, l_linenumber FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    ),
    "listing_detail_join": (
        lambda spark, sf: joins.with_details(
            table(spark, sf, "documents").select("doc_id", "lang", "source"), table(spark, sf, "labels"), ["doc_id"]),
        """SELECT doc_id, lang, source, quality, toxic, CASE WHEN l.doc_id IS NULL THEN 'no detail page' END AS error
        FROM documents LEFT JOIN labels l USING (doc_id)""",
    ),
    "dim_lookup": (_lookup, _lookup_sql()),
    "union_sources": (
        _united,
        f"""{POSTINGS} SELECT id, platform, CASE WHEN platform <> 'site_c' THEN title END AS title,
        CASE WHEN platform = 'site_a' THEN city END AS city,
        CASE WHEN platform = 'site_b' THEN salary_currency END AS salary_currency FROM postings""",
    ),
    "named_run_results": (
        _named_runs,
        """SELECT CASE WHEN value < 10 THEN 'small' ELSE 'large' END AS run_name, count(*) AS total_found,
        count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY 1""",
    ),
    "dedup_first": (
        lambda spark, sf: sets.dedup_first(sightings(spark, sf).select("platform", "id", "title", "description", "event_id"),
                                           ["platform", "id"], ["event_id"]),
        f"""{SIGHTINGS} SELECT platform, id, title, description, event_id FROM writes
        QUALIFY row_number() OVER (PARTITION BY platform, id ORDER BY event_id) = 1""",
    ),
    "source_quota": (
        lambda spark, sf: ranking.quota_per_source(
            table(spark, sf, "events").select("event_type", "ts", "event_id"), "event_type", ["ts", "event_id"], 2500),
        """SELECT event_type, ts, event_id FROM events
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 2500""",
    ),
    "detail_batches": (
        lambda spark, sf: ranking.in_batches(table(spark, sf, "orders").select("o_orderdate", "o_orderkey"),
                                             ["o_orderdate", "o_orderkey"], 10).select("o_orderkey", "row_no", "batch_no"),
        """WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_no FROM orders)
        SELECT o_orderkey, row_no, (row_no - 1) // 10 AS batch_no FROM n""",
    ),
    "page_frontier": (
        lambda spark, sf: raw_pages.page_frontier(
            table(spark, sf, "events").select(
                "user_id", F.col("event_id").alias("page_no"),
                F.when((F.col("event_type") == "error") & (F.col("value") > 15), 0).otherwise(5).alias("n_rows")),
            "user_id"),
        """WITH p AS (SELECT user_id, event_id AS page_no,
             CASE WHEN event_type = 'error' AND value > 15 THEN 0 ELSE 5 END AS n_rows FROM events),
        s AS (SELECT user_id, min(page_no) AS stop FROM p WHERE n_rows = 0 GROUP BY user_id)
        SELECT user_id, page_no, n_rows FROM p LEFT JOIN s USING (user_id) WHERE stop IS NULL OR page_no < stop""",
    ),
    "status_rejects": (
        lambda spark, sf: raw_pages.split_by_status(table(spark, sf, "pages").withColumn(
            "status", F.when(F.col("page_id") % 7 == 0, 404).when(F.col("page_id") % 5 != 0, 200)
        ))[1].select("page_id", "error"),
        """SELECT page_id, 'HTTP ' || CASE WHEN page_id % 7 = 0 THEN 404 ELSE 0 END AS error FROM pages
        WHERE page_id % 7 = 0 OR page_id % 5 = 0""",
    ),
    "api_listings": (
        lambda spark, sf: raw_pages.parse_bodies(
            table(spark, sf, "events").withColumn(
                "props", F.when(F.col("event_id") % 50 == 0, F.concat(F.col("props"), F.lit("}"))).otherwise(F.col("props"))),
            "props", "k int",
        )[0].select("event_id", F.col("body.k").alias("k")),
        """SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events WHERE event_id % 50 <> 0""",
    ),
    "count_by_source": (
        lambda spark, sf: aggregates.value_counts(table(spark, sf, "documents"), "source"),
        "SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source",
    ),
}
