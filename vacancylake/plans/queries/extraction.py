"""Queries over markup. Spark renders orders as pages; the SQL states the fields that must come back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from vacancylake import fixed_values as fixed
from vacancylake.functions.links import listing_url
from vacancylake.operators import extract, sets
from vacancylake.plans import ingest
from vacancylake.plans.queries import Registered
from vacancylake.session import new_shared_path, stored
from vacancylake.sinks.bucketed import forget, write_bucketed
from vacancylake.sources.driver_tables import AS_OF, postings, table
from vacancylake.sources.raw_pages import CrawlConfig

# two entries per page; the second lacks what the layout needs to identify it
_TABLE_PAGE = (
    "<html><body><table id='job_list_table'><tr><th>x</th></tr>"
    "<tr><td></td><td><a class=v href=\"/ge/?view=jobs&amp;id=%s\"> R&amp;D %s </a><i>%s</i>"
    "<img src='/i/new.gif'><img src=\"/i/%s.gif\"></td><td><a href='/c'><img src='/l.png'></a></td>"
    "<td><a href='/c/%s'>%s</a></td><td>%s %s</td><td>%s %s</td></tr>"
    "<tr><td></td><td><a href='/ge/?view=jobs'>no number</a></td><td></td><td></td><td></td><td></td></tr>"
    "<tr><td>short</td></tr></table></body></html>"
)
_CARD_PAGE = (
    "<div class='menu'><div class=\"list-item\">outside</div></div><div class='item-listing wide'>"
    "<div class='list-item first'><p class='list-item-title'><a class='announcement-list-item' "
    "href='/announcement/%s/x'>%s</a></p><span class='list-item-tag item-badge'>%s</span>"
    "<a class='list-item-company' href='/company/%s'>%s</a><span class='list-item-time'><b>%s %s</b> - %s %s</span>%s</div>"
    "<div class='list-item'><div>advert</div></div></div>"
)
_GENERATED_PAGE = (
    "<a href='%s'><div class='sc-28f268a4-2 udaGZ'><h2 class='sc-64e43013-0 jkUKFK title'>%s</h2>"
    "<span class='sc-64e43013-0 hdwvnh price'><span>%s</span> თვეში</span><div class='sc-28f268a4-1 d'>%s</div>"
    "<span class='sc-64e43013-0 jMGSUP'>3 წლამდე</span><span class='sc-64e43013-0 jMGSUP'>%s %s - %s %s</span>"
    "<div class='sc-28f268a4-5 j'>%s</div></div></a><div class='sc-28f268a4-2 udaGZ'>advert</div>"
)


def _spread(rows):
    """Narrow rows over all tasks before pages are made of them: a small file is one task otherwise."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")


def listing_pages(spark, sf):
    """One page per order, in the layout of one of three sources."""
    rows = postings(spark, sf, ["id", "title", "company_name", "city", "is_remote", "published_date", "salary_min",
                                "category"])
    rows = _spread(rows).withColumn("key", F.col("id").cast("bigint"))
    key = F.col("key")
    ends = F.col("published_date") + F.make_dt_interval((key % 20).cast("int"))

    def spelled(stamp, names):
        return [F.dayofmonth(stamp), F.element_at(F.lit(names), F.month(stamp))]

    full = fixed.GEORGIAN_MONTHS
    short = fixed.GEORGIAN_SHORT_MONTHS
    city = F.coalesce("city", F.lit(""))
    as_table = F.format_string(
        _TABLE_PAGE, "id", "title", F.when(F.col("is_remote"), "Remote").otherwise(city),
        F.when(key % 2 == 0, "salary").otherwise("upd"), "id", "company_name",
        *spelled(F.col("published_date"), full), *spelled(ends, fixed.ENGLISH_MONTHS),
    )
    as_card = F.format_string(
        _CARD_PAGE, "id", "title", city, "id", "company_name", *spelled(F.col("published_date"), short),
        *spelled(ends, short),
        F.when(key % 4 == 0, "<p class='list-item-location'>ვიპ</p>")
        .when(key % 4 == 1, "<p class='list-item-location'>-</p>").otherwise(""),
    )
    low = F.floor(F.coalesce("salary_min", F.lit(0))).cast("bigint")
    as_generated = F.format_string(
        _GENERATED_PAGE, F.when(key % 5 == 0, "/ka/l").otherwise(F.concat(F.lit("/ka/l/vacancies/"), "id")), "title",
        F.when(low > 0, F.concat(F.format_number(low, 0), F.lit(" - "), F.format_number(low + 200, 0), F.lit(" ₾")))
        .otherwise("შეთანხმებით"),
        F.repeat("category", F.lit(30)), *spelled(F.col("published_date"), full), *spelled(ends, full),
        F.when(key % 2 == 0, "სასწრაფოდ").otherwise("-"),
    )
    return rows.select(
        key.alias("page_id"),
        F.when(key % 3 == 0, "jobs_ge").when(key % 3 == 1, "cv_ge").otherwise("ss_ge").alias("platform"),
        F.when(key % 3 == 0, as_table).when(key % 3 == 1, as_card).otherwise(as_generated).alias("html"),
    )


def _flat(found):
    return found.select(
        "page_id", "row_no", "id", "platform", "title", F.col("location.city").alias("city"),
        F.col("location.is_remote").alias("is_remote"), F.col("company.name").alias("company"),
        F.col("company.jobs_url").alias("company_url"), F.col("dates.published").alias("published"),
        F.col("dates.deadline").alias("deadline"), F.col("salary.min_amount").alias("salary_min"),
        F.col("salary.max_amount").alias("salary_max"), F.col("metadata.has_salary_info").alias("has_salary"),
        F.col("metadata.is_new").alias("is_new"), F.col("metadata.is_vip").alias("is_vip"),
        F.col("metadata.is_urgent").alias("is_urgent"), "url", F.length("short_description").alias("description_size"),
    )


_IN_AS_OF_YEAR = """CASE WHEN month({0}) = 2 AND day({0}) = 29 THEN NULL
 ELSE CAST({0} - to_years(CAST(year({0}) - 2001 AS INTEGER)) AS TIMESTAMP) END"""

_LISTINGS_SQL = f"""WITH p AS (SELECT o_orderkey AS k, o_orderkey % 3 AS s, c_mktsegment || ' role ' || o_orderkey AS title,
    c_name, c_mktsegment, CASE WHEN o_orderkey % 17 <> 0 THEN n_name ELSE '' END AS city,
    o_orderpriority = '1-URGENT' AS urgent,
    CASE WHEN o_orderkey % 3 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) ELSE 0 END AS low,
    o_orderdate AS a, o_orderdate + to_days(CAST(o_orderkey % 20 AS INTEGER)) AS b
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT k AS page_id, 0 AS row_no,
  CASE WHEN s = 2 AND k % 5 = 0 THEN CAST(CAST('0x' || substr(md5(title), 1, 8) AS BIGINT) % 1000000 AS VARCHAR)
       ELSE CAST(k AS VARCHAR) END AS id,
  (['jobs_ge', 'cv_ge', 'ss_ge'])[CAST(s + 1 AS INTEGER)] AS platform,
  CASE WHEN s = 0 THEN 'R&D ' || title ELSE title END AS title,
  CASE s WHEN 0 THEN CASE WHEN urgent THEN 'Remote' ELSE city END WHEN 1 THEN city ELSE 'თბილისი' END AS city,
  s = 0 AND urgent AS is_remote,
  CASE WHEN s = 2 THEN 'Unknown Company' ELSE c_name END AS company,
  CASE s WHEN 0 THEN '/c/' || k WHEN 1 THEN 'https://www.cv.ge/company/' || k ELSE '' END AS company_url,
  {_IN_AS_OF_YEAR.format('a')} AS published, {_IN_AS_OF_YEAR.format('b')} AS deadline,
  CASE WHEN s = 2 AND low > 0 THEN CAST(low AS DOUBLE) END AS salary_min,
  CASE WHEN s = 2 AND low > 0 THEN CAST(low + 200 AS DOUBLE) END AS salary_max,
  CASE s WHEN 0 THEN k % 2 = 0 WHEN 1 THEN FALSE ELSE low > 0 END AS has_salary,
  s = 0 AS is_new,
  CASE WHEN s <> 1 THEN FALSE WHEN k % 4 = 0 THEN TRUE WHEN k % 4 = 1 THEN FALSE END AS is_vip,
  s = 2 AND k % 2 = 0 AS is_urgent,
  CASE s WHEN 0 THEN '/ge/?view=jobs&id=' || k WHEN 1 THEN 'https://www.cv.ge/announcement/' || k || '/x'
         ELSE 'https://jobs.ss.ge/ka/l' || CASE WHEN k % 5 = 0 THEN '' ELSE '/vacancies/' || k END END AS url,
  CASE WHEN s = 2 THEN CAST(CASE WHEN length(c_mktsegment) * 30 > 200 THEN 203 ELSE length(c_mktsegment) * 30 END AS INTEGER)
       END AS description_size
FROM p"""

_CONTENT_PAGE = (
    "<html><head><script>var t='<div class=\"entry-content\">';</script></head><body>"
    "<div class='entry-content'><h2>%s</h2><p>მოთხოვნები:</p><ul><li>%s</li><li>line %s</li></ul>"
    "<p>მოვალეობები:</p><p>%s</p><p>ხელფასი: %s-%s ლარი</p></div>"
    "<a href='/x'>x</a><a href='mailto:hr%s@example.org'>write</a>"
    "<aside class='widget widget_ci-company-info-widget'><p class='card-info-title'> %s </p></aside></body></html>"
)
_PLAIN_PAGE = (
    "<html><body><h1> %s </h1><div class='company-info'><a href='/c'>%s</a></div>"
    "<div id='job_description'><p>%s</p> <p>%s</p></div>%s</body></html>"
)


def detail_pages(spark, sf):
    """One detail page per order; one in seven has no content."""
    rows = _spread(postings(spark, sf, ["id", "title", "company_name", "category", "job_type", "salary_min"]))
    key = F.col("id").cast("bigint")
    low = F.floor(F.coalesce("salary_min", F.lit(100))).cast("bigint")
    content = F.format_string(_CONTENT_PAGE, "title", "category", "id", "job_type", low, low + 50, "id", "company_name")
    plain = F.format_string(
        _PLAIN_PAGE, "title", "company_name", "category", "job_type",
        F.when(key % 4 == 0, "<div class='salary'></div>").when(key % 4 == 2, "<b>100 ₾</b>").otherwise(""))
    return rows.select(
        key.alias("page_id"), "id", F.when(key % 2 == 0, "cv_ge").otherwise("jobs_ge").alias("platform"), "title",
        F.when(key % 2 == 1, plain).when(key % 7 == 0, "<p>gone</p>").otherwise(content).alias("html"),
    )


_DETAILS_SQL = """WITH p AS (SELECT o_orderkey AS k, c_mktsegment || ' role ' || o_orderkey AS title, c_name AS company,
    c_mktsegment AS category, lower(substr(o_orderpriority, 3, 20)) AS job_type,
    CASE WHEN o_orderkey % 3 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) ELSE 100 END AS low
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def _stored_details(spark, sf):
    pages = detail_pages(spark, sf)
    listings = pages.select("platform", "id", "title", F.concat(F.lit("/p/"), "id").alias("url"))
    return ingest.ingest_details(listings, pages, ingest.empty_table(spark, "job_details"), AS_OF)


def _details_repeats(spark, sf):
    """Pages of the same postings again: some failed, some later and empty, some later and good; a third of the rows stored before."""
    pages = detail_pages(spark, sf).withColumns({"status": F.lit(200), "fetched_at": F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))})
    key = F.col("id").cast("bigint")
    later = pages.withColumns({
        "page_id": key + 10**9, "fetched_at": F.to_timestamp_ntz(F.lit("2024-01-02 00:00:00")),
        "status": F.when(key % 5 == 1, 503).otherwise(200),
        "html": F.when(key % 5 == 2, F.lit("<p>gone</p>")).otherwise(F.concat(F.lit("<!-- again -->"), "html")),
    })
    first = pages.withColumn("status", F.when(key % 5 == 1, F.lit(500)).otherwise(F.lit(200)))
    listings = pages.select("platform", "id", "title", F.concat(F.lit("/p/"), "id").alias("url"))
    before = ingest.ingest_details(listings.where(key % 3 == 0), pages, ingest.empty_table(spark, "job_details"), "2024-01-01 00:00:00").table
    return ingest.ingest_details(listings, first.unionByName(later), stored(before, "details-before"), AS_OF)


def _child_values(child_tables):
    values = {"job_requirements": "requirement", "job_responsibilities": "responsibility",
              "job_contacts": "contact_value"}
    return sets.union_sources([
        child_tables[name].select(F.lit(name).alias("table_name"), "platform", "job_id", F.col(value).alias("value"))
        for name, value in values.items()
    ])


def _first_run(spark, sf):
    pages = listing_pages(spark, sf).withColumn("status", F.when(F.col("page_id") % 19 == 0, 500).otherwise(200))
    return ingest.ingest_listings(pages, ingest.empty_table(spark, "job_listings"), AS_OF, query="BUILD")


_EARLIER = "2001-08-20 06:00:00"


def _second_run(spark, sf):
    """All listings of even pages, then those of pages not divisible by four over that stored table."""
    pages = listing_pages(spark, sf).withColumn("status", F.when(F.col("page_id") % 19 == 0, 500).otherwise(200))
    first = ingest.ingest_listings(pages.where("page_id % 2 = 0"), ingest.empty_table(spark, "job_listings"), _EARLIER)
    return ingest.ingest_listings(pages.where("page_id % 4 <> 0"), stored(first.table, "listings-before"), AS_OF)


def _numbered_pages(spark, sf):
    """Listing pages at the addresses of a crawl in five categories and two languages; some failed, some without a listing."""
    key, number = F.col("page_id"), F.col("page_no")
    pages = listing_pages(spark, sf).withColumn("page_no", (F.floor(key / 3) % 60 + 1).cast("int"))
    return pages.withColumns({
        "url": listing_url(F.col("platform"), number, category_id=(key % 5).cast("string"), locale=F.when(key % 2 == 0, "ge").otherwise("en")),
        "status": F.when((key % 97 == 0) & (number > 18), 500).otherwise(200),
        "html": F.when((number == 45) & (F.col("platform") == "ss_ge"), "<html></html>").otherwise(F.col("html")),
        "fetched_at": F.lit(AS_OF).cast("timestamp_ntz"),
    })


def _crawled(config):
    def run(spark, sf):
        found = ingest.ingest_listings(_numbered_pages(spark, sf), ingest.empty_table(spark, "job_listings"), AS_OF, crawl=config)
        return found.table.select("platform", "id", "title", "company_name")

    return run


def _crawled_sql(asked, stops="(failed OR empty)"):
    """``asked``: which pages of the source with filters in its addresses; the other two have none."""
    return f"""WITH l AS ({_LISTINGS_SQL}), n AS (SELECT *, page_id // 3 % 60 + 1 AS page_no, page_id % 97 = 0 AND page_id // 3 % 60 + 1 > 18 AS failed,
      platform = 'ss_ge' AND page_id // 3 % 60 + 1 = 45 AS empty FROM l),
    a AS (SELECT * FROM n WHERE CASE platform WHEN 'jobs_ge' THEN {asked} WHEN 'cv_ge' THEN page_no <= 24 ELSE page_no <= 50 END),
    s AS (SELECT platform, min(page_no) AS stop FROM a WHERE {stops} GROUP BY platform),
    r AS (SELECT a.* FROM a LEFT JOIN s USING (platform) WHERE (stop IS NULL OR page_no < stop) AND NOT failed AND NOT empty)
    SELECT platform, id, arg_min(title, (page_no, page_id)) AS title, arg_min(company, (page_no, page_id)) AS company_name FROM r GROUP BY platform, id"""


def _bucketed_runs(spark, sf):
    """Two runs over a table in buckets: the second reads the first one's table where it lies and writes the next version there."""
    pages = listing_pages(spark, sf).withColumn("status", F.when(F.col("page_id") % 19 == 0, 500).otherwise(200))
    key, names, current = ["platform", "id"], [], ingest.empty_table(spark, "job_listings")
    for chosen, as_of in (("page_id % 2 = 0", _EARLIER), ("page_id % 4 <> 0", AS_OF)):
        found = ingest.ingest_listings(pages.where(chosen), current, as_of, bucketed=bool(names))
        name, path = f"listings_{uuid4().hex}", new_shared_path(spark, "listings")
        current = write_bucketed(found.table, name, path, key, 16, dealt=bool(names))
        names.append(name)
    for name in names:
        forget(spark, name)
    return current


QUERIES: Registered = {
    "ingest_category": (_crawled(CrawlConfig(category_id="3", locale="en")), _crawled_sql("page_id % 5 = 3 AND page_id % 2 = 1")),
    "ingest_locale": (_crawled(CrawlConfig(category_id="2", locale="ge", stop_at_failed=False)), _crawled_sql("page_id % 5 = 2 AND page_id % 2 = 0", "empty")),
    "ingest_listings_again": (
        lambda spark, sf: _second_run(spark, sf).table.select(
            "platform", "id", "title", "company_name", F.col("salary_min").cast("double").alias("salary_min"),
            "scraped_date", "created_at", "updated_at"),
        f"""WITH l AS ({_LISTINGS_SQL}), p AS (SELECT *, page_id % 2 = 0 AS early, page_id % 4 <> 0 AS late FROM l WHERE page_id % 19 <> 0)
        SELECT platform, id, arg_min(title, (NOT early, page_id)) AS title, arg_min(company, (NOT early, page_id)) AS company_name,
        arg_min_null(salary_min, (NOT early, page_id)) AS salary_min,
        CASE WHEN bool_or(late) THEN TIMESTAMP '{AS_OF}' ELSE TIMESTAMP '{_EARLIER}' END AS scraped_date,
        CASE WHEN bool_or(early) THEN TIMESTAMP '{_EARLIER}' ELSE TIMESTAMP '{AS_OF}' END AS created_at,
        CASE WHEN bool_or(late) THEN TIMESTAMP '{AS_OF}' ELSE TIMESTAMP '{_EARLIER}' END AS updated_at
        FROM p GROUP BY platform, id""",
    ),
    "ingest_bucketed": (
        lambda spark, sf: _bucketed_runs(spark, sf).select("platform", "id", "title", "scraped_date", "created_at", "updated_at"),
        f"""WITH l AS ({_LISTINGS_SQL}), p AS (SELECT *, page_id % 2 = 0 AS early, page_id % 4 <> 0 AS late FROM l WHERE page_id % 19 <> 0)
        SELECT platform, id, arg_min(title, (NOT early, page_id)) AS title,
        CASE WHEN bool_or(late) THEN TIMESTAMP '{AS_OF}' ELSE TIMESTAMP '{_EARLIER}' END AS scraped_date,
        CASE WHEN bool_or(early) THEN TIMESTAMP '{_EARLIER}' ELSE TIMESTAMP '{AS_OF}' END AS created_at,
        CASE WHEN bool_or(late) THEN TIMESTAMP '{AS_OF}' ELSE TIMESTAMP '{_EARLIER}' END AS updated_at
        FROM p GROUP BY platform, id""",
    ),
    "extract_listings": (
        lambda spark, sf: _flat(extract.accepted(extract.extract_listings(listing_pages(spark, sf), AS_OF))),
        _LISTINGS_SQL,
    ),
    "extract_rejects": (
        lambda spark, sf: extract.rejects(extract.extract_listings(listing_pages(spark, sf), AS_OF)),
        """SELECT o_orderkey AS page_id, 'jobs_ge' AS platform, 1 AS row_no, 'no id' AS problem FROM orders
           WHERE o_orderkey % 3 = 0
        UNION ALL SELECT o_orderkey, 'jobs_ge', 2, 'fewer than 6 cells' FROM orders WHERE o_orderkey % 3 = 0
        UNION ALL SELECT o_orderkey, 'cv_ge', 1, 'no title' FROM orders WHERE o_orderkey % 3 = 1
        UNION ALL SELECT o_orderkey, 'ss_ge', 1, 'no title' FROM orders WHERE o_orderkey % 3 = 2""",
    ),
    "extract_details": (
        lambda spark, sf: extract.extract_details(detail_pages(spark, sf)).select(
            "page_id", "platform", "problem", "title", "company_name", "contact_email", "has_salary_mark",
            F.col("salary_text.amount").alias("amount"), "requirements", "responsibilities",
            F.md5("description").alias("description")),
        f"""{_DETAILS_SQL} SELECT k AS page_id, CASE WHEN k % 2 = 0 THEN 'cv_ge' ELSE 'jobs_ge' END AS platform,
        CASE WHEN k % 14 = 0 THEN 'no content' END AS problem, CASE WHEN k % 2 = 1 THEN title ELSE '' END AS title,
        CASE WHEN k % 14 = 0 THEN '' ELSE company END AS company_name,
        CASE WHEN k % 14 = 0 THEN '' WHEN k % 2 = 0 THEN 'hr' || k || '@example.org' END AS contact_email,
        FALSE AS has_salary_mark,
        CASE WHEN k % 2 = 0 AND k % 14 <> 0 THEN low || '-' || (low + 50) END AS amount,
        CASE WHEN k % 2 = 0 AND k % 14 <> 0 THEN category || chr(10) || 'line ' || k ELSE '' END AS requirements,
        CASE WHEN k % 2 = 0 AND k % 14 <> 0
             THEN job_type || chr(10) || 'ხელფასი: ' || low || '-' || (low + 50) || ' ლარი' ELSE '' END AS responsibilities,
        md5(CASE WHEN k % 2 = 1 THEN category || job_type WHEN k % 14 = 0 THEN ''
            ELSE concat_ws(chr(10), title, 'მოთხოვნები:', category, 'line ' || k, 'მოვალეობები:', job_type,
                           'ხელფასი: ' || low || '-' || (low + 50) || ' ლარი') END) AS description FROM p""",
    ),
    "ingest_listings": (
        lambda spark, sf: _first_run(spark, sf).table.select(
            "platform", "id", "title", "company_name", F.col("salary_min").cast("double").alias("salary_min"),
            "scraped_date", "created_at", "updated_at"),
        f"""WITH l AS ({_LISTINGS_SQL})
        SELECT platform, id, arg_min(title, page_id) AS title, arg_min(company, page_id) AS company_name,
        arg_min_null(salary_min, page_id) AS salary_min, TIMESTAMP '{AS_OF}' AS scraped_date,
        TIMESTAMP '{AS_OF}' AS created_at, TIMESTAMP '{AS_OF}' AS updated_at
        FROM l WHERE page_id % 19 <> 0 AND contains(lower(title), 'build') GROUP BY platform, id""",
    ),
    "ingest_rejects": (
        lambda spark, sf: _first_run(spark, sf).rejects.groupBy("platform", "problem").agg(F.count("*").alias("n")),
        """WITH o AS (SELECT o_orderkey % 3 AS s, o_orderkey % 19 = 0 AS failed,
            (['jobs_ge', 'cv_ge', 'ss_ge'])[CAST(o_orderkey % 3 + 1 AS INTEGER)] AS platform FROM orders)
        SELECT platform, 'HTTP 500' AS problem, count(*) AS n FROM o WHERE failed GROUP BY 1
        UNION ALL SELECT platform, CASE WHEN s = 0 THEN 'no id' ELSE 'no title' END, count(*) FROM o WHERE NOT failed GROUP BY 1, 2
        UNION ALL SELECT platform, 'fewer than 6 cells', count(*) FROM o WHERE NOT failed AND s = 0 GROUP BY 1""",
    ),
    "ingest_run_log": (
        lambda spark, sf: ingest.run_log(_first_run(spark, sf), "2001-09-01 05:00:00", AS_OF)[0],
        f"""WITH o AS (SELECT o_orderkey % 3 AS s, o_orderkey % 19 = 0 AS failed, c_mktsegment = 'BUILDING' AS chosen,
            (['jobs_ge', 'cv_ge', 'ss_ge'])[CAST(o_orderkey % 3 + 1 AS INTEGER)] AS platform
          FROM orders JOIN customer ON o_custkey = c_custkey),
        c AS (SELECT platform, count(*) FILTER (chosen AND NOT failed) AS good,
              count(*) FILTER (failed) + count(*) FILTER (NOT failed) * CASE WHEN platform = 'jobs_ge' THEN 2 ELSE 1 END AS bad
            FROM o GROUP BY platform)
        SELECT sha256(platform || '|2001-09-01 05:00:00|{AS_OF}') AS id, platform, good + bad AS total_jobs_found, good AS successful_scrapes, bad AS failed_scrapes,
        TIMESTAMP '2001-09-01 05:00:00' AS start_time, TIMESTAMP '{AS_OF}' AS end_time, TIMESTAMP '{AS_OF}' AS created_at
        FROM c""",
    ),
    "ingest_run_errors": (
        lambda spark, sf: ingest.run_log(_first_run(spark, sf), "2001-09-01 05:00:00", AS_OF)[1].groupBy(
            "error_message").agg(F.count("*").alias("n")),
        """SELECT 'HTTP 500' AS error_message, count(*) AS n FROM orders WHERE o_orderkey % 19 = 0
        UNION ALL SELECT 'no id', count(*) FROM orders WHERE o_orderkey % 19 <> 0 AND o_orderkey % 3 = 0
        UNION ALL SELECT 'fewer than 6 cells', count(*) FROM orders WHERE o_orderkey % 19 <> 0 AND o_orderkey % 3 = 0
        UNION ALL SELECT 'no title', count(*) FROM orders WHERE o_orderkey % 19 <> 0 AND o_orderkey % 3 > 0""",
    ),
    "ingest_details": (
        lambda spark, sf: _stored_details(spark, sf).table.select(
            "platform", "id", "title", "company_name", F.col("salary_min").cast("double").alias("salary_min"),
            F.col("salary_max").cast("double").alias("salary_max"), "has_salary_info", "url"),
        f"""{_DETAILS_SQL} SELECT CASE WHEN k % 2 = 0 THEN 'cv_ge' ELSE 'jobs_ge' END AS platform, CAST(k AS VARCHAR) AS id,
        title, company AS company_name, CASE WHEN k % 2 = 0 THEN CAST(low AS DOUBLE) END AS salary_min,
        CASE WHEN k % 2 = 0 THEN CAST(low + 50 AS DOUBLE) END AS salary_max, k % 2 = 0 AS has_salary_info, '/p/' || k AS url
        FROM p WHERE k % 14 <> 0""",
    ),
    "ingest_children": (
        lambda spark, sf: _child_values(_stored_details(spark, sf).children),
        f"""{_DETAILS_SQL}, g AS (SELECT * FROM p WHERE k % 2 = 0 AND k % 14 <> 0)
        SELECT 'job_requirements' AS table_name, 'cv_ge' AS platform, CAST(k AS VARCHAR) AS job_id, category AS value FROM g
        UNION ALL SELECT 'job_requirements', 'cv_ge', CAST(k AS VARCHAR), 'line ' || k FROM g
        UNION ALL SELECT 'job_responsibilities', 'cv_ge', CAST(k AS VARCHAR), job_type FROM g
        UNION ALL SELECT 'job_responsibilities', 'cv_ge', CAST(k AS VARCHAR),
            'ხელფასი: ' || low || '-' || (low + 50) || ' ლარი' FROM g
        UNION ALL SELECT 'job_contacts', 'cv_ge', CAST(k AS VARCHAR), 'hr' || k || '@example.org' FROM g""",
    ),
    "detail_rejects": (
        lambda spark, sf: _stored_details(spark, sf).rejects.withColumnRenamed("problem", "error"),
        """SELECT 'cv_ge' AS platform, CAST(o_orderkey AS VARCHAR) AS id, '/p/' || o_orderkey AS url, 'no content' AS error
        FROM orders WHERE o_orderkey % 14 = 0""",
    ),
    "ingest_details_repeats": (
        lambda spark, sf: _details_repeats(spark, sf).table.select("platform", "id", "title", "created_at", "updated_at"),
        f"""{_DETAILS_SQL}, q AS (SELECT *, k % 2 = 1 OR k % 7 <> 0 AS readable FROM p)
        SELECT CASE WHEN k % 2 = 0 THEN 'cv_ge' ELSE 'jobs_ge' END AS platform, CAST(k AS VARCHAR) AS id, title,
          CASE WHEN k % 3 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '{AS_OF}' END AS created_at,
          CASE WHEN k % 5 = 1 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '{AS_OF}' END AS updated_at
        FROM q WHERE readable AND (k % 5 <> 1 OR k % 3 = 0)""",
    ),
    "details_repeats_rejects": (
        lambda spark, sf: _details_repeats(spark, sf).rejects.select("platform", "id", "problem"),
        f"""{_DETAILS_SQL}, q AS (SELECT k, CASE WHEN k % 2 = 0 THEN 'cv_ge' ELSE 'jobs_ge' END AS platform, CAST(k AS VARCHAR) AS id,
          k % 2 = 1 OR k % 7 <> 0 AS readable FROM p)
        SELECT platform, id, CASE WHEN k % 5 = 1 THEN 'HTTP 503' ELSE 'no content' END AS problem FROM q WHERE k % 5 = 1 OR NOT readable
        UNION ALL SELECT platform, id, CASE WHEN k % 5 = 2 OR NOT readable THEN 'no content' ELSE 'another page of this posting was taken' END
        FROM q WHERE k % 5 <> 1""",
    ),
    "crawl_feed_rejects": (
        lambda spark, sf: ingest.crawl_feed(
            listing_pages(spark, sf).withColumn("status", F.when(F.col("page_id") % 19 == 0, 500).otherwise(200)), AS_OF).rejects,
        """SELECT o_orderkey AS page_id, CASE o_orderkey % 3 WHEN 0 THEN 'jobs_ge' WHEN 1 THEN 'cv_ge' ELSE 'ss_ge' END AS platform,
          CAST(NULL AS INTEGER) AS row_no, 'HTTP 500' AS problem FROM orders WHERE o_orderkey % 19 = 0
        UNION ALL SELECT o_orderkey, 'jobs_ge', 1, 'no id' FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 19 <> 0
        UNION ALL SELECT o_orderkey, 'jobs_ge', 2, 'fewer than 6 cells' FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 19 <> 0
        UNION ALL SELECT o_orderkey, 'cv_ge', 1, 'no title' FROM orders WHERE o_orderkey % 3 = 1 AND o_orderkey % 19 <> 0
        UNION ALL SELECT o_orderkey, 'ss_ge', 1, 'no title' FROM orders WHERE o_orderkey % 3 = 2 AND o_orderkey % 19 <> 0""",
    ),
    "crawl_feed": (
        lambda spark, sf: ingest.crawl_feed(listing_pages(spark, sf).withColumn("status", F.lit(200)), AS_OF).table.select(
            "id", "platform", "title", "url", "company_name", "location_city", "published_date", "scraped_date", "is_vip"),
        f"""WITH l AS ({_LISTINGS_SQL}) SELECT id, platform, title, url, company AS company_name, city AS location_city,
        published AS published_date, TIMESTAMP '{AS_OF}' AS scraped_date, is_vip FROM l""",
    ),
    "page_texts": (
        # the given pages through the same extraction job, with a layout of their own
        lambda spark, sf: _page_texts(spark, sf),
        # in texts a reference counts even without its semicolon
        r"""SELECT page_id, nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1', 1), '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'),
            '&amp;?', '&', 'g')), '') AS title,
        CAST(len(regexp_extract_all(html, '(?i)<a\b[^>]*\bhref\s*=')) AS INTEGER) AS links FROM pages""",
    ),
}


def _page_texts(spark, sf):
    from vacancylake.functions.markup import Step
    from vacancylake.operators.layouts import Field, Layout

    layout = Layout(root=(), fields={
        "title": Field(((Step("h1"),),)), "links": Field(((Step("a"),),), "href", True),
    })
    pages = table(spark, sf, "pages").withColumn("platform", F.lit("given"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return extract.raw_detail_rows(pages, {"given": layout}, tasks).select(
        "page_id", F.nullif("title", F.lit("")).alias("title"), F.size("links").alias("links"))
