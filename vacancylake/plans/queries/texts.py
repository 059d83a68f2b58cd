"""Queries over texts, addresses and dates.

Local-language inputs are written by Spark from the given tables (a date column
becomes "25 ივნისი", a price becomes "2,800 - 3,000 ₾ თვეში"), so their number
grows with the tables; the SQL states the expected value from the original column.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vacancylake import fixed_values as fixed
from vacancylake.functions import dates, flags, links, salary, text
from vacancylake.functions.sections import split_sections
from vacancylake.operators import pages as page_ops
from vacancylake.plans.queries import Registered
from vacancylake.sources.driver_tables import AS_OF, table

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"


def _sql_list(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def written_dates(spark, sf):
    """Order dates as day and month name, in four spellings; one order in five is unreadable."""
    month = F.month("o_orderdate")
    day = F.dayofmonth("o_orderdate").cast("string")
    spelled = [F.element_at(F.lit(names), month) for names in dates.ALL_MONTH_NAMES]
    style = F.col("o_orderkey") % 5
    written = (
        F.when(style == 0, F.concat(day, F.lit(" "), spelled[0]))
        .when(style == 1, F.concat(F.lit("  "), day, F.lit(" "), spelled[1], F.lit(" ")))
        .when(style == 2, F.concat(day, F.lit(" "), spelled[2]))
        .when(style == 3, F.concat(day, F.lit(" "), spelled[1], F.lit(" 2001")))
        .otherwise(spelled[1])
    )
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate", written.alias("written"))


def _written_ranges(spark, sf):
    end = F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 40).cast("int"))
    dash = F.when(F.col("o_orderkey") % 3 == 0, " - ").when(F.col("o_orderkey") % 3 == 1, "–").otherwise("")

    def spell(stamp):
        return F.concat(F.dayofmonth(stamp), F.lit(" "), F.element_at(F.lit(fixed.GEORGIAN_SHORT_MONTHS), F.month(stamp)))

    tail = F.when(dash == "", "").otherwise(F.concat(dash, spell(end)))
    rows = table(spark, sf, "orders").select("o_orderkey", F.concat(spell(F.col("o_orderdate")), tail).alias("written"))
    start_text, end_text = dates.split_range(F.col("written"), normalise_dashes=True)
    return rows.select(
        "o_orderkey", dates.day_month(start_text, AS_OF).alias("start_date"),
        dates.day_month(end_text, AS_OF).alias("end_date"),
    )


def _salary_labels(spark, sf):
    low = F.floor("o_totalprice")
    written = (
        F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.format_number(low, 0), F.lit(" - "),
                                                      F.format_number(low + 500, 0), F.lit(" ₾ თვეში")))
        .when(F.col("o_orderkey") % 4 == 1, F.concat(F.format_number(low, 0), F.lit(" ₾")))
        .when(F.col("o_orderkey") % 4 == 2, F.lit("შეთანხმებით"))
        .otherwise(F.lit(" , "))
    )
    found = salary.salary_from_label(written)
    return table(spark, sf, "orders").select("o_orderkey", found.alias("s")).select(
        "o_orderkey", F.col("s.min_amount").cast("double").alias("min_amount"),
        F.col("s.max_amount").cast("double").alias("max_amount"), "s.currency", "s.period",
    )


def _salary_prose(grouped):
    def run(spark, sf):
        number = F.floor("o_totalprice").cast("string")
        plus = (F.floor("o_totalprice") + 100).cast("string")
        commas = F.format_number(F.floor("o_totalprice"), 0)
        style = F.col("o_orderkey") % 5
        prose = F.concat(
            F.col("o_orderpriority"), F.lit(". "),
            F.when(style == 0, F.concat(F.lit("ხელფასი: "), number, F.lit("-"), plus, F.lit(" ლარი")))
            .when(style == 1, F.concat(number, F.lit(" ლარი")))
            .when(style == 2, F.concat(F.lit("ხელფასი "), number))
            .when(style == 3, F.concat(F.lit("ხელფასი: "), commas, F.lit(" ლარი")))
            .otherwise(F.lit("-")),
            F.lit(" ."),
        )
        rows = table(spark, sf, "orders").select(
            "o_orderkey", salary.salary_from_prose(prose, grouped_digits=grouped).alias("s"))
        low, high = salary.amount_bounds(F.col("s.amount"))
        return rows.select("o_orderkey", "s.amount", "s.currency", low.cast("double").alias("low"),
                           high.cast("double").alias("high"))

    return run


def with_headers(spark, sf):
    """Documents with section headers put before some of their lines."""
    headers = ["მოვალეობები:", "ბენეფიტები:", "სამუშაო პირობები:", "ძირითადი მოთხოვნები:", "მოთხოვნები:",
               "დამატებითი პირობები:"]

    def headed(line, i):
        pick = F.length(line) % 11 + i % 2
        head = F.lit("")
        for k, header in enumerate(headers):
            head = F.when(pick == 2 * k, F.lit(header + "\n")).otherwise(head)
        return F.concat(head, line)

    lines = F.split("text", "\n")
    return table(spark, sf, "documents").select("doc_id", F.array_join(F.transform(lines, headed), "\n").alias("text"))


def _sections(mode):
    def run(spark, sf):
        parts = split_sections(with_headers(spark, sf), "text", mode)
        names = list(fixed.SECTION_KEYWORDS)
        return parts.select("doc_id", *[F.md5(n).alias(n) for n in names], *[F.length(n).alias(f"{n}_size") for n in names])

    return run


def _sections_sql(state, longest_first):
    ranked = [(w, k) for k, words in enumerate(fixed.SECTION_KEYWORDS.values()) for w in words]
    if longest_first:
        ranked.sort(key=lambda p: -len(p[0]))
    rank = "CASE WHEN NOT ends_with(line, ':') THEN NULL " + " ".join(
        f"WHEN contains(line, '{w}') THEN {k}" for w, k in ranked) + " END"
    exact = ", ".join(f"'{w}:'" for words in fixed.SECTION_KEYWORDS.values() for w in words)
    body = ", ".join(
        f"coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (state = {k} AND line NOT IN ({exact})), '') AS {n}"
        for k, n in enumerate(fixed.SECTION_KEYWORDS)
    )
    names = list(fixed.SECTION_KEYWORDS)
    return f"""WITH src AS (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
    headed AS (SELECT doc_id, i, line, CASE length(line) % 11 + i % 2
        WHEN 0 THEN 'მოვალეობები:' WHEN 2 THEN 'ბენეფიტები:' WHEN 4 THEN 'სამუშაო პირობები:'
        WHEN 6 THEN 'ძირითადი მოთხოვნები:' WHEN 8 THEN 'მოთხოვნები:' WHEN 10 THEN 'დამატებითი პირობები:' END AS head
        FROM src),
    lines AS (SELECT doc_id, 2 * i AS pos, head AS line FROM headed WHERE head IS NOT NULL
              UNION ALL SELECT doc_id, 2 * i + 1, trim(line, {_SPACES}) FROM headed),
    ranked AS (SELECT *, {rank} AS ix FROM lines WHERE line <> ''),
    stated AS (SELECT *, {state} OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS state FROM ranked),
    parts AS (SELECT doc_id, {body} FROM stated GROUP BY doc_id)
    SELECT doc_id, {", ".join(f"md5(coalesce({n}, '')) AS {n}" for n in names)},
           {", ".join(f"length(coalesce({n}, '')) AS {n}_size" for n in names)}
    FROM documents LEFT JOIN parts USING (doc_id)"""


def _stamps(spark, sf):
    style = F.col("event_id") % 6
    second = F.date_trunc("second", F.col("ts"))
    written = (
        F.when(style == 0, F.concat(dates.iso_text(F.col("ts")), F.lit("Z")))
        .when(style == 1, F.concat(dates.iso_text(F.col("ts")), F.lit("+04:00")))
        .when(style == 2, F.concat(dates.iso_text(F.col("ts")), F.lit("-02:30")))
        .when(style == 3, F.date_format("ts", "yyyy-MM-dd"))
        .when(style == 4, F.concat(F.lit("x"), second.cast("string")))
        .otherwise(F.lit(""))
    )
    return table(spark, sf, "events").select("event_id", dates.iso_stamp(written).alias("stamp"))


def _icons(spark, sf):
    parts = {"exp": 2, "upd": 3, "salary": 5, "new": 7, "reg": 11}
    sources = F.array_compact(F.array(*[
        F.when(F.col("event_id") % n == 0, F.concat(F.lit(f"/i/{p}_"), F.lower("event_type"), F.lit(".gif")))
        for p, n in parts.items()
    ]))
    rows = table(spark, sf, "events").select("event_id", sources.alias("icons"))
    return rows.select("event_id", *[c.alias(n) for n, c in flags.icon_flags(F.col("icons")).items()])


def _listing_urls(spark, sf):
    key = F.col("c_custkey")
    platform = F.when(key % 3 == 0, "jobs_ge").when(key % 3 == 1, "cv_ge").otherwise("ss_ge")
    url = links.listing_url(
        platform, (key % 30 + 1).cast("int"), category_id=F.when(key % 2 == 0, F.col("c_nationkey").cast("string")),
        location_id=F.when(key % 4 == 0, F.lit("")), query=F.concat(F.col("c_mktsegment"), F.lit(" & R+D*~"), F.col("c_name")),
        has_salary=key % 5 == 0, locale=F.lit("ge"),
    )
    return table(spark, sf, "customer").select("c_custkey", url.alias("url"))


def _detail_urls(spark, sf):
    key = F.col("o_orderkey")
    given = F.when(key % 3 == 0, F.concat(F.lit("/announcement/"), key, F.lit("/x"))).when(
        key % 3 == 1, F.concat(F.lit("https://example.org/"), key))
    platform = F.when(key % 2 == 0, "cv_ge").otherwise("ss_ge")
    return table(spark, sf, "orders").select(
        "o_orderkey", links.detail_url(platform, key.cast("string"), given).alias("url"))


_HTML_CLEAN = """regexp_replace(regexp_replace(html,
 '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<!--.*?-->|<!doctype[^>]*>', '', 'g'), '(?s)<[^>]*>', chr(10), 'g')"""
for _reference, _char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"),
                          ("&middot;", "·"), ("&amp;", "&")):  # those in the given pages; the last one decodes nothing twice
    _HTML_CLEAN = f"replace({_HTML_CLEAN}, '{_reference}', '{_char}')"
_PLAIN_SQL = f"trim(regexp_replace({_HTML_CLEAN}, '[ \\t\\r\\v\\f]*\\n[\\s\\v]*', chr(10), 'g'), {_SPACES})"


QUERIES: Registered = {
    "posting_id": (
        lambda spark, sf: table(spark, sf, "pages").select(
            "page_id", links.posting_id(F.col("url"), [r"/blog/(\d+)", r"^https?://[^/]+/[^?#]*?(\d+)"]).alias("id")),
        r"""SELECT page_id, coalesce(nullif(regexp_extract(url, '/blog/([0-9]+)', 1), ''),
        nullif(regexp_extract(url, '^https?://[^/]+/[^?#]*?([0-9]+)', 1), '')) AS id FROM pages""",
    ),
    "title_id": (
        lambda spark, sf: table(spark, sf, "documents").select("doc_id", links.title_id(F.col("text")).alias("id")),
        """SELECT doc_id, CAST(CAST('0x' || substr(md5(text), 1, 8) AS BIGINT) % 1000000 AS VARCHAR) AS id
        FROM documents""",
    ),
    "abs_url": (
        lambda spark, sf: page_ops.page_links(table(spark, sf, "pages")).select(
            "page_id", "pos", links.absolute(F.col("href"), F.concat(F.lit("https://"), F.col("host"))).alias("url")),
        """WITH l AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
               unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*?href="([^"]*)"[^>]*>.*?</a\\s*>', 1)) AS href,
               generate_subscripts(regexp_extract_all(html, '(?is)<a\\b[^>]*?href="([^"]*)"[^>]*>.*?</a\\s*>', 1), 1) - 1
               AS pos FROM pages)
        SELECT page_id, CAST(pos AS INTEGER) AS pos,
               CASE WHEN starts_with(href, 'http') OR href = '' THEN href ELSE 'https://' || host || href END AS url
        FROM l""",
    ),
    "listing_urls": (
        _listing_urls,
        """SELECT c_custkey, CASE c_custkey % 3
          WHEN 0 THEN 'https://jobs.ge/ge?page=' || (c_custkey % 30 + 1)
            || CASE WHEN c_custkey % 2 = 0 THEN '&cid=' || c_nationkey ELSE '' END
            || '&q=' || replace(url_encode(c_mktsegment || ' & R+D*~' || c_name), '%20', '+')
            || CASE WHEN c_custkey % 5 = 0 THEN '&has_salary=1' ELSE '' END
          WHEN 1 THEN 'https://www.cv.ge/announcements/all'
            || CASE WHEN c_custkey % 30 > 0 THEN '?page=' || (c_custkey % 30 + 1) ELSE '' END
          ELSE 'https://jobs.ss.ge/ka/l/vacancies'
            || CASE WHEN c_custkey % 30 > 0 THEN '?page=' || (c_custkey % 30 + 1) ELSE '' END END AS url
        FROM customer""",
    ),
    "detail_urls": (
        _detail_urls,
        """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN 'https://example.org/' || o_orderkey
          WHEN o_orderkey % 2 = 0 THEN 'https://www.cv.ge/announcement/' || o_orderkey
               || CASE WHEN o_orderkey % 3 = 0 THEN '/x' ELSE '' END
          WHEN o_orderkey % 3 = 0 THEN 'https://jobs.ss.ge/announcement/' || o_orderkey || '/x'
          ELSE 'https://jobs.ss.ge/ka/l/vacancies/' || o_orderkey END AS url FROM orders""",
    ),
    "local_date": (
        lambda spark, sf: written_dates(spark, sf).select(
            "o_orderkey", dates.day_month(F.col("written"), AS_OF).alias("day")),
        """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 OR (month(o_orderdate) = 2 AND day(o_orderdate) = 29) THEN NULL
        ELSE CAST(o_orderdate - to_years(CAST(year(o_orderdate) - 2001 AS INTEGER)) AS TIMESTAMP) END AS day FROM orders""",
    ),
    "local_date_nearest_year": (
        lambda spark, sf: written_dates(spark, sf).select(
            "o_orderkey", dates.day_month(F.col("written"), "2001-01-10 06:00:00", roll_year=True).alias("day")),
        """WITH d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 OR (month(o_orderdate) = 2 AND day(o_orderdate) = 29)
            THEN NULL ELSE o_orderdate - to_years(CAST(year(o_orderdate) - 2001 AS INTEGER)) END AS day FROM orders)
        SELECT o_orderkey, CAST(CASE WHEN day > TIMESTAMP '2001-01-10 06:00:00' + INTERVAL 183 DAY
            THEN day - INTERVAL 1 YEAR ELSE day END AS TIMESTAMP) AS day FROM d""",
    ),
    "local_date_range": (
        _written_ranges,
        """WITH d AS (SELECT o_orderkey, o_orderdate AS a, o_orderdate + to_days(CAST(o_orderkey % 40 AS INTEGER)) AS b
                      FROM orders)
        SELECT o_orderkey,
          CASE WHEN month(a) = 2 AND day(a) = 29 THEN NULL
               ELSE CAST(a - to_years(CAST(year(a) - 2001 AS INTEGER)) AS TIMESTAMP) END AS start_date,
          CASE WHEN o_orderkey % 3 = 2 OR (month(b) = 2 AND day(b) = 29) THEN NULL
               ELSE CAST(b - to_years(CAST(year(b) - 2001 AS INTEGER)) AS TIMESTAMP) END AS end_date FROM d""",
    ),
    "iso_ts": (
        _stamps,
        """SELECT event_id, CASE event_id % 6
          WHEN 0 THEN date_trunc('second', ts)
          WHEN 1 THEN date_trunc('second', ts) - INTERVAL 4 HOUR
          WHEN 2 THEN date_trunc('second', ts) + INTERVAL 150 MINUTE
          WHEN 3 THEN date_trunc('day', ts) END AS stamp FROM events""",
    ),
    "icon_flags": (
        _icons,
        """SELECT event_id, event_id % 2 = 0 AS is_expiring, event_id % 3 = 0 AS was_recently_updated,
        event_id % 5 = 0 AS has_salary_info, event_id % 7 = 0 AS is_new, event_id % 11 = 0 AS is_in_region FROM events""",
    ),
    "salary_range_parse": (
        _salary_labels,
        """SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN floor(o_totalprice) END AS min_amount,
        CASE o_orderkey % 4 WHEN 0 THEN floor(o_totalprice) + 500 WHEN 1 THEN floor(o_totalprice) END AS max_amount,
        CASE WHEN o_orderkey % 4 < 2 THEN 'GEL' END AS currency,
        CASE WHEN o_orderkey % 4 < 2 THEN 'monthly' END AS period FROM orders""",
    ),
    "salary_from_text": (
        _salary_prose(True),
        """WITH n AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS v, o_orderkey % 5 AS s FROM orders)
        SELECT o_orderkey, CASE WHEN s = 0 THEN v || '-' || (v + 100) WHEN s < 4 THEN CAST(v AS VARCHAR) END AS amount,
        CASE WHEN s < 4 THEN 'GEL' END AS currency, CASE WHEN s < 4 THEN CAST(v AS DOUBLE) END AS low,
        CASE WHEN s = 0 THEN CAST(v + 100 AS DOUBLE) WHEN s < 4 THEN CAST(v AS DOUBLE) END AS high FROM n""",
    ),
    "salary_from_text_digits_only": (
        _salary_prose(False),
        """WITH n AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS v, o_orderkey % 5 AS s FROM orders),
        k AS (SELECT *, CASE s WHEN 0 THEN v || '-' || (v + 100)
              WHEN 3 THEN CASE WHEN v >= 1000 THEN right(CAST(v AS VARCHAR), 3) ELSE CAST(v AS VARCHAR) END
              WHEN 4 THEN NULL ELSE CAST(v AS VARCHAR) END AS amount FROM n)
        SELECT o_orderkey, amount, CASE WHEN s < 4 THEN 'GEL' END AS currency,
        CAST(split_part(amount, '-', 1) AS DOUBLE) AS low,
        CAST(CASE WHEN contains(amount, '-') THEN split_part(amount, '-', 2) ELSE amount END AS DOUBLE) AS high FROM k""",
    ),
    "section_split": (
        _sections("earliest"),
        _sections_sql("min(ix)", False),
    ),
    "section_split_last_header": (
        _sections("last"),
        _sections_sql("last_value(ix IGNORE NULLS)", True),
    ),
    "preview": (
        lambda spark, sf: table(spark, sf, "documents").select(
            "doc_id", text.preview(F.col("text")).alias("preview"), F.length("text").alias("size")),
        """SELECT doc_id, CASE WHEN length(text) > 200 THEN left(text, 200) || '...' ELSE text END AS preview,
        CAST(length(text) AS INTEGER) AS size FROM documents""",
    ),
    "trimmed_lines": (
        lambda spark, sf: table(spark, sf, "documents").select(
            "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")
        ).select("doc_id", "pos", F.md5(text.strip(F.col("line"))).alias("line")),
        f"""SELECT doc_id, CAST(pos AS INTEGER) AS pos, md5(trim(line, {_SPACES})) AS line FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)""",
    ),
    "emails": (
        lambda spark, sf: table(spark, sf, "documents").select(
            "doc_id", text.first_email(F.col("text")).alias("email")).where("email IS NOT NULL"),
        r"""SELECT doc_id, regexp_extract(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') AS email FROM documents
        WHERE regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')""",
    ),
    "mailto_address": (
        lambda spark, sf: table(spark, sf, "customer").select(
            "c_custkey",
            text.mailto_address(F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise(F.concat(
                F.lit('<p>x</p><a class="m" href="mailto:'), F.lower(F.replace("c_name", F.lit("#"), F.lit("."))),
                F.lit('@example.org">write</a>')))).alias("email"),
        ),
        """SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN lower(replace(c_name, '#', '.')) || '@example.org' END
        AS email FROM customer""",
    ),
    "html_text": (
        lambda spark, sf: table(spark, sf, "pages").select(
            "page_id", text.plain_text(F.col("html")).alias("t")
        ).select("page_id", F.md5("t").alias("text"), F.length("t").alias("size")),
        f"""SELECT page_id, md5(t) AS text, CAST(length(t) AS INTEGER) AS size
        FROM (SELECT page_id, {_PLAIN_SQL} AS t FROM pages)""",
    ),
    "currency_mark": (
        lambda spark, sf: table(spark, sf, "documents").select(
            "doc_id", salary.mentions_currency(F.concat("text", F.when(F.col("doc_id") % 9 == 0, " ₾").otherwise("")))
            .alias("has_mark")),
        """SELECT doc_id, doc_id % 9 = 0 OR contains(text, '$') OR contains(text, '₾') OR contains(text, 'ლარი') AS has_mark
        FROM documents""",
    ),
    "page_fields": (
        lambda spark, sf: page_ops.page_fields(table(spark, sf, "pages")),
        r"""SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
        nullif(regexp_extract(url, '^https?://[^/]+/[^?#]*?([0-9]+)', 1), '') AS id,
        nullif(regexp_extract(html, '(?i)<html[^>]*\blang="([^"]*)"', 1), '') AS lang,
        nullif(trim(replace(replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1),
            '&quot;', '"'), '&amp;', '&')), '') AS title,
        nullif(trim(replace(replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1', 1),
            '&quot;', '"'), '&amp;', '&')), '') AS heading,
        CAST(len(regexp_extract_all(html, '(?i)<a\b[^>]*\bhref\s*=')) AS INTEGER) AS link_count FROM pages""",
    ),
    "page_links": (
        lambda spark, sf: page_ops.page_links(table(spark, sf, "pages")).select("page_id", "pos", "href", "label"),
        """WITH m AS (SELECT page_id,
            regexp_extract_all(html, '(?is)<a\\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a\\s*>', 1) AS h,
            regexp_extract_all(html, '(?is)<a\\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a\\s*>', 2) AS t FROM pages)
        SELECT page_id, CAST(generate_subscripts(h, 1) - 1 AS INTEGER) AS pos, unnest(h) AS href, trim(unnest(t)) AS label
        FROM m""",
    ),
}
