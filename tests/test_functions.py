"""Golden values of the scalar functions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vacancylake import fixed_values as fixed
from vacancylake.functions import dates, flags, links, salary, text
from vacancylake.functions.sections import split_sections
from vacancylake.operators import pages as page_ops

NOW = "2025-09-01 06:00:00"


def one(spark, build, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(build(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("platform,url,anchored,expected", [
    ("cv_ge", "/announcement/417196/some-title", True, "417196"),
    ("cv_ge", "/announcement/417203/another-job", True, "417203"),
    ("cv_ge", "invalid-url", True, None),
    ("jobs_ge", "/ge/?view=jobs&id=123", True, "123"),
    ("jobs_ge", "/x?cid=6&id=123", False, "6"),
    ("jobs_ge", "/x?cid=6&id=123", True, "123"),
    ("ss_ge", "/ka/l/vacancies/88", True, "88"),
    ("ss_ge", "/x?id=9", True, "9"),
    ("ss_ge", None, True, None),
])
def test_posting_id(spark, platform, url, anchored, expected):
    assert one(spark, lambda c: links.posting_id(c, links.ID_PATTERNS[platform], anchored), url) == expected


def test_title_id_is_stable(spark):
    first = one(spark, links.title_id, "Seller")
    assert first == one(spark, links.title_id, "Seller") and 0 <= int(first) < 1_000_000


def test_addresses(spark):
    def of(platform):
        return one(spark, lambda c: links.detail_url(F.lit(platform), c), "417196")

    assert of("cv_ge") == "https://www.cv.ge/announcement/417196"
    assert one(spark, lambda c: links.listing_url(F.lit("cv_ge"), c), 1, "int").endswith("/announcements/all")
    assert one(spark, lambda c: links.listing_url(F.lit("cv_ge"), c), 2, "int").endswith("/announcements/all?page=2")
    assert one(spark, lambda c: links.listing_url(F.lit("ss_ge"), c), 1, "int").endswith("/ka/l/vacancies")
    full = one(spark, lambda c: links.listing_url(
        F.lit("jobs_ge"), c, F.lit("6"), F.lit("17"), has_salary=F.lit(True), locale=F.lit("ge")), 3, "int")
    assert full == "https://jobs.ge/ge?page=3&cid=6&lid=17&has_salary=1"
    assert one(spark, links.query_encode, "a b&c*~é") == "a+b%26c%2A~%C3%A9"


@pytest.mark.parametrize("written,start,end", [
    ("25 ივნისი - 29 ივლისი", (6, 25), (7, 29)),
    ("25 ივნ - 20 ივლ", (6, 25), (7, 20)),
    ("25 ივნ", (6, 25), None),
    ("25 ივნ-20 ივლ", None, None),
    ("", None, None),
    (None, None, None),
])
def test_date_ranges(spark, written, start, end):
    def year(pair):
        return dt.datetime(2025, *pair) if pair else None

    assert one(spark, lambda c: dates.day_month(dates.split_range(c)[0], NOW), written) == year(start)
    assert one(spark, lambda c: dates.day_month(dates.split_range(c)[1], NOW), written) == year(end)


def test_joined_range_is_read_when_dashes_are_normalised(spark):
    end = one(spark, lambda c: dates.day_month(dates.split_range(c, normalise_dashes=True)[1], NOW), "25 ივნ-20 ივლ")
    assert end == dt.datetime(2025, 7, 20)


@pytest.mark.parametrize("written,expected", [
    ("25 June", dt.datetime(2025, 6, 25)), ("25 Jun", None), ("June", None), ("30 თებერვალი", None),
    ("29 February", None), ("x June", None), ("0 June", None), ("25 June 2019 extra", dt.datetime(2025, 6, 25)),
])
def test_day_month(spark, written, expected):
    assert one(spark, lambda c: dates.day_month(c, NOW), written) == expected


def test_month_names_of_one_source_only(spark):
    names = dates.month_map(dates.MONTH_NAMES["ss_ge"])
    assert one(spark, lambda c: dates.day_month(c, NOW, names), "25 ივნ") is None
    assert one(spark, lambda c: dates.day_month(c, NOW, names), "25 June") is None


def test_rolled_year(spark):
    january = "2025-01-05 00:00:00"
    assert one(spark, lambda c: dates.day_month(c, january), "20 December") == dt.datetime(2025, 12, 20)
    assert one(spark, lambda c: dates.day_month(c, january, roll_year=True), "20 December") == dt.datetime(2024, 12, 20)
    december = "2024-12-28 00:00:00"
    assert one(spark, lambda c: dates.day_month(c, december, roll_year=True), "10 January") == dt.datetime(2025, 1, 10)


@pytest.mark.parametrize("written,low,high", [
    ("2,800 - 3,000 ₾ თვეში", 2800, 3000), ("1,500 ₾", 1500, 1500), ("1,500–2,000 ₾", 1500, 1500),
    ("შეთანხმებით", None, None), (",", None, None), ("", None, None), (", - 5", None, None),
    ("99999999999 ₾", None, None),
])
def test_salary_label(spark, written, low, high):
    found = one(spark, salary.salary_from_label, written)
    if low is None:
        assert found is None
    else:
        assert (found.min_amount, found.max_amount, found.currency, found.period) == (low, high, "GEL", "monthly")


@pytest.mark.parametrize("written,amount,digits_only", [
    ("ხელფასი: 1000-1500 ლარი", "1000-1500", "1000-1500"), ("1200 ლარი", "1200", "1200"),
    ("ხელფასი 900", "900", "900"), ("ხელფასი: 1,200 ლარი", "1200", "200"), ("none", None, None),
])
def test_salary_prose(spark, written, amount, digits_only):
    for grouped, expected in ((True, amount), (False, digits_only)):
        found = one(spark, lambda c: salary.salary_from_prose(c, grouped), written)
        assert (found and found.amount) == expected
    if amount == "1000-1500":
        assert found.raw_text == written


@pytest.mark.parametrize("low,high,currency,shown", [
    ("2800", "3000", "GEL", "2800.00-3000.00 GEL"), ("2800", None, None, "From 2800.00 "),
    (None, "3000", "GEL", "Not specified"),
])
def test_salary_range(spark, low, high, currency, shown):
    df = spark.createDataFrame([(low, high, currency)], "l string, h string, c string").select(
        salary.salary_range(salary.money(F.col("l")), salary.money(F.col("h")), F.col("c")).alias("r"))
    assert df.first().r == shown


def test_money_rounds_half_up_and_rejects_what_does_not_fit(spark):
    assert one(spark, salary.money, "10.005") == Decimal("10.01")
    assert one(spark, salary.money, "123456789.00") is None
    assert one(spark, salary.money, "x") is None


@pytest.mark.parametrize("remote,city,region,shown", [
    (True, "Tbilisi", None, "Remote"), (False, "Tbilisi", "Region", "Tbilisi, Region"), (None, "Tbilisi", None, "Tbilisi"),
    (False, None, "Region", "Location not specified"), (False, "", None, ""),
])
def test_location(spark, remote, city, region, shown):
    df = spark.createDataFrame([(remote, city, region)], "r boolean, c string, g string")
    assert df.select(flags.location_display(F.col("r"), F.col("c"), F.col("g")).alias("v")).first().v == shown


@pytest.mark.parametrize("hours,days", [(47, 1), (-47, -1), (-7, 0), (None, None)])
def test_whole_days(spark, hours, days):
    stamp = dt.datetime(2025, 9, 1, 6) - dt.timedelta(hours=hours) if hours is not None else None
    assert one(spark, lambda c: dates.whole_days_since(c, NOW), stamp, "timestamp_ntz") == days


@pytest.mark.parametrize("written,expected", [
    ("2024-01-15T10:30:00Z", dt.datetime(2024, 1, 15, 10, 30)), ("2024-01-15", dt.datetime(2024, 1, 15)),
    ("2024-01-15T10:30:00+04:00", dt.datetime(2024, 1, 15, 6, 30)),
    ("2024-01-15 10:30:00.250000", dt.datetime(2024, 1, 15, 10, 30, 0, 250000)),
    ("2024-01-15T10:30:00-04:30", dt.datetime(2024, 1, 15, 15)), ("x", None), ("", None), ("2024-13-01", None),
])
def test_iso_stamp(spark, written, expected):
    assert one(spark, dates.iso_stamp, written) == expected


def test_icons_and_places(spark):
    def icons(sources):
        df = spark.createDataFrame([(sources,)], "s array<string>")
        return df.select(*[c.alias(n) for n, c in flags.icon_flags(F.col("s")).items()]).first().asDict()

    assert {k for k, v in icons(["/i/exp.gif", "/i/new.png"]).items() if v} == {"is_expiring", "is_new"}
    assert {k for k, v in icons(["/i/express.png"]).items() if v} == {"is_expiring"}
    assert not any(icons(None).values())
    assert one(spark, flags.is_remote_place, "Remote, Tbilisi") is True
    assert one(spark, flags.is_remote_place, "თბილისი") is False
    assert one(spark, lambda c: flags.has_marker(c, fixed.VIP_WORD), None) is None


def test_texts(spark):
    assert one(spark, text.preview, "a" * 201) == "a" * 200 + "..."
    assert one(spark, text.preview, "a" * 200) == "a" * 200
    assert one(spark, text.strip, " \t a b \n ") == "a b"
    assert one(spark, text.first_email, "write to a.b@c-d.org, now") == "a.b@c-d.org"
    assert one(spark, text.mailto_address, "<a href='mailto:x@y.z'>m</a>") == "x@y.z"
    page = "<style>p{}</style><h1> A &amp;lt; </h1><!-- c --><p>b<br>c</p><script>d</script>"
    assert one(spark, text.plain_text, page) == "A &lt;\nb\nc"
    assert one(spark, text.decoded, "&#4304;&#x10D0;&eacute;&amp;amp;&nbsp;& &none; &#0;&#x110000;") == "ააé&amp; & &none; &#0;&#x110000;"
    assert one(spark, text.decoded, "") == "" and one(spark, text.decoded, None) is None


def test_pages_as_written(spark):
    html = ("<HTML class=x lang='ka'><title>R&amp;D <b>x</b></title><h1 id=a><span>A</span>B</h1>"
            "<a href='/a'>one <i>1</i></a><a class=c href=/b>t&#119;o</a><a href=\"/c\">open <a data-href='/no'>none</a>")
    df = spark.createDataFrame([(1, "https://e.org/7", html), (2, None, None), (3, "", "")], "page_id int, url string, html string")
    links = page_ops.page_links(df).orderBy("page_id", "pos").collect()
    assert [(r.href, r.label) for r in links] == [("/a", "one 1"), ("/b", "two"), ("/c", "open")]
    row = page_ops.page_fields(df).orderBy("page_id").first()
    assert (row.lang, row.title, row.heading) == ("ka", "R&D x", "AB")
    assert page_ops.page_fields(df).count() == 3


REQ, DUT = "მოთხოვნები:", "მოვალეობები:"


@pytest.mark.parametrize("lines,earliest,last", [
    (["შესავალი", REQ, "ა", DUT, "ბ"], {"requirements": "ა\nბ"}, {"requirements": "ა", "responsibilities": "ბ"}),
    ([DUT, "ა", REQ, "ბ"], {"responsibilities": "ა", "requirements": "ბ"}, {"responsibilities": "ა", "requirements": "ბ"}),
    (["ძირითადი მოთხოვნები:", "ა"], {"requirements": "ძირითადი მოთხოვნები:\nა"},
     {"requirements": "ძირითადი მოთხოვნები:\nა"}),
    (["დამატებითი პირობები:", "ა"], {"conditions": "ა"}, {"benefits": "ა"}),
    (["text", "", "  "], {}, {}),
    ([], {}, {}),
])
def test_sections(spark, lines, earliest, last):
    df = spark.createDataFrame([("\n".join(lines),)], "t string")
    for mode, expected in (("earliest", earliest), ("last", last)):
        got = split_sections(df, "t", mode).drop("t").first().asDict()
        assert got == {name: expected.get(name, "") for name in fixed.SECTION_KEYWORDS}
