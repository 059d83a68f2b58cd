"""Golden pages for each layout, and the reader of markup."""

import datetime as dt

from pyspark.sql import functions as F

from vacancylake import schemas
from vacancylake.functions.markup import Page, Step
from vacancylake.operators import extract
from vacancylake.operators.layouts import LISTING_LAYOUTS
from vacancylake.plans import ingest

NOW = "2025-09-01 06:00:00"

TABLE = """<table id="job_list_table"><tr><th>h</th></tr>
<tr><td></td><td><a href="/ge/?view=jobs&id=123">Driver</a><i>Remote</i><img src="/i/new.gif"></td>
<td><a href="/c/1"><img src="/l.png"></a></td><td><a href="/c/1">ACME</a></td><td>25 ივნისი</td><td>20 ივლისი</td></tr>
<tr><td>short row</td></tr></table>"""
CARD = """<div class="item-listing"><div class="list-item"><p class="list-item-title">
<a class="announcement-list-item" href="/announcement/417196/x">Cashier</a></p>
<span class="list-item-tag item-badge">თბილისი</span><a class="list-item-company" href="/company/9">ACME</a>
<span class="list-item-time">25 ივნ - 20 ივლ</span><p class="list-item-location">ვიპ</p></div></div>"""
GENERATED = """<a href="/ka/l/vacancies/88"><div class="sc-28f268a4-2 udaGZ"><h2 class="sc-64e43013-0 jkUKFK title">Seller</h2>
<span class="sc-64e43013-0 hdwvnh price">2,800 - 3,000 ₾ თვეში</span><div class="sc-28f268a4-1 d">Text</div>
<span class="sc-64e43013-0 jMGSUP">3 წლამდე</span><span class="sc-64e43013-0 jMGSUP">25 ივნისი - 29 ივლისი</span>
<div class="sc-28f268a4-5 j">სასწრაფოდ</div></div></a>"""


def pages(spark, *entries):
    return spark.createDataFrame(
        [(i, platform, f"u{i}", i, None, status, html) for i, (platform, status, html) in enumerate(entries)],
        schemas.RAW_PAGE_DDL)


def test_listings_of_each_layout(spark):
    rows = extract.extract_listings(
        pages(spark, ("jobs_ge", 200, TABLE), ("cv_ge", 200, CARD), ("ss_ge", 200, GENERATED)), NOW)
    found = {r.platform: r for r in extract.accepted(rows).collect()}

    a = found["jobs_ge"]
    assert (a.id, a.title, a.location.city, a.location.is_remote, a.company.name) == ("123", "Driver", "Remote", True, "ACME")
    assert (a.url, a.company.logo_url, a.company.jobs_url) == ("/ge/?view=jobs&id=123", "/l.png", "/c/1")
    assert a.metadata.is_new and not a.metadata.is_expiring and a.metadata.is_vip is False
    assert (a.dates.published, a.dates.deadline) == (dt.datetime(2025, 6, 25), dt.datetime(2025, 7, 20))

    b = found["cv_ge"]
    assert (b.id, b.location.city, b.location.is_remote) == ("417196", "თბილისი", False)
    assert b.url == "https://www.cv.ge/announcement/417196/x" and b.company.jobs_url == "https://www.cv.ge/company/9"
    assert b.metadata.is_vip is True and b.salary is None
    assert (b.dates.published, b.dates.deadline) == (dt.datetime(2025, 6, 25), dt.datetime(2025, 7, 20))

    c = found["ss_ge"]
    assert (c.id, c.url, c.company.name, c.location.city) == (
        "88", "https://jobs.ss.ge/ka/l/vacancies/88", "Unknown Company", "თბილისი")
    assert (c.salary.min_amount, c.salary.max_amount, c.salary.currency, c.salary.period) == (2800, 3000, "GEL", "monthly")
    assert c.metadata.has_salary_info and c.metadata.is_urgent and c.metadata.is_in_region
    assert (c.dates.published, c.dates.deadline, c.experience) == (
        dt.datetime(2025, 6, 25), dt.datetime(2025, 7, 29), "3 წლამდე")

    assert [(r.platform, r.problem) for r in extract.rejects(rows).collect()] == [("jobs_ge", "fewer than 6 cells")]


def test_missing_parts(spark):
    bare = CARD.replace('<p class="list-item-location">ვიპ</p>', "").replace(
        '<span class="list-item-tag item-badge">თბილისი</span>', "")
    no_link = GENERATED.replace('<a href="/ka/l/vacancies/88">', "").replace("</a>", "")
    rows = extract.accepted(extract.extract_listings(pages(spark, ("cv_ge", 200, bare), ("ss_ge", 200, no_link)), NOW))
    found = {r.platform: r for r in rows.collect()}
    assert found["cv_ge"].metadata.is_vip is None and found["cv_ge"].location.city == ""
    assert found["ss_ge"].url == "" and found["ss_ge"].id.isdigit()


def test_a_page_no_layout_knows_and_an_empty_one(spark):
    rows = extract.extract_listings(pages(spark, ("elsewhere", 200, TABLE), ("jobs_ge", 200, "<p>"), ("cv_ge", 200, None)), NOW)
    assert [r.problem for r in rows.collect()] == ["no layout for this source", "layout not found", "layout not found"]


def test_details(spark):
    content = """<h1>T</h1><div class="entry-content"><p>მოთხოვნები:</p><p>ა</p>x<br>ხელფასი: 1,200 ლარი</div>
    <a href="mailto:a@b.c">m</a><aside class="widget_ci-company-info-widget"><p class="card-info-title"> Co </p></aside>"""
    plain = """<h1> T </h1><div class="company-info"><a>Q</a></div><div id="job_description"> a <b> b </b></div>
    <script>"$"</script>"""
    entries = pages(spark, ("cv_ge", 200, content), ("jobs_ge", 200, plain), ("cv_ge", 200, "<p>"))
    fields = {r.page_id: r for r in extract.extract_details(entries).collect()}
    assert fields[0].requirements == "ა\nx\nხელფასი: 1,200 ლარი" and fields[0].contact_email == "a@b.c"
    assert fields[0].company_name == "Co" and fields[0].salary_text.amount == "1200"
    assert (fields[1].title, fields[1].description, fields[1].company_name, fields[1].has_salary_mark) == ("T", "ab", "Q", True)
    assert fields[2].problem == "no content"

    listings = spark.createDataFrame(
        [("cv_ge", "1", "Cook", "u"), ("jobs_ge", "2", "Nurse", "v"), ("cv_ge", "3", "Clerk", "w"), ("cv_ge", "4", "X", "y")],
        "platform string, id string, title string, url string")
    located = entries.withColumn("id", (F.col("page_id") + 1).cast("string"))
    result = ingest.ingest_details(listings, located, ingest.empty_table(spark, "job_details"), NOW)
    stored = {r.id: r for r in result.table.collect()}
    assert set(stored) == {"1", "2"} and stored["1"].title == "Cook" and stored["1"].platform == "cv_ge"
    assert float(stored["1"].salary_min) == 1200 and stored["2"].salary_min is None
    assert {(r.job_id, r.requirement) for r in result.children["job_requirements"].collect()} == {
        ("1", "ა"), ("1", "x"), ("1", "ხელფასი: 1,200 ლარი")}
    assert [(r.contact_type, r.contact_value) for r in result.children["job_contacts"].collect()] == [("email", "a@b.c")]
    assert {(r.id, r.problem) for r in result.rejects.collect()} == {("3", "no content"), ("4", "no detail page")}


def test_ingest_keeps_the_first_write_and_counts_every_page(spark):
    again = TABLE.replace("Driver", "Driver again")
    current = ingest.empty_table(spark, "job_listings")
    first = ingest.ingest_listings(pages(spark, ("jobs_ge", 200, TABLE), ("jobs_ge", 200, again), ("cv_ge", 404, CARD)), current, NOW)
    rows = first.table.collect()
    assert [(r.id, r.title, r.created_at, r.updated_at) for r in rows] == [
        ("123", "Driver", dt.datetime(2025, 9, 1, 6), dt.datetime(2025, 9, 1, 6))]
    assert sorted(r.problem for r in first.rejects.collect()) == ["HTTP 404", "fewer than 6 cells", "fewer than 6 cells"]
    runs, errors = ingest.run_log(first, "2025-09-01 05:00:00", NOW)
    assert {(r.platform, r.total_jobs_found, r.successful_scrapes, r.failed_scrapes) for r in runs.collect()} == {
        ("jobs_ge", 4, 2, 2), ("cv_ge", 1, 0, 1)}
    ids = {r.platform: r.id for r in runs.collect()}
    assert sorted((r.scraping_result_id == ids["cv_ge"], r.error_message) for r in errors.collect()) == [
        (False, "fewer than 6 cells"), (False, "fewer than 6 cells"), (True, "HTTP 404")]
    later = ingest.ingest_listings(pages(spark, ("jobs_ge", 200, again)), first.table, "2025-09-02 06:00:00").table.first()
    assert (later.title, later.created_at, later.updated_at, later.scraped_date) == (
        "Driver", dt.datetime(2025, 9, 1, 6), dt.datetime(2025, 9, 2, 6), dt.datetime(2025, 9, 2, 6))


def test_ingest_filters_and_quota(spark):
    entries = [("jobs_ge", 200, TABLE.replace("id=123", f"id={i}").replace("Driver", f"Driver {i}")) for i in range(10)]
    current = ingest.empty_table(spark, "job_listings")
    some = ingest.ingest_listings(pages(spark, *entries), current, NOW, quota=3).table
    assert {r.id for r in some.collect()} == {"0", "1", "2"}
    named = ingest.ingest_listings(pages(spark, *entries), current, NOW, query="DRIVER 7", location="remo").table
    assert [r.id for r in named.collect()] == ["7"]
    too_long = pages(spark, ("jobs_ge", 200, TABLE.replace("Driver", "D" * 501)))
    rejected = ingest.ingest_listings(too_long, current, NOW)
    assert rejected.table.count() == 0 and "length:title<=500" in {r.problem for r in rejected.rejects.collect()}


def test_a_function_reads_a_source_of_its_own(spark):
    def reader(html):
        for line in html.split():
            yield {"title": line, "href": f"/announcement/{len(line)}"}

    rows = extract.extract_listings(pages(spark, ("cv_ge", 200, "cook nurse")), NOW, layouts={"cv_ge": reader})
    assert [(r.row_no, r.id, r.title) for r in rows.orderBy("row_no").collect()] == [(0, "4", "cook"), (1, "5", "nurse")]


def test_quota_follows_page_numbers(spark):
    entries = spark.createDataFrame(
        [(9 - i, "jobs_ge", f"u{i}", i, None, 200, TABLE.replace("id=123", f"id={i}")) for i in range(9)],
        schemas.RAW_PAGE_DDL)
    kept = ingest.ingest_listings(entries, ingest.empty_table(spark, "job_listings"), NOW, quota=2).table
    assert {r.id for r in kept.collect()} == {"0", "1"}


def test_crawl_feed(spark):
    feed = ingest.crawl_feed(pages(spark, ("cv_ge", 200, CARD)), NOW)
    item = feed.table.first()
    assert (item.company_url, item.location_city, item.is_vip) == ("https://www.cv.ge/company/9", "თბილისი", True)
    assert feed.rejects.count() == 0


def test_record_shapes_match_the_declared_ones(spark):
    rows = extract.accepted(extract.extract_listings(pages(spark, ("cv_ge", 200, CARD)), NOW))
    declared = schemas.struct(schemas.LISTING_DDL)
    got = rows.drop("page_id", "row_no", "experience").schema
    assert [(f.name, f.dataType.simpleString()) for f in got] == [(f.name, f.dataType.simpleString()) for f in declared]


def test_reader_of_markup():
    page = Page("<DIV Class='a  b' id=x>t&amp;u<p>one<br>two<p>three</div><a href=\"?a=1&id=2&amp;c=3&copy=1\">z</a> 1 < 2 "
                "<script>var x='<p>$';if(a<b)</script><b title=don't>q</b><i/>w<img src=x /><!-- c -->")
    box = page.follow((Step("div", id="x"),))
    assert page.text(box) == "t&uonetwothree" and page.joined(box, "|") == "t&u|one|two|three"
    assert page.follow((Step("*", cls="a b"),)) is box and page.follow((Step("div", cls="b"),)) is box
    assert page.follow((Step("div", cls="ab"),)) is None
    assert page.follow((Step("a"),)).attrs["href"] == "?a=1&id=2&c=3&copy=1"
    assert page.text(page.follow((Step("p", at=1),), box)) == "three"
    assert page.follow((Step("p", at=2),), box) is None
    assert page.follow((Step("p"), Step("div", around=True))) is box
    assert page.text(page.root).endswith("z 1 < 2 qw") and page.hidden == ["var x='<p>$';if(a<b)", " c "]


def test_ways_that_begin_alike_are_walked_once(monkeypatch):
    html = ("<table id=job_list_table><tr></tr><tr><td></td><td><a href='/?id=1'>t</a><i>p</i></td><td><a><img src=l></a></td>"
            "<td><a href=/c>c</a></td><td>a</td><td>b</td></tr></table>")
    walked, nth = [], Page.nth
    monkeypatch.setattr(Page, "nth", lambda page, step, inside: walked.append((step, inside.start)) or nth(page, step, inside))
    record, = extract.records_of(LISTING_LAYOUTS["jobs_ge"], html)
    assert (record["title"], record["href"], record["place"], record["icons"], record["logo"], record["company"]) == ("t", "/?id=1", "p", [], "l", "c")
    assert (record["published"], record["deadline"]) == ("a", "b")
    assert len(walked) == len(set(walked)) == 11


def test_odd_attributes_end_tags_where_they_did():
    page = Page("<a x=\"p>q\" y='>' z=1>one</a><b v=\"open>two</b><i = ' k>' t/>three<u a=='='>four")
    assert [(e.tag, page.text(e)) for e in page.select(Step("*"))] == [("a", "one"), ("b", "two"), ("i", ""), ("u", "four")]
    assert page.follow((Step("a"),)).attrs == {"x": "p>q", "y": ">", "z": "1"}
