"""Pages to raw field rows, and raw rows to listings and details.

The Python tasks only read text out of markup. Ids, addresses, dates,
salaries, flags and sections are column expressions afterwards.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake import fixed_values as fixed
from vacancylake import schemas
from vacancylake.functions import dates, flags, links, salary
from vacancylake.functions.markup import Page, Step
from vacancylake.functions.sections import section_items, split_sections
from vacancylake.functions.text import matched, preview
from vacancylake.operators.layouts import DETAIL_LAYOUTS, LISTING_LAYOUTS, Layout
from vacancylake.session import ship_package

_LISTING_TEXTS = [
    "title", "href", "place", "logo", "company", "company_href", "published", "deadline", "period", "marker",
    "price", "experience", "description",
]
_LISTING_LISTS = ["icons", "spans"]
_DETAIL_TEXTS = ["title", "body", "company", "salary_box"]
_DETAIL_LISTS = ["links"]


_ROWS_PER_BATCH = 5000
_BYTES_PER_BATCH = 16 << 20  # of page text behind the rows held
NO_LAYOUT = "layout not found"
_MONEY = re.compile(fixed.CURRENCY_MARKS)


def _raw_schema(texts: list[str], lists: list[str], keep: list[str]) -> pa.Schema:
    return pa.schema(
        [("page_id", pa.int64()), ("platform", pa.string()), ("row_no", pa.int32())]
        + [(k, pa.string()) for k in keep]
        + [(t, pa.string()) for t in texts]
        + [(t, pa.list_(pa.string())) for t in lists]
        + [("mentions_money", pa.bool_()), ("problem", pa.string())]
    )


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {names.get(f.type, 'array<string>')}" for f in schema)


def _take(page: Page, element, take: str) -> str | None:
    if take == "text":
        return page.text(element)
    if take == "joined":
        return page.joined(element, "")
    if take == "lines":
        return page.joined(element, "\n")
    if take == "present":
        return "yes"
    return element.attrs.get(take, "")


_UNKNOWN = object()


class _Ways:
    """The elements at the ends of ways below ``row``; ways that begin alike are walked once."""

    __slots__ = ("page", "row", "steps", "found")

    def __init__(self, page: Page, row, steps: list[tuple[int, Step]]):
        self.page, self.row, self.steps, self.found = page, row, steps, [_UNKNOWN] * len(steps)

    def end(self, node: int):
        if node < 0:
            return self.row
        element = self.found[node]
        if element is _UNKNOWN:
            before, step = self.steps[node]
            inside = self.row if before < 0 else self.end(before)
            element = self.found[node] = None if inside is None else self.page.nth(step, inside)
        return element


def _read(page: Page, below: _Ways, ways: list[tuple[int, Step | None]], take: str):
    for node, every in ways:
        element = below.end(node)
        if element is not None:
            return _take(page, element, take) if every is None else [_take(page, e, take) for e in page.select(every, element)]
    return None


def _records(html: str, layout: Layout) -> Iterator[dict]:
    page = Page(html)
    root = page.follow(layout.root)
    if root is None:  # not an empty list, but a page of another shape
        yield {"row_no": 0, "problem": NO_LAYOUT}
        return
    steps, needs, fields = layout.plan
    rows = [root] if layout.rows is None else page.select(layout.rows, root)[layout.skip:]
    for row_no, row in enumerate(rows):
        below = _Ways(page, row, steps)
        missing = next((why for node, why in needs if below.end(node) is None), None)
        record = {"row_no": row_no, "problem": missing}
        if missing is None:
            for name, ways, take in fields:
                record[name] = _read(page, below, ways, take)
            if layout.some and not any((record[name] or "").strip() for name in layout.some):
                record["problem"] = "no content"
            if layout.rows is None:
                record["mentions_money"] = any(map(_MONEY.search, page.every_text()))
        yield record


# how a source is read: a layout, or a function from the page's text to field rows
Reader = Layout | Callable[[str], Iterable[dict]]


def records_of(reader: Reader, html: str) -> Iterable[dict]:
    """Field rows of one page."""
    return reader(html) if callable(reader) else _records(html, reader)


def _extractor(layouts: dict[str, Reader], schema: pa.Schema, keep: list[str]) -> Callable:
    def rows_of(head: dict, html: str | None) -> Iterator[dict]:
        layout = layouts.get(head["platform"])
        if layout is None:
            yield head | {"problem": "no layout for this source"}
            return
        try:
            yield from [{"row_no": i, **head, **record} for i, record in enumerate(records_of(layout, html or ""))]
        except Exception as error:  # noqa: BLE001 - one bad page must not end the job
            yield head | {"problem": f"{type(error).__name__}: {error}"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = ["page_id", "platform", *keep]
        out, size = [], 0
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in [*heads, "html"]]
            for *values, html in zip(*columns):
                out.extend(rows_of(dict(zip(heads, values)), html))
                size += len(html or "")
                if len(out) >= _ROWS_PER_BATCH or size >= _BYTES_PER_BATCH:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def raw_listing_rows(
    pages: DataFrame, layouts: dict[str, Reader] = LISTING_LAYOUTS, tasks: int | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per listing entry found on each page; ``problem`` says why a row is unusable.

    One pass for all sources: the layout is chosen by each page's ``platform``.
    Pages stay where they are read unless ``tasks`` is given, which helps when
    they come in a few unsplittable files. ``keep`` names text columns that travel
    along.
    """
    return _raw_rows(pages, layouts, _LISTING_TEXTS, _LISTING_LISTS, tasks, keep or [])


def raw_detail_rows(
    pages: DataFrame, layouts: dict[str, Reader] = DETAIL_LAYOUTS, tasks: int | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per detail page."""
    return _raw_rows(pages, layouts, _DETAIL_TEXTS, _DETAIL_LISTS, tasks, keep or [])


def _raw_rows(
    pages: DataFrame, layouts: dict[str, Reader], texts: list[str], lists: list[str], tasks: int | None, keep: list[str]
) -> DataFrame:
    ship_package(pages.sparkSession)
    schema = _raw_schema(texts, lists, keep)
    pages = pages.select("page_id", "platform", *[F.col(k).cast("string") for k in keep], "html")
    if tasks is not None:
        pages = pages.repartition(tasks, "page_id")
    return pages.mapInArrow(_extractor(layouts, schema, keep), _ddl(schema))


def _nested(fields: str, **values: Column) -> Column:
    """A struct of the declared fields; those not given are NULL."""
    kinds = {f.name: f.dataType for f in schemas.struct(fields)}
    return F.struct(*[values.get(n, F.lit(None)).cast(k).alias(n) for n, k in kinds.items()])


def _by_source(**choices: Column) -> Column:
    out = None
    for name, value in choices.items():
        test = F.col("platform") == name
        out = F.when(test, value) if out is None else out.when(test, value)
    return out


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def listings_from_rows(
    rows: DataFrame, as_of: str | dt.datetime, roll_year: bool = False, keep: list[str] | None = None
) -> DataFrame:
    """Nested listings plus ``page_id, row_no, experience, problem``; a row without an id has a problem."""
    now = dates.moment(as_of)
    href = _text("href")
    url = _by_source(
        jobs_ge=href,  # this source's addresses are kept as printed
        cv_ge=links.absolute(href, fixed.BASE_ADDRESS["cv_ge"]),
        ss_ge=links.absolute(href, fixed.BASE_ADDRESS["ss_ge"]),
    )
    found_id = _by_source(**{p: links.posting_id(href, patterns) for p, patterns in links.ID_PATTERNS.items()})
    job_id = F.when(F.col("platform") == "ss_ge", F.coalesce(found_id, links.title_id(_text("title")))).otherwise(found_id)

    def has_month(text: Column) -> Column:
        return text.rlike("|".join(fixed.GEORGIAN_MONTHS))

    period = F.when(F.col("platform") == "ss_ge", F.get(F.filter("spans", has_month), F.lit(0))).otherwise(
        F.col("period"))
    start, end = dates.split_range(period, normalise_dashes=True)

    months = _by_source(**{p: dates.month_map(names) for p, names in dates.MONTH_NAMES.items()})

    def day(text: Column) -> Column:
        return dates.day_month(text, now, months, roll_year)

    published = F.when(F.col("platform") == "jobs_ge", F.col("published")).otherwise(start)
    deadline = F.when(F.col("platform") == "jobs_ge", F.col("deadline")).otherwise(end)
    price = salary.salary_from_label(F.col("price"))
    is_ss = F.col("platform") == "ss_ge"
    icons = flags.icon_flags(F.col("icons"))
    no = F.lit(False)

    prepared = rows.withColumns({
        "_id": job_id, "_url": url, "_published": day(published), "_deadline": day(deadline), "_price": price,
    })
    place = F.when(is_ss, F.lit(fixed.DEFAULT_CITY)).otherwise(_text("place"))
    price = F.col("_price")
    return prepared.select(
        *(keep or []), "page_id", "row_no", "experience",
        F.coalesce("problem", F.when(F.col("_id").isNull(), F.lit("no id"))).alias("problem"),
        F.col("_id").alias("id"), "platform", _text("title").alias("title"),
        _nested(schemas.LOCATION, city=place, is_remote=~is_ss & flags.is_remote_place(F.col("place"))).alias("location"),
        _nested(
            schemas.COMPANY,
            name=F.when(is_ss, F.lit(fixed.UNKNOWN_COMPANY)).otherwise(_text("company")),
            logo_url=_text("logo"),
            jobs_url=_by_source(
                jobs_ge=_text("company_href"),
                cv_ge=links.absolute(_text("company_href"), fixed.BASE_ADDRESS["cv_ge"]),
                ss_ge=F.lit(""),
            ),
        ).alias("company"),
        _nested(
            schemas.FLAGS,
            **{name: flag for name, flag in icons.items() if name not in ("has_salary_info", "is_in_region")},
            has_salary_info=F.when(is_ss, price.isNotNull()).otherwise(icons["has_salary_info"]),
            is_in_region=is_ss | icons["is_in_region"],
            is_remote=no, is_featured=no,
            is_urgent=is_ss & F.coalesce(flags.has_marker(F.col("marker"), fixed.URGENT_WORD), no),
            is_vip=F.when(F.col("platform") == "cv_ge", flags.has_marker(F.col("marker"), fixed.VIP_WORD)).otherwise(no),
        ).alias("metadata"),
        _nested(
            schemas.DATES, published=F.col("_published"), deadline=F.col("_deadline"), scraped=now
        ).alias("dates"),
        F.when(price.isNotNull(), _nested(
            schemas.SALARY, min_amount=price["min_amount"], max_amount=price["max_amount"],
            currency=price["currency"], period=price["period"], is_negotiable=no,
        )).alias("salary"),
        F.lit(None).cast("string").alias("job_type"),
        F.lit(None).cast("string").alias("category"),
        F.col("_url").alias("url"),
        F.when(is_ss, preview(_text("description"))).alias("short_description"),
    )


def extract_listings(
    pages: DataFrame, as_of: str | dt.datetime, layouts: dict[str, Reader] = LISTING_LAYOUTS, roll_year: bool = False,
    keep: list[str] | None = None,
) -> DataFrame:
    """Pages to listings; split the result with ``accepted`` and ``rejects``."""
    return listings_from_rows(raw_listing_rows(pages, layouts, keep=keep), as_of, roll_year, keep)


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("problem").isNull()).drop("problem")


def rejects(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("problem").isNotNull()).select("page_id", "platform", "row_no", "problem")


def extract_details(
    pages: DataFrame, mode: str = "last", layouts: dict[str, Reader] = DETAIL_LAYOUTS, keep: list[str] | None = None
) -> DataFrame:
    """Detail pages to fields and sections, with ``page_id``, ``problem`` and the ``keep`` columns.

    Salary, e-mail and sections are looked for in the sources that print them in
    the running text.
    """
    rows = raw_detail_rows(pages, layouts, keep=keep)
    body = F.coalesce(F.col("body"), F.lit(""))
    mail = F.get(F.filter("links", lambda href: F.startswith(href, F.lit("mailto:"))), F.lit(0))
    prose = F.col("platform") == "cv_ge"
    rows = rows.withColumns({
        "description": body,
        "contact_email": F.when(prose, F.coalesce(matched(mail, "^mailto:(.*)$"), F.lit(""))),
        "salary_text": F.when(prose, salary.salary_from_prose(body)),
        "has_salary_mark": ~prose & (F.col("salary_box").isNotNull() | F.col("mentions_money")),
        "_sections": F.when(prose, body).otherwise(F.lit("")),
    })
    parts = split_sections(rows, "_sections", mode)
    return parts.select(
        "page_id", "platform", *(keep or []), "problem", F.coalesce("title", F.lit("")).alias("title"), "description",
        F.coalesce("company", F.lit("")).alias("company_name"), "contact_email", "salary_text", "has_salary_mark",
        *fixed.SECTION_KEYWORDS,
    )


def details_from_fields(fields: DataFrame, as_of: str | dt.datetime) -> DataFrame:
    """Nested details. ``fields`` carries ``id``, ``platform``, ``title`` and ``url`` of the listing.

    Sections become lists of lines, a salary text its two bounds, a mark without
    an amount an empty salary, and the e-mail address a contact.
    """
    low, high = salary.amount_bounds(F.col("salary_text.amount"))
    found = F.col("salary_text").isNotNull()
    no = F.lit(False)
    text_list = "array<string>"
    mail = F.coalesce(F.col("contact_email"), F.lit(""))
    return fields.select(
        "id", "platform", "title", "description",
        section_items(F.col("requirements")).alias("requirements"),
        section_items(F.col("responsibilities")).alias("responsibilities"),
        section_items(F.col("benefits")).alias("benefits"),
        F.array().cast(text_list).alias("skills"),
        F.lit(None).cast("string").alias("experience_level"),
        F.lit(None).cast("string").alias("education_level"),
        _nested(schemas.LOCATION, is_remote=no).alias("location"),
        _nested(schemas.COMPANY, name=F.col("company_name")).alias("company"),
        _nested(schemas.FLAGS, **{f.name: no for f in schemas.struct(schemas.FLAGS) if f.name != "has_salary_info"},
                has_salary_info=found).alias("metadata"),
        _nested(schemas.DATES, scraped=dates.moment(as_of)).alias("dates"),
        F.when(found | F.col("has_salary_mark"), _nested(
            schemas.SALARY, min_amount=low, max_amount=high, currency=F.col("salary_text.currency"), is_negotiable=no,
        )).alias("salary"),
        "url",
        F.lit(None).cast("string").alias("application_url"),
        F.when(mail != "", F.create_map(F.lit("email"), mail)).otherwise(
            F.create_map().cast("map<string,string>")).alias("contact_info"),
        F.lit(None).cast("string").alias("description_file_path"),
    )
