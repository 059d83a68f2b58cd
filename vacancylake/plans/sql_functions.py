"""The overview's computed columns, links and plugged-in readers as functions that SQL text can call.

Scalar functions are SQL themselves, so the optimizer sees through them; reading markup is a table function in Python, one
call a page, joined laterally: ``SELECT page_id, l.href FROM pages, LATERAL page_links(html) AS l``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf

from vacancylake import fixed_values as fixed
from vacancylake.functions.markup import Page, Step
from vacancylake.operators.extract import Reader, records_of
from vacancylake.session import ship_package


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


_SCALAR = {
    "salary_range(low DECIMAL(10,2), high DECIMAL(10,2), currency STRING) RETURNS STRING": f"""
        CASE WHEN low IS NOT NULL AND high IS NOT NULL
             THEN concat(CAST(low AS STRING), '-', CAST(high AS STRING), ' ', coalesce(currency, ''))
             WHEN low IS NOT NULL THEN concat('From ', CAST(low AS STRING), ' ', coalesce(currency, ''))
             ELSE {_text(fixed.NOT_SPECIFIED)} END""",
    "location_display(is_remote BOOLEAN, city STRING, region STRING) RETURNS STRING": f"""
        CASE WHEN is_remote THEN {_text(fixed.REMOTE_LABEL)}
             WHEN city IS NOT NULL AND region IS NOT NULL THEN concat(city, ', ', region)
             WHEN city IS NOT NULL THEN city
             ELSE {_text(fixed.NO_LOCATION)} END""",
    "whole_days_since(stamp TIMESTAMP_NTZ, as_of TIMESTAMP_NTZ) RETURNS BIGINT": "CAST(extract(DAY FROM as_of - stamp) AS BIGINT)",
}


def register_scalar_functions(spark: SparkSession) -> list[str]:
    """``salary_range``, ``location_display``, ``whole_days_since``; returns the names."""
    for head, body in _SCALAR.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in _SCALAR]


def register_overview_function(spark: SparkSession, listings: DataFrame, as_of: str | dt.datetime, table: str = "listings") -> None:
    """A view of the raw listings and ``overview_of(platform)``, a table function over it; a NULL platform means all."""
    register_scalar_functions(spark)
    listings.createOrReplaceTempView(table)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION overview_of(wanted STRING)
        RETURNS TABLE (platform STRING, id STRING, title STRING, salary_range STRING, location_display STRING,
                       days_since_scraped BIGINT, days_since_published BIGINT)
        RETURN SELECT platform, id, title, salary_range(salary_min, salary_max, salary_currency),
               location_display(is_remote, city, region), whole_days_since(scraped_date, TIMESTAMP_NTZ {_text(str(as_of))}),
               whole_days_since(published_date, TIMESTAMP_NTZ {_text(str(as_of))})
               FROM {table} WHERE wanted IS NULL OR platform = wanted""")


class _PageLinks:
    """Every link of a page, in page order; an empty or NULL page has none."""

    def eval(self, html: str) -> Iterator[tuple]:
        if html:
            page, pos = Page(html), 0
            for anchor in page.select(Step("a")):
                if "href" in anchor.attrs:
                    yield pos, anchor.attrs["href"], " ".join(page.joined(anchor, " ").split())
                    pos += 1


def _reader_function(reader: Reader, fields: list[str], kinds: str):
    class Rows:
        def eval(self, html: str) -> Iterator[tuple]:
            try:
                for row_no, record in enumerate(records_of(reader, html or "")):
                    yield record.get("row_no", row_no), *(record.get(f) for f in fields), record.get("problem")
            except Exception as error:  # noqa: BLE001 - one bad page must not end the statement
                yield 0, *(None for _ in fields), f"{type(error).__name__}: {error}"

    return udtf(Rows, returnType=f"row_no int, {kinds}, problem string", useArrow=True)


def register_link_function(spark: SparkSession, name: str = "page_links") -> None:
    """``name(html)`` gives pos, href and label of every link."""
    ship_package(spark)
    spark.udtf.register(name, udtf(_PageLinks, returnType="pos int, href string, label string", useArrow=True))


def register_reader(spark: SparkSession, name: str, reader: Reader, fields: dict[str, str]) -> None:
    """``name(html)`` gives the rows that ``reader`` (a layout, or a function from page to field rows) finds: row_no, the fields
    with the given types, and the problem that makes a row unusable. A reader that fails gives one row that says why."""
    ship_package(spark)
    kinds = ", ".join(f"`{f}` {kind}" for f, kind in fields.items())
    spark.udtf.register(name, _reader_function(reader, list(fields), kinds))
