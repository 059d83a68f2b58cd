"""Nested records to flat rows and back to text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake import schemas
from vacancylake.functions import dates, flags
from vacancylake.functions.salary import money
from vacancylake.functions.text import cut

_FLAGS = [
    "is_expiring", "was_recently_updated", "has_salary_info", "is_new",
    "is_in_region", "is_featured", "is_urgent", "is_vip",
]


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def _common(as_of: str | dt.datetime) -> dict[str, Column]:
    """Columns a listing and a detail flatten alike.

    A flag is false only when its whole group is missing; a group that is there
    keeps an unknown (NULL) flag unknown.
    """
    def flag(group: str, name: str) -> Column:
        return F.when(F.col(group).isNull(), F.lit(False)).otherwise(F.col(f"{group}.{name}"))

    out = {
        "city": F.col("location.city"),
        "region": F.col("location.region"),
        "country": F.col("location.country"),
        "is_remote": flag("location", "is_remote"),
        "company_name": F.col("company.name"),
        "company_website": F.col("company.website"),
        "company_logo_url": F.col("company.logo_url"),
        "salary_min": money(F.col("salary.min_amount")),
        "salary_max": money(F.col("salary.max_amount")),
        "salary_currency": F.col("salary.currency"),
        "salary_period": F.col("salary.period"),
        "salary_negotiable": flag("salary", "is_negotiable"),
        "published_date": F.col("dates.published"),
        "deadline_date": F.col("dates.deadline"),
        "updated_date": F.col("dates.updated"),
        "scraped_date": dates.moment(as_of),
    }
    return out | {name: flag("metadata", name) for name in _FLAGS}


def flatten_listing(listings: DataFrame, as_of: str | dt.datetime, keep: list[str] | None = None) -> DataFrame:
    """Nested listing -> the 31 stored columns (and ``keep``); the seen time is the moment of saving."""
    common = {name: c.alias(name) for name, c in _common(as_of).items()}
    special = {name: _text(name) for name in ("id", "platform", "title")}
    wanted = [c for c in schemas.columns("job_listings") if c not in ("created_at", "updated_at")]
    return listings.select(*[special.get(c, common.get(c, F.col(c))) for c in wanted], *(keep or []))


def flatten_detail(details: DataFrame, as_of: str | dt.datetime) -> DataFrame:
    """Nested detail -> the 37 stored columns."""
    common = {name: c.alias(name) for name, c in _common(as_of).items()}
    special = {name: _text(name) for name in ("id", "platform", "title", "description")}
    special |= {f"company_{n}": F.col(f"company.{n}").alias(f"company_{n}")
                for n in ("description", "industry", "size", "location")}
    wanted = [c for c in schemas.columns("job_details") if c not in ("created_at", "updated_at")]
    return details.select(*[special.get(c, common.get(c, F.col(c))) for c in wanted])


def crawler_items(listings: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Nested listing -> flat feed item."""
    def flag(name: str) -> Column:
        return F.when(F.col("metadata").isNull(), F.lit(False)).otherwise(F.col(f"metadata.{name}")).alias(name)

    def part(group: str, name: str, alias: str) -> Column:
        return F.when(F.col(group).isNull(), F.lit("")).otherwise(F.col(f"{group}.{name}")).alias(alias)

    return listings.select(
        *(keep or []), "id", "platform", "title", "url",
        part("company", "name", "company_name"),
        part("company", "jobs_url", "company_url"),
        part("company", "logo_url", "company_logo_url"),
        part("location", "city", "location_city"),
        part("location", "country", "location_country"),
        F.when(F.col("location").isNull(), F.lit(False)).otherwise(F.col("location.is_remote")).alias(
            "location_is_remote"
        ),
        *[flag(n) for n in ("is_expiring", "was_recently_updated", "has_salary_info", "is_new", "is_in_region",
                            "is_vip")],
        F.col("dates.published").alias("published_date"),
        F.col("dates.deadline").alias("deadline_date"),
        F.col("dates.scraped").alias("scraped_date"),
    )


def as_json(records: DataFrame, name: str = "record") -> DataFrame:
    """Each record as one JSON text; missing values stay as nulls, dates are ISO."""
    options = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}
    return records.select(F.to_json(F.struct(*records.columns), options).alias(name))


def show_columns(overview: DataFrame) -> DataFrame:
    """The seven display columns, cut to their widths."""
    return overview.select(
        "platform",
        cut(F.col("title"), 25).alias("title"),
        cut(F.coalesce("company_name", F.lit("N/A")), 20).alias("company"),
        cut(F.col("location_display"), 15).alias("location"),
        cut(F.col("salary_range"), 15).alias("salary"),
        F.coalesce("days_since_scraped", F.lit(0)).cast("string").alias("days_ago"),
        flags.yes_no(F.col("is_remote")).alias("remote"),
    )


def display_cut(df: DataFrame, width: int = 20) -> DataFrame:
    """Any result as text, each value cut to ``width`` characters."""
    return df.select(*[cut(F.col(c).cast("string"), width).alias(c) for c in df.columns])


def stamp_lineage(df: DataFrame, source: str, layout: str, as_of: str | dt.datetime) -> DataFrame:
    """Where and when a record came in."""
    return df.withColumns({
        "_platform_type": F.lit(source),
        "_scraper_info": F.lit(layout),
        "_scraped_at": dates.moment(as_of),
    })
