"""Declared schemas of the stored tables and of the records in flight."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

_TS = "timestamp_ntz"

LOCATION = "city string, region string, country string, is_remote boolean"
COMPANY = (
    "name string, website string, logo_url string, description string, "
    "industry string, size string, location string, jobs_url string"
)
FLAGS = (
    "is_expiring boolean, was_recently_updated boolean, has_salary_info boolean, is_new boolean, "
    "is_in_region boolean, is_remote boolean, is_featured boolean, is_urgent boolean, is_vip boolean"
)
DATES = f"published {_TS}, deadline {_TS}, updated {_TS}, scraped {_TS}"
SALARY = "min_amount double, max_amount double, currency string, period string, is_negotiable boolean"


def _nested(ddl: str) -> str:
    return "struct<" + ", ".join(f"{n}: {t}" for n, t in (f.strip().split(" ", 1) for f in ddl.split(","))) + ">"


_GROUPS = (
    f"location {_nested(LOCATION)}, company {_nested(COMPANY)}, metadata {_nested(FLAGS)}, "
    f"dates {_nested(DATES)}, salary {_nested(SALARY)}"
)

LISTING_DDL = (
    f"id string, platform string, title string, {_GROUPS}, "
    "job_type string, category string, url string, short_description string"
)
DETAIL_DDL = (
    "id string, platform string, title string, description string, requirements array<string>, "
    "responsibilities array<string>, benefits array<string>, skills array<string>, "
    f"experience_level string, education_level string, {_GROUPS}, url string, application_url string, "
    "contact_info map<string, string>, description_file_path string"
)
RAW_PAGE_DDL = (
    f"page_id bigint, platform string, url string, page_no int, fetched_at {_TS}, status int, html string"
)

# name, type, not null, longest text (None = unlimited)
_FLAG_COLUMNS = [
    (name, "boolean", False, None)
    for name in (
        "is_expiring", "was_recently_updated", "has_salary_info", "is_new",
        "is_in_region", "is_featured", "is_urgent", "is_vip",
    )
]
_SALARY_COLUMNS = [
    ("salary_min", "decimal(10,2)", False, None),
    ("salary_max", "decimal(10,2)", False, None),
    ("salary_currency", "string", False, 10),
    ("salary_period", "string", False, 20),
    ("salary_negotiable", "boolean", False, None),
]
_DATE_COLUMNS = [(f"{n}_date", _TS, False, None) for n in ("published", "deadline", "updated", "scraped")]
_PLACE_COLUMNS = [
    ("city", "string", False, 500),
    ("region", "string", False, 200),
    ("country", "string", False, 100),
    ("is_remote", "boolean", False, None),
]
_STAMPS = [("created_at", _TS, False, None), ("updated_at", _TS, False, None)]


def _child(value: str, width: int | None = None) -> list[tuple]:
    return [
        ("platform", "string", True, 50),
        ("job_id", "string", True, 255),
        (value, "string", True, width),
        ("created_at", _TS, False, None),
    ]


TABLES: dict[str, list[tuple]] = {
    "companies": [
        ("id", "string", True, None),
        ("name", "string", False, 255),
        ("website", "string", False, 500),
        ("logo_url", "string", False, 500),
        ("description", "string", False, None),
        ("industry", "string", False, 100),
        ("size", "string", False, 50),
        ("location", "string", False, 255),
        ("jobs_url", "string", False, 500),
        *_STAMPS,
    ],
    "job_listings": [
        ("id", "string", True, 255),
        ("platform", "string", True, 50),
        ("title", "string", True, 500),
        ("job_type", "string", False, 50),
        ("category", "string", False, 100),
        ("url", "string", False, 1000),
        ("short_description", "string", False, None),
        *_PLACE_COLUMNS,
        ("company_name", "string", False, 255),
        ("company_website", "string", False, 500),
        ("company_logo_url", "string", False, 500),
        *_SALARY_COLUMNS,
        *_DATE_COLUMNS,
        *_FLAG_COLUMNS,
        *_STAMPS,
    ],
    "job_details": [
        ("id", "string", True, 255),
        ("platform", "string", True, 50),
        ("title", "string", True, 500),
        ("description", "string", False, None),
        ("experience_level", "string", False, 50),
        ("education_level", "string", False, 50),
        ("url", "string", False, 1000),
        ("application_url", "string", False, 1000),
        ("description_file_path", "string", False, 500),
        *_PLACE_COLUMNS,
        ("company_name", "string", False, 255),
        ("company_website", "string", False, 500),
        ("company_logo_url", "string", False, 500),
        ("company_description", "string", False, None),
        ("company_industry", "string", False, 100),
        ("company_size", "string", False, 50),
        ("company_location", "string", False, 255),
        *_SALARY_COLUMNS,
        *_DATE_COLUMNS,
        *_FLAG_COLUMNS,
        *_STAMPS,
    ],
    "job_requirements": _child("requirement"),
    "job_responsibilities": _child("responsibility"),
    "job_benefits": _child("benefit"),
    "job_skills": _child("skill", 100),
    "job_contacts": [
        ("platform", "string", True, 50),
        ("job_id", "string", True, 255),
        ("contact_type", "string", True, 50),
        ("contact_value", "string", True, 255),
        ("created_at", _TS, False, None),
    ],
    "scraping_results": [
        ("id", "string", True, None),
        ("platform", "string", True, 50),
        ("total_jobs_found", "bigint", False, None),
        ("successful_scrapes", "bigint", False, None),
        ("failed_scrapes", "bigint", False, None),
        ("start_time", _TS, True, None),
        ("end_time", _TS, False, None),
        ("created_at", _TS, False, None),
    ],
    "scraping_errors": [
        ("scraping_result_id", "string", False, None),
        ("error_message", "string", True, None),
        ("created_at", _TS, False, None),
    ],
}


def columns(table: str) -> list[str]:
    return [name for name, *_ in TABLES[table]]


def ddl(table: str) -> str:
    return ", ".join(f"{name} {kind}" for name, kind, *_ in TABLES[table])


def struct(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


def not_null_columns(table: str) -> list[str]:
    return [name for name, _, required, _ in TABLES[table] if required]


def length_limits(table: str) -> dict[str, int]:
    return {name: width for name, _, _, width in TABLES[table] if width}


def create_tables(spark: SparkSession, database: str = "default", location: str | None = None) -> list[str]:
    """Create every stored table that is not there yet. Safe to repeat."""
    for name in TABLES:
        where = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({ddl(name)}) USING parquet{where}")
    return list(TABLES)


def drop_tables(spark: SparkSession, database: str = "default", *, confirm: bool = False) -> None:
    """Drop every stored table; refuses unless ``confirm`` is given."""
    if not confirm:
        raise ValueError("pass confirm=True to drop the tables")
    for name in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
