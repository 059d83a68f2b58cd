"""Posting ids and addresses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancylake import fixed_values as fixed
from vacancylake.functions.text import matched

# Where each source puts the posting id in an address.
ID_PATTERNS = {
    "jobs_ge": [r"id=(\d+)"],
    "cv_ge": [r"/announcement/(\d+)"],
    "ss_ge": [r"/vacancies/(\d+)", r"id=(\d+)"],
}
DETAIL_PATH = {
    "jobs_ge": "/ge/?view=jobs&id=",
    "cv_ge": "/announcement/",
    "ss_ge": "/ka/l/vacancies/",
}
LISTING_PATH = {"cv_ge": "/announcements/all", "ss_ge": "/ka/l/vacancies"}


def posting_id(url: Column, patterns: Sequence[str], anchored: bool = True) -> Column:
    """First pattern that matches wins; NULL when none does.

    ``anchored`` makes ``id=`` a whole query parameter, so ``cid=6`` is not an id.
    """
    if anchored:
        patterns = [p.replace("id=", "[?&]id=") if p.startswith("id=") else p for p in patterns]
    return F.coalesce(*[matched(url, p) for p in patterns])


def title_id(title: Column) -> Column:
    """A stable stand-in id for a posting whose address carries none."""
    return (F.conv(F.substring(F.md5(title), 1, 8), 16, 10).cast("bigint") % 1_000_000).cast("string")


def absolute(url: Column, base: Column | str) -> Column:
    base = F.lit(base) if isinstance(base, str) else base
    return F.when(F.startswith(url, F.lit("http")) | (url == ""), url).when(url.isNotNull(), F.concat(base, url))


def detail_url(platform: Column, job_id: Column, url: Column | None = None) -> Column:
    """The given address made absolute, else the source's own template."""
    built = _per_platform(
        platform, {p: F.concat(F.lit(fixed.BASE_ADDRESS[p] + path), job_id) for p, path in DETAIL_PATH.items()}
    )
    if url is None:
        return built
    return F.coalesce(absolute(F.nullif(url, F.lit("")), base_address(platform)), built)


def base_address(platform: Column) -> Column:
    return _per_platform(platform, {p: F.lit(a) for p, a in fixed.BASE_ADDRESS.items()})


def query_encode(value: Column) -> Column:
    """Form encoding: blanks become ``+``; only letters, digits and ``_.-~`` stay."""
    return F.replace(F.replace(F.url_encode(value), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def query_string(params: Mapping[str, Column]) -> Column:
    """``a=1&b=2`` in the given order; NULL and empty parameters are left out."""
    pairs = [
        F.when(value.isNotNull() & (value.cast("string") != ""),
               F.concat(F.lit(f"{name}="), query_encode(value.cast("string"))))
        for name, value in params.items()
    ]
    return F.concat_ws("&", *pairs)


def listing_url(
    platform: Column,
    page: Column,
    category_id: Column | None = None,
    location_id: Column | None = None,
    query: Column | None = None,
    has_salary: Column | None = None,
    locale: Column | None = None,
) -> Column:
    none = F.lit(None).cast("string")
    has_salary = F.lit(False) if has_salary is None else has_salary
    searched = F.concat(
        F.lit(fixed.BASE_ADDRESS["jobs_ge"] + "/"), F.lit("en") if locale is None else locale, F.lit("?"),
        query_string({
            "page": page,
            "cid": none if category_id is None else category_id,
            "lid": none if location_id is None else location_id,
            "q": none if query is None else query,
            "has_salary": F.when(has_salary, F.lit("1")),
        }),
    )
    paged = {
        p: F.concat(F.lit(fixed.BASE_ADDRESS[p] + path), F.when(page > 1, F.concat(F.lit("?page="), page)).otherwise(""))
        for p, path in LISTING_PATH.items()
    }
    return _per_platform(platform, {"jobs_ge": searched, **paged})


def _per_platform(platform: Column, choices: Mapping[str, Column]) -> Column:
    out = None
    for name, value in choices.items():
        out = F.when(platform == name, value) if out is None else out.when(platform == name, value)
    return out
