"""Flags, places and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancylake import fixed_values as fixed


def icon_flags(sources: Column) -> dict[str, Column]:
    """One flag per icon kind: true when any image address contains its part."""

    def any_has(part: str) -> Column:
        return F.coalesce(F.exists(sources, lambda src: F.contains(src, F.lit(part))), F.lit(False))

    return {name: any_has(part) for name, part in fixed.ICON_PARTS.items()}


def is_remote_place(place: Column) -> Column:
    return F.coalesce(F.contains(F.lower(place), F.lit(fixed.REMOTE_WORD)), F.lit(False))


def has_marker(text: Column, marker: str) -> Column:
    """True/false when the element is there, NULL when it is missing."""
    return F.contains(text, F.lit(marker))


def location_display(is_remote: Column, city: Column, region: Column) -> Column:
    return (
        F.when(is_remote, F.lit(fixed.REMOTE_LABEL))
        .when(city.isNotNull() & region.isNotNull(), F.concat(city, F.lit(", "), region))
        .when(city.isNotNull(), city)
        .otherwise(F.lit(fixed.NO_LOCATION))
    )


def yes_no(flag: Column, yes: str = fixed.YES_MARK, no: str = fixed.NO_MARK) -> Column:
    return F.when(flag, F.lit(yes)).otherwise(F.lit(no))


def platform_code(name: Column) -> Column:
    """The identifier for any recorded spelling of a source; unknown names stay."""
    pairs = [F.lit(x) for spelled, code in fixed.PLATFORM_SPELLINGS.items() for x in (spelled, code)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), name)
