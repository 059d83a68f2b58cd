"""Salary texts and salary display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancylake import fixed_values as fixed

# the first "a - b" anywhere, else the first number
_BOUNDS = r"(?s)^(?:.*?([\d,]+)\s*-\s*([\d,]+)|.*?([\d,]+)).*$"
_PLAIN = r"\d+(?:-\d+)?"
_GROUPED = r"(?:\d{1,3}(?:,\d{3})+|\d+)(?:\s*-\s*(?:\d{1,3}(?:,\d{3})+|\d+))?"


def money(value: Column) -> Column:
    """DECIMAL(10,2), rounded half up; NULL when it does not fit."""
    return value.try_cast("decimal(10,2)")


def _amount(text: Column) -> Column:
    return money(F.replace(text, F.lit(","), F.lit("")))


def _salary(low: Column, high: Column) -> Column:
    return F.when(
        low.isNotNull() & high.isNotNull(),
        F.struct(low.alias("min_amount"), high.alias("max_amount"),
                 F.lit(fixed.CURRENCY).alias("currency"), F.lit(fixed.PERIOD).alias("period")),
    )


def salary_from_label(text: Column) -> Column:
    """``2,800 - 3,000 ₾ თვეში`` -> min, max, currency, period; NULL when no number is there."""
    clean = F.replace(F.replace(text, F.lit(fixed.LARI_SIGN), F.lit("")), F.lit(fixed.PER_MONTH_WORD), F.lit(""))
    bounds = F.regexp_replace(clean, _BOUNDS, "$1$3|$2$3")  # unmatched groups are empty
    low, high = (_amount(F.split_part(bounds, F.lit("|"), F.lit(i))) for i in (1, 2))
    return _salary(low, high)


def salary_from_prose(text: Column, grouped_digits: bool = True) -> Column:
    """Amount, currency and matched words from running text, NULL when none.

    Three shapes are tried in order. ``grouped_digits=False`` reads digits
    only, so ``1,200`` counts as ``200``.
    """
    number = _GROUPED if grouped_digits else _PLAIN
    found = None
    for shape in fixed.SALARY_SHAPES:
        pattern = "(?iu)" + shape.replace("N", number)
        hit = F.struct(
            F.regexp_replace(F.regexp_extract(text, pattern, 1), r"[,\s]", "").alias("amount"),
            F.lit(fixed.CURRENCY).alias("currency"),
            F.regexp_extract(text, pattern, 0).alias("raw_text"),
        )
        found = F.when(text.rlike(pattern), hit) if found is None else found.when(text.rlike(pattern), hit)
    return found


def amount_bounds(amount: Column) -> tuple[Column, Column]:
    """``1000-1500`` -> (1000, 1500); ``900`` -> (900, 900)."""
    parts = F.split(amount, "-", 2)
    low = money(F.get(parts, F.lit(0)))
    return low, F.coalesce(money(F.get(parts, F.lit(1))), low)


def mentions_currency(text: Column) -> Column:
    return text.rlike(fixed.CURRENCY_MARKS)


def salary_range(low: Column, high: Column, currency: Column) -> Column:
    shown = F.coalesce(currency, F.lit(""))
    low_text, high_text = low.cast("string"), high.cast("string")
    return (
        F.when(low.isNotNull() & high.isNotNull(), F.concat(low_text, F.lit("-"), high_text, F.lit(" "), shown))
        .when(low.isNotNull(), F.concat(F.lit("From "), low_text, F.lit(" "), shown))
        .otherwise(F.lit(fixed.NOT_SPECIFIED))
    )
