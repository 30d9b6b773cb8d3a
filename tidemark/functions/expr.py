"""Small column helpers shared by every operator.

All of them build Catalyst expressions, so they stay inside code generation.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def c(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def ladder(rules, default=None) -> Column:
    """First matching rule wins; ``rules`` is a list of (condition, value)."""
    first_cond, first_value = rules[0]
    out = F.when(first_cond, first_value)
    for cond, value in rules[1:]:
        out = out.when(cond, value)
    return out.otherwise(default)


def at_least(value, cuts, default=None) -> Column:
    """Label of the first cut that ``value`` reaches (>=)."""
    return ladder([(c(value) >= cut, label) for cut, label in cuts], default)


def above(value, cuts, default=None) -> Column:
    """Label of the first cut that ``value`` exceeds (>)."""
    return ladder([(c(value) > cut, label) for cut, label in cuts], default)


def at_most(value, cuts, default=None) -> Column:
    return ladder([(c(value) <= cut, label) for cut, label in cuts], default)


def below(value, cuts, default=None) -> Column:
    return ladder([(c(value) < cut, label) for cut, label in cuts], default)


def choose(value, mapping: dict, default=None) -> Column:
    return ladder([(c(value) == key, out) for key, out in mapping.items()], default)


def flag(cond: Column) -> Column:
    """Three-valued condition as a plain true/false."""
    return F.coalesce(cond, F.lit(False))


def dbl(value) -> Column:
    return c(value).cast("double")


def ratio(num, den) -> Column:
    """Quotient as double, null when the denominator is zero or null."""
    return F.try_divide(dbl(num), dbl(den))


def rnd(value, digits: int = 2) -> Column:
    """Round half away from zero, as decimals do; a binary 2.4999999999999996 counts as 2.5."""
    return F.round(dbl(value).cast(f"decimal(38,{digits + 4})"), digits).cast("double")


def pct(num, den, digits: int = 2) -> Column:
    return rnd(F.try_divide(dbl(num) * 100.0, dbl(den)), digits)


def zero(value) -> Column:
    return F.coalesce(c(value), F.lit(0))


def sum_if(cond: Column, value) -> Column:
    """Sum over matching rows, 0 when there are none."""
    return zero(F.sum(F.when(cond, c(value))))


def mean(value) -> Column:
    """Average from an exact sum and a count (no intermediate decimal rounding)."""
    return F.try_divide(F.sum(c(value)).cast("double"), F.count(c(value)).cast("double"))


def weighted_mean(value, weight) -> Column:
    return ratio(F.sum(c(value) * c(weight)), F.sum(c(weight)))


def on_date(as_of: date | str) -> Column:
    return F.lit(str(as_of)).cast("date")


def as_date(value) -> Column:
    return c(value).cast("date")


def days(start, end) -> Column:
    return F.datediff(as_date(end), as_date(start))


def months_crossed(start, end) -> Column:
    """Calendar-month boundaries between two dates."""
    a, b = as_date(start), as_date(end)
    return (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))


def years_crossed(start, end) -> Column:
    return F.year(as_date(end)) - F.year(as_date(start))


def minutes_crossed(start, end) -> Column:
    def minute_no(ts):
        return F.floor(F.unix_seconds(F.date_trunc("minute", c(ts)).cast("timestamp")) / 60)

    return (minute_no(end) - minute_no(start)).cast("bigint")


def day_number(value) -> Column:
    return F.unix_date(as_date(value))


def is_weekend(value) -> Column:
    return F.dayofweek(as_date(value)).isin(1, 7)


def is_tagged(text) -> Column:
    """Text that carries a bracketed tag."""
    return c(text).rlike(r"(?s)\[.*\]")


def tag_of(text) -> Column:
    return F.regexp_extract(c(text), r"\[(.*?)\]", 1)


def distinct_list(value) -> Column:
    """Sorted, comma-separated distinct values; empty text when there are none."""
    return F.array_join(F.array_sort(F.collect_set(c(value))), ", ")


def attach_total(df: DataFrame, **totals: Column) -> DataFrame:
    """Add one-row totals to every row without a single-partition window."""
    return df.crossJoin(F.broadcast(df.agg(*[expr.alias(name) for name, expr in totals.items()])))


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for consumers that do not keep decimal types."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
