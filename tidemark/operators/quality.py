"""Measured data quality of any table: completeness, uniqueness, validity, timeliness, grade."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import at_least, days, flag, on_date, pct, rnd


def quality_report(
    df: DataFrame,
    *,
    keys: list[str],
    required: list[str],
    domains: dict[str, list | Column],
    freshness_col: str,
    as_of,
    max_age_days: int = 1,
    name: str = "table",
) -> DataFrame:
    """One row of scores.

    Completeness: filled required cells.  Uniqueness: rows whose key is not repeated, from one
    count per key.  Validity: rows that meet every domain rule.  Timeliness: 100 while the newest
    row is at most ``max_age_days`` old, then one point less per day.
    """
    n = F.count(F.lit(1))
    cells = reduce(lambda a, b: a + b, [F.count(x) for x in required])
    rules = [F.col(x).isin(rule) if isinstance(rule, list) else rule for x, rule in domains.items()]
    valid = reduce(lambda a, b: a & b, [flag(x) for x in rules], F.lit(True))
    age = F.greatest(days(F.max(freshness_col), on_date(as_of)), F.lit(0))
    main = df.agg(
        n.alias("total_records"),
        pct(cells, n * len(required)).alias("completeness_percent"),
        *[(n - F.count(x)).alias(f"missing_{x}") for x in required],
        pct(F.count_if(valid), n).alias("validity_score"),
        F.count_if(~valid).alias("invalid_records"),
        age.alias("age_days"),
        F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100.0 + max_age_days - age)).alias("timeliness_score"),
    )
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    unique = per_key.agg(
        F.count(F.lit(1)).alias("unique_keys"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("duplicate_records"),
        pct(F.sum(F.when(F.col("_n") == 1, 1).otherwise(0)), F.sum("_n")).alias("uniqueness_score"),
    )
    total = (
        F.col("completeness_percent") + F.col("uniqueness_score") + F.col("validity_score") + F.col("timeliness_score")
    ) / 4
    return (
        main.crossJoin(F.broadcast(unique))  # one row each
        .withColumn("overall_quality_score", rnd(total))
        .withColumns(
            {
                "data_source": F.lit(name),
                "quality_grade": at_least("overall_quality_score", [(95, "A"), (90, "B"), (80, "C")], "D"),
                "quality_status": at_least("overall_quality_score", [(90, "GOOD"), (80, "ACCEPTABLE")], "POOR"),
                "issues_count": F.col("duplicate_records") + F.col("invalid_records"),
            }
        )
    )


def customer_completeness(customers: DataFrame) -> DataFrame:
    """Missing names, addresses and birth dates of current customers."""
    fields = {"first_name": "first_name", "family_name": "family_name", "email": "email", "dob": "date_of_birth"}
    gaps = reduce(lambda a, b: a | b, [F.col(x).isNull() for x in fields.values()])
    n = F.count(F.lit(1))
    return customers.agg(
        n.alias("total_customers"),
        *[F.count_if(F.col(col).isNull()).alias(f"missing_{x}") for x, col in fields.items()],
        pct(n - F.count_if(gaps), n).alias("completeness_percentage"),
    )
