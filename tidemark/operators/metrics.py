"""A small metric layer: declared models, dimensions and named metrics, queried by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import ratio, rnd


@dataclass(frozen=True)
class Metric:
    """An aggregate in two steps: parts of the facts, which may be merged any number of times, and the value of parts."""

    parts: tuple[tuple[Callable[[], Column], Callable[[str], Column]], ...]
    value: Callable[..., Column] = lambda part: part

    def names(self, name: str) -> list[str]:
        return [f"_{name}_{i}" for i in range(len(self.parts))]

    def of_facts(self, name: str) -> list[Column]:
        return [first().alias(n) for n, (first, _) in zip(self.names(name), self.parts, strict=True)]

    def merged(self, name: str) -> Column:
        own = (again(n) for n, (_, again) in zip(self.names(name), self.parts, strict=True))
        return self.value(*own).alias(name)


def _counted(part: str) -> Column:
    return F.coalesce(F.sum(part), F.lit(0))


def _count(x):
    return Metric(((lambda: F.count(x), _counted),))


def _count_if(cond):
    return Metric(((lambda: F.count_if(cond()), _counted),))


def _sum(x):
    return Metric(((lambda: F.sum(x), F.sum),))


def _rounded_sum(x):
    return Metric(((lambda: F.sum(x), F.sum),), rnd)


def _avg(x):
    return Metric(((lambda: F.sum(x), F.sum), (lambda: F.count(x), F.sum)), lambda total, n: rnd(ratio(total, n)))


def _max(x):
    return Metric(((lambda: F.max(x), F.max),))


@dataclass(frozen=True)
class Model:
    """A fact table, the tables it refers to, its dimensions and its metrics.

    ``relations`` maps a table name to (key in the fact, key in the table, columns to add).
    ``dims`` None means every column of the fact may be used.
    """

    fact: str
    metrics: dict[str, Metric] = field(default_factory=dict)
    relations: dict[str, tuple[str, str, tuple[str, ...]]] = field(default_factory=dict)
    dims: tuple[str, ...] | None = None


CUSTOMER_COLUMNS = ("country", "account_tier", "overall_risk_rating", "risk_classification", "lifecycle_stage")
TO_CUSTOMER = ("customer_id", "customer_id", CUSTOMER_COLUMNS)
# "customers" is the customer view reduced to one row per customer
MODELS: dict[str, Model] = {
    "customer_360": Model(
        "customers",
        {
            "customer_count": _count("customer_id"),
            "total_balance_sum": _sum("total_balance"),
            "avg_balance": _avg("total_balance"),
        },
        {"advisors": ("current_advisor_employee_id", "employee_id", ("region", "performance_rating"))},
    ),
    "employee_advisor": Model(
        "advisors",
        {
            "advisor_count": _count("employee_id"),
            "total_aum_sum": _sum("total_aum"),
            "avg_aum": _avg("total_aum"),
            "total_clients_sum": _sum("total_clients"),
            "avg_retention": _avg("client_retention_rate"),
        },
    ),
    "compliance_monitoring": Model(
        "transaction_anomalies",
        {
            "transaction_count": _count("transaction_id"),
            "total_amount": _sum("amount"),
            "avg_amount": _avg("amount"),
            "high_risk_count": _count_if(
                lambda: F.col("overall_anomaly_classification").isin("HIGH_ANOMALY", "CRITICAL_ANOMALY")
            ),
        },
        {"customers": TO_CUSTOMER},
    ),
    "wealth_management": Model(
        "portfolio_performance",
        {
            "portfolio_count": _count("account_id"),
            "total_aum": _sum("total_portfolio_value_chf"),
            "avg_portfolio_value": _avg("total_portfolio_value_chf"),
            "avg_return": _avg("total_portfolio_twr_percentage"),
            "avg_sharpe": _avg("sharpe_ratio"),
            "best_return": _max("total_portfolio_twr_percentage"),
        },
        {"customers": TO_CUSTOMER},
    ),
    "risk_reporting": Model(
        "risk_aggregation",
        {
            "customer_risk_count": _count("customer_id"),
            "total_exposure_sum": _sum("total_exposure_chf"),
            "total_capital_sum": _rounded_sum("total_capital_requirement_chf"),
            "avg_exposure": _avg("total_exposure_chf"),
            "max_concentration": _max("max_single_exposure_chf"),
        },
        {"customers": TO_CUSTOMER},
    ),
    # models that declare facts and dimensions only
    **{
        name: Model(fact)
        for name, fact in {
            "lcr_current": "lcr_current",
            "hqla_breakdown": "hqla_breakdown",
            "outflow_breakdown": "outflow_breakdown",
            "lcr_trend": "lcr_trend_90day",
            "lcr_alerts": "alerts_active",
            "loan_portfolio": "loan_portfolio_summary",
            "loan_ltv": "ltv_distribution",
            "loan_funnel": "application_funnel",
            "loan_affordability": "affordability_summary",
            "loan_compliance": "loan_compliance_screening",
        }.items()
    },
}


def metric_query(
    model: Model | str,
    tables: Callable[[str], DataFrame],
    *,
    metrics: list[str] = (),
    dims: list[str] = (),
    filters: Column | None = None,
) -> DataFrame:
    """Named metrics by dimensions; without metrics, the distinct dimension rows.

    The fact is reduced to one row per join key and own dimensions before it is joined, and only relations that a
    dimension needs are joined.  A referenced table is reduced to one row per key first, so facts are never repeated.
    """
    m = MODELS[model] if isinstance(model, str) else model
    unknown = [x for x in metrics if x not in m.metrics]
    if unknown:
        raise KeyError(f"unknown metrics: {unknown}")
    df = tables(m.fact)
    if filters is not None:
        df = df.where(filters)
    own = [x for x in dims if x in df.columns]
    joined = {t: [x for x in columns if x in dims and x not in own] for t, (_, _, columns) in m.relations.items()}
    known = [*own, *(x for columns in joined.values() for x in columns)]
    missing = [x for x in dims if x not in known or (m.dims is not None and x not in m.dims)]
    if missing:
        raise KeyError(f"unknown dimensions: {missing}")
    needed = {t: columns for t, columns in joined.items() if columns}
    keys = list(dict.fromkeys([*own, *(m.relations[t][0] for t in needed)]))
    parts = [column for x in metrics for column in m.metrics[x].of_facts(x)]
    if parts:
        df = df.groupBy(*keys).agg(*parts)
    else:
        df = df.select(*keys).distinct()
    for table, columns in needed.items():
        here, there, _ = m.relations[table]
        lookup = tables(table).select(F.col(there).alias("_key"), *columns).distinct()
        df = df.join(lookup, F.col(here) == F.col("_key"), "left").drop("_key")
    if not metrics:
        return df.select(*dims).distinct()
    return df.groupBy(*dims).agg(*(m.metrics[x].merged(x) for x in metrics))


def wealth_detailed(performance: DataFrame, customer_view: DataFrame) -> DataFrame:
    """Portfolio rows with the customer's name, country, tier and rating."""
    who = customer_view.select(
        "customer_id",
        F.col("full_name").alias("customer_name"),
        F.col("country").alias("customer_country"),
        F.col("account_tier").alias("customer_tier"),
        F.col("overall_risk_rating").alias("customer_risk_rating"),
    ).distinct()
    return performance.join(who, "customer_id", "left")
