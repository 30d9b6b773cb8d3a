"""Compliance, lending, wealth, staff and dashboard reports over the marts.

Ordered lists with a limit are top-k reports: Spark keeps only the best rows of each partition.
Every limited report has a unique last sort key, so the rows are the same on every run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import (
    above, at_least, at_most, attach_total, below, choose, days, distinct_list, flag, ladder, mean, on_date, pct, ratio, rnd,
    sum_if, zero,
)
from tidemark.functions.spread import quantiles
from tidemark.operators.customer import MATCHED, one_per_customer

ALERTS = ("CRITICAL_ANOMALY", "HIGH_ANOMALY", "MODERATE_ANOMALY")
NORDICS, CENTRAL = ("Sweden", "Norway", "Denmark", "Finland"), ("Germany", "Austria", "Switzerland")


def _cls() -> Column:
    return F.col("overall_anomaly_classification")


def _n() -> Column:
    return F.count(F.lit(1))


def _side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    out = one_row_frames[0]
    for more in one_row_frames[1:]:
        out = out.crossJoin(F.broadcast(more))
    return out


# ---- anti money laundering --------------------------------------------------------------------


def quarterly_alerts(txns: DataFrame, scored: DataFrame, customer_view: DataFrame, *, n_days: int = 90) -> DataFrame:
    """Alert volumes and filing estimates over the last days of data."""
    end = txns.agg(F.max("value_date").alias("_end"))

    def recent(df):
        both = df.crossJoin(F.broadcast(end))  # one row
        return both.where(F.col("value_date").between(F.date_sub("_end", n_days), F.col("_end")))

    universe = recent(txns).agg(
        _n().alias("total_transactions"), F.sum(F.abs("amount")).alias("_volume"), F.countDistinct("account_id").alias("unique_accounts")
    )
    hits, urgent = recent(scored).where(_cls().isin(*ALERTS)), F.col("requires_immediate_review")
    serious = _cls().isin("CRITICAL_ANOMALY", "HIGH_ANOMALY")
    alerts = hits.agg(
        _n().alias("total_alerts"),
        F.count_if(_cls() == "CRITICAL_ANOMALY").alias("critical_alerts"),
        F.count_if(_cls() == "HIGH_ANOMALY").alias("high_alerts"),
        F.count_if(urgent).alias("immediate_review_required"),
        F.count_if(_cls() == "MODERATE_ANOMALY").alias("likely_false_positives"),
        F.count_if(serious & urgent).alias("likely_true_positives"),
    )
    homes = customer_view.where(F.col("country").isNotNull()).select("customer_id", "country").distinct()
    home = F.col("country")
    filings = (
        hits.where(serious & urgent)
        .select("customer_id")
        .distinct()
        .join(homes, "customer_id")
        .agg(
            _n().alias("estimated_sar_filings"),
            *[F.count_if(home == x).alias(f"sar_{x.lower()}") for x in ("Switzerland", "Germany", "Austria")],
            F.count_if(home.isin(*NORDICS)).alias("sar_nordics"),
        )
    )
    total, n = F.col("total_alerts"), F.col("total_transactions")
    return (
        _side_by_side(universe, alerts, filings)
        .withColumns(
            {
                "total_volume_million_usd": rnd(F.col("_volume").cast("double") / 1000000),
                "alerts_per_1000_transactions": rnd(ratio(total * 1000, n)),
                "false_positive_rate_pct": pct("likely_false_positives", total),
                "true_positive_rate_pct": pct("likely_true_positives", total),
                "sar_rate_per_10k_transactions": rnd(ratio(F.col("estimated_sar_filings") * 10000, n), 4),
                "alerts_per_sar_ratio": rnd(ratio(total, "estimated_sar_filings")),
            }
        )
        .drop("_volume")
    )


def alert_backlog(scored: DataFrame, customer_view: DataFrame, *, as_of) -> DataFrame:
    """Open alerts by severity, service level, age and region; alerts are counted by customer, day and class first."""
    homes = customer_view.select("customer_id", "country").distinct()
    counted = scored.where(_cls().isin(*ALERTS)).groupBy("customer_id", "value_date", _cls()).agg(_n().alias("alerts"))
    df = counted.join(homes, "customer_id", "left").withColumn("age", days("value_date", on_date(as_of)))
    limit = choose(_cls(), {"CRITICAL_ANOMALY": 5, "HIGH_ANOMALY": 15}, 30)
    age, home, n = F.col("age"), F.col("country"), F.col("alerts")

    def total(when: Column | None = None) -> Column:
        return zero(F.sum(n if when is None else F.when(when, n)))

    late, dated = total(age > limit), total(age.isNotNull())
    nordic, central = flag(home.isin(*NORDICS)), flag(home.isin(*CENTRAL))
    return df.agg(
        total().alias("total_open_alerts"),
        rnd(ratio(F.sum(age * n), dated), 1).alias("avg_age_days"),
        F.max("age").alias("oldest_alert_days"),
        *[total(_cls() == x).alias(f"{x.split('_')[0].lower()}_open") for x in ALERTS],
        late.alias("sla_breach_count"),
        pct(late, total()).alias("sla_breach_percentage"),
        *_aging("alerts", count=total),
        total(nordic).alias("nordic_backlog"),
        total(central).alias("central_europe_backlog"),
        total(~nordic & ~central).alias("other_backlog"),
    )


def _aging(prefix: str, age: str = "age", count: Callable[[Column], Column] = F.count_if) -> list[Column]:
    a = F.col(age)
    return [
        count(a <= 7).alias(f"{prefix}_0_7_days"),
        count((a > 7) & (a <= 30)).alias(f"{prefix}_8_30_days"),
        count((a > 30) & (a <= 90)).alias(f"{prefix}_31_90_days"),
        count(a > 90).alias(f"{prefix}_90_plus_days"),
    ]


def risk_heatmap(txns, scored, accounts, customer_view, *, top: int = 10) -> DataFrame:
    """Alert rate by country, by amount tier and by kind of customer.

    Payments and alerts are each reduced to one row per account and tier before anything is joined.
    """
    tier = at_least(
        "amount", [(100000, "TIER_1_>100K"), (10000, "TIER_2_10K-100K"), (1000, "TIER_3_1K-10K")], "TIER_4_<1K"
    ).alias("tier")
    alerts = scored.where(_cls().isin(*ALERTS)).groupBy("account_id", tier)
    alerts = alerts.agg(_n().alias("alerts"), F.count_if(_cls() == "CRITICAL_ANOMALY").alias("critical"))
    paid = txns.groupBy("account_id", tier).agg(_n().alias("n"), F.sum("amount").alias("amount"), F.count("amount").alias("valued"))
    rows = paid.join(alerts, ["account_id", "tier"], "left")
    kinds = one_per_customer(customer_view).select(
        "customer_id",
        "country",
        ladder(
            [
                (F.col("exposed_person_match_type").isin(*MATCHED), "PEP"),
                (F.col("risk_classification").isin("CRITICAL", "HIGH"), "HIGH_RISK"),
            ],
            "STANDARD",
        ).alias("_kind"),
    )
    pep = customer_view.groupBy("customer_id").agg(
        F.max(F.col("exposed_person_match_type").isin(*MATCHED)).alias("_pep")
    )
    kinds = kinds.join(pep, "customer_id").withColumn("_kind", F.when(F.col("_pep"), "PEP").otherwise(F.col("_kind")))
    owned = rows.join(accounts.select("account_id", "customer_id"), "account_id", "left").join(
        kinds.drop("_pep"), "customer_id", "left"
    )
    hits = zero(F.sum("alerts"))

    def part(df, dimension, category, detail):
        out = df.groupBy(category.alias("category")).agg(
            hits.alias("alert_count"),
            F.sum("n").alias("total_transactions"),
            pct(hits, F.sum("n")).alias("alert_rate_pct"),
            detail.cast("double").alias("detail_metric"),
        )
        return out.withColumn("risk_dimension", F.lit(dimension))

    by_country = (
        part(owned.where(F.col("country").isNotNull()), "COUNTRY_RISK", F.col("country"), zero(F.sum("critical")))
        .orderBy(F.desc("alert_rate_pct"), "category")
        .limit(top)
    )
    by_tier = part(rows, "AMOUNT_TIER", F.col("tier"), rnd(ratio(F.sum("amount"), F.sum("valued"))))
    by_kind = part(owned, "CUSTOMER_TYPE", F.coalesce("_kind", F.lit("STANDARD")), F.max(F.lit(None).cast("double")))
    return by_country.unionByName(by_tier).unionByName(by_kind)


def analysis_period(txns: DataFrame, *, n_days: int = 90) -> DataFrame:
    """First and last value date and the start of the last analysis window."""
    return txns.agg(F.min("value_date").alias("earliest_date"), F.max("value_date").alias("latest_date")).withColumns(
        {"analysis_start": F.date_sub("latest_date", n_days), "analysis_end": F.col("latest_date")}
    )


def filings_by_country(scored: DataFrame, customer_view: DataFrame) -> DataFrame:
    """Customers with a serious alert that needs immediate review, by country."""
    serious = _cls().isin("CRITICAL_ANOMALY", "HIGH_ANOMALY") & F.col("requires_immediate_review")
    homes = customer_view.where(F.col("country").isNotNull()).select("customer_id", "country").distinct()
    people = scored.where(serious).select("customer_id").distinct().join(homes, "customer_id")
    return people.groupBy("country").agg(_n().alias("customer_count")).orderBy(F.desc("customer_count"))


# ---- sanctions --------------------------------------------------------------------------------

EMBARGOED = ("RU", "BY", "KP", "IR", "SY", "CU", "VE")


def sanctions_universe(scored, customer_view, watch_list, screening, *, as_of, n_days: int = 30) -> DataFrame:
    """What was screened and what was hit, on one row."""
    recent = scored.where(F.col("value_date") >= F.date_sub(on_date(as_of), n_days))
    paid = recent.agg(
        _n().alias("total_transactions_30d"),
        F.sum("amount").alias("_value"),
    )
    senders = recent.agg(F.countDistinct("account_id").alias("unique_sender_accounts"))
    receivers = recent.agg(F.countDistinct("counterparty_account").alias("unique_receiver_accounts"))
    people = (
        customer_view.select("customer_id", "country")
        .distinct()
        .agg(
            _n().alias("total_customers"),
            F.count_if(F.col("country").isin(*EMBARGOED)).alias("high_risk_country_customers"),
        )
    )
    listed = watch_list.select("entity_name").distinct().agg(_n().alias("total_sanctioned_entities"))
    kinds = watch_list.agg(F.size(F.collect_set("entity_type")).alias("entity_types_monitored"))
    flags = {
        "exact_match_hits": F.col("match_type") == "EXACT_MATCH",
        "fuzzy_match_hits": F.col("match_type") == "FUZZY_MATCH",
        "alias_match_hits": F.col("match_type") == "ALIAS_MATCH",
        "high_confidence_hits": F.col("match_confidence") == "HIGH_CONFIDENCE",
        "medium_confidence_hits": F.col("match_confidence") == "MEDIUM_CONFIDENCE",
    }
    hits = (
        screening.groupBy("customer_id")
        .agg(*[F.max(x).alias(k) for k, x in flags.items()])
        .agg(_n().alias("total_customers_with_hits"), *[F.count_if(k).alias(k) for k in flags])
    )
    score = screening.agg(rnd(mean("match_score")).alias("avg_match_score"))
    out = _side_by_side(paid, senders, receivers, people, listed, kinds, hits, score)
    return out.withColumns(
        {"total_value_million_usd": rnd(F.col("_value").cast("double") / 1000000), "confirmed_breaches": F.lit(0)}
    ).drop("_value")


def sanctions_hits(screening: DataFrame, *, limit: int = 50) -> DataFrame:
    return (
        screening.orderBy(
            F.desc("match_score"), F.desc("combined_risk_score"), "customer_id", "entity_id", "match_type"
        )
        .limit(limit)
        .select(
            "customer_id", "customer_name", "customer_dob", "customer_country", "match_type", "entity_name", "authority",
            "list_name", "sanctions_program", "match_score", "match_confidence", "dob_match", "nationality_match",
            "disposition_recommendation", "alert_priority", "combined_risk_score",
        )
    )


def sanctions_quality(screening: DataFrame) -> DataFrame:
    """Signals behind the hits of each confidence level."""
    dob, nat = F.col("dob_match"), F.col("nationality_match")
    flags = {"dob_matches": dob, "nationality_matches": nat, "multi_signal_validation": dob & nat}
    people = (
        screening.groupBy("match_confidence", "customer_id")
        .agg(*[F.max(x).alias(k) for k, x in flags.items()])
        .groupBy("match_confidence")
        .agg(_n().alias("customers"), *[F.count_if(k).alias(k) for k in flags])
    )
    rest = screening.groupBy("match_confidence").agg(
        rnd(mean("match_score")).alias("avg_match_score"),
        distinct_list("disposition_recommendation").alias("recommended_actions"),
    )
    return people.join(rest, "match_confidence")


def sanctions_alerts(alerts: DataFrame, *, limit: int = 25) -> DataFrame:
    rank = choose("alert_priority", {"CRITICAL": 1, "HIGH": 2, "MEDIUM": 3})
    return (
        alerts.orderBy(rank, F.desc("combined_risk_score"), "customer_id", "entity_id", "match_type")
        .limit(limit)
        .select(
            "customer_id", "customer_name", "customer_country", "match_type", "entity_name", "authority",
            "sanctions_program", "alert_priority", "match_confidence", "combined_risk_score", "disposition_recommendation",
        )
    )


# ---- know your customer -----------------------------------------------------------------------


def kyc_audit_trail(customer_view, customer_history, address_history, customer_id: str, *, as_of) -> dict[str, DataFrame]:
    """Profile, last ten risk versions and last five addresses of one customer."""
    mine, today = F.col("customer_id") == customer_id, on_date(as_of)
    until = F.coalesce("valid_to", today)
    profile = customer_view.where(mine).select(
        "customer_id", "first_name", "family_name", "date_of_birth", "country", "onboarding_date",
        F.col("exposed_person_match_type").alias("pep_status"),
        F.coalesce("exposed_person_exact_category", "exposed_person_fuzzy_category").alias("pep_category"),
        "sanctions_match_type", F.col("risk_classification").alias("current_risk"), "has_anomaly", "total_accounts",
        F.col("total_balance").alias("total_aum"), "total_transactions", "last_transaction_date",
    )
    newest = [F.desc("valid_from"), F.desc("insert_timestamp_utc")]
    risk = (
        customer_history.where(mine)
        .orderBy(*newest)
        .limit(10)
        .select(
            "customer_id", "risk_classification", "credit_score_band", "valid_from", "valid_to",
            days("valid_from", until).alias("days_in_status"),
            F.when(F.col("valid_to").isNull(), "CURRENT").otherwise("HISTORICAL").alias("status"),
        )
    )
    homes = (
        address_history.where(mine)
        .orderBy(*newest)
        .limit(5)
        .select(
            "customer_id", "street_address", "city", "state", "zipcode", "country", "valid_from", "valid_to", "is_current",
            days("valid_from", until).alias("residence_days"),
        )
    )
    return {"profile": profile, "risk_versions": risk, "addresses": homes}


def kyc_overdue(customer_view: DataFrame, *, as_of) -> DataFrame:
    """Customers past their refresh date: yearly for exposed persons, else by risk."""
    pep, severe = F.col("exposed_person_match_type").isin(*MATCHED), flag(F.col("risk_classification").isin("CRITICAL", "HIGH"))
    policy = ladder([(pep, 365), (severe, 730)], 1095)
    over = days("onboarding_date", on_date(as_of)) - policy
    df = customer_view.select(over.alias("over"), (pep | severe).alias("special"))
    o = F.col("over")
    late = F.count_if(o > 0)
    return df.agg(
        _n().alias("total_customers"),
        F.count_if(o <= 0).alias("kyc_current_count"),
        late.alias("kyc_overdue_count"),
        pct(F.count_if(o <= 0), _n()).alias("kyc_current_percentage"),
        pct(late, _n()).alias("kyc_overdue_percentage"),
        F.count_if((o > 0) & (o <= 30)).alias("overdue_0_30_days"),
        F.count_if((o > 30) & (o <= 90)).alias("overdue_31_90_days"),
        F.count_if((o > 90) & (o <= 180)).alias("overdue_91_180_days"),
        F.count_if(o > 180).alias("overdue_180_plus_days"),
        F.count_if((o > 0) & F.col("special")).alias("high_risk_overdue_count"),
        F.greatest(F.max("over"), F.lit(0)).alias("max_days_overdue"),
        rnd(mean(F.when(o > 0, o)), 1).alias("avg_days_overdue"),
    )


def screening_alert_aging(customer_view: DataFrame, *, as_of) -> DataFrame:
    pep, hit = F.col("exposed_person_match_type").isin(*MATCHED), F.col("sanctions_match_type").isin(*MATCHED)
    cls = F.col("risk_classification")
    kinds = [
        (pep & (cls == "CRITICAL"), "PEP_CRITICAL", 5),
        (pep, "PEP_STANDARD", 15),
        (hit, "SANCTIONS_HIT", 7),
        (cls == "CRITICAL", "CRITICAL_RISK", 7),
        (cls == "HIGH", "HIGH_RISK", 30),
    ]
    df = customer_view.where(pep | hit | cls.isin("CRITICAL", "HIGH")).select(
        days("onboarding_date", on_date(as_of)).alias("age"),
        ladder([(cond, label) for cond, label, _ in kinds], "OTHER").alias("kind"),
        ladder([(cond, limit) for cond, _, limit in kinds], 30).alias("limit"),
    )
    age, kind = F.col("age"), F.col("kind")
    late = F.count_if(age > F.col("limit"))
    return df.agg(
        _n().alias("total_alerts"),
        late.alias("sla_breach_count"),
        pct(late, _n()).alias("sla_breach_percentage"),
        F.count_if(kind == "PEP_CRITICAL").alias("pep_critical_count"),
        F.count_if(kind == "PEP_STANDARD").alias("pep_standard_count"),
        F.count_if(kind == "SANCTIONS_HIT").alias("sanctions_count"),
        F.count_if(kind.isin("CRITICAL_RISK", "HIGH_RISK")).alias("other_high_risk_count"),
        *_aging("aging"),
        F.max("age").alias("oldest_alert_days"),
        rnd(mean("age"), 1).alias("avg_alert_age_days"),
        F.count_if(age > 30).alias("alerts_over_30_days"),
        F.count_if(age > 90).alias("alerts_over_90_days"),
    )


# ---- staff ------------------------------------------------------------------------------------


def advisor_list(performance: DataFrame) -> DataFrame:
    return (
        performance.where(F.col("employment_status") == "ACTIVE")
        .orderBy(F.desc("available_capacity"), F.desc("performance_rating"))
        .select(
            "employee_id", "advisor_name", "country", "region", "tenure_days",
            rnd(F.col("tenure_days") / 365.25, 1).alias("tenure_years"), "performance_rating", "languages_spoken",
            "total_clients", "available_capacity", "capacity_utilization_pct", "workload_status",
            rnd("total_portfolio_value", 0).alias("total_aum_chf"), rnd("avg_client_balance", 0).alias("avg_aum_per_client"),
            "high_risk_clients", "critical_risk_clients", "team_leader_name",
        )
    )


def advisor_capacity(performance: DataFrame) -> DataFrame:
    return performance.select(
        "employee_id", "advisor_name", "total_clients", "workload_status", "available_capacity", "total_portfolio_value",
        "region", "country", "capacity_utilization_pct", "total_transactions", "high_risk_clients", "performance_rating",
        "employment_status",
    ).orderBy(F.desc("available_capacity"))


def wealth_portfolios(performance: DataFrame) -> DataFrame:
    return performance.select(
        F.col("employee_id").alias("advisor_id"), "advisor_name", F.col("total_portfolio_value").alias("total_aum"),
        F.col("total_clients").alias("client_count"), F.col("avg_client_balance").alias("avg_aum_per_client"),
        "performance_rating", "region",
    ).orderBy(F.desc("total_aum"))


def team_report(teams: DataFrame) -> DataFrame:
    """Teams by assets, with assets per advisor."""
    return teams.select(
        "team_leader_id", "team_leader_name", "region", "total_advisors", "active_advisors",
        rnd("total_team_aum", 0).alias("team_aum_chf"),
        rnd(ratio("total_team_aum", "total_advisors"), 0).alias("avg_aum_per_advisor"), "total_clients",
        "avg_clients_per_advisor", "team_available_capacity",
        rnd("team_capacity_utilization_pct", 1).alias("team_utilization_pct"), "high_risk_clients",
        "avg_advisor_performance", "min_advisor_performance", "max_advisor_performance",
    ).orderBy(F.desc("team_aum_chf"))


def hiring_need(workload: DataFrame) -> DataFrame:
    use = F.col("capacity_utilization_pct")
    need = F.ceil((F.col("total_clients") - F.col("advisor_count") * 150.0) / 150.0)
    return workload.select(
        "country", "region", F.col("advisor_count").alias("total_advisors"), "total_clients", "avg_clients_per_advisor",
        "available_capacity", rnd(use, 1).alias("avg_utilization_pct"), "total_capacity", "used_capacity",
        above(use, [(90, "URGENT_HIRING_NEEDED"), (80, "HIRING_RECOMMENDED"), (70, "MONITOR_CLOSELY")], "ADEQUATE_COVERAGE").alias(
            "hiring_status"
        ),
        F.when(use > 75, need).otherwise(0).cast("bigint").alias("estimated_advisors_needed"),
    )


def advisor_revenue(by_advisor: DataFrame, performance: DataFrame) -> DataFrame:
    """Assets, revenue and share of high-value clients per active advisor."""
    who = performance.where(F.col("employment_status") == "ACTIVE").select(
        F.col("employee_id").alias("advisor_employee_id"), "tenure_days", "performance_rating", "team_leader_name"
    )
    top = F.col("premium_clients") + F.col("platinum_clients") + F.col("gold_clients")
    return by_advisor.join(who, "advisor_employee_id").select(
        "advisor_employee_id", "advisor_name", "country", "region", rnd("total_aum", 0).alias("total_aum_chf"),
        F.col("total_clients").alias("client_count"), rnd("avg_aum_per_client", 0).alias("avg_client_aum"),
        rnd("estimated_annual_revenue", 0).alias("estimated_annual_revenue_chf"), top.alias("high_value_clients_count"),
        pct(top, "total_clients", 1).alias("high_value_client_pct"), "tenure_days",
        rnd(F.col("tenure_days") / 365.25, 1).alias("tenure_years"), "performance_rating", "team_leader_name",
    )


def relationship_list(assignments: DataFrame, *, limit: int = 1000) -> DataFrame:
    """Current client relationships with their reach and stage."""
    held = F.col("assignment_duration_days")
    return (
        assignments.select(
            "advisor_employee_id", "advisor_name", "advisor_country", "advisor_region", "customer_id", "customer_name",
            "customer_country", F.col("risk_classification").alias("customer_risk_classification"), "assignment_start_date",
            held.alias("relationship_duration_days"), F.col("assignment_duration_years").alias("relationship_duration_years"),
            rnd("total_balance", 0).alias("client_aum_chf"), F.col("total_accounts").alias("customer_total_accounts"),
            F.when(F.col("advisor_country") != F.col("customer_country"), "CROSS_BORDER").otherwise("DOMESTIC").alias("assignment_type"),
            below(held, [(180, "NEW_RELATIONSHIP"), (730, "ESTABLISHING"), (1825, "MATURE")], "LONGSTANDING").alias("relationship_stage"),
        )
        .orderBy("advisor_name", F.desc_nulls_first("client_aum_chf"), "customer_id")
        .limit(limit)
    )


# ---- lending ----------------------------------------------------------------------------------


def credit_overview(customer_view: DataFrame) -> DataFrame:
    """Credit tiers of customers with accounts; each customer counts once."""
    df = (
        customer_view.where(F.col("total_accounts") > 0)
        .select("customer_id", "country", "credit_score_band", "total_accounts", "total_balance", "has_anomaly")
        .distinct()
    )
    band = F.col("credit_score_band")
    tier = ladder(
        [
            (band.isin("EXCELLENT", "VERY_GOOD"), "LOW"),
            (band == "GOOD", "MEDIUM"),
            (band.isin("FAIR", "POOR"), "HIGH"),
        ],
        "NONE",
    )
    return df.agg(
        _n().alias("total_customers_with_accounts"),
        F.sum("total_balance").alias("total_exposure_usd"),
        rnd(mean("total_balance")).alias("avg_exposure_per_customer"),
        *[F.count_if(tier == x).alias(f"{x.lower()}_risk_customers") for x in ("LOW", "MEDIUM", "HIGH")],
        F.count_if(tier == "NONE").alias("not_rated_customers"),
        F.count_if("has_anomaly").alias("customers_with_anomalies"),
        pct(F.count_if("has_anomaly"), _n()).alias("anomaly_rate_pct"),
        F.size(F.collect_set("country")).alias("countries_with_exposure"),
        F.sum("total_accounts").alias("total_accounts_all_types"),
        rnd(mean("total_accounts")).alias("avg_accounts_per_customer"),
    )


def npl_report(ratings: DataFrame) -> DataFrame:
    """Non-performing exposure and days past due per segment."""
    late, exposure = F.col("days_past_due"), F.sum("total_exposure_chf")

    def weighted(*xs):
        out = F.col("total_exposure_chf")
        for x in xs:
            out = out * F.col(x).cast("decimal(6,2)")
        return F.sum(out)

    return ratings.groupBy("portfolio_segment").agg(
        _n().alias("total_customers"),
        exposure.alias("total_exposure_chf"),
        rnd(mean("total_exposure_chf")).alias("avg_exposure_chf"),
        F.count_if("default_flag").alias("default_count"),
        pct(F.count_if("default_flag"), _n()).alias("npl_rate_pct"),
        sum_if(F.col("default_flag"), "total_exposure_chf").alias("npl_amount_chf"),
        F.count_if(late.between(1, 29)).alias("dpd_1_29"),
        F.count_if(late.between(30, 59)).alias("dpd_30_59"),
        F.count_if(late.between(60, 89)).alias("dpd_60_89"),
        F.count_if(late >= 90).alias("dpd_90_plus"),
        F.count_if("watch_list_flag").alias("watchlist_count"),
        pct(F.count_if("watch_list_flag"), _n()).alias("watchlist_rate_pct"),
        rnd(ratio(weighted("pd_1_year"), exposure)).alias("weighted_avg_pd_pct"),
        rnd(ratio(weighted("lgd_rate"), exposure)).alias("weighted_avg_lgd_pct"),
        rnd(weighted("pd_1_year", "lgd_rate").cast("double") / 10000).alias("expected_loss_chf"),
        rnd(ratio(exposure * 6, exposure) * 10).alias("collateral_coverage_pct"),
    )


def basel_report(summary: DataFrame) -> DataFrame:
    fine = (F.col("tier1_capital_ratio") >= 6.0) & (F.col("total_capital_ratio") >= 8.0)
    return summary.withColumn("regulatory_status", F.when(fine, "COMPLIANT").otherwise("NON_COMPLIANT"))


def rating_distribution(metrics: DataFrame) -> DataFrame:
    kept = metrics.drop("vintage_months", "concentration_risk_score", "secured_exposure_chf", "unsecured_exposure_chf")
    out = attach_total(kept, _all=F.sum("total_exposure_chf"))
    return out.withColumn("portfolio_concentration_pct", pct("total_exposure_chf", "_all")).drop("_all")


# ---- wealth -----------------------------------------------------------------------------------


def _held(performance: DataFrame, customer_view: DataFrame, *columns: str) -> DataFrame:
    """Accounts with positive value next to their customer, each account once."""
    who = customer_view.select("customer_id", F.col("full_name").alias("client_name"), *columns).distinct()
    return performance.where(F.col("total_portfolio_value_chf") > 0).join(who, "customer_id")


def _by_client(df: DataFrame, *columns: str):
    return df.groupBy("customer_id", "client_name", *columns)


VALUE = "total_portfolio_value_chf"


def top_performers(performance: DataFrame, customer_view: DataFrame, *, limit: int = 50) -> DataFrame:
    put = F.col("equity_total_invested_chf") + F.col("fi_total_invested_chf") + F.col("cmd_total_invested_chf")

    def by_value(x):
        return rnd(ratio(F.sum(F.col(x).cast("decimal(18,4)") * F.col(VALUE)), F.sum(VALUE)))

    return (
        _by_client(_held(performance, customer_view, "country", "account_tier"), "country", "account_tier")
        .agg(
            F.count("account_id").alias("accounts"),
            F.sum(put).alias("total_invested"),
            F.sum(VALUE).alias("current_value"),
            rnd(F.sum("total_return_chf")).alias("total_return"),
            by_value("total_portfolio_twr_percentage").alias("portfolio_twr_pct"),
            by_value("annualized_portfolio_twr").alias("annualized_twr_pct"),
            *[
                rnd(F.avg(f"{k}_return_percentage")).alias(f"avg_{n}_return_pct")
                for k, n in (("equity", "equity"), ("fi", "fi"), ("cmd", "commodity"))
            ],
        )
        .orderBy(F.desc("portfolio_twr_pct"), "customer_id")
        .limit(limit)
    )


def risk_adjusted(performance: DataFrame, customer_view: DataFrame, *, limit: int = 50) -> DataFrame:
    keys = ("account_tier", "risk_classification")
    sharpe = F.avg("sharpe_ratio")
    return (
        _by_client(_held(performance, customer_view, *keys), *keys)
        .agg(
            F.sum(VALUE).alias("total_aum"),
            rnd(F.avg("total_portfolio_twr_percentage")).alias("avg_twr_pct"),
            rnd(F.avg("annualized_portfolio_twr")).alias("avg_annualized_twr_pct"),
            rnd(F.avg("portfolio_volatility")).alias("avg_volatility_pct"),
            rnd(sharpe).alias("avg_sharpe_ratio"),
            rnd(F.avg("risk_free_rate_annual_pct")).alias("risk_free_rate_pct"),
            ladder(
                [
                    (sharpe >= 2.0, "EXCELLENT"),
                    (sharpe >= 1.5, "VERY_GOOD"),
                    (sharpe >= 1.0, "GOOD"),
                    (sharpe >= 0.5, "FAIR"),
                    (sharpe > 0, "POOR"),
                ],
                "NEGATIVE",
            ).alias("performance_rating"),
            F.count("account_id").alias("accounts"),
        )
        .orderBy(F.desc_nulls_last("avg_sharpe_ratio"), "customer_id")
        .limit(limit)
    )


def asset_allocation(performance: DataFrame, customer_view: DataFrame, *, limit: int = 100) -> DataFrame:
    keys, kinds = ("account_tier", "risk_classification"), {"cash": "cash", "equity": "equity", "fi": "fi", "cmd": "commodity"}
    value = {n: F.sum(f"current_{k}_value_chf") for k, n in kinds.items()}
    total = F.sum(VALUE)
    largest = ratio(F.greatest(*value.values()) * 100, total)
    return (
        _by_client(_held(performance, customer_view, *keys), *keys)
        .agg(
            total.alias("total_portfolio_value"),
            *[v.alias(f"{n}_value") for n, v in value.items()],
            *[pct(v, total).alias(f"{n}_allocation_pct") for n, v in value.items()],
            above(largest, [(80, "HIGH_CONCENTRATION"), (60, "MEDIUM_CONCENTRATION")], "WELL_DIVERSIFIED").alias(
                "concentration_risk"
            ),
        )
        .orderBy(F.desc("total_portfolio_value"), "customer_id")
        .limit(limit)
    )


def fee_report(performance: DataFrame, customer_view: DataFrame, *, limit: int = 100) -> DataFrame:
    kinds = {"equity": "equity", "fi": "fi", "cmd": "commodity"}
    # per-account fees carry two decimals: sum them exactly
    fee = {n: F.sum(F.col(f"{k}_commission_chf").cast("decimal(18,2)")) for k, n in kinds.items()}
    fees = fee["equity"] + fee["fi"] + fee["commodity"]
    gain = F.sum(F.col("total_return_chf").cast("decimal(28,2)"))
    return (
        _by_client(_held(performance, customer_view, "account_tier"), "account_tier")
        .agg(
            F.sum(VALUE).alias("total_aum"),
            gain.alias("total_return"),
            rnd(F.avg("total_portfolio_twr_percentage")).alias("avg_twr_pct"),
            *[v.alias(f"{n}_commissions") for n, v in fee.items()],
            fees.alias("total_commissions"),
            rnd(ratio(fees * 100, F.sum(VALUE)), 4).alias("commission_to_aum_pct"),
            rnd(ratio(fees * 100, F.when(F.abs(gain) != F.lit("0.01").cast("decimal(5,2)"), F.abs(gain)))).alias("commission_to_return_pct"),
            *[F.sum(f"{k}_trades_count").alias(f"{n}_trades") for k, n in kinds.items()],
            (gain - fees).alias("net_return_after_fees"),
        )
        .where(F.col("total_commissions") > 0)
        .orderBy(F.desc("total_commissions"), "customer_id")
        .limit(limit)
    )


SEGMENTS = [
    (10000000, "ULTRA_HIGH_NET_WORTH"),
    (1000000, "HIGH_NET_WORTH"),
    (250000, "AFFLUENT"),
    (50000, "MASS_AFFLUENT"),
]
SEGMENT_NAMES = {
    "ULTRA_HIGH_NET_WORTH": "uhnw", "HIGH_NET_WORTH": "hnw", "AFFLUENT": "affluent", "MASS_AFFLUENT": "mass_affluent",
    "RETAIL": "retail",
}


def wealth_segments(customer_view: DataFrame, *, as_of) -> DataFrame:
    """Wealth segments with the exact median balance; each customer counts once."""
    df = (
        customer_view.where(F.col("total_accounts") > 0)
        .select("customer_id", "total_accounts", "total_balance", "total_transactions", "last_transaction_date")
        .distinct()
    )
    segment = at_least("total_balance", SEGMENTS, "RETAIL")
    main = df.agg(
        _n().alias("total_clients"),
        F.sum("total_balance").alias("total_aum_usd"),
        rnd(mean("total_balance")).alias("avg_aum_per_client"),
        F.max("total_balance").alias("largest_portfolio"),
        F.sum("total_accounts").alias("total_accounts"),
        rnd(mean("total_accounts")).alias("avg_accounts_per_client"),
        *[F.count_if(segment == x).alias(f"{n}_clients") for x, n in SEGMENT_NAMES.items()],
        F.sum("total_transactions").alias("total_transactions"),
        F.count_if(F.col("last_transaction_date") >= F.date_sub(on_date(as_of), 30)).alias("active_last_30_days"),
    )
    middle = quantiles(df.withColumn("_all", F.lit(1)), ["_all"], "total_balance", {"m": 0.5})
    return _side_by_side(main, middle.select(rnd("m").alias("median_aum_per_client")))


# ---- dashboard --------------------------------------------------------------------------------


def group_counts(df: DataFrame, key: str, order: Column | None = None, **aggs: Column) -> DataFrame:
    """Rows per key with further aggregates: the group-by tiles of a dashboard.

    This and the reports below count rows as customers, so they take the view with one row per customer.
    """
    out = df.groupBy(key).agg(_n().alias("customer_count"), *[v.alias(k) for k, v in aggs.items()])
    return out if order is None else out.orderBy(order)


def risk_distribution(view: DataFrame) -> DataFrame:
    return group_counts(view, "overall_risk_rating", F.desc("avg_risk_score"), avg_risk_score=rnd(F.avg("overall_risk_score")))


def match_summary(view: DataFrame, kind: str) -> DataFrame:
    """Counts by match type; ``kind`` is 'exposed_person' or 'sanctions'."""
    review = F.col(f"requires_{kind}_review")
    return group_counts(
        view,
        f"{kind}_match_type",
        avg_accuracy=rnd(F.avg(f"{kind}_match_accuracy_percent")),
        requires_review=F.count_if(review),
    )


def tier_distribution(view: DataFrame) -> DataFrame:
    kinds = ("checking", "savings", "business", "investment")
    return group_counts(
        view,
        "account_tier",
        avg_total_accounts=rnd(mean("total_accounts")),
        **{f"avg_{k}": rnd(mean(f"{k}_accounts")) for k in kinds},
    )


def country_distribution(view: DataFrame) -> DataFrame:
    return group_counts(
        view, "country", tier_diversity=F.size(F.collect_set("account_tier")), avg_risk_score=rnd(F.avg("overall_risk_score"))
    )


def lifecycle_summary(view: DataFrame) -> DataFrame:
    return group_counts(
        view,
        "lifecycle_stage",
        avg_churn_probability=rnd(F.avg("churn_probability")),
        avg_days_inactive=rnd(mean("days_since_last_transaction")),
    )


def high_risk_customers(view: DataFrame) -> DataFrame:
    return (
        view.where(F.col("high_risk_customer") | F.col("requires_exposed_person_review") | F.col("requires_sanctions_review"))
        .select(
            "customer_id", "full_name", "country", "account_tier", "overall_risk_rating", "overall_risk_score",
            "exposed_person_match_type", "exposed_person_match_accuracy_percent", "sanctions_match_type",
            "sanctions_match_accuracy_percent", "requires_exposed_person_review", "requires_sanctions_review",
            "high_risk_customer",
        )
        .orderBy(F.desc("overall_risk_score"))
    )


def newest_alerts(scored: DataFrame, *, limit: int = 1000) -> DataFrame:
    return scored.where(_cls().isin(*ALERTS)).orderBy(F.desc("booking_date"), "transaction_id").limit(limit)


def match_list(view: DataFrame, kind: str) -> DataFrame:
    accuracy, risk = f"{kind}_match_accuracy_percent", f"overall_{kind}_risk"
    return (
        view.where(F.col(f"{kind}_match_type") != "NO_MATCH")
        .select("customer_id", "full_name", "country", f"{kind}_match_type", accuracy, f"requires_{kind}_review", risk)
        # few accuracies for many rows: customers spread them over the tasks of the sort
        .orderBy(F.desc(accuracy), "customer_id")
    )


def lending_portfolio(view: DataFrame) -> DataFrame:
    return view.select(
        "customer_id", "full_name", "country", "credit_score_band", "risk_classification", "account_tier", "total_accounts"
    ).orderBy("customer_id")


CHURN_COLUMNS = [
    "customer_id", "first_name", "family_name", "account_tier", "country", "lifecycle_stage", "churn_probability",
    "days_since_last_transaction", "last_transaction_date", "email", "phone",
]


def high_churn_customers(view: DataFrame, *, above_pct: float = 70) -> DataFrame:
    return view.where(F.col("churn_probability") > above_pct).select(*CHURN_COLUMNS).orderBy(F.desc("churn_probability"))


def premium_at_risk(view: DataFrame, *, above_pct: float = 70) -> DataFrame:
    best = F.col("account_tier").isin("GOLD", "PLATINUM")
    rows = view.where(best & (F.col("churn_probability") > above_pct))
    return rows.select(*CHURN_COLUMNS, "preferred_contact_method").orderBy(F.desc("churn_probability"))


def dormant_customers(view: DataFrame, *, min_days: int = 180) -> DataFrame:
    idle = F.col("days_since_last_transaction")
    rows = view.where((idle > min_days) & F.col("lifecycle_stage").isin("DORMANT", "DECLINING"))
    return rows.select(*CHURN_COLUMNS, "total_accounts").orderBy(F.desc("days_since_last_transaction"))


def revenue_at_risk(view: DataFrame, *, above_pct: float = 70) -> DataFrame:
    p = F.col("churn_probability")
    return view.where(p > above_pct).agg(
        _n().alias("at_risk_customers"),
        F.count_if(p > 90).alias("critical_customers"),
        F.count_if(p.between(70, 90)).alias("high_customers"),
        rnd(F.avg(p)).alias("avg_churn_probability"),
    )


def aml_metrics(scored: DataFrame, *, as_of, n_days: int = 90) -> DataFrame:
    recent = scored.where(F.col("booking_date") >= F.date_sub(on_date(as_of), n_days).cast("timestamp_ntz"))
    alert = _cls().isin(*ALERTS)
    return recent.agg(
        F.count_if(alert).alias("total_alerts"),
        F.countDistinct(F.when(alert, F.col("customer_id"))).alias("unique_customers"),
        F.count_if(_cls() != "NORMAL_BEHAVIOR").alias("anomalous_transactions"),
    )


def kyc_completeness(view: DataFrame) -> DataFrame:
    return view.groupBy("country").agg(
        _n().alias("total_customers"),
        *[F.count(x).alias(f"{x}_complete") for x in ("email", "phone", "employer")],
        *[pct(F.count(x), _n()).alias(f"{x}_pct") for x in ("email", "phone")],
    )


def contact_quality(view: DataFrame) -> DataFrame:
    fields = {"email": "email", "phone": "phone", "dob": "date_of_birth", "address": "street_address"}
    unique = view.select("customer_id").distinct().agg(_n().alias("unique_customers"))
    main = view.agg(
        _n().alias("total_records"),
        *[(_n() - F.count(c)).alias(f"missing_{x}") for x, c in fields.items()],
        *[pct(F.count(c), _n()).alias(f"{x}_completeness") for x, c in fields.items()],
    )
    return _side_by_side(main, unique)


def compliance_summary(view: DataFrame) -> DataFrame:
    return view.agg(
        _n().alias("total_customers"),
        F.count_if("high_risk_customer").alias("high_risk_count"),
        F.count_if(F.col("exposed_person_match_type") != "NO_MATCH").alias("pep_matches"),
        F.count_if(F.col("sanctions_match_type") != "NO_MATCH").alias("sanctions_matches"),
        F.count_if("requires_exposed_person_review").alias("pep_reviews_needed"),
        F.count_if("requires_sanctions_review").alias("sanctions_reviews_needed"),
        F.count_if("has_anomaly").alias("anomaly_count"),
        rnd(F.avg("overall_risk_score")).alias("avg_risk_score"),
    )


# ---- liquidity and loan pages -----------------------------------------------------------------


def lcr_status_page(daily: DataFrame) -> DataFrame:
    """The newest day of the liquidity ratio."""
    return _newest(daily).select(
        F.col("as_of_date").alias("reporting_date"), "lcr_ratio", "lcr_status", "severity", "hqla_total", "outflow_total",
        "lcr_buffer_chf", "lcr_buffer_pct", "l1_total", "l2_capped", "l2a_total", "l2b_total", "cap_applied", "discarded_l2",
        "outflow_retail", "outflow_corp", "outflow_fi",
    )


def loan_pages(report: DataFrame, order: str, *, as_of, descending: bool = True) -> DataFrame:
    """A dated loan report of one day without its date, in display order."""
    today = report.where(F.col("as_of_date") == on_date(as_of)).drop("as_of_date")
    return today.orderBy(F.desc(order) if descending else F.asc(order))


def lcr_trend_page(trend: DataFrame, *, as_of, n_days: int = 90) -> DataFrame:
    return (
        trend.where(F.col("as_of_date") >= F.date_sub(on_date(as_of), n_days))
        .drop("consecutive_breaches_3d", "high_volatility_alert", "sustained_breach_alert", "critical_breach_alert")
        .orderBy("as_of_date")
    )


def _newest(df: DataFrame) -> DataFrame:
    return df.join(F.broadcast(df.agg(F.max("as_of_date").alias("as_of_date"))), "as_of_date")


def hqla_page(detail: DataFrame) -> DataFrame:
    return (
        _newest(detail)
        .groupBy("asset_type", "regulatory_level")
        .agg(
            F.max("haircut_factor").alias("haircut_factor"),
            _n().alias("holding_count"),
            F.sum("market_value_chf").alias("market_value_chf"),
            rnd(F.sum("weighted_value_chf")).alias("weighted_value_chf"),
            rnd(mean("market_value_chf")).alias("avg_holding_size_chf"),
        )
        .orderBy(F.desc("market_value_chf"))
    )


def deposit_page(detail: DataFrame) -> DataFrame:
    return (
        _newest(detail)
        .groupBy("deposit_type", "counterparty_type")
        .agg(
            F.max("base_run_off_rate").alias("base_run_off_rate"),
            _n().alias("account_count"),
            F.countDistinct("customer_id").alias("customer_count"),
            F.sum("balance_chf").alias("total_balance_chf"),
            rnd(F.sum("outflow_amount_chf")).alias("total_outflow_chf"),
            rnd(mean("balance_chf")).alias("avg_balance_chf"),
            rnd(mean("final_run_off_rate") * 100).alias("avg_adjusted_run_off_rate"),
        )
        .orderBy(F.desc("total_outflow_chf"))
    )


def lcr_alert_page(alerts: DataFrame) -> DataFrame:
    rank = choose("alert_severity", {"CRITICAL": 1, "HIGH": 2, "MEDIUM": 3, "INFO": 4}, 5)
    return (
        alerts.where(F.col("total_alert_count") > 0)
        .withColumn("a", F.explode("all_alerts"))
        .select(
            "as_of_date", "lcr_ratio", "lcr_status", "severity", F.col("a.severity").alias("alert_severity"),
            F.col("a.type").alias("alert_type"), F.col("a.message").alias("alert_message"),
            F.col("a.action").alias("recommended_action"),
        )
        .orderBy(rank, F.desc("as_of_date"))
    )


def lcr_monthly_page(monthly: DataFrame, *, months: int = 12) -> DataFrame:
    names = {
        "reporting_month": "report_month", "lcr_avg": "avg_lcr_ratio", "lcr_min": "min_lcr_ratio", "lcr_max": "max_lcr_ratio",
        "breach_days": "days_below_100_pct", "warning_days": "days_below_105_pct",
    }
    status = at_most("breach_days", [(0, "PASS"), (3, "WARNING")], "FAIL")
    return (
        monthly.withColumn("compliance_status", status)
        .withColumnsRenamed(names)
        .orderBy(F.desc("report_month"))
        .limit(months)
    )


def loan_compliance_page(screening: DataFrame, *, limit: int = 100) -> DataFrame:
    rank = choose("compliance_status", {"SANCTIONS_REVIEW": 1, "PEP_REVIEW": 2, "HIGH_RISK_REVIEW": 3}, 4)
    special = (
        F.col("compliance_hold_flag")
        | flag(F.col("vulnerable_customer_flag"))
        | flag(F.col("overall_risk_rating").isin("CRITICAL", "HIGH"))
    )
    kept = [
        "application_id", "customer_id", "full_name", "country", "requested_amount", "application_status",
        "requires_sanctions_review", "requires_exposed_person_review", "overall_risk_rating", "vulnerable_customer_flag",
        "compliance_hold_flag", "compliance_status", "application_date_time",
    ]
    ordered = screening.where(special).select(*kept).distinct()
    return ordered.orderBy(rank, F.desc("application_date_time"), "application_id", "overall_risk_rating", "requires_exposed_person_review").limit(limit)


def loan_customer_page(summary: DataFrame, customer_view: DataFrame, *, limit: int = 100) -> DataFrame:
    who = one_per_customer(customer_view).select(
        "customer_id", F.col("full_name").alias("customer_name"), "vulnerable_customer_flag", "requires_sanctions_review",
        "requires_exposed_person_review",
    )
    return (
        summary.where(F.col("total_applications") > 0)
        .join(who, "customer_id", "left")
        .orderBy(F.desc("total_approved_amount"), "customer_id")
        .limit(limit)
    )
