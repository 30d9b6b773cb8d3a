"""Credit ratings, market-risk capital, aggregated risk, limits and concentration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import (
    above, attach_total, below, c, choose, dbl, flag, ladder, mean, months_crossed, on_date, pct, ratio, rnd, sum_if, zero,
)

# fixed values: rating, PD one year, PD lifetime, risk weight, by tagged share of payments above a cut
RATING_SCALE = [
    (20, "B", 8.0, 15.0, 120.0, 60),
    (10, "BB", 4.0, 8.0, 100.0, 30),
    (5, "BBB", 2.0, 4.0, 75.0, 0),
    (2, "A", 1.0, 2.0, 50.0, 0),
    (0, "AA", 0.5, 1.0, 35.0, 0),
]
WITH_ANOMALY = ("CCC", 15.0, 25.0, 150.0, 120)
BEST = ("AAA", 0.1, 0.3, 20.0, 0)
RATING_RANK = {"AAA": 7, "AA": 6, "A": 5, "BBB": 4, "BB": 3, "B": 2, "CCC": 1}


def irb_customer_ratings(customer_view: DataFrame, anomaly: DataFrame, balances: DataFrame, *, as_of) -> DataFrame:
    """One rating per customer; account balances are summed per customer before the join."""
    people = customer_view.select("customer_id", "full_name", "has_anomaly", "onboarding_date").distinct()
    share = anomaly.select("customer_id", F.col("anomaly_percentage").alias("_share"))
    held = balances.groupBy("customer_id").agg(F.sum("current_balance_base").alias("_held"))
    df = people.join(share, "customer_id", "left").join(held, "customer_id", "left")
    odd, exposure, tagged = flag(F.col("has_anomaly")), zero("_held"), F.col("_share")

    def scale(i: int) -> Column:
        rules = [(odd, WITH_ANOMALY[i])] + [(tagged > row[0], row[i + 1]) for row in RATING_SCALE]
        return ladder(rules, BEST[i])

    return df.select(
        "customer_id",
        "full_name",
        "onboarding_date",
        scale(0).alias("credit_rating"),
        scale(1).alias("pd_1_year"),
        scale(2).alias("pd_lifetime"),
        F.lit(45.0).alias("lgd_rate"),
        exposure.alias("ead_amount"),
        scale(3).alias("risk_weight"),
        on_date(as_of).alias("rating_date"),
        F.lit("FOUNDATION_IRB").alias("rating_methodology"),
        F.lit("RETAIL").alias("portfolio_segment"),
        scale(4).alias("days_past_due"),
        (odd | flag(tagged > 20)).alias("default_flag"),
        flag(tagged > 5).alias("watch_list_flag"),
        exposure.alias("total_exposure_chf"),
        rnd(dbl(exposure * 6) / 10).alias("secured_exposure_chf"),
        rnd(dbl(exposure * 4) / 10).alias("unsecured_exposure_chf"),
    )


def _weighted(*weights) -> Column:
    """Exposure times percentages, in exact decimals until the end."""
    out = F.col("total_exposure_chf")
    for w in weights:
        out = out * c(w).cast("decimal(6,2)")
    return F.sum(out)


def _percent_of_exposure(*weights) -> Column:
    return dbl(_weighted(*weights)) / float(100 ** len(weights))


def irb_portfolio_metrics(ratings: DataFrame, *, as_of) -> DataFrame:
    exposure, n = F.sum("total_exposure_chf"), F.count(F.lit(1))
    largest = F.max("total_exposure_chf")
    rwa = _percent_of_exposure("risk_weight")
    months = months_crossed("onboarding_date", on_date(as_of))
    return ratings.groupBy("portfolio_segment", "credit_rating").agg(
        n.alias("customer_count"),
        exposure.alias("total_exposure_chf"),
        rnd(mean("total_exposure_chf")).alias("average_exposure_chf"),
        rnd(ratio(_weighted("pd_1_year"), exposure)).alias("weighted_avg_pd"),
        rnd(ratio(_weighted("lgd_rate"), exposure)).alias("weighted_avg_lgd"),
        rnd(_percent_of_exposure("pd_1_year", "lgd_rate")).alias("expected_loss_chf"),
        rnd(rwa).alias("risk_weighted_assets_chf"),
        rnd(dbl(_weighted("risk_weight") * 8) / 10000.0).alias("capital_requirement_chf"),
        F.count_if("default_flag").alias("default_count"),
        pct(F.count_if("default_flag"), n).alias("default_rate"),
        F.count_if("watch_list_flag").alias("watch_list_count"),
        pct(F.count_if("watch_list_flag"), n).alias("watch_list_rate"),
        rnd(dbl(exposure * 6) / 10).alias("secured_exposure_chf"),
        rnd(dbl(exposure * 4) / 10).alias("unsecured_exposure_chf"),
        rnd(ratio(exposure * 6, exposure) * 10).alias("collateral_coverage_ratio"),
        rnd(mean(months)).alias("vintage_months"),
        ladder(
            [(largest * 100 > exposure * cut, points) for cut, points in ((30, 9), (20, 7), (10, 5), (5, 3))], 1
        ).alias("concentration_risk_score"),
    )


def rating_history(ratings: DataFrame) -> DataFrame:
    """Dated snapshot of the ratings, to be appended day by day."""
    return ratings.select(
        "customer_id", F.col("rating_date").alias("effective_date"), "credit_rating", "pd_1_year", "pd_lifetime",
        "lgd_rate", "risk_weight", "default_flag", "watch_list_flag", "total_exposure_chf", "days_past_due", "rating_date",
    )


def irb_rwa_summary(metrics: DataFrame, *, as_of) -> DataFrame:
    segment = F.col("portfolio_segment")
    exposure, rwa = F.sum("total_exposure_chf"), F.sum("risk_weighted_assets_chf")
    names = ("retail", "corporate", "sme")
    return metrics.agg(
        exposure.alias("total_exposure_chf"),
        rnd(rwa).alias("total_rwa_chf"),
        rnd(F.sum("capital_requirement_chf")).alias("total_capital_requirement_chf"),
        rnd(F.sum("expected_loss_chf")).alias("total_expected_loss_chf"),
        pct(rwa, exposure).alias("average_risk_weight"),
        F.sum("default_count").alias("default_customers"),
        F.sum("customer_count").alias("total_customers"),
        pct(F.sum("default_count"), F.sum("customer_count")).alias("portfolio_default_rate"),
        *[sum_if(segment == x.upper(), "total_exposure_chf").alias(f"{x}_exposure_chf") for x in names],
        *[rnd(sum_if(segment == x.upper(), "risk_weighted_assets_chf")).alias(f"{x}_rwa_chf") for x in names],
    ).withColumns(
        {
            "calculation_date": on_date(as_of),
            "tier1_capital_ratio": F.lit(15.2),
            "total_capital_ratio": F.lit(18.5),
            "leverage_ratio": F.lit(5.8),
        }
    )


def irb_risk_trends(ratings: DataFrame, history: DataFrame, *, as_of) -> DataFrame:
    """Portfolio averages and movements against the snapshot of the day before."""
    before = history.where(F.col("effective_date") == F.date_sub(on_date(as_of), 1)).select(
        "customer_id", F.col("default_flag").alias("_was"), choose("credit_rating", RATING_RANK).alias("_rank_was")
    )
    rank, n = choose("credit_rating", RATING_RANK), F.count(F.lit(1))
    bad, was = F.col("default_flag"), flag(F.col("_was"))
    pd, rate = F.avg("pd_1_year"), F.count_if(bad) * 100.0 / n
    fresh, cured = F.count_if(bad & ~was), F.count_if(~bad & was)
    return (
        ratings.join(before, "customer_id", "left")
        .groupBy("portfolio_segment")
        .agg(
            *[
                rnd(F.avg(x)).alias(f"avg_{x}")
                for x in ("pd_1_year", "pd_lifetime", "lgd_rate", "risk_weight")
            ],
            F.sum("total_exposure_chf").alias("total_exposure_chf"),
            rnd(_percent_of_exposure("risk_weight")).alias("total_rwa_chf"),
            rnd(_percent_of_exposure("pd_1_year", "lgd_rate")).alias("expected_loss_chf"),
            rnd(rate).alias("default_rate"),
            fresh.alias("new_defaults"),
            cured.alias("cured_defaults"),
            (fresh - cured).alias("net_default_change"),
            F.count_if(rank > F.col("_rank_was")).alias("rating_migrations_up"),
            F.count_if(rank < F.col("_rank_was")).alias("rating_migrations_down"),
            ladder([(rnd(pd, 6).between(0.5, 2.0), 9), (rnd(pd, 6).between(0.1, 5.0), 7)], 5).alias("model_performance_score"),
            ladder([(rate.between(0.5, 3.0), 92.5), (rate.between(0.1, 5.0), 87.2)], 78.5).alias("backtesting_accuracy"),
        )
        .withColumns({"trend_date": on_date(as_of), "stress_test_multiplier": F.lit(1.0)})
    )


# ---- market risk -------------------------------------------------------------------------------

# fixed values: risk weight in percent by class, with the buckets that differ
CLASS_WEIGHTS = {"EQUITY": 25.0, "FX": 15.0, "INTEREST_RATE": 3.0, "COMMODITY": 35.0, "CREDIT_SPREAD": 6.0}
BUCKET_WEIGHTS = {
    "IR_SOVEREIGN": 1.5, "COMM_ENERGY": 30.0, "COMM_PRECIOUS": 20.0, "COMM_BASE": 25.0, "CS_IG_HIGH": 2.0, "CS_IG_LOW": 3.5,
}
TOP, HIGH, INVESTMENT = ("AAA", "AA"), ("AAA", "AA", "A"), ("AAA", "AA", "A", "BBB")


def _position(risk_class, bucket, kind, name, currency, value, delta, liquidity, modellable) -> Column:
    return F.struct(
        F.lit(risk_class).alias("risk_class"),
        bucket.alias("risk_bucket"),
        "customer_id",
        "account_id",
        kind.alias("instrument_type"),
        c(name).alias("instrument_name"),
        currency.alias("currency"),
        c(value).cast("decimal(28,2)").alias("position_value_chf"),
        c(delta).cast("decimal(28,4)").alias("delta_chf"),
        F.lit(None).cast("decimal(28,4)").alias("vega_chf"),
        liquidity.alias("liquidity_score"),
        (~modellable).alias("is_nmrf"),
    )


def _open(positions: DataFrame, *layouts: Column) -> DataFrame:
    """Open positions in the given layouts, from one pass; a layout that is null gives no row."""
    found = positions.where(F.col("position_status") != "CLOSED")
    if len(layouts) == 1:
        return found.select(layouts[0].alias("_p")).select("_p.*")
    return found.select(F.explode(F.filter(F.array(*layouts), lambda x: x.isNotNull())).alias("_p")).select("_p.*")


def frtb_risk_positions(eq_pos: DataFrame, fi_pos: DataFrame, cmd_pos: DataFrame, base_ccy: str = "CHF") -> DataFrame:
    """Open positions of all classes in one layout."""
    issuer, rating, kind = F.col("issuer_type"), F.col("credit_rating"), F.col("commodity_type")
    firm = issuer == "CORPORATE"
    equity = _position(
        "EQUITY", F.lit("EQUITY_LARGE_CAP"), F.lit("EQUITY"), "symbol", F.lit(base_ccy), "net_investment_chf",
        "net_investment_chf", F.lit(8.0), F.lit(True),
    )
    rates = _position(
        "INTEREST_RATE", choose(issuer, {"SOVEREIGN": "IR_SOVEREIGN", "CORPORATE": "IR_CORPORATE"}, "IR_OTHER"),
        F.col("instrument_type"), "issuer", F.col("currency"), "total_investment_chf", "total_dv01_chf",
        ladder([(issuer == "SOVEREIGN", 9.0), (rating.isin(*TOP), 7.0)], 5.0), ~(firm & ~rating.isin(*HIGH)),
    )
    spreads = _position(
        "CREDIT_SPREAD",
        ladder([(rating.isin(*TOP), "CS_IG_HIGH"), (rating.isin("A", "BBB"), "CS_IG_LOW")], "CS_HY"),
        F.col("instrument_type"), "issuer", F.col("currency"), "total_investment_chf",
        F.col("total_investment_chf") * F.lit("0.01").cast("decimal(3,2)"),
        ladder([(rating.isin(*HIGH), 7.0)], 4.0), rating.isin(*INVESTMENT),
    )
    buckets = {"ENERGY": "COMM_ENERGY", "PRECIOUS_METAL": "COMM_PRECIOUS", "BASE_METAL": "COMM_BASE", "AGRICULTURAL": "COMM_AGRI"}
    goods = _position(
        "COMMODITY", choose(kind, buckets, "COMM_OTHER"), kind, "commodity_name", F.lit(base_ccy),
        "total_investment_chf", "total_delta_chf",
        ladder([(kind.isin("ENERGY", "PRECIOUS_METAL"), 7.0), (kind == "BASE_METAL", 6.0)], 4.0), kind != "AGRICULTURAL",
    )
    spread = F.when(firm & (F.col("instrument_type") == "BOND"), spreads)
    return _open(eq_pos, equity).unionByName(_open(fi_pos, rates, spread)).unionByName(_open(cmd_pos, goods))


def frtb_sensitivities(positions: DataFrame) -> DataFrame:
    delta, vega = F.col("delta_chf"), zero("vega_chf")
    return positions.groupBy("risk_class", "risk_bucket").agg(
        F.count(F.lit(1)).alias("total_positions"),
        F.count_if(delta > 0).alias("long_positions"),
        F.count_if(delta < 0).alias("short_positions"),
        F.sum(F.abs(delta)).alias("gross_delta_chf"),
        F.sum(delta).alias("net_delta_chf"),
        F.sum(F.abs(vega)).alias("gross_vega_chf"),
        F.sum(vega).alias("net_vega_chf"),
        F.max(F.abs("position_value_chf")).alias("largest_position_chf"),
        F.count_if("is_nmrf").alias("nmrf_positions"),
    )


def risk_weight(risk_class="risk_class", bucket="risk_bucket") -> Column:
    return F.coalesce(choose(bucket, BUCKET_WEIGHTS), choose(risk_class, CLASS_WEIGHTS, 10.0))


def frtb_capital_charges(sensitivities: DataFrame) -> DataFrame:
    gross, vega, weight = dbl("gross_delta_chf"), dbl("gross_vega_chf"), risk_weight()
    delta = gross * weight / 100
    addon = F.when(F.col("nmrf_positions") > 0, gross * 50 / 100).otherwise(0.0)
    return sensitivities.select(
        "risk_class",
        "risk_bucket",
        "gross_delta_chf",
        "net_delta_chf",
        weight.alias("risk_weight"),
        rnd(delta).alias("delta_capital_charge_chf"),
        rnd(vega * 10 / 100).alias("vega_capital_charge_chf"),
        rnd(gross * 5 / 100).alias("curvature_capital_charge_chf"),
        rnd(addon).alias("nmrf_add_on_chf"),
        rnd(delta + vega * 10 / 100 + gross * 5 / 100 + addon).alias("total_capital_charge_chf"),
    )


def frtb_nmrf(positions: DataFrame) -> DataFrame:
    score = F.col("liquidity_score")
    return positions.where("is_nmrf").select(
        "risk_class",
        "risk_bucket",
        "instrument_name",
        "customer_id",
        "position_value_chf",
        "delta_chf",
        "liquidity_score",
        ladder(
            [
                (score < 3, "HIGHLY_ILLIQUID"),
                (score < 5, "ILLIQUID"),
                ((F.col("risk_class") == "CREDIT_SPREAD") & (F.col("risk_bucket") == "CS_HY"), "HIGH_YIELD_CREDIT"),
                ((F.col("risk_class") == "COMMODITY") & (F.col("risk_bucket") == "COMM_AGRI"), "AGRICULTURAL_COMMODITY"),
            ],
            "OTHER",
        ).alias("nmrf_reason"),
        rnd(dbl(F.abs("position_value_chf")) / 2).alias("capital_add_on_chf"),
    )


# ---- aggregated risk ---------------------------------------------------------------------------

# fixed values: average weight by market class, limit and its kind by risk type
MARKET_WEIGHTS = {"EQUITY": 25.0, "FX": 15.0, "INTEREST_RATE": 2.0, "COMMODITY": 30.0, "CREDIT_SPREAD": 5.0}
RISK_LIMITS = {
    "CREDIT": ("EXPOSURE_LIMIT", 1000000000),
    "MARKET": ("VAR_LIMIT", 500000000),
    "OPERATIONAL": ("LOSS_LIMIT", 100000000),
    "LIQUIDITY": ("CASH_FLOW_LIMIT", 2000000000),
}
DIMENSIONS = ["risk_type", "business_line", "geography", "currency", "customer_segment", "customer_id"]


def _tier(amount, low, high):
    return below(amount, [(low, "LOW_RISK"), (high, "MEDIUM_RISK")], "HIGH_RISK")


def _risk_rows(df, risk_type, line, geography, currency, segment, customer, amount, capital, weight) -> DataFrame:
    return df.select(
        F.lit(risk_type).alias("risk_type"),
        F.lit(line).alias("business_line"),
        F.lit(geography).alias("geography"),
        currency.alias("currency"),
        segment.alias("customer_segment"),
        customer.alias("customer_id"),
        amount.cast("decimal(28,2)").alias("exposure"),
        capital.cast("decimal(28,4)").alias("capital"),
        weight.cast("double").alias("weight"),
    )


def risk_aggregation(
    ratings: DataFrame, positions: DataFrame, anomaly: DataFrame, exposure_now: DataFrame, *, as_of, by: list[str] | None = None
) -> DataFrame:
    """Credit, market, operational and liquidity exposure in one grouped table."""

    def part(amount, percent):
        return amount * F.lit(percent).cast("decimal(5,2)") / 100

    owed, value = F.col("total_exposure_chf"), F.abs("position_value_chf")
    lost, flow = F.col("anomalous_amount"), F.col("total_chf_amount")
    rows = [
        _risk_rows(
            ratings, "CREDIT", "RETAIL", "EMEA", F.lit("CHF"), _tier("pd_1_year", 0.5, 2.0), F.col("customer_id"), owed,
            owed * F.col("risk_weight").cast("decimal(6,2)") / 100, F.col("risk_weight"),
        ),
        _risk_rows(
            positions, "MARKET", "TRADING", "GLOBAL", F.col("currency"), _tier(value, 1000000, 5000000),
            F.col("customer_id"), value, part(value, "8"), choose("risk_class", MARKET_WEIGHTS, 20.0),
        ),
        _risk_rows(
            anomaly.where("is_anomalous_customer"), "OPERATIONAL", "ALL", "GLOBAL", F.lit("CHF"), _tier(lost, 100000, 500000),
            F.col("customer_id"), lost, part(lost, "15"), F.lit(100),
        ),
        _risk_rows(
            exposure_now, "LIQUIDITY", "TREASURY", "GLOBAL", F.col("currency"), _tier(flow, 1000000, 10000000),
            F.concat(F.lit("LIQUIDITY_"), "currency"), F.abs(flow), part(F.abs(flow), "5"), F.lit(50),
        ),
    ]
    all_rows = rows[0]
    for more in rows[1:]:
        all_rows = all_rows.unionByName(more)
    keys = by or DIMENSIONS
    total, capital, largest = F.sum("exposure"), F.sum("capital"), F.max("exposure")
    people = F.lit(1).cast("bigint") if "customer_id" in keys else F.countDistinct("customer_id")
    return all_rows.groupBy(*keys).agg(
        total.alias("total_exposure_chf"),
        rnd(capital).alias("total_capital_requirement_chf"),
        rnd(F.avg("weight")).alias("avg_risk_weight"),
        F.max(people).alias("customer_count") if "customer_id" in keys else people.alias("customer_count"),
        largest.alias("max_single_exposure_chf"),
        rnd(F.stddev_samp(dbl("exposure"))).alias("exposure_volatility_chf"),
        rnd(ratio(largest, total) * 100).alias("max_concentration_percent"),
        rnd(ratio(capital, total) * 100).alias("capital_ratio_percent"),
        rnd(ratio(total, F.max(people) if "customer_id" in keys else people)).alias("avg_exposure_per_customer_chf"),
    ).withColumn("reporting_date", on_date(as_of))


def _ratio_status():
    return F.when(
        ratio(F.sum("total_capital_requirement_chf"), F.sum("total_exposure_chf")) >= 0.08, "COMPLIANT"
    ).otherwise("NON_COMPLIANT")


def executive_dashboard(agg: DataFrame) -> DataFrame:
    exposure, capital = F.sum("total_exposure_chf"), F.sum("total_capital_requirement_chf")
    kind = F.col("risk_type")
    share = rnd(ratio(capital, exposure) * 100)
    return agg.agg(
        exposure.alias("total_exposure_chf"),
        rnd(capital).alias("total_capital_requirement_chf"),
        share.alias("capital_ratio_percent"),
        rnd(F.avg("max_concentration_percent")).alias("concentration_risk_score"),
        *[sum_if(kind == x, "total_exposure_chf").alias(f"{x.lower()}_risk_exposure_chf") for x in RISK_LIMITS],
        F.sum("customer_count").alias("total_customer_count"),
        *[
            F.size(F.collect_set(col)).alias(name)  # domains of a handful of values
            for col, name in (
                ("geography", "geographic_diversification"),
                ("currency", "currency_diversification"),
                ("business_line", "business_line_diversification"),
            )
        ],
        rnd(F.avg("exposure_volatility_chf")).alias("risk_volatility_score"),
        _ratio_status().alias("basel_iii_compliance_status"),
        rnd(capital / 4, 0).alias("regulatory_capital_buffer_chf"),
        share.alias("capital_adequacy_ratio_percent"),
        rnd(ratio(exposure, F.lit(10000000000)) * 100).alias("risk_limit_utilization_percent"),
    ).withColumns({"risk_trend_30_days": F.lit("STABLE"), "risk_trend_90_days": F.lit("STABLE")})


def regulatory_reporting(agg: DataFrame, *, as_of, institution: str = "BANK", region: str = "EMEA") -> DataFrame:
    """Measured part of the regulatory report; governance scores that are not measured are left out."""
    exposure, capital = F.sum("total_exposure_chf"), F.sum("total_capital_requirement_chf")
    return agg.agg(
        F.count(F.lit(1)).alias("risk_data_points_count"),
        _ratio_status().alias("basel_iii_compliance_status"),
        exposure.alias("total_risk_exposure_chf"),
        rnd(capital).alias("total_capital_requirement_chf"),
        rnd(ratio(capital, exposure) * 100).alias("risk_coverage_percent"),
    ).withColumns(
        {
            "report_type": F.lit("BCBS239_RISK_REPORT"),
            "reporting_date": on_date(as_of),
            "institution_name": F.lit(institution),
            "region": F.lit(region),
            "risk_aggregation_frequency": F.lit("HOURLY"),
            "risk_reporting_frequency": F.lit("DAILY"),
            "regulatory_reporting_frequency": F.lit("DAILY"),
        }
    )


def risk_concentration(agg: DataFrame, *, floor: float = 0.02) -> DataFrame:
    """Groups above 2 % of the portfolio.

    Totals come from small grouped aggregates that are joined back, not from a window over
    everything.
    """
    rows = agg.where(F.col("customer_id").isNotNull())
    amount = F.sum("total_exposure_chf")
    df = attach_total(rows, _all=amount)
    for key in ("risk_type", "business_line"):
        # four fixed risk types, four fixed business lines: bounded by construction
        df = df.join(F.broadcast(rows.groupBy(key).agg(amount.alias(f"_{key}"))), key)
    exposure = F.col("total_exposure_chf")
    share = ratio(exposure, "_all")
    return df.where(share > floor).select(
        "customer_id",
        F.concat(F.lit("Customer_"), "customer_id").alias("customer_name"),
        "risk_type",
        "business_line",
        "geography",
        "currency",
        "total_exposure_chf",
        rnd(share * 100).alias("exposure_percent_of_portfolio"),
        rnd(ratio(exposure, "_risk_type") * 100).alias("exposure_percent_of_risk_type"),
        rnd(ratio(exposure, "_business_line") * 100).alias("exposure_percent_of_business_line"),
        above(share, [(0.05, "HIGH_CONCENTRATION"), (0.02, "MEDIUM_CONCENTRATION")], "LOW_CONCENTRATION").alias(
            "risk_concentration_flag"
        ),
        rnd(share * 100).alias("concentration_risk_score"),
        above(share, [(0.05, "CRITICAL"), (0.02, "HIGH"), (0.01, "MEDIUM")], "LOW").alias("concentration_risk_level"),
        F.col("avg_risk_weight").alias("risk_weight"),
        "customer_segment",
        F.lit("STABLE").alias("concentration_trend"),
        above(share, [(0.05, "ALERT"), (0.02, "WARNING")], "NORMAL").alias("alert_status"),
    )


def risk_limits(agg: DataFrame, *, as_of, limits: dict | None = None) -> DataFrame:
    table = limits or RISK_LIMITS
    today, used = on_date(as_of), F.col("current_exposure_chf")
    limit = choose("risk_type", {k: v[1] for k, v in table.items()}).cast("bigint")
    df = (
        agg.groupBy("risk_type", "business_line", "geography", "currency")
        .agg(F.sum("total_exposure_chf").alias("current_exposure_chf"))
        .withColumns({"risk_limit_chf": limit, "limit_type": choose("risk_type", {k: v[0] for k, v in table.items()})})
    )
    use = ratio(used, "risk_limit_chf")
    return df.withColumns(
        {
            "utilization_percent": rnd(use * 100),
            "remaining_limit_chf": F.col("risk_limit_chf") - used,
            "breach_flag": F.when(used > F.col("risk_limit_chf"), "BREACH").otherwise("WITHIN_LIMITS"),
            "alert_level": above(use, [(0.9, "CRITICAL"), (0.8, "HIGH"), (0.7, "MEDIUM")], "LOW"),
            "risk_status": above(use, [(1.0, "BREACH"), (0.9, "CRITICAL"), (0.8, "HIGH")], "NORMAL"),
            "limit_approved_by": F.lit("RISK_COMMITTEE"),
            "limit_effective_date": F.date_sub(today, 365),
            "limit_expiry_date": F.date_add(today, 365),
            "limit_review_frequency": F.lit("QUARTERLY"),
            "last_breach_date": F.lit(None).cast("date"),
            "breach_count_30_days": F.lit(0),
            "alert_count_30_days": F.when(use > 0.8, 1).otherwise(0),
            "last_limit_review_date": F.date_sub(today, 90),
            "next_review_date": F.date_add(today, 90),
        }
    )
