"""Accounts, exchange rates, payment behaviour, anomalies, balances and settlement reports."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import (
    above, as_date, at_least, c, choose, day_number, days, dbl, distinct_list, flag, is_tagged, is_weekend, ladder,
    mean, months_crossed, on_date, pct, ratio, rnd, sum_if, tag_of, zero,
)
from tidemark.functions.lineage import stored
from tidemark.functions.spread import counted_quantiles


def accounts_enriched(accounts: DataFrame) -> DataFrame:
    kind, ccy = F.col("account_type"), F.col("base_currency")
    priority = {"CHECKING": 1, "SAVINGS": 2, "BUSINESS": 3, "INVESTMENT": 4}
    return accounts.select(
        "account_id",
        "account_type",
        "base_currency",
        "customer_id",
        "status",
        flag(F.col("status") == "ACTIVE").alias("is_active"),
        *[flag(kind == k).alias(f"is_{k.lower()}_account") for k in priority],
        flag(ccy == "USD").alias("is_usd_account"),
        flag(ccy == "EUR").alias("is_eur_account"),
        flag(ccy.isin("GBP", "CHF", "NOK", "SEK", "DKK")).alias("is_other_currency_account"),
        choose(kind, priority, 99).alias("account_type_priority"),
        ladder(
            [
                (ccy.isin("EUR", "GBP"), "MAJOR_EUROPEAN"),
                (ccy == "USD", "USD_BASE"),
                (ccy.isin("CHF", "NOK", "SEK", "DKK"), "OTHER_EUROPEAN"),
            ],
            "OTHER",
        ).alias("currency_group"),
    )


def fx_enhanced(fx: DataFrame, *, as_of) -> DataFrame:
    """Spread, trend and rolling statistics per currency pair.

    The key of the input is (date, pair), so each window holds at most one row per day.
    """
    pair = Window.partitionBy("from_currency", "to_currency").orderBy("date")
    last30, last7 = pair.rowsBetween(-29, 0), pair.rowsBetween(-6, 0)
    mid, majors = F.col("mid_rate"), ["CHF", "USD", "EUR", "GBP"]
    newest = fx.agg(F.max("date").alias("_newest"))
    df = fx.withColumns(
        {
            "_prev": F.lag("mid_rate").over(pair),
            "_vol": F.stddev_samp("mid_rate").over(last30),
            "_avg7": (F.sum("mid_rate").over(last7).cast("double") / F.count("mid_rate").over(last7)),
            "min_rate_30d": F.min("mid_rate").over(last30),
            "max_rate_30d": F.max("mid_rate").over(last30),
        }
    ).crossJoin(F.broadcast(newest))  # one row
    spread = F.col("ask_rate") - F.col("bid_rate")
    change = mid - F.col("_prev")
    spread_pct = F.when(mid > 0, rnd(ratio(spread, mid) * 100, 4))
    return df.select(
        "date",
        "from_currency",
        "to_currency",
        F.concat_ws("/", "from_currency", "to_currency").alias("currency_pair"),
        "mid_rate",
        "bid_rate",
        "ask_rate",
        spread.alias("spread_absolute"),
        spread_pct.alias("spread_percentage"),
        change.alias("daily_change_absolute"),
        F.when(F.col("_prev") > 0, rnd(ratio(change, "_prev") * 100, 4)).alias("daily_change_percentage"),
        ladder(
            [
                (F.col("_prev").isNull(), "NO_PREV_DATA"),
                (change > 0, "APPRECIATING"),
                (change < 0, "DEPRECIATING"),
            ],
            "STABLE",
        ).alias("trend_direction"),
        rnd("_vol", 6).alias("volatility_30d"),
        rnd("_avg7", 6).alias("moving_avg_7d"),
        "min_rate_30d",
        "max_rate_30d",
        rnd(ratio(mid - F.col("min_rate_30d"), F.col("max_rate_30d") - F.col("min_rate_30d")) * 100, 2).alias(
            "rate_position_percentage"
        ),
        ladder(
            [(F.col("from_currency") == "CHF", "CHF_BASE"), (F.col("to_currency") == "CHF", "CHF_TARGET")],
            "CROSS_CURRENCY",
        ).alias("currency_pair_type"),
        F.when(F.col("from_currency").isin(majors) & F.col("to_currency").isin(majors), "MAJOR_PAIR")
        .otherwise("MINOR_PAIR")
        .alias("pair_classification"),
        ladder(
            [
                (spread_pct.isNull(), "UNKNOWN_SPREAD"),
                (spread_pct > 1.0, "HIGH_SPREAD"),
                (spread_pct > 0.5, "MEDIUM_SPREAD"),
            ],
            "LOW_SPREAD",
        ).alias("spread_risk_level"),
        ladder(
            [
                (F.col("_vol").isNull(), "UNKNOWN_VOLATILITY"),
                (F.col("_vol") > 0.05, "HIGH_VOLATILITY"),
                (F.col("_vol") > 0.02, "MEDIUM_VOLATILITY"),
            ],
            "LOW_VOLATILITY",
        ).alias("volatility_risk_level"),
        ((F.col("date") == on_date(as_of)) | (F.col("date") == F.col("_newest"))).alias("is_current_rate"),
    )


def _since(df: DataFrame, column: str, as_of, n_days: int) -> DataFrame:
    return df.where(c(column) >= F.date_sub(on_date(as_of), n_days).cast("timestamp_ntz"))


def _stddev(n: Column, total: Column, squares: Column) -> Column:
    """Sample deviation from exact sums of integers; null for fewer than two."""
    spread = squares.cast("decimal(38,0)") * n - total.cast("decimal(38,0)") * total
    return F.when(n > 1, F.sqrt(F.greatest(dbl(spread), F.lit(0.0)) / dbl(n) / (dbl(n) - 1)))


def _counted(used: DataFrame, unit: int, full: bool) -> DataFrame:
    """One pass over the payments: how often an account has each amount, day, currency and counterparty.

    Rows are account_id, kind, number (the amount in its smallest unit, or the day), text, n and for days the sums of
    hours.  All kinds are combined before the shuffle, so a busy account is spread by its values.
    """
    nothing = F.lit(None)

    def cell(kind: str, number=nothing, text=nothing) -> Column:
        return F.struct(F.lit(kind).alias("kind"), number.cast("bigint").alias("number"), text.cast("string").alias("text"))

    cells = [cell("amount", F.col("amount") * unit), cell("day", F.unix_date(as_date("booking_date")))]
    if full:
        cells += [cell(x, text=F.col(x)) for x in ("currency", "counterparty_account")]
    hour = F.hour("booking_date")
    rows = used.select("account_id", hour.alias("hour"), F.explode(F.array(*cells)).alias("cell"))
    return rows.groupBy("account_id", "cell.kind", "cell.number", "cell.text").agg(
        F.count(F.lit(1)).alias("n"), F.sum("hour").alias("hours"), F.sum(F.col("hour") * F.col("hour")).alias("squares")
    )


def behavioural_profile(
    txns: DataFrame, *, as_of, lookback: int = 450, min_n: int = 5, full: bool = True
) -> DataFrame:
    """Per-account statistics over the look-back, for accounts with at least ``min_n`` payments.

    The payments are read once, into a stored table of counts by account and value; moments, distinct days and exact
    quantiles come from that table.  ``full`` adds the columns that scoring does not need.
    """
    used = _since(txns, "booking_date", as_of, lookback).where(
        F.col("booking_date") < on_date(as_of).cast("timestamp_ntz")
    )
    kind = used.schema["amount"].dataType
    unit = 10**kind.scale
    counted = stored(_counted(used, unit, full))
    n, v, is_day, is_amount = F.col("n"), F.col("number"), F.col("kind") == "day", F.col("kind") == "amount"
    valued = is_amount & v.isNotNull()

    def total(when: Column, value: Column) -> Column:
        return F.sum(F.when(when, value))

    wide = v.cast("decimal(20,0)")
    sums = counted.groupBy("account_id").agg(
        total(is_day, n).alias("total_transactions"),
        F.count_if(is_day & v.isNotNull()).alias("active_days"),
        total(is_day & is_weekend(F.date_from_unix_date(v.cast("int"))), n).alias("_weekend"),
        total(is_day, F.col("hours")).alias("_hours"),
        total(is_day, F.col("squares")).alias("_squares"),
        total(valued, n).alias("_n"),
        total(valued, wide * n).alias("_sum"),
        total(valued, (wide * wide).cast("decimal(38,0)") * n).alias("_sum2"),
        F.min(F.when(valued, v)).alias("_min"),
        F.max(F.when(valued, v)).alias("_max"),
        F.count_if((F.col("kind") == "currency") & F.col("text").isNotNull()).alias("distinct_currencies"),
        F.count_if((F.col("kind") == "counterparty_account") & F.col("text").isNotNull()).alias("distinct_counterparties"),
    )
    count, active = F.col("total_transactions"), F.col("active_days")
    scale = F.lit(Decimal(1).scaleb(-kind.scale))
    base = sums.where(count >= min_n).select(
        "account_id",
        "total_transactions",
        ratio(F.col("_sum") * scale, "_n").alias("avg_transaction_amount"),
        (_stddev(F.col("_n"), F.col("_sum"), F.col("_sum2")) / unit).alias("stddev_transaction_amount"),
        *((F.col(f"_{x}") * scale).cast(kind).alias(f"{x}_transaction_amount") for x in ("min", "max")),
        "active_days",
        ratio(count, active).alias("avg_daily_transaction_count"),
        ratio("_hours", count).alias("avg_transaction_hour"),
        _stddev(count, F.col("_hours"), F.col("_squares")).alias("stddev_transaction_hour"),
        ratio(zero("_weekend"), count).alias("weekend_transaction_ratio"),
        *(["distinct_currencies", "distinct_counterparties"] if full else []),
    )
    cuts = {"median_transaction_amount": 0.5, "large_transaction_threshold": 0.95}
    if full:
        cuts |= {"q1_amount": 0.25, "q3_amount": 0.75}
    amounts = counted.where(valued).select("account_id", v.alias("_v"), n.alias("_n"))
    return base.join(counted_quantiles(amounts, ["account_id"], unit, cuts), "account_id")


def transaction_anomalies(
    txns: DataFrame,
    accounts: DataFrame,
    *,
    as_of,
    lookback: int = 450,
    horizon: int = 120,
    min_n: int = 5,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Score every recent payment against its account's own behaviour.

    Velocity needs counts over trailing days.  They are computed on (account, day) totals, joined
    with the profile, and attached to the payments on (account, day): one wide shuffle, keyed so
    that even an account with a third of all payments spreads over its days.  A written
    ``behavioural_profile`` of the same look-back may be given, which spares its scans.
    """
    recent = _since(txns, "booking_date", as_of, horizon).withColumn("_day", as_date("booking_date"))
    daily = recent.groupBy("account_id", "_day").agg(F.count(F.lit(1)).alias("_n"))
    by_day = Window.partitionBy("account_id").orderBy(day_number("_day"))
    if profile is None:
        profile = behavioural_profile(txns, as_of=as_of, lookback=lookback, min_n=min_n, full=False)
    else:
        unused = ("q1_amount", "q3_amount", "distinct_currencies", "distinct_counterparties")
        profile = profile.where(F.col("total_transactions") >= min_n).drop(*unused)
    owner = accounts.select("account_id", "customer_id")
    spine = (
        daily.withColumns(
            {
                "transactions_last_24h": F.sum("_n").over(by_day.rangeBetween(-1, 0)) - 1,
                "transactions_last_7d": F.sum("_n").over(by_day.rangeBetween(-7, 0)) - 1,
            }
        )
        .drop("_n")
        .join(profile, "account_id")
        .join(owner, "account_id", "left")
    )
    df = recent.join(spine, ["account_id", "_day"])

    amount, hour = F.col("amount"), F.hour("booking_date")
    amount_gap = F.abs(amount.cast("double") - F.col("avg_transaction_amount"))
    hour_gap = F.abs(hour - F.col("avg_transaction_hour"))
    sd_amount, sd_hour = F.col("stddev_transaction_amount"), F.col("stddev_transaction_hour")
    df = df.withColumns(
        {
            "_az": F.when(sd_amount > 0, amount_gap / sd_amount).otherwise(0.0),
            "_tz": F.when(sd_hour > 0, hour_gap / sd_hour).otherwise(0.0),
            "settlement_days": days("booking_date", "value_date"),
            "transaction_hour": hour,
            "transaction_dayofweek": F.dayofweek("booking_date"),
            "is_large_transaction": amount.cast("double") >= F.col("large_transaction_threshold"),
            "is_unusual_weekend_transaction": is_weekend("booking_date")
            & (F.col("weekend_transaction_ratio") < 0.1),
        }
    )
    az, tz, settle = F.col("_az"), F.col("_tz"), F.col("settlement_days")

    def faster(times: int):
        """Trailing count reaches ``times`` the daily average, compared in whole numbers."""
        return F.col("transactions_last_24h") * F.col("active_days") >= F.col("total_transactions") * times

    odd_weekend, large = F.col("is_unusual_weekend_transaction"), F.col("is_large_transaction")
    late, back = settle > 5, settle < 0

    def weight(cond, points):
        return F.when(cond, points).otherwise(0.0)

    return df.select(
        "transaction_id",
        "account_id",
        "customer_id",
        "booking_date",
        "value_date",
        "amount",
        "currency",
        "counterparty_account",
        "description",
        F.col("total_transactions").alias("customer_total_transactions"),
        "avg_transaction_amount",
        "median_transaction_amount",
        "avg_daily_transaction_count",
        rnd(az, 2).alias("amount_anomaly_score"),
        rnd(tz, 2).alias("timing_anomaly_score"),
        at_least(
            az,
            [(3.0, "EXTREME_AMOUNT_ANOMALY"), (2.0, "HIGH_AMOUNT_ANOMALY"), (1.5, "MODERATE_AMOUNT_ANOMALY")],
            "NORMAL_AMOUNT",
        ).alias("amount_anomaly_level"),
        at_least(tz, [(2.0, "HIGH_TIMING_ANOMALY"), (1.5, "MODERATE_TIMING_ANOMALY")], "NORMAL_TIMING").alias(
            "timing_anomaly_level"
        ),
        ladder([(faster(5), "HIGH_VELOCITY_ANOMALY"), (faster(3), "MODERATE_VELOCITY_ANOMALY")], "NORMAL_VELOCITY").alias(
            "velocity_anomaly_level"
        ),
        large.alias("is_large_transaction"),
        odd_weekend.alias("is_unusual_weekend_transaction"),
        ((hour < 6) | (hour > 22)).alias("is_off_hours_transaction"),
        "settlement_days",
        late.alias("is_delayed_settlement"),
        back.alias("is_backdated_settlement"),
        rnd(
            az * 0.35
            + tz * 0.2
            + weight(faster(3), 2.0) * 0.25
            + weight(odd_weekend, 1.0) * 0.1
            + weight(late, 1.5) * 0.1,
            2,
        ).alias("composite_anomaly_score"),
        ladder(
            [
                ((az >= 3) | (tz >= 2) | faster(5) | (large & (hour < 6)) | back, "CRITICAL_ANOMALY"),
                ((az >= 2) | (tz >= 1.5) | faster(3) | odd_weekend | late, "HIGH_ANOMALY"),
                ((az >= 1.5) | (tz >= 1) | faster(2) | (settle > 3), "MODERATE_ANOMALY"),
            ],
            "NORMAL_BEHAVIOR",
        ).alias("overall_anomaly_classification"),
        ((az >= 3) | faster(5) | back).alias("requires_immediate_review"),
        ((az >= 2) | (tz >= 2) | faster(3) | late).alias("requires_enhanced_monitoring"),
        "transactions_last_24h",
        "transactions_last_7d",
        "transaction_hour",
        "transaction_dayofweek",
    )


def account_balances(
    accounts: DataFrame, txns: DataFrame, fx: DataFrame, *, as_of, lookback: int = 450, base_ccy: str = "CHF"
) -> DataFrame:
    """Balance, activity and category per active account.

    ``accounts`` and ``fx`` are the enriched tables.  Payments are summed per account before the
    join, so the join sees one row per account on both sides.
    """
    recent = F.col("booking_date") >= F.date_sub(on_date(as_of), 30).cast("timestamp_ntz")
    amt = F.col("base_amount")
    moves = (
        _since(txns, "booking_date", as_of, lookback)
        .groupBy("account_id")
        .agg(
            F.count_if(amt != 0).alias("total_transactions"),
            F.count_if(amt > 0).alias("credit_transactions"),
            F.count_if(amt < 0).alias("debit_transactions"),
            F.sum(amt).alias("_bal"),
            sum_if(amt > 0, amt).alias("_cred"),
            sum_if(amt < 0, F.abs(amt)).alias("_deb"),
            mean(amt).alias("_avg"),
            F.min(amt).alias("_min"),
            F.max(amt).alias("_max"),
            F.min("booking_date").alias("_first"),
            F.max("booking_date").alias("_last"),
            F.max("value_date").alias("last_value_date"),
            F.count_if(recent & (amt != 0)).alias("recent_transactions_30d"),
            sum_if(recent, amt).alias("_recent"),
        )
    )
    quoted = fx.where(F.col("is_current_rate") & (F.col("from_currency") == base_ccy))
    # newest current rate per quoted currency, so a rate dated ahead cannot repeat an account
    rates = quoted.groupBy(F.col("to_currency").alias("base_currency")).agg(
        F.max_by("mid_rate", "date").alias("_mid")
    )
    df = accounts.where("is_active").join(moves, "account_id", "left").join(rates, "base_currency", "left")
    bal, n = zero("_bal"), zero("total_transactions")
    n30, moved = zero("recent_transactions_30d"), zero("_recent")
    own = F.when((F.col("base_currency") == base_ccy) | F.col("_mid").isNull(), bal.cast("double")).otherwise(
        bal.cast("double") * F.col("_mid").cast("double")
    )
    return df.select(
        "account_id",
        "customer_id",
        "account_type",
        "base_currency",
        F.col("status").alias("account_status"),
        bal.alias("current_balance_base"),
        zero("_cred").alias("total_credits_base"),
        zero("_deb").alias("total_debits_base"),
        rnd(own, 2).alias("current_balance_base_currency"),
        n.alias("total_transactions"),
        zero("credit_transactions").alias("credit_transactions"),
        zero("debit_transactions").alias("debit_transactions"),
        rnd(F.coalesce("_avg", F.lit(0.0)), 2).alias("avg_transaction_amount_base"),
        zero("_min").alias("min_transaction_amount_base"),
        zero("_max").alias("max_transaction_amount_base"),
        ladder(
            [
                (n == 0, "INACTIVE"),
                (n30 == 0, "DORMANT"),
                (n30 >= 20, "HIGH_ACTIVITY"),
                (n30 >= 5, "MODERATE_ACTIVITY"),
            ],
            "LOW_ACTIVITY",
        ).alias("activity_level"),
        ladder(
            [
                (bal < 0, "OVERDRAWN"),
                (bal == 0, "ZERO_BALANCE"),
                (bal < 900, "LOW_BALANCE"),
                (bal < 9000, "MODERATE_BALANCE"),
                (bal < 90000, "HIGH_BALANCE"),
            ],
            "VERY_HIGH_BALANCE",
        ).alias("balance_category"),
        (bal < -900).alias("is_overdrawn"),
        ((n30 == 0) & (n > 0)).alias("is_dormant"),
        (F.abs(moved) > 45000).alias("has_large_recent_movements"),
        as_date("_first").alias("first_transaction_date"),
        as_date("_last").alias("last_transaction_date"),
        "last_value_date",
        n30.alias("recent_transactions_30d"),
        moved.alias("recent_balance_change_30d_base"),
    )


def customer_transaction_summary(txns: DataFrame, accounts: DataFrame, *, as_of) -> DataFrame:
    """Twelve-month activity per customer; summed per account before owners are attached."""
    today = on_date(as_of)
    year = F.col("value_date") >= F.add_months(today, -12)
    one = F.lit(1)
    per_account = txns.groupBy("account_id", F.trunc("value_date", "month").alias("_month")).agg(
        F.count_if(year).alias("y"),
        F.count(one).alias("n"),
        F.count_if(year & (F.col("amount") < 0)).alias("d"),
        F.count_if(year & (F.col("amount") > 0)).alias("cr"),
        F.count_if(F.col("value_date") >= F.add_months(today, -1)).alias("m"),
        F.max("value_date").alias("last"),
        F.min("value_date").alias("first"),
    )
    per_month = (
        per_account.join(accounts.select("account_id", "customer_id"), "account_id")
        .groupBy("customer_id", "_month")
        .agg(*[F.sum(x).alias(x) for x in ("y", "n", "d", "cr", "m")], F.max("last").alias("last"), F.min("first").alias("first"))
    )
    last, first = F.max("last"), F.min("first")
    return per_month.groupBy("customer_id").agg(
        F.sum("y").alias("total_transactions_12m"),
        F.sum("n").alias("total_transactions_all_time"),
        F.sum("d").alias("debit_transactions"),
        F.sum("cr").alias("credit_transactions"),
        last.alias("last_transaction_date"),
        days(last, today).alias("days_since_last_transaction"),
        first.alias("first_transaction_date"),
        rnd(ratio(F.sum("n"), months_crossed(first, today)), 2).alias("avg_monthly_transactions"),
        F.count("_month").alias("transaction_months_active"),
        (days(last, today) >= 180).alias("is_dormant_transactionally"),
        (F.sum("m") > 50).alias("is_highly_active"),
    )


# ---- reports over scored payments -------------------------------------------------------------



def _amounts(prefix: str, label: str = "amount"):
    return [F.sum("amount").alias(f"total_{prefix}{label}"), rnd(mean("amount"), 2).alias(f"avg_{prefix}{label}")]



def daily_transaction_summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy(as_date("booking_date").alias("transaction_date")).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.countDistinct("customer_id").alias("unique_customers"),
        *_amounts("base_"),
        F.count_if(F.col("amount") > 0).alias("incoming_count"),
        F.count_if(F.col("amount") < 0).alias("outgoing_count"),
        F.count_if(is_tagged("description")).alias("anomalous_count"),
        F.countDistinct("currency").alias("currency_count"),
    )


def currency_exposure_current(scored: DataFrame, base_ccy: str = "CHF") -> DataFrame:
    one = F.lit(1.0)  # payments are already held in the base currency
    return (
        scored.where(F.col("currency") != base_ccy)
        .groupBy("currency")
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.sum("amount").alias("total_original_amount"),
            F.sum("amount").alias("total_chf_amount"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
        .withColumns({"avg_fx_rate": one, "min_fx_rate": one, "max_fx_rate": one})
    )


def currency_exposure_history(scored: DataFrame, base_ccy: str = "CHF") -> DataFrame:
    """Daily totals first; the rolling windows then see one row per currency and day."""
    daily = (
        scored.where(F.col("currency") != base_ccy)
        .groupBy(as_date("booking_date").alias("exposure_date"), "currency")
        .agg(
            F.count(F.lit(1)).alias("daily_transaction_count"),
            F.sum("amount").alias("daily_total_amount"),
            rnd(mean("amount"), 2).alias("daily_avg_amount"),
            F.min("amount").alias("daily_min_amount"),
            F.max("amount").alias("daily_max_amount"),
            F.countDistinct("customer_id").alias("daily_unique_customers"),
        )
    )
    by_ccy = Window.partitionBy("currency").orderBy("exposure_date")
    week = by_ccy.rowsBetween(-6, 0)
    total, then = F.col("daily_total_amount"), F.lag("daily_total_amount", 30).over(by_ccy)
    return daily.select(
        "*",
        F.sum("daily_transaction_count").over(week).alias("rolling_7d_transaction_count"),
        F.sum(total).over(week).alias("rolling_7d_total_amount"),
        rnd(F.sum(total).over(week).cast("double") / F.count(total).over(week), 2).alias(
            "rolling_7d_avg_daily_amount"
        ),
        then.alias("amount_30_days_ago"),
        F.when(then > 0, rnd(ratio(total - then, then) * 100, 2)).alias("growth_rate_30d_percent"),
        above("daily_transaction_count", [(100, "HIGH_VOLUME"), (50, "MEDIUM_VOLUME")], "LOW_VOLUME").alias(
            "daily_volume_category"
        ),
        above(total, [(1000000, "HIGH_EXPOSURE"), (100000, "MEDIUM_EXPOSURE")], "LOW_EXPOSURE").alias(
            "daily_exposure_category"
        ),
    )


def settlement_exposure(scored: DataFrame, base_ccy: str = "CHF") -> DataFrame:
    gap = days("booking_date", "value_date")
    n, late = F.count(F.lit(1)), F.count_if(gap > 5)
    return (
        scored.where(F.col("currency") != base_ccy)
        .groupBy(as_date("value_date").alias("settlement_date"), "currency")
        .agg(
            n.alias("settlement_transaction_count"),
            F.sum("amount").alias("settlement_total_amount"),
            rnd(mean(gap), 2).alias("avg_settlement_days"),
            F.count_if(gap == 0).alias("same_day_settlements"),
            F.count_if(gap == 1).alias("t_plus_1_settlements"),
            F.count_if(gap.between(2, 3)).alias("t_plus_2_3_settlements"),
            late.alias("delayed_settlements"),
            F.count_if(gap < 0).alias("backdated_settlements"),
            ladder(
                [(late > 0, "HIGH_SETTLEMENT_RISK"), (F.count_if(gap > 3) * 10 > n, "MEDIUM_SETTLEMENT_RISK")],
                "LOW_SETTLEMENT_RISK",
            ).alias("settlement_risk_level"),
        )
        .withColumn(
            "settlement_timing_type",
            F.when(is_weekend("settlement_date"), "WEEKEND_SETTLEMENT").otherwise("WEEKDAY_SETTLEMENT"),
        )
    )


def settlement_analysis(scored: DataFrame) -> DataFrame:
    gap = F.col("settlement_days")
    return (
        scored.select(
            as_date("booking_date").alias("booking_date"),
            as_date("value_date").alias("value_date"),
            days("booking_date", "value_date").alias("settlement_days"),
            "customer_id",
            "amount",
        )
        .groupBy("booking_date", "value_date", "settlement_days")
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.countDistinct("customer_id").alias("unique_customers"),
            *_amounts(""),
            F.count_if(gap < 0).alias("backdated_count"),
            F.count_if(gap > 5).alias("delayed_count"),
            F.count_if(gap == 0).alias("same_day_count"),
            F.count_if(gap == 1).alias("next_day_count"),
            F.count_if(gap.between(2, 3)).alias("t_plus_2_3_count"),
        )
    )


def _people(customer_view: DataFrame) -> DataFrame:
    """One row per customer: the customer view repeats a customer once per screening match."""
    return customer_view.select("customer_id", "full_name", "has_anomaly", "onboarding_date").distinct()


def anomaly_analysis(customer_view: DataFrame, scored: DataFrame) -> DataFrame:
    """Share, amount and kinds of tagged payments per customer that has payments."""
    per_tag = scored.groupBy("customer_id", F.when(is_tagged("description"), tag_of("description")).alias("_tag")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_amount")
    )
    tagged = F.col("_tag").isNotNull()
    n, hit = F.sum("_n"), sum_if(tagged, "_n")
    per_customer = per_tag.groupBy("customer_id").agg(
        n.alias("total_transactions"),
        hit.alias("anomalous_transactions"),
        pct(hit, n).alias("anomaly_percentage"),
        sum_if(tagged, "_amount").alias("anomalous_amount"),
        distinct_list("_tag").alias("anomaly_types"),
    )
    return (
        _people(customer_view)
        .drop("onboarding_date")
        .withColumnRenamed("has_anomaly", "is_anomalous_customer")
        .join(per_customer, "customer_id")
    )


def high_risk_patterns(scored: DataFrame, base_ccy: str = "CHF") -> DataFrame:
    gap, amount, other = days("booking_date", "value_date"), F.col("amount"), F.col("counterparty_account")
    rules = [
        (amount >= 10000, "HIGH_AMOUNT"),
        (is_tagged("description"), "ANOMALOUS"),
        ((F.col("currency") != base_ccy) & (amount >= 5000), "HIGH_FX_AMOUNT"),
        (other.rlike("^OFF.SHORE."), "OFFSHORE"),
        (other.rlike("^CRYPTO."), "CRYPTO"),
        (~F.hour("booking_date").between(9, 17), "OFF_HOURS"),
        (gap < 0, "BACKDATED_SETTLEMENT"),
        (gap > 5, "DELAYED_SETTLEMENT"),
    ]
    return (
        scored.withColumn("risk_category", ladder(rules))
        .where(F.col("risk_category").isNotNull())
        .select(
            "transaction_id",
            "customer_id",
            "booking_date",
            "value_date",
            "amount",
            "currency",
            F.when(amount > 0, "IN").otherwise("OUT").alias("direction"),
            "description",
            "risk_category",
            gap.alias("settlement_days"),
        )
    )


def customer_summary(customer_view: DataFrame, accounts: DataFrame, scored: DataFrame) -> DataFrame:
    """Accounts and scored payments per customer, each summed before the join."""
    held = accounts.groupBy("customer_id").agg(
        F.count("account_id").alias("total_accounts"),
        F.countDistinct("base_currency").alias("currency_count"),
        distinct_list("base_currency").alias("account_currencies"),
    )
    paid = scored.groupBy("customer_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        F.sum("amount").alias("total_base_amount"),
        rnd(mean("amount")).alias("avg_transaction_amount"),
        F.max("amount").alias("max_transaction_amount"),
        F.count_if(is_tagged("description")).alias("anomalous_transactions"),
    )
    counts = {x: zero(x) for x in ("total_accounts", "currency_count", "total_transactions", "anomalous_transactions")}
    return (
        _people(customer_view)
        .join(held, "customer_id", "left")
        .join(paid, "customer_id", "left")
        .withColumns({**counts, "account_currencies": F.coalesce("account_currencies", F.lit(""))})
    )


def lifecycle_anomalies(
    customers: DataFrame, events: DataFrame, scored: DataFrame, accounts: DataFrame, txns: DataFrame
) -> DataFrame:
    """Payments flagged soon after a sensitive customer event that ended a quiet period.

    The last payment before each event is an as-of lookup.  Payments are reduced to distinct
    (customer, day) first, so the ordered scan per customer is bounded by the calendar.
    """
    kinds = ["REACTIVATION", "ADDRESS_CHANGE", "EMPLOYMENT_CHANGE"]
    watched = events.where(F.col("event_type").isin(kinds))
    paid_days = (
        txns.select("account_id", as_date("booking_date").alias("_paid"))
        .distinct()
        .join(accounts.select("account_id", "customer_id"), "account_id")
        .select("customer_id", F.col("_paid").alias("_at"), F.col("_paid").alias("_day"))
        .distinct()
    )
    asked = watched.select("customer_id", F.col("event_date").alias("_at"), F.lit(None).cast("date").alias("_day"))
    both = paid_days.unionByName(asked.distinct()).withColumn("_no", day_number("_at"))
    before = Window.partitionBy("customer_id").orderBy("_no").rangeBetween(Window.unboundedPreceding, -1)
    asof = (
        both.withColumn("_last", F.max("_day").over(before))
        .where("_day is null")
        .select("customer_id", F.col("_at").alias("event_date"), "_last")
        .distinct()
    )
    quiet = days("_last", "event_date")
    sensitive = (
        watched.join(asof, ["customer_id", "event_date"])
        .withColumn("days_dormant_before_event", quiet)
        .where("days_dormant_before_event > 30")
        .select("customer_id", "event_id", "event_type", "event_date", "days_dormant_before_event")
    )
    flagged = scored.where(
        F.col("overall_anomaly_classification").isin("CRITICAL_ANOMALY", "HIGH_ANOMALY")
    ).withColumn("transaction_date", as_date("booking_date"))
    # one key per possible day (0..30 after the event): an equi-join on customer and day
    dated = sensitive.withColumn(
        "transaction_date", F.explode(F.sequence("event_date", F.date_add("event_date", 30)))
    )
    level, dormant = F.col("overall_anomaly_classification"), F.col("days_dormant_before_event")
    critical = level == "CRITICAL_ANOMALY"
    moved = F.col("event_type").isin("REACTIVATION", "ADDRESS_CHANGE")
    return (
        dated.join(flagged, ["customer_id", "transaction_date"])
        .join(customers.select("customer_id", "full_name"), "customer_id")
        .select(
            "customer_id",
            "full_name",
            F.col("event_id").alias("lifecycle_event_id"),
            "event_type",
            "event_date",
            "days_dormant_before_event",
            "transaction_id",
            "transaction_date",
            F.col("amount").alias("transaction_amount"),
            F.col("composite_anomaly_score").alias("anomaly_score"),
            level.alias("anomaly_level"),
            days("event_date", "transaction_date").alias("days_between_event_and_transaction"),
            ladder([(critical & moved, "CRITICAL"), (dormant > 180, "HIGH"), (~critical, "MEDIUM")], "LOW").alias(
                "aml_risk_level"
            ),
            (critical & moved & (dormant > 180)).alias("requires_sar_filing"),
            F.lit("OPEN").alias("investigation_status"),
        )
    )
