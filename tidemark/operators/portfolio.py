"""Performance of the whole portfolio of an account: cash, equity, fixed income, commodities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import as_date, at_least, days, dbl, ladder, on_date, ratio, rnd, sum_if, zero


def _recent(df: DataFrame, ts: str, as_of, n_days: int) -> DataFrame:
    return df.where(F.col(ts) >= F.date_sub(on_date(as_of), n_days).cast("timestamp_ntz"))


def _cash(txns: DataFrame) -> DataFrame:
    amount, day = F.col("amount"), as_date("booking_date")
    return txns.groupBy("account_id").agg(
        F.min(day).alias("start"),
        F.max(day).alias("end"),
        sum_if(amount > 0, amount).alias("deposits"),
        sum_if(amount < 0, -amount).alias("withdrawals"),
        F.sum(amount).alias("net_flow"),
        F.count(F.lit(1)).alias("cash_n"),
        F.countDistinct(day).alias("cash_days"),
    )


def _book(trades: DataFrame, kind: str) -> DataFrame:
    size = F.abs("base_gross_amount")
    buy, sell = F.col("side") == "1", F.col("side") == "2"
    # equity counts purchases as invested, the other classes count all turnover
    invested = sum_if(buy, size) if kind == "equity" else F.sum(size)
    gain = sum_if(sell, size) - sum_if(~sell if kind != "equity" else buy, size)
    aggs = [
        F.count(F.lit(1)).alias(f"{kind}_n"),
        F.count_if(buy).alias(f"{kind}_buys"),
        F.count_if(sell).alias(f"{kind}_sells"),
        invested.alias(f"{kind}_invested"),
        gain.alias(f"{kind}_pl"),
        F.sum("commission").alias(f"{kind}_fee"),
    ]
    if kind == "equity":
        aggs.append(F.countDistinct(as_date("trade_date")).alias("equity_days"))
    return trades.groupBy("account_id").agg(*aggs)


def _open_positions(positions: DataFrame, kind: str) -> DataFrame:
    return (
        positions.where("position_status <> 'CLOSED'")
        .groupBy("account_id")
        .agg(F.count(F.lit(1)).alias(f"{kind}_open"), F.sum("net_investment_chf").alias(f"{kind}_value"))
    )


def portfolio_performance(
    txns, eq_trades, fi_trades, cmd_trades, balances, eq_pos, fi_pos, cmd_pos, accounts, *, as_of, lookback: int = 450
) -> DataFrame:
    """Time-weighted return, allocation and activity per account.

    All inputs are reduced to one row per account, stacked and merged in a single grouping, which
    replaces the chain of outer joins.  Volatility, Sharpe ratio and drawdown are not derived from
    data by the rules this follows; they stay at zero.
    """
    today = on_date(as_of)
    flows = [
        _cash(_recent(txns, "booking_date", as_of, lookback)).withColumn("_flow", F.lit(True)),
        *[
            _book(_recent(t, "trade_date", as_of, lookback), k).withColumn("_flow", F.lit(True))
            for t, k in ((eq_trades, "equity"), (fi_trades, "fi"), (cmd_trades, "cmd"))
        ],
        balances.select("account_id", F.col("current_balance_base").alias("cash_value"), F.lit(1).alias("has_cash")),
        _open_positions(eq_pos, "equity"),
        _open_positions(fi_pos, "fi"),
        _open_positions(cmd_pos, "cmd"),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), flows)
    values = [x for x in stacked.columns if x not in ("account_id", "_flow")]
    df = (
        stacked.groupBy("account_id")
        .agg(F.max("_flow").alias("_flow"), *[F.max(x).alias(x) for x in values])
        .where("_flow")  # accounts with any movement in the look-back
        .withColumns({x: zero(x) for x in values if x not in ("start", "end")})
    )
    n_days = F.when(F.col("start").isNotNull(), days("start", "end")).otherwise(lookback)
    # accounts without a balance row open at zero
    df = df.withColumns(
        {
            "days_in_period": n_days,
            "opening": F.when(F.col("has_cash") == 1, F.col("cash_value") - F.col("net_flow")).otherwise(0),
        }
    )
    return _finish(df, accounts, today, lookback)


def _finish(df: DataFrame, accounts: DataFrame, today, lookback: int) -> DataFrame:
    cash, opening, flow = dbl("cash_value"), dbl("opening"), dbl("net_flow")
    exact_net = F.col("equity_pl") - F.col("equity_fee")
    exact_gain = F.col("cash_value") - F.col("opening") - F.col("net_flow")
    invested, net = dbl("equity_invested"), dbl(exact_net)
    total = F.col("cash_value") + F.col("equity_value") + F.col("fi_value") + F.col("cmd_value")
    n_days = F.col("days_in_period")
    df = df.withColumns(
        {
            "_total": total,
            "_cash_twr": F.when(opening > 0, (cash - opening - flow) / opening * 100).otherwise(0.0),
            "_eq_twr": F.when(invested > 0, net / invested * 100).otherwise(0.0),
            "_w": F.when(opening + invested > 0, opening / (opening + invested)).otherwise(1.0),
            "_we": F.when(opening + invested > 0, invested / (opening + invested)).otherwise(0.0),
        }
    ).withColumn("_twr", F.col("_cash_twr") * F.col("_w") + F.col("_eq_twr") * F.col("_we"))
    twr = F.col("_twr")
    growth = 1 + twr / 100
    # a loss above 100 % has no annual rate: report the lower bound
    annual = F.when(growth > 0, (F.pow(growth, 365.0 / n_days) - 1) * 100).otherwise(-100.0)
    trades = F.col("cash_n") + F.col("equity_n")

    def returned(kind):
        got, put = dbl(f"{kind}_pl") - dbl(f"{kind}_fee"), dbl(f"{kind}_invested")
        return rnd(F.when(put > 0, got / put * 100).otherwise(0.0), 4)

    def share(kind, empty):
        return rnd(F.when(F.col("_total") > 0, ratio(f"{kind}_value", "_total") * 100).otherwise(empty))

    has = {k: F.col(f"{k}_n") > 0 for k in ("equity", "fi", "cmd")}
    columns = [
        "account_id",
        "customer_id",
        "account_type",
        "base_currency",
        F.coalesce("start", F.date_sub(today, lookback)).alias("measurement_period_start"),
        F.coalesce("end", today).alias("measurement_period_end"),
        n_days.alias("days_in_period"),
        F.col("opening").alias("cash_starting_balance"),
        F.col("cash_value").alias("cash_ending_balance"),
        F.col("deposits").alias("cash_deposits"),
        F.col("withdrawals").alias("cash_withdrawals"),
        F.col("net_flow").alias("cash_net_flow"),
        rnd("_cash_twr", 4).alias("cash_twr_percentage"),
        F.col("equity_n").alias("equity_trades_count"),
        F.col("equity_buys").alias("equity_buy_trades"),
        F.col("equity_sells").alias("equity_sell_trades"),
        F.col("equity_invested").alias("equity_total_invested_chf"),
        F.col("equity_pl").alias("equity_realized_pl_chf"),
        rnd("equity_fee").alias("equity_commission_chf"),
        rnd(exact_net).alias("equity_net_return_chf"),
        rnd("_eq_twr", 4).alias("equity_return_percentage"),
    ]
    for kind in ("fi", "cmd"):
        columns += [
            F.col(f"{kind}_n").alias(f"{kind}_trades_count"),
            F.col(f"{kind}_buys").alias(f"{kind}_buy_trades"),
            F.col(f"{kind}_sells").alias(f"{kind}_sell_trades"),
            F.col(f"{kind}_invested").alias(f"{kind}_total_invested_chf"),
            F.col(f"{kind}_pl").alias(f"{kind}_net_pl_chf"),
            rnd(f"{kind}_fee").alias(f"{kind}_commission_chf"),
            returned(kind).alias(f"{kind}_return_percentage"),
        ]
    columns.append(F.col("cash_value").alias("current_cash_value_chf"))
    for kind in ("equity", "fi", "cmd"):
        columns += [
            F.col(f"{kind}_open").alias(f"current_{kind}_positions"),
            F.col(f"{kind}_value").alias(f"current_{kind}_value_chf"),
        ]
    columns += [
        F.col("_total").alias("total_portfolio_value_chf"),
        share("cash", 100.0).alias("cash_allocation_percentage"),
        *[share(k, 0.0).alias(f"{k}_allocation_percentage") for k in ("equity", "fi", "cmd")],
        rnd(twr, 4).alias("total_portfolio_twr_percentage"),
        rnd(exact_gain + exact_net).alias("total_return_chf"),
        rnd(
            F.when(n_days >= 30, F.least(F.greatest(annual, F.lit(-10000.0)), F.lit(10000.0))).otherwise(0.0), 4
        ).alias("annualized_portfolio_twr"),
        F.lit(0.0).alias("portfolio_volatility"),
        F.lit(0.0).alias("sharpe_ratio"),
        F.lit(3.5).alias("risk_free_rate_annual_pct"),
        F.lit(0.0).alias("max_drawdown_percentage"),
        trades.alias("total_transactions"),
        rnd(F.when(n_days > 0, trades * 30.0 / n_days).otherwise(0.0)).alias("transaction_frequency"),
        F.greatest("cash_days", "equity_days").alias("trading_days"),
        at_least(
            twr,
            [(15, "EXCELLENT_PERFORMANCE"), (8, "GOOD_PERFORMANCE"), (2, "NEUTRAL_PERFORMANCE"), (0, "POOR_PERFORMANCE")],
            "NEGATIVE_PERFORMANCE",
        ).alias("performance_category"),
        F.lit("LOW_RISK").alias("risk_category"),
        ladder(
            [
                (~has["equity"] & ~has["fi"] & ~has["cmd"], "CASH_ONLY"),
                (has["equity"] & has["fi"] & has["cmd"], "MULTI_ASSET"),
                (has["equity"] & (has["fi"] | has["cmd"]), "BALANCED"),
                (has["equity"], "EQUITY_FOCUSED"),
                (has["fi"], "FI_FOCUSED"),
            ],
            "COMMODITY_FOCUSED",
        ).alias("portfolio_type"),
    ]
    used = (
        (F.col("opening") > 0)
        | (F.col("equity_invested") > 0)
        | (F.col("fi_invested") > 0)
        | (F.col("cmd_invested") > 0)
    )
    owner = accounts.select("account_id", "customer_id", "account_type", "base_currency")
    return df.where(used).join(owner, "account_id", "left").select(*columns)
