"""Equity, fixed-income and commodity trades: summaries, positions and exposures.

Side '1' is a buy and '2' a sell.  Every group is one conditional aggregate, so map-side
combining does most of the work and a busy account costs no more than a quiet one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import (
    as_date, at_least, at_most, attach_total, c, choose, days, dbl, ladder, mean, months_crossed, on_date, pct, ratio,
    rnd, sum_if, weighted_mean,
)
from tidemark.functions.spread import cell_distinct, cell_mode, cells

ONE = 1


def _buy():
    return F.col("side") == "1"


def _sell():
    return F.col("side") == "2"


def _base():
    return F.abs("base_gross_amount")


def _n():
    return F.count(F.lit(ONE))


def _signed(column):
    return F.sum(F.when(_buy(), c(column)).otherwise(-c(column)))


def _size(cuts):
    return at_least(_base(), list(zip(cuts, ("VERY_LARGE", "LARGE", "MEDIUM"), strict=True)), "SMALL")


def _bps():
    gross = F.abs("gross_amount")
    return F.when(gross > 0, ratio(F.col("commission"), gross) * 10000).otherwise(0.0)


def _standing(net):
    return ladder([(net > 0, "LONG"), (net < 0, "SHORT")], "CLOSED")


def _realized(measure):
    """Sale proceeds less the average purchase cost of what was sold."""
    bought, sold = F.sum(F.when(_buy(), c(measure))), F.sum(F.when(_sell(), c(measure)))
    paid, got = F.sum(F.when(_buy(), _base())), sum_if(_sell(), _base())
    cost = F.when((sold > 0) & (bought > 0), dbl(paid) / dbl(bought) * dbl(sold)).otherwise(0.0)
    return rnd(dbl(got) - cost)


def equity_trade_summary(trades: DataFrame) -> DataFrame:
    return trades.withColumns(
        {
            "side_description": choose("side", {"1": "BUY", "2": "SELL"}, "UNKNOWN"),
            "commission_rate_bps": rnd(_bps()),
            "trade_value_category": _size((1000000, 100000, 10000)),
            "settlement_days": days("trade_date", "settlement_date"),
            "trade_year": F.year("trade_date"),
            "trade_month": F.month("trade_date"),
            "trade_day_of_week": F.dayofweek("trade_date"),
        }
    )


def equity_positions(trades: DataFrame, *, as_of) -> DataFrame:
    qty, gross = F.col("quantity"), F.abs("gross_amount")
    buys, sells = sum_if(_buy(), qty), sum_if(_sell(), qty)
    paid, got = sum_if(_buy(), gross), sum_if(_sell(), gross)
    paid_chf, got_chf = sum_if(_buy(), _base()), sum_if(_sell(), _base())

    def price(cond, volume):
        value = sum_if(cond, qty * F.col("price"))
        return F.when(volume > 0, rnd(ratio(value, volume), 6)).otherwise(0.0)

    return trades.groupBy("account_id", "customer_id", "symbol", "isin", "currency").agg(
        (buys - sells).alias("total_quantity"),
        buys.alias("total_buys"),
        sells.alias("total_sells"),
        price(_buy(), buys).alias("average_buy_price"),
        price(_sell(), sells).alias("average_sell_price"),
        paid.alias("total_buy_amount"),
        got.alias("total_sell_amount"),
        rnd(F.sum("commission")).alias("total_commission"),
        rnd(paid - got + F.sum("commission")).alias("net_investment"),
        paid_chf.alias("total_buy_amount_chf"),
        got_chf.alias("total_sell_amount_chf"),
        (paid_chf - got_chf).alias("net_investment_chf"),
        _realized("quantity").alias("realized_pl_chf"),
        _standing(buys - sells).alias("position_status"),
        as_date(F.min("trade_date")).alias("first_trade_date"),
        as_date(F.max("trade_date")).alias("last_trade_date"),
        _n().alias("trade_count"),
        days(F.min("trade_date"), on_date(as_of)).alias("holding_days"),
    )


def equity_customer_activity(trades: DataFrame, *, as_of) -> DataFrame:
    """Volumes, habits and tenure per customer, from one scan of the trades."""
    kinds = {"day": as_date("trade_date"), "account": F.col("account_id")} | {x: F.col(x) for x in ("symbol", "market", "order_type")}
    found = cells(
        trades,
        ["customer_id"],
        kinds,
        F.count_if(_buy()).alias("buys"),
        F.count_if(_sell()).alias("sells"),
        F.sum(_base()).alias("volume"),
        F.count(_base()).alias("valued"),
        F.max(_base()).alias("largest"),
        F.sum("commission").alias("commission"),
        F.sum(_bps()).alias("bps"),
        F.count(_bps()).alias("with_bps"),
        F.min("trade_date").alias("first"),
        F.max("trade_date").alias("last"),
    )
    day = F.col("kind") == "day"

    def total(name: str):
        return F.sum(F.when(day, F.col(name)))

    first, last, n = F.min("first"), F.max("last"), total("n")
    months = months_crossed(first, last)
    symbol = cell_mode("symbol")
    return found.groupBy("customer_id").agg(
        n.alias("total_trades"),
        total("buys").alias("total_buy_trades"),
        total("sells").alias("total_sell_trades"),
        total("volume").alias("total_volume_chf"),
        rnd(total("commission")).alias("total_commission_chf"),
        rnd(ratio(total("volume"), total("valued"))).alias("average_trade_size_chf"),
        F.max("largest").alias("largest_trade_chf"),
        rnd(ratio(total("bps"), total("with_bps"))).alias("average_commission_bps"),
        as_date(first).alias("first_trade_date"),
        as_date(last).alias("last_trade_date"),
        cell_distinct("day").alias("trading_days"),
        days(first, on_date(as_of)).alias("customer_tenure_days"),
        rnd(F.when(months > 0, n / months).otherwise(n.cast("double"))).alias("average_trades_per_month"),
        at_least(n, [(100, "VERY_ACTIVE"), (50, "ACTIVE"), (20, "MODERATE"), (5, "OCCASIONAL")], "INACTIVE").alias(
            "trader_category"
        ),
        cell_distinct("account").alias("unique_accounts"),
        symbol["value"].alias("most_traded_symbol"),
        symbol["n"].alias("most_traded_symbol_count"),
        cell_distinct("symbol").alias("unique_symbols"),
        cell_mode("market")["value"].alias("preferred_market"),
        cell_mode("order_type")["value"].alias("preferred_order_type"),
    )


def _term(days_left):
    return at_most(days_left, [(365, "SHORT_TERM"), (1825, "MEDIUM_TERM")], "LONG_TERM")


def fi_trade_summary(trades: DataFrame, *, as_of) -> DataFrame:
    left = days(on_date(as_of), "maturity_date")
    return trades.withColumns(
        {
            "side_description": choose("side", {"1": "BUY/PAY", "2": "SELL/RECEIVE"}, "UNKNOWN"),
            "days_to_maturity": left,
            "trade_value_category": _size((10000000, 1000000, 100000)),
            "maturity_bucket": _term(left),
        }
    )


def fi_positions(trades: DataFrame) -> DataFrame:
    net = _signed("notional")
    return trades.groupBy(
        "account_id", "customer_id", "instrument_type", "issuer", "issuer_type", "credit_rating", "currency"
    ).agg(
        net.alias("total_notional"),
        _n().alias("total_trades"),
        F.count_if(_buy()).alias("total_buy_trades"),
        F.count_if(_sell()).alias("total_sell_trades"),
        F.sum(_base()).alias("total_investment_chf"),
        F.sum("base_net_amount").alias("net_investment_chf"),
        _realized("notional").alias("realized_pl_chf"),
        rnd(weighted_mean("duration", F.abs("notional"))).alias("average_duration"),
        F.sum("dv01").alias("total_dv01_chf"),
        rnd(mean("credit_spread_bps")).alias("average_credit_spread_bps"),
        _standing(net).alias("position_status"),
        as_date(F.min("trade_date")).alias("first_trade_date"),
        as_date(F.max("trade_date")).alias("last_trade_date"),
    )


def _bonds(trades: DataFrame) -> DataFrame:
    return trades.where(F.col("instrument_type") == "BOND")


def fi_duration_analysis(trades: DataFrame, *, as_of) -> DataFrame:
    bucket = _term(days(on_date(as_of), "maturity_date"))
    return (
        _bonds(trades)
        .groupBy("currency", bucket.alias("maturity_bucket"))
        .agg(
            _n().alias("total_positions"),
            F.sum("notional").alias("total_notional"),
            F.sum("base_gross_amount").alias("total_notional_chf"),
            rnd(weighted_mean("duration", F.abs("notional"))).alias("weighted_avg_duration"),
            F.sum("dv01").alias("total_dv01_chf"),
            F.min("duration").alias("min_duration"),
            F.max("duration").alias("max_duration"),
        )
    )


def fi_credit_exposure(trades: DataFrame) -> DataFrame:
    grouped = (
        _bonds(trades)
        .groupBy("credit_rating", "issuer_type")
        .agg(
            _n().alias("total_positions"),
            F.sum(_base()).alias("total_notional_chf"),
            rnd(mean("credit_spread_bps")).alias("average_credit_spread_bps"),
            F.sum("dv01").alias("total_dv01_chf"),
        )
    )
    # the total is summed from the groups: a few rows, one more pass over the groups only
    return attach_total(grouped, _all=F.sum("total_notional_chf")).select(
        *grouped.columns, pct("total_notional_chf", "_all").alias("concentration_percentage")
    )


def fi_yield_curve(trades: DataFrame, *, as_of, min_n: int = 3) -> DataFrame:
    today = on_date(as_of)
    years = rnd(days(today, "maturity_date") / 365.0, 0).cast("bigint")
    return (
        _bonds(trades)
        .where(F.col("maturity_date") > today)
        .groupBy("currency", years.alias("maturity_years"))
        .agg(
            rnd(mean("coupon_rate")).alias("average_yield"),
            rnd(mean("credit_spread_bps")).alias("average_credit_spread_bps"),
            _n().alias("trade_count"),
        )
        .where(F.col("trade_count") >= min_n)
    )


REGIMES = [(50, "EXTREME"), (30, "HIGH"), (15, "NORMAL")]


def cmd_trade_summary(trades: DataFrame) -> DataFrame:
    return trades.withColumns(
        {
            "side_description": choose("side", {"1": "BUY", "2": "SELL"}, "UNKNOWN"),
            "trade_value_category": _size((1000000, 100000, 10000)),
            "volatility_regime": at_least("volatility", REGIMES, "LOW"),
        }
    )


def cmd_positions(trades: DataFrame) -> DataFrame:
    qty = F.col("quantity")
    net = _signed("quantity")
    return trades.groupBy(
        "account_id", "customer_id", "commodity_type", "commodity_name", "commodity_code", "unit"
    ).agg(
        net.alias("total_quantity"),
        sum_if(_buy(), qty).alias("total_buy_quantity"),
        sum_if(_sell(), qty).alias("total_sell_quantity"),
        _n().alias("total_trades"),
        F.sum(_base()).alias("total_investment_chf"),
        F.sum("base_net_amount").alias("net_investment_chf"),
        _realized("quantity").alias("realized_pl_chf"),
        rnd(ratio(F.sum(F.col("price") * qty), F.sum(qty))).alias("average_price"),
        F.sum("delta").alias("total_delta_chf"),
        rnd(mean("volatility")).alias("average_volatility"),
        _standing(net).alias("position_status"),
        F.min("trade_date").alias("first_trade_date"),
        F.max("trade_date").alias("last_trade_date"),
    )


def cmd_delta_exposure(trades: DataFrame) -> DataFrame:
    size = F.abs("delta")
    grouped = trades.groupBy("commodity_type").agg(
        _n().alias("total_positions"),
        F.count_if(_buy()).alias("long_positions"),
        F.count_if(_sell()).alias("short_positions"),
        F.sum(size).alias("total_delta_chf"),
        sum_if(_buy(), size).alias("long_delta_chf"),
        sum_if(_sell(), size).alias("short_delta_chf"),
        _signed("delta").alias("net_delta_chf"),
        F.max(_base()).alias("largest_single_position_chf"),
        F.sum(_base()).alias("_value"),
    )
    out = attach_total(grouped, _all=F.sum("_value"))
    return out.withColumn("concentration_percentage", pct("_value", "_all")).drop("_value", "_all")


def cmd_volatility(trades: DataFrame) -> DataFrame:
    vol = mean("volatility")
    return trades.groupBy("commodity_name", "commodity_type").agg(
        rnd(vol).alias("current_volatility"),
        rnd(F.min("volatility")).alias("min_volatility"),
        rnd(F.max("volatility")).alias("max_volatility"),
        at_least(vol, REGIMES, "LOW").alias("volatility_regime"),
        _n().alias("trade_count"),
        F.sum(_base()).alias("total_value_chf"),
    )


def cmd_delivery_schedule(trades: DataFrame) -> DataFrame:
    qty = F.col("quantity")
    return (
        trades.where(F.col("delivery_month").isNotNull() & F.col("contract_type").isin("FUTURE", "FORWARD"))
        .groupBy("delivery_month", "delivery_location", "commodity_type", "commodity_name", "unit")
        .agg(
            sum_if(_sell(), qty).alias("total_quantity_to_deliver"),
            sum_if(_buy(), qty).alias("total_quantity_to_receive"),
            _signed("quantity").alias("net_delivery_obligation"),
            _n().alias("contract_count"),
            F.min("trade_date").alias("earliest_trade_date"),
        )
    )


# ---- equity reports ---------------------------------------------------------------------------


def equity_summary(trades: DataFrame, accounts: DataFrame) -> DataFrame:
    """Per customer and account; the account currency is attached after the aggregate."""
    per_account = trades.groupBy("customer_id", "account_id").agg(
        _n().alias("total_trades"),
        F.count_if(_buy()).alias("buy_trades"),
        F.count_if(_sell()).alias("sell_trades"),
        F.countDistinct("symbol").alias("unique_symbols"),
        F.sum(_base()).alias("total_chf_volume"),
        F.sum("base_gross_amount").alias("net_chf_position"),
        rnd(F.sum("commission")).alias("total_commission_chf"),
        rnd(mean(_base())).alias("avg_trade_size_chf"),
        as_date(F.min("trade_date")).alias("first_trade_date"),
        as_date(F.max("trade_date")).alias("last_trade_date"),
    )
    return per_account.join(accounts.select("account_id", "base_currency"), "account_id", "left")


def equity_positions_by_security(trades: DataFrame) -> DataFrame:
    qty = F.col("quantity")
    return trades.groupBy("symbol", "isin").agg(
        F.countDistinct("customer_id").alias("unique_customers"),
        _signed("quantity").alias("net_position"),
        sum_if(_buy(), qty).alias("total_bought"),
        sum_if(_sell(), qty).alias("total_sold"),
        _n().alias("total_trades"),
        F.sum(_base()).alias("total_chf_volume"),
        rnd(mean("price"), 4).alias("avg_price"),
        rnd(F.min("price"), 4).alias("min_price"),
        rnd(F.max("price"), 4).alias("max_price"),
        as_date(F.max("trade_date")).alias("last_trade_date"),
    )


def equity_currency_exposure(trades: DataFrame, base_ccy: str = "CHF") -> DataFrame:
    """Trades in foreign currencies, from one scan; the few currencies are spread by customer and symbol."""
    found = cells(
        trades.where(F.col("currency") != base_ccy),
        ["currency"],
        {"customer": F.col("customer_id"), "symbol": F.col("symbol")},
        F.sum(F.abs("gross_amount")).alias("original"),
        F.sum(_base()).alias("volume"),
        F.sum("fx_rate").alias("rates"),
        F.count("fx_rate").alias("rated"),
        F.min("fx_rate").alias("low"),
        F.max("fx_rate").alias("high"),
    )

    def total(name: str):
        return F.sum(F.when(F.col("kind") == "customer", F.col(name)))

    return found.groupBy("currency").agg(
        total("n").alias("trade_count"),
        total("original").alias("total_original_volume"),
        total("volume").alias("total_chf_volume"),
        rnd(ratio(total("rates"), total("rated")), 6).alias("avg_fx_rate"),
        F.min("low").alias("min_fx_rate"),
        F.max("high").alias("max_fx_rate"),
        cell_distinct("customer").alias("unique_customers"),
        cell_distinct("symbol").alias("unique_symbols"),
    )


def high_value_equity_trades(trades: DataFrame, threshold: int = 100000) -> DataFrame:
    return (
        trades.where(_base() > threshold)
        .select(
            as_date("trade_date").alias("trade_date"), "customer_id", "account_id", "trade_id", "symbol", "side",
            "quantity", rnd("price", 4).alias("price"), _base().alias("chf_value"), "market", "venue",
        )
        .orderBy(F.desc("chf_value"))
    )
