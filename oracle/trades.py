"""Trade, position and portfolio queries."""

from oracle import QUERIES, VIEWS, d, mean, pct, r
from oracle.bank import AS_OF

PERF_BACK = 1500
EQ_DEC = "quantity price gross_amount commission net_amount base_gross_amount base_net_amount fx_rate".split()
FI_DEC = "notional price gross_amount commission net_amount base_gross_amount base_net_amount fx_rate coupon_rate duration dv01 credit_spread_bps liquidity_score".split()
CMD_DEC = [*EQ_DEC, *"delta spot_price forward_price volatility liquidity_score".split()]


def _dbl(cols):
    return ", ".join(f"{d(x)} AS {x}" for x in cols)


B, S, BASE = "side = '1'", "side = '2'", "abs(base_gross_amount)"
_if = lambda cond, x: f"sum(CASE WHEN {cond} THEN {x} ELSE 0 END)"
_cnt = lambda cond: f"count(CASE WHEN {cond} THEN 1 END)"
_net = lambda x: f"sum(CASE WHEN {B} THEN {x} ELSE -{x} END)"
_size = lambda a, b, c: f"CASE WHEN {BASE} >= {a} THEN 'VERY_LARGE' WHEN {BASE} >= {b} THEN 'LARGE' WHEN {BASE} >= {c} THEN 'MEDIUM' ELSE 'SMALL' END"
_pos = lambda x: f"CASE WHEN {x} > 0 THEN 'LONG' WHEN {x} < 0 THEN 'SHORT' ELSE 'CLOSED' END"


def _real(m):
    return r(
        f"CAST({_if(S, BASE)} AS DOUBLE) - CASE WHEN {_if(S, m)} > 0 AND {_if(B, m)} > 0 THEN CAST({_if(B, BASE)} AS DOUBLE) / CAST({_if(B, m)} AS DOUBLE) * CAST({_if(S, m)} AS DOUBLE) ELSE 0 END"
    )


BPS = "CASE WHEN abs(gross_amount) > 0 THEN CAST(commission AS DOUBLE) / CAST(abs(gross_amount) AS DOUBLE) * 10000 ELSE 0 END"
QUERIES["equity_trade_summary"] = f"""
  SELECT * REPLACE ({_dbl(EQ_DEC)}), CASE side WHEN '1' THEN 'BUY' WHEN '2' THEN 'SELL' ELSE 'UNKNOWN' END AS side_description, {r(BPS)} AS commission_rate_bps, {_size(1000000, 100000, 10000)} AS trade_value_category,
    date_diff('day', CAST(trade_date AS DATE), settlement_date) AS settlement_days, year(trade_date) AS trade_year, month(trade_date) AS trade_month, dayofweek(trade_date) + 1 AS trade_day_of_week FROM in_equity_trades"""
VIEWS["eq_pos"] = f"""
  SELECT account_id, customer_id, symbol, isin, currency, {_net('quantity')} AS total_quantity, {_if(B, 'quantity')} AS total_buys, {_if(S, 'quantity')} AS total_sells,
    coalesce({r(f"CAST({_if(B, 'quantity * price')} AS DOUBLE) / nullif(CAST({_if(B, 'quantity')} AS DOUBLE), 0)", 6)}, 0) AS average_buy_price,
    coalesce({r(f"CAST({_if(S, 'quantity * price')} AS DOUBLE) / nullif(CAST({_if(S, 'quantity')} AS DOUBLE), 0)", 6)}, 0) AS average_sell_price,
    {_if(B, 'abs(gross_amount)')} AS total_buy_amount, {_if(S, 'abs(gross_amount)')} AS total_sell_amount, {r('sum(commission)')} AS total_commission,
    {r(f"{_if(B, 'abs(gross_amount)')} - {_if(S, 'abs(gross_amount)')} + sum(commission)")} AS net_investment, {_if(B, BASE)} AS total_buy_amount_chf, {_if(S, BASE)} AS total_sell_amount_chf,
    {_if(B, BASE)} - {_if(S, BASE)} AS net_investment_chf, {_real('quantity')} AS realized_pl_chf, {_pos(_net('quantity'))} AS position_status,
    CAST(min(trade_date) AS DATE) AS first_trade_date, CAST(max(trade_date) AS DATE) AS last_trade_date, count(*) AS trade_count, date_diff('day', CAST(min(trade_date) AS DATE), {AS_OF}) AS holding_days
  FROM in_equity_trades GROUP BY 1, 2, 3, 4, 5"""
QUERIES["equity_positions"] = f"SELECT * REPLACE ({_dbl('total_quantity total_buys total_sells total_buy_amount total_sell_amount total_buy_amount_chf total_sell_amount_chf net_investment_chf'.split())}) FROM eq_pos"
_mode = lambda v, n: f"(SELECT customer_id, {v} AS {n}, n AS {n}_n FROM (SELECT customer_id, {v}, count(*) AS n, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, {v}) AS rn FROM in_equity_trades GROUP BY 1, 2) WHERE rn = 1)"
QUERIES["equity_customer_activity"] = f"""
  SELECT t.*, most_traded_symbol, most_traded_symbol_n AS most_traded_symbol_count, preferred_market, preferred_order_type FROM (
    SELECT customer_id, count(*) AS total_trades, {_cnt(B)} AS total_buy_trades, {_cnt(S)} AS total_sell_trades, count(DISTINCT symbol) AS unique_symbols, count(DISTINCT account_id) AS unique_accounts,
      {d(f'sum({BASE})')} AS total_volume_chf, {r('sum(commission)')} AS total_commission_chf, {r(mean(BASE))} AS average_trade_size_chf, {d(f'max({BASE})')} AS largest_trade_chf, {r(f'avg({BPS})')} AS average_commission_bps,
      CAST(min(trade_date) AS DATE) AS first_trade_date, CAST(max(trade_date) AS DATE) AS last_trade_date, count(DISTINCT CAST(trade_date AS DATE)) AS trading_days, date_diff('day', CAST(min(trade_date) AS DATE), {AS_OF}) AS customer_tenure_days,
      {r("CASE WHEN date_diff('month', min(trade_date), max(trade_date)) > 0 THEN CAST(count(*) AS DOUBLE) / date_diff('month', min(trade_date), max(trade_date)) ELSE count(*) END")} AS average_trades_per_month,
      CASE WHEN count(*) >= 100 THEN 'VERY_ACTIVE' WHEN count(*) >= 50 THEN 'ACTIVE' WHEN count(*) >= 20 THEN 'MODERATE' WHEN count(*) >= 5 THEN 'OCCASIONAL' ELSE 'INACTIVE' END AS trader_category FROM in_equity_trades GROUP BY 1) t
  JOIN {_mode('symbol', 'most_traded_symbol')} a USING (customer_id) JOIN {_mode('market', 'preferred_market')} b USING (customer_id) JOIN {_mode('order_type', 'preferred_order_type')} c USING (customer_id)"""

_left = f"date_diff('day', {AS_OF}, maturity_date)"
_term = f"CASE WHEN {_left} <= 365 THEN 'SHORT_TERM' WHEN {_left} <= 1825 THEN 'MEDIUM_TERM' ELSE 'LONG_TERM' END"
_wd = r("CAST(sum(duration * abs(notional)) AS DOUBLE) / nullif(CAST(sum(abs(notional)) AS DOUBLE), 0)")
QUERIES["fi_trade_summary"] = f"""
  SELECT * REPLACE ({_dbl(FI_DEC)}), CASE side WHEN '1' THEN 'BUY/PAY' WHEN '2' THEN 'SELL/RECEIVE' ELSE 'UNKNOWN' END AS side_description, {_left} AS days_to_maturity, {_size(10000000, 1000000, 100000)} AS trade_value_category, {_term} AS maturity_bucket FROM in_fi_trades"""
VIEWS["fi_pos"] = f"""
  SELECT account_id, customer_id, instrument_type, issuer, issuer_type, credit_rating, currency, {_net('notional')} AS total_notional, count(*) AS total_trades, {_cnt(B)} AS total_buy_trades, {_cnt(S)} AS total_sell_trades,
    sum({BASE}) AS total_investment_chf, sum(base_net_amount) AS net_investment_chf, {_real('notional')} AS realized_pl_chf, {_wd} AS average_duration, sum(dv01) AS total_dv01_chf, {r(mean('credit_spread_bps'))} AS average_credit_spread_bps,
    {_pos(_net('notional'))} AS position_status, CAST(min(trade_date) AS DATE) AS first_trade_date, CAST(max(trade_date) AS DATE) AS last_trade_date FROM in_fi_trades GROUP BY 1, 2, 3, 4, 5, 6, 7"""
QUERIES["fi_positions"] = f"SELECT * REPLACE ({_dbl('total_notional total_investment_chf net_investment_chf total_dv01_chf'.split())}) FROM fi_pos"
QUERIES["fi_duration_analysis"] = f"""
  SELECT currency, {_term} AS maturity_bucket, count(*) AS total_positions, {d('sum(notional)')} AS total_notional, {d('sum(base_gross_amount)')} AS total_notional_chf, {_wd} AS weighted_avg_duration, {d('sum(dv01)')} AS total_dv01_chf,
    {d('min(duration)')} AS min_duration, {d('max(duration)')} AS max_duration FROM in_fi_trades WHERE instrument_type = 'BOND' GROUP BY 1, 2"""
QUERIES["fi_credit_exposure"] = f"""
  SELECT credit_rating, issuer_type, count(*) AS total_positions, {d(f'sum({BASE})')} AS total_notional_chf, {r(mean('credit_spread_bps'))} AS average_credit_spread_bps, {d('sum(dv01)')} AS total_dv01_chf,
    {pct(f'sum({BASE})', f"(SELECT sum({BASE}) FROM in_fi_trades WHERE instrument_type = 'BOND')")} AS concentration_percentage FROM in_fi_trades WHERE instrument_type = 'BOND' GROUP BY 1, 2"""
QUERIES["fi_yield_curve"] = f"""
  SELECT currency, CAST({r(f'{_left} / 365.0', 0)} AS BIGINT) AS maturity_years, {r(mean('coupon_rate'))} AS average_yield, {r(mean('credit_spread_bps'))} AS average_credit_spread_bps, count(*) AS trade_count
  FROM in_fi_trades WHERE instrument_type = 'BOND' AND maturity_date > {AS_OF} GROUP BY 1, 2 HAVING count(*) >= 3"""

_reg = lambda v: f"CASE WHEN {v} >= 50 THEN 'EXTREME' WHEN {v} >= 30 THEN 'HIGH' WHEN {v} >= 15 THEN 'NORMAL' ELSE 'LOW' END"
QUERIES["cmd_trade_summary"] = f"""
  SELECT * REPLACE ({_dbl(CMD_DEC)}), CASE side WHEN '1' THEN 'BUY' WHEN '2' THEN 'SELL' ELSE 'UNKNOWN' END AS side_description, {_size(1000000, 100000, 10000)} AS trade_value_category, {_reg('volatility')} AS volatility_regime FROM in_cmd_trades"""
VIEWS["cmd_pos"] = f"""
  SELECT account_id, customer_id, commodity_type, commodity_name, commodity_code, unit, {_net('quantity')} AS total_quantity, {_if(B, 'quantity')} AS total_buy_quantity, {_if(S, 'quantity')} AS total_sell_quantity, count(*) AS total_trades,
    sum({BASE}) AS total_investment_chf, sum(base_net_amount) AS net_investment_chf, {_real('quantity')} AS realized_pl_chf, {r('CAST(sum(price * quantity) AS DOUBLE) / nullif(CAST(sum(quantity) AS DOUBLE), 0)')} AS average_price,
    sum(delta) AS total_delta_chf, {r(mean('volatility'))} AS average_volatility, {_pos(_net('quantity'))} AS position_status, min(trade_date) AS first_trade_date, max(trade_date) AS last_trade_date FROM in_cmd_trades GROUP BY 1, 2, 3, 4, 5, 6"""
QUERIES["cmd_positions"] = f"SELECT * REPLACE ({_dbl('total_quantity total_buy_quantity total_sell_quantity total_investment_chf net_investment_chf total_delta_chf'.split())}) FROM cmd_pos"
QUERIES["cmd_delta_exposure"] = f"""
  SELECT commodity_type, count(*) AS total_positions, {_cnt(B)} AS long_positions, {_cnt(S)} AS short_positions, {d('sum(abs(delta))')} AS total_delta_chf, {d(_if(B, 'abs(delta)'))} AS long_delta_chf, {d(_if(S, 'abs(delta)'))} AS short_delta_chf,
    {d(_net('delta'))} AS net_delta_chf, {d(f'max({BASE})')} AS largest_single_position_chf, {pct(f'sum({BASE})', f'(SELECT sum({BASE}) FROM in_cmd_trades)')} AS concentration_percentage FROM in_cmd_trades GROUP BY 1"""
QUERIES["cmd_volatility"] = f"""
  SELECT commodity_name, commodity_type, {r(mean('volatility'))} AS current_volatility, {r('min(volatility)')} AS min_volatility, {r('max(volatility)')} AS max_volatility, {_reg(mean('volatility'))} AS volatility_regime, count(*) AS trade_count, {d(f'sum({BASE})')} AS total_value_chf
  FROM in_cmd_trades GROUP BY 1, 2"""
QUERIES["cmd_delivery_schedule"] = f"""
  SELECT delivery_month, delivery_location, commodity_type, commodity_name, unit, {d(_if(S, 'quantity'))} AS total_quantity_to_deliver, {d(_if(B, 'quantity'))} AS total_quantity_to_receive, {d(_net('quantity'))} AS net_delivery_obligation,
    count(*) AS contract_count, min(trade_date) AS earliest_trade_date FROM in_cmd_trades WHERE delivery_month IS NOT NULL AND contract_type IN ('FUTURE','FORWARD') GROUP BY 1, 2, 3, 4, 5"""
QUERIES["equity_summary"] = f"""
  SELECT t.customer_id, t.account_id, a.base_currency, count(*) AS total_trades, {_cnt(B)} AS buy_trades, {_cnt(S)} AS sell_trades, count(DISTINCT symbol) AS unique_symbols, {d(f'sum({BASE})')} AS total_chf_volume, {d('sum(base_gross_amount)')} AS net_chf_position,
    {r('sum(commission)')} AS total_commission_chf, {r(mean(BASE))} AS avg_trade_size_chf, CAST(min(trade_date) AS DATE) AS first_trade_date, CAST(max(trade_date) AS DATE) AS last_trade_date
  FROM in_equity_trades t LEFT JOIN in_accounts a ON t.account_id = a.account_id GROUP BY 1, 2, 3"""
QUERIES["equity_positions_by_security"] = f"""
  SELECT symbol, isin, count(DISTINCT customer_id) AS unique_customers, {d(_net('quantity'))} AS net_position, {d(_if(B, 'quantity'))} AS total_bought, {d(_if(S, 'quantity'))} AS total_sold, count(*) AS total_trades, {d(f'sum({BASE})')} AS total_chf_volume,
    {r(mean('price'), 4)} AS avg_price, {r('min(price)', 4)} AS min_price, {r('max(price)', 4)} AS max_price, CAST(max(trade_date) AS DATE) AS last_trade_date FROM in_equity_trades GROUP BY 1, 2"""
QUERIES["equity_currency_exposure"] = f"""
  SELECT currency, count(*) AS trade_count, {d('sum(abs(gross_amount))')} AS total_original_volume, {d(f'sum({BASE})')} AS total_chf_volume, {r(mean('fx_rate'), 6)} AS avg_fx_rate, {d('min(fx_rate)')} AS min_fx_rate, {d('max(fx_rate)')} AS max_fx_rate,
    count(DISTINCT customer_id) AS unique_customers, count(DISTINCT symbol) AS unique_symbols FROM in_equity_trades WHERE currency <> 'CHF' GROUP BY 1"""
QUERIES["high_value_equity_trades"] = f"""
  SELECT CAST(trade_date AS DATE) AS trade_date, customer_id, account_id, trade_id, symbol, side, {d('quantity')} AS quantity, {r('price', 4)} AS price, {d(BASE)} AS chf_value, market, venue FROM in_equity_trades WHERE {BASE} > 100000"""

# ---- portfolio --------------------------------------------------------------------------------
_since = lambda ts: f"{ts} >= {AS_OF} - INTERVAL {PERF_BACK} DAY"


def _flow(k, table):
    inv = _if(B, BASE) if k == "eq" else f"sum({BASE})"
    pl = f"{_if(S, BASE)} - {_if(B, BASE)}" if k == "eq" else f"sum(CASE WHEN {S} THEN {BASE} ELSE -{BASE} END)"
    return f"(SELECT account_id, count(*) AS {k}_n, {_cnt(B)} AS {k}_b, {_cnt(S)} AS {k}_s, {inv} AS {k}_inv, {pl} AS {k}_pl, sum(commission) AS {k}_fee, count(DISTINCT CAST(trade_date AS DATE)) AS {k}_days FROM {table} WHERE {_since('trade_date')} GROUP BY 1)"


def _open(k, view):
    return f"(SELECT account_id, count(*) AS {k}_open, sum(net_investment_chf) AS {k}_val FROM {view} WHERE position_status <> 'CLOSED' GROUP BY 1)"


_z = lambda x: f"coalesce({x}, 0)"
_ret = lambda k: r(f"CASE WHEN {_z(k + '_inv')} > 0 THEN (CAST({_z(k + '_pl')} AS DOUBLE) - CAST({_z(k + '_fee')} AS DOUBLE)) / CAST({k}_inv AS DOUBLE) * 100 ELSE 0 END", 4)
_sh = lambda v, e: r(f"CASE WHEN tot > 0 THEN CAST({v} AS DOUBLE) / CAST(tot AS DOUBLE) * 100 ELSE {e} END")
_blk = lambda k, p: f"{_z(k + '_n')} AS {p}_trades_count, {_z(k + '_b')} AS {p}_buy_trades, {_z(k + '_s')} AS {p}_sell_trades, {d(_z(k + '_inv'))} AS {p}_total_invested_chf, {r(_z(k + '_fee'))} AS {p}_commission_chf, {_ret(k)} AS {p}_return_percentage"
VIEWS["perf"] = f"""
  SELECT account_id, customer_id, account_type, base_currency, measurement_period_start, measurement_period_end, nd AS days_in_period, {d('op')} AS cash_starting_balance, {d('cash')} AS cash_ending_balance, {d(_z('dep'))} AS cash_deposits, {d(_z('wd'))} AS cash_withdrawals,
    {d(_z('nf'))} AS cash_net_flow, {r('ct', 4)} AS cash_twr_percentage, {_blk('eq', 'equity')}, {d(_z('eq_pl'))} AS equity_realized_pl_chf, {r('xnet')} AS equity_net_return_chf, {_blk('fi', 'fi')}, {d(_z('fi_pl'))} AS fi_net_pl_chf, {_blk('cm', 'cmd')}, {d(_z('cm_pl'))} AS cmd_net_pl_chf,
    {d('cash')} AS current_cash_value_chf, {_z('eq_open')} AS current_equity_positions, {d(_z('eq_val'))} AS current_equity_value_chf, {_z('fi_open')} AS current_fi_positions, {d(_z('fi_val'))} AS current_fi_value_chf, {_z('cm_open')} AS current_cmd_positions, {d(_z('cm_val'))} AS current_cmd_value_chf,
    {d('tot')} AS total_portfolio_value_chf, {_sh('cash', 100)} AS cash_allocation_percentage, {_sh(_z('eq_val'), 0)} AS equity_allocation_percentage, {_sh(_z('fi_val'), 0)} AS fi_allocation_percentage, {_sh(_z('cm_val'), 0)} AS cmd_allocation_percentage,
    {r('twr', 4)} AS total_portfolio_twr_percentage, {r(f"CASE WHEN bal IS NULL THEN -{_z('nf')} ELSE 0 END + xnet")} AS total_return_chf,
    {r('CASE WHEN nd >= 30 THEN least(greatest(CASE WHEN 1 + twr / 100 > 0 THEN (pow(1 + twr / 100, CAST(365 AS DOUBLE) / nd) - 1) * 100 ELSE -100 END, -10000), 10000) ELSE 0 END', 4)} AS annualized_portfolio_twr,
    CAST(0 AS DOUBLE) AS portfolio_volatility, CAST(0 AS DOUBLE) AS sharpe_ratio, CAST(3.5 AS DOUBLE) AS risk_free_rate_annual_pct, CAST(0 AS DOUBLE) AS max_drawdown_percentage, {_z('cn')} + {_z('eq_n')} AS total_transactions,
    {r(f"CASE WHEN nd > 0 THEN ({_z('cn')} + {_z('eq_n')}) * CAST(30 AS DOUBLE) / nd ELSE 0 END")} AS transaction_frequency, greatest({_z('cd')}, {_z('eq_days')}) AS trading_days,
    CASE WHEN twr >= 15 THEN 'EXCELLENT_PERFORMANCE' WHEN twr >= 8 THEN 'GOOD_PERFORMANCE' WHEN twr >= 2 THEN 'NEUTRAL_PERFORMANCE' WHEN twr >= 0 THEN 'POOR_PERFORMANCE' ELSE 'NEGATIVE_PERFORMANCE' END AS performance_category, 'LOW_RISK' AS risk_category,
    CASE WHEN eq_n IS NULL AND fi_n IS NULL AND cm_n IS NULL THEN 'CASH_ONLY' WHEN eq_n > 0 AND fi_n > 0 AND cm_n > 0 THEN 'MULTI_ASSET' WHEN eq_n > 0 AND (fi_n > 0 OR cm_n > 0) THEN 'BALANCED' WHEN eq_n > 0 THEN 'EQUITY_FOCUSED' WHEN fi_n > 0 THEN 'FI_FOCUSED' ELSE 'COMMODITY_FOCUSED' END AS portfolio_type
  FROM (SELECT *, CASE WHEN op + inv > 0 THEN ct * op / (op + inv) ELSE ct END + CASE WHEN op + inv > 0 THEN et * inv / (op + inv) ELSE 0 END AS twr FROM (
    SELECT *, CASE WHEN op > 0 THEN (CAST(cash AS DOUBLE) - op - CAST({_z('nf')} AS DOUBLE)) / op * 100 ELSE 0 END AS ct, CASE WHEN inv > 0 THEN net / inv * 100 ELSE 0 END AS et FROM (
    SELECT *, CAST({_z('eq_pl')} - {_z('eq_fee')} AS DOUBLE) AS net, {_z('eq_pl')} - {_z('eq_fee')} AS xnet, CAST({_z('eq_inv')} AS DOUBLE) AS inv, {_z('bal')} AS cash, CAST(CASE WHEN bal IS NULL THEN 0 ELSE bal - {_z('nf')} END AS DOUBLE) AS op,
      coalesce(s, {AS_OF} - {PERF_BACK}) AS measurement_period_start, coalesce(e, {AS_OF}) AS measurement_period_end, coalesce(date_diff('day', s, e), {PERF_BACK}) AS nd,
      {_z('bal')} + {_z('eq_val')} + {_z('fi_val')} + {_z('cm_val')} AS tot
    FROM (SELECT account_id, min(CAST(booking_date AS DATE)) AS s, max(CAST(booking_date AS DATE)) AS e, sum(CASE WHEN amount > 0 THEN amount ELSE 0 END) AS dep, sum(CASE WHEN amount < 0 THEN -amount ELSE 0 END) AS wd, sum(amount) AS nf, count(*) AS cn,
        count(DISTINCT CAST(booking_date AS DATE)) AS cd FROM in_transactions WHERE {_since('booking_date')} GROUP BY 1) c
    FULL JOIN {_flow('eq', 'in_equity_trades')} q USING (account_id) FULL JOIN {_flow('fi', 'in_fi_trades')} f USING (account_id) FULL JOIN {_flow('cm', 'in_cmd_trades')} m USING (account_id)
    LEFT JOIN (SELECT account_id, current_balance_base AS bal FROM balances) b USING (account_id) LEFT JOIN {_open('eq', 'eq_pos')} p1 USING (account_id) LEFT JOIN {_open('fi', 'fi_pos')} p2 USING (account_id) LEFT JOIN {_open('cm', 'cmd_pos')} p3 USING (account_id)
    LEFT JOIN (SELECT account_id, customer_id, account_type, base_currency FROM in_accounts) a USING (account_id)) x) y) z
  WHERE op > 0 OR inv > 0 OR fi_inv > 0 OR cm_inv > 0"""
QUERIES["portfolio_performance"] = "SELECT * FROM perf"
