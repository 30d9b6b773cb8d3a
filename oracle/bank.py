"""Customer, screening and payment queries."""

from oracle import QUERIES, VIEWS, d, mean, pct, r, same

AS_OF = "DATE '2001-08-02'"
BACK = 3650
KINDS = "ONBOARDING ACCOUNT_CLOSE ACCOUNT_UPGRADE ACCOUNT_DOWNGRADE ADDRESS_CHANGE EMPLOYMENT_CHANGE REACTIVATION CHURN"


def _history(src: str, extra: str = "") -> str:
    lead = "lead(insert_timestamp_utc) OVER (PARTITION BY customer_id ORDER BY insert_timestamp_utc, version_id)"
    return f"""SELECT * EXCLUDE (version_id) {extra}, CAST(insert_timestamp_utc AS DATE) AS valid_from,
      CAST({lead} AS DATE) - 1 AS valid_to, {lead} IS NULL AS is_current FROM {src}"""


def _current(src: str, extra: str = "") -> str:
    return f"""SELECT * EXCLUDE (version_id, insert_timestamp_utc, rn) {extra}, insert_timestamp_utc AS current_from, TRUE AS is_current
      FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY insert_timestamp_utc DESC, version_id DESC) AS rn FROM {src}) WHERE rn = 1"""


NAME = ", first_name || ' ' || family_name AS full_name"
VIEWS["addresses_current"] = _current("in_addresses")
VIEWS["addresses_history"] = _history("in_addresses")
VIEWS["customer_current"] = _current("in_customers", NAME)
VIEWS["customer_history"] = _history("in_customers", NAME)
for q in ("addresses_current", "addresses_history", "customer_current", "customer_history"):
    same(q)

VIEWS["customer_lifecycle"] = f"""
  SELECT *, idle <= 90 AS has_recent_activity, idle >= 180 AS is_dormant_lifecycle, idle AS days_since_last_event
  FROM (SELECT c.customer_id, first_name, family_name, full_name, onboarding_date,
      date_diff('day', onboarding_date, {AS_OF}) AS customer_age_days,
      {r(f"date_diff('day', onboarding_date, {AS_OF}) / 30.44")} AS customer_age_months,
      count(e.event_id) AS total_lifecycle_events, min(e.event_date) AS first_event_date, max(e.event_date) AS last_event_date,
      coalesce(date_diff('day', max(e.event_date), {AS_OF}), 9999) AS idle,
      {', '.join(f"count(CASE WHEN e.event_type = '{k}' THEN 1 END) AS {k.lower()}_count" for k in KINDS.split())},
      CASE WHEN count(e.event_id) = 0 THEN 0.0 ELSE least(100.0, count(e.event_id) * 10.0 +
        count(CASE WHEN e.event_date >= {AS_OF} - INTERVAL 3 MONTH THEN 1 END) * 5.0) END::DOUBLE AS engagement_score
    FROM customer_current c LEFT JOIN in_customer_events e ON c.customer_id = e.customer_id GROUP BY 1, 2, 3, 4, 5) q"""
QUERIES["customer_lifecycle"] = "SELECT * EXCLUDE (idle) FROM customer_lifecycle"

VIEWS["accounts_enriched"] = """
  SELECT account_id, account_type, base_currency, customer_id, status, status = 'ACTIVE' AS is_active,
    account_type = 'CHECKING' AS is_checking_account, account_type = 'SAVINGS' AS is_savings_account,
    account_type = 'BUSINESS' AS is_business_account, account_type = 'INVESTMENT' AS is_investment_account,
    base_currency = 'USD' AS is_usd_account, base_currency = 'EUR' AS is_eur_account,
    base_currency IN ('GBP','CHF','NOK','SEK','DKK') AS is_other_currency_account,
    CASE account_type WHEN 'CHECKING' THEN 1 WHEN 'SAVINGS' THEN 2 WHEN 'BUSINESS' THEN 3 WHEN 'INVESTMENT' THEN 4 ELSE 99 END AS account_type_priority,
    CASE WHEN base_currency IN ('EUR','GBP') THEN 'MAJOR_EUROPEAN' WHEN base_currency = 'USD' THEN 'USD_BASE'
      WHEN base_currency IN ('CHF','NOK','SEK','DKK') THEN 'OTHER_EUROPEAN' ELSE 'OTHER' END AS currency_group
  FROM in_accounts"""
same("accounts_enriched")

VIEWS["fx_enhanced"] = f"""
  SELECT date, from_currency, to_currency, from_currency || '/' || to_currency AS currency_pair, mid_rate, bid_rate, ask_rate,
    ask_rate - bid_rate AS spread_absolute, sp AS spread_percentage, mid_rate - prev AS daily_change_absolute,
    CASE WHEN prev > 0 THEN {r('CAST(mid_rate - prev AS DOUBLE) / CAST(prev AS DOUBLE) * 100', 4)} END AS daily_change_percentage,
    CASE WHEN prev IS NULL THEN 'NO_PREV_DATA' WHEN mid_rate > prev THEN 'APPRECIATING' WHEN mid_rate < prev THEN 'DEPRECIATING' ELSE 'STABLE' END AS trend_direction,
    {r('vol', 6)} AS volatility_30d, {r('avg7', 6)} AS moving_avg_7d, mn AS min_rate_30d, mx AS max_rate_30d,
    CASE WHEN mx > mn THEN {r('CAST(mid_rate - mn AS DOUBLE) / CAST(mx - mn AS DOUBLE) * 100')} END AS rate_position_percentage,
    CASE WHEN from_currency = 'CHF' THEN 'CHF_BASE' WHEN to_currency = 'CHF' THEN 'CHF_TARGET' ELSE 'CROSS_CURRENCY' END AS currency_pair_type,
    CASE WHEN from_currency IN ('CHF','USD','EUR','GBP') AND to_currency IN ('CHF','USD','EUR','GBP') THEN 'MAJOR_PAIR' ELSE 'MINOR_PAIR' END AS pair_classification,
    CASE WHEN sp IS NULL THEN 'UNKNOWN_SPREAD' WHEN sp > 1 THEN 'HIGH_SPREAD' WHEN sp > 0.5 THEN 'MEDIUM_SPREAD' ELSE 'LOW_SPREAD' END AS spread_risk_level,
    CASE WHEN vol IS NULL THEN 'UNKNOWN_VOLATILITY' WHEN vol > 0.05 THEN 'HIGH_VOLATILITY' WHEN vol > 0.02 THEN 'MEDIUM_VOLATILITY' ELSE 'LOW_VOLATILITY' END AS volatility_risk_level,
    date = {AS_OF} OR date = (SELECT max(date) FROM in_fx_rates) AS is_current_rate
  FROM (SELECT *, lag(mid_rate) OVER w AS prev, stddev_samp(CAST(mid_rate AS DOUBLE)) OVER (w ROWS 29 PRECEDING) AS vol,
      CAST(sum(mid_rate) OVER (w ROWS 6 PRECEDING) AS DOUBLE) / count(*) OVER (w ROWS 6 PRECEDING) AS avg7,
      min(mid_rate) OVER (w ROWS 29 PRECEDING) AS mn, max(mid_rate) OVER (w ROWS 29 PRECEDING) AS mx,
      CASE WHEN mid_rate > 0 THEN {r('CAST(ask_rate - bid_rate AS DOUBLE) / CAST(mid_rate AS DOUBLE) * 100', 4)} END AS sp
    FROM in_fx_rates WINDOW w AS (PARTITION BY from_currency, to_currency ORDER BY date)) q"""
DEC_FX = "mid_rate bid_rate ask_rate spread_absolute daily_change_absolute min_rate_30d max_rate_30d".split()
QUERIES["fx_enhanced"] = f"SELECT * REPLACE ({', '.join(f'{d(x)} AS {x}' for x in DEC_FX)}, {r('volatility_30d', 4)} AS volatility_30d) FROM fx_enhanced"

VIEWS["behaviour"] = f"""
  SELECT account_id, count(*) AS n, {mean('amount')} AS avg_amount, stddev_samp(CAST(amount AS DOUBLE)) AS sd_amount,
    min(amount) AS min_amount, max(amount) AS max_amount, quantile_cont(CAST(amount AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(amount AS DOUBLE), 0.5) AS q2,
    quantile_cont(CAST(amount AS DOUBLE), 0.75) AS q3, quantile_cont(CAST(amount AS DOUBLE), 0.95) AS q95,
    count(DISTINCT CAST(booking_date AS DATE)) AS days, CAST(count(*) AS DOUBLE) / count(DISTINCT CAST(booking_date AS DATE)) AS per_day,
    CAST(sum(hour(booking_date)) AS DOUBLE) / count(*) AS avg_hour, stddev_samp(hour(booking_date)) AS sd_hour,
    count(DISTINCT currency) AS ccys, count(DISTINCT counterparty_account) AS others,
    CAST(count(CASE WHEN dayofweek(booking_date) IN (0, 6) THEN 1 END) AS DOUBLE) / count(*) AS weekend
  FROM in_transactions WHERE booking_date >= {AS_OF} - INTERVAL {BACK} DAY AND booking_date < {AS_OF}
  GROUP BY account_id HAVING count(*) >= 5"""
QUERIES["behavioural_profile"] = f"""
  SELECT account_id, n AS total_transactions, avg_amount AS avg_transaction_amount, {r('sd_amount', 4)} AS stddev_transaction_amount,
    {d('min_amount')} AS min_transaction_amount, {d('max_amount')} AS max_transaction_amount, {r('q1', 4)} AS q1_amount,
    {r('q2', 4)} AS median_transaction_amount, {r('q3', 4)} AS q3_amount, {r('q95', 4)} AS large_transaction_threshold,
    days AS active_days, per_day AS avg_daily_transaction_count, avg_hour AS avg_transaction_hour, {r('sd_hour', 6)} AS stddev_transaction_hour,
    ccys AS distinct_currencies, others AS distinct_counterparties, weekend AS weekend_transaction_ratio FROM behaviour"""

VIEWS["scored"] = f"""
  SELECT transaction_id, account_id, customer_id, booking_date, value_date, amount, currency, counterparty_account, description,
    n AS customer_total_transactions, avg_amount AS avg_transaction_amount, q2 AS median_transaction_amount, per_day AS avg_daily_transaction_count,
    {r('az')} AS amount_anomaly_score, {r('tz')} AS timing_anomaly_score,
    CASE WHEN az >= 3 THEN 'EXTREME_AMOUNT_ANOMALY' WHEN az >= 2 THEN 'HIGH_AMOUNT_ANOMALY' WHEN az >= 1.5 THEN 'MODERATE_AMOUNT_ANOMALY' ELSE 'NORMAL_AMOUNT' END AS amount_anomaly_level,
    CASE WHEN tz >= 2 THEN 'HIGH_TIMING_ANOMALY' WHEN tz >= 1.5 THEN 'MODERATE_TIMING_ANOMALY' ELSE 'NORMAL_TIMING' END AS timing_anomaly_level,
    CASE WHEN v5 THEN 'HIGH_VELOCITY_ANOMALY' WHEN v3 THEN 'MODERATE_VELOCITY_ANOMALY' ELSE 'NORMAL_VELOCITY' END AS velocity_anomaly_level,
    big AS is_large_transaction, odd AS is_unusual_weekend_transaction, h < 6 OR h > 22 AS is_off_hours_transaction, sd AS settlement_days,
    sd > 5 AS is_delayed_settlement, sd < 0 AS is_backdated_settlement,
    {r('az * 0.35 + tz * 0.2 + CASE WHEN v3 THEN 0.5 ELSE 0 END + CASE WHEN odd THEN 0.1 ELSE 0 END + CASE WHEN sd > 5 THEN 0.15 ELSE 0 END')} AS composite_anomaly_score,
    CASE WHEN az >= 3 OR tz >= 2 OR v5 OR (big AND h < 6) OR sd < 0 THEN 'CRITICAL_ANOMALY'
      WHEN az >= 2 OR tz >= 1.5 OR v3 OR odd OR sd > 5 THEN 'HIGH_ANOMALY'
      WHEN az >= 1.5 OR tz >= 1 OR v2 OR sd > 3 THEN 'MODERATE_ANOMALY' ELSE 'NORMAL_BEHAVIOR' END AS overall_anomaly_classification,
    az >= 3 OR v5 OR sd < 0 AS requires_immediate_review, az >= 2 OR tz >= 2 OR v3 OR sd > 5 AS requires_enhanced_monitoring,
    l1 AS transactions_last_24h, l7 AS transactions_last_7d, h AS transaction_hour, dayofweek(booking_date) + 1 AS transaction_dayofweek
  FROM (SELECT *, l1 * days >= 5 * n AS v5, l1 * days >= 3 * n AS v3, l1 * days >= 2 * n AS v2,
      dayofweek(booking_date) IN (0, 6) AND weekend < 0.1 AS odd, CAST(amount AS DOUBLE) >= q95 AS big,
      CASE WHEN sd_amount > 0 THEN abs(CAST(amount AS DOUBLE) - avg_amount) / sd_amount ELSE 0 END AS az,
      CASE WHEN sd_hour > 0 THEN abs(h - avg_hour) / sd_hour ELSE 0 END AS tz
    FROM (SELECT t.*, b.* EXCLUDE (account_id), a.customer_id, hour(booking_date) AS h, date_diff('day', CAST(booking_date AS DATE), value_date) AS sd,
        count(*) OVER (PARTITION BY t.account_id ORDER BY CAST(booking_date AS DATE) RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) - 1 AS l1,
        count(*) OVER (PARTITION BY t.account_id ORDER BY CAST(booking_date AS DATE) RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) - 1 AS l7
      FROM in_transactions t LEFT JOIN behaviour b ON t.account_id = b.account_id LEFT JOIN in_accounts a ON t.account_id = a.account_id
      WHERE booking_date >= {AS_OF} - INTERVAL {BACK} DAY) q WHERE n IS NOT NULL) p"""
QUERIES["transaction_anomalies"] = (
    f"SELECT * REPLACE ({d('amount')} AS amount, {r('median_transaction_amount', 4)} AS median_transaction_amount) FROM scored"
)

VIEWS["balances"] = f"""
  SELECT a.account_id, a.customer_id, a.account_type, a.base_currency, a.status AS account_status,
    coalesce(bal, 0) AS current_balance_base, coalesce(cr, 0) AS total_credits_base, coalesce(db, 0) AS total_debits_base,
    {r("CASE WHEN a.base_currency = 'CHF' OR mid_rate IS NULL THEN CAST(coalesce(bal, 0) AS DOUBLE) ELSE CAST(coalesce(bal, 0) AS DOUBLE) * CAST(mid_rate AS DOUBLE) END")} AS current_balance_base_currency,
    coalesce(n, 0) AS total_transactions, coalesce(nc, 0) AS credit_transactions, coalesce(nd, 0) AS debit_transactions,
    {r('coalesce(av, 0)')} AS avg_transaction_amount_base, coalesce(mn, 0) AS min_transaction_amount_base, coalesce(mx, 0) AS max_transaction_amount_base,
    CASE WHEN coalesce(n, 0) = 0 THEN 'INACTIVE' WHEN coalesce(n30, 0) = 0 THEN 'DORMANT' WHEN n30 >= 20 THEN 'HIGH_ACTIVITY' WHEN n30 >= 5 THEN 'MODERATE_ACTIVITY' ELSE 'LOW_ACTIVITY' END AS activity_level,
    CASE WHEN coalesce(bal, 0) < 0 THEN 'OVERDRAWN' WHEN coalesce(bal, 0) = 0 THEN 'ZERO_BALANCE' WHEN bal < 900 THEN 'LOW_BALANCE' WHEN bal < 9000 THEN 'MODERATE_BALANCE'
      WHEN bal < 90000 THEN 'HIGH_BALANCE' ELSE 'VERY_HIGH_BALANCE' END AS balance_category,
    coalesce(bal, 0) < -900 AS is_overdrawn, coalesce(n30, 0) = 0 AND coalesce(n, 0) > 0 AS is_dormant, abs(coalesce(b30, 0)) > 45000 AS has_large_recent_movements,
    CAST(f AS DATE) AS first_transaction_date, CAST(l AS DATE) AS last_transaction_date, last_value_date,
    coalesce(n30, 0) AS recent_transactions_30d, coalesce(b30, 0) AS recent_balance_change_30d_base
  FROM accounts_enriched a LEFT JOIN (SELECT account_id, count(CASE WHEN base_amount <> 0 THEN 1 END) AS n, count(CASE WHEN base_amount > 0 THEN 1 END) AS nc,
      count(CASE WHEN base_amount < 0 THEN 1 END) AS nd, sum(base_amount) AS bal, sum(CASE WHEN base_amount > 0 THEN base_amount ELSE 0 END) AS cr,
      sum(CASE WHEN base_amount < 0 THEN -base_amount ELSE 0 END) AS db, {mean('base_amount')} AS av, min(base_amount) AS mn, max(base_amount) AS mx,
      min(booking_date) AS f, max(booking_date) AS l, max(value_date) AS last_value_date,
      count(CASE WHEN booking_date >= {AS_OF} - INTERVAL 30 DAY AND base_amount <> 0 THEN 1 END) AS n30,
      sum(CASE WHEN booking_date >= {AS_OF} - INTERVAL 30 DAY THEN base_amount ELSE 0 END) AS b30
    FROM in_transactions WHERE booking_date >= {AS_OF} - INTERVAL {BACK} DAY GROUP BY 1) t ON a.account_id = t.account_id
  LEFT JOIN (SELECT to_currency, arg_max(mid_rate, date) AS mid_rate FROM fx_enhanced WHERE is_current_rate AND from_currency = 'CHF' GROUP BY 1) f ON f.to_currency = a.base_currency
  WHERE a.is_active"""
DEC_BAL = "current_balance_base total_credits_base total_debits_base min_transaction_amount_base max_transaction_amount_base recent_balance_change_30d_base".split()
QUERIES["account_balances"] = f"SELECT * REPLACE ({', '.join(f'{d(x)} AS {x}' for x in DEC_BAL)}) FROM balances"

QUERIES["customer_transaction_summary"] = f"""
  SELECT a.customer_id, count(CASE WHEN value_date >= {AS_OF} - INTERVAL 12 MONTH THEN 1 END) AS total_transactions_12m, count(*) AS total_transactions_all_time,
    count(CASE WHEN value_date >= {AS_OF} - INTERVAL 12 MONTH AND amount < 0 THEN 1 END) AS debit_transactions,
    count(CASE WHEN value_date >= {AS_OF} - INTERVAL 12 MONTH AND amount > 0 THEN 1 END) AS credit_transactions,
    max(value_date) AS last_transaction_date, date_diff('day', max(value_date), {AS_OF}) AS days_since_last_transaction, min(value_date) AS first_transaction_date,
    {r(f"CAST(count(*) AS DOUBLE) / nullif(date_diff('month', min(value_date), {AS_OF}), 0)")} AS avg_monthly_transactions,
    count(DISTINCT date_trunc('month', value_date)) AS transaction_months_active, date_diff('day', max(value_date), {AS_OF}) >= 180 AS is_dormant_transactionally,
    count(CASE WHEN value_date >= {AS_OF} - INTERVAL 1 MONTH THEN 1 END) > 50 AS is_highly_active
  FROM in_transactions t JOIN in_accounts a ON t.account_id = a.account_id GROUP BY 1"""

TAG = r"regexp_matches(description, '\[.*\]')"
GAP = "date_diff('day', CAST(booking_date AS DATE), value_date)"
QUERIES["daily_transaction_summary"] = f"""
  SELECT CAST(booking_date AS DATE) AS transaction_date, count(*) AS transaction_count, count(DISTINCT customer_id) AS unique_customers,
    {d('sum(amount)')} AS total_base_amount, {r(mean('amount'))} AS avg_base_amount, count(CASE WHEN amount > 0 THEN 1 END) AS incoming_count,
    count(CASE WHEN amount < 0 THEN 1 END) AS outgoing_count, count(CASE WHEN {TAG} THEN 1 END) AS anomalous_count, count(DISTINCT currency) AS currency_count
  FROM scored GROUP BY 1"""
VIEWS["ccy_now"] = """SELECT currency, count(*) AS transaction_count, sum(amount) AS total_original_amount, sum(amount) AS total_chf_amount,
    count(DISTINCT customer_id) AS unique_customers FROM scored WHERE currency <> 'CHF' GROUP BY 1"""
QUERIES["currency_exposure_current"] = f"""
  SELECT currency, transaction_count, {d('total_original_amount')} AS total_original_amount, {d('total_chf_amount')} AS total_chf_amount, unique_customers,
    CAST(1 AS DOUBLE) AS avg_fx_rate, CAST(1 AS DOUBLE) AS min_fx_rate, CAST(1 AS DOUBLE) AS max_fx_rate FROM ccy_now"""
QUERIES["currency_exposure_history"] = f"""
  SELECT dt AS exposure_date, currency, n AS daily_transaction_count, {d('s')} AS daily_total_amount, {r('av')} AS daily_avg_amount, {d('mn')} AS daily_min_amount,
    {d('mx')} AS daily_max_amount, u AS daily_unique_customers, CAST(sum(n) OVER (w ROWS 6 PRECEDING) AS BIGINT) AS rolling_7d_transaction_count,
    {d('sum(s) OVER (w ROWS 6 PRECEDING)')} AS rolling_7d_total_amount,
    {r('CAST(sum(s) OVER (w ROWS 6 PRECEDING) AS DOUBLE) / count(*) OVER (w ROWS 6 PRECEDING)')} AS rolling_7d_avg_daily_amount,
    {d('lag(s, 30) OVER w')} AS amount_30_days_ago,
    CASE WHEN lag(s, 30) OVER w > 0 THEN {r('CAST(s - lag(s, 30) OVER w AS DOUBLE) / CAST(lag(s, 30) OVER w AS DOUBLE) * 100')} END AS growth_rate_30d_percent,
    CASE WHEN n > 100 THEN 'HIGH_VOLUME' WHEN n > 50 THEN 'MEDIUM_VOLUME' ELSE 'LOW_VOLUME' END AS daily_volume_category,
    CASE WHEN s > 1000000 THEN 'HIGH_EXPOSURE' WHEN s > 100000 THEN 'MEDIUM_EXPOSURE' ELSE 'LOW_EXPOSURE' END AS daily_exposure_category
  FROM (SELECT CAST(booking_date AS DATE) AS dt, currency, count(*) AS n, sum(amount) AS s, {mean('amount')} AS av, min(amount) AS mn, max(amount) AS mx,
    count(DISTINCT customer_id) AS u FROM scored WHERE currency <> 'CHF' GROUP BY 1, 2) q WINDOW w AS (PARTITION BY currency ORDER BY dt)"""
QUERIES["settlement_exposure"] = f"""
  SELECT value_date AS settlement_date, currency, count(*) AS settlement_transaction_count, {d('sum(amount)')} AS settlement_total_amount,
    {r(mean(GAP))} AS avg_settlement_days, count(CASE WHEN {GAP} = 0 THEN 1 END) AS same_day_settlements, count(CASE WHEN {GAP} = 1 THEN 1 END) AS t_plus_1_settlements,
    count(CASE WHEN {GAP} BETWEEN 2 AND 3 THEN 1 END) AS t_plus_2_3_settlements, count(CASE WHEN {GAP} > 5 THEN 1 END) AS delayed_settlements,
    count(CASE WHEN {GAP} < 0 THEN 1 END) AS backdated_settlements,
    CASE WHEN count(CASE WHEN {GAP} > 5 THEN 1 END) > 0 THEN 'HIGH_SETTLEMENT_RISK' WHEN count(CASE WHEN {GAP} > 3 THEN 1 END) > count(*) * 0.1 THEN 'MEDIUM_SETTLEMENT_RISK' ELSE 'LOW_SETTLEMENT_RISK' END AS settlement_risk_level,
    CASE WHEN dayofweek(value_date) IN (0, 6) THEN 'WEEKEND_SETTLEMENT' ELSE 'WEEKDAY_SETTLEMENT' END AS settlement_timing_type
  FROM scored WHERE currency <> 'CHF' GROUP BY 1, 2"""
QUERIES["settlement_analysis"] = f"""
  SELECT CAST(booking_date AS DATE) AS booking_date, value_date, {GAP} AS settlement_days, count(*) AS transaction_count, count(DISTINCT customer_id) AS unique_customers,
    {d('sum(amount)')} AS total_amount, {r(mean('amount'))} AS avg_amount, count(CASE WHEN {GAP} < 0 THEN 1 END) AS backdated_count, count(CASE WHEN {GAP} > 5 THEN 1 END) AS delayed_count,
    count(CASE WHEN {GAP} = 0 THEN 1 END) AS same_day_count, count(CASE WHEN {GAP} = 1 THEN 1 END) AS next_day_count, count(CASE WHEN {GAP} BETWEEN 2 AND 3 THEN 1 END) AS t_plus_2_3_count
  FROM scored GROUP BY 1, 2, 3"""
VIEWS["tagged_share"] = rf"""
  SELECT c.customer_id, c.full_name, c.has_anomaly AS is_anomalous_customer, count(*) AS total_transactions, count(CASE WHEN {TAG} THEN 1 END) AS anomalous_transactions,
    {pct(f'count(CASE WHEN {TAG} THEN 1 END)', 'count(*)')} AS anomaly_percentage, sum(CASE WHEN {TAG} THEN amount ELSE 0 END) AS anomalous_amount,
    coalesce(string_agg(DISTINCT CASE WHEN {TAG} THEN regexp_extract(description, '\[(.*?)\]', 1) END, ', ' ORDER BY CASE WHEN {TAG} THEN regexp_extract(description, '\[(.*?)\]', 1) END), '') AS anomaly_types
  FROM customer_current c JOIN scored t ON c.customer_id = t.customer_id GROUP BY 1, 2, 3"""
QUERIES["anomaly_analysis"] = f"SELECT * REPLACE ({d('anomalous_amount')} AS anomalous_amount) FROM tagged_share"
QUERIES["high_risk_patterns"] = f"""
  SELECT transaction_id, customer_id, booking_date, value_date, {d('amount')} AS amount, currency, CASE WHEN amount > 0 THEN 'IN' ELSE 'OUT' END AS direction, description, cat AS risk_category, {GAP} AS settlement_days
  FROM (SELECT *, CASE WHEN amount >= 10000 THEN 'HIGH_AMOUNT' WHEN {TAG} THEN 'ANOMALOUS' WHEN currency <> 'CHF' AND amount >= 5000 THEN 'HIGH_FX_AMOUNT'
      WHEN counterparty_account LIKE 'OFF_SHORE_%' THEN 'OFFSHORE' WHEN counterparty_account LIKE 'CRYPTO_%' THEN 'CRYPTO' WHEN hour(booking_date) NOT BETWEEN 9 AND 17 THEN 'OFF_HOURS'
      WHEN {GAP} < 0 THEN 'BACKDATED_SETTLEMENT' WHEN {GAP} > 5 THEN 'DELAYED_SETTLEMENT' END AS cat FROM scored) q WHERE cat IS NOT NULL"""
QUERIES["customer_summary"] = f"""
  SELECT c.customer_id, full_name, has_anomaly, onboarding_date, coalesce(na, 0) AS total_accounts, coalesce(nc, 0) AS currency_count, coalesce(cl, '') AS account_currencies,
    coalesce(nt, 0) AS total_transactions, {d('st')} AS total_base_amount, {r('av')} AS avg_transaction_amount, {d('mx')} AS max_transaction_amount, coalesce(tg, 0) AS anomalous_transactions
  FROM customer_current c LEFT JOIN (SELECT customer_id, count(*) AS na, count(DISTINCT base_currency) AS nc, string_agg(DISTINCT base_currency, ', ' ORDER BY base_currency) AS cl FROM in_accounts GROUP BY 1) a ON c.customer_id = a.customer_id
  LEFT JOIN (SELECT customer_id, count(*) AS nt, sum(amount) AS st, {mean('amount')} AS av, max(amount) AS mx, count(CASE WHEN {TAG} THEN 1 END) AS tg FROM scored GROUP BY 1) t ON c.customer_id = t.customer_id"""
QUERIES["lifecycle_anomalies"] = f"""
  SELECT customer_id, full_name, event_id AS lifecycle_event_id, event_type, event_date, dorm AS days_dormant_before_event, transaction_id, tdate AS transaction_date,
    {d('amount')} AS transaction_amount, composite_anomaly_score AS anomaly_score, overall_anomaly_classification AS anomaly_level, date_diff('day', event_date, tdate) AS days_between_event_and_transaction,
    CASE WHEN crit AND event_type IN ('REACTIVATION','ADDRESS_CHANGE') THEN 'CRITICAL' WHEN dorm > 180 THEN 'HIGH' WHEN NOT crit THEN 'MEDIUM' ELSE 'LOW' END AS aml_risk_level,
    crit AND event_type IN ('REACTIVATION','ADDRESS_CHANGE') AND dorm > 180 AS requires_sar_filing, 'OPEN' AS investigation_status
  FROM (SELECT e.*, c.full_name, s.transaction_id, s.amount, s.composite_anomaly_score, s.overall_anomaly_classification, CAST(s.booking_date AS DATE) AS tdate,
      s.overall_anomaly_classification = 'CRITICAL_ANOMALY' AS crit FROM (SELECT e.*, date_diff('day', (SELECT max(CAST(t.booking_date AS DATE)) FROM in_accounts a JOIN in_transactions t ON a.account_id = t.account_id
        WHERE a.customer_id = e.customer_id AND CAST(t.booking_date AS DATE) < e.event_date), e.event_date) AS dorm
      FROM in_customer_events e WHERE event_type IN ('REACTIVATION','ADDRESS_CHANGE','EMPLOYMENT_CHANGE')) e
    JOIN customer_current c ON c.customer_id = e.customer_id
    JOIN scored s ON s.customer_id = e.customer_id AND CAST(s.booking_date AS DATE) BETWEEN e.event_date AND e.event_date + 30 AND s.overall_anomaly_classification IN ('CRITICAL_ANOMALY','HIGH_ANOMALY')
    WHERE dorm > 30) q"""

# ---- screening --------------------------------------------------------------------------------
VIEWS["listed"] = f"""
  SELECT *, CASE WHEN authority = 'DOT - Department of Treasury' AND list_name LIKE '%SDN%' THEN 10 WHEN authority LIKE '%UK%' OR authority LIKE '%Canada%' THEN 7
      WHEN entity_type = 'Individual' THEN 8 WHEN entity_type = 'Vessel' THEN 5 ELSE 6 END AS risk_score,
    expiry_date IS NULL OR expiry_date > {AS_OF} AS is_active,
    CASE WHEN list_name LIKE '%SDN%' THEN 'OFAC Specially Designated Nationals (SDN)' WHEN list_name LIKE '%UK Sanctions%' THEN 'UK Russia Sanctions' WHEN list_name LIKE '%Canada%' THEN 'Canada Port State Control' ELSE list_name END AS sanctions_program,
    CASE WHEN authority LIKE '%DOT%' OR authority LIKE '%Treasury%' THEN 'US_OFAC' WHEN authority LIKE '%UK%' OR authority LIKE '%FCDO%' THEN 'UK_OFSI' WHEN authority LIKE '%Canada%' THEN 'CANADA_PSC'
      WHEN authority LIKE '%EU%' THEN 'EU_SANCTIONS' WHEN authority LIKE '%SECO%' THEN 'SWISS_SECO' ELSE 'OTHER' END AS authority_category,
    date_diff('day', effective_date, {AS_OF}) AS days_since_listing, date_diff('day', {AS_OF}, expiry_date) AS days_until_expiry FROM in_watch_list"""
QUERIES["watch_list_enriched"] = "SELECT * FROM listed"
QUERIES["name_pairs"] = """
  SELECT a, b, CAST(levenshtein(a, b) AS INTEGER) AS distance FROM (SELECT DISTINCT upper(full_name) AS a FROM customer_current)
  CROSS JOIN (SELECT DISTINCT upper(entity_name) AS b FROM listed WHERE is_active) WHERE levenshtein(a, b) <= 5"""
QUERIES["alias_pairs"] = """
  SELECT a, b FROM (SELECT DISTINCT upper(full_name) AS a FROM customer_current)
  CROSS JOIN (SELECT DISTINCT upper(entity_aliases) AS b FROM listed WHERE is_active) WHERE contains(b, a) AND a <> ''"""
VIEWS["screen_pairs"] = """
  SELECT c.customer_id, full_name AS customer_name, date_of_birth AS customer_dob, coalesce(a.country, 'UNKNOWN') AS customer_country, CAST(NULL AS VARCHAR) AS customer_nationality,
    CAST(NULL AS VARCHAR) AS customer_type, risk_classification, entity_id, entity_name, entity_aliases, dob AS sanctions_dob, nationality_country AS sanctions_nationality, authority, list_name,
    sanctions_program, risk_score AS sanctions_risk_score, is_active AS sanctions_is_active, effective_date, expiry_date, citation_link,
    levenshtein(upper(full_name), upper(entity_name)) AS dist, coalesce(contains(upper(entity_aliases), upper(full_name)), FALSE) AS aka
  FROM customer_current c LEFT JOIN addresses_current a ON c.customer_id = a.customer_id CROSS JOIN listed WHERE is_active"""
VIEWS["exact_m"] = "SELECT * EXCLUDE (dist, aka), 'EXACT_MATCH' AS match_type, CAST(100 AS DOUBLE) AS match_score, CAST(0 AS INTEGER) AS edit_distance FROM screen_pairs WHERE dist = 0"
VIEWS["fuzzy_m"] = """SELECT * EXCLUDE (dist, aka), 'FUZZY_MATCH' AS match_type, CAST(CASE WHEN dist <= 1 THEN 95 ELSE 100 - 5 * dist END AS DOUBLE) AS match_score, CAST(dist AS INTEGER) AS edit_distance
  FROM screen_pairs p WHERE dist <= 5 AND NOT EXISTS (SELECT 1 FROM exact_m e WHERE e.customer_id = p.customer_id AND e.entity_id = p.entity_id)"""
VIEWS["alias_m"] = """SELECT * EXCLUDE (dist, aka), 'ALIAS_MATCH' AS match_type, CAST(95 AS DOUBLE) AS match_score, CAST(0 AS INTEGER) AS edit_distance
  FROM screen_pairs p WHERE aka AND NOT EXISTS (SELECT 1 FROM exact_m e WHERE e.customer_id = p.customer_id AND e.entity_id = p.entity_id)"""
for kind in ("exact", "fuzzy", "alias"):
    QUERIES[f"name_match_{kind}"] = f"SELECT * FROM {kind}_m"
VIEWS["screening"] = """
  SELECT *, CASE WHEN match_type = 'EXACT_MATCH' THEN 'EXACT' WHEN match_type = 'ALIAS_MATCH' OR match_score >= 90 THEN 'HIGH_CONFIDENCE' WHEN match_score >= 80 THEN 'MEDIUM_CONFIDENCE' WHEN match_score >= 70 THEN 'LOW_CONFIDENCE' ELSE 'VERY_LOW_CONFIDENCE' END AS match_confidence,
    CASE WHEN match_type = 'EXACT_MATCH' AND dob_match THEN 'HARD_BLOCK' WHEN match_type IN ('EXACT_MATCH','ALIAS_MATCH') OR (match_score >= 90 AND (dob_match OR nationality_match)) THEN 'IMMEDIATE_INVESTIGATION'
      WHEN match_score >= 85 THEN 'ENHANCED_DUE_DILIGENCE' WHEN match_score >= 75 THEN 'MANUAL_REVIEW' ELSE 'LIKELY_FALSE_POSITIVE' END AS disposition_recommendation,
    CASE risk_classification WHEN 'CRITICAL' THEN 10 WHEN 'HIGH' THEN 8 WHEN 'MEDIUM' THEN 5 WHEN 'LOW' THEN 3 ELSE 5 END + sanctions_risk_score AS combined_risk_score,
    CASE WHEN match_type = 'EXACT_MATCH' AND dob_match THEN 'CRITICAL' WHEN match_type IN ('EXACT_MATCH','ALIAS_MATCH') OR match_score >= 85 THEN 'HIGH' WHEN match_score >= 75 THEN 'MEDIUM' ELSE 'LOW' END AS alert_priority
  FROM (SELECT *, coalesce(sanctions_dob NOT LIKE '%[%' AND strftime(customer_dob, '%Y-%m-%d') = sanctions_dob, FALSE) AS dob_match,
      coalesce(customer_nationality = sanctions_nationality, FALSE) AS nationality_match, coalesce(customer_country = sanctions_nationality, FALSE) AS country_match
    FROM (SELECT * FROM exact_m UNION ALL SELECT * FROM fuzzy_m UNION ALL SELECT * FROM alias_m) u) q"""
QUERIES["customer_screening"] = "SELECT * FROM screening"
_D = {
    "exact_match_customers": "match_type = 'EXACT_MATCH'", "fuzzy_match_customers": "match_type = 'FUZZY_MATCH'", "alias_match_customers": "match_type = 'ALIAS_MATCH'",
    "exact_confidence_customers": "match_confidence = 'EXACT'", "high_confidence_customers": "match_confidence = 'HIGH_CONFIDENCE'", "medium_confidence_customers": "match_confidence = 'MEDIUM_CONFIDENCE'",
    "low_confidence_customers": "match_confidence = 'LOW_CONFIDENCE'", "hard_block_required": "disposition_recommendation = 'HARD_BLOCK'",
    "immediate_investigation_required": "disposition_recommendation = 'IMMEDIATE_INVESTIGATION'", "edd_required": "disposition_recommendation = 'ENHANCED_DUE_DILIGENCE'",
    "manual_review_required": "disposition_recommendation = 'MANUAL_REVIEW'", "likely_false_positives": "disposition_recommendation = 'LIKELY_FALSE_POSITIVE'",
    "critical_alerts": "alert_priority = 'CRITICAL'", "high_alerts": "alert_priority = 'HIGH'", "medium_alerts": "alert_priority = 'MEDIUM'", "low_alerts": "alert_priority = 'LOW'",
    "ofac_matches": "authority LIKE '%DOT%' OR authority LIKE '%Treasury%'", "uk_matches": "authority LIKE '%UK%'", "canada_matches": "authority LIKE '%Canada%'",
}
QUERIES["screening_summary"] = f"""
  SELECT count(DISTINCT customer_id) AS total_customers_with_matches, count(DISTINCT entity_id) AS total_sanctions_entities_matched, count(*) AS total_matches,
    {', '.join(f'count(DISTINCT CASE WHEN {cond} THEN customer_id END) AS {name}' for name, cond in _D.items())},
    {r(mean('match_score'))} AS avg_match_score, {r(mean("CASE WHEN match_type = 'FUZZY_MATCH' THEN match_score END"))} AS avg_fuzzy_match_score FROM screening"""
QUERIES["high_risk_alerts"] = """
  SELECT * EXCLUDE (country_match, sanctions_is_active, expiry_date) FROM screening
  WHERE disposition_recommendation IN ('HARD_BLOCK','IMMEDIATE_INVESTIGATION','ENHANCED_DUE_DILIGENCE') AND alert_priority IN ('CRITICAL','HIGH')"""

_lv = "levenshtein(upper({}), upper({}))".format
VIEWS["pep_pairs"] = f"""
  SELECT c.customer_id, upper(c.full_name) = upper(p.full_name) AS is_exact, p.* EXCLUDE (status), {_lv('c.first_name', 'p.first_name')} AS df, {_lv('c.family_name', 'p.last_name')} AS dl, {_lv('c.full_name', 'p.full_name')} AS dn
  FROM customer_current c CROSS JOIN in_exposed_persons p WHERE p.status = 'ACTIVE'"""
PEP_NEAR = "(df <= 2 AND dl = 0) OR (df = 0 AND dl <= 2) OR (df = 1 AND dl = 1) OR dn <= 3"
QUERIES["exposed_name_pairs"] = f"""
  SELECT DISTINCT upper(c.first_name) AS cf, upper(c.family_name) AS cl, exposed_person_id FROM pep_pairs p JOIN customer_current c ON p.customer_id = c.customer_id WHERE {PEP_NEAR}"""
QUERIES["exposed_person_matches"] = f"""
  SELECT customer_id, 'EXACT' AS match_kind, * EXCLUDE (customer_id, is_exact, df, dl, dn) FROM pep_pairs WHERE is_exact
  UNION ALL SELECT customer_id, 'FUZZY' AS match_kind, * EXCLUDE (customer_id, is_exact, df, dl, dn) FROM pep_pairs WHERE {PEP_NEAR}"""

# ---- customer view ----------------------------------------------------------------------------
_T = ("CHECKING", "SAVINGS", "BUSINESS", "INVESTMENT")
_lev = lambda lv, an: f"(coalesce(e_level = '{lv}', FALSE) OR coalesce(f_level = '{lv}', FALSE))" + (" AND has_anomaly" if an else "")
_RULES = [("CRITICAL", 1, "CRITICAL", 95), ("HIGH", 1, "HIGH", 85), ("CRITICAL", 0, "HIGH", 80), ("MEDIUM", 1, "MEDIUM", 65), ("HIGH", 0, "MEDIUM", 60), ("LOW", 1, "LOW", 45), ("MEDIUM", 0, "LOW", 40)]
_rate = "CASE WHEN sid IS NOT NULL THEN 'CRITICAL' " + " ".join(f"WHEN {_lev(a, b)} THEN '{x}'" for a, b, x, _ in _RULES) + f" WHEN has_anomaly THEN 'LOW' WHEN {_lev('LOW', 0)} THEN 'LOW' ELSE 'NO_RISK' END"
_pts = "CASE WHEN sid IS NOT NULL THEN 100 " + " ".join(f"WHEN {_lev(a, b)} THEN {x}" for a, b, _, x in _RULES) + f" WHEN has_anomaly THEN 35 WHEN {_lev('LOW', 0)} THEN 30 ELSE 10 END"
_age = f"date_diff('year', date_of_birth, {AS_OF})"
_old, _young = f"{_age} >= 75", f"({_age} BETWEEN 18 AND 25 AND date_diff('month', onboarding_date, {AS_OF}) <= 6)"
_poor = "(income_range IN ('0-25K','25K-50K') AND credit_score_band IN ('POOR','FAIR'))"
_frag = "(account_tier IN ('BASIC','STANDARD') AND risk_classification IN ('HIGH','CRITICAL'))"
_ten = f"date_diff('day', onboarding_date, {AS_OF})"
VIEWS["c360"] = f"""
  SELECT customer_id, first_name, family_name, date_of_birth, onboarding_date, reporting_currency, has_anomaly, employer, position, employment_type, income_range, account_tier, email, phone,
    preferred_contact_method, risk_classification, credit_score_band, full_name, street_address, city, state, zipcode, country, address_effective_date, current_status, status_effective_date,
    coalesce(na, 0) AS total_accounts, coalesce(ats, '') AS account_types, coalesce(ccs, '') AS currencies, {', '.join(f'coalesce(n_{t}, 0) AS {t.lower()}_accounts' for t in _T)},
    coalesce(tb, 0) AS total_balance, balance_as_of_date, {', '.join(f'coalesce(b_{t}, 0) AS {t.lower()}_balance' for t in _T)}, coalesce(mxb, 0) AS max_account_balance, coalesce(mnb, 0) AS min_account_balance, {r('coalesce(avb, 0)')} AS avg_account_balance,
    coalesce(y, 0) AS total_transactions, coalesce(n, 0) AS total_transactions_all_time, last_transaction_date, coalesce(date_diff('day', last_transaction_date, {AS_OF}), 9999) AS days_since_last_transaction,
    coalesce(dbt, 0) AS debit_transactions, coalesce(crt, 0) AS credit_transactions, {r('coalesce(y, 0) / 12.0')} AS avg_monthly_transactions, coalesce(date_diff('day', last_transaction_date, {AS_OF}), 9999) >= 180 AS is_dormant_transactionally,
    coalesce(m1, 0) > 50 AS is_highly_active, current_advisor_employee_id, advisor_assignment_start_date, e_id AS exposed_person_exact_match_id, e_name AS exposed_person_exact_match_name, e_cat AS exposed_person_exact_category, e_level AS exposed_person_exact_risk_level,
    f_id AS exposed_person_fuzzy_match_id, f_name AS exposed_person_fuzzy_match_name, f_cat AS exposed_person_fuzzy_category, f_level AS exposed_person_fuzzy_risk_level,
    CAST(CASE WHEN e_id IS NOT NULL THEN 100 WHEN f_id IS NOT NULL THEN CASE WHEN df = 1 AND dl = 1 THEN 95 WHEN (df = 0 AND dl = 1) OR (df = 1 AND dl = 0) THEN 90 WHEN (df = 0 AND dl = 2) OR (df = 2 AND dl = 0) THEN 85 WHEN dn <= 3 THEN greatest(70, 100 - dn * 10) ELSE 75 END END AS DOUBLE) AS exposed_person_match_accuracy_percent,
    CASE WHEN e_id IS NOT NULL THEN 'EXACT_MATCH' WHEN f_id IS NOT NULL THEN 'FUZZY_MATCH' ELSE 'NO_MATCH' END AS exposed_person_match_type,
    CASE WHEN e_id IS NOT NULL THEN 'ACTIVE' END AS exposed_person_exact_status, CASE WHEN f_id IS NOT NULL THEN 'ACTIVE' END AS exposed_person_fuzzy_status, CAST(NULL AS VARCHAR) AS sanctions_exact_match_type, CAST(NULL AS VARCHAR) AS sanctions_exact_match_country, CAST(NULL AS VARCHAR) AS sanctions_fuzzy_match_type, CAST(NULL AS VARCHAR) AS sanctions_fuzzy_match_country,
    sid AS sanctions_match_id, sname AS sanctions_match_name, authority AS sanctions_authority, list_name AS sanctions_list, sanctions_program, sanctions_risk_score, match_type AS sanctions_match_type_detail, match_score AS sanctions_match_score,
    match_confidence AS sanctions_match_confidence, disposition_recommendation AS sanctions_disposition, alert_priority AS sanctions_alert_priority, dob_match AS sanctions_dob_match, nationality_match AS sanctions_nationality_match, match_score AS sanctions_match_accuracy_percent,
    coalesce(match_type, 'NO_MATCH') AS sanctions_match_type, CASE WHEN match_type = 'EXACT_MATCH' THEN sid END AS sanctions_exact_match_id, CASE WHEN match_type = 'EXACT_MATCH' THEN sname END AS sanctions_exact_match_name,
    CASE WHEN match_type IN ('FUZZY_MATCH','ALIAS_MATCH') THEN sid END AS sanctions_fuzzy_match_id, CASE WHEN match_type IN ('FUZZY_MATCH','ALIAS_MATCH') THEN sname END AS sanctions_fuzzy_match_name,
    CASE {' '.join(f"WHEN {_lev(x, 0)} THEN '{x}'" for x in ('CRITICAL', 'HIGH', 'MEDIUM', 'LOW'))} ELSE 'NO_EXPOSED_PERSON_RISK' END AS overall_exposed_person_risk,
    CASE WHEN sid IS NOT NULL THEN 'CRITICAL' ELSE 'NO_SANCTIONS_RISK' END AS overall_sanctions_risk, {_rate} AS overall_risk_rating, {_pts} AS overall_risk_score,
    e_id IS NOT NULL OR f_id IS NOT NULL AS requires_exposed_person_review, sid IS NOT NULL AS requires_sanctions_review, has_anomaly AND (e_id IS NOT NULL OR f_id IS NOT NULL OR sid IS NOT NULL) AS high_risk_customer,
    {_old} OR {_young} OR {_poor} OR {_frag} AS vulnerable_customer_flag,
    CASE WHEN {_old} THEN 'CAPABILITY' WHEN {_young} THEN 'CAPABILITY,FINANCIAL' WHEN {_poor} THEN 'FINANCIAL' WHEN {_frag} THEN 'LIFE_EVENT,FINANCIAL' END AS vulnerability_categories, FALSE AS legal_capacity_concerns_flag,
    CASE WHEN {_ten} <= 90 THEN 'NEW' WHEN churn_count > 0 OR account_close_count > 0 THEN 'CHURNED' WHEN is_dormant_lifecycle THEN 'DORMANT' WHEN eng < 30 AND days_since_last_event > 90 THEN 'DECLINING' WHEN {_ten} >= 365 AND eng >= 50 THEN 'MATURE' ELSE 'ACTIVE' END AS lifecycle_stage,
    coalesce(eng, 0) AS engagement_score, CAST(CASE WHEN churn_count > 0 OR account_close_count > 0 THEN 100 WHEN is_dormant_lifecycle AND eng < 20 THEN 85 WHEN is_dormant_lifecycle THEN 70 WHEN days_since_last_event > 120 AND eng < 30 THEN 55
      WHEN days_since_last_event > 90 THEN 40 WHEN eng < 30 THEN 25 WHEN NOT has_recent_activity THEN 15 ELSE 5 END AS DOUBLE) AS churn_probability, coalesce(tle, 0) AS total_lifecycle_events
  FROM customer_current c
  LEFT JOIN (SELECT customer_id, street_address, city, state, zipcode, country, current_from AS address_effective_date FROM addresses_current) a USING (customer_id)
  LEFT JOIN (SELECT customer_id, status AS current_status, status_start_date AS status_effective_date FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY status_start_date DESC, status_id DESC) AS rn FROM in_customer_status WHERE is_current) WHERE rn = 1) s USING (customer_id)
  LEFT JOIN (SELECT customer_id, count(*) AS na, string_agg(DISTINCT account_type, ', ' ORDER BY account_type) AS ats, string_agg(DISTINCT base_currency, ', ' ORDER BY base_currency) AS ccs, {', '.join(f"count(CASE WHEN account_type = '{t}' THEN 1 END) AS n_{t}" for t in _T)} FROM in_accounts GROUP BY 1) ac USING (customer_id)
  LEFT JOIN (SELECT customer_id, sum(current_balance_base) AS tb, max(last_transaction_date) AS balance_as_of_date, {', '.join(f"sum(CASE WHEN account_type = '{t}' THEN current_balance_base ELSE 0 END) AS b_{t}" for t in _T)}, max(current_balance_base) AS mxb, min(current_balance_base) AS mnb, {mean('current_balance_base')} AS avb FROM balances GROUP BY 1) b USING (customer_id)
  LEFT JOIN (SELECT a.customer_id, count(CASE WHEN value_date >= {AS_OF} - INTERVAL 12 MONTH THEN 1 END) AS y, count(*) AS n, max(value_date) AS last_transaction_date, count(CASE WHEN amount < 0 AND value_date >= {AS_OF} - INTERVAL 12 MONTH THEN 1 END) AS dbt,
      count(CASE WHEN amount > 0 AND value_date >= {AS_OF} - INTERVAL 12 MONTH THEN 1 END) AS crt, count(CASE WHEN value_date >= {AS_OF} - INTERVAL 1 MONTH THEN 1 END) AS m1 FROM in_accounts a JOIN in_transactions t ON a.account_id = t.account_id GROUP BY 1) t USING (customer_id)
  LEFT JOIN (SELECT customer_id, churn_count, account_close_count, is_dormant_lifecycle, engagement_score AS eng, days_since_last_event, has_recent_activity, total_lifecycle_events AS tle FROM customer_lifecycle) l USING (customer_id)
  LEFT JOIN (SELECT customer_id, advisor_employee_id AS current_advisor_employee_id, assignment_start_date AS advisor_assignment_start_date FROM in_assignments WHERE is_current) ad USING (customer_id)
  LEFT JOIN (SELECT customer_id, exposed_person_id AS e_id, full_name AS e_name, exposed_person_category AS e_cat, risk_level AS e_level FROM pep_pairs WHERE is_exact) pe USING (customer_id)
  LEFT JOIN (SELECT customer_id AS fc, exposed_person_id AS f_id, full_name AS f_name, exposed_person_category AS f_cat, risk_level AS f_level, df, dl, dn FROM pep_pairs WHERE {PEP_NEAR}) pf ON pf.fc = c.customer_id AND f_id <> coalesce(e_id, 'NO_EXACT_MATCH')
  LEFT JOIN (SELECT DISTINCT customer_id, entity_id AS sid, entity_name AS sname, authority, list_name, sanctions_program, sanctions_risk_score, match_type, match_score, match_confidence, disposition_recommendation, alert_priority, dob_match, nationality_match FROM screening) sc USING (customer_id)"""
DEC_360 = [*(f"{t.lower()}_balance" for t in _T), "total_balance", "max_account_balance", "min_account_balance"]
QUERIES["customer_360"] = f"SELECT * REPLACE ({', '.join(f'{d(x)} AS {x}' for x in DEC_360)}) FROM c360"
_pepc, _hitc, _sev = "exposed_person_match_type IN ('EXACT_MATCH','FUZZY_MATCH')", "sanctions_match_type IN ('EXACT_MATCH','FUZZY_MATCH')", "risk_classification IN ('CRITICAL','HIGH')"
_C7 = {
    **{f"{x.lower()}_risk": f"risk_classification = '{x}'" for x in ("CRITICAL", "HIGH", "MEDIUM", "LOW")},
    "pep": _pepc, "pep_exact_match": "exposed_person_match_type = 'EXACT_MATCH'", "pep_fuzzy_match": "exposed_person_match_type = 'FUZZY_MATCH'", "sanctions": _hitc,
    "sanctions_exact_match": "sanctions_match_type = 'EXACT_MATCH'", "sanctions_fuzzy_match": "sanctions_match_type = 'FUZZY_MATCH'", "anomaly": "has_anomaly", "combined_high_risk": f"{_pepc} OR {_hitc} OR {_sev} OR has_anomaly",
    "multiple_risk_factors": f"CAST({_pepc} AS INT) + CAST({_hitc} AS INT) + CAST({_sev} AS INT) + CAST(has_anomaly AS INT) >= 2", "pep_and_sanctions": f"{_pepc} AND {_hitc}",
    "dormant_high_risk": f"({_pepc} OR {_hitc} OR {_sev}) AND is_dormant_transactionally", "active_high_risk": f"({_pepc} OR {_hitc} OR {_sev}) AND NOT is_dormant_transactionally",
}
_nd = lambda cond: f"count(DISTINCT CASE WHEN {cond} THEN customer_id END)"
_aum = lambda cond: f"CAST((SELECT coalesce(sum(b), 0) FROM (SELECT customer_id, max(total_balance) AS b FROM c360 WHERE {cond} GROUP BY 1) z) AS DOUBLE)"
QUERIES["customer_risk_profile"] = f"""
  SELECT count(DISTINCT customer_id) AS total_customers, {', '.join(f'{_nd(x)} AS {n}_count' for n, x in _C7.items())},
    {', '.join(f"{pct(_nd(_C7[n]), 'count(DISTINCT customer_id)')} AS {n}_pct" for n in ('critical_risk', 'high_risk', 'medium_risk', 'low_risk', 'pep', 'sanctions', 'anomaly', 'combined_high_risk'))},
    {', '.join(f"{_aum(_C7[x + '_risk'])} AS {x}_risk_aum" for x in ('critical', 'high', 'medium', 'low'))}, {_aum(f'{_pepc} OR {_hitc} OR {_sev}')} AS total_high_risk_aum FROM c360"""
_conf = lambda k, a: f"CASE WHEN {k} = 'EXACT_MATCH' THEN 'HIGH' WHEN {k} = 'FUZZY_MATCH' AND {a} >= 90 THEN 'MEDIUM_HIGH' WHEN {k} = 'FUZZY_MATCH' AND {a} >= 80 THEN 'MEDIUM' WHEN {k} = 'FUZZY_MATCH' THEN 'LOW_MEDIUM' ELSE 'NONE' END"
VIEWS["status_c8"] = f"""
  SELECT customer_id, first_name, family_name, full_name, date_of_birth, country, onboarding_date, current_status, exposed_person_match_type AS pep_match_type, {_pepc} AS is_pep,
    coalesce(exposed_person_exact_match_name, exposed_person_fuzzy_match_name) AS pep_match_name, coalesce(exposed_person_exact_category, exposed_person_fuzzy_category) AS pep_category,
    coalesce(exposed_person_exact_risk_level, exposed_person_fuzzy_risk_level) AS pep_risk_level, exposed_person_match_accuracy_percent AS pep_match_accuracy,
    {_conf('exposed_person_match_type', 'exposed_person_match_accuracy_percent')} AS pep_match_confidence, sanctions_match_type, {_hitc} AS has_sanctions_hit,
    coalesce(sanctions_exact_match_name, sanctions_fuzzy_match_name) AS sanctions_match_name, sanctions_match_accuracy_percent AS sanctions_match_accuracy, CAST(NULL AS VARCHAR) AS sanctions_entity_type, CAST(NULL AS VARCHAR) AS sanctions_country,
    {_conf('sanctions_match_type', 'sanctions_match_accuracy_percent')} AS sanctions_match_confidence, overall_exposed_person_risk, overall_sanctions_risk, overall_risk_rating, overall_risk_score,
    CASE WHEN sanctions_match_type = 'EXACT_MATCH' THEN 'SANCTIONS_EXACT_CRITICAL' WHEN sanctions_match_type = 'FUZZY_MATCH' THEN 'SANCTIONS_FUZZY_HIGH'
      WHEN exposed_person_match_type = 'EXACT_MATCH' AND exposed_person_exact_risk_level IN ('CRITICAL','HIGH') THEN 'PEP_EXACT_HIGH' WHEN exposed_person_match_type = 'FUZZY_MATCH' AND exposed_person_fuzzy_risk_level IN ('CRITICAL','HIGH') THEN 'PEP_FUZZY_HIGH'
      WHEN {_pepc} THEN 'PEP_MEDIUM' WHEN risk_classification = 'CRITICAL' THEN 'HIGH_RISK_NO_MATCH' WHEN risk_classification = 'HIGH' THEN 'MEDIUM_RISK_NO_MATCH' ELSE 'LOW_RISK' END AS screening_risk_tier,
    CASE WHEN {_hitc} THEN 'IMMEDIATE_BLOCK' WHEN exposed_person_match_type = 'EXACT_MATCH' THEN 'ENHANCED_DUE_DILIGENCE' WHEN exposed_person_match_type = 'FUZZY_MATCH' THEN 'VERIFY_AND_INVESTIGATE'
      WHEN risk_classification = 'CRITICAL' THEN 'ENHANCED_MONITORING' WHEN risk_classification = 'HIGH' THEN 'STANDARD_MONITORING' ELSE 'ROUTINE' END AS required_action,
    requires_exposed_person_review AS requires_pep_review, requires_sanctions_review, requires_exposed_person_review OR requires_sanctions_review AS requires_investigation,
    CASE WHEN sanctions_match_type = 'EXACT_MATCH' THEN 1 WHEN sanctions_match_type = 'FUZZY_MATCH' THEN 3 WHEN exposed_person_match_type = 'EXACT_MATCH' THEN 7 WHEN exposed_person_match_type = 'FUZZY_MATCH' THEN 14 WHEN risk_classification = 'CRITICAL' THEN 7 WHEN risk_classification = 'HIGH' THEN 30 ELSE 90 END AS investigation_sla_days,
    {_ten} AS days_since_screening,
    CASE WHEN sanctions_match_type = 'EXACT_MATCH' AND {_ten} > 1 THEN TRUE WHEN sanctions_match_type = 'FUZZY_MATCH' AND {_ten} > 3 THEN TRUE WHEN exposed_person_match_type = 'EXACT_MATCH' AND {_ten} > 7 THEN TRUE WHEN exposed_person_match_type = 'FUZZY_MATCH' AND {_ten} > 14 THEN TRUE ELSE FALSE END AS is_sla_breach,
    risk_classification, has_anomaly AS has_transaction_anomaly, high_risk_customer, {_hitc} OR {_pepc} OR {_sev} AS is_high_risk, {_hitc} AND {_pepc} AS has_multiple_screening_hits,
    {d('total_balance')} AS account_balance, total_accounts, total_transactions, is_dormant_transactionally FROM c360"""
QUERIES["screening_status"] = "SELECT * FROM status_c8"
QUERIES["screening_alerts"] = "SELECT * FROM status_c8 WHERE requires_investigation"
