"""Credit, market and aggregated risk queries."""

from oracle import QUERIES, VIEWS, d, mean, pct, r
from oracle.bank import AS_OF, TAG


def _scale(odd, cuts, best):
    return f"CASE WHEN has_anomaly THEN {odd} " + " ".join(f"WHEN sh > {c} THEN {v}" for c, v in zip((20, 10, 5, 2, 0), cuts, strict=True)) + f" ELSE {best} END"


_dd = lambda x: f"CAST({x} AS DOUBLE)"
def _irb(day: str, until: str) -> str:
    """Ratings on a day, from the payments that the condition lets through."""
    return f"""
  SELECT customer_id, full_name, onboarding_date, {_scale("'CCC'", ("'B'", "'BB'", "'BBB'", "'A'", "'AA'"), "'AAA'")} AS credit_rating, {_dd(_scale(15, (8, 4, 2, 1, 0.5), 0.1))} AS pd_1_year, {_dd(_scale(25, (15, 8, 4, 2, 1), 0.3))} AS pd_lifetime, CAST(45 AS DOUBLE) AS lgd_rate,
    coalesce(hd, 0) AS ead_amount, {_dd(_scale(150, (120, 100, 75, 50, 35), 20))} AS risk_weight, {day} AS rating_date, 'FOUNDATION_IRB' AS rating_methodology, 'RETAIL' AS portfolio_segment, {_scale(120, (60, 30, 0, 0, 0), 0)} AS days_past_due,
    has_anomaly OR coalesce(sh > 20, FALSE) AS default_flag, coalesce(sh > 5, FALSE) AS watch_list_flag, coalesce(hd, 0) AS total_exposure_chf, {r('CAST(coalesce(hd, 0) * 6 AS DOUBLE) / 10')} AS secured_exposure_chf, {r('CAST(coalesce(hd, 0) * 4 AS DOUBLE) / 10')} AS unsecured_exposure_chf
  FROM customer_current LEFT JOIN (SELECT customer_id, {pct(f'count(CASE WHEN {TAG} THEN 1 END)', 'count(*)')} AS sh FROM scored WHERE {until} GROUP BY 1) t USING (customer_id)
  LEFT JOIN (SELECT customer_id, sum(coalesce(bal, 0)) AS hd FROM accounts_enriched a LEFT JOIN (SELECT account_id, sum(base_amount) AS bal FROM in_transactions WHERE {until} GROUP BY 1) m ON a.account_id = m.account_id WHERE a.is_active GROUP BY 1) b USING (customer_id)"""


VIEWS["irb"] = _irb(AS_OF, "TRUE")
for _back in (1, 90):
    VIEWS[f"irb_{_back}"] = _irb(f"({AS_OF} - {_back})", f"booking_date < {AS_OF} - {_back - 1}")
QUERIES["irb_customer_ratings"] = f"SELECT * REPLACE ({d('ead_amount')} AS ead_amount, {d('total_exposure_chf')} AS total_exposure_chf) FROM irb"
_stored = f"customer_id, rating_date AS effective_date, credit_rating, pd_1_year, pd_lifetime, lgd_rate, risk_weight, default_flag, watch_list_flag, {d('total_exposure_chf')} AS total_exposure_chf, days_past_due, rating_date"
QUERIES["rating_history"] = " UNION ALL ".join(f"SELECT {_stored} FROM {v}" for v in ("irb", "irb_1", "irb_90"))
_x = "total_exposure_chf"
_d2 = lambda x: f"CAST({x} AS DECIMAL(6,2))"
VIEWS["irbm"] = f"""
  SELECT portfolio_segment, credit_rating, count(*) AS customer_count, sum({_x}) AS total_exposure_chf, {r(mean(_x))} AS average_exposure_chf, {r(f"CAST(sum({_x} * {_d2('pd_1_year')}) AS DOUBLE) / nullif(CAST(sum({_x}) AS DOUBLE), 0)")} AS weighted_avg_pd,
    {r(f"CAST(sum({_x} * {_d2('lgd_rate')}) AS DOUBLE) / nullif(CAST(sum({_x}) AS DOUBLE), 0)")} AS weighted_avg_lgd, {r(f"CAST(sum({_x} * {_d2('pd_1_year')} * {_d2('lgd_rate')}) AS DOUBLE) / 10000")} AS expected_loss_chf, {r(f"CAST(sum({_x} * {_d2('risk_weight')}) AS DOUBLE) / 100")} AS risk_weighted_assets_chf,
    {r(f"CAST(sum({_x} * {_d2('risk_weight')}) * 8 AS DOUBLE) / 10000")} AS capital_requirement_chf, count(CASE WHEN default_flag THEN 1 END) AS default_count, {pct('count(CASE WHEN default_flag THEN 1 END)', 'count(*)')} AS default_rate, count(CASE WHEN watch_list_flag THEN 1 END) AS watch_list_count,
    {pct('count(CASE WHEN watch_list_flag THEN 1 END)', 'count(*)')} AS watch_list_rate, {r(f'CAST(sum({_x}) * 6 AS DOUBLE) / 10')} AS secured_exposure_chf, {r(f'CAST(sum({_x}) * 4 AS DOUBLE) / 10')} AS unsecured_exposure_chf, CASE WHEN sum({_x}) <> 0 THEN CAST(60 AS DOUBLE) END AS collateral_coverage_ratio,
    {r(mean(f"date_diff('month', onboarding_date, {AS_OF})"))} AS vintage_months, CASE WHEN max({_x}) > sum({_x}) * 0.3 THEN 9 WHEN max({_x}) > sum({_x}) * 0.2 THEN 7 WHEN max({_x}) > sum({_x}) * 0.1 THEN 5 WHEN max({_x}) > sum({_x}) * 0.05 THEN 3 ELSE 1 END AS concentration_risk_score
  FROM irb GROUP BY 1, 2"""
QUERIES["irb_portfolio_metrics"] = f"SELECT * REPLACE ({d(_x)} AS total_exposure_chf) FROM irbm"
_seg = lambda s, x: f"sum(CASE WHEN portfolio_segment = '{s}' THEN {x} ELSE 0 END)"
QUERIES["irb_rwa_summary"] = f"""
  SELECT {AS_OF} AS calculation_date, {d(f'sum({_x})')} AS total_exposure_chf, {r('sum(risk_weighted_assets_chf)')} AS total_rwa_chf, {r('sum(capital_requirement_chf)')} AS total_capital_requirement_chf, {r('sum(expected_loss_chf)')} AS total_expected_loss_chf, {pct('sum(risk_weighted_assets_chf)', f'sum({_x})')} AS average_risk_weight,
    CAST(15.2 AS DOUBLE) AS tier1_capital_ratio, CAST(18.5 AS DOUBLE) AS total_capital_ratio, CAST(5.8 AS DOUBLE) AS leverage_ratio, CAST(sum(default_count) AS BIGINT) AS default_customers, CAST(sum(customer_count) AS BIGINT) AS total_customers, {pct('sum(default_count)', 'sum(customer_count)')} AS portfolio_default_rate,
    {', '.join(f"{d(_seg(s, _x))} AS {s.lower()}_exposure_chf, {r(_seg(s, 'risk_weighted_assets_chf'))} AS {s.lower()}_rwa_chf" for s in ('RETAIL', 'CORPORATE', 'SME'))} FROM irbm"""
_rk = lambda x: f"CASE {x} WHEN 'AAA' THEN 7 WHEN 'AA' THEN 6 WHEN 'A' THEN 5 WHEN 'BBB' THEN 4 WHEN 'BB' THEN 3 WHEN 'B' THEN 2 WHEN 'CCC' THEN 1 END"
_rate = "count(CASE WHEN a.default_flag THEN 1 END) * CAST(100 AS DOUBLE) / count(*)"
_new, _cur = "count(CASE WHEN a.default_flag AND NOT coalesce(h.default_flag, FALSE) THEN 1 END)", "count(CASE WHEN NOT a.default_flag AND coalesce(h.default_flag, FALSE) THEN 1 END)"
QUERIES["irb_risk_trends"] = f"""
  SELECT {AS_OF} AS trend_date, portfolio_segment, {', '.join(f"{r(f'avg({x})')} AS avg_{x}" for x in ('pd_1_year', 'pd_lifetime', 'lgd_rate', 'risk_weight'))}, {d(f'sum({_x})')} AS total_exposure_chf, {r(f"CAST(sum({_x} * {_d2('risk_weight')}) AS DOUBLE) / 100")} AS total_rwa_chf,
    {r(f"CAST(sum({_x} * {_d2('pd_1_year')} * {_d2('lgd_rate')}) AS DOUBLE) / 10000")} AS expected_loss_chf, {r(_rate)} AS default_rate, {_new} AS new_defaults, {_cur} AS cured_defaults, {_new} - {_cur} AS net_default_change,
    count(CASE WHEN {_rk('a.credit_rating')} > {_rk('h.credit_rating')} THEN 1 END) AS rating_migrations_up, count(CASE WHEN {_rk('a.credit_rating')} < {_rk('h.credit_rating')} THEN 1 END) AS rating_migrations_down,
    CASE WHEN avg(pd_1_year) BETWEEN 0.5 AND 2 THEN 9 WHEN avg(pd_1_year) BETWEEN 0.1 AND 5 THEN 7 ELSE 5 END AS model_performance_score, CAST(CASE WHEN {_rate} BETWEEN 0.5 AND 3 THEN 92.5 WHEN {_rate} BETWEEN 0.1 AND 5 THEN 87.2 ELSE 78.5 END AS DOUBLE) AS backtesting_accuracy, CAST(1 AS DOUBLE) AS stress_test_multiplier
  FROM irb a LEFT JOIN (SELECT customer_id, credit_rating, default_flag FROM irb_1) h ON a.customer_id = h.customer_id GROUP BY 2"""

VIEWS["frtb"] = """
  SELECT 'EQUITY' AS risk_class, 'EQUITY_LARGE_CAP' AS risk_bucket, customer_id, account_id, 'EQUITY' AS instrument_type, symbol AS instrument_name, 'CHF' AS currency, CAST(net_investment_chf AS DECIMAL(28,2)) AS position_value_chf, CAST(net_investment_chf AS DECIMAL(28,4)) AS delta_chf, CAST(NULL AS DECIMAL(28,4)) AS vega_chf,
    CAST(8 AS DOUBLE) AS liquidity_score, FALSE AS is_nmrf FROM eq_pos WHERE position_status <> 'CLOSED'
  UNION ALL SELECT 'INTEREST_RATE', CASE issuer_type WHEN 'SOVEREIGN' THEN 'IR_SOVEREIGN' WHEN 'CORPORATE' THEN 'IR_CORPORATE' ELSE 'IR_OTHER' END, customer_id, account_id, instrument_type, issuer, currency, CAST(total_investment_chf AS DECIMAL(28,2)), CAST(total_dv01_chf AS DECIMAL(28,4)), NULL,
    CASE WHEN issuer_type = 'SOVEREIGN' THEN 9 WHEN credit_rating IN ('AAA','AA') THEN 7 ELSE 5 END, issuer_type = 'CORPORATE' AND credit_rating NOT IN ('AAA','AA','A') FROM fi_pos WHERE position_status <> 'CLOSED'
  UNION ALL SELECT 'CREDIT_SPREAD', CASE WHEN credit_rating IN ('AAA','AA') THEN 'CS_IG_HIGH' WHEN credit_rating IN ('A','BBB') THEN 'CS_IG_LOW' ELSE 'CS_HY' END, customer_id, account_id, instrument_type, issuer, currency, CAST(total_investment_chf AS DECIMAL(28,2)), CAST(total_investment_chf * 0.01 AS DECIMAL(28,4)), NULL,
    CASE WHEN credit_rating IN ('AAA','AA','A') THEN 7 ELSE 4 END, credit_rating NOT IN ('AAA','AA','A','BBB') FROM fi_pos WHERE position_status <> 'CLOSED' AND instrument_type = 'BOND' AND issuer_type = 'CORPORATE'
  UNION ALL SELECT 'COMMODITY', CASE commodity_type WHEN 'ENERGY' THEN 'COMM_ENERGY' WHEN 'PRECIOUS_METAL' THEN 'COMM_PRECIOUS' WHEN 'BASE_METAL' THEN 'COMM_BASE' WHEN 'AGRICULTURAL' THEN 'COMM_AGRI' ELSE 'COMM_OTHER' END, customer_id, account_id, commodity_type, commodity_name, 'CHF', CAST(total_investment_chf AS DECIMAL(28,2)), CAST(total_delta_chf AS DECIMAL(28,4)), NULL,
    CASE WHEN commodity_type IN ('ENERGY','PRECIOUS_METAL') THEN 7 WHEN commodity_type = 'BASE_METAL' THEN 6 ELSE 4 END, commodity_type = 'AGRICULTURAL' FROM cmd_pos WHERE position_status <> 'CLOSED'"""
QUERIES["frtb_risk_positions"] = f"SELECT * REPLACE ({', '.join(f'{d(x)} AS {x}' for x in ('position_value_chf', 'delta_chf', 'vega_chf'))}) FROM frtb"
VIEWS["sens"] = """
  SELECT risk_class, risk_bucket, count(*) AS total_positions, count(CASE WHEN delta_chf > 0 THEN 1 END) AS long_positions, count(CASE WHEN delta_chf < 0 THEN 1 END) AS short_positions, sum(abs(delta_chf)) AS gross_delta_chf, sum(delta_chf) AS net_delta_chf,
    sum(abs(coalesce(vega_chf, 0))) AS gross_vega_chf, sum(coalesce(vega_chf, 0)) AS net_vega_chf, max(abs(position_value_chf)) AS largest_position_chf, count(CASE WHEN is_nmrf THEN 1 END) AS nmrf_positions FROM frtb GROUP BY 1, 2"""
QUERIES["frtb_sensitivities"] = f"SELECT * REPLACE ({', '.join(f'{d(x)} AS {x}' for x in 'gross_delta_chf net_delta_chf gross_vega_chf net_vega_chf largest_position_chf'.split())}) FROM sens"
_wt = "CAST(CASE WHEN risk_class = 'EQUITY' THEN 25 WHEN risk_class = 'FX' THEN 15 WHEN risk_bucket = 'IR_SOVEREIGN' THEN 1.5 WHEN risk_class = 'INTEREST_RATE' THEN 3 WHEN risk_bucket = 'COMM_ENERGY' THEN 30 WHEN risk_bucket = 'COMM_PRECIOUS' THEN 20 WHEN risk_bucket = 'COMM_BASE' THEN 25 WHEN risk_class = 'COMMODITY' THEN 35 WHEN risk_bucket = 'CS_IG_HIGH' THEN 2 WHEN risk_bucket = 'CS_IG_LOW' THEN 3.5 WHEN risk_class = 'CREDIT_SPREAD' THEN 6 ELSE 10 END AS DOUBLE)"
_g, _v, _ad = "CAST(gross_delta_chf AS DOUBLE)", "CAST(gross_vega_chf AS DOUBLE)", "CASE WHEN nmrf_positions > 0 THEN CAST(gross_delta_chf AS DOUBLE) * 50 / 100 ELSE 0 END"
QUERIES["frtb_capital_charges"] = f"""
  SELECT risk_class, risk_bucket, {_g} AS gross_delta_chf, {d('net_delta_chf')} AS net_delta_chf, {_wt} AS risk_weight, {r(f'{_g} * {_wt} / 100')} AS delta_capital_charge_chf, {r(f'{_v} * 10 / 100')} AS vega_capital_charge_chf, {r(f'{_g} * 5 / 100')} AS curvature_capital_charge_chf, {r(_ad)} AS nmrf_add_on_chf,
    {r(f'{_g} * {_wt} / 100 + {_v} * 10 / 100 + {_g} * 5 / 100 + {_ad}')} AS total_capital_charge_chf FROM sens"""
QUERIES["frtb_nmrf"] = f"""
  SELECT risk_class, risk_bucket, instrument_name, customer_id, {d('position_value_chf')} AS position_value_chf, {d('delta_chf')} AS delta_chf, liquidity_score, CASE WHEN liquidity_score < 3 THEN 'HIGHLY_ILLIQUID' WHEN liquidity_score < 5 THEN 'ILLIQUID' WHEN risk_bucket = 'CS_HY' THEN 'HIGH_YIELD_CREDIT' WHEN risk_bucket = 'COMM_AGRI' THEN 'AGRICULTURAL_COMMODITY' ELSE 'OTHER' END AS nmrf_reason,
    {r('CAST(abs(position_value_chf) AS DOUBLE) / 2')} AS capital_add_on_chf FROM frtb WHERE is_nmrf"""
_tier = lambda x, a, b: f"CASE WHEN {x} < {a} THEN 'LOW_RISK' WHEN {x} < {b} THEN 'MEDIUM_RISK' ELSE 'HIGH_RISK' END"
VIEWS["allrisk"] = f"""
  SELECT 'CREDIT' AS risk_type, 'RETAIL' AS business_line, 'EMEA' AS geography, 'CHF' AS currency, {_tier('pd_1_year', 0.5, 2)} AS customer_segment, customer_id, CAST(total_exposure_chf AS DECIMAL(28,2)) AS x, CAST(total_exposure_chf * {_d2('risk_weight')} * 0.01 AS DECIMAL(28,4)) AS k, risk_weight AS w FROM irb
  UNION ALL SELECT 'MARKET', 'TRADING', 'GLOBAL', currency, {_tier('abs(position_value_chf)', 1000000, 5000000)}, customer_id, abs(position_value_chf), CAST(abs(position_value_chf) * 0.08 AS DECIMAL(28,4)), CASE risk_class WHEN 'EQUITY' THEN 25 WHEN 'FX' THEN 15 WHEN 'INTEREST_RATE' THEN 2 WHEN 'COMMODITY' THEN 30 WHEN 'CREDIT_SPREAD' THEN 5 ELSE 20 END FROM frtb
  UNION ALL SELECT 'OPERATIONAL', 'ALL', 'GLOBAL', 'CHF', {_tier('anomalous_amount', 100000, 500000)}, customer_id, anomalous_amount, CAST(anomalous_amount * 0.15 AS DECIMAL(28,4)), 100 FROM tagged_share WHERE is_anomalous_customer
  UNION ALL SELECT 'LIQUIDITY', 'TREASURY', 'GLOBAL', currency, {_tier('total_chf_amount', 1000000, 10000000)}, 'LIQUIDITY_' || currency, abs(total_chf_amount), CAST(abs(total_chf_amount) * 0.05 AS DECIMAL(28,4)), 50 FROM ccy_now"""
VIEWS["ragg"] = f"""
  SELECT risk_type, business_line, geography, currency, customer_segment, customer_id, sum(x) AS total_exposure_chf, {r('sum(k)')} AS total_capital_requirement_chf, {r('avg(w)')} AS avg_risk_weight, count(DISTINCT customer_id) AS customer_count, max(x) AS max_single_exposure_chf, {r('stddev_samp(CAST(x AS DOUBLE))')} AS exposure_volatility_chf,
    {r('CAST(max(x) AS DOUBLE) / nullif(CAST(sum(x) AS DOUBLE), 0) * 100')} AS max_concentration_percent, {r('CAST(sum(k) AS DOUBLE) / nullif(CAST(sum(x) AS DOUBLE), 0) * 100')} AS capital_ratio_percent, {r('CAST(sum(x) AS DOUBLE) / count(DISTINCT customer_id)')} AS avg_exposure_per_customer_chf, {AS_OF} AS reporting_date
  FROM allrisk GROUP BY 1, 2, 3, 4, 5, 6"""
_show = f"{d('total_exposure_chf')} AS total_exposure_chf, {d('max_single_exposure_chf')} AS max_single_exposure_chf"
QUERIES["risk_aggregation"] = f"SELECT * REPLACE ({_show}, {r('exposure_volatility_chf', 0)} AS exposure_volatility_chf) FROM ragg"
_cap = "sum(total_capital_requirement_chf)"
_rr = f"{_cap} / nullif(CAST(sum(total_exposure_chf) AS DOUBLE), 0)"
_ty = lambda t: d(f"sum(CASE WHEN risk_type = '{t}' THEN total_exposure_chf ELSE 0 END)")
QUERIES["executive_dashboard"] = f"""
  SELECT {d('sum(total_exposure_chf)')} AS total_exposure_chf, {r(_cap)} AS total_capital_requirement_chf, {r(f'{_rr} * 100')} AS capital_ratio_percent, {r('avg(max_concentration_percent)')} AS concentration_risk_score, {', '.join(f'{_ty(t)} AS {t.lower()}_risk_exposure_chf' for t in ('CREDIT', 'MARKET', 'OPERATIONAL', 'LIQUIDITY'))},
    CAST(sum(customer_count) AS BIGINT) AS total_customer_count, count(DISTINCT geography) AS geographic_diversification, count(DISTINCT currency) AS currency_diversification, count(DISTINCT business_line) AS business_line_diversification, 'STABLE' AS risk_trend_30_days, 'STABLE' AS risk_trend_90_days, {r('avg(exposure_volatility_chf)', 0)} AS risk_volatility_score,
    CASE WHEN {_rr} >= 0.08 THEN 'COMPLIANT' ELSE 'NON_COMPLIANT' END AS basel_iii_compliance_status, {r(f'{_cap} / 4', 0)} AS regulatory_capital_buffer_chf, {r(f'{_rr} * 100')} AS capital_adequacy_ratio_percent, {r('CAST(sum(total_exposure_chf) AS DOUBLE) / 10000000000 * 100')} AS risk_limit_utilization_percent FROM ragg"""
QUERIES["regulatory_reporting"] = f"""
  SELECT 'BCBS239_RISK_REPORT' AS report_type, {AS_OF} AS reporting_date, 'BANK' AS institution_name, 'EMEA' AS region, 'HOURLY' AS risk_aggregation_frequency, 'DAILY' AS risk_reporting_frequency, 'DAILY' AS regulatory_reporting_frequency, count(*) AS risk_data_points_count,
    CASE WHEN {_rr} >= 0.08 THEN 'COMPLIANT' ELSE 'NON_COMPLIANT' END AS basel_iii_compliance_status, {d('sum(total_exposure_chf)')} AS total_risk_exposure_chf, {r(_cap)} AS total_capital_requirement_chf, {r(f'{_rr} * 100')} AS risk_coverage_percent FROM ragg"""
CONC_FLOOR = 0.001
_s = "CAST(total_exposure_chf AS DOUBLE) / nullif(CAST(sum(total_exposure_chf) OVER ({}) AS DOUBLE), 0)".format
QUERIES["risk_concentration"] = f"""
  SELECT customer_id, 'Customer_' || customer_id AS customer_name, risk_type, business_line, geography, currency, {d('total_exposure_chf')} AS total_exposure_chf, {r('s * 100')} AS exposure_percent_of_portfolio, {r('st * 100')} AS exposure_percent_of_risk_type, {r('sb * 100')} AS exposure_percent_of_business_line,
    CASE WHEN s > 0.05 THEN 'HIGH_CONCENTRATION' WHEN s > 0.02 THEN 'MEDIUM_CONCENTRATION' ELSE 'LOW_CONCENTRATION' END AS risk_concentration_flag, {r('s * 100')} AS concentration_risk_score, CASE WHEN s > 0.05 THEN 'CRITICAL' WHEN s > 0.02 THEN 'HIGH' WHEN s > 0.01 THEN 'MEDIUM' ELSE 'LOW' END AS concentration_risk_level,
    avg_risk_weight AS risk_weight, customer_segment, 'STABLE' AS concentration_trend, CASE WHEN s > 0.05 THEN 'ALERT' WHEN s > 0.02 THEN 'WARNING' ELSE 'NORMAL' END AS alert_status
  FROM (SELECT *, {_s('')} AS s, {_s('PARTITION BY risk_type')} AS st, {_s('PARTITION BY business_line')} AS sb FROM ragg WHERE customer_id IS NOT NULL) q WHERE s > {CONC_FLOOR}"""
QUERIES["risk_limits"] = f"""
  SELECT risk_type, business_line, geography, currency, {d('e')} AS current_exposure_chf, lim AS risk_limit_chf, kind AS limit_type, {r('u * 100')} AS utilization_percent, {d('lim - e')} AS remaining_limit_chf, CASE WHEN e > lim THEN 'BREACH' ELSE 'WITHIN_LIMITS' END AS breach_flag,
    CASE WHEN u > 0.9 THEN 'CRITICAL' WHEN u > 0.8 THEN 'HIGH' WHEN u > 0.7 THEN 'MEDIUM' ELSE 'LOW' END AS alert_level, CASE WHEN u > 1 THEN 'BREACH' WHEN u > 0.9 THEN 'CRITICAL' WHEN u > 0.8 THEN 'HIGH' ELSE 'NORMAL' END AS risk_status, 'RISK_COMMITTEE' AS limit_approved_by, {AS_OF} - 365 AS limit_effective_date, {AS_OF} + 365 AS limit_expiry_date,
    'QUARTERLY' AS limit_review_frequency, CAST(NULL AS DATE) AS last_breach_date, 0 AS breach_count_30_days, CASE WHEN u > 0.8 THEN 1 ELSE 0 END AS alert_count_30_days, {AS_OF} - 90 AS last_limit_review_date, {AS_OF} + 90 AS next_review_date
  FROM (SELECT *, CAST(e AS DOUBLE) / lim AS u FROM (SELECT risk_type, business_line, geography, currency, sum(total_exposure_chf) AS e, CAST(CASE risk_type WHEN 'CREDIT' THEN 1000000000 WHEN 'MARKET' THEN 500000000 WHEN 'OPERATIONAL' THEN 100000000 ELSE 2000000000 END AS BIGINT) AS lim,
      CASE risk_type WHEN 'CREDIT' THEN 'EXPOSURE_LIMIT' WHEN 'MARKET' THEN 'VAR_LIMIT' WHEN 'OPERATIONAL' THEN 'LOSS_LIMIT' ELSE 'CASH_FLOW_LIMIT' END AS kind FROM ragg GROUP BY 1, 2, 3, 4) q) p"""
