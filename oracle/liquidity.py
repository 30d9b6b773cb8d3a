"""Liquidity coverage queries."""

from oracle import QUERIES, VIEWS, d, mean, pct, r

from tidemark.plans.lookups import DEPOSIT_TYPES, HQLA_ELIGIBILITY


def _rows(rows, types):
    def cell(v, t):
        if isinstance(v, bool):
            return str(v).upper()
        return f"CAST('{v}' AS {t})" if t else "'" + str(v).replace("'", "''") + "'"

    return "VALUES " + ", ".join("(" + ", ".join(cell(v, t) for v, t in zip(x, types, strict=True)) + ")" for x in rows)


VIEWS["elig"] = f"SELECT * FROM ({_rows(HQLA_ELIGIBILITY, ('', '', '', 'DECIMAL(5,2)', 'DECIMAL(5,4)', ''))}) t(asset_type, asset_name, regulatory_level, haircut_pct, haircut_factor, snb_coordinate)"
VIEWS["dtypes"] = f"SELECT * FROM ({_rows(DEPOSIT_TYPES, ('', '', 'DECIMAL(5,4)', '', ''))}) t(deposit_type, deposit_name, base_run_off_rate, allows, snb_coordinate)"
VIEWS["hold"] = "SELECT h.*, e.* EXCLUDE (asset_type), market_value_chf * haircut_factor AS weighted_value_chf FROM in_hqla_holdings h JOIN elig e ON h.asset_type = e.asset_type"
VIEWS["dep"] = """
  SELECT *, balance_chf * final_run_off_rate AS outflow_amount_chf FROM (
    SELECT b.*, deposit_name, base_run_off_rate, snb_coordinate, CAST(greatest(0.03, least(1.0, base_run_off_rate - CASE WHEN allows AND product_count >= 3 THEN 0.02 ELSE 0 END - CASE WHEN allows AND has_direct_debit THEN 0.01 ELSE 0 END
      + CASE WHEN account_tenure_days < 540 THEN 0.05 ELSE 0 END)) AS DECIMAL(8,4)) AS final_run_off_rate FROM in_deposits b JOIN dtypes t ON b.deposit_type = t.deposit_type) q"""
QUERIES["hqla_holdings_detail"] = f"SELECT * REPLACE ({', '.join(f'{d(x)} AS {x}' for x in 'quantity market_value_ccy market_value_chf haircut_pct haircut_factor weighted_value_chf'.split())}) FROM hold"
QUERIES["deposit_balances_detail"] = f"SELECT * REPLACE ({', '.join(f'{d(x)} AS {x}' for x in 'balance_ccy balance_chf base_run_off_rate final_run_off_rate outflow_amount_chf'.split())}) FROM dep"
VIEWS["hqla1"] = f"""
  SELECT as_of_date, hqla_level, asset_type, n AS holdings_count, mv AS market_value_chf, haircut_pct, {r('w')} AS hqla_value_chf, {pct('w', 'sum(w) OVER (PARTITION BY as_of_date)')} AS pct_of_total_hqla
  FROM (SELECT as_of_date, regulatory_level AS hqla_level, asset_type, count(*) AS n, sum(market_value_chf) AS mv, max(haircut_pct) AS haircut_pct, sum(weighted_value_chf) AS w FROM hold WHERE hqla_eligible GROUP BY 1, 2, 3) q"""
QUERIES["lcr_hqla"] = f"SELECT * REPLACE ({d('market_value_chf')} AS market_value_chf, {d('haircut_pct')} AS haircut_pct) FROM hqla1"
VIEWS["out0"] = "SELECT as_of_date, counterparty_type, count(*) AS n, count(DISTINCT customer_id) AS u, sum(balance_chf) AS b, sum(outflow_amount_chf) AS o FROM dep WHERE account_status = 'ACTIVE' GROUP BY 1, 2"
VIEWS["out1"] = f"""
  SELECT as_of_date, counterparty_type, n AS account_count, u AS customer_count, b AS balance_chf, {r('CAST(o AS DOUBLE) / nullif(CAST(b AS DOUBLE), 0)', 4)} AS run_off_rate, {r('o')} AS outflow_amount_chf,
    {pct('o', 'sum(o) OVER (PARTITION BY as_of_date)')} AS pct_of_total_outflows, {pct('b', 'sum(b) OVER (PARTITION BY as_of_date)')} AS pct_of_total_deposits FROM out0"""
QUERIES["lcr_outflow"] = f"SELECT * REPLACE ({d('balance_chf')} AS balance_chf) FROM out1"
_lv = lambda x: f"sum(CASE WHEN regulatory_level = '{x}' THEN weighted_value_chf ELSE 0 END)"
_ln = lambda x: f"count(CASE WHEN regulatory_level = '{x}' THEN 1 END)"
VIEWS["hqlac"] = f"""
  SELECT as_of_date, {r('l1')} AS l1_total, {r('a')} AS l2a_total, {r('b')} AS l2b_total, {r('l2')} AS l2_uncapped, {r('least(l2, cap)')} AS l2_capped, {r('CAST(l1 AS DOUBLE) + least(l2, cap)')} AS hqla_total, n1 AS l1_count, n2 AS l2a_count, n3 AS l2b_count,
    n1 + n2 + n3 AS total_holdings, 3 * (a + b) > 2 * l1 AS cap_applied, {r('greatest(CAST(3 * (a + b) - 2 * l1 AS DOUBLE) / 3, 0)')} AS discarded_l2, {r('cap')} AS max_l2_allowed, {r('least(l2, cap) / nullif(CAST(l1 AS DOUBLE), 0) * 100')} AS l2_to_l1_pct
  FROM (SELECT *, CAST(a + b AS DOUBLE) AS l2, CAST(l1 AS DOUBLE) * 2 / 3 AS cap FROM (SELECT as_of_date, {_lv('L1')} AS l1, {_lv('L2A')} AS a, {_lv('L2B')} AS b, {_ln('L1')} AS n1, {_ln('L2A')} AS n2, {_ln('L2B')} AS n3 FROM hold WHERE hqla_eligible GROUP BY 1) q) p"""
QUERIES["hqla_calculation"] = "SELECT * FROM hqlac"
_p = lambda p, x: f"sum(CASE WHEN counterparty_type = '{p}' THEN {x} ELSE 0 END)"
VIEWS["outc"] = f"""
  SELECT as_of_date, {r('r')} AS outflow_retail, {r('c')} AS outflow_corp, {r('f')} AS outflow_fi, {r('r + c + f')} AS outflow_total, CAST(nr AS BIGINT) AS retail_accounts, CAST(nc AS BIGINT) AS corp_accounts, CAST(nf AS BIGINT) AS fi_accounts,
    CAST(nr + nc + nf AS BIGINT) AS total_accounts, coalesce({pct('r', 'br')}, 0) AS retail_effective_run_off_pct, coalesce({pct('c', 'bc')}, 0) AS corp_effective_run_off_pct
  FROM (SELECT as_of_date, {_p('RETAIL', 'o')} AS r, {_p('CORPORATE', 'o')} AS c, {_p('FINANCIAL_INSTITUTION', 'o')} AS f, {_p('RETAIL', 'n')} AS nr, {_p('CORPORATE', 'n')} AS nc, {_p('FINANCIAL_INSTITUTION', 'n')} AS nf, {_p('RETAIL', 'b')} AS br, {_p('CORPORATE', 'b')} AS bc FROM out0 GROUP BY 1) q"""
QUERIES["outflow_calculation"] = "SELECT * FROM outc"
_keep = "l1_total l2a_total l2b_total l2_uncapped l2_capped hqla_total discarded_l2 total_holdings outflow_retail outflow_corp outflow_fi outflow_total".split()
VIEWS["lcrd"] = f"""
  SELECT *, CASE WHEN outflow_total > 0 THEN {r('hqla_total / nullif(outflow_total, 0) * 100')} ELSE 9999.99 END::DOUBLE AS lcr_ratio,
    CASE WHEN outflow_total = 0 THEN 'N/A' WHEN hqla_total / outflow_total * 100 >= 100 THEN 'PASS' WHEN hqla_total / outflow_total * 100 >= 95 THEN 'WARNING' ELSE 'FAIL' END AS lcr_status,
    CASE WHEN outflow_total = 0 THEN 'GRAY' WHEN hqla_total / outflow_total * 100 >= 100 THEN 'GREEN' WHEN hqla_total / outflow_total * 100 >= 95 THEN 'YELLOW' ELSE 'RED' END AS severity,
    {r('hqla_total - outflow_total')} AS lcr_buffer_chf, {r('(hqla_total - outflow_total) / nullif(outflow_total, 0) * 100')} AS lcr_buffer_pct
  FROM (SELECT as_of_date, 'BANK-1' AS bank_id, {', '.join(f'coalesce({x}, 0) AS {x}' for x in _keep)}, coalesce(cap_applied, FALSE) AS cap_applied, coalesce(total_accounts, 0) AS total_deposit_accounts FROM hqlac FULL JOIN outc USING (as_of_date)) q"""
QUERIES["lcr_daily"] = "SELECT * FROM lcrd"
_w = lambda n: f"(ORDER BY as_of_date ROWS {n - 1} PRECEDING)"
VIEWS["lcrt"] = f"""
  SELECT as_of_date, lcr_ratio, {', '.join(f"{r(f'avg(lcr_ratio) OVER {_w(n)}')} AS lcr_{n}d_avg" for n in (7, 30, 90))}, {r(f'stddev_samp(lcr_ratio) OVER {_w(30)}')} AS lcr_30d_volatility, min(lcr_ratio) OVER {_w(30)} AS lcr_30d_min,
    max(lcr_ratio) OVER {_w(30)} AS lcr_30d_max, {r('lcr_ratio - lag(lcr_ratio) OVER (ORDER BY as_of_date)')} AS lcr_dod_change, lcr_status, severity, count(CASE WHEN lcr_ratio < 100 THEN 1 END) OVER {_w(3)} AS consecutive_breaches_3d,
    coalesce(abs(lcr_ratio - lag(lcr_ratio) OVER (ORDER BY as_of_date)) > 10, FALSE) AS high_volatility_alert, count(CASE WHEN lcr_ratio < 100 THEN 1 END) OVER {_w(3)} >= 3 AS sustained_breach_alert, lcr_ratio < 95 AS critical_breach_alert FROM lcrd"""
QUERIES["lcr_trend"] = "SELECT * FROM lcrt"
_st = lambda s: f"count(CASE WHEN lcr_status = '{s}' THEN 1 END)"
VIEWS["lcrm"] = f"""
  SELECT CAST(date_trunc('month', as_of_date) AS DATE) AS reporting_month, count(*) AS trading_days, {r('avg(lcr_ratio)')} AS lcr_avg, min(lcr_ratio) AS lcr_min, max(lcr_ratio) AS lcr_max, {r('stddev_samp(lcr_ratio)')} AS lcr_volatility, {r('avg(hqla_total)')} AS avg_hqla_total,
    {r('avg(outflow_total)')} AS avg_outflow_total, {_st('FAIL')} AS breach_days, {_st('WARNING')} AS warning_days, {_st('PASS')} AS compliant_days, {pct(_st('FAIL'), 'count(*)')} AS breach_rate_pct FROM lcrd GROUP BY 1"""
QUERIES["lcr_monthly_summary"] = "SELECT * FROM lcrm"
_hb = lambda lv, x: f"(SELECT {x} FROM hold WHERE as_of_date = (SELECT max(as_of_date) FROM hold) AND regulatory_level = '{lv}' HAVING count(*) > 0)"
_db = lambda p, x: f"(SELECT {x} FROM dep WHERE as_of_date = (SELECT max(as_of_date) FROM dep) AND counterparty_type = '{p}' HAVING count(*) > 0)"
_DX = {"account_count": "count(*)", "customer_count": "count(DISTINCT customer_id)", "balance_chf": r("sum(balance_chf)"), "avg_run_off_pct": r(f"{mean('final_run_off_rate')} * 100")}
QUERIES["lcr_monitoring"] = f"""
  SELECT l.as_of_date AS reporting_date, bank_id, l.lcr_ratio, l.lcr_status, l.severity, hqla_total, l1_total, l2a_total, l2b_total, l2_capped, cap_applied, discarded_l2, outflow_total, outflow_retail, outflow_corp, outflow_fi, lcr_buffer_chf, lcr_buffer_pct,
    t.* EXCLUDE (as_of_date, lcr_ratio, lcr_status, severity), {', '.join(f"{_hb(x, 'count(*)')} AS {x.lower()}_holding_count, {_hb(x, r('sum(market_value_chf)'))} AS {x.lower()}_gross_value" for x in ('L1', 'L2A', 'L2B'))},
    {_hb('L1', "string_agg(DISTINCT currency, ', ' ORDER BY currency)")} AS l1_currencies, {', '.join(f"{_db(p, x)} AS {n}_{k}" for p, n in (('RETAIL', 'retail'), ('CORPORATE', 'corp')) for k, x in _DX.items())}
  FROM lcrd l CROSS JOIN lcrt t WHERE l.as_of_date = (SELECT max(as_of_date) FROM lcrd) AND t.as_of_date = (SELECT max(as_of_date) FROM lcrt)"""
_al = lambda s, t, m, a: f"[{{'severity': '{s}', 'type': '{t}', 'message': {m}, 'action': '{a}'}}]"
_n2 = lambda x: f"printf('%.2f', {x})"
VIEWS["alrt"] = f"""
  SELECT as_of_date, lcr_ratio, lcr_status, severity, list_concat(list_concat(ra, mo), ca) AS all_alerts, CAST(len(ra) + len(mo) + len(ca) AS INTEGER) AS total_alert_count,
    CASE WHEN len(ra) > 0 AND ra[1].severity = 'CRITICAL' THEN 'CRITICAL' WHEN len(ra) > 0 THEN 'HIGH' WHEN len(mo) > 0 THEN 'MEDIUM' WHEN len(ca) > 0 THEN 'INFO' ELSE 'NONE' END AS highest_severity
  FROM (SELECT l.as_of_date, l.lcr_ratio, l.lcr_status, l.severity,
    CASE WHEN l.lcr_ratio < 95 THEN {_al('CRITICAL', 'LCR_BREACH_CRITICAL', f"'LCR of ' || {_n2('l.lcr_ratio')} || '% lies under the critical mark of 95%'", 'Tell the head of treasury now')}
      WHEN l.lcr_ratio < 100 THEN {_al('HIGH', 'LCR_BREACH', f"'LCR of ' || {_n2('l.lcr_ratio')} || '% lies under the required 100%'", 'Report to the supervisor within a day and start the recovery plan')}
      WHEN l.lcr_ratio < 105 AND consecutive_breaches_3d >= 2 THEN {_al('MEDIUM', 'LCR_WARNING', f"'LCR of ' || {_n2('l.lcr_ratio')} || '% close to the minimum, days under it of the last three: ' || consecutive_breaches_3d", 'Watch daily; add liquid assets if it lasts')} ELSE [] END AS ra,
    CASE WHEN abs(lcr_dod_change) > 10 THEN {_al('HIGH', 'HIGH_VOLATILITY', f"'LCR moved within a day by ' || {_n2('lcr_dod_change')} || ' points'", 'Find the holdings or deposits behind the move')}
      WHEN abs(lcr_dod_change) > 5 THEN {_al('MEDIUM', 'MODERATE_VOLATILITY', f"'LCR moved within a day by ' || {_n2('lcr_dod_change')} || ' points'", 'Compare positions with the day before')} ELSE [] END AS mo,
    CASE WHEN cap_applied THEN {_al('INFO', 'L2_CAP_APPLIED', f"'Level 2 over its share of 40%; not counted, in millions of CHF: ' || {_n2('discarded_l2 / 1000000')}", 'Hold more level 1 or less level 2 assets')} ELSE [] END AS ca
    FROM lcrd l CROSS JOIN lcrt t WHERE l.as_of_date = (SELECT max(as_of_date) FROM lcrd) AND t.as_of_date = (SELECT max(as_of_date) FROM lcrt)) q"""
# arrays of structs are shown as text so that engines agree on their form
QUERIES["lcr_alerts"] = "SELECT * REPLACE (array_to_string(list_transform(all_alerts, lambda x: x.severity || '/' || x.type || '/' || x.message || '/' || x.action), '; ') AS all_alerts) FROM alrt"
_share = lambda x, y: r(f"{x} / nullif({y}, 0) * 100", 1)
VIEWS["lcrnow"] = f"""
  SELECT as_of_date AS reporting_date, bank_id, lcr_ratio AS lcr_ratio_pct, lcr_status AS compliance_status, severity AS status_color, hqla_total AS hqla_total_chf, l1_total AS level1_assets_chf, l2a_total AS level2a_assets_chf, l2b_total AS level2b_assets_chf,
    l2_capped AS level2_assets_after_cap_chf, l2_uncapped AS level2_assets_before_cap_chf, {_share('l1_total', 'hqla_total')} AS level1_pct_of_hqla, {_share('l2_capped', 'hqla_total')} AS level2_pct_of_hqla, cap_applied AS is_40pct_cap_applied, discarded_l2 AS discarded_level2_chf,
    {r('l2_uncapped / nullif(l1_total, 0) * 150 - 40', 1)} AS cap_buffer_pct, outflow_total AS net_cash_outflows_chf, outflow_retail AS retail_outflows_chf, outflow_corp AS corporate_outflows_chf, outflow_fi AS financial_inst_outflows_chf,
    {_share('outflow_retail', 'outflow_total')} AS retail_pct_of_outflows, {_share('outflow_corp', 'outflow_total')} AS corporate_pct_of_outflows, {_share('outflow_fi', 'outflow_total')} AS fi_pct_of_outflows, lcr_buffer_chf AS liquidity_buffer_chf, lcr_buffer_pct AS buffer_pct_of_outflows,
    CASE WHEN lcr_buffer_pct >= 50 THEN 'STRONG' WHEN lcr_buffer_pct >= 20 THEN 'ADEQUATE' WHEN lcr_buffer_pct >= 10 THEN 'MODERATE' WHEN lcr_buffer_pct >= 0 THEN 'MINIMAL' ELSE 'BREACH' END AS buffer_strength, total_holdings AS hqla_securities_count, total_deposit_accounts AS deposit_accounts_count
  FROM lcrd WHERE as_of_date = (SELECT max(as_of_date) FROM lcrd)"""
QUERIES["lcr_current"] = "SELECT * FROM lcrnow"
QUERIES["hqla_breakdown"] = f"""
  SELECT as_of_date AS reporting_date, hqla_level AS asset_level, asset_type, {d('sum(market_value_chf)')} AS market_value_chf, {r('CAST(sum(market_value_chf) AS DOUBLE) / 1000000000')} AS market_value_billions, {r(mean('haircut_pct'))} AS haircut_pct, sum(hqla_value_chf) AS hqla_value_chf,
    {r('sum(hqla_value_chf) / 1000000000')} AS hqla_value_billions, count(*) AS holdings_count, {_share('sum(hqla_value_chf)', '(SELECT hqla_total FROM lcrd WHERE as_of_date = (SELECT max(as_of_date) FROM hqla1))')} AS pct_of_total_hqla,
    CASE hqla_level WHEN 'L1' THEN 0 WHEN 'L2A' THEN 15 WHEN 'L2B' THEN 50 END AS standard_haircut_pct, CASE hqla_level WHEN 'L1' THEN 1 WHEN 'L2A' THEN 2 WHEN 'L2B' THEN 3 ELSE 4 END AS level_sort_order,
    CASE hqla_level WHEN 'L1' THEN 'Level 1, taken in full' WHEN 'L2A' THEN 'Level 2A, less 15%' WHEN 'L2B' THEN 'Level 2B, less half' ELSE 'Unknown' END AS quality_description
  FROM hqla1 WHERE as_of_date = (SELECT max(as_of_date) FROM hqla1) GROUP BY 1, 2, 3"""
QUERIES["outflow_breakdown"] = f"""
  SELECT as_of_date AS reporting_date, counterparty_type, {d('balance_chf')} AS deposit_balance_chf, {r('CAST(balance_chf AS DOUBLE) / 1000000000')} AS deposit_balance_billions, {r('run_off_rate * 100')} AS avg_run_off_rate_pct, {r('run_off_rate * 100')} AS min_run_off_rate_pct, {r('run_off_rate * 100')} AS max_run_off_rate_pct,
    outflow_amount_chf, {r('outflow_amount_chf / 1000000000')} AS outflow_amount_billions, account_count, {_share('outflow_amount_chf', '(SELECT outflow_total FROM lcrd WHERE as_of_date = (SELECT max(as_of_date) FROM out1))')} AS pct_of_total_outflows, {_share('CAST(balance_chf AS DOUBLE)', 'sum(CAST(balance_chf AS DOUBLE)) OVER ()')} AS pct_of_total_deposits,
    {_share('outflow_amount_chf', 'CAST(balance_chf AS DOUBLE)')} AS effective_run_off_pct, CASE WHEN counterparty_type LIKE 'RETAIL%' THEN 'Retail Deposits' WHEN counterparty_type LIKE 'CORPORATE%' THEN 'Corporate Deposits' WHEN counterparty_type = 'FINANCIAL_INSTITUTION' THEN 'Wholesale Funding' ELSE 'Other' END AS counterparty_category,
    CASE WHEN {r('run_off_rate * 100')} <= 5 THEN 'Very Stable' WHEN run_off_rate * 100 <= 15 THEN 'Stable' WHEN run_off_rate * 100 <= 30 THEN 'Moderate Risk' WHEN run_off_rate * 100 <= 50 THEN 'High Risk' ELSE 'Very High Risk' END AS stability_rating,
    CASE counterparty_type WHEN 'RETAIL_STABLE' THEN 1 WHEN 'RETAIL_LESS_STABLE' THEN 2 WHEN 'RETAIL_INSURED' THEN 3 WHEN 'CORPORATE_OPERATIONAL' THEN 4 WHEN 'CORPORATE_NON_OPERATIONAL' THEN 5 WHEN 'FINANCIAL_INSTITUTION' THEN 6 WHEN 'WHOLESALE_FUNDING' THEN 7 ELSE 8 END AS display_order
  FROM out1 WHERE as_of_date = (SELECT max(as_of_date) FROM out1)"""
_lg = "lag(lcr_ratio) OVER (ORDER BY as_of_date)"
QUERIES["lcr_trend_90day"] = f"""
  SELECT as_of_date AS reporting_date, lcr_ratio AS lcr_ratio_pct, lcr_status AS compliance_status, severity AS status_color, hqla_total AS hqla_total_chf, outflow_total AS outflow_total_chf, lcr_buffer_chf AS liquidity_buffer_chf, {r(f'avg(lcr_ratio) OVER {_w(7)}')} AS ma7_lcr_ratio, {r(f'avg(lcr_ratio) OVER {_w(30)}')} AS ma30_lcr_ratio,
    {r(f'lcr_ratio - {_lg}')} AS day_over_day_change_pct, {r(f'(lcr_ratio - {_lg}) / nullif({_lg}, 0) * 100')} AS day_over_day_change_percent,
    CASE WHEN abs({r(f'lcr_ratio - {_lg}', 6)}) <= 2 THEN 'Stable' WHEN abs({r(f'lcr_ratio - {_lg}', 6)}) <= 5 THEN 'Moderate' WHEN abs({r(f'lcr_ratio - {_lg}', 6)}) <= 10 THEN 'High' ELSE 'Very High' END AS volatility_rating,
    lcr_ratio < 100 AS is_breach, lcr_ratio < 105 AS is_warning, count(CASE WHEN lcr_ratio < 100 THEN 1 END) OVER {_w(3)} AS consecutive_breach_days_3day, CASE WHEN lcr_ratio > {_lg} THEN 'Improving' WHEN lcr_ratio < {_lg} THEN 'Declining' ELSE 'Stable' END AS trend_direction,
    {r('lcr_ratio - 100', 1)} AS distance_from_minimum_pct, {r('lcr_ratio - 110', 1)} AS distance_from_target_pct, cap_applied AS is_40pct_cap_applied FROM lcrd WHERE as_of_date >= DATE '2001-11-04' - 90"""
VIEWS["active"] = """
  SELECT as_of_date AS alert_date, a.type AS alert_type, a.severity, a.message AS description, lcr_ratio AS current_lcr_ratio, CAST(CASE a.type WHEN 'LCR_BREACH_CRITICAL' THEN 95 WHEN 'LCR_BREACH' THEN 100 WHEN 'LCR_WARNING' THEN 100 WHEN 'L2_CAP_APPLIED' THEN 66.67 END AS DOUBLE) AS alert_threshold, a.action AS recommended_action,
    CASE a.severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'INFO' THEN 4 ELSE 5 END AS severity_priority, age AS days_since_alert, CASE WHEN age = 0 THEN 'Today' WHEN age = 1 THEN 'Yesterday' WHEN age <= 7 THEN 'This Week' ELSE 'Older' END AS alert_age,
    CASE WHEN a.type IN ('LCR_BREACH','LCR_BREACH_CRITICAL','LCR_WARNING') THEN 'Compliance Alert' WHEN a.type IN ('HIGH_VOLATILITY','MODERATE_VOLATILITY') THEN 'Risk Alert' WHEN a.type = 'L2_CAP_APPLIED' THEN 'Portfolio Alert' ELSE 'Operational Alert' END AS alert_category, a.type = 'LCR_BREACH' AND age * 24 > 24 AS escalation_required
  FROM (SELECT *, unnest(all_alerts) AS a, date_diff('day', as_of_date, DATE '2001-11-05') AS age FROM alrt WHERE as_of_date >= DATE '2001-11-05' - 30) q"""
QUERIES["alerts_active"] = "SELECT * FROM active"
