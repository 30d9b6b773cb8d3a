"""Messages, sources, metric models, quality and report queries."""

from oracle import QUERIES, VIEWS, d, mean, pct, r
from oracle.bank import AS_OF

NUM = "CAST(o_orderkey AS VARCHAR)"
DAY = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"
_c = lambda x: f"CASE {x} % 3 WHEN 0 THEN 'CH' WHEN 1 THEN 'DE' ELSE 'GB' END"
_ccy = "CASE o_orderkey % 5 WHEN 0 THEN 'CHF' WHEN 1 THEN 'EUR' WHEN 2 THEN 'USD' WHEN 3 THEN 'GBP' ELSE 'SEK' END"
_min = "CASE o_orderkey % 3 WHEN 0 THEN 5 WHEN 1 THEN 20 ELSE 59 END"
_amt = "CAST(o_totalprice AS DECIMAL(18,2))"
_made = f"o_orderdate + INTERVAL 10 HOUR + to_minutes({_min}) + INTERVAL 30 SECOND"
_mark = "CASE WHEN j = 0 THEN '' ELSE '-' || j END"
_each = "FROM orders, unnest(generate_series(0, o_orderkey % 3)) AS g(j)"
# the expected rows come from the orders themselves, not from parsing the documents
VIEWS["p008"] = f"""
  SELECT 'pacs008_' || {NUM} || '.xml' AS source_filename, o_orderdate AS source_load_timestamp, {DAY} || '-MSG' || {NUM} AS message_id, {_made} AS creation_datetime, CAST(1 + o_orderkey % 3 AS INTEGER) AS number_of_transactions, CAST(j + 1 AS INTEGER) AS transaction_index, {_ccy} AS group_settlement_currency, {_amt} AS group_settlement_amount, 'CLRG' AS settlement_method,
    CASE WHEN o_orderkey % 2 = 0 THEN 'TARGET2' ELSE 'SIC' END AS clearing_system_code, 'I' || {NUM} || {_mark} AS instruction_id, 'E' || {NUM} || {_mark} AS end_to_end_id, 'T' || {NUM} || {_mark} AS transaction_id, 'NORM' AS instruction_priority, 'SEPA' AS service_level_code, CAST(NULL AS VARCHAR) AS local_instrument_code, {_ccy} AS transaction_currency, {_amt} AS transaction_amount,
    CAST(o_orderdate AS DATE) AS interbank_settlement_date, 'SHAR' AS charges_bearer, 'BA' || o_custkey % 7 AS instructing_agent_bic, 'BB' || o_orderkey % 7 AS instructed_agent_bic, 'BA' || o_custkey % 7 AS debtor_agent_bic, 'BB' || o_orderkey % 7 AS creditor_agent_bic, 'Debtor ' || {NUM} AS debtor_name, 'Road ' || {NUM} AS debtor_street, CAST(o_custkey AS VARCHAR) AS debtor_postal_code,
    'Town' AS debtor_city, {_c('o_custkey')} AS debtor_country, 'DI' || {NUM} AS debtor_iban, 'Creditor ' || {NUM} AS creditor_name, 'Road ' || {NUM} AS creditor_street, CAST(o_custkey AS VARCHAR) AS creditor_postal_code, 'Town' AS creditor_city, {_c('o_orderkey')} AS creditor_country, 'CI' || {NUM} AS creditor_iban, o_orderpriority AS remittance_information,
    {_amt} >= 100000 AS is_high_value_payment, o_orderkey % 2 = 0 AS is_target2_payment, {_c('o_custkey')} || ' -> ' || {_c('o_orderkey')} AS payment_corridor, CASE WHEN o_custkey % 3 = o_orderkey % 3 THEN 'DOMESTIC' ELSE 'CROSS_BORDER' END AS payment_type_classification {_each}"""
QUERIES["credit_transfers"] = f"SELECT p.* REPLACE ({d('group_settlement_amount')} AS group_settlement_amount, {d('transaction_amount')} AS transaction_amount), CAST(length(m.raw_xml) AS INTEGER) AS xml_size_bytes FROM p008 p JOIN in_messages m ON m.file_name = p.source_filename"
_ts = "CASE (o_orderkey + j) % 5 WHEN 0 THEN 'ACCP' WHEN 1 THEN 'RJCT' WHEN 2 THEN 'PDNG' WHEN 3 THEN 'ACSC' ELSE 'ACSP' END"
_gs = "CASE o_orderkey % 3 WHEN 0 THEN 'ACCP' WHEN 1 THEN 'RJCT' ELSE 'PDNG' END"
VIEWS["p002"] = f"""
  SELECT 'pacs002_' || {NUM} || '.xml' AS source_filename, o_orderdate AS source_load_timestamp, 'R' || {NUM} AS message_id, o_orderdate + INTERVAL 11 HOUR AS creation_datetime, 'BB' || o_orderkey % 7 AS instructing_agent_bic, 'BA' || o_custkey % 7 AS instructed_agent_bic, {DAY} || '-MSG' || {NUM} AS original_message_id, 'pacs.008.001.08' AS original_message_name_id,
    {_made} AS original_creation_datetime, {_gs} AS group_status, CAST(j + 1 AS INTEGER) AS transaction_index, CASE WHEN o_orderkey % 6 = 0 THEN 'X' ELSE 'E' || {NUM} || {_mark} END AS original_end_to_end_id, {_ts} AS transaction_status, 'AC01' AS status_reason, CAST(NULL AS VARCHAR) AS original_instruction_id, CASE WHEN o_orderkey % 12 = 0 THEN 'X' ELSE 'T' || {NUM} || {_mark} END AS original_transaction_id, CAST(NULL AS TIMESTAMP) AS acceptance_datetime,
    CASE (o_orderkey + j) % 5 WHEN 0 THEN 'ACCEPTED' WHEN 1 THEN 'REJECTED' WHEN 2 THEN 'PENDING' WHEN 3 THEN 'ACCEPTED_SETTLEMENT_COMPLETED' ELSE 'ACCEPTED_SETTLEMENT_IN_PROCESS' END AS transaction_status_description, CASE o_orderkey % 3 WHEN 0 THEN 'ACCEPTED' WHEN 1 THEN 'REJECTED' ELSE 'PENDING' END AS group_status_description, (o_orderkey + j) % 5 IN (0, 3, 4) AS is_positive_response, (o_orderkey + j) % 5 = 1 AS is_rejection,
    TRUE AS is_pacs008_response, CASE WHEN o_orderdate >= DATE '2000-01-01' THEN substr({DAY}, 1, 8) END AS original_message_date {_each} WHERE o_orderkey % 10 <> 0"""
QUERIES["status_reports"] = "SELECT p.*, CAST(length(m.raw_xml) AS INTEGER) AS xml_size_bytes FROM p002 p JOIN in_messages m ON m.file_name = p.source_filename"
QUERIES["payment_lifecycle"] = f"""
  SELECT a.message_id AS pacs008_message_id, b.original_message_id AS pacs002_original_message_id, a.end_to_end_id AS pacs008_end_to_end_id, b.original_end_to_end_id AS pacs002_original_end_to_end_id, transaction_status, transaction_status_description, group_status, group_status_description, status_reason, is_rejection, is_positive_response, transaction_currency,
    {d('transaction_amount')} AS transaction_amount, debtor_name, creditor_name, payment_corridor, payment_type_classification, is_high_value_payment, is_target2_payment, a.source_filename AS pacs008_file, b.source_filename AS pacs002_file, a.source_load_timestamp AS pacs008_load_timestamp, b.source_load_timestamp AS pacs002_load_timestamp, date_diff('minute', original_creation_datetime, b.creation_datetime) AS ack_time
  FROM p008 a LEFT JOIN p002 b ON b.original_message_id = a.message_id AND (b.original_end_to_end_id = a.end_to_end_id OR b.original_transaction_id = a.transaction_id)"""

# ---- sources ----------------------------------------------------------------------------------
_tx = f"SELECT booking_date, value_date, transaction_id, account_id, {d('amount')} AS amount, currency, {d('base_amount')} AS base_amount, base_currency, {d('fx_rate')} AS fx_rate, counterparty_account, description, CAST(NULL AS TIMESTAMP) AS created_at FROM in_transactions"
QUERIES["csv_load"] = _tx
QUERIES["stream_ingest"] = _tx
QUERIES["csv_load_by_name"] = "SELECT account_id, account_type, base_currency, customer_id, status FROM in_accounts"
QUERIES["csv_load_null_tokens"] = "SELECT customer_id, street_address, city, state, zipcode, country, insert_timestamp_utc FROM in_addresses"
QUERIES["loose_json"] = "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"
QUERIES["ordered_load"] = "SELECT transaction_id, account_id FROM in_transactions WHERE account_id IN (SELECT account_id FROM in_accounts WHERE account_type <> 'SAVINGS')"
QUERIES["insert_if_absent"] = "SELECT transaction_id, account_id FROM in_transactions"

# ---- metrics and quality ----------------------------------------------------------------------
VIEWS["once"] = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY overall_risk_score DESC, sanctions_match_id DESC NULLS LAST, exposed_person_exact_match_id DESC NULLS LAST, exposed_person_fuzzy_match_id DESC NULLS LAST, sanctions_match_type_detail DESC NULLS LAST) AS rn FROM c360) WHERE rn = 1"""
QUERIES["metrics_customer_360"] = f"SELECT country, region, count(*) AS customer_count, {d('sum(total_balance)')} AS total_balance_sum, {r(mean('total_balance'))} AS avg_balance FROM once LEFT JOIN (SELECT employee_id, region FROM emp WHERE position_level = 'CLIENT_ADVISOR') e ON e.employee_id = current_advisor_employee_id GROUP BY 1, 2"
QUERIES["metrics_employee_advisor"] = f"SELECT region, count(*) AS advisor_count, {r('sum(total_portfolio_value)')} AS total_aum_sum, {r(mean('total_portfolio_value'))} AS avg_aum, CAST(sum(total_clients) AS BIGINT) AS total_clients_sum, {r('avg(CASE WHEN total_clients > 0 THEN 100 ELSE 0 END)')} AS avg_retention FROM advp GROUP BY 1"
QUERIES["metrics_compliance_monitoring"] = f"SELECT currency, account_tier, count(*) AS transaction_count, {d('sum(amount)')} AS total_amount, {r(mean('amount'))} AS avg_amount, count(CASE WHEN overall_anomaly_classification IN ('HIGH_ANOMALY','CRITICAL_ANOMALY') THEN 1 END) AS high_risk_count FROM scored s LEFT JOIN (SELECT customer_id, account_tier FROM once) c USING (customer_id) GROUP BY 1, 2"
QUERIES["metrics_wealth_management"] = f"SELECT portfolio_type, country, count(*) AS portfolio_count, {r('sum(total_portfolio_value_chf)')} AS total_aum, {r(mean('total_portfolio_value_chf'))} AS avg_portfolio_value, {r('avg(total_portfolio_twr_percentage)')} AS avg_return, {r('avg(sharpe_ratio)')} AS avg_sharpe, max(total_portfolio_twr_percentage) AS best_return FROM perf p LEFT JOIN (SELECT customer_id, country FROM once) c USING (customer_id) GROUP BY 1, 2"
QUERIES["metrics_risk_reporting"] = f"SELECT risk_type, count(customer_id) AS customer_risk_count, {d('sum(total_exposure_chf)')} AS total_exposure_sum, {r('sum(total_capital_requirement_chf)')} AS total_capital_sum, {r(mean('total_exposure_chf'))} AS avg_exposure, {d('max(max_single_exposure_chf)')} AS max_concentration FROM ragg GROUP BY 1"
_DIMS = {
    "lcr_current": ("lcrnow", "compliance_status, buffer_strength, lcr_ratio_pct"), "hqla_breakdown": ("hqla1", None), "outflow_breakdown": ("out1", None), "lcr_trend": (None, None),
    "lcr_alerts": ("active", "alert_type, severity, alert_category"), "loan_portfolio": ("o7", "country, application_status, loan_count"), "loan_ltv": ("o8", "ltv_bucket, loan_count"), "loan_funnel": ("o9", "country, channel, total_applications"),
    "loan_affordability": ("o10", "country, affordability_result, assessment_count"), "loan_compliance": ("o14", "compliance_status, application_status, country"),
}
for _k, (_v, _cols) in _DIMS.items():
    if _v and _cols:
        QUERIES[f"metrics_{_k}"] = f"SELECT DISTINCT {_cols} FROM {_v}"
QUERIES["metrics_hqla_breakdown"] = "SELECT DISTINCT hqla_level AS asset_level, asset_type FROM hqla1 WHERE as_of_date = (SELECT max(as_of_date) FROM hqla1)"
QUERIES["metrics_outflow_breakdown"] = "SELECT DISTINCT counterparty_type, account_count FROM out1 WHERE as_of_date = (SELECT max(as_of_date) FROM out1)"
QUERIES["metrics_lcr_trend"] = "SELECT DISTINCT as_of_date AS reporting_date, lcr_ratio AS lcr_ratio_pct, lcr_status AS compliance_status FROM lcrd WHERE as_of_date >= DATE '2001-11-04' - 90"
QUERIES["wealth_detailed"] = "SELECT p.*, full_name AS customer_name, country AS customer_country, account_tier AS customer_tier, overall_risk_rating AS customer_risk_rating FROM perf p LEFT JOIN (SELECT DISTINCT customer_id, full_name, country, account_tier, overall_risk_rating FROM c360) c USING (customer_id)"
_req = ("customer_id", "first_name", "email", "phone")
QUERIES["quality_report"] = f"""
  SELECT *, {r('(completeness_percent + uniqueness_score + validity_score + timeliness_score) / 4')} AS overall_quality_score, 'customer' AS data_source, CASE WHEN {r('(completeness_percent + uniqueness_score + validity_score + timeliness_score) / 4')} >= 95 THEN 'A' WHEN {r('(completeness_percent + uniqueness_score + validity_score + timeliness_score) / 4')} >= 90 THEN 'B' WHEN {r('(completeness_percent + uniqueness_score + validity_score + timeliness_score) / 4')} >= 80 THEN 'C' ELSE 'D' END AS quality_grade,
    CASE WHEN {r('(completeness_percent + uniqueness_score + validity_score + timeliness_score) / 4')} >= 90 THEN 'GOOD' WHEN {r('(completeness_percent + uniqueness_score + validity_score + timeliness_score) / 4')} >= 80 THEN 'ACCEPTABLE' ELSE 'POOR' END AS quality_status, duplicate_records + invalid_records AS issues_count
  FROM (SELECT count(*) AS total_records, {pct(' + '.join(f'count({x})' for x in _req), f'count(*) * {len(_req)}')} AS completeness_percent, {', '.join(f'count(*) - count({x}) AS missing_{x}' for x in _req)},
    {pct("count(CASE WHEN risk_classification IN ('LOW','MEDIUM','HIGH') AND date_of_birth < onboarding_date THEN 1 END)", 'count(*)')} AS validity_score, count(*) - count(CASE WHEN risk_classification IN ('LOW','MEDIUM','HIGH') AND date_of_birth < onboarding_date THEN 1 END) AS invalid_records,
    greatest(date_diff('day', CAST(max(insert_timestamp_utc) AS DATE), {AS_OF}), 0) AS age_days, CAST(greatest(0, least(100, 101 - greatest(date_diff('day', CAST(max(insert_timestamp_utc) AS DATE), {AS_OF}), 0))) AS DOUBLE) AS timeliness_score FROM in_customers) a
  CROSS JOIN (SELECT count(*) AS unique_keys, CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS duplicate_records, {pct('count(CASE WHEN n = 1 THEN 1 END)', 'sum(n)')} AS uniqueness_score FROM (SELECT customer_id, count(*) AS n FROM in_customers GROUP BY 1) k) b"""
QUERIES["customer_completeness"] = f"SELECT count(*) AS total_customers, count(*) - count(first_name) AS missing_first_name, count(*) - count(family_name) AS missing_family_name, count(*) - count(email) AS missing_email, count(*) - count(date_of_birth) AS missing_dob, {pct('count(CASE WHEN first_name IS NOT NULL AND family_name IS NOT NULL AND email IS NOT NULL AND date_of_birth IS NOT NULL THEN 1 END)', 'count(*)')} AS completeness_percentage FROM customer_current"

# ---- reports ----------------------------------------------------------------------------------
_al = "overall_anomaly_classification IN ('CRITICAL_ANOMALY','HIGH_ANOMALY','MODERATE_ANOMALY')"
_ser = "overall_anomaly_classification IN ('CRITICAL_ANOMALY','HIGH_ANOMALY')"
_q = "value_date BETWEEN (SELECT max(value_date) FROM in_transactions) - 90 AND (SELECT max(value_date) FROM in_transactions)"
_k = lambda x, t="1": f"count(CASE WHEN {x} THEN {t} END)"
QUERIES["quarterly_alerts"] = f"""
  SELECT total_transactions, unique_accounts, {r('CAST(vol AS DOUBLE) / 1000000')} AS total_volume_million_usd, total_alerts, {r('total_alerts * 1000 / nullif(CAST(total_transactions AS DOUBLE), 0)')} AS alerts_per_1000_transactions, critical_alerts, high_alerts, immediate_review_required, likely_false_positives, likely_true_positives,
    {pct('likely_false_positives', 'total_alerts')} AS false_positive_rate_pct, {pct('likely_true_positives', 'total_alerts')} AS true_positive_rate_pct, s.*, {r('estimated_sar_filings * 10000 / nullif(CAST(total_transactions AS DOUBLE), 0)', 4)} AS sar_rate_per_10k_transactions, {r('total_alerts / nullif(CAST(estimated_sar_filings AS DOUBLE), 0)')} AS alerts_per_sar_ratio
  FROM (SELECT count(*) AS total_transactions, count(DISTINCT account_id) AS unique_accounts, sum(abs(amount)) AS vol FROM in_transactions WHERE {_q}) t CROSS JOIN (SELECT count(*) AS total_alerts, {_k("overall_anomaly_classification = 'CRITICAL_ANOMALY'")} AS critical_alerts, {_k("overall_anomaly_classification = 'HIGH_ANOMALY'")} AS high_alerts, {_k('requires_immediate_review')} AS immediate_review_required,
      {_k("overall_anomaly_classification = 'MODERATE_ANOMALY'")} AS likely_false_positives, {_k(_ser + ' AND requires_immediate_review')} AS likely_true_positives FROM scored WHERE {_q} AND {_al}) a
  CROSS JOIN (SELECT count(DISTINCT s.customer_id) AS estimated_sar_filings, {', '.join(f"count(DISTINCT CASE WHEN country = '{x}' THEN s.customer_id END) AS sar_{x.lower()}" for x in ('Switzerland', 'Germany', 'Austria'))}, count(DISTINCT CASE WHEN country IN ('Sweden','Norway','Denmark','Finland') THEN s.customer_id END) AS sar_nordics
      FROM scored s JOIN c360 c ON s.customer_id = c.customer_id WHERE {_q} AND {_ser} AND requires_immediate_review AND country IS NOT NULL) s"""
_sla = "CASE overall_anomaly_classification WHEN 'CRITICAL_ANOMALY' THEN 5 WHEN 'HIGH_ANOMALY' THEN 15 ELSE 30 END"
_ages = lambda p, a: f"{_k(f'{a} <= 7')} AS {p}_0_7_days, {_k(f'{a} BETWEEN 8 AND 30')} AS {p}_8_30_days, {_k(f'{a} BETWEEN 31 AND 90')} AS {p}_31_90_days, {_k(f'{a} > 90')} AS {p}_90_plus_days"
QUERIES["alert_backlog"] = f"""
  SELECT count(*) AS total_open_alerts, {r(mean('age'), 1)} AS avg_age_days, max(age) AS oldest_alert_days, {', '.join(f"{_k(f'''overall_anomaly_classification = '{x}_ANOMALY' ''')} AS {x.lower()}_open" for x in ('CRITICAL', 'HIGH', 'MODERATE'))}, {_k(f'age > {_sla}')} AS sla_breach_count, {pct(_k(f'age > {_sla}'), 'count(*)')} AS sla_breach_percentage, {_ages('alerts', 'age')},
    {_k("country IN ('Sweden','Norway','Denmark','Finland')")} AS nordic_backlog, {_k("country IN ('Germany','Austria','Switzerland')")} AS central_europe_backlog, {_k("coalesce(country, '') NOT IN ('Sweden','Norway','Denmark','Finland','Germany','Austria','Switzerland')")} AS other_backlog
  FROM (SELECT s.*, country, date_diff('day', value_date, {AS_OF}) AS age FROM scored s LEFT JOIN in_accounts a ON a.account_id = s.account_id LEFT JOIN one360 c ON c.customer_id = a.customer_id WHERE {_al}) q"""
VIEWS["heat"] = f"""SELECT t.transaction_id, t.amount, s.transaction_id IS NOT NULL AS hit, s.overall_anomaly_classification AS cls, k.country, coalesce(k.kind, 'STANDARD') AS kind FROM in_transactions t LEFT JOIN scored s ON s.transaction_id = t.transaction_id AND {_al} LEFT JOIN in_accounts a ON a.account_id = t.account_id
  LEFT JOIN (SELECT customer_id, country, CASE WHEN bool_or(exposed_person_match_type IN ('EXACT_MATCH','FUZZY_MATCH')) THEN 'PEP' WHEN any_value(risk_classification) IN ('CRITICAL','HIGH') THEN 'HIGH_RISK' ELSE 'STANDARD' END AS kind FROM c360 GROUP BY 1, 2) k ON k.customer_id = a.customer_id"""
_rate = f"{_k('hit')} AS alert_count, count(*) AS total_transactions, {pct(_k('hit'), 'count(*)')} AS alert_rate_pct"
QUERIES["risk_heatmap"] = f"""
  SELECT * FROM (SELECT 'COUNTRY_RISK' AS risk_dimension, country AS category, {_rate}, CAST({_k("cls = 'CRITICAL_ANOMALY'")} AS DOUBLE) AS detail_metric FROM heat WHERE country IS NOT NULL GROUP BY 2 ORDER BY alert_rate_pct DESC, category LIMIT 10)
  UNION ALL SELECT 'AMOUNT_TIER', CASE WHEN amount >= 100000 THEN 'TIER_1_>100K' WHEN amount >= 10000 THEN 'TIER_2_10K-100K' WHEN amount >= 1000 THEN 'TIER_3_1K-10K' ELSE 'TIER_4_<1K' END, {_rate}, {r(mean('amount'))} FROM heat GROUP BY 2
  UNION ALL SELECT 'CUSTOMER_TYPE', kind, {_rate}, NULL FROM heat GROUP BY 2"""
_sd = lambda x: f"count(DISTINCT CASE WHEN {x} THEN customer_id END)"
QUERIES["sanctions_universe"] = f"""
  SELECT a.* EXCLUDE (v), {r('CAST(v AS DOUBLE) / 1000000')} AS total_value_million_usd, b.*, c.*, e.*, 0 AS confirmed_breaches FROM (SELECT count(*) AS total_transactions_30d, count(DISTINCT account_id) AS unique_sender_accounts, count(DISTINCT counterparty_account) AS unique_receiver_accounts, sum(amount) AS v FROM scored WHERE value_date >= {AS_OF} - 30) a
  CROSS JOIN (SELECT count(DISTINCT customer_id) AS total_customers, {_sd("country IN ('RU','BY','KP','IR','SY','CU','VE')")} AS high_risk_country_customers FROM c360) b CROSS JOIN (SELECT count(DISTINCT entity_name) AS total_sanctioned_entities, count(DISTINCT entity_type) AS entity_types_monitored FROM in_watch_list) c
  CROSS JOIN (SELECT count(DISTINCT customer_id) AS total_customers_with_hits, {', '.join(f"{_sd(f'''match_type = '{x.upper()}_MATCH' ''')} AS {x}_match_hits" for x in ('exact', 'fuzzy', 'alias'))}, {_sd("match_confidence = 'HIGH_CONFIDENCE'")} AS high_confidence_hits, {_sd("match_confidence = 'MEDIUM_CONFIDENCE'")} AS medium_confidence_hits, {r(mean('match_score'))} AS avg_match_score FROM screening) e"""
QUERIES["sanctions_hits"] = "SELECT customer_id, customer_name, customer_dob, customer_country, match_type, entity_name, authority, list_name, sanctions_program, match_score, match_confidence, dob_match, nationality_match, disposition_recommendation, alert_priority, combined_risk_score FROM screening ORDER BY match_score DESC, combined_risk_score DESC, customer_id, entity_id, match_type LIMIT 50"
QUERIES["sanctions_quality"] = f"SELECT match_confidence, count(DISTINCT customer_id) AS customers, {r(mean('match_score'))} AS avg_match_score, {_sd('dob_match')} AS dob_matches, {_sd('nationality_match')} AS nationality_matches, {_sd('dob_match AND nationality_match')} AS multi_signal_validation, string_agg(DISTINCT disposition_recommendation, ', ' ORDER BY disposition_recommendation) AS recommended_actions FROM screening GROUP BY 1"
QUERIES["sanctions_alerts"] = "SELECT customer_id, customer_name, customer_country, match_type, entity_name, authority, sanctions_program, alert_priority, match_confidence, combined_risk_score, disposition_recommendation FROM screening WHERE disposition_recommendation IN ('HARD_BLOCK','IMMEDIATE_INVESTIGATION','ENHANCED_DUE_DILIGENCE') AND alert_priority IN ('CRITICAL','HIGH') ORDER BY CASE alert_priority WHEN 'CRITICAL' THEN 1 ELSE 2 END, combined_risk_score DESC, customer_id, entity_id, match_type LIMIT 25"
QUERIES["kyc_audit_profile"] = f"SELECT customer_id, first_name, family_name, date_of_birth, country, onboarding_date, exposed_person_match_type AS pep_status, coalesce(exposed_person_exact_category, exposed_person_fuzzy_category) AS pep_category, sanctions_match_type, risk_classification AS current_risk, has_anomaly, total_accounts, {d('total_balance')} AS total_aum, total_transactions, last_transaction_date FROM c360 WHERE customer_id = '7'"
QUERIES["kyc_audit_risk_versions"] = f"SELECT customer_id, risk_classification, credit_score_band, valid_from, valid_to, date_diff('day', valid_from, coalesce(valid_to, {AS_OF})) AS days_in_status, CASE WHEN valid_to IS NULL THEN 'CURRENT' ELSE 'HISTORICAL' END AS status FROM customer_history WHERE customer_id = '7' ORDER BY valid_from DESC, insert_timestamp_utc DESC LIMIT 10"
QUERIES["kyc_audit_addresses"] = f"SELECT customer_id, street_address, city, state, zipcode, country, valid_from, valid_to, is_current, date_diff('day', valid_from, coalesce(valid_to, {AS_OF})) AS residence_days FROM addresses_history WHERE customer_id = '7' ORDER BY valid_from DESC, insert_timestamp_utc DESC LIMIT 5"
_pepx, _hitx = "exposed_person_match_type IN ('EXACT_MATCH','FUZZY_MATCH')", "sanctions_match_type IN ('EXACT_MATCH','FUZZY_MATCH')"
QUERIES["kyc_overdue"] = f"""
  SELECT count(*) AS total_customers, {_k('o <= 0')} AS kyc_current_count, {_k('o > 0')} AS kyc_overdue_count, {pct(_k('o <= 0'), 'count(*)')} AS kyc_current_percentage, {pct(_k('o > 0'), 'count(*)')} AS kyc_overdue_percentage, {_k('o BETWEEN 1 AND 30')} AS overdue_0_30_days, {_k('o BETWEEN 31 AND 90')} AS overdue_31_90_days, {_k('o BETWEEN 91 AND 180')} AS overdue_91_180_days, {_k('o > 180')} AS overdue_180_plus_days,
    {_k('o > 0 AND sp')} AS high_risk_overdue_count, greatest(max(o), 0) AS max_days_overdue, {r(mean('CASE WHEN o > 0 THEN o END'), 1)} AS avg_days_overdue FROM (SELECT date_diff('day', onboarding_date, {AS_OF}) - CASE WHEN {_pepx} THEN 365 WHEN risk_classification IN ('CRITICAL','HIGH') THEN 730 ELSE 1095 END AS o, {_pepx} OR risk_classification IN ('CRITICAL','HIGH') AS sp FROM once) q"""
QUERIES["screening_alert_aging"] = f"""
  SELECT count(*) AS total_alerts, {_k('age > lim')} AS sla_breach_count, {pct(_k('age > lim'), 'count(*)')} AS sla_breach_percentage, {_k("kind = 'PEP_CRITICAL'")} AS pep_critical_count, {_k("kind = 'PEP_STANDARD'")} AS pep_standard_count, {_k("kind = 'SANCTIONS_HIT'")} AS sanctions_count, {_k("kind IN ('CRITICAL_RISK','HIGH_RISK')")} AS other_high_risk_count, {_ages('aging', 'age')}, max(age) AS oldest_alert_days,
    {r(mean('age'), 1)} AS avg_alert_age_days, {_k('age > 30')} AS alerts_over_30_days, {_k('age > 90')} AS alerts_over_90_days FROM (SELECT date_diff('day', onboarding_date, {AS_OF}) AS age, CASE WHEN {_pepx} AND risk_classification = 'CRITICAL' THEN 'PEP_CRITICAL' WHEN {_pepx} THEN 'PEP_STANDARD' WHEN {_hitx} THEN 'SANCTIONS_HIT' WHEN risk_classification = 'CRITICAL' THEN 'CRITICAL_RISK' WHEN risk_classification = 'HIGH' THEN 'HIGH_RISK' ELSE 'OTHER' END AS kind,
      CASE WHEN {_pepx} AND risk_classification = 'CRITICAL' THEN 5 WHEN {_pepx} THEN 15 WHEN {_hitx} THEN 7 WHEN risk_classification = 'CRITICAL' THEN 7 ELSE 30 END AS lim FROM once WHERE {_pepx} OR {_hitx} OR risk_classification IN ('CRITICAL','HIGH')) q"""
QUERIES["advisor_list"] = f"SELECT employee_id, advisor_name, country, region, tenure_days, {r('tenure_days / 365.25', 1)} AS tenure_years, performance_rating, languages_spoken, total_clients, available_capacity, capacity_utilization_pct, workload_status, {r('total_portfolio_value', 0)} AS total_aum_chf, {r('avg_client_balance', 0)} AS avg_aum_per_client, high_risk_clients, critical_risk_clients, team_leader_name FROM advp WHERE employment_status = 'ACTIVE'"
QUERIES["hiring_need"] = QUERIES["workload_distribution"].join(("SELECT country, region, advisor_count AS total_advisors, total_clients, avg_clients_per_advisor, available_capacity, " + r("capacity_utilization_pct", 1) + " AS avg_utilization_pct, total_capacity, used_capacity, CASE WHEN capacity_utilization_pct > 90 THEN 'URGENT_HIRING_NEEDED' WHEN capacity_utilization_pct > 80 THEN 'HIRING_RECOMMENDED' WHEN capacity_utilization_pct > 70 THEN 'MONITOR_CLOSELY' ELSE 'ADEQUATE_COVERAGE' END AS hiring_status, CAST(CASE WHEN capacity_utilization_pct > 75 THEN ceil((total_clients - advisor_count * 150) / 150) ELSE 0 END AS BIGINT) AS estimated_advisors_needed FROM (", ") w"))
_top = "premium_clients + platinum_clients + gold_clients"
QUERIES["advisor_revenue"] = f"SELECT p.advisor_employee_id, p.advisor_name, p.country, p.region, {r('total_aum', 0)} AS total_aum_chf, p.total_clients AS client_count, {r('avg_aum_per_client', 0)} AS avg_client_aum, {r('estimated_annual_revenue', 0)} AS estimated_annual_revenue_chf, {_top} AS high_value_clients_count, {pct(_top, 'p.total_clients', 1)} AS high_value_client_pct, tenure_days, {r('tenure_days / 365.25', 1)} AS tenure_years, performance_rating, team_leader_name FROM ({QUERIES['portfolio_by_advisor']}) p JOIN advp a ON a.employee_id = p.advisor_employee_id WHERE a.employment_status = 'ACTIVE'"
QUERIES["relationship_list"] = f"SELECT advisor_employee_id, advisor_name, advisor_country, advisor_region, customer_id, customer_name, customer_country, risk_classification AS customer_risk_classification, assignment_start_date, assignment_duration_days AS relationship_duration_days, assignment_duration_years AS relationship_duration_years, {r('total_balance', 0)} AS client_aum_chf, total_accounts AS customer_total_accounts, CASE WHEN advisor_country <> customer_country THEN 'CROSS_BORDER' ELSE 'DOMESTIC' END AS assignment_type, CASE WHEN assignment_duration_days < 180 THEN 'NEW_RELATIONSHIP' WHEN assignment_duration_days < 730 THEN 'ESTABLISHING' WHEN assignment_duration_days < 1825 THEN 'MATURE' ELSE 'LONGSTANDING' END AS relationship_stage FROM ({QUERIES['current_assignments']}) q ORDER BY advisor_name, client_aum_chf DESC NULLS FIRST, customer_id LIMIT 1000"
_band = "CASE WHEN credit_score_band IN ('EXCELLENT','VERY_GOOD') THEN 'L' WHEN credit_score_band = 'GOOD' THEN 'M' WHEN credit_score_band IN ('FAIR','POOR') THEN 'H' ELSE 'N' END"
QUERIES["credit_overview"] = f"""
  SELECT count(*) AS total_customers_with_accounts, {d('sum(total_balance)')} AS total_exposure_usd, {r(mean('total_balance'))} AS avg_exposure_per_customer, {_k(f"{_band} = 'L'")} AS low_risk_customers, {_k(f"{_band} = 'M'")} AS medium_risk_customers, {_k(f"{_band} = 'H'")} AS high_risk_customers, {_k(f"{_band} = 'N'")} AS not_rated_customers, {_k('has_anomaly')} AS customers_with_anomalies,
    {pct(_k('has_anomaly'), 'count(*)')} AS anomaly_rate_pct, CAST(count(DISTINCT country) AS INTEGER) AS countries_with_exposure, CAST(sum(total_accounts) AS BIGINT) AS total_accounts_all_types, {r(mean('total_accounts'))} AS avg_accounts_per_customer FROM once WHERE total_accounts > 0"""
_e = "total_exposure_chf"
_w2 = lambda *xs: f"CAST(sum({_e} * {' * '.join(f'CAST({x} AS DECIMAL(6,2))' for x in xs)}) AS DOUBLE)"
QUERIES["npl_report"] = f"""
  SELECT portfolio_segment, count(*) AS total_customers, {d(f'sum({_e})')} AS total_exposure_chf, {r(mean(_e))} AS avg_exposure_chf, {_k('default_flag')} AS default_count, {pct(_k('default_flag'), 'count(*)')} AS npl_rate_pct, {d(f'sum(CASE WHEN default_flag THEN {_e} ELSE 0 END)')} AS npl_amount_chf, {_k('days_past_due BETWEEN 1 AND 29')} AS dpd_1_29, {_k('days_past_due BETWEEN 30 AND 59')} AS dpd_30_59,
    {_k('days_past_due BETWEEN 60 AND 89')} AS dpd_60_89, {_k('days_past_due >= 90')} AS dpd_90_plus, {_k('watch_list_flag')} AS watchlist_count, {pct(_k('watch_list_flag'), 'count(*)')} AS watchlist_rate_pct, {r(f'{_w2("pd_1_year")} / nullif(CAST(sum({_e}) AS DOUBLE), 0)')} AS weighted_avg_pd_pct, {r(f'{_w2("lgd_rate")} / nullif(CAST(sum({_e}) AS DOUBLE), 0)')} AS weighted_avg_lgd_pct,
    {r(f'{_w2("pd_1_year", "lgd_rate")} / 10000')} AS expected_loss_chf, CASE WHEN sum({_e}) <> 0 THEN CAST(60 AS DOUBLE) END AS collateral_coverage_pct FROM irb GROUP BY 1"""
QUERIES["basel_report"] = f"SELECT *, CASE WHEN tier1_capital_ratio >= 6 AND total_capital_ratio >= 8 THEN 'COMPLIANT' ELSE 'NON_COMPLIANT' END AS regulatory_status FROM ({QUERIES['irb_rwa_summary']}) q"
QUERIES["rating_distribution"] = f"SELECT * EXCLUDE (vintage_months, concentration_risk_score, secured_exposure_chf, unsecured_exposure_chf) REPLACE ({d(_e)} AS total_exposure_chf), {pct(_e, f'sum({_e}) OVER ()')} AS portfolio_concentration_pct FROM irbm"
VIEWS["held"] = "SELECT p.*, full_name AS client_name, country, account_tier, risk_classification FROM perf p JOIN one360 o USING (customer_id) JOIN (SELECT customer_id, full_name FROM customer_current) n USING (customer_id) WHERE total_portfolio_value_chf > 0"
_tv = "total_portfolio_value_chf"
_d18 = lambda x, k=2: f"CAST({x} AS DECIMAL(28,{k}))"
_vw = lambda x: r(f"CAST(sum(CAST({x} AS DECIMAL(18,4)) * CAST({_tv} AS DECIMAL(20,2))) AS DOUBLE) / nullif(CAST(sum({_d18(_tv)}) AS DOUBLE), 0)")
QUERIES["top_performers"] = f"""
  SELECT customer_id, client_name, country, account_tier, count(*) AS accounts, CAST(sum({_d18('equity_total_invested_chf + fi_total_invested_chf + cmd_total_invested_chf')}) AS DOUBLE) AS total_invested, CAST(sum({_d18(_tv)}) AS DOUBLE) AS current_value, {r('sum(total_return_chf)')} AS total_return, {_vw('total_portfolio_twr_percentage')} AS portfolio_twr_pct, {_vw('annualized_portfolio_twr')} AS annualized_twr_pct,
    {r('avg(equity_return_percentage)')} AS avg_equity_return_pct, {r('avg(fi_return_percentage)')} AS avg_fi_return_pct, {r('avg(cmd_return_percentage)')} AS avg_commodity_return_pct FROM held GROUP BY 1, 2, 3, 4 ORDER BY portfolio_twr_pct DESC, customer_id LIMIT 50"""
QUERIES["risk_adjusted"] = f"""
  SELECT customer_id, client_name, account_tier, risk_classification, CAST(sum({_d18(_tv)}) AS DOUBLE) AS total_aum, {r('avg(total_portfolio_twr_percentage)')} AS avg_twr_pct, {r('avg(annualized_portfolio_twr)')} AS avg_annualized_twr_pct, {r('avg(portfolio_volatility)')} AS avg_volatility_pct, {r('avg(sharpe_ratio)')} AS avg_sharpe_ratio, {r('avg(risk_free_rate_annual_pct)')} AS risk_free_rate_pct,
    CASE WHEN avg(sharpe_ratio) >= 2 THEN 'EXCELLENT' WHEN avg(sharpe_ratio) >= 1.5 THEN 'VERY_GOOD' WHEN avg(sharpe_ratio) >= 1 THEN 'GOOD' WHEN avg(sharpe_ratio) >= 0.5 THEN 'FAIR' WHEN avg(sharpe_ratio) > 0 THEN 'POOR' ELSE 'NEGATIVE' END AS performance_rating, count(*) AS accounts FROM held GROUP BY 1, 2, 3, 4 ORDER BY avg_sharpe_ratio DESC NULLS LAST, customer_id LIMIT 50"""
_cv = {"cash": "cash", "equity": "equity", "fi": "fi", "cmd": "commodity"}
_sv = lambda k: f"sum({_d18(f'current_{k}_value_chf')})"
_gr = f"CAST(greatest({', '.join(_sv(k) for k in _cv)}) AS DOUBLE) * 100 / nullif(CAST(sum({_d18(_tv)}) AS DOUBLE), 0)"
QUERIES["asset_allocation"] = f"""
  SELECT customer_id, client_name, account_tier, risk_classification, CAST(sum({_d18(_tv)}) AS DOUBLE) AS total_portfolio_value, {', '.join(f'CAST({_sv(k)} AS DOUBLE) AS {n}_value, {pct(_sv(k), f"sum({_d18(_tv)})")} AS {n}_allocation_pct' for k, n in _cv.items())},
    CASE WHEN {_gr} > 80 THEN 'HIGH_CONCENTRATION' WHEN {_gr} > 60 THEN 'MEDIUM_CONCENTRATION' ELSE 'WELL_DIVERSIFIED' END AS concentration_risk FROM held GROUP BY 1, 2, 3, 4 ORDER BY total_portfolio_value DESC, customer_id LIMIT 100"""
_fk = {"equity": "equity", "fi": "fi", "cmd": "commodity"}
_fe = lambda k: f"sum(CAST({k}_commission_chf AS DECIMAL(18,2)))"
_fees = "(" + " + ".join(_fe(k) for k in _fk) + ")"
_gain = f"sum({_d18('total_return_chf')})"
QUERIES["fee_report"] = f"""
  SELECT customer_id, client_name, account_tier, CAST(sum({_d18(_tv)}) AS DOUBLE) AS total_aum, CAST({_gain} AS DOUBLE) AS total_return, {r('avg(total_portfolio_twr_percentage)')} AS avg_twr_pct, {', '.join(f'CAST({_fe(k)} AS DOUBLE) AS {n}_commissions, CAST(sum({k}_trades_count) AS BIGINT) AS {n}_trades' for k, n in _fk.items())}, CAST({_fees} AS DOUBLE) AS total_commissions,
    {r(f'CAST({_fees} * 100 AS DOUBLE) / nullif(CAST(sum({_d18(_tv)}) AS DOUBLE), 0)', 4)} AS commission_to_aum_pct, {r(f'CAST({_fees} * 100 AS DOUBLE) / nullif(CAST(nullif(abs({_gain}), 0.01) AS DOUBLE), 0)')} AS commission_to_return_pct, CAST({_gain} - {_fees} AS DOUBLE) AS net_return_after_fees FROM held GROUP BY 1, 2, 3 HAVING {_fees} > 0 ORDER BY total_commissions DESC, customer_id LIMIT 100"""
_sg = "CASE WHEN total_balance >= 10000000 THEN 'uhnw' WHEN total_balance >= 1000000 THEN 'hnw' WHEN total_balance >= 250000 THEN 'affluent' WHEN total_balance >= 50000 THEN 'mass_affluent' ELSE 'retail' END"
QUERIES["wealth_segments"] = f"""
  SELECT count(*) AS total_clients, {d('sum(total_balance)')} AS total_aum_usd, {r(mean('total_balance'))} AS avg_aum_per_client, {r('quantile_cont(CAST(total_balance AS DOUBLE), 0.5)')} AS median_aum_per_client, {d('max(total_balance)')} AS largest_portfolio, CAST(sum(total_accounts) AS BIGINT) AS total_accounts, {r(mean('total_accounts'))} AS avg_accounts_per_client,
    {', '.join(f"{_k(f'''{_sg} = '{x}' ''')} AS {x}_clients" for x in ('uhnw', 'hnw', 'affluent', 'mass_affluent', 'retail'))}, CAST(sum(total_transactions) AS BIGINT) AS total_transactions, {_k(f'last_transaction_date >= {AS_OF} - 30')} AS active_last_30_days FROM once WHERE total_accounts > 0"""
QUERIES["risk_distribution"] = f"SELECT overall_risk_rating, count(*) AS customer_count, {r('avg(overall_risk_score)')} AS avg_risk_score FROM once GROUP BY 1"
for _x, _n in (("exposed_person", "pep_match_summary"), ("sanctions", "sanctions_match_summary")):
    QUERIES[_n] = f"SELECT {_x}_match_type, count(*) AS customer_count, {r(f'avg({_x}_match_accuracy_percent)')} AS avg_accuracy, {_k(f'requires_{_x}_review')} AS requires_review FROM once GROUP BY 1"
QUERIES["tier_distribution"] = f"SELECT account_tier, count(*) AS customer_count, {r(mean('total_accounts'))} AS avg_total_accounts, {', '.join(f'{r(mean(x + '_accounts'))} AS avg_{x}' for x in ('checking', 'savings', 'business', 'investment'))} FROM once GROUP BY 1"
QUERIES["country_distribution"] = f"SELECT country, count(*) AS customer_count, CAST(count(DISTINCT account_tier) AS INTEGER) AS tier_diversity, {r('avg(overall_risk_score)')} AS avg_risk_score FROM once GROUP BY 1"
QUERIES["lifecycle_summary"] = f"SELECT lifecycle_stage, count(*) AS customer_count, {r('avg(churn_probability)')} AS avg_churn_probability, {r(mean('days_since_last_transaction'))} AS avg_days_inactive FROM once GROUP BY 1"
QUERIES["high_risk_customers"] = "SELECT customer_id, full_name, country, account_tier, overall_risk_rating, overall_risk_score, exposed_person_match_type, exposed_person_match_accuracy_percent, sanctions_match_type, sanctions_match_accuracy_percent, requires_exposed_person_review, requires_sanctions_review, high_risk_customer FROM once WHERE high_risk_customer OR requires_exposed_person_review OR requires_sanctions_review"
QUERIES["newest_alerts"] = f"SELECT * REPLACE ({d('amount')} AS amount, {r('median_transaction_amount', 4)} AS median_transaction_amount) FROM scored WHERE {_al} ORDER BY booking_date DESC, transaction_id LIMIT 1000"
for _x, _n in (("exposed_person", "pep_matches"), ("sanctions", "sanctions_matches")):
    QUERIES[_n] = f"SELECT customer_id, full_name, country, {_x}_match_type, {_x}_match_accuracy_percent, requires_{_x}_review, overall_{_x}_risk FROM c360 WHERE {_x}_match_type <> 'NO_MATCH'"
QUERIES["lending_portfolio"] = "SELECT customer_id, full_name, country, credit_score_band, risk_classification, account_tier, total_accounts FROM once"
_churn = "customer_id, first_name, family_name, account_tier, country, lifecycle_stage, churn_probability, days_since_last_transaction, last_transaction_date, email, phone"
QUERIES["high_churn_customers"] = f"SELECT {_churn} FROM once WHERE churn_probability > 20"
QUERIES["premium_at_risk"] = f"SELECT {_churn}, preferred_contact_method FROM once WHERE account_tier IN ('GOLD','PLATINUM') AND churn_probability > 20"
QUERIES["dormant_customers"] = f"SELECT {_churn}, total_accounts FROM once WHERE days_since_last_transaction > 10 AND lifecycle_stage IN ('DORMANT','DECLINING')"
QUERIES["revenue_at_risk"] = f"SELECT count(*) AS at_risk_customers, {_k('churn_probability > 90')} AS critical_customers, {_k('churn_probability BETWEEN 70 AND 90')} AS high_customers, {r('avg(churn_probability)')} AS avg_churn_probability FROM once WHERE churn_probability > 70"
_normal = "overall_anomaly_classification <> 'NORMAL_BEHAVIOR'"
QUERIES["aml_metrics"] = f"SELECT {_k(_al)} AS total_alerts, count(DISTINCT CASE WHEN {_al} THEN customer_id END) AS unique_customers, {_k(_normal)} AS anomalous_transactions FROM scored WHERE booking_date >= {AS_OF} - INTERVAL 90 DAY"
QUERIES["kyc_completeness"] = f"SELECT country, count(*) AS total_customers, count(email) AS email_complete, count(phone) AS phone_complete, count(employer) AS employer_complete, {pct('count(email)', 'count(*)')} AS email_pct, {pct('count(phone)', 'count(*)')} AS phone_pct FROM once GROUP BY 1"
QUERIES["contact_quality"] = f"SELECT count(*) AS total_records, count(DISTINCT customer_id) AS unique_customers, {', '.join(f'count(*) - count({c}) AS missing_{x}, {pct(f'count({c})', 'count(*)')} AS {x}_completeness' for x, c in (('email', 'email'), ('phone', 'phone'), ('dob', 'date_of_birth'), ('address', 'street_address')))} FROM once"
QUERIES["compliance_summary"] = f"SELECT count(*) AS total_customers, {_k('high_risk_customer')} AS high_risk_count, {_k("exposed_person_match_type <> 'NO_MATCH'")} AS pep_matches, {_k("sanctions_match_type <> 'NO_MATCH'")} AS sanctions_matches, {_k('requires_exposed_person_review')} AS pep_reviews_needed, {_k('requires_sanctions_review')} AS sanctions_reviews_needed, {_k('has_anomaly')} AS anomaly_count, {r('avg(overall_risk_score)')} AS avg_risk_score FROM once"
QUERIES["lcr_trend_page"] = "SELECT * EXCLUDE (consecutive_breaches_3d, high_volatility_alert, sustained_breach_alert, critical_breach_alert) FROM lcrt WHERE as_of_date >= DATE '2001-11-04' - 90"
QUERIES["hqla_page"] = f"SELECT asset_type, regulatory_level, {d('max(haircut_factor)')} AS haircut_factor, count(*) AS holding_count, {d('sum(market_value_chf)')} AS market_value_chf, {r('sum(weighted_value_chf)')} AS weighted_value_chf, {r(mean('market_value_chf'))} AS avg_holding_size_chf FROM hold WHERE as_of_date = (SELECT max(as_of_date) FROM hold) GROUP BY 1, 2"
QUERIES["deposit_page"] = f"SELECT deposit_type, counterparty_type, {d('max(base_run_off_rate)')} AS base_run_off_rate, count(*) AS account_count, count(DISTINCT customer_id) AS customer_count, {d('sum(balance_chf)')} AS total_balance_chf, {r('sum(outflow_amount_chf)')} AS total_outflow_chf, {r(mean('balance_chf'))} AS avg_balance_chf, {r(f"{mean('final_run_off_rate')} * 100")} AS avg_adjusted_run_off_rate FROM dep WHERE as_of_date = (SELECT max(as_of_date) FROM dep) GROUP BY 1, 2"
QUERIES["lcr_alert_page"] = "SELECT as_of_date, lcr_ratio, lcr_status, severity, a.severity AS alert_severity, a.type AS alert_type, a.message AS alert_message, a.action AS recommended_action FROM (SELECT *, unnest(all_alerts) AS a FROM alrt) q"
QUERIES["lcr_monthly_page"] = "SELECT reporting_month AS report_month, trading_days, lcr_avg AS avg_lcr_ratio, lcr_min AS min_lcr_ratio, lcr_max AS max_lcr_ratio, lcr_volatility, avg_hqla_total, avg_outflow_total, breach_days AS days_below_100_pct, warning_days AS days_below_105_pct, compliant_days, breach_rate_pct, CASE WHEN breach_days = 0 THEN 'PASS' WHEN breach_days <= 3 THEN 'WARNING' ELSE 'FAIL' END AS compliance_status FROM lcrm ORDER BY 1 DESC LIMIT 12"
QUERIES["loan_compliance_page"] = "SELECT DISTINCT application_id, customer_id, full_name, country, requested_amount, application_status, requires_sanctions_review, requires_exposed_person_review, overall_risk_rating, vulnerable_customer_flag, compliance_hold_flag, compliance_status, application_date_time FROM o14 WHERE compliance_hold_flag OR vulnerable_customer_flag OR overall_risk_rating IN ('CRITICAL','HIGH') ORDER BY CASE compliance_status WHEN 'SANCTIONS_REVIEW' THEN 1 WHEN 'PEP_REVIEW' THEN 2 WHEN 'HIGH_RISK_REVIEW' THEN 3 ELSE 4 END, application_date_time DESC, application_id, overall_risk_rating, requires_exposed_person_review LIMIT 100"
QUERIES["loan_customer_page"] = "SELECT s.*, full_name AS customer_name, vulnerable_customer_flag, requires_sanctions_review, requires_exposed_person_review FROM o11 s LEFT JOIN once c USING (customer_id) WHERE total_applications > 0 ORDER BY total_approved_amount DESC, customer_id LIMIT 100"

QUERIES["analysis_period"] = "SELECT min(value_date) AS earliest_date, max(value_date) AS latest_date, max(value_date) - 90 AS analysis_start, max(value_date) AS analysis_end FROM in_transactions"
QUERIES["filings_by_country"] = f"SELECT c.country, count(DISTINCT s.customer_id) AS customer_count FROM scored s JOIN c360 c ON s.customer_id = c.customer_id WHERE {_ser} AND requires_immediate_review AND c.country IS NOT NULL GROUP BY 1"
QUERIES["advisor_capacity"] = "SELECT employee_id, advisor_name, total_clients, workload_status, available_capacity, total_portfolio_value, region, country, capacity_utilization_pct, total_transactions, high_risk_clients, performance_rating, employment_status FROM advp"
QUERIES["wealth_portfolios"] = "SELECT employee_id AS advisor_id, advisor_name, total_portfolio_value AS total_aum, total_clients AS client_count, avg_client_balance AS avg_aum_per_client, performance_rating, region FROM advp"
QUERIES["team_report"] = f"SELECT team_leader_id, team_leader_name, region, total_advisors, active_advisors, {r('total_team_aum', 0)} AS team_aum_chf, {r('total_team_aum / nullif(CAST(total_advisors AS DOUBLE), 0)', 0)} AS avg_aum_per_advisor, total_clients, avg_clients_per_advisor, team_available_capacity, {r('team_capacity_utilization_pct', 1)} AS team_utilization_pct, high_risk_clients, avg_advisor_performance, min_advisor_performance, max_advisor_performance FROM teams"
QUERIES["lcr_status_page"] = "SELECT as_of_date AS reporting_date, lcr_ratio, lcr_status, severity, hqla_total, outflow_total, lcr_buffer_chf, lcr_buffer_pct, l1_total, l2_capped, l2a_total, l2b_total, cap_applied, discarded_l2, outflow_retail, outflow_corp, outflow_fi FROM lcrd WHERE as_of_date = (SELECT max(as_of_date) FROM lcrd)"
for _n, _v in (("loan_portfolio_page", "o7"), ("loan_ltv_page", "o8"), ("loan_funnel_page", "o9"), ("loan_affordability_page", "o10")):
    QUERIES[_n] = f"SELECT * EXCLUDE (as_of_date) FROM {_v}"

# ---- files ----------------------------------------------------------------------------------------
QUERIES["xml_load"] = """
  SELECT regexp_extract(raw_xml, '<MsgId>([^<]*)', 1) AS message_id,
    CASE WHEN NOT bad THEN CAST(1 + n % 3 AS INTEGER) END AS entries, CASE WHEN bad THEN 'not well formed' END AS reason
  FROM (SELECT raw_xml, n, n % 7 = 3 AS bad FROM (SELECT raw_xml, CAST(regexp_extract(file_name, '_([0-9]+)', 1) AS BIGINT) AS n FROM in_messages) m) q"""
QUERIES["list_files"] = "SELECT DISTINCT 'account_type=' || account_type AS folder, 'account_id,customer_id,status' AS header FROM in_accounts"
QUERIES["stream_account_totals"] = f"""
  SELECT account_id, {d('sum(base_amount)')} AS balance, count(*) AS payments, count(CASE WHEN base_amount > 0 THEN 1 END) AS credits, count(CASE WHEN base_amount < 0 THEN 1 END) AS debits,
    min(booking_date) AS first_booking, max(booking_date) AS last_booking, {d('max(base_amount)')} AS largest FROM in_transactions GROUP BY 1"""
QUERIES["stream_daily_totals"] = f"""
  SELECT CAST(booking_date AS DATE) AS booking_day, currency, {d('sum(amount)')} AS amount, count(*) AS payments, {d('max(amount)')} AS largest FROM in_transactions GROUP BY 1, 2"""
