"""Logical bank inputs expressed over the given TPC-H-like tables.

Every entry is one SELECT that both Spark SQL and ANSI engines accept; the few
functions whose spelling differs go through a dialect object.  The operators
never see these adapters: they take DataFrames in the declared bank layout.
"""

from __future__ import annotations

import re

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

AS_OF = "2001-08-02"
# events end on 2024-01-30; moving them by this many days lines them up with the orders
EVENT_SHIFT = 8217


class SparkDialect:
    @staticmethod
    def add_days(d, n):
        return f"date_add({d}, CAST({n} AS INT))"

    @staticmethod
    def add_hours(ts, n):
        return f"({ts} + make_dt_interval(0, CAST({n} AS INT)))"

    @staticmethod
    def sub_days(ts, n):
        return f"({ts} - make_dt_interval(CAST({n} AS INT)))"

    @staticmethod
    def month_text(d):
        return f"date_format({d}, 'yyyy-MM')"


class AnsiDialect:
    @staticmethod
    def add_days(d, n):
        return f"({d} + CAST({n} AS INTEGER))"

    @staticmethod
    def add_hours(ts, n):
        return f"({ts} + to_hours(CAST({n} AS INTEGER)))"

    @staticmethod
    def sub_days(ts, n):
        return f"({ts} - to_days(CAST({n} AS INTEGER)))"

    @staticmethod
    def month_text(d):
        return f"strftime({d}, '%Y-%m')"


def pick(n: str, *values) -> str:
    """CASE that selects the n-th literal (0-based)."""
    body = " ".join(
        f"WHEN {i} THEN " + (f"'{v}'" if isinstance(v, str) else str(v)) for i, v in enumerate(values)
    )
    return f"CASE CAST({n} AS INT) {body} END"


def match(expr: str, default, **mapping) -> str:
    body = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {expr} {body} ELSE '{default}' END"


def letters(n: str) -> str:
    """Ten letters from a number: a stable pseudo-name without a lookup."""
    spread = f"(({n}) + 17) * 1103515245 % 2147483647"
    return f"translate(lpad(CAST({spread} AS STRING), 10, '0'), '0123456789', 'aeioubcdrn')"


def tables(d) -> dict[str, str]:
    users = "(SELECT max(user_id) + 1 FROM {events})"
    suppliers = "(SELECT count(*) FROM {supplier})"
    shift = lambda: d.sub_days("ts", f"{EVENT_SHIFT} + event_id % 400")
    # cut instead of rounded: half-way cases of a binary product differ between engines
    fixed = lambda e, p, k: f"CAST(FLOOR(({e}) * {10**k}) / {10**k} AS DECIMAL({p},{k}))"
    money = lambda e: fixed(e, 18, 2)
    first = lambda n: f"substr({letters(n)}, 1, 5)"
    family = lambda n: f"substr({letters(n)}, 6, 5)"
    ccy = lambda n: pick(f"{n} % 5", "CHF", "EUR", "USD", "GBP", "SEK")
    t: dict[str, str] = {}

    t["in_customers"] = f"""
      SELECT CAST(user_id AS STRING) AS customer_id, {first('user_id')} AS first_name,
        {family('user_id')} AS family_name,
        {d.add_days("DATE '1918-01-01'", 'user_id * 137 % 24000')} AS date_of_birth,
        {d.add_days("DATE '1996-01-01'", 'user_id * 53 % 2030')} AS onboarding_date,
        {ccy('user_id')} AS reporting_currency, user_id % 7 = 0 AS has_anomaly,
        'Employer ' || CAST(event_id % 50 AS STRING) AS employer, event_type AS position,
        {pick('event_id % 3', 'FULL_TIME', 'PART_TIME', 'SELF_EMPLOYED')} AS employment_type,
        {pick('user_id % 4', '0-25K', '25K-50K', '50K-100K', '100K+')} AS income_range,
        {pick('user_id % 6', 'BASIC', 'STANDARD', 'SILVER', 'GOLD', 'PREMIUM', 'PLATINUM')} AS account_tier,
        CASE WHEN user_id % 11 <> 0 THEN 'c' || CAST(user_id AS STRING) || '@example.org' END AS email,
        CASE WHEN user_id % 13 <> 0 THEN '+41' || CAST(user_id AS STRING) END AS phone,
        {pick('event_id % 3', 'EMAIL', 'PHONE', 'POST')} AS preferred_contact_method,
        {pick('event_id % 4', 'LOW', 'MEDIUM', 'HIGH', 'CRITICAL')} AS risk_classification,
        {pick('user_id % 5', 'POOR', 'FAIR', 'GOOD', 'VERY_GOOD', 'EXCELLENT')} AS credit_score_band,
        {shift()} AS insert_timestamp_utc, event_id AS version_id
      FROM {{events}}"""
    t["in_addresses"] = f"""
      SELECT CAST(user_id AS STRING) AS customer_id, 'Street ' || CAST(event_id AS STRING) AS street_address,
        {pick('event_id % 4', 'Zurich', 'Berlin', 'London', 'Oslo')} AS city,
        CASE WHEN event_id % 3 = 0 THEN 'State ' || event_type END AS state,
        lpad(CAST(event_id % 9999 AS STRING), 4, '0') AS zipcode,
        {pick('event_id % 4', 'Switzerland', 'Germany', 'United Kingdom', 'Norway')} AS country,
        {shift()} AS insert_timestamp_utc, event_id AS version_id
      FROM {{events}}"""
    t["in_customer_events"] = f"""
      SELECT CAST(event_id AS STRING) AS event_id, CAST(user_id AS STRING) AS customer_id,
        CASE WHEN event_type = 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'ONBOARDING' ELSE 'REACTIVATION' END
             WHEN event_type = 'view' THEN CASE WHEN event_id % 2 = 0 THEN 'ADDRESS_CHANGE' ELSE 'EMPLOYMENT_CHANGE' END
             WHEN event_type = 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'ACCOUNT_UPGRADE' ELSE 'ACCOUNT_DOWNGRADE' END
             WHEN event_type = 'purchase' THEN 'ADDRESS_CHANGE'
             WHEN event_id % 199 = 0 THEN 'CHURN' WHEN event_id % 197 = 0 THEN 'ACCOUNT_CLOSE'
             ELSE 'EMPLOYMENT_CHANGE' END AS event_type,
        CAST({shift()} AS DATE) AS event_date, {shift()} AS event_timestamp_utc, props AS event_details
      FROM {{events}}"""
    t["in_customer_status"] = f"""
      SELECT CAST(event_id AS STRING) AS status_id, CAST(user_id AS STRING) AS customer_id,
        {pick('event_id % 5', 'ACTIVE', 'DORMANT', 'SUSPENDED', 'REACTIVATED', 'CLOSED')} AS status,
        CAST({shift()} AS DATE) AS status_start_date, value > 50 AS is_current
      FROM {{events}}"""
    t["in_accounts"] = f"""
      SELECT CAST(c_custkey AS STRING) AS account_id,
        {match('c_mktsegment', 'OTHER', HOUSEHOLD='CHECKING', MACHINERY='SAVINGS', BUILDING='BUSINESS', AUTOMOBILE='INVESTMENT')} AS account_type,
        {ccy('c_nationkey')} AS base_currency, CAST(c_custkey % {users} AS STRING) AS customer_id,
        CASE WHEN c_acctbal >= 0 THEN 'ACTIVE' ELSE 'CLOSED' END AS status
      FROM {{customer}}"""
    amount = money("(CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END) / 10")
    t["in_transactions"] = f"""
      SELECT {d.add_hours('o_orderdate', 'o_orderkey % 24')} AS booking_date,
        {d.add_days('CAST(o_orderdate AS DATE)', 'o_orderkey % 9 - 1')} AS value_date,
        CAST(o_orderkey AS STRING) AS transaction_id, CAST(o_custkey AS STRING) AS account_id,
        {amount} AS amount, {ccy('o_orderkey')} AS currency, {amount} AS base_amount, 'CHF' AS base_currency,
        CAST(1 AS DECIMAL(15,6)) AS fx_rate,
        CASE WHEN o_orderkey % 50 = 1 THEN 'OFF_SHORE_' WHEN o_orderkey % 50 = 2 THEN 'CRYPTO_' ELSE 'IBAN_' END
          || CAST(o_orderkey % 211 AS STRING) AS counterparty_account,
        CASE WHEN o_orderkey % 17 = 0 THEN '[' || {pick('o_orderkey % 3', 'SMURFING', 'LAYERING', 'ROUND_TRIP')} || '] ' ELSE '' END
          || o_orderpriority AS description
      FROM {{orders}}"""
    t["in_fx_rates"] = f"""
      SELECT date, from_currency, to_currency, {fixed('mid', 15, 6)} AS mid_rate,
        {fixed('mid - half', 15, 6)} AS bid_rate, {fixed('mid + half', 15, 6)} AS ask_rate
      FROM (SELECT CAST(l_shipdate AS DATE) AS date,
          CASE l_returnflag WHEN 'A' THEN 'CHF' WHEN 'N' THEN 'EUR' ELSE 'USD' END AS from_currency,
          CASE l_linestatus WHEN 'O' THEN 'GBP' ELSE 'SEK' END AS to_currency,
          CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
            / CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / 1000 AS mid,
          CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 8 AS half
        FROM {{lineitem}} GROUP BY 1, 2, 3) q"""

    trade_keys = f"""l_orderkey * 10 + l_linenumber AS trade_no, CAST(l_orderkey * 10 + l_linenumber AS STRING) AS trade_id,
        {d.add_hours('l_shipdate', 'l_orderkey % 24')} AS trade_date,
        {d.add_days('CAST(l_shipdate AS DATE)', 'l_linenumber')} AS settlement_date,
        CAST(o_custkey % {users} AS STRING) AS customer_id, CAST(o_custkey AS STRING) AS account_id,
        CASE WHEN l_returnflag = 'R' THEN '2' ELSE '1' END AS side"""
    fx = "((CASE WHEN l_suppkey % 5 = 0 THEN 100 ELSE 50 + l_suppkey % 100 END) / 100)"
    t["in_equity_trades"] = f"""
      SELECT {trade_keys}, CAST(l_orderkey AS STRING) AS order_id, CAST(l_linenumber AS STRING) AS exec_id,
        'S' || CAST(l_partkey % 50 AS STRING) AS symbol,
        'CH' || lpad(CAST(l_partkey % 50 AS STRING), 10, '0') AS isin,
        CAST(l_quantity AS DECIMAL(15,4)) AS quantity, {fixed('l_extendedprice / l_quantity', 18, 6)} AS price,
        {ccy('l_suppkey')} AS currency, {money('l_extendedprice * 3')} AS gross_amount,
        {fixed('l_extendedprice * l_tax / 100', 12, 4)} AS commission,
        {money('l_extendedprice * 3 * (1 - l_discount / 100)')} AS net_amount, 'CHF' AS base_currency,
        {money(f'l_extendedprice * 3 * {fx}')} AS base_gross_amount,
        {money(f'l_extendedprice * 3 * (1 - l_discount / 100) * {fx}')} AS base_net_amount,
        CAST({fx} AS DECIMAL(12,6)) AS fx_rate, {pick('l_linenumber % 3', 'SIX', 'XETRA', 'LSE')} AS market,
        {pick('l_suppkey % 3', 'MARKET', 'LIMIT', 'STOP')} AS order_type, 'TRADE' AS exec_type, 'DAY' AS time_in_force,
        'B' || CAST(l_suppkey % 7 AS STRING) AS broker_id, 'V' || CAST(l_suppkey % 3 AS STRING) AS venue
      FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey"""
    t["in_fi_trades"] = f"""
      SELECT {trade_keys}, {pick('l_linenumber % 4', 'BOND', 'IRS', 'BOND', 'BOND')} AS instrument_type,
        'I' || CAST(l_partkey AS STRING) AS instrument_id, p_brand AS issuer,
        CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'SOVEREIGN' WHEN p_type = 'SMALL' THEN 'SUPRANATIONAL' ELSE 'CORPORATE' END AS issuer_type,
        {ccy('l_suppkey')} AS currency, {money('l_extendedprice * 40')} AS notional,
        {fixed('90 + l_discount * 100', 18, 6)} AS price, {money('l_extendedprice * 40')} AS gross_amount,
        {fixed('l_extendedprice * l_tax / 100', 12, 4)} AS commission,
        {money('l_extendedprice * 40 * (1 - l_discount / 100)')} AS net_amount, 'CHF' AS base_currency,
        {money(f'l_extendedprice * 40 * {fx}')} AS base_gross_amount,
        {money(f'l_extendedprice * 40 * (1 - l_discount / 100) * {fx}')} AS base_net_amount,
        CAST({fx} AS DECIMAL(12,6)) AS fx_rate, {fixed('l_discount * 50', 8, 4)} AS coupon_rate,
        {d.add_days('CAST(l_shipdate AS DATE)', 'p_size * 200')} AS maturity_date, CAST(p_size / 5 AS DECIMAL(8,4)) AS duration,
        {money('l_extendedprice * p_size / 500')} AS dv01,
        {pick('p_size % 7', 'AAA', 'AA', 'A', 'BBB', 'BB', 'B', 'CCC')} AS credit_rating,
        CAST(20 + p_size % 7 * 40 + l_quantity AS DECIMAL(8,2)) AS credit_spread_bps,
        CAST(p_size % 10 AS DECIMAL(4,1)) AS liquidity_score
      FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON l_partkey = p_partkey"""
    t["in_cmd_trades"] = f"""
      SELECT {trade_keys},
        {match('p_type', 'AGRICULTURAL', ECONOMY='ENERGY', PROMO='PRECIOUS_METAL', LARGE='BASE_METAL', SMALL='FREIGHT')} AS commodity_type,
        p_name AS commodity_name, p_brand AS commodity_code,
        {pick('l_linenumber % 3', 'FUTURE', 'FORWARD', 'SPOT')} AS contract_type,
        CAST(l_quantity AS DECIMAL(18,4)) AS quantity, {pick('l_partkey % 2', 'BARREL', 'TONNE')} AS unit,
        {fixed('l_extendedprice / l_quantity', 18, 4)} AS price, {ccy('l_suppkey')} AS currency,
        {money('l_extendedprice')} AS gross_amount, {fixed('l_extendedprice * l_tax / 100', 12, 4)} AS commission,
        {money('l_extendedprice * (1 - l_discount / 100)')} AS net_amount, 'CHF' AS base_currency,
        {money(f'l_extendedprice * 12 * {fx}')} AS base_gross_amount,
        {money(f'l_extendedprice * 12 * (1 - l_discount / 100) * {fx}')} AS base_net_amount,
        CAST({fx} AS DECIMAL(12,6)) AS fx_rate,
        CASE WHEN l_linenumber % 3 <> 0 THEN {d.month_text(d.add_days('CAST(l_shipdate AS DATE)', '90'))} END AS delivery_month,
        {pick('l_suppkey % 3', 'Rotterdam', 'Houston', 'Singapore')} AS delivery_location,
        {fixed('l_extendedprice * (l_discount - 0.04)', 18, 2)} AS delta,
        CAST(p_retailprice AS DECIMAL(18,4)) AS spot_price, {fixed('p_retailprice * 1.01', 18, 4)} AS forward_price,
        {fixed('l_discount * 600', 8, 2)} AS volatility, CAST(p_size % 10 AS DECIMAL(4,1)) AS liquidity_score,
        {pick('l_suppkey % 2', 'ICE', 'CME')} AS exchange
      FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON l_partkey = p_partkey"""
    t["in_hqla_holdings"] = f"""
      SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS holding_id, CAST(l_shipdate AS DATE) AS as_of_date,
        CASE l_returnflag WHEN 'A' THEN {pick('l_linenumber % 4', 'CASH_SNB', 'CASH_VAULT', 'GOVT_BOND_CHF', 'GOVT_BOND_FOREIGN')}
          WHEN 'N' THEN {pick('l_linenumber % 2', 'CANTON_BOND', 'COVERED_BOND')}
          ELSE {pick('l_linenumber % 2', 'EQUITY_SMI', 'CORPORATE_BOND_AA')} END AS asset_type,
        'CH' || lpad(CAST(l_partkey AS STRING), 10, '0') AS isin, {ccy('l_suppkey')} AS currency,
        CAST(l_quantity AS DECIMAL(18,6)) AS quantity, {money('l_extendedprice')} AS market_value_ccy,
        {money('l_extendedprice * ((50 + l_suppkey % 100) / 100)')} AS market_value_chf, l_tax < 0.075 AS hqla_eligible,
        'PF' || CAST(l_suppkey % 4 AS STRING) AS portfolio_code
      FROM {{lineitem}}"""
    t["in_deposits"] = f"""
      SELECT CAST(o_orderkey AS STRING) AS account_id, CAST(o_orderdate AS DATE) AS as_of_date,
        CAST(o_custkey AS STRING) AS customer_id,
        {pick('o_orderkey % 7', 'RETAIL_STABLE_INSURED', 'RETAIL_STABLE', 'RETAIL_LESS_STABLE', 'CORPORATE_OPERATIONAL', 'CORPORATE_NON_OPERATIONAL', 'FINANCIAL_INSTITUTION', 'UNSECURED_WHOLESALE')} AS deposit_type,
        {ccy('o_custkey')} AS currency, {money('o_totalprice')} AS balance_ccy, {money('o_totalprice * 1.25')} AS balance_chf,
        o_orderkey % 7 < 2 AS is_insured, CAST(o_orderkey % 6 AS INT) AS product_count,
        CAST(o_orderkey * 37 % 2000 AS INT) AS account_tenure_days, o_orderkey % 2 = 0 AS has_direct_debit,
        o_orderkey % 7 = 3 AS is_operational,
        {pick('o_orderkey % 7', 'RETAIL', 'RETAIL', 'RETAIL', 'CORPORATE', 'CORPORATE', 'FINANCIAL_INSTITUTION', 'CORPORATE')} AS counterparty_type,
        o_orderpriority AS customer_segment, CASE WHEN o_orderkey % 10 = 0 THEN 'CLOSED' ELSE 'ACTIVE' END AS account_status
      FROM {{orders}}"""
    t["in_employees"] = f"""
      SELECT CAST(s_suppkey AS STRING) AS employee_id, {first('s_suppkey + 500')} AS first_name,
        {family('s_suppkey + 500')} AS family_name, {d.add_days("DATE '1980-01-01'", 's_suppkey * 61 % 7000')} AS hire_date,
        CASE WHEN s_suppkey % 9 = 5 THEN 'ON_LEAVE' ELSE 'ACTIVE' END AS employment_status, n_name AS country, r_name AS region,
        CASE WHEN s_suppkey = 0 THEN 'SUPER_TEAM_LEADER' WHEN s_suppkey * 3 + 1 < {suppliers} THEN 'TEAM_LEADER'
          ELSE 'CLIENT_ADVISOR' END AS position_level,
        CASE WHEN s_suppkey > 0 THEN CAST(CAST(FLOOR((s_suppkey - 1) / 3) AS BIGINT) AS STRING) END AS manager_employee_id,
        CAST((10 + s_suppkey % 40) / 10 AS DECIMAL(3,2)) AS performance_rating,
        {pick('s_suppkey % 3', 'EN', 'EN,DE', 'EN,FR')} AS languages_spoken
      FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey"""
    t["in_assignments"] = f"""
      SELECT CAST(c_custkey AS STRING) AS assignment_id, CAST(c_custkey % {users} AS STRING) AS customer_id,
        CAST({suppliers} - 1 - c_custkey % CAST(FLOOR({suppliers} / 2) AS BIGINT) AS STRING) AS advisor_employee_id,
        {d.add_days("DATE '1996-06-01'", 'c_custkey * 29 % 1800')} AS assignment_start_date,
        CASE WHEN c_custkey >= {users} THEN {d.add_days("DATE '1996-06-01'", 'c_custkey * 29 % 1800 + 30')} END AS assignment_end_date,
        c_custkey < {users} AS is_current, {pick('c_custkey % 4', 'INITIAL', 'TRANSFER', 'ESCALATION', 'REBALANCING')} AS assignment_reason
      FROM {{customer}}"""
    target = f"s_suppkey * 7 % {users}"
    full = f"{first(target)} || ' ' || {family(target)}"
    t["in_watch_list"] = f"""
      SELECT 'E' || CAST(s_suppkey AS STRING) AS entity_id,
        CASE s_suppkey % 5 WHEN 0 THEN upper({full}) WHEN 1 THEN 'z' || substr({full}, 2) WHEN 2 THEN {full} || 'xy'
          ELSE {first('s_suppkey + 70001')} || ' ' || {family('s_suppkey + 70001')} END AS entity_name,
        CASE s_suppkey % 5 WHEN 3 THEN 'aka ' || {full} || '; other' WHEN 4 THEN NULL ELSE 'aka ' || {first('s_suppkey + 9')} END AS entity_aliases,
        {pick('s_suppkey % 3', 'Individual', 'Vessel', 'Organization')} AS entity_type,
        CASE WHEN s_suppkey % 2 = 0 THEN CAST({d.add_days("DATE '1918-01-01'", f'{target} * 137 % 24000')} AS STRING) ELSE '[1950]' END AS dob,
        n_name AS nationality_country,
        {pick('s_suppkey % 4', 'DOT - Department of Treasury', 'UK FCDO', 'Canada Transport', 'SECO')} AS authority,
        {pick('s_suppkey % 4', 'SDN List', 'UK Sanctions List', 'Canada Port', 'SECO List')} AS list_name,
        {d.add_days("DATE '1990-01-01'", 's_suppkey * 11 % 4000')} AS effective_date,
        CASE WHEN s_suppkey % 6 = 5 THEN {d.add_days("DATE '2000-01-01'", 's_suppkey * 13 % 1500')} END AS expiry_date,
        'https://example.org/' || CAST(s_suppkey AS STRING) AS citation_link
      FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey"""
    ptarget = f"s_suppkey * 11 % {users}"
    t["in_exposed_persons"] = f"""
      SELECT 'P' || CAST(s_suppkey AS STRING) AS exposed_person_id, first_name || ' ' || last_name AS full_name,
        first_name, last_name, {pick('s_suppkey % 3', 'DOMESTIC', 'FOREIGN', 'FAMILY')} AS exposed_person_category,
        {pick('s_suppkey % 4', 'LOW', 'MEDIUM', 'HIGH', 'CRITICAL')} AS risk_level,
        CASE WHEN s_suppkey % 8 = 7 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status
      FROM (SELECT s_suppkey,
          CASE s_suppkey % 6 WHEN 1 THEN 'z' || substr({first(ptarget)}, 2) WHEN 2 THEN {first(ptarget)} || 'q'
            WHEN 3 THEN {first(ptarget)} || 'qq' WHEN 5 THEN {first('s_suppkey + 90001')} ELSE {first(ptarget)} END AS first_name,
          CASE s_suppkey % 6 WHEN 2 THEN {family(ptarget)} || 'w' WHEN 4 THEN substr({family(ptarget)}, 2, 4) ELSE {family(ptarget)} END AS last_name
        FROM {{supplier}}) q"""
    t["in_loan_extracts"] = f"""
      SELECT 'mortgage_' || CAST(o_orderkey AS STRING) || '_internal.txt' AS file_name, o_orderdate AS file_timestamp,
        o_orderdate AS extraction_timestamp,
        CASE WHEN o_orderkey % 40 = 39 THEN '{{"error": "unreadable"}}' ELSE
        '{{"response": {{"document_type": "MORTGAGE_APPLICATION", "customer_name": "' ||
        CASE WHEN o_orderkey % 10 = 0 THEN 'None' ELSE {first(f'o_custkey % {users}')} || ' ' || {family(f'o_custkey % {users}')} END ||
        '", "employment": "' || o_orderpriority || '", "employment_tenure_years": "' || CAST(o_orderkey % 30 AS STRING) ||
        '", "monthly_income": "CHF ' || CAST(CAST(FLOOR(3000 + o_orderkey % 20000) AS BIGINT) AS STRING) ||
        '", "existing_debts_monthly": "' || CASE WHEN o_orderkey % 9 = 0 THEN 'None' ELSE CAST(o_orderkey * 7 % 3000 AS STRING) END ||
        '", "credit_score": "' || CAST(550 + o_orderkey % 300 AS STRING) ||
        '", "property_address": "' || CASE WHEN o_orderkey % 15 = 0 THEN 'None' ELSE 'Road ' || CAST(o_orderkey AS STRING) END ||
        '", "property_type": "' || CASE WHEN o_orderkey % 14 = 0 THEN 'None' ELSE {pick('o_orderkey % 2', 'HOUSE', 'APARTMENT')} END ||
        '", "purchase_price": "EUR 1,' || lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0') || ', 000' ||
        '", "loan_amount": "' || CAST(CAST(FLOOR(o_totalprice * 3.5) AS BIGINT) AS STRING) ||
        '", "down_payment": "null", "loan_term_years": "' || CAST(5 + o_orderkey % 25 AS STRING) ||
        '", "rate_type": "' || {pick('o_orderkey % 2', 'FIXED', 'VARIABLE')} ||
        '", "country": "' || {pick('o_orderkey % 6', 'Switzerland', 'UK', 'Germany', 'France', 'None', 'Deutschland')} || '"}}}}' END AS extracted_data
      FROM {{orders}}"""
    def el(tag, value, attrs=""):
        return f"'<{tag}{attrs}>' || {value} || '</{tag}>'"

    def wrap(tag, *parts):
        return f"'<{tag}>' || " + " || ".join(parts) + f" || '</{tag}>'"

    def bic(tag, prefix, n):
        return wrap(tag, "'<FinInstnId>'", el("BICFI", f"'{prefix}' || CAST({n} AS STRING)"), "'</FinInstnId>'")

    num = "CAST(o_orderkey AS STRING)"
    msg_id = f"CAST(CAST(o_orderdate AS DATE) AS STRING) || '-MSG' || {num}"
    made = f"CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T10:' || {pick('o_orderkey % 3', '05', '20', '59')} || ':30'"
    paid = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)"
    here, there = pick("o_custkey % 3", "CH", "DE", "GB"), pick("o_orderkey % 3", "CH", "DE", "GB")
    money_ccy = "'<{0} Ccy=\"' || " + ccy("o_orderkey") + " || '\">' || " + paid + " || '</{0}>'"

    def party(tag, name, country):
        return wrap(
            tag, el("Nm", f"'{name} ' || {num}"), "'<PstlAdr>'", el("StrtNm", f"'Road ' || {num}"),
            el("PstCd", "CAST(o_custkey AS STRING)"), el("TwnNm", "'Town'"), el("Ctry", country), "'</PstlAdr>'",
        )

    def iban(tag, prefix):
        return wrap(tag, "'<Id>'", el("IBAN", f"'{prefix}' || {num}"), "'</Id>'")

    def up_to_three(entry):
        """Messages carry one to three entries; the first has the plain number as its mark."""
        more = [f"CASE WHEN o_orderkey % 3 >= {j} THEN {entry(j, repr(f'-{j}'))} ELSE '' END" for j in (1, 2)]
        return [entry(0, "''"), *more]

    def paid_one(j, mark):
        return wrap(
            "CdtTrfTxInf",
            wrap("PmtId", el("InstrId", f"'I' || {num} || {mark}"), el("EndToEndId", f"'E' || {num} || {mark}"), el("TxId", f"'T' || {num} || {mark}")),
            wrap("PmtTpInf", el("InstrPrty", "'NORM'"), "'<SvcLvl>'", el("Cd", "'SEPA'"), "'</SvcLvl>'"),
            money_ccy.format("IntrBkSttlmAmt"), el("IntrBkSttlmDt", "CAST(CAST(o_orderdate AS DATE) AS STRING)"), el("ChrgBr", "'SHAR'"),
            bic("InstgAgt", "BA", "o_custkey % 7"), bic("InstdAgt", "BB", "o_orderkey % 7"), bic("DbtrAgt", "BA", "o_custkey % 7"),
            bic("CdtrAgt", "BB", "o_orderkey % 7"), party("Dbtr", "Debtor", here), iban("DbtrAcct", "DI"),
            party("Cdtr", "Creditor", there), iban("CdtrAcct", "CI"), wrap("RmtInf", el("Ustrd", "o_orderpriority")),
        )

    def answered_one(j, mark):
        return wrap(
            "TxInfAndSts", el("OrgnlEndToEndId", f"CASE WHEN o_orderkey % 6 = 0 THEN 'X' ELSE 'E' || {num} || {mark} END"),
            el("TxSts", pick(f"(o_orderkey + {j}) % 5", "ACCP", "RJCT", "PDNG", "ACSC", "ACSP")), wrap("StsRsnInf", "'<Rsn>'", el("Cd", "'AC01'"), "'</Rsn>'"),
            el("OrgnlTxId", f"CASE WHEN o_orderkey % 12 = 0 THEN 'X' ELSE 'T' || {num} || {mark} END"),
        )

    transfer = wrap(
        "FIToFICstmrCdtTrf",
        wrap("GrpHdr", el("MsgId", msg_id), el("CreDtTm", made), el("NbOfTxs", "CAST(1 + o_orderkey % 3 AS STRING)"), money_ccy.format("TtlIntrBkSttlmAmt"),
             wrap("SttlmInf", el("SttlmMtd", "'CLRG'"), "'<ClrSys>'", el("Cd", pick("o_orderkey % 2", "TARGET2", "SIC")), "'</ClrSys>'")),
        *up_to_three(paid_one),
    )
    answer = wrap(
        "FIToFIPmtStsRpt",
        wrap("GrpHdr", el("MsgId", f"'R' || {num}"), el("CreDtTm", f"CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T11:00:00'"),
             bic("InstgAgt", "BB", "o_orderkey % 7"), bic("InstdAgt", "BA", "o_custkey % 7")),
        wrap("OrgnlGrpInfAndSts", el("OrgnlMsgId", msg_id), el("OrgnlMsgNmId", "'pacs.008.001.08'"), el("OrgnlCreDtTm", made),
             el("GrpSts", pick("o_orderkey % 3", "ACCP", "RJCT", "PDNG"))),
        *up_to_three(answered_one),
    )
    ns = '<Document xmlns="urn:iso:std:iso:20022:tech:xsd:pacs">'
    t["in_messages"] = f"""
      SELECT 'pacs008_' || {num} || '.xml' AS file_name, o_orderdate AS load_ts, '{ns}' || {transfer} || '</Document>' AS raw_xml FROM {{orders}}
      UNION ALL SELECT 'pacs002_' || {num} || '.xml', o_orderdate, '{ns}' || {answer} || '</Document>' FROM {{orders}} WHERE o_orderkey % 10 <> 0"""
    return t


def needs(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


SPARK_TABLES = tables(SparkDialect)
ANSI_TABLES = {
    name: re.sub(r"\{(\w+)\}", r"\1", sql) for name, sql in tables(AnsiDialect).items()
}
