"""Declared column layouts of the landing tables, in file order (fixed values)."""

LANDING = {
    "customer": """customer_id STRING, first_name STRING, family_name STRING, date_of_birth DATE, onboarding_date DATE,
        reporting_currency STRING, has_anomaly BOOLEAN, employer STRING, position STRING, employment_type STRING,
        income_range STRING, account_tier STRING, email STRING, phone STRING, preferred_contact_method STRING,
        risk_classification STRING, credit_score_band STRING, insert_timestamp_utc TIMESTAMP_NTZ""",
    "addresses": """customer_id STRING, street_address STRING, city STRING, state STRING, zipcode STRING, country STRING,
        insert_timestamp_utc TIMESTAMP_NTZ""",
    "exposed_person": """exposed_person_id STRING, full_name STRING, first_name STRING, last_name STRING, date_of_birth DATE,
        nationality STRING, position_title STRING, organization STRING, country STRING, exposed_person_category STRING,
        risk_level STRING, status STRING, start_date DATE, end_date DATE, reference_link STRING, source STRING,
        last_updated DATE, created_date DATE""",
    "customer_event": """event_id STRING, customer_id STRING, event_type STRING, event_date DATE,
        event_timestamp_utc TIMESTAMP_NTZ, channel STRING, event_details STRING, previous_value STRING, new_value STRING,
        triggered_by STRING, requires_review BOOLEAN, review_status STRING, review_date DATE, notes STRING,
        insert_timestamp_utc TIMESTAMP_NTZ""",
    "customer_status": """status_id STRING, customer_id STRING, status STRING, status_reason STRING, status_start_date DATE,
        status_end_date DATE, is_current BOOLEAN, linked_event_id STRING, insert_timestamp_utc TIMESTAMP_NTZ""",
    "accounts": "account_id STRING, account_type STRING, base_currency STRING, customer_id STRING, status STRING",
    "employee": """employee_id STRING, first_name STRING, family_name STRING, email STRING, phone STRING, date_of_birth DATE,
        hire_date DATE, employment_status STRING, country STRING, office_location STRING, region STRING,
        position_level STRING, manager_employee_id STRING, performance_rating DECIMAL(3,2), languages_spoken STRING,
        certifications STRING, insert_timestamp_utc TIMESTAMP_NTZ""",
    "client_assignment": """assignment_id STRING, customer_id STRING, advisor_employee_id STRING, assignment_start_date DATE,
        assignment_end_date DATE, is_current BOOLEAN, assignment_reason STRING, insert_timestamp_utc TIMESTAMP_NTZ""",
    "fx_rates": """date DATE, from_currency STRING, to_currency STRING, mid_rate DECIMAL(15,6), bid_rate DECIMAL(15,6),
        ask_rate DECIMAL(15,6), created_at TIMESTAMP_NTZ""",
    "transactions": """booking_date TIMESTAMP_NTZ, value_date DATE, transaction_id STRING, account_id STRING,
        amount DECIMAL(15,2), currency STRING, base_amount DECIMAL(15,2), base_currency STRING, fx_rate DECIMAL(15,6),
        counterparty_account STRING, description STRING, created_at TIMESTAMP_NTZ""",
    "equity_trades": """trade_date TIMESTAMP_NTZ, settlement_date DATE, trade_id STRING, customer_id STRING,
        account_id STRING, order_id STRING, exec_id STRING, symbol STRING, isin STRING, side STRING,
        quantity DECIMAL(15,4), price DECIMAL(18,6), currency STRING, gross_amount DECIMAL(18,2),
        commission DECIMAL(12,4), net_amount DECIMAL(18,2), base_currency STRING, base_gross_amount DECIMAL(18,2),
        base_net_amount DECIMAL(18,2), fx_rate DECIMAL(12,6), market STRING, order_type STRING, exec_type STRING,
        time_in_force STRING, broker_id STRING, venue STRING, created_at TIMESTAMP_NTZ""",
    "fi_trades": """trade_date TIMESTAMP_NTZ, settlement_date DATE, trade_id STRING, customer_id STRING, account_id STRING,
        order_id STRING, instrument_type STRING, instrument_id STRING, issuer STRING, issuer_type STRING, currency STRING,
        side STRING, notional DOUBLE, price DOUBLE, accrued_interest DOUBLE, gross_amount DOUBLE, commission DOUBLE,
        net_amount DOUBLE, base_currency STRING, base_gross_amount DOUBLE, base_net_amount DOUBLE, fx_rate DOUBLE,
        fixed_rate DOUBLE, floating_rate_index STRING, tenor_years DOUBLE, coupon_rate DOUBLE, maturity_date DATE,
        duration DOUBLE, dv01 DOUBLE, credit_rating STRING, credit_spread_bps DOUBLE, market STRING, broker_id STRING,
        venue STRING, liquidity_score DOUBLE, created_at TIMESTAMP_NTZ""",
    "cmd_trades": """trade_date TIMESTAMP_NTZ, settlement_date DATE, trade_id STRING, customer_id STRING, account_id STRING,
        order_id STRING, commodity_type STRING, commodity_name STRING, commodity_code STRING, contract_type STRING,
        side STRING, quantity DOUBLE, unit STRING, price DOUBLE, currency STRING, gross_amount DOUBLE, commission DOUBLE,
        net_amount DOUBLE, base_currency STRING, base_gross_amount DOUBLE, base_net_amount DOUBLE, fx_rate DOUBLE,
        contract_size DOUBLE, num_contracts DOUBLE, delivery_month STRING, delivery_location STRING, delta DOUBLE,
        vega DOUBLE, spot_price DOUBLE, forward_price DOUBLE, volatility DOUBLE, liquidity_score DOUBLE, exchange STRING,
        broker_id STRING, venue STRING, created_at TIMESTAMP_NTZ""",
    "hqla_holdings": """holding_id STRING, as_of_date DATE, asset_type STRING, isin STRING, security_name STRING,
        currency STRING, quantity DECIMAL(18,6), market_value_ccy DECIMAL(18,2), market_value_chf DECIMAL(18,2),
        fx_rate DECIMAL(12,6), maturity_date DATE, credit_rating STRING, smi_constituent BOOLEAN, hqla_eligible BOOLEAN,
        ineligibility_reason STRING, portfolio_code STRING, custodian STRING, insert_timestamp_utc TIMESTAMP_NTZ""",
    "deposit_balances": """account_id STRING, as_of_date DATE, customer_id STRING, deposit_type STRING, currency STRING,
        balance_ccy DECIMAL(18,2), balance_chf DECIMAL(18,2), fx_rate DECIMAL(12,6), is_insured BOOLEAN,
        product_count INT, account_tenure_days INT, has_direct_debit BOOLEAN, is_operational BOOLEAN,
        counterparty_type STRING, customer_segment STRING, account_status STRING, insert_timestamp_utc TIMESTAMP_NTZ""",
}
# tokens that mean "no value" in the liquidity files
LIQUIDITY_NULLS = ("NULL", "null", "")
# name patterns of the landing files
FILE_PATTERNS = {
    "customer": "*customers*.csv",
    "addresses": "*customer_addresses*.csv",
    "exposed_person": "*pep*.csv",
    "customer_event": "*customer_events*.csv",
    "customer_status": "*customer_status*.csv",
}
