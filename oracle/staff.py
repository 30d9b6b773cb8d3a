"""Hierarchy, advisor and workload queries."""

from oracle import QUERIES, VIEWS, d, mean, pct, r
from oracle.bank import AS_OF

_nm = lambda a: f"{a}.first_name || ' ' || {a}.family_name"
VIEWS["emp"] = "SELECT *, first_name || ' ' || family_name AS emp_name FROM in_employees"
# manager numbers fall with every step up, so ancestors are found by following at most 12 managers
_J = " ".join(f"LEFT JOIN emp e{i} ON e{i - 1}.manager_employee_id = e{i}.employee_id" for i in range(1, 13))
_level = "1 + " + " + ".join(f"CASE WHEN e{i}.employee_id IS NOT NULL THEN 1 ELSE 0 END" for i in range(1, 13))
_root = "coalesce(" + ", ".join(f"e{i}.employee_id" for i in range(12, -1, -1)) + ")"
_path = lambda x: "concat_ws(' > ', " + ", ".join(f"e{i}.{x}" for i in range(12, -1, -1)) + ")"
QUERIES["hierarchy"] = f"""
  SELECT e0.employee_id, e0.first_name, e0.family_name, e0.position_level, e0.manager_employee_id, e0.country, e0.region, e0.employment_status, e0.hire_date, {d('e0.performance_rating')} AS performance_rating, e0.emp_name AS full_name,
    {_level} AS hierarchy_level, {_root} AS root_super_leader_id, CASE WHEN e0.position_level = 'CLIENT_ADVISOR' THEN e0.manager_employee_id END AS team_leader_id, {_path('employee_id')} AS hierarchy_path, {_path('emp_name')} AS hierarchy_path_names,
    CASE WHEN e0.position_level = 'CLIENT_ADVISOR' THEN e1.emp_name END AS team_leader_name FROM emp e0 {_J}"""
VIEWS["cur"] = "SELECT DISTINCT customer_id, advisor_employee_id AS employee_id, assignment_start_date AS sd FROM in_assignments WHERE is_current"
QUERIES["organizational_chart"] = f"""
  SELECT e.employee_id, e.emp_name AS employee_name, e.position_level, e.country, e.region, e.employment_status, e.hire_date, date_diff('day', e.hire_date, {AS_OF}) AS tenure_days, {r(f"date_diff('day', e.hire_date, {AS_OF}) / 365.25", 1)} AS tenure_years, {d('e.performance_rating')} AS performance_rating, e.languages_spoken,
    e.manager_employee_id, m.emp_name AS manager_name, m.position_level AS manager_position, (SELECT count(*) FROM emp x WHERE x.manager_employee_id = e.employee_id) AS direct_reports, (SELECT count(DISTINCT customer_id) FROM cur x WHERE x.employee_id = e.employee_id) AS client_count
  FROM emp e LEFT JOIN emp m ON e.manager_employee_id = m.employee_id"""
VIEWS["one360"] = "SELECT DISTINCT customer_id, has_anomaly, total_balance, total_accounts, total_transactions, risk_classification, account_tier, reporting_currency, country, days_since_last_transaction FROM c360"
VIEWS["advp"] = f"""
  SELECT e.employee_id, e.emp_name AS advisor_name, e.country, e.region, e.hire_date, date_diff('day', e.hire_date, {AS_OF}) AS tenure_days, e.employment_status, {d('e.performance_rating')} AS performance_rating, e.languages_spoken, e.manager_employee_id AS team_leader_id, m.emp_name AS team_leader_name,
    count(a.customer_id) AS total_clients, count(CASE WHEN has_anomaly THEN 1 END) AS high_risk_clients, {pct('count(CASE WHEN has_anomaly THEN 1 END)', 'count(a.customer_id)')} AS high_risk_percentage, {d('coalesce(sum(total_balance), 0)')} AS total_portfolio_value, coalesce({r(mean('total_balance'))}, 0) AS avg_client_balance,
    {d('coalesce(max(total_balance), 0)')} AS max_client_balance, CAST(coalesce(sum(total_accounts), 0) AS BIGINT) AS total_client_accounts, coalesce({r(mean('total_accounts'))}, 0) AS avg_accounts_per_client, CAST(coalesce(sum(total_transactions), 0) AS BIGINT) AS total_transactions, coalesce({r(mean('total_transactions'))}, 0) AS avg_transactions_per_client,
    count(CASE WHEN risk_classification = 'CRITICAL' THEN 1 END) AS critical_risk_clients, count(CASE WHEN risk_classification = 'HIGH' THEN 1 END) AS high_risk_clients_classification, max(sd) AS most_recent_assignment, min(sd) AS first_assignment, {pct('count(a.customer_id)', '200')} AS capacity_utilization_pct, 200 - count(a.customer_id) AS available_capacity,
    CASE WHEN count(a.customer_id) >= 180 THEN 'AT_CAPACITY' WHEN count(a.customer_id) >= 150 THEN 'HIGH_LOAD' WHEN count(a.customer_id) >= 100 THEN 'BALANCED' ELSE 'LOW_LOAD' END AS workload_status
  FROM emp e LEFT JOIN emp m ON e.manager_employee_id = m.employee_id LEFT JOIN cur a ON a.employee_id = e.employee_id LEFT JOIN one360 o ON o.customer_id = a.customer_id WHERE e.position_level = 'CLIENT_ADVISOR' GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11"""
QUERIES["advisor_performance"] = "SELECT * FROM advp"
_cc = lambda x: d(f"sum(CASE WHEN reporting_currency = '{x}' THEN total_balance ELSE 0 END)")
QUERIES["portfolio_by_advisor"] = f"""
  SELECT e.employee_id AS advisor_employee_id, e.emp_name AS advisor_name, e.country, e.region, count(*) AS total_clients, {d('sum(total_balance)')} AS total_aum, {r(mean('total_balance'))} AS avg_aum_per_client, {', '.join(f'{_cc(x)} AS aum_{x.lower()}' for x in ('USD', 'EUR', 'GBP', 'CHF'))},
    {d("sum(CASE WHEN reporting_currency NOT IN ('USD','EUR','GBP','CHF') THEN total_balance ELSE 0 END)")} AS aum_other, {', '.join(f"count(CASE WHEN account_tier = '{x}' THEN 1 END) AS {x.lower()}_clients" for x in ('PREMIUM', 'PLATINUM', 'GOLD'))}, {r('CAST(sum(total_balance) AS DOUBLE) / 100')} AS estimated_annual_revenue
  FROM cur a JOIN emp e ON a.employee_id = e.employee_id JOIN one360 o ON o.customer_id = a.customer_id GROUP BY 1, 2, 3, 4"""
VIEWS["teams"] = f"""
  SELECT t.employee_id AS team_leader_id, t.emp_name AS team_leader_name, t.region, t.hire_date, {d('t.performance_rating')} AS tl_performance_rating, t.manager_employee_id AS super_leader_id, s.emp_name AS super_leader_name, count(DISTINCT e.employee_id) AS total_advisors,
    count(DISTINCT CASE WHEN e.employment_status = 'ACTIVE' THEN e.employee_id END) AS active_advisors, (SELECT {r(mean('performance_rating'))} FROM emp x WHERE x.manager_employee_id = t.employee_id) AS avg_advisor_performance, {d('min(e.performance_rating)')} AS min_advisor_performance, {d('max(e.performance_rating)')} AS max_advisor_performance,
    count(DISTINCT a.customer_id) AS total_clients, count(DISTINCT CASE WHEN has_anomaly THEN a.customer_id END) AS high_risk_clients, {d('coalesce(sum(total_balance), 0)')} AS total_team_aum, coalesce({r(mean('total_balance'))}, 0) AS avg_client_balance, count(DISTINCT e.country) AS countries_covered, coalesce(string_agg(DISTINCT e.country, ', ' ORDER BY e.country), '') AS country_list,
    {r('CAST(count(DISTINCT a.customer_id) AS DOUBLE) / nullif(count(DISTINCT e.employee_id), 0)', 1)} AS avg_clients_per_advisor, {pct('count(DISTINCT a.customer_id)', 'count(DISTINCT e.employee_id) * 200')} AS team_capacity_utilization_pct, count(DISTINCT e.employee_id) * 200 - count(DISTINCT a.customer_id) AS team_available_capacity
  FROM emp t LEFT JOIN emp s ON t.manager_employee_id = s.employee_id LEFT JOIN emp e ON e.manager_employee_id = t.employee_id LEFT JOIN cur a ON a.employee_id = e.employee_id LEFT JOIN one360 o ON o.customer_id = a.customer_id WHERE t.position_level = 'TEAM_LEADER' GROUP BY 1, 2, 3, 4, 5, 6, 7, t.employee_id"""
QUERIES["team_leader_dashboard"] = "SELECT * FROM teams"
_du = f"date_diff('day', assignment_start_date, {AS_OF})"
QUERIES["current_assignments"] = f"""
  SELECT assignment_id, a.customer_id, c.full_name AS customer_name, o.country AS customer_country, c.has_anomaly AS is_high_risk_customer, advisor_employee_id, e.emp_name AS advisor_name, e.country AS advisor_country, e.region AS advisor_region, {d('e.performance_rating')} AS advisor_rating, e.manager_employee_id AS team_leader_id,
    m.emp_name AS team_leader_name, assignment_start_date, {_du} AS assignment_duration_days, {r(f'{_du} / 365.25', 1)} AS assignment_duration_years, assignment_reason, {d('total_balance')} AS total_balance, total_transactions, total_accounts, account_tier, o.risk_classification, days_since_last_transaction
  FROM in_assignments a JOIN customer_current c ON a.customer_id = c.customer_id JOIN emp e ON a.advisor_employee_id = e.employee_id LEFT JOIN emp m ON e.manager_employee_id = m.employee_id LEFT JOIN (SELECT * EXCLUDE (account_tier) , account_tier FROM one360) o ON o.customer_id = a.customer_id WHERE a.is_current""".replace(" account_tier, o.risk", " o.account_tier, o.risk")
QUERIES["assignment_history"] = f"""
  SELECT assignment_id, a.customer_id, c.full_name AS customer_name, advisor_employee_id, e.emp_name AS advisor_name, e.country AS advisor_country, assignment_start_date, assignment_end_date, a.is_current, date_diff('day', assignment_start_date, coalesce(assignment_end_date, {AS_OF})) AS assignment_duration_days, assignment_reason,
    CASE WHEN assignment_end_date IS NULL THEN 'ACTIVE' ELSE 'ENDED' END AS assignment_status, CASE assignment_reason WHEN 'TRANSFER' THEN 'Advisor Change' WHEN 'ESCALATION' THEN 'Escalated to Senior' WHEN 'REBALANCING' THEN 'Workload Rebalancing' ELSE 'Initial Assignment' END AS assignment_type_description
  FROM in_assignments a JOIN customer_current c ON a.customer_id = c.customer_id JOIN emp e ON a.advisor_employee_id = e.employee_id"""
QUERIES["workload_distribution"] = f"""
  SELECT e.country, e.region, count(DISTINCT e.employee_id) AS advisor_count, count(DISTINCT a.customer_id) AS total_clients, {r('CAST(count(DISTINCT a.customer_id) AS DOUBLE) / count(DISTINCT e.employee_id)', 1)} AS avg_clients_per_advisor, min(n) AS min_clients_per_advisor, max(n) AS max_clients_per_advisor,
    {r('stddev_samp(n)', 1)} AS stddev_clients, count(DISTINCT e.employee_id) * 200 AS total_capacity, count(DISTINCT a.customer_id) AS used_capacity, count(DISTINCT e.employee_id) * 200 - count(DISTINCT a.customer_id) AS available_capacity, {pct('count(DISTINCT a.customer_id)', 'count(DISTINCT e.employee_id) * 200')} AS capacity_utilization_pct,
    CASE WHEN stddev_samp(n) < 20 THEN 'WELL_BALANCED' WHEN stddev_samp(n) < 40 THEN 'MODERATELY_BALANCED' ELSE 'IMBALANCED' END AS balance_status
  FROM emp e LEFT JOIN cur a ON a.employee_id = e.employee_id LEFT JOIN (SELECT employee_id, count(DISTINCT customer_id) AS n FROM cur GROUP BY 1) k ON k.employee_id = e.employee_id WHERE e.position_level = 'CLIENT_ADVISOR' GROUP BY 1, 2"""
QUERIES["advisors"] = """
  SELECT employee_id, advisor_name AS full_name, advisor_name AS first_name, advisor_name AS family_name, CAST(NULL AS DATE) AS date_of_birth, CAST(NULL AS DOUBLE) AS total_checking_balance, CAST(NULL AS DOUBLE) AS total_savings_balance, CAST(NULL AS DOUBLE) AS total_investment_balance, hire_date, team_leader_id AS manager_employee_id, languages_spoken, total_clients, total_portfolio_value AS total_aum, avg_client_balance, total_clients AS active_clients, 0 AS closed_clients, CAST(CASE WHEN total_clients > 0 THEN 100 ELSE 0 END AS DOUBLE) AS client_retention_rate,
    total_client_accounts AS total_accounts_managed, high_risk_clients, 0 AS premium_clients, country, region, employment_status, performance_rating, CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS certifications, CAST(NULL AS VARCHAR) AS position_level, CAST(NULL AS VARCHAR) AS office_location FROM advp"""
