"""Employee hierarchy, advisors, teams, assignments and workload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import (
    at_least, choose, days, distinct_list, ladder, mean, on_date, pct, ratio, rnd, sum_if, zero,
)
from tidemark.functions.lineage import stored
from tidemark.functions.spread import salted_join

CAPACITY = 200


def _name(prefix: str = ""):
    return F.concat_ws(" ", f"{prefix}first_name", f"{prefix}family_name")


TOP, ADVISOR = "SUPER_TEAM_LEADER", "CLIENT_ADVISOR"


def chains(staff: DataFrame) -> DataFrame:
    """employee_id and up: the employee, the manager, the manager's manager and so on, as structs of id, name and level.

    Each round joins every unfinished chain with the chain of its last manager, so chains double: a chain of n levels takes
    log2(n) rounds, however long. A chain ends where there is no manager, or before someone who is on it already.
    """
    known = staff.select(F.col("employee_id").alias("manager_employee_id"), F.lit(True).alias("_known")).distinct()
    first = staff.join(known, "manager_employee_id", "left").select(
        "employee_id",
        F.array(F.struct(F.col("employee_id").alias("id"), F.col("full_name").alias("name"), F.col("position_level").alias("level"))).alias("up"),
        F.when(F.col("_known"), F.col("manager_employee_id")).alias("next"),
    )
    state = stored(first)
    while not state.where("next IS NOT NULL").isEmpty():
        upper = state.select(F.col("employee_id").alias("next"), F.col("up").alias("more"), F.col("next").alias("then"))
        ids = F.transform("up", lambda x: x["id"])
        # one manager may head very many unfinished chains
        met = salted_join(state.where("next IS NOT NULL"), upper, "next").withColumn(
            "again", F.array_position(F.transform("more", lambda x: F.array_contains(ids, x["id"])), F.lit(True))
        )
        more = F.when(F.col("again") > 0, F.slice("more", 1, F.col("again").cast("int") - 1)).otherwise(F.col("more"))
        longer = met.select("employee_id", F.concat("up", more).alias("up"), F.when(F.col("again") == 0, F.col("then")).alias("next"))
        state = stored(state.where("next IS NULL").union(longer))
    return state.select("employee_id", "up")


def hierarchy(employees: DataFrame) -> DataFrame:
    """Everyone under a top leader, with level and paths; below several top leaders once for each.

    There is no limit to the levels, and a chain of managers that returns to itself ends there.
    """
    staff = employees.select(
        "employee_id", "first_name", "family_name", "position_level", "manager_employee_id", "country", "region",
        "employment_status", "hire_date", "performance_rating", _name().alias("full_name"),
    )
    at = F.explode(F.filter(F.sequence(F.lit(1), F.size("up")), lambda i: F.get("up", i - 1)["level"] == TOP)).alias("hierarchy_level")
    placed = chains(staff).select("employee_id", "up", at)
    down = placed.withColumn("down", F.reverse(F.slice("up", 1, F.col("hierarchy_level"))))
    # the manager of the nearest advisor, the employee included, below the top leader
    below = F.slice("up", 1, F.col("hierarchy_level") - 1)
    advisor = F.array_position(F.transform(below, lambda x: F.coalesce(x["level"] == ADVISOR, F.lit(False))), F.lit(True))
    leader = F.when(advisor > 0, F.get("up", advisor.cast("int")))
    walked = down.select(
        "employee_id",
        "hierarchy_level",
        F.get("down", F.lit(0))["id"].alias("root_super_leader_id"),
        leader["id"].alias("team_leader_id"),
        F.array_join(F.transform("down", lambda x: x["id"]), " > ").alias("hierarchy_path"),
        F.array_join(F.transform("down", lambda x: x["name"]), " > ").alias("hierarchy_path_names"),
        leader["name"].alias("team_leader_name"),
    )
    return walked.join(staff, "employee_id")


def _current(assignments: DataFrame) -> DataFrame:
    return assignments.where("is_current").select(
        "customer_id", F.col("advisor_employee_id").alias("employee_id"), "assignment_start_date"
    )


def _managers(employees: DataFrame) -> DataFrame:
    return employees.select(F.col("employee_id").alias("manager_employee_id"), _name().alias("_manager"), F.col("position_level").alias("_manager_level"))


def _per_customer(view: DataFrame) -> DataFrame:
    """One row per customer: the wide view repeats a customer once per screening match."""
    kept = [
        "has_anomaly", "total_balance", "total_accounts", "total_transactions", "risk_classification", "account_tier",
        "reporting_currency", "country", "days_since_last_transaction",
    ]
    return view.select("customer_id", *kept).distinct()


def organizational_chart(employees: DataFrame, assignments: DataFrame, *, as_of) -> DataFrame:
    tenure = days("hire_date", on_date(as_of))
    reports = (
        employees.where(F.col("manager_employee_id").isNotNull())
        .groupBy(F.col("manager_employee_id").alias("employee_id"))
        .agg(F.count(F.lit(1)).alias("direct_reports"))
    )
    clients = _current(assignments).groupBy("employee_id").agg(F.countDistinct("customer_id").alias("client_count"))
    return (
        employees.join(_managers(employees), "manager_employee_id", "left")
        .join(reports, "employee_id", "left")
        .join(clients, "employee_id", "left")
        .select(
            "employee_id",
            _name().alias("employee_name"),
            "position_level",
            "country",
            "region",
            "employment_status",
            "hire_date",
            tenure.alias("tenure_days"),
            rnd(tenure / 365.25, 1).alias("tenure_years"),
            "performance_rating",
            "languages_spoken",
            "manager_employee_id",
            F.col("_manager").alias("manager_name"),
            F.col("_manager_level").alias("manager_position"),
            zero("direct_reports").alias("direct_reports"),
            zero("client_count").alias("client_count"),
        )
    )


def _book_of(assignments: DataFrame, view: DataFrame) -> DataFrame:
    """Totals per advisor over their current clients."""
    held = _current(assignments).join(_per_customer(view), "customer_id", "left")
    first = held.groupBy("employee_id", "customer_id").agg(
        F.max("assignment_start_date").alias("_last"),
        F.min("assignment_start_date").alias("_first"),
        *[F.max(x).alias(x) for x in ("has_anomaly", "total_balance", "total_accounts", "total_transactions", "risk_classification")],
    )
    level = F.col("risk_classification")
    return first.groupBy("employee_id").agg(
        F.count(F.lit(1)).alias("total_clients"),
        F.count_if("has_anomaly").alias("high_risk_clients"),
        F.sum("total_balance").alias("_aum"),
        rnd(mean("total_balance")).alias("_avg_balance"),
        F.max("total_balance").alias("_max_balance"),
        F.count("total_balance").alias("_with_balance"),
        F.sum("total_accounts").alias("_accounts"),
        rnd(mean("total_accounts")).alias("_avg_accounts"),
        F.sum("total_transactions").alias("_txns"),
        rnd(mean("total_transactions")).alias("_avg_txns"),
        F.count_if(level == "CRITICAL").alias("critical_risk_clients"),
        F.count_if(level == "HIGH").alias("high_risk_clients_classification"),
        F.max("_last").alias("most_recent_assignment"),
        F.min("_first").alias("first_assignment"),
    )


def _load(n):
    return at_least(n, [(180, "AT_CAPACITY"), (150, "HIGH_LOAD"), (100, "BALANCED")], "LOW_LOAD")


def advisor_performance(employees, assignments, customer_view, *, as_of, capacity: int = CAPACITY) -> DataFrame:
    advisors = employees.where(F.col("position_level") == "CLIENT_ADVISOR")
    n = zero("total_clients")
    return (
        advisors.join(_managers(employees), "manager_employee_id", "left")
        .join(_book_of(assignments, customer_view), "employee_id", "left")
        .select(
            "employee_id",
            _name().alias("advisor_name"),
            "country",
            "region",
            "hire_date",
            days("hire_date", on_date(as_of)).alias("tenure_days"),
            "employment_status",
            "performance_rating",
            "languages_spoken",
            F.col("manager_employee_id").alias("team_leader_id"),
            F.col("_manager").alias("team_leader_name"),
            n.alias("total_clients"),
            zero("high_risk_clients").alias("high_risk_clients"),
            pct(zero("high_risk_clients"), n).alias("high_risk_percentage"),
            zero("_aum").alias("total_portfolio_value"),
            F.coalesce("_avg_balance", F.lit(0.0)).alias("avg_client_balance"),
            zero("_max_balance").alias("max_client_balance"),
            zero("_accounts").alias("total_client_accounts"),
            F.coalesce("_avg_accounts", F.lit(0.0)).alias("avg_accounts_per_client"),
            zero("_txns").alias("total_transactions"),
            F.coalesce("_avg_txns", F.lit(0.0)).alias("avg_transactions_per_client"),
            zero("critical_risk_clients").alias("critical_risk_clients"),
            zero("high_risk_clients_classification").alias("high_risk_clients_classification"),
            "most_recent_assignment",
            "first_assignment",
            pct(n, F.lit(capacity)).alias("capacity_utilization_pct"),
            (F.lit(capacity) - n).alias("available_capacity"),
            _load(n).alias("workload_status"),
        )
    )


def portfolio_by_advisor(assignments: DataFrame, employees: DataFrame, customer_view: DataFrame) -> DataFrame:
    bal, ccy, tier = F.col("total_balance"), F.col("reporting_currency"), F.col("account_tier")
    named = ["USD", "EUR", "GBP", "CHF"]
    book = (
        _current(assignments)
        .select("customer_id", "employee_id")
        .distinct()
        .join(_per_customer(customer_view), "customer_id")
        .groupBy("employee_id")
        .agg(
            F.count(F.lit(1)).alias("total_clients"),
            F.sum(bal).alias("total_aum"),
            rnd(mean(bal)).alias("avg_aum_per_client"),
            *[sum_if(ccy == x, bal).alias(f"aum_{x.lower()}") for x in named],
            sum_if(~ccy.isin(named) | ccy.isNull(), bal).alias("aum_other"),
            *[F.count_if(tier == x).alias(f"{x.lower()}_clients") for x in ("PREMIUM", "PLATINUM", "GOLD")],
            rnd(F.sum(bal) / 100).alias("estimated_annual_revenue"),
        )
    )
    who = employees.select("employee_id", _name().alias("advisor_name"), "country", "region")
    return book.join(who, "employee_id").withColumnRenamed("employee_id", "advisor_employee_id")


def team_leader_dashboard(employees, assignments, customer_view, *, capacity: int = CAPACITY) -> DataFrame:
    """Per team leader: advisors, clients, assets and capacity, each summed before joining."""
    book = _book_of(assignments, customer_view)
    team = (
        employees.where(F.col("manager_employee_id").isNotNull())
        .join(book, "employee_id", "left")
        .groupBy(F.col("manager_employee_id").alias("team_leader_id"))
        .agg(
            F.count(F.lit(1)).alias("total_advisors"),
            F.count_if(F.col("employment_status") == "ACTIVE").alias("active_advisors"),
            rnd(mean("performance_rating")).alias("avg_advisor_performance"),
            F.min("performance_rating").alias("min_advisor_performance"),
            F.max("performance_rating").alias("max_advisor_performance"),
            zero(F.sum("total_clients")).alias("total_clients"),
            zero(F.sum("high_risk_clients")).alias("high_risk_clients"),
            zero(F.sum("_aum")).alias("total_team_aum"),
            F.coalesce(rnd(ratio(F.sum("_aum"), F.sum("_with_balance"))), F.lit(0.0)).alias("avg_client_balance"),
            F.size(F.collect_set("country")).alias("countries_covered"),
            distinct_list("country").alias("country_list"),
        )
    )
    leaders = employees.where(F.col("position_level") == "TEAM_LEADER").select(
        F.col("employee_id").alias("team_leader_id"),
        _name().alias("team_leader_name"),
        "region",
        "hire_date",
        F.col("performance_rating").alias("tl_performance_rating"),
        "manager_employee_id",
    )
    zeros = ["total_advisors", "active_advisors", "total_clients", "high_risk_clients", "total_team_aum", "countries_covered"]
    n, clients = F.col("total_advisors"), F.col("total_clients")
    return (
        leaders.join(_managers(employees).drop("_manager_level"), "manager_employee_id", "left")
        .join(team, "team_leader_id", "left")
        .withColumns({x: zero(x) for x in zeros})
        .withColumns(
            {
                "avg_client_balance": F.coalesce("avg_client_balance", F.lit(0.0)),
                "country_list": F.coalesce("country_list", F.lit("")),
                "avg_clients_per_advisor": rnd(ratio(clients, n), 1),
                "team_capacity_utilization_pct": pct(clients, n * capacity),
                "team_available_capacity": n * capacity - clients,
            }
        )
        .withColumnsRenamed({"manager_employee_id": "super_leader_id", "_manager": "super_leader_name"})
    )


def current_assignments(assignments, customers, employees, customer_view, *, as_of) -> DataFrame:
    held = days("assignment_start_date", on_date(as_of))
    advisor = employees.select(
        F.col("employee_id").alias("advisor_employee_id"), _name().alias("advisor_name"),
        F.col("country").alias("advisor_country"), F.col("region").alias("advisor_region"),
        F.col("performance_rating").alias("advisor_rating"), "manager_employee_id",
    )
    client = customers.select("customer_id", F.col("full_name").alias("customer_name"), F.col("has_anomaly").alias("is_high_risk_customer"))
    return (
        assignments.where("is_current")
        .join(client, "customer_id")
        .join(advisor, "advisor_employee_id")
        .join(_managers(employees), "manager_employee_id", "left")
        .join(_per_customer(customer_view).drop("has_anomaly", "reporting_currency"), "customer_id", "left")
        .select(
            "assignment_id",
            "customer_id",
            "customer_name",
            F.col("country").alias("customer_country"),
            "is_high_risk_customer",
            "advisor_employee_id",
            "advisor_name",
            "advisor_country",
            "advisor_region",
            "advisor_rating",
            F.col("manager_employee_id").alias("team_leader_id"),
            F.col("_manager").alias("team_leader_name"),
            "assignment_start_date",
            held.alias("assignment_duration_days"),
            rnd(held / 365.25, 1).alias("assignment_duration_years"),
            "assignment_reason",
            "total_balance",
            "total_transactions",
            "total_accounts",
            "account_tier",
            "risk_classification",
            "days_since_last_transaction",
        )
    )


REASONS = {"TRANSFER": "Advisor Change", "ESCALATION": "Escalated to Senior", "REBALANCING": "Workload Rebalancing"}


def assignment_history(assignments, customers, employees, *, as_of) -> DataFrame:
    advisor = employees.select(
        F.col("employee_id").alias("advisor_employee_id"), _name().alias("advisor_name"),
        F.col("country").alias("advisor_country"),
    )
    client = customers.select("customer_id", F.col("full_name").alias("customer_name"))
    return (
        assignments.join(client, "customer_id")
        .join(advisor, "advisor_employee_id")
        .select(
            "assignment_id",
            "customer_id",
            "customer_name",
            "advisor_employee_id",
            "advisor_name",
            "advisor_country",
            "assignment_start_date",
            "assignment_end_date",
            "is_current",
            days("assignment_start_date", F.coalesce("assignment_end_date", on_date(as_of))).alias(
                "assignment_duration_days"
            ),
            "assignment_reason",
            F.when(F.col("assignment_end_date").isNull(), "ACTIVE").otherwise("ENDED").alias("assignment_status"),
            choose("assignment_reason", REASONS, "Initial Assignment").alias("assignment_type_description"),
        )
    )


def workload_distribution(employees: DataFrame, assignments: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """Client spread per country and region.

    The spread is weighted by assignment rows, as each advisor appears once per current client.
    """
    clients = _current(assignments).groupBy("employee_id").agg(
        F.countDistinct("customer_id").alias("_n"), F.count(F.lit(1)).alias("_rows")
    )
    df = employees.where(F.col("position_level") == "CLIENT_ADVISOR").join(clients, "employee_id", "left")
    n, rows = F.col("_n"), F.col("_rows")
    weight, s1, s2 = F.sum(rows), F.sum(rows * n), F.sum(rows * n * n)
    spread = F.when(
        weight > 1, F.sqrt((weight * s2 - s1 * s1).cast("double") / (weight * (weight - 1)).cast("double"))
    )
    used, room = zero(F.sum(n)), F.count(F.lit(1)) * capacity
    return df.groupBy("country", "region").agg(
        F.count(F.lit(1)).alias("advisor_count"),
        used.alias("total_clients"),
        rnd(ratio(used, F.count(F.lit(1))), 1).alias("avg_clients_per_advisor"),
        F.min(n).alias("min_clients_per_advisor"),
        F.max(n).alias("max_clients_per_advisor"),
        rnd(spread, 1).alias("stddev_clients"),
        room.alias("total_capacity"),
        used.alias("used_capacity"),
        (room - used).alias("available_capacity"),
        pct(used, room).alias("capacity_utilization_pct"),
        ladder([(spread < 20, "WELL_BALANCED"), (spread < 40, "MODERATELY_BALANCED")], "IMBALANCED").alias(
            "balance_status"
        ),
    )


def advisors(performance: DataFrame) -> DataFrame:
    """The advisor table under the names other reports expect."""
    missing = ["email", "phone", "certifications", "position_level", "office_location"]
    return performance.select(
        "employee_id",
        *[F.col("advisor_name").alias(x) for x in ("full_name", "first_name", "family_name")],
        "hire_date",
        F.col("team_leader_id").alias("manager_employee_id"),
        "languages_spoken",
        "total_clients",
        F.col("total_portfolio_value").alias("total_aum"),
        "avg_client_balance",
        F.col("total_clients").alias("active_clients"),
        F.lit(0).alias("closed_clients"),
        F.when(F.col("total_clients") > 0, 100.0).otherwise(0.0).alias("client_retention_rate"),
        F.col("total_client_accounts").alias("total_accounts_managed"),
        "high_risk_clients",
        F.lit(0).alias("premium_clients"),
        "country",
        "region",
        "employment_status",
        "performance_rating",
        *[F.lit(None).cast("string").alias(x) for x in missing],
        F.lit(None).cast("date").alias("date_of_birth"),
        *[F.lit(None).cast("decimal(18,2)").alias(f"total_{x}_balance") for x in ("checking", "savings", "investment")],
    )


