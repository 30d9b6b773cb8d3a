"""Customer versions, lifecycle, the wide customer view, and screening status."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import (
    as_date, c, choose, days, distinct_list, flag, ladder, mean, months_crossed, on_date, pct, rnd, sum_if,
    years_crossed, zero,
)
from tidemark.functions.lineage import stored
from tidemark.functions.spread import latest, with_next
from tidemark.operators.screening import exposed_match_score

VERSION_TS = "insert_timestamp_utc"


def _full_name():
    return F.concat_ws(" ", "first_name", "family_name")


def current_version(versions: DataFrame, key: str = "customer_id", ts: str = VERSION_TS, tie: str = "version_id") -> DataFrame:
    """Newest version per key."""
    row = latest(versions, [key], [ts, tie])
    return row.drop(tie).withColumnRenamed(ts, "current_from").withColumn("is_current", F.lit(True))


def version_history(versions: DataFrame, key: str = "customer_id", ts: str = VERSION_TS, tie: str = "version_id") -> DataFrame:
    """Every version with its validity; an interval ends the day before the next version."""
    df = with_next(versions, [key], ts, [tie], "_next")
    return df.select(
        *[x for x in versions.columns if x not in (ts, tie)],
        as_date(ts).alias("valid_from"),
        F.date_sub(as_date("_next"), 1).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
        ts,
    )


def addresses_current(addresses: DataFrame) -> DataFrame:
    return current_version(addresses)


def addresses_history(addresses: DataFrame) -> DataFrame:
    return version_history(addresses)


def customer_current(customers: DataFrame) -> DataFrame:
    return current_version(customers).withColumn("full_name", _full_name())


def customer_history(customers: DataFrame) -> DataFrame:
    return version_history(customers).withColumn("full_name", _full_name())


EVENT_KINDS = [
    "ONBOARDING", "ACCOUNT_CLOSE", "ACCOUNT_UPGRADE", "ACCOUNT_DOWNGRADE", "ADDRESS_CHANGE", "EMPLOYMENT_CHANGE",
    "REACTIVATION", "CHURN",
]


def customer_lifecycle(customers: DataFrame, events: DataFrame, *, as_of) -> DataFrame:
    today = on_date(as_of)
    seen = events.groupBy("customer_id").agg(
        F.count("event_id").alias("total_lifecycle_events"),
        F.min("event_date").alias("first_event_date"),
        F.max("event_date").alias("last_event_date"),
        *[F.count_if(F.col("event_type") == k).alias(f"{k.lower()}_count") for k in EVENT_KINDS],
        F.count_if(F.col("event_date") >= F.add_months(today, -3)).alias("_recent"),
    )
    n = zero("total_lifecycle_events")
    idle = F.coalesce(days("last_event_date", today), F.lit(9999))
    age = days("onboarding_date", today)
    return customers.join(seen, "customer_id", "left").select(
        "customer_id",
        "first_name",
        "family_name",
        "full_name",
        "onboarding_date",
        age.alias("customer_age_days"),
        rnd(age / 30.44, 2).alias("customer_age_months"),
        n.alias("total_lifecycle_events"),
        "first_event_date",
        "last_event_date",
        idle.alias("days_since_last_event"),
        *[zero(f"{k.lower()}_count").alias(f"{k.lower()}_count") for k in EVENT_KINDS],
        (idle <= 90).alias("has_recent_activity"),
        (idle >= 180).alias("is_dormant_lifecycle"),
        F.when(n == 0, 0.0)
        .otherwise(F.least(F.lit(100.0), n * 10.0 + zero("_recent") * 5.0))
        .alias("engagement_score"),
    )


# ---- ladders of the customer view --------------------------------------------------------------

# fixed values: rating and score by the highest exposed-person level, with and without an anomaly
RISK_RULES = [
    ("CRITICAL", True, "CRITICAL", 95),
    ("HIGH", True, "HIGH", 85),
    ("CRITICAL", False, "HIGH", 80),
    ("MEDIUM", True, "MEDIUM", 65),
    ("HIGH", False, "MEDIUM", 60),
    ("LOW", True, "LOW", 45),
    ("MEDIUM", False, "LOW", 40),
    (None, True, "LOW", 35),
    ("LOW", False, "LOW", 30),
]


def risk_rating_and_score(exact_level, fuzzy_level, sanctions_id, has_anomaly):
    """(rating, score) from both exposed-person levels, a sanctions hit and the anomaly mark."""
    rating, score = [(c(sanctions_id).isNotNull(), "CRITICAL")], [(c(sanctions_id).isNotNull(), 100)]
    for level, with_anomaly, label, points in RISK_RULES:
        cond = F.lit(True)
        if level:
            cond = flag(c(exact_level) == level) | flag(c(fuzzy_level) == level)
        if with_anomaly:
            cond = cond & flag(c(has_anomaly))
        rating.append((cond, label))
        score.append((cond, points))
    return ladder(rating, "NO_RISK"), ladder(score, 10)


def vulnerability(income, band, dob, onboarding, tier, risk, *, as_of):
    """(flag, category) of a customer who may need special care."""
    today = on_date(as_of)
    age = years_crossed(dob, today)
    old = flag(age >= 75)
    young = flag(age.between(18, 25) & (months_crossed(onboarding, today) <= 6))
    poor = flag(c(income).isin("0-25K", "25K-50K") & c(band).isin("POOR", "FAIR"))
    fragile = flag(c(tier).isin("BASIC", "STANDARD") & c(risk).isin("HIGH", "CRITICAL"))
    category = ladder(
        [(old, "CAPABILITY"), (young, "CAPABILITY,FINANCIAL"), (poor, "FINANCIAL"), (fragile, "LIFE_EVENT,FINANCIAL")]
    )
    return old | young | poor | fragile, category


def lifecycle_stage(onboarding, *, as_of):
    """(stage, churn probability) from the lifecycle columns of the same row."""
    tenure = days(onboarding, on_date(as_of))
    left = flag((F.col("churn_count") > 0) | (F.col("account_close_count") > 0))
    dormant, score, idle = flag(F.col("is_dormant_lifecycle")), F.col("engagement_score"), F.col("days_since_last_event")
    stage = ladder(
        [
            (tenure <= 90, "NEW"),
            (left, "CHURNED"),
            (dormant, "DORMANT"),
            ((score < 30) & (idle > 90), "DECLINING"),
            ((tenure >= 365) & (score >= 50), "MATURE"),
        ],
        "ACTIVE",
    )
    churn = ladder(
        [
            (left, 100.0),
            (dormant & (score < 20), 85.0),
            (dormant, 70.0),
            ((idle > 120) & (score < 30), 55.0),
            (idle > 90, 40.0),
            (score < 30, 25.0),
            (~F.col("has_recent_activity"), 15.0),
        ],
        5.0,
    )
    return stage, churn


def _accounts_per_customer(accounts: DataFrame) -> DataFrame:
    kind = F.col("account_type")
    return accounts.groupBy("customer_id").agg(
        F.count("account_id").alias("total_accounts"),
        distinct_list("account_type").alias("account_types"),
        distinct_list("base_currency").alias("currencies"),
        *[F.count_if(kind == k).alias(f"{k.lower()}_accounts") for k in ("CHECKING", "SAVINGS", "BUSINESS", "INVESTMENT")],
    )


def _balances_per_customer(balances: DataFrame) -> DataFrame:
    bal, kind = F.col("current_balance_base"), F.col("account_type")
    return balances.groupBy("customer_id").agg(
        F.sum(bal).alias("total_balance"),
        F.max("last_transaction_date").alias("balance_as_of_date"),
        *[
            sum_if(kind == k, bal).alias(f"{k.lower()}_balance")
            for k in ("CHECKING", "SAVINGS", "BUSINESS", "INVESTMENT")
        ],
        F.max(bal).alias("max_account_balance"),
        F.min(bal).alias("min_account_balance"),
        rnd(mean(bal)).alias("avg_account_balance"),
    )


def _payments_per_customer(txns: DataFrame, accounts: DataFrame, today) -> DataFrame:
    year = F.col("value_date") >= F.add_months(today, -12)
    per_account = txns.groupBy("account_id").agg(
        F.count_if(year).alias("y"),
        F.count("transaction_id").alias("n"),
        F.max("value_date").alias("last"),
        F.count_if(year & (F.col("amount") < 0)).alias("d"),
        F.count_if(year & (F.col("amount") > 0)).alias("cr"),
        F.count_if(F.col("value_date") >= F.add_months(today, -1)).alias("m"),
    )
    return (
        per_account.join(accounts.select("account_id", "customer_id"), "account_id")
        .groupBy("customer_id")
        .agg(
            F.sum("y").alias("total_transactions"),
            F.sum("n").alias("total_transactions_all_time"),
            F.max("last").alias("last_transaction_date"),
            F.sum("d").alias("debit_transactions"),
            F.sum("cr").alias("credit_transactions"),
            F.sum("m").alias("_last_month"),
        )
    )


def customer_360(
    customers, addresses, status, accounts, balances, txns, assignments, exposed, screening, lifecycle, *, as_of
) -> DataFrame:
    """Everything known about a customer, one row per customer and screening-match combination.

    ``customers``/``addresses`` are current versions, ``exposed`` comes from
    `exposed_person_matches`, ``screening`` from `customer_screening`.  Accounts, balances and
    payments are each reduced to one row per customer before they are joined.
    """
    people = customer_persons(
        customers, addresses, status, accounts, balances, txns, assignments, exposed, lifecycle, as_of=as_of
    )
    return customer_view(people, screening, as_of=as_of)


def customer_persons(
    customers, addresses, status, accounts, balances, txns, assignments, exposed, lifecycle, *, as_of
) -> DataFrame:
    """What the view joins before the list hits: one row per customer and exposed-person match."""
    today = on_date(as_of)
    where = addresses.select(
        "customer_id", "street_address", "city", "state", "zipcode", "country",
        F.col("current_from").alias("address_effective_date"),
    )
    now = latest(
        status.where("is_current").select("customer_id", "status", "status_start_date", "status_id"),
        ["customer_id"],
        ["status_start_date", "status_id"],
    ).select(
        "customer_id",
        F.col("status").alias("current_status"),
        F.col("status_start_date").alias("status_effective_date"),
    )
    advisor = assignments.where("is_current").select(
        "customer_id",
        F.col("advisor_employee_id").alias("current_advisor_employee_id"),
        F.col("assignment_start_date").alias("advisor_assignment_start_date"),
    )

    def person(kind: str) -> DataFrame:
        label = kind.lower()
        return exposed.where(F.col("match_kind") == kind).select(
            F.col("customer_id"),
            F.col("exposed_person_id").alias(f"exposed_person_{label}_match_id"),
            F.col("full_name").alias(f"exposed_person_{label}_match_name"),
            F.col("exposed_person_category").alias(f"exposed_person_{label}_category"),
            F.col("risk_level").alias(f"exposed_person_{label}_risk_level"),
            *([F.col("first_name").alias("_pf"), F.col("last_name").alias("_pl")] if kind == "FUZZY" else []),
        )

    fuzzy = person("FUZZY").withColumnRenamed("customer_id", "_fuzzy_customer")
    cycle = lifecycle.select(
        "customer_id", "churn_count", "account_close_count", "is_dormant_lifecycle", "engagement_score",
        "days_since_last_event", "has_recent_activity", "total_lifecycle_events",
    )
    df = (
        customers.drop("current_from", "is_current")
        .join(where, "customer_id", "left")
        .join(now, "customer_id", "left")
        .join(_accounts_per_customer(accounts), "customer_id", "left")
        .join(_balances_per_customer(balances), "customer_id", "left")
        .join(_payments_per_customer(txns, accounts, today), "customer_id", "left")
        .join(cycle, "customer_id", "left")
        .join(advisor, "customer_id", "left")
        .join(person("EXACT"), "customer_id", "left")
    )
    return df.join(
        fuzzy,
        (df["customer_id"] == fuzzy["_fuzzy_customer"])
        & (fuzzy["exposed_person_fuzzy_match_id"] != F.coalesce("exposed_person_exact_match_id", F.lit("NO_EXACT_MATCH"))),
        "left",
    )


def _hits(screening: DataFrame) -> DataFrame:
    return screening.select(
        "customer_id",
        F.col("entity_id").alias("sanctions_match_id"),
        F.col("entity_name").alias("sanctions_match_name"),
        F.col("authority").alias("sanctions_authority"),
        F.col("list_name").alias("sanctions_list"),
        "sanctions_program",
        "sanctions_risk_score",
        F.col("match_type").alias("sanctions_match_type_detail"),
        F.col("match_score").alias("sanctions_match_score"),
        F.col("match_confidence").alias("sanctions_match_confidence"),
        F.col("disposition_recommendation").alias("sanctions_disposition"),
        F.col("alert_priority").alias("sanctions_alert_priority"),
        F.col("dob_match").alias("sanctions_dob_match"),
        F.col("nationality_match").alias("sanctions_nationality_match"),
    )


def repeated_entries(watch_list: DataFrame) -> DataFrame:
    """entity_id of the list's entries that share one; all other entries match a customer once in each way."""
    return watch_list.groupBy("entity_id").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1).select("entity_id")


def _distinct_hits(screening: DataFrame, repeated: DataFrame | None) -> DataFrame:
    if repeated is None:
        # dealt by customer, which serves the distinct rows and the join
        return _hits(screening).repartition("customer_id").distinct()
    again = repeated.select(F.col("entity_id").alias("_again"))
    same = F.col("entity_id").eqNullSafe(F.col("_again"))
    once = _hits(screening.join(again, same, "left_anti"))
    return once.unionByName(_hits(screening.join(again, same, "left_semi")).distinct())


def customer_view(people: DataFrame, screening: DataFrame, *, as_of, repeated: DataFrame | None = None) -> DataFrame:
    """The view from the rows of `customer_persons` and the hits of `customer_screening`.

    What doesn't depend on a list hit is computed before the hits multiply the rows, so readers of such columns that
    count a customer once need no hits.  With ``repeated``, what `repeated_entries` gives for the screened list, only the
    hits of those entries are compared with each other, and readers join no more columns of the hits than they need;
    without it all hits are made distinct.
    """
    today, df = on_date(as_of), people
    hit = _distinct_hits(screening, repeated)
    exact_id, fuzzy_id, sid = (
        F.col(x) for x in ("exposed_person_exact_match_id", "exposed_person_fuzzy_match_id", "sanctions_match_id")
    )
    levels = ("exposed_person_exact_risk_level", "exposed_person_fuzzy_risk_level")
    anomaly, kind = F.col("has_anomaly"), F.col("sanctions_match_type_detail")
    near = kind.isin("FUZZY_MATCH", "ALIAS_MATCH")
    rating, score = risk_rating_and_score(*levels, "sanctions_match_id", anomaly)
    vulnerable, category = vulnerability(
        "income_range", "credit_score_band", "date_of_birth", "onboarding_date", "account_tier", "risk_classification",
        as_of=as_of,
    )
    stage, churn = lifecycle_stage("onboarding_date", as_of=as_of)
    watched = exact_id.isNotNull() | fuzzy_id.isNotNull()
    idle = F.coalesce(days("last_transaction_date", today), F.lit(9999))
    zeros = [
        "total_accounts", "checking_accounts", "savings_accounts", "business_accounts", "investment_accounts",
        "total_balance", "checking_balance", "savings_balance", "business_balance", "investment_balance",
        "max_account_balance", "min_account_balance", "total_transactions", "total_transactions_all_time",
        "debit_transactions", "credit_transactions", "total_lifecycle_events",
    ]
    accuracy = ladder(
        [
            (exact_id.isNotNull(), F.lit(100.0)),
            (
                fuzzy_id.isNotNull(),
                exposed_match_score("first_name", "family_name", "_pf", "_pl", "exposed_person_fuzzy_match_name"),
            ),
        ]
    )
    of_hit = {
        "sanctions_match_accuracy_percent": F.col("sanctions_match_score"),
        "sanctions_match_type": F.coalesce(kind, F.lit("NO_MATCH")),
        "sanctions_exact_match_id": F.when(kind == "EXACT_MATCH", sid),
        "sanctions_exact_match_name": F.when(kind == "EXACT_MATCH", F.col("sanctions_match_name")),
        "sanctions_fuzzy_match_id": F.when(near, sid),
        "sanctions_fuzzy_match_name": F.when(near, F.col("sanctions_match_name")),
        "overall_sanctions_risk": F.when(sid.isNotNull(), "CRITICAL").otherwise("NO_SANCTIONS_RISK"),
        "overall_risk_rating": rating,
        "overall_risk_score": score,
        "requires_sanctions_review": sid.isNotNull(),
        "high_risk_customer": flag(anomaly) & (F.col("requires_exposed_person_review") | sid.isNotNull()),
    }
    of_person = {
        **{x: zero(x) for x in zeros},
        "avg_account_balance": F.coalesce("avg_account_balance", F.lit(0.0)),
        "account_types": F.coalesce("account_types", F.lit("")),
        "currencies": F.coalesce("currencies", F.lit("")),
        "engagement_score": F.coalesce("engagement_score", F.lit(0.0)),
        "days_since_last_transaction": idle,
        "avg_monthly_transactions": rnd(zero("total_transactions") / 12.0, 2),
        "is_dormant_transactionally": idle >= 180,
        "is_highly_active": zero("_last_month") > 50,
        "exposed_person_match_accuracy_percent": accuracy,
        "exposed_person_match_type": ladder(
            [(exact_id.isNotNull(), "EXACT_MATCH"), (fuzzy_id.isNotNull(), "FUZZY_MATCH")], "NO_MATCH"
        ),
        # only active persons are matched; the list carries no entity type or country per match
        "exposed_person_exact_status": F.when(exact_id.isNotNull(), "ACTIVE"),
        "exposed_person_fuzzy_status": F.when(fuzzy_id.isNotNull(), "ACTIVE"),
        "overall_exposed_person_risk": ladder(
            [
                (flag(F.col(levels[0]) == x) | flag(F.col(levels[1]) == x), x)
                for x in ("CRITICAL", "HIGH", "MEDIUM", "LOW")
            ],
            "NO_EXPOSED_PERSON_RISK",
        ),
        "requires_exposed_person_review": watched,
        "vulnerable_customer_flag": vulnerable,
        "vulnerability_categories": category,
        "legal_capacity_concerns_flag": F.lit(False),
        "lifecycle_stage": stage,
        "churn_probability": churn,
    }
    unknown = [f"sanctions_{k}_match_{x}" for k in ("exact", "fuzzy") for x in ("type", "country")]
    added = [
        "days_since_last_transaction", "avg_monthly_transactions", "is_dormant_transactionally", "is_highly_active",
        "exposed_person_match_accuracy_percent", "exposed_person_match_type", "sanctions_match_accuracy_percent",
        "sanctions_match_type", "exposed_person_exact_status", "exposed_person_fuzzy_status", *unknown,
        "sanctions_exact_match_id", "sanctions_exact_match_name", "sanctions_fuzzy_match_id", "sanctions_fuzzy_match_name",
        "overall_exposed_person_risk", "overall_sanctions_risk", "overall_risk_rating", "overall_risk_score",
        "requires_exposed_person_review", "requires_sanctions_review", "high_risk_customer", "vulnerable_customer_flag",
        "vulnerability_categories", "legal_capacity_concerns_flag", "lifecycle_stage", "churn_probability",
    ]
    helpers = {
        "_pf", "_pl", "_fuzzy_customer", "_last_month", "churn_count", "account_close_count", "is_dormant_lifecycle",
        "days_since_last_event", "has_recent_activity",
    }
    own = [x for x in df.columns if x not in helpers]
    out = df.withColumns(of_person).drop(*helpers).join(hit, "customer_id", "left")
    out = out.withColumns({**of_hit, **{x: F.lit(None).cast("string") for x in unknown}})
    return out.select(*own, *[x for x in hit.columns if x != "customer_id"], *added)


MATCHED = ("EXACT_MATCH", "FUZZY_MATCH")


def one_per_customer(view: DataFrame) -> DataFrame:
    """The highest-scored row of each customer, where the view holds one row per match."""
    order = [
        "overall_risk_score", "sanctions_match_id", "exposed_person_exact_match_id", "exposed_person_fuzzy_match_id",
        "sanctions_match_type_detail",
    ]
    return latest(view, ["customer_id"], order)


#: Rows of one hit for each customer that every task may hold; with more they are joined by key.
HELD_ROWS = 1_000_000


def last_hits(screening: DataFrame) -> DataFrame:
    """The last hit by entity and kind of each customer.

    It is found among narrow rows, and the others are dropped where they are read: they aren't shuffled.
    """
    order = ["entity_id", "match_type"]
    last = stored(screening.groupBy("customer_id").agg(F.max(F.struct(*order)).alias("_last")).select("customer_id", "_last.*"))
    keys = ["customer_id", *order]
    same = reduce(and_, (F.col(x).eqNullSafe(F.col(f"_last_{x}")) for x in keys))
    last = last.withColumnsRenamed({x: f"_last_{x}" for x in keys})
    hits = screening.join(F.broadcast(last) if last.count() <= HELD_ROWS else last, same, "left_semi")
    return latest(hits, ["customer_id"], order)


def customers_once(people: DataFrame, screening: DataFrame, *, as_of) -> DataFrame:
    """`one_per_customer` of the view, without its product of persons and hits.

    A customer's rows hold each person with each hit, and the score asks only whether there is a hit: the chosen row
    has the last hit by entity and kind whatever its person.
    """
    return one_per_customer(customer_view(people, last_hits(screening), as_of=as_of))


def customer_kinds(people: DataFrame, screening: DataFrame, *, as_of) -> DataFrame:
    """The view with one hit of each kind that a customer has, for readers that ask which kinds there are, or any.

    A hit without an identifier of the entry asks for no review, so it is a kind of its own.
    """
    kinds = screening.withColumn("_known", F.col("entity_id").isNotNull()).dropDuplicates(["customer_id", "match_type", "_known"])
    return customer_view(people, kinds.drop("_known"), as_of=as_of)


def per_customer(view: DataFrame, **flags) -> DataFrame:
    """One row per customer with each named condition true if any of its match rows has it."""
    return view.groupBy("customer_id").agg(
        F.max("total_balance").alias("total_balance"), *[F.max(flag(x)).alias(n) for n, x in flags.items()]
    )


def customer_risk_profile(view: DataFrame) -> DataFrame:
    """One row of counts, shares and balances; each customer counts once."""
    pep, hit, cls = F.col("exposed_person_match_type"), F.col("sanctions_match_type"), F.col("risk_classification")
    is_pep, is_hit = pep.isin(*MATCHED), hit.isin(*MATCHED)
    severe, anomaly, dormant = cls.isin("CRITICAL", "HIGH"), F.col("has_anomaly"), F.col("is_dormant_transactionally")
    factors = sum((flag(x).cast("int") for x in (is_pep, severe, is_hit, anomaly)), F.lit(0))
    listed = is_pep | severe | is_hit
    conds = {f"{x.lower()}_risk": cls == x for x in ("CRITICAL", "HIGH", "MEDIUM", "LOW")} | {
        "pep": is_pep,
        "pep_exact_match": pep == "EXACT_MATCH",
        "pep_fuzzy_match": pep == "FUZZY_MATCH",
        "sanctions": is_hit,
        "sanctions_exact_match": hit == "EXACT_MATCH",
        "sanctions_fuzzy_match": hit == "FUZZY_MATCH",
        "anomaly": anomaly,
        "combined_high_risk": listed | anomaly,
        "multiple_risk_factors": factors >= 2,
        "pep_and_sanctions": is_pep & is_hit,
        "dormant_high_risk": listed & dormant,
        "active_high_risk": listed & ~dormant,
        "_listed": listed,
    }
    shares = ["critical_risk", "high_risk", "medium_risk", "low_risk", "pep", "sanctions", "anomaly", "combined_high_risk"]
    n = F.count(F.lit(1))
    return per_customer(view, **conds).agg(
        n.alias("total_customers"),
        *[F.count_if(x).alias(f"{x}_count") for x in conds if x != "_listed"],
        *[pct(F.count_if(x), n).alias(f"{x}_pct") for x in shares],
        *[sum_if(F.col(f"{x}_risk"), "total_balance").alias(f"{x}_risk_aum") for x in ("critical", "high", "medium", "low")],
        sum_if(F.col("_listed"), "total_balance").alias("total_high_risk_aum"),
    )


def _confidence(kind: str, accuracy: str):
    fuzzy = F.col(kind) == "FUZZY_MATCH"
    return ladder(
        [
            (F.col(kind) == "EXACT_MATCH", "HIGH"),
            (fuzzy & (F.col(accuracy) >= 90), "MEDIUM_HIGH"),
            (fuzzy & (F.col(accuracy) >= 80), "MEDIUM"),
            (fuzzy, "LOW_MEDIUM"),
        ],
        "NONE",
    )


def screening_status(view: DataFrame, *, as_of) -> DataFrame:
    pep, hit, cls = F.col("exposed_person_match_type"), F.col("sanctions_match_type"), F.col("risk_classification")
    is_pep, is_hit = pep.isin(*MATCHED), hit.isin(*MATCHED)
    severe = ("CRITICAL", "HIGH")
    age = days("onboarding_date", on_date(as_of))
    review = F.col("requires_exposed_person_review") | F.col("requires_sanctions_review")
    deadlines = [
        (hit == "EXACT_MATCH", 1),
        (hit == "FUZZY_MATCH", 3),
        (pep == "EXACT_MATCH", 7),
        (pep == "FUZZY_MATCH", 14),
    ]
    breach = F.lit(False)
    for cond, limit in deadlines:
        breach = breach | (cond & (age > limit))
    return view.select(
        "customer_id",
        "first_name",
        "family_name",
        "full_name",
        "date_of_birth",
        "country",
        "onboarding_date",
        "current_status",
        pep.alias("pep_match_type"),
        is_pep.alias("is_pep"),
        F.coalesce("exposed_person_exact_match_name", "exposed_person_fuzzy_match_name").alias("pep_match_name"),
        F.coalesce("exposed_person_exact_category", "exposed_person_fuzzy_category").alias("pep_category"),
        F.coalesce("exposed_person_exact_risk_level", "exposed_person_fuzzy_risk_level").alias("pep_risk_level"),
        F.col("exposed_person_match_accuracy_percent").alias("pep_match_accuracy"),
        _confidence("exposed_person_match_type", "exposed_person_match_accuracy_percent").alias("pep_match_confidence"),
        "sanctions_match_type",
        is_hit.alias("has_sanctions_hit"),
        F.coalesce("sanctions_exact_match_name", "sanctions_fuzzy_match_name").alias("sanctions_match_name"),
        F.coalesce("sanctions_exact_match_type", "sanctions_fuzzy_match_type").alias("sanctions_entity_type"),
        F.coalesce("sanctions_exact_match_country", "sanctions_fuzzy_match_country").alias("sanctions_country"),
        F.col("sanctions_match_accuracy_percent").alias("sanctions_match_accuracy"),
        _confidence("sanctions_match_type", "sanctions_match_accuracy_percent").alias("sanctions_match_confidence"),
        "overall_exposed_person_risk",
        "overall_sanctions_risk",
        "overall_risk_rating",
        "overall_risk_score",
        ladder(
            [
                (hit == "EXACT_MATCH", "SANCTIONS_EXACT_CRITICAL"),
                (hit == "FUZZY_MATCH", "SANCTIONS_FUZZY_HIGH"),
                ((pep == "EXACT_MATCH") & F.col("exposed_person_exact_risk_level").isin(*severe), "PEP_EXACT_HIGH"),
                ((pep == "FUZZY_MATCH") & F.col("exposed_person_fuzzy_risk_level").isin(*severe), "PEP_FUZZY_HIGH"),
                (is_pep, "PEP_MEDIUM"),
                (cls == "CRITICAL", "HIGH_RISK_NO_MATCH"),
                (cls == "HIGH", "MEDIUM_RISK_NO_MATCH"),
            ],
            "LOW_RISK",
        ).alias("screening_risk_tier"),
        ladder(
            [
                (is_hit, "IMMEDIATE_BLOCK"),
                (pep == "EXACT_MATCH", "ENHANCED_DUE_DILIGENCE"),
                (pep == "FUZZY_MATCH", "VERIFY_AND_INVESTIGATE"),
                (cls == "CRITICAL", "ENHANCED_MONITORING"),
                (cls == "HIGH", "STANDARD_MONITORING"),
            ],
            "ROUTINE",
        ).alias("required_action"),
        F.col("requires_exposed_person_review").alias("requires_pep_review"),
        "requires_sanctions_review",
        review.alias("requires_investigation"),
        ladder([*deadlines, (cls == "CRITICAL", 7), (cls == "HIGH", 30)], 90).alias("investigation_sla_days"),
        age.alias("days_since_screening"),
        breach.alias("is_sla_breach"),
        "risk_classification",
        F.col("has_anomaly").alias("has_transaction_anomaly"),
        "high_risk_customer",
        (is_hit | is_pep | flag(cls.isin(*severe))).alias("is_high_risk"),
        (is_hit & is_pep).alias("has_multiple_screening_hits"),
        F.col("total_balance").alias("account_balance"),
        "total_accounts",
        "total_transactions",
        "is_dormant_transactionally",
    )


ACTION_RANK = {
    "IMMEDIATE_BLOCK": 1,
    "ENHANCED_DUE_DILIGENCE": 2,
    "VERIFY_AND_INVESTIGATE": 3,
    "ENHANCED_MONITORING": 4,
}


def screening_alerts(status: DataFrame) -> DataFrame:
    return status.where("requires_investigation").orderBy(
        choose("required_action", ACTION_RANK, 5), F.desc("is_sla_breach"), F.desc("days_since_screening"),
        # equal rows of the above are most rows; in order of these they are sorted by many tasks
        "customer_id", "pep_match_name", "sanctions_match_name",
    )
