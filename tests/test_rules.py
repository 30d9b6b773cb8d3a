"""One row on each side of the documented thresholds, and edge inputs."""

import random
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.expr import minutes_crossed, months_crossed, rnd
from tidemark.functions.spread import quantiles
from tidemark.operators import customer as cu
from tidemark.operators import liquidity as lq
from tidemark.operators import loans as ln
from tidemark.operators import payments as pay
from tidemark.operators import screening as sc
from tidemark.operators import staff as st
from tidemark.plans import lookups
from tidemark.plans.catalog import registered

AS_OF = "2024-06-30"


def ids(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_rounding_and_boundaries(spark):
    row = spark.range(1).select(
        rnd(F.lit(2.675)).alias("a"),
        rnd(F.lit(-2.675)).alias("b"),
        months_crossed(F.lit("2024-01-31"), F.lit("2024-02-01")).alias("m"),
        minutes_crossed(F.lit(datetime(2024, 1, 1, 0, 0, 59)), F.lit(datetime(2024, 1, 1, 0, 1, 0))).alias("n"),
    ).first()
    assert (row.a, row.b, row.m, row.n) == (2.68, -2.68, 1, 1)


def test_risk_ladder(spark):
    rows = [
        ("a", "CRITICAL", None, None, True), ("b", None, "HIGH", None, True), ("c", "CRITICAL", None, None, False),
        ("d", None, "MEDIUM", None, True), ("e", "HIGH", "LOW", None, False), ("f", "LOW", None, None, True),
        ("g", "MEDIUM", None, None, False), ("h", None, None, None, True), ("i", "LOW", None, None, False),
        ("j", None, None, None, False), ("k", None, None, "E1", False),
    ]
    df = spark.createDataFrame(rows, "id string, e string, f string, s string, an boolean")
    rating, score = cu.risk_rating_and_score("e", "f", "s", "an")
    got = {r.id: (r.r, r.p) for r in df.select("id", rating.alias("r"), score.alias("p")).collect()}
    assert got == {
        "a": ("CRITICAL", 95), "b": ("HIGH", 85), "c": ("HIGH", 80), "d": ("MEDIUM", 65), "e": ("MEDIUM", 60),
        "f": ("LOW", 45), "g": ("LOW", 40), "h": ("LOW", 35), "i": ("LOW", 30), "j": ("NO_RISK", 10), "k": ("CRITICAL", 100),
    }


def test_match_score(spark):
    rows = [("ann", "lee", "ann", "lee"), ("ann", "lee", "anx", "lex"), ("ann", "lee", "ann", "lex"), ("ann", "lee", "ann", "lxx"), ("annabel", "lee", "xnnxbxl", "lee")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string").withColumn("n", F.concat_ws(" ", "c", "d"))
    got = [r.s for r in df.select(sc.exposed_match_score("a", "b", "c", "d", "n").alias("s")).collect()]
    assert got == [100.0, 95.0, 90.0, 85.0, 70.0]


def test_run_off_rate_is_clamped(spark):
    rows = [
        (1, "0.0300", True, 3, True, 600), (2, "0.0500", True, 3, False, 600), (3, "0.0500", True, 2, True, 539),
        (4, "1.0000", False, 9, True, 10), (5, "0.1000", False, 3, True, 540), (6, "0.0500", True, None, None, None),
    ]
    df = spark.createDataFrame(rows, "id int, b string, l boolean, p int, d boolean, t int").withColumn("b", F.col("b").cast("decimal(5,4)"))
    got = ids(df.select("id", lq.run_off_rate("b", "l", "p", "d", "t").cast("double").alias("r")), "id", "r")
    assert got == {1: 0.03, 2: 0.03, 3: 0.09, 4: 1.0, 5: 0.1, 6: 0.05}


def test_lcr_sides_and_cap(spark):
    held = spark.createDataFrame(
        [("1", date(2024, 1, 1), "CASH_SNB", 100.0, True), ("2", date(2024, 1, 1), "CANTON_BOND", 1000.0, True),
         ("3", date(2024, 1, 2), "CASH_SNB", 50.0, True), ("4", date(2024, 1, 2), "CASH_SNB", 999.0, False)],
        "holding_id string, as_of_date date, asset_type string, v double, hqla_eligible boolean",
    ).withColumn("market_value_chf", F.col("v").cast("decimal(18,2)"))
    hqla = lq.hqla_calculation(held, lookups.hqla_eligibility(spark))
    row = hqla.where("as_of_date = '2024-01-01'").first()
    assert (row.l2_uncapped, row.l2_capped, row.cap_applied, row.hqla_total) == (850.0, 66.67, True, 166.67)
    out = spark.createDataFrame(
        [(date(2024, 1, 1), 166.67), (date(2024, 1, 3), 10.0), (date(2024, 1, 2), 52.0)], "as_of_date date, outflow_total double"
    ).withColumns({f"outflow_{x}": F.lit(0.0) for x in ("retail", "corp", "fi")} | {"total_accounts": F.lit(1)})
    daily = lq.lcr_daily(hqla, out, "B")
    assert ids(daily, "as_of_date", "lcr_status") == {date(2024, 1, 1): "PASS", date(2024, 1, 2): "WARNING", date(2024, 1, 3): "FAIL"}
    alone = lq.lcr_daily(hqla, out.where("false"), "B")
    assert {(r.lcr_ratio, r.lcr_status) for r in alone.collect()} == {(9999.99, "N/A")}


def test_small_accounts_and_flat_amounts(spark):
    rows = [("four", 10.0)] * 4 + [("flat", 10.0)] * 6
    df = spark.createDataFrame([(a, v, i) for i, (a, v) in enumerate(rows)], "account_id string, v double, i int").select(
        "account_id", F.col("v").cast("decimal(15,2)").alias("amount"), F.col("i").cast("string").alias("transaction_id"),
        F.lit(datetime(2024, 6, 1, 12)).cast("timestamp_ntz").alias("booking_date"), F.lit(date(2024, 6, 1)).alias("value_date"),
        F.lit("CHF").alias("currency"), F.lit("x").alias("counterparty_account"), F.lit("d").alias("description"),
    )
    owners = spark.createDataFrame([("flat", "c1")], "account_id string, customer_id string")
    got = pay.transaction_anomalies(df, owners, as_of=AS_OF).collect()
    assert {r.account_id for r in got} == {"flat"} and len(got) == 6
    assert {r.amount_anomaly_score for r in got} == {0.0} and {r.transactions_last_24h for r in got} == {5}


def test_loan_numbers(spark):
    doc = '{"response": {"loan_amount": "CHF 1,200,000", "purchase_price": "1 500 000", "monthly_income": "None", "credit_score": "n/a"}}'
    rows = [("a_internal.txt", doc), ("b_internal.txt", "{broken"), ("c_internal.txt", '{"error": 1}')]
    df = spark.createDataFrame(rows, "file_name string, extracted_data string").withColumns(
        {"file_timestamp": F.lit(datetime(2024, 1, 1)), "extraction_timestamp": F.lit(datetime(2024, 1, 1))}
    )
    got = {r.file_name[0]: r for r in ln.extract_flat(df).collect()}
    assert float(got["a"].loan_amount) == 1200000 and got["a"].ltv_ratio_pct == 80.0
    assert got["a"].monthly_income is None and got["a"].credit_score is None
    assert [got[x].extraction_success for x in "abc"] == [True, False, False]
    assert ln.extract_flat(df, existing=df.limit(1)).count() == 2


def test_hierarchy_skips_orphans(spark):
    rows = [("1", None, "SUPER_TEAM_LEADER"), ("2", "1", "TEAM_LEADER"), ("3", "2", "CLIENT_ADVISOR"), ("4", "99", "CLIENT_ADVISOR"), ("5", "1", "TEAM_LEADER")]
    df = spark.createDataFrame(rows, "employee_id string, manager_employee_id string, position_level string").withColumns(
        {x: F.lit("n") for x in ("first_name", "family_name", "country", "region", "employment_status", "hire_date", "performance_rating")}
    )
    got = {r.employee_id: (r.hierarchy_level, r.team_leader_id, r.hierarchy_path) for r in st.hierarchy(df).collect()}
    assert got == {"1": (1, None, "1"), "2": (2, None, "1 > 2"), "3": (3, "2", "1 > 2 > 3"), "5": (2, None, "1 > 5")}


def _staff(spark, rows):
    df = spark.createDataFrame(rows, "employee_id string, manager_employee_id string, position_level string")
    return df.withColumns(
        {x: F.lit("n") for x in ("first_name", "family_name", "country", "region", "employment_status", "hire_date", "performance_rating")}
    )


def test_hierarchy_of_deep_and_cyclic_chains(spark):
    chain = [("0", None, "SUPER_TEAM_LEADER")] + [(str(i), str(i - 1), "TEAM_LEADER") for i in range(1, 500)]
    chain += [("a", "499", "CLIENT_ADVISOR"), ("b", "a", "ASSISTANT")]
    got = {r.employee_id: r for r in st.hierarchy(_staff(spark, chain)).collect()}
    assert len(got) == 502 and all(got[str(i)].hierarchy_level == i + 1 for i in range(500))
    assert got["b"].hierarchy_path.split(" > ") == [str(i) for i in range(500)] + ["a", "b"]
    assert got["a"].team_leader_id == got["b"].team_leader_id == "499" and got["7"].team_leader_id is None
    ring = [("1", "3", "SUPER_TEAM_LEADER"), ("2", "1", "TEAM_LEADER"), ("3", "2", "TEAM_LEADER")]
    ring += [("4", "3", "SUPER_TEAM_LEADER"), ("5", "4", "TEAM_LEADER"), ("6", "6", "TEAM_LEADER"), ("7", "6", "TEAM_LEADER")]
    got = sorted((r.employee_id, r.hierarchy_path) for r in st.hierarchy(_staff(spark, ring)).collect())
    assert got == [("1", "1"), ("2", "1 > 2"), ("3", "1 > 2 > 3"), ("4", "1 > 2 > 3 > 4"), ("4", "4"), ("5", "1 > 2 > 3 > 4 > 5"), ("5", "4 > 5")]


def test_quantiles_need_exact_values(spark):
    df = spark.createDataFrame([(1, 1.5)], "k int, v double")
    with pytest.raises(TypeError):
        quantiles(df, ["k"], "v", {"m": 0.5})
    fine = df.selectExpr("k", "cast(0.1234 as decimal(10,4)) as v")
    assert quantiles(fine, ["k"], "v", {"m": 0.5}).first().m == 0.1234


def test_fixed_lookups_are_the_broadcast_side(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1024")
    try:
        holdings = spark.range(1000).selectExpr("if(id % 2 = 0, 'CASH_SNB', 'CASH_VAULT') AS asset_type", "cast(id as decimal(18,2)) AS market_value_chf")
        plan = lq.hqla_holdings_detail(holdings, lookups.hqla_eligibility(spark))._jdf.queryExecution().executedPlan().toString()
        apps = spark.range(9).selectExpr("if(id % 2 = 0, 'CH_SARON_MORTGAGE', 'x') AS product_id", "id AS application_id")
        loans = ln._with_product(apps, lookups.products(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for text in (plan, loans):
        assert "BroadcastHashJoin" in text and "BuildRight" in text and "SortMergeJoin" not in text


def test_customers_count_once(spark):
    got = registered()
    sf = "/root/testdata/sf0.01"
    total = got["compliance_summary"](spark, sf).first().total_customers
    assert total == got["customer_risk_profile"](spark, sf).first().total_customers
    assert total == got["customer_360"](spark, sf).select("customer_id").distinct().count()


def test_profile_reads_the_payments_once(spark, folder):
    """Moments, distinct values and quantiles against a plain calculation, and one scan of the facts."""
    rng = random.Random(3)
    rows = [(rng.choice("aaab"), rng.choice([None, *range(-300, 300)]), rng.choice(["CHF", "EUR", None]), rng.choice("xyz"), datetime(2024, 1, rng.randint(1, 28), rng.randint(0, 23))) for _ in range(400)]
    schema = "account_id string, amount int, currency string, counterparty_account string, booking_date timestamp_ntz"
    path = str(folder / "t")
    spark.createDataFrame([*rows, ("c", 1, "CHF", "x", datetime(2024, 1, 1))], schema).withColumn("amount", (F.col("amount") / 100).cast("decimal(12,2)")).write.parquet(path)
    txns = spark.read.parquet(path)
    got = {r.account_id: r for r in pay.behavioural_profile(txns, as_of="2024-02-01").collect()}
    assert set(got) == {"a", "b"}
    for account, r in got.items():
        own = [x for x in rows if x[0] == account]
        amounts, hours = [x[1] / 100 for x in own if x[1] is not None], [x[4].hour for x in own]
        assert (r.total_transactions, r.active_days) == (len(own), len({x[4].date() for x in own}))
        assert (r.distinct_currencies, r.distinct_counterparties) == (len({x[2] for x in own if x[2]}), len({x[3] for x in own}))
        assert (float(r.min_transaction_amount), float(r.max_transaction_amount)) == (min(amounts), max(amounts))
        for value, want in (
            (r.avg_transaction_amount, np.mean(amounts)), (r.stddev_transaction_amount, np.std(amounts, ddof=1)),
            (r.avg_transaction_hour, np.mean(hours)), (r.stddev_transaction_hour, np.std(hours, ddof=1)),
            (r.weekend_transaction_ratio, np.mean([x[4].weekday() >= 5 for x in own])),
            (r.median_transaction_amount, np.quantile(amounts, 0.5)), (r.large_transaction_threshold, np.quantile(amounts, 0.95)),
            (r.q1_amount, np.quantile(amounts, 0.25)), (r.q3_amount, np.quantile(amounts, 0.75)),
        ):
            assert abs(value - want) < 1e-9
    assert pay._counted(txns, 100, True)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert path not in pay.behavioural_profile(txns, as_of="2024-02-01")._jdf.queryExecution().executedPlan().toString()


def test_loan_fields_are_read_at_once(spark):
    """Odd documents keep their values; the fields come from one reading of the parsed document, not one each."""
    from tidemark.operators.loans import extract_flat

    texts = [
        '{"response": {"customer_name": "A", "loan_amount": "CHF 1,200,000", "credit_score": 700, "country": null, "loan_term_years": "x"}}',
        '{"response": {"customer_name": {"a": [1, "b"]}, "loan_amount": 12.50, "employment": true, "monthly_income": "1\\t0 0,0", "country": "None"}}',
        '{"response": {"Customer_Name": "B", "loan_amount": "EUR ABC 5", "purchase_price": "12.5", "rate_type": [], "property_type": ""}}',
        '{"response": null}', '{"response": "text"}', '{"response": [1]}', '{"other": 1}', "[]", "not json", None,
        '{"response": {"customer_name": "A", "customer_name": "B"}}', '{"response": {}}',
    ]
    df = spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "file_name string, extracted_data string")
    df = df.select("*", F.lit("2001-01-01 00:00:00").cast("timestamp_ntz").alias("file_timestamp"), F.current_date().alias("extraction_timestamp"))
    out = extract_flat(df)
    rows = {r.file_name: r for r in out.collect()}
    assert (rows["f0"].customer_name, rows["f0"].loan_amount, rows["f0"].credit_score, rows["f0"].country, rows["f0"].loan_term_years) == ("A", 1200000, 700, None, None)
    assert (rows["f1"].customer_name, rows["f1"].loan_amount, rows["f1"].employment, rows["f1"].monthly_income, rows["f1"].country) == ('{"a":[1,"b"]}', 13, "true", 1000, None)
    assert (rows["f2"].customer_name, rows["f2"].loan_amount, rows["f2"].purchase_price, rows["f2"].rate_type, rows["f2"].property_type) == (None, 5, 13, "[]", "")
    assert [rows[f"f{i}"].extraction_success for i in range(12)] == [True, True, True, True, True, True, False, False, False, False, False, True]
    assert all(rows[f"f{i}"].customer_name is None for i in range(2, 12))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get") <= 4


def test_applications_meet_the_view_in_many_tasks(spark, monkeypatch):
    """The rows of the join are many times its bytes, by which the adaptive planner would put it into one task."""
    monkeypatch.setattr(ln, "APPLICATIONS", 20, raising=False)
    kept = "full_name string, requires_sanctions_review boolean, requires_exposed_person_review boolean, overall_risk_rating string, vulnerable_customer_flag boolean, "
    kept += ", ".join(f"{x} string" for x in ("sanctions_match_name", "sanctions_authority", "sanctions_risk_score", "exposed_person_exact_match_name"))
    kept += ", " + ", ".join(f"exposed_person_{x} string" for x in ("exact_category", "exact_risk_level", "match_type"))
    view = spark.createDataFrame([(str(i % 50), *[None] * 12) for i in range(100)], f"customer_id string, {kept}")
    apps = spark.range(400).select(
        F.col("id").cast("string").alias("application_id"), (F.col("id") % 60).cast("string").alias("customer_id"), F.lit("CHE").alias("country"),
        F.lit(1).alias("requested_amount"), F.lit("APPROVED").alias("status"), F.lit(1).alias("application_date_time"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ln.loan_compliance_screening(apps, view)
        rows = out.select("customer_id", F.spark_partition_id().alias("part")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) == sum(2 if i % 60 < 50 else 1 for i in range(400)) and len({r.part for r in rows}) > 8
