"""The registered marts and queries over a `Workspace`."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import plain, rnd
from tidemark.operators import credit as cr
from tidemark.operators import customer as cu
from tidemark.operators import liquidity as lq
from tidemark.operators import loans as ln
from tidemark.operators import messages as ms
from tidemark.operators import metrics as mt
from tidemark.operators import payments as pay
from tidemark.operators import portfolio as pf
from tidemark.operators import quality as qu
from tidemark.operators import reports as rp
from tidemark.operators import screening as sc
from tidemark.operators import staff as st
from tidemark.operators import trades as tr
from tidemark.plans import lookups
from tidemark.plans.tables import AS_OF
from tidemark.plans.workspace import Workspace
from tidemark.sources.files import REASON, clean, file_catalogue, load_csv, parse_loose_json
from tidemark.sources.schemas import LANDING, LIQUIDITY_NULLS
from tidemark.sources.sinks import append_new, export_csv, run_in_order
from tidemark.sources.snapshots import SnapshotStore
from tidemark.sources.xml import load_xml
from tidemark.streaming.ingest import ingest_stream, ingested
from tidemark.streaming.refresh import Totals, refreshed, refresher

# the whole order history is the look-back: the given data ends with the as-of date
WINDOW = {"as_of": AS_OF, "lookback": 3650}

MARTS: dict[str, Callable[[Workspace], DataFrame]] = {}
QUERIES: dict[str, Callable[[Workspace], DataFrame]] = {}
#: Columns by which a mart is stored.
FOLDERS: dict[str, list[str]] = {}


def mart(name: str, build, show=None) -> None:
    """A result that other queries read; its own query reads the written table."""
    MARTS[name] = build
    QUERIES[name] = (lambda ws: show(ws[name])) if show else (lambda ws: ws[name])


def query(name: str, build) -> None:
    QUERIES[name] = build


def rounded(**digits: int):
    """Round statistics whose last bits depend on the order of summation."""
    return lambda df: df.withColumns({x: rnd(x, k) for x, k in digits.items()})


PEOPLE = ("customer_persons", "customer_screening")

# ---- customers --------------------------------------------------------------------------------
query("addresses_history", lambda w: cu.addresses_history(w["in_addresses"]))
query("customer_history", lambda w: cu.customer_history(w["in_customers"]))
mart("addresses_current", lambda w: cu.addresses_current(w["in_addresses"]))
mart("customer_current", lambda w: cu.customer_current(w["in_customers"]))
mart("customer_lifecycle", lambda w: cu.customer_lifecycle(*w("customer_current", "in_customer_events"), as_of=AS_OF))
MARTS["customer_persons"] = lambda w: cu.customer_persons(
    *w(
        "customer_current", "addresses_current", "in_customer_status", "in_accounts", "account_balances",
        "in_transactions", "in_assignments", "exposed_person_matches", "customer_lifecycle",
    ),
    as_of=AS_OF,
)
mart("customer_360", lambda w: cu.customer_view(*w(*PEOPLE), as_of=AS_OF, repeated=cu.repeated_entries(w["in_watch_list"])))
# readers that ask which kinds of hit a customer has
MARTS["customer_kinds"] = lambda w: cu.customer_kinds(*w(*PEOPLE), as_of=AS_OF)
query("customer_risk_profile", lambda w: cu.customer_risk_profile(w["customer_kinds"]))
query("screening_status", lambda w: cu.screening_status(w["customer_360"], as_of=AS_OF))
query("screening_alerts", lambda w: cu.screening_alerts(cu.screening_status(w["customer_360"], as_of=AS_OF)))

# ---- screening --------------------------------------------------------------------------------
SCREEN = ("customer_current", "addresses_current", "in_watch_list", "name_pairs", "alias_pairs")
for _name in ("name_pairs", "alias_pairs"):
    mart(_name, lambda w, f=getattr(sc, _name): f(*w("customer_current", "in_watch_list"), as_of=AS_OF))
mart("exposed_name_pairs", lambda w: sc.exposed_name_pairs(*w("customer_current", "in_exposed_persons")))
query("watch_list_enriched", lambda w: sc.watch_list_enriched(w["in_watch_list"], as_of=AS_OF))
for _kind in ("exact", "fuzzy", "alias"):
    query(f"name_match_{_kind}", lambda w, k=_kind: sc.name_matches(*w(*SCREEN), as_of=AS_OF, kind=k))
mart("customer_screening", lambda w: sc.customer_screening(*w(*SCREEN), as_of=AS_OF))
query("screening_summary", lambda w: sc.screening_summary(w["customer_screening"]))
query("high_risk_alerts", lambda w: sc.high_risk_alerts(w["customer_screening"]))
mart("exposed_person_matches", lambda w: sc.exposed_person_matches(*w("customer_current", "in_exposed_persons", "exposed_name_pairs")))

# ---- payments ---------------------------------------------------------------------------------
query("accounts_enriched", lambda w: pay.accounts_enriched(w["in_accounts"]))
mart("fx_enhanced", lambda w: pay.fx_enhanced(w["in_fx_rates"], as_of=AS_OF), rounded(volatility_30d=4))
mart(
    "behavioural_profile",
    lambda w: pay.behavioural_profile(w["in_transactions"], **WINDOW),
    rounded(
        stddev_transaction_amount=4, q1_amount=4, median_transaction_amount=4, q3_amount=4,
        large_transaction_threshold=4, stddev_transaction_hour=6,
    ),
)
mart(
    "transaction_anomalies",
    lambda w: pay.transaction_anomalies(
        *w("in_transactions", "in_accounts"), horizon=3650, profile=w["behavioural_profile"], **WINDOW
    ),
    rounded(median_transaction_amount=4),
)
mart(
    "account_balances",
    lambda w: pay.account_balances(
        pay.accounts_enriched(w["in_accounts"]), *w("in_transactions", "fx_enhanced"), **WINDOW
    ),
)
query(
    "customer_transaction_summary",
    lambda w: pay.customer_transaction_summary(*w("in_transactions", "in_accounts"), as_of=AS_OF),
)
for _name in (
    "daily_transaction_summary", "currency_exposure_current", "currency_exposure_history", "settlement_exposure",
    "settlement_analysis", "high_risk_patterns",
):
    query(_name, lambda w, f=getattr(pay, _name): f(w["transaction_anomalies"]))
mart("anomaly_analysis", lambda w: pay.anomaly_analysis(*w("customer_360", "transaction_anomalies")))
query("customer_summary", lambda w: pay.customer_summary(*w("customer_360", "in_accounts", "transaction_anomalies")))
query(
    "lifecycle_anomalies",
    lambda w: pay.lifecycle_anomalies(
        *w("customer_current", "in_customer_events", "transaction_anomalies", "in_accounts", "in_transactions")
    ),
)

# ---- trades and positions ---------------------------------------------------------------------
# positions are almost as many as trades, so they aren't stored: whoever reads a few of their columns aggregates only those
POSITIONS: dict[str, Callable[[Workspace], DataFrame]] = {
    "equity_positions": lambda w: tr.equity_positions(w["in_equity_trades"], as_of=AS_OF),
    "fi_positions": lambda w: tr.fi_positions(w["in_fi_trades"]),
    "cmd_positions": lambda w: tr.cmd_positions(w["in_cmd_trades"]),
}
for _name, _build in POSITIONS.items():
    query(_name, _build)


def _positions(w) -> list[DataFrame]:
    return [build(w) for build in POSITIONS.values()]


query("equity_trade_summary", lambda w: tr.equity_trade_summary(w["in_equity_trades"]))
query("equity_customer_activity", lambda w: tr.equity_customer_activity(w["in_equity_trades"], as_of=AS_OF))
query("fi_trade_summary", lambda w: tr.fi_trade_summary(w["in_fi_trades"], as_of=AS_OF))
query("fi_duration_analysis", lambda w: tr.fi_duration_analysis(w["in_fi_trades"], as_of=AS_OF))
query("fi_credit_exposure", lambda w: tr.fi_credit_exposure(w["in_fi_trades"]))
query("fi_yield_curve", lambda w: tr.fi_yield_curve(w["in_fi_trades"], as_of=AS_OF))
query("cmd_trade_summary", lambda w: tr.cmd_trade_summary(w["in_cmd_trades"]))
for _name in ("cmd_delta_exposure", "cmd_volatility", "cmd_delivery_schedule"):
    query(_name, lambda w, f=getattr(tr, _name): f(w["in_cmd_trades"]))
query("equity_summary", lambda w: tr.equity_summary(*w("in_equity_trades", "in_accounts")))
for _name in ("equity_positions_by_security", "equity_currency_exposure", "high_value_equity_trades"):
    query(_name, lambda w, f=getattr(tr, _name): f(w["in_equity_trades"]))
mart(
    "portfolio_performance",
    lambda w: pf.portfolio_performance(
        *w("in_transactions", "in_equity_trades", "in_fi_trades", "in_cmd_trades", "account_balances"),
        *_positions(w),
        w["in_accounts"],
        as_of=AS_OF,
        lookback=1500,
    ),
)

# ---- liquidity --------------------------------------------------------------------------------
LAST_LIQUIDITY_DAY, NEXT_DAY = "2001-11-04", "2001-11-05"


def _assets(w):
    return w["in_hqla_holdings"], lookups.hqla_eligibility(w.spark)


def _funding(w):
    return w["in_deposits"], lookups.deposit_types(w.spark)


def _alert_text(df):
    """Arrays of structs as text, so every consumer can compare them."""
    text = F.transform("all_alerts", lambda x: F.concat_ws("/", x["severity"], x["type"], x["message"], x["action"]))
    return df.withColumn("all_alerts", F.array_join(text, "; "))


query("hqla_holdings_detail", lambda w: lq.hqla_holdings_detail(*_assets(w)).drop("is_active"))
query("deposit_balances_detail", lambda w: lq.deposit_balances_detail(*_funding(w)))
mart("lcr_hqla", lambda w: lq.lcr_hqla(*_assets(w)))
mart("lcr_outflow", lambda w: lq.lcr_outflow(*_funding(w)))
query("hqla_calculation", lambda w: lq.hqla_calculation(*_assets(w)))
query("outflow_calculation", lambda w: lq.outflow_calculation(*_funding(w)))
mart("lcr_daily", lambda w: lq.lcr_daily(lq.hqla_calculation(*_assets(w)), lq.outflow_calculation(*_funding(w)), "BANK-1"))
query("lcr_trend", lambda w: lq.lcr_trend(w["lcr_daily"]))
query("lcr_monthly_summary", lambda w: lq.lcr_monthly_summary(w["lcr_daily"]))
query(
    "lcr_monitoring",
    lambda w: lq.lcr_monitoring(
        w["lcr_daily"],
        lq.lcr_trend(w["lcr_daily"]),
        lq.hqla_holdings_detail(*_assets(w)),
        lq.deposit_balances_detail(*_funding(w)),
    ),
)
query("lcr_alerts", lambda w: _alert_text(lq.lcr_alerts(w["lcr_daily"], lq.lcr_trend(w["lcr_daily"]))))
query("lcr_current", lambda w: lq.lcr_current(w["lcr_daily"]))
query("hqla_breakdown", lambda w: lq.hqla_breakdown(*w("lcr_hqla", "lcr_daily")))
query("outflow_breakdown", lambda w: lq.outflow_breakdown(*w("lcr_outflow", "lcr_daily")))
query("lcr_trend_90day", lambda w: lq.lcr_trend_90day(w["lcr_daily"], as_of=LAST_LIQUIDITY_DAY))
query(
    "alerts_active",
    lambda w: lq.alerts_active(lq.lcr_alerts(w["lcr_daily"], lq.lcr_trend(w["lcr_daily"])), as_of=NEXT_DAY),
)

# ---- risk -------------------------------------------------------------------------------------
mart(
    "irb_customer_ratings",
    lambda w: cr.irb_customer_ratings(*w("customer_360", "anomaly_analysis", "account_balances"), as_of=AS_OF),
)
query("irb_portfolio_metrics", lambda w: cr.irb_portfolio_metrics(w["irb_customer_ratings"], as_of=AS_OF))
query(
    "irb_rwa_summary",
    lambda w: cr.irb_rwa_summary(cr.irb_portfolio_metrics(w["irb_customer_ratings"], as_of=AS_OF), as_of=AS_OF),
)


# days whose ratings are stored; trends compare the two latest
RATED_DAYS = tuple((date.fromisoformat(AS_OF) - timedelta(days=x)).isoformat() for x in (90, 1, 0))


def _ratings_on(w, day: str) -> DataFrame:
    """Ratings from what was booked up to the end of a day."""
    if day == AS_OF:
        return w["irb_customer_ratings"]
    booked = F.col("booking_date") < F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz")
    scored, txns = (df.where(booked) for df in w("transaction_anomalies", "in_transactions"))
    balances = pay.account_balances(
        pay.accounts_enriched(w["in_accounts"]), txns, w["fx_enhanced"], as_of=day, lookback=WINDOW["lookback"]
    )
    view = w["customer_360"]
    return cr.irb_customer_ratings(view, pay.anomaly_analysis(view, scored), balances, as_of=day)


def _rating_snapshots(w) -> SnapshotStore:
    """The stored ratings; days that aren't stored yet are added."""
    store = SnapshotStore(w.spark, f"{w.root}/snapshots/ratings", "effective_date")
    stored = {d.isoformat() for d in store.dates()}
    for day in RATED_DAYS:
        if day not in stored:
            store.add(cr.rating_history(_ratings_on(w, day)), day)
    return store


query("rating_history", lambda w: _rating_snapshots(w).read())
query("irb_risk_trends", lambda w: cr.irb_risk_trends(w["irb_customer_ratings"], _rating_snapshots(w).latest(2, AS_OF), as_of=AS_OF))


def _risk_positions(w) -> DataFrame:
    return cr.frtb_risk_positions(*_positions(w))


query("frtb_risk_positions", _risk_positions)
query("frtb_sensitivities", lambda w: cr.frtb_sensitivities(_risk_positions(w)))
query("frtb_capital_charges", lambda w: cr.frtb_capital_charges(cr.frtb_sensitivities(_risk_positions(w))))
query("frtb_nmrf", lambda w: cr.frtb_nmrf(_risk_positions(w)))
mart(
    "risk_aggregation",
    lambda w: cr.risk_aggregation(
        w["irb_customer_ratings"],
        _risk_positions(w),
        w["anomaly_analysis"],
        pay.currency_exposure_current(w["transaction_anomalies"]),
        as_of=AS_OF,
    ),
    rounded(exposure_volatility_chf=0),
)
query("executive_dashboard", lambda w: rounded(risk_volatility_score=0)(cr.executive_dashboard(w["risk_aggregation"])))
query("regulatory_reporting", lambda w: cr.regulatory_reporting(w["risk_aggregation"], as_of=AS_OF))
query("risk_concentration", lambda w: cr.risk_concentration(w["risk_aggregation"], floor=0.001))
query("risk_limits", lambda w: cr.risk_limits(w["risk_aggregation"], as_of=AS_OF))

# ---- staff ------------------------------------------------------------------------------------
STAFF = ("in_employees", "in_assignments")
query("hierarchy", lambda w: st.hierarchy(w["in_employees"]))
query("organizational_chart", lambda w: st.organizational_chart(*w(*STAFF), as_of=AS_OF))
mart("advisor_performance", lambda w: st.advisor_performance(*w(*STAFF, "customer_360"), as_of=AS_OF))
query("advisors", lambda w: st.advisors(w["advisor_performance"]))
query("portfolio_by_advisor", lambda w: st.portfolio_by_advisor(*w("in_assignments", "in_employees", "customer_360")))
mart("team_leader_dashboard", lambda w: st.team_leader_dashboard(*w(*STAFF, "customer_360")))
query(
    "current_assignments",
    lambda w: st.current_assignments(
        *w("in_assignments", "customer_current", "in_employees", "customer_360"), as_of=AS_OF
    ),
)
query(
    "assignment_history",
    lambda w: st.assignment_history(*w("in_assignments", "customer_current", "in_employees"), as_of=AS_OF),
)
query("workload_distribution", lambda w: st.workload_distribution(*w(*STAFF)))

# ---- loans ------------------------------------------------------------------------------------
mart("extract_flat", lambda w: ln.extract_flat(w["in_loan_extracts"]))
mart("build_applications", lambda w: ln.build_applications(*w("extract_flat", "customer_360"), lookups.products(w.spark)))
mart("build_collateral", lambda w: ln.build_collateral(w["extract_flat"]))
mart("build_affordability", lambda w: ln.build_affordability(*w("extract_flat", "build_applications"), lookups.country_regimes(w.spark)))
mart("build_collateral_link", lambda w: ln.build_collateral_link(*w("extract_flat", "build_applications", "build_collateral")))
mart("loan_portfolio_summary", lambda w: ln.loan_portfolio_summary(w["build_applications"], lookups.products(w.spark), as_of=AS_OF))
PLEDGED = ("build_applications", "build_collateral_link", "build_collateral")
mart("ltv_distribution", lambda w: ln.ltv_distribution(*w(*PLEDGED), as_of=AS_OF))
mart("application_funnel", lambda w: ln.application_funnel(w["build_applications"], lookups.products(w.spark), as_of=AS_OF))
mart("affordability_summary", lambda w: ln.affordability_summary(*w("build_affordability", "build_applications"), as_of=AS_OF))
mart("customer_loan_summary", lambda w: ln.customer_loan_summary(*w(*PLEDGED, "build_affordability")))
LOAN_REPORTS = ("loan_portfolio_summary", "ltv_distribution", "application_funnel", "affordability_summary")
query("loan_portfolio_current", lambda w: ln.loan_portfolio_current(*w(*LOAN_REPORTS), as_of=AS_OF))
query(
    "ltv_distribution_current",
    lambda w: ln.current_date_view(w["ltv_distribution"], ["ltv_bucket_sort_order"], as_of=AS_OF),
)
query(
    "application_funnel_current",
    lambda w: ln.current_date_view(w["application_funnel"], [F.desc("total_applications")], as_of=AS_OF),
)
query(
    "affordability_current",
    lambda w: ln.current_date_view(w["affordability_summary"], ["country", "affordability_result"], as_of=AS_OF),
)
query("loan_compliance_screening", lambda w: ln.loan_compliance_screening(*w("build_applications", "customer_360")))
query("loan_eligibility", lambda w: ln.loan_eligibility(w["customers_once"], as_of=AS_OF))
query("loan_compliance_status", lambda w: ln.loan_compliance_status(*w("customer_kinds", "customer_screening"), as_of=AS_OF))
TEXT_FIELDS = {
    "email": "([A-Za-z0-9._]+@[A-Za-z0-9]+[.][A-Za-z.]+)",
    "first_date": "([0-9]{4}-[0-9]{2}-[0-9]{2})",
    "dotted_number": "([0-9]+[.][0-9]+[.][0-9]+[.][0-9]+)",
}
query(
    "extract_from_text",
    lambda w: ln.extract_from_text(w["documents"], TEXT_FIELDS).select("doc_id", *TEXT_FIELDS),
)

# ---- messages ---------------------------------------------------------------------------------
MARTS["messages_by_kind"] = lambda w: ms.tagged(w["in_messages"])
FOLDERS["messages_by_kind"] = [ms.KIND]
mart("credit_transfers", lambda w: ms.credit_transfers(w["messages_by_kind"]))
mart("status_reports", lambda w: ms.status_reports(w["messages_by_kind"]))
query("payment_lifecycle", lambda w: ms.payment_lifecycle(*w("credit_transfers", "status_reports")))

# ---- sources and sinks: tables go out as files and come back through the loaders ---------------


def _as_files(w, table: str, layout: str, name: str, reverse: bool = False) -> str:
    """Write a table as CSV in the declared layout (or reversed, for matching by name)."""
    path, df = w.path(name), w[table]
    names = [f.split()[0] for f in LANDING[layout].replace("\n", " ").split(", ")]
    cols = [F.col(x) if x in df.columns else F.lit(None).cast("string").alias(x) for x in names]
    export_csv(df.select(*(reversed(cols) if reverse else cols)), path)
    return path


def _csv_load(w):
    path = _as_files(w, "in_transactions", "transactions", "csv_transactions")
    return load_csv(w.spark, path, LANDING["transactions"], required=["transaction_id"]).rows.drop("_source_file")


def _csv_by_name(w):
    path = _as_files(w, "in_accounts", "accounts", "csv_accounts", reverse=True)
    return load_csv(w.spark, path, LANDING["accounts"], by_name=True).rows.drop("_source_file")


def _csv_null_tokens(w):
    path, df = w.path("csv_addresses"), w["in_addresses"].drop("version_id")
    export_csv(df.withColumn("state", F.coalesce("state", F.lit("NULL"))), path)
    rows = load_csv(w.spark, path, LANDING["addresses"], null_values=LIQUIDITY_NULLS).rows.drop("_source_file")
    return clean(rows, blank_to_null=["street_address", "city"], default_now=["insert_timestamp_utc"])


def _stream_ingest(w):
    source = _as_files(w, "in_transactions", "transactions", "stream_source")
    sink, checkpoint = w.path("stream_sink"), w.path("stream_checkpoint")
    ingest_stream(w.spark, source, LANDING["transactions"], sink, checkpoint, max_files=2).awaitTermination()
    return ingested(w.spark, sink)


#: What an ingest of payments keeps up to date.
ACCOUNT_TOTALS = Totals(
    keys={"account_id": "account_id"},
    sums={"balance": "base_amount"},
    counts={"payments": True, "credits": "base_amount > 0", "debits": "base_amount < 0"},
    least={"first_booking": "booking_date"},
    greatest={"last_booking": "booking_date", "largest": "base_amount"},
)
DAILY_TOTALS = Totals(
    keys={"booking_day": "CAST(booking_date AS DATE)", "currency": "currency"},
    sums={"amount": "amount"},
    counts={"payments": True},
    greatest={"largest": "amount"},
)


def _stream_totals(w, name: str) -> DataFrame:
    """Totals that follow the ingest batch by batch; the first batch is refreshed twice, as after a failure."""
    source = _as_files(w, "in_transactions", "transactions", f"{name}_source")
    sink, checkpoint = w.path(f"{name}_sink"), w.path(f"{name}_checkpoint")
    totals = ACCOUNT_TOTALS if name == "stream_account_totals" else DAILY_TOTALS
    kept = w.path(name)
    refresh = refresher({kept: totals})

    def again(rows: DataFrame, number: int) -> None:
        refresh(rows, number)
        if number == 0:
            refresh(rows, number)

    ingest_stream(
        w.spark, source, LANDING["transactions"], sink, checkpoint, max_files=1, refresh=again
    ).awaitTermination()
    return refreshed(w.spark, kept, totals)


def _insert_if_absent(w):
    path, df = w.path("insert_target"), w["in_transactions"].select("transaction_id", "account_id")
    append_new(w.spark, path, df.where("account_id < '5'"), ["transaction_id"])
    append_new(w.spark, path, df, ["transaction_id"])
    return w.spark.read.parquet(path)


def _ordered_load(w):
    """Accounts first, then the payments of accounts that have arrived."""
    accounts, payments = w.path("ordered_accounts"), w.path("ordered_payments")

    def load_payments():
        arrived = w.spark.read.parquet(accounts).select("account_id")
        rows = w["in_transactions"].select("transaction_id", "account_id")
        append_new(w.spark, payments, rows.join(arrived, "account_id", "left_semi"), ["transaction_id"])

    run_in_order(lambda: append_new(w.spark, accounts, w["in_accounts"].where("account_type <> 'SAVINGS'"), ["account_id"]), load_payments)
    return w.spark.read.parquet(payments)


def _xml_load(w):
    """All messages in files of many, every seventh broken; each is either read or rejected."""
    path, n = w.path("xml_messages"), F.regexp_extract("file_name", r"_(\d+)", 1).cast("long")
    broken = F.when(n % 7 == 3, F.replace("raw_xml", F.lit("</MsgId>"), F.lit("")))
    # the texts are many times as large as the tables; a task's file is bounded, so it needn't be split
    w["in_messages"].select(F.coalesce(broken, F.col("raw_xml"))).write.option("compression", "gzip").text(path)
    body = f"{ms.KINDS['pacs008']}: STRUCT<{ms.TRANSFER}>, {ms.KINDS['pacs002']}: STRUCT<{ms.STATUS}>"
    loaded = load_xml(w.spark, path, "Document", body)
    head = [F.col(f"msg.{root}.GrpHdr.MsgId") for root in ms.KINDS.values()]
    count = F.coalesce(*(F.size(f"msg.{ms.KINDS[kind]}.{items}") for kind, items in (("pacs008", "CdtTrfTxInf"), ("pacs002", "TxInfAndSts"))))
    lost = F.regexp_extract("raw_xml", "<MsgId>([^<]*)", 1)
    good = F.col(REASON).isNull()
    return loaded.both.select(
        F.when(good, F.coalesce(*head)).otherwise(lost).alias("message_id"), F.when(good, count).alias("entries"), F.col(REASON).alias("reason")
    )


def _list_files(w):
    """Folder and header of the account files, a folder for each type."""
    path = w.path("account_files")
    w["in_accounts"].select("account_type", "account_id", "customer_id", "status").write.partitionBy("account_type").option("header", "true").csv(path)
    found = file_catalogue(w.spark, path, "%.csv", "account_type=%")
    folder = F.element_at(F.split("relative_path", "/"), 1)
    return found.where("size > 0 AND last_modified IS NOT NULL").select(folder.alias("folder"), "header").distinct()


query("xml_load", _xml_load)
query("list_files", _list_files)
query("csv_load", _csv_load)
query("csv_load_by_name", _csv_by_name)
query("csv_load_null_tokens", _csv_null_tokens)
query("stream_ingest", _stream_ingest)
for _name in ("stream_account_totals", "stream_daily_totals"):
    query(_name, lambda w, n=_name: _stream_totals(w, n))
query("insert_if_absent", _insert_if_absent)
query("ordered_load", _ordered_load)
query(
    "loose_json",
    lambda w: w["events"].select(
        "event_id",
        F.try_variant_get(parse_loose_json(F.replace("props", F.lit('"'), F.lit("'"))), "$.k", "int").alias("k"),
    ),
)

# ---- metric models, quality ---------------------------------------------------------------------
mart("customers_once", lambda w: cu.customers_once(*w(*PEOPLE), as_of=AS_OF))
del QUERIES["customers_once"]


def _table(w):
    def find(name: str) -> DataFrame:
        if name == "customers":
            return w["customers_once"]
        return w[name] if name in MARTS else QUERIES[name](w)

    return find


MODEL_QUERIES = {
    "customer_360": ["country", "region"],
    "employee_advisor": ["region"],
    "compliance_monitoring": ["currency", "account_tier"],
    "wealth_management": ["portfolio_type", "country"],
    "risk_reporting": ["risk_type"],
    "lcr_current": ["compliance_status", "buffer_strength", "lcr_ratio_pct"],
    "hqla_breakdown": ["asset_level", "asset_type"],
    "outflow_breakdown": ["counterparty_type", "account_count"],
    "lcr_trend": ["reporting_date", "lcr_ratio_pct", "compliance_status"],
    "lcr_alerts": ["alert_type", "severity", "alert_category"],
    "loan_portfolio": ["country", "application_status", "loan_count"],
    "loan_ltv": ["ltv_bucket", "loan_count"],
    "loan_funnel": ["country", "channel", "total_applications"],
    "loan_affordability": ["country", "affordability_result", "assessment_count"],
    "loan_compliance": ["compliance_status", "application_status", "country"],
}
for _model, _dims in MODEL_QUERIES.items():
    query(
        f"metrics_{_model}",
        lambda w, m=_model, d=tuple(_dims): mt.metric_query(m, _table(w), metrics=list(mt.MODELS[m].metrics), dims=list(d)),
    )
query("wealth_detailed", lambda w: mt.wealth_detailed(*w("portfolio_performance", "customer_kinds")))
query(
    "quality_report",
    lambda w: qu.quality_report(
        w["in_customers"],
        keys=["customer_id"],
        required=["customer_id", "first_name", "email", "phone"],
        domains={
            "risk_classification": ["LOW", "MEDIUM", "HIGH"],
            "birth": F.col("date_of_birth") < F.col("onboarding_date"),
        },
        freshness_col="insert_timestamp_utc",
        as_of=AS_OF,
        name="customer",
    ),
)
query("customer_completeness", lambda w: qu.customer_completeness(w["customer_current"]))

# ---- reports ------------------------------------------------------------------------------------
VIEW, SCORED, PERF = "customer_360", "transaction_anomalies", "portfolio_performance"
ONCE = "customers_once"  # the view with the strongest match of each customer
query("quarterly_alerts", lambda w: rp.quarterly_alerts(*w("in_transactions", SCORED, VIEW)))
query("alert_backlog", lambda w: rp.alert_backlog(*w(SCORED, VIEW), as_of=AS_OF))
query("risk_heatmap", lambda w: rp.risk_heatmap(*w("in_transactions", SCORED, "in_accounts", VIEW)))
query(
    "sanctions_universe",
    lambda w: rp.sanctions_universe(*w(SCORED, VIEW, "in_watch_list", "customer_screening"), as_of=AS_OF),
)
query("sanctions_hits", lambda w: rp.sanctions_hits(w["customer_screening"]))
query("sanctions_quality", lambda w: rp.sanctions_quality(w["customer_screening"]))
query("sanctions_alerts", lambda w: rp.sanctions_alerts(QUERIES["high_risk_alerts"](w)))
for _part in ("profile", "risk_versions", "addresses"):
    query(
        f"kyc_audit_{_part}",
        lambda w, p=_part: rp.kyc_audit_trail(
            w[VIEW], QUERIES["customer_history"](w), QUERIES["addresses_history"](w), "7", as_of=AS_OF
        )[p],
    )
query("kyc_overdue", lambda w: rp.kyc_overdue(w[ONCE], as_of=AS_OF))
query("screening_alert_aging", lambda w: rp.screening_alert_aging(w[ONCE], as_of=AS_OF))
query("advisor_list", lambda w: rp.advisor_list(w["advisor_performance"]))
query("hiring_need", lambda w: rp.hiring_need(st.workload_distribution(*w(*STAFF))))
query("advisor_revenue", lambda w: rp.advisor_revenue(QUERIES["portfolio_by_advisor"](w), w["advisor_performance"]))
query("relationship_list", lambda w: rp.relationship_list(QUERIES["current_assignments"](w)))
query("credit_overview", lambda w: rp.credit_overview(w[VIEW]))
query("npl_report", lambda w: rp.npl_report(w["irb_customer_ratings"]))
query("basel_report", lambda w: rp.basel_report(QUERIES["irb_rwa_summary"](w)))
query("rating_distribution", lambda w: rp.rating_distribution(QUERIES["irb_portfolio_metrics"](w)))
for _name in ("top_performers", "risk_adjusted", "asset_allocation", "fee_report"):
    query(_name, lambda w, f=getattr(rp, _name): f(*w(PERF, VIEW)))
query("wealth_segments", lambda w: rp.wealth_segments(w[VIEW], as_of=AS_OF))
for _name in (
    "risk_distribution", "tier_distribution", "country_distribution", "lifecycle_summary", "high_risk_customers",
    "lending_portfolio", "revenue_at_risk", "kyc_completeness", "contact_quality", "compliance_summary",
):
    query(_name, lambda w, f=getattr(rp, _name): f(w[ONCE]))
query("pep_match_summary", lambda w: rp.match_summary(w[ONCE], "exposed_person"))
query("sanctions_match_summary", lambda w: rp.match_summary(w[ONCE], "sanctions"))
query("pep_matches", lambda w: rp.match_list(w[VIEW], "exposed_person"))
query("sanctions_matches", lambda w: rp.match_list(w[VIEW], "sanctions"))
# thresholds below the defaults, because the given tables hold few inactive customers
query("high_churn_customers", lambda w: rp.high_churn_customers(w[ONCE], above_pct=20))
query("premium_at_risk", lambda w: rp.premium_at_risk(w[ONCE], above_pct=20))
query("dormant_customers", lambda w: rp.dormant_customers(w[ONCE], min_days=10))
query("newest_alerts", lambda w: rounded(median_transaction_amount=4)(rp.newest_alerts(w[SCORED])))
query("aml_metrics", lambda w: rp.aml_metrics(w[SCORED], as_of=AS_OF))
query("lcr_trend_page", lambda w: rp.lcr_trend_page(lq.lcr_trend(w["lcr_daily"]), as_of=LAST_LIQUIDITY_DAY))
query("hqla_page", lambda w: rp.hqla_page(lq.hqla_holdings_detail(*_assets(w))))
query("deposit_page", lambda w: rp.deposit_page(lq.deposit_balances_detail(*_funding(w))))
query("lcr_alert_page", lambda w: rp.lcr_alert_page(lq.lcr_alerts(w["lcr_daily"], lq.lcr_trend(w["lcr_daily"]))))
query("lcr_monthly_page", lambda w: rp.lcr_monthly_page(lq.lcr_monthly_summary(w["lcr_daily"])))
query("loan_compliance_page", lambda w: rp.loan_compliance_page(QUERIES["loan_compliance_screening"](w)))
query("analysis_period", lambda w: rp.analysis_period(w["in_transactions"]))
query("filings_by_country", lambda w: rp.filings_by_country(*w(SCORED, VIEW)))
query("advisor_capacity", lambda w: rp.advisor_capacity(w["advisor_performance"]))
query("wealth_portfolios", lambda w: rp.wealth_portfolios(w["advisor_performance"]))
query("team_report", lambda w: rp.team_report(w["team_leader_dashboard"]))
query("lcr_status_page", lambda w: rp.lcr_status_page(w["lcr_daily"]))
query("loan_portfolio_page", lambda w: rp.loan_pages(w["loan_portfolio_summary"], "total_requested_amount", as_of=AS_OF))
query("loan_ltv_page", lambda w: rp.loan_pages(w["ltv_distribution"], "ltv_bucket_sort_order", as_of=AS_OF, descending=False))
query("loan_funnel_page", lambda w: rp.loan_pages(w["application_funnel"], "total_applications", as_of=AS_OF))
query("loan_affordability_page", lambda w: rp.loan_pages(w["affordability_summary"], "country", as_of=AS_OF, descending=False))
query("loan_customer_page", lambda w: rp.loan_customer_page(*w("customer_loan_summary", ONCE)))


def registered() -> dict[str, Callable]:
    """name -> callable(spark, sf_dir) for every query."""

    def bind(build):
        return lambda spark, sf_dir: plain(build(Workspace.of(spark, sf_dir, MARTS, FOLDERS)))

    return {name: bind(build) for name, build in QUERIES.items()}
