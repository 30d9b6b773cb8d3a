"""Loan applications from extracted documents, affordability, collateral, and loan reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import (
    as_date, at_most, attach_total, c, days, dbl, flag, ladder, mean, on_date, pct, ratio, rnd, sum_if,
    years_crossed,
)
from tidemark.functions.spread import latest

EMPTY_MARKS = ("None", "null")
SUFFIX = "_internal.txt"

# fixed values: spellings of a country, its currency
COUNTRY_NAMES = {
    "CHE": ("Switzerland", "Swiss", "CHE"),
    "GBR": ("UK", "United Kingdom", "GBR", "Britain"),
    "DEU": ("Germany", "DEU", "Deutschland"),
    "FRA": ("France", "FRA"),
    "PRT": ("Portugal", "PRT"),
    "ITA": ("Italy", "ITA"),
    "ESP": ("Spain", "ESP"),
}
PRODUCT_NAMES = {"CHE": ("Switzerland", "Swiss", "CHE"), "GBR": ("UK", "United Kingdom", "GBR"), "DEU": ("Germany", "DEU")}
CURRENCY_NAMES = {
    "CHF": ("Switzerland", "Swiss", "CHE"),
    "GBP": ("UK", "United Kingdom", "GBR", "Britain"),
    "EUR": ("Germany", "DEU", "France", "FRA", "Italy", "ITA", "Spain", "ESP", "Portugal", "PRT"),
}
# fixed values for countries without a regime of their own: limit, rate shown, rate used
OTHER_LIMIT, OTHER_SHOWN, OTHER_USED = 0.40, "0.05", "0.045"


def _known(country, table: dict, default: str) -> Column:
    return ladder([(c(country).isin(*names), code) for code, names in table.items()], default)


def _text(value: Column) -> Column:
    return F.when(~value.isin(*EMPTY_MARKS), value)


def _number(text: Column) -> Column:
    """Whole number from text such as 'CHF 1,200,000'; null when it is not one."""
    bare = F.translate(F.regexp_replace(text, "[A-Z]{3}", ""), ", \t\n\x0b\f\r", "")
    return bare.try_cast("decimal(38,0)")


def _sum_of(text: Column) -> Column:
    return _number(text).cast("decimal(18,2)")


def extract_flat(extracts: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Extracted documents as one typed row each, skipping those already flattened.

    The JSON is parsed once per row into a variant, and all fields are read from it at once, as texts.
    """
    df = extracts
    if existing is not None:
        keys = ["file_name", "extraction_timestamp"]
        df = df.join(existing.select(*keys).distinct(), keys, "left_anti")
    names = ["document_type", "customer_name", "employment", "property_address", "property_type", "rate_type", "country"]
    sums = ["monthly_income", "existing_debts_monthly", "purchase_price", "loan_amount", "down_payment"]
    wholes = ["employment_tenure_years", "credit_score", "loan_term_years"]
    shape = ", ".join(f"{x}: STRING" for x in (*names, *sums, *wholes))
    # one-element explodes keep the optimizer from repeating the parse, the reading and the marks for every field
    df = df.withColumn("_doc", F.explode(F.array(F.try_parse_json("extracted_data"))))
    read = F.try_variant_get("_doc", "$.response", f"STRUCT<{shape}>")
    there = F.try_variant_get("_doc", "$.response", "variant").isNotNull()
    df = df.withColumn("_read", F.explode(F.array(F.struct(there.alias("there"), read.alias("fields")))))

    def text(field: str) -> Column:
        return _text(F.col(f"_read.fields.{field}"))

    flat = df.select(
        "file_name",
        "file_timestamp",
        "extraction_timestamp",
        *[text(x).alias(x) for x in names],
        *[_number(text(x)).cast("int").alias(x) for x in wholes],
        *[_sum_of(text(x)).alias(x) for x in sums],
        F.col("_read.there").alias("extraction_success"),
    )
    return flat.withColumns(
        {
            "ltv_ratio_pct": F.when(F.col("purchase_price") > 0, rnd(ratio("loan_amount", "purchase_price") * 100)),
            "dti_ratio_pct": F.when(F.col("monthly_income") > 0, rnd(ratio("existing_debts_monthly", "monthly_income") * 100)),
        }
    )


def extract_from_text(docs: DataFrame, patterns: dict[str, str], text: str = "text") -> DataFrame:
    """Named fields from free text by pattern: first capture, or null.  Whole texts are searched."""

    def first(pattern: str) -> Column:
        found = F.regexp_extract(c(text), pattern, 1)
        return F.when(found != "", found)

    return docs.withColumns({name: first(p) for name, p in patterns.items()})


def _stem() -> Column:
    return F.replace(F.col("file_name"), F.lit(SUFFIX), F.lit(""))


def _new(df: DataFrame, key: str, existing: DataFrame | None) -> DataFrame:
    return df if existing is None else df.join(existing.select(key).distinct(), key, "left_anti")


def build_applications(
    flat: DataFrame, customer_view: DataFrame, products: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """One application per document: matched customer, product of the country, first decision.

    ``products`` is the catalogue, so its first mortgage per country is found before the join and
    no document fans out over products.  If several customers share the name, the smallest
    identifier is taken and ``customer_matches`` tells how many there are.
    """
    first_product = (
        products.where((F.col("product_type") == "MORTGAGE") & F.col("is_active"))
        .groupBy(F.col("country").alias("_product_country"))
        .agg(F.min("product_id").alias("product_id"))
    )
    # the view repeats a customer for each match
    people = customer_view.select("customer_id", "full_name", "first_name", "family_name").distinct()
    by_name = (
        people.select("customer_id", F.upper(F.trim("full_name")).alias("_name"))
        .unionByName(
            people.select("customer_id", F.upper(F.trim(F.concat_ws(" ", "first_name", "family_name"))).alias("_name"))
        )
        .groupBy("_name")
        .agg(F.min("customer_id").alias("customer_id"), F.countDistinct("customer_id").alias("_matches"))
    )
    ltv, score, dti = F.col("ltv_ratio_pct"), F.col("credit_score"), F.col("dti_ratio_pct")
    status = ladder(
        [
            ((ltv > 90) | (score < 600), "DECLINED"),
            ((ltv > 85) | (score < 650) | (dti > 45), "UNDER_REVIEW"),
        ],
        "APPROVED",
    )
    usable = flat.where(flag(F.col("extraction_success")) & (F.col("loan_amount") > 0))
    df = (
        latest(usable, ["file_name"], ["extraction_timestamp"])
        .withColumns(
            {
                "application_id": F.concat(F.lit("APP_"), _stem()),
                # documents without a name get a key of their own, so they do not pile up in one task
                "_name": F.coalesce(F.upper(F.trim("customer_name")), F.concat(F.lit("\u0000"), "file_name")),
                "_product_country": _known("country", PRODUCT_NAMES, "CHE"),
            }
        )
    )
    return (
        _new(df, "application_id", existing)
        .join(by_name, "_name", "left")
        .join(first_product, "_product_country", "left")
        .select(
            "application_id",
            "customer_id",
            F.coalesce("_matches", F.lit(0).cast("long")).alias("customer_matches"),
            F.col("file_timestamp").alias("application_date_time"),
            F.lit("EMAIL").alias("channel"),
            _known("country", COUNTRY_NAMES, "CHE").alias("country"),
            "product_id",
            F.col("loan_amount").alias("requested_amount"),
            (F.col("loan_term_years") * 12).alias("requested_term_months"),
            _known("country", CURRENCY_NAMES, "CHF").alias("requested_currency"),
            F.lit("PURCHASE_PRIMARY_RESIDENCE").alias("purpose"),
            status.alias("status"),
        )
    )


def build_collateral(flat: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    df = flat.where(
        flag(F.col("extraction_success")) & F.col("property_address").isNotNull() & (F.col("purchase_price") > 0)
    ).select(
        F.concat(F.lit("COLL_"), _stem()).alias("collateral_id"),
        "property_address",
        F.coalesce("property_type", F.lit("Unknown")).alias("property_type"),
        F.lit("OWNER_OCCUPIED").alias("occupancy_type"),
        F.col("purchase_price").alias("valuation_value"),
        as_date("file_timestamp").alias("valuation_date"),
        F.lit("AVM").alias("valuation_method"),
    )
    return _new(df, "collateral_id", existing)


def build_affordability(
    flat: DataFrame, applications: DataFrame, regimes: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Debt-to-income and debt-service ratios against the limit of the country's regime."""
    income, debts, loan = dbl("monthly_income"), dbl(F.coalesce("existing_debts_monthly", F.lit(0))), dbl("loan_amount")
    dsti = F.try_divide(F.try_divide(loan, dbl(F.col("loan_term_years") * 12)) + debts, income)
    own_rate = F.col("affordability_imputed_rate")
    stress = F.coalesce(own_rate, F.lit(OTHER_SHOWN).cast("decimal(5,4)"))
    payment_rate = dbl(F.coalesce(own_rate, F.lit(OTHER_USED).cast("decimal(5,4)")))
    limit = F.coalesce(dbl("affordability_limit"), F.lit(OTHER_LIMIT))
    who = applications.select("application_id", "customer_id", F.col("country").alias("_home"))
    df = (
        flat.where(flag(F.col("extraction_success")) & (F.col("monthly_income") > 0) & F.col("loan_amount").isNotNull())
        .withColumns(
            {
                "affordability_id": F.concat(F.lit("AFF_"), _stem()),
                "application_id": F.concat(F.lit("APP_"), _stem()),
            }
        )
        .join(who, "application_id")
        .join(regimes.withColumnRenamed("country_code", "_home"), "_home", "left")
    )
    return _new(df, "affordability_id", existing).select(
        "affordability_id",
        "application_id",
        "customer_id",
        F.col("monthly_income").alias("gross_income_monthly"),
        F.coalesce("existing_debts_monthly", F.lit(0).cast("decimal(18,2)")).alias("total_debt_obligations_monthly"),
        rnd(F.try_divide(debts, income), 3).alias("dti_ratio"),
        rnd(dsti, 3).alias("dsti_ratio"),
        F.when(dsti <= limit, "PASS").otherwise("FAIL").alias("affordability_result"),
        ladder(
            [
                (dsti > 0.45, "HIGH_DSTI_RATIO"),
                (F.col("credit_score") < 650, "LOW_CREDIT_SCORE"),
                (F.col("ltv_ratio_pct") > 85, "HIGH_LTV"),
            ]
        ).alias("affordability_reason_codes"),
        stress.alias("interest_rate_stress_applied_pct"),
        rnd(loan * payment_rate / 12).alias("stressed_payment_monthly"),
    )


def build_collateral_link(
    flat: DataFrame, applications: DataFrame, collateral: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    df = flat.where(
        flag(F.col("extraction_success")) & F.col("loan_amount").isNotNull() & F.col("property_address").isNotNull()
    ).select(
        F.concat(F.lit("LINK_"), _stem()).alias("link_id"),
        F.concat(F.lit("APP_"), _stem()).alias("account_id"),
        F.concat(F.lit("COLL_"), _stem()).alias("collateral_id"),
        as_date("file_timestamp").alias("effective_from_date"),
        F.lit("1ST").alias("charge_rank"),
        F.col("loan_amount").alias("charge_amount"),
        F.lit(100.0).alias("collateral_allocation_pct"),
        F.lit("REGISTERED").alias("registration_status"),
    )
    known = applications.select(F.col("application_id").alias("account_id"))
    return _new(
        df.join(known, "account_id", "left_semi").join(collateral.select("collateral_id"), "collateral_id", "left_semi"),
        "link_id",
        existing,
    )


# ---- reports ----------------------------------------------------------------------------------


def _with_product(applications: DataFrame, products: DataFrame) -> DataFrame:
    kind = products.select("product_id", F.col("product_type").alias("_type"))
    return applications.join(kind, "product_id", "left").withColumn(
        "product_type", F.coalesce("_type", F.lit("Unknown"))
    )


def loan_portfolio_summary(applications: DataFrame, products: DataFrame, *, as_of) -> DataFrame:
    amount = F.col("requested_amount")
    return (
        _with_product(applications, products)
        .groupBy("product_type", "country", F.col("status").alias("application_status"))
        .agg(
            F.count(F.lit(1)).alias("loan_count"),
            F.sum(amount).alias("total_requested_amount"),
            rnd(mean(amount)).alias("avg_requested_amount"),
            F.min(amount).alias("min_requested_amount"),
            F.max(amount).alias("max_requested_amount"),
            rnd(mean("requested_term_months"), 0).cast("int").alias("avg_term_months"),
        )
        .withColumn("as_of_date", on_date(as_of))
    )


LTV_CUTS = [(50, "0-50%"), (60, "50-60%"), (70, "60-70%"), (80, "70-80%"), (90, "80-90%")]


def _loan_to_value(applications: DataFrame, link: DataFrame, collateral: DataFrame, how: str) -> DataFrame:
    pledged = link.select(F.col("account_id").alias("application_id"), "collateral_id").join(
        collateral.select("collateral_id", "valuation_value"), "collateral_id", how
    )
    return applications.join(pledged, "application_id", how).withColumn(
        "_ltv", ratio("requested_amount", "valuation_value") * 100
    )


def ltv_distribution(applications: DataFrame, link: DataFrame, collateral: DataFrame, *, as_of) -> DataFrame:
    df = _loan_to_value(applications, link, collateral, "inner").where(F.col("valuation_value") > 0)
    grouped = df.groupBy(
        at_most("_ltv", LTV_CUTS, ">90%").alias("ltv_bucket"),
        at_most("_ltv", [(cut, i + 1) for i, (cut, _) in enumerate(LTV_CUTS)], 6).alias("ltv_bucket_sort_order"),
    ).agg(
        F.count(F.lit(1)).alias("loan_count"),
        F.sum("requested_amount").alias("total_loan_amount"),
        rnd(F.avg(rnd("_ltv"))).alias("avg_ltv_pct"),
        F.sum("valuation_value").alias("total_collateral_value"),
    )
    out = attach_total(grouped, _all=F.sum("loan_count"))
    return out.withColumns(
        {"pct_of_total_loans": pct("loan_count", "_all"), "as_of_date": on_date(as_of)}
    ).drop("_all")


def application_funnel(applications: DataFrame, products: DataFrame, *, as_of) -> DataFrame:
    n = F.count(F.lit(1))

    def held(state):
        return F.count_if(F.col("status") == state)

    return (
        _with_product(applications, products)
        .groupBy("product_type", "country", "channel")
        .agg(
            n.alias("total_applications"),
            held("APPROVED").alias("approved_count"),
            held("DECLINED").alias("declined_count"),
            held("UNDER_REVIEW").alias("under_review_count"),
            pct(held("APPROVED"), n).alias("approval_rate_pct"),
            pct(held("DECLINED"), n).alias("decline_rate_pct"),
            rnd(mean("requested_amount")).alias("avg_requested_amount"),
        )
        .withColumn("as_of_date", on_date(as_of))
    )


def affordability_summary(affordability: DataFrame, applications: DataFrame, *, as_of) -> DataFrame:
    n = F.count(F.lit(1))
    return (
        affordability.join(applications.select("application_id", "country"), "application_id")
        .groupBy("country", "affordability_result")
        .agg(
            n.alias("assessment_count"),
            rnd(F.avg("dti_ratio") * 100).alias("avg_dti_ratio_pct"),
            rnd(F.avg("dsti_ratio") * 100).alias("avg_dsti_ratio_pct"),
            rnd(mean("gross_income_monthly")).alias("avg_gross_income"),
            rnd(mean("total_debt_obligations_monthly")).alias("avg_debt_obligations"),
            pct(F.count_if(F.col("affordability_result") == "PASS"), n).alias("pass_rate_pct"),
        )
        .withColumn("as_of_date", on_date(as_of))
    )


def customer_loan_summary(applications, link, collateral, affordability) -> DataFrame:
    status, amount = F.col("status"), F.col("requested_amount")
    known = applications.where(F.col("customer_id").isNotNull())
    result = affordability.select("application_id", "affordability_result")
    df = _loan_to_value(known, link, collateral, "left").join(result, "application_id", "left")
    return df.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_applications"),
        F.count_if(status == "APPROVED").alias("approved_applications"),
        F.count_if(status == "DECLINED").alias("declined_applications"),
        sum_if(status == "APPROVED", amount).alias("total_approved_amount"),
        rnd(mean(amount)).alias("avg_requested_amount"),
        F.max("application_date_time").alias("latest_application_date"),
        F.max_by("status", F.struct("application_date_time", "application_id")).alias("latest_application_status"),
        rnd(F.avg(rnd("_ltv"))).alias("avg_ltv_pct"),
        F.count_if(F.col("affordability_result") == "PASS").alias("affordability_pass_count"),
        F.count_if(F.col("affordability_result") == "FAIL").alias("affordability_fail_count"),
    )


def loan_portfolio_current(portfolio, ltv, funnel, afford, *, as_of) -> DataFrame:
    """One row of headline numbers over the four reports of the date."""

    def today(df):
        return df.where(F.col("as_of_date") == on_date(as_of))

    home = F.col("country")
    parts = [
        today(portfolio).agg(
            F.sum("loan_count").alias("total_loans"),
            F.sum("total_requested_amount").alias("total_exposure"),
            rnd(F.avg("avg_requested_amount"), 0).alias("avg_loan_amount"),
            *[
                F.sum(F.when(home == code, F.col("loan_count"))).alias(f"{name}_loans")
                for code, name in (("CHE", "switzerland"), ("GBR", "uk"), ("DEU", "germany"))
            ],
        ),
        today(ltv).agg(
            rnd(F.avg("avg_ltv_pct")).alias("avg_ltv_pct"),
            F.sum(F.when(F.col("ltv_bucket").isin("80-90%", ">90%"), F.col("loan_count"))).alias("high_ltv_count"),
        ),
        today(funnel).agg(
            F.sum("total_applications").alias("total_applications"),
            rnd(F.avg("approval_rate_pct")).alias("avg_approval_rate_pct"),
        ),
        today(afford).agg(
            F.sum("assessment_count").alias("total_assessments"),
            rnd(F.avg("pass_rate_pct")).alias("avg_affordability_pass_rate_pct"),
        ),
    ]
    out = parts[0]
    for one_row in parts[1:]:
        out = out.crossJoin(F.broadcast(one_row))
    return out.withColumn("as_of_date", on_date(as_of))


def current_date_view(report: DataFrame, order: list, *, as_of) -> DataFrame:
    """A dated report restricted to one day, in display order."""
    return report.where(F.col("as_of_date") == on_date(as_of)).orderBy(*order)


#: Applications that one task joins with all matches of their customers.
APPLICATIONS = 50_000


def loan_compliance_screening(applications: DataFrame, customer_view: DataFrame) -> DataFrame:
    """One row per application and row of the view.

    Few bytes become very many rows, so the tasks of the join follow the applications, not the bytes.
    """
    kept = [
        "full_name", "requires_sanctions_review", "requires_exposed_person_review", "overall_risk_rating",
        "vulnerable_customer_flag", "sanctions_match_name", "sanctions_authority", "sanctions_risk_score",
        "exposed_person_exact_match_name", "exposed_person_exact_category", "exposed_person_exact_risk_level",
        "exposed_person_match_type",
    ]
    listed, watched = flag(F.col("requires_sanctions_review")), flag(F.col("requires_exposed_person_review"))
    known = applications.where(F.col("customer_id").isNotNull())
    parts = max(known.sparkSession.sparkContext.defaultParallelism, -(-known.count() // APPLICATIONS))
    return (
        known.repartition(parts, "customer_id")
        .join(customer_view.select("customer_id", *kept), "customer_id", "left")
        .select(
            "application_id",
            "customer_id",
            "country",
            "requested_amount",
            F.col("status").alias("application_status"),
            *kept,
            "application_date_time",
            (listed | watched).alias("compliance_hold_flag"),
            ladder(
                [
                    (listed, "SANCTIONS_REVIEW"),
                    (watched, "PEP_REVIEW"),
                    (F.col("overall_risk_rating").isin("CRITICAL", "HIGH"), "HIGH_RISK_REVIEW"),
                ],
                "CLEAR",
            ).alias("compliance_status"),
        )
    )


def loan_eligibility(customer_view: DataFrame, *, as_of) -> DataFrame:
    """Customers who may apply: active, aged 18 to 75, not critical, no sanctions review."""
    today = on_date(as_of)
    age = years_crossed("date_of_birth", today)
    return customer_view.where(
        (F.col("current_status") == "ACTIVE")
        & age.between(18, 75)
        & (F.col("overall_risk_rating") != "CRITICAL")
        & ~F.col("requires_sanctions_review")
    ).select(
        "customer_id", "full_name", "date_of_birth", age.alias("age"), "country", "risk_classification",
        "credit_score_band", "income_range", "employment_type", F.col("total_balance").alias("existing_aum"),
        "total_accounts", "days_since_last_transaction", "overall_risk_rating", "requires_sanctions_review",
        "requires_exposed_person_review", days("onboarding_date", today).alias("relationship_tenure_days"),
    )


def loan_compliance_status(customer_view: DataFrame, screening: DataFrame, *, as_of, only=None) -> DataFrame:
    """Know-your-customer state and clearance per customer and screening hit.

    ``only`` keeps the named statuses, such as COMPLIANT and ENHANCED_DD_REQUIRED.
    """
    age, rating = days("onboarding_date", on_date(as_of)), F.col("overall_risk_rating")
    overdue = (age > 365) & rating.isin("HIGH", "CRITICAL")
    people = customer_view.select(
        "customer_id", "full_name", "country", "risk_classification", "onboarding_date", "overall_risk_rating",
        "exposed_person_match_type", "overall_exposed_person_risk", "requires_sanctions_review",
    ).distinct()
    hits = screening.select(
        "customer_id",
        F.col("match_type").alias("sanctions_match_type"),
        F.col("alert_priority").alias("sanctions_alert_priority"),
        "disposition_recommendation",
    )
    known_person = (F.col("exposed_person_match_type") == "EXACT_MATCH") & (
        F.col("overall_exposed_person_risk") == "CRITICAL"
    )
    out = people.join(hits, "customer_id", "left").select(
        "customer_id",
        "full_name",
        "country",
        "risk_classification",
        F.when(overdue | (age > 1095), "KYC_REFRESH_REQUIRED").otherwise("KYC_CURRENT").alias("kyc_status"),
        "sanctions_match_type",
        "sanctions_alert_priority",
        "disposition_recommendation",
        F.col("exposed_person_match_type").alias("pep_status"),
        "overall_exposed_person_risk",
        ladder(
            [
                (F.col("requires_sanctions_review"), "BLOCKED_SANCTIONS"),
                (known_person, "ENHANCED_DD_REQUIRED"),
                (rating == "CRITICAL", "MANUAL_REVIEW_REQUIRED"),
                (overdue, "KYC_REFRESH_REQUIRED"),
            ],
            "COMPLIANT",
        ).alias("compliance_status"),
    )
    return out if only is None else out.where(F.col("compliance_status").isin(*only))
