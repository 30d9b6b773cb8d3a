"""Small reference tables with fixed content, and how to turn them into DataFrames.

The sizes are fixed here, so joins broadcast them: each is a local relation, whose size Spark knows, with a hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: asset type, name, level, haircut %, factor, coordinate
HQLA_ELIGIBILITY = [
    ("CASH_SNB", "Swiss National Bank Reserves", "L1", "0.00", "1.0000", "1.1.1.1"),
    ("CASH_VAULT", "Physical Cash (Vault)", "L1", "0.00", "1.0000", "1.1.1.2"),
    ("GOVT_BOND_CHF", "Swiss Confederation Bonds", "L1", "0.00", "1.0000", "1.1.1.3"),
    ("GOVT_BOND_FOREIGN", "Foreign Government Bonds (0% RW)", "L1", "0.00", "1.0000", "1.1.1.4"),
    ("CANTON_BOND", "Swiss Canton Bonds", "L2A", "15.00", "0.8500", "1.1.2.1.1"),
    ("COVERED_BOND", "Covered Bonds (Pfandbriefe)", "L2A", "15.00", "0.8500", "1.1.2.1.2"),
    ("EQUITY_SMI", "Swiss Market Index (SMI) Equities", "L2B", "50.00", "0.5000", "1.1.2.2.1"),
    ("CORPORATE_BOND_AA", "Corporate Bonds (AA- or better)", "L2B", "50.00", "0.5000", "1.1.2.2.2"),
]
# fixed values: deposit type, name, base run-off rate, loyalty discount allowed, coordinate
DEPOSIT_TYPES = [
    ("RETAIL_STABLE_INSURED", "Retail Stable (Insured, 3+ Products)", "0.0300", True, "1.2.1.1"),
    ("RETAIL_STABLE", "Retail Stable", "0.0500", True, "1.2.1.2"),
    ("RETAIL_LESS_STABLE", "Retail Less Stable", "0.1000", False, "1.2.1.3"),
    ("CORPORATE_OPERATIONAL", "Corporate Operational", "0.2500", False, "1.2.2.1"),
    ("CORPORATE_NON_OPERATIONAL", "Corporate Non-Operational", "0.4000", False, "1.2.2.2"),
    ("FINANCIAL_INSTITUTION", "Financial Institution Deposits", "1.0000", False, "1.2.2.3"),
    ("UNSECURED_WHOLESALE", "Unsecured Wholesale Funding", "1.0000", False, "1.2.3"),
]
# fixed values: product, name, type, country
PRODUCTS = [
    ("CH_FIXED_MORTGAGE_25Y", "Swiss Fixed Rate Mortgage (25Y)", "MORTGAGE", "CHE"),
    ("CH_SARON_MORTGAGE", "Swiss SARON Variable Mortgage", "MORTGAGE", "CHE"),
    ("CH_BUY_TO_LET_MORTGAGE", "Swiss Buy-to-Let Mortgage", "MORTGAGE", "CHE"),
    ("UK_FIXED_MORTGAGE_30Y", "UK Fixed Rate Mortgage (30Y)", "MORTGAGE", "GBR"),
    ("UK_TRACKER_MORTGAGE", "UK Base Rate Tracker Mortgage", "MORTGAGE", "GBR"),
    ("UK_GREEN_MORTGAGE", "UK Green Mortgage (EPC A-C)", "MORTGAGE", "GBR"),
    ("DE_FIXED_MORTGAGE_20Y", "German Fixed Rate Mortgage (20Y)", "MORTGAGE", "DEU"),
    ("DE_KFW_GREEN_MORTGAGE", "German KfW Energy Efficient Mortgage", "MORTGAGE", "DEU"),
]
# fixed values: application status, name, category, final, needs action, order
APPLICATION_STATUS = [
    ("DRAFT", "Draft", "PENDING", False, True, 1),
    ("SUBMITTED", "Submitted", "PENDING", False, False, 2),
    ("KYC_PENDING", "KYC Pending", "PENDING", False, True, 3),
    ("UNDER_REVIEW", "Under Review", "PENDING", False, False, 4),
    ("APPROVED", "Approved", "APPROVED", False, False, 5),
    ("OFFER_ISSUED", "Offer Issued", "APPROVED", False, True, 6),
    ("OFFER_ACCEPTED", "Offer Accepted", "APPROVED", False, False, 7),
    ("COOLING_OFF", "Cooling-Off Period", "PENDING", False, False, 8),
    ("DISBURSED", "Disbursed", "DISBURSED", True, False, 9),
    ("DECLINED", "Declined", "DECLINED", True, False, 10),
    ("WITHDRAWN", "Withdrawn by Applicant", "WITHDRAWN", True, False, 11),
    ("CANCELLED", "Cancelled by Bank", "DECLINED", True, False, 12),
]
# fixed values: country, currency, affordability limit (share of income), stressed rate
COUNTRY_REGIMES = [
    ("CHE", "CHF", "0.33", "0.0500"),
    ("GBR", "GBP", "0.45", "0.0700"),
    ("DEU", "EUR", "0.40", "0.0450"),
]


def _literal(value) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def _values(spark: SparkSession, rows: list[tuple], names: str, *columns: str) -> DataFrame:
    listed = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    return F.broadcast(spark.sql(f"SELECT {', '.join(columns)} FROM VALUES {listed} AS t({names})"))


def hqla_eligibility(spark: SparkSession) -> DataFrame:
    return _values(
        spark, HQLA_ELIGIBILITY, "asset_type, asset_name, regulatory_level, p, f, snb_coordinate",
        "asset_type", "asset_name", "regulatory_level", "cast(p as decimal(5,2)) haircut_pct",
        "cast(f as decimal(5,4)) haircut_factor", "snb_coordinate", "true as is_active",
    )


def deposit_types(spark: SparkSession) -> DataFrame:
    return _values(
        spark, DEPOSIT_TYPES, "deposit_type, deposit_name, r, allows_relationship_discount, snb_coordinate",
        "deposit_type", "deposit_name", "cast(r as decimal(5,4)) base_run_off_rate", "allows_relationship_discount",
        "snb_coordinate", "true as is_active",
    )


def products(spark: SparkSession) -> DataFrame:
    return _values(spark, PRODUCTS, "product_id, product_name, product_type, country", "*", "true as is_active")


def application_status(spark: SparkSession) -> DataFrame:
    names = "status_code, status_name, status_category, is_final, requires_action, display_order"
    return _values(spark, APPLICATION_STATUS, names, "*")


def country_regimes(spark: SparkSession) -> DataFrame:
    return _values(
        spark, COUNTRY_REGIMES, "country_code, currency_code, d, r",
        "country_code", "currency_code", "cast(d as decimal(5,2)) affordability_limit",
        "cast(r as decimal(5,4)) affordability_imputed_rate",
    )
