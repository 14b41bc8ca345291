"""Clean layer: raw tables to typed, harmonized columns, and the rules that gate them.

Each function maps one raw frame to one typed frame; `CHECKS` holds the rules of each table.
Decisions where the source semantics leave room:
- a row passes only if every rule IS TRUE, so an undecided (NULL) rule quarantines the row;
- rows without a key are never merged by deduplication, they go to quarantine;
- only fully blank sales rows are dropped, partly filled ones reach the rules;
- a listing is unsold when its sale date is missing after parsing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as fn
from ..operators import harmonize, quality
from . import fixed_values as fixed
from .raw import SALES_COLUMNS

CHECKS = {
    "customers": quality.rules(fixed.CUSTOMER_RULES),
    "claims": quality.rules(fixed.CLAIM_RULES),
    "policy": quality.rules(fixed.POLICY_RULES),
    "sales": quality.rules(fixed.SALES_RULES),
    "cars": quality.rules(fixed.CAR_RULES),
}


def _lineage(raw: DataFrame) -> dict[str, Column]:
    return {name: F.col(name) for name in (fixed.SOURCE_FILE, fixed.LOAD_TIMESTAMP)
            if name in raw.columns}


def harmonized_customers(raw: DataFrame) -> DataFrame:
    """Unified columns, repaired values, typed measures; still one row per raw row."""
    unified = {name: fn.first_present(raw, names)
               for name, names in fixed.CUSTOMER_VARIANTS.items()}
    education_slot = fn.column_or_null(raw, "Education")
    marital_slot = fn.column_or_null(raw, "Marital_status")
    education = fn.prefer_if_in(marital_slot, fixed.EDUCATION_VALUES, unified["education"])

    def flag(name: str) -> Column:
        return fn.as_int(fn.column_or_null(raw, name))

    return harmonize.shape(raw, {
        "customer_id": unified["customer_id"],
        "region": fn.recode(unified["region"], fixed.REGION_CODES),
        "state": fn.column_or_null(raw, "State"),
        "city": unified["city"],
        "job": fn.column_or_null(raw, "Job"),
        "marital": fn.prefer_if_in(education_slot, fixed.MARITAL_VALUES, unified["marital"]),
        "education": fn.recode(education, fixed.EDUCATION_TYPOS),
        "default_flag": flag("Default"),
        "balance": flag("Balance"),
        "hh_insurance": flag("HHInsurance"),
        "car_loan": flag("CarLoan"),
        **_lineage(raw),
    })


def customers(raw: DataFrame) -> DataFrame:
    """Harmonized and reduced to one row per customer: the master file wins, then file order.

    Rows of one customer in one file are ordered by their values, so that the choice is fixed.
    """
    harmonized = harmonized_customers(raw)
    return quality.keep_first(harmonized, "customer_id", customer_order(harmonized))


def customer_order(harmonized: DataFrame) -> list[Column]:
    """Which row of a customer wins."""
    from_master = F.col(fixed.SOURCE_FILE).contains(fixed.MASTER_SOURCE)
    values = [c for c in harmonized.columns
              if c not in ("customer_id", fixed.SOURCE_FILE, fixed.LOAD_TIMESTAMP)]
    return [F.when(from_master, 0).otherwise(1), F.col(fixed.SOURCE_FILE),
            *[F.col(c) for c in values]]


def claims(raw: DataFrame) -> DataFrame:
    def amount(name: str) -> Column:
        return fn.as_double(fn.null_if_in(F.col(name), fixed.AMOUNT_SENTINELS))

    def answer(name: str) -> Column:
        return fn.null_if_in(F.col(name), fixed.UNKNOWN_SENTINELS)

    as_is = {c: F.col(c) for c in (
        "incident_state", "incident_city", "incident_location", "incident_type",
        "collision_type", "incident_severity", "authorities_contacted")}
    return harmonize.shape(raw, {
        "claim_id": F.col("ClaimID"),
        "policy_id": F.col("PolicyID"),
        **as_is,
        **{f"{c}_amount": amount(c) for c in ("injury", "property", "vehicle")},
        "number_of_vehicles_involved": fn.as_int(F.col("number_of_vehicles_involved")),
        **{c: answer(c) for c in ("property_damage", "police_report_available")},
        **{c: fn.as_int(F.col(c)) for c in ("bodily_injuries", "witnesses")},
        "claim_rejected": F.col("Claim_Rejected"),
        "claim_processed_on_raw": fn.null_if_in(F.col("Claim_Processed_On"),
                                                fixed.AMOUNT_SENTINELS),
        # The texts are minute fragments; no date can be recovered, so they stay as they are.
        "incident_date_raw": F.col("incident_date"),
        "claim_logged_on_raw": F.col("Claim_Logged_On"),
        **_lineage(raw),
    })


def policy(raw: DataFrame) -> DataFrame:
    return harmonize.shape(raw, {
        "policy_number": F.col("policy_number"),
        "policy_bind_date": fn.as_date(F.col("policy_bind_date"), fixed.DATE_FORMAT),
        "policy_state": F.col("policy_state"),
        "policy_csl": F.col("policy_csl"),
        "policy_deductable": fn.as_int(F.col("policy_deductable")),
        "policy_annual_premium": fn.as_double(F.col("policy_annual_premium")),
        "umbrella_limit": fn.as_int(F.col("umbrella_limit")),
        "car_id": F.col("car_id"),
        "customer_id": F.col("customer_id"),
        **_lineage(raw),
    })


def sales(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    """`as_of` fixes the day that ages are counted to; the current day if not given."""
    today = F.lit(as_of).cast("date") if as_of else F.current_date()
    placed = fn.as_timestamp(F.col("ad_placed_on"), fixed.MINUTE_FORMAT)
    sold = fn.as_timestamp(F.col("sold_on"), fixed.MINUTE_FORMAT)
    return harmonize.shape(quality.usable_rows(raw, SALES_COLUMNS), {
        "sales_id": F.col("sales_id").try_cast("bigint"),
        "ad_placed_on": placed,
        "sold_on": sold,
        "original_selling_price": fn.as_double(F.col("original_selling_price")),
        "region": F.col("Region"),
        "state": F.col("State"),
        "city": F.col("City"),
        "seller_type": F.col("seller_type"),
        "owner": F.col("owner"),
        "car_id": F.col("car_id"),
        "days_unsold": F.when(sold.isNull(), F.date_diff(today, placed)),
        **_lineage(raw),
    })


def cars(raw: DataFrame) -> DataFrame:
    measured = {"mileage_kmpl": "mileage", "engine_cc": "engine", "max_power_bhp": "max_power"}
    return harmonize.shape(raw, {
        "car_id": F.col("car_id"),
        "name": F.col("name"),
        "km_driven": fn.as_int(F.col("km_driven")),
        "fuel": F.col("fuel"),
        "transmission": F.col("transmission"),
        **{out: fn.leading_number(F.col(c), fixed.NUMBER_PATTERN)
           for out, c in measured.items()},
        # Torque has no common notation across sources, so it is kept as text.
        "torque_raw": F.col("torque"),
        "seats": fn.as_int(F.col("seats")),
        "model": F.col("model"),
        **_lineage(raw),
    })
