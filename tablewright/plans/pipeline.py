"""Running the layers end to end and storing each as a documented table.

The lazy `Layers` recompute everything a query needs; at scale the layers are stored once and
read many times. Every silver table is computed in one pass that writes its clean and its
quarantined half together; facts read the stored halves, rollups read the stored facts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import quality
from ..session import tune
from ..sources.tables import TableSpec, attach, publish
from . import gold, raw, silver

SILVER = ["customers", "claims", "policy", "sales", "cars"]

# What each published table is, for the catalog.
COMMENTS = {
    "customers": "Customers, harmonized, one row each, all rules passed",
    "claims": "Claims, typed, all rules passed",
    "policy": "Policies, typed, all rules passed",
    "sales": "Listings, dates parsed, blank rows dropped, all rules passed",
    "cars": "Vehicles, unit suffixes removed, all rules passed",
    "dim_customer": "Customer dimension, one row per customer",
    "dim_policy": "Policy dimension with coverage tier, one row per policy",
    "dim_car": "Vehicle dimension",
    "dim_date": "Calendar",
    "fact_claims": "Claims with policy and customer attributes, one row per claim",
    "fact_sales": "Listings with vehicle attributes, one row per listing",
    "agg_claim_rejection_by_policy_region": "Rejection rate by coverage and region",
    "agg_claim_severity_breakdown": "Claim counts and amounts by severity",
    "agg_customer_count_by_region": "Customers by region",
    "agg_unsold_inventory_by_model_region": "Unsold listings and their age by model, region",
    "agg_policy_premium_by_coverage_tier": "Premiums and claim exposure by coverage tier",
}


COMMENTS |= {f"{table}_failed": f"Rows of {table} that failed a rule, with the reason"
             for table in SILVER}


# What the columns of the main tables mean.
_COVERAGE = {
    "policy_csl": "Combined single limit, per person / per accident in thousands of dollars",
    "policy_csl_tier": "Coverage tier derived from the limit: Low, Medium, High or Unknown",
    "policy_deductable": "Deductible in dollars",
    "policy_annual_premium": "Premium per year in dollars",
}
COLUMN_COMMENTS = {
    "dim_policy": {
        "policy_number": "Number of the policy, unique",
        "policy_bind_date": "Day the policy took effect",
        "policy_state": "State the policy was issued in",
        **_COVERAGE,
        "umbrella_limit": "Additional liability cover in dollars, 0 for none",
        "car_id": "Insured vehicle, key of dim_car",
        "customer_id": "Policyholder, key of dim_customer",
    },
    "dim_customer": {
        "customer_id": "Customer, unique over all sources",
        "region": "Sales region, full name",
        "state": "State of residence",
        "city": "City of residence",
        "job": "Occupation",
        "marital": "Marital status, NULL where the source does not record it",
        "education": "Education level, NULL where the source does not record it",
        "default_flag": "1 after a missed repayment, else 0",
        "balance": "Account balance in dollars",
        "hh_insurance": "1 with household insurance, else 0",
        "car_loan": "1 with a car loan, else 0",
    },
    "fact_claims": {
        "claim_id": "Claim number",
        "policy_id": "Policy claimed under, key of dim_policy",
        "customer_id": "Policyholder, NULL if the policy is unknown",
        **_COVERAGE,
        "region": "Region of the policyholder",
        "state": "State of the policyholder",
        "incident_severity": "Severity of the damage",
        "incident_type": "Kind of incident",
        "collision_type": "Side of the collision",
        "incident_state": "State of the incident",
        "incident_city": "City of the incident",
        "authorities_contacted": "Authority contacted; the text None if none was",
        "property_damage": "YES or NO, NULL if unknown",
        "police_report_available": "YES or NO, NULL if unknown",
        "claim_rejected": "Y if rejected, N if approved",
        "is_rejected": "1 if rejected, else 0",
        "injury_amount": "Claimed for injuries, dollars",
        "property_amount": "Claimed for property, dollars",
        "vehicle_amount": "Claimed for the vehicle, dollars, NULL if not assessed",
        "total_claim_amount": "Sum of the three amounts, missing ones as 0",
        "number_of_vehicles_involved": "Vehicles involved",
        "bodily_injuries": "Injured persons",
        "witnesses": "Witnesses",
    },
}


class StoredLayers:
    """The interface of `Layers`, read from published tables of one schema."""

    def __init__(self, spark: SparkSession, schema: str) -> None:
        self.spark, self.schema = spark, schema

    def clean(self, table: str) -> DataFrame:
        return self.spark.table(f"{self.schema}.{table}")

    def quarantined(self, table: str) -> DataFrame:
        return self.spark.table(f"{self.schema}.{table}_failed")

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self.clean("dim_customer")

    @cached_property
    def dim_policy(self) -> DataFrame:
        return self.clean("dim_policy")

    @cached_property
    def dim_car(self) -> DataFrame:
        return self.clean("dim_car")

    @cached_property
    def fact_claims(self) -> DataFrame:
        return self.clean("fact_claims")

    @cached_property
    def fact_sales(self) -> DataFrame:
        return self.clean("fact_sales")


def run(spark: SparkSession, bronze: dict[str, DataFrame], schema: str, base: str,
        as_of: str | None = None) -> StoredLayers:
    """Build and publish all layers from raw frames; files go below `base`."""
    tune(spark)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{base}/catalog'")
    stored = StoredLayers(spark, schema)

    def put(name: str, df: DataFrame, layer: str) -> None:
        spec = TableSpec(f"{schema}.{name}", COMMENTS.get(name, ""), layer,
                         columns=COLUMN_COMMENTS.get(name, {}))
        publish(df, spec, path=f"{base}/{layer}/{name}")

    def keep(name: str, half: DataFrame, layer: str, folder: str) -> None:
        # The half is stored already; only an empty one has no folder to point at.
        if half.isEmpty():
            put(name, half, layer)
        else:
            spec = TableSpec(f"{schema}.{name}", COMMENTS.get(name, ""), layer)
            attach(spark, spec, folder, half.schema)

    for table in SILVER:
        typed = (silver.sales(bronze["sales"], as_of) if table == "sales"
                 else getattr(silver, table)(bronze[table]))
        folder = f"{base}/silver/{table}"
        clean, failed = quality.write_split(typed, silver.CHECKS[table], folder)
        keep(table, clean, "silver", f"{folder}/{quality.PASSED}=true")
        keep(f"{table}_failed", failed, "quarantine", f"{folder}/{quality.PASSED}=false")

    put("dim_customer", gold.dim_customer(stored.clean("customers")), "gold")
    put("dim_policy", gold.dim_policy(stored.clean("policy")), "gold")
    put("dim_car", gold.dim_car(stored.clean("cars")), "gold")
    put("dim_date", gold.dim_date(spark), "gold")
    put("fact_claims", gold.fact_claims(stored.clean("claims"), stored.clean("policy"),
                                        stored.clean("customers"), whole=True), "gold")
    put("fact_sales", gold.fact_sales(stored.clean("sales"), stored.clean("cars"), whole=True),
        "gold")

    rollups: dict[str, Callable[[], DataFrame]] = {
        "agg_claim_rejection_by_policy_region":
            lambda: gold.rejection_by_tier_region(stored.fact_claims),
        "agg_claim_severity_breakdown": lambda: gold.severity_breakdown(stored.fact_claims),
        "agg_customer_count_by_region": lambda: gold.customers_by_region(stored.dim_customer),
        "agg_unsold_inventory_by_model_region":
            lambda: gold.unsold_by_model_region(stored.fact_sales),
        "agg_policy_premium_by_coverage_tier":
            lambda: gold.premium_by_tier(stored.dim_policy, stored.fact_claims),
    }
    for name, build in rollups.items():
        put(name, build(), "gold")
    return stored


def run_on(spark: SparkSession, sf_dir: str, schema: str, base: str) -> StoredLayers:
    """The pipeline over the raw tables derived from one data folder."""
    bronze = {t: getattr(raw, t)(spark, sf_dir) for t in SILVER}
    return run(spark, bronze, schema, base, raw.AS_OF)
