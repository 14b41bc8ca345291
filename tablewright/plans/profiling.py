"""Exploration of the raw tables: the numbered profiling questions as single-scan queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import measures as m
from ..functions.cleaning import as_timestamp, recode
from ..operators import harmonize, joins, profile, quality
from . import fixed_values as fixed
from .raw import SALES_COLUMNS

SOURCE = fixed.SOURCE_FILE


def _physical(logical: str) -> Column:
    return harmonize.by_source(F.col(SOURCE), {
        s: None if columns[logical] is None else F.col(columns[logical]).cast("string")
        for s, columns in fixed.CUSTOMER_COLUMNS.items()})


def table_sizes(raw: dict[str, DataFrame]) -> DataFrame:
    """Rows of every source file group and table."""
    stacked = [profile.row_counts_by(raw[t], SOURCE) for t in ("customers", "sales")]
    single = profile.row_counts({t: raw[t] for t in ("policy", "cars")})
    return stacked[0].unionByName(stacked[1]).unionByName(single)


def schema_variants(customers: DataFrame) -> DataFrame:
    return harmonize.schema_variants(customers, SOURCE, {
        "id_col": ["CustomerID", "Customer_ID", "cust_id"],
        "region_col": ["Region", "Reg"],
        "city_col": ["City", "City_in_state"],
        "education_col": ["Education", "Edu"],
        "marital_col": ["Marital", "Marital_status"],
    })


def customer_nulls(customers: DataFrame) -> DataFrame:
    """NULLs per source in the columns each source really has; absent ones report NULL."""
    counted = profile.null_profile(customers, {
        "customerid": _physical("id"), "region": _physical("region"),
        "state": F.col("State"), "city": _physical("city"),
        "education": _physical("education"),
    }, by=[SOURCE])
    absent = [s for s, c in fixed.CUSTOMER_COLUMNS.items() if c["education"] is None]
    missing = (F.col("column_name") == "education") & F.col(SOURCE).isin(absent)
    return counted.select(F.col(SOURCE).alias("table_name"), "column_name", "total_rows",
                          F.when(~missing, F.col("null_rows")).alias("null_rows"))


def region_values(customers: DataFrame) -> DataFrame:
    return profile.value_counts(
        customers.select(F.col(SOURCE).alias("table_name"),
                         _physical("region").alias("region")), ["region"], ["table_name"])


def education_values(customers: DataFrame) -> DataFrame:
    having = [s for s, c in fixed.CUSTOMER_COLUMNS.items() if c["education"] is not None]
    return profile.value_counts(
        customers.where(F.col(SOURCE).isin(having)).select(
            F.col(SOURCE).alias("table_name"), _physical("education").alias("education")),
        ["education"], ["table_name"])


def swap_evidence(customers: DataFrame, source: str = "customers_6") -> DataFrame:
    return profile.value_counts(customers.where(F.col(SOURCE) == source),
                                ["Education", "Marital_status"])


def harmonized_union(customers: DataFrame) -> DataFrame:
    """The six regional sources under one schema, each by its own column mapping."""
    regional = [s for s in fixed.CUSTOMER_COLUMNS if s != fixed.MASTER_SOURCE]
    src = F.col(SOURCE)
    swapped = src == "customers_6"
    marital = harmonize.by_source(src, {
        "customers_1": F.col("Marital_status"),
        **{s: F.col("Marital") for s in ("customers_3", "customers_4", "customers_5")},
        "customers_6": F.col("Education")})
    education = F.when(swapped, F.col("Marital_status")).otherwise(_physical("education"))
    return customers.where(src.isin(regional)).select(
        src.alias("source_table"),
        F.coalesce("CustomerID", "Customer_ID", "cust_id").alias("customer_id"),
        F.when(src == "customers_5", recode(F.col("Region"), fixed.REGION_CODES))
        .otherwise(_physical("region")).alias("region"),
        F.col("State").alias("state"),
        _physical("city").alias("city"),
        F.col("Job").alias("job"),
        marital.alias("marital_status"),
        F.when(src == "customers_5", recode(F.col("Education"), fixed.EDUCATION_TYPOS))
        .otherwise(education).alias("education"),
        F.col("Default").alias("default_flag"),
        F.col("Balance").alias("balance"),
        F.col("HHInsurance").alias("hh_insurance"),
        F.col("CarLoan").alias("car_loan"),
    )


def keys_by_source(customers: DataFrame) -> DataFrame:
    regional = customers.where(F.col(SOURCE) != fixed.MASTER_SOURCE).select(
        SOURCE, F.coalesce("CustomerID", "Customer_ID", "cust_id").alias("customer_id"))
    return profile.keys_by_source(regional, SOURCE, "customer_id")


def master_only(customers: DataFrame) -> DataFrame:
    """Master keys that no regional source delivers."""
    is_master = F.col(SOURCE) == fixed.MASTER_SOURCE
    master = customers.where(is_master).select("CustomerID")
    regional = customers.where(~is_master).select(
        F.coalesce("CustomerID", "Customer_ID", "cust_id").alias("customer_id"))
    return joins.orphans(master, regional, "CustomerID", "customer_id")


def policy_keys(policy: DataFrame) -> DataFrame:
    keys = ["policy_number", "customer_id", "car_id"]
    return profile.key_profile(policy, keys, [*keys, "policy_bind_date"])


def suspicious_policies(policy: DataFrame) -> DataFrame:
    def number(column: str) -> Column:
        return F.col(column).try_cast("double")

    return policy.where((number("umbrella_limit") < 0) | (number("policy_annual_premium") <= 0)
                        | (number("policy_deductable") <= 0))


def blank_sales(sales: DataFrame) -> DataFrame:
    return quality.blank_rows(sales, SALES_COLUMNS)


def blank_sales_by_source(sales: DataFrame) -> DataFrame:
    return blank_sales(sales).groupBy(
        F.col(SOURCE).alias("table_name")).agg(m.rows().alias("blank_rows"))


def partial_sales(sales: DataFrame) -> DataFrame:
    others = [c for c in SALES_COLUMNS if c not in ("ad_placed_on", "sold_on")]
    return quality.partial_rows(sales, "ad_placed_on", others)


def usable_sales(sales: DataFrame) -> DataFrame:
    return quality.usable_rows(sales, SALES_COLUMNS).groupBy(
        F.col(SOURCE).alias("table_name")).agg(m.rows().alias("usable_rows"))


def unsold_by_source(sales: DataFrame) -> DataFrame:
    return sales.where("sold_on IS NULL AND car_id IS NOT NULL").groupBy(
        F.col(SOURCE).alias("table_name")).agg(m.rows().alias("unsold_count"))


def aging_buckets(sales: DataFrame, as_of: str) -> DataFrame:
    placed = as_timestamp(F.col("ad_placed_on"), fixed.MINUTE_FORMAT)
    sold = as_timestamp(F.col("sold_on"), fixed.MINUTE_FORMAT)
    age = F.date_diff(F.lit(as_of).cast("date"), placed)
    return sales.where(F.col("car_id").isNotNull() & sold.isNull()).groupBy(
        F.col(SOURCE).alias("source_table"), F.col("Region").alias("region")).agg(
        m.rows().alias("unsold_cars"),
        m.count_where(age >= 90).alias("unsold_90_plus_days"),
        m.count_where(age >= 60).alias("unsold_60_plus_days"))


def sales_across_sources(sales: DataFrame) -> DataFrame:
    """Listings delivered more than once, with the sources that deliver them.

    The set holds source names only, so it is bounded by the number of sources.
    """
    keyed = sales.where("sales_id IS NOT NULL AND car_id IS NOT NULL")
    sources = F.array_join(F.sort_array(F.collect_set(SOURCE)), ", ")
    return profile.repeated_keys(keyed, ["sales_id", "car_id"], sources.alias("source_tables"))


def car_profile(cars: DataFrame) -> DataFrame:
    return profile.key_profile(cars, ["car_id"], [
        "car_id", "name", "fuel", "transmission", "mileage", "engine", "max_power", "torque"])


def car_distribution(cars: DataFrame) -> DataFrame:
    return profile.distribution(cars, ["fuel", "transmission", "seats"])


def join_preview(policy: DataFrame, customers: DataFrame, cars: DataFrame, k: int = 100
                 ) -> DataFrame:
    """The first `k` policies by number with holder and car.

    A left join keeps at least one row per policy, so the first k joined rows come from the
    first k policies. They are picked before joining; k keys then narrow the other two tables
    by a semi join, and neither of them is shuffled whole. All columns take part in the order:
    policies of one number may be picked several times over in a plan, and it is always the same
    ones.
    """
    columns = ["policy_bind_date", "policy_state", "policy_annual_premium", "customer_id",
               "car_id"]
    order = [F.col("policy_number").asc_nulls_last(),
             *[F.col(c).asc_nulls_last() for c in columns]]
    first = policy.select("policy_number", *columns).orderBy(*order).limit(k)
    holders = customers.where(F.col(SOURCE) == fixed.MASTER_SOURCE).select(
        F.col("CustomerID").alias("customer_id"), F.col("Region").alias("region"),
        F.col("State").alias("state"), F.col("City").alias("city"), F.col("Job").alias("job"),
        F.col("Marital").alias("marital"), F.col("Education").alias("education"))
    models = cars.select("car_id", F.col("name").alias("car_name"), "model", "fuel",
                         "transmission")

    def narrowed(table: DataFrame, key: str) -> DataFrame:
        # At most k keys: the limit above is the size check of this broadcast.
        return table.join(F.broadcast(first.select(key).distinct()), key, "left_semi")

    return (
        first.join(narrowed(holders, "customer_id"), "customer_id", "left")
        .join(narrowed(models, "car_id"), "car_id", "left")
        .orderBy(*order, "region", "state", "city", "job", "marital", "education", "car_name",
                 "model", "fuel", "transmission").limit(k)
    )


def claim_nulls(claims: DataFrame) -> DataFrame:
    return profile.null_profile(claims, {"ClaimID": F.col("ClaimID"),
                                         "Claim_Logged_On": F.col("Claim_Logged_On")})


def repeated_claims(claims: DataFrame) -> DataFrame:
    return profile.repeated_keys(claims, ["ClaimID"])


def unlogged_claims(claims: DataFrame) -> DataFrame:
    return claims.where("Claim_Logged_On IS NULL")


def claim_log_dates(claims: DataFrame) -> DataFrame:
    """Raw log times next to what they parse to, for judging whether they are dates at all."""
    parsed = as_timestamp(F.col("Claim_Logged_On"), fixed.MINUTE_FORMAT)
    return claims.select("ClaimID", "Claim_Logged_On", parsed.alias("parsed_claim_ts"))


def claim_joinability(claims: DataFrame, policy: DataFrame, customers: DataFrame) -> DataFrame:
    master = customers.where(F.col(SOURCE) == fixed.MASTER_SOURCE)
    return joins.key_coverage([
        ("claims.PolicyID -> policy.policy_number", claims, "PolicyID", policy,
         "policy_number"),
        ("claims.ClaimID -> policy.policy_number", claims, "ClaimID", policy, "policy_number"),
        ("claims.PolicyID -> customers.CustomerID", claims, "PolicyID", master, "CustomerID"),
        ("claims.ClaimID -> customers.CustomerID", claims, "ClaimID", master, "CustomerID"),
    ])


def claim_categories(claims: DataFrame) -> DataFrame:
    """Frequencies of the categorical columns of clean claims, in one pass."""
    return profile.value_counts(claims, [
        "incident_severity", "claim_rejected", "bodily_injuries", "witnesses",
        "number_of_vehicles_involved", "authorities_contacted"])
