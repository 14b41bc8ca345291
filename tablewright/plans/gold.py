"""Star schema: dimensions, facts and the rollups over them.

Every function takes clean frames and returns a frame, so the layers can be stored or chained.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import measures as m
from ..functions.cleaning import classify, null_safe_sum
from ..operators import joins
from . import fixed_values as fixed


def coverage_tier() -> Column:
    return classify(F.col("policy_csl"), fixed.CSL_TIERS, fixed.CSL_TIER_DEFAULT)


def _lineage(df: DataFrame) -> list[str]:
    return [c for c in (fixed.SOURCE_FILE, fixed.LOAD_TIMESTAMP) if c in df.columns]


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "region", "state", "city", "job", "marital", "education",
        "default_flag", "balance", "hh_insurance", "car_loan", *_lineage(customers))


def dim_policy(policy: DataFrame) -> DataFrame:
    return policy.select(
        "policy_number", "policy_bind_date", "policy_state", "policy_csl",
        coverage_tier().alias("policy_csl_tier"), "policy_deductable",
        "policy_annual_premium", "umbrella_limit", "car_id", "customer_id",
        *_lineage(policy))


def dim_car(cars: DataFrame) -> DataFrame:
    return cars.select(
        "car_id", "name", "model", "fuel", "transmission", "km_driven", "mileage_kmpl",
        "engine_cc", "max_power_bhp", "torque_raw", "seats", *_lineage(cars))


def _calendar_columns(days: DataFrame) -> DataFrame:
    day = F.col("full_date")
    return days.select(
        F.date_format(day, fixed.DATE_KEY_FORMAT).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(fixed.WEEKEND_DAYS).cast("int").alias("is_weekend"),
    )


def dim_date(spark: SparkSession, start: str = fixed.CALENDAR_START,
             days: int = fixed.CALENDAR_DAYS) -> DataFrame:
    """Calendar of `days` days from `start`."""
    first = F.lit(start).cast("date")
    return _calendar_columns(
        spark.range(days).select(F.date_add(first, F.col("id").cast("int")).alias("full_date")))


def dim_date_spanning(dated: DataFrame, *columns: str) -> DataFrame:
    """Calendar over all days between the first and the last date found in the columns."""
    days = F.explode(F.array(*[F.to_date(c) for c in columns]))
    return _calendar_columns(
        dated.select(days.alias("d")).agg(F.min("d").alias("a"), F.max("d").alias("b"))
        .select(F.explode(F.sequence("a", "b")).alias("full_date")))


def fact_claims(claims: DataFrame, policy: DataFrame, customers: DataFrame, whole: bool = False
                ) -> DataFrame:
    """One row per claim with its policy's and policyholder's attributes.

    The two dimensions are joined first and the claims meet the result once, so the large side
    moves once, and claims without a policy do not pile up on a NULL customer. A claim without
    a policy keeps NULL attributes, tier included. Customers are known to be one row per id;
    saying so lets Spark leave their join out of any plan that uses no column of theirs. `whole`
    is for a caller that takes all columns: the claims then move in a more compact form.
    """
    holders = customers.select("customer_id", "region", "state").dropDuplicates(["customer_id"])
    cover = policy.select(
        "policy_number", "policy_csl", coverage_tier().alias("policy_csl_tier"),
        "policy_deductable", "policy_annual_premium", "customer_id",
    ).join(holders, "customer_id", "left")
    if whole:
        joined = joins.left_packed(claims.drop("incident_location"), cover, "policy_id",
                                   "policy_number")
    else:
        joined = claims.join(cover, F.col("policy_id") == F.col("policy_number"), "left")
    amounts = [F.col(f"{part}_amount") for part in ("injury", "property", "vehicle")]
    return joined.select(
        "claim_id", "policy_id", "customer_id",
        "policy_csl", "policy_csl_tier", "policy_deductable", "policy_annual_premium",
        "region", "state",
        "incident_severity", "incident_type", "collision_type", "incident_state",
        "incident_city", "authorities_contacted", "property_damage",
        "police_report_available", "claim_rejected",
        F.coalesce((F.col("claim_rejected") == "Y").cast("int"), F.lit(0))
        .alias("is_rejected"),
        *amounts,
        null_safe_sum(*amounts).alias("total_claim_amount"),
        "number_of_vehicles_involved", "bodily_injuries", "witnesses",
        "incident_date_raw", "claim_logged_on_raw", "claim_processed_on_raw",
        *_lineage(claims))


def fact_sales(sales: DataFrame, cars: DataFrame, whole: bool = False) -> DataFrame:
    """One row per listing with its car's attributes; `whole` as in `fact_claims`."""
    models = cars.select("car_id", F.col("name").alias("car_name"),
                         F.col("model").alias("car_model"), "fuel", "transmission", "seats")
    sold = F.col("sold_on").isNotNull()
    if whole:
        joined = joins.left_packed(sales, models.withColumnRenamed("car_id", "_model_id"), "car_id",
                                   "_model_id")
    else:
        joined = sales.join(models, "car_id", "left")
    return joined.select(
        "sales_id", "car_id", "car_name", "car_model", "fuel", "transmission", "seats",
        "region", "state", "city", "seller_type", "owner", "ad_placed_on", "sold_on",
        F.year("ad_placed_on").alias("listing_year"),
        F.month("ad_placed_on").alias("listing_month"),
        sold.cast("int").alias("is_sold"),
        "original_selling_price", "days_unsold",
        F.when(~sold, F.col("original_selling_price")).alias("revenue_at_risk"),
        *_lineage(sales))


# ------------------------------------------------------------------------------- rollups

def _rejections() -> tuple[Column, Column]:
    rejected = F.sum("is_rejected")
    return rejected.alias("rejected_claims"), m.percent(rejected, m.rows()).alias(
        "rejection_rate_pct")


def rejection_by_tier_region(claims: DataFrame) -> DataFrame:
    return claims.groupBy("policy_csl", "policy_csl_tier", "region").agg(
        m.rows().alias("total_claims"),
        *_rejections(),
        m.money_mean("total_claim_amount").alias("avg_claim_amount"),
        m.money_sum("total_claim_amount").alias("total_claim_amount"),
    ).orderBy(F.desc("rejection_rate_pct"), "policy_csl", "region")


def severity_breakdown(claims: DataFrame) -> DataFrame:
    return claims.groupBy("incident_severity").agg(
        m.rows().alias("total_claims"),
        *_rejections(),
        m.money_sum("total_claim_amount").alias("total_claim_amount"),
        m.money_mean("total_claim_amount").alias("avg_claim_amount"),
        m.rounded_mean("bodily_injuries").alias("avg_bodily_injuries"),
        m.rounded_mean("number_of_vehicles_involved").alias("avg_vehicles_involved"),
    ).orderBy(F.desc("total_claims"), "incident_severity")


def customers_by_region(customers: DataFrame) -> DataFrame:
    owners = {"customers_with_default": "default_flag",
              "customers_with_hh_insurance": "hh_insurance",
              "customers_with_car_loan": "car_loan"}
    return customers.groupBy("region").agg(
        m.rows().alias("customer_count"),
        F.count_distinct("state").alias("states_covered"),
        m.rounded_mean("balance").alias("avg_balance"),
        *[m.count_where(F.col(flag) == 1).alias(name) for name, flag in owners.items()],
    ).orderBy("region")


def unsold_by_model_region(sales: DataFrame) -> DataFrame:
    age = F.col("days_unsold")
    return sales.where("is_sold = 0").groupBy("car_model", "region").agg(
        m.rows().alias("unsold_count"),
        F.max(age).alias("max_days_unsold"),
        m.rounded_mean(age, 1).alias("avg_days_unsold"),
        F.min(age).alias("min_days_unsold"),
        m.money_sum("revenue_at_risk").alias("total_revenue_at_risk"),
        m.money_mean("original_selling_price").alias("avg_listing_price"),
        *[m.count_where(age > limit).alias(f"unsold_over_{limit}_days") for limit in (60, 90)],
    ).orderBy(F.desc("max_days_unsold"), "car_model", "region")


def claim_measures(claims: DataFrame) -> DataFrame:
    """What the premium rollup needs of clean claims, before any join."""
    amounts = [F.col(f"{part}_amount") for part in ("injury", "property", "vehicle")]
    return claims.select(
        "policy_id",
        F.coalesce((F.col("claim_rejected") == "Y").cast("int"), F.lit(0)).alias("is_rejected"),
        null_safe_sum(*amounts).alias("total_claim_amount"))


def premium_by_tier(policies: DataFrame, claims: DataFrame, joined_before: bool = True
                    ) -> DataFrame:
    """Premiums and claim exposure per tier; claims are summed per policy before they join.

    `claims` are fact rows, in which a claim appears once per policy row of its number; with
    `joined_before` off they are `claim_measures`, and the rows per number are counted here, on
    the policies' own shuffle.
    """
    per_policy = claims.groupBy("policy_id").agg(
        m.rows().alias("claims"), F.sum("is_rejected").alias("rejected"),
        m.exact_sum("total_claim_amount").alias("claimed"),
        m.rest_sum("total_claim_amount").alias("claimed_rest"))
    copies = F.lit(1)
    if not joined_before:
        copies = F.col("_copies")
        policies = policies.withColumn(
            "_copies", F.count("policy_number").over(Window.partitionBy("policy_number")))
    joined = policies.join(per_policy, F.col("policy_number") == F.col("policy_id"), "left")
    filed = F.coalesce(F.sum(F.col("claims") * copies), F.lit(0))
    rejected = F.coalesce(F.sum(F.col("rejected") * copies), F.lit(0))
    claimed = F.sum((F.col("claimed") * copies.cast("decimal(19,0)")).cast("decimal(38,9)"))
    rest = F.sum(F.col("claimed_rest") * copies)
    return joined.groupBy("policy_csl", "policy_csl_tier").agg(
        m.rows().alias("policy_count"),
        m.money_mean("policy_annual_premium").alias("avg_annual_premium"),
        m.money_sum("policy_annual_premium").alias("total_premium_revenue"),
        m.rounded_mean("policy_deductable").alias("avg_deductable"),
        m.rounded_mean("umbrella_limit").alias("avg_umbrella_limit"),
        filed.alias("total_claims_filed"),
        m.percent(rejected, F.greatest(filed, F.lit(1))).alias("overall_rejection_rate_pct"),
        F.coalesce(m.money_total(claimed, rest), F.lit(0.0)).alias("total_claims_exposure"),
    ).orderBy("policy_csl")
