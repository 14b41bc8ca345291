"""KPI tables per business domain and their roll-up into JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import measures as m
from ..functions import text
from ..operators import enrich
from . import fixed_values as fixed


# ---------------------------------------------------------------------- policy portfolio

def policy_total(policies: DataFrame) -> DataFrame:
    return policies.agg(m.rows().alias("total_policies"))


def policy_by_tier(policies: DataFrame) -> DataFrame:
    return policies.groupBy("policy_csl_tier").agg(
        m.rows().alias("count"),
        m.money_mean("policy_annual_premium").alias("avg_premium"),
        m.money_sum("policy_annual_premium").alias("total_revenue"),
    ).orderBy("policy_csl_tier")


def policy_by_state(policies: DataFrame) -> DataFrame:
    return policies.groupBy("policy_state").agg(m.rows().alias("count")).orderBy(
        F.desc("count"), "policy_state")


def policy_umbrella(policies: DataFrame) -> DataFrame:
    limit = F.col("umbrella_limit")
    return policies.agg(
        m.count_where(limit > 0).alias("with_umbrella"),
        m.count_where(limit == 0).alias("without_umbrella"),
        m.rounded_mean(F.when(limit > 0, limit), 0).alias("avg_umbrella_amount"))


def policy_by_deductible(policies: DataFrame) -> DataFrame:
    return policies.groupBy("policy_deductable").agg(m.rows().alias("count")).orderBy(
        "policy_deductable")


# -------------------------------------------------------------------- claims performance

def _rejected() -> Column:
    return F.sum("is_rejected")


def _rejection_rate() -> Column:
    return m.percent(_rejected(), m.rows(), 1)


def claims_overall(claims: DataFrame) -> DataFrame:
    return claims.agg(
        m.rows().alias("total_claims"),
        _rejected().alias("total_rejected"),
        (m.rows() - _rejected()).alias("total_approved"),
        _rejection_rate().alias("rejection_rate_pct"),
        m.money_sum("total_claim_amount").alias("total_exposure"),
        m.money_mean("total_claim_amount").alias("avg_claim_amount"))


def claims_by_severity(claims: DataFrame) -> DataFrame:
    return claims.groupBy("incident_severity").agg(
        m.rows().alias("count"),
        _rejected().alias("rejected"),
        m.money_mean("total_claim_amount").alias("avg_amount"))


def claims_by_region(claims: DataFrame) -> DataFrame:
    return claims.where("region IS NOT NULL").groupBy("region").agg(
        m.rows().alias("count"),
        _rejected().alias("rejected"),
        _rejection_rate().alias("rejection_rate"),
        m.money_sum("total_claim_amount").alias("total_exposure"),
    ).orderBy(F.desc("rejection_rate"), "region")


def claims_by_tier(claims: DataFrame) -> DataFrame:
    return claims.where("policy_csl_tier IS NOT NULL").groupBy("policy_csl_tier").agg(
        m.rows().alias("count"), _rejection_rate().alias("rejection_rate"))


# ---------------------------------------------------------------------- customer profile

def customer_total(customers: DataFrame) -> DataFrame:
    return customers.agg(m.rows().alias("total_customers"))


def customers_by_region(customers: DataFrame) -> DataFrame:
    return customers.groupBy("region").agg(
        m.rows().alias("count"), m.rounded_mean("balance").alias("avg_balance"),
    ).orderBy(F.desc("count"), "region")


def customer_risk(customers: DataFrame) -> DataFrame:
    return customers.agg(
        F.sum("default_flag").alias("customers_with_default"),
        F.sum("hh_insurance").alias("customers_with_hh_insurance"),
        F.sum("car_loan").alias("customers_with_car_loan"),
        m.rounded_mean("balance").alias("avg_balance"))


def customers_by(customers: DataFrame, column: str) -> DataFrame:
    return customers.where(F.col(column).isNotNull()).groupBy(column).agg(
        m.rows().alias("count")).orderBy(F.desc("count"), column)


# ------------------------------------------------------------------------------ documents

JSON_OPTIONS = {"ignoreNullFields": "false"}


def _by_each(df: DataFrame, dimensions: list[str], **sums: Column) -> DataFrame:
    """Sums by every single dimension and in total, from one pass over `df`.

    The rows are reduced to one per combination of dimension values first; the grouping sets
    then expand only that small table. `_set` names the dimension, or `total`.
    """
    base = df.groupBy(*dimensions).agg(*[c.alias(name) for name, c in sums.items()])
    sets = [[F.col(d)] for d in dimensions] + [[]]
    # One bit per dimension, set where the dimension is not part of the grouping.
    ones = 2 ** len(dimensions) - 1
    labels = {ones - 2 ** (len(dimensions) - 1 - i): d for i, d in enumerate(dimensions)}
    label = F.create_map(*[F.lit(x) for bits, d in labels.items() for x in (bits, d)])
    grouped = base.groupingSets(sets, *[F.col(d) for d in dimensions]).agg(
        *[F.sum(name).alias(name) for name in sums], F.grouping_id().alias("_bits"))
    return grouped.withColumn(
        "_set", F.coalesce(label[F.col("_bits").cast("int")], F.lit("total")))


def _rows_of(group: str, order: list[Column], skip_null: bool = False, **fields: Column
             ) -> Column:
    """Rows of one grouping as an ordered array of structs; a handful of group rows."""
    member = F.col("_set") == group
    if skip_null:
        member = member & F.col(group).isNotNull()
    row = F.struct(*[c.alias(name) for name, c in fields.items()])
    entry = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], row.alias("row"))
    return F.transform(F.array_sort(F.collect_list(F.when(member, entry))),
                       lambda e: e["row"])


def _total(value: Column) -> Column:
    return F.max(F.when(F.col("_set") == "total", value))


def _total_object(**fields: Column) -> Column:
    return F.struct(*[_total(c).alias(name) for name, c in fields.items()])


def _document(name: str, title: str, grouped: DataFrame, **sections: Column) -> DataFrame:
    one = grouped.agg(*[c.alias(key) for key, c in sections.items()])
    return one.select(
        F.lit(name).alias("domain_name"), F.lit(title).alias("summary_title"),
        F.to_json(F.struct(*sections), JSON_OPTIONS).alias("kpi_data_json"))


def documents(policies: DataFrame, claims: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per domain: its name, title and all its KPIs as one JSON document.

    Each table is read once, whatever the number of KPIs (see `_by_each`).
    """
    n = F.col("n")

    def ratio(a: str, b: str = "n", digits: int = 2) -> Column:
        return F.round(F.col(a).cast("double") / F.nullif(F.col(b), F.lit(0)), digits)

    def dollars(a: str) -> Column:
        return m.money_total(F.col(a), F.col(f"{a}_rest"))

    def mean_dollars(a: str) -> Column:
        return m.money_ratio(F.col(a), F.col(f"{a}_rest"), n)

    limit = F.col("umbrella_limit")
    by_policy = _by_each(
        policies, ["policy_csl_tier", "policy_state", "policy_deductable"],
        n=m.rows(), premium=m.exact_sum("policy_annual_premium"),
        premium_rest=m.rest_sum("policy_annual_premium"),
        covered=m.count_where(limit > 0), bare=m.count_where(limit == 0),
        limits=F.sum(F.when(limit > 0, limit)))
    policy_doc = _document(
        "policy_portfolio", "Policy portfolio summary", by_policy,
        total_policies=_total(n),
        by_tier=_rows_of("policy_csl_tier", [F.col("policy_csl_tier")],
                         policy_csl_tier=F.col("policy_csl_tier"), count=n,
                         avg_premium=mean_dollars("premium"),
                         total_revenue=dollars("premium")),
        by_state=_rows_of("policy_state", [-n, F.col("policy_state")],
                          policy_state=F.col("policy_state"), count=n),
        umbrella=_total_object(with_umbrella=F.col("covered"), without_umbrella=F.col("bare"),
                               avg_umbrella_amount=ratio("limits", "covered", 0)),
        by_deductible=_rows_of("policy_deductable", [F.col("policy_deductable")],
                               policy_deductable=F.col("policy_deductable"), count=n))

    rate = m.percent(F.col("rejected"), n, 1)
    by_claim = _by_each(
        claims, ["incident_severity", "region", "policy_csl_tier"],
        n=m.rows(), rejected=F.sum("is_rejected"), amount=m.exact_sum("total_claim_amount"),
        amount_rest=m.rest_sum("total_claim_amount"))
    claim_doc = _document(
        "claims_performance", "Claims performance summary", by_claim,
        total_claims=_total(n),
        overall=_total_object(
            total_rejected=F.col("rejected"), total_approved=n - F.col("rejected"),
            rejection_rate_pct=rate, total_exposure=dollars("amount"),
            avg_claim_amount=mean_dollars("amount")),
        by_severity=_rows_of("incident_severity", [F.col("incident_severity")],
                             incident_severity=F.col("incident_severity"), count=n,
                             rejected=F.col("rejected"), avg_amount=mean_dollars("amount")),
        by_region=_rows_of("region", [-rate, F.col("region")], skip_null=True,
                           region=F.col("region"), count=n, rejected=F.col("rejected"),
                           rejection_rate=rate, total_exposure=dollars("amount")),
        by_coverage_tier=_rows_of("policy_csl_tier", [F.col("policy_csl_tier")],
                                  skip_null=True, policy_csl_tier=F.col("policy_csl_tier"),
                                  count=n, rejection_rate=rate))

    by_person = _by_each(
        customers, ["region", "education", "marital"],
        n=m.rows(), balances=F.sum("balance"), balanced=F.count("balance"),
        defaults=F.sum("default_flag"), insured=F.sum("hh_insurance"),
        loans=F.sum("car_loan"))
    mean_balance = ratio("balances", "balanced")
    customer_doc = _document(
        "customer_profile", "Customer profile summary", by_person,
        total_customers=_total(n),
        by_region=_rows_of("region", [-n, F.col("region")], region=F.col("region"), count=n,
                           avg_balance=mean_balance),
        risk_indicators=_total_object(
            customers_with_default=F.col("defaults"),
            customers_with_hh_insurance=F.col("insured"),
            customers_with_car_loan=F.col("loans"), avg_balance=mean_balance),
        **{f"by_{c}": _rows_of(c, [-n, F.col(c)], skip_null=True, **{c: F.col(c), "count": n})
           for c in ("education", "marital")})
    return policy_doc.unionByName(claim_doc).unionByName(customer_doc)


SUMMARY_PROMPT = (
    "{title}. Write an executive summary from these figures only, citing each number used, "
    "and close with two or three recommendations. Context: {context} Figures: {figures}"
)
# What a reader of each domain's summary wants to know.
CONTEXTS = {
    "policy_portfolio": "mix of tiers, premium income, umbrella uptake and spread over states.",
    "claims_performance": "rejections and exposure by severity, region and coverage tier.",
    "customer_profile": "where customers live, their balances, defaults and other products.",
}


def insight_report(docs: DataFrame, fn: enrich.Generator | None, model_name: str) -> DataFrame:
    """KPI documents with a generated executive summary each."""
    contexts = F.create_map(*[F.lit(x) for pair in CONTEXTS.items() for x in pair])
    prompt = text.template(SUMMARY_PROMPT, title=F.col("summary_title"),
                           context=contexts[F.col("domain_name")],
                           figures=F.col("kpi_data_json"))
    return enrich.generate(docs.withColumn("_prompt", prompt), "_prompt", fn, model_name,
                           output="ai_executive_summary", error_prefix=fixed.ERROR_PREFIX)
