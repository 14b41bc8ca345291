"""Every query by name: callables of (session, data folder)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins, profile, quality
from ..session import tune
from . import fixed_values as fixed
from . import gold, increments, issues, kpi, profiling, raw, retrieval, scoring, showcase, silver
from .layers import Layers

Query = Callable[[SparkSession, str], DataFrame]
TABLES = ["customers", "claims", "policy", "sales", "cars"]


def _on_layers(build: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Layers(tune(spark), sf_dir))


def _rule_counts(layers: Layers) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        quality.rule_counts(layers.typed(t), silver.CHECKS[t], t) for t in TABLES])


def _issues(layers: Layers) -> DataFrame:
    return issues.registry({t: layers.raw(t) for t in ("customers", "claims", "sales",
                                                       "policy")}).drop("detected_at")


def _orphans(left: str, left_key: str, right: str, right_key: str) -> Query:
    def build(layers: Layers) -> DataFrame:
        target = layers.raw(right)
        if right == "customers":
            target = target.where(F.col(fixed.SOURCE_FILE) == fixed.MASTER_SOURCE)
        return joins.orphans(layers.raw(left), target, left_key, right_key)

    return _on_layers(build)


def _orphan_sales(layers: Layers) -> DataFrame:
    keyed = layers.raw("sales").where("car_id IS NOT NULL").select(
        F.col(fixed.SOURCE_FILE).alias("source_table"), "car_id")
    return joins.orphans(keyed, layers.raw("cars"), "car_id", "car_id")


def _duplicates(layers: Layers) -> DataFrame:
    keyed = layers.raw("customers").select(
        F.coalesce("CustomerID", "Customer_ID", "cust_id").alias("customer_id"))
    return quality.duplicate_excess(keyed, "customer_id")


def _gold_sizes(layers: Layers) -> DataFrame:
    return profile.row_counts({
        "dim_customer": layers.dim_customer, "dim_policy": layers.dim_policy,
        "dim_car": layers.dim_car, "fact_claims": layers.fact_claims,
        "fact_sales": layers.fact_sales})


def _scored(layers: Layers) -> DataFrame:
    return scoring.score(layers.clean("claims"))


def _scores(scored: DataFrame) -> DataFrame:
    points = [f"{name.lower()}_points" for name, _ in fixed.SCORE_RULES]
    return scored.select("claim_id", "policy_id", "total_claim_amount",
                         F.round("amount_zscore", 6).alias("amount_zscore"), *points,
                         "anomaly_score", "priority_tier", "triggered_rules")


def _calibrated(layers: Layers) -> DataFrame:
    claims = layers.clean("claims")
    return _scores(scoring.score(claims, scoring.computed_statistics(claims)))


def queries() -> dict[str, Query]:
    on = _on_layers
    registry: dict[str, Query] = {}

    # harmonization, rules, quarantine
    registry["harmonize_customers"] = on(
        lambda x: silver.harmonized_customers(x.raw("customers")))
    registry["dedup_priority"] = on(lambda x: x.typed("customers"))
    for table in TABLES:
        registry[f"clean_{table}"] = on(lambda x, t=table: x.clean(t))
        registry[f"quarantine_{table}"] = on(lambda x, t=table: x.quarantined(t))
    registry["rule_counts"] = on(_rule_counts)
    registry["dq_registry"] = on(_issues)
    registry["duplicate_excess"] = on(_duplicates)
    registry["split_once"] = on(showcase.split_once)
    registry["email_check"] = showcase.email_check

    # star schema
    registry["dim_customer"] = on(lambda x: x.dim_customer)
    registry["dim_policy"] = on(lambda x: x.dim_policy)
    registry["dim_car"] = on(lambda x: x.dim_car)
    registry["dim_date"] = on(
        lambda x: gold.dim_date_spanning(x.clean("policy"), "policy_bind_date"))
    registry["fact_claims"] = on(lambda x: x.fact_claims)
    registry["fact_sales"] = on(lambda x: x.fact_sales)
    registry["rollup_rejection_by_tier_region"] = on(
        lambda x: gold.rejection_by_tier_region(x.fact_claims))
    registry["rollup_severity"] = on(lambda x: gold.severity_breakdown(x.fact_claims))
    registry["rollup_customers_by_region"] = on(
        lambda x: gold.customers_by_region(x.dim_customer))
    registry["rollup_unsold_aging"] = on(lambda x: gold.unsold_by_model_region(x.fact_sales))
    registry["rollup_premium_by_tier"] = on(
        lambda x: gold.premium_by_tier(x.dim_policy, gold.claim_measures(x.clean("claims")),
                                       joined_before=False))
    registry["gold_row_counts"] = on(_gold_sizes)

    # profiling of the raw tables
    registry["profile_row_counts"] = on(
        lambda x: profiling.table_sizes({t: x.raw(t) for t in TABLES}))
    registry["profile_schema_variants"] = on(
        lambda x: profiling.schema_variants(x.raw("customers")))
    registry["profile_nulls_customers"] = on(
        lambda x: profiling.customer_nulls(x.raw("customers")))
    registry["profile_region_values"] = on(
        lambda x: profiling.region_values(x.raw("customers")))
    registry["profile_education_values"] = on(
        lambda x: profiling.education_values(x.raw("customers")))
    registry["profile_swap"] = on(lambda x: profiling.swap_evidence(x.raw("customers")))
    registry["harmonized_union"] = on(lambda x: profiling.harmonized_union(x.raw("customers")))
    registry["profile_source_keys"] = on(lambda x: profiling.keys_by_source(x.raw("customers")))
    registry["anti_master"] = on(lambda x: profiling.master_only(x.raw("customers")))
    registry["profile_policy_keys"] = on(lambda x: profiling.policy_keys(x.raw("policy")))
    registry["suspicious_policies"] = on(
        lambda x: profiling.suspicious_policies(x.raw("policy")))
    registry["anti_policy_customer"] = _orphans("policy", "customer_id", "customers",
                                                "CustomerID")
    registry["anti_policy_car"] = _orphans("policy", "car_id", "cars", "car_id")
    registry["blank_rows"] = on(lambda x: profiling.blank_sales(x.raw("sales")))
    registry["blank_row_counts"] = on(
        lambda x: profiling.blank_sales_by_source(x.raw("sales")))
    registry["partial_rows"] = on(lambda x: profiling.partial_sales(x.raw("sales")))
    registry["usable_rows"] = on(lambda x: profiling.usable_sales(x.raw("sales")))
    registry["unsold_by_source"] = on(lambda x: profiling.unsold_by_source(x.raw("sales")))
    registry["aging_buckets"] = on(
        lambda x: profiling.aging_buckets(x.raw("sales"), raw.AS_OF))
    registry["dups_across_sources"] = on(
        lambda x: profiling.sales_across_sources(x.raw("sales")))
    registry["profile_cars"] = on(lambda x: profiling.car_profile(x.raw("cars")))
    registry["profile_car_mix"] = on(lambda x: profiling.car_distribution(x.raw("cars")))
    registry["anti_sales_car"] = on(_orphan_sales)
    registry["join_preview"] = on(showcase.join_preview)
    registry["profile_nulls_claims"] = on(lambda x: profiling.claim_nulls(x.raw("claims")))
    registry["profile_schema"] = on(showcase.described)
    registry["dups_key"] = on(lambda x: profiling.repeated_claims(x.raw("claims")))
    registry["missing_timestamp"] = on(lambda x: profiling.unlogged_claims(x.raw("claims")))
    registry["claim_log_dates"] = on(lambda x: profiling.claim_log_dates(x.raw("claims")))
    registry["anti_claims_policy"] = _orphans("claims", "PolicyID", "policy", "policy_number")
    registry["key_coverage"] = on(lambda x: profiling.claim_joinability(
        x.raw("claims"), x.raw("policy"), x.raw("customers")))
    registry["join_paths"] = showcase.join_paths
    registry["column_matches"] = on(showcase.column_matches)
    registry["matched_union"] = on(showcase.matched_union)
    registry["profile_numeric"] = on(
        lambda x: profile.numeric_profile(x.clean("claims"), scoring.AMOUNTS))
    registry["profile_amounts"] = on(
        lambda x: showcase.spread(scoring.with_total(x.clean("claims")), "total_claim_amount"))
    registry["profile_claim_categories"] = on(
        lambda x: profiling.claim_categories(x.clean("claims")))
    registry["profile_damage_reports"] = on(lambda x: profile.distribution(
        x.clean("claims"), ["property_damage", "police_report_available"]))

    # scoring
    registry["score_claims"] = on(lambda x: _scores(_scored(x)))
    registry["score_claims_calibrated"] = on(_calibrated)
    registry["score_tiers"] = on(lambda x: scoring.tier_distribution(_scored(x)))
    registry["score_summary"] = on(lambda x: scoring.score_summary(_scored(x)))
    registry["top_flagged"] = on(lambda x: scoring.top_flagged(_scored(x), "HIGH", 5))
    registry["top_medium"] = on(lambda x: scoring.top_flagged(_scored(x), "MEDIUM", 1))
    registry["scored_view"] = on(lambda x: showcase.scored_view(_scored(x)))
    registry["prompt_text"] = on(lambda x: showcase.flagged_prompts(_scored(x)))
    registry["scored_output"] = on(lambda x: showcase.scored_report(_scored(x)))
    registry["generation_status"] = on(
        lambda x: scoring.status_counts(scoring.scored_report(_scored(x))))
    registry["generation_resumed"] = on(lambda x: showcase.generation_resumed(_scored(x)))
    registry["generation_failures"] = on(lambda x: showcase.generation_failures(_scored(x)))
    registry["issue_report"] = on(showcase.issue_report)
    registry["issue_preview"] = on(showcase.issue_preview)
    registry["generate_in_sql"] = on(showcase.generate_in_sql)
    registry["extract_text_block"] = showcase.text_blocks

    # KPIs
    registry["kpi_policy_count"] = on(lambda x: kpi.policy_total(x.dim_policy))
    registry["kpi_policy_by_tier"] = on(lambda x: kpi.policy_by_tier(x.dim_policy))
    registry["kpi_policy_by_state"] = on(lambda x: kpi.policy_by_state(x.dim_policy))
    registry["kpi_umbrella"] = on(lambda x: kpi.policy_umbrella(x.dim_policy))
    registry["kpi_policy_by_deductible"] = on(lambda x: kpi.policy_by_deductible(x.dim_policy))
    registry["kpi_claims_overall"] = on(lambda x: kpi.claims_overall(x.fact_claims))
    registry["kpi_claims_by_severity"] = on(lambda x: kpi.claims_by_severity(x.fact_claims))
    registry["kpi_claims_by_region"] = on(lambda x: kpi.claims_by_region(x.fact_claims))
    registry["kpi_claims_by_tier"] = on(lambda x: kpi.claims_by_tier(x.fact_claims))
    registry["kpi_customer_count"] = on(lambda x: kpi.customer_total(x.dim_customer))
    registry["kpi_customers_by_region"] = on(lambda x: kpi.customers_by_region(x.dim_customer))
    registry["kpi_customer_risk"] = on(lambda x: kpi.customer_risk(x.dim_customer))
    registry["kpi_customers_by_education"] = on(
        lambda x: kpi.customers_by(x.dim_customer, "education"))
    registry["kpi_customers_by_marital"] = on(
        lambda x: kpi.customers_by(x.dim_customer, "marital"))
    registry["kpi_documents"] = on(
        lambda x: kpi.documents(x.dim_policy, x.fact_claims, x.dim_customer))
    registry["kpi_document_figures"] = on(showcase.document_figures)
    registry["insight_report"] = on(showcase.insight_report)

    # retrieval
    registry["topk_l2"] = showcase.topk
    registry["topk_l2_all"] = showcase.nearest_to_all
    registry["retrieval_log"] = showcase.retrieval_log
    registry["retrieval_answer"] = on(showcase.retrieval_answer)
    registry["doc_text"] = on(lambda x: retrieval.policy_documents(x.dim_policy))
    registry["lookup_by_number"] = on(lambda x: retrieval.lookup_by_number(x.dim_policy, 804))
    registry["top_premium"] = on(lambda x: retrieval.top_premiums(x.dim_policy))
    registry["umbrella_by_state"] = on(
        lambda x: retrieval.umbrella_in_state(x.dim_policy, "STATE_3"))
    registry["by_deductible"] = on(lambda x: retrieval.with_deductible(x.dim_policy, 2000))
    registry["tier_by_state"] = on(lambda x: retrieval.tier_by_state(x.dim_policy, "High"))

    registry["split_counts"] = on(showcase.split_counts)

    # kept up to date batch by batch
    registry["dedup_incremental"] = on(showcase.dedup_incremental)
    for name in increments.ROLLUPS:
        registry[f"incremental_{name}"] = on(
            lambda x, name=name: showcase.rollup_incremental(x, name))

    # sources and sinks
    registry["ingest_stream"] = on(showcase.ingest_stream)
    registry["ingest_rescued"] = on(showcase.ingest_rescued)
    registry["ingest_evolving"] = on(showcase.ingest_evolving)
    registry["ingest_json"] = on(showcase.ingest_json)
    registry["ingest_defaults"] = on(showcase.ingest_defaults)
    registry["ingest_batch_typed"] = on(showcase.ingest_typed)
    registry["publish_table"] = on(showcase.publish_table)
    registry["publish_after_failure"] = on(showcase.publish_after_failure)
    registry["publish_metadata"] = on(showcase.publish_metadata)
    registry["ingest_batch_tables"] = on(showcase.batch_tables)
    registry["landing_to_gold"] = on(showcase.landing_to_gold)
    registry["stored_pipeline"] = on(showcase.stored_pipeline)
    return registry
