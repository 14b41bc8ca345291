import json
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.operators import joins, profile, retrieve
from tablewright.operators.quantile import exact_quantile
from tablewright.plans import fixed_values as fixed
from tablewright.plans import gold, kpi, profiling
from tablewright.session import tune


def discrete_quantile(values, q):
    values = np.sort(values)
    return values[max(0, int(np.ceil(q * len(values))) - 1)]


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.95, 1.0])
@pytest.mark.parametrize("accuracy, bins", [(10_000, 1024), (100, 7)])
@pytest.mark.parametrize("shape", ["spread", "ties", "outlier", "single", "third"])
def test_quantile_is_exact(spark, q, accuracy, bins, shape):
    rng = np.random.default_rng(5)
    values = {
        "spread": rng.normal(size=3000),
        "ties": rng.integers(0, 7, 3000).astype(float),
        "outlier": np.append(rng.random(2000), 1e12),
        "single": np.array([4.5]),
        "third": np.append(np.full(1000, 0.5), rng.random(2000)),
    }[shape]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    got = exact_quantile(df, "x", q, accuracy, bins).first()["quantile"]
    assert got == discrete_quantile(values, q)


def test_quantile_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantile(df, "x", 0.5).first()["quantile"] is None


def test_orphans_with_hot_and_missing_keys(spark):
    left = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None)
        .otherwise(F.col("id")).alias("k"), "id")
    right = spark.createDataFrame([(7,), (7,), (2,), (5,), (None,)], "r long")
    got = joins.orphans(left, right, "k", "r")
    expected = left.join(right, F.col("k") == F.col("r"), "left_anti")
    assert got.columns == ["k", "id"]
    assert got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0


def test_key_coverage(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "a int")
    right = spark.createDataFrame([(1,), (1,), (3,)], "b int")
    row = joins.key_coverage([("a -> b", left, "a", right, "b")]).first()
    assert tuple(row) == ("a -> b", 4, 2, 2)


def test_hot_policy_is_split_by_the_join(spark):
    """A third of all claims on one policy: the join splits that partition, result is whole."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        claims = spark.range(0, n, 1, 8).select(
            F.col("id").alias("claim_id"),
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).alias("policy_id"),
            *[F.lit("x").alias(c) for c in (
                "incident_severity", "incident_type", "collision_type", "incident_state",
                "incident_city", "authorities_contacted", "property_damage",
                "police_report_available", "incident_date_raw", "claim_logged_on_raw",
                "claim_processed_on_raw")],
            F.lit("Y").alias("claim_rejected"),
            *[F.rand(1).alias(f"{p}_amount") for p in ("injury", "property", "vehicle")],
            *[F.lit(1).alias(c) for c in (
                "number_of_vehicles_involved", "bodily_injuries", "witnesses")])
        policy = spark.range(500).select(
            F.col("id").alias("policy_number"), F.lit("100/300").alias("policy_csl"),
            F.lit(500).alias("policy_deductable"), F.lit(1.0).alias("policy_annual_premium"),
            (F.col("id") % 50).alias("customer_id"))
        customers = spark.range(50).select(
            F.col("id").alias("customer_id"), F.lit("East").alias("region"),
            F.lit("S").alias("state"))
        fact = gold.fact_claims(claims, policy, customers)
        rows = fact.collect()
        assert len(rows) == n and all(r.region == "East" for r in rows)
        assert "isSkew=true" in fact._jdf.queryExecution().executedPlan().toString() or \
            "skewed" in fact._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def brute_force(queries, corpus, k):
    out = {}
    for qid, q in queries:
        ranked = sorted((float(sum((np.float64(a) - np.float64(b)) ** 2
                                   for a, b in zip(v, q, strict=True))), cid)
                        for cid, v in corpus)
        out[qid] = [cid for _, cid in ranked[:k]]
    return out


@pytest.mark.parametrize("bound", [4096, 7])
def test_topk_against_brute_force(spark, monkeypatch, bound):
    """Large blocks and small ones give the same, with many ties among the distances."""
    monkeypatch.setattr(retrieve, "BLOCK", bound)
    monkeypatch.setattr(retrieve, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(3)
    corpus = [(i, [float(x) for x in rng.integers(0, 4, 5)]) for i in range(200)]
    queries = [(i, [float(x) for x in rng.integers(0, 4, 5)]) for i in range(6)]
    schema = "{} long, v array<float>"
    stored = spark.createDataFrame([*corpus, (999, None)], schema.format("c")).repartition(4)
    hits = retrieve.topk_l2(spark.createDataFrame(queries, schema.format("q")), stored,
                            "q", "c", "v", 7)
    got = {}
    for r in hits.orderBy("q", "rank").collect():
        got.setdefault(r.q, []).append(r.c)
        assert r.confidence == pytest.approx(1 / (1 + r.distance))
    assert got == brute_force(queries, corpus, 7)


def test_topk_when_a_third_of_the_corpus_is_one_vector(spark):
    corpus = spark.range(9000).select(
        F.format_string("d%05d", "id").alias("c"),
        F.when(F.col("id") % 3 == 0, F.array(F.lit(0.0), F.lit(0.0)))
        .otherwise(F.array(F.col("id").cast("double"), F.lit(1.0))).alias("v"))
    queries = spark.createDataFrame([("a", [0.0, 0.0])], "q string, v array<double>")
    hits = retrieve.topk_l2(queries, corpus, "q", "c", "v", 4).orderBy("rank").collect()
    assert [(r.q, r.c, r.distance) for r in hits] == [
        ("a", f"d{i:05d}", 0.0) for i in (0, 3, 6, 9)]


def test_topk_of_a_small_corpus(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id long, v array<float>")
    hits = retrieve.topk_l2(df.withColumnRenamed("id", "q"), df, "q", "id", "v", 5)
    assert hits.count() == 4
    assert retrieve.topk_l2(df.where("false").withColumnRenamed("id", "q"), df, "q", "id",
                            "v", 5).count() == 0


def test_one_rule_for_bad_vectors_and_any_number_of_questions(spark):
    """NULL vectors, NULL and infinite elements and other lengths take no part."""
    nan, inf = float("nan"), float("inf")
    corpus = spark.createDataFrame(
        [(1, [0.0, 1.0]), (2, [1.0]), (3, None), (4, [0.0, None]), (5, [nan, 0.0]),
         (6, [inf, 0.0]), (7, []), (8, [5.0, 5.0])], "id long, v array<double>")
    good = [(i, [float(i % 7), 1.0]) for i in range(3000)]
    bad = [(10_000, None), (10_001, [None, 1.0]), (10_002, [nan, 1.0]), (10_003, [])]
    short = [(20_000, [1.0])]
    for some in (good[:1], good):
        queries = spark.createDataFrame(some + bad + short, "q long, v array<double>")
        got = {}
        for r in retrieve.topk_l2(queries, corpus, "q", "id", "v", 2).collect():
            got.setdefault(r.q, set()).add(r.id)
        assert got == {**{q: {1, 8} for q, _ in some}, 20_000: {2}}


def test_topk_skips_what_pivots_rule_out(spark, monkeypatch):
    """Clusters, twins and both ends of the range of doubles: same rows, fewer distances."""
    monkeypatch.setattr(retrieve, "BLOCK", 500)
    monkeypatch.setattr(retrieve, "GROUP", 20)
    monkeypatch.setattr(retrieve, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 100, (12, 6))
    points = [(i, [float(x) for x in centres[i % 12] + rng.normal(0, 1, 6)])
              for i in range(480)]
    points += [(2000 + i, points[i % 3][1]) for i in range(100)]
    points += [(3000 + i, [x, 0.0, 0.0, 0.0, 0.0, 0.0])
               for i, x in enumerate([1e200, -1e200, 1e-200, -1e-200, 3e-170, 1e154])]
    corpus = spark.createDataFrame(points, "c long, v array<double>").repartition(3)
    asked = corpus.withColumnRenamed("c", "q")
    with np.errstate(over="ignore"):
        expected = brute_force(points, points, 5)
    got = {}
    for r in retrieve.topk_l2(asked, corpus, "q", "c", "v", 5).orderBy("q", "rank").collect():
        got.setdefault(r.q, []).append(r.c)
    assert got == expected
    work = retrieve.distances_computed(asked, corpus, "q", "c", "v", 5).first()
    assert work.pairs == len(points) ** 2
    assert 0 < work.scored == round(work.share * len(points) ** 2) < 0.4 * len(points) ** 2
    empty = corpus.where("false")
    assert tuple(retrieve.distances_computed(asked, empty, "q", "c", "v", 5).first()) == (
        0, 0, None)


def test_log_and_context(spark):
    hits = spark.createDataFrame(
        [(1, 20, 2, 0.25), (1, 10, 1, 0.5)], "q int, c int, rank int, confidence double")
    log = retrieve.retrieval_log(hits, "q", "c", "%.4f").first()
    assert tuple(log) == (1, "10, 20", "0.5000, 0.2500", 2)
    texts = hits.withColumn("text", F.concat(F.lit("t"), "c"))
    assert retrieve.assemble_context(texts, "q", "c", "text").first().context == \
        "[10]: t10\n\n[20]: t20"


def test_fixed_calendar(spark):
    days = gold.dim_date(spark)
    assert days.count() == 4018
    first, last = (days.orderBy(o).first() for o in ("date_key", F.desc("date_key")))
    assert (first.date_key, last.date_key) == ("20100101", "20201231")
    assert (first.day_name, first.day_of_week, first.is_weekend) == ("Friday", 6, 0)
    assert days.where("is_weekend = 1 AND day_name NOT IN ('Saturday','Sunday')").count() == 0


def scans(df, column):
    """Scans in the plan that read a column."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return len(re.findall(rf"Relation \[[^\]]*\b{column}#", plan))


def test_rollups_join_what_they_use(layers):
    severity = gold.severity_breakdown(layers.fact_claims)
    for df in (severity, kpi.claims_overall(layers.fact_claims),
               kpi.claims_by_severity(layers.fact_claims), kpi.claims_by_tier(layers.fact_claims)):
        assert scans(df, "c_custkey") == 0 and scans(df, "o_orderkey") == 1
    lean = gold.premium_by_tier(layers.dim_policy, gold.claim_measures(layers.clean("claims")),
                                joined_before=False)
    assert scans(lean, "o_orderkey") == 1 and scans(lean, "c_custkey") == 0
    assert lean.collect() == gold.premium_by_tier(layers.dim_policy, layers.fact_claims).collect()


def test_premiums_when_policy_numbers_repeat(spark):
    policy = spark.createDataFrame(
        [(1, "100/300", "Low", 500, 10.0, 0), (1, "100/300", "Low", 500, 20.0, 0),
         (2, "100/300", "Low", 500, 30.0, 0), (None, "100/300", "Low", 500, 1.0, 0)],
        "policy_number long, policy_csl string, policy_csl_tier string, policy_deductable int, "
        "policy_annual_premium double, umbrella_limit int")
    claims = spark.createDataFrame(
        [(1, 1, 5.0), (1, 0, 6.0), (2, 0, 2e16), (None, 1, 7.0)],
        "policy_id long, is_rejected int, total_claim_amount double")
    fact = claims.join(policy.select("policy_number"),
                       F.col("policy_id") == F.col("policy_number"), "left").drop("policy_number")
    lean = gold.premium_by_tier(policy, claims, joined_before=False).collect()
    assert lean == gold.premium_by_tier(policy, fact).collect()
    assert lean[0].total_claims_filed == 9 and lean[0].total_claims_exposure == 2e16 + 44


def test_calibration_reads_claims_three_times(layers):
    from tablewright.plans import scoring
    claims = layers.clean("claims")
    scored = scoring.score(claims, scoring.computed_statistics(claims))
    assert scans(scored, "l_orderkey") <= 4


def test_preview_of_tied_policies_keeps_holders_and_cars(spark):
    from tablewright.plans import profiling
    n = 200
    policy = spark.range(n).repartition(8).select(
        F.lit(1).cast("long").alias("policy_number"), F.lit("2000-01-01").alias("policy_bind_date"),
        F.lit("S").alias("policy_state"), F.lit("1").alias("policy_annual_premium"),
        F.col("id").alias("customer_id"), F.col("id").alias("car_id"))
    customers = spark.range(n).select(
        F.lit(fixed.MASTER_SOURCE).alias(fixed.SOURCE_FILE), F.col("id").alias("CustomerID"),
        *[F.lit("x").alias(c) for c in ("Region", "State", "City", "Job", "Marital", "Education")])
    cars = spark.range(n).select(F.col("id").alias("car_id"), *[
        F.lit("y").alias(c) for c in ("name", "model", "fuel", "transmission")])
    rows = profiling.join_preview(policy, customers, cars).collect()
    assert len(rows) == 100 and all(r.region == "x" and r.car_name == "y" for r in rows)


def test_orphans_with_a_hot_key(spark):
    from tablewright.operators import joins
    left = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(0, 30_000, 2).select(F.col("id").alias("r")).unionByName(
        spark.createDataFrame([(None,), (4,), (4,)], "r long"))
    got = joins.orphans(left.unionByName(spark.createDataFrame([(None, 1)], "k long, id long")),
                        right, "k", "r")
    assert got.count() == 30_000 - 10_000 + 1


def test_facts_keep_their_grain(layers):
    assert layers.fact_claims.count() == layers.clean("claims").count()
    assert layers.fact_sales.count() == layers.clean("sales").count()


def test_rollups_add_up(layers):
    fact = layers.fact_claims
    total = fact.agg(F.count("*"), F.sum("is_rejected")).first()
    for rollup in (gold.rejection_by_tier_region(fact), gold.severity_breakdown(fact)):
        assert tuple(rollup.agg(F.sum("total_claims"), F.sum("rejected_claims")).first()) == \
            tuple(total)
    by_tier = gold.premium_by_tier(layers.dim_policy, fact)
    assert by_tier.agg(F.sum("policy_count")).first()[0] == layers.dim_policy.count()


def test_age_limits_are_strict_in_the_rollup(spark):
    sales = spark.createDataFrame(
        [("m", "r", d, 1.0, 1.0, 0) for d in (60, 61, 90, 91)],
        "car_model string, region string, days_unsold int, revenue_at_risk double, "
        "original_selling_price double, is_sold int")
    row = gold.unsold_by_model_region(sales).first()
    assert (row.unsold_over_60_days, row.unsold_over_90_days) == (3, 1)


def test_documents_agree_with_the_kpi_tables(layers):
    docs = {r.domain_name: json.loads(r.kpi_data_json) for r in kpi.documents(
        layers.dim_policy, layers.fact_claims, layers.dim_customer).collect()}

    def rows(df):
        return [r.asDict() for r in df.collect()]

    policy, claims, people = (docs[d] for d in (
        "policy_portfolio", "claims_performance", "customer_profile"))
    assert policy["total_policies"] == layers.dim_policy.count()
    assert policy["by_state"] == rows(kpi.policy_by_state(layers.dim_policy))
    assert policy["by_deductible"] == rows(kpi.policy_by_deductible(layers.dim_policy))
    assert policy["umbrella"] == rows(kpi.policy_umbrella(layers.dim_policy))[0]
    for ours, table in ((policy["by_tier"], kpi.policy_by_tier(layers.dim_policy)),
                        (claims["by_region"], kpi.claims_by_region(layers.fact_claims)),
                        (people["by_region"], kpi.customers_by_region(layers.dim_customer)),
                        (people["by_education"],
                         kpi.customers_by(layers.dim_customer, "education")),
                        (people["by_marital"],
                         kpi.customers_by(layers.dim_customer, "marital")),
                        (claims["by_severity"], kpi.claims_by_severity(layers.fact_claims)
                         .orderBy("incident_severity")),
                        (claims["by_coverage_tier"], kpi.claims_by_tier(layers.fact_claims)
                         .orderBy("policy_csl_tier"))):
        expected = rows(table)
        assert len(ours) == len(expected)
        for a, b in zip(ours, expected, strict=True):
            assert a == pytest.approx(b) if not any(
                isinstance(v, str) or v is None for v in b.values()) else {
                k: pytest.approx(v) if isinstance(v, float) else v for k, v in b.items()} == a
    assert people["risk_indicators"] == pytest.approx(
        rows(kpi.customer_risk(layers.dim_customer))[0])
    overall = rows(kpi.claims_overall(layers.fact_claims))[0]
    assert claims["total_claims"] == overall.pop("total_claims")
    assert claims["overall"] == pytest.approx(overall)


def test_documents_keep_missing_values(spark, layers):
    none = layers.dim_policy.where("false")
    doc = kpi.documents(none, layers.fact_claims, layers.dim_customer).where(
        "domain_name = 'policy_portfolio'").first()
    assert json.loads(doc.kpi_data_json)["umbrella"]["avg_umbrella_amount"] is None


def test_null_profile_by_group(spark):
    df = spark.createDataFrame([("s", 1, None), ("s", None, None), ("t", 1, 1)],
                               "g string, a int, b int")
    got = profile.null_profile(df, {"a": F.col("a"), "b": F.col("b")}, ["g"]).collect()
    assert sorted(tuple(r) for r in got) == [
        ("s", "a", 2, 1), ("s", "b", 2, 2), ("t", "a", 1, 0), ("t", "b", 1, 0)]


def test_harmonized_union_takes_the_regional_sources(spark, layers):
    given = layers.raw("customers").dtypes
    rows = [{"_source_file": "customers_2", "Customer_ID": 2, "Edu": "primary"},
            {"_source_file": "customers_5", "CustomerID": 5, "Region": "E", "Education": "terto"},
            {"_source_file": "customers_6", "CustomerID": 6, "Education": "single",
             "Marital_status": "secondary"},
            {"_source_file": "customers_7", "CustomerID": 7, "Region": "East"}]
    df = spark.createDataFrame([tuple(r.get(name) for name, _ in given) for r in rows],
                               ", ".join(f"`{name}` {kind}" for name, kind in given))
    got = profiling.harmonized_union(df).orderBy("customer_id").select(
        "source_table", "customer_id", "region", "marital_status", "education").collect()
    assert [tuple(r) for r in got] == [
        ("customers_2", 2, None, None, "primary"), ("customers_5", 5, "East", None, "tertiary"),
        ("customers_6", 6, None, "single", "secondary")]


def test_orphans_move_only_rows_that_may_be_orphans(spark):
    left = spark.range(20_000).select(F.col("id").cast("int").alias("k"), "id")
    got = joins.orphans(left, spark.range(19_990).select(F.col("id").alias("r")), "k", "r")
    assert sorted(r.k for r in got.collect()) == list(range(19_990, 20_000))
    missing = spark.range(19_990, 20_000).select(F.col("id").cast("int").alias("m"))
    assert 10 <= joins.may_match(left, "k", missing, "m").count() < 100


@pytest.mark.parametrize("kind", ["double", "float", "string"])
def test_rows_that_may_match_include_all_that_do(spark, kind):
    left = spark.createDataFrame([(-0.0,), (0.0,), (2.0,), (float("nan"),), (None,)], "x double") \
        .select(F.col("x").cast(kind).alias("k"))
    keys = spark.createDataFrame([(0.0,), (float("nan"),), (None,)], "y double").select(
        F.col("y").cast(kind).alias("m")).distinct()
    whole = left.join(keys, F.col("k") == F.col("m"), "left_semi").count()
    got = joins.may_match(left, "k", keys, "m")
    assert got.where("k IS NULL").count() == left.where("k IS NULL").count()
    assert got.join(keys, F.col("k") == F.col("m"), "left_semi").count() == whole


def test_close_vectors_are_those_that_squares_finds(monkeypatch):
    """Distances within the bar are exact to the last bit, and few are computed one by one."""
    from tablewright.operators import retrieve

    rng = np.random.default_rng(3)
    for scale, dims in ((1, 64), (1e-160, 5), (1e154, 3), (1e6, 1)):
        cells, points = (rng.normal(5, 1, (dims, n)) * scale for n in (300, 20))
        points[:, 0] = cells[:, 7]
        with np.errstate(over="ignore"):
            every = retrieve._squares(cells, points)
        bar = np.sort(every, axis=1)[:, 4]
        which, found = retrieve._close(cells, points, bar)
        inside = every <= bar[:, None]
        assert list(which) == list(range(20))
        assert (found[inside] == every[inside]).all()
    cells, points = rng.normal(0, 1, (64, 4096)), rng.normal(0, 1, (64, 64))
    order, radii, starts, pivots = retrieve._grouped(cells)
    cells = cells[:, order].copy()
    asked = []
    whole = retrieve._squares
    monkeypatch.setattr(retrieve, "_squares", lambda c, p: (
        asked.append(c.shape[1] * p.shape[1]), whole(c, p))[1])
    best = retrieve._Best(5, pa.array(range(64)), order)
    retrieve._meet(best, points, cells, order, radii, starts, pivots)
    expected = np.sort(whole(cells, points), axis=1)[:, :5]
    assert (best.distance == expected).all()
    assert sum(asked) < 0.5 * best.scored.sum()


def test_packed_join_gives_the_rows_of_a_plain_one(spark):
    left = spark.createDataFrame(
        [(1, "a", None, "", 2.5), (1, 'q"\\', "x,\n\t", " b ", None), (None, None, None, None, 0.1),
         (7, "ü 😀", "[]", "null", -0.0), (1, "a", None, "", 2.5)],
        "k int, t string, `u v` string, w string, d double")
    right = spark.createDataFrame([(1, "one"), (1, "uno"), (None, "none")], "rk int, name string")
    plain = left.join(right, F.col("k") == F.col("rk"), "left")
    packed = joins.left_packed(left, right, "k", "rk")
    assert packed.dtypes == plain.dtypes
    assert Counter(packed.collect()) == Counter(plain.collect())
    odd = left.withColumn("t", F.when(F.col("t") == "a", F.unhex(F.lit("61FF")).cast("string"))
                          .when(F.col("k") == 7, F.repeat(F.lit("long"), 1 << 18)).otherwise(F.col("t")))
    seen = [*(F.hex(c) for c in ("t", "u v", "w")), "d", "name"]
    plain = odd.join(right, F.col("k") == F.col("rk"), "left").select(*seen)
    assert Counter(joins.left_packed(odd, right, "k", "rk").select(*seen).collect()) == Counter(
        plain.collect())
    # A text key stays as it is, and a table without other texts has nothing to pack.
    named = right.select("name")
    assert joins.left_packed(named, right.toDF("rk", "other"), "name", "other").count() == 3


def test_stored_facts_move_their_texts_packed(layers):
    parts = [layers.clean(t) for t in ("claims", "policy", "customers")]
    plain, whole = gold.fact_claims(*parts), gold.fact_claims(*parts, whole=True)
    assert whole.dtypes == plain.dtypes and Counter(whole.collect()) == Counter(plain.collect())
    cars = layers.clean("sales"), layers.clean("cars")
    plain, whole = gold.fact_sales(*cars), gold.fact_sales(*cars, whole=True)
    assert whole.dtypes == plain.dtypes and Counter(whole.collect()) == Counter(plain.collect())


def test_write_into_two_folders_sorts_nothing(spark, tmp_path):
    tune(spark)
    spark.sql(f"CREATE TABLE halves (v BIGINT, p BOOLEAN) USING parquet PARTITIONED BY (p) "
              f"LOCATION '{tmp_path}'")
    try:
        plan = spark.sql("EXPLAIN INSERT INTO halves SELECT id, id % 2 = 0 FROM range(9)").first()[0]
        assert "WriteFiles" in plan and "Sort" not in plan
    finally:
        spark.sql("DROP TABLE halves")


def test_packed_join_takes_texts_apart_without_a_parser(spark):
    """Texts with the character between packed ones, and such as look like its marks."""
    left = spark.createDataFrame(
        [(1, "=", "\x01b", ""), (1, "x\x01", None, "="), (None, "\x00", "\x01", "a=b"), (2, "", "", None),
         (3, None, None, None)], "k int, t string, `u v` string, w string")
    right = spark.createDataFrame([(1, "one"), (3, None)], "rk int, name string")
    packed = joins.left_packed(left, right, "k", "rk")
    assert Counter(packed.collect()) == Counter(
        left.join(right, F.col("k") == F.col("rk"), "left").collect())
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    assert "json" not in plan and plan.count("split(") == 1
