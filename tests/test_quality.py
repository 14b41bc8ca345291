from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.operators import quality
from tablewright.plans import silver

CHECKS = quality.rules([
    ("has_id", "id", "id IS NOT NULL", "null id"),
    ("positive", "v", "v > 0", "bad v: {value}"),
])


def test_null_predicate_fails_with_its_own_reason(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, -1)], "id int, v int")
    failed = {r.id: r[quality.REASON] for r in quality.failing(df, CHECKS).collect()}
    assert failed == {2: "bad v: 0", 3: "null v", None: "null id, bad v: -1"}
    assert [r.id for r in quality.passing(df, CHECKS).collect()] == [1]


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)),
                          st.one_of(st.none(), st.integers(-2, 2))), min_size=1, max_size=30))
def test_split_is_exhaustive_and_disjoint(spark, data):
    df = spark.createDataFrame(data, "id int, v int")
    clean = quality.passing(df, CHECKS).collect()
    failed = quality.failing(df, CHECKS)
    assert len(clean) + failed.count() == len(data)
    assert failed.where(F.col(quality.REASON) == "").count() == 0
    counted = quality.rule_counts(df, CHECKS, "t").collect()
    assert all(r.passed_rows + r.failed_rows == r.total_rows == len(data) for r in counted)


def test_write_split_with_an_empty_half(spark, tmp_path):
    df = spark.createDataFrame([(1, 1), (2, 2)], "id int, v int")
    clean, failed = quality.write_split(df, CHECKS, str(tmp_path / "t"))
    assert clean.columns == ["id", "v"] and clean.count() == 2
    assert failed.columns == ["id", "v", quality.REASON] and failed.count() == 0


def test_keep_first_never_merges_rows_without_key(spark):
    df = spark.createDataFrame(
        [("a", 2), ("a", 1), (None, 1), (None, 1), ("b", 3)], "k string, o int")
    got = sorted(((r.k or "", r.o) for r in quality.keep_first(df, "k", [F.col("o")]).collect()))
    assert got == [("", 1), ("", 1), ("a", 1), ("b", 3)]


def test_keep_first_is_idempotent(layers):
    once = layers.typed("customers")
    order = [F.col("_source_file")]
    assert quality.keep_first(once, "customer_id", order).count() == once.count()
    assert once.where("customer_id IS NOT NULL").count() == \
        once.select("customer_id").distinct().count()


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    hot = spark.range(30_000).select(F.lit(1).alias("k"), F.col("id").alias("o"))
    cold = spark.range(100).select((F.col("id") + 2).cast("int").alias("k"),
                                   F.col("id").alias("o"))
    kept = quality.keep_first(hot.union(cold), "k", [F.col("o")])
    assert kept.count() == 101
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_blank_partial_usable(spark):
    df = spark.createDataFrame([(1, "x", 2), (None, None, None), (None, "y", 3)],
                               "a int, b string, c int")
    columns = ["a", "b", "c"]
    assert quality.blank_rows(df, columns).count() == 1
    assert quality.usable_rows(df, columns).count() == 2
    assert [r.b for r in quality.partial_rows(df, "b", ["a", "c"]).collect()] == ["y"]


def test_duplicate_excess(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "k int")
    assert tuple(quality.duplicate_excess(df, "k").first()) == (5, 2, 2)


def test_rule_boundaries(spark):
    policy = spark.createDataFrame(
        [(1, 1, 1, 0.01, 0), (2, 1, 1, 0.0, 0), (3, 1, 1, 5.0, -1), (4, 1, 1, 5.0, None)],
        "policy_number int, customer_id int, car_id int, policy_annual_premium double, "
        "umbrella_limit int")
    checks = silver.CHECKS["policy"]
    assert [r.policy_number for r in quality.passing(policy, checks).collect()] == [1]
    reasons = [r[quality.REASON] for r in
               quality.failing(policy, checks).orderBy("policy_number").collect()]
    assert reasons == ["invalid premium", "negative umbrella_limit", "null umbrella_limit"]
