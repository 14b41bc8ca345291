"""Schema log, versioned publishing, incremental winners and rollups."""

import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablewright.sources import files, tables
from tablewright.sources.versions import VersionLog
from tablewright.streaming import ingest, schema_log


def drop(root, contents):
    for name, content in contents.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as handle:
            handle.write(content)


def test_versions_are_written_once(spark, tmp_path):
    log = VersionLog(spark, str(tmp_path / "log"))
    assert log.latest() == (0, {})
    log.put(1, {"a": 1})
    log.put(2, {"a": 2})
    assert log.all() == [(1, {"a": 1}), (2, {"a": 2})]
    with pytest.raises(PySparkException):
        log.put(2, {"a": 3})
    assert log.latest() == (2, {"a": 2})


def test_types_widen(spark):
    assert schema_log.widened("bigint", "double") == "double"
    assert schema_log.widened("timestamp", "date") == "timestamp"
    assert schema_log.widened("bigint", "date") == schema_log.widened("string", "bigint") == "string"
    assert schema_log.widened(None, "date") == schema_log.widened("date", None) == "date"
    rows = [("1", "1.5", "007", "2024-02-29", "2024-02-29", "true", None, "1"),
            (None, "-2e3", "1", "2024-03-01", "2024-03-01 10:00", "FALSE", None, "x")]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(8)))
    assert list(schema_log.inferred(df, df.columns).values()) == [
        "bigint", "double", "string", "date", "timestamp", "boolean", None, "string"]
    odd = spark.createDataFrame([("99999999999999999999", "2023-02-29", "NaN", "1d")],
                                ", ".join(f"c{i} string" for i in range(4)))
    assert list(schema_log.inferred(odd, odd.columns).values()) == [
        "double", "string", "string", "string"]


def test_schema_grows_with_the_files(spark, tmp_path, monkeypatch):
    root, target, checkpoint = (str(tmp_path / n) for n in ("in", "table", "check"))

    def run():
        ingest.ingest(spark, root, "*.csv", target, checkpoint, infer_types=True)
        return ingest.stored(spark, target, typed=True)

    drop(root, {"a.csv": "id,Value,day\n1,5,2024-01-31\n2,,\n"})
    first = run()
    assert dict(first.dtypes)["Value"] == "bigint" and dict(first.dtypes)["day"] == "date"
    drop(root, {"b.csv": "value,extra,id,none\n1.25,007,3,\n"})
    second = run()
    kinds = dict(second.dtypes)
    assert (kinds["Value"], kinds["extra"], kinds["none"]) == ("double", "string", "string")
    assert {(r.id, r.Value, r.extra) for r in second.collect()} == {
        (1, 5.0, None), (2, None, None), (3, 1.25, "007")}
    drop(root, {"c.csv": "id,day\nx,2024-01-01 10:30\n"})
    assert dict(run().dtypes)["id"] == "string"
    # Nothing new: no new version. The text is as it came.
    run()
    history = ingest.schema_history(spark, target).collect()
    assert max(r.version for r in history) == 3
    assert {r.column_name: r.since_batch for r in history if r.version == 3} == {
        "id": 0, "Value": 0, "day": 0, "extra": 1, "none": 1}
    assert {r.id for r in ingest.stored(spark, target).collect()} == {"1", "2", "3", "x"}
    # A repeated batch leaves the log as it is.
    log = schema_log.SchemaLog(spark, target)
    before = log.log.latest()
    assert log.merge({"ID": "bigint", "Extra": "bigint"}, 1) == before[0] == 3
    # The log alone names the columns: reading plans no look into the data files.
    monkeypatch.setattr(files, "read_header", None)
    with pytest.raises(ValueError):
        ingest.stored(spark, str(tmp_path / "nothing"))


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    root = str(tmp_path / "t")
    name = "kept_table"
    spec = tables.TableSpec(name, "about it", "gold", columns={"id": "the key"})
    tables.publish(spark.range(10), spec, path=root)
    broken = spark.range(10).select(F.when(F.col("id") > 8, F.raise_error(F.lit("broken")))
                                    .otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(PySparkException):
        tables.publish(broken, spec, path=root)
    assert spark.table(name).count() == 10
    # The new rows may come from the table itself; a reader that has begun can go on.
    reader = spark.read.parquet(os.path.join(root, sorted(os.listdir(root))[0]))
    tables.publish(spark.table(name).where("id < 4"), spec, path=root)
    assert spark.table(name).count() == 4 and reader.count() == 10
    for n in range(3):
        tables.publish(spark.range(n), spec, path=root)
        assert spark.table(name).count() == n
    assert len([f for f in os.listdir(root) if f.startswith(tables.VERSION)]) == 2
    # Other columns, then a table without a path, partitions and buckets.
    tables.publish(spark.range(3).withColumn("b", F.lit("x")), spec, path=root)
    assert spark.table(name).columns == ["id", "b"]
    assert [r.comment for r in tables.table_description(spark, name).collect()
            if r.col_name == "id"] == ["the key"]
    for option in ({"partition_by": ["b"]}, {"bucket_by": (2, "id")}):
        for n in (5, 7):
            rows = spark.range(n).withColumn("b", F.col("id") % 2)
            got = tables.publish(rows, tables.TableSpec("kept_other"), **option)
            assert got.count() == n and got.where("b = 1").count() == n // 2
    assert not [t.name for t in spark.catalog.listTables() if tables.VERSION[:-1] in t.name]


def test_winners_do_not_depend_on_the_order_of_batches(spark, tmp_path):
    from tablewright.operators import incremental, quality

    rng = random.Random(6)
    rows = [(rng.choice([None, *range(12)]), rng.randrange(50), f"v{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "k int, rank int, v string")

    def order(frame):
        return [F.col("rank"), F.col("v")]

    want = sorted(quality.keep_first(df, "k", order(df)).collect(), key=repr)
    parts = [spark.createDataFrame(rows[at::4], df.schema) for at in range(4)]
    for turn, batches in enumerate(([0, 1, 2, 3], [3, 3, 1, 0, 2, 2], [2, 0, 3, 1])):
        winners = incremental.Winners(
            incremental.Runs(spark, str(tmp_path / f"w{turn}")), "k", order)
        assert winners.current() is None
        for batch in batches:
            winners.update(batch, parts[batch])
            if turn == 2 and batch == 3:
                winners.compact()
                winners.update(0, parts[0])          # merged already: changes nothing
        assert sorted(winners.current().collect(), key=repr) == want


def test_a_batch_that_fails_changes_nothing(spark, tmp_path):
    from tablewright.operators.incremental import Runs

    runs = Runs(spark, str(tmp_path / "r"))
    runs.put(1, spark.range(5))
    with pytest.raises(PySparkException):
        runs.put(2, spark.range(5).select(F.when(F.col("id") > 3, F.raise_error(F.lit("x")))
                                          .otherwise(F.col("id")).cast("long").alias("id")))
    assert runs.read().count() == 5 and runs.read(without=1).count() == 0
    runs.put(2, spark.range(2))
    runs.put(2, spark.range(3))
    assert runs.read().count() == 8 and runs.read(without=2).count() == 5
    assert runs.settled(1) and not runs.settled(2) and not runs.settled(7)


def test_rollups_can_be_taken_back(spark, tmp_path):
    from tablewright.operators.incremental import Rollup, Runs
    from tablewright.plans import increments

    rest, money = increments._money("m", "amount")
    rollup = Rollup({"g": F.col("g"), **rest}, money, lambda parts: parts.groupBy("g").agg(
        F.sum("n").alias("n"), increments._money_sum("m").alias("total"),
        increments._money_mean("m").alias("mean")))

    def frame(rows):
        return spark.createDataFrame(rows, "g string, amount double")

    first = [("a", 0.1), ("a", 0.2), ("a", float("inf")), ("b", 1e300), (None, None), ("c", 5.0)]
    runs = Runs(spark, str(tmp_path / "r"))
    runs.put(0, rollup.partial(frame(first)))
    runs.put(1, rollup.partial(frame([("a", 0.3), ("d", None)]),
                               frame([("a", float("inf")), ("b", 1e300), ("c", 5.0)])))
    got = {r.g: (r.n, r.total, r["mean"]) for r in rollup.result(runs).collect()}
    assert got == {"a": (3, 0.6, 0.2), None: (1, None, None), "d": (1, None, None)}
    runs.compact(rollup.merged)
    assert {r.g: (r.n, r.total, r["mean"]) for r in rollup.result(runs).collect()} == got


def _clean_frames(spark, customers, policies, claims):
    """Clean tables of which only the columns that matter hold values."""
    texts = ("incident_type", "collision_type", "incident_state", "incident_city", "property_damage",
             "authorities_contacted", "police_report_available", "incident_date_raw",
             "claim_logged_on_raw", "claim_processed_on_raw")
    claim = spark.createDataFrame(claims, "claim_id long, policy_id long, claim_rejected string, "
                                          "injury_amount double, incident_severity string")
    return {
        "customers": spark.createDataFrame(
            customers, "customer_id long, region string, state string, balance int"),
        "policy": spark.createDataFrame(
            policies, "policy_number long, customer_id long, policy_csl string, "
                      "policy_annual_premium double").withColumns(
            {c: F.lit(1) for c in ("policy_deductable", "umbrella_limit", "car_id")}
            | {c: F.lit("x") for c in ("policy_state", "policy_bind_date")}),
        "claims": claim.withColumns(
            {c: F.lit("x") for c in texts}
            | {c: F.lit(2.0) for c in ("property_amount", "vehicle_amount")}
            | {c: F.lit(1) for c in ("bodily_injuries", "number_of_vehicles_involved", "witnesses")})}


def test_a_batch_takes_back_only_what_it_changes(spark, tmp_path):
    from tablewright.plans import gold, increments

    customers = [(1, "East", "a", 5), (2, "West", "b", 6)]
    policies = [(10, 1, "100/300", 7.0), (11, 2, "100/300", 8.0), (None, 1, "x", 1.0)]
    claims = [(100, 10, "Y", 1.5, "m"), (101, 11, "N", 2.5, "m"), (102, 12, "N", 3.5, "n"),
              (103, None, "Y", 4.5, "n"), (104, 10, "N", 5.5, "n")]
    # Batches: a claim only; a policy that claims waited for, and a second row of policy 10; customer
    # 1 moves, 2 only gets another balance.
    batches = {
        "claim": ([], [], [(105, 11, "Y", 6.5, "m"), (106, None, "N", 7.5, "m")]),
        "policy": ([], [(12, 3, "250/500", 9.0), (10, 2, "250/500", 9.5)], []),
        "customer": ([(1, "North", "a", 5), (2, "West", "b", 9)], [], [])}
    full = {"rejection_by_tier_region": lambda t: gold.rejection_by_tier_region(gold.fact_claims(
                t["claims"], t["policy"], t["customers"])),
            "severity": lambda t: gold.severity_breakdown(gold.fact_claims(
                t["claims"], t["policy"], t["customers"])),
            "premium_by_tier": lambda t: gold.premium_by_tier(
                gold.dim_policy(t["policy"]), gold.claim_measures(t["claims"]), False)}
    state = increments.IncrementalGold(spark, str(tmp_path / "unused"), rollups=tuple(full))
    taken_back = {("claim", "rejection_by_tier_region"): 0, ("claim", "severity"): 0,
                  ("policy", "rejection_by_tier_region"): 3, ("policy", "severity"): 3,
                  ("customer", "rejection_by_tier_region"): 2, ("customer", "severity"): 0}
    nothing = _clean_frames(spark, [], [], [])
    first = _clean_frames(spark, customers, policies, claims)
    for batch, rows in batches.items():
        moved = {c[0]: c for c in [*customers, *rows[0]]}
        new = _clean_frames(spark, *rows)
        now = _clean_frames(spark, list(moved.values()), policies + rows[1], claims + rows[2])
        for name, build in full.items():
            rollup = state.rollups[name]
            added, removed = state._change(name, new, first, now)
            if (batch, name) in taken_back:
                assert removed.count() == taken_back[batch, name], (batch, name)
            runs = increments.Runs(spark, str(tmp_path / f"{batch}-{name}"))
            runs.put(0, rollup.partial(*state._change(name, first, nothing, first)))
            runs.put(1, rollup.partial(added, removed))
            want = build(now)
            got = rollup.result(runs).select(want.columns)
            assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr), (batch, name)
