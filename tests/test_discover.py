"""Value sketches, join paths, column matching and resumable generation."""

import itertools
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import discover, enrich, sketch
from tablewright.plans import fixed_values as fixed
from tablewright.plans import raw

RELATED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
TRUE_PATHS = {
    "nation.n_regionkey -> region.r_regionkey", "customer.c_nationkey -> nation.n_nationkey",
    "supplier.s_nationkey -> nation.n_nationkey", "orders.o_custkey -> customer.c_custkey",
    "lineitem.l_orderkey -> orders.o_orderkey", "lineitem.l_partkey -> part.p_partkey",
    "lineitem.l_suppkey -> supplier.s_suppkey"}


# ----------------------------------------------------------------------------------- sketches

def test_sketch_is_the_smallest_hashes(spark):
    rows = [("p" if i % 3 else "q", i % 700, None if i % 2 else str(i)) for i in range(4000)]
    df = spark.createDataFrame(rows + [(None, 1, "1")], "t string, a int, `b c` string").repartition(7)
    got = {}
    for r in sketch.sketches(df, "t", ["a", "b c"], 50).collect():
        got.setdefault((r.part, r.column_name), []).append(r.hash)
    for part, column in itertools.product("pq", ("a", "b c")):
        hashes = [r[0] for r in df.where(F.col("t") == part).where(F.col(f"`{column}`").isNotNull())
                  .select(F.xxhash64(F.col(f"`{column}`").cast("string"))).distinct().collect()]
        assert sorted(got[part, column]) == sorted(hashes)[:50]


def test_containment_of_small_columns_is_exact(spark):
    left = spark.createDataFrame([("l", i % 40) for i in range(4000)], "t string, a bigint")
    right = spark.createDataFrame([("r", i, None) for i in range(10, 9000)],
                                  "t string, b bigint, empty bigint")
    sizes, shares = sketch.containment([(left, "t", ["a"]), (right, "t", ["b", "empty"])], 64)
    assert sizes == {("l", "a"): 40, ("r", "b"): 64}
    assert shares[("l", "a"), ("r", "b")] == 30 / 40
    assert not any("empty" in place for pair in shares for place in pair)


def test_containment_of_large_columns_is_close(spark):
    a = spark.range(20_000).select(F.lit("a").alias("t"), F.col("id").alias("x"))
    b = spark.range(5_000, 40_000).select(F.lit("b").alias("t"), F.col("id").alias("y"))
    _, shares = sketch.containment([(a, "t", ["x"]), (b, "t", ["y"])])
    assert abs(shares[("a", "x"), ("b", "y")] - 0.75) < 0.12       # four standard errors
    assert abs(shares[("b", "y"), ("a", "x")] - 15 / 35) < 0.13


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([], "t string, a int")
    assert sketch.containment([(empty, "t", ["a"])]) == ({}, {})
    assert discover.join_paths({"x": empty, "y": empty, "z": empty.select(F.lit(1.5).alias("d"))}) == []
    assert discover.matched_columns(empty, "t", "r") == []


# --------------------------------------------------------------------------------- join paths

def test_true_join_paths_come_first(spark, sf_dir):
    related = {name: raw.read(spark, sf_dir, name) for name in RELATED}
    paths = discover.join_paths(related)
    assert {p.label for p in paths[:len(TRUE_PATHS)]} == TRUE_PATHS
    checked = {r.key_pair: r for r in discover.checked_paths(related, paths[:7]).collect()}
    assert all(r.unmatched_rows == 0 and r.total_rows > 0 for r in checked.values())
    assert len(checked) == 7


def test_best_key_of_each_column_of_raw_tables(spark, sf_dir):
    """Orphans, NULLs and other names on either side; the master file's ids are not all there."""
    tables = {name: getattr(raw, name)(spark, sf_dir).drop(fixed.SOURCE_FILE)
              for name in ("claims", "policy", "cars", "sales")}
    customers = raw.customers(spark, sf_dir)
    tables["customers"] = customers.where(F.col(fixed.SOURCE_FILE) == fixed.MASTER_SOURCE).drop(
        fixed.SOURCE_FILE)
    best = {}
    for p in discover.join_paths(tables):
        best.setdefault((p.table, p.column), (p.key_table, p.key))
    assert best["claims", "PolicyID"] == ("policy", "policy_number")
    assert best["policy", "customer_id"] == ("customers", "CustomerID")
    assert best["policy", "car_id"] == best["sales", "car_id"] == ("cars", "car_id")


def test_kinds_are_not_mixed_and_repeated_columns_are_no_keys(spark):
    a = spark.createDataFrame([(i % 9, str(i)) for i in range(90)], "k int, s string")
    b = spark.createDataFrame([(i, i % 3) for i in range(50)], "k long, v int")
    labels = [p.label for p in discover.join_paths({"a": a, "b": b})]
    assert "a.k -> b.k" in labels
    assert not any("s" in label.split(" -> ")[0].split(".")[1] for label in labels)
    assert all("b.v" not in label.split(" -> ")[1] for label in labels)


# ---------------------------------------------------------------------------- column matching

def test_assignment_is_of_greatest_weight():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n, m = map(int, rng.integers(1, 6, 2))
        weights = rng.integers(0, 5, (n, m)).astype(float)
        pairs = discover.assigned(weights)
        assert len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs) == min(n, m)
        some = itertools.permutations(range(max(n, m)), min(n, m))
        best = max(sum(weights[i, p] if n <= m else weights[p, i] for i, p in enumerate(choice))
                   for choice in some)
        assert sum(weights[i, j] for i, j in pairs) == best


def test_exchanged_and_renamed_columns(spark):
    colours, sizes = ["red", "green", "blue"], ["small", "large"]
    rows = [("ref", i, colours[i % 3], sizes[i % 2], None) for i in range(60)]
    rows += [("new", i, sizes[i % 2], None, colours[i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "src string, id int, colour string, size string, c string")
    found = {(a, b): c for a, b, c, _ in discover.matched_columns(df, "src", "ref")}
    assert found == {("new", "id"): "id", ("new", "colour"): "size", ("new", "c"): "colour"}
    united = discover.unified(df, "src", "ref", discover.matched_columns(df, "src", "ref"),
                              ["id", "colour", "size"])
    assert united.where("src = 'ref'").drop("src").exceptAll(
        united.where("src = 'new'").drop("src")).count() == 0


# ------------------------------------------------------------------------ resumable generation

def writing(folder, refuse=()):
    """A generator that leaves one file per prompt it was asked; raises on some."""
    def answer(prompt):
        with open(os.path.join(folder, f"{abs(hash(prompt))}-{os.urandom(4).hex()}"), "w") as f:
            f.write(prompt)
        if prompt in refuse:
            raise ValueError("no")
        return prompt.upper()
    return enrich.each(answer)


def asked(folder):
    out = []
    for name in os.listdir(folder):
        with open(os.path.join(folder, name)) as f:
            out.append(f.read())
        os.remove(os.path.join(folder, name))
    return sorted(out)


@pytest.mark.parametrize("at_once", [100_000, 2])
def test_second_run_asks_only_what_failed_or_is_new(spark, tmp_path, at_once):
    folder = str(tmp_path / "asked")
    os.mkdir(folder)
    store = str(tmp_path / "store")

    def run(prompts, refuse=(), model="m"):
        df = spark.createDataFrame(list(enumerate(prompts)), "id int, p string")
        out = enrich.generate_resumed(df, "p", writing(folder, refuse), model, store,
                                      at_once=at_once)
        assert out.columns == ["id", "generated_text", "generation_status", "model_name",
                               "generated_at", "reply_run"]
        return {r.id: (r.generated_text, r.generation_status) for r in out.collect()}

    first = run(["a", "b", "a", None, "c", ""], refuse=("b",))
    assert asked(folder) == ["", "a", "b", "c"]
    assert first == {0: ("A", "success"), 1: ("ERROR: no", "failed"), 2: ("A", "success"),
                     3: (None, "skipped"), 4: ("C", "success"), 5: first[5]}
    again = run(["a", "b", "a", None, "c", ""])
    assert asked(folder) == ["b"] and again == {**first, 1: ("B", "success")}
    assert run(["a", "b", "d"]) == {0: ("A", "success"), 1: ("B", "success"), 2: ("D", "success")}
    assert asked(folder) == ["d"]
    assert run(["a", "b", "d"]) and asked(folder) == []
    assert run(["a"], model="other") and asked(folder) == ["a"]
    assert run([None, None]) == {0: (None, "skipped"), 1: (None, "skipped")} and run([]) == {}
    assert asked(folder) == []


def test_unentered_round_is_not_read(spark, tmp_path):
    store = str(tmp_path / "store")
    df = spark.createDataFrame([(1, "a")], "id int, p string")
    broken = spark.createDataFrame([], enrich.STORED)
    broken.write.parquet(f"{store}/replies/left-over")
    out = enrich.generate_resumed(df, "p", enrich.each(str.upper), "m", store).collect()
    assert [(r.generated_text, r.reply_run) for r in out] == [("A", 1)]
    more = df.union(df).union(spark.createDataFrame([(2, None)], df.schema))
    kept = enrich.generate_resumed(more, "p", enrich.each(str.lower), "m", store).collect()
    assert sorted((r.id, r.generated_text) for r in kept)[:2] == [(1, "A"), (1, "A")]
    assert len(kept) == 3


def test_prompts_are_kept_twice_at_most(spark, tmp_path, monkeypatch):
    """What a run keeps beside its replies: its rows, and the prompts of its rounds."""
    monkeypatch.setattr(enrich, "shared_folder", lambda _, purpose: str(tmp_path / purpose))
    df = spark.range(1500).select("id", F.concat_ws("", *[
        F.sha2(F.concat_ws("-", "id", F.lit(i)), 256) for i in range(16)]).alias("p"))
    out = enrich.generate_resumed(df, "p", enrich.each(lambda p: p[:4]), "m",
                                  str(tmp_path / "store"), at_once=500)
    assert out.where("generation_status = 'success'").count() == 1500
    kept = sum(f.stat().st_size for f in (tmp_path / "generate").rglob("*.parquet"))
    assert kept < 1500 * 1024 * 2


def test_many_rounds_are_asked_in_one_job(spark, tmp_path):
    """How many jobs a run takes does not depend on how many prompts it may lose."""
    df = spark.createDataFrame([(i, f"p{i % 60}") for i in range(80)], "id int, p string")
    counts = {}
    for at_once in (100_000, 2):
        group = f"asked-{at_once}"
        spark.sparkContext.setJobGroup(group, group)
        out = enrich.generate_resumed(df, "p", enrich.each(str.upper), "m", str(tmp_path / group),
                                      at_once=at_once)
        assert sorted((r.id, r.generated_text) for r in out.collect()) == [
            (i, f"P{i % 60}") for i in range(80)]
        counts[at_once] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        stored = [f for f in (tmp_path / group / "replies").rglob("part-*.parquet")]
        assert at_once > 2 or len(stored) > 30
    spark.sparkContext.setJobGroup("", "")
    assert counts[2] <= counts[100_000] + 5


def test_interrupted_run_keeps_what_its_ended_tasks_stored(spark, tmp_path):
    folder, store = str(tmp_path / "asked"), str(tmp_path / "store")
    os.mkdir(folder)
    prompts = [f"p{i}" for i in range(24)]
    df = spark.createDataFrame([(p, p) for p in prompts], "name string, p string").repartition(1)
    answer = writing(folder)

    def breaks(some):
        if "p7" in some:
            time.sleep(4)
            os._exit(1)
        return answer(some)

    with pytest.raises(Exception, match="aborted"):
        enrich.generate_resumed(df, "p", breaks, "m", store, at_once=2)
    first = set(asked(folder))
    assert len(first) > 12 and "p7" not in first
    out = enrich.generate_resumed(df, "p", answer, "m", store, at_once=2).collect()
    assert sorted((r.name, r.generated_text, r.generation_status) for r in out) == sorted(
        (p, p.upper(), "success") for p in prompts)
    again = asked(folder)
    assert "p7" in again and set(again) | first == set(prompts) and len(again) < 12
    enrich.generate_resumed(df, "p", answer, "m", store, at_once=2)
    assert asked(folder) == []
