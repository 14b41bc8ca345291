"""Referential checks and key coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks of the table that `may_match` looks keys up in: 4 MB of bits, some 30 MB as broadcast.
MARKS = 1 << 25
PACKED, UNPACKED = "_texts", "_texts_as_they_are"
LONG_TEXT = 1 << 20
# Stands between packed texts, and before each that is not NULL.
BETWEEN, THERE = "\u0001", "="


def _slot(df: DataFrame, key: str) -> Column:
    value = F.col(key)
    if dict(df.dtypes)[key] in ("float", "double"):
        value = value + F.lit(0).cast(dict(df.dtypes)[key])      # -0.0 equals 0.0
    return F.pmod(F.xxhash64(value), F.lit(MARKS))


def may_match(df: DataFrame, key: str, keys: DataFrame, keys_key: str) -> DataFrame:
    """Rows of `df` whose key may be among `keys`, and those without a key; no row moves.

    Both keys have one type. The keys are marked in a table of MARKS bits, whose words Spark
    broadcasts; a row stays if its mark is set, which some rows' are by chance. When the table
    is full, all rows stay. What must be exact is left to a join that follows.
    """
    words = keys.select(_slot(keys, keys_key).alias("_slot")).groupBy(
        F.shiftright("_slot", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(_slot % 64 AS INT))")).alias("_marks"))
    looked_up = df.withColumn("_slot", _slot(df, key)).withColumn(
        "_of", F.shiftright("_slot", 6)).join(F.broadcast(words), F.col("_of") == F.col("_word"), "left")
    marked = F.getbit("_marks", (F.col("_slot") % 64).cast("int")) == 1
    return looked_up.where(F.col(key).isNull() | marked).select(*[f"`{c}`" for c in df.columns])


def left_packed(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join of tables without common columns; the texts of `left` travel as one text.

    A row on its way through a shuffle spends 16 bytes and more on every text, however short. For
    results that take all columns only: a packed column cannot be left out of the plan. Rows with very
    long texts, with one that is no UTF-8, which does not outlast the taking apart, or with one that holds
    the character between texts, keep them as they are.
    """
    texts = [c for c, kind in left.dtypes if kind == "string" and c != left_key]
    rest = [f"`{c}`" for c in left.columns if c not in texts]
    if not texts:
        return left.join(right, F.col(left_key) == F.col(right_key), "left")
    parts = [F.coalesce(F.concat(F.lit(THERE), F.col(f"`{c}`")), F.lit("")) for c in texts]
    free = reduce(Column.__and__, [
        F.coalesce(~F.contains(f"`{c}`", F.lit(BETWEEN)), F.lit(True)) for c in texts])
    whole = left.withColumn(PACKED, F.concat(*[
        piece for part in parts for piece in (F.lit(BETWEEN), part)][1:]))
    fits = free & F.is_valid_utf8(PACKED) & (F.octet_length(PACKED) < LONG_TEXT)
    packed = whole.select(*rest, F.when(fits, F.col(PACKED)).alias(PACKED),
                          F.when(~fits, F.array(*[f"`{c}`" for c in texts])).alias(UNPACKED))
    joined = packed.join(right, F.col(left_key) == F.col(right_key), "left").withColumn(
        PACKED, F.split(PACKED, BETWEEN))
    return joined.withColumns({c: F.when(F.col(UNPACKED).isNotNull(), F.col(UNPACKED)[i]).when(
        F.col(PACKED)[i] != "", F.substring(F.col(PACKED)[i], 2, LONG_TEXT))
        for i, c in enumerate(texts)}).select(
        *[f"`{c}`" for c in (*left.columns, *right.columns)])


def orphans(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of `left` whose key is not in `right`; a NULL key is never found.

    Keys move first, alone: those of `left` that are not in `right` mark the rows that may be in the
    result, and only these rows move whole. Both sides are reduced to their distinct keys before
    they move, so repeated keys cost one row per task. The partitions of the right keys are then left as they are by `coalesce`, which makes Spark
    put a plain exchange on both sides of the join: adaptive execution can so split the rows of
    a frequent left key, and replaces the join by a broadcast where the keys' size allows it.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = (
        right.where(F.col(right_key).isNotNull())
        .select(F.col(right_key).alias("_key")).distinct().coalesce(max(2, parts))
    )
    missing = left.where(F.col(left_key).isNotNull()).select(
        F.col(left_key).alias("_left")).distinct().join(
        keys, F.col("_left") == F.col("_key"), "left_anti")
    rows = may_match(left, left_key, missing, "_left")
    return rows.join(keys, F.col(left_key) == F.col("_key"), "left_anti")


def key_coverage(pairs: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """How well each candidate key pair links two tables.

    `pairs` holds (label, left, left key, right, right key). A left column is grouped once,
    whatever the number of tables it is held against: their distinct keys, marked by table, meet
    in one row per key, and rows are counted through the per-key counts.
    """
    by_column: dict[tuple[int, str], list[tuple[str, DataFrame, str, DataFrame, str]]] = {}
    for pair in pairs:
        by_column.setdefault((id(pair[1]), pair[2]), []).append(pair)
    reports = []
    for (_, left_key), group in by_column.items():
        per_key = group[0][1].groupBy(F.col(left_key).alias("_left")).agg(
            F.count(F.lit(1)).alias("n"))
        marked = [right.where(F.col(right_key).isNotNull())
                  .select(F.col(right_key).cast("string").alias("_right"), F.lit(i).alias("_table"))
                  for i, (_, _, _, right, right_key) in enumerate(group)]
        found = reduce(DataFrame.unionByName, marked).groupBy("_right").agg(
            *[F.max(F.col("_table") == i).alias(f"_in{i}") for i in range(len(group))])
        joined = per_key.join(found, F.col("_left").cast("string") == F.col("_right"), "left")
        matched = [F.sum(F.when(F.col(f"_in{i}"), F.col("n")).otherwise(0))
                   for i in range(len(group))]
        entries = F.array(*[F.struct(F.lit(pair[0]).alias("key_pair"),
                                     F.col(f"_m{i}").alias("matched_rows"))
                            for i, pair in enumerate(group)])
        reports.append(
            joined.agg(F.sum("n").alias("total_rows"),
                       *[c.alias(f"_m{i}") for i, c in enumerate(matched)])
            .select("total_rows", F.explode(entries).alias("e"))
            .select("e.key_pair", "total_rows", "e.matched_rows",
                    (F.col("total_rows") - F.col("e.matched_rows")).alias("unmatched_rows")))
    return reduce(DataFrame.unionByName, reports)
