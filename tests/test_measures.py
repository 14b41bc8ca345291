import math
from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F

from tablewright.functions import measures as m


def test_money_adds_up_exactly_in_any_order(spark):
    rng = np.random.default_rng(1)
    cents = [int(x) for x in rng.integers(-10**9, 10**9, 4000)]
    df = spark.createDataFrame([(c / 100,) for c in cents] + [(None,)], "x double")
    expected = Decimal(sum(cents)) / 100
    for parts in (1, 3, 16):
        row = df.repartition(parts).agg(m.exact_sum("x").alias("s"),
                                        m.money_sum("x").alias("r"),
                                        m.money_mean("x", 4).alias("a")).first()
        assert row.s == expected and row.r == float(expected)
        assert row.a == round(float(expected) / len(cents), 4)


def test_money_beyond_the_range_of_a_long(spark):
    df = spark.range(1000).select(F.lit(9e13).alias("x"))
    assert df.agg(m.exact_sum("x").alias("s")).first().s == Decimal(9 * 10**16)


def test_nothing_and_not_a_number(spark):
    df = spark.createDataFrame([(None,), (2.5,)], "x double")
    assert df.agg(m.money_sum("x").alias("s")).first().s == 2.5
    assert df.agg(m.money_mean("x").alias("s")).first().s == 2.5
    odd = df.unionByName(spark.createDataFrame([(float("nan"),)], "x double"))
    assert math.isnan(odd.agg(m.money_sum("x").alias("s")).first().s)
    assert math.isnan(odd.agg(m.money_mean("x").alias("s")).first().s)
    endless = df.unionByName(spark.createDataFrame([(float("inf"),)], "x double"))
    assert endless.agg(m.money_sum("x").alias("s")).first().s == math.inf
    assert df.where("x IS NULL").agg(m.money_mean("x").alias("s")).first().s is None


def test_no_amount_is_cut(spark):
    df = spark.createDataFrame([(1.0,), (2e15,), (0.00004,), (0.00004,), (0.00004,)], "x double")
    row = df.agg(m.exact_sum("x").alias("s"), m.money_sum("x", 5).alias("r"),
                 m.money_mean("x").alias("a")).first()
    assert row.s == Decimal("2000000000000001.000120000") and row.a == 400000000000000.2
    large = spark.createDataFrame([(1e18,), (3.0,), (1e300,)], "x double")
    assert large.agg(m.money_sum("x").alias("s")).first().s == 1e300
    assert large.where("x < 1e300").agg(m.money_sum("x").alias("s")).first().s == 1e18
    many = spark.range(3_000_000).select(F.lit(9e14).alias("x"))
    assert many.agg(m.money_sum("x").alias("s")).first().s == 2.7e21
    small = spark.createDataFrame([(-2.675,), (123456.78901,), (0.1,)], "x double")
    assert small.agg(m.exact_sum("x").alias("s")).first().s == Decimal("123454.214010000")


def test_half_is_rounded_up(spark):
    df = spark.createDataFrame([(281199.22,), (281199.23,)], "x double")
    assert df.agg(m.money_mean("x").alias("s")).first().s == 281199.23
