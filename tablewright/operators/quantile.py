"""Exact quantiles without gathering the values in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rank error of the bracketing sketch is at most rows / ACCURACY (Spark's own default).
ACCURACY = 10_000
# Equal-width bins that the bracket is cut into for ranking.
BINS = 1024

_BELOW, _INSIDE, _ABOVE = 0, 1, 2


def bracket(value: str, q: float, accuracy: int = ACCURACY) -> Column:
    """Aggregate: two values between which the quantile lies, from a mergeable sketch."""
    margin = 2.0 / accuracy
    ends = F.array(F.lit(max(0.0, q - margin)), F.lit(min(1.0, q + margin)))
    return F.percentile_approx(F.col(value).cast("double"), ends, F.lit(accuracy))


def exact_quantile(df: DataFrame, value: str, q: float, accuracy: int = ACCURACY,
                   bins: int = BINS, *, between: list[float] | None = None) -> DataFrame:
    """Smallest value whose cumulative share reaches `q`; a one-row frame `quantile`.

    `between` is the `bracket`, if the caller has it from a pass of its own; else it is computed
    now. Both are two numbers. One pass then counts the rows below and above the bracket and
    folds the rows inside it by value, so ties and hot values weigh one row per task. The values
    inside are ranked bin by bin: the only ordered list that meets in one task is that of the bin
    totals. A dense cluster of different values may lie in one bin; the bracket spans at most
    4 / ACCURACY of the rows, which bounds it. Should the bracket miss the rank, which the
    sketch's guarantee rules out, the query fails instead of guessing.
    """
    values = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    if between is None:
        between = values.agg(bracket("v", q, accuracy).alias("b")).first()["b"]
    ends = F.array(*[F.lit(x) for x in between or [None, None]]).cast("array<double>")

    low, high = F.col("b")[0], F.col("b")[1]
    zone = F.when(F.col("v") < low, _BELOW).when(F.col("v") <= high, _INSIDE).otherwise(_ABOVE)
    width = F.nullif(high - low, F.lit(0.0))
    position = F.coalesce(F.floor((F.col("v") - low) / width * bins), F.lit(0))
    folded = (
        values.withColumn("b", ends)
        .select("v", zone.alias("zone"), position.alias("position"))
        .select(
            F.when(F.col("zone") == _INSIDE, F.col("v")).alias("v"),
            F.when(F.col("zone") == _BELOW, -1).when(F.col("zone") == _ABOVE, bins + 1)
            .otherwise(F.col("position")).alias("bin"))
        .groupBy("bin", "v").agg(F.count(F.lit(1)).alias("n"))
    )

    # At most bins + 3 rows from here on: the two outer zones, the bins, and the upper edge.
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    totals = folded.groupBy("bin").agg(F.sum("n").alias("m")).select(
        "bin",
        F.coalesce(F.sum("m").over(before), F.lit(0)).alias("offset"),
        F.ceil(F.lit(q) * F.sum("m").over(Window.partitionBy())).alias("wanted"))
    within = Window.partitionBy("bin").orderBy("v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    running = F.col("offset") + F.sum("n").over(within)
    hit = (
        folded.join(F.broadcast(totals), "bin")
        .select("bin", "v", "wanted", running.alias("running"))
        .where("running >= wanted")
        .agg(F.min_by(F.struct("bin", "v"), "running").alias("first"))
    )
    found = F.col("first.bin").between(0, bins)
    return hit.select(
        F.when(F.col("first").isNull(), F.lit(None).cast("double"))
        .when(found, F.col("first.v"))
        .otherwise(F.raise_error(F.lit("quantile bracket missed the rank")).cast("double"))
        .alias("quantile"))
