"""Table profiles. Each is one aggregation over one scan, whatever the number of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantile import bracket, exact_quantile


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for a set of tables."""
    result: DataFrame | None = None
    for name, df in tables.items():
        counted = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        result = counted if result is None else result.unionByName(counted)
    return result


def row_counts_by(df: DataFrame, source: str) -> DataFrame:
    """Same, for tables stacked in one frame and told apart by a source column."""
    return df.groupBy(F.col(source).alias("table_name")).agg(
        F.count(F.lit(1)).alias("row_count"))


def null_profile(df: DataFrame, columns: dict[str, Column], by: list[str] | None = None
                 ) -> DataFrame:
    """Long form: one row per group and column with its row and NULL counts.

    `columns` maps a reported name to the expression that is tested.
    """
    by = by or []
    names = list(columns)
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(columns[n].isNull()).alias(f"n{i}") for i, n in enumerate(names)],
    )
    entries = F.array(*[F.struct(F.lit(n).alias("column_name"),
                                 F.col(f"n{i}").alias("null_rows"))
                        for i, n in enumerate(names)])
    return counted.select(*by, F.col("_rows").alias("total_rows"),
                          F.explode(entries).alias("e")
                          ).select(*by, "e.column_name", "total_rows", "e.null_rows")


def value_counts(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Long form: one row per group, column and value with its frequency.

    The columns are unpivoted inside the scan; counts are combined before the shuffle.
    """
    by = by or []
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                 F.col(f"`{c}`").cast("string").alias("value"))
                        for c in columns])
    return (
        df.select(*by, F.explode(entries).alias("e"))
        .groupBy(*by, "e.column_name", "e.value")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """Frequencies of column combinations."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("cnt"))


def key_profile(df: DataFrame, keys: list[str], nullable: list[str]) -> DataFrame:
    """One row: total rows, distinct values of each key, NULLs of each column."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_distinct(F.col(k)).alias(f"distinct_{k}") for k in keys],
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in nullable],
    )


def keys_by_source(df: DataFrame, source: str, key: str) -> DataFrame:
    """Rows and distinct keys per source, counted through (source, key) groups."""
    per_key = df.groupBy(source, key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(F.col(source).alias("source_table")).agg(
        F.sum("n").alias("rows_in_source"), F.count(key).alias("distinct_keys"))


def repeated_keys(df: DataFrame, keys: list[str], *extra: Column) -> DataFrame:
    """Key combinations that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"), *extra).where("cnt > 1")


def numeric_profile(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """Mean and sample standard deviation, one row per column."""
    aggregates = []
    for c in columns:
        aggregates += [F.round(F.avg(c), digits).alias(f"m_{c}"),
                       F.round(F.stddev_samp(c), digits).alias(f"s_{c}")]
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                 F.col(f"m_{c}").alias("mean"),
                                 F.col(f"s_{c}").alias("stddev")) for c in columns])
    return df.agg(*aggregates).select(F.explode(entries).alias("e")).select("e.*")


def spread_profile(df: DataFrame, value: str, quantile: float, digits: int = 4) -> DataFrame:
    """One row: mean, sample standard deviation, extremes and an exact quantile of a measure.

    One pass, made at once, gives the four figures and the bracket of the quantile; the frame
    returned holds them and makes the pass that finds the quantile.
    """
    basic = df.agg(
        F.round(F.avg(value), digits).alias("mean"),
        F.round(F.stddev_samp(value), digits).alias("stddev"),
        F.max(value).alias("max"),
        F.min(value).alias("min"),
        bracket(value, quantile).alias("_bracket"),
    )
    row = basic.first()
    found = exact_quantile(df, value, quantile,
                           between=row["_bracket"] or [None, None])
    return found.select(*[F.lit(row[c]).cast(basic.schema[c].dataType).alias(c)
                          for c in ("mean", "stddev", "max", "min")], "quantile")


def described_columns(table: str, df: DataFrame) -> DataFrame:
    """Schema as rows, with how far each column is filled: one scan, one row per column."""
    counted = df.agg(F.count(F.lit(1)).alias("_rows"),
                     *[F.count(F.col(f"`{c}`")).alias(f"c{i}")
                       for i, c in enumerate(df.columns)])
    entries = F.array(*[
        F.struct(F.lit(i + 1).alias("position"),
                 F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.col(f"c{i}").alias("filled_rows"))
        for i, f in enumerate(df.schema.fields)])
    return counted.select(F.lit(table).alias("table_name"), F.col("_rows").alias("total_rows"),
                          F.explode(entries).alias("e")
                          ).select("table_name", "total_rows", "e.*")
