"""Bringing sources with different column names into one shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shape(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """One projection with the given output names, in order."""
    return df.select(*[column.alias(name) for name, column in columns.items()])


def union_sources(parts: list[DataFrame]) -> DataFrame:
    """Stack sources by column name; names a source lacks are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def by_source(source: Column, mapping: dict[str, Column | None]) -> Column:
    """Per-source choice of the physical column behind a logical one; NULL if a source has none.

    Replaces one SELECT per source under UNION ALL by one expression over one scan.
    """
    chosen: Column | None = None
    for name, column in mapping.items():
        if column is None:
            continue
        hit = source == name
        chosen = F.when(hit, column) if chosen is None else chosen.when(hit, column)
    return chosen if chosen is not None else F.lit(None).cast("string")


def schema_variants(df: DataFrame, source: str, variants: dict[str, list[str]]) -> DataFrame:
    """Which physical name each source uses for each logical column, read off the data.

    One row per (source, logical column); the physical name is NULL where a source delivers
    none of them. One aggregation by source, whatever the number of columns.
    """
    names = [v for group in variants.values() for v in group]
    counted = df.groupBy(F.col(source).alias("source_table")).agg(
        *[F.count(F.col(f"`{v}`")).alias(v) for v in names])
    rows = F.array(*[
        F.struct(
            F.lit(logical).alias("logical_column"),
            F.coalesce(*[F.when(F.col(f"`{v}`") > 0, F.lit(v)) for v in group])
            .alias("physical_column"),
        )
        for logical, group in variants.items()
    ])
    return counted.select("source_table", F.explode(rows).alias("r")).select(
        "source_table", "r.logical_column", "r.physical_column")
