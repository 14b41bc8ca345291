"""Named row rules, quarantine with reasons, deduplication, issue registry."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.cleaning import all_null, any_null

REASON = "_rejection_reason"
PASSED = "_passed"


@dataclass(frozen=True)
class Rule:
    """A row passes when `predicate` IS TRUE; false and NULL both fail."""

    name: str
    column: str
    predicate: str
    reason: str

    def failed(self) -> Column:
        return ~F.coalesce(F.expr(self.predicate), F.lit(False))

    def message(self) -> Column:
        """Reason text if the row fails this rule, else NULL.

        When the predicate is undecided because the value is missing, the text says so
        instead of blaming a value that is not there.
        """
        before, slot, after = self.reason.partition("{value}")
        text = F.lit(before)
        if slot:
            text = F.concat(text, F.col(self.column).cast("string"), F.lit(after))
        undecided = F.expr(self.predicate).isNull()
        missing = F.lit(f"null {self.column}")
        return F.when(undecided, missing).when(self.failed(), text)


def rules(specs: Iterable[tuple[str, str, str, str]]) -> list[Rule]:
    return [Rule(*spec) for spec in specs]


def _all_pass(checks: list[Rule]) -> str:
    return " AND ".join(f"({rule.predicate})" for rule in checks)


def passing(df: DataFrame, checks: list[Rule]) -> DataFrame:
    """Rows for which every rule holds. A plain conjunction, so it can be pushed to the scan."""
    return df.where(_all_pass(checks))


def failing(df: DataFrame, checks: list[Rule]) -> DataFrame:
    """The complement of `passing`, with the reasons of all failed rules joined by a comma."""
    return (
        df.where(~F.coalesce(F.expr(_all_pass(checks)), F.lit(False)))
        .withColumn(REASON, F.concat_ws(", ", *[rule.message() for rule in checks]))
    )


def write_split(df: DataFrame, checks: list[Rule], path: str,
                counts: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """Store both halves with one pass over the input; return readers for (clean, failed).

    The transform behind `df` runs once. Each reader scans its own folder only. With `counts`, the
    same pass counts the rows that fail each rule; `observed_counts` tells them afterwards.
    """
    passed = F.coalesce(F.expr(_all_pass(checks)), F.lit(False))
    reason = F.concat_ws(", ", *[rule.message() for rule in checks])
    flagged = df.withColumn(REASON, F.when(~passed, reason)).withColumn(PASSED, passed)
    watched = flagged if counts is None else flagged.observe(counts, *_rule_aggregates(checks))
    watched.write.mode("overwrite").option("compression", "zstd").partitionBy(PASSED).parquet(path)
    # Read through the root with the schema given: a half without rows has no folder, but is
    # still an empty table.
    stored = df.sparkSession.read.schema(flagged.schema).parquet(path)
    return (stored.where(F.col(PASSED)).drop(REASON, PASSED),
            stored.where(~F.col(PASSED)).drop(PASSED))


def _rule_aggregates(checks: list[Rule]) -> list[Column]:
    return [F.count(F.lit(1)).alias("total_rows"),
            *[F.count_if(rule.failed()).alias(f"f{i}") for i, rule in enumerate(checks)]]


def observed_counts(spark: SparkSession, counts: Observation, checks: list[Rule], table: str
                    ) -> DataFrame:
    """What `rule_counts` tells, from the counts that a `write_split` took on its way."""
    seen = counts.get
    total = seen["total_rows"]
    return spark.createDataFrame(
        [(table, rule.name, total, total - seen[f"f{i}"], seen[f"f{i}"])
         for i, rule in enumerate(checks)],
        "table_name string, rule_name string, total_rows bigint, passed_rows bigint, "
        "failed_rows bigint")


def rule_counts(df: DataFrame, checks: list[Rule], table: str) -> DataFrame:
    """One row per rule: rows checked, passed, failed. One scan whatever the number of rules."""
    counted = df.agg(*_rule_aggregates(checks))
    per_rule = F.array(*[
        F.struct(F.lit(rule.name).alias("rule_name"), F.col(f"f{i}").alias("failed_rows"))
        for i, rule in enumerate(checks)
    ])
    return (
        counted.select("total_rows", F.explode(per_rule).alias("r"))
        .select(
            F.lit(table).alias("table_name"),
            "r.rule_name",
            "total_rows",
            (F.col("total_rows") - F.col("r.failed_rows")).alias("passed_rows"),
            "r.failed_rows",
        )
    )


def keep_first(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per non-NULL key, the first in `order`; rows without a key are all kept.

    `row_number() = 1` lets Spark put a per-task group limit in front of the shuffle, so a key
    that holds a third of the rows sends one row per task. Rows without a key get a lane of
    their own each: they spread over all tasks and never meet. The lane numbers follow the row
    order of the input partitions, so the input should be a scan, as stored tables are; a lost
    task then numbers its rows the same way again.
    """
    lane = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    window = Window.partitionBy(key, "_lane").orderBy(*order)
    return (
        df.withColumn("_lane", lane)
        .withColumn("_position", F.row_number().over(window))
        .where("_position = 1")
        .drop("_lane", "_position")
    )


def duplicate_excess(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond one per key: total, distinct, excess. Counts are combined before the shuffle."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("total_rows"),
        F.count(key).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNotNull(), F.col("n") - 1)), F.lit(0))
        .alias("excess_rows"),
    )


def blank_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which all the columns are NULL (padding of spreadsheet exports)."""
    return df.where(all_null(columns))


def usable_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(~all_null(columns))


def partial_rows(df: DataFrame, anchor: str, others: list[str]) -> DataFrame:
    """Rows whose anchor is there while another column is missing."""
    return df.where(F.col(anchor).isNotNull() & any_null(others))


@dataclass(frozen=True)
class Issue:
    """A known data problem: metadata plus how to count the rows it affects.

    `affected` is a SQL predicate over the raw rows, or None when `column` is checked for
    sources that never deliver it (`absent_in_source`) or for repeated keys (`repeated_key`).
    """

    issue_id: str
    table: str
    column: str
    rule: str
    kind: str
    severity: str
    description: str
    fix: str
    affected: str | None = None
    absent_in_source: tuple[str, ...] = ()
    repeated_key: str | None = None


def count_issues(df: DataFrame, issues: list[Issue], source: str | None = None) -> DataFrame:
    """issue_id, affected, total for every issue of one table.

    One conditional aggregate per source file group, then a fold over the few sources.
    Repeated keys need the keys themselves and take an aggregation of their own.
    """
    plain = [i for i in issues if i.repeated_key is None]
    keyed = [i for i in issues if i.repeated_key is not None]
    parts: list[DataFrame] = []
    if plain:
        aggregates = [F.count(F.lit(1)).alias("total")]
        for n, issue in enumerate(plain):
            if issue.absent_in_source:
                present = F.coalesce(*[F.col(f"`{c}`").cast("string")
                                       for c in issue.absent_in_source])
                aggregates.append(F.count(present).alias(f"c{n}"))
            else:
                aggregates.append(F.count_if(F.expr(issue.affected)).alias(f"c{n}"))
        by = [source] if source else []
        per_source = df.groupBy(*by).agg(*aggregates)
        totals = per_source.agg(F.sum("total").alias("total"), *[
            (F.sum(F.when(F.col(f"c{n}") == 0, F.col("total")).otherwise(0))
             if issue.absent_in_source else F.sum(f"c{n}")).alias(f"c{n}")
            for n, issue in enumerate(plain)
        ])
        entries = F.array(*[
            F.struct(F.lit(issue.issue_id).alias("issue_id"),
                     F.col(f"c{n}").alias("affected_records"),
                     F.col("total").alias("total_records"))
            for n, issue in enumerate(plain)
        ])
        parts.append(totals.select(F.explode(entries).alias("e")).select("e.*"))
    for issue in keyed:
        parts.append(duplicate_excess(df, issue.repeated_key).select(
            F.lit(issue.issue_id).alias("issue_id"),
            F.col("excess_rows").alias("affected_records"),
            F.col("total_rows").alias("total_records")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def issue_registry(counts: DataFrame, issues: list[Issue]) -> DataFrame:
    """Counts joined with the issue metadata, one row per issue, with the affected ratio and the
    time of the count."""
    def text(attribute: str) -> Column:
        pairs = [F.lit(p) for i in issues for p in (i.issue_id, getattr(i, attribute))]
        return F.create_map(*pairs)[F.col("issue_id")]

    ratio = F.round(F.col("affected_records").cast("double") / F.col("total_records"), 3)
    return counts.select(
        "issue_id",
        text("table").alias("table_name"),
        text("column").alias("column_name"),
        text("rule").alias("rule_name"),
        text("kind").alias("issue_type"),
        text("severity").alias("severity"),
        "affected_records",
        "total_records",
        ratio.alias("affected_ratio"),
        text("description").alias("description"),
        text("fix").alias("suggested_fix"),
        F.current_timestamp().alias("detected_at"),
    )
