"""Results that are kept up to date batch by batch, equal to those over all rows at once.

State lies in runs: each batch adds one, a folder of its own, and a version log says which folders
count. A run is in effect from the moment the log names it, so a batch that fails halfway changes
nothing, and a batch that is repeated replaces its own run. Runs merge into one by compaction.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.versions import VersionLog
from . import quality


class Runs:
    """Rows by batch below one folder, all of one schema."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.log = VersionLog(spark, f"{folder}/log")

    def _record(self) -> tuple[int, dict]:
        version, record = self.log.latest()
        return version, record or {"runs": {}, "merged": [], "base": None, "schema": None}

    def _write(self, df: DataFrame, name: str) -> str:
        folder = f"{name}-{uuid.uuid4().hex[:8]}"
        df.write.option("compression", "zstd").parquet(f"{self.folder}/{folder}")
        return folder

    def settled(self, batch: int) -> bool:
        """Whether the batch was taken in, and another one or a compaction came after it."""
        record = self._record()[1]
        order = list(record["runs"])
        return batch in record["merged"] or str(batch) in order[:-1]

    def run(self, batch: int) -> DataFrame:
        """The rows of one batch."""
        record = self._record()[1]
        schema = T.StructType.fromJson(json.loads(record["schema"]))
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{record['runs'][str(batch)]}")

    def put(self, batch: int, df: DataFrame) -> None:
        """Add a batch's rows, or replace them. What was compacted already stays as it is."""
        version, record = self._record()
        if batch in record["merged"]:
            return
        record["runs"][str(batch)] = self._write(df, f"batch-{batch}")
        record["schema"] = record["schema"] or df.schema.json()
        self.log.put(version + 1, record)

    def read(self, without: int | None = None) -> DataFrame | None:
        """All rows, or all but those of one batch; None before the first batch."""
        record = self._record()[1]
        if not record["schema"]:
            return None
        folders = [f for b, f in record["runs"].items() if b != str(without)]
        folders += [record["base"]] if record["base"] else []
        schema = T.StructType.fromJson(json.loads(record["schema"]))
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{f}" for f in folders])

    def compact(self, merge: Callable[[DataFrame], DataFrame]) -> None:
        """Put `merge` of all rows in the place of the runs."""
        version, record = self._record()
        if record["runs"]:
            base = self._write(merge(self.read()), "base")
            merged = record["merged"] + [int(b) for b in record["runs"]]
            self.log.put(version + 1, {**record, "runs": {}, "merged": merged, "base": base})


class Winners:
    """The first row of each key in a fixed order, over all batches so far.

    A batch is reduced to its own winners before it is stored, and winners of winners are winners:
    the order in which batches come does not matter, and history is never ranked again as a whole.
    Rows without a key are all kept.
    """

    def __init__(self, runs: Runs, key: str, order: Callable[[DataFrame], list[Column]]):
        self.runs, self.key, self.order = runs, key, order

    def _first(self, df: DataFrame) -> DataFrame:
        return quality.keep_first(df, self.key, self.order(df))

    def update(self, batch: int, df: DataFrame) -> None:
        self.runs.put(batch, self._first(df))

    def current(self, without: int | None = None) -> DataFrame | None:
        rows = self.runs.read(without)
        return None if rows is None else self._first(rows)

    def compact(self) -> None:
        self.runs.compact(self._first)


@dataclass(frozen=True)
class Rollup:
    """An aggregate that can be taken back: counts and exact sums per key.

    `sums` maps names to aggregates that add up and can be negated. Minima, maxima and distinct counts
    follow in `finish` from keys that hold the values themselves.
    """

    keys: dict[str, Column]
    sums: dict[str, Column]
    finish: Callable[[DataFrame], DataFrame]

    def _grouped(self, rows: DataFrame, sign: int) -> DataFrame:
        totals = {"n": F.count(F.lit(1)), **self.sums}
        return rows.groupBy(*[c.alias(k) for k, c in self.keys.items()]).agg(
            *[(total if sign > 0 else -total).alias(name) for name, total in totals.items()])

    def _added(self, parts: DataFrame) -> DataFrame:
        kinds = dict(parts.dtypes)
        return parts.groupBy(*self.keys).agg(
            *[F.sum(name).cast(kinds[name]).alias(name) for name in ("n", *self.sums)])

    def partial(self, added: DataFrame, removed: DataFrame | None = None) -> DataFrame:
        """State of the added rows less that of the removed ones."""
        parts = self._grouped(added, 1)
        if removed is not None:
            back = self._grouped(removed, -1)
            parts = parts.unionByName(back.select(
                *[F.col(f.name).cast(f.dataType).alias(f.name) for f in parts.schema]))
            return self._added(parts)
        return parts

    def merged(self, parts: DataFrame) -> DataFrame:
        """State over all parts; keys that were taken back in full are gone."""
        return self._added(parts).where("n <> 0")

    def result(self, runs: Runs) -> DataFrame:
        return self.finish(self.merged(runs.read()))
