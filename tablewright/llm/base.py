"""Working folders, stored tables and session settings shared by the operators."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import shared_folder

# Words are maximal runs of other characters than blank, tab, line feed, vertical tab, form feed
# and carriage return.
GAPS = "[\\x20\\x09-\\x0D]+"

# Short rows (a few numbers) that one task handles where their number is known.
ROWS_PER_TASK = 50_000

# Rows handed to Python at a time: few, because a single text may be very long.
ROWS_PER_BATCH = "512"


def ready(spark: SparkSession) -> SparkSession:
    """The session, with small Arrow batches unless it sets their size itself."""
    given = {key for key, _ in spark.sparkContext.getConf().getAll()}
    if "spark.sql.execution.arrow.maxRecordsPerBatch" not in given:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return spark


class Work:
    """A folder of its own below `spark.checkpoint.dir`; each stored table cuts lineage there."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = ready(spark)
        self.folder = shared_folder(spark, purpose)
        self.count = 0

    def path(self, name: str) -> str:
        self.count += 1
        return os.path.join(self.folder, f"{self.count:03d}-{name}")

    def stored(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """Write the rows once and read them back. `rows`: about how many short rows there are."""
        path = self.path(name)
        (df if rows is None else few(df, rows)).write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def few(df: DataFrame, rows: int) -> DataFrame:
    """The rows in no more tasks than so many short rows need; never in more than they have."""
    return df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: str) -> F.Column:
    """Number of words of a text column; null and blank texts have none."""
    parts = F.filter(F.split(F.col(text), GAPS), lambda part: part != "")
    return F.coalesce(F.size(parts), F.lit(0)).cast("bigint")
