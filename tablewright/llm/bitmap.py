"""Bit tables of a fixed size, gathered from positions that Spark holds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW_BITS = 8 * 4096            # bits of one row of Spark's bitmap functions


def gathered(positions: DataFrame, bits: int) -> np.ndarray:
    """The table of `bits` bits in which those of column `position` (from 0) are set, as bytes.

    Spark combines the positions to rows of 4 KB; at most bits / 32768 such rows reach the driver,
    however many positions there are.
    """
    table = np.zeros(-(-bits // ROW_BITS) * ROW_BITS // 8, np.uint8)
    rows = (positions.groupBy((F.col("position").cast("bigint") / ROW_BITS).cast("int").alias("row"))
            .agg(F.bitmap_construct_agg(F.col("position") % ROW_BITS).alias("part")))
    for row in rows.where("row IS NOT NULL").collect():
        at = row["row"] * ROW_BITS // 8
        table[at:at + ROW_BITS // 8] |= np.frombuffer(row["part"], np.uint8)
    return table


def has(table: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Whether each position's bit is set."""
    return (table[(positions >> 3).astype(np.int64)] >> (positions & 7).astype(np.uint8)) & 1 == 1
