"""Which columns hold values of which others, estimated from bounded samples of their values.

A column's sketch is the k smallest distinct hashes of its values: a uniform sample of the distinct
values, whatever their frequencies, and all of them where there are at most k. Looked up in another
column, it tells which share of its distinct values that column holds. With the values all looked
up, the standard error is at most 1 / (2 sqrt k), however different the sizes of the columns are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 256
ROWS = "part string, column_name string, hash bigint"


def _hashed(df: DataFrame, part: str, columns: list[str]) -> DataFrame:
    """`part` and the hash of each column's text; NULL stays NULL."""
    quoted = [F.col(f"`{c}`") for c in columns]
    return df.select(
        F.col(f"`{part}`").cast("string").alias("part"),
        *[F.when(c.isNotNull(), F.xxhash64(c.cast("string"))).alias(f"h{i}")
          for i, c in enumerate(quoted)])


def _values(batch: pa.RecordBatch) -> Iterator[tuple[str, int, np.ndarray]]:
    """(part, column number, hashes) of a batch, rows without a part left out."""
    parts = batch.column(0).dictionary_encode()
    codes = parts.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    for code, part in enumerate(parts.dictionary.to_pylist()):
        rows = codes == code
        for i in range(1, batch.num_columns):
            column = batch.column(i)
            yield part, i - 1, column.filter(pa.array(rows)).drop_null().to_numpy()


def _rows(found: dict[tuple[str, int], np.ndarray], columns: list[str]) -> pa.RecordBatch:
    keys = list(found)
    sizes = [len(found[key]) for key in keys]
    return pa.RecordBatch.from_arrays([
        pa.array([key[0] for key, n in zip(keys, sizes, strict=True) for _ in range(n)],
                 pa.string()),
        pa.array([columns[key[1]] for key, n in zip(keys, sizes, strict=True) for _ in range(n)],
                 pa.string()),
        pa.array(np.concatenate([found[key] for key in keys]) if keys else [], pa.int64()),
    ], names=["part", "column_name", "hash"])


def sketches(df: DataFrame, part: str, columns: list[str], k: int = K) -> DataFrame:
    """(`part`, `column_name`, `hash`): the k smallest distinct hashes of each part's column.

    One scan for all columns; a task hands on at most k hashes per part and column, so the
    number of parts has to be small (tables or source files, not keys). NULL values and rows
    whose part is NULL are left out; a column of NULLs has no rows.
    """
    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            for name, i, hashes in _values(batch):
                before = held.get((name, i), np.empty(0, np.int64))
                if len(before) == k:
                    hashes = hashes[hashes < before[-1]]
                if len(hashes):
                    held[name, i] = np.unique(np.concatenate([before, hashes]))[:k]
        yield _rows(held, columns)

    window = Window.partitionBy("part", "column_name").orderBy("hash")
    return (_hashed(df, part, columns).mapInArrow(smallest, ROWS).distinct()
            .withColumn("_place", F.row_number().over(window)).where(F.col("_place") <= k)
            .drop("_place"))


def looked_up(df: DataFrame, part: str, columns: list[str], wanted: np.ndarray) -> DataFrame:
    """(`part`, `column_name`, `hash`): which of the wanted hashes each part's column holds.

    One scan for all columns. `wanted` travels with the tasks; it is a set of sketches, so its size
    is bounded by k times the number of columns.
    """
    wanted = np.unique(wanted.astype(np.int64))

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            for name, i, hashes in _values(batch):
                if not len(wanted):
                    continue
                places = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                hits = held.setdefault((name, i), np.zeros(len(wanted), bool))
                hits[places[wanted[places] == hashes]] = True
        yield _rows({key: wanted[hits] for key, hits in held.items()}, columns)

    return _hashed(df, part, columns).mapInArrow(seen, ROWS).distinct()


Place = tuple[str, str]     # (part, column)


def containment(tables: list[tuple[DataFrame, str, list[str]]], k: int = K
                ) -> tuple[dict[Place, int], dict[tuple[Place, Place], float]]:
    """Sketch sizes, and for every two columns the share of the first's values the second holds.

    `tables` lists (frame, part column, columns). Each frame is scanned twice, once for the
    sketches and once to look all of them up. Sketches come to the driver: k numbers per column.
    Pairs without a common value are left out.
    """
    sampled = reduce(DataFrame.unionByName, [sketches(*t, k) for t in tables]).toArrow()
    hashes = sampled.column("hash").to_numpy()
    held = reduce(DataFrame.unionByName, [looked_up(*t, hashes) for t in tables]).toArrow()
    owners: dict[int, list[Place]] = {}
    sizes: dict[Place, int] = {}
    for part, column, value in zip(*(sampled.column(c).to_pylist() for c in sampled.column_names),
                                   strict=True):
        owners.setdefault(value, []).append((part, column))
        sizes[part, column] = sizes.get((part, column), 0) + 1
    common: dict[tuple[Place, Place], int] = {}
    for part, column, value in zip(*(held.column(c).to_pylist() for c in held.column_names),
                                   strict=True):
        for owner in owners[value]:
            if owner != (part, column):
                pair = owner, (part, column)
                common[pair] = common.get(pair, 0) + 1
    return sizes, {pair: n / sizes[pair[0]] for pair, n in common.items()}
