"""Join paths between tables and column correspondences between files, found from their values."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .harmonize import by_source, shape
from .joins import key_coverage
from .sketch import K, containment

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# Share of a column's sampled values that a key has to hold, and of rows of a key that differ.
LEAST_CONTAINED = 0.75
LEAST_UNIQUE = 0.9
# Weights of values and names where columns of two files are matched.
VALUE_WEIGHT, NAME_WEIGHT = 0.6, 0.4
# A pair of columns below this is no match.
LEAST_MATCH = 0.25


def name_likeness(a: str, b: str) -> float:
    """Share of letter pairs that two names have in common (Dice), case and signs aside."""
    def pairs(name: str) -> set[str]:
        plain = "".join(c for c in name.lower() if c.isalnum())
        return {plain[i:i + 2] for i in range(len(plain) - 1)} or {plain}

    x, y = pairs(a), pairs(b)
    return 2 * len(x & y) / (len(x) + len(y))


def _bare(column: str) -> str:
    """A column name without a prefix of one or two letters, as in `l_orderkey`."""
    head, _, tail = column.partition("_")
    return tail if tail and len(head) <= 2 else column


@dataclass(frozen=True)
class Path:
    """A column whose values are found in a key of another table."""

    table: str
    column: str
    key_table: str
    key: str
    contained: float        # estimated share of the column's distinct values that the key holds
    covered: float          # estimated share of the key's values that the column holds
    likeness: float         # of the names

    @property
    def score(self) -> float:
        return self.contained * (0.4 + 0.2 * self.covered + 0.4 * self.likeness)

    @property
    def label(self) -> str:
        return f"{self.table}.{self.column} -> {self.key_table}.{self.key}"


def key_like(df: DataFrame) -> list[str]:
    """Columns that may take part in a join: whole numbers and texts."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (*WHOLE, T.StringType))]


def join_paths(tables: dict[str, DataFrame], k: int = K,
               least_contained: float = LEAST_CONTAINED) -> list[Path]:
    """Candidate join paths, best first: every column whose values a key of another table holds.

    A key is a column nearly all of whose filled rows differ. Columns of all tables are sketched in
    one scan a table and looked up in a second; a third, without a shuffle of rows, counts filled
    and distinct ones approximately. A small range of whole numbers lies in every dense key, so
    ranking also asks how far the column covers the key and how alike their names are. Empty
    columns have no path. Only columns of the same kind (number, text) are paired, and tables are
    not paired with themselves.
    """
    columns = {name: key_like(df) for name, df in tables.items()}
    marked = [(df.select(F.lit(name).alias("_table"), *[F.col(f"`{c}`") for c in columns[name]]),
               "_table", columns[name]) for name, df in tables.items() if columns[name]]
    _, shares = containment(marked, k)
    unique: dict[tuple[str, str], bool] = {}
    for name, df in tables.items():
        if not columns[name]:
            continue
        row = df.agg(*[expression for i, c in enumerate(columns[name]) for expression in (
            F.count(F.col(f"`{c}`")).alias(f"n{i}"),
            F.approx_count_distinct(F.col(f"`{c}`"), 0.02).alias(f"d{i}"))]).first()
        for i, c in enumerate(columns[name]):
            unique[name, c] = row[f"n{i}"] > 0 and row[f"d{i}"] >= LEAST_UNIQUE * row[f"n{i}"]
    text = {(name, f.name): isinstance(f.dataType, T.StringType)
            for name, df in tables.items() for f in df.schema.fields}
    found = []
    for (column, key), share in shares.items():
        if (column[0] == key[0] or not unique[key] or text[column] != text[key]
                or share < least_contained):
            continue
        likeness = max(name_likeness(_bare(column[1]), _bare(key[1])),
                       name_likeness(_bare(column[1]), f"{key[0]} {_bare(key[1])}"))
        found.append(Path(*column, *key, share, shares.get((key, column), 0.0), likeness))
    return sorted(found, key=lambda p: (-p.score, p.label))


def checked_paths(tables: dict[str, DataFrame], paths: list[Path]) -> DataFrame:
    """Exact rows and matched rows of each path: `key_pair`, `total_rows`, `matched_rows`,
    `unmatched_rows`. A column is grouped once for all keys it is held against."""
    return key_coverage([(p.label, tables[p.table], p.column, tables[p.key_table], p.key)
                         for p in paths])


# ------------------------------------------------------------------------- column matching

def assigned(weights: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, column), each used once, of greatest total weight: shortest augmenting paths.

    Columns without a partner are left alone. Rows are the files' columns, a few dozen.
    """
    flipped = weights.shape[0] > weights.shape[1]
    cost = -(weights.T if flipped else weights)
    rows, columns = cost.shape
    row_price, column_price = np.zeros(rows), np.zeros(columns + 1)
    holder = np.full(columns + 1, -1)           # the row that holds a column; last: the new one
    for row in range(rows):
        holder[columns], at = row, columns
        distance = np.full(columns, np.inf)
        came = np.full(columns, columns)
        done = np.zeros(columns + 1, bool)
        while holder[at] >= 0:
            done[at] = True
            now = holder[at]
            slack = cost[now] - row_price[now] - column_price[:columns]
            better = ~done[:columns] & (slack < distance)
            distance[better], came[better] = slack[better], at
            reach = np.where(done[:columns], np.inf, distance)
            nearest = int(reach.argmin())
            step = reach[nearest]
            used = np.flatnonzero(done)
            row_price[holder[used]] += step
            column_price[used] -= step
            distance[~done[:columns]] -= step
            at = nearest
        while at != columns:
            before = came[at]
            holder[at] = holder[before]
            at = before
        holder[columns] = -1
    pairs = [(int(holder[c]), c) for c in range(columns) if holder[c] >= 0]
    return sorted((c, r) if flipped else (r, c) for r, c in pairs)


def matched_columns(df: DataFrame, source: str, reference: str, columns: list[str] | None = None,
                    k: int = K) -> list[tuple[str, str, str, float]]:
    """(source, its column, the reference source's column, score) for sources stacked in one frame.

    Values and names both speak for a pair: the share of the column's sampled values that the
    reference column holds, and the likeness of the names. The pairs of a source are those of
    greatest total score, each column used once, so two columns whose contents are exchanged are
    found exchanged, and a column renamed beyond recognition follows its values. Pairs below
    LEAST_MATCH are left out, as are columns a source leaves empty. All sources are sketched in
    one scan and looked up in another; the number of sources has to be small.
    """
    columns = columns or [c for c in df.columns if c != source]
    sizes, shares = containment([(df, source, columns)], k)
    own: dict[str, list[str]] = {}
    for part, column in sizes:
        own.setdefault(part, []).append(column)
    out = []
    for part in sorted(own):
        mine, theirs = sorted(own[part]), sorted(own.get(reference, []))
        if part == reference or not theirs:
            continue
        weights = np.array([[
            VALUE_WEIGHT * shares.get(((part, a), (reference, b)), 0.0)
            + NAME_WEIGHT * name_likeness(a, b) for b in theirs] for a in mine])
        out += [(part, mine[i], theirs[j], float(weights[i, j]))
                for i, j in assigned(weights) if weights[i, j] >= LEAST_MATCH]
    return out


def unified(df: DataFrame, source: str, reference: str,
            matches: list[tuple[str, str, str, float]], columns: list[str]) -> DataFrame:
    """All sources under the reference's names: `source` and `columns`, NULL where a source has no
    column for a name. One projection over one scan."""
    behind: dict[str, dict[str, str]] = {}
    for part, column, name, _ in matches:
        behind.setdefault(name, {})[part] = column
    return shape(df, {source: F.col(source), **{
        name: by_source(F.col(source), {
            reference: F.col(f"`{name}`"),
            **{part: F.col(f"`{c}`") for part, c in sorted(behind.get(name, {}).items())}})
        for name in columns}})
