"""Exact top-k inner products by columnar branch-and-bound.

Vectors are packed into blocks in vertical layout: one row per dimension, so that a group of
dimensions is one contiguous slice over all vectors. Every block of queries meets every block of
candidates. Scores accumulate one group of dimensions after the other; what the remaining
dimensions can still add is bounded by the product of the remaining masses (Cauchy-Schwarz), and
candidates that cannot reach the k-th best any more are compacted away before the next group.
A task carries each query's best from block to block, so later blocks are pruned from the start.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.base import Work, partitions

SCALE = 256
BLOCK = 4096                   # vectors of a block
GROUP = 8                      # dimensions added between two prunings
TOP = 5
QUERY_EVERY = 50
TASK_BLOCKS = 16               # blocks of candidates that a task takes where there are many
CARRIED = 256                  # query blocks whose best rows a task carries on

BLOCKS = "dimensions int, n int, rows binary, ids binary, columns binary"
HITS = "query_row bigint, query_id bigint, vec_id bigint, score bigint"
LONG = (-(1 << 63), (1 << 63) - 1)
LARGEST = np.finfo(np.float64).max


def _packed(batches):
    """Collect the rows of a partition into blocks, one series per number of dimensions."""
    held: dict[int, list] = {}

    def block(dimensions: int):
        rows = held.pop(dimensions)
        marks, ids = (np.concatenate([r[i] for r in rows]) for i in range(2))
        columns = np.concatenate([r[2] for r in rows], axis=1)
        return pa.RecordBatch.from_arrays([
            pa.array([dimensions], pa.int32()), pa.array([len(ids)], pa.int32()),
            pa.array([marks.astype("<i8").tobytes()], pa.binary()),
            pa.array([ids.astype("<i8").tobytes()], pa.binary()),
            pa.array([np.ascontiguousarray(columns).tobytes()], pa.binary()),
        ], names=["dimensions", "n", "rows", "ids", "columns"])

    for batch in batches:
        marks, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        lists = batch.column(2)
        lengths = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        starts = np.concatenate(([0], np.cumsum(lengths)))
        for dimensions in np.unique(lengths):
            which = np.flatnonzero(lengths == dimensions)
            for at in range(0, len(which), BLOCK):
                part = which[at:at + BLOCK]
                values = flat[starts[part][:, None] + np.arange(dimensions)]
                rows = held.setdefault(int(dimensions), [])
                with np.errstate(over="ignore"):
                    whole = np.clip(np.floor(SCALE * values), -LARGEST, LARGEST)
                rows.append((marks[part], ids[part], whole.T))
                if sum(len(r[0]) for r in rows) >= BLOCK:
                    yield block(int(dimensions))
    for dimensions in list(held):
        yield block(dimensions)


def _exact_scores(query: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Scores beyond the range of int64 arithmetic: Python integers, cut off at a long's ends."""
    q = [int(x) for x in query]
    return np.array([min(max(sum(a * int(b) for a, b in zip(q, c, strict=True)), LONG[0]), LONG[1])
                     for c in columns.T], np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= bar)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some].astype(object)
                            if len(scores) and scores.min() == LONG[0] else -scores[some]))][:k]


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray,
                 columns: np.ndarray, k: int = TOP, query_rows: np.ndarray | None = None,
                 rows: np.ndarray | None = None, bars: list[float] | None = None):
    """Yield (query id, ids, scores) of each query's k best candidates of one block.

    `queries` and `columns` are vertical: dimensions by vectors, whole numbers as doubles.
    A query's own row is no candidate; rows are told apart by `rows`, or by id without them.
    Candidates that stay below a query's bar may be left out.
    """
    query_rows, rows = (query_ids, ids) if rows is None else (query_rows, rows)
    dimensions = len(columns)
    largest = [float(np.abs(m).max()) if m.size else 0.0 for m in (queries, columns)]
    safe = largest[0] * largest[1] * max(dimensions, 1) < 2.0 ** 62 and max(largest) < 2.0 ** 62
    if not safe:
        for j, query_id in enumerate(query_ids):
            other = np.flatnonzero(rows != query_rows[j])
            scores = _exact_scores(queries[:, j], columns[:, other])
            best = _best(ids[other], scores, k)
            yield query_id, ids[other][best], scores[best]
        return
    whole, asked = columns.astype(np.int64), queries.astype(np.int64)
    cuts = list(range(0, dimensions, GROUP)) + [dimensions]

    def masses(m):
        """Euclidean length of what each vector still holds from each cut on."""
        squares = [(m[a:b] ** 2).sum(0) for a, b in zip(cuts, cuts[1:])]
        tails = [np.zeros(m.shape[1])]
        for s in reversed(squares):
            tails.append(tails[-1] + s)
        return np.sqrt(np.stack(tails[::-1]))

    tails, query_tails = masses(columns), masses(queries)
    for j, query_id in enumerate(query_ids):
        q = asked[:, j]
        alive = np.flatnonzero(rows != query_rows[j])
        scores = np.zeros(len(alive), np.int64)
        bar = bars[j] if bars else -math.inf
        first_step = True
        for step, (a, b) in enumerate(zip(cuts, cuts[1:])):
            part = whole[a:b] if len(alive) == whole.shape[1] else whole[a:b, alive]
            scores = scores + q[a:b] @ part
            if b == dimensions:
                break
            rest = query_tails[step + 1, j] * tails[step + 1, alive]
            bound = scores + rest
            if len(alive) > k:
                if first_step:
                    # The k with the best prospects, scored in full, set the bar.
                    first = np.argpartition(bound, len(bound) - k)[len(bound) - k:]
                    bar = max(bar, float((q @ whole[:, alive[first]]).min()))
                else:
                    # k candidates are certain to reach the k-th greatest of the lower bounds.
                    low = scores - rest
                    low -= np.abs(low) * 1e-12 + rest * 1e-12 + 1
                    bar = max(bar, float(np.partition(low, len(low) - k)[len(low) - k]))
            first_step = False
            # One more than the bound allows for rounding: scores are whole numbers.
            keep = bound * (1 + 1e-12) + 1 + np.abs(bound) * 1e-12 >= bar
            if not keep.all():
                alive, scores = alive[keep], scores[keep]
        best = _best(ids[alive], scores, k)
        yield query_id, ids[alive][best], scores[best]


class Carried:
    """The best rows so far of the queries of one block."""

    def __init__(self, query_rows: np.ndarray, query_ids: np.ndarray):
        self.rows, self.ids = query_rows, query_ids
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in query_ids]

    def bars(self, k: int) -> list[float]:
        return [float(scores.min()) if len(scores) >= k else -math.inf for _, scores in self.best]

    def add(self, place: int, ids: np.ndarray, scores: np.ndarray, k: int) -> None:
        ids = np.concatenate((self.best[place][0], ids))
        scores = np.concatenate((self.best[place][1], scores))
        picked = _best(ids, scores, k)
        self.best[place] = ids[picked], scores[picked]

    def hits(self) -> pa.RecordBatch:
        counts = [len(ids) for ids, _ in self.best]
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat(self.rows, counts)), pa.array(np.repeat(self.ids, counts)),
            pa.array(np.concatenate([ids for ids, _ in self.best])),
            pa.array(np.concatenate([scores for _, scores in self.best])),
        ], names=["query_row", "query_id", "vec_id", "score"])


def _searched(k: int):
    def run(batches):
        carried: dict[int, Carried] = {}
        for batch in batches:
            for place in range(batch.num_rows):
                row = batch.slice(place, 1).to_pylist()[0]
                if row["dimensions"] != row["q_dimensions"]:
                    continue
                rows, ids, query_rows, query_ids = (
                    np.frombuffer(row[c], "<i8") for c in ("rows", "ids", "q_rows", "q_ids"))
                columns = np.frombuffer(row["columns"]).reshape(row["dimensions"], len(ids))
                queries = np.frombuffer(row["q_columns"]).reshape(row["dimensions"], len(query_ids))
                key = int(query_rows[0])
                if key not in carried and len(carried) >= CARRIED:
                    # What is known of the oldest block is handed on; it starts anew if met again.
                    yield carried.pop(next(iter(carried))).hits()
                held = carried.setdefault(key, Carried(query_rows.copy(), query_ids.copy()))
                found = search_block(query_ids, queries, ids, columns, k, query_rows, rows,
                                     held.bars(k))
                for j, (_, some, scores) in enumerate(found):
                    held.add(j, some, scores, k)
        for held in carried.values():
            yield held.hits()
    return run


def top_scores(vectors: DataFrame, *, k: int = TOP, query_every: int = QUERY_EVERY,
               id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k highest integer inner products of each query: `query_id`, `rank`, `vec_id`, `score`.

    Components count as floor(256 * x). Queries are the rows whose id is divisible by
    `query_every`; candidates are all rows but the query's own id. Ties go to the smaller id.
    With fewer than k candidates a query has fewer rows.

    Null vectors, ones that hold a null or non-finite component and rows without an id take no
    part. Only vectors of equal length are compared; empty ones score 0 with each other. A row that
    repeats an id or a vector is a candidate, and a query, of its own: an id that several query
    rows have occurs in as many rankings. Components that exceed a double after scaling count as
    the largest one, and scores beyond a long's range stop at its end. Extra columns are ignored;
    an empty table gives an empty result.

    The queries are a fixed share of the rows, so they are held in blocks as well and never whole
    in one place: blocks meet blocks, and Spark broadcasts the query blocks only if their
    measured size allows it. A task takes several blocks of candidates and hands on k rows per
    query; it carries the best rows of CARRIED query blocks, and hands on earlier what exceeds them.
    """
    work = Work(vectors.sparkSession, "search")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(math.inf)))
    # Stored once, so that a row keeps its mark wherever it is read.
    usable = work.stored(
        rows.where(F.col("vec_id").isNotNull() & finite)
        .select(F.monotonically_increasing_id().alias("row"), "vec_id", "vector"), "usable")
    candidates = work.stored(usable.mapInArrow(_packed, BLOCKS), "candidates")
    queries = work.stored(usable.where(F.col("vec_id") % query_every == 0)
                          .mapInArrow(_packed, BLOCKS), "queries")
    queries = queries.select(*[F.col(c).alias(f"q_{c}") for c in queries.columns])
    blocks = candidates.count()
    tasks = max(1, min(blocks, max(partitions(vectors.sparkSession), -(-blocks // TASK_BLOCKS))))
    hits = candidates.repartition(tasks).crossJoin(queries).mapInArrow(_searched(k), HITS)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
