"""Exact nearest-vector retrieval and the texts built from it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import confidence

# Vectors that are scored against each other at a time, on either side.
BLOCK = 4096
# Questions of a block scored together: bounds the distance matrix.
QUERY_BLOCK = 64
# Vectors around a pivot, on average.
GROUP = 128


def topk_l2(queries: DataFrame, corpus: DataFrame, query_id: str, corpus_id: str,
            vector: str, k: int) -> DataFrame:
    """The `k` nearest corpus vectors of every query by squared L2 distance.

    Output: query id, corpus id, `rank` from 1, `distance`, `confidence`; ties go to the
    smaller corpus id. A vector that is NULL or empty, or holds a NULL, an infinite element or
    one that is no number, takes no part, on either side; vectors of different lengths never
    meet. A query that finds nothing has no row.

    Both sides are packed into blocks where they are read, and blocks meet blocks. A block groups
    its vectors around pivots of its own and keeps every vector's distance to its pivot, so that
    the triangle inequality rules out groups and parts of groups for a question. Each task
    carries the k best of its questions from block to block, which lowers the bar as it goes, and
    hands on k rows per question at its end; only those are shuffled. What a task carries is in
    proportion to the question blocks it reads. Spark broadcasts these if their size allows it,
    and else streams them past the corpus blocks task by task.
    """
    window = Window.partitionBy(query_id).orderBy("distance", corpus_id)
    return (
        _candidates(queries, corpus, query_id, corpus_id, vector, k).drop("scored")
        .withColumn("rank", F.row_number().over(window))
        .where(F.col("rank") <= k)
        .withColumn("confidence", confidence(F.col("distance")))
    )


def distances_computed(queries: DataFrame, corpus: DataFrame, query_id: str, corpus_id: str,
                       vector: str, k: int) -> DataFrame:
    """One row: how many distances `topk_l2` computes (`scored`) of `pairs` pairs of vectors of
    equal length, and the `share`; no pairs, no share."""
    def lengths(df: DataFrame, identity: str, name: str) -> DataFrame:
        return _usable(df, identity, vector).groupBy(F.size("_vector").alias("length")).agg(
            F.count(F.lit(1)).cast("decimal(38,0)").alias(name))

    pairs = lengths(queries, query_id, "asked").join(
        lengths(corpus, corpus_id, "stored"), "length").agg(
        F.coalesce(F.sum(F.col("asked") * F.col("stored")), F.lit(0)).cast("decimal(38,0)")
        .alias("pairs"))
    scored = _candidates(queries, corpus, query_id, corpus_id, vector, k).agg(
        F.coalesce(F.sum("scored"), F.lit(0)).alias("scored"))
    return scored.join(F.broadcast(pairs)).withColumn(
        "share", F.try_divide(F.col("scored").cast("double"), F.col("pairs").cast("double")))


def _candidates(queries: DataFrame, corpus: DataFrame, query_id: str, corpus_id: str,
                vector: str, k: int) -> DataFrame:
    """Each task's k best rows per question; `scored` counts its distances, on the first row."""
    asked = _blocks(queries, query_id, vector).select(
        F.monotonically_increasing_id().alias("q_block"), F.col("length").alias("q_length"),
        F.col("ids").alias("q_ids"), F.col("cells").alias("q_cells"))
    stored = _blocks(corpus, corpus_id, vector)
    schema = T.StructType([
        T.StructField(query_id, queries.schema[query_id].dataType),
        T.StructField(corpus_id, corpus.schema[corpus_id].dataType),
        T.StructField("distance", T.DoubleType()), T.StructField("scored", T.LongType())])
    return stored.crossJoin(asked).mapInArrow(
        _score_blocks(k, [query_id, corpus_id]), schema)


def _usable(df: DataFrame, identity: str, vector: str) -> DataFrame:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                     & (F.abs(x.cast("double")) < float("inf")))
    return df.where(F.col(identity).isNotNull() & (F.size(vector) > 0) & whole).select(
        F.col(identity).alias("_id"), F.col(vector).cast("array<double>").alias("_vector"))


def _squares(cells: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of every point to every vector; both have one row per element.

    Element by element, so the sum has the same order as a plain fold.
    """
    total = np.zeros((points.shape[1], cells.shape[1]))
    with np.errstate(over="ignore"):
        for d in range(len(cells)):
            total += (cells[d] - points[d, :, None]) ** 2
    return total


def _close(cells: np.ndarray, points: np.ndarray, bar: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray]:
    """Points with a vector within their `bar`, and their squared distances as `_squares` has them,
    but infinite where they exceed the bar.

    One matrix product tells which may not, with a slack far above its rounding errors; only those
    are computed element by element. A product that overflows rules nothing out.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        size, norms = (points * points).sum(0), (cells * cells).sum(0)
        slack = (len(cells) + 16) * 1e-14 * (size + norms.max()) + 1e-300
        apart = norms - 2 * (points.T @ cells)
        row, column = np.nonzero(~(apart > (bar + slack - size)[:, None]))
    if len(row) * 8 > apart.size:
        return np.arange(points.shape[1]), _squares(cells, points)
    which = np.flatnonzero(np.bincount(row))
    at = np.searchsorted(which, row)
    near = np.full((len(which), cells.shape[1]), np.inf)
    # Added up one after another, as a plain fold does.
    with np.errstate(over="ignore"):
        parts = (cells[:, column] - points[:, row]) ** 2
        near[at, column] = np.add.accumulate(parts, axis=0, out=parts)[-1]
    return which, near


def _grouped(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Group vectors around pivots far from each other.

    Gives the order (by group, then distance to its pivot), these distances, the groups' first
    places with the end, and the pivots' places in the order.
    """
    n = cells.shape[1]
    near, group, pivots = _squares(cells, cells[:, :1])[0], np.zeros(n, np.int64), [0]
    while len(pivots) < -(-n // GROUP):
        far = int(np.argmax(near))
        if near[far] == 0:
            break
        to = _squares(cells, cells[:, [far]])[0]
        group[to < near] = len(pivots)
        near = np.minimum(near, to)
        pivots.append(far)
    order = np.lexsort((near, group))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    starts = np.searchsorted(group[order], np.arange(len(pivots) + 1))
    return order, np.sqrt(near[order]), starts, place[pivots]


def _blocks(df: DataFrame, identity: str, vector: str) -> DataFrame:
    """Usable vectors packed per partition: `length`, `ids`, `cells` (elements by vectors), in
    groups: `radii` to the group's pivot, `starts` of the groups and the end, `pivots`."""
    schema = T.StructType([
        T.StructField("length", T.IntegerType()),
        T.StructField("ids", T.ArrayType(df.schema[identity].dataType)),
        T.StructField("cells", T.BinaryType()), T.StructField("radii", T.BinaryType()),
        T.StructField("starts", T.BinaryType()), T.StructField("pivots", T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[pa.Array, np.ndarray]]] = {}

        def block(length: int) -> pa.RecordBatch:
            parts = held.pop(length)
            ids = pa.concat_arrays([ids for ids, _ in parts])
            cells = np.concatenate([cells for _, cells in parts], axis=1)
            order, radii, starts, pivots = _grouped(cells)
            return pa.RecordBatch.from_arrays(
                [pa.array([length], pa.int32()),
                 pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()),
                                          ids.take(pa.array(order))),
                 *[pa.array([x.tobytes()], pa.binary())
                   for x in (cells[:, order], radii, starts, pivots)]],
                names=schema.names)

        for batch in batches:
            vectors = batch.column(1)
            starts = vectors.offsets.to_numpy()
            flat = vectors.values.to_numpy()
            lengths = np.diff(starts)
            for length in map(int, np.unique(lengths)):
                which = np.flatnonzero(lengths == length)
                for at in range(0, len(which), BLOCK):
                    part = which[at:at + BLOCK]
                    cells = flat[starts[part][:, None] + np.arange(length)].T
                    held.setdefault(length, []).append((batch.column(0).take(
                        pa.array(part)), cells))
                    if sum(len(ids) for ids, _ in held[length]) >= BLOCK:
                        yield block(length)
        for length in list(held):
            yield block(length)

    return _usable(df, identity, vector).mapInArrow(pack, schema)


class _Best:
    """The k best rows of each question of a block so far, best first."""

    def __init__(self, k: int, q_ids: pa.Array, ids: np.ndarray):
        self.k, self.q_ids = k, q_ids
        self.distance = np.full((len(q_ids), k), np.inf)
        self.missing = np.ones((len(q_ids), k), bool)
        # What stands where a row is missing is any id: sorting needs one type.
        self.ids = np.full((len(q_ids), k), ids[0], ids.dtype)
        self.scored = np.zeros(len(q_ids), np.int64)

    def take(self, rows: np.ndarray, distance: np.ndarray, ids: np.ndarray) -> None:
        """Let the questions `rows` choose among vectors too; ties go to the smaller id."""
        better = distance.min(axis=1) <= self.distance[rows, -1]
        rows, distance = rows[better], distance[better]
        if not len(rows):
            return
        k = self.k
        every = np.concatenate((self.distance[rows], distance), axis=1)
        row, at = np.nonzero(every <= np.partition(every, k - 1, axis=1)[:, k - 1:k])
        old, held = at < k, np.minimum(at, k - 1)
        chosen = np.where(old, self.ids[rows[row], held], ids[np.maximum(at - k, 0)])
        missing = old & self.missing[rows[row], held]
        order = np.lexsort((chosen, missing, every[row, at], row))
        first = np.searchsorted(row, np.arange(len(rows)))
        order = order[(first[:, None] + np.arange(k)).ravel()]
        shape = (len(rows), k)
        self.distance[rows] = every[row, at][order].reshape(shape)
        self.ids[rows] = chosen[order].reshape(shape)
        self.missing[rows] = missing[order].reshape(shape)


def _meet(best: _Best, points: np.ndarray, cells: np.ndarray, ids: np.ndarray,
          radii: np.ndarray, starts: np.ndarray, pivots: np.ndarray) -> None:
    """Show a block to a block of questions, the nearest groups first.

    A vector farther from its pivot than the question by more than the question's k-th distance,
    or nearer by more, cannot be among the k best. The slack is far above rounding errors. What is
    left is held against the k-th distance by a matrix product (`_close`).
    """
    for start in range(0, points.shape[1], QUERY_BLOCK):
        block = points[:, start:start + QUERY_BLOCK]
        away = np.sqrt(_squares(cells[:, pivots], block))
        for g in np.argsort(away.min(axis=0), kind="stable"):
            bar = np.sqrt(best.distance[start:start + block.shape[1], -1])
            reach = bar + 4e-9 * (away[:, g] + bar) + 1e-150
            bounded = away[:, g] + reach < 1e150       # beyond, squares may overflow
            with np.errstate(invalid="ignore"):
                least = np.where(bounded, away[:, g] - reach, -np.inf)
                most = np.where(bounded, away[:, g] + reach, np.inf)
            inside = radii[starts[g]:starts[g + 1]]
            low = np.searchsorted(inside, least, "left")
            high = np.searchsorted(inside, most, "right")
            asking = np.flatnonzero(low < high)
            if len(asking):
                part = slice(starts[g] + low[asking].min(), starts[g] + high[asking].max())
                best.scored[start + asking] += part.stop - part.start
                which, distance = _close(cells[:, part], block[:, asking],
                                         best.distance[start + asking, -1])
                if len(which):
                    best.take(start + asking[which], distance, ids[part])


def _score_blocks(k: int, names: list[str]) -> Callable:
    """The k best rows of each question among all the blocks that a task sees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, _Best] = {}
        id_type = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                length = row["length"].as_py()
                if length != row["q_length"].as_py():
                    continue
                id_type = row["ids"].values.type
                ids = row["ids"].values.to_numpy(zero_copy_only=False)
                block = row["q_block"].as_py()
                if block not in found:
                    found[block] = _Best(k, row["q_ids"].values, ids)
                _meet(found[block], np.frombuffer(row["q_cells"].as_py()).reshape(length, -1),
                      np.frombuffer(row["cells"].as_py()).reshape(length, -1), ids,
                      np.frombuffer(row["radii"].as_py()),
                      np.frombuffer(row["starts"].as_py(), np.int64),
                      np.frombuffer(row["pivots"].as_py(), np.int64))
        for best in found.values():
            which, rank = np.nonzero(~best.missing)
            yield pa.RecordBatch.from_arrays(
                [best.q_ids.take(pa.array(which)), pa.array(best.ids[which, rank], id_type),
                 pa.array(best.distance[which, rank]),
                 pa.array(np.where(rank == 0, best.scored[which], 0))],
                names=[*names, "distance", "scored"])

    return run


def assemble_context(hits: DataFrame, query_id: str, label: str, text: str) -> DataFrame:
    """One row per query: its retrieved texts as `[label]: text`, blank line between, by rank.

    At most k short rows per query meet, so the lists are bounded by the retrieval itself.
    """
    entry = F.struct(
        "rank",
        F.concat(F.lit("["), F.col(label).cast("string"), F.lit("]: "), F.col(text))
        .alias("passage"))
    ordered = F.array_sort(F.collect_list(entry))
    return hits.groupBy(query_id).agg(
        F.array_join(F.transform(ordered, lambda e: e["passage"]), "\n\n").alias("context"))


def retrieval_log(hits: DataFrame, query_id: str, corpus_id: str, score_format: str
                  ) -> DataFrame:
    """One row per query: retrieved ids, their confidences and how many there were."""
    ordered = F.array_sort(F.collect_list(F.struct(
        "rank", F.col(corpus_id).cast("string").alias("id"),
        F.format_string(score_format, "confidence").alias("score"))))
    return (
        hits.groupBy(query_id).agg(ordered.alias("hits"))
        .select(
            query_id,
            F.array_join(F.transform("hits", lambda h: h["id"]), ", ").alias("retrieved_ids"),
            F.array_join(F.transform("hits", lambda h: h["score"]), ", ")
            .alias("confidence_scores"),
            F.size("hits").alias("num_chunks_retrieved"))
    )
