"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Rows are dealt to shards by a hash of their position. Each shard's distinct vectors become the nodes
of a graph with levels: a node reaches level l with probability LINKS ** -l. Nodes are numbered from
the highest level down, so that the nodes of a level are a prefix, and a level is one flat array of
neighbour numbers. Queries meet every shard in blocks: they descend greedily to the lowest level and
run a beam search there, many queries at a time; the nearest rows of all shards are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.base import Work, partitions

TOP = 10
QUERY_EVERY = 100
SHARD_ROWS = 8192              # rows of one graph, on average
QUERY_ROWS = 1024              # queries that search together, on average
LINKS = 16                     # neighbours of a node; twice as many on the lowest level
BEAM_BUILD, BEAM_SEARCH = 64, 160
BEAM_ABOVE = 24                # nodes that lead from one level to the next
SCANNED = 640                  # nodes of a level that is looked at in full
OPENED = 4                     # nodes of a beam whose neighbours are looked up at a time
BRIDGES = 2                    # extra neighbours by which otherwise unreachable nodes are reached
FIRST, MOST = 64, 1024         # nodes inserted at a time: as many as the level has, within these
AT_ONCE = 256                  # queries or new nodes whose distances are held at a time

SHARDS = ("dimensions int, n int, rows int, starts binary, row_ids binary, vec_ids binary, "
          "vectors binary, level_sizes binary, neighbours binary")
BLOCKS = "dimensions int, rows int, row_ids binary, vec_ids binary, vectors binary"
HITS = "query_row bigint, query_id bigint, vec_id bigint, row_id bigint, score double"


def distances(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Euclidean distances of pairs of rows in double precision, without overflow or underflow."""
    with np.errstate(over="ignore"):
        gaps = vectors / 2 - queries / 2         # the difference of two doubles may overflow
        largest = np.abs(gaps).max(-1, keepdims=True)
        plain = np.sqrt(((vectors - queries) ** 2).sum(-1))
    odd = (largest[..., 0] > 1e140) | ((largest[..., 0] < 1e-140) & (largest[..., 0] > 0))
    if odd.any():
        scale = np.where(largest > 0, largest, 1.0)
        with np.errstate(over="ignore"):
            scaled = np.sqrt(((gaps / scale) ** 2).sum(-1)) * scale[..., 0] * 2
        plain = np.where(odd, scaled, plain)
    return plain


def _heights(n: int, links: int) -> np.ndarray:
    """Numbers of levels above the lowest, for each place in an order of insertion."""
    heights = np.floor(-np.log(1 - np.random.default_rng(n).random(n)) / np.log(links))
    return np.sort(np.minimum(heights, 8).astype(np.int64))[::-1]


class Graph:
    """Levels of flat neighbour arrays over vectors that are numbered from the top level down."""

    def __init__(self, vectors: np.ndarray, levels: list[np.ndarray]):
        self.vectors, self.levels = vectors, levels
        self.squares = (vectors ** 2).sum(1)

    # Building ----------------------------------------------------------------------------

    @classmethod
    def built(cls, vectors: np.ndarray, links: int = LINKS, beam: int = BEAM_BUILD) -> Graph:
        """The graph of distinct vectors, which are numbered in their order of insertion."""
        heights = _heights(len(vectors), links)
        graph = cls(vectors, [])
        for level in range(int(heights[0]) if len(heights) else -1, -1, -1):
            size = int((heights >= level).sum())
            graph._add_level(size, 2 * links if level == 0 else links, links, beam)
        return graph

    def _add_level(self, size: int, room: int, links: int, beam: int) -> None:
        """Insert the nodes 0 to `size` into a new lowest level, in batches that double."""
        near = np.full((size, room + BRIDGES), -1, np.int32)
        above, self.levels = self.levels, [near, *self.levels]
        done = min(size, FIRST)
        everyone = np.arange(done)
        self._link(near, everyone, np.broadcast_to(everyone, (done, done)), links, room)
        while done < size:
            upto = min(size, done + min(done, MOST))
            new = np.arange(done, upto)
            for at in range(0, len(new), AT_ONCE):
                some = new[at:at + AT_ONCE]
                entries = self._entries(self.vectors[some], above)
                found = self._beam(near, self.vectors[some], entries, beam)
                # Nodes of the same batch do not see each other in the graph yet.
                gaps = self._matrix(some, new)
                gaps[np.arange(len(some)), some - done] = np.inf
                close = np.argsort(gaps, 1, kind="stable")[:, :links]
                mates = np.where(np.take_along_axis(gaps, close, 1) < np.inf, new[close], -1)
                self._link(near, some, np.concatenate((found, mates), 1), links, room)
            done = upto
        self._bridge(near)

    def _matrix(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        gaps = (self.squares[left][:, None] + self.squares[right][None]
                - 2 * self.vectors[left] @ self.vectors[right].T)
        return np.maximum(gaps, 0)

    def _chosen(self, nodes: np.ndarray, candidates: np.ndarray, room: int) -> np.ndarray:
        """At most `room` neighbours of each node, near and in different directions.

        A candidate (-1: none) is passed over if it is nearer to one that was taken before than to
        the node; what room is left goes to the nearest of those passed over.
        """
        out = np.full((len(nodes), room), -1, np.int32)
        for at in range(0, len(nodes), AT_ONCE):
            own, some = nodes[at:at + AT_ONCE], np.sort(candidates[at:at + AT_ONCE], 1)
            valid = (some >= 0) & (some != own[:, None])
            valid[:, 1:] &= some[:, 1:] != some[:, :-1]
            points = self.vectors[some]
            gaps = ((points - self.vectors[own][:, None]) ** 2).sum(2)
            gaps[~valid] = np.inf
            order = np.argsort(gaps, 1, kind="stable")[:, :3 * room]
            some, gaps = np.take_along_axis(some, order, 1), np.take_along_axis(gaps, order, 1)
            points = np.take_along_axis(points, order[:, :, None], 1)
            squares = (points ** 2).sum(2)
            between = squares[:, :, None] + squares[:, None] - 2 * points @ points.transpose(0, 2, 1)
            taken = np.zeros(some.shape, bool)
            for j in range(some.shape[1]):
                shadowed = (taken & (between[:, j] < gaps[:, j, None])).any(1)
                taken[:, j] = ~shadowed & (gaps[:, j] < np.inf) & (taken.sum(1) < room)
            # Taken ones first, then the others, each by distance.
            place = np.argsort(np.where(taken, 0, np.where(gaps < np.inf, 1, 2)), 1, kind="stable")
            kept = np.take_along_axis(np.where(gaps < np.inf, some, -1), place, 1)[:, :room]
            out[at:at + AT_ONCE, :kept.shape[1]] = kept
        return out

    def _link(self, near, nodes, candidates, links: int, room: int) -> None:
        """Give new nodes their neighbours, and enter them with those neighbours in turn."""
        # Mates that came before may have entered the new nodes already.
        chosen = self._chosen(nodes, np.concatenate((candidates, near[nodes, :room]), 1), links)
        near[nodes, :links], near[nodes, links:room] = chosen, -1
        owner, target = np.repeat(nodes, links), chosen.ravel()
        owner, target = owner[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        owner, target = owner[order], target[order]
        hubs, first, counts = np.unique(target, return_index=True, return_counts=True)
        for width in np.unique(counts):
            same = counts == width
            hub = hubs[same]
            fresh = owner[first[same][:, None] + np.arange(width)]
            near[hub, :room] = self._chosen(
                hub, np.concatenate((near[hub, :room], fresh), 1), room)

    def _bridge(self, near: np.ndarray) -> None:
        """Reach every node from node 0: an unreached one becomes the extra neighbour of the nearest
        reached node that has room for one."""
        reached = np.zeros(len(near), bool)

        def spread(front: np.ndarray) -> None:
            while len(front):
                reached[front] = True
                beyond = np.unique(near[front])
                beyond = beyond[beyond >= 0]
                front = beyond[~reached[beyond]]

        spread(np.array([0]))
        while not reached.all():
            node = int(np.argmin(reached))
            hosts = np.flatnonzero(reached & (near[:, -1] < 0))
            host = hosts[np.argmin(self._matrix(np.array([node]), hosts)[0])]
            near[host, np.flatnonzero(near[host, -BRIDGES:] < 0)[0] - BRIDGES] = node
            spread(np.array([node]))

    # Searching ---------------------------------------------------------------------------

    def _gaps(self, queries: np.ndarray, own: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances of each query to its nodes (-1: infinitely far); `own`: its square."""
        dots = np.matmul(self.vectors[nodes], queries[:, :, None])[:, :, 0]
        gaps = self.squares[nodes] - 2 * dots + own[:, None]
        return np.where(nodes >= 0, np.maximum(gaps, 0), np.inf)

    def _entries(self, queries: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Near nodes of the lowest of `levels` for each query, level by level from the top.

        Small levels are looked at in full, so that groups far from each other are all found.
        """
        small = [level for level, near in enumerate(levels) if len(near) <= SCANNED]
        if not small:
            return np.zeros((len(queries), 1), np.int64)
        size = len(levels[small[0]])
        gaps = self.squares[:size] - 2 * queries @ self.vectors[:size].T
        at = np.argsort(gaps, 1, kind="stable")[:, :BEAM_ABOVE]
        for near in reversed(levels[:small[0]]):
            at = self._beam(near, queries, at, BEAM_ABOVE)
        return at

    def _beam(self, near, queries, entries, beam: int) -> np.ndarray:
        """The `beam` nearest nodes found from the entries, nearest first (-1: none)."""
        n, own = len(queries), (queries ** 2).sum(1)
        seen = np.zeros((n, len(near)), bool)
        everyone = np.arange(n)[:, None]
        room = max(0, beam - entries.shape[1])
        nodes = np.concatenate((entries, np.full((n, room), -1, np.int64)), 1)
        opened = nodes < 0
        gaps = self._gaps(queries, own, nodes)
        seen[np.broadcast_to(everyone, nodes.shape)[~opened], nodes[~opened]] = True
        live = np.arange(n)
        while len(live):
            waiting = np.where(opened[live], np.inf, gaps[live])
            some = np.argpartition(waiting, OPENED - 1, 1)[:, :OPENED] if beam > OPENED \
                else np.argsort(waiting, 1)[:, :OPENED]
            ready = np.take_along_axis(waiting, some, 1) < np.inf
            going = ready.any(1)
            live, some, ready = live[going], some[going], ready[going]
            if not len(live):
                break
            rows = live[:, None]
            opened[rows, some] = True
            around = near[np.where(ready, nodes[rows, some], 0)]
            around = np.where(ready[:, :, None], around, -1).reshape(len(live), -1)
            around = np.sort(around, 1)
            new = around >= 0
            new[:, 1:] &= around[:, 1:] != around[:, :-1]
            new &= ~seen[rows, around]
            # Move the new ones to the front, so that no more columns are needed than the most have.
            width = int(new.sum(1).max())
            around = np.take_along_axis(np.where(new, around, -1),
                                        np.argsort(~new, 1, kind="stable")[:, :width], 1)
            new = around >= 0
            seen[np.broadcast_to(rows, around.shape)[new], around[new]] = True
            all_gaps = np.concatenate((gaps[live], self._gaps(queries[live], own[live], around)), 1)
            best = np.argpartition(all_gaps, min(beam, all_gaps.shape[1]) - 1, 1)[:, :beam]
            gaps[live] = np.take_along_axis(all_gaps, best, 1)
            nodes[live] = np.take_along_axis(np.concatenate((nodes[live], around), 1), best, 1)
            opened[live] = np.take_along_axis(np.concatenate(
                (opened[live], np.zeros(around.shape, bool)), 1), best, 1) | (nodes[live] < 0)
        return np.take_along_axis(nodes, np.argsort(gaps, 1, kind="stable"), 1)

    def nearest(self, queries: np.ndarray, beam: int = BEAM_SEARCH) -> np.ndarray:
        """Node numbers near each query (-1: none), as found by the beam."""
        n = len(self.vectors)
        if n <= beam:
            return np.broadcast_to(np.arange(n), (len(queries), n))
        out = [self._beam(self.levels[0], part, self._entries(part, self.levels[1:]), beam)
               for part in np.split(queries, range(AT_ONCE, len(queries), AT_ONCE))]
        return np.concatenate(out)


def _matrix_of(column, dimensions: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten(), np.float64).reshape(-1, dimensions)


def _binary(values, kind: str) -> pa.Array:
    return pa.array([np.ascontiguousarray(values, kind).tobytes()], pa.binary())


def _shard(key, table):
    """One row: the distinct vectors of a shard, the rows that have them, and their graph."""
    dimensions = key[0].as_py()
    vectors = _matrix_of(table["vector"], dimensions)
    row_ids, vec_ids = (table[c].to_numpy() for c in ("row_id", "vec_id"))
    distinct, owner = np.unique(vectors, axis=0, return_inverse=True)
    order = np.random.default_rng(len(distinct)).permutation(len(distinct))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    owner = place[owner.ravel()]
    rows = np.lexsort((row_ids, vec_ids, owner))
    graph = Graph.built(distinct[order])
    return pa.Table.from_arrays([
        pa.array([dimensions], pa.int32()), pa.array([len(order)], pa.int32()),
        pa.array([len(rows)], pa.int32()),
        _binary(np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(order))))), "<i8"),
        _binary(row_ids[rows], "<i8"), _binary(vec_ids[rows], "<i8"),
        _binary(graph.vectors, "<f8"), _binary([len(a) for a in graph.levels], "<i4"),
        _binary(np.concatenate([a.ravel() for a in graph.levels]), "<i4"),
    ], names=[c.split()[0] for c in SHARDS.split(", ")])


def _block(key, table):
    return pa.Table.from_arrays([
        pa.array([key[0].as_py()], pa.int32()), pa.array([table.num_rows], pa.int32()),
        _binary(table["row_id"].to_numpy(), "<i8"), _binary(table["vec_id"].to_numpy(), "<i8"),
        _binary(_matrix_of(table["vector"], key[0].as_py()), "<f8"),
    ], names=[c.split()[0] for c in BLOCKS.split(", ")])


def read_graph(row: dict) -> Graph:
    """The graph that a shard's row holds."""
    vectors = np.frombuffer(row["vectors"]).reshape(row["n"], row["dimensions"])
    flat, levels, at = np.frombuffer(row["neighbours"], "<i4"), [], 0
    for level, size in enumerate(np.frombuffer(row["level_sizes"], "<i4")):
        wide = (LINKS if level else 2 * LINKS) + BRIDGES
        levels.append(flat[at:at + size * wide].reshape(size, wide))
        at += size * wide
    return Graph(vectors, levels)


def search_shard(graph: Graph, row: dict, k: int) -> pa.RecordBatch:
    """The k nearest rows of a shard for each query of a block, among those that the beams found."""
    starts, row_ids, vec_ids = (np.frombuffer(row[c], "<i8") for c in ("starts", "row_ids", "vec_ids"))
    query_rows, query_ids = (np.frombuffer(row[c], "<i8") for c in ("q_row_ids", "q_vec_ids"))
    queries = np.frombuffer(row["q_vectors"]).reshape(len(query_rows), row["dimensions"])
    distinct, owner = np.unique(queries, axis=0, return_inverse=True)
    owner = owner.ravel()
    found = graph.nearest(distinct)
    out = []
    for j in range(len(distinct)):
        nodes = found[j][found[j] >= 0]
        gaps = distances(distinct[j], graph.vectors[nodes])
        # Enough of the nearest nodes for k rows besides the query's own, ties whole.
        if len(nodes) > k + 1:
            bar = np.partition(gaps, k)[k]
            nodes, gaps = nodes[gaps <= bar], gaps[gaps <= bar]
        # Rows of a node come by id, so its first k + 1 suffice.
        counts = np.minimum(starts[nodes + 1] - starts[nodes], k + 1)
        rows = np.repeat(starts[nodes] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        gaps = np.repeat(gaps, counts)
        order = np.lexsort((row_ids[rows], vec_ids[rows], gaps))[:k + 1]
        rows, gaps = rows[order], gaps[order]
        for q in np.flatnonzero(owner == j):
            others = np.flatnonzero(row_ids[rows] != query_rows[q])[:k]
            out.append((np.full(len(others), query_rows[q]), np.full(len(others), query_ids[q]),
                        vec_ids[rows[others]], row_ids[rows[others]], gaps[others]))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns],
                                      names=["query_row", "query_id", "vec_id", "row_id", "score"])


def _searched(k: int):
    def run(batches):
        held = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                if batch.column("dimensions")[at] != batch.column("q_dimensions")[at]:
                    continue
                row = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                # Rows of one shard follow each other: its graph is read once.
                if held[0] != (row["dimensions"], row["row_ids"]):
                    held = (row["dimensions"], row["row_ids"]), read_graph(row)
                yield search_shard(held[1], row, k)
    return run


def nearest(vectors: DataFrame, *, k: int = TOP, query_every: int = QUERY_EVERY,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest rows found of each query: `query_id`, `rank`, `vec_id`, `score`.

    Queries are the rows whose id is divisible by `query_every`; candidates are all rows but the
    query's own. The score is the Euclidean distance of the original vectors in double precision;
    nearest first, ties to the smaller id. Every row is in the index of its shard, and every query
    searches every shard; that the nearest are found is likely, not certain (the README has the
    measured recall). Shards of at most BEAM_SEARCH distinct vectors are searched in full, so a
    query with fewer than k candidates gets them all.

    Null, empty and zero vectors, ones that hold a null or non-finite component, and rows without
    an id take no part. Only vectors of equal length are compared. Rows that repeat an id are
    candidates and queries each, and so are rows that repeat a vector: a node of the graph holds all
    rows with its vector. Extra columns are ignored; an empty table gives an empty result.
    """
    work = Work(vectors.sparkSession, "graph")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"),
                          # Adding zero turns negative zeros into positive ones.
                          F.transform(F.col(vector_col).cast("array<double>"),
                                      lambda x: x + F.lit(0.0)).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = work.stored(
        rows.where(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
        .select(F.monotonically_increasing_id().alias("row_id"), "vec_id", "vector",
                F.size("vector").alias("dimensions")), "usable")
    asking = usable.where(F.col("vec_id") % query_every == 0)

    def dealt(df: DataFrame, size: int) -> DataFrame:
        parts = max(1, -(-df.count() // size))
        return df.withColumn("part", F.pmod(F.xxhash64("row_id"), F.lit(parts))) \
            .groupBy("dimensions", "part")

    shards = work.stored(dealt(usable, SHARD_ROWS).applyInArrow(_shard, SHARDS), "shards")
    blocks = work.stored(dealt(asking, QUERY_ROWS).applyInArrow(_block, BLOCKS), "queries")
    blocks = blocks.drop("rows").select(
        *[F.col(c).alias(f"q_{c}") for c in ("dimensions", "row_ids", "vec_ids", "vectors")])
    tasks = max(1, min(shards.count(), 4 * partitions(vectors.sparkSession)))
    hits = shards.drop("rows").repartition(tasks).crossJoin(blocks).mapInArrow(_searched(k), HITS)
    order = Window.partitionBy("query_row").orderBy("score", "vec_id", "row_id")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
