"""MinHash near-duplicates by an LSH forest.

Every distinct shingle set gets a MinHash signature. The forest is a number of *orders*: each
sorts all signatures by its own sequence of signature columns, by a range shuffle, so that no key
can load one task. A pair that agrees on the first columns of an order lies close together there;
the streaming pass over a sorted partition proposes, for every row, the preceding rows it shares
its longest prefix with. The depth thus adapts to the region: in a sparse one a short prefix
makes neighbours, in a crowded one only the longest do.

Crowded regions need more than neighbours: a text at the rim of a large group may resemble only
the few central ones. So each region's most linked texts are proposed to all of its other texts
that are still in another component: CENTRES candidates per text and region, never all pairs.

Proposals are confirmed on the full sets, and confirmed links are closed into components. What
is then still outside a region's largest component is held against the whole region, blocks of
some bytes against blocks of some bytes, on the full sets: no pair that shares a region stays untested because
the region is crowded, and only links leave the tasks.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm import words
from tablewright.llm.base import Work, few, partitions
from tablewright.llm.graph import components

COLUMNS = 72          # length of a signature: ORDERS * LEAST_PREFIX
SKETCH = 48           # columns of which every forest row carries a byte, to estimate likeness
SKETCH_MISS = 1e-9    # most probable loss of a pair at the threshold to the sketch test
ORDERS = 24           # trees of the forest
DEPTH = 8             # signature columns an order sorts by
LEAST_PREFIX = 3      # columns that neighbours share at least
NEIGHBOURS = 3        # preceding rows looked at
CENTRES = 4           # most linked members of a region that its others are held against

BLOCK_BYTES = 1 << 20 # full sets of a region held against each other at a time, on either side

FEATURES = "id bigint, n_shingles bigint, class binary, signature binary"
FOREST = "tree int, prefix binary, id bigint, sketch binary"
PROPOSED = "kind int, a bigint, b bigint, tree int, prefix binary, sketch binary"
PAIR, MEMBER, RIM = 0, 1, 2


def _multipliers() -> np.ndarray:
    return np.random.default_rng(20).integers(0, 1 << 63, COLUMNS, np.uint64) * np.uint64(2) \
        + np.uint64(1)


@cache
def _orders() -> np.ndarray:
    """Signature columns of each tree, most significant first. No two trees share one of their
    first LEAST_PREFIX columns, so that trees miss a pair independently."""
    rng = np.random.default_rng(21)
    first = rng.permutation(COLUMNS).reshape(ORDERS, LEAST_PREFIX)
    return np.stack([np.concatenate((own, rng.permutation(np.setdiff1d(np.arange(COLUMNS), own))
                                     [:DEPTH - LEAST_PREFIX])) for own in first])


def _sketch_floor(percent: int) -> float:
    """Largest share of agreeing sketch columns that a pair at the threshold falls short of with
    a probability of SKETCH_MISS at most."""
    p, below, k = percent / 100, 0.0, 0
    while k < SKETCH:
        below += math.comb(SKETCH, k) * p ** k * (1 - p) ** (SKETCH - k)
        if below > SKETCH_MISS:
            break
        k += 1
    return k / SKETCH


def _signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of COLUMNS minima per non-empty set."""
    starts = offsets[:-1][np.diff(offsets) > 0]
    out = np.zeros((len(starts), COLUMNS), np.uint32)
    if len(starts):
        for k, factor in enumerate(_multipliers()):
            turned = ((values * factor) >> np.uint64(32)).astype(np.uint32)
            out[:, k] = np.minimum.reduceat(turned, starts)
    return out


def _class_keys(values: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """128 bits for each set: equal for equal sets."""
    import hashlib
    raw = values.astype("<u8").tobytes()
    return [hashlib.blake2b(raw[8 * s:8 * e], digest_size=16).digest()
            for s, e in zip(offsets[:-1], offsets[1:], strict=True)]


def _features(n: int):
    def run(batches):
        for batch in batches:
            values, offsets = words.shingles(*words.hashed(batch.column(1).to_pylist()), n)
            counts = np.diff(offsets)
            rows = iter(_signatures(values, offsets))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(counts, pa.int64()),
                pa.array(_class_keys(values, offsets), pa.binary()),
                pa.array([next(rows).tobytes() if c else None for c in counts], pa.binary()),
            ], names=["id", "n_shingles", "class", "signature"])
    return run


def _sets(n: int):
    def run(batches):
        for batch in batches:
            values, offsets = words.shingles(*words.hashed(batch.column(1).to_pylist()), n)
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                         pa.array(values.view(np.int64))),
            ], names=["id", "members"])
    return run


def _set_bytes(n: int):
    def run(batches):
        for batch in batches:
            values, offsets = words.shingles(*words.hashed(batch.column(1).to_pylist()), n)
            raw = values.astype("<u8").tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([raw[8 * s:8 * e] for s, e in zip(offsets[:-1], offsets[1:],
                                                           strict=True)], pa.binary()),
            ], names=["id", "members"])
    return run


def _forest(batches):
    orders = _orders()
    for batch in batches:
        ids = batch.column(0).to_numpy()
        m = len(ids)
        if not m:
            continue
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(m, COLUMNS)
        low = [row.tobytes() for row in sig[:, :SKETCH].astype(np.uint8)]
        for tree, columns in enumerate(orders):
            prefix = [row.tobytes() for row in sig[:, columns].astype(">u4")]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(m, tree, np.int32)), pa.array(prefix, pa.binary()),
                pa.array(ids), pa.array(low, pa.binary()),
            ], names=["tree", "prefix", "id", "sketch"])


def _proposals(kind: int, a, b=None, tree=None, prefix=None, sketch=None) -> pa.RecordBatch:
    m = len(a)

    def column(values, kind):
        return pa.nulls(m, kind) if values is None else pa.array(values, kind)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(m, kind, np.int32)), column(a, pa.int64()), column(b, pa.int64()),
        column(tree, pa.int32()), column(prefix, pa.binary()), column(sketch, pa.binary()),
    ], names=["kind", "a", "b", "tree", "prefix", "sketch"])


def _neighbours(likeness: float, rim: bool):
    """Stream over rows sorted by (tree, prefix, id). Yields proposed pairs, the members of
    regions that hold several rows and, if asked for, the rows next to the partition's ends."""
    def run(batches):
        held: tuple[list, list, list, list] = ([], [], [], [])
        begun = False
        for batch in batches:
            if not batch.num_rows:
                continue
            new = tuple(batch.column(k).to_pylist() for k in range(4))
            if rim and not begun:
                yield _proposals(RIM, new[2][:NEIGHBOURS], None, new[0][:NEIGHBOURS],
                                 new[1][:NEIGHBOURS], new[3][:NEIGHBOURS])
            begun = True
            old = len(held[0])
            tree, prefix, ids, low = (h + n for h, n in zip(held, new, strict=True))
            m = len(ids)
            trees, keys = np.array(tree), np.array(ids, np.int64)
            columns = np.frombuffer(b"".join(prefix), ">u4").reshape(m, DEPTH)
            sketch = np.frombuffer(b"".join(low), np.uint8).reshape(m, SKETCH)
            together = np.zeros(m, bool)
            for shift in range(1, NEIGHBOURS + 1):
                if m <= shift:
                    break
                same = (columns[shift:, :LEAST_PREFIX] == columns[:-shift, :LEAST_PREFIX]).all(1) \
                    & (trees[shift:] == trees[:-shift])
                later = np.flatnonzero(same) + shift
                later = later[later >= old]
                together[later] = together[later - shift] = True
                agree = (sketch[later] == sketch[later - shift]).mean(1) if len(later) else \
                    np.zeros(0)
                later = later[agree >= likeness]
                x, y = keys[later], keys[later - shift]
                apart = x != y
                yield _proposals(PAIR, np.minimum(x, y)[apart], np.maximum(x, y)[apart])
            at = np.flatnonzero(together)
            yield _proposals(MEMBER, keys[at], None, trees[at],
                             [prefix[i][:4 * LEAST_PREFIX] for i in at], [low[i] for i in at])
            held = tuple(x[-NEIGHBOURS:] for x in (tree, prefix, ids, low))
        if rim and begun:
            yield _proposals(RIM, held[2], None, held[0], held[1], held[3])
    return run


def _alike(likeness: float):
    """Keep the pairs whose sketches agree often enough."""
    def run(batches):
        for batch in batches:
            m = batch.num_rows
            if m:
                x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8)
                        .reshape(m, SKETCH) for k in (2, 3))
                yield batch.filter(pa.array((x == y).mean(1) >= likeness)).select(["a", "b"])
    return run


def _linked(asked: list[dict], rows: list[dict], percent: int, tree: int):
    """Links of the asked rows to rows of other components: one per row and component.

    Two rows that share a region of an earlier tree as well are left to that one.
    """
    sets = [np.frombuffer(r["members"], "<u8") for r in rows]
    sizes = np.array([len(s) for s in sets])
    roots = np.array([r["root"] for r in rows], np.int64)
    ids = np.array([r["id"] for r in rows], np.int64)
    first = _orders()[:tree, :LEAST_PREFIX]
    prefixes = np.frombuffer(b"".join(r["signature"] for r in rows), np.uint32) \
        .reshape(len(rows), COLUMNS)[:, first]
    for one in asked:
        own = np.frombuffer(one["members"], "<u8")
        fits = np.minimum(sizes, len(own)) * 100 >= np.maximum(sizes, len(own)) * percent
        near = np.flatnonzero(fits & (roots != one["root"]))
        mine = np.frombuffer(one["signature"], np.uint32)[first]
        near = near[~(prefixes[near] == mine).all(2).any(1)]
        if not len(near):
            continue
        values = np.concatenate([sets[k] for k in near])
        place = np.minimum(np.searchsorted(own, values), len(own) - 1)
        starts = np.concatenate(([0], np.cumsum(sizes[near])[:-1]))
        shared = np.add.reduceat((own[place] == values).astype(np.int64), starts)
        hits = near[100 * shared >= percent * (len(own) + sizes[near] - shared)]
        _, some = np.unique(roots[hits], return_index=True)
        for k in hits[some]:
            yield int(one["id"]), int(ids[k])


def _compared(percent: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = list(_linked(row["asked"], row["rows"], percent, row["tree"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a for a, _ in found], pa.int64()),
                     pa.array([b for _, b in found], pa.int64())], names=["a", "b"])
    return run


def _completed(members: DataFrame, roots: DataFrame, classes: DataFrame, docs: DataFrame, n: int,
               percent: int, work: Work) -> DataFrame:
    """Links between rows of one region that are in different components.

    `members` has tree, prefix, id. Only regions of several components are looked at, and
    in them only rows outside the largest one ask; each is held against all rows of the region,
    and two rows that share regions of several trees are compared in the first of them only.
    """
    region = ["tree", "prefix"]
    count = members.count()
    rows = work.stored(
        members.select(*region, "id")
        .join(roots.select(F.col("u").alias("id"), "v"), "id", "left")
        .select(*region, "id", F.coalesce("v", "id").alias("root")), "rooted", count)
    mixed = (few(rows.groupBy(*region, "root").count(), count).groupBy(*region)
             .agg(F.max(F.struct("count", (-F.col("root")).alias("r"))).alias("main"),
                  F.sum("count").alias("n"))
             .where("n > main.count").select(*region, (-F.col("main.r")).alias("main")))
    rows = work.stored(
        rows.join(work.stored(mixed, "mixed", count), region)
        .select(*region, "id", "root", (F.col("root") != F.col("main")).alias("asks")),
        "asking", count)
    ids = work.stored(few(rows, count).select("id").distinct(), "ids", count)
    sets = work.stored(docs.join(ids, "id", "left_semi").select("id", "text")
                       .mapInArrow(_set_bytes(n), "id bigint, members binary"), "packed")
    size = F.octet_length("members")
    sizes = work.stored(
        few(rows.join(sets.select("id", size.alias("size")), "id"), count).groupBy(*region).agg(
            F.ceil(F.sum("size") / BLOCK_BYTES).alias("blocks"),
            F.ceil(F.sum(F.when(F.col("asks"), F.col("size"))) / BLOCK_BYTES).alias("asking")),
        "sizes", count)
    full = (rows.join(sizes, region).join(sets, "id")
            .join(classes.select(F.col("rep").alias("id"), "signature"), "id"))

    def blocks(some: DataFrame, parts: str, name: str) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.col(parts)).alias("block")
        return work.stored(
            some.groupBy(*region, block)
            .agg(F.collect_list(F.struct("id", "root", "members", "signature")).alias(name))
            .drop("block"), name)

    asked, blocks = blocks(full.where("asks"), "asking", "asked"), blocks(full, "blocks", "rows")
    found = asked.join(blocks, region).select("tree", "asked", "rows")
    return work.stored(
        found.mapInArrow(_compared(percent), "a bigint, b bigint").distinct(),
        "completed")


def _confirmed(pairs: DataFrame, docs: DataFrame, n: int, percent: int, work: Work) -> DataFrame:
    """The pairs whose full sets reach the threshold; sets are made anew from the whole texts."""
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = work.stored(
        docs.join(work.stored(ends, "ends", 2 * pairs.count()), "id", "left_semi").select("id", "text")
        .mapInArrow(_sets(n), "id bigint, members array<bigint>"), "sets")
    left = sets.select(F.col("id").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("members").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    return work.stored(
        pairs.join(left, "a").join(right, "b")
        .withColumn("shared", shared)
        .where(100 * F.col("shared") >= percent * (F.size("x") + F.size("y") - F.col("shared")))
        .select("a", "b"), "confirmed")


def near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 80,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents whose shingle sets have a Jaccard similarity of percent/100 or more.

    Returns one row per input row: `doc_id`, `n_shingles`, `component_id` (the smallest id that
    links lead to, its own included), `kept` (it is that smallest one).

    Words are split at ASCII white space, A-Z lower-cased. A text with fewer words than a shingle
    has its whole sequence as its only shingle; an empty, blank or null text has none and is
    linked with nothing. Equal sets are one class and need no comparison. Rows that repeat an id
    are one node. A row without an id is in no group: its `component_id` is null and it is kept.
    Extra columns are ignored. An empty table gives an empty result.

    A pair at 0.8 shares LEAST_PREFIX columns in at least one of ORDERS trees, which have no such
    column in common, with probability 1 - (1 - 0.8^3)^24, all but 1 in 30 million; more similar
    pairs are missed less. The sketch test, always on the same columns, adds 1 in 10^9 at most.
    """
    spark = docs.sparkSession
    work = Work(spark, "near-dup")
    n_parts = partitions(spark)
    likeness = _sketch_floor(percent)
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))

    features = work.stored(docs.mapInArrow(_features(shingle), FEATURES), "features")
    classes = work.stored(
        features.where("n_shingles > 0 and id is not null").groupBy("class")
        .agg(F.min("id").alias("rep"), F.first("signature").alias("signature")), "classes")

    by_order = ["tree", "prefix", "id"]
    streamed = work.stored(
        classes.select("rep", "signature").mapInArrow(_forest, FOREST)
        .repartitionByRange(n_parts, *by_order).sortWithinPartitions(*by_order)
        .mapInArrow(_neighbours(likeness, rim=True), PROPOSED), "proposed")
    # At most 2 * NEIGHBOURS rows per partition: one task puts the partitions' ends together.
    ends = work.stored(
        streamed.where(F.col("kind") == RIM).select("tree", "prefix", F.col("a").alias("id"),
                                                    "sketch")
        .coalesce(1).sortWithinPartitions(*by_order)
        .mapInArrow(_neighbours(likeness, rim=False), PROPOSED), "ends")
    proposed = streamed.where(F.col("kind") != RIM).unionByName(ends)
    count = proposed.count()
    pairs = work.stored(
        proposed.where(F.col("kind") == PAIR).select("a", "b").distinct(), "pairs", count)
    links = _confirmed(pairs, docs, shingle, percent, work)
    roots = components(links, work)

    # Crowded regions: the most linked member against those still elsewhere.
    region = ["tree", "prefix"]
    degree = links.select(F.col("a").alias("id")).union(links.select("b")) \
        .groupBy("id").agg(F.count("*").alias("degree"))
    members = work.stored(
        proposed.where(F.col("kind") == MEMBER)
        .select("tree", "prefix", F.col("a").alias("id"), "sketch").distinct()
        .join(work.stored(degree, "degree", count), "id", "left")
        .join(roots.select(F.col("u").alias("id"), "v"), "id", "left")
        .select("tree", "prefix", "id", "sketch", F.coalesce("degree", F.lit(0)).alias("degree"),
                F.coalesce("v", "id").alias("root")), "members", count)
    crowded = members.groupBy(*region).count().where(F.col("count") > NEIGHBOURS + 1)
    members = work.stored(
        members.join(work.stored(crowded.drop("count"), "crowded", count), region, "left_semi"),
        "rows", count)
    ranked = Window.partitionBy(*region).orderBy(F.desc("degree"), "id")
    centres = work.stored(
        members.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= CENTRES)
        .select(*region, F.struct("id", "root", "sketch").alias("c")), "centres", count)
    more = (members.join(centres, region).where("root != c.root")
            .select(F.least("id", F.col("c.id")).alias("a"),
                    F.greatest("id", F.col("c.id")).alias("b"), "sketch",
                    F.col("c.sketch").alias("other"))
            .mapInArrow(_alike(likeness), "a bigint, b bigint").distinct()
            .join(pairs, ["a", "b"], "left_anti"))
    more = work.stored(more, "more")
    if not more.isEmpty():
        late = _confirmed(more, docs, shingle, percent, work)
        if not late.isEmpty():
            merged = roots.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(late)
            roots = components(merged, work)
    last = _completed(members, roots, classes, docs, shingle, percent, work)
    if not last.isEmpty():
        merged = roots.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(last)
        roots = components(merged, work)

    named = work.stored(
        classes.select("class", "rep")
        .join(roots.select(F.col("u").alias("rep"), "v"), "rep", "left")
        .select("class", F.coalesce("v", "rep").alias("root")), "named")
    found = (features.select("id", "n_shingles", "class").join(named, "class", "left")
             .select("id", "n_shingles",
                     F.coalesce("root", "id").alias("component_id")))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.when(
        F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
