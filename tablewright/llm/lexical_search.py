"""Exact ranked lexical search with two trees.

Documents and items are sparse vectors over the items' terms. A document's coordinate is the term's
weight times its saturated frequency, an item's coordinate is how often it holds the term; the score
is their inner product, in whole numbers. Documents lie in blocks. Per block, both sides get a
hierarchy whose nodes hold coordinate maxima. The inner product of two nodes' maxima bounds every
pair below them: a pair of nodes whose bound is below the weakest k-th score of its items goes, with
all its pairs. Each item's k best so far are carried from block to block of a task.
"""

from __future__ import annotations

import zlib
from collections import Counter, OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm import bitmap
from tablewright.llm.base import Work, partitions

TOP = 20
BLOCK_DOCS = 4096
BLOCK_POSTINGS = 1_000_000     # a block ends beyond so many (document, term) entries
BLOCK_ITEMS = 512
DOC_FAN, ITEM_FAN = 16, 8      # children of a node
FILTER_BITS = 1 << 20          # bit table of the items' terms, by CRC-32
HELD_BLOCKS = 256              # item blocks whose results a task holds at a time

# Bytes outside 0-9, A-Z, a-z and non-ASCII characters separate terms; A-Z is lower-cased.
TERM_BYTES = bytes(c if c >= 128 or chr(c).isdigit() or chr(c).islower() else
                   c + 32 if chr(c).isupper() else 32 for c in range(256))

DOC_BLOCKS = ("docs bigint, words bigint, n int, ids binary, null_ids binary, sizes binary, "
              "terms array<binary>, term_docs array<bigint>, starts binary, places binary, "
              "counts binary")
ITEM_TERMS = "item bigint, item_id bigint, term binary, count bigint"
ITEM_BLOCKS = ("block int, n int, items binary, ids binary, null_ids binary, terms array<binary>, "
               "weights binary, starts binary, places binary, counts binary")
HITS = "item bigint, item_id bigint, doc_id bigint, score bigint"


def terms_of(raw: bytes | None) -> list[bytes]:
    """All terms of a UTF-8 text, in order."""
    return (raw or b"").translate(TERM_BYTES).split()


def _item_terms(batches):
    for batch in batches:
        rows = [(item, item_id, term, count)
                for item, item_id, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                for term, count in Counter(terms_of(raw)).items()]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.int64()),
                                            strict=True)],
            names=["item", "item_id", "term", "count"])


def _binary(values, kind: str) -> pa.Array:
    return pa.array([np.asarray(values, kind).tobytes()], pa.binary())


class _DocBlock:
    """Documents of one block as they are read: only terms that an item may hold are kept."""

    def __init__(self):
        self.docs = self.words = 0
        self.ids, self.sizes, self.starts = [], [], [0]
        self.places, self.counts = [], []
        self.terms: dict[bytes, int] = {}
        self.term_docs: list[int] = []

    def add(self, doc_id: int | None, raw: bytes | None, wanted: bytes) -> None:
        found = terms_of(raw)
        if not found:
            return
        self.docs += 1
        self.words += len(found)
        before = len(self.places)
        for term, count in Counter(found).items():
            if wanted[zlib.crc32(term) % FILTER_BITS]:
                place = self.terms.setdefault(term, len(self.terms))
                if place == len(self.term_docs):
                    self.term_docs.append(0)
                self.term_docs[place] += 1
                self.places.append(place)
                self.counts.append(count)
        if len(self.places) > before:
            self.ids.append(doc_id)
            self.sizes.append(len(found))
            self.starts.append(len(self.places))

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCS or len(self.places) >= BLOCK_POSTINGS

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([self.docs], pa.int64()), pa.array([self.words], pa.int64()),
            pa.array([len(self.ids)], pa.int32()),
            _binary([i or 0 for i in self.ids], "<i8"), _binary([i is None for i in self.ids], "u1"),
            _binary(self.sizes, "<i8"),
            pa.array([list(self.terms)], pa.list_(pa.binary())),
            pa.array([self.term_docs], pa.list_(pa.int64())),
            _binary(self.starts, "<i8"), _binary(self.places, "<i4"), _binary(self.counts, "<i8"),
        ], names=[c.split()[0] for c in DOC_BLOCKS.split(", ")])


def _doc_blocks(wanted):
    def run(batches):
        flags = np.unpackbits(wanted.value, bitorder="little").tobytes()
        block = _DocBlock()
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block.add(doc_id, raw.as_py(), flags)
                if block.full():
                    yield block.batch()
                    block = _DocBlock()
        if block.docs:
            yield block.batch()
    return run


def _item_blocks(key, table):
    """One block of items, from its (item, term, count, weight) rows."""
    items, first, owner = np.unique(table["item"].to_numpy(), return_index=True, return_inverse=True)
    ids = table["item_id"].take(pa.array(first)).to_pylist()
    terms: dict[bytes, int] = {}
    places = np.array([terms.setdefault(t, len(terms)) for t in table["term"].to_pylist()], np.int64)
    weights = np.zeros(len(terms), np.int64)
    weights[places] = table["weight"].to_numpy()
    order = np.lexsort((places, owner))
    starts = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(items)))))
    return pa.Table.from_arrays([
        pa.array([key[0].as_py()], pa.int32()), pa.array([len(items)], pa.int32()),
        _binary(items, "<i8"), _binary([i or 0 for i in ids], "<i8"),
        _binary([i is None for i in ids], "u1"),
        pa.array([list(terms)], pa.list_(pa.binary())), _binary(weights, "<i8"),
        _binary(starts, "<i8"), _binary(places[order], "<i4"),
        _binary(table["count"].to_numpy()[order], "<i8"),
    ], names=[c.split()[0] for c in ITEM_BLOCKS.split(", ")])


class Tree:
    """Levels of nodes over sparse vectors; level 0 is the vectors, the last has one node.

    A level is (starts, places, values): node j holds its coordinates at starts[j]:starts[j + 1],
    each the maximum over the node's children. Vectors with the same largest coordinate lie together.
    """

    def __init__(self, starts: np.ndarray, places: np.ndarray, values: np.ndarray, fan: int):
        n = len(starts) - 1
        owner = np.repeat(np.arange(n), np.diff(starts))
        largest = np.lexsort((-values, owner))
        largest = largest[np.unique(owner[largest], return_index=True)[1]]
        lead = np.full(n, -1, np.int64)
        height = np.zeros(n, np.int64)
        lead[owner[largest]], height[owner[largest]] = places[largest], values[largest]
        self.order = np.lexsort((-height, lead))
        rank = np.empty(n, np.int64)
        rank[self.order] = np.arange(n)
        self.fan = fan
        self.levels = [self._level(rank[owner], places, values, n)]
        while n > 1:
            nodes = np.repeat(np.arange(n), np.diff(self.levels[-1][0])) // fan
            n = -(-n // fan)
            self.levels.append(self._level(nodes, *self.levels[-1][1:], n))

    @staticmethod
    def _level(nodes, places, values, n):
        order = np.lexsort((places, nodes))
        nodes, places, values = nodes[order], places[order], values[order]
        new = np.ones(len(nodes), bool)
        new[1:] = (nodes[1:] != nodes[:-1]) | (places[1:] != places[:-1])
        at = np.flatnonzero(new)
        values = np.maximum.reduceat(values, at) if len(at) else values
        counts = np.bincount(nodes[at], minlength=n)
        return np.concatenate(([0], np.cumsum(counts))), places[at], values

    def width(self, level: int) -> int:
        return len(self.levels[level][0]) - 1

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Nodes of the level below."""
        below = (nodes[:, None] * self.fan + np.arange(self.fan)).ravel()
        return below[below < self.width(level - 1)]

    def products(self, level: int, nodes: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Inner product of a dense vector with each of the nodes' vectors of maxima."""
        starts, places, values = self.levels[level]
        counts = starts[nodes + 1] - starts[nodes]
        ends = np.cumsum(counts)
        rows = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[nodes] - ends + counts, counts)
        sums = np.concatenate(([0], np.cumsum(dense[places[rows]] * values[rows])))
        return sums[ends] - sums[ends - counts]

    def dense(self, level: int, node: int, width: int) -> np.ndarray:
        starts, places, values = self.levels[level]
        out = np.zeros(width, np.int64)
        out[places[starts[node]:starts[node + 1]]] = values[starts[node]:starts[node + 1]]
        return out


class Items:
    """One block of items with its tree and, per item, the k best documents so far."""

    def __init__(self, row: dict, k: int):
        self.k, self.n = k, row["n"]
        self.items, self.ids = (np.frombuffer(row[c], "<i8") for c in ("items", "ids"))
        self.null_ids = np.frombuffer(row["null_ids"], "u1")
        self.place = {term: i for i, term in enumerate(row["terms"])}
        self.weights = np.frombuffer(row["weights"], "<i8")
        self.tree = Tree(np.frombuffer(row["starts"], "<i8"), np.frombuffer(row["places"], "<i4"),
                         np.frombuffer(row["counts"], "<i8"), ITEM_FAN)
        none = np.zeros(0, np.int64)
        self.best = [(none, none, none)] * self.n       # scores, null ids, ids; by place in the tree
        self.bars = np.ones(self.n, np.int64)           # least score that may still enter

    def weakest(self, level: int, node: int) -> int:
        wide = ITEM_FAN ** level
        return int(self.bars[node * wide:(node + 1) * wide].min())

    def offer(self, item: int, scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray) -> None:
        """Keep the k best: highest score first, then the smallest id, rows without an id last."""
        have = [np.concatenate(pair) for pair in zip(self.best[item], (scores, nulls, ids), strict=True)]
        best = np.lexsort((have[2], have[1], -have[0]))[:self.k]
        self.best[item] = tuple(a[best] for a in have)
        if len(best) == self.k:
            self.bars[item] = self.best[item][0][-1]

    def hits(self) -> pa.RecordBatch:
        counts = [len(b[0]) for b in self.best]
        owner = np.repeat(self.tree.order, counts)
        scores, nulls, ids = (np.concatenate(a) for a in zip(*self.best, strict=True))
        return pa.RecordBatch.from_arrays([
            pa.array(self.items[owner]),
            pa.array(self.ids[owner], mask=self.null_ids[owner] == 1),
            pa.array(ids, mask=nulls == 1), pa.array(scores)],
            names=["item", "item_id", "doc_id", "score"])


class Docs:
    """The tree of one block of documents over the terms of one block of items."""

    def __init__(self, row: dict, items: Items, docs: int, words: int):
        of_item = np.array([items.place.get(t, -1) for t in row["terms"]], np.int64)
        places = of_item[np.frombuffer(row["places"], "<i4")]
        sizes = np.frombuffer(row["sizes"], "<i8")
        starts = np.frombuffer(row["starts"], "<i8")
        owner = np.repeat(np.arange(row["n"]), np.diff(starts))
        kept = places >= 0
        places, owner, counts = places[kept], owner[kept], np.frombuffer(row["counts"], "<i8")[kept]
        length = np.array([100 - 25 + 25 * int(n) * docs // words for n in sizes], np.int64)
        values = items.weights[places] * (1_000_000_000 * counts // (1000 * counts + 12 * length[owner]))
        used, owner = np.unique(owner, return_inverse=True)
        self.ids = np.frombuffer(row["ids"], "<i8")[used]
        self.nulls = np.frombuffer(row["null_ids"], "u1")[used].astype(np.int64)
        starts = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(used)))))
        self.tree = Tree(starts.astype(np.int64), places, values, DOC_FAN)


def search(items: Items, docs: Docs) -> int:
    """Offer every document that may enter to its items; returns the number of scored pairs."""
    if not len(docs.ids) or not items.n:
        return 0
    width, top = len(items.weights), len(docs.tree.levels) - 1
    scored = 0

    def visit(item_level: int, node: int, doc_level: int, nodes: np.ndarray) -> None:
        nonlocal scored
        dense = items.tree.dense(item_level, node, width)
        bounds = docs.tree.products(doc_level, nodes, dense)
        keep = bounds >= items.weakest(item_level, node)
        nodes, bounds = nodes[keep], bounds[keep]
        if not len(nodes):
            return
        if item_level:
            # One side after the other: the documents' nodes open while their leaves are far.
            if doc_level > 1:
                nodes, doc_level = docs.tree.children(doc_level, nodes), doc_level - 1
            for child in items.tree.children(item_level, np.array([node])):
                visit(item_level - 1, int(child), doc_level, nodes)
            return
        while doc_level > 1:
            nodes = docs.tree.children(doc_level, nodes)
            doc_level -= 1
            bounds = docs.tree.products(doc_level, nodes, dense)
            keep = bounds >= items.bars[node]
            nodes, bounds = nodes[keep], bounds[keep]
        # The most promising leaves first; their scores raise the bar for the others.
        order = np.argsort(-bounds, kind="stable")
        nodes, bounds, at, step = nodes[order], bounds[order], 0, 4
        while at < len(nodes) and bounds[at] >= items.bars[node]:
            some = nodes[at:at + step]
            some = some[bounds[at:at + step] >= items.bars[node]]
            leaves = docs.tree.children(1, some) if doc_level else some
            scores = docs.tree.products(0, leaves, dense)
            scored += len(leaves)
            enter = scores >= items.bars[node]
            rows = docs.tree.order[leaves[enter]]
            items.offer(node, scores[enter], docs.nulls[rows], docs.ids[rows])
            at, step = at + step, step * 2

    root = len(items.tree.levels) - 1
    visit(root, 0, top, np.arange(docs.tree.width(top)))
    return scored


def _searched(docs: int, words: int, k: int):
    def run(batches):
        held: OrderedDict[int, Items] = OrderedDict()
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                block = row["i_block"]
                if block not in held:
                    if len(held) >= HELD_BLOCKS:
                        yield held.popitem(last=False)[1].hits()
                    held[block] = Items({c: row[f"i_{c}"] for c in (
                        "n", "items", "ids", "null_ids", "terms", "weights", "starts", "places",
                        "counts")}, k)
                search(held[block], Docs(row, held[block], docs, words))
        for items in held.values():
            yield items.hits()
    return run


def ranked(docs: DataFrame, items: DataFrame, *, k: int = TOP, id_col: str = "doc_id",
           text_col: str = "text", item_id_col: str = "item_id",
           item_text_col: str = "text") -> DataFrame:
    """Each item's k highest-scoring documents: `item_id`, `rank`, `doc_id`, `score`.

    Terms, weights, lengths and scores are whole numbers as described in the README; only documents
    with a score above 0 are ranked, equal scores by ascending doc_id. With fewer such documents an
    item has fewer rows.

    A null or empty text has no terms; such a document counts nowhere, such an item has no rows.
    Every row is a document or an item of its own: rows that repeat an id are ranked each, and a
    repeated item has its rows again. Rows without an id are ranked after all others of their score,
    with a null id. Extra columns are ignored. Empty tables give an empty result.

    Item blocks meet document blocks; Spark broadcasts the item blocks only if their measured size
    allows it. A task hands on k rows an item, whatever number of blocks it has searched.
    """
    spark = docs.sparkSession
    work = Work(spark, "lexical")
    terms = items.select(F.monotonically_increasing_id().alias("item"),
                         F.col(item_id_col).cast("bigint").alias("item_id"),
                         F.col(item_text_col).cast("binary").alias("text")) \
        .mapInArrow(_item_terms, ITEM_TERMS)
    terms = work.stored(terms, "items")
    wanted = spark.sparkContext.broadcast(bitmap.gathered(
        terms.select((F.crc32("term") % FILTER_BITS).alias("position")), FILTER_BITS))
    blocks = work.stored(
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                    F.col(text_col).cast("binary").alias("text"))
        .mapInArrow(_doc_blocks(wanted), DOC_BLOCKS), "docs")
    totals = blocks.agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    n_docs, n_words = totals["docs"] or 0, totals["words"] or 0

    found = blocks.select(F.explode(F.arrays_zip("terms", "term_docs")).alias("t")) \
        .groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.term_docs").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(float(n_docs)) + 2) / (2 * F.col("df") + 1)))
    weighted = terms.join(found.withColumn("weight", weight.cast("bigint")), "term")
    block = F.expr(f"CAST(pmod(xxhash64(item), {max(1, -(-items.count() // BLOCK_ITEMS))}) AS INT)")
    asked = work.stored(
        weighted.select(block.alias("block"), "item", "item_id", "term", "count", "weight")
        .groupBy("block").applyInArrow(_item_blocks, ITEM_BLOCKS), "asked")
    asked = asked.select(*[F.col(c).alias(f"i_{c}") for c in asked.columns])
    tasks = max(1, min(blocks.count(), 4 * partitions(spark)))
    hits = blocks.where("n > 0").drop("term_docs").repartition(tasks).crossJoin(asked) \
        .mapInArrow(_searched(n_docs, n_words, k), HITS)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
