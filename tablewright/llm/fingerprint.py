"""Document fingerprints from closed syncmers, in DataFrame functions only.

The text is read as words. Each run of SPAN words has a hash (an s-mer); a k-mer of K words holds
WINDOW of them. A k-mer is chosen if the least of its s-mer hashes is its first or its last one.
Whether it is chosen depends on its own K words alone, not on the text around it, so two texts
that share a passage choose the same anchors in it, wherever it stands. Of any WINDOW k-mers in a
row at least one is chosen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.base import GAPS, Work

SPAN = 3                       # words of an s-mer
WINDOW = 7                     # s-mers of a k-mer
K = SPAN + WINDOW - 1          # words of a k-mer: 9, covered by the s-mers at 0, 3 and 6

# Scripts without blanks: each of these characters ends a word of its own.
UNSPACED = "(?<=[\\u2E80-\\u9FFF\\uAC00-\\uD7AF])"

# The neighbour search packs ids into buckets of 2^6, those into 2^20, those into 2^20.
ID_BITS = 6
LEVEL_BITS = (20, 20)


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add `out`: the anchors of the text column in order of occurrence, as array<bigint>.

    A text without any chosen k-mer (one shorter than K words, say) has the hash of the whole
    text as its only anchor, so that no fingerprint is empty and equal texts have equal ones.
    """
    w, h = f"{out}__words", f"{out}__spans"
    chosen = F.transform(
        F.slice(F.col(h), 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.when(
            F.array_min(F.slice(F.col(h), i + 1, WINDOW))
            .isin(x, F.get(F.col(h), i + (WINDOW - 1))),
            F.xxhash64(x, F.get(F.col(h), i + SPAN), F.get(F.col(h), i + 2 * SPAN))))
    return (
        df.withColumn(w, F.transform(F.split(text, f"{GAPS}|{UNSPACED}"),
                                     lambda x: F.xxhash64(x)))
        .withColumn(h, F.transform(
            F.slice(F.col(w), 1, F.greatest(F.size(w) - (SPAN - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(F.col(w), i + 1), F.get(F.col(w), i + 2))))
        .withColumn(out, F.filter(chosen, lambda x: x.isNotNull()))
        .withColumn(out, F.when(F.size(out) > 0, F.col(out))
                    .otherwise(F.array(F.xxhash64(F.col(text)))))
        .drop(w, h))


def anchor_positions(docs: DataFrame, *, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row per anchor: `doc_id`, `ordinal` (its place among the text's anchors), `anchor`.

    A join on `anchor` gives the passages two documents share; runs of equal difference of
    ordinals give their extent. A null text counts as empty.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return with_anchors(rows, "text", "anchors").select(
        "doc_id", F.posexplode("anchors").alias("ordinal", "anchor"))


def as_text(anchors: str) -> F.Column:
    """The fingerprint as a string: hexadecimal anchors, blank between them."""
    return F.array_join(F.transform(F.col(anchors), lambda x: F.lower(F.hex(x))), " ")


def likeness(a: str, b: str) -> F.Column:
    """Jaccard similarity of two sets of anchors, 0 to 1."""
    shared = F.size(F.array_intersect(a, b)).cast("double")
    return shared / F.size(F.array_union(a, b))


def _successors(keys: DataFrame, bits: tuple[int, ...]) -> DataFrame:
    """The next larger key of every key of a distinct bigint column `k`, as `follower`.

    Keys are numbered within blocks of 2^bits; a block's last key is followed by the first of
    the next block that has any, found the same way one level up. What is left above the last
    level fits one task: at most 2^(64 - all bits) blocks, whatever the number of keys.
    """
    if not bits:
        return keys.select("k", F.lead("k").over(Window.orderBy("k")).alias("follower"))
    blocked = keys.withColumn("block", F.shiftright("k", bits[0]))
    firsts = blocked.groupBy("block").agg(F.min("k").alias("first"))
    after = _successors(firsts.select(F.col("block").alias("k")), bits[1:])
    after = after.join(firsts.withColumnRenamed("block", "follower"), "follower") \
        .select(F.col("k").alias("block"), "first")
    own = blocked.withColumn(
        "inside", F.lead("k").over(Window.partitionBy("block").orderBy("k")))
    return own.join(after, "block", "left").select(
        "k", F.coalesce("inside", "first").alias("follower"))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form.

    The edited text has its last quarter (code points, rounded down) replaced by as many from the
    head of the next document's text, or all of it if shorter. The next document is the next row
    in ascending order of id (nulls first), then text; after the last row comes the first. A null
    text counts as empty. A single row is its own next. An empty table gives an empty result.

    Returns `doc_id`, `n_chars`, `edited_sha256`, `fingerprint`, `edited_fingerprint`,
    `near_edited`, `near_next`. Extra columns are ignored.

    Texts move once, to buckets of 64 consecutive ids. The first row of each bucket is known
    beforehand, so the last row of the one before finds it by a join on the bucket, for which
    nothing moves again.
    """
    work = Work(docs.sparkSession, "fingerprint")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lowest_bucket = -(1 << (63 - ID_BITS)) - 1                     # below every id's
    rows = rows.withColumn("bucket", F.coalesce(F.shiftright("doc_id", ID_BITS),
                                                F.lit(lowest_bucket)))

    heads = work.stored(
        rows.groupBy("bucket").agg(F.min(F.struct("doc_id", "text")).alias("head"))
        .select("bucket", F.col("head.text").alias("text")), "heads")
    follows = work.stored(_successors(heads.select(F.col("bucket").alias("k")), LEVEL_BITS),
                          "follows")
    lowest = heads.agg(F.min("bucket")).first()[0]
    entering = with_anchors(
        follows.select(F.col("k").alias("before"),
                       F.coalesce("follower", F.lit(lowest)).alias("bucket"))
        .join(heads, "bucket").select(F.col("before").alias("bucket"),
                                      F.col("text").alias("head_text")),
        "head_text", "head_anchors")

    order = Window.partitionBy("bucket").orderBy("doc_id", "text")
    here = (with_anchors(rows.repartition("bucket"), "text", "anchors")
            .withColumn("following", F.lead(F.struct("text", "anchors")).over(order))
            .join(work.stored(entering, "entering"), "bucket", "left"))
    quarter = F.expr("length(text) div 4").cast("int")
    edited = (
        here.withColumn("next_text", F.coalesce("following.text", "head_text"))
        .withColumn("next_anchors", F.coalesce("following.anchors", "head_anchors"))
        .withColumn("n_chars", F.length("text").cast("bigint"))
        .withColumn("edited", F.concat(
            F.substring(F.col("text"), F.lit(1), F.length("text") - quarter),
            F.substring(F.col("next_text"), F.lit(1), quarter)))
        .select("doc_id", "n_chars", "edited", "anchors", "next_anchors"))
    return with_anchors(edited, "edited", "edited_anchors").select(
        "doc_id", "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        as_text("anchors").alias("fingerprint"),
        as_text("edited_anchors").alias("edited_fingerprint"),
        likeness("anchors", "edited_anchors").alias("near_edited"),
        likeness("anchors", "next_anchors").alias("near_next"))
