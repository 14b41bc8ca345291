"""Packing into length buckets that are optimal for the whole corpus.

Documents are cut into pieces of at most `max_tokens` words. The number of pieces of each length
is a histogram of at most that many rows; dynamic programming over it finds the bucket lengths
with the least padding. Inside a bucket every piece is padded to the same length, so a batch holds
a fixed number of pieces, and a piece's batch follows from its number in the bucket.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.base import Work, word_count

MAX_TOKENS = 2048
BUCKETS = 16
BATCH_TOKENS = 16384
SHARD_ROWS = 10_000            # pieces that one task numbers


def bucket_lengths(histogram: dict[int, int], buckets: int) -> list[int]:
    """The at most `buckets` lengths that minimise the padding of all pieces.

    Every piece is padded to the least bucket length not below its own. Of equal solutions, the
    one found from the smallest preceding boundary is taken. No pieces: no buckets.
    """
    lengths = np.array(sorted(histogram), np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[int(n)] for n in lengths], np.float64)
    pieces = np.concatenate(([0.0], np.cumsum(counts)))
    tokens = np.concatenate(([0.0], np.cumsum(counts * lengths)))
    m = len(lengths)
    # cost[j]: padding of the first j lengths; one bucket, then one more each round.
    cost = lengths * pieces[1:] - tokens[1:]
    cost = np.concatenate(([0.0], cost))
    choice = []
    for _ in range(min(buckets, m) - 1):
        better, origin = cost.copy(), np.zeros(m + 1, np.int64)
        for j in range(1, m + 1):
            i = np.arange(j)
            ways = cost[:j] + lengths[j - 1] * (pieces[j] - pieces[i]) - (tokens[j] - tokens[i])
            origin[j] = int(np.argmin(ways))
            better[j] = ways[origin[j]]
        choice.append(origin)
        cost = better
    bounds, j = [], m
    for origin in reversed(choice):
        bounds.append(int(lengths[j - 1]))
        j = int(origin[j])
        if j == 0:
            break
    if j > 0:
        bounds.append(int(lengths[j - 1]))
    return sorted(bounds)


def packed(docs: DataFrame, *, max_tokens: int = MAX_TOKENS, buckets: int = BUCKETS,
           batch_tokens: int = BATCH_TOKENS, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per piece: `doc_id`, `piece`, `first_token`, `n_tokens`, `bucket_length`,
    `batch`, `slot`.

    Tokens are words; piece 0 starts at token 0. Together the pieces of a document are its whole
    text. `batch` counts from 0 within its bucket; a batch holds batch_tokens // bucket_length
    pieces (one at least), and only the last of a bucket may hold fewer. Pieces are dealt in a
    order random by a hash of id and text, so that batches mix documents, rows without an id too.

    A null, empty or blank text has one piece of no tokens, in no bucket: bucket_length, batch
    and slot are null. Repeated rows are packed each. A null id is carried along. Extra columns
    are ignored. An empty table gives an empty result.
    """
    work = Work(docs.sparkSession, "packing")
    sizes = work.stored(docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                                    word_count(text_col).alias("words"),
                                    F.xxhash64(id_col, text_col).alias("seed")), "sizes")
    last = F.greatest(F.expr(f"(words - 1) div {max_tokens}"), F.lit(0)).cast("int")
    pieces = (
        sizes.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("first_token", (F.col("piece") * F.lit(max_tokens).cast("bigint")))
        .withColumn("n_tokens", F.least(F.col("words") - F.col("first_token"),
                                        F.lit(max_tokens).cast("bigint")))
        .drop("words"))

    counted = pieces.where("n_tokens > 0").groupBy("n_tokens").count().collect()
    histogram = {row["n_tokens"]: row["count"] for row in counted}    # max_tokens rows at most
    lengths = bucket_lengths(histogram, buckets)
    totals = dict.fromkeys(lengths, 0)
    for n, count in histogram.items():
        totals[next(x for x in lengths if x >= n)] += count

    bucket = shards = per_batch = F.lit(None).cast("bigint")
    for n in reversed(lengths):
        fits = F.col("n_tokens") <= n
        bucket = F.when(fits, F.lit(n)).otherwise(bucket)
        shards = F.when(fits, F.lit(-(-totals[n] // SHARD_ROWS))).otherwise(shards)
        per_batch = F.when(fits, F.lit(max(1, batch_tokens // n))).otherwise(per_batch)
    pieces = (pieces.withColumn("bucket_length", F.when(F.col("n_tokens") > 0, bucket))
              .withColumn("per_batch", per_batch)
              .withColumn("order", F.xxhash64("seed", "piece"))
              .withColumn("shard", F.pmod(F.col("order"), shards)))
    some = pieces.where("n_tokens > 0")

    ahead = Window.partitionBy("bucket_length").orderBy("shard") \
        .rowsBetween(Window.unboundedPreceding, -1)
    starts = work.stored(
        some.groupBy("bucket_length", "shard").count()
        .withColumn("start", F.coalesce(F.sum("count").over(ahead), F.lit(0)))
        .drop("count"), "starts")
    inside = Window.partitionBy("bucket_length", "shard").orderBy("order", "doc_id", "piece", "n_tokens")
    number = F.col("start") + F.row_number().over(inside) - 1
    dealt = (
        some.join(starts, ["bucket_length", "shard"])
        .withColumn("number", number)
        .withColumn("batch", F.expr("number div per_batch"))
        .withColumn("slot", F.expr("number % per_batch").cast("int")))
    columns = ["doc_id", "piece", "first_token", "n_tokens", "bucket_length", "batch", "slot"]
    none = pieces.where("n_tokens = 0").withColumn("batch", F.lit(None).cast("bigint")) \
        .withColumn("slot", F.lit(None).cast("int"))
    return dealt.select(*columns).unionByName(none.select(*columns)).select(
        "doc_id", "piece", "first_token", "n_tokens",
        F.col("bucket_length").cast("bigint").alias("bucket_length"), "batch", "slot")
