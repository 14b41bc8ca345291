"""Mixing sources to target weights, in DataFrame functions only.

Each document gets a hash-random key. Keys are cut into CELLS equal ranges per source, each range
is sorted by key, and the words before a document are those of the ranges before plus those
before it in its own: a prefix sum that no single task computes. A source is read through in that
order, over and over, until its exact budget of words is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.base import Work, word_count

WEIGHTS = (3, 1, 2)            # by rank of the source, repeating
SHARE = (3, 2)                 # the mix has 3/2 of all words
MOST = 2                       # times a source's words that it may be read
CELL_DIGITS = 3                # hex digits of the key that name its range: 4,096 ranges


def _targets(sources: DataFrame) -> DataFrame:
    """Add `target`, `budget` to rows (sk, source, source_size): one row per source.

    Sources with little for their weight stop at MOST times their size; what they leave is
    shared by weight among the rest. In order of size per weight this has a closed form: a source
    stops if its cap does not exceed its share of what the sources before it, all stopped, leave.
    """
    numerator, denominator = SHARE
    cycle = F.array(*[F.lit(w) for w in WEIGHTS])
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    common = 1
    for w in WEIGHTS:
        common *= w
    wide = "decimal(38,0)"
    rows = (sources.withColumn("weight", F.element_at(cycle, (rank - 1) % len(WEIGHTS) + 1))
            .withColumn("per_weight", F.col("source_size").cast(wide)
                        * F.expr(f"{common} div weight"))
            .withColumn("cap", F.col("source_size") * MOST))
    order = Window.orderBy("per_weight", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy()
    rows = (rows.withColumn("caps_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
            .withColumn("weight_left", F.sum("weight").over(everywhere)
                        - F.coalesce(F.sum("weight").over(before), F.lit(0)))
            .withColumn("total", F.sum("source_size").over(everywhere))
            .withColumn("stops", F.col("cap").cast(wide) * denominator * F.col("weight_left")
                        <= F.col("weight") * (F.col("total").cast(wide) * numerator
                                              - F.col("caps_before") * denominator)))
    stopped = F.when(F.col("stops"), F.col("cap")).otherwise(0)
    going = F.when(F.col("stops"), 0).otherwise(F.col("weight"))
    rows = (rows.withColumn("left", F.col("total") * numerator
                            - F.sum(stopped).over(everywhere) * denominator)
            .withColumn("sharing", F.sum(going).over(everywhere)))
    share = (F.col("weight").cast(wide) * F.col("left")).cast("double") \
        / (F.col("sharing") * denominator).cast("double")
    target = F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(share)
    return rows.select("__sk", "source_size", target.alias("target"),
                       F.floor(target).cast("bigint").alias("__budget"))


def mixed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """All rows and columns, with `size`, `source_size`, `target`, `taken`.

    `size` is the text's number of words, `source_size` that of its source, `target` the words
    its source shall give, `taken` the words of this document in the mix, repeats counted: 0, its
    size once or more, or a part of it where its source's budget ends. Taken words of a source
    add up to the whole part of its target.

    A null source is one source of its own, ranked last. Null, empty and blank texts have size 0
    and give nothing. Rows that repeat an id follow each other. A null id has the key of an empty
    string. Columns of the input that are named like an added one are replaced. An empty table
    gives an empty result.

    The sources themselves (one row each) pass through one task; documents never do: a source
    that holds a third of all rows is spread over all of its ranges.
    """
    work = Work(docs.sparkSession, "mixing")
    added = ("size", "source_size", "target", "taken")
    rows = docs.select(*docs.columns).withColumn("size", word_count(text_col)) \
        .drop(*[c for c in added if c != "size"])
    rows = (rows
            .withColumn("__sk", F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n")))
            .withColumn("__key", F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))))\
        .withColumn("__cell", F.substring("__key", 1, CELL_DIGITS))

    cells = work.stored(
        rows.groupBy("__sk", "__cell").agg(F.sum("size").alias("words"),
                                       F.first(source_col).alias("source")), "cells")
    targets = work.stored(
        _targets(cells.groupBy("__sk").agg(F.sum("words").alias("source_size"),
                                         F.first("source").alias("source"))), "targets")
    ahead = Window.partitionBy("__sk").orderBy("__cell") \
        .rowsBetween(Window.unboundedPreceding, -1)
    starts = work.stored(
        cells.withColumn("__start", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
        .join(targets, "__sk").select("__sk", "__cell", "__start", "source_size", "target", "__budget"),
        "starts")

    inside = Window.partitionBy("__sk", "__cell").orderBy("__key", id_col, "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    laps = F.expr("CASE WHEN source_size > 0 THEN __budget div source_size ELSE 0 END")
    return (
        rows.withColumn("__ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, ["__sk", "__cell"])
        .withColumn("__rest", F.col("__budget") - laps * F.col("source_size"))
        .withColumn("taken", laps * F.col("size") + F.greatest(F.lit(0), F.least(
            F.col("size"), F.col("__rest") - F.col("__start") - F.col("__ahead"))))
        .select(*[c for c in docs.columns if c not in added],
                "size", "source_size", "target", F.col("taken").cast("bigint").alias("taken")))


def repeated(mix: DataFrame, columns: list[str], *, text_col: str = "text") -> DataFrame:
    """The documents of a mix: each as often as it was taken whole, and the head of the one in
    which its source's budget ends, cut after its last word taken. Untaken ones are left out."""
    whole = F.expr("CASE WHEN size > 0 THEN taken div size ELSE 0 END").cast("int")
    part = (F.col("taken") - whole * F.col("size")).cast("int")
    # The head keeps the words; the gaps between them become single blanks.
    words = F.filter(F.split(F.col(text_col), "[\\x20\\x09-\\x0D]+"), lambda x: x != "")
    head = F.array_join(F.slice(words, 1, part), " ")
    copies = F.concat(F.array_repeat(F.lit(False), whole),
                      F.array_repeat(F.lit(True), F.when(part > 0, 1).otherwise(0)))
    rows = mix.where("taken > 0").withColumn("__cut", F.explode(copies))
    text = F.when(F.col("__cut"), head).otherwise(F.col(text_col))
    return rows.withColumn(text_col, text).select(*columns)
