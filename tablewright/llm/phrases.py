"""Phrase collocations by prefix-free parsing.

Documents are parsed into chunks that begin where the content says so: at a window of three words
whose hash is a multiple of CHUNK. A chunk runs on over the window that begins the next one, so every
phrase of up to four words lies inside the chunk in which it begins, and is counted there alone. The
distinct chunks with their numbers of occurrences are the dictionary; all counting is done inside it,
each chunk once, weighted by its number.

Phrases are counted level by level. A phrase can reach the least count only if both phrases that are
one word shorter do, so each level counts hashes of the phrases whose parts passed and keeps the
frequent ones in a bit table of fixed size. Collisions only let more phrases through: what is
reported is counted by the words themselves.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm import bitmap
from tablewright.llm.base import Work
from tablewright.llm.words import hash_bytes, mix

WORDS = 4                      # longest phrase
LEAST = 30                     # least count of a phrase
TOP = 2000
INSIDE_PERCENT = 80            # a longer phrase hides its parts from this share of their count on
FACTOR = 2_000_000             # of the score
CHUNK = 16                     # words that a chunk has on average
WINDOW = WORDS - 1             # words that overlap
TABLE_BITS = 1 << 27           # bit table of each level
TEXT_BYTES = 4 << 20           # text counted at a time
UNKNOWN = "und"

# Piece ends become the token ".", which no word can be: it is a separator itself.
END = b"."
SEPARATORS = {ord(c) for c in ".,;:!?\n\v\f\r"}
TOKEN_BYTES = bytes(10 if c in SEPARATORS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c
                    for c in range(256))

CHUNKS = "lang string, chunk binary, words bigint, copies bigint"
HASHES = "hash bigint, copies bigint"
PHRASES = "lang string, phrase binary, words int, copies bigint"
STEP = np.uint64(0x9E3779B97F4A7C15)


def normal(raw: bytes) -> bytes:
    """The words of a UTF-8 text and END between pieces, each after a blank."""
    return b" ".join([b"", *raw.translate(TOKEN_BYTES).replace(b"\n", b" . ").split()])


class Tokens:
    """Tokens of bytes in which each follows a blank: where they lie, their hashes, which are words."""

    def __init__(self, raw: bytes):
        self.raw, data = raw, np.frombuffer(raw, np.uint8)
        self.first = np.flatnonzero(data == 32) + 1
        self.end = np.append(self.first[1:] - 1, len(raw))
        self.hash = hash_bytes(raw)
        self.word = (self.end - self.first != 1) | (data[self.first] != END[0])

    def text(self, at, upto) -> list[bytes]:
        """The texts from each token `at` to the one before `upto`."""
        raw = self.raw
        return [raw[a:b] for a, b in zip(self.first[at].tolist(), self.end[upto - 1].tolist(),
                                         strict=True)]

    def numbers(self) -> np.ndarray:
        """Equal numbers for equal tokens, from 0; different ones for others."""
        _, first, number = np.unique(self.hash, return_index=True, return_inverse=True)
        data, like = np.frombuffer(self.raw, np.uint8), first[number]
        sizes = self.end - self.first
        same = (sizes == sizes[like]).all()
        if same:
            gap = np.repeat(self.first[like] - self.first, sizes)
            own = np.flatnonzero(data != 32)
            same = (data[own] == data[own + gap]).all()
        if not same:        # two tokens share a hash: number them by their bytes
            place = defaultdict(count().__next__)
            number = np.fromiter(map(place.__getitem__, self.raw[1:].split(b" ")), np.int64,
                                 len(number))
        return number


def parsed(texts: list[tuple[str, bytes]]) -> Counter:
    """How often each (lang, chunk, words of its own) occurs in some texts."""
    split = [(lang, some) for lang, raw in texts if (some := normal(raw))]
    found: Counter = Counter()
    if not split:
        return found
    tail = b" " + b" ".join([END] * WINDOW)
    tokens = Tokens(b"".join([some + tail for _, some in split]))
    sizes = np.array([some.count(b" ") + WINDOW for _, some in split])
    firsts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    rolled = np.zeros(len(tokens.hash) - WINDOW + 1, np.uint64)
    for k in range(WINDOW):
        rolled = mix(rolled * STEP + tokens.hash[k:k + len(rolled)])
    begins = np.append(rolled % np.uint64(CHUNK) == 0, np.zeros(WINDOW - 1, bool))
    for k in range(1, WINDOW + 1):
        begins[firsts + sizes - k] = False       # what follows the text
    begins[firsts] = True
    at = np.flatnonzero(begins)
    text = np.searchsorted(firsts, at, "right") - 1
    upto = np.minimum(np.append(at[1:], len(begins)), (firsts + sizes - WINDOW)[text])
    inside = np.concatenate(([0], np.cumsum(tokens.word)))
    words = inside[upto] - inside[at]
    at, upto, text, words = (a[words > 0] for a in (at, upto, text, words))
    langs = [lang for lang, _ in split]
    found.update(zip([langs[t] for t in text.tolist()], tokens.text(at, upto + WINDOW),
                     words.tolist(), strict=True))
    return found


def _parsed(batches):
    """The chunks of a partition, those of equal content in one batch of texts added up."""
    def flush():
        found = parsed(held)
        keys = list(zip(*found, strict=True)) or [()] * 3
        return pa.RecordBatch.from_arrays([
            pa.array(keys[0], pa.string()), pa.array(keys[1], pa.binary()),
            pa.array(keys[2], pa.int64()), pa.array(list(found.values()), pa.int64())],
            names=["lang", "chunk", "words", "copies"])

    held, size = [], 0
    for batch in batches:
        for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            held.append((lang, raw.as_py()))
            size += len(held[-1][1])
            if size >= TEXT_BYTES:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the first of each distinct key, and the sum of the key's weights."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    new = np.concatenate(([True], keys[order][1:] != keys[order][:-1]))
    return order[new], np.add.reduceat(weights[order], np.flatnonzero(new))


class Chunks:
    """Distinct chunks as arrays of tokens, with the phrases that begin at each word of their own."""

    def __init__(self, langs: list[str], chunks: list[bytes], copies: list[int]):
        self.tokens = Tokens(b" " + b" ".join(chunks))
        sizes = np.array([c.count(b" ") + 1 for c in chunks], np.int64)
        self.langs, lang = np.unique(np.array(langs, object), return_inverse=True)
        self.lang = np.repeat(lang, sizes)
        self.copies = np.repeat(np.array(copies, np.int64), sizes)
        seeds = np.array([xxhash.xxh64_intdigest(x) for x in self.langs], np.uint64)
        # The last tokens of a chunk belong to the next one.
        self.own = np.arange(sizes.sum()) < np.repeat(np.cumsum(sizes) - WINDOW, sizes)
        self.rolled = [mix(seeds[self.lang] + self.tokens.hash)]

    def hashes(self, n: int) -> np.ndarray:
        """Hash of the n words from each token on, in the token's language."""
        while len(self.rolled) < n:
            k = len(self.rolled)
            longer = self.rolled[-1].copy()
            longer[:-k] = mix(longer[:-k] * STEP + self.tokens.hash[k:])
            self.rolled.append(longer)
        return self.rolled[n - 1]

    def starts(self, n: int, tables: list[np.ndarray]) -> np.ndarray:
        """Tokens at which a phrase of n words begins whose shorter phrases, and which itself where
        its level has a table, may be frequent. tables[i] is that of phrases of i + 2 words."""
        at = np.flatnonzero(self.own & self.tokens.word)
        for k in range(1, n):
            at = at[self.tokens.word[at + k]]
        for words, table in enumerate(tables[:n - 1], 2):
            hashes = self.hashes(words) % np.uint64(TABLE_BITS)
            for k in range(n - words + 1):
                at = at[bitmap.has(table, hashes[at + k])]
        return at

    def frequent_hashes(self, n: int, tables: list[np.ndarray]) -> pa.RecordBatch:
        at = self.starts(n, tables)
        hashes = self.hashes(n)[at].view(np.int64)
        first, sums = summed(hashes, self.copies[at])
        return pa.RecordBatch.from_arrays([pa.array(hashes[first]), pa.array(sums)],
                                          names=["hash", "copies"])

    def phrases(self, tables: list[np.ndarray]):
        """Distinct phrases of each number of words, with their numbers of occurrences."""
        number = self.tokens.numbers()
        many = int(number.max()) + 1
        for n in range(1, WORDS + 1):
            at = self.starts(n, tables)
            keys = self.lang[at]
            for k in range(n):
                if k > 1:       # ranks of the pairs so far, so that products stay small
                    keys = np.unique(keys, return_inverse=True)[1]
                keys = keys * many + number[at + k]
            first, sums = summed(keys, self.copies[at])
            first = at[first]
            yield pa.RecordBatch.from_arrays([
                pa.array(self.langs[self.lang[first]], pa.string()),
                pa.array(self.tokens.text(first, first + n), pa.binary()),
                pa.array(np.full(len(first), n), pa.int32()), pa.array(sums)],
                names=["lang", "phrase", "words", "copies"])


def _counted(answer, tables):
    """Hand chunks of some megabytes of text at a time to `answer`, with the bit tables."""
    def run(batches):
        have = [t.value for t in tables]
        held, size = ([], [], []), 0
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns, strict=True):
                for some, value in zip(held, row, strict=True):
                    some.append(value)
                size += len(row[1])
                if size >= TEXT_BYTES:
                    yield from answer(Chunks(*held), have)
                    held, size = ([], [], []), 0
        if held[0]:
            yield from answer(Chunks(*held), have)
    return run


def counts(docs: DataFrame, work: Work, *, least: int = LEAST, text_col: str = "text",
           lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to WORDS words with at least `least` occurrences (`lang`, `phrase`, `words`,
    `f`), and the number of words per language (`lang`, `n`). Both are stored."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                        F.col(text_col).cast("binary").alias("text")).where("text IS NOT NULL")
    chunks = work.stored(
        texts.mapInArrow(_parsed, CHUNKS).groupBy("lang", "chunk")
        .agg(F.first("words").alias("words"), F.sum("copies").alias("copies")), "chunks")
    sizes = work.stored(chunks.groupBy("lang").agg(
        F.sum(F.col("words") * F.col("copies")).alias("n")), "sizes")
    chunks = chunks.select("lang", "chunk", "copies")

    tables: list = []
    for n in range(2, WORDS):
        found = chunks.mapInArrow(
            _counted(lambda c, t, n=n: [c.frequent_hashes(n, t)], list(tables)), HASHES)
        frequent = found.groupBy("hash").agg(F.sum("copies").alias("f")).where(F.col("f") >= least)
        table = bitmap.gathered(
            frequent.select(F.col("hash").bitwiseAND(TABLE_BITS - 1).alias("position")), TABLE_BITS)
        tables.append(spark.sparkContext.broadcast(table))

    found = chunks.mapInArrow(
        _counted(lambda c, t: c.phrases(t), tables), PHRASES)
    return work.stored(
        found.groupBy("lang", "phrase", "words").agg(F.sum("copies").alias("f"))
        .where(F.col("f") >= least)
        .withColumn("phrase", F.col("phrase").cast("string")), "frequent"), sizes


def collocations(docs: DataFrame, *, least: int = LEAST, top: int = TOP, text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """Each language's `top` phrases of two to four words: `lang`, `rank`, `phrase`, `a`, `l`, `r`,
    `n`, `score`, as described in the README.

    a counts the phrase, l and r the two parts of its lowest-scoring cut, n the language's words.
    Phrases that a longer one accounts for (INSIDE_PERCENT of their count) are left out. Highest
    score first, then highest a, then the phrase in byte order.

    A null language counts as `und`. Null, empty and blank texts hold no words. Every row counts:
    repeated rows and rows without an id too. Extra columns are ignored. An empty table, or one
    without a phrase that occurs `least` times, gives an empty result.
    """
    work = Work(docs.sparkSession, "phrases")
    frequent, sizes = counts(docs, work, least=least, text_col=text_col, lang_col=lang_col)
    parts = F.split("phrase", " ", -1)

    def joined(first, length) -> F.Column:
        return F.array_join(F.slice(parts, first, length), " ")

    cuts = (
        frequent.where("words > 1").select(
            "lang", "phrase", "words", F.col("f").alias("a"),
            F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
        .withColumn("left", joined(F.lit(1), F.col("k")))
        .withColumn("right", joined(F.col("k") + 1, F.col("words") - F.col("k"))))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(frequent.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)),
                         ["lang", side])
    score = F.expr(f"CAST(CAST(a AS DECIMAL(19, 0)) * {FACTOR} div "
                   "(CAST(l AS DECIMAL(19, 0)) + CAST(r AS DECIMAL(19, 0))) AS BIGINT)")
    scored = (cuts.withColumn("score", score).groupBy("lang", "phrase", "words", "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))

    # Every part of a phrase that is itself a candidate, with the phrase's count.
    inside = (
        frequent.where("words > 2")
        .select("lang", "phrase", "f", "words",
                F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("length"))
        .select("lang", "phrase", "f", "length",
                F.explode(F.sequence(F.lit(1), F.col("words") - F.col("length") + 1)).alias("first"))
        .select("lang", joined(F.col("first"), F.col("length")).alias("phrase"), "f")
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    hidden = F.expr(f"CAST(longer AS DECIMAL(19, 0)) * 100 >= CAST(a AS DECIMAL(19, 0)) * "
                    f"{INSIDE_PERCENT}")
    left = scored.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | ~hidden)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order).cast("bigint")) \
        .where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
