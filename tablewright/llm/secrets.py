"""Secret scans: three base patterns, and credential values that are costly to guess.

A value in credential context need not be long to be a secret. Its guess cost is the logarithm of
the guesses an attacker needs who knows words, dates, repeats and keyboard walks: the least sum
over all ways to cut the value into such spans and single brute-forced characters, found by
dynamic programming from left to right. The words are a short fixed list and the words that most
documents of the corpus hold outside such values, so that prose (`password: required`) is cheap.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.base import ready

KINDS = ("assign", "access", "hex", "guess")

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
CREDENTIAL = re.compile(
    r"(?:pass(?:word|wd|code|phrase)?|pwd|secret|token|api_?key|credentials?)"
    r"[\"']?\x20*[:=]\x20*[\"']?([!#-&(-+\--~]{6,})", re.IGNORECASE | re.ASCII)

# A text holds a context only if its lower-cased form holds one of these.
ASSIGN_HINTS = ("passw", "secret", "token", "api")
CREDENTIAL_HINTS = ("pass", "pwd", "secret", "token", "api", "credential")

LEAST_ASSIGN, LEAST_ACCESS = 12, 18
LEAST_COST = 8.0               # powers of ten: 100 million guesses

# Frequent words of passwords, most frequent first.
COMMON = (
    "password 123456 qwerty admin welcome login letmein monkey dragon master hello secret test "
    "user root guest default changeme sample example shadow sunshine princess football baseball "
    "summer winter spring autumn love access server system public private token demo temp pass "
    "word house green blue red black white night day star moon sun the and for you all this that "
    "with from have not are was will one two three four five required optional invalid expired "
    "incorrect missing protected forgotten changed string none null true false value field hidden "
    "redacted undefined unknown encrypted placeholder authentication authorization bearer "
    "management manager policy length strength protection generator recovery").split()
RANKS = {word: rank for rank, word in enumerate(COMMON, 1)}
LONGEST = max(map(len, COMMON))

# Words of the corpus: so many, in so many documents at least.
CORPUS_WORDS, LEAST_DOCUMENTS = 20_000, 3
LONGEST_WORD = 24
WORD = re.compile(r"(?<![a-z])[a-z]{4,%d}(?![a-z])" % LONGEST_WORD)
COUNTED_AT_A_TIME = 100_000    # distinct words a task holds
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz",
        "0123456789")
STEPS = {a + b for row in ROWS for a, b in zip(row, row[1:])} \
    | {b + a for row in ROWS for a, b in zip(row, row[1:])}
DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])"
                  r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d"
                  r"|(?:19|20)\d\d")

SPAN_COST = 0.5                # for choosing to try a pattern at all
DATE_COST = math.log10(366 * 120)
YEAR_COST = math.log10(120)


def _character_cost(c: str) -> float:
    """Brute force: the size of the class a character belongs to."""
    if c.isdigit():
        return 1.0
    return math.log10(26) if c.isalpha() else math.log10(33)


def _ends(value: str, follows) -> list[int]:
    """For each start, the end of the longest run whose neighbouring characters all follow."""
    ends = [0] * len(value)
    for i in range(len(value) - 1, -1, -1):
        ends[i] = ends[i + 1] if i + 1 < len(value) and follows(value[i], value[i + 1]) else i + 1
    return ends


def spans_of(value: str, words: Mapping[str, int] = {}) -> Iterator[tuple[int, int, float]]:
    """Start, end and cost of every span that a guesser tries as a whole. `words` has the ranks
    of words besides the fixed ones."""
    longest = max(LONGEST, LONGEST_WORD) if words else LONGEST
    low = value.lower()
    if len(low) != len(value):                    # a character whose lower case is longer
        low = value
    repeats = _ends(low, lambda a, b: a == b)
    walks = _ends(low, lambda a, b: a + b in STEPS)
    for i in range(len(low)):
        for j in range(i + 3, min(len(low), i + longest) + 1):
            rank = RANKS.get(low[i:j]) or words.get(low[i:j])
            if rank:
                shift = 0.0 if value[i:j] in (low[i:j], low[i:j].title()) else 0.5
                yield i, j, SPAN_COST + math.log10(rank + 1) + shift
        found = DATE.match(low, i)
        if found:
            yield i, found.end(), SPAN_COST + (YEAR_COST if found.end() - i == 4 else DATE_COST)
        for ends, alphabet in ((repeats, 94), (walks, 47)):
            if ends[i] - i >= 3:
                yield i, ends[i], SPAN_COST + math.log10(alphabet * (ends[i] - i))


def guess_cost(value: str, words: Mapping[str, int] = {}) -> float:
    """Least cost of a segmentation into spans and brute-forced characters; 0 for an empty value."""
    starting: dict[int, list[tuple[int, float]]] = {}
    for i, j, cost in spans_of(value, words):
        starting.setdefault(i, []).append((j, cost))
    best = [0.0] + [math.inf] * len(value)
    for i, c in enumerate(value):
        best[i + 1] = min(best[i + 1], best[i] + _character_cost(c))
        for j, cost in starting.get(i, ()):
            best[j] = min(best[j], best[i] + cost)
    return best[-1]


def find(text: str | None, words: Mapping[str, int] = {}) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points, by start, then kind. A null text is empty.

    Base patterns are matched left to right without overlap, each on its own; then matches that
    are too short are dropped. `guess` is a value in credential context that is not inside an
    `assign` match and costs LEAST_COST or more.
    """
    if not text:
        return []
    found: list[tuple[str, int, int]] = []
    low = text.lower()
    if any(hint in low for hint in ASSIGN_HINTS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text)
                  if len(m[2]) >= LEAST_ASSIGN]
    known = [(start, end) for _, start, end in found]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= LEAST_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    if any(hint in low for hint in CREDENTIAL_HINTS):
        at = 0
        for m in CREDENTIAL.finditer(text):
            while at < len(known) and known[at][1] <= m.start(1):
                at += 1
            inside = at < len(known) and known[at][0] < m.end(1)
            if not inside and guess_cost(m[1], words) >= LEAST_COST:
                found.append(("guess", *m.span(1)))
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def masked_text(text: str | None, words: Mapping[str, int] = {}) -> str | None:
    """The text with every span, overlapping ones as one, replaced by [SECRET]."""
    spans = find(text, words)
    if not spans:
        return text
    parts, at = [], 0
    for _, start, end in spans:
        if start >= at:
            parts += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


FOUND = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def _words_counted(batches):
    def counted():
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
            names=["word", "n"])

    counts: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            low = (text or "").lower()
            if any(hint in low for hint in CREDENTIAL_HINTS):
                low = CREDENTIAL.sub(" ", low)
            counts.update(set(WORD.findall(low)))
            if len(counts) >= COUNTED_AT_A_TIME:
                yield counted()
                counts.clear()
    yield counted()


def corpus_words(docs: DataFrame, *, text_col: str = "text") -> dict[str, int]:
    """Ranks, behind the fixed words, of the CORPUS_WORDS words that most documents hold.

    A word counts where it stands outside credential values, so that a value is not made cheap by
    being repeated; a word of fewer than LEAST_DOCUMENTS documents does not count. Of equally
    frequent words the first in code-point order ranks first.
    """
    ready(docs.sparkSession)
    counts = docs.select(text_col).mapInArrow(_words_counted, "word string, n bigint") \
        .groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= LEAST_DOCUMENTS).orderBy(F.desc("n"), "word") \
        .limit(CORPUS_WORDS).toArrow().column("word").to_pylist()
    return {word: rank for rank, word in enumerate(top, len(COMMON) + 1)}


def _report(texts: pd.Series, words: Mapping[str, int]) -> pd.DataFrame:
    rows = []
    for text in texts:
        spans = find(text, words)
        base = [span for span in spans if span[0] != "guess"]
        kinds = [kind for kind, _, _ in base]
        rows.append((kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                     hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
    return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def _masked(texts: pd.Series, words: Mapping[str, int]) -> pd.Series:
    return texts.map(lambda text: masked_text(text, words), na_action="ignore")


def scanned(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: `doc_id`, `n_assign`, `n_access`, `n_hex`, `base_sha256`, `spans`.

    Null and empty texts have no spans; `spans` is then an empty string. Ids, nulls and repeated
    rows included, are carried along; extra columns are ignored; no rows give no rows. Each text
    is scanned whole, in time that grows with its length.
    """
    words = corpus_words(docs, text_col=text_col)
    report = F.pandas_udf(lambda texts: _report(texts, words), FOUND)
    return docs.select(F.col(id_col).alias("doc_id"), report(text_col).alias("found")) \
        .select("doc_id", "found.*")


def masked(docs: DataFrame, *, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The same rows and columns with secrets masked, and the length column, if there is one,
    holding the new number of code points. Null texts stay null."""
    words = corpus_words(docs, text_col=text_col)
    mask = F.pandas_udf(lambda texts: _masked(texts, words), "string")
    out = docs.withColumn(text_col, mask(text_col))
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.coalesce(F.length(text_col), F.col(length_col))
                             .cast(docs.schema[length_col].dataType))
    return out.select(*docs.columns)
