"""Language identification: sparse multinomial logistic regression on TF-IDF n-grams.

Texts become counts of hashed runs of one to three characters, damped, weighted by inverse
document frequency and scaled to length one. Weights are learned by follow-the-regularised-leader
with an elastic-net penalty, whose L1 part leaves most of them zero. A temperature fitted on
learning rows that the weights have not seen turns the scores into calibrated probabilities.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.base import ready

WIDTH = 1 << 14                # hashed features
LONGEST = 3                    # characters of an n-gram
PIECE = 1 << 20                # characters counted at a time
SAMPLE = 3000                  # learning rows at most, about; an equal share for each language
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.01
LEAST_ASIDE = 20               # rows below which the temperature stays 1
UNKNOWN = "und"

_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if "letters" not in _tables:
        _tables["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool,
                                         0x110000)
    return _tables["letters"]


def _counts_of(codes: np.ndarray) -> np.ndarray:
    counts = np.zeros(WIDTH, np.int64)
    for n in range(1, LONGEST + 1):
        m = len(codes) - n + 1
        if m <= 0:
            break
        h = np.full(m, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            h = (h ^ codes[k:k + m]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(13)
        counts += np.bincount((h * np.uint32(0xC2B2AE35)) >> np.uint32(18), minlength=WIDTH)
    return counts


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text; None if it is null or has no letter.

    Upper case is lowered; each run of other characters than letters is one blank.
    """
    if not text:
        return None
    counts, any_letter = np.zeros(WIDTH, np.int64), False
    for at in range(0, len(text), PIECE):
        low = text[at:at + PIECE].lower()
        codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[codes]
        any_letter |= bool(letter.any())
        codes = np.where(letter, codes, np.uint32(32))
        keep = np.ones(len(codes), bool)
        keep[1:] = letter[1:] | letter[:-1]
        counts += _counts_of(np.concatenate(
            (np.array([32], np.uint32), codes[keep], np.array([32], np.uint32))))
    return counts if any_letter else None


def _weighted(indices: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf[indices]
    norm = np.sqrt((x * x).sum())
    return x / norm if norm else x


class Model:
    """Languages, feature weights and temperature. Immutable once fitted; sent to the tasks."""

    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray,
                 temperature: float):
        self.languages, self.idf = languages, idf.astype(np.float32)
        self.weights, self.temperature = weights.astype(np.float32), temperature

    def probabilities(self, indices: np.ndarray, counts: np.ndarray) -> np.ndarray:
        scores = _weighted(indices, counts, self.idf) @ self.weights[indices]
        return _softmax(scores / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float]:
        """A language and its probability; `und` and 0 for a text without a letter, or if
        nothing was learned. Of equally likely languages the first in code-point order."""
        counts = gram_counts(text) if self.languages else None
        if counts is None:
            return UNKNOWN, 0.0
        indices = np.flatnonzero(counts)
        chances = self.probabilities(indices, counts[indices])
        best = int(np.argmax(chances))
        return self.languages[best], min(1.0, float(chances[best]))


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max())
    return e / e.sum()


def _ftrl(rows: list, labels: np.ndarray, classes: int) -> np.ndarray:
    """Weights after EPOCHS passes of per-coordinate FTRL-proximal steps."""
    z, n = np.zeros((WIDTH, classes)), np.zeros((WIDTH, classes))

    def weights(z, n):
        live = np.abs(z) > L1
        return np.where(live, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    rng = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            w = weights(z[at], n[at])
            error = _softmax(x @ w)
            error[labels[i]] -= 1.0
            g = np.outer(x, error)
            root = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - root) / ALPHA * w
    return weights(z, n)


def _temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """Golden-section search for the temperature of least negative log likelihood.

    Labels count as certain only up to (rows + 1) / (rows + 2), the rest is spread evenly over
    the other languages: else rows without an error would ask for temperature 0.
    """
    count, classes = scores.shape
    sure = (count + 1) / (count + 2)
    wanted = np.full(scores.shape, (1 - sure) / (classes - 1))
    wanted[np.arange(count), labels] = sure

    def loss(log_t: float) -> float:
        s = scores / np.exp(log_t)
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - (wanted * s).sum(1)).mean())

    low, high, ratio = -4.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def fit(samples: list[tuple[str, np.ndarray, np.ndarray]],
        frequencies: tuple[int, np.ndarray] | None = None) -> Model:
    """Learn from (language, feature indices, counts). Every fifth row only sets the temperature.

    `frequencies`: the number of documents and, per feature, of those that have it; by default
    those of the samples.
    """
    languages = sorted({language for language, _, _ in samples})
    if not languages:
        return Model([], np.zeros(WIDTH), np.zeros((WIDTH, 0)), 1.0)
    if frequencies is None:
        seen = np.zeros(WIDTH)
        for _, indices, _ in samples:
            seen[indices] += 1
        frequencies = len(samples), seen
    idf = np.log((1 + frequencies[0]) / (1 + frequencies[1])) + 1
    labels = np.array([languages.index(language) for language, _, _ in samples])
    rows = [(indices, _weighted(indices, counts, idf)) for _, indices, counts in samples]
    aside = np.arange(len(rows)) % 5 == 4
    learn = np.flatnonzero(~aside)
    weights = _ftrl([rows[i] for i in learn], labels[learn], len(languages))
    temperature = 1.0
    if aside.sum() >= LEAST_ASIDE and len(languages) > 1:
        scores = np.stack([rows[i][1] @ weights[rows[i][0]] for i in np.flatnonzero(aside)])
        temperature = _temperature(scores, labels[aside])
    return Model(languages, idf, weights, temperature)


def _counted(batches):
    for batch in batches:
        kept = []
        for doc_id, text, language in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counts = gram_counts(text)
            if counts is not None:
                at = np.flatnonzero(counts)
                kept.append((doc_id, language, at.astype("<u2").tobytes(),
                             counts[at].astype("<u4").tobytes()))
        columns = list(zip(*kept, strict=True)) if kept else [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()),
             pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())],
            names=["doc_id", "lang", "indices", "counts"])


def _features(batches):
    """For one task: how many texts have each feature, and, as feature WIDTH, how many have any."""
    seen = np.zeros(WIDTH + 1, np.int64)
    for batch in batches:
        for text in batch.column(0):
            counts = gram_counts(text.as_py())
            if counts is not None:
                seen[:WIDTH] += counts > 0
                seen[WIDTH] += 1
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())],
                                     names=["feature", "n"])


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """The number of texts with a letter and, per feature, of those that have it. All texts of
    the one column are counted; a task hands on one row per feature, the driver gets the sums."""
    sums = texts.mapInArrow(_features, "feature int, n bigint").groupBy("feature").agg(
        F.sum("n").alias("n")).toArrow()
    seen = np.zeros(WIDTH + 1, np.int64)
    seen[sums.column("feature").to_numpy()] = sums.column("n").to_numpy()
    return int(seen[WIDTH]), seen[:WIDTH]


def held_out(id_col: str) -> F.Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned(docs: DataFrame, *, sample: int = SAMPLE, id_col: str = "doc_id",
            text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on about `sample` labelled rows that are not held out, an equal share for each
    language, chosen by a hash of id and text; of equal rows one is taken. Document frequencies
    are those of all labelled rows that are not held out. Rows without id, language or letters
    teach nothing."""
    ready(docs.sparkSession)
    rows = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(id_col)) \
        .select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
                F.col(lang_col).alias("lang"))
    totals = {row["lang"]: row["count"] for row in rows.groupBy("lang").count().collect()}
    if not totals:
        return fit([])
    share = sample / len(totals)
    fine = 1 << 30
    bar = F.create_map(*[F.lit(x) for lang, count in totals.items()
                         for x in (lang, int(fine * min(1.0, share / count)))])
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(fine)) < F.element_at(bar, F.col("lang")))
    got = chosen.mapInArrow(
        _counted, "doc_id bigint, lang string, indices binary, counts binary").distinct().toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("lang", "ascending"), ("indices", "ascending"),
                       ("counts", "ascending")])
    return fit([(lang, np.frombuffer(at, "<u2").astype(np.int64),
                 np.frombuffer(counts, "<u4").astype(np.float64))
                for lang, at, counts in zip(*(got.column(c).to_pylist()
                                              for c in ("lang", "indices", "counts")),
                                            strict=True)],
               document_frequencies(rows.select("text")))


def with_language(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """Add `lang_pred` and `score` from the text alone; columns so named are replaced."""
    ready(docs.sparkSession)

    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(text) for text in texts],
                            columns=["lang_pred", "score"])

    predict = F.pandas_udf(run, "lang_pred string, score double")
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.withColumn("__lang", predict(text_col)).select(
        *rest, F.col("__lang.lang_pred").alias("lang_pred"), F.col("__lang.score").alias("score"))


def identified(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang") -> DataFrame:
    """One row per document: `doc_id`, `held_out`, `lang_pred`, `score`.

    A null text, or one without a letter, is `und` with score 0; so is every text if there is
    nothing to learn from. With one language learned, all others get it with score 1. Repeated
    rows get equal results, extra columns are ignored, no rows give no rows.
    """
    model = learned(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       held_out(id_col).alias("held_out"))
    return with_language(rows, model).select("doc_id", "held_out", "lang_pred", "score")
