"""Masked pseudo-likelihood of documents.

A bidirectional window network predicts every word from the two words on either side, and the
logarithms of the probabilities it gives to the words that stand there sum to a document's score.
Classes are bands of word frequency: the most frequent words have one each, the others share classes
of equal mass. The network predicts the class. Inside a class a word's probability comes in two
forms: `log_likelihood` takes the word's share of its class, counted over the whole corpus, whatever
stands beside it; `word_log_likelihood` predicts the word too, by an inner softmax over the words of
the class that sees the same hidden state.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import words
from tablewright.llm.base import Work, ready

VOCABULARY = 1 << 16           # words are hashed into so many
CLASSES, SINGLE = 64, 40       # classes in all; of one word each
KNOWN = 4096                   # most frequent words, which the network tells apart in a context
SIDES = (-2, -1, 1, 2)
WIDTH = 24                     # of an embedding
SHARD_WORDS = 1_000_000        # words that one task learns from, about
EPOCHS, BATCH, RATE = 3, 512, 0.01
SAFE_SCORE = 60.0              # float32 holds exp of this and sums of such
SLICES, FAN_IN = 16, 64        # parameter slices; shards averaged at a time
CHUNK = 1 << 11                # words scored at a time
UNTOUCHED = 1e-6               # weight of a row that a shard has no word for
INNER_BATCH, INNER_RATE = 256, 0.2
FAN = 64                       # words or groups of words that one inner softmax tells apart
DAMPING = 0.1                  # first moment of the inner softmax: few examples move it little
INNER_CHUNK = 1 << 17          # words scored at a time by the inner softmax
ITEM = np.dtype((np.void, 4 * WIDTH))          # an embedding as one item


def word_ids(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    hashes, offsets = words.hashed(texts)
    return (hashes >> np.uint64(48)).astype(np.int64), offsets


def _counted(batches):
    counts = np.zeros(VOCABULARY, np.int64)
    for batch in batches:
        counts += np.bincount(word_ids(batch.column(0).to_pylist())[0], minlength=VOCABULARY)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen])],
                                     names=["word", "n"])


class Inner:
    """Trees over the words of each class; a softmax at every node, all told in rows.

    A class of more than FAN words is cut, by frequency, into at most FAN groups, and these again
    until groups have FAN words. Every word or group is a row of a table of weights; `paths` has the
    rows a word goes through, level by level, -1 where there is no choice left. Weights begin at
    zero, where a row's probability is its share of its node (`base`).
    """

    def __init__(self, band: np.ndarray, order: np.ndarray, counts: np.ndarray):
        self.paths, starts, base = [], [0], []
        seen = order[counts[order] > 0]
        by_band = seen[np.argsort(band[seen], kind="stable")]
        now = np.split(by_band, np.searchsorted(band[by_band], np.arange(1, CLASSES)))
        while now := [members for members in now if len(members) > 1]:
            rows, deeper = np.full(VOCABULARY, -1, np.int64), []
            for members in now:
                size = 1
                while size * FAN < len(members):
                    size *= FAN
                child = np.arange(len(members)) // size
                rows[members] = starts[-1] + child
                mass = np.bincount(child, counts[members])
                base.append(np.log(mass / mass.sum()))
                starts.append(starts[-1] + len(mass))
                if size > 1:
                    deeper += np.split(members, np.arange(size, len(members), size))
            self.paths.append(rows)
            now = deeper
        self.starts = np.array(starts)
        self.base = np.concatenate(base).astype(np.float32) if base else np.zeros(0, np.float32)
        self.node = np.repeat(np.arange(len(base)), np.diff(self.starts))

    def choices(self, ids: np.ndarray):
        """For every node that the words go through: its rows, positions and their choices."""
        for rows in self.paths:
            own = rows[ids]
            at = np.flatnonzero(own >= 0)
            nodes = self.node[own[at]]
            order = np.argsort(nodes.astype(np.uint16), kind="stable")
            at, nodes = at[order], nodes[order]
            first = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]]) if len(at) else []
            for here, places in zip(nodes[first], np.split(at, first[1:])):
                part = slice(self.starts[here], self.starts[here + 1])
                yield part, places, own[places] - part.start

    def train(self, network: Network, contexts: np.ndarray, ids: np.ndarray) -> None:
        """Adagrad over every node's positions, shuffled; the network has learned already."""
        network.words = np.zeros((len(self.base), WIDTH + 1), np.float32)
        rng = np.random.default_rng(5)
        hidden = with_one(network, contexts)
        for part, places, choice in self.choices(ids):
            mixed = rng.permutation(len(places))
            h, choice = hidden[places[mixed]], choice[mixed]
            weights, base = network.words[part], self.base[part, None]
            moment = np.full_like(weights, DAMPING)
            for at in range(0, len(places), INNER_BATCH):
                x, y = h[at:at + INNER_BATCH], choice[at:at + INNER_BATCH]
                error = weights @ x.T
                error += base
                error -= error.max(0)
                np.exp(error, out=error)
                error /= error.sum(0)
                error[y, np.arange(len(y))] -= 1
                g = error @ x
                moment += g * g
                weights -= INNER_RATE * g / np.sqrt(moment)

    def log_probability(self, network: Network, hidden: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Of every word within its class, by the hidden units (with the one) of its position."""
        logs = np.zeros(len(ids), np.float32)
        for part, places, choice in self.choices(ids):
            scores = network.words[part] @ hidden[places].T
            scores += self.base[part, None]
            scores -= scores.max(0)
            chosen = scores[choice, np.arange(len(choice))]
            logs[places] += chosen - np.log(np.exp(scores, out=scores).sum(0))
        return logs

    def weights(self, ids: np.ndarray) -> np.ndarray:
        """How many of the positions each row's node has learned from."""
        if not len(self.base):
            return np.zeros(0)
        chosen = sum(np.bincount(own[own >= 0], minlength=len(self.base))
                     for own in (rows[ids] for rows in self.paths))
        per_node = np.add.reduceat(chosen, self.starts[:-1])
        return np.maximum(per_node[self.node], UNTOUCHED)


def with_one(network: Network, contexts: np.ndarray) -> np.ndarray:
    """Hidden units with a constant one behind them, which meets the bias."""
    out = np.ones((len(contexts), WIDTH + 1), np.float32)
    for at in range(0, len(out), CHUNK):
        out[at:at + CHUNK, :WIDTH] = network.hidden(contexts[at:at + CHUNK])
    return out


class Bands:
    """Classes, shares and context ids of all hashed words, from their counts in the corpus."""

    def __init__(self, counts: np.ndarray):
        order = np.lexsort((np.arange(VOCABULARY), -counts))
        self.band = np.full(VOCABULARY, CLASSES - 1, np.int64)
        self.band[order[:SINGLE]] = np.arange(SINGLE)
        rest = order[SINGLE:]
        mass = np.cumsum(counts[rest], dtype=np.float64)
        if mass[-1] > 0:
            self.band[rest] = SINGLE + np.minimum(
                (mass - counts[rest] / 2) / mass[-1] * (CLASSES - SINGLE),
                CLASSES - SINGLE - 1).astype(np.int64)
        self.inner = Inner(self.band, order, counts)
        total = np.bincount(self.band, counts, CLASSES)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.log_share = np.log(counts / total[self.band])
        # Contexts: frequent words, the classes of the others, and beyond the text's ends.
        self.context = KNOWN + self.band
        self.context[order[:KNOWN]] = np.arange(KNOWN)

    def contexts(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Context ids of every position, one column per side; never across a text's ends."""
        padded = KNOWN + CLASSES
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        own = self.context[ids]
        out = np.full((len(ids), len(SIDES)), padded, np.int64)
        for column, side in enumerate(SIDES):
            if len(ids) <= abs(side):
                continue
            here, there = (slice(-side, None), slice(None, side)) if side < 0 else \
                (slice(None, -side), slice(side, None))
            out[here, column] = np.where(owner[here] == owner[there], own[there], padded)
        return out


class Network:
    """Sum of one embedding per side, tanh, softmax over the classes; `words` are the weights of the
    inner softmax over the words of a class, one row per row of `Inner`."""

    def __init__(self, seed: int = 3, inner_rows: int = 0):
        rng = np.random.default_rng(seed)
        self.joint = np.concatenate(
            [rng.normal(0, 0.1, (KNOWN + CLASSES + 1, WIDTH)).astype(np.float32) for _ in SIDES])
        self.tables = np.split(self.joint, len(SIDES))         # views, one per side
        self.out = rng.normal(0, 0.1, (WIDTH, CLASSES)).astype(np.float32)
        self.bias = np.zeros(CLASSES, np.float32)
        self.words = np.zeros((inner_rows, WIDTH + 1), np.float32)

    def parameters(self) -> np.ndarray:
        return np.concatenate([t.ravel() for t in (*self.tables, self.out, self.bias)])

    def load(self, flat: np.ndarray) -> Network:
        at = 0
        for array in (*self.tables, self.out, self.bias):
            array[...] = flat[at:at + array.size].reshape(array.shape)
            at += array.size
        return self

    def hidden(self, contexts: np.ndarray) -> np.ndarray:
        total = self.tables[0].take(contexts[:, 0], 0)
        for column in range(1, len(SIDES)):
            total += self.tables[column].take(contexts[:, column], 0)
        return np.tanh(total, out=total)

    def log_probability(self, contexts: np.ndarray, bands: np.ndarray) -> np.ndarray:
        return self.class_log_probability(self.hidden(contexts), bands)

    def class_log_probability(self, hidden: np.ndarray, bands: np.ndarray) -> np.ndarray:
        scores = self.out.T @ hidden.T
        scores += self.bias[:, None]
        scores -= scores.max(0)
        chosen = scores[bands, np.arange(len(bands))]
        return chosen - np.log(np.exp(scores, out=scores).sum(0))

    def train(self, contexts: np.ndarray, bands: np.ndarray) -> None:
        """Adagrad over EPOCHS shuffled passes; starts from the classes' frequencies."""
        if not len(bands):
            return
        self.bias[...] = np.log((np.bincount(bands, minlength=CLASSES) + 0.5)
                           / (len(bands) + CLASSES / 2)).astype(np.float32)
        rows = joint_rows(contexts).astype(np.uint16)
        # Output weights with the bias as last row: hidden units get a constant one to match.
        out = np.vstack((self.out, self.bias))
        moments = [np.full_like(t, 1e-4) for t in (self.joint, out)]
        # The same rows as one item each, which numpy writes at once.
        joint_items, moment_items = (t.view(ITEM)[:, 0] for t in (self.joint, moments[0]))
        rng = np.random.default_rng(4)
        buffer, places = np.empty((BATCH, WIDTH), np.float32), np.arange(BATCH)
        for _ in range(EPOCHS):
            order = rng.permutation(len(bands))
            rows_now, bands_now = rows[order], bands[order]
            sides_now = np.ascontiguousarray(rows_now.T).astype(np.intp)
            for at in range(0, len(order), BATCH):
                flat, y = rows_now[at:at + BATCH].ravel(), bands_now[at:at + BATCH]
                size = len(y)
                units, more = np.empty((size, WIDTH), np.float32), buffer[:size]
                for column, side in enumerate(sides_now[:, at:at + BATCH]):
                    self.joint.take(side, 0, out=more if column else units, mode="clip")
                    if column:
                        units += more
                np.tanh(units, out=units)
                h = np.empty((size, WIDTH + 1), np.float32)
                h[:, :WIDTH], h[:, WIDTH] = units, 1
                # One row per class: sums over the classes then run along rows. Scores are shifted
                # only if they could leave the range of exp.
                error = out.T @ h.T
                if np.abs(out).sum(0).max() > SAFE_SCORE:
                    error -= error.max(0)
                np.exp(error, out=error)
                total = error.sum(0)
                error[y, places[:size]] -= total
                # The errors stay unscaled; what they are multiplied with is scaled instead.
                scale = (1 / (total * np.float32(size ** 0.5)))[:, None]
                back = error.T @ out[:WIDTH].T
                units *= units
                np.subtract(1, units, out=units)
                units *= scale
                back *= units
                h *= scale
                g = h.T @ error.T
                moments[1] += g * g
                out -= RATE * 5 * g / np.sqrt(moments[1])
                # One sum per row of the joint table, its positions brought together by a sort.
                by_row = np.argsort(flat, kind="stable")
                touched, g = summed(flat[by_row], back, by_row // len(SIDES))
                moment = moment_items.take(touched).view(np.float32).reshape(g.shape)
                moment += g * g
                moment_items[touched] = moment.view(ITEM)[:, 0]
                g *= RATE * 5
                g /= np.sqrt(moment, out=moment)
                now = joint_items.take(touched).view(np.float32).reshape(g.shape)
                now -= g
                joint_items[touched] = now.view(ITEM)[:, 0]
        self.out[...], self.bias[...] = out[:WIDTH], out[WIDTH]


def summed(rows: np.ndarray, values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ones of the sorted `rows` and for each the sum of its `values`, which lie at `at`.

    Most rows come once and are only copied; the others are added in pairs of columns, as complex
    numbers: half as many short sums.
    """
    first = np.ones(len(rows) + 1, bool)
    np.not_equal(rows[1:], rows[:-1], out=first[1:-1])
    starts = np.flatnonzero(first[:-1])
    sums = values.take(at[starts], 0)
    repeated = ~(first[:-1] & first[1:])
    if repeated.any():
        own = np.flatnonzero(repeated)
        pairs = values.take(at[own], 0).view(np.complex64)
        several = np.flatnonzero(~first[starts + 1])
        sums.view(ITEM)[several, 0] = np.add.reduceat(
            pairs, np.flatnonzero(first[own]), axis=0).view(
            ITEM)[:, 0]
    return rows[starts].astype(np.intp), sums


def joint_rows(contexts: np.ndarray) -> np.ndarray:
    """Rows of the joint table that the contexts of each position stand for."""
    return contexts + np.arange(len(SIDES)) * (KNOWN + CLASSES + 1)


COLUMNS = ["doc_id", "n_words", "log_likelihood", "mean_log_probability", "word_log_likelihood",
           "mean_word_log_probability"]


def _scores(bands: Bands, network: Network):
    def run(batches):
        for batch in batches:
            ids, offsets = word_ids(batch.column(1).to_pylist())
            contexts = bands.contexts(ids, offsets)
            own = bands.band[ids]
            logs, word_logs = bands.log_share[ids], np.empty(len(ids))
            for start in range(0, len(ids), INNER_CHUNK):
                here = slice(start, start + INNER_CHUNK)
                hidden = with_one(network, contexts[here])
                for at in range(0, len(hidden), CHUNK):
                    part = slice(start + at, start + min(at + CHUNK, len(hidden)))
                    word_logs[part] = network.class_log_probability(
                        hidden[at:at + CHUNK, :WIDTH], own[part])
                logs[here] += word_logs[here]
                word_logs[here] += bands.inner.log_probability(network, hidden, ids[here])
            counts = np.diff(offsets)
            owner = np.repeat(np.arange(len(counts)), counts)
            columns = [batch.column(0), pa.array(counts)]
            for each in (logs, word_logs):
                sums = np.bincount(owner, each, len(counts)).astype(np.float64)
                columns += [pa.array(sums), pa.array(
                    np.divide(sums, counts, out=np.zeros(len(sums)), where=counts > 0),
                    mask=counts == 0)]
            yield pa.RecordBatch.from_arrays(columns, names=COLUMNS)
    return run


def _weights(contexts: np.ndarray) -> np.ndarray:
    """How many positions each parameter has learned from, in the order of `parameters`."""
    touched = np.bincount(joint_rows(contexts).ravel(),
                          minlength=len(SIDES) * (KNOWN + CLASSES + 1))
    return np.concatenate((np.repeat(np.maximum(touched, UNTOUCHED), WIDTH),
                           np.full((WIDTH + 1) * CLASSES, max(len(contexts), UNTOUCHED))))


def _trained(bands: Bands):
    def run(key, docs):
        """Parameters learned from every word of one shard's texts, in SLICES parts; the inner weights
        are as many parts more, in half precision, with one averaging weight per row."""
        docs = docs.sort_by([("doc", "ascending"), ("text", "ascending")])
        ids, offsets = word_ids(docs.column("text").to_pylist())
        contexts, network = bands.contexts(ids, offsets), Network()
        network.train(contexts, bands.band[ids])
        bands.inner.train(network, contexts, ids)
        parts, weights = (
            [*np.array_split(outer.astype("<f4"), SLICES), *np.array_split(inner, SLICES)]
            for outer, inner in (
                (network.parameters(), network.words.astype("<f2")),
                (_weights(contexts), bands.inner.weights(ids).astype("<f4"))))
        return pa.table({"shard": pa.array([key[0].as_py()] * 2 * SLICES, pa.int64()),
                         "slice": pa.array(range(2 * SLICES), pa.int32()),
                         "part": pa.array([p.tobytes() for p in parts], pa.binary()),
                         "weight": pa.array([w.tobytes() for w in weights], pa.binary())})
    return run


def _averaged(key, rows: pa.Table) -> pa.Table:
    """Mean of one slice over at most FAN_IN shards, each parameter weighted by the positions it
    has learned from: what a shard has no word for stays as the other shards learned it."""
    rows = rows.sort_by("shard")
    total = weight = 0.0
    kind, shape = ("<f2", (-1, WIDTH + 1)) if key[1].as_py() >= SLICES else ("<f4", (-1, 1))
    for part, weights in zip(rows.column("part").to_pylist(), rows.column("weight").to_pylist(),
                             strict=True):
        w = np.frombuffer(weights, "<f4").astype(np.float64)[:, None]
        total, weight = total + np.frombuffer(part, kind).reshape(shape) * w, weight + w
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()),
                     "slice": pa.array([key[1].as_py()], pa.int32()),
                     "part": pa.array([(total / weight).astype(kind).tobytes()], pa.binary()),
                     "weight": pa.array([weight.astype("<f4").tobytes()], pa.binary())})


def fitted(docs: DataFrame, work: Work) -> tuple[Bands, Network]:
    """Count all words of the corpus, then train the network on every position of every text.

    Texts are dealt whole to shards of about SHARD_WORDS words by a hash of id and text; one task
    learns from one shard, and the shards' parameters are averaged FAN_IN at a time, slice by
    slice. No task or driver holds more than a shard, FAN_IN slices, VOCABULARY counts or one
    network with its inner weights (25 numbers for each of at most VOCABULARY words and their
    groups). `docs` has columns `id` and `text`.
    """
    counted = work.stored(
        docs.select("text").mapInArrow(_counted, "word int, n bigint")
        .groupBy("word").agg(F.sum("n").alias("n")), "counts").toArrow()
    counts = np.zeros(VOCABULARY, np.int64)
    counts[counted.column("word").to_numpy()] = counted.column("n").to_numpy()
    bands = Bands(counts)
    network = Network(inner_rows=len(bands.inner.base))
    total = int(counts.sum())
    if not total:
        return bands, network
    shards = -(-total // SHARD_WORDS)
    schema = "shard bigint, slice int, part binary, weight binary"
    learned = work.stored(
        docs.where("text IS NOT NULL")
        .select(F.pmod(F.xxhash64("id", "text"), F.lit(shards)).alias("shard"),
                F.xxhash64("id").alias("doc"), "text")
        .groupBy("shard").applyInArrow(_trained(bands), schema), "learned")
    while shards > 1:
        shards = -(-shards // FAN_IN)
        learned = work.stored(
            learned.withColumn("shard", F.col("shard") % shards)
            .groupBy("shard", "slice").applyInArrow(lambda key, rows: _averaged(key, rows), schema),
            "averaged")
    parts = learned.orderBy("slice").select("part").toArrow().column("part").to_pylist()
    if parts:
        network.load(np.concatenate([np.frombuffer(p, "<f4") for p in parts[:SLICES]]))
        network.words = np.concatenate([np.frombuffer(p, "<f2") for p in parts[SLICES:]]).astype(
            np.float32).reshape(-1, WIDTH + 1)
    return bands, network


def scored(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: `doc_id`, `n_words`, `log_likelihood`, `mean_log_probability` (classes
    predicted, words by their share), `word_log_likelihood`, `mean_word_log_probability` (words
    predicted).

    Every word of every text is predicted. A null, empty or blank text has 0 words, likelihood 0
    and a null mean. Equal texts score alike up to rounding, ids (null too) are carried along, extra columns are
    ignored, no rows give no rows.
    """
    ready(docs.sparkSession)
    work = Work(docs.sparkSession, "lm-score")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    bands, network = fitted(rows, work)
    return rows.mapInArrow(
        _scores(bands, network),
        "doc_id bigint, n_words bigint, log_likelihood double, mean_log_probability double, "
        "word_log_likelihood double, mean_word_log_probability double")
