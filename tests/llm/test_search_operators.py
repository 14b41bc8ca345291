"""Nearest neighbours, phrases and ranked lexical search against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from edge_cases import LOWER, edge_docs, no_docs
from pyspark.sql import functions as F
from tablewright.llm import graph_search, lexical_search, phrases, queries
from tablewright.llm.base import Work


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# 11 Nearest neighbours -----------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, score string, rank string, row_id string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "s", "r", "x") for i, v in rows], VECTORS)


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def nearest_rows(rows, query, k):
    """Ranked (vec_id, distance) of one row among all others, by comparing all."""
    own = np.array(rows[query][1], float)
    found = sorted((math.sqrt(((np.array(v, float) - own) ** 2).sum()), i)
                   for at, (i, v) in enumerate(rows) if at != query and len(v) == len(own))
    return [(i, d) for d, i in found[:k]]


def test_nearest_recall_and_scores(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(graph_search, "SHARD_ROWS", 120)
    rows = [(r.vec_id, r.embedding) for r in
            spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = by_query(queries.op11_nearest(spark, sf_dir).collect())
    asked = [n for n, (i, _) in enumerate(rows) if i % 100 == 0]
    assert set(got) == {rows[n][0] for n in asked}
    right = 0
    for n in asked:
        hits = got[rows[n][0]]
        assert [h[0] for h in hits] == list(range(1, 11))
        exact = dict(nearest_rows(rows, n, len(rows)))
        assert all(score == pytest.approx(exact[i], rel=1e-12) for _, i, score in hits)
        right += len({h[1] for h in hits} & {i for i, _ in nearest_rows(rows, n, 10)})
    assert right >= 0.95 * 10 * len(asked)


def test_graph_finds_neighbours_and_reaches_every_node():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 24)) * 30
    points = np.concatenate([rng.normal(size=(2000, 24)),
                             np.repeat(centres, 150, 0) + rng.normal(size=(1200, 24)) * 0.01])
    points = points[rng.permutation(len(points))]
    graph = graph_search.Graph.built(points)
    for near in graph.levels:
        seen, front = set(), [0]
        while front:
            seen.update(front)
            front = sorted({int(x) for x in near[front].ravel() if x >= 0} - seen)
        assert len(seen) == len(near)
        assert near.max() < len(near)
    asked = points[::16]
    found = graph.nearest(asked)
    gaps = ((asked[:, None] - points) ** 2).sum(2)
    exact = np.argsort(gaps, 1)[:, :10]
    recall = np.mean([len(set(f[:10]) & set(e)) / 10 for f, e in zip(found, exact, strict=True)])
    assert recall >= 0.95


def test_stored_graph_round_trip():
    points = np.random.default_rng(5).normal(size=(900, 7))
    graph = graph_search.Graph.built(points)
    row = {"n": len(points), "dimensions": 7, "vectors": points.tobytes(),
           "level_sizes": np.array([len(a) for a in graph.levels], "<i4").tobytes(),
           "neighbours": np.concatenate([a.ravel() for a in graph.levels]).astype("<i4").tobytes()}
    back = graph_search.read_graph(row)
    assert all((a == b).all() for a, b in zip(graph.levels, back.levels, strict=True))
    assert (graph.nearest(points[:9], 50) == back.nearest(points[:9], 50)).all()


def test_nearest_of_awkward_rows(spark):
    rng = random.Random(2)
    hot = [1.0, 2.0, 3.0]
    rows = [(i, hot) for i in range(0, 240)]                       # one vector in many rows
    rows += [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(240, 420)]
    rows += [(300, [9.0, 9.0, 9.0]), (300, [9.0, 9.0, 9.0]), (-100, [9.0, 9.0, 8.5])]   # repeated id
    rows += [(1000, [5.0, 0.5]), (1001, [5.0, 0.25])]              # another length
    odd = [(500, None), (600, []), (700, [0.0, -0.0, 0.0]), (800, [1.0, None, 2.0]),
           (900, [1.0, float("nan"), 2.0]), (1100, [1.0, float("inf"), 2.0]), (None, hot)]
    got = {}
    for r in graph_search.nearest(vectors(spark, rows + odd)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = {}
    for n, (i, _) in enumerate(rows):
        if i % 100 == 0:
            want.setdefault(i, []).extend(
                (rank, v, d) for rank, (v, d) in enumerate(nearest_rows(rows, n, 10), 1))
    assert set(got) == set(want)
    for i, hits in want.items():
        assert [(a, b) for a, b, _ in sorted(got[i])] == [(a, b) for a, b, _ in sorted(hits)]
        assert [c for *_, c in sorted(got[i])] == pytest.approx([c for *_, c in sorted(hits)])
    assert len(got[300]) == 30 and len(got[1000]) == 1
    none = graph_search.nearest(vectors(spark, []))
    assert none.columns == ["query_id", "rank", "vec_id", "score"] and none.count() == 0


def test_distances_of_extreme_vectors():
    a = np.array([[1e300, -1e300], [1e-300, 0.0], [3.0, 4.0], [1.7e308, 0.0], [2.0, 2.0]])
    b = np.array([[1e300, 1e300], [0.0, 0.0], [0.0, 0.0], [-1.7e308, 0.0], [2.0, 2.0]])
    got = graph_search.distances(a, b)
    assert got[:3] == pytest.approx([2e300, 1e-300, 5.0])
    assert got[3] == math.inf and got[4] == 0.0


# 12 Phrases ------------------------------------------------------------------------------------

def all_phrases(rows):
    """Counts of every phrase of one to four words by (lang, phrase), and the words per language."""
    found, sizes = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n\v\f\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            sizes[lang or "und"] += len(w)
            for n in range(1, 5):
                found.update((lang or "und", " ".join(w[i:i + n])) for i in range(len(w) - n + 1))
    return found, sizes


def best_phrases(rows, least, top=2000):
    found, sizes = all_phrases(rows)
    frequent = {key: f for key, f in found.items() if f >= least}
    candidates = {key: f for key, f in frequent.items() if " " in key[1]}
    out = []
    for (lang, phrase), a in candidates.items():
        w = phrase.split(" ")
        cuts = []
        for k in range(1, len(w)):
            left, right = found[lang, " ".join(w[:k])], found[lang, " ".join(w[k:])]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        if not any(other == lang and 100 * f >= 80 * a and longer != phrase
                   and f" {phrase} " in f" {longer} "
                   for (other, longer), f in candidates.items()):
            out.append((lang, -score, -a, phrase.encode(), left, right))
    ranked, seen = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase.decode(), -a, left, right, sizes[lang], -score))
    return ranked


PHRASE_COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def found_phrases(docs, **options):
    return sorted(tuple(r[c] for c in PHRASE_COLUMNS)
                  for r in phrases.collocations(docs, **options).collect())


def test_every_phrase_is_counted_once():
    rng = random.Random(4)
    texts = [("en", " ".join(rng.choice(["a", "b", "c.", "d", "e!\n", "ü"]) for _ in range(n)).encode())
             for n in (0, 1, 2, 3, 4, 5, 60, 2000, 2000)]
    texts += [("en", texts[-1][1]), ("en", b"x " * 500), ("en", b" . ,;\t\n")]
    chunks = phrases.parsed(texts)
    found, sizes = all_phrases([(lang, raw.decode()) for lang, raw in texts])
    part = phrases.Chunks([k[0] for k in chunks], [k[1] for k in chunks], list(chunks.values()))
    got = Counter()
    for n, batch in enumerate(part.phrases([]), 1):
        for row in batch.to_pylist():
            got[row["lang"], row["phrase"].decode()] += row["copies"]
            assert row["words"] == n
    assert got == found
    assert sum(words * copies for (_, _, words), copies in chunks.items()) == sizes["en"]
    # Equal content gives equal chunks: a copy adds hardly a distinct one.
    assert len(chunks) < len(phrases.parsed(texts[:-4])) + len(phrases.parsed([texts[-2]])) + 200


def test_tokens_that_share_a_hash():
    tokens = phrases.Tokens(b" ab cd ab . ef cd")
    assert tokens.word.tolist() == [True, True, True, False, True, True]
    for shared in (tokens.hash, np.where(tokens.word, np.uint64(7), tokens.hash)):
        tokens.hash = shared
        number = tokens.numbers().tolist()
        assert number[0] == number[2] and number[1] == number[5] and len(set(number)) == 4


@pytest.mark.parametrize("bits", [1 << 27, 1 << 15])
def test_phrases(documents, monkeypatch, bits):
    """Also with so small a bit table that it lets nearly everything through."""
    monkeypatch.setattr(phrases, "TABLE_BITS", bits)
    rows = [(r.lang, r.text) for r in documents.collect()]
    want = best_phrases(rows, 6, top=90)
    assert len(want) > 100 and found_phrases(documents, least=6, top=90) == want


def test_phrases_of_awkward_rows(spark):
    docs = edge_docs(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert found_phrases(docs, least=1) == best_phrases(rows, 1)
    assert found_phrases(docs, least=2) == best_phrases(rows, 2)
    assert found_phrases(no_docs(spark), least=1) == []
    assert found_phrases(docs, least=10 ** 6) == []


def test_phrase_ties_and_hidden_parts(spark):
    text = "b a. b a. a c. a c. é z. é z. new york city. new york city. york city x"
    docs = spark.createDataFrame([(1, text, None), (2, text, "und"), (None, text.upper(), None)],
                                 "doc_id bigint, text string, lang string")
    got = found_phrases(docs, least=6)
    assert got == best_phrases([(None, text.replace("É", "é"))] * 2 + [(None, text.upper())], 6)
    assert "new york" not in [r[2] for r in got]


# 13 Ranked lexical search ----------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranking(docs, items, k=20):
    """Rows (item_id, rank, doc_id, score) by scoring every pair."""
    counted = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n_docs, words = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item_id, text in items:
        asked, scores = Counter(terms(text)), []
        for doc_id, c, n in counted:
            m = 75 + 25 * n * n_docs // words
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                        for t, times in asked.items() if c[t])
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        out += [(item_id, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def found_ranking(docs, items, **options):
    return sorted(map(tuple, lexical_search.ranked(docs, items, **options).collect()), key=repr)


@pytest.mark.parametrize("block", [4096, 37])
def test_ranking(spark, sf_dir, documents, monkeypatch, block):
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 16)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = ranking([(r.doc_id, r.text) for r in documents.collect()],
                   [(r.item_id, r.text) for r in items.collect()])
    assert found_ranking(documents, items) == want


def test_ranking_of_awkward_rows(spark):
    docs = edge_docs(spark)
    items = spark.createDataFrame(
        [(1, "quick fox, QUICK fox"), (1, "quick fox, QUICK fox"), (2, None), (3, ""), (4, "zzz qqq"),
         (None, "again world"), (5, "alpha " * 3000 + "one"), (6, "日本語のテキスト ſ k"), (7, "12 34")],
        "item_id bigint, text string").withColumn("score", F.lit("x")).withColumn("doc_id", F.lit("y"))
    want = ranking([(r.doc_id, r.text) for r in docs.collect()],
                   [(r.item_id, r.text) for r in items.collect()], k=3)
    assert found_ranking(docs, items, k=3) == want
    assert len([r for r in want if r[0] == 1]) == 6              # the repeated item twice
    assert found_ranking(no_docs(spark), items) == []
    assert found_ranking(docs, items.where("false")) == []


def item_rows(rng, words, n):
    return [" ".join(rng.choices(words, k=rng.randrange(1, 9))) for _ in range(n)]


def test_trees_prune_and_lose_nothing():
    """On topical texts whole batches go unscored; the best stay those of all pairs."""
    rng = random.Random(8)
    topics = [[f"t{t}w{i}" for i in range(30)] for t in range(40)]
    common = [f"c{i}" for i in range(50)]
    texts = [" ".join(rng.choices(topics[t], k=25) + rng.choices(common, k=25))
             for t in (rng.randrange(40) for _ in range(3000))]
    asked = [" ".join(rng.choices(topics[t], k=6) + rng.choices(common, k=2)) for t in range(40)]
    wanted = b"\1" * lexical_search.FILTER_BITS
    df = Counter(x for t in texts for x in set(t.split()))
    weight = {t: math.floor(1000 * math.log((2 * len(texts) + 2) / (2 * n + 1))) for t, n in df.items()}
    place = {t: i for i, t in enumerate(weight)}
    counts = [Counter(a.split()) for a in asked]
    items = lexical_search.Items({
        "n": len(asked), "items": np.arange(len(asked)).tobytes(),
        "ids": np.arange(len(asked)).tobytes(), "null_ids": np.zeros(len(asked), "u1").tobytes(),
        "terms": [t.encode() for t in weight], "weights": np.array(list(weight.values())).tobytes(),
        "starts": np.cumsum([0] + [len(c) for c in counts]).tobytes(),
        "places": np.array([place[t] for c in counts for t in c], "<i4").tobytes(),
        "counts": np.array([n for c in counts for n in c.values()]).tobytes()}, 5)
    scored = 0
    for at in range(0, len(texts), 500):
        block = lexical_search._DocBlock()
        for i, text in enumerate(texts[at:at + 500], at):
            block.add(i, text.encode(), wanted)
        row = block.batch().to_pylist()[0]
        scored += lexical_search.search(items, lexical_search.Docs(row, items, len(texts), 150_000))
    assert scored < 0.35 * len(texts) * len(asked)
    got = sorted(tuple(r.values())[1:] for r in items.hits().to_pylist())
    want = sorted((i, d, s) for i, _, d, s in ranking(list(enumerate(texts)), list(enumerate(asked)), 5))
    assert got == want


def test_bit_tables(spark):
    from tablewright.llm import bitmap

    some = sorted(random.Random(1).sample(range(1 << 17), 5000)) + [0, (1 << 17) - 1]
    table = bitmap.gathered(spark.createDataFrame([(i,) for i in some * 2] + [(None,)],
                                                  "position bigint"), 1 << 17)
    assert np.flatnonzero(np.unpackbits(table, bitorder="little")).tolist() == sorted(set(some))
    everywhere = np.arange(1 << 17, dtype=np.uint64)
    assert np.flatnonzero(bitmap.has(table, everywhere)).tolist() == sorted(set(some))
    assert Work(spark, "x").folder
