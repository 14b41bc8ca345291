"""Packing, mixing, URL filter, vector search and WARC against plain Python."""

import base64
import hashlib
import io
import itertools
import random
from fractions import Fraction

import numpy as np
import pytest
import zstandard
from edge_cases import LONG, ROWS, edge_docs, no_docs, words
from pyspark.sql import functions as F
from tablewright.llm import mixing, packing, url_filter, vector_search, warc
from tablewright.llm.base import Work


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# 4 Packing ---------------------------------------------------------------------------------

def padding(histogram, bounds):
    return sum(count * (min(b for b in bounds if b >= n) - n) for n, count in histogram.items())


@pytest.mark.parametrize("seed", range(12))
def test_bucket_lengths_are_optimal(seed):
    rng = random.Random(seed)
    histogram = {n: rng.randrange(1, 50) for n in rng.sample(range(1, 60), rng.randrange(1, 10))}
    buckets = rng.randrange(1, 5)
    got = packing.bucket_lengths(histogram, buckets)
    lengths = sorted(histogram)
    best = min(padding(histogram, [*some, lengths[-1]])
               for k in range(min(buckets, len(lengths)))
               for some in itertools.combinations(lengths[:-1], k))
    assert len(got) <= buckets and got[-1] == lengths[-1] and padding(histogram, got) == best
    assert packing.bucket_lengths({}, 3) == []


def check_packing(rows, texts, max_tokens, batch_tokens):
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for doc_id, text in texts:
        n = len(words(text))
        own = sorted({(r.piece, r.first_token, r.n_tokens) for r in pieces[doc_id]})
        assert own == [(i, i * max_tokens, min(max_tokens, n - i * max_tokens))
                       for i in range(max(1, -(-n // max_tokens)))]
    batches = {}
    for r in rows:
        if r.n_tokens == 0:
            assert (r.bucket_length, r.batch, r.slot) == (None, None, None)
        else:
            assert r.n_tokens <= r.bucket_length
            batches.setdefault((r.bucket_length, r.batch), []).append(r.slot)
    for length in {b for b, _ in batches}:
        numbers = sorted(k for b, k in batches if b == length)
        room = max(1, batch_tokens // length)
        assert numbers == list(range(len(numbers)))
        for k in numbers:
            slots = sorted(batches[length, k])
            assert slots == list(range(len(slots)))
            assert len(slots) == room or k == numbers[-1]
    histogram = {}
    for r in rows:
        if r.n_tokens:
            histogram[r.n_tokens] = histogram.get(r.n_tokens, 0) + 1
    assert {r.bucket_length for r in rows if r.n_tokens} == set(
        packing.bucket_lengths(histogram, packing.BUCKETS))


def test_packing(documents, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 7)
    texts = [(r.doc_id, r.text) for r in documents.collect()]
    check_packing(packing.packed(documents, max_tokens=300, batch_tokens=2000).collect(), texts,
                  300, 2000)


def test_packing_of_awkward_rows(spark):
    got = packing.packed(edge_docs(spark), max_tokens=512).collect()
    check_packing(got, [(i, t) for i, t, _, _ in ROWS], 512, packing.BATCH_TOKENS)
    assert sum(r.doc_id == 8 for r in got) == 2
    assert packing.packed(no_docs(spark)).count() == 0
    blank = edge_docs(spark, ROWS[1:4])
    assert {r.batch for r in packing.packed(blank).collect()} == {None}


# 5 Mixing ----------------------------------------------------------------------------------

def brute_targets(sizes):
    """Share by weight, stop those above their cap, share again, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) \
        + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        going = [s for s in names if s not in stopped]
        left = total - sum(stopped.values())
        shares = {s: left * weight[s] / sum(weight[t] for t in going) for s in going}
        above = {s: 2.0 * sizes[s] for s in going if shares[s] > 2 * sizes[s]}
        if not above:
            return {**stopped, **shares}
        stopped |= above


def check_mix(rows, texts):
    sizes = {}
    for _, text, source in texts:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    targets = brute_targets(sizes)
    by_id = {}
    for i, text, source in texts:
        by_id.setdefault(i, (len(words(text)), source))
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        n, source = by_id[r.doc_id]
        assert (r.size, r.source_size) == (n, sizes[source])
        assert r.target == pytest.approx(targets[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    for source, target in targets.items():
        assert target - 1.001 <= taken[source] <= target + 0.001
    # All but the document in which the budget ends are taken a whole number of times.
    cut = [by_id[r.doc_id][1] for r in rows if r.size and r.taken % r.size]
    assert len(cut) == len(set(cut))


def test_mix(documents):
    texts = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    got = mixing.mixed(documents).collect()
    check_mix(got, texts)
    again = mixing.mixed(documents.repartition(5)).collect()
    assert {(r.doc_id, r.taken) for r in got} == {(r.doc_id, r.taken) for r in again}


def test_mix_of_uneven_sources(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(60), rng.choice(["a"] * 9 + ["b", "c", "d", None]), "x")
            for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, taken string")
    got = mixing.mixed(docs)
    assert got.columns == ["doc_id", "text", "source", "size", "source_size", "target", "taken"]
    check_mix(got.collect(), [r[:3] for r in rows])


def test_mix_keeps_other_columns(spark):
    names = ["key", "cell", "sk", "start", "budget", "ahead", "rest", "cut", "weight", "words"]
    docs = edge_docs(spark).select("doc_id", "text", "source", *[
        F.lit(n).alias(n) for n in names])
    rows = mixing.mixed(docs).collect()
    assert all(r[n] == n for r in rows for n in names) and len(rows) == len(ROWS)
    out = mixing.repeated(mixing.mixed(docs), docs.columns)
    assert out.columns == docs.columns and {r.cut for r in out.collect()} == {"cut"}


def test_mix_of_awkward_rows(spark):
    got = mixing.mixed(edge_docs(spark)).collect()
    assert len(got) == len(ROWS)
    check_mix(got, [(i, t, s) for i, t, _, s in ROWS])
    assert mixing.mixed(no_docs(spark)).count() == 0
    blank = mixing.mixed(edge_docs(spark, ROWS[1:4])).collect()
    assert [r.taken for r in blank] == [0, 0, 0]


def test_repeated_documents_add_up(spark, documents):
    mix = mixing.mixed(documents)
    out = mixing.repeated(mix, documents.columns)
    assert out.columns == documents.columns
    counted = {}
    for r in out.collect():
        counted[r.doc_id] = counted.get(r.doc_id, 0) + len(words(r.text))
    assert counted == {r.doc_id: r.taken for r in mix.collect() if r.taken}


# 7 URL filter ------------------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "http://", "https://A.Example.NET/en/x", "http://example.net/de/",
    "http://x.example.com/de/1?y=/fr/#z", "http://example.com/fr/", "http://b.org/fr/1",
    "http://borg/fr/", "http://org/fr/", "ftp://net/", "http://net", "http://y.net?/x",
    "http://notnet/", "http://x.net:80/", "see http://q.net/a and http://r.org/fr/",
    "http://ÄB.net/ß", "http://x.net/" + "a/" * 3000, "://x.org/fr/", "http://z.org#/fr/",
]


def brute_rule(url):
    _, found, rest = (url or "").partition("://")
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]) if found else ""
    path = rest[cut:].split("?")[0].split("#")[0] if found else ""
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_rules_match_brute_force(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = [(r.page_id, r.url) for r in pages.select("page_id", "url").collect()]
    rows += [(10_000 + i, u) for i, u in enumerate(URLS)] + [(None, URLS[4]), (3, rows[3][1])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows],
                               "page_id bigint, url string, host string, label string")
    got = url_filter.judged(df).collect()
    assert len(got) == len(rows)
    expected = {}
    for i, u in rows:
        expected.setdefault(i, brute_rule(u))
    for r in got:
        host, path, rule, ruled = expected[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == ruled if ruled else r.verdict in ("allow", "block")


def test_trees_learn_what_the_urls_tell(spark):
    """Long urls full of digits below one suffix are blocked by rule; others like them follow."""
    rng = random.Random(4)

    def url(bad, suffix, i):
        path = "".join(rng.choice("0123456789") for _ in range(40)) if bad else "page"
        return f"http://site{i}.{suffix}/{path}/{i}"
    rows = [(i, url(i % 2, "block.test" if i % 2 else "allow.test", i)) for i in range(400)]
    rows += [(1000 + i, url(i % 2, "other.example", i)) for i in range(100)]
    rules = (("block", "block.test", "/"), ("allow", "allow.test", "/"))
    got = {r.page_id: r for r in url_filter.judged(
        spark.createDataFrame(rows, "page_id bigint, url string"), rules=rules).collect()}
    right = sum(got[1000 + i].verdict == ("block" if i % 2 else "allow") for i in range(100))
    assert right >= 95 and got[1000].rule is None


def test_url_filter_without_labels(spark):
    df = spark.createDataFrame([(1, "http://a.test/"), (2, None)], "page_id bigint, url string")
    assert {r.verdict for r in url_filter.judged(df).collect()} == {"allow"}
    only = df.unionByName(spark.createDataFrame([(3, "http://a.net/")], df.schema))
    assert {r.verdict for r in url_filter.judged(only).collect()} == {"block"}
    assert url_filter.judged(df.where("false")).count() == 0


# 8 Vector search ---------------------------------------------------------------------------

def brute_top(rows, k, every):
    """Every usable row is a candidate, and a query if its id is divisible, of its own."""
    largest = int(np.finfo(float).max)
    whole = [(i, [max(min(int(np.floor(256 * Fraction(x))), largest), -largest) for x in v])
             for i, v in rows if i is not None and v is not None
             and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (q, vector) in enumerate(whole):
        if q % every == 0:
            found = sorted((-min(max(sum(a * b for a, b in zip(vector, v)), -2 ** 63), 2 ** 63 - 1), i)
                           for place, (i, v) in enumerate(whole)
                           if place != at and len(v) == len(vector))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shape", ["normal", "ties", "skewed", "small"])
def test_top_scores_match_brute_force(spark, monkeypatch, shape):
    monkeypatch.setattr(vector_search, "BLOCK", 64)
    rng = np.random.default_rng(6)
    n = 4 if shape == "small" else 300
    m = rng.normal(size=(n, 20))
    if shape == "ties":
        m = rng.integers(-1, 2, size=(n, 20)).astype(float)
    if shape == "skewed":
        m *= rng.pareto(1, size=(n, 1))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    got = vector_search.top_scores(df, query_every=7)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 5, 7)


def test_search_prunes_and_stays_exact():
    rng = np.random.default_rng(1)
    scale = 2.0 ** -np.arange(64)[:, None] * 4000
    columns = np.floor(rng.normal(size=(64, 3000)) * scale)
    queries = np.floor(rng.normal(size=(64, 20)) * scale)
    ids, query_ids = np.arange(3000), np.arange(5000, 5020)
    for j, (_, found, scores) in enumerate(vector_search.search_block(
            query_ids, queries, ids, columns)):
        exact = queries[:, j].astype(np.int64) @ columns.astype(np.int64)
        order = np.lexsort((ids, -exact))[:5]
        assert list(found) == list(order) and list(scores) == list(exact[order])


def test_top_scores_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [3.0, -1.0]), (1, [3.0, -1.0]), (2, None), (3, [nan, 1.0]),
            (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (7, [1.0]), (50, [1.0]), (8, [1e300, 1.0]),
            (None, [9.0, 9.0]), (100, [-0.001, 0.999]), (1, [2.0, 7.0]), (9, [1e308, 1.0]),
            (150, []), (100, [-0.001, 0.999]), (100, [4.0, 0.5])]
    df = spark.createDataFrame([(i, v, "s", 1.0) for i, v in rows],
                               "vec_id bigint, embedding array<double>, score string, rank double")
    got = sorted(tuple(r) for r in vector_search.top_scores(df).collect())
    assert got == brute_top(rows, 5, 50)
    assert (0, 2, 9, 2 ** 63 - 1) in got and (150, 1, 6, 0) in got
    assert vector_search.top_scores(df.where("false")).count() == 0


def test_repeated_rows_are_candidates(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (50, [1.0, 2.0]), (50, [1.0, 2.0])],
                               "vec_id bigint, embedding array<double>")
    one = [(50, 1, 50, 5 * 65536), (50, 2, 1, 2 * 65536), (50, 3, 1, 65536)]
    assert sorted(tuple(r) for r in vector_search.top_scores(df).collect()) == sorted(one * 2)


@pytest.mark.parametrize("carried", [1, 256])
def test_best_rows_are_carried_from_block_to_block(spark, monkeypatch, carried):
    """Few tasks with many blocks each, also where a task may carry one query block only."""
    rng = np.random.default_rng(3)
    rows = [(i % 900, [float(x) for x in v])
            for i, v in enumerate(np.round(rng.normal(size=(1000, 12)) * rng.pareto(1, (1000, 1)), 1))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    monkeypatch.setattr(vector_search, "BLOCK", 16)
    monkeypatch.setattr(vector_search, "CARRIED", carried)
    monkeypatch.setattr(vector_search, "TASK_BLOCKS", 40)
    monkeypatch.setattr(vector_search, "partitions", lambda _: 1)
    got = sorted(tuple(r) for r in vector_search.top_scores(df, query_every=9).collect())
    assert got == brute_top(rows, 5, 9)


# 9 WARC ------------------------------------------------------------------------------------

def brute_warc(rows, least=0):
    keeper, count = {}, {}
    for i, _, html in rows:
        count[html or ""] = count.get(html or "", 0) + 1
        if i is not None:
            keeper[html or ""] = max(i, keeper.get(html or "", i))
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        k = keeper.get(html or "")
        again = count[html or ""] > 1 and k is not None and i != k and len(raw) >= least
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if again else "response", k if again else None))
    return sorted(out, key=repr)


PAGES = [(1, "http://a/", "same"), (2, None, "same"), (3, "http://b/\r\nX: y", "same"),
         (4, "http://ü/", "ünïcode \U0001F389" * 50), (5, "", None), (6, "http://c", ""),
         (None, "http://n", "same"), (None, "http://n", "alone"), (7, "http://d", "dup"),
         (7, "http://d", "dup"), (8, "http://e", LONG), (9, "http://f", "\r\n\r\nWARC/1.1\r\n")]


@pytest.mark.parametrize("least", [0, 5])
def test_archives_of_awkward_rows(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 100)
    df = spark.createDataFrame([(*r, "x") for r in PAGES],
                               "page_id bigint, url string, html string, record_type string")
    got = warc.round_trip(df.repartition(3), least_bytes=least).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_warc(PAGES, least)
    assert warc.round_trip(df.where("false")).count() == 0


def test_archives_of_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    doubled = pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 1_000_000))
    folder, manifest = warc.archived(doubled, Work(spark, "test"))
    got = warc.records(folder, manifest)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_warc(
        [tuple(r) for r in doubled.collect()])


def archive_of(records):
    return b"".join(warc.archive(records))


def test_dictionary_is_read_plain_and_compressed():
    records = [warc.record(i, f"http://h{i}/", f"<html>page {i} of many</html>".encode() * 20,
                           "response", None, "d") for i in range(200)]
    raw = archive_of(records)
    assert raw[:4] == b"\x5d\x2a\x4d\x18"
    assert list(warc.frames(io.BytesIO(raw))) == records
    size = int.from_bytes(raw[4:8], "little")
    packed = zstandard.ZstdCompressor().compress(raw[8:8 + size])
    again = raw[:4] + len(packed).to_bytes(4, "little") + packed + raw[8 + size:]
    assert list(warc.frames(io.BytesIO(again))) == records
    few = archive_of(records[:2])
    assert list(warc.frames(io.BytesIO(few))) == records[:2]
    assert list(warc.frames(io.BytesIO(b""))) == []
    fields = warc.parsed(records[5])
    assert fields["page_id"] == 5 and fields["url"] == "http://h5/"
    assert fields["payload"] == b"<html>page 5 of many</html>" * 20


@pytest.mark.parametrize("spoil", [
    lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"),
    lambda r: r.replace(b"Content-Length: ", b"Content-Length: 1", 1),
    lambda r: r.replace(b"body", b"BODY"),
    lambda r: r[:-2],
    lambda r: r.replace(b"WARC-Date: d\r\n", b""),
    lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: dream"),
    lambda r: r.replace(b"WARC-Date: d", b"WARC-Date: d\r\nWARC-Date: d"),
])
def test_broken_records_are_refused(spoil):
    good = warc.record(1, "http://a/", b"the body", "response", None, "d")
    assert warc.parsed(good)["payload_bytes"] == 8
    with pytest.raises(warc.BadArchive):
        warc.parsed(spoil(good))


def test_broken_archives_are_refused():
    raw = archive_of([warc.record(1, None, b"x" * 1000, "response", None, "d")])
    for bad in (raw[:-3], raw[:20] + b"\0\0\0" + raw[23:], raw + b"junk"):
        with pytest.raises(warc.BadArchive):
            list(warc.frames(io.BytesIO(bad)))


def test_rows_without_id_are_numbered_in_many_tasks(spark, monkeypatch):
    """Their texts spread them over the shards; reruns agree."""
    monkeypatch.setattr(packing, "SHARD_ROWS", 50)
    docs = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"),
                                    F.concat(F.lit("w "), "id").alias("text"))
    got = [sorted((r.batch, r.slot) for r in packing.packed(d, batch_tokens=64).collect())
           for d in (docs, docs.repartition(7))]
    assert got[0] == got[1] == [(i // 32, i % 32) for i in range(2000)]
    order = docs.select(F.pmod(F.xxhash64(F.xxhash64("doc_id", "text"), F.lit(0)), F.lit(40)))
    assert order.distinct().count() == 40
