"""Each stage of the pipeline against a plain form of its decision, on its own input."""

import os
import shutil
import subprocess
import sys

import corpus_pipeline
import pytest
from edge_cases import ROWS, edge_docs, groups, no_docs, words
from pyspark.sql import functions as F
from tablewright.llm import language, secrets
from tablewright.llm.base import Work
from test_data_operators import check_packing


@pytest.fixture(scope="module")
def kept(spark, sf_dir):
    """What each stage reads and, last, what the pipeline returns."""
    work = Work(spark, "stages")
    frames = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(work.stored(stage(spark, frames[-1], sf_dir), name))
    return frames


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_dup", "secrets", "mixing", "packing"]


def test_columns_stay(kept):
    for frame in kept[1:5]:
        assert frame.dtypes == kept[0].dtypes


def test_language_keeps_clean_documents(kept):
    model = language.learned(kept[0])
    expected = set()
    for r in kept[0].collect():
        predicted, score = model.predict(r.text)
        if predicted != "und" and score >= corpus_pipeline.LEAST_CONFIDENCE:
            expected.add(r.doc_id)
    got = {r.doc_id for r in kept[1].collect()}
    assert got == expected and len(got) >= 0.98 * kept[0].count()


def test_language_without_labels_keeps_what_has_letters(spark, kept):
    docs = kept[0].limit(20).withColumn("lang", F.lit(None).cast("string"))
    blank = docs.limit(1).withColumn("text", F.lit("12 - 34"))
    none = docs.limit(1).withColumn("text", F.lit(None).cast("string"))
    got = corpus_pipeline.in_some_language(spark, docs.union(blank).union(none), "")
    assert got.dtypes == docs.dtypes
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))


def test_one_of_each_group_stays(kept):
    texts = [(r.doc_id, r.text) for r in kept[1].collect()]
    roots = groups(texts, 5)
    assert sorted(r.doc_id for r in kept[2].collect()) == sorted(set(roots.values()))


def test_secrets_are_masked(kept):
    before = {r.doc_id: r for r in kept[2].collect()}
    after = {r.doc_id: r for r in kept[3].collect()}
    assert before.keys() == after.keys()
    changed = 0
    for i, r in after.items():
        assert r.text == secrets.masked_text(before[i].text) and r.n_chars == len(r.text)
        changed += r.text != before[i].text
    assert changed


def test_mix_reads_sources_up_to_their_targets(kept):
    from test_data_operators import brute_targets
    before = {r.doc_id: r for r in kept[3].collect()}
    sizes, taken = {}, {}
    for r in before.values():
        sizes[r.source] = sizes.get(r.source, 0) + len(words(r.text))
    for r in kept[4].collect():
        taken[r.source] = taken.get(r.source, 0) + len(words(r.text))
        assert r.n_chars == len(r.text)
        assert r.text == before[r.doc_id].text or words(r.text) == words(
            before[r.doc_id].text)[:len(words(r.text))]
    for source, target in brute_targets(sizes).items():
        assert abs(taken.get(source, 0) - target) < 1.001


def test_everything_is_packed(kept):
    rows = kept[5].collect()
    texts = {r.doc_id: r.text for r in kept[4].collect()}
    total = sum(len(words(r.text)) for r in kept[4].collect())
    assert sum(r.n_tokens for r in rows) == total
    assert {r.doc_id for r in rows} == texts.keys()
    single = kept[4].dropDuplicates(["doc_id"])
    check_packing(corpus_pipeline.batches(None, single, "").collect(),
                  [(r.doc_id, r.text) for r in single.collect()], 2048, 16384)


def test_run_equals_its_stages(spark, sf_dir, kept):
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, kept[5].collect()))


def test_awkward_rows_pass_through(spark):
    for rows in (ROWS, []):
        docs = edge_docs(spark, rows) if rows else no_docs(spark)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "")
            if name != "packing":
                assert docs.columns == edge_docs(spark, []).columns
        assert (docs.count() > 0) == bool(rows)


def test_the_rest_works_without_this_package(tmp_path):
    """A copy without the operators and the pipeline still imports and lists its queries."""
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(
        ".git", "llm", "corpus_pipeline.py", "__pycache__", "*.pyc"))
    script = ("import __spark_entry__ as e; q = e.queries(); "
              "assert 'pipeline' not in q and not [n for n in q if n.startswith('op')]; "
              "assert set(e.oracle_sql()) <= set(q); print(len(q))")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=copy, env=env, text=True,
                          capture_output=True, timeout=120)
    assert int(done.stdout) > 100, done.stderr[-2000:]
