"""Every stage against what it stands for, on its own input, and the whole run."""

from collections import Counter

import pytest

import corpus_pipeline
from lodestat.llm.common import written
from test_decontaminate import tokens_of
from test_ngram_join import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, small_docs):
    """The rows before and after each stage."""
    out, docs = {}, small_docs
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, FOLDER), "test-stage")
        out[name] = (docs, after)
        docs = after
    return out


def test_order_and_columns(stages, small_docs):
    assert list(stages) == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "mixing", "sharding"]
    assert all(after.schema.simpleString() == small_docs.schema.simpleString() for name, (_, after) in stages.items() if name != "sharding")


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_language_keeps_texts_in_a_language(stages):
    before, after = stages["language_id"]
    gone = [r.text for r in before.collect() if r.doc_id not in ids(after)]
    assert len(gone) <= 0.02 * before.count() and all(r.text for r in after.collect())


def test_one_of_each_class_stays(stages):
    before, after = stages["ngram_jaccard_join"]
    classes = brute([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, c, _, _ in classes})


def test_leaks_go_and_others_stay(spark, stages):
    before, after = stages["benchmark_decontamination"]
    items = [" ".join(tokens_of(r.text)) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    whole = {r.doc_id for r in before.collect() if any(f" {i} " in f" {' '.join(tokens_of(r.text))} " for i in items)}
    gone = ids(before) - ids(after)
    assert whole and whole <= gone and len(gone - whole) <= 2


def test_mix_repeats_within_limits(stages):
    before, after = stages["mixing"]
    words = Counter()
    for r in after.collect():
        words[r.doc_id] += len(r.text.split())
    sizes = {r.doc_id: len(r.text.split()) for r in before.collect()}
    assert all(n <= 3 * sizes[d] for d, n in words.items())
    assert abs(sum(words.values()) / sum(sizes.values()) - 1) < 0.02


def test_shards_hold_every_row_once(stages):
    before, after = stages["sharding"]
    rows = after.collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in before.collect())
    counts = Counter(r.shard for r in rows)
    assert len({(r.shard, r.slot) for r in rows}) == len(rows) and max(counts.values()) - min(counts.get(i, 0) for i in range(40)) <= 1


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        columns, n = docs.columns, docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, FOLDER), "test-stage")
            assert name == "sharding" or docs.columns == columns
        assert (docs.count() > 0) == (n > 0)


def test_run_is_the_stages_in_turn(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 100
