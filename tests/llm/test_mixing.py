import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lodestat.llm.common import WORD
from lodestat.llm.mixing import draw_key, mix, mixed_rows, source_targets, weighted, word_count


def brute_targets(sizes, weights=(5, 2, 1), ceiling=3.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out, free = sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(out.values())
        share = left / sum(w[s] for s in free)
        over = {s for s in free if share * w[s] >= ceiling * sizes[s]}
        if not over:
            return out | {s: share * w[s] for s in free}
        out |= {s: ceiling * sizes[s] for s in over}
        free -= over
    return out


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 1000, "c": 500, None: 3, "é": 0, "zz": 70}, {None: 5}])
def test_targets_by_water_filling(spark, sizes):
    table = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in source_targets(table).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in want)


def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")


def test_takes_reach_targets_by_smallest_keys(spark, small_docs):
    rows = mix(weighted(small_docs, labels(spark))).withColumn("draw", draw_key("doc_id", F.coalesce("weight", F.lit(1.0)), 7)).collect()
    texts = {r.doc_id: r.text for r in small_docs.collect()}
    by_source = defaultdict(list)
    for r in rows:
        assert r.size == len(re.findall(WORD, texts[r.doc_id]))
        by_source[r.source].append(r)
    want = brute_targets({s: sum(r.size for r in own) for s, own in by_source.items()})
    for s, own in by_source.items():
        left = math.floor(want[s] + 1e-9) - own[0].epochs * own[0].source_size
        for r in sorted(own, key=lambda r: r.draw):
            assert r.part == max(0, min(r.size, left)), (s, r)
            left -= r.part
            assert r.epochs * r.size + r.part <= 3 * r.size
        assert left <= 0


def test_reruns_agree_however_rows_are_dealt(spark, small_docs):
    take = lambda d: sorted((r.doc_id, r.epochs, r.part) for r in mix(weighted(d, labels(spark))).collect())
    assert take(small_docs) == take(small_docs.repartition(13))


def test_better_documents_are_drawn_more_often(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'s' AS source", "10L AS size", "IF(id % 2 = 0, 4.0D, 1.0D) AS weight")
    other = spark.range(4000, 4100).selectExpr("id AS doc_id", "'t' AS source", "900L AS size", "1.0D AS weight")
    rows = mix(docs.unionByName(other), weights=(1, 5)).where("source = 's' AND part > 0").collect()
    good = sum(r.doc_id % 2 == 0 for r in rows)
    assert rows[0].epochs == 0 and good > 1.8 * (len(rows) - good)


def test_rows_of_the_mix(spark, small_docs):
    plan = {r.doc_id: r for r in mix(weighted(small_docs, labels(spark))).collect()}
    got = mixed_rows(small_docs, labels(spark))
    assert got.columns == small_docs.columns
    copies = defaultdict(int)
    for r in got.collect():
        copies[r.doc_id] += len(re.findall(WORD, r.text))
        assert r.n_chars == len(r.text)
    assert all(copies[d] == r.epochs * r.size + r.part for d, r in plan.items())


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    rows = mix(weighted(odd_docs, labels(spark))).collect()
    assert len(rows) == 17 and {r.source for r in rows} == {"s1", "s2", "s3", "é", None}
    assert mixed_rows(odd_docs, labels(spark)).columns == odd_docs.columns
    assert mixed_rows(odd_docs, labels(spark)).count() > 0
    assert mixed_rows(no_docs, labels(spark)).isEmpty()
    assert odd_docs.select(word_count().alias("n")).agg(F.min("n")).first()[0] == 0


def test_whole_rows_come_near_the_target(spark, small_docs):
    texts = {(r.doc_id, r.text, r.n_chars) for r in small_docs.collect()}
    taken = defaultdict(int)
    for r in mixed_rows(small_docs, labels(spark), whole=True).collect():
        assert (r.doc_id, r.text, r.n_chars) in texts
        taken[r.source] += len(re.findall(WORD, r.text))
    sizes, longest = defaultdict(int), defaultdict(int)
    for r in small_docs.collect():
        n = len(re.findall(WORD, r.text))
        sizes[r.source], longest[r.source] = sizes[r.source] + n, max(longest[r.source], n)
    want = brute_targets(sizes)
    assert all(abs(taken[s] - want[s]) <= longest[s] + 1 for s in want)


def test_pipeline_stage_ships_whole_rows(spark):
    from corpus_pipeline import mix_sources

    docs = spark.range(300).selectExpr("id AS doc_id", "concat('one two\nthree four\nfive six ', id) AS text", "'en' AS lang", "concat('s', 1000 + id) AS source", "30L AS n_chars")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = mix_sources(spark, docs, "/root/testdata/sf0.001").collect()
    assert all(r.text == texts[r.doc_id] and r.n_chars == 30 for r in rows)
    assert abs(len(rows) - 300) < 30  # sources of one row each: on average at the target


def test_rows_without_words_go_by_their_draw_key(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "IF(id % 2 = 0, 'a b c d', '') AS text", "'a' AS source")
    docs = docs.unionByName(spark.range(2000, 2100).selectExpr("id AS doc_id", "repeat('w ', 400) AS text", "'b' AS source"))
    docs = docs.unionByName(spark.range(3000, 3003).selectExpr("id AS doc_id", "'' AS text", "'c' AS source"))
    rows = mixed_rows(docs, labels(spark), weights=(1, 19, 1), whole=True)
    n = {(r.source, r.text == ""): r["count"] for r in rows.groupBy("source", F.col("text").eqNullSafe("").alias("e"), "text").count().collect()}
    assert 0 < n["a", False] < 1000 and 0.7 * n["a", False] < n["a", True] < 1.4 * n["a", False] and n["c", True] == 3
