import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from lodestat.llm.sharding import digest, shard_documents


def shards_of(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.shard].append(r.slot)
    return out


def check_places(rows, n, shards):
    found = shards_of(rows)
    assert len(rows) == n
    assert all(sorted(slots) == list(range(len(slots))) for slots in found.values())
    counts = [len(found.get(i, [])) for i in range(shards)]
    assert max(counts) - min(counts) <= 1


def test_every_row_gets_one_slot_and_counts_differ_by_one(small_docs):
    rows = digest(shard_documents(small_docs, shards=7, bucket_bytes=20_000)).collect()
    check_places(rows, small_docs.count(), 7)
    texts = {r.doc_id: r.text for r in small_docs.collect()}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "rows", None)


def test_reruns_agree_and_seeds_differ(small_docs):
    place = lambda **s: {r.doc_id: (r.shard, r.slot) for r in digest(shard_documents(small_docs, shards=5, **s)).collect()}
    assert place() == place() != place(seed=18)


def test_shuffle_leaves_no_trace_of_the_order(small_docs):
    rows = digest(shard_documents(small_docs, shards=4)).orderBy("shard", "slot").collect()
    ids = np.array([r.doc_id for r in rows], dtype=float)
    assert abs(np.corrcoef(ids, np.arange(len(ids)))[0, 1]) < 0.25


def test_odd_and_empty_tables(odd_docs, no_docs):
    out = shard_documents(odd_docs, shards=3, bucket_bytes=1000)
    check_places(out.collect(), 17, 3)
    assert out.select("doc.*").exceptAll(odd_docs).isEmpty() and odd_docs.exceptAll(out.select("doc.*")).isEmpty()
    assert shard_documents(no_docs).isEmpty()


def test_one_id_on_all_rows_is_spread(spark):
    docs = spark.range(4000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    out = shard_documents(docs, shards=4, bucket_bytes=4000)
    check_places(out.collect(), 4000, 4)


def test_main_path_has_no_python(spark, small_docs):
    plan = shard_documents(small_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
