import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.llm.common import written
from lodestat.llm.fingerprints import (
    Sketcher, containment, decode, distinct_shingles, encode, fingerprint_documents, merge, merge_fingerprints, resemblance, with_next,
)

K = 128


def shingles(text, n=5):
    words = text.lower().encode().split()
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edits(rows):
    """(id, text, edited, next) by the rule, over rows in order of falling id."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = []
    for i, (key, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        cut = len(text) // 3
        out.append((key, text, text[: len(text) - cut] + after[:cut], after))
    return out


@pytest.mark.parametrize("slice_bytes", [32 << 20, 3000])
def test_rows_agree_with_brute_force(small_docs, slice_bytes):
    rows = [(r.doc_id, r.text or "") for r in small_docs.collect()]
    got = {r.doc_id: r for r in fingerprint_documents(small_docs, slice_bytes=slice_bytes).collect()}
    assert len(got) == len(rows)
    sketcher = Sketcher()
    worst = []
    for key, text, edited, after in edits(rows):
        r = got[key]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (encode(sketcher.sketch(text)), encode(sketcher.sketch(edited)))
        worst += [abs(r.near_edited - jaccard(text, edited)), abs(r.near_next - jaccard(text, after))]
    assert max(worst) < 0.2 and np.mean(worst) < 0.03


def test_estimates():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in rng.integers(0, 5000, 6000)]
    a, b = " ".join(words[:4000]), " ".join(words[2000:])
    s = Sketcher()
    x, y = s.sketch(a), s.sketch(b)
    assert abs(resemblance(x, y, K) - jaccard(a, b)) < 0.13
    assert abs(containment(x, y, K) - len(shingles(a) & shingles(b)) / len(shingles(a))) < 0.15
    assert abs(distinct_shingles(x, K) / len(shingles(a)) - 1) < 0.3
    assert (merge(s.sketch(" ".join(words[:3000])), s.sketch(" ".join(words[2996:4000])), K) == x).all()
    assert (decode(encode(x)) == x).all() and len(decode("")) == 0
    few = s.sketch("only six words are in here")
    assert distinct_shingles(few, K) == 2 and resemblance(few, few, K) == 1 and resemblance(few, s.sketch(""), K) == 0


def test_merging_parts_equals_the_whole(spark):
    words = [f"w{i % 900}x{i}" for i in range(3000)]
    parts = [(g, encode(Sketcher().sketch(" ".join(words[i : i + 304])))) for i in range(0, 3000, 300) for g in ("a", None)] + [("a", None)]
    got = merge_fingerprints(spark.createDataFrame(parts, "g string, fingerprint string").repartition(4), "g").collect()
    whole = encode(Sketcher().sketch(" ".join(words)))
    assert sorted((r.g, r.fingerprint) for r in got if r.g) == [("a", whole)] and len(got) == 2
    assert all(r.fingerprint == whole for r in got)


def test_odd_tables(spark, odd_docs, no_docs):
    rows = fingerprint_documents(odd_docs).collect()
    assert len(rows) == 17
    ordered = odd_docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    ordered = ordered.orderBy(F.col("doc_id").desc_nulls_last(), "h", "text").collect()
    want = []
    for i, r in enumerate(ordered):
        after, cut = ordered[(i + 1) % len(ordered)].text, len(r.text) // 3
        want.append((r.doc_id, len(r.text), hashlib.sha256((r.text[: len(r.text) - cut] + after[:cut]).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in rows), key=str) == sorted(want, key=str)
    by_text = {}
    for r in rows:
        assert by_text.setdefault((r.n_chars, r.fingerprint), r.fingerprint) == r.fingerprint
    assert fingerprint_documents(no_docs).isEmpty()
    alone = fingerprint_documents(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and alone.near_next == 1


def test_an_id_on_most_rows_is_cut(spark):
    rows = [(i if i % 10 < 2 else (None if i % 10 < 5 else 2**60 + 1), f"text {i} " + "and more of it " * (i % 7)) for i in range(1000)]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string"), "hot-id")
    sizes = [r["n"] for r in with_next(docs, slice_bytes=2000).where("own").groupBy("slice").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 1000 and max(sizes) < 100
    ordered = docs.orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text").collect()
    want = []
    for i, r in enumerate(ordered):
        after, cut = ordered[(i + 1) % len(ordered)].text, len(r.text) // 3
        want.append((r.doc_id, len(r.text), hashlib.sha256((r.text[: len(r.text) - cut] + after[:cut]).encode()).hexdigest()))
    got = fingerprint_documents(docs, slice_bytes=2000).select("doc_id", "n_chars", "edited_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
