import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.llm.common import id_remainder
from lodestat.llm.katz import K, discounts, narrow, pack_ids, score_documents, unpack_ids, wide

START, END, UNKNOWN = "<s>", "</s>", "<unk>"


class Katz:
    """The model from dictionaries, by its definition."""

    def __init__(self, texts):
        self.uni, self.followers, self.contexts = Counter(), defaultdict(Counter), Counter()
        for text in texts:
            words = tokens(text)
            self.uni.update(words)
            for v, w in zip([START, *words], words, strict=False):
                self.followers[v][w] += 1
                self.contexts[v] += 1
        counts = lambda values: np.bincount([min(c, K + 2) for c in values] or [0], minlength=K + 3)[: K + 2]
        self.d1 = discounts(counts(self.uni.values()))
        self.d2 = discounts(counts([c for f in self.followers.values() for c in f.values()]))
        self.n = sum(self.uni.values())
        self.freed = sum(c - self.cut(c, self.d1) for c in self.uni.values())
        self.left = {}

    def cut(self, c, d):
        return c * d[c - 1] if c <= K else float(c)

    def p1(self, w):
        bottom = self.n if self.freed > 0 else self.n + 1
        return self.cut(self.uni[w], self.d1) / bottom if self.uni[w] else (self.freed or 1) / bottom

    def p2(self, v, w):
        seen = self.followers.get(v)
        if not seen:
            return self.p1(w)
        bottom = self.contexts[v] + (not any(c <= K and self.d2[c - 1] < 1 for c in seen.values()))
        if seen[w]:
            return self.cut(seen[w], self.d2) / bottom
        if v not in self.left:
            left = 1 - sum(self.cut(c, self.d2) for c in seen.values()) / bottom
            self.left[v] = left / (1 - sum(self.p1(x) for x in seen if seen[x]))
        return self.left[v] * self.p1(w)

    def score(self, text):
        words = tokens(text)
        known = {w if self.uni[w] else UNKNOWN for w in words}
        assert known
        return sum(math.log10(self.p2(v, w if self.uni[w] else UNKNOWN)) for v, w in zip([START, *words], words, strict=False))


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + [END]


def check(docs, held, **settings):
    rows = docs.select("doc_id", "text", held.alias("out")).collect()
    model = Katz([r.text for r in rows if not r.out])
    got = score_documents(docs, held, **settings).collect()
    want = defaultdict(list)
    for r in rows:
        words = tokens(r.text)
        base = sum(math.log10((model.uni[w] + 1) / (model.n + 1 * (len(+model.uni) + 1))) for w in words)
        want[str(r.doc_id)].append((bool(r.out), len(words), sum(model.uni[w] > 0 for w in words), model.n, round(base, 6), round(model.score(r.text), 6)))
    have = defaultdict(list)
    for r in got:
        have[str(r.doc_id)].append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)))
    assert have.keys() == want.keys()
    for k, rows_of_id in want.items():
        np.testing.assert_allclose(np.array(sorted(have[k]), dtype=float), np.array(sorted(rows_of_id), dtype=float), atol=2e-6)
    return model


@pytest.fixture(scope="module")
def tiny(spark):
    rng = random.Random(4)
    words = [f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(1500)]
    rows = [(i, " ".join(words[10 * i : 10 * i + 10]) + (" Hot Pair" * 3 if i % 2 else "")) for i in range(150)]
    return spark.createDataFrame([*rows, (200, None), (201, ""), (202, "never seen words"), (203, "Straße É É")], "doc_id long, text string")


@pytest.mark.parametrize("settings", [{}, {"chunk_tokens": 100, "bucket_bytes": 200}])
def test_agrees_with_the_definition(tiny, settings):
    model = check(tiny, id_remainder("doc_id", 7) == 2, **settings)
    for v in [START, "hot", "w1", "w2", "pair", "nowhere"]:
        assert math.isclose(sum(model.p2(v, w) for w in [*(w for w in model.uni if model.uni[w]), UNKNOWN]), 1, abs_tol=1e-9)


def test_on_the_documents(small_docs):
    check(small_docs.where("doc_id < 25"), id_remainder("doc_id", 7) == 2)
    rows = score_documents(small_docs, id_remainder("doc_id", 7) == 2).where("held_out").collect()
    assert rows and all(zlib.crc32(r.doc_id.encode()) % 7 == 2 for r in rows)
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_discounts():
    d = discounts(np.array([0, 1000, 400, 220, 140, 100, 75]))
    assert ((d > 0) & (d < 1)).all() and (np.diff(d) > 0).all()
    assert (discounts(np.array([0, 3, 0, 0, 0, 0, 0])) < 1).all() and len(discounts(np.zeros(7, dtype=int))) == K


def test_odd_and_empty_tables(odd_docs, no_docs):
    check(odd_docs, id_remainder("doc_id", 7) == 2)
    check(odd_docs, F.lit(True))  # nothing to learn from
    assert score_documents(no_docs, F.lit(False)).isEmpty()


class HigherKatz:
    """The model of any order from dictionaries, by the recursive definition."""

    def __init__(self, texts, order):
        self.low = Katz(texts)
        self.followers = {n: defaultdict(Counter) for n in range(2, order + 1)}
        for text in texts:
            path = [START, *tokens(text)]
            for n, seen in self.followers.items():
                for i in range(n - 1, len(path)):
                    seen[tuple(path[i - n + 1 : i])][path[i]] += 1
        counts = lambda values: np.bincount([min(c, K + 2) for c in values] or [0], minlength=K + 3)[: K + 2]
        self.d = {n: discounts(counts([c for f in seen.values() for c in f.values()])) for n, seen in self.followers.items()}

    def p(self, context, w):
        if not context:
            return self.low.p1(w)
        d, seen = self.d[len(context) + 1], self.followers[len(context) + 1].get(context)
        if not seen:
            return self.p(context[1:], w)
        bottom = sum(seen.values()) + (not any(c <= K and d[c - 1] < 1 for c in seen.values()))
        if w in seen:
            return self.low.cut(seen[w], d) / bottom
        left = 1 - sum(self.low.cut(c, d) for c in seen.values()) / bottom
        return left / (1 - sum(self.p(context[1:], x) for x in seen)) * self.p(context[1:], w)

    def score(self, text, order):
        path = [START, *(w if self.low.uni[w] else UNKNOWN for w in tokens(text))]
        return sum(math.log10(self.p(tuple(path[max(0, i - order + 1) : i]), path[i])) for i in range(1, len(path)))


@pytest.mark.parametrize("order", [1, 3, 4])
@pytest.mark.parametrize("settings", [{}, {"chunk_tokens": 100, "bucket_bytes": 200}])
def test_longer_contexts_back_off_order_by_order(tiny, order, settings):
    out = id_remainder("doc_id", 7) == 2
    rows = tiny.select("doc_id", "text", out.alias("out")).collect()
    model = HigherKatz([r.text for r in rows if not r.out], order)
    got = {r.doc_id: r.score for r in score_documents(tiny, out, order=order, **settings).collect()}
    assert all(math.isclose(got[str(r.doc_id)], model.score(r.text, order), abs_tol=2e-6) for r in rows)
    if order > 1:
        words = [*(w for w in model.low.uni if model.low.uni[w]), UNKNOWN]
        contexts = list(model.followers[order])[:5]
        assert all(math.isclose(sum(model.p(c, w) for w in words), 1, abs_tol=1e-9) for c in contexts)


def test_the_query_takes_longer_contexts_than_one_word():
    from lodestat.llm.katz import ORDER

    assert ORDER >= 3


def test_messages_take_few_bytes():
    """Numbers go in the fewest bytes, and the contexts of a bucket by the steps between their places."""
    draw = np.random.default_rng(5)
    for x in (np.array([], np.uint64), np.array([0]), np.array([255, 256, 3]), draw.integers(0, 1 << 63, 50), np.array([2**64 - 1], np.uint64)):
        assert (wide(narrow(x)) == x.astype(np.uint64)).all()
    assert len(narrow(draw.integers(0, 6, 3000) ** 8)) < 3 * 3000
    buckets = 275
    ids = np.cumsum(draw.integers(1, 160, 3000)).astype(np.uint64) * np.uint64(buckets) + np.uint64(7)
    assert (unpack_ids(pack_ids(ids, buckets), buckets) == ids).all() and len(pack_ids(ids, buckets)) < 1.2 * len(ids)
    mixed = draw.integers(0, 1 << 40, 100).astype(np.uint64)  # of many buckets, and not in order
    assert (unpack_ids(pack_ids(mixed, buckets), buckets) == mixed).all()


def test_rounds_leave_no_shuffle_files(spark, tiny):
    from pathlib import Path

    folders = [Path(str(x)) for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    shuffles = lambda: {p.name for f in folders for p in f.rglob("shuffle_*.data")}
    before = shuffles()
    scores = score_documents(tiny, id_remainder("doc_id", 7) == 2, order=3)
    assert shuffles() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert scores.count() == tiny.count()
