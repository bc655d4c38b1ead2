import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodestat.llm.ngram_join import components, jaccard_classes, runs_for, star_classes


def shingles(text, n=5):
    words = (text or "").lower().encode().split()
    n = min(n, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def brute(rows):
    """(id, text) -> id of its class, links to other sets, rows with its set."""
    sets = defaultdict(list)
    for doc, text in rows:
        sets[shingles(text)].append(doc)
    keys, root, links = list(sets), {s: s for s in sets}, Counter()

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    holders = defaultdict(list)
    for i, s in enumerate(keys):
        for j, k in Counter(j for x in s for j in holders[x]).items():
            if 5 * k >= 4 * len(s | keys[j]):
                links[s] += 1
                links[keys[j]] += 1
                root[find(s)] = find(keys[j])
        for x in s:
            holders[x].append(i)
    members = defaultdict(list)
    for s in keys:
        members[find(s)] += [d for d in sets[s] if d is not None]
    return sorted(((doc, min(members[find(s)], default=None), links[s], len(sets[s])) for doc, text in rows for s in [shingles(text)]), key=str)


def check(docs, **settings):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = jaccard_classes(docs, **settings).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in got), key=str) == brute(rows)
    return got


def test_agrees_with_brute_force(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


@pytest.fixture(scope="module")
def near_copies(spark):
    """A large group of near copies of one text, whose edits make some pairs alike and some not."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(3000)}" for _ in range(150)]
    rows = []
    for i in range(260):
        words = base[:]
        for _ in range(rng.randrange(7)):
            words[rng.randrange(150)] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base[:40] + [f"y{rng.randrange(10_000)}" for _ in range(200)])) for i in range(100)]  # they share a passage
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_a_large_group(near_copies):
    got = check(near_copies)
    assert max(Counter(r.class_id for r in got).values()) > 100


def test_a_group_above_the_leaf_size_keeps_its_classes(near_copies):
    """Checked leaf by leaf, links may number fewer than all, but classes hold."""
    rows = {r.doc_id: r for r in jaccard_classes(near_copies, most=60).collect()}
    for doc, cls, links, _ in brute([(r.doc_id, r.text) for r in near_copies.collect()]):
        assert rows[doc].class_id == cls and (rows[doc].n_links > 0) == (links > 0) and rows[doc].n_links <= links


def test_odd_and_empty_tables(odd_docs, no_docs):
    check(odd_docs)
    assert jaccard_classes(no_docs).isEmpty()


def test_helpers(spark):
    label = components(7, np.array([1, 5, 3]), np.array([2, 6, 2]))
    assert label.tolist() == [0, 1, 1, 1, 4, 5, 5]
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (102, 101)]
    got = {r.rep: r.root for r in star_classes(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(2, 61)} | {101: 100, 102: 100}
    assert runs_for(0.999, 0.8, 1) < runs_for(0.999, 0.8, 3) < 40
