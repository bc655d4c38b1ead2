import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lodestat.llm import prefix_trie as t

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain_trie(rows):
    """All nodes by walking every rebuilt conversation."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            text = text or ""
            own[conv].append((turn is not None, turn or 0, role or "", hashlib.sha256(text.encode()).digest(), text))
    own = {c: [(role, text) for *_, role, _, text in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:])
    members = defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
    inside = defaultdict(list)
    for node in members:
        for d in range(len(node) + 1):
            inside[node[:d]].append(node)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    saved = {node: (len(m) - 1) * len(node[-1][1].encode()) if node else 0 for node, m in members.items()}
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if built[c] == node)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(m), len(node), parent, len(m), children[node], sum(children[x] == 0 for x in inside[node]), sum(saved[x] for x in inside[node]), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def found(spark, rows, tmp_path, extra=()):
    table = spark.createDataFrame(rows, SCHEMA)
    table.withColumns({c: F.lit(1) for c in extra}).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    out = t.op12_prefix_trie(spark, str(tmp_path))
    assert dict(out.dtypes) == {c: "string" if c == "ends_sha256" else "bigint" for c in COLUMNS}
    return sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=lambda r: r[:2])


def odd_rows():
    draw = random.Random(4)
    rows = []
    for c in [*range(-7, 40), 10**12, 10**12 + 3]:
        for turn in range(draw.randrange(1, 12)):
            rows.append((c, turn, draw.choice(["user", "assistant"]), draw.choice(["a", "b", "é" * 50])))
    rows += [(45, None, None, None), (45, 1, "", ""), (45, 1, "user", None), (45, 1, "user", None), (45, 1, "a", "z"), (45, 1, "a", "y")]
    rows += [(None, 0, "user", "nobody's"), (52, 0, "user", "only a turn"), (53, None, "user", "x"), (53, None, "user", "x")]
    rows += [(60, i, "user", f"turn {i % 7}") for i in range(700)]
    return rows + [(61, i, "user", f"turn {i % 7}") for i in range(600)]


def test_trie_against_brute_force(spark, tmp_path):
    rows = odd_rows()
    extra = ["node", "arc", "rank", "id", "n", "pos", "bytes", "_slice", "depth", "parent", "k1", "one"]
    assert found(spark, rows, tmp_path, extra) == plain_trie(rows)


def test_many_rounds_and_hot_groups(spark, tmp_path, monkeypatch):
    """A third of the conversations are equal, a third share the first turn only; the tour is ranked by mating all the way."""
    monkeypatch.setattr(t, "CHUNK", 16)
    ranked = t.list_rank
    monkeypatch.setattr(t, "list_rank", lambda links: ranked(links, most_short=4))
    rows = [(c, i, "user", f"same {i}") for c in range(0, 200, 5) for i in range(3)]
    rows += [(c, i, "user", "same 0" if i == 0 else f"{c} {i}") for c in range(1, 200, 5) for i in range(3)]
    rows += [(c, 0, None, f"own {c}") for c in range(1000, 1040)]
    assert found(spark, rows, tmp_path) == plain_trie(rows)


def test_empty_table(spark, tmp_path):
    assert found(spark, [], tmp_path) == []


@pytest.mark.parametrize("n", [0, 1, 2, 3, 500])
def test_list_rank(spark, n):
    ids = random.Random(n).sample(range(10 * n), n)
    links = spark.createDataFrame(list(zip(ids, [*ids[1:], None])) if n else [], "id long, next long")
    for most_short in (1, 7, 1000):
        ranks = {r["id"]: r["rank"] for r in t.list_rank(links, most_short=most_short).collect()}
        assert ranks == {x: i for i, x in enumerate(ids)}


@pytest.mark.parametrize("most_short", [1, 3])
def test_a_ring_is_no_list(spark, most_short):
    with pytest.raises(Exception, match="form one list"):
        t.list_rank(spark.createDataFrame([(0, 1), (1, 2), (2, 0)], "id long, next long"), most_short=most_short, most_rounds=1)
