import random

from lodestat.llm.decontaminate import Items, find_leaks, tile, tokens_of


def brute_tiles(doc, item, least):
    """Greedy string tiling as published: scan all pairs of unmarked places for the longest match, mark, repeat."""
    marked_doc, marked_item, out = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                k = 0
                while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and i + k not in marked_doc and j + k not in marked_item:
                    k += 1
                if k > best[2]:
                    best = (i, j, k)
        if best[2] < least:
            return out
        i, j, k = best
        marked_doc.update(range(i, i + k))
        marked_item.update(range(j, j + k))
        out.append(best)


def test_tiling_agrees_with_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        item = [rng.choice("abcdefgh") for _ in range(30)]
        pieces = [item[a : a + rng.randint(3, 12)] for a in (rng.randrange(25) for _ in range(4))]
        doc = [w for p in pieces for w in [*p, rng.choice("xyz")]]
        starts = [(i, j) for i in range(len(doc) - 2) for j in range(len(item) - 2) if doc[i : i + 3] == item[j : j + 3]]
        got, want = tile(doc, item, starts, 3), brute_tiles(doc, item, 3)
        assert all(doc[i : i + n] == item[j : j + n] for i, j, n in got)
        for side in (0, 1):
            used = [x for t in got for x in range(t[side], t[side] + t[2])]
            assert len(used) == len(set(used))
        # ties may fall either way; the longest match and the total covered must not fall behind
        assert (max((t[2] for t in got), default=0)) == max((t[2] for t in want), default=0)
        assert sum(t[2] for t in got) >= 0.9 * sum(t[2] for t in want)


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def test_reordered_passages_are_caught_and_mentions_are_not():
    words = ITEM.split()
    turned = " ".join(words[10:]) + " some words between " + " ".join(words[:10])
    items = Items([(7, ITEM), (8, "too short item")], 5)
    hit = items.judge(turned.upper().replace("MU NU", "Mu, nu!"), 0.5)
    assert [h["item_id"] for h in hit] == [7] and hit[0]["coverage"] == 1 and len(hit[0]["tiles"]) == 2
    assert items.judge(" ".join(words[:9]), 0.5) == [] and items.judge(None, 0.5) == [] and items.judge("", 0.5) == []
    assert items.judge(" ".join(reversed(words)), 0.5) == []


def test_items_of_any_length_are_found_where_they_stand_whole():
    items = Items([(n, " ".join(ITEM.split()[:n])) for n in range(1, 8)] + [(20, ""), (21, "?!"), (22, "nu xi omicron")], 5)
    words = ITEM.split()
    for n in range(1, 8):
        text = "before " + " ".join(words[:n]) + " after"
        hits = {h["item_id"]: h["coverage"] for h in items.judge(text, 0.5)}
        assert {i for i, c in hits.items() if c == 1} == set(range(1, n + 1))
        assert all(i <= n or (n >= 5 and c >= 0.5) for i, c in hits.items())
    assert [h["item_id"] for h in items.judge("pi nu XI, omicron", 0.5)] == [22] and items.judge("xi nu omicron", 0.5) == []


def test_scripts_without_spaces():
    sentence = "今天天气很好我们去公园散步吧"
    items = Items([(1, sentence), (2, "สวัสดีครับ"), (3, "ひらがな")], 5)
    assert tokens_of("Ab今天 c_1é天x") == ["ab", "今", "天", "c_1é", "天", "x"] and tokens_of("don't stop") == ["don", "t", "stop"]
    assert [(h["item_id"], h["coverage"]) for h in items.judge(sentence, 0.5)] == [(1, 1.0)]
    assert [h["item_id"] for h in items.judge("他说" + sentence + "然后走了", 0.5)] == [1]
    turned = items.judge(sentence[7:] + "。" + sentence[:7], 0.5)
    assert [(h["item_id"], len(h["tiles"])) for h in turned] == [(1, 2)]
    assert items.judge("今天很好", 0.5) == [] and [h["item_id"] for h in items.judge("abcひらがなdef", 0.5)] == [3]


def test_agrees_with_containment_on_the_tables(spark, small_docs):
    """The planted passages are whole items: a document leaks an item if its tokens hold the item's."""
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = {r.doc_id: f" {' '.join(tokens_of(r.text))} " for r in small_docs.collect()}
    items = {r.item_id: " ".join(tokens_of(r.text)) for r in benchmark.collect()}
    whole = {(d, i) for d, text in docs.items() for i, item in items.items() if f" {item} " in text}
    for block_chars in (32 << 20, 1000):  # one block, and several
        got = {(r.doc_id, leak.item_id): leak.coverage for r in find_leaks(small_docs, benchmark, block_chars=block_chars).collect() for leak in r.leaks}
        assert whole and whole <= got.keys() and all(got[x] == 1 for x in whole)
        assert all(got[x] >= 0.5 for x in got) and len(got) <= len(whole) + 2


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog while rain falls"), (1, None), (None, "un deux trois quatre cinq six sept huit"), (2, "")], "item_id long, text string")
    got = find_leaks(odd_docs, items, into="found")
    rows = got.collect()
    assert len(rows) == 17 and got.columns == [*odd_docs.columns, "found"]
    assert sorted(r.doc_id for r in rows if any(x.item_id == 1 for x in r.found)) == [1, 2, 3]
    assert [r.doc_id for r in rows if any(x.item_id is None for x in r.found)] == [10, 10]
    assert all(r.found == [] for r in find_leaks(odd_docs, items.limit(0), into="found").collect())
    assert find_leaks(no_docs, items).isEmpty()
