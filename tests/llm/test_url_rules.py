from itertools import combinations

import pytest
from pyspark.sql import functions as F

from lodestat.llm.url_rules import RULES, host_of, judge_urls, label_pages, mine_rules, path_of, rules_table, teaching_pages, url_tokens

URLS = [
    (1, "https://www.Example.ORG/es/page?x=1#top"), (2, "http://example.org/en/12"), (3, "http://example.org/en/2"), (4, "http://badexample.org/es/"),
    (5, "http://shop.com/de/x"), (6, "http://shop.com/fr/x"), (7, "http://com/de/"), (8, "ftp://site.net/?q"), (9, "no scheme"), (10, None), (11, ""),
    (12, "http://org"), (13, "http://org/"), (None, "http://a.example.org/es/"), (5, "http://shop.com/de/x"), (14, "http://host?com/de/"), (15, "x://y://example.org/es/"),
]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = next((rest[:i] for i, c in enumerate(rest) if c in "/?#"), rest)
    path = next((rest[len(host) : i] for i, c in enumerate(rest) if c in "?#" and i >= len(host)), rest[len(host) :])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, a) for a, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_listed_rules(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").selectExpr("*", "1 AS host", "2 AS rule", "3 AS tokens")
    none = mine_rules(spark.createDataFrame([], "url string, block boolean"))
    got = judge_urls(pages, rules_table(spark, RULES), none).collect()
    want = [(i, *brute(u)) for i, u in URLS]
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=str) == sorted(((i, h, p, r, a or "allow") for i, h, p, r, a in want), key=str)


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(f"http://h{i % 7}.com/{'casino' if i % 3 == 0 else 'news'}/{'win' if i % 2 else 'lose'}/{i}", i % 3 == 0 and i % 2 == 1) for i in range(600)]
    return spark.createDataFrame(rows, "url string, block boolean")


def brute_rules(rows, least, confidence):
    """Every shortest token combination of its rows that reaches the bounds and holds no shorter rule as sure."""
    at = {}
    for row, (tokens, _) in enumerate(rows):
        for n in range(1, len(tokens) + 1):
            for c in combinations(sorted(tokens), n):
                at.setdefault(c, set()).add(row)
    blocked = {c: sum(rows[i][1] for i in held) for c, held in at.items()}
    shortest = {}
    for c, held in at.items():
        shortest[frozenset(held)] = min(len(c), shortest.get(frozenset(held), 99))
    base = sum(b for _, b in rows) / len(rows)
    good = {c: blocked[c] / len(held) for c, held in at.items() if blocked[c] >= least and len(c) == shortest[frozenset(held)]}
    good = {c: x for c, x in good.items() if x >= confidence and x > base}
    return {c: x for c, x in good.items() if not any(set(d) < set(c) and y >= x for d, y in good.items())}, {c: len(h) for c, h in at.items()}


def test_rules_agree_with_counting(labelled):
    mined = mine_rules(labelled, least_support=0.02, least_confidence=0.7).collect()
    rows = [(frozenset(r.t), r.block) for r in labelled.select(url_tokens().alias("t"), "block").collect()]
    want, n = brute_rules(rows, 0.02 * len(rows), 0.7)
    assert {tuple(r.tokens): round(r.confidence, 9) for r in mined} == {c: round(x, 9) for c, x in want.items()} and want
    assert all(n[(r.posted,)] == min(n[(t,)] for t in r.tokens) for r in mined)


@pytest.mark.parametrize("length", [12, 16, 30])
def test_a_long_url_is_one_item_and_takes_no_rule_away(spark, length):
    long = "http://spam.com/" + "/".join(f"s{i}" for i in range(length - 2))
    rows = [(long, True)] * 5 + [(f"http://h{i % 7}.com/a{i}", False) for i in range(50)] + [("http://bad.net/x", True)] * 6
    rules = {tuple(r.tokens): (r.confidence, r.posted) for r in mine_rules(spark.createDataFrame(rows, "url string, block boolean")).collect()}
    whole = tuple(sorted(["h:spam", *(f"p:s{i}" for i in range(length - 2))]))
    assert rules.keys() == {whole, ("h:bad", "h:net", "p:x")} and all(c == 1 and p in t for t, (c, p) in rules.items())


def test_a_very_long_url_and_nulls(spark):
    rows = [("http://a.b/" + "/".join(f"s{i}" for i in range(20_000)), True)] * 5 + [("http://a.b/c", False)] * 20 + [(None, True), (None, None), ("", None)]
    (rule,) = mine_rules(spark.createDataFrame(rows, "url string, block boolean")).collect()
    assert len(rule.tokens) == 20_000 and rule.confidence == 1


def test_listed_verdicts_teach_but_must_hold_on_other_rows_too(spark):
    rows = [(f"http://h{i}.com/de/x{i}", True, True) for i in range(60)] + [(f"http://h{i}.com/fr/{i}", False, True) for i in range(60)]
    frame = lambda more: spark.createDataFrame(rows + more, "url string, block boolean, listed boolean")
    assert [tuple(r.tokens) for r in mine_rules(frame([])).collect()] == [("p:de",)]
    against = frame([(f"http://h{i}.net/de/{i}", i % 4 == 0, False) for i in range(12)])
    assert [tuple(r.tokens) for r in mine_rules(against).collect()] == [("h:com", "p:de")]
    agree = frame([(f"http://h{i}.net/{'de' if i < 30 else 'en'}/{i}", i < 30, False) for i in range(60)])
    assert ("p:de",) in {tuple(r.tokens) for r in mine_rules(agree).collect()}


def test_rules_of_the_tables_hold_on_held_out_pages(spark):
    """Rules mined on one half of the teaching pages, listed rules put aside, block pages of the other half rightly."""
    pages, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("pages", "labels"))
    rows = teaching_pages(pages, labels, rules_table(spark, RULES)).cache()
    half = F.pmod(F.xxhash64("url"), F.lit(2))
    mined, test = mine_rules(rows.where(half == 0)), rows.where(half == 1).select(F.monotonically_increasing_id().alias("page_id"), "url", "block").collect()
    verdicts = judge_urls(spark.createDataFrame(test), rules_table(spark, [("allow", "zz", "/")]), mined).collect()
    decided = {v.page_id: v.verdict for v in verdicts}
    hit = [r.block for r in test if decided[r.page_id] == "block"]
    assert mined.count() > 0 and len(hit) >= 5 and sum(hit) / len(hit) > 0.75 > 2 * sum(r.block for r in test) / len(test)


def test_index_finds_what_all_rules_find(spark, labelled):
    mined = mine_rules(labelled, least_support=0.02, least_confidence=0.7)
    rules = [frozenset(r.tokens) for r in mined.collect()]
    pages = spark.createDataFrame([(i, f"https://x.org/{a}/{b}?c=1") for i, (a, b) in enumerate([("casino", "win"), ("casino", "lose"), ("news", "win"), ("win", "casino")])], "page_id long, url string")
    got = {r.page_id: r.verdict for r in judge_urls(pages, rules_table(spark, [("allow", "zz", "/")]), mined).collect()}
    for r in pages.select("page_id", url_tokens().alias("t")).collect():
        assert got[r.page_id] == ("block" if any(rule <= set(r.t) for rule in rules) else "allow")
    assert got == {0: "block", 1: "allow", 2: "allow", 3: "block"}


def test_tokens_and_parts(spark):
    row = spark.createDataFrame([("http://A.b.com/x/y/x?q=1&r#z",)], "url string").select(url_tokens().alias("t"), host_of().alias("h"), path_of().alias("p")).first()
    assert sorted(row.t) == ["h:a", "h:b", "h:com", "p:x", "p:y", "q:q", "q:r"] and (row.h, row.p) == ("a.b.com", "/x/y/x")


def test_labels_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a/"), (2, "http://b/"), (3, None), (None, "http://c/")], "page_id long, url string")
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (2, 0, None), (3, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, label_pages(pages, labels).collect()), key=str) == [("http://a/", True), ("http://b/", True), (None, False)]
    none = spark.createDataFrame([], "page_id long, url string")
    mined = mine_rules(label_pages(none, labels))
    assert mined.isEmpty() and judge_urls(none, rules_table(spark, RULES), mined).isEmpty()


def test_a_host_of_a_large_table_gets_its_rule(spark):
    """20 pages of 20 000, all blocked, under a base rate of a quarter."""
    rows = spark.range(20_000).selectExpr("id", "if(id < 20, 'bad.net', concat('h', id % 50, '.com')) AS host", "pmod(xxhash64(id), 97) AS p")
    rows = rows.selectExpr("concat('http://', host, '/a', p) AS url", "id < 20 OR pmod(xxhash64(id, 5), 4) = 0 AS block")
    rules = {tuple(r.tokens): r.confidence for r in mine_rules(rows).collect()}
    assert rules == {("h:bad", "h:net"): 1}  # two tokens that stand on the same rows


@pytest.mark.parametrize("n", [100, 1000])
def test_chance_makes_no_rule(spark, n):
    rows = spark.range(n).selectExpr("concat('http://h', id % 40, '.com/', pmod(xxhash64(id), 30), '/', id % 7) AS url", "pmod(xxhash64(id, 9), 4) = 0 AS block")
    assert mine_rules(rows).isEmpty()


def test_rules_beat_the_base_rate_on_held_out_pages(spark):
    rows = spark.range(1200).selectExpr("id", "id % 12 = 0 AS bad", "pmod(xxhash64(id, 3), 20) AS p")
    rows = rows.selectExpr("id", "concat('http://h', id % 30, '.com/', if(bad, 'casino', 'news'), '/', p) AS url", "pmod(xxhash64(id, 1), 10) < if(bad, 9, 2) AS block").cache()
    half = "pmod(xxhash64(id, 2), 2)"
    for fold in (0, 1):
        mined, test = mine_rules(rows.where(f"{half} <> {fold}")), rows.where(f"{half} = {fold}")
        verdicts = {r.page_id: r.verdict for r in judge_urls(test.withColumnRenamed("id", "page_id"), rules_table(spark, [("allow", "zz", "/")]), mined).collect()}
        held = [(verdicts[r.id] == "block", r.block) for r in test.collect()]
        hit = [b for v, b in held if v]
        assert len(hit) > 20 and sum(hit) / len(hit) > 2 * sum(b for _, b in held) / len(held)
