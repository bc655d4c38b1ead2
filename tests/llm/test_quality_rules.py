import math
import re
from collections import Counter

from pyspark.sql import functions as F

from lodestat.llm import quality_rules as q

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_statistics(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_statistics_against_brute_force(spark, small_docs, odd_docs, no_docs):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    extra = [
        (1, "a b a b a b a"),
        (2, "x x x"),
        (3, "one two three one two three"),
        (4, " \x0b\x0c leading and trailing \r\n\n \n\t"),
        (5, "word joined by a space that isn't one; word joined by a space that isn't one"),
        (6, "\U0001f426 \U0001f426\U0001f426 #\U0001f426\n#\n#\n # \n"),
        (7, "same " * 5000),
        (8, "\x1c\x85 counted as words \x1c\x85 counted as words"),
    ]
    for docs in (small_docs, odd_docs, no_docs, spark.createDataFrame(extra, "doc_id long, text string")):
        texts = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str)
        expected = sorted(((i, *plain_statistics(t)) for i, t in texts), key=str)
        found = q.measured(docs).select("doc_id", *columns, "base_failed").collect()
        assert sorted((tuple(r[:-1]) for r in found), key=str) == expected
        for r in found:
            assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])


def plain_ladder(x):
    unit = 10 ** max(0, len(str(x)) - 2)
    return x - x % unit


def test_ladder_keeps_thresholds(spark):
    numbers = [*range(1200), 9_999, 10_000, 99_999, 100_000, 123_456_789, 999_999_999_999, 10**15, 10**15 - 1]
    rows = spark.createDataFrame([(x,) for x in numbers], "x long").select("x", q.ladder(F.col("x")).alias("l")).collect()
    assert all(r["l"] == plain_ladder(r["x"]) for r in rows)


def plain_best(rows):
    """(gain, condition) of the best threshold over rows of (features, bad, good)."""
    bad, good = sum(r[1] for r in rows), sum(r[2] for r in rows)
    found = None
    for f in sorted(q.FEATURES):
        for at_least in (True, False):
            for value in sorted({r[0][f] for r in rows}):
                p, n = (sum(r[k] for r in rows if (r[0][f] >= value) == at_least) for k in (1, 2))
                gain = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good))) if p else 0
                if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                    found = gain, q.Condition(f, at_least, value)
    return found[1] if found else None


def random_cells(spark, n=400, seed=3):
    import random

    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        values = {f: plain_ladder(draw.randrange(30)) for f in q.FEATURES}
        bad = (values["symbols_per_1000_chars"] >= 20 and values["words"] < 15) or values["digits_per_1000_chars"] >= 26
        bad = bad != (draw.random() < 0.03)
        rows.append((values, int(bad), int(not bad), draw.randrange(3) == 0))
    schema = ", ".join(f"{f} long" for f in q.FEATURES) + ", n_bad long, n_good long, pruning boolean"
    return rows, spark.createDataFrame([(*v.values(), b, g, p) for v, b, g, p in rows], schema)


def plain_rules(rows, most_conditions=4, least_precision=0.75):
    met = lambda values, rule: all((values[c.feature] >= c.threshold) == c.at_least for c in rule)
    rules = []
    while True:
        rest = [r for r in rows if not any(met(r[0], rule) for rule in rules)]
        rule = ()
        while len(rule) < most_conditions:
            found = plain_best([r for r in rest if not r[3] and met(r[0], rule)])
            if found is None or found in rule:
                break
            rule = (*rule, found)
        if not rule:
            return rules
        counts = [[sum(r[k] for r in rest if r[3] and met(r[0], rule[:length])) for k in (1, 2)] for length in range(1, len(rule) + 1)]
        worth = [(b - g) / max(1, b + g) for b, g in counts]
        best = worth.index(max(worth))
        if (counts[best][0] + 1) / (sum(counts[best]) + 2) < least_precision:
            return rules
        rules.append(rule[: best + 1])


def test_learning_against_brute_force(spark):
    rows, counts = random_cells(spark)
    rules = q.learn_rules(counts)
    assert rules == plain_rules(rows)
    assert {c.feature for rule in rules for c in rule} >= {"symbols_per_1000_chars", "digits_per_1000_chars"}


def test_noise_teaches_no_rule(spark):
    rows, counts = random_cells(spark)
    noise = counts.withColumn("n_bad", (F.xxhash64(*q.FEATURES) % 5 == 0).cast("long")).withColumn("n_good", 1 - F.col("n_bad"))
    assert q.learn_rules(noise) == []


def test_order_of_rules_and_their_words(spark):
    rules = [(q.Condition("words", True, 10), q.Condition("digits_per_1000_chars", False, 5)), (q.Condition("words", False, 100),)]
    rows = spark.createDataFrame([(1, 20, 0), (2, 20, 9), (3, 200, 9), (4, 5, 0)], "id long, words long, digits_per_1000_chars long")
    found = {r["id"]: r["rule"] for r in rows.withColumn("rule", q.decision(rules)).collect()}
    assert found == {1: "words >= 10 AND digits_per_1000_chars < 5", 2: "words < 100", 3: None, 4: "words < 100"}


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    teach = F.col("doc_id") % 2 == 0
    rows, rules = q.judge(docs, labels.where(teach))
    assert rules
    told = rows.join(q.quality_labels(labels.where(~teach)), F.col("doc_id") == F.col("label_id")).where("not base_failed")
    counts = {(r["bad"], r["kept"]): r["count"] for r in told.groupBy("bad", "kept").count().collect()}
    clean_kept, clean_lost = counts.get((False, True), 0), counts.get((False, False), 0)
    assert clean_lost <= 0.02 * (clean_kept + clean_lost)
    assert counts.get((True, False), 0) >= 0.9 * (counts.get((True, False), 0) + counts.get((True, True), 0))


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (2, None, None), (None, 0, 1), (8, 0, 0), (8, 0, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    rows, rules = q.judge(odd_docs, labels)
    assert rules == [] and rows.count() == odd_docs.count()
    assert all(r["kept"] == (not r["base_failed"]) for r in rows.collect())
    assert {r["label_id"]: r["bad"] for r in q.quality_labels(labels).collect()} == {1: False, 8: True, 99: True}
    none = labels.limit(0)
    assert q.judge(odd_docs, none)[1] == []
    rows, rules = q.judge(no_docs, labels)
    assert rows.count() == 0 and rules == []


def test_native_plan(spark):
    plan = q.op11_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
