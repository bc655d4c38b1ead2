"""Quality rules: an ordered list of threshold conjunctions, learned by sequential covering."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestat.llm.common import BLANKS, text_or_empty, written

# fixed values: what a blank, a symbol and a closing mark is
BLANK = r"[\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
MARK = r"[.,;:!?]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words in windows of three words that stand twice or more in ``words``; windows are told apart by 64-bit hashes."""
    window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    hashes = F.when(F.size(words) < 3, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.size(words) - 3), window))

    def places(by_hash: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(by_hash, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(by_hash, j + 1)["h"] == x["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(by_hash, same), lambda x: x["at"]))

    def covered(at: Column) -> Column:
        fresh = F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - x, F.lit(3))))
        return F.aggregate(fresh, F.lit(0), lambda total, x: total + x)

    def count(h: Column) -> Column:
        by_hash = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(by_hash, lambda s: let(places(s), covered)))

    return let(hashes, count).cast("long")


def statistics(text: str = "text") -> Column:
    """The counts of one whole text as a struct; a null text counts as empty."""
    whole = text_or_empty(text)
    inner = F.trim(whole, F.lit(BLANKS))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"{BLANK}+", -1))
    lines = F.filter(F.split(whole, "\n", -1), lambda line: F.trim(line, F.lit(BLANKS)) != "")
    number = lambda pattern: F.regexp_count(whole, F.lit(pattern)).cast("long")
    counted = {
        "n_chars": F.length(whole).cast("long"),
        "word_chars": F.length(whole).cast("long") - number(BLANK),
        "n_symbols": number(SYMBOL),
        "n_upper": number(r"\p{Lu}"),
        "n_digits": number(r"[0-9]"),
        "n_marks": number(MARK),
    }
    of_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated_words(w).alias("repeated")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("repeated")))
    return F.struct(*(c.alias(name) for name, c in counted.items()), of_words.alias("words"), of_lines.alias("lines"))


def _per(part: str, whole: str, scale: int) -> str:
    return f"CASE WHEN {whole} > 0 THEN {part} * {scale} DIV {whole} ELSE 0 END"


#: What rules may judge, all whole numbers, as SQL over the counts of ``measured``.
FEATURES = {
    "words": "n_words",
    "word_chars_per_100_words": _per("word_chars", "n_words", 100),
    "words_per_line": _per("n_words", "n_lines", 1),
    "symbols_per_1000_chars": _per("n_symbols", "n_chars", 1000),
    "capitals_per_1000_chars": _per("n_upper", "n_chars", 1000),
    "digits_per_1000_chars": _per("n_digits", "n_chars", 1000),
    "marks_per_1000_chars": _per("n_marks", "n_chars", 1000),
    "repeated_lines_per_1000": _per("n_dup_lines", "n_lines", 1000),
    "repeated_words_per_1000": _per("n_repeat_words", "n_words", 1000),
}


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A written row per row of ``docs``: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and the features."""
    rows = written(docs.select(F.col(key), statistics(text).alias("s")), "text-statistics")
    rows = rows.select(
        key,
        "s.n_chars",
        F.col("s.words.n").alias("n_words"),
        *(f"s.{c}" for c in ("word_chars", "n_symbols", "n_upper", "n_digits", "n_marks")),
        F.col("s.lines.n").alias("n_lines"),
        F.col("s.lines.repeated").alias("n_dup_lines"),
        F.col("s.words.repeated").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return rows.withColumn("base_failed", failed).withColumns({name: F.expr(sql) for name, sql in FEATURES.items()})


def ladder(x: Column) -> Column:
    """``x``, 0 or more, rounded down to two leading digits: at most 90 values a power of ten, whatever the data.

    For a value t of the ladder, ladder(x) >= t just if x >= t.
    """
    unit = F.pow(F.lit(10.0), F.length(x.cast("string")) - 2).cast("long")
    return F.when(x < 100, x).otherwise(x - x % unit)


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: int

    def column(self) -> Column:
        return F.col(self.feature) >= self.threshold if self.at_least else F.col(self.feature) < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold}"


Rule = tuple[Condition, ...]


def holds(rule: Rule) -> Column:
    """All conditions of the rule; the rule without conditions always holds."""
    found = F.lit(True)
    for condition in rule:
        found = found & condition.column()
    return found


def in_words(rule: Rule) -> str:
    return " AND ".join(map(str, rule))


def decision(rules: list[Rule]) -> Column:
    """The rules as one ordered conditional expression: the words of the first rule that holds, else null."""
    found = F.lit(None).cast("string")
    for rule in reversed(rules):
        found = F.when(holds(rule), F.lit(in_words(rule))).otherwise(found)
    return found


def quality_labels(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """A row per labelled id: label_id, bad. An id labelled twice counts as its better label; null ids and labels don't count."""
    told = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull())
    return told.groupBy(F.col(key).alias("label_id")).agg((F.max("quality") == 0).alias("bad"))


def cells(rows: DataFrame, labels: DataFrame, prune_share: int = 3, seed: int = 5, key: str = "doc_id") -> DataFrame:
    """Labelled rows counted by their ladder values: features, pruning (one id in ``prune_share``, by hash), n_bad, n_good."""
    told = rows.where(~F.col("base_failed")).join(quality_labels(labels), F.col(key) == F.col("label_id"))
    pruning = (F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(prune_share)) == 0).alias("pruning")
    by = [ladder(F.col(f)).alias(f) for f in FEATURES]
    n = lambda c, name: F.sum(c.cast("long")).alias(name)
    return written(told.groupBy(*by, pruning).agg(n(F.col("bad"), "n_bad"), n(~F.col("bad"), "n_good")), "label-cells")


def best_condition(grow: DataFrame) -> Condition | None:
    """The threshold with the largest information gain over the bad rows (ties: first by name), None if none gains.

    All ladder values of all features are judged: their counts are a few thousand rows at most, at any size of the table.
    """
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in FEATURES)))
    counts = grow.select(each.alias("x"), "n_bad", "n_good").groupBy("x.feature", "x.value").agg(F.sum("n_bad").alias("bad"), F.sum("n_good").alias("good"))
    by_feature = Window.partitionBy("feature")
    upward = by_feature.orderBy(F.col("value").desc())
    sums = counts.select("feature", "value", *(F.sum(c).over(upward).alias(f"{c}_from") for c in ("bad", "good")), *(F.sum(c).over(by_feature).alias(f"{c}_all") for c in ("bad", "good")))
    two = F.explode(
        F.array(
            F.struct(F.lit(True).alias("at_least"), F.col("bad_from").alias("p"), F.col("good_from").alias("n")),
            F.struct(F.lit(False).alias("at_least"), (F.col("bad_all") - F.col("bad_from")).alias("p"), (F.col("good_all") - F.col("good_from")).alias("n")),
        )
    )
    judged = sums.select("feature", "value", "bad_all", "good_all", two.alias("c")).where("c.p > 0")
    pure = lambda p, n: F.log2(p / (p + n))
    gain = F.col("c.p") * (pure(F.col("c.p"), F.col("c.n")) - pure(F.col("bad_all"), F.col("good_all")))
    top = judged.withColumn("gain", gain).where("gain > 1e-9").orderBy(F.desc("gain"), "feature", F.desc("c.at_least"), "value").limit(1).first()
    return Condition(top["feature"], top["c"]["at_least"], top["value"]) if top else None


def grow_rule(grow: DataFrame, most_conditions: int) -> Rule:
    """Conditions are added while they gain and good rows are still covered."""
    rule: Rule = ()
    while len(rule) < most_conditions:
        found = best_condition(grow.where(holds(rule)))
        if found is None or found in rule:
            break
        rule = (*rule, found)
    return rule


def prune_rule(rule: Rule, prune: DataFrame) -> tuple[Rule, int, int]:
    """Of all beginnings of the rule, the one with the largest (bad - good) / (bad + good) on rows it wasn't grown on; its counts."""
    sums = [F.coalesce(F.sum(F.when(holds(rule[:k]), F.col(c))), F.lit(0)) for k in range(1, len(rule) + 1) for c in ("n_bad", "n_good")]
    counts = list(prune.agg(*(c.alias(f"c{i}") for i, c in enumerate(sums))).first())
    worth = lambda k: (counts[2 * k] - counts[2 * k + 1]) / max(1, counts[2 * k] + counts[2 * k + 1])
    k = max(range(len(rule)), key=lambda k: (worth(k), -k))
    return rule[: k + 1], counts[2 * k], counts[2 * k + 1]


def learn_rules(counts: DataFrame, most_rules: int = 16, most_conditions: int = 4, least_precision: float = 0.75) -> list[Rule]:
    """Sequential covering of the bad rows of ``cells``.

    A rule is grown on two thirds of the rows, pruned on the rest, and taken if (bad + 1) / (bad + good + 2) of the rows
    it covers there is ``least_precision`` or more; the rows it covers leave both parts, and the next rule is grown on
    what is left. The first rule that isn't taken ends the list, so a list that labels don't bear out is empty.
    """
    rules: list[Rule] = []
    left = F.lit(True)
    while len(rules) < most_rules:
        rest = counts.where(left)
        rule = grow_rule(rest.where(~F.col("pruning")), most_conditions)
        if not rule:
            break
        rule, bad, good = prune_rule(rule, rest.where("pruning"))
        if (bad + 1) / (bad + good + 2) < least_precision:
            break
        rules.append(rule)
        left = left & ~holds(rule)
    return rules


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> tuple[DataFrame, list[Rule]]:
    """Learn from the labelled rows and judge every row: the columns of ``measured``, rule (null: none holds), kept.

    A null or empty text has no words and fails the base rule. A null id is never labelled; rows with one id share its
    label and are judged by their own texts. Without labels, or with labels of one kind, there is no rule. An empty
    table gives no row. Only key and text of ``docs`` are read, so further columns can't clash.
    """
    rows = measured(docs, key, text)
    rules = learn_rules(cells(rows, labels, key=key), **settings)
    rows = rows.withColumn("rule", F.when(~F.col("base_failed"), decision(rules)))
    return rows.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), rules


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = judge(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
