"""URL filtering by listed rules and by mined association rules."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm.common import lower_ascii, written

# fixed values: (action, host, path)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def _rest(url: str) -> Column:
    at = F.instr(F.col(url), "://")
    return F.when(at > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise(F.lit(""))


def host_of(url: str = "url") -> Column:
    return lower_ascii(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: str = "url") -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def url_tokens(url: str = "url") -> Column:
    """Host labels, path segments and query names, each once and marked by kind."""
    mark = lambda kind, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    return F.array_distinct(F.concat(mark("h:", F.split(host_of(url), r"\.")), mark("p:", F.split(path_of(url), "/")), mark("q:", names)))


def fold_tokens(rows: DataFrame) -> DataFrame:
    """n, both, tokens for ``rows`` (row, block, token): tokens that stand on the same rows are one item, on ``n`` rows, ``both`` of them blocked.

    Rows are compared by their number and two sums of row hashes. An item holds no more tokens than the urls it stands in.
    """
    marks = [F.sum(F.xxhash64(F.lit(seed), "row").cast("decimal(20,0)")).alias(f"mark{seed}") for seed in (1, 2)]
    known = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.count_if("block").alias("both"), *marks)
    return known.groupBy("n", "both", "mark1", "mark2").agg(F.sort_array(F.collect_list("token")).alias("tokens"))


def mine_rules(labelled: DataFrame, least_support: float = 0.0, least_confidence: float = 0.6, least_blocked: int = 5, chance: float = 0.05) -> DataFrame:
    """Rules tokens -> block from ``labelled`` (url, block): rule_id, tokens, confidence, support, posted.

    Tokens that stand on the same rows are folded into one item, and items on fewer than ``least_blocked`` blocked rows can be
    in no rule and go, so a long url costs one item, however many tokens it has. FP-growth finds the item combinations held by at
    least ``least_blocked`` blocked rows (and, if asked for, by a share of ``least_support`` of all rows). Combinations that stand on
    the same rows are one hypothesis, written as its shortest combinations: what a longer one adds changes no row. A rule stays if
    its confidence reaches the bound, beats the base rate and can't be put down to it: were its rows blocked at the base rate,
    so many would be with a probability (by Chernoff's bound) of at most ``chance`` shared among all hypotheses tried. So what
    counts as a rule depends neither on the table's size nor on the length of its urls. Combinations of items that really
    differ in their rows are all mined, which is FP-growth's own cost.

    An optional column ``listed`` marks rows whose verdict comes from a listed rule. They teach like the others, but where a rule
    also stands on rows that are not listed, the only ones it will decide, it must pass every bound on these alone as well.
    A rule that holds all of a shorter one which is as sure would decide nothing and goes.
    ``posted`` is the rule's rarest token, under which the index lists it. Null urls give no tokens; an empty table gives no rule;
    a null ``block`` counts as false.
    """
    listed = F.coalesce("listed", F.lit(False)) if "listed" in labelled.columns else F.lit(False)
    rows = labelled.select(F.coalesce("block", F.lit(False)).alias("block"), listed.alias("listed"), url_tokens().alias("tokens"), F.expr("uuid()").alias("row"))
    rows = written(rows, "url-rows")
    free_rows = ~F.col("listed")
    total, blocked, free_total, free_blocked = rows.agg(F.count(F.lit(1)), F.count_if("block"), F.count_if(free_rows), F.count_if(free_rows & F.col("block"))).first()
    least = max(least_blocked, math.ceil(least_support * total))
    long = rows.select("row", "block", "listed", F.explode("tokens").alias("token"))
    items = written(fold_tokens(long).where(F.col("both") >= least).select(F.col("tokens")[0].alias("item"), "tokens", "n"), "url-items")
    held = rows.join(long.join(items.select(F.col("item").alias("token"), "item", "n"), "token").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("n", "item"))).alias("held")), "row")
    held = written(held.select("block", "listed", "row", F.col("held.item").alias("items")), "url-baskets")
    # mined on the blocked rows alone; FP-growth rounds rows x share up
    sets = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / max(blocked, least), minConfidence=0.0).fit(held.where("block").select("items")).freqItemsets
    sizes = items.select("item", "n")
    ranked = sets.select(F.xxhash64(F.sort_array("items")).alias("rule_id"), "items", F.explode("items").alias("item")).join(sizes, "item")
    sets = written(ranked.groupBy("rule_id").agg(F.first("items").alias("items"), F.min(F.struct("n", "item")).alias("rarest")).select("rule_id", "items", "rarest.item"), "url-sets")
    hits = held.withColumn("item", F.explode("items")).withColumnRenamed("items", "basket").join(sets, "item")
    hits = hits.where(F.size(F.array_except("items", "basket")) == 0)
    tried = hits.groupBy("rule_id").agg(
        F.first("items").alias("items"), F.first("item").alias("rarest"), F.count(F.lit(1)).alias("freq"), F.count_if("block").alias("both"), F.count_if(free_rows).alias("free"),
        F.count_if(free_rows & F.col("block")).alias("free_both"), *(F.sum(F.xxhash64(F.lit(s), "row").cast("decimal(20,0)")).alias(f"mark{s}") for s in (1, 2)),
    )
    tried = written(tried, "url-tried")
    classes = tried.groupBy("freq", "mark1", "mark2").agg(F.min(F.size("items")).alias("shortest"))
    needed = math.log(max(classes.count(), 1) / chance)

    def holds(n: str, both: str, base: float) -> Column:
        c = F.col(both) / F.col(n)
        beyond = F.col(n) * (c * F.ln(c / base) + F.when(c < 1, (1 - c) * F.ln((1 - c) / (1 - base))).otherwise(0.0)) >= needed if 0 < base < 1 else F.lit(False)
        return (c >= least_confidence) & (c > base) & beyond

    rules = tried.join(classes, ["freq", "mark1", "mark2"]).where(F.size("items") == F.col("shortest")).where(holds("freq", "both", blocked / max(total, 1)))
    rules = rules.where((F.col("free") == 0) | ((F.col("free_both") > 0) & holds("free", "free_both", free_blocked / max(free_total, 1))))
    rules = written(rules.select("rule_id", "items", "rarest", "both", (F.col("both") / F.col("freq")).alias("confidence")), "url-held")
    short = rules.select(F.col("rule_id").alias("short_id"), F.col("items").alias("short"), F.col("rarest").alias("item"), F.col("confidence").alias("short_confidence"))
    within = rules.select("rule_id", "items", "confidence", F.explode("items").alias("item")).join(short, "item")
    within = within.where((F.size("short") < F.size("items")) & (F.col("short_confidence") >= F.col("confidence")) & (F.size(F.array_except("short", "items")) == 0))
    rules = rules.join(within.select("rule_id").distinct(), "rule_id", "left_anti")
    support = (F.col("both") / total if total else F.lit(0.0)).alias("support")
    spread = rules.select("rule_id", "confidence", support, F.col("rarest").alias("posted"), F.explode("items").alias("item")).join(items.select("item", "tokens"), "item")
    out = spread.groupBy("rule_id").agg(F.sort_array(F.flatten(F.collect_list("tokens"))).alias("tokens"), *(F.first(x).alias(x) for x in ("confidence", "support", "posted")))
    return written(out, "url-rules")


def listed_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """For each url that a listed rule (action, host, path) fits: url, rule, action of the longest rule.

    A rule is looked up by the suffixes of the url's host, so the number of rules doesn't matter.
    """
    labels = F.split(F.col("host"), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    at = urls.select("url", host_of().alias("host"), path_of().alias("path")).where("host != ''")
    at = at.select("url", "path", F.explode(suffixes).alias("suffix"))
    rules = rules.select("action", F.col("host").alias("suffix"), F.col("path").alias("prefix"), F.concat("host", "path").alias("rule"))
    fits = at.join(rules, "suffix").where(F.startswith(F.col("path"), F.col("prefix")))
    best = F.max(F.struct(F.length("rule"), "rule", "action"))
    return fits.groupBy("url").agg(best.alias("best")).select("url", "best.rule", "best.action")


def mined_verdicts(urls: DataFrame, mined: DataFrame) -> DataFrame:
    """For each url that a mined rule fits: url, rule_id and confidence of the surest. Every url's tokens look up the
    rules posted under them; a rule fits if the url holds all its tokens."""
    tokens = urls.select("url", url_tokens().alias("url_tokens"))
    hits = tokens.select("url", "url_tokens", F.explode("url_tokens").alias("posted")).join(mined, "posted")
    hits = hits.where(F.size(F.array_except("tokens", "url_tokens")) == 0)
    best = F.max(F.struct("confidence", "rule_id"))
    return hits.groupBy("url").agg(best.alias("best")).select("url", "best.confidence", "best.rule_id")


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    cells = [F.struct(F.lit(a).alias("action"), F.lit(h).alias("host"), F.lit(p).alias("path")) for a, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*cells)))


def judge_urls(pages: DataFrame, listed: DataFrame, mined: DataFrame, key: str = "page_id") -> DataFrame:
    """One row for each page: key, host, path, rule, verdict, confidence, rule_id.

    The longest listed rule that fits decides; else a mined rule that fits blocks, and none allows. Verdicts are found once
    for each distinct url, so a url on a third of all pages costs one lookup; the join back can be split. A null
    url, or one without ``://``, has empty host and path, fits no rule and is allowed; null keys and repeated rows
    stay as they are. Extra columns don't matter.
    """
    pages = pages.select(key, "url")
    urls = pages.where("url is not null").groupBy("url").agg(F.lit(1).alias("once")).select("url")
    verdicts = listed_verdicts(urls, listed).join(mined_verdicts(urls, mined), "url", "full_outer")
    verdicts = verdicts.select(F.col("url").alias("judged"), "rule", "action", "confidence", "rule_id")
    verdict = F.coalesce("action", F.when(F.col("rule_id").isNotNull(), "block"), F.lit("allow"))
    out = pages.join(verdicts, F.col("url") == F.col("judged"), "left")
    return out.select(key, host_of().alias("host"), path_of().alias("path"), "rule", verdict.alias("verdict"), "confidence", "rule_id")


def label_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """url and block of the pages whose id is labelled: toxic or of low quality means block."""
    labels = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    block = F.coalesce((F.col("toxic") == 1) | (F.col("quality") == 0), F.lit(False))
    return pages.select("page_id", "url").join(labels, F.col("page_id") == F.col("doc_id")).select("url", block.alias("block"))


def teaching_pages(pages: DataFrame, labels: DataFrame, listed: DataFrame) -> DataFrame:
    """url, block, listed: every page that a listed rule decides, by that rule, and every other labelled page by its label."""
    urls = pages.where("url is not null").select("url").distinct()
    verdicts = written(listed_verdicts(urls, listed).select(F.col("url").alias("judged"), (F.col("action") == "block").alias("block")), "url-listed")
    same = F.col("url") == F.col("judged")
    by_rule = pages.select("url").join(verdicts, same).select("url", "block", F.lit(True).alias("listed"))
    by_label = label_pages(pages, labels).join(verdicts.select("judged"), same, "left_anti")
    return by_rule.unionByName(by_label.select("url", "block", F.lit(False).alias("listed")))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, listed = spark.read.parquet(f"{sf_dir}/pages.parquet"), rules_table(spark, RULES)
    mined = mine_rules(teaching_pages(pages, spark.read.parquet(f"{sf_dir}/labels.parquet"), listed))
    return judge_urls(pages, listed, mined)
