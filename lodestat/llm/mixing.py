"""Mixing sources to target weights with Efraimidis-Spirakis keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestat.llm.common import WORD, text_or_empty, whole_row, written

BINS = 4096
MOST_BROADCAST = 1 << 20


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most_epochs: float = 3.0, source: str = "source") -> DataFrame:
    """One row per source: source_size and target.

    Sources in code point order (null last) take the weights in turn and share the total of all sizes by weight. A
    target stops at ``most_epochs`` times the source's size; what is cut off is shared again by weight until no target
    is above. With the sources in order of limit by weight, the share per weight if those before are at their limit
    rises until the first that isn't, so its maximum is the final share.
    """
    per = sizes.groupBy(source).agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    per = per.withColumn("weight", F.get(F.array(*(F.lit(float(w)) for w in weights)), turn % len(weights)))
    per = per.withColumn("limit", F.col("source_size") * most_epochs)
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), F.col(source).asc_nulls_last())
    limits = F.coalesce(F.sum("limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    share = (F.sum("source_size").over(everything) - limits) / weight_left
    per = per.withColumn("share", share).withColumn("share", F.max("share").over(everything))
    return per.select(source, "source_size", F.least("limit", F.col("share") * F.col("weight")).alias("target"))


def uniform(key: str, seed: int) -> Column:
    """A number above 0 up to 1 from id and seed."""
    return (F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 53)) + 1) / F.lit(float(1 << 53))


def draw_key(key: str, weight: Column, seed: int) -> Column:
    """-ln(u) / weight: the smallest keys are a weighted sample without replacement."""
    return -F.ln(uniform(key, seed)) / weight


def mix(
    docs: DataFrame, weight: str = "weight", weights: tuple[float, ...] = (5, 2, 1), most_epochs: float = 3.0, seed: int = 7, key: str = "doc_id", source: str = "source", whole: bool = False
) -> DataFrame:
    """How often each row of ``docs`` (columns ``size`` and ``weight`` besides its own) enters the mix.

    Every source first gives complete epochs; the words that its target then lacks come from the rows with the smallest
    draw keys. Keys are cut into bins; sums per source and bin show the bin in which the budget ends, all bins before
    it are taken whole, and only that bin's rows are ordered: a source with a third of all rows costs no more than
    one part in a thousand of it in any task. The row at which the budget ends gives only the words still lacking; with ``whole`` it is
    taken or left as a whole by a draw of its own, with the share of its words still lacking as probability: a source then misses its
    target by less than one row, to either side, and on average not at all.

    A null id or weight is allowed (weight 1, also for weights not above 0); a null source is a source, the last; rows
    with equal ids have equal keys and are taken in order of size; a row of size 0 is in the last pass if its draw key comes before
    the end of the budget, or if its source has no words at all. An empty table gives no row. The
    draw depends on ids and seed only, so reruns agree however the rows are dealt.

    Returns the rows with source_size, target, epochs (whole copies), part (words of one more copy) and extra (1 if there is one more copy).
    """
    w = F.coalesce(F.when(F.col(weight) > 0, F.col(weight)), F.lit(1.0))
    keyed = docs.withColumn("draw", draw_key(key, w, seed))
    keyed = keyed.withColumn("bin", F.floor(F.col("draw") / (1 + F.col("draw")) * BINS).cast("int"))
    binned = keyed.groupBy(source, "bin").agg(F.sum("size").alias("size"))
    targets = source_targets(binned, weights, most_epochs, source)
    targets = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
    targets = targets.withColumn("budget", (F.floor("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    upto = F.sum("size").over(Window.partitionBy(source).orderBy("bin"))
    ends = binned.withColumn("upto", upto).withColumnRenamed(source, "bin_source")
    ends = targets.join(ends, F.col(source).eqNullSafe(F.col("bin_source")) & (F.col("upto") >= F.col("budget")) & (F.col("budget") > 0), "left")
    first = F.min(F.struct(F.col("bin"), (F.col("upto") - F.col("size")).alias("before")))
    ends = ends.groupBy(F.col(source).alias("at"), "source_size", "target", "epochs", "budget").agg(first.alias("end"))
    ends = ends.select("at", "source_size", "target", "epochs", "budget", F.coalesce("end.bin", F.lit(-1)).alias("end_bin"), F.col("end.before").alias("before"))

    ends = written(ends, "mix-ends")
    if ends.count() <= MOST_BROADCAST:  # a row per source; beyond it rows meet their source in a shuffled join, which can be split
        ends = F.broadcast(ends)
    joined = keyed.join(ends, F.col(source).eqNullSafe(F.col("at")))
    out = [*docs.columns, "source_size", "target", "epochs"]
    before_end = F.col("bin") < F.col("end_bin")
    part, extra = F.when(before_end, F.col("size")).otherwise(F.lit(0)), (before_end | (F.col("source_size") == 0)).cast("int")
    settled = joined.where(F.col("bin") != F.col("end_bin")).select(*out, part.cast("long").alias("part"), extra.alias("extra"))
    ordered = Window.partitionBy("at").orderBy("draw", key, "size").rowsBetween(Window.unboundedPreceding, -1)
    lacking = F.col("budget") - F.col("before") - F.coalesce(F.sum("size").over(ordered), F.lit(0))
    last = joined.where(F.col("bin") == F.col("end_bin")).withColumn("lacking", lacking)
    if whole:
        taken = (F.col("lacking") > 0) & (uniform(key, seed + 1) * F.col("size") <= F.col("lacking"))
        part = F.when(taken, F.col("size")).otherwise(F.lit(0))
    else:
        taken = F.col("lacking") > 0
        part = F.least("size", F.greatest("lacking", F.lit(0)))
    return settled.unionByName(last.select(*out, part.cast("long").alias("part"), taken.cast("int").alias("extra")))


def label_weights(labels: DataFrame, good: float = 2.0, bad: float = 0.5) -> DataFrame:
    """doc_id and weight from quality labels; an id labelled twice counts as its better label."""
    return labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")).select(
        F.col("doc_id").alias("label_id"), F.when(F.col("quality") == 1, good).when(F.col("quality") == 0, bad).otherwise(1.0).alias("weight")
    )


def weighted(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows as struct ``doc`` beside key, source, size and weight, so no column of theirs can clash."""
    rows = docs.select(whole_row(docs), key, "source", word_count().alias("size"))
    labels = label_weights(labels)
    return rows.join(labels, rows[key] == labels["label_id"], "left").drop("label_id")


def mixed_rows(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as the mix takes it.

    The one copy per source at which the budget ends holds only its first words (joined by single spaces; n_chars follows);
    with ``whole=True`` every copy is a whole row.
    """
    planned = mix(weighted(docs, labels), **settings)
    copy = F.explode(F.sequence(F.lit(1), (F.col("epochs") + F.col("extra")).cast("int")))
    rows = planned.where("epochs > 0 OR extra > 0").select("doc", "size", "epochs", "part", copy.alias("copy"))
    cut = (F.col("copy") > F.col("epochs")) & (F.col("part") < F.col("size"))
    words = F.regexp_extract_all(F.col("doc.text"), F.lit(WORD), F.lit(0))
    text = F.when(cut, F.array_join(F.slice(words, F.lit(1), F.col("part").cast("int")), " ")).otherwise(F.col("doc.text"))
    rows = rows.withColumn("cut_text", text).withColumn("was_cut", cut)
    out = {c: F.col(f"doc.`{c}`") for c in docs.columns}
    out["text"] = F.col("cut_text")
    if "n_chars" in out:
        out["n_chars"] = F.when(F.col("was_cut"), F.length("cut_text").cast("long")).otherwise(F.col("doc.n_chars"))
    return rows.select(*(c.alias(name) for name, c in out.items()))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    taken = F.col("epochs") * F.col("size") + F.col("part")
    return mix(weighted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("doc")).select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source", "epochs")
