"""Line deduplication against levelled sorted runs of line hashes."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm.common import BLANKS, lower_ascii, new_path, text_or_empty

HASHES = ("h1", "h2")


def line_key(line: Column) -> Column:
    return lower_ascii(F.trim(line, F.lit(BLANKS)))


def lines_of(text: str = "text") -> Column:
    return F.split(text_or_empty(text), "\n", -1)


class LineRuns:
    """All line hashes seen so far, in levels of sorted runs.

    A run is a table bucketed and sorted by hash, so a batch is merged with it bucket by bucket and only the batch
    moves. ``fan_in`` runs of one level are compacted into one run of the next, so a batch meets
    ``fan_in * log(batches)`` runs at most. Hashes of different runs are disjoint: a run takes only what was new.
    """

    def __init__(self, spark: SparkSession, buckets: int, fan_in: int = 4):
        self.spark, self.buckets, self.fan_in = spark, buckets, fan_in
        self.levels: list[list[str]] = [[]]

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        sorted_rows = df.repartition(self.buckets, *HASHES)
        sorted_rows.write.bucketBy(self.buckets, *HASHES).sortBy(*HASHES).option("compression", "none").option("path", new_path(self.spark, "run")).saveAsTable(name)
        return name

    def add(self, batch: DataFrame, key: str) -> DataFrame:
        """Take a batch of (key, h1, h2) and return its hashes that repeat: h1, h2, owner, seen_before.

        owner is the smallest key that holds the hash in this batch; seen_before says that an earlier batch owns it.
        """
        found = batch.groupBy(*HASHES).agg(F.min(key).alias("owner"), F.max(key).alias("last"), F.max(F.col(key).isNull()).alias("no_key"))
        earlier = F.lit(False)
        for i, run in enumerate(run for level in self.levels for run in level):
            there = self.spark.table(run).where("not seen_before").select(*HASHES, F.lit(True).alias(f"in_{i}"))
            found = found.join(there, list(HASHES), "left")
            earlier = earlier | F.col(f"in_{i}").isNotNull()
        name = self._write(found.select(*HASHES, "owner", "last", "no_key", earlier.alias("seen_before")))
        self.levels[0].append(name)
        for depth in range(len(self.levels)):
            if len(self.levels[depth]) < self.fan_in:
                break
            merged = self.spark.table(self.levels[depth][0]).where("not seen_before")
            for run in self.levels[depth][1:]:
                merged = merged.unionByName(self.spark.table(run).where("not seen_before"))
            self.levels[depth] = []
            self.levels += [[]] * (depth + 2 - len(self.levels))
            self.levels[depth + 1] = [*self.levels[depth + 1], self._write(merged)]
        several = (F.col("owner") < F.col("last")) | (F.col("no_key") & F.col("owner").isNotNull())
        return self.spark.table(name).where(several | F.col("seen_before")).select(*HASHES, "owner", "seen_before")


def dedup_lines(
    docs: DataFrame, batches: int = 4, fan_in: int = 3, least_chars: int = 10, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Keep every line key of ``least_chars`` code points or more only in the smallest document that holds it.

    Documents come in ``batches`` of about equal counts by rising id. Each batch's hashes (128 bits) merge with the runs
    of the earlier ones: what a run holds is owned by an earlier, smaller id; the rest the batch owns, by its smallest
    id, and adds as a run. A line of an id that isn't the owner goes; a key within one document only, or a short one,
    stays with all its lines. A hot line is folded per task before the exchange; the join that spreads the verdicts
    can be split by adaptive execution.

    A null or empty text is one empty line. A null id counts as the largest; rows with one id count as one document.
    Ties and repeated rows therefore keep their lines together. Extra columns don't matter.

    Returns a row for each row of ``docs``: key, n_lines, n_dropped, kept (the text left).
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key), text_or_empty(text).alias("text"))
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    cuts = []
    if batches > 1:
        cuts = docs.agg(F.percentile_approx(key, [i / batches for i in range(1, batches)], 100 * batches)).first()[0] or []
    batch = sum(((F.col(key) > cut).cast("int") for cut in sorted(set(cuts))), F.lit(0))
    batch = F.when(F.col(key).isNull(), F.lit(len(set(cuts)))).otherwise(batch)

    line = F.explode(F.array_distinct(F.transform(lines_of(), line_key)))
    hashed = docs.select(key, batch.alias("batch"), line.alias("line")).where(F.length("line") >= least_chars)
    hashed = hashed.select(key, F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"), "batch")
    path = new_path(spark, "lines")
    hashed.write.option("compression", "none").partitionBy("batch").parquet(path)  # hashes don't compress
    hashed = spark.read.schema(hashed.schema).parquet(path)

    runs = LineRuns(spark, buckets=max(8, math.ceil(total / (1 << 30))), fan_in=fan_in)
    repeats = None
    for i in range(len(set(cuts)) + 1):
        own = runs.add(hashed.where(F.col("batch") == i), key).withColumn("batch", F.lit(i))
        repeats = own if repeats is None else repeats.unionByName(own)
    lost = hashed.join(repeats, ["batch", *HASHES]).where(F.col("seen_before") | ~F.col(key).eqNullSafe(F.col("owner")))
    lost = lost.groupBy(F.col(key).alias("at")).agg(F.collect_set("h1").alias("lost"))

    joined = docs.join(lost, F.col(key).eqNullSafe(F.col("at")), "left").select(key, lines_of().alias("lines"), "lost")
    stays = lambda x: (F.length(line_key(x)) < least_chars) | ~F.array_contains(F.col("lost"), F.xxhash64(line_key(x)))
    kept = F.when(F.col("lost").isNull(), F.col("lines")).otherwise(F.filter("lines", stays))
    return joined.withColumn("left_over", kept).select(
        key,
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("left_over")).cast("long").alias("n_dropped"),
        F.array_join("left_over", "\n").alias("kept"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH lines AS (
    SELECT doc_id, n, line,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS n
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), owners AS (
    SELECT k, min(doc_id) AS owner FROM lines WHERE length(k) >= 10 GROUP BY k
), judged AS (
    SELECT l.doc_id, l.n, l.line, o.owner IS NULL OR o.owner = l.doc_id AS stays FROM lines l LEFT JOIN owners o ON l.k = o.k AND length(l.k) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE stays), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
