"""Two-pass external shuffle into shards."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestat.llm.common import new_path, text_or_empty, whole_row

RECORD_BYTES = 16
MOST_BROADCAST = 1 << 20


def write_shards(
    docs: DataFrame, folder: str, shards: int = 40, bucket_bytes: int = 32 << 20, seed: int = 17, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Shuffle all rows of ``docs`` and write them as ``shards`` folders ``shard=N`` whose row counts differ by one at most.

    Pass one scatters every row by a seeded hash of its key, text and place in the input into buckets of about
    ``bucket_bytes``, one task each; pass two shuffles every bucket (Fisher-Yates, seeded, one stream per bucket) and
    writes it. Buckets follow each other, so a bucket's rows go to consecutive places, and the places 0..n-1 are cut into
    shards of equal counts. Slots count from 0 without gaps inside a shard.

    The place in the input keeps a key that a third of all rows share from meeting in one bucket; ``docs`` must
    therefore be a table (or another source that deals out its rows alike every time). No row is dropped: null keys,
    null and empty texts and repeated rows each get a slot of their own; an empty table writes no shard. One row of
    any length stays whole, so a bucket can exceed ``bucket_bytes`` by one text. Input columns are kept in the struct
    ``doc``, where no name can clash.

    Returns the written rows: slot, size (UTF-8 bytes + 16), text_crc32, doc, shard.
    """
    spark = docs.sparkSession
    rows = docs.select(
        whole_row(docs),
        (F.octet_length(text_or_empty(text)) + F.lit(RECORD_BYTES)).cast("long").alias("size"),
        F.crc32(text_or_empty(text).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit(seed), F.col(key), text_or_empty(text), F.monotonically_increasing_id()).alias("draw"),
    )
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = max(shards, math.ceil(total / bucket_bytes))
    rows = rows.withColumn("bucket", F.pmod("draw", F.lit(buckets)).cast("int"))

    # a row for each bucket, far fewer than rows: one small ordered sum
    before = F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = rows.groupBy("bucket").agg(F.count("*").alias("n")).select("bucket", before.alias("start"))

    shuffled = (
        rows.repartitionById(buckets, F.col("bucket"))
        .sortWithinPartitions("bucket", "draw")  # the order that the shuffle starts from doesn't hang on arrival
        .groupBy("bucket")
        .agg(F.collect_list(F.struct("size", "text_crc32", "doc")).alias("rows"))
        .select("bucket", F.posexplode(F.shuffle("rows", F.lit(seed))))
    )
    if buckets <= MOST_BROADCAST:  # 24 bytes a bucket; beyond it the rows meet their starts in a shuffled join
        starts = F.broadcast(starts)
    placed = shuffled.join(starts, "bucket").select("col.*", (F.col("start") + F.col("pos")).alias("place"))
    small, longer = n // shards, n % shards  # the first `longer` shards hold one row more
    edge = longer * (small + 1)
    shard = F.when(F.col("place") < edge, F.floor(F.col("place") / (small + 1))).otherwise(F.floor((F.col("place") - edge) / max(small, 1)) + longer)
    slot = F.col("place") - F.when(F.col("shard") < longer, F.col("shard") * (small + 1)).otherwise(F.col("shard") * small + longer)
    out = placed.withColumn("shard", shard.cast("int")).select(slot.cast("long").alias("slot"), "size", "text_crc32", "doc", "shard")
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    return spark.read.schema(out.schema).parquet(folder)


def shard_documents(docs: DataFrame, **settings) -> DataFrame:
    """``write_shards`` into a new folder of the shared folder."""
    return write_shards(docs, new_path(docs.sparkSession, "shards"), **settings)


def digest(shards: DataFrame, key: str = "doc_id") -> DataFrame:
    """Where every document is, from the shards as written; the checksum is taken from the written text."""
    return shards.select(
        F.col(f"doc.{key}").alias(key),
        "size",
        F.crc32(F.coalesce(F.col("doc.text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")))
