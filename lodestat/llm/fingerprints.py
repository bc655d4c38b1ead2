"""Bottom-k sketches of shingle hashes as document fingerprints."""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm.common import parts_for, text_or_empty

BITS = 48  # a hash takes six bytes


class Sketcher:
    """Hashes of all word shingles of a text; of these the ``k`` smallest are its fingerprint.

    A text of one to ``shingle`` - 1 words is one shingle; a text without words has none. Words are compared in lower case.
    """

    def __init__(self, k: int = 128, shingle: int = 5):
        self.k, self.shingle = k, shingle
        self.memo: dict[bytes, int] = {}

    def hashes(self, text: str) -> np.ndarray:
        words = text.lower().encode("utf-8", "surrogatepass").split()  # bytes split at ASCII blanks only
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(self.memo) > 500_000:
            self.memo.clear()
        memo, values = self.memo, []
        for word in words:
            value = memo.get(word)
            if value is None:
                value = memo[word] = xxhash.xxh64_intdigest(word)
            values.append(value)
        one = np.array(values, dtype=np.uint64)
        length = min(self.shingle, len(one))
        n = len(one) - length + 1
        mixed = np.zeros(n, dtype=np.uint64)
        for i in range(length):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + one[i : i + n]
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        return mixed >> np.uint64(64 - BITS)

    def sketch(self, text: str) -> np.ndarray:
        return bottom(self.hashes(text), self.k)


def bottom(hashes: np.ndarray, k: int) -> np.ndarray:
    return np.unique(hashes)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """The fingerprint of both parts together."""
    return bottom(np.concatenate([a, b]), k)


def resemblance(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Estimated Jaccard similarity; exact where both texts have fewer than k shingles. Two without shingles are alike."""
    both = merge(a, b, k)
    return float(np.isin(both, np.intersect1d(a, b, assume_unique=True), assume_unique=True).mean()) if len(both) else 1.0


def containment(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Estimated share of a's shingles that b has, from the hashes below both fingerprints' ends."""
    ends = [x[-1] for x in (a, b) if len(x) == k]
    seen = a[a <= min(ends)] if ends else a
    return float(np.isin(seen, b, assume_unique=True).mean()) if len(seen) else 1.0


def distinct_shingles(a: np.ndarray, k: int) -> float:
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**BITS / float(a[-1])


def encode(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode() if len(a) else ""


def decode(text: str) -> np.ndarray:
    six = np.frombuffer(base64.b64decode(text), dtype=np.uint8).reshape(-1, 6)
    return np.pad(six, ((0, 0), (2, 0))).copy().view(">u8").reshape(-1).astype(np.uint64)


def merge_fingerprints(df: DataFrame, by: str, fingerprint: str = "fingerprint", k: int = 128, salts: int = 64) -> DataFrame:
    """One fingerprint per value of ``by`` (any null is a value): by, fingerprint, distinct_shingles.

    Each task folds what it reads to one fingerprint per value, then values are folded per salt and at last as a
    whole, so a value that a third of all rows hold meets nowhere unfolded. Null fingerprints count as empty.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            for value, text in zip(batch["by"], batch["fingerprint"], strict=True):
                new = decode(text or "")
                held[value] = merge(held[value], new, k) if value in held else new
        yield pd.DataFrame({"by": list(held), "fingerprint": [encode(x) for x in held.values()]}, dtype=object)

    def fold_group(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"by": group["by"].iloc[:1], "fingerprint": [encode(bottom(np.concatenate([decode(t) for t in group["fingerprint"]]), k))]}, dtype=object)

    named = df.select(F.col(by).cast("string").alias("by"), F.col(fingerprint).alias("fingerprint"))
    for keys in (["by", F.pmod(F.spark_partition_id(), F.lit(salts))], ["by"]):
        named = named.mapInPandas(fold, "by string, fingerprint string") if len(keys) == 2 else named
        named = named.groupBy(*keys).applyInPandas(fold_group, "by string, fingerprint string")
    count = F.pandas_udf(lambda s: s.map(lambda t: distinct_shingles(decode(t), k)), "double")
    return named.select(F.col("by").alias(by), "fingerprint", count("fingerprint").alias("distinct_shingles"))


def with_next(docs: DataFrame, slice_bytes: int = 32 << 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Deal rows out so that each meets the next one by falling key, the first following the last.

    Keys are cut into slices of about ``slice_bytes``, one partition each; the row that starts a slice is copied to the end
    of the slice before. Returns key, text, slice and own (false for copies), sorted so inside partitions. Null keys come
    last; equal keys are ordered by a hash of the text, then the text. A key (or null) that fills several slices is cut by that
    hash, so of one key only rows with one text must lie together.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    # the hash is turned round, so that it falls along with the key
    docs = docs.select("key", "text", F.coalesce("key", F.lit(0)).cast("long").alias("number"), F.col("key").isNull().alias("keyless"), F.bitwise_not(F.xxhash64("text")).alias("turned"))
    rows, without, total = docs.agg(F.count("*"), F.count_if("keyless"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = parts_for(spark, total, slice_bytes)
    lowest = parts * without // max(rows, 1)  # slices that null keys fill
    keyed = parts - lowest
    cuts = docs.agg(F.percentile_approx("key", [i / keyed for i in range(1, keyed)] or [0.5], 20 * parts)).first()[0] or []
    cuts = cuts if keyed > 1 else []
    # a cut that comes twice hints at a key which fills a slice or more; cuts come through doubles, so such keys are counted
    twice = [float(cut) for cut, n in Counter(cuts).items() if n > 1]
    hot = docs.where(F.col("key").cast("double").isin(twice)).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") * parts >= rows)
    hot = {r["key"]: r["n"] * parts // rows for r in hot.collect()}  # at most as many as slices
    # where slices end; a hot key stands here once for each slice that it fills
    bounds = np.array(sorted([*(set(cuts) - set(hot)), *(key for key, n in hot.items() for _ in range(n))]), dtype=np.int64)

    @F.pandas_udf("int")
    def slice_of(number: pd.Series, keyless: pd.Series, turned: pd.Series) -> pd.Series:
        share = np.minimum((turned.to_numpy().astype(np.float64) + 2.0**63) / 2.0**64, 1 - 2.0**-53)
        low, high = np.searchsorted(bounds, number, "left"), np.searchsorted(bounds, number, "right")
        own = np.where(keyless, np.floor(share * lowest), lowest + low + np.floor(share * (high - low)))
        return pd.Series(own.astype(np.int32))

    # a row for each slice: the row that starts it
    sliced = docs.withColumn("slice", slice_of("number", "keyless", "turned"))
    tops = sliced.groupBy("slice").agg(F.max(F.struct("key", "turned")).alias("top")).orderBy("slice").collect()
    slices = np.array([r["slice"] for r in tops], dtype=np.int32)
    top_number = np.array([r["top"]["key"] or 0 for r in tops], dtype=np.int64)
    top_keyless = np.array([r["top"]["key"] is None for r in tops], dtype=bool)
    top_turned = np.array([r["top"]["turned"] for r in tops], dtype=np.int64)

    @F.pandas_udf("int")
    def also_in(number: pd.Series, keyless: pd.Series, turned: pd.Series, own: pd.Series) -> pd.Series:
        at = np.searchsorted(slices, own)
        starts = (top_number[at] == number) & (top_keyless[at] == keyless) & (top_turned[at] == turned)
        return pd.Series(np.roll(slices, -1)[at]).where(starts).astype("Int32")

    sliced = sliced.withColumn("also", also_in("number", "keyless", "turned", "slice"))
    places = F.filter(F.array(F.struct("slice", F.lit(True).alias("own")), F.struct(F.col("also").alias("slice"), F.lit(False).alias("own"))), lambda x: x["slice"].isNotNull())
    dealt = sliced.select("key", "text", F.inline(places)).repartitionById(lowest + len(bounds) + 1, F.col("slice"))
    return dealt.sortWithinPartitions("slice", F.col("own").desc(), F.col("key").desc_nulls_last(), F.xxhash64("text"), "text")


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, distinct_shingles double"


def fingerprint_documents(docs: DataFrame, k: int = 128, shingle: int = 5, **settings) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, whose last third is the beginning of the next text.

    The next text is that of the next row by falling doc_id, after the last that of the first; a table of one row is
    its own next. Rows stream through the task sorted, one held at a time, whatever their number or length. Null
    texts are empty; an empty text is its own edit and is like any other text without words; repeated ids and rows
    each get a row; an empty table gives none. Extra columns don't matter.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sketcher, held = Sketcher(k, shingle), None
        for batch in batches:
            rows = []
            for key, text, part, own in zip(batch["key"], batch["text"], batch["slice"], batch["own"], strict=True):
                if not own and (held is None or held[2] != part):
                    continue  # of the copies that end a slice, only the first is anyone's next
                sketch = sketcher.sketch(text)
                if held is not None and held[2] == part:
                    before, its_text, _, its_sketch = held
                    cut = len(its_text) // 3
                    edited = its_text[: len(its_text) - cut] + text[:cut]
                    edited_sketch = sketcher.sketch(edited)
                    rows.append((
                        before, len(its_text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), encode(its_sketch), encode(edited_sketch),
                        resemblance(its_sketch, edited_sketch, k), resemblance(its_sketch, sketch, k), distinct_shingles(its_sketch, k),
                    ))
                held = (key, text, part, sketch) if own else None
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in OUT.split(", ")])

    return with_next(docs, **settings).withColumn("key", F.col("key").cast("string")).mapInPandas(run, OUT.replace("doc_id long", "doc_id string")).withColumn("doc_id", F.col("doc_id").cast("long"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
