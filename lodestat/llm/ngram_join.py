"""N-gram Jaccard join by chosen paths."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm.common import text_or_empty, written

COORDINATES = 64
MULTIPLIERS = np.array([xxhash.xxh64_intdigest(b"multiplier", seed=i) | 1 for i in range(COORDINATES)], dtype=np.uint64)
SIGNED = "doc_id string, text_key long, rep binary, signature array<int>"


def shingles(text: str, length: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all word shingles (lower case); fewer words than ``length`` make one shingle."""
    words = text.lower().encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    memo: dict[bytes, int] = {}
    one = np.fromiter((memo[w] if w in memo else memo.setdefault(w, xxhash.xxh64_intdigest(w)) for w in words), dtype=np.uint64, count=len(words))
    length = min(length, len(one))
    n = len(one) - length + 1
    out = np.zeros(n, dtype=np.uint64)
    for i in range(length):
        out = out * np.uint64(0x9E3779B97F4A7C15) + one[i : i + n]
    out ^= out >> np.uint64(29)
    return np.unique(out * np.uint64(0xBF58476D1CE4E5B9))


def signature(found: np.ndarray) -> np.ndarray:
    """The embedded set: per coordinate the smallest of a permuted hash, 32 bits of it. A coordinate is one sampled token."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(found), 8192):
        mixed = found[start : start + 8192, None] * MULTIPLIERS
        mixed ^= mixed >> np.uint64(32)
        least = np.minimum(least, (mixed * np.uint64(0xD6E8FEB86659FD93)).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def sign(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found = shingles(text, length)
                rows.append((xxhash.xxh128_digest(found.tobytes()), signature(found) if len(found) else None))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_key": batch["text_key"], "rep": [r for r, _ in rows], "signature": [s for _, s in rows]})

    return run


def runs_for(recall: float, similarity: float, depth: int) -> int:
    """Runs until a pair at the threshold is together at ``depth`` in one of them with probability ``recall``.

    A path takes each coordinate with probability 1 / (similarity * COORDINATES), so a pair at the threshold keeps
    one common path on average from level to level, and some with the probability of a critical branching process.
    """
    stays = 1.0
    for _ in range(depth):
        stays = 1 - math.exp(-stays)
    return math.ceil(math.log(1 - recall) / math.log(1 - stays))


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each node's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def candidate_groups(least_equal: int):
    """Per leaf, compare all signatures; members with a likely partner come out with their group within the leaf."""

    def judge(leaf: np.ndarray, reps: np.ndarray, signatures: np.ndarray) -> pd.DataFrame:
        first, second = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        at, step = np.arange(len(leaf)), 0
        while len(at):
            step += 1
            at = at[at + step < len(leaf)]
            at = at[leaf[at] == leaf[at + step]]
            for part in np.array_split(at, len(at) // 100_000 + 1):
                near = part[(signatures[part] == signatures[part + step]).sum(axis=1) >= least_equal]
                first.append(near)
                second.append(near + step)
        a, b = np.concatenate(first), np.concatenate(second)
        label = components(len(leaf), a, b)
        used = np.unique(np.concatenate([a, b]))
        return pd.DataFrame({"leaf": leaf[used], "head": reps[label[used]], "rep": reps[used]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            leaf = batch["leaf"].to_numpy()
            cut = int(np.flatnonzero(leaf != leaf[-1])[-1]) + 1 if (leaf != leaf[-1]).any() else 0
            held = batch.iloc[cut:]
            if cut:
                yield judge(leaf[:cut], batch["rep"].to_numpy()[:cut], np.stack(batch["signature"].to_numpy()[:cut]))
        if held is not None and len(held):
            yield judge(held["leaf"].to_numpy(), held["rep"].to_numpy(), np.stack(held["signature"].to_numpy()))

    return run


def leaves_of(signed: DataFrame, runs: int, similarity: float, most: int, depth: int, seed: int) -> DataFrame:
    """(leaf, rep): the buckets of at most ``most`` sets in which chosen paths end.

    A run starts with all sets in one bucket; a bucket above ``most`` is split on coordinates that its path's hash
    chooses, alike for all members. Buckets still above it after ``depth`` levels hold sets that are alike in most
    coordinates; they are cut into blocks, and every two blocks make a leaf, so no pair is left out.
    """
    spark = signed.sparkSession
    sets = signed.select("rep", "signature")
    chance = 1 / (similarity * COORDINATES)
    draw = np.random.default_rng(seed)
    roots = [(run, i) for run in range(runs) for i in np.flatnonzero(draw.random(COORDINATES) < chance)]
    paths = F.array(*(F.xxhash64(F.lit(run), F.lit(int(i)), F.col("signature")[int(i)]) for run, i in roots))
    rows = written(sets.select("rep", F.explode(paths).alias("path")), "paths", compression="none")
    leaves = None
    for level in range(1, depth + 1):
        sizes = rows.groupBy("path").agg(F.count("*").alias("members")).where("members > 1")
        sized = written(rows.join(sizes, "path"), "paths", compression="none")
        small = sized.where(F.col("members") <= most).select(F.col("path").alias("leaf"), "rep")
        leaves = small if leaves is None else leaves.unionByName(small)
        large = sized.where(F.col("members") > most)
        if large.isEmpty():
            return leaves
        if level < depth:
            taken = lambda i: F.pmod(F.xxhash64("path", i), F.lit(1 << 30)) < F.lit(int(chance * (1 << 30)))
            steps = F.transform("signature", lambda x, i: F.when(taken(i), F.xxhash64("path", i, x)))
            steps = F.explode(F.filter(steps, lambda x: x.isNotNull()))
            rows = written(large.join(sets, "rep").select("rep", steps.alias("path")), "paths", compression="none")
    blocks = F.ceil(F.col("members") * 2 / F.lit(most)).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    pair = F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.xxhash64("path", F.least(own, other), F.greatest(own, other)))
    return leaves.unionByName(large.select(F.explode(pair).alias("leaf"), "rep"))


def star_classes(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b) as (rep, root): large-star and small-star steps until nothing changes.

    Every step links nodes to the smallest node they know of; rounds grow with the logarithm of the size, and each
    is a grouped minimum and a join on the nodes.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "stars")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        kept = both.where("b < a").join(least, "a").select("a", F.col("low").alias("b"))
        edges = large.unionByName(kept).where("a <> b").distinct()
        least = edges.groupBy("a").agg(F.min("b").alias("low"))
        down = edges.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
        edges = written(down.select("e.a", "e.b").where("a <> b").distinct(), "stars")
        new = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if new == mark:
            return edges.select(F.col("a").alias("rep"), F.col("b").alias("root"))
        mark = new


def verify(similarity: float, length: int):
    """All pairs of one task by their exact sets: per member the head of its class in the task, and its links.

    A pair that several tasks hold counts in the first of them only.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        task, n = group["task"].iloc[0], len(group)
        sets = [shingles(t, length) for t in group["text"]]
        sizes = np.array([len(s) for s in sets])
        flat, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        number = np.cumsum(np.concatenate([[0], (flat[1:] != flat[:-1]).astype(np.int64)]))
        shared = np.bincount(number)[number] > 1
        columns, owner = np.unique(number[shared], return_inverse=True)[1], owner[shared]
        common = np.zeros((n, n), dtype=np.float32)
        width = max(1, (4 << 20) // n)
        for start in range(0, int(columns[-1]) + 1 if len(columns) else 0, width):
            i, j = np.searchsorted(columns, [start, start + width])
            has = np.zeros((n, width), dtype=np.float32)
            has[owner[i:j], columns[i:j] - start] = 1
            common += has @ has.T
        union = sizes[:, None] + sizes[None, :] - common
        a, b = np.nonzero(np.triu(common >= similarity * union - 1e-6, 1))
        label = components(n, a, b)
        others = group["tasks"].tolist()
        if any(len(x) > 1 for x in others):
            known = [set(x) for x in others]
            own = np.array([min(known[i] & known[j]) == task for i, j in zip(a, b, strict=True)], dtype=bool)
            a, b = a[own], b[own]
        links = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
        reps = group["rep"].to_numpy()
        return pd.DataFrame({"rep": reps, "head": reps[label], "links": links.astype(np.int64)})

    return run


def jaccard_classes(
    docs: DataFrame, similarity: float = 0.8, length: int = 5, recall: float = 0.999, most: int = 1000, depth: int = 3, slack: float = 0.2, seed: int = 5,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Classes of documents joined by word ``length``-gram Jaccard similarity of at least ``similarity``.

    Documents with equal shingle sets are one set. Chosen paths split the sets on shared coordinates of their
    min-wise embedding into leaves of at most ``most`` sets, in as many runs as ``recall`` asks for. In a leaf all
    pairs are compared by embedding; those within ``slack`` of the threshold (four standard deviations) become
    candidates. Groups of candidates that touch are checked as one task by their exact sets; a group above ``most`` is checked leaf by
    leaf instead, so no task holds more. No pair is written out: a task gives its classes and each set's number of links.

    A null or empty text has no shingles: such documents are one class without links. Null ids are kept, the largest
    in their class; rows that repeat an id or a text each get a row; an empty table gives none. Extra columns don't matter.

    Returns per row: the key, text_key (hash of the text), class_id (the smallest id of the class), keeper (the smallest (id, text
    key) of the class), n_links (other sets linked to this one's) and n_copies (rows with this set, itself included).
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("string").alias("doc_id"), F.xxhash64(text_or_empty(text)).alias("text_key"), text_or_empty(text).alias("text"))
    signed = written(texts.mapInPandas(sign(length), SIGNED), "signed", compression="none").withColumn("doc_id", F.col("doc_id").cast("long"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first")
    sets = signed.groupBy("rep").agg(first, F.count("*").alias("copies"), F.any_value("signature").alias("signature"))
    sets = written(sets, "sets", compression="none")

    leaves = leaves_of(sets.where("signature IS NOT NULL"), runs_for(recall, similarity, depth), similarity, most, depth, seed)
    held = leaves.join(sets.select("rep", "signature"), "rep").repartition("leaf").sortWithinPartitions("leaf")
    least_equal = math.ceil((similarity - slack) * COORDINATES)
    grouped = written(held.mapInPandas(candidate_groups(least_equal), "leaf long, head binary, rep binary"), "groups", compression="none")
    near = star_classes(grouped.select(F.col("rep").alias("a"), F.col("head").alias("b")))
    near = near.unionByName(near.select("root").distinct().select(F.col("root").alias("rep"), "root"))
    sizes = near.groupBy("root").agg(F.count("*").alias("members"))
    near = written(near.join(sizes, "root"), "near", compression="none")
    whole = near.where(F.col("members") <= most).select("rep", F.xxhash64("root").alias("task"), F.array(F.xxhash64("root")).alias("tasks"))
    parts = grouped.join(near.where(F.col("members") > most).select("rep"), "rep").select("rep", F.xxhash64("leaf", "head").alias("task")).distinct()
    lists = parts.groupBy("rep").agg(F.collect_list("task").alias("tasks"))
    tasks = whole.unionByName(parts.join(lists, "rep").select("rep", "task", "tasks"))

    wanted = tasks.join(sets.select("rep", "first.doc_id", "first.text_key"), "rep").withColumnsRenamed({"doc_id": "id", "text_key": "its_key"})
    one_text = texts.withColumn("doc_id", F.col("doc_id").cast("long"))
    with_text = one_text.join(wanted, one_text["doc_id"].eqNullSafe(F.col("id")) & (one_text["text_key"] == F.col("its_key")))
    with_text = with_text.select("task", "tasks", "rep", "text")
    checked = with_text.groupBy("task").applyInPandas(_once(verify(similarity, length)), "rep binary, head binary, links long")
    checked = written(checked, "checked", compression="none")
    classes = star_classes(checked.where("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b")))
    links = checked.groupBy("rep").agg(F.sum("links").alias("n_links"))

    sets = sets.select("rep", "first", "copies").join(classes, "rep", "left").join(links, "rep", "left")
    sets = sets.select("rep", "first", "copies", F.coalesce("root", "rep").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    keepers = sets.groupBy("root").agg(F.min("first").alias("keeper"))
    sets = sets.join(keepers, "root").select("rep", "copies", "n_links", "keeper")
    out = signed.select("doc_id", "text_key", "rep").join(sets, "rep")
    return out.select(F.col("doc_id").alias(key), "text_key", F.col("keeper.doc_id").alias("class_id"), "keeper", "n_links", F.col("copies").alias("n_copies"))


def _once(check):
    """Rows that repeat an id and its text bring one set several times."""
    return lambda group: check(group.drop_duplicates("rep"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = jaccard_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return classes.select("doc_id", "class_id", "n_links", "n_copies")
