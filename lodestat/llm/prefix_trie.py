"""Prefix trie of conversations; what its subtrees hold comes from an Euler tour ranked as a list."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestat.llm.common import text_or_empty, written
from lodestat.operators.ordered import SLICE, previous_row, row_numbers, running_totals, sliced

CHUNK = 4096


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, n (from 1, by turn, null first), t1, t2 (128-bit hash of role and text), bytes (of the text).

    Turns with one number are ordered by role and the text's SHA-256, so that no text travels. A null role or text is
    empty; rows without a conv_id belong to no conversation and go.
    """
    role, text = text_or_empty("role"), text_or_empty("text")
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        # the place tells repeated rows apart, so that many of them don't meet in one slice; their order doesn't show
        F.struct(role.alias("role"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("text"), F.monotonically_increasing_id().alias("at")).alias("tie"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    rows = row_numbers(rows, "turn", "tie", ["conv_id"], "n")
    return written(rows.select("conv_id", "n", F.xxhash64("tie.role", "tie.text").alias("t1"), F.xxhash64(F.lit("second"), "tie.role", "tie.text").alias("t2"), "bytes"), "turns")


def rebuilt(turns: DataFrame, family: int = 5, most_heads: int = 9) -> DataFrame:
    """Every conversation c as the first h turns of c - c % family, then its own turns after its first h: conv_id, pos, t1, t2, bytes.

    h is the CRC-32 of c's decimals modulo ``most_heads``; the remainder of a negative c is negative. A conversation that is left without a turn has no row here.
    """
    convs = turns.groupBy(F.col("conv_id").alias("c")).agg(F.lit(1).alias("one")).select(
        "c", (F.col("c") - F.col("c") % family).alias("base"), (F.crc32(F.col("c").cast("string").cast("binary")) % most_heads).alias("h")
    )
    heads = turns.where((F.col("n") < most_heads) & (F.col("conv_id") % family == 0))
    first = convs.join(heads, (F.col("base") == F.col("conv_id")) & (F.col("n") <= F.col("h")))
    first = first.select(F.col("c").alias("conv_id"), F.col("n").alias("pos"), "t1", "t2", "bytes")
    lengths = heads.groupBy(F.col("conv_id").alias("of")).agg(F.max("n").alias("length"))
    convs = convs.join(lengths, F.col("base") == F.col("of"), "left").select("c", "h", F.least("h", F.coalesce("length", F.lit(0))).alias("shift"))
    rest = turns.join(convs, (F.col("conv_id") == F.col("c")) & (F.col("n") > F.col("h")))
    return first.unionByName(rest.select("conv_id", (F.col("n") - F.col("h") + F.col("shift")).alias("pos"), "t1", "t2", "bytes"))


def prefixes(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, pos, t1, t2, bytes) with the identity of the prefix that ends there (k1, k2) and of the one before (p1, p2).

    A prefix is known by the XOR of the hashes of (place, turn) over its turns: 128 bits, and 0 for the empty prefix. XORs of slices
    are handed over like running totals, so a conversation of any length is cut among tasks.
    """
    step = {f"s{i}": F.xxhash64(F.lit(i), "pos", "t1", "t2") for i in (1, 2)}
    table = sliced(turns.withColumns(step).select("conv_id", "pos", "bytes", *step), ["conv_id", "pos"])
    inside = Window.partitionBy("conv_id", SLICE).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = table.withColumns({f"in{i}": F.bit_xor(f"s{i}").over(inside) for i in (1, 2)})
    ends = table.groupBy("conv_id", SLICE).agg(*(F.bit_xor(f"s{i}").alias(f"all{i}") for i in (1, 2)))
    earlier = Window.partitionBy("conv_id").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("conv_id", SLICE, *(F.coalesce(F.bit_xor(f"all{i}").over(earlier), F.lit(0)).alias(f"before{i}") for i in (1, 2)))
    k = {f"k{i}": F.col(f"in{i}").bitwiseXOR(F.col(f"before{i}")) for i in (1, 2)}
    rows = rows.join(ends, ["conv_id", SLICE]).withColumns(k)
    return rows.select("conv_id", "pos", "bytes", "k1", "k2", *(F.col(f"k{i}").bitwiseXOR(F.col(f"s{i}")).alias(f"p{i}") for i in (1, 2)))


def build_trie(turns: DataFrame, conv_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie of rebuilt turns (conv_id, pos, t1, t2, bytes) and of ``conv_ids`` (conv_id), which may have no turn.

    Returns nodes (node 0.., conv_id: smallest member, depth, parent: its node, parent_conv_id, n_convs, bytes) and ends
    (node, conv_id: the conversations that end there). The root has depth 0 and stands even where it has no child.
    """
    roots = conv_ids.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("bytes"), *(F.lit(0).cast("long").alias(c) for c in ("k1", "k2", "p1", "p2")))
    steps = written(prefixes(turns).withColumn("pos", F.col("pos").cast("long")).unionByName(roots), "prefixes")
    nodes = steps.groupBy(F.col("pos").alias("depth"), "k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("bytes").alias("bytes"), F.min("p1").alias("p1"), F.min("p2").alias("p2")
    )
    # nodes with one smallest member differ in depth, so (conv_id, depth) is their order
    nodes = written(row_numbers(nodes, "conv_id", "depth", name="node").withColumn("node", F.col("node") - 1), "nodes")
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    )
    linked = nodes.join(above, ["depth", "p1", "p2"], "left")
    last = steps.groupBy("conv_id").agg(F.max(F.struct("pos", "k1", "k2")).alias("last")).select("conv_id", "last.*")
    ends = last.join(nodes.select("node", F.col("depth").alias("pos"), "k1", "k2"), ["pos", "k1", "k2"]).select("node", "conv_id")
    return written(linked.select("node", "conv_id", "depth", "parent", "parent_conv_id", "n_convs", "bytes"), "trie"), ends


def euler_tour(nodes: DataFrame) -> DataFrame:
    """Arcs of the depth-first tour as a linked list: arc, next (null at the end). Arc 2v enters node v, arc 2v + 1 leaves it.

    From v the tour enters its child with the largest number, after a node the next smaller child of its parent, after the
    smallest child it leaves the parent. The siblings of one parent are ordered in slices, however many they are.
    """
    first = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(F.max("node").alias("child"))
    enter = nodes.join(first, F.col("node") == F.col("of"), "left").select((F.col("node") * 2).alias("arc"), F.coalesce(F.col("child") * 2, F.col("node") * 2 + 1).alias("next"))
    siblings = previous_row(nodes.where("parent IS NOT NULL").select("node", "parent"), "node", {"sibling": "node"}, ["parent"])
    leave = siblings.select((F.col("node") * 2 + 1).alias("arc"), F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1).alias("next"))
    end = nodes.where("parent IS NULL").select((F.col("node") * 2 + 1).alias("arc"), F.lit(None).cast("long").alias("next"))
    return enter.unionByName(leave).unionByName(end)


def _rank_short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ranks of a whole short list by pointer doubling: the places from the list's start."""
    if parts := [rows for rows in batches if len(rows)]:
        rows = pd.concat(parts, ignore_index=True)
        ids = rows["id"].to_numpy(np.int64)
        order = np.argsort(ids)
        end = len(ids)
        follows = rows["next"].notna().to_numpy()
        jump = np.full(end + 1, end)
        jump[:end][follows] = order[np.searchsorted(ids, rows["next"][follows].to_numpy(np.int64), sorter=order)]
        left = np.append(rows["length"].to_numpy(np.int64), 0)
        for _ in range(end.bit_length()):
            left, jump = left + left[jump], jump[jump]
        if (jump != end).any():
            raise ValueError("next doesn't form one list")
        yield pd.DataFrame({"id": ids, "rank": left.max() - left[:end]})


def list_rank(links: DataFrame, most_short: int = 1 << 14, seed: int = 11, most_rounds: int = 200) -> DataFrame:
    """The place (0..) of every element of one linked list: id, rank, from rows (id, next), next null at the end.

    Rounds of random mating: every element tosses a coin by hash; one with heads whose next has tails takes it over, with
    its length. A quarter of the elements goes in a round, so all rounds together move a bounded multiple of the list,
    and what is left after a logarithmic number of rounds fits ``most_short`` rows, which one task ranks. Then the rounds
    are undone from last to first: an element stands as far behind its taker as was noted. Every round is written to the shared folder.
    """
    rows = written(links.select(F.col("id").cast("long"), F.col("next").cast("long"), F.lit(1).cast("long").alias("length")), "list")
    taken: list[DataFrame] = []
    while (n := rows.count()) > most_short:
        if len(taken) == most_rounds:
            raise RuntimeError(f"{n} elements are left after {most_rounds} rounds; next doesn't form one list")
        heads = F.xxhash64(F.lit(seed + len(taken)), "id") % 2 == 0
        takers = rows.where(heads)
        mates = rows.where(~heads).select(F.col("id").alias("mate"), F.col("next").alias("mate_next"), F.col("length").alias("mate_length"))
        # rows that find nobody stay: takers as they are, mates as elements of their own
        pairs = written(takers.join(mates, F.col("next") == F.col("mate"), "full"), "list-pairs")
        both = F.col("id").isNotNull() & F.col("mate").isNotNull()
        taken.append(pairs.where(both).select(F.col("mate").alias("id"), F.col("id").alias("taker"), F.col("length").alias("behind")))
        rows = pairs.select(
            F.coalesce("id", "mate").alias("id"),
            F.when(F.col("mate").isNull(), F.col("next")).otherwise(F.col("mate_next")).alias("next"),
            (F.coalesce("length", F.lit(0)) + F.coalesce("mate_length", F.lit(0))).alias("length"),
        )
    ranks = rows.repartition(1).mapInPandas(_rank_short, "id long, rank long")
    for gone in reversed(taken):
        ranks = written(ranks, "ranks")
        of = ranks.select(F.col("id").alias("taker"), F.col("rank").alias("taker_rank"))
        ranks = ranks.unionByName(gone.join(of, "taker").select("id", (F.col("taker_rank") + F.col("behind")).alias("rank")))
    return written(ranks, "ranks")


def subtree_sums(nodes: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """node and the sum of every measure over its subtree, itself included: differences of prefix sums along the tour."""
    names = list(measures)
    arcs = list_rank(euler_tour(nodes).withColumnRenamed("arc", "id"))
    values = nodes.select((F.col("node") * 2).alias("arc"), *(c.alias(name) for name, c in measures.items()))
    tour = arcs.join(values, F.col("id") == F.col("arc"), "left").select("id", "rank", *(F.coalesce(name, F.lit(0)).alias(name) for name in names))
    sums = running_totals(tour, "rank", names)
    leaves = F.col("id") % 2 == 1
    span = lambda name: F.sum(F.when(leaves, F.col(f"cum_{name}")).otherwise(F.col(name) - F.col(f"cum_{name}"))).cast("long").alias(name)
    return sums.groupBy(F.floor(F.col("id") / 2).alias("node")).agg(*map(span, names))


def trie_measures(nodes: DataFrame) -> DataFrame:
    """Nodes with n_children, n_leaves and saved_tokens."""
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = written(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "trie-children")
    measures = {"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")}
    return counted.join(subtree_sums(counted, measures), "node")


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of every node's chunks, comma-joined, from rows sorted by node and place; one chunk is in memory at a time."""
    node, state = None, None
    for rows in batches:
        out = []
        for at, chunk in zip(rows["node"].to_numpy(), rows["ids"], strict=True):
            if at != node:
                if node is not None:
                    out.append((node, state.hexdigest()))
                node, state = at, hashlib.sha256()
                state.update(chunk.encode())
            else:
                state.update(b"," + chunk.encode())
        yield pd.DataFrame(out, columns=["node", "digest"])
    if node is not None:
        yield pd.DataFrame([(node, state.hexdigest())], columns=["node", "digest"])


def ends_digest(ends: DataFrame, keys: Sequence[str] = ("node", "conv_id")) -> DataFrame:
    """node, digest: SHA-256 of the ascending, comma-joined ids that end there.

    Ids are sorted in slices and joined to chunks of ``CHUNK`` ids; a node's chunks, few rows even for a third of all
    conversations, are then read as a stream in order.
    """
    node, conv = keys
    table = sliced(ends.select(F.col(node).alias("node"), F.col(conv).alias("conv_id")), ["node", "conv_id"])
    inside = Window.partitionBy("node", SLICE).orderBy("conv_id")
    chunks = table.withColumn("chunk", F.floor((F.row_number().over(inside) - 1) / CHUNK))
    ids = F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",")
    chunks = chunks.groupBy("node", SLICE, "chunk").agg(ids.alias("ids"))
    dealt = chunks.repartition(F.col("node")).sortWithinPartitions("node", SLICE, "chunk")
    return dealt.select("node", "ids").mapInPandas(_digests, "node long, digest string")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations without a conv_id go; an empty table has no node. Extra columns aren't read."""
    turns = numbered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    nodes, ends = build_trie(rebuilt(turns), turns.groupBy("conv_id").agg(F.lit(1).alias("one")))
    found = trie_measures(nodes).join(ends_digest(ends), "node", "left")
    nobody = F.sha2(F.lit("").cast("binary"), 256)
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("digest", nobody).alias("ends_sha256"))


# CRC-32 bit by bit: the SQL engine has no such function
OP12_SQL = """
WITH RECURSIVE turns AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), ids AS (
    SELECT DISTINCT conv_id FROM turns
), bits AS (
    SELECT conv_id, 4294967295::BIGINT AS crc, 0 AS done FROM ids
    UNION ALL
    SELECT conv_id, list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END, xor(crc, ascii(substr(conv_id::VARCHAR, done + 1, 1))::BIGINT)), done + 1
    FROM bits WHERE done < length(conv_id::VARCHAR)
), convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, xor(crc, 4294967295::BIGINT) % 9 AS h FROM bits WHERE done = length(conv_id::VARCHAR)
), rebuilt AS (
    SELECT c.conv_id, t.n AS pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.n <= c.h
    UNION ALL
    SELECT c.conv_id, t.n + 1000, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.n > c.h
), steps AS (
    SELECT conv_id, row_number() OVER w AS depth, array_agg({'role': role, 'text': text}) OVER w AS prefix, octet_length(encode(text)) AS bytes
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING)
    UNION ALL
    SELECT conv_id, 0, [], 0 FROM ids
), placed AS (
    SELECT conv_id, depth, bytes, min(conv_id) OVER (PARTITION BY depth, prefix) AS node FROM steps
), lengths AS (
    SELECT conv_id, max(depth) AS depth FROM placed GROUP BY conv_id
), nodes AS (
    SELECT node, depth, count(*) AS n_convs, any_value(bytes) AS bytes FROM placed GROUP BY node, depth
), parents AS (
    SELECT n.node, n.depth, n.n_convs, n.bytes, p.node AS parent FROM nodes n LEFT JOIN placed p ON p.conv_id = n.node AND p.depth = n.depth - 1
), children AS (
    SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY 1, 2
), counted AS (
    SELECT p.*, coalesce(c.n_children, 0) AS n_children FROM parents p LEFT JOIN children c USING (node, depth)
), sums AS (
    SELECT a.node, a.depth, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.bytes)::BIGINT AS saved_tokens
    FROM counted b JOIN placed a ON a.conv_id = b.node AND a.depth <= b.depth GROUP BY a.node, a.depth
), ends AS (
    SELECT p.node, p.depth, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) AS ids FROM placed p JOIN lengths USING (conv_id, depth) GROUP BY p.node, p.depth
)
SELECT c.node AS conv_id, c.depth, c.parent AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM counted c JOIN sums s USING (node, depth) LEFT JOIN ends e USING (node, depth)
"""
