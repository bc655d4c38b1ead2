"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKEN = re.compile(r"\w+")
# fixed values: scripts written without spaces (Thai, Lao, Burmese, Khmer, kana, Han); each of their letters is a token
UNSPACED = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
TOKEN_OR_LETTER = re.compile(rf"[^\W{UNSPACED}]+|(?=[{UNSPACED}])\w")
LEAKS = "array<struct<item_id: bigint, coverage: double, tiles: array<struct<doc_at: int, item_at: int, length: int>>>>"
BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(text: str | None) -> list[str]:
    """Lower-case words without punctuation; in scripts without spaces, letters."""
    if not text:
        return []
    return (TOKEN if text.isascii() else TOKEN_OR_LETTER).findall(text.lower())


def window_hashes(ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and Karp-Rabin fingerprints (64 bits) of all windows of ``length`` tokens that hold no id 0."""
    n = len(ids) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    unknown = np.concatenate([[0], np.cumsum(ids == 0)])
    at = np.flatnonzero(unknown[length:] == unknown[:n])
    out = np.zeros(len(at), dtype=np.uint64)
    for i in range(length):
        out = out * BASE + ids[at + i]
    return at, out


def tile(doc: list[str], item: list[str], starts: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (doc_at, item_at, length) of the longest matches first, none overlapping in either text.

    ``starts`` are the places (doc, item) of equal windows of ``least`` tokens. Windows that follow each other on
    a diagonal form a maximal match, found by comparing tokens. The longest is marked; a match of which a part has been
    marked meanwhile comes back with what is left of it, while that is ``least`` tokens or more.
    """
    diagonals = defaultdict(list)
    for i, j in starts:
        if doc[i : i + least] == item[j : j + least]:
            diagonals[i - j].append(i)
    matches = []
    for shift, places in diagonals.items():
        places.sort()
        first = last = places[0]
        for i in [*places[1:], None]:
            if i is not None and i <= last + 1:
                last = i
                continue
            heapq.heappush(matches, (-(last - first + least), first, first - shift))
            if i is not None:
                first = last = i
    doc_marks, item_marks = set(), set()
    tiles = []
    while matches:
        length, i, j = heapq.heappop(matches)
        free = [k for k in range(-length) if i + k not in doc_marks and j + k not in item_marks]
        if len(free) == -length:
            doc_marks.update(range(i, i - length))
            item_marks.update(range(j, j - length))
            tiles.append((i, j, -length))
            continue
        run = 0
        for at, k in enumerate(free):
            run = run + 1 if at and free[at - 1] == k - 1 else 1
            if run >= least and (at + 1 == len(free) or free[at + 1] != k + 1):
                heapq.heappush(matches, (-run, i + k - run + 1, j + k - run + 1))
    return tiles


class Items:
    """A block of benchmark items: token ids (words that no item has are 0), and sorted fingerprints of all windows.

    An item shorter than a window has one window, itself; windows are kept by their length.
    """

    def __init__(self, rows: list[tuple[int, str]], least: int):
        self.ids = [item for item, _ in rows]
        self.tokens = [tokens_of(text) for _, text in rows]
        self.words: dict[str, int] = {}
        for tokens in self.tokens:
            for token in tokens:
                self.words.setdefault(token, len(self.words) + 1)
        self.least = [min(least, len(tokens)) for tokens in self.tokens]
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in sorted({n for n in self.least if n}):
            owners = [i for i, n in enumerate(self.least) if n == length]
            found = [window_hashes(self.numbered(self.tokens[i]), length) for i in owners]
            flat = np.concatenate([h for _, h in found])
            order = np.argsort(flat, kind="stable")
            owner = np.repeat(owners, [len(h) for _, h in found])[order]
            self.windows[length] = flat[order], owner, np.concatenate([at for at, _ in found])[order]

    def numbered(self, tokens: list[str]) -> np.ndarray:
        return np.fromiter(map(self.words.get, tokens, repeat(0)), dtype=np.uint64, count=len(tokens))

    def judge(self, text: str | None, least_coverage: float) -> list[dict]:
        doc = tokens_of(text)
        numbers = self.numbered(doc)
        starts = defaultdict(list)
        for length, (hashes, owner, place) in self.windows.items():
            at, own = window_hashes(numbers, length)
            low, high = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
            for w in np.flatnonzero(high > low):
                for k in range(low[w], high[w]):
                    starts[int(owner[k])].append((int(at[w]), int(place[k])))
        found = []
        for item, places in starts.items():
            tokens, least = self.tokens[item], self.least[item]
            if len({j + k for _, j in places for k in range(least)}) < least_coverage * len(tokens):
                continue  # what no seed touches can't be covered
            tiles = tile(doc, tokens, places, least)
            coverage = sum(n for *_, n in tiles) / len(tokens)
            if coverage >= least_coverage:
                found.append({"item_id": self.ids[item], "coverage": coverage, "tiles": [dict(zip(("doc_at", "item_at", "length"), t, strict=True)) for t in tiles]})
        return found


def _judge(items: Broadcast, least_coverage: float):
    @F.pandas_udf(LEAKS)
    def judge(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in series:
            yield pd.Series([items.value.judge(t, least_coverage) for t in part])

    return judge


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, least_tokens: int = 5, least_coverage: float = 0.5, block_chars: int = 32 << 20, into: str = "leaks", text: str = "text"
) -> DataFrame:
    """Add the array ``into`` (item_id, coverage, tiles) of the benchmark items that each row of ``docs`` gives away.

    Items are the stated query set: they come to the tasks in blocks of ``block_chars`` characters, each broadcast and
    held against all rows, so a benchmark of any size is covered and no row of ``docs`` moves. Windows of ``least_tokens``
    tokens (lower case, without punctuation) that a document shares with an item are the seeds; tiling then covers the
    item with the longest matches, in any order, and the item counts as leaked if its tiles hold ``least_coverage`` of its
    tokens. A passage that many documents share costs each of them the same.

    A script without spaces is cut into letters. An item of fewer tokens than a window is its own window, so it is found where it
    stands whole; with an item of one word that is every text with this word.

    A null or empty text leaks nothing; an item without a token is never found; repeated items each show up; an empty
    benchmark or table leaks nothing. Other columns pass by.
    """
    spark = docs.sparkSession
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", F.col("text").alias("item_text"))
    running = F.pmod(F.xxhash64("item_id", "item_text"), F.lit(1 << 30))
    blocks = max(1, -(-(items.agg(F.coalesce(F.sum(F.length("item_text")), F.lit(0))).first()[0]) // block_chars))
    parts = []
    for block in range(blocks):
        rows = [tuple(r) for r in items.where(running % blocks == block).select("item_id", "item_text").collect()]
        items_here = Items(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1])), least_tokens)
        parts.append(_judge(spark.sparkContext.broadcast(items_here), least_coverage)(F.col(text)))
    return docs.withColumn(into, F.concat(*parts))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that it gives away."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    leaks = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return leaks.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.item_id", "leak.coverage", F.size("leak.tiles").alias("n_tiles"))
