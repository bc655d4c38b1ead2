"""Katz backoff n-gram scoring.

Texts are cut into chunks of about a million tokens. A chunk asks by hash bucket for the counts of its distinct words, then order by
order of its distinct n-grams; a bucket adds up what all chunks bring, stores its part of the model, and answers every chunk. So a
word or pair comes once per chunk, however often it occurs, and no occurrence crosses the network.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm.common import id_remainder, new_path, parts_for, shuffles_dropped, text_or_empty, written

K = 5  # counts up to K are discounted
ORDER = 3  # of the registered query
END = np.uint64(xxhash.xxh64_intdigest(b" end"))  # no word holds a blank
UNKNOWN_ID, START_ID = np.uint64(0), np.uint64(1)
PACKER, UNPACKER = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()

LAST = np.array([-1])  # the end of a text, before it has a number

CHUNKS = "chunk long, ids array<string>, held array<boolean>, lengths binary, types binary, counts binary, tokens binary"
ASKS = "bucket int, chunk long, a binary, b binary, c binary, d binary, e binary"
TELLS = "kind string, bucket int, chunk long, a binary, b binary, c binary, d binary, e binary"
ANSWERS = ["bucket", "chunk", "a", "b", "c", "d", "e"]
SCORES = "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def u64(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint64)


def u32(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint32)


def planes(x: np.ndarray) -> bytes:
    """Four-byte numbers with equal bytes beside each other: small numbers then compress well."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    return x * np.uint64(0xD6E8FEB86659FD93)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Rises with the hash, so a bucket is a range of hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def discounts(n: np.ndarray) -> np.ndarray:
    """Katz's factors for counts 1..K from n[r], the number of n-grams that occur r times (r up to K + 1).

    Good-Turing estimates below the largest cut-off for which all of them lie between 0 and 1; where no cut-off gives
    that (few or odd counts), absolute discounting by n1 / (n1 + 2 n2), or by a half without such counts.
    """
    for k in range(K, 0, -1):
        if (n[1 : k + 2] > 0).all():
            r = np.arange(1, k + 1)
            common = (k + 1) * n[k + 1] / n[1]
            if common < 1:
                d = ((r + 1) * n[2 : k + 2] / (n[1 : k + 1] * r) - common) / (1 - common)
                if ((d > 0) & (d < 1)).all():
                    return np.concatenate([d, np.ones(K - k)])
    cut = n[1] / (n[1] + 2 * n[2]) if n[1] > 0 and n[2] > 0 else 0.5
    r = np.arange(1, K + 1)
    return (r - cut) / r


@dataclass
class Unigrams:
    """The lowest order: counts, and the probability of a word by its count; all unknown words are one event."""

    tokens: int
    types: int
    texts: int
    factor: np.ndarray
    left: float  # probability of the unknown word
    bottom: float  # what counts are divided by

    @classmethod
    def from_counts(cls, tokens: int, types: int, texts: int, n: np.ndarray) -> "Unigrams":
        factor = discounts(n)
        cut = float(((1 - factor) * np.arange(1, K + 1) * n[1 : K + 1]).sum())
        bottom = tokens if cut > 0 else tokens + 1
        return cls(tokens, types, texts, factor, (cut if cut > 0 else 1.0) / bottom, float(bottom))

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.factor) / self.bottom, self.left)


def discounted(counts: np.ndarray, factor: np.ndarray) -> np.ndarray:
    return counts * np.concatenate([[1.0], factor, [1.0]])[np.minimum(counts, K + 1)]


class Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def cut_chunks(chunk_tokens: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, n_chunks = TaskContext.get().partitionId() << 32, 0
        types = Numbers()
        ids, held, lengths, tokens = [], [], [], []
        n = 0

        def flush() -> pd.DataFrame:
            nonlocal n, n_chunks, types, ids, held, lengths, tokens
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, types), dtype=np.uint64, count=len(types))
            hashes = np.append(hashes, END)
            local = np.concatenate(tokens)
            local[local < 0] = len(types)
            order = np.lexsort((hashes, -np.bincount(local)))  # frequent words get small numbers, the many equally rare ones rise with their hashes
            place = np.empty(len(order), dtype=np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            local = place[local]
            trains = np.repeat(~np.array(held), lengths)
            counts = np.bincount(local[trains], minlength=len(order)).astype(np.uint32)
            row = (first + n_chunks, ids, held, np.array(lengths, np.uint32).tobytes(), rising(hashes[order]), counts.tobytes(), planes(local))
            n, n_chunks, types, ids, held, lengths, tokens = 0, n_chunks + 1, Numbers(), [], [], [], []
            return pd.DataFrame([row], columns=names(CHUNKS))

        for batch in batches:
            for doc, text, out in zip(batch["id"], batch["text"], batch["held"], strict=True):
                words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
                local = np.fromiter(map(types.__getitem__, words), dtype=np.int64, count=len(words))
                ids.append(doc)
                held.append(bool(out))
                lengths.append(len(words) + 1)
                tokens += [local, LAST]
                n += len(words) + 1
                if n >= chunk_tokens:
                    yield flush()
        if ids:
            yield flush()

    return run


def ask_words(buckets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, types, counts in zip(batch["chunk"], batch["types"], batch["counts"], strict=True):
                hashes = np.cumsum(wide(types))
                order = np.argsort(hashes)
                types, counts = hashes[order], u32(counts)[order]
                edges = np.searchsorted(bucket_of(types, buckets), np.arange(buckets + 1, dtype=np.uint64))
                rows = [(b, chunk, types[i:j].tobytes(), narrow(counts[i:j]), None, None, None) for b, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if j > i]
                yield pd.DataFrame(rows, columns=names(ASKS))

    return run


def tell_words(buckets: int):
    """Word counts of a bucket: the vocabulary with its ids (frequent words first), and each chunk's answers."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        bucket = int(group["bucket"].iloc[0])
        asked = [u64(a) for a in group["a"]]
        types, at = np.unique(np.concatenate(asked), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([wide(b) for b in group["b"]])).astype(np.uint64)
        order = np.argsort(-counts.astype(np.int64), kind="stable")
        places = np.empty(len(types), dtype=np.uint64)
        places[order] = np.arange(len(types), dtype=np.uint64)
        ids, known = places * np.uint64(buckets) + np.uint64(bucket + 2), counts > 0
        n = np.bincount(counts[counts <= K + 1].astype(np.int64), minlength=K + 2)
        stats = np.array([counts.sum(), known.sum(), *n], dtype=np.int64)
        rows = [("model", bucket, None, types[known].tobytes(), narrow(ids[known]), narrow(counts[known]), stats.tobytes(), None)]
        for chunk, part in zip(group["chunk"], np.split(at, np.cumsum([len(a) for a in asked])[:-1]), strict=True):
            by_count = part[np.argsort(-counts[part].astype(np.int64), kind="stable")]  # as the ids, so these rise
            rows.append(("answer", bucket, chunk, rising(places[by_count[counts[by_count] > 0]]), narrow(counts[part]), None, None, None))
        return pd.DataFrame(rows, columns=names(TELLS))

    return run


def told_words(places: bytes, counts: bytes, bucket: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and counts of the words that a chunk asked of a bucket."""
    counts = wide(counts).astype(np.int64)
    by_count = np.argsort(-counts, kind="stable")
    ids = np.full(len(counts), UNKNOWN_ID)
    ids[by_count[counts[by_count] > 0]] = np.cumsum(wide(places)) * np.uint64(buckets) + np.uint64(bucket + 2)
    return ids, counts


class Chunk:
    """A chunk with the ids and counts of its words, taken from order to order.

    At every position stand its token's count and log probability in the order reached, and the context of the next
    order, which is known if it was trained; the n-grams asked for are the distinct (context, word) at known contexts.
    """

    def __init__(self, row: pd.Series, answers: pd.DataFrame, low: Unigrams, buckets: int, hot: int):
        self.ids, self.held, self.lengths = row["ids"], np.array(row["held"], dtype=bool), u32(row["lengths"]).astype(np.int64)
        self.buckets, self.most = buckets, hot
        answers, order = answers.sort_values("bucket"), np.argsort(np.cumsum(wide(row["types"])))
        word_ids, word_counts = np.empty(len(order), dtype=np.uint64), np.empty(len(order), dtype=np.int64)
        told = [told_words(a, b, bucket, buckets) for a, b, bucket in zip(answers["a"], answers["b"], answers["bucket"], strict=True)]
        word_ids[order], word_counts[order] = (np.concatenate(x) for x in zip(*told, strict=True))
        tokens = from_planes(row["tokens"]).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.trains = ~np.repeat(self.held, self.lengths)
        # contexts and words by local numbers that rise with the ids; the start of a text is one more context, all unknown words are one word
        self.start, by_id = len(word_ids), np.argsort(word_ids, kind="stable")
        rank = np.empty(self.start, dtype=np.int64)
        rank[by_id] = np.arange(self.start)
        self.word = np.where(word_counts > 0, rank, self.start)[tokens]
        self.word_id = np.append(word_ids[by_id], UNKNOWN_ID)[self.word]
        self.word_count = self.count = word_counts[tokens]
        self.bottom = np.full(len(tokens), low.bottom)  # what the counts of the order reached are divided by
        self.logs = np.log10(low.probability(word_counts))[tokens]
        self.context, self.contexts = np.concatenate([[0], rank[tokens[:-1]] + 1]), self.start + 1
        self.context[self.starts] = 0
        self.context_id, self.context_count = np.append(START_ID, word_ids[by_id])[self.context], np.append(low.texts, word_counts[by_id])[self.context]

    def find_grams(self) -> None:
        """The distinct n-grams of the next order, and the order in which they are asked."""
        self.known = np.flatnonzero(self.context_count > 0)
        grams = self.context[self.known] * (self.start + 1) + self.word[self.known]
        order = np.argsort(grams)
        new = np.zeros(len(grams), dtype=bool)
        new[first_of_runs(grams[order])] = True
        self.gram_at = np.empty(len(grams), dtype=np.int64)
        self.gram_at[order] = np.cumsum(new) - 1
        first = self.known[order[new]]
        self.v_at, self.v_id, self.v_count, self.w_id = (x[first] for x in (self.context, self.context_id, self.context_count, self.word_id))
        self.low_count, self.low_log, self.low_bottom = (x[first] for x in (self.count, self.logs, self.bottom))
        self.hot = self.v_count > self.most  # the n-grams of such a context are spread over all buckets
        self.bucket = (self.v_id % np.uint64(self.buckets)).astype(np.min_scalar_type(self.buckets))
        self.bucket[self.hot] = bucket_of(mixed(self.v_id[self.hot] + mixed(self.w_id[self.hot] + np.uint64(7))), self.buckets)
        self.order = np.argsort(self.bucket, kind="stable")
        self.trained = np.bincount(self.gram_at[self.trains[self.known]], minlength=len(first))

    def rise(self, counts: np.ndarray, bottoms: np.ndarray, logs: np.ndarray, ids: np.ndarray | None) -> None:
        """Take what was told of the n-grams; each trained n-gram is the context of the position after it, except over a text's start."""
        gram, count, bottom = (np.zeros(len(self.logs), dtype=np.int64) for _ in range(3))
        gram[self.known], count[self.known], bottom[self.known] = self.gram_at, counts[self.gram_at], bottoms[self.gram_at]
        self.logs = self.logs.copy()
        self.logs[self.known] = logs[self.gram_at]
        self.count, self.bottom = count, bottom
        if ids is None:  # the highest order is no context
            return
        gram_id = np.zeros(len(self.logs), dtype=np.uint64)
        gram_id[self.known] = ids[self.gram_at]
        self.context, self.contexts = np.concatenate([[0], gram[:-1]]), len(counts)
        self.context_id = np.concatenate([gram_id[:1], gram_id[:-1]])
        self.context_count = np.concatenate([[0], count[:-1]])
        self.context_count[self.starts] = 0


def first_of_runs(*keys: np.ndarray) -> np.ndarray:
    new = np.zeros(len(keys[0]), dtype=bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def ask_grams(low: Unigrams, told: list["Told"], buckets: int, hot: int):
    """The n-grams one order above those told."""

    def run(chunks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, row in chunks.iterrows():
            c = risen(row, answers, low, told, buckets, hot)
            c.find_grams()
            o = c.order
            bucket, v, w, low_count, trained, is_hot = c.bucket[o], c.v_id[o], c.w_id[o], np.where(c.trained > 0, c.low_count, 0)[o], c.trained[o], c.hot[o]
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            for b, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                if j > i:
                    runs = first_of_runs(v[i:j])
                    times = 2 * np.diff(np.append(runs, j - i)) + is_hot[i:j][runs]  # the last bit says hot
                    rows.append((b, row["chunk"], pack_ids(v[i:j][runs], buckets), narrow(times), narrow(w[i:j]), narrow(low_count[i:j]), narrow(trained[i:j])))
        return pd.DataFrame(rows, columns=names(ASKS))

    return run


def narrow(x: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes each in which all fit (the first byte says how many), equal bytes beside each other and packed."""
    size = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return bytes([size]) + PACKER.compress(x.astype("<u8").view(np.uint8).reshape(-1, 8).T[:size].tobytes())


def wide(data: bytes) -> np.ndarray:
    rows = np.frombuffer(UNPACKER.decompress(data[1:]), dtype=np.uint8).reshape(data[0], -1)
    out = np.zeros((rows.shape[1], 8), dtype=np.uint8)
    out[:, : data[0]] = rows.T
    return out.view("<u8").ravel()


def rising(x: np.ndarray) -> bytes:
    """Rising whole numbers by their steps; where they fall, a step takes eight bytes and wraps."""
    return narrow(np.diff(x.astype(np.uint64), prepend=np.uint64(0)))


def pack_ids(ids: np.ndarray, buckets: int) -> bytes:
    """Rising ids, most of them of one bucket: the places in the buckets by their steps, then the buckets."""
    places = rising(ids // np.uint64(buckets))
    return len(places).to_bytes(4, "little") + places + narrow(ids % np.uint64(buckets))


def unpack_ids(data: bytes, buckets: int) -> np.ndarray:
    cut = 4 + int.from_bytes(data[:4], "little")
    return np.cumsum(wide(data[4:cut])) * np.uint64(buckets) + wide(data[cut:])


def pack(made: np.ndarray) -> bytes:
    """What contexts' weights are made of: the probabilities as they are, then the whole numbers narrow."""
    return len(made).to_bytes(4, "little") + made[:, K + 1].tobytes() + narrow(made[:, : K + 1].astype(np.uint64).ravel(order="F"))


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    return np.column_stack([wide(data[4 + 8 * n :]).reshape(K + 1, n).T.astype(np.float64), np.frombuffer(data, dtype=np.float64, count=n, offset=4)])


def tell_grams(low_factor: np.ndarray, buckets: int, last: bool):
    """N-gram counts of a bucket, each chunk's answers, and for contexts what their backoff weight is made of.

    Trained n-grams are numbered, as contexts of the next order, by bucket and place in it, unless this order is the last.

    Per context: the number of its followers seen 1..K times, the sum of larger counts, and the discounted lower-order
    counts of all followers; what the lower order divides them by is known to the chunks. They go to the chunks that meet an unseen follower of it; for a hot context, whose
    followers lie in all buckets, every bucket tells its part once.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        bucket = int(group["bucket"].iloc[0])
        contexts, lengths = [unpack_ids(a, buckets) for a in group["a"]], [wide(b).astype(np.int64) for b in group["b"]]
        times = [x >> 1 for x in lengths]
        vs, v_at = np.unique(np.concatenate(contexts), return_inverse=True)
        asked = np.repeat(v_at, np.concatenate(times))
        words = np.concatenate([wide(c) for c in group["c"]])
        n_words = words.max() + np.uint64(1)
        pairs, at = np.unique(asked.astype(np.uint64) * n_words + words, return_inverse=True)
        trained = np.concatenate([wide(e) for e in group["e"]])
        counts = np.bincount(at, weights=trained).astype(np.int64)
        low_counts = np.zeros(len(pairs), dtype=np.int64)
        low_counts[at[trained > 0]] = np.concatenate([wide(d) for d in group["d"]])[trained > 0]  # told with trained n-grams only
        v_of, seen = (pairs // n_words).astype(np.int64), counts > 0
        made = np.zeros((len(vs), K + 2))
        for r in range(1, K + 1):
            made[:, r - 1] = np.bincount(v_of[counts == r], minlength=len(vs))
        made[:, K] = np.bincount(v_of[counts > K], weights=counts[counts > K], minlength=len(vs))
        # a trained n-gram's lower n-gram is trained too
        made[:, K + 1] = np.bincount(v_of[seen], weights=discounted(low_counts[seen], low_factor), minlength=len(vs))
        few = ((made[:, :K] > 0) << np.arange(K)).sum(axis=1).astype(np.uint8)  # which small counts a context has
        stats = np.bincount(counts[(counts > 0) & (counts <= K + 1)], minlength=K + 2)
        # per context its id and number of followers, then the followers' ids and counts
        kept, followers = np.unique(v_of[seen], return_counts=True)
        model = (pairs[seen] % n_words, counts[seen])
        rows = [("model", bucket, None, pack_ids(vs[kept], buckets), *(narrow(x) for x in model), stats.tobytes(), narrow(followers))]
        ends = np.cumsum([t.sum() for t in times])[:-1]
        answers, places = np.split(counts[at], ends), np.split((np.cumsum(seen) - 1)[at], ends)
        own_contexts = np.split(v_at, np.cumsum([len(c) for c in contexts])[:-1])
        hot = np.zeros(len(vs), dtype=bool)
        for chunk, own, runs, length, answer, place in zip(group["chunk"], own_contexts, times, lengths, answers, places, strict=True):
            unseen = np.add.reduceat(answer == 0, np.concatenate([[0], np.cumsum(runs)[:-1]])) > 0
            is_hot = length & 1 == 1
            hot[own[is_hot]] = True
            needed = np.flatnonzero(unseen & ~is_hot).astype(np.uint32)
            rows.append(("answer", bucket, chunk, narrow(answer), narrow(few[own]), rising(needed), pack(made[own[needed]]), None if last else rising(place[answer > 0])))
        rows.append(("hot", bucket, None, vs[hot].tobytes(), made[hot].tobytes(), None, None, None))
        return pd.DataFrame(rows, columns=names(TELLS))

    return run


def hot_contexts(told: DataFrame) -> dict[int, np.ndarray]:
    """What all buckets tell of the hot contexts, added up; these are at most as many as buckets."""

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, made in zip(batch["a"], batch["b"], strict=True):
                values = pd.DataFrame(np.frombuffer(made, dtype=np.float64).reshape(-1, K + 2), columns=[f"m{i}" for i in range(K + 2)])
                yield pd.concat([pd.Series(u64(ids).view(np.int64), name="v"), values], axis=1)

    columns = [f"m{i}" for i in range(K + 2)]
    rows = told.where("kind = 'hot'").select("a", "b").mapInPandas(parts, "v long, " + ", ".join(f"{c} double" for c in columns))
    sums = rows.groupBy("v").agg(*(F.sum(c).alias(c) for c in columns)).collect()
    return {np.int64(r["v"]).astype(np.uint64): np.array([r[c] for c in columns]) for r in sums}


@dataclass
class Told:
    """What is known on all buckets of an order above the first."""

    order: int
    factor: np.ndarray
    hot_made: dict[int, np.ndarray]
    last: bool


def score_chunk(low: Unigrams, told: list[Told], buckets: int, hot: int):
    def run(chunks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([scored(risen(row, answers, low, told, buckets, hot), low) for _, row in chunks.iterrows()])

    return run


def risen(row: pd.Series, answers: pd.DataFrame, low: Unigrams, told: list[Told], buckets: int, hot: int) -> Chunk:
    """A chunk taken through all orders told."""
    c = Chunk(row, answers[answers["kind"] == "1"], low, buckets, hot)
    for order in told:
        c.find_grams()
        take_answers(c, answers[answers["kind"] == str(order.order)].sort_values("bucket"), order)
    return c


def take_answers(c: Chunk, answers: pd.DataFrame, told: Told) -> None:
    o, factor = c.order, told.factor
    in_place, gram_counts, gram_bottoms = np.empty(len(o)), np.zeros(len(o), dtype=np.int64), np.zeros(len(o), dtype=np.int64)
    gram_ids = None if told.last else np.zeros(len(o), dtype=np.uint64)
    if len(o):
        bucket, v = c.bucket[o], c.v_id[o]
        runs = first_of_runs(bucket, v)  # the contexts in the order asked
        run_of = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, len(o))))
        counts = np.concatenate([wide(a) for a in answers["a"]]).astype(np.int64)
        few = np.concatenate([wide(b) for b in answers["b"]]).astype(np.uint8)
        first_run = np.searchsorted(bucket[runs], answers["bucket"].to_numpy())
        needed = np.concatenate([np.cumsum(wide(x)).astype(np.int64) + first for x, first in zip(answers["c"], first_run, strict=True)])
        made = np.concatenate([unpack(x) for x in answers["d"]])
        # a hot context has a run in many buckets
        context_of_run = c.v_at[o][runs]
        total, small = np.zeros((c.contexts, K + 2)), np.zeros(c.contexts, dtype=np.uint8)
        total[context_of_run[needed]] = made
        small[context_of_run] = few
        hot = runs[c.hot[o][runs]]
        for at, of in dict(zip(c.v_at[o][hot].tolist(), v[hot], strict=True)).items():
            total[at] = told.hot_made[of]
            small[at] = ((total[at, :K] > 0) << np.arange(K)).sum()
        cuts = ((factor < 1) << np.arange(K)).sum().astype(np.uint8)
        context_counts, low_bottoms = np.zeros(c.contexts, dtype=np.int64), np.ones(c.contexts)
        context_counts[context_of_run], low_bottoms[context_of_run] = c.v_count[o][runs], c.low_bottom[o][runs]
        bottom = context_counts + ((small & cuts) == 0)  # nothing is discounted: one more count for the unseen
        mass = (total[:, :K] @ (factor * np.arange(1, K + 1)) + total[:, K]) / bottom
        weight = (1 - mass) / (1 - total[:, K + 1] / low_bottoms)
        context = context_of_run[run_of]
        with np.errstate(divide="ignore"):
            in_place[o] = np.where(counts > 0, np.log10(discounted(counts, factor) / bottom[context]), np.log10(weight[context]) + c.low_log[o])
        gram_counts[o], gram_bottoms[o] = counts, bottom[context]
        if gram_ids is not None:
            gram_ids[o[counts > 0]] = np.concatenate([np.cumsum(wide(x)) * np.uint64(c.buckets) + np.uint64(b) for x, b in zip(answers["e"], answers["bucket"], strict=True)])
    c.rise(gram_counts, gram_bottoms, in_place, gram_ids)


def scored(c: Chunk, low: Unigrams) -> pd.DataFrame:
    base = np.log10((c.word_count + 1) / (low.tokens + 1 * (low.types + 1)))
    return pd.DataFrame({
        "doc_id": list(c.ids), "held_out": c.held, "n_tokens": c.lengths, "n_known": np.add.reduceat((c.word_count > 0).astype(np.int64), c.starts), "train_tokens": low.tokens,
        "base_score": np.add.reduceat(base, c.starts), "score": np.add.reduceat(c.logs, c.starts),
    })


def _bucketed(df: DataFrame, parts: int) -> DataFrame:
    """A table dealt out by chunk, so that answers come to the chunks and the chunks stay."""
    spark, name = df.sparkSession, f"llm_chunks_{uuid.uuid4().hex}"
    df.write.bucketBy(parts, "chunk").option("compression", "zstd").option("path", new_path(spark, "chunks")).saveAsTable(name)
    return spark.table(name)


def score_documents(
    docs: DataFrame, held_out: Column, chunk_tokens: int = 1_000_000, bucket_bytes: int = 3 << 20, key: str = "doc_id", text: str = "text", order: int = 2
) -> DataFrame:
    """Score every whole text under a Katz model of n-grams up to ``order`` learned from the rows that ``held_out`` doesn't mark.

    Tokens are words (A-Z lowered) and one end per text; a text's first context is its start, and no context goes beyond it. Every
    order is a round of asking and telling; trained n-grams are numbered by bucket, so that a context of any length is one small number. Counts up to 5 get
    Good-Turing discounts (``discounts``). What they free in a context goes to its unseen followers in proportion to
    the lower order, exactly: weight = (1 - discounted mass) / (1 - lower-order mass of the seen followers), both summed over all
    followers. A context without a discounted follower gets one more count for the unseen; an unseen context takes the
    lower order; all unknown words are one event. Words are known by 64-bit hashes.

    Counts are stored by bucket (kind ``model`` of the tables in the shared folder): word ids and counts, n-grams and counts. A context that
    holds more than an average bucket's share of tokens is spread over all buckets by its followers.

    A null or empty text is the end token alone; null ids are kept; a null mark counts as false; repeated rows count each time; an empty
    table gives no row, and with nothing to learn from every token is unknown. Extra columns don't matter.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one row per row.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("string").alias("id"), text_or_empty(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count_if(~F.col("held"))).first()
    buckets = parts_for(spark, total[0], bucket_bytes)
    chunks = _bucketed(rows.mapInPandas(cut_chunks(chunk_tokens), CHUNKS), buckets)

    with shuffles_dropped(spark):
        asked = chunks.select("chunk", "types", "counts").mapInPandas(ask_words(buckets), ASKS)
        words = written(asked.groupBy("bucket").applyInPandas(tell_words(buckets), TELLS), "words", partition_by=("kind",))
        stats = _sums(words, K + 4)
        low = Unigrams.from_counts(int(stats[0]), int(stats[1]), total[1], stats[2:])
        hot = max(1, low.tokens // buckets)

        answers = words.where("kind = 'answer'").select(F.lit("1").alias("kind"), *ANSWERS)
        told, factor = [], low.factor
        for n in range(2, order + 1):
            asked = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(ask_grams(low, told, buckets, hot), ASKS)
            grams = written(asked.groupBy("bucket").applyInPandas(tell_grams(factor, buckets, n == order), TELLS), f"grams-{n}", partition_by=("kind",))
            factor = discounts(_sums(grams, K + 2))
            told = [*told, Told(n, factor, hot_contexts(grams), n == order)]
            answers = answers.unionByName(grams.where("kind = 'answer'").select(F.lit(str(n)).alias("kind"), *ANSWERS))
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(score_chunk(low, told, buckets, hot), SCORES)


def _sums(told: DataFrame, n: int) -> np.ndarray:
    """Sums of the statistics that all buckets tell, a few numbers."""

    def numbers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(i, int(x)) for data in batch["d"] for i, x in enumerate(np.frombuffer(data, dtype=np.int64))], columns=["i", "n"])

    sums = told.where("kind = 'model'").select("d").mapInPandas(numbers, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(n, dtype=np.int64)
    for r in sums:
        out[r["i"]] = r["n"]
    return out


def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scores = score_documents(docs, id_remainder("doc_id", 7) == 2, order=ORDER)
    return scores.withColumn("doc_id", F.col("doc_id").cast("long"))
