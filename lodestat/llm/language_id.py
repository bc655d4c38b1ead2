"""Language identification: known words first, then shorter and shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestat.llm.common import id_remainder

LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def words_in(text: str | None) -> list[str]:
    """Runs of letters in lower case; signs such as fractions and raised digits may be in one but don't make one."""
    return [word for word in LETTERS.findall(text.lower()) if word.isalpha() or any(map(str.isalpha, word))] if text else []


def grams_of(word: str, n: int) -> list[str]:
    padded = f"_{word}_" if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


class WordModel:
    """Per-language log frequencies of words and character n-grams, a row for each in one matrix."""

    def __init__(self, langs: list[str], words: dict[str, int], grams: list[dict[str, int]], table: np.ndarray):
        self.langs, self.words, self.grams, self.table = langs, words, grams, table

    @classmethod
    def from_counts(cls, counts: pd.DataFrame, langs: list[str], longest: int) -> "WordModel":
        """``counts``: kind (0 a word, n an n-gram), item, lang, n. Frequencies are smoothed by half a count."""
        at = {lang: i for i, lang in enumerate(langs)}
        index: list[dict[str, int]] = [{} for _ in range(longest + 1)]
        blocks, start = [np.zeros((0, len(langs)))], 0
        for kind in range(longest + 1):
            own = counts[counts["kind"] == kind]
            codes, items = pd.factorize(own["item"])
            table = np.full((len(items), len(langs)), 0.5)
            np.add.at(table, (codes, own["lang"].map(at).to_numpy(dtype=np.int64)), own["n"].to_numpy())
            blocks.append(np.log(table / table.sum(axis=0)) if len(items) else table)
            index[kind] = {item: start + i for i, item in enumerate(items)}
            start += len(items)
        return cls(langs, index[0], index[1:], np.concatenate(blocks).astype(np.float32))

    def unseen(self, word: str) -> np.ndarray:
        """The mean over the longest n-grams of which any is known; nothing known says nothing."""
        for table, n in zip(reversed(self.grams), range(len(self.grams), 0, -1), strict=True):
            rows = [row for gram in grams_of(word, n) if (row := table.get(gram)) is not None]
            if rows:
                return self.table[rows].mean(axis=0)
        return np.zeros(len(self.langs), dtype=np.float32)

    def predict(self, text: str | None, memo: dict[str, np.ndarray]) -> tuple[str, float]:
        found = Counter(words_in(text))
        if not found or not self.langs:
            return UNKNOWN, 0.0
        total = np.zeros(len(self.langs))
        rows, times = [], []
        for word, n in found.items():
            row = self.words.get(word)
            if row is not None:
                rows.append(row)
                times.append(n)
                continue
            vector = memo.get(word)
            if vector is None:
                vector = self.unseen(word)
                if len(memo) >= 200_000:
                    memo.clear()
                memo[word] = vector
            total += n * vector
        if rows:
            total += np.asarray(times, dtype=np.float64) @ self.table[rows]
        odds = np.exp(total - total.max())
        best = int(odds.argmax())
        return self.langs[best], float(odds[best] / odds.sum())


def fit(
    docs: DataFrame, sample_docs: int = 2000, most_items: int = 50_000, least_count: int = 2, longest: int = 4, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> WordModel:
    """Fit on the labelled rows of ``docs``.

    ``sample_docs`` bounds the sample: each language gives about that many rows, those whose hashed id is below
    sample_docs / rows of the language; whole texts are counted. ``most_items`` bounds the model: so many words and so
    many n-grams of each length per language, the most frequent that occur ``least_count`` times. The model is what the
    driver collects and broadcasts; its size doesn't depend on the table. Null or empty texts and null labels teach nothing.
    """
    labelled = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = {r["lang"]: r["rows"] for r in labelled.groupBy("lang").agg(F.count("*").alias("rows")).collect()}
    langs = sorted(rows)
    draw = F.pmod(F.xxhash64(F.lit(11), "key"), F.lit(1 << 40)) / float(1 << 40)
    share = F.lit(0.0)
    for name in langs:
        share = F.when(F.col("lang") == name, sample_docs / rows[name]).otherwise(share)
    sample = labelled.where(draw < share).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, own in batch.groupby("lang"):
                words = Counter(w for t in own["text"] for w in words_in(t))
                kinds, items, times = [0] * len(words), list(words), list(words.values())
                for n in range(1, longest + 1):
                    grams: Counter[str] = Counter()
                    for word, k in words.items():
                        for gram in grams_of(word, n):
                            grams[gram] += k
                    kinds += [n] * len(grams)
                    items += list(grams)
                    times += list(grams.values())
                yield pd.DataFrame({"lang": pd.Series([name] * len(items), dtype=object), "kind": kinds, "item": pd.Series(items, dtype=object), "n": times})

    counted = sample.mapInPandas(count, "lang string, kind int, item string, n long")
    counted = counted.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)
    # of each language and kind the most frequent: the count of the last that fits, from counts of counts
    by = ["lang", "kind"]
    larger = F.sum("items").over(Window.partitionBy(*by).orderBy(F.col("n").desc()))
    levels = counted.groupBy(*by, "n").agg(F.count("*").alias("items")).withColumn("upto", larger)
    fitting = levels.where(F.col("upto") <= most_items).select(*by, "n")
    return WordModel.from_counts(counted.join(fitting, [*by, "n"]).toPandas(), langs, longest)


def predict_languages(docs: DataFrame, model: WordModel, text: str = "text", into: str = "language") -> DataFrame:
    """Add the struct column ``into`` (lang, score): the likeliest language and its posterior under equal priors.

    Every word of the whole text counts. A null text or one without a letter is ``und`` with score 0, as is every text
    if nothing could be learned; ties go to the first language by name. Only the text enters; other columns pass by.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memo: dict[str, np.ndarray] = {}
        for part in parts:
            yield pd.DataFrame([shared.value.predict(t, memo) for t in part], columns=["lang", "score"])

    return docs.withColumn(into, predict(F.col(text)))


def held_out(key: str = "doc_id"):
    return id_remainder(key, 5) == 0


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out()))
    out = predict_languages(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))
