import datetime

import pytest

#: Extra columns whose names clash with what operators add or use inside.
CLASHING = ["size", "slot", "shard", "bucket", "weight", "language", "leaks", "rep", "task", "path", "key", "line", "h1", "doc", "digest", "held", "a.b"]


def rows_of_documents():
    long = " ".join(f"word{i % 700}" for i in range(20_000))
    base = "the quick brown fox jumps over the lazy dog while rain falls on the old stone bridge near town every evening"
    return [
        (1, base + " today", "en", "s1", 10),
        (2, base + " today", "en", "s1", 10),  # a copy
        (3, base.upper() + " today", "en", None, None),  # equal but for case
        (4, None, "en", "s2", 0),
        (5, "", None, "s2", 0),
        (6, "   \n\t ", "fr", "s3", 6),
        (7, "!!! 123 ???", "fr", "s3", 11),
        (8, long, "en", "s1", len(long)),
        (9, long + " end", "en", "s1", len(long)),  # a near copy
        (10, "un deux trois quatre cinq six sept huit neuf dix\nune ligne répétée ici\nfin", "fr", "s3", 70),
        (10, "un deux trois quatre cinq six sept huit neuf dix\nune ligne répétée ici\nfin", "fr", "s3", 70),  # a repeated row
        (11, "onze\n  Une ligne répétée ici \nautre", "fr", "é", 30),
        (11, "another text under an id that is taken already", None, "é", 30),
        (None, "a text without an id", "en", "s1", 20),
        (None, None, None, None, None),
        (12, "one", "en", "s2", 3),
        (13, "ein kleiner Vogel sitzt auf dem Dach \U0001f426 und singt", "de", "s2", 50),
    ]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, copies, repeated rows and ids, and clashing extra columns."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows_of_documents(), SCHEMA)
    extra = {name: F.lit(i) for i, name in enumerate(CLASHING)} | {"made": F.lit(datetime.date(2024, 1, 1))}
    from lodestat.llm.common import written

    return written(docs.withColumns(extra).repartition(3), "odd-docs")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
