"""Session construction and lineage cutting."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; extra settings win over the defaults."""
    builder = SparkSession.builder.master(master).appName("lodestat")
    for key, value in {**DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_OWN_FOLDER: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only a session inside one process (master ``local[...]``, as in tests) may leave it unset; it then gets one folder of
    its own, removed when the process ends. On a cluster a machine-local folder would lose rows, so there this raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _OWN_FOLDER:
        _OWN_FOLDER.append(tempfile.mkdtemp(prefix="lodestat-"))
        atexit.register(shutil.rmtree, _OWN_FOLDER[0], ignore_errors=True)
    return _OWN_FOLDER[0]


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    Reading the table back cuts the lineage, survives lost executors, and gives the planner the true size of the data;
    loops that join their own results would otherwise carry ever larger size estimates.
    """
    path = f"{shared_folder(df.sparkSession)}/lodestat-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """``checkpointed``, dealt out by ``key``: joins and groups by it move the other side only, in every round of a loop."""
    spark, name = df.sparkSession, f"lodestat_{uuid.uuid4().hex}"
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(parts, key).write.bucketBy(parts, key).option("path", f"{shared_folder(spark)}/lodestat-{uuid.uuid4().hex}").saveAsTable(name)
    return spark.table(name)
