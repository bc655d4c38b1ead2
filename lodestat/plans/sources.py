"""Scans and sinks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.plans.registry import plan
from lodestat.sources import readers, writers


def _schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


@plan("scan_parquet", "select * from orders")
def scan_parquet(t):
    return readers.read_parquet(t.spark, f"{t.folder}/orders.parquet")


@plan(
    "scan_pruned",
    "select l_returnflag, sum(l_quantity) as qty from lineitem group by 1",
)
def scan_pruned(t):
    li = readers.read_parquet(t.spark, f"{t.folder}/lineitem.parquet", ["l_returnflag", "l_quantity"])
    return li.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("qty"))


@plan("scan_csv", "select o_orderkey, o_totalprice, o_orderpriority as priority from orders")
def scan_csv(t):
    path = writers.scratch_folder(t.spark, "csv")
    source = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    text = source.select(*[F.col(c).cast("string").alias(c) for c in source.columns])
    junk = text.limit(1).select(F.lit("skip me").alias("a"), F.lit("").alias("b"), F.lit("").alias("c"))
    writers.write_csv(text.union(junk), path, header=False, sep=";")
    return readers.read_csv(
        t.spark,
        path,
        _schema("o_orderkey long, o_totalprice double, o_orderpriority string"),
        sep=";",
        header=False,
        names=["o_orderkey", "o_totalprice", "priority"],
        skip_where=("o_orderkey", ["skip me"]),
    )


@plan(
    "scan_csv_glob_year",
    "select o_orderkey, o_totalprice, cast(year(o_orderdate) as integer) as file_year from orders",
)
def scan_csv_glob_year(t):
    path = writers.scratch_folder(t.spark, "years")
    rows = t.orders.select(
        F.concat(F.lit("orders_"), F.year("o_orderdate")).alias("batch"),
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
    )
    second = rows.select("batch").distinct().select("batch", F.lit("Order").alias("a"), F.lit("Price").alias("b"))
    rows.union(second).write.partitionBy("batch").option("header", True).csv(path)
    return readers.read_csv_by_year(
        t.spark, f"{path}/batch=orders_*/*.csv", _schema("o_orderkey long, o_totalprice double"), "o_orderkey", "Order"
    )


@plan("scan_ndjson", "select event_id, user_id, event_type, value from events")
def scan_ndjson(t):
    path = writers.write_ndjson(
        t.events.select("event_id", "user_id", "event_type", "value"), writers.scratch_folder(t.spark, "json")
    )
    return readers.read_ndjson(t.spark, path, _schema("event_id long, user_id long, event_type string, value double"))


@plan("scan_excel", "select o_orderdate as day, round(sum(o_totalprice), 2) as total from orders group by 1")
def scan_excel(t):
    daily = t.orders.groupBy(F.col("o_orderdate").alias("day")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return readers.read_xlsx(t.spark, writers.write_xlsx(daily, writers.scratch_folder(t.spark, "sheets")))


@plan("scan_typed_schema", "select c_custkey, c_name, c_acctbal, c_mktsegment from customer")
def scan_typed_schema(t):
    schema = _schema("c_custkey long, c_name string, c_acctbal double, c_mktsegment string")
    return t.spark.read.schema(schema).parquet(f"{t.folder}/customer.parquet")


@plan("sink_parquet", "select * from supplier")
def sink_parquet(t):
    path = writers.write_parquet(t.supplier, writers.scratch_folder(t.spark, "parquet"))
    return readers.read_parquet(t.spark, path)


@plan("sink_csv", "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, o_totalprice from orders")
def sink_csv(t):
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice")
    path = writers.write_csv(rows, writers.scratch_folder(t.spark, "csvout"), date_format="dd/MM/yyyy")
    schema = _schema("o_orderkey long, o_orderdate date, o_totalprice double")
    back = t.spark.read.schema(schema).option("header", True).option("dateFormat", "dd/MM/yyyy").csv(path)
    return back.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


SPLIT_OF_ORDER = """case when md5(o_orderkey::varchar || '|42') < 'b' then 'train'
                         when md5(o_orderkey::varchar || '|42') < 'd' then 'validation' else 'test' end"""


@plan(
    "sink_split_layout",
    f"select {SPLIT_OF_ORDER} as split, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by 1",
)
def sink_split_layout(t):
    h = F.md5(F.concat(F.col("o_orderkey").cast("string"), F.lit("|42")))
    split = F.when(h < "b", "train").when(h < "d", "validation").otherwise("test")
    path = writers.write_splits(
        t.orders.select("o_orderkey", "o_totalprice", split.alias("split")), writers.scratch_folder(t.spark, "splits")
    )
    back = t.spark.read.schema(_schema("o_orderkey long, o_totalprice double, split string")).option("header", True)
    return back.csv(path).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@plan("scan_batch_predictions", "select event_id, round(value / 500, 6) as score from events")
def scan_batch_predictions(t):
    rows = t.events.select("event_id", F.round(F.col("value") / 500, 6).alias("score"))
    path = writers.write_csv(rows.repartition(4, "event_id"), writers.scratch_folder(t.spark, "predictions"), header=False)
    return readers.read_csv(t.spark, f"{path}/*.csv", _schema("event_id long, score double"), header=False)
