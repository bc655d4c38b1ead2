"""Joins and set operations."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.functions.bins import cut_index
from lodestat.operators import joins as J
from lodestat.operators.ordered import hash_row_numbers, previous_row
from lodestat.operators.windows import lookback_distinct
from lodestat.plans.registry import plan, r6

HALF = "timestamp '2024-01-16'"


def halves(t, *columns):
    """Events before and after the middle of the month."""
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    return (
        t.events.filter(F.col("ts") < cut).select(*columns),
        t.events.filter(F.col("ts") >= cut).select(*columns),
    )


@plan(
    "join_left_chain",
    """with o as (select o_custkey as c_custkey, count(*) as n_orders, round(sum(o_totalprice), 2) as spent from orders group by 1),
    l as (select o_custkey as c_custkey, sum(l_quantity) as qty from lineitem join orders on l_orderkey = o_orderkey group by 1)
    select c_custkey, c_mktsegment, coalesce(n_orders, 0) as n_orders, coalesce(spent, 0) as spent, coalesce(qty, 0) as qty
    from customer left join o using (c_custkey) left join l using (c_custkey)""",
)
def join_left_chain(t):
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("qty"))
    items = per_order.join(orders.select("o_orderkey", "c_custkey"), "o_orderkey")
    chain = J.left_chain(
        t.customer.select("c_custkey", "c_mktsegment"),
        [
            orders.groupBy("c_custkey").agg(
                F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("spent")
            ),
            items.groupBy("c_custkey").agg(F.sum("qty").alias("qty")),
        ],
        "c_custkey",
    )
    return chain.na.fill(0)


@plan(
    "join_left_missing_side",
    """select d.lang, count(*) as n, count(l.quality) as labelled from documents d left join labels l using (doc_id) group by 1""",
)
def join_left_missing_side(t):
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return joined.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count("quality").alias("labelled"))


@plan(
    "join_inner",
    "select o_orderkey, c_mktsegment, o_totalprice from orders join customer on o_custkey = c_custkey",
)
def join_inner(t):
    c = t.customer.select("c_custkey", "c_mktsegment")
    return t.orders.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_mktsegment", "o_totalprice")


@plan(
    "join_anti",
    f"""with b as (select distinct floor(value / 5)::bigint as bin from events where ts < {HALF}),
    m as (select distinct floor(value / 5)::bigint as bin from events where ts >= {HALF})
    select 'uncovered' as side, bin from m where bin not in (select bin from b)
    union all select 'unused', bin from b where bin not in (select bin from m)""",
)
def join_anti(t):
    b, m = halves(t, F.floor(F.col("value") / 5).alias("bin"))
    missing = J.absent_keys(m, b, "bin").select(F.lit("uncovered").alias("side"), "bin")
    return missing.union(J.absent_keys(b, m, "bin").select(F.lit("unused").alias("side"), "bin"))


@plan(
    "join_semi_isin",
    """select o_orderkey, o_custkey from orders where o_custkey in
    (select c_custkey from customer where c_mktsegment = 'BUILDING')""",
)
def join_semi_isin(t):
    building = t.customer.filter("c_mktsegment = 'BUILDING'")
    return J.keep_listed(t.orders, building, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@plan(
    "join_complement",
    """select o_orderkey from orders where o_orderkey not in (select o_orderkey from orders where o_orderkey % 5 = 0)
    and o_orderkey not in (select o_orderkey from orders where o_orderkey % 7 = 0)""",
)
def join_complement(t):
    keys = t.orders.select("o_orderkey")
    return J.complement(keys, [keys.filter("o_orderkey % 5 = 0"), keys.filter("o_orderkey % 7 = 0")], "o_orderkey")


@plan(
    "join_map_lookup",
    """select c_custkey, coalesce(n_name, 'none') as nation from customer
    left join (select * from nation where n_nationkey <> 3) on c_nationkey = n_nationkey""",
)
def join_map_lookup(t):
    nation = t.nation.filter("n_nationkey <> 3")
    return J.lookup(t.customer.select("c_custkey", "c_nationkey"), nation, "c_nationkey", "n_nationkey", "n_name", "nation", "none").drop("c_nationkey")


@plan(
    "join_agg_back",
    """with a as (select l_partkey, avg(l_quantity) as mean_qty from lineitem where l_returnflag = 'R' group by 1)
    select l_orderkey, l_linenumber, l_partkey, round(coalesce(mean_qty, 0), 6) as mean_qty from lineitem left join a using (l_partkey)""",
)
def join_agg_back(t):
    returned = t.lineitem.filter("l_returnflag = 'R'").groupBy("l_partkey").agg(F.avg("l_quantity").alias("mean_qty"))
    joined = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(returned, "l_partkey", "left")
    return joined.withColumn("mean_qty", r6(F.coalesce("mean_qty", F.lit(0.0))))


@plan(
    "join_fold_reduce",
    """with f as (select l_orderkey % 4 as fold, l_suppkey, avg(l_discount) as importance from lineitem group by 1, 2)
    select l_suppkey, round(avg(importance), 6) as mean_importance, count(*) as folds from f group by 1""",
)
def join_fold_reduce(t):
    per = t.lineitem.groupBy((F.col("l_orderkey") % 4).alias("fold"), "l_suppkey").agg(F.avg("l_discount").alias("importance"))
    folds = [per.filter(F.col("fold") == i) for i in range(4)]
    return J.mean_of_folds(folds, "l_suppkey", "importance", "mean_importance").withColumn("mean_importance", r6("mean_importance"))


@plan(
    "join_horizontal",
    """with a as (select o_orderkey, row_number() over (order by md5(o_orderkey::varchar || '|1')) as i from orders),
    b as (select o_orderkey as other, row_number() over (order by md5(o_orderkey::varchar || '|2')) as i from orders)
    select i as "row", o_orderkey, other from a join b using (i)""",
)
def join_horizontal(t):
    left = hash_row_numbers(t.orders.select("o_orderkey"), ["o_orderkey"], seed=1, name="row")
    right = hash_row_numbers(t.orders.select("o_orderkey"), ["o_orderkey"], seed=2, name="row")
    return left.join(right.withColumnRenamed("o_orderkey", "other"), "row")


@plan(
    "join_index_labels",
    """select ('0x' || right(md5(doc_id::varchar), 8))::bigint as doc_hash, n_chars, coalesce(quality, -1) as target
    from documents left join labels using (doc_id)""",
)
def join_index_labels(t):
    hashed = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 25, 8), 16, 10).cast("long")
    features = t.documents.select(hashed.alias("doc_hash"), "n_chars")
    target = t.labels.select(hashed.alias("doc_hash"), F.col("quality").alias("target"))
    return features.join(target, "doc_hash", "left").withColumn("target", F.coalesce("target", F.lit(-1)))


@plan(
    "join_range_lookback",
    """select a.event_id, count(distinct b.event_type) as kinds from events a join events b
    on a.user_id = b.user_id and b.ts > a.ts - interval 24 hours and b.ts <= a.ts group by 1""",
)
def join_range_lookback(t):
    return lookback_distinct(t.events, "user_id", "ts", "event_type", 24, "kinds").select("event_id", "kinds")


@plan(
    "join_asof_prev",
    """select event_id, coalesce(lag(value) over w, -1) as prev_value, coalesce(lag(event_type) over w, 'none') as prev_type
    from events window w as (partition by user_id order by ts)""",
)
def join_asof_prev(t):
    prev = previous_row(t.events, "ts", {"prev_value": "value", "prev_type": "event_type"}, ["user_id"])
    return prev.select(
        "event_id",
        F.coalesce("prev_value", F.lit(-1.0)).alias("prev_value"),
        F.coalesce("prev_type", F.lit("none")).alias("prev_type"),
    )


BREAKS = [1.0, 5.0, 10.0, 25.0, 50.0, 75.0, 100.0, 200.0]


@plan(
    "join_bin_range",
    "select event_id, ("
    + " + ".join(f"(value > {b})::integer" for b in BREAKS)
    + ")::integer as bin from events",
)
def join_bin_range(t):
    return t.events.select("event_id", cut_index(F.col("value"), BREAKS).alias("bin"))


@plan(
    "union_train_test_flag",
    """select is_train, count(*) as n, round(sum(o_totalprice), 2) as total from (
    select *, 1 as is_train from orders where o_orderkey % 3 > 0 union all select *, 0 from orders where o_orderkey % 3 = 0) group by 1""",
)
def union_train_test_flag(t):
    train = t.orders.filter("o_orderkey % 3 > 0").withColumn("is_train", F.lit(1))
    test = t.orders.filter("o_orderkey % 3 = 0").withColumn("is_train", F.lit(0))
    both = train.unionByName(test)
    return both.groupBy("is_train").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@plan(
    "union_segments",
    """with d as (select date_trunc('day', ts)::timestamp as day, round(sum(value), 4) as total from events group by 1)
    select day, total, 'before' as segment from d where day < timestamp '2024-01-10' union all
    select day, round(total * 0.5, 4), 'replaced' from d where day >= timestamp '2024-01-10' and day < timestamp '2024-01-17' union all
    select day, total, 'after' from d where day >= timestamp '2024-01-17'""",
)
def union_segments(t):
    daily = t.events.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.round(F.sum("value"), 4).alias("total"))
    a, b = F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-17").cast("timestamp_ntz")
    day = F.col("day")
    parts = [
        daily.filter(day < a).withColumn("segment", F.lit("before")),
        daily.filter((day >= a) & (day < b)).withColumn("total", r6(F.col("total") * 0.5, 4)).withColumn("segment", F.lit("replaced")),
        daily.filter(day >= b).withColumn("segment", F.lit("after")),
    ]
    return reduce(DataFrame.unionByName, parts)


@plan("intersect_keys", "select c_custkey as key from customer intersect select o_custkey from orders")
def intersect_keys(t):
    return t.customer.select(F.col("c_custkey").alias("key")).intersect(t.orders.select("o_custkey"))


@plan("except_keys", "select c_custkey as key from customer except select o_custkey from orders")
def except_keys(t):
    return t.customer.select(F.col("c_custkey").alias("key")).subtract(t.orders.select("o_custkey"))


@plan(
    "assert_disjoint_cover",
    """select count(*) as keys, true as disjoint, true as complete from orders""",
)
def assert_disjoint_cover(t):
    from lodestat.operators.splits import check_cover

    keys = t.orders.select("o_orderkey")
    parts = [keys.filter(f"o_orderkey % 10 in ({x})") for x in ("0,1,2,3,4,5", "6,7", "8,9")]
    return check_cover(keys, parts, "o_orderkey")
