"""Projections, filters, missing values and encoders."""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from lodestat.operators import cleaning as C
from lodestat.operators import encoding as E
from lodestat.operators import parts as P
from lodestat.operators.ordered import carry_forward
from lodestat.operators.quantiles import attach
from lodestat.plans.registry import plan, r6

NUMERICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@plan("project_rename", "select p_partkey as id, p_name as label, p_brand as brand, p_size as size_cm from part")
def project_rename(t):
    part = t.part.select("p_partkey", "p_name", "p_brand", "p_size")
    return part.withColumnsRenamed({"p_partkey": "id", "p_name": "label", "p_brand": "brand", "p_size": "size_cm"})


@plan("clean_column_names", "select c_custkey as customer_key, c_name as full_name, c_acctbal as acct_bal from customer")
def clean_column_names(t):
    raw = t.customer.select(
        F.col("c_custkey").alias("num__Customer  Key"), F.col("c_name").alias("cat__Full.Name"), F.col("c_acctbal").alias("_Acct-Bal_")
    )
    return C.clean_names(raw)


@plan("select_by_dtype", "select event_id, user_id, value from events")
def select_by_dtype(t):
    return t.events.select(*C.columns_of_kind(t.events, "numeric"))


@plan("drop_columns", "select event_id, ts, user_id, event_type from events")
def drop_columns(t):
    return C.drop_columns(t.events, ["value", "props"])


@plan("drop_all_null_columns", "select event_id, value from events")
def drop_all_null_columns(t):
    return C.drop_all_null_columns(t.events.select("event_id", "value", F.lit(None).cast("string").alias("echo")))


@plan(
    "null_profile",
    """with j as (select d.doc_id, d.lang, l.quality, l.toxic from documents d left join labels l using (doc_id))
    select 'quality' as "column", count(*) - count(quality) as nulls, round((count(*) - count(quality)) / count(*), 6) as share from j
    union all select 'toxic', count(*) - count(toxic), round((count(*) - count(toxic)) / count(*), 6) from j""",
)
def null_profile(t):
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return C.null_profile(joined).withColumn("share", r6("share"))


@plan(
    "blank_to_null",
    """select p_partkey, case when p_partkey % 7 = 0 then null else p_brand end as brand,
    case when p_size = 1 then null else p_type end as kind from part""",
)
def blank_to_null(t):
    dirty = t.part.select(
        "p_partkey",
        F.when(F.col("p_partkey") % 7 == 0, "").otherwise(F.col("p_brand")).alias("brand"),
        F.when(F.col("p_size") == 1, "NaN").otherwise(F.col("p_type")).alias("kind"),
    )
    return C.texts_to_null(dirty)


@plan(
    "fill_null_literal",
    """select coalesce(d.doc_id, l.doc_id) as doc_id, coalesce(l.quality, -127) as quality, coalesce(l.toxic, -127) as toxic,
    coalesce(d.lang, 'Unknown') as lang from documents d full join labels l on d.doc_id = l.doc_id""",
)
def fill_null_literal(t):
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "full_outer")
    return C.fill_by_kind(joined, "Unknown", -127)


EV_NULLS = "select event_id, user_id, ts, event_type, case when event_id % 7 = 0 then null else value end as value from events"


def _ev_nulls(t):
    return t.events.select(
        "event_id", "user_id", "ts", "event_type", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value")
    )


@plan(
    "fill_null_median",
    f"with e as ({EV_NULLS}) select event_id, round(coalesce(value, (select median(value) from e)), 6) as value from e",
)
def fill_null_median(t):
    return C.fill_median(_ev_nulls(t), ["value"]).select("event_id", r6("value").alias("value"))


@plan(
    "forward_fill",
    f"""with e as ({EV_NULLS}) select event_id, last_value(value ignore nulls) over (partition by user_id order by ts
    rows between unbounded preceding and current row) as value from e""",
)
def forward_fill(t):
    return carry_forward(_ev_nulls(t), "ts", ["value"], ["user_id"]).select("event_id", "value")


@plan(
    "drop_null_rows",
    """select doc_id, quality, toxic from documents left join labels using (doc_id) where quality is not null""",
)
def drop_null_rows(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return joined.na.drop(how="all", subset=["quality", "toxic"]).na.drop(subset=["quality"])


@plan(
    "filter_eq_range_in",
    """select l_orderkey, l_linenumber, l_quantity from lineitem where l_returnflag = 'R' and l_quantity between 10 and 20
    and l_linenumber in (1, 2, 3) and l_shipdate >= timestamp '1996-01-01' and l_shipdate < timestamp '1998-01-01'""",
)
def filter_eq_range_in(t):
    li = t.lineitem
    kept = li.filter(
        (F.col("l_returnflag") == "R")
        & F.col("l_quantity").between(10, 20)
        & F.col("l_linenumber").isin(1, 2, 3)
        & (F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
        & (F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    )
    return kept.select("l_orderkey", "l_linenumber", "l_quantity")


@plan(
    "filter_quantile_trim",
    """with b as (select quantile_cont(l_extendedprice, 0.05) as lo, quantile_cont(l_extendedprice, 0.95) as hi from lineitem),
    k as (select l.* from lineitem l, b where l_extendedprice >= lo and l_extendedprice <= hi)
    select l_returnflag, count(*) as n, min(l_extendedprice) as low, max(l_extendedprice) as high from k group by 1""",
)
def filter_quantile_trim(t):
    kept = C.keep_between_quantiles(t.lineitem, "l_extendedprice", 0.05, 0.95)
    return kept.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high")
    )


@plan(
    "case_when_adjust",
    """select o_orderkey, round(case when year(o_orderdate) = 1997 then o_totalprice * 1.1
    when year(o_orderdate) = 1998 then o_totalprice * 0.9 else o_totalprice end, 4) as price from orders""",
)
def case_when_adjust(t):
    y, p = F.year("o_orderdate"), F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey", r6(F.when(y == 1997, p * 1.1).when(y == 1998, p * 0.9).otherwise(p), 4).alias("price")
    )


@plan(
    "map_values",
    """select o_orderkey, cast(case o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then 1 when '3-MEDIUM' then 2
    else -1 end as integer) as level from orders""",
)
def map_values(t):
    mapping = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}
    return C.map_values(t.orders, "o_orderpriority", mapping, default=-1, out="level").select("o_orderkey", "level")


@plan(
    "cast_downcast",
    """select l_orderkey, cast(l_quantity as smallint) as qty, cast(l_linenumber as tinyint) as l_linenumber,
    coalesce(try_cast(l_returnflag as integer), -1) as flag from lineitem""",
)
def cast_downcast(t):
    rows = t.lineitem.select(
        F.col("l_orderkey"),
        F.col("l_quantity").cast("smallint").alias("qty"),
        "l_linenumber",
        F.coalesce(F.col("l_returnflag").try_cast("int"), F.lit(-1)).alias("flag"),
    )
    return C.narrow_integers(rows, ["l_linenumber"])


@plan(
    "onehot_encode",
    """select l_linestatus, count(*) as n, sum(case when l_returnflag = 'A' then 1 else 0 end)::bigint as "l_returnflag_A",
    sum(case when l_returnflag = 'N' then 1 else 0 end)::bigint as "l_returnflag_N",
    sum(case when l_returnflag = 'R' then 1 else 0 end)::bigint as "l_returnflag_R" from lineitem group by 1""",
)
def onehot_encode(t):
    encoded = E.one_hot(t.lineitem.select("l_linestatus", "l_returnflag"), ["l_returnflag"])
    made = [c for c in encoded.columns if c.startswith("l_returnflag_")]
    return encoded.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in made])


@plan(
    "multilabel_binarize",
    """select p_partkey, (list_contains(string_split(p_name, ' '), 'red'))::integer as has_red,
    (list_contains(string_split(p_name, ' '), 'widget'))::integer as has_widget,
    (list_contains(string_split(p_name, ' '), 'small'))::integer as has_small from part""",
)
def multilabel_binarize(t):
    return E.multilabel(t.part.select("p_partkey", "p_name"), "p_name", " ").select(
        "p_partkey", "has_red", "has_widget", "has_small"
    )


@plan(
    "ordinal_encode",
    """with c as (select distinct p_brand from part where p_partkey % 3 = 0 and p_brand <> 'Brand#7'),
    k as (select p_brand, cast(row_number() over (order by p_brand) - 1 as integer) as code from c)
    select p_partkey, coalesce(code, -999) as brand_code from part left join k using (p_brand)""",
)
def ordinal_encode(t):
    fitted = E.ordinal_codes(t.part.filter("p_partkey % 3 = 0 and p_brand <> 'Brand#7'"), "p_brand")
    return E.ordinal_encode(t.part, "p_brand", fitted, "brand_code").select("p_partkey", "brand_code")


@plan(
    "count_encode",
    "select p_partkey, count(*) over (partition by p_type) as type_count from part",
)
def count_encode(t):
    return E.count_encode(t.part, "p_type", "type_count").select("p_partkey", "type_count")


@plan(
    "target_encode_ordered",
    """with r as (select event_id, event_type, (value > 50)::integer as y, md5(event_id::varchar || '|42') as h from events)
    select event_id, round((coalesce(sum(y) over w, 0) + 0.5) / (count(*) over w + 1), 6) as encoded from r
    window w as (partition by event_type order by h rows between unbounded preceding and 1 preceding)""",
)
def target_encode_ordered(t):
    rows = t.events.select(
        "event_id",
        "event_type",
        (F.col("value") > 50).cast("int").alias("y"),
        F.md5(F.concat(F.col("event_id").cast("string"), F.lit("|42"))).alias("h"),
    )
    return E.target_encode_ordered(rows, "event_type", "y", "h", "encoded").select("event_id", r6("encoded").alias("encoded"))


@plan("bool_to_int", "select event_id, (event_type = 'purchase')::integer as bought, (value > 100)::integer as large from events")
def bool_to_int(t):
    flags = t.events.select(
        "event_id", (F.col("event_type") == "purchase").alias("bought"), (F.col("value") > 100).alias("large")
    )
    return flags.withColumns({c: F.col(c).cast("int") for c in C.columns_of_kind(flags, "boolean")})


@plan(
    "cols_equal",
    """select o_orderstatus, count(*) filter (o_orderkey % 25 = o_custkey % 25) as matched, count(*) as n,
    bool_and(o_orderkey % 25 = o_custkey % 25) as all_equal from orders group by 1""",
)
def cols_equal(t):
    rows = t.orders.withColumn("same", F.col("o_orderkey") % 25 == F.col("o_custkey") % 25)
    return rows.groupBy("o_orderstatus").agg(
        F.count_if("same").alias("matched"), F.count(F.lit(1)).alias("n"), F.bool_and("same").alias("all_equal")
    )


@plan(
    "dedupe_keep_first",
    "select min(doc_id) as doc_id, md5(text) as digest, count(*) over () as kept from documents group by text",
)
def dedupe_keep_first(t):
    first = C.keep_first(t.documents.select("doc_id", "text"), ["text"], ["doc_id"])
    kept = first.agg(F.count(F.lit(1)).alias("kept")).scalar()
    return first.select("doc_id", F.md5("text").alias("digest"), kept.alias("kept"))


@plan(
    "find_duplicates",
    "select doc_id, lang, source from documents where text in (select text from documents group by text having count(*) > 1)",
)
def find_duplicates(t):
    return C.duplicate_members(t.documents, ["text"]).select("doc_id", "lang", "source")


@plan(
    "assert_row_identity",
    """select bool_and(abs(l_extendedprice * (1 - l_discount) + l_extendedprice * l_discount - l_extendedprice) < 1e-6) as holds,
    count(*) as n from lineitem""",
)
def assert_row_identity(t):
    price, off = F.col("l_extendedprice"), F.col("l_discount")
    return t.lineitem.agg(
        F.bool_and(F.abs(price * (1 - off) + price * off - price) < 1e-6).alias("holds"), F.count(F.lit(1)).alias("n")
    )


@plan("distinct_values", "select distinct p_brand from part")
def distinct_values(t):
    return t.part.select("p_brand").distinct()


@plan(
    "sparsity_profile",
    "\nunion all ".join(
        f"select '{c}' as \"column\", round(avg(({c} <> 0)::integer), 6) as share from lineitem" for c in NUMERICS
    ),
)
def sparsity_profile(t):
    return C.nonzero_share(t.lineitem, NUMERICS).withColumn("share", r6("share"))


@plan(
    "feature_ranges",
    "\nunion all ".join(
        f"""select '{c}' as "column", min({c}) + 0.0 as low, max({c}) as high, round((min({c}) + max({c})) / 2, 6) as mid,
        round((max({c}) - min({c})) / 2, 6) as half_range from lineitem"""
        for c in NUMERICS
    ),
)
def feature_ranges(t):
    return C.range_profile(t.lineitem, NUMERICS).withColumns({"mid": r6("mid"), "half_range": r6("half_range")})


@plan(
    "longest_value",
    "\nunion all ".join(
        f"""(select '{c}' as "column", md5({c}) as digest, strlen({c})::integer as bytes from documents
        order by strlen({c}) desc, doc_id limit 1)"""
        for c in ("text", "lang", "source")
    ),
)
def longest_value(t):
    return C.longest_values(t.documents, ["text", "lang", "source"], "doc_id").select(
        "column", F.md5("value").alias("digest"), "bytes"
    )


@plan(
    "prepared_by_pipeline",
    """with e as (select event_id, user_id, event_type, value, case when value <= 60 then value end as v, event_id % 3 <> 0 as train from events),
    m as (select quantile_cont(v, 0.5) as fill, avg(value) as prior from e where train),
    s as (select avg(coalesce(v, fill)) as centre, stddev_pop(coalesce(v, fill)) as spread from e, m where train),
    o as (select event_type, row_number() over (order by event_type) - 1 as code, sum(value) as total, count(*) as n from e where train group by 1),
    c as (select user_id, count(*) as seen from e where train group by 1)
    select event_id, round((coalesce(v, fill) - centre) / spread, 6) as scaled, coalesce(code, -999)::integer as code, coalesce(seen, 0) as seen, round((coalesce(total, 0) + 5 * prior) / (coalesce(n, 0) + 5), 6) as mean_value
    from e cross join m cross join s left join o using (event_type) left join c using (user_id) where not train""",
)
def prepared_by_pipeline(t):
    """Parts fitted on two thirds of the events prepare the rest."""
    events = t.events.withColumn("v", F.when(F.col("value") <= 60, F.col("value")))
    train = F.col("event_id") % 3 != 0
    steps = [
        P.Fill(inputCols=["v"], strategy="median"),
        P.Scale(inputCols=["v"], outputCols=["scaled"], kind="zscore"),
        P.Ordinal(inputCols=["event_type"], outputCols=["code"]),
        P.CountEncode(inputCols=["user_id"], outputCols=["seen"]),
        P.TargetEncode(inputCols=["event_type"], outputCols=["mean_value"], target="value", weight=5.0),
    ]
    fitted = Pipeline(stages=steps).fit(events.where(train))
    out = fitted.transform(events.where(~train))
    return out.select("event_id", r6("scaled").alias("scaled"), "code", "seen", r6("mean_value").alias("mean_value"))
