"""Scalar functions: strings, dates, numbers, arrays, JSON."""

from pyspark.sql import functions as F

from lodestat.functions import dates as D
from lodestat.functions import scalars as X
from lodestat.functions import text as T
from lodestat.operators.cleaning import columns_of_kind
from lodestat.operators.quantiles import quantile_values
from lodestat.plans.registry import plan, r6


def _zero(c):
    """Rounding may leave a negative zero; make it zero."""
    return r6(c) + 0.0


@plan("str_lower_all", "select p_partkey, lower(p_name) as p_name, lower(p_brand) as p_brand, lower(p_type) as p_type from part")
def str_lower_all(t):
    p = t.part.select("p_partkey", "p_name", "p_brand", "p_type")
    return p.withColumns({c: F.lower(c) for c in columns_of_kind(p, "string")})


@plan(
    "str_money_percent",
    "select l_orderkey, l_linenumber, round(l_extendedprice, 2) as price, round(l_discount * 100, 1) + 0.0 as discount from lineitem",
)
def str_money_percent(t):
    dirty = t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("$"), F.format_number("l_extendedprice", 2)).alias("price"),
        F.format_string("%.1f%%", F.col("l_discount") * 100).alias("discount"),
    )
    return dirty.withColumns({"price": X.money(F.col("price")), "discount": X.money(F.col("discount")) + 0.0})


@plan("str_replace_suffix", "select p_partkey, p_type as label from part")
def str_replace_suffix(t):
    dotted = t.part.select("p_partkey", F.concat("p_type", F.when(F.col("p_partkey") % 2 == 0, ".").otherwise("")).alias("label"))
    return dotted.withColumn("label", F.regexp_replace("label", r"\.$", ""))


@plan("str_split_struct", "select split_part(c_name, '#', 1) as kind, split_part(c_name, '#', 2)::bigint as number from customer")
def str_split_struct(t):
    piece = F.split("c_name", "#", 2)
    fields = F.struct(F.get(piece, F.lit(0)).alias("kind"), F.get(piece, F.lit(1)).cast("long").alias("number"))
    return t.customer.select(fields.alias("s")).select("s.*")


@plan(
    "str_hex_tail_to_int",
    """with h as (select doc_id, ('0x' || right(md5(doc_id::varchar), 16))::ubigint::hugeint as u from documents)
    select doc_id, (case when u >= 9223372036854775808 then u - 18446744073709551616 else u end)::bigint as code from h""",
)
def str_hex_tail_to_int(t):
    return t.documents.select("doc_id", X.signed_hex_tail(F.md5(F.col("doc_id").cast("string"))).alias("code"))


@plan("str_format_percent", "select l_orderkey, l_linenumber, printf('%.2f%%', l_extendedprice / 101300 * 100) as share from lineitem")
def str_format_percent(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", X.percent_text(F.col("l_extendedprice") / 101300).alias("share"))


@plan(
    "str_title_case",
    """select event_id, upper(event_type[1]) || event_type[2:] || ' Count Usd' as label from events""",
)
def str_title_case(t):
    snake = F.concat("event_type", F.lit("_count_usd"))
    return t.events.select("event_id", F.initcap(F.replace(snake, F.lit("_"), F.lit(" "))).alias("label"))


@plan(
    "str_suffix_rules",
    """with e as (select event_id, event_type, value, md5(event_id::varchar) as device, event_id::varchar as card from events)
    select event_id, case when event_type in ('click', 'view') then case when value < 5 then 0.9 when device like '%16' or device like '%78' or device like '%23' then 0.1 else 0.05 end
    else case when value > 150 then 0.8 when card like '%01' or card like '%02' or card like '%03' then 0.3 when device like '%a7' or device like '%b4' then 0.2 else 0.0001 end end::double as risk from e""",
)
def str_suffix_rules(t):
    device, card, value = F.md5(F.col("event_id").cast("string")), F.col("event_id").cast("string"), F.col("value")

    def ends(c, tails):
        return c.rlike("(" + "|".join(tails) + ")$")

    usual = F.when(value < 5, 0.9).when(ends(device, ["16", "78", "23"]), 0.1).otherwise(0.05)
    other = F.when(value > 150, 0.8).when(ends(card, ["01", "02", "03"]), 0.3).when(ends(device, ["a7", "b4"]), 0.2).otherwise(0.0001)
    return t.events.select("event_id", F.when(F.col("event_type").isin("click", "view"), usual).otherwise(other).alias("risk"))


STOP_SQL = "[" + ", ".join(f"'{w}'" for w in T.STOP_WORDS) + "]"


@plan(
    "text_clean_stopwords",
    rf"""select doc_id, md5(c) as digest, length(text)::bigint as before, length(c)::bigint as after from (
    select doc_id, text, array_to_string(list_filter(list_transform(list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'),
    lambda w: w <> '' and not list_contains({STOP_SQL}, lower(w))), lambda w: regexp_replace(w, '[^A-Za-z0-9_]+', '', 'g')), lambda w: regexp_matches(w, '^[A-Za-z]+$')), ' ') as c
    from documents)""",
)
def text_clean_stopwords(t):
    d = t.documents.select("doc_id", "text", T.without_stop_words(F.col("text")).alias("c"))
    return d.select("doc_id", F.md5("c").alias("digest"), F.length("text").cast("long").alias("before"), F.length("c").cast("long").alias("after"))


@plan("date_parse_month_end", "select o_orderkey, last_day(o_orderdate)::timestamp as month_end from orders")
def date_parse_month_end(t):
    return t.orders.select("o_orderkey", D.month_end(F.date_format("o_orderdate", "MM/yyyy")).cast("timestamp_ntz").alias("month_end"))


@plan(
    "date_repair",
    """select o_orderkey, case when o_orderkey % 11 = 0 then 'none' else strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') end as month from orders""",
)
def date_repair(t):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    # years after 1999 are written the way a spreadsheet mangles them: "1-Sep" for September 2001
    mangled = F.concat(F.regexp_replace(F.date_format(day, "yy"), "^0", ""), F.lit("-"), F.date_format(day, "MMM"))
    text = F.when(key % 11 == 0, "??").when(F.year(day) >= 2000, mangled).otherwise(F.date_format(day, "MMM-yy"))
    return t.orders.select("o_orderkey", F.coalesce(D.repair_month(text).cast("string"), F.lit("none")).alias("month"))


@plan(
    "date_parts",
    """select event_id, year(ts)::integer as year, quarter(ts)::integer as quarter, month(ts)::integer as month, day(ts)::integer as day,
    isodow(ts)::integer as weekday, hour(ts)::integer as hour, weekofyear(ts)::integer as iso_week from events""",
)
def date_parts(t):
    return t.events.select("event_id", *[c.alias(n) for n, c in D.parts(F.col("ts")).items()])


@plan(
    "date_durations",
    """select l_orderkey, l_linenumber, l_partkey, trunc(epoch_us(l_shipdate - o_orderdate) / 86400000000)::integer as days from lineitem join orders on l_orderkey = o_orderkey""",
)
def date_durations(t):
    joined = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", D.whole_days(F.col("l_shipdate"), F.col("o_orderdate")).alias("days"))


def _cyclic_sql(value, period, name):
    a = f"{value} * (2 * pi() / {period})"
    return f"round(sin({a}), 6) + 0.0 as {name}_sin, round(cos({a}), 6) + 0.0 as {name}_cos"


@plan(
    "date_cyclic",
    f"""select event_id, {_cyclic_sql('month(ts)', 12, 'month')}, {_cyclic_sql('isodow(ts)', 7, 'weekday')}, {_cyclic_sql('hour(ts)', 24, 'hour')},
    round((day(ts) - 1) / 30, 6) as day_scaled, round(hour(ts) / 23, 6) as hour_scaled from events""",
)
def date_cyclic(t):
    p = D.parts(F.col("ts"))
    waves = {**D.cyclic(p["month"], 12, "month"), **D.cyclic(p["weekday"], 7, "weekday"), **D.cyclic(p["hour"], 24, "hour")}
    return t.events.select(
        "event_id", *[_zero(c).alias(n) for n, c in waves.items()],
        r6((p["day"] - 1) / 30).alias("day_scaled"), r6(p["hour"] / 23).alias("hour_scaled"),
    )


@plan(
    "date_time_radians",
    "select event_id, round((hour(ts) * 3600 + minute(ts) * 60 + second(ts)) * (2 * pi() / 86400), 6) as angle from events",
)
def date_time_radians(t):
    from lodestat.operators.windows import time_angle

    return t.events.select("event_id", r6(time_angle("ts")).alias("angle"))


@plan(
    "date_from_parts",
    """select event_id, strftime(ts, '%Y-%m-%d') as day, strftime(ts, '%H:%M') as clock from events""",
)
def date_from_parts(t):
    ev = t.events.select(
        "event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.dayofmonth("ts").alias("d"),
        (F.hour("ts") * 100 + F.minute("ts")).alias("hhmm"),
    )
    digits = F.lpad(F.col("hhmm").cast("string"), 4, "0")
    clock = F.concat(F.substring(digits, 1, 2), F.lit(":"), F.substring(digits, 3, 2))
    return ev.select("event_id", F.make_date("y", "m", "d").cast("string").alias("day"), clock.alias("clock"))


@plan(
    "date_filter_year",
    "select o_orderstatus, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share from orders where year(o_orderdate) = 1998 group by 1",
)
def date_filter_year(t):
    from lodestat.operators.aggregates import value_counts

    # a range on the stored column reaches the Parquet scan; year(column) = 1998 would not
    day = F.col("o_orderdate")
    year = (day >= F.lit("1998-01-01").cast("timestamp_ntz")) & (day < F.lit("1999-01-01").cast("timestamp_ntz"))
    return value_counts(t.orders.filter(year), "o_orderstatus").withColumn("share", r6("share"))


KEY = ["l_orderkey", "l_linenumber", "l_partkey"]
KEY_SQL = ", ".join(KEY)


@plan(
    "math_logs",
    f"""select {KEY_SQL}, round(ln(1 + l_quantity), 6) as log1p_qty, round(log10(l_extendedprice), 6) as log10_price,
    round(ln(l_tax + 1e-6), 6) as log_tax, round(exp(l_discount), 6) as exp_discount from lineitem""",
)
def math_logs(t):
    return t.lineitem.select(
        *KEY, r6(F.log1p("l_quantity")).alias("log1p_qty"), r6(F.log10("l_extendedprice")).alias("log10_price"),
        r6(F.log(F.col("l_tax") + 1e-6)).alias("log_tax"), r6(F.exp("l_discount")).alias("exp_discount"),
    )


@plan(
    "math_powers",
    f"""select {KEY_SQL}, round(l_quantity * l_quantity, 6) as l_quantity_squared, round(l_quantity * l_quantity * l_quantity, 6) as l_quantity_cubed,
    round(sqrt(l_quantity), 6) as l_quantity_sqrt from lineitem""",
)
def math_powers(t):
    return t.lineitem.select(*KEY, *[r6(c).alias(n) for n, c in X.powers(["l_quantity"]).items()])


ROW = "[l_quantity, l_discount * 10, l_tax * 10, l_linenumber]"


@plan(
    "math_row_reduce",
    f"""select {KEY_SQL}, round(l_quantity * l_discount * 10 * l_tax * 10 * l_linenumber, 5) + 0.0 as row_product, round(l_quantity + l_discount * 10 + l_tax * 10 + l_linenumber, 5) as row_sum,
    round(list_median({ROW}), 5) as row_median, round(list_max({ROW}), 5) as row_max, round(list_stddev_samp({ROW}), 5) as row_std from lineitem""",
)
def math_row_reduce(t):
    li = t.lineitem.select(
        *KEY, "l_quantity", (F.col("l_discount") * 10).alias("d10"), (F.col("l_tax") * 10).alias("t10"),
        F.col("l_linenumber").cast("double").alias("ln"),
    )
    cells = X.row_reductions(["l_quantity", "d10", "t10", "ln"])
    return li.select(*KEY, *[(r6(c, 5) + 0.0).alias(n) for n, c in cells.items()])


INTER = ["l_quantity", "l_discount", "l_tax"]


def _interaction_sql():
    a, b, c = INTER
    signs = {"add": "+", "sub": "-", "mul": "*"}
    cells = []
    for name, s in signs.items():
        cells += [f"round({x} {s} {y}, 6) + 0.0 as {x}_{name}_{y}" for x, y in ((a, b), (a, c), (b, c))]
        cells.append(f"round({a} {s} ({b} {s} {c}), 6) + 0.0 as {a}_{name}_{b}_{name}_{c}")
    return ", ".join(cells)


@plan("math_interactions", f"select {KEY_SQL}, {_interaction_sql()} from lineitem")
def math_interactions(t):
    return t.lineitem.select(*KEY, *[_zero(c).alias(n) for n, c in X.interactions(INTER).items()])


@plan(
    "math_polynomial",
    f"""with e as (select {KEY_SQL}, l_quantity / 50 as a, l_discount as b from lineitem) select {KEY_SQL}, round(a, 6) as a, round(b, 6) + 0.0 as b,
    round(a * a, 6) as a_x_a, round(a * b, 6) + 0.0 as a_x_b, round(b * b, 6) + 0.0 as b_x_b, round(a * a * a, 6) as a_x_a_x_a, round(a * a * b, 6) + 0.0 as a_x_a_x_b,
    round(a * b * b, 6) + 0.0 as a_x_b_x_b, round(b * b * b, 6) + 0.0 as b_x_b_x_b from e""",
)
def math_polynomial(t):
    li = t.lineitem.select(*KEY, (F.col("l_quantity") / 50).alias("a"), F.col("l_discount").alias("b"))
    return li.select(*KEY, *[_zero(c).alias(n) for n, c in X.monomials(["a", "b"], 3).items()])


@plan(
    "math_combined_ratios",
    """with i as (select l_orderkey, sum(l_quantity) as qty, count(*) as lines, sum(l_extendedprice) as price from lineitem group by 1)
    select o_orderkey, round(qty / nullif(lines, 0), 6) as qty_per_line, round(price / nullif(o_totalprice, 0), 6) as price_share, round(o_totalprice / nullif(lines, 0), 6) as total_per_line
    from orders join i on o_orderkey = l_orderkey""",
)
def math_combined_ratios(t):
    i = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("lines"), F.sum("l_extendedprice").alias("price")
    )
    j = t.orders.select("o_orderkey", "o_totalprice").join(i, "o_orderkey")
    return j.select(
        "o_orderkey", r6(F.try_divide("qty", "lines")).alias("qty_per_line"), r6(F.try_divide("price", "o_totalprice")).alias("price_share"),
        r6(F.try_divide("o_totalprice", "lines")).alias("total_per_line"),
    )


@plan(
    "math_sigmoid",
    """with z as (select event_id, (value - 50) / 10 as z from events) select event_id, round(case when z >= 0 then 1 / (1 + exp(-z)) else exp(z) / (1 + exp(z)) end, 6) as sigmoid,
    round(greatest(z, 0) + ln(1 + exp(-abs(z))), 6) as softplus from z""",
)
def math_sigmoid(t):
    z = (F.col("value") - 50) / 10
    return t.events.select("event_id", r6(X.sigmoid(z)).alias("sigmoid"), r6(X.softplus(z)).alias("softplus"))


LAMBDAS = [round(-1 + 0.25 * i, 2) for i in range(9)]


@plan(
    "math_boxcox",
    """with l as (select unnest([-1, -0.75, -0.5, -0.25, 0, 0.25, 0.5, 0.75, 1])::double as lam),
    y as (select lam, ln(o_totalprice) as lx, case when lam = 0 then ln(o_totalprice) else (pow(o_totalprice, lam) - 1) / lam end as y from orders, l)
    select lam, round((lam - 1) * sum(lx) - count(*) / 2 * ln(var_pop(y)), 2) as log_likelihood from y group by 1""",
)
def math_boxcox(t):
    x = F.col("o_totalprice")
    # the whole grid is scored by one aggregate over the rows
    row = t.orders.agg(
        F.sum(F.log(x)).alias("lx"), F.count(x).alias("n"),
        *[F.var_pop(X.box_cox(x, lam)).alias(f"v{i}") for i, lam in enumerate(LAMBDAS)],
    )
    cells = [
        F.struct(F.lit(lam).alias("lam"), r6((lam - 1) * F.col("lx") - F.col("n") / 2 * F.log(f"v{i}"), 2).alias("log_likelihood"))
        for i, lam in enumerate(LAMBDAS)
    ]
    return row.select(F.inline(F.array(*cells)))


@plan(
    "math_cap_percentiles",
    """with r as (select event_id, value, value - (select avg(value) from events) as r from events),
    q as (select quantile_cont(r, 0.005) as lo, quantile_cont(r, 0.995) as hi, median(value) as m from r)
    select event_id, greatest(round(greatest(least(r, hi), lo) + m), 1) as adjusted from r, q""",
)
def math_cap_percentiles(t):
    mean = t.events.agg(F.avg("value")).scalar()
    r = t.events.select("event_id", "value", (F.col("value") - mean).alias("r"))
    q = quantile_values(r, ["r", "value"], {"lo": 0.005, "mid": 0.5, "hi": 0.995})
    capped = F.greatest(F.least(F.col("r"), F.lit(q["r_hi"])), F.lit(q["r_lo"])) + q["value_mid"]
    return r.select("event_id", F.greatest(F.round(capped), F.lit(1.0)).alias("adjusted"))


@plan(
    "math_lift",
    """with g as (select user_id, avg((event_type = 'purchase')::integer) filter (ts < timestamp '2024-01-16') as p0,
    avg((event_type = 'purchase')::integer) filter (ts >= timestamp '2024-01-16') as p1 from events group by 1)
    select user_id, round(p1 - p0, 6) + 0.0 as additive, round(case when abs(p0) > 1e-12 then (p1 - p0) / p0 end, 6) + 0.0 as multiplicative from g""",
)
def math_lift(t):
    buy = (F.col("event_type") == "purchase").cast("double")
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    g = t.events.groupBy("user_id").agg(F.avg(F.when(~late, buy)).alias("p0"), F.avg(F.when(late, buy)).alias("p1"))
    return g.select(
        "user_id", _zero(X.lift(F.col("p0"), F.col("p1"))).alias("additive"),
        _zero(X.lift(F.col("p0"), F.col("p1"), "multiplicative")).alias("multiplicative"),
    )


@plan("json_extract", "select event_id, (props->>'k')::integer as k from events")
def json_extract(t):
    return t.events.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@plan(
    "array_argmax_probs",
    "select vec_id, (list_position(embedding, list_max(embedding)) - 1)::integer as place, round(list_max(embedding)::double, 6) as value from embeddings",
)
def array_argmax_probs(t):
    best = X.argmax_with_value(F.col("embedding"))
    return t.embeddings.select("vec_id", best.alias("b")).select("vec_id", "b.place", r6(F.col("b.value").cast("double")).alias("value"))


@plan(
    "str_label_from_filename",
    """select regexp_extract(p_name || p_partkey || '.jpg', '^([a-z]+)', 1) as label, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share from part group by 1""",
)
def str_label_from_filename(t):
    from lodestat.operators.aggregates import value_counts

    name = F.concat("p_name", F.col("p_partkey").cast("string"), F.lit(".jpg"))
    labels = t.part.select(F.regexp_extract(name, "^([a-z]+)", 1).alias("label"))
    return value_counts(labels, "label").withColumn("share", r6("share"))


@plan(
    "array_membership",
    "select doc_id, list_contains(string_split(text, ' '), 'the')::integer as has_the, list_contains(string_split(text, ' '), 'data')::integer as has_data from documents",
)
def array_membership(t):
    pieces = F.split("text", " ")
    return t.documents.select(
        "doc_id", F.array_contains(pieces, "the").cast("int").alias("has_the"), F.array_contains(pieces, "data").cast("int").alias("has_data")
    )
