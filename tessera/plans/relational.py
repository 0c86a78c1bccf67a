"""Profiling, join, sort, set, scalar and split queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import arrays, dates, numeric, strings
from tessera.operators import joins, ordering, profile, setops, splits
from tessera.plans.registry import r6, register
from tessera.sources.tables import load

KEY = 78  # the one customer / order looked up (present at every scale factor)


@register(
    "top_rated_for_key",
    sql=f"""
    SELECT o.o_orderkey, o.o_custkey, c.c_name, o.o_totalprice
    FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    WHERE o.o_custkey = {KEY}
    ORDER BY o.o_totalprice DESC, o.o_orderkey LIMIT 10""",
)
def top_rated_for_key(spark, sf_dir, key=KEY, k=10):
    """A customer's ten largest orders, with the customer's name."""
    orders = load(spark, sf_dir, "orders")
    customer = load(spark, sf_dir, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    mine = joined.where(F.col("o_custkey") == key)
    top = ordering.top_k(mine, [F.desc("o_totalprice"), "o_orderkey"], k)
    return top.select("o_orderkey", "o_custkey", "c_name", "o_totalprice")


@register(
    "lookup_key",
    sql=f"""
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name, l.l_quantity
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    WHERE l.l_orderkey = {KEY}""",
)
def lookup_key(spark, sf_dir, key=KEY):
    """All lines of one order, with the part name looked up.

    The filter reaches the line scan; Spark chooses the join from sizes.
    """
    lines = load(spark, sf_dir, "lineitem").where(F.col("l_orderkey") == key)
    lines = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    part = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    out = joins.lookup_join(lines, part, ["l_partkey"], "inner")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "l_quantity")


@register(
    "table_counts",
    sql="""
    SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_distinct_l_orderkey,
           count(DISTINCT l_partkey) AS n_distinct_l_partkey,
           round(count(*) / count(DISTINCT l_orderkey), 6) AS rows_per_l_orderkey
    FROM lineitem""",
)
def table_counts(spark, sf_dir):
    """A01 A03 A11."""
    out = profile.table_counts(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"], "l_orderkey")
    return out.withColumn("rows_per_l_orderkey", r6("rows_per_l_orderkey"))


@register("distinct_values", sql="SELECT DISTINCT p_brand, p_type FROM part ORDER BY p_brand, p_type")
def distinct_values(spark, sf_dir):
    """A02 U02."""
    return profile.distinct_values(load(spark, sf_dir, "part"), ["p_brand", "p_type"], sort=True)


@register(
    "count_by_value",
    sql="SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment ORDER BY n, c_mktsegment",
)
def count_by_value(spark, sf_dir):
    """Customers per segment, ascending by count."""
    return profile.ascending_counts(load(spark, sf_dir, "customer"), "c_mktsegment")


@register(
    "events_per_user",
    sql="""
    SELECT user_id, count(*) AS n_events, round(sum(value), 6) AS total_value
    FROM events GROUP BY user_id ORDER BY user_id""",
)
def events_per_user(spark, sf_dir):
    """Group size per key (no group materialised), by key."""
    ev = load(spark, sf_dir, "events")
    out = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"), r6(F.sum("value")).alias("total_value"))
    return out.orderBy("user_id")


@register(
    "value_summary",
    sql="""
    SELECT count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean,
           round(stddev_pop(l_quantity), 6) AS stdev, max(l_quantity) AS max,
           min(l_quantity) AS min, round(sum(l_quantity), 6) AS total
    FROM lineitem""",
)
def value_summary(spark, sf_dir):
    """The RDD ``stats()`` five numbers plus the sum."""
    s = profile.summary(load(spark, sf_dir, "lineitem"), "l_quantity")
    return s.select("n", r6("mean").alias("mean"), r6("stdev").alias("stdev"), "max", "min", r6("total").alias("total"))


@register(
    "describe_column",
    sql="""
    SELECT count(l_extendedprice) AS n, round(avg(l_extendedprice), 6) AS mean,
           round(stddev_samp(l_extendedprice), 6) AS stddev, min(l_extendedprice) AS min,
           max(l_extendedprice) AS max
    FROM lineitem""",
)
def describe_column(spark, sf_dir):
    """A13."""
    d = profile.describe_column(load(spark, sf_dir, "lineitem"), "l_extendedprice")
    return d.select("n", r6("mean").alias("mean"), r6("stddev").alias("stddev"), "min", "max")


@register(
    "median_value",
    sql="SELECT round(median(l_extendedprice), 6) AS median_l_extendedprice FROM lineitem",
)
def median_value(spark, sf_dir):
    """A10: exact median."""
    m = profile.median(load(spark, sf_dir, "lineitem"), "l_extendedprice")
    return m.select(r6("median_l_extendedprice").alias("median_l_extendedprice"))


_HIST_SQL = """
    WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
                      count(l_extendedprice) AS total
               FROM lineitem WHERE l_extendedprice IS NOT NULL),
    c AS (SELECT CASE WHEN s.hi = s.lo THEN 0
                 ELSE least(CAST(floor((l_extendedprice - s.lo) / ((s.hi - s.lo) / 20)) AS BIGINT), 19)
                 END AS bin, count(*) AS n
          FROM lineitem, s WHERE l_extendedprice IS NOT NULL GROUP BY 1)
    SELECT g.bin, round(s.lo + g.bin * ((s.hi - s.lo) / 20), 6) AS lo,
           round(s.lo + (g.bin + 1) * ((s.hi - s.lo) / 20), 6) AS hi,
           coalesce(c.n, 0) AS n {extra}
    FROM (SELECT CAST(generate_series AS BIGINT) AS bin FROM generate_series(0, 19)) g
    CROSS JOIN s LEFT JOIN c ON g.bin = c.bin"""


def _histogram(spark, sf_dir, density):
    h = profile.histogram(load(spark, sf_dir, "lineitem"), "l_extendedprice", 20, density)
    cols = ["bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "n"]
    if density:
        cols.append(r6("density").alias("density"))
    return h.select(*cols)


@register("histogram_counts", sql=_HIST_SQL.format(extra=""))
def histogram_counts(spark, sf_dir):
    """20 equal-width bins of the extended price, every bin listed."""
    return _histogram(spark, sf_dir, False)


@register(
    "histogram_density",
    sql=_HIST_SQL.format(extra=", round(coalesce(c.n, 0) / (s.total * ((s.hi - s.lo) / 20)), 6) AS density"),
)
def histogram_density(spark, sf_dir):
    """A15 with ``normed=True``: count / (n * width)."""
    return _histogram(spark, sf_dir, True)


@register(
    "target_transforms",
    sql="""
    SELECT o_orderkey, round(ln(o_totalprice), 6) AS log_price, round(sqrt(o_totalprice), 6) AS sqrt_price,
           round(exp(ln(o_totalprice)), 6) AS exp_log_price
    FROM orders""",
)
def target_transforms(spark, sf_dir):
    """Log / sqrt of a target, and exp back."""
    o = load(spark, sf_dir, "orders")
    x = F.col("o_totalprice")
    return o.select(
        "o_orderkey", r6(F.log(x)).alias("log_price"), r6(F.sqrt(x)).alias("sqrt_price"), r6(F.exp(F.log(x))).alias("exp_log_price")
    )


@register(
    "union_rows",
    sql="""
    SELECT n_nationkey AS key, n_name AS name, 'nation' AS kind FROM nation
    UNION ALL SELECT r_regionkey, r_name, 'region' FROM region""",
)
def union_rows(spark, sf_dir):
    """Positional bag union; names from the first input."""
    n = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.lit("nation").alias("kind"))
    r = load(spark, sf_dir, "region").select("r_regionkey", "r_name", F.lit("region"))
    return setops.append_rows(n, r)


@register(
    "inner_join_using",
    sql="""
    SELECT s.s_nationkey AS nationkey, s.s_suppkey, s.s_name, n.n_name
    FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
)
def inner_join_using(spark, sf_dir):
    """Join on a shared column name; the key appears once."""
    s = load(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "nationkey").select("nationkey", "s_suppkey", "s_name")
    n = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    return joins.join_using(s, n, ["nationkey"])


_FLAGS_SQL = """
    SELECT l_orderkey, l_linenumber,
           concat_ws(',', CASE WHEN l_returnflag = 'R' THEN 'returned' END,
                          CASE WHEN l_linestatus = 'O' THEN 'open' END,
                          CASE WHEN l_discount >= 0.05 THEN 'discounted' END,
                          CASE WHEN l_tax > 0 THEN 'taxed' END,
                          CASE WHEN l_quantity >= 40 THEN 'bulk' END) AS flags
    FROM lineitem"""


@register("flags_to_names", sql=_FLAGS_SQL)
def flags_to_names(spark, sf_dir):
    """Several 0/1 flags -> the list of names that are set (joined with commas)."""
    li = load(spark, sf_dir, "lineitem")
    flags = [
        ("returned", F.col("l_returnflag") == "R"),
        ("open", F.col("l_linestatus") == "O"),
        ("discounted", F.col("l_discount") >= 0.05),
        ("taxed", F.col("l_tax") > 0),
        ("bulk", F.col("l_quantity") >= 40),
    ]
    return li.select("l_orderkey", "l_linenumber", arrays.flags_to_names(flags, ",").alias("flags"))


BASE_YEAR = 2002


def _day_month_year(ts):
    """``dd-MM-yyyy`` text from date parts: no formatter per row, no time-zone cast."""
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat_ws("-", two(F.dayofmonth(ts)), two(F.month(ts)), F.lpad(F.year(ts).cast("string"), 4, "0"))


@register(
    "year_from_text",
    sql=f"""
    WITH t AS (SELECT o_orderkey,
                      CASE WHEN o_orderpriority = '5-LOW' THEN ''
                           WHEN o_orderstatus = 'P' THEN 'unknown'
                           ELSE strftime(o_orderdate, '%d-%m-%Y') END AS date_text
               FROM orders),
    y AS (SELECT o_orderkey, coalesce(TRY_CAST(right(date_text, 4) AS INTEGER), 1900) AS year FROM t)
    SELECT o_orderkey, year, CAST({BASE_YEAR} - year AS INTEGER) AS age,
           round(CASE WHEN year = 1900 THEN (SELECT avg(year) FROM y WHERE year <> 1900)
                      ELSE year END, 6) AS year_filled
    FROM y""",
)
def year_from_text(spark, sf_dir):
    """Year from the text's last four characters (1900 when missing), age from
    a base year, and every missing year filled with the mean of the known ones."""
    o = load(spark, sf_dir, "orders")
    text = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
        .when(F.col("o_orderstatus") == "P", F.lit("unknown"))
        .otherwise(_day_month_year("o_orderdate"))
    )
    y = o.select("o_orderkey", strings.year_from_text(text).alias("year"))
    known_mean = y.where(F.col("year") != 1900).agg(F.avg("year")).scalar()
    filled = F.when(F.col("year") == 1900, known_mean).otherwise(F.col("year").cast("double"))
    return y.select("o_orderkey", "year", numeric.age_from_year("year", BASE_YEAR).alias("age"), r6(filled).alias("year_filled"))


_RAW_TITLE_SQL = (
    "concat(p_name, ' (', CASE WHEN p_size % 2 = 0 THEN p_type ELSE p_brand END, ') (', CAST(p_size AS VARCHAR), ')')"
)


@register(
    "title_strip",
    sql=f"""
    WITH t AS (SELECT p_partkey, {_RAW_TITLE_SQL} AS raw FROM part)
    SELECT p_partkey, raw,
           CASE WHEN regexp_matches(raw, '\\([\\p{{L}}\\p{{N}}_]+\\)')
                THEN trim(regexp_extract(raw, '^(.*?)\\([\\p{{L}}\\p{{N}}_]+\\)', 1))
                ELSE raw END AS title
    FROM t""",
)
def title_strip(spark, sf_dir):
    """text before the first one-word parenthesis ("Seven (Se7en) (1995)" -> "Seven")."""
    p = load(spark, sf_dir, "part")
    raw = F.concat(
        F.col("p_name"), F.lit(" ("),
        F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(F.col("p_brand")),
        F.lit(") ("), F.col("p_size").cast("string"), F.lit(")"),
    )
    t = p.select("p_partkey", raw.alias("raw"))
    return t.select("p_partkey", "raw", strings.title_without_parenthesis("raw").alias("title"))


@register(
    "clean_numeric",
    sql="""
    WITH t AS (SELECT c_custkey,
                      CASE WHEN c_mktsegment = 'BUILDING' THEN '?'
                           WHEN c_nationkey = 0 THEN 'n/a'
                           ELSE '"' || CAST(c_acctbal AS VARCHAR) || '"' END AS raw
               FROM customer),
    v AS (SELECT c_custkey, raw,
                 CASE WHEN contains(replace(raw, '"', ''), '?') THEN 0.0
                      ELSE TRY_CAST(replace(raw, '"', '') AS DOUBLE) END AS v
          FROM t)
    SELECT c_custkey, CASE WHEN v < 0 THEN 0.0 ELSE v END AS acctbal_clean,
           CASE WHEN raw IS NOT NULL AND v IS NULL THEN 1 ELSE 0 END AS rejected
    FROM v""",
)
def clean_numeric(spark, sf_dir):
    """Quoted numeric text with "?" and negatives cleaned to doubles."""
    c = load(spark, sf_dir, "customer")
    raw = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("?"))
        .when(F.col("c_nationkey") == 0, F.lit("n/a"))
        .otherwise(F.concat(F.lit('"'), F.col("c_acctbal").cast("string"), F.lit('"')))
    )
    t = c.select("c_custkey", raw.alias("raw"))
    return t.select(
        "c_custkey", numeric.clean_numeric("raw").alias("acctbal_clean"), numeric.rejected("raw").alias("rejected")
    )


@register(
    "safe_half",
    sql="""
    SELECT p_partkey, right(p_brand, 2) AS code, TRY_CAST(right(p_brand, 2) AS DOUBLE) / 2 AS half
    FROM part""",
)
def safe_half(spark, sf_dir):
    """Halve a code that is sometimes not a number (null then, not an error)."""
    p = load(spark, sf_dir, "part").select("p_partkey", F.right("p_brand", F.lit(2)).alias("code"))
    return p.select("p_partkey", "code", numeric.safe_half("code").alias("half"))


@register("hour_of_day", sql="SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour FROM events")
def hour_of_day(spark, sf_dir):
    """F08 M20."""
    return load(spark, sf_dir, "events").select("event_id", dates.hour_of_timestamp("ts").alias("hour"))


@register(
    "time_of_day",
    sql="""
    SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour,
           CASE WHEN hour(ts) >= 7 AND hour(ts) < 12 THEN 'morning'
                WHEN hour(ts) >= 12 AND hour(ts) < 14 THEN 'lunch'
                WHEN hour(ts) >= 14 AND hour(ts) < 18 THEN 'afternoon'
                WHEN hour(ts) >= 18 AND hour(ts) < 23 THEN 'evening'
                ELSE 'night' END AS period
    FROM events""",
)
def time_of_day(spark, sf_dir):
    """Time-of-day band of the event hour."""
    h = load(spark, sf_dir, "events").select("event_id", dates.hour_of_timestamp("ts").alias("hour"))
    return h.select("event_id", "hour", dates.time_of_day("hour").alias("period"))


@register(
    "time_of_day_literal",
    sql="""
    SELECT event_id, CASE WHEN hour(ts) > 7 THEN 'morning' ELSE 'night' END AS period FROM events""",
)
def time_of_day_literal(spark, sf_dir):
    """F11 D08 as the source's code behaves (its first branch shadows the others)."""
    h = load(spark, sf_dir, "events").select("event_id", dates.hour_of_timestamp("ts").alias("hour"))
    return h.select("event_id", dates.time_of_day_literal("hour").alias("period"))


@register("iso_weekday", sql="SELECT o_orderkey, CAST(isodow(o_orderdate) AS INTEGER) AS iso_dow FROM orders")
def iso_weekday(spark, sf_dir):
    """F09."""
    return load(spark, sf_dir, "orders").select("o_orderkey", dates.iso_weekday("o_orderdate").alias("iso_dow"))


@register(
    "weekend_flag",
    sql="SELECT o_orderkey, CAST(CASE WHEN isodow(o_orderdate) > 5 THEN 1 ELSE 0 END AS DOUBLE) AS weekend FROM orders",
)
def weekend_flag(spark, sf_dir):
    """F10."""
    return load(spark, sf_dir, "orders").select("o_orderkey", dates.weekend_flag("o_orderdate").alias("weekend"))


@register(
    "rename_drop_select",
    sql="""
    SELECT l_orderkey, l_linenumber, l_extendedprice AS price, CAST(l_quantity AS INTEGER) AS qty, l_returnflag
    FROM lineitem WHERE l_linestatus <> 'O'""",
)
def rename_drop_select(spark, sf_dir):
    """Drop, rename, cast, select by name, inequality filter."""
    li = load(spark, sf_dir, "lineitem").drop("l_tax", "l_shipdate").withColumnRenamed("l_extendedprice", "price")
    li = li.where(F.col("l_linestatus") != "O")
    return li.select("l_orderkey", "l_linenumber", "price", F.col("l_quantity").cast("int").alias("qty"), "l_returnflag")


@register(
    "top_k_per_group",
    sql="""
    SELECT * FROM (
        SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice,
               CAST(rank() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC) AS BIGINT) AS rnk
        FROM lineitem) WHERE rnk <= 5""",
)
def top_k_per_group(spark, sf_dir):
    """Five most expensive lines per supplier, ties kept."""
    li = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    top = ordering.top_k_per_group(li, ["l_suppkey"], [F.desc("l_extendedprice")], 5, "rnk")
    return top.withColumn("rnk", F.col("rnk").cast("long"))


@register(
    "multi_sort_desc",
    sql="""
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    ORDER BY o_orderstatus DESC, o_totalprice DESC, o_orderkey""",
)
def multi_sort_desc(spark, sf_dir):
    """Sort by several columns, all descending (key last for a total order)."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return ordering.sort_desc(o, ["o_orderstatus", "o_totalprice"], ["o_orderkey"])


@register(
    "kfold_split",
    sql="""
    SELECT o_orderkey,
           CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1)
                / (SELECT ceil(count(*) / 5.0) FROM orders)) AS BIGINT) AS fold
    FROM orders""",
)
def kfold_split(spark, sf_dir):
    """Five contiguous folds in key order; fold i is the test set of split i."""
    o = load(spark, sf_dir, "orders").select("o_orderkey")
    return splits.positional_folds(o, ["o_orderkey"], 5)


HOLDOUT = dict(start=1, stop=10, max_test=1000)


@register(
    "holdout_per_user",
    sql=f"""
    WITH r AS (SELECT event_id, user_id,
                      row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
    q AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS qn
          FROM r WHERE k BETWEEN {HOLDOUT['start']} AND {HOLDOUT['stop']})
    SELECT r.event_id, r.user_id,
           CASE WHEN q.qn IS NOT NULL AND q.qn <= {HOLDOUT['max_test']} THEN 'test' ELSE 'base' END AS part
    FROM r LEFT JOIN q ON r.event_id = q.event_id""",
)
def holdout_per_user(spark, sf_dir):
    """Events 1-10 of every user are test rows, at most 1000 in event order."""
    ev = load(spark, sf_dir, "events").select("event_id", "user_id")
    out = splits.holdout_per_key(ev, "user_id", ["event_id"], id_col="event_id", **HOLDOUT)
    return out.select("event_id", "user_id", "part")


@register(
    "hash_split_share",
    sql="""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN CAST('0x' || substr(md5(concat_ws('|', '42', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 8) AS BIGINT)
                % 10 < 8 THEN 'train' ELSE 'test' END AS part
    FROM lineitem""",
)
def hash_split_share(spark, sf_dir):
    """Partition-independent 80/20 split of the lines by a hash of their identity."""
    li = load(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return li.select(*keys, splits.hash_split(li, keys).alias("part"))


@register(
    "hour_of_epoch",
    sql="SELECT event_id, CAST((CAST(floor(epoch(ts)) AS BIGINT) // 3600) % 24 AS INTEGER) AS hour FROM events",
)
def hour_of_epoch(spark, sf_dir):
    """epoch seconds to the hour of the day, whatever the session's time zone."""
    ev = load(spark, sf_dir, "events")
    seconds = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', cast(ts as timestamp_ntz))")
    return ev.select("event_id", dates.hour_of_epoch(seconds).alias("hour"))


@register(
    "unmatched_left_join",
    sql="""
    SELECT c.c_custkey, o.o_orderkey FROM customer c LEFT JOIN
      (SELECT * FROM orders WHERE o_orderstatus = 'P') o ON c.c_custkey = o.o_custkey""",
)
def unmatched_left_join(spark, sf_dir):
    """Customers without a pending order keep one row with a null order."""
    c = load(spark, sf_dir, "customer").select("c_custkey")
    o = load(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return joins.join_using(c, o, ["c_custkey"], "left")


@register(
    "numeric_two_key_sort",
    sql="SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem ORDER BY l_partkey, l_orderkey, l_linenumber",
)
def numeric_two_key_sort(spark, sf_dir):
    """The whole table sorted by numeric keys."""
    li = load(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber")
    return li.orderBy("l_partkey", "l_orderkey", "l_linenumber")


@register(
    "fold_train_side",
    sql="""
    WITH f AS (SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1)
                      / (SELECT ceil(count(*) / 5.0) FROM orders)) AS BIGINT) AS fold FROM orders)
    SELECT o_orderkey, fold FROM f WHERE fold <> 2""",
)
def fold_train_side(spark, sf_dir):
    """The train side of split 2."""
    folded = splits.positional_folds(load(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 5)
    return splits.fold_split(folded, 2)[0]


def _holdout_sql(start, stop, cap):
    capped = f"q.qn <= {cap}" if cap else "TRUE"
    return f"""
    WITH r AS (SELECT event_id, user_id,
                      row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
    q AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS qn FROM r WHERE k BETWEEN {start} AND {stop})
    SELECT r.event_id, r.user_id, CASE WHEN q.qn IS NOT NULL AND {capped} THEN 'test' ELSE 'base' END AS part
    FROM r LEFT JOIN q ON r.event_id = q.event_id"""


@register("holdout_11_20", sql=_holdout_sql(11, 20, 1000))
def holdout_11_20(spark, sf_dir):
    """Events 11-20 of every user, at most 1000 in event order."""
    ev = load(spark, sf_dir, "events").select("event_id", "user_id")
    return splits.holdout_per_key(ev, "user_id", ["event_id"], 11, 20, 1000, "event_id").select("event_id", "user_id", "part")


@register("holdout_uncapped", sql=_holdout_sql(1, 10, 0))
def holdout_uncapped(spark, sf_dir):
    """Events 1-10 of every user, all of them."""
    ev = load(spark, sf_dir, "events").select("event_id", "user_id")
    return splits.holdout_per_key(ev, "user_id", ["event_id"], 1, 10, 0, "event_id").select("event_id", "user_id", "part")


_DERIVED_HIST_SQL = """
    WITH x AS (SELECT 'log' AS kind, ln(o_totalprice) AS x FROM orders
               UNION ALL SELECT 'sqrt', sqrt(o_totalprice) FROM orders),
    s AS (SELECT kind, min(x) AS lo, max(x) AS hi FROM x GROUP BY kind),
    c AS (SELECT x.kind, least(CAST(floor((x - s.lo) / ((s.hi - s.lo) / 10)) AS BIGINT), 9) AS bin, count(*) AS n
          FROM x JOIN s ON x.kind = s.kind GROUP BY 1, 2)
    SELECT s.kind, g.bin, round(s.lo + g.bin * ((s.hi - s.lo) / 10), 6) AS lo, coalesce(c.n, 0) AS n
    FROM s CROSS JOIN (SELECT CAST(generate_series AS BIGINT) AS bin FROM generate_series(0, 9)) g
    LEFT JOIN c ON c.kind = s.kind AND c.bin = g.bin"""


@register("derived_histograms", sql=_DERIVED_HIST_SQL)
def derived_histograms(spark, sf_dir):
    """Histograms of the logarithm and the square root of a target."""
    o = load(spark, sf_dir, "orders")
    out = []
    for kind, value in (("log", F.log("o_totalprice")), ("sqrt", F.sqrt("o_totalprice"))):
        h = profile.histogram(o.select(value.alias("x")), "x", 10)
        out.append(h.select(F.lit(kind).alias("kind"), "bin", r6("lo").alias("lo"), "n"))
    return setops.append_rows(*out)


@register(
    "age_distribution",
    sql=f"""
    SELECT CAST({BASE_YEAR} - year(o_orderdate) AS INTEGER) AS age, count(*) AS n FROM orders GROUP BY 1""",
)
def age_distribution(spark, sf_dir):
    """How many orders of each age, from a base year."""
    ages = load(spark, sf_dir, "orders").select(numeric.age_from_year(F.year("o_orderdate"), BASE_YEAR).alias("age"))
    return profile.count_by(ages, ["age"])


@register(
    "array_means",
    sql="SELECT vec_id, round(list_avg(CAST(embedding AS DOUBLE[])), 6) AS mean FROM embeddings",
)
def array_means(spark, sf_dir):
    """The mean of every vector."""
    return load(spark, sf_dir, "embeddings").select("vec_id", r6(arrays.array_mean("embedding")).alias("mean"))


@register(
    "formatted_numbers",
    sql="SELECT l_orderkey, l_linenumber, format('{:,.2f}', l_extendedprice) AS price FROM lineitem",
)
def formatted_numbers(spark, sf_dir):
    """numbers as text with two places and thousands separators."""
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.format_number("l_extendedprice", 2).alias("price"))
