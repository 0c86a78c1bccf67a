"""Stream queries (ST01-ST10): the events table replayed through a file stream.

Purchases are events: ``user_id`` is the user, ``event_type`` the product and ``value``
the price.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.registry import r6, register
from tessera.sources.tables import load
from tessera.streaming import streams


def _purchases(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("user"), F.col("event_type").alias("product"), F.col("value").alias("price"))


@register(
    "purchase_summary",
    sql="""
    SELECT count(*) AS n_purchases, count(DISTINCT user_id) AS unique_users, round(sum(value), 6) AS revenue
    FROM events""",
)
def purchase_summary(spark, sf_dir):
    """ST04a-c: the per-batch metrics, over the whole table as one batch."""
    m = streams.purchase_metrics(_purchases(spark, sf_dir))
    return m.select("n_purchases", "unique_users", r6("revenue").alias("revenue"))


@register(
    "products_by_popularity",
    sql="SELECT event_type AS product, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, product",
)
def products_by_popularity(spark, sf_dir):
    """ST04d O04: purchases per product, most popular first."""
    return streams.products_by_popularity(_purchases(spark, sf_dir))


#: The events are replayed in so many slices of eight days, each a batch of its own.
SLICES = 4
_SLICE_SQL = "(day(ts) - 1) // 8"


def _replay(spark, rows, base, start, kind="text"):
    """Writes ``rows`` (with ``slice``) below the shared folder a slice at a time, and runs the stream that
    ``start`` gives over what is new, from its checkpoint."""
    for k in range(SLICES):
        rows.where(F.col("slice") == k).drop("slice").write.mode("append").format(kind).save(f"{base}/in")
        start().awaitTermination()


def _slice(ts="ts"):
    return F.floor((F.dayofmonth(ts) - 1) / 8).alias("slice")


def _each_batch(session, sink, base):
    def start():
        lines = streams.line_stream(session, f"{base}/in")
        return (
            lines.writeStream.option("checkpointLocation", f"{base}/checkpoint").foreachBatch(sink).trigger(availableNow=True).start()
        )

    return start


def purchase_lines(spark, sf_dir):
    """``events`` as ``user,product,price`` text lines; for every 50th event a malformed line (cut short)
    stands beside the good one."""
    ev = load(spark, sf_dir, "events")
    user, price = F.col("user_id").cast("string"), F.col("value").cast("string")
    spoiled = F.when(F.col("event_id") % 50 == 0, F.concat_ws(",", user, "event_type"))
    lines = F.array_compact(F.array(F.concat_ws(",", user, "event_type", price), spoiled))
    return ev.select(F.explode(lines).alias("value"), _slice())


@register(
    "revenue_per_user",
    sql="SELECT user_id, count(*) AS n_purchases, round(sum(value), 6) AS revenue FROM events GROUP BY user_id",
)
def revenue_per_user(spark, sf_dir):
    """ST05 A17 ST01 ST10 S14: running purchases and revenue per user, kept in the state store of a stream
    over the events, restarted for each of four batches; the result is the state after the last, read
    from the state store."""
    base = streams.scratch_dir(spark, "revenue_per_user")
    own = streams.stateful_session(spark)

    def start():
        events = streams.line_stream(own, f"{base}/in", fmt="parquet", schema="user_id long, value double")
        return streams.start_running_totals(events, "user_id", "value", f"{base}/out", f"{base}/checkpoint", trigger={"availableNow": True})

    _replay(spark, load(spark, sf_dir, "events").select("user_id", "value", _slice()), base, start, "parquet")
    state = streams.last_totals(spark, f"{base}/checkpoint")
    return state.select("user_id", "n_purchases", r6("revenue").alias("revenue"))


@register(
    "purchase_metrics_stream",
    sql="""
    SELECT CAST(count(*) AS BIGINT) AS n_purchases, round(sum(value), 6) AS revenue,
           count(*) FILTER (WHERE event_id % 50 = 0) AS n_rejected FROM events""",
)
def purchase_metrics_stream(spark, sf_dir):
    """ST02 ST04a ST04c ST09 S02 S08 S13: text lines parsed and measured batch by batch, malformed ones
    counted; added up over all batches, however many files the lines came in."""
    base = streams.scratch_dir(spark, "purchase_metrics")
    _replay(spark, purchase_lines(spark, sf_dir), base, _each_batch(spark, streams.metrics_sink(f"{base}/out"), base))
    m = spark.read.parquet(f"{base}/out/metrics")
    return m.agg(
        F.sum("n_purchases").alias("n_purchases"), r6(F.sum("revenue")).alias("revenue"), F.sum("n_rejected").alias("n_rejected")
    )


@register(
    "unique_users_stream",
    sql=f"""
    WITH b AS (SELECT CAST({_SLICE_SQL} AS BIGINT) AS batch_id, count(*) AS n_purchases, count(DISTINCT user_id) AS unique_users,
                      round(sum(value), 6) AS revenue FROM events GROUP BY 1)
    SELECT *, 1 AS sketch_within_5_percent, (SELECT count(DISTINCT user_id) FROM events) AS merged_within_5_percent_of FROM b""",
)
def unique_users_stream(spark, sf_dir):
    """ST04a-c: purchases, exact distinct users and revenue of each batch, whether the batch's sketch tells
    its distinct users within 5 % (six standard errors), and the distinct users of all batches if the
    merged sketches tell them within 5 %."""
    base = streams.scratch_dir(spark, "unique_users")
    _replay(spark, purchase_lines(spark, sf_dir), base, _each_batch(spark, streams.metrics_sink(f"{base}/out"), base))
    m = spark.read.parquet(f"{base}/out/metrics")
    own = F.hll_sketch_estimate("users_sketch")
    near = lambda guess, n: F.abs(guess - n) <= 0.05 * n
    merged = streams.merged_unique_users(m).scalar()
    exact = load(spark, sf_dir, "events").agg(F.countDistinct("user_id")).scalar()
    return m.select(
        F.col("batch_id").cast("long").alias("batch_id"), "n_purchases", "unique_users", r6("revenue").alias("revenue"),
        near(own, F.col("unique_users")).cast("int").alias("sketch_within_5_percent"),
        F.when(near(merged, exact), exact).alias("merged_within_5_percent_of"),
    )


@register(
    "popularity_stream",
    sql="SELECT event_type AS product, count(*) AS n FROM events GROUP BY event_type",
)
def popularity_stream(spark, sf_dir):
    """ST04d: purchases per product over all batches of the line stream."""
    base = streams.scratch_dir(spark, "popularity")
    _replay(spark, purchase_lines(spark, sf_dir), base, _each_batch(spark, streams.metrics_sink(f"{base}/out"), base))
    streams.compact(spark, f"{base}/out/popularity", f"{base}/compact", "product", ["n"])
    return spark.read.parquet(f"{base}/compact").select("product", F.col("n").cast("long").alias("n"))


@register(
    "user_totals_stream",
    sql="""
    SELECT CAST(user_id AS VARCHAR) AS "user", count(*) AS n_purchases, round(sum(value), 6) AS revenue FROM events
    GROUP BY user_id""",
)
def user_totals_stream(spark, sf_dir):
    """ST02 ST05: totals per user as state of one's own (a value state per user) over four batches of the line
    stream, read from the state store after the last."""
    base = streams.scratch_dir(spark, "user_totals")
    own = streams.stateful_session(spark, partitions=8)

    def start():
        events = streams.parse_purchases(streams.line_stream(own, f"{base}/in"))
        totals = streams.running_state(events, "user", "price").writeStream.outputMode("update")
        return totals.option("checkpointLocation", f"{base}/checkpoint").format("noop").trigger(availableNow=True).start()

    _replay(spark, purchase_lines(spark, sf_dir), base, start)
    state = streams.last_state(spark, f"{base}/checkpoint", "totals")
    return state.select("user", "n_purchases", r6("revenue").alias("revenue"))


def labelled_lines(events):
    """``label<TAB>features`` text lines built from events (value ~ hour, minute, k); for every 40th event a
    malformed line (without a tab) stands beside the good one."""
    k = F.get_json_object("props", "$.k")
    feats = F.concat_ws(",", F.hour("ts").cast("string"), F.minute("ts").cast("string"), F.coalesce(k, F.lit("0")))
    value = F.col("value").cast("string")
    spoiled = F.when(F.col("event_id") % 40 == 0, value)
    lines = F.array_compact(F.array(F.concat(value, F.lit("\t"), feats), spoiled))
    return events.select(F.explode(lines).alias("value"), _slice())


def _regression(spark, sf_dir):
    base = streams.scratch_dir(spark, "batch_regression")
    sink = streams.regression_sink(f"{base}/metrics", f"{base}/model", save_after=1000)
    _replay(spark, labelled_lines(load(spark, sf_dir, "events")), base, _each_batch(spark, sink, base))
    return spark.read.parquet(f"{base}/metrics")


@register("batch_regression")
def batch_regression(spark, sf_dir):
    """ST03 ST06-ST09 S12 S13: labelled lines from the stream, a regression on each batch, its samples,
    rejects, running total and in-sample RMSE; the model saved once the total reaches the threshold."""
    m = _regression(spark, sf_dir)
    return m.select("batch_id", "samples", "rejected", "total_samples", r6("rmse").alias("rmse"), "saved")


@register(
    "batch_regression_totals",
    sql=f"""
    WITH b AS (SELECT {_SLICE_SQL} AS slice, count(*) AS samples, count(*) FILTER (WHERE event_id % 40 = 0) AS rejected
               FROM events GROUP BY 1)
    SELECT CAST(slice AS BIGINT) AS batch_id, samples, rejected,
           CAST(sum(samples) OVER (ORDER BY slice) AS BIGINT) AS total_samples,
           sum(samples) OVER (ORDER BY slice) >= 1000 AS saved
    FROM b""",
)
def batch_regression_totals(spark, sf_dir):
    """ST03 ST07 ST08 ST09: samples and rejects of each batch, the running total, and whether the model was
    saved by then."""
    m = _regression(spark, sf_dir)
    return m.select(F.col("batch_id").cast("long").alias("batch_id"), "samples", "rejected", "total_samples", "saved")


_HOUR_VALUE = "(SELECT CAST(hour(ts) AS DOUBLE) AS x, value AS y, {slice} AS slice, event_id FROM events)".format(slice=_SLICE_SQL)
_LINE = """count(*) AS n, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept,
           sqrt(greatest(regr_syy(y, x) - regr_sxy(y, x) * regr_sxy(y, x) / regr_sxx(y, x), 0) / count(*)) AS rmse"""


def hour_lines(events):
    """``value<TAB>hour`` lines, and a malformed one beside every 40th."""
    value = F.col("value").cast("string")
    good = F.concat_ws("\t", value, F.hour("ts").cast("string"))
    lines = F.array_compact(F.array(good, F.when(F.col("event_id") % 40 == 0, value)))
    return events.select(F.explode(lines).alias("value"), _slice())


@register(
    "batch_moments_regression",
    sql=f"""
    WITH s AS {_HOUR_VALUE},
    own AS (SELECT slice, count(*) FILTER (WHERE event_id % 40 = 0) AS rejected, {_LINE} FROM s GROUP BY slice),
    total AS (SELECT b.slice, {_LINE} FROM (SELECT DISTINCT slice FROM s) b JOIN s ON s.slice <= b.slice GROUP BY b.slice)
    SELECT CAST(slice AS BIGINT) AS batch_id, own.n AS samples, rejected, round(own.slope, 4) AS slope,
           round(own.intercept, 4) AS intercept, round(own.rmse, 4) AS rmse, total.n AS total_samples,
           round(total.slope, 4) AS total_slope, round(total.intercept, 4) AS total_intercept, round(total.rmse, 4) AS total_rmse
    FROM own JOIN total USING (slice)""",
)
def batch_moments_regression(spark, sf_dir):
    """ST03 ST06 ST07 ST09: least squares on each batch and on all batches so far, from sums of products that
    are carried from batch to batch."""
    base = streams.scratch_dir(spark, "batch_moments")
    sink = streams.moments_sink(f"{base}/out")
    _replay(spark, hour_lines(load(spark, sf_dir, "events")), base, _each_batch(spark, sink, base))
    m = spark.read.parquet(f"{base}/out/fits")
    r4 = lambda c, name: F.round(c, 4).alias(name)
    return m.select(
        F.col("batch_id").cast("long").alias("batch_id"), "samples", "rejected", r4(F.col("coefficients")[0], "slope"),
        r4("intercept", "intercept"), r4("rmse", "rmse"), "total_samples", r4(F.col("total_coefficients")[0], "total_slope"),
        r4("total_intercept", "total_intercept"), r4("total_rmse", "total_rmse"),
    )


@register(
    "model_scores_stream",
    sql=f"""
    WITH s AS {_HOUR_VALUE}, f AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM s WHERE slice = 0)
    SELECT CAST(x AS INTEGER) AS hour, count(*) AS n, round(min(intercept + slope * x), 4) AS least,
           round(max(intercept + slope * x), 4) AS most
    FROM s, f GROUP BY x""",
)
def model_scores_stream(spark, sf_dir):
    """S12 ST08: the model that the stream saved at its first batch, read back and applied to a stream of all
    lines; scores per hour, which is the model's one feature."""
    base = streams.scratch_dir(spark, "model_scores")
    sink = streams.regression_sink(f"{base}/metrics", f"{base}/model", save_after=1, reg=0.0, elastic_net=0.0)
    _replay(spark, hour_lines(load(spark, sf_dir, "events")), base, _each_batch(spark, sink, base))
    scored = streams.scored_lines(streams.line_stream(spark, f"{base}/in"), f"{base}/model")
    written = scored.writeStream.option("checkpointLocation", f"{base}/scores-checkpoint").trigger(availableNow=True)
    written.format("parquet").start(f"{base}/scores").awaitTermination()
    rows = spark.read.schema("line string, label double, prediction double").parquet(f"{base}/scores")
    hour = F.split("line", "\t")[1].cast("int").alias("hour")
    return rows.groupBy(hour).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.min("prediction"), 4).alias("least"), F.round(F.max("prediction"), 4).alias("most")
    )
