"""Structured Streaming operators (ST01-ST10, S08, S12-S14).

The source's DStream job becomes: a ``readStream`` source with one ``lines`` column (S08),
parsers as column expressions (ST02, ST03), per-batch metrics and per-batch model fits in
``foreachBatch`` (ST04, ST06-ST09), and running totals kept in the state store (ST05), by a built-in
aggregate or by a processor of one's own with timers, and read back through the state source.

Sinks are keyed by ``batch_id`` (one folder per batch, overwritten on replay), so a batch
replayed after a failure does not count twice (``foreachBatch`` is at-least-once).
"""

from __future__ import annotations

import uuid

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tessera.functions.numeric import number
from tessera.operators.moments import SCHEMA as MOMENTS
from tessera.operators.moments import added, fit, moments
from tessera.session import ensure_checkpoint_dir


def exact_file_glob(path: str) -> str:
    """A glob matching exactly one file (the file source wants a folder or a glob)."""
    return path[:-1] + "[" + path[-1] + "]"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, for stream state and sinks."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"


def line_stream(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "text",
    schema=None,
    max_files_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    """A stream of lines: new files under ``path`` (text files give one ``value`` per
    line), or any other source through ``fmt`` and its ``options``, e.g.
    ``line_stream(spark, fmt="socket", host=h, port=p)`` or Kafka (then select
    ``CAST(value AS STRING) AS value``). The operators below only need the ``value`` column.
    """
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path) if path is not None else reader.load()


def parse_purchases(lines: DataFrame, col: str = "value") -> DataFrame:
    """ST02: ``user,product,price`` lines -> typed columns. Lines without three fields, or whose price
    is no number, are dropped; :func:`bad_purchases` has them."""
    return _purchase_fields(lines, col).where(_WHOLE).select("user", "product", "price")


_WHOLE = "product is not null and price is not null"


def _purchase_fields(lines: DataFrame, col: str) -> DataFrame:
    parts = F.split(F.col(col), ",", -1)
    field = lambda i: F.trim(F.get(parts, F.lit(i)))
    return lines.select(
        F.col(col).alias("line"), field(0).alias("user"), field(1).alias("product"), number(field(2)).alias("price")
    )


def bad_purchases(lines: DataFrame, col: str = "value") -> DataFrame:
    """ST09: the lines that :func:`parse_purchases` drops, as ``line``."""
    return _purchase_fields(lines, col).where(f"not ({_WHOLE})").select("line")


def parse_labelled(lines: DataFrame, col: str = "value") -> DataFrame:
    """ST03: ``label<TAB>x1,x2,...`` lines -> ``(label, features vector)``; rows whose label or
    any feature does not parse are dropped (count them with ``bad_labelled_rows``)."""
    return _labelled_fields(lines, col).where(_COMPLETE).select("label", array_to_vector("xs").alias("features"))


_COMPLETE = "label is not null and coalesce(forall(xs, x -> x is not null), false)"


def _labelled_fields(lines: DataFrame, col: str) -> DataFrame:
    parts = F.split(F.col(col), "\t", 2)
    xs = F.transform(F.split(F.get(parts, F.lit(1)), ",", -1), lambda x: number(F.trim(x)))
    return lines.select(F.col(col).alias("line"), number(F.trim(F.get(parts, F.lit(0)))).alias("label"), xs.alias("xs"))


def bad_labelled_rows(lines: DataFrame, col: str = "value") -> DataFrame:
    """ST09: the lines that :func:`parse_labelled` drops, as ``line``."""
    return _labelled_fields(lines, col).where(f"not ({_COMPLETE})").select("line")


# ---- per-batch metrics (ST04) ---------------------------------------------------------------


def purchase_metrics(batch: DataFrame, user: str = "user", price: str = "price", truncate: bool = False) -> DataFrame:
    """ST04a-c: purchases, distinct users and revenue of one batch (one row).

    ``truncate=True`` sums whole units as the source did (D17)."""
    p = F.col(price).cast("long") if truncate else F.col(price)
    return batch.agg(
        F.count(F.lit(1)).alias("n_purchases"),
        F.countDistinct(user).alias("unique_users"),
        F.sum(p).alias("revenue"),
    )


#: log2 of a sketch's buckets: a standard error of about 0.8 % in 16 KB.
SKETCH_BITS = 14


def users_sketch(batch: DataFrame, user: str = "user", bits: int = SKETCH_BITS) -> DataFrame:
    """ST04b across batches: one row with ``users_sketch``, a mergeable sketch of the distinct users."""
    return batch.agg(F.hll_sketch_agg(user, F.lit(bits)).alias("users_sketch"))


def merged_unique_users(metrics: DataFrame, keys=(), name: str = "approx_unique_users") -> DataFrame:
    """ST04b: distinct users over several batches, from the sketches in the batch table (a user seen in two
    batches counts once); per ``keys`` if there are any."""
    return metrics.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("users_sketch")).alias(name))


def products_by_popularity(batch: DataFrame, product: str = "product") -> DataFrame:
    """ST04d/O04: purchases per product, most popular first (ties by product)."""
    return batch.groupBy(product).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), product)


def metrics_sink(out_dir: str, col: str = "value"):
    """``foreachBatch`` writer over ``user,product,price`` lines: the batch's metrics (ST04a-c, with
    its rejected lines and a sketch of its users) below ``metrics``, purchases per product (ST04d) below
    ``popularity`` and each user's share of the batch below ``totals``; a folder per batch id,
    overwritten on replay. One stream, one source: the tables agree batch by batch and add up
    (:func:`merged_counts`, :func:`merged_unique_users`). They are no state: see :func:`running_state`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            if held.isEmpty():  # ST09
                return
            good = parse_purchases(held, col).persist()
            bad = bad_purchases(held, col).agg(F.count(F.lit(1)).alias("n_rejected")).scalar()
            tables = {
                "metrics": purchase_metrics(good).crossJoin(users_sketch(good)).withColumn("n_rejected", bad),  # one row each
                "popularity": good.groupBy("product").agg(F.count(F.lit(1)).alias("n")),
                "totals": running_totals(good, "user", "price"),
            }
            for name, table in tables.items():
                table.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out_dir}/{name}/batch={batch_id}")
            good.unpersist()
        finally:
            held.unpersist()

    return write


def merged_counts(spark: SparkSession, path: str, key: str, sums: list[str]) -> DataFrame:
    """Per-batch tables added up by key: each batch wrote only its own counts."""
    return spark.read.parquet(path).groupBy(key).agg(*[F.sum(c).alias(c) for c in sums])


def compact(spark: SparkSession, path: str, into: str, key: str, sums: list[str]) -> None:
    """Writes the sums over all batches so far as one table, for readers that should not scan every
    batch's folder."""
    merged_counts(spark, path, key, sums).write.mode("overwrite").parquet(into)


# ---- running state per key (ST05) -------------------------------------------------------------


def running_totals(events: DataFrame, key: str, price: str) -> DataFrame:
    """ST05/A17: purchases and revenue per key since the stream started (stateful aggregate)."""
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("n_purchases"), F.sum(price).alias("revenue"))


def batch_upsert_sink(out_dir: str):
    """``foreachBatch`` writer for ``update`` mode: changed keys of each batch, by batch id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    return write


def start_running_totals(
    events: DataFrame, key: str, price: str, out_dir: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """ST01/ST05/ST10/S14: start the stateful aggregate in ``update`` mode (only changed keys
    are written each batch; state lives in the state store under ``checkpoint``)."""
    agg = running_totals(events, key, price)
    writer = agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(batch_upsert_sink(out_dir))
    writer = writer.trigger(**(trigger or {"processingTime": "10 seconds"}))
    return writer.start()


def last_state(spark: SparkSession, checkpoint: str, state: str | None = None) -> DataFrame:
    """ST05: every key and its state after the last batch, read from the state store below
    ``checkpoint`` by the state data source: ``key.*`` and ``value.*`` as columns. ``state``: the state
    variable's name, for :func:`running_state`. What is read is the last version of the state,
    whatever the number of batches before it."""
    reader = spark.read.format("statestore")
    if state is not None:
        reader = reader.option("stateVarName", state)
    return reader.load(checkpoint).select("key.*", "value.*")


def last_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The running totals of :func:`start_running_totals` after the last batch: the key,
    ``n_purchases`` and ``revenue``."""
    rows = last_state(spark, checkpoint)
    key, n, revenue = rows.columns  # the aggregate's buffers, in its order
    return rows.select(key, F.col(n).alias("n_purchases"), F.col(revenue).alias("revenue"))


def stateful_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session beside the caller's, on the same cluster, whose streams keep state in RocksDB (off the
    heap, checkpointed as changelogs), which :func:`running_state` needs. ``partitions``: of the state,
    for the life of a stream (the caller's shuffle partitions otherwise). The caller's own settings stay
    as they are."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    if partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(partitions))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS_DB)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return own


_ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TOTALS = "n_purchases long, revenue double, last_ms long"


class RunningTotals(StatefulProcessor):
    """ST05: a key's purchases and revenue in a value state. With ``idle_ms`` a timer is set that much after
    the key's last event time; when it goes off without a later event, the totals are given out as
    ``closed`` and the state is dropped, so that state does not grow with all keys ever seen."""

    def __init__(self, key: str, price: str, time: str | None, idle_ms: int | None):
        self.key, self.price, self.time, self.idle_ms = key, price, time, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", TOTALS)

    def _row(self, key, n, revenue, closed):
        import pandas as pd

        return pd.DataFrame({self.key: [key[0]], "n_purchases": [n], "revenue": [revenue], "closed": [closed]})

    def handleInputRows(self, key, rows, timerValues):
        n, revenue, last = self.totals.get() if self.totals.exists() else (0, 0.0, None)
        for some in rows:
            n += len(some)
            revenue += float(some[self.price].sum())
            if self.time is not None:
                newest = int(some[self.time].max().timestamp() * 1000)
                last = newest if last is None else max(last, newest)
        if self.idle_ms is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(last + self.idle_ms)
        self.totals.update((n, revenue, last))
        yield self._row(key, n, revenue, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.totals.exists():
            n, revenue, _ = self.totals.get()
            self.totals.clear()
            yield self._row(key, n, revenue, True)

    def close(self) -> None:
        pass


def running_state(events: DataFrame, key: str, price: str, time: str | None = None, idle_ms: int | None = None) -> DataFrame:
    """ST05/A17 with state of one's own: ``(key, n_purchases, revenue, closed)``, a row for each key that a batch
    touched and, with ``idle_ms`` (``time`` then is the watermarked event-time column), one for each key
    that fell silent. Run it in a :func:`stateful_session`; read the state of all keys with
    ``last_state(spark, checkpoint, "totals")``.
    """
    if (time is None) != (idle_ms is None):
        raise ValueError("time and idle_ms go together")
    kind = events.schema[key].dataType.simpleString()
    return events.groupBy(key).transformWithStateInPandas(
        RunningTotals(key, price, time, idle_ms), outputStructType=f"{key} {kind}, n_purchases long, revenue double, closed boolean",
        outputMode="update", timeMode="none" if idle_ms is None else "eventTime",
    )


# ---- per-batch model fits (ST06-ST08, S12, S13) -----------------------------------------------


def regression_sink(
    metrics_dir: str, model_dir: str, save_after: int = 100_000, max_iter: int = 10, reg: float = 0.3, elastic_net: float = 0.8,
    col: str = "value", partitions: int | None = None,
):
    """``foreachBatch`` writer over ``label<TAB>x1,...`` lines: fit a linear regression on each batch,
    write ``(batch_id, samples, rejected, total_samples, rmse, saved)`` for it, and save the model once
    the running sample count first reaches ``save_after`` (threshold crossing, D18).

    The running count stands in the row of the last batch before this one, so it survives a restart,
    a replayed batch overwrites its own row, and no batch reads more than one earlier row (ST07).
    ``partitions``: deal the batch over so many partitions, by a hash of its lines.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = batch.repartition(partitions, col) if partitions else batch
        held = lines.persist()
        try:
            if held.isEmpty():  # ST09
                return
            spark = batch.sparkSession
            good, rejected = parse_labelled(held, col), bad_labelled_rows(held, col).count()
            samples = good.count()
            before, saved = _last_total(spark, metrics_dir, batch_id)
            total, rmse = before + samples, None
            save_now = total >= save_after and not saved
            if samples:
                model = LinearRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net).fit(good)
                rmse = float(RegressionEvaluator(metricName="rmse").evaluate(model.transform(good)))
                if save_now:  # S12/ST08
                    model.write().overwrite().save(model_dir)
            row = [(batch_id, samples, rejected, total, rmse, saved or bool(save_now and samples))]
            kinds = "batch_id long, samples long, rejected long, total_samples long, rmse double, saved boolean"
            spark.createDataFrame(row, kinds).write.mode("overwrite").parquet(f"{metrics_dir}/batch={batch_id}")
        finally:
            held.unpersist()

    return write


def _last_total(spark: SparkSession, metrics_dir: str, batch_id: int) -> tuple[int, bool]:
    """Running count and saved flag of the last batch before this one; (0, False) before any."""
    try:
        rows = spark.read.parquet(metrics_dir)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no batch yet
            return 0, False
        raise
    last = rows.where(F.col("batch") < batch_id).orderBy(F.desc("batch")).select("total_samples", "saved").head()
    return (int(last["total_samples"]), bool(last["saved"])) if last else (0, False)


def moments_sink(out_dir: str, reg: float = 0.0, elastic_net: float = 0.0, col: str = "value"):
    """ST06/ST07 without a pass per iteration: ``foreachBatch`` writer over ``label<TAB>x1,...`` lines. Each batch
    is one aggregate, its moments (:mod:`tessera.operators.moments`); the sums of all batches so far are the
    last batch's sums plus these. Writes, by batch id, ``sums`` (the sums so far) and ``fits``: samples,
    rejected, coefficients, intercept and in-sample RMSE of the batch, and the same of all so far.

    A replayed batch writes the same rows again; a batch reads one earlier batch's sums, by its path.
    """
    kinds = (
        "batch_id long, samples long, rejected long, coefficients array<double>, intercept double, rmse double, "
        "total_samples long, total_coefficients array<double>, total_intercept double, total_rmse double"
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = batch.persist()
        try:
            good = _labelled_fields(held, col).where(_COMPLETE)
            rejected = bad_labelled_rows(held, col).count()
            own = moments(good, "xs", "label").persist()
            total = added(own, _sums_before(spark, out_dir, batch_id))
            total.write.mode("overwrite").parquet(f"{out_dir}/sums/batch={batch_id}")
            now, so_far = fit(own, reg, elastic_net), fit(spark.read.schema(MOMENTS).parquet(f"{out_dir}/sums/batch={batch_id}"), reg, elastic_net)
            own.unpersist()
            row = (batch_id, now.samples, rejected, *now[1:], *so_far)
            spark.createDataFrame([row], kinds).write.mode("overwrite").parquet(f"{out_dir}/fits/batch={batch_id}")
        finally:
            held.unpersist()

    return write


def _sums_before(spark: SparkSession, out_dir: str, batch_id: int) -> DataFrame:
    """The sums that the batch before this one wrote; none before the first."""
    none = spark.createDataFrame([], MOMENTS)
    if batch_id == 0:
        return none
    try:
        return spark.read.schema(MOMENTS).parquet(f"{out_dir}/sums/batch={batch_id - 1}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":  # the sink is new to a stream that has run before
            return none
        raise


def scored_lines(lines: DataFrame, model_dir: str, col: str = "value") -> DataFrame:
    """S12/ST08 read back: the saved model applied to a stream (or table) of ``label<TAB>x1,...`` lines:
    ``(line, label, prediction)``; lines that do not parse are left out."""
    parsed = _labelled_fields(lines, col).where(_COMPLETE).select("line", "label", array_to_vector("xs").alias("features"))
    return LinearRegressionModel.load(model_dir).transform(parsed).select("line", "label", "prediction")
