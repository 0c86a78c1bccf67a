"""Streams: final state equals the batch aggregate, survives a restart, replays are idempotent."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.streaming import streams


def _write(folder, name, lines):
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def _run(spark, src, out, ck):
    events = streams.parse_purchases(streams.line_stream(spark, src, max_files_per_trigger=1))
    q = streams.start_running_totals(events, "user", "price", out, ck, trigger={"availableNow": True})
    q.awaitTermination()
    return {r.user: (r.n_purchases, r.revenue) for r in streams.last_totals(spark, ck).collect()}


def test_running_totals_with_restart(spark):
    base = tempfile.mkdtemp(prefix="tessera-stream-")
    src, out, ck = (os.path.join(base, d) for d in ("src", "out", "ck"))
    os.makedirs(src)
    _write(src, "b1.txt", ["u,p,5.5"])
    assert _run(spark, src, out, ck) == {"u": (1, 5.5)}
    _write(src, "b2.txt", ["u,q,2.25", "v,p,1"])
    state = _run(spark, src, out, ck)  # restarted from the checkpoint
    assert state == {"u": (2, 7.75), "v": (1, 1.0)}
    assert _run(spark, src, out, ck) == state  # nothing new: nothing changes


def test_parse_labelled_and_bad_rows(spark):
    lines = spark.createDataFrame([("1.5\t1,2,3",), ("x\t1,2",), ("2\t1,,3",), ("3\t4,5,6",)], "value string")
    good = streams.parse_labelled(lines).collect()
    assert [(r.label, list(r.features)) for r in good] == [(1.5, [1.0, 2.0, 3.0]), (3.0, [4.0, 5.0, 6.0])]
    assert streams.bad_labelled_rows(lines).count() == 2


def test_regression_sink_counts_once_and_saves_on_crossing(spark):
    base = tempfile.mkdtemp(prefix="tessera-reg-")
    sink = streams.regression_sink(f"{base}/m", f"{base}/model", save_after=6)
    lines = spark.createDataFrame([(f"{i}.0\t{i},{i % 3}",) for i in range(4)] + [("",), ("1.5",), ("x\t1",)], "value string")
    sink(lines, 0)
    sink(lines, 0)  # replay of batch 0
    sink(lines, 1)
    sink(lines.limit(0), 2)  # empty batch: skipped
    sink(lines.where("value = ''"), 3)  # nothing but rejects
    m = spark.read.parquet(f"{base}/m").orderBy("batch_id").collect()
    assert [(r.batch_id, r.samples, r.rejected, r.total_samples, r.saved) for r in m] == [
        (0, 4, 3, 4, False), (1, 4, 3, 8, True), (3, 0, 1, 8, True),
    ]
    assert os.path.isdir(f"{base}/model")


def test_regression_sink_raises_on_a_broken_metrics_table(spark):
    base = tempfile.mkdtemp(prefix="tessera-reg-")
    os.makedirs(f"{base}/m/batch=0")
    _write(f"{base}/m/batch=0", "part-0.parquet", ["not parquet"])
    lines = spark.createDataFrame([("1\t2",), ("2\t3",)], "value string")
    with pytest.raises(Exception, match="(?i)parquet"):
        streams.regression_sink(f"{base}/m", f"{base}/model")(lines, 1)


def test_malformed_purchase_lines_are_rejected_not_fatal(spark):
    lines = spark.createDataFrame([("u,p,1.5",), ("u,p",), ("",), (",,",), ("u,p,x",), (" v , q , 2 ",)], "value string")
    good = streams.parse_purchases(lines).collect()
    assert [(r.user, r["product"], r.price) for r in good] == [("u", "p", 1.5), ("v", "q", 2.0)]
    assert streams.bad_purchases(lines).count() == 4
    blank = spark.createDataFrame([("",), ("1.5",), ("\t",), ("1\t2,",)], "value string")
    assert streams.parse_labelled(blank).count() == 0 and streams.bad_labelled_rows(blank).count() == 4


def test_one_monitor_query_writes_all_metrics(spark):
    from tessera.streaming.jobs import purchase_monitor

    base = tempfile.mkdtemp(prefix="tessera-monitor-")
    os.makedirs(f"{base}/src")
    _write(f"{base}/src", "a.txt", ["u,p,1", "v,p,2", "bad"])
    _write(f"{base}/src", "b.txt", ["u,q,3", "", "u,p,4"])
    lines = streams.line_stream(spark, f"{base}/src", max_files_per_trigger=1)
    purchase_monitor(lines, f"{base}/out", f"{base}/ck", trigger={"availableNow": True}).awaitTermination()
    m = spark.read.parquet(f"{base}/out/metrics")
    assert sorted((r.n_purchases, r.revenue, r.n_rejected) for r in m.collect()) == [(2, 3.0, 1), (2, 7.0, 1)]
    n = streams.merged_counts(spark, f"{base}/out/popularity", "product", ["n"])
    assert {r["product"]: r.n for r in n.collect()} == {"p": 3, "q": 1}
    t = streams.merged_counts(spark, f"{base}/out/totals", "user", ["n_purchases", "revenue"])
    assert {r.user: (r.n_purchases, r.revenue) for r in t.collect()} == {"u": (3, 8.0), "v": (1, 2.0)}


def test_purchase_metrics(spark):
    b = spark.createDataFrame([("u", "p", 5.5), ("u", "q", 2.25), ("v", "p", 1.0)], "user string, product string, price double")
    m = streams.purchase_metrics(b).first()
    assert (m.n_purchases, m.unique_users, m.revenue) == (3, 2, 8.75)
    assert streams.purchase_metrics(b, truncate=True).first().revenue == 8
    assert [(r["product"], r.n) for r in streams.products_by_popularity(b).collect()] == [("p", 2), ("q", 1)]


def _bytes_read(spark):
    return sum(x.getBytesRead() for x in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics() if x.getScheme() == "file")


def _state_after(spark, batches):
    """State of the built-in aggregate after so many batches over the same ten users, and bytes read for it."""
    base = tempfile.mkdtemp(prefix="tessera-state-")
    src, out, ck = (os.path.join(base, d) for d in ("src", "out", "ck"))
    os.makedirs(src)
    own = streams.stateful_session(spark)
    own.conf.set("spark.sql.shuffle.partitions", "2")
    for b in range(batches):
        _write(src, f"b{b}.txt", [f"u{i},p,{b}" for i in range(10)])
    events = streams.parse_purchases(streams.line_stream(own, src, max_files_per_trigger=1))
    streams.start_running_totals(events, "user", "price", out, ck, trigger={"availableNow": True}).awaitTermination()
    # what the state source opens: the last version's files, not those of every batch's output
    before = _bytes_read(spark)
    rows = {r.user: (r.n_purchases, r.revenue) for r in streams.last_totals(spark, ck).collect()}
    assert rows == {f"u{i}": (batches, float(sum(range(batches)))) for i in range(10)}
    return _bytes_read(spark) - before


def test_reading_state_does_not_grow_with_the_batches(spark):
    _state_after(spark, 1)
    few, many = _state_after(spark, 3), _state_after(spark, 12)
    assert many <= 2 * few + 20_000


def test_state_of_ones_own_with_restart_and_idle_timer(spark):
    base = tempfile.mkdtemp(prefix="tessera-own-")
    src, ck, out = (os.path.join(base, d) for d in ("src", "ck", "out"))
    os.makedirs(src)
    own = streams.stateful_session(spark)
    own.conf.set("spark.sql.shuffle.partitions", "2")

    def run(name, lines):
        _write(src, name, lines)
        parts = F.split("value", ",")
        events = streams.line_stream(own, src).select(
            parts[0].alias("user"), parts[1].cast("double").alias("price"), F.timestamp_seconds(parts[2].cast("long")).alias("at")
        )
        rows = streams.running_state(events.withWatermark("at", "0 seconds"), "user", "price", "at", 60_000)
        q = rows.writeStream.outputMode("update").option("checkpointLocation", ck).foreachBatch(
            lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch={i}")
        ).trigger(availableNow=True).start()
        q.awaitTermination()
        state = streams.last_state(spark, ck, "totals")
        return {r.user: (r.n_purchases, r.revenue) for r in state.collect()}

    assert run("a", ["u,1.5,1000", "v,2,1010", "u,1,1020"]) == {"u": (2, 2.5), "v": (1, 2.0)}
    state = run("b", ["u,4,1050"])  # v's timer stands at 1070
    assert state == {"u": (3, 6.5), "v": (1, 2.0)}
    assert run("c", ["u,1,1100"]) == {"u": (4, 7.5)}  # v fell silent
    closed = spark.read.parquet(out).where("closed").collect()
    assert [(r.user, r.n_purchases, r.revenue) for r in closed] == [("v", 1, 2.0)]
    assert run("d", ["v,5,1110"]) == {"u": (4, 7.5), "v": (1, 5.0)}  # and begins anew


def test_state_of_ones_own_needs_time_for_its_timer(spark):
    events = spark.createDataFrame([("u", 1.0)], "user string, price double")
    with pytest.raises(ValueError, match="go together"):
        streams.running_state(events, "user", "price", idle_ms=5)


def test_sketches_of_batches_merge(spark):
    users = [range(0, 3000), range(1000, 5000), range(4000, 4500)]
    rows = [spark.createDataFrame([(f"u{i}",) for i in u], "user string") for u in users]
    tables = [streams.users_sketch(r) for r in rows]
    for u, t in zip(users, tables, strict=True):
        guess = streams.merged_unique_users(t).first()[0]
        assert abs(guess - len(u)) <= 0.03 * len(u)
    both = streams.merged_unique_users(tables[0].unionByName(tables[1]).unionByName(tables[2])).first()[0]
    assert abs(both - 5000) <= 150
    again = streams.merged_unique_users(tables[0].unionByName(tables[0])).first()[0]  # a user of two batches counts once
    assert abs(again - 3000) <= 90


def test_moments_sink_replays_and_carries_sums(spark):
    base = tempfile.mkdtemp(prefix="tessera-moments-")
    sink = streams.moments_sink(base)
    lines = lambda rows: spark.createDataFrame([(x,) for x in rows], "value string")
    first, second = lines(["1\t1,0", "3\t2,1", "2\t3,0", "bad", "9\t4,4"]), lines(["1\t1,5", "7\t2,0"])
    sink(first, 0)
    sink(second, 1)
    sink(second, 1)  # replayed
    sink(lines([""]), 2)  # nothing but rejects: the sums go on
    rows = {r.batch_id: r for r in spark.read.parquet(f"{base}/fits").collect()}
    assert [(rows[b].samples, rows[b].rejected, rows[b].total_samples) for b in range(3)] == [(4, 1, 4), (2, 0, 6), (0, 1, 6)]
    x = np.array([[1, 0], [2, 1], [3, 0], [4, 4], [1, 5], [2, 0]], float)
    y = np.array([1, 3, 2, 9, 1, 7], float)
    beta, *_ = np.linalg.lstsq(np.column_stack([np.ones(6), x]), y, rcond=None)
    rmse = np.sqrt(np.mean((y - beta[0] - x @ beta[1:]) ** 2))
    for r in (rows[1], rows[2]):
        assert [r.total_intercept, *r.total_coefficients, r.total_rmse] == pytest.approx([*beta, rmse])
    assert rows[2].rmse is None and rows[2].intercept is None
