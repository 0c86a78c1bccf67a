"""Runnable stream jobs (ST01-ST10): the source's purchase monitor and per-batch regression,
as Structured Streaming queries over any line source (socket, Kafka value, or new files)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tessera.streaming import streams


def purchase_monitor(lines: DataFrame, out_dir: str, checkpoint_dir: str, trigger: dict | None = None) -> StreamingQuery:
    """ST01/ST02/ST04/ST05/S13/S14: one query over ``user,product,price`` lines that writes each
    batch's metrics, popularity and totals per user below ``out_dir`` (see
    :func:`tessera.streaming.streams.metrics_sink`). Read the running totals with
    ``merged_counts(spark, out_dir + "/totals", "user", ["n_purchases", "revenue"])``."""
    return (
        lines.writeStream.option("checkpointLocation", checkpoint_dir)
        .foreachBatch(streams.metrics_sink(out_dir))
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def regression_monitor(
    lines: DataFrame, out_dir: str, checkpoint_dir: str, save_after: int = 100_000, trigger: dict | None = None
) -> StreamingQuery:
    """ST03/ST06-ST10/S12: fit a linear regression on each batch of ``label<TAB>x1,...`` lines, log
    ``(batch_id, samples, rejected, total_samples, rmse, saved)`` to ``out_dir/metrics`` and save the
    model to ``out_dir/model`` when the running sample count reaches ``save_after``."""
    sink = streams.regression_sink(f"{out_dir}/metrics", f"{out_dir}/model", save_after=save_after)
    return (
        lines.writeStream.option("checkpointLocation", checkpoint_dir)
        .foreachBatch(sink)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )
