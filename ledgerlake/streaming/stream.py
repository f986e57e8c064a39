"""Structured Streaming forms of the incremental operators.

The reference emulates a stream with scheduled micro-batches over a high-water
mark. Here the same work runs as a file-source stream whose checkpoint is the
mark: `trigger(availableNow=True)` processes everything new and stops, which is
the scheduled-run shape; a processing-time trigger makes it continuous.
Sinks are keyed upserts inside `foreachBatch`, idempotent under replays.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stored import read_table, upsert_table
from ..session import ensure_checkpoint_dir, stored_once


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    """File-source stream: new files since the checkpoint are the increment."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def dedupe_stream(df: DataFrame, keys: list[str], ts: str, delay: str = "24 hours") -> DataFrame:
    """Late-data allowance (T2): duplicates within the watermark delay are dropped."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


BUCKETS = 64


def _bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _run(stream: DataFrame, mode: str, apply, checkpoint: str, available_now: bool) -> None:
    w = stream.writeStream.outputMode(mode).foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    w.start().awaitTermination()


def upsert_stream(stream: DataFrame, table_path: str, keys: list[str], order, checkpoint: str,
                  available_now: bool = True, buckets: int = BUCKETS) -> DataFrame | None:
    """Keep `table_path` as the latest row per key of everything the stream delivered (T4).

    The table is the only state beside the stream's checkpoint: a restart goes on from
    both. A micro-batch is reduced to one row per key, competes with the stored rows of its
    keys and rewrites only their hash buckets; a replayed batch changes nothing. Returns
    the table, or None while nothing has ever arrived.
    """
    spark = stream.sparkSession

    def apply(batch: DataFrame, batch_id: int):
        with stored_once(batch, "stream") as came:  # a batch that is read again runs the stream's work again
            if not came.isEmpty():
                upsert_table(spark, table_path, _bucketed(came, keys, buckets), keys, "bucket", order=order, competing=True)
    _run(stream, "append", apply, checkpoint, available_now)
    return _table(spark, table_path)


def counters_stream(stream: DataFrame, key: str, value_cols: dict[str, object], checkpoint: str, table_path: str,
                    available_now: bool = True, buckets: int = BUCKETS) -> DataFrame | None:
    """Running counters per key (T5): a streaming aggregate whose state lives in the checkpoint;
    each trigger upserts the changed keys' totals only. Returns as upsert_stream does."""
    spark = stream.sparkSession
    agg = stream.groupBy(key).agg(*[expr.alias(name) for name, expr in value_cols.items()])

    def apply(batch: DataFrame, batch_id: int):
        with stored_once(batch, "stream") as came:  # a batch that is read again runs the stream's work again
            if not came.isEmpty():
                upsert_table(spark, table_path, _bucketed(came, [key], buckets), key, "bucket")
    _run(agg, "update", apply, checkpoint, available_now)
    return _table(spark, table_path)


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    table = read_table(spark, path)
    return None if table is None else table.drop("bucket")
