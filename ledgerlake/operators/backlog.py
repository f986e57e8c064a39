"""Ingest bookkeeping: spines, completion ledgers, work backlogs.

The request side of ingestion is data: which keys are still missing, with the
JSON-RPC request text that would fetch them. The fetcher itself is not built;
files it lands are read by `sources.raw`.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hexnum import bucket1000, hex_to_bigint, int_to_hex
from ..functions.keys import lit_ts, batch_no, json_array, json_str, row_in_batch, rpc_payload
from .latest import latest_per_key, sort_columns
from .numbering import global_position
from .sinks import upsert

# Fixed values of the reference configuration (sizing constants).
BLOCKS_PER_HOUR = 1000
HEAD_DELAY_MINUTES = 3
LOOKBACK_HOURS = 72
BATCH_SIZE = 100


def number_spine(spark: SparkSession, n: int) -> DataFrame:
    """0 .. n-1 as `_id`, lazily generated (never stored)."""
    return spark.range(n).withColumnRenamed("id", "_id")


def head_delay(blocks_per_hour: int = BLOCKS_PER_HOUR, delay_minutes: int = HEAD_DELAY_MINUTES) -> int:
    return int(blocks_per_hour / 60 * delay_minutes)


def block_spine(spark: SparkSession, head: int, start_block: int = 0,
                blocks_per_hour: int = BLOCKS_PER_HOUR, delay_minutes: int = HEAD_DELAY_MINUTES) -> DataFrame:
    """Blocks from `start_block` up to `head - delay`, with their hex form."""
    delay = head_delay(blocks_per_hour, delay_minutes)
    ids = spark.range(max(start_block + delay, 0), head + 1)
    return ids.select((F.col("id") - F.lit(delay)).alias("block_number")).select(
        "block_number", int_to_hex("block_number").alias("block_number_hex"))


def chain_head(responses: DataFrame, col: str = "result") -> int:
    """Head block number from a one-row eth_blockNumber response table."""
    r = responses.select(hex_to_bigint(col).alias("h")).agg(F.max("h").alias("h")).first()
    return int(r["h"] or 0)


def lookback_frame(blocks: DataFrame, now: dt.datetime, hours: int = LOOKBACK_HOURS,
                   ts: str = "block_timestamp", col: str = "block_number") -> DataFrame:
    """One row: the smallest block in the hour [trunc_hour(now) - hours, +1h), 0 when none (F8)."""
    top = now.replace(minute=0, second=0, microsecond=0)
    lo, hi = top - dt.timedelta(hours=hours), top - dt.timedelta(hours=hours - 1)
    return (blocks.where((F.col(ts) >= lit_ts(lo)) & (F.col(ts) < lit_ts(hi)))
            .agg(F.coalesce(F.min(col), F.lit(0)).cast("bigint").alias("block_number")))


def lookback_block(blocks: DataFrame, now: dt.datetime, **how) -> int:
    """The same as a number, to bound the backlogs with."""
    return int(lookback_frame(blocks, now, **how).first()[0])


def split_backlog(df: DataFrame, boundary: int, col: str = "block_number") -> tuple[DataFrame, DataFrame]:
    """(realtime: at or after the boundary, history: before it)."""
    return df.where(F.col(col) >= boundary), df.where(F.col(col) < boundary)


def update_ledger(ledger: DataFrame | None, raw: DataFrame, keys: list[str],
                  order=("block_number desc", "_inserted_timestamp desc"),
                  cols=("file_name", "_inserted_timestamp")) -> DataFrame:
    """Completion ledger: latest delivery per key, merged into the ledger (T4)."""
    extra = [c for c in cols if c not in keys]
    batch = latest_per_key(raw.select(*keys, *extra), keys, [o for o in order if o.split()[0] in keys + extra])
    return upsert(ledger, batch, keys, "merge")


def missing_keys(spine: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the spine not yet in the ledger: EXCEPT (distinct, NULL-safe)."""
    return spine.select(*keys).subtract(ledger.select(*keys))


def newest(df: DataFrame, order, n: int | None) -> DataFrame:
    """ORDER BY ... LIMIT n, planned as a distributed top-k (L1, L2), or any n rows without an `order` (L3); None takes all."""
    if n is None:
        return df
    return (df.orderBy(*sort_columns(order)) if order else df).limit(n)


def top_n(df: DataFrame, measure: str, n: int | None, tiebreak: list[str]) -> DataFrame:
    """n rows with the largest measure, ties broken by `tiebreak` (L4)."""
    return newest(df, [f"{measure} desc nulls last"] + [f"{t} asc" for t in tiebreak], n)


def work_backlog(spine: DataFrame, ledger: DataFrame, method: str, keys=("block_number",),
                 since_block: int | None = None, before_block: int | None = None, *, cap: int | None,
                 params=None) -> DataFrame:
    """Missing keys with their JSON-RPC request (T6): the `cap` newest, or all (None).
    `since_block` bounds the realtime form, `before_block` the history form (T7)."""
    keys = list(keys)
    if since_block is not None:
        spine, ledger = (d.where(F.col("block_number") >= since_block) for d in (spine, ledger))
    if before_block is not None:
        spine, ledger = (d.where(F.col("block_number") < before_block) for d in (spine, ledger))
    todo = missing_keys(spine, ledger, keys)
    params = params or (lambda: json_array(json_str(int_to_hex("block_number")), F.lit("true")))
    out = todo.select(*keys, bucket1000("block_number").cast("bigint").alias("partition_key"),
                      rpc_payload(method, params(), F.col("block_number")).alias("request"))
    return newest(out, ["partition_key desc", *[f"{k} desc" for k in keys]], cap)


def pack_batches(df: DataFrame, order, value: str, size: int = BATCH_SIZE) -> DataFrame:
    """Number rows, group per `size`, collect values in order (T9). Numbering is a range sort
    over all tasks (global_position); a group has `size` rows."""
    numbered = global_position(df, order, "row_num")
    grouped = (numbered.withColumn("batch_number", batch_no("row_num", size))
               .groupBy("batch_number")
               .agg(F.array_sort(F.collect_list(F.struct("row_num", F.col(value).alias("v")))).alias("_b")))
    return grouped.select("batch_number", F.transform("_b", lambda s: s["v"]).alias("batch_request"),
                          F.array_size("_b").alias("n_requests"))


def with_batch_columns(df: DataFrame, row_col: str, size: int = BATCH_SIZE) -> DataFrame:
    return df.withColumn("batch_number", batch_no(row_col, size)).withColumn(
        "row_within_batch", row_in_batch(row_col, size))
