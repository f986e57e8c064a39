"""Silver models (M1-M4): latest raw document per key, call trees flattened.

Inputs are bronze frames from `sources.raw.bronze` (VARIANT value/data/metadata,
block_number resolved, failures dropped). Each model returns the *batch* to
upsert by its key; `target` (the current table) supplies the high-water mark.
"""
from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import jget, jnode
from ..functions.jsontext import members
from ..functions.keys import lit_ts, surrogate_key
from ..operators.explode import computed_once
from ..operators.incremental import high_water, since
from ..operators.latest import latest_per_key
from ..operators.tree import flatten_tree

FLOOR = dt.datetime(1900, 1, 1)


def with_audit(df: DataFrame, run_ts: dt.datetime, run_id: str | None = None) -> DataFrame:
    """Row lineage stamps: one literal run time per run (replayable), run id."""
    out = (df.withColumn("inserted_timestamp", lit_ts(run_ts))
           .withColumn("modified_timestamp", lit_ts(run_ts)))
    if run_id is not None:
        out = out.withColumn("_invocation_id", F.lit(run_id))
    return out


@F.pandas_udf(T.StringType())
def _result_of(text: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else (members(t) or {}).get("result") for t in text], dtype=object)


def _new_since(bronze: DataFrame, target: DataFrame | None) -> DataFrame:
    if target is None:
        return bronze
    return since(bronze, "_inserted_timestamp", high_water(target, "_inserted_timestamp", FLOOR))


def _latest(src: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Latest delivery per key; deliveries of one time are told apart by the hash of their line."""
    return latest_per_key(src, keys, order, tiebreak=["line_hash"] if "line_hash" in src.columns else "all").drop("line_hash")


def _line(bronze: DataFrame) -> list[str]:
    return [c for c in ("line_hash",) if c in bronze.columns]


def silver_blocks(bronze: DataFrame, run_ts: dt.datetime, target: DataFrame | None = None,
                  run_id: str | None = None) -> DataFrame:
    """M1: latest block document per block_number."""
    src = _new_since(bronze, target).where(F.col("data").isNotNull())
    src = src.select("block_number", "partition_key", F.col("data").alias("block_json"), "_inserted_timestamp", *_line(bronze))
    out = _latest(src, ["block_number"], ["_inserted_timestamp desc"])
    return with_audit(out.withColumn("blocks_id", surrogate_key("block_number")), run_ts, run_id)


def silver_transactions(bronze: DataFrame, run_ts: dt.datetime, target: DataFrame | None = None,
                        run_id: str | None = None) -> DataFrame:
    """M2: one transaction document per (block, position); rows without position dropped."""
    src = _new_since(bronze, target).where(F.col("data").isNotNull())
    src = src.select("block_number", "partition_key", jget("value", "$.array_index", "int").alias("tx_position"),
                     F.col("data").alias("transaction_json"), "_inserted_timestamp", *_line(bronze)).where("tx_position IS NOT NULL")
    out = _latest(src, ["block_number", "tx_position"], ["_inserted_timestamp desc"])
    return with_audit(out.withColumn("transactions_id", surrogate_key("block_number", "tx_position")), run_ts, run_id)


def silver_receipts(bronze: DataFrame, run_ts: dt.datetime, target: DataFrame | None = None,
                    run_id: str | None = None) -> DataFrame:
    """M3: latest receipt per tx hash (newest block first, then newest delivery).

    A present `result: null` stays (it never matches a transaction later)."""
    src = computed_once(_new_since(bronze, target), "receipts_json", jnode("data", "$.result")).where("receipts_json IS NOT NULL")
    src = src.select("block_number", "partition_key", "tx_hash", "receipts_json", "_inserted_timestamp", *_line(bronze))
    out = _latest(src, ["tx_hash"], ["block_number desc", "_inserted_timestamp desc"])
    return with_audit(out.withColumn("receipts_id", surrogate_key("block_number", "tx_hash")), run_ts, run_id)


def silver_traces(bronze: DataFrame, run_ts: dt.datetime, target: DataFrame | None = None,
                  run_id: str | None = None) -> DataFrame:
    """M4: one row per call node of the latest trace document per (block, position), with its
    depth-first position, child count and whether it or a caller failed."""
    deep = F.col("data_text") if "data_text" in bronze.columns else F.lit(None).cast("string")
    src = computed_once(_new_since(bronze, target), "_doc", jnode("data", "$.result")).select(
        "block_number", jget("value", "$.array_index", "int").alias("tx_position"), "partition_key",
        F.col("_doc").alias("full_traces"), deep.alias("_deep"), F.col("_doc").isNotNull().alias("_open"),
        "_inserted_timestamp", *_line(bronze))

    def latest(rows: DataFrame) -> DataFrame:
        return _latest(rows, ["block_number", "tx_position"], ["_inserted_timestamp desc"])
    # known before the rows are shuffled, so that the branch of text documents doesn't shuffle the others' trees
    some = src.where("_open OR _deep IS NOT NULL")
    keys = ["block_number", "tx_position", "partition_key", "_inserted_timestamp"]
    how = {"inherit": {"path_error": "error"}, "skip_field": "failed"}
    out = flatten_tree(latest(some).where("_open"), "full_traces", keys, **how)
    if "data_text" in bronze.columns:  # documents beyond VARIANT, as text; without any, no other can precede one
        texts = src.where("_deep IS NOT NULL")
        long = latest(texts if texts.isEmpty() else some).where("not _open").select(*keys, _result_of(F.col("_deep")).alias("full_traces"))
        out = out.unionByName(flatten_tree(long, "full_traces", keys, **how))
    out = out.withColumnRenamed("node", "trace_json").drop("depth")
    out = out.withColumn("traces_id", surrogate_key("block_number", "tx_position", "trace_address"))
    return with_audit(out, run_ts, run_id)
