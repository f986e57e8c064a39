"""Gold facts (M5-M8): typed blocks, transactions, event logs and call traces.

Each builder returns the batch of rows to upsert; `target` (the current fact
table, or None on a first run) drives the high-water mark and the heal branch.
Heal re-derives rows whose lookups (block time, receipt, transaction) were
missing when first built; the winner rule then keeps the most complete row.
Rows are keyed by their own id, never replaced per block, so a heal cannot
drop the complete rows of the same block (a quirk of the reference).
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hexnum import (decimal_adjust, hex_epoch_ts, hex_to_bigint, hex_to_decimal, hex_to_int, to_gwei,
                                tx_fee_precise)
from ..functions.json import jget, jnode, jsize, jstr_at
from ..functions.keys import lit_ts, nullif_empty, selector, status_bool, surrogate_key
from ..operators.explode import explode_json
from ..operators.incremental import EPOCH, high_water, since
from ..operators.joins import join_keys, lookup
from ..operators.latest import latest_per_key
from .silver import with_audit

NETWORK = "testnet"


def _delta(src: DataFrame, target: DataFrame | None) -> tuple[DataFrame, dt.datetime | None]:
    if target is None:
        return src, None
    mark = high_water(target, "modified_timestamp", EPOCH)
    return since(src, "modified_timestamp", mark, inclusive=False), mark


def _lookup_floor(mark: dt.datetime | None) -> dt.datetime | None:
    """Lookup pruning of the reference: parents modified since date(mark) - 1 day."""
    if mark is None:
        return None
    return dt.datetime(mark.year, mark.month, mark.day) - dt.timedelta(days=1)


def _near(missing: DataFrame, *lookups: DataFrame) -> list[DataFrame] | None:
    """The lookups within the range of blocks that rows to heal come from; None if there is nothing to heal."""
    r = missing.agg(F.min("block_number").alias("lo"), F.max("block_number").alias("hi")).first()
    if r["lo"] is None:
        return None
    return [d.where(F.col("block_number").between(r["lo"], r["hi"])) for d in lookups]


# ---------------------------------------------------------------- M5 blocks
def fact_blocks(silver_blocks: DataFrame, run_ts: dt.datetime, target: DataFrame | None = None,
                network: str = NETWORK) -> DataFrame:
    src, _ = _delta(silver_blocks, target)
    b = F.col("block_json")
    out = src.select(
        "block_number",
        jget(b, "$.hash").alias("block_hash"),
        hex_epoch_ts(jget(b, "$.timestamp")).alias("block_timestamp"),
        F.lit(network).alias("network"),
        jsize(b, "$.transactions").alias("tx_count"),
        hex_to_bigint(jget(b, "$.size")).alias("size"),
        jget(b, "$.miner").alias("miner"),
        jget(b, "$.mixHash").alias("mix_hash"),
        jget(b, "$.extraData").alias("extra_data"),
        jget(b, "$.parentHash").alias("parent_hash"),
        hex_to_bigint(jget(b, "$.gasUsed")).alias("gas_used"),
        hex_to_bigint(jget(b, "$.gasLimit")).alias("gas_limit"),
        hex_to_decimal(jget(b, "$.baseFeePerGas")).alias("base_fee_per_gas"),
        hex_to_decimal(jget(b, "$.difficulty")).alias("difficulty"),
        hex_to_decimal(jget(b, "$.totalDifficulty")).alias("total_difficulty"),
        jget(b, "$.sha3Uncles").alias("sha3_uncles"),
        jnode(b, "$.uncles").alias("uncle_blocks"),
        hex_to_decimal(jget(b, "$.nonce")).alias("nonce"),
        jget(b, "$.receiptsRoot").alias("receipts_root"),
        jget(b, "$.stateRoot").alias("state_root"),
        jget(b, "$.transactionsRoot").alias("transactions_root"),
        jget(b, "$.logsBloom").alias("logs_bloom"),
        surrogate_key("block_number").alias("fact_blocks_id"),
    )
    return with_audit(out, run_ts)


# ---------------------------------------------------------- M6 transactions
def _tx_fields(base: DataFrame) -> DataFrame:
    t = F.col("transaction_json")
    raw_value = hex_to_int(jget(t, "$.value"))
    precise = decimal_adjust(raw_value, 18)
    return base.select(
        "block_number", "tx_position",
        jget(t, "$.blockHash").alias("block_hash"),
        jget(t, "$.from").alias("from_address"),
        hex_to_bigint(jget(t, "$.gas")).alias("gas_limit"),
        hex_to_decimal(jget(t, "$.gasPrice")).alias("_gas_price_wei"),
        jget(t, "$.hash").alias("tx_hash"),
        jget(t, "$.input").alias("input_data"),
        selector(jget(t, "$.input")).alias("origin_function_signature"),
        hex_to_decimal(jget(t, "$.nonce")).alias("nonce"),
        jget(t, "$.r").alias("r"),
        jget(t, "$.s").alias("s"),
        nullif_empty(jget(t, "$.to")).alias("to_address"),
        hex_to_bigint(jget(t, "$.type")).alias("tx_type"),
        hex_to_bigint(jget(t, "$.v")).alias("v"),
        to_gwei(jget(t, "$.maxFeePerGas")).alias("max_fee_per_gas"),
        to_gwei(jget(t, "$.maxPriorityFeePerGas")).alias("max_priority_fee_per_gas"),
        raw_value.alias("value_precise_raw"),
        precise.alias("value_precise"),
        precise.cast("double").alias("value"),
        jnode(t, "$.accessList").alias("access_list"),
    )


def _receipt_keyed(receipts: DataFrame) -> DataFrame:
    """Receipts with the JSON-derived join key materialised first."""
    r = F.col("receipts_json")
    return receipts.select(
        "block_number", jget(r, "$.transactionHash").alias("tx_hash"),
        jget(r, "$.status").alias("_status"),
        hex_to_bigint(jget(r, "$.gasUsed")).alias("gas_used"),
        hex_to_bigint(jget(r, "$.cumulativeGasUsed")).alias("cumulative_gas_used"),
        hex_to_decimal(jget(r, "$.effectiveGasPrice")).alias("effective_gas_price"),
        *([c for c in ["modified_timestamp"] if c in receipts.columns]))


TX_ORDER = ["block_number desc", "block_timestamp desc nulls last", "tx_succeeded desc nulls last"]


def _tx_rows(fields: DataFrame, blocks: DataFrame, receipts: DataFrame, floor) -> DataFrame:
    pf = None if floor is None else F.col("modified_timestamp") >= lit_ts(floor)
    j = lookup(fields, blocks, ["block_number"], ["block_timestamp"], parent_filter=pf)
    rk = _receipt_keyed(receipts)
    if floor is not None and "modified_timestamp" in rk.columns:
        rk = rk.where(pf)
    rk = rk.drop("modified_timestamp") if "modified_timestamp" in rk.columns else rk
    j = join_keys(j, rk, ["block_number", "tx_hash"], "left")
    fee = tx_fee_precise(F.col("_gas_price_wei"), F.col("gas_used"), 18)
    return j.select(
        "block_number", "block_timestamp", "tx_hash", "from_address", "to_address", "origin_function_signature",
        "value", "value_precise_raw", "value_precise",
        F.coalesce(fee.cast("double"), F.lit(0.0)).alias("tx_fee"), fee.alias("tx_fee_precise"),
        status_bool("_status").alias("tx_succeeded"), "tx_type", "nonce", "tx_position", "input_data",
        (F.col("_gas_price_wei").cast("double") / F.lit(1e9)).alias("gas_price"),
        "gas_used", "gas_limit", "cumulative_gas_used", "effective_gas_price",
        "max_fee_per_gas", "max_priority_fee_per_gas", "access_list", "r", "s", "v")


def fact_transactions(silver_tx: DataFrame, blocks: DataFrame, receipts: DataFrame, run_ts: dt.datetime,
                      target: DataFrame | None = None) -> DataFrame:
    base, mark = _delta(silver_tx, target)
    rows = _tx_rows(_tx_fields(base), blocks, receipts, _lookup_floor(mark))
    if target is not None:
        # heal: re-derive incomplete rows from silver, with lookups as old as they need; a receipt without
        # a status is an answer, not a gap
        missing = target.where(F.col("block_timestamp").isNull() | (F.col("tx_succeeded").isNull() & F.col("gas_used").isNull()))
        near = _near(missing, silver_tx, blocks, receipts)
        if near is not None:
            again = join_keys(near[0], missing.select("block_number", "tx_position"), ["block_number", "tx_position"], "left_semi")
            rows = rows.unionByName(_tx_rows(_tx_fields(again), near[1], near[2], None))
    rows = latest_per_key(rows, ["tx_hash"], TX_ORDER, tiebreak=["tx_position", "tx_fee_precise"])
    return with_audit(rows.withColumn("fact_transactions_id", surrogate_key("tx_hash")), run_ts)


# ----------------------------------------------------------- M7 event logs
LOG_ORDER = ["block_number desc", "block_timestamp desc nulls last", "origin_function_signature desc nulls last"]


def _log_rows(receipts: DataFrame) -> DataFrame:
    r = F.col("receipts_json")
    base = receipts.where(jsize(r, "$.logs") > 0).select(
        "block_number", "tx_hash", "receipts_json",
        jget(r, "$.from").alias("origin_from_address"), jget(r, "$.to").alias("origin_to_address"),
        status_bool(jget(r, "$.status")).alias("tx_succeeded"))
    logs = explode_json(base, "receipts_json", "$.logs",
                        keep=["block_number", "tx_hash", "origin_from_address", "origin_to_address", "tx_succeeded"])
    v = F.col("value")
    return logs.select(
        "block_number", "tx_hash",
        hex_to_bigint(jget(v, "$.transactionIndex")).cast("int").alias("tx_position"),
        hex_to_bigint(jget(v, "$.logIndex")).cast("int").alias("event_index"),
        jget(v, "$.address").alias("contract_address"),
        jnode(v, "$.topics").alias("topics"),
        *[jstr_at(v, "$.topics", i).alias(f"topic_{i}") for i in range(4)],
        jget(v, "$.data").alias("data"),
        jget(v, "$.removed", "boolean").alias("event_removed"),
        "origin_from_address", "origin_to_address", "tx_succeeded")


def _log_lookups(rows: DataFrame, keyed: DataFrame, blocks: DataFrame, txs: DataFrame, floor) -> DataFrame:
    """Rows with their block's time and their transaction's signature. Both are looked up for the rows' keys alone
    (`keyed` has them all), so that the rows themselves are shuffled once."""
    pf = None if floor is None else F.col("modified_timestamp") >= lit_ts(floor)
    keys = ["block_number", "tx_hash"]
    found = lookup(keyed.select(*keys).distinct(), blocks, ["block_number"], ["block_timestamp"], parent_filter=pf)
    found = lookup(found, txs, ["tx_hash", "block_number"], ["origin_function_signature"], parent_filter=pf)
    return join_keys(rows, found, keys, "left", null_safe=True)


LOG_COLS = ["block_number", "block_timestamp", "tx_hash", "tx_position", "event_index", "contract_address", "topics",
            "topic_0", "topic_1", "topic_2", "topic_3", "data", "event_removed", "origin_from_address",
            "origin_to_address", "origin_function_signature", "tx_succeeded"]


def fact_event_logs(receipts: DataFrame, blocks: DataFrame, txs: DataFrame, run_ts: dt.datetime,
                    target: DataFrame | None = None) -> DataFrame:
    base, mark = _delta(receipts, target)
    rows = _log_lookups(_log_rows(base), base, blocks, txs, _lookup_floor(mark)).select(*LOG_COLS)
    if target is not None:
        missing = target.where(F.col("block_timestamp").isNull() | F.col("origin_function_signature").isNull())
        again = missing.select(*[c for c in LOG_COLS if c not in ("block_timestamp", "origin_function_signature")])
        near = _near(missing, blocks, txs)
        if near is not None:
            rows = rows.unionByName(_log_lookups(again, again, *near, None).select(*LOG_COLS))
        # only a heal can bring a second row for a key (receipts are unique per tx)
        rows = latest_per_key(rows, ["tx_hash", "event_index"], LOG_ORDER,
                              tiebreak=["tx_position", "contract_address"])
    return with_audit(rows.withColumn("fact_event_logs_id", surrogate_key("tx_hash", "event_index")), run_ts)


# ---------------------------------------------------------------- M8 traces
TRACE_ORDER = ["block_timestamp desc nulls last", "tx_succeeded desc nulls last"]
TX_LOOKUP = {"tx_hash": "tx_hash", "block_timestamp": "block_timestamp",
             "origin_function_signature": "origin_function_signature", "origin_from_address": "from_address",
             "origin_to_address": "to_address", "tx_succeeded": "tx_succeeded"}
TRACE_COLS = ["block_number", "block_timestamp", "tx_hash", "tx_position", "trace_index", "from_address",
              "to_address", "input", "output", "type", "trace_address", "sub_traces", "value", "value_precise_raw",
              "value_precise", "value_hex", "gas", "gas_used", "origin_from_address", "origin_to_address",
              "origin_function_signature", "trace_succeeded", "error_reason", "revert_reason", "tx_succeeded"]


def trace_nodes(silver_traces: DataFrame) -> DataFrame:
    """Typed call nodes (no tx fields). Position, child count and failure on the path come with
    silver, from the walk over the tree; nodes with a `failed` field have no position."""
    st = silver_traces.where(F.col("trace_index").isNotNull())
    t = F.col("trace_json")
    raw = F.coalesce(hex_to_int(jget(t, "$.value")), F.lit("0"))
    precise = decimal_adjust(raw, 18)
    return st.select(
        "block_number", "tx_position", "trace_index", "trace_address", "sub_traces",
        jget(t, "$.from").alias("from_address"), jget(t, "$.to").alias("to_address"),
        jget(t, "$.input").alias("input"), jget(t, "$.output").alias("output"), jget(t, "$.type").alias("type"),
        precise.cast("double").alias("value"), raw.alias("value_precise_raw"), precise.alias("value_precise"),
        F.coalesce(jget(t, "$.value"), F.lit("0x0")).alias("value_hex"),
        hex_to_bigint(jget(t, "$.gas")).alias("gas"), hex_to_bigint(jget(t, "$.gasUsed")).alias("gas_used"),
        (~F.col("path_error")).alias("trace_succeeded"),
        jget(t, "$.error").alias("error_reason"), jget(t, "$.revertReason").alias("revert_reason"),
        *([c for c in ["modified_timestamp"] if c in silver_traces.columns]))


def _trace_lookup(nodes: DataFrame, txs: DataFrame, floor) -> DataFrame:
    t = txs if floor is None else txs.where(F.col("modified_timestamp") >= lit_ts(floor))
    t = t.select("block_number", "tx_position", *[F.col(v).alias(k) for k, v in TX_LOOKUP.items()])
    return join_keys(nodes.drop(*[k for k in TX_LOOKUP if k in nodes.columns]), t,
                     ["block_number", "tx_position"], "left")


def fact_traces(silver_traces: DataFrame, txs: DataFrame, run_ts: dt.datetime,
                target: DataFrame | None = None) -> DataFrame:
    base, mark = _delta(silver_traces, target)
    floor = None if mark is None else mark - dt.timedelta(hours=24)
    rows = _trace_lookup(trace_nodes(base), txs, floor).select(*TRACE_COLS)
    if target is not None:
        missing = target.where(F.col("block_timestamp").isNull() | F.col("tx_hash").isNull())
        near = _near(missing, txs)
        if near is not None:
            rows = rows.unionByName(_trace_lookup(missing.select(*TRACE_COLS), near[0], None).select(*TRACE_COLS))
        # silver is one row per node, so only healed rows can compete for a key
        rows = latest_per_key(rows, ["block_number", "tx_position", "trace_index"], TRACE_ORDER,
                              tiebreak=["trace_address"])
    rows = rows.withColumn("fact_traces_id", surrogate_key("block_number", "tx_position", "trace_index"))
    return with_audit(rows, run_ts)
