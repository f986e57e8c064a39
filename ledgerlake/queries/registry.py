"""Registered queries over the driver tables, each with its DuckDB oracle.

Every query reads whole tables (or data Spark derives from them) and exercises
one or more operators of the survey's inventory; the oracle states the same
result relationally. Column names and types agree on both sides.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as LF
from ..operators import backlog as BL
from ..operators import checks as CK
from ..operators import incremental as INC
from ..operators import setops as SO
from ..operators import sinks as SK
from ..operators.explode import explode_json, posexplode_json
from ..operators.joins import lookup
from ..operators.latest import latest_per_key, top_per_key
from ..operators.numbering import number_within, with_lag
from ..operators.tree import ancestor_flag, child_counts, flatten_tree, has_error, preorder_index
from ..plans import contracts as CT
from ..plans import gold as GD
from ..plans import ingest as IN
from ..plans import suites as SU
from ..plans.run import run_model
from ..session import store
from . import chain as CH
from .sqlparts import BLOCK_SQL, LINES_CTE, LOG_SQL, NODES_CTE, TRACE_SQL, TX_CTE, TX_SQL, addr, shift_sql, word

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Fixed run times of the scenarios (no wall clock inside a query).
NOW = dt.datetime(2024, 1, 20, 12, 30, 0)
SPLIT_TS = dt.datetime(2024, 1, 15, 0, 0, 0)


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def T(spark, sf, name):
    return CH.table(spark, sf, name)


_chains: dict = {}


def chain(spark, sf) -> CH.Chain:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _chains:
        _chains[key] = CH.Chain(spark, sf)
    return _chains[key]


# ------------------------------------------------------------------ N1-N5
@query("latest_per_key", """
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_latest_per_key(spark, sf):
    ev = T(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_per_key(ev, ["user_id"], ["ts desc", "event_id desc"])


@query("latest_ranked", """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS FIRST, l_extendedprice DESC NULLS LAST, l_partkey DESC, l_suppkey DESC,
           l_quantity DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""")
def q_latest_ranked(spark, sf):
    li = T(spark, sf, "lineitem")
    return latest_per_key(li, ["l_orderkey", "l_linenumber"],
                          ["l_shipdate desc", "l_extendedprice desc nulls last"],
                          tiebreak=["l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag",
                                    "l_linestatus"])


# ------------------------------------------------------------- P1-P33
@query("json_fields", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       coalesce(json_extract_string(props, '$.missing'), 'none') AS missing,
       json_type(props) = 'OBJECT' AS is_object
FROM events""")
def q_json_fields(spark, sf):
    ev = T(spark, sf, "events")
    v = LF.as_variant("props")
    return ev.select("event_id", LF.jget(v, "$.k", "bigint").alias("k"),
                     F.coalesce(LF.jget(v, "$.missing"), F.lit("none")).alias("missing"),
                     (F.schema_of_variant(v).startswith("OBJECT")).alias("is_object"))


@query("hex_roundtrip", """
SELECT o_orderkey, '0x' || lower(hex(o_orderkey)) AS hex_key, o_orderkey::VARCHAR AS back,
       true AS same FROM orders""")
def q_hex_roundtrip(spark, sf):
    o = T(spark, sf, "orders")
    h = LF.int_to_hex("o_orderkey")
    back = LF.hex_to_int(h)
    return o.select("o_orderkey", h.alias("hex_key"), back.alias("back"),
                    (back == F.col("o_orderkey").cast("string")).alias("same"))


@query("hex_wide", """
SELECT c_custkey, '0x' || md5(c_name) AS hex_value, ('0x' || md5(c_name))::UHUGEINT::VARCHAR AS dec_value,
       upper(md5(c_name)) AS upper_hex FROM customer""")
def q_hex_wide(spark, sf):
    c = T(spark, sf, "customer")
    h = F.concat(F.lit("0x"), F.md5("c_name"))
    return c.select("c_custkey", h.alias("hex_value"),
                    LF.hex_to_int(F.concat(F.lit("0X"), F.upper(F.md5("c_name")))).alias("dec_value"),
                    F.upper(F.md5("c_name")).alias("upper_hex"))


@query("amounts", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(l_extendedprice * 100)::BIGINT::VARCHAR AS raw,
       {shift_sql('round(l_extendedprice * 100)::BIGINT', 2)} AS precise,
       CAST({shift_sql('round(l_extendedprice * 100)::BIGINT', 2)} AS DOUBLE) AS amount,
       {shift_sql('round(l_extendedprice * 100)::BIGINT * l_quantity::BIGINT', 2)} AS fee_precise,
       (round(l_extendedprice * 100)::BIGINT)::DOUBLE / 1e9 AS gwei
FROM lineitem""")
def q_amounts(spark, sf):
    li = T(spark, sf, "lineitem")
    c = CH.cents(F.col("l_extendedprice"))
    h = LF.int_to_hex(c)
    raw, precise, amount = LF.amount_cols(h, 2, "amount")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", raw.alias("raw"),
                     precise.alias("precise"), amount.alias("amount"),
                     LF.tx_fee_precise(c, F.col("l_quantity").cast("bigint"), 2).alias("fee_precise"),
                     LF.to_gwei(h).alias("gwei"))


@query("text_from_hex", """
SELECT n_nationkey, n_name AS name, length(n_name)::BIGINT AS n_chars FROM nation""")
def q_text_from_hex(spark, sf):
    n = T(spark, sf, "nation")
    padded = F.concat(F.lit("0x"), F.rpad(F.lower(F.hex("n_name")), 64, "0"))
    txt = LF.hex_to_string(padded)
    return n.select("n_nationkey", txt.alias("name"), F.length(txt).cast("bigint").alias("n_chars"))


@query("status_flags", """
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS tx_succeeded,
       left(o_orderpriority, 10) AS selector,
       nullif(CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END, '') AS priority,
       CASE WHEN o_totalprice > 250000 THEN 'high' ELSE 'low' END AS band
FROM orders""")
def q_status_flags(spark, sf):
    o = T(spark, sf, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "0x1").when(F.col("o_orderstatus") == "O", "0x0") \
        .otherwise(F.col("o_orderstatus"))
    pr = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(F.col("o_orderpriority"))
    return o.select("o_orderkey", LF.status_bool(status).alias("tx_succeeded"),
                    LF.selector("o_orderpriority").alias("selector"), LF.nullif_empty(pr).alias("priority"),
                    F.when(F.col("o_totalprice") > 250000, "high").otherwise("low").alias("band"))


@query("surrogate_keys", """
SELECT l_orderkey, l_linenumber,
       md5(l_orderkey::VARCHAR || '-' ||
           coalesce((CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber END)::VARCHAR,
                    '_dbt_utils_surrogate_key_null_')) AS id
FROM lineitem""")
def q_surrogate_keys(spark, sf):
    li = T(spark, sf, "lineitem")
    ln = F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_linenumber"))
    return li.select("l_orderkey", "l_linenumber", LF.surrogate_key("l_orderkey", ln).alias("id"))


# ---------------------------------------------------------------- X1, X2
@query("explode_lines", f"""
WITH {TX_CTE}, {LINES_CTE}
SELECT tx_hash, log_index AS event_index, (SELECT count(*) FROM lineitem x WHERE x.l_orderkey = lines.l_orderkey)
         AS n_logs,
       '0x' || md5(l_returnflag) AS topic_0, {word('l_partkey')} AS topic_1, {word('l_linenumber')} AS topic_2,
       CASE WHEN l_linestatus = 'O' THEN '0x' || md5(l_linestatus) END AS topic_3
FROM lines""")
def q_explode_lines(spark, sf):
    r = chain(spark, sf).silver("receipts")
    base = r.select("tx_hash", "receipts_json", LF.jsize("receipts_json", "$.logs").cast("bigint").alias("n_logs"))
    logs = explode_json(base, "receipts_json", "$.logs", keep=["tx_hash", "n_logs"], pos="event_index")
    return logs.select("tx_hash", F.col("event_index").cast("bigint").alias("event_index"), "n_logs",
                       *[LF.jstr_at("value", "$.topics", i).alias(f"topic_{i}") for i in range(4)])


# ------------------------------------------------------- X3, N6, A1, J5-J7
@query("tree_flatten", f"""
WITH {TX_CTE}, {NODES_CTE}
SELECT o_orderkey, trace_address, parent_trace_address, depth, sub_traces, from_address, to_address, type
FROM nodes""")
def q_tree_flatten(spark, sf):
    docs = chain(spark, sf).docs.select("o_orderkey", F.parse_json(F.to_json("root")).alias("root"))
    n = flatten_tree(docs, "root", ["o_orderkey"])
    return n.select("o_orderkey", "trace_address", "parent_trace_address", F.col("depth").cast("bigint"),
                    F.col("sub_traces").cast("bigint"), LF.jget("node", "$.from").alias("from_address"),
                    LF.jget("node", "$.to").alias("to_address"), LF.jget("node", "$.type").alias("type"))


@query("tree_index", f"""
WITH {TX_CTE}, {NODES_CTE}
SELECT block_number, tx_position, trace_address, trace_index, sub_traces FROM nodes""")
def q_tree_index(spark, sf):
    # on the flat table, without what the walk already knows
    g = ["block_number", "tx_position"]
    st = chain(spark, sf).silver("traces").select(*g, "trace_address", "parent_trace_address", "trace_address_array")
    n = child_counts(st, g, "trace_address", "parent_trace_address", "sub_traces")
    n = preorder_index(n, g, "trace_address_array", "trace_index", mode="split")
    return n.select(F.col("block_number").cast("bigint"), F.col("tx_position").cast("bigint"), "trace_address",
                    F.col("trace_index").cast("bigint"), F.col("sub_traces").cast("bigint"))


@query("tree_errors", f"""
WITH {TX_CTE}, {NODES_CTE}
SELECT o_orderkey, trace_address, own_error, NOT path_error AS trace_succeeded,
       NOT path_error AS trace_succeeded_join FROM nodes""")
def q_tree_errors(spark, sf):
    docs = chain(spark, sf).docs.select("o_orderkey", F.parse_json(F.to_json("root")).alias("root"))
    n = flatten_tree(docs, "root", ["o_orderkey"], inherit={"path_error": "error"})
    n = n.withColumn("own_error", has_error(F.col("node")))
    n = ancestor_flag(n, ["o_orderkey"], "own_error", "trace_address_array", "any_error")
    return n.select("o_orderkey", "trace_address", "own_error", (~F.col("path_error")).alias("trace_succeeded"),
                    (~F.col("any_error")).alias("trace_succeeded_join"))


def _plain(fact):
    """All columns of a fact but the run stamps; JSON as text, small integers as BIGINT."""
    cols = []
    for f in fact.schema.fields:
        if f.name in ("inserted_timestamp", "modified_timestamp"):
            continue
        kind = f.dataType.typeName()
        c = F.col(f.name)
        cols.append((F.to_json(c) if kind == "variant" else c.cast("bigint") if kind == "integer" else c).alias(f.name))
    return fact.select(*cols)


@query("call_tree_fact", TRACE_SQL)
def q_call_tree_fact(spark, sf):
    return _plain(chain(spark, sf).gold("traces"))


@query("deep_calls", """
WITH n AS (SELECT o_orderkey // 1024 AS doc, o_orderkey, o_orderstatus,
                  row_number() OVER (PARTITION BY o_orderkey // 1024 ORDER BY o_orderkey) - 1 AS pos FROM orders)
SELECT doc, pos::BIGINT AS depth, pos::BIGINT AS trace_index, o_orderkey,
       max((o_orderstatus = 'P')::INT) OVER (PARTITION BY doc ORDER BY pos) = 1 AS path_error,
       (pos < max(pos) OVER (PARTITION BY doc))::BIGINT AS sub_traces FROM n""")
def q_deep_calls(spark, sf):
    """1,024 orders in a row as one call chain: deeper than VARIANT parses."""
    o = T(spark, sf, "orders").select(F.floor(F.col("o_orderkey") / 1024).alias("doc"), "o_orderkey", "o_orderstatus")
    node = F.concat(F.lit('{"key":'), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderstatus") == "P", ',"error":"p"')
                    .otherwise(""))
    per = o.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", node.alias("n")))).alias("a"))
    text = F.concat(F.array_join(F.transform("a", lambda x: x["n"]), ',"calls":['), F.lit("}"),
                    F.repeat(F.lit("]}"), F.size("a") - 1))
    n = flatten_tree(per.select("doc", text.alias("text")), "text", ["doc"], inherit={"path_error": "error"})
    return n.select("doc", F.col("depth").cast("bigint"), F.col("trace_index").cast("bigint"),
                    LF.jget("node", "$.key", "bigint").alias("o_orderkey"), "path_error", F.col("sub_traces").cast("bigint"))


@query("deep_chain", """
SELECT conv_id, CASE WHEN turn = 0 THEN 'ORIGIN' ELSE repeat('0_', (turn - 1)::INT) || '0' END AS trace_address, turn AS depth, role, length(text)::BIGINT AS n_chars
FROM conversations""")
def q_deep_chain(spark, sf):
    cv = T(spark, sf, "conversations")
    # each dialogue becomes one document: turn k is the only call of turn k-1
    turns = cv.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))

    def nest(acc, x):
        node = F.to_json(F.struct(x["turn"].alias("turn"), x["role"].alias("role"), x["text"].alias("text")))
        inner = F.concat(F.substring(node, 1, F.length(node) - 1), F.lit(',"calls":['), acc, F.lit("]}"))
        return F.when(acc == "", node).otherwise(inner)

    doc = F.aggregate(F.reverse("t"), F.lit(""), nest)
    docs = turns.select("conv_id", F.parse_json(doc).alias("doc"))
    n = flatten_tree(docs, "doc", ["conv_id"])
    return n.select("conv_id", "trace_address", F.col("depth").cast("bigint"), LF.jget("node", "$.role").alias("role"),
                    F.length(LF.jget("node", "$.text")).cast("bigint").alias("n_chars"))


# ------------------------------------------------------------ M1, M5-M7
@query("block_fact", BLOCK_SQL)
def q_block_fact(spark, sf):
    return _plain(chain(spark, sf).gold("blocks"))


@query("tx_fact", TX_SQL)
def q_tx_fact(spark, sf):
    return _plain(chain(spark, sf).gold("transactions"))


@query("log_fact", LOG_SQL)
def q_log_fact(spark, sf):
    return _plain(chain(spark, sf).gold("event_logs"))


# ------------------------------------------------------------ W1-W4, T2-T5
def _orders_batch(spark, sf):
    """Target = orders dated before 1998; batch = orders from 1998 on plus a re-delivery
    of every order of status 'P' with a new price (updates of existing keys)."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    target = o.where(F.col("o_orderdate") < LF.lit_ts(dt.datetime(1998, 1, 1)))
    late = o.where(F.col("o_orderdate") >= LF.lit_ts(dt.datetime(1998, 1, 1)))
    changed = target.where(F.col("o_orderstatus") == "P").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    target = target.withColumn("first_seen", LF.lit_ts(dt.datetime(2024, 1, 1)))
    batch = late.unionByName(changed).withColumn("first_seen", LF.lit_ts(dt.datetime(2024, 2, 1)))
    return target, batch


_UPSERT_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1998-01-01' THEN o_totalprice + 1
            ELSE o_totalprice END AS o_totalprice, o_orderdate,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' AND {keep} THEN TIMESTAMP '2024-01-01'
            ELSE TIMESTAMP '2024-02-01' END AS first_seen
FROM orders"""


@query("replace_by_key", _UPSERT_SQL.format(keep="o_orderstatus <> 'P'"))
def q_replace_by_key(spark, sf):
    target, batch = _orders_batch(spark, sf)
    return SK.upsert(target, batch, "o_orderkey", "replace_key")


@query("merge_keep", _UPSERT_SQL.format(keep="true"))
def q_merge_keep(spark, sf):
    target, batch = _orders_batch(spark, sf)
    return SK.upsert(target, batch, "o_orderkey", "merge", keep_existing=["first_seen"])


@query("merge_pruned", _UPSERT_SQL.format(keep="o_orderstatus <> 'P'"))
def q_merge_pruned(spark, sf):
    target, batch = _orders_batch(spark, sf)
    # the stored rows of the batch's keys have the batch's dates; rows dated before them are not joined
    return SK.upsert(target, batch, "o_orderkey", "merge", prune_on="o_orderdate")


RUNS = (dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2), dt.datetime(2024, 2, 3))


def _stamped(df, late):
    """`df` as the second run finds it: rows for which `late` holds came after the first."""
    return df.withColumn("modified_timestamp", F.when(late, LF.lit_ts(RUNS[1] - dt.timedelta(hours=1)))
                         .otherwise(LF.lit_ts(RUNS[0] - dt.timedelta(hours=1))))


def _two_runs(spark, name, key, source, late, first_lookups, lookups, build):
    """A stored fact after two runs. The first sees the early rows and lookups that lack some parents;
    the second gets the late rows as a true delta and heals what the first could not complete."""
    from ..streaming import work_dir
    path = work_dir(spark, name)
    early = source.where(~late)
    run_model(spark, path, lambda target: build(early, *first_lookups, RUNS[0], target), key, "bucket", bucket_of="block_number")
    return run_model(spark, path, lambda target: build(_stamped(source, late), *lookups, RUNS[1], target), key, "bucket",
                     bucket_of="block_number", keep_existing=["inserted_timestamp"]).drop("bucket")


@query("heal_late", TX_SQL)
def q_heal_late(spark, sf):
    c = chain(spark, sf)
    blocks = _stamped(c.gold("blocks"), F.lit(False))
    receipts = _stamped(c.silver("receipts"), F.lit(False))
    early = blocks.where(F.col("block_number") % 2 == 0)
    return _plain(_two_runs(spark, "heal-tx", "tx_hash", _stamped(c.silver("transactions"), F.lit(False)),
                            F.col("tx_position") % 3 == 1, (early, receipts), (blocks, receipts), GD.fact_transactions))


@query("heal_logs", LOG_SQL)
def q_heal_logs(spark, sf):
    c = chain(spark, sf)
    blocks, txs = (_stamped(c.gold(n), F.lit(False)) for n in ("blocks", "transactions"))
    few = txs.where(F.col("block_number") % 2 == 0)
    return _plain(_two_runs(spark, "heal-logs", ["tx_hash", "event_index"], _stamped(c.silver("receipts"), F.lit(False)),
                            F.col("block_number") % 5 == 1, (blocks, few), (blocks, txs), GD.fact_event_logs))


@query("heal_traces", TRACE_SQL)
def q_heal_traces(spark, sf):
    c = chain(spark, sf)
    txs = _stamped(c.gold("transactions"), F.lit(False))
    few = txs.where(F.col("block_number") % 2 == 0)
    return _plain(_two_runs(spark, "heal-traces", ["block_number", "tx_position", "trace_index"],
                            _stamped(c.silver("traces"), F.lit(False)), F.col("block_number") % 5 == 1, (few,), (txs,),
                            GD.fact_traces))


@query("relevant_contracts", f"""
WITH {TX_CTE}, {NODES_CTE},
e AS (SELECT {addr('l_suppkey')} AS a, count(*) AS n, max(t.block_number) AS b FROM lineitem JOIN tx t ON t.o_orderkey = l_orderkey GROUP BY 1),
c AS (SELECT n.to_address AS a, count(*) AS n, max(n.block_number) AS b FROM nodes n JOIN tx t ON t.o_orderkey = n.o_orderkey
      WHERE t.tx_succeeded AND NOT n.path_error AND n.to_address <> '' AND n.input IS NOT NULL AND n.input <> '0x' GROUP BY 1)
SELECT coalesce(e.a, c.a) AS contract_address, coalesce(e.n, 0)::BIGINT AS total_event_count,
       coalesce(c.n, 0)::BIGINT AS total_call_count, (coalesce(e.n, 0) + coalesce(c.n, 0))::BIGINT AS total_interaction_count,
       coalesce(e.b, 0)::BIGINT AS latest_event_block, coalesce(c.b, 0)::BIGINT AS latest_call_block
FROM e FULL JOIN c ON e.a = c.a""")
def q_relevant_contracts(spark, sf):
    """Running counts over two runs: odd blocks come with the second."""
    c = chain(spark, sf)
    late = F.col("block_number") % 2 == 1

    def at(df, run):
        return df.withColumn("inserted_timestamp", F.when(late, LF.lit_ts(RUNS[1])).otherwise(LF.lit_ts(RUNS[0]))) \
            .where(F.col("inserted_timestamp") <= LF.lit_ts(RUNS[run]))
    logs, calls = c.gold("event_logs"), c.gold("traces").where(F.col("to_address") != "")
    first = store(CT.relevant_contracts(at(logs, 0), at(calls, 0)), "contracts")
    second = CT.relevant_contracts(at(logs, 1), at(calls, 1), prev=first)
    return SK.upsert(first, second, "contract_address").select(
        "contract_address", "total_event_count", "total_call_count", "total_interaction_count", "latest_event_block",
        "latest_call_block")


@query("ledger_receipts", f"""
WITH {TX_CTE}
SELECT block_number, tx_hash, md5(block_number::VARCHAR || '-' || tx_hash) AS complete_receipts_by_hash_id,
       block_number % 2 = 1 AS second_run FROM tx""")
def q_ledger_receipts(spark, sf):
    """The receipts ledger over two runs of the raw files' rows."""
    b = chain(spark, sf).bronze("receipts_by_hash").select("block_number", "tx_hash", "file_name")
    late = F.col("block_number") % 2 == 1
    b = b.withColumn("_inserted_timestamp", F.when(late, LF.lit_ts(RUNS[1])).otherwise(LF.lit_ts(RUNS[0])))
    first = store(IN.ledger(None, b.where(~late), "receipts_by_hash"), "ledger")
    both = IN.ledger(first, b, "receipts_by_hash")
    return both.select(F.col("block_number").cast("bigint"), "tx_hash", "complete_receipts_by_hash_id",
                       (F.col("_inserted_timestamp") == LF.lit_ts(RUNS[1])).alias("second_run"))


@query("receipts_backlog", f"""
WITH {TX_CTE}
SELECT block_number, tx_hash, round(block_number, -3)::BIGINT AS partition_key,
       '{{"id":' || block_number::VARCHAR || ',"jsonrpc":"2.0","method":"eth_getTransactionReceipt","params":["' || tx_hash || '"]}}' AS request
FROM tx WHERE block_number < 40 AND NOT coalesce(tx_succeeded, false)""")
def q_receipts_backlog(spark, sf):
    """History form: hashes listed by the blocks' answers, less those a ledger has."""
    c = chain(spark, sf)
    done = c.gold("transactions").where("tx_succeeded").select("block_number", "tx_hash")
    out = IN.receipts_backlog(IN.receipts_todo(c.silver("blocks")), done, before_block=40, cap=None)
    return out.select(F.col("block_number").cast("bigint"), "tx_hash", "partition_key", "request")


@query("traces_history", """
SELECT o_orderkey AS block_number, round(o_orderkey, -3)::BIGINT AS partition_key,
       '{"id":' || o_orderkey::VARCHAR || ',"jsonrpc":"2.0","method":"debug_traceBlockByNumber","params":["0x'
         || lower(hex(o_orderkey)) || '",{"tracer":"callTracer","timeout":"120s"}]}' AS request
FROM (SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem) WHERE o_orderkey < 900""")
def q_traces_history(spark, sf):
    spine = T(spark, sf, "orders").select(F.col("o_orderkey").alias("block_number"))
    led = T(spark, sf, "lineitem").select(F.col("l_orderkey").alias("block_number"))
    return IN.traces_backlog(spine, led, before_block=900, cap=None)


@query("running_counts", """
SELECT user_id, count(*)::BIGINT AS n_events, sum((event_type = 'purchase')::INT)::BIGINT AS n_purchases,
       max(ts) AS last_ts FROM events GROUP BY user_id""")
def q_running_counts(spark, sf):
    ev = T(spark, sf, "events")

    def batch(df):
        return df.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"),
                                         F.sum((F.col("event_type") == "purchase").cast("int")).cast("bigint")
                                         .alias("n_purchases"), F.max("ts").alias("last_ts"))
    b1 = batch(ev.where(F.col("ts") < LF.lit_ts(SPLIT_TS)))
    b2 = batch(ev.where(F.col("ts") >= LF.lit_ts(SPLIT_TS)))
    s1 = INC.add_totals(None, b1, "user_id", ["n_events", "n_purchases"], {"last_ts": "last_ts"})
    s2 = INC.add_totals(s1, b2, "user_id", ["n_events", "n_purchases"], {"last_ts": "last_ts"})
    return s2.select("user_id", F.col("n_events").cast("bigint"), F.col("n_purchases").cast("bigint"), "last_ts")


@query("ledger", """
SELECT l_orderkey AS block_number, 'file_' || l_linenumber::VARCHAR AS file_name, l_shipdate AS _inserted_timestamp
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC,
   'file_' || l_linenumber::VARCHAR DESC) = 1""")
def q_ledger(spark, sf):
    li = T(spark, sf, "lineitem").select(F.col("l_orderkey").alias("block_number"),
                                         F.concat(F.lit("file_"), F.col("l_linenumber").cast("string"))
                                         .alias("file_name"), F.col("l_shipdate").alias("_inserted_timestamp"))
    first = li.where(F.col("_inserted_timestamp") < LF.lit_ts(dt.datetime(1998, 1, 1)))
    rest = li.where(F.col("_inserted_timestamp") >= LF.lit_ts(dt.datetime(1998, 1, 1)))
    led = BL.update_ledger(None, first, ["block_number"], order=["_inserted_timestamp desc", "file_name desc"])
    return BL.update_ledger(led, rest, ["block_number"], order=["_inserted_timestamp desc", "file_name desc"])


@query("backlog_keys", """
SELECT o_orderkey AS block_number, round(o_orderkey, -3)::BIGINT AS partition_key,
       '{"id":' || o_orderkey::VARCHAR || ',"jsonrpc":"2.0","method":"eth_getBlockByNumber","params":["0x'
         || lower(hex(o_orderkey)) || '",true]}' AS request
FROM (SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem)
""")
def q_backlog_keys(spark, sf):
    spine = T(spark, sf, "orders").select(F.col("o_orderkey").alias("block_number"))
    led = T(spark, sf, "lineitem").select(F.col("l_orderkey").alias("block_number"))
    return BL.work_backlog(spine, led, "eth_getBlockByNumber", cap=None)


@query("spine", f"""
WITH {TX_CTE}, h AS (SELECT max(block_number) AS head, min(block_number) AS lo FROM tx)
SELECT r.range AS block_number, '0x' || lower(hex(r.range)) AS block_number_hex,
       round(r.range, -3)::BIGINT AS partition_key
FROM h, range((SELECT lo FROM h), (SELECT head FROM h) - 50 + 1) r""")
def q_spine(spark, sf):
    tx = chain(spark, sf).tx
    b = tx.agg(F.max("block_number").alias("head"), F.min("block_number").alias("lo")).first()
    sp = BL.block_spine(spark, int(b["head"]), start_block=int(b["lo"]))
    return sp.select("block_number", "block_number_hex",
                     LF.bucket1000("block_number").cast("bigint").alias("partition_key"))


@query("lookback", """
SELECT coalesce(min(event_id), 0)::BIGINT AS block_number FROM events
WHERE ts >= TIMESTAMP '2024-01-17 12:00:00' AND ts < TIMESTAMP '2024-01-17 13:00:00'""")
def q_lookback(spark, sf):
    ev = T(spark, sf, "events").select(F.col("event_id").alias("block_number"), F.col("ts").alias("block_timestamp"))
    return BL.lookback_frame(ev, NOW, hours=72)


@query("batch_pack", """
WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)
SELECT ceil(rn / 100)::BIGINT AS batch_number, count(*)::BIGINT AS n_requests,
       min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM n GROUP BY 1""")
def q_batch_pack(spark, sf):
    packed = BL.pack_batches(T(spark, sf, "orders").select("o_orderkey"), ["o_orderkey asc"], "o_orderkey", 100)
    return packed.select("batch_number", F.col("n_requests").cast("bigint"),
                         F.col("batch_request")[0].alias("first_key"),
                         F.element_at("batch_request", -1).alias("last_key"))


@query("top_unread", f"""
WITH rel AS (SELECT {addr('o_custkey')} AS contract_address, count(*) AS total_event_count,
                    max(date_diff('day', DATE '1995-01-01', o_orderdate))::BIGINT AS latest_block
             FROM orders GROUP BY o_custkey),
done AS (SELECT {addr('c_custkey')} AS contract_address FROM customer WHERE c_mktsegment = 'BUILDING'),
base AS (SELECT * FROM rel WHERE total_event_count >= 10
         AND contract_address NOT IN (SELECT contract_address FROM done)
         ORDER BY total_event_count DESC, contract_address LIMIT 200),
sel(function_sig) AS (VALUES ('0x313ce567'), ('0x06fdde03'), ('0x95d89b41'))
SELECT contract_address, latest_block, function_sig, rpad(function_sig, 64, '0') AS input,
  '{{"id":"' || contract_address || '-' || rpad(function_sig, 64, '0') || '-' || latest_block::VARCHAR
  || '","jsonrpc":"2.0","method":"eth_call","params":[{{"to":"' || contract_address
  || '","from":null,"data":"' || rpad(function_sig, 64, '0') || '"}},"0x' || lower(hex(latest_block)) || '"]}}'
  AS rpc_request
FROM base, sel""")
def q_top_unread(spark, sf):
    o = T(spark, sf, "orders")
    rel = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("total_event_count"),
        F.max(F.datediff(F.col("o_orderdate").cast("date"), F.lit(CH.BLOCK_ZERO).cast("date"))).cast("bigint")
        .alias("latest_event_block")).withColumn("contract_address", CH.addr(F.col("o_custkey")))
    done = T(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select(
        CH.addr(F.col("c_custkey")).alias("contract_address"))
    return CT.token_read_requests(rel, done, n=200, min_events=10).select(
        "contract_address", "latest_block", "function_sig", "input", "rpc_request")


@query("abi_metadata", """
SELECT p_partkey::VARCHAR AS contract_address, p_name AS token_name,
       CASE WHEN p_size * 3 < 100 THEN (p_size * 3)::INT END AS token_decimals, p_brand AS token_symbol
FROM part""")
def q_abi_metadata(spark, sf):
    p = T(spark, sf, "part")

    def abi_string(c):
        h = F.lower(F.hex(c))
        return F.concat(F.lit("0x"), F.lpad(F.lit("20"), 64, "0"), F.lpad(F.lower(F.hex(F.length(c))), 64, "0"),
                        F.rpad(h, ((F.length(h) + 63) / 64).cast("int") * 64, "0"))

    def reads(sig, result):
        call_id = F.concat_ws("-", F.col("p_partkey").cast("string"), F.rpad(F.lit(sig), 64, "0"), F.lit("1"))
        return p.select(F.struct(call_id.alias("id"), result.alias("result")).alias("r"))

    rows = (reads(CT.NAME_SIG, abi_string(F.col("p_name")))
            .unionByName(reads(CT.SYMBOL_SIG, abi_string(F.col("p_brand"))))
            .unionByName(reads(CT.DECIMALS_SIG, CH.word(F.col("p_size") * 3))))
    # 100 keys, 300 reads, to an answer
    responses = rows.groupBy(F.floor(F.split_part(F.col("r")["id"], F.lit("-"), F.lit(1)).cast("bigint") / 100)
                             .alias("batch")).agg(
        F.to_json(F.struct(F.collect_list("r").alias("data"))).alias("response"))
    got = CT.token_read_results(responses, CH.RUN_TS)
    meta = CT.contract_metadata(got, CH.RUN_TS)
    return meta.select("contract_address", "token_name", "token_decimals", "token_symbol")


@query("created_latest", f"""
WITH {TX_CTE}, {NODES_CTE},
c AS (SELECT n.to_address AS created_contract_address, n.block_number, t.tx_hash, n.from_address AS creator_address,
             n.input AS created_contract_input, t.block_timestamp
      FROM nodes n JOIN tx t ON t.o_orderkey = n.o_orderkey
      WHERE n.type ILIKE 'create%' AND n.to_address IS NOT NULL AND n.input IS NOT NULL AND n.input <> '0x'
        AND NOT n.path_error AND t.tx_succeeded)
SELECT created_contract_address, block_number, tx_hash, creator_address FROM c
QUALIFY row_number() OVER (PARTITION BY created_contract_address ORDER BY block_number DESC,
   block_timestamp DESC, tx_hash DESC, creator_address DESC, created_contract_input DESC) = 1""")
def q_created_latest(spark, sf):
    cc = CT.created_contracts(chain(spark, sf).gold("traces"), CH.RUN_TS)
    return cc.select("created_contract_address", "block_number", "tx_hash", "creator_address")


@query("contract_dim", f"""
WITH c0 AS (SELECT upper({addr('c_custkey')}) AS created_contract_address, c_custkey AS block_number,
                   c_name AS creator_address, TIMESTAMP '2024-01-03' + to_seconds(c_custkey) AS ts,
                   '0x' || md5(c_name) AS tx_hash FROM customer),
c1 AS (SELECT {addr('s_suppkey')} AS contract_address, s_name AS token_name, upper(s_name) AS token_symbol,
              s_nationkey::INT AS token_decimals, TIMESTAMP '2024-01-03' + to_seconds(s_suppkey * 2) AS ts FROM supplier)
SELECT lower(coalesce(created_contract_address, contract_address)) AS address, token_symbol AS symbol,
       token_name AS name, token_decimals AS decimals, block_number AS created_block_number,
       c0.ts AS created_block_timestamp, tx_hash AS created_tx_hash, creator_address,
       md5(lower(coalesce(created_contract_address, contract_address))) AS dim_contracts_id,
       greatest(coalesce(c0.ts, TIMESTAMP '2000-01-01'), coalesce(c1.ts, TIMESTAMP '2000-01-01')) AS inserted_timestamp,
       greatest(coalesce(c0.ts, TIMESTAMP '2000-01-01'), coalesce(c1.ts, TIMESTAMP '2000-01-01')) AS modified_timestamp
FROM c0 FULL OUTER JOIN c1 ON lower(created_contract_address) = lower(contract_address)""")
def q_contract_dim(spark, sf):
    def at(seconds):
        return F.timestamp_add("SECOND", seconds, LF.lit_ts(dt.datetime(2024, 1, 3)))
    c, s = T(spark, sf, "customer"), T(spark, sf, "supplier")
    t0, t1 = at(F.col("c_custkey")), at(F.col("s_suppkey") * 2)
    c0 = c.select(
        F.upper(CH.addr(F.col("c_custkey"))).alias("created_contract_address"), F.col("c_custkey").alias("block_number"),
        t0.alias("block_timestamp"), F.concat(F.lit("0x"), F.md5("c_name")).alias("tx_hash"),
        F.col("c_name").alias("creator_address"), t0.alias("inserted_timestamp"), t0.alias("modified_timestamp"))
    c1 = s.select(
        CH.addr(F.col("s_suppkey")).alias("contract_address"), F.upper("s_name").alias("token_symbol"),
        F.col("s_name").alias("token_name"), F.col("s_nationkey").cast("int").alias("token_decimals"),
        t1.alias("inserted_timestamp"), t1.alias("modified_timestamp"))
    return CT.dim_contracts(c0, c1)


# ----------------------------------------------------------------- Q1-Q14
@query("check_not_null", """
SELECT o_orderkey FROM orders WHERE o_orderpriority <> '5-LOW' AND
  (CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END) IS NULL""")
def q_check_not_null(spark, sf):
    o = T(spark, sf, "orders").withColumn(
        "st", F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderstatus")))
    return CK.not_null(o, "st", where=F.col("o_orderpriority") != "5-LOW").select("o_orderkey")


@query("check_unique", """
SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n_records FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_check_unique(spark, sf):
    return CK.unique_on(T(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", F.col("n_records").cast("bigint"))


@query("check_matches", """
SELECT event_id, props FROM events WHERE NOT regexp_matches(props, '"k": [0-9]{2}') AND event_type <> 'view'""")
def q_check_matches(spark, sf):
    return CK.matches(T(spark, sf, "events"), "props", '"k": [0-9]{2}', where=F.col("event_type") != "view") \
        .select("event_id", "props")


@query("check_gaps", """
WITH v AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem),
p AS (SELECT l_orderkey, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS prev,
             l_linenumber FROM v)
SELECT l_orderkey, prev AS l_linenumber_previous, l_linenumber, (l_linenumber - prev - 1)::BIGINT AS gap
FROM p WHERE l_linenumber - prev > 1""")
def q_check_gaps(spark, sf):
    g = CK.sequence_gaps(T(spark, sf, "lineitem"), "l_linenumber", ["l_orderkey"])
    return g.select("l_orderkey", "l_linenumber_previous", "l_linenumber", F.col("gap").cast("bigint"))


@query("check_gaps_global", """
WITH v AS (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus = 'F'),
p AS (SELECT lag(o_orderkey) OVER (ORDER BY o_orderkey) AS prev, o_orderkey FROM v)
SELECT prev AS o_orderkey_previous, o_orderkey, (o_orderkey - prev - 1)::BIGINT AS gap
FROM p WHERE o_orderkey - prev > 1""")
def q_check_gaps_global(spark, sf):
    g = CK.sequence_gaps(T(spark, sf, "orders"), "o_orderkey", where=F.col("o_orderstatus") == "F")
    return g.select("o_orderkey_previous", "o_orderkey", F.col("gap").cast("bigint"))


@query("check_counts_match", """
WITH got AS (SELECT l_orderkey, count(*) AS actual FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS l_orderkey, 4 AS expected, coalesce(actual, 0)::BIGINT AS actual
FROM orders LEFT JOIN got ON got.l_orderkey = o_orderkey WHERE coalesce(actual, 0) <> 4""")
def q_check_counts_match(spark, sf):
    parents = T(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(4).alias("n"))
    r = CK.counts_match(T(spark, sf, "lineitem"), parents, "l_orderkey", "n")
    return r.select("l_orderkey", F.col("expected").cast("int"),
                    F.coalesce(F.col("actual"), F.lit(0)).cast("bigint").alias("actual"))


@query("check_orphans", """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def q_check_orphans(spark, sf):
    parents = T(spark, sf, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return CK.orphans(T(spark, sf, "lineitem"), parents, "l_orderkey").select("l_orderkey", "l_linenumber")


@query("check_childless", """
SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def q_check_childless(spark, sf):
    parents = T(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return CK.childless(parents, T(spark, sf, "lineitem"), "l_orderkey").select(
        F.col("l_orderkey").alias("o_orderkey"))


@query("check_one_parent", """
SELECT l_partkey, count(DISTINCT l_suppkey)::BIGINT AS n_parents FROM lineitem
GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1""")
def q_check_one_parent(spark, sf):
    return CK.one_parent(T(spark, sf, "lineitem"), "l_partkey", "l_suppkey").select(
        "l_partkey", F.col("n_parents").cast("bigint"))


@query("check_freshness", """
SELECT max(ts) AS newest FROM events HAVING max(ts) < TIMESTAMP '2030-01-01 00:00:00' - INTERVAL 2 HOUR""")
def q_check_freshness(spark, sf):
    ev = T(spark, sf, "events")
    stale = CK.fresh(ev, "ts", dt.datetime(2030, 1, 1), dt.timedelta(hours=2))
    newest = INC.high_water(ev, "ts")
    return stale.unionByName(CK.fresh(ev, "ts", newest + dt.timedelta(hours=1), dt.timedelta(hours=2)))


def _faulty(c):
    """The facts with seeded faults: a lost block, transactions delivered twice, a broken hash, a cut call tree."""
    b, t, e, n = (c.gold(x) for x in ("blocks", "transactions", "event_logs", "traces"))
    b = b.where("block_number <> 10").withColumn("block_hash", F.when(F.col("block_number") % 7 == 0, "0x1").otherwise(F.col("block_hash")))
    t = t.unionByName(t.where("block_number = 12"))
    e = e.withColumn("contract_address", F.when(F.col("event_index") == 3, "0x").otherwise(F.col("contract_address")))
    n = n.where("not (trace_index = 1 and block_number % 3 = 0)").where("block_number <> 20")
    return {"blocks": b, "transactions": t, "event_logs": e, "traces": n}


_SUITE_SQL = """
WITH {tx}, {lines}, {nodes},
b AS (SELECT block_number, count(*) AS n FROM tx WHERE block_number > {after} AND block_number <> 10 GROUP BY 1),
t AS (SELECT * FROM tx WHERE block_number > {after} UNION ALL SELECT * FROM tx WHERE block_number = 12 AND 12 > {after}),
n AS (SELECT * FROM nodes WHERE block_number > {after} AND NOT (trace_index = 1 AND block_number % 3 = 0) AND block_number <> 20),
f(tbl, chk, failures, allowed) AS (
  SELECT 'blocks', 'unique', 0, 0
  UNION ALL SELECT 'blocks', 'gaps', (SELECT count(*) FROM (SELECT block_number - lag(block_number) OVER (ORDER BY block_number) AS d FROM b) WHERE d > 1), {allowed}
  UNION ALL SELECT 'blocks', 'transactions as declared', (SELECT count(*) FROM b FULL JOIN (SELECT block_number, count(*) AS m FROM t GROUP BY 1) x USING (block_number) WHERE coalesce(n, 0) <> coalesce(m, 0)), 0
  UNION ALL SELECT 'blocks', unnest(['not null block_number', 'not null block_timestamp', 'not null block_hash', 'type block_number',
    'type tx_count', 'type size', 'type gas_used', 'type block_timestamp']), 0, 0
  UNION ALL SELECT 'blocks', 'matches block_hash', (SELECT count(*) FROM b WHERE block_number % 7 = 0), 0
  UNION ALL SELECT 'transactions', 'unique', (SELECT count(*) FROM tx WHERE block_number = 12 AND 12 > {after}), 0
  UNION ALL SELECT 'transactions', 'gaps', 0, {allowed}
  UNION ALL SELECT 'transactions', 'block missing', (SELECT count(*) FROM tx WHERE block_number = 10 AND 10 > {after}), 0
  UNION ALL SELECT 'transactions', unnest(['not null tx_hash', 'not null from_address', 'not null block_timestamp', 'matches from_address']), 0, 0
  UNION ALL SELECT 'event_logs', unnest(['unique', 'one transaction']), 0, 0
  UNION ALL SELECT 'event_logs', 'gaps', 0, {allowed}
  UNION ALL SELECT 'event_logs', 'matches contract_address', (SELECT count(*) FROM lines WHERE log_index = 3 AND block_number > {after}), 0
  UNION ALL SELECT 'traces', 'unique', 0, 0
  UNION ALL SELECT 'traces', 'gaps', (SELECT count(*) FROM (SELECT trace_index - lag(trace_index) OVER (PARTITION BY block_number, tx_position ORDER BY trace_index) AS d FROM n) WHERE d > 1), {allowed}
  UNION ALL SELECT 'traces', 'transactions without traces', (SELECT count(*) FROM t WHERE block_number = 20), 0
  UNION ALL SELECT 'traces', 'not null type', 0, 0
  UNION ALL SELECT 'blocks', 'fresh', 1, 0)
SELECT tbl AS "table", chk AS "check", failures::BIGINT AS failures, CASE WHEN failures > allowed THEN 'error' ELSE 'pass' END AS status FROM f"""


@query("check_suite_full", _SUITE_SQL.format(tx=TX_CTE, lines=LINES_CTE, nodes=NODES_CTE, after=-1, allowed=0))
def q_check_suite_full(spark, sf):
    return SU.run_suite(spark, _faulty(chain(spark, sf)), SU.fact_suite(now=dt.datetime(2030, 1, 1)))


@query("check_suite_recent", _SUITE_SQL.format(tx=TX_CTE, lines=LINES_CTE, nodes=NODES_CTE, after=8, allowed=10))
def q_check_suite_recent(spark, sf):
    tables = SU.scoped(_faulty(chain(spark, sf)), "recent", 8)
    return SU.run_suite(spark, tables, SU.fact_suite(recent=True, now=dt.datetime(2030, 1, 1)))


# ------------------------------------------- set operations and small shapes
@query("union_distinct", """
SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier UNION SELECT n_nationkey FROM nation""")
def q_union_distinct(spark, sf):
    return SO.union_distinct(*[T(spark, sf, t).select(F.col(c).alias("nation")) for t, c in (
        ("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey"))])


@query("spine_counts", """
SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus IN ('F', 'O'))::BIGINT AS settled,
       (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS open_price
FROM customer""")
def q_spine_counts(spark, sf):
    o = T(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    settled = o.where(SO.in_list("o_orderstatus", ["F", "O"])).groupBy("c_custkey").agg(F.count(F.lit(1)).alias("settled"))
    price = o.where("o_orderstatus = 'P'").groupBy("c_custkey").agg(F.max("o_totalprice").alias("open_price"))
    out = SO.spine_join(T(spark, sf, "customer"), [settled, price], "c_custkey")
    return out.select("c_custkey", F.coalesce("settled", F.lit(0)).cast("bigint").alias("settled"), "open_price")


@query("reemit_groups", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1)""")
def q_reemit_groups(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    hit = li.where(SO.in_list("l_returnflag", ["R"]) & (F.col("l_linenumber") == 1)).select("l_orderkey").distinct()
    return SO.reemit_groups(li.drop("l_returnflag"), hit, "l_orderkey")


@query("outer_on_lower", f"""
SELECT upper({addr('c_custkey')}) AS a, {addr('s_suppkey')} AS b FROM customer FULL JOIN supplier ON c_custkey = s_suppkey""")
def q_outer_on_lower(spark, sf):
    a = T(spark, sf, "customer").select(F.upper(CH.addr(F.col("c_custkey"))).alias("a"))
    b = T(spark, sf, "supplier").select(CH.addr(F.col("s_suppkey")).alias("b"))
    return SO.full_outer_norm(a, b, "a", "b")


@query("previous_event", """
SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM events""")
def q_previous_event(spark, sf):
    return with_lag(T(spark, sf, "events").select("user_id", "event_id"), ["user_id"], "event_id", "previous")


@query("batch_columns", """
WITH n AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS row_num FROM orders)
SELECT *, ceil(row_num / 100)::BIGINT AS batch_number, ((row_num - 1) % 100 + 1)::BIGINT AS row_within_batch FROM n""")
def q_batch_columns(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return BL.with_batch_columns(number_within(o, ["o_orderstatus"], ["o_orderkey asc"]), "row_num")


@query("unused_numbers", """
SELECT r.range AS number, r.range < 700 AS history FROM range((SELECT max(o_orderkey) + 1 FROM orders)) r
WHERE r.range NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def q_unused_numbers(spark, sf):
    """A generated spine less the keys in use, split at a boundary and put together again."""
    o = T(spark, sf, "orders")
    n = BL.number_spine(spark, o.agg(F.max("o_orderkey")).first()[0] + 1).withColumnRenamed("_id", "number")
    left = BL.missing_keys(n, o.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("number")), ["number"])
    recent, history = BL.split_backlog(left, 700, "number")
    return SO.union_all(recent.withColumn("history", F.lit(False)), history.withColumn("history", F.lit(True)))


@query("largest_line", """
SELECT l_orderkey, max(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY l_orderkey""")
def q_largest_line(spark, sf):
    li = T(spark, sf, "lineitem")
    best = top_per_key(li, ["l_orderkey"], "l_extendedprice", ["l_extendedprice"])
    return best.select("l_orderkey", "l_extendedprice")


@query("topic_positions", f"""
WITH {TX_CTE}, {LINES_CTE}
SELECT tx_hash, log_index AS event_index, unnest([0, 1, 2])::BIGINT AS position,
       unnest(['0x' || md5(l_returnflag), {word('l_partkey')}, {word('l_linenumber')}]) AS topic FROM lines
UNION ALL SELECT tx_hash, log_index, 3, '0x' || md5(l_linestatus) FROM lines WHERE l_linestatus = 'O'""")
def q_topic_positions(spark, sf):
    logs = chain(spark, sf).gold("event_logs").select("tx_hash", "event_index", "topics")
    t = posexplode_json(logs, "topics", "$", keep=["tx_hash", "event_index"])
    return t.select("tx_hash", F.col("event_index").cast("bigint"), F.col(t.columns[-2]).cast("bigint").alias("position"),
                    LF.jget(t.columns[-1], "$").alias("topic"))


@query("heal_prices", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders""")
def q_heal_prices(spark, sf):
    """Rows whose price was missing, refilled and put in place of the incomplete ones; new rows beside them."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    target = o.where("o_orderkey % 4 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))
    healed = INC.heal(target, F.col("o_totalprice").isNull(), lambda rows: lookup(
        rows.drop("o_totalprice"), o, ["o_orderkey"], ["o_totalprice"]))
    new = o.where("o_orderkey % 4 = 0").union(target.where("o_totalprice is null"))
    batch = INC.union_new_and_healed(new, healed.select(*o.columns), ["o_orderkey"], ["o_totalprice desc nulls last"])
    return SK.upsert(target, batch, "o_orderkey")


@query("stream_dedupe", """
SELECT event_id, user_id, ts FROM events""")
def q_stream_dedupe(spark, sf):
    """Events delivered twice, kept once (watermark and state)."""
    from ..streaming import dedupe_stream, read_stream, work_dir
    base = work_dir(spark, "stream_dedupe")
    ev = T(spark, sf, "events").select("event_id", "user_id", "ts")
    ev = ev.withColumn("at", F.col("ts").cast("timestamp"))
    ev.union(ev.where("event_id % 3 = 0")).write.parquet(f"{base}/in")
    s = dedupe_stream(read_stream(spark, f"{base}/in", ev.schema), ["event_id"], "at")
    q = (s.writeStream.format("parquet").option("checkpointLocation", f"{base}/_checkpoint").option("path", f"{base}/out")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(ev.schema).parquet(f"{base}/out").select("event_id", "user_id", "ts")


# ------------------------------------------------------------- streaming
def _event_files(spark, sf, base: str) -> tuple[str, list]:
    """Two deliveries of the events: before and from SPLIT_TS, the second with the first's purchases again."""
    ev = T(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    old = ev.where(F.col("ts") < LF.lit_ts(SPLIT_TS))
    new = ev.where(F.col("ts") >= LF.lit_ts(SPLIT_TS)).unionByName(old.where("event_type = 'purchase'"))
    return f"{base}/in", [lambda: old.write.mode("append").parquet(f"{base}/in"),
                          lambda: new.write.mode("append").parquet(f"{base}/in")]


@query("stream_upsert", """
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_stream_upsert(spark, sf):
    """Two deliveries, each read by a run of its own, then a run without news: the table goes on."""
    from ..streaming import read_stream, upsert_stream, work_dir
    base = work_dir(spark, "stream_upsert")
    path, deliveries = _event_files(spark, sf, base)
    schema = T(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value").schema
    for deliver in [*deliveries, lambda: None]:
        deliver()
        s = read_stream(spark, path, schema)
        out = upsert_stream(s, f"{base}/table", ["user_id"], ["ts desc", "event_id desc"], f"{base}/_checkpoint")
    return out


@query("stream_counters", """
SELECT user_id, (count(*) + count(*) FILTER (event_type = 'purchase' AND ts < TIMESTAMP '2024-01-15'))::BIGINT AS n_events,
       max(ts) AS last_ts FROM events GROUP BY user_id""")
def q_stream_counters(spark, sf):
    """Running totals over two runs; rows delivered twice count twice, as the reference's counters do."""
    from ..streaming import counters_stream, read_stream, work_dir
    base = work_dir(spark, "stream_counters")
    path, deliveries = _event_files(spark, sf, base)
    schema = T(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value").schema
    for deliver in [*deliveries, lambda: None]:
        deliver()
        out = counters_stream(read_stream(spark, path, schema), "user_id",
                              {"n_events": F.count(F.lit(1)), "last_ts": F.max("ts")}, f"{base}/_checkpoint", f"{base}/table")
    return out.select("user_id", F.col("n_events").cast("bigint"), "last_ts")


# the queries over stored tables and ingestion register themselves
from . import ingestion, tables  # noqa: E402, F401
