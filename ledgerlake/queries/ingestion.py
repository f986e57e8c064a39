"""Queries over raw files, streams, ledgers and backlogs, derived from the driver tables."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import functions as LF
from ..functions.keys import path_partition_key
from ..functions.sqlreg import register_sql_functions
from ..operators import backlog as BL
from ..operators import intervals as IV
from ..operators import setops as SO
from ..operators.tree import flatten_tree
from ..plans import ingest as IN
from ..session import path_exists, store
from ..sources import read_raw, registered_files
from ..sources.seed import Catalog, read_seed
from ..streaming import heal_stream, ingest_stream, read_stream, work_dir
from . import chain as CH
from .registry import T, chain, query
from .sqlparts import TX_CTE


def _order_lines(spark, sf):
    """A raw record per order: answered (F), failed (O) or cut short (P); no partition key in the record."""
    key = F.col("o_orderkey").cast("string")
    head = F.concat(F.lit('{"value":{"BLOCK_NUMBER":'), key, F.lit('},"metadata":null,"data":'))
    return T(spark, sf, "orders").select(
        "o_orderkey", F.floor(F.col("o_orderkey") / 1000).alias("k"),
        F.when(F.col("o_orderstatus") == "F", F.concat(head, F.lit('{"result":{"custkey":'), F.col("o_custkey").cast("string"), F.lit("}}}")))
        .when(F.col("o_orderstatus") == "O", F.concat(head, F.lit('{"error":{"code":'), key, F.lit("}}}"))).otherwise(F.concat(F.lit("cut "), head)).alias("line"))


def _write(lines, path):
    """Files of 128,000 order keys each, from thousands that are all even or all odd."""
    k = F.floor(F.col("k") / 256) * 2 + F.pmod("k", F.lit(2))
    lines.select(k.alias("k"), "line").repartition("k").write.partitionBy("k").mode("append").text(path)


@query("raw_registered", """
SELECT o_orderkey, 'read' AS found FROM orders WHERE o_orderstatus = 'F' AND (o_orderkey // 1000) % 2 = 0
UNION ALL SELECT -1, 'missing'""")
def q_raw_registered(spark, sf):
    """Half of the files registered, and one that does not exist: only the registered half is opened, the lost one reported."""
    path = work_dir(spark, "raw") + "/blocks"
    _write(_order_lines(spark, sf), path)
    files = spark.read.text(path).select(F.col("_metadata.file_path").alias("file_name"), "k").distinct()
    stamp = LF.lit_ts(dt.datetime(2024, 1, 1)).alias("_inserted_timestamp")
    manifest = files.where("k % 2 = 0").select("file_name", stamp).union(spark.range(1).select(F.lit("k=0/gone.json"), stamp))
    got = read_raw(spark, path, "blocks", manifest=manifest)
    lost = registered_files(spark, path, manifest).where("not present")
    return (got.where(F.col("_inserted_timestamp") == LF.lit_ts(dt.datetime(2024, 1, 1)))
            .select(F.col("block_number").cast("bigint").alias("o_orderkey"), F.lit("read").alias("found"))
            .union(lost.select(F.lit(-1).cast("bigint"), F.lit("missing"))))


@query("raw_recent", """
SELECT o_orderkey, o_orderkey // 1000 * 1000 AS partition_key FROM orders WHERE o_orderstatus = 'F' AND (o_orderkey // 1000) % 3 <> 0""")
def q_raw_recent(spark, sf):
    """Files modified within three days only; failed records dropped, keys resolved, the partition key from the path."""
    path = work_dir(spark, "raw") + "/confirm_blocks"
    lines = _order_lines(spark, sf).withColumn("folder", F.concat((F.col("k") * 1000).cast("string"), F.lit("_1")))
    lines.select("folder", "line").repartition("folder").write.partitionBy("folder").text(path)
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    now = dt.datetime.now(dt.timezone.utc)
    for s in fs.listStatus(root):  # every third folder is made four days old
        name = s.getPath().getName()
        if name.startswith("folder=") and int(name[7:].split("_")[0]) // 1000 % 3 == 0:
            for f in fs.listStatus(s.getPath()):
                old = int((now - dt.timedelta(days=4)).timestamp() * 1000)
                fs.setTimes(f.getPath(), old, old)
    got = read_raw(spark, path, "confirm_blocks", since=dt.timedelta(days=3))
    folder = F.regexp_replace("file_name", "folder=", "")
    return got.select(F.col("block_number").cast("bigint").alias("o_orderkey"), path_partition_key(folder, -2).cast("bigint").alias("partition_key"))


@query("stream_raw", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'kept' WHEN 'O' THEN 'failed' ELSE 'unreadable' END AS fate FROM orders""")
def q_stream_raw(spark, sf):
    """Raw confirm_blocks files as a stream: two deliveries with broken lines, a run of its own for each and one without news."""
    base = work_dir(spark, "stream-raw")
    lines = _order_lines(spark, sf)
    for part in (lines.where("o_orderkey % 2 = 0"), lines.where("o_orderkey % 2 = 1"), None):
        if part is not None:
            _write(part, f"{base}/in")
        good, bad = ingest_stream(spark, f"{base}/in", "confirm_blocks", f"{base}/bronze", f"{base}/quarantine", f"{base}/_checkpoint")
    number = F.regexp_extract("value", '"BLOCK_NUMBER":([0-9]+)', 1).cast("bigint")
    return good.select(F.col("block_number").cast("bigint").alias("o_orderkey"), F.lit("kept").alias("fate")).union(bad.select(number, "reason"))


@query("heal_stream", """
SELECT o_orderkey, o_orderkey // 20 AS block_number, o_totalprice,
       CASE WHEN (o_orderkey // 20) % 7 <> 3 THEN 788918400 + 12 * (o_orderkey // 20) END AS epoch, (o_orderkey // 20) % 7 <> 3 AS complete FROM orders""")
def q_heal_stream(spark, sf):
    """Orders as rows, blocks as parents: every second block comes a run late, every seventh never; then a run without news."""
    base = work_dir(spark, "heal-stream")
    o = T(spark, sf, "orders").select("o_orderkey", F.floor(F.col("o_orderkey") / 20).alias("block_number"), "o_totalprice")
    blocks = o.select("block_number").distinct().where("block_number % 7 <> 3").withColumn("epoch", F.lit(CH.ZERO_EPOCH) + 12 * F.col("block_number"))
    deliveries = [(o.where("o_orderkey % 10 <> 1"), blocks.where("block_number % 2 = 0")), (o.where("o_orderkey % 10 = 1"), blocks.where("block_number % 2 = 1"))]
    for delivery in [*deliveries, None]:
        for name, part in zip(("rows", "blocks"), delivery or ()):
            part.write.mode("append").parquet(f"{base}/{name}")
        rows, parents = read_stream(spark, f"{base}/rows", o.schema), read_stream(spark, f"{base}/blocks", blocks.schema)
        out = heal_stream(rows, parents, "block_number", ["o_orderkey"], f"{base}/_checkpoint", f"{base}/table")
    return out.select("o_orderkey", "block_number", "o_totalprice", "epoch", "complete")


# ------------------------------------------------------------------ backlogs with their caps
_REQUEST = """'{{"id":' || {n}::VARCHAR || ',"jsonrpc":"2.0","method":"{m}","params":[{p}]}}'"""


def _request(n, method, params):
    return _REQUEST.format(n=n, m=method, p=params)


def _spine(spark, sf, table="orders", col="o_orderkey"):
    return T(spark, sf, table).select(F.col(col).alias("block_number"))


@query("blocks_realtime", f"""
SELECT o_orderkey AS block_number, round(o_orderkey, -3)::BIGINT AS partition_key,
       {_request('o_orderkey', 'eth_getBlockByNumber', '''"0x' || lower(hex(o_orderkey)) || '",true''')} AS request
FROM (SELECT o_orderkey FROM orders WHERE o_orderkey >= 500
      EXCEPT (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O' INTERSECT SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F'))
ORDER BY round(o_orderkey, -3) DESC, o_orderkey DESC LIMIT 300""")
def q_blocks_realtime(spark, sf):
    """The 300 newest blocks that lack blocks or transactions (L1, realtime form)."""
    li = T(spark, sf, "lineitem")
    done = [li.where(F.col("l_linestatus") == s).select(F.col("l_orderkey").alias("block_number")).distinct() for s in ("O", "F")]
    return IN.blocks_transactions_backlog(_spine(spark, sf), *done, since_block=500, cap=300)


@query("traces_realtime", f"""
SELECT o_orderkey AS block_number, round(o_orderkey, -3)::BIGINT AS partition_key,
       {_request('o_orderkey', 'debug_traceBlockByNumber', '''"0x' || lower(hex(o_orderkey)) || '",{"tracer":"callTracer","timeout":"120s"}''')} AS request
FROM (SELECT o_orderkey FROM orders WHERE o_orderkey >= 700 EXCEPT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
ORDER BY round(o_orderkey, -3) DESC, o_orderkey DESC LIMIT 200""")
def q_traces_realtime(spark, sf):
    done = T(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("block_number"))
    return IN.traces_backlog(_spine(spark, sf), done, since_block=700, cap=200)


@query("receipts_realtime", f"""
WITH {TX_CTE}
SELECT block_number, tx_hash, round(block_number, -3)::BIGINT AS partition_key,
       {_request('block_number', 'eth_getTransactionReceipt', '''"' || tx_hash || '"''')} AS request
FROM tx WHERE block_number >= 5 AND NOT coalesce(tx_succeeded, false)
ORDER BY round(block_number, -3) DESC, block_number DESC, tx_hash DESC LIMIT 400""")
def q_receipts_realtime(spark, sf):
    """The 400 newest (block, hash) pairs without a receipt (L2, realtime form)."""
    c = chain(spark, sf)
    done = c.gold("transactions").where("tx_succeeded").select("block_number", "tx_hash")
    out = IN.receipts_backlog(IN.receipts_todo(c.silver("blocks")), done, since_block=5, cap=400)
    return out.select(F.col("block_number").cast("bigint"), "tx_hash", "partition_key", "request")


@query("any_backlog", """
SELECT least(250, count(*))::BIGINT AS n, true AS all_missing FROM (SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def q_any_backlog(spark, sf):
    """A cap without an order (L3): any 250 missing keys will do, but they must be missing."""
    done = T(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("block_number"))
    some = BL.newest(BL.missing_keys(_spine(spark, sf), done, ["block_number"]), [], 250).checkpoint()
    wrong = some.join(done, "block_number", "left_semi").count()
    return some.agg(F.count(F.lit(1)).alias("n")).withColumn("all_missing", F.lit(wrong == 0))


@query("ledger_gaps", """
WITH m AS (SELECT max(o_orderkey) AS top FROM orders)
SELECT r.range AS block_number FROM range((SELECT top + 1 FROM m)) r WHERE r.range NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
UNION ALL SELECT 999999999""")
def q_ledger_gaps(spark, sf):
    """A spine of a billion blocks less a ledger kept as runs: only the gaps become rows."""
    o = T(spark, sf, "orders").where("o_orderstatus <> 'P'")
    top = T(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0]
    ledger = IV.merge_runs(IV.number_runs(o, "o_orderkey").union(IV.one_run(spark, top + 1, 10 ** 9 - 2)))
    return IV.ledger_backlog(IV.one_run(spark, 0, 10 ** 9 - 1), ledger, None)


@query("newest_gaps", """
SELECT r.range AS block_number FROM range((SELECT max(o_orderkey) + 1 FROM orders)) r
WHERE r.range NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') ORDER BY 1 DESC LIMIT 321""")
def q_newest_gaps(spark, sf):
    """The 321 newest numbers a ledger of runs lacks (L1)."""
    o = T(spark, sf, "orders")
    top = o.agg(F.max("o_orderkey")).first()[0]
    return IV.ledger_backlog(IV.one_run(spark, 0, top), IV.number_runs(o.where("o_orderstatus <> 'P'"), "o_orderkey"), 321)


@query("head_spine", """
SELECT r.range AS block_number, '0x' || lower(hex(r.range)) AS block_number_hex FROM range((SELECT max(o_orderkey) - 50 + 1 FROM orders)) r""")
def q_head_spine(spark, sf):
    """The chain head from hexadecimal answers (T10), and the blocks up to it less the delay."""
    answers = T(spark, sf, "orders").select(LF.int_to_hex("o_orderkey").alias("result"))
    return BL.block_spine(spark, BL.chain_head(answers))


# ------------------------------------------------------------------ small shapes nothing else reached
@query("sql_functions", """
SELECT o_orderkey, o_orderkey::VARCHAR AS back, '0x' || lower(hex(o_orderkey)) AS hex_key, md5(o_orderkey::VARCHAR || '-' || o_orderstatus) AS id,
       CASE WHEN o_orderstatus = 'F' THEN true WHEN o_orderstatus = 'O' THEN false END AS ok,
       rtrim(rtrim(printf('%.2f', o_orderkey / 100.0), '0'), '.') AS shifted FROM orders""")
def q_sql_functions(spark, sf):
    """The column functions by their SQL names."""
    register_sql_functions(spark)
    o = T(spark, sf, "orders")
    return spark.sql("""
        SELECT o_orderkey, hex_to_int(int_to_hex(o_orderkey)) AS back, int_to_hex(o_orderkey) AS hex_key,
               surrogate_key2(CAST(o_orderkey AS STRING), o_orderstatus) AS id,
               status_bool(CASE o_orderstatus WHEN 'F' THEN '0x1' WHEN 'O' THEN '0x0' END) AS ok,
               decimal_adjust_2(CAST(o_orderkey AS STRING)) AS shifted
        FROM {orders}""", orders=o)


@query("failed_nodes", """
SELECT l_orderkey, l_linenumber, n_lines - 1 AS n_kept FROM (
  SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey) AS n_lines,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem) WHERE i = 1""")
def q_failed_nodes(spark, sf):
    """Nodes with a `failed` field (F10) have no position and are no one's child: one such call a tree."""
    li = T(spark, sf, "lineitem")
    per = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("a"))
    call = F.transform("a", lambda x, i: F.concat(F.lit('{"line":'), x["l_linenumber"].cast("string"), F.when(i == 0, ',"failed":null').otherwise(""), F.lit("}")))
    doc = F.parse_json(F.concat(F.lit('{"calls":['), F.array_join(call, ","), F.lit("]}")))
    n = flatten_tree(per.select("l_orderkey", doc.alias("doc")), "doc", ["l_orderkey"], skip_field="failed")
    # read twice below, opened once
    n = store(n.select("l_orderkey", "depth", "trace_index", "sub_traces", LF.jget("node", "$.line", "int").alias("l_linenumber"))
              .where("depth = 0 or trace_index is null"), "nodes")
    root = n.where("depth = 0").select("l_orderkey", F.col("sub_traces").cast("bigint").alias("n_kept"))
    return n.where("trace_index is null").select("l_orderkey", "l_linenumber").join(root, "l_orderkey")


@query("seed_schedules", """
SELECT n_name AS workflow_name, CASE WHEN n_regionkey > 0 THEN n_regionkey::VARCHAR || ' * * * *' END AS workflow_schedule, c.n AS n_customers
FROM nation JOIN (SELECT c_nationkey, count(*)::BIGINT AS n FROM customer GROUP BY 1) c ON c_nationkey = n_nationkey""")
def q_seed_schedules(spark, sf):
    """A seed file with empty values (S10) joined to a declared source."""
    path = work_dir(spark, "seed")
    n = T(spark, sf, "nation")
    n.select(F.col("n_name").alias("workflow_name"), F.when(F.col("n_regionkey") > 0, F.concat(F.col("n_regionkey").cast("string"), F.lit(" * * * *")))
             .alias("workflow_schedule")).write.option("header", True).csv(path)
    catalog = Catalog(spark)
    catalog.register("declared_customers", f"{sf}/customer.parquet")
    per = catalog.table("declared_customers").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_customers"))
    keys = n.select("n_nationkey", F.col("n_name").alias("workflow_name"))
    return (read_seed(spark, path).join(keys, "workflow_name").join(per, F.col("n_nationkey") == F.col("c_nationkey"))
            .select("workflow_name", "workflow_schedule", "n_customers"))


@query("split_texts", """
SELECT c_custkey, string_split(c_name, '#')[1] AS first, len(string_split(c_name, '#'))::INT AS n_parts, instr(c_name, '#')::INT AS at, substr(c_name, instr(c_name, '#') + 1) AS number FROM customer""")
def q_split_texts(spark, sf):
    """Text to an array and the place of a mark in it."""
    at = F.instr("c_name", "#")
    parts = F.split("c_name", "#")
    return T(spark, sf, "customer").select("c_custkey", parts[0].alias("first"), F.size(parts).alias("n_parts"), at.alias("at"),
                                           F.substring(F.col("c_name"), at + 1, F.length("c_name")).alias("number"))


@query("guarded_batches", """
SELECT o_orderstatus, count(*)::BIGINT AS n FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY 1""")
def q_guarded_batches(spark, sf):
    """Work for the batches that have rows only (F7): the empty one writes no folder."""
    path, o = work_dir(spark, "guard"), T(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    for s in ("F", "none", "P"):
        SO.run_if_any(o.where(F.col("o_orderstatus") == s), lambda batch, s=s: batch.write.parquet(f"{path}/{s}"))
    there = [s for s in ("F", "none", "P") if path_exists(spark, f"{path}/{s}")]
    return spark.read.parquet(*[f"{path}/{s}" for s in there]).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("object_totals", """
SELECT o_custkey, json_group_object(o_orderstatus, n) AS totals FROM (
  SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2 ORDER BY 1, 2) GROUP BY o_custkey""")
def q_object_totals(spark, sf):
    """Keys to values as one object per group (A5), in the order of the keys."""
    per = T(spark, sf, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.array_sort(F.collect_list(F.struct("o_orderstatus", "n")))  # three statuses a customer
    return per.groupBy("o_custkey").agg(F.to_json(F.map_from_entries(pairs)).alias("totals"))
