"""Chain-shaped raw records derived from the driver's order tables.

The driver tables are not blockchain data, so this module turns them into the
*shape* the models consume, entirely with Spark (whole tables, no sampling):

  20 order keys -> block (number = key // 20, one every 12 seconds)
  order         -> transaction (position = rank of the order key in its block),
                   receipt (status from the order status, one log per line item)
                   and call trace (root -> one call per supplier -> one call per line)

A block holds at most 20 orders at any scale. The documents are written as JSON-line
files, an early delivery with damaged payloads for every third block and then the right
one, and the models read them back through the raw reader; so every model has to pick the
latest delivery. `sqlparts.py` restates the derivation in SQL, which is how the results
are checked. Fixed values below are the contract between the two sides.
"""
from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, remove_path, shuffles_removed, store
from ..sources.raw import read_raw

# Fixed values of the derivation (shared with sqlparts.py).
BLOCK_ZERO = "1995-01-01"
ZERO_EPOCH = 788_918_400  # seconds of that day
BLOCK_ORDERS = 20
BLOCK_SECONDS = 12
RUN_TS = dt.datetime(2024, 2, 1, 0, 0, 0)
FILE_RECORDS = 100_000  # records in a raw file: gzip files are not split, so this bounds a reading task
BLOCK_ROOTS = ["sha3Uncles", "receiptsRoot", "stateRoot", "transactionsRoot"]
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus", "l_shipdate"]

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate", "n_lines",
              "block_number", "tx_position"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hx(c: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(c)))


def addr(c: Column) -> Column:
    return F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(c)), 40, "0"))


def word(c: Column) -> Column:
    return F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(c)), 64, "0"))


def cents(c: Column) -> Column:
    return F.round(c * F.lit(100)).cast("bigint")


def orders_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its block and transaction fields."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    o = o.join(li, o["o_orderkey"] == li["l_orderkey"], "left").drop("l_orderkey")
    o = o.withColumn("n_lines", F.coalesce("n_lines", F.lit(0)).cast("bigint"))
    blk = F.floor(F.col("o_orderkey") / BLOCK_ORDERS).cast("bigint")
    o = o.withColumn("block_number", blk)
    pos = F.row_number().over(Window.partitionBy("block_number").orderBy("o_orderkey")) - 1
    return with_texts(o.withColumn("tx_position", pos.cast("bigint")))


def with_texts(o: DataFrame, *more: str) -> DataFrame:
    """The transaction fields of orders that know their place, and the columns `more`. Texts are made after a
    shuffle, not before it: they are several times as long as what they are made of."""
    return o.select(
        *ORDER_COLS, *more,
        (F.lit(ZERO_EPOCH) + F.col("block_number") * BLOCK_SECONDS).alias("epoch"),
        F.concat(F.lit("0x"), F.md5(F.col("o_orderkey").cast("string"))).alias("tx_hash"),
        addr(F.col("o_custkey")).alias("from_addr"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
        .otherwise(addr(F.col("o_custkey") + F.lit(1000000))).alias("to_addr"),
        F.concat(hx(cents(F.col("o_totalprice"))), F.lit("0" * 16)).alias("value_hex"),
        hx(F.lit(21000) + F.lit(1000) * F.pmod("o_custkey", F.lit(100))).alias("gas_hex"),
        hx((F.pmod("o_custkey", F.lit(50)) + 1) * F.lit(1000000000)).alias("gas_price_hex"),
        F.concat(F.lit("0x"), F.substring(F.md5("o_orderpriority"), 1, 8),
                 F.lpad(F.lower(F.hex("o_orderkey")), 64, "0")).alias("input"),
        hx(F.lit(21000) + F.lit(5000) * F.col("n_lines")).alias("gas_used_hex"),
        F.when(F.col("o_orderstatus") == "F", F.lit("0x1")).when(F.col("o_orderstatus") == "O", F.lit("0x0"))
        .alias("status"),
    )


def _envelope(df: DataFrame, data: Column, value: Column) -> DataFrame:
    """One raw record per row as a JSON line, and whether an early, damaged delivery precedes it."""
    request = F.struct(F.struct(F.struct(F.col("block_number").alias("id")).alias("data")).alias("request"))
    head = F.concat(F.lit('{"partition_key":'), F.round("block_number", -3).cast("string"), F.lit(',"value":'),
                    F.to_json(value), F.lit(',"metadata":'), F.to_json(request), F.lit(',"data":'))
    payload = F.to_json(data, {"ignoreNullFields": "true"})
    damaged = F.regexp_replace(payload, '"(gas|value|data|from|miner|size|type)":"[^"]*"', '"$1":"0x7"')
    return df.select(F.concat(head, payload, F.lit("}")).alias("line"), F.concat(head, damaged, F.lit("}")).alias("early"),
                     (F.col("block_number") % 3 == 0).alias("twice"))


def bronze_transactions(tx: DataFrame) -> DataFrame:
    d = F.struct(
        word(F.col("block_number")).alias("blockHash"), hx(F.col("block_number")).alias("blockNumber"),
        F.col("from_addr").alias("from"), F.col("gas_hex").alias("gas"), F.col("gas_price_hex").alias("gasPrice"),
        F.col("tx_hash").alias("hash"), F.col("input").alias("input"), hx(F.col("o_orderkey")).alias("nonce"),
        F.concat(F.lit("0x"), F.md5(F.concat(F.lit("r"), F.col("o_orderkey").cast("string")))).alias("r"),
        F.concat(F.lit("0x"), F.md5(F.concat(F.lit("s"), F.col("o_orderkey").cast("string")))).alias("s"),
        F.col("to_addr").alias("to"), hx(F.col("tx_position")).alias("transactionIndex"),
        F.lit("0x2").alias("type"), F.lit("0x1").alias("v"), F.col("value_hex").alias("value"),
        hx((F.pmod("o_custkey", F.lit(50)) + 2) * F.lit(1000000000)).alias("maxFeePerGas"),
        hx(F.lit(1500000000).cast("bigint")).alias("maxPriorityFeePerGas"),
        F.array(F.struct(F.col("from_addr").alias("address"))).alias("accessList"))
    return _envelope(tx, d, F.struct(F.col("block_number").alias("BLOCK_NUMBER"),
                                     F.col("tx_position").cast("int").alias("array_index")))


def line_logs(spark: SparkSession, sf_dir: str, tx: DataFrame) -> DataFrame:
    """`tx` with its receipt's logs: line items in a total order, as log objects."""
    # line items are shuffled as they are and once; the texts of the logs are made after that
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER).repartition("l_orderkey")
    per_order = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*LINE_ORDER))).alias("_l"))
    # an order that repeats has each of its lines once per position
    w = Window.partitionBy("block_number", "o_orderkey")
    t = tx.select(*ORDER_COLS).withColumns({"_first": F.min("tx_position").over(w), "_last": F.max("tx_position").over(w)})
    j = with_texts(t.join(per_order, t["o_orderkey"] == per_order["l_orderkey"], "left"), "_l", "_first", "_last")

    def log(x: Column, position: Column) -> Column:
        return F.struct(
            addr(x["l_suppkey"]).alias("address"),
            word(F.col("block_number")).alias("blockHash"),
            hx(F.col("block_number")).alias("blockNumber"),
            hx(cents(x["l_extendedprice"])).alias("data"),
            F.lit(False).alias("removed"),
            F.array_compact(F.array(F.concat(F.lit("0x"), F.md5(x["l_returnflag"])), word(x["l_partkey"]), word(x["l_linenumber"]),
                                    F.when(x["l_linestatus"] == "O", F.concat(F.lit("0x"), F.md5(x["l_linestatus"])))))
            .alias("topics"),
            F.col("tx_hash").alias("transactionHash"), hx(position).alias("transactionIndex"))

    def placed(x: Column, position: Column) -> Column:
        return F.struct(x.alias("line"), log(x, position).alias("log"))
    alone = F.transform("_l", lambda x: log(x, F.col("tx_position")))
    many = F.transform(F.array_sort(F.flatten(F.transform("_l", lambda x: F.transform(
        F.sequence("_first", "_last"), lambda p: placed(x, p))))), lambda y: y["log"])
    # logIndex = position inside the receipt
    return j.withColumn("logs", F.transform(F.when(F.col("_first") == F.col("_last"), alone).otherwise(many),
                                            lambda x, i: x.withField("logIndex", hx(i)))).drop("_l", "_first", "_last")


def bronze_receipts(spark: SparkSession, sf_dir: str, tx: DataFrame) -> DataFrame:
    r = line_logs(spark, sf_dir, tx)
    d = F.struct(F.struct(
        F.col("tx_hash").alias("transactionHash"), F.col("from_addr").alias("from"), F.col("to_addr").alias("to"),
        F.col("status").alias("status"), F.col("gas_used_hex").alias("gasUsed"),
        F.col("gas_used_hex").alias("cumulativeGasUsed"), F.col("gas_price_hex").alias("effectiveGasPrice"),
        F.coalesce(F.col("logs"), F.array().cast(r.schema["logs"].dataType)).alias("logs")).alias("result"))
    return _envelope(r, d, F.struct(F.col("block_number").alias("BLOCK_NUMBER"), F.col("tx_hash").alias("TX_HASH")))


def bronze_blocks(tx: DataFrame) -> DataFrame:
    per = tx.groupBy("block_number", "epoch").agg(
        F.array_sort(F.collect_list(F.struct("tx_position", "tx_hash"))).alias("_t"),
        F.sum(F.lit(21000) + F.lit(5000) * F.col("n_lines")).alias("gas_used"),
        F.count(F.lit(1)).alias("n"))
    d = F.struct(
        hx(F.col("block_number")).alias("number"), word(F.col("block_number")).alias("hash"),
        hx(F.col("epoch")).alias("timestamp"), F.transform("_t", lambda x: x["tx_hash"]).alias("transactions"),
        hx(F.lit(500) + F.lit(100) * F.col("n")).alias("size"), hx(F.col("gas_used")).alias("gasUsed"),
        F.lit("0x1c9c380").alias("gasLimit"), F.lit("0x0000000000000000").alias("nonce"),
        word(F.col("block_number") - 1).alias("parentHash"), F.array().cast("array<string>").alias("uncles"),
        F.lit("0x0").alias("difficulty"), hx(F.col("block_number") * 3).alias("totalDifficulty"),
        addr(F.col("block_number") + 77).alias("miner"), word(F.col("block_number") + 1).alias("mixHash"),
        hx(F.col("block_number") + 5).alias("extraData"), hx(F.col("block_number") + 7).alias("baseFeePerGas"),
        *[word(F.col("block_number") + i).alias(c) for i, c in enumerate(BLOCK_ROOTS, 10)],
        hx(F.col("block_number") + 20).alias("logsBloom"))
    return _envelope(per, d, F.struct(F.col("block_number").alias("BLOCK_NUMBER")))


def trace_documents(spark: SparkSession, sf_dir: str, tx: DataFrame) -> DataFrame:
    """Nested call tree per order: root -> supplier calls -> line calls (JSON `calls`)."""
    # shuffled once, by order and as they are; the texts of the nodes are made where they are needed
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER).repartition("l_orderkey")
    sup = table(spark, sf_dir, "supplier")

    def line_node(x: Column) -> Column:
        return F.struct(
            F.lit("STATICCALL").alias("type"), addr(x["l_suppkey"]).alias("from"),
            addr(x["l_partkey"]).alias("to"), hx(cents(x["l_extendedprice"])).alias("value"),
            hx(x["l_quantity"].cast("bigint") * F.lit(1000)).alias("gas"),
            hx(x["l_linenumber"].cast("bigint") * F.lit(100)).alias("gasUsed"),
            F.concat(F.lit("0x"), F.md5(x["l_partkey"].cast("string"))).alias("input"),
            F.lit("0x").alias("output"),
            F.when(x["l_returnflag"] == "R", F.lit("returned")).alias("error"))
    lines = (li.groupBy("l_orderkey", "l_suppkey")
             .agg(F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in LINE_ORDER]))).alias("_l")))
    lines = lines.join(sup, lines["l_suppkey"] == sup["s_suppkey"], "left")

    def sup_node(x: Column) -> Column:
        return F.struct(
            F.when(x["s_nationkey"] < 5, F.lit("CREATE")).otherwise(F.lit("CALL")).alias("type"),
            F.lit(None).cast("string").alias("from"), addr(x["l_suppkey"]).alias("to"),
            F.lit("0x0").alias("value"), F.lit("0x5208").alias("gas"), F.lit("0x5208").alias("gasUsed"),
            F.concat(F.lit("0x"), F.substring(F.md5(x["s_name"]), 1, 8)).alias("input"), F.lit("0x").alias("output"),
            F.when(x["s_acctbal"] < 0, F.lit("insolvent")).alias("error"),
            F.transform(x["_l"], line_node).alias("calls"))
    sups = lines.groupBy("l_orderkey").agg(
        F.collect_list(F.struct("l_suppkey", "s_nationkey", "s_name", "s_acctbal", "_l")).alias("_s"))
    t = tx.select(*ORDER_COLS)
    t = with_texts(t.join(sups, t["o_orderkey"] == sups["l_orderkey"], "left"), "_s")
    t = t.withColumn("_s", F.array_sort(F.transform("_s", lambda x: F.struct(x["l_suppkey"], sup_node(x).alias("n")))))
    root = F.struct(
        F.lit("CALL").alias("type"), F.col("from_addr").alias("from"), F.col("to_addr").alias("to"),
        F.col("value_hex").alias("value"), F.col("gas_hex").alias("gas"), F.col("gas_used_hex").alias("gasUsed"),
        F.col("input").alias("input"), F.lit("0x").alias("output"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("urgent")).alias("error"),
        F.transform(F.coalesce("_s", F.array()), lambda x: x["n"]).alias("calls"))
    # supplier nodes carry the caller: the transaction's receiver
    root = root.withField("calls", F.transform(root["calls"], lambda n: n.withField("from", F.col("to_addr"))))
    return t.select("block_number", "tx_position", "o_orderkey", root.alias("root"))


def bronze_traces(docs: DataFrame) -> DataFrame:
    return _envelope(docs, F.struct(F.col("root").alias("result")),
                     F.struct(F.col("block_number").alias("BLOCK_NUMBER"),
                              F.col("tx_position").cast("int").alias("array_index")))


class Chain:
    """Lazily built chain tables over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}
        self._handed_out: set[str] = set()  # entities whose raw files a caller may still read
        self.fixture_seconds = 0.0  # spent on writing raw files, which no model does

    def _get(self, name, fn):
        if name not in self._cache:
            self._cache[name] = fn()
        return self._cache[name]

    @property
    def tx(self):
        return self._get("tx", lambda: orders_tx(self.spark, self.sf_dir))

    @property
    def docs(self):
        return self._get("docs", lambda: trace_documents(self.spark, self.sf_dir, self.tx))

    def raw(self, entity: str) -> str:
        """The folder of an entity's raw files: the early deliveries first, then the right ones."""
        self._handed_out.add(entity)
        return self._raw(entity)

    def _raw(self, entity: str) -> str:
        lines = {"blocks": lambda: bronze_blocks(self.tx), "transactions": lambda: bronze_transactions(self.tx),
                 "receipts_by_hash": lambda: bronze_receipts(self.spark, self.sf_dir, self.tx),
                 "traces": lambda: bronze_traces(self.docs)}[entity]

        def write():
            begun = time.perf_counter()
            path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/raw-{uuid.uuid4().hex}/{entity}"
            rows = lines()
            with shuffles_removed(self.spark):
                for part, folder in ((rows.where("twice").select("early"), "early"), (rows.select("line"), "late")):
                    part.write.options(compression="gzip", maxRecordsPerFile=FILE_RECORDS).text(f"{path}/{folder}")
            self.fixture_seconds += time.perf_counter() - begun
            return path
        return self._get(f"raw_{entity}", write)

    def bronze(self, entity: str) -> DataFrame:
        return read_raw(self.spark, self.raw(entity), entity)

    def silver(self, name):
        from ..plans import silver
        entity = "receipts_by_hash" if name == "receipts" else name
        builders = {"blocks": silver.silver_blocks, "transactions": silver.silver_transactions, "receipts": silver.silver_receipts,
                    "traces": silver.silver_traces}

        def build():
            raw = read_raw(self.spark, self._raw(entity), entity)
            out = store(builders[name](raw, RUN_TS), f"silver-{name}")
            if entity not in self._handed_out:  # whoever asks for them later has them written again
                remove_path(self.spark, self._cache.pop(f"raw_{entity}"))
            return out
        return self._get(f"silver_{name}", build)

    def gold(self, name):
        from ..plans import gold
        builders = {
            "blocks": lambda: gold.fact_blocks(self.silver("blocks"), RUN_TS),
            "transactions": lambda: gold.fact_transactions(self.silver("transactions"), self.gold("blocks"),
                                                           self.silver("receipts"), RUN_TS),
            "event_logs": lambda: gold.fact_event_logs(self.silver("receipts"), self.gold("blocks"),
                                                       self.gold("transactions"), RUN_TS),
            "traces": lambda: gold.fact_traces(self.silver("traces"), self.gold("transactions"), RUN_TS),
        }
        # blocks and transactions are looked up by the other facts: stored once, read with the columns needed
        if name in ("blocks", "transactions"):
            return self._get(f"gold_{name}", lambda: store(builders[name](), f"gold-{name}"))
        return self._get(f"gold_{name}", builders[name])
