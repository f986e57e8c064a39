"""What a run leaves on disk and how often it reads: limits that the size of the input makes matter."""
from __future__ import annotations

import gzip
import os
import re
from pathlib import Path

from pyspark.sql import functions as F

from ledgerlake.queries.chain import Chain
from ledgerlake.session import store


def _chain_tables(spark, folder: str) -> str:
    rows = spark.range(60)
    rows.select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
                F.lit(10.5).alias("o_totalprice"), F.lit("1998-01-01 00:00:00").cast("timestamp_ntz").alias("o_orderdate"),
                F.lit("5-LOW").alias("o_orderpriority")).write.parquet(f"{folder}/orders.parquet")
    rows.select("id", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("n")).select(
        F.col("id").alias("l_orderkey"), (F.col("n") * 10).cast("bigint").alias("l_partkey"), (F.col("n") % 2).cast("bigint").alias("l_suppkey"),
        F.col("n").alias("l_linenumber"), F.lit(2.0).alias("l_quantity"), F.lit(3.25).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"),
        F.lit(0.0).alias("l_tax"), F.lit("R").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.lit("1998-01-01 00:00:00").cast("timestamp_ntz").alias("l_shipdate")).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(2).select(F.col("id").alias("s_suppkey"), F.lit("S").alias("s_name"), F.lit(3).alias("s_nationkey"),
                          F.lit(1.0).alias("s_acctbal")).write.parquet(f"{folder}/supplier.parquet")
    return folder


def test_raw_files_are_compressed_and_whole(spark, tmp_path):
    c = Chain(spark, _chain_tables(spark, str(tmp_path)))
    path = Path(c.raw("traces").removeprefix("file:"))
    files = sorted(path.rglob("part-*"))
    assert files and all(f.name.endswith(".gz") for f in files)
    late = [line for f in files if f.parent.name == "late" for line in gzip.open(f, "rt")]
    assert len(late) == 60
    assert c.bronze("traces").count() == 80  # one block of three is delivered twice


def _shuffled(spark) -> int:
    """Bytes of shuffle files there are now."""
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    return sum(os.path.getsize(os.path.join(at, n)) for r in env.blockManager().diskBlockManager().localDirsString()
               for at, _, names in os.walk(str(r)) for n in names if n.startswith("shuffle_") and n.endswith(".data"))


def test_stored_frames_leave_no_shuffle_files(spark):
    before = _shuffled(spark)
    rows = spark.range(200_000).select((F.col("id") % 1000).alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    out = store(rows.repartition(8, "k"))
    assert _shuffled(spark) - before < 1_000_000  # 200,000 digests are some 8 MB
    assert out.count() == 200_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_walk_sends_bounded_batches(spark):
    """Chains of 300 calls have 45,000 steps of addresses each: 100 of them must not become one batch."""
    import pyarrow as pa

    from ledgerlake.operators.tree import WALK_HELD, _walk
    n = 300
    text = '{"k":1,"calls":[' * (n - 1) + '{"k":1}' + "]}" * (n - 1)
    names = ["doc", "trace_address_array", "depth", "sub_traces", "trace_index", "_text", "path_error"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(100), pa.int64()), pa.array([text] * 99 + [None])], names=["doc", "_doc"])
    out = list(_walk(1, names, "calls", ("error",), None)(iter([batch])))
    assert len(out) > 1 and sum(b.num_rows for b in out) == 99 * n
    assert all(len(b.column(1).values) <= WALK_HELD + n for b in out)
    assert [r for b in out for r in b.column(0).to_pylist()] == [d for d in range(99) for _ in range(n)]


def test_wide_hex_takes_as_few_limbs_as_it_needs(spark):
    from ledgerlake.functions import hex_to_int
    values = [16 ** n - 1 for n in range(30, 65)] + [16 ** n for n in range(30, 64)] + [10 ** n for n in range(30, 78)]
    rows = spark.createDataFrame([(hex(v), str(v)) for v in values], "h string, d string")
    assert rows.where(~hex_to_int("h").eqNullSafe(F.col("d"))).count() == 0
    plan = rows.select(hex_to_int("h"))._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal(20,0)) / " not in plan


def test_lines_are_shuffled_once_for_the_documents(spark, tmp_path):
    c = Chain(spark, _chain_tables(spark, str(tmp_path)))
    plan = c.docs._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert keys and not any("l_suppkey" in k for k in keys)


def test_checks_leave_no_shuffle_files(spark):
    from ledgerlake.operators import checks as CK
    from ledgerlake.plans.suites import Check, run_suite
    rows = spark.range(200_000).select(F.md5(F.col("id").cast("string")).alias("v"))
    before = _shuffled(spark)
    out = run_suite(spark, {"t": rows}, [Check(f"unique {i}", "t", lambda t: CK.unique_on(t["t"], ["v"])) for i in range(2)])
    assert [r["failures"] for r in out.collect()] == [0, 0]
    assert _shuffled(spark) - before < 1_000_000
