"""What runs keep on disk, how many files they make and how often they repeat work."""
from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import functions as F

from ledgerlake.operators import stored as ST
from ledgerlake.operators.numbering import number_within
from ledgerlake.queries.chain import Chain
from ledgerlake.session import ensure_checkpoint_dir
from ledgerlake.streaming import read_stream, upsert_stream

from test_scale import _chain_tables


def _left(spark, name: str) -> set[str]:
    root = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    return {p.name for p in root.glob(f"{name}-*")}


def test_raw_files_go_when_silver_is_stored(spark, tmp_path):
    c = Chain(spark, _chain_tables(spark, str(tmp_path)))
    before = {p for p in _left(spark, "raw")}
    assert c.silver("receipts").count() == 60
    root = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    assert not [p for d in _left(spark, "raw") - before for p in (root / d).rglob("part-*")]
    assert c.bronze("receipts_by_hash").count() == 80  # written again for whoever asks
    handed = Path(c.raw("receipts_by_hash").removeprefix("file:"))
    c._cache.pop("silver_receipts")
    c.silver("receipts")
    assert list(handed.rglob("part-*"))  # and kept, once handed out


def test_receipts_shuffle_lines_once_and_as_they_are(spark, tmp_path):
    from ledgerlake.queries import chain as CH
    c = Chain(spark, _chain_tables(spark, str(tmp_path)))
    plan = CH.bronze_receipts(spark, str(tmp_path), c.tx)._jdf.queryExecution().executedPlan().toString()
    below = [part for part in re.split(r"\n", plan) if "Exchange hashpartitioning" in part]
    assert sum("l_orderkey" in x or "o_orderkey" in x for x in below) <= 4  # lines, their number, orders twice


def test_an_order_that_repeats_has_its_lines_at_each_position(spark, tmp_path):
    folder = _chain_tables(spark, str(tmp_path / "once"))
    for t in ("orders", "lineitem", "supplier"):
        rows = spark.read.parquet(f"{folder}/{t}.parquet")
        (rows.union(rows.where("o_orderkey = 21")) if t == "orders" else rows).write.parquet(f"{tmp_path}/twice/{t}.parquet")
    got = (Chain(spark, f"{tmp_path}/twice").bronze("receipts_by_hash")
           .select(F.size(F.expr("variant_get(data, '$.result.logs', 'array<variant>')")).alias("n"), "tx_hash").distinct())
    assert {(r["n"], r["count"]) for r in got.groupBy("n").count().collect()} == {(3, 59), (6, 1)}


def test_numbering_stores_compressed_rows(spark):
    before, stored = _left(spark, "rdd"), _left(spark, "numbered")
    rows = spark.range(1000).select((F.col("id") % 7).alias("g"), "id")
    out = number_within(rows, ["g"], ["id asc"]).groupBy("g").agg(F.max("row_num").alias("m")).collect()
    assert sorted(r["m"] for r in out) == [142] * 1 + [143] * 6
    assert len(_left(spark, "numbered") - stored) == 1 and _left(spark, "rdd") == before


def test_many_partition_values_share_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(6000).select("id", (F.col("id") - 3000).alias("bucket"), F.lit("a").alias("v"))
    ST.replace_table(spark, path, rows, "id", "bucket")
    folders = {f.split("/_p=")[1].split("/")[0] for f in ST.read_table(spark, path).inputFiles()}
    assert 100 < len(folders) <= ST.FOLDERS + 1
    batch = rows.where("id % 2 = 0").withColumn("v", F.lit("b"))
    batches = _left(spark, "batch")
    out = ST.upsert_table(spark, path, batch, "id")
    assert _left(spark, "batch") == batches  # the batch was for the run only
    assert {(r["v"], r["count"]) for r in out.groupBy("v").count().collect()} == {("a", 3000), ("b", 3000)}
    one = ST.read_table(spark, path, where={"bucket": (-3000, -3000)})
    assert [tuple(r) for r in one.collect()] == [(0, -3000, "b")] and len(one.inputFiles()) <= 2


def test_few_partition_values_keep_their_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(100).select("id", F.when(F.col("id") > 0, F.col("id") % 10).alias("bucket"))
    ST.replace_table(spark, path, rows, "id", "bucket")
    folders = {f.split("/_p=")[1].split("/")[0] for f in ST.read_table(spark, path).inputFiles()}
    assert folders == {"null", *map(str, range(10))}


def test_a_micro_batch_is_computed_once(spark, tmp_path):
    spark.range(100).write.parquet(f"{tmp_path}/in")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    rows = read_stream(spark, f"{tmp_path}/in", "id bigint").mapInArrow(count, "id bigint")
    out = upsert_stream(rows, f"{tmp_path}/table", ["id"], ["id desc"], f"{tmp_path}/_checkpoint")
    assert out.count() == 100 and seen.value == 100


def test_silver_traces_shuffle_trees_once(spark, tmp_path):
    from ledgerlake.plans import silver
    from ledgerlake.queries.chain import RUN_TS
    c = Chain(spark, _chain_tables(spark, str(tmp_path)))
    plan = silver.silver_traces(c.bronze("traces"), RUN_TS)._jdf.queryExecution().optimizedPlan().toString()
    below = [next(x for x in part.split("\n") if "Project [" in x) for part in plan.split("Window [")[1:]]
    assert len(below) == 2 and sum("full_traces" in x for x in below) == 1


def test_leaves_and_failed_nodes_open_alike(spark):
    from ledgerlake.operators.tree import flatten_tree
    text = '{"k":1,"calls":[{"k":2,"calls":null},{"k":3,"calls":[{"k":4,"failed":null},{"k":5}]},7]}'
    rows = spark.range(1).select("id", F.lit(text).alias("t"))
    n = flatten_tree(rows.select("id", F.parse_json("t").alias("t")), "t", ["id"], skip_field="failed")
    got = {r["trace_address"]: (r["j"], r["sub_traces"], r["trace_index"])
           for r in n.withColumn("j", F.to_json("node")).collect()}
    assert got == {"ORIGIN": ('{"k":1}', 3, 0), "0": ('{"k":2}', 0, 1), "1": ('{"k":3}', 1, 2), "1_0": ('{"failed":null,"k":4}', 0, None),
                   "1_1": ('{"k":5}', 0, 3), "2": ("7", 0, 4)}


def _bronze_traces(spark, docs):
    """Bronze rows of (position, delivery's time, depth of the call chain, name of its root)."""
    from ledgerlake.sources.raw import bronze, envelope_from_text
    lines = []
    for position, at, depth, name in docs:
        tree = f'{{"n":"{name}","calls":[' + '{"calls":[' * depth + "]}" * depth + "]}"
        lines.append((f'{{"partition_key":0,"value":{{"BLOCK_NUMBER":7,"array_index":{position}}},"metadata":{{}},'
                      f'"data":{{"result":{tree}}}}}', at))
    df = spark.createDataFrame(lines, "value string, at string")
    return bronze(envelope_from_text(df, "value", inserted=F.col("at").cast("timestamp_ntz")), "traces")


def test_the_latest_delivery_wins_whether_variant_holds_it_or_not(spark):
    from ledgerlake.plans import silver
    from ledgerlake.queries.chain import RUN_TS
    early, late = "2024-01-01", "2024-01-02"
    docs = [(0, early, 1, "a"), (0, late, 2, "b"), (1, early, 700, "c"), (1, late, 1, "d"), (2, early, 1, "e"), (2, late, 700, "f")]

    def found(some):
        n = silver.silver_traces(_bronze_traces(spark, some), RUN_TS)
        n = n.groupBy("tx_position").agg(F.count(F.lit(1)).alias("n"), F.max(F.expr("try_variant_get(trace_json, '$.n', 'string')")).alias("name"))
        return sorted(tuple(r) for r in n.collect())
    assert found(docs) == [(0, 3, "b"), (1, 2, "d"), (2, 701, "f")]
    assert found(docs[:2]) == [(0, 3, "b")]


def test_raw_traces_are_parsed_for_deep_documents_once(spark, tmp_path):
    from ledgerlake.plans import silver
    from ledgerlake.queries.chain import RUN_TS
    c = Chain(spark, _chain_tables(spark, str(tmp_path)))
    plan = silver.silver_traces(c.bronze("traces"), RUN_TS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [value") == 3  # the branch of text documents reads the long lines alone
    assert plan.count("$.result,") == 2  # a member is copied once, not again by every filter on it


def test_children_of_a_level_are_opened_once(spark):
    from ledgerlake.operators.tree import flatten_tree
    depth = 20  # more levels than are opened of every document
    text = "".join(f'{{"k":{i},"calls":[' for i in range(depth)) + '{"k":99}' + "]}" * depth
    rows = spark.range(1).select("id", F.lit(text).alias("t")).repartition(2)
    n = flatten_tree(rows.select("id", F.parse_json("t").alias("t")), "t", ["id"])
    got = sorted((r["depth"], r["sub_traces"], r["trace_index"], r["j"]) for r in n.withColumn("j", F.to_json("node")).collect())
    assert got == [*((i, 1, i, f'{{"k":{i}}}') for i in range(depth)), (depth, 0, depth, '{"k":99}')]
    plan = n._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("$['calls'], ArrayType") <= 4
