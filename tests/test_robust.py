"""Cases a plain run never meets: deep and broken records, restarts, moved keys, other time zones."""
from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import as_variant, jget, lit_ts
from ledgerlake.functions.jsontext import call_tree, members
from ledgerlake.functions.keys import path_partition_key
from ledgerlake.operators import (add_buckets, chain_head, explode_array, flatten_tree, latest_per_key, run_if_any,
                                  sequence_gaps, upsert, upsert_table)
from ledgerlake.operators.numbering import number_within
from ledgerlake.plans import gold, ingest, silver
from ledgerlake.plans.run import run_model
from ledgerlake.session import ensure_checkpoint_dir
from ledgerlake.sources.raw import join_manifest, read_raw, unreadable
from ledgerlake.sources.seed import Catalog, read_seed
from ledgerlake.streaming import counters_stream, read_stream, upsert_stream, work_dir

RUN = dt.datetime(2024, 1, 1)


def chain_of(depth: int) -> str:
    text = '{"type":"CALL","gas":"0x1"}'
    for i in range(depth):
        text = '{"type":"CALL","gas":"0x%x","calls":[%s]%s}' % (i, text, ',"error":"x"' if i == depth - 3 else "")
    return text


def plain_tree(node, address=(), path=False):
    path = path or node.get("error") is not None
    kids = node.get("calls") or []
    yield list(address), len(kids), {k: v for k, v in node.items() if k != "calls"}, path
    for i, k in enumerate(kids):
        yield from plain_tree(k, (*address, i), path)


def test_walk_equals_plain_recursion():
    doc = {"a": "x\"{[,\\", "calls": [{"n": [1, {"calls": [2]}], "error": None}, {"error": {"m": 1}, "calls": [{}, {"b": 1.5}]},
                                    {"calls": []}], "error": None, "z": {"calls": {"q": []}}}
    for text in (json.dumps(doc), json.dumps(doc, indent=2), json.dumps(doc, separators=(",", ":"))):
        got = call_tree(text, flags=("error",))
        want = list(plain_tree(doc))
        assert [(a, n, json.loads(t), f) for a, n, _, t, (f,) in got] == want
        assert [p for _, _, p, _, _ in got] == list(range(len(want)))
    assert members(json.dumps(doc)).keys() == doc.keys() and members("[1]") is None and members('{"a":1') is None
    assert members("{}") == {} and call_tree("null")[0][3] == "null"


def test_skipped_nodes_have_no_position():
    text = '{"calls":[{"failed":null,"error":"e","calls":[{"b":1}]},{"c":1}]}'
    assert [(a, n, p, f) for a, n, p, _, (f,) in call_tree(text, flags=("error",), skip_field="failed")] == [
        ([], 1, 0, False), ([0], 1, None, False), ([0, 0], 0, 1, False), ([1], 0, 2, False)]


@pytest.mark.parametrize("depth", [1, 1024, 6000])
def test_deep_trees_from_files(spark, tmp_path, depth):
    rec = ('{"partition_key":null,"value":{"BLOCK_NUMBER":7,"array_index":0},"metadata":null,"data":{"id":1,"result":%s}}')
    bad = '{"partition_key":1,"value":{"BLOCK_NUMBER":8,"array_index":0},"data":{"error":1,"result":%s}}' % chain_of(depth)
    (tmp_path / "9000_1.json").write_text(rec % chain_of(depth) + "\nnot json\n" + bad + "\n\n")
    raw = read_raw(spark, str(tmp_path), "traces")
    nodes = silver.silver_traces(raw, RUN).collect()
    assert len(nodes) == depth + 1 and {n.block_number for n in nodes} == {7} and {n.partition_key for n in nodes} == {9000}
    assert {len(n.trace_address_array): n.trace_index for n in nodes} == {i: i for i in range(depth + 1)}
    assert sum(not n.path_error for n in nodes) == (2 if depth >= 3 else depth + 1)
    lines = spark.read.text(str(tmp_path)).where("value <> ''")
    assert [r.value for r in unreadable(lines).collect()] == ["not json"]


def test_empty_batches(spark):
    none = spark.createDataFrame([], "k int, j string")
    assert flatten_tree(none, "j", ["k"]).count() == 0
    assert flatten_tree(none.select("k", as_variant("j").alias("v")), "v", ["k"], inherit={"p": "error"}).count() == 0
    assert upsert(none, none, "k").count() == 0


def test_partition_key_from_path(spark):
    paths = ["s3a://bucket/x/raw/blocks/12000_3.json", "file:///tmp/a/b/7_0.json", "none", "/a/x_1.json"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(path_partition_key("p")).collect()] == [12000, 7, None, None]


def test_latest_breaks_variant_ties(spark):
    rows = [(1, '{"a":%d}' % i) for i in range(20)]
    pick = set()
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k int, j string").select("k", as_variant("j").alias("v")).repartition(5)
        pick.add(latest_per_key(df, ["k"], ["k desc"]).select(jget("v", "$.a")).first()[0])
    assert len(pick) == 1


def test_persisted_upsert_moves_keys_and_replays(spark):
    path = work_dir(spark, "t")
    a = spark.createDataFrame([(1, 1000, "a"), (2, 1000, "b"), (3, 2000, "c")], "id int, bucket int, v string")
    b = spark.createDataFrame([(3, 3000, "C"), (2, 2000, "B"), (4, None, "d")], "id int, bucket int, v string")
    upsert_table(spark, path, a, "id", "bucket")
    for _ in range(2):
        out = upsert_table(spark, path, b, "id", "bucket")
        assert sorted((r.id, r.bucket, r.v) for r in out.collect()) == [(1, 1000, "a"), (2, 2000, "B"), (3, 3000, "C"), (4, None, "d")]
    moved = spark.createDataFrame([(1, 2000, "A")], a.schema)
    out = upsert_table(spark, path, moved, "id", "bucket")
    assert sorted((r.id, r.bucket) for r in out.collect()) == [(1, 2000), (2, 2000), (3, 3000), (4, None)]


def test_batches_that_repeat_a_key(spark):
    t = spark.createDataFrame([(1, 1)], "id int, n int")
    b = spark.createDataFrame([(2, 1), (2, 5), (2, 3)], "id int, n int")
    with pytest.raises(ValueError):
        upsert(t, b, "id", "merge")
    assert sorted(map(tuple, upsert(t, b, "id", "merge", order=["n desc"]).collect())) == [(1, 1), (2, 5)]


def test_streams_go_on_after_a_restart(spark):
    base = work_dir(spark, "s")
    schema = "k int, n int"

    def put(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")

    def run():
        s = read_stream(spark, f"{base}/in", spark.createDataFrame([], schema).schema)
        up = upsert_stream(s, f"{base}/up", ["k"], ["n desc"], f"{base}/c1")
        s = read_stream(spark, f"{base}/in", spark.createDataFrame([], schema).schema)
        cnt = counters_stream(s, "k", {"c": F.count(F.lit(1))}, f"{base}/c2", f"{base}/cnt")
        return (up and sorted(map(tuple, up.select("k", "n").collect())),
                cnt and sorted(map(tuple, cnt.select("k", "c").collect())))
    spark.createDataFrame([], schema).write.parquet(f"{base}/in")
    assert run() == (None, None)
    put([(1, 5), (2, 1)])
    assert run() == ([(1, 5), (2, 1)], [(1, 1), (2, 1)])
    put([(1, 3), (3, 9)])
    assert run() == ([(1, 5), (2, 1), (3, 9)], [(1, 2), (2, 1), (3, 1)])
    assert run() == ([(1, 5), (2, 1), (3, 9)], [(1, 2), (2, 1), (3, 1)])


def test_numbering_forms_agree(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    rows = [sorted(map(tuple, number_within(df, ["g"], ["v asc"], mode=m).collect())) for m in ("split", "window")]
    assert rows[0] == rows[1]


@pytest.mark.parametrize("bucket", [1, 4, 100_000])
def test_gaps_across_buckets(spark, bucket):
    rows = [(g, v) for g in "ab" for v in (-9, -3, -2, 0, 1, 5, 5, 40, 41, 99)] + [("c", 7), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v int")
    want = [(g, a, b, b - a - 1) for g in "ab" for a, b in ((-9, -3), (-2, 0), (1, 5), (5, 40), (41, 99))]
    assert sorted(map(tuple, sequence_gaps(df, "v", ["g"], bucket=bucket).collect())) == want
    assert sorted(map(tuple, sequence_gaps(df.where("g = 'a'"), "v", bucket=bucket).collect())) == [w[1:] for w in want[:5]]


def test_other_time_zones(spark):
    ts = dt.datetime(2024, 1, 1, 12)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-01-01 09:00:00",), ("2024-01-01 12:00:00",)], "s string").select(
            F.col("s").cast("timestamp_ntz").alias("t"))
        assert df.where(F.col("t") >= lit_ts(ts)).count() == 1
        stamped = silver.with_audit(df, ts)
        assert stamped.first().inserted_timestamp == ts
        assert gold._lookup_floor(ts) == dt.datetime(2023, 12, 31)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_ledgers_and_backlogs(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    s = "block_number long, tx_hash string, file_name string, _inserted_timestamp timestamp_ntz"
    first = ingest.ledger(None, spark.createDataFrame([(1, "a", "f", t0), (1, "b", "f", t0)], s), "receipts_by_hash", t0)
    both = ingest.ledger(first, spark.createDataFrame([(2, "a", "g", t1), (1, "b", "g", t1)], s), "receipts_by_hash", t1)
    assert sorted((r.block_number, r.tx_hash, r.file_name) for r in both.collect()) == [(1, "a", "f"), (1, "b", "g"), (2, "a", "g")]
    assert all(r.complete_receipts_by_hash_id and r.inserted_timestamp for r in both.collect())
    spine = spark.range(10).select(F.col("id").alias("block_number"))
    done = spark.createDataFrame([(3,), (8,)], "block_number long")

    def numbers(df):
        return sorted(r.block_number for r in df.collect())
    assert numbers(ingest.traces_backlog(spine, done, since_block=5, cap=None)) == [5, 6, 7, 9]
    assert numbers(ingest.traces_backlog(spine, done, before_block=5, cap=None)) == [0, 1, 2, 4]
    assert numbers(ingest.traces_backlog(spine, done, before_block=5, cap=2)) == [2, 4]
    assert '"timeout":"120s"' in ingest.traces_backlog(spine, done, cap=1).first().request
    assert numbers(ingest.blocks_transactions_backlog(spine, done, done.where("block_number = 3"), before_block=9, cap=None)) == [0, 1, 2, 4, 5, 6, 7, 8]
    blocks = spark.createDataFrame([(1, '{"transactions":["a","b"]}'), (2, '{"transactions":["a"]}'), (3, "{}")], "block_number long, j string")
    todo = ingest.receipts_todo(blocks.select("block_number", as_variant("j").alias("block_json")))
    got = ingest.receipts_backlog(todo, first, cap=None).collect()
    assert [(r.block_number, r.tx_hash) for r in got] == [(2, "a")]
    assert ingest.block_requests(spine, 4).count() == 3
    assert ensure_checkpoint_dir(spark)


def test_manifest_seed_and_catalog(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    for n in (1, 2):
        (tmp_path / "raw" / f"{n}000_1.json").write_text('{"value":{"BLOCK_NUMBER":%d},"data":{"result":{}}}\n' % n)
    raw = read_raw(spark, str(tmp_path / "raw"), "blocks")
    reg = raw.where("partition_key = 2000").select("file_name", "partition_key", lit_ts(RUN).alias("_inserted_timestamp"))
    assert [(r.block_number, r._inserted_timestamp) for r in join_manifest(raw, reg).collect()] == [(2, RUN)]
    recent = read_raw(spark, str(tmp_path / "raw"), "blocks", since=dt.timedelta(days=1))
    assert recent.count() == 2 and read_raw(spark, str(tmp_path / "raw"), "blocks", since=dt.timedelta(days=1),
                                            now=dt.datetime(2100, 1, 1)).count() == 0
    (tmp_path / "s.csv").write_text("workflow_name,workflow_schedule\na,1 * *\nb,\n")
    assert [tuple(r) for r in read_seed(spark, str(tmp_path / "s.csv")).collect()] == [("a", "1 * *"), ("b", None)]
    spark.range(3).write.parquet(str(tmp_path / "t"))
    c = Catalog(spark)
    c.register("three", str(tmp_path / "t"))
    assert c.table("three").count() == 3 == spark.sql("select * from three").count()


def test_rebuild_guard_and_full_refresh(spark):
    path = work_dir(spark, "m")
    rows = spark.createDataFrame([(1, 10, "a"), (2, 5010, "b")], "id int, block_number int, v string")
    run_model(spark, path, lambda t: rows, "id", "bucket", bucket_of="block_number")
    with pytest.raises(PermissionError):
        run_model(spark, path, lambda t: rows, "id", "bucket", bucket_of="block_number", full_refresh=True, may_rebuild=False)
    seen = []
    out = run_model(spark, path, lambda t: seen.append(t) or rows.where("id = 1"), "id", "bucket", bucket_of="block_number",
                    full_refresh=True)
    assert seen == [None] and [r.id for r in out.collect()] == [1]
    out = run_model(spark, path, lambda t: rows.withColumn("v", F.lit("c")), "id", "bucket", bucket_of="block_number")
    assert sorted((r.id, r.v, r.bucket) for r in out.collect()) == [(1, "c", 0), (2, "c", 5000)]


def test_small_helpers(spark):
    assert chain_head(spark.createDataFrame([("0x10",), ("0xff",)], "result string")) == 255
    assert run_if_any(spark.range(0), lambda d: 1) is None and run_if_any(spark.range(1), lambda d: 1) == 1
    a = explode_array(spark.createDataFrame([(1, [3, 4])], "k int, a array<int>"), "a", ["k"])
    assert sorted(r[-1] for r in a.collect()) == [3, 4]
    assert add_buckets(spark.createDataFrame([(1499,)], "block_number int")).first().partition_key == 1000
