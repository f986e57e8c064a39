import datetime as dt
import json
import random

from pyspark.sql import functions as F

from ledgerlake.functions import as_variant, jget
from ledgerlake.operators import (add_totals, ancestor_flag, child_counts, flatten_tree, has_error, latest_per_key,
                                  not_in, number_within, preorder_index, sequence_gaps,
                                  upsert, with_constants)

TREE = ('{"from":"0xa","type":"CALL","value":"0xde0b6b3a7640000","calls":['
        '{"from":"0xb","type":"CALL","error":"reverted","calls":[{"from":"0xc"},{"from":"0xe","calls":[{"from":"0xf"}]}]},'
        '{"from":"0xd"},{"from":"0xg"}]}')
EXPECTED = [(0, "ORIGIN", None, "0xa", 3, True), (1, "0", "ORIGIN", "0xb", 2, False), (2, "0_0", "0", "0xc", 0, False),
            (3, "0_1", "0", "0xe", 1, False), (4, "0_1_0", "0_1", "0xf", 0, False), (5, "1", "ORIGIN", "0xd", 0, True),
            (6, "2", "ORIGIN", "0xg", 0, True)]


def _nodes(spark):
    df = spark.createDataFrame([(1, 0, TREE)], "block_number long, tx_position int, j string") \
        .select("block_number", "tx_position", as_variant("j").alias("v"))
    return flatten_tree(df, "v", ["block_number", "tx_position"], inherit={"path_error": "error"})


def test_flatten_tree_fixture(spark):
    n = _nodes(spark)
    got = sorted((r.trace_index, r.trace_address, r.parent_trace_address, r.f, r.sub_traces, not r.path_error)
                 for r in n.select("*", jget("node", "$.from").alias("f")).collect())
    assert got == EXPECTED


def test_flat_operators_agree_with_walk(spark):
    g = ["block_number", "tx_position"]
    n = _nodes(spark).withColumn("own", has_error(F.col("node")))
    n = child_counts(n, g, name="kids")
    n = ancestor_flag(n, g, "own", name="anc")
    n = preorder_index(n, g, name="position", mode="split")
    for r in n.collect():
        assert r.kids == r.sub_traces and r.anc == r.path_error and r.position == r.trace_index


def test_twelve_siblings_are_not_children(spark):
    kids = ",".join('{"from":"k%d"%s}' % (i, ',"error":"x"' if i == 1 else "") for i in range(13))
    doc = '{"from":"r","calls":[{"from":"p","calls":[%s]}]}' % kids
    df = spark.createDataFrame([(1, doc)], "k long, j string").select("k", as_variant("j").alias("v"))
    n = flatten_tree(df, "v", ["k"], inherit={"bad": "error"}).withColumn("own", has_error(F.col("node")))
    n = ancestor_flag(n, ["k"], "own", name="anc")
    rows = {r.trace_address: (r.bad, r.anc) for r in n.collect()}
    assert rows["0_1"] == (True, True) and rows["0_12"] == (False, False)


def test_latest_per_key_takes_the_newest(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    best = {}
    for r in ev.collect():
        if r.user_id not in best or (r.ts, r.event_id) > (best[r.user_id].ts, best[r.user_id].event_id):
            best[r.user_id] = r
    got = latest_per_key(ev, ["user_id"], ["ts desc", "event_id desc"])
    assert {r.user_id: r for r in got.select(*ev.columns).collect()} == best


def test_latest_per_key_nulls_first_default(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b")], "k int, t int, p string")
    assert latest_per_key(df, ["k"], ["t desc"]).first().p == "a"
    assert latest_per_key(df, ["k"], ["t desc nulls last"]).first().p == "b"


def test_number_within_split_equals_window(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "user_id", "ts")
    a = number_within(ev, ["user_id"], ["ts asc", "event_id asc"], "rn", mode="split")
    b = number_within(ev, ["user_id"], ["ts asc", "event_id asc"], "rn", mode="window")
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_upsert_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = upsert(t, b, "k")
    twice = upsert(once, b, "k")
    assert sorted(once.collect()) == sorted(twice.collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_merge_keeps_columns(spark):
    t = spark.createDataFrame([(1, "a", 10)], "k int, v string, first int")
    b = spark.createDataFrame([(1, "A", 20), (2, "b", 20)], "k int, v string, first int")
    out = sorted(upsert(t, b, "k", "merge", keep_existing=["first"]).collect())
    assert out == [(1, "A", 10), (2, "b", 20)]


def test_incremental_totals_equal_one_shot(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    split = dt.datetime(2024, 1, 15)
    cnt = lambda d: d.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    s = add_totals(add_totals(None, cnt(ev.where(F.col("ts") < split)), "user_id", ["n"]),
                   cnt(ev.where(F.col("ts") >= split)), "user_id", ["n"])
    assert sorted(s.collect()) == sorted(cnt(ev).collect())


def test_not_in_null_semantics(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(1,)], "k int")
    bn = spark.createDataFrame([(1,), (None,)], "k int")
    assert [r.k for r in not_in(a, b, "k").collect()] == [2]
    assert not_in(a, bn, "k").count() == 0


def test_with_constants_and_gaps(spark):
    df = spark.createDataFrame([(1,), (2,), (5,), (9,)], "v long")
    assert with_constants(df, [{"s": "x"}, {"s": "y"}]).count() == 8
    g = sorted((r.v_previous, r.v, r.gap) for r in sequence_gaps(df, "v").collect())
    assert g == [(2, 5, 2), (5, 9, 3)]


def test_both_ways_of_flattening_agree(spark):
    """VARIANT documents are opened in the JVM, text is walked in Python: same nodes, positions, counts and flags."""
    r = random.Random(7)

    def node(depth):
        n = {"type": r.choice(["CALL", None, 3]), "z": r.random() < 0.5}
        if r.random() < 0.2:
            n["error"] = r.choice(["x", None, {"a": 1}, False])
        if r.random() < 0.15:
            n["failed"] = r.choice([None, True])
        if depth and r.random() < 0.8:
            n["calls"] = r.choice([None, [], [node(depth - 1) for _ in range(r.randint(1, 4))], [node(depth - 1), 5, "s", None, [1]]])
        return n

    def line(depth):
        return {"type": "CALL", **({"calls": [line(depth - 1), {"type": "x", "failed": 1, "error": "e"}]} if depth else {"error": "deep"})}
    docs = [json.dumps(x) for x in [*[node(5) for _ in range(60)], line(40), line(200), "leaf", 7, None, [1]]]
    df = spark.createDataFrame(list(enumerate(docs)), "k int, j string")
    for skip in ("failed", None):
        how = {"inherit": {"bad": "error", "odd": "z"}, "skip_field": skip}
        got = [sorted(map(str, flatten_tree(d, c, ["k"], **how).withColumn("node", F.to_json("node")).collect()))
               for d, c in ((df, "j"), (df.select("k", as_variant("j").alias("v")), "v"))]
        assert got[0] == got[1] and len(got[0]) > 500
