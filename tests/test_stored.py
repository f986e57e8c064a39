"""Stored tables: columns that come and go, files a run opens, versions, compaction, clustered reads."""
from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import compact_table, read_table, replace_table, upsert_table, vacuum_table
from ledgerlake.operators import stored as ST
from ledgerlake.streaming import work_dir


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_fewer_columns_leave_other_values_alone(spark):
    path = work_dir(spark, "t")
    upsert_table(spark, path, spark.createDataFrame([(1, 0, "a", 10), (2, 0, "b", 20)], "id int, p int, v string, extra int"), "id", "p")
    less = spark.createDataFrame([(1, 0, "A")], "id int, p int, v string")
    assert rows(upsert_table(spark, path, less, "id"), "id", "v", "extra") == [(1, "A", None), (2, "b", 20)]
    upsert_table(spark, path, spark.createDataFrame([(1, 0, "a", 11)], "id int, p int, v string, extra int"), "id")
    assert rows(upsert_table(spark, path, less, "id", mode="merge"), "id", "v", "extra") == [(1, "A", 11), (2, "b", 20)]


def test_appended_and_widened_columns_survive_reading(spark):
    path = work_dir(spark, "t")
    upsert_table(spark, path, spark.createDataFrame([(1, 0, 7), (2, 9, 8)], "id int, p int, n int"), "id", "p")
    more = spark.createDataFrame([(2, 9, 2 ** 40, "new")], "id bigint, p int, n bigint, note string")
    upsert_table(spark, path, more, "id")
    got = read_table(spark, path)
    assert dict(got.dtypes) == {"id": "bigint", "p": "int", "n": "bigint", "note": "string"}
    assert rows(got, "id", "n", "note") == [(1, 7, None), (2, 2 ** 40, "new")]
    upsert_table(spark, path, spark.createDataFrame([(1, 0, 5)], "id int, p int, n int"), "id")  # narrower again, and an old key
    assert rows(read_table(spark, path), "id", "n", "note") == [(1, 5, None), (2, 2 ** 40, "new")]
    with pytest.raises(TypeError):
        upsert_table(spark, path, spark.createDataFrame([(1, 0, "x")], "id int, p int, n string"), "id")
    assert len(ST.versions(spark, path)) == 3


def test_files_opened_follow_the_batch(spark):
    opened = {}
    for buckets in (20, 200):
        path = work_dir(spark, "t")
        t = spark.range(0, 40 * buckets, 2).select("id", F.floor(F.col("id") / 40).alias("p"), F.lit(0).alias("v"))
        upsert_table(spark, path, t, "id", "p")
        assert ST._files(spark, path, ST.version_info(spark, path)).count() >= buckets
        near = spark.range(80, 100, 2).select("id", F.lit(2).cast("bigint").alias("p"), F.lit(1).alias("v"))
        out = upsert_table(spark, path, near, "id")
        opened[buckets] = ST.version_info(spark, path)["run"]
        assert out.count() == 20 * buckets and out.where("v = 1").count() == 10
        far = spark.createDataFrame([(0, 0, 2), (40 * buckets - 2, buckets - 1, 2)], t.schema)
        assert upsert_table(spark, path, far, "id").where("v = 2").count() == 2  # ranges rule out nothing, filters do
        assert ST.version_info(spark, path)["run"] == {"opened": 2, "rewritten": 2}
        new = spark.range(1, 40 * buckets, 8).select("id", F.floor(F.col("id") / 40).alias("p"), F.lit(3).alias("v"))
        assert upsert_table(spark, path, new, "id").count() == 25 * buckets  # no key is there: nothing is rewritten
        assert ST.version_info(spark, path)["run"]["rewritten"] == 0
    assert opened[20] == opened[200] == {"opened": 1, "rewritten": 1}


def test_big_batches_use_ranges_only(spark, monkeypatch):
    monkeypatch.setattr(ST, "MAX_HASHES", 3)
    path = work_dir(spark, "t")
    upsert_table(spark, path, spark.range(100).select("id", F.floor(F.col("id") / 10).alias("p")), "id", "p")
    out = upsert_table(spark, path, spark.range(15, 25).select("id", F.lit(77).cast("bigint").alias("p")), "id")
    assert out.count() == 100 and out.where("p = 77").count() == 10
    assert ST.version_info(spark, path)["run"] == {"opened": 2, "rewritten": 2}


def test_null_keys_and_odd_partition_values(spark):
    path = work_dir(spark, "t")
    t = spark.createDataFrame([(None, "a/b c%", 1), ("x", None, 2), ("y", "é+", 3)], "k string, p string, v int")
    upsert_table(spark, path, t, "k", "p")
    out = upsert_table(spark, path, spark.createDataFrame([(None, "a/b c%", 9), ("y", "q", 8)], t.schema), "k")
    assert rows(out, "k", "p", "v") == rows(spark.createDataFrame([(None, "a/b c%", 9), ("x", None, 2), ("y", "q", 8)], t.schema), "k", "p", "v")


def test_a_run_is_seen_whole_or_not_at_all(spark):
    path = work_dir(spark, "t")
    old = spark.range(10).select("id", F.lit(0).alias("p"))
    replace_table(spark, path, old, "id", "p")
    ST._write(spark.range(5).select("id", F.lit(0).alias("p")), path, ["id"], "p", ["id"], 100)  # a run that died before its version
    assert read_table(spark, path).count() == 10
    with pytest.raises(ValueError):
        replace_table(spark, path, old.union(old), "id", "p")
    assert read_table(spark, path).count() == 10 and ST.versions(spark, path) == [0]
    replace_table(spark, path, old.where("id < 3"), "id", "p")
    assert read_table(spark, path).count() == 3 and read_table(spark, path, version=0).count() == 10
    info = ST.version_info(spark, path)
    with pytest.raises(RuntimeError):  # a run that began before another one ended
        ST._commit(spark, path, info["number"], info)
    assert vacuum_table(spark, path, keep=1) == 3 and read_table(spark, path).count() == 3
    assert ST.versions(spark, path) == [1]


def test_compaction_and_clustered_reads(spark):
    path = work_dir(spark, "t")
    day = dt.date(2024, 1, 1)
    for i in range(4):
        batch = spark.range(i * 100, i * 100 + 100).select("id", F.date_add(F.lit(day), (F.col("id") % 5).cast("int")).alias("d"))
        upsert_table(spark, path, batch, "id", "d", cluster=["d", "id"])
    before, n = rows(read_table(spark, path), "id", "d"), ST._files(spark, path, ST.version_info(spark, path)).count()
    compact_table(spark, path, file_rows=200)
    assert rows(read_table(spark, path), "id", "d") == before
    after = ST._files(spark, path, ST.version_info(spark, path)).count()
    assert n >= 20 and after < n / 2
    one = read_table(spark, path, where={"d": (dt.date(2024, 1, 2), dt.date(2024, 1, 2))})
    assert one.count() == 80 and all("_p=2024-01-02" in f for f in one.inputFiles())
    assert read_table(spark, path, where={"id": (395, None)}).count() == 5
    assert read_table(spark, path, where={"id": (1000, None)}).count() == 0


def test_empty_batches_and_tables(spark):
    path = work_dir(spark, "t")
    assert read_table(spark, path) is None and compact_table(spark, path) is None
    none = spark.createDataFrame([], "id int, p int")
    assert upsert_table(spark, path, none, "id", "p").count() == 0
    assert upsert_table(spark, path, spark.createDataFrame([(1, 1)], none.schema), "id").count() == 1
    assert upsert_table(spark, path, none, "id").count() == 1
