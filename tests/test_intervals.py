"""Runs of numbers against plain sets; counters against replays; raw ingestion."""
from __future__ import annotations

import datetime as dt
import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import intervals as IV
from ledgerlake.operators.incremental import count_once
from ledgerlake.sources import read_raw, registered_files
from ledgerlake.streaming import ingest_stream, work_dir


def as_set(runs):
    rows = [(r.lo, r.hi) for r in runs.collect()]
    out = [n for lo, hi in rows for n in range(lo, hi + 1)]
    assert len(out) == len(set(out)) and all(lo <= hi for lo, hi in rows)
    return set(out), sorted(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_equal_sets(spark, seed):
    r = random.Random(seed)
    a = [r.randint(-50, 400) for _ in range(300)] + list(range(32_700, 32_900)) + list(range(65_000, 66_000)) + [None]
    b = [r.randint(-60, 420) for _ in range(200)] + list(range(32_760, 32_780)) + [65_000, 65_999]
    ra, rb = (IV.number_runs(spark.createDataFrame([(x,) for x in xs], "n bigint").repartition(5), "n") for xs in (a, b))
    sa, rows = as_set(ra)
    assert sa == set(a) - {None} and all(x[1] + 1 < y[0] for x, y in zip(rows, rows[1:]))
    for stretch in (7, IV.STRETCH):
        assert as_set(IV.subtract_runs(ra, rb, stretch))[0] == set(a) - {None} - set(b)
    left = sorted(set(a) - {None} - set(b), reverse=True)
    for n in (1, 40, 10 ** 6):
        assert sorted((x.block_number for x in IV.ledger_backlog(ra, rb, n).collect()), reverse=True) == left[:n]
    pieces = spark.createDataFrame([(0, 9), (5, 20), (21, 30), (40, 39), (2, 3), (50, 60)], IV.RUNS)
    assert as_set(IV.merge_runs(pieces))[1] == [(0, 30), (50, 60)]


def test_a_billion_numbers_without_a_billion_rows(spark):
    spine = IV.one_run(spark, 0, 10 ** 9 - 1)
    ledger = spark.createDataFrame([(0, 499_999_999), (500_000_003, 999_999_899), (999_999_950, 10 ** 9 + 5)], IV.RUNS)
    left = IV.subtract_runs(spine, ledger)
    assert IV.count_numbers(left).first().n == 3 + 50
    assert sorted(x.block_number for x in IV.newest_numbers(left, 51).collect())[:2] == [500_000_002, 999_999_900]
    none = spark.createDataFrame([], IV.RUNS)
    assert IV.count_numbers(IV.subtract_runs(spine, none)).first().n == 10 ** 9 and IV.subtract_runs(none, spine).count() == 0
    assert IV.number_runs(none, "lo").count() == 0


def test_a_replayed_run_counts_once(spark):
    path = work_dir(spark, "c")
    runs = {"r1": [("a", 2, 5), ("b", 1, 7)], "r2": [("a", 3, 4), ("c", 1, 1)]}
    for run in ("r1", "r2", "r2", "r1"):
        batch = spark.createDataFrame(runs[run], "k string, n bigint, at int")
        out = count_once(spark, path, batch, "k", ["n"], {"at": "at"}, run_id=run)
    assert sorted(map(tuple, out.collect())) == [("a", 5, 5), ("b", 1, 7), ("c", 1, 1)]


LINE = '{"partition_key":%d,"value":{"BLOCK_NUMBER":%d},"data":%s,"metadata":null}\n'


def test_only_registered_files_are_opened(spark, tmp_path):
    root = tmp_path / "raw"
    (root / "d").mkdir(parents=True)
    for n in (1, 2, 3):
        (root / "d" / f"{n}.json").write_text(LINE % (n, n, '{"result":{}}'))
    with gzip.open(root / "d" / "4.json.gz", "wt") as f:
        f.write(LINE % (4, 4, '{"result":{}}'))
    (root / "d" / "broken.json.gz").write_bytes(b"no gzip at all")  # whoever opens it fails
    t = [dt.datetime(2024, 1, i) for i in (1, 2, 3)]
    names = [("d/1.json", t[0]), (f"file://{root}/d/2.json", t[1]), ("/d/4.json.gz", t[2]), ("d/2.json", t[2]), ("d/gone.json", t[2])]
    manifest = spark.createDataFrame(names, "file_name string, _inserted_timestamp timestamp_ntz")
    got = read_raw(spark, str(root), "blocks", manifest=manifest).collect()
    assert sorted((r.block_number, r._inserted_timestamp) for r in got) == [(1, t[0]), (2, t[2]), (4, t[2])]
    recent = read_raw(spark, str(root), "blocks", since=dt.timedelta(days=1), now=t[2], manifest=manifest)
    assert sorted(r.block_number for r in recent.collect()) == [2, 4]
    report = registered_files(spark, str(root), manifest).collect()
    assert sorted((r.file_name, r.present) for r in report) == [("d/1.json", True), ("d/2.json", True), ("d/4.json.gz", True), ("d/gone.json", False)]
    with pytest.raises(Exception):
        read_raw(spark, str(root), "blocks").collect()
    assert read_raw(spark, str(root), "blocks", manifest=manifest.limit(0)).count() == 0


def test_raw_stream_with_broken_lines_and_restart(spark, tmp_path):
    root, base = tmp_path / "raw", work_dir(spark, "s")
    root.mkdir()
    args = (spark, str(root), "confirm_blocks", f"{base}/bronze", f"{base}/quarantine", f"{base}/ckpt")
    assert ingest_stream(*args) == (None, None)
    deep = json.dumps(0)
    for _ in range(1500):
        deep = '{"a":%s}' % deep
    (root / "1000_1.json").write_text(LINE % (1000, 1001, '{"result":{}}') + "not json\n" + LINE % (1000, 1002, '{"error":1}') + "[1]\n\n"
                                      + '{"value":{"x":1},"data":{"result":1}}\n' + LINE % (1000, 1003, deep))
    good, bad = ingest_stream(*args)
    assert sorted((r.block_number, r.partition_key) for r in good.collect()) == [(1001, 1000), (1003, 1000)]
    want = [("failed", 1002), ("no block number", None), ("unreadable", None), ("unreadable", None)]
    assert sorted((r.reason, json.loads(r.value)["value"].get("BLOCK_NUMBER") if r.value[0] == "{" else None) for r in bad.collect()) == want
    (root / "2000_1.json").write_text('{"value":{"block_number":2001},"data":{"result":{}}}\n{"cut":\n')
    for _ in range(2):  # the second run finds nothing new
        good, bad = ingest_stream(*args)
        assert sorted((r.block_number, r.partition_key) for r in good.collect()) == [(1001, 1000), (1003, 1000), (2001, 2000)]
        assert bad.count() == 5 and dict(bad.groupBy("batch").count().collect()) == {0: 4, 1: 1}
