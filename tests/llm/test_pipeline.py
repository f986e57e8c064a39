"""The pipeline's stages against brute force on a small table."""
from __future__ import annotations

import collections

from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import classifier, simhash
from ledgerlake.llm.common import stored

from .test_corpus_operators import DOC, ODD, SF, brute_groups, brute_lines, check_packed


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_duplicates", "source_mix", "best_fit_packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stored(stage(spark, seen[-1], SF)))
    assert all(d.columns == columns for d in seen[:-1])
    start, good, lined, single, mixed, packed = ([tuple(r) for r in d.collect()] for d in seen)
    model = classifier.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r["_row"].doc_id for r in classifier.classify(docs, model).collect() if r.score >= 0.3}
    assert {r[0] for r in good} == kept and set(good) <= set(start)
    want = brute_lines([(r[0], r[1]) for r in good])
    assert {r[0]: r[1] for r in lined} == {i: t for (i, _), t in want.items()}
    groups = brute_groups([(r[0], r[1]) for r in lined])
    assert sorted(str(r[0]) for r in single) == sorted({c for _, _, c in groups})
    times = collections.Counter(mixed)
    assert set(mixed) <= set(single) and max(times.values()) <= 2
    check_packed(seen[-1].collect(), [(r[0], r[1]) for r in mixed])


def test_odd_and_empty_tables(spark):
    odd = spark.createDataFrame(ODD, DOC).withColumns({c: F.lit(1) for c in ("score", "copies", "lines", "size", "node")})
    docs, empty = odd, odd.limit(0)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs, empty = stored(stage(spark, docs, SF)), stored(stage(spark, empty, SF))
        if i < 4:
            assert docs.columns == odd.columns
        assert docs.count() > 0 and empty.count() == 0


def test_one_row_of_repeated_rows(spark):
    df = spark.createDataFrame([(1, "same words in here"), (1, "same words in here"), (None, "same words in here"),
                                (None, "other words over there"), (None, "other words over there")], "doc_id bigint, text string")
    got = sorted(str(r.doc_id) for r in simhash.keep_one_each(df).collect())
    assert got == ["1", "None"]
