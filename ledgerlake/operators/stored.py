"""Stored tables without a table format (W1-W8): Parquet files and a version file that names them.

    <path>/data/<run>/_p=<part>/*.parquet   rows; a file is never changed once written
    <path>/files/<run>                      what a version consists of: a row per data file with its rows and
                                            the smallest and largest value of key and cluster columns
    <path>/blooms/<run>                     a Bloom filter of the keys of each file the run wrote
    <path>/versions/<number>.json           the schema, and which run's file list holds

A run writes its files first and its version file last, by a rename that fails if the number is
taken: readers see a run whole or not at all, a run that dies leaves the version before it as it
was, and of two runs at once one is refused. What is kept beside the rows buys three things:

* columns: the schema lives in the version, so a batch with fewer, more or wider columns neither
  loses what other rows hold nor hides columns that older files lack;
* upserts that read what the batch may touch: a file is opened only if the range of its keys meets
  the batch's and its filter holds one of the batch's keys (filters are tested in tasks, for batches of
  up to `MAX_HASHES` keys; beyond that ranges alone decide), and rewritten only if a key is really there;
* clustered reads: files are cut by partition value, range-sorted within it, bounded in rows,
  and `read_table(where=...)` lists those alone whose ranges meet the bounds.

The driver holds paths of candidate files and one JSON text; keys, rows and filters stay in tasks,
but for the batch's key hashes, whose number is measured first.
"""
from __future__ import annotations

import json
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists, shuffles_removed, stored_once
from .joins import join_keys
from .latest import latest_per_key
from .sinks import upsert

FILE_ROWS = 1_000_000
FOLDERS, FOLDER_ROWS = 500, 50_000  # a run writes FOLDERS folders, or one for FOLDER_ROWS of its rows if those are more
MAX_HASHES = 1_000_000  # 8 MB
BITS_PER_KEY, PROBES = 16, 4
_WIDER = [["tinyint", "smallint", "int", "bigint"], ["float", "double"], ["tinyint", "smallint", "int", "double"],
          ["date", "timestamp_ntz"]]


# ---- versions ---------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the table's versions, oldest first; none if there is no table."""
    folder, fs = _fs(spark, f"{path}/versions")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def version_info(spark: SparkSession, path: str, number: int | None = None) -> dict | None:
    """What the version file says: number, schema, key, files, run (counts of the run that made it)."""
    if number is None:
        known = versions(spark, path)
        if not known:
            return None
        number = known[-1]
    text = spark.read.option("wholetext", "true").text(f"{path}/versions/{number:08d}.json").first()[0]
    return {"number": number, **json.loads(text)}


def _commit(spark: SparkSession, path: str, number: int, info: dict) -> None:
    jvm = spark._jvm
    temp, fs = _fs(spark, f"{path}/versions/.{uuid.uuid4().hex}.tmp")
    out = fs.create(temp, False)
    out.write(json.dumps(info).encode())
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(temp.toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(fs.makeQualified(temp), fs.makeQualified(_fs(spark, f"{path}/versions/{number:08d}.json")[0]), none)
    except Exception as e:
        fs.delete(temp, False)
        raise RuntimeError(f"{path}: another run has written version {number}") from e


def stored_schema(info: dict) -> T.StructType:
    return T.StructType.fromJson(info["schema"])


def merged_schema(old: T.StructType, new: T.StructType, keys: list[str] = ()) -> T.StructType:
    """The old columns, then new ones; where types differ, the wider of the two."""
    def wider(name: str, a: T.DataType, b: T.DataType) -> T.DataType:
        if a == b:
            return a
        x, y = a.simpleString(), b.simpleString()
        for row in _WIDER[:1] if name in keys else _WIDER:  # a key must keep its text, which is what is hashed
            if x in row and y in row:
                return a if row.index(x) > row.index(y) else b
        raise TypeError(f"column {name} is stored as {x}, the batch has {y}")
    types = {f.name: f.dataType for f in new.fields}
    out = [T.StructField(f.name, wider(f.name, f.dataType, types[f.name]) if f.name in types else f.dataType) for f in old.fields]
    return T.StructType(out + [T.StructField(f.name, f.dataType) for f in new.fields if f.name not in old.names])


def _as(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` in the columns and types of `schema`; what it lacks is null."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


# ---- files ------------------------------------------------------------------------

def _key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def _slots(h: np.ndarray, size: int) -> list[np.ndarray]:
    h = h.view(np.uint64)
    low, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return [(low + np.uint64(i) * step) & np.uint64(size - 1) for i in range(PROBES)]


def _bloom(part: pd.DataFrame) -> pd.DataFrame:
    """One file's filter (a file has at most `FILE_ROWS` rows)."""
    size = 1 << max(10, int(len(part) * BITS_PER_KEY - 1).bit_length())
    bits = np.zeros(size, bool)
    for s in _slots(part["h"].to_numpy(), size):
        bits[s] = True
    return pd.DataFrame({"fid": part["fid"].iloc[:1], "bits": [np.packbits(bits).tobytes()]})


def _may_hold(hashes: np.ndarray):
    def run(batches):
        for b in batches:
            keep = []
            for i, raw in enumerate(b.column("bits").to_pylist()):
                bits = np.unpackbits(np.frombuffer(raw, np.uint8)).view(bool)
                left = hashes
                for j in range(PROBES):
                    left = left[bits[_slots(left, len(bits))[j]]]
                if len(left):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([b.column("fid").take(pa.array(keep, pa.int64()))], names=["fid"])
    return run


def _folder(df: DataFrame, partition_col: str, values: DataFrame) -> Column:
    """The folder of a row: its partition value, or the first of a range of whole numbers if there are more values than
    folders that the rows fill. Files know the range of their values, which is what reads go by."""
    value = F.col(partition_col)
    if not isinstance(df.schema[partition_col].dataType, T.IntegralType):
        return value.cast("string")
    r = values.agg(F.count(F.lit(1)).alias("n"), F.min(partition_col).alias("lo"), F.max(partition_col).alias("hi")).first()
    few = max(FOLDERS, r["n"] // FOLDER_ROWS)
    bits = 0 if r["lo"] is None else (-(-(r["hi"] - r["lo"] + 1) // few) - 1).bit_length()
    value = value.cast("bigint")
    return F.shiftleft(F.shiftright(value, bits), bits).cast("string") if bits else value.cast("string")


def _write(df: DataFrame, path: str, keys: list[str], partition_col: str | None, cluster: list[str], file_rows: int,
           values: DataFrame | None = None) -> tuple[str, DataFrame]:
    """Write rows as a run of their own; the run's name and a row per file. `values`: what the partition values are
    among, if that is read with less work than the rows."""
    spark, run = df.sparkSession, uuid.uuid4().hex
    part = F.coalesce(_folder(df, partition_col, df if values is None else values), F.lit("null")) if partition_col else F.lit("all")
    rows = df.withColumn("_p", F.regexp_replace(part, "[^A-Za-z0-9.-]", "_"))  # a folder's name; the column itself is in the files
    (rows.repartitionByRange("_p", *cluster).sortWithinPartitions("_p", *cluster).write.options(maxRecordsPerFile=file_rows, compression="zstd")
     .partitionBy("_p").parquet(f"{path}/data/{run}"))
    file = F.concat(F.lit(f"{run}/"), F.substring_index("_metadata.file_path", f"/{run}/", -1))
    new = spark.read.schema(df.schema).parquet(f"{path}/data/{run}").select("*", file.alias("_file"))
    new = new.withColumn("fid", F.xxhash64("_file"))
    (new.select("fid", _key_hash(keys).alias("h")).groupBy("fid").applyInPandas(_bloom, "fid bigint, bits binary")
     .write.parquet(f"{path}/blooms/{run}"))
    watched = dict.fromkeys([*keys, *([partition_col] if partition_col else []), *cluster])
    return run, new.groupBy("fid").agg(
        F.first("_file").alias("file"), F.lit(run).alias("run"), F.count(F.lit(1)).alias("rows"),
        *[F.min(c).alias(f"lo_{c}") for c in watched], *[F.max(c).alias(f"hi_{c}") for c in watched])


def _files(spark: SparkSession, path: str, info: dict) -> DataFrame:
    return spark.read.parquet(f"{path}/files/{info['files']}")


def _meets(files: DataFrame, col: str, lo, hi) -> Column:
    """Files that may hold a value from lo to hi (either None: open)."""
    if f"lo_{col}" not in files.columns:
        return F.lit(True)
    fits = F.lit(True)
    if lo is not None:
        fits = fits & (F.col(f"hi_{col}") >= F.lit(lo))
    if hi is not None:
        fits = fits & (F.col(f"lo_{col}") <= F.lit(hi))
    return F.coalesce(fits, F.lit(True))  # a file without values is not ruled out


def _rows_of(spark: SparkSession, path: str, schema: T.StructType, files: list[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/{f}" for f in files])


def read_table(spark: SparkSession, path: str, where: dict[str, tuple] | None = None, version: int | None = None) -> DataFrame | None:
    """The table as of its newest (or the given) version, None if there is none.

    `where` maps columns to (lowest, highest) values, either of them None: only files that may
    hold such rows are listed and opened, and only such rows returned.
    """
    info = version_info(spark, path, version)
    if info is None:
        return None
    files = _files(spark, path, info)
    for c, (lo, hi) in (where or {}).items():
        files = files.where(_meets(files, c, lo, hi))
    rows = _rows_of(spark, path, stored_schema(info), [r[0] for r in files.select("file").collect()])
    for c, (lo, hi) in (where or {}).items():
        rows = rows.where(F.col(c) >= F.lit(lo)) if lo is not None else rows
        rows = rows.where(F.col(c) <= F.lit(hi)) if hi is not None else rows
    return rows


# ---- runs -------------------------------------------------------------------------

def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _publish(spark, path: str, info: dict | None, schema: T.StructType, keys: list[str], partition_col: str | None, cluster: list[str],
             run: str, files: DataFrame, report: dict, run_id: str | None = None) -> None:
    files.write.parquet(f"{path}/files/{run}")
    applied = [*(info or {}).get("applied", []), *([run_id] if run_id is not None else [])]
    _commit(spark, path, 0 if info is None else info["number"] + 1, {
        "schema": schema.jsonValue(), "key": keys, "partition": partition_col, "cluster": cluster, "files": run, "run": report,
        "applied": applied})


def _one_row_a_key(df: DataFrame, keys: list[str]) -> None:
    if not df.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"the batch repeats a key of {keys}: name the order that picks one row")


def replace_table(spark: SparkSession, path: str, df: DataFrame, key, partition_col: str | None = None, cluster=None, order=None,
                  file_rows: int = FILE_ROWS, run_id: str | None = None) -> DataFrame:
    """Make `df` the whole table. Readers see the old table until the new one is complete; old versions stay readable."""
    keys, info = _keys(key), version_info(spark, path)
    cluster = list(cluster or keys)
    if order is not None:
        df = latest_per_key(df, keys, order)
    with shuffles_removed(spark):
        run, files = _write(df, path, keys, partition_col, cluster, file_rows)
        _one_row_a_key(spark.read.schema(df.schema).parquet(f"{path}/data/{run}"), keys)
        _publish(spark, path, info, df.schema, keys, partition_col, cluster, run, files, {"replaced": True}, run_id)
    return read_table(spark, path)


def _candidates(spark: SparkSession, path: str, info: dict, batch: DataFrame, keys: list[str]) -> list[str]:
    """Files that may hold a key of the batch."""
    files = _files(spark, path, info)
    r = batch.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{n}_{c}") for c in keys for n, f in (("lo", F.min), ("hi", F.max))],
                  *[F.count(c).alias(f"n_{c}") for c in keys]).first()
    for c in keys:
        if r[f"n_{c}"] == r["n"]:  # a null key has no place in a range
            files = files.where(_meets(files, c, r[f"lo_{c}"], r[f"hi_{c}"]))
    if r["n"] <= MAX_HASHES:
        hashes = batch.select(_key_hash(keys).alias("h")).toArrow().column("h").to_numpy()
        runs = [x[0] for x in files.select("run").distinct().collect()]
        if not runs:
            return []
        blooms = spark.read.parquet(*[f"{path}/blooms/{x}" for x in runs]).join(files.select("fid"), "fid", "left_semi")
        files = files.join(blooms.select("fid", "bits").mapInArrow(_may_hold(hashes), "fid bigint"), "fid", "left_semi")
    return [x[0] for x in files.select("file").collect()]


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, key, partition_col: str | None = None, mode: str = "replace_key",
                 keep_existing: list[str] | None = None, order=None, competing: bool = False, cluster=None,
                 file_rows: int = FILE_ROWS, run_id: str | None = None) -> DataFrame:
    """Apply `batch` to the stored table by `key`; returns the table.

    Rows of the batch take the place of stored rows of their keys, wherever those lie. `merge`
    keeps the stored values of `keep_existing` and of columns that the batch lacks. `order` picks
    one of the rows of a key; without it a batch that repeats a key is refused. `competing`:
    stored rows stand for election under `order`. Applying a batch again gives the same rows.
    With a `run_id`, which the version records, a run that was applied before changes nothing.
    """
    keys, info = _keys(key), version_info(spark, path)
    if info is None:
        return replace_table(spark, path, batch, keys, partition_col, cluster, order, file_rows, run_id)
    if run_id is not None and run_id in info["applied"]:
        return read_table(spark, path)
    partition_col, cluster = partition_col or info["partition"], list(cluster or info["cluster"])
    schema = merged_schema(stored_schema(info), batch.schema, keys)
    lacking = [f.name for f in schema.fields if f.name not in batch.columns]
    if order is not None:
        batch = latest_per_key(batch, keys, order)
    with shuffles_removed(spark), stored_once(_as(batch, schema), "batch") as rows:
        _apply(spark, path, info, schema, rows, keys, partition_col, mode, keep_existing, lacking, order, competing, cluster,
               file_rows, run_id)
    return read_table(spark, path)


def _apply(spark: SparkSession, path: str, info: dict, schema: T.StructType, batch: DataFrame, keys: list[str], partition_col: str | None,
           mode: str, keep_existing: list[str] | None, lacking: list[str], order, competing: bool, cluster: list[str], file_rows: int,
           run_id: str | None) -> None:
    """Write the version that `batch`, in the columns of `schema`, makes of the one that `info` describes."""
    if order is None:
        _one_row_a_key(batch, keys)
    may = _candidates(spark, path, info, batch, keys)
    stored = _rows_of(spark, path, schema, may)
    held = []
    if may:
        file = F.substring_index(F.col("_metadata.file_path"), "/data/", -1)
        held = [r[0] for r in join_keys(stored.select(*keys, file.alias("_file")), batch.select(*keys), keys, "left_semi", null_safe=True)
                .select("_file").distinct().collect()]
    target, came = _rows_of(spark, path, schema, held), batch
    if competing:
        batch = batch.unionByName(join_keys(target, batch.select(*keys), keys, "left_semi", null_safe=True))
    if mode == "merge":
        keep_existing = [*(keep_existing or []), *lacking]
    new = upsert(target if held else None, batch, keys, mode, keep_existing, order=order, checked=not competing)
    values = came.select(partition_col).union(target.select(partition_col)) if partition_col else None
    run, added = _write(_as(new, schema), path, keys, partition_col, cluster, file_rows, values)
    before = _files(spark, path, info)
    gone = before.where(F.col("file").isin(held)) if held else before.limit(0)
    kept = before.join(gone.select("fid"), "fid", "left_anti")
    _publish(spark, path, info, schema, keys, partition_col, cluster, run, kept.unionByName(added, allowMissingColumns=True),
             {"opened": len(may), "rewritten": len(held)}, run_id)


def read_keys(spark: SparkSession, path: str, keyed: DataFrame, key) -> DataFrame | None:
    """Stored rows of the keys in `keyed`, from the files alone that may hold them; None if there is no table."""
    keys, info = _keys(key), version_info(spark, path)
    if info is None:
        return None
    rows = _rows_of(spark, path, stored_schema(info), _candidates(spark, path, info, keyed.select(*keys), keys))
    return join_keys(rows, keyed.select(*keys).distinct(), keys, "left_semi", null_safe=True)


def compact_table(spark: SparkSession, path: str, file_rows: int = FILE_ROWS) -> DataFrame | None:
    """Put files of less than half of `file_rows` together, where a partition has more than one of them."""
    info = version_info(spark, path)
    if info is None:
        return None
    files = _files(spark, path, info)
    place = F.substring_index(F.substring_index("file", "/", -2), "/", 1)
    small = files.withColumn("place", place).where(F.col("rows") < file_rows // 2)
    many = small.groupBy("place").count().where("count > 1")
    chosen = [r[0] for r in small.join(many, "place", "left_semi").select("file").collect()]
    if not chosen:
        return read_table(spark, path)
    schema = stored_schema(info)
    with shuffles_removed(spark):
        run, added = _write(_rows_of(spark, path, schema, chosen), path, info["key"], info["partition"], info["cluster"], file_rows)
        kept = files.where(~F.col("file").isin(chosen))
        _publish(spark, path, info, schema, info["key"], info["partition"], info["cluster"], run,
                 kept.unionByName(added, allowMissingColumns=True), {"compacted": len(chosen)})
    return read_table(spark, path)


def vacuum_table(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete what no version among the newest `keep` needs, and the older versions; the number of runs deleted."""
    known = versions(spark, path)
    old, new = known[:-keep], known[-keep:]
    used = {i["files"] for i in (version_info(spark, path, n) for n in new)}
    used |= {r[0] for u in list(used) for r in spark.read.parquet(f"{path}/files/{u}").select("run").distinct().collect()}
    for n in old:
        p, fs = _fs(spark, f"{path}/versions/{n:08d}.json")
        fs.delete(p, False)
    deleted = 0
    for kind in ("data", "files", "blooms"):
        folder, fs = _fs(spark, f"{path}/{kind}")
        for s in fs.listStatus(folder) if fs.exists(folder) else []:
            if s.getPath().getName() not in used:
                deleted += fs.delete(s.getPath(), True) and kind == "data"
    return deleted


def table_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/versions") and bool(versions(spark, path))
