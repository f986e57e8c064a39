"""Raw envelope readers.

A raw record is one JSON line {partition_key, value, data, metadata} written by
the fetcher under `<root>/<entity>/<partition_key>_<n>.json`. Records become
rows with VARIANT columns plus provenance from the file metadata columns.
"""
from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import jget, jnode
from ..functions.jsontext import members
from ..functions.keys import path_partition_key
from ..operators.explode import computed_once

# The five raw entities of the reference and their extra key.
RAW_ENTITIES = {
    "blocks": {},
    "transactions": {},
    "receipts_by_hash": {"tx_hash": "$.TX_HASH"},
    "traces": {},
    "confirm_blocks": {},
}

ENVELOPE = ["partition_key", "value", "data", "metadata", "data_text", "file_name", "_inserted_timestamp", "line_hash"]


_DEEP = T.StructType([*[T.StructField(c, T.StringType()) for c in ("partition_key", "value", "data", "metadata")],
                      T.StructField("failed", T.BooleanType())])


@F.pandas_udf(_DEEP)
def _deep_record(text: pd.Series) -> pd.DataFrame:
    """Members of a record that VARIANT cannot hold (too deep), as text; nulls for what is no record."""
    rows = []
    for t in text:
        rec = members(t) if t else None
        data = members(rec["data"]) if rec and "data" in rec else None
        rows.append(tuple((rec or {}).get(k) for k in ("partition_key", "value", "data", "metadata"))
                    + (None if data is None else "error" in data,))
    return pd.DataFrame(rows, columns=["partition_key", "value", "data", "metadata", "failed"])


# a record that nests deeper than VARIANT parses (1,000 levels) opens and closes as many brackets
_DEEP_CHARS = 2000


def envelope_from_text(df: DataFrame, text: str = "value", file_name: Column | None = None,
                       inserted: Column | None = None) -> DataFrame:
    """JSON-line text -> (partition_key, value, data, metadata VARIANT, data_text, file_name, _inserted_timestamp, line_hash).

    A record too deep for VARIANT keeps its payload in `data_text` (null for all others); a
    line that is no JSON gives no row, see `unreadable`. Records are parsed once, in the JVM.
    Only long lines that VARIANT refuses travel to Python, by a scan of their own that drops all others.
    """
    raw = F.col(text)
    where_from = [(file_name if file_name is not None else F.lit(None).cast("string")).alias("file_name"),
                  (inserted if inserted is not None else F.lit(None).cast("timestamp_ntz")).alias("_inserted_timestamp"),
                  F.xxhash64(raw).alias("line_hash")]
    # the filters that follow see the parsed record and its members, and do not take the line apart again
    read = computed_once(df.select(raw.alias("_raw"), *where_from), "_rec", F.try_parse_json("_raw")).where("_rec is not null")
    rec, part = F.col("_rec"), F.col("_part")
    read = computed_once(read, "_part", F.struct(jget(rec, "$.partition_key", "int").alias("partition_key"),
                                                 *[jnode(rec, f"$.{c}").alias(c) for c in ("value", "data", "metadata")]))
    flat = read.select(*[part[c].alias(c) for c in ("partition_key", "value", "data", "metadata")],
                       F.lit(None).cast("string").alias("data_text"), "file_name", "_inserted_timestamp", "line_hash")
    refused = df.where((F.length(raw) > _DEEP_CHARS) & F.try_parse_json(raw).isNull())
    long = refused.select(*where_from, _deep_record(raw).alias("_deep"))
    deep = F.col("_deep")
    payload = F.when(~F.coalesce(deep["failed"], F.lit(False)), deep["data"])
    long = long.select(F.regexp_replace(deep["partition_key"], '"', "").try_cast("int").alias("partition_key"),
                       *[F.try_parse_json(deep[c]).alias(c) for c in ("value", "data", "metadata")],
                       payload.alias("data_text"), "file_name", "_inserted_timestamp", "line_hash")
    return flat.union(long)


def unreadable(df: DataFrame, text: str = "value") -> DataFrame:
    """The rows whose text is no JSON object: what a run should report instead of losing."""
    raw = F.col(text)
    read = df.select("*", F.explode_outer(F.array(F.try_parse_json(raw))).alias("_rec"))
    other = read.where(F.col("_rec").isNotNull() & ~F.schema_of_variant("_rec").startswith("OBJECT")).drop("_rec")
    refused = read.where("_rec is null").drop("_rec")
    short = refused.where(F.length(raw) <= _DEEP_CHARS)
    long = refused.where(F.length(raw) > _DEEP_CHARS).withColumn("_deep", _deep_record(raw))
    found = F.coalesce(F.col("_deep.data"), F.col("_deep.value"), F.col("_deep.partition_key")).isNotNull()
    return other.union(short).union(long.where(~found).drop("_deep"))


def resolve_block_number(df: DataFrame, full_scan: bool = False) -> DataFrame:
    """First non-null of the record key, (full scan: lower-case key), the request id,
    and the id inside a stringified request; as INT (S7)."""
    cands = [jget("value", "$.BLOCK_NUMBER", "string")]
    if full_scan:
        cands.append(jget("value", "$.block_number", "string"))
    cands += [jget("metadata", "$.request.data.id", "string"),
              jget(F.try_parse_json(jget("metadata", "$.request.data", "string")), "$.id", "string")]
    return df.withColumn("block_number", F.coalesce(*cands).try_cast("int"))


def drop_failed(df: DataFrame) -> DataFrame:
    """Keep payloads without an `error` key (a JSON null error drops too)."""
    fine = F.col("data").isNotNull() & jnode("data", "$.error").isNull()
    return df.where(fine | F.col("data_text").isNotNull() if "data_text" in df.columns else fine)


def extract_key(df: DataFrame, name: str, path: str, type_: str = "string") -> DataFrame:
    """Entity-specific key from the record."""
    return df.withColumn(name, jget("value", path, type_))


def bronze(envelope: DataFrame, entity: str, full_scan: bool = False) -> DataFrame:
    """Envelope -> bronze view of one entity: keys resolved, failures dropped."""
    out = drop_failed(resolve_block_number(envelope, full_scan))
    for name, path in RAW_ENTITIES[entity].items():
        out = extract_key(out, name, path)
    return out


def _relative(path: Column, root: str) -> Column:
    """A file's path below `root`, whatever scheme it is written with; paths that are relative already stay."""
    at = F.locate(root, path)
    return F.ltrim(F.when(at > 0, F.substring(path, at + len(root), F.length(path))).otherwise(path), F.lit("/"))


def _root_path(spark: SparkSession, root: str) -> str:
    return spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/") + "/"


def registered_files(spark: SparkSession, root: str, manifest: DataFrame, since: dt.datetime | None = None) -> DataFrame:
    """file_name, registered_at, present of every file the manifest names (from `since` on, by registration).

    The folder is listed by Spark, no file is opened. A file registered twice counts once, with its newest stamp.
    """
    m = manifest if since is None else manifest.where(F.col("_inserted_timestamp") >= F.lit(since))
    base = _root_path(spark, root)
    named = (m.select(_relative(F.col("file_name"), base).alias("file_name"), "_inserted_timestamp")
             .groupBy("file_name").agg(F.max("_inserted_timestamp").alias("registered_at")))
    there = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select(_relative(F.col("path"), base).alias("file_name")).distinct())
    return named.join(there.withColumn("present", F.lit(True)), "file_name", "left").withColumn("present", F.col("present").isNotNull())


def _lines(reader, paths) -> DataFrame:
    return reader.text(paths).where("value <> ''").select("value", F.col("_metadata.file_path").alias("_path"),
                                                           F.col("_metadata.file_modification_time").alias("_mtime"))


def read_raw(spark: SparkSession, path: str, entity: str, since: dt.timedelta | None = None,
             now: dt.datetime | None = None, manifest: DataFrame | None = None) -> DataFrame:
    """Scan raw JSON files of an entity.

    `since` limits the scan to files modified in the window: the `modifiedAfter`
    option prunes files at listing time, before any task runs (S2); None reads all (S3).
    With a `manifest` (file_name, _inserted_timestamp) exactly its files are read, those registered
    in the window if there is one, and rows carry the registration as their time; others are
    never opened. Names without a file are skipped: `registered_files` reports them.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    start = None
    if since is not None:
        now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        start = now - since
    if manifest is not None:
        files = registered_files(spark, path, manifest, start).where("present").drop("present")
        names = [f"{path.rstrip('/')}/{r[0]}" for r in files.select("file_name").toLocalIterator()]
        txt = _lines(spark.read, names) if names else spark.createDataFrame([], "value string, _path string, _mtime timestamp")
        rel = _relative(F.col("_path"), _root_path(spark, path))
        txt = (txt.withColumn("_rel", rel).join(files.withColumnRenamed("file_name", "_rel"), "_rel")
               .select("value", "_path", F.col("registered_at").alias("_mtime")))
    else:
        if start is not None:
            reader = reader.option("modifiedAfter", start.strftime("%Y-%m-%dT%H:%M:%S"))
        txt = _lines(reader, path)
    env = envelope_from_text(txt, "value", F.col("_path"), F.col("_mtime").cast("timestamp_ntz"))
    # partition key from the path (S4) where the record does not carry one
    env = env.withColumn("partition_key", F.coalesce(
        "partition_key", path_partition_key("file_name")))
    return bronze(env, entity, full_scan=since is None)


def join_manifest(raw: DataFrame, manifest: DataFrame) -> DataFrame:
    """Keep records of registered files only, on (file_name, partition_key) (S5), of a frame that is read already;
    `read_raw(manifest=...)` does not open other files in the first place.

    The manifest has one row per file; broadcast is safe only while that holds,
    so it is left to AQE, which broadcasts on measured size.
    """
    m = manifest.select("file_name", "partition_key", F.col("_inserted_timestamp").alias("_reg_ts"))
    out = raw.join(m, ["file_name", "partition_key"], "inner")
    return out.withColumn("_inserted_timestamp", F.coalesce("_reg_ts", "_inserted_timestamp")).drop("_reg_ts")
