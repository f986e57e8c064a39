"""Call trees.

A trace document is a nested tree: each node has fields and an optional array
of child nodes (`calls`). The reference flattens it with a recursive FLATTEN
and rebuilds addresses with regexes; here:

* `flatten_tree` opens each document in one narrow pass (no shuffle, no checkpoint, no depth
  limit): VARIANT documents level by level with array functions, all in the JVM; text, which
  may nest deeper than VARIANT does, by a walk in Python. Depth-first positions, child counts
  and flags inherited downwards (an error on the path fails a subtree) come out of the same
  pass, which answers the ancestry question of the reference without any join.
* `preorder_index`, `child_counts` and `ancestor_flag` work on a *flat* node
  table (address arrays), as the gold model reads it from silver.

Addresses: root = [] shown as 'ORIGIN'; child i of [a, b] is [a, b, i] shown
as 'a_b_i'; the parent of a top-level node is 'ORIGIN'.
"""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsontext import call_tree
from .joins import join_keys
from .numbering import number_within

ROOT = "ORIGIN"


def address_text(addr) -> Column:
    addr = F.col(addr) if isinstance(addr, str) else addr
    return F.when(F.array_size(addr) == 0, F.lit(ROOT)).otherwise(F.array_join(addr, "_"))


def parent_text(addr) -> Column:
    addr = F.col(addr) if isinstance(addr, str) else addr
    n = F.array_size(addr)
    return (F.when(n == 0, F.lit(None).cast("string"))
            .when(n == 1, F.lit(ROOT))
            .otherwise(F.array_join(F.slice(addr, 1, n - 1), "_")))


def strip_field(node: Column, field: str) -> Column:
    """The node object without one field (its children), still a VARIANT."""
    fields = F.try_variant_get(node, "$", "map<string,variant>")
    return F.to_variant_object(F.map_filter(fields, lambda k, v: k != field))


def _walk(n_keys: int, names: list[str], child_field: str, flags: tuple[str, ...], skip_field: str | None):
    def run(batches):
        for b in batches:
            found, held = [], 0
            for i, text in enumerate(b.column(n_keys)):
                text = text.as_py()
                if text is None:
                    continue
                for node in call_tree(text, child_field, flags, skip_field):
                    found.append((i, *node))
                    held += len(node[0]) + len(node[3]) + 1
                    if held > WALK_HELD:
                        yield packed(b, found)
                        found, held = [], 0
            if found:
                yield packed(b, found)

    def packed(b, found):
        at, address, kids, position, node, own = zip(*found)
        rows = pa.array(at, pa.int32())
        cols = [b.column(k).take(rows) for k in range(n_keys)]
        cols += [pa.array(address, pa.list_(pa.int32())), pa.array([len(x) for x in address], pa.int32()),
                 pa.array(kids, pa.int32()), pa.array(position, pa.int32()), pa.array(node, pa.string()),
                 *[pa.array([o[f] for o in own], pa.bool_()) for f in range(len(flags))]]
        return pa.RecordBatch.from_arrays(cols, names=names)
    return run


WALK_HELD = 1 << 20  # steps of addresses and characters of nodes sent at once: the addresses of a chain grow with its square
LEVELS, MAX_LEVELS = 16, 1024  # levels opened of every document, and of those that are deeper (VARIANT nests up to 1,000)


def _field(node: Column, name: str) -> Column:
    return F.try_variant_get(node, f"$['{name}']", "variant")


def _bound(value: Column, use) -> Column:
    """use(value) with `value` computed once: what a lambda names twice is computed twice."""
    return F.transform(F.array(value), use)[0]


def _open(df: DataFrame, node_col: str, keys: list[str], child_field: str, inherit: dict[str, str], skip_field: str | None) -> DataFrame:
    """keys, trace_address_array, sub_traces, trace_index, node and the inherited flags of VARIANT documents."""
    def children(n: Column) -> Column:
        return F.coalesce(F.try_variant_get(n, f"$['{child_field}']", "array<variant>"), F.array().cast("array<variant>"))

    def skipped(n: Column) -> Column:
        return _field(n, skip_field).isNotNull() if skip_field else F.lit(False)

    def item(n: Column, address: Column, up: Column | None) -> Column:
        flags = []
        for name, field in inherit.items():
            v = _field(n, field)
            own = v.isNotNull() & ~F.coalesce(F.is_variant_null(v), F.lit(True)) & ~skipped(n)
            flags.append((own if up is None else up[name] | own).alias(name))
        return F.struct(address.alias("a"), n.alias("n"), skipped(n).alias("s"), *flags)

    def done(y: Column) -> Column:
        count = F.size(F.filter(y["k"], lambda k: ~skipped(k)) if skip_field else y["k"])
        return F.struct(y["x"].alias("x"), count.alias("c"), (F.size(y["k"]) > 0).alias("p"))

    def step(acc: Column, _: Column) -> Column:
        """The nodes of the last level go to `all` with what their children tell, the children become the last level."""
        def opened_level(t: Column) -> Column:
            below = F.flatten(F.transform(t, lambda y: F.transform(
                y["k"], lambda k, i: item(k, F.concat(y["x"]["a"], F.array(i)), y["x"]))))
            return F.struct(below.alias("last"), F.concat(acc["all"], F.transform(t, done)).alias("all"))
        level = F.transform(acc["last"], lambda x: F.struct(x.alias("x"), children(x["n"]).alias("k")))
        # nothing is copied for levels that a document hasn't
        return F.when(F.size(acc["last"]) > 0, _bound(level, opened_level)).otherwise(acc)

    def opened(start: Column, levels: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), start, step)
    root = F.array(item(F.col(node_col), F.array().cast("array<int>"), None))
    empty = F.filter(F.transform(root, lambda x: done(F.struct(x.alias("x"), children(x["n"]).alias("k")))), lambda _: F.lit(False))
    docs = df.where(F.col(node_col).isNotNull()).select(*keys, opened(F.struct(root.alias("last"), empty.alias("all")), LEVELS).alias("_t"))
    t = F.col("_t")
    docs = docs.select(*keys, F.when(F.size(t["last"]) > 0, opened(t, MAX_LEVELS)).otherwise(t)["all"].alias("_all"))

    def is_skipped(y: Column) -> Column:
        return y["x"]["s"]

    def by_address(y: Column, z: Column) -> Column:
        return F.when(y["x"]["a"] < z["x"]["a"], -1).when(y["x"]["a"] > z["x"]["a"], 1).otherwise(0)
    in_order = F.array_sort(F.filter("_all", lambda y: ~is_skipped(y)), by_address)
    if skip_field:
        in_order = F.when(F.exists("_all", is_skipped), F.concat(in_order, F.filter("_all", is_skipped))).otherwise(in_order)
    nodes = docs.select(*keys, F.posexplode_outer(in_order).alias("_i", "_y"))  # outer: never empty, and Spark infers no filter that repeats the work
    y, x = F.col("_y"), F.col("_y.x")
    # a leaf stays as it is; whether a node without children has the field is only asked where there are none
    leaf = ~y["p"] & F.when(~y["p"], _field(x["n"], child_field).isNull())
    return nodes.select(*keys, x["a"].alias("trace_address_array"), y["c"].alias("sub_traces"),
                        F.when(~x["s"], F.col("_i")).alias("trace_index"),
                        F.when(leaf, x["n"]).otherwise(F.coalesce(strip_field(x["n"], child_field), x["n"])).alias("node"),
                        *[x[f].alias(f) for f in inherit])


def flatten_tree(df: DataFrame, node_col: str, keys: list[str], child_field: str = "calls",
                 inherit: dict[str, str] | None = None, skip_field: str | None = None) -> DataFrame:
    """One row per node: keys, trace_address_array, trace_address, parent_trace_address,
    depth, sub_traces (children in the document), trace_index (depth-first position), node
    (VARIANT, children removed) and one boolean per `inherit` entry.

    `node_col` is a VARIANT or JSON text; text keeps trees of any depth, at the price of Python. A null
    gives no row.
    inherit = {"path_error": "error"}: true when that field holds a value (JSON null does not
    count) on the node or on any ancestor (root included). Nodes that have `skip_field` get
    no trace_index, are no one's child and pass no flag on.
    """
    inherit = inherit or {}
    if df.schema[node_col].dataType != T.StringType():
        rows = _open(df, node_col, keys, child_field, inherit, skip_field)
        return rows.select(*keys, address_text("trace_address_array").alias("trace_address"),
                           parent_text("trace_address_array").alias("parent_trace_address"), "trace_address_array",
                           F.size("trace_address_array").alias("depth"), "sub_traces", "trace_index", "node", *inherit)
    names = [*keys, "trace_address_array", "depth", "sub_traces", "trace_index", "_text", *inherit]
    schema = T.StructType([*[df.schema[k] for k in keys],
                           T.StructField("trace_address_array", T.ArrayType(T.IntegerType())),
                           *[T.StructField(c, T.IntegerType()) for c in ("depth", "sub_traces", "trace_index")],
                           T.StructField("_text", T.StringType()), *[T.StructField(c, T.BooleanType()) for c in inherit]])
    rows = df.select(*keys, F.col(node_col).alias("_doc")).mapInArrow(
        _walk(len(keys), names, child_field, tuple(inherit.values()), skip_field), schema)
    return rows.select(*keys, address_text("trace_address_array").alias("trace_address"),
                       parent_text("trace_address_array").alias("parent_trace_address"), "trace_address_array",
                       "depth", "sub_traces", "trace_index", F.try_parse_json("_text").alias("node"), *inherit)


def has_error(node: Column) -> Column:
    """A node failed when its `error` field holds a value (JSON null does not count)."""
    return F.try_variant_get(node, "$.error", "string").isNotNull()


def preorder_index(nodes: DataFrame, group: list[str], addr: str = "trace_address_array",
                   name: str = "trace_index", mode: str = "window") -> DataFrame:
    """Zero-based depth-first position inside the group (arrays sort prefix-first).

    A group is one call tree, which block gas limits bound: a plain window by default."""
    return number_within(nodes, group, [f"{addr} asc"], name, mode=mode, start=0)


def child_counts(nodes: DataFrame, group: list[str], addr: str = "trace_address",
                 parent: str = "parent_trace_address", name: str = "sub_traces") -> DataFrame:
    """Number of direct children per node (0 for leaves), by a partial aggregate."""
    counts = (nodes.where(F.col(parent).isNotNull())
              .groupBy(*group, F.col(parent).alias("_addr")).agg(F.count(F.lit(1)).alias(name)))
    j = join_keys(nodes, counts, {**{g: g for g in group}, addr: "_addr"}, "left")
    return j.withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def ancestor_flag(nodes: DataFrame, group: list[str], flag: str, addr: str = "trace_address_array",
                  name: str = "path_flag") -> DataFrame:
    """True when the node or any ancestor (root included) has `flag` set.

    Each node lists its prefixes (depth + 1 of them) and meets the distinct set of
    flagged addresses on (group, prefix): an equi-join replaces the reference's
    regex theta join. `0_12` is not under `0_1` because arrays compare element-wise.
    """
    flagged = (nodes.where(F.col(flag)).select(*group, F.col(addr).alias("_prefix")).distinct())
    prefixes = nodes.select(*group, F.col(addr).alias("_node"),
                            F.explode(F.sequence(F.lit(0), F.array_size(addr))).alias("_k"))
    prefixes = prefixes.select(*group, "_node", F.slice("_node", 1, F.col("_k")).alias("_prefix"))
    hit = prefixes.join(flagged, [*group, "_prefix"], "left_semi").select(*group, "_node").distinct()
    hit = hit.withColumn(name, F.lit(True))
    j = join_keys(nodes, hit, {**{g: g for g in group}, addr: "_node"}, "left")
    return j.withColumn(name, F.coalesce(F.col(name), F.lit(False)))
