"""Mixing sources to target weights, in DataFrame functions only.

Tokens are aggregated per source, targets follow from weights and caps, and the
repetition rate of a source is target / size. A document is emitted floor(rate)
times plus one hash-seeded Bernoulli copy whose probability is the fraction.

Defined cases: a null text has no words; a null source is a source of its own and
comes last; sources without words have target 0 and rate 0; repeated rows (same id)
draw alike; an empty table gives an empty result. Columns of the input are kept, so
names this module adds must be given by the caller or start with `_mx_`.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import global_position
from .common import maybe_broadcast, whole_row, word_count
from ..session import ensure_checkpoint_dir

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_REPEAT = 2.0
SEED = "mix-1"


def uniform_draw(id_col: Column, seed: str = SEED) -> Column:
    """A reproducible number in [0, 1) from an id: 52 bits of an MD5 digest."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def source_targets(docs: DataFrame, size: Column, source_col: str = "source", weights=WEIGHTS,
                   share: float = SHARE, max_repeat: float = MAX_REPEAT) -> tuple[DataFrame, int]:
    """(_mx_source, source_size, target, rate) per source, and the number of sources.

    Sources in code-point order (null last) take the weights in turn. Targets share
    `share` times all words by weight; one that would exceed `max_repeat` times its
    source's words stops there and the excess is shared again among the rest.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    totals = (docs.groupBy(F.col(source_col).alias("_mx_source"))
              .agg(F.sum(size).alias("source_size")))
    w = F.array(*[F.lit(float(x)) for x in weights])
    ranked = (global_position(totals, "_mx_source asc nulls last", "_mx_rank", start=0)
              .withColumn("_mx_w", F.get(w, (F.col("_mx_rank") % len(weights)).cast("int")))
              .withColumn("_mx_cap", F.col("source_size") * F.lit(float(max_repeat)))
              .checkpoint())
    total, n = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.count(F.lit(1))).first()
    budget = float(share) * total
    # raise the common level until no further source exceeds its cap: one one-row
    # aggregate per step over the small per-source frame
    level, capped = 0.0, -1
    while True:
        stops = F.col("_mx_cap") < F.lit(level) * F.col("_mx_w")
        k, cap_sum, w_sum = ranked.agg(
            F.coalesce(F.sum(stops.cast("int")), F.lit(0)),
            F.coalesce(F.sum(F.when(stops, F.col("_mx_cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~stops, F.col("_mx_w"))), F.lit(0.0))).first()
        if k == capped or not w_sum:
            break
        capped, level = k, (budget - cap_sum) / w_sum
    free = F.lit(budget - cap_sum) * F.col("_mx_w") / F.lit(w_sum) if w_sum else F.lit(0.0)
    target = F.when(stops, F.col("_mx_cap")).otherwise(F.least(free, F.col("_mx_cap")))
    out = ranked.select("_mx_source", "source_size", target.alias("target")).withColumn(
        "_mx_rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    return out, n


def with_copies(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size: Column | None = None,
                text_col: str = "text", seed: str = SEED, **how) -> DataFrame:
    """`docs` plus source_size, target and copies (how often the mix takes the document)."""
    size = word_count(F.col(text_col)) if size is None else size
    targets, n = source_targets(docs, size, source_col, **how)
    joined = docs.join(maybe_broadcast(targets, n), docs[source_col].eqNullSafe(targets["_mx_source"]), "inner")
    whole = F.floor("_mx_rate")
    extra = uniform_draw(docs[id_col], seed) < F.col("_mx_rate") - whole
    return (joined.withColumn("copies", (whole + F.when(extra, 1).otherwise(0)).cast("int"))
            .drop("_mx_source", "_mx_rate"))


def mix_sources(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of `docs`."""
    mixed = with_copies(docs.select(whole_row(docs, "_mx_row"),
                                    F.col(how.pop("id_col", "doc_id")).alias("_mx_id"),
                                    F.col(how.pop("source_col", "source")).alias("_mx_src"),
                                    F.col(how.pop("text_col", "text")).alias("_mx_text")),
                        id_col="_mx_id", source_col="_mx_src", text_col="_mx_text", **how)
    return (mixed.where("copies > 0")
            .select("_mx_row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("_mx_copy"))
            .select("_mx_row.*"))
