"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Learned
filters slide over each chunk and are max-pooled within it; a hidden layer reads the
pooled vector of a chunk, is max-pooled over the chunks of the document, and gives one
probability. So one bad passage can decide, wherever in a text of any length it is.

Training takes a bounded sample of labelled rows (MAX_PER_CLASS rows per label in hash
order, whole texts, MAX_BYTES in all) and weighs it back to the labels' frequencies.
Rows whose crc32(id as text) mod 5 is 0 are held out and never learned from. Labels,
language, source and id are never inputs.

Defined cases: null and empty texts are one empty chunk and get a score; without labels
of both kinds every score is the share of label 1 (1 when there are no labels: nothing
is rejected); equal texts get equal scores; repeated label rows count once (the larger
label); an empty table gives an empty result; columns are kept, whatever their names.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_row

CHUNK, HOP = 256, 192  # bytes of a chunk, and from one chunk to the next
WIDTH, STRIDE = 6, 2  # bytes a filter sees, and moves by
FILTERS, HIDDEN = 32, 16
THRESHOLD = 0.3
FOLDS = 5  # rows with crc32(id) mod FOLDS = 0 are held out
MAX_PER_CLASS = 1500
MAX_BYTES = 32 << 20
EPOCHS, BATCH, RATE, DECAY = 8, 32, 0.01, 1e-4
SEED = 7


def _byte_features() -> np.ndarray:
    """256 x 8: four classes of bytes and four numbers that tell bytes apart; padding (0) is all zero."""
    b = np.arange(256)
    alnum = np.array([chr(i).isalnum() and i < 128 for i in b])
    kinds = [(b >= 65) & (b <= 90), np.isin(b, [32, *range(9, 14)]), (b > 32) & (b < 127) & ~alnum, (b >= 48) & (b <= 57)]
    own = np.random.default_rng(SEED).normal(0, 0.7, (256, 4))
    table = np.concatenate([np.stack(kinds, 1).astype(float), own], axis=1)
    table[0] = 0
    return table.astype(np.float32)


_BYTES = _byte_features()
_DIM = _BYTES.shape[1]


def chunks_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(chunks x CHUNK bytes, number of chunks of each text)."""
    counts = np.array([max(1, -(-max(0, len(t) - CHUNK) // HOP) + 1) for t in texts], np.int64)
    sizes = (counts - 1) * HOP + CHUNK
    at = np.cumsum(sizes) - sizes
    flat = np.zeros(int(sizes.sum()), np.uint8)
    for t, a in zip(texts, at):
        flat[a:a + len(t)] = np.frombuffer(t, np.uint8)
    first = np.cumsum(counts) - counts
    starts = np.repeat(at, counts) + HOP * (np.arange(int(counts.sum())) - np.repeat(first, counts))
    return np.lib.stride_tricks.sliding_window_view(flat, CHUNK)[starts], counts


def _windows(chunks: np.ndarray) -> np.ndarray:
    """chunks x positions x (WIDTH * features) of what the filters see."""
    e = _BYTES[chunks].reshape(len(chunks), -1)
    return np.lib.stride_tricks.sliding_window_view(e, WIDTH * _DIM, axis=1)[:, ::STRIDE * _DIM]


class Network:
    def __init__(self, seed: int = SEED):
        r = np.random.default_rng(seed)
        f32 = np.float32
        self.w = [r.normal(0, 1 / np.sqrt(WIDTH * _DIM), (WIDTH * _DIM, FILTERS)).astype(f32), np.zeros(FILTERS, f32),
                  r.normal(0, 1 / np.sqrt(FILTERS), (FILTERS, HIDDEN)).astype(f32), np.full(HIDDEN, 0.1, f32),
                  r.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN).astype(f32), np.zeros(1, f32)]

    def _pooled(self, chunks: np.ndarray) -> np.ndarray:
        """Max over positions, before the bias (which is the same at every position)."""
        out = np.empty((len(chunks), FILTERS), np.float32)
        for s in range(0, len(chunks), 256):
            x = _windows(chunks[s:s + 256])
            y = np.ascontiguousarray(x).reshape(-1, WIDTH * _DIM) @ self.w[0]
            out[s:s + 256] = y.reshape(x.shape[0], x.shape[1], FILTERS).max(1)
        return out

    def scores(self, chunks: np.ndarray, counts: np.ndarray) -> np.ndarray:
        _, b, v, c, u, d = self.w
        hidden = np.maximum(np.maximum(self._pooled(chunks) + b, 0) @ v + c, 0)
        doc = np.maximum.reduceat(hidden, np.cumsum(counts) - counts, axis=0)
        return 1 / (1 + np.exp(-np.clip((doc @ u + d[0]).astype(np.float64), -30, 30)))

    def gradients(self, chunks: np.ndarray, counts: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Of the weighted log loss; only the positions and chunks that won a maximum carry any."""
        w, b, v, c, u, d = self.w
        x = np.ascontiguousarray(_windows(chunks))
        y = (x.reshape(-1, x.shape[2]) @ w).reshape(x.shape[0], x.shape[1], FILTERS)
        best = y.argmax(1)
        raw = np.take_along_axis(y, best[:, None, :], 1)[:, 0] + b
        pooled = np.maximum(raw, 0)
        hidden = np.maximum(pooled @ v + c, 0)
        first = np.cumsum(counts) - counts
        doc = np.maximum.reduceat(hidden, first, axis=0)
        p = 1 / (1 + np.exp(-np.clip(doc @ u + d[0], -30, 30)))
        g = (weight * (p - label)).astype(np.float32) / len(label)
        g_doc = g[:, None] * u
        won = np.stack([hidden[f:f + n].argmax(0) + f for f, n in zip(first, counts)])  # documents x HIDDEN
        g_hidden = np.zeros_like(hidden)
        np.add.at(g_hidden, (won, np.arange(HIDDEN)[None, :]), g_doc)
        g_hidden *= hidden > 0
        g_raw = (g_hidden @ v.T) * (raw > 0)
        g_w = np.empty_like(w)
        rows = np.arange(len(chunks))
        for k in range(FILTERS):
            g_w[:, k] = g_raw[:, k] @ x[rows, best[:, k]]
        return [g_w, g_raw.sum(0), pooled.T @ g_hidden, g_hidden.sum(0), doc.T @ g, np.array([g.sum()], np.float32)]

    def fit(self, texts: list[bytes], label: np.ndarray, weight: np.ndarray) -> "Network":
        """Adam over shuffled batches of whole texts."""
        r = np.random.default_rng(SEED)
        share = float((weight * label).sum() / weight.sum())
        self.w[5][0] = np.log(share / (1 - share))
        m, s, step = [np.zeros_like(x) for x in self.w], [np.zeros_like(x) for x in self.w], 0
        for epoch in range(EPOCHS):
            order = r.permutation(len(texts))
            rate = RATE * (1 - epoch / EPOCHS)
            for at in range(0, len(order), BATCH):
                own = order[at:at + BATCH]
                grads = self.gradients(*chunks_of([texts[i] for i in own]), label[own], weight[own])
                step += 1
                for i, grad in enumerate(grads):
                    grad = grad + DECAY * self.w[i]
                    m[i] += 0.1 * (grad - m[i])
                    s[i] += 0.001 * (grad * grad - s[i])
                    self.w[i] -= (rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(s[i] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self


class Constant:
    """The score when there is nothing to learn from."""

    def __init__(self, share: float):
        self.share = share

    def scores(self, chunks: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.full(len(counts), self.share)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_per_class: int = MAX_PER_CLASS, max_bytes: int = MAX_BYTES):
    """A network fitted on a bounded sample of the labelled documents that are not held out."""
    known = (labels.select(F.col(id_col).alias("i"), F.col(label_col).alias("y"))
             .where("i is not null and y in (0, 1)").where(~held_out(F.col("i")))
             .groupBy("i").agg(F.max("y").alias("y")))
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return Constant(float(min(n, default=1)))
    chosen = [known.where(F.col("y") == y).orderBy(F.xxhash64("i"), "i").limit(max_per_class) for y in (0, 1)]
    ids = chosen[0].union(chosen[1])
    # the sample's ids number 2 * max_per_class at most: safe to broadcast and, with their sizes, to collect
    found = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).join(
        F.broadcast(ids), F.col("id") == F.col("i"))
    sizes = found.groupBy("i").agg(F.max("y").alias("y"), F.min(F.octet_length("t")).alias("b"),
                                   F.min(F.xxhash64("t")).alias("k")).collect()
    sizes.sort(key=lambda r: (r["k"], r["i"]))
    room, take = max_bytes, []
    for r in sizes:
        if r["b"] <= room:
            room -= r["b"]
            take.append(r)
    if len({r["y"] for r in take}) < 2:
        return Constant(float(n.get(1, 0)) / sum(n.values()))
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(r["i"], r["b"], r["k"]) for r in take], "wi bigint, wb bigint, wk bigint")
    rows = (found.join(F.broadcast(wanted), (F.col("i") == F.col("wi")) & (F.octet_length("t") == F.col("wb")))
            .select("i", "y", "t").dropDuplicates(["i"]).collect())
    rows.sort(key=lambda r: r["i"])
    label = np.array([r["y"] for r in rows], np.float32)
    share = n[1] / (n[0] + n[1])
    weight = np.where(label == 1, share / max(1e-9, label.mean()), (1 - share) / max(1e-9, 1 - label.mean()))
    return Network().fit([r["t"].encode() for r in rows], label, weight.astype(np.float32))


def score(text: Column, model) -> Column:
    """Probability of label 1 for a text column."""
    @F.pandas_udf("double")
    def run(t: pd.Series) -> pd.Series:
        out, waiting, size = [], [], 0

        def settle():
            nonlocal waiting, size
            if waiting:
                out.append(model.scores(*chunks_of(waiting)))
            waiting, size = [], 0
        for x in t:
            waiting.append(x.encode() if x else b"")
            size += len(waiting[-1])
            if size > 1 << 20:
                settle()
        settle()
        return pd.Series(np.concatenate(out) if out else np.empty(0))
    return run(text)


def classify(docs: DataFrame, model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`_row` (all columns of docs as a struct), score and predicted."""
    scored = docs.select(whole_row(docs), score(F.col(text_col), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model, **how) -> DataFrame:
    """`docs` without the documents the network rejects."""
    return classify(docs, model, **how).where("predicted = 1").select("_row.*")
