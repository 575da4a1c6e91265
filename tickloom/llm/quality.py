"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks of ``CHUNK`` bytes, ``STEP`` apart, that cover all of it.  Bytes are embedded,
learned filters of ``2 * GRID`` bytes slide over each chunk in steps of ``GRID``, and each filter's largest
activation is kept per chunk.  The mean and the maximum over a document's chunks go through one hidden layer into one
probability.  A document is scored on all its bytes; nothing but the text enters a score.

Training is on the driver, on a sample of at most ``SAMPLE_DOCS`` labelled documents and ``SAMPLE_BYTES`` bytes: the first
in the order of a hash of the id, among those that are not held out (crc32 of the id's text, modulo 3, is 1), until the
bytes are used up.  Of an id that repeats one text is taken; texts above ``LONGEST`` bytes are left out.  Only sizes and
then the chosen texts come to the driver.  Each step looks at some chunks of each document.  The learned weights, a few thousand numbers, go to all tasks.

Defined results: null and empty texts have one chunk of padding and are scored like any other; documents with a null
id are scored and counted as not held out, but never learned from; repeated rows are scored each; documents labelled
twice with different labels are learned from with both; other columns are ignored; without labels of both kinds the
score is the share of label 1 (0.5 without any); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textbytes import blocks

CHUNK = 256
STEP = 192
GRID = 4
EMBED = 8
FILTERS = 24
HIDDEN = 12

SAMPLE_DOCS = 3000
SAMPLE_BYTES = 24 << 20
LONGEST = 2 << 20
EPOCHS = 12
BATCH_DOCS = 48
BATCH_CHUNKS = 6
SEED = 20240229


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of a block's documents, padded with zero bytes, and how many each document has (at least one)."""
    length = np.diff(offsets)
    count = np.maximum(1, -(-(length - (CHUNK - STEP)) // STEP))
    row = np.repeat(np.arange(len(length)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[row] + nth * STEP
    size = np.clip(offsets[row + 1] - start, 0, CHUNK)
    padded = np.concatenate([data, np.zeros(CHUNK, np.uint8)])
    out = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[start]
    out[np.arange(CHUNK) >= size[:, None]] = 0
    return out, count


class Network:
    """The weights and how they are used and learned."""

    def __init__(self, rng: np.random.Generator):
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.w = {
            "embed": normal(256, EMBED, scale=0.5),
            "conv": normal(2, GRID * EMBED, FILTERS, scale=(2 * GRID * EMBED) ** -0.5),
            "conv_bias": np.zeros(FILTERS, np.float32),
            "hidden": normal(2 * FILTERS, HIDDEN, scale=(2 * FILTERS) ** -0.5),
            "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": normal(HIDDEN, scale=HIDDEN**-0.5),
            "out_bias": np.zeros((), np.float32),
        }

    def filters(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per chunk the largest activation of each filter, where it is, and the embedded grid."""
        grid = self.w["embed"][x].reshape(len(x), CHUNK // GRID, GRID * EMBED)
        a = grid @ self.w["conv"][0]
        b = grid @ self.w["conv"][1]
        z = a[:, :-1] + b[:, 1:]
        at = z.argmax(axis=1)
        top = np.take_along_axis(z, at[:, None], axis=1)[:, 0] + self.w["conv_bias"]
        return np.maximum(top, 0), at, grid

    def pooled(self, top: np.ndarray, count: np.ndarray) -> np.ndarray:
        first = np.cumsum(count) - count
        return np.concatenate([np.add.reduceat(top, first) / count[:, None].astype(top.dtype), np.maximum.reduceat(top, first)], axis=1)

    def combine(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.tanh(pooled @ self.w["hidden"] + self.w["hidden_bias"])
        return 1 / (1 + np.exp(-(h @ self.w["out"] + self.w["out_bias"]).astype(np.float64))), h

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x, count = chunks(data, offsets)
        tops = [self.filters(x[i : i + 512])[0] for i in range(0, len(x), 512)]
        return self.combine(self.pooled(np.concatenate(tops), count))[0]

    def gradients(self, x: np.ndarray, count: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        top, at, grid = self.filters(x)
        pooled = self.pooled(top, count)
        p, h = self.combine(pooled)
        d_logit = (weight * (p - label) / weight.sum()).astype(h.dtype)
        d_h = d_logit[:, None] * self.w["out"] * (1 - h * h)
        d_pooled = d_h @ self.w["hidden"].T
        row = np.repeat(np.arange(len(count)), count)
        d_mean, d_max = d_pooled[:, :FILTERS], d_pooled[:, FILTERS:]
        is_top = top == pooled[row, FILTERS:]
        ties = np.add.reduceat(is_top, np.cumsum(count) - count, dtype=np.float32)
        d_top = (d_mean / count[:, None])[row] + np.where(is_top, (d_max / ties)[row], 0)
        d_top = np.where(top > 0, d_top, 0).astype(top.dtype)
        chunk = np.arange(len(x))[:, None]
        before, after = grid[chunk, at], grid[chunk, at + 1]  # chunks, filters, grid * embed
        d_conv = np.stack([np.einsum("cf,cfe->ef", d_top, g, optimize=True) for g in (before, after)])
        d_embed = np.zeros_like(self.w["embed"])
        for k, part in enumerate((at, at + 1)):
            d_cells = (d_top[:, :, None] * self.w["conv"][k].T).reshape(*at.shape, GRID, EMBED)
            letters = x.reshape(len(x), CHUNK // GRID, GRID)[chunk, part]
            np.add.at(d_embed, letters.ravel(), d_cells.reshape(-1, EMBED))
        return {
            "embed": d_embed,
            "conv": d_conv,
            "conv_bias": d_top.sum(0),
            "hidden": pooled.T @ d_h,
            "hidden_bias": d_h.sum(0),
            "out": h.T @ d_logit,
            "out_bias": d_logit.sum(),
        }

    def learn(self, texts: list[bytes], labels: np.ndarray, rng: np.random.Generator) -> None:
        """Adam over shuffled documents; both labels have the same total weight."""
        weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
        weight = (weight / weight.mean()).astype(np.float32)
        sizes = np.array([len(t) for t in texts])
        cut = [chunks(np.frombuffer(t, np.uint8), np.array([0, n]))[0] for t, n in zip(texts, sizes)]
        mean = {k: np.zeros_like(v) for k, v in self.w.items()}
        square = {k: np.zeros_like(v) for k, v in self.w.items()}
        step, steps = 0, EPOCHS * -(-len(texts) // BATCH_DOCS)
        for _ in range(EPOCHS):
            order = rng.permutation(len(texts))
            for i in range(0, len(order), BATCH_DOCS):
                batch = order[i : i + BATCH_DOCS]
                picked = [c if len(c) <= BATCH_CHUNKS else c[np.sort(rng.choice(len(c), BATCH_CHUNKS, replace=False))] for c in (cut[j] for j in batch)]
                found = self.gradients(np.concatenate(picked), np.array([len(c) for c in picked]), labels[batch], weight[batch])
                step += 1
                rate = 0.008 * (1 - step / (steps + 1))
                for k, g in found.items():
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g * g
                    self.w[k] = (self.w[k] - rate * mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Network | float:
    """A network learned from labelled documents, or a constant score where there is only one kind of label."""
    usable = labels.select(F.col(key).alias("__id"), F.col(label).cast("int").alias("__label")).filter("__id is not null and __label in (0, 1)")
    usable = usable.filter(~held_out("__id")).distinct()
    # bounded: ids of at most SAMPLE_DOCS documents, chosen by hash
    chosen = usable.orderBy(F.xxhash64("__id"), "__id", "__label").limit(SAMPLE_DOCS)
    rows = docs.select(F.col(key).alias("__id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    sized = rows.withColumn("__size", F.octet_length("__text")).withColumn("__hash", F.xxhash64("__text")).filter(F.col("__size") <= LONGEST)
    # bounded: of each chosen id the hash and the size of one text, a few numbers for each of SAMPLE_DOCS ids
    one = sized.join(F.broadcast(chosen.select("__id").distinct()), "__id").groupBy("__id").agg(F.min(F.struct("__hash", "__size")).alias("t"))
    of = {r["__id"]: r.t for r in one.collect()}
    picked, size = [], 0
    for r in chosen.collect():
        if r["__id"] in of:
            size += of[r["__id"]]["__size"]
            if size > SAMPLE_BYTES:
                break
            picked.append((r["__id"], of[r["__id"]]["__hash"], r["__label"]))
    found = {}
    if picked:
        wanted = docs.sparkSession.createDataFrame(list({p[:2] for p in picked}), T.StructType([T.StructField("__id", docs.schema[key].dataType), T.StructField("__hash", T.LongType())]))
        texts = sized.join(F.broadcast(wanted), ["__id", "__hash"]).groupBy("__id", "__hash").agg(F.min("__text").alias("t"))
        found = {r["__id"]: r.t.encode() for r in texts.collect()}  # at most SAMPLE_BYTES
    texts, kinds = [found[i] for i, _, _ in picked], [k for _, _, k in picked]
    kinds = np.array(kinds)
    if len(set(kinds.tolist())) < 2:
        return float(kinds[0]) if len(kinds) else 0.5
    rng = np.random.default_rng(SEED)
    network = Network(rng)
    network.learn(texts, kinds, rng)
    return network


def _scores(network: Network | float, column: pa.Array) -> np.ndarray:
    out = np.full(len(column), network if isinstance(network, float) else 0.0)
    if not isinstance(network, float):
        for first, end, data, at in blocks(column, 1 << 20):
            out[first:end] = network.score(data, at)
    return out


def score(docs: DataFrame, network: Network | float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _scores(network, batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"]
            )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held_out(key).alias("held_out"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, network: Network | float, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that score at least ``threshold``, with all their columns."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(network, batch.column(place)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
