"""A byte-level convolutional quality classifier in numpy.

A text's UTF-8 bytes are laid on a grid of rows of 4 bytes. A learned embedding of bytes feeds
learned filters over windows of 12 bytes (3 rows); one more input channel is the echo: how much of
the 64 bytes before a row repeats bytes of the 24 before them (filters are linear and could not see
repetition). Rectified outputs are max-pooled over overlapping chunks of 512 bytes, one every 256,
which cover the whole text; the maximum and the mean over a text's chunks meet in one logistic unit.

Each text starts on a row and a block of its own, so a score does not depend on its neighbours.
Training fits all weights with Adam on a bounded number of labelled texts (``train_docs``, one text an id), each read whole, as
scoring does; long texts go through the filters a slice at a time.

Defined cases: null and empty texts are scored like a text without bytes; a null id is never held
out; labels other than 0 and 1 and labels without a document are ignored; with labels of one class
or none the score is that class's smoothed share; repeated rows and extra columns are harmless.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._bytes import chunks, text_buffer
from ._spark import texts

ROW, WIDTH, BLOCK, EMBED, FILTERS = 4, 3, 64, 7, 32
LAGS = range(2, 25)
SLICE_ROWS = 1 << 15


@dataclass
class Grid:
    """Texts on the row grid: bytes, echo channel, and where each text's blocks lie."""

    data: np.ndarray
    echo: np.ndarray
    block_off: np.ndarray


def lay_out(buf: np.ndarray, off: np.ndarray) -> Grid:
    size = ROW * BLOCK
    n = np.diff(off)
    blocks = (n + 32 + size - 1) // size  # 32 zero bytes or more between texts
    block_off = np.concatenate([[0], np.cumsum(blocks)])
    lead = size
    data = np.zeros(lead + int(block_off[-1]) * size + size, np.uint8)
    for i in np.flatnonzero(n).tolist():
        at = lead + int(block_off[i]) * size
        data[at : at + int(n[i])] = buf[off[i] : off[i + 1]]
    four = np.ndarray(shape=(len(data) - 3,), dtype="<u4", buffer=data, strides=(1,))
    rows = int(block_off[-1]) * BLOCK
    here = four[lead : lead + rows * ROW : ROW]
    same = np.zeros(rows, bool)
    for lag in LAGS:
        same |= here == four[lead - lag : lead - lag + rows * ROW : ROW]
    same &= here != 0
    sums = np.concatenate([[0], np.cumsum(same)])
    begin = np.repeat(block_off[:-1] * BLOCK, blocks * BLOCK)
    to = np.arange(1, rows + 1)
    echo = ((sums[to] - sums[np.maximum(to - 16, begin)]) / 16.0).astype(np.float32)
    return Grid(data[lead:], echo, block_off)


@dataclass
class Weights:
    embedding: np.ndarray  # (256, EMBED)
    filters: np.ndarray  # (WIDTH * ROW * EMBED + 2, FILTERS): patch, echo, bias
    top: np.ndarray  # (2 * FILTERS + 1,)
    share: float = 0.5
    constant: bool = False


def convolve(w: Weights, g: Grid, first: int, count: int) -> np.ndarray:
    """Rectified filter outputs (rows, FILTERS) of the rows from ``first`` on."""
    data = g.data[first * ROW : (first + count + WIDTH - 1) * ROW]
    x = w.embedding[data].reshape(count + WIDTH - 1, ROW * EMBED)
    step = ROW * EMBED
    z = x[:count] @ w.filters[:step]
    for k in range(1, WIDTH):
        z += x[k : k + count] @ w.filters[k * step : (k + 1) * step]
    z += g.echo[first : first + count, None] * w.filters[-2]
    z += w.filters[-1]
    return np.maximum(z, 0, out=z)


def block_maxima(w: Weights, g: Grid, places: np.ndarray | None = None) -> np.ndarray:
    """(blocks, FILTERS): each filter's maximum in a block; its row within the block goes to ``places`` where that is given."""
    rows = int(g.block_off[-1]) * BLOCK
    out = np.empty((int(g.block_off[-1]), FILTERS), np.float32)
    last_rows = np.zeros(rows, bool)
    last_rows[g.block_off[1:] * BLOCK - 1] = last_rows[g.block_off[1:] * BLOCK - 2] = True  # their windows reach the next text
    for at in range(0, rows, SLICE_ROWS):
        count = min(SLICE_ROWS, rows - at)
        z = convolve(w, g, at, count)
        z[last_rows[at : at + count]] = 0
        z = z.reshape(-1, BLOCK, FILTERS)
        here = slice(at // BLOCK, (at + count) // BLOCK)
        if places is None:
            out[here] = z.max(axis=1)
        else:
            places[here] = z.argmax(axis=1)
            out[here] = np.take_along_axis(z, places[here][:, None, :].astype(np.int64), 1)[:, 0]
    return out


def pooled(maxima: np.ndarray, block_off: np.ndarray) -> np.ndarray:
    """(texts, 2 * FILTERS): the maximum and the mean over each text's overlapping chunks."""
    two = maxima.copy()
    inner = np.ones(len(maxima), bool)
    inner[block_off[1:] - 1] = False  # a text's last block is a chunk with its predecessor, or alone
    i = np.flatnonzero(inner)
    two[i] = np.maximum(maxima[i], maxima[i + 1])
    n = np.diff(block_off)
    several = np.flatnonzero(n > 1)
    two[block_off[several + 1] - 1] = 0
    top = np.maximum.reduceat(maxima, block_off[:-1], axis=0)
    mean = np.add.reduceat(two.astype(np.float64), block_off[:-1], axis=0) / np.maximum(n - 1, 1)[:, None]
    return np.concatenate([top, mean.astype(np.float32)], axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def score(w: Weights, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    if w.constant:
        return np.full(len(off) - 1, w.share)
    g = lay_out(buf, off)
    return sigmoid(pooled(block_maxima(w, g), g.block_off).astype(np.float64) @ w.top[:-1].astype(np.float64) + float(w.top[-1]))


class _Adam:
    def __init__(self, params: list[np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m, self.v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def step(self, grads: list[np.ndarray]) -> None:
        self.t += 1
        for p, g, m, v in zip(self.params, grads, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.99**self.t)) + 1e-7)


def fit(column: pa.Array, quality: np.ndarray, epochs: int = 5, batch: int = 32, rate: float = 0.01, seed: int = 5) -> Weights:
    rng = np.random.default_rng(seed)
    width = WIDTH * ROW * EMBED
    w = Weights(rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), rng.normal(0, 0.15, (width + 2, FILTERS)).astype(np.float32), np.concatenate([rng.normal(0, 0.1, 2 * FILTERS), [0.0]]).astype(np.float32))
    w.share = float((quality.sum() + 1) / (len(quality) + 2))
    if not 0 < quality.sum() < len(quality):
        w.constant = True
        return w
    w.top[-1] = np.log(w.share / (1 - w.share))
    buf, off = text_buffer(column)
    adam = _Adam([w.embedding, w.filters, w.top], rate)
    for epoch in range(epochs):
        adam.rate = rate * (1 - epoch / epochs)
        order = rng.permutation(len(quality))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            parts = [buf[off[i] : off[i + 1]] for i in pick]
            po = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
            g = lay_out(np.concatenate([*parts, np.zeros(8, np.uint8)]), po)
            adam.step(_gradient(w, g, quality[pick]))
    return w


def _gradient(w: Weights, g: Grid, quality: np.ndarray) -> list[np.ndarray]:
    blocks = int(g.block_off[-1])
    arg = np.zeros((blocks, FILTERS), np.int64)
    maxima = block_maxima(w, g, arg)
    feature = pooled(maxima, g.block_off)
    d = ((sigmoid(feature @ w.top[:-1] + w.top[-1]) - quality) / len(quality)).astype(np.float32)
    g_top = np.concatenate([feature.T @ d, [d.sum()]]).astype(np.float32) + np.float32(1e-4) * w.top
    # the gradient of a maximum goes to the block that holds it
    push = np.zeros((blocks, FILTERS), np.float32)
    d_max, d_mean = d[:, None] * w.top[None, :FILTERS], d[:, None] * w.top[None, FILTERS:-1]
    for i in range(len(d)):
        a, b = int(g.block_off[i]), int(g.block_off[i + 1])
        push[a + maxima[a:b].argmax(axis=0), np.arange(FILTERS)] += d_max[i]
        if b - a == 1:
            push[a] += d_mean[i]
        else:
            later = maxima[a + 1 : b] > maxima[a : b - 1]
            share = d_mean[i] / (b - a - 1)
            push[a : b - 1] += np.where(later, 0, share)
            push[a + 1 : b] += np.where(later, share, 0)
    push *= maxima > 0
    block, f = np.nonzero(push)
    value = push[block, f]
    row = block * BLOCK + arg[block, f]
    byte = g.data[row[:, None] * ROW + np.arange(WIDTH * ROW)[None, :]]
    patch = w.embedding[byte].reshape(len(row), -1)
    g_filters = np.zeros_like(w.filters)
    onto = np.zeros((len(row), FILTERS), np.float32)
    onto[np.arange(len(row)), f] = value
    g_filters[:-2] = patch.T @ onto
    g_filters[-2] = g.echo[row] @ onto
    g_filters[-1] = onto.sum(axis=0)
    back = (value[:, None] * w.filters[:-2, f].T).reshape(-1, EMBED)
    g_embed = np.stack([np.bincount(byte.ravel(), weights=back[:, k], minlength=256) for k in range(EMBED)], axis=1).astype(np.float32)
    return [g_embed, g_filters, g_top]


def held_out(doc_id: str = "doc_id", folds: int = 5, fold: int = 0) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def train_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", train_docs: int = 3000) -> Weights:
    """Weights from at most ``train_docs`` labelled ids outside the held-out fold, drawn by a hash of the id, one whole text each.

    Of several rows with one id the least text is taken, so no more rows than ids reach the driver.
    """
    marks = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(F.col("quality").isin(0, 1) & ~held_out()).where(F.col("doc_id").isNotNull())
    chosen = marks.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    # the chosen ids are train_docs rows at most: a proven bound for the broadcast
    met = texts(docs, doc_id, text).join(F.broadcast(chosen), "doc_id")
    rows = met.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality")).toArrow().sort_by("doc_id")
    return fit(rows.column("text"), np.asarray(rows.column("quality"), dtype=np.float32))


def _scorer(weights) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(score(weights.value, buf, off), pa.float64())], names=["doc_id", "score"])

    return run


def quality_scores(docs: DataFrame, weights: Weights, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # a fixed number of weights
    out = texts(docs, doc_id, text).mapInArrow(_scorer(shared), "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, weights: Weights, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in chunks(batches, text):
            yield rows.filter(pa.array(score(shared.value, buf, off) >= threshold))

    return docs.mapInArrow(run, docs.schema)
