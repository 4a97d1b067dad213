"""Quality by a byte-level convolutional network in numpy.

A text's bytes are laid in chunks of ``CHUNK`` bytes that overlap, to its end.  Learned
filters run over each chunk, the largest answer of each filter in a chunk is kept, and the
mean and the largest over all chunks go into one logistic output.

The fit uses at most ``max_train`` labelled documents that are not held out, in order of a
hash of doc_id, each in its whole length.  Scores read every byte too.  doc_id decides which
rows are held out, and nothing else but the text enters a score.

Defined results: a null text is empty; an empty text has one chunk of padding; a null
doc_id is not held out and never trained on; where labels repeat for a doc_id the largest
counts, and where documents repeat the fit takes the smallest text; without labels, or with those of one class alone, the score is the share of label 1
(0.5 without any); equal rows get equal results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.llm.shared import text_or_empty

CHUNK, OVERLAP, WIDTH, STRIDE, EMBED, FILTERS = 512, 64, 8, 4, 8, 32
BLOCK = 128  # chunks worked on at a time
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def chunks(raw: bytes) -> np.ndarray:
    """(chunks, CHUNK) bytes of a text, zero-padded."""
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(raw) - OVERLAP) // step))
    padded = np.zeros((n - 1) * step + CHUNK, dtype=np.uint8)
    padded[:len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    return sliding_window_view(padded, CHUNK)[::step]


@dataclass
class Net:
    embed: np.ndarray    # (256, EMBED)
    filters: np.ndarray  # (WIDTH * EMBED, FILTERS)
    offset: np.ndarray   # (FILTERS,)
    out: np.ndarray      # (2 * FILTERS,)
    bias: np.ndarray     # (1,)
    constant: float | None = None

    def windows(self, c: np.ndarray) -> np.ndarray:
        x = sliding_window_view(c, WIDTH, axis=1)[:, ::STRIDE]
        return x  # (chunks, places, WIDTH) bytes

    def answers(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = self.windows(c)
        flat = self.embed[x].reshape(-1, WIDTH * EMBED)
        a = (flat @ self.filters + self.offset).reshape(len(c), x.shape[1], FILTERS)
        a[x.max(axis=2) == 0] = 0  # padding alone
        at = a.argmax(axis=1)
        return np.maximum(np.take_along_axis(a, at[:, None, :], axis=1)[:, 0], 0), at, x

    def pooled(self, c: np.ndarray) -> np.ndarray:
        return np.concatenate([self.answers(c[i:i + BLOCK])[0] for i in range(0, len(c), BLOCK)])

    def features(self, groups: list[np.ndarray]) -> np.ndarray:
        best = self.pooled(np.concatenate(groups))
        ends = np.cumsum([len(g) for g in groups])
        starts = np.r_[0, ends[:-1]]
        mean = np.add.reduceat(best, starts) / (ends - starts)[:, None]
        return np.concatenate([mean, np.maximum.reduceat(best, starts)], axis=1)

    def scores(self, groups: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(groups), self.constant)
        z = self.features(groups).astype(np.float64) @ self.out.astype(np.float64) + float(self.bias[0])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _step(net: Net, groups: list[np.ndarray], y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean log loss by embed, filters, offset, out and bias."""
    c = np.concatenate(groups)
    best, picked = [], []  # each filter's largest answer in a chunk, and the WIDTH bytes that gave it
    for i in range(0, len(c), BLOCK):
        top, at, x = net.answers(c[i:i + BLOCK])
        best.append(top)
        picked.append(np.take_along_axis(x, at[:, :, None], axis=1))
    best, picked = np.concatenate(best), np.concatenate(picked)
    ends = np.cumsum([len(g) for g in groups])
    starts = np.r_[0, ends[:-1]]
    n, of = ends - starts, np.repeat(np.arange(len(groups)), ends - starts)
    mean, top = np.add.reduceat(best, starts) / n[:, None], np.maximum.reduceat(best, starts)
    f = np.concatenate([mean, top], axis=1)
    p = 1 / (1 + np.exp(-np.clip(f @ net.out + net.bias[0], -40, 40)))
    d = (p - y) / len(y)
    is_top = best == top[of]
    is_top = is_top / np.maximum(np.add.reduceat(is_top.astype(np.float32), starts), 1)[of]
    back = d[of, None] * (net.out[None, :FILTERS] / n[of, None] + net.out[None, FILTERS:] * is_top) * (best > 0)
    filters, embed = np.zeros_like(net.filters), np.zeros_like(net.embed)
    for i in range(0, len(c), BLOCK):
        b, own = back[i:i + BLOCK], picked[i:i + BLOCK]
        filters += np.einsum("cf,cfe->ef", b, net.embed[own].reshape(len(b), FILTERS, WIDTH * EMBED), optimize=True)
        np.add.at(embed, own.reshape(-1), (b[:, :, None] * net.filters.T[None]).reshape(-1, EMBED))
    return [embed, filters.astype(np.float32), back.sum(axis=0), f.T @ d, np.array([d.sum()])]


def fit(data: list[tuple[int, np.ndarray]], epochs: int = 10, batch: int = 32, rate: float = 0.004, seed: int = 11) -> Net:
    """Adam on shuffled batches; the same data give the same net."""
    rng = np.random.default_rng(seed)
    y = np.array([q for q, _ in data], dtype=np.float32)
    net = Net(rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32),
              np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32), np.zeros(1, np.float32))
    if not len(y) or y.min() == y.max():
        net.constant = float(y.mean()) if len(y) else 0.5
        return net
    params = [net.embed, net.filters, net.offset, net.out, net.bias]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            own = order[at:at + batch]
            t += 1
            now = rate * (1 - epoch / epochs)
            for p, g, m, v in zip(params, _step(net, [data[i][1] for i in own], y[own]), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= now * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-7)
    return net


def train(docs: DataFrame, labels: DataFrame, max_train: int = 2400) -> Net:
    own = (labels.filter("doc_id is not null and quality is not null").filter(~held_out(F.col("doc_id")))
           .groupBy(F.col("doc_id").alias("l_id")).agg(F.max("quality").cast("int").alias("quality")))
    chosen = own.orderBy(F.xxhash64("l_id"), "l_id").limit(max_train)  # at most max_train rows

    text = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    rows = (text.join(F.broadcast(chosen), text["doc_id"] == chosen["l_id"])
            .groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("text").alias("text")).collect())  # at most max_train rows
    rows.sort(key=lambda r: r["doc_id"])
    return fit([(r["quality"], chunks(r["text"].encode())) for r in rows])


def score(docs: DataFrame, net: Net) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                s = net.scores([chunks(t.as_py().encode()) for t in part.column("text")])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                                 names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, SCHEMA)
