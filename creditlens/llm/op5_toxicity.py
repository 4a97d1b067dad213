"""Toxicity grades by cumulative-link ordinal regression on sparse word counts.

Grades run from 0 (clean) to 3.  The labels are 0 or 1, so the grade of a labelled toxic
document is the third, among all of them, into which the count of its words that mark
toxicity falls.  One weight vector is shared by the ordered thresholds: P(grade > k) =
sigmoid(w.x - threshold_k).  Features are log(1 + count) of words and word beginnings, chosen
by how far their document rates in the two classes lie apart; copies among the labelled
documents are taken once, so a word of one copied text does not count as a mark.  A
document is toxic where its chance of a grade above 0 reaches the cut with the best F1 in
the sample.

The fit uses a sample of at most ``max_train`` labelled documents, in order of a hash of
doc_id; every document is scored over its whole text.

Defined results: a null or empty text has no features, and gets the grade of the thresholds
alone; labels that are null are left out, and where labels repeat for a doc_id the largest
counts; without toxic or without clean labels the model has no features and calls nothing
toxic; equal rows get equal results; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.llm.shared import text_or_empty, written

WORD = re.compile(r"[^\W_]+")
BEGINNINGS = range(4, 9)
GRADES = 4
KEPT_WORDS = 100_000
SCHEMA = "doc_id long, p_toxic double, severity double, grade int, toxic boolean"


def features(word: str) -> list[str]:
    """A word and its beginnings of 4 to 8 letters."""
    return [word, *("^" + word[:n] for n in BEGINNINGS if len(word) > n)]


@dataclass(frozen=True)
class Model:
    words: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray
    cut: float = 0.5
    met: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def above(self, score: np.ndarray) -> np.ndarray:
        """(rows, thresholds): the chance that the grade lies above each threshold."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -40, 40)))

    def score(self, text: str) -> float:
        words, met, counts = WORD.findall(text.lower()), self.met, {}
        if len(met) > KEPT_WORDS:
            met.clear()
        for w in set(words):
            if w not in met:
                met[w] = tuple(self.words[f] for f in features(w) if f in self.words)
        for own in filter(None, map(met.__getitem__, words)):
            for i in own:
                counts[i] = counts.get(i, 0) + 1
        return float(sum(self.weights[i] * np.log1p(n) for i, n in sorted(counts.items())))


def _training_rows(docs: DataFrame, labels: DataFrame, max_train: int) -> DataFrame:
    """(doc_id, toxic, words, counts) of the sampled labelled documents, near copies once."""
    own = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").alias("l_id")).agg(F.max("toxic").alias("toxic"))
    chosen = own.orderBy(F.xxhash64("l_id"), "l_id").limit(max_train)  # at most max_train rows of 12 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                words, counts, marks = [], [], []
                for t in part.column("text").to_pylist():
                    w = WORD.findall(t.lower())
                    c: dict[str, int] = {}
                    for x, n in Counter(w).items():
                        for f in features(x):
                            c[f] = c.get(f, 0) + n
                    words.append(list(c))
                    counts.append(list(c.values()))
                    shingles = {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
                    marks.append([min(xxhash.xxh64_intdigest(s, seed) for s in shingles) >> 1 for seed in (1, 2, 3)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), pa.array(words, pa.list_(pa.string())),
                                                  pa.array(counts, pa.list_(pa.int64())), pa.array(marks, pa.list_(pa.int64()))],
                                                 names=["doc_id", "toxic", "words", "counts", "marks"])

    text = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    rows = written(text.join(F.broadcast(chosen), text["doc_id"] == chosen["l_id"]).select("doc_id", F.col("toxic").cast("int"), "text")
                   .mapInArrow(run, "doc_id long, toxic int, words array<string>, counts array<long>, marks array<long>"))
    # a near copy of five-word shingles has the same least hash with the chance of its similarity
    copies = (rows.select("doc_id", F.posexplode("marks").alias("i", "m")).withColumn("first", F.lit(None).cast("long")))
    least = copies.groupBy("i", "m").agg(F.min("doc_id").alias("first"))
    later = copies.drop("first").join(least, ["i", "m"]).filter("doc_id > first").select("doc_id").distinct()
    return rows.join(later, "doc_id", "left_anti").select("doc_id", "toxic", "words", "counts")


def train(docs: DataFrame, labels: DataFrame, max_train: int = 12_000, min_docs: int = 5, min_z: float = 5.0,
          max_words: int = 4096) -> Model:
    rows = written(_training_rows(docs, labels, max_train))
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    none = Model({}, np.zeros(0), np.array([1.0, 2.0, 3.0]))
    if not n.get(0) or not n.get(1):
        return none
    a, b = F.col("toxic") / n[1], (F.col("seen") - F.col("toxic")) / n[0]
    p = F.col("seen") / (n[0] + n[1])
    seen = rows.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("seen"), F.sum("toxic").alias("toxic"))
    marks = (seen.filter((F.col("seen") >= min_docs) & (F.col("seen") < n[0] + n[1]))
             .withColumn("z", (a - b) / F.sqrt(p * (1 - p) * (1 / n[0] + 1 / n[1])))
             .filter(F.abs("z") >= min_z).orderBy(F.desc(F.abs("z")), "word").limit(max_words))
    found = marks.select("word", "z").collect()
    if not found:
        return none
    words = {r["word"]: i for i, r in enumerate(found)}
    known = F.broadcast(marks.sparkSession.createDataFrame([(w, i) for w, i in words.items()], "word string, i int"))
    cells = (rows.select("doc_id", "toxic", F.explode(F.arrays_zip("words", "counts")).alias("x"))
             .select("doc_id", "toxic", F.col("x.words").alias("word"), F.col("x.counts").alias("c")).join(known, "word")
             .groupBy("doc_id", "toxic").agg(F.collect_list(F.struct("i", "c")).alias("x")))
    data = rows.select("doc_id", "toxic").join(cells.select("doc_id", "x"), "doc_id", "left").orderBy("doc_id").select("toxic", "x").collect()
    plus = np.array([r["z"] > 0 for r in found])
    return _fit(words, plus, [(r["toxic"], [(y["i"], y["c"]) for y in r["x"] or ()]) for r in data])


def _fit(words: dict[str, int], plus: np.ndarray, data: list[tuple[int, list[tuple[int, int]]]], rounds: int = 1500,
         penalty: float = 2e-5) -> Model:
    """Gradient steps (Adam) on the ordinal likelihood; the order of thresholds holds by construction."""
    toxic = np.array([t for t, _ in data])
    marks = np.array([sum(c for i, c in x if plus[i]) for _, x in data])
    cuts = np.quantile(marks[toxic == 1], [1 / 3, 2 / 3])
    grade = np.where(toxic == 1, 1 + (marks > cuts[0]) + (marks > cuts[1]), 0)
    row = np.repeat(np.arange(len(data)), [len(x) for _, x in data])
    col = np.array([i for _, x in data for i, _ in x], dtype=np.int64)
    val = np.log1p(np.array([c for _, x in data for _, c in x], dtype=float))
    k, m = len(words), len(data)
    theta = np.concatenate([np.zeros(k), [1.0, 0.0, 0.0]])  # weights, first threshold, logs of the steps between
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        steps = np.exp(theta[k + 1:])
        cut = theta[k] + np.concatenate([[0], np.cumsum(steps)])
        s = np.bincount(row, weights=val * theta[col], minlength=m)
        c = np.concatenate([np.ones((m, 1)), 1 / (1 + np.exp(-np.clip(s[:, None] - cut[None, :], -40, 40))), np.zeros((m, 1))], axis=1)
        p = np.maximum(c[np.arange(m), grade] - c[np.arange(m), grade + 1], 1e-12)
        slope = c * (1 - c)
        lower, upper = slope[np.arange(m), grade], slope[np.arange(m), grade + 1]
        ds = (upper - lower) / p / m
        dcut = np.array([((lower / p) * (grade == j + 1) - (upper / p) * (grade == j)).sum() / m for j in range(GRADES - 1)])
        g = np.concatenate([np.bincount(col, weights=val * ds[row], minlength=k) + penalty * theta[:k], [dcut.sum()],
                            [dcut[j + 1:].sum() * steps[j] for j in range(GRADES - 2)]])
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        theta = theta - 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    model = Model(words, theta[:k], theta[k] + np.concatenate([[0], np.cumsum(np.exp(theta[k + 1:]))]))
    p = model.above(np.bincount(row, weights=val * theta[col], minlength=m))[:, 0]
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, m + 1) + toxic.sum())
    ends = np.flatnonzero(np.r_[p[order][1:] != p[order][:-1], True])
    best = int(f1[ends].argmax())
    after = p[order][ends[best] + 1] if ends[best] + 1 < m else 0.0
    return Model(words, model.weights, model.thresholds, float((p[order][ends[best]] + after) / 2))


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, p_toxic, severity, grade, toxic) of every document; severity is the expected grade."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                above = model.above(np.array([model.score(t.as_py()) for t in part.column("text")]))
                each = np.concatenate([1 - above[:, :1], above[:, :-1] - above[:, 1:], above[:, -1:]], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(above[:, 0]), pa.array(above.sum(axis=1)), pa.array(each.argmax(axis=1).astype(np.int32)),
                     pa.array(above[:, 0] >= model.cut)], names=["doc_id", "p_toxic", "severity", "grade", "toxic"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, SCHEMA)


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, all columns, that are not toxic."""
    @F.pandas_udf("boolean")
    def toxic(text):
        import pandas as pd

        return pd.Series(model.above(np.array([model.score(t) for t in text]))[:, 0] >= model.cut)

    return docs.filter(~toxic(text_or_empty()))
