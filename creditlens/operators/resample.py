"""Splits and samples (T1-T5) with exact, engine-independent counts.

Row order inside a stratum is a hash order (md5 of 'seed:id'), so results do not depend on
partitioning.  A row's rank is the number of rows in its stratum with a smaller hash prefix
(a table of at most 65,536 counts per stratum) plus its rank within the prefix, so a stratum
with most of the rows is spread over many windows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlens.functions.columns import join_on_keys

SEED = 42
PREFIX_DIGITS = 4  # hexadecimal digits of the hash that make a cell
# Split fractions (train, validation, test).
SPLIT_FRACTIONS = (0.6, 0.2, 0.2)
BUCKETS = 256  # ranges of scores in a bootstrap
SLICE = 2048   # rows whose weights a task holds at once


def hash_order(key, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def rank_within(df: DataFrame, strata: list[str], key: str, seed: int = SEED, most: Column | None = None) -> DataFrame:
    """Adds ``stratum_rank`` (1-based, hash order) and ``stratum_size`` per stratum.

    ``most``: rows whose rank is surely above it may be left out before any row is ranked.
    """
    h = df.withColumn("_h", hash_order(key, seed)).withColumn("_p", F.substring("_h", 1, PREFIX_DIGITS))
    counts = h.groupBy(*strata, "_p").agg(F.count(F.lit(1)).alias("_n"))
    cell = Window.partitionBy(*strata).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # prefixes of one stratum
    cells = counts.withColumn("_before", F.coalesce(F.sum("_n").over(cell), F.lit(0))).withColumn(
        "stratum_size", F.sum("_n").over(Window.partitionBy(*strata))).drop("_n")
    j = join_on_keys(h, cells, [*strata, "_p"])
    if most is not None:
        j = j.filter(F.col("_before") < most)
    own = F.row_number().over(Window.partitionBy(*strata, "_p").orderBy("_h", key))
    return j.withColumn("stratum_rank", F.col("_before") + own).drop("_before", "_h", "_p")


def stratified_split(df: DataFrame, strata: list[str], key: str, fractions=SPLIT_FRACTIONS,
                     seed: int = SEED) -> DataFrame:
    """train / validation / test by cumulative fraction cut-offs of the hash rank."""
    r = rank_within(df, strata, key, seed)
    n, rk = F.col("stratum_size"), F.col("stratum_rank")
    c1 = F.floor(n * fractions[0])
    c2 = F.floor(n * (fractions[0] + fractions[1]))
    return r.withColumn("split", F.when(rk <= c1, "train").when(rk <= c2, "validation").otherwise("test")) \
            .drop("stratum_rank", "stratum_size")


def vintage_split(df: DataFrame, year_col: str, train_until: int, validation_year: int) -> DataFrame:
    """Ordered vintage split: <= train_until train, validation year, later test."""
    y = F.col(year_col)
    return df.withColumn("split", F.when(y <= train_until, "train").when(y == validation_year, "validation")
                         .when(y > validation_year, "test"))


def quantile_split(df: DataFrame, date_col: str, q1: float = 0.6, q2: float = 0.8) -> DataFrame:
    """Split at the q1 / q2 interpolated quantiles of the date: <=, (,], >.

    The two cut-offs are exact order statistics computed by a distributed job.
    """
    from creditlens.operators import evaluate as ev
    secs = df.filter(F.col(date_col).isNotNull()).select(
        F.unix_timestamp(F.col(date_col).cast("timestamp")).cast("double").alias("_s"), F.lit(0).alias("_y"))
    row = ev.order_statistics(ev.cumulative_scores(secs, "_s", "_y"), [q1, q2]).first()
    c1, c2 = float(row["q0"]), float(row["q1"])
    s = F.unix_timestamp(F.col(date_col).cast("timestamp")).cast("double")
    return df.withColumn("split", F.when(s <= c1, "train").when(s <= c2, "validation")
                         .when(s > c2, "test")).withColumn("cut_validation", F.timestamp_seconds(F.lit(c1))) \
             .withColumn("cut_test", F.timestamp_seconds(F.lit(c2)))


def proportional_sample(df: DataFrame, group: str, key: str, max_rows: int, seed: int = SEED) -> DataFrame:
    """Per-group quota min(n, max(1, round_half_even(max_rows * n / total))) in hash order (T4)."""
    total = df.count()
    quota = F.least(F.col("stratum_size"),
                    F.greatest(F.lit(1), F.bround(F.lit(float(max_rows)) * F.col("stratum_size") / F.lit(float(total)), 0)))
    r = rank_within(df, [group], key, seed, quota)
    return r.filter(F.col("stratum_rank") <= quota).drop("stratum_rank", "stratum_size")


def capped_sample(df: DataFrame, group: str, key: str, cap: int, seed: int = SEED) -> DataFrame:
    """At most ``cap`` rows per group, in hash order (T5)."""
    r = rank_within(df, [group], key, seed, F.lit(cap))
    return r.filter(F.col("stratum_rank") <= cap).drop("stratum_rank", "stratum_size")


def _poisson1_below() -> np.ndarray:
    """The 32-bit uniforms at which a Poisson(1) variate goes up by one (up to 13; 12 covers 1 - 1e-10)."""
    cdf, out = 0.0, []
    for k in range(13):
        cdf += math.exp(-1.0) / math.factorial(k)
        out.append(math.ceil(cdf * 4294967296.0))
    return np.array([x for x in out if x < 1 << 32], dtype=np.uint32)


def poisson1_weights(keys: list[str], replicates: int, seed: int = SEED) -> np.ndarray:
    """(keys, replicates) Poisson(1) weights by inverse CDF of hash uniforms; one digest gives eight of 32 bits."""
    starts = [f"boot{seed}:{d}:".encode() for d in range(-(-replicates // 8))]
    raw = b"".join([hashlib.sha256(s + k).digest() for k in (key.encode() for key in keys) for s in starts])
    u = np.frombuffer(raw, dtype=">u4").reshape(len(keys), 8 * len(starts))[:, :replicates].astype(np.uint32)
    out = np.zeros(u.shape, dtype=np.uint8)
    for low in _poisson1_below():
        out += u >= low
    return out


def _summed(weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(weights, starts, axis=0, dtype=np.int64)


def weighted_histogram(df: DataFrame, key: str, label: str, scores: list[str], replicates: int, seed: int, buckets: int = BUCKETS) -> DataFrame:
    """(model, bucket, score, y, weights): the weights of all replicates, summed over a batch's rows of a score and a class.

    A bucket is a range of scores, higher buckets having lower scores; each lies in one partition, in descending order of
    the score.  A score is there once for each batch at most, so a hot one is few rows.
    """
    x = df.select(F.col(key).cast("string").alias("k"), F.col(label).cast("int").alias("y"), *[F.col(c).cast("double").alias(f"s{i}") for i, c in enumerate(scores)])
    names = [f"s{i}" for i in range(len(scores))]
    x = x.filter(" and ".join([f"{c} is not null and not isnan({c})" for c in names] + ["y is not null"]))
    cuts = x.agg(*[F.percentile_approx(c, [i / buckets for i in range(1, buckets)], 10 * buckets).alias(c) for c in names]).first()  # buckets numbers a score
    edges = [np.unique(np.array(cuts[c] or [], dtype=float)) for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
            w = poisson1_weights(batch.column("k").to_pylist(), replicates, seed)
            y = batch.column("y").to_numpy()
            for i, c in enumerate(names):
                score = batch.column(c).to_numpy()
                order = np.lexsort((y, score))
                s, o = score[order], y[order]
                at = np.flatnonzero(np.r_[True, (s[1:] != s[:-1]) | (o[1:] != o[:-1])])
                sums = _summed(w[order], at)
                packed = [r.astype("u1" if r.max() < 256 else "<u4").tobytes() for r in sums]  # told apart by their length
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i, dtype=np.int32)), pa.array((len(edges[i]) - np.searchsorted(edges[i], s[at])).astype(np.int32)),
                                                  pa.array(s[at]), pa.array(o[at]), pa.array(packed, pa.binary())], names=["model", "bucket", "score", "y", "weights"])

    return (x.mapInArrow(run, "model int, bucket int, score double, y int, weights binary")
            .repartition("model", "bucket").sortWithinPartitions("model", "bucket", F.desc("score")))


def _slices(batches: Iterator[pa.RecordBatch], replicates: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows of one (model, bucket) at a time: model, bucket, scores, classes, weights."""
    for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
        model, bucket, score, y = (batch.column(c).to_numpy() for c in ("model", "bucket", "score", "y"))
        raw = batch.column("weights").to_pylist()
        w = np.array([np.frombuffer(r, dtype="u1" if len(r) == replicates else "<u4") for r in raw], dtype=np.int64)
        turn = np.flatnonzero(np.r_[True, (np.diff(model) != 0) | (np.diff(bucket) != 0)])
        for a, b in zip(turn.tolist(), [*turn[1:].tolist(), len(raw)]):
            yield int(model[a]), int(bucket[a]), score[a:b], y[a:b], w[a:b]


def _bucket_totals(hist: DataFrame, replicates: int) -> dict[int, dict[int, np.ndarray]]:
    """Of each model and bucket the weights of the negatives and positives: (2, replicates)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for model, bucket, _, y, w in _slices(batches, replicates):
            own = sums.setdefault((model, bucket), np.zeros((2, replicates), dtype="<i8"))
            own += np.array([w[y == 0].sum(axis=0), w[y == 1].sum(axis=0)])
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()),
                                              pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["model", "bucket", "sums"])

    out: dict[int, dict[int, np.ndarray]] = {}
    for r in hist.mapInArrow(run, "model int, bucket int, sums binary").collect():  # a row per model and bucket
        out.setdefault(r["model"], {})[r["bucket"]] = np.frombuffer(r["sums"], dtype="<i8").reshape(2, replicates)
    return out


def replicate_sums(hist: DataFrame, replicates: int) -> DataFrame:
    """(model, replicate, auc, ap, brier, loss, pos, neg): each the sum over scores; auc over P N, ap over P."""
    from creditlens.operators import evaluate as ev
    before: dict[tuple[int, int], np.ndarray] = {}
    total: dict[int, np.ndarray] = {}
    for model, own in _bucket_totals(hist, replicates).items():
        at = np.zeros((2, replicates), dtype=np.int64)
        for bucket in sorted(own):
            before[model, bucket] = at
            at = at + own[bucket]
        total[model] = at
    names = ["auc", "ap", "brier", "loss", "pos", "neg"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        held: list = []  # the model, the counts so far, and the last score with its own counts, as more of it may follow

        def close(model: int, at: np.ndarray, neg: np.ndarray, pos: np.ndarray) -> np.ndarray:
            fp, tp = at[0] + np.cumsum(neg, axis=0), at[1] + np.cumsum(pos, axis=0)
            sums[model][0] += (pos * (total[model][0] - fp + 0.5 * neg)).sum(axis=0)
            sums[model][1] += (pos * (tp / np.maximum(tp + fp, 1))).sum(axis=0)
            return np.array([fp[-1], tp[-1]])

        def done() -> None:
            if held:
                close(held[0], held[2], held[4][0][None], held[4][1][None])

        for model, bucket, score, y, w in _slices(batches, replicates):
            own = sums.setdefault(model, np.zeros((len(names), replicates)))
            clipped = np.clip(score, ev.EPS, 1 - ev.EPS)
            own[2] += ((score - y) ** 2) @ w
            own[3] += -np.where(y == 1, np.log(clipped), np.log(1 - clipped)) @ w
            own[4] += w[y == 1].sum(axis=0)
            own[5] += w[y == 0].sum(axis=0)
            starts = np.flatnonzero(np.r_[True, np.diff(score) != 0])
            neg, pos = _summed(w * (y == 0)[:, None], starts), _summed(w * (y == 1)[:, None], starts)
            if held and held[:2] == [model, bucket]:
                at = held[2]
                if held[3] == score[0]:
                    neg[0] += held[4][0]
                    pos[0] += held[4][1]
                else:
                    neg, pos = np.vstack([held[4][0][None], neg]), np.vstack([held[4][1][None], pos])
            else:
                done()
                at = before[model, bucket]
            if len(neg) > 1:
                at = close(model, at, neg[:-1], pos[:-1])
            held = [model, bucket, at, score[-1], (neg[-1], pos[-1])]
        done()
        for model, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(replicates, model, dtype=np.int32)), pa.array(np.arange(1, replicates + 1)), *map(pa.array, own)],
                                             names=["model", "replicate", *names])

    rows = hist.mapInArrow(run, "model int, replicate long, " + ", ".join(f"{c} double" for c in names))
    return rows.groupBy("model", "replicate").agg(*[F.sum(c).alias(c) for c in names])


def bootstrap_ci(df: DataFrame, key: str, score: str, label: str, replicates: int = 500,
                 seed: int = SEED, benchmark: str | None = None) -> DataFrame:
    """Percentile 95% intervals of AUC, average precision, Brier, log loss and event rate (E14);
    with a ``benchmark`` score the intervals are for the paired difference (E15).

    A replicate whose rows are all of one class has no AUC and is left out; ``replicates``
    in the result counts the others.  Rows without a score or label take no part.

    Weights follow from the key alone, so every score column has the same ones and a paired
    comparison shares its replicates exactly.  They are drawn once, summed over the rows of a score
    and kept by ranges of the score; running counts begin with the totals of the ranges before.
    """
    scores = [score] + ([benchmark] if benchmark else [])
    hist = weighted_histogram(df, key, label, scores, replicates, seed).persist(StorageLevel.MEMORY_AND_DISK)
    p, n = F.col("pos"), F.col("neg")
    m = replicate_sums(hist, replicates).filter("pos > 0 and neg > 0").select(
        "model", "replicate", (F.col("auc") / (p * n)).alias("roc_auc"), (F.col("ap") / p).alias("average_precision"),
        (F.col("brier") / (p + n)).alias("brier_score"), (F.col("loss") / (p + n)).alias("log_loss"), (p / (p + n)).alias("event_rate"))
    names = ["roc_auc", "average_precision", "brier_score", "log_loss", "event_rate"]
    if benchmark:
        a = m.filter("model = 0").select("replicate", *names)
        b = m.filter("model = 1").select("replicate", *[F.col(n).alias(f"b_{n}") for n in names])
        m = a.join(b, "replicate").select("replicate", *[(F.col(n) - F.col(f"b_{n}")).alias(n) for n in names])
    else:
        m = m.select("replicate", *names)
    lng = m.unpivot(["replicate"], names, "metric", "value")
    return lng.groupBy("metric").agg(
        F.count(F.lit(1)).alias("replicates"),
        F.percentile("value", 0.025).alias("lower"), F.percentile("value", 0.975).alias("upper"),
        F.avg("value").alias("mean"))
