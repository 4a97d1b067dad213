"""Bootstrap intervals against plain loops over replicates."""

import hashlib
import math
import random

import numpy as np

from creditlens.operators import resample as rs


def plain_weights(key, replicates):
    out = []
    for r in range(replicates):
        x = hashlib.sha256(f"boot42:{r // 8}:{key}".encode()).hexdigest()
        u, cdf, w = int(x[8 * (r % 8):8 * (r % 8) + 8], 16) / 4294967296.0, 0.0, 13
        for k in range(13):
            cdf += math.exp(-1.0) / math.factorial(k)
            if u < cdf:
                w = k
                break
        out.append(w)
    return out


def plain_metrics(rows, replicates):
    out = []
    for r in range(replicates):
        w = np.array([x[3][r] for x in rows])
        p, y = (np.array([x[i] for x in rows], dtype=float) for i in (1, 2))
        pos, neg = w * y, w * (1 - y)
        auc = sum(a * (neg[p < s].sum() + 0.5 * neg[p == s].sum()) for a, s in zip(pos, p)) / (pos.sum() * neg.sum())
        ap = sum(a * pos[p >= s].sum() / w[p >= s].sum() for a, s in zip(pos, p) if a) / pos.sum()
        loss = -(pos * np.log(p) + neg * np.log(1 - p)).sum() / w.sum()
        out.append({"roc_auc": auc, "average_precision": ap, "brier_score": (w * (p - y) ** 2).sum() / w.sum(), "log_loss": loss, "event_rate": pos.sum() / w.sum()})
    return out


def test_weights_are_those_of_the_hash():
    keys = [f"é{i}" for i in range(50)]
    assert rs.poisson1_weights(keys, 21).tolist() == [plain_weights(k, 21) for k in keys]


def test_intervals_match_plain_replicates(spark):
    """A hot score over several slices, ties, and rows without a score, which take no part."""
    rng = random.Random(3)
    rows = [(f"k{i}", 0.1 if i % 2 else round(rng.uniform(0.05, 0.9), 2), int(rng.random() < 0.3)) for i in range(5000)]
    full = [(*r, plain_weights(r[0], 12)) for r in rows]
    expected = plain_metrics(full, 12)
    other = plain_metrics([(k, 0.1 + (hash(y) % 2) / 2, y, w) for k, _, y, w in full], 12)
    odd = [("n1", None, 1), ("n2", float("nan"), 0), ("n3", 0.5, None)]
    docs = spark.createDataFrame(rows + odd, "k string, p double, y int").selectExpr("*", "0.1 + y / 2.0D as b").repartition(3)
    found = {r["metric"]: r for r in rs.bootstrap_ci(docs, "k", "p", "y", 12).collect()}
    pair = {r["metric"]: r for r in rs.bootstrap_ci(docs, "k", "p", "y", 12, benchmark="b").collect()}
    for name in expected[0]:
        for got, values in ((found, [e[name] for e in expected]), (pair, [e[name] - o[name] for e, o in zip(expected, other)])):
            assert got[name]["replicates"] == 12
            assert np.allclose([got[name][c] for c in ("lower", "upper", "mean")], [*np.percentile(values, [2.5, 97.5]), np.mean(values)], atol=1e-9)


def test_a_hot_score_is_few_rows(spark):
    rows = spark.range(6000).selectExpr("cast(id as string) as k", "0.25D as p", "cast(id % 2 as int) as y").coalesce(1)
    assert rs.weighted_histogram(rows, "k", "y", ["p"], 16, 42).count() <= 8
