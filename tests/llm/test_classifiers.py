"""Toxicity grades and quality scores: held-out accuracy and defined cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditlens.llm import op5_toxicity as tox
from creditlens.llm import op8_quality as qual

ODD = [(1, None), (2, ""), (None, "plain words"), (3, "same"), (3, "same"), (4, "Ü" * 3000)]


def auc(y, s):
    order = np.argsort(np.asarray(s), kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    y = np.asarray(y)
    n1, n0 = y.sum(), len(y) - y.sum()
    return (rank[y == 1].sum() - n1 * (n1 - 1) / 2) / n1 / n0


@pytest.fixture(scope="module")
def data(spark):
    d = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "1 as words", "'x' as score", "2 as toxic")


def test_toxicity_held_out(spark, data):
    docs, labels = data
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = tox.train(docs, labels.filter(~held))
    assert (np.diff(model.thresholds) > 0).all()
    rows = tox.grade(docs, model).withColumnRenamed("toxic", "predicted").join(labels.filter(held), "doc_id").select("p_toxic", "severity", "grade", F.col("predicted").alias("t"), labels["toxic"].alias("y")).collect()
    y = [r.y for r in rows]
    assert auc(y, [r.severity for r in rows]) > 0.85
    assert np.mean([r.t == bool(r.y) for r in rows]) > 0.93
    assert all(0 <= r.severity <= 3 and r.grade in range(4) for r in rows)
    found = tox.grade(odd(spark), model).collect()
    assert len(found) == len(ODD) and not any(r.toxic for r in found)
    kept = tox.clean(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == tox.grade(docs, model).filter("not toxic").count()
    assert tox.grade(docs.limit(0), model).count() == 0


def test_toxicity_without_labels(spark, data):
    docs, labels = data
    model = tox.train(docs, labels.limit(0))
    assert not tox.grade(docs, model).filter("toxic").count()


def test_quality_held_out(spark, data):
    docs, labels = data
    net = qual.train(docs, labels)
    found = qual.score(docs, net).collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    y = {r.doc_id: r.quality for r in labels.collect()}
    own = [r for r in found if r.held_out and r.doc_id in y]
    assert auc([y[r.doc_id] for r in own], [r.score for r in own]) > 0.9
    assert np.mean([r.predicted == y[r.doc_id] for r in own]) > 0.88
    rows = qual.score(odd(spark), net).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert qual.score(docs.limit(0), net).count() == 0
    assert qual.train(docs, labels.limit(0)).constant == 0.5


def test_chunks_cover_everything():
    for n in (0, 1, 8, 64, 65, 511, 512, 513, 960, 961, 5000):
        c = qual.chunks(bytes([1]) * n)
        assert c.shape[1] == qual.CHUNK
        covered = np.zeros(n, dtype=int)
        for i in range(len(c)):
            covered[i * (qual.CHUNK - qual.OVERLAP):][:qual.CHUNK] += 1
        assert (covered > 0).all()


def test_network_gradients():
    rng = np.random.default_rng(1)
    groups = [qual.chunks(rng.integers(1, 256, n, dtype=np.uint8).tobytes()) for n in (40, 900, 2000)]
    y = np.array([1, 0, 1], dtype=np.float64)
    net = qual.fit([(1, groups[0]), (0, groups[1])], epochs=1)
    for k in ("embed", "filters", "offset", "out", "bias"):
        setattr(net, k, getattr(net, k).astype(np.float64))
    net.offset += 0.05

    def loss():
        p = net.scores(groups)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
    grads = qual._step(net, groups, y)
    for g, p in zip(grads, [net.embed, net.filters, net.offset, net.out, net.bias]):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = p[at]
        p[at] = old + 1e-5
        up = loss()
        p[at] = old - 1e-5
        down = loss()
        p[at] = old
        assert abs((up - down) / 2e-5 - g[at]) < 1e-3 * max(1, abs(g[at])) + 1e-4


def test_network_scores_against_a_plain_forward_pass():
    rng = np.random.default_rng(5)
    texts = [b"", b"abc", bytes(rng.integers(1, 256, 700, dtype=np.uint8)), bytes(rng.integers(1, 256, 90_000, dtype=np.uint8))]
    net = qual.fit([(1, qual.chunks(texts[2])), (0, qual.chunks(texts[1]))], epochs=1)
    found = net.scores([qual.chunks(t) for t in texts])
    for text, score in zip(texts, found):
        tops, at = [], 0
        while True:
            part = text[at:at + qual.CHUNK].ljust(qual.CHUNK, b"\0")
            own = [part[i:i + qual.WIDTH] for i in range(0, qual.CHUNK - qual.WIDTH + 1, qual.STRIDE)]
            answers = [net.embed[list(w)].reshape(-1) @ net.filters + net.offset if any(w) else np.zeros(qual.FILTERS) for w in own]
            tops.append(np.maximum(np.max(answers, axis=0), 0))
            if at + qual.CHUNK >= len(text):
                break
            at += qual.CHUNK - qual.OVERLAP
        z = np.concatenate([np.mean(tops, axis=0), np.max(tops, axis=0)]) @ net.out + net.bias[0]
        assert abs(1 / (1 + np.exp(-z)) - score) < 1e-4


def test_quality_fit_with_repeated_documents(spark):
    long = "plain words " * 3000
    rows = [(i, long + str(i) if i % 2 else "x7 !! " * 40) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    again = rows + [(2, "zz")] + rows[:9]
    nets = [qual.train(spark.createDataFrame(r, "doc_id long, text string").repartition(n), labels) for r, n in ((rows, 1), (again, 5))]
    assert all((a == b).all() for a, b in zip((nets[0].embed, nets[0].out), (nets[1].embed, nets[1].out)))
