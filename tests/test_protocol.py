"""Select, freeze, refit, test once; one fit over time windows; a calibrator around a frozen model."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from creditlens.operators import evaluate as ev
from creditlens.operators import protocol
from creditlens.operators import models
from creditlens.plans import protocol_plans as pp


def recipe(columns, label):
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="f"), LogisticRegression(featuresCol="f", labelCol=label, maxIter=50)])


def recipes():
    return {"long": recipe(pp.NUMERIC, "quality"), "short": recipe(["n_lines"], "quality")}


def plain(rows, threshold):
    """(p, y) rows -> AUC, average precision, Brier, confusion, by definition."""
    pos, neg = [p for p, y in rows if y == 1], [p for p, y in rows if y == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    counts = [sum((p >= threshold) == a and (y == 1) == b for p, y in rows) for a, b in ((True, True), (True, False), (False, False), (False, True))]
    return auc, sum((p - y) ** 2 for p, y in rows) / len(rows), counts


def cheapest(rows):
    return min((sum(5 * (y == 1 and p < t) + (y == 0 and p >= t) for p, y in rows), t) for t in ev.THRESHOLDS)


def test_protocol_follows_its_order_and_the_plain_figures(spark, small_dir):
    d = pp._split_documents(spark, small_dir).persist()
    p = protocol.Protocol(d, recipes(), "quality", min_rows=10)
    with pytest.raises(RuntimeError):
        p.refit()
    frozen = p.select()
    with pytest.raises(RuntimeError):
        p.select()
    with pytest.raises(RuntimeError):
        p.test()
    # selection by plain computation
    train, held, test = (d.filter(F.col("split") == s) for s in ("train", "validation", "test"))
    scored = {n: [(r.p, r.quality) for r in models.score(x.fit(train), held).collect()] for n, x in recipes().items()}
    said = {n: plain(rows, 0.5)[:2] for n, rows in scored.items()}
    best = max(a for a, _ in said.values())
    assert frozen.champion == min((b, n) for n, (a, b) in said.items() if a >= best - 0.02)[1]
    for n, a, b in frozen.validation:
        assert (a, b) == pytest.approx(said[n])
    assert (frozen.cost, frozen.threshold) == pytest.approx(cheapest(scored[frozen.champion]))
    # refit on both splits, one look at test
    model = p.refit()
    assert p.refit() is model and p.development_rows == train.count() + held.count()
    row = p.test().first()
    auc, brier, counts = plain([(r.p, r.quality) for r in models.score(recipes()[frozen.champion].fit(train.unionByName(held)), test).collect()], frozen.threshold)
    assert row.roc_auc == pytest.approx(auc, abs=1e-3) and row.brier_score == pytest.approx(brier, abs=1e-3)
    assert row.accounts == test.count() and row.threshold == frozen.threshold and row.tp + row.fp + row.tn + row.fn == row.accounts
    with pytest.raises(RuntimeError):
        p.test()
    # labels of test have no part in what is frozen
    turned = d.withColumn("quality", F.when(F.col("split") == "test", 1 - F.col("quality")).otherwise(F.col("quality")))
    assert protocol.Protocol(turned, recipes(), "quality", min_rows=10).select() == frozen
    d.unpersist()


def test_windows_carry_one_threshold_and_the_calibrator_leaves_scores_alone(spark, small_dir):
    w = pp.windowed_loans(spark, small_dir).withColumn("target", F.col("target").cast("double")).persist()
    own = recipe(pp.LOAN_FEATURES, "target")
    found = {r["window"]: r for r in protocol.out_of_time(w, own, "target", "vintage").collect()}
    scored = models.score(own.fit(w.filter("split = 'train'")), w.filter("split <> 'train'")).select("id", "split", "target", "vintage", "p").persist()
    rows = [(r.split, r.vintage, r.p, r.target) for r in scored.collect()]
    _, threshold = cheapest([(p, y) for s, _, p, y in rows if s == "in_time"])
    assert {"random_test", "in_time", "out_of_time"} < set(found) and any(k.startswith("vintage_") for k in found)
    for name, r in found.items():
        part = [(p, y) for s, v, p, y in rows if s == name or (s == "out_of_time" and name == f"vintage_{v}")]
        assert r.threshold == threshold and r.accounts == len(part)
        if 0 < sum(y for _, y in part) < len(part):
            auc, brier, counts = plain(part, threshold)
            assert (r.roc_auc, r.brier_score) == pytest.approx((auc, brier), abs=1e-9) and [r.tp, r.fp, r.tn, r.fn] == counts
    after = protocol.calibrated(protocol.fit_calibrator(scored.filter("split = 'in_time'"), "target"), scored)
    assert after.columns == [*scored.columns, "p_cal"]
    assert {r.id: r.p for r in after.collect()} == {r.id: r.p for r in scored.collect()}  # every bit
    assert found["in_time"].brier_calibrated <= found["in_time"].brier_score + 1e-9


def test_too_few_rows_and_one_class_are_errors(spark):
    rows = [(i, float(i % 2), "train", 1.0) for i in range(20)] + [(i, 1.0, "validation", 1.0) for i in range(20, 30)]
    d = spark.createDataFrame(rows, "id long, quality double, split string, x double")
    with pytest.raises(Exception):
        protocol.Protocol(d, {"a": recipe(["x"], "quality")}, "quality", min_rows=100).select()
    with pytest.raises(ValueError):
        protocol.Protocol(d, {"a": recipe(["x"], "quality")}, "quality", min_rows=10).select()
    with pytest.raises(ValueError):
        protocol.Protocol(d, {}, "quality")
