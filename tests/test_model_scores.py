"""Queries that give the models' and the allocation's own figures, against plain computations."""

import pytest

import __spark_entry__ as entry


def plain(rows, col):
    pos, neg = ([r[col] for r in rows if r.quality == v] for v in (1, 0))
    auc = sum((x > y) + 0.5 * (x == y) for x in pos for y in neg) / (len(pos) * len(neg))
    return auc, sum((r[col] - r.quality) ** 2 for r in rows) / len(rows)


def test_calibration_scores(spark, small_dir):
    from creditlens.plans.extra_plans import _calibrated

    got = {r.model: r for r in entry.queries()["ml_calibration_scores"](spark, small_dir).collect()}
    for x, col, name in zip(_calibrated(spark, small_dir), ("p", "p_cal"), ("uncalibrated", "sigmoid_calibrated")):
        rows = x.collect()
        assert got[name].accounts == len(rows)
        assert (got[name].roc_auc, got[name].brier_score) == pytest.approx(plain(rows, col), abs=1e-6)


def test_allocation_values(spark, small_dir):
    from creditlens.operators import allocate as al
    from creditlens.operators.policy import PolicyAssumptions
    from creditlens.plans.allocation_plans import _decided

    got = entry.queries()["portfolio_allocation_values"](spark, small_dir).collect()
    a = PolicyAssumptions()
    rows = al.allocate(_decided(spark, small_dir, a), a).decisions.collect()
    value = float(sum(r.incremental_contribution for r in rows))
    for k, r in enumerate(got):
        assert r.accounts == len(rows) and float(r.value) == pytest.approx(value, abs=0.02) and r.gap == pytest.approx(r.dual_bound - value, abs=0.03)
        assert float(r.usage) == pytest.approx(float(sum(x[f"_u{k + 1}"] for x in rows)), abs=0.02)


def test_few_training_rows_are_in_few_partitions(spark):
    from creditlens.operators import models

    rows = spark.range(5000).repartition(200)
    got = models.packed(rows, 5000)
    assert got.rdd.getNumPartitions() == 2 and got.count() == 5000
