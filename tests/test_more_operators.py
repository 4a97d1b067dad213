"""Tests for contracts, explanation, files, harmonizer helpers, sessions and pilot tests."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from creditlens.operators import contracts as ct
from creditlens.operators import experiment as xp
from creditlens.operators import explain, explorer
from creditlens.operators import harmonize as hz
from creditlens.sources import adapters, files
from creditlens.streaming.counters import sessions


def test_readiness_rules_flag_each_problem(spark):
    base = {"customer_reference": "C1", "as_of_date": "2024-01-31T00:00:00+05:30", "consent_reference": "CNS-1",
            "consent_timestamp": "2024-01-20T00:00:00+05:30", "bureau_report_date": "2024-01-15T00:00:00+05:30",
            "bureau_dpd_30_12m": 0.0, "bureau_dpd_90_24m": 0.0, "open_trades": 2.0,
            "total_monthly_obligation_inr": 25000.0, "verified_monthly_income_inr": 100000.0,
            "income_verified_at": "2024-01-10T00:00:00+05:30", "current_limit_inr": 200000.0,
            "current_balance_inr": 50000.0, "statement_months": 12.0, "data_lineage_id": "L1"}
    rows = [dict(base), dict(base, customer_reference="C2", bureau_report_date="2023-11-01T00:00:00+05:30"),
            dict(base, customer_reference="C3", as_of_date="2024-01-31T00:00:00"),
            dict(base, customer_reference="C4", statement_months=3.0)]
    df = spark.createDataFrame(rows)
    v, d = ct.readiness(df)
    got = {(r.customer_reference, r.rule) for r in v.collect()}
    assert ("C2", "bureau_stale") in got and ("C3", "timezone_missing") in got and ("C4", "short_history") in got
    assert not any(c == "C1" for c, _ in got)
    ok = d.collect()
    assert [r.customer_reference for r in ok] == ["C1"]
    assert ok[0].foir_proxy == pytest.approx(0.25) and ok[0].bureau_age_days == 16


def test_counterfactual_ranks_and_directions(spark, small_dir):
    c = explain.counterfactuals(adapters.shared_scored(spark, small_dir)).cache()
    assert c.groupBy("account_id").count().filter("count != 4").count() == 0
    bad = c.filter((F.col("score_change") < 0) & (F.col("direction") != "risk-increasing evidence"))
    assert bad.count() == 0
    pay = c.filter("feature_group = 'payment_amount_history'").agg(F.max(F.abs("score_change"))).first()[0]
    assert pay == 0.0


def test_affine_permutation_is_a_bijection():
    for n in (1, 2, 7, 97, 1000):
        for r, prime in enumerate(explain.PERM_PRIMES, 1):
            image = [(k * prime + r * 7919) % n for k in range(n)]
            assert sorted(image) == list(range(n))
    with pytest.raises(ValueError):
        explain.permutation_importance(None, "id", "source", "y", repeats=len(explain.PERM_PRIMES) + 1)


def test_session_windows_match_gap_rule(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    mins = [0, 10, 45, 50, 200]
    rows = [(1, t0 + dt.timedelta(minutes=m), "view", 1.0) for m in mins]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_type string, value double")
    s = sorted(r.events for r in sessions(df, 30).collect())
    assert s == [1, 2, 2]


def test_csv_and_arff_round_trip(spark):
    df = spark.createDataFrame([(1, 2.5, "a"), (2, None, "b")], "k int, x double, s string")
    p = files.write_csv(df, files.scratch_path(spark, "t-csv"))
    back = files.read_csv(spark, p, "k int, x double, s string").orderBy("k").collect()
    assert back[0].x == 2.5 and back[1].x is None
    a = files.write_arff(df, files.scratch_path(spark, "t-arff"), "t", ["k", "x"], ["s"])
    rows = sorted(files.read_arff(spark, a).collect(), key=lambda r: r.k)
    assert rows[1].x is None and rows[0].s == "a"
    with pytest.raises(ValueError):
        files.guard_rows(df, max_rows=1)


def test_null_preserving_helpers(spark):
    df = spark.createDataFrame([(None, None), (95.0, 3.0), (-1.0, None)], "a double, b double")
    r = df.select(hz.sum_min_count([hz.placeholder_null(F.col("a"), 90), F.col("b")]).alias("s"),
                  hz.ratio_clip(F.col("a"), F.lit(1.0)).alias("r")).collect()
    assert r[0].s is None and r[1].s == 3.0 and r[0].r is None and r[2].r == 0.0


def test_holm_adjustment_is_monotone(spark, small_dir):
    t = xp.arm_tests(adapters.pilot(spark, small_dir)).orderBy("p_value").collect()
    assert len(t) == 3
    adj = [r.holm_p for r in t]
    assert adj == sorted(adj) and all(a >= r.p_value for a, r in zip(adj, t))


def test_page_is_clamped(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("account_id"))
    p = explorer.page(df.orderBy("account_id"), 99, 30).collect()
    assert len(p) == 5 and p[0].page == 2
