"""One-pass metric bundle, keyed zip, permuted blocks, session stream."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from creditlens.operators import bundle as bu
from creditlens.operators import evaluate as ev
from creditlens.operators import experiment as xp
from creditlens.operators.keyed import Incomplete, KeyedZip
from creditlens.streaming.counters import SessionStream, sessions


def scored(spark, rows):
    return spark.createDataFrame(rows, "g string, pd double, y int")


def plain(rows, t):
    p, y = [r[1] for r in rows], [r[2] for r in rows]
    pairs = [(a, b) for a, u in zip(p, y) for b, v in zip(p, y) if u == 1 and v == 0]
    cost = {c: sum(ev.FN_COST * (v == 1) if s < c else (v == 0) for s, v in zip(p, y)) for c in ev.THRESHOLDS}
    return {"accounts": len(p), "events": sum(y), "brier_score": sum((a - b) ** 2 for a, b in zip(p, y)) / len(p),
            "roc_auc": sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs) if pairs else None,
            "tp": sum(s >= t and v == 1 for s, v in zip(p, y)), "fp": sum(s >= t and v == 0 for s, v in zip(p, y)),
            "best_threshold": min(cost, key=lambda c: (cost[c], c)), "best_cost": min(cost.values())}


def test_bundle_against_plain_sums(spark):
    rng = random.Random(3)
    rows = [("a", round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(400)]
    rows += [(None, round(rng.random(), 3), int(rng.random() < 0.5)) for _ in range(90)] + [("one", 0.25, 1), ("one", 0.25, 1)]
    odd = [("a", None, 1), ("a", math.nan, 0), ("none", None, 1), ("a", 0.4, None)]
    found = {r.g: r for r in bu.bundle(scored(spark, rows + odd), group_cols=["g"], threshold=0.37).collect()}
    assert set(found) == {"a", None, "one", "none"}
    for g in ("a", None, "one"):
        for k, v in plain([r for r in rows if r[0] == g], 0.37).items():
            assert found[g][k] == v if v is None or isinstance(v, int) else abs(found[g][k] - v) < 1e-9, (g, k)
    assert found["a"].unscored == 2 and found["one"].unscored == 0
    assert found["none"].unscored == 1 and found["none"].roc_auc is None
    assert found["one"].ks is None and abs(found["one"].calibration_gap - 0.75) < 1e-12
    whole = bu.bundle(scored(spark, rows + odd), names=["roc_auc", "ks"])
    assert whole.columns[:3] == ["unscored", "roc_auc", "ks"] and abs(whole.first().roc_auc - plain(rows, 0.5)["roc_auc"]) < 1e-9
    assert bu.bundle(scored(spark, [])).count() == 0


def test_bundle_reads_and_shuffles_the_scores_once(spark, monkeypatch):
    plans, cut = [], bu.cut_lineage
    monkeypatch.setattr(bu, "cut_lineage", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), cut(df))[1])
    source = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").selectExpr("l_returnflag as g", "l_discount as pd", "cast(l_quantity > 25 as int) as y")
    out = bu.bundle(source, group_cols=["g"])
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert [p.count("FileScan parquet") for p in plans] == [1] + [0] * (len(plans) - 1)
    assert plans[0].count("Exchange hashpartitioning") == 1
    assert out.count() == source.select("g").distinct().count()


def test_registry_refuses_clashes():
    with pytest.raises(ValueError):
        bu.metric("ks", lambda: F.lit(1))
    with pytest.raises(ValueError):
        bu.metric("own", lambda: F.lit(1), _gap=("max", lambda: F.lit(1)))
    with pytest.raises(ValueError):
        bu.metric("own", lambda: F.lit(1), _own=("avg", lambda: F.lit(1)))


def test_keyed_zip(spark):
    a = spark.createDataFrame([(i, i * 1.0) for i in range(50)], "id long, f double")
    b = spark.createDataFrame([(i, str(i)) for i in range(50)], "id long, s string")
    c = spark.createDataFrame([(i, -i) for i in range(49, -1, -1)], "id long, t long")
    z = KeyedZip({"a": a, "b": b, "c": c}, "id", 4)
    assert "Exchange" not in z.rows()._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, r.f, r.s, r.t) for r in z.complete().collect()) == [(i, float(i), str(i), -i) for i in range(50)]
    worse = KeyedZip({"a": a.filter("id <> 7").unionByName(a.filter("id = 9")), "b": b.selectExpr("nullif(id, 3) as id", "s"), "c": c}, "id", 4)
    assert sorted((r.part, r.fault, r.key or -1, r.rows) for r in worse.faults().collect()) == [
        ("a", "missing", 7, 0), ("a", "repeated", 9, 2), ("b", "missing", 3, 0), ("b", "null", -1, 1)]
    with pytest.raises(Incomplete, match="a: missing 1, a: repeated 1"):
        worse.complete()
    assert KeyedZip({"a": a.limit(0), "b": b.limit(0)}, "id", 2).complete().count() == 0
    with pytest.raises(ValueError):
        KeyedZip({"a": a, "b": a}, "id")


def test_blocks_are_balanced(spark):
    rows = [(i, "hot" if i % 3 else None if i % 2 else "cold") for i in range(1003)]
    out = xp.assign_in_blocks(spark.createDataFrame(rows, "id long, s string"), ["s"], "id").collect()
    assert len(out) == 1003
    for s in ("hot", "cold", None):
        own = [r for r in out if r.s == s]
        sizes = Counter(r.arm for r in own)
        assert max(sizes.values()) - min(sizes.get(a, 0) for a in xp.ARMS) <= 1
        blocks = Counter(r.block for r in own)
        assert all(n == 4 for b, n in blocks.items() if b < max(blocks))
    assert len({tuple(r.arm for r in sorted(out, key=lambda r: r.id) if r.s == "hot" and r.block == b) for b in range(40)}) > 5


def test_pilot_refuses_a_null_arm(spark):
    df = spark.createDataFrame([(None, 1.0, 1.0, 0, 1)], "arm string, contribution double, baseline_spend double, delinquency int, accepted int")
    with pytest.raises(ValueError):
        xp.analyze_pilot(df)


SCHEMA = "user_id long, ts timestamp_ntz, event_type string, value double"


def test_session_stream_cut_and_late(spark, tmp_path):
    rng = random.Random(5)
    at = sorted(rng.randrange(200_000) for _ in range(300))
    events = spark.createDataFrame([(rng.randrange(6), s, "error" if s % 5 == 0 else "view", s / 7) for s in at], "user_id long, s long, event_type string, value double")
    events = events.selectExpr("user_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) as ts", "event_type", "value").cache()
    order = F.unix_micros(F.col("ts").cast("timestamp"))
    q = events.agg(F.percentile_approx(order, [0.25, 0.5, 0.75]).alias("q")).first().q
    quarter = F.size(F.filter(F.array(*[F.lit(c) for c in q]), lambda c: c < order))
    runs = []
    for name, parts in (("once", [[events]]), ("cut", [[events.filter(quarter == i).coalesce(1) for i in pair] for pair in ((0, 1), (2, 3))])):
        folders = [str(tmp_path / name / x) for x in ("in", "out", "state")]
        for several in parts:  # a new object goes on from the checkpoint, file by file
            stream = SessionStream(spark, events.schema, *folders)
            for p in several:
                stream.add(p)
            stream.run(None if name == "once" else 1)
        if name == "cut":
            stream.add(spark.sql("select 99L as user_id, timestamp_ntz'2023-12-01 00:00:00' as ts, 'view' as event_type, 1.0D as value"))
            stream.run()
        stream.close()
        runs.append(sorted(tuple(r) for r in stream.found().collect()))
        assert [(r.user_id, r.late) for r in stream.late().collect()] == ([(99, 1)] if name == "cut" else [])
    assert runs[0] == sorted(tuple(r) for r in sessions(events).collect()) == runs[1]
