"""Canonical JSON, maker-checker rules with NULLs, and readiness instants."""

import hashlib
import json

from pyspark.sql import functions as F

from creditlens.operators import contracts as ct
from creditlens.operators import evaluate as ev
from creditlens.operators import ledger
from creditlens.sources import adapters


def test_event_hash_is_that_of_ascii_json(spark):
    rows = [("plain",), (None,), ("é ñ 日本 😀",), ('quote " back \\ slash',), ("line\nfeed\ttab\r\b\f\x01\x7f",), ("",)]
    df = spark.createDataFrame([(r[0], "x") for r in rows], "reason string, other string")
    for k in ledger.HASH_KEYS:
        if k not in df.columns:
            df = df.withColumn(k, F.lit(k))
    got = {r.reason: r.h for r in df.select("reason", ledger.event_hash("x", F.col("previous_hash")).alias("h")).collect()}
    for (text,) in rows:
        doc = {k: (text if k == "reason" else k) for k in ledger.HASH_KEYS}
        assert got[text] == hashlib.sha256(json.dumps(doc, sort_keys=True, separators=(",", ":")).encode()).hexdigest(), text


def test_null_checker_and_long_checker(spark):
    ok = (ledger.REVIEW_DECISIONS[0], ledger.REVIEW_REASONS[0])
    rows = [("R1", 0, "ACC-000001", "submitted", "ann", *ok), ("R1", 1, "ACC-000001", "approved", None, *ok),
            ("R2", 0, "ACC-0000012", "submitted", "ann", *ok), ("R2", 1, "ACC-0000012", "approved", "b" * 90, *ok),
            ("R3", 0, "ACC-000003", "submitted", "ann", None, ok[1])]
    df = spark.createDataFrame(rows, "review_id string, seq long, account_id string, event string, actor string, decision string, reason string")
    found = {(r.review_id, r.rule) for r in ledger.violations(df).collect()}
    assert found == {("R1", "distinct_checker"), ("R3", "governed_values")}


def test_readiness_needs_every_instant(spark, small_dir):
    df = adapters.readiness_records(spark, small_dir)
    _, passing = ct.readiness(df)
    one = df.join(passing.select("customer_reference").limit(1), "customer_reference")
    for value, rule in (("2030-01-01T00:00:00.5+05:30", "evidence_after_decision"), ("2001-02-30T00:00:00+05:30", "timestamp_unparseable"),
                        ("2001-01-01 00:00:00+05:30", "timestamp_unparseable")):
        v, ok = ct.readiness(one.withColumn("consent_timestamp", F.lit(value)))
        assert rule in {r.rule for r in v.collect()} and ok.count() == 0


def test_duplicate_ids_are_trimmed(spark):
    df = spark.createDataFrame([(" A1",), ("A1",), ("A2",)], "account_id string")
    trimmed = df.withColumn("account_id", F.trim("account_id"))
    assert [r.account_id for r in ct.duplicate_keys(trimmed, "account_id").collect()] == ["A1"]


def test_scores_that_are_missing_take_no_part(spark):
    rows = [(0.9, 1), (0.8, 0), (0.7, 1), (None, 0), (float("nan"), 0), (0.1, None)]
    df = spark.createDataFrame(rows, "pd double, y int")
    r = ev.discrimination(df).first()
    assert (r.positives, r.negatives, r.roc_auc) == (2, 1, 0.5) and abs(r.average_precision - (1 + 2 / 3) / 2) < 1e-12
    assert ev.unscored(df).first().unscored == 2


def test_buckets_follow_the_data(spark):
    df = spark.range(20_000).select((F.col("id") / 20_000).alias("pd"), (F.col("id") % 2).alias("y")).unionByName(
        spark.createDataFrame([(1e12, 1)], "pd double, y long"))
    h = ev.score_histogram(df)
    edges = h.agg(F.percentile_approx("score", [i / 64 for i in range(1, 64)], 640)).first()[0]
    counts = [0] * 64
    for r in h.select("score").collect():
        counts[sum(e < r.score for e in edges)] += 1
    assert max(counts) < 3 * 20_000 / 64
    assert abs(ev.discrimination(df).first().roc_auc - 0.5) < 0.01


def test_rank_cells(spark):
    rows = [(f"k{i:03d}", [0.5, 0.5, 0.5, 0.2, 0.9][i % 5], i % 3 == 0) for i in range(100)]
    df = spark.createDataFrame(rows, "account_id string, pd double, y boolean").withColumn("y", F.col("y").cast("int"))
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    cuts = [10, 25, 26, 60, 90]
    want = {}
    for rank, (_, s, y) in enumerate(order, 1):
        c = sum(x < rank for x in cuts)
        n, e = want.get(c, (0, 0))
        want[c] = (n + 1, e + y)
    assert {r.cell: (r.accounts, r.events) for r in ev.rank_cells(df, cuts).collect()} == want
