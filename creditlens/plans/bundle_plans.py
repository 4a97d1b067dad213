"""Queries of the one-pass metric bundle, the keyed zip, stratified assignment and the session stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from creditlens.functions.columns import dround, sql_dround
from creditlens.operators import evaluate as ev
from creditlens.operators import experiment as xp
from creditlens.operators.bundle import bundle
from creditlens.operators.features import engineer_features
from creditlens.operators.keyed import KeyedZip
from creditlens.plans.evaluation import COHORT_METRICS, _base_sql, _cohort_sql
from creditlens.plans.oracle_base import acct_ctes, with_ctes
from creditlens.plans.registry import ORACLE, register
from creditlens.session import ensure_checkpoint_dir
from creditlens.sources import adapters
from creditlens.sources.tables import read_table

THRESHOLD = 0.2
BUNDLE_ROUNDED = [*COHORT_METRICS, "precision", "recall", "f1", "best_threshold", "calibration_gap"]


def _bundle_sql() -> str:
    cuts = ", ".join(f"{t!r}" for t in ev.THRESHOLDS)
    at = ", ".join(f"{x!r}" for x in ev.linspace(0.0, 1.0, 11))
    f1 = "coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0)"
    metrics = ", ".join(f"{sql_dround('cm.' + m, 6)} AS {m}" for m in COHORT_METRICS)
    return _base_sql(_cohort_sql("source_dataset") + f""",
cf AS (SELECT source_dataset AS g, sum(y) AS events, sum(CASE WHEN pd >= {THRESHOLD} THEN y ELSE 0 END) AS tp, sum(CASE WHEN pd >= {THRESHOLD} THEN 1 - y ELSE 0 END) AS fp,
              sum(CASE WHEN pd < {THRESHOLD} THEN 1 - y ELSE 0 END) AS tn, sum(CASE WHEN pd < {THRESHOLD} THEN y ELSE 0 END) AS fn FROM scored_y GROUP BY 1),
co AS (SELECT source_dataset AS g, t, sum(CASE WHEN pd < t THEN {ev.FN_COST} * y ELSE 1 - y END) AS cost FROM scored_y, (SELECT unnest([{cuts}]::DOUBLE[]) AS t) GROUP BY 1, 2),
be AS (SELECT g, t, cost FROM co QUALIFY row_number() OVER (PARTITION BY g ORDER BY cost, t) = 1),
ed AS (SELECT source_dataset AS g, list_sort(list_distinct(quantile_cont(pd, [{at}]))) AS e FROM scored_y GROUP BY 1),
bi AS (SELECT ed.g, len(list_filter(e[2:len(e) - 1], lambda x: x < pd)) AS bin, avg(pd) AS p, avg(CAST(y AS DOUBLE)) AS o
       FROM scored_y JOIN ed ON ed.g IS NOT DISTINCT FROM source_dataset GROUP BY 1, 2),
ga AS (SELECT g, avg(abs(p - o)) AS gap FROM bi GROUP BY 1)
SELECT cm.g AS source_dataset, cm.accounts, CAST(events AS BIGINT) AS events, CAST(0 AS BIGINT) AS unscored, {metrics},
  CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn,
  {sql_dround('coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0.0)', 6)} AS precision, {sql_dround('coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0.0)', 6)} AS recall,
  {sql_dround(f1, 6)} AS f1, {sql_dround('t', 6)} AS best_threshold, CAST(cost AS BIGINT) AS best_cost, {sql_dround('gap', 6)} AS calibration_gap
FROM cm JOIN cf ON cf.g IS NOT DISTINCT FROM cm.g JOIN be ON be.g IS NOT DISTINCT FROM cm.g JOIN ga ON ga.g IS NOT DISTINCT FROM cm.g""")


@register("metric_bundle", _bundle_sql)
def q_metric_bundle(spark, sf_dir):
    """Every metric per source from one pass over the scores (E13, A17, MO2)."""
    b = bundle(adapters.shared_scored(spark, sf_dir), group_cols=["source_dataset"], threshold=THRESHOLD)
    return b.select(*[dround(c, 6).alias(c) if c in BUNDLE_ROUNDED else F.col(c) for c in b.columns])


def _parts(spark, sf_dir):
    s = adapters.shared_scored(spark, sf_dir)
    features = engineer_features(s, keep=["account_id"]).select("account_id", "current_utilization", "delinquent_month_count")
    return {"features": features, "scores": s.select("account_id", "pd"), "ids": s.select("account_id", "source_dataset", "vintage")}


@register("keyed_zip", lambda: with_ctes(acct_ctes()) + f"""
SELECT s.account_id, {sql_dround('s.pd', 6)} AS pd, s.source_dataset, s.vintage, {sql_dround('least(greatest(greatest(a.BILL_AMT1, 0.0) / greatest(a.LIMIT_BAL, 1.0), -20.0), 20.0)', 6)} AS current_utilization
FROM scored_y s JOIN acct6 a ON a.account_id = s.account_id""")
def q_keyed_zip(spark, sf_dir):
    """Features, scores and ids zipped by account_id, after proof that no key is missing or repeated."""
    z = KeyedZip(_parts(spark, sf_dir), "account_id").complete()
    return z.select("account_id", dround("pd", 6).alias("pd"), "source_dataset", "vintage", dround("current_utilization", 6).alias("current_utilization"))


_DIGEST = "substr(md5(account_id), 1, 1)"


@register("keyed_zip_faults", lambda: with_ctes(acct_ctes()) + f""",
x AS (SELECT account_id, {_DIGEST} AS d FROM scored_y)
SELECT 'scores' AS part, 'missing' AS fault, account_id AS key, CAST(0 AS BIGINT) AS rows FROM x WHERE d = '0'
UNION ALL SELECT 'features', 'repeated', account_id, CAST(2 AS BIGINT) FROM x WHERE d = '1'
UNION ALL SELECT 'ids', 'null', NULL, CAST(count(*) AS BIGINT) FROM x WHERE d = '2' HAVING count(*) > 0
UNION ALL SELECT 'ids', 'missing', account_id, CAST(0 AS BIGINT) FROM x WHERE d = '2'""")
def q_keyed_zip_faults(spark, sf_dir):
    """Planted faults: scores left out, features given twice, ids without a key."""
    p = _parts(spark, sf_dir)
    d = F.expr(_DIGEST)
    parts = {"features": p["features"].unionByName(p["features"].filter(d == "1")), "scores": p["scores"].filter(d != "0"),
             "ids": p["ids"].withColumn("account_id", F.when(d != "2", F.col("account_id")))}
    return KeyedZip(parts, "account_id").faults()


def _blocks_sql() -> str:
    arms = ", ".join(f"{{'h': md5('{xp.SEED}:' || coalesce(c_mktsegment, '') || ':' || b || ':{a}'), 'arm': '{a}'}}" for a in xp.ARMS)
    return f"""
WITH r AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5('{xp.SEED}:' || c_custkey), c_custkey) - 1 AS k FROM customer),
b AS (SELECT *, CAST(k // {len(xp.ARMS)} AS BIGINT) AS b FROM r)
SELECT c_custkey, c_mktsegment, b AS block, list_sort([{arms}])[CAST(k % {len(xp.ARMS)} + 1 AS INTEGER)].arm AS arm FROM b"""


@register("stratified_assignment", _blocks_sql)
def q_stratified_assignment(spark, sf_dir):
    """Arms by permuted blocks inside market segments."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    return xp.assign_in_blocks(c, ["c_mktsegment"], "c_custkey").select("c_custkey", "c_mktsegment", "block", "arm")


SESSION_PARTS = 3


@register("session_stream", lambda: ORACLE["session_counters"])
def q_session_stream(spark, sf_dir):
    """The session counters from a stream in append mode, cut and restarted between parts of the events (ST3)."""
    from creditlens.plans.summary_plans import SESSION_GAP_MINUTES
    from creditlens.streaming.counters import SessionStream
    events = read_table(spark, sf_dir, "events", ["user_id", "ts", "event_type", "value"])
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = events.agg(F.percentile_approx(at, [i / SESSION_PARTS for i in range(1, SESSION_PARTS)]).alias("c")).first()["c"] or []  # two numbers
    home = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sessions-{uuid.uuid4().hex}"
    stream = SessionStream(spark, events.schema, f"{home}/in", f"{home}/out", f"{home}/state", SESSION_GAP_MINUTES)
    part = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>"), lambda c: c < at))
    for i in range(SESSION_PARTS):
        stream.add(events.filter(part == i))
        stream.run()
    stream.close()
    return stream.found()
