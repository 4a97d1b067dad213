"""Scenario deltas (D18), feature summary (A13), nearest-rank percentiles (A21), sessions (ST3)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from creditlens.functions.columns import dround, sql_dround, sql_dsum
from creditlens.operators import evaluate as ev
from creditlens.operators import scenarios
from creditlens.operators.features import FEATURE_NAMES, engineer_features
from creditlens.operators.policy import PolicyAssumptions
from creditlens.plans.features import feature_select_sql
from creditlens.plans.oracle_base import acct_ctes, suffixed_decision_ctes, with_ctes
from creditlens.plans.registry import register
from creditlens.sources import adapters
from creditlens.sources.tables import read_table

SCENARIO = replace(PolicyAssumptions(), lgd=0.55, response_elasticity=0.45, profitability_hurdle=250.0)


def _deltas_sql() -> str:
    ms = ["proposed_limit", "proposed_expected_loss", "eligible_increases", "incremental_contribution"]

    def val(sfx, m):
        if m == "eligible_increases":
            return f"(SELECT CAST(sum(CASE WHEN increase_pct > 0 THEN 1 ELSE 0 END) AS DOUBLE) FROM decided{sfx})"
        return f"(SELECT {sql_dsum(m)} FROM decided{sfx})"
    sel = " UNION ALL ".join(f"SELECT '{m}' AS metric, {val('_b', m)} AS baseline, {val('_s', m)} AS scenario" for m in ms)
    return with_ctes(acct_ctes(), suffixed_decision_ctes("_b", PolicyAssumptions()),
                     suffixed_decision_ctes("_s", SCENARIO)) + f"\nSELECT *, scenario - baseline AS change FROM ({sel})"


@register("scenario_deltas", _deltas_sql)
def q_scenario_deltas(spark, sf_dir):
    return scenarios.scenario_deltas(adapters.shared_scored(spark, sf_dir), SCENARIO)


QS = (0.01, 0.5, 0.99)


def _feature_summary_sql() -> str:
    return with_ctes(acct_ctes()) + f""",
feat AS ({feature_select_sql()}),
lng AS (SELECT feature, value FROM (UNPIVOT feat ON {', '.join(FEATURE_NAMES)} INTO NAME feature VALUE value))
SELECT feature, {sql_dround('quantile_cont(value, 0.01)', 6)} AS p01, {sql_dround('quantile_cont(value, 0.5)', 6)} AS median,
       {sql_dround('quantile_cont(value, 0.99)', 6)} AS p99,
       {sql_dround('avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END)', 6)} AS missing_rate
FROM lng GROUP BY feature"""


@register("feature_summary", _feature_summary_sql)
def q_feature_summary(spark, sf_dir):
    f = engineer_features(adapters.shared_scored(spark, sf_dir), keep=[])
    f = f.select(*[dround(c, 6).alias(c) for c in FEATURE_NAMES])
    lng = f.unpivot([], FEATURE_NAMES, "feature", "value")
    miss = lng.groupBy("feature").agg(F.avg(F.col("value").isNull().cast("double")).alias("missing_rate"))
    obs = lng.filter(F.col("value").isNotNull()).withColumn("_y", F.lit(0))
    q = ev.order_statistics(ev.cumulative_scores(obs, "value", "_y", ["feature"]), QS, ["feature"])
    return q.join(miss, "feature").select("feature", dround("q0", 6).alias("p01"), dround("q1", 6).alias("median"),
                                          dround("q2", 6).alias("p99"), dround("missing_rate", 6).alias("missing_rate"))


@register("value_percentiles", """
WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS rk,
                  count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL)
SELECT event_type, CAST(max(n) AS BIGINT) AS n,
       max(CASE WHEN rk = greatest(ceil(n * 0.5), 1) THEN value END) AS p50,
       max(CASE WHEN rk = greatest(ceil(n * 0.95), 1) THEN value END) AS p95
FROM r GROUP BY event_type""")
def q_value_percentiles(spark, sf_dir):
    ev_ = read_table(spark, sf_dir, "events", ["event_type", "value"]).filter(F.col("value").isNotNull())
    cum = ev.cumulative_scores(ev_.withColumn("_y", F.lit(0)), "value", "_y", ["event_type"])
    return ev.nearest_rank(cum, [0.5, 0.95], ["event_type"]).select("event_type", "n", F.col("p0").alias("p50"),
                                                                      F.col("p1").alias("p95"))


SESSION_GAP_MINUTES = 30


@register("session_counters", f"""
WITH e AS (SELECT user_id, ts, value, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS err,
                  CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                         OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL {SESSION_GAP_MINUTES} MINUTE
                       THEN 1 ELSE 0 END AS new_s FROM events),
s AS (SELECT *, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e)
SELECT user_id, epoch_us(min(ts)) AS session_start_us, CAST(count(*) AS BIGINT) AS events,
       CAST(sum(err) AS BIGINT) AS errors, {sql_dround('avg(value)', 6)} AS mean_value, max(value) AS max_value
FROM s GROUP BY user_id, sid""")
def q_session_counters(spark, sf_dir):
    from creditlens.streaming.counters import sessions
    return sessions(read_table(spark, sf_dir, "events", ["user_id", "ts", "event_type", "value"]), SESSION_GAP_MINUTES)
