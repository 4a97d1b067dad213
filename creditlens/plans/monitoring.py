"""Monitoring queries (E18, E19, MO1, MO3) over the events snapshot and account features."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions.columns import dround, sql_dround
from creditlens.operators import evaluate as ev
from creditlens.operators import monitor
from creditlens.operators.features import FEATURE_NAMES, engineer_features
from creditlens.plans.features import feature_select_sql
from creditlens.plans.oracle_base import acct_ctes, with_ctes
from creditlens.plans.registry import register
from creditlens.sources import adapters

REFERENCE_VINTAGE = 1995


def _snapshot_with_reference(spark, sf_dir):
    snap = adapters.shared_snapshot(spark, sf_dir)
    p0 = snap.agg(F.min("period")).first()[0]  # tiny statistic: first (reference) week
    ref = snap.filter(F.col("period") == F.lit(p0))
    return snap, ref


SNAP_SQL = """
snap AS (
  SELECT event_id, CAST(date_trunc('week', ts) AS DATE) AS period,
         least(value / 500.0::DOUBLE, 1.0::DOUBLE) AS probability,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS outcome,
         CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS DOUBLE) AS delinquency_count,
         least(value / 100.0::DOUBLE, 5.0::DOUBLE) AS utilization, event_type AS action,
         CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL THEN NULL
              WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 0 THEN 1 ELSE 0 END AS override
  FROM events),
p0 AS (SELECT min(period) AS p0 FROM snap)"""


def _bin_sql(col: str) -> str:
    return "(" + " + ".join(f"CASE WHEN {col} >= {e!r}::DOUBLE THEN 1 ELSE 0 END" for e in ev.HIST_EDGES[1:-1]) + ")"


PSI_SQL = f""",
bins AS (SELECT range AS bin FROM range(20)),
periods AS (SELECT DISTINCT period FROM snap),
hist AS (SELECT period, {_bin_sql('probability')} AS bin, count(*) AS c FROM snap
         WHERE probability >= 0.0 AND probability <= 1.0 GROUP BY 1, 2),
fullh AS (SELECT p.period, b.bin, CAST(coalesce(h.c, 0) AS DOUBLE) AS c FROM periods p CROSS JOIN bins b
          LEFT JOIN hist h ON h.period = p.period AND h.bin = b.bin),
ref AS (SELECT bin, c AS rc, sum(c) OVER () AS te FROM fullh, p0 WHERE period = p0.p0),
psi AS (SELECT f.period, sum((greatest(f.c / f.ta, 1e-6) - greatest(r.rc / r.te, 1e-6))
                        * ln(greatest(f.c / f.ta, 1e-6) / greatest(r.rc / r.te, 1e-6))) AS score_psi
        FROM (SELECT *, greatest(sum(c) OVER (PARTITION BY period), 1) AS ta FROM fullh) f JOIN ref r ON r.bin = f.bin
        GROUP BY f.period)"""


@register("score_psi", lambda: with_ctes(SNAP_SQL) + PSI_SQL + f"""
SELECT period, {sql_dround('score_psi', 6)} AS score_psi FROM psi""")
def q_score_psi(spark, sf_dir):
    snap, ref = _snapshot_with_reference(spark, sf_dir)
    h = monitor.reference_histogram(ref)
    return monitor.score_psi(h, snap, "probability", ["period"]).select(
        "period", dround("score_psi", 6).alias("score_psi"))


STATUS_COLS = ["brier_score", "roc_auc", "score_psi", "calibration_gap", "max_missing_rate",
               "override_rate", "brier_delta"]


def _status_sql() -> str:
    t = monitor.MonitoringThresholds()
    qs = ", ".join(f"{q!r}" for q in ev.DECILE_QUANTILES)
    miss = ", ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)" for c in monitor.NUMERIC_SIGNALS)
    return with_ctes(SNAP_SQL) + PSI_SQL + f""",
base AS (SELECT period, CAST(count(*) AS BIGINT) AS rows, avg((probability - outcome) * (probability - outcome)) AS brier_score,
                greatest({miss}) AS max_missing_rate, avg(coalesce(CAST(override AS DOUBLE), 0.0)) AS override_rate
         FROM snap GROUP BY period),
refb AS (SELECT b.brier_score AS rb FROM base b, p0 WHERE b.period = p0.p0),
rk AS (SELECT period, outcome, rank() OVER (PARTITION BY period ORDER BY probability)
              + (count(*) OVER (PARTITION BY period, probability) - 1) / 2.0 AS r FROM snap),
auc AS (SELECT period, (sum(CASE WHEN outcome = 1 THEN r END) - sum(outcome) * (sum(outcome) + 1) / 2.0)
               / (CAST(sum(outcome) AS DOUBLE) * sum(1 - outcome)) AS roc_auc FROM rk GROUP BY period),
edges AS (SELECT period, list_sort(list_distinct(quantile_cont(probability, [{qs}]))) AS e FROM snap GROUP BY period),
qb AS (SELECT s.period, s.probability, s.outcome,
              len(list_filter(list_slice(e.e, 2, len(e.e) - 1), lambda x: x < s.probability)) AS b
       FROM snap s JOIN edges e ON e.period = s.period),
gap AS (SELECT period, avg(abs(o - p)) AS calibration_gap FROM (
          SELECT period, b, avg(CAST(outcome AS DOUBLE)) AS o, avg(probability) AS p FROM qb GROUP BY 1, 2) GROUP BY 1),
sig AS (SELECT base.*, auc.roc_auc, psi.score_psi, gap.calibration_gap, base.brier_score - refb.rb AS brier_delta
        FROM base JOIN auc USING (period) JOIN psi USING (period) JOIN gap USING (period), refb)
SELECT period, rows, {', '.join(f"{sql_dround(c, 6)} AS {c}" for c in STATUS_COLS)},
  CASE WHEN score_psi >= {t.psi_red} OR brier_delta >= {t.brier_delta_red} OR calibration_gap >= {t.calibration_gap_red}
            OR max_missing_rate >= {t.missing_rate_red} THEN 'red'
       WHEN score_psi >= {t.psi_amber} OR brier_delta >= {t.brier_delta_amber}
            OR calibration_gap >= {t.calibration_gap_amber} THEN 'amber' ELSE 'green' END AS status
FROM sig"""


@register("monitoring_status", _status_sql)
def q_monitoring_status(spark, sf_dir):
    snap, ref = _snapshot_with_reference(spark, sf_dir)
    hist = monitor.reference_histogram(ref)
    rb = ref.agg(F.avg((F.col("probability") - F.col("outcome")) ** 2)).first()[0]  # tiny statistic
    s = monitor.snapshot_signals(snap, hist, rb, ["period"])
    return s.select("period", F.col("rows").cast("bigint").alias("rows"),
                    *[dround(c, 6).alias(c) for c in STATUS_COLS], "status")


@register("monitoring_checks", lambda: "SELECT period, score_psi >= 0.1 AS psi_warning, score_psi >= 0.25 AS psi_action, calibration_gap > 0.05 AS calibration_warning, "
          "CASE WHEN pm > 0 THEN abs(max_missing_rate - pm) / pm > 0.2 WHEN pm = 0 THEN max_missing_rate > 0.2 END AS missingness_shift FROM ("
          "SELECT *, lag(max_missing_rate) OVER (ORDER BY period) AS pm FROM (" + _status_sql() + "))")
def q_monitoring_checks(spark, sf_dir):
    """Score shift, calibration and missingness flags of each week (MO3)."""
    snap, ref = _snapshot_with_reference(spark, sf_dir)
    rb = ref.agg(F.avg((F.col("probability") - F.col("outcome")) ** 2)).first()[0]  # tiny statistic
    s = monitor.snapshot_signals(snap, monitor.reference_histogram(ref), rb, ["period"])
    return monitor.period_checks(s.select("period", *[dround(c, 6).alias(c) for c in ("score_psi", "calibration_gap", "max_missing_rate")]))


@register("monitoring_action_mix", with_ctes(SNAP_SQL) + """
SELECT period, action, CAST(count(*) AS BIGINT) AS rows FROM snap GROUP BY 1, 2""")
def q_monitoring_action_mix(spark, sf_dir):
    """How often each action was taken in each week (MO1, A19)."""
    return adapters.shared_snapshot(spark, sf_dir).groupBy("period", "action").agg(F.count(F.lit(1)).alias("rows"))


@register("monitoring_guards", with_ctes(SNAP_SQL) + """,
f AS (SELECT period, CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN 1.5 ELSE probability END AS p,
             CASE WHEN event_id % 107 = 0 THEN NULL WHEN event_id % 109 = 0 THEN 2 WHEN period = p0.p0 THEN 0 ELSE outcome END AS y FROM snap, p0),
r AS (SELECT period, 'probability_blank' AS rule, count(*) AS rows FROM f WHERE p IS NULL GROUP BY 1
      UNION ALL SELECT period, 'probability_range', count(*) FROM f WHERE p < 0 OR p > 1 GROUP BY 1
      UNION ALL SELECT period, 'outcome_blank', count(*) FROM f WHERE y IS NULL GROUP BY 1
      UNION ALL SELECT period, 'outcome_not_binary', count(*) FROM f WHERE y NOT IN (0, 1) GROUP BY 1
      UNION ALL SELECT period, 'one_outcome_class', count(*) FROM f GROUP BY 1 HAVING count(DISTINCT y) < 2)
SELECT period, rule, CAST(rows AS BIGINT) AS rows FROM r""")
def q_monitoring_guards(spark, sf_dir):
    """What the guards find in a snapshot with faults by event number (MO1)."""
    snap, _ = _snapshot_with_reference(spark, sf_dir)
    p0 = snap.agg(F.min("period")).first()[0]  # tiny statistic
    i = F.col("event_id")
    faulty = snap.select("period", F.when(i % 101 == 0, F.lit(None)).when(i % 103 == 0, 1.5).otherwise(F.col("probability")).alias("probability"),
                         F.when(i % 107 == 0, F.lit(None)).when(i % 109 == 0, 2).when(F.col("period") == F.lit(p0), 0).otherwise(F.col("outcome")).alias("outcome"))
    return monitor.snapshot_guards(faulty, ["period"])


@register("monitoring_by_period", lambda: with_ctes(SNAP_SQL) + f""",
a AS (SELECT period, action, count(*) AS rows, avg(probability) AS mean_score, avg(CAST(outcome AS DOUBLE)) AS event_rate
      FROM snap GROUP BY 1, 2),
b AS (SELECT *, rows / sum(rows) OVER (PARTITION BY period) AS mix_share FROM a),
c AS (SELECT *, lag(event_rate) OVER (PARTITION BY action ORDER BY period) AS pr,
             lag(mix_share) OVER (PARTITION BY action ORDER BY period) AS pm FROM b)
SELECT period, action, CAST(rows AS BIGINT) AS rows, {sql_dround('mean_score', 6)} AS mean_score,
       {sql_dround('event_rate', 6)} AS event_rate, {sql_dround('mix_share', 6)} AS mix_share,
       CASE WHEN pr > 0 THEN abs(event_rate - pr) / pr > 0.2 WHEN pr = 0 THEN event_rate > 0 END AS risk_rate_shift,
       abs(mix_share - pm) > 0.05 AS mix_shift
FROM c""")
def q_monitoring_by_period(spark, sf_dir):
    d = monitor.period_drift(adapters.shared_snapshot(spark, sf_dir), "period", "action")
    return d.select("period", "action", F.col("rows").cast("bigint").alias("rows"),
                    *[dround(c, 6).alias(c) for c in ("mean_score", "event_rate", "mix_share")],
                    "risk_rate_shift", "mix_shift")


def _feature_psi_sql() -> str:
    qs = ", ".join(f"{q!r}" for q in ev.DECILE_QUANTILES)
    return with_ctes(acct_ctes()) + f""",
feat AS ({feature_select_sql()}),
lng AS (SELECT vintage, feature, value FROM (UNPIVOT feat ON {', '.join(FEATURE_NAMES)} INTO NAME feature VALUE value)),
ref AS (SELECT * FROM lng WHERE vintage = {REFERENCE_VINTAGE}),
cmp AS (SELECT * FROM lng WHERE vintage > {REFERENCE_VINTAGE}),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [{qs}]))) AS e FROM ref GROUP BY feature),
binned AS (SELECT x.pop, x.feature, len(list_filter(list_slice(e.e, 2, len(e.e) - 1), lambda v: v <= x.value)) AS bin
           FROM (SELECT 'e' AS pop, feature, value FROM ref UNION ALL SELECT 'a', feature, value FROM cmp) x
           JOIN edges e ON e.feature = x.feature),
cnt AS (SELECT feature, bin, sum(CASE WHEN pop = 'e' THEN 1 ELSE 0 END) AS ne, sum(CASE WHEN pop = 'a' THEN 1 ELSE 0 END) AS na
        FROM binned GROUP BY 1, 2),
sh AS (SELECT feature, bin, ne / sum(ne) OVER (PARTITION BY feature) AS es, na / sum(na) OVER (PARTITION BY feature) AS as_ FROM cnt),
psi AS (SELECT feature, sum((greatest(as_, 1e-6) - greatest(es, 1e-6)) * ln(greatest(as_, 1e-6) / greatest(es, 1e-6))) AS psi
        FROM sh GROUP BY feature),
res AS (SELECT p.feature, CASE WHEN len(e.e) < 3 THEN 0.0 ELSE p.psi END AS psi FROM psi p JOIN edges e ON e.feature = p.feature)
SELECT feature, {sql_dround('psi', 6)} AS psi,
       CASE WHEN psi < 0.10 THEN 'Stable' WHEN psi < 0.25 THEN 'Monitor' ELSE 'Investigate' END AS status
FROM res"""


@register("feature_psi", _feature_psi_sql)
def q_feature_psi(spark, sf_dir):
    a = adapters.shared_scored(spark, sf_dir)
    f = engineer_features(a, keep=["account_id", "first_order"])
    f = f.select(F.year("first_order").alias("vintage"), *[dround(c, 6).alias(c) for c in FEATURE_NAMES])
    ref = f.filter(F.col("vintage") == REFERENCE_VINTAGE)
    cmp_ = f.filter(F.col("vintage") > REFERENCE_VINTAGE)
    p = monitor.feature_psi(ref, cmp_, FEATURE_NAMES)
    return p.select("feature", dround("psi", 6).alias("psi"), "status")


@register("top_drift_features", lambda: "SELECT * FROM (" + _feature_psi_sql() + ") ORDER BY psi DESC, feature LIMIT 12")
def q_top_drift(spark, sf_dir):
    from creditlens.operators.explorer import top_k
    return top_k(q_feature_psi(spark, sf_dir), [F.desc("psi"), F.asc("feature")], 12)


BASELINE_MISSING = ["delinquency_count", "utilization", "debt_to_income", "credit_lines", "income_inr",
                    "credit_age_months"]


# Monitoring thresholds of the baseline.
BASELINE_THRESHOLDS = {"score_psi_warning": 0.10, "score_psi_action": 0.25, "calibration_gap_warning": 0.05, "risk_rate_relative_shift_warning": 0.20,
                       "missingness_relative_shift_warning": 0.20, "source_mix_share_shift_warning": 0.05}


@register("monitoring_baseline", lambda: with_ctes(acct_ctes()) + f"""
SELECT 'source_mix' AS section, source_dataset AS key, 'share' AS metric,
       {sql_dround('count(*) / CAST((SELECT count(*) FROM scored_y) AS DOUBLE)', 6)} AS value FROM scored_y GROUP BY 2
UNION ALL
SELECT 'missingness', feature, 'missing_rate', {sql_dround('missing_rate', 6)} FROM (UNPIVOT (
  SELECT {', '.join(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS {c}' for c in BASELINE_MISSING)} FROM scored_y)
  ON {', '.join(BASELINE_MISSING)} INTO NAME feature VALUE missing_rate)
UNION ALL
SELECT 'histogram', CAST(e.range AS VARCHAR), 'count', CAST(count(s.pd) AS DOUBLE)
FROM range(20) e LEFT JOIN scored_y s ON {_bin_sql('s.pd')} = e.range AND s.pd >= 0 AND s.pd <= 1 GROUP BY e.range
UNION ALL
SELECT 'risk_band', CASE WHEN pd < 0.05 THEN 'Low' WHEN pd < 0.15 THEN 'Moderate' WHEN pd < 0.30 THEN 'High'
       ELSE 'Very high' END, 'accounts', CAST(count(*) AS DOUBLE) FROM scored_y GROUP BY 2
UNION ALL
SELECT 'source_signal', source_dataset, 'event_rate', {sql_dround('avg(CAST(y AS DOUBLE))', 6)} FROM scored_y GROUP BY 2
UNION ALL
SELECT 'source_signal', source_dataset, 'mean_score', {sql_dround('avg(pd)', 6)} FROM scored_y GROUP BY 2
UNION ALL
SELECT 'source_signal', source_dataset, m, {sql_dround("CASE m WHEN 'roc_auc' THEN auc ELSE 2 * auc - 1 END", 6)} FROM (
  SELECT source_dataset, (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / (CAST(sum(y) AS DOUBLE) * sum(1 - y)) AS auc
  FROM (SELECT source_dataset, y, rank() OVER (PARTITION BY source_dataset ORDER BY pd)
               + (count(*) OVER (PARTITION BY source_dataset, pd) - 1) / 2.0 AS r FROM scored_y) GROUP BY 1),
  (SELECT unnest(['roc_auc', 'gini']) AS m)
UNION ALL SELECT 'threshold', k, 'value', v FROM (VALUES {', '.join(f"('{k}', {v!r}::DOUBLE)" for k, v in BASELINE_THRESHOLDS.items())}) t(k, v)""")
def q_monitoring_baseline(spark, sf_dir):
    """Baseline snapshot for monitoring (MO2) as one tidy (section, key, metric, value) table."""
    from creditlens.functions.columns import risk_band
    s = adapters.shared_scored(spark, sf_dir)
    n = s.count()  # one number
    mix = s.groupBy("source_dataset").agg((F.count(F.lit(1)) / F.lit(float(n))).alias("value")).select(
        F.lit("source_mix").alias("section"), F.col("source_dataset").alias("key"), F.lit("share").alias("metric"),
        dround("value", 6).alias("value"))
    miss = s.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in BASELINE_MISSING]).unpivot(
        [], BASELINE_MISSING, "key", "value").select(F.lit("missingness").alias("section"), "key",
                                                    F.lit("missing_rate").alias("metric"), dround("value", 6).alias("value"))
    hist = ev.score_histogram_bins(s, "pd").select(F.lit("histogram").alias("section"), F.col("bin").cast("string").alias("key"),
                                                  F.lit("count").alias("metric"), F.col("count").cast("double").alias("value"))
    bands = s.groupBy(risk_band("pd").alias("key")).agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("risk_band").alias("section"), "key", F.lit("accounts").alias("metric"), "value")
    sig = s.groupBy(F.col("source_dataset").alias("key")).agg(
        dround(F.avg(F.col("y").cast("double")), 6).alias("event_rate"), dround(F.avg("pd"), 6).alias("mean_score")
    ).unpivot(["key"], ["event_rate", "mean_score"], "metric", "value").select(
        F.lit("source_signal").alias("section"), "key", "metric", "value")
    power = ev.discrimination(s, "pd", "y", ["source_dataset"]).select(
        F.col("source_dataset").alias("key"), dround("roc_auc", 6).alias("roc_auc"), dround("gini", 6).alias("gini")).unpivot(
        ["key"], ["roc_auc", "gini"], "metric", "value").select(F.lit("source_signal").alias("section"), "key", "metric", "value")
    limits = spark.createDataFrame([("threshold", k, "value", v) for k, v in BASELINE_THRESHOLDS.items()], mix.schema)
    return mix.unionByName(miss).unionByName(hist).unionByName(bands).unionByName(sig).unionByName(power).unionByName(limits)
