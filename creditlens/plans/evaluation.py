"""Evaluation queries over the scored accounts."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions.columns import dround, join_on_keys, sql_dround
from creditlens.operators import evaluate as ev
from creditlens.plans.oracle_base import acct_ctes, with_ctes
from creditlens.plans.registry import register
from creditlens.sources import adapters

CONFUSION_THRESHOLD = 0.15


def _scored(spark, sf_dir):
    return adapters.shared_scored(spark, sf_dir)


def _r6(df, cols):
    return df.select(*[dround(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def _base_sql(body: str) -> str:
    return with_ctes(acct_ctes()) + body


CUM_SQL = """,
h AS (SELECT pd AS score, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM scored_y GROUP BY pd),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
             sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM h)"""

AUC_SQL = """,
rk AS (SELECT y, rank() OVER (ORDER BY pd) + (count(*) OVER (PARTITION BY pd) - 1) / 2.0 AS avg_rank FROM scored_y),
auc AS (SELECT (sum(CASE WHEN y = 1 THEN avg_rank END) - sum(y) * (sum(y) + 1) / 2.0)
               / (CAST(sum(y) AS DOUBLE) * sum(1 - y)) AS roc_auc FROM rk)"""


@register("roc_auc", lambda: _base_sql(AUC_SQL + f"""
SELECT {sql_dround('roc_auc', 6)} AS roc_auc, {sql_dround('2 * roc_auc - 1', 6)} AS gini FROM auc"""))
def q_roc_auc(spark, sf_dir):
    return _r6(ev.discrimination(_scored(spark, sf_dir)).select("roc_auc", "gini"), ["roc_auc", "gini"])


@register("average_precision", lambda: _base_sql(CUM_SQL + f"""
SELECT CAST(max(P) AS BIGINT) AS positives, {sql_dround('sum(pos / P * tp / (tp + fp))', 6)} AS average_precision
FROM c"""))
def q_average_precision(spark, sf_dir):
    return _r6(ev.discrimination(_scored(spark, sf_dir)).select("positives", "average_precision"),
               ["average_precision"])


@register("ks_gini", lambda: _base_sql(CUM_SQL + AUC_SQL + f"""
SELECT {sql_dround('max(tp / P - fp / N)', 6)} AS ks, {sql_dround('2 * max(roc_auc) - 1', 6)} AS gini
FROM c, auc"""))
def q_ks_gini(spark, sf_dir):
    return _r6(ev.discrimination(_scored(spark, sf_dir)).select("ks", "gini"), ["ks", "gini"])


PROPER_COLS = ["event_rate", "mean_score", "brier_score", "log_loss"]


def _proper_sql(group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    eps = f"{ev.EPS!r}::DOUBLE"
    pc = f"least(greatest(pd, {eps}), 1 - {eps})"
    return _base_sql(f"""
SELECT {g}CAST(count(*) AS BIGINT) AS accounts, {sql_dround('avg(CAST(y AS DOUBLE))', 6)} AS event_rate,
  {sql_dround('avg(pd)', 6)} AS mean_score, {sql_dround('avg((pd - y) * (pd - y))', 6)} AS brier_score,
  {sql_dround(f'avg(-(y * ln({pc}) + (1 - y) * ln(1 - {pc})))', 6)} AS log_loss
FROM scored_y{gb}""")


@register("proper_scores", _proper_sql)
def q_proper_scores(spark, sf_dir):
    return _r6(ev.proper_scores(_scored(spark, sf_dir)), PROPER_COLS)


@register("confusion_at_threshold", lambda: _base_sql(f"""
SELECT tp, fp, tn, fn, {sql_dround('precision', 6)} AS precision, {sql_dround('recall', 6)} AS recall,
       {sql_dround('f1', 6)} AS f1 FROM (
  SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
         coalesce(2 * (coalesce(tp / nullif(tp + fp, 0), 0.0)) * (coalesce(tp / nullif(tp + fn, 0), 0.0))
           / nullif(coalesce(tp / nullif(tp + fp, 0), 0.0) + coalesce(tp / nullif(tp + fn, 0), 0.0), 0.0), 0.0) AS f1
  FROM (SELECT CAST(sum(CASE WHEN pd >= {CONFUSION_THRESHOLD} AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
               CAST(sum(CASE WHEN pd >= {CONFUSION_THRESHOLD} AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
               CAST(sum(CASE WHEN pd < {CONFUSION_THRESHOLD} AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
               CAST(sum(CASE WHEN pd < {CONFUSION_THRESHOLD} AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn
        FROM scored_y))"""))
def q_confusion(spark, sf_dir):
    return _r6(ev.confusion(_scored(spark, sf_dir), CONFUSION_THRESHOLD), ["precision", "recall", "f1"])


def _threshold_sql() -> str:
    return _base_sql(""",
t AS (SELECT range AS j, CASE WHEN range = 111 THEN 0.6::DOUBLE
                 ELSE range * ((0.6::DOUBLE - 0.05::DOUBLE) / 111) + 0.05::DOUBLE END AS threshold FROM range(112)),
cost AS (
  SELECT t.j, t.threshold,
         CAST(sum(CASE WHEN s.pd < t.threshold AND s.y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS false_negatives,
         CAST(sum(CASE WHEN s.pd >= t.threshold AND s.y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS false_positives
  FROM t, scored_y s GROUP BY t.j, t.threshold)
SELECT threshold, 5 * false_negatives + false_positives AS cost, false_negatives, false_positives
FROM cost ORDER BY 5 * false_negatives + false_positives, threshold LIMIT 1""")


@register("best_threshold", _threshold_sql)
def q_best_threshold(spark, sf_dir):
    return ev.best_threshold(_scored(spark, sf_dir))


def _calibration_sql() -> str:
    qs = ", ".join(f"{q!r}" for q in ev.DECILE_QUANTILES)
    inner = " + ".join(f"CASE WHEN e[{i + 1}] < pd THEN 1 ELSE 0 END" for i in range(1, 10))
    return _base_sql(f""",
edges AS (SELECT quantile_cont(pd, [{qs}]) AS e FROM scored_y)
SELECT CAST({inner} AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS accounts,
       {sql_dround('avg(pd)', 6)} AS mean_predicted, {sql_dround('avg(CAST(y AS DOUBLE))', 6)} AS observed_rate
FROM scored_y, edges GROUP BY 1""")


@register("calibration_curve", _calibration_sql)
def q_calibration(spark, sf_dir):
    return _r6(ev.calibration_curve(_scored(spark, sf_dir)), ["mean_predicted", "observed_rate"])


@register("score_histogram", lambda: _base_sql(""",
e AS (SELECT range AS bin, range * 0.05::DOUBLE AS lower,
             CASE WHEN range = 19 THEN 1.0::DOUBLE ELSE (range + 1) * 0.05::DOUBLE END AS upper FROM range(20))
SELECT e.bin AS bin, e.lower, e.upper,
       CAST(count(s.pd) AS BIGINT) AS count
FROM e LEFT JOIN scored_y s
  ON s.pd >= e.lower AND (s.pd < e.upper OR (e.bin = 19 AND s.pd <= e.upper))
GROUP BY e.bin, e.lower, e.upper"""))
def q_score_histogram(spark, sf_dir):
    return ev.score_histogram_bins(_scored(spark, sf_dir))


@register("risk_table", lambda: _base_sql(f""",
b AS (SELECT * FROM (VALUES (0, 'Low'), (1, 'Moderate'), (2, 'High'), (3, 'Very high')) v(band_order, band)),
a AS (SELECT CASE WHEN pd < 0.05 THEN 'Low' WHEN pd < 0.15 THEN 'Moderate' WHEN pd < 0.30 THEN 'High'
             ELSE 'Very high' END AS band, count(*) AS accounts, avg(pd) AS mean_pd,
             avg(CAST(y AS DOUBLE)) AS observed_default_rate FROM scored_y GROUP BY 1)
SELECT b.band_order, b.band, CAST(coalesce(a.accounts, 0) AS BIGINT) AS accounts,
       {sql_dround('coalesce(a.mean_pd, 0.0)', 6)} AS mean_pd,
       {sql_dround('coalesce(a.observed_default_rate, 0.0)', 6)} AS observed_default_rate
FROM b LEFT JOIN a ON a.band = b.band"""))
def q_risk_table(spark, sf_dir):
    return _r6(ev.risk_table(_scored(spark, sf_dir)), ["mean_pd", "observed_default_rate"])


@register("lift_table", lambda: _base_sql(f""",
r AS (SELECT pd, y, row_number() OVER (ORDER BY pd DESC, account_id) AS rnk, count(*) OVER () AS n,
             sum(y) OVER () AS ev FROM scored_y),
d AS (SELECT CAST(ceil(10.0 * rnk / n) AS INTEGER) AS decile, count(*) AS accounts, sum(y) AS events,
             avg(pd) AS mean_pd, max(n) AS n, max(ev) AS ev FROM r GROUP BY 1)
SELECT decile, CAST(accounts AS BIGINT) AS accounts, {sql_dround('CAST(events AS DOUBLE) / accounts', 6)} AS risk_rate,
       {sql_dround('mean_pd', 6)} AS mean_pd, {sql_dround('CAST(events AS DOUBLE) / greatest(ev, 1)', 6)} AS default_share,
       {sql_dround('(CAST(events AS DOUBLE) / greatest(accounts, 1)) / (CAST(ev AS DOUBLE) / n)', 6)} AS lift
FROM d"""))
def q_lift_table(spark, sf_dir):
    return _r6(ev.lift_table(_scored(spark, sf_dir)), ["risk_rate", "mean_pd", "default_share", "lift"])


@register("lorenz_curve", lambda: _base_sql(f""",
r AS (SELECT y, row_number() OVER (ORDER BY pd DESC, account_id) AS rnk FROM scored_y),
c AS (SELECT rnk, sum(y) OVER (ORDER BY rnk ROWS UNBOUNDED PRECEDING) AS cum FROM r),
tot AS (SELECT count(*) AS n, sum(y) AS ev FROM scored_y),
p AS (SELECT range AS point, CASE WHEN range = 249 THEN n - 1
             ELSE CAST(floor(range * ((n - 1) / 249.0::DOUBLE)) AS BIGINT) END AS idx, n, ev FROM range(250), tot)
SELECT p.point AS point, CAST(p.idx AS BIGINT) AS index, {sql_dround('(p.idx + 1) / CAST(p.n AS DOUBLE)', 6)} AS population_share,
       {sql_dround('c.cum / CAST(greatest(p.ev, 1) AS DOUBLE)', 6)} AS event_share
FROM p JOIN c ON c.rnk = p.idx + 1"""))
def q_lorenz(spark, sf_dir):
    return _r6(ev.lorenz_curve(_scored(spark, sf_dir)), ["population_share", "event_share"])


@register("roc_curve", lambda: _base_sql(CUM_SQL + f""",
pts AS (SELECT CAST(row_number() OVER (ORDER BY score DESC) AS BIGINT) AS i, score, fp / N AS fpr, tp / P AS tpr FROM c
        UNION ALL SELECT 0, NULL, 0.0, 0.0),
n AS (SELECT count(*) AS n FROM pts),
keep AS (SELECT DISTINCT CASE WHEN n <= 250 THEN range WHEN range = 249 THEN n - 1
                 ELSE CAST(floor(range * ((n - 1) / 249.0::DOUBLE)) AS BIGINT) END AS i
         FROM n, range((SELECT CASE WHEN n <= 250 THEN n ELSE 250 END FROM n)))
SELECT pts.i, {sql_dround('score', 6)} AS score, {sql_dround('fpr', 6)} AS fpr, {sql_dround('tpr', 6)} AS tpr
FROM pts WHERE i IN (SELECT i FROM keep)"""))
def q_roc_curve(spark, sf_dir):
    return _r6(ev.roc_points(_scored(spark, sf_dir)), ["score", "fpr", "tpr"])


COHORT_METRICS = ["event_rate", "mean_score", "brier_score", "log_loss", "roc_auc", "average_precision",
                  "ks", "gini"]


def cohort_metrics(df, group_cols, score="pd", label="y"):
    """Per-cohort metric table: proper scores joined with rank metrics on the group key."""
    p = ev.proper_scores(df, score, label, group_cols)
    d = ev.discrimination(df, score, label, group_cols).drop("positives", "negatives")
    return join_on_keys(p, d, list(group_cols))


def _cohort_sql(group: str) -> str:
    eps = f"{ev.EPS!r}::DOUBLE"
    pc = f"least(greatest(pd, {eps}), 1 - {eps})"
    return f""",
rk AS (SELECT {group} AS g, pd, y, rank() OVER (PARTITION BY {group} ORDER BY pd)
              + (count(*) OVER (PARTITION BY {group}, pd) - 1) / 2.0 AS avg_rank FROM scored_y),
auc AS (SELECT g, CASE WHEN sum(y) > 0 AND sum(1 - y) > 0 THEN (sum(CASE WHEN y = 1 THEN avg_rank END)
               - sum(y) * (sum(y) + 1) / 2.0) / (CAST(sum(y) AS DOUBLE) * sum(1 - y)) END AS roc_auc FROM rk GROUP BY g),
h AS (SELECT {group} AS g, pd AS score, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg
      FROM scored_y GROUP BY 1, 2),
c AS (SELECT *, sum(pos) OVER (PARTITION BY g ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
             sum(neg) OVER (PARTITION BY g ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
             sum(pos) OVER (PARTITION BY g) AS P, sum(neg) OVER (PARTITION BY g) AS N FROM h),
rk2 AS (SELECT g, CASE WHEN max(P) > 0 THEN sum(pos / P * tp / (tp + fp)) END AS average_precision,
               CASE WHEN max(P) > 0 AND max(N) > 0 THEN max(tp / P - fp / N) END AS ks FROM c GROUP BY g),
ps AS (SELECT {group} AS g, count(*) AS accounts, avg(CAST(y AS DOUBLE)) AS event_rate, avg(pd) AS mean_score,
              avg((pd - y) * (pd - y)) AS brier_score,
              avg(-(y * ln({pc}) + (1 - y) * ln(1 - {pc}))) AS log_loss FROM scored_y GROUP BY 1),
cm AS (SELECT ps.g, CAST(ps.accounts AS BIGINT) AS accounts, event_rate, mean_score, brier_score, log_loss,
              auc.roc_auc, rk2.average_precision, rk2.ks, 2 * auc.roc_auc - 1 AS gini
       FROM ps JOIN auc ON ps.g IS NOT DISTINCT FROM auc.g JOIN rk2 ON ps.g IS NOT DISTINCT FROM rk2.g)"""


@register("metrics_by_cohort", lambda: _base_sql(_cohort_sql("source_dataset") + "\nSELECT g AS source_dataset, accounts, "
          + ", ".join(f"{sql_dround(m, 6)} AS {m}" for m in COHORT_METRICS) + " FROM cm"))
def q_metrics_by_cohort(spark, sf_dir):
    return _r6(cohort_metrics(_scored(spark, sf_dir), ["source_dataset"]), COHORT_METRICS)


@register("metrics_by_vintage", lambda: _base_sql(_cohort_sql("vintage") + "\nSELECT g AS vintage, accounts, "
          + ", ".join(f"{sql_dround(m, 6)} AS {m}" for m in COHORT_METRICS) + " FROM cm"))
def q_metrics_by_vintage(spark, sf_dir):
    return _r6(cohort_metrics(_scored(spark, sf_dir), ["vintage"]), COHORT_METRICS)


MACRO_METRICS = ["roc_auc", "average_precision", "brier_score", "log_loss"]


def macro_vs_pooled(df, group_cols, score="pd", label="y"):
    """Equal-weight (macro) mean of per-cohort metrics next to the pooled value."""
    per = cohort_metrics(df, group_cols, score, label)
    macro = per.agg(*[F.avg(m).alias(m) for m in MACRO_METRICS])
    pooled = cohort_metrics(df.withColumn("_all", F.lit(1)), ["_all"], score, label).drop("_all")
    long = lambda d, name: d.select(*MACRO_METRICS).unpivot([], MACRO_METRICS, "metric", name)
    return long(pooled, "pooled").join(long(macro, "macro"), "metric")


@register("macro_metrics", lambda: _base_sql(_cohort_sql("source_dataset") + _cohort_sql("1").replace(
    "rk AS", "rk_p AS").replace("FROM rk GROUP", "FROM rk_p GROUP").replace("auc AS", "auc_p AS")
    .replace("h AS", "h_p AS").replace("FROM h)", "FROM h_p)").replace("c AS", "c_p AS")
    .replace("FROM c GROUP", "FROM c_p GROUP").replace("rk2 AS", "rk2_p AS").replace("ps AS", "ps_p AS")
    .replace("cm AS", "cm_p AS").replace("FROM ps JOIN auc ON ps.g IS NOT DISTINCT FROM auc.g JOIN rk2 ON ps.g IS NOT DISTINCT FROM rk2.g",
                                         "FROM ps_p ps JOIN auc_p auc ON ps.g IS NOT DISTINCT FROM auc.g JOIN rk2_p rk2 ON ps.g IS NOT DISTINCT FROM rk2.g")
    + "\n" + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, (SELECT {sql_dround(m, 6)} FROM cm_p) AS pooled, "
        f"(SELECT {sql_dround(f'avg({m})', 6)} FROM cm) AS macro" for m in MACRO_METRICS)))
def q_macro_metrics(spark, sf_dir):
    return _r6(macro_vs_pooled(_scored(spark, sf_dir), ["source_dataset"]), ["pooled", "macro"])


AUC_TOLERANCE = 0.02


def champion(df, models: dict, label="y"):
    """Champion: within 0.02 AUC of the best, then lowest Brier, then name."""
    from functools import reduce
    per = []
    for name, col in models.items():
        d = ev.discrimination(df, col, label).select("roc_auc")
        p = ev.proper_scores(df, col, label).select("brier_score")
        # both sides are single-row aggregates: attach them through a one-row key
        per.append(join_on_keys(d.withColumn("_k", F.lit(1)), p.withColumn("_k", F.lit(1)), ["_k"])
                   .drop("_k").withColumn("model", F.lit(name)))
    allm = reduce(lambda a, b: a.unionByName(b), per)
    from pyspark.sql import Window
    w = Window.partitionBy(F.lit(0))  # one row per model: bounded
    near = allm.withColumn("_best", F.max("roc_auc").over(w)).withColumn(
        "eligible", F.col("roc_auc") >= F.col("_best") - AUC_TOLERANCE)
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("eligible"), "brier_score", "model")
    return near.withColumn("selected", F.row_number().over(order) == 1).drop("_best")


CHAMPION_MODELS = {"behavioural_scorecard": "pd", "delinquency_only": "pd_benchmark"}


def _champion_sql() -> str:
    parts = []
    for name, col in CHAMPION_MODELS.items():
        parts.append(f"""
SELECT '{name}' AS model,
  (SELECT (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / (CAST(sum(y) AS DOUBLE) * sum(1 - y))
   FROM (SELECT y, rank() OVER (ORDER BY {col}) + (count(*) OVER (PARTITION BY {col}) - 1) / 2.0 AS r FROM scored_y))
   AS roc_auc,
  (SELECT avg(({col} - y) * ({col} - y)) FROM scored_y) AS brier_score""")
    return _base_sql(f""",
m AS ({' UNION ALL '.join(parts)}),
e AS (SELECT *, roc_auc >= max(roc_auc) OVER () - {AUC_TOLERANCE} AS eligible FROM m)
SELECT model, {sql_dround('roc_auc', 6)} AS roc_auc, {sql_dround('brier_score', 6)} AS brier_score, eligible,
       row_number() OVER (ORDER BY eligible DESC, brier_score, model) = 1 AS selected FROM e""")


@register("champion_selection", _champion_sql)
def q_champion(spark, sf_dir):
    return _r6(champion(_scored(spark, sf_dir), CHAMPION_MODELS), ["roc_auc", "brier_score"])


# Overlapping segment definitions (label, rule on the behavioural features).
SEGMENTS = [
    ("Utilization <30%", lambda u, d: u < 0.30),
    ("Utilization 30–70%", lambda u, d: (u >= 0.30) & (u < 0.70)),
    ("Utilization ≥70%", lambda u, d: u >= 0.70),
    ("No reported delinquency", lambda u, d: d == 0),
    ("One delinquent month", lambda u, d: d == 1),
    ("Two or more delinquent months", lambda u, d: d >= 2),
]
SEGMENT_SQL = [
    ("Utilization <30%", "current_utilization < 0.30"),
    ("Utilization 30–70%", "current_utilization >= 0.30 AND current_utilization < 0.70"),
    ("Utilization ≥70%", "current_utilization >= 0.70"),
    ("No reported delinquency", "delinquent_month_count = 0"),
    ("One delinquent month", "delinquent_month_count = 1"),
    ("Two or more delinquent months", "delinquent_month_count >= 2"),
]


def segment_performance(scored_df):
    """Overlapping segments (A12): explode matched labels, then per-segment metrics incl. AUC."""
    from creditlens.operators.features import engineer_features
    f = engineer_features(scored_df, keep=["account_id", "pd", "y"])
    u, d = dround("current_utilization", 6), F.col("delinquent_month_count")
    labels = F.array_compact(F.array(*[F.when(rule(u, d), F.lit(name)) for name, rule in SEGMENTS]))
    seg = f.select("account_id", "pd", "y", F.explode(labels).alias("segment"))
    base = seg.groupBy("segment").agg(F.count(F.lit(1)).alias("accounts"),
                                      F.avg(F.col("y").cast("double")).alias("event_rate"),
                                      F.avg("pd").alias("mean_probability"))
    auc = ev.discrimination(seg, "pd", "y", ["segment"]).select("segment", "roc_auc")
    return join_on_keys(base, auc, ["segment"])


def _segment_sql() -> str:
    from creditlens.plans.features import feature_select_sql
    arr = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in SEGMENT_SQL)
    return _base_sql(f""",
feat AS ({feature_select_sql()}),
seg AS (SELECT s.account_id, s.pd, s.y, unnest(list_filter([{arr}], lambda x: x IS NOT NULL)) AS segment
        FROM feat f JOIN scored_y s ON s.account_id = f.account_id),
rk AS (SELECT segment, y, rank() OVER (PARTITION BY segment ORDER BY pd)
              + (count(*) OVER (PARTITION BY segment, pd) - 1) / 2.0 AS r FROM seg)
SELECT b.segment, b.accounts, {sql_dround('b.event_rate', 6)} AS event_rate,
       {sql_dround('b.mean_probability', 6)} AS mean_probability, {sql_dround('a.roc_auc', 6)} AS roc_auc
FROM (SELECT segment, CAST(count(*) AS BIGINT) AS accounts, avg(CAST(y AS DOUBLE)) AS event_rate,
             avg(pd) AS mean_probability FROM seg GROUP BY segment) b
JOIN (SELECT segment, CASE WHEN sum(y) > 0 AND sum(1 - y) > 0 THEN (sum(CASE WHEN y = 1 THEN r END)
             - sum(y) * (sum(y) + 1) / 2.0) / (CAST(sum(y) AS DOUBLE) * sum(1 - y)) END AS roc_auc
      FROM rk GROUP BY segment) a ON a.segment = b.segment""")


@register("segment_performance", _segment_sql)
def q_segment_performance(spark, sf_dir):
    r = segment_performance(_scored(spark, sf_dir))
    return r.select("segment", F.col("accounts").cast("bigint").alias("accounts"),
                    *[dround(c, 6).alias(c) for c in ("event_rate", "mean_probability", "roc_auc")])


# Right-closed age bands (0,29] (29,39] (39,49] (49,59] (59,inf) and labels.
AGE_BANDS = [(0, 29, "<30"), (29, 39, "30-39"), (39, 49, "40-49"), (49, 59, "50-59"), (59, None, "60+")]
FAIRNESS_THRESHOLD = 0.15


def segment_fairness(df, threshold: float = FAIRNESS_THRESHOLD):
    """Per (dimension, segment): accounts, default rate, mean pd, TPR, FPR, AUC."""
    age = F.col("credit_age_months")
    band = None
    for lo, hi, label in AGE_BANDS:
        cond = (age > lo) & (age <= hi) if hi is not None else (age > lo)
        band = F.when(cond, F.lit(label)) if band is None else band.when(cond, F.lit(label))
    dims = F.array(F.struct(F.lit("source_dataset").alias("dimension"), F.col("source_dataset").alias("segment")),
                   F.struct(F.lit("region").alias("dimension"), F.col("region").alias("segment")),
                   F.struct(F.lit("credit_age_band").alias("dimension"), band.alias("segment")))
    long = df.select("pd", "y", F.inline(dims)).filter(F.col("segment").isNotNull())
    pred = (F.col("pd") >= threshold).cast("double")
    base = long.groupBy("dimension", "segment").agg(
        F.count(F.lit(1)).alias("accounts"), F.avg(F.col("y").cast("double")).alias("observed_default_rate"),
        F.avg("pd").alias("mean_pd"),
        F.avg(F.when(F.col("y") == 1, pred)).alias("tpr"), F.avg(F.when(F.col("y") == 0, pred)).alias("fpr"))
    auc = ev.discrimination(long, "pd", "y", ["dimension", "segment"]).select("dimension", "segment", "roc_auc")
    return join_on_keys(base, auc, ["dimension", "segment"])


def _fairness_sql() -> str:
    band = "CASE " + " ".join(
        (f"WHEN credit_age_months > {lo} AND credit_age_months <= {hi} THEN '{lab}'" if hi is not None
         else f"WHEN credit_age_months > {lo} THEN '{lab}'") for lo, hi, lab in AGE_BANDS) + " END"
    return _base_sql(f""",
lng AS (SELECT * FROM (
          SELECT 'source_dataset' AS dimension, source_dataset AS segment, pd, y FROM scored_y
          UNION ALL SELECT 'region', region, pd, y FROM scored_y
          UNION ALL SELECT 'credit_age_band', {band}, pd, y FROM scored_y) WHERE segment IS NOT NULL),
rk AS (SELECT dimension, segment, y, rank() OVER (PARTITION BY dimension, segment ORDER BY pd)
              + (count(*) OVER (PARTITION BY dimension, segment, pd) - 1) / 2.0 AS r FROM lng),
auc AS (SELECT dimension, segment, CASE WHEN sum(y) > 0 AND sum(1 - y) > 0 THEN (sum(CASE WHEN y = 1 THEN r END)
               - sum(y) * (sum(y) + 1) / 2.0) / (CAST(sum(y) AS DOUBLE) * sum(1 - y)) END AS roc_auc
        FROM rk GROUP BY 1, 2)
SELECT l.dimension, l.segment, CAST(count(*) AS BIGINT) AS accounts,
       {sql_dround('avg(CAST(y AS DOUBLE))', 6)} AS observed_default_rate, {sql_dround('avg(pd)', 6)} AS mean_pd,
       {sql_dround(f'avg(CASE WHEN y = 1 THEN CASE WHEN pd >= {FAIRNESS_THRESHOLD} THEN 1.0 ELSE 0.0 END END)', 6)} AS tpr,
       {sql_dround(f'avg(CASE WHEN y = 0 THEN CASE WHEN pd >= {FAIRNESS_THRESHOLD} THEN 1.0 ELSE 0.0 END END)', 6)} AS fpr,
       {sql_dround('max(a.roc_auc)', 6)} AS roc_auc
FROM lng l JOIN auc a ON a.dimension = l.dimension AND a.segment = l.segment GROUP BY l.dimension, l.segment""")


@register("segment_fairness", _fairness_sql)
def q_segment_fairness(spark, sf_dir):
    r = segment_fairness(_scored(spark, sf_dir))
    return r.select("dimension", "segment", F.col("accounts").cast("bigint").alias("accounts"),
                    *[dround(c, 6).alias(c) for c in ("observed_default_rate", "mean_pd", "tpr", "fpr", "roc_auc")])
