"""Population-stability and monitoring operators (E7b, E18, E19, MO1-MO3).

Everything is computed per group (feature, period) so the work spreads over
groups: quantile edges come from the distributed order statistic in
``evaluate``; histograms are grouped counts; PSI is an aggregate over bins.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditlens.functions.columns import join_on_keys
from creditlens.operators import evaluate as ev

SHARE_FLOOR = 1e-6


@dataclass(frozen=True)
class MonitoringThresholds:
    """Governance thresholds for the red / amber / green status."""

    psi_amber: float = 0.10
    psi_red: float = 0.25
    brier_delta_amber: float = 0.01
    brier_delta_red: float = 0.02
    calibration_gap_amber: float = 0.03
    calibration_gap_red: float = 0.05
    missing_rate_red: float = 0.01


# Required response per status.
RESPONSES = {
    "green": "Continue monitoring",
    "amber": "Investigate before expanding automatic decisions",
    "red": "Disable automatic increases and initiate rollback review",
}
# PSI status cut points for feature drift.
PSI_STABLE, PSI_MONITOR = 0.10, 0.25


def _floor_share(c):
    return F.greatest(c, F.lit(SHARE_FLOOR))


def psi_expr(actual_share, expected_share):
    a, e = _floor_share(actual_share), _floor_share(expected_share)
    return (a - e) * F.log(a / e)


def decile_edges(values: DataFrame, group_cols: list[str], value: str = "value") -> DataFrame:
    """Per group: sorted unique edges of the reference deciles (linear interpolation)."""
    cum = ev.cumulative_scores(values.withColumn("_y", F.lit(0)), value, "_y", group_cols)
    q = ev.order_statistics(cum, ev.DECILE_QUANTILES, group_cols)
    return q.select(*group_cols, F.array_sort(F.array_distinct(
        F.array(*[F.col(f"q{i}") for i in range(len(ev.DECILE_QUANTILES))]))).alias("edges"))


def feature_psi(reference: DataFrame, comparison: DataFrame, features: list[str]) -> DataFrame:
    """PSI per feature with reference-decile bins; < 3 unique edges gives 0."""
    def long(df, pop):
        return df.select(*features).unpivot([], features, "feature", "value").withColumn("pop", F.lit(pop))

    ref, cmp_ = long(reference, "expected"), long(comparison, "actual")
    edges = decile_edges(ref, ["feature"])
    both = ref.unionByName(cmp_)
    inner = F.slice(F.col("edges"), 2, F.greatest(F.size("edges") - 2, F.lit(0)))
    binned = join_on_keys(both, edges, ["feature"]).withColumn(
        "bin", F.size(F.filter(inner, lambda e: e <= F.col("value"))))
    counts = binned.groupBy("feature", "bin").agg(
        F.sum((F.col("pop") == "expected").cast("long")).alias("ne"),
        F.sum((F.col("pop") == "actual").cast("long")).alias("na"))
    w = Window.partitionBy("feature")
    shares = counts.select(
        "feature", "bin", (F.col("ne") / F.sum("ne").over(w)).alias("e"),
        (F.col("na") / F.sum("na").over(w)).alias("a"))
    # bins empty on both sides contribute (floor - floor) * ln(1) = 0, so only observed bins matter
    psi = shares.groupBy("feature").agg(F.sum(psi_expr(F.col("a"), F.col("e"))).alias("psi"))
    psi = join_on_keys(psi, edges, ["feature"]).select(
        "feature", F.when(F.size("edges") < 3, F.lit(0.0)).otherwise(F.col("psi")).alias("psi"))
    return psi.withColumn("status", F.when(F.col("psi") < PSI_STABLE, "Stable")
                          .when(F.col("psi") < PSI_MONITOR, "Monitor").otherwise("Investigate"))


def reference_histogram(df: DataFrame, score: str = "probability") -> DataFrame:
    """Stored histogram (lower, upper, count) over 20 equal bins on [0, 1]."""
    return ev.score_histogram_bins(df, score).select("bin", "lower", "upper", "count")


def score_psi(reference_hist: DataFrame, df: DataFrame, score: str = "probability",
              group_cols=None) -> DataFrame:
    """PSI of scores against a stored histogram; scores outside its range are ignored."""
    g = list(group_cols or [])
    h = ev.score_histogram_bins(df, score, group_cols=g)
    ref = reference_hist.select("bin", F.col("count").alias("ref_count"))
    tot_e = ref.agg(F.sum("ref_count").alias("te"))
    j = h.join(F.broadcast(ref), "bin")  # stored histogram: 20 rows
    w = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    j = j.withColumn("_ta", F.greatest(F.sum("count").over(w), F.lit(1)))
    te = tot_e.first()["te"]
    return j.groupBy(*g).agg(F.sum(psi_expr(F.col("count") / F.col("_ta"),
                                            F.col("ref_count") / F.lit(float(te)))).alias("score_psi"))


def qcut_calibration_gap(df: DataFrame, score: str, label: str, group_cols: list[str]) -> DataFrame:
    """Mean |observed - predicted| over quantile bins (min(10, distinct) bins, unique edges,
    right-closed, lowest included) per group (E7b)."""
    g = list(group_cols)
    nd = df.groupBy(*g).agg(F.countDistinct(score).alias("_nd"))
    cum = ev.cumulative_scores(df, score, label, g)
    # quantile fractions k/q for q = min(10, distinct): computed for every possible q <= 10
    fr = {}
    for q in range(1, 11):
        fr[q] = ev.linspace(0.0, 1.0, q + 1)
    allq = sorted({x for v in fr.values() for x in v})
    os = ev.order_statistics(cum, allq, g)
    pos = {x: i for i, x in enumerate(allq)}
    edges_expr = None
    for q in fr:
        arr = F.array(*[F.col(f"q{pos[x]}") for x in fr[q]])
        cond = F.least(F.col("_nd"), F.lit(10)) == q
        edges_expr = F.when(cond, arr) if edges_expr is None else edges_expr.when(cond, arr)
    e = join_on_keys(os, nd, g).select(*g, F.array_sort(F.array_distinct(edges_expr)).alias("edges"))
    inner = F.slice(F.col("edges"), 2, F.greatest(F.size("edges") - 2, F.lit(0)))
    b = join_on_keys(df, e, g).withColumn(
        "_bin", F.size(F.filter(inner, lambda x: x < F.col(score))))
    per = b.groupBy(*g, "_bin").agg(F.avg(F.col(label).cast("double")).alias("o"), F.avg(score).alias("p"))
    return per.groupBy(*g).agg(F.avg(F.abs(F.col("o") - F.col("p"))).alias("calibration_gap"))


NUMERIC_SIGNALS = ["probability", "outcome", "delinquency_count", "utilization", "override"]


def snapshot_signals(df: DataFrame, reference_hist: DataFrame, reference_brier: float,
                     group_cols: list[str], thresholds: MonitoringThresholds | None = None) -> DataFrame:
    """Monitoring signals and governed status per group (MO1)."""
    t = thresholds or MonitoringThresholds()
    g = list(group_cols)
    p, y = F.col("probability"), F.col("outcome").cast("double")
    base = df.groupBy(*g).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg((p - y) * (p - y)).alias("brier_score"),
        F.greatest(*[F.avg(F.col(c).isNull().cast("double")) for c in NUMERIC_SIGNALS]).alias("max_missing_rate"),
        F.avg(F.coalesce(F.col("override").cast("double"), F.lit(0.0))).alias("override_rate"))
    auc = ev.discrimination(df, "probability", "outcome", g).select(*g, "roc_auc")
    psi = score_psi(reference_hist, df, "probability", g)
    gap = qcut_calibration_gap(df, "probability", "outcome", g)
    s = join_on_keys(join_on_keys(join_on_keys(base, auc, g), psi, g), gap, g)
    s = s.withColumn("brier_delta", F.col("brier_score") - F.lit(float(reference_brier)))
    red = ((F.col("score_psi") >= t.psi_red) | (F.col("brier_delta") >= t.brier_delta_red)
           | (F.col("calibration_gap") >= t.calibration_gap_red) | (F.col("max_missing_rate") >= t.missing_rate_red))
    amber = ((F.col("score_psi") >= t.psi_amber) | (F.col("brier_delta") >= t.brier_delta_amber)
             | (F.col("calibration_gap") >= t.calibration_gap_amber))
    status = F.when(red, "red").when(amber, "amber").otherwise("green")
    resp = F.create_map(*[x for k, v in RESPONSES.items() for x in (F.lit(k), F.lit(v))])
    return s.withColumn("status", status).withColumn("required_response", resp[F.col("status")])


def snapshot_guards(df: DataFrame, group_cols: list[str]) -> DataFrame:
    """(group, rule, rows): what makes a snapshot unfit for monitoring (MO1).

    Blank scores or outcomes, scores outside [0, 1], outcomes other than 0 and 1, and groups
    in which only one outcome occurs.
    """
    g = list(group_cols)
    p, y = F.col("probability").cast("double"), F.col("outcome").cast("double")
    known = p.isNotNull() & ~F.isnan(p)
    rules = {"probability_blank": ~known, "outcome_blank": y.isNull(), "probability_range": known & ~p.between(0, 1),
             "outcome_not_binary": y.isNotNull() & ~y.isin(0.0, 1.0)}
    counts = df.groupBy(*g).agg(*[F.count(F.when(c, 1)).alias(n) for n, c in rules.items()],
                                F.when(F.count_distinct(y) < 2, F.count(F.lit(1))).otherwise(0).alias("one_outcome_class"))
    return counts.unpivot(g, [*rules, "one_outcome_class"], "rule", "rows").filter("rows > 0")


def period_checks(signals: DataFrame, period: str = "period", psi_warning: float = 0.10, psi_action: float = 0.25,
                  gap_warning: float = 0.05, missing_shift: float = 0.20) -> DataFrame:
    """Flags of each period's signals, a row per period (MO3).

    A missing rate shifts where it moves by more than a fifth of the period before, or by
    that much itself where there was none before.
    """
    before = F.lag("max_missing_rate").over(Window.orderBy(period))  # a row per period
    now = F.col("max_missing_rate")
    return signals.select(
        period, (F.col("score_psi") >= psi_warning).alias("psi_warning"), (F.col("score_psi") >= psi_action).alias("psi_action"),
        (F.col("calibration_gap") > gap_warning).alias("calibration_warning"),
        F.when(before > 0, F.abs(now - before) / before > missing_shift).when(before == 0, now > missing_shift).alias("missingness_shift"))


def thresholds_dict(t: MonitoringThresholds | None = None) -> dict:
    return asdict(t or MonitoringThresholds())


def period_drift(df: DataFrame, period: str, segment: str, score: str = "probability",
                 label: str = "outcome", rel_shift: float = 0.20, mix_shift_pp: float = 0.05) -> DataFrame:
    """Period x segment aggregates with consecutive-period drift flags (MO3).

    Window partitions are (segment) with one row per period: bounded by the number of periods.
    """
    a = df.groupBy(period, segment).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(score).alias("mean_score"),
        F.avg(F.col(label).cast("double")).alias("event_rate"))
    tot = Window.partitionBy(period)
    a = a.withColumn("mix_share", F.col("rows") / F.sum("rows").over(tot))
    w = Window.partitionBy(segment).orderBy(period)
    prev_rate, prev_mix = F.lag("event_rate").over(w), F.lag("mix_share").over(w)
    return a.select(
        "*",
        F.when(prev_rate > 0, F.abs(F.col("event_rate") - prev_rate) / prev_rate > rel_shift)
         .when(prev_rate == 0, F.col("event_rate") > 0).alias("risk_rate_shift"),
        (F.abs(F.col("mix_share") - prev_mix) > mix_shift_pp).alias("mix_shift"))
