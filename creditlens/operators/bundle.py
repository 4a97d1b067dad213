"""One-pass metric bundle (E13) and its metric registry.

The scores are read and shuffled once, into a histogram of distinct scores per group that goes
to the shared checkpoint folder.  Running counts over the histogram follow, and one
aggregation of these into cells (group, decision threshold, calibration bin) from which every
metric is rolled up: a group has (thresholds + 1) x 10 cells at most, whatever its rows.

A metric of the registry names the partial results it needs, each a sum or a maximum over the
histogram's rows, and computes its value from them and from the totals P and N.  Metrics that
name the same partial result share it.

Rows without a score (NULL or NaN) are counted as ``unscored`` and enter no metric; rows without
a label are left out; a group without scored rows has NULL metrics; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.functions.columns import join_on_keys
from creditlens.operators import evaluate as ev
from creditlens.session import cut_lineage

BINS = 10


@dataclass(frozen=True)
class Metric:
    value: Callable[[], Column]
    parts: dict[str, tuple[str, Callable[[], Column]]] = field(default_factory=dict)


METRICS: dict[str, Metric] = {}


def metric(name: str, value: Callable[[], Column], **parts: tuple[str, Callable[[], Column]]) -> None:
    """Adds a metric; parts: name -> ("sum" or "max", expression over score, pos, neg, tp, fp, P, N)."""
    if name in METRICS:
        raise ValueError(f"duplicate metric {name}")
    for part, (how, make) in parts.items():
        if how not in ("sum", "max"):
            raise ValueError(f"{name}.{part}: {how}")
        if any(part in m.parts and m.parts[part][1] is not make for m in METRICS.values()):
            raise ValueError(f"{name}.{part} is another metric's")
    METRICS[name] = Metric(value, parts)


def _clipped() -> Column:
    return F.least(F.greatest("score", F.lit(ev.EPS)), F.lit(1 - ev.EPS))


def _of_all(part: str) -> Callable[[], Column]:
    return lambda: F.try_divide(F.col(part), F.col("P") + F.col("N"))


def _both(value: Column) -> Column:
    return F.when((F.col("P") > 0) & (F.col("N") > 0), value)


def _above() -> Column:
    return F.col("pos") * (F.col("N") - F.col("fp") + 0.5 * F.col("neg"))


def _auc() -> Column:
    return _both(F.col("_above") / (F.col("P") * F.col("N")))


metric("accounts", lambda: (F.col("P") + F.col("N")).cast("bigint"))
metric("events", lambda: F.col("P").cast("bigint"))
metric("event_rate", _of_all("P"))
metric("mean_score", _of_all("_scores"), _scores=("sum", lambda: F.col("score") * (F.col("pos") + F.col("neg"))))
metric("brier_score", _of_all("_squares"), _squares=("sum", lambda: F.col("pos") * (1 - F.col("score")) * (1 - F.col("score")) + F.col("neg") * F.col("score") * F.col("score")))
metric("log_loss", _of_all("_logs"), _logs=("sum", lambda: -(F.col("pos") * F.log(_clipped()) + F.col("neg") * F.log(1 - _clipped()))))
metric("roc_auc", _auc, _above=("sum", _above))
metric("gini", lambda: 2 * _auc() - 1, _above=("sum", _above))
metric("average_precision", lambda: F.when(F.col("P") > 0, F.col("_steps") / F.col("P")),
       _steps=("sum", lambda: F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))))
metric("ks", lambda: _both(F.col("_gap")), _gap=("max", lambda: F.try_divide(F.col("tp"), F.col("P")) - F.try_divide(F.col("fp"), F.col("N"))))


def histogram(df: DataFrame, score: str, label: str, group_cols: list[str]) -> DataFrame:
    """(group, score, pos, neg) of labelled rows, checkpointed; score is NULL for unscored rows."""
    x, y = F.col(score).cast("double"), F.col(label).cast("double")
    return cut_lineage(df.filter(y.isNotNull()).groupBy(*group_cols, F.when(~F.isnan(x), x).alias("score")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")))


def _with_bins(cum: DataFrame, g: list[str]) -> DataFrame:
    """Adds ``bin``: inner edges below the score, edges being the distinct quantiles of min(10, distinct scores) bins."""
    at = {q: ev.linspace(0.0, 1.0, q + 1) for q in range(1, BINS + 1)}
    every = sorted({x for v in at.values() for x in v})
    place = {x: i for i, x in enumerate(every)}
    distinct = cum.groupBy(*g).agg(F.least(F.count(F.lit(1)), F.lit(BINS)).alias("_q"))
    edges = F.element_at(F.create_map(*[c for q, v in at.items() for c in (F.lit(q), F.array(*[F.col(f"q{place[x]}") for x in v]))]), F.col("_q").cast("int"))
    edges = F.array_sort(F.array_distinct(edges))
    table = join_on_keys(ev.order_statistics(cum, every, g), distinct, g).select(*g, F.slice(edges, 2, F.greatest(F.size(edges) - 2, F.lit(0))).alias("_inner"))
    return join_on_keys(cum, table, g).withColumn("bin", F.size(F.filter("_inner", lambda e: e < F.col("score")))).drop("_inner")


def bundle(df: DataFrame, score: str = "pd", label: str = "y", group_cols=None, names: list[str] | None = None, threshold: float = 0.5,
           thresholds: list[float] | None = None, fn_cost: float = ev.FN_COST) -> DataFrame:
    """Per group: the registry's metrics (or ``names``), ``unscored``, confusion counts with precision,
    recall and F1 at ``threshold``, the threshold of least cost, and the calibration gap."""
    names = list(METRICS) if names is None else list(names)
    ts = sorted({float(t) for t in (thresholds or ev.THRESHOLDS)} | {float(threshold)})
    candidates = {float(t) for t in (thresholds or ev.THRESHOLDS)}
    g = list(group_cols or []) or ["_all"]
    keyed = df if group_cols else df.withColumn("_all", F.lit(1))
    hist = histogram(keyed, score, label, g)
    cum = cut_lineage(ev.running_counts(hist.filter("score is not null"), g))
    parts = {p: spec for n in names for p, spec in METRICS[n].parts.items()}
    n, how = F.col("pos") + F.col("neg"), {"sum": F.sum, "max": F.max}
    level = F.size(F.filter(F.array(*[F.lit(t) for t in ts]), lambda t: t <= F.col("score")))
    cells = cut_lineage(_with_bins(cum, g).groupBy(*g, level.alias("level"), "bin").agg(
        F.first("P").alias("P"), F.first("N").alias("N"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum(F.col("score") * n).alias("_weight"),
        *[how[h](make()).alias(p) for p, (h, make) in parts.items()]))
    # cells of a group: its thresholds and bins, a bounded number
    total = cells.groupBy(*g).agg(F.first("P").alias("P"), F.first("N").alias("N"), *[how[h](F.col(p)).alias(p) for p, (h, _) in parts.items()],
                                  F.collect_list(F.struct("level", "pos", "neg")).alias("_cells"))

    def upto(side: str, least: int) -> Column:
        return F.aggregate("_cells", F.lit(0.0), lambda acc, c: acc + F.when(c["level"] >= least, c[side]).otherwise(F.lit(0.0)))

    own = ts.index(float(threshold)) + 1  # scores at this level or above are at the threshold or above
    tp, fp = upto("pos", own), upto("neg", own)
    cost = [F.struct((fn_cost * (F.col("P") - upto("pos", i + 1)) + upto("neg", i + 1)).alias("cost"), F.lit(t).alias("threshold")) for i, t in enumerate(ts) if t in candidates]
    total = total.withColumns({"tp": tp, "fp": fp, "_best": F.array_min(F.array(*cost))})
    tp, fp = F.col("tp"), F.col("fp")
    precision, recall = (F.coalesce(F.try_divide(tp, d), F.lit(0.0)) for d in (tp + fp, F.col("P")))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    rolled = total.select(*g, *[METRICS[x].value().alias(x) for x in names], *[c.cast("bigint").alias(a) for a, c in
                          (("tp", tp), ("fp", fp), ("tn", F.col("N") - fp), ("fn", F.col("P") - tp))], precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
                          F.col("_best.threshold").alias("best_threshold"), F.col("_best.cost").cast("bigint").alias("best_cost"))
    own_bins = cells.groupBy(*g, "bin").agg(F.sum("pos").alias("pos"), F.sum(n).alias("n"), F.sum("_weight").alias("w"))
    gap = own_bins.groupBy(*g).agg(F.avg(F.abs(F.col("pos") / F.col("n") - F.col("w") / F.col("n"))).alias("calibration_gap"))
    missing = hist.groupBy(*g).agg(F.coalesce(F.sum(F.when(F.col("score").isNull(), n)), F.lit(0.0)).cast("bigint").alias("unscored"))
    return join_on_keys(join_on_keys(missing, rolled, g, "left"), gap, g, "left").drop("_all")
