"""Model-evaluation operators (E1-E13, A10, A14), pooled or per group.

Scale design
------------
* Rank metrics (AUC, average precision, KS, ROC points, exact quantiles) start
  from a histogram of distinct scores per group, then take prefix sums in two
  levels: score buckets whose edges are quantiles of the data (a bounded table)
  give offsets, a window partitioned by (group, bucket) finishes the running sums.
  No window runs over the whole table in one task, and a hot score value is one
  histogram row.  Rows without a score take no part.
* Cuts by rank with an id tie-break (lift deciles, gains curve) come from the same
  histogram; only the rows of scores that straddle a cut are ranked by id, with
  ``repartitionByRange`` on (score desc, id), which splits even a hot score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlens.functions.columns import RISK_BAND_LABELS, join_on_keys, risk_band
from creditlens.session import cut_lineage

SCORE_BUCKETS = 256
EPS = 2.220446049250313e-16  # float64 machine epsilon (log-loss clipping)


def _g(group_cols) -> list[str]:
    return list(group_cols or [])


def score_histogram(df: DataFrame, score: str = "pd", label: str = "y", group_cols=None) -> DataFrame:
    """Positives and negatives of each score; rows without a score (NULL or NaN) or label take no part."""
    g = _g(group_cols)
    y, x = F.col(label).cast("double"), F.col(score).cast("double")
    return df.filter(x.isNotNull() & ~F.isnan(x) & y.isNotNull()).groupBy(*g, x.alias("score")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def count_below(edges: Column, x: Column, most: int) -> Column:
    """How many of the ascending ``edges``, ``most`` at most, are below x, by halving; 0 for a null."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, most).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(edges, n + step - 1) < x, n + step).otherwise(n))


def unscored(df: DataFrame, score: str = "pd", group_cols=None) -> DataFrame:
    """How many rows have no usable score (NULL or NaN), per group."""
    x = F.col(score).cast("double")
    return df.groupBy(*_g(group_cols)).agg(F.count(F.when(x.isNull() | F.isnan(x), 1)).alias("unscored"))


def cumulative_scores(df: DataFrame, score: str = "pd", label: str = "y", group_cols=None,
                      buckets: int = SCORE_BUCKETS) -> DataFrame:
    """Per distinct score: pos, neg, tp / fp (counts with score >= s) and totals P, N."""
    return running_counts(score_histogram(df, score, label, group_cols), group_cols, buckets)


def running_counts(h: DataFrame, group_cols=None, buckets: int = SCORE_BUCKETS) -> DataFrame:
    """``cumulative_scores`` from a histogram (group, score, pos, neg).

    Bucket edges are quantiles of each group's distinct scores, so buckets follow the data:
    an outlier or a dense range leaves them balanced.  The offset table has at most
    ``buckets`` + 1 rows per group, and each window sees one bucket's distinct scores.
    """
    g = _g(group_cols)
    at = [i / buckets for i in range(1, buckets)]
    edges = h.groupBy(*g).agg(F.percentile_approx("score", at, 10 * buckets).alias("_edges"))
    if g:
        h = join_on_keys(h, edges, g)
    else:  # one group: a bounded array as a literal
        row = edges.first()
        h = h.withColumn("_edges", F.array(*[F.lit(float(e)) for e in row["_edges"] or ()]).cast("array<double>"))
    h = h.withColumn("bucket", count_below(F.col("_edges"), F.col("score"), buckets).cast("bigint")).drop("_edges")
    bt = h.groupBy(*g, "bucket").agg(F.sum("pos").alias("bpos"), F.sum("neg").alias("bneg"))
    whole = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    above = whole.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = bt.select(
        *g, "bucket",
        F.coalesce(F.sum("bpos").over(above), F.lit(0.0)).alias("off_pos"),
        F.coalesce(F.sum("bneg").over(above), F.lit(0.0)).alias("off_neg"),
        F.sum("bpos").over(whole).alias("P"), F.sum("bneg").over(whole).alias("N"))
    j = join_on_keys(h, offsets, [*g, "bucket"])
    within = Window.partitionBy(*g, "bucket").orderBy(F.desc("score")).rowsBetween(
        Window.unboundedPreceding, 0)
    return j.select(
        *g, "score", "pos", "neg", "P", "N",
        (F.col("off_pos") + F.sum("pos").over(within)).alias("tp"),
        (F.col("off_neg") + F.sum("neg").over(within)).alias("fp"))


def discrimination(df: DataFrame, score: str = "pd", label: str = "y", group_cols=None) -> DataFrame:
    """ROC-AUC (ties share rank), average precision (step sum), KS and Gini per group."""
    g = _g(group_cols)
    c = cumulative_scores(df, score, label, g)
    P, N = F.col("P"), F.col("N")
    agg = c.groupBy(*g).agg(
        F.first("P").alias("positives"), F.first("N").alias("negatives"),
        F.sum(F.col("pos") * (N - F.col("fp") + 0.5 * F.col("neg"))).alias("_auc_num"),
        F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("_ap_num"),
        F.max(F.try_divide(F.col("tp"), P) - F.try_divide(F.col("fp"), N)).alias("_ks"))
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    auc = F.when(both, F.col("_auc_num") / (F.col("positives") * F.col("negatives")))
    return agg.select(
        *g,
        F.col("positives").cast("bigint").alias("positives"),
        F.col("negatives").cast("bigint").alias("negatives"),
        auc.alias("roc_auc"),
        F.when(F.col("positives") > 0, F.col("_ap_num") / F.col("positives")).alias("average_precision"),
        F.when(both, F.col("_ks")).alias("ks"),
        (2 * auc - 1).alias("gini"))


def proper_scores(df: DataFrame, score: str = "pd", label: str = "y", group_cols=None) -> DataFrame:
    """Brier score, log loss (p clipped to [eps, 1-eps]), event rate, mean score."""
    p, y = F.col(score).cast("double"), F.col(label).cast("double")
    pc = F.least(F.greatest(p, F.lit(EPS)), F.lit(1 - EPS))
    return df.groupBy(*_g(group_cols)).agg(
        F.count(F.lit(1)).alias("accounts"),
        F.avg(y).alias("event_rate"),
        F.avg(p).alias("mean_score"),
        F.avg((p - y) * (p - y)).alias("brier_score"),
        F.avg(-(y * F.log(pc) + (1 - y) * F.log(1 - pc))).alias("log_loss"))


def confusion(df: DataFrame, threshold: float | Column, score: str = "pd", label: str = "y",
              group_cols=None) -> DataFrame:
    """Confusion counts at ``score >= threshold`` with precision, recall, F1 (0 when undefined)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = F.col(score) >= t
    y = F.col(label) == 1
    a = df.groupBy(*_g(group_cols)).agg(
        F.sum((pred & y).cast("long")).alias("tp"), F.sum((pred & ~y).cast("long")).alias("fp"),
        F.sum((~pred & ~y).cast("long")).alias("tn"), F.sum((~pred & y).cast("long")).alias("fn"))
    prec = F.coalesce(F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0)), F.lit(0.0))
    rec = F.coalesce(F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0)), F.lit(0.0))
    return a.select("*", prec.alias("precision"), rec.alias("recall")).withColumn(
        "f1", F.coalesce(2 * F.col("precision") * F.col("recall")
                         / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)), F.lit(0.0)))


def linspace(start: float, stop: float, num: int) -> list[float]:
    """Evenly spaced values computed the way numpy does (index * step + start; exact stop)."""
    step = (stop - start) / (num - 1)
    out = [j * step + start for j in range(num)]
    out[-1] = stop
    return out


# Candidate decision thresholds and the cost weight of a missed event.
THRESHOLDS = linspace(0.05, 0.60, 112)
FN_COST = 5


def best_threshold(df: DataFrame, score: str = "pd", label: str = "y", thresholds=None,
                   fn_cost: float = FN_COST) -> DataFrame:
    """Cost-optimal threshold: lowest fn_cost*FN + FP, ties to the lowest threshold.

    Each score is bucketed to the number of thresholds at or below it (no range
    join), the 113-bucket histogram is tiny, and cumulative sums give FN/FP.
    """
    ts = list(thresholds or THRESHOLDS)
    tarr = F.array(*[F.lit(float(t)) for t in ts])
    idx = F.size(F.filter(tarr, lambda t: t <= F.col(score)))
    y = F.col(label).cast("long")
    h = df.groupBy(idx.alias("idx")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    table = F.inline(F.array(*[F.struct(F.lit(j).alias("j"), F.lit(float(t)).alias("threshold"))
                               for j, t in enumerate(ts)]))
    # counts per threshold j: FN = positives with idx <= j ; FP = negatives with idx > j
    agg = h.agg(
        F.sum("pos").alias("P"), F.sum("neg").alias("N"),
        F.map_from_entries(F.collect_list(F.struct("idx", "pos"))).alias("pm"),
        F.map_from_entries(F.collect_list(F.struct("idx", "neg"))).alias("nm"))
    rows = agg.select("P", "N", "pm", "nm", table)
    fn = F.aggregate(F.sequence(F.lit(0), F.col("j")), F.lit(0).cast("long"),
                     lambda acc, k: acc + F.coalesce(F.col("pm")[k], F.lit(0).cast("long")))
    tn = F.aggregate(F.sequence(F.lit(0), F.col("j")), F.lit(0).cast("long"),
                     lambda acc, k: acc + F.coalesce(F.col("nm")[k], F.lit(0).cast("long")))
    costs = rows.select("j", "threshold", fn.alias("fn"), (F.col("N") - tn).alias("fp")).withColumn(
        "cost", F.lit(fn_cost) * F.col("fn") + F.col("fp"))
    best = costs.agg(F.min_by(F.struct("cost", "threshold", "fn", "fp"),
                              F.struct("cost", "threshold")).alias("b"))
    return best.select(F.col("b.threshold").alias("threshold"), F.col("b.cost").cast("long").alias("cost"),
                       F.col("b.fn").cast("long").alias("false_negatives"),
                       F.col("b.fp").cast("long").alias("false_positives"))


def order_statistics(cum: DataFrame, quantiles, group_cols=None) -> DataFrame:
    """Exact linear-interpolated quantiles of the score from ``cumulative_scores`` output.

    x[k] (0-based) is the smallest score whose ascending cumulative count exceeds k.
    Returns one row per group with column ``q{i}`` per quantile.
    """
    g = _g(group_cols)
    n_col = F.col("P") + F.col("N")
    cum_asc = n_col - (F.col("tp") + F.col("fp")) + F.col("pos") + F.col("neg")
    c2 = cum.withColumn("_n", n_col).withColumn("_ca", cum_asc)  # P + N are per-group totals
    aggs = []
    for i, q in enumerate(quantiles):
        h = (F.col("_n") - 1) * F.lit(float(q))
        lo = F.floor(h)
        aggs.append(F.min(F.when(F.col("_ca") >= lo + 1, F.col("score"))).alias(f"_lo{i}"))
        aggs.append(F.min(F.when(F.col("_ca") >= F.least(lo + 2, F.col("_n")), F.col("score"))).alias(f"_hi{i}"))
        aggs.append(F.first(h - lo).alias(f"_fr{i}"))
    a = c2.groupBy(*g).agg(*aggs)
    return a.select(*g, *[(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_fr{i}"))
                          .alias(f"q{i}") for i in range(len(quantiles))])


DECILE_QUANTILES = [k * 0.1 for k in range(11)]


def calibration_curve(df: DataFrame, score: str = "pd", label: str = "y", n_bins: int = 10) -> DataFrame:
    """Quantile calibration curve: bin = number of inner quantile edges strictly below p.

    The edges (n_bins + 1 doubles) are an exact order statistic computed by a
    distributed job and brought to the driver as a tiny statistic.
    """
    qs = [k * (1.0 / n_bins) for k in range(n_bins + 1)] if n_bins != 10 else DECILE_QUANTILES
    edges_row = order_statistics(cumulative_scores(df, score, label), qs).first()
    inner = [float(edges_row[f"q{i}"]) for i in range(1, n_bins)]
    b = F.size(F.filter(F.array(*[F.lit(e) for e in inner]), lambda e: e < F.col(score)))
    return df.groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("accounts"),
        F.avg(F.col(score)).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("observed_rate"))


# Probability histogram edges on [0, 1] (numpy linspace, last bin closed).
HIST_EDGES = linspace(0.0, 1.0, 21)


def score_histogram_bins(df: DataFrame, score: str = "pd", edges=None, group_cols=None) -> DataFrame:
    """Equal-width histogram, bins [e_i, e_i+1), last bin closed, out-of-range ignored."""
    e = list(edges or HIST_EDGES)
    g = _g(group_cols)
    inner = F.array(*[F.lit(float(x)) for x in e[1:-1]])
    p = F.col(score)
    in_range = (p >= e[0]) & (p <= e[-1])
    b = F.size(F.filter(inner, lambda x: x <= p))
    counts = df.filter(in_range).groupBy(*g, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    bins = F.inline(F.array(*[F.struct(F.lit(i).alias("bin"), F.lit(float(e[i])).alias("lower"),
                                       F.lit(float(e[i + 1])).alias("upper")) for i in range(len(e) - 1)]))
    if g:
        keys = df.select(*g).distinct().select(*g, bins)
    else:
        keys = df.sparkSession.range(1).select(bins)
    return keys.join(counts, [*g, "bin"], "left").select(
        *g, "bin", "lower", "upper", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))


def risk_table(df: DataFrame, score: str = "pd", label: str = "y") -> DataFrame:
    """Risk-band calibration table; empty bands are reported with zeros (A10)."""
    a = df.groupBy(risk_band(score).alias("band")).agg(
        F.count(F.lit(1)).alias("accounts"), F.avg(score).alias("mean_pd"),
        F.avg(F.col(label).cast("double")).alias("observed_default_rate"))
    bands = df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("band_order"), F.lit(b).alias("band")) for i, b in enumerate(RISK_BAND_LABELS)])))
    return bands.join(a, "band", "left").select(
        "band_order", "band", F.coalesce("accounts", F.lit(0)).cast("bigint").alias("accounts"),
        F.coalesce("mean_pd", F.lit(0.0)).alias("mean_pd"),
        F.coalesce("observed_default_rate", F.lit(0.0)).alias("observed_default_rate"))


def global_rank(df: DataFrame, order: list[Column], partitions: int | None = None) -> DataFrame:
    """Dense 1-based row position under ``order`` (which must be a total order).

    Range partitioning samples the sort keys, so a hot leading key is split
    across tasks by the trailing keys.  ``monotonically_increasing_id`` numbers
    rows within each sorted partition; per-partition counts (one row per
    partition, a bounded table) give the offsets.
    """
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                .withColumn("_mid", F.monotonically_increasing_id()))
    # Range bounds come from sampling, and row order after a shuffle is not
    # fixed, so two evaluations could partition differently.  A reliable
    # checkpoint (shared checkpoint folder) pins one partitioning for both uses
    # below and survives executor loss.
    ranged = cut_lineage(ranged)
    ranged = ranged.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_local", F.col("_mid") - F.shiftleft(F.col("_pid"), 33) + 1)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    return (ranged.join(offsets, "_pid")
                  .withColumn("rank", F.col("_off") + F.col("_local"))
                  .drop("_mid", "_pid", "_local", "_off"))


def rank_cells(df: DataFrame, cuts: list[int], score: str = "pd", label: str = "y", key: str = "account_id") -> DataFrame:
    """(cell, accounts, events, score_sum): rows by the number of ``cuts`` below their rank.

    Ranks run from 1 by score descending, then id; ``cuts`` ascend.  A score whose rows all
    fall into one cell is counted from the histogram.  At most len(cuts) scores straddle a
    cut; their rows alone are ranked by id.
    """
    upto, count = F.col("tp") + F.col("fp"), F.col("pos") + F.col("neg")
    at = F.array(*[F.lit(int(c)) for c in cuts]).cast("array<bigint>")
    below = lambda rank: count_below(at, rank, len(cuts))
    c = cumulative_scores(df, score, label).select("score", "pos", count.alias("n"), (upto - count).alias("before"))
    c = c.withColumn("cell", below(F.col("before") + 1)).withColumn("last", below(F.col("before") + F.col("n")))
    whole = c.filter("cell = last").groupBy("cell").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.sum(F.col("n") * F.col("score")).alias("s"))
    split = c.filter("cell < last")
    ahead = F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1))  # a row per straddling score
    split = split.select(F.col("score").alias("c_score"), (F.col("before") - F.coalesce(ahead, F.lit(0.0))).alias("shift"))
    rows = df.select(F.col(key).alias("k"), F.col(score).cast("double").alias("score"), F.col(label).cast("double").alias("pos"))
    own = global_rank(rows.join(split, F.col("score") == F.col("c_score")).filter("pos is not null").drop("c_score"), [F.desc("score"), F.asc("k")])
    ranked = own.groupBy(below(F.col("rank") + F.col("shift")).alias("cell")).agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("pos").alias("pos"), F.sum("score").alias("s"))
    return whole.unionByName(ranked).groupBy("cell").agg(F.sum("n").cast("bigint").alias("accounts"), F.sum("pos").cast("bigint").alias("events"), F.sum("s").alias("score_sum"))


def _totals(df: DataFrame, score: str, label: str) -> tuple[int, int]:
    """(scored rows, events): two numbers brought to the driver as a tiny statistic."""
    row = score_histogram(df, score, label).agg(F.sum(F.col("pos") + F.col("neg")).alias("n"), F.sum("pos").alias("e")).first()
    return int(row["n"] or 0), int(row["e"] or 0)


def lift_table(df: DataFrame, score: str = "pd", label: str = "y", key: str = "account_id",
               n_groups: int = 10) -> DataFrame:
    """Score-decile lift: decile of rank r of n is ceil(10 r / n); ties by id."""
    n, events = _totals(df, score, label)
    a = rank_cells(df, [n * i // n_groups for i in range(1, n_groups)], score, label, key)
    base = events / n if n else 0.0
    return a.select(
        (F.col("cell") + 1).alias("decile"), "accounts",
        (F.col("events") / F.col("accounts")).alias("risk_rate"), (F.col("score_sum") / F.col("accounts")).alias("mean_pd"),
        (F.col("events") / F.lit(max(events, 1))).alias("default_share"),
        ((F.col("events") / F.greatest(F.col("accounts"), F.lit(1))) / F.lit(base) if base
         else F.lit(0.0)).alias("lift"))


def sample_indices(n: int, points: int) -> list[int]:
    """numpy ``linspace(0, n-1, points).astype(int)`` computed the same way."""
    if points == 1:
        return [0]
    return [int(v) for v in linspace(0.0, float(n - 1), points)]


def lorenz_curve(df: DataFrame, score: str = "pd", label: str = "y", key: str = "account_id",
                 points: int = 250) -> DataFrame:
    """Gains curve at ``points`` evenly spaced ranks: population share and event share.

    Events are counted per cell between sample points, and a running sum over at most
    ``points`` rows follows.
    """
    n, events = _totals(df, score, label)
    idx = sample_indices(n, points)
    cuts = sorted(set(i + 1 for i in idx))
    ev = rank_cells(df, cuts, score, label, key).select(F.col("cell").alias("b"), F.col("events").alias("ev"))
    spark = df.sparkSession
    pts = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(j).alias("point"), F.lit(i).alias("index"), F.lit(cuts.index(i + 1)).alias("b"))
        for j, i in enumerate(idx)])))
    bev = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(k).alias("b")) for k in range(len(cuts))])))
    bev = bev.join(ev, "b", "left").withColumn(
        "cum", F.sum(F.coalesce("ev", F.lit(0))).over(
            Window.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)))  # <= points rows
    return pts.join(bev, "b").select(
        "point", F.col("index").cast("bigint").alias("index"),
        ((F.col("index") + 1) / F.lit(n)).alias("population_share"),
        (F.col("cum") / F.lit(max(events, 1))).alias("event_share"))


def roc_points(df: DataFrame, score: str = "pd", label: str = "y", max_points: int = 250) -> DataFrame:
    """ROC curve over all distinct thresholds plus the origin, down-sampled by index."""
    c = cumulative_scores(df, score, label)
    pts = c.select("score", (F.col("fp") / F.col("N")).alias("fpr"), (F.col("tp") / F.col("P")).alias("tpr"))
    ranked = global_rank(pts, [F.desc("score")])  # origin is index 0, thresholds 1..m
    m = ranked.count()
    n = m + 1
    keep = sample_indices(n, max_points) if n > max_points else list(range(n))
    keep_arr = F.array(*[F.lit(int(k)) for k in sorted(set(keep))])
    origin = df.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("i"), F.lit(None).cast("double").alias("score"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    allpts = origin.unionByName(ranked.select(F.col("rank").cast("bigint").alias("i"), "score", "fpr", "tpr"))
    return allpts.filter(F.array_contains(keep_arr, F.col("i")))


def nearest_rank(cum: DataFrame, quantiles, group_cols=None) -> DataFrame:
    """Nearest-rank percentiles sorted[ceil(p * n) - 1] from ``cumulative_scores`` output."""
    g = _g(group_cols)
    n_col = F.col("P") + F.col("N")
    c = cum.withColumn("_n", n_col).withColumn(
        "_ca", n_col - (F.col("tp") + F.col("fp")) + F.col("pos") + F.col("neg"))
    aggs = [F.min(F.when(F.col("_ca") >= F.greatest(F.ceil(F.col("_n") * F.lit(float(q))), F.lit(1)),
                         F.col("score"))).alias(f"p{i}") for i, q in enumerate(quantiles)]
    return c.groupBy(*g).agg(F.first("_n").cast("bigint").alias("n"), *aggs)
