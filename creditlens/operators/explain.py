"""Model explanation: counterfactual neutralisations (E25) and permutation importance.

The scorer is a column expression over the history (the deterministic
scorecard), so both operators stay narrow or use equi-joins: a permutation
pairs the k-th row of one hash order with the k-th row of another within the
same source, i.e. an equi-join on (source, k) with unique keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlens.operators import evaluate as ev
from creditlens.operators.resample import rank_within
from creditlens.sources.adapters import BILL_COLUMNS, PAY_COLUMNS, SCORE_DQ, SCORE_INTERCEPT, SCORE_UTIL


def scorecard(dq: Column, util: Column) -> Column:
    return F.round(1 / (1 + F.exp(-(F.lit(SCORE_INTERCEPT) + SCORE_DQ * dq + SCORE_UTIL * util))), 6)


def history_score(pay: list[Column], bill1: Column, limit: Column) -> Column:
    dq = sum(F.when(p > 0, 1).otherwise(0) for p in pay).cast("double")
    return scorecard(dq, F.least(bill1 / limit, F.lit(5.0)))


# Neutralised feature groups in evaluation order.
GROUPS = ("repayment_status_history", "bill_and_utilization_history", "payment_amount_history",
          "balance_trend_and_volatility")


def counterfactuals(acct: DataFrame, key: str = "account_id") -> DataFrame:
    """Four one-group neutralisations per account, ranked by absolute score change."""
    lim = F.col("LIMIT_BAL")
    pay = [F.col(c) for c in PAY_COLUMNS]
    bills = [F.col(c) for c in BILL_COLUMNS]
    base = history_score(pay, bills[0], lim)
    mean_bill = sum(bills) / len(bills)
    scen = [
        history_score([F.least(p, F.lit(0.0)) for p in pay], bills[0], lim),
        history_score(pay, F.least(bills[0], lim * 0.30), lim),
        base,  # payments do not enter the scorecard
        history_score(pay, mean_bill, lim),
    ]
    rows = F.array(*[F.struct(F.lit(i).alias("group_order"), F.lit(g).alias("feature_group"), s.alias("neutralized_score"))
                     for i, (g, s) in enumerate(zip(GROUPS, scen))])
    x = acct.select(key, base.alias("observed_score"), F.inline(rows))
    x = x.withColumn("score_change", F.col("neutralized_score") - F.col("observed_score"))
    w = Window.partitionBy(key).orderBy(F.desc(F.abs("score_change")), "group_order")  # 4 rows per account
    return x.select(key, "feature_group", "observed_score", "neutralized_score", "score_change",
                    F.when(F.col("neutralized_score") < F.col("observed_score"), "risk-increasing evidence")
                     .otherwise("risk-reducing evidence").alias("direction"),
                    F.row_number().over(w).alias("rank"))


PERMUTED = ("delinquency_count", "utilization")
# Primes just below powers of two, each above any stratum's size: a different permutation for each repeat.
PERM_PRIMES = (2**59 - 55, 2**60 - 93, 2**61 - 1, 2**62 - 57, 2**63 - 25)


def permutation_importance(df: DataFrame, key: str, source: str, label: str, repeats: int = 5) -> DataFrame:
    """Within-source permutation of each scorecard input.

    ``mean_auc_drop`` and ``std_auc_drop`` are over repeats of the macro drop, the mean over
    sources of a source's own AUC drop; ``pooled_mean_auc_drop`` is that of all rows together.
    One hash rank k (0-based) per source; repeat r maps k -> (k * prime_r + r * 7919) mod n, a
    bijection because the prime is above every n.  Each repeat is an equi-join on
    (source, mapped rank): unique keys, no skew, no second ranking job.
    """
    if not 1 <= repeats <= len(PERM_PRIMES):
        raise ValueError(f"1 to {len(PERM_PRIMES)} repeats: each needs a prime of its own")
    ranked = rank_within(df, [source], key, seed=1000).select(
        key, source, label, *PERMUTED, (F.col("stratum_rank") - 1).alias("k"), F.col("stratum_size").alias("n"))
    donors = ranked.select(source, F.col("k").alias("_k2"), *[F.col(f).alias(f"_perm_{f}") for f in PERMUTED])
    reps = ranked.select("*", F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("repeat"))
    prime = F.element_at(F.array(*[F.lit(x).cast("decimal(38,0)") for x in PERM_PRIMES]), (F.col("repeat") - 1) % len(PERM_PRIMES) + 1)
    mapped = F.pmod(F.col("k").cast("decimal(19,0)") * prime.cast("decimal(19,0)") + F.col("repeat").cast("decimal(19,0)") * 7919,
                    F.col("n").cast("decimal(38,0)")).cast("bigint")
    j = reps.withColumn("_k2", mapped).join(donors, [source, "_k2"])  # one join for all repeats
    own = scorecard(F.col("delinquency_count"), F.col("utilization"))
    scores = F.array(
        F.struct(F.lit("delinquency_count").alias("feature"),
                 scorecard(F.col("_perm_delinquency_count"), F.col("utilization")).alias("_p")),
        F.struct(F.lit("utilization").alias("feature"),
                 scorecard(F.col("delinquency_count"), F.col("_perm_utilization")).alias("_p")))
    u = j.select("repeat", source, label, F.inline(scores)).persist()
    base = df.withColumn("_p", own)
    pooled_base = ev.discrimination(base, "_p", label).select("roc_auc").first()[0]
    by_source = ev.discrimination(base, "_p", label, [source]).select(source, F.col("roc_auc").alias("_base"))
    per = ev.discrimination(u, "_p", label, ["feature", "repeat", source]).join(by_source, source)
    macro = per.groupBy("feature", "repeat").agg(F.avg(F.col("_base") - F.col("roc_auc")).alias("drop"))
    pooled = ev.discrimination(u, "_p", label, ["feature", "repeat"]).groupBy("feature").agg(
        F.avg(F.lit(float(pooled_base)) - F.col("roc_auc")).alias("pooled_mean_auc_drop"))
    return macro.groupBy("feature").agg(F.avg("drop").alias("mean_auc_drop"), F.stddev_pop("drop").alias("std_auc_drop")).join(pooled, "feature").select(
        "*", F.lit(float(pooled_base)).alias("base_auc"))


# Partial-dependence grid quantiles (16 points from 0.01 to 0.99).
PDP_QUANTILES = [0.01 + i * (0.98 / 15) for i in range(16)]
PDP_QUANTILES[-1] = 0.99


def partial_dependence(df: DataFrame, feature: str, source: str, min_rows: int = 100) -> DataFrame:
    """Effect curve of ``feature``: each source's own grid of quantiles over its observed rows, and
    the equal-weight average of values and scores over sources with at least ``min_rows`` of them (E17).

    A source's grid is a row of exact order statistics; each observed row evaluates all grid
    points in-row, with one aggregation per (source, point).
    """
    obs = df.filter(F.col(feature).isNotNull())
    grid = ev.order_statistics(ev.cumulative_scores(obs.withColumn("_y", F.lit(0)), feature, "_y", [source]), PDP_QUANTILES, [source])
    grid = grid.select(F.col(source).alias("_source"), F.array(*[F.struct(F.lit(i).alias("point"), F.col(f"q{i}").alias("value"))
                                                                 for i in range(len(PDP_QUANTILES))]).alias("_grid"))  # a row per source

    def score_at(p):
        dq = p["value"] if feature == "delinquency_count" else F.col("delinquency_count")
        ut = p["value"] if feature == "utilization" else F.col("utilization")
        return F.struct(p["point"].alias("point"), p["value"].alias("value"), scorecard(dq, ut).alias("score"))

    each = obs.join(grid, obs[source].eqNullSafe(F.col("_source"))).select("_source", F.inline(F.transform("_grid", score_at)))
    per = each.groupBy("_source", "point").agg(F.count(F.lit(1)).alias("_n"), F.first("value").alias("value"), F.avg("score").alias("mean_score"))
    return per.filter(F.col("_n") >= min_rows).groupBy("point").agg(
        F.avg("value").alias("value"), F.avg("mean_score").alias("partial_dependence"), F.count(F.lit(1)).alias("sources"))
