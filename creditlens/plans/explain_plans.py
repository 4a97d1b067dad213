"""Explanation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions.columns import dround, sql_dround
from creditlens.operators import explain
from creditlens.plans.oracle_base import acct_ctes, with_ctes
from creditlens.plans.registry import register
from creditlens.sources import adapters


def _score_sql(dq: str, util: str) -> str:
    return f"round(1 / (1 + exp(-(-3.2::DOUBLE + 0.65::DOUBLE * ({dq}) + 0.8::DOUBLE * ({util})))), 6)"


def _dq_sql(pays) -> str:
    return "CAST(" + " + ".join(f"CASE WHEN {p} > 0 THEN 1 ELSE 0 END" for p in pays) + " AS DOUBLE)"


def _counterfactual_sql() -> str:
    pays = ["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]
    bills = [f"BILL_AMT{i}" for i in range(1, 7)]
    base = _score_sql(_dq_sql(pays), "least(BILL_AMT1 / LIMIT_BAL, 5.0)")
    mean_bill = "((" + " + ".join(bills) + ") / 6)"
    scen = [
        _score_sql(_dq_sql([f"least({p}, 0.0)" for p in pays]), "least(BILL_AMT1 / LIMIT_BAL, 5.0)"),
        _score_sql(_dq_sql(pays), "least(least(BILL_AMT1, LIMIT_BAL * 0.30) / LIMIT_BAL, 5.0)"),
        base,
        _score_sql(_dq_sql(pays), f"least({mean_bill} / LIMIT_BAL, 5.0)"),
    ]
    sel = " UNION ALL ".join(
        f"SELECT account_id, {i} AS go, '{g}' AS feature_group, {base} AS observed_score, {s} AS neutralized_score FROM acct6"
        for i, (g, s) in enumerate(zip(explain.GROUPS, scen)))
    return with_ctes(acct_ctes()) + f""",
cf AS ({sel})
SELECT account_id, feature_group, {sql_dround('observed_score', 6)} AS observed_score,
       {sql_dround('neutralized_score', 6)} AS neutralized_score, {sql_dround('neutralized_score - observed_score', 6)} AS score_change,
       CASE WHEN neutralized_score < observed_score THEN 'risk-increasing evidence' ELSE 'risk-reducing evidence' END AS direction,
       CAST(row_number() OVER (PARTITION BY account_id ORDER BY abs(neutralized_score - observed_score) DESC, go) AS INTEGER) AS rank
FROM cf"""


@register("counterfactuals", _counterfactual_sql)
def q_counterfactuals(spark, sf_dir):
    c = explain.counterfactuals(adapters.shared_scored(spark, sf_dir))
    return c.select("account_id", "feature_group", *[dround(x, 6).alias(x) for x in
                                                     ("observed_score", "neutralized_score", "score_change")],
                    "direction", "rank")


def _perm_sql() -> str:
    auc = lambda src, p: f"""(SELECT (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / (CAST(sum(y) AS DOUBLE) * sum(1 - y))
        FROM (SELECT y, rank() OVER (ORDER BY {p}) + (count(*) OVER (PARTITION BY {p}) - 1) / 2.0 AS r FROM {src}))"""
    perms = []
    for r in range(1, 6):
        for f in ("delinquency_count", "utilization"):
            dq = "b.delinquency_count" if f == "delinquency_count" else "a.delinquency_count"
            ut = "b.utilization" if f == "utilization" else "a.utilization"
            perms.append(f"SELECT '{f}' AS feature, {r} AS rep, a.source_dataset AS src, a.y, {_score_sql(dq, ut)} AS p FROM r0 a JOIN r0 b "
                         f"ON a.source_dataset = b.source_dataset AND b.k = "
                         f"CAST((CAST(a.k AS HUGEINT) * {explain.PERM_PRIMES[r - 1]} + {r * 7919}) % a.n AS BIGINT)")
    return with_ctes(acct_ctes()) + f""",
r0 AS (SELECT account_id, source_dataset, delinquency_count, utilization, y,
              row_number() OVER (PARTITION BY source_dataset ORDER BY md5('1000:' || account_id), account_id) - 1 AS k,
              count(*) OVER (PARTITION BY source_dataset) AS n FROM scored_y),
perm AS ({' UNION ALL '.join(perms)}),
rk AS (SELECT feature, rep, y, rank() OVER (PARTITION BY feature, rep ORDER BY p)
              + (count(*) OVER (PARTITION BY feature, rep, p) - 1) / 2.0 AS r FROM perm),
aucs AS (SELECT feature, rep, (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0)
                / (CAST(sum(y) AS DOUBLE) * sum(1 - y)) AS auc FROM rk GROUP BY feature, rep),
srk AS (SELECT feature, rep, src, y, rank() OVER (PARTITION BY feature, rep, src ORDER BY p)
              + (count(*) OVER (PARTITION BY feature, rep, src, p) - 1) / 2.0 AS r
        FROM (SELECT * FROM perm UNION ALL SELECT 'base', 0, source_dataset, y, pd FROM scored_y)),
sauc AS (SELECT feature, rep, src, (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0)
                / (CAST(sum(y) AS DOUBLE) * sum(1 - y)) AS auc FROM srk GROUP BY feature, rep, src),
macro AS (SELECT s.feature, s.rep, avg(b.auc - s.auc) AS d FROM sauc s JOIN sauc b ON b.feature = 'base' AND b.src = s.src
          WHERE s.feature <> 'base' GROUP BY 1, 2),
base AS (SELECT {auc('scored_y', 'pd')} AS b),
m AS (SELECT feature, avg(d) AS mean_drop, stddev_pop(d) AS std_drop FROM macro GROUP BY 1)
SELECT feature, {sql_dround('any_value(mean_drop)', 6)} AS mean_auc_drop, {sql_dround('any_value(std_drop)', 6)} AS std_auc_drop,
       {sql_dround('avg(b - auc)', 6)} AS pooled_mean_auc_drop, {sql_dround('max(b)', 6)} AS base_auc
FROM aucs JOIN m USING (feature), base GROUP BY feature"""


@register("permutation_importance", _perm_sql)
def q_permutation_importance(spark, sf_dir):
    s = adapters.shared_scored(spark, sf_dir)
    r = explain.permutation_importance(s, "account_id", "source_dataset", "y")
    return r.select("feature", *[dround(c, 6).alias(c) for c in ("mean_auc_drop", "std_auc_drop", "pooled_mean_auc_drop", "base_auc")])


def _pdp_sql(feature: str) -> str:
    qs = ", ".join(f"{q!r}" for q in explain.PDP_QUANTILES)
    dq = "g.value" if feature == "delinquency_count" else "s.delinquency_count"
    ut = "g.value" if feature == "utilization" else "s.utilization"
    return with_ctes(acct_ctes()) + f""",
q AS (SELECT source_dataset, quantile_cont({feature}, [{qs}]) AS v, count(*) AS c FROM scored_y WHERE {feature} IS NOT NULL GROUP BY 1),
g AS (SELECT source_dataset, i - 1 AS point, v[i] AS value FROM q, range(1, 17) t(i) WHERE c >= 100),
per AS (SELECT s.source_dataset, g.point, g.value, avg({_score_sql(dq, ut)}) AS m
        FROM scored_y s JOIN g ON g.source_dataset = s.source_dataset WHERE s.{feature} IS NOT NULL GROUP BY 1, 2, 3)
SELECT CAST(point AS INTEGER) AS point, {sql_dround('avg(value)', 6)} AS value, {sql_dround('avg(m)', 6)} AS partial_dependence,
       CAST(count(*) AS BIGINT) AS sources
FROM per GROUP BY point"""


@register("partial_dependence", lambda: _pdp_sql("utilization"))
def q_partial_dependence(spark, sf_dir):
    p = explain.partial_dependence(adapters.shared_scored(spark, sf_dir), "utilization", "source_dataset")
    return p.select("point", dround("value", 6).alias("value"),
                    dround("partial_dependence", 6).alias("partial_dependence"), "sources")
