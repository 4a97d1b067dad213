"""Candidate, kill-switch, reason and scenario queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions.columns import dround, sql_dround, sql_dsum
from creditlens.operators import policy, scenarios
from creditlens.operators.policy import CHECK_NAMES, PolicyAssumptions
from creditlens.plans.oracle_base import acct_ctes, decision_ctes, suffixed_decision_ctes, with_ctes
from creditlens.plans.portfolio import decisions
from creditlens.plans.registry import register
from creditlens.sources import adapters

CHECK_SQL = ["ck_enabled", "ck_maxinc", "ck_exposure", "ck_elc", "ck_hurdle", "ck_history", "ck_overext"]
BAND_SQL = ("CASE WHEN pd < 0.05 THEN 'Low' WHEN pd < 0.15 THEN 'Moderate' WHEN pd < 0.30 THEN 'High' "
            "ELSE 'Very high' END")


def _candidates_sql() -> str:
    checks = ", ".join(f"{c} AS {n}" for c, n in zip(CHECK_SQL, CHECK_NAMES))
    return with_ctes(acct_ctes(), decision_ctes()) + f"""
SELECT account_id, {sql_dround('pd', 6)} AS pd, {BAND_SQL} AS risk_band,
       CAST(row_number() OVER (PARTITION BY account_id ORDER BY pct) - 1 AS INTEGER) AS option_index,
       pct AS increase_pct, {sql_dround('prop_limit')} AS proposed_limit, {sql_dround('prop_ead')} AS proposed_ead,
       {sql_dround('prop_ecl')} AS proposed_expected_loss, {sql_dround('contrib')} AS incremental_contribution,
       {sql_dround('rar', 6)} AS risk_adjusted_return, eligible, {checks}
FROM elig"""


@register("policy_candidates", _candidates_sql)
def q_policy_candidates(spark, sf_dir):
    d = policy.decide(adapters.shared_scored(spark, sf_dir), keep_candidates=True)
    c = policy.explode_candidates(d)
    money = ["proposed_limit", "proposed_ead", "proposed_expected_loss", "incremental_contribution"]
    return c.select(
        "account_id", dround("pd", 6).alias("pd"), "risk_band", "option_index", "increase_pct",
        *[dround(m).alias(m) for m in money], dround("risk_adjusted_return", 6).alias("risk_adjusted_return"),
        "eligible", *CHECK_NAMES)


def _summary_sql(source: str) -> str:
    money = [("current_limit_inr", "current_limit"), ("proposed_limit", "proposed_limit"),
             ("current_ead", "current_ead"), ("proposed_ead", "proposed_ead"),
             ("current_expected_loss", "current_expected_loss"),
             ("proposed_expected_loss", "proposed_expected_loss"),
             ("incremental_contribution", "incremental_contribution")]
    ie = "SUM(CAST(proposed_ead - current_ead AS DECIMAL(38,9)))"
    ic = "SUM(CAST(incremental_contribution AS DECIMAL(38,9)))"
    cols = ["CAST(count(*) AS BIGINT) AS accounts"] + [f"{sql_dsum(c)} AS {n}" for c, n in money]
    cols += ["CAST(sum(CASE WHEN increase_pct > 0 THEN 1 ELSE 0 END) AS BIGINT) AS eligible_increases",
             "CAST(sum(CASE WHEN action IN ('Manual review', 'Freeze automatic increases') THEN 1 ELSE 0 END) "
             "AS BIGINT) AS early_warning",
             f"CAST(ROUND({ie}, 2) AS DOUBLE) AS incremental_exposure",
             f"CASE WHEN {ie} > 0 THEN round(CAST({ic} AS DOUBLE) / CAST({ie} AS DOUBLE), 6) ELSE 0.0 END "
             "AS risk_adjusted_return"]
    return "SELECT " + ", ".join(cols) + f" FROM {source}"


@register("portfolio_summary", lambda: with_ctes(acct_ctes(), decision_ctes()) + "\n" + _summary_sql("reasons"))
def q_portfolio_summary(spark, sf_dir):
    return scenarios.exact_summary(decisions(spark, sf_dir))


def _kill_sql() -> str:
    return with_ctes(acct_ctes(), decision_ctes()) + """,
killed AS (
  SELECT account_id,
    CASE WHEN increase_pct > 0 THEN 'Manual review' ELSE action END AS action,
    CASE WHEN increase_pct > 0 THEN 0.0 ELSE increase_pct END AS increase_pct,
    current_limit_inr, current_ead, current_expected_loss,
    CASE WHEN increase_pct > 0 THEN current_limit_inr ELSE proposed_limit END AS proposed_limit,
    CASE WHEN increase_pct > 0 THEN current_ead ELSE proposed_ead END AS proposed_ead,
    CASE WHEN increase_pct > 0 THEN current_expected_loss ELSE proposed_expected_loss END AS proposed_expected_loss,
    CASE WHEN increase_pct > 0 THEN 0.0 ELSE incremental_contribution END AS incremental_contribution
  FROM reasons)
""" + _summary_sql("killed")


@register("kill_switch", _kill_sql)
def q_kill_switch(spark, sf_dir):
    return scenarios.exact_summary(scenarios.kill_switch(decisions(spark, sf_dir)))


def _kill_reasons_sql() -> str:
    return with_ctes(acct_ctes(), decision_ctes()) + """
SELECT reason, CAST(count(*) AS BIGINT) AS accounts FROM (
  SELECT unnest(string_split(CASE WHEN increase_pct > 0 THEN
      trim(coalesce(reason_codes, '') || ' | Automatic increases disabled by governance control', ' |')
      ELSE reason_codes END, ' | ')) AS reason FROM reasons) GROUP BY reason"""


@register("kill_switch_reasons", _kill_reasons_sql)
def q_kill_switch_reasons(spark, sf_dir):
    k = scenarios.kill_switch(decisions(spark, sf_dir))
    return (k.select(F.explode(F.split("reason_codes", r" \| ")).alias("reason"))
             .groupBy("reason").agg(F.count(F.lit(1)).alias("accounts")))


@register("reason_codes", lambda: with_ctes(acct_ctes(), decision_ctes()) + """
SELECT reason, CAST(count(*) AS BIGINT) AS accounts
FROM (SELECT unnest(string_split(reason_codes, ' | ')) AS reason FROM reasons) GROUP BY reason""")
def q_reason_codes(spark, sf_dir):
    d = decisions(spark, sf_dir)
    return d.select(F.explode("reason_codes").alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("accounts"))


def _sensitivity_sql() -> str:
    grid = scenarios.scenario_grid()
    blocks = [acct_ctes()] + [suffixed_decision_ctes(f"_{i}", a) for i, (_, _, _, a) in enumerate(grid)]
    ie = "SUM(CAST(proposed_ead - current_ead AS DECIMAL(38,9)))"
    ic = "SUM(CAST(incremental_contribution AS DECIMAL(38,9)))"
    selects = []
    for i, (name, label, v, _) in enumerate(grid):
        selects.append(
            f"SELECT {i} AS sid, '{name}' AS assumption, '{label}' AS scenario, {float(v)!r}::DOUBLE AS value, "
            "CAST(sum(CASE WHEN increase_pct > 0 THEN 1 ELSE 0 END) AS BIGINT) AS eligible_increases, "
            f"{sql_dsum('proposed_limit')} AS proposed_limit, "
            f"{sql_dsum('proposed_expected_loss')} AS proposed_expected_loss, "
            f"{sql_dsum('incremental_contribution')} AS incremental_contribution, "
            f"CASE WHEN {ie} <> 0 THEN round(CAST({ic} AS DOUBLE) / CAST({ie} AS DOUBLE), 6) ELSE 0.0 END "
            f"AS risk_adjusted_return FROM decided_{i}")
    return with_ctes(*blocks) + "\n" + "\nUNION ALL\n".join(selects)


@register("scenario_sensitivity", _sensitivity_sql)
def q_scenario_sensitivity(spark, sf_dir):
    return scenarios.sensitivity(adapters.shared_scored(spark, sf_dir))


def _directional_sql() -> str:
    a = PolicyAssumptions()
    rr = a.interchange_rate + a.revolving_rate * a.apr
    pts = []
    for name in scenarios.DIRECTIONAL_ASSUMPTIONS:
        b = getattr(a, name)
        drv = "(-loss_driver)" if name == "lgd" else f"(spend_driver * {rr!r}::DOUBLE)"
        for label, f in scenarios.SCENARIO_FACTORS:
            v = min(b * f, 1.0)
            pts.append(f"SELECT '{name}' AS assumption, '{label}' AS scenario, {v!r}::DOUBLE AS value, "
                       f"contribution + {v - b!r}::DOUBLE * {drv} AS contribution FROM agg")
    return with_ctes(acct_ctes(), decision_ctes()) + f""",
agg AS (
  SELECT CAST(SUM(CAST(incremental_contribution AS DECIMAL(38,9))) AS DOUBLE) AS contribution,
         CAST(SUM(CAST(pd * (proposed_ead - current_ead) AS DECIMAL(38,9))) AS DOUBLE) AS loss_driver,
         CAST(SUM(CAST((proposed_limit - current_limit_inr) * utilization * 12 AS DECIMAL(38,9))) AS DOUBLE)
           AS spend_driver
  FROM reasons),
pts AS ({' UNION ALL '.join(pts)}),
mx AS (SELECT p.*, max(abs(contribution)) OVER (PARTITION BY assumption) AS m FROM pts p)
SELECT assumption, scenario, value, {sql_dround('contribution')} AS contribution,
       round(greatest(2.0, abs(contribution) / CASE WHEN m = 0 THEN 1.0 ELSE m END * 100), 6) AS width,
       contribution < 0 AS negative
FROM mx"""


@register("directional_sensitivity", _directional_sql)
def q_directional_sensitivity(spark, sf_dir):
    return scenarios.directional(decisions(spark, sf_dir))
