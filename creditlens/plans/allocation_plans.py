"""Portfolio allocation queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from creditlens.functions.columns import dround, sql_dround
from creditlens.operators import allocate as al
from creditlens.operators import policy, scenarios
from creditlens.operators.policy import PolicyAssumptions
from creditlens.plans import portfolio
from creditlens.plans.oracle_base import acct_ctes, decision_ctes, with_ctes
from creditlens.plans.registry import register
from creditlens.sources import adapters


def _decided(spark, sf_dir, a):
    return policy.decide(adapters.shared_scored(spark, sf_dir), a, keep_candidates=True)


UNCAPPED = dict(portfolio_growth_cap=1.0, portfolio_loss_growth_cap=1.0, portfolio_capital_budget=1e18,
                max_higher_risk_increase_share=1.0)


@register("allocation_unconstrained", portfolio._mart_sql("action_summary"))
def q_allocation_unconstrained(spark, sf_dir):
    """With caps that cannot bind the allocation must equal the per-account optimum."""
    a = replace(PolicyAssumptions(), **UNCAPPED)
    r = al.allocate(_decided(spark, sf_dir, a), a)
    d = r.decisions
    return d.groupBy("action").agg(
        F.count(F.lit(1)).alias("accounts"),
        F.round(F.sum((F.col("proposed_limit") - F.col("current_limit_inr")).cast("decimal(38,9)")), 2)
         .cast("double").alias("incremental_limit"),
        F.round(F.sum(F.col("incremental_contribution").cast("decimal(38,9)")), 2).cast("double")
         .alias("simulated_contribution"))


CAP_NAMES = list(al.CAPS)


def _usage_sql(a: PolicyAssumptions) -> str:
    caps = [f"sum(current_limit_inr) * {a.portfolio_growth_cap!r}", f"sum(current_expected_loss) * {a.portfolio_loss_growth_cap!r}",
            f"CAST({a.portfolio_capital_budget!r} AS DOUBLE)", f"count(*) * {a.max_higher_risk_increase_share!r}"]
    rows = " UNION ALL ".join(f"SELECT '{n}' AS constraint_name, {c} AS cap, count(*) AS accounts FROM reasons" for n, c in zip(CAP_NAMES, caps))
    return with_ctes(acct_ctes(), decision_ctes()) + f"""
SELECT constraint_name, {sql_dround('cap', 2)} AS cap, CAST(accounts AS BIGINT) AS accounts, TRUE AS within_cap, TRUE AS below_bound, TRUE AS gap_small, TRUE AS beats_holding
FROM ({rows})"""


TIGHT = dict(portfolio_growth_cap=0.03, portfolio_loss_growth_cap=0.03, portfolio_capital_budget=2_000_000_000.0, max_higher_risk_increase_share=0.1)


@register("portfolio_allocation_usage", lambda: _usage_sql(PolicyAssumptions()))
def q_portfolio_allocation(spark, sf_dir):
    """Allocation under the default caps: each cap, and whether the allocation keeps it and comes near the dual bound (the figures: portfolio_allocation_values)."""
    return _usage(spark, sf_dir, PolicyAssumptions())


@register("portfolio_allocation_tight", lambda: _usage_sql(replace(PolicyAssumptions(), **TIGHT)))
def q_portfolio_allocation_tight(spark, sf_dir):
    """The same with caps that bind: growth and loss at 3 %, higher-risk increases at 10 %."""
    return _usage(spark, sf_dir, replace(PolicyAssumptions(), **TIGHT))


@register("portfolio_allocation_values")
def q_portfolio_allocation_values(spark, sf_dir):
    """Allocation under the default caps: usage of each cap, value, dual bound and gap (no SQL)."""
    return _usage_values(spark, sf_dir, PolicyAssumptions()).withColumnRenamed("constraint", "constraint_name")


def _usage(spark, sf_dir, a):
    v = _usage_values(spark, sf_dir, a)
    return v.select(F.col("constraint").alias("constraint_name"), "cap", F.col("accounts").cast("bigint").alias("accounts"),
                    (F.col("usage") <= F.col("cap") + 0.01).alias("within_cap"), (F.col("value") <= F.col("dual_bound") + 0.01).alias("below_bound"),
                    (F.col("gap") <= 0.05 * F.col("dual_bound")).alias("gap_small"), (F.col("value") >= 0).alias("beats_holding"))


@register("portfolio_allocation_tight_values")
def q_portfolio_allocation_tight_values(spark, sf_dir):
    """Allocation under caps that bind: usage of each cap, value, dual bound and gap (no SQL)."""
    return _usage_values(spark, sf_dir, replace(PolicyAssumptions(), **TIGHT)).withColumnRenamed("constraint", "constraint_name")


# One cap that counts: at most so large a share of the accounts may be higher-risk increases.
COUNTED = UNCAPPED | dict(max_higher_risk_increase_share=0.02)


def _counted_sql() -> str:
    a = replace(PolicyAssumptions(), **COUNTED)
    higher = "risk_band IN ('Moderate', 'High', 'Very high')"
    return with_ctes(acct_ctes(), decision_ctes(a)) + f""",
ranked AS (
  SELECT r.*, {higher} AND increase_pct > 0 AS counted,
    row_number() OVER (PARTITION BY {higher} AND increase_pct > 0 ORDER BY incremental_contribution DESC, account_id) AS nth,
    floor((SELECT count(*) FROM reasons) * {a.max_higher_risk_increase_share!r} + 1e-9) AS most
  FROM reasons r),
kept AS (SELECT *, wstate IS NULL AND NOT (counted AND nth > most) AND increase_pct > 0 AS raised FROM ranked)
SELECT account_id, CASE WHEN wstate IS NOT NULL THEN action WHEN raised THEN action ELSE 'No change' END AS action,
  CASE WHEN raised THEN increase_pct ELSE 0.0::DOUBLE END AS increase_pct,
  CASE WHEN raised THEN {sql_dround('incremental_contribution', 2)} WHEN wstate IS NOT NULL THEN {sql_dround('incremental_contribution', 2)} ELSE 0.0::DOUBLE END AS incremental_contribution,
  CASE WHEN raised THEN {sql_dround('proposed_limit', 2)} ELSE {sql_dround('current_limit_inr', 2)} END AS proposed_limit,
  CASE WHEN wstate IS NOT NULL THEN 'not allocated' WHEN raised THEN '{policy.R_PORTFOLIO_INCREASE}'
       ELSE '{policy.R_EXPOSURE_REACHED} | {policy.R_PORTFOLIO_HOLD}' END AS appended
FROM kept"""


@register("allocation_counted_cap", _counted_sql)
def q_allocation_counted_cap(spark, sf_dir):
    """Allocation with one cap that binds, on the number of higher-risk increases: each account's action and appended reasons.

    The optimum of this case is the largest gains, so SQL can tell it.
    """
    a = replace(PolicyAssumptions(), **COUNTED)
    d = al.allocate(_decided(spark, sf_dir, a), a).decisions
    own = [policy.R_PORTFOLIO_INCREASE, policy.R_EXPOSURE_REACHED, policy.R_PORTFOLIO_HOLD]
    added = F.array_join(F.filter("reason_codes", lambda r: r.isin(*own)), " | ")
    return d.select("account_id", "action", "increase_pct", dround("incremental_contribution", 2).alias("incremental_contribution"),
                    dround("proposed_limit", 2).alias("proposed_limit"),
                    F.when(F.col("action").isin(*policy.RESTRICTED_ACTIONS), F.lit("not allocated")).otherwise(added).alias("appended"))


def _slack_sql() -> str:
    from creditlens.plans.policy_plans import _sensitivity_sql
    return _sensitivity_sql()


@register("sensitivity_slack_caps", _slack_sql)
def q_sensitivity_slack_caps(spark, sf_dir):
    """The 30 scenarios through the capped search with caps that cannot bind: the unconstrained sensitivity."""
    found = scenarios.constrained_sensitivity(adapters.shared_scored(spark, sf_dir), replace(PolicyAssumptions(), **UNCAPPED))
    return found.select("sid", "assumption", "scenario", "value", "eligible_increases", "proposed_limit", "proposed_expected_loss",
                        "incremental_contribution", "risk_adjusted_return")


@register("constrained_sensitivity")
def q_constrained_sensitivity(spark, sf_dir):
    """The 30 scenarios allocated again under the portfolio caps: result, usage, caps, bound and gap (no SQL)."""
    return scenarios.constrained_sensitivity(adapters.shared_scored(spark, sf_dir), replace(PolicyAssumptions(), **TIGHT))


def _usage_values(spark, sf_dir, a):
    r = al.allocate(_decided(spark, sf_dir, a), a)
    d = r.decisions
    agg = d.agg(F.count(F.lit(1)).alias("accounts"),
                F.sum((F.col("increase_pct") > 0).cast("long")).alias("increases"),
                F.sum("incremental_contribution").alias("value"),
                *[F.sum(f"_u{k + 1}").alias(n) for k, n in enumerate(CAP_NAMES)])
    long = agg.unpivot(["accounts", "increases", "value"], CAP_NAMES, "constraint", "usage")
    caps = F.create_map(*[x for n, c in zip(CAP_NAMES, r.caps) for x in (F.lit(n), F.lit(float(c)))])
    return long.select("constraint", dround("usage", 2).alias("usage"), dround(caps[F.col("constraint")], 2).alias("cap"),
                       "accounts", "increases", dround("value", 2).alias("value"),
                       F.lit(round(r.dual_bound, 2)).alias("dual_bound"), F.lit(round(r.gap, 2)).alias("gap"))
