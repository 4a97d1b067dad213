"""Portfolio-constrained allocation (D14, D15) as a multiple-choice knapsack over accounts.

Every account chooses exactly one option (hold or an eligible increase).  Four
portfolio caps couple the choices: total limit growth, expected-loss growth,
capital for incremental exposure, and the number of higher-risk increases.
Usage is measured relative to hold, so all-hold is always feasible.

``knapsack.solve`` finds multipliers, fills what they leave free and publishes the gap to
the dual bound; a gap above the target is an error.  The instance is never collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.operators import knapsack, policy
from creditlens.operators.policy import PolicyAssumptions

HIGHER_RISK = ("Moderate", "High", "Very high")
N_RES = knapsack.N_RES
CAPS = ("limit_growth", "loss_growth", "capital", "higher_risk_increases")


@dataclass
class AllocationResult:
    decisions: DataFrame
    lam: tuple
    value: float
    dual_bound: float
    usage: tuple
    caps: tuple

    @property
    def gap(self) -> float:
        return max(self.dual_bound - self.value, 0.0)


def options(decided: DataFrame, a: PolicyAssumptions) -> DataFrame:
    """Per account the allowed options with value and resource usage relative to hold."""
    restricted = F.col("action").isin(*policy.RESTRICTED_ACTIONS)
    cands = F.when(restricted, F.slice(F.col("candidates"), 1, 1)).otherwise(
        F.filter(F.col("candidates"), lambda c: c["eligible"]))
    higher = F.col("risk_band").isin(*HIGHER_RISK)

    def opt(c):
        return F.struct(
            c["increase_pct"].alias("pct"),
            c["incremental_contribution"].alias("v"),
            (c["proposed_limit"] - F.col("current_limit_inr")).alias("a1"),
            (c["proposed_expected_loss"] - F.col("current_expected_loss")).alias("a2"),
            (F.greatest(c["proposed_ead"] - F.col("current_ead"), F.lit(0.0)) * a.capital_allocation_rate).alias("a3"),
            ((c["increase_pct"] > 0) & higher).cast("double").alias("a4"),
            c.alias("c"))
    return decided.withColumn("options", F.transform(cands, opt))


def caps_for(decided: DataFrame, a: PolicyAssumptions) -> tuple:
    t = decided.agg(F.sum("current_limit_inr").alias("lim"), F.sum("current_expected_loss").alias("loss"),
                    F.count(F.lit(1)).alias("n")).first()
    return (float(t["lim"]) * a.portfolio_growth_cap, float(t["loss"]) * a.portfolio_loss_growth_cap,
            float(a.portfolio_capital_budget), float(t["n"]) * a.max_higher_risk_increase_share)


def allocate(decided: DataFrame, a: PolicyAssumptions | None = None, gap_target: float = 0.002, **search) -> AllocationResult:
    """Choose one option per account under the four portfolio caps (see module doc).

    The gap to the bound is at most ``gap_target`` of the value, or the gain of one account per
    cap, which whole accounts cannot promise to beat; else ``knapsack.GapNotMet`` is raised.
    """
    a = a or PolicyAssumptions()
    caps = caps_for(decided, a)
    # figures alone are kept and passed over again; what an option says comes back with its index in choose_with
    figures = F.transform("options", lambda o: F.struct(o["pct"], o["v"], *[o[f"a{k + 1}"] for k in range(N_RES)]))
    found = knapsack.solve(options(decided, a).select(F.lit(0).alias("sid"), "account_id", figures.alias("options")), {0: caps}, gap_target=gap_target,
                           whole_accounts=True, **search)
    o = found.outcomes[0]
    return AllocationResult(choose_with(decided, a, found.chosen), o.lam, o.value, o.bound, o.usage, o.caps)


def choose_with(decided: DataFrame, a: PolicyAssumptions, chosen: DataFrame) -> DataFrame:
    """Take the chosen options (account_id, pick) and relabel the decisions."""
    o = options(decided, a).join(chosen.select("account_id", "pick"), "account_id").withColumn("_pick", F.element_at("options", F.col("pick") + 1))
    restricted = F.col("action").isin(*policy.RESTRICTED_ACTIONS)
    c = F.col("_pick")["c"]
    pct = F.col("_pick")["pct"]
    extra = F.when(pct > 0, F.array(F.lit(policy.R_PORTFOLIO_INCREASE))).otherwise(
        F.array(F.lit(policy.R_EXPOSURE_REACHED), F.lit(policy.R_PORTFOLIO_HOLD)))
    keep = lambda name, new: F.when(restricted, F.col(name)).otherwise(new)
    out = o.withColumns({
        "action": keep("action", policy.action_label(pct)),
        "increase_pct": keep("increase_pct", pct),
        "proposed_limit": keep("proposed_limit", c["proposed_limit"]),
        "proposed_ead": keep("proposed_ead", c["proposed_ead"]),
        "proposed_expected_loss": keep("proposed_expected_loss", c["proposed_expected_loss"]),
        "incremental_contribution": keep("incremental_contribution", c["incremental_contribution"]),
        # usage per cap relative to hold (restricted accounts stay at hold)
        "risk_adjusted_return": keep("risk_adjusted_return", c["risk_adjusted_return"]),
        "reason_codes": keep("reason_codes", F.array_distinct(F.concat(F.col("reason_codes"), extra))),
        "policy_checks": keep("policy_checks", c["checks"]),
        **{f"_u{k + 1}": F.when(restricted, F.lit(0.0)).otherwise(F.col("_pick")[f"a{k + 1}"]) for k in range(N_RES)},
    })
    return out.drop("options", "pick", "_pick", "candidates")
