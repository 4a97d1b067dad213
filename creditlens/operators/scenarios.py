"""Policy scenario analysis (D16-D18) and the governance kill switch.

Many policies are evaluated in ONE pass over the accounts: the scenarios of an
account are inlined as rows, decided as plain columns and partially aggregated
inside the same task, so the shuffle carries (#scenarios x #tasks) rows.  No
cross join is used.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.functions.columns import let, risk_band
from creditlens.operators import policy
from creditlens.operators.policy import PolicyAssumptions

# Assumptions varied one at a time, and the scenario factors.
SENSITIVITY_ASSUMPTIONS = (
    "lgd", "ccf", "interchange_rate", "apr", "funding_cost", "capital_cost",
    "response_elasticity", "max_increase", "expected_loss_ceiling", "profitability_hurdle",
)
SCENARIO_FACTORS = (("Low", 0.8), ("Base", 1.0), ("High", 1.2))
DIRECTIONAL_ASSUMPTIONS = ("lgd", "response_elasticity")


def scenario_grid(base: PolicyAssumptions | None = None):
    """[(assumption, label, value, PolicyAssumptions)] for the one-at-a-time grid."""
    base = base or PolicyAssumptions()
    values = base.to_dict()
    out = []
    for name in SENSITIVITY_ASSUMPTIONS:
        b = values[name]
        for label, factor in SCENARIO_FACTORS:
            v = min(b * factor, 1.0) if b <= 1 else b * factor
            out.append((name, label, v, replace(base, **{name: v})))
    return out


def scenario_table(grid) -> Column:
    """The scenario grid as a literal ARRAY<STRUCT> (bounded: one entry per scenario).

    Built as one SQL literal expression (a single call instead of one per field).
    """
    def num(x):
        return f"CAST('{float(x)!r}' AS DOUBLE)"

    items = []
    for i, (n, lab, v, a) in enumerate(grid):
        kv = [f"'sid', {i}", f"'assumption', '{n}'", f"'scenario', '{lab}'", f"'value', {num(v)}"]
        kv += [f"'{k}', {num(x)}" for k, x in a.to_dict().items()]
        items.append("named_struct(" + ", ".join(kv) + ")")
    return F.expr("array(" + ", ".join(items) + ")")


def _inlined(scored: DataFrame, grid) -> DataFrame:
    """A row for each account and scenario: account_id, behaviour columns, ``_warned``, ``_band`` and the scenario's fields."""
    b = policy.with_behavior(scored).select("account_id", "pd", *policy.BEHAVIOR_COLUMNS, policy._warning()[0].isNotNull().alias("_warned"), risk_band(F.col("pd")).alias("_band"))
    # the accounts are few bytes and as many times the work as there are scenarios, so they are spread over all cores
    return b.repartition(scored.sparkSession.sparkContext.defaultParallelism * 2).select("*", F.inline(scenario_table(grid)))


def _options() -> dict[str, Column]:
    """The options of a row of ``_inlined`` as plain columns, hold first: lambda functions are interpreted for each row and not compiled."""
    P = {k: F.col(k) for k in PolicyAssumptions.names()}
    return {f"_c{i}": policy.candidate(pct, P, F.lit(True)) for i, pct in enumerate(policy.CANDIDATE_PCTS)}


def _summed(rows: DataFrame) -> DataFrame:
    """What every account chooses under the scenario of its row: increase, limit, loss, contribution and exposure.

    ``rows`` is from ``_inlined``.
    """
    options = _options()

    def ranked(c):
        o = F.col(c)
        return F.struct(o["incremental_contribution"].alias("v"), (-o["increase_pct"]).alias("neg_pct"), o["proposed_limit"].alias("proposed_limit"),
                        o["proposed_expected_loss"].alias("proposed_expected_loss"), o["delta_ead"].alias("delta_ead"))

    hold, *increases = options  # an increase above the largest that is allowed is not eligible
    chosen = F.array_max(F.array(ranked(hold), *[F.when(~F.col("_warned") & F.col(c)["eligible"], ranked(c)) for c in increases]))
    return rows.select("sid", "assumption", "scenario", "value", *[o.alias(c) for c, o in options.items()], "_warned").select(
        "sid", "assumption", "scenario", "value", chosen.alias("_s")).select(
        "sid", "assumption", "scenario", "value", (F.col("_s.neg_pct") < 0).cast("int").alias("increase"), "_s.proposed_limit", "_s.proposed_expected_loss",
        F.col("_s.v").alias("incremental_contribution"), F.col("_s.delta_ead").alias("incremental_exposure"))


def sensitivity(scored: DataFrame, base: PolicyAssumptions | None = None) -> DataFrame:
    """Unconstrained one-at-a-time sensitivity: 30 full re-decisions in one job.

    The scenario grid is a literal array; an account's rows, one for each scenario, are
    inlined, decided and partially aggregated in the same task, so the shuffle carries
    (#scenarios x #tasks) rows.
    """
    grid = scenario_grid(base)
    for *_, a in grid:
        a.validate()
    per = _summed(_inlined(scored, grid))
    dec = lambda c: F.sum(F.col(c).cast("decimal(38,9)"))
    g = per.groupBy("sid", "assumption", "scenario", "value").agg(
        F.sum("increase").cast("bigint").alias("eligible_increases"),
        dec("proposed_limit").alias("_pl"), dec("proposed_expected_loss").alias("_pel"),
        dec("incremental_contribution").alias("_ic"), dec("incremental_exposure").alias("_ie"))
    return g.select(
        "sid", "assumption", "scenario", "value", "eligible_increases",
        F.round("_pl", 2).cast("double").alias("proposed_limit"),
        F.round("_pel", 2).cast("double").alias("proposed_expected_loss"),
        F.round("_ic", 2).cast("double").alias("incremental_contribution"),
        F.when(F.col("_ie") != 0, F.round(F.col("_ic").cast("double") / F.col("_ie").cast("double"), 6))
         .otherwise(F.lit(0.0)).alias("risk_adjusted_return"))


def constrained_sensitivity(scored: DataFrame, base: PolicyAssumptions | None = None, gap_target: float = 0.002) -> DataFrame:
    """The 30 scenarios, each allocated again under its own portfolio caps (D16), with usage and gap.

    The base scenario is solved first; its multipliers start the others, which are then solved
    together: a round's job holds the candidates of every scenario that is still open, and each
    scenario keeps its own bracket.  Its rows are those of ``sensitivity`` where no cap binds.
    """
    from creditlens.operators import allocate, knapsack

    base = base or PolicyAssumptions()
    grid = scenario_grid(base)
    for *_, a in grid:
        a.validate()
    first = next(i for i, (_, label, _, _) in enumerate(grid) if label == "Base")

    def rows(of) -> DataFrame:
        """(sid, account_id, limit, loss, options) of the scenarios; the options are those allowed, hold first."""
        options = _options()
        hold, *increases = options

        def figures(c):
            x, now = F.col(c), F.col(hold)
            return F.struct(
                x["increase_pct"].alias("pct"), x["incremental_contribution"].alias("v"), (x["proposed_limit"] - F.col("_limit")).alias("a1"),
                (x["proposed_expected_loss"] - now["proposed_expected_loss"]).alias("a2"),
                (F.greatest(x["proposed_ead"] - now["proposed_ead"], F.lit(0.0)) * F.col("capital_allocation_rate")).alias("a3"),
                ((x["increase_pct"] > 0) & F.col("_band").isin(*allocate.HIGHER_RISK)).cast("double").alias("a4"), x["proposed_limit"].alias("proposed_limit"),
                x["proposed_expected_loss"].alias("proposed_expected_loss"), x["delta_ead"].alias("delta_ead"))

        allowed = F.array_compact(F.array(figures(hold), *[F.when(~F.col("_warned") & F.col(c)["eligible"], figures(c)) for c in increases]))
        return (_inlined(scored, grid).filter(F.col("sid").isin(*of)).select("sid", "account_id", "_limit", "_warned", "_band", "capital_allocation_rate", *[o.alias(c) for c, o in options.items()])
                .select("sid", "account_id", F.col("_limit").alias("limit"), F.col(hold)["proposed_expected_loss"].alias("loss"), allowed.alias("options")))

    every = list(range(len(grid)))
    sums = rows(every).groupBy("sid").agg(F.sum("limit").alias("limit"), F.sum("loss").alias("loss"), F.count(F.lit(1)).alias("n")).collect()  # a row per scenario
    caps = {}
    for r in sums:
        a = grid[r["sid"]][3]
        caps[r["sid"]] = (r["limit"] * a.portfolio_growth_cap, r["loss"] * a.portfolio_loss_growth_cap, a.portfolio_capital_budget, r["n"] * a.max_higher_risk_increase_share)
    start = knapsack.solve(rows([first]), {first: caps[first]}, gap_target=gap_target, whole_accounts=True).outcomes[first].lam
    found = knapsack.solve(rows(every), caps, start=start, gap_target=gap_target, whole_accounts=True)
    named = scored.sparkSession.createDataFrame(
        [(i, n, label, float(v), *map(float, found.outcomes[i].usage), *map(float, caps[i]), float(found.outcomes[i].bound), float(found.outcomes[i].gap))
         for i, (n, label, v, _) in enumerate(grid) if i in caps],
        "sid int, assumption string, scenario string, value double, " + ", ".join(f"usage_{c} double" for c in allocate.CAPS) + ", "
        + ", ".join(f"cap_{c} double" for c in allocate.CAPS) + ", bound double, gap double")
    c = F.element_at("options", F.col("pick") + 1)
    dec = lambda x: F.sum(x.cast("decimal(38,9)"))
    g = found.chosen.groupBy("sid").agg(
        F.sum((c["pct"] > 0).cast("int")).cast("bigint").alias("eligible_increases"), dec(c["proposed_limit"]).alias("_pl"),
        dec(c["proposed_expected_loss"]).alias("_pel"), dec(c["v"]).alias("_ic"), dec(c["delta_ead"]).alias("_ie"))
    return g.join(named, "sid").select(
        "sid", "assumption", "scenario", "value", "eligible_increases",
        F.round("_pl", 2).cast("double").alias("proposed_limit"), F.round("_pel", 2).cast("double").alias("proposed_expected_loss"),
        F.round("_ic", 2).cast("double").alias("incremental_contribution"),
        F.when(F.col("_ie") != 0, F.round(F.col("_ic").cast("double") / F.col("_ie").cast("double"), 6)).otherwise(F.lit(0.0)).alias("risk_adjusted_return"),
        *[f"{kind}_{x}" for kind in ("usage", "cap") for x in allocate.CAPS], "bound", "gap")


def directional(decisions: DataFrame, base: PolicyAssumptions | None = None) -> DataFrame:
    """Fixed-action sensitivity: contribution is linear in LGD and elasticity."""
    a = base or PolicyAssumptions()
    dec = lambda e: F.sum(e.cast("decimal(38,9)")).cast("double")
    agg = decisions.agg(
        dec(F.col("incremental_contribution")).alias("contribution"),
        dec(F.col("pd") * (F.col("proposed_ead") - F.col("current_ead"))).alias("loss_driver"),
        dec((F.col("proposed_limit") - F.col("current_limit_inr")) * F.col("utilization") * 12).alias("spend_driver"))
    revenue_rate = a.interchange_rate + a.revolving_rate * a.apr
    points = []
    for name in DIRECTIONAL_ASSUMPTIONS:
        b = getattr(a, name)
        driver = -F.col("loss_driver") if name == "lgd" else F.col("spend_driver") * F.lit(revenue_rate)
        for label, factor in SCENARIO_FACTORS:
            v = min(b * factor, 1.0)
            points.append(F.struct(F.lit(name).alias("assumption"), F.lit(label).alias("scenario"),
                                   F.lit(v).alias("value"),
                                   (F.col("contribution") + F.lit(v - b) * driver).alias("contribution")))
    long = agg.select(F.inline(F.array(*points)))
    from pyspark.sql import Window
    w = Window.partitionBy("assumption")  # 3 rows per partition: bounded
    mx = F.max(F.abs("contribution")).over(w)
    return long.select(
        "assumption", "scenario", "value",
        F.round(F.col("contribution").cast("decimal(38,9)"), 2).cast("double").alias("contribution"),
        F.round(F.greatest(F.lit(2.0), F.abs("contribution") / F.when(mx == 0, 1.0).otherwise(mx) * 100), 6)
         .alias("width"),
        (F.col("contribution") < 0).alias("negative"))


def kill_switch(decisions: DataFrame) -> DataFrame:
    """Governance stop: every increase becomes a manual review at the current limit."""
    inc = F.col("increase_pct") > 0
    reasons = F.array_join("reason_codes", " | ") if dict(decisions.dtypes)["reason_codes"].startswith("array") \
        else F.col("reason_codes")
    return decisions.withColumns({
        "action": F.when(inc, F.lit(policy.MANUAL_REVIEW)).otherwise(F.col("action")),
        "proposed_limit": F.when(inc, F.col("current_limit_inr")).otherwise(F.col("proposed_limit")),
        "proposed_ead": F.when(inc, F.col("current_ead")).otherwise(F.col("proposed_ead")),
        "proposed_expected_loss": F.when(inc, F.col("current_expected_loss")).otherwise(F.col("proposed_expected_loss")),
        "incremental_contribution": F.when(inc, F.lit(0.0)).otherwise(F.col("incremental_contribution")),
        "risk_adjusted_return": F.when(inc, F.lit(0.0)).otherwise(F.col("risk_adjusted_return")),
        "reason_codes": F.when(inc, F.btrim(F.concat(F.coalesce(reasons, F.lit("")),
                                                     F.lit(" | " + policy.R_DISABLED)), F.lit(" |")))
                         .otherwise(reasons),
        "increase_pct": F.when(inc, F.lit(0.0)).otherwise(F.col("increase_pct")),
    })


def exact_summary(decisions: DataFrame) -> DataFrame:
    """Portfolio summary with exact decimal money sums (A1); return guarded by growth."""
    dec = lambda e: F.sum(F.col(e).cast("decimal(38,9)")) if isinstance(e, str) else F.sum(e.cast("decimal(38,9)"))
    g = decisions.agg(
        F.count(F.lit(1)).alias("accounts"),
        *[F.round(dec(c), 2).cast("double").alias(c2) for c, c2 in (
            ("current_limit_inr", "current_limit"), ("proposed_limit", "proposed_limit"),
            ("current_ead", "current_ead"), ("proposed_ead", "proposed_ead"),
            ("current_expected_loss", "current_expected_loss"),
            ("proposed_expected_loss", "proposed_expected_loss"),
            ("incremental_contribution", "incremental_contribution"))],
        dec(F.col("proposed_ead") - F.col("current_ead")).alias("_ie"),
        dec(F.col("incremental_contribution")).alias("_ic"),
        F.sum(F.when(F.col("increase_pct") > 0, 1).otherwise(0)).cast("bigint").alias("eligible_increases"),
        F.sum(F.when(F.col("action").isin(*policy.RESTRICTED_ACTIONS), 1).otherwise(0)).cast("bigint")
         .alias("early_warning"))
    return g.select(
        "*", F.round("_ie", 2).cast("double").alias("incremental_exposure"),
        F.when(F.col("_ie") > 0, F.round(F.col("_ic").cast("double") / F.col("_ie").cast("double"), 6))
         .otherwise(F.lit(0.0)).alias("risk_adjusted_return")).drop("_ie", "_ic")


def scenario_deltas(scored: DataFrame, scenario: PolicyAssumptions, base: PolicyAssumptions | None = None) -> DataFrame:
    """Scenario summary minus baseline summary in one pass (D18): both policies are
    evaluated per row, one aggregate, then unpivoted to (metric, baseline, scenario, change)."""
    base = base or PolicyAssumptions()
    b = policy.with_behavior(scored)
    en = F.lit(True)

    def summary(a):
        P = policy.params(a)
        return let(policy.candidates_expr(P, en), lambda c: let(policy.selected_option(c, en), lambda s: F.struct(
            (s["increase_pct"] > 0).cast("long").alias("eligible_increases"),
            s["proposed_limit"].alias("proposed_limit"),
            s["proposed_expected_loss"].alias("proposed_expected_loss"),
            s["incremental_contribution"].alias("incremental_contribution"))))
    x = b.select(summary(base).alias("b"), summary(scenario).alias("s"))
    metrics = ["proposed_limit", "proposed_expected_loss", "eligible_increases", "incremental_contribution"]
    dec = lambda c: F.round(F.sum(F.col(c).cast("decimal(38,9)")), 2).cast("double")
    agg = x.agg(*[dec(f"b.{m}").alias(f"b_{m}") for m in metrics], *[dec(f"s.{m}").alias(f"s_{m}") for m in metrics])
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"b_{m}").alias("baseline"),
                              F.col(f"s_{m}").alias("scenario")) for m in metrics])
    return agg.select(F.inline(rows)).withColumn("change", F.col("scenario") - F.col("baseline"))
