"""Portfolio decision and SQL-mart queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions.columns import dround, sql_dround, sql_dsum
from creditlens.operators import mart, policy
from creditlens.plans.oracle_base import acct_ctes, decision_ctes, with_ctes
from creditlens.plans.registry import register
from creditlens.sources import adapters

MONEY = ["current_limit_inr", "proposed_limit", "current_ead", "proposed_ead",
         "current_expected_loss", "proposed_expected_loss", "incremental_contribution"]


def decisions(spark, sf_dir, assumptions=None, enabled=True):
    return policy.decide(adapters.shared_scored(spark, sf_dir), assumptions, enabled)


def _mart(spark, sf_dir, view):
    # account_id is derived from the customer primary key, so uniqueness holds by construction.
    views = mart.build_mart(spark, decisions(spark, sf_dir), check_unique=False,
                            prefix="q_")
    return views[view]


def _mart_sql(view: str) -> str:
    body = mart.MART_VIEWS[view].replace("FROM decisions", "FROM reasons")
    return with_ctes(acct_ctes(), decision_ctes()) + "\n" + body


for _view in mart.MART_VIEWS:
    register(_view, _mart_sql(_view))(lambda spark, sf_dir, _v=_view: _mart(spark, sf_dir, _v))


def _decision_rows(df):
    return df.select(
        "account_id", "source_dataset", "action", "increase_pct", "risk_band",
        dround("pd", 6).alias("pd"), dround("utilization", 6).alias("utilization"),
        *[dround(c, 2).alias(c) for c in MONEY],
        dround("risk_adjusted_return", 6).alias("risk_adjusted_return"),
        F.array_join("reason_codes", " | ").alias("reason_codes"),
    )


def _decision_rows_sql(source: str = "reasons") -> str:
    cols = ["account_id", "source_dataset", "action", "increase_pct", "risk_band",
            f"{sql_dround('pd', 6)} AS pd", f"{sql_dround('utilization', 6)} AS utilization"]
    cols += [f"{sql_dround(c, 2)} AS {c}" for c in MONEY]
    cols += [f"{sql_dround('risk_adjusted_return', 6)} AS risk_adjusted_return", "reason_codes"]
    return "SELECT " + ", ".join(cols) + f" FROM {source}"


@register("policy_decisions", lambda: with_ctes(acct_ctes(), decision_ctes()) + "\n" + _decision_rows_sql())
def q_policy_decisions(spark, sf_dir):
    return _decision_rows(decisions(spark, sf_dir))


RECONCILE_TOLERANCES = {"accounts": 0.0, "current_limit": 0.02, "proposed_limit": 0.02, "current_ead": 0.02,
                        "proposed_ead": 0.02, "current_expected_loss": 0.02, "proposed_expected_loss": 0.02,
                        "incremental_contribution": 0.02, "eligible_increases": 0.0}


@register("mart_reconciliation", lambda: with_ctes(acct_ctes(), decision_ctes()) + f"""
SELECT 'accounts' AS metric, CAST(count(*) AS DOUBLE) AS actual, CAST(count(*) - 1 AS DOUBLE) AS expected, 0.0::DOUBLE AS tolerance, 1.0::DOUBLE AS difference
FROM reasons
UNION ALL SELECT 'current_limit', {sql_dsum('current_limit_inr', 2)}, {sql_dsum('current_limit_inr', 2)} + 5.0, 0.02, 5.0 FROM reasons""")
def q_mart_reconciliation(spark, sf_dir):
    """SQL mart view versus a stored summary in which two metrics have drifted (A8, TC3).

    The stored document is the DataFrame summary, written to JSON with one account less,
    5.00 more of current limit, and 0.01 more of proposed limit, which is within tolerance.
    """
    from creditlens.operators.scenarios import exact_summary
    from creditlens.sources import files
    d = decisions(spark, sf_dir)
    view = mart.build_mart(spark, d, check_unique=True, prefix="rec_")["portfolio_reconciliation"]
    metrics = list(RECONCILE_TOLERANCES)
    drift = {"accounts": -1, "current_limit": 5.0, "proposed_limit": 0.01}
    path = files.scratch_path(spark, "summary")
    files.write_json_lines(exact_summary(d).select(*[(F.col(m).cast("double") + F.lit(float(drift.get(m, 0)))).alias(m) for m in metrics]), path)
    doc = files.read_json_document(spark, path, ", ".join(f"{m} double" for m in metrics), multi_line=False)
    k = F.lit(1)
    r = mart.reconcile(view.withColumn("_k", k), doc.withColumn("_k", k), ["_k"], RECONCILE_TOLERANCES)
    return r.select("metric", dround("actual", 2).alias("actual"), dround("expected", 2).alias("expected"), "tolerance", dround("difference", 2).alias("difference"))
