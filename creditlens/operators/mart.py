"""Portfolio summaries, the SQL decision mart and reconciliation.

Every summary is one hash aggregation with partial (map-side) combine, so the
shuffle carries one row per group per task regardless of portfolio size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.operators.policy import RESTRICTED_ACTIONS

MART_REQUIRED = (
    "account_id", "source_dataset", "action", "increase_pct", "risk_band", "pd", "utilization",
    "current_limit_inr", "proposed_limit", "current_ead", "proposed_ead",
    "current_expected_loss", "proposed_expected_loss", "incremental_contribution",
)

# The mart's views, written as Spark SQL over a temp view named ``decisions``.
MART_VIEWS = {
    "portfolio_reconciliation": """
        SELECT CAST(COUNT(*) AS BIGINT) AS accounts,
               CAST(ROUND(SUM(CAST(current_limit_inr AS DECIMAL(38,9))), 2) AS DOUBLE) AS current_limit,
               CAST(ROUND(SUM(CAST(proposed_limit AS DECIMAL(38,9))), 2) AS DOUBLE) AS proposed_limit,
               CAST(ROUND(SUM(CAST(current_ead AS DECIMAL(38,9))), 2) AS DOUBLE) AS current_ead,
               CAST(ROUND(SUM(CAST(proposed_ead AS DECIMAL(38,9))), 2) AS DOUBLE) AS proposed_ead,
               CAST(ROUND(SUM(CAST(current_expected_loss AS DECIMAL(38,9))), 2) AS DOUBLE) AS current_expected_loss,
               CAST(ROUND(SUM(CAST(proposed_expected_loss AS DECIMAL(38,9))), 2) AS DOUBLE) AS proposed_expected_loss,
               CAST(ROUND(SUM(CAST(incremental_contribution AS DECIMAL(38,9))), 2) AS DOUBLE) AS incremental_contribution,
               CAST(SUM(CASE WHEN increase_pct > 0 THEN 1 ELSE 0 END) AS BIGINT) AS eligible_increases
        FROM decisions""",
    "action_summary": """
        SELECT action, CAST(COUNT(*) AS BIGINT) AS accounts,
               CAST(ROUND(SUM(CAST(proposed_limit - current_limit_inr AS DECIMAL(38,9))), 2) AS DOUBLE) AS incremental_limit,
               CAST(ROUND(SUM(CAST(incremental_contribution AS DECIMAL(38,9))), 2) AS DOUBLE) AS simulated_contribution
        FROM decisions GROUP BY action""",
    "source_risk_summary": """
        SELECT source_dataset, CAST(COUNT(*) AS BIGINT) AS accounts,
               ROUND(AVG(pd), 6) AS mean_score,
               ROUND(AVG(utilization), 6) AS mean_utilization,
               CAST(ROUND(SUM(CAST(proposed_ead AS DECIMAL(38,9))), 2) AS DOUBLE) AS proposed_ead,
               CAST(ROUND(SUM(CAST(proposed_expected_loss AS DECIMAL(38,9))), 2) AS DOUBLE) AS proposed_loss_proxy
        FROM decisions GROUP BY source_dataset""",
    "risk_band_summary": """
        SELECT risk_band, CAST(COUNT(*) AS BIGINT) AS accounts,
               CAST(ROUND(SUM(CAST(proposed_ead AS DECIMAL(38,9))), 2) AS DOUBLE) AS proposed_ead,
               CAST(ROUND(SUM(CAST(proposed_expected_loss AS DECIMAL(38,9))), 2) AS DOUBLE) AS proposed_loss_proxy
        FROM decisions GROUP BY risk_band""",
}
# Allow-listed (view, sort key) pairs for reading the mart.
VIEW_ORDER = {
    ("portfolio_reconciliation", "accounts"): "accounts",
    ("action_summary", "action"): "action",
    ("source_risk_summary", "source_dataset"): "source_dataset",
    ("risk_band_summary", "risk_band"): "risk_band",
}


def require_columns(df: DataFrame, required) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"input lacks: {', '.join(missing)}")
    return df.select(*required)


def build_mart(spark: SparkSession, decisions: DataFrame, check_unique: bool = True,
               prefix: str = "") -> dict[str, DataFrame]:
    """Register ``decisions`` and the four mart views; return them as DataFrames."""
    d = require_columns(decisions, MART_REQUIRED)
    if check_unique:
        dup = d.groupBy("account_id").count().filter("count > 1").limit(1).count()
        if dup:
            raise ValueError("Portfolio must contain unique account IDs")
    d.createOrReplaceTempView(f"{prefix}decisions")
    out = {}
    for name, sql in MART_VIEWS.items():
        view = f"{prefix}{name}"
        spark.sql(f"CREATE OR REPLACE TEMP VIEW {view} AS " +
                  sql.replace("FROM decisions", f"FROM {prefix}decisions"))
        out[name] = spark.table(view)
    return out


def read_view(spark: SparkSession, view: str, order_by: str, prefix: str = "") -> DataFrame:
    key = VIEW_ORDER.get((view, order_by))
    if key is None:
        raise ValueError("no such mart view, or it has no such sort key")
    return spark.table(f"{prefix}{view}").orderBy(key)


def summarize(decisions: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """Portfolio summary (A1) as one aggregate; ratio guarded by zero exposure."""
    incr_exposure = F.sum(F.col("proposed_ead") - F.col("current_ead"))
    contribution = F.sum("incremental_contribution")
    aggs = [
        F.count(F.lit(1)).alias("accounts"),
        F.sum("current_limit_inr").alias("current_limit"),
        F.sum("proposed_limit").alias("proposed_limit"),
        F.sum("current_ead").alias("current_ead"),
        F.sum("proposed_ead").alias("proposed_ead"),
        F.sum("current_expected_loss").alias("current_expected_loss"),
        F.sum("proposed_expected_loss").alias("proposed_expected_loss"),
        contribution.alias("incremental_contribution"),
        incr_exposure.alias("incremental_exposure"),
        F.sum(F.when(F.col("increase_pct") > 0, 1).otherwise(0)).cast("bigint").alias("eligible_increases"),
        F.sum(F.when(F.col("action").isin(*RESTRICTED_ACTIONS), 1).otherwise(0)).cast("bigint")
         .alias("early_warning"),
    ]
    g = decisions.groupBy(*(group_cols or [])).agg(*aggs)
    return g.withColumn(
        "risk_adjusted_return",
        F.when(F.col("incremental_exposure") != 0,
               F.col("incremental_contribution") / F.col("incremental_exposure")).otherwise(F.lit(0.0)))


def value_counts(df: DataFrame, column: str, name: str = "accounts") -> DataFrame:
    """Hash count per value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def reconcile(actual: DataFrame, expected: DataFrame, keys: list[str],
              tolerances: dict[str, float]) -> DataFrame:
    """Compare two aggregates metric by metric.

    Both sides are unpivoted to (keys, metric, value) and full-outer-joined;
    rows whose absolute difference exceeds the metric's tolerance (or which exist
    on one side only) are returned.  An empty result means reconciled.
    """
    metrics = list(tolerances)

    def long(df, name):
        return df.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
            keys, metrics, "metric", name)

    a, e = long(actual, "actual"), long(expected, "expected")
    tol = F.create_map(*[x for m, t in tolerances.items() for x in (F.lit(m), F.lit(float(t)))])
    j = a.join(e, [*keys, "metric"], "full_outer")
    return (j.withColumn("tolerance", tol[F.col("metric")])
             .withColumn("difference", F.abs(F.col("actual") - F.col("expected")))
             .filter(F.col("actual").isNull() | F.col("expected").isNull()
                     | (F.col("difference") > F.col("tolerance"))))
