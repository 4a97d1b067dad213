"""Behavioural features from a six-month history row.

All features are native column / higher-order-function arithmetic inside one
projection (whole-stage codegen, no Python).  Index 0 of every array is the
latest month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.functions.columns import array_mean, sample_std

PAY_COLUMNS = ["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]
BILL_COLUMNS = [f"BILL_AMT{i}" for i in range(1, 7)]
PAYMENT_COLUMNS = [f"PAY_AMT{i}" for i in range(1, 7)]
HISTORY_COLUMNS = ["LIMIT_BAL", *PAY_COLUMNS, *BILL_COLUMNS, *PAYMENT_COLUMNS]

# Feature names in output order, and the final clip bound.
FEATURE_NAMES = [
    "limit_bal", "current_utilization", "average_utilization", "maximum_utilization",
    "utilization_trend", "recent_payment_ratio", "average_payment_ratio", "payment_consistency",
    "delinquent_month_count", "maximum_delinquency_severity", "recent_payment_deterioration",
    "revolving_balance_proxy", "limit_headroom", "balance_volatility", "payment_volatility",
    "recent_balance_growth", "inactive_month_count",
]
FEATURE_CLIP = 20.0


def _finite_clip(x: Column, bound: float) -> Column:
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.least(F.greatest(F.when(bad, F.lit(0.0)).otherwise(x), F.lit(-bound)), F.lit(bound))


def _staged_inputs() -> dict[str, Column]:
    """Inputs under private names.

    Features are computed from these in a second projection: an output alias
    such as ``limit_bal`` would otherwise capture a ``LIMIT_BAL`` reference made
    inside a lambda (case-insensitive lateral-alias resolution).
    """
    return {
        "_f_limit": F.greatest(F.col("LIMIT_BAL").cast("double"), F.lit(1.0)),
        "_f_b": F.array(*[F.greatest(F.col(c).cast("double"), F.lit(0.0)) for c in BILL_COLUMNS]),
        "_f_p": F.array(*[F.greatest(F.col(c).cast("double"), F.lit(0.0)) for c in PAYMENT_COLUMNS]),
        "_f_s": F.array(*[F.col(c).cast("double") for c in PAY_COLUMNS]),
    }


def feature_columns(clip_bound: float = FEATURE_CLIP) -> dict[str, Column]:
    """Feature expressions over the staged inputs of ``_staged_inputs``."""
    limit, b, p, s = F.col("_f_limit"), F.col("_f_b"), F.col("_f_p"), F.col("_f_s")
    util = F.transform(b, lambda x: x / limit)
    ratio = F.zip_with(p, b, lambda x, y: x / F.greatest(y, F.lit(1.0)))
    b0, b2, p0, s0 = b[0], b[2], p[0], s[0]
    tail = F.slice(s, 2, 5)
    raw = {
        "limit_bal": limit,
        "current_utilization": util[0],
        "average_utilization": array_mean(util),
        "maximum_utilization": F.array_max(util),
        "utilization_trend": util[0] - util[5],
        "recent_payment_ratio": p0 / F.greatest(b0, F.lit(1.0)),
        "average_payment_ratio": array_mean(ratio),
        "payment_consistency": F.size(F.filter(p, lambda x: x > 0)) / F.lit(6.0),
        "delinquent_month_count": F.size(F.filter(s, lambda x: x > 0)).cast("double"),
        "maximum_delinquency_severity": F.array_max(F.transform(s, lambda x: F.greatest(x, F.lit(0.0)))),
        "recent_payment_deterioration": s0 - array_mean(tail),
        "revolving_balance_proxy": F.greatest(b0 - p0, F.lit(0.0)) / limit,
        "limit_headroom": F.greatest(limit - b0, F.lit(0.0)) / limit,
        "balance_volatility": sample_std(b) / limit,
        "payment_volatility": sample_std(p) / limit,
        "recent_balance_growth": (b0 - b2) / limit,
        "inactive_month_count": F.size(F.filter(b, lambda x: x == 0)).cast("double"),
    }
    return {k: _finite_clip(v, clip_bound) for k, v in raw.items()}


def engineer_features(df: DataFrame, keep: list[str] | None = None,
                      clip_bound: float = FEATURE_CLIP) -> DataFrame:
    """Append (or, with ``keep``, project to keep + ) the 17 behavioural features."""
    base = list(keep if keep is not None else df.columns)
    staged = df.select(*base, *[v.alias(k) for k, v in _staged_inputs().items()])
    cols = feature_columns(clip_bound)
    return staged.select(*base, *[v.alias(k) for k, v in cols.items()])


def history_long(df: DataFrame, key: str = "account_id") -> DataFrame:
    """Wide six-month row -> six rows, oldest first.

    Period labels run M-5 .. M-1 for older months and 'Current' for the latest.
    """
    limit = F.col("current_limit_inr").cast("double")
    months = F.array(*[
        F.struct(
            F.lit(5 - i).alias("position"),
            F.lit("Current" if i == 0 else f"M-{i}").alias("period"),
            F.col(BILL_COLUMNS[i]).cast("double").alias("bill"),
            F.col(PAYMENT_COLUMNS[i]).cast("double").alias("payment"),
            F.when(limit != 0, F.col(BILL_COLUMNS[i]) / limit).otherwise(F.lit(0.0)).alias("utilization"),
            (F.col(PAY_COLUMNS[i]) > 0).cast("int").alias("delinquency"),
        ) for i in range(6)
    ])
    return df.select(key, F.inline(months))
