"""Portfolio explorer: filters, allow-listed sorting, pagination, search (P10, P15, S1-S3, IO12)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.functions.columns import risk_band_rank

PAGE_SIZE = 25
SEARCH_LIMIT = 8
# Utilisation bands (half-open) and the sortable columns.
UTILIZATION_BANDS = {"low": (0.0, 0.3), "moderate": (0.3, 0.6), "high": (0.6, 0.9), "very_high": (0.9, None)}
SORTABLE = ("account_id", "pd", "risk_band", "action", "utilization", "current_limit_inr", "proposed_limit",
            "incremental_contribution")
FORMULA_PREFIXES = ("=", "+", "-", "@")


def display_utilization(df: DataFrame) -> Column:
    """Reported utilisation, else balance / limit, clipped to [0, 1.2] for display."""
    u = F.coalesce(F.col("utilization"), F.col("current_balance_inr") / F.col("current_limit_inr"))
    return F.least(F.greatest(u, F.lit(0.0)), F.lit(1.2))


def filter_portfolio(df: DataFrame, search: str = "", risk: str = "", action: str = "",
                     delinquency: str = "", utilization_band: str = "") -> DataFrame:
    """Composable filters; search is a literal, case-insensitive substring match (never a regex)."""
    out = df
    if search.strip():
        out = out.filter(F.contains(F.lower(F.col("account_id")), F.lit(search.strip().lower())))
    if risk:
        out = out.filter(F.col("risk_band") == risk)
    if action:
        out = out.filter(F.col("action") == action)
    if delinquency == "yes":
        out = out.filter(F.col("delinquency_count") > 0)
    elif delinquency == "no":
        out = out.filter(F.col("delinquency_count") == 0)
    elif delinquency == "unknown":
        out = out.filter(F.col("delinquency_count").isNull())
    if utilization_band in UTILIZATION_BANDS:
        lo, hi = UTILIZATION_BANDS[utilization_band]
        u = F.col("utilization")
        out = out.filter((u >= lo) & (u < hi) if hi is not None else (u >= lo))
    return out


def sort_portfolio(df: DataFrame, sort: str = "pd", direction: str = "desc") -> DataFrame:
    """Allow-listed sort (unknown key -> pd); NULLs last both ways; risk band by severity; id tie-break."""
    key = sort if sort in SORTABLE else "pd"
    c = risk_band_rank(F.col("risk_band")) if key == "risk_band" else F.col(key)
    primary = c.desc_nulls_last() if direction == "desc" else c.asc_nulls_last()
    return df.orderBy(primary, F.asc("account_id"))


def page(df: DataFrame, page_no: int, total_rows: int, size: int = PAGE_SIZE) -> DataFrame:
    """Page clamped to [1, ceil(n / size)] (1 if empty) of an already sorted frame."""
    pages = max(1, math.ceil(total_rows / size))
    p = min(max(int(page_no), 1), pages)
    return df.offset((p - 1) * size).limit(size).withColumn("page", F.lit(p))


def search(df: DataFrame, query: str, limit: int = SEARCH_LIMIT) -> DataFrame:
    """First ``limit`` literal matches in key order (S3)."""
    return filter_portfolio(df, search=query).orderBy("account_id").limit(limit)


def safe_csv(df: DataFrame) -> DataFrame:
    """Prefix string cells that a spreadsheet would read as a formula with a quote (IO12)."""
    cols = []
    for name, dtype in df.dtypes:
        if dtype == "string":
            c = F.col(name)
            risky = F.substring(c, 1, 1).isin(*FORMULA_PREFIXES)
            cols.append(F.when(risky, F.concat(F.lit("'"), c)).otherwise(c).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    """Lookup by key (P11); an unknown key is an error rather than an empty answer."""
    hit = df.filter(F.col(key) == F.lit(value))
    if hit.limit(1).count() == 0:
        raise KeyError(f"Unknown {key}: {value}")
    return hit


def top_k(df: DataFrame, order: list, k: int = 12) -> DataFrame:
    """Sorted evidence, first ``k`` rows (S4): a bounded top-k (per-task heaps, then merge)."""
    return df.orderBy(*order).limit(k)


def localise(df: DataFrame, money_cols: list[str], currency: str, rates: dict, default: float = 1.0) -> DataFrame:
    """Convert money columns with a literal rate map; an unknown code falls back to ``default``."""
    rate_map = F.create_map(*[x for k, v in rates.items() for x in (F.lit(k), F.lit(float(v)))])
    rate = F.coalesce(rate_map[F.lit(currency)], F.lit(float(default)))
    return df.withColumns({c: F.col(c) * rate for c in money_cols})
