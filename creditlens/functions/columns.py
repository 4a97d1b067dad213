"""Reusable column expressions.

Everything here returns a ``Column`` built from native Spark functions so that
whole-stage code generation covers it; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference behaviour: risk-band cut points
# (half-open [a, b) intervals) and their labels, lowest first.
RISK_BAND_EDGES = (0.05, 0.15, 0.30)
RISK_BAND_LABELS = ("Low", "Moderate", "High", "Very high")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def risk_band(pd_col) -> Column:
    p = col(pd_col)
    return (F.when(p < RISK_BAND_EDGES[0], RISK_BAND_LABELS[0])
            .when(p < RISK_BAND_EDGES[1], RISK_BAND_LABELS[1])
            .when(p < RISK_BAND_EDGES[2], RISK_BAND_LABELS[2])
            .otherwise(RISK_BAND_LABELS[3]))


def risk_band_rank(band_col) -> Column:
    b = col(band_col)
    expr = F.when(b == RISK_BAND_LABELS[0], 0)
    for i, label in enumerate(RISK_BAND_LABELS[1:], start=1):
        expr = expr.when(b == label, i)
    return expr


def exposure(limit, balance, ccf) -> Column:
    """Drawn balance plus credit-conversion factor times the undrawn line."""
    lim, bal, c = col(limit), col(balance), _lit(ccf)
    drawn = F.least(F.greatest(bal, F.lit(0.0)), lim)
    return drawn + c * F.greatest(lim - drawn, F.lit(0.0))


def clip(c, lower=None, upper=None) -> Column:
    """pandas-style clip: NULL stays NULL (Spark greatest/least skip NULLs)."""
    x = col(c)
    out = x
    if lower is not None:
        out = F.greatest(out, _lit(lower))
    if upper is not None:
        out = F.least(out, _lit(upper))
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(out)


def nan_to_null(c) -> Column:
    x = col(c)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def safe_ratio(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI-safe)."""
    return F.try_divide(col(num), F.nullif(col(den), F.lit(0)))


def hash_uniform(prefix: str, key) -> Column:
    """Deterministic uniform in [0, 1): first 32 bits of md5(prefix || key)."""
    digest = F.md5(F.concat(F.lit(prefix), col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def sample_std(arr) -> Column:
    """Sample standard deviation (ddof=1) of a numeric array column; 0 when n < 2."""
    a = col(arr)
    n = F.size(a).cast("double")
    mean = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x) / n
    ss = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    return F.when(n > 1, F.sqrt(ss / (n - 1))).otherwise(F.lit(0.0))


def array_mean(arr) -> Column:
    a = col(arr)
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x) / F.size(a)


def ordered_distinct_reasons(*conds_and_texts) -> Column:
    """Ordered, de-duplicated string array from (condition, text) pairs."""
    items = [F.when(cond, F.lit(text)) for cond, text in conds_and_texts]
    return F.array_distinct(F.array_compact(F.array(*items)))


def let(value: Column, fn) -> Column:
    """Bind ``value`` once and use it many times inside ``fn`` (a lambda variable).

    ``transform(array(v), x -> f(x))[0]`` keeps the optimizer from inlining a
    large expression into each of its references, which otherwise multiplies
    the expression tree (and planning time) by the number of references.
    """
    return F.transform(F.array(value), fn)[0]


def pad_digits(value: Column, width: int) -> Column:
    """A number's digits, zero-padded to ``width``; longer numbers keep all their digits."""
    text = value.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def dround(c, digits: int = 2) -> Column:
    """Round through an exact DECIMAL(38,9): engine- and order-independent half-up rounding."""
    return F.round(col(c).cast("decimal(38,9)"), digits).cast("double")


def dsum(c, digits: int = 2) -> Column:
    """Exact decimal sum rounded to ``digits`` (deterministic under any partitioning)."""
    return F.round(F.sum(col(c).cast("decimal(38,9)")), digits).cast("double")


def sql_dround(expr: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


def sql_dsum(expr: str, digits: int = 2) -> str:
    return f"CAST(ROUND(SUM(CAST({expr} AS DECIMAL(38,9))), {digits}) AS DOUBLE)"


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` treating NULL keys as equal (a NULL cohort is still a cohort)."""
    if not keys:
        raise ValueError("join_on_keys needs at least one key")
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])
