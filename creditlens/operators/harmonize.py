"""Harmonization of differently coded sources into one schema.

A harmonizer is a ``DataFrame -> DataFrame`` projection to the target schema;
the registry maps source names to harmonizers.  The union is ``unionByName``
with a source tag; provenance and missingness are grouped aggregates by source.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.functions.columns import clip
from creditlens.operators.contracts import REGION_CATEGORIES

# The harmonized target schema (features, then the target).
FEATURES = ["delinquency_count", "utilization", "debt_to_income", "credit_lines", "income_inr",
            "credit_age_months", "region"]
TARGET = "default"
HARMONIZED = ["source_key", *FEATURES, TARGET]
NUMERIC_FEATURES = FEATURES[:-1]

HARMONIZERS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def harmonizer(name: str):
    def deco(fn):
        HARMONIZERS[name] = fn
        return fn
    return deco


def _typed(cols: dict[str, Column]) -> list[Column]:
    out = []
    for c in HARMONIZED:
        v = cols.get(c, F.lit(None))
        t = "string" if c in ("source_key", "region") else ("int" if c == TARGET else "double")
        out.append(v.cast(t).alias(c))
    return out


@harmonizer("card_history")
def card_history(df: DataFrame) -> DataFrame:
    """Six-month card history: delinquency count and clipped utilisation; other fields unknown (H1)."""
    return df.select(*_typed({
        "source_key": F.col("account_id"),
        "delinquency_count": F.col("delinquency_count"),
        "utilization": clip(F.col("BILL_AMT1") / F.greatest(F.col("LIMIT_BAL"), F.lit(1.0)), 0.0, 5.0),
        "region": F.col("region"),
        TARGET: F.col("y"),
    }))


@harmonizer("supplier_ledger")
def supplier_ledger(df: DataFrame) -> DataFrame:
    """Special-value source: negative balances are 'unknown' codes, label Bad/Good -> 1/0 (H5)."""
    bal = F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal"))
    label = F.when(F.col("s_acctbal") < 0, F.lit("Bad")).otherwise(F.lit("Good"))
    return df.select(*_typed({
        "source_key": F.concat(F.lit("SUPP-"), F.col("s_suppkey").cast("string")),
        "utilization": clip(bal / 10000.0, 0.0, 5.0),
        "income_inr": bal * 83.0,
        "region": F.col("region"),
        TARGET: F.when(label == "Bad", 1).otherwise(0),
    }))


LOAN_TERMINAL = ("F", "O")
LOAN_BAD = ("F",)
PORTFOLIO_START = "1995-01-01"


@harmonizer("order_loans")
def order_loans(df: DataFrame) -> DataFrame:
    """Loan source: terminal statuses only, bad-status target, clipped ratios, credit age (H6)."""
    kept = df.filter(F.col("o_orderstatus").isin(*LOAN_TERMINAL))
    age = F.datediff(F.to_date("o_orderdate"), F.lit(PORTFOLIO_START).cast("date")) / 30.44
    return kept.select(*_typed({
        "source_key": F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string")),
        "utilization": clip(F.col("o_totalprice") / 500000.0, 0.0, 5.0),
        "debt_to_income": clip(F.col("o_totalprice") / 1000000.0, 0.0, 1.0),
        "income_inr": F.col("o_totalprice") * 2.97,
        "credit_age_months": clip(age, 0.0),
        "region": F.col("region"),
        TARGET: F.col("o_orderstatus").isin(*LOAN_BAD).cast("int"),
    }))


def union_sources(sources: dict[str, DataFrame], reference_only: tuple[str, ...] = ()) -> DataFrame:
    """Union of harmonized sources with a ``market`` tag; reference-only sources excluded (H8)."""
    parts = [HARMONIZERS[name](df).withColumn("market", F.lit(name))
             for name, df in sources.items() if name not in reference_only]
    u = reduce(lambda a, b: a.unionByName(b), parts)
    bad = ~F.col(TARGET).isin(0, 1) | ~F.coalesce(F.col("region").isin(*REGION_CATEGORIES), F.lit(False))
    return u.withColumn("domain_ok", ~F.coalesce(bad, F.lit(True)))


def provenance(sources: dict[str, DataFrame], reference_only: tuple[str, ...] = ()) -> DataFrame:
    """Per source: rows, rows in the union (0 if reference-only), risk rate, null rate per feature (H9)."""
    parts = [HARMONIZERS[name](df).withColumn("market", F.lit(name))
             .withColumn("in_union", F.lit(0 if name in reference_only else 1))
             for name, df in sources.items()]
    u = reduce(lambda a, b: a.unionByName(b), parts)
    return u.groupBy("market").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("in_union").cast("bigint").alias("rows_in_union"),
        F.avg(F.col(TARGET).cast("double")).alias("risk_rate"),
        *[F.avg(F.col(c).isNull().cast("double")).alias(f"null_{c}") for c in NUMERIC_FEATURES])


def missingness(union: DataFrame, group: str = "market") -> DataFrame:
    """Missing-rate matrix: (source, feature, missing_rate)."""
    wide = union.groupBy(group).agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in NUMERIC_FEATURES])
    return wide.unpivot([group], NUMERIC_FEATURES, "feature", "missing_rate")


def column_medians(df: DataFrame, columns: list[str], group_cols=None) -> DataFrame:
    """(group, column, median) of every column that has a value; NULL and NaN are left out.

    One histogram of (group, column, value) serves any number of columns; exact order
    statistics of it follow.
    """
    from creditlens.operators import evaluate as ev
    from creditlens.session import cut_lineage
    g = list(group_cols or [])
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("score")) for c in columns]))
    h = df.select(*g, cells).filter(F.col("score").isNotNull() & ~F.isnan("score")).groupBy(*g, "column", "score").agg(
        F.lit(0.0).alias("pos"), F.count(F.lit(1)).cast("double").alias("neg"))
    own = [*g, "column"]
    return ev.order_statistics(ev.running_counts(cut_lineage(h), own), [0.5], own).withColumnRenamed("q0", "median")


def median_impute(df: DataFrame, columns: list[str], group_cols=None, indicators: bool = True) -> DataFrame:
    """Exact (interpolated) median imputation with optional missing indicators.

    All columns share one histogram and, with groups, one join.  A group without any value of
    a column keeps its NULLs.
    """
    from creditlens.functions.columns import join_on_keys
    g, out = list(group_cols or []), df
    med = column_medians(df, columns, g)
    if g:
        out = join_on_keys(out, med.groupBy(*g).agg(*[F.max(F.when(F.col("column") == c, F.col("median"))).alias(f"_med_{c}") for c in columns]), g, "left")
    else:
        found = {r["column"]: r["median"] for r in med.collect()}  # a row per column
        out = out.withColumns({f"_med_{c}": F.lit(found.get(c)).cast("double") for c in columns})
    if indicators:
        out = out.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in columns})
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_med_{c}")) for c in columns}).drop(*[f"_med_{c}" for c in columns])


# ---- helper patterns of the coded-source harmonizers (H2-H4, H7, H13) ----

def code_map(c: Column, mapping: dict) -> Column:
    """Lookup of coded values through a literal map (unknown codes -> NULL) (H2, H3)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return m[c]


def placeholder_null(c: Column, threshold: float) -> Column:
    """Values at or above a placeholder threshold mean 'unknown' (H4)."""
    return F.when(c < threshold, c)


def sum_min_count(cols: list[Column]) -> Column:
    """Row sum ignoring NULLs, but NULL when every input is NULL (pandas min_count=1) (H4)."""
    total = sum(F.coalesce(c, F.lit(0.0)) for c in cols)
    return F.when(F.coalesce(*cols).isNull(), F.lit(None).cast("double")).otherwise(total)


def ratio_clip(num: Column, den: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    """num / max(den, 1) clipped to [lo, hi], NULL-preserving (H7)."""
    return clip(num / F.greatest(den, F.lit(1.0)), lo, hi)


def one_hot(df: DataFrame, columns: list[str], numeric: list[str] | None = None, max_levels: int = 1000) -> DataFrame:
    """Dense dummies ``{column}_{value}`` for the listed categorical columns.

    The levels of each column (a bounded set, checked against ``max_levels``) are
    the only values brought to the driver.
    """
    out = df
    for c in columns:
        levels = [r[0] for r in df.select(c).distinct().limit(max_levels + 1).collect()]
        if len(levels) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} levels")
        for v in sorted(x for x in levels if x is not None):
            out = out.withColumn(f"{c}_{v}", (F.col(c) == F.lit(v)).cast("int"))
    return out


# Coded-source maps (installment-rate code -> share of income; placeholder bound).
INSTALLMENT_RATE = {1: 0.35, 2: 0.30, 3: 0.225, 4: 0.125}
PLACEHOLDER_AT = 45


@harmonizer("coded_parts")
def coded_parts(df: DataFrame) -> DataFrame:
    """Coded legacy source (H2-H4, H7): placeholder codes -> NULL, min_count sums,
    a code map for the installment rate, a clipped ratio and a code-set target."""
    size = placeholder_null(F.col("p_size").cast("double"), PLACEHOLDER_AT)
    brand_digit = F.substring(F.col("p_brand"), -1, 1).cast("int")
    return df.select(*_typed({
        "source_key": F.concat(F.lit("PART-"), F.col("p_partkey").cast("string")),
        "delinquency_count": sum_min_count([size / 10.0, F.lit(None).cast("double")]),
        "debt_to_income": code_map(brand_digit, INSTALLMENT_RATE),
        "utilization": ratio_clip(F.col("p_retailprice"), F.lit(1000.0), 0.0, 5.0),
        "region": F.lit("undisclosed"),
        TARGET: F.col("p_type").startswith("PROMO").cast("int"),
    }))
