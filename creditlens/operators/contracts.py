"""Contract validation as rule tables.

Each rule is a boolean Column that is TRUE when a row violates it; the
validator emits one (key, rule) row per violation instead of stopping at the
first, so a whole table is checked in one narrow pass.  ``strict`` raises on
the first violation found (for boundary checks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Harmonized region domain and the per-field ranges (checked only when supplied).
REGION_CATEGORIES = ("asia", "europe", "north_america", "taiwan", "undisclosed")
FIELD_BOUNDS = {
    "delinquency_count": (0, 100),
    "utilization": (0, 5),
    "debt_to_income": (0, 1),
    "credit_lines": (0, 500),
    "income_inr": (0, 1_000_000_000),
    "credit_age_months": (0, 2_000),
}
MAX_LIMIT = 10_000_000
MODEL_INPUT_COLUMNS = ["delinquency_count", "utilization", "debt_to_income", "credit_lines",
                       "income_inr", "credit_age_months", "region"]
EXPOSURE_COLUMNS = ["current_limit_inr", "current_balance_inr"]
ID_PATTERN = r"^[A-Za-z0-9][A-Za-z0-9_-]{2,39}$"
SURROGATE_SALT = "creditlens-v1|"  # salt of the anonymised surrogate id (configurable)


class SchemaError(ValueError):
    pass


def require(df: DataFrame, columns) -> DataFrame:
    """Required-column check + projection; error lists the sorted missing names."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise SchemaError(f"input lacks: {', '.join(missing)}")
    return df.select(*columns)


def not_finite(c: Column) -> Column:
    return F.isnan(c) | (F.abs(c) == float("inf"))


def harmonized_rules(key: str = "account_id") -> dict[str, Column]:
    """Rules of the harmonized profile + exposure contract."""
    rules: dict[str, Column] = {
        "id_blank": F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) == "",
        "id_pattern": ~F.coalesce(F.trim(F.col(key).cast("string")).rlike(ID_PATTERN), F.lit(False)),
    }
    numeric = [c for c in MODEL_INPUT_COLUMNS if c != "region"] + EXPOSURE_COLUMNS
    for c in numeric:
        raw = F.col(c)
        rules[f"{c}_not_numeric"] = raw.isNotNull() & raw.cast("string").try_cast("double").isNull()
        rules[f"{c}_not_finite"] = F.coalesce(not_finite(raw.cast("string").try_cast("double")), F.lit(False))
    rules["region_domain"] = ~F.coalesce(F.lower(F.trim(F.col("region"))).isin(*REGION_CATEGORIES), F.lit(False))
    lim = F.col("current_limit_inr").cast("string").try_cast("double")
    bal = F.col("current_balance_inr").cast("string").try_cast("double")
    rules["exposure_blank"] = lim.isNull() | bal.isNull()
    rules["limit_range"] = F.coalesce((lim <= 0) | (lim > MAX_LIMIT), F.lit(False))
    rules["balance_range"] = F.coalesce((bal < 0) | (bal > lim * 2), F.lit(False))
    for c, (lo, hi) in FIELD_BOUNDS.items():
        v = F.col(c).cast("string").try_cast("double")
        rules[f"{c}_range"] = F.coalesce((v < lo) | (v > hi), F.lit(False))
    return rules


def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """One (key, rule) row per violated rule; empty means the table passes."""
    flags = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    return df.select(key, F.explode(flags).alias("rule"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count (partial aggregation absorbs hot keys)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def contract_violations(df: DataFrame, key: str = "account_id") -> DataFrame:
    """Row rules plus the uniqueness rule (duplicates reported once per key)."""
    rows = violations(df, key, harmonized_rules(key))
    trimmed = df.withColumn(key, F.trim(F.col(key).cast("string")))
    dups = duplicate_keys(trimmed, key).select(key, F.lit("id_duplicate").alias("rule"))
    return rows.unionByName(dups)


def strict(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """Raise on the first violation (boundary mode); otherwise return ``df``."""
    first = violations(df, key, rules).limit(1).collect()
    if first:
        raise SchemaError(f"Contract violation: {first[0]['rule']} for {first[0][key]}")
    return df


def missing_fields(columns: list[str]) -> Column:
    """' | '-joined names of the NULL columns of a row."""
    return F.array_join(F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])), " | ")


def surrogate_id(key, salt: str = SURROGATE_SALT) -> Column:
    """'ACC-' + upper(first 10 hex of sha256(salt + id))."""
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit("ACC-"), F.upper(F.substring(F.sha2(F.concat(F.lit(salt), k.cast("string")), 256), 1, 10)))


PAY_COLUMNS = ["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]
PAYMENT_COLUMNS = [f"PAY_AMT{i}" for i in range(1, 7)]


def clean_report(df: DataFrame, key: str, target: str, numeric: list[str], order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Keep-first de-duplication, invalid-row removal and a one-row quality report (P5).

    The first row of a key is the least by ``order`` (columns that tell when a row was loaded),
    then by all columns; without ``order`` by all columns.  The least is taken map-side, so a
    key with many copies costs one row per task.  Duplicates are counted before
    de-duplication, invalid rows after it.  Returns (clean rows, report).
    """
    lead = list(order or [])
    src = df
    first = df.groupBy(key).agg(F.min(F.struct(*lead, *[F.col(c) for c in df.columns if c != key and c not in lead])).alias("_r"))
    dedup = first.select(key, "_r.*").select(*df.columns)
    invalid_status = F.exists(F.array(*[F.col(c) for c in PAY_COLUMNS]), lambda x: (x < -2) | (x > 9))
    invalid_amount = F.exists(F.array(*[F.col(c) for c in PAYMENT_COLUMNS]), lambda x: x < 0)
    any_missing = F.exists(F.array(*[F.col(c).cast("double") for c in numeric]), lambda x: x.isNull())
    bad_limit = F.col("LIMIT_BAL") <= 0
    bad_target = ~F.col(target).isin(0, 1) | F.col(target).isNull()
    invalid = any_missing | F.coalesce(bad_limit, F.lit(False)) | bad_target | \
        F.coalesce(invalid_status, F.lit(False)) | F.coalesce(invalid_amount, F.lit(False))
    before = src.agg(F.count(F.lit(1)).alias("source_rows"),
                     (F.count(F.lit(1)) - F.countDistinct(key)).alias("duplicate_ids"))
    exact = src.distinct().agg(F.count(F.lit(1)).alias("_distinct_rows"))
    after = dedup.agg(
        F.sum(sum(F.col(c).isNull().cast("long") for c in numeric)).alias("missing_cells"),
        F.sum(F.coalesce(bad_limit, F.lit(False)).cast("long")).alias("invalid_limit_rows"),
        F.sum(bad_target.cast("long")).alias("invalid_target_rows"),
        F.sum(F.coalesce(invalid_status, F.lit(False)).cast("long")).alias("invalid_payment_status_rows"),
        F.sum(F.coalesce(invalid_amount, F.lit(False)).cast("long")).alias("invalid_payment_amount_rows"),
        F.sum((~invalid).cast("long")).alias("clean_rows"),
        F.avg(F.when(~invalid, F.col(target).cast("double"))).alias("target_rate"))
    k = F.lit(1)
    rep = (before.withColumn("_k", k).join(exact.withColumn("_k", k), "_k").join(after.withColumn("_k", k), "_k")
           .select("source_rows", "clean_rows", (F.col("source_rows") - F.col("clean_rows")).alias("removed_rows"),
                   "duplicate_ids", (F.col("source_rows") - F.col("_distinct_rows")).alias("exact_duplicates"),
                   "missing_cells", "invalid_limit_rows", "invalid_target_rows", "invalid_payment_status_rows",
                   "invalid_payment_amount_rows", "target_rate"))
    return dedup.filter(~invalid), rep


# Readiness contract fields, prohibited identifiers and evidence age bounds.
READINESS_REQUIRED = (
    "customer_reference", "as_of_date", "consent_reference", "consent_timestamp", "bureau_report_date",
    "bureau_dpd_30_12m", "bureau_dpd_90_24m", "open_trades", "total_monthly_obligation_inr",
    "verified_monthly_income_inr", "income_verified_at", "current_limit_inr", "current_balance_inr",
    "statement_months", "data_lineage_id",
)
PROHIBITED_IDENTIFIERS = ("name", "pan", "aadhaar", "phone", "email", "address")
READINESS_NUMERIC = ("bureau_dpd_30_12m", "bureau_dpd_90_24m", "open_trades", "total_monthly_obligation_inr",
                     "verified_monthly_income_inr", "current_limit_inr", "current_balance_inr", "statement_months")
READINESS_TIMESTAMPS = ("as_of_date", "consent_timestamp", "bureau_report_date", "income_verified_at")
BUREAU_MAX_DAYS = 30
INCOME_MAX_DAYS = 90
MIN_STATEMENT_MONTHS = 6
OFFSET_PATTERN = r"(Z|[+-]\d{2}:\d{2})$"


def _instant(c: str) -> Column:
    """Epoch seconds, with their fraction, of an ISO timestamp that carries an offset (NULL otherwise)."""
    s = F.trim(F.col(c))
    fraction = F.coalesce(F.expr("try_cast(nullif(regexp_extract(trim(" + c + r"), '(\\.[0-9]+)(Z|[+-][0-9]{2}:[0-9]{2})$', 1), '') as double)"), F.lit(0.0))
    whole = F.regexp_replace(s, r"\.[0-9]+(Z|[+-][0-9]{2}:[0-9]{2})$", "$1")
    return F.when(s.rlike(OFFSET_PATTERN), F.unix_timestamp(F.try_to_timestamp(whole, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))) + fraction)


def readiness_rules(df: DataFrame) -> dict[str, Column]:
    """Readiness contract as rules (P8); prohibited identifier columns fail every row."""
    rules: dict[str, Column] = {}
    for f in READINESS_REQUIRED:
        rules[f"missing_{f}"] = F.col(f).isNull() | (F.trim(F.col(f).cast("string")) == "")
    bad_cols = sorted(set(PROHIBITED_IDENTIFIERS) & set(df.columns))
    rules["prohibited_identifier"] = F.lit(bool(bad_cols))
    rules["timezone_missing"] = F.exists(F.array(*[F.col(c) for c in READINESS_TIMESTAMPS]),
                                         lambda x: ~F.coalesce(x.rlike(OFFSET_PATTERN), F.lit(False)))
    rules["timestamp_unparseable"] = F.lit(False)
    for c in READINESS_TIMESTAMPS:  # an offset, and yet no instant: no rule below could judge it
        rules["timestamp_unparseable"] |= F.trim(F.col(c)).rlike(OFFSET_PATTERN) & _instant(c).isNull()
    asof = _instant("as_of_date")
    cons, bur, inc = _instant("consent_timestamp"), _instant("bureau_report_date"), _instant("income_verified_at")
    rules["evidence_after_decision"] = F.exists(F.array(cons > asof, bur > asof, inc > asof), lambda x: F.coalesce(x, F.lit(False)))
    rules["bureau_stale"] = F.coalesce(asof - bur > BUREAU_MAX_DAYS * 86400, F.lit(False))
    rules["income_stale"] = F.coalesce(asof - inc > INCOME_MAX_DAYS * 86400, F.lit(False))
    rules["negative_numeric"] = F.exists(F.array(*[F.col(c) for c in READINESS_NUMERIC]), lambda x: x < 0)
    rules["nonpositive_income_or_limit"] = (F.col("verified_monthly_income_inr") <= 0) | (F.col("current_limit_inr") <= 0)
    rules["balance_above_bound"] = F.col("current_balance_inr") > F.col("current_limit_inr") * 2
    rules["short_history"] = F.col("statement_months") < MIN_STATEMENT_MONTHS
    return {k: F.coalesce(v, F.lit(False)) for k, v in rules.items()}


def readiness(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(violations(customer_reference, rule), derived controls of the passing rows)."""
    rules = readiness_rules(df)
    v = violations(df, "customer_reference", rules)
    known = F.forall(F.array(*[_instant(c) for c in READINESS_TIMESTAMPS]), lambda x: x.isNotNull())
    ok = df.filter(~F.exists(F.array(*rules.values()), lambda x: x) & known)
    asof = _instant("as_of_date")
    derived = ok.select(
        "customer_reference", "data_lineage_id", "consent_reference",
        (F.col("total_monthly_obligation_inr") / F.col("verified_monthly_income_inr")).alias("foir_proxy"),
        (F.col("current_balance_inr") / F.col("current_limit_inr")).alias("utilization"),
        F.floor((asof - _instant("bureau_report_date")) / 86400).cast("int").alias("bureau_age_days"),
        F.floor((asof - _instant("income_verified_at")) / 86400).cast("int").alias("income_age_days"))
    return v, derived


HISTORY_BILLS = [f"BILL_AMT{i}" for i in range(1, 7)]


def behavioral_rules(key: str = "ACCOUNT_ID") -> dict[str, Column]:
    """Six-month history + exposure contract (P3, P4): finite numerics, no blanks, limit > 0,
    repayment status in [-2, 9], payments >= 0, exposure bounds."""
    hist = ["LIMIT_BAL", *PAY_COLUMNS, *HISTORY_BILLS, *PAYMENT_COLUMNS]
    v = lambda c: F.col(c).cast("string").try_cast("double")
    rules: dict[str, Column] = {
        "id_blank": F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) == "",
        "history_blank_or_not_numeric": F.exists(F.array(*[v(c) for c in hist]), lambda x: x.isNull()),
        "history_not_finite": F.exists(F.array(*[v(c) for c in hist]), lambda x: F.isnan(x) | (F.abs(x) == float("inf"))),
        "limit_not_positive": v("LIMIT_BAL") <= 0,
        "repayment_status_range": F.exists(F.array(*[v(c) for c in PAY_COLUMNS]), lambda x: (x < -2) | (x > 9)),
        "payment_negative": F.exists(F.array(*[v(c) for c in PAYMENT_COLUMNS]), lambda x: x < 0),
        "exposure_blank": v("current_limit_inr").isNull() | v("current_balance_inr").isNull(),
        "exposure_not_finite": F.exists(F.array(*[v(c) for c in EXPOSURE_COLUMNS]), lambda x: F.isnan(x) | (F.abs(x) == float("inf"))),
        "limit_range": (v("current_limit_inr") <= 0) | (v("current_limit_inr") > MAX_LIMIT),
        "balance_range": (v("current_balance_inr") < 0) | (v("current_balance_inr") > v("current_limit_inr") * 2),
    }
    return {k: F.coalesce(c, F.lit(False)) for k, c in rules.items()}


def behavioral_violations(df: DataFrame, key: str = "ACCOUNT_ID") -> DataFrame:
    """(key, rule) rows of the six-month and exposure contracts, and ``id_duplicate`` once for each repeated trimmed id."""
    dups = duplicate_keys(df.withColumn(key, F.trim(F.col(key).cast("string"))).filter(F.coalesce(F.col(key), F.lit("")) != ""), key)
    return violations(df, key, behavioral_rules(key)).unionByName(dups.select(key, F.lit("id_duplicate").alias("rule")))


def row_guards(df: DataFrame, label: str, group_cols: list[str], min_rows: int = 100) -> DataFrame:
    """Rows and classes of each group, and the guard that it fails: ``too_few_rows``, ``one_class`` or NULL.

    Rows without a label count as rows and belong to no class.
    """
    r = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("rows"), F.size(F.collect_set(label)).cast("bigint").alias("classes"))  # a label has few values
    return r.withColumn("guard", F.when(F.col("rows") < min_rows, "too_few_rows").when(F.col("classes") < 2, "one_class"))


def require_rows(df: DataFrame, min_rows: int = 100, label: str | None = None) -> DataFrame:
    """Row-count and class guard before training or evaluation (P17): one small aggregate."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if label:
        aggs.append(F.countDistinct(label).alias("k"))
    r = df.agg(*aggs).first()
    if r["n"] < min_rows:
        raise ValueError(f"At least {min_rows} rows are required, found {r['n']}")
    if label and r["k"] < 2:
        raise ValueError("Both outcome classes are required")
    return df
