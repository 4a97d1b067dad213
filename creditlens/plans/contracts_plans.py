"""Contract, cleaning and identifier queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions.columns import dround, sql_dround
from creditlens.operators import contracts as ct
from creditlens.plans.oracle_base import acct_ctes, with_ctes
from creditlens.plans.registry import register
from creditlens.sources import adapters

RAW_SQL = """,
rawp AS (
  SELECT s.account_id, s.delinquency_count, s.BILL_AMT1 / s.LIMIT_BAL AS utilization, s.debt_to_income,
         s.credit_lines, s.income_inr, s.credit_age_months, lower(trim(r.r_name)) AS region,
         s.current_limit_inr, s.BILL_AMT1 AS current_balance_inr
  FROM scored_y s LEFT JOIN nation n ON s.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def _violations_sql() -> str:
    rules = [
        ("id_blank", "coalesce(trim(account_id), '') = ''"),
        ("id_pattern", "NOT coalesce(regexp_full_match(trim(account_id), '^[A-Za-z0-9][A-Za-z0-9_-]{2,39}$'), FALSE)"),
        ("region_domain", f"NOT coalesce(lower(trim(region)) IN {ct.REGION_CATEGORIES}, FALSE)"),
        ("exposure_blank", "current_limit_inr IS NULL OR current_balance_inr IS NULL"),
        ("limit_range", f"coalesce(current_limit_inr <= 0 OR current_limit_inr > {ct.MAX_LIMIT}, FALSE)"),
        ("balance_range", "coalesce(current_balance_inr < 0 OR current_balance_inr > current_limit_inr * 2, FALSE)"),
    ]
    for c in [x for x in ct.MODEL_INPUT_COLUMNS if x != "region"] + ct.EXPOSURE_COLUMNS:
        rules.append((f"{c}_not_finite", f"coalesce(isnan({c}) OR isinf({c}), FALSE)"))
    for c, (lo, hi) in ct.FIELD_BOUNDS.items():
        rules.append((f"{c}_range", f"coalesce({c} < {lo} OR {c} > {hi}, FALSE)"))
    sel = " UNION ALL ".join(f"SELECT account_id, '{n}' AS rule FROM rawp WHERE {cond}" for n, cond in rules)
    return with_ctes(acct_ctes()) + RAW_SQL + f"""
{sel}
UNION ALL SELECT account_id, 'id_duplicate' FROM rawp GROUP BY account_id HAVING count(*) > 1"""


@register("contract_violations", _violations_sql)
def q_contract_violations(spark, sf_dir):
    return ct.contract_violations(adapters.raw_profile(spark, sf_dir))


@register("contract_violation_counts", lambda: "SELECT rule, CAST(count(*) AS BIGINT) AS rows FROM ("
          + _violations_sql() + ") GROUP BY rule")
def q_violation_counts(spark, sf_dir):
    v = ct.contract_violations(adapters.raw_profile(spark, sf_dir))
    return v.groupBy("rule").agg(F.count(F.lit(1)).alias("rows"))


SOURCE_NUMERIC = ["LIMIT_BAL", *ct.PAY_COLUMNS, *[f"BILL_AMT{i}" for i in range(1, 7)], *ct.PAYMENT_COLUMNS, "y"]


# Faults by account number: column -> (every so many-th, value).
FAULTS = {"LIMIT_BAL": (7, "-LIMIT_BAL"), "PAY_0": (11, "12"), "PAY_AMT1": (13, "-1"), "y": (17, "NULL"), "BILL_AMT1": (19, "NULL")}


def _faulty_sql(c: str) -> str:
    return f"CASE WHEN ck % {FAULTS[c][0]} = 0 THEN {FAULTS[c][1]} ELSE {c} END AS {c}" if c in FAULTS else c


@register("clean_report", lambda: with_ctes(acct_ctes()) + f""",
base AS (SELECT account_id, CAST(substr(account_id, 6) AS BIGINT) AS ck, {', '.join(SOURCE_NUMERIC)} FROM scored_y),
faulty AS (SELECT account_id, ck, {', '.join(_faulty_sql(c) for c in SOURCE_NUMERIC)} FROM base),
src AS (SELECT *, 1 AS load_no FROM faulty UNION ALL SELECT *, 1 FROM faulty WHERE ck % 15 = 0
        UNION ALL SELECT * REPLACE (LIMIT_BAL + 1 AS LIMIT_BAL), 2 FROM faulty WHERE ck % 10 = 0),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY load_no) AS rn FROM src) WHERE rn = 1),
inv AS (SELECT *, ({' OR '.join(f'{c} IS NULL' for c in SOURCE_NUMERIC)}) OR coalesce(LIMIT_BAL <= 0, FALSE) OR y IS NULL OR y NOT IN (0, 1)
          OR {' OR '.join(f'coalesce({c} < -2 OR {c} > 9, FALSE)' for c in ct.PAY_COLUMNS)}
          OR {' OR '.join(f'coalesce({c} < 0, FALSE)' for c in ct.PAYMENT_COLUMNS)} AS invalid FROM firsts),
n AS (SELECT count(*) AS n, count(DISTINCT account_id) AS ids, (SELECT count(*) FROM (SELECT DISTINCT * FROM src)) AS distinct_rows FROM src)
SELECT CAST(max(n) AS BIGINT) AS source_rows, CAST(sum(CASE WHEN NOT invalid THEN 1 ELSE 0 END) AS BIGINT) AS clean_rows,
  CAST(max(n) - sum(CASE WHEN NOT invalid THEN 1 ELSE 0 END) AS BIGINT) AS removed_rows,
  CAST(max(n) - max(ids) AS BIGINT) AS duplicate_ids,
  CAST(max(n) - max(distinct_rows) AS BIGINT) AS exact_duplicates,
  CAST(sum({' + '.join(f'CASE WHEN {c} IS NULL THEN 1 ELSE 0 END' for c in SOURCE_NUMERIC)}) AS BIGINT) AS missing_cells,
  CAST(sum(CASE WHEN LIMIT_BAL <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS invalid_limit_rows,
  CAST(sum(CASE WHEN y NOT IN (0, 1) OR y IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS invalid_target_rows,
  CAST(sum(CASE WHEN {' OR '.join(f'{c} < -2 OR {c} > 9' for c in ct.PAY_COLUMNS)} THEN 1 ELSE 0 END) AS BIGINT)
    AS invalid_payment_status_rows,
  CAST(sum(CASE WHEN {' OR '.join(f'{c} < 0' for c in ct.PAYMENT_COLUMNS)} THEN 1 ELSE 0 END) AS BIGINT)
    AS invalid_payment_amount_rows,
  {sql_dround('avg(CASE WHEN NOT invalid THEN CAST(y AS DOUBLE) END)', 6)} AS target_rate
FROM inv, n""")
def q_clean_report(spark, sf_dir):
    """The quality report of accounts some of which are made faulty, loaded twice, or copied."""
    base = adapters.shared_scored(spark, sf_dir).select("account_id", *SOURCE_NUMERIC)
    ck = F.expr("cast(substring(account_id, 6) as bigint)")
    faulty = base.select("account_id", *[F.when(ck % FAULTS[c][0] == 0, F.expr(FAULTS[c][1])).otherwise(F.col(c)).alias(c) if c in FAULTS else F.col(c)
                                         for c in SOURCE_NUMERIC]).withColumn("load_no", F.lit(1))
    src = (faulty.unionByName(faulty.filter(ck % 15 == 0))
           .unionByName(faulty.filter(ck % 10 == 0).withColumn("LIMIT_BAL", F.col("LIMIT_BAL") + 1).withColumn("load_no", F.lit(2))))
    _, rep = ct.clean_report(src, "account_id", "y", SOURCE_NUMERIC, ["load_no"])
    return rep.select(*[F.col(c).cast("bigint").alias(c) if c != "target_rate" else dround(c, 6).alias(c)
                        for c in rep.columns])


@register("surrogate_ids", lambda: with_ctes(acct_ctes()) + f"""
SELECT account_id, 'ACC-' || upper(substr(sha256('{ct.SURROGATE_SALT}' || account_id), 1, 10)) AS surrogate_id,
       regexp_full_match(account_id, '^[A-Za-z0-9][A-Za-z0-9_-]{{2,39}}$') AS valid_id,
       array_to_string(list_filter([CASE WHEN debt_to_income IS NULL THEN 'debt_to_income' END,
                                    CASE WHEN income_inr IS NULL THEN 'income_inr' END,
                                    CASE WHEN credit_age_months IS NULL THEN 'credit_age_months' END],
                                   lambda x: x IS NOT NULL), ' | ') AS missing_model_fields
FROM scored_y""")
def q_surrogate_ids(spark, sf_dir):
    s = adapters.shared_scored(spark, sf_dir)
    return s.select("account_id", ct.surrogate_id("account_id").alias("surrogate_id"),
                    F.col("account_id").rlike(ct.ID_PATTERN).alias("valid_id"),
                    ct.missing_fields(["debt_to_income", "income_inr", "credit_age_months"])
                    .alias("missing_model_fields"))


READY_SQL = """
WITH per AS (
  SELECT o_custkey AS ck, max(o_orderdate) AS last_order, count(*) AS n_orders,
         sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS open_trades, sum(o_totalprice) AS spend,
         count(DISTINCT strftime(o_orderdate, '%Y-%m')) AS statement_months
  FROM orders GROUP BY o_custkey),
j AS (SELECT c.c_custkey AS ck, c.c_acctbal, p.last_order, p.n_orders, p.open_trades, p.spend, p.statement_months,
             p.last_order + INTERVAL 1 DAY AS as_of
      FROM customer c JOIN per p ON c.c_custkey = p.ck),
t AS (SELECT *, CASE WHEN ck % 59 = 0 THEN NULL WHEN ck % 43 = 0 THEN as_of + INTERVAL 2 DAY ELSE as_of - INTERVAL 10 DAY END AS consent_ts,
             CAST(CAST(as_of AS DATE) - CAST(ck % 35 AS INTEGER) AS TIMESTAMP) AS bureau_ts,
             CAST(CAST(as_of AS DATE) - CAST(ck % 100 AS INTEGER) AS TIMESTAMP) AS income_ts,
             ck % 47 <> 0 AS has_tz FROM j),
rec AS (
  SELECT 'ACCT-' || printf('%012d', ck) AS customer_reference, has_tz, as_of, consent_ts, bureau_ts, income_ts,
         CASE WHEN ck % 41 = 0 THEN NULL ELSE 'CNS-' || CAST(ck AS VARCHAR) END AS consent_reference,
         CAST(n_orders % 3 AS DOUBLE) AS bureau_dpd_30_12m, CAST(n_orders % 2 AS DOUBLE) AS bureau_dpd_90_24m,
         CAST(open_trades AS DOUBLE) AS open_trades,
         CASE WHEN ck % 53 = 0 THEN -spend / 120.0 ELSE spend / 120.0 END AS total_monthly_obligation_inr,
         c_acctbal * 10.0 AS verified_monthly_income_inr, 150000.0 + 100 * (c_acctbal + 1000) AS current_limit_inr,
         spend / 4.0 AS current_balance_inr, CAST(statement_months AS DOUBLE) AS statement_months
  FROM t),
rules AS (
  SELECT customer_reference, 'missing_consent_reference' AS rule FROM rec WHERE consent_reference IS NULL
  UNION ALL SELECT customer_reference, 'timezone_missing' FROM rec WHERE NOT has_tz
  UNION ALL SELECT customer_reference, 'timestamp_unparseable' FROM rec WHERE consent_ts IS NULL
  UNION ALL SELECT customer_reference, 'evidence_after_decision' FROM rec
    WHERE has_tz AND (consent_ts > as_of OR bureau_ts > as_of OR income_ts > as_of)
  UNION ALL SELECT customer_reference, 'bureau_stale' FROM rec WHERE has_tz AND epoch(as_of) - epoch(bureau_ts) > 30 * 86400
  UNION ALL SELECT customer_reference, 'income_stale' FROM rec WHERE has_tz AND epoch(as_of) - epoch(income_ts) > 90 * 86400
  UNION ALL SELECT customer_reference, 'negative_numeric' FROM rec
    WHERE bureau_dpd_30_12m < 0 OR bureau_dpd_90_24m < 0 OR open_trades < 0 OR total_monthly_obligation_inr < 0
       OR verified_monthly_income_inr < 0 OR current_limit_inr < 0 OR current_balance_inr < 0 OR statement_months < 0
  UNION ALL SELECT customer_reference, 'nonpositive_income_or_limit' FROM rec
    WHERE verified_monthly_income_inr <= 0 OR current_limit_inr <= 0
  UNION ALL SELECT customer_reference, 'balance_above_bound' FROM rec WHERE current_balance_inr > current_limit_inr * 2
  UNION ALL SELECT customer_reference, 'short_history' FROM rec WHERE statement_months < 6)"""


@register("readiness_violations", READY_SQL + "\nSELECT customer_reference, rule FROM rules")
def q_readiness_violations(spark, sf_dir):
    v, _ = ct.readiness(adapters.readiness_records(spark, sf_dir))
    return v


@register("readiness_controls", READY_SQL + f"""
SELECT customer_reference, {sql_dround('total_monthly_obligation_inr / verified_monthly_income_inr', 6)} AS foir_proxy,
       {sql_dround('current_balance_inr / current_limit_inr', 6)} AS utilization,
       CAST(floor((epoch(as_of) - epoch(bureau_ts)) / 86400) AS INTEGER) AS bureau_age_days,
       CAST(floor((epoch(as_of) - epoch(income_ts)) / 86400) AS INTEGER) AS income_age_days
FROM rec WHERE customer_reference NOT IN (SELECT customer_reference FROM rules)""")
def q_readiness_controls(spark, sf_dir):
    _, d = ct.readiness(adapters.readiness_records(spark, sf_dir))
    return d.select("customer_reference", dround("foir_proxy", 6).alias("foir_proxy"),
                    dround("utilization", 6).alias("utilization"), "bureau_age_days", "income_age_days")
