"""Harmonization queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions.columns import dround, sql_dround
from creditlens.operators import harmonize as hz
from creditlens.plans.oracle_base import acct_ctes, with_ctes
from creditlens.plans.registry import register
from creditlens.sources import adapters

REFERENCE_ONLY = ("supplier_ledger",)

SRC_SQL = """,
reg AS (SELECT n.n_nationkey, CASE upper(trim(r.r_name)) WHEN 'AMERICA' THEN 'north_america' WHEN 'ASIA' THEN 'asia'
               WHEN 'EUROPE' THEN 'europe' ELSE 'undisclosed' END AS region
        FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
h_card AS (
  SELECT account_id AS source_key, delinquency_count, least(greatest(BILL_AMT1 / greatest(LIMIT_BAL, 1.0), 0.0), 5.0) AS utilization,
         NULL::DOUBLE AS debt_to_income, NULL::DOUBLE AS credit_lines, NULL::DOUBLE AS income_inr,
         NULL::DOUBLE AS credit_age_months, region, CAST(y AS INTEGER) AS "default", 'card_history' AS market FROM scored_y),
h_sup AS (
  SELECT 'SUPP-' || CAST(s.s_suppkey AS VARCHAR) AS source_key, NULL::DOUBLE AS delinquency_count,
         CASE WHEN s_acctbal >= 0 THEN least(greatest(s_acctbal / 10000.0, 0.0), 5.0) END AS utilization,
         NULL::DOUBLE AS debt_to_income, NULL::DOUBLE AS credit_lines,
         CASE WHEN s_acctbal >= 0 THEN s_acctbal END * 83.0 AS income_inr, NULL::DOUBLE AS credit_age_months,
         g.region, CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END AS "default", 'supplier_ledger' AS market
  FROM supplier s LEFT JOIN reg g ON s.s_nationkey = g.n_nationkey),
h_loan AS (
  SELECT 'ORD-' || CAST(o.o_orderkey AS VARCHAR) AS source_key, NULL::DOUBLE AS delinquency_count,
         least(greatest(o_totalprice / 500000.0, 0.0), 5.0) AS utilization,
         least(greatest(o_totalprice / 1000000.0, 0.0), 1.0) AS debt_to_income, NULL::DOUBLE AS credit_lines,
         o_totalprice * 2.97 AS income_inr,
         greatest(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) / 30.44, 0.0) AS credit_age_months,
         g.region, CASE WHEN o_orderstatus IN ('F') THEN 1 ELSE 0 END AS "default", 'order_loans' AS market
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN reg g ON c.c_nationkey = g.n_nationkey
  WHERE o_orderstatus IN ('F', 'O')),
h_part AS (
  SELECT 'PART-' || CAST(p_partkey AS VARCHAR) AS source_key,
         CASE WHEN CAST(p_size AS DOUBLE) < 45 THEN CAST(p_size AS DOUBLE) / 10.0 END AS delinquency_count,
         CASE WHEN p_retailprice IS NULL THEN NULL ELSE least(greatest(p_retailprice / greatest(1000.0, 1.0), 0.0), 5.0) END
           AS utilization,
         CASE CAST(right(p_brand, 1) AS INTEGER) WHEN 1 THEN 0.35 WHEN 2 THEN 0.30 WHEN 3 THEN 0.225 WHEN 4 THEN 0.125 END
           AS debt_to_income,
         NULL::DOUBLE AS credit_lines, NULL::DOUBLE AS income_inr, NULL::DOUBLE AS credit_age_months,
         'undisclosed' AS region, CASE WHEN starts_with(p_type, 'PROMO') THEN 1 ELSE 0 END AS "default",
         'coded_parts' AS market
  FROM part),
allsrc AS (SELECT source_key, delinquency_count, utilization, debt_to_income, credit_lines, income_inr,
                  credit_age_months, region, "default", market FROM h_card
           UNION ALL SELECT source_key, delinquency_count, utilization, debt_to_income, credit_lines, income_inr,
                  credit_age_months, region, "default", market FROM h_sup
           UNION ALL SELECT source_key, delinquency_count, utilization, debt_to_income, credit_lines, income_inr,
                  credit_age_months, region, "default", market FROM h_loan
           UNION ALL SELECT source_key, delinquency_count, utilization, debt_to_income, credit_lines, income_inr,
                  credit_age_months, region, "default", market FROM h_part),
uni AS (SELECT * FROM allsrc WHERE market NOT IN ('supplier_ledger'))"""

NUM = hz.NUMERIC_FEATURES


@register("harmonized_union", lambda: with_ctes(acct_ctes()) + SRC_SQL + f"""
SELECT source_key, market, {', '.join(f'{sql_dround(c, 6)} AS {c}' for c in NUM)}, region, "default",
       ("default" IN (0, 1) AND coalesce(region IN ('asia', 'europe', 'north_america', 'taiwan', 'undisclosed'), FALSE))
         AS domain_ok
FROM uni""")
def q_harmonized_union(spark, sf_dir):
    u = hz.union_sources(adapters.harmonization_sources(spark, sf_dir), REFERENCE_ONLY)
    return u.select("source_key", "market", *[dround(c, 6).alias(c) for c in NUM], "region", "default", "domain_ok")


@register("union_provenance", lambda: with_ctes(acct_ctes()) + SRC_SQL + f"""
SELECT market, CAST(count(*) AS BIGINT) AS rows,
       CAST(sum(CASE WHEN market IN ('supplier_ledger') THEN 0 ELSE 1 END) AS BIGINT) AS rows_in_union,
       {sql_dround('avg(CAST("default" AS DOUBLE))', 6)} AS risk_rate,
       {', '.join(f"{sql_dround(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)', 6)} AS null_{c}" for c in NUM)}
FROM allsrc GROUP BY market""")
def q_union_provenance(spark, sf_dir):
    p = hz.provenance(adapters.harmonization_sources(spark, sf_dir), REFERENCE_ONLY)
    return p.select("market", F.col("rows").cast("bigint").alias("rows"), "rows_in_union",
                    *[dround(c, 6).alias(c) for c in p.columns if c.startswith("null_") or c == "risk_rate"])


@register("missingness_matrix", lambda: with_ctes(acct_ctes()) + SRC_SQL + f""",
w AS (SELECT market, {', '.join(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS {c}' for c in NUM)}
      FROM uni GROUP BY market)
SELECT market, feature, {sql_dround('missing_rate', 6)} AS missing_rate
FROM (UNPIVOT w ON {', '.join(NUM)} INTO NAME feature VALUE missing_rate)""")
def q_missingness(spark, sf_dir):
    u = hz.union_sources(adapters.harmonization_sources(spark, sf_dir), REFERENCE_ONLY)
    return hz.missingness(u).select("market", "feature", dround("missing_rate", 6).alias("missing_rate"))


@register("median_imputation", lambda: with_ctes(acct_ctes()) + SRC_SQL + f""",
med AS (SELECT market, quantile_cont(credit_age_months, 0.5) AS m FROM uni GROUP BY market)
SELECT u.market, CAST(sum(CASE WHEN u.credit_age_months IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS imputed,
       {sql_dround('avg(coalesce(u.credit_age_months, med.m))', 6)} AS mean_after
FROM uni u JOIN med ON med.market = u.market GROUP BY u.market""")
def q_median_imputation(spark, sf_dir):
    u = hz.union_sources(adapters.harmonization_sources(spark, sf_dir), REFERENCE_ONLY)
    imp = hz.median_impute(u, ["credit_age_months"], ["market"])
    return imp.groupBy("market").agg(F.sum("credit_age_months_missing").cast("bigint").alias("imputed"),
                                     dround(F.avg("credit_age_months"), 6).alias("mean_after"))


@register("one_hot_levels", lambda: with_ctes(acct_ctes()) + """
SELECT 'source_dataset' AS column_name, source_dataset AS level, CAST(count(*) AS BIGINT) AS ones FROM scored_y GROUP BY 2
UNION ALL SELECT 'region', region, CAST(count(*) AS BIGINT) FROM scored_y GROUP BY 2""")
def q_one_hot_levels(spark, sf_dir):
    s = adapters.shared_scored(spark, sf_dir).select("account_id", "source_dataset", "region")
    oh = hz.one_hot(s, ["source_dataset", "region"])
    dummies = [c for c in oh.columns if c.startswith("source_dataset_") or c.startswith("region_")]
    sums = oh.agg(*[F.sum(c).cast("bigint").alias(c) for c in dummies])
    rows = F.array(*[F.struct(F.lit("source_dataset" if c.startswith("source_dataset_") else "region").alias("column_name"),
                              F.lit(c.split("_", 2)[-1] if c.startswith("source_dataset_") else c[len("region_"):]).alias("level"),
                              F.col(c).alias("ones")) for c in dummies])
    return sums.select(F.inline(rows))
