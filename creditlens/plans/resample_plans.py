"""Split and sample queries (T1-T5) over the vintage loans."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions.columns import dround, sql_dround
from creditlens.operators import resample as rs
from creditlens.plans.registry import register
from creditlens.sources import adapters

LOANS_SQL = """WITH lines_o AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_extendedprice * (1 - l_discount)) AS net_revenue
  FROM lineitem GROUP BY l_orderkey),
loans AS (
  SELECT o.o_orderkey AS id, o.o_orderdate AS issue_date, year(o.o_orderdate) AS vintage,
         CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS target, o.o_totalprice AS loan_amnt
  FROM orders o LEFT JOIN lines_o l ON o.o_orderkey = l.l_orderkey)"""


@register("stratified_split", LOANS_SQL + """,
r AS (SELECT id, target, row_number() OVER (PARTITION BY target ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) AS rk,
             count(*) OVER (PARTITION BY target) AS n FROM loans)
SELECT CASE WHEN rk <= floor(n * 0.6) THEN 'train' WHEN rk <= floor(n * 0.8) THEN 'validation' ELSE 'test' END AS split,
       target, CAST(count(*) AS BIGINT) AS rows, CAST(sum(id % 1000) AS BIGINT) AS id_checksum
FROM r GROUP BY 1, 2""")
def q_stratified_split(spark, sf_dir):
    s = rs.stratified_split(adapters.vintage_loans(spark, sf_dir), ["target"], "id")
    return s.groupBy("split", "target").agg(F.count(F.lit(1)).alias("rows"),
                                            F.sum(F.col("id") % 1000).cast("bigint").alias("id_checksum"))


@register("vintage_split", LOANS_SQL + f"""
SELECT CASE WHEN vintage <= 1998 THEN 'train' WHEN vintage = 1999 THEN 'validation' ELSE 'test' END AS split,
       CAST(count(*) AS BIGINT) AS rows, {sql_dround('avg(CAST(target AS DOUBLE))', 6)} AS event_rate
FROM loans GROUP BY 1""")
def q_vintage_split(spark, sf_dir):
    s = rs.vintage_split(adapters.vintage_loans(spark, sf_dir), "vintage", 1998, 1999)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), dround(F.avg(F.col("target").cast("double")), 6)
                                  .alias("event_rate"))


@register("vintage_quantile_split", LOANS_SQL + f""",
c AS (SELECT quantile_cont(epoch(issue_date), 0.6) AS c1, quantile_cont(epoch(issue_date), 0.8) AS c2 FROM loans)
SELECT CASE WHEN epoch(issue_date) <= c1 THEN 'train' WHEN epoch(issue_date) <= c2 THEN 'validation' ELSE 'test' END AS split,
       CAST(count(*) AS BIGINT) AS rows, {sql_dround('avg(CAST(target AS DOUBLE))', 6)} AS event_rate
FROM loans, c WHERE issue_date IS NOT NULL GROUP BY 1""")
def q_vintage_quantile_split(spark, sf_dir):
    s = rs.quantile_split(adapters.vintage_loans(spark, sf_dir), "issue_date").filter(F.col("split").isNotNull())
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), dround(F.avg(F.col("target").cast("double")), 6)
                                  .alias("event_rate"))


SAMPLE_ROWS = 5000


@register("vintage_sample", LOANS_SQL + f""",
r AS (SELECT id, vintage, target, row_number() OVER (PARTITION BY vintage ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) AS rk,
             count(*) OVER (PARTITION BY vintage) AS n, count(*) OVER () AS total FROM loans)
SELECT vintage, CAST(count(*) AS BIGINT) AS rows, {sql_dround('avg(CAST(target AS DOUBLE))', 6)} AS event_rate
FROM r WHERE rk <= least(n, greatest(1, round_even({SAMPLE_ROWS}.0 * n / total, 0))) GROUP BY vintage""")
def q_vintage_sample(spark, sf_dir):
    s = rs.proportional_sample(adapters.vintage_loans(spark, sf_dir), "vintage", "id", SAMPLE_ROWS)
    return s.groupBy("vintage").agg(F.count(F.lit(1)).alias("rows"),
                                    dround(F.avg(F.col("target").cast("double")), 6).alias("event_rate"))


@register("capped_sample", LOANS_SQL + f""",
r AS (SELECT id, vintage, target, row_number() OVER (PARTITION BY vintage ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) AS rk FROM loans)
SELECT vintage, CAST(count(*) AS BIGINT) AS rows, CAST(sum(id % 1000) AS BIGINT) AS id_checksum
FROM r WHERE rk <= 500 GROUP BY vintage""")
def q_capped_sample(spark, sf_dir):
    s = rs.capped_sample(adapters.vintage_loans(spark, sf_dir), "vintage", "id", 500)
    return s.groupBy("vintage").agg(F.count(F.lit(1)).alias("rows"),
                                    F.sum(F.col("id") % 1000).cast("bigint").alias("id_checksum"))
