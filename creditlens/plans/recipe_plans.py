"""Queries of the cross-dataset recipes."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.operators import recipes as rc
from creditlens.plans.oracle_base import acct_ctes, with_ctes
from creditlens.plans.registry import register
from creditlens.sources import adapters

RECIPES = [
    rc.Recipe("accounts", adapters.shared_scored, "account_id", "y", ("delinquency_count", "debt_to_income", "credit_lines", "income_inr", "credit_age_months"), ("region",)),
    rc.Recipe("orders", adapters.vintage_loans, "id", "target", ("loan_amnt", "n_lines", "net_revenue")),
    rc.Recipe("documents", adapters.labelled_documents, "doc_id", "quality", ("n_chars", "n_words", "n_lines", "chars_per_word"), ("lang",)),
]


@register("cross_dataset_splits", lambda: with_ctes(acct_ctes()) + """,
t AS (SELECT 'accounts' AS dataset, account_id AS key, y FROM scored_y
      UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END FROM orders
      UNION ALL SELECT 'documents', CAST(d.doc_id AS VARCHAR), CAST(l.quality AS INTEGER) FROM labels l JOIN documents d ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY dataset, y ORDER BY md5('42:' || key), key) AS rk, count(*) OVER (PARTITION BY dataset, y) AS n FROM t)
SELECT dataset, CASE WHEN rk <= floor(n * 0.6) THEN 'train' WHEN rk <= floor(n * 0.8) THEN 'validation' ELSE 'test' END AS split, CAST(y AS INTEGER) AS y,
       CAST(count(*) AS BIGINT) AS rows, min(key) AS first_key FROM r GROUP BY 1, 2, 3""")
def q_cross_dataset_splits(spark, sf_dir):
    """Rows of each recipe's splits, by label."""
    parts = [r.split(spark, sf_dir).select(F.lit(r.dataset).alias("dataset"), "split", "y", F.col("key").cast("string").alias("key")) for r in RECIPES]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.groupBy("dataset", "split", "y").agg(F.count(F.lit(1)).alias("rows"), F.min("key").alias("first_key"))


@register("cross_dataset_recipes")
def q_cross_dataset_recipes(spark, sf_dir):
    """Champion, frozen threshold and test metrics of every dataset and model."""
    return rc.run(spark, sf_dir, RECIPES, rounds=20)
