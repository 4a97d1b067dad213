"""Portfolio description, guards, lookups and membership queries (A9, H10, E7, IO4, IO14, P11, P15, L4, X4, J12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions.columns import dround, sql_dround
from creditlens.operators import evaluate as ev
from creditlens.operators import experiment as xp
from creditlens.operators import explorer as xr
from creditlens.operators import ledger
from creditlens.operators.evaluate import order_statistics
from creditlens.plans.oracle_base import acct_ctes, with_ctes
from creditlens.plans.pilot_ledger import LEDGER_EVENTS_SQL, PILOT_SQL
from creditlens.plans.registry import register
from creditlens.sources import adapters, files
from creditlens.sources.tables import read_table

EDA_COLUMNS = ("current_limit_inr", "utilization")
EDA_QUANTILES = (("p10", 0.1), ("median", 0.5), ("p90", 0.9))


def _eda_sql() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS measure, CAST(count(*) AS BIGINT) AS accounts, {sql_dround(f'avg({c})', 4)} AS mean, "
        + ", ".join(f"{sql_dround(f'quantile_cont({c}, {q})', 4)} AS {n}" for n, q in EDA_QUANTILES)
        + f", {sql_dround('avg(CAST(y AS DOUBLE))', 6)} AS default_rate, CAST(sum(CASE WHEN delinquency_count > 0 THEN 1 ELSE 0 END) AS BIGINT) AS delinquent_accounts FROM scored_y"
        for c in EDA_COLUMNS)
    return with_ctes(acct_ctes()) + "\n" + rows


@register("eda_summary", _eda_sql)
def q_eda_summary(spark, sf_dir):
    """Mean and exact quantiles of limit and utilization, default rate and delinquent accounts."""
    s = adapters.shared_scored(spark, sf_dir)
    long = s.select("y", "delinquency_count", F.inline(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("v")) for c in EDA_COLUMNS])))
    plain = long.groupBy("measure").agg(
        F.count(F.lit(1)).alias("accounts"), F.avg("v").alias("mean"), F.avg(F.col("y").cast("double")).alias("default_rate"),
        F.sum((F.col("delinquency_count") > 0).cast("bigint")).alias("delinquent_accounts"))
    q = order_statistics(ev.cumulative_scores(long, "v", "y", ["measure"]), [x for _, x in EDA_QUANTILES], ["measure"])
    return plain.join(q, "measure").select(
        "measure", "accounts", dround("mean", 4).alias("mean"), *[dround(f"q{i}", 4).alias(n) for i, (n, _) in enumerate(EDA_QUANTILES)],
        dround("default_rate", 6).alias("default_rate"), "delinquent_accounts")


@register("eda_target_by_group", lambda: with_ctes(acct_ctes()) + f"""
SELECT source_dataset AS "group", CAST(count(*) AS BIGINT) AS accounts, {sql_dround('avg(CAST(y AS DOUBLE))', 6)} AS target_rate FROM scored_y GROUP BY 1""")
def q_eda_target_by_group(spark, sf_dir):
    s = adapters.shared_scored(spark, sf_dir)
    return s.groupBy(F.col("source_dataset").alias("group")).agg(F.count(F.lit(1)).alias("accounts"), dround(F.avg(F.col("y").cast("double")), 6).alias("target_rate"))


# Rows that all sources together, and a large source, must have, and how many large ones.
ROW_BUDGET, LARGE_SOURCE, LARGE_SOURCES = 1_500_000, 200_000, 2


@register("row_budget", f"""
WITH s AS (SELECT 'customer' AS source, count(*) AS n FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier
           UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem)
SELECT source, CAST(n AS BIGINT) AS rows, n >= {LARGE_SOURCE} AS large, CAST(sum(n) OVER () AS BIGINT) AS all_rows,
       sum(n) OVER () >= {ROW_BUDGET} AND sum(CASE WHEN n >= {LARGE_SOURCE} THEN 1 ELSE 0 END) OVER () >= {LARGE_SOURCES} AS within_budget FROM s""")
def q_row_budget(spark, sf_dir):
    """Whether the sources hold enough rows, and enough large sources."""
    from pyspark.sql import Window
    parts = [read_table(spark, sf_dir, t, [c]).select(F.lit(t).alias("source")) for t, c in
             (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey"))]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    n = both.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy(F.lit(0))  # a row per source
    large = F.col("rows") >= LARGE_SOURCE
    return n.select("source", "rows", large.alias("large"), F.sum("rows").over(whole).alias("all_rows"),
                    ((F.sum("rows").over(whole) >= ROW_BUDGET) & (F.sum(large.cast("int")).over(whole) >= LARGE_SOURCES)).alias("within_budget"))


def _curve_gap_sql() -> str:
    edges = ", ".join(f"quantile_cont(pd, {k * 0.1!r}) AS e{k}" for k in range(1, 10))
    below = " + ".join(f"CASE WHEN e{k} < pd THEN 1 ELSE 0 END" for k in range(1, 10))
    return with_ctes(acct_ctes()) + f""",
e AS (SELECT {edges} FROM scored_y),
b AS (SELECT {below} AS bin, avg(pd) AS p, avg(CAST(y AS DOUBLE)) AS o FROM scored_y, e GROUP BY 1)
SELECT CAST(count(*) AS BIGINT) AS points, {sql_dround('avg(abs(p - o))', 6)} AS mean_absolute_gap FROM b"""


@register("calibration_curve_gap", _curve_gap_sql)
def q_calibration_curve_gap(spark, sf_dir):
    """Mean absolute gap over the points of the calibration curve (E7 a)."""
    c = ev.calibration_curve(adapters.shared_scored(spark, sf_dir))
    return c.agg(F.count(F.lit(1)).alias("points"), dround(F.avg(F.abs(F.col("mean_predicted") - F.col("observed_rate"))), 6).alias("mean_absolute_gap"))


@register("membership_filters", """
SELECT 'without_orders' AS membership, CAST(count(*) AS BIGINT) AS customers FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
UNION ALL SELECT 'with_urgent_order', CAST(count(*) AS BIGINT) FROM customer c
  WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')""")
def q_membership_filters(spark, sf_dir):
    """Semi and anti joins on the customer key."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey"])
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderpriority"])
    key = c.c_custkey == o.o_custkey
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("customers")).select(F.lit(name).alias("membership"), "customers")
    return count(c.join(o, key, "left_anti"), "without_orders").unionByName(
        count(c.join(o.filter("o_orderpriority = '1-URGENT'"), key, "left_semi"), "with_urgent_order"))


@register("ledger_history", f"""WITH {LEDGER_EVENTS_SQL}
SELECT review_id, CAST(count(*) AS BIGINT) AS events, arg_min(event, seq) AS first_event, arg_max(event, seq) AS last_event FROM ev GROUP BY 1""")
def q_ledger_history(spark, sf_dir):
    return ledger.history(adapters.ledger_events(spark, sf_dir))


@register("pilot_continuous_mde", PILOT_SQL + f"""
SELECT segment, CAST(count(*) AS BIGINT) AS accounts,
       {sql_dround(f'{sum(xp.z_values())!r}::DOUBLE * stddev_samp(baseline_spend) * sqrt(2 / (count(*) / 4.0::DOUBLE))', 2)} AS mde FROM pilot GROUP BY 1""")
def q_pilot_continuous_mde(spark, sf_dir):
    """Smallest effect on spend that a four-arm pilot of each segment can show."""
    r = xp.continuous_mde(adapters.pilot(spark, sf_dir), "baseline_spend", "segment")
    return r.select("segment", F.col("n").alias("accounts"), dround("mde", 2).alias("mde"))


@register("input_sample", lambda: with_ctes(acct_ctes()) + """
SELECT account_id, current_limit_inr, current_balance_inr FROM scored_y ORDER BY account_id LIMIT 5""")
def q_input_sample(spark, sf_dir):
    """The first five accounts as a template of the batch input (IO14)."""
    return files.sample_input(adapters.shared_scored(spark, sf_dir), "account_id", ["account_id", "current_limit_inr", "current_balance_inr"])


@register("account_lookup", lambda: with_ctes(acct_ctes()) + f"""
SELECT account_id, {sql_dround('least(greatest(coalesce(utilization, current_balance_inr / current_limit_inr), 0.0), 1.2)', 6)} AS display_utilization
FROM scored_y WHERE account_id = (SELECT max(account_id) FROM scored_y)""")
def q_account_lookup(spark, sf_dir):
    """One account by key, with the utilization shown for it (P11, P15); an unknown key raises."""
    s = adapters.shared_scored(spark, sf_dir)
    key = s.agg(F.max("account_id")).first()[0]
    hit = xr.lookup(s, "account_id", key)
    return hit.select("account_id", dround(xr.display_utilization(hit), 6).alias("display_utilization"))


@register("upload_guards", f"""
SELECT 'customer' AS upload, count(*) <= {files.MAX_UPLOAD_ROWS} AS accepted FROM customer UNION ALL SELECT 'orders', count(*) <= {files.MAX_UPLOAD_ROWS} FROM orders
UNION ALL SELECT 'lineitem', count(*) <= {files.MAX_UPLOAD_ROWS} FROM lineitem""")
def q_upload_guards(spark, sf_dir):
    """Which tables the upload guard lets through by their rows (IO4)."""
    def accepted(name: str) -> bool:
        try:
            files.guard_rows(read_table(spark, sf_dir, name))
        except ValueError:
            return False
        return True

    return spark.createDataFrame([(t, accepted(t)) for t in ("customer", "orders", "lineitem")], "upload string, accepted boolean")
