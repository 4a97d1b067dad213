"""File format round trips and integrity queries (IO1-IO11, TC1, TC2).

Each query first writes data that Spark derives from the given tables into a
fresh folder under the shared checkpoint directory, then reads it back with the
format reader, so the reader's work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions.columns import dround, sql_dround
from creditlens.operators import resample as rs
from creditlens.plans.portfolio import decisions
from creditlens.plans.registry import register
from creditlens.sources import adapters, files
from creditlens.sources.tables import read_table
from creditlens.plans.oracle_base import acct_ctes, decision_ctes, with_ctes

DECISION_SCHEMA = ("account_id string, source_dataset string, action string, increase_pct double, "
                   "risk_band string, pd double, utilization double, current_limit_inr double, "
                   "proposed_limit double, current_ead double, proposed_ead double, current_expected_loss double, "
                   "proposed_expected_loss double, incremental_contribution double, risk_adjusted_return double, "
                   "reason_codes string, policy_checks string")


@register("csv_roundtrip", lambda: with_ctes(acct_ctes(), decision_ctes()) + f"""
SELECT action, CAST(count(*) AS BIGINT) AS accounts, {sql_dround('sum(CAST(proposed_limit AS DECIMAL(38,9)))')} AS proposed_limit
FROM reasons GROUP BY action""")
def q_csv_roundtrip(spark, sf_dir):
    from creditlens.operators.policy import decision_table
    path = files.write_csv(decision_table(decisions(spark, sf_dir)), files.scratch_path(spark, "decisions-csv"))
    back = files.read_csv(spark, path, DECISION_SCHEMA, columns=["action", "proposed_limit"])
    return back.groupBy("action").agg(F.count(F.lit(1)).alias("accounts"), F.round(
        F.sum(F.col("proposed_limit").cast("decimal(38,9)")), 2).cast("double").alias("proposed_limit"))


@register("arff_roundtrip", f"""
SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS customers, {sql_dround('sum(CAST(c_acctbal AS DECIMAL(38,9)))')} AS acctbal
FROM customer GROUP BY c_mktsegment""")
def q_arff_roundtrip(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal", "c_mktsegment"])
    path = files.scratch_path(spark, "customer-arff")
    files.write_arff(cust, path, "customer", ["c_custkey", "c_acctbal"], ["c_mktsegment"])
    back = files.read_arff(spark, path)
    return back.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"), F.round(
        F.sum(F.col("c_acctbal").cast("double").cast("decimal(38,9)")), 2).cast("double").alias("acctbal"))


@register("whitespace_roundtrip", """
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS orders, CAST(sum(o_custkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1""")
def q_whitespace_roundtrip(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    path = files.scratch_path(spark, "orders-txt")
    orders.select(F.concat_ws("   ", *[F.col(c).cast("string") for c in orders.columns]).alias("value")).write.mode("overwrite").text(path)
    back = files.read_whitespace(spark, path, orders.columns)
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_custkey").cast("bigint")).alias("key_sum"))


@register("json_roundtrip", with_ctes(acct_ctes()) + f"""
SELECT source_dataset, CAST(count(*) AS BIGINT) AS accounts, {sql_dround('avg(pd)', 6)} AS mean_score
FROM scored_y GROUP BY source_dataset""")
def q_json_roundtrip(spark, sf_dir):
    s = adapters.shared_scored(spark, sf_dir).select("account_id", "source_dataset", "pd")
    path = files.write_json_lines(s, files.scratch_path(spark, "scored-json"))
    back = files.read_json_document(spark, path, "account_id string, source_dataset string, pd double",
                                    multi_line=False)
    return back.groupBy("source_dataset").agg(F.count(F.lit(1)).alias("accounts"),
                                              dround(F.avg("pd"), 6).alias("mean_score"))


def _canon_sql(cols_types: list[tuple[str, str]]) -> str:
    parts = []
    for c, t in sorted(cols_types):
        v = f"CAST(round(CAST({c} AS DECIMAL(38,6)), 6) AS VARCHAR)" if t == "double" else f"CAST({c} AS VARCHAR)"
        parts.append(f"'{c}=' || coalesce({v}, '\\N')")
    return " || '|' || ".join(parts)


ORDERS_COLS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp"), ("o_orderpriority", "string")]


@register("content_hash", f"""
WITH h AS (SELECT CAST(CAST(('0x' || substr(sha256({_canon_sql(ORDERS_COLS)}), 1, 15)) AS UBIGINT) AS DECIMAL(38,0)) AS d
           FROM orders),
a AS (SELECT count(*) AS rows, CAST(sum(d) AS VARCHAR) AS digest_sum FROM h)
SELECT CAST(rows AS BIGINT) AS rows, digest_sum,
       substr(sha256(CAST(rows AS VARCHAR) || ':' || digest_sum), 1, 12) AS version FROM a""")
def q_content_hash(spark, sf_dir):
    return files.content_hash(read_table(spark, sf_dir, "orders", [c for c, _ in ORDERS_COLS]))


@register("split_manifest", f"""
WITH lines_o AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_extendedprice * (1 - l_discount)) AS net_revenue
  FROM lineitem GROUP BY l_orderkey),
loans AS (
  SELECT o.o_orderkey AS id, CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS target, o.o_totalprice AS loan_amnt
  FROM orders o),
r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) AS rk,
             count(*) OVER (PARTITION BY target) AS n FROM loans),
s AS (SELECT *, CASE WHEN rk <= floor(n * 0.6) THEN 'train' WHEN rk <= floor(n * 0.8) THEN 'validation' ELSE 'test' END AS split FROM r)
SELECT split, CAST(count(*) AS BIGINT) AS rows,
       CAST(sum(CAST(CAST(('0x' || substr(sha256({_canon_sql([('id', 'bigint'), ('target', 'int'), ('loan_amnt', 'double')])}), 1, 15)) AS UBIGINT) AS DECIMAL(38,0))) AS VARCHAR) AS digest_sum,
       'id,target,loan_amnt' AS columns
FROM s GROUP BY split""")
def q_split_manifest(spark, sf_dir):
    loans = adapters.vintage_loans(spark, sf_dir).select("id", "target", "loan_amnt")
    s = rs.stratified_split(loans, ["target"], "id")
    return files.write_splits(s, files.scratch_path(spark, "loan-splits"))


@register("file_checksums", lambda: with_ctes(acct_ctes(), decision_ctes()) + """,
b AS (SELECT DISTINCT action FROM reasons), n AS (SELECT count(*) AS n FROM b)
SELECT 'verified' AS status, CAST(n - 1 AS BIGINT) AS files FROM n
UNION ALL SELECT 'checksum-mismatch', CAST(1 AS BIGINT) FROM n UNION ALL SELECT 'missing', CAST(2 AS BIGINT) FROM n""")
def q_file_checksums(spark, sf_dir):
    """Write the totals of the decisions, a file for each action; verify the folder against a
    manifest that names two files more and has one wrong checksum."""
    from creditlens.operators.policy import decision_table
    from pyspark.sql import Window
    path = files.scratch_path(spark, "decisions-sum")
    totals = decision_table(decisions(spark, sf_dir)).groupBy("action").agg(
        F.count(F.lit(1)).alias("accounts"), F.sum(F.col("proposed_limit").cast("decimal(38,2)")).alias("proposed_limit"))
    totals.coalesce(1).write.partitionBy("action").option("header", True).csv(path)  # a row, and a file, per action
    made = files.hashed_files(spark, path).drop("length")
    first = F.row_number().over(Window.orderBy("file_name")) == 1  # a row per file
    manifest = made.withColumn("sha256", F.when(first, F.sha2(F.lit("other"), 256)).otherwise(F.col("sha256")))
    more = spark.createDataFrame([("absent-1.csv", "0" * 64), ("absent-2.csv", "0" * 64)], "file_name string, sha256 string")
    return files.verify_files(spark, path, manifest.unionByName(more)).groupBy("status").agg(F.count(F.lit(1)).alias("files"))


ORDERS_CSV_SCHEMA = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                     "o_orderdate timestamp_ntz, o_orderpriority string")
SEASONED_CUTOFF = "2000-12-31"


BAD_RATE_SQL = sql_dround("avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END)", 6)


@register("orders_csv_scan", f"""
SELECT year(o_orderdate) AS vintage, CAST(count(*) AS BIGINT) AS loans, {BAD_RATE_SQL} AS bad_rate
FROM orders WHERE o_orderdate <= TIMESTAMP '{SEASONED_CUTOFF} 00:00:00' AND o_orderstatus IN ('F', 'O')
GROUP BY 1""")
def q_orders_csv_scan(spark, sf_dir):
    """Out-of-core scan of a CSV export with the early filter pushed into the scan (IO3, IO5).

    Replaces a chunk loop: the scan is split into tasks by the reader, and the date and
    status predicates plus the column list reach the CSV scan (PushedFilters / ReadSchema).
    """
    path = files.write_csv(read_table(spark, sf_dir, "orders"), files.scratch_path(spark, "orders-csv"))
    o = files.read_csv(spark, path, ORDERS_CSV_SCHEMA, columns=["o_orderstatus", "o_orderdate"])
    kept = o.filter((F.col("o_orderdate") <= F.lit(f"{SEASONED_CUTOFF} 00:00:00").cast("timestamp_ntz"))
                    & F.col("o_orderstatus").isin("F", "O"))
    return kept.groupBy(F.year("o_orderdate").alias("vintage")).agg(
        F.count(F.lit(1)).alias("loans"),
        dround(F.avg((F.col("o_orderstatus") == "F").cast("double")), 6).alias("bad_rate"))


# Display rates (display units per INR) and the modelling-time source rate.
DISPLAY_RATES = {"INR": 1.0, "USD": 1.0 / 95.4, "EUR": 1.0 / 110.0}
SOURCE_TO_INR = {"TWD": 2.97, "USD": 83.0, "DEM": 45.0, "EUR": 90.0, "INR": 1.0}


@register("currency_localisation", with_ctes(acct_ctes(), decision_ctes()) + """,
rates AS (SELECT * FROM (VALUES ('INR', 1.0::DOUBLE), ('USD', 1.0::DOUBLE / 95.4), ('EUR', 1.0::DOUBLE / 110.0)) v(currency, rate))
SELECT r.currency, """ + sql_dround("sum(CAST(d.proposed_limit * r.rate AS DECIMAL(38,9)))") + """ AS proposed_limit,
       """ + sql_dround("sum(CAST(d.incremental_contribution * r.rate AS DECIMAL(38,9)))") + """ AS incremental_contribution
FROM reasons d, rates r GROUP BY r.currency""")
def q_currency_localisation(spark, sf_dir):
    """Display-currency conversion of the decisions through a rate table."""
    from creditlens.operators.explorer import localise
    d = decisions(spark, sf_dir)
    out = []
    for cur in DISPLAY_RATES:
        x = localise(d, ["proposed_limit", "incremental_contribution"], cur, DISPLAY_RATES)
        out.append(x.agg(F.lit(cur).alias("currency"),
                         F.round(F.sum(F.col("proposed_limit").cast("decimal(38,9)")), 2).cast("double").alias("proposed_limit"),
                         F.round(F.sum(F.col("incremental_contribution").cast("decimal(38,9)")), 2).cast("double")
                          .alias("incremental_contribution")))
    r = out[0]
    for o in out[1:]:
        r = r.unionByName(o)
    return r
