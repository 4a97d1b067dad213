"""Adapters from the driver's TPC-H-style tables to the credit contracts.

Every adapter is a DataFrame job over the given tables, so its work grows with
the data.  Pre-aggregation happens before each join: line items collapse to one
row per order, orders collapse to one row per customer, so no join ever sees a
skewed key (a customer with a third of all orders is a single row after the
map-side partial aggregate).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.functions.columns import hash_uniform, pad_digits
from creditlens.sources.tables import read_table

# Fixed adapter constants (documented in FIXTURES.md, part B).
LATEST_YEAR = 2001            # period 1 = latest month = this order year
PERIODS = 6
AS_OF_DATE = "2001-12-31"
DAYS_PER_MONTH = 30.44
# TPC-H region name -> harmonized region category.
REGION_MAP = {"AMERICA": "north_america", "ASIA": "asia", "EUROPE": "europe"}
DEFAULT_REGION = "undisclosed"
# Deterministic scorecard: pd = sigmoid(intercept + b_dq * delinquency + b_util * utilization).
SCORE_INTERCEPT = -3.2
SCORE_DQ = 0.65
SCORE_UTIL = 0.8


def account_id(custkey) -> F.Column:
    return F.concat(F.lit("ACCT-"), pad_digits(F.col(custkey), 12))


def order_line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: line count, returned-line count, net revenue."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_extendedprice", "l_discount", "l_returnflag"])
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("n_returned"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_revenue"),
    )


def customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-customer six-period history as conditional aggregates (one shuffle on custkey)."""
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    lines = order_line_totals(spark, sf_dir)
    o = (orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
         .withColumn("period", F.lit(LATEST_YEAR + 1) - F.year("o_orderdate")))
    aggs = [
        F.count(F.lit(1)).alias("n_orders"),
        F.min("o_orderdate").alias("first_order"),
    ]
    for k in range(1, PERIODS + 1):
        in_k = F.col("period") == k
        aggs += [
            F.sum(F.when(in_k, F.col("o_totalprice"))).alias(f"bill_{k}"),
            F.sum(F.when(in_k, F.col("net_revenue"))).alias(f"rev_{k}"),
            F.count(F.when(in_k, F.lit(1))).alias(f"orders_{k}"),
            F.sum(F.when(in_k, F.coalesce(F.col("n_lines"), F.lit(0)))).alias(f"lines_{k}"),
            F.sum(F.when(in_k, F.coalesce(F.col("n_returned"), F.lit(0)))).alias(f"ret_{k}"),
        ]
    return o.groupBy(F.col("o_custkey").alias("custkey")).agg(*aggs)


def _pay_status(k: int) -> F.Column:
    n_o, n_l, n_r = F.col(f"orders_{k}"), F.col(f"lines_{k}"), F.col(f"ret_{k}")
    # integer comparisons: r >= 0.75 <=> 4*ret >= 3*lines ; r > 0.60 <=> 5*ret > 3*lines
    return (F.when(F.coalesce(n_o, F.lit(0)) == 0, F.lit(-2.0))
            .when(F.coalesce(n_l, F.lit(0)) == 0, F.lit(-1.0))
            .when(4 * n_r >= 3 * n_l, F.lit(2.0))
            .when(5 * n_r > 3 * n_l, F.lit(1.0))
            .otherwise(F.lit(0.0)))


def region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    mapped = F.lit(DEFAULT_REGION)
    for name, value in reversed(list(REGION_MAP.items())):
        mapped = F.when(F.upper(F.trim(F.col("r_name"))) == name, F.lit(value)).otherwise(mapped)
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
            .select("n_nationkey", F.coalesce(mapped, F.lit(DEFAULT_REGION)).alias("region")))


def acct6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-month history row (A2 shape) for every customer."""
    cust = read_table(spark, sf_dir, "customer",
                      ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    hist = customer_history(spark, sf_dir)
    j = cust.join(hist, cust.c_custkey == hist.custkey, "left")
    cols = [
        F.col("c_custkey"),
        account_id("c_custkey").alias("account_id"),
        F.col("c_nationkey"),
        F.col("c_mktsegment"),
        (F.lit(150000.0) + 100 * (F.col("c_acctbal") + 1000)).alias("LIMIT_BAL"),
    ]
    # Repayment-status names follow the legacy layout: PAY_0, PAY_2 .. PAY_6.
    for k in range(1, PERIODS + 1):
        name = "PAY_0" if k == 1 else f"PAY_{k}"
        cols.append(_pay_status(k).alias(name))
    for k in range(1, PERIODS + 1):
        cols.append(F.coalesce(F.col(f"bill_{k}"), F.lit(0.0)).alias(f"BILL_AMT{k}"))
    for k in range(1, PERIODS + 1):
        cols.append(F.coalesce(F.col(f"rev_{k}") / 4, F.lit(0.0)).alias(f"PAY_AMT{k}"))
    cols += [
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("bigint").alias("n_orders"),
        F.col("first_order"),
    ]
    return j.select(*cols)


PAY_COLUMNS = ["PAY_0"] + [f"PAY_{k}" for k in range(2, PERIODS + 1)]
BILL_COLUMNS = [f"BILL_AMT{k}" for k in range(1, PERIODS + 1)]
PAYMENT_COLUMNS = [f"PAY_AMT{k}" for k in range(1, PERIODS + 1)]


def profile(spark: SparkSession, sf_dir: str, history: DataFrame | None = None) -> DataFrame:
    """Harmonized profile (A1 shape) plus exposure fields and the raw history."""
    h = history if history is not None else acct6(spark, sf_dir)
    regions = region_lookup(spark, sf_dir)
    delinquency = sum(F.when(F.col(c) > 0, 1).otherwise(0) for c in PAY_COLUMNS)
    ck = F.col("c_custkey")
    return (h.join(regions, h.c_nationkey == regions.n_nationkey, "left").select(
        *[F.col(c) for c in h.columns],
        delinquency.cast("double").alias("delinquency_count"),
        F.least(F.col("BILL_AMT1") / F.col("LIMIT_BAL"), F.lit(5.0)).alias("utilization"),
        F.when(ck % 5 == 0, F.lit(None).cast("double"))
         .otherwise((ck % 97).cast("double") / 120.0).alias("debt_to_income"),
        F.col("n_orders").cast("double").alias("credit_lines"),
        F.lit(None).cast("double").alias("income_inr"),
        (F.datediff(F.lit(AS_OF_DATE).cast("date"), F.to_date("first_order")) / DAYS_PER_MONTH)
         .alias("credit_age_months"),
        F.coalesce(F.col("region"), F.lit(DEFAULT_REGION)).alias("region"),
        F.col("LIMIT_BAL").alias("current_limit_inr"),
        F.least(F.col("BILL_AMT1"), 2 * F.col("LIMIT_BAL")).alias("current_balance_inr"),
        F.col("c_mktsegment").alias("source_dataset"),
    ))


def score_expr(dq, util, with_util: bool = True) -> F.Column:
    z = F.lit(SCORE_INTERCEPT) + SCORE_DQ * F.col(dq)
    if with_util:
        z = z + SCORE_UTIL * F.col(util)
    return F.round(1 / (1 + F.exp(-z)), 6)


def scored(spark: SparkSession, sf_dir: str, prof: DataFrame | None = None) -> DataFrame:
    """Profile + deterministic scorecard pd, benchmark score and hash-drawn outcome."""
    p = prof if prof is not None else profile(spark, sf_dir)
    return (p.withColumn("pd", score_expr("delinquency_count", "utilization"))
             .withColumn("pd_benchmark", score_expr("delinquency_count", "utilization", False))
             .withColumn("y", (hash_uniform("y:", "account_id") < F.col("pd")).cast("int"))
             .withColumn("vintage", F.year("first_order")))


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring snapshot (A5 shape) from the events stream, one row per event.

    probability = least(value / 500, 1); outcome = error event; override = props.k
    divisible by 10; action = event type; period = 7-day window start (UTC).
    delinquency_count and utilization are derived from props.k and value.
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value", "props"])
    k = F.get_json_object("props", "$.k").try_cast("int")
    ts = F.col("ts").cast("timestamp")
    return ev.select(
        "event_id",
        ts.alias("ts"),
        F.to_date(F.window(ts, "7 days", startTime="4 days").start).alias("period"),
        F.least(F.col("value") / 500.0, F.lit(1.0)).alias("probability"),
        (F.col("event_type") == "error").cast("int").alias("outcome"),
        (k % 4).cast("double").alias("delinquency_count"),
        F.least(F.col("value") / 100.0, F.lit(5.0)).alias("utilization"),
        F.col("event_type").alias("action"),
        F.when(k.isNull(), F.lit(None)).otherwise((k % 10 == 0).cast("int")).alias("override"),
    )


PILOT_CUTOFF_YEAR = 1999


def pilot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Randomized-pilot table (A6 shape), one row per customer.

    baseline_spend = order value before 1999; contribution = 0.1 x later order
    value plus the arm's simulated response (increase x later value x 0.18);
    delinquency = returned-line share > 0.4; accepted = has an urgent order.
    """
    from creditlens.operators.experiment import ARM_INCREASE, assign_arm
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    lines = order_line_totals(spark, sf_dir)
    o = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    early = F.year("o_orderdate") < PILOT_CUTOFF_YEAR
    per = o.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.sum(F.when(early, F.col("o_totalprice")).otherwise(0.0)).alias("baseline_spend"),
        F.sum(F.when(~early, F.col("o_totalprice")).otherwise(0.0)).alias("later_spend"),
        F.sum(F.coalesce("n_lines", F.lit(0))).alias("n_lines"),
        F.sum(F.coalesce("n_returned", F.lit(0))).alias("n_returned"),
        F.max((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("accepted"))
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    j = cust.join(per, cust.c_custkey == per.custkey, "left")
    arm = assign_arm("c_custkey")
    inc = F.create_map(*[x for k, v in ARM_INCREASE.items() for x in (F.lit(k), F.lit(v))])[arm]
    later = F.coalesce("later_spend", F.lit(0.0))
    return j.select(
        account_id("c_custkey").alias("account_id"), F.col("c_mktsegment").alias("segment"),
        arm.alias("arm"),
        F.coalesce("baseline_spend", F.lit(0.0)).alias("baseline_spend"),
        (0.1 * later + inc * later * 0.18).alias("contribution"),
        F.coalesce((F.col("n_returned") * 5 > F.col("n_lines") * 2).cast("int"), F.lit(0)).alias("delinquency"),
        F.coalesce("accepted", F.lit(0)).alias("accepted"))


# Governed review decisions and reasons.
REVIEW_DECISIONS = ("Approve proposed action", "Hold current limit", "Freeze increases")
REVIEW_REASONS = ("Verified additional information", "Affordability concern",
                  "Recent repayment deterioration", "Policy exception declined",
                  "Escalated for specialist review")


def ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review events (A10 shape) from conversations: one review per conversation."""
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role"])
    dec = F.element_at(F.array(*[F.lit(d) for d in REVIEW_DECISIONS]), (F.col("conv_id") % 3 + 1).cast("int"))
    rea = F.element_at(F.array(*[F.lit(r) for r in REVIEW_REASONS]), (F.col("conv_id") % 5 + 1).cast("int"))
    return c.select(
        F.concat(F.lit("REV-"), pad_digits(F.col("conv_id"), 9)).alias("review_id"),
        F.col("turn").cast("bigint").alias("seq"),
        F.concat(F.lit("ACC-"), pad_digits(F.col("conv_id"), 6)).alias("account_id"),
        F.when(F.col("turn") == 0, "submitted").when(F.col("turn") == 1, "approved").otherwise("noted").alias("event"),
        F.col("role").alias("actor"), dec.alias("decision"), rea.alias("reason"),
        F.concat(F.lit("2024-01-01T00:"), pad_digits(F.col("turn"), 2), F.lit(":00+00:00"))
         .alias("created_at"))


_SHARED: dict = {}


def shared_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored-account table, persisted once per session and input directory.

    Many queries start from the same accounts; persisting the intermediate
    (memory, spilling to disk) avoids rebuilding the lineitem -> orders ->
    customer chain for each of them.  A lost executor's blocks are recomputed
    from lineage.
    """
    from pyspark import StorageLevel
    key = (spark.sparkContext.applicationId, sf_dir)
    df = _SHARED.get(key)
    if df is None:
        df = scored(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
        _SHARED[key] = df
    return df


def raw_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile before harmonization clean-up: unclipped utilisation and balance,
    raw lower-cased region names.  Input for contract validation."""
    s = shared_scored(spark, sf_dir)
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    names = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        "n_nationkey", F.lower(F.trim("r_name")).alias("raw_region"))
    return s.join(names, s.c_nationkey == names.n_nationkey, "left").select(
        "account_id", "delinquency_count", (F.col("BILL_AMT1") / F.col("LIMIT_BAL")).alias("utilization"),
        "debt_to_income", "credit_lines", "income_inr", "credit_age_months",
        F.col("raw_region").alias("region"), "current_limit_inr",
        F.col("BILL_AMT1").alias("current_balance_inr"))


def harmonization_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Three differently coded sources (B5): customers' card history, supplier ledgers, order loans."""
    regions = region_lookup(spark, sf_dir)
    cards = shared_scored(spark, sf_dir)
    sup = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey", "s_acctbal"])
    sup = sup.join(regions, sup.s_nationkey == regions.n_nationkey, "left")
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    cust = cust.join(regions, cust.c_nationkey == regions.n_nationkey, "left").select(
        "c_custkey", "region")
    loans = orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
    parts = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_type", "p_size", "p_retailprice"])
    return {"card_history": cards, "supplier_ledger": sup, "order_loans": loans, "coded_parts": parts}


def vintage_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vintage loans (A7 shape, B4): one row per order with order/line features."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    lines = order_line_totals(spark, sf_dir)
    o = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    return o.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("issue_date"),
        F.year("o_orderdate").alias("vintage"), (F.col("o_orderstatus") == "F").cast("int").alias("target"),
        F.col("o_totalprice").alias("loan_amnt"), F.coalesce("n_lines", F.lit(0)).cast("double").alias("n_lines"),
        F.coalesce("net_revenue", F.lit(0.0)).alias("net_revenue"))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents (B10): quality target, language cohort, whole-text length features."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "n_chars"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    j = labels.join(docs, "doc_id")
    words = F.size(F.split(F.trim(F.col("text")), r"\s+"))
    lines = F.size(F.split(F.col("text"), "\n"))
    return j.select("doc_id", F.col("quality").cast("double").alias("quality"), "lang",
                    F.col("n_chars").cast("double").alias("n_chars"), words.cast("double").alias("n_words"),
                    lines.cast("double").alias("n_lines"),
                    (F.col("n_chars") / F.greatest(words, F.lit(1))).alias("chars_per_word"))


def readiness_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regulated-market readiness records (A9 shape, B9), one per customer with orders.

    Timestamps are ISO-8601 strings with an offset; a few rows per rule break it
    by formula on the customer key (missing consent, no offset, no such day, future consent,
    negative obligation), others break it naturally (stale evidence, short
    history, negative balances, balance above twice the limit).
    """
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    per = o.groupBy(F.col("o_custkey").alias("ck")).agg(
        F.max("o_orderdate").alias("last_order"), F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)).alias("open_trades"),
        F.sum("o_totalprice").alias("spend"),
        F.countDistinct(F.date_format("o_orderdate", "yyyy-MM")).alias("statement_months"))
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal"])
    j = c.join(per, c.c_custkey == per.ck)
    ck = F.col("c_custkey")
    as_of = F.col("last_order") + F.expr("INTERVAL 1 DAY")
    fmt = lambda ts, off: F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(off))
    offset = F.lit("+05:30")
    part = F.when(ck % 3 == 0, F.lit(".250")).otherwise(F.lit(""))  # some instants carry a fraction
    iso = lambda ts: F.when(ck % 47 == 0, fmt(ts, "")).otherwise(F.concat(fmt(ts, ""), part, offset))
    consent_ts = F.when(ck % 43 == 0, as_of + F.expr("INTERVAL 2 DAYS")).otherwise(as_of - F.expr("INTERVAL 10 DAYS"))
    bureau = F.date_sub(F.to_date(as_of), (ck % 35).cast("int"))
    income = F.date_sub(F.to_date(as_of), (ck % 100).cast("int"))
    return j.select(
        account_id("c_custkey").alias("customer_reference"),
        iso(as_of).alias("as_of_date"),
        F.when(ck % 41 == 0, F.lit(None)).otherwise(F.concat(F.lit("CNS-"), ck.cast("string"))).alias("consent_reference"),
        F.when(ck % 59 == 0, F.lit("2001-13-41T00:00:00+05:30")).otherwise(iso(consent_ts)).alias("consent_timestamp"),
        iso(bureau.cast("timestamp_ntz")).alias("bureau_report_date"),
        (F.col("n_orders") % 3).cast("double").alias("bureau_dpd_30_12m"),
        (F.col("n_orders") % 2).cast("double").alias("bureau_dpd_90_24m"),
        F.col("open_trades").cast("double").alias("open_trades"),
        F.when(ck % 53 == 0, -F.col("spend") / 120.0).otherwise(F.col("spend") / 120.0).alias("total_monthly_obligation_inr"),
        (F.col("c_acctbal") * 10.0).alias("verified_monthly_income_inr"),
        iso(income.cast("timestamp_ntz")).alias("income_verified_at"),
        (F.lit(150000.0) + 100 * (F.col("c_acctbal") + 1000)).alias("current_limit_inr"),
        (F.col("spend") / 4.0).alias("current_balance_inr"),
        F.col("statement_months").cast("double").alias("statement_months"),
        F.concat(F.lit("LIN-"), ck.cast("string")).alias("data_lineage_id"))


def shared_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled-document features, persisted once per session and input directory.

    Word and line counts read the whole text of every document; model fitting
    passes over the table many times, so the features are computed once.
    """
    from pyspark import StorageLevel
    key = ("documents", spark.sparkContext.applicationId, sf_dir)
    df = _SHARED.get(key)
    if df is None:
        df = labelled_documents(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
        _SHARED[key] = df
    return df


def shared_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monitoring snapshot, persisted once per session (several monitoring branches read it)."""
    from pyspark import StorageLevel
    key = ("snapshot", spark.sparkContext.applicationId, sf_dir)
    df = _SHARED.get(key)
    if df is None:
        df = snapshot(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
        _SHARED[key] = df
    return df
