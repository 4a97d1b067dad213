"""Experiment (X1-X3) and ledger (L1-L4) queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from creditlens.functions.columns import dround, sql_dround
from creditlens.operators import experiment as xp
from creditlens.operators import ledger
from creditlens.plans.registry import register
from creditlens.sources import adapters
from creditlens.sources.adapters import REVIEW_DECISIONS, REVIEW_REASONS

ARM_SQL = ("list_element(['control', 'increase_10', 'increase_20', 'increase_30'], "
           "CAST(CAST(('0x' || substr(sha256('42:' || CAST(c_custkey AS VARCHAR)), 1, 16)) AS UBIGINT) % 4 + 1 AS INTEGER))")

PILOT_SQL = f"""
WITH lines_o AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_returned
  FROM lineitem GROUP BY l_orderkey),
per AS (
  SELECT o.o_custkey AS custkey,
         sum(CASE WHEN year(o.o_orderdate) < 1999 THEN o.o_totalprice ELSE 0.0 END) AS baseline_spend,
         sum(CASE WHEN year(o.o_orderdate) >= 1999 THEN o.o_totalprice ELSE 0.0 END) AS later_spend,
         sum(coalesce(l.n_lines, 0)) AS n_lines, sum(coalesce(l.n_returned, 0)) AS n_returned,
         max(CASE WHEN o.o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS accepted
  FROM orders o LEFT JOIN lines_o l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_custkey),
pilot AS (
  SELECT 'ACCT-' || printf('%012d', c.c_custkey) AS account_id, c.c_mktsegment AS segment,
         {ARM_SQL} AS arm, coalesce(p.baseline_spend, 0.0) AS baseline_spend,
         0.1 * coalesce(p.later_spend, 0.0) + (CASE {ARM_SQL} WHEN 'control' THEN 0.0 WHEN 'increase_10' THEN 0.1
              WHEN 'increase_20' THEN 0.2 ELSE 0.3 END) * coalesce(p.later_spend, 0.0) * 0.18 AS contribution,
         coalesce(CASE WHEN p.n_returned * 5 > p.n_lines * 2 THEN 1 ELSE 0 END, 0) AS delinquency,
         coalesce(p.accepted, 0) AS accepted
  FROM customer c LEFT JOIN per p ON c.c_custkey = p.custkey)"""


@register("arm_assignment", PILOT_SQL + """
SELECT arm, CAST(count(*) AS BIGINT) AS accounts FROM pilot GROUP BY arm""")
def q_arm_assignment(spark, sf_dir):
    p = adapters.pilot(spark, sf_dir)
    return p.groupBy("arm").agg(F.count(F.lit(1)).alias("accounts"))


PILOT_COLS = ["mean_contribution", "cuped_mean_contribution", "delinquency_rate", "acceptance_rate",
              "itt_contribution_delta", "cuped_contribution_delta", "delinquency_delta", "cuped_theta"]


@register("pilot_cuped", PILOT_SQL + f""",
st AS (SELECT covar_pop(contribution, baseline_spend) AS cv, var_pop(baseline_spend) AS vr,
              avg(baseline_spend) AS m FROM pilot),
th AS (SELECT CASE WHEN vr <> 0 THEN cv / vr ELSE 0.0 END AS theta, m FROM st),
per_arm AS (
  SELECT arm, count(*) AS rows, avg(contribution) AS mean_contribution,
         avg(contribution - theta * (baseline_spend - m)) AS cuped_mean_contribution,
         avg(CAST(delinquency AS DOUBLE)) AS delinquency_rate, avg(CAST(accepted AS DOUBLE)) AS acceptance_rate,
         max(theta) AS cuped_theta
  FROM pilot, th GROUP BY arm),
ctl AS (SELECT * FROM per_arm WHERE arm = 'control')
SELECT a.arm, CAST(a.rows AS BIGINT) AS rows,
  {sql_dround('a.mean_contribution', 6)} AS mean_contribution,
  {sql_dround('a.cuped_mean_contribution', 6)} AS cuped_mean_contribution,
  {sql_dround('a.delinquency_rate', 6)} AS delinquency_rate, {sql_dround('a.acceptance_rate', 6)} AS acceptance_rate,
  {sql_dround('a.mean_contribution - c.mean_contribution', 6)} AS itt_contribution_delta,
  {sql_dround('a.cuped_mean_contribution - c.cuped_mean_contribution', 6)} AS cuped_contribution_delta,
  {sql_dround('a.delinquency_rate - c.delinquency_rate', 6)} AS delinquency_delta,
  {sql_dround('a.cuped_theta', 6)} AS cuped_theta
FROM per_arm a, ctl c""")
def q_pilot_cuped(spark, sf_dir):
    r = xp.analyze_pilot(adapters.pilot(spark, sf_dir))
    return r.select("arm", "rows", *[dround(c, 6).alias(c) for c in PILOT_COLS])


MDE = 0.01


def _power_sql() -> str:
    za, zb = xp.z_values()
    p1, p2 = "base_rate", f"(base_rate + {MDE})"
    pooled = f"(({p1} + {p2}) / 2)"
    num = (f"power({za!r} * sqrt(2 * {pooled} * (1 - {pooled})) + {zb!r} * sqrt({p1} * (1 - {p1}) "
           f"+ {p2} * (1 - {p2})), 2)")
    return PILOT_SQL + f""",
rates AS (SELECT segment, avg(CAST(delinquency AS DOUBLE)) AS base_rate FROM pilot WHERE arm = 'control' GROUP BY segment)
SELECT segment, {sql_dround("base_rate", 6)} AS base_rate, {MDE!r}::DOUBLE AS minimum_detectable_effect,
  CASE WHEN base_rate > 0 AND base_rate < 1 AND base_rate + {MDE} < 1
       THEN CAST(ceil({num} / ({MDE} * {MDE})) AS BIGINT) END AS required_per_arm
FROM rates"""


@register("power_table", _power_sql)
def q_power_table(spark, sf_dir):
    p = adapters.pilot(spark, sf_dir)
    rates = p.filter(F.col("arm") == "control").groupBy("segment").agg(
        F.avg(F.col("delinquency").cast("double")).alias("base_rate"))
    return rates.select("segment", dround("base_rate", 6).alias("base_rate"),
                        F.lit(MDE).alias("minimum_detectable_effect"),
                        xp.required_sample(F.col("base_rate"), F.lit(MDE)).alias("required_per_arm"))


def _json_sql(prev: str) -> str:
    kv = []
    for k in ledger.HASH_KEYS:
        v = prev if k == "previous_hash" else f"e.{k}"
        kv.append(f"'\"{k}\":\"' || {v} || '\"'")
    return "sha256('{' || " + " || ',' || ".join(kv) + " || '}')"


LEDGER_EVENTS_SQL = f"""
ev AS (
  SELECT 'REV-' || printf('%09d', conv_id) AS review_id, CAST(turn AS BIGINT) AS seq,
         'ACC-' || printf('%06d', conv_id) AS account_id,
         CASE WHEN turn = 0 THEN 'submitted' WHEN turn = 1 THEN 'approved' ELSE 'noted' END AS event,
         role AS actor, list_element({list(REVIEW_DECISIONS)}, CAST(conv_id % 3 + 1 AS INTEGER)) AS decision,
         list_element({list(REVIEW_REASONS)}, CAST(conv_id % 5 + 1 AS INTEGER)) AS reason,
         '2024-01-01T00:' || printf('%02d', turn) || ':00+00:00' AS created_at,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS idx
  FROM conversations)"""

CHAIN_SQL = f"""WITH RECURSIVE {LEDGER_EVENTS_SQL},
chain AS (
  SELECT e.review_id, e.seq, e.idx, e.event, e.actor, 'GENESIS' AS previous_hash, {_json_sql("'GENESIS'")} AS event_hash
  FROM ev e WHERE e.idx = 1
  UNION ALL
  SELECT e.review_id, e.seq, e.idx, e.event, e.actor, c.event_hash, {_json_sql('c.event_hash')}
  FROM chain c JOIN ev e ON e.review_id = c.review_id AND e.idx = c.idx + 1)"""


@register("ledger_chain", CHAIN_SQL + """
SELECT review_id, seq, event, actor, previous_hash, event_hash FROM chain""")
def q_ledger_chain(spark, sf_dir):
    c = ledger.chain(adapters.ledger_events(spark, sf_dir))
    return c.select("review_id", "seq", "event", "actor", "previous_hash", "event_hash")


@register("ledger_verification", CHAIN_SQL + """
SELECT CAST(count(*) AS BIGINT) AS events, CAST(count(DISTINCT review_id) AS BIGINT) AS reviews,
       CAST(0 AS BIGINT) AS broken_links,
       -- an altered reason breaks its own hash; a lost second event breaks the link of the event after it
       CAST(sum(CASE WHEN seq = 0 AND CAST(substr(review_id, 5) AS BIGINT) % 11 = 0 AND idx = 1 THEN 1
                     WHEN idx = 3 AND CAST(substr(review_id, 5) AS BIGINT) % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS broken_in_altered
FROM chain""")
def q_ledger_verification(spark, sf_dir):
    """The chain as stored, and a copy with altered reasons and lost events, both verified."""
    c = ledger.chain(adapters.ledger_events(spark, sf_dir))
    number = F.expr("cast(substring(review_id, 5) as bigint)")
    lost = (F.col("idx") == 2) & (number % 7 == 0)
    altered = (c.withColumn("idx", F.row_number().over(Window.partitionBy("review_id").orderBy("seq"))).filter(~lost)
               .withColumn("reason", F.when((F.col("seq") == 0) & (F.col("idx") == 1) & (number % 11 == 0), F.lit("Altered")).otherwise(F.col("reason"))).drop("idx"))
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name)).withColumn("_k", F.lit(1))
    a = c.agg(F.count(F.lit(1)).alias("events"), F.countDistinct("review_id").alias("reviews")).withColumn("_k", F.lit(1))
    return (a.join(count(ledger.verify(c), "broken_links"), "_k").join(count(ledger.verify(altered), "broken_in_altered"), "_k").drop("_k"))


@register("ledger_violations", f"""WITH {LEDGER_EVENTS_SQL},
faulty AS (SELECT review_id, seq, event, reason,
             CASE WHEN CAST(substr(review_id, 5) AS BIGINT) % 19 = 0 THEN 'X-1' ELSE account_id END AS account_id,
             CASE WHEN event = 'approved' AND CAST(substr(review_id, 5) AS BIGINT) % 13 = 0 THEN NULL
                  WHEN event = 'submitted' AND CAST(substr(review_id, 5) AS BIGINT) % 23 = 0 THEN repeat('m', 90) ELSE actor END AS actor,
             CASE WHEN CAST(substr(review_id, 5) AS BIGINT) % 17 = 0 THEN NULL ELSE decision END AS decision FROM ev),
w AS (SELECT *, first_value(actor) OVER (PARTITION BY review_id ORDER BY seq) AS maker,
             lag(event) OVER (PARTITION BY review_id ORDER BY seq) AS prev_event FROM faulty),
r AS (
  SELECT review_id, seq, 'account_pattern' AS rule FROM w WHERE NOT coalesce(regexp_full_match(account_id, '^ACC-\\d{{6,}}$'), FALSE)
  UNION ALL SELECT review_id, seq, 'maker_identity' FROM w
    WHERE event = 'submitted' AND (coalesce(trim(actor), '') = '' OR length(actor) > {ledger.MAX_ACTOR_LENGTH})
  UNION ALL SELECT review_id, seq, 'governed_values' FROM w
    WHERE coalesce(decision NOT IN {tuple(REVIEW_DECISIONS)}, TRUE) OR coalesce(reason NOT IN {tuple(REVIEW_REASONS)}, TRUE)
  UNION ALL SELECT review_id, seq, 'approval_state' FROM w WHERE event = 'approved' AND coalesce(prev_event = 'submitted', FALSE) = FALSE
  UNION ALL SELECT review_id, seq, 'distinct_checker' FROM w
    WHERE event = 'approved' AND (coalesce(trim(actor), '') = '' OR lower(trim(actor)) = lower(trim(maker))))
SELECT review_id, seq, rule FROM r""")
def q_ledger_violations(spark, sf_dir):
    """Rule violations of the events, some of which are made faulty by their review number."""
    e = adapters.ledger_events(spark, sf_dir)
    number = F.expr("cast(substring(review_id, 5) as bigint)")
    e = (e.withColumn("account_id", F.when(number % 19 == 0, "X-1").otherwise(F.col("account_id")))
         .withColumn("actor", F.when((F.col("event") == "approved") & (number % 13 == 0), F.lit(None).cast("string"))
                     .when((F.col("event") == "submitted") & (number % 23 == 0), F.repeat(F.lit("m"), 90)).otherwise(F.col("actor")))
         .withColumn("decision", F.when(number % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("decision"))))
    return ledger.violations(ledger.chain(e))


@register("arm_tests", PILOT_SQL + f""",
a AS (SELECT arm, count(*) AS n, avg(CAST(delinquency AS DOUBLE)) AS rate FROM pilot GROUP BY arm),
z AS (SELECT a.arm, a.n, a.rate, (a.rate * a.n + c.rate * c.n) / (a.n + c.n) AS pooled, c.n AS n0, c.rate AS r0
      FROM a, a c WHERE c.arm = 'control' AND a.arm <> 'control'),
t AS (SELECT arm, n, rate, (rate - r0) / sqrt(pooled * (1 - pooled) * (1.0::DOUBLE / n + 1.0::DOUBLE / n0)) AS z FROM z),
p AS (SELECT *, {xp.normal_sf2_sql('z')} AS p_value FROM t),
o AS (SELECT *, row_number() OVER (ORDER BY p_value, arm) AS k, count(*) OVER () AS m FROM p),
h AS (SELECT *, max(least(1.0::DOUBLE, (m - k + 1) * p_value)) OVER (ORDER BY k) AS holm FROM o)
SELECT arm, CAST(n AS BIGINT) AS n, {sql_dround('rate', 6)} AS rate, {sql_dround('z', 6)} AS z, {sql_dround('p_value', 6)} AS p_value,
       {sql_dround('holm', 6)} AS holm_p, holm < 0.05 AS reject FROM h""")
def q_arm_tests(spark, sf_dir):
    """Arm-versus-control delinquency tests with Holm adjustment."""
    r = xp.arm_tests(adapters.pilot(spark, sf_dir))
    return r.select("arm", F.col("n").cast("bigint").alias("n"), dround("rate", 6).alias("rate"),
                    dround("z", 6).alias("z"), dround("p_value", 6).alias("p_value"),
                    dround("holm_p", 6).alias("holm_p"), "reject")
