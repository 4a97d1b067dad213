"""Queries of the ML stages (F18, M2, H14), seasoned-loan preparation (T6), history contracts and row guards."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from creditlens.functions.columns import dround, sql_dround
from creditlens.operators import contracts as ct
from creditlens.operators import seasoned
from creditlens.operators.features import FEATURE_NAMES
from creditlens.operators.stages import BehavioralFeatures, MedianImputer, MedianImputerModel
from creditlens.plans.features import feature_select_sql
from creditlens.plans.oracle_base import acct_ctes, with_ctes
from creditlens.plans.registry import register
from creditlens.sources import adapters, files
from creditlens.sources.tables import read_table


def _imputed_sql() -> str:
    one = " UNION ALL ".join(f"SELECT '{c}' AS feature, CASE WHEN substr(md5(account_id || '{c}'), 1, 1) <> '0' THEN {c} END AS v FROM f" for c in FEATURE_NAMES)
    return with_ctes(acct_ctes()) + f""",
f AS ({feature_select_sql()}), l AS ({one}),
m AS (SELECT feature, quantile_cont(v, 0.5) AS med FROM l GROUP BY 1)
SELECT l.feature, {sql_dround('max(med)', 6)} AS median, CAST(sum(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS imputed,
       {sql_dround('avg(coalesce(v, med))', 6)} AS mean_after FROM l JOIN m ON m.feature = l.feature GROUP BY 1"""


@register("imputed_features", _imputed_sql)
def q_imputed_features(spark, sf_dir):
    """The 17 features with one in sixteen left out, filled by stages that were saved and loaded."""
    path = files.scratch_path(spark, "stages")
    BehavioralFeatures().save(f"{path}/features")
    made = BehavioralFeatures.load(f"{path}/features").transform(adapters.acct6(spark, sf_dir))
    kept = made.select("account_id", *[F.when(F.substring(F.md5(F.concat("account_id", F.lit(c))), 1, 1) != "0", dround(c, 6)).alias(c) for c in FEATURE_NAMES])
    MedianImputer(inputCols=FEATURE_NAMES).fit(kept).save(f"{path}/imputer")
    model = MedianImputerModel.load(f"{path}/imputer")
    medians = dict(zip(model.getOrDefault(model.inputCols), model.getOrDefault(model.medians)))
    wide = model.transform(kept).agg(*[x for c in FEATURE_NAMES for x in (F.sum(f"{c}_missing").cast("bigint").alias(f"{c}_n"), F.avg(c).alias(f"{c}_m"))])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), dround(F.lit(medians[c]), 6).alias("median"), F.col(f"{c}_n").alias("imputed"),
                                                   dround(f"{c}_m", 6).alias("mean_after")) for c in FEATURE_NAMES])))


CUTOFF = dt.date(2000, 12, 31)
LOANS_CSV = "id long, issue_d string, term string, loan_status string, fico_range_low string, fico_range_high string"


def _export(spark, sf_dir):
    """A text export of orders as loans, some cells of it malformed, read back as text."""
    o, k = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_orderstatus"]), F.col("o_orderkey")
    out = o.select(
        k.alias("id"), F.when(k % 50 == 0, "n/a").when(k % 50 != 1, F.date_format("o_orderdate", "MMM-yyyy")).alias("issue_d"),
        F.when(k % 70 == 3, "unknown").when(k % 5 == 0, " 60 months").otherwise(" 36 months").alias("term"),
        F.when(F.col("o_orderstatus") == "F", "Charged Off").when(F.col("o_orderstatus") == "O", "Fully Paid").otherwise("Current").alias("loan_status"),
        F.when(k % 90 == 7, "x").otherwise((600 + k % 200).cast("string")).alias("fico_range_low"), (604 + k % 200).cast("string").alias("fico_range_high"))
    return files.read_csv(spark, files.write_csv(out, files.scratch_path(spark, "loans-csv")), LOANS_CSV)


_EXAMINED = f"""
WITH e AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 50 > 1 THEN date_trunc('month', o_orderdate) END AS issued, o_orderstatus AS s, o_orderkey % 90 = 7 AS bad,
  CASE WHEN o_orderkey % 50 <= 1 THEN 'date' WHEN o_orderkey % 70 = 3 THEN 'term' WHEN o_orderkey % 5 = 0 THEN 'other_term'
       WHEN date_trunc('month', o_orderdate) > DATE '{CUTOFF}' THEN 'late' WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status' END AS reason FROM orders)"""


@register("seasoned_loans", _EXAMINED + """
SELECT id, CAST(year(issued) AS INTEGER) AS vintage, CASE WHEN NOT bad THEN 602.0::DOUBLE + id % 200 END AS score_mean, CAST(bad AS INTEGER) AS malformed,
       CASE s WHEN 'F' THEN 1 ELSE 0 END AS target FROM e WHERE reason IS NULL""")
def q_seasoned_loans(spark, sf_dir):
    """Terminal 36-month loans issued up to the cut-off."""
    return seasoned.prepare(_export(spark, sf_dir), CUTOFF)


@register("seasoned_rejects", _EXAMINED + " SELECT reason, CAST(count(*) AS BIGINT) AS loans FROM e WHERE reason IS NOT NULL GROUP BY 1")
def q_seasoned_rejects(spark, sf_dir):
    return seasoned.rejects(_export(spark, sf_dir), CUTOFF)


HISTORY = ["LIMIT_BAL", *ct.PAY_COLUMNS, *ct.HISTORY_BILLS, *ct.PAYMENT_COLUMNS]
# Planted faults: column -> (every so many-th account, value), as both dialects read it.
PLANTED = {"LIMIT_BAL": (61, "'-5'"), "PAY_0": (11, "'12'"), "PAY_AMT1": (13, "'-1'"), "PAY_AMT2": (23, "'abc'"), "BILL_AMT1": (19, "NULL"), "BILL_AMT2": (29, "'Infinity'"),
           "current_limit_inr": (31, "'20000000'"), "current_balance_inr": (37, "'1e9'"), "account_id": (43, "'  '")}
TWICE = 47


def _planted(c: str, source: str | None = None) -> str:
    own = f"CAST({source or c} AS STRING)"
    return f"CASE WHEN c_custkey % {PLANTED[c][0]} = 0 THEN {PLANTED[c][1]} ELSE {own} END AS {c}" if c in PLANTED else f"{own} AS {c}"


def _history_sql() -> str:
    num = {c: f"try_cast({c} AS DOUBLE)" for c in [*HISTORY, *ct.EXPOSURE_COLUMNS]}
    any_of = lambda cols, cond: " OR ".join(cond.format(num[c]) for c in cols)
    lim, bal = num["current_limit_inr"], num["current_balance_inr"]
    rules = {"id_blank": "coalesce(trim(account_id), '') = ''", "history_blank_or_not_numeric": any_of(HISTORY, "{0} IS NULL"),
             "history_not_finite": any_of(HISTORY, "isnan({0}) OR isinf({0})"), "limit_not_positive": f"{num['LIMIT_BAL']} <= 0",
             "repayment_status_range": any_of(ct.PAY_COLUMNS, "{0} < -2 OR {0} > 9"), "payment_negative": any_of(ct.PAYMENT_COLUMNS, "{0} < 0"),
             "exposure_blank": f"{lim} IS NULL OR {bal} IS NULL", "exposure_not_finite": any_of(ct.EXPOSURE_COLUMNS, "isnan({0}) OR isinf({0})"),
             "limit_range": f"{lim} <= 0 OR {lim} > {ct.MAX_LIMIT}", "balance_range": f"{bal} < 0 OR {bal} > {lim} * 2"}
    cols = ", ".join([*[_planted(c) for c in ["account_id", *HISTORY]], _planted("current_limit_inr", "LIMIT_BAL"), _planted("current_balance_inr", "BILL_AMT1")])
    rows = " UNION ALL ".join(f"SELECT account_id, '{r}' AS rule FROM f WHERE coalesce({c}, FALSE)" for r, c in rules.items())
    return with_ctes(acct_ctes()) + f""",
p AS (SELECT c_custkey, {cols} FROM acct6), f AS (SELECT * FROM p UNION ALL SELECT * FROM p WHERE c_custkey % {TWICE} = 0)
{rows}
UNION ALL SELECT trim(account_id), 'id_duplicate' FROM f WHERE coalesce(trim(account_id), '') <> '' GROUP BY 1 HAVING count(*) > 1"""


@register("history_violations", _history_sql)
def q_history_violations(spark, sf_dir):
    """Violations of the six-month and exposure contracts, on planted faults."""
    p = adapters.acct6(spark, sf_dir).selectExpr("c_custkey", *[_planted(c) for c in ["account_id", *HISTORY]], _planted("current_limit_inr", "LIMIT_BAL"),
                                                 _planted("current_balance_inr", "BILL_AMT1"))
    return ct.behavioral_violations(p.unionByName(p.filter(F.col("c_custkey") % TWICE == 0)), "account_id")


@register("row_guards", lambda: with_ctes(acct_ctes()) + """
SELECT vintage, region, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT y) AS BIGINT) AS classes,
       CASE WHEN count(*) < 20 THEN 'too_few_rows' WHEN count(DISTINCT y) < 2 THEN 'one_class' END AS guard FROM scored_y GROUP BY 1, 2""")
def q_row_guards(spark, sf_dir):
    """Which vintages of a region hold enough rows and both classes to be modelled."""
    return ct.row_guards(adapters.shared_scored(spark, sf_dir), "y", ["vintage", "region"], min_rows=20)
