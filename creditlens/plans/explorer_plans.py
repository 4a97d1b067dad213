"""Explorer queries (P10, P15, S1-S3, IO12, IO14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions.columns import dround, sql_dround
from creditlens.operators import explorer as xr
from creditlens.plans.oracle_base import acct_ctes, decision_ctes, with_ctes
from creditlens.plans.portfolio import decisions
from creditlens.plans.registry import register
from creditlens.sources.tables import read_table

PAGE_NO = 3


def _explorer_rows(df):
    return df.select("account_id", "action", "risk_band", dround("pd", 6).alias("pd"),
                     dround("utilization", 6).alias("utilization"), dround("proposed_limit", 2).alias("proposed_limit"))


def _explorer_sql(where: str, order: str, tail: str) -> str:
    return with_ctes(acct_ctes(), decision_ctes()) + f"""
SELECT account_id, action, risk_band, {sql_dround('pd', 6)} AS pd, {sql_dround('utilization', 6)} AS utilization,
       {sql_dround('proposed_limit', 2)} AS proposed_limit{tail}
FROM reasons WHERE {where} ORDER BY {order}"""


FILTER_WHERE = ("risk_band = 'Moderate' AND delinquency_count = 0 AND utilization >= 0.6 AND utilization < 0.9 "
                "AND contains(lower(account_id), '1')")


@register("explorer_filter", lambda: _explorer_sql(FILTER_WHERE, "account_id", ""))
def q_explorer_filter(spark, sf_dir):
    d = decisions(spark, sf_dir)
    f = xr.filter_portfolio(d, search="1", risk="Moderate", delinquency="no", utilization_band="high")
    return _explorer_rows(f)


@register("explorer_page", lambda: "SELECT *, " + str(PAGE_NO) + " AS page FROM (" + _explorer_sql(
    "TRUE", "utilization DESC NULLS LAST, account_id", "") + f" LIMIT 25 OFFSET {(PAGE_NO - 1) * 25})")
def q_explorer_page(spark, sf_dir):
    d = decisions(spark, sf_dir)
    n = d.count()
    return xr.page(_explorer_rows(xr.sort_portfolio(d, "utilization", "desc")), PAGE_NO, n)


@register("explorer_last_page", lambda: "SELECT account_id, page FROM (SELECT account_id, rn, CAST(ceil(n / 25.0) AS INTEGER) AS page, n FROM ("
          "SELECT account_id, row_number() OVER (ORDER BY utilization DESC NULLS LAST, account_id) AS rn, count(*) OVER () AS n FROM ("
          + _explorer_sql("TRUE", "account_id", "") + "))) WHERE rn > (page - 1) * 25")
def q_explorer_last_page(spark, sf_dir):
    """A page number beyond the last is clamped to it."""
    d = decisions(spark, sf_dir)
    return xr.page(_explorer_rows(xr.sort_portfolio(d, "utilization", "desc")), 10**6, d.count()).select("account_id", "page")


@register("explorer_search", lambda: "SELECT * FROM (" + _explorer_sql(
    "contains(lower(account_id), '000000000012')", "account_id", "") + " LIMIT 8)")
def q_explorer_search(spark, sf_dir):
    return _explorer_rows(xr.search(decisions(spark, sf_dir), "000000000012"))


@register("safe_csv_cells", """
SELECT conv_id, turn, role,
       CASE WHEN substr(text, 1, 1) IN ('=', '+', '-', '@') THEN '''' || text ELSE text END AS text
FROM conversations""")
def q_safe_csv(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    return xr.safe_csv(c)
