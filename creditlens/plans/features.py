"""Feature queries."""

from __future__ import annotations

from creditlens.functions.columns import dround, sql_dround
from creditlens.operators.features import FEATURE_NAMES, engineer_features, history_long
from creditlens.plans.oracle_base import acct_ctes, with_ctes
from creditlens.plans.registry import register
from creditlens.sources import adapters


def feature_select_sql() -> str:
    l_ = "greatest(LIMIT_BAL, 1.0::DOUBLE)"
    b = [f"greatest(BILL_AMT{i}, 0.0::DOUBLE)" for i in range(1, 7)]
    p = [f"greatest(PAY_AMT{i}, 0.0::DOUBLE)" for i in range(1, 7)]
    s = ["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]
    u = [f"({x} / {l_})" for x in b]
    r = [f"({p[i]} / greatest({b[i]}, 1.0::DOUBLE))" for i in range(6)]

    def mean(xs):
        return "((" + " + ".join(xs) + ") / " + str(len(xs)) + ")"

    def std(xs):
        m = mean(xs)
        return "sqrt((" + " + ".join(f"({x} - {m}) * ({x} - {m})" for x in xs) + ") / 5)"

    def cnt(xs, cond):
        return "CAST((" + " + ".join(f"CASE WHEN {x} {cond} THEN 1 ELSE 0 END" for x in xs) + ") AS DOUBLE)"

    f = {
        "limit_bal": l_,
        "current_utilization": u[0],
        "average_utilization": mean(u),
        "maximum_utilization": f"greatest({', '.join(u)})",
        "utilization_trend": f"({u[0]} - {u[5]})",
        "recent_payment_ratio": r[0],
        "average_payment_ratio": mean(r),
        "payment_consistency": f"({cnt(p, '> 0')} / 6.0::DOUBLE)",
        "delinquent_month_count": cnt(s, "> 0"),
        "maximum_delinquency_severity": "greatest(" + ", ".join(f"greatest({x}, 0.0::DOUBLE)" for x in s) + ")",
        "recent_payment_deterioration": f"({s[0]} - {mean(s[1:])})",
        "revolving_balance_proxy": f"(greatest({b[0]} - {p[0]}, 0.0::DOUBLE) / {l_})",
        "limit_headroom": f"(greatest({l_} - {b[0]}, 0.0::DOUBLE) / {l_})",
        "balance_volatility": f"({std(b)} / {l_})",
        "payment_volatility": f"({std(p)} / {l_})",
        "recent_balance_growth": f"(({b[0]} - {b[2]}) / {l_})",
        "inactive_month_count": cnt(b, "= 0"),
    }
    cols = ", ".join(f"{sql_dround(f'least(greatest({v}, -20.0::DOUBLE), 20.0::DOUBLE)', 6)} AS {k}"
                     for k, v in f.items())
    return f"SELECT account_id, year(first_order) AS vintage, {cols} FROM acct6"


def _feature_sql() -> str:
    return with_ctes(acct_ctes()) + f"\nSELECT * EXCLUDE (vintage) FROM ({feature_select_sql()})"


@register("behavioral_features", _feature_sql)
def q_behavioral_features(spark, sf_dir):
    f = engineer_features(adapters.shared_scored(spark, sf_dir), keep=["account_id"])
    return f.select("account_id", *[dround(c, 6).alias(c) for c in FEATURE_NAMES])


def _history_sql() -> str:
    parts = []
    for i in range(6):
        label = "Current" if i == 0 else f"M-{i}"
        parts.append(
            f"SELECT p.account_id, {5 - i} AS position, '{label}' AS period, "
            f"{sql_dround(f'BILL_AMT{i + 1}', 2)} AS bill, {sql_dround(f'PAY_AMT{i + 1}', 2)} AS payment, "
            f"{sql_dround(f'CASE WHEN current_limit_inr <> 0 THEN BILL_AMT{i + 1} / current_limit_inr ELSE 0.0 END', 6)} AS utilization, "
            f"CASE WHEN {['PAY_0', 'PAY_2', 'PAY_3', 'PAY_4', 'PAY_5', 'PAY_6'][i]} > 0 THEN 1 ELSE 0 END AS delinquency FROM profile p")
    return with_ctes(acct_ctes()) + "\n" + "\nUNION ALL\n".join(parts)


@register("history_long", _history_sql)
def q_history_long(spark, sf_dir):
    h = history_long(adapters.shared_scored(spark, sf_dir))
    return h.select("account_id", "position", "period", dround("bill", 2).alias("bill"),
                    dround("payment", 2).alias("payment"), dround("utilization", 6).alias("utilization"),
                    "delinquency")
