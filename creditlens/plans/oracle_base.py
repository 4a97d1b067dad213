"""DuckDB SQL building blocks for the oracle queries.

These CTEs restate the adapters and the decision policy in plain ANSI SQL
(window ranking instead of in-row arrays), so the oracle is an independent
formulation of the same semantics.
"""

from __future__ import annotations

from creditlens.operators.policy import PolicyAssumptions

PERIODS = range(1, 7)
PAY_NAMES = ["PAY_0"] + [f"PAY_{k}" for k in range(2, 7)]


def _hist_aggs() -> str:
    parts = []
    for k in PERIODS:
        parts += [
            f"sum(CASE WHEN period = {k} THEN o_totalprice END) AS bill_{k}",
            f"sum(CASE WHEN period = {k} THEN net_revenue END) AS rev_{k}",
            f"count(CASE WHEN period = {k} THEN 1 END) AS orders_{k}",
            f"sum(CASE WHEN period = {k} THEN coalesce(n_lines, 0) END) AS lines_{k}",
            f"sum(CASE WHEN period = {k} THEN coalesce(n_returned, 0) END) AS ret_{k}",
        ]
    return ",\n    ".join(parts)


def _acct_cols() -> str:
    parts = []
    for k, name in zip(PERIODS, PAY_NAMES):
        parts.append(
            f"CASE WHEN coalesce(h.orders_{k}, 0) = 0 THEN -2.0::DOUBLE "
            f"WHEN coalesce(h.lines_{k}, 0) = 0 THEN -1.0::DOUBLE "
            f"WHEN 4 * h.ret_{k} >= 3 * h.lines_{k} THEN 2.0::DOUBLE "
            f"WHEN 5 * h.ret_{k} > 3 * h.lines_{k} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {name}")
    for k in PERIODS:
        parts.append(f"coalesce(h.bill_{k}, 0.0::DOUBLE) AS BILL_AMT{k}")
    for k in PERIODS:
        parts.append(f"coalesce(h.rev_{k} / 4, 0.0::DOUBLE) AS PAY_AMT{k}")
    return ",\n    ".join(parts)


def acct_ctes() -> str:
    dq = " + ".join(f"CASE WHEN {c} > 0 THEN 1 ELSE 0 END" for c in PAY_NAMES)
    return f"""
lines_o AS (
  SELECT l_orderkey, count(*) AS n_lines,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_returned,
         sum(l_extendedprice * (1 - l_discount)) AS net_revenue
  FROM lineitem GROUP BY l_orderkey),
ord AS (
  SELECT o.o_custkey, o.o_totalprice, o.o_orderdate, 2002 - year(o.o_orderdate) AS period,
         l.n_lines, l.n_returned, l.net_revenue
  FROM orders o LEFT JOIN lines_o l ON o.o_orderkey = l.l_orderkey),
hist AS (
  SELECT o_custkey AS custkey, count(*) AS n_orders, min(o_orderdate) AS first_order,
    {_hist_aggs()}
  FROM ord GROUP BY o_custkey),
acct6 AS (
  SELECT c.c_custkey, 'ACCT-' || printf('%012d', c.c_custkey) AS account_id,
    c.c_nationkey, c.c_mktsegment,
    150000.0::DOUBLE + 100 * (c.c_acctbal + 1000) AS LIMIT_BAL,
    {_acct_cols()},
    CAST(coalesce(h.n_orders, 0) AS BIGINT) AS n_orders, h.first_order
  FROM customer c LEFT JOIN hist h ON c.c_custkey = h.custkey),
regions AS (
  SELECT n.n_nationkey,
         CASE upper(trim(r.r_name)) WHEN 'AMERICA' THEN 'north_america' WHEN 'ASIA' THEN 'asia'
              WHEN 'EUROPE' THEN 'europe' ELSE 'undisclosed' END AS region
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
profile AS (
  SELECT a.*,
    CAST({dq} AS DOUBLE) AS delinquency_count,
    least(a.BILL_AMT1 / a.LIMIT_BAL, 5.0::DOUBLE) AS utilization,
    CASE WHEN a.c_custkey % 5 = 0 THEN NULL::DOUBLE
         ELSE CAST(a.c_custkey % 97 AS DOUBLE) / 120.0::DOUBLE END AS debt_to_income,
    CAST(a.n_orders AS DOUBLE) AS credit_lines,
    NULL::DOUBLE AS income_inr,
    datediff('day', CAST(a.first_order AS DATE), DATE '2001-12-31') / 30.44::DOUBLE AS credit_age_months,
    coalesce(g.region, 'undisclosed') AS region,
    a.LIMIT_BAL AS current_limit_inr,
    least(a.BILL_AMT1, 2 * a.LIMIT_BAL) AS current_balance_inr,
    a.c_mktsegment AS source_dataset
  FROM acct6 a LEFT JOIN regions g ON a.c_nationkey = g.n_nationkey),
scored AS (
  SELECT p.*,
    round(1 / (1 + exp(-(-3.2::DOUBLE + 0.65::DOUBLE * delinquency_count + 0.8::DOUBLE * utilization))), 6) AS pd,
    round(1 / (1 + exp(-(-3.2::DOUBLE + 0.65::DOUBLE * delinquency_count))), 6) AS pd_benchmark,
    year(first_order) AS vintage
  FROM profile p),
scored_y AS (
  SELECT s.*,
    CASE WHEN CAST('0x' || substr(md5('y:' || account_id), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE < pd
         THEN 1 ELSE 0 END AS y
  FROM scored s)"""


def _lit(v: float) -> str:
    return f"{float(v)!r}::DOUBLE"


def decision_ctes(a: PolicyAssumptions | None = None, enabled: bool = True,
                  source: str = "scored_y") -> str:
    """Candidates, checks, chosen option and reasons (pre-allocation)."""
    a = a or PolicyAssumptions()
    L = {k: _lit(v) for k, v in a.to_dict().items()}
    en = "TRUE" if enabled else "FALSE"
    pcts = ", ".join(f"({_lit(p)})" for p in (0.0, 0.1, 0.2, 0.3))
    ead = lambda lim: (f"(least(greatest(bal, 0.0::DOUBLE), {lim}) + {L['ccf']} * "
                       f"greatest({lim} - least(greatest(bal, 0.0::DOUBLE), {lim}), 0.0::DOUBLE))")
    return f"""
beh AS (
  SELECT s.*, current_limit_inr AS lim, greatest(current_balance_inr, 0.0::DOUBLE) AS bal,
    least(greatest(coalesce(utilization,
          greatest(current_balance_inr, 0.0::DOUBLE) / greatest(current_limit_inr, 1.0::DOUBLE)),
          0.0::DOUBLE), 5.0::DOUBLE) AS util_b,
    (CASE WHEN delinquency_count IS NULL THEN 0 ELSE 1 END + CASE WHEN utilization IS NULL THEN 0 ELSE 1 END
     + CASE WHEN debt_to_income IS NULL THEN 0 ELSE 1 END + CASE WHEN credit_lines IS NULL THEN 0 ELSE 1 END
     + CASE WHEN credit_age_months IS NULL THEN 0 ELSE 1 END) AS hist
  FROM {source} s),
cand0 AS (
  SELECT b.*, p.pct, lim * (1 + p.pct) AS prop_limit
  FROM beh b, (VALUES {pcts}) p(pct)
  WHERE p.pct <= {L['max_increase']} + 1e-12),
cand1 AS (
  SELECT c.*, {ead('lim')} AS cur_ead, {ead('prop_limit')} AS prop_ead FROM cand0 c),
cand2 AS (
  SELECT c.*, pd * {L['lgd']} * cur_ead AS cur_ecl, pd * {L['lgd']} * prop_ead AS prop_ecl,
    prop_ead - cur_ead AS d_ead,
    (prop_limit - lim) * {L['response_elasticity']} * util_b * 12 AS spend
  FROM cand1 c),
cand AS (
  SELECT c.*,
    spend * {L['interchange_rate']} + spend * {L['revolving_rate']} * {L['apr']} - (prop_ecl - cur_ecl)
      - d_ead * {L['funding_cost']} - d_ead * {L['capital_cost']}
      - CASE WHEN pct <> 0 THEN {L['servicing_cost']} ELSE 0.0::DOUBLE END AS contrib
  FROM cand2 c),
checks AS (
  SELECT c.*,
    CASE WHEN d_ead > 0 THEN contrib / d_ead ELSE 0.0::DOUBLE END AS rar,
    {en} AS ck_enabled,
    pct <= {L['max_increase']} + 1e-12 AS ck_maxinc,
    prop_limit <= {L['max_account_exposure']} AS ck_exposure,
    pd * {L['lgd']} <= {L['expected_loss_ceiling']} AS ck_elc,
    contrib >= {L['profitability_hurdle']} AS ck_hurdle,
    coalesce(delinquency_count = 0, FALSE) AS ck_history,
    (util_b <= 1.10 AND (debt_to_income IS NULL OR debt_to_income <= 0.60)) AS ck_overext
  FROM cand c),
elig AS (
  SELECT c.*, (pct = 0 OR (ck_enabled AND ck_maxinc AND ck_exposure AND ck_elc AND ck_hurdle
                           AND ck_history AND ck_overext)) AS eligible,
    row_number() OVER (PARTITION BY account_id ORDER BY pct DESC) AS rn_last
  FROM checks c),
best AS (
  SELECT * FROM (
    SELECT e.*, row_number() OVER (PARTITION BY account_id ORDER BY contrib DESC, pct ASC) AS rn_best
    FROM elig e WHERE eligible) WHERE rn_best = 1),
warn AS (
  SELECT b.*,
    CASE WHEN hist < 2 OR delinquency_count IS NULL THEN 'insufficient'
         WHEN delinquency_count >= 2 THEN 'freeze'
         WHEN delinquency_count = 1 THEN 'reported'
         WHEN debt_to_income IS NOT NULL AND debt_to_income > 0.60 THEN 'overext'
         WHEN util_b > 1.10 THEN 'overext' END AS wstate
  FROM beh b),
decided AS (
  SELECT w.account_id, w.source_dataset, w.pd, w.utilization, w.current_limit_inr, w.util_b,
    w.delinquency_count, w.wstate,
    CASE WHEN w.wstate = 'freeze' THEN 'Freeze automatic increases'
         WHEN w.wstate IS NOT NULL THEN 'Manual review'
         WHEN NOT {en} THEN 'Manual review'
         WHEN s.pct = 0.0 THEN 'No change' WHEN s.pct = 0.1 THEN 'Increase 10%'
         WHEN s.pct = 0.2 THEN 'Increase 20%' WHEN s.pct = 0.3 THEN 'Increase 30%' END AS action,
    s.pct AS increase_pct,
    CASE WHEN w.pd < 0.05 THEN 'Low' WHEN w.pd < 0.15 THEN 'Moderate' WHEN w.pd < 0.30 THEN 'High'
         ELSE 'Very high' END AS risk_band,
    s.prop_limit AS proposed_limit, s.cur_ead AS current_ead, s.prop_ead AS proposed_ead,
    s.cur_ecl AS current_expected_loss, s.prop_ecl AS proposed_expected_loss,
    s.contrib AS incremental_contribution, s.rar AS risk_adjusted_return,
    l.ck_exposure AS last_exposure, l.ck_elc AS last_elc, l.ck_hurdle AS last_hurdle,
    l.ck_history AS last_history, l.ck_overext AS last_overext, l.ck_enabled AS last_enabled
  FROM warn w
  JOIN elig b0 ON b0.account_id = w.account_id AND b0.pct = 0.0
  JOIN elig l ON l.account_id = w.account_id AND l.rn_last = 1
  LEFT JOIN best bb ON bb.account_id = w.account_id
  JOIN elig s ON s.account_id = w.account_id
       AND s.pct = CASE WHEN w.wstate IS NOT NULL OR NOT {en} THEN 0.0 ELSE bb.pct END),
reasons AS (
  SELECT d.*,
    CASE WHEN wstate = 'insufficient' THEN 'Insufficient behavioral history | Manual review required'
         WHEN wstate = 'freeze' THEN 'Repeated delinquency'
         WHEN wstate = 'reported' THEN 'Reported delinquency | Manual review required'
         WHEN wstate = 'overext' THEN 'Customer-overextension safeguard | Manual review required'
         WHEN NOT {en} THEN 'Automatic increases disabled by governance control | Manual review required'
         ELSE coalesce(nullif(array_to_string(list_filter([
            CASE WHEN delinquency_count = 0 THEN 'No reported delinquency in the harmonized source fields' END,
            CASE WHEN util_b >= 0.65 AND pd < 0.15 THEN 'High utilization with low estimated risk' END,
            CASE WHEN util_b < 0.20 THEN 'Low utilization provides no evidence of additional need' END,
            CASE WHEN increase_pct = 0 AND NOT last_enabled THEN 'Automatic increases disabled by governance control' END,
            CASE WHEN increase_pct = 0 AND NOT last_exposure THEN 'Exposure limit reached' END,
            CASE WHEN increase_pct = 0 AND NOT last_elc THEN 'Expected loss exceeds policy ceiling' END,
            CASE WHEN increase_pct = 0 AND NOT last_hurdle THEN 'Incremental return below profitability hurdle' END,
            CASE WHEN increase_pct = 0 AND NOT last_history THEN 'Payment-history eligibility rule not met' END,
            CASE WHEN increase_pct = 0 AND NOT last_overext THEN 'Customer-overextension safeguard' END
            ], lambda x: x IS NOT NULL), ' | '), ''), 'Best eligible risk-adjusted contribution')
    END AS reason_codes
  FROM decided d)"""


DECISION_CTE_NAMES = ("beh", "cand0", "cand1", "cand2", "cand", "checks", "elig", "best", "warn",
                      "decided", "reasons")


def suffixed_decision_ctes(sfx: str, *args, **kwargs) -> str:
    """``decision_ctes`` with every CTE name suffixed, so several policies can coexist."""
    import re
    text = decision_ctes(*args, **kwargs)
    for name in DECISION_CTE_NAMES:
        text = re.sub(rf"\b{name}\b", f"{name}{sfx}", text)
    return text


def with_ctes(*blocks: str) -> str:
    return "WITH " + ",".join(blocks)
