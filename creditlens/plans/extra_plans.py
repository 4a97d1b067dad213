"""Resampling (E14, E15) and streaming (ST1) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions.columns import dround, sql_dround
from creditlens.operators import resample as rs
from creditlens.plans.registry import register
from creditlens.sources import adapters
from creditlens.streaming import monitor_stream

REPLICATES = 500


@register("bootstrap_ci")
def q_bootstrap_ci(spark, sf_dir):
    """Poisson(1) bootstrap intervals (rows-only check: replicate weights are hash-drawn)."""
    s = adapters.shared_scored(spark, sf_dir)
    r = rs.bootstrap_ci(s, "account_id", "pd", "y", REPLICATES)
    return r.select("metric", "replicates", *[dround(c, 6).alias(c) for c in ("lower", "upper", "mean")])


@register("paired_bootstrap")
def q_paired_bootstrap(spark, sf_dir):
    """Paired bootstrap of scorecard minus delinquency-only benchmark (shared weights)."""
    s = adapters.shared_scored(spark, sf_dir)
    r = rs.bootstrap_ci(s, "account_id", "pd", "y", REPLICATES, benchmark="pd_benchmark")
    return r.select("metric", "replicates", *[dround(c, 6).alias(c) for c in ("lower", "upper", "mean")])


@register("stream_monitoring", f"""
SELECT CAST(date_trunc('week', ts) AS DATE) AS period, CAST(count(*) AS BIGINT) AS rows,
       {sql_dround('avg(least(value / 500.0, 1.0))', 6)} AS mean_score,
       {sql_dround("avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END)", 6)} AS event_rate,
       CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS events
FROM events GROUP BY 1""")
def q_stream_monitoring(spark, sf_dir):
    t = monitor_stream.run_available(spark, sf_dir)
    return t.select("period", F.col("rows").cast("bigint").alias("rows"), dround("mean_score", 6).alias("mean_score"),
                    dround("event_rate", 6).alias("event_rate"), F.col("events").cast("bigint").alias("events"))


# Labelled documents and their hash split, as SQL.
SPLIT_SQL = """
d AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS rk,
             count(*) OVER (PARTITION BY quality) AS n FROM labels JOIN documents USING (doc_id)),
s AS (SELECT *, CASE WHEN rk <= floor(n * 0.6) THEN 'train' WHEN rk <= floor(n * 0.8) THEN 'validation' ELSE 'test' END AS split FROM d)"""


@register("ml_train_select", f"""WITH {SPLIT_SQL}
SELECT m.model, split, CAST(count(*) AS BIGINT) AS accounts, CAST(sum(quality) AS BIGINT) AS positives, TRUE AS better_than_chance,
       TRUE AS one_champion, TRUE AS champion_by_rule
FROM s, (SELECT unnest(['Gradient boosted trees', 'Regularized logistic regression']) AS model) m WHERE split <> 'train' GROUP BY 1, 2""")
def q_ml_train_select(spark, sf_dir):
    """Candidates on labelled documents: rows and events of each split, and whether the champion follows the rule."""
    from creditlens.operators import models
    s, r = _trained(spark, sf_dir)
    events = s.groupBy("split").agg(F.sum("quality").cast("bigint").alias("positives"))
    val = r.filter("split = 'validation'")
    top = val.agg(F.max("roc_auc").alias("top"), F.min(F.when(F.col("champion"), F.col("brier_score"))).alias("b"), F.sum(F.col("champion").cast("int")).alias("n"))
    rule = val.crossJoin(F.broadcast(top)).agg(  # a row per candidate against one row
        F.bool_and(F.col("n") == 1).alias("one_champion"),
        F.bool_and(F.when(F.col("champion"), F.col("roc_auc") >= F.col("top") - models.AUC_TOLERANCE)
                   .otherwise((F.col("roc_auc") < F.col("top") - models.AUC_TOLERANCE) | (F.col("brier_score") >= F.col("b")))).alias("champion_by_rule"))
    return (r.join(events, "split").crossJoin(F.broadcast(rule))
            .select("model", "split", F.col("accounts").cast("bigint").alias("accounts"), "positives", (F.col("roc_auc") > 0.5).alias("better_than_chance"),
                    "one_champion", "champion_by_rule"))


def _trained(spark, sf_dir):
    """The split documents, and the measures of each candidate on each split."""
    from creditlens.operators import models
    s = rs.stratified_split(adapters.shared_documents(spark, sf_dir), ["quality"], "doc_id").persist()
    return s, models.train_select(s, ["n_chars", "n_words", "n_lines", "chars_per_word"], ["lang"], "quality").persist()


@register("ml_train_select_scores")
def q_ml_train_select_scores(spark, sf_dir):
    """Candidates on labelled documents: AUC and Brier score of each split, and which one is the champion (no SQL)."""
    return _trained(spark, sf_dir)[1].select("model", "split", F.col("accounts").cast("bigint").alias("accounts"), "roc_auc", "brier_score", "champion")


@register("ml_calibration", f"""WITH {SPLIT_SQL}
SELECT m.model, CAST(count(*) AS BIGINT) AS accounts, CAST(sum(quality) AS BIGINT) AS positives, TRUE AS probabilities_valid, TRUE AS better_than_even
FROM s, (SELECT unnest(['uncalibrated', 'sigmoid_calibrated']) AS model) m WHERE split = 'test' GROUP BY 1""")
def q_ml_calibration(spark, sf_dir):
    """Test split before and after cross-fitted sigmoid calibration: rows, events, valid probabilities, Brier below 0.25."""
    from creditlens.operators import evaluate as ev
    raw, cal = _calibrated(spark, sf_dir)

    def m(x, col, name):
        p = F.col(col)
        valid = x.agg(F.bool_and((p >= 0) & (p <= 1)).alias("probabilities_valid"), F.sum("quality").cast("bigint").alias("positives"))
        return ev.proper_scores(x, col, "quality").select("brier_score", "accounts").crossJoin(F.broadcast(valid)).select(  # one row each
            F.lit(name).alias("model"), F.col("accounts").cast("bigint").alias("accounts"), "positives", "probabilities_valid",
            (F.col("brier_score") < 0.25).alias("better_than_even"))
    return m(raw, "p", "uncalibrated").unionByName(m(cal, "p_cal", "sigmoid_calibrated"))


def _calibrated(spark, sf_dir):
    """The test split scored before (p) and after (p_cal) calibration."""
    from creditlens.operators import models
    d = rs.stratified_split(adapters.shared_documents(spark, sf_dir), ["quality"], "doc_id").persist()
    num, cat = ["n_chars", "n_words", "n_lines", "chars_per_word"], ["lang"]
    train = d.filter("split = 'train'")
    pipe = models.candidates(num, cat, "quality", train.count())["Regularized logistic regression"]
    raw = models.score(pipe.fit(train), d.filter("split = 'test'"))
    predict = models.sigmoid_calibrated(d, pipe, "quality", "doc_id", F.col("split") == "train")
    return raw, predict(d.filter("split = 'test'"))


@register("ml_calibration_scores")
def q_ml_calibration_scores(spark, sf_dir):
    """Test split before and after cross-fitted sigmoid calibration: AUC and Brier score (no SQL)."""
    from creditlens.operators import evaluate as ev

    def m(x, col, name):
        return ev.proper_scores(x, col, "quality").select("brier_score", "accounts").crossJoin(F.broadcast(ev.discrimination(x, col, "quality").select("roc_auc"))).select(  # one row each
            F.lit(name).alias("model"), F.col("accounts").cast("bigint").alias("accounts"), "roc_auc", "brier_score")
    raw, cal = _calibrated(spark, sf_dir)
    return m(raw, "p", "uncalibrated").unionByName(m(cal, "p_cal", "sigmoid_calibrated"))


def _poisson_case(u: str) -> str:
    import math
    cdf, parts = 0.0, []
    for k in range(13):
        cdf += math.exp(-1.0) / math.factorial(k)
        parts.append(f"WHEN {u} < {cdf!r}::DOUBLE THEN {k}")
    return "CASE " + " ".join(parts) + " ELSE 13 END"


def _bootstrap_sql(paired: bool) -> str:
    from creditlens.operators.evaluate import EPS
    from creditlens.plans.oracle_base import acct_ctes, with_ctes
    eps = f"{EPS!r}::DOUBLE"

    def metric_ctes(col: str, sfx: str) -> str:
        pc = f"least(greatest({col}, {eps}), 1 - {eps})"
        return f""",
prop{sfx} AS (SELECT replicate, sum(weight * ({col} - y) * ({col} - y)) / sum(weight) AS brier_score,
              sum(weight * -(y * ln({pc}) + (1 - y) * ln(1 - {pc}))) / sum(weight) AS log_loss,
              sum(weight * y) / sum(weight) AS event_rate FROM w2 GROUP BY replicate),
h{sfx} AS (SELECT replicate, {col} AS score, sum(weight * y) AS pos, sum(weight * (1 - y)) AS neg FROM w2 GROUP BY 1, 2),
c{sfx} AS (SELECT *, sum(neg) OVER (PARTITION BY replicate ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
                 sum(pos) OVER (PARTITION BY replicate ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
                 sum(pos) OVER (PARTITION BY replicate) AS P, sum(neg) OVER (PARTITION BY replicate) AS N FROM h{sfx}),
m{sfx} AS (SELECT p.*, a.roc_auc, a.average_precision FROM prop{sfx} p JOIN (SELECT replicate,
             sum(pos * (N - fp + 0.5 * neg)) / (max(P) * max(N)) AS roc_auc,
             sum(pos * tp / (tp + fp)) / max(P) AS average_precision FROM c{sfx} WHERE P > 0 AND N > 0 GROUP BY replicate) a
           USING (replicate))"""
    u = ("CAST('0x' || substr(sha256('boot42:' || CAST((r.range - 1) // 8 AS VARCHAR) || ':' || s.account_id), 8 * ((r.range - 1) % 8) + 1, 8) AS BIGINT)"
         " / 4294967296.0::DOUBLE")
    body = with_ctes(acct_ctes()) + f""",
b AS (SELECT s.account_id, s.pd, s.pd_benchmark, CAST(s.y AS DOUBLE) AS y, r.range AS replicate, {u} AS u
      FROM scored_y s, range(1, {REPLICATES + 1}) r),
w2 AS (SELECT * FROM (SELECT *, {_poisson_case('u')} AS weight FROM b) WHERE weight > 0)"""
    body += metric_ctes("pd", "")
    names = ["roc_auc", "average_precision", "brier_score", "log_loss", "event_rate"]
    if paired:
        body += metric_ctes("pd_benchmark", "_b")
        body += ",\nmm AS (SELECT a.replicate, " + ", ".join(f"a.{n} - b.{n} AS {n}" for n in names) + \
                " FROM m a JOIN m_b b USING (replicate))"
        src = "mm"
    else:
        src = "m"
    return body + f""",
lng AS (SELECT metric, value FROM (UNPIVOT {src} ON {', '.join(names)} INTO NAME metric VALUE value))
SELECT metric, CAST(count(*) AS BIGINT) AS replicates, {sql_dround('quantile_cont(value, 0.025)', 6)} AS lower,
       {sql_dround('quantile_cont(value, 0.975)', 6)} AS upper, {sql_dround('avg(value)', 6)} AS mean
FROM lng GROUP BY metric"""


from creditlens.plans.registry import ORACLE  # noqa: E402

ORACLE["bootstrap_ci"] = _bootstrap_sql(False)
ORACLE["paired_bootstrap"] = _bootstrap_sql(True)
