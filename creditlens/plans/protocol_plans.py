"""Model protocol and out-of-time evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions.columns import dround
from creditlens.operators import models, protocol
from creditlens.operators import resample as rs
from creditlens.plans.extra_plans import SPLIT_SQL
from creditlens.plans.registry import register
from creditlens.plans.resample_plans import LOANS_SQL
from creditlens.sources import adapters

NUMERIC, CATEGORICAL = ["n_chars", "n_words", "n_lines", "chars_per_word"], ["lang"]
LOAN_FEATURES = ["loan_amnt", "n_lines", "net_revenue"]
ROUNDS = 40   # boosting rounds: every candidate is fitted once, and the champion again
UNDATED = 97  # every so manyth loan has lost its issue date


def _split_documents(spark, sf_dir):
    return rs.stratified_split(adapters.shared_documents(spark, sf_dir), ["quality"], "doc_id")


@register("ml_development_set", f"""WITH {SPLIT_SQL},
r AS (SELECT split AS role, quality FROM s UNION ALL SELECT 'development', quality FROM s WHERE split IN ('train', 'validation'))
SELECT role, CAST(count(*) AS BIGINT) AS accounts, CAST(sum(quality) AS BIGINT) AS events FROM r GROUP BY role""")
def q_ml_development_set(spark, sf_dir):
    """Rows and events of each split, and of the development set that the champion is fitted on again."""
    roles = F.array_compact(F.array(F.col("split"), F.when(F.col("split").isin(*protocol.DEVELOPMENT), F.lit("development"))))
    return (_split_documents(spark, sf_dir).select(F.explode(roles).alias("role"), "quality").groupBy("role")
            .agg(F.count(F.lit(1)).alias("accounts"), F.sum("quality").cast("bigint").alias("events")))


def run_protocol(d):
    n_train = d.filter("split = 'train'").count()
    p = protocol.Protocol(d, models.candidates(NUMERIC, CATEGORICAL, "quality", n_train, rounds=ROUNDS), "quality")
    p.select()
    p.refit()
    return p


@register("ml_protocol")
def q_ml_protocol(spark, sf_dir):
    """Champion and threshold from validation, fitted again on the development set, measured once on test (no SQL)."""
    d = _split_documents(spark, sf_dir).persist()
    p = run_protocol(d)
    out = p.test().drop("split").select(F.lit(p.frozen.champion).alias("champion"), F.lit(p.development_rows).cast("bigint").alias("development_rows"), "*")
    return out


def windowed_loans(spark, sf_dir):
    loans = adapters.vintage_loans(spark, sf_dir).withColumn("issue_date", F.when(F.col("id") % UNDATED != 0, F.col("issue_date")))
    return protocol.time_windows(loans, "id", "issue_date")


_UNIFORM = "CAST('0x' || substr(md5('window:' || CAST(id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0"


@register("out_of_time_windows", LOANS_SQL + f""",
d AS (SELECT id, target, vintage, CASE WHEN id % {UNDATED} <> 0 THEN issue_date END AS issued FROM loans),
c AS (SELECT quantile_cont(epoch(issued), 0.6) AS c1, quantile_cont(epoch(issued), 0.8) AS c2, count(*) - count(issued) AS undated FROM d),
w AS (SELECT d.*, undated, CASE WHEN epoch(issued) <= c1 AND {_UNIFORM} < 0.2 THEN 'random_test' WHEN epoch(issued) <= c1 THEN 'train'
        WHEN epoch(issued) <= c2 THEN 'in_time' ELSE 'out_of_time' END AS split FROM d, c WHERE issued IS NOT NULL),
r AS (SELECT *, split AS \"window\" FROM w UNION ALL SELECT *, 'vintage_' || vintage FROM w WHERE split = 'out_of_time')
SELECT \"window\", CAST(count(*) AS BIGINT) AS accounts, CAST(sum(target) AS BIGINT) AS events, CAST(CAST(min(issued) AS DATE) AS VARCHAR) AS first_issue,
       CAST(CAST(max(issued) AS DATE) AS VARCHAR) AS last_issue, CAST(max(undated) AS BIGINT) AS undated_rows FROM r GROUP BY 1""")
def q_out_of_time_windows(spark, sf_dir):
    """Accounts, events and dates of each time window, and how many loans have no date."""
    w = windowed_loans(spark, sf_dir)
    undated = w.agg(F.sum(F.col("issue_date").isNull().cast("long")).alias("n")).first()["n"]
    return (protocol.by_window(w, "vintage").groupBy("window")
            .agg(F.count(F.lit(1)).alias("accounts"), F.sum("target").cast("bigint").alias("events"), F.min("issue_date").cast("date").cast("string").alias("first_issue"),
                 F.max("issue_date").cast("date").cast("string").alias("last_issue")).withColumn("undated_rows", F.lit(undated or 0).cast("bigint")))


def evidence(spark, sf_dir):
    w = windowed_loans(spark, sf_dir).withColumn("target", F.col("target").cast("double")).persist()
    n_train = w.filter("split = 'train'").count()
    recipe = models.candidates(LOAN_FEATURES, [], "target", n_train)["Regularized logistic regression"]
    out = protocol.out_of_time(w, recipe, "target", "vintage")
    w.unpersist()
    return out


@register("out_of_time_evidence")
def q_out_of_time_evidence(spark, sf_dir):
    """Random test, in-time, out-of-time and each later vintage from one fit and one scoring pass, the threshold
    frozen in time, Brier score before and after a calibrator around the same model (no SQL)."""
    m = evidence(spark, sf_dir)
    counts = ["accounts", "events", "tp", "fp", "tn", "fn", "threshold"]
    return m.select("window", *[c if c in counts else dround(c, 6).alias(c) for c in m.columns if c != "window"])
