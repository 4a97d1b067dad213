"""Batch re-decisioning and scoring jobs (D19, D21), micro-batch decisions (ST2), ML persistence."""

from __future__ import annotations

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from creditlens.functions.columns import dround
from creditlens.operators import contracts as ct
from creditlens.operators import explorer as xr
from creditlens.operators import policy
from creditlens.operators.explain import history_score
from creditlens.plans import portfolio
from creditlens.plans.oracle_base import acct_ctes, suffixed_decision_ctes, with_ctes
from creditlens.plans.registry import register
from creditlens.plans.summary_plans import SCENARIO
from creditlens.sources import adapters, files
from creditlens.sources.adapters import BILL_COLUMNS, PAY_COLUMNS, PAYMENT_COLUMNS

STORED_COLUMNS = ["account_id", "source_dataset", "pd", "delinquency_count", "utilization", "debt_to_income",
                  "credit_lines", "credit_age_months", "current_limit_inr", "current_balance_inr"]


def _summary_sql(decided: str) -> str:
    return f"""
SELECT action, CAST(count(*) AS BIGINT) AS accounts,
       CAST(ROUND(SUM(CAST(proposed_limit - current_limit_inr AS DECIMAL(38,9))), 2) AS DOUBLE) AS incremental_limit,
       CAST(ROUND(SUM(CAST(incremental_contribution AS DECIMAL(38,9))), 2) AS DOUBLE) AS simulated_contribution
FROM {decided} GROUP BY action"""


def _summary(d):
    return d.groupBy("action").agg(
        F.count(F.lit(1)).alias("accounts"),
        F.round(F.sum((F.col("proposed_limit") - F.col("current_limit_inr")).cast("decimal(38,9)")), 2)
         .cast("double").alias("incremental_limit"),
        F.round(F.sum(F.col("incremental_contribution").cast("decimal(38,9)")), 2).cast("double")
         .alias("simulated_contribution"))


@register("resimulate_existing", lambda: with_ctes(acct_ctes(), suffixed_decision_ctes("_s", SCENARIO))
          + _summary_sql("decided_s"))
def q_resimulate_existing(spark, sf_dir):
    """Re-decide a stored scored table under new assumptions without re-scoring."""
    path = files.scratch_path(spark, "stored-scores")
    adapters.shared_scored(spark, sf_dir).select(*STORED_COLUMNS).write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    return _summary(policy.decide(stored, SCENARIO))


@register("batch_score_decide", lambda: with_ctes(acct_ctes(), suffixed_decision_ctes("_d", None)) + _summary_sql("decided_d"))
def q_batch_score_decide(spark, sf_dir):
    """Validate the six-month batch contract, score it, decide, export formula-safe CSV."""
    s = adapters.shared_scored(spark, sf_dir)
    batch = s.select(F.col("account_id").alias("ACCOUNT_ID"), "LIMIT_BAL", *PAY_COLUMNS, *BILL_COLUMNS,
                     *PAYMENT_COLUMNS, "current_limit_inr", "current_balance_inr",
                     # profile fields travel with the batch for the policy's history checks
                     "delinquency_count", "utilization", "debt_to_income", "credit_lines", "credit_age_months",
                     "source_dataset")
    bad = ct.violations(batch, "ACCOUNT_ID", ct.behavioral_rules()).limit(1).count()
    if bad:
        raise ct.SchemaError("Batch violates the six-month history contract")
    scored = batch.withColumn("pd", history_score([F.col(c) for c in PAY_COLUMNS], F.col("BILL_AMT1"),
                                                  F.col("LIMIT_BAL"))).withColumnRenamed("ACCOUNT_ID", "account_id")
    d = policy.decide(scored)
    files.write_csv(xr.safe_csv(policy.decision_table(d)), files.scratch_path(spark, "batch-decisions"))
    return _summary(d)


@register("stream_decisions", lambda: with_ctes(acct_ctes(), suffixed_decision_ctes("_d", None)) + _summary_sql("decided_d"))
def q_stream_decisions(spark, sf_dir):
    """Micro-batch score-and-decide (ST2): per-account stages only, appended by foreachBatch."""
    src = files.scratch_path(spark, "stream-in")
    out = files.scratch_path(spark, "stream-out")
    adapters.shared_scored(spark, sf_dir).select(*STORED_COLUMNS).write.mode("overwrite").parquet(src)
    schema = spark.read.parquet(src).schema

    def decide_batch(batch_df, epoch_id):
        # a batch that runs again replaces its own folder
        policy.decision_table(policy.decide(batch_df)).write.mode("overwrite").parquet(f"{out}/epoch={epoch_id}")

    q = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).parquet(src).writeStream
         .foreachBatch(decide_batch).option("checkpointLocation", out + "-ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return _summary(spark.read.parquet(out).drop("epoch"))


def _ablation_sql() -> str:
    from creditlens.plans.extra_plans import SPLIT_SQL
    return f"""WITH {SPLIT_SQL}
SELECT f.feature_set, CAST(count(*) AS BIGINT) AS accounts, TRUE AS files_verified, TRUE AS auc_in_range, TRUE AS full_set_not_worse
FROM s, (SELECT unnest(['with_language', 'text_length_only', 'language_only']) AS feature_set) f WHERE split = 'test' GROUP BY 1"""


@register("ml_ablation", _ablation_sql)
def q_ml_ablation(spark, sf_dir):
    """Feature-set ablation with Spark ML; every pipeline is saved, all its files are checked
    against the manifest and it is read again before scoring (E22, M6)."""
    out = _ablation(spark, sf_dir)
    best = F.max(F.when(F.col("feature_set") == "language_only", F.col("roc_auc"))).over(Window.partitionBy(F.lit(0)))  # three rows
    full = F.max(F.when(F.col("feature_set") == "with_language", F.col("roc_auc"))).over(Window.partitionBy(F.lit(0)))
    return out.select("feature_set", "accounts", F.lit(True).alias("files_verified"), F.col("roc_auc").between(0, 1).alias("auc_in_range"),
                      (full >= best).alias("full_set_not_worse"))


@register("ml_ablation_scores")
def q_ml_ablation_scores(spark, sf_dir):
    """Feature-set ablation: the AUC of each set on the test split (no SQL)."""
    return _ablation(spark, sf_dir)


def _ablation(spark, sf_dir):
    from creditlens.operators import models, resample as rs
    from pyspark.ml import PipelineModel
    d = rs.stratified_split(adapters.shared_documents(spark, sf_dir), ["quality"], "doc_id").persist()
    sets = {"with_language": (["n_chars", "n_words", "n_lines", "chars_per_word"], ["lang"]),
            "text_length_only": (["n_chars", "n_words", "n_lines", "chars_per_word"], []),
            "language_only": ([], ["lang"])}
    rows = []
    train = d.filter("split = 'train'")
    n_train = train.count()
    for name, (num, cat) in sets.items():
        pipe = models.candidates(num, cat, "quality", n_train)["Regularized logistic regression"]
        path = files.scratch_path(spark, f"model-{name}")
        pipe.fit(train).write().overwrite().save(path)
        saved = files.hashed_files(spark, path).drop("length").collect()  # a few files of one model
        manifest = spark.createDataFrame(saved, "file_name string, sha256 string")
        if not saved or not files.verify_files(spark, path, manifest).filter("status <> 'verified'").isEmpty():
            raise RuntimeError("a saved model file is missing or altered")
        model = PipelineModel.load(path)
        from creditlens.operators import evaluate as ev
        sc = models.score(model, d.filter("split = 'test'"))
        rows.append(ev.discrimination(sc, "p", "quality").select(
            F.lit(name).alias("feature_set"), (F.col("positives") + F.col("negatives")).alias("accounts"), "roc_auc"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
