"""Spark ML training, selection and scoring.

Candidates are ``pyspark.ml`` pipelines over one assembled table; the split is
a column (T1), validation metrics reuse the distributed evaluators, and the
champion rule is: within 0.02 AUC of the best, then lowest Brier, then name.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.operators import evaluate as ev

SEED = 42
AUC_TOLERANCE = 0.02
BOOSTING_ROUNDS = 160
ROWS_A_PART = 4096  # training rows of a partition


def candidates(numeric: list[str], categorical: list[str], label: str, n_train: int, rounds: int = BOOSTING_ROUNDS) -> dict[str, Pipeline]:
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in categorical]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in categorical], outputCols=[f"{c}_ohe" for c in categorical],
                        handleInvalid="keep") if categorical else None
    feats = numeric + [f"{c}_ohe" for c in categorical]
    asm = VectorAssembler(inputCols=feats, outputCol="raw_features", handleInvalid="keep")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    pre = [*idx, *([ohe] if ohe else []), asm]
    # C = 0.5 in the sklearn parameterisation -> regParam = 1 / (C * n)
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / (0.5 * max(n_train, 1)),
                            elasticNetParam=0.0, maxIter=100)
    gbt = GBTClassifier(featuresCol="raw_features", labelCol=label, maxIter=rounds, stepSize=0.06, maxDepth=4,
                        seed=SEED)
    return {"Regularized logistic regression": Pipeline(stages=[*pre, scaler, lr]),
            "Gradient boosted trees": Pipeline(stages=[*pre, gbt])}


def packed(train: DataFrame, n: int) -> DataFrame:
    """``train`` of ``n`` rows in partitions that follow the rows: boosting runs several jobs a round over every partition, however empty."""
    return train.repartition(max(1, -(-n // ROWS_A_PART)))


def score(model, df: DataFrame) -> DataFrame:
    """Batch scoring: probability of the positive class (M7)."""
    return model.transform(df).withColumn("p", vector_to_array("probability")[1])


def train_select(df: DataFrame, numeric: list[str], categorical: list[str], label: str,
                 split_col: str = "split") -> DataFrame:
    """Fit every candidate on train, evaluate on validation, pick the champion; report test metrics."""
    from creditlens.operators.contracts import require_rows
    train = require_rows(df.filter(F.col(split_col) == "train"), 100, label)
    n_train = train.count()
    train = packed(train.select(*dict.fromkeys([*numeric, *categorical, label])), n_train).cache()
    rows = []
    for name, pipe in candidates(numeric, categorical, label, n_train).items():
        model = pipe.fit(train)
        scored = score(model, df.filter(F.col(split_col).isin("validation", "test")))
        m = (ev.discrimination(scored, "p", label, [split_col]).select(split_col, "roc_auc")
             .join(ev.proper_scores(scored, "p", label, [split_col]).select(split_col, "brier_score", "accounts"),
                   split_col))
        rows.append(m.withColumn("model", F.lit(name)))
    allm = rows[0]
    for r in rows[1:]:
        allm = allm.unionByName(r)
    from pyspark.sql import Window
    val = allm.filter(F.col(split_col) == "validation")
    w = Window.partitionBy(F.lit(0))  # one row per candidate model
    sel = (val.withColumn("eligible", F.col("roc_auc") >= F.max("roc_auc").over(w) - AUC_TOLERANCE)
              .withColumn("rank", F.row_number().over(w.orderBy(F.desc("eligible"), "brier_score", "model")))
              .select("model", (F.col("rank") == 1).alias("champion")))
    train.unpersist()
    return allm.join(sel, "model")


def sigmoid_calibrated(df: DataFrame, pipe: Pipeline, label: str, key: str, train_filter, folds: int = 3):
    """Cross-fitted sigmoid calibration (M3).

    Fold f fits the base pipeline on the other folds and a one-feature logistic
    calibrator on the held-out fold's raw scores; predictions average the calibrated
    probabilities of the fold models.  Returns a function DataFrame -> DataFrame with ``p_cal``.
    """
    from creditlens.operators.resample import hash_order
    train = df.filter(train_filter).withColumn(
        "_fold", F.pmod(F.conv(F.substring(hash_order(key, 7), 1, 8), 16, 10).cast("bigint"), F.lit(folds)))
    pairs = []
    for f in range(folds):
        base = pipe.fit(train.filter(F.col("_fold") != f))
        held = score(base, train.filter(F.col("_fold") == f)).select(
            F.col(label), F.array(F.log(F.col("p") / (1 - F.col("p")))).alias("_z"))
        from pyspark.ml.functions import array_to_vector
        cal = LogisticRegression(featuresCol="_zv", labelCol=label, regParam=0.0, maxIter=100).fit(
            held.select(label, array_to_vector("_z").alias("_zv")))
        pairs.append((base, cal))

    def predict(x: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector
        out = x
        for i, (base, cal) in enumerate(pairs):  # one narrow pass: each model adds its column to the same rows
            before = out.columns
            out = score(base, out).select(*before, array_to_vector(F.array(F.log(F.col("p") / (1 - F.col("p"))))).alias("_zv"))
            out = cal.transform(out).select(*before, vector_to_array("probability")[1].alias(f"_p{i}"))
        return out.withColumn("p_cal", sum(F.col(f"_p{i}") for i in range(len(pairs))) / len(pairs)).drop(
            *[f"_p{i}" for i in range(len(pairs))])
    return predict
