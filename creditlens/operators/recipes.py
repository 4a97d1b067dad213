"""One training recipe over tables of different schema.

A ``Recipe`` names a table's key, label and inputs.  Each is split 60/20/20 within its label by
hash, medians and both candidates are fitted on train, scored rows are kept once, the champion
and each model's threshold come from validation, and test is read at that threshold.  Recipes are
independent of each other and run their jobs at the same time.

Rows without a label take no part; a recipe whose train, validation or test lacks a class raises ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.operators import models
from creditlens.operators.bundle import bundle
from creditlens.operators.resample import stratified_split
from creditlens.operators.stages import MedianImputer

RESULT = ("dataset string, model string, champion boolean, rows long, risk_rate double, test_rows long, threshold double, roc_auc double, "
          "average_precision double, brier_score double, log_loss double, precision double, recall double")


@dataclass(frozen=True)
class Recipe:
    dataset: str
    load: Callable[[SparkSession, str], DataFrame]
    key: str
    label: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = field(default=())

    def split(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """(key, y, inputs, split) of the labelled rows."""
        df = self.load(spark, sf_dir).select(F.col(self.key).alias("key"), F.col(self.label).cast("int").alias("y"), *self.numeric, *self.categorical)
        return stratified_split(df.filter("y is not null"), ["y"], "key")


def _run(recipe: Recipe, spark: SparkSession, sf_dir: str, rounds: int) -> list[tuple]:
    """A row per model, as RESULT has it."""
    data = recipe.split(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        numeric, categorical = list(recipe.numeric), list(recipe.categorical)
        train = data.filter("split = 'train'")
        shape = {r["split"]: r for r in data.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("events")).collect()}
        if any(s not in shape or not 0 < shape[s]["events"] < shape[s]["n"] for s in ("train", "validation", "test")):
            raise ValueError(f"{recipe.dataset}: a split lacks a class")
        rows, events = (sum(r[c] for r in shape.values()) for c in ("n", "events"))
        fill = MedianImputer(inputCols=numeric).fit(train)
        inputs = numeric + [f"{c}_missing" for c in numeric]
        found = {}
        for name, pipe in models.candidates(inputs, categorical, "y", shape["train"]["n"], rounds).items():
            model = pipe.fit(fill.transform(train))
            scored = models.score(model, fill.transform(data.filter("split <> 'train'"))).select("split", "y", "p").persist(StorageLevel.MEMORY_AND_DISK)
            try:
                val = bundle(scored.filter("split = 'validation'"), "p", "y").first()
                test = bundle(scored.filter("split = 'test'"), "p", "y", threshold=val["best_threshold"]).first()
            finally:
                scored.unpersist()
            found[name] = (val, test)
        best = max(v["roc_auc"] for v, _ in found.values())
        champion = min((v["brier_score"], n) for n, (v, _) in found.items() if v["roc_auc"] >= best - models.AUC_TOLERANCE)[1]
        return [(recipe.dataset, n, n == champion, rows, events / rows, t["accounts"], v["best_threshold"], t["roc_auc"], t["average_precision"], t["brier_score"],
                 t["log_loss"], t["precision"], t["recall"]) for n, (v, t) in found.items()]
    finally:
        data.unpersist()


def run(spark: SparkSession, sf_dir: str, recipes: list[Recipe], rounds: int = models.BOOSTING_ROUNDS, at_once: int = 3) -> DataFrame:
    """A row per dataset and model: champion, the threshold frozen on validation, and test metrics."""
    with ThreadPoolExecutor(at_once) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(_run), r, spark, sf_dir, rounds) for r in recipes]
        rows = [row for j in jobs for row in j.result()]  # a row per dataset and model
    return spark.createDataFrame(rows, RESULT)
