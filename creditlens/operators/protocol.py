"""Select, freeze, refit and test once (M5, H12); one fit over time windows (E23); frozen-model calibration (M3).

The order is the contract.  Candidates are fitted on train and compared on validation; the
champion's recipe and its cost-optimal threshold are frozen; the recipe is fitted again on
the development set, train and validation together; test is read once.  A step out of
order, or a second look at test, is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.functions.columns import hash_uniform
from creditlens.operators import evaluate as ev
from creditlens.operators import models
from creditlens.operators import resample as rs
from creditlens.operators.contracts import require_rows
from creditlens.session import cut_lineage

DEVELOPMENT = ("train", "validation")


def measures(scored: DataFrame, label: str, threshold: float, group: str, score: str = "p") -> DataFrame:
    """AUC, average precision, Brier, log loss and the confusion at a carried threshold, per group."""
    return (ev.proper_scores(scored, score, label, [group]).join(ev.discrimination(scored, score, label, [group]), group)
            .join(ev.confusion(scored, threshold, score, label, [group]), group)
            .select(group, F.col("accounts").cast("bigint").alias("accounts"), F.col("positives").alias("events"), "event_rate", "roc_auc", "average_precision",
                    "brier_score", "log_loss", F.lit(float(threshold)).alias("threshold"), "tp", "fp", "tn", "fn", "precision", "recall", "f1"))


@dataclass(frozen=True)
class Frozen:
    """What selection decides, and nothing of it changes later."""

    champion: str
    threshold: float
    cost: int
    validation: tuple[tuple[str, float, float], ...]  # model, AUC, Brier


class Protocol:
    """One selection over a table with a ``split`` column of train, validation and test."""

    def __init__(self, df: DataFrame, recipes: dict[str, Pipeline], label: str, split: str = "split", min_rows: int = 100):
        if not recipes:
            raise ValueError("no candidate recipes")
        self.df, self.recipes, self.label, self.split, self.min_rows = df, recipes, label, split, min_rows
        self.frozen: Frozen | None = None
        self.model: PipelineModel | None = None
        self.development_rows: int | None = None
        self._tested = False

    def _rows(self, *splits: str) -> DataFrame:
        return self.df.filter(F.col(self.split).isin(*splits))

    def select(self) -> Frozen:
        """Fit every candidate on train, compare on validation, freeze champion and threshold."""
        if self.frozen:
            raise RuntimeError("the selection is frozen")
        train = require_rows(self._rows("train"), self.min_rows, self.label).persist()
        held = None
        for name, recipe in sorted(self.recipes.items()):
            own = models.score(recipe.fit(train), self._rows("validation")).select(F.lit(name).alias("model"), self.label, "p")
            held = own if held is None else held.unionByName(own)
        held = held.persist()  # each model scores validation once
        rows = (ev.discrimination(held, "p", self.label, ["model"]).select("model", "roc_auc")
                .join(ev.proper_scores(held, "p", self.label, ["model"]).select("model", "brier_score"), "model").collect())  # a row per candidate
        if any(r.roc_auc is None for r in rows) or not rows:
            raise ValueError("validation needs rows of both classes")
        best = max(r.roc_auc for r in rows)
        champion = min((r for r in rows if r.roc_auc >= best - models.AUC_TOLERANCE), key=lambda r: (r.brier_score, r.model)).model
        cut = ev.best_threshold(held.filter(F.col("model") == champion), "p", self.label).first()
        held.unpersist()
        train.unpersist()
        self.frozen = Frozen(champion, float(cut.threshold), int(cut.cost), tuple((r.model, r.roc_auc, r.brier_score) for r in sorted(rows)))
        return self.frozen

    def refit(self) -> PipelineModel:
        """Fit the frozen recipe on the development set."""
        if not self.frozen:
            raise RuntimeError("select before refit")
        if self.model is None:
            development = self._rows(*DEVELOPMENT).persist()
            self.development_rows = development.count()
            self.model = self.recipes[self.frozen.champion].fit(development)
            development.unpersist()
        return self.model

    def test(self) -> DataFrame:
        """Measures of the refitted champion on test at the frozen threshold: one row, once."""
        if self.model is None:
            raise RuntimeError("refit before test")
        if self._tested:
            raise RuntimeError("the test split has been used")
        self._tested = True
        scored = models.score(self.model, self._rows("test")).select(self.split, self.label, "p")
        return measures(scored, self.label, self.frozen.threshold, self.split)


def time_windows(df: DataFrame, key: str, date_col: str, holdout: float = 0.2) -> DataFrame:
    """``split``: train, random_test (a random share of the earliest 60 %), in_time (the next 20 %), out_of_time; undated rows have none."""
    cut = rs.quantile_split(df, date_col)
    return cut.withColumn("split", F.when((F.col("split") == "train") & (hash_uniform("window:", key) < holdout), "random_test")
                          .when(F.col("split") == "validation", "in_time").when(F.col("split") == "test", "out_of_time").otherwise(F.col("split")))


def by_window(windowed: DataFrame, year: str) -> DataFrame:
    """A row per window it belongs to: its split, and the vintage year of what is out of time."""
    own = F.array_compact(F.array(F.col("split"), F.when(F.col("split") == "out_of_time", F.concat(F.lit("vintage_"), F.col(year).cast("string")))))
    return windowed.filter("split is not null").withColumn("window", F.explode(own))


def fit_calibrator(scored: DataFrame, label: str, score: str = "p") -> LogisticRegressionModel:
    """A sigmoid around a model that stays as it is, from rows that it was not fitted on."""
    return LogisticRegression(featuresCol="_z", labelCol=label, regParam=0.0, maxIter=100).fit(scored.select(F.col(label), _logit(score).alias("_z")))


def _logit(score: str):
    p = F.least(F.greatest(F.col(score), F.lit(ev.EPS)), F.lit(1 - ev.EPS))
    return array_to_vector(F.array(F.log(p / (1 - p))))


def calibrated(calibrator: LogisticRegressionModel, scored: DataFrame, score: str = "p", out: str = "p_cal") -> DataFrame:
    """The rows with the calibrated probability beside the score, which keeps every bit."""
    columns = scored.columns
    return calibrator.transform(scored.withColumn("_z", _logit(score))).select(*columns, vector_to_array("probability")[1].alias(out))


def out_of_time(windowed: DataFrame, recipe: Pipeline, label: str, year: str) -> DataFrame:
    """One fit on train, one scoring pass over the other windows, the threshold frozen on in_time.

    ``brier_calibrated`` is after a calibrator fitted on in_time around the same model; for
    in_time itself it is of the rows it was fitted on.
    """
    model = recipe.fit(windowed.filter("split = 'train'"))
    scored = models.score(model, windowed.filter("split <> 'train'")).select("split", label, year, "p").persist()
    in_time = scored.filter("split = 'in_time'")
    threshold = ev.best_threshold(in_time, "p", label).first().threshold
    rows = by_window(calibrated(fit_calibrator(in_time, label), scored), year).persist()
    out = (measures(rows, label, float(threshold), "window")
           .join(ev.proper_scores(rows, "p_cal", label, ["window"]).select("window", F.col("brier_score").alias("brier_calibrated")), "window"))
    out = cut_lineage(out)  # a row per window
    rows.unpersist()
    scored.unpersist()
    return out
