"""ML stages of our own, shared medians, and seasoned loans."""

import datetime as dt
import statistics

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from creditlens.operators import evaluate as ev
from creditlens.operators import harmonize as hz
from creditlens.operators import models, seasoned
from creditlens.operators.features import FEATURE_NAMES, engineer_features
from creditlens.operators.stages import BehavioralFeatures, MedianImputer, MedianImputerModel
from creditlens.sources import adapters


def test_pipeline_saved_loaded_and_scored(spark, small_dir, tmp_path):
    data = adapters.acct6(spark, small_dir).withColumn("y", (F.col("PAY_0") > 0).cast("int"))
    names = [f"{c}_missing" for c in FEATURE_NAMES]
    pipe = Pipeline(stages=[BehavioralFeatures(), MedianImputer(inputCols=FEATURE_NAMES), VectorAssembler(inputCols=FEATURE_NAMES + names, outputCol="features"),
                            LogisticRegression(featuresCol="features", labelCol="y", maxIter=10)])
    fitted = pipe.fit(data)
    fitted.save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    one, two = (sorted((r.account_id, r.p) for r in models.score(m, data).select("account_id", "p").collect()) for m in (fitted, again))
    assert one == two
    assert ev.discrimination(models.score(again, data), "p", "y").first().roc_auc > 0.8
    plain = engineer_features(data, keep=["account_id"])
    assert sorted(map(tuple, again.stages[0].transform(data).select("account_id", *FEATURE_NAMES).collect())) == sorted(map(tuple, plain.select("account_id", *FEATURE_NAMES).collect()))
    with pytest.raises(ValueError, match="LIMIT_BAL"):
        BehavioralFeatures().transform(data.drop("LIMIT_BAL"))


def test_imputer_cases(spark):
    rows = [(1.0, None, 5), (None, None, 7), (float("nan"), None, 7), (4.0, None, None), (9.0, None, 1)]
    df = spark.createDataFrame(rows, "a double, b double, c int")
    model = MedianImputer(inputCols=["a", "b", "c"]).fit(df)
    assert model.getOrDefault(model.medians) == [4.0, 0.0, 6.0]
    out = model.transform(df).collect()
    assert [(r.a, r.a_missing) for r in out] == [(1, 0), (4, 1), (4, 1), (4, 0), (9, 0)]
    assert {(r.b, r.b_missing) for r in out} == {(0.0, 1)} and [r.c for r in out] == [5, 7, 7, 6, 1]
    assert MedianImputer(inputCols=["a"], indicators=False).fit(df).transform(df).columns == df.columns
    with pytest.raises(ValueError, match="a_missing"):
        model.transform(df.withColumn("a_missing", F.lit(0)))
    assert MedianImputer(inputCols=["a", "c"]).fit(df.limit(0)).transform(df.limit(0)).count() == 0


def test_medians_of_groups(spark):
    rows = [(g, (i * 37 % 101) / 3 if i % 4 else None, float(i % 7)) for g in ("x", None) for i in range(60 + 3 * (g is None))]
    df = spark.createDataFrame(rows + [("empty", None, 1.0)], "g string, a double, b double")
    found = {(r.g, r.column): r.median for r in hz.column_medians(df, ["a", "b"], ["g"]).collect()}
    for g in ("x", None):
        for i, c in ((1, "a"), (2, "b")):
            assert abs(found[g, c] - statistics.median(r[i] for r in rows if r[0] == g and r[i] is not None)) < 1e-12
    assert ("empty", "a") not in found
    filled = hz.median_impute(df, ["a", "b"], ["g"]).filter("g is null or g <> 'empty'")
    assert filled.filter("a is null").count() == 0 and filled.agg(F.sum("a_missing")).first()[0] == sum(r[1] is None for r in rows)
    assert hz.median_impute(df, ["a"], ["g"]).filter("g = 'empty' and a is null").count() == 1


def test_seasoned_cells(spark):
    rows = [(1, "Dec-2015", " 36 months", "Fully Paid", "700", "704"), (2, "jan-2014", "36", "Default", "x", "704"), (3, "Dec-15", "36", "Default", "1", "2"),
            (4, None, "36", "Default", "1", "2"), (5, "Foo-2015", "36", "Default", "1", "2"), (6, "Jan-2015", "years", "Default", "1", "2"), (7, "Jan-2015", None, "Default", "1", "2"),
            (8, "Jan-2015", " 60 months", "Default", "1", "2"), (9, "Jan-2016", "36", "Default", "1", "2"), (10, "Jan-2015", "36", "Current", "1", "2"),
            (11, "Jan-2015", "36", None, "1", "2"), (12, "May-2015", "36 months", "Charged Off", None, ""), (12, "May-2015", "36 months", "Charged Off", None, "")]
    raw = spark.createDataFrame(rows, "id long, issue_d string, term string, loan_status string, fico_range_low string, fico_range_high string")
    cutoff = dt.date(2015, 12, 31)
    assert sorted(tuple(r) for r in seasoned.prepare(raw, cutoff).fillna(-1).collect()) == [
        (1, 2015, 702.0, 0, 0), (2, 2014, -1.0, 1, 1), (12, 2015, -1.0, 0, 1), (12, 2015, -1.0, 0, 1)]
    assert {r.reason: r.loans for r in seasoned.rejects(raw, cutoff).collect()} == {"date": 3, "term": 2, "other_term": 1, "late": 1, "status": 2}
    assert seasoned.prepare(raw.limit(0), cutoff).count() == 0


def test_row_guards(spark):
    from creditlens.operators import contracts as ct

    df = spark.createDataFrame([("a", 1), ("a", 0), ("a", None), ("b", 1), ("b", 1), ("b", 1), (None, 1)], "g string, y int")
    found = {r.g: (r.rows, r.classes, r.guard) for r in ct.row_guards(df, "y", ["g"], 3).collect()}
    assert found == {"a": (3, 2, None), "b": (3, 1, "one_class"), None: (1, 1, "too_few_rows")}
    assert ct.row_guards(df.limit(0), "y", ["g"]).count() == 0


def test_history_contract_rows(spark, small_dir):
    from creditlens.operators import contracts as ct

    good = adapters.acct6(spark, small_dir).withColumns({"current_limit_inr": F.col("LIMIT_BAL") + 1, "current_balance_inr": F.lit(5.0)}).limit(3)
    rows = good.collect()
    cols = {"PAY_AMT3": "payment_negative", "PAY_6": "repayment_status_range", "LIMIT_BAL": "limit_not_positive", "current_balance_inr": "balance_range"}
    assert ct.behavioral_violations(good, "account_id").count() == 0
    for c, rule in cols.items():
        worse = good.withColumn(c, F.when(F.col("account_id") == rows[0].account_id, F.lit(-7).cast(good.schema[c].dataType)).otherwise(F.col(c)))
        assert [tuple(r) for r in ct.behavioral_violations(worse, "account_id").collect()] == [(rows[0].account_id, rule)]
    again = good.unionByName(good.filter(F.col("account_id") == rows[1].account_id).withColumn("account_id", F.concat(F.lit(" "), "account_id")))
    assert [tuple(r) for r in ct.behavioral_violations(again, "account_id").collect()] == [(rows[1].account_id, "id_duplicate")]
