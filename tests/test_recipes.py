"""Cross-dataset recipes: figures against plain sums, and what test labels may change."""

import pytest
from pyspark.sql import functions as F

from creditlens.operators import recipes as rc


def table(spark, n=900):
    x = F.xxhash64("id") % 1000 / 1000.0
    return spark.range(n).select("id", F.when(F.col("id") % 17 > 0, x).alias("x"), (F.col("id") % 5).cast("double").alias("z"), (F.col("id") % 3).cast("string").alias("c"),
                               (x + F.pmod(F.xxhash64(F.col("id") + 7), F.lit(100)) / 100.0 > 0.6).cast("int").alias("y"))


def test_recipe_rows(spark):
    one = rc.Recipe("one", lambda s, d: table(s), "id", "y", ("x", "z"), ("c",))
    two = rc.Recipe("two", lambda s, d: table(s, n=400).withColumnRenamed("x", "other").filter("y is not null"), "id", "y", ("other",))
    rows = rc.run(spark, "", [one, two], rounds=5).collect()
    assert sorted((r.dataset, r.model) for r in rows) == sorted((d, m) for d in ("one", "two") for m in ("Gradient boosted trees", "Regularized logistic regression"))
    split = one.split(spark, "").cache()
    for d in ("one", "two"):
        assert sum(r.champion for r in rows if r.dataset == d) == 1
    own = [r for r in rows if r.dataset == "one"]
    assert all(r.rows == 900 and r.test_rows == split.filter("split = 'test'").count() for r in own)
    assert all(abs(r.risk_rate - split.agg(F.avg("y")).first()[0]) < 1e-12 and r.roc_auc > 0.7 for r in own)
    assert sorted(r.n for r in split.groupBy("key").agg(F.count(F.lit(1)).alias("n")).collect()) == [1] * 900
    split.unpersist()


def test_recipe_without_a_class(spark):
    with pytest.raises(ValueError, match="one: a split"):
        rc.run(spark, "", [rc.Recipe("one", lambda s, d: table(s).withColumn("y", F.lit(1)), "id", "y", ("x",))], rounds=2)
