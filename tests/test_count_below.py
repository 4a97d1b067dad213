"""Counting edges by halving, against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from creditlens.operators.evaluate import count_below


@pytest.mark.parametrize("most", [1, 2, 9, 255, 256])
def test_counts_the_edges_below(spark, most):
    rng = random.Random(most)
    rows = [(sorted(rng.randrange(40) / 4 for _ in range(rng.randrange(most + 1))), rng.choice([None, rng.randrange(-1, 45) / 4])) for _ in range(60)]
    rows += [(sorted(float(i) for i in range(most)), x) for x in (-1.0, 0.0, 0.5, most - 1.0, float(most))]
    found = spark.createDataFrame(rows, "e array<double>, x double").withColumn("n", count_below(F.col("e"), F.col("x"), most)).collect()
    assert [r["n"] for r in found] == [sum(e < r["x"] for e in r["e"]) if r["x"] is not None else 0 for r in found]


def test_cost_does_not_follow_the_edges(spark):
    one = spark.range(1).select(count_below(F.array(*[F.lit(float(i)) for i in range(250)]), F.col("id"), 250).alias("n"))
    plan = one._jdf.queryExecution().analyzed().toString()
    assert "aggregate(" in plan and "filter(" not in plan
