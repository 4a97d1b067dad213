"""Helpers of the training-data operators: shared folder, written tables, components, row keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below the folder that the cluster names in ``spark.checkpoint.dir``.

    Driver and executors all see that folder.  Only where the setting is absent (local
    tests) a folder of our own is made.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def fresh(n: int) -> list[str]:
    """Column names that no input has."""
    return [f"_{uuid.uuid4().hex}" for _ in range(n)]


def written(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends there."""
    path = shared_folder(df.sparkSession)
    writer = df.write.option("compression", compression) if compression else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """Partitions of an exchange by key: the session's setting, and no fewer than the cores."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and leave every other character as it is."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected edges (a, b) of longs: (node, component).

    ``component`` is the smallest node that can be reached.  Large-star and small-star
    steps in turn; every round is written to the shared folder, so a lost executor costs
    one round.  A star's centre may hold any share of the edges: the minima are summed
    map-side, and the joins have one row per node on one side, which adaptive execution
    can split.
    """
    edges = written(edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
                    .filter("u < v").distinct())
    before = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node joins the smallest of its neighbourhood
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("m").alias("u"), "v").filter("u < v").distinct())
        # small star: a node's smaller neighbours and the node itself join the smallest of them
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (large.join(least, "v").select(F.col("m").alias("u"), F.col("u").alias("v"))
                 .unionByName(least.select(F.col("m").alias("u"), "v")).filter("u < v").distinct())
        edges = written(small)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    star = edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return star.unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
