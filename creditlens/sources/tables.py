"""Parquet table scans with explicit column projection."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one table; a column list prunes the parquet read to those columns."""
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        df = df.select(*columns)
    return df


def register_views(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> None:
    for name in names or TABLES:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
