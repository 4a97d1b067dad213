"""Keyed zip of features, scores and ids (J2): bucketed, sorted tables joined without an exchange.

Each part is written once, hashed by its key into the same number of buckets and sorted within
them.  Joins, counts and anti joins on the key then read bucket by bucket.  The files lie in
the shared checkpoint folder; the tables are known to the session's catalog only.

Rows with a null key are faults and join nothing; a key that a part holds twice is a fault of that
part and joins all its rows; parts share no column but the key.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.session import ensure_checkpoint_dir


class Incomplete(ValueError):
    """Parts whose keys differ or repeat."""


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    spark = df.sparkSession
    name = f"part_{uuid.uuid4().hex}"
    # a writer's task holds one bucket, so that a bucket is one file
    (df.repartition(buckets, key).write.format("parquet").option("path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return spark.table(name)


class KeyedZip:
    """Parts by name, all keyed by ``key``."""

    def __init__(self, parts: dict[str, DataFrame], key: str, buckets: int | None = None):
        names = [c for p in parts.values() for c in p.columns if c != key]
        if len(set(names)) < len(names):
            raise ValueError("parts share a column besides the key")
        spark = next(iter(parts.values())).sparkSession
        self.key, self.buckets = key, buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.parts = {n: bucketed(p, key, self.buckets) for n, p in parts.items()}

    def rows(self) -> DataFrame:
        """All columns of the keys that every part has."""
        return reduce(lambda a, b: a.join(b.hint("merge"), self.key), self.parts.values())

    def faults(self) -> DataFrame:
        """(part, fault, key, rows): keys ``missing`` in a part that another part has, ``repeated`` keys, ``null`` keys."""
        key, out = F.col(self.key), []
        for name, part in self.parts.items():
            tagged = lambda df, fault, rows: df.select(F.lit(name).alias("part"), F.lit(fault).alias("fault"), key.alias("key"), rows.alias("rows"))  # noqa: B023, E731
            counts = part.groupBy(self.key).agg(F.count(F.lit(1)).alias("n"))
            out.append(tagged(counts.filter(key.isNull()), "null", F.col("n")))
            out.append(tagged(counts.filter(key.isNotNull() & (F.col("n") > 1)), "repeated", F.col("n")))
            lacking = [other.filter(key.isNotNull()).select(self.key).join(part.select(self.key).hint("merge"), self.key, "left_anti")
                       for n, other in self.parts.items() if n != name]
            out.append(tagged(reduce(DataFrame.unionByName, lacking).distinct(), "missing", F.lit(0).cast("bigint")))
        return reduce(DataFrame.unionByName, out)

    def complete(self) -> DataFrame:
        """``rows``, or an error that counts the faults."""
        found = {f"{r['part']}: {r['fault']}": r["keys"] for r in self.faults().groupBy("part", "fault").agg(F.count(F.lit(1)).alias("keys")).collect()}
        if found:
            raise Incomplete(", ".join(f"{k} {v}" for k, v in sorted(found.items())))
        return self.rows()
