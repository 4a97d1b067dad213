"""File sources and sinks (IO1-IO11, IO14) and integrity checks (TC1-TC3).

Readers take an explicit schema (no inference on the hot path); text formats
are parsed with native string functions after ``spark.read.text``.  Sinks use
the DataFrame writer, whose job commit makes the output appear atomically.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlens.session import ensure_checkpoint_dir

# Upload guard limits of the batch contract.
MAX_UPLOAD_ROWS = 5_000
MAX_UPLOAD_BYTES = 5 * 1024 * 1024


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    return os.path.join(ensure_checkpoint_dir(spark), "files", f"{name}-{uuid.uuid4().hex[:10]}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, columns: list[str] | None = None,
             encoding: str = "UTF-8") -> DataFrame:
    """Header CSV with an explicit schema; a column list prunes the scan (IO1, IO2).

    A UTF-8 byte-order mark on the first header cell is tolerated (IO4).
    """
    df = (spark.read.option("header", True).option("encoding", encoding).option("enforceSchema", False)
          .schema(schema).csv(path))
    return df.select(*columns) if columns else df


def guard_rows(df: DataFrame, max_rows: int = MAX_UPLOAD_ROWS) -> DataFrame:
    """Row-limit guard for uploads: probes at most max_rows + 1 rows (IO4)."""
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"Upload exceeds {max_rows} rows")
    return df


def guard_bytes(spark: SparkSession, path: str, max_bytes: int = MAX_UPLOAD_BYTES) -> None:
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"Upload exceeds {max_bytes} bytes")


def _placed_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(v, _f, _at): trimmed lines with their file and their order in it.

    A task numbers its lines in order, and a file's splits are ordered by where they start.
    """
    return spark.read.option("encoding", encoding).text(path).select(
        F.trim("value").alias("v"), F.col("_metadata.file_path").alias("_f"),
        F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")).alias("_at"))


def read_arff(spark: SparkSession, path: str) -> DataFrame:
    """ARFF: names from @attribute lines, data lines after @data, '?' -> NULL (IO6).

    In a file with an @data line the data are the lines after the first of them, whatever
    they start with; a file without one holds data alone (a part of a folder that
    ``write_arff`` made).  Blank lines and lines that start with '%' are no data.  Values in
    single quotes may hold commas; a backslash keeps a quote.  Only the attribute names
    reach the driver.
    """
    lines = _placed_lines(spark, path)
    begins = (lines.filter(F.lower("v") == "@data").groupBy(F.col("_f").alias("_d")).agg(F.min("_at").alias("_from")))
    placed = lines.join(begins, F.col("_f") == F.col("_d"), "left")  # a row per file on the right
    attrs = (placed.filter(F.lower("v").startswith("@attribute") & (F.col("_at") < F.col("_from")))
             .select("_f", "_at", F.regexp_extract("v", r"(?i)^@attribute\s+('[^']+'|\"[^\"]+\"|\S+)", 1).alias("name"))
             .collect())
    names = [r["name"].strip("'\"") for r in sorted(attrs, key=lambda r: (r["_f"], r["_at"]))]
    data = placed.filter((F.col("v") != "") & ~F.col("v").startswith("%") & (F.col("_from").isNull() | (F.col("_at") > F.col("_from"))))
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    cells = F.from_csv("v", schema.simpleString()[7:-1].replace(":", " "), {"quote": "'", "escape": "\\", "nullValue": "?",
                                                                         "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
    return data.select(cells.alias("r")).select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)])


def write_arff(df: DataFrame, path: str, relation: str, numeric: list[str], nominal: list[str]) -> str:
    """ARFF sink: a one-partition header (ordered lines) followed by the data files.

    Text that holds a comma, a quote, a blank or a sign with a meaning of its own is quoted.
    """
    spark = df.sparkSession
    header = [f"% {relation}", f"@relation {relation}"]
    header += [f"@attribute {c} numeric" for c in numeric] + [f"@attribute {c} string" for c in nominal]
    header += ["", "@data"]
    head = spark.createDataFrame([(h,) for h in header], "value string").coalesce(1)  # a few lines

    def cell(c: str) -> Column:
        text = F.col(c).cast("string")
        quoted = F.concat(F.lit("'"), F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), "'", r"\\'"), F.lit("'"))
        return F.coalesce(F.when(text.rlike(r"[\s,'%@?\\]") | (text == ""), quoted).otherwise(text), F.lit("?"))

    body = df.select(F.concat_ws(",", *[cell(c) for c in numeric + nominal]).alias("value"))
    head.unionByName(body).write.mode("overwrite").text(path)
    return path


def read_whitespace(spark: SparkSession, path: str, names: list[str] | None = None,
                    encoding: str = "ISO-8859-1") -> DataFrame:
    """Whitespace-delimited text, blank lines skipped; header-less when ``names`` is given (IO7).

    Without names the first line of the first file is the header; it is skipped there and
    where another file starts with it.  Equal lines further down are data.
    """
    lines = _placed_lines(spark, path, encoding).filter("v != ''")
    parts = F.split("v", r"\s+")
    if names is None:
        tops = lines.groupBy(F.col("_f").alias("_t")).agg(F.min(F.struct("_at", "v")).alias("top"))  # a row per file
        header = tops.orderBy("_t").select("top.v").first()["v"]
        names = header.split()
        lines = (lines.join(tops.filter(F.col("top.v") == header).select("_t", F.col("top._at").alias("_skip")), F.col("_f") == F.col("_t"), "left")
                 .filter(F.col("_skip").isNull() | (F.col("_at") != F.col("_skip"))))
    return lines.select(*[parts[i].alias(n) for i, n in enumerate(names)])


def read_json_document(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                       multi_line: bool = True) -> DataFrame:
    """JSON: whole multi-line documents (IO8), or one document per line with ``multi_line=False``."""
    r = spark.read.option("multiLine", multi_line)
    return (r.schema(schema) if schema else r).json(path)


def write_csv(df: DataFrame, path: str) -> str:
    """CSV sink; the job committer publishes the folder atomically (IO9)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json_lines(df: DataFrame, path: str) -> str:
    """JSON evidence sink: one compact document per row (IO11)."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)
    return path


def canonical_row(columns: list[str]) -> Column:
    """Order-stable text of a row: sorted column names, doubles as DECIMAL(38,6) strings."""
    parts = []
    for c in sorted(columns):
        parts.append(F.concat(F.lit(c + "="), F.coalesce(F.col(c).cast("string"), F.lit("\\N"))))
    return F.concat_ws("|", *parts)


def canonical_frame(df: DataFrame) -> DataFrame:
    cols = []
    for name, dtype in df.dtypes:
        if dtype in ("double", "float") or dtype.startswith("decimal"):
            cols.append(F.round(F.col(name).cast("decimal(38,6)"), 6).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def content_hash(df: DataFrame) -> DataFrame:
    """Order-insensitive dataset checksum and 12-character version (TC2).

    Each canonical row is hashed; the digests' leading 60 bits are summed exactly
    (DECIMAL), so the result does not depend on row order or partitioning.
    """
    c = canonical_frame(df)
    h = F.sha2(canonical_row(c.columns), 256)
    agg = c.agg(F.count(F.lit(1)).alias("rows"),
                F.sum(F.conv(F.substring(h, 1, 15), 16, 10).cast("decimal(38,0)")).alias("digest_sum"))
    return agg.select("rows", F.col("digest_sum").cast("string").alias("digest_sum"),
                      F.substring(F.sha2(F.concat_ws(":", F.col("rows").cast("string"),
                                                     F.col("digest_sum").cast("string")), 256), 1, 12).alias("version"))


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> DataFrame:
    """Partitioned split sink plus a manifest: rows, order-insensitive checksum, columns (IO10)."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)
    back = df.sparkSession.read.parquet(path)
    data_cols = [x for x in back.columns if x != split_col]
    c = canonical_frame(back)
    h = F.conv(F.substring(F.sha2(canonical_row(data_cols), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return (c.groupBy(split_col).agg(F.count(F.lit(1)).alias("rows"), F.sum(h).cast("string").alias("digest_sum"))
             .withColumn("columns", F.lit(",".join(data_cols))))


def hashed_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file_name, sha256, length) of every file below ``folder``; names are relative to it.

    A file is one row, so this is for files of up to 2 GB; ``content_hash`` is for tables.
    """
    tail = folder.rstrip("/").rsplit("/", 1)[-1]
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
            .select(F.substring_index("path", f"/{tail}/", -1).alias("file_name"), F.sha2("content", 256).alias("sha256"), "length"))


def verify_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Checksum verification of files against a manifest (TC1).

    manifest(file_name, sha256) left-joined with the hashed files -> status
    verified / missing / checksum-mismatch.
    """
    files = hashed_files(spark, folder).withColumnRenamed("sha256", "actual_sha256")
    j = manifest.join(files, "file_name", "left")
    status = (F.when(F.col("actual_sha256").isNull(), "missing")
              .when(F.col("actual_sha256") == F.lower(F.col("sha256")), "verified").otherwise("checksum-mismatch"))
    return j.select("file_name", "sha256", "actual_sha256", status.alias("status"))


def sample_input(df: DataFrame, key: str, columns: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by key projected to the batch contract (IO14)."""
    return df.orderBy(key).limit(n).select(*columns)
