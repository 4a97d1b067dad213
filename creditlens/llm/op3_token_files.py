"""Token ids as flat binary files with 64-bit document offsets.

Documents are range-partitioned and sorted by doc_id.  Each task writes one shard: a flat
file of little-endian unsigned ids (2 bytes each where the vocabulary allows, else 4), a
file of 64-bit offsets (one per document, and the end), and the doc_ids with a mask of
nulls.  A shard is written under a name of its attempt and then renamed, so a task that
runs again after a lost executor replaces its shard by the same bytes.  The bases of the
shards are prefix sums over one small row per shard.  Readers memory-map the shards.

Defined results: a null or empty text has the end id alone; null doc_ids come first; equal
doc_ids are ordered by a hash of their texts, and equal rows are written once each; an empty
table gives no shard with documents and no rows; other columns of the input are not read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.llm.encoding import encoder
from creditlens.llm.shared import partitions, shared_folder, text_or_empty

GROUP = 64  # texts encoded at once


@dataclass(frozen=True)
class TokenFiles:
    """Where the shards lie: (shard, base, documents, tokens) for each, in doc_id order."""

    folder: str
    dtype: str
    shards: tuple[tuple[int, int, int, int], ...]


def filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system and path of a shared folder's URI."""
    if uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pa.fs.FileSystem.from_uri(uri) if "://" in uri else (pa.fs.LocalFileSystem(), uri)


def _shard_names(path: str, shard: int) -> dict[str, str]:
    return {k: f"{path}/shard-{shard:07d}.{k}" for k in ("ids", "offsets", "docs", "nulls")}


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> TokenFiles:
    """Encode every whole text, append ``end_id`` and write the shards in ascending doc_id order."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark)
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    dtype = encoder(tokenizer).dtype.str

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_many
        end = np.array([end_id], dtype=dtype).tobytes()
        size = np.dtype(dtype).itemsize
        shard = TaskContext.get().partitionId()
        fs, path = filesystem(folder)
        names, tag = _shard_names(path, shard), uuid.uuid4().hex
        lengths, ids, nulls = [], [], []
        with fs.open_output_stream(f"{names['ids']}.{tag}") as out:
            for batch in batches:
                ids.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False))
                nulls.append(np.asarray(batch.column(0).is_null()))
                for at in range(0, batch.num_rows, GROUP):
                    raw = [x + end for x in encode(batch.column(1).slice(at, GROUP).to_pylist())]
                    lengths.extend(len(x) // size for x in raw)
                    out.write(b"".join(raw))
        offsets = np.concatenate([[0], np.cumsum(lengths, dtype="<i8")]).astype("<i8")
        rest = {"offsets": offsets, "docs": np.concatenate([*ids, []]).astype("<i8") if not ids else np.concatenate(ids).astype("<i8"),
                "nulls": np.concatenate(nulls).astype("u1") if nulls else np.zeros(0, "u1")}
        for kind, values in rest.items():
            with fs.open_output_stream(f"{names[kind]}.{tag}") as out:
                out.write(values.tobytes())
        for name in names.values():
            fs.move(f"{name}.{tag}", name)
        yield pa.RecordBatch.from_pydict({"shard": [shard], "documents": [len(lengths)], "tokens": [int(offsets[-1])]})

    by = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    done = (rows.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by)
            .mapInArrow(write, "shard long, documents long, tokens long").collect())  # a row per shard
    shards, base = [], 0
    for shard, documents, tokens in sorted(tuple(r) for r in done):
        if documents:
            shards.append((shard, base, documents, tokens))
        base += tokens
    files = TokenFiles(folder, dtype, tuple(shards))
    with fs.open_output_stream(f"{path}/manifest.json") as out:
        out.write(json.dumps({"dtype": dtype, "shards": files.shards}).encode())
    return files


def open_shard(folder: str, dtype: str, shard: int) -> dict[str, np.ndarray]:
    """A shard's arrays, memory-mapped where the shared folder is mounted, else read."""
    fs, path = filesystem(folder)
    kinds = {"ids": dtype, "offsets": "<i8", "docs": "<i8", "nulls": "u1"}
    names = _shard_names(path, shard)
    if isinstance(fs, pa.fs.LocalFileSystem):
        return {k: np.memmap(names[k], dtype=v, mode="r") for k, v in kinds.items()}
    return {k: np.frombuffer(fs.open_input_file(names[k]).read_buffer(), dtype=v) for k, v in kinds.items()}


def read_token_files(spark: SparkSession, files: TokenFiles, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, from the files."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    arrow = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
                      + [("ids", pa.binary())] * with_ids)
    folder, dtype = files.folder, files.dtype

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x = open_shard(folder, dtype, row["shard"])
                for at in range(0, row["documents"], 2048):
                    to = min(row["documents"], at + 2048)
                    offsets = np.asarray(x["offsets"][at:to + 1])
                    raw = [x["ids"][a:b].astype("<u4").tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                    columns = [pa.array(np.asarray(x["docs"][at:to]), mask=np.asarray(x["nulls"][at:to]).astype(bool)),
                               pa.array(offsets[:-1] + row["base"]), pa.array(np.diff(offsets)),
                               pa.array([zlib.crc32(r) for r in raw], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns + [pa.array(raw, pa.binary())] * with_ids, schema=arrow)

    rows = spark.createDataFrame(list(files.shards), "shard long, base long, documents long, tokens long")
    return rows.repartition(max(1, min(len(files.shards), partitions(spark)))).mapInArrow(read, schema)
