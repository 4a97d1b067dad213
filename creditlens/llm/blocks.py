"""Packed blocks: sums over keys that many chunks of documents share, without a row for each key.

A chunk sends its ascending distinct 64-bit keys, and a value for each, as one block for each
range of the key space.  A task that has all blocks of a range sums the values of equal keys
and answers each block with the totals, in the block's own order, so the answer needs no
keys.  Keys are hashes, so ranges of equal width have equally many, whatever is frequent:
a key has one entry for each chunk at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.llm.op3_token_files import filesystem
from creditlens.llm.shared import partitions, shared_folder

REQUEST = "kind int, part long, chunk long, keys binary, own binary"
_ANSWER = pa.schema([("kind", pa.int32()), ("part", pa.int64()), ("chunk", pa.int64()), ("task", pa.int64()), ("totals", pa.binary()),
                     ("distinct", pa.int64()), ("whole", pa.int64())])
ANSWER = "kind int, part long, chunk long, task long, totals binary, distinct long, whole long"


def pack(values: np.ndarray) -> bytes:
    """Integers of one type, byte plane by byte plane, so that equal high bytes lie together."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(raw: bytes, dtype: str) -> np.ndarray:
    kind = np.dtype(dtype)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def ranges_for(entries: int) -> int:
    """How many ranges the keys of so many entries are cut into: a power of two, about a million entries each."""
    return 1 << min(16, max(0, (entries >> 20).bit_length()))


def requests(kind: int, chunk: int, keys: np.ndarray, own: np.ndarray, n: int) -> pa.RecordBatch:
    """The blocks of ascending distinct unsigned keys and their values; n ranges."""
    shift = np.uint64(64 - (n.bit_length() - 1))
    part = keys >> shift if n > 1 else np.zeros(len(keys), dtype=np.uint64)
    first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    upto = np.r_[first[1:], len(keys)]
    steps = np.diff(keys, prepend=np.uint64(0))
    steps[first] = keys[first]
    blocks = [(kind, int(part[a]), chunk, pack(steps[a:b]), pack(own[a:b])) for a, b in zip(first.tolist(), upto.tolist())]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    columns = zip(*blocks) if blocks else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["kind", "part", "chunk", "keys", "own"])


def answered(asked: DataFrame, judge: Callable[[int, np.ndarray], np.ndarray]) -> tuple[str, DataFrame]:
    """Sum the requests over their keys; the folder of the answers and the answers.

    ``judge`` makes what is answered from a kind and its totals.  A chunk's number begins with
    its task (32 bits up); the answers of a task's chunks lie in one folder.
    """
    spark, folder = asked.sparkSession, shared_folder(asked.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def take(rows: list[tuple]) -> pa.RecordBatch:
            kind, part = rows[0][:2]
            keys = [np.cumsum(unpack(r[3], "<u8"), dtype=np.uint64) for r in rows]
            every = np.concatenate(keys)
            own = np.concatenate([unpack(r[4], "<i8") for r in rows])
            order = np.argsort(every, kind="stable")
            ascending = every[order]
            first = np.flatnonzero(np.r_[True, ascending[1:] != ascending[:-1]])
            sums = np.add.reduceat(own[order], first)
            said = np.empty(len(every), dtype=np.int64)
            said[order] = np.repeat(judge(kind, sums), np.diff(np.r_[first, len(every)]))
            cuts = np.cumsum([len(k) for k in keys])[:-1]
            n = len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * n, pa.int32()), pa.array([part] * n, pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                 pa.array([r[2] >> 32 for r in rows], pa.int64()), pa.array([pack(x) for x in np.split(said, cuts)], pa.binary()),
                 pa.array([int((sums > 0).sum())] + [0] * (n - 1), pa.int64()), pa.array([int(sums.sum())] + [0] * (n - 1), pa.int64())], schema=_ANSWER)

        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("kind", "part", "chunk", "keys", "own"))):
                if held and held[0][:2] != row[:2]:
                    yield take(held)
                    held = []
                held.append(row)
        if held:
            yield take(held)

    n = partitions(spark)
    out = asked.repartition(n, "kind", "part").sortWithinPartitions("kind", "part", "chunk").mapInArrow(run, ANSWER)
    out.repartition(n, "task").sortWithinPartitions("task", "chunk", "kind", "part").write.partitionBy("task").parquet(folder)
    return folder, spark.read.schema(ANSWER).parquet(folder)


def answers_to(folder: str, chunk: int) -> dict[int, np.ndarray]:
    """The answers to a chunk, by kind, in the order of the keys that it sent."""
    fs, path = filesystem(f"{folder}/task={chunk >> 32}")
    found: dict[int, list[tuple[int, bytes]]] = {}
    if fs.get_file_info(path).type != pa.fs.FileType.NotFound:
        for name in sorted(f.path for f in fs.get_file_info(pa.fs.FileSelector(path)) if f.path.endswith(".parquet")):
            with fs.open_input_file(name) as f:
                rows = pq.ParquetFile(f).read(columns=["kind", "part", "chunk", "totals"])
            rows = rows.filter(pa.compute.equal(rows.column("chunk"), chunk))
            for kind, part, raw in zip(*(rows.column(c).to_pylist() for c in ("kind", "part", "totals"))):
                found.setdefault(kind, []).append((part, raw))
    return {k: np.concatenate([unpack(raw, "<i8") for _, raw in sorted(v)]) for k, v in found.items()}
