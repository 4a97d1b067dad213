"""Mixture-controlled packing of documents into sequences by deficit round-robin over sources.

Every source is a queue of tokens.  In each round a queue's deficit grows by its quantum
(its target share of a window, in 1/65536 tokens), and the queue serves as many chunks of
``chunk`` tokens as its deficit covers; the rest is carried to the next round.  The rounds
laid end to end and cut at ``window`` tokens are the sequences, so a window strays from the
target proportions by a chunk for each queue at most (and one more).  What a queue has served after any
number of rounds has a closed form, so every task computes the deficits at its own rounds
and needs no other task's.  A queue that has run dry is passed over.  The rest that does not
fill a last window is cut into sequences whose lengths are powers of two: nothing is padded.

The targets are the queues' shares of all tokens, or given weights.  The 255 largest sources
have a queue each, all others share one more; so what is sent to every task is bounded.  The
shared queue is dealt in the same way by rounds of its own: a chunk's round follows from its
source's share alone (with a first deficit by the source's hash, so that small sources do not
all come last), and the places of rounds and of chunks in them are prefix sums by exchanges.
A weight for '' is for all sources of the shared queue that have none, by their tokens.

Defined results: a null text is empty, and an empty document is its end id alone; a null
source is a source of its own; repeated rows are packed once each; an empty table gives no
rows; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditlens.llm.encoding import encoder
from creditlens.llm.shared import text_or_empty, written

QUEUES = 255
GROUP = 64
KEEP = 400_000      # pieces of text whose ids a task remembers, where no other stage shares its Python workers
SHIFT = 16
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, source string")


def encoded(docs: DataFrame, tokenizer: str, end_id: int, keep: int = 200_000) -> DataFrame:
    """Every document's ids, written once: (doc_id, source, task, place, n_tokens, ids).

    ``place`` is the number of tokens before the document in its task and source.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer, keep)
        end, size = np.array([end_id], dtype=e.dtype).tobytes(), e.dtype.itemsize
        task, served = TaskContext.get().partitionId(), {}
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                part = batch.slice(at, GROUP)
                raw = [x + end for x in e.encode_many(part.column("text").to_pylist())]
                places = []
                for source, x in zip(part.column("source").to_pylist(), raw):
                    places.append(served.get(source, 0))
                    served[source] = places[-1] + len(x) // size
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("source"), pa.array([task] * len(raw), pa.int64()),
                     pa.array(places, pa.int64()), pa.array([len(x) // size for x in raw], pa.int64()), pa.array(raw, pa.binary())],
                    names=["doc_id", "source", "task", "place", "n_tokens", "ids"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), text_or_empty().alias("text"))
    return written(rows.mapInArrow(encode, "doc_id long, source string, task long, place long, n_tokens long, ids binary"))


class Rounds:
    """The closed form of the rounds: what each queue has served, and where in the whole."""

    def __init__(self, totals: list[int], weights: list[float] | None, window: int, chunk: int):
        whole = sum(totals)
        self.totals, self.window, self.chunk, self.whole = np.array(totals, dtype=np.int64), window, chunk, whole
        if weights is None:
            quanta = [max(1, (window * t << SHIFT) // whole) for t in totals]
        else:
            if min(weights) <= 0:
                raise ValueError("a queue's weight must be positive")
            quanta = [max(1, int(window * w / sum(weights) * (1 << SHIFT))) for w in weights]
        self.quanta = np.array(quanta, dtype=np.int64)
        full = whole // window * window
        tail = [1 << b for b in range(window.bit_length(), -1, -1) if (whole - full) >> b & 1]
        self.full, self.tail = full, full + np.concatenate([[0], np.cumsum(tail, dtype=np.int64)]).astype(np.int64)

    def served(self, rounds: np.ndarray) -> np.ndarray:
        """(rounds, queues): tokens served when so many rounds are over."""
        due = (rounds[:, None] * self.quanta[None, :]) >> SHIFT
        return np.minimum(due // self.chunk * self.chunk, self.totals[None, :])

    def serving(self, queue: np.ndarray, chunk_no: np.ndarray) -> np.ndarray:
        """The round, from 1, in which a queue's chunk is served."""
        quantum = self.quanta[queue]
        return (((chunk_no + 1) * self.chunk << SHIFT) + quantum - 1) // quantum

    def place(self, rounds: np.ndarray, queue: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The place in the whole of a queue's token ``at``, which its round serves."""
        out = np.empty(len(at), dtype=np.int64)
        for lo in range(0, len(at), 4096):
            s = slice(lo, lo + 4096)
            own, back = np.unique(rounds[s], return_inverse=True)
            before, after = self.served(own - 1), self.served(own)
            ahead = np.cumsum(after - before, axis=1) - (after - before)  # of the queues before it in the round
            base = before.sum(axis=1)
            q = queue[s]
            out[s] = base[back] + ahead[back, q] + at[s] - before[back, q]
        return out

    def cut(self, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
        """Split intervals of the whole at the ends of sequences: (interval, start, length, sequence, offset)."""
        end, w = start + length, self.window
        n = np.where(length > 0, (end - 1) // w - start // w + 1, 0)
        of = np.repeat(np.arange(len(start)), n)
        k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        seq = start[of] // w + k
        a, b = np.maximum(start[of], seq * w), np.minimum(end[of], (seq + 1) * w)
        late = np.flatnonzero(a >= self.full)
        rows = []
        for i in late:  # fewer than a window's tokens
            for j in range(len(self.tail) - 1):
                x, y = max(a[i], self.tail[j]), min(b[i], self.tail[j + 1])
                if x < y:
                    rows.append((of[i], x, y, self.full // w + j, x - self.tail[j]))
        keep = a < self.full
        out = [of[keep], a[keep], b[keep], seq[keep], (a - seq * w)[keep]]
        if rows:
            out = [np.concatenate([o, np.array(c, dtype=np.int64)]) for o, c in zip(out, zip(*rows))]
        return out[0], out[1], out[2] - out[1], out[3], out[4]


def _deal(chunk: int, size: int):
    """mapInArrow over documents of the shared queue: their parts, and the round of the queue that serves each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                rows = batch.slice(lo, 512)
                n, at, per, phase = (rows.column(x).to_numpy(zero_copy_only=False) for x in ("n_tokens", "at", "per", "phase"))
                chunks = (at + n - 1) // chunk - at // chunk + 1
                doc = np.repeat(np.arange(len(n)), chunks)
                no = at[doc] // chunk + np.arange(len(doc)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
                turn = np.floor((no + phase[doc]) * chunk / per[doc]).astype(np.int64)
                first = np.flatnonzero(np.r_[True, (np.diff(doc) != 0) | (np.diff(turn) != 0)])
                last = np.r_[first[1:], len(doc)] - 1
                d = doc[first]
                x = np.maximum(at[d], no[first] * chunk)
                part = np.minimum(at[d] + n[d], (no[last] + 1) * chunk) - x
                skip = x - at[d]
                raw, take = rows.column("ids").to_pylist(), pa.array(d)
                own = [raw[i][b * size:(b + m) * size] for i, b, m in zip(d.tolist(), skip.tolist(), part.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c).take(take) for c in ("doc_id", "source", "n_tokens", "key")), pa.array(own, pa.binary()), pa.array(skip), pa.array(part),
                     pa.array(turn[first]), pa.array(x)],
                    names=["doc_id", "source", "n_tokens", "key", "ids", "skip", "part", "turn", "x"])

    return run


def _shared(placed: DataFrame, shares: DataFrame, width: float, chunk: int, size: int, queue: int) -> DataFrame:
    """Parts of the documents of the shared queue and their places in it; shares: (key, share) of its sources."""
    spark = placed.sparkSession
    phase = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    parts = written(placed.join(shares.select("key", (F.col("share") * width).alias("per"), phase.alias("phase")), "key")
                    .mapInArrow(_deal(chunk, size), "doc_id long, source string, n_tokens long, key string, ids binary, skip long, part long, turn long, x long"))
    turns = parts.groupBy("turn").agg(F.sum("part").alias("n"))
    most = turns.agg(F.max("turn")).first()[0] + 1
    group = F.floor(F.col("turn") / F.lit(most / 1024)).cast("long")
    turns = written(turns.withColumn("group", group))
    ends, total = [], 0
    for r in turns.groupBy("group").agg(F.sum("n").alias("n")).orderBy("group").collect():  # 1025 at most
        ends.append((r["group"], total))
        total += r["n"]
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("group").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = (turns.withColumn("inside", inside).join(F.broadcast(spark.createDataFrame(ends, "group long, before long")), "group")
            .select("turn", (F.col("inside") + F.col("before")).alias("base")))
    ahead = F.coalesce(F.sum("part").over(Window.partitionBy("turn").orderBy("key", "x").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # of one round
    return (parts.withColumn("ahead", ahead).join(base, "turn")
            .select("doc_id", "source", "n_tokens", "ids", F.lit(queue).alias("queue"), (F.col("base") + F.col("ahead")).alias("at"), "skip", "part"))


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = 4096, chunk: int = 4,
         weights: dict[str, float] | None = None, keep: int = 200_000) -> DataFrame:
    """Pieces of all documents: where each run of a document's ids lies in which sequence."""
    spark = docs.sparkSession
    dtype = encoder(tokenizer).dtype.str
    ids = encoded(docs, tokenizer, end_id, keep)
    key = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    sums = written(ids.withColumn("key", key).groupBy("task", "key").agg(F.sum("n_tokens").alias("n")))
    top = sums.groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(QUEUES).collect()
    if not top:
        return spark.createDataFrame([], PIECES)
    whole = sums.agg(F.sum("n")).first()[0]
    totals = [r["n"] for r in top]
    rest = whole - sum(totals)
    if rest:
        totals.append(rest)
    names = spark.createDataFrame([(r["key"], i) for i, r in enumerate(top)], "key string, queue int")
    given = [weights.get(r["key"][1:], 0) if r["key"][0] == "s" else 0 for r in top] if weights else None
    if rest:
        others = sums.join(F.broadcast(names), "key", "left_anti").groupBy("key").agg(F.sum("n").alias("n"))  # at most QUEUES rows are sent
        if given is None:
            shares = others.select("key", (F.col("n") / F.lit(rest)).alias("share"))
        else:
            own = spark.createDataFrame([(f"s{k}", float(w)) for k, w in weights.items() if k], "key string, weight double")
            others = written(others.join(own, "key", "left"))
            listed, least, plain = others.agg(F.sum("weight"), F.min("weight"), F.sum(F.when(F.col("weight").isNull(), F.col("n")))).first()
            left = weights.get("", 0) if plain else 0
            if plain and left <= 0 or least is not None and least <= 0:
                raise ValueError("a queue's weight must be positive")
            given.append((listed or 0) + left)
            shares = others.select("key", (F.coalesce("weight", F.col("n") * F.lit(left / (plain or 1))) / F.lit(float(given[-1]))).alias("share"))
    rounds = Rounds(totals, given, window, chunk)

    earlier = F.sum("n").over(Window.partitionBy("key").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    bases = (sums.withColumn("base", F.coalesce(earlier, F.lit(0)))
             .join(F.broadcast(names), "key", "left").select("task", "key", "queue", "base"))  # at most QUEUES rows
    found = (ids.withColumn("key", key).join(bases, ["task", "key"])
             .select("doc_id", "source", "key", "n_tokens", "ids", "queue", (F.col("base") + F.col("place")).alias("at")))
    placed = found.select("doc_id", "source", "n_tokens", "ids", "queue", "at", F.lit(0).cast("long").alias("skip"), F.col("n_tokens").alias("part"))
    if rest:
        width = max(float(rounds.quanta[-1]) / (1 << SHIFT), float(chunk))
        dealt = _shared(found.filter("queue is null").drop("queue"), shares, width, chunk, np.dtype(dtype).itemsize, len(top))
        placed = placed.filter("queue is not null").unionByName(dealt)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = rounds.chunk
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                n, queue, at, skip = (part.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("part", "queue", "at", "skip"))
                chunks = (at + n - 1) // c - at // c + 1
                doc = np.repeat(np.arange(len(n)), chunks)
                no = at[doc] // c + np.arange(len(doc)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
                rnd = rounds.serving(queue[doc], no)
                first = np.flatnonzero(np.r_[True, (np.diff(doc) != 0) | (np.diff(rnd) != 0)])
                last = np.r_[first[1:], len(doc)] - 1
                d, r = doc[first], rnd[first]
                a = np.maximum(at[d], no[first] * c)
                b = np.minimum(at[d] + n[d], (no[last] + 1) * c)
                g = rounds.place(r, queue[d], a)
                of, x, length, seq, offset = rounds.cut(g, b - a)
                start = (a - at[d])[of] + x - g[of]
                d = d[of]
                raw = part.column("ids").to_pylist()
                tokens = {i: np.frombuffer(raw[i], dtype=dtype).astype("<u4") for i in np.unique(d).tolist()}
                crc = [zlib.crc32(tokens[i][s:s + m]) for i, s, m in zip(d.tolist(), start.tolist(), length.tolist())]
                take = pa.array(d)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(take), pa.array(start + skip[d]), pa.array(length), pa.array(crc, pa.int64()),
                     part.column("n_tokens").take(take), pa.array(seq), pa.array(offset), part.column("source").take(take)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])

    return placed.mapInArrow(cut, PIECES)
