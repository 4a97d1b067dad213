"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first search.

The tree is fitted on at most ``sample`` distinct vectors, in order of a hash of vec_id;
every vector is then put into a leaf.  A query keeps a priority queue of nodes by distance
and visits leaves best first.  How many leaves it visits is calibrated: for at most
``calibrate`` queries the exact neighbours among all vectors are found, and visits are
widened until ``recall`` of them lie in visited leaves.  A query goes on until its leaves
hold enough candidates.  Leaves with many vectors or many queries are dealt out as blocks.

Vectors with equal components are searched once: a class of them keeps its ``k`` + 1
smallest vec_ids, which is all that any answer can need.

Defined results: vectors that are null, empty, zero or hold null or non-finite components
take no part, nor do those of another length than the commonest, nor null vec_ids; rows
with the same vec_id and vector are one; an empty table gives no rows; other columns are not
read.  Ties go to the smaller vec_id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditlens.llm.shared import partitions, written

BLOCK = 16_384  # vectors, or queries, of a leaf that meet in one task
RESULT = "query_id long, rank int, vec_id long, score double"


@dataclass(frozen=True)
class Tree:
    """Nodes by number: centres, children (none for a leaf) and the leaf's number."""

    centres: np.ndarray
    children: tuple[tuple[int, ...], ...]
    leaf: np.ndarray

    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row descends to."""
        out, todo = np.zeros(len(x), dtype=np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            kids = np.array(self.children[node])
            near = (((self.centres[kids] ** 2).sum(axis=1))[None, :] - 2 * x[rows] @ self.centres[kids].T).argmin(axis=1)
            todo += [(int(k), rows[near == i]) for i, k in enumerate(kids) if (near == i).any()]
        return out

    def visits(self, x: np.ndarray, most: int, counts: np.ndarray, enough: int) -> list[int]:
        """Leaves for one query, best first: ``most``, and more while they hold too few vectors."""
        heap, out, held = [(0.0, 0)], [], 0
        while heap and (len(out) < most or held < enough):
            _, node = heapq.heappop(heap)
            kids = self.children[node]
            if not kids:
                number = int(self.leaf[node])
                out.append(number)
                held += counts[number]
                continue
            d = ((self.centres[list(kids)] - x) ** 2).sum(axis=1)
            for k, far in zip(kids, d.tolist()):
                heapq.heappush(heap, (far, k))
        return out


def fit(x: np.ndarray, branching: int, leaf: int, rounds: int = 8, seed: int = 5) -> Tree:
    """Split by k-means until a node has at most ``leaf`` rows of the sample."""
    rng = np.random.default_rng(seed)
    centres, children, leaves, todo = [x.mean(axis=0)], [()], {}, [(0, x)]
    while todo:
        node, own = todo.pop(0)
        near = np.zeros(len(own), dtype=int)
        if len(own) > leaf:
            c = own[rng.choice(len(own), min(branching, len(own)), replace=False)]
            for _ in range(rounds):
                near = ((c**2).sum(axis=1)[None, :] - 2 * own @ c.T).argmin(axis=1)
                sums = np.zeros_like(c)
                np.add.at(sums, near, own)
                n = np.bincount(near, minlength=len(c))
                c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
            near = ((c**2).sum(axis=1)[None, :] - 2 * own @ c.T).argmin(axis=1)
        groups = [g for g in np.unique(near)]
        if len(groups) < 2:
            leaves[node] = len(leaves)
            continue
        kids = []
        for g in groups:
            kids.append(len(centres))
            centres.append(own[near == g].mean(axis=0))
            children.append(())
            todo.append((kids[-1], own[near == g]))
        children[node] = tuple(kids)
    number = np.full(len(centres), -1)
    number[list(leaves)] = list(leaves.values())
    return Tree(np.array(centres), tuple(children), number)


def unit(raw) -> np.ndarray:
    """Rows of float64 bytes, scaled to length 1; the scale of a row is taken out first."""
    x = np.frombuffer(b"".join(raw), dtype="<f8").reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        flat = b.column("v").flatten().to_numpy(zero_copy_only=False).astype("<f8")
        width = len(flat) // max(1, b.num_rows)
        raw = [flat[i * width:(i + 1) * width].tobytes() for i in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(raw, pa.binary())], names=["vec_id", "raw"])


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, raw): rows that take part, their components as float64 bytes."""
    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    v = v.filter("vec_id is not null and v is not null and size(v) > 0 and forall(v, x -> x is not null and abs(x) < double('infinity')) and exists(v, x -> x <> 0)")
    width = v.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if width is None:
        return v.select("vec_id", F.lit(None).cast("binary").alias("raw")).limit(0)
    # -0.0 becomes 0.0, so that equal vectors have equal bytes
    return v.filter(F.size("v") == width["n"]).select("vec_id", F.expr("transform(v, x -> x + 0D)").alias("v")).mapInArrow(_pack, "vec_id long, raw binary")


def best_of(query: np.ndarray, rows: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(queries, k) places of the rows with the largest cosine, ties to the smaller ``first``, and their cosines."""
    order = np.argsort(first, kind="stable")
    score = query @ rows[order].T
    k = min(k, len(rows))
    top = np.argpartition(-score, k - 1, axis=1)[:, :k]
    low = np.take_along_axis(score, top, axis=1).min(axis=1)
    for i in np.flatnonzero((score >= low[:, None]).sum(axis=1) > k):  # ties at the edge
        top[i] = np.lexsort((np.arange(score.shape[1]), -score[i]))[:k]
    top = np.take_along_axis(top, np.argsort(-np.take_along_axis(score, top, axis=1), axis=1, kind="stable"), axis=1)
    return order[top], np.take_along_axis(score, top, axis=1)


def _meet(k: int):
    """mapInArrow over cells, each its vectors and then its queries: the ``k`` best ids of every query in the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[float, int]]] = {}
        at, raw, first, ids, x = None, [], [], [], None

        def out() -> pa.RecordBatch:
            rows = [(q, i, -s) for q, found in best.items() for s, i in found]
            best.clear()
            q, i, s = zip(*rows) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.float64())], names=["q", "id", "score"])

        for b in batches:
            keys = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("leaf", "s", "t", "kind")], axis=1)
            cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            for lo, hi in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(keys)].tolist()):
                if lo == hi:
                    continue
                part = b.slice(lo, hi - lo)
                if tuple(keys[lo, :3]) != at:
                    at, raw, first, ids, x = tuple(keys[lo, :3]), [], [], [], None
                if keys[lo, 3] == 0:  # at most about BLOCK vectors in a cell
                    raw += part.column("raw").to_pylist()
                    first += part.column("id").to_pylist()
                    ids += part.column("ids").to_pylist()
                    continue
                if not raw:
                    continue
                x = unit(raw) if x is None else x
                for n in range(0, part.num_rows, 512):
                    asks = part.slice(n, 512)
                    top, score = best_of(unit(asks.column("raw").to_pylist()), x, np.array(first), k)
                    for q, places, scores in zip(asks.column("id").to_pylist(), top.tolist(), score.tolist()):
                        had = best.get(q, [])
                        if len(had) < k or -scores[0] <= had[-1][0]:
                            best[q] = sorted(had + [(-s, i) for p, s in zip(places, scores) for i in ids[p]])[:k]
                if len(best) > 100_000:
                    yield out()
        yield out()

    return run


def _top(df: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    return df.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, branching: int = 8, sample: int = 20_000, leaf: int | None = None,
           calibrate: int = 128, recall: float = 0.96) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row of ``queries``, its own vec_id left out.

    leaf: rows of the sample in a leaf; by default leaves are about the root of the number
    of vectors, so that visits and the rows of a leaf grow alike.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    near = Window.partitionBy("raw").orderBy("vec_id")
    kept = rows.distinct().withColumn("place", F.row_number().over(near)).filter(F.col("place") <= k + 1)
    classes = written(kept.groupBy("raw").agg(F.min("vec_id").alias("first"), F.array_sort(F.collect_list("vec_id")).alias("ids")))
    drawn = classes.select("raw", "first").orderBy(F.xxhash64("first"), "first").limit(sample).collect()
    if not drawn:
        return spark.createDataFrame([], RESULT)
    if leaf is None:  # about as many leaves as the root of the vectors; k-means leaves are half full
        leaf = max(16, int(2 * len(drawn) / classes.count() ** 0.5))
    tree = fit(unit([bytes(r["raw"]) for r in drawn]), branching, leaf)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                at = tree.assign(unit(b.column("raw").to_pylist()))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at)], names=["raw", "first", "ids", "leaf"])

    placed = written(classes.mapInArrow(place, "raw binary, first long, ids array<long>, leaf long"))
    counts = np.zeros(tree.leaves(), dtype=np.int64)
    for r in placed.groupBy("leaf").count().collect():  # a row per leaf
        counts[r["leaf"]] = r["count"]

    asked = usable(queries)
    asked = written(asked.distinct().join(placed.select("raw", F.col("first").alias("q")), "raw").select("vec_id", "q", "raw"))
    distinct = asked.groupBy("q").agg(F.first("raw").alias("raw"))
    trial = distinct.orderBy(F.xxhash64("q"), "q").limit(calibrate).collect()
    if not trial:
        return spark.createDataFrame([], RESULT)
    ask, names = unit([bytes(r["raw"]) for r in trial]), np.array([r["q"] for r in trial])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 8192):
                part = b.slice(at, 8192)
                first, leaves = (part.column(c).to_numpy() for c in ("first", "leaf"))
                top, score = best_of(ask, unit(part.column("raw").to_pylist()), first, k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(names, top.shape[1])), pa.array(first[top.ravel()]), pa.array(leaves[top.ravel()]),
                                                  pa.array(score.ravel())], names=["q", "id", "leaf", "score"])

    truth = _top(placed.mapInArrow(exact, "q long, id long, leaf long, score double"), k + 1).filter("q <> id").collect()
    order = {q: {n: i for i, n in enumerate(tree.visits(x, tree.leaves(), counts, 0))} for q, x in zip(names.tolist(), ask)}
    ranks = np.sort([order[r["q"]][r["leaf"]] for r in truth if r["place"] <= k + 1])
    most = int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)]) + 1 if len(ranks) else 1

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                raw = part.column("raw").to_pylist()
                lists = [tree.visits(x, most, counts, k + 1) for x in unit(raw)]
                of = np.repeat(np.arange(len(raw)), [len(v) for v in lists])
                yield pa.RecordBatch.from_arrays([part.column("q").take(pa.array(of)), part.column("raw").take(pa.array(of)),
                                                  pa.array(np.concatenate([np.array(v, dtype=np.int64) for v in lists]))], names=["q", "raw", "leaf"])

    visits = written(distinct.select("q", "raw").mapInArrow(visit, "q long, raw binary, leaf long"))
    asks = {r["leaf"]: r["count"] for r in visits.groupBy("leaf").count().collect()}  # a row per leaf
    blocks = spark.createDataFrame([(i, int(-(-counts[i] // BLOCK)) or 1, -(-asks.get(i, 0) // BLOCK) or 1) for i in range(len(counts))], "leaf long, of_rows int, of_asks int")
    blocks = F.broadcast(blocks)  # a row per leaf
    left = (placed.join(blocks, "leaf").withColumn("s", F.pmod(F.xxhash64("first"), F.col("of_rows")))
            .withColumn("t", F.explode(F.sequence(F.lit(0).cast("long"), F.col("of_asks").cast("long") - 1)))
            .select("leaf", "s", "t", F.lit(0).alias("kind"), "raw", F.col("first").alias("id"), "ids"))
    right = (visits.join(blocks, "leaf").withColumn("t", F.pmod(F.xxhash64("q"), F.col("of_asks")))
             .withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("of_rows").cast("long") - 1)))
             .select("leaf", "s", "t", F.lit(1).alias("kind"), "raw", F.col("q").alias("id"), F.lit(None).cast("array<long>").alias("ids")))
    cell = ["leaf", "s", "t"]
    found = (left.unionByName(right).repartition(partitions(spark), *cell).sortWithinPartitions(*cell, "kind")
             .mapInArrow(_meet(k + 1), "q long, id long, score double"))
    best = _top(found, k + 1).select("q", "id", "score")
    mine = asked.select("vec_id", "q").join(best, "q").filter("vec_id <> id")
    w = Window.partitionBy("vec_id", "q").orderBy(F.desc("score"), "id")
    return (mine.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select(F.col("vec_id").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"))
