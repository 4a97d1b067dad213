"""SimHash near-duplicates: a binary trie joined with itself under a Hamming error budget.

Distinct fingerprints alone take part.  With a budget of ``bits`` differing bits, one of
``bits`` + 1 blocks of a linked pair is equal, so the trie is laid out once for each block,
with that block first; pairs start at the node below the block's equal bits.  Nodes with
more than ``most`` fingerprints are laid out again by the bits that are left, in the same
way, so a dense node is split over tasks and no fingerprint is left out.  Within a node,
node pairs are traversed together: differing bits add up, and a pair beyond the budget is
pruned with all below it.  Links of a node leave its task as a spanning forest, which keeps
what is connected; components over all tasks follow from star steps on written edges.

Components take a number of rounds that grows with the logarithm of the longest path; beyond 60
rounds ``components`` raises an error, and no link is dropped.

Defined results: a null text is empty; a text without words has fingerprint zero, which
links like any other; equal rows get equal results; a null doc_id never names a component,
and a component of null doc_ids alone has a null id; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.llm.shared import components, fresh, partitions, text_or_empty, written

SEED = 42
SLICE = 1 << 14


def fingerprint(text: str, shingle: int) -> int:
    """Bits set in over half of the hashes of all shingles of ``shingle`` words."""
    import xxhash

    words = text.encode().lower().split()  # of bytes: A-Z alone, and ASCII white space alone
    if not words:
        return 0
    if len(words) > shingle:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    else:
        parts = iter([b" ".join(words)])
    digest, n = xxhash.xxh64_intdigest, max(1, len(words) - shingle + 1)
    h = np.fromiter((digest(p, SEED) for p in parts), dtype="<u8", count=n)
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, SLICE):
        votes += np.unpackbits(h[at:at + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, hashed: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer; with ``hashed`` also h, the hash of the text."""
    more = [F.xxhash64("text").alias("h")] if hashed else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                fp = np.array([fingerprint(t.as_py(), shingle) for t in part.column("text")], dtype=np.uint64)
                own = {"doc_id": part.column("doc_id"), "fp": pa.array(fp.view(np.int64))} | ({"h": part.column("h")} if hashed else {})
                yield pa.RecordBatch.from_arrays(list(own.values()), names=list(own))

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"), *more).mapInArrow(run, "doc_id long, fp long" + ", h long" * hashed)


def trie_pairs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of values within ``bits`` bits, in each of the tries [start, end).

    values: unsigned, ascending and distinct in each trie.  A trie's node is a range of it.
    """
    a0, a1, b0, b1 = starts, ends, starts, ends
    used = np.zeros(len(starts), dtype=np.int64)
    left, right = [], []
    for bit in range(depth - 1, -1, -1):
        many = (a1 - a0 > 1) | (b1 - b0 > 1)
        one = ~many & (a0 != b0)  # two leaves: what is left differs in so many bits
        if one.any():
            x, y = a0[one], b0[one]
            low = np.uint64((1 << (bit + 1)) - 1)
            ok = used[one] + np.bitwise_count((values[x] ^ values[y]) & low) <= bits
            left.append(x[ok])
            right.append(y[ok])
        a0, a1, b0, b1, used = a0[many], a1[many], b0[many], b1[many], used[many]
        if not len(a0):
            break
        ones = np.concatenate([[0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        same = a0 == b0
        cross = ~same
        pairs = [(a0, am, b0, bm, used), (am, a1, bm, b1, used), (a0, am, bm, b1, used + 1),
                 (am[cross], a1[cross], b0[cross], bm[cross], used[cross] + 1)]
        a0, a1, b0, b1, used = (np.concatenate(x) for x in zip(*pairs))
        keep = (a1 > a0) & (b1 > b0) & (used <= bits) & ~((a0 == b0) & (a1 - a0 < 2))
        a0, a1, b0, b1, used = a0[keep], a1[keep], b0[keep], b1[keep], used[keep]
    else:
        one = a0 != b0
        left.append(a0[one])
        right.append(b0[one])
    empty = np.zeros(0, dtype=np.int64)
    return np.concatenate([*left, empty]), np.concatenate([*right, empty])


def forest(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """A spanning forest of the links."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := root.setdefault(x, x)) != x:
            root[x] = root.setdefault(p, p)
            x = root[x]
        return x

    out = []
    for x, y in zip(a, b):
        rx, ry = find(x), find(y)
        if rx != ry:
            root[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out


def _node_links(bits: int):
    """mapInArrow over rows (key, fp, rest), the rows of a key together and in order of key."""
    def links(keys: np.ndarray, fp: np.ndarray, rest: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((rest, keys))
        keys, fp, rest = keys[order], fp[order], rest[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        i, j = trie_pairs(rest, starts, np.r_[starts[1:], len(keys)], 64, bits)
        kept = forest(fp[i].tolist(), fp[j].tolist())
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in kept], pa.int64()), pa.array([y for _, y in kept], pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def take(rows):
            keys = np.array([k for x in rows for k in x[0]], dtype=object)
            codes = np.unique(keys, return_inverse=True)[1]
            return links(codes, np.concatenate([x[1] for x in rows]), np.concatenate([x[2] for x in rows]).view(np.uint64))

        n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_pylist()
            fp, rest = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "rest"))
            if held and n >= 50_000 and keys[0] != keys[-1]:
                cut = next(i for i, k in enumerate(keys) if k != keys[0])  # the held node may go on so far
                held.append((keys[:cut], fp[:cut], rest[:cut]))
                yield take(held)
                held, n, keys, fp, rest = [], 0, keys[cut:], fp[cut:], rest[cut:]
            held.append((keys, fp, rest))
            n += len(keys)
        if held:
            yield take(held)

    return run


def links(fps: DataFrame, bits: int, most: int = 4096) -> DataFrame:
    """A forest (a, b) that connects all fingerprints ``fp`` within ``bits`` bits; fps are distinct."""
    spark = fps.sparkSession
    level = fps.select("fp", F.lit("").alias("key"), F.col("fp").alias("rest"))
    depth, out = {"": 64}, []
    while True:
        # lay out by each block of the bits that are left; depth: bits left, by the kind of key
        rows, left = [], {}
        for kind, n in depth.items():
            own = level if len(depth) == 1 else level.filter(F.split("key", ":")[0] == kind)
            at = 0
            for i in range(bits + 1):
                width = (n - at) // (bits + 1 - i)
                mask = (1 << width) - 1
                block = F.shiftrightunsigned("rest", at).bitwiseAND(F.lit(mask))
                low = F.col("rest").bitwiseAND(F.lit((1 << at) - 1))
                high = F.shiftleft(F.shiftrightunsigned("rest", at + width), at) if at + width < 64 else F.lit(0).cast("long")
                name = f"{kind}{i}"
                left[name] = n - width
                value = F.concat(F.when(F.instr("key", ":") > 0, F.substring_index("key", ":", -1)).otherwise(""), F.lit("."), F.hex(block))
                rows.append(own.select("fp", F.concat(F.lit(f"{name}:"), value).alias("key"), high.bitwiseOR(low).alias("rest")))
                at += width
        laid = rows[0]
        for x in rows[1:]:
            laid = laid.unionByName(x)
        counts = laid.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        laid = written(laid.join(counts, "key"))
        ready = laid if max(left.values()) <= most.bit_length() else laid.filter(F.col("n") <= most)
        n = partitions(spark)
        out.append(ready.select("key", "fp", "rest").repartition(n, "key").sortWithinPartitions("key").mapInArrow(_node_links(bits), "a long, b long"))
        if max(left.values()) <= most.bit_length():
            break
        level = laid.filter(F.col("n") > most).select("fp", "key", "rest")
        if level.isEmpty():
            break
        depth = left
    found = out[0]
    for x in out[1:]:
        found = found.unionByName(x)
    return found


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2, hashed: bool = False) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document; with ``hashed`` also h (of its text) and component."""
    if not 0 <= bits < 8:
        raise ValueError("the budget is from 0 to 7 bits")
    fps = written(fingerprints(docs, shingle, hashed))
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = components(links(classes, bits)).select(F.col("node").alias("fp"), "component")
    named = classes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    more = ["h", "component"] if hashed else []
    return (fps.join(named.join(least, "component").select("fp", "component_id", *more[1:]), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *more))


def first_of_each(docs: DataFrame, shingle: int = 3, bits: int = 2, one: bool = False) -> DataFrame:
    """The documents, all columns, that are the smallest doc_id of their component, and those without a doc_id.

    Rows are told apart by doc_id and text.  With ``one`` a component keeps one row: of the
    texts of its smallest doc_id the one with the smallest hash, and of equal rows any.
    """
    found = near_duplicates(docs, shingle, bits, hashed=True).filter("doc_id is not null")
    if one:
        found = written(found)
        stays = found.filter("doc_id = component_id").groupBy("component").agg(F.min("h").alias("least"))
        gone = found.join(stays, "component").filter("doc_id <> component_id or h <> least")
    else:
        gone = found.filter("doc_id <> component_id")

    own_id, own_h = fresh(2)

    def same(keys: DataFrame):
        keys = keys.select(F.col("doc_id").alias(own_id), F.col("h").alias(own_h))
        return keys, (docs["doc_id"].cast("long") == keys[own_id]) & (F.xxhash64(docs["text"]) == keys[own_h])

    kept = docs.join(*same(gone.select("doc_id", "h").distinct()), "left_anti")
    if not one:
        return kept
    often = written(found.groupBy("doc_id", "h").count().filter("count > 1"))
    single = kept.join(*same(often), "left_anti")
    repeated = kept.join(*same(often), "left_semi").withColumn(own_h, F.xxhash64("text")).dropDuplicates(["doc_id", own_h])
    return single.unionByName(repeated.select(docs.columns))
