"""SimHash links and components against all pairs."""

import random

import numpy as np
import xxhash

from creditlens.llm.op9_simhash import first_of_each, fingerprint, links, near_duplicates, trie_pairs
from creditlens.llm.shared import components


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, bits):
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint():
    for t in ["", "a", "a b", "A b\tC", "Ünï b c d e", "x y z w " * 300, "\x1c a\x85b c"]:
        assert fingerprint(t, 3) == plain_fingerprint(t)


def test_trie_pairs():
    rng = random.Random(3)
    values, starts, ends, want = [], [], [], set()
    for _ in range(30):
        base = rng.getrandbits(64)
        own = sorted({base ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (2**64 - 1) for _ in range(rng.randrange(1, 40))})
        starts.append(len(values))
        values += own
        ends.append(len(values))
        want |= {(i, j) for j in range(starts[-1], ends[-1]) for i in range(starts[-1], j) if (values[i] ^ values[j]).bit_count() <= 2}
    i, j = trie_pairs(np.array(values, dtype=np.uint64), np.array(starts), np.array(ends), 64, 2)
    assert {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())} == want and len(i) == len(want)


def test_links_split_dense_nodes(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = list({b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (rng.getrandbits(8) << 3) for b in base for _ in range(60)} | {0, 1 << 63, 2**64 - 1})
    signed = [x - 2**64 if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for most in (4096, 8):
        found = {r.node: r.component for r in components(links(df, 2, most)).collect()}
        got = [found.get(x, x) for x in signed]
        want = plain_components(fps, 2)
        assert len({*zip(got, want)}) == len(set(got)) == len(set(want))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (-5, 100), (200, 201)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[i] == -5 for i in range(100, 160)) and found[201] == 200


def test_near_duplicates(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(9001, None, "x"), (9002, "", "x"), (9003, " \n", "x"), (None, "same here now", "x"), (9004, "same here now", "x"),
                                 (9004, "same here now", "x"), (None, "alone in the world today", "x")], "doc_id long, text string, lang string")
    docs = docs.unionByName(odd).selectExpr("*", "1 as fp", "2 as component")
    given = docs.collect()
    fps = [plain_fingerprint(r.text) for r in given]
    label = plain_components(fps, 2)
    least = {}
    for r, c in zip(given, label):
        if r.doc_id is not None:
            least[c] = min(least.get(c, r.doc_id), r.doc_id)
    want = sorted((r.doc_id is not None, r.doc_id or 0, f"{fp:016x}", str(least.get(c))) for r, fp, c in zip(given, fps, label))
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.fingerprint, str(r.component_id)) for r in near_duplicates(docs).collect())
    assert got == want
    kept = first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(r.doc_id for r, c in zip(given, label) if r.doc_id is not None and least[c] == r.doc_id)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_repeated_doc_ids(spark):
    copied, clean, other = ("the quick brown fox jumps over a lazy dog", "an entirely different text stands alone here", "yet another text of its own words entirely")
    rows = [(1, copied, "x"), (2, copied, "x"), (2, clean, "x"), (3, other, "x"), (3, other, "x"), (3, other.upper(), "x"), (None, copied, "x"), (None, copied, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as h", "2 as component")
    kept = first_of_each(docs, one=True)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id or 0, r.text.lower()) for r in kept.collect())
    assert got == sorted([(0, copied), (0, copied), (1, copied), (2, clean), (3, other)])
    assert sorted((r.doc_id or 0, r.text) for r in first_of_each(docs).collect()) == sorted((i or 0, t) for i, t, _ in rows if (i, t) != (2, copied))
