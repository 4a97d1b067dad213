"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import re
import zlib

import pytest

from creditlens.llm.op13_prefix_trie import TernaryTree, rebuilt, sequences, trie

SHAPE = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = own.get(c - c % 20, [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append((c, d == len(path)))
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        children = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(len(x) == len(q) + 1 and x[:len(q)] == q for x in below)]
        saved = sum((len(nodes[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        ends = ",".join(str(c) for c in sorted(c for c, e in members if e))
        out.append((min(c for c, _ in members), len(p), min(c for c, _ in nodes[p[:-1]]) if p else None, len(members), len(children), len(leaves),
                    saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, shards=None, **more):
    table = spark.createDataFrame(rows, SHAPE).selectExpr("*", "1 as words", "'x' as path")
    return sorted((tuple(r) for r in trie(rebuilt(sequences(table)), shards).collect()), key=str)


def random_rows(seed, convs, turns, kinds):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(r.randrange(turns)):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice([f"word {k} of it" for k in range(kinds)] + ["", None, "  "])))
    return rows


@pytest.mark.parametrize("shards", [1, 2, 5, 40])
def test_equals_plain_prefixes_for_any_number_of_shards(spark, shards):
    rows = random_rows(shards, 90, 7, 2)
    assert found(spark, rows, shards) == brute(rows)


def test_copies_and_prefixes_of_each_other(spark):
    # sixty copies, and each of their prefixes, cut into many shards; ids far from multiples of 20 as well
    rows = [(c, t, "user", f"turn {t}") for c in range(60) for t in range(6)] + [(1000 + k, t, "user", f"turn {t}") for k in range(7) for t in range(k)]
    for shards in (1, 3, 8):
        assert found(spark, rows, shards) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, 0, "user", "left out"), (1, None, "user", "first"), (1, 0, None, "second"), (1, 0, None, "second"), (1, 1, "user", None),
            (1, 1, "user", "tie b"), (1, 1, "user", "tie a"), (40, 0, "", ""), (40, 1, None, None), (41, 0, "user", "x"), (-5, 0, "user", "below zero"),
            (7, 0, "user", "a" * 100_000)]
    rows = [r for r in rows if r[0] != -5] + random_rows(3, 25, 4, 1)
    assert found(spark, rows, 4) == brute(rows)


def test_empty_table(spark):
    assert found(spark, [(None, 0, "user", "x")]) == []
    assert found(spark, []) == []


def test_a_long_conversation_without_recursion(spark):
    rows = [(3, t, "user", str(t % 7)) for t in range(5000)]
    table = spark.createDataFrame(rows, SHAPE)
    out = trie(rebuilt(sequences(table)), 2)
    h = zlib.crc32(b"3") % 4
    assert out.count() == 5000 - h + 1 and out.agg({"depth": "max"}).first()[0] == 5000 - h


def test_the_median_keeps_siblings_balanced():
    tree = TernaryTree()
    tree.insert_sorted([([k], [1]) for k in range(1023)])

    def height(node):
        return 0 if not node else 1 + max(height(tree.low[node]), height(tree.high[node]))

    assert height(tree.eq[0]) == 10
