"""The probabilistic suffix tree against plain dictionaries over all documents."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from creditlens.llm import op12_suffix_tree
from creditlens.llm.blocks import pack, ranges_for, unpack
from creditlens.llm.op12_suffix_tree import least_for, scores
from creditlens.llm.queries import table

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
START = None


def split(text):
    return WORD.findall((text or "").encode().lower()) + [b""]


def brute(rows, depth, least, divergence):
    """Rows (doc_id, text) -> doc_id, held_out, n_tokens, n_known, N, base, score; and the states."""
    rest = [None if d is None else zlib.crc32(str(d).encode()) % 5 for d, _ in rows]
    texts = [split(t) for _, t in rows]
    words, follow = Counter(), defaultdict(Counter)
    for r, words_of in zip(rest, texts):
        if r is not None and r != 1:
            words.update(words_of)
            whole = [START] + words_of
            for i in range(1, len(whole)):
                for k in range(1, min(depth, i) + 1):
                    follow[tuple(whole[i - k:i])][whole[i]] += 1
    n_all, v = sum(words.values()), len(words)

    def root(x):
        return (words[x] + 0.5) / (n_all + 0.5 * (v + 1))

    def p(x, c):
        if not c:
            return root(x)
        kinds, n = len(follow[c]), sum(follow[c].values())
        return (follow[c][x] + kinds * p(x, c[1:])) / (n + kinds)

    states = {()}
    for c in list(follow):
        n, kinds = sum(follow[c].values()), len(follow[c])
        if n >= least:
            gain = 0
            for x, m in follow[c].items():
                t = kinds - (m == 1)
                gain += m * round(math.log(((m - 1) + t * p(x, c[1:])) / (n - 1 + t) / p(x, c[1:])) * (1 << 20))
            if gain > divergence * (1 << 20):
                states.add(c)
    out = []
    for (d, _), r, words_of in zip(rows, rest, texts):
        whole, score = [START] + words_of, 0.0
        for i in range(1, len(whole)):
            state = next(c for k in range(min(depth, i), -1, -1) if (c := tuple(whole[i - k:i])) in states)
            score += math.log10(p(whole[i], state))
        out.append((d, r == 1, len(words_of), sum(words[x] > 0 for x in words_of), n_all, sum(math.log10(root(x)) for x in words_of), score))
    return out, states


def same(found, expected):
    def key(r):
        return str(r[:5])

    assert [r[:5] for r in sorted(found, key=key)] == [r[:5] for r in sorted(expected, key=key)]
    for f, e in zip(sorted(found, key=lambda r: (key(r), r[5], r[6])), sorted(expected, key=lambda r: (key(r), r[5], r[6]))):
        assert f[5] == pytest.approx(e[5], rel=1e-9) and f[6] == pytest.approx(e[6], rel=1e-9)


def run(spark, rows, **parameters):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as rest", "'x' as score", "2 as task")
    return [tuple(r) for r in scores(docs, **parameters).collect()]


@pytest.mark.parametrize("depth,least,tokens", [(3, 2, 1 << 20), (2, 4, 3000), (0, 2, 1000)])
def test_equals_plain_dictionaries(spark, monkeypatch, depth, least, tokens):
    monkeypatch.setattr(op12_suffix_tree, "TOKENS", tokens)
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    rows += [(100_000 + i, "one two three four five " * (i + 1)) for i in range(8)]
    expected, states = brute(rows, depth, least, 2.0)
    assert (depth == 0) == (len(states) == 1) and {len(s) for s in states} == set(range(depth + 1))
    same(run(spark, rows, depth=depth, least=least, divergence=2.0), expected)


def test_null_empty_repeated_and_long(spark):
    rows = [(0, None), (1, ""), (2, " \t\n"), (None, "The the THE end"), (3, "the end É é"), (3, "the end É é"), (4, "a\x00b \x1f c"), (5, "the end " * 30_000),
            (7, "the  end\x0bof\x0cit"), (7, None)]
    same(run(spark, rows, depth=3, least=2, divergence=1.0), brute(rows, 3, 2, 1.0)[0])


def test_empty_table_and_nothing_to_learn_from(spark):
    assert run(spark, []) == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    assert run(spark, [(held, "a b")]) == [(held, True, 3, 0, 0, 0.0, 0.0)]


def test_held_out_documents_are_told_better_than_by_the_root(spark):
    found = run(spark, [tuple(r) for r in table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()])
    held = [r for r in found if r[1]]
    assert len(held) > 100 and sum(r[6] for r in held) > sum(r[5] for r in held)


def test_packed_blocks_round_trip():
    for values in (np.zeros(0, "<u8"), np.array([0, 1, 2**63], "<u8"), np.arange(-5, 5, dtype="<i8")):
        assert np.array_equal(unpack(pack(values), values.dtype.str), values)
    assert ranges_for(0) == 1 and ranges_for(1 << 20) == 2 and ranges_for(1 << 60) == 1 << 16


def test_contexts_need_more_evidence_in_a_larger_corpus():
    assert [least_for(n) for n in (0, 10_000, 25_600, 1_000_000, 10**8)] == [2, 2, 2, 7, 63]


def test_the_default_evidence_does_not_follow_the_size(spark, monkeypatch):
    monkeypatch.setattr(op12_suffix_tree, "ROOT", 1)  # the corpus is as one 25,600 times larger
    rows = [(i, f"w{i % 7} a b c w{i % 5} d e") for i in range(300)] + [(1000 + i, "rare pair of words") for i in range(3)]
    same(run(spark, rows), brute(rows, 2, 2, 2.0)[0])
