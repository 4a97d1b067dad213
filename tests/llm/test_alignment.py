"""Cross-tokenizer alignment against a plain walk over both token lists."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from creditlens.llm import op11_alignment
from creditlens.llm.op11_alignment import align, pair
from creditlens.llm.queries import BYTES, PIECES, table

HARD = ["", None, "a", " ", "Hello world", "  two  spaces\n\ttabs ", "naïve café 東京 😀 ẞ", "<|endoftext|> x </s> <unk>", "a▁b", "\x00\x01", "Hello world", "x" * 3000,
        "ab " * 20000]


def brute(rows):
    """Rows (doc_id, text) -> what the contract says, token by token."""
    p, texts = pair(BYTES, PIECES), {}
    for text in {t for _, t in rows if t}:
        a = p.a.encode(" " + text, add_special_tokens=False).ids
        b = p.b.encode(text)
        whole = (" " + text).encode()
        if b"".join(p.bytes_a[i] for i in a) != whole or b"".join(p.bytes_b[i] for i in b) != whole:
            continue
        links, groups, i, j, at_a, at_b, now = [], [], 0, 0, len(p.bytes_a[a[0]]), len(p.bytes_b[b[0]]), ([a[0]], [b[0]])
        while True:
            links.append((a[i], b[j]))
            step_a, step_b = at_a <= at_b, at_b <= at_a
            if step_a and step_b:
                groups.append(now)
                now = ([], [])
            if step_a:
                i += 1
                if i == len(a):
                    break
                at_a += len(p.bytes_a[a[i]])
                now[0].append(a[i])
            if step_b:
                j += 1
                at_b += len(p.bytes_b[b[j]])
                now[1].append(b[j])
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        texts[text] = (len(a), len(b), len(groups), links, hashlib.sha256(said.encode()).hexdigest())
    counts = Counter(x for _, t in rows if t in texts for x in texts[t][3])
    best = {}
    for (a, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for doc_id, t in rows:
        if t not in texts:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, digest = texts[t]
        out.append((doc_id, n_a, n_b, n_groups, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return sorted(out, key=str)


def test_equals_the_plain_walk(spark, monkeypatch):
    monkeypatch.setattr(op11_alignment, "RANGE", 700)
    rows = [(i, t) for i, t in enumerate(HARD)] + [(None, "Hello world"), (4, "Hello world")]
    rows += [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit(1)).withColumn("n_a", F.lit("x"))
    found = sorted((tuple(r) for r in align(docs, BYTES, PIECES).collect()), key=str)
    assert found == brute(rows)


def test_small_groups_of_texts_give_the_same(spark, monkeypatch):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    monkeypatch.setattr(op11_alignment, "HELD", 500)
    monkeypatch.setattr(op11_alignment, "CHARS", 300)
    assert sorted((tuple(r) for r in align(docs, BYTES, PIECES).collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert align(spark.createDataFrame([], "doc_id long, text string"), BYTES, PIECES).collect() == []


def test_two_bytes_for_each_id():
    with pytest.raises(Exception):
        pair("missing.json", PIECES)
