"""Token counts after edits against counts of the edited texts."""

import random

import pytest

from creditlens.llm.encoding import encoder
from creditlens.llm.op1_token_counts import LEAF, Tree, counter, leaves, own_edits, recount, trees

WORDS, BYTES = "word_bpe_49k.json", "byte_bpe_50k.json"
ODD = ["", " ", "\n\n  x", "a b" * 700, "don't  stop\x1c now   é  ", "x" * 3000, "  lead and  trail   \n", "日本語 テキスト " * 90, "<|endoftext|> a <|endoftext|>"]


def apply(text, edits):
    for s, d, i in edits:
        s = min(max(0, s or 0), len(text))
        text = text[:s] + (i or "") + text[s + max(0, d or 0):]
    return text


@pytest.mark.parametrize("name", [WORDS, BYTES])
def test_leaves_and_edits(name):
    count = counter(name)
    rng = random.Random(4)
    bits = ["a", " ", "  ", "\n", "word", "'s", ".", "!!", " ", "é", "1", " the end ", "\x1c", "x" * 900, " long words here" * 120, ""]
    texts = ODD + ["".join(rng.choice(bits[:-3]) for _ in range(rng.randrange(900))) for _ in range(12)]
    for text in texts:
        cut = leaves(text)
        assert "".join(cut) == text and sum(count(cut)) == count([text])[0]
        t = Tree(cut, count(cut), count)
        for _ in range(12):
            s, d, i = rng.randrange(len(text) + 3), rng.choice([0, 1, 2, 30, 800]), "".join(rng.choice(bits) for _ in range(rng.randrange(4)))
            t.edit(s, d, i)
            text = apply(text, [(s, d, i)])
            assert "".join(t.texts) == text and t.chars[1] == len(text)
            assert t.tokens[1] == count([text])[0], (text, s, d, i)


def test_edit_encodes_little():
    count = counter(WORDS)
    text = "some plain words of text " * 4000
    cut = leaves(text)
    t = Tree(cut, count(cut), count)
    t.edit(50_000, 4, "other")
    assert t.encoded < 3 * LEAF


def test_recount(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(9000 + i, t) for i, t in enumerate(ODD)] + [(9900, None), (None, "no id"), (None, None), (9001, "again"), (9001, " ")], "doc_id long, text string")
    docs = docs.unionByName(odd).selectExpr("*", "1 as h", "2 as tokens", "3 as kind")
    more = spark.createDataFrame([(9000, 5, None, None, "new text"), (9000, 4, -3, 2, None), (None, 1, 0, 0, "x"), (77777, 1, 0, 0, "x")],
                                 "doc_id long, seq long, start long, deleted long, inserted string")
    edits = own_edits(docs).unionByName(more)
    by = {}
    for e in edits.collect():
        if e.doc_id is not None:
            by.setdefault(e.doc_id, []).append((e.seq, e.start or 0, e.deleted or 0, e.inserted or ""))
    count = counter(WORDS)
    # a doc_id with several texts gets edits of each of them, for each
    want = []
    for r in docs.collect():
        own = [x[1:] for x in sorted(by.get(r.doc_id, []))]
        text = apply(r.text or "", own)
        want.append((str(r.doc_id), *count([r.text or "", text]), len(own), len(text)))
    got = [(str(r.doc_id), r.n_tokens_before, r.n_tokens, r.n_edits, r.n_chars) for r in recount(docs, trees(docs, WORDS), edits, WORDS).collect()]
    assert sorted(got) == sorted(want)
    assert encoder(WORDS).dtype.itemsize == 2
    none = docs.limit(0)
    assert recount(none, trees(none, WORDS), own_edits(none), WORDS).count() == 0
