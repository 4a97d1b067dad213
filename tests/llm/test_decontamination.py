"""Decontamination against a plain search."""

import hashlib
import re

from creditlens.llm.op7_decontamination import clean, find

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UP = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, window=10):
    wins = [(str(i) if i is not None else "", tuple(w[a:a + min(window, len(w))])) for i, t in items
            for w in [WORD.findall((t or "").translate(UP))] if w for a in range(len(w) - min(window, len(w)) + 1)]
    out = []
    for d, t in docs:
        w = WORD.findall((t or "").translate(UP))
        hit, found = set(), set()
        for item, p in wins:
            for a in range(len(w) - len(p) + 1):
                if tuple(w[a:a + len(p)]) == p:
                    hit |= set(range(a, a + len(p)))
                    found.add(item)
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def rows(df):
    return [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()]


def key(r):
    return (r[0] is not None, r[0] or 0, r[1], r[4])


DOCS = [(1, "Alpha beta, gamma! one two three four five six seven eight nine ten"), (2, None), (3, ""), (None, "zürich ÉCOLE"), (None, "plain"),
        (4, "one TWO three four five six seven eight nine"), (5, "ab " * 5000 + "short item " + "ab " * 20), (5, "short item"), (5, "short item"),
        (6, "ab " * 30), (7, "x-y_z one two three four five six seven eight nine ten eleven short  item"), (8, "short\titem" * 2)]
ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short item."), (10, "short ITEM"), (3, None), (4, "!!"),
         (5, "ab " * 12), (2, "zürich École"), (None, "plain"), (6, "never seen anywhere")]


def test_matches_brute_force(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 as h", "2 as n", "3 as word")
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 as phrase", "2 as n")
    assert sorted(rows(find(docs, items)), key=key) == sorted(brute(DOCS, ITEMS), key=key)
    left = clean(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 3, 4, 8]
    none = items.limit(0)
    assert not any(r.contaminated for r in find(docs, none).collect())
    assert find(docs.limit(0), items).count() == 0


def test_whole_table(spark, small_dir):
    docs, items = (spark.read.parquet(f"{small_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = rows(find(docs, items))
    assert sorted(found, key=key) == sorted(brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]), key=key)
    assert any(r[5] for r in found)
