"""Stages that join keys of their own to documents: names they use inside, null and empty texts, repeated rows, empty tables."""

from creditlens.llm import op2_passages, op7_decontamination, op9_simhash

PASSAGE = " ".join(f"word{i}" for i in range(60))
ROWS = [(1, PASSAGE), (2, "before " + PASSAGE + " after"), (3, None), (4, ""), (5, "a short text of its own"), (5, "a short text of its own"), (None, PASSAGE),
        (6, "one two three four five six seven eight nine ten eleven")]


def docs(spark, rows):
    names = ("b_id", "b_h", "s_id", "s_h", "s_spans", "h", "fp", "component_id", "start")
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *[f"'mine' as {n}" for n in names])


def kept(df):
    assert all(r[n] == "mine" for r in df.collect() for n in df.columns if n not in ("doc_id", "text"))
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_passages_are_cut(spark):
    assert kept(op2_passages.cut(docs(spark, ROWS))) == sorted([(d, "before after" if d == 2 else t) for d, t in ROWS], key=str)


def test_benchmark_documents_go(spark):
    items = spark.createDataFrame([(1, "two three four five six seven eight nine ten eleven")], "item_id long, text string")
    assert kept(op7_decontamination.clean(docs(spark, ROWS), items)) == sorted(ROWS[:-1], key=str)


def test_one_of_each_group_stays(spark):
    # documents 3 and 4 have no words and one fingerprint; a row without a doc_id stays
    found = kept(op9_simhash.first_of_each(docs(spark, ROWS), one=True))
    assert found.count((5, ROWS[4][1])) == 1 and (None, PASSAGE) in found and (3, None) in found and (4, "") not in found


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    none = docs(spark, [])
    assert kept(op2_passages.cut(none)) == kept(op7_decontamination.clean(none, items)) == kept(op9_simhash.first_of_each(none, one=True)) == []
