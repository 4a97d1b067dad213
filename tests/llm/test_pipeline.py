"""The pipeline's stages against plain versions, each on its own input."""

import numpy as np

import corpus_pipeline
from creditlens.llm import op2_passages, op5_toxicity
from test_decontamination import brute
from test_packing_files import check_pieces
from test_simhash import plain_components, plain_fingerprint


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    labels = spark.read.parquet(f"{small_dir}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash near-dedup", "substring dedup", "benchmark decontamination", "packing"]
    stage = [f for _, f in corpus_pipeline.STAGES]

    one = stage[0](spark, docs, small_dir).cache()
    model = op5_toxicity.train(docs, labels, max_train=12_000)
    score = {d: float(model.above(np.array([model.score(t)]))[0, 0]) for d, t in texts(docs).items()}
    assert texts(one) == {d: t for d, t in texts(docs).items() if score[d] < model.cut}

    two = stage[1](spark, one, small_dir).cache()
    own = sorted(texts(one).items())
    label = plain_components([plain_fingerprint(t) for _, t in own], 2)
    assert sorted(texts(two)) == [d for i, (d, _) in enumerate(own) if label[i] == i]

    three = stage[2](spark, two, small_dir).cache()
    before, after = texts(two), texts(three)
    spans = {}
    for r in op2_passages.passages(two).collect():
        assert r.ref_doc_id < r.doc_id and r.length >= 50 and r.matched >= 0.8 * r.length
        spans.setdefault(r.doc_id, []).append((r.start, r.length))
    for d, t in before.items():
        left = op2_passages.without(t, spans[d]) if d in spans else t
        assert after.get(d, left) == left and (d in after or not any(c.isalnum() for c in left))

    four = stage[3](spark, three, small_dir).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    assert sorted(texts(four)) == sorted(r[0] for r in brute(sorted(after.items()), items) if not r[5])
    assert all(x.columns == docs.columns for x in (one, two, three, four))

    check_pieces(stage[4](spark, four, small_dir).collect(), four.collect(), 4096)


def test_run(spark, small_dir):
    pieces = corpus_pipeline.run(spark, small_dir).collect()
    assert pieces and len({p.doc_id for p in pieces}) < spark.read.parquet(f"{small_dir}/documents.parquet").count()
