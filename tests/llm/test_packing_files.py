"""Token files and packing against whole-text encodings by the library."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from creditlens.llm.encoding import encoder
from creditlens.llm.op3_token_files import read_token_files, write_token_files
from creditlens.llm.op10_packing import Rounds, pack

WORDS, END = "word_bpe_49k.json", 2
ODD = ["ΑΣ ΟΔΟΣ", "a<|endoftext|>b <|endoftext|> c", "İstanbul ǅ", "é x́", "\x1c a\x85b c", "it's I'LL '", "", "  ",
       "½²ª 日本語 हिन्दी", "</w> w</w>", "a\tb\rc\x0bd\x0ce", "ſ ŉ ß ÿ ­ x", "don't''s", "1234 a1b2", "x!!. y... z., q", "The end. The, end.\nA"]


def library(texts):
    t = Tokenizer.from_file(str(public_tokenizers.path(WORDS)))
    return [np.array([*e.ids, END], dtype="<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(ODD)]
    rows += [(100, None, None), (101, "long words here. " * 4000, "s0"), (102, "tail", "s9"), (102, "tail", "s9"), (None, "no id", "s1")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'x' as ids", "1 as start")


def test_encoder_matches_library(small_dir):
    import pyarrow.parquet as pq

    texts = pq.read_table(f"{small_dir}/documents.parquet")["text"].to_pylist() + ODD
    assert encoder(WORDS).encode_many(texts) == encoder(WORDS).library(texts)


def test_token_files(spark, docs):
    rows = read_token_files(spark, write_token_files(docs, WORDS, END), with_ids=True).collect()
    given = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert len(rows) == len(given)
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [r.doc_id for r in given]
    at = 0
    for r, ids in zip(rows, library([g.text for g in given])):
        assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (at, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes())
        at += len(ids)


def check_pieces(pieces, given, window):
    ids = {}
    for g, x in zip(given, library([g.text for g in given])):
        ids.setdefault(g.doc_id, x)
    sequences, covered = {}, {}
    for p in pieces:
        x = ids[p.doc_id]
        assert p.doc_tokens == len(x) and p.ids_crc32 == zlib.crc32(x[p.start:p.start + p.length].tobytes())
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        covered.setdefault(p.doc_id, []).append((p.start, p.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at == window or at < window and at & (at - 1) == 0
    copies = {}
    for g in given:
        copies[g.doc_id] = copies.get(g.doc_id, 0) + 1
    for doc, own in covered.items():
        count = np.zeros(len(ids[doc]), dtype=int)
        for s, n in own:
            count[s:s + n] += 1
        assert (count == copies[doc]).all()
    assert covered.keys() == copies.keys()


@pytest.mark.parametrize("window,chunk", [(4096, 4), (64, 2)])
def test_pack(spark, docs, window, chunk):
    check_pieces(pack(docs, WORDS, END, window, chunk).collect(), docs.collect(), window)


def test_pack_proportions(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    pieces = pack(docs, WORDS, END, 4096).collect()
    check_pieces(pieces, docs.collect(), 4096)
    total, by = 0, {}
    for p in pieces:
        total += p.length
        by[p.source] = by.get(p.source, 0) + p.length
    last = max(p.sequence_id for p in pieces)
    for seq in range(0, total // 4096 - 1):
        own = {}
        for p in pieces:
            if p.sequence_id == seq:
                own[p.source] = own.get(p.source, 0) + p.length
        for s, n in by.items():
            assert abs(own.get(s, 0) - 4096 * n / total) <= (len(by) + 2) * 4
    assert last >= total // 4096 - 1


def test_weights_and_many_sources(spark):
    rows = [(i, f"word{i} and more words", f"host{i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check_pieces(pack(docs, WORDS, END, 256).collect(), docs.collect(), 256)
    two = docs.selectExpr("doc_id", "text", "if(doc_id % 2 = 0, 'a', 'b') as source")
    pieces = pack(two, WORDS, END, 256, 8, weights={"a": 3.0, "b": 1.0}).collect()
    check_pieces(pieces, two.collect(), 256)
    first = [p for p in pieces if p.sequence_id < 3]
    assert abs(sum(p.length for p in first if p.source == "a") / sum(p.length for p in first) - 0.75) < 0.05


def test_shares_of_more_sources_than_queues(spark):
    rows = [(i, "word " * (90 if i < 300 else 9), f"host{i % 300}" if i < 600 else f"tiny{i}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    given = docs.collect()

    def tokens(pieces, wanted):
        out = {}
        for p in pieces:
            if wanted(p):
                out[p.source] = out.get(p.source, 0) + p.length
        return out

    pieces = pack(docs, WORDS, END, 2048).collect()
    check_pieces(pieces, given, 2048)
    whole = tokens(pieces, lambda p: True)
    total = sum(whole.values())
    for seq in range(total // 2048):
        before = tokens(pieces, lambda p: p.sequence_id <= seq)
        for source, n in whole.items():
            assert abs(before.get(source, 0) - n * (seq + 1) * 2048 / total) <= 20, (seq, source)
        tiny = sum(n for source, n in before.items() if source[0] == "t") / sum(before.values())
        assert abs(tiny - sum(n for source, n in whole.items() if source[0] == "t") / total) < 0.05
    heavy = pack(docs, WORDS, END, 2048, weights={"": 100.0, "tiny899": 100.0, **{f"host{i}": 1.0 for i in range(300)}}).collect()
    check_pieces(heavy, given, 2048)
    first = tokens(heavy, lambda p: p.sequence_id == 0)
    assert first["tiny899"] == whole["tiny899"] > 0
    with pytest.raises(ValueError):
        pack(docs, WORDS, END, 2048, weights={f"host{i}": 1.0 for i in range(300)})


def test_rounds_serve_everything_once():
    r = Rounds([1000, 37, 1, 555], None, 64, 4)
    k = np.arange(0, 200)
    s = r.served(k)
    assert (np.diff(s, axis=0) >= 0).all() and (s[-1] == r.totals).all()


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert pack(docs, WORDS, END).count() == 0
    assert read_token_files(spark, write_token_files(docs, WORDS, END)).count() == 0


def test_packing_remembers_more_pieces():
    from creditlens.llm import op10_packing

    texts = ["some words, and some more.", "WORDS again 12 é", ""]
    few, many = encoder("word_bpe_49k.json"), encoder("word_bpe_49k.json", op10_packing.KEEP)
    assert many.keep == op10_packing.KEEP > few.keep
    assert few.encode_many(texts) == many.encode_many(texts) == many.library(texts)
