"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
WORDS = "word_bpe_49k.json"
BYTES = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
END = 2


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from creditlens.llm.op3_token_files import read_token_files, write_token_files

    return read_token_files(spark, write_token_files(table(spark, sf_dir, "documents"), WORDS, END))


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from creditlens.llm.op10_packing import KEEP, pack

    return pack(table(spark, sf_dir, "documents"), WORDS, END, window=4096, keep=KEEP)


# Words: runs of digits, letters and characters beyond ASCII, in lower case (A-Z alone).
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query("op7_decontamination", rf"""
with items as (select cast(item_id as varchar) as item, {_WORDS} as w from benchmark),
 windows as (select distinct item, least(len(w), 10) as n,
             unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i : i + least(len(w), 10) - 1], ' '))) as phrase
             from items where len(w) > 0),
 texts as (select doc_id, {_WORDS} as w from documents),
 lengths as (select distinct n from windows),
 spans as (select doc_id, n, unnest(range(1, len(w) - n + 2)) as first, w from texts, lengths where len(w) >= n),
 phrases as (select doc_id, n, first, array_to_string(w[first : first + n - 1], ' ') as phrase from spans),
 hits as (select doc_id, p.n, first, item from phrases p join windows v on p.phrase = v.phrase and p.n = v.n),
 words as (select doc_id, count(distinct pos) as n_hit from (select doc_id, unnest(range(first, first + n)) as pos from hits) group by doc_id),
 found as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as list from hits group by doc_id)
select t.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from texts t left join words using (doc_id) left join found using (doc_id)""")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from creditlens.llm.op7_decontamination import find

    found = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.drop("h", "spans")


@query("op9_simhash")
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from creditlens.llm.op9_simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, bits=2)


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from creditlens.llm.op5_toxicity import grade, train

    docs = table(spark, sf_dir, "documents")
    return grade(docs, train(docs, table(spark, sf_dir, "labels"), max_train=12_000))


@query("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from creditlens.llm.op8_quality import score, train

    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels"), max_train=2400))


@query("op4_neighbours")
def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from creditlens.llm.op4_neighbours import search

    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


@query("op2_passages")
def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from creditlens.llm.op2_passages import passages

    return passages(table(spark, sf_dir, "documents"), min_words=50, similarity=0.8, stable=True).drop("h")


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from creditlens.llm.op1_token_counts import own_edits, recount, trees
    from creditlens.llm.shared import written

    docs = table(spark, sf_dir, "documents")
    return recount(docs, written(trees(docs, WORDS)), own_edits(docs), WORDS)


# The replica is made from the pages: of some pages a byte is changed, others lose their end or are left out.
_RECORD = """'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
 || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)"""


@query("op6_fixity", f"""
with p as (select page_id, {_RECORD} as record, cast('0x' || substr(md5('file' || page_id), 1, 4) as bigint) % (select greatest(1, cast(ceil(count(*) / 2048.0) as bigint)) from pages) as file,
             cast('0x' || substr(md5('fault' || page_id), 1, 4) as bigint) % 100 as fault from pages),
 r as (select *, row_number() over (partition by file order by page_id, sha256(record)) - 1 as seq, strlen(record) as length,
             coalesce(sum(strlen(record)) over (partition by file order by page_id, sha256(record) rows between unbounded preceding and 1 preceding), 0) as start from p),
 d as (select *, case fault when 0 then left(record, 10) || '~' || substr(record, 12) when 1 then left(record, length(record) - 8) end as damaged from r where fault < 3)
select file, seq, page_id, cast(start as bigint) as start, cast(length as bigint) as length, case fault when 2 then 'missing' else 'changed' end as found,
       sha256(record) as expected_sha256, sha256(damaged) as found_sha256 from d""")
def op6_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from creditlens.llm.op6_fixity import RECORDS, audit, end_to_end, number, record
    from creditlens.llm.shared import written

    pages = table(spark, sf_dir, "pages")
    files = max(1, -(-pages.count() // RECORDS))
    kept = pages.select((number(F.col("page_id"), "file") % files).alias("file"), "page_id", record(F.col("url"), F.col("html")).alias("record"),
                        (number(F.col("page_id"), "fault") % 100).alias("fault"))
    damaged = (F.when(F.col("fault") == 0, F.concat(F.substring("record", 1, 10), F.lit("~"), F.expr("substring(record, 12)")))
               .when(F.col("fault") == 1, F.expr("left(record, length(record) - 8)")))
    # records lie end to end; damage leaves the offsets of all others as they are
    both = kept.withColumn("damaged", damaged).select("file", "page_id", "fault", F.octet_length("record").alias("length"), F.sha2("record", 256).alias("digest"),
                                                      F.octet_length("damaged").alias("new_length"), F.sha2("damaged", 256).alias("new_digest"))
    both = written(both.withColumn("start", end_to_end()))
    replica = both.filter("fault <> 2").select("file", "page_id", "start", F.coalesce("new_length", "length").alias("length"), F.coalesce("new_digest", "digest").alias("digest"))
    return audit(both.select("file", "page_id", "start", "length", "digest"), replica)


@query("op11_alignment")
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from creditlens.llm.op11_alignment import align

    return align(table(spark, sf_dir, "documents"), BYTES, PIECES)


# The CRC-32 of a decimal number, bit by bit: a byte is mixed in (value >= 0), then eight shifts (-1).
_CRC = """xor(list_reduce(flatten([[4294967295::bigint]] || list_transform(string_split(conv_id::varchar, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
 lambda c, e: case when e >= 0 then xor(c, e) else xor(c >> 1, 3988292384 * (c & 1)) end), 4294967295)"""
_TURN = "sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))"


@query("op13_prefix_trie", rf"""
with t as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, {_TURN}) - 1 as i, {_TURN} as d,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as w from conversations where conv_id is not null),
 c as (select conv_id, {_CRC} % 4 as h from (select distinct conv_id from t)),
 r as (select c.conv_id, 0 as part, i, d, w from c join t on t.conv_id = c.conv_id - c.conv_id % 20 and t.i < h
       union all select c.conv_id, 1, i, d, w from c join t on t.conv_id = c.conv_id and t.i >= h),
 s as (select c.conv_id, coalesce(p, []) as p, coalesce(ws, []) as ws
       from c left join (select conv_id, list(d order by part, i) as p, list(w order by part, i) as ws from r group by conv_id) using (conv_id)),
 m as (select conv_id, p, ws, unnest(range(0, len(p) + 1)) as depth from s),
 g as (select depth, md5(array_to_string(p[1:depth], ',')) as node, case when depth > 0 then md5(array_to_string(p[1:depth - 1], ',')) end as above, min(conv_id) as conv_id,
         count(*) as n_convs, min(case when depth > 0 then ws[depth] else 0 end) as w, any_value(p[1:depth]) as path,
         coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where len(p) = depth), '') as ends from m group by all),
 k as (select above, depth - 1 as depth, count(*) as n from g where depth > 0 group by all),
 f as (select g.*, coalesce(k.n, 0) as n_children from g left join k on k.above = g.node and k.depth = g.depth),
 u as (select unnest(range(0, depth + 1)) as d, path, (n_convs - 1) * w as saved, n_children = 0 as leaf from f),
 a as (select d as depth, md5(array_to_string(path[1:d], ',')) as node, sum(saved)::bigint as saved_tokens, count(*) filter (where leaf) as n_leaves from u group by all)
select f.conv_id, f.depth, o.conv_id as parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, sha256(f.ends) as ends_sha256
from f join a on a.node = f.node and a.depth = f.depth left join g o on o.node = f.above and o.depth = f.depth - 1""")
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from creditlens.llm.op13_prefix_trie import rebuilt, sequences, trie
    from creditlens.llm.shared import written

    return trie(rebuilt(written(sequences(table(spark, sf_dir, "conversations"))), every=20, most=4))


@query("op12_suffix_tree")
def op12_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from creditlens.llm.op12_suffix_tree import scores

    return scores(table(spark, sf_dir, "documents"), depth=2, divergence=2.0)
