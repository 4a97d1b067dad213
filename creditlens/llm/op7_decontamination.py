"""Benchmark decontamination by a prefix-filtered join, in DataFrame operations only.

A benchmark item gives windows of ``window`` consecutive words (one shorter window where it
has fewer).  A window is a set of tokens that a document must hold whole, so the prefix that
has to meet is its single rarest token.  Tokens are ordered by how often all documents hold
them; only the rarest token of each window is joined with the positions of the documents'
words.  Its place in the window gives the start (positional bound), and the window must end
within the document (length bound).  What is left is verified word by word.

Defined results: null or empty texts have no words, and so no hits; rows with equal or null
doc_ids are judged each by its own text; items without words, or with a null text, have no
windows; item_ids that repeat count once; a null item_id counts as an empty string; an empty
benchmark finds nothing; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.llm.shared import ascii_lower, fresh, text_or_empty, written

# Between words: ASCII characters other than digits and, in lower case, letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Benchmark-derived tables of at most so many bytes are broadcast; larger ones are shuffled.
BROADCAST_BYTES = 8 << 20


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), BETWEEN), "")


def _windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item, phrase, length): the distinct windows of every item, phrases space-joined."""
    own = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                           words(text_or_empty()).alias("w")).filter("size(w) > 0")
    own = own.withColumn("n", F.least(F.size("w"), F.lit(window)))
    return own.select("item", "n", F.explode(F.expr("transform(sequence(1, size(w) - n + 1), i -> array_join(slice(w, i, n), ' '))")).alias("phrase")).distinct()


def find(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans) of every document.

    ``spans`` holds the verified occurrences as (start, length) in words, ascending.
    """
    pairs = written(_windows(benchmark, window))
    phrases = written(pairs.select("phrase", "n").distinct().withColumn("phrase_id", F.monotonically_increasing_id()))
    size = phrases.agg(F.coalesce(F.sum(F.octet_length("phrase") + 40), F.lit(0))).first()[0]
    small = F.broadcast if size <= BROADCAST_BYTES else (lambda df: df)

    text = docs.select(F.col("doc_id"), F.xxhash64("text").alias("h"), words(text_or_empty()).alias("w"))
    tokens = phrases.select("phrase_id", "phrase", "n", F.posexplode(F.split("phrase", " ")).alias("j", "word"))
    vocabulary = tokens.select("word").distinct()
    seen = text.select(F.explode("w").alias("word")).join(small(vocabulary), "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("seen"))
    # a window with a word that no document holds occurs nowhere: the inner join drops it
    ranked = tokens.join(written(seen), "word", "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    rarest = written(ranked.groupBy("phrase_id", "phrase", "n").agg(F.min(F.struct("seen", "word", "j")).alias("r"))
                     .filter("r.seen > 0").select("phrase_id", "phrase", "n", "r.word", "r.j"))

    placed = text.select("doc_id", "h", F.size("w").alias("size"), F.posexplode("w").alias("at", "word"))
    candidates = (placed.join(small(rarest), "word").withColumn("start", F.col("at") - F.col("j"))
                  .filter("start >= 0 and start + n <= size")
                  .groupBy("doc_id", "h").agg(F.collect_set(F.struct("start", "n", "phrase_id", "phrase")).alias("c")))
    c = candidates.select(F.col("doc_id").alias("c_id"), F.col("h").alias("c_h"), "c")
    verified = (text.join(c, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("h") == F.col("c_h")), "left")
                .select("doc_id", "h", F.size("w").cast("long").alias("n_words"),
                        F.expr("filter(coalesce(c, array()), x -> array_join(slice(w, x.start + 1, x.n), ' ') = x.phrase)").alias("hits")))
    verified = written(verified.select(
        "doc_id", "h", "n_words",
        F.expr("array_sort(array_distinct(transform(hits, x -> struct(x.start as start, x.n as length))))").alias("spans"),
        F.expr("array_distinct(transform(hits, x -> x.phrase_id))").alias("phrase_ids")))

    items = (verified.filter("size(phrase_ids) > 0").select("doc_id", "h", F.explode("phrase_ids").alias("phrase_id"))
             .join(phrases.join(pairs, ["phrase", "n"]).select("phrase_id", "item"), "phrase_id")
             .groupBy(F.col("doc_id").alias("i_id"), F.col("h").alias("i_h")).agg(F.array_sort(F.collect_set("item")).alias("items")))
    out = verified.join(items, F.col("doc_id").eqNullSafe(F.col("i_id")) & (F.col("h") == F.col("i_h")), "left")
    covered = F.expr("""aggregate(spans, struct(0 as upto, 0 as n),
        (a, s) -> struct(greatest(a.upto, s.start + s.length) as upto,
                         a.n + greatest(0, s.start + s.length - greatest(a.upto, s.start)) as n), a -> a.n)""").cast("long")
    own = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", covered.alias("n_hit"), F.size(own).cast("long").alias("n_items"),
                      F.sha2(F.array_join(own, ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), "h", "spans")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents, all columns, that hold no window of the benchmark."""
    own_id, own_h = fresh(2)
    bad = find(docs, benchmark, window).filter("contaminated").select(F.col("doc_id").alias(own_id), F.col("h").alias(own_h)).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col(own_id)) & (F.xxhash64(docs["text"]) == F.col(own_h)), "left_anti")
