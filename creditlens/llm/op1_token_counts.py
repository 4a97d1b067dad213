"""Token counts that follow edits: a segment tree of pre-tokens for each document.

``trees`` cuts every text into leaves of whole pre-tokens and keeps each leaf's characters
and tokens.  ``recount`` applies edits in order: the tree is descended by characters to the
leaves that an edit touches, context is added until the region starts and ends where no
token can cross, that region alone is encoded again, and the sums above it are updated.  A
leaf that has grown to several times its size makes the tree of its document be laid out
anew, from counts that are known and the region's own.

A cut lies before white space that follows a character other than white space; no tokenizer
of the supplied files merges across it.

Edits: (doc_id, seq, start, deleted, inserted), in characters of the text as the edits with
a smaller seq have left it.  Defined results: places beyond the text are moved to its end,
negative and null numbers count as 0, a null insertion is empty; ties of seq go by the
other columns; a null text is empty; rows with the same doc_id all get its edits; edits
without a document, or with a null doc_id, do nothing; documents without edits keep their
counts; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.llm.encoding import encoder
from creditlens.llm.shared import partitions, text_or_empty

LEAF = 384          # characters of a leaf, and on to the next cut
CUT = re.compile(r"\S(?=[ \t\n\r])")
SPACE = " \t\n\r"
COUNTS = ("doc_id long, n_tokens_before long, n_tokens long, n_edits long, n_chars long, encoded_chars long, n_leaves long")


def leaves(text: str) -> list[str]:
    """The text in runs of whole pre-tokens."""
    out, at = [], 0
    while at < len(text):
        m = CUT.search(text, at + LEAF)
        to = m.end() if m else len(text)
        out.append(text[at:to])
        at = to
    return out


def counter(tokenizer: str) -> Callable[[list[str]], list[int]]:
    e = encoder(tokenizer)
    size = e.dtype.itemsize
    return lambda texts: [len(x) // size for x in e.encode_many(texts)]


class Tree:
    """Sums of characters and tokens over leaves, in the order of a binary heap."""

    def __init__(self, texts: list[str], tokens: list[int], count: Callable[[list[str]], list[int]]):
        self.count, self.encoded = count, 0
        self._lay(texts, tokens)

    def _lay(self, texts: list[str], tokens: list[int]) -> None:
        self.texts, n = list(texts) or [""], 1
        while n < len(self.texts):
            n *= 2
        self.n = n
        self.chars, self.tokens = [0] * (2 * n), [0] * (2 * n)
        for i, t in enumerate(self.texts):
            self.chars[n + i], self.tokens[n + i] = len(t), tokens[i] if tokens else 0
        for i in range(n - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds the character, and the characters before the leaf; the end belongs to the last."""
        if at >= self.chars[1]:
            at = max(0, self.chars[1] - 1)
        node, before = 1, 0
        while node < self.n:
            node *= 2
            if at - before >= self.chars[node] and self.chars[node + 1]:
                before += self.chars[node]
                node += 1
        return min(node - self.n, len(self.texts) - 1), before

    def _put(self, leaf: int, text: str, tokens: int) -> None:
        self.texts[leaf] = text
        i = self.n + leaf
        more, rise = len(text) - self.chars[i], tokens - self.tokens[i]
        while i:
            self.chars[i] += more
            self.tokens[i] += rise
            i //= 2

    def edit(self, start: int, deleted: int, inserted: str) -> None:
        whole = self.chars[1]
        start = min(max(0, start), whole)
        end = min(whole, start + max(0, deleted))
        first, before = self.find(start)
        last, ahead = self.find(max(start, end - 1))
        region = "".join(self.texts[first:last + 1])
        region = region[:start - before] + inserted + region[end - before:]
        while first > 0 and region and region[0] not in SPACE:  # no cut before it any more
            first -= 1
            region = self.texts[first] + region
        while last + 1 < len(self.texts) and region and region[-1].isspace():  # no cut after it
            last += 1
            region += self.texts[last]
        parts = leaves(region) if len(region) > 4 * LEAF else [region]
        tokens = self.count(parts)
        self.encoded += len(region)
        if len(parts) > last - first + 1:
            old = [self.tokens[self.n + i] for i in range(len(self.texts))]
            self._lay(self.texts[:first] + parts + self.texts[last + 1:], old[:first] + tokens + old[last + 1:])
            return
        parts += [""] * (last - first + 1 - len(parts))
        tokens += [0] * (len(parts) - len(tokens))
        for i, (t, k) in enumerate(zip(parts, tokens)):
            self._put(first + i, t, k)


def trees(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, h, tokens) of every document: the tokens of its leaves; h is the text's ``xxhash64``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                cut = [leaves(t.as_py()) for t in part.column("text")]
                flat = iter(count([x for c in cut for x in c]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("h"), pa.array([[next(flat) for _ in c] for c in cut], pa.list_(pa.int64()))],
                                                 names=["doc_id", "h", "tokens"])

    text = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), text_or_empty().alias("text"))
    return text.mapInArrow(run, "doc_id long, h long, tokens array<long>")


def recount(docs: DataFrame, known: DataFrame, edits: DataFrame, tokenizer: str) -> DataFrame:
    """Counts of every document before and after its edits, with the characters encoded again.

    ``known``: the result of ``trees`` on the same documents.  Trees, texts and edits of a
    document meet in that order in one task, which holds one doc_id's texts at a time.
    """
    empty = {"h": "long", "tokens": "array<long>", "text": "string", "seq": "long", "start": "long", "deleted": "long"}

    def side(df: DataFrame, kind: int) -> DataFrame:
        own = [F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in empty.items()]
        return df.select("doc_id", F.coalesce("doc_id", F.xxhash64("h") if "h" in df.columns else F.lit(0).cast("long")).alias("key"), F.lit(kind).alias("kind"), *own)

    text = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), text_or_empty().alias("text"))
    change = edits.filter("doc_id is not null").select(F.col("doc_id").cast("long"), F.coalesce("inserted", F.lit("")).alias("text"),
                                                       *[F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in ("seq", "start", "deleted")])
    rows = (side(known.dropDuplicates(["doc_id", "h"]), 0).unionByName(side(text, 1)).unionByName(side(change, 2))
            .repartition(partitions(docs.sparkSession), "key").sortWithinPartitions("key", "doc_id", "kind", "seq", "start", "deleted", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        names = [x.split()[0] for x in COUNTS.split(", ")]

        def done(own: list, doc_id: int | None) -> list[tuple]:
            return [(doc_id, before, t.tokens[1], n, t.chars[1], t.encoded, len(t.texts)) for t, before, n in own]

        at, sums, own = (), {}, []
        for b in batches:
            out = []
            for doc_id, key, kind, h, tokens, text, _, start, deleted in zip(*(b.column(c).to_pylist() for c in ("doc_id", "key", "kind", "h", "tokens", "text", "seq", "start", "deleted"))):
                if (key, doc_id) != at:
                    out += done(own, at[1] if at else None)
                    at, sums, own = (key, doc_id), {}, []
                if kind == 0:
                    sums[h] = tokens
                elif kind == 1:
                    cut = leaves(text)
                    t = Tree(cut, sums[h] if h in sums else count(cut), count)
                    own.append([t, t.tokens[1], 0])
                else:
                    for x in own:
                        x[0].edit(start, deleted, text)
                        x[2] += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)
        if own:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done(own, at[1]))], names=names)

    return rows.mapInArrow(run, COUNTS)


def own_edits(docs: DataFrame) -> DataFrame:
    """One to three edits of every document, made from its own text: a run of its characters put in another's place."""
    text = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), text_or_empty().alias("t"))
    rows = text.select("doc_id", "t", F.explode(F.sequence(F.lit(0).cast("long"), F.pmod(F.xxhash64("doc_id"), F.lit(3)))).alias("seq"))
    place = [F.pmod(F.xxhash64("doc_id", "seq", F.lit(i)), F.greatest(F.length("t"), F.lit(1))).cast("int") for i in (1, 2)]
    size = F.pmod(F.xxhash64("doc_id", "seq", F.lit(3)), F.lit(60)).cast("int")
    return rows.select("doc_id", "seq", place[0].alias("start"), size.alias("deleted"), F.substring("t", place[1] + 1, size + 5).alias("inserted"))
