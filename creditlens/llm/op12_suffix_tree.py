"""Language-model scores by a probabilistic suffix tree over words.

A state of the tree is a context: the last k words, k up to ``depth``, the start of a document
being one.  What follows a context c has the distribution

    P(x | c) = (n(c, x) + T(c) P(x | shorter c)) / (N(c) + T(c))

with N(c) occurrences and T(c) different continuations in the training documents, down to the
root, P(x) = (n(x) + 0.5) / (N + 0.5 (V + 1)), where all unknown words are one symbol.  A
context with ``least`` occurrences (two, where not given: each is left out of its own counts,
so one alone tells nothing) is a state if its distribution diverges from that of the
context one word shorter: the logarithm of their ratio, each occurrence left out of its own
counts, summed over its occurrences, exceeds ``divergence``.  A token has the probability that
the longest suffix state of its history gives it.

Documents are cut once into chunks of about a million tokens: ids into the chunk's own words,
and 64-bit hashes of these.  A pass over the chunks asks for what the next one needs, in
packed blocks (``blocks``): counts of a level's continuations, then the T of its contexts,
then their divergences.  A level counts only after contexts that the level above found often
enough.  No count leaves the exchange but as an answer to a chunk that holds its key, so no
task holds the model, and the model grows with the corpus.

Defined results: a null or empty text is its end alone; a null doc_id is scored but neither
learned from nor held out; repeated rows count and are scored each; an empty table gives no
rows; without training documents every token has probability 1 at the root; other columns
are not read.  A very long text is a chunk of its own.  Words are told apart by 64-bit
hashes.  Sums that decide a state are of whole numbers, so they don't depend on their order.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.llm.blocks import REQUEST, answered, answers_to, pack, ranges_for, requests, unpack
from creditlens.llm.shared import text_or_empty, written

SEED = 42
TOKENS = 1 << 20      # tokens of a chunk, about
LEAST = 2             # occurrences that a context needs, whatever the size of the corpus
ROOT = 160            # by which the root of the training tokens is divided in ``least_for``
UNIT = 1 << 32        # fixed point of 1 / n
GAIN = 1 << 20        # fixed point of a logarithm
COUNT, KINDS, STATE = 0, 8, 16  # what a request of level k asks for: this + k
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
CHUNKS = "chunk long, docs array<long>, held array<boolean>, train array<boolean>, lengths array<long>, words binary, tokens binary"
_CHUNK = pa.schema([("chunk", pa.int64()), ("docs", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("train", pa.list_(pa.bool_())),
                    ("lengths", pa.list_(pa.int64())), ("words", pa.binary()), ("tokens", pa.binary())])


def chunks(docs: DataFrame) -> DataFrame:
    """The documents in chunks, as ids of the chunk's words; the end of a document is the empty word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        task, number = TaskContext.get().partitionId() << 32, count()

        def out() -> pa.RecordBatch:
            tokens = np.concatenate(ids)
            often = np.argsort(-np.bincount(tokens, minlength=len(known)), kind="stable")  # small ids for frequent words
            rank = np.empty(len(often), dtype="<u4")
            rank[often] = np.arange(len(often), dtype="<u4")
            hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in known), dtype="<u8", count=len(known))
            row = [task + next(number), *rows, pack(hashes[often]), pack(rank[tokens])]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _CHUNK.types)], schema=_CHUNK)

        def fresh():
            return defaultdict(count().__next__), [], ([], [], [], [])

        known, ids, rows = fresh()
        size = 0
        for batch in batches:
            for doc_id, rest, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "rest", "text"))):
                words = text.lower().split()  # of bytes: A-Z alone, and ASCII white space alone
                words.append(b"")
                ids.append(np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words)))
                for column, value in zip(rows, (doc_id, rest == 1, rest is not None and rest != 1, len(words))):
                    column.append(value)
                size += len(words)
                if size >= TOKENS:
                    yield out()
                    known, ids, rows = fresh()
                    size = 0
        if size:
            yield out()

    rows = docs.select(F.col("doc_id").cast("long"), (F.crc32(F.col("doc_id").cast("string")) % 5).alias("rest"), text_or_empty().cast("binary").alias("text"))
    return written(rows.mapInArrow(run, CHUNKS))


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes, in this order."""
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x632BE59BD9B4E019))
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Chunk:
    """What a chunk knows so far: counts n, N and T and probabilities of its tokens at each level."""

    def __init__(self, row: dict, whole: tuple[int, int], least: int):
        self.lengths, self.least = np.array(row["lengths"], dtype=np.int64), least
        self.words, self.tokens = unpack(row["words"], "<u8"), unpack(row["tokens"], "<u4").astype(np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.place = np.arange(len(self.tokens)) - np.repeat(self.first, self.lengths)
        self.train = np.repeat(np.array(row["train"], dtype=bool), self.lengths)
        self.end = int(self.tokens[-1])
        self.train_tokens, self.distinct = whole

    def back(self, k: int, at: np.ndarray) -> np.ndarray:
        """The token k places before those at ``at``, the document's end standing for its start."""
        return np.where(self.place[at] >= k, self.tokens[at - k], self.end)

    def root(self, totals: np.ndarray) -> None:
        """From the training counts of the words, in order of their hashes."""
        counts = np.empty(len(self.words), dtype=np.int64)
        counts[np.argsort(self.words)] = totals
        self.n = counts[self.tokens]
        self.base = self.p = (self.n + 0.5) / (self.train_tokens + 0.5 * (self.distinct + 1))
        self.known, self.end_count = self.n > 0, int(counts[self.end])
        self.logp = np.log10(self.p)
        self.context, self.active = None, np.ones(len(self.tokens), dtype=bool)

    def deepen(self, k: int) -> None:
        """Go from the contexts of k - 1 words to those of k words that are frequent enough."""
        before = np.r_[0, self.n[:-1]]  # the context's count is that of its last word after the words before it
        self.N = np.where(self.place >= 1, before, self.end_count if k == 1 else 0)
        now = (self.place >= k - 1) & (self.N >= self.least)
        if k > 1:
            now &= self.active
        self.parent, self.active = self.p, now
        self.at = at = np.flatnonzero(now)
        last = self.back(k, at)
        if k == 1:  # a context is a word of the chunk
            seen = np.flatnonzero(np.bincount(last, minlength=len(self.words)))
            keys = _mix(np.full(len(seen), SEED, dtype=np.uint64), self.words[seen])
            order = np.argsort(keys)
            self.contexts, place = keys[order], np.zeros(len(self.words), dtype=np.int64)
            place[seen[order]] = np.arange(len(seen))
            self.of = place[last]
        else:
            self.contexts, self.of = np.unique(_mix(self.context[at], self.words[last]), return_inverse=True)
        self.context = np.zeros(len(self.tokens), dtype=np.uint64)
        self.context[at] = self.contexts[self.of]
        self.grams, self.gram = np.unique(_mix(self.context[at], self.words[self.tokens[at]]), return_inverse=True)

    def counted(self, totals: np.ndarray) -> None:
        self.n = np.zeros(len(self.tokens), dtype=np.int64)
        self.n[self.at] = totals[self.gram]

    def weighed(self, kinds: np.ndarray) -> None:
        """From T of the contexts: the probabilities at this level."""
        self.T = kinds[self.of]
        n, N, par = self.n[self.at], self.N[self.at], self.parent[self.at]
        self.p = self.parent.copy()
        self.p[self.at] = (n + self.T * par) / (N + self.T)

    def judged(self, state: np.ndarray) -> None:
        """Tokens after a state have its probability; longer states come later."""
        own = self.at[state[self.of] > 0]
        self.logp[own] = np.log10(self.p[own])

    def sums(self, of: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
        """Whole numbers of the training tokens summed by their key."""
        out = np.zeros(n, dtype=np.int64)
        own = self.train[self.at]
        np.add.at(out, of[own], values[own])
        return out

    def kinds(self) -> np.ndarray:
        n = self.n[self.at]
        return self.sums(self.of, len(self.contexts), np.where(n > 0, np.rint(UNIT / np.maximum(n, 1)), 0).astype(np.int64))

    def gains(self) -> np.ndarray:
        """Each training token left out of its own counts: how much better its context tells it than the shorter one."""
        n, N, par = self.n[self.at], self.N[self.at], self.parent[self.at]
        kinds = self.T - (n == 1)
        seen = self.train[self.at]
        ratio = np.ones(len(n))
        ratio[seen] = ((n[seen] - 1) / par[seen] + kinds[seen]) / (N[seen] - 1 + kinds[seen])
        return self.sums(self.of, len(self.contexts), np.rint(np.log(ratio) * GAIN).astype(np.int64))


def _learn(row: dict, folders: list[str], whole: tuple[int, int], least: int, depth: int, n: int) -> tuple[Chunk, list[pa.RecordBatch]]:
    """A chunk with all answers so far, and what it asks for next.

    After the words' counts (pass 0), pass p asks for the counts of level p, for T of level
    p - 1 and for the divergences of level p - 2.
    """
    chunk, asked, passes = Chunk(row, whole, least), [], len(folders)
    got = [answers_to(f, row["chunk"]) for f in folders]

    def answer(p: int, kind: int) -> np.ndarray:
        return got[p].get(kind, np.zeros(0, dtype=np.int64))

    def ask(kind: int, keys: np.ndarray, own: np.ndarray) -> None:
        asked.append(requests(kind, row["chunk"], keys, own.astype("<i8"), n))

    if not passes:
        order = np.argsort(chunk.words)
        ask(COUNT, chunk.words[order], np.bincount(chunk.tokens[chunk.train], minlength=len(order))[order])
        return chunk, asked
    chunk.root(answer(0, COUNT))
    for k in range(1, min(depth, passes) + 1):
        chunk.deepen(k)
        if passes == k:
            ask(COUNT + k, chunk.grams, chunk.sums(chunk.gram, len(chunk.grams), np.ones(len(chunk.at), dtype=np.int64)))
            break
        chunk.counted(answer(k, COUNT + k))
        if passes == k + 1:
            ask(KINDS + k, chunk.contexts, chunk.kinds())
        else:
            chunk.weighed(answer(k + 1, KINDS + k))
            if passes == k + 2:
                ask(STATE + k, chunk.contexts, chunk.gains())
            else:
                chunk.judged(answer(k + 2, STATE + k))
    return chunk, asked


def least_for(train_tokens: int) -> int:
    """A ``least`` for callers who want a smaller model of a larger corpus; ``scores`` doesn't take it by itself."""
    return max(2, math.ceil(math.sqrt(train_tokens) / ROOT))


def scores(docs: DataFrame, depth: int = 2, least: int = LEAST, divergence: float = 2.0) -> DataFrame:
    """Every document's log10 probability by the tree and by its root alone.

    ``doc_id`` whose crc32 leaves 1 when divided by 5 are held out.
    """
    if least < 2 or not 0 <= depth < 8:
        raise ValueError("contexts occur twice at least and have up to 7 words")
    cut = chunks(docs)
    tokens = cut.select(F.sum(F.expr("aggregate(lengths, 0L, (a, x) -> a + x)"))).first()[0] or 0
    n, folders, whole = ranges_for(tokens), [], (0, 0)

    def judge(kind: int, totals: np.ndarray) -> np.ndarray:
        if kind >= STATE:
            return (totals > divergence * GAIN).astype(np.int64)
        return (totals + UNIT // 2) // UNIT if kind >= KINDS else totals

    for _ in range(1 + (depth + 2 if depth else 0)):
        def ask(batches: Iterator[pa.RecordBatch], done=tuple(folders), whole=whole) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield from _learn(batch.slice(i, 1).to_pylist()[0], list(done), whole, least, depth, n)[1]

        folder, answers = answered(cut.mapInArrow(ask, REQUEST), judge)
        if not folders:
            whole = tuple(x or 0 for x in answers.agg(F.sum("whole"), F.sum("distinct")).first())
        folders.append(folder)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk = _learn(row, folders, whole, least, depth, n)[0]
                sums = [np.add.reduceat(x, chunk.first) for x in (chunk.known.astype(np.int64), np.log10(chunk.base), chunk.logp)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["docs"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(chunk.lengths), pa.array(sums[0]),
                     pa.array(np.full(len(chunk.lengths), whole[0])), pa.array(sums[1]), pa.array(sums[2])],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return cut.mapInArrow(score, SCORES)
