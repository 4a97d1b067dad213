"""Cross-tokenizer alignment: two tokenizations of the same bytes, and how they correspond.

1. Exact-text deduplication: documents are grouped by full text with a partial count in every
   task, so a text that a third of all rows share is shuffled once per task.  Each distinct
   text is tokenised and aligned once.
2. Alignment: both tokenizers cover the bytes of space+text.  The union of their token ends cuts
   the bytes into intervals; an interval lies in one token of each, which is one link, and no
   two intervals are the same pair of occurrences.  Common ends close the groups.  A batch of
   texts is one run of bytes for numpy, because every text ends in both.
   Where a text has single spaces alone, neither tokenizer merges across one, so its tokens are
   those of its words (a space and what follows up to the next) in turn; words already met
   are kept in the worker.  All other texts are encoded whole.
3. Pair counts: a text's distinct pairs (b << 16 | a) and their numbers are written with it.
   Tasks sum them, times the copies of the text, before the exchange by pair.
4. Measures: the counts are written in ranges of pairs.  A task sorts the pairs of a group of texts
   and goes through the ranges one at a time, so it holds one range, however many pairs there
   are; their number is bounded by the two vocabularies, not by the corpus.
5. The measures of a text are joined to the doc_ids by the SHA-256 of the text.

Defined results: null and empty texts, and texts whose joined token bytes differ from
space+text, have zeros and '' as digest; rows with equal texts get equal measures, and each
adds to the counts; a null doc_id stays null; an empty table gives no rows; other columns
are not read.  A very long text is a batch of its own.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditlens.llm.encoding import tokenizer_path
from creditlens.llm.op3_token_files import filesystem
from creditlens.llm.shared import partitions, shared_folder, written

CHARS = 400_000     # characters of the texts that are aligned at once
HELD = 1 << 22      # pairs that a task holds at once
RANGE = 1 << 20     # pairs of one range of the counts
MEASURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
KEPT = 400_000      # words that a worker keeps
_RUNS = re.compile(r"\s \s?| \s")  # white space beside a space
_PLAIN = re.compile("[!-~¡-¬®-ſ]+")  # ASCII and Latin letters, no marks that combine
_NONE = np.zeros(0, dtype="<u4")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class Pair:
    """Two tokenizers, the bytes of their tokens and the decimal ids that a digest is made of."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # special strings inside texts are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size_a, size_b = self.a.get_vocab_size(), self.b.get_piece_size()
        if size_a > 1 << 16 or size_b > 1 << 16:
            raise ValueError("a pair has 16 bits for each id")
        # byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [x for x in range(256) if x not in set(plain)]
        back = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(rest)}
        self.bytes_a = [b""] * size_a
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i)
                        else p.replace("▁", " ").encode() for i, p in enumerate(map(self.b.id_to_piece, range(size_b)))]
        self.len_a, self.len_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b))
        self.parts = [f"{i}{end}".encode() for i in range(size_a) for end in ",|"] + [f"{i}{end}".encode() for i in range(size_b) for end in ",;"]
        self.first_b = 2 * size_a
        self.apart, self.ranked = self._words_apart(), self._by_rank(path_a)
        self.forget()

    def _words_apart(self) -> bool:
        """Whether no token has a space after a character that is none, so that none spans two words."""
        return not any(re.search(r"\S ", x.decode("utf-8", "replace")) for x in (*self.bytes_a, *self.bytes_b))

    def _by_rank(self, path: str):
        """A faster library for plain words of the same file, where the order of its merges is that of its ids."""
        import tiktoken

        spec = json.load(open(path, encoding="utf-8"))
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"]]
        vocab, added = spec["model"]["vocab"], {x["content"] for x in spec["added_tokens"]}
        made, pre = [vocab[m] for m in merges], spec["pre_tokenizer"] or {}
        if (spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)
                or made != sorted(set(made)) or len(vocab.keys() - added) != len(made) + 256):
            return None
        words = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        return tiktoken.Encoding("ranked", pat_str=words, special_tokens={}, mergeable_ranks={self.bytes_a[i]: i for t, i in vocab.items() if t not in added})

    def tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids by both; none for a text that its tokens do not give back."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        for i, t in enumerate(texts):
            whole = (" " + t).encode()
            if not t or b"".join(map(self.bytes_a.__getitem__, a[i])) != whole or b"".join(map(self.bytes_b.__getitem__, b[i])) != whole:
                a[i], b[i] = [], []
        return a, b

    def links(self, texts: list[str]) -> list[tuple | None]:
        """(n_a, n_b, n_groups, the groups as text, the pair of every link in order) of each text; None for one without tokens."""
        lists_a, lists_b = self.tokens(texts)
        live = [t for t, x in enumerate(lists_a) if x]
        rows: list = [None] * len(texts)
        if live:
            ends = np.cumsum([len(texts[t].encode()) + 1 for t in live])
            a, b = (np.array(list(chain.from_iterable(x[t] for t in live)), dtype=np.int64) for x in (lists_a, lists_b))
            counts, said, pairs = self.cut(a, b, ends)
            for t, x, y, g, n, upto, text in zip(live, *counts.tolist(), np.cumsum(counts[3]).tolist(), said):
                rows[t] = (x, y, g, text, pairs[upto - n:upto])
        return rows

    def cut(self, a: np.ndarray, b: np.ndarray, text_ends: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """Tokens of texts that end at these bytes, laid end to end: n_a, n_b, n_groups and n_links, the groups as text, all pairs."""
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        ends = np.union1d(end_a, end_b)
        i, j = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        common = np.flatnonzero((end_a[i] == ends) & (end_b[j] == ends))
        link_upto, group_upto = np.searchsorted(ends, text_ends) + 1, np.searchsorted(ends[common], text_ends) + 1
        counts = np.array([np.diff(x, prepend=0) for x in (i[link_upto - 1] + 1, j[link_upto - 1] + 1, group_upto, link_upto)])

        # the groups as text: the A ids of a group, then its B ids
        group_a, group_b = np.searchsorted(ends[common], end_a), np.searchsorted(ends[common], end_b)
        last_a, last_b = i[common], j[common]
        out = np.empty(len(a) + len(b), dtype=np.int64)
        before_b = np.concatenate([[0], last_b[:-1] + 1])
        out[np.arange(len(a)) + before_b[group_a]] = 2 * a + (np.arange(len(a)) == last_a[group_a])
        out[np.arange(len(b)) + last_a[group_b] + 1] = self.first_b + 2 * b + (np.arange(len(b)) == last_b[group_b])
        parts = list(map(self.parts.__getitem__, out.tolist()))
        upto = np.cumsum(counts[0] + counts[1]).tolist()
        return counts, [b"".join(parts[x:y])[:-1] for x, y in zip([0, *upto], upto)], ((b[j] << 16) | a[i]).astype("<u4")

    def _together(self, words: list[str]) -> tuple | None:
        """``cut`` of words that go to the tokenizers as one text; None where that does not give them back."""
        text = " ".join(words)
        a = self.ranked.encode_ordinary(" " + text) if self.ranked else self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b, whole = self.b.encode(text), (" " + text).encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != whole or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
            return None
        a, b, ends = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64), np.cumsum([len(w.encode()) + 1 for w in words])
        if not np.isin(ends, np.cumsum(self.len_a[a])).all() or not np.isin(ends, np.cumsum(self.len_b[b])).all():
            return None
        return self.cut(a, b, ends)

    def learn(self, words: list[str]) -> None:
        """Keep the words' counts, groups and pairs."""
        plain = [w for w in words if _PLAIN.fullmatch(w)]
        odd = [w for w in words if not _PLAIN.fullmatch(w)] if len(plain) < len(words) else []
        groups = [(x[at:at + 4096], x is plain) for x in (plain, odd) for at in range(0, len(x), 4096)]
        counts, pairs = [self.counts], [self.pairs]
        for group, together in groups:
            found = self._together(group) if together else None
            if found is None:
                rows = [r or (0, 0, 0, None, _NONE) for r in self.links(group)]
                found = (np.array([(r[0], r[1], r[2], len(r[4])) for r in rows], dtype=np.int64).T, [r[3] for r in rows], np.concatenate([r[4] for r in rows]))
            self.place.update(zip(group, range(len(self.said), len(self.said) + len(group))))
            self.said += found[1]
            counts.append(found[0])
            pairs.append(found[2])
        self.counts, self.pairs = np.concatenate(counts, axis=1), np.concatenate(pairs)
        self.upto = np.cumsum(self.counts[3])

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.said: list[bytes | None] = []
        self.counts, self.pairs, self.upto = np.zeros((4, 0), dtype=np.int64), _NONE, np.zeros(0, dtype=np.int64)

    def align(self, texts: list[str]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups_sha256, pairs, more) of every text.

        pairs: its distinct pairs, ascending, as unsigned 32-bit integers; more: the places
        and numbers of those that occur more than once.
        """
        if len(self.said) > KEPT:
            self.forget()
        of, split, whole = [], [], []
        for t, text in enumerate(texts):
            if text and self.apart and not _RUNS.search(text) and not text[0].isspace() and not text[-1].isspace():
                of.append(t)
                split.append(text.split(" "))
            else:
                whole.append(t)
        rows: list[tuple] = [(0, 0, 0, 0, "", b"", b"")] * len(texts)
        self._finish(rows, of, *self._from_words(split))
        found = [(t, r) for t, r in zip(whole, self.links([texts[t] for t in whole])) if r is not None]
        for at in range(0, len(found), 64):
            part = found[at:at + 64]
            self._finish(rows, [t for t, _ in part], np.array([r[:3] for _, r in part]).T, [r[3] for _, r in part],
                         np.array([len(r[4]) for _, r in part]), np.concatenate([r[4] for _, r in part]))
        return rows

    def _from_words(self, split: list[list[str]]) -> tuple[np.ndarray, list[bytes | None], np.ndarray, np.ndarray]:
        """Of texts in words: n_a, n_b and n_groups, the groups as text (None: no tokens), the number of links, all pairs."""
        words = list(chain.from_iterable(split))
        at = list(map(self.place.get, words))
        if None in at:
            self.learn(list({w for w, i in zip(words, at) if i is None}))
            at = list(map(self.place.__getitem__, words))
        said = list(map(self.said.__getitem__, at))
        ids, sizes = np.array(at, dtype=np.int64), np.array([len(x) for x in split], dtype=np.int64)
        upto = np.cumsum(sizes).tolist()
        groups = [b";".join(x) if None not in (x := said[a:b]) else None for a, b in zip([0, *upto], upto)]
        sums = [np.diff(np.concatenate([[0], np.cumsum(c[ids])])[[0, *upto]]) for c in self.counts]
        n = self.counts[3][ids]
        first = self.upto[ids] - n
        place = np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        return np.array(sums[:3]), groups, sums[3], self.pairs[place]

    def _finish(self, rows: list[tuple], of: list[int], sums: np.ndarray, groups: list[bytes | None], n_links: np.ndarray, links: np.ndarray) -> None:
        if not of:
            return
        keys = np.sort(links.astype(np.int64) | np.repeat(np.arange(len(of)) << 32, n_links))
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
        numbers, keys = np.diff(np.r_[first, len(keys)]), keys[first]
        upto = np.searchsorted(keys, np.arange(1, len(of) + 1) << 32).tolist()
        pairs, at = (keys & 0xFFFFFFFF).astype("<u4"), 0
        for k, (t, said, a, b, g, n) in enumerate(zip(of, groups, *sums.tolist(), n_links.tolist())):
            if said is not None:
                count = numbers[at:upto[k]]
                often = np.flatnonzero(count > 1)
                rows[t] = (a, b, g, n, hashlib.sha256(said).hexdigest(), pairs[at:upto[k]].tobytes(), np.concatenate([often, count[often]]).astype("<u4").tobytes())
            at = upto[k]


@functools.lru_cache(maxsize=2)
def pair(path_a: str, path_b: str) -> Pair:
    """The two tokenizers, once per Python process; bare names are public tokenizers."""
    return Pair(tokenizer_path(path_a), tokenizer_path(path_b))


def unpack(pairs: bytes, more: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A text's distinct pairs and how many links each has."""
    codes = np.frombuffer(pairs, dtype="<u4")
    numbers = np.ones(len(codes), dtype=np.int64)
    often = np.frombuffer(more, dtype="<u4").reshape(2, -1)
    numbers[often[0]] = often[1]
    return codes, numbers


def digest(text: str = "text"):
    """Which text a row has; none for null and empty texts."""
    return F.when(F.length(text) > 0, F.unhex(F.sha2(text, 256)))


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Every distinct text once: (digest, copies, measures, pairs, more), written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pair(path_a, path_b)
        for batch in batches:
            sizes = np.asarray(pa.compute.utf8_length(batch.column("text")))
            lo = 0
            while lo < batch.num_rows:
                n = max(1, int(np.searchsorted(np.cumsum(sizes[lo:lo + 256]), CHARS, side="right")))
                part = batch.slice(lo, n)
                lo += n
                found = list(zip(*p.align(part.column("text").to_pylist())))
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest"), part.column("copies"), *(pa.array(x, pa.int64()) for x in found[:4]),
                     pa.array(found[4], pa.string()), pa.array(found[5], pa.binary()), pa.array(found[6], pa.binary())],
                    names=["digest", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "more"])

    texts = docs.filter(F.length("text") > 0).groupBy("text").agg(F.count(F.lit(1)).alias("copies")).select("text", "copies", digest().alias("digest"))
    return written(texts.mapInArrow(run, f"digest binary, copies long, {MEASURES}, pairs binary, more binary"), "zstd")


def _merge(codes: list[np.ndarray], numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    all_codes, all_numbers = np.concatenate(codes), np.concatenate(numbers)
    order = np.argsort(all_codes, kind="stable")
    all_codes = all_codes[order]
    first = np.flatnonzero(np.r_[True, all_codes[1:] != all_codes[:-1]])
    return all_codes[first], np.add.reduceat(all_numbers[order], first)


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, n, best): links of each pair in the whole corpus; best: no pair of its B id has more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: list[np.ndarray] = []
        numbers: list[np.ndarray] = []
        held = kept = 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(codes[0].astype(np.int64)), pa.array(numbers[0])], names=["pair", "n"])

        for batch in batches:
            for copies, pairs, more in zip(*(batch.column(c).to_pylist() for c in ("copies", "pairs", "more"))):
                own, n = unpack(pairs, more)
                codes.append(own)
                numbers.append(n * copies)
                held += len(own)
                if held - kept >= HELD:
                    merged = _merge(codes, numbers)
                    codes, numbers, held = [merged[0]], [merged[1]], len(merged[0])
                    kept = held
                    if held >= HELD:
                        yield out()
                        codes, numbers, held, kept = [], [], 0, 0
        if held:
            merged = _merge(codes, numbers)
            codes, numbers = [merged[0]], [merged[1]]
            yield out()

    sums = (texts.filter("n_links > 0").select("copies", "pairs", "more").mapInArrow(run, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")))
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", 16)))  # as many rows as A has ids, at most
    return sums.withColumn("best", F.col("n") == most)


def write_ranges(counts: DataFrame) -> str:
    """The counts as Parquet files, each an ascending range of about ``RANGE`` pairs."""
    spark, folder = counts.sparkSession, shared_folder(counts.sparkSession)
    counts = written(counts)
    n = max(1, -(-counts.count() // RANGE))
    counts.repartitionByRange(n, "pair").sortWithinPartitions("pair").write.parquet(folder)
    return folder


def measured(texts: DataFrame, folder: str) -> DataFrame:
    """(digest, measures, n_best, count_sum) of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        ranges = sorted(f.path for f in fs.get_file_info(pa.fs.FileSelector(path)) if f.path.endswith(".parquet"))

        def take(rows: pa.Table) -> pa.RecordBatch:
            own = [unpack(p, m) for p, m in zip(rows.column("pairs").to_pylist(), rows.column("more").to_pylist())]
            codes, numbers = (np.concatenate(x) for x in zip(*own))
            order = np.argsort(codes, kind="stable")
            ascending = codes[order].astype(np.int64)
            count, best = np.zeros(len(codes), dtype=np.int64), np.zeros(len(codes), dtype=bool)
            for name in ranges:
                with fs.open_input_file(name) as f:
                    c = pq.read_table(f)
                if c.num_rows:
                    known = c.column("pair").to_numpy()
                    s = slice(*np.searchsorted(ascending, [known[0], known[-1] + 1]))
                    at = np.searchsorted(known, ascending[s])
                    count[order[s]], best[order[s]] = c.column("n").to_numpy()[at], c.column("best").to_numpy()[at]
            upto = np.concatenate([[0], np.cumsum([len(x) for x, _ in own])])
            links, all_best = np.concatenate([[0], np.cumsum(numbers * count)]), np.concatenate([[0], np.cumsum(numbers * best)])
            out = rows.drop_columns(["pairs", "more"]).append_column("n_best", pa.array(np.diff(all_best[upto]))).append_column("count_sum", pa.array(np.diff(links[upto])))
            return out.combine_chunks().to_batches()[0]

        rows, held = [], 0
        for batch in batches:
            sizes = np.asarray(pa.compute.binary_length(batch.column("pairs"))) // 4
            lo = 0
            while lo < batch.num_rows:
                n = max(1, int(np.searchsorted(np.cumsum(sizes[lo:]), HELD - held, side="right")))
                rows.append(batch.slice(lo, n))
                held += int(sizes[lo:lo + n].sum())
                lo += n
                if held >= HELD or lo < batch.num_rows:
                    yield take(pa.Table.from_batches(rows))
                    rows, held = [], 0
        if rows:
            yield take(pa.Table.from_batches(rows))

    columns = ["digest", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "more"]
    return texts.select(*columns).mapInArrow(run, f"digest binary, {MEASURES}, n_best long, count_sum long")


def align(docs: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """How tokenizer A (byte-level BPE) and B (sentencepiece) cut each document, in the light of all links.

    (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256); n_best: links whose
    pair is the commonest of its B id; count_sum: corpus-wide counts summed over the links.
    """
    texts = aligned(docs, tokenizer_a, tokenizer_b)
    found = measured(texts, write_ranges(pair_counts(texts)))
    rows = docs.select(F.col("doc_id").cast("long"), digest().alias("digest")).join(found, "digest", "left")
    zeros = [F.coalesce(c, F.lit("" if c == "groups_sha256" else 0)).alias(c) for c in COLUMNS[1:]]
    return rows.select("doc_id", *zeros)
