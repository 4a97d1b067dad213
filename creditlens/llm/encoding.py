"""Token ids of whole texts, by the tokenizers library.

A tokenizer file whose normalizer drops white space and whose words end in a marked token
never merges across white space, so its ids of a text are the ids of its space-separated
pieces in turn.  ``WordEncoder`` keeps the ids of pieces that it has met and gives the
library only the new ones.  Other tokenizer files go to the library text by text.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import regex

# Characters that the word path handles by itself: no combining marks, no letters whose
# lower case depends on their place, no special white space.  All else goes to the library whole.
_PLAIN_TEXT = regex.compile("[\t\n\r -~¡-¬®-įı-ſ]*")
_STOP = re.compile("(?<=[a-z])([.,])(?=[ \n])")
_PLAIN_LINES = regex.compile("[\n!-~¡-¬®-įı-ſ]+")
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+|\n")


class LibraryEncoder:
    """Ids of whole texts as little-endian unsigned integers, by the library alone."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")

    def library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in found]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        return self.library(texts)


class WordEncoder(LibraryEncoder):
    """The same ids, with the ids of known pieces kept: two generations of ``keep`` at most."""

    def __init__(self, path: str, keep: int = 200_000):
        from tokenizers import Tokenizer

        super().__init__(path)
        spec = json.load(open(path, encoding="utf-8"))
        split = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, spec["pre_tokenizer"]["pretokenizers"][-1]]}
        self.words = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": split, "added_tokens": []}))
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends[[i for w, i in spec["model"]["vocab"].items() if w.endswith(spec["model"]["end_of_word_suffix"])]] = True
        self.specials = regex.compile("|".join(regex.escape(x["content"]) for x in spec["added_tokens"]) or "(?!)")
        self.keep = keep
        self.pieces: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        self.old_parts: dict[str, bytes] = {}

    def _part_ids(self, unmet: list[str]) -> None:
        for i in range(0, len(unmet), 2048):
            group = unmet[i:i + 2048]
            ids = np.array(self.words.encode_batch_fast([" ".join(group)], add_special_tokens=False)[0].ids, dtype=self.dtype)
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize).tolist()
            if len(cuts) != len(group):  # not a file of this kind after all: the library decides
                self.parts.update(zip(group, self.library(group)))
                continue
            raw = ids.tobytes()
            self.parts.update((part, raw[a:b]) for part, a, b in zip(group, [0, *cuts], cuts))

    def _learn(self, new: list[str]) -> None:
        plain = "\n".join(new)
        if not _PLAIN_LINES.fullmatch(plain) or self.specials.search(plain):
            odd = [w for w in new if not _PLAIN_LINES.fullmatch(w) or self.specials.search(w)]
            for i in range(0, len(odd), 512):
                self.pieces.update(zip(odd[i:i + 512], self.library(odd[i:i + 512])))
            left = set(odd)
            new = [w for w in new if w not in left]
            plain = "\n".join(new)
        if not new:
            return
        parts = _PARTS.findall(plain.lower())
        unmet = [p for p in set(parts) if p not in self.parts and p != "\n"]
        self.parts.update((p, self.old_parts[p]) for p in unmet if p in self.old_parts)
        self._part_ids([p for p in unmet if p not in self.parts])
        words, known, at = iter(new), self.parts, []
        for p in parts:
            if p == "\n":
                self.pieces[next(words)] = b"".join(at)
                at = []
            else:
                at.append(known[p])
        self.pieces[next(words)] = b"".join(at)

    def _split(self, text: str) -> list[str]:
        """Pieces between white space; in plain texts also lower-cased, with a full stop or comma apart."""
        if _PLAIN_TEXT.fullmatch(text):
            text = _STOP.sub(r" \1", text.lower())
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")

    def encode_many(self, texts: list[str]) -> list[bytes]:
        if len(self.pieces) > self.keep:
            self.old_pieces, self.pieces = self.pieces, {"": b""}
        if len(self.parts) > self.keep:
            self.old_parts, self.parts = self.parts, {}
        words = [self._split(t) for t in texts]
        found = [list(map(self.pieces.get, w)) for w in words]
        gaps = [[i for i, v in enumerate(f) if v is None] if None in f else () for f in found]
        unmet = {w[i] for w, g in zip(words, gaps) for i in g}
        if unmet:
            self.pieces.update((w, self.old_pieces[w]) for w in unmet if w in self.old_pieces)
            if new := [w for w in unmet if w not in self.pieces]:
                self._learn(new)
            for w, f, g in zip(words, found, gaps):
                for i in g:
                    f[i] = self.pieces[w[i]]
        return [b"".join(f) for f in found]


def _is_word_file(spec: dict) -> bool:
    steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    pre = [x.get("type") for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    return (steps == ["NFC", "Replace", "Lowercase"] and pre == ["Split", "ByteLevel"]
            and spec["pre_tokenizer"]["pretokenizers"][0].get("pattern") == {"Regex": pattern}
            and bool(spec["model"].get("end_of_word_suffix")) and not spec["model"].get("dropout"))


def tokenizer_path(name_or_path: str) -> str:
    """Where a tokenizer file lies; a bare name is a public tokenizer."""
    if "/" in name_or_path:
        return name_or_path
    import public_tokenizers

    return str(public_tokenizers.path(name_or_path))


@functools.lru_cache(maxsize=4)
def encoder(name_or_path: str, keep: int = 200_000) -> LibraryEncoder:
    """The encoder of a tokenizer file, one per Python process and ``keep``; a bare name is a public tokenizer."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    path = tokenizer_path(name_or_path)
    spec = json.load(open(path, encoding="utf-8"))
    return WordEncoder(path, keep) if _is_word_file(spec) else LibraryEncoder(path)
