"""Ids of a BPE with word ends, computed once per distinct word.

The tokenizer composes, squeezes white space, lower-cases and splits before it
merges, so a text's ids are its words' ids. What the file says is checked on
loading; a tokenizer of another make encodes whole texts.
"""

from __future__ import annotations

import itertools
import json
import os
import re

import numpy as np
import regex

CACHE = 400_000      # words remembered by a worker
JOINED = 2000        # new words encoded as one text

# The normaliser and the split pattern this shortcut is made for.
NORMALISERS = ["NFC", "Replace", "Lowercase"]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

SPLIT_ANY = regex.compile(PATTERN)
_LATIN = r"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{digit}]|[^{blank}{letter}{digit}]+"
SPLIT_LATIN = re.compile(_LATIN.format(letter=r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff",
                                       digit=r"0-9\xb2\xb3\xb9\xbc-\xbe", blank=r"\t-\r \x85\xa0"))
SPLIT_ASCII = re.compile(_LATIN.format(letter="A-Za-z", digit="0-9", blank=r"\t-\r "))

_loaded: dict[str, "WordIds"] = {}


class _Codes(dict):
    """Word -> running number; words asked for the first time are listed."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        self.new.append(word)
        return code


def _flat(encodings: list) -> np.ndarray:
    return np.fromiter(itertools.chain.from_iterable(e.ids for e in encodings), dtype=np.uint32)


class WordIds:
    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        path = tokenizer
        if not os.path.exists(path):
            import public_tokenizers
            path = public_tokenizers.path(tokenizer)
        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.by_word = self._words_stand_alone(path)
        vocab = self.tok.get_vocab()
        self.width = 2 if max(vocab.values()) < 1 << 16 else 4
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)   # ids that end a word
        if self.by_word:
            self.ends[[i for t, i in vocab.items() if t.endswith(self.mark)]] = True
        self._forget()

    def _words_stand_alone(self, path: str) -> bool:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.mark = spec["model"].get("end_of_word_suffix") or ""
        normal = (spec.get("normalizer") or {}).get("normalizers", [])
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        return (spec["model"].get("type") == "BPE" and bool(self.mark)
                and [n["type"] for n in normal] == NORMALISERS and normal[1]["pattern"] == {"Regex": r"\s+"}
                and split[0].get("pattern") == {"Regex": PATTERN}
                and split[0].get("behavior") == "Removed" and split[0].get("invert") is True
                and [s["type"] for s in split[1:]] == ["ByteLevel"] and not split[1]["use_regex"]
                and not split[1]["add_prefix_space"])

    def _forget(self) -> None:
        self.codes = _Codes()
        self.table = np.zeros(0, dtype=np.uint32)
        self.first = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)

    def _learn(self) -> None:
        """Ids of the new words. Words of letters are encoded many at a time with
        blanks between them; an id with the end mark ends a word."""
        new, self.codes.new = self.codes.new, []
        if not new:
            return
        plain = [i for i, w in enumerate(new) if w.isalpha()]
        is_plain = np.zeros(len(new), dtype=bool)
        is_plain[plain] = True
        rest = np.flatnonzero(~is_plain).tolist()
        texts = [" ".join([new[i] for i in plain[k:k + JOINED]]) for k in range(0, len(plain), JOINED)]
        flat = _flat(self.tok.encode_batch_fast(texts, add_special_tokens=False))
        tails = np.flatnonzero(self.ends[flat]) + 1
        if len(tails) != len(plain):
            raise ValueError("a word of letters did not end in one end mark")
        size = np.zeros(len(new), dtype=np.int64)
        first = np.empty(len(new), dtype=np.int64)
        size[is_plain] = np.diff(tails, prepend=0)
        first[is_plain] = tails - size[is_plain]
        single = self.tok.encode_batch_fast([new[i] for i in rest], add_special_tokens=False)
        size[rest] = [len(e) for e in single]
        first[rest] = len(flat) + np.cumsum(size[rest]) - size[rest]
        self.first = np.concatenate([self.first, len(self.table) + first])
        self.size = np.concatenate([self.size, size])
        self.table = np.concatenate([self.table, flat, _flat(single)])

    def words(self, t: str) -> list[str]:
        if t.isascii():
            return SPLIT_ASCII.findall(t.lower())
        try:
            t.encode("latin-1")
        except UnicodeEncodeError:
            return SPLIT_ANY.findall(self.tok.normalizer.normalize_str(t))
        return SPLIT_LATIN.findall(t.lower())

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and their number per text."""
        if not self.by_word:
            got = self.tok.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
            return _flat(got), np.array([len(e) for e in got], dtype=np.int64)
        if len(self.codes) > CACHE:
            self._forget()
        words: list[str] = []
        count = np.zeros(len(texts), dtype=np.int64)
        whole: dict[int, np.ndarray] = {}
        for i, t in enumerate(texts):
            if not t:
                continue
            if any(s in t for s in self.special):
                whole[i] = np.array(self.tok.encode(t, add_special_tokens=False).ids, dtype=np.uint32)
                continue
            w = self.words(t)
            words += w
            count[i] = len(w)
        code = np.fromiter(map(self.codes.__getitem__, words), dtype=np.int64, count=len(words))
        self._learn()
        length = self.size[code]
        at = np.cumsum(length) - length
        ids = self.table[np.arange(int(length.sum())) + np.repeat(self.first[code] - at, length)]
        doc = np.repeat(np.arange(len(texts)), count)
        n = np.bincount(doc, weights=length, minlength=len(texts)).astype(np.int64)
        if whole:
            cut = np.cumsum(n)
            per = [whole.get(i, ids[cut[i] - n[i]:cut[i]]) for i in range(len(texts))]
            ids, n = np.concatenate(per), np.array([len(p) for p in per], dtype=np.int64)
        return ids, n


def encoder(tokenizer: str) -> WordIds:
    if tokenizer not in _loaded:
        _loaded[tokenizer] = WordIds(tokenizer)
    return _loaded[tokenizer]
