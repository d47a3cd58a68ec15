"""Packing of tokenised documents into sequences by hierarchical best fit.

Partitions pack their pieces by best fit (largest first) and emit the bins that
are nearly full. Bins that are not become items themselves: a tree merges the
underfull bins of several partitions and packs them again, round by round, until
one node is left.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import zlib

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import map_pandas, regroup, written

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k.json"   # a file, or a name that public_tokenizers knows
SEPARATOR = 0                     # id that ends a document
FULL = 8                          # a bin with no more free places is emitted at once
ITEMS = 10_000                    # items (pieces, then underfull bins) of a node
LITTLE = 0.002                    # a round that merges a smaller share of its bins has found what it can
CACHE = 400_000                   # words remembered by a worker
JOINED = 2000                     # new words encoded as one text
BLANK_BYTE = "\u0120"             # how a byte-level vocabulary writes a blank

# White space and the split before the merges, as the byte-level tokenizer defines
# them. The commonest alternative (letters) comes first; it shares no first
# character with the contractions, so the order of the two is free. Texts of
# plain ASCII or of Latin-1 characters take a pattern with the classes spelled out.
_SPLIT = r" ?[{letter}]+|'(?:[stmd]|re|ve|ll)| ?[{digit}]+| ?[^{blank}{letter}{digit}]+|[{blank}]+(?![^{blank}])|[{blank}]+"
_BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT_ANY = regex.compile(_SPLIT.format(letter=r"\p{L}", digit=r"\p{N}", blank=_BLANK))
SPLIT_LATIN = re.compile(_SPLIT.format(letter=r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff",
                                       digit=r"0-9\xb2\xb3\xb9\xbc-\xbe", blank=r"\t-\r \x85\xa0"))
SPLIT_ASCII = re.compile(_SPLIT.format(letter="A-Za-z", digit="0-9", blank=r"\t-\r "))

_loaded: dict[str, "WordEncoder"] = {}


def _flat(encodings: list) -> np.ndarray:
    return np.fromiter(itertools.chain.from_iterable(e.ids for e in encodings), dtype=np.uint32)


class _Codes(dict):
    """Word -> running number; words asked for the first time are listed."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        self.new.append(word)
        return code


class WordEncoder:
    """The tokenizer's ids, computed once per distinct word.

    A byte-level BPE merges within the words its pattern splits off, so a text's
    ids are its words' ids. Texts that name a special token go through the
    tokenizer whole. The ids of all known words lie in one table."""

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        path = tokenizer
        if not os.path.exists(path):
            import public_tokenizers
            path = public_tokenizers.path(tokenizer)
        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        # What the shortcut assumes of the file; any other tokenizer encodes whole texts.
        self.by_word = (spec["model"].get("type") == "BPE" and not spec.get("normalizer") and split.get("type") == "ByteLevel"
                        and split.get("use_regex", True) and not split.get("add_prefix_space")
                        and not spec["model"].get("end_of_word_suffix") and not spec["model"].get("continuing_subword_prefix"))
        vocab = self.tok.get_vocab()
        self.opens = np.zeros(max(vocab.values()) + 1, dtype=bool)  # ids that begin with a blank
        self.opens[[i for t, i in vocab.items() if t.startswith(BLANK_BYTE)]] = True
        self._forget()

    def _forget(self) -> None:
        self.codes = _Codes()
        self.table = np.zeros(0, dtype=np.uint32)
        self.first = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)

    def _learn(self) -> None:
        """Ids of the new words. Words of a blank and letters are encoded many at a
        time, one after the other: the pattern splits exactly these words off
        again, and an id that begins with a blank begins the next word."""
        new, self.codes.new = self.codes.new, []
        if not new:
            return
        plain = [i for i, w in enumerate(new) if w[0] == " " and w[1:].isalpha()]
        is_plain = np.zeros(len(new), dtype=bool)
        is_plain[plain] = True
        rest = np.flatnonzero(~is_plain).tolist()
        texts = ["".join([new[i] for i in plain[k:k + JOINED]]) for k in range(0, len(plain), JOINED)]
        size = np.zeros(len(new), dtype=np.int64)
        flat = _flat(self.tok.encode_batch_fast(texts, add_special_tokens=False))
        heads = np.flatnonzero(self.opens[flat])
        size[is_plain] = np.diff(np.append(heads, len(flat)))
        single = self.tok.encode_batch_fast([new[i] for i in rest], add_special_tokens=False)
        size[rest] = [len(e) for e in single]
        first = np.empty(len(new), dtype=np.int64)
        first[is_plain] = heads
        first[rest] = len(flat) + np.cumsum(size[rest]) - size[rest]
        self.first = np.concatenate([self.first, len(self.table) + first])
        self.size = np.concatenate([self.size, size])
        self.table = np.concatenate([self.table, flat, _flat(single)])

    def words(self, t: str) -> list[str]:
        if t.isascii():
            return SPLIT_ASCII.findall(t)
        try:
            t.encode("latin-1")
        except UnicodeEncodeError:
            return SPLIT_ANY.findall(t)
        return SPLIT_LATIN.findall(t)

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


def encoder(tokenizer: str) -> WordEncoder:
    if tokenizer not in _loaded:
        _loaded[tokenizer] = WordEncoder(tokenizer)
    return _loaded[tokenizer]


def _pieces(tokenizer: str, capacity: int):
    def run(batches):
        enc = encoder(tokenizer)
        for pdf in regroup(batches, "text"):
            ids, n = enc.encode(pdf["text"].tolist())
            doc, piece, start, length, crc = [], [], [], [], []
            at = 0
            for d, m in zip(pdf["doc"].tolist(), n.tolist()):
                own = np.append(ids[at:at + m], SEPARATOR).astype("<u4")
                at += m
                first = (m % capacity) + 1  # the rest is whole sequences
                lo, k = 0, 0
                while lo <= m:
                    hi = first if k == 0 else lo + capacity
                    doc.append(d)
                    piece.append(k)
                    start.append(lo)
                    length.append(hi - lo)
                    crc.append(zlib.crc32(own[lo:hi].tobytes()))
                    lo, k = hi, k + 1
            out = pd.DataFrame({"piece": piece, "start": start, "length": length, "ids_crc32": crc})
            out.insert(0, "doc", pd.array(doc, dtype="Int64"))
            yield out
    return run


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit of items in the given order: bin and offset of each, fill of each bin.

    Open bins are kept by free space; one set bit per space in use finds the
    tightest fit without a search."""
    where = np.empty(len(sizes), dtype=np.int64)
    offset = np.empty(len(sizes), dtype=np.int64)
    fill: list[int] = []
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    for i, s in enumerate(sizes.tolist()):
        fit = used >> s
        if fit:
            space = s + (fit & -fit).bit_length() - 1
            b = by_space[space].pop()
            if not by_space[space]:
                used ^= 1 << space
        else:
            b, space = len(fill), capacity
            fill.append(0)
        where[i], offset[i] = b, fill[b]
        fill[b] += s
        space -= s
        if space:
            by_space[space].append(b)
            used |= 1 << space
    return where, offset, np.array(fill, dtype=np.int64)


ROUND = "item long, bin long, offset long, fill long, done boolean"


def _pack_node(level: int, last: bool, capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        node = int(pdf["node"].iloc[0])
        pdf = pdf.sort_values(["size", "item"], ascending=[False, True], kind="stable")
        where, offset, fill = best_fit(pdf["size"].to_numpy(), capacity)
        done = (capacity - fill <= FULL) | last
        base = (level << 58) + (node << 26)
        return pd.DataFrame({"item": pdf["item"].to_numpy(), "bin": base + where, "offset": offset,
                             "fill": fill[where], "done": done[where]})
    return run


def mergeable(sizes: dict[int, int], capacity: int, before: int) -> tuple[int, int]:
    """Which underfull bins can still be merged: ``(largest fill, how many)``, from the
    number of bins of each fill.

    A bin fuller than what the emptiest one needs can take nothing. Two bins of at
    most half the capacity always merge, so once a round leaves nearly as many bins
    as it got (``before``), few such halves are left, and each needs one host: the
    halves and as many of the emptiest others decide all that is left."""
    total = sum(sizes.values())
    if total < 2:
        return 0, 0
    most = capacity - min(sizes)
    if before and before - total < LITTLE * before:
        halves = sum(n for s, n in sizes.items() if 2 * s <= capacity)
        seen = 0
        for s in sorted(sizes):
            seen += sizes[s]
            if seen >= 2 * halves:
                most = min(most, s)
                break
    kept = sum(n for s, n in sizes.items() if s <= most)
    return (most, kept) if kept > 1 else (0, 0)


def token_pieces(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
                 capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document: ``item, doc, piece, start, length, ids_crc32``,
    written to the shared folder (the item numbers are fixed by that)."""
    src = df.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    rows = map_pandas(src, _pieces(tokenizer, capacity),
                      "doc long, piece int, start long, length long, ids_crc32 long")
    return written(rows.withColumn("item", F.monotonically_increasing_id()), "pack-pieces")


def pack_items(items: DataFrame, capacity: int = CAPACITY, per_node: int = ITEMS) -> DataFrame:
    """``(item, sequence_id, offset)`` for ``items(item, size)`` with sizes 1..capacity.

    A round deals what is left by hash to nodes of about ``per_node`` items, packs
    each by best fit and hands every bin on that another one could still fill or be
    filled by (``mergeable``; the fills are counted, at most ``capacity`` numbers).
    As bins are fewer than what they hold, the nodes become fewer; the last round
    has one. Rounds of several nodes go on while they merge bins."""
    whole = items.where(F.col("size") == capacity)
    rest = items.where(F.col("size") < capacity).select("item", "size")
    placed, level, left, todo, idle = None, 1, rest.count(), rest, 0
    while left and idle < 2:        # (two rounds that merge nothing end it, too)
        nodes = -(-left // per_node)
        dealt = todo.withColumn("node", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(nodes)))
        now = written(dealt.groupBy("node").applyInPandas(_pack_node(level, nodes == 1, capacity), ROUND), f"pack-round{level}")
        if placed is None:
            placed = now.select("item", F.col("bin").alias("sequence_id"), "offset")
        else:
            step = now.select(F.col("item").alias("sequence_id"), F.col("bin").alias("to"), F.col("offset").alias("by"))
            placed = placed.join(step, "sequence_id", "left").select(
                "item", F.coalesce("to", "sequence_id").alias("sequence_id"),
                (F.col("offset") + F.coalesce("by", F.lit(0))).alias("offset"))
        if nodes == 1:
            break
        bins = now.where(~F.col("done") & (F.col("offset") == 0)).select(F.col("bin").alias("item"), F.col("fill").alias("size"))
        sizes = {r["size"]: r["n"] for r in bins.groupBy("size").agg(F.count("*").alias("n")).collect()}
        idle = idle + 1 if sum(sizes.values()) >= left else 0
        most, left = mergeable(sizes, capacity, left)
        todo, level = bins.where(F.col("size") <= most), level + 1
    full = whole.select("item", F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full if placed is None else placed.unionByName(full)


def pack_documents(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
                   capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``key, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its tokenizer ids (no special tokens added) and then id 0. A
    document longer than ``capacity`` is cut; its first piece takes what whole
    sequences leave over. Pieces of a sequence lie without gaps from 0.

    Nodes hold about ``ITEMS`` items each, dealt by hash, whatever the input. Order
    within a node is by size and item number, so a task that runs again packs
    alike.

    Null or empty text is the single id 0; repeated rows are packed each; a null
    key is kept; an empty table gives no rows; other columns are ignored.
    """
    pieces = token_pieces(df, key, text, tokenizer, capacity)
    placed = pack_items(pieces.select("item", F.col("length").alias("size")), capacity)
    return pieces.join(placed, "item").select(
        F.col("doc").alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
