"""Near-equal token windows by Karmarkar-Karp multiway differencing.

Every task packs the documents of its partition in groups. In a group the items
start as partial partitions of one item; the two with the largest spread are
merged again and again, heavy windows of one with light windows of the other,
until one partition into k windows is left. If a window exceeds the capacity, k
rises and the group is differenced anew. What little room is left is closed by
cutting the emptiest windows up.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quarry.llm.common import regroup_arrow, text_batches
from quarry.llm.word_ids import encoder

CAPACITY = 4096
TOKENIZER = "word_bpe_49k.json"   # a file, or a name that public_tokenizers knows
SEPARATOR = 2                     # id that ends a document
ITEMS = 4096                      # documents of a group
TOKENS = 4_000_000                # a group of long documents is complete earlier
FIELDS = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class _Differencing:
    """Partial partitions are arrays of window sums, falling, with the node that
    holds each window's items; windows that hold nothing are left out."""

    def __init__(self, sizes: np.ndarray, k: int):
        self.k, self.n = k, len(sizes)
        self.left: list[np.ndarray] = []
        self.right: list[np.ndarray] = []
        self.nodes = self.n
        order = np.argsort(-sizes, kind="stable")
        self.heap = [(-int(sizes[i]), t, sizes[i:i + 1].astype(np.int64), np.array([i])) for t, i in enumerate(order.tolist())]
        self.made = self.n        # sorted by falling size: a heap already

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """New nodes, each of two windows that become one."""
        self.left.append(a)
        self.right.append(b)
        self.nodes += len(a)
        return np.arange(self.nodes - len(a), self.nodes)

    def merge(self, a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
        (sa, na), (sb, nb) = a, b
        both = len(sa) + len(sb) - self.k
        if both <= 0:             # enough empty windows: nothing meets
            s, node = np.concatenate([sa, sb]), np.concatenate([na, nb])
        else:                     # the heaviest of one meet the lightest of the other
            x, y = len(sa) - both, len(sb) - both
            s = np.concatenate([sa[:x], sa[x:] + sb[y:][::-1], sb[:y]])
            node = np.concatenate([na[:x], self.join(na[x:], nb[y:][::-1]), nb[:y]])
        order = np.argsort(-s, kind="stable")
        return s[order], node[order]

    def push(self, s: np.ndarray, node: np.ndarray) -> None:
        spread = int(s[0]) - (int(s[-1]) if len(s) == self.k else 0)
        heapq.heappush(self.heap, (-spread, self.made, s, node))
        self.made += 1

    def run(self) -> np.ndarray:
        """Window of each item."""
        heap = self.heap
        while len(heap) > 1:
            _, _, s, node = heapq.heappop(heap)
            room = self.k - len(s)
            if room and len(heap[0][2]) == 1:
                # A partition with an empty window has the largest spread until it
                # has none, so it takes one item after the other.
                more = []
                while heap and room > len(more) and len(heap[0][2]) == 1:
                    more.append(heapq.heappop(heap))
                s = np.concatenate([s, *[m[2] for m in more]])
                node = np.concatenate([node, *[m[3] for m in more]])
                order = np.argsort(-s, kind="stable")
                self.push(s[order], node[order])
                continue
            _, _, t, other = heapq.heappop(heap)
            self.push(*self.merge((s, node), (t, other)))
        where = np.zeros(self.nodes, dtype=np.int64)
        if heap:
            where[heap[0][3]] = np.arange(len(heap[0][3]))
        end = self.nodes
        for a, b in zip(reversed(self.left), reversed(self.right)):
            own = where[end - len(a):end]
            where[a], where[b] = own, own
            end -= len(a)
        return where[:self.n]


def karmarkar_karp(sizes: np.ndarray, k: int) -> np.ndarray:
    """Window 0..k-1 of each item, with near-equal sums."""
    return _Differencing(np.asarray(sizes, dtype=np.int64), k).run()


def near_equal_windows(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Windows of items of at most ``capacity``, and their number: the least that
    could hold all, raised while a window exceeds the capacity. One window an item
    always fits, so this ends."""
    total, n = int(sizes.sum()), len(sizes)
    k, tries = max(1, -(-total // capacity)), 0
    while True:
        where = karmarkar_karp(sizes, k)
        most = int(np.bincount(where, weights=sizes, minlength=k).max()) if n else 0
        if most <= capacity:
            return where, k
        # The heaviest window lay so much above the mean: leave that room. Where items
        # are too coarse for that (all just over half a window), rise ever faster.
        mean = capacity - (most - total / k)
        k, tries = min(n, max(k + (1 << tries), int(-(-total // mean)) if mean > 0 else 0)), tries + 1


def close_windows(sizes: np.ndarray, where: np.ndarray, k: int, capacity: int) -> tuple[np.ndarray, ...]:
    """Pieces ``(item, lo, length, window)`` without padding: the emptiest windows
    are cut up to fill the others, and what then remains makes windows whose
    lengths are powers of two."""
    total = int(sizes.sum())
    full = total // capacity
    sums = np.bincount(where, weights=sizes, minlength=k).astype(np.int64)
    rank = np.empty(k, dtype=np.int64)
    order = np.argsort(-sums, kind="stable")
    rank[order] = np.arange(k)
    kept = rank[where] < full
    whole = np.flatnonzero(kept)
    pool = np.flatnonzero(~kept)
    pool = pool[np.argsort(rank[where[pool]], kind="stable")]
    rest = total - full * capacity
    tail = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    want = np.concatenate([capacity - sums[order[:full]], np.array(tail, dtype=np.int64)])
    target = np.arange(len(want))[want > 0]
    # Lay the pool's tokens end to end; a piece ends where an item or a gap ends.
    item_end, gap_end = np.cumsum(sizes[pool]), np.cumsum(want[target])
    ends = np.union1d(item_end, gap_end)
    begins = np.concatenate([[0], ends])[:-1].astype(np.int64)
    at = np.searchsorted(item_end, begins, side="right")
    into = np.searchsorted(gap_end, begins, side="right")
    lo = begins - (item_end - sizes[pool])[at]
    return (np.concatenate([whole, pool[at]]), np.concatenate([np.zeros(len(whole), np.int64), lo]),
            np.concatenate([sizes[whole], ends - begins]), np.concatenate([rank[where[whole]], target[into]]))


def pack_group(tokens: np.ndarray, capacity: int, close: bool = True) -> tuple[np.ndarray, ...]:
    """Pieces ``(document, start, length, window, offset)`` of documents of so many tokens."""
    full, rest = tokens // capacity, tokens % capacity
    item = np.flatnonzero(rest)
    sizes = rest[item]
    where, k = near_equal_windows(sizes, capacity) if len(item) else (np.zeros(0, np.int64), 0)
    if close and len(item):
        at, lo, length, window = close_windows(sizes, where, k, capacity)
    else:
        at, lo, length, window = np.arange(len(item)), np.zeros(len(item), np.int64), sizes, where
    # whole windows of long documents come first, what is left over last
    doc = np.concatenate([np.repeat(np.arange(len(tokens)), full), item[at]])
    cut = np.arange(int(full.sum())) - np.repeat(np.cumsum(full) - full, full)
    start = np.concatenate([cut * capacity, full[item[at]] * capacity + lo])
    length = np.concatenate([np.full(len(cut), capacity), length])
    base = int(window.max()) + 1 if len(window) else 0
    window = np.concatenate([base + np.arange(len(cut)), window])
    order = np.lexsort((start, doc, window))
    doc, start, length, window = (a[order].astype(np.int64) for a in (doc, start, length, window))
    end = np.cumsum(length)
    head = np.concatenate([[True], window[1:] != window[:-1]]) if len(window) else np.zeros(0, bool)
    first = (end - length)[head]
    offset = end - length - first[np.cumsum(head) - 1]
    return doc, start, length, window, offset


def _groups(batches, enc, separator: int, items: int, tokens: int):
    """Keys, ids and token counts of as many documents as make a group."""
    keys, ids, counts, have, size = [], [], [], 0, 0
    for held in regroup_arrow(batches, "text", 1_000_000):
        got, n = enc.encode(held.column("text").to_pylist())
        n = n + 1
        at = np.cumsum(n) - 1
        flat = np.insert(got, at - np.arange(len(n)), separator).astype("<u4")
        keys.append(held.column("key").combine_chunks())
        ids.append(flat)
        counts.append(n)
        have, size = have + len(n), size + len(flat)
        if have >= items or size >= tokens:
            yield pa.chunked_array(keys).combine_chunks(), np.concatenate(ids), np.concatenate(counts)
            keys, ids, counts, have, size = [], [], [], 0, 0
    if have:
        yield pa.chunked_array(keys).combine_chunks(), np.concatenate(ids), np.concatenate(counts)


def pack_windows(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
                 capacity: int = CAPACITY, separator: int = SEPARATOR, close: bool = True,
                 items: int = ITEMS, tokens: int = TOKENS) -> DataFrame:
    """One row per piece: ``key, start, length, ids, doc_tokens, sequence_id, offset``.

    A document is its tokenizer ids (no special tokens added) and then
    ``separator``. ``ids`` holds the piece's ids as little-endian unsigned 32-bit
    numbers, ``start`` the ids of its document before it, ``offset`` its place in
    its sequence, without gaps from 0. Documents longer than ``capacity`` give
    whole sequences first; what is left of them is packed with the others.

    One pass and no shuffle: a task packs its partition in groups of about
    ``items`` documents or ``tokens`` tokens, so memory is bounded by a group and
    its longest document. With ``close`` no sequence needs padding: it is full or
    its length is a power of two (at most log2 of the capacity such ones a group).
    Without, sequences are near-equal and no document up to ``capacity`` is cut.
    A task that runs again packs alike.

    Null or empty text is the separator alone; repeated rows are packed each; a
    null key is kept; an empty table gives no rows; other columns are ignored.
    """
    spark = df.sparkSession
    text_batches(spark)
    src = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = StructType([src.schema["key"], *StructType.fromDDL(FIELDS).fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        enc = encoder(tokenizer)
        base = TaskContext.get().partitionId() << 36
        for keys, ids, counts in _groups(batches, enc, separator, items, tokens):
            doc, start, length, window, offset = pack_group(counts, capacity, close)
            lo = (np.cumsum(counts) - counts)[doc] + start
            raw = ids.tobytes()
            cols = [keys.take(pa.array(doc)), pa.array(start), pa.array(length),
                    pa.array([raw[4 * a:4 * (a + m)] for a, m in zip(lo.tolist(), length.tolist())], pa.binary()),
                    pa.array(counts[doc]), pa.array(base + window), pa.array(offset)]
            base += int(window.max()) + 1
            table = pa.Table.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow)], schema=arrow)
            yield from table.to_batches(max_chunksize=4096)

    return src.mapInArrow(run, schema).withColumnRenamed("key", key)


def window_report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``pack_windows`` with each piece's ids as their CRC."""
    return pack_windows(df, key, text).select(
        key, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
