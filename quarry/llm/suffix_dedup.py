"""Removal of long repeated byte strings across documents.

A byte goes if some 50-byte string that covers it also starts in a document with
a smaller id. The suffixes are put in order by the difference-cover algorithm
(sampled triples are sorted and named, the names are ordered recursively, the
remaining suffixes are merged in) and adjacent prefixes are compared.

How the work is spread. The order of two suffixes only matters up to 50 bytes, so
suffixes that share these bytes must meet and others need not:

1. Documents are hashed into blocks. In each block every 50-byte string gets its
   minimiser, the smallest hash of the 20-byte strings in it; equal strings have
   equal minimisers. Blocks send their distinct minimisers, packed, to
   hash-partitioned tasks, which return those that occur in several documents.
   (Hash collisions only let a few strings more through.)
2. Each block cuts its texts into runs of neighbouring strings with one repeated
   minimiser and sends them to the partition of the minimiser. Equal runs of a
   block are sent once, for the smallest document, so a passage in a third of
   all documents reaches a partition at most once per block.
   Runs of a minimiser whose runs exceed a bound over all blocks (a frequent phrase
   with ever new neighbours) would fill one partition. Of these, blocks first
   exchange the hashes of the 50-byte strings themselves, as in step 1; each string
   that occurs in several documents is then a run of its own, sent with its bytes,
   once per block, to the partition of its own hash.
3. Each partition drops equal runs, orders the suffixes of what is left by the
   difference-cover algorithm, compares adjacent 50-byte prefixes, and sends
   covered intervals back to the blocks, which cut the texts. (A run that is left
   alone with its minimiser shares no string with any other and is not sorted.)

All steps use one shuffle of the texts by block (the exchange is reused);
everything else that moves is packed numpy arrays. Blocks and partitions grow in
number with the input, not in size. A block sends at most ``FAN`` rows whatever
the number of partitions: beyond that hashes travel in two hops, from blocks to
bands of blocks and from there to partitions, and back the same way. Hashes only
bring strings together; that two are equal is decided by their bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quarry.llm.common import free_name, text_batches

LENGTH = 50            # bytes of a string that counts as a repeat
GRAM = 20              # bytes of a minimiser
SPREAD = LENGTH - GRAM + 1
MAX_RUN = 2048         # starts in one run; longer ones are cut (equal strings still meet)
PIECE = 1 << 20        # bytes hashed at a time
BLOCK_BYTES = 4 << 20  # text of a block of documents
SPLIT_BYTES = 1 << 20  # bytes of the runs of one minimiser, above which its strings go to partitions of their own
FAN = 512              # rows a block (or a band of blocks) sends in one exchange
NO_ID = np.iinfo(np.int64).max

U = np.uint64
MIX = [U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x94D049BB133111EB), U(0xBF58476D1CE4E5B9), U(0xD6E8FEB86659FD93)]


def _words8(b: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as one number (little end first), zero padded."""
    x = np.concatenate([b, np.zeros(8, dtype=np.uint8)]).astype(U)
    x = x[:-1] | (x[1:] << U(8))
    x = x[:-2] | (x[2:] << U(16))
    return (x[:-4] | (x[4:] << U(32)))[:len(b)]


def _minimisers(b: np.ndarray) -> np.ndarray:
    """For each start of a LENGTH-byte string, the smallest hash of its GRAM-byte strings."""
    x8 = _words8(b)
    n = len(b) - GRAM + 1
    h = (x8[:n] * MIX[0]) ^ (x8[8:8 + n] * MIX[1])
    h = (h ^ (h >> U(29))) * MIX[3]
    h ^= (x8[16:16 + n] & U(0xFFFFFFFF)) * MIX[2]
    h = (h ^ (h >> U(32))) * MIX[4]
    h ^= h >> U(29)
    width = 1
    while width * 2 <= SPREAD:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    if width < SPREAD:
        h = np.minimum(h[:len(h) - (SPREAD - width)], h[SPREAD - width:])
    return h


def _runs(b: np.ndarray, offsets: np.ndarray):
    """Runs of neighbouring string starts with one minimiser, over texts that lie
    one after the other (``offsets``): (minimiser, text, start in b, starts)."""
    out = []
    i, m = 0, len(offsets) - 1
    while i < m:  # pieces of whole texts
        j = i + 1
        while j < m and offsets[j + 1] - offsets[i] <= PIECE:
            j += 1
        lo, hi = int(offsets[i]), int(offsets[j])
        if hi - lo >= LENGTH:
            mins = _minimisers(b[lo:hi])
            ok = np.ones(len(mins), dtype=bool)
            ends = offsets[i + 1:j + 1] - lo
            begins = offsets[i:j] - lo
            for e, s in zip(ends[:-1], begins[:-1]):
                ok[max(s, e - LENGTH + 1):e] = False
            first = ok.copy()
            first[1:] &= ~ok[:-1] | (mins[1:] != mins[:-1])
            last = ok.copy()
            last[:-1] &= ~ok[1:] | (mins[1:] != mins[:-1])
            s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
            if len(s):
                parts = (e - s + MAX_RUN - 1) // MAX_RUN
                if parts.max() > 1:
                    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
                    e = np.minimum(np.repeat(e, parts), np.repeat(s, parts) + (nth + 1) * MAX_RUN)
                    s = np.repeat(s, parts) + nth * MAX_RUN
                out.append((mins[s], np.searchsorted(offsets, s + lo, side="right") - 1, s + lo, e - s))
        i = j
    if not out:
        z = np.zeros(0, dtype=np.int64)
        return z.astype(U), z, z, z
    return tuple(np.concatenate(x) for x in zip(*out))


def _spread(mins: np.ndarray) -> np.ndarray:
    g = mins * MIX[0]
    g ^= g >> U(31)
    return g * MIX[1]


def _texts(t: pa.Table, key: str, text: str):
    """Texts of a block in a fixed order: ids, bytes, offsets, row numbers, digests.

    A null text is empty; a null id counts as larger than all others."""
    ids = np.array([NO_ID if v is None else v for v in t.column(key).to_pylist()], dtype=np.int64)
    raw = [b"" if v is None else v.encode("utf-8") for v in t.column(text).to_pylist()]
    dig = [hashlib.md5(v).digest() for v in raw]
    order = sorted(range(len(raw)), key=lambda i: (ids[i], dig[i]))
    raw = [raw[i] for i in order]
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in raw], dtype=np.int64)]).astype(np.int64)
    return ids[order], b"".join(raw), offsets, np.array(order, dtype=np.int64), [dig[i] for i in order]


# ---- step 1: which minimisers occur in several documents ----

# Entries of one or more blocks: per block ``sizes`` codes (partition and hash), whether
# a code is in several documents of its block, the bytes behind it as a power of two,
# and ``dsizes`` whole-text digests with their ids and row numbers.
FOUND = ("part int, band int, blocks binary, sizes binary, codes binary, local binary, weights binary, "
         "dsizes binary, digests binary, ids binary, rows binary")
# The answers: per block ``sizes`` codes that occur in several documents, which of them
# are heavy, and ``dsizes`` rows that are copies of a text with a smaller id.
HITS = "part int, band int, blocks binary, sizes binary, codes binary, heavy binary, dsizes binary, copies binary"
BY_BLOCK = "block int, codes binary, heavy binary, copies binary"


def _table_of(ddl: str, rows: list[dict]) -> pa.Table:
    names = [x.split() for x in ddl.split(", ")]
    return pa.table({n: pa.array([r[n] for r in rows], pa.int32() if k == "int" else pa.binary()) for n, k in names})


def _column(t: pa.Table, name: str, dtype) -> np.ndarray:
    """A packed column of all rows, one after the other."""
    return np.frombuffer(b"".join(t.column(name).to_pylist()), dtype=dtype)


def _codes(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> U(32)) % U(parts)) << U(32) | (hashes & U(0xFFFFFFFF))


def _digest_parts(digests: np.ndarray, parts: int) -> np.ndarray:
    return (digests[:, 0] % U(parts)).astype(np.int64)


def _cuts(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct sorted keys and where their runs begin and end."""
    key, first = np.unique(sorted_keys, return_index=True)
    return key, first, np.append(first[1:], len(sorted_keys))[:len(key)]      # no keys, no runs


def _found_rows(block: int, band: int, wide: int, parts: int, code, local, weight, digests, ids, rows) -> list[dict]:
    """One row per group of ``wide`` partitions that has entries; ``code`` ascends."""
    to, dto = (code >> U(32)).astype(np.int64) // wide, _digest_parts(digests, parts) // wide
    by = np.argsort(dto, kind="stable")
    dto, digests, ids, rows = dto[by], digests[by], ids[by], rows[by]
    out = []
    for p in np.union1d(to, dto).tolist():
        x, y = np.searchsorted(to, [p, p + 1])
        u, v = np.searchsorted(dto, [p, p + 1])
        own = code[x:y] & U(0xFFFFFFFF) if wide == 1 else code[x:y]
        out.append({"part": p, "band": band, "blocks": np.int32(block).tobytes(), "sizes": np.int32(y - x).tobytes(),
                    "codes": own.astype(np.uint32 if wide == 1 else U).tobytes(), "local": local[x:y].astype(np.uint8).tobytes(),
                    "weights": weight[x:y].tobytes(), "dsizes": np.int32(v - u).tobytes(),
                    "digests": np.ascontiguousarray(digests[u:v]).tobytes(), "ids": ids[u:v].tobytes(),
                    "rows": rows[u:v].astype(np.int32).tobytes()})
    return out


def _send_minimisers(key: str, text: str, parts: int, wide: int = 1):
    def run(t: pa.Table) -> pa.Table:
        block = t.column("__block")[0].as_py()
        ids, raw, offsets, _, dig = _texts(t, key, text)
        b = np.frombuffer(raw, dtype=np.uint8)
        mins, doc, _, n = _runs(b, offsets)
        code = _codes(_spread(mins), parts)
        o = np.lexsort((ids[doc], code))
        code, who, n = code[o], ids[doc][o], n[o] + LENGTH - 1
        _, head, end = _cuts(code)
        # Bytes of the runs of each minimiser, rounded up to a power of two.
        weight = np.ceil(np.log2(np.add.reduceat(n, head))).astype(np.uint8) if len(head) else np.zeros(0, np.uint8)
        d16 = np.frombuffer(b"".join(dig), dtype=U).reshape(-1, 2)
        return _table_of(FOUND, _found_rows(block, block // wide, wide, parts, code[head], who[head] != who[end - 1], weight, d16, ids,
                                            np.arange(len(ids))))
    return run


def _to_parts(parts: int):
    """Second hop: the entries of a band of blocks, by partition."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("blocks")
        band = t.column("band")[0].as_py()
        blocks, sizes, dsizes = (_column(t, c, np.int32) for c in ("blocks", "sizes", "dsizes"))
        code, local, weight = _column(t, "codes", U), _column(t, "local", np.uint8), _column(t, "weights", np.uint8)
        digests, ids, rows = _column(t, "digests", U).reshape(-1, 2), _column(t, "ids", np.int64), _column(t, "rows", np.int32)
        owner, downer = np.repeat(np.arange(len(blocks)), sizes), np.repeat(np.arange(len(blocks)), dsizes)
        to, dto = (code >> U(32)).astype(np.int64), _digest_parts(digests, parts)
        by, dby = np.argsort(to, kind="stable"), np.argsort(dto, kind="stable")
        to, dto = to[by], dto[dby]
        out = []
        for p in np.union1d(to, dto).tolist():
            e, d = by[slice(*np.searchsorted(to, [p, p + 1]))], dby[slice(*np.searchsorted(dto, [p, p + 1]))]
            who = np.union1d(owner[e], downer[d])
            out.append({"part": p, "band": band, "blocks": blocks[who].tobytes(),
                        "sizes": np.bincount(np.searchsorted(who, owner[e]), minlength=len(who)).astype(np.int32).tobytes(),
                        "codes": code[e].tobytes(), "local": local[e].tobytes(), "weights": weight[e].tobytes(),
                        "dsizes": np.bincount(np.searchsorted(who, downer[d]), minlength=len(who)).astype(np.int32).tobytes(),
                        "digests": np.ascontiguousarray(digests[d]).tobytes(), "ids": ids[d].tobytes(), "rows": rows[d].tobytes()})
        return _table_of(FOUND, out)
    return run


def _find_repeated(split_bytes: int, wide: int = 1):
    return lambda t: _repeated(t, split_bytes, wide)


def _repeated(t: pa.Table, split_bytes: int, wide: int) -> pa.Table:
    part = t.column("part")[0].as_py()
    code = _column(t, "codes", np.uint32 if wide == 1 else U).astype(U)
    if wide == 1:
        code = code | (U(part) << U(32))
    o = np.argsort(code, kind="stable")
    _, start, end = _cuts(code[o])
    flag, heavy = np.zeros(len(code), dtype=bool), np.zeros(len(code), dtype=bool)
    if len(start):
        size = end - start
        hit = (size > 1) | np.logical_or.reduceat(_column(t, "local", np.uint8)[o].astype(bool), start)
        flag[o] = np.repeat(hit, size)
        bytes_ = np.exp2(_column(t, "weights", np.uint8)[o].astype(np.float64))
        heavy[o] = np.repeat(np.add.reduceat(bytes_, start) > split_bytes, size)
    dig, ids, rows = _column(t, "digests", "V16"), _column(t, "ids", np.int64), _column(t, "rows", np.int32)
    _, same = np.unique(dig, return_inverse=True) if len(dig) else (None, np.zeros(0, np.int64))
    least = np.full(int(same.max()) + 1 if len(same) else 0, NO_ID)
    np.minimum.at(least, same, ids)
    copy = least[same] < ids
    # The answers go back the way the entries came: by band, or by block if there is one hop.
    out, x, y = [], 0, 0
    lists = zip(*(t.column(c).to_pylist() for c in ("band", "blocks", "sizes", "dsizes")))
    for band, *packed in lists:
        blocks, sizes, dsizes = (np.frombuffer(v, dtype=np.int32) for v in packed)
        n, m = int(sizes.sum()), int(dsizes.sum())
        f, c = flag[x:x + n], copy[y:y + m]
        if f.any() or c.any():
            count = lambda sz, ok: np.bincount(np.repeat(np.arange(len(sz)), sz)[ok], minlength=len(sz)).astype(np.int32)
            out.append({"part": part // wide, "band": band, "blocks": blocks.tobytes(), "sizes": count(sizes, f).tobytes(),
                        "codes": code[x:x + n][f].tobytes(), "heavy": heavy[x:x + n][f].astype(np.uint8).tobytes(),
                        "dsizes": count(dsizes, c).tobytes(), "copies": rows[y:y + m][c].tobytes()})
        x, y = x + n, y + m
    return _table_of(HITS, out)


def _to_blocks(t: pa.Table) -> pa.Table:
    """The answers of several partitions, by block."""
    blocks, sizes, dsizes = (_column(t, c, np.int32) for c in ("blocks", "sizes", "dsizes"))
    code, heavy, copies = _column(t, "codes", U), _column(t, "heavy", np.uint8), _column(t, "copies", np.int32)
    owner, downer = np.repeat(blocks, sizes), np.repeat(blocks, dsizes)
    by, dby = np.argsort(owner, kind="stable"), np.argsort(downer, kind="stable")
    owner, downer, out = owner[by], downer[dby], []
    for k in np.unique(blocks).tolist():
        e, d = by[slice(*np.searchsorted(owner, [k, k + 1]))], dby[slice(*np.searchsorted(downer, [k, k + 1]))]
        if len(e) or len(d):
            out.append({"block": k, "codes": code[e].tobytes(), "heavy": heavy[e].tobytes(), "copies": copies[d].tobytes()})
    return _table_of(BY_BLOCK, out)


def _answers(found: DataFrame, parts: int, wide: int, split_bytes: float) -> DataFrame:
    """Which of the entries occur in several documents, by block."""
    if wide > 1:
        found = found.groupBy("part", "band").applyInArrow(_to_parts(parts), FOUND)
    hits = found.groupBy("part").applyInArrow(_find_repeated(split_bytes, wide), HITS)
    if wide == 1:       # a band is a block
        return hits.select(F.col("band").alias("block"), "codes", "heavy", "copies")
    return hits.groupBy("part", "band").applyInArrow(_to_blocks, BY_BLOCK)


# ---- step 2: runs of repeated minimisers, by partition ----

RUNS = "part int, block int, meta binary, body binary, covered binary"
META = np.dtype([("min", "<u8"), ("hash", "<u8"), ("id", "<i8"), ("row", "<i4"), ("start", "<i4"), ("size", "<i4")])
SPAN = np.dtype([("row", "<i4"), ("start", "<i4"), ("end", "<i4")])
_TABLE = np.random.default_rng(20250101).integers(1, 2**63, 256, dtype=np.int64).astype(U)
_BASE = U(0x2545F4914F6CDD1D)
_BACK = U(pow(0x2545F4914F6CDD1D, -1, 2**64))


_POWER = np.cumprod(np.concatenate([[U(1)], np.full(PIECE + MAX_RUN + LENGTH, _BASE)]), dtype=U)
_POWER_BACK = np.cumprod(np.concatenate([[U(1)], np.full(PIECE + MAX_RUN + LENGTH, _BACK)]), dtype=U)


def _run_hashes(b: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of b[start:start+length], from prefix sums over a
    piece at a time. ``start`` ascends."""
    out = np.empty(len(start), dtype=U)
    i = 0
    while i < len(start):
        lo = int(start[i])
        j = int(np.searchsorted(start, lo + PIECE))
        at, n = start[i:j] - lo, length[i:j]
        part = _TABLE[b[lo:lo + int((at + n).max())]]
        total = np.concatenate([[U(0)], np.cumsum(part * _POWER[:len(part)], dtype=U)])
        out[i:j] = (total[at + n] - total[at]) * _POWER_BACK[at] ^ (n.astype(U) * MIX[2])
        i = j
    return out


def _start_hashes(b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64-bit hashes of the LENGTH-byte strings at ``start`` (ascending), of another
    kind than ``_run_hashes``."""
    out = np.empty(len(start), dtype=U)
    i = 0
    while i < len(start):
        lo = int(start[i])
        j = int(np.searchsorted(start, lo + PIECE))
        at = start[i:j] - lo
        x8 = _words8(b[lo:lo + int(at[-1]) + LENGTH])
        h = np.full(len(at), MIX[2])
        for off in (0, 8, 16, 24, 32, 40, LENGTH - 8):
            h = (h ^ x8[at + off]) * MIX[3]
            h ^= h >> U(31)
        out[i:j] = h
        i = j
    return out


def _join_spans(spans: np.ndarray) -> np.ndarray:
    """The spans of single strings, those that touch as one."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans["start"], spans["row"]))]
    head = np.flatnonzero(np.concatenate([[True], (spans["row"][1:] != spans["row"][:-1])
                                          | (spans["start"][1:] > spans["end"][:-1])]))
    out = spans[head].copy()
    out["end"] = spans["end"][np.append(head[1:], len(spans)) - 1]
    return out


def _gather(b: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The given pieces of b, one after the other."""
    at = np.cumsum(length) - length
    return b[np.arange(int(length.sum())) + np.repeat(start - at, length)]


def _verified(b: np.ndarray, at: np.ndarray, length: np.ndarray, o: np.ndarray, same: np.ndarray) -> np.ndarray:
    """``same`` (the run ``o[i]`` has the hashes of ``o[i - 1]``) where the bytes agree, too."""
    out = same.copy()
    idx = np.flatnonzero(same)
    i = 0
    while i < len(idx):
        j = i + max(1, int(np.searchsorted(np.cumsum(length[o[idx[i:]]]), PIECE)))
        one, two = o[idx[i:j]], o[idx[i:j] - 1]
        equal = length[one] == length[two]
        out[idx[i:j][~equal]] = False
        one, two, n = one[equal], two[equal], length[one][equal]
        if len(one):
            wrong = np.add.reduceat(_gather(b, at[one], n) != _gather(b, at[two], n), np.cumsum(n) - n) > 0
            out[idx[i:j][equal][wrong]] = False
        i = j
    return out


def _wanted(hits: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted codes that a block was told to occur elsewhere, which are heavy, and its copies."""
    code, heavy = _column(hits, "codes", U), _column(hits, "heavy", np.uint8).astype(bool)
    by = np.argsort(code, kind="stable")
    return code[by], heavy[by], _column(hits, "copies", np.int32)


def _is_in(code: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(wanted, code), max(len(wanted) - 1, 0))
    return at, wanted[at] == code if len(wanted) else np.zeros(len(code), bool)


def _repeated_runs(b, ids, offsets, hits: pa.Table, parts: int):
    """The runs of a block whose minimiser occurs elsewhere, in texts that are no
    copies: (minimiser, text, start, starts, heavy), and the copies."""
    wanted, heavy, copies = _wanted(hits)
    is_copy = np.zeros(len(ids), dtype=bool)
    is_copy[copies] = True
    mins, doc, start, n = _runs(b, offsets)
    at, ok = _is_in(_codes(_spread(mins), parts), wanted)
    ok &= ~is_copy[doc]
    many = heavy[at[ok]] if len(heavy) else np.zeros(int(ok.sum()), bool)
    return mins[ok], doc[ok], start[ok], n[ok], many, copies


def _single_starts(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.repeat(start, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def _send_heavy(key: str, text: str, parts: int, wide: int):
    """Hashes of the 50-byte strings of heavy minimisers (step 1 once more, for strings)."""
    def run(docs: pa.Table, hits: pa.Table) -> pa.Table:
        rows: list[dict] = []
        if docs.num_rows and hits.num_rows and _column(hits, "heavy", np.uint8).any():
            block = docs.column("__block")[0].as_py()
            ids, raw, offsets, _, _ = _texts(docs, key, text)
            b = np.frombuffer(raw, dtype=np.uint8)
            _, doc, start, n, many, _ = _repeated_runs(b, ids, offsets, hits, parts)
            ones = _single_starts(start[many], n[many])
            who = ids[np.repeat(doc[many], n[many])]
            code = _codes(_start_hashes(b, ones), parts)
            o = np.lexsort((who, code))
            code, who = code[o], who[o]
            _, head, end = _cuts(code)
            none = np.zeros(0, np.int64)
            rows = _found_rows(block, block // wide, wide, parts, code[head], who[head] != who[end - 1],
                               np.zeros(len(head), np.uint8), np.zeros((0, 2), U), none, none)
        return _table_of(FOUND, rows)
    return run


def _send_runs(key: str, text: str, parts: int, run_parts: int):
    kinds = {"part": pa.int32(), "block": pa.int32(), "meta": pa.binary(), "body": pa.binary(), "covered": pa.binary()}

    def run(docs: pa.Table, hits: pa.Table) -> pa.Table:
        rows: dict[str, list] = {c: [] for c in kinds}
        of_strings = np.array(hits.column("strings").to_pylist(), dtype=bool)
        first, second = hits.filter(pa.array(~of_strings)), hits.filter(pa.array(of_strings))
        if docs.num_rows and first.num_rows:
            block = docs.column("__block")[0].as_py()
            ids, raw, offsets, _, _ = _texts(docs, key, text)
            b = np.frombuffer(raw, dtype=np.uint8)
            mins, doc, start, n, many, copies = _repeated_runs(b, ids, offsets, first, parts)
            size = np.diff(offsets)
            whole = copies[size[copies] >= LENGTH]
            covered = np.zeros(len(whole), dtype=SPAN)
            covered["row"], covered["end"] = whole, size[whole]
            spans = [covered]
            # Of heavy minimisers, each repeated string is a run of its own, with its
            # hash in place of the minimiser.
            ones, one_doc = _single_starts(start[many], n[many]), np.repeat(doc[many], n[many])
            one_min = _start_hashes(b, ones)
            here = _is_in(_codes(one_min, parts), _wanted(second)[0])[1]
            ones, one_doc, one_min = ones[here], one_doc[here], one_min[here]
            h = np.concatenate([_run_hashes(b, start[~many], n[~many] + LENGTH - 1),
                                _run_hashes(b, ones, np.full(len(ones), LENGTH))])
            mins, doc = np.concatenate([mins[~many], one_min]), np.concatenate([doc[~many], one_doc])
            start = np.concatenate([start[~many], ones])
            n = np.concatenate([n[~many], np.ones(len(ones), dtype=n.dtype)])
            single = np.arange(len(n)) >= len(n) - len(ones)
            who = ids[doc]
            o = np.lexsort((who, h, mins, single))
            same = np.zeros(len(o), dtype=bool)
            same[1:] = (mins[o][1:] == mins[o][:-1]) & (h[o][1:] == h[o][:-1]) & (single[o][1:] == single[o][:-1])
            same = _verified(b, start, n + LENGTH - 1, o, same)
            least = who[o][np.maximum.accumulate(np.where(same, 0, np.arange(len(o))))] if len(o) else who
            later = np.zeros(len(o), dtype=bool)
            later[o] = who[o] > least  # the same string is in a smaller document of this block
            mine = np.zeros(int(later.sum()), dtype=SPAN)
            mine["row"], mine["start"] = doc[later], start[later] - offsets[doc[later]]
            mine["end"] = mine["start"] + n[later] + LENGTH - 1
            spans += [mine[~single[later]], _join_spans(mine[single[later]])]
            send = np.flatnonzero(~later)
            to = ((_spread(mins[send]) * MIX[2]) >> U(33)).astype(np.int64) % run_parts
            send = send[np.argsort(to, kind="stable")]
            _, begin, end = _cuts(np.sort(to))
            to = np.sort(to)
            meta = np.zeros(len(send), dtype=META)
            meta["min"], meta["hash"], meta["id"], meta["row"] = mins[send], h[send], who[send], doc[send]
            meta["start"], meta["size"] = start[send] - offsets[doc[send]], n[send]
            done = np.concatenate(spans).tobytes()
            for x, y in zip(begin, end):
                rows["part"].append(int(to[x]))
                rows["block"].append(block)
                rows["meta"].append(meta[x:y].tobytes())
                rows["body"].append(_gather(b, start[send[x:y]], n[send[x:y]] + LENGTH - 1).tobytes())
                rows["covered"].append(b"")
            if done:
                rows["part"].append(block % run_parts)
                rows["block"].append(block)
                rows["meta"].append(b"")
                rows["body"].append(b"")
                rows["covered"].append(done)
        return pa.table({c: pa.array(v, type=kinds[c]) for c, v in rows.items()})
    return run


# ---- step 3: difference-cover order and adjacent prefixes ----

def _pack(*cols: np.ndarray) -> np.ndarray:
    """One number per tuple, in the tuples' order."""
    code, top = cols[0].astype(np.int64), int(cols[0].max(initial=0)) + 1
    for c in cols[1:]:
        width = int(c.max(initial=0)) + 1
        if top * width >= 2**63:
            seen, code = np.unique(code, return_inverse=True)
            top = len(seen)
        code = code * width + c
        top *= width
    return code


def suffix_ranks(s: np.ndarray) -> np.ndarray:
    """Rank (from 0) of every suffix of ``s`` (numbers from 1), by a difference
    cover modulo 3.

    Suffixes at positions 1 and 2 modulo 3 are the sample. Their triples are
    sorted and named; if two triples are equal, the string of names is ordered by
    recursion. A remaining suffix is its first number and a sample rank; it is
    merged with the sample by comparing one or two numbers and then ranks.
    """
    n = len(s)
    if n < 6:
        order = sorted(range(n), key=lambda i: s[i:].tolist())
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.arange(n)
        return rank
    z = np.concatenate([s, np.zeros(4, dtype=s.dtype)])
    one = np.arange(1, n + (n % 3 == 1), 3)  # with a closing triple of zeros where needed
    two = np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    triples = _pack(z[sample], z[sample + 1], z[sample + 2])
    named, names = np.unique(triples, return_inverse=True)
    ranked = names if len(named) == len(sample) else suffix_ranks(names + 1)
    rk = np.zeros(n + 4, dtype=np.int64)
    rk[sample] = ranked + 1
    zero = np.arange(0, n, 3)
    one = one[one < n]
    one_by_rank, two_by_rank = one[np.argsort(rk[one])], two[np.argsort(rk[two])]
    zero = zero[np.argsort(_pack(z[zero], rk[zero + 1]), kind="stable")]
    a = np.concatenate([zero, one_by_rank])
    short = _pack(z[a], rk[a + 1])
    short0, short1 = short[:len(zero)], short[len(zero):]
    c = np.concatenate([zero, two_by_rank])
    long_ = _pack(z[c], z[c + 1], rk[c + 2])
    long0, long2 = long_[:len(zero)], long_[len(zero):]
    rank = np.empty(n, dtype=np.int64)
    rank[zero] = np.arange(len(zero)) + np.searchsorted(short1, short0) + np.searchsorted(long2, long0)
    taken = np.concatenate([one, two])
    place = np.empty(len(taken), dtype=np.int64)
    place[np.argsort(rk[taken])] = np.arange(len(taken))
    rank[taken] = place
    rank[one_by_rank] += np.searchsorted(short0, short1)
    rank[two_by_rank] += np.searchsorted(long0, long2)
    return rank


COVERED = "block int, covered binary"


def _resolve(t: pa.Table) -> pa.Table:
    blocks = np.array(t.column("block").to_pylist(), dtype=np.int64)
    metas = [np.frombuffer(m, dtype=META) for m in t.column("meta").to_pylist()]
    body = np.frombuffer(b"".join(t.column("body").to_pylist()), dtype=np.uint8)
    meta = np.concatenate(metas)
    block = np.repeat(blocks, [len(m) for m in metas])
    out: dict[int, list[bytes]] = {}
    for blk, c in zip(blocks.tolist(), t.column("covered").to_pylist()):
        if c:
            out.setdefault(blk, []).append(c)
    if len(meta):
        size = meta["size"].astype(np.int64)
        length = size + LENGTH - 1
        at = np.cumsum(length) - length
        o = np.lexsort((meta["id"], meta["hash"], meta["size"], meta["min"]))
        m = meta[o]
        same = np.zeros(len(o), dtype=bool)
        same[1:] = (m["min"][1:] == m["min"][:-1]) & (m["hash"][1:] == m["hash"][:-1]) & (m["size"][1:] == m["size"][:-1])
        # Runs that only share their hashes stay apart; they are ordered like any others.
        same = _verified(body, at, length, o, same)
        group = np.cumsum(~same) - 1
        heads = np.flatnonzero(~same)
        least = m["id"][heads]
        spans, owner = [], []

        def emit(which: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
            """Starts lo..hi-1 of the runs ``which`` begin covered strings."""
            x = np.zeros(len(which), dtype=SPAN)
            x["row"] = meta["row"][which]
            x["start"] = meta["start"][which] + lo
            x["end"] = meta["start"][which] + hi + LENGTH - 1
            spans.append(x)
            owner.append(block[which])

        def order_runs(chosen: np.ndarray) -> None:
            """Covered strings of the chosen distinct runs, each taken for its
            smallest document."""
            if not len(chosen):
                return
            rep, lowest = o[heads[chosen]], least[chosen]
            n, ln = size[rep], length[rep]
            text = _gather(body, at[rep], ln)
            first = np.cumsum(ln + 1) - (ln + 1)
            closed = np.zeros(int((ln + 1).sum()), dtype=np.int64)  # 1 closes a run
            inside = np.arange(len(text)) + np.repeat(np.arange(len(rep)), ln)
            closed[inside] = text.astype(np.int64) + 2
            closed[closed == 0] = 1
            starts = np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)
            run_of = np.repeat(np.arange(len(rep)), n)
            by = np.argsort(suffix_ranks(closed)[starts])
            pos = starts[by]
            x8 = _words8(np.where(closed > 1, closed - 2, 0).astype(np.uint8))
            equal = np.ones(max(len(pos) - 1, 0), dtype=bool)
            for off in (0, 8, 16, 24, 32, 40, LENGTH - 8):
                equal &= x8[pos[1:] + off] == x8[pos[:-1] + off]
            new = np.concatenate([[True], ~equal])
            who = lowest[run_of[by]]
            lows = np.minimum.reduceat(who, np.flatnonzero(new))
            hit = np.zeros(len(pos), dtype=bool)
            hit[by] = lows[np.cumsum(new) - 1] < who
            # Neighbouring covered starts of a run as intervals, for each place of the run.
            edge = hit.copy()
            edge[1:] &= ~hit[:-1] | (run_of[1:] != run_of[:-1])
            last = hit.copy()
            last[:-1] &= ~hit[1:] | (run_of[1:] != run_of[:-1])
            lo, hi = np.flatnonzero(edge), np.flatnonzero(last) + 1
            if not len(lo):
                return
            base = np.cumsum(n) - n
            r = run_of[lo]
            number = np.full(len(heads), -1)
            number[chosen] = np.arange(len(chosen))
            mine = (m["id"] == least[group]) & (number[group] >= 0)
            places, g_of = o[mine], number[group[mine]]  # a run may be more than once in its smallest document
            count = np.bincount(g_of, minlength=len(rep))
            begin = np.cumsum(count) - count
            times = count[r]
            nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            emit(places[np.repeat(begin[r], times) + nth], np.repeat(lo - base[r], times), np.repeat(hi - base[r], times))

        later = o[m["id"] > least[group]]
        emit(later, np.zeros(len(later), np.int64), size[later])
        # Equal strings have equal minimisers: a run that is the only one of its
        # minimiser shares no string with another run, so its smallest document
        # keeps it. The others are ordered.
        alone = np.ones(len(heads), dtype=bool)
        twin = m["min"][heads][1:] == m["min"][heads][:-1]
        alone[1:] &= ~twin
        alone[:-1] &= ~twin
        order_runs(np.flatnonzero(~alone))
        every, own = np.concatenate(spans), np.concatenate(owner)
        o2 = np.argsort(own, kind="stable")
        every, own = every[o2], own[o2]
        cuts = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [len(own)]]) if len(own) else [0]
        for x, y in zip(cuts[:-1], cuts[1:]):
            out.setdefault(int(own[x]), []).append(every[x:y].tobytes())
    return pa.table({"block": pa.array(list(out), pa.int32()),
                     "covered": pa.array([b"".join(v) for v in out.values()], pa.binary())})


def _merge(spans: np.ndarray) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(zip(spans["start"].tolist(), spans["end"].tolist())):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _cut_texts(key: str, text: str, schema: pa.Schema):
    def run(docs: pa.Table, cov: pa.Table) -> pa.Table:
        ids, raw, offsets, order, _ = _texts(docs, key, text)
        spans = np.concatenate([np.zeros(0, SPAN), *[np.frombuffer(c, dtype=SPAN) for c in cov.column("covered").to_pylist()]])
        spans = spans[np.argsort(spans["row"], kind="stable")]
        at = np.searchsorted(spans["row"], np.arange(len(ids) + 1))
        res: dict[str, list] = {c: [None] * len(ids) for c in ("bytes", "removed", "spans", "sha", "kept")}
        for i in range(len(ids)):
            b = raw[offsets[i]:offsets[i + 1]]
            cut = _merge(spans[at[i]:at[i + 1]])
            left, last = [], 0
            for s, e in cut:
                left.append(b[last:s])
                last = e
            left.append(b[last:])
            rest = b"".join(left)
            k = int(order[i])
            res["bytes"][k], res["removed"][k], res["spans"][k] = len(b), len(b) - len(rest), len(cut)
            res["sha"][k] = hashlib.sha256(rest).hexdigest()
            res["kept"][k] = rest.decode("utf-8", "ignore")
        cols = [docs.column(i) for i in range(docs.num_columns) if docs.column_names[i] != "__block"]
        cols += [pa.array(res["bytes"], pa.int64()), pa.array(res["removed"], pa.int64()), pa.array(res["spans"], pa.int64()),
                 pa.array(res["sha"], pa.string()), pa.array(res["kept"], pa.string())]
        return pa.Table.from_arrays(cols, names=schema)
    return run


def _sent_runs(base: DataFrame, k: str, t: str, parts: int, run_parts: int, split_bytes: int, fan: int = FAN) -> DataFrame:
    """Steps 1 and 2: the runs of repeated minimisers by partition."""
    wide = -(-parts // fan)     # partitions that share a row of the first hop, and blocks in a band
    docs = base.groupBy("__block")
    hits = _answers(docs.applyInArrow(_send_minimisers(k, t, parts, wide), FOUND), parts, wide, split_bytes)
    heavy = docs.cogroup(hits.groupBy("block")).applyInArrow(_send_heavy(k, t, parts, wide), FOUND)
    strings = _answers(heavy, parts, wide, float("inf"))
    both = hits.withColumn("strings", F.lit(False)).unionByName(strings.withColumn("strings", F.lit(True)))
    return docs.cogroup(both.groupBy("block")).applyInArrow(_send_runs(k, t, parts, run_parts), RUNS)


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES,
                   split_bytes: int = SPLIT_BYTES, fan: int = FAN) -> tuple[DataFrame, dict[str, str]]:
    """All columns of ``df`` plus ``n_bytes, n_removed, n_spans, kept_sha256, kept_text``
    (returned with the names they got, which never clash).

    Texts are UTF-8 bytes. A byte is removed if a 50-byte string that covers it
    also starts in a row with a smaller ``key``; strings are judged on the input.
    ``n_spans`` counts maximal removed runs, ``kept_sha256`` digests the rest,
    ``kept_text`` is the rest as text (bytes of characters cut in two are left
    out of it, not of the digest).

    Null text is empty; a text under 50 bytes is kept whole; rows of equal key
    remove nothing from each other; a null key counts as larger than all others;
    repeated rows each get a row; an empty table gives none.
    """
    spark = df.sparkSession
    text_batches(spark)
    total = df.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    blocks = max(64, total // block_bytes)
    parts, run_parts = max(32, total // (8 << 20)), max(64, total // (2 << 20))
    names, taken = {}, list(df.columns)
    for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"):
        names[c] = free_name(taken, f"__{c}")
        taken.append(names[c])
    inner = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    k, t = f"c{df.columns.index(key)}", f"c{df.columns.index(text)}"
    inner = inner.withColumn(k, F.col(k).cast("long")).withColumn(t, F.col(t).cast("string"))
    base = inner.withColumn("__block", F.pmod(F.xxhash64(k), F.lit(blocks)).cast("int"))
    covered = _sent_runs(base, k, t, parts, run_parts, split_bytes, fan).groupBy("part").applyInArrow(_resolve, COVERED)
    extra = [StructField(names["n_bytes"], _t("long")), StructField(names["n_removed"], _t("long")),
             StructField(names["n_spans"], _t("long")), StructField(names["kept_sha256"], _t("string")),
             StructField(names["kept_text"], _t("string"))]
    schema = StructType([*inner.schema.fields, *extra])
    cut = base.groupBy("__block").cogroup(covered.groupBy("block")).applyInArrow(
        _cut_texts(k, t, [f.name for f in schema.fields]), schema)
    return cut.toDF(*df.columns, *names.values()), names


def _t(name: str):
    return StructType.fromDDL(f"x {name}").fields[0].dataType


def repeat_report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    got, names = remove_repeats(df.select(key, text), key, text)
    return got.select(key, *[F.col(names[c]).alias(c) for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with its texts cut (a column ``n_chars``, if there is one, follows)."""
    got, names = remove_repeats(df, key, text)
    kept = F.when(F.col(text).isNull(), F.col(text)).otherwise(F.col(names["kept_text"]))
    cols = []
    for c in df.columns:
        if c == text:
            cols.append(kept.alias(c))
        elif c == "n_chars":
            cols.append(F.when(F.col(names["n_removed"]) > 0, F.char_length(kept).cast("long"))
                        .otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(c))
    return got.select(*cols)
