"""Counting quotient filters of packed word-id n-grams.

An n-gram of up to four word ids is one number of two halves. An invertible
permutation spreads the numbers evenly; of the permuted number the leading bits
(the quotient) are stored by position and all other bits (the remainder) in full,
so a filter loses nothing and can be read back. Filters are sorted, so they merge
like sorted lists.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U = np.uint64
ROUNDS = [U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
MANY = 255     # counts from here on stand in a list of their own


def _mix(x: np.ndarray, key: np.uint64) -> np.ndarray:
    x = (x ^ key) * U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(29))


def ones(bits: int) -> np.uint64:
    return U((1 << bits) - 1)


def permute(hi: np.ndarray, lo: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """A Feistel network over two halves of ``half`` bits."""
    mask = ones(half)
    for key in ROUNDS:
        hi, lo = lo, hi ^ (_mix(lo, key) & mask)
    return hi, lo


def restore(hi: np.ndarray, lo: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    mask = ones(half)
    for key in reversed(ROUNDS):
        hi, lo = lo ^ (_mix(hi, key) & mask), hi
    return hi, lo


def sort_order(hi: np.ndarray, lo: np.ndarray, half: int) -> np.ndarray:
    """Order by ``(hi, lo)``. Mostly the first 64 bits decide; where they do not,
    both halves are compared."""
    room = 64 - half
    lead = hi if room <= 0 else (hi << U(room)) | (lo >> U(half - room) if half > room else lo << U(room - half))
    order = np.argsort(lead, kind="stable")
    if half > room and len(order) > 1:
        s, low = lead[order], lo[order]
        if (low[1:] < low[:-1])[s[1:] == s[:-1]].any():
            return np.lexsort((lo, hi))
    return order


def _narrow(x: np.ndarray, bits: int) -> bytes:
    width = -(-bits // 8)
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _wide(raw: memoryview, n: int, bits: int) -> tuple[np.ndarray, int]:
    width = -(-bits // 8)
    out = np.zeros((n, 8), dtype=np.uint8)
    if width:
        out[:, :width] = np.frombuffer(raw, dtype=np.uint8, count=n * width).reshape(n, width)
    return out.reshape(-1).view("<u8").astype(U), n * width


@dataclass
class QuotientFilter:
    """Sorted permuted numbers ``hi, lo`` and their counts. The first ``prefix``
    bits of ``hi`` are the same for all and not stored."""
    half: int
    prefix: int
    hi: np.ndarray
    lo: np.ndarray
    count: np.ndarray

    @staticmethod
    def of(hi: np.ndarray, lo: np.ndarray, half: int) -> "QuotientFilter":
        """Count packed n-grams given as two halves."""
        hi, lo = permute(hi, lo, half)
        return _counted(half, 0, hi, lo, np.ones(len(hi), dtype=np.int64))

    @staticmethod
    def merge(parts: list["QuotientFilter"]) -> "QuotientFilter":
        hi, lo, count = (np.concatenate([getattr(p, f) for p in parts]) for f in ("hi", "lo", "count"))
        return _counted(parts[0].half, parts[0].prefix, hi, lo, count)

    def split(self, bits: int) -> list[tuple[int, "QuotientFilter"]]:
        """Cut by the next ``bits`` bits (or those there are): ``(value of the bits,
        filter)``, empty ones left out."""
        bits = min(bits, self.half - self.prefix)
        rest = U(self.half - self.prefix - bits)
        head = self.hi >> rest
        at = np.flatnonzero(np.append(True, head[1:] != head[:-1])) if len(head) else np.zeros(0, np.int64)
        out = []
        for a, b in zip(at, np.append(at[1:], len(head))):
            part = QuotientFilter(self.half, self.prefix + bits, self.hi[a:b] & ones(int(rest)), self.lo[a:b], self.count[a:b])
            out.append((int(head[a]), part))
        return out

    def at_least(self, least: int) -> "QuotientFilter":
        keep = self.count >= least
        return QuotientFilter(self.half, self.prefix, self.hi[keep], self.lo[keep], self.count[keep])

    def entries(self, block: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The packed n-grams and their counts; ``block`` is the common prefix."""
        hi = self.hi if not self.prefix else self.hi | (U(block) << U(self.half - self.prefix))
        return *restore(hi, self.lo, self.half), self.count

    def to_bytes(self) -> bytes:
        """Header, then per quotient its number of remainders in unary (two bits a
        slot), remainders, counts of a byte, and the counts that need more."""
        n, width = len(self.hi), self.half - self.prefix
        q = min(width, max(0, n.bit_length() - 1))
        rest = width - q
        quotient = (self.hi >> U(rest)).astype(np.int64)
        unary = np.zeros(n + (1 << q), dtype=np.uint8)
        unary[quotient + np.arange(n)] = 1
        large = self.count >= MANY
        head = np.array([n, q, self.half, self.prefix, int(large.sum())], dtype="<i8")
        tail = self.hi & ones(rest)
        if rest + self.half <= 64:      # both parts of the remainder in one number
            remainder = _narrow((tail << U(self.half)) | self.lo if self.half < 64 else self.lo, rest + self.half)
        else:
            remainder = _narrow(tail, rest) + _narrow(self.lo, self.half)
        return b"".join([head.tobytes(), np.packbits(unary).tobytes(), remainder, np.minimum(self.count, MANY).astype(np.uint8).tobytes(),
                         self.count[large].astype("<i8").tobytes()])

    @staticmethod
    def from_bytes(raw: bytes) -> "QuotientFilter":
        n, q, half, prefix, large = np.frombuffer(raw, dtype="<i8", count=5).tolist()
        view = memoryview(raw)[40:]
        slots = n + (1 << q)
        unary = np.unpackbits(np.frombuffer(view, dtype=np.uint8, count=-(-slots // 8)), count=slots)
        at = np.flatnonzero(unary)
        quotient = (at - np.arange(n)).astype(U)
        view = view[-(-slots // 8):]
        rest = half - prefix - q
        if rest + half <= 64:
            both, used = _wide(view, n, rest + half)
            hi, lo = (both >> U(half), both & ones(half)) if half < 64 else (np.zeros(n, dtype=U), both)
            view = view[used:]
        else:
            hi, used = _wide(view, n, rest)
            lo, more = _wide(view[used:], n, half)
            view = view[used + more:]
        count = np.frombuffer(view, dtype=np.uint8, count=n).astype(np.int64)
        count[count == MANY] = np.frombuffer(view[n:], dtype="<i8", count=large)
        return QuotientFilter(half, prefix, hi | (quotient << U(rest)) if rest < 64 else hi, lo, count)


def _counted(half: int, prefix: int, hi: np.ndarray, lo: np.ndarray, count: np.ndarray) -> QuotientFilter:
    order = sort_order(hi, lo, half)
    hi, lo, count = hi[order], lo[order], count[order]
    if not len(hi):
        return QuotientFilter(half, prefix, hi, lo, count)
    head = np.flatnonzero(np.append(True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])))
    return QuotientFilter(half, prefix, hi[head], lo[head], np.add.reduceat(count, head))
