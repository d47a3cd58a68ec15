"""SentencePiece encoding and decoding on the tokenizers library.

The model file (a protobuf) is parsed and rebuilt: normaliser, white-space
marker, merges or unigram scores, byte fallback. Batches are encoded by the
library's own threads, and the result is verified against SentencePiece itself.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import with_results

MODEL = "piece_bpe_32k.model"   # a file, or a name that public_tokenizers knows
MARK = "▁"                      # stands for a blank
THREADS = 2
CACHE = 300_000               # units remembered by a worker
FIELDS = "n_ids long, ids_crc32 long, roundtrip boolean, parity boolean"

NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

_loaded: dict[str, "PieceCodec"] = {}


def read_model(blob: bytes):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(blob)
    return proto


def bpe_merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """All ways to put a piece together from two pieces, best piece first."""
    known = {p: s for p, s, kind in pieces if kind in (NORMAL, USER, UNUSED)}
    order = sorted((-s, i, p) for i, (p, s, kind) in enumerate(pieces) if kind == NORMAL and len(p) > 1)
    return [(p[:k], p[k:]) for _, _, p in order for k in range(1, len(p)) if p[:k] in known and p[k:] in known]


class _Codes(dict):
    """Unit -> running number; units asked for the first time are listed."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        code = self[unit] = len(self)
        self.new.append(unit)
        return code


def flat_ids(encoded: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after the other, and their number per text."""
    n = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
    return np.fromiter(itertools.chain.from_iterable(encoded), dtype=np.int32, count=int(n.sum())), n


def equal_parts(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Whether the i-th part of ``a`` (``na[i]`` numbers) equals that of ``b``."""
    if (na == nb).all():
        row = np.repeat(np.arange(len(na)), na)
        return np.bincount(row[a != b], minlength=len(na)) == 0
    ea, eb = np.cumsum(na), np.cumsum(nb)
    return np.array([x == y and np.array_equal(a[i - x:i], b[j - y:j]) for x, i, y, j in zip(na, ea, nb, eb)], dtype=bool)


class PieceCodec:
    """A SentencePiece model rebuilt for the tokenizers library.

    A text is normalised, marked and split into units: runs of marks with what
    follows. No piece of such a model crosses into the next unit (checked), so a
    unit's ids do not depend on its text, and each distinct unit is encoded and
    decoded once per worker."""

    def __init__(self, blob: bytes):
        import sentencepiece
        from tokenizers import Tokenizer, decoders, models, normalizers

        proto = read_model(blob)
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=blob)
        spec, train = proto.normalizer_spec, proto.trainer_spec
        pieces = [(p.piece, p.score, p.type) for p in proto.pieces]
        unk = next(i for i, p in enumerate(pieces) if p[2] == UNKNOWN)
        vocab = {p: i for i, (p, _, _) in enumerate(pieces)}
        if train.model_type == 2:
            model = models.BPE(vocab=vocab, merges=bpe_merges(pieces), unk_token=pieces[unk][0], fuse_unk=True,
                               byte_fallback=train.byte_fallback)
        elif train.model_type == 1:
            model = models.Unigram([(p, s) for p, s, _ in pieces], unk_id=unk, byte_fallback=train.byte_fallback)
        else:
            raise ValueError("only BPE and unigram models are supported")
        if any(kind == USER for _, _, kind in pieces) or not spec.escape_whitespaces or train.treat_whitespace_as_suffix:
            raise ValueError("user-defined pieces, suffix marks and unmarked blanks are not supported")
        if any(MARK in p.lstrip(MARK) for p, _, kind in pieces if kind in (NORMAL, UNUSED)):
            raise ValueError("a piece runs over a blank; units would not be independent")
        self.tok = Tokenizer(model)
        self.tok.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
        self.charsmap = normalizers.Precompiled(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.squeeze, self.prefix = spec.remove_extra_whitespaces, spec.add_dummy_prefix
        surface = []
        for p, _, kind in pieces:
            if kind == BYTE:
                surface.append(bytes([int(p[3:5], 16)]))
            else:
                surface.append(b"" if kind == CONTROL else p.replace(MARK, " ").encode())
        surface[unk] = " ⁇ ".encode()
        size = np.fromiter(map(len, surface), dtype=np.int64, count=len(surface))
        self.surface = np.frombuffer(b"".join(surface), dtype=np.uint8)
        self.surface_size, self.surface_at = size, np.cumsum(size) - size
        self._forget()

    def _forget(self) -> None:
        self.codes = _Codes()
        self.table = np.zeros(0, dtype=np.int32)   # ids of all known units
        self.first = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.back = np.zeros(0, dtype=bool)        # does decoding give the unit again

    def normalise(self, t: str) -> str:
        if self.charsmap is not None:
            t = self.charsmap.normalize_str(t)
        if self.squeeze:
            t = re.sub(" +", " ", t).strip(" ")
        return t.replace(MARK, " ")

    def units(self, normal: str) -> list[str]:
        if not normal:
            return []
        return UNIT.findall((MARK if self.prefix else "") + normal.replace(" ", MARK))

    def _learn(self) -> None:
        """Encode the new units in one multithreaded batch and decode them again."""
        new, self.codes.new = self.codes.new, []
        if not new:
            return
        ids, n = flat_ids([e.ids for e in self.tok.encode_batch_fast(new, add_special_tokens=False)])
        body, cut = self._surfaces(ids, n)
        back = [body[x:y] == u.replace(MARK, " ").encode() for u, x, y in zip(new, cut[:-1].tolist(), cut[1:].tolist())]
        self.first = np.concatenate([self.first, len(self.table) + np.cumsum(n) - n])
        self.size = np.concatenate([self.size, n])
        self.table = np.concatenate([self.table, ids])
        self.back = np.concatenate([self.back, np.array(back, dtype=bool)])

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, their number and, per text, whether
        decoding gives the normalised text again."""
        if len(self.codes) > CACHE:
            self._forget()
        every: list[str] = []
        count = np.zeros(len(texts), dtype=np.int64)
        for i, t in enumerate(texts):
            if t:
                u = self.units(self.normalise(t))
                every += u
                count[i] = len(u)
        code = np.fromiter(map(self.codes.__getitem__, every), dtype=np.int64, count=len(every))
        self._learn()
        length = self.size[code]
        at = np.cumsum(length) - length
        ids = self.table[np.arange(int(length.sum())) + np.repeat(self.first[code] - at, length)]
        doc = np.repeat(np.arange(len(texts)), count)
        n = np.bincount(doc, weights=length, minlength=len(texts)).astype(np.int64)
        return ids, n, np.bincount(doc[~self.back[code]], minlength=len(texts)) == 0

    def parity(self, texts: list, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether SentencePiece gives the same ids for each text as a whole."""
        return equal_parts(ids, n, *flat_ids(self.sp.encode([t or "" for t in texts], num_threads=THREADS)))

    def _surfaces(self, ids: np.ndarray, n: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of id sequences that lie one after the other, and where each begins."""
        length = self.surface_size[ids]
        at = np.cumsum(length) - length
        body = self.surface[np.arange(int(length.sum())) + np.repeat(self.surface_at[ids] - at, length)].tobytes()
        return body, np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], np.cumsum(n)])]

    def decode(self, ids: np.ndarray, n: np.ndarray) -> list[str]:
        """Texts of id sequences that lie one after the other."""
        body, cut = self._surfaces(ids, n)
        out = [body[x:y].decode("utf-8", "replace") for x, y in zip(cut[:-1], cut[1:])]
        return [t[1:] if self.prefix and t.startswith(" ") else t for t in out]


def codec(model: str) -> PieceCodec:
    if model not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        path = model
        if not os.path.exists(path):
            import public_tokenizers
            path = public_tokenizers.path(model)
        with open(path, "rb") as f:
            _loaded[model] = PieceCodec(f.read())
    return _loaded[model]


def _report(model: str):
    def run(texts: list) -> dict:
        c = codec(model)
        # each distinct text of the batch once
        at, distinct = pd.factorize(np.array([*(t or "" for t in texts), None], dtype=object)[:-1])
        distinct = list(distinct)
        ids, n, back = c.encode(distinct)
        same = c.parity(distinct, ids, n)
        raw, end = ids.astype("<u4").tobytes(), np.cumsum(n)
        crc = np.array([zlib.crc32(raw[4 * (e - m):4 * e]) for e, m in zip(end.tolist(), n.tolist())], dtype=np.int64)
        return {"n_ids": n[at], "ids_crc32": crc[at], "roundtrip": back[at], "parity": same[at]}
    return run


def piece_report(df: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """One row per input row: ``key, n_ids, ids_crc32, roundtrip, parity``.

    ``ids_crc32`` is the CRC of the ids as little-endian unsigned 32-bit numbers.
    ``roundtrip``: decoding the ids gives the normalised text, unit by unit.
    ``parity``: SentencePiece gives the same ids for the text as a whole, checked
    for every text.

    Null or empty text has no ids and passes both; each row stands alone, so
    repeated rows each get a row; an empty table gives none; other columns are
    ignored.
    """
    got, names = with_results(df.select(F.col(key).alias("__key"), F.col(text).alias("__text")), "__text",
                              _report(model), FIELDS)
    return got.select(F.col("__key").alias(key), *[F.col(names[c]).alias(c) for c in names])


def encode_texts(df: DataFrame, text: str = "text", model: str = MODEL) -> tuple[DataFrame, dict[str, str]]:
    """All columns of ``df`` and ``ids`` (array of int; empty for null)."""
    def run(texts: list) -> dict:
        ids, n, _ = codec(model).encode(texts)
        return {"ids": [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] if len(texts) else []}
    return with_results(df, text, run, "ids array<int>")


def decode_ids(df: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """``df`` with column ``ids`` replaced by its text, in the same place and name."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def back(col: pd.Series) -> pd.Series:
        rows = [np.asarray(x if x is not None else [], dtype=np.int64) for x in col]
        n = np.array([len(x) for x in rows], dtype=np.int64)
        return pd.Series(codec(model).decode(np.concatenate([np.zeros(0, np.int64), *rows]), n))
    return df.withColumn(ids, back(F.col(ids)))
