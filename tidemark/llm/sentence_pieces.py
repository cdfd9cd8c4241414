"""Offset-preserving SentencePiece encoding and decoding.

The text is normalised by the longest prefixes of the model's compiled character map, and every normalised byte keeps
the source byte it came from. The normalised text is cut where no piece can reach across, the parts are segmented by
the library with the normaliser taken out of the model, and every piece is projected to the source bytes it covers.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common as C

BLANK = "▁"
#: Parts of texts whose pieces a worker keeps; it starts anew when full.
KEPT = 250_000
#: Text bytes encoded at a time.
ENCODED_BYTES = 1 << 18
RESULTS = T.StructType([
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("begins", T.ArrayType(T.IntegerType())),
    T.StructField("ends", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType()),
])


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _varint(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = raw[at]
        at += 1
        value |= (b & 0x7F) << shift
        shift += 7
        if b < 0x80:
            return value, at


def fields(raw: bytes):
    """(number, value, whole field) of a serialised message."""
    at = 0
    while at < len(raw):
        begin = at
        key, at = _varint(raw, at)
        if key & 7 == 0:
            value, at = _varint(raw, at)
        else:
            n, at = {1: (8, at), 5: (4, at)}.get(key & 7) or _varint(raw, at)
            value, at = raw[at : at + n], at + n
        yield key >> 3, value, raw[begin:at]


class CharMap:
    """The compiled character map: a double-array trie over UTF-8 prefixes, then the replacements."""

    def __init__(self, blob: bytes):
        n = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + n], "<u4").tolist()
        self.texts = blob[4 + n :]

    def longest(self, raw: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest known prefix of raw[at:], and the prefix's length."""
        units, best = self.units, None
        node = units[0] >> 10 << ((units[0] & 512) >> 6)
        for i in range(at, len(raw)):
            node ^= raw[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != raw[i]:
                break
            node ^= unit >> 10 << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                value = units[node] & 0x7FFFFFFF
                best = self.texts[value : self.texts.index(b"\0", value)], i + 1 - at
        return best


class Codec:
    """Encoding with source spans, and decoding, under one model."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            model = f.read()
        parts = list(fields(model))
        rules = next((dict((n, v) for n, v, _ in fields(value)) for n, value, _ in parts if n == 3), {})
        trained = next((dict((n, v) for n, v, _ in fields(value)) for n, value, _ in parts if n == 2), {})
        self.map = CharMap(rules[2]) if rules.get(2) else None
        self.dummy, self.trim, self.suffix = bool(rules.get(3, 1)), bool(rules.get(4, 1)), bool(trained.get(24, 0))
        self.escape = bool(rules.get(5, 1))
        plain = bytes([1 << 3 | 2, 8]) + b"identity" + bytes([3 << 3, 0, 4 << 3, 0, 5 << 3, 1])
        bare = b"".join(whole for n, _, whole in parts if n not in (3, 5)) + bytes([3 << 3 | 2, len(plain)]) + plain
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=bare)
        pieces = [self.segmenter.id_to_piece(i) for i in range(self.segmenter.get_piece_size())]
        size = len(pieces)
        self.byte = np.array([int(p[3:5], 16) if self.segmenter.is_byte(i) else -1 for i, p in enumerate(pieces)])
        self.width = np.array([1 if self.byte[i] >= 0 else len(p.encode()) for i, p in enumerate(pieces)], np.int64)
        self.blanks = np.array([0 if self.byte[i] >= 0 else p.count(BLANK) for i, p in enumerate(pieces)], np.int64)
        self.unknown = np.array([self.segmenter.is_unknown(i) for i in range(size)], bool)
        self.cuts = self.escape and not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in pieces)
        self.simple = self.map is None and self.dummy and not self.trim and not self.suffix and self.cuts
        self.parts: dict[str, tuple[bytes, bytes]] = {}

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised bytes and, for each and for the end, the source byte."""
        raw, out, source = text.encode(), bytearray(), []
        blank = BLANK.encode() if self.escape else b" "

        def prefix(at: int) -> tuple[bytes, int]:
            if self.map and (got := self.map.longest(raw, at)):
                return got
            n = 1 if raw[at] < 0x80 else 2 if raw[at] < 0xE0 else 3 if raw[at] < 0xF0 else 4
            return raw[at : at + n], n

        def put(x: bytes, at: int) -> None:
            out.extend(x)
            source.extend([at] * len(x))

        at = 0
        while self.trim and at < len(raw):
            x, n = prefix(at)
            if x != b" ":
                break
            at += n
        if at == len(raw):
            return b"", np.zeros(1, np.int64)
        if self.dummy and not self.suffix:
            put(blank, at)
        after_blank = self.trim
        while at < len(raw):
            x, n = prefix(at)
            if after_blank:
                x = x.lstrip(b" ")
            if x:
                put(x.replace(b" ", blank), at)
                after_blank = self.trim and x.endswith(b" ")
            at += n
        while self.trim and out.endswith(blank):
            at = source[len(out) - len(blank)]
            del out[-len(blank) :], source[-len(blank) :]
        if self.dummy and self.suffix:
            put(blank, at)
        return bytes(out), np.array([*source, at], np.int64)

    def _segment(self, parts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and normalised byte lengths of parts."""
        out = []
        for part, ids in zip(parts, self.segmenter.encode(parts, num_threads=1), strict=True):
            ids = np.array(ids, np.int64)
            if len(ids) and self.unknown[ids].any():
                width = np.array([len(p.surface.encode()) for p in self.segmenter.encode(part, return_type="proto").pieces], np.int64)
            else:
                width = self.width[ids]
            out.append((ids, width))
        return out

    def general(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, begins and ends of any text under any model."""
        norm, source = self.normalise(text)
        parts = re.findall(f"{BLANK}*[^{BLANK}]+|{BLANK}+$", norm.decode()) if self.cuts else [norm.decode()] if norm else []
        got = self._segment(parts)
        ids = np.concatenate([x for x, _ in got]) if got else np.zeros(0, np.int64)
        ends = np.cumsum(np.concatenate([w for _, w in got])) if got else np.zeros(0, np.int64)
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        return ids, source[begins], source[ends]

    def _learn(self, new: set[str]) -> None:
        """Parts that follow one blank: their ids and the source bytes of each piece, the blank included."""
        if len(self.parts) + len(new) > KEPT:
            self.parts.clear()
        parts = list(new)
        found = self.segmenter.encode([BLANK + p.replace(" ", BLANK) for p in parts], num_threads=1)
        ids = np.fromiter(itertools.chain.from_iterable(found), np.int64)
        ends = np.cumsum([len(x) for x in found]) * 4
        width = self.width[ids] - 2 * self.blanks[ids]
        value = self.byte[ids]
        if (value >= 0).any():  # the last byte of a character holds it whole
            lead = value >= 0xC0
            n = np.where(lead, 2 + (value >= 0xE0) + (value >= 0xF0), 0)
            width[lead] = 0
            for k in (2, 3, 4):
                at = np.flatnonzero(n == k)
                for j in range(1, k):
                    width[at + j] = k if j == k - 1 else 0
        if self.unknown[ids].any():
            width = np.concatenate([w for _, w in self._segment([BLANK + p.replace(" ", BLANK) for p in parts])]) - 2 * self.blanks[ids]
        ids, width, a = ids.astype("<i4").tobytes(), width.astype("<i4").tobytes(), 0
        for part, b in zip(parts, ends.tolist(), strict=True):
            self.parts[part] = ids[a:b], width[a:b]
            a = b

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        split = []
        for t in texts:
            if not self.simple or not t or BLANK in t:
                split.append(None)
                continue
            words = t.split(" ")
            split.append([w[1:] for w in re.findall(" +[^ ]*", " " + t)] if "" in words else words)
        known = self.parts
        new = {w for words in split if words for w in words if w not in known}
        if new:
            if len(known) + len(new) > KEPT:
                known.clear()
                new = {w for words in split if words for w in words}
            self._learn(new)
        out = []
        for t, words in zip(texts, split, strict=True):
            if words is None:
                out.append(self.general(t))
                continue
            got = [known[w] for w in words]
            ids = np.frombuffer(b"".join([g[0] for g in got]), "<i4")
            width = np.frombuffer(b"".join([g[1] for g in got]), "<i4")
            ends = np.cumsum(width, dtype=np.int64) - 1  # the first blank is not in the source
            out.append((ids, np.maximum(ends - width, 0), np.maximum(ends, 0)))
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1)


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays).astype(np.int32) if arrays else np.zeros(0, np.int32)))


def _encode(path: str, others: list[str]):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        got = codec(path).encode(texts)
        ids = [g[0] for g in got]
        out = {c: batch.column(c) for c in [*others, "text"]}
        out |= {"ids": _lists(ids), "begins": _lists([g[1] for g in got]), "ends": _lists([g[2] for g in got])}
        out["decoded"] = C.strings(codec(path).decode([x.tolist() for x in ids]))
        return pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return run


def encode(docs: DataFrame, model: str) -> DataFrame:
    """The documents with ``ids``, the source byte span of every piece (``begins``, ``ends``) and the ``decoded`` text.

    No begin or end ids and no sampling. The bytes of a character outside the vocabulary share it: all but the last have
    an empty span. Columns of the results' names are replaced, all others kept; repeated rows stay. A null text is
    encoded as the empty one: no ids, decoded to the empty text. Texts are encoded whole at any length.
    """
    others = [c for c in C.without(docs, RESULTS.names) if c != "text"]
    narrow = docs.select(*map(C.quoted, others), F.col("text").cast("string").alias("text"))
    return C.mapped(narrow, C.over_slices(_encode(model, others), "text", ENCODED_BYTES, lambda: codec(model).parts.clear()), T.StructType([*narrow.schema.fields, *RESULTS.fields]))


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
