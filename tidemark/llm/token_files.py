"""Token ids of a corpus as packed files: encode in doc_id order, pack in patched frame-of-reference blocks, read back.

Documents are range-partitioned by doc_id once. A task encodes its documents in order and writes segments of about
``SEGMENT_IDS`` ids; a segment is one row of a Parquet folder with its documents, their lengths and the image of
packed blocks (``blocks``). Only Spark writes and reads the folder, so it may lie in any store.
"""

from __future__ import annotations

import itertools
import operator
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import blocks
from tidemark.llm import common as C

END_ID = 2
SEGMENT_IDS = 1 << 20
#: Texts between white space whose ids a worker keeps: so many new ones, and those of the generation before.
KEPT = 400_000

SEGMENTS = "part int, seq int, n_ids long, doc_ids array<bigint>, lengths array<bigint>, image binary"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Letters below U+0250 with some marks after them: one or two words to the tokenizer, whatever stands around them. İ is
#: none of them, since it becomes a letter and a mark, nor are ² or ¾, which are numbers. Lines that are no such piece give
#: two empty groups.
LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c != "İ")
PLAIN = re.compile(rf"^(?:([{LETTERS}]*)([.,;:!?%$&*#]*)|.*)$", re.MULTILINE)
#: The same in lower case, whose letters may be any.
LOWER = re.compile(r"(?:[^\W\d_]*[.,;:!?%$&*#]*\n)*")


class Encoder:
    """Ids of whole texts as the tokenizers library gives them, as little-endian bytes.

    The library drops white space and splits at it, so a text's ids are those of its pieces between ASCII white space.
    Pieces are encoded by the library once and kept; new plain words are encoded many in one call and told apart by
    their ends.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same merges over lower-case words between blanks: what the normaliser and the splitting do to plain words
        # has been done already.
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer = None
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([bool(suffix) and (self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(size)], bool)
        self.pieces: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn_words(self, words: list[str]) -> None:
        for k in range(0, len(words), 500):
            some = words[k : k + 500]
            low = " ".join(some).lower()
            ids = np.array(self.merges.encode_batch_fast([low], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids) and LOWER.fullmatch(low.replace(" ", "\n") + "\n"):
                raw, a = ids.tobytes(), 0
                for w, b in zip(some, (4 * ends).tolist(), strict=True):
                    self.words[w] = raw[a:b]
                    a = b
            else:
                self.words.update(zip(some, self._library(some), strict=True))

    def _learn(self, new: list[bytes]) -> None:
        if len(self.words) > KEPT:
            self.words.clear()
        found = PLAIN.findall(b"\n".join(new).decode())
        self._learn_words([w for w in {x for pair in found for x in pair} if w and w not in self.words])
        words = self.words
        words[""] = b""
        self.pieces.update((raw, words[a] + words[b]) for raw, (a, b) in zip(new, found, strict=True) if a or b)
        rest = [raw for raw, (a, b) in zip(new, found, strict=True) if not (a or b)]
        self.pieces.update(zip(rest, self._library([raw.decode() for raw in rest]), strict=True))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split = [t.split() for t in texts]
        pieces = list(itertools.chain.from_iterable(split))
        if len(self.pieces) > KEPT:
            self.before, self.pieces = self.pieces, {}
        ids = list(map(self.pieces.get, pieces))
        if new := dict.fromkeys(itertools.compress(pieces, map(operator.is_, ids, itertools.repeat(None)))):
            known = self.before
            self.pieces.update((p, known[p]) for p in new if p in known)
            if unknown := [p for p in new if p not in self.pieces]:
                self._learn(unknown)
            found = self.pieces
            ids = [found[p] if x is None else x for p, x in zip(pieces, ids, strict=True)]
        ends = list(itertools.accumulate(map(len, split)))
        return [b"".join(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _write(path: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        ids, doc_ids, held = [], [], 0

        def segment():
            lengths = [len(x) // 4 for x in ids]
            image = blocks.encode(np.frombuffer(b"".join(ids), "<u4"))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([sum(lengths)], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
                 pa.array([lengths], pa.list_(pa.int64())), pa.array([image], pa.binary())],
                ["part", "seq", "n_ids", "doc_ids", "lengths", "image"],
            )

        for batch in batches:
            for rows in C.slices(batch, "text"):
                flat, bounds = C.flat_bytes(rows.column("text"))
                raw = flat.tobytes()
                for d, x in zip(rows.column("doc_id").to_pylist(), encoder(path).encode([raw[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]), strict=True):
                    ids.append(x + end)
                    doc_ids.append(d)
                    held += len(x) // 4 + 1
                    if held >= SEGMENT_IDS:
                        yield segment()
                        ids, doc_ids, held, seq = [], [], 0, seq + 1
        if ids:
            yield segment()

    return run


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID, partitions: int | None = None) -> str:
    """Write the ids of all documents, each followed by ``end_id``, in ascending doc_id order; returns the folder.

    Documents with a null doc_id come first; rows of one doc_id are ordered by the hash of their text. A null text is
    empty and has the end id alone. Columns other than doc_id and text are not written. An empty table gives an
    empty folder.
    """
    spark = docs.sparkSession
    folder = folder or C.fresh_path(spark, "token-files")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    narrow.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_write(tokenizer, end_id), SEGMENTS).write.parquet(folder)
    return folder


def _read(batches):
    for batch in batches:
        for part, seq, doc_ids, lengths, image in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "doc_ids", "lengths", "image")), strict=True):
            ids = blocks.decode(image).astype("<u4")
            ends = np.cumsum(lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(doc_ids), pa.int32()), pa.array([seq] * len(doc_ids), pa.int32()), pa.array(doc_ids, pa.int64()), pa.array(ends - lengths, pa.int64()),
                 pa.array([ids[e - n : e].tobytes() for e, n in zip(ends.tolist(), lengths, strict=True)], pa.binary())],
                ["part", "seq", "doc_id", "within", "ids"],
            )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of the files: doc_id, start (ids before it) and its ids as little-endian 4-byte integers."""
    segments = spark.read.parquet(folder)
    sizes = segments.select("part", "seq", "n_ids")
    running = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    within_part = sizes.select("part", "seq", F.coalesce(F.sum("n_ids").over(running), F.lit(0)).alias("_seq"))
    # One row for each task that wrote: the window has no key, and its rows are bounded by the partitions.
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_part"))
    starts = within_part.join(parts, "part").select("part", "seq", (F.col("_seq") + F.col("_part")).alias("_start"))
    docs = segments.mapInArrow(_read, "part int, seq int, doc_id long, within long, ids binary")
    return docs.join(starts, ["part", "seq"]).select("doc_id", (F.col("_start") + F.col("within")).alias("start"), "ids")


def digests(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder).select("doc_id", "start", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
