"""Benchmark decontamination: windows of benchmark words are looked up in the words of every document.

The benchmark is cut into blocks of at most ``BLOCK_BYTES`` of words. One block at a time is broadcast as sorted
window hashes with the words behind them, so what a task holds does not grow with the benchmark. A task takes the words
of its documents as arrays, hashes every window, and compares the words of each window whose hash is known.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common as C

WINDOW = 10
#: Bytes of item words that are broadcast at a time, and the words of one piece of an item.
BLOCK_BYTES = 4 << 20
PIECE_WORDS = 50_000
#: Text bytes looked up at a time: some ten numbers go with each word.
SCANNED_BYTES = 1 << 18

SPANS = T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())]))
RESULTS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("hit_items", T.ArrayType(T.StringType())), T.StructField("hit_spans", SPANS),
])


def _letters() -> np.ndarray:
    """Word bytes in lower case, 0 for all others: digits, ASCII letters, and every byte of a non-ASCII character."""
    t = np.zeros(256, np.uint8)
    keep = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
    t[keep] = keep
    t[0x41:0x5B] = np.arange(0x61, 0x7B)
    return t


LETTERS = _letters()


class Words:
    """The words of a slice of documents: where they begin and end, whose they are, and their hashes."""

    def __init__(self, flat: np.ndarray, bounds: np.ndarray):
        self.low = LETTERS[flat]
        inside = self.low != 0
        before = np.zeros(len(flat), bool)
        before[1:] = inside[:-1]
        firsts = bounds[:-1][bounds[:-1] < len(flat)]
        before[firsts] = False
        self.begin = np.flatnonzero(inside & ~before)
        after = np.zeros(len(flat), bool)
        after[:-1] = inside[1:]
        lasts = bounds[1:] - 1
        after[lasts[lasts >= 0]] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.row = np.searchsorted(bounds, self.begin, side="right") - 1
        self.hash = C.stretch_hash(C.prefix_hash(self.low), self.begin, self.end)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all runs of n words that stay within a document."""
        m = len(self.hash) - n + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        up, _ = C.powers(n, C.WORD_BASE)
        total = np.zeros(m, np.uint64)
        for k in range(n):
            total += self.hash[k : k + m] * up[k]
        at = np.flatnonzero(self.row[:m] == self.row[n - 1 :])
        return at, total[at]

    def text(self, first: int, n: int) -> bytes:
        return b" ".join(self.low[a:b].tobytes() for a, b in zip(self.begin[first : first + n], self.end[first : first + n], strict=True))


class Block:
    """Window hashes of some benchmark items, by window length, and the words behind each."""

    def __init__(self, items: list[tuple[str, str, int]]):
        """items: (name, words joined by blanks, window length)."""
        self.names = [name for name, _, _ in items]
        flat, bounds = C.flat_bytes(pa.array([words for _, words, _ in items], pa.string()))
        self.words = Words(flat, bounds)
        length = np.array([n for _, _, n in items], np.int64)
        self.tables = {}
        for n in sorted(set(length.tolist())):
            at, h = self.words.windows(n)
            mine = length[self.words.row[at]] == n
            at, h = at[mine], h[mine]
            order = np.argsort(h, kind="stable")
            known = np.zeros(1 << 20, bool)
            known[(h >> np.uint64(44)).astype(np.int64)] = True
            self.tables[n] = (h[order], at[order], known)

    def hits(self, words: Words):
        """(first word, number of words, item name) of every verified occurrence."""
        for n, (known_hash, known_at, known) in self.tables.items():
            at, h = words.windows(n)
            maybe = known[(h >> np.uint64(44)).astype(np.int64)]
            at, h = at[maybe], h[maybe]
            left, right = np.searchsorted(known_hash, h, "left"), np.searchsorted(known_hash, h, "right")
            found = np.flatnonzero(right > left)
            for i in found.tolist():
                text = words.text(int(at[i]), n)
                for k in range(int(left[i]), int(right[i])):
                    w = int(known_at[k])
                    if self.words.text(w, n) == text:
                        yield int(at[i]), n, self.names[self.words.row[w]]


def _cut_items(batches):
    for batch in batches:
        out = []
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            flat, bounds = C.flat_bytes(pa.array([text.as_py()], pa.string()))
            words = Words(flat, bounds)
            n = len(words.begin)
            length = min(n, WINDOW)
            for a in range(0, max(0, n - length) + (n > 0), PIECE_WORDS):
                out.append((name, words.text(a, min(PIECE_WORDS + length - 1, n - a)).decode(), length))
        yield pa.RecordBatch.from_arrays(
            [C.strings([x[0] for x in out]), C.strings([x[1] for x in out]), pa.array([x[2] for x in out], pa.int32())], ["item", "words", "n"]
        )


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES):
    """The benchmark as blocks of bounded size, one at a time on the driver."""
    spark = benchmark.sparkSession
    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.col("text").cast("string").alias("text"))
    pieces = C.stored(named.mapInArrow(_cut_items, "item string, words string, n int").distinct(), "benchmark-items")
    total = pieces.agg(F.sum(F.octet_length("words") + 16)).first()[0] or 0
    n = -(-total // block_bytes) or 1
    block = F.pmod(F.xxhash64("item", "words"), F.lit(n))
    for k in range(n):
        rows = pieces.filter(block == k).collect()
        yield spark.sparkContext.broadcast(Block(sorted((r.item, r.words, r.n) for r in rows)))


def _scan(block, others: list[str], cleaned: bool):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = batch.column("text")
        flat, bounds = C.flat_bytes(text)
        words = Words(flat, bounds)
        rows = batch.num_rows
        names: list[set] = [set(x) for x in batch.column("hit_items").to_pylist()]
        edge = np.zeros(len(words.begin) + 1, np.int32)
        for i, spans in enumerate(batch.column("hit_spans").to_pylist()):  # what earlier blocks found
            for s in spans:
                edge[np.searchsorted(words.begin, bounds[i] + s["begin"])] += 1
                edge[np.searchsorted(words.begin, bounds[i] + s["end"])] -= 1
        for first, n, name in block.value.hits(words):
            edge[first] += 1
            edge[first + n] -= 1
            names[words.row[first]].add(name)
        hit = np.cumsum(edge[:-1]) > 0
        n_words = np.bincount(words.row, minlength=rows)
        n_hit = np.bincount(words.row[hit], minlength=rows)
        # Runs of hit words within a document become byte spans.
        begins = hit.copy()
        begins[1:] &= ~(hit[:-1] & (words.row[1:] == words.row[:-1]))
        ends = hit.copy()
        ends[:-1] &= ~(hit[1:] & (words.row[1:] == words.row[:-1]))
        a, b, row = words.begin[begins], words.end[ends], words.row[begins]
        spans = [[] for _ in range(rows)]
        for i, x, y in zip(row.tolist(), a.tolist(), b.tolist(), strict=True):
            spans[i].append({"begin": x - int(bounds[i]), "end": y - int(bounds[i])})
        out = {c: batch.column(c) for c in others}
        out["text"] = text
        if cleaned:
            clean = text.to_pylist()
            for i in {*row.tolist()}:
                raw, at, parts = clean[i].encode(), 0, []
                for s in spans[i]:
                    parts.append(raw[at : s["begin"]])
                    at = s["end"]
                clean[i] = b"".join([*parts, raw[at:]]).decode()
            out["clean_text"] = C.strings(clean)
        out |= {
            "n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(n_hit, pa.int64()),
            "hit_items": pa.array([sorted(x) for x in names], pa.list_(pa.string())),
            "hit_spans": pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
        }
        return pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, cleaned: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every document with its words that lie in a benchmark window.

    A window is ``WINDOW`` consecutive words of an item, or all words of a shorter item. Adds ``n_words``, ``n_hit``,
    ``hit_items`` (sorted item names), ``hit_spans`` (byte offsets of the maximal runs of hit words) and, if
    ``cleaned``, ``clean_text`` without those spans. Columns of these names are replaced, all others kept; repeated
    rows stay. A null text has no words and a null ``clean_text``; an item without words has no window; a null
    ``item_id`` is named ``null``; an empty benchmark hits nothing.
    """
    results = [*RESULTS.names, *(["clean_text"] if cleaned else [])]
    others = [c for c in C.without(docs, results) if c != "text"]
    found = docs.select(
        *map(C.quoted, others), F.col("text").cast("string").alias("text"),
        F.array().cast("array<string>").alias("hit_items"), F.array().cast(SPANS).alias("hit_spans"),
    )
    schema = T.StructType([*found.drop("hit_items", "hit_spans").schema.fields, *([T.StructField("clean_text", T.StringType())] if cleaned else []), *RESULTS.fields])
    for k, block in enumerate(item_blocks(benchmark, block_bytes)):
        if k:
            found = C.stored(found, "decontaminated")
        found = C.mapped(found, C.over_slices(_scan(block, others, cleaned), "text", SCANNED_BYTES), schema)
    return found


def digests(found: DataFrame) -> DataFrame:
    """What is compared of the operator's result."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def remove_hits(docs: DataFrame, benchmark: DataFrame, most: float = 0.5) -> DataFrame:
    """Documents without benchmark passages: hit spans are cut out, and documents with more than ``most`` of their words hit go."""
    found = decontaminate(docs, benchmark)
    kept = found.filter(~(F.col("n_hit") > F.col("n_words") * F.lit(most)))
    return kept.select(*[F.col("clean_text").alias("text") if c == "text" else F.col(C.quoted(c)) for c in docs.columns if c not in RESULTS.names])
