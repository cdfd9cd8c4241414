"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A text is the bytes of its words, each followed by a blank, and an end. A byte is eight binary decisions; each decision
after each context of up to ``DEPTH`` bytes is a node with a Krichevsky-Trofimov estimate of its zeros and ones, and a
node's weighted probability is half its own estimate and half the product of its children's. The counts of all training
texts are gathered as strings of ``DEPTH`` + 1 bytes, the tree is built level by level from the deepest (aggregates) and
mixed level by level from the root (joins). The strings of all texts to be scored take part with what counts they have,
so every string ends in a code length of its last byte. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C

DEPTH = 5
END = b"\n"
#: Entries that a task gathers before it hands them on.
GATHERED = 1 << 20
#: Entries of either kind (at 12 bytes) that are sent to every task; beyond, chunks of texts get their own by joins.
SENT = 6 << 20
CHUNK_BYTES = 16 << 20
GRAM, WORD = 0, 1


class Streams:
    """Texts of a slice as streams: the last byte's string for every byte, and the hash of every word."""

    def __init__(self, texts: list[str | None]):
        split = [(t or "").encode().lower().split() for t in texts]
        pad = END * DEPTH
        parts = [pad + (b" ".join(w) + b" " if w else b"") + END for w in split]
        self.words = np.array([len(w) for w in split], np.int64)
        flat = np.frombuffer(b"".join(parts), np.uint8)
        size = np.array([len(p) for p in parts], np.int64)
        first = np.cumsum(size) - size
        self.bytes = size - DEPTH
        wide = flat.astype(np.uint64)
        key = np.zeros(max(len(flat) - DEPTH, 0), np.uint64)
        for k in range(DEPTH + 1):
            key = key << np.uint64(8) | wide[k : k + len(key)]
        row = np.repeat(np.arange(len(parts)), self.bytes)
        self.grams = key[first[row] + np.arange(len(row)) - np.repeat(np.cumsum(self.bytes) - self.bytes, self.bytes)]
        end = np.flatnonzero(flat == 0x20)
        begin = np.empty_like(end)
        begin[1:] = end[:-1] + 1
        firsts = np.cumsum(self.words) - self.words
        begin[firsts[self.words > 0]] = (first + DEPTH)[self.words > 0]
        self.hashes = C.stretch_hash(C.prefix_hash(flat), begin, end)


def _summed(keys: np.ndarray, n: np.ndarray, held: np.ndarray):
    keys, at = np.unique(keys, return_inverse=True)
    return keys, np.bincount(at, n, len(keys)).astype(np.int64), np.bincount(at, held, len(keys)) > 0


def _gather(batches):
    """(kind, key, n, held): strings and words with their counts in training texts, and whether a text held out has them."""
    waiting = {GRAM: [], WORD: []}

    def merged(kind):
        return _summed(*(np.concatenate(x) for x in zip(*waiting[kind], strict=True)))

    def out(kind, keys, n, held):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)), pa.array(n, pa.int64()), pa.array(held)], ["kind", "key", "n", "held"])

    for batch in batches:
        for part in C.slices(batch, "text"):
            trains = np.array(part.column("train").to_pylist(), bool)
            texts = part.column("text").to_pylist()
            for train in (True, False):
                s = Streams([t for t, ok in zip(texts, trains.tolist(), strict=True) if ok == train])
                for kind, found in ((GRAM, s.grams), (WORD, s.hashes)):
                    keys, n = np.unique(found, return_counts=True)
                    waiting[kind].append((keys, n * train, np.full(len(keys), not train)))
            for kind, got in waiting.items():
                if sum(len(k) for k, _, _ in got) > 2 * GATHERED:
                    keys, n, held = merged(kind)
                    waiting[kind] = [(keys, n, held)]
                    if len(keys) > GATHERED:
                        yield out(kind, keys, n, held)
                        waiting[kind] = []
    for kind, got in waiting.items():
        if got:
            yield out(kind, *merged(kind))


def _log_gamma(x: Column) -> Column:
    """Natural logarithm of the gamma function for x >= 0.5: Stirling's series at x + 7."""
    z = x + 7
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    below = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(below)


def _estimate() -> Column:
    """Logarithm of the Krichevsky-Trofimov probability of a zeros and b ones."""
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    return F.when(F.col("a") + F.col("b") == 0, 0.0).otherwise(_log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1) - math.log(math.pi))


def code_lengths(strings: DataFrame) -> DataFrame:
    """(key, log_p): the decimal logarithm of the last byte's probability after the bytes before it, for each string.

    ``strings`` has key (``DEPTH`` + 1 bytes, the last one lowest) and n, its count in training, which may be 0.
    """
    steps = F.explode(F.sequence(F.lit(0), F.lit(7)))

    # The string without its last byte, then a one and the bits of that byte before decision k.
    node = F.expr("(key & ~255) + shiftleft(1, k) + shiftright(key & 255, 8 - k)")
    bits = strings.select("key", "n", steps.alias("k")).select("key", "n", node.alias("node"), (F.expr("shiftright(key & 255, 7 - k) & 1") == 1).alias("one"))
    none = F.lit(0).cast("long")
    deepest = bits.groupBy("node").agg(F.sum(F.when(F.col("one"), none).otherwise(F.col("n"))).alias("a"), F.sum(F.when(F.col("one"), F.col("n")).otherwise(none)).alias("b"))
    levels = [C.stored(deepest.withColumn("w", _estimate()), "tree")]
    for d in range(DEPTH - 1, -1, -1):
        parent = F.col("node").bitwiseAND((1 << (8 * d + 8)) - 1)
        up = levels[-1].groupBy(parent.alias("node")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("w").alias("below")).withColumn("own", _estimate())
        top = F.greatest("own", "below")
        mixed = math.log(0.5) + top + F.log(F.exp(F.col("own") - top) + F.exp(F.col("below") - top))
        levels.append(C.stored(up.withColumn("w", mixed).withColumn("stop", F.exp(F.col("own") + math.log(0.5) - F.col("w"))).select("node", "a", "b", "w", "stop"), "tree"))
    kt = (F.col("b") + 0.5) / (F.col("a") + F.col("b") + 1.0)
    root = levels.pop()
    mix = root.select(F.col("node").alias("parent"), (F.col("stop") * kt).alias("p"), (1 - F.col("stop")).alias("rest"))
    for d in range(1, DEPTH + 1):
        level = levels.pop().withColumn("parent", F.col("node").bitwiseAND((1 << (8 * d)) - 1))
        stop = F.col("stop") if d < DEPTH else F.lit(1.0)
        mix = level.join(mix, "parent").select(F.col("node").alias("parent"), (F.col("p") + F.col("rest") * stop * kt).alias("p"), (F.col("rest") * (1 - stop)).alias("rest"))
        if d < DEPTH:
            mix = C.stored(mix, "mixture")
    p = F.when(F.col("one"), F.col("p")).otherwise(1 - F.col("p"))
    return bits.join(mix.select(F.col("parent").alias("node"), "p"), "node").groupBy("key").agg(F.sum(F.log10(p)).alias("log_p"))


def _table(df: DataFrame, value: str, kind) -> tuple[np.ndarray, np.ndarray]:
    got = df.toArrow()
    keys = got.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], got.column(value).to_numpy().astype(kind)[order]


def _found(table, needles: np.ndarray, missing) -> np.ndarray:
    keys, values = table
    if not len(keys):
        return np.full(len(needles), missing, values.dtype)
    some, at = np.unique(needles, return_inverse=True)
    place = np.minimum(np.searchsorted(keys, some), len(keys) - 1)
    return np.where(keys[place] == some, values[place], missing)[at]


def _scored(texts: list, train: np.ndarray, grams, words, tokens: int, kinds: int):
    s = Streams(texts)
    firsts = np.cumsum(s.bytes) - s.bytes
    log_p = _found(grams, s.grams, 0.0).astype(np.float64)
    score = np.add.reduceat(log_p, firsts) if len(texts) else np.zeros(0)
    row = np.repeat(np.arange(len(texts)), s.words)
    # A word of a training text that is not in the table occurs there alone.
    c = np.maximum(_found(words[:2], s.hashes, 0), train[row].astype(np.int32))
    base = np.bincount(row, np.log10((c + 1) / (tokens + kinds + 1)), len(texts)).astype(np.float64)
    ends = int(words[2])
    base += math.log10((ends + 1) / (tokens + kinds + 1))
    known = np.bincount(row, c > 0, len(texts)).astype(np.int64) + (ends > 0)
    return s.words + 1, known, base, score


SCORES = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]


def _rows(batch, texts, found, tokens: int) -> pa.RecordBatch:
    n, known, base, score = found
    size = np.array([max(1, len((t or "").encode())) for t in texts])
    cols = {c: batch.column(c) for c in batch.schema.names if c not in ("text", "chunk")}
    cols |= {"n_tokens": pa.array(n, pa.int64()), "n_known": pa.array(known, pa.int64()), "train_tokens": pa.array(np.full(len(n), tokens), pa.int64()), "base_score": pa.array(base), "score": pa.array(score),
             "bits_per_byte": pa.array(-score / math.log10(2) / size)}
    return pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def score(docs: DataFrame, train: Column, sent: int = SENT) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every document.

    Learns from the rows where ``train`` holds, scores all. A null text is empty: its stream is the end alone. White
    space other than one blank between words isn't scored, and A-Z count as a-z. Repeated rows are texts of their own. If
    nothing is learned from, every decision has probability 1/2. Columns other than doc_id and text are not used.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    counts = narrow.select("text", "train").mapInArrow(_gather, "kind int, key long, n long, held boolean").groupBy("kind", "key").agg(F.sum("n").alias("n"), F.bool_or("held").alias("held"))
    counts = C.stored(counts, "counts")
    grams, words = counts.filter(F.col("kind") == GRAM).select("key", "n"), counts.filter(F.col("kind") == WORD)
    learned = narrow.filter("train").count()
    sums = words.filter("n > 0").agg(F.sum("n"), F.count("*")).first()
    tokens, kinds = (sums[0] or 0) + learned, sums[1] + (learned > 0)
    lengths = C.stored(code_lengths(grams), "lengths")
    known = words.filter("n > 1 or (n = 1 and held)").select("key", "n")
    schema = f"doc_id {kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    if max(lengths.count(), known.count()) <= sent:
        tables = spark.sparkContext.broadcast((_table(lengths, "log_p", np.float64), (*_table(known, "n", np.int32), learned)))

        def run(batch):
            texts = batch.column("text").to_pylist()
            return _rows(batch, texts, _scored(texts, np.array(batch.column("train").to_pylist(), bool), *tables.value, tokens, kinds), tokens)

        return narrow.mapInArrow(C.over_slices(run, "text"), schema)

    # Texts in chunks of bounded size: a chunk names its strings and words, gets their figures by joins, and is scored.
    total = narrow.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    chunked = narrow.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(total // CHUNK_BYTES + 1)))

    def wanted(table):
        s = Streams(table.column("text").to_pylist())
        keys = [np.unique(s.grams), np.unique(s.hashes)]
        return pa.table([pa.array(np.full(sum(map(len, keys)), table.column("chunk")[0].as_py()), pa.int64()), pa.array(np.repeat(np.array([GRAM, WORD], np.int32), [len(k) for k in keys])), pa.array(np.concatenate(keys).view(np.int64))],
                        ["chunk", "kind", "key"])

    figures = lengths.select(F.lit(GRAM).alias("kind"), "key", F.col("log_p").alias("figure")).union(known.select(F.lit(WORD), "key", F.col("n").cast("double")))
    asked = chunked.select("chunk", "text").groupBy("chunk").applyInArrow(wanted, "chunk long, kind int, key long").join(figures, ["kind", "key"])

    def cogroup(left, right):
        tables = []
        for k, dtype in ((GRAM, np.float64), (WORD, np.int64)):
            own = right.filter(pa.array(right.column("kind").to_numpy() == k))
            keys = own.column("key").to_numpy().view(np.uint64)
            order = np.argsort(keys)
            tables.append((keys[order], own.column("figure").to_numpy()[order].astype(dtype)))
        batches = [_rows(b, (t := b.column("text").to_pylist()), _scored(t, np.array(b.column("train").to_pylist(), bool), tables[0], (*tables[1], learned), tokens, kinds), tokens) for x in left.combine_chunks().to_batches() for b in C.slices(x, "text")]
        return pa.Table.from_batches(batches)

    return chunked.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(cogroup, schema)


def digests(docs: DataFrame, modulus: int = 7, remainder: int = 2) -> DataFrame:
    from tidemark.llm.language_id import held_out

    held = held_out("doc_id", modulus, remainder)
    return score(docs, ~held).select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
