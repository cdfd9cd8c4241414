"""Near-duplicate documents by order MinHash, verified by banded alignment.

A document is the sequence of its five-word shingles, each labelled with its occurrence. Every sketch takes the
``MINIMA`` least shingles under one hash function and keeps them in text order, so that equal sketches speak for equal
order too. Documents with a sketch in common are candidates; each is aligned with one document of its buckets, and then
all pairs of a bucket that are still in different components are, unless their lengths or the bitmaps of their
shingles prove them unlike. Equal texts count once.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.llm.decontamination import Words
from tidemark.llm.graph import joined

SHINGLE = 5
#: Sketches of a document and shingles of a sketch. Two documents at 0.8 share a sketch with probability near 0.8**3,
#: and none of 20 with probability below 1e-6.
SKETCHES, MINIMA = 20, 3
SIMILAR = 0.8
#: Bits of a text's bitmap for each of its shingles, at least; members of a bucket that meet in one task; partners that a
#: text hands on in the first round; pairs that a task holds before it keeps so many of each text.
BITS = 8
BLOCK = 1024
FIRST = 4
HELD = 1 << 18
#: Hashes of copies that are sent to all tasks (32 MB), at most.
SENT = 4 << 20
#: Text bytes whose shingles are made at a time: some hundred bytes of numbers go with each.
SHINGLED_BYTES = 1 << 18


def _shingles(words: Words, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all shingles in text order; fewer words than a shingle are one shingle."""
    at, h = words.windows(SHINGLE)
    where, hashes = [at], [h]
    counts = np.bincount(words.row, minlength=rows)
    for n in range(1, SHINGLE):
        at, h = words.windows(n)
        short = counts[words.row[at]] == n
        where.append(at[short])
        hashes.append(C.mixed(h[short] + np.uint64(n)))
    at, h = np.concatenate(where), np.concatenate(hashes)
    order = np.argsort(at, kind="stable")
    return words.row[at[order]], h[order]


def _occurrences(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """How many equal shingles of the same document come before each."""
    order = np.lexsort((h, row))
    same = np.zeros(len(h), bool)
    same[1:] = (row[order][1:] == row[order][:-1]) & (h[order][1:] == h[order][:-1])
    n = np.arange(len(h))
    start = np.maximum.accumulate(np.where(same, 0, n))
    out = np.empty(len(h), np.int64)
    out[order] = n - start
    return out


def sketches(row: np.ndarray, h: np.ndarray, rows: int) -> np.ndarray:
    """rows x SKETCHES hashes of ordered minima; rows without shingles have zeros."""
    out = np.zeros((rows, SKETCHES), np.uint64)
    if not len(h):
        return out
    labelled = C.mixed(h + _occurrences(row, h).astype(np.uint64) * np.uint64(C.WORD_BASE))
    first = np.flatnonzero(np.diff(row, prepend=-1))
    size = np.diff([*first, len(row)])
    spread = np.repeat(np.arange(len(first)), size)
    for j in range(SKETCHES):
        v = C.mixed(labelled ^ np.uint64((j + 1) * C.BYTE_BASE & C.MASK))
        place = np.full((len(first), MINIMA), len(row), np.int64)
        for k in range(MINIMA):
            low = np.minimum.reduceat(v, first)
            at = np.flatnonzero(v == low[spread])
            some = spread[at]
            alive = size[some] > k  # a document has so many minima as it has shingles, at most
            place[some[alive][::-1], k] = at[alive][::-1]
            v[at] = np.uint64(C.MASK)
        place.sort(axis=1)
        picked = np.append(labelled, np.uint64(0))[place]
        total = np.full(len(first), j + 1, np.uint64)
        for k in range(MINIMA):
            total = C.mixed(total * np.uint64(C.WORD_BASE) + picked[:, k])
        out[row[first], j] = total
    return out


def _node(text: str | None) -> bytes | None:
    return None if text is None else hashlib.md5(text.encode(), usedforsecurity=False).digest()


def _sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
    text = batch.column("text")
    words = Words(*C.flat_bytes(text))
    row, h = _shingles(words, batch.num_rows)
    found = sketches(row, h, batch.num_rows).view(np.int64)
    has = np.zeros(batch.num_rows, bool)
    has[row] = True
    offsets = np.concatenate([[0], np.cumsum(np.where(has, SKETCHES, 0))]).astype(np.int32)
    node = [_node(t) if ok else None for t, ok in zip(text.to_pylist(), has.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(node, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(found[has].ravel()))], ["doc_id", "node", "sketches"]
    )


def _once(batches):
    """Every text of a task once, with its node."""
    seen = set()
    for batch in batches:
        for part in C.slices(batch, "text", 4 << 20):
            texts = part.column("text").to_pylist()
            nodes = [_node(t) for t in texts]
            new = [i for i, n in enumerate(nodes) if n is not None and not (n in seen or seen.add(n))]
            yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in new], pa.binary()), C.strings([texts[i] for i in new])], ["node", "text"])


def aligned(a: list[int], b: list[int], least: float = SIMILAR) -> float:
    """Shingles matched in order, over all of both: m / (|a| + |b| - m); 0 if it is below ``least``.

    The longest common subsequence is found in a band: at this similarity two matched shingles can't lie further
    apart than the shingles that stay unmatched.
    """
    total = len(a) + len(b)
    need = least * total / (1 + least)
    if sum((Counter(a) & Counter(b)).values()) < need - 1e-9:
        return 0.0
    band = int(total - 2 * need) + 1
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    places: dict[int, list[int]] = {}
    for i, s in enumerate(x):
        places.setdefault(s, []).append(i)
    full = (1 << len(x)) - 1
    free = full  # bit i is 0 where the row of the alignment table steps up
    for j, s in enumerate(y):
        mask = 0
        for i in places.get(s, ()):
            if abs(i - j) <= band:
                mask |= 1 << i
        if mask:
            u = free & mask
            free = ((free + u) | (free - u)) & full
    m = head + tail + len(x) - free.bit_count()
    return m / (total - m) if m >= need - 1e-9 else 0.0


def shingles_of(text: str) -> list[int]:
    words = Words(*C.flat_bytes(C.strings([text])))
    return _shingles(words, 1)[1].tolist()


def _verify(batches):
    last, kept = None, []
    for batch in batches:
        for part in C.slices(batch, "text", 4 << 20):
            score = []
            for c, x, y in zip(part.column("centre").to_pylist(), part.column("centre_text").to_pylist(), part.column("text").to_pylist(), strict=True):
                if c != last:
                    last, kept = c, shingles_of(x)
                score.append(aligned(kept, shingles_of(y)))
            yield pa.RecordBatch.from_arrays([part.column("node"), part.column("centre"), pa.array(score, pa.float64())], ["node", "centre", "similarity"])


def _bitmap(batches):
    """Of every text its number of shingles and a bitmap of them, each with its occurrence; a power of two of bits."""
    for batch in batches:
        for part in C.slices(batch, "text", SHINGLED_BYTES):
            row, h = _shingles(Words(*C.flat_bytes(part.column("text"))), part.num_rows)
            labelled = C.mixed(h + _occurrences(row, h).astype(np.uint64) * np.uint64(C.WORD_BASE))
            size = np.bincount(row, minlength=part.num_rows)
            bits = []
            for mine in np.split(labelled, np.cumsum(size)[:-1]):
                marks = np.zeros(1 << max(9, (BITS * len(mine) - 1).bit_length()), bool)
                marks[mine & np.uint64(len(marks) - 1)] = True
                bits.append(np.packbits(marks, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(size, pa.int64()), pa.array(bits, pa.binary())], ["node", "size", "bits"])


class _Bitmaps:
    """Bitmaps of many texts; two are compared at the length of the shorter, to which the longer is folded."""

    def __init__(self, bits: list[bytes], size: np.ndarray):
        self.length, self.size, self.at = np.array([len(b) for b in bits]), size, {}
        for n in np.unique(self.length).tolist():
            own, twice = (np.flatnonzero(self.length == k) for k in (n, 2 * n))
            flat = np.frombuffer(b"".join([bits[i] for i in own]), np.uint64).reshape(len(own), -1)
            if len(twice):
                wide = np.frombuffer(b"".join([bits[i] for i in twice]), np.uint64).reshape(len(twice), 2, -1)
                flat = np.concatenate([flat, wide[:, 0] | wide[:, 1]])
            slot = np.zeros(len(bits), np.int64)
            slot[own], slot[twice] = np.arange(len(own)), len(own) + np.arange(len(twice))
            self.at[n] = slot, flat, np.bitwise_count(flat).sum(axis=1, dtype=np.int64)

    def shared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """So many shingles two texts have in common at most: a bit of one alone is a shingle that the other lacks."""
        out, short = np.zeros(len(i), np.int64), np.minimum(self.length[i], self.length[j])
        for n in np.unique(short).tolist():
            some = np.flatnonzero(short == n)
            slot, flat, ones = self.at[n]
            a, b = slot[i[some]], slot[j[some]]
            both = np.bitwise_count(flat[a] & flat[b]).sum(axis=1, dtype=np.int64)
            out[some] = np.minimum(self.size[i[some]] - ones[a], self.size[j[some]] - ones[b]) + both
        return out


def _likeliest(node: np.ndarray, x: np.ndarray, y: np.ndarray, bound: np.ndarray, many: int) -> np.ndarray:
    """Places of the pairs that are among the ``many`` likeliest of text ``x``."""
    order = np.lexsort((node[y], -bound, node[x]))
    first = np.flatnonzero(np.diff(node[x][order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(first, np.diff([*first, len(order)]))
    return order[rank < many]


def _possible(many: int):
    def run(table: pa.Table) -> pa.Table:
        """Pairs of a bucket, from two components, that their lengths and bitmaps allow to be similar, with the bound.

        A pair is listed in the first bucket that its texts share. A text hands on its ``many`` likeliest pairs; a row of
        nulls tells that there are more.
        """
        table = table.sort_by([("bucket", "ascending"), ("low", "ascending"), ("high", "ascending"), ("node", "ascending")])
        node, label = (table.column(c).combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64) for c in ("node", "label"))
        bucket, place, low, high, mine, size = (table.column(c).to_numpy() for c in ("bucket", "place", "low", "high", "mine", "size"))
        n = len(node)
        maps = _Bitmaps(table.column("bits").to_pylist(), size)
        places, buckets = (table.column(c).combine_chunks() for c in ("places", "buckets"))
        column = places.flatten().to_numpy()
        sketch = np.zeros((n, column.max(initial=0) + 1), np.int64)  # 0 where a text meets no other
        sketch[np.repeat(np.arange(n), places.value_lengths().to_numpy()), column] = buckets.flatten().to_numpy()
        earlier = np.arange(sketch.shape[1])
        x, y, bound = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        new, waiting, more = [], 0, False
        d = 1
        i = np.arange(n - 1)
        while len(i := i[i + d < n]) or new:
            j = i + d
            same = (bucket[i] == bucket[j]) & (low[i] == low[j]) & (high[i] == high[j])
            i, j = i[same], j[same]  # who has no neighbour at this distance has none farther away
            ok = (label[i] != label[j]) & ((low[i] == high[i]) | (mine[i] != mine[j])) & (np.minimum(size[i], size[j]) >= SIMILAR * np.maximum(size[i], size[j]) - 1e-9)
            for a in range(0, len(some := np.flatnonzero(ok)), 4096):
                u, v = i[some[a : a + 4096]], j[some[a : a + 4096]]
                shared, total = maps.shared(u, v), size[u] + size[v]
                near = shared >= SIMILAR * total / (1 + SIMILAR) - 1e-9
                u, v, most = u[near], v[near], (shared / total)[near]
                before = ((sketch[u] == sketch[v]) & (sketch[u] != 0) & (earlier < place[u][:, None])).any(axis=1)
                new.append((u[~before], v[~before], most[~before]))
                waiting += len(u) - int(before.sum())
            if waiting > HELD or not len(i):
                x, y, bound = (np.concatenate([a, *b]) for a, b in zip((x, y, bound), zip(*new, strict=True) if new else ((), (), ()), strict=True))
                some = _likeliest(node, x, y, bound, many)
                more |= len(some) < len(x)
                x, y, bound = x[some], y[some], bound[some]
                new, waiting = [], 0
            d += 1
        names = table.column("node").combine_chunks()
        null = [None] * more
        return pa.table(
            [pa.array(names.take(pa.array(y)).to_pylist() + null, pa.binary()), pa.array(names.take(pa.array(x)).to_pylist() + null, pa.binary()), pa.array(bound.tolist() + null, pa.float64())],
            ["node", "centre", "bound"],
        )

    return run


def _scored(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    both = pairs.select("node", "centre").join(texts, "node").join(texts.select(F.col("node").alias("centre"), F.col("text").alias("centre_text")), "centre")
    return C.stored(both.select("node", "centre", "text", "centre_text").mapInArrow(_verify, "node binary, centre binary, similarity double"), "scored")


def _links(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("similarity") >= SIMILAR).select(F.col("centre").alias("a"), F.col("node").alias("b"))


def labels(docs: DataFrame, sketched: DataFrame) -> DataFrame:
    """(node, label) of every text (by its digest) with a verified link: the least node of its component.

    First every text is aligned with the least of the least members of its buckets. Then all other pairs of a bucket that
    lie in different components and may be similar by length and bitmap are listed and aligned in rounds, of each text the
    likeliest and more of them in every round, until no pair is left out. So a pair with a sketch in common is aligned, in
    one component, or proved to be below ``SIMILAR``.
    """
    narrow = docs.select(F.col("text").cast("string").alias("text"))
    once = sketched.filter("node is not null").select("node", "sketches").dropDuplicates(["node"])
    every = C.stored(once.select("node", F.posexplode(F.array_distinct("sketches")).alias("place", "bucket")), "buckets")
    near = every.sparkSession.createDataFrame([], "node binary, label binary")
    centres = every.groupBy("bucket").agg(F.min("node").alias("centre"), F.count("*").alias("n")).filter("n > 1").select("bucket", "centre")
    # Documents that are in no bucket with another never move; later rounds stay within these buckets and texts.
    member = C.stored(every.join(centres, "bucket"), "shared")
    least = C.stored(member.groupBy("node").agg(F.min("centre").alias("centre"), F.collect_list(F.struct("place", "bucket")).alias("own")), "pairs")
    pairs = least.filter("node <> centre").select("node", "centre")
    if pairs.isEmpty():
        return near
    texts = C.stored(narrow.mapInArrow(_once, "node binary, text string").join(least.select("node"), "node", "left_semi").dropDuplicates(["node"]), "texts")
    marks = C.stored(texts.mapInArrow(_bitmap, "node binary, size long, bits binary").join(least.select("node", F.col("own.place").alias("places"), F.col("own.bucket").alias("buckets")), "node"), "marks")
    many = FIRST
    tried, left, more = pairs, pairs, True
    while True:
        new = _links(_scored(left, texts))
        if not new.isEmpty():
            near = joined(near, new)
        listed = _untried(member, near, marks, many) if more else None
        while listed is not None:
            more = not listed.filter("node is null").isEmpty()
            left = C.stored(listed.filter("node is not null").select("node", "centre").distinct().join(tried, ["node", "centre"], "left_anti"), "pairs")
            many *= FIRST
            if not left.isEmpty():
                break
            listed = _untried(member, near, marks, many) if more else None
        if listed is None:
            return near
        tried = tried.union(left)


def _untried(member: DataFrame, near: DataFrame, marks: DataFrame, many: int) -> DataFrame | None:
    """The ``many`` likeliest pairs of each text in a task: of a bucket, in two components, perhaps similar."""
    named = member.join(near, "node", "left").select("node", "bucket", "place", F.coalesce("label", "node").alias("label"))
    mixed = named.groupBy("bucket").agg(F.count("*").alias("n"), F.min("label").alias("least"), F.max("label").alias("most")).filter("least <> most")
    held = C.stored(named.join(mixed.select("bucket", F.ceil(F.col("n") / BLOCK).alias("blocks")), "bucket"), "held")
    rows = held.agg(F.sum("blocks")).first()[0]
    if not rows:
        return None
    # Members are dealt to blocks, and every block of a bucket meets every other; chunks are sets of such meetings.
    dealt = held.withColumn("mine", F.pmod(F.xxhash64("node"), "blocks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("node", "label", "bucket", "place", "mine", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"))
    dealt = dealt.join(marks, "node").withColumn("chunk", F.pmod(F.xxhash64("bucket", "low", "high"), F.lit(rows // (4 * BLOCK) + 1)))
    return C.stored(dealt.groupBy("chunk").applyInArrow(_possible(many), "node binary, centre binary, bound double"), "listed")


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, node, class_id, kept), one row for every row of ``docs``: near copies share the least doc_id as class_id.

    Near copies are texts whose five-word shingles, aligned in order, match to at least ``SIMILAR``, or a chain of such.
    Equal texts with a word in them are copies. A null text and one without words is a class of its own, with a null
    node. A null doc_id is never the least if the class has another. Rows that are equal in doc_id and text are one
    document and stay alike. Columns other than doc_id and text are not used. An empty table has no classes.
    """
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    sketched = C.stored(narrow.mapInArrow(C.over_slices(_sketch, "text", SHINGLED_BYTES), "doc_id " + dict(narrow.dtypes)["doc_id"] + ", node binary, sketches array<bigint>"), "sketches")
    label = labels(docs, sketched)
    least = sketched.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    named = least.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    group = named.groupBy("label").agg(F.min("least").alias("class_id"), F.sum("rows").alias("rows")).filter("rows > 1")
    copies = C.stored(named.join(group.select("label", "class_id"), "label").select("node", "class_id"), "classes")
    return sketched.select("doc_id", "node").join(copies, "node", "left").select(
        "doc_id", "node", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce(F.col("doc_id") == F.coalesce("class_id", "doc_id"), F.col("class_id").isNull()).alias("kept")
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents without those that a document with a lesser doc_id is a near copy of.

    Hashes of those that go are sent to all tasks if they are few enough, and then only documents with such a hash, and
    not all texts, meet them in a join.
    """
    node = F.unhex(F.md5(F.col("text").cast("string").cast("binary")))
    gone = C.stored(classes(docs).filter("not kept").select(F.col("doc_id").alias("_gone"), F.col("node").alias("_node"), F.xxhash64("doc_id", "node").alias("_hash")).distinct(), "gone")
    match = F.col("doc_id").eqNullSafe(F.col("_gone")) & (node == F.col("_node"))
    if gone.count() > SENT:
        return docs.join(gone, match, "left_anti")
    sent = F.broadcast(gone.select("_hash").distinct())
    listed = F.xxhash64("doc_id", node) == F.col("_hash")
    return docs.join(sent, listed, "left_anti").union(docs.join(sent, listed, "left_semi").join(gone, match, "left_anti"))


def digests(docs: DataFrame) -> DataFrame:
    return classes(docs).select("doc_id", "class_id", "kept")
