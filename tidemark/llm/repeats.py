"""Removal of long repeated byte strings by the order of their fixed-length strings.

A string of ``LENGTH`` bytes that occurs twice has the same anchors in both places: the least hash of a ``GRAM``-byte
string within it. Anchors whose gram occurs once in the corpus are dropped; the bytes around the others (all that a
string holding the anchor can reach) are compared by hash, and where they differ within one gram the bytes before and
those from the anchor are put in suffix order. Strings of ``LENGTH`` bytes are equal if both of their parts are, which
the bytes that neighbours in either order share tell for every offset to the anchor. Longest-previous-factor arrays would tell more than is asked: that a
factor has at least ``LENGTH`` bytes is the equality of strings of that length, so they are not computed.
Grams with more than ``CROWD`` different surroundings are decided by counting the hashes of their strings instead, which
spreads them over all tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common as C

LENGTH = 200
GRAM = 100
REACH = LENGTH - GRAM
#: Surroundings of one gram that a task puts in suffix order, and the bytes it puts in order at a time.
CROWD = 8000
SORTED_BYTES = 1 << 19
#: Repeated grams that are sent to all tasks (32 MB) to drop others early; more of them are joined instead.
SENT = 4 << 20

#: Text bytes whose grams are made at a time: some hundred bytes of numbers go with each.
HASHED_BYTES = 1 << 18

SPAN = "array<struct<begin:int,end:int>>"
SPAN_ARROW = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))


def _sliding(op, v: np.ndarray, w: int, fill) -> np.ndarray:
    """op over every run of w neighbours (van Herk's two passes); len(v) - w + 1 values."""
    n = -(-len(v) // w) * w
    padded = np.full(n, fill, v.dtype)
    padded[: len(v)] = v
    blocks = padded.reshape(-1, w)
    after = op.accumulate(blocks, axis=1).ravel()
    before = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    m = len(v) - w + 1
    return op(before[:m], after[w - 1 : w - 1 + m])


class Anchors:
    """Selected grams of a slice of texts: row, place in the text, gram hash, hash of the surroundings."""

    def __init__(self, flat: np.ndarray, bounds: np.ndarray):
        prefix = C.prefix_hash(flat)
        n = len(flat) - GRAM + 1
        self.row = self.pos = np.zeros(0, np.int64)
        self.gram = self.around = np.zeros(0, np.uint64)
        w = REACH + 1
        if n < w:
            return
        end = np.repeat(bounds[1:], np.diff(bounds))
        _, down = C.powers(len(prefix))
        v = C.mixed((prefix[GRAM:] - prefix[:-GRAM]) * down[:n])
        left = end - np.arange(len(flat))
        v[left[:n] < GRAM] = np.uint64(C.MASK)
        low = _sliding(np.minimum, v, w, np.uint64(C.MASK))
        low[left[: len(low)] < LENGTH] = 0
        padded = np.zeros(n + w - 1, np.uint64)
        padded[w - 1 : w - 1 + len(low)] = low
        sel = np.flatnonzero((v == _sliding(np.maximum, padded, w, np.uint64(0))) & (v != np.uint64(C.MASK)))
        self.row = np.searchsorted(bounds, sel, side="right") - 1
        self.pos = sel - bounds[self.row]
        self.gram = v[sel]
        a, b = np.maximum(sel - REACH, bounds[self.row]), np.minimum(sel + LENGTH, end[sel])
        self.around = C.mixed(C.stretch_hash(prefix, a, b) + (sel - a).astype(np.uint64) * np.uint64(C.WORD_BASE) + (b - a).astype(np.uint64))


def _node(raw: bytes) -> bytes:
    return hashlib.md5(raw, usedforsecurity=False).digest()


def _different(batches, seen: set):
    """Slices of texts of at least LENGTH bytes, each text once a task: (nodes, flat, bounds)."""
    for batch in batches:
        for part in C.slices(batch, "text", HASHED_BYTES):
            flat, bounds = C.flat_bytes(part.column("text"))
            raw, keep, nodes = flat.tobytes(), [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if b - a >= LENGTH:
                    x = raw[a:b]
                    n = _node(x)
                    if n not in seen:
                        seen.add(n)
                        nodes.append(n)
                        keep.append(x)
            if keep:
                yield nodes, np.frombuffer(b"".join(keep), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in keep])])


def _grams(batches):
    for _, flat, bounds in _different(batches, set()):
        gram, n = np.unique(Anchors(flat, bounds).gram, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n, pa.int64())], ["gram", "n"])


def _occurrences(known):
    def run(batches):
        for nodes, flat, bounds in _different(batches, set()):
            a = Anchors(flat, bounds)
            ok = np.ones(len(a.gram), bool)
            if known is not None:
                grams = known.value
                at = np.minimum(np.searchsorted(grams, a.gram), max(len(grams) - 1, 0))
                ok = grams[at] == a.gram if len(grams) else np.zeros(len(a.gram), bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.gram[ok].view(np.int64)), pa.array(a.around[ok].view(np.int64)), pa.array([nodes[r] for r in a.row[ok].tolist()], pa.binary()), pa.array(a.pos[ok], pa.int32())],
                ["gram", "around", "node", "pos"],
            )

    return run


def _cut(batches):
    """The bytes around the wanted places of a text."""
    for batch in batches:
        for part in C.slices(batch, "text"):
            out = []
            for node, least, text, places in zip(*(part.column(c).to_pylist() for c in ("node", "least", "text", "places")), strict=True):
                raw = text.encode()
                for p in places:
                    a = max(0, p["pos"] - REACH)
                    out.append((p["gram"], p["around"], node, least, p["pos"], p["pos"] - a, raw[a : p["pos"] + LENGTH], p["crowd"]))
            cols = list(zip(*out, strict=True)) or [[]] * 8
            kinds = (pa.int64(), pa.int64(), pa.binary(), part.column("least").type, pa.int32(), pa.int32(), pa.binary(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["gram", "around", "node", "least", "pos", "left", "bytes", "crowd"])


def _starts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of starts of LENGTH-byte strings in each text; of every start its text, offset and place end to end."""
    size = np.array([len(t) for t in texts], np.int64)
    n = np.maximum(size - LENGTH + 1, 0)
    which = np.repeat(np.arange(len(texts)), n)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    return n, which, offset, (np.cumsum(size) - size)[which] + offset


def _suffix_order(rows: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of byte strings (rows filled up with zeros) within their groups, and what each shares with the one before.

    Strings of different groups share -1 bytes.
    """
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    keys = wide.view(">u8").astype(np.uint64)
    order = np.lexsort((size, *keys.T[::-1], group))
    differ = rows[order[1:]] != rows[order[:-1]]
    same = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    shared = np.full(len(rows), -1, np.int64)
    shared[1:] = np.where(group[order[1:]] == group[order[:-1]], np.minimum(same, np.minimum(size[order[1:]], size[order[:-1]])), -1)
    return order, shared


def longest_factors(texts: list[bytes], left: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every text and number of bytes k before its anchor (at ``left``): whether the LENGTH bytes from there also stand
    so around the anchor of another text of the group, and of an earlier one.

    Equal strings have equal anchors at equal offsets, so only strings that begin as far before their anchors are
    compared: two are equal if the k bytes before the anchors and the LENGTH - k bytes from them are. Both sides are put
    in suffix order once, in which neighbours that share fewer bytes part the classes of each k.
    """
    n, size = len(texts), np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer(b"".join(texts) + bytes(1), np.uint8)
    anchor = np.cumsum(size) - size + left
    back, ahead = np.minimum(left, REACH), np.minimum(size - left, LENGTH)
    offset = np.arange(LENGTH)
    before = np.where(offset[:REACH] < back[:, None], flat[np.maximum(anchor[:, None] - 1 - offset[:REACH], 0)], 0)
    after = np.where(offset < ahead[:, None], flat[np.minimum(anchor[:, None] + offset, len(flat) - 1)], 0)
    sides = [_suffix_order(before, back, group), _suffix_order(after, ahead, group)]
    anywhere, earlier = np.zeros((n, REACH + 1), bool), np.zeros((n, REACH + 1), bool)
    for k in range(REACH + 1):
        some = np.flatnonzero((back >= k) & (ahead >= LENGTH - k))
        if len(some) < 2:
            continue
        classes = []
        for (order, shared), depth in zip(sides, (k, LENGTH - k), strict=True):
            number = np.empty(n, np.int64)
            number[order] = np.cumsum(shared < depth)
            classes.append(number[some])
        key = classes[0] * (n + 1) + classes[1]
        at = np.argsort(key, kind="stable")  # a class keeps the order of the texts
        equal = np.diff(key[at]) == 0
        late, early = some[at[1:][equal]], some[at[:-1][equal]]
        anywhere[late, k] = anywhere[early, k] = earlier[late, k] = True
    return anywhere, earlier


def _span(hit: np.ndarray) -> pa.Array:
    """Bytes that the strings found in each row cover, by offset to the anchor: their starts are near enough for one span."""
    some = hit.any(axis=1)
    first, last = hit.shape[1] - 1 - hit[some, ::-1].argmax(axis=1), hit[some].argmax(axis=1)
    spans = pa.StructArray.from_arrays([pa.array(-first, pa.int32()), pa.array(LENGTH - last, pa.int32())], fields=list(SPAN_ARROW.value_type))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some)]), pa.int32()), spans).cast(SPAN_ARROW)


def _order(batches):
    """Whole grams at a time, in suffix order; rows come by gram, least, node and pos."""
    held, held_bytes = [], 0

    def flush(rows):
        group = np.cumsum([i == 0 or rows[i][0] != rows[i - 1][0] for i in range(len(rows))])
        anywhere, earlier = longest_factors([r[5] for r in rows], np.array([r[4] for r in rows], np.int64), group)
        some = np.flatnonzero(anywhere.any(axis=1))
        ids = [pa.array([rows[i][c] for i in some.tolist()], pa.int64()) for c in (0, 1)]
        return pa.RecordBatch.from_arrays([*ids, _span(anywhere[some]), _span(earlier[some])], ["gram", "around", "anywhere", "earlier"])

    for batch in batches:
        for r in zip(*(batch.column(c).to_pylist() for c in ("gram", "around", "node", "pos", "left", "bytes")), strict=True):
            if held_bytes > SORTED_BYTES and held[-1][0] != r[0]:
                yield flush(held)
                held, held_bytes = [], 0
            held.append(r)
            held_bytes += len(r[5])
    if held:
        yield flush(held)


def _strings(batches):
    """Hashes (128 bits) of all LENGTH-byte strings around the grams of a crowd."""
    for batch in batches:
        for k in range(0, batch.num_rows, 1000):
            rows = batch.slice(k, 1000)
            texts = rows.column("bytes").to_pylist()
            _, which, offset, at = _starts(texts)
            flat = np.frombuffer(b"".join(texts), np.uint8)
            h, h2 = (C.stretch_hash(C.prefix_hash(flat, base), at, at + LENGTH, base) for base in (C.BYTE_BASE, C.WORD_BASE))
            pos, left = rows.column("pos").to_numpy(), rows.column("left").to_numpy()
            kept = rows.select(["gram", "around", "least", "node"]).take(pa.array(which))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(pos[which] - left[which] + offset, pa.int32()), pa.array(offset - left[which], pa.int32()), pa.array(h.view(np.int64)), pa.array(h2.view(np.int64))],
                ["gram", "around", "least", "node", "start", "offset", "h", "h2"],
            )


def spans(docs: DataFrame, keep_first: bool) -> DataFrame:
    """(node, spans) of the texts with repeated bytes, and ``copies`` and ``least`` of every text that has copies."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    text = docs.select(F.col("text").cast("string").alias("text")).filter(F.octet_length("text") >= LENGTH)
    nodes = C.stored(
        docs.filter(F.octet_length("text") >= LENGTH).select("doc_id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("node")).groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")),
        "texts",
    )
    grams = C.stored(text.mapInArrow(_grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).filter("n > 1").select("gram"), "grams")
    known = None
    if grams.count() <= SENT:
        known = spark.sparkContext.broadcast(np.sort(np.array(grams.toArrow().column("gram").to_numpy()).view(np.uint64)))
    found = text.mapInArrow(_occurrences(known), "gram long, around long, node binary, pos int")
    if known is None:
        found = found.join(grams, "gram", "left_semi")
    places = C.stored(found.join(nodes.select("node", "least"), "node"), "places")
    order = F.struct("least", "node", "pos")
    kinds = places.groupBy("gram", "around").agg(F.min(order).alias("first"), F.max(order).alias("last"))
    crowds = kinds.groupBy("gram").agg(F.count("*").alias("kinds"))
    kinds = C.stored(kinds.join(crowds, "gram"), "kinds")
    wanted = (
        kinds.filter("kinds > 1").select("first.node", F.struct("gram", "around", F.col("first.pos").alias("pos"), (F.col("kinds") > CROWD).alias("crowd")).alias("p"))
        .groupBy("node").agg(F.collect_list("p").alias("places")).join(nodes.select("node", "least"), "node")
    )

    def once(batches):
        for ids, flat, bounds in _different(batches, set()):
            raw = flat.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), C.strings([raw[a:b].decode() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)])], ["node", "text"])

    around = f"gram long, around long, node binary, least {kind}, pos int, left int, bytes binary, crowd boolean"
    texts = text.mapInArrow(once, "node binary, text string").join(wanted, "node").dropDuplicates(["node"])
    cut = C.stored(texts.select("node", "least", "text", "places").mapInArrow(_cut, around), "surroundings")
    ordered = cut.filter("not crowd").repartition("gram").sortWithinPartitions("gram", "least", "node", "pos")
    decided = ordered.select("gram", "around", "node", "pos", "left", "bytes").mapInArrow(_order, f"gram long, around long, anywhere {SPAN}, earlier {SPAN}")
    crowd = cut.filter("crowd").select("gram", "around", "least", "node", "pos", "left", "bytes")
    if not crowd.isEmpty():
        strings = C.stored(crowd.mapInArrow(_strings, f"gram long, around long, least {kind}, node binary, start int, offset int, h long, h2 long"), "strings")
        at = F.struct("least", "node", "start")
        ends = strings.groupBy("h", "h2").agg(F.min(at).alias("low"), F.max(at).alias("high")).filter("low <> high")
        hit = strings.join(ends, ["h", "h2"]).select("gram", "around", F.struct(F.col("offset").alias("begin"), (F.col("offset") + LENGTH).alias("end")).alias("s"), (at > F.col("low")).alias("late"))
        decided = decided.union(hit.groupBy("gram", "around").agg(F.collect_list("s").alias("anywhere"), F.collect_list(F.when(F.col("late"), F.col("s"))).alias("earlier")))
    joined = places.join(kinds, ["gram", "around"]).join(decided, ["gram", "around"], "left")
    # All that stands around a gram in two places is repeated; else what the suffix order says.
    whole = F.array(F.struct(F.greatest(F.col("pos") - REACH, F.lit(0)).alias("begin"), (F.col("pos") + LENGTH).alias("end")))
    moved = lambda c: F.transform(F.coalesce(F.col(c), F.array().cast(SPAN)), lambda s: F.struct((s["begin"] + F.col("pos")).alias("begin"), (s["end"] + F.col("pos")).alias("end")))
    if keep_first:
        own = F.when(order == F.col("first"), moved("earlier")).otherwise(whole)
    else:
        own = F.when(F.col("first") != F.col("last"), whole).otherwise(moved("anywhere"))
    per_text = joined.select("node", own.alias("s")).filter(F.size("s") > 0).groupBy("node").agg(F.flatten(F.collect_list("s")).alias("spans"))
    return nodes.join(per_text, "node", "left").filter("copies > 1 or spans is not null").select("node", "least", "copies", F.coalesce("spans", F.array().cast(SPAN)).alias("spans"))


def _apply(others: list[str], keep_first: bool):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = {c: batch.column(c) for c in others}
        sizes, removed, kept, texts = [], [], [], []
        for text, found, all_gone in zip(*(batch.column(c).to_pylist() for c in ("text", "_spans", "_all")), strict=True):
            raw = (text or "").encode()
            n, merged = len(raw), []
            for s in sorted((s["begin"], min(s["end"], n)) for s in ([{"begin": 0, "end": n}] if all_gone else found or [])):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            at, bare, whole = 0, [], []
            for a, b in merged:
                bare.append(raw[at:a])
                while a < b and raw[a] & 0xC0 == 0x80:  # a text loses whole characters only
                    a += 1
                c = b
                while c > a and c < n and raw[c] & 0xC0 == 0x80:
                    c -= 1
                whole.append((a, c))
                at = b
            bare.append(raw[at:])
            at, parts = 0, []
            for a, b in whole:
                parts.append(raw[at:a])
                at = b
            texts.append(None if text is None else b"".join([*parts, raw[at:]]).decode())
            sizes.append(n)
            removed.append([{"begin": a, "end": b} for a, b in merged])
            kept.append(b"".join(bare))
        out |= {"text": batch.column("text"), "n_bytes": pa.array(sizes, pa.int64()), "removed": pa.array(removed, SPAN_ARROW), "kept": pa.array(kept, pa.binary()), "kept_text": C.strings(texts)}
        return pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return run


def remove_repeats(docs: DataFrame, keep_first: bool = True) -> DataFrame:
    """The documents with ``n_bytes``, ``removed`` (byte spans), ``kept`` (remaining bytes) and ``kept_text``.

    A byte goes if a string of ``LENGTH`` bytes that covers it also starts elsewhere, in this document or another; with
    ``keep_first`` only if it starts earlier (in the document with the lesser doc_id, a null one first, or before in the
    same one), so that the first copy stays. Strings are judged on the input. ``kept_text`` drops whole characters only.
    A null text is empty with a null ``kept_text``. Rows that are equal in doc_id and text are two places of their text
    without ``keep_first`` and one with it. Columns of the results' names are replaced, all others kept.
    """
    results = ["n_bytes", "removed", "kept", "kept_text", "_spans", "_all", "_node", "_least", "_copies"]
    others = [c for c in C.without(docs, results) if c != "text"]
    found = spans(docs.select("doc_id", F.col("text").cast("string").alias("text")), keep_first).select(
        F.col("node").alias("_node"), F.col("least").alias("_least"), F.col("copies").alias("_copies"), F.col("spans").alias("_spans")
    )
    narrow = docs.select(*map(C.quoted, others), F.col("text").cast("string").alias("text"))
    joined = narrow.join(found, F.unhex(F.md5(F.col("text").cast("binary"))) == F.col("_node"), "left")
    copy = ~F.col("doc_id").eqNullSafe(F.col("_least")) if keep_first else F.col("_copies") > 1
    joined = joined.withColumn("_all", F.coalesce(F.col("_node").isNotNull() & copy, F.lit(False))).drop("_node", "_least", "_copies")
    schema = T.StructType([*narrow.schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField("removed", T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
                           T.StructField("kept", T.BinaryType()), T.StructField("kept_text", T.StringType())])
    return C.mapped(joined, C.over_slices(_apply(others, keep_first), "text"), schema)


def strip(docs: DataFrame) -> DataFrame:
    """The documents without later copies of passages; documents of which nothing is left go."""
    done = remove_repeats(docs).filter((F.size("removed") == 0) | F.col("kept_text").rlike(r"\S"))
    return done.select(*[F.col("kept_text").alias("text") if c == "text" else F.col(C.quoted(c)) for c in docs.columns if c in done.columns])


def digests(docs: DataFrame) -> DataFrame:
    done = remove_repeats(docs, keep_first=False)
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return done.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
