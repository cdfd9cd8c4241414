"""Merkle manifest of a table: a tree of sixteen-fold runs for every source, one tree over the sources, and proofs.

Leaves are digests of rows. In each source they stand in doc_id order; every sixteen neighbouring digests become the
digest of their hex texts, level by level, until one is left, the source's subroot. The subroots, in order of the
source, become the root in the same way.

Proofs are made for many leaves at once (an octopus multiproof). A block of leaves works out which nodes lie beside
the paths of its leaves and can't be derived from them, a set that grows with the tree's height and not with the
block where leaves are neighbours. It fetches each of them once, derives what its leaves share, and writes out the
proof of each leaf on the spot.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common as C

FANOUT = 16
#: Leaves in a block, as a power of two: a block's proofs are written out in one task.
BLOCK_BITS = 10
#: Proofs verified at a time: each is a few thousand bytes.
VERIFIED = 1024
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: The tree over the sources; trees of sources are called '' (null) or '+' and the source.
TOP = "#"
HEX = 64


def encoded(value: Column) -> Column:
    """A field as its length in bytes, a colon and the value; null as a dash."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, values)), 256)


@dataclass(frozen=True)
class Manifest:
    """Written tables. ``leaves``: doc_id, source, leaf, shown (the digest to be verified), tree, i, n (place in the
    tree, and the tree's leaves), j, m (the same for the source in the tree over sources), block. ``nodes``: tree, level, i, digest."""

    leaves: DataFrame
    nodes: DataFrame

    def root(self) -> DataFrame:
        """(root): the digest of the whole table; no row if it is empty."""
        top = self.nodes.filter(F.col("tree") == TOP)
        return top.join(top.agg(F.max("level").alias("level")), "level").select(F.col("digest").alias("root"))


def build(docs: DataFrame, fields: list[str] = FIELDS, shown: dict[str, Column] | None = None) -> Manifest:
    """Trees over all rows; ``shown`` replaces fields in the copy that is to be verified against them.

    Each row is a leaf, repeated rows too. A null source is a tree of its own and stands first; a null doc_id stands
    before all others; rows of one doc_id stand in order of their digests. Other columns, whatever their names, don't
    count. An empty table has no nodes.
    """
    shown = shown or {}
    field = lambda c: F.col(C.quoted(c))
    leaves = docs.select(
        field("doc_id").alias("doc_id"), field("source").alias("source"), F.coalesce(F.concat(F.lit("+"), field("source").cast("string")), F.lit("")).alias("tree"),
        leaf_digest([field(c) for c in fields]).alias("leaf"), leaf_digest([shown.get(c, field(c)) for c in fields]).alias("shown"),
    )
    by = ["tree", "doc_id", "leaf"]
    placed, runs = _placed(C.stored(leaves, "merkle-rows"), by)
    inside = Window.partitionBy("tree")
    before = inside.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("tree", "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(inside).alias("n"))
    trees, tree_runs = _placed(C.stored(runs.select("tree").distinct(), "merkle-trees"), ["tree"])
    order = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition
    tree_runs = tree_runs.groupBy("_part").agg(F.min("_first").alias("_first"), F.sum("_rows").alias("_rows"))
    tree_runs = tree_runs.select("_part", (F.coalesce(F.sum("_rows").over(order), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(Window.partitionBy()).alias("m"))
    trees = trees.join(tree_runs, "_part").select("tree", (F.col("_at") + F.col("_shift")).alias("j"), "m")
    runs = runs.join(C.stored(trees, "merkle-trees"), "tree")
    leaves = placed.join(runs, ["tree", "_part"]).select(
        "doc_id", "source", "leaf", "shown", "tree", (F.col("_at") + F.col("_shift")).alias("i"), "n", "j", "m", F.shiftright("_at", BLOCK_BITS).alias("block")
    )
    leaves = C.stored(leaves, "merkle-leaves")
    levels = _levels(leaves.select("tree", "i", "n", F.col("leaf").alias("digest")))
    roots = _union([x.filter("n = 1").select("tree", "digest") for x in levels]).join(trees, "tree")
    levels += _levels(C.stored(roots.select(F.lit(TOP).alias("tree"), F.col("j").alias("i"), F.col("m").alias("n"), "digest"), "merkle-subroots"))
    return Manifest(leaves, _union([x.select("tree", "level", "i", "digest") for x in levels]))


def _placed(df: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows, sorted over range partitions, with their place there (_at, _part); and the runs of each tree in them."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.shiftright("_at", 33).alias("_part")
    x = C.stored(df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "merkle-placed")
    return x.select("*", part), x.groupBy("tree", part).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))


def _levels(leaves: DataFrame) -> list[DataFrame]:
    """Tables of the nodes (tree, level, i, n, digest) of every level, from the leaves up; n is the tree's nodes there."""
    out = [leaves.withColumn("level", F.lit(0))]
    while not (open_ := out[-1].filter("n > 1")).isEmpty():
        kids = F.sort_array(F.collect_list(F.struct("i", "digest"))).alias("kids")
        up = open_.groupBy("tree", "level", F.expr(f"i div {FANOUT}").alias("i"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n")).agg(kids)
        digest = F.sha2(F.array_join("kids.digest", ""), 256)
        out.append(C.stored(up.select("tree", (F.col("level") + 1).alias("level"), "i", "n", digest.alias("digest")), "merkle-level"))
    return out


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for x in frames[1:]:
        out = out.unionByName(x)
    return out


def missing(have: np.ndarray, n: int) -> list[np.ndarray]:
    """By level, the places of the least set of nodes with which the leaves ``have`` (of ``n``) reach the root."""
    out = []
    have = np.unique(have)
    while n > 1:
        runs = np.unique(have // FANOUT)
        members = (runs[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        out.append(np.setdiff1d(members[members < n], have, assume_unique=True))
        have, n = runs, -(-n // FANOUT)
    return out


_ASKED = "block long, tree string, level int, i long"


def _ask(leaves: pa.Table) -> pa.Table:
    names, which = np.unique(np.array(leaves["tree"].to_pylist(), dtype=object), return_inverse=True)
    i, n, j, m = (leaves[c].to_numpy() for c in ("i", "n", "j", "m"))
    order = np.argsort(which, kind="stable")
    wanted = [(TOP, missing(j, int(m[0])))]
    for name, rows in zip(names, np.split(order, np.flatnonzero(np.diff(which[order])) + 1), strict=True):
        if n[rows[0]] > 1:
            wanted.append((name, missing(i[rows], int(n[rows[0]]))))
    rows = [(name, level, int(k)) for name, levels in wanted for level, places in enumerate(levels) for k in places]
    trees, levels, places = zip(*rows, strict=True) if rows else ((), (), ())
    block = [leaves["block"][0].as_py()] * len(rows)
    return pa.table([pa.array(block, pa.int64()), C.strings(list(trees)), pa.array(levels, pa.int32()), pa.array(places, pa.int64())], ["block", "tree", "level", "i"])


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _climb(known: dict[int, str], n: int, given: dict[int, dict[int, str]]) -> tuple[str, list[tuple[dict[int, str], dict[int, str]]]]:
    """The root above the known leaves; and for each level the derived nodes and the texts of their runs."""
    layers, level = [], 0
    while n > 1:
        beside = given.get(level, {})
        texts = {g: "".join(known[k] if k in known else beside[k] for k in range(g * FANOUT, min(n, (g + 1) * FANOUT))) for g in {k // FANOUT for k in known}}
        layers.append((known, texts))
        known, n, level = {g: _sha(t) for g, t in texts.items()}, -(-n // FANOUT), level + 1
    return known[0], layers


Path = tuple[str, tuple[int, ...], tuple[int, ...]]


def _paths(layers: list, above: Path) -> dict[int, Path]:
    """Of each leaf: the siblings' digests up to the root, its slots in the runs, and the runs' widths."""
    out = {0: above}
    for nodes, texts in reversed(layers):
        down = {}
        for k in nodes:
            g, s = divmod(k, FANOUT)
            run, (proof, slots, widths) = texts[g], out[g]
            down[k] = (run[: s * HEX] + run[(s + 1) * HEX :] + proof, (s, *slots), (len(run) // HEX, *widths))
        out = down
    return out


_PROVED = "leaf string, shown string, subroot string, root string, proof string, slots array<int>, widths array<int>"


def _expand(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
    """The proofs of one block's leaves from the fetched nodes."""
    given: dict = defaultdict(lambda: defaultdict(dict))
    for tree, level, i, digest in zip(*(fetched[c].to_pylist() for c in ("tree", "level", "i", "digest")), strict=True):
        given[tree][level][i] = digest
    tree, i, n, j, m, leaf = (leaves[c].to_pylist() for c in ("tree", "i", "n", "j", "m", "leaf"))
    known: dict = defaultdict(dict)
    size, place = {}, {}
    for t, a, b, c, digest in zip(tree, i, n, j, leaf, strict=True):
        known[t][a] = digest
        size[t], place[t] = b, c
    climbed = {t: _climb(k, size[t], given[t]) for t, k in known.items()}
    root, layers = _climb({place[t]: subroot for t, (subroot, _) in climbed.items()}, m[0], given[TOP]) if m else ("", [])
    tops = _paths(layers, ("", (), ()))
    paths = {t: _paths(x, tops[place[t]]) for t, (_, x) in climbed.items()}
    found = [paths[t][a] for t, a in zip(tree, i, strict=True)]
    ints = pa.list_(pa.int32())
    return pa.table(
        [leaves["doc_id"], leaves["source"], leaves["leaf"], leaves["shown"], C.strings([climbed[t][0] for t in tree]), C.strings([root] * len(tree)),
         C.strings([p for p, _, _ in found]), pa.array([s for _, s, _ in found], ints), pa.array([w for _, _, w in found], ints)],
        ["doc_id", "source", *[c.split()[0] for c in _PROVED.split(", ")]],
    )


def prove(manifest: Manifest, leaves: DataFrame | None = None) -> DataFrame:
    """(doc_id, source, leaf, shown, subroot, root, proof, slots, widths) of all leaves, or of any subset of the manifest's.

    ``proof`` holds the hex digests of the siblings, level by level to the root and from left to right within a run;
    a leaf's digest stands at place ``slots[k]`` of a run of ``widths[k]`` digests on level k. A table of one row has an
    empty proof, and its leaf is its root.
    """
    leaves = manifest.leaves if leaves is None else leaves
    asked = leaves.select("block", "tree", "i", "n", "j", "m").groupBy("block").applyInArrow(_ask, _ASKED)
    fetched = asked.join(manifest.nodes, ["tree", "level", "i"]).select("block", "tree", "level", "i", "digest")
    types = {f.name: f.dataType for f in leaves.schema.fields}
    proved = T.StructType([T.StructField("doc_id", types["doc_id"]), T.StructField("source", types["source"]), *T._parse_datatype_string(_PROVED).fields])
    return leaves.groupBy("block").cogroup(fetched.groupBy("block")).applyInArrow(_expand, proved)


def fold(digest: str, proof: str, slots: list[int], widths: list[int]) -> str:
    """The root that a leaf's digest and its proof lead to."""
    at = 0
    for s, w in zip(slots, widths, strict=True):
        end = at + (w - 1) * HEX
        digest = _sha(proof[at : at + s * HEX] + digest + proof[at + s * HEX : end])
        at = end
    return digest


def verified(proved: DataFrame) -> DataFrame:
    """The proofs with ``folded_root``, recomputed from ``shown`` and the proof alone, and ``verified``: it is the root."""
    names = proved.columns

    def run(batches):
        for b in (batch.slice(k, VERIFIED) for batch in batches for k in range(0, batch.num_rows, VERIFIED)):
            cols = [b.column(names.index(c)).to_pylist() for c in ("shown", "proof", "slots", "widths")]
            yield pa.RecordBatch.from_arrays([*b.columns, C.strings([fold(*x) for x in zip(*cols, strict=True)])], [*names, "folded_root"])

    schema = T.StructType([*proved.schema.fields, T.StructField("folded_root", T.StringType())])
    return C.mapped(proved, run, schema).withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered() -> Column:
    """The text as the query tampers with it: A-Z in lower case where 5 divides the checksum of the doc_id."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.when(hit, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))


def digests(docs: DataFrame) -> DataFrame:
    found = verified(prove(build(docs, shown={"text": tampered()})))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")
