"""Sharding by histogram sort: exact counts below probed keys find splitters, then one exchange deals the rows out.

The key of a row is (hash of its text, doc_id), so equal texts are neighbours and a large group of copies can still be
cut at a document. Every round counts the bytes below the probes that lie evenly within the stretches of key space
where a splitter may still be; a round returns at most ``PROBES`` counts for each open splitter, whatever the input.
Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common as C

SHARDS = 8
PROBES = 1024
#: A splitter may miss its target by this share of a shard's bytes.
TOLERANCE = 0.001
ROUNDS = 24
WIDE = "decimal(38,0)"
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1

RESULTS = ["size", "shard", "slot"]


@dataclass
class Stretch:
    """Key space (h, d) from ``low`` to ``high``, both within, with the bytes below it; a splitter's target lies inside."""

    target: int
    low: tuple[int, int]
    high: tuple[int, int]
    below: int
    bytes: int

    def level(self) -> int:
        """Probe the hashes first; within one hash, the documents."""
        return int(self.low[0] == self.high[0])

    def step(self) -> int:
        i = self.level()
        return (self.high[i] - self.low[i]) // PROBES + 1


def _within(s: Stretch) -> Column:
    if s.level():
        return (F.col("_h") == s.low[0]) & F.col("_d").between(s.low[1], s.high[1])
    return F.col("_h").between(s.low[0], s.high[0])


def _probe(s: Stretch) -> Column:
    i = s.level()
    key = F.col("_d" if i else "_h").cast(WIDE)
    return F.floor((key - F.lit(s.low[i]).cast(WIDE)).cast("decimal(38,6)") / F.lit(s.step()).cast("decimal(20,0)")).cast("int")


def splitters(keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """The least keys (hash, document) of shards 1, 2, ...: shard i has the rows from splitter i to below splitter i + 1.

    ``keys`` has ``_h``, ``_d`` and ``size``. Each splitter is refined until the bytes below it are within ``tolerance``
    of a shard's share of its target, or until the stretch is one single key.
    """
    first = keys.agg(F.sum("size"), F.min("_h"), F.max("_h")).first()
    total = first[0] or 0
    if not total:
        return []
    out: list[tuple[int, int] | None] = [None] * (shards - 1)
    whole = Stretch(0, (first[1], LOWEST), (first[2], HIGHEST), 0, total)
    if first[1] == first[2]:
        ends = keys.agg(F.min("_d"), F.max("_d")).first()
        whole.low, whole.high = (first[1], ends[0]), (first[2], ends[1])
    todo = {i: Stretch(total * (i + 1) // shards, whole.low, whole.high, 0, total) for i in range(shards - 1)}
    for _ in range(ROUNDS):
        if not todo:
            break
        open_ = {(s.low, s.high): s for s in todo.values()}
        place = {k: n for n, k in enumerate(open_)}
        group, probe = F.lit(None).cast("int"), F.lit(None).cast("int")
        inside = F.lit(False)
        for k, s in open_.items():
            group, probe, inside = F.when(_within(s), place[k]).otherwise(group), F.when(_within(s), _probe(s)).otherwise(probe), inside | _within(s)
        counts = (
            keys.filter(inside).groupBy(group.alias("g"), probe.alias("p"))
            .agg(F.sum("size").alias("b"), F.min("_h").alias("h0"), F.max("_h").alias("h1"), F.min("_d").alias("d0"), F.max("_d").alias("d1"))
            .orderBy("g", "p").collect()
        )
        for i, s in list(todo.items()):
            below = s.below
            for r in (r for r in counts if r.g == place[(s.low, s.high)]):
                if below + r.b < s.target:
                    below += r.b
                    continue
                one = r.h0 == r.h1
                low, high = (r.h0, r.d0 if one else LOWEST), (r.h1, r.d1 if one else HIGHEST)
                before, after = s.target - below, below + r.b - s.target
                close = tolerance * total / shards
                if min(before, after) <= close or low == high:
                    out[i] = low if before <= after else _next(high)
                    del todo[i]
                else:
                    todo[i] = Stretch(s.target, low, high, below, r.b)
                break
    for i, s in todo.items():  # keys that ROUNDS rounds can't tell apart don't exist; this is for safety
        out[i] = s.low
    return sorted(out)


def _next(key: tuple[int, int]) -> tuple[int, int]:
    h, d = key
    return (h, d + 1) if d < HIGHEST else (min(h + 1, HIGHEST), LOWEST)


def deal(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, partitions: int | None = None) -> DataFrame:
    """All columns of the documents with ``size`` (bytes of the text plus 1), ``shard`` and ``slot``.

    The shards' bytes are equal within the tolerance and one row's size. Within a shard the slots follow the key and
    have no gaps. Columns called size, shard or slot, or as the working columns (_h, _d, _at, _part, _shift), are replaced. A null text has size 1; rows that are equal in every
    column are told apart by their place only, and stay together. A null doc_id counts as the lowest document. An
    empty table gives an empty result, and the rows of fewer documents than shards leave shards empty.
    """
    spark = docs.sparkSession
    keep = C.without(docs, [*RESULTS, "_h", "_d", "_at", "_part", "_shift"])
    keyed = docs.select(
        *map(C.quoted, keep), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.xxhash64("text").alias("_h"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("_d"),
    )
    cuts = splitters(C.stored(keyed.select("size", "_h", "_d"), "shard-keys"), shards, tolerance)
    shard = F.lit(0)
    for h, d in cuts:
        shard = shard + ((F.col("_h") > h) | ((F.col("_h") == h) & (F.col("_d") >= d))).cast("int")
    n = partitions or max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = (
        keyed.withColumn("shard", shard).repartitionByRange(n, "shard", "_h", "_d").sortWithinPartitions("shard", "_h", "_d")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    written = C.stored(dealt.drop("_h", "_d"), "shards")
    part = F.shiftright("_at", 33)
    runs = written.groupBy("shard", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row for each partition and shard: bounded by the number of partitions.
    runs = runs.select("shard", "_part", (before - F.col("_first")).alias("_shift"))
    numbered = written.withColumn("_part", part).join(F.broadcast(runs), ["shard", "_part"])
    return numbered.select(*map(C.quoted, keep), "size", "shard", (F.col("_at") + F.col("_shift")).alias("slot"))


def digests(dealt: DataFrame) -> DataFrame:
    return dealt.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
