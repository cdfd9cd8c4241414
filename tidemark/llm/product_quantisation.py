"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, table-lookup distances, exact cosines.

The coarse centroids and the codebooks of the residuals are fitted on a bounded sample; every vector is indexed. A unit
vector x goes to its nearest centroid and asks all lists whose centroid is at most ``MARGIN`` farther from x than the
nearest. Within a list the asymmetric distance of x to a code is summed from tables, and a code is passed on if it may
be as near as the threshold given the error that its vector was quantised with, so the codes lose nothing. What is
passed on is compared by exact cosine. Equal vectors of one label are one entry with its multiplicity.

Vectors of different lengths have no cosine, so lists are kept by (label, length) and each of the ``LENGTHS`` most
frequent lengths has an index of its own, fitted on its share of the sample. A rarer length has one list without codes:
all its vectors are compared, block by block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.llm.graph import components

SIMILAR = 0.98
#: The sample that centroids and codebooks are fitted on, and their numbers.
SAMPLE = 8192
CENTROIDS, PARTS, CODES = 256, 8, 64
ROUNDS = 8
#: Vectors a centroid is fitted on at least: a small sample must not make each of its vectors a list of its own.
FEWEST = 16
#: Lengths that are fitted, and the least number of vectors that each is fitted on where it has them.
LENGTHS, LEAST = 16, 256
#: A near copy's list is missed only if it lies across a boundary by more than this distance.
MARGIN = 0.12
#: Entries of a list that meet the queries of a list in one task.
BLOCK = 1024


def _kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    pick = np.random.default_rng(seed)
    centres = x[pick.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        near = (x @ centres.T * -2 + (centres**2).sum(1)).argmin(1)
        n = np.bincount(near, minlength=len(centres))
        sums = np.stack([np.bincount(near, x[:, d], len(centres)) for d in range(x.shape[1])], axis=1)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


class Index:
    """Centroids, and the codebooks of the parts of a residual."""

    def __init__(self, sample: np.ndarray):
        self.centroids = _kmeans(sample, max(1, min(CENTROIDS, len(sample) // FEWEST)), 1)
        near = self.distances(sample).argmin(1)
        rest = sample - self.centroids[near]
        self.cuts = np.array_split(np.arange(sample.shape[1]), min(PARTS, sample.shape[1]))
        self.books = [_kmeans(rest[:, c], CODES, 2 + i) for i, c in enumerate(self.cuts)]

    def distances(self, x: np.ndarray) -> np.ndarray:
        d = (x**2).sum(1)[:, None] + (self.centroids**2).sum(1) - 2 * x @ self.centroids.T
        return np.sqrt(np.maximum(d, 0))

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of x in its list, and the distance between x and what the codes stand for."""
        rest = x - self.centroids[lists]
        codes = np.stack([((rest[:, c] ** 2).sum(1)[:, None] + (b**2).sum(1) - 2 * rest[:, c] @ b.T).argmin(1) for c, b in zip(self.cuts, self.books, strict=True)], axis=1)
        told = np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], axis=1)
        return codes.astype(np.uint8), np.linalg.norm(rest - told, axis=1)

    def tables(self, x: np.ndarray, which: int) -> np.ndarray:
        """Squared distances of each query's residual in a list to every code of every part."""
        rest = x - self.centroids[which]
        out = np.full((len(x), len(self.books), CODES), np.inf)
        for i, (c, b) in enumerate(zip(self.cuts, self.books, strict=True)):
            out[:, i, : len(b)] = np.maximum((rest[:, c] ** 2).sum(1)[:, None] + (b**2).sum(1) - 2 * rest[:, c] @ b.T, 0)
        return out


class Indexes:
    """The index of each length; a length that was not fitted has a single centroid and a single code, the origin."""

    def __init__(self, samples: dict[int, np.ndarray]):
        self.fitted = {n: Index(_unit(x)) for n, x in samples.items()}

    def of(self, n: int) -> Index:
        return self.fitted[n] if n in self.fitted else Index(np.zeros((1, n)))


def _matrix(column: pa.Array) -> np.ndarray:
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / scale
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _ask(index):
    """Each entry as a member of its list and as a query of all lists near enough."""

    def run(batches):
        for batch in batches:
            sizes = batch.column("n").to_numpy()
            for size in np.unique(sizes).tolist():
                yield one(batch.filter(pa.array(sizes == size)), index.value.of(size))

    def one(batch, fitted):
        x = _unit(_matrix(batch.column("v")))
        d = fitted.distances(x)
        own = d.argmin(1)
        codes, error = fitted.encode(x, own)
        row, lists = np.nonzero(d <= d.min(1)[:, None] + MARGIN)
        n = batch.num_rows
        take = np.concatenate([np.arange(n), row])
        copied = batch.take(pa.array(take))
        told = [codes[i].tobytes() if k < n else b"" for k, i in enumerate(take.tolist())]
        return pa.RecordBatch.from_arrays(
            [copied.column("label"), copied.column("n"), pa.array(np.concatenate([own, lists]), pa.int32()), pa.array(np.arange(len(take)) >= n), copied.column("entry"), copied.column("copies"),
             copied.column("v"), pa.array(own[take], pa.int32()), pa.array(told, pa.binary()), pa.array(error[take])],
            ["label", "n", "list", "asks", "entry", "copies", "v", "home", "codes", "error"],
        )

    return run


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node reached) over the pairs."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        new = root.copy()
        np.minimum.at(new, x, root[y])
        np.minimum.at(new, y, root[x])
        new = new[new]
        if (new == root).all():
            return nodes, nodes[root]
        root = new


def _meet(index, similar: float):
    """Queries against entries of a list: for every entry with a link, how many others it links and one it reaches.

    A pair may be seen from both sides or from one. Seen from both, each side counts for its query; seen from one, that
    side counts for both.
    """
    reach = np.sqrt(2 - 2 * similar) + 1e-6

    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        own, ask = table.filter(pa.array(~asks)), table.filter(pa.array(asks))
        found = ([], [], [], [], [])
        if own.num_rows and ask.num_rows:
            which = own.column("list")[0].as_py()
            y = _unit(_matrix(own.column("v").combine_chunks()))
            fitted = index.value.of(y.shape[1])
            codes = np.frombuffer(b"".join(own.column("codes").to_pylist()), np.uint8).reshape(own.num_rows, -1)
            error, ids, many = own.column("error").to_numpy(), own.column("entry").to_numpy(), own.column("copies").to_numpy()
            away = fitted.distances(y)
            answers = away <= away.min(1)[:, None] + MARGIN
            q = _unit(_matrix(ask.column("v").combine_chunks()))
            asked, homes, copies = ask.column("entry").to_numpy(), ask.column("home").to_numpy(), ask.column("copies").to_numpy()
            for a in range(0, len(q), 256):
                part = q[a : a + 256]
                t = fitted.tables(part, which)
                far = np.zeros((len(part), len(y)))
                for i in range(codes.shape[1]):
                    far += t[:, i, codes[:, i]]
                i, j = np.nonzero(np.sqrt(far) <= reach + error)
                ok = (np.einsum("nd,nd->n", part[i], y[j]) >= similar) & (asked[a + i] != ids[j])
                i, j = a + i[ok], j[ok]
                alone = ~answers[j, homes[i]]
                for f, v in zip(found, (asked[i], ids[j], many[j], copies[i], alone), strict=True):
                    f.append(v)
        x, y, to, back, alone = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in found)
        alone = alone.astype(bool)
        nodes, root = _roots(x, y)
        links = np.zeros(len(nodes), np.int64)
        np.add.at(links, np.searchsorted(nodes, x), to)
        np.add.at(links, np.searchsorted(nodes, y[alone]), back[alone])
        return pa.table([pa.array(nodes, pa.int64()), pa.array(links, pa.int64()), pa.array(root, pa.int64())], ["entry", "links", "root"])

    return run


def near_copies(vectors: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for every row with ``vec_id``, ``embedding`` and ``label``.

    Two rows link if their labels are equal and not null and the cosine of their vectors, in double precision, is at
    least ``similar``. Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and
    vectors of different lengths do not link with each other. Repeated rows are vectors of their own and link each other. A component is
    named by its least vec_id; a null vec_id is never the least if there is another. Other columns are not used.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "label", F.col("embedding").alias("v"))
    wrong = F.exists("v", lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    fine = F.col("label").isNotNull() & F.coalesce(~wrong & F.exists("v", lambda c: c != 0), F.lit(False))
    rows = rows.withColumns({"fine": fine, "k1": F.xxhash64("label", "v"), "k2": F.xxhash64(F.lit(1), "label", "v")})
    entries = rows.filter("fine").groupBy("k1", "k2").agg(F.any_value("label").alias("label"), F.any_value("v").alias("v"), F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    entries = C.stored(entries.withColumns({"n": F.size("v"), "entry": F.monotonically_increasing_id()}), "entries")
    usual = entries.groupBy("n").count().orderBy(F.desc("count"), "n").limit(LENGTHS).collect()
    if not usual:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    share = SAMPLE / sum(u["count"] for u in usual)
    samples = {}
    for u in usual:
        sample = entries.filter(F.col("n") == u["n"]).orderBy("k1", "k2").limit(max(LEAST, int(u["count"] * share))).select("v").toArrow()
        samples[u["n"]] = _matrix(sample.column("v").combine_chunks())
    index = spark.sparkContext.broadcast(Indexes(samples))
    kinds = dict(entries.dtypes)
    asked = C.stored(
        entries.select("label", "n", "entry", "copies", "v").mapInArrow(_ask(index), f"label {kinds['label']}, n int, list int, asks boolean, entry long, copies long, v {kinds['v']}, home int, codes binary, error double"), "asked"
    )
    # Members and queries of a list are dealt to blocks, and every block of members meets every block of queries.
    sizes = asked.groupBy("label", "n", "list").agg(F.ceil(F.count_if(~F.col("asks")) / BLOCK).alias("members"), F.ceil(F.count_if("asks") / BLOCK).alias("queries")).filter("members > 0 and queries > 0")
    dealt = asked.join(sizes, ["label", "n", "list"]).withColumn("mine", F.pmod(F.xxhash64("entry"), F.when(F.col("asks"), F.col("queries")).otherwise(F.col("members"))))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("asks"), F.col("members")).otherwise(F.col("queries")) - 1))
    dealt = dealt.select("label", "n", "list", "asks", "entry", "copies", "v", "home", "codes", "error", "mine", other.alias("theirs"))
    pair = F.when(F.col("asks"), F.struct(F.col("theirs").alias("m"), F.col("mine").alias("q"))).otherwise(F.struct(F.col("mine").alias("m"), F.col("theirs").alias("q")))
    met = C.stored(dealt.groupBy("label", "n", "list", pair.alias("pair")).applyInArrow(_meet(index, similar), "entry long, links long, root long"), "met")
    near = components(met.select(F.col("entry").alias("a"), F.col("root").alias("b")).filter("a <> b"))
    links = met.groupBy("entry").agg(F.sum("links").alias("links"))
    named = entries.select("k1", "k2", "entry", "least", "copies").join(links, "entry", "left").join(near.withColumnRenamed("node", "entry"), "entry", "left")
    named = named.withColumn("label", F.coalesce("label", "entry"))
    least = named.groupBy("label").agg(F.min("least").alias("component"))
    done = named.join(least, "label").select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "component")
    out = rows.select("vec_id", "fine", "k1", "k2").join(done.withColumn("fine", F.lit(True)), ["fine", "k1", "k2"], "left")
    named = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), named.alias("component_id"), F.coalesce(F.col("vec_id") == named, named.isNull()).alias("kept"))
