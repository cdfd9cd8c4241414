"""What the operators of this package share: table access, written tables, slices of batches, word and hash arrays."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.session import scratch_path

#: Text bytes handled at a time inside a task; a single longer text is handled whole.
SLICE_BYTES = 1 << 20

#: Odd multipliers of the polynomial and mixing hashes; any odd values would do.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xC2B2AE3D27D4EB4F
MASK = (1 << 64) - 1


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of this application, wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    place = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark_code.zip")
    with zipfile.ZipFile(place, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "tidemark")):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), top))
    spark.sparkContext.addPyFile(place)
    _SHIPPED.add(app)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the application's scratch folder."""
    return scratch_path(spark, name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table written to the shared folder: it cuts the lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The columns of ``df`` that no result column replaces."""
    gone = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in gone]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have about ``limit`` bytes; a longer text stands alone."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // limit
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def over_slices(fn: Callable[[pa.RecordBatch], pa.RecordBatch], column: str, limit: int = SLICE_BYTES, done: Callable[[], None] | None = None):
    """A mapInArrow function that applies ``fn`` to slices of every batch; at its end it calls ``done``.

    A worker outlives its task and waits for others beside the executor, so it gives back what its batches took.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for part in slices(batch, column, limit):
                    yield fn(part)
        finally:
            if done:
                done()
            pa.default_memory_pool().release_unused()

    return run


def mapped(df: DataFrame, fn, schema: T.StructType) -> DataFrame:
    """mapInArrow for columns of any name: it can't refer to names with dots, so they travel under numbers."""
    names, results = df.columns, schema.names

    def renamed(batches, to):
        for b in batches:
            yield pa.RecordBatch.from_arrays(b.columns, to)

    def run(batches):
        return renamed(fn(renamed(batches, names)), [f"r{i}" for i in range(len(results))])

    numbered = T.StructType([T.StructField(f"r{i}", f.dataType) for i, f in enumerate(schema.fields)])
    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(run, numbered).toDF(*results)


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and the row boundaries; nulls are empty."""
    column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]


@functools.lru_cache(maxsize=4)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    def table(x: int) -> np.ndarray:
        out = np.full(n, x, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return table(base), table(pow(base, -1, 1 << 64))


def powers(n: int, base: int = BYTE_BASE) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64, at least ``n`` of each."""
    return _powers(1 << max(10, int(n).bit_length()), base)


def prefix_hash(values: np.ndarray, base: int = BYTE_BASE) -> np.ndarray:
    """Running polynomial sums: ``stretch_hash`` takes the hash of any stretch out of them."""
    up, _ = powers(len(values) + 1, base)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], dtype=np.uint64, out=out[1:])
    return out


def stretch_hash(prefix: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int = BYTE_BASE) -> np.ndarray:
    _, down = powers(len(prefix), base)
    return mixed((prefix[end] - prefix[begin]) * down[begin])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread of 64-bit hashes (the finishing step of splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def strings(values: list) -> pa.Array:
    return pa.array(values, pa.string())
