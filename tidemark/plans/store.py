"""Written intermediate tables: each landed input or canonical table is built once and read back.

A stage reads what earlier stages wrote, so checks and reports scan pruned
columns instead of re-deriving, plans stay short, and losing an executor costs
its own scan only.  Tables go below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path

_WRITTEN: dict[tuple[str, str, str, tuple], tuple[str, object]] = {}


def _state(spark: SparkSession, folder: str) -> tuple:
    """Names, lengths and times of what lies in an input folder, so that changed input is built anew."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, todo = [], [place]
    while todo:
        for f in fs.listStatus(todo.pop()):
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
            if f.isDirectory():
                todo.append(f.getPath())
    return tuple(sorted(found))


def stored(
    spark: SparkSession, sf: str, name: str, build: Callable[[SparkSession, str], DataFrame], by: str | None = None,
    together: tuple[str, str] | None = None,
) -> DataFrame:
    """The named table of an input folder, written on first use in this application, a folder for each value of ``by``.

    Tables kept ``together`` by (key, order) share one bucketing on the key, as many buckets as shuffle partitions, sorted
    in each: joins, windows and aggregates by that key then read them where they lie, without an exchange.
    """
    key = (spark.sparkContext.applicationId, sf, name, _state(spark, sf))
    if key not in _WRITTEN:
        path = scratch_path(spark, name)
        df = build(spark, sf)
        if together:
            n = int(spark.conf.get("spark.sql.shuffle.partitions"))
            df.write.bucketBy(n, together[0]).sortBy(*together).option("path", path).saveAsTable(_entry(path))
        else:
            (df.write.partitionBy(by) if by else df.write).parquet(path)
        _WRITTEN[key] = (path, df.schema)
    path, schema = _WRITTEN[key]
    return spark.table(_entry(path)) if together else spark.read.schema(schema).parquet(path)


def _entry(path: str) -> str:
    """The catalog's name of a bucketed table; each written folder is new, so each name is."""
    return path.rsplit("/", 1)[1].replace("-", "_")


def forget() -> None:
    """Build everything anew on next use (benches)."""
    _WRITTEN.clear()
