"""Write semantics on plain parquet: merges as frames, writes by partition or new folder."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def merged(old: DataFrame, new: DataFrame, pk: list[str]) -> DataFrame:
    """Keyed upsert: a new row replaces the stored row of its key, others stay."""
    return old.join(new.select(*pk), pk, "left_anti").unionByName(new.select(*old.columns))


def merged_columns(old: DataFrame, new: DataFrame, pk: list[str], updated: list[str]) -> DataFrame:
    """Upsert that only sets ``updated`` on stored rows; rows with a new key are inserted whole."""
    n = new.select(*pk, *[F.col(c).alias(f"_{c}") for c in old.columns if c in new.columns and c not in pk], F.lit(True).alias("_new"))
    o = old.withColumn("_old", F.lit(True))
    cols = []
    for c in old.columns:
        if c in pk:
            cols.append(F.col(c))
        elif f"_{c}" not in n.columns:
            cols.append(F.col(c))
        elif c in updated:
            cols.append(F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_{c}")).alias(c))
    return o.join(n, pk, "full_outer").select(*cols)


def synced(old: DataFrame, new: DataFrame, pk: list[str], lo, hi, date: str = "date") -> DataFrame:
    """Range-bounded sync: stored rows outside [lo, hi] go, then the upsert."""
    return merged(old.where(F.col(date).between(lo, hi)), new, pk)


class PartitionedTable:
    """A Parquet table by partition value whose versions are switched, never overwritten.

    A version is a small file that lists the folder of each partition value. An upsert
    writes the touched partitions to new folders and then the next list; readers take
    the newest list, so a write that fails leaves the table as it was. Folders of
    versions before the last are only removed by ``vacuum``.
    """

    def __init__(self, spark: SparkSession, path: str, partition: str):
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition
        jvm = spark.sparkContext._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        place = self._path(f"{self.path}/versions")
        if not self._fs.exists(place):
            return []
        return sorted(int(f.getPath().getName()[1:-5]) for f in self._fs.listStatus(place) if re.fullmatch(r"v\d+\.json", f.getPath().getName()))

    def folders(self) -> dict[str, str]:
        """Folder of each partition value (as in the folder's name) in the current version."""
        versions = self._versions()
        if not versions:
            return {}
        text = self.spark.read.text(f"{self.path}/versions/v{versions[-1]}.json", wholetext=True).first()[0]
        return json.loads(text)

    def read(self, schema: StructType, values: list | None = None) -> DataFrame:
        """The current rows; of some partition values only, if they are given."""
        wanted = None if values is None else {_folder_name(v) for v in values}
        places = [f"{self.path}/data/{run}/{self.partition}={v}" for v, run in sorted(self.folders().items()) if wanted is None or v in wanted]
        if not places:
            return self.spark.createDataFrame([], schema)
        names = [f.name for f in schema.fields]
        held = StructType([*schema.fields, StructField("write", StringType())])
        return self.spark.read.schema(held).option("basePath", f"{self.path}/data").parquet(*places).select(*names)

    def _commit(self, df: DataFrame, values: list, rows_per_file: int) -> None:
        run = uuid.uuid4().hex
        rest = [c for c in df.columns if c != self.partition]
        # small values share a task and large ones are split, each into files of about the advisory size
        out = df.hint("rebalance", self.partition).sortWithinPartitions(self.partition, *rest)
        out.write.option("maxRecordsPerFile", rows_per_file).partitionBy(self.partition).parquet(f"{self.path}/data/write={run}")
        now = self.folders() | {_folder_name(v): f"write={run}" for v in values}
        versions = self._versions()
        place = f"{self.path}/versions"
        self._fs.mkdirs(self._path(place))
        stage, final = self._path(f"{place}/.{run}"), self._path(f"{place}/v{(versions[-1] if versions else 0) + 1}.json")
        stream = self._fs.create(stage, False)
        stream.write(bytearray(json.dumps(now), "utf-8"))
        stream.close()
        if not self._fs.rename(stage, final):  # another writer was first
            raise RuntimeError(f"{self.path} was changed by another write")

    def upsert(self, new: DataFrame, pk: list[str], rows_per_file: int = 5_000_000) -> None:
        """Upsert by key; only partitions that ``new`` touches are read and written.

        The touched values come to the driver: as many as folders at most. They are an
        ``isin`` filter on the stored side, so other partitions are not even listed.
        Rows of a large partition value are spread over tasks. ``partition`` must
        follow from the key.
        """
        values = [r[0] for r in new.select(self.partition).distinct().collect()]
        if not values:
            return
        old = self.read(new.schema, values).where(F.col(self.partition).isin(values))
        self._commit(merged(old, new, pk), values, rows_per_file)

    def vacuum(self) -> None:
        """Remove folders that the current version does not name, and the lists before it."""
        kept = set(self.folders().values())
        for f in self._fs.listStatus(self._path(f"{self.path}/data")):
            if f.getPath().getName() not in kept:
                self._fs.delete(f.getPath(), True)
        for v in self._versions()[:-1]:
            self._fs.delete(self._path(f"{self.path}/versions/v{v}.json"), False)


def _folder_name(value) -> str:
    """A partition value as Spark writes it in a folder's name (numbers, dates and plain words)."""
    text = str(value)
    if value is None or not re.fullmatch(r"[A-Za-z0-9._+ -]+", text):
        raise ValueError(f"{value!r} can't be a partition value")
    return text


def replace(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Full refresh.  Never the path ``df`` is read from: Spark refuses that."""
    out = df.sortWithinPartitions(*order) if order else df
    out.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json_report(report: DataFrame, path: str) -> None:
    """One-column JSON documents (see ``operators.health``) as text."""
    report.write.mode("overwrite").text(path)
