"""A keyed Parquet table with row-level writes: changed rows and tombstones in delta folders, merged when read.

A version is a small list of folders, one base and the deltas written since, in order. A write compares its rows with
the stored ones, writes those that change anything to a folder of its own, and then creates the next list. Creating a
file that must not exist yet is all that decides between two writers: the later one fails and the table is as the
first one left it. A write that fails before that has changed nothing, and no list or folder is ever overwritten.

Readers take the newest list. Rows whose key occurs in no delta are read as they are; only the others are folded.
``compact`` writes a new base; older lists stay readable until ``vacuum``.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

PUT, SET, DELETE = "put", "set", "delete"


class Conflict(RuntimeError):
    """Another write was first, or was left unfinished; nothing was changed."""


class KeyedTable:
    """Rows of ``schema``, unique by ``pk``, below ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, pk: list[str]):
        self.spark, self.path, self.pk = spark, path.rstrip("/"), pk
        self.schema = StructType([StructField(f.name, f.dataType) for f in schema.fields])
        self.values = [f.name for f in schema.fields if f.name not in pk]
        jvm = spark.sparkContext._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ versions
    def versions(self) -> list[int]:
        place = self._path(f"{self.path}/versions")
        if not self._fs.exists(place):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(place)]
        return sorted(int(n[1:-5]) for n in names if re.fullmatch(r"v\d+\.json", n))

    def _list(self, version: int) -> list[dict] | None:
        """The folders of a version; None if its list was not finished."""
        text = self.spark.read.text(f"{self.path}/versions/v{version}.json", wholetext=True).first()
        try:
            return json.loads(text[0])["folders"] if text else None
        except ValueError:
            return None

    def current(self) -> tuple[int, list[dict]]:
        """The newest finished version and its folders; 0 and none before the first write."""
        for v in reversed(self.versions()):
            folders = self._list(v)
            if folders is not None:
                return v, folders
        return 0, []

    def _commit(self, seen: int, folders: list[dict]) -> int:
        """The version after ``seen``: created only if nobody did since."""
        last = max(self.versions(), default=0)
        if last != seen:
            raise Conflict(f"{self.path}: version {last} came after {seen}")
        place = self._path(f"{self.path}/versions/v{seen + 1}.json")
        self._fs.mkdirs(place.getParent())
        try:
            stream = self._fs.create(place, False)
        except Py4JJavaError as e:
            raise Conflict(f"{self.path}: version {seen + 1} was written meanwhile") from e
        stream.write(bytearray(json.dumps({"folders": folders}), "utf-8"))
        stream.close()
        return seen + 1

    def recover(self) -> None:
        """After a writer died while it made a list: the version before becomes the newest again."""
        last = max(self.versions(), default=0)
        seen, folders = self.current()
        if last != seen:
            self._commit(last, folders)

    # --------------------------------------------------------------- reads
    def _folder(self, name: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/data/{name}")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the newest version, or of an earlier one."""
        folders = self.current()[1] if version is None else (self._list(version) if version else [])
        if folders is None:
            raise ValueError(f"version {version} was not finished")
        names = self.schema.names
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        base = self._folder(folders[0]["name"], self.schema)
        if len(folders) == 1:
            return base
        deltas = None
        for k, f in enumerate(folders[1:], 1):
            d = self._folder(f["name"], StructType([*self.schema.fields, StructField("_op", StringType())]))
            d = d.select(*names, F.lit(k).alias("_at"), "_op", F.array(*map(F.lit, f["columns"])).cast("array<string>").alias("_columns"))
            deltas = d if deltas is None else deltas.unionByName(d)
        touched = deltas.select(*self.pk).distinct()
        first = base.join(touched, self.pk, "left_semi").select(*names, F.lit(0).alias("_at"), F.lit(PUT).alias("_op"), F.array().cast("array<string>").alias("_columns"))
        steps = first.unionByName(deltas).groupBy(*self.pk).agg(F.sort_array(F.collect_list(F.struct("_at", "_op", "_columns", F.struct(*self.values).alias("_row")))).alias("_steps"))
        kind = StructType([f for f in self.schema.fields if f.name not in self.pk])
        row = F.aggregate("_steps", F.lit(None).cast(kind), lambda held, step: self._step(held, step).cast(kind))
        folded = steps.select(*self.pk, row.alias("_row")).where("_row IS NOT NULL").select(*self.pk, "_row.*")
        return base.join(touched, self.pk, "left_anti").unionByName(folded.select(*names))

    def _step(self, held: Column, step: Column) -> Column:
        """What a key's row is after one more write."""
        some = F.struct(*[F.when(F.array_contains(step["_columns"], c), step["_row"][c]).otherwise(held[c]).alias(c) for c in self.values])
        return F.when(step["_op"] == DELETE, F.lit(None)).when((step["_op"] == PUT) | held.isNull(), step["_row"]).otherwise(some)

    # -------------------------------------------------------------- writes
    def replace(self, rows: DataFrame) -> int:
        """All rows anew."""
        seen = self.current()[0]
        name = f"base-{uuid.uuid4().hex}"
        rows.select(*self.schema.names).write.parquet(f"{self.path}/data/{name}")
        return self._commit(seen, [{"name": name, "columns": []}])

    def compact(self) -> int:
        """The same rows as one base."""
        return self.replace(self.read())

    def _append(self, seen: int, folders: list[dict], changes: DataFrame, columns: list[str]) -> int:
        """Write the changed rows (schema and _op); a write that changes nothing makes no version."""
        if not folders:
            folders = [{"name": f"base-{uuid.uuid4().hex}", "columns": []}]
            self.spark.createDataFrame([], self.schema).write.parquet(f"{self.path}/data/{folders[0]['name']}")
        name = f"delta-{uuid.uuid4().hex}"
        place = f"{self.path}/data/{name}"
        changes.select(*self.schema.names, "_op").sortWithinPartitions(*self.pk).write.parquet(place)
        if self.spark.read.parquet(place).isEmpty():
            return seen
        return self._commit(seen, [*folders, {"name": name, "columns": columns}])

    def _changed(self, stored: DataFrame, new: DataFrame, columns: list[str], op: str) -> DataFrame:
        """New rows that have no stored row, or one that differs in ``columns``."""
        old = stored.select(*self.pk, F.struct(*columns).alias("_old")) if columns else stored.select(*self.pk, F.lit(True).alias("_old"))
        kept = F.col("_old").isNull() | (~F.struct(*[F.col(c) for c in columns]).eqNullSafe(F.col("_old")) if columns else F.lit(False))
        types = {f.name: f.dataType for f in self.schema.fields}
        x = new.select(*[F.col(c).cast(types[c]).alias(c) if c in new.columns else F.lit(None).cast(types[c]).alias(c) for c in self.schema.names])
        return x.join(old, self.pk, "left").where(kept).select(*self.schema.names, F.lit(op).alias("_op"))

    def upsert(self, new: DataFrame) -> int:
        """Rows by key: a new row takes the place of the stored one. ``new`` has each key once."""
        seen, folders = self.current()
        return self._append(seen, folders, self._changed(self.read(seen), new, self.values, PUT), [])

    def update(self, new: DataFrame, columns: list[str]) -> int:
        """Only ``columns`` of stored rows change; rows with a new key are inserted whole."""
        seen, folders = self.current()
        return self._append(seen, folders, self._changed(self.read(seen), new, columns, SET), columns)

    def sync(self, new: DataFrame, lo, hi, date: str = "date") -> int:
        """Stored rows outside [lo, hi] go (a NULL date too), then the upsert, in one version."""
        seen, folders = self.current()
        stored = self.read(seen)
        within = F.coalesce(F.col(date).between(lo, hi), F.lit(False))
        gone = stored.where(~within).join(new.select(*self.pk), self.pk, "left_anti").select(*self.schema.names, F.lit(DELETE).alias("_op"))
        return self._append(seen, folders, self._changed(stored, new, self.values, PUT).unionByName(gone), [])

    def delete(self, keys: DataFrame) -> int:
        seen, folders = self.current()
        gone = self.read(seen).join(keys.select(*self.pk), self.pk, "left_semi")
        return self._append(seen, folders, gone.select(*self.schema.names, F.lit(DELETE).alias("_op")), [])

    def written(self) -> DataFrame:
        """(delta, op, rows): what the deltas of the current version hold."""
        out = self.spark.createDataFrame([], "delta int, op string, rows bigint")
        for k, f in enumerate(self.current()[1][1:], 1):
            d = self._folder(f["name"], StructType([StructField("_op", StringType())]))
            out = out.unionByName(d.groupBy(F.col("_op").alias("op")).agg(F.count("*").alias("rows")).select(F.lit(k).alias("delta"), "op", "rows"))
        return out

    def vacuum(self, keep: int = 1) -> None:
        """Remove lists before the last ``keep`` and the folders that no kept list names. For times without readers or writers."""
        versions = self.versions()
        used = {f["name"] for v in versions[-keep:] for f in self._list(v) or []}
        for f in self._fs.listStatus(self._path(f"{self.path}/data")):
            if f.getPath().getName() not in used:
                self._fs.delete(f.getPath(), True)
        for v in versions[:-keep]:
            self._fs.delete(self._path(f"{self.path}/versions/v{v}.json"), False)
