"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


_LOCAL_FOLDERS: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "tidemark", shuffle: int = 8) -> SparkSession:
    """A local session for tests and benches; clusters bring their own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")  # small local data
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")  # tables kept by symbol join on (symbol, date) in place
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only on a local master where nothing is set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_FOLDERS[app]


_SCRATCH: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path in the application's scratch folder, which goes when the application ends."""
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        root = os.path.join(shared_folder(spark), f"tidemark-{app}")
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(place)
        fs.deleteOnExit(place)
        _SCRATCH[app] = root
    return os.path.join(_SCRATCH[app], f"{name}-{uuid.uuid4().hex}")
