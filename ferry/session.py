"""Session construction and the shared scratch folder.

Intermediate files (staged fixtures, sink output that is read back, stream
checkpoints) go under the folder the cluster names in ``spark.checkpoint.dir``,
which must be visible to every executor. Only when that setting is absent
(unit tests, a laptop) do we pick a local folder and register it.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "ferry",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with the settings every ferry job assumes.

    ANSI mode stays on (bad dates and bad casts fail the job, as the
    reference's steps do), AQE re-plans shuffles at runtime and coalesces
    small partitions, and the session clock is UTC so ``timestamp_ntz``
    values and ``timestamp`` watermarks agree. Master and shuffle partitions
    come from the environment (``spark-submit``); without one, local mode with
    two partitions per core.
    """
    b = SparkSession.builder
    if master or not _environment_has("spark.master"):
        b = b.master(master or f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        if not shuffle_partitions:
            shuffle_partitions = int(os.environ.get("BENCH_CPUS", "8")) * 2
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = (b
         .appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.ansi.enabled", "true")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # Streaming state in RocksDB: off-heap, spills to local disk, and
         # checkpoints incrementally, so large dedup state is not on the heap.
         .config("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _environment_has(key: str) -> bool:
    """Whether spark-submit or the defaults file sets ``key``."""
    SparkContext._ensure_initialized()  # the JVM knows both
    return SparkConf().contains(key)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate data.

    Read from ``spark.checkpoint.dir`` (or a checkpoint dir already set on
    the context). Without either, a local session registers a fresh local
    folder; on a cluster that would scatter the data over separate disks, so
    there it is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ferry-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, through the path's file system."""
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (never reused)."""
    return f"{scratch_root(spark)}/ferry/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()
_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``ferry`` importable in executor Python workers.

    Functions handed to ``mapInPandas`` and the Python data source are
    pickled by reference, so workers import ``ferry``. The package is zipped
    once per application and added with ``addPyFile``; Spark serves the file
    to every executor (as ``--py-files`` does). The zip is built where the
    driver can write plain files: the shared folder when it is a mounted
    path, else the driver's own temporary folder (only the driver reads it).
    """
    import zipfile

    sc = spark.sparkContext
    with _LOCK:
        if sc.applicationId in _SHIPPED:
            return
        root = scratch_root(spark)
        if "://" in root and not root.startswith("file:"):
            folder = tempfile.mkdtemp(prefix="ferry-pyfiles-")
        else:
            folder = scratch_path(spark, "pyfiles").removeprefix("file:")
            os.makedirs(folder, exist_ok=True)
        target = os.path.join(folder, "ferry.zip")
        pkg = os.path.dirname(os.path.abspath(__file__))
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for d, _, files in os.walk(pkg):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(d, f)
                        z.write(full, os.path.join("ferry", os.path.relpath(full, pkg)))
        sc.addPyFile(target)
        _SHIPPED.add(sc.applicationId)
