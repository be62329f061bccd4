"""Session helpers: a local session for tests/bench and the checkpoint folder.

Library code never builds its own session; it takes the caller's.  The only
setting it touches is the checkpoint folder, and only when the cluster left
it unset (local tests), because iterative operators cut lineage with tables
written there (``materialize``).
"""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
import weakref
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tickwise") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting one only where none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  A machine-local temporary folder is only chosen in local mode.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative operators")
    path = tempfile.mkdtemp(prefix="tickwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def materialize(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Cut lineage: write ``df`` once as a Parquet table under the checkpoint
    folder (shared storage on a cluster) and read it back.

    One job, columnar, and a lost executor only re-reads files.  (A plain
    ``DataFrame.checkpoint()`` computes its input a second time to write the
    checkpoint files unless it is also cached.)  The job's shuffle files go when
    it ends: nothing reads them again.  Results may read the tables as long as
    the session lives, or until ``release``; ``drop_materialized``, also run when
    the driver's Python ends, removes them.  ``compression``: a codec other than
    the session's."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"tw-{uuid.uuid4().hex}")
    if not _WRITTEN:
        atexit.register(drop_materialized, spark)
    _WRITTEN.append(path)
    with _shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path, compression=compression)
    table = spark.read.parquet(path)
    _PATHS[table] = path
    return table


_WRITTEN: list[str] = []
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()

#: Spark's switch for removing a query's shuffle files as it ends, off by default: they then
#: stay until the driver's JVM happens to collect the query.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)


def release(table: DataFrame) -> None:
    """Delete a table of ``materialize`` that nothing will read again."""
    path = _PATHS.pop(table)
    _WRITTEN.remove(path)
    _delete(table.sparkSession, path)


def drop_materialized(spark: SparkSession) -> None:
    """Delete the tables that ``materialize`` wrote; DataFrames that still read them stop working."""
    while _WRITTEN:
        _delete(spark, _WRITTEN.pop())


def _delete(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tickwise`` importable on executors (once per SparkContext).

    Executors unpickle strategy objects and fold functions by reference, so
    the package goes out with ``addPyFile`` -- Spark's own distribution path.
    """
    import zipfile

    sc = spark.sparkContext
    ident = sc.applicationId
    if ident in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="tickwise-py-")
    archive = os.path.join(out_dir, "tickwise.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            if "__pycache__" in root:
                continue
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.join("tickwise", os.path.relpath(full, pkg_dir)))
    sc.addPyFile(archive)
    _SHIPPED.add(ident)
