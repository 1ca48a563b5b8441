"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours relies on.  They are applied with
# ``setIfMissing`` semantics on an existing cluster session: a cluster that
# already chose a value keeps it.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "riskweave") -> SparkSession:
    """Return the active session or build a local one (tests, bench).

    On a cluster ``master`` is left to spark-submit; locally it defaults to
    ``local[*]``.  The UI is kept off: nothing here needs a web server.
    """
    active = SparkSession.getActiveSession()
    if active is not None and master is None:
        return active
    builder = (
        SparkSession.builder.appName(app_name)
        .master(master or "local[*]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("RISKWEAVE_DRIVER_MEMORY", "8g"))
        # remove reliable-checkpoint files once their DataFrame is garbage-collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply our defaults to an existing session where they are unset."""
    conf = spark.conf
    for k, v in _DEFAULTS.items():
        if conf.get(k, None) is None:
            conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The cluster names its shared storage in ``spark.checkpoint.dir``; we
    read it from the session.  Only when it is unset (local tests) do we
    choose a folder ourselves, and register it as the checkpoint dir so
    ``DataFrame.checkpoint()`` uses the same place.
    """
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a shared directory; return it.

    Order: the session's ``spark.checkpoint.dir``; else a directory already
    set on the SparkContext; else (local runs and tests only) a folder of
    our own, registered on the context.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server reads spark.checkpoint.dir itself
        sc = None
    if not root and sc is not None and sc.getCheckpointDir():
        root = sc.getCheckpointDir()
    if not root:
        root = os.environ.get("RISKWEAVE_SCRATCH")
        if not root:
            master = sc.master if sc is not None else ""
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            root = "/tmp/riskweave-shared"
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # a session may reject core settings at run time
            pass
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


#: Removes the shuffle files of a query as it ends (Spark 4.1).
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries made in this block lose their shuffle files as they end, not
    with the driver's garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def spill(df: DataFrame, purpose: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later jobs do
    not repeat its plan, and a lost executor costs no recomputation.  The
    shuffle files of the write go as it ends.  With ``by``, its last column,
    a filter on that reads only the rows asked for.  ``release`` removes the
    folder."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    with shuffles_removed(spark):
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(by) if by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._spilled = (path,)
    return out


def release(*frames: DataFrame) -> None:
    """Remove the folders behind frames of ``spill`` (or of what was built on
    one and says so in ``_spilled``) once nothing reads them any more."""
    for df in frames:
        for path in getattr(df, "_spilled", ()):
            remove(df.sparkSession, path)
        df._spilled = ()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own on whatever file system it lies on."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)
