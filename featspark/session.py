"""Session helpers.

Settings are only filled in where the caller has not set them, so a cluster
configuration (shuffle partitions, checkpoint folder) always wins.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    # Local runs use as many shuffle partitions as cores; coalescing them by
    # bytes (>= 1 MB each) would put heavy-per-row stages of small test data
    # on one core.  Cluster sessions keep Spark's default (coalescing on).
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # PySpark 4 records the Python call site of every Column call for error
    # messages (a JVM round trip each); wide plans build much faster without
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "featspark") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in _LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
    b = b.config("spark.driver.memory", os.environ.get("FEATSPARK_DRIVER_MEM", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder of the session, or None.

    Read from the context or from ``spark.checkpoint.dir``; library code
    never invents one (a machine-local folder is wrong on a cluster).
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    return None


class NoSharedFolder(RuntimeError):
    pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder: the configured one, else, in local mode only, a scratch
    folder; on a cluster a machine-local folder would be wrong, so it must be set."""
    d = checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="featspark-ckpt-"))
        d = spark.sparkContext.getCheckpointDir()
    return d


def drop_at_end(spark: SparkSession, path: str) -> None:
    """Have ``path`` (an existing folder) deleted when the driver ends: results that
    read it are lazy, so it cannot go earlier."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


_ROOTS: set[str] = set()


def shared_dir(spark: SparkSession, what: str) -> str:
    """A fresh path for ``what`` in this application's folder below the shared
    checkpoint folder; the application's folder goes when the driver ends."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/featspark-{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
        drop_at_end(spark, root)
        _ROOTS.add(root)
    return f"{root}/{what}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several jobs will read.

    Reliable ``checkpoint()`` into the shared checkpoint folder (survives
    executor loss; never ``localCheckpoint``).  The folder is the session's; a
    scratch folder is taken only where none is set.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with ``values`` set; its own settings come back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def batches(spark: SparkSession) -> dict[str, str]:
    """Setting for jobs that take wide rows to Python: no more than ``BATCH`` rows at a time."""
    now = int(spark.conf.get(ARROW))
    return {ARROW: str(min(now, BATCH) if now > 0 else BATCH)}


def written(df: DataFrame, what: str, tasks: int = 0, by: str = "") -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: like
    ``materialize``, for frames of which later steps read a few columns.
    The table is deleted when the driver ends, the shuffle files of the write when it is
    over.  With ``tasks`` the shuffles of the write have at least so many partitions; with
    ``by`` there is a folder per value of that column (the session's own settings come back)."""
    spark = df.sparkSession
    path = shared_dir(spark, what)
    shuffles = max(tasks, int(spark.conf.get(SHUFFLES)))
    with settings(spark, {CLEANUP: "true", WRITERS: "8", SHUFFLES: str(shuffles), **batches(spark)}):
        w = df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP)
        (w.partitionBy(by) if by else w).parquet(path)
    # the schema is known (a table without rows has no files); Parquet knows no NOT NULL
    return spark.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns])


ARROW = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of 10 KB that a Python worker is sent together.
BATCH = 2000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Files that a task keeps open, so that it need not sort its rows by folder.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: Bytes that a task holds before it writes them to a Parquet file.
ROW_GROUP = 32 << 20
SHUFFLES = "spark.sql.shuffle.partitions"
#: Rows of a few hundred bytes that one task sorts: about 100 MB.
ROWS_A_TASK = 250_000


def tasks_for(df: DataFrame, rows: int = ROWS_A_TASK) -> int:
    """Partitions of about ``rows`` rows for the table ``df`` (counted, from its footers
    if it is a file), so that what one task holds does not grow with the table; never
    fewer than the session's."""
    return max(int(df.sparkSession.conf.get(SHUFFLES)), -(-df.count() // rows))


def in_tasks(df: DataFrame, rows: int = ROWS_A_TASK) -> DataFrame:
    """The table ``df`` in tasks of about ``rows`` rows, but one per core at least: iterative fits
    run hundreds of stages over it, and a task takes some milliseconds however small it is."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows)))
