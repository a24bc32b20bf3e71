"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. ANSI arithmetic keeps decimal overflow loud,
# AQE re-plans joins from runtime sizes and splits skewed shuffle partitions.
ENGINE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # keyed state of streams on disk, not in the executors' heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[*]", app: str = "starweave",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs. On a cluster, pass the cluster's own
    master and let spark-submit supply resources."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**ENGINE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator to a shared filesystem; it is
    only filled in here when unset (local runs and tests), with a fresh
    scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster; "
                               "a machine-local scratch folder would not survive executor loss")
        d = tempfile.mkdtemp(prefix="starweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path for it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove_folder(spark: SparkSession, path: str) -> None:
    system, p = shared_path(spark, path)
    system.delete(p, True)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_open_scopes: list[list[str]] = []


@contextmanager
def released_cuts(spark: SparkSession):
    """Removes, when left, the tables that ``cut_lineage`` has written inside, and the
    shuffle files of each job inside as soon as it has ended: its results are
    written, and the driver's garbage collection, which else decides on them, may be
    long in coming. For jobs that have written their results by then; frames that
    still read such tables must not leave the block."""
    made: list[str] = []
    _open_scopes.append(made)
    kept = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        _open_scopes.remove(made)
        spark.conf.set(FREE_SHUFFLES, kept)
        for path in made:
            remove_folder(spark, path)


ROWS_PER_FILE = 1 << 17


def files_for(spark: SparkSession, rows: int) -> int:
    """Files for so many short rows: one for ROWS_PER_FILE, and for each core."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_FILE))


def cut_lineage(df, rows: int | None = None):
    """Truncate lineage by writing the rows as a Parquet table in the shared
    checkpoint folder and reading them back.

    Never a local checkpoint: a lost executor would take those blocks with it.
    Compared with ``Dataset.checkpoint`` (which computes the plan in one job
    and writes it in a second) this is a single write job, and the re-read
    plan carries file statistics, so the planner can broadcast a small result.
    The table stays for as long as the frame may be read; ``released_cuts``
    bounds that time.

    ``rows``, a bound of the frame's rows where one is known: the table gets
    as many files as ``files_for`` has for them, not one for each shuffle partition. Every file costs the store calls, and a local
    one two processes that set its mode.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(files_for(spark, rows))
    path = os.path.join(ensure_checkpoint_dir(spark), "cut", uuid.uuid4().hex)
    if _open_scopes:
        _open_scopes[-1].append(path)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
