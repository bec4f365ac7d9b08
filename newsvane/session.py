"""Session set-up and the few session-level helpers jobs share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A table may be hinted for broadcast only up to this many bytes (checked, see `broadcast_if_small`).
BROADCAST_LIMIT_BYTES = 256 * 1024 * 1024


def build_session(app: str = "newsvane", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # Keyed state of streams lies on disk, not on the heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediates: `spark.checkpoint.dir`, else one beside the warehouse.

    The same on every master. A cluster names a folder that all executors reach; where none is
    named, the warehouse is shared all the same.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
    sc.setCheckpointDir(path)
    return path


def stage(df: DataFrame, name: str, rows_per_file: int = 0) -> tuple[DataFrame, str]:
    """Write an intermediate table to the shared folder; the table read back, and where it lies.

    A reader holds thousands of rows of a file at once: large rows need a bound on those of a file.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stage_buckets(
    df: DataFrame, name: str, by: Iterable[str], buckets: int, rows_per_file: int = 0
) -> tuple[DataFrame, str, str]:
    """Write an intermediate table cut into ``buckets`` by a hash of ``by``, so that a join or a group
    on ``by`` reads it where it lies; the table, where it lies, and the name it has in the catalog.

    A frame that is partitioned so already writes one file per bucket, or one for ``rows_per_file`` rows.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged/{table}"
    written = df.write.format("parquet").option("path", path).option("maxRecordsPerFile", rows_per_file)
    written.bucketBy(buckets, *by).saveAsTable(table)
    return spark.read.table(table), path, table


def discard(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete staged tables that nothing reads any more."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def frugal(spark: SparkSession, batch_bytes: int) -> Iterator[None]:
    """Meanwhile no more than about ``batch_bytes`` go to a Python worker at once, and a query's shuffle files are
    deleted when it ends. For steps that stage what they make; neither changes a result."""
    wanted = {
        "spark.sql.execution.arrow.maxBytesPerBatch": str(batch_bytes),
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    }
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write an intermediate to the shared checkpoint folder, so losing an executor loses no work."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, rows: int, bytes_per_row: int, limit: int | None = None) -> DataFrame:
    """Hint a broadcast only when ``rows`` (a measured count) keeps it under the limit.

    Above the limit the frame is returned unhinted: Spark then shuffles both sides and AQE splits
    the skewed partitions.
    """
    return F.broadcast(df) if rows * bytes_per_row <= (BROADCAST_LIMIT_BYTES if limit is None else limit) else df


def hashed(df: DataFrame, rows: int, bytes_per_row: int, limit: int | None = None) -> DataFrame:
    """As `broadcast_if_small`, for a frame whose join keys are unique: above the limit it is shuffled and
    hashed by part, so neither side of the join is sorted."""
    small = rows * bytes_per_row <= (BROADCAST_LIMIT_BYTES if limit is None else limit)
    return broadcast_if_small(df, rows, bytes_per_row, limit) if small else df.hint("shuffle_hash")
