"""Session settings and materialisation that outlives a lost executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings for a large cluster. All may be changed by the caller's own session.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "racecast", shuffle_partitions: int = 8_000, **conf: str) -> SparkSession:
    """Session for the cluster; AQE merges the shuffle partitions a small job does not need."""
    builder = SparkSession.builder.appName(app)
    settings = {**CLUSTER_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str | None:
    """The folder all nodes share, from ``spark.checkpoint.dir``; None where it is unset, on any master."""
    return spark.conf.get("spark.checkpoint.dir", None)


def scratch_folder(spark: SparkSession) -> str:
    """A new place for files in the shared folder; on one machine without that setting, in a temporary folder."""
    folder = shared_folder(spark)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        folder = tempfile.mkdtemp(prefix="racecast-")
    path = f"{folder.rstrip('/')}/racecast-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(partial(_delete, spark, path))
    return path


_scopes: list[list[Callable[[], object]]] = []


@contextmanager
def intermediates() -> Iterator[None]:
    """Drop at the end what ``materialise`` kept inside: results must have been written or fetched by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for drop in _scopes.pop():
            drop()


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Compute ``df`` once for several readers.

    Written as a table to the shared folder, so a lost executor costs one re-read and each reader
    scans only its columns. Without such a folder the rows are kept by ``persist``, with the plan as
    the way back. Inside ``intermediates`` it is dropped at the end of that block; otherwise it is left
    to the owner of the folder or session.

    With ``by`` the rows are dealt out by these columns once and kept so, as a bucketed table in the shared folder: joins
    and groupings on them need no further exchange.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if by:
        df = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *by)
    if folder is None:
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        drop = kept.unpersist
    else:
        name = uuid.uuid4().hex
        path = f"{folder.rstrip('/')}/racecast-{spark.sparkContext.applicationId}/{name}"
        drop = partial(_delete, spark, path)
        if by:
            table = f"racecast_{name}"
            buckets = df.write.format("parquet").option("path", path)
            n = int(spark.conf.get("spark.sql.shuffle.partitions"))
            buckets.bucketBy(n, *by).saveAsTable(table)
            kept = spark.table(table)
            drop = partial(_drop_table, spark, table, drop)
        else:
            df.write.parquet(path)
            kept = spark.read.schema(df.schema).parquet(path)
    if _scopes:
        _scopes[-1].append(drop)
    return kept


def _drop_table(spark: SparkSession, table: str, delete: Callable[[], object]) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    delete()
