"""Intermediate tables on shared storage.

A frame that several jobs read is written once as parquet under the folder
the cluster names in `spark.checkpoint.dir`.  That cuts lineage in a way that
survives the loss of executors, keeps column pruning and filter pushdown, and
gives the planner real sizes.
"""

from __future__ import annotations

import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

#: Bytes of a table that a task reads where it counts what is mostly distinct: so much fits its hash table.
SPLIT = 16 << 20

_SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
_READ_BUCKETS = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_roots: dict[str, str] = {}
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


class _Run:
    """A folder of tables named in the order in which a run writes them; complete ones are its manifest."""

    def __init__(self, folder: str):
        self.folder = folder
        self.written: Counter[str] = Counter()

    def path(self, name: str) -> str:
        self.written[name] += 1
        return f"{self.folder}/{name}-{self.written[name]}"


_run: ContextVar[_Run | None] = ContextVar("scratch_run", default=None)
_bucket_key: ContextVar[str | None] = ContextVar("bucket_key", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables; a temporary one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    root = configured or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = context.applicationId
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="gramloom-")
        return _local_roots[app]
    return f"{root.rstrip('/')}/{context.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _file(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of a path, and the path."""
    context = spark.sparkContext
    file = context._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(context._jsc.hadoopConfiguration()), file


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, from the working folder if it is relative; catalogs have other ideas of relative ones."""
    system, file = _file(spark, path)
    return system.makeQualified(file).toString()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and all below it, if it is there."""
    system, folder = _file(spark, path)
    system.delete(folder, True)


@contextmanager
def scratch_run(spark: SparkSession, folder: str | None = None) -> Iterator[None]:
    """Keep the tables that are written within in one folder, and delete it when the run has ended well.

    Given a folder on shared storage, a run that failed leaves it, and the same run started again in the same folder
    reads the tables that are complete instead of writing them anew.  The run must have the
    same inputs and settings then.  Without a folder nothing is left in either case.
    """
    run = _Run(folder or scratch_path(spark, "run"))
    token = _run.set(run)
    ended = False
    try:
        yield
        ended = True
    finally:
        _run.reset(token)
        if ended or folder is None:
            delete_folder(spark, run.folder)


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Jobs within read SPLIT bytes a task, unless the session names a size itself."""
    if spark.conf.get(_SPLIT_BYTES, None) is not None:
        yield
        return
    spark.conf.set(_SPLIT_BYTES, SPLIT)
    try:
        yield
    finally:
        spark.conf.unset(_SPLIT_BYTES)


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run within go when it has run, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


@contextmanager
def in_buckets(key: str) -> Iterator[None]:
    """Tables written within are bucketed by a column, as finely as shuffles deal rows.

    What an aggregation by that column alone hands on lies in its buckets already, so this takes no shuffle of its own.
    """
    token = _bucket_key.set(key)
    try:
        yield
    finally:
        _bucket_key.reset(token)


def bucket_count(spark: SparkSession) -> int:
    """As many buckets as a shuffle has partitions before they are coalesced."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def _table_name(spark: SparkSession) -> Iterator[str]:
    """A name in the catalog for a moment: buckets are known to tables only.  The files stay."""
    name = f"gramloom_{uuid.uuid4().hex}"
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_buckets(frame: DataFrame, path: str, key: str, buckets: int, row_group: int | None = None, append: bool = False) -> None:
    """Write rows to the buckets of a folder, which is emptied first unless they are to be added."""
    spark = frame.sparkSession
    if not append:
        delete_folder(spark, path)
    with _table_name(spark) as name, shuffles_end(spark):
        if append:
            _create(spark, name, path, _ddl(frame), key, buckets)
        writer = frame.write.format("parquet").mode("append").bucketBy(buckets, key)
        # Adding to a table takes its options from the session, which names no size of row groups.
        for option, value in (("path", path), ("compression", "zstd"), ("parquet.block.size", row_group)):
            writer = writer.option(option, value) if value else writer
        writer.saveAsTable(name)


def _ddl(frame: DataFrame) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in frame.schema)


def _create(spark: SparkSession, name: str, path: str, schema: str, key: str, buckets: int) -> None:
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING parquet OPTIONS (compression 'zstd') "
        f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{quoted}'"
    )


@contextmanager
def buckets_stay(spark: SparkSession) -> Iterator[None]:
    """Tables in buckets are read bucket by bucket within, also where Spark sees no use for that."""
    before = spark.conf.get(_READ_BUCKETS, "true")
    spark.conf.set(_READ_BUCKETS, "false")
    try:
        yield
    finally:
        spark.conf.set(_READ_BUCKETS, before)


def read_buckets(spark: SparkSession, path: str, schema: str, key: str, buckets: int) -> DataFrame:
    with _table_name(spark) as name:
        _create(spark, name, path, schema, key, buckets)
        return spark.table(name)


def write_table(frame: DataFrame, name: str, row_group: int | None = None) -> DataFrame:
    """Write a frame once and hand back a scan of it; within a run that goes on, a table that is complete is read.

    Its shuffle files go once it is written, so that the disk holds those of one table at a time.  A task reads whole row groups, so smaller ones than usual let tasks be smaller.
    """
    spark = frame.sparkSession
    run = _run.get()
    path = run.path(name) if run else scratch_path(spark, name)
    if run:
        system, marker = _file(spark, f"{path}/_SUCCESS")
        complete = system.exists(marker)
    key, buckets = _bucket_key.get(), bucket_count(spark)
    if key:
        path = qualified(spark, path)
        if not run or not complete:
            write_buckets(frame, path, key, buckets, row_group)
        table = read_buckets(spark, path, _ddl(frame), key, buckets)
        _paths[table] = path
        return table
    if not run or not complete:
        writer = frame.write.mode("overwrite").option("compression", "zstd")
        if row_group:
            writer = writer.option("parquet.block.size", row_group)
        with shuffles_end(spark):
            writer.parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    _paths[table] = path
    return table


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables that `write_table` wrote, once nothing reads them any more."""
    for table in tables:
        path = _paths.pop(table, None)
        if path is not None:
            delete_folder(table.sparkSession, path)

