"""Where staged tables go: the shared folder the cluster names, never a worker's own disk."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

CHECKPOINT_KEY = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_root: dict[str, str] = {}
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)
_writers: dict[str, int] = {}
_asked: dict[str, str | None] = {}
_lock = threading.Lock()


def shared_root(spark: SparkSession) -> str:
    """The folder set in ``spark.checkpoint.dir``; a temporary one only where nothing is set (local tests)."""
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        _local_root[app] = tempfile.mkdtemp(prefix="rookery-")
    return _local_root[app]


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_root(spark)}/rookery/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of the writes inside go as soon as a write is done, not when the driver happens to collect garbage.

    The setting of the session comes back with the last of several writers that run side by side.
    """
    app = spark.sparkContext.applicationId
    with _lock:
        _writers[app] = _writers.get(app, 0) + 1
        if _writers[app] == 1:
            _asked[app] = spark.conf.get(SHUFFLE_CLEANUP, None)
            spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            _writers[app] -= 1
            if not _writers[app]:
                before = _asked.pop(app)
                spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders of the tables staged inside, by this thread or ``side_by_side``."""
    folders: list[str] = []
    token = _scratch.set(folders)
    try:
        yield folders
    finally:
        _scratch.reset(token)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end: only what is written elsewhere remains of them."""
    with recorded() as folders:
        try:
            yield
        finally:
            for path in folders:
                remove_folder(spark, path)


def side_by_side(jobs: int) -> ThreadPoolExecutor:
    """Threads for jobs that do not depend on one another; what they stage belongs to the caller's ``scratch``."""
    return ThreadPoolExecutor(jobs, initializer=_scratch.set, initargs=(_scratch.get(),))


def stage(df: DataFrame, label: str, *, partition_by: tuple[str, ...] = (), rows_per_file: int = 0) -> DataFrame:
    """Write a frame once and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    if (kept := _scratch.get()) is not None:
        kept.append(path)
    writer = df.write.option("compression", "zstd").option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_removed(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder of any store that Spark reads; none where it does not exist."""
    files, place = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()) if files.exists(place) else []


def file_paths(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """The files of a folder of any store that Spark reads whose names fit a pattern, in order; none where it does not exist."""
    files, place = _file_system(spark, path)
    fitting = files.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place, pattern)) if files.exists(place) else None
    return sorted(s.getPath().toString() for s in fitting or [] if s.isFile())


def join_files(spark: SparkSession, paths: Sequence[str], target: str) -> None:
    """The bytes of the files in order as one file; each goes as soon as it is copied, so the disk holds one twice at most."""
    files, place = _file_system(spark, target)
    files.mkdirs(place.getParent())
    jvm = spark.sparkContext._jvm
    out = files.create(place, False)
    try:
        for path in paths:
            part = jvm.org.apache.hadoop.fs.Path(path)
            source = files.open(part)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
            finally:
                source.close()
            files.delete(part, False)
    finally:
        out.close()


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the writer of a folder has finished."""
    files, place = _file_system(spark, f"{path}/_SUCCESS")
    return files.exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A frame from query parameters, as a local relation: its size is known, so Spark may broadcast it."""
    struct = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in struct]
    table = pa.Table.from_arrays(
        [pa.array(list(values), type=field.type) for values, field in zip(columns, to_arrow_schema(struct))],
        names=struct.names,
    )
    return spark.createDataFrame(table, schema=struct)
