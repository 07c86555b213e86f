"""Folders: the shared scratch area, and Hadoop file system calls on named paths."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from itertools import islice

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
#: File system calls at a time, and paths that wait for them.
CALL_THREADS = 16
CALL_BATCH = 1000


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors reach: as the cluster names it, else one in the warehouse, which is shared too."""
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/faremill-scratch").rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/faremill-{purpose}-{uuid.uuid4().hex}"


@contextmanager
def stored(spark: SparkSession, df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """Writes ``df`` to the shared folder and gives it back as a scan, for several readers.

    The written files outlive a lost executor, unlike cached blocks.
    """
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)


@contextmanager
def small_splits(spark: SparkSession, most: int) -> Iterator[None]:
    """Scans that run inside give a task ``most`` bytes of files at most; a lower setting of the session is kept."""
    before = spark.conf.get(SPLIT_BYTES)
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(SPLIT_BYTES, str(min(size, most)))
    try:
        yield
    finally:
        spark.conf.set(SPLIT_BYTES, before)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def tree_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Files below a path, or the file itself, and folders below it; none where there is no such path."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return 0, 0
    summary = fs.getContentSummary(target)
    return summary.getFileCount(), max(0, summary.getDirectoryCount() - 1)


def file_count(spark: SparkSession, path: str) -> int:
    """Files below a path; 0 when there is no such path."""
    return tree_size(spark, path)[0]


def delete_path(spark: SparkSession, path: str) -> bool:
    """Deletes a file or a whole folder; False when there was none."""
    fs, target = _file_system(spark, path)
    return fs.delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)


def in_parallel(call: Callable[[str], object], paths: Iterable[str]) -> int:
    """Calls ``call`` on every path from a few threads, holding one batch of paths at a time; how many there were."""
    names = iter(paths)
    done = 0
    with ThreadPoolExecutor(CALL_THREADS) as pool:
        while batch := list(islice(names, CALL_BATCH)):
            done += len(list(pool.map(call, batch)))
    return done


def missing(spark: SparkSession, paths: list[str]) -> set[str]:
    """Those of the given paths where nothing is."""
    gone: list[str] = []
    in_parallel(lambda path: path_exists(spark, path) or gone.append(path), paths)
    return set(gone)


def delete_empty(spark: SparkSession, folder: str) -> bool:
    """Deletes a folder that holds nothing; anything in it keeps it."""
    fs, target = _file_system(spark, folder)
    try:
        return fs.delete(target, False)
    except Py4JJavaError:
        return False


def matching(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Paths below a folder that match a glob pattern of few matches."""
    fs, target = _file_system(spark, folder)
    # Characters of the folder's own name are no pattern.
    plain = "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in target.toString())
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(plain + pattern))
    return [status.getPath().toString() for status in found or []]


def qualified(spark: SparkSession, path: str) -> str:
    """The path as listings show it, with scheme and authority."""
    fs, target = _file_system(spark, path)
    return fs.makeQualified(target).toString()


def children(spark: SparkSession, folder: str) -> Iterator[tuple[str, bool]]:
    """Path and whether it is a folder, of every direct entry; the listing is streamed, not held."""
    fs, target = _file_system(spark, folder)
    if fs.exists(target):
        entries = fs.listStatusIterator(target)
        while entries.hasNext():
            entry = entries.next()
            yield entry.getPath().toString(), entry.isDirectory()


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """One atomic move within a file system; False where the source is not there or the target is taken."""
    fs, here = _file_system(spark, source)
    there = _file_system(spark, target)[1]
    if not fs.exists(here) or fs.exists(there):
        return False
    try:
        return fs.rename(here, there)
    except Py4JJavaError as error:
        if "FileNotFoundException" in str(error.java_exception):
            return False
        raise


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Moves one file, between file systems too; what stood at ``target`` is replaced."""
    here, source_path = _file_system(spark, source)
    there, target_path = _file_system(spark, target)
    there.mkdirs(target_path.getParent())
    there.delete(target_path, True)
    if here.getUri().equals(there.getUri()) and here.rename(source_path, target_path):
        return
    copy_file(spark, source, target, delete_source=True)


def copy_file(spark: SparkSession, source: str, target: str, delete_source: bool = False) -> None:
    here, source_path = _file_system(spark, source)
    there, target_path = _file_system(spark, target)
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files.copy(here, source_path, there, target_path, delete_source, conf)
