"""Intermediate tables of the operators, kept where every executor reaches them."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faremill.storage import scratch_path


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """Writes ``df`` as Parquet below ``spark.checkpoint.dir`` and gives it back as a scan.

    The files outlive lost executors and cut the lineage. They belong to a result that is computed later, so
    they stay until the shared folder is cleared.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: In a worker process: calls that drop what operators keep there for their next task.
KEEPERS: list[Callable[[], object]] = []


def let_go() -> None:
    """Drops what other operators keep in this worker process; for the begin of a task that needs the memory itself.

    Workers live on from job to job. The allocator gives freed memory back only when asked, where it can be.
    """
    if KEEPERS:
        for forget in list(KEEPERS):
            forget()
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


#: Rows of whole texts that cross to a Python worker at once.
TEXT_ROWS = 1000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def with_text_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches hold at most TEXT_ROWS rows.

    Spark's own 10,000 rows suit numbers; of whole texts they take hundreds of megabytes in each worker and
    as much again outside the heap. A lower setting of the session is kept. Results do not depend on it.
    """
    conf = df.sparkSession.conf
    rows = int(conf.get(_BATCH_ROWS, "10000"))
    if rows <= 0 or rows > TEXT_ROWS:
        conf.set(_BATCH_ROWS, str(TEXT_ROWS))
    return df
