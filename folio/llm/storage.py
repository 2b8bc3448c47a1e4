"""Lineage cuts and row identity shared by the operators."""

from __future__ import annotations

import atexit
import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.session import ensure_checkpoint_dir

_held: list[tuple] = []  # (weak reference to the file index that every plan over a table shares, session, path)


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the cluster's shared checkpoint folder, and read back.

    Cuts the lineage at a place that outlives any executor; the statistics of the files let Spark
    decide by size whether a later join may broadcast. The table is removed once no plan can read it any more
    (as Spark's own cleaner removes shuffles), at the latest when the program ends.
    """
    path = f"{ensure_checkpoint_dir(spark)}/folio-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    index = out._jdf.queryExecution().analyzed().relation().location()
    _held.append((spark._jvm.java.lang.ref.WeakReference(index), spark, path))
    del index
    release(spark)
    return out


def release(spark: SparkSession) -> None:
    """Let go of what finished steps left: shuffle files and written tables that nothing refers to any more.

    Without it they stay until the driver happens to collect garbage, and disks hold the sum of all
    steps in place of the largest one.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    _remove([h for h in _held if h[0].get() is None])


def _remove(tables: list[tuple]) -> None:
    for table in tables:
        _, spark, path = table
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        _held.remove(table)


@atexit.register
def _remove_all() -> None:
    for table in list(_held):
        try:
            _remove([table])
        except Exception:  # noqa: BLE001 - the program ends, and with it perhaps already the JVM
            return


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of ``rows`` rows at most in the jobs that run inside: whole texts make them large, in the JVM and in the Python worker beside it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), rows) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, crc, text): only the two columns used, so further columns of any name can't clash.

    ``crc`` tells rows apart that repeat a doc_id with another text.
    """
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("crc"),
        F.col(text_col).alias("text"))
