"""Small helpers shared by the operators: folds, staging, batches of texts, the query registry."""

from __future__ import annotations

import gc
import hashlib
import sys
import types
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayline.session import scratch_path

T = TypeVar("T")
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Words are runs of anything but space and the five control characters of white space.
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold kept from training: crc32 of the id as text leaves 2 modulo 4.  A null id is not
    in it (and is not learned from either, see ``in_training``)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def in_training(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 != 2, F.lit(False))


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_keys(docs: DataFrame, key: str = "_row") -> DataFrame:
    """``docs`` and a number of its own for each row, the same whenever it is read: the place of the
    row in its Parquet file.  What is not read from files is written once."""
    spark = docs.sparkSession
    try:
        placed = docs.select(
            "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias(key)
        )
    except AnalysisException:
        return staged(docs.withColumn(key, F.monotonically_increasing_id()), "rows")
    # One row per file, numbered in one task; Spark broadcasts the table where it is small.
    files = placed.select("_file").distinct().repartition(1).sortWithinPartitions("_file")
    names = files.select(
        F.monotonically_increasing_id().alias("_place"), F.col("_file").alias("_name")
    )
    names = staged(names, "files")
    return (
        placed.join(names, F.col("_file") == F.col("_name"))
        .withColumn(key, F.shiftleft("_place", 40) + F.col(key))
        .select(*docs.columns, key)
    )


def slices(batches: Iterator[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    """Arrow batches in small runs of rows, so that Python strings of few texts exist at a time.

    A worker process runs many tasks.  The functions of an earlier task, and the models in them, are
    reference cycles that Python would keep for long, as few objects are made: they go first, and
    with them the buffers that Arrow keeps for later."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def per_worker(kind: str, content: bytes, make: Callable[[], T]) -> T:
    """``make()``, kept for all tasks that a worker process runs on the same ``content``.  Functions
    travel by value, with module variables of their own in each task; a module made in the worker
    outlives them."""
    kept = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__
    key = f"{kind}-{hashlib.blake2b(content, digest_size=16).hexdigest()}"
    if key not in kept:
        kept[key] = make()
    return kept[key]
