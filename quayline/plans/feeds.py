"""Catalogues, payloads, polls and files derived from the given tables."""

from __future__ import annotations

import gzip
import itertools
import uuid
from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayline.functions.dcm import DCM_TYPES
from quayline.operators.payload import text_lines
from quayline.session import scratch_path
from quayline.sources.location import open_location

# One table type per user, so that all of them occur.
TABLE_TYPES = [t for t in DCM_TYPES if t.startswith("match_table_")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """For work on every row that costs more than moving it: a table read by fewer tasks than there
    are cores is hashed over all of them.  Tables with enough splits stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def order_slots_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as dated slots; one in ten has no date."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("order_"), "o_orderkey").alias("name"),
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderdate")).alias("date"),
        F.col("o_orderpriority").alias("priority"),
    )


def document_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as slots with text; one in ten has no date."""
    day = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(doc_id % 30 as int))")
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), "doc_id").alias("name"),
        F.when(F.col("doc_id") % 10 != 0, day).alias("date"),
        "doc_id",
        "lang",
        "text",
    )


def gzipped(payload: DataFrame, chosen: Column) -> DataFrame:
    """``name, date, content`` with the chosen rows' content compressed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = batch.column("packed").to_pylist()
            contents = [
                gzip.compress(content, 1, mtime=0) if flag and content is not None else content
                for content, flag in zip(batch.column("content").to_pylist(), flags, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("name"), batch.column("date"), pa.array(contents, pa.binary())],
                names=["name", "date", "content"],
            )

    flagged = payload.select("name", "date", "content", chosen.alias("packed"))
    return flagged.mapInArrow(pack, "name string, date timestamp_ntz, content binary")


def document_payload(spark: SparkSession, sf_dir: str, charset: str = "UTF-8") -> DataFrame:
    """Documents as bytes, every second one gzipped."""
    docs = spread(document_slots(spark, sf_dir), "name")
    docs = docs.withColumn("content", F.encode("text", charset))
    return gzipped(docs, F.col("doc_id") % 2 == 0)


def dcm_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as file names of a data-transfer bucket, some of them foreign."""
    daily, hourly = F.date_format("ts", "yyyyMMdd"), F.date_format("ts", "yyyyMMddHH")
    kind = F.col("event_type")
    tables = F.array(*[F.lit(t) for t in TABLE_TYPES])
    label = (
        F.when(kind == "purchase", F.concat(F.lit("activity_"), daily))
        .when(kind == "click", F.concat(F.lit("click_"), hourly))
        .when(kind == "view", F.concat(F.lit("impression_"), hourly))
        .when(
            kind == "signup",
            F.concat(
                F.element_at(tables, (F.col("user_id") % len(TABLE_TYPES) + 1).cast("int")),
                F.lit("_"),
                daily,
            ),
        )
        .otherwise(F.concat(F.lit("FOO_"), hourly))
    )
    name = F.concat(
        F.lit("dcm_account"), "user_id", F.lit("_"), label, F.lit("_"),
        F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit("_"), "event_id", F.lit(".csv.gz"),
    )
    return spread(table(spark, sf_dir, "events"), "event_id").select(name.alias("name"))


def event_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day's events as one listing of slots named by user and event type."""
    return table(spark, sf_dir, "events").select(
        F.date_trunc("DAY", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("poll"),
        F.concat_ws("_", "user_id", "event_type").alias("name"),
        F.col("ts").alias("date"),
    )


# Parts of the documents that become folders of files, and whether their files are gzipped.
PARTS_OF_DOCUMENTS = (("english", "lang = 'en'", True), ("other", "not (lang <=> 'en')", False))
DOCUMENTS_PER_FILE = 1000
MARK = "\ufeff"  # a text's first character, which tells the byte order


def write_document_files(docs: DataFrame, path: str, packed: bool) -> None:
    """Lines of documents as text files of ``DOCUMENTS_PER_FILE`` ids, one per folder ``bucket``,
    plain or gzipped.  A line is the document's id, the line's number in it and the line."""
    named = docs.withColumn("name", F.col("doc_id").cast("string"))
    lines = text_lines(named).select(
        F.col("slot").cast("long").alias("doc_id"),
        "line_no",
        F.concat_ws("\t", "slot", "line_no", "value").alias("value"),
    )
    placed = lines.withColumn("bucket", F.floor(F.col("doc_id") / DOCUMENTS_PER_FILE))
    (
        placed.repartition("bucket")
        .sortWithinPartitions("bucket", "doc_id", "line_no")
        .select("bucket", "value")
        .write.partitionBy("bucket")
        .option("compression", "gzip" if packed else "none")
        .text(path)
    )


def write_wide_files(docs: DataFrame, path: str, charset: str) -> None:
    """The lines of ``write_document_files`` in files ``bucket=N/lines.txt`` in ``charset``, which
    Spark's text writer does not offer.  A file gets its name when it is whole, so that a task that
    is run again replaces what an earlier attempt wrote."""
    bucket = F.floor(F.col("doc_id") / DOCUMENTS_PER_FILE)
    named = docs.withColumn("name", F.col("doc_id").cast("string"))
    lines = text_lines(named).select(
        F.col("slot").cast("long").alias("doc_id"),
        "line_no",
        F.concat_ws("\t", "slot", "line_no", "value").alias("value"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_location(path)
        rows = (
            row
            for batch in batches
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)
        )
        for number, own in itertools.groupby(rows, key=itemgetter(0)):
            place = f"{folder}/bucket={number}"
            store.create_dir(place, recursive=True)
            attempt = f"{place}/_{uuid.uuid4().hex}"
            with store.open_output_stream(attempt) as out:
                out.write(MARK.encode(charset))
                for _, value in own:
                    out.write(f"{value}\n".encode(charset))
            store.move(attempt, f"{place}/lines.txt")
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([number], pa.int64())})

    placed = lines.withColumn("bucket", bucket)
    written = (
        placed.repartition("bucket")
        .sortWithinPartitions("bucket", "doc_id", "line_no")
        .select("bucket", "value")
        .mapInArrow(run, "bucket long")
    )
    written.count()


_files: dict[tuple, str] = {}


def wide_document_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder below the shared one: documents by part as plain UTF-16, English ones with the low
    byte first, the others with the high byte first; written once."""
    key = (spark.sparkContext.applicationId, sf_dir, "wide")
    if key not in _files:
        base = scratch_path(spark, "documents")
        docs = document_slots(spark, sf_dir)
        for part, chosen, english in PARTS_OF_DOCUMENTS:
            order = "utf-16-le" if english else "utf-16-be"
            write_wide_files(docs.filter(chosen), f"{base}/{part}", order)
        _files[key] = base
    return _files[key]


def document_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder below the shared one: English documents gzipped, the others plain; written once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _files:
        base = scratch_path(spark, "documents")
        docs = document_slots(spark, sf_dir)
        for part, chosen, packed in PARTS_OF_DOCUMENTS:
            write_document_files(docs.filter(chosen), f"{base}/{part}", packed)
        _files[key] = base
    return _files[key]
