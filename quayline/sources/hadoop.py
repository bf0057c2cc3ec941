"""Slots on any Hadoop file system, read by Spark itself.

For ``hdfs://``, ``s3a://``, ``gs://``, ``ftp://`` or ``sftp://`` paths whose file system is on the
cluster's class path; credentials come from the Hadoop configuration.  Files are listed by Spark's
own (parallel) listing.
"""

from __future__ import annotations

import codecs
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayline.functions.text import GZIP_HEADER
from quayline.operators.payload import payload_lines


def hadoop_slots(
    spark: SparkSession, path: str, recursive: bool = False, glob: str | None = None
) -> DataFrame:
    """``name, date, length, content`` of the files below ``path``, named by their full path.

    It is a catalogue and a payload at once: content is read only where it is selected, after
    filters on the other columns have dropped files.  Content is one cell, below 2 GiB: for binary
    files.  Lines of files of any size come from ``hadoop_lines`` and from connectors.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        F.col("path").alias("name"), F.col("modificationTime").alias("date"), "length", "content"
    )


# Endings of names whose files Spark's text reader unpacks.
UNPACKED = r"\.(gz|bz2|deflate|lz4|snappy|zst)$"
# A gzip file begins with these; a line end is not among them.
GZIP_START = b"\x1f\x8b\x08"
# Contents up to this are read into one cell where they may be packed.
WHOLE_BYTES = 512 << 20
# Splits whose numbers are broadcast: one row each.
BROADCAST_SPLITS = 1_000_000


def _decoded(uri: Column) -> Column:
    """The path that a URI stands for, as ``hadoop_slots`` has it."""
    plus = F.replace(uri, F.lit("+"), F.lit("%2B"))
    return F.when(F.contains(uri, F.lit("%")), F.url_decode(plus)).otherwise(uri)


def _text_rows(
    spark: SparkSession, path: str, recursive: bool, glob: str | None, whole_bytes: int
) -> DataFrame:
    """Lines as bytes with the split they are from and a number that grows within it."""
    reader = spark.read.option("recursiveFileLookup", recursive)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    about = F.col("_metadata")
    lines = reader.text(path)
    # Filters on names and sizes choose files, before any is opened.
    packed = about["file_name"].rlike(UNPACKED) & (about["file_size"] <= whole_bytes)
    return lines.filter(~packed).select(
        _decoded(about["file_path"]).alias("slot"),
        about["file_modification_time"].alias("slot_date"),
        about["file_size"].alias("size"),
        about["file_block_start"].alias("start"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").cast("binary").alias("value"),
    )


def hadoop_lines(
    spark: SparkSession,
    path: str,
    recursive: bool = False,
    glob: str | None = None,
    charset: str = "UTF-8",
    line_numbers: bool = True,
    whole_bytes: int = WHOLE_BYTES,
) -> DataFrame:
    """``slot, slot_date, line_no, value``: the lines of the files below ``path``, named by their full
    path and decided by content: what begins like a gzip file is gunzipped, whatever its name.

    Plain files are cut into splits that tasks read side by side.  A line's number is its place in its
    split plus the lines of the splits before, which are counted by one more reading; without
    ``line_numbers`` it is null.  Whether a file is packed is seen by a first reading of all files.
    Packed files, and those whose names say so, are read whole, up to ``whole_bytes`` each; a larger
    one whose name says that it is packed is taken at its word, and one whose name does not is an error.

    Malformed UTF-8 becomes U+FFFD; a byte order mark at the start of a plain UTF-8 file is dropped.
    UTF-8, ASCII and ISO-8859-1 are read in splits; files of any other charset are read whole.
    """
    name = codecs.lookup(charset).name
    everything = hadoop_slots(spark, path, recursive, glob)
    if name not in ("utf-8", "ascii", "iso8859-1"):
        return _numbered(payload_lines(everything, charset), line_numbers)
    rows = _text_rows(spark, path, recursive, glob, whole_bytes)
    begins = F.substring("value", 1, 3) == F.lit(GZIP_START)
    heads = rows.filter((F.col("start") == 0) & begins & (F.col("size") >= GZIP_HEADER))
    # The first line of a file has the least number of its split.
    first = rows.filter("start = 0").groupBy("slot").agg(F.min("at").alias("first"))
    heads = heads.join(first, "slot").filter("at = first").select("slot", "size")
    said = everything.filter(F.col("name").rlike(UNPACKED) & (F.col("length") <= whole_bytes))
    # Names of files, of which the driver holds a list in any case.
    disguised = heads.collect()
    large = [r["slot"] for r in disguised if r["size"] > whole_bytes]
    if large:
        raise ValueError(f"gzip files of more than {whole_bytes} bytes need a name that says so: {large[:3]}")
    hidden = [r["slot"] for r in disguised]
    plain = rows.filter(~F.col("slot").isin(hidden)) if hidden else rows
    text = F.make_valid_utf8(F.col("value").cast("string"))
    if name == "iso8859-1":
        text = F.decode("value", "ISO-8859-1")
    elif name == "ascii":
        text = F.regexp_replace(F.decode("value", "ISO-8859-1"), r"[^\x00-\x7f]", "\ufffd")
    plain = (_placed(plain) if line_numbers else plain.withColumn("line_no", F.lit(None).cast("long")))
    lines = plain.select("slot", "slot_date", "line_no", text.alias("value"))
    lines = lines.unionByName(_numbered(payload_lines(said, charset), line_numbers))
    if hidden:
        contents = spark.read.format("binaryFile").load([_literal(h) for h in hidden])
        packed = contents.select(
            F.col("path").alias("name"), F.col("modificationTime").alias("date"), "content"
        )
        lines = lines.unionByName(_numbered(payload_lines(packed, charset), line_numbers))
    return lines


def _literal(path: str) -> str:
    """A path in which nothing stands for other names."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def _numbered(lines: DataFrame, line_numbers: bool) -> DataFrame:
    return lines if line_numbers else lines.withColumn("line_no", F.lit(None).cast("long"))


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``line_no``.  The counts are part of the same plan, so that both readings cut the
    files alike."""
    splits = rows.groupBy("slot", "start").agg(
        F.count(F.lit(1)).alias("lines"), F.min("at").alias("first")
    )
    # One row per split: a file of any size is a small group here.
    earlier = Window.partitionBy("slot").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    before = splits.select(
        F.col("slot").alias("_slot"),
        F.col("start").alias("_start"),
        (F.coalesce(F.sum("lines").over(earlier), F.lit(0)) - F.col("first")).alias("_shift"),
    )
    if rows.rdd.getNumPartitions() <= BROADCAST_SPLITS:
        before = F.broadcast(before)
    same = (F.col("slot") == F.col("_slot")) & (F.col("start") == F.col("_start"))
    return rows.join(before, same).withColumn("line_no", F.col("at") + F.col("_shift"))
