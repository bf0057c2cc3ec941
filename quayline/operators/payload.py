"""Slots to lines.

``fetch_lines`` streams each slot through a task: chunks are fetched, gunzipped, decoded and split
without holding the slot.  ``payload_lines`` does the same for contents that already sit in a
column, ``text_lines`` for text columns (JVM only).  All give ``slot, slot_date, line_no, value``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import closing

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayline.functions.text import (
    GZIP_HEADER,
    is_gzip,
    iter_blocks,
    lines_array,
    next_line_start,
    ordered_charset,
    split_lines,
    unit_width,
)
from quayline.operators.ordering import index_slots, one_slot_per_partition, slot_order
from quayline.session import stored
from quayline.sources.base import MAX_RETRIES, Connector, Fetcher
from quayline.sources.wanted import Wanted

LINE_KEYS = ("slot", "slot_date", "line_no")
# A batch leaves the task when it holds this many lines or characters.
LINES_PER_BATCH = 50_000
CHARS_PER_BATCH = 4 << 20
# Bytes in which the end of a line is looked for first; each further look takes so many times more.
LOOK_BYTES, LOOK_GROWTH = 16 << 10, 8
# Tasks per core that count the lines of ranges.
COUNT_TASKS = 32
# Slots that are looked at before all of a catalogue are numbered, and tasks that look side by side.
PEEK_SLOTS, PEEK_TASKS = 256, 256


def lines_schema(slots: DataFrame) -> T.StructType:
    """Schema of the lines of a catalogue; the date keeps the catalogue's own type."""
    date = slots.schema["date"].dataType if "date" in slots.columns else T.TimestampType()
    return T.StructType(
        [
            T.StructField("slot", T.StringType()),
            T.StructField("slot_date", date),
            T.StructField("line_no", T.LongType()),
            T.StructField("value", T.StringType()),
        ]
    )


def _keys(slots: DataFrame) -> list:
    date = F.col("date") if "date" in slots.columns else F.lit(None).cast("timestamp")
    return [F.col("name").alias("slot"), date.alias("slot_date")]


class _LineBatches:
    """Collects blocks of lines of consecutive slots into record batches."""

    def __init__(self, names: pa.Array, dates: pa.Array) -> None:
        self._names, self._dates = names, dates
        self._clear()

    def _clear(self) -> None:
        self._rows: list[int] = []
        self._counts: list[int] = []
        self._firsts: list[int] = []
        self._blocks: list[str] = []
        self._lines = self._chars = 0

    def add(self, row: int, first: int, block: str) -> int:
        """Add a block whose first line has number ``first``; gives its number of lines."""
        count = block.count("\n") + 1
        self._rows.append(row)
        self._counts.append(count)
        self._firsts.append(first)
        self._blocks.append(block)
        self._lines += count
        self._chars += len(block)
        return count

    @property
    def full(self) -> bool:
        return self._lines >= LINES_PER_BATCH or self._chars >= CHARS_PER_BATCH

    def take(self) -> Iterator[pa.RecordBatch]:
        if not self._blocks:
            return
        values = lines_array(self._blocks)
        counts = np.asarray(self._counts, np.int64)
        before = np.cumsum(counts) - counts
        numbers = np.arange(len(values)) + np.repeat(np.asarray(self._firsts) - before, counts)
        rows = np.repeat(np.asarray(self._rows, np.int64), counts)
        self._clear()
        for start in range(0, len(values), LINES_PER_BATCH):
            part = slice(start, start + LINES_PER_BATCH)
            slots = pa.array(rows[part])
            yield pa.RecordBatch.from_arrays(
                [
                    self._names.take(slots),
                    self._dates.take(slots),
                    pa.array(numbers[part], pa.int64()),
                    values[part],
                ],
                names=["slot", "slot_date", "line_no", "value"],
            )


def _lines_of_batch(
    batch: pa.RecordBatch, blocks_of: Callable[[int], Iterable[str]]
) -> Iterator[pa.RecordBatch]:
    """Lines of each row's slot, numbered from the row's ``first_line`` if there is one."""
    out = _LineBatches(batch.column("slot"), batch.column("slot_date"))
    firsts = batch.column("first_line").to_pylist() if "first_line" in batch.schema.names else None
    for row in range(batch.num_rows):
        number = firsts[row] if firsts else 0
        for block in blocks_of(row):
            number += out.add(row, number, block)
            if out.full:
                yield from out.take()
    yield from out.take()


def fetch_lines(
    slots: DataFrame,
    connector: Connector,
    charset: str = "UTF-8",
    max_retries: int = MAX_RETRIES,
    first_lines: int | None = None,
) -> DataFrame:
    """The lines of every slot in the catalogue, fetched where the catalogue row is.

    Partitioning is that of ``slots``; see ``one_slot_per_partition``.  With ``first_lines``, a slot
    is read only as far as that many lines take.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with closing(Fetcher(connector, max_retries)) as fetcher:
            for batch in batches:
                names = batch.column("slot").to_pylist()

                def blocks_of(row: int, names: list = names) -> Iterator[str]:
                    blocks = iter_blocks(fetcher.chunks(names[row]), charset)
                    if first_lines is None:
                        return blocks
                    return _head(blocks, first_lines, fetcher)

                yield from _lines_of_batch(batch, blocks_of)

    return slots.select(*_keys(slots)).mapInArrow(read, lines_schema(slots))


def _head(blocks: Iterator[str], lines: int, fetcher: Fetcher) -> Iterator[str]:
    """The first ``lines`` lines of a slot; its transfer is broken off behind them."""
    for block in blocks:
        parts = block.split("\n", lines)[:lines]
        yield "\n".join(parts)
        lines -= len(parts)
        if not lines:
            fetcher.close()
            return


def fetch_payload(
    slots: DataFrame, connector: Connector, max_retries: int = MAX_RETRIES
) -> DataFrame:
    """Whole contents, ``name, date, content``: for binary slots.  A slot must be below 2 GiB."""
    date = lines_schema(slots)["slot_date"].dataType
    schema = T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("date", date),
            T.StructField("content", T.BinaryType()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with closing(Fetcher(connector, max_retries)) as fetcher:
            for batch in batches:
                for row in range(batch.num_rows):
                    one = batch.slice(row, 1)
                    content = b"".join(fetcher.chunks(one.column("slot")[0].as_py()))
                    yield pa.RecordBatch.from_arrays(
                        [*one.columns, pa.array([content], pa.binary())],
                        names=["name", "date", "content"],
                    )

    return slots.select(*_keys(slots)).mapInArrow(read, schema)


def payload_lines(payload: DataFrame, charset: str = "UTF-8") -> DataFrame:
    """The lines of contents held in a ``content`` column."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents = batch.column("content")

            def blocks_of(row: int, contents: pa.Array = contents) -> Iterable[str]:
                cell = contents[row]
                if not cell.is_valid:
                    return ()
                return iter_blocks([memoryview(cell.as_buffer()).cast("B")], charset)

            yield from _lines_of_batch(batch, blocks_of)

    return payload.select(*_keys(payload), "content").mapInArrow(read, lines_schema(payload))


def text_lines(payload: DataFrame, text: str = "text") -> DataFrame:
    """The lines of contents that are already text; stays in the JVM."""
    parts = F.posexplode(split_lines(F.col(text)))
    return payload.select(*_keys(payload), parts.alias("line_no", "value")).withColumn(
        "line_no", F.col("line_no").cast("long")
    )


def ordered_lines(
    slots: DataFrame,
    connector: Connector,
    charset: str = "UTF-8",
    max_retries: int = MAX_RETRIES,
    slots_per_partition: int = 1,
    split_bytes: int | None = None,
    max_partitions: int | None = None,
    line_numbers: bool = True,
    partition_bytes: int | None = None,
) -> DataFrame:
    """The lines of a catalogue in slot order: partition ``i`` holds the lines of slot ``i``.

    Every partition uses one client, so ``max_partitions`` bounds the connections a server sees, by
    packing consecutive slots; ``slots_per_partition`` packs that many, ``partition_bytes`` as many
    as begin within so many bytes.

    With ``split_bytes``, plain slots that are longer are read by several consecutive partitions
    where the connector can seek, with the same lines and line numbers.  The numbers take one more
    reading of those slots; without ``line_numbers`` their ``line_no`` is null instead.  Ranges hold
    whole units of the charset; multi-byte charsets other than UTF-8, UTF-16 and UTF-32 are not cut.
    """
    width = unit_width(charset)
    if split_bytes and connector.seekable and width and "length" in slots.columns:
        split_bytes += -split_bytes % width
        if not slots.filter(F.col("length") > split_bytes).isEmpty():
            ranges = index_slots(
                split_slots(slots.drop("slot_index"), connector, split_bytes, max_retries)
            )
            count = ranges.count()
            if line_numbers:
                ranges = number_ranges(ranges, connector, max_retries, count, charset)
            placed = one_slot_per_partition(ranges, slots_per_partition, max_partitions, count)
            return fetch_ranges(placed, connector, charset, max_retries)
    placed = one_slot_per_partition(
        slots, slots_per_partition, max_partitions, partition_bytes=partition_bytes
    )
    return fetch_lines(placed, connector, charset, max_retries)


def read_lines(
    spark: SparkSession,
    connector: Connector,
    choose: Callable[[DataFrame], DataFrame] | None = None,
    charset: str = "UTF-8",
    max_retries: int = MAX_RETRIES,
    on_list_error: str = "fail",
    slots_per_partition: int = 1,
    split_bytes: int | None = None,
    max_partitions: int | None = None,
    line_numbers: bool = True,
    partition_bytes: int | None = None,
    wanted: Wanted | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """List, choose, order and fetch.

    ``choose`` maps the catalogue to the slots to read, with any DataFrame operation, for example
    ``lambda c: between_dates(c, "2024-01-01")``.  ``wanted`` and ``where`` bound
    the listing itself (see ``read_catalogue``).
    """
    from quayline.operators.catalogue import read_catalogue

    slots = read_catalogue(spark, connector, max_retries, on_list_error, wanted, where)
    if choose is not None:
        slots = choose(slots)
    return ordered_lines(
        slots,
        connector,
        charset,
        max_retries,
        slots_per_partition,
        split_bytes,
        max_partitions,
        line_numbers,
        partition_bytes,
    )


# Large slots


def split_slots(
    slots: DataFrame,
    connector: Connector,
    split_bytes: int,
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """Cut slots longer than ``split_bytes`` into byte ranges ``start`` to ``stop``, the last of
    them open.  Adds ``version``, what the slot was when it was cut.

    Slots are cut by the length they have now, not by the listed one.  Those that turn out to be
    gzipped, which only their first bytes tell, stay whole: start and stop are null.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with closing(Fetcher(connector, max_retries)) as fetcher:
            for batch in batches:
                sizes, versions = [], []
                listed = batch.column("length").to_pylist()
                for i, name in enumerate(batch.column("name").to_pylist()):
                    size, version = None, None
                    if listed[i] is not None and listed[i] > split_bytes:
                        size, version = fetcher.about(name)
                        if is_gzip(b"".join(fetcher.chunks(name, 0, GZIP_HEADER))):
                            size = None
                    sizes.append(size)
                    versions.append(version)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(sizes, pa.int64()), pa.array(versions, pa.string())],
                    names=[*batch.schema.names, "_size", "version"],
                )

    schema = T.StructType(
        [
            *slots.schema.fields,
            T.StructField("_size", T.LongType()),
            T.StructField("version", T.StringType()),
        ]
    )
    plain = F.col("_size") > 0
    starts = F.when(plain, F.sequence(F.lit(0), F.col("_size") - 1, F.lit(split_bytes))).otherwise(
        F.array(F.lit(None).cast("long"))
    )
    cut = slots.mapInArrow(look, schema).withColumn("start", F.explode(starts))
    stop = F.when(F.col("start") + split_bytes < F.col("_size"), F.col("start") + split_bytes)
    return stored(cut.withColumn("stop", stop).drop("_size"), "ranges")


def _looking(fetcher: Fetcher, name: str, start: int, stop: int | None) -> Iterator[bytes]:
    """Content from ``start`` for one who will soon stop reading: in fetches that grow."""
    step = LOOK_BYTES
    while stop is None or start < stop:
        end = start + step if stop is None else min(start + step, stop)
        for chunk in fetcher.chunks(name, start, end):
            start += len(chunk)
            yield chunk
        if start < end:
            return
        step *= LOOK_GROWTH


def _range_blocks(
    fetcher: Fetcher, name: str, cut: tuple[int | None, int | None, str | None], charset: str
) -> Iterator[str]:
    """The lines that start in a range; the last one may end beyond, that of an open range ends with
    the slot.  A line over many ranges is read once to its end, by the range it starts in, and once
    by the others, each of which looks only within itself for where a line begins."""
    start, stop, version = cut
    if start is None:
        yield from iter_blocks(fetcher.chunks(name), charset)
        return
    first, width, ordered = 0, unit_width(charset), charset
    if width > 1:
        # The byte order of all ranges is what the slot begins with.
        ordered, _ = ordered_charset(charset, b"".join(fetcher.chunks(name, 0, width)))
    if start:
        charset = ordered
        before = start - width
        first = next_line_start(_looking(fetcher, name, before, stop), before, ordered)
    # A carriage return that ends the range may be half a line end: then no line starts in it.
    if stop is None or first < stop:
        last = None
        if stop is not None:
            last = next_line_start(_looking(fetcher, name, stop - width, None), stop - width, ordered)
        if last is None or first < last:
            yield from iter_blocks(fetcher.chunks(name, first, last), charset, packed=False)
    fetcher.unchanged(name, version)


def number_ranges(
    ranges: DataFrame,
    connector: Connector,
    max_retries: int = MAX_RETRIES,
    count: int | None = None,
    charset: str = "UTF-8",
) -> DataFrame:
    """Add ``first_line``, the number of lines in earlier ranges of the slot.

    Reads the split slots once more to count their lines, in at most ``COUNT_TASKS`` tasks per core, each
    for consecutive ranges; the counts are stored.  ``ranges`` are indexed; ``count`` saves counting them.
    """
    # Any charset of single bytes counts the same lines; this one is fastest.
    counted = charset if unit_width(charset) > 1 else "latin-1"

    def count_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with closing(Fetcher(connector, max_retries)) as fetcher:
            for batch in batches:
                names, *cuts = (
                    batch.column(c).to_pylist() for c in ("name", "start", "stop", "version")
                )
                lines = [
                    sum(b.count("\n") + 1 for b in _range_blocks(fetcher, name, cut, counted))
                    for name, *cut in zip(names, *cuts, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("slot_index"), batch.column("name"), pa.array(lines, pa.int64())],
                    names=["slot_index", "name", "lines"],
                )

    cut = ranges.filter("start IS NOT NULL").select("slot_index", "name", "start", "stop", "version")
    most = COUNT_TASKS * cut.sparkSession.sparkContext.defaultParallelism
    counts = stored(
        one_slot_per_partition(cut, max_partitions=most, count=count).mapInArrow(
            count_lines, "slot_index long, name string, lines long"
        ),
        "counts",
    )
    # One row per range: a slot of any size is a small group here.
    earlier = Window.partitionBy("name").orderBy("slot_index").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select("slot_index", F.sum("lines").over(earlier).alias("first_line"))
    return ranges.join(offsets, "slot_index", "left").withColumn(
        "first_line", F.coalesce("first_line", F.lit(0).cast("long"))
    )


def fetch_ranges(
    ranges: DataFrame,
    connector: Connector,
    charset: str = "UTF-8",
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """The lines of ranges, numbered if the ranges are.  A slot that changed since it was cut fails
    the task: its ranges would be of two versions."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with closing(Fetcher(connector, max_retries)) as fetcher:
            for batch in batches:
                rows = batch.select(["slot", "start", "stop", "version"]).to_pylist()

                def blocks_of(row: int, rows: list = rows) -> Iterator[str]:
                    name, *cut = rows[row].values()
                    return _range_blocks(fetcher, name, cut, charset)

                yield from _lines_of_batch(batch, blocks_of)

    numbered = "first_line" in ranges.columns
    keyed = ranges.select(
        *_keys(ranges), "start", "stop", "version", *(["first_line"] if numbered else [])
    )
    lines = keyed.mapInArrow(read, lines_schema(ranges))
    # Whole slots among unnumbered ranges could be numbered, but then only some lines would be.
    return lines if numbered else lines.withColumn("line_no", F.lit(None).cast("long"))


def slot_metrics(lines: DataFrame) -> DataFrame:
    """Records and characters read per slot.  A slot's lines sit in one task, so what is shuffled is
    one row per slot."""
    return lines.groupBy("slot").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.char_length("value")).alias("characters"),
        F.sum(F.octet_length("value")).alias("text_bytes"),
    )


def read_metrics(
    slots: DataFrame,
    connector: Connector,
    charset: str = "UTF-8",
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """``slot, slot_date, content_bytes, records, characters`` of every slot, read once and counted as
    it passes: the bytes that were transferred, and lines and characters of the decoded text."""
    schema = T.StructType(
        [
            *lines_schema(slots).fields[:2],
            *[T.StructField(n, T.LongType()) for n in ("content_bytes", "records", "characters")],
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with closing(Fetcher(connector, max_retries)) as fetcher:
            for batch in batches:
                counts = []
                for name in batch.column("slot").to_pylist():
                    passed = [0]

                    def counted(name: str = name, passed: list[int] = passed) -> Iterator[bytes]:
                        for chunk in fetcher.chunks(name):
                            passed[0] += len(chunk)
                            yield chunk

                    records = characters = 0
                    for block in iter_blocks(counted(), charset):
                        ends = block.count("\n")
                        records += ends + 1
                        characters += len(block) - ends
                    counts.append((passed[0], records, characters))
                columns = list(zip(*counts, strict=True)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *[pa.array(c, pa.int64()) for c in columns]], names=schema.names
                )

    return slots.select(*_keys(slots)).mapInArrow(read, schema)


def peek_lines(
    slots: DataFrame, to_lines: Callable[[DataFrame], DataFrame], n: int = 10
) -> DataFrame:
    """The first ``n`` lines in slot order, reading each slot at most once and no more slots than
    that takes, give or take the growth of the steps.

    ``to_lines`` makes lines of a catalogue; fetching, it should read heads alone:
    ``lambda s: fetch_lines(s, connector, first_lines=n)``.  Heads are stored, slots in turn one, two,
    four, … at a time, until there are enough lines; empty slots give none.  The first slots are what
    remains of the first ones of every task.  Only if those do not suffice are all slots numbered, once,
    and a step's slots are shared out to at most ``PEEK_TASKS`` tasks.
    """
    first = stored(slots.orderBy(*slot_order(slots.columns)).limit(PEEK_SLOTS), "first")
    # One sorted file.
    indexed = first.coalesce(1).withColumn("slot_index", F.monotonically_increasing_id())
    total = indexed.count()
    all_indexed = total < PEEK_SLOTS
    found, lines, at, step = None, 0, 0, 1
    while found is None or lines < n:
        if at and at == total:
            if all_indexed:
                break
            indexed, all_indexed = stored(index_slots(slots), "indexed"), True
            total = indexed.count()
            continue
        step = max(1, min(step, total - at))
        tasks = min(step, PEEK_TASKS)
        place = F.col("slot_index")
        chosen = indexed.filter((place >= at) & (place < at + step))
        # Slots side by side, those of a task in order.
        task = F.floor((place - at) * tasks / step).cast("int")
        spread = chosen.repartitionById(tasks, task).sortWithinPartitions("slot_index")
        heads = stored(to_lines(spread).filter(F.col("line_no") < n), "heads")
        lines += heads.count()
        found = heads if found is None else found.unionByName(heads)
        at, step = min(at + step, total) if total else 0, 2 * step
        if not total:
            break
    return found.orderBy(F.col("slot_date").asc_nulls_last(), "slot", "line_no").limit(n)


def write_lines(lines: DataFrame, path: str, **options: str) -> None:
    """One text file per partition, one row per line."""
    lines.select("value").write.options(**options).text(path)
