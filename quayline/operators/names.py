"""Large sets of slot names: filters that cut them before a shuffle, and a compact form to keep them in."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A filter is broadcast, as one number of 64 bits for four names: up to some 20 MB.
FILTER_NAMES = 2_000_000
NAMES_PER_BLOCK = 1000


def _place(name: Column, words: int) -> tuple[Column, Column]:
    """The word of a filter that a name falls to, and its two bits there."""
    digest = F.xxhash64(name)
    one = F.lit(1).cast("long")

    def bit(shift: int) -> Column:
        place = F.shiftrightunsigned(digest, shift).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", one, place)

    word = F.shiftrightunsigned(digest, 12).bitwiseAND(F.lit(words - 1))
    return word, bit(0).bitwiseOR(bit(6))


def name_filter(names: DataFrame, words: int, column: str = "name") -> DataFrame:
    """A Bloom filter as a table ``word, bits``: each name sets two bits of one of ``words`` words, a
    power of two.  Filters of parts are merged by OR, which tasks do before anything moves."""
    word, bits = _place(F.col(column), words)
    placed = names.select(word.alias("word"), bits.alias("bits"))
    return placed.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def likely_among(rows: DataFrame, names: DataFrame, count: int, column: str = "name") -> DataFrame:
    """``rows`` whose name may be one of ``names``, of which there are ``count``: all that are, and about
    one in a hundred of the others.  No row moves; the filter does.  Beyond ``FILTER_NAMES`` names
    it would not be small, and all rows pass."""
    if count > FILTER_NAMES:
        return rows
    words = 1 << max(0, -(-count // 4) - 1).bit_length()
    held = name_filter(names.select(F.col(column).alias("name")), words)
    held = held.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    word, bits = _place(F.col(column), words)
    near = rows.join(F.broadcast(held), word == F.col("_word"))
    return near.filter(bits.bitwiseAND(F.col("_bits")) == bits).drop("_word", "_bits")


# Names in blocks


def _number(value: int) -> bytes:
    """Seven bits a byte, the last byte below 128."""
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def pack_block(names: list[str]) -> bytes:
    """Sorted names: of each, how many bytes it shares with the one before it, and the others."""
    out, before = bytearray(), b""
    for name in names:
        now = name.encode("utf-8", "surrogatepass")
        shared, most = 0, min(len(now), len(before))
        while shared < most and now[shared] == before[shared]:
            shared += 1
        out += _number(shared) + _number(len(now) - shared) + now[shared:]
        before = now
    return zlib.compress(bytes(out), 6)


def unpack_block(packed: bytes) -> Iterator[str]:
    data, at, before = zlib.decompress(packed), 0, b""

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        shared, more = number(), number()
        before = before[:shared] + data[at : at + more]
        at += more
        yield before.decode("utf-8", "surrogatepass")


def pack_names(names: DataFrame, per_block: int = NAMES_PER_BLOCK) -> DataFrame:
    """``first, last, n_names, packed``: the distinct names of a table, sorted, in blocks of up to
    ``per_block``.  Null names are left out.  Tasks sort ranges of names and pack them as they pass."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passing() -> Iterable[str]:
            last = None
            for batch in batches:
                for name in batch.column("name").to_pylist():
                    if name != last:
                        yield name
                    last = name

        source = iter(passing())
        while block := list(islice(source, per_block)):
            yield pa.RecordBatch.from_pydict(
                {
                    "first": [block[0]],
                    "last": [block[-1]],
                    "n_names": pa.array([len(block)], pa.int64()),
                    "packed": [pack_block(block)],
                }
            )

    # Equal names fall into one range.
    placed = names.select("name").dropna().distinct().repartitionByRange("name")
    return placed.sortWithinPartitions("name").mapInArrow(
        pack, "first string, last string, n_names long, packed binary"
    )


def unpack_names(blocks: DataFrame) -> DataFrame:
    """The names of ``pack_names``, one a row, block by block."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("packed").to_pylist():
                yield pa.RecordBatch.from_pydict({"name": list(unpack_block(packed))})

    return blocks.select("packed").mapInArrow(unpack, "name string")
