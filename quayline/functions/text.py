"""Bytes to lines: gunzip by content, lenient decoding, universal line ends.

Two forms of the same rules.  ``split_lines`` is a column expression for text that is already a
Spark string.  ``iter_blocks`` works on a stream of byte chunks inside an Arrow task, holding one
chunk and one unfinished line at a time, so a slot may be larger than memory.
"""

from __future__ import annotations

import codecs
import io
import itertools
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# A line ends at any of these three.
LINE_END = r"\r\n|\n|\r"

# Marks that tell the byte order of a charset, and what its units are called then.
MARKS = {
    "utf-16": [(codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be")],
    "utf-32": [(codecs.BOM_UTF32_LE, "utf-32-le"), (codecs.BOM_UTF32_BE, "utf-32-be")],
}

GZIP_MAGIC = b"\x1f\x8b"
GZIP_DEFLATE = 8
GZIP_HEADER = 10
INFLATE_STEP = 4 << 20


def split_lines(text: Column) -> Column:
    """The lines of ``text`` as an array: a final line end adds no line, empty text has none."""
    # A one-character separator avoids the regex engine; carriage returns are the exception.
    parts = F.when(F.contains(text, F.lit("\r")), F.split(text, LINE_END)).otherwise(
        F.split(text, "\n")
    )
    # Only a final line end, or empty text, leaves an empty last part.  The one-element array binds
    # the parts to a name, so that the split is evaluated once.
    return F.transform(
        F.array(parts),
        lambda p: F.when(
            F.element_at(p, -1) == "", F.slice(p, F.lit(1), F.size(p) - 1)
        ).otherwise(p),
    )[0]


def inflate(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """Pass bytes through, gunzipped when they start like a gzip file, whatever the name says."""
    source = iter(chunks)
    head = b""
    while len(head) < GZIP_HEADER:
        chunk = next(source, None)
        if chunk is None:
            break
        head = head + bytes(chunk) if len(head) else chunk
    if is_gzip(head):
        yield from _gunzip(itertools.chain([head], source))
        return
    if len(head):
        yield head
    yield from source


def _gunzip(source: Iterator[bytes]) -> Iterator[bytes]:
    member = zlib.decompressobj(31)
    between = b""
    for data in source:
        while len(data):
            if member.eof:
                # After a member another header goes on; anything else is padding.
                between += bytes(data)
                if len(between) < 3:
                    break
                if between[:2] != GZIP_MAGIC or between[2] != GZIP_DEFLATE:
                    # Read to the end all the same: a transfer left open would block the next one.
                    for _ in source:
                        pass
                    return
                data, between, member = between, b"", zlib.decompressobj(31)
            out = member.decompress(data, INFLATE_STEP)
            if out:
                yield out
            data = member.unused_data if member.eof else member.unconsumed_tail
    if not member.eof:
        raise EOFError("gzip content ends before its end marker")


def _decoder(charset: str, chunks: Iterator[bytes]) -> tuple[codecs.IncrementalDecoder, Iterator]:
    """A replacing decoder; UTF-16 and UTF-32 without a mark are big-endian, as on the JVM."""
    name = codecs.lookup(charset).name
    if name in MARKS:
        head = b""
        for chunk in chunks:
            head += bytes(chunk)
            if len(head) >= unit_width(charset):
                break
        name, marked = ordered_charset(charset, head)
        chunks = itertools.chain([head[marked:]], chunks)
    return codecs.getincrementaldecoder(name)(errors="replace"), chunks


def is_gzip(head: bytes) -> bool:
    return len(head) >= GZIP_HEADER and head[:2] == GZIP_MAGIC and head[2] == GZIP_DEFLATE


def ordered_charset(charset: str, head: bytes) -> tuple[str, int]:
    """``charset`` with the byte order that a text beginning with ``head`` has, and the length of the
    mark that tells it.  Charsets without marks stay as they are."""
    marks = MARKS.get(codecs.lookup(charset).name)
    if not marks:
        return charset, 0
    for mark, name in marks:
        if head.startswith(mark):
            return name, len(mark)
    return marks[1][1], 0


def unit_width(charset: str) -> int:
    """The bytes of a unit of ``charset``, if a unit that is a line end always ends a line, wherever in
    the text it is; 0 for all other charsets, whose texts cannot be cut."""
    name = codecs.lookup(charset).name
    if name.startswith(("utf-16", "utf-32")):
        return 2 if name.startswith("utf-16") else 4
    return int(name in ("utf-8", "ascii") or name.startswith(("iso8859-", "cp125")))


def _whole_units(chunks: Iterable[bytes], width: int) -> Iterator[bytes]:
    """The same bytes in chunks that end with a unit, but for what the last one lacks."""
    rest = b""
    for chunk in chunks:
        held = rest + bytes(chunk) if rest else chunk
        cut = len(held) - len(held) % width
        if cut:
            yield held[:cut]
        rest = bytes(held[cut:])
    if rest:
        yield rest


def _find_unit(chunk: bytes, unit: bytes) -> int:
    at = chunk.find(unit)
    while at % len(unit) and at >= 0:
        at = chunk.find(unit, at + 1)
    return at


def next_line_start(chunks: Iterable[bytes], offset: int, charset: str = "UTF-8") -> int:
    """The offset of the first line that starts after the unit at ``offset``, where ``chunks``
    begin; the end of the text if no line does.  ``charset`` is one with a known byte order."""
    feed, back = "\n".encode(charset), "\r".encode(charset)
    width = len(feed)
    ends_in_return = False
    for chunk in _whole_units(chunks, width):
        if ends_in_return:
            return offset + width * (chunk[:width] == feed)
        found = [i for i in (_find_unit(chunk, feed), _find_unit(chunk, back)) if i >= 0]
        if found:
            at = min(found)
            after = at + width
            if chunk[at:after] == feed:
                return offset + after
            if after < len(chunk):
                return offset + after + width * (chunk[after : after + width] == feed)
            ends_in_return = True
        offset += len(chunk)
    return offset


def iter_blocks(
    chunks: Iterable[bytes], charset: str = "UTF-8", packed: bool = True
) -> Iterator[str]:
    """Blocks of whole consecutive lines of one slot, joined by ``\\n``.

    A block of k line breaks is k + 1 lines.  Not ``packed``, gzip is not looked for.
    """
    decoder, source = _decoder(charset, inflate(chunks) if packed else iter(chunks))
    # The newline decoder turns every line end into \n and copes with \r | \n across chunks.
    reader = io.IncrementalNewlineDecoder(decoder, translate=True)
    unfinished: list[str] = []
    for chunk in source:
        text = reader.decode(chunk)
        cut = text.rfind("\n")
        if cut < 0:
            unfinished.append(text)
            continue
        unfinished.append(text[:cut])
        yield "".join(unfinished)
        unfinished = [text[cut + 1 :]]
    unfinished.append(reader.decode(b"", final=True))
    text = "".join(unfinished)
    if text:
        yield text.removesuffix("\n")


def lines_array(blocks: list[str]) -> pa.StringArray:
    """The lines of blocks as one array, cut at byte positions rather than line by line."""
    data = "\n".join(blocks).encode()
    cuts = np.flatnonzero(np.frombuffer(data, np.uint8) == ord("\n"))
    offsets = np.zeros(len(cuts) + 2, np.int32)
    # Taking the line breaks out moves each later byte down by one.
    offsets[1:-1] = cuts - np.arange(len(cuts))
    offsets[-1] = len(data) - len(cuts)
    return pa.StringArray.from_buffers(
        len(cuts) + 1, pa.py_buffer(offsets), pa.py_buffer(data.replace(b"\n", b""))
    )
