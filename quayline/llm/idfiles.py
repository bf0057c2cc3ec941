"""Token ids of a corpus as binary files: one concatenated array of ids per file, with the document
boundaries and document ids beside it as Elias-Fano sequences.

Layout of a file, all numbers little-endian: the header (``HEADER``), the ids (unsigned, 2 bytes
each if the vocabulary allows, else 4), the ends of the documents as an Elias-Fano sequence, the
document ids less the smallest one as another.  Documents with a null id come first in the corpus
and are only counted.  An Elias-Fano sequence of n values up to u takes about 2 + log2(u / n) bits
a value: the low bits of each value are packed, the high parts are unary gaps in a bit vector, and
the positions of every ``SAMPLE``-th one in it let ``select`` find any value without a table.

Documents are range-partitioned and sorted by id, so that files follow each other in that order.  A
file is named afresh by each attempt of a task and counts only if the manifest, a table that Spark
commits, names it: attempts that were lost or repeated leave files that nobody reads.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array as pack
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quayline.llm.common import per_worker, slices, staged
from quayline.session import scratch_path
from quayline.sources.location import open_location

MAGIC = b"QLIDS001"
# Magic; documents, ids, documents without id, bytes an id; smallest id; bytes of both sequences.
HEADER = "<8sQQQQqQQ"
SEQUENCE = "<QQQQ"  # values, low bits, bytes of low bits, bytes of high bits
SAMPLE = 256
RUN = 1024  # documents read at a time
# Ids in a file, unless one document has more, and distinct words held by a task at a time.
FILE_IDS = 4_000_000
TABLE_ENTRIES = 600_000
# Letters whose lower case is not in dispute, then marks but for the apostrophe.
PLAIN = re.compile(r"([a-zA-ZÀ-ÖØ-öø-įı-ſ]+)([!-&(-/:-@\[-`{-~]*)")
GAP_FREE = re.compile(r"[^ \t-\r]+")


class EliasFano:
    """A non-decreasing sequence of non-negative integers, read from ``to_bytes()`` of another."""

    def __init__(self, data: bytes) -> None:
        self.count, self.low_bits, low, high = struct.unpack_from(SEQUENCE, data)
        at = struct.calcsize(SEQUENCE)
        self.low = np.frombuffer(data, np.uint8, low, at)
        self.high = np.frombuffer(data, np.uint8, high, at + low)
        samples = (self.count + SAMPLE - 1) // SAMPLE
        self.samples = np.frombuffer(data, "<u8", samples, at + low + high)

    @staticmethod
    def to_bytes(values: np.ndarray) -> bytes:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        lows = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(lows.astype(np.uint8).reshape(-1), bitorder="little")
        ones = (values >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        high = np.packbits(bits, bitorder="little")
        head = struct.pack(SEQUENCE, n, low_bits, len(low), len(high))
        return head + low.tobytes() + high.tobytes() + ones[::SAMPLE].astype("<u8").tobytes()

    def _lows(self, first: int, count: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(count, np.uint64)
        start = first * self.low_bits
        stop = start + count * self.low_bits
        bits = np.unpackbits(self.low[start // 8 : (stop + 7) // 8], bitorder="little")
        bits = bits[start % 8 : start % 8 + count * self.low_bits].reshape(count, self.low_bits)
        return bits.astype(np.uint64) @ (np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64))

    def _one(self, i: int) -> int:
        """Where one ``i`` is: from the sampled one before it, byte by byte, then bit by bit."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = at // 8
        bits = int(self.high[byte]) & (0xFF << (at % 8)) & 0xFF
        while (ones := bits.bit_count()) <= left:
            left -= ones
            byte += 1
            bits = int(self.high[byte])
        for _ in range(left):
            bits &= bits - 1
        return byte * 8 + (bits & -bits).bit_length() - 1

    def select(self, i: int) -> int:
        """Value ``i``."""
        return (self._one(i) - i) << self.low_bits | int(self._lows(i, 1)[0])

    def run(self, first: int, count: int) -> np.ndarray:
        """Up to ``count`` values from ``first`` on: only the bits between the first one and the last,
        which select finds, are unpacked."""
        count = min(count, self.count - first)
        if count <= 0:
            return np.zeros(0, np.uint64)
        start, stop = self._one(first), self._one(first + count - 1)
        bits = np.unpackbits(self.high[start // 8 : stop // 8 + 1], bitorder="little")
        ones = np.flatnonzero(bits[start % 8 :])[:count] + start
        highs = (ones - np.arange(first, first + count)).astype(np.uint64)
        return highs << np.uint64(self.low_bits) | self._lows(first, count)


def pack_file(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """The bytes of a file; ``doc_ids`` in ascending order, nulls first."""
    ends = np.cumsum([len(i) // width for i in ids], dtype=np.int64)
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    bounds = EliasFano.to_bytes(ends)
    names = EliasFano.to_bytes(known.astype(np.uint64) - np.uint64(least % (1 << 64)))
    total = int(ends[-1]) if len(ends) else 0
    head = struct.pack(
        HEADER, MAGIC, len(ids), total, len(ids) - len(known), width, least, len(bounds), len(names)
    )
    return b"".join([head, *ids, bounds, names])


class IdFile:
    """A file's documents, by position."""

    def __init__(self, data: bytes) -> None:
        (magic, self.count, self.total, self.nulls, width, self.least, bounds, names) = (
            struct.unpack_from(HEADER, data)
        )
        if magic != MAGIC:
            raise ValueError("not a file of ids")
        at = struct.calcsize(HEADER)
        self.ids = np.frombuffer(data, f"<u{width}", self.total, at)
        at += self.total * width
        self.ends = EliasFano(data[at : at + bounds])
        self.names = EliasFano(data[at + bounds : at + bounds + names])

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.least + self.names.select(i - self.nulls)

    def document(self, i: int) -> np.ndarray:
        start = self.ends.select(i - 1) if i else 0
        return self.ids[start : self.ends.select(i)]

    def doc_ids(self, first: int, count: int) -> list[int | None]:
        none = min(max(self.nulls - first, 0), count)
        known = self.names.run(max(first - self.nulls, 0), count - none)
        return [None] * none + [self.least + int(v) for v in known]


def _byte_letters() -> dict[int, str]:
    """The letters byte-level tokenizers write bytes as: printable Latin-1 stands for itself, the
    other bytes in turn for the characters from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class WordTable(dict):
    """Ids, as bytes, of each distinct word met so far, filled as words are asked for.

    The tokenizer drops white space and none of its tokens crosses it, so a text's ids are those of
    its words in turn; each distinct word is encoded once by the library.  Of a word of letters with
    marks after it, both are looked up apart, the letters in lower case, and letters go straight to
    the library's model: the tokenizer would lower and part them so too, which a few probes confirm
    first.  Every other word takes the whole way through the library.
    """

    def __init__(self, tokenizer: Tokenizer, width: int, entries: int = TABLE_ENTRIES) -> None:
        super().__init__()
        self.tokenizer = tokenizer
        self.model = self.tokenizer.model
        self.code = "H" if width == 2 else "I"
        self.entries = entries
        self.letters = _byte_letters()
        self.parted = all(
            self._of_letters(core.lower()) + self._whole(marks) == self._whole(core + marks)
            for core, marks in (("Probing", "&&."), ("Àéſß", "..."), ("THE", "%"), ("iı", ""))
        )

    def _whole(self, word: str) -> bytes:
        return pack(self.code, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _of_letters(self, core: str) -> bytes:
        if not core.isascii():
            core = core.encode().decode("latin-1").translate(self.letters)
        return pack(self.code, [t.id for t in self.model.tokenize(core)]).tobytes()

    def __missing__(self, word: str) -> bytes:
        found = PLAIN.fullmatch(word) if self.parted else None
        if not found:
            ids = self._whole(word)
        else:
            core = found[1].lower()
            if core == word:
                ids = self._of_letters(core)
            else:
                ids = self[core] + self[found[2]] if found[2] else self[core]
        self[word] = ids
        return ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self) > self.entries:
            self.clear()
        get = self.__getitem__
        return [b"".join(map(get, GAP_FREE.findall(t))) if t else b"" for t in texts]


def read_tokenizer(path: str) -> str:
    """The tokenizer file's text, which travels to the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def write_id_files(
    docs: DataFrame,
    tokenizer: str,
    path: str,
    end_id: int | None = 1,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode ``docs`` (``doc_id``, ``text``; other columns are ignored), append ``end_id`` to each
    document and write files below ``path``.  Returns the manifest: ``part``, ``seq``, ``file``,
    ``n_docs``, ``n_ids``, ``start`` (ids in all files before).

    Documents are ordered by id, null ids first, equal ids by a hash of the text.
    A null text is an empty one.  An empty table gives an empty manifest.
    """
    width = 2 if Tokenizer.from_str(tokenizer).get_vocab_size(True) <= 1 << 16 else 4
    end = b"" if end_id is None else int(end_id).to_bytes(width, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_location(path)
        store.create_dir(folder, recursive=True)
        part, seq = TaskContext.get().partitionId(), 0
        # The library does not give back all that a tokenizer takes: one for all tasks of a worker.
        shared = per_worker("words", tokenizer.encode(), lambda: Tokenizer.from_str(tokenizer))
        words = WordTable(shared, width)
        names, ids, size = [], [], 0

        def flush() -> pa.RecordBatch:
            file = f"ids-{part:06d}-{seq:06d}-{uuid.uuid4().hex}.efi"
            with store.open_output_stream(f"{folder}/{file}") as out:
                out.write(pack_file(names, ids, width))
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int64()),
                    "seq": pa.array([seq], pa.int64()),
                    "file": [file],
                    "n_docs": pa.array([len(ids)], pa.int64()),
                    "n_ids": pa.array([size // width], pa.int64()),
                }
            )

        for batch in slices(batches):
            found = words.encode(batch.column("text").to_pylist())
            for name, own in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                own += end
                if ids and size + len(own) > file_ids * width:
                    yield flush()
                    seq, names, ids, size = seq + 1, [], [], 0
                names.append(name)
                ids.append(own)
                size += len(own)
        if ids:
            yield flush()

    # Rows that share an id, even whole copies, still spread over ranges by the last two keys.  The
    # text itself is no key: keys are sampled and sent to the driver.
    ordered = (
        docs.select("doc_id", "text")
        .withColumn("_hash", F.xxhash64("text"))
        .withColumn("_copy", F.monotonically_increasing_id())
        .repartitionByRange("doc_id", "_hash", "_copy")
        .sortWithinPartitions("doc_id", "_hash", "_copy")
    )
    files = staged(
        ordered.select("doc_id", "text").mapInArrow(
            run, "part long, seq long, file string, n_docs long, n_ids long"
        ),
        "manifest",
    )
    # One row per file and, for this window, one per task: never the documents.
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return files.join(parts, "part").select(
        "part", "seq", "file", "n_docs", "n_ids",
        (F.col("_before") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).alias("start"),
    )


def read_id_files(manifest: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, ``ids_crc32`` (of the ids
    as unsigned 32-bit numbers) and, if asked for, ``ids`` of every document in the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_location(path)
        for row in (r for batch in batches for r in batch.to_pylist()):
            with store.open_input_stream(f"{folder}/{row['file']}") as file:
                content = IdFile(file.read())
            for at in range(0, content.count, RUN):
                ends = content.ends.run(at, RUN).astype(np.int64)
                before = content.ends.select(at - 1) if at else 0
                starts = np.concatenate([[before], ends[:-1]]).astype(np.int64)
                own = [
                    content.ids[a:b].astype("<u4") for a, b in zip(starts, ends, strict=True)
                ]
                columns = {
                    "doc_id": pa.array(content.doc_ids(at, len(ends)), pa.int64()),
                    "start": pa.array(starts + row["start"]),
                    "n_tokens": pa.array(ends - starts),
                    "ids_crc32": pa.array([zlib.crc32(o.tobytes()) for o in own], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([o.tolist() for o in own], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    files = manifest.select("file", "start")
    tasks = max(1, min(10_000, manifest.count()))
    return files.repartition(tasks, "file").mapInArrow(
        run, schema + (", ids array<int>" if with_ids else "")
    )


def id_file_documents(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write ``docs`` as files in the shared folder and read every document back from them."""
    path = scratch_path(docs.sparkSession, "idfiles")
    return read_id_files(write_id_files(docs, tokenizer, path, end_id), path)
