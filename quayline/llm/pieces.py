"""SentencePiece encoding and decoding over a table of distinct marked words.

The library writes every space as a marker and, in a model whose pieces hold a marker only in front,
no merge crosses from a word into the next marker.  A text is therefore a sequence of chunks, each a
run of markers with the word after it, and chunks can be segmented apart from each other.  A task
keeps a table of the distinct chunks it has met, segments each once, and joins the ids back by
position.  Shuffling positions to a table shared by all tasks would move every word of the corpus
twice; a table per task moves nothing, and a lost task only has to be run again.
"""

from __future__ import annotations

import hashlib
from array import array as pack
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from sentencepiece import SentencePieceProcessor

from quayline.llm.common import slices

MARK = "▁"
# Distinct chunks held by a task at a time.  A full table is emptied, which costs only time.
TABLE_ENTRIES = 200_000


def read_model(path: str) -> bytes:
    """The model file; its bytes travel to the tasks, which need not see the path.

    A model with a piece that holds a marker behind another character, or with markers as suffixes,
    is refused: its pieces can cross words.
    """
    with open(path, "rb") as file:
        model = file.read()
    processor = SentencePieceProcessor(model_proto=model)
    for i in range(processor.get_piece_size()):
        if MARK in processor.id_to_piece(i).lstrip(MARK):
            raise ValueError("pieces of this model cross word markers")
    if processor.encode("a b")[:1] != processor.encode("a") or processor.encode("") != []:
        raise ValueError("this model does not mark the front of words")
    return model


def chunks_of(text: str) -> list[str]:
    """The chunks of a non-empty text.  A chunk is named by what follows its first marker: its
    further markers as spaces, then its word."""
    words = text.replace(MARK, " ").split(" ")
    if "" not in words:
        return words
    found, markers = [], 0
    for word in words:
        if word:
            found.append(" " * markers + word)
            markers = 0
        else:
            markers += 1
    if markers:
        # Markers at the end: the first of them is implied, like that of a word.
        found.append(" " * (markers - 1))
    return found


class ChunkTable:
    """Ids and text of each distinct chunk met so far."""

    def __init__(self, model: bytes, entries: int = TABLE_ENTRIES) -> None:
        self.processor = SentencePieceProcessor(model_proto=model)
        self.entries = entries
        self.ids: dict[str, bytes] = {}
        self.written: dict[str, str] = {}
        # Only chunks that decoding does not give back as they are.
        self.texts: dict[str, str] = {}

    def add(self, texts: list[list[str]]) -> None:
        """Segment the chunks of ``texts`` that are not in the table."""
        if len(self.ids) > self.entries:
            self.ids, self.written, self.texts = {}, {}, {}
        new = list(set(chain.from_iterable(texts)).difference(self.ids))
        if not new:
            return
        encoded = self.processor.encode(new, num_threads=1)
        # A marker alone cannot be asked for: an empty text has no marker.
        marker = [self.processor.piece_to_id(MARK)]
        encoded = [e if c else marker for c, e in zip(new, encoded, strict=True)]
        decoded = self.processor.decode(encoded, num_threads=1)
        for chunk, ids, text in zip(new, encoded, decoded, strict=True):
            self.ids[chunk] = pack("i", ids).tobytes()
            if text != chunk:
                self.texts[chunk] = text

    def encode(self, chunks: list[str]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.ids.__getitem__, chunks)), np.int32)

    def _write(self, chunk: str) -> str:
        own = self.written.get(chunk)
        if own is None:
            ids = np.frombuffer(self.ids[chunk], np.int32).tolist()
            own = self.written[chunk] = " ".join(map(str, ids))
        return own

    def written_ids(self, chunks: list[str]) -> str:
        return " ".join(map(self._write, chunks))

    def decode(self, chunks: list[str]) -> str:
        """The text of the chunks' ids: each chunk's text behind its marker, but for the first
        marker."""
        odd = self.texts
        if not odd:
            return " ".join(chunks)
        return " ".join([odd.get(c, c) for c in chunks])


def _id_lists(
    table: ChunkTable, parts: list[list[str]], end_id: int | None
) -> tuple[np.ndarray, pa.ListArray]:
    """Number of ids, and the ids, of each text, as one array with offsets."""
    end = np.array([] if end_id is None else [end_id], np.int32)
    own = [np.concatenate([table.encode(p), end]) for p in parts]
    counts = np.array([len(o) for o in own], np.int64)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    values = np.concatenate(own) if own else end[:0]
    return counts, pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def encode_documents(docs: DataFrame, model: bytes, end_id: int | None = 2) -> DataFrame:
    """``docs`` (``doc_id``, ``text``; other columns are ignored) to ``doc_id``, ``n_tokens``,
    ``ids`` (array) and ``decoded``.

    A null text is encoded as an empty one: the end id alone, decoded to an empty text.  Rows that
    repeat, or share an id, give a result each; an empty table gives none.
    """

    def make(table: ChunkTable, batch: pa.RecordBatch, parts: list[list[str]]) -> dict[str, list]:
        counts, ids = _id_lists(table, parts, end_id)
        return {
            "n_tokens": counts,
            "ids": ids,
            "decoded": [table.decode(p) for p in parts],
        }

    return _encoded(docs, model, make, "n_tokens long, ids array<int>, decoded string")


def encoding_digests(docs: DataFrame, model: bytes, end_id: int | None = 2) -> DataFrame:
    """As ``encode_documents``, with sha256 of the decimal ids joined by spaces and of the decoded
    text in place of both, made in the tasks so that neither is moved."""

    def make(table: ChunkTable, batch: pa.RecordBatch, parts: list[list[str]]) -> dict[str, list]:
        end = "" if end_id is None else str(end_id)
        written = [" ".join(filter(None, [table.written_ids(p), end])) for p in parts]
        return {
            "n_tokens": [w.count(" ") + 1 if w else 0 for w in written],
            "ids_sha256": [hashlib.sha256(w.encode()).hexdigest() for w in written],
            "decoded_sha256": [
                hashlib.sha256(table.decode(p).encode()).hexdigest() for p in parts
            ],
        }

    return _encoded(docs, model, make, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_rows(docs: DataFrame, model: bytes, end_id: int | None = 2) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` and ``exact`` (whether decoding the ids gives the text
    back, a null one as empty) in place of ``text``."""

    def make(table: ChunkTable, batch: pa.RecordBatch, parts: list[list[str]]) -> dict[str, list]:
        counts, ids = _id_lists(table, parts, end_id)
        texts = batch.column("text").to_pylist()
        return {
            "n_tokens": counts,
            "ids": ids,
            "exact": [table.decode(p) == (t or "") for p, t in zip(parts, texts, strict=True)],
        }

    others = [c for c in docs.columns if c not in ("text", "n_tokens", "ids", "exact")]
    return _encoded(
        docs, model, make, "n_tokens long, ids array<int>, exact boolean", tuple(others)
    )


def _encoded(
    docs: DataFrame, model: bytes, make, schema: str, others: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    names = [part.split(" ")[0] for part in schema.split(", ")]
    kinds = {"long": pa.int64(), "array<int>": pa.list_(pa.int32()), "string": pa.string(), "boolean": pa.bool_()}
    types = [kinds[part.split(" ")[1]] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model)
        for batch in slices(batches):
            parts = [chunks_of(t) if t else [] for t in batch.column("text").to_pylist()]
            table.add(parts)
            made = make(table, batch, parts)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in others],
                    *[
                        made[n] if isinstance(made[n], pa.Array) else pa.array(made[n], t)
                        for n, t in zip(names, types, strict=True)
                    ],
                ],
                names=[*others, *names],
            )

    chosen = docs.select(*[F.col(f"`{c}`") for c in others], "text")
    fields = StructType([f for f in chosen.schema.fields if f.name != "text"])
    for field in StructType.fromDDL(schema).fields:
        fields = fields.add(field)
    return chosen.mapInArrow(run, fields)


def decode_ids(encoded: DataFrame, model: bytes) -> DataFrame:
    """``encoded`` (``doc_id``, ``ids``) to ``doc_id`` and ``text``, by the library's ``decode``.
    Control ids leave no text; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = SentencePieceProcessor(model_proto=model)
        for batch in slices(batches):
            ids = [i or [] for i in batch.column("ids").to_pylist()]
            texts = processor.decode(ids, num_threads=1) if ids else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
