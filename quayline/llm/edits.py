"""Token counts that follow edits without encoding a document again.

A document's pre-tokens are kept as blocks of (characters, tokens) under a segment tree of sums.  An
edit descends to the first pre-token it may touch, splits the text anew from there until a boundary
falls on one of the old boundaries behind the edit, replaces the pre-tokens between, and updates the
sums above.

That is exact because a pre-token depends only on the text from its start to two characters behind
its end (the longest look ahead of the pattern): those that end three or more characters before an
edit stay, and from a common boundary behind the edit on, everything stays.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayline.llm.common import slices

AHEAD = 2  # characters behind a pre-token that it depends on
BLOCK = 64  # pre-tokens of a block; a block splits when it has twice as many
COUNTED = 300_000  # distinct pre-tokens whose counts a task holds


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


class Counter:
    """Pre-tokens of a text and the number of tokens of each, by the tokenizer library."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        pairs = (line.split() for line in ranks.splitlines() if line)
        self.encoding = tiktoken.Encoding(
            "counted",
            pat_str=pattern,
            mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
            special_tokens={},
        )
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def tokens(self, piece: str) -> int:
        found = self.known.get(piece)
        if found is None:
            if len(self.known) > COUNTED:
                self.known.clear()
            found = self.known[piece] = len(self.encoding.encode_ordinary(piece))
        return found

    def pieces(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of each pre-token."""
        found = self.pattern.findall(text)
        return (
            np.fromiter(map(len, found), np.int64, len(found)),
            np.fromiter(map(self.tokens, found), np.int64, len(found)),
        )


class CountedText:
    """A text and its pre-tokens, in blocks under a segment tree of characters and tokens."""

    def __init__(self, text: str, counter: Counter) -> None:
        self.text = text
        self.counter = counter
        lengths, tokens = counter.pieces(text)
        self.blocks = [
            (lengths[i : i + BLOCK], tokens[i : i + BLOCK])
            for i in range(0, len(lengths), BLOCK)
        ] or [(lengths, tokens)]
        self._build()

    def _build(self) -> None:
        self.width = 1 << (len(self.blocks) - 1).bit_length()
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        for i, (lengths, tokens) in enumerate(self.blocks):
            self.sums[self.width + i] = lengths.sum(), tokens.sum()
        for node in range(self.width - 1, 0, -1):
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def _update(self, block: int) -> None:
        lengths, tokens = self.blocks[block]
        node = self.width + block
        self.sums[node] = lengths.sum(), tokens.sum()
        while node > 1:
            node //= 2
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1][1])

    @property
    def n_pieces(self) -> int:
        return sum(len(lengths) for lengths, _ in self.blocks)

    def _find(self, position: int) -> tuple[int, int]:
        """The block that holds the character at ``position`` (or the last), and where it begins."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            here = int(self.sums[node][0])
            if position >= before + here and node + 1 < 2 * self.width and self.sums[node + 1][0]:
                before += here
                node += 1
        return node - self.width, before

    def edit(self, start: int, deleted: int, inserted: str) -> int:
        """Replace ``deleted`` characters at ``start`` by ``inserted``; positions beyond the text are
        moved into it.  Returns the number of pre-tokens that were made anew."""
        start = min(max(start, 0), len(self.text))
        end = min(start + max(deleted, 0), len(self.text))
        shift = len(inserted) - (end - start)
        text = self.text[:start] + inserted + self.text[end:]
        # The first pre-token that ends less than AHEAD characters before the edit.
        first, at = self._find(max(0, start - AHEAD))
        lengths, _ = self.blocks[first]
        ends = at + np.cumsum(lengths)
        kept = int(np.searchsorted(ends, start - AHEAD, side="right"))
        begin = int(ends[kept - 1]) if kept else at

        # Walk the old boundaries behind the edit and the new ones until they meet.
        made_lengths, made_tokens = [], []
        last, place, old = first, kept, begin
        position = begin
        met = position == len(text) and begin + 0 == len(self.text)
        matches = self.counter.pattern.finditer(text, begin)
        while not met:
            match = next(matches, None)
            if match is None:
                position = len(text)
            else:
                made_lengths.append(match.end() - match.start())
                made_tokens.append(self.counter.tokens(match[0]))
                position = match.end()
            # Old boundaries up to here, in the old text's positions.
            while old < position - shift or old < end:
                while last < len(self.blocks) and place >= len(self.blocks[last][0]):
                    last, place = last + 1, 0
                if last >= len(self.blocks):
                    break
                old += int(self.blocks[last][0][place])
                place += 1
            met = old == position - shift and old >= end or match is None
        self._replace(first, kept, last, place, made_lengths, made_tokens)
        self.text = text
        return len(made_lengths)

    def _replace(self, first, kept, last, place, lengths, tokens) -> None:
        """Put new pre-tokens for those from ``kept`` of block ``first`` to before ``place`` of block
        ``last``."""
        tail = self.blocks[last] if last < len(self.blocks) else (np.zeros(0, np.int64),) * 2
        own = tuple(
            np.concatenate([head[:kept], np.array(new, np.int64), rest[place:]])
            for head, new, rest in zip(self.blocks[first], (lengths, tokens), tail, strict=True)
        )
        if last == first and 0 < len(own[0]) <= 2 * BLOCK:
            self.blocks[first] = own
            self._update(first)
            return
        parts = [
            (own[0][i : i + BLOCK], own[1][i : i + BLOCK]) for i in range(0, len(own[0]), BLOCK)
        ]
        self.blocks[first : last + 1] = parts
        if not self.blocks:
            self.blocks = [own]
        self._build()


def count_edits(docs: DataFrame, ranks: bytes, pattern: str, with_text: bool = False) -> DataFrame:
    """``docs`` (``doc_id``, ``text``, ``edits``; other columns are ignored) to ``doc_id``,
    ``n_tokens`` before and ``n_tokens_edited`` after the edits, ``n_pieces`` (pre-tokens before),
    ``n_made`` (pre-tokens made anew), ``edited_chars`` and, if asked for, ``edited`` (the text).

    ``edits`` is an array of structs ``start``, ``deleted`` (both in code points) and ``inserted``,
    applied in turn, each to the text the one before left.  A null text is an empty one; null edits
    are none; a null start or length is 0, a null insertion empty; positions beyond the text are
    moved into it.  Repeated rows give repeated results; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks, pattern)
        for batch in slices(batches):
            rows = []
            for text, edits in zip(
                batch.column("text").to_pylist(), batch.column("edits").to_pylist(), strict=True
            ):
                counted = CountedText(text or "", counter)
                before, pieces = counted.n_tokens, counted.n_pieces
                made = sum(
                    counted.edit(e["start"] or 0, e["deleted"] or 0, e["inserted"] or "")
                    for e in edits or []
                    if e is not None
                )
                rows.append(
                    (before, counted.n_tokens, pieces, made, len(counted.text), counted.text)
                )
            names = ["n_tokens", "n_tokens_edited", "n_pieces", "n_made", "edited_chars"]
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(5)]
            if with_text:
                names.append("edited")
                columns.append(pa.array([r[5] for r in rows], pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], names=["doc_id", *names]
            )

    schema = (
        "doc_id long, n_tokens long, n_tokens_edited long, n_pieces long, n_made long, "
        "edited_chars long"
    )
    chosen = docs.select(
        "doc_id",
        "text",
        F.transform(
            "edits",
            lambda e: F.struct(
                e["start"].cast("long").alias("start"),
                e["deleted"].cast("long").alias("deleted"),
                e["inserted"].alias("inserted"),
            ),
        ).alias("edits"),
    )
    return chosen.mapInArrow(run, schema + (", edited string" if with_text else ""))


def edits_by_document(edits: DataFrame) -> DataFrame:
    """A table of edits (``doc_id``, ``seq``, ``start``, ``deleted``, ``inserted``) as one array per
    document in order of ``seq``, to be joined to the documents.  The edits of one document are
    applied in turn and so must fit a row."""
    one = F.struct("seq", "start", "deleted", "inserted")
    return edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(one)).alias("edits"))
