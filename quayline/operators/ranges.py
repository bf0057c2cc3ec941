"""Where a stream starts, and the token from which it can go on."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayline.operators.names import NAMES_PER_BLOCK, likely_among, pack_names, unpack_names
from quayline.operators.ordering import dense_positions, slot_order

NAMES_PER_ROW = 1000
ZONED = re.compile(r"(Z|[+-]\d\d:?\d\d)$")


@dataclass(frozen=True)
class StartRange:
    """Slots dated at or after ``date``, except those named.

    Either part may be missing; without both everything is accepted.  With a date, undated slots are
    not accepted.  Names are a list, or ``seen``: a table with a ``name`` column of any size.
    """

    date: datetime | str | None = None
    names: tuple[str, ...] = ()
    seen: DataFrame | None = None

    def to_json(self) -> str:
        if self.seen is not None:
            raise ValueError("a table of names is kept as a table, not as text")
        date = self.date.isoformat(sep=" ") if isinstance(self.date, datetime) else self.date
        return json.dumps({"date": date, "slots": list(self.names)})

    @classmethod
    def from_json(cls, text: str) -> StartRange:
        fields = json.loads(text)
        return cls(fields.get("date"), tuple(fields.get("slots") or ()))


def apply_start(
    slots: DataFrame, start: StartRange | None, prefilter: bool = False
) -> DataFrame:
    """Keep the slots, batch or stream, that ``start`` accepts.  ``prefilter``, for a batch and a far
    larger table ``seen``, cuts that one by a filter of the slots' names before it is moved."""
    if start is None:
        return slots
    if start.date is not None:
        slots = slots.filter(F.col("date") >= instant(start.date, slots))
    if start.names:
        table = slots.sparkSession.createDataFrame([(n,) for n in start.names], "name string")
        slots = slots.join(table, "name", "left_anti")
    if start.seen is not None:
        seen = start.seen.select("name")
        if prefilter:
            seen = likely_among(seen, slots, slots.count())
        slots = slots.join(seen, "name", "left_anti")
    return slots


def instant(value: datetime | str, like: DataFrame, column: str = "date") -> Column:
    """``value`` as a literal of the catalogue's own date type.  A value with a zone names a moment:
    for dates without a zone it is that moment's UTC reading, which is what they hold."""
    kind = like.schema[column].dataType
    if isinstance(value, str) and kind.typeName() == "timestamp_ntz":
        # The same reading whatever the session's zone: text with a zone is moved to UTC.
        zoned = ZONED.search(value.strip())
        value = datetime.fromisoformat(value.strip()) if zoned else value
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(UTC)
            if kind.typeName() == "timestamp_ntz":
                value = value.replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(kind)


def range_summary(slots: DataFrame, names_per_row: int = NAMES_PER_ROW) -> DataFrame:
    """The resume token of a read: its earliest date and all slot names in slot order.

    ``range_date, piece, names, n_names`` with ``names`` an array, so that a name may hold any
    character; up to ``names_per_row`` names are one row, more continue in further pieces.  No
    slots, no rows.  An undated catalogue has a null date.
    """
    from quayline.operators.polls import listed_names

    dated = slots if "date" in slots.columns else slots.withColumn(
        "date", F.lit(None).cast("timestamp")
    )
    placed = dense_positions(dated.select("name", "date"), slot_order(["name", "date"]))
    earliest = placed.agg(F.min("date").alias("range_date"))
    token = listed_names(placed, names_per_row)
    # One row: the earliest date of all.
    return token.crossJoin(F.broadcast(earliest)).select("range_date", "piece", "names", "n_names")


def resume_range(summary: DataFrame) -> StartRange:
    """The start that goes on after the read ``summary`` (of ``range_summary``) describes: slots as
    new as its earliest one, without its own.  Its names stay a table."""
    date = summary.select(F.col("range_date").cast("string")).first()
    seen = summary.select(F.explode("names").alias("name"))
    return StartRange(date[0] if date else None, seen=seen)


def packed_range(slots: DataFrame, names_per_block: int = NAMES_PER_BLOCK) -> DataFrame:
    """The resume token of a read as ``range_date, first, last, n_names, packed``: the same date and
    names as ``range_summary``, with the names sorted by themselves and packed, a few bytes each.

    No slots, no rows.
    """
    date = F.min("date") if "date" in slots.columns else F.lit(None).cast("timestamp")
    earliest = slots.agg(date.alias("range_date"))
    # One row: the earliest date of all.
    return pack_names(slots, names_per_block).crossJoin(F.broadcast(earliest)).select(
        "range_date", "first", "last", "n_names", "packed"
    )


def resume_packed(token: DataFrame) -> StartRange:
    """The start that goes on after the read of a ``packed_range``."""
    date = token.select(F.col("range_date").cast("string")).first()
    return StartRange(date[0] if date else None, seen=unpack_names(token))
