"""Names of the last batches before a restart, as streaming state that expires by batch number.

A name's state is the number of the poll whose batch read it.  Rows carry the number of the first poll
of their run, which is the event time: while a run goes on no time passes and no name is forgotten; a
restart moves the watermark, and names of batches before the horizon time out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState

# Milliseconds of event time that stand for one poll.
TICK = 1000
TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _as_text(field: T.StructField) -> Column:
    """A column as it passes through JSON without loss: points of time as text or microseconds."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.TimestampType):
        return F.unix_micros(column).alias(field.name)
    return (column.cast("string") if isinstance(field.dataType, TIMES) else column).alias(field.name)


def _text_type(field: T.StructField) -> T.StructField:
    if isinstance(field.dataType, T.TimestampType):
        return T.StructField(field.name, T.LongType())
    kind = T.StringType() if isinstance(field.dataType, TIMES) else field.dataType
    return T.StructField(field.name, kind)


def _from_text(field: T.StructField) -> Column:
    column = F.col(f"_row.`{field.name}`")
    if isinstance(field.dataType, T.TimestampType):
        return F.timestamp_micros(column).alias(field.name)
    return column.cast(field.dataType).alias(field.name)


def _remember(batches: int) -> Callable:
    def run(
        key: tuple[str], frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(frames)
        number, begun = int(rows["poll_number"].max()), int(rows["run_number"].max())
        held = state.get[0] if state.exists else None
        if held is None or held < begun - batches:
            held = number
            state.update((number,))
            # Several roots may list a name: one of them is read, the same in every attempt.
            yield pd.DataFrame({"row": [rows["row"].min()]})
        # Times out when a run begins more than ``batches`` polls later.
        state.setTimeoutTimestamp((held + batches) * TICK + TICK // 2)

    return run


def recent_names(listed: DataFrame, batches: int) -> DataFrame:
    """Rows of a stream of polls (``name``, ``poll_number``, ``run_number`` and others) whose names are
    in no batch since ``batches`` polls before their run began, each name once; without the numbers."""
    fields = [f for f in listed.schema.fields if f.name not in ("poll_number", "run_number")]
    packed = listed.select(
        "name",
        "poll_number",
        "run_number",
        F.to_json(F.struct(*[_as_text(f) for f in fields])).alias("row"),
        F.timestamp_millis(F.col("run_number") * TICK).alias("begun"),
    )
    fresh = (
        # Rows at the watermark itself would count as late.
        packed.withWatermark("begun", "1 millisecond")
        .groupBy("name")
        .applyInPandasWithState(
            _remember(batches), "row string", "number long", "append", "EventTimeTimeout"
        )
    )
    schema = T.StructType([_text_type(f) for f in fields])
    rows = fresh.select(F.from_json("row", schema).alias("_row"))
    return rows.select(*[_from_text(f) for f in fields])
