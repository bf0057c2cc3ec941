"""What a stream of listings selects, over a table of polls ``poll, name[, date]``.

The same rules as the stream, for backfills and audits: a slot belongs to the first poll that lists
its name; a later file of the same name is not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayline.operators.ordering import dense_positions, slot_order
from quayline.operators.ranges import NAMES_PER_ROW, StartRange, apply_start


def new_slots(polls: DataFrame, start: StartRange | None = None) -> DataFrame:
    """Each slot name once, with the poll that selects it and, if dated, its date there.

    Old-dated slots that appear late count as new; only the name decides.
    """
    accepted = apply_start(polls, start)
    if "date" not in polls.columns:
        return accepted.groupBy("name").agg(F.min("poll").alias("poll"))
    # A poll that lists one name twice: the earliest date, undated last.
    first = F.min(F.struct("poll", F.col("date").isNull().alias("undated"), "date"))
    chosen = accepted.groupBy("name").agg(first.alias("first"))
    return chosen.select("name", "first.poll", "first.date")


def replayed_slots(polls: DataFrame, restart: Column, horizon_start: Column) -> DataFrame:
    """Slots read again when a stream restarted at ``restart`` remembers only recent polls.

    Names first selected before ``horizon_start`` are forgotten; those listed again at or after
    ``restart`` come back, at the first such poll.
    """
    per_name = polls.groupBy("name").agg(
        F.min("poll").alias("first_poll"),
        F.min(F.when(F.col("poll") >= restart, F.col("poll"))).alias("replayed_poll"),
    )
    return per_name.filter(
        (F.col("first_poll") < horizon_start) & F.col("replayed_poll").isNotNull()
    )


def batch_report(selected: DataFrame) -> DataFrame:
    """Per batch: how many slots it selected, their lines (``n_lines``, where that column is given)
    and the range of their dates."""
    counts = [F.count(F.lit(1)).alias("n_slots")]
    if "n_lines" in selected.columns:
        counts.append(F.sum("n_lines").alias("n_lines"))
    if "date" in selected.columns:
        counts += [F.min("date").alias("min_date"), F.max("date").alias("max_date")]
    return selected.groupBy("poll").agg(*counts)


def batch_descriptions(selected: DataFrame, names_per_row: int = NAMES_PER_ROW) -> DataFrame:
    """Per batch, the slot names in slot order, one per line, for people to read.

    A long description continues over several rows: ``piece`` 0, 1, … of at most ``names_per_row``
    names.  So a first poll over a large backlog does not become one giant cell.
    """
    placed = dense_positions(selected, slot_order(selected.columns), within=["poll"])
    return listed_names(placed, names_per_row, "poll").select(
        "poll", "piece", F.array_join("names", "\n").alias("description"), "n_names"
    )


def listed_names(placed: DataFrame, names_per_row: int, *keys: str) -> DataFrame:
    """Names by ``position``, as arrays of ``names_per_row``."""
    piece = F.floor(F.col("position") / names_per_row).cast("long").alias("piece")
    members = F.sort_array(F.collect_list(F.struct("position", "name")))
    return placed.groupBy(*keys, piece).agg(
        F.transform(members, lambda m: m["name"]).alias("names"),
        F.count(F.lit(1)).alias("n_names"),
    )
