"""Global order and positions without pulling rows into one task.

``row_number()`` over an unpartitioned window, or over a hot group, sorts everything in one task.
Here the rows are range-sorted across tasks and written to the shared checkpoint folder; each task
then only needs to know how many rows of its group lie in earlier partitions, a table with one row
per partition and group.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayline.session import scratch_path, shared_dir, stored

# Offsets are broadcast up to this many rows (about 10 MB) and joined by shuffle beyond it.
BROADCAST_ROWS = 200_000
# Slots of a run, the unit in which bytes before a slot are summed.
RUN_SLOTS = 4096
# Partitions that one shuffle deals out, and shuffled stretches of more partitions than that.
LISTED_PARTITIONS, STRETCHES = 2000, 2000
# Partitions whose tasks may read a shuffle and return its counters.
COUNTED_PARTITIONS = 20_000
# Partitions whose tasks the driver has in hand at a time.
STEP_PARTITIONS = 50_000


def slot_order(columns: Sequence[str]) -> list[Column]:
    """By date with undated slots last, then by name; by name alone in an undated catalogue.  Ranges
    of one slot follow each other."""
    keys = [F.col("date").asc_nulls_last()] if "date" in columns else []
    return [*keys, F.col("name").asc(), *([F.col("start")] if "start" in columns else [])]


def dense_positions(
    df: DataFrame,
    order: Sequence[Column],
    within: Sequence[str] = (),
    name: str = "position",
) -> DataFrame:
    """Number rows 0, 1, 2, … in ``order``, separately per ``within`` group.

    Equals ``row_number() - 1``.  Groups and runs of equal keys may span any number of tasks.  The
    sorted rows are checkpointed, because positions must not change when a lost task is re-run.
    """
    shared_dir(df.sparkSession)
    rest = [c for c in df.columns if c not in within]
    # Rows equal in every ordered column differ by the last two keys, so a large run of them is
    # still cut into several range partitions.
    ordered = (
        df.withColumn("_tie", F.xxhash64(*rest))
        .withColumn("_copy", F.monotonically_increasing_id())
        .orderBy(*[F.col(c) for c in within], *order, "_tie", "_copy")
        .drop("_tie", "_copy")
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_row", 33))
        .checkpoint()
    )
    blocks = ordered.groupBy(*within, "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first")
    )
    # Without groups this window sees one row per partition of the sort, never the data.
    earlier = Window.partitionBy(*within).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = blocks.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(within)],
        F.col("_part").alias("_block"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    if not within or blocks.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    match = F.col("_part") == F.col("_block")
    for i, c in enumerate(within):
        match = match & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return ordered.join(offsets, match).select(
        *df.columns, (F.col("_row") + F.col("_shift")).alias(name)
    )


def index_slots(slots: DataFrame, name: str = "slot_index") -> DataFrame:
    """Number the slots of a catalogue from 0 in slot order."""
    return dense_positions(slots, slot_order(slots.columns), name=name)


def one_slot_per_partition(
    slots: DataFrame,
    slots_per_partition: int = 1,
    max_partitions: int | None = None,
    count: int | None = None,
    partition_bytes: int | None = None,
) -> DataFrame:
    """Place slot ``i`` in partition ``i``, so that each task reads one slot, in slot order.

    ``slots_per_partition`` packs runs of that many consecutive slots instead.  ``max_partitions``
    bounds the partitions, and with them the clients open at a time, by packing as many slots as
    that takes.  ``partition_bytes`` packs by length instead: a partition takes the slots that begin
    within its share of all bytes, so that small slots go together and a large one goes alone.
    None of them is set unless the caller asks.  ``count`` saves counting the slots.
    """
    if slots_per_partition < 1 or (max_partitions is not None and max_partitions < 1):
        raise ValueError("slots_per_partition and max_partitions must be greater than 0")
    indexed = slots if "slot_index" in slots.columns else index_slots(slots)
    if partition_bytes is not None:
        return _packed_by_bytes(indexed, partition_bytes)
    if count is None:
        last = indexed.agg(F.max("slot_index")).first()[0]
        count = 0 if last is None else last + 1
    pack = slots_per_partition
    if max_partitions is not None:
        pack = max(pack, math.ceil(count / max_partitions))
    # A checkpoint, because a task with a sort returns the counters of all steps before it.
    shared_dir(slots.sparkSession)
    placed = indexed.withColumn("_target", F.expr(f"slot_index div {pack}")).checkpoint()
    return _placed(placed, max(1, math.ceil(count / pack)), pack > 1)


def rows_of_partitions(
    slots: DataFrame,
    rows: Callable[[DataFrame, Column], DataFrame],
    key: str,
    slots_per_partition: int = 1,
) -> DataFrame:
    """What ``rows`` makes of slots placed by ``one_slot_per_partition``, with a task for every partition.

    The driver remembers every task of a job and what it returned, so that half a million in one job do not
    fit a small driver.  Partitions are therefore run in steps, jobs of ``STEP_PARTITIONS`` consecutive ones,
    and their rows shuffled by ``key`` and stored, so that there is no file for every task.  ``rows`` gets the
    placed slots of a step, with the ``slot_index`` they have among all, and the number of their partition
    among all.
    """
    indexed = stored(index_slots(slots), "indexed")
    count = indexed.count()
    step = STEP_PARTITIONS * slots_per_partition
    path = scratch_path(slots.sparkSession, "rows")
    place = F.col("slot_index")
    for first in range(0, max(count, 1), step):
        own = indexed.filter((place >= first) & (place < first + step))
        placed = one_slot_per_partition(
            own.withColumn("slot_index", place - first),
            slots_per_partition,
            count=min(step, count - first),
        )
        number = F.spark_partition_id().cast("long") + first // slots_per_partition
        made = rows(placed.withColumn("slot_index", place + first), number)
        made.repartition(key).write.mode("append").parquet(path)
    return slots.sparkSession.read.schema(made.schema).parquet(path)


def _placed(slots: DataFrame, count: int, packed: bool) -> DataFrame:
    """Checkpointed slots in ``count`` partitions by ``_target``, which is dropped; ``packed`` ones in order.

    Spark sends every task of a shuffle the list of its partitions, so that many partitions cost time
    that grows with the square of their number.  Beyond ``LISTED_PARTITIONS`` slots are dealt out to
    stretches of so many consecutive partitions, and the product of the stretches with the places of a
    stretch has one partition for every place: a task reads its stretch and keeps what is its own.

    A task that reads a shuffle or sorts returns the counters of both, which the driver adds up one
    task after the other.  Beyond ``COUNTED_PARTITIONS`` the stretches are checkpointed in order first.
    """
    target = F.col("_target")
    cut = count > COUNTED_PARTITIONS

    def in_order(df: DataFrame) -> DataFrame:
        return df.sortWithinPartitions("slot_index") if packed else df

    def own(stretches: DataFrame, width: int, first: int) -> DataFrame:
        """Each stretch ``width`` times, partition i of the product being place i % width of stretch
        i div width, and of it what belongs there."""
        if cut:
            stretches = in_order(stretches).checkpoint()
        places = slots.sparkSession.range(0, width, 1, width).select()
        product = stretches.hint("shuffle_replicate_nl").crossJoin(places)
        # Its number is a column first: in a filter it holds only where Spark makes code of whole stages.
        here = product.withColumn("_here", F.spark_partition_id() + F.lit(first))
        return here.filter("_target = _here").drop("_here")

    if count <= LISTED_PARTITIONS:
        return in_order(slots.repartitionById(count, target.cast("int")).drop("_target"))
    # A width that divides the number saves a second product, whose counters every task would return.
    least = math.ceil(count / max(STRETCHES, math.isqrt(count)))
    width = next((w for w in range(least, 4 * least) if count % w == 0), least)
    stretches = count // width
    whole = stretches * width
    # No slot is left out, should there be more than were counted.
    slots = slots.withColumn("_target", F.least(target, F.lit(count - 1)))
    dealt = slots.filter(target < whole).repartitionById(
        stretches, F.expr(f"cast(_target div {width} as int)")
    )
    spread = own(dealt, width, 0)
    if whole < count:
        rest = slots.filter(target >= whole).repartitionById(1, F.lit(0))
        spread = spread.union(own(rest, count - whole, whole))
    spread = spread.drop("_target")
    return spread if cut else in_order(spread)


def _packed_by_bytes(indexed: DataFrame, partition_bytes: int) -> DataFrame:
    """Bytes before a slot are those of the runs of slots before its run, one row per run, and of the
    slots before it in its run: no task sees more than a run or the table of runs."""
    if partition_bytes < 1:
        raise ValueError("partition_bytes must be greater than 0")
    run = F.floor(F.col("slot_index") / RUN_SLOTS)
    sized = indexed.withColumn("_run", run).withColumn(
        "_bytes", F.coalesce(F.col("length"), F.lit(0)).cast("long")
    )
    earlier = (Window.unboundedPreceding, -1)
    runs = sized.groupBy("_run").agg(F.sum("_bytes").alias("_all"))
    offsets = runs.select(
        F.col("_run").alias("_of"),
        F.coalesce(F.sum("_all").over(Window.orderBy("_run").rowsBetween(*earlier)), F.lit(0))
        .alias("_offset"),
    )
    within = Window.partitionBy("_run").orderBy("slot_index").rowsBetween(*earlier)
    placed = sized.withColumn("_before", F.coalesce(F.sum("_bytes").over(within), F.lit(0)))
    placed = placed.join(offsets, F.col("_run") == F.col("_of")).withColumn(
        "_target", F.expr(f"(_offset + _before) div {partition_bytes}")
    )
    shared_dir(indexed.sparkSession)
    placed = placed.select(*indexed.columns, "_target").checkpoint()
    last = placed.agg(F.max("_target")).first()[0]
    return _placed(placed, 1 if last is None else last + 1, True)
