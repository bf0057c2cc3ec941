"""Choosing slots.  A catalogue is any DataFrame with a ``name`` and, where slots are dated, a
``date`` column; every operator here runs before a single slot is fetched."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayline.functions.dcm import parse_dcm_name
from quayline.operators.names import likely_among
from quayline.operators.ordering import slot_order
from quayline.operators.ranges import instant
from quayline.session import stored
from quayline.sources.base import Connector
from quayline.sources.datasource import listing_reader
from quayline.sources.listing import catalogue_schema, list_pages, list_roots
from quayline.sources.wanted import Wanted

log = logging.getLogger(__name__)


def read_catalogue(
    spark: SparkSession,
    connector: Connector,
    max_retries: int = 3,
    on_list_error: str = "fail",
    wanted: Wanted | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """All slots a connector lists: ``name, date, length`` and what the connector adds.

    Listed at once, in executor tasks, one per listing root; the listing is stored in the shared
    folder, so that whatever is done with the catalogue lists nothing again.  ``on_list_error`` set
    to ``empty`` turns a listing that still fails after ``max_retries`` re-tries into no slots: all
    roots or none.  ``wanted`` bounds what is listed: parts that cannot hold such slots are not listed
    at all, and of the others only rows of such slots leave the tasks.

    ``where`` keeps the slots that satisfy a condition and lets Spark find the bounds in it: comparisons
    of names, beginnings of names, lists of names, dates and data-transfer types, joined by AND.
    """
    if on_list_error not in ("fail", "empty"):
        raise ValueError("on_list_error must be fail or empty")
    if where is not None:
        if wanted is not None:
            raise ValueError("give bounds or a condition")
        loaded = listing_reader(spark, connector, max_retries, on_list_error).load()
        return stored(loaded.filter(where), "listing")
    schema = catalogue_schema(connector)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = list_roots(connector, max_retries, wanted, split=True)
                yield pa.RecordBatch.from_pydict({"root": found})

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from list_pages(connector, batch.column("root").to_pylist(), max_retries, wanted)

    try:
        roots = stored(spark.range(1, numPartitions=1).mapInArrow(find, "root string"), "roots")
        # A task per root: each is placed by its position, as rows of one sorted file.
        placed = roots.withColumn("_at", F.monotonically_increasing_id().cast("int"))
        spread = placed.repartitionById(max(1, roots.count()), "_at")
        return stored(spread.select("root").mapInArrow(collect, schema), "listing")
    except PySparkException as error:
        if on_list_error == "fail":
            raise
        log.error("going on without slots: %s", error)
        return spark.createDataFrame([], schema)


def order_slots(slots: DataFrame) -> DataFrame:
    """Sort by date (undated last), then name."""
    return slots.orderBy(*slot_order(slots.columns))


def matching(slots: DataFrame, condition: Column | str) -> DataFrame:
    """Slots that satisfy a predicate over their columns: an expression, or the column a pandas UDF
    gives where the choice needs Python."""
    return slots.filter(condition)


# What a slot is known by.
IDENTITY = ("name", "date", "dcm_type")


def exclude_previous(
    slots: DataFrame, previous: DataFrame, prefilter: bool = False
) -> DataFrame:
    """Drop slots that are among the previous ones: same name and, where both tables have them, same
    date and type; null equals null.  Other columns, such as the length, do not tell slots apart.

    A slot that came back with another date is kept.  ``prefilter`` is for far more previous slots than
    slots: the slots are counted, and previous ones whose name is surely none of theirs are cut by a
    broadcast filter before the join moves them.
    """
    if "name" not in slots.columns or "name" not in previous.columns:
        raise ValueError("slots are told apart by name: both tables need that column")
    shared = [c for c in IDENTITY if c in slots.columns and c in previous.columns]
    if prefilter:
        previous = likely_among(previous, slots, slots.count())
    old = previous.select(*[F.col(c).alias(f"_old_{c}") for c in shared])
    same = F.lit(True)
    for c in shared:
        same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    return slots.join(old, same, "left_anti")


def between_dates(
    slots: DataFrame,
    from_date: datetime | str | None = None,
    to_date: datetime | str | None = None,
) -> DataFrame:
    """``from_date`` inclusive, ``to_date`` exclusive.  With a bound set, undated slots drop out."""
    if from_date is not None:
        slots = slots.filter(F.col("date") >= instant(from_date, slots))
    if to_date is not None:
        slots = slots.filter(F.col("date") < instant(to_date, slots))
    return slots


def empty_like(slots: DataFrame) -> DataFrame:
    """A catalogue of the same shape without slots."""
    return slots.filter(F.lit(False))


def dcm_slots(
    listing: DataFrame, types: list[str] | None = None, lenient: bool = False
) -> DataFrame:
    """Turn a listing of data-transfer files into dated, typed slots; other names drop out.

    Type and date come from the name; ``types`` keeps only those types, none or empty keeps all.
    """
    others = [c for c in listing.columns if c not in ("name", "date", "dcm_type")]
    parsed = listing.select("name", parse_dcm_name(F.col("name"), lenient).alias("_dcm"), *others)
    # Not a filter, which would be moved below the parsing and parse every name a second time.
    found = parsed.select(
        "name", F.inline(F.when(F.col("_dcm").isNotNull(), F.array("_dcm"))), *others
    ).select("name", "date", "dcm_type", *others)
    return found.filter(F.col("dcm_type").isin(list(types))) if types else found
