"""Every slot once, as it appears.

poll source → start range → first sight of the name → fetch on executors.  Names already read live
in streaming state, spread over executors and restored from the checkpoint, not in the driver.  The
source sends names that are new to the last listing, and nothing when nothing is new: then there is
no batch.
"""

from __future__ import annotations

import json
import logging
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from quayline.operators.ordering import dense_positions, index_slots, slot_order
from quayline.operators.payload import fetch_lines, ordered_lines
from quayline.operators.polls import listed_names
from quayline.operators.ranges import NAMES_PER_ROW, StartRange, apply_start
from quayline.sources.base import MAX_RETRIES, Connector
from quayline.sources.datasource import poll_reader
from quayline.sources.location import open_location
from quayline.streaming.horizon import recent_names

log = logging.getLogger(__name__)

OBSERVED, OBSERVED_SLOTS = "slot_batch", "slot_batch_slots"


@dataclass(frozen=True)
class SlotStream:
    """A stream over a connector.

    ``log_dir`` keeps listings until their batch is committed.  It belongs to one query and lies on
    storage all executors share, beside the checkpoint; keep or drop the two together.
    ``max_slots`` bounds the slots of a batch (by listing root, so that it may be passed by less than
    the number of roots); what is left over comes with the next ones.

    Unless ``remember_batches`` is set, a name is never read twice.  With it, the names of that many
    polls with new slots before a restart are remembered, and all since; a slot of an older batch that
    is still listed is read again after the restart, and only then (see ``quayline.streaming.horizon``).
    """

    spark: SparkSession
    connector: Connector
    log_dir: str
    start: StartRange | None = None
    charset: str = "UTF-8"
    max_retries: int = MAX_RETRIES
    poll_interval_ms: int = 1000
    remember_batches: int | None = None
    max_slots: int | None = None

    def listings(self) -> DataFrame:
        """Slots as polls find them new: ``name, date, length, poll`` and what the connector adds, with
        ``remember_batches`` also ``poll_number`` and ``run_number``."""
        return poll_reader(
            self.spark,
            self.connector,
            self.max_retries,
            self.log_dir,
            self.poll_interval_ms,
            self.max_slots,
            self.remember_batches is not None,
        ).load()

    def slots(self) -> DataFrame:
        """New slots, each name once, or again after a restart if it is no longer remembered."""
        start = self.start
        if start is None or start.seen is None:
            return self._not_read(apply_start(self.listings(), start))
        # Names of a table are compared behind the state, with new names only.
        dated = apply_start(self.listings(), StartRange(start.date, start.names))
        return apply_start(self._not_read(dated), StartRange(seen=start.seen))

    def _not_read(self, listed: DataFrame) -> DataFrame:
        if self.remember_batches is None:
            return listed.dropDuplicates(["name"])
        return recent_names(listed, self.remember_batches)

    def lines(self) -> DataFrame:
        """The lines of new slots, for any sink.

        Lines of one slot are in order; order between slots of one batch is left to ``slot_date``,
        ``slot`` and ``line_no``.  ``for_each_batch`` keeps slot order by itself.
        """
        slots = self.slots().observe(
            OBSERVED_SLOTS,
            F.count(F.lit(1)).alias("n_slots"),
            F.min("date").alias("min_date"),
            F.max("date").alias("max_date"),
            F.min("name").alias("first_name"),
            F.max("name").alias("last_name"),
        )
        lines = fetch_lines(slots, self.connector, self.charset, self.max_retries)
        return lines.observe(OBSERVED, F.count(F.lit(1)).alias("n_lines"))

    def for_each_batch(
        self,
        work: Callable[[DataFrame, DataFrame, int], None],
        slots_per_partition: int = 1,
        slot_table: str | None = None,
        line_table: str | None = None,
        report_table: str | None = None,
    ) -> DataStreamWriter:
        """Call ``work(lines, slots, batch_id)`` for every batch that selected at least one slot.

        ``slots`` is the batch's indexed catalogue, stored once, so using it any number of times
        lists nothing again.  ``lines`` has one partition per slot, in slot order, and fetches each
        slot once per action on it.

        All three tables are Parquet folders with a partition ``batch_id``; a repeated batch replaces
        its own.  ``slot_table`` gets the batch's slots after ``work``: what was read when, and a
        start for another stream (``StartRange(seen=...)``).  ``line_table`` gets the lines before
        ``work``, which is then given them from there, so that every slot is fetched once whatever
        ``work`` does.  ``report_table``, which needs it, gets ``n_slots, n_lines, min_date,
        max_date, start`` (the range as JSON), and ``piece, names, n_names``: the names in slot
        order, as many rows as ``range_summary`` would take.
        """
        if report_table is not None and line_table is None:
            raise ValueError("report_table needs a line_table")

        def run(selected: DataFrame, batch_id: int) -> None:
            # What was selected is written once; everything after reads it from there.
            place = f"{self.log_dir.rstrip('/')}/selected/batch={batch_id}"
            selected.write.mode("overwrite").parquet(place)
            try:
                slots = self.spark.read.schema(selected.schema).parquet(place)
                if slots.isEmpty():
                    log.info("batch %d selected no slot", batch_id)
                    return
                slots = index_slots(slots)
                lines = ordered_lines(
                    slots, self.connector, self.charset, self.max_retries, slots_per_partition
                )
                if line_table is not None:
                    own = f"{line_table}/batch_id={batch_id}"
                    lines.write.mode("overwrite").parquet(own)
                    lines = self.spark.read.schema(lines.schema).parquet(own)
                work(lines, slots, batch_id)
                if report_table is not None:
                    self._report(slots, lines).write.mode("overwrite").parquet(
                        f"{report_table}/batch_id={batch_id}"
                    )
                if slot_table is not None:
                    slots.write.mode("overwrite").parquet(f"{slot_table}/batch_id={batch_id}")
            finally:
                files, path = open_location(place)
                files.delete_dir(path)

        return self.slots().writeStream.foreachBatch(run)

    def _report(self, slots: DataFrame, lines: DataFrame) -> DataFrame:
        totals = slots.agg(
            F.count(F.lit(1)).alias("n_slots"),
            F.min("date").alias("min_date"),
            F.max("date").alias("max_date"),
        ).crossJoin(lines.agg(F.count(F.lit(1)).alias("n_lines")))
        start = self.start
        text = None
        if start is not None:
            text = StartRange(start.date, start.names).to_json()
        placed = dense_positions(slots.select("name", "date"), slot_order(["name", "date"]))
        names = listed_names(placed, NAMES_PER_ROW)
        return names.crossJoin(F.broadcast(totals)).select(
            "n_slots", "n_lines", "min_date", "max_date", F.lit(text).cast("string").alias("start"),
            "piece", "names", "n_names",
        )


@dataclass
class BatchReportListener(StreamingQueryListener):
    """Collects what the last ``keep`` batches of ``SlotStream.lines`` queries read, as they end:
    ``batch_id, n_slots, n_lines``, the range of their dates ``min_date, max_date`` and of their names
    ``first_name, last_name``.  Batches without a slot are left out.  All names are in the
    ``report_table`` of ``for_each_batch``."""

    keep: int = 1000
    batches: deque = field(init=False)

    def __post_init__(self) -> None:
        self.batches = deque(maxlen=self.keep)

    def onQueryStarted(self, event) -> None:  # noqa: ANN001
        pass

    def onQueryProgress(self, event) -> None:  # noqa: ANN001
        lines = event.progress.observedMetrics.get(OBSERVED)
        slots = event.progress.observedMetrics.get(OBSERVED_SLOTS)
        if lines is None or slots is None or not slots["n_slots"]:
            return
        report = {"batch_id": event.progress.batchId, "n_lines": lines["n_lines"], **slots.asDict()}
        self.batches.append(report)

    def onQueryIdle(self, event) -> None:  # noqa: ANN001
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001
        pass

    def to_json(self) -> str:
        return json.dumps(list(self.batches), default=str)
