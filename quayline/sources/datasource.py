"""The ``slots`` data source: catalogues as tables and as streams of new slots.

Batch: one task per listing root.  Streaming: a poll is a Spark job of the session, in which every root
is listed by a task and compared with what it held at the poll before; only if some root has new names
is there a batch.  What a poll sends is stored in a log folder by those tasks, so that a batch lists
nothing, and one that is run again, after a failure or a restart, sees the same rows.
"""

from __future__ import annotations

import dataclasses
import json
import logging
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrameReader, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    Filter,
    InputPartition,
)
from pyspark.sql.streaming import DataStreamReader

from quayline.sources.base import MAX_RETRIES, Connector, SlotSourceError, require
from quayline.sources.listing import arrow_schema, catalogue_schema, list_pages, list_roots
from quayline.sources.pollog import FRESH, PollLog
from quayline.sources.wanted import Wanted, wanted_by
from quayline.streaming.watch import Mailbox, watch

log = logging.getLogger(__name__)

FORMAT = "slots"
# What a session must set for Spark to hand filters to a reader.
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def accepted(batch: pa.RecordBatch, start: dict | None) -> pa.RecordBatch:
    """Rows that a start range, as JSON fields ``date`` and ``slots``, accepts."""
    if not start:
        return batch
    if start.get("date"):
        bound = datetime.fromisoformat(start["date"])
        bound = bound.astimezone(UTC) if bound.tzinfo else bound.replace(tzinfo=UTC)
        late = pc.greater_equal(batch.column("date"), pa.scalar(bound, pa.timestamp("us", "UTC")))
        batch = batch.filter(pc.fill_null(late, False))
    if start.get("slots"):
        named = pc.is_in(batch.column("name"), value_set=pa.array(start["slots"], pa.string()))
        batch = batch.filter(pc.invert(named))
    return batch


@dataclass
class RootsPartition(InputPartition):
    roots: list[str]


@dataclass
class ListedPartition(InputPartition):
    log_dir: str
    root: str


@dataclass
class PollPartition(InputPartition):
    root: str
    poll: int
    number: int = 0
    run: int = 0


NUMBERS = ("poll_number", "run_number")
# The one poll of a listing that is made before it is read.
LISTED = 1


class CatalogueReader(DataSourceReader):
    """One task per root, or per part of a root.

    Roots are found by a job of the session whose ``mailbox`` is given; without one, in this process.
    Where a failing listing counts as no slots it must fail as a whole: then that job makes the whole
    listing, a task per root, and it is read if all of them succeed.
    """

    def __init__(
        self,
        connector: Connector,
        max_retries: int,
        on_list_error: str,
        start: dict | None,
        kind: str = "",
        mailbox: str | None = None,
    ) -> None:
        self.connector = connector
        self.max_retries = max_retries
        self.on_list_error = on_list_error
        self.start = start
        self.kind = kind
        self.mailbox = mailbox
        self.wanted = Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Filters bound what is listed.  Spark applies them all the same: bounds may be wider."""
        self.wanted = wanted_by(filters)
        yield from filters

    def _ask(self, log_dir: str | None) -> dict:
        request = {
            "connector": self.kind, "parameters": self.connector.to_json(),
            "max_retries": self.max_retries, "wanted": self.wanted.to_dict(),
        }
        if log_dir is not None:
            request |= {"log_dir": log_dir, "poll": LISTED, "previous": None, "most": None}
        return Mailbox(self.mailbox).ask(uuid.uuid4().hex, request)

    def partitions(self) -> list[InputPartition]:
        empty = self.on_list_error == "empty"
        if self.mailbox is None:
            if empty:
                return [RootsPartition([])]
            found = list_roots(self.connector, self.max_retries, self.wanted, split=True)
        elif empty:
            place = f"{self.mailbox}/listing-{uuid.uuid4().hex}"
            try:
                self._ask(place)
            except SlotSourceError as error:
                log.error("going on without slots: %s", error)
                return []
            return [ListedPartition(place, r) for r in PollLog(place).roots(LISTED) or []]
        else:
            found = self._ask(None)["roots"]
        return [RootsPartition([root]) for root in found]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, ListedPartition):
            for page in PollLog(partition.log_dir).read(LISTED, partition.root):
                yield accepted(page.drop_columns([FRESH]), self.start)
            return
        if not isinstance(partition, RootsPartition):
            # Of no partitions Spark makes one that says nothing.
            return
        try:
            roots = partition.roots or list_roots(self.connector, self.max_retries, self.wanted)
            pages = list_pages(self.connector, roots, self.max_retries, self.wanted)
            first = next(pages, None)
        except SlotSourceError as error:
            if self.on_list_error == "fail":
                raise
            log.error("going on without slots: %s", error)
            return
        if first is not None:
            yield accepted(first, self.start)
            for page in pages:
                yield accepted(page, self.start)


class UnboundedReader(CatalogueReader):
    """Takes no filters.  Spark refuses a reader that does unless ``PUSHDOWN`` is set."""

    pushFilters = DataSourceReader.pushFilters


class PollReader(DataSourceStreamReader):
    """Offsets are polls, by time in milliseconds.

    The first poll of a run sends everything, since the query may have been started with another
    range than before; after it, a poll that finds nothing new is none.  Polls are made by the session
    whose ``mailbox`` is given (see ``quayline.streaming.watch``); without one, as where the reader is
    used by itself, in this process.
    """

    def __init__(
        self,
        connector: Connector,
        max_retries: int,
        log_dir: str,
        interval_ms: int,
        with_poll: bool = True,
        start: dict | None = None,
        most: int | None = None,
        kind: str = "",
        mailbox: str | None = None,
        with_numbers: bool = False,
    ) -> None:
        self.connector = connector
        self.max_retries = max_retries
        self.with_numbers = with_numbers
        self.log = PollLog(log_dir)
        self.interval_ms = interval_ms
        self.with_poll = with_poll
        self.start = start
        self.most = most
        self.kind = kind
        self.mailbox = mailbox
        self.sender = uuid.uuid4().hex
        self.last: dict | None = None
        self.token: str | None = None
        self.more = False

    def initialOffset(self) -> dict:
        return {"poll": 0}

    def _look(self, poll: int, previous: int | None) -> tuple[int, bool]:
        """Number of new slots of a poll, and whether there are more."""
        if self.mailbox is not None:
            request = {
                "connector": self.kind, "parameters": self.connector.to_json(),
                "max_retries": self.max_retries, "log_dir": self.log.location,
                "poll": poll, "previous": previous, "most": self.most,
            }
            answer = Mailbox(self.mailbox).ask(self.sender, request)
            return answer["new"], answer["cut"]
        roots = list_roots(self.connector, self.max_retries)
        found = {
            root: self.log.poll_root(self.connector, self.max_retries, root, poll, previous, self.most)
            for root in roots
        }
        if previous is None or any(new for new, _ in found.values()):
            own = [root for root, (new, _) in found.items() if new]
            self.log.write_poll(poll, own, first=previous is None)
        return sum(n for n, _ in found.values()), any(cut for _, cut in found.values())

    def latestOffset(self) -> dict:
        now = time.time_ns() // 1_000_000
        now -= now % self.interval_ms
        if self.last and now <= self.last["poll"] and not self.more:
            return self.last
        token = self.connector.fresh().change_token()
        if self.last and token is not None and token == self.token and not self.more:
            return self.last
        # A clock set back must not move the stream back.
        previous = self.last["poll"] if self.last else None
        poll = max(now, max(self.log.latest(), previous or 0) + 1)
        new, self.more = self._look(poll, previous)
        self.token = token
        if self.last is None or new:
            self.last = {"poll": poll}
        return self.last

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """The roots with new slots, which the poll has entered in the log."""
        if start["poll"] >= end["poll"]:
            return []
        roots = self.log.roots(end["poll"])
        if roots is None:
            raise SlotSourceError(f"the log at {self.log.location} does not hold poll {end['poll']}")
        numbers = self.log.number(start["poll"], end["poll"]) if self.with_numbers else (0, 0)
        return [PollPartition(root, end["poll"], *numbers) for root in roots]

    def read(self, partition: PollPartition) -> Iterator[pa.RecordBatch]:
        poll = datetime.fromtimestamp(partition.poll / 1000, UTC)
        names = arrow_schema(self.connector).names
        for batch in self.log.read(partition.poll, partition.root):
            rows = accepted(batch.filter(batch.column(FRESH)), self.start)
            if not rows.num_rows:
                continue
            columns, named = [*rows.columns[:-1]], names
            if self.with_poll:
                columns.append(pa.array([poll] * rows.num_rows, pa.timestamp("us", "UTC")))
                named = [*names, "poll"]
            if self.with_numbers:
                for number, label in zip((partition.number, partition.run), NUMBERS, strict=True):
                    columns.append(pa.array([number] * rows.num_rows, pa.int64()))
                    named = [*named, label]
            yield pa.RecordBatch.from_arrays(columns, names=named)

    def commit(self, end: dict) -> None:
        self.log.forget_before(end["poll"])


class SlotSource(DataSource):
    """``spark.read.format("slots")`` / ``spark.readStream.format("slots")``.

    Options: ``connector`` (its short name) and ``parameters`` (its fields as JSON), or the scalar
    fields as options of their own; ``maxRetries`` (3); ``start``, a ``StartRange`` as JSON.  Batch:
    ``onListError`` (``fail`` or ``empty``) and ``pushFilters`` (``false``).  Stream: ``logDir`` (shared folder, required),
    ``pollInterval`` in ms (1000), ``maxSlotsPerTrigger`` and ``withPoll`` (``true`` adds the time of
    the poll as a column), ``withNumbers`` (``true`` adds ``poll_number`` and ``run_number``, the number
    of the poll's batch and of the first batch of its run).  A stream sends a name when it appears, and all names again when it is
    restarted; ``SlotStream`` keeps the first of each.  Rows are as the connector refines them.

    With ``pushFilters`` and the session's ``spark.sql.python.filterPushdown.enabled``, filters bound the
    listing.  Spark then keeps what it listed for the first filter with the loaded DataFrame, also for
    other filters: load anew for every query, or use ``read_catalogue(..., where=...)``, which does.
    """

    connectors: dict[str, type[Connector]] = {}
    mailbox: str | None = None

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _with(self, column: str) -> bool:
        return self.options.get(f"with{column}", "false").lower() == "true"

    def schema(self) -> str:
        listed = catalogue_schema(self._kind())
        listed = f"{listed}, poll timestamp" if self._with("Poll") else listed
        return ", ".join([listed, *(f"{n} long" for n in NUMBERS if self._with("Numbers"))])

    def _kind(self) -> type[Connector]:
        kind = self.options.get("connector")
        if kind not in self.connectors:
            raise ValueError(f"connector must be one of {sorted(self.connectors)}, not {kind!r}")
        return self.connectors[kind]

    def _connector(self) -> Connector:
        cls = self._kind()
        if "parameters" in self.options:
            return cls.from_json(self.options["parameters"])
        given = {}
        for field in dataclasses.fields(cls):
            if field.name in self.options:
                text = self.options[field.name]
                kinds = str(field.type)
                if kinds.startswith(("str", "int", "bool", "float")):
                    given[field.name] = text if kinds.startswith("str") else json.loads(text)
                else:
                    given[field.name] = json.loads(text)
        return cls(**given)

    def _max_retries(self) -> int:
        return int(self.options.get("maxRetries", MAX_RETRIES))

    def _start(self) -> dict | None:
        text = self.options.get("start")
        return json.loads(text) if text else None

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        if self._with("Poll") or self._with("Numbers"):
            raise ValueError("withPoll and withNumbers are for streams")
        on_error = self.options.get("onListError", "fail")
        if on_error not in ("fail", "empty"):
            raise ValueError("onListError must be fail or empty")
        push = self.options.get("pushFilters", "false").lower() == "true"
        return (CatalogueReader if push else UnboundedReader)(
            self._connector(),
            self._max_retries(),
            on_error,
            self._start(),
            self.options["connector"],
            self.mailbox,
        )

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: ANN001
        log_dir = self.options.get("logDir")
        interval = int(self.options.get("pollInterval", 1000))
        most = self.options.get("maxSlotsPerTrigger")
        require(logDir=log_dir, pollInterval=interval)
        if most is not None:
            require(maxSlotsPerTrigger=int(most))
        return PollReader(
            self._connector(),
            self._max_retries(),
            log_dir,
            interval,
            self._with("Poll"),
            self._start(),
            None if most is None else int(most),
            self.options["connector"],
            self.mailbox,
            self._with("Numbers"),
        )


def built_in() -> dict[str, type[Connector]]:
    from quayline.sources.dcm import DcmConnector, DcmFilesConnector
    from quayline.sources.files import FilesConnector
    from quayline.sources.ftp import FtpConnector
    from quayline.sources.ftps import FtpsConnector
    from quayline.sources.gcs import GcsConnector
    from quayline.sources.sftp import SftpConnector

    return {
        "files": FilesConnector,
        "ftp": FtpConnector,
        "ftps": FtpsConnector,
        "sftp": SftpConnector,
        "gcs": GcsConnector,
        "dcm": DcmConnector,
        "dcm_files": DcmFilesConnector,
    }


def register_sources(spark: SparkSession, **plugins: type[Connector]) -> None:
    """Make the format known to the session, with further connectors by short name.  Connectors
    that were added to the session before stay."""
    known = {**built_in(), **getattr(spark, "_slot_connectors", {}), **plugins}
    spark._slot_connectors = known
    own = {"connectors": known, "mailbox": watch(spark, known)}
    spark.dataSource.register(type("SlotSource", (SlotSource,), own))


def _registered(spark: SparkSession, connector: Connector) -> str:
    """The short name of a connector's class, made known to the session."""
    cls = type(connector)
    kind = next((k for k, known in built_in().items() if known is cls), cls.__name__)
    register_sources(spark, **{kind: cls})
    return kind


def listing_reader(
    spark: SparkSession, connector: Connector, max_retries: int, on_list_error: str
) -> DataFrameReader:
    """A reader of the catalogue whose filters bound the listing; each load is for one query.

    The session gets the setting without which Spark refuses such readers, whichever source they are
    of, so that no query that worked before changes.
    """
    spark.conf.set(PUSHDOWN, "true")
    reader = spark.read.format(SlotSource.name()).option("connector", _registered(spark, connector))
    reader = reader.option("parameters", connector.to_json()).option("maxRetries", max_retries)
    return reader.option("onListError", on_list_error).option("pushFilters", True)


def poll_reader(
    spark: SparkSession,
    connector: Connector,
    max_retries: int,
    log_dir: str,
    poll_interval_ms: int,
    max_slots: int | None = None,
    with_numbers: bool = False,
) -> DataStreamReader:
    reader = spark.readStream.format(SlotSource.name()).option("withPoll", True)
    reader = reader.option("withNumbers", with_numbers)
    reader = reader.option("logDir", log_dir).option("pollInterval", poll_interval_ms)
    if max_slots is not None:
        reader = reader.option("maxSlotsPerTrigger", max_slots)
    return (
        reader.option("connector", _registered(spark, connector))
        .option("parameters", connector.to_json())
        .option("maxRetries", max_retries)
    )
