"""Polls by Spark jobs.

A streaming source decides about a new batch in a process of the driver that has no session.  There it
only leaves a request in a mailbox, a folder of the session; a thread of the session sees it, lists
every root in a task, and leaves the answer.  No listing is made on the driver, and where nothing is
new there is no batch.
"""

from __future__ import annotations

import json
import logging
import threading
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quayline.session import scratch_path
from quayline.sources.base import Connector, SlotSourceError
from quayline.sources.listing import list_roots
from quayline.sources.location import open_location
from quayline.sources.pollog import PollLog
from quayline.sources.wanted import Wanted

log = logging.getLogger(__name__)

# Seconds between two looks into the mailbox: on a local disk, and elsewhere.
LOOK_SECONDS, FAR_LOOK_SECONDS = 0.05, 0.5
# A request that nobody takes up: the session that made the stream is gone.
UNHEARD_SECONDS = 120


def look_seconds(files: fs.FileSystem) -> float:
    return LOOK_SECONDS if isinstance(files, fs.LocalFileSystem) else FAR_LOOK_SECONDS


class Mailbox:
    """Requests and answers as small files."""

    def __init__(self, location: str) -> None:
        self.location = location

    def _path(self, sender: str, kind: str) -> tuple[fs.FileSystem, str]:
        files, base = open_location(self.location)
        return files, f"{base}/{sender}.{kind}"

    def put(self, sender: str, kind: str, content: dict) -> None:
        files, path = self._path(sender, kind)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        with files.open_output_stream(path) as out:
            out.write(json.dumps(content).encode())

    def get(self, sender: str, kind: str) -> dict | None:
        """None if there is nothing, or nothing whole yet."""
        files, path = self._path(sender, kind)
        try:
            with files.open_input_stream(path) as source:
                return json.loads(source.read())
        except (OSError, ValueError):
            return None

    def senders(self) -> list[str]:
        files, base = open_location(self.location)
        found = files.get_file_info(fs.FileSelector(base, allow_not_found=True))
        return [i.base_name[:-4] for i in found if i.base_name.endswith(".ask")]

    def ask(self, sender: str, request: dict) -> dict:
        """Leave a request and wait for its answer."""
        request = {**request, "id": uuid.uuid4().hex}
        files, _ = open_location(self.location)
        self.put(sender, "ask", request)
        heard, since = False, time.monotonic()
        while True:
            time.sleep(look_seconds(files))
            answer = self.get(sender, "answer")
            if answer is not None and answer["id"] == request["id"]:
                if answer.get("error"):
                    raise SlotSourceError(answer["error"])
                return answer
            heard = heard or (self.get(sender, "heard") or {}).get("id") == request["id"]
            if not heard and time.monotonic() - since > UNHEARD_SECONDS:
                raise SlotSourceError("no session takes up the polls of this stream")


def roots_in_tasks(
    spark: SparkSession,
    connector: Connector,
    max_retries: int,
    wanted: Wanted | None = None,
    split: bool = False,
) -> list[str]:
    """The roots of a collection, found in a task.  They become partitions, of which the driver holds a
    list in any case."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = list_roots(connector, max_retries, wanted, split)
                yield pa.RecordBatch.from_pydict({"root": pa.array(found, pa.string())})

    one = spark.range(1, numPartitions=1)
    return [r[0] for r in one.mapInArrow(find, "root string").collect()]


def poll_in_tasks(
    spark: SparkSession,
    connector: Connector,
    max_retries: int,
    log_dir: str,
    poll: int,
    previous: int | None,
    most: int | None,
    wanted: Wanted | None = None,
) -> tuple[int, bool]:
    """Poll a collection, one task per root, and enter the poll in the log if it found new slots or is
    the first one.  Gives the number of new slots, and whether some were left out."""
    polls = PollLog(log_dir)
    roots = roots_in_tasks(spark, connector, max_retries, wanted)
    # The bound of a batch is dealt out to the roots.
    share = None if most is None else -(-most // max(1, len(roots)))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for root in batch.column("root").to_pylist():
                new, cut = polls.poll_root(
                    connector, max_retries, root, poll, previous, share, wanted
                )
                yield pa.RecordBatch.from_pydict({"root": [root], "new": [new], "cut": [cut]})

    table = spark.createDataFrame(list(enumerate(roots)), "place int, root string")
    placed = table.repartitionById(max(1, len(roots)), F.col("place")).select("root")
    found = placed.mapInArrow(look, "root string, new long, cut boolean").filter("new > 0").collect()
    new = sum(r["new"] for r in found)
    if new or previous is None:
        polls.write_poll(poll, sorted(r["root"] for r in found), first=previous is None)
    return new, any(r["cut"] for r in found)


class Watch(threading.Thread):
    """Answers the requests of a session's streams, as long as the session lives."""

    def __init__(self, spark: SparkSession, connectors: dict[str, type[Connector]]) -> None:
        super().__init__(name="slot-polls", daemon=True)
        self.spark = spark
        self.connectors = connectors
        self.mailbox = Mailbox(scratch_path(spark, "polls"))
        self._answered: dict[str, str] = {}

    def _alive(self) -> bool:
        context = self.spark.sparkContext
        return context._jsc is not None and not context._jsc.sc().isStopped()

    def run(self) -> None:
        files, _ = open_location(self.mailbox.location)
        while True:
            time.sleep(look_seconds(files))
            try:
                if not self._alive():
                    return
                for sender in self.mailbox.senders():
                    self._serve(sender)
            except Exception as error:
                # A session that is being stopped, or a mailbox that cannot be reached now.
                log.warning("looking for polls: %s", error)
                time.sleep(FAR_LOOK_SECONDS)

    def _serve(self, sender: str) -> None:
        request = self.mailbox.get(sender, "ask")
        if request is None or self._answered.get(sender) == request["id"]:
            return
        self.mailbox.put(sender, "heard", {"id": request["id"]})
        try:
            connector = self.connectors[request["connector"]].from_json(request["parameters"])
            retries, wanted = request["max_retries"], Wanted.from_dict(request.get("wanted"))
            if "log_dir" in request:
                new, cut = poll_in_tasks(
                    self.spark, connector, retries, request["log_dir"], request["poll"],
                    request["previous"], request["most"], wanted,
                )
                answer = {"new": new, "cut": cut}
            else:
                # What a batch read has to list.
                found = roots_in_tasks(self.spark, connector, retries, wanted, split=True)
                answer = {"roots": found}
        except Exception as error:
            answer = {"error": f"listing failed: {error}"}
        self._answered[sender] = request["id"]
        self.mailbox.put(sender, "answer", {"id": request["id"], **answer})


def watch(spark: SparkSession, connectors: dict[str, type[Connector]]) -> str:
    """The mailbox of the session, with a thread that looks into it."""
    running = getattr(spark, "_slot_watch", None)
    if running is None or not running.is_alive():
        running = Watch(spark, connectors)
        running.start()
        spark._slot_watch = running
    running.connectors = connectors
    return running.mailbox.location
