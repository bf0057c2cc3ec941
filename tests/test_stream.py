"""Streams: order, start ranges, restart, failures, reports."""

from __future__ import annotations

import sys
import time
from dataclasses import dataclass

import pytest
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import FIVE
from quayline import (
    BatchReportListener,
    SlotStream,
    StartRange,
    batch_descriptions,
    batch_report,
    read_catalogue,
    register_sources,
    replayed_slots,
)
from flaky import FlakyFiles
from quayline.sources import buckets, listing, pollog
from quayline.sources.base import Connector, Slot, SlotSourceError
from quayline.sources.datasource import PollReader
from quayline.sources.dcm import DcmFilesConnector
from quayline.sources.files import FilesConnector
from quayline.sources.pollog import PollLog
from quayline.streaming import watch

# Workers cannot import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def lines(*names):
    return [f"{line} - {n}" for n in names for line in FIVE]


class Run:
    """One query location, run to the end of what is there."""

    def __init__(self, spark, folder, start=None, connector=None, retries=3):
        self.spark, self.base = spark, folder.path.parent
        self.connector = connector or FilesConnector(str(folder.path))
        self.stream = SlotStream(
            spark, self.connector, str(self.base / "polls"), start, max_retries=retries,
            poll_interval_ms=1,
        )

    def append(self):
        query = (
            self.stream.lines().writeStream.format("parquet")
            .option("checkpointLocation", str(self.base / "checkpoint"))
            .trigger(availableNow=True).start(str(self.base / "out"))
        )
        query.awaitTermination()
        got = self.spark.read.parquet(str(self.base / "out"))
        return sorted(r.value for r in got.collect())

    def batches(self):
        got = []

        def work(found, slots, batch_id):
            got.append(([r.value for r in found.collect()],
                        [r.name for r in slots.orderBy("slot_index").collect()], batch_id))

        query = (
            self.stream.for_each_batch(work)
            .option("checkpointLocation", str(self.base / "checkpoint"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return got


def test_new_slots_once_and_restart(spark, folder):
    run = Run(spark, folder)
    folder.put("one.txt", date="2016-12-01")
    assert run.append() == lines("one.txt")
    assert run.append() == lines("one.txt")
    folder.put("one.txt", ["changed"], date="2017-12-01")
    folder.put("old.txt", date="2010-12-01", packed=True)
    # A changed file is not read again, a late file with an old date is; new options of a new query
    # object apply.
    assert Run(spark, folder).append() == sorted(lines("one.txt", "old.txt"))
    assert len(list((folder.path.parent / "polls").iterdir())) <= 2


def test_slot_order_in_a_batch(spark, folder):
    for name, date in (("b.txt", "2016-12-02"), ("z.txt", "2016-12-01"), ("a.txt", "2016-12-02")):
        folder.put(name, date=date)
    run = Run(spark, folder, StartRange("2016-01-01"))
    assert run.batches() == [(lines("z.txt", "a.txt", "b.txt"), ["z.txt", "a.txt", "b.txt"], 0)]
    assert run.batches() == []  # nothing new: the work is not called
    folder.put("c.txt")
    assert [b[:2] for b in run.batches()] == [(lines("c.txt"), ["c.txt"])]


@pytest.mark.parametrize(
    ("start", "expected"),
    [
        (None, ["x.txt", "y_1.txt", "y_2.txt"]),
        (StartRange("2016-12-01"), ["y_1.txt", "y_2.txt"]),
        (StartRange("2016-12-01", ("y_1.txt",)), ["y_2.txt"]),
        (StartRange(names=("y_1.txt",)), ["x.txt", "y_2.txt"]),
    ],
)
def test_start(spark, folder, start, expected):
    folder.put("x.txt", date="2016-10-11")
    folder.put("y_1.txt", date="2016-12-01")
    folder.put("y_2.txt", date="2016-12-01")
    assert [b[1] for b in Run(spark, folder, start).batches()] == [expected]


def test_start_from_a_table(spark, folder):
    folder.put("x.txt")
    folder.put("y.txt")
    seen = spark.createDataFrame([("x.txt",)], "name string")
    assert Run(spark, folder, StartRange(seen=seen)).append() == lines("y.txt")


def test_slot_table(spark, folder):
    """What was read when, and going on from it under a new checkpoint."""
    run = Run(spark, folder)
    table = str(folder.path.parent / "table")
    for name in ("a.txt", "b.txt"):
        folder.put(name)
        query = (
            run.stream.for_each_batch(lambda found, slots, batch: found.count(), slot_table=table)
            .option("checkpointLocation", str(folder.path.parent / "checkpoint"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    read = spark.read.parquet(table).drop("poll").withColumnRenamed("batch_id", "poll")
    assert {(r.poll, r.description) for r in batch_descriptions(read).collect()} == {
        (0, "a.txt"), (1, "b.txt"),
    }
    assert {(r.poll, r.n_slots) for r in batch_report(read).collect()} == {(0, 1), (1, 1)}
    folder.put("c.txt")
    # Remembering everything, and only the last batch.
    for seen, expected in ((read, ["c.txt"]), (read.filter("poll = 1"), ["a.txt", "c.txt"])):
        again = SlotStream(
            spark, run.connector, str(folder.path.parent / f"polls{len(expected)}"),
            StartRange(seen=seen), poll_interval_ms=1,
        )
        got = []
        query = (
            again.for_each_batch(
                lambda found, slots, batch, got=got: got.extend(r.name for r in slots.collect())
            )
            .option("checkpointLocation", str(folder.path.parent / f"checkpoint{len(expected)}"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        assert sorted(got) == expected


def test_failures(spark, folder):
    folder.put("one.txt")
    marks = str(folder.path.parent / "marks")
    bad = FlakyFiles(str(folder.path), marks=marks, listBadTries=2, fetchBadTries=2)
    with pytest.raises(StreamingQueryException, match="listing"):
        Run(spark, folder, connector=bad, retries=1).append()
    # The batch was not committed: a restart lists, and then fetches, again.
    with pytest.raises(StreamingQueryException, match="fetching slot one.txt"):
        Run(spark, folder, connector=bad, retries=1).append()
    assert Run(spark, folder, connector=bad, retries=1).append() == lines("one.txt")


def test_failed_batch_sees_its_first_listing(spark, folder):
    folder.put("one.txt")
    marks = str(folder.path.parent / "marks")
    bad = FlakyFiles(str(folder.path), marks=marks, fetchBadTries=1)
    with pytest.raises(StreamingQueryException):
        Run(spark, folder, connector=bad, retries=0).batches()
    folder.put("two.txt")
    # First the batch that failed, with the slots it had; what came later is a batch of its own.
    assert [b[1:] for b in Run(spark, folder, connector=bad).batches()] == [(["one.txt"], 0)]
    assert [b[1:] for b in Run(spark, folder, connector=bad).batches()] == [(["two.txt"], 1)]


def test_polls_show_more_slots(spark, folder):
    for name in ("a.txt", "b.txt", "c.txt", "d.txt"):
        folder.put(name)
    marks = str(folder.path.parent / "marks")
    run = Run(spark, folder, connector=FlakyFiles(str(folder.path), marks=marks, splitInside=True))
    # A poll lists once: what it sees is what its batch gets.
    assert [[b[1] for b in run.batches()] for _ in range(5)] == [
        [["a.txt"]], [["b.txt"]], [["c.txt"]], [["d.txt"]], [],
    ]


@dataclass(frozen=True, repr=False)
class InTasksOnly(FilesConnector):
    """Neither lists nor looks for parts outside of tasks."""

    def _in_task(self) -> None:
        from pyspark import TaskContext

        if TaskContext.get() is None:
            raise RuntimeError("listed on the driver")

    def roots(self):
        self._in_task()
        return super().roots()

    def list(self, root):
        self._in_task()
        return super().list(root)


@pytest.mark.parametrize("through_format", [False, True])
def test_polls_list_in_tasks(spark, folder, through_format):
    """Nothing is listed on the driver, and idle polls make no batch."""
    folder.put("a/one.txt")
    folder.put("b/two.txt")
    base = folder.path.parent
    connector = InTasksOnly(str(folder.path), recursive=True)
    with pytest.raises(RuntimeError):
        connector.list("")
    if through_format:
        register_sources(spark, in_tasks=InTasksOnly)
        listed = (
            spark.readStream.format("slots")
            .options(connector="in_tasks", path=str(folder.path), recursive="true", pollInterval=1)
            .option("logDir", str(base / "polls")).load()
        )
    else:
        listed = SlotStream(spark, connector, str(base / "polls"), poll_interval_ms=1).listings()
    query = (
        listed.select("name").writeStream.format("parquet")
        .option("checkpointLocation", str(base / "checkpoint"))
        .trigger(processingTime="50 milliseconds").start(str(base / "out"))
    )
    try:
        query.processAllAvailable()
        time.sleep(1)
        done = len(list((base / "checkpoint" / "commits").glob("[0-9]*")))
        time.sleep(2)
        assert len(list((base / "checkpoint" / "commits").glob("[0-9]*"))) == done == 1
        folder.put("b/three.txt")
        query.processAllAvailable()
        names = [r.name for r in spark.read.parquet(str(base / "out")).collect()]
        assert sorted(names) == ["a/one.txt", "b/three.txt", "b/two.txt"]
        # Only the root that changed has a further listing.
        assert sorted(len(list(p.iterdir())) for p in (base / "polls").glob("root=*")) == [1, 1, 2]
    finally:
        query.stop()


def contents(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*"))


def test_nothing_new_means_nothing_done(spark, folder):
    """After a batch, polls that find nothing new leave no batch, file or folder."""
    for name in ("a.txt", "b.txt"):
        folder.put(name)
    base = folder.path.parent
    marks = str(base / "marks")
    run = Run(spark, folder, connector=FlakyFiles(str(folder.path), marks=marks))
    query = (
        run.stream.lines().writeStream.format("parquet")
        .option("checkpointLocation", str(base / "checkpoint"))
        .trigger(processingTime="100 milliseconds").start(str(base / "out"))
    )
    try:
        query.processAllAvailable()
        time.sleep(1)
        before = contents(base / "out") + contents(base / "checkpoint") + contents(base / "polls")
        polls = len(contents(base / "marks"))
        time.sleep(3)
        after = contents(base / "out") + contents(base / "checkpoint") + contents(base / "polls")
        assert after == before
        assert len(contents(base / "marks")) >= polls + 5  # it did look
        assert sum(p["numInputRows"] for p in query.recentProgress) == 2
        folder.put("c.txt")
        query.processAllAvailable()
        assert spark.read.parquet(str(base / "out")).count() == 15
        # Only the new slot was sent.
        assert sum(p["numInputRows"] for p in query.recentProgress) == 3
    finally:
        query.stop()


def test_bounded_batches(spark, folder):
    for i in range(7):
        folder.put(f"f{i}.txt")
    base = folder.path.parent
    stream = SlotStream(
        spark, FilesConnector(str(folder.path)), str(base / "polls"), poll_interval_ms=1, max_slots=3
    )
    sizes = []
    query = (
        stream.for_each_batch(lambda found, slots, batch: sizes.append(slots.count()))
        .option("checkpointLocation", str(base / "checkpoint"))
        .trigger(processingTime="50 milliseconds").start()
    )
    try:
        deadline = time.time() + 60
        while sum(sizes) < 7 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        query.stop()
    assert sizes == [3, 3, 1]


def test_live_report(spark, folder):
    base = folder.path.parent
    run = Run(spark, folder, StartRange("2016-01-01", ("x.txt",)))
    marks = str(base / "marks")
    stream = SlotStream(
        spark, FlakyFiles(str(folder.path), marks=marks), str(base / "polls"), run.stream.start,
        poll_interval_ms=1,
    )

    def work(found, slots, batch):
        found.count()
        found.collect()

    for names in (("b.txt", "a.txt"), ("old.txt",)):
        for name in names:
            folder.put(name, date="2016-02-03" if name == "old.txt" else "2016-12-01")
        query = (
            stream.for_each_batch(
                work, line_table=str(base / "lines"), report_table=str(base / "report")
            )
            .option("checkpointLocation", str(base / "checkpoint"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    rows = spark.read.parquet(str(base / "report")).orderBy("batch_id").collect()
    assert [(r.batch_id, r.n_slots, r.n_lines, r.names, r.n_names) for r in rows] == [
        (0, 2, 10, ["a.txt", "b.txt"], 2), (1, 1, 5, ["old.txt"], 1),
    ]
    assert [str(r.min_date)[:10] for r in rows] == ["2016-12-01", "2016-02-03"]
    assert rows[0].start == '{"date": "2016-01-01", "slots": ["x.txt"]}'
    # However often the work reads its lines, a slot is fetched once.
    import hashlib

    for name in ("a.txt", "b.txt", "old.txt"):
        key = hashlib.sha256(f"fetch {name}".encode()).hexdigest()[:24]
        assert len(list((base / "marks" / key).iterdir())) == 1


def test_report(spark, folder):
    listener = BatchReportListener()
    spark.streams.addListener(listener)
    try:
        folder.put("a.txt")
        folder.put("b.txt")
        run = Run(spark, folder)
        run.append()
        folder.put("c.txt")
        run.append()
        deadline = time.time() + 20
        while len(listener.batches) < 2 and time.time() < deadline:
            time.sleep(0.2)
        assert [b["n_lines"] for b in listener.batches] == [10, 5]
        assert [b["n_slots"] for b in listener.batches] == [2, 1]
        assert [(b["first_name"], b["last_name"]) for b in listener.batches] == [
            ("a.txt", "b.txt"), ("c.txt", "c.txt"),
        ]
        assert {str(b["min_date"])[:10] for b in listener.batches} == {"2016-12-01"}
        assert '"batch_id": 0' in listener.to_json()
    finally:
        spark.streams.removeListener(listener)


def test_remembered_batches(spark, folder):
    """Names of batches before the last ones come back after a restart, and never before."""
    base = folder.path.parent
    read = []

    def run(batches):
        stream = SlotStream(
            spark, FilesConnector(str(folder.path)), str(base / "polls"), poll_interval_ms=1,
            remember_batches=2,
        )
        query = (
            stream.for_each_batch(
                lambda found, slots, batch: read.append([r.name for r in slots.collect()]),
                slot_table=str(base / "table"),
            )
            .option("checkpointLocation", str(base / "checkpoint"))
            .trigger(processingTime="50 milliseconds").start()
        )
        try:
            for name in batches or [None]:
                if name:
                    folder.put(name)
                want = len(read) + 1
                deadline = time.time() + 60
                while len(read) < want and time.time() < deadline:
                    time.sleep(0.1)
            time.sleep(1.5)
        finally:
            query.stop()

    run(["a.txt", "b.txt", "c.txt", "d.txt"])
    assert read == [["a.txt"], ["b.txt"], ["c.txt"], ["d.txt"]]
    # Within the run nothing came back, though only two batches are remembered.
    polls = spark.createDataFrame(
        [(p, n) for p, names in ((0, "a"), (1, "ab"), (2, "abc"), (3, "abcd"), (4, "abcde"))
         for n in names],
        "poll int, name string",
    )
    again = replayed_slots(polls, F.lit(4), F.lit(2))
    folder.put("e.txt")
    run([])
    assert sorted(read[4]) == sorted([f"{r.name}.txt" for r in again.collect()] + ["e.txt"])


def test_remembered_in_state(spark, folder):
    """No table is needed: ``lines()`` remembers too, restarts after restart."""
    base = folder.path.parent
    stream = SlotStream(
        spark, FilesConnector(str(folder.path)), str(base / "polls"), poll_interval_ms=1,
        remember_batches=1,
    )
    seen = []
    for step in ("a.txt", "b.txt", None, "c.txt", None):
        if step:
            folder.put(step)
        query = (
            stream.lines().writeStream.format("parquet")
            .option("checkpointLocation", str(base / "checkpoint"))
            .trigger(availableNow=True).start(str(base / "out"))
        )
        query.awaitTermination()
        lines = spark.read.parquet(str(base / "out"))
        seen.append({r["slot"]: r["count"] // 5 for r in lines.groupBy("slot").count().collect()})
    # Read at polls 1 and 2; a again at 3, b at 4 (with c), a at 5: the last run's names are known.
    assert seen == [
        {"a.txt": 1},
        {"a.txt": 1, "b.txt": 1},
        {"a.txt": 2, "b.txt": 1},
        {"a.txt": 2, "b.txt": 2, "c.txt": 1},
        {"a.txt": 3, "b.txt": 2, "c.txt": 1},
    ]


def test_only_batches_have_numbers(tmp_path):
    """A poll that never became a batch moves no number; a repeated batch keeps its own."""
    log = PollLog(str(tmp_path))
    log.write_poll(10, [""], first=True)
    assert log.number(0, 10) == (1, 1)
    log.write_poll(20, [""])
    assert log.number(10, 20) == (2, 1)
    log.write_poll(30, [""])  # asked for by a query that was then stopped
    log.write_poll(40, [""], first=True)
    assert log.number(20, 40) == (3, 3) == log.number(20, 40)
    log.forget_before(40)
    log.write_poll(50, [""])
    assert log.number(40, 50) == (4, 3)


def test_rows_pass_the_state_whole(spark, tmp_path):
    """Dates to the microsecond and beyond nanosecond years, long numbers, nulls and odd names."""
    from datetime import datetime

    from quayline.streaming.horizon import recent_names

    schema = (
        "name string, date timestamp_ntz, length long, poll timestamp, `own.tags` array<string>, "
        "poll_number long, run_number long"
    )
    poll = datetime(2024, 1, 2, 3, 4, 5, 678901)
    rows = [
        ('q"uo\\te\n.txt', datetime(2016, 12, 1, 1, 2, 3, 456789), 2**62 + 1, poll, ["x", None], 1, 1),
        ("far", datetime(9999, 12, 31, 23, 59, 59, 999999), None, poll, None, 1, 1),
        ("early", datetime(1, 1, 1), 0, None, [], 1, 1),
        ("none", None, None, None, None, 1, 1),
        ("none", None, None, None, None, 1, 1),
    ]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    listed = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    query = (
        recent_names(listed, 2).writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    found = spark.read.schema(recent_names(listed, 2).schema).parquet(str(tmp_path / "out")).collect()
    assert sorted(map(tuple, found), key=str) == sorted({str(r[:5]): r[:5] for r in rows}.values(), key=str)


def test_format(spark, folder):
    folder.put("a.txt")
    register_sources(spark)
    listings = (
        spark.readStream.format("slots")
        .options(connector="files", path=str(folder.path), logDir=f"{folder.path.parent}/polls")
        .load()
    )
    assert listings.isStreaming
    assert listings.columns == ["name", "date", "length"]
    query = (
        listings.writeStream.format("memory").queryName("listed").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert [r.name for r in spark.table("listed").collect()] == ["a.txt"]


def test_dcm_format(spark, folder):
    names = ("dcm_account1_click_2016092602_x.csv", "dcm_account1_activity_20160927_x.csv", "other")
    for name in names:
        folder.put(name)
    register_sources(spark)
    reader = spark.read.format("slots").options(connector="dcm_files", path=str(folder.path))
    assert {(r.dcm_type, str(r.date)) for r in reader.load().collect()} == {
        ("click", "2016-09-26 02:00:00"), ("activity", "2016-09-27 00:00:00"),
    }
    some = reader.option("types", '["click"]').load()
    assert [r.name for r in some.collect()] == [names[0]]
    catalogue = read_catalogue(spark, DcmFilesConnector(str(folder.path)))
    assert catalogue.columns == ["name", "date", "length", "dcm_type"]
    assert catalogue.count() == 2


@dataclass(frozen=True, repr=False)
class Named(Connector):
    """Slots with the given names."""

    names: tuple[str, ...] = ()

    def list(self, root):
        return [Slot(n) for n in self.names]

    def fetch(self, name):
        return [b""]


def fresh(log, poll):
    rows = [r for b in log.read(poll, "") for r in b.to_pylist()]
    return sorted(r["name"] for r in rows if r["fresh"])


@pytest.mark.parametrize("linked", [True, False])
def test_poll_log(tmp_path, linked, monkeypatch):
    if not linked:
        # As on an object store, where a link cannot be made.
        class Store(pafs.SubTreeFileSystem):
            pass

        monkeypatch.setattr(
            pollog, "open_location", lambda where: (Store("/", pafs.LocalFileSystem()), where[5:])
        )
    log = PollLog(f"file:{tmp_path}/polls")
    assert log.latest() == 0 and log.roots(5) is None
    assert log.poll_root(Named(("a",)), 0, "", 5, None) == (1, False)
    log.write_poll(5, [""])
    assert log.latest() == 5 and log.roots(5) == [""]
    # Another attempt of the same task does not replace what the first one published.
    assert log.poll_root(Named(("b", "c")), 0, "", 5, None) == (1, False)
    assert fresh(log, 5) == ["a"]
    assert log.has(5, "") and not log.has(5, "other")
    # The same names again leave nothing behind; names that are gone are new when they come back.
    assert log.poll_root(Named(("a",)), 0, "", 6, 5) == (0, False)
    assert not log.has(6, "")
    assert log.poll_root(Named(("b", "c")), 0, "", 7, 6) == (2, False)
    assert fresh(log, 7) == ["b", "c"]
    assert log.poll_root(Named(("c", "a", "b")), 0, "", 8, 7) == (1, False)
    assert fresh(log, 8) == ["a"] and not log.has(5, "")
    # A bound leaves slots out, and the next poll finds them new.
    names = tuple("abcdefgh")
    assert log.poll_root(Named(names), 0, "", 9, 8, 2) == (2, True)
    assert log.poll_root(Named(names), 0, "", 10, 9, 2) == (2, True)
    assert log.poll_root(Named(names), 0, "", 11, 10, 2) == (1, False)
    assert log.poll_root(Named(names), 0, "", 12, 11, 2) == (0, False)
    log.write_poll(12, [])
    log.forget_before(12)
    assert log.latest() == 12 and log.roots(5) is None


def test_listings_by_bucket(tmp_path, monkeypatch):
    """Listings of many runs and buckets, of growing and shrinking numbers of buckets."""
    monkeypatch.setattr(buckets, "RUN_ROWS", 700)
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 40)
    monkeypatch.setattr(listing, "PAGE_ROWS", 90)
    log = PollLog(f"{tmp_path}/polls")
    before: set = set()
    for poll, wanted in enumerate(
        (range(0), range(30), range(20, 5000), range(4000, 4100), range(3000), range(3000)), 1
    ):
        names = {f"é{i}\n/{i * i}" for i in wanted}
        new, cut = log.poll_root(Named(tuple(names)), 0, "", poll, poll - 1 if poll > 1 else None)
        assert (new, cut) == (len(names - before), False)
        if log.has(poll, ""):
            assert fresh(log, poll) == sorted(names - before)
            assert sorted(r["name"] for b in log.read(poll, "") for r in b.to_pylist()) == sorted(names)
        before = names
    assert not log.has(6, "")


def test_offsets_never_go_back(tmp_path):
    (tmp_path / "in").mkdir()
    reader = PollReader(FilesConnector(str(tmp_path / "in")), 0, str(tmp_path / "polls"), 1000)
    now = reader.latestOffset()
    assert now["poll"] % 1000 == 0
    assert reader.latestOffset() == now
    later = now["poll"] + 3_600_000
    reader.log.write_poll(later, [])
    (tmp_path / "in" / "a").touch()
    again = PollReader(FilesConnector(str(tmp_path / "in")), 0, str(tmp_path / "polls"), 1000)
    assert again.latestOffset()["poll"] == later + 1
    assert again.partitions({"poll": later}, {"poll": later}) == []
    assert [p.root for p in again.partitions({"poll": later}, {"poll": later + 1})] == [""]
    with pytest.raises(SlotSourceError, match="does not hold"):
        again.partitions({"poll": 0}, {"poll": later + 7})


def test_unheard_polls(tmp_path, monkeypatch):
    monkeypatch.setattr(watch, "UNHEARD_SECONDS", 0.1)
    reader = PollReader(
        FilesConnector(str(tmp_path)), 0, str(tmp_path / "polls"), 1, mailbox=f"{tmp_path}/box"
    )
    with pytest.raises(SlotSourceError, match="no session"):
        reader.latestOffset()
