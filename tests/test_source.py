"""Reading slots through the data source: partitions, contents, gzip, re-tries, errors."""

from __future__ import annotations

import sys
from dataclasses import dataclass

import pytest
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import FIVE
from quayline import (
    Connector,
    Slot,
    between_dates,
    exclude_previous,
    fetch_payload,
    hadoop_lines,
    hadoop_slots,
    index_slots,
    ordered_lines,
    payload_lines,
    peek_lines,
    read_catalogue,
    read_lines,
    read_metrics,
    register_sources,
    slot_metrics,
    text_lines,
    write_lines,
)
from quayline.operators import payload
from quayline.operators.payload import fetch_lines
from flaky import FlakyFiles
from quayline.sources.files import FilesConnector


# Workers cannot import this file: send its connectors along, as a notebook's would be.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def values(df) -> list[str]:
    return [r.value for r in df.collect()]


def flaky(folder, **fields):
    marks = str(folder.path.parent / "marks")
    return FlakyFiles(str(folder.path), skipHidden=True, marks=marks, **fields)


def calls(folder, what):
    """How often a listing of a root, or a fetch of a slot, was begun."""
    import hashlib

    place = folder.path.parent / "marks" / hashlib.sha256(what.encode()).hexdigest()[:24]
    return len(list(place.iterdir())) if place.exists() else 0


@pytest.fixture
def files(folder):
    folder.put("example_20161202.txt", date="2016-12-02")
    folder.put("example_20161201.txt", date="2016-12-01", packed=True)
    folder.put("_hidden.txt")
    return FilesConnector(str(folder.path), skipHidden=True)


def test_catalogue(spark, files):
    rows = read_catalogue(spark, files).orderBy("name")
    assert [tuple(r) for r in rows.select("name", F.col("date").cast("string")).collect()] == [
        ("example_20161201.txt", "2016-12-01 00:00:00"),
        ("example_20161202.txt", "2016-12-02 00:00:00"),
    ]


def test_each_slot_is_a_partition_in_order(spark, files):
    lines = read_lines(spark, files)
    parts = lines.rdd.glom().map(lambda rows: [r.value for r in rows]).collect()
    assert parts == [[f"{line} - {n}" for line in FIVE]
                     for n in ("example_20161201.txt", "example_20161202.txt")]
    assert values(lines.limit(5)) == parts[0]
    one_client = read_lines(spark, files, max_partitions=1)
    assert one_client.rdd.getNumPartitions() == 1
    assert values(one_client) == parts[0] + parts[1]


def test_choosing_before_fetching(spark, files):
    some = read_lines(spark, files, lambda c: between_dates(c, "2016-12-02"))
    assert {r.slot for r in some.collect()} == {"example_20161202.txt"}
    seen = read_catalogue(spark, files).filter("name LIKE '%01.txt'")
    rest = read_lines(spark, files, lambda c: exclude_previous(c, seen))
    assert rest.count() == 5
    none = read_lines(spark, files, lambda c: c.filter("name = 'x'"))
    assert none.count() == 0
    assert none.columns == ["slot", "slot_date", "line_no", "value"]


def test_contents(spark, folder):
    folder.put("plain.gz", ["only the name is zipped"])
    folder.put("zipped.txt", ["a", "", "b"], packed=True)
    folder.put("empty.txt", b"")
    folder.put("empty.gz", b"", packed=True)
    folder.put("one", b"\x1f")
    folder.put("latin.txt", b"caf\xe9")
    connector = FilesConnector(str(folder.path))
    rows = read_lines(spark, connector).orderBy("slot", "line_no").collect()
    assert [(r.slot, r.line_no, r.value) for r in rows] == [
        ("latin.txt", 0, "caf�"),
        ("one", 0, "\x1f"),
        ("plain.gz", 0, "only the name is zipped"),
        ("zipped.txt", 0, "a"),
        ("zipped.txt", 1, ""),
        ("zipped.txt", 2, "b"),
    ]
    latin = read_lines(spark, connector, lambda c: c.filter("name = 'latin.txt'"), "ISO-8859-1")
    assert values(latin) == ["café"]
    payload = fetch_payload(read_catalogue(spark, connector), connector)
    assert payload.count() == 6
    again = payload_lines(payload).orderBy("slot", "line_no").collect()
    assert [tuple(r) for r in again] == [tuple(r) for r in rows]


def test_large_slots_are_read_in_ranges(spark, folder):
    long = [f"line {i} " + "é" * (i % 50) for i in range(3000)]
    folder.put("a.txt", "\r\n".join(long).encode(), date="2016-12-03")
    folder.put("b.txt", long[:10], date="2016-12-01")
    folder.put("c.txt", long, date="2016-12-02", packed=True)
    folder.put("d.txt", b"x" * 9000, date="2016-12-04")
    connector = FilesConnector(str(folder.path))
    whole = read_lines(spark, connector, split_bytes=None)
    split = read_lines(spark, connector, split_bytes=2000)
    assert whole.rdd.getNumPartitions() == 4
    assert split.rdd.getNumPartitions() > 50
    assert split.collect() == whole.collect()
    # What has no units that always end a line is not cut.
    assert read_lines(
        spark, connector, charset="Shift_JIS", split_bytes=2000
    ).rdd.getNumPartitions() == 4


@pytest.mark.parametrize("charset", ["UTF-16", "UTF-32", "UTF-16LE"])
def test_ranges_of_wide_units(spark, folder, charset):
    # U+0A0D and U+0D0A hold the bytes of line ends; a range may end between two halves of a pair.
    long = [f"{i} \u0a0d\u0d0a\u0a00 \U0001f600" + "é" * (i % 50) for i in range(1500)]
    for order in ("LE", "BE") if len(charset) == 6 else ("",):
        text = "\r\n".join(long)
        mark = "\ufeff" if order else ""
        folder.put(f"a{order}.txt", (mark + text).encode(charset + order), date="2016-12-03")
    folder.put("b.txt", "\n".join(long[:9]).encode(f"{charset[:6]}{charset[6:] or 'BE'}"))
    connector = FilesConnector(str(folder.path))
    whole = read_lines(spark, connector, charset=charset)
    split = read_lines(spark, connector, charset=charset, split_bytes=2001)
    assert split.rdd.getNumPartitions() > 40
    rows = split.collect()
    assert rows == whole.collect()
    assert {r.value for r in rows} == set(long)


def test_lines_of_ranges_are_counted_by_few_tasks(spark, folder, monkeypatch):
    long = [f"line {i}" for i in range(2000)]
    folder.put("a.txt", long)
    folder.put("b.txt", long[:700])
    connector = FilesConnector(str(folder.path))
    placed, place = [], payload.one_slot_per_partition

    def spy(*args, **kwargs):
        placed.append(place(*args, **kwargs))
        return placed[-1]

    monkeypatch.setattr(payload, "one_slot_per_partition", spy)
    monkeypatch.setattr(payload, "COUNT_TASKS", 2)
    split = read_lines(spark, connector, split_bytes=300)
    counted, fetched = (p.rdd.getNumPartitions() for p in placed)
    assert counted <= 2 * spark.sparkContext.defaultParallelism < fetched
    rows = [(r.slot, r.line_no, r.value) for r in split.collect()]
    assert rows == [(s, i, v) for s, n in (("a.txt", 2000), ("b.txt", 700)) for i, v in enumerate(long[:n])]


def test_nested_folders(spark, folder):
    for name in ("top.txt", "a/1.txt", "a/x/2.txt", "a/x/deep/3.txt", "b/y/4.txt", "_no/5.txt"):
        folder.put(name)
    for depth, roots in ((1, 3), (2, 5), (3, 6), (9, 6)):
        connector = FilesConnector(
            str(folder.path), recursive=True, rootDepth=depth, skipHidden=True
        )
        slots = read_catalogue(spark, connector)
        assert len(connector.roots()) == roots
        assert sorted(r.name for r in slots.collect()) == [
            "a/1.txt", "a/x/2.txt", "a/x/deep/3.txt", "b/y/4.txt", "top.txt",
        ]
    assert FilesConnector(str(folder.path)).roots() == [""]
    assert read_catalogue(spark, FilesConnector(str(folder.path))).count() == 1
    # Nothing is hidden unless that is asked for.
    everything = FilesConnector(str(folder.path), recursive=True)
    assert read_catalogue(spark, everything).filter("name = '_no/5.txt'").count() == 1


def test_hadoop_paths(spark, files, folder):
    slots = hadoop_slots(spark, str(folder.path))
    dated = between_dates(slots, "2016-12-02")
    plan = dated.select("name")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan  # listing does not read files
    assert "GreaterThanOrEqual" in plan
    found = payload_lines(slots).orderBy("slot", "line_no")
    assert values(found) == values(read_lines(spark, files))


@pytest.fixture
def small_splits(spark):
    kept = {}
    for key, value in (("maxPartitionBytes", "200"), ("openCostInBytes", "1"), ("minPartitionNum", "1")):
        key = f"spark.sql.files.{key}"
        kept[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    yield
    for key, value in kept.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hadoop_lines(spark, folder, small_splits):
    """Numbers over many splits; content, not the name, says what is packed."""
    import random

    rng = random.Random(8)
    for i in range(4):
        body = "".join(f"line {j} {'x' * rng.randint(0, 30)}{rng.choice(['', ''])}" + rng.choice(
            ["\n", "\r\n", "\r", "\n\n"]) for j in range(rng.randint(1, 200)))
        folder.put(f"plain {i}%20.txt", body.encode())
        folder.put(f"packed_{i}.txt.gz", body.encode(), packed=True)
        folder.put(f"in disguise [{i}]", body.encode(), packed=True)
        folder.put(f"said_{i}.gz", body.encode())
    folder.put("empty", b"")
    folder.put("empty.gz", b"")
    folder.put("short", b"\x1f\x8b\x08")
    folder.put("bad", b"caf\xe9\nok")
    found = hadoop_lines(spark, str(folder.path))
    assert found.columns == ["slot", "slot_date", "line_no", "value"]
    rows = [(r.slot.rsplit("/", 1)[1], r.line_no, r.value) for r in found.collect()]
    connector = FilesConnector(str(folder.path))
    expected = read_lines(spark, connector).collect()

    assert sorted(rows) == sorted((r.slot, r.line_no, r.value) for r in expected)
    # Slots are called alike however they are read.
    listed = {r.name for r in hadoop_slots(spark, str(folder.path)).select("name").collect()}
    assert {r.slot for r in found.collect()} <= listed
    unnumbered = hadoop_lines(spark, str(folder.path), line_numbers=False)
    assert {r.line_no for r in unnumbered.collect()} == {None}
    assert sorted(r.value for r in unnumbered.collect()) == sorted(r[2] for r in rows)
    # Too large to be read whole without a name that says what it is.
    with pytest.raises(ValueError, match="name that says so"):
        hadoop_lines(spark, str(folder.path), glob="in*", whole_bytes=20)
    large = hadoop_lines(spark, str(folder.path), glob="packed_*", whole_bytes=20)
    packed = [r for r in rows if r[0].startswith("packed_")]
    assert sorted((r.slot.rsplit("/", 1)[1], r.line_no, r.value) for r in large.collect()) == sorted(packed)


@pytest.mark.parametrize("charset", ["ISO-8859-1", "ascii", "UTF-16", "cp1252"])
def test_hadoop_charsets(spark, folder, small_splits, charset):
    text = "".join(f"z\u00e9ro {i}\r\n" for i in range(80))
    folder.put("a", text.encode("ascii" if charset == "ascii" else charset, "replace"))
    folder.put("b", text.encode("latin-1" if charset == "ascii" else charset), packed=True)
    found = {(r.slot.rsplit("/", 1)[1], r.line_no, r.value)
             for r in hadoop_lines(spark, str(folder.path), charset=charset).collect()}
    expected = read_lines(spark, FilesConnector(str(folder.path)), charset=charset).collect()
    assert found == {(r.slot, r.line_no, r.value) for r in expected} and len(found) == 160


def test_retries(spark, files, folder):
    def listed(**fields):
        connector = flaky(folder, **fields)
        return index_slots(read_catalogue(spark, connector, max_retries=2))

    assert listed(listBadTries=2).count() == 2
    # Two failures and one listing that succeeds, however often the catalogue is used.
    assert calls(folder, "list ") == 3
    with pytest.raises(PySparkException, match="failed after 2 re-tries"):
        listed(listBadTries=9)


@pytest.mark.parametrize(("retries", "works"), [(2, True), (1, False)])
def test_fetch_retries(spark, files, folder, retries, works):
    connector = flaky(folder, fetchBadTries=2)
    slots = read_catalogue(spark, connector)
    lines = fetch_lines(slots, connector, max_retries=retries)
    if works:
        # Failing in the middle of a slot neither loses nor repeats lines.
        assert lines.orderBy("slot", "line_no").collect() == read_lines(spark, files).orderBy(
            "slot", "line_no"
        ).collect()
    else:
        with pytest.raises(PySparkException, match="failed after 1 re-tries"):
            lines.collect()


def test_list_errors(spark, tmp_path):
    missing = FilesConnector(str(tmp_path / "none"))
    with pytest.raises(PySparkException, match="listing"):
        read_catalogue(spark, missing, max_retries=0).collect()
    empty = read_catalogue(spark, missing, max_retries=0, on_list_error="empty")
    assert empty.collect() == []
    assert ordered_lines(empty, missing).collect() == []
    # Finding the parts of a tree is part of the listing.
    tree = FilesConnector(str(tmp_path / "none"), recursive=True)
    with pytest.raises(PySparkException, match="listing"):
        read_catalogue(spark, tree, max_retries=0)
    assert read_catalogue(spark, tree, max_retries=0, on_list_error="empty").collect() == []
    with pytest.raises(ValueError, match="on_list_error"):
        read_catalogue(spark, missing, on_list_error="ignore")
    register_sources(spark)
    reader = spark.read.format("slots").options(connector="files", recursive="true", maxRetries=0)
    reader = reader.option("path", str(tmp_path / "none"))
    with pytest.raises(PySparkException, match="listing"):
        reader.load().collect()
    assert reader.option("onListError", "empty").load().collect() == []
    with pytest.raises(PySparkException, match="onListError"):
        reader.option("onListError", "ignore").load().collect()


@dataclass(frozen=True, repr=False)
class HalfListed(FilesConnector):
    """A tree one folder of which cannot be listed."""

    def list(self, root):
        yield from super().list(root)
        if root == "b":
            raise OSError("listing fails on purpose")


def test_a_listing_is_whole_or_nothing(spark, folder):
    folder.put("a/1.txt")
    folder.put("b/2.txt")
    connector = HalfListed(str(folder.path), recursive=True)
    with pytest.raises(PySparkException, match="listing b"):
        read_catalogue(spark, connector, max_retries=0)
    assert read_catalogue(spark, connector, 0, "empty").collect() == []
    register_sources(spark, half=HalfListed)
    reader = spark.read.format("slots").options(
        connector="half", path=str(folder.path), recursive="true", maxRetries=0
    )
    assert reader.option("onListError", "empty").load().collect() == []
    with pytest.raises(PySparkException, match="listing b"):
        reader.option("onListError", "fail").load().collect()


def test_missing_slot(spark, files, folder):
    slots = index_slots(read_catalogue(spark, files))
    (folder.path / "example_20161202.txt").unlink()
    with pytest.raises(PySparkException, match="example_20161202.txt"):
        fetch_lines(slots, files, max_retries=0).collect()


@dataclass(frozen=True, repr=False)
class Numbers(Connector):
    """Slots without dates, written as a plug-in."""

    count: int = 0

    def list(self, root):
        return [Slot(f"n{i}") for i in range(self.count)]

    def fetch(self, name):
        yield f"{name} a\n{name}".encode()
        yield b" b\n"


def test_plug_in(spark):
    lines = read_lines(spark, Numbers(3))
    assert values(lines) == [f"n{i} {x}" for i in range(3) for x in "ab"]
    assert {r.slot_date for r in lines.collect()} == {None}


def test_format_options(spark, files, folder):
    register_sources(spark, numbers=Numbers)
    by_options = spark.read.format("slots").option("connector", "files").option(
        "path", str(folder.path)
    )
    assert by_options.option("skipHidden", "true").load().count() == 2
    start = '{"date": "2016-12-02", "slots": []}'
    assert [r.name for r in by_options.option("start", start).load().collect()] == [
        "example_20161202.txt"
    ]
    named = '{"date": null, "slots": ["example_20161202.txt"]}'
    assert [r.name for r in by_options.option("start", named).load().collect()] == [
        "example_20161201.txt"
    ]
    # A plug-in stays known whatever else is read or registered.
    read_catalogue(spark, files)
    register_sources(spark)
    assert spark.read.format("slots").options(connector="numbers", count=4).load().count() == 4
    with pytest.raises(PySparkException, match="connector must be one of"):
        spark.read.format("slots").option("connector", "other").load().collect()
    with pytest.raises(PySparkException, match="must not be empty"):
        spark.read.format("slots").option("connector", "files").load().collect()


@dataclass(frozen=True, repr=False)
class Changing(Numbers):
    """Fails once in the middle and then serves another content."""

    marks: str = ""

    def fetch(self, name):
        import os

        mark = os.path.join(self.marks, name)
        if os.path.exists(mark):
            yield b"other content\n"
        else:
            open(mark, "w").close()
            yield b"first\n"
            raise OSError("cut off")


def test_a_slot_that_changes_between_attempts_fails(spark, tmp_path):
    connector = Changing(1, str(tmp_path))
    with pytest.raises(PySparkException, match="changed between two attempts"):
        read_lines(spark, connector).collect()


def test_metrics_peek_and_sink(spark, files, tmp_path):
    lines = read_lines(spark, files)
    found = {r.slot: (r.records, r.characters) for r in slot_metrics(lines).collect()}
    length = len("LINE 001 - example_20161201.txt")
    assert set(found.values()) == {(5, 5 * length)}
    slots = index_slots(read_catalogue(spark, files))
    first = peek_lines(slots, lambda s: fetch_lines(s, files, first_lines=7), 7)
    assert [(r.slot, r.line_no) for r in first.collect()] == [
        *(("example_20161201.txt", i) for i in range(5)), ("example_20161202.txt", 0),
        ("example_20161202.txt", 1),
    ]
    assert peek_lines(slots, lambda s: fetch_lines(s, files), 100).count() == 10
    write_lines(lines, str(tmp_path / "out"))
    assert sorted(values(spark.read.text(str(tmp_path / "out")))) == sorted(values(lines))


def test_peek_reads_few_slots(spark, folder):
    for i in range(30):
        folder.put(f"f{i:02d}.txt", b"" if i < 3 else [f"{i}"], date="2016-12-01")
    connector = flaky(folder)
    slots = index_slots(read_catalogue(spark, connector))
    heads = peek_lines(slots, lambda s: fetch_lines(s, connector, first_lines=2), 2)
    assert values(heads) == ["3", "4"]
    assert values(heads) == ["3", "4"]
    # One, two and four slots were looked at, each once, and only one listing was made.
    fetched = [calls(folder, f"fetch f{i:02d}.txt") for i in range(30)]
    assert fetched == [1] * 7 + [0] * 23
    assert calls(folder, "list ") == 1


def test_peek_past_many_empty_slots(spark, monkeypatch):
    """More empty slots before the first line than are looked at first; no task gets them all."""
    from quayline.operators import payload

    monkeypatch.setattr(payload, "PEEK_SLOTS", 8)
    monkeypatch.setattr(payload, "PEEK_TASKS", 16)
    slots = spark.range(3000).select(
        F.format_string("s%05d", "id").alias("name"),
        F.when(F.col("id") >= 2500, F.concat(F.lit("a\nb"), "id")).otherwise("").alias("text"),
    ).repartition(7)
    most = []

    def to_lines(chosen):
        sizes = chosen.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        most.append(sizes)
        return text_lines(chosen)

    found = [(r.slot, r.value) for r in peek_lines(slots, to_lines, 3).collect()]
    assert found == [("s02500", "a"), ("s02500", "b2500"), ("s02501", "a")]
    assert max(most) <= 3000 // 16 + 1
    assert peek_lines(slots.limit(0), to_lines, 3).collect() == []
    assert peek_lines(slots.filter("text = ''"), text_lines, 3).collect() == []
    assert peek_lines(slots, text_lines, 0).collect() == []


def test_read_metrics(spark, folder):
    import gzip

    folder.put("plain.txt", "é\nb\r\n".encode())
    folder.put("zipped.txt", ["abc"], packed=True)
    folder.put("empty.txt", b"")
    connector = FilesConnector(str(folder.path))
    found = read_metrics(read_catalogue(spark, connector), connector)
    assert {r.slot: tuple(r)[2:] for r in found.collect()} == {
        "plain.txt": (6, 2, 2),
        "zipped.txt": (len(gzip.compress(b"abc")), 1, 3),
        "empty.txt": (0, 0, 0),
    }


def test_heads_are_read_no_further(spark, folder):
    folder.put("long.txt", b"line\n" * 4_000_000)
    connector = FilesConnector(str(folder.path))
    lines = fetch_lines(read_catalogue(spark, connector), connector, first_lines=3)
    assert [(r.line_no, r.value) for r in lines.collect()] == [(i, "line") for i in range(3)]


@dataclass(frozen=True, repr=False)
class Growing(FilesConnector):
    """Grows by a hundred lines when it is read, a chosen number of calls after the listing."""

    marks: str = ""
    after: int = 0

    def _grow(self, name):
        import os

        os.makedirs(self.marks, exist_ok=True)
        done = len(os.listdir(self.marks))
        open(os.path.join(self.marks, str(done)), "w").close()
        if done == self.after:
            with open(os.path.join(self.path, name), "a") as out:
                out.writelines(f"new {i}\n" for i in range(100))

    def size(self, name):
        self._grow(name)
        return super().size(name)


@pytest.mark.parametrize("after", [0, 1])
def test_a_split_slot_that_grows_is_read_whole_or_not_at_all(spark, folder, tmp_path, after):
    folder.put("a.txt", [f"line {i}" for i in range(100)] + [""])
    connector = Growing(str(folder.path), marks=str(tmp_path / "m"), after=after)
    if after:
        # Between counting the lines of a range and reading another.
        with pytest.raises(PySparkException, match="changed while it was read"):
            read_lines(spark, connector, split_bytes=200).collect()
    else:
        lines = read_lines(spark, connector, split_bytes=200)
        # Between listing and cutting: all of it.
        assert lines.count() == 200
        assert [r.line_no for r in lines.orderBy("line_no").collect()] == list(range(200))


def test_lines_longer_than_ranges(spark, folder):
    content = b"a\n" + b"x" * 5000 + b"\r\n" + b"y" * 3000 + b"\rz\n\n" + b"w" * 1001
    folder.put("a.txt", content)
    connector = FilesConnector(str(folder.path))
    whole = read_lines(spark, connector).collect()
    for size in (1, 2, 3, 7, 100, 999, 5001, 5002, 5003, 20_000):
        if size > 3:
            assert read_lines(spark, connector, split_bytes=size).collect() == whole
    unnumbered = read_lines(spark, connector, split_bytes=100, line_numbers=False).collect()
    assert [r.value for r in unnumbered] == [r.value for r in whole]
    assert {r.line_no for r in unnumbered} == {None}
