"""What reaches the listing: bounds of names, dates and types; large roots; where listings are made."""

from __future__ import annotations

import dataclasses
import hashlib
import random
import sys
from dataclasses import dataclass
from datetime import UTC, datetime

import pytest
from pyspark import TaskContext, cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual, StringStartsWith

from flaky import FlakyFiles
from quayline import Slot, Wanted, read_catalogue, read_lines, register_sources
from quayline.sources import files as files_module
from quayline.sources.datasource import CatalogueReader
from quayline.sources.files import FilesConnector
from quayline.sources.wanted import after_prefix, wanted_by

# Workers cannot import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_bounds_of_names():
    rng = random.Random(3)
    names = ["".join(rng.choices("ab/\x00\U0010ffff퟿", k=rng.randint(0, 5))) for _ in range(300)]
    for _ in range(400):
        low, high, prefix = (rng.choice([None, rng.choice(names)]) for _ in range(3))
        some = tuple(rng.sample(names, 3)) if rng.random() < 0.3 else None
        wanted = Wanted(low=low, high=high, names=some)
        if prefix:
            wanted = wanted.both(Wanted.prefixed(prefix))
        for name in names:
            expected = (
                (low is None or name >= low) and (high is None or name < high)
                and (not prefix or name.startswith(prefix)) and (some is None or name in some)
            )
            assert wanted.name(name) == expected
        below = rng.choice(names) + "/"
        if any(wanted.name(n) for n in names if n.startswith(below)):
            assert wanted.below(below)
    assert after_prefix("a/") == "a0" and after_prefix("\U0010ffff") is None
    assert after_prefix("a\U0010ffff") == "b" and after_prefix("퟿") == ""
    assert Wanted.prefixed("") == Wanted()


def test_rows_and_text_form():
    day = datetime(2024, 1, 2, tzinfo=UTC)
    wanted = Wanted(since=day, until=day, types=("click",), names=("a", "b"))
    assert Wanted.from_dict(wanted.to_dict()) == wanted
    columns = ["name", "date", "length", "dcm_type"]
    assert wanted.row(("a", day, 1, "click"), columns)
    assert wanted.row(("a", day.replace(tzinfo=None), 1), columns[:3])
    for row in (("c", day, 1, "click"), ("a", None, 1, "click"), ("a", day, 1, "sites"),
                ("a", day.replace(day=3), 1, "click"), ("a", day.replace(day=1), 1, "click")):
        assert not wanted.row(row, columns)


def test_filters_to_bounds():
    name = ("name",)
    assert wanted_by(
        [StringStartsWith(name, "a/"), GreaterThan(name, "a/c"), LessThanOrEqual(name, "a/x")]
    ) == Wanted(low="a/c", high="a/x\x00")
    assert wanted_by([In(name, ["a", None, "b"]), EqualTo(name, "b")]) == Wanted(names=("b",))
    assert wanted_by([EqualTo(("length",), 3), EqualTo(("date",), None)]) == Wanted()
    assert wanted_by([EqualTo(("dcm_type",), "click")]) == Wanted(types=("click",))


@pytest.mark.parametrize("depth", [1, 2])
def test_roots_that_cannot_hold_what_is_wanted(tmp_path, depth):
    """Against listing all: no wanted name is lost, and no root is listed that holds none below."""
    rng = random.Random(depth)
    names = [f"{a}/{b}/{i}" for a in "xyz" for b in ("p", "q.1", "q") for i in range(2)]
    names += [f"{a}/{i}" for a in "xyz" for i in "mno"] + ["top", "x.top"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).touch()
    connector = FilesConnector(str(tmp_path), recursive=True, rootDepth=depth)
    assert sorted(s.name for r in connector.roots() for s in connector.list(r)) == sorted(names)
    for _ in range(200):
        pick = rng.choice(names)
        wanted = rng.choice(
            [Wanted.prefixed(pick[: rng.randint(1, len(pick))]), Wanted(low=pick),
             Wanted(names=(pick, rng.choice(names))), Wanted(high=pick),
             Wanted(low=pick, high=rng.choice(names))]
        )
        found = [s.name for r in connector.wanted_roots(wanted) for s in connector.list(r)]
        assert sorted(n for n in found if wanted.name(n)) == sorted(n for n in names if wanted.name(n))
    assert connector.wanted_roots(Wanted.prefixed("y/q/")) == (["y"] if depth == 1 else ["y/q"])
    assert connector.wanted_roots(Wanted(names=("top",))) == [""]


def listed_roots(base) -> int:
    return len(list((base / "marks").iterdir())) if (base / "marks").exists() else 0


def test_filters_reach_the_listing(spark, folder):
    """Rows are those of the unpushed filter, and folders that cannot hold them are not listed."""
    base = folder.path.parent
    for i in range(12):
        folder.put(f"d{i:02}/a.txt", date=f"2024-01-{i + 1:02}")
        folder.put(f"d{i:02}/b.txt", date=f"2024-02-{i + 1:02}")
    connector = FlakyFiles(str(folder.path), recursive=True, marks=str(base / "marks"))
    everything = read_catalogue(spark, connector)
    assert everything.count() == 24 and listed_roots(base) == 13
    for condition, roots in (
        ("name like 'd0%' and date >= timestamp'2024-02-03 00:00:00'", 10),
        ("name = 'd07/a.txt'", 1),
        ("name in ('d03/a.txt', 'd04/b.txt', 'nowhere/c')", 2),
        ("name >= 'd10' and name < 'd11/b'", 2),
        ("name = 'd07/a.txt' or length > 0", 13),
        ("name like 'x%'", 0),
        ("true", 13),
    ):
        for mark in sorted((base / "marks").rglob("*"), reverse=True):
            mark.unlink() if mark.is_file() else mark.rmdir()
        pushed = read_catalogue(spark, connector, where=condition)
        assert sorted(pushed.collect()) == sorted(everything.filter(condition).collect())
        # The top folder may hold names below a bound.
        assert listed_roots(base) in (roots, roots + 1), condition


def test_a_loaded_catalogue_may_be_used_again(spark, folder):
    """Spark keeps what a pushed filter has listed; unless asked for, none is pushed."""
    for i in range(4):
        folder.put(f"d{i}/a.txt")
    register_sources(spark)
    reader = spark.read.format("slots").options(connector="files", path=str(folder.path))
    listed = reader.option("recursive", "true").load()
    assert [listed.filter(c).count() for c in ("name = 'd1/a.txt'", "true", "name like 'd2%'")] == [1, 4, 1]
    once = reader.options(recursive="true", pushFilters="true").load()
    assert once.filter("name like 'd3%'").count() == 1


@pytest.fixture
def no_pushdown(spark):
    """The session as Spark makes it: a reader that takes filters is refused."""
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def test_format_in_a_plain_session(spark, folder, no_pushdown):
    for name in ("a/1", "b/2"):
        folder.put(name)
    register_sources(spark)
    reader = spark.read.format("slots").option("connector", "files").option("path", str(folder.path))
    once = reader.options(recursive="true").load()
    assert [r.name for r in once.filter("name < 'b'").collect()] == ["a/1"]
    assert once.count() == 2


def test_filters_reach_the_listing_in_a_plain_session(spark, folder, no_pushdown):
    for name in ("a/1", "b/2"):
        folder.put(name)
    base = folder.path.parent
    connector = FlakyFiles(str(folder.path), recursive=True, marks=str(base / "marks"))
    found = read_catalogue(spark, connector, where=F.col("name").startswith("b/"))
    assert [r.name for r in found.collect()] == ["b/2"]
    # The top folder may hold such names, folder a cannot.
    assert listed_roots(base) in (1, 2)


def test_types_and_dates_of_names(spark, folder):
    for name in ("dcm_account1_click_2016092602_x", "dcm_account1_activity_20160927_x", "other",
                 "dcm_account2_click_2016102602_x"):
        folder.put(name)
    register_sources(spark)
    listed = spark.read.format("slots").options(connector="dcm_files", path=str(folder.path)).load()
    clicks = listed.filter("dcm_type = 'click' and date < timestamp'2016-10-01 00:00:00'")
    assert [r.name for r in clicks.collect()] == ["dcm_account1_click_2016092602_x"]
    reader = CatalogueReader(FilesConnector(str(folder.path)), 0, "fail", None)
    pushed = list(reader.pushFilters([EqualTo(("dcm_type",), "click"), EqualTo(("length",), 1)]))
    # Spark goes on applying all of them.
    assert len(pushed) == 2 and reader.wanted == Wanted(types=("click",))


def test_wanted_by_function(spark, folder):
    for name in ("a/1", "a/2", "b/1"):
        folder.put(name)
    connector = FilesConnector(str(folder.path), recursive=True)
    found = read_catalogue(spark, connector, wanted=Wanted.prefixed("a/"))
    assert sorted(r.name for r in found.collect()) == ["a/1", "a/2"]
    lines = read_lines(spark, connector, wanted=Wanted(names=("b/1",)))
    assert {r.slot for r in lines.collect()} == {"b/1"}


@pytest.mark.parametrize("recursive", [False, True])
def test_a_large_folder_is_listed_by_many_tasks(spark, folder, monkeypatch, recursive):
    base = folder.path.parent
    names = {f"é{hashlib.md5(str(i).encode()).hexdigest()[:6]}_{i}" for i in range(1500)}
    top = folder.path / "sub" if recursive else folder.path
    top.mkdir(exist_ok=True)
    for name in names:
        (top / name).touch()
    names = {f"sub/{n}" for n in names} if recursive else names
    connector = FlakyFiles(
        str(folder.path), recursive=recursive, splitRows=100, marks=str(base / "marks")
    )
    monkeypatch.setattr(files_module, "SAMPLED", 256)
    parts = [p for root in connector.roots() for p in connector.split(root)]
    sizes = [len(list(FilesConnector.list(connector, p))) for p in parts if p]
    assert len(sizes) == 15 and sum(sizes) == 1500 and max(sizes) < 300
    slots = read_catalogue(spark, connector)
    assert {r.name for r in slots.collect()} == names and slots.count() == 1500
    # Each part was listed once, by a task of its own.
    assert listed_roots(base) == len(parts)
    register_sources(spark, flaky=FlakyFiles)
    through = (
        spark.read.format("slots").option("connector", "flaky")
        .option("parameters", connector.to_json()).load()
    )
    assert through.rdd.getNumPartitions() == len(parts)
    assert {r.name for r in through.collect()} == names


@dataclass(frozen=True, repr=False)
class InTasksOnly(FilesConnector):
    """Neither lists nor looks for parts outside of tasks; a folder named ``bad`` cannot be listed."""

    def _folders(self, look_into):
        if TaskContext.get() is None:
            raise RuntimeError("listed on the driver")
        return super()._folders(look_into)

    def list(self, root):
        if TaskContext.get() is None:
            raise RuntimeError("listed on the driver")
        if root.startswith("bad"):
            raise OSError("not to be listed")
        return super().list(root)


@pytest.mark.parametrize("policy", ["fail", "empty"])
def test_batches_list_in_tasks(spark, folder, policy):
    for name in ("a/1", "b/2", "c/3"):
        folder.put(name)
    register_sources(spark, in_tasks=InTasksOnly)
    reader = spark.read.format("slots").options(connector="in_tasks", path=str(folder.path))
    reader = reader.options(recursive="true", onListError=policy, maxRetries=0)
    assert sorted(r.name for r in reader.load().collect()) == ["a/1", "b/2", "c/3"]
    # A task per root, also where all or nothing is listed.
    assert reader.load().rdd.getNumPartitions() >= 3
    reader = reader.option("pushFilters", "true")
    assert [r.name for r in reader.load().filter("name like 'b/%'").collect()] == ["b/2"]
    folder.put("bad/4")
    if policy == "empty":
        assert reader.load().count() == 0
        # What is not wanted is not listed, and cannot fail.
        assert reader.load().filter(F.col("name").startswith("a/")).count() == 1
    else:
        with pytest.raises(PySparkException, match="not to be listed|failed after"):
            reader.load().collect()


def test_dates_are_those_of_the_disk(folder):
    folder.put("x", date="2016-12-01")
    (folder.path / "gone").symlink_to(folder.path / "nothing")
    slots = list(FilesConnector(str(folder.path)).list(""))
    assert slots == [Slot("x", datetime(2016, 12, 1, tzinfo=UTC), (folder.path / "x").stat().st_size)]
    assert dataclasses.asdict(FilesConnector("/x"))["splitRows"] == 100_000
