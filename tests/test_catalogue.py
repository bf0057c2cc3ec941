"""Choosing and ordering slots, against small hand-made catalogues and brute force."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from quayline import (
    StartRange,
    apply_start,
    batch_descriptions,
    between_dates,
    dense_positions,
    empty_like,
    exclude_previous,
    index_slots,
    matching,
    new_slots,
    one_slot_per_partition,
    order_slots,
    range_summary,
    replayed_slots,
    resume_range,
)
from quayline.operators import ordering
from quayline.plans.queries import QUERIES

SCHEMA = "name string, date timestamp"


def catalogue(spark, *rows):
    df = spark.createDataFrame([tuple(r) for r in rows], "name string, date string")
    return df.withColumn("date", F.col("date").cast("timestamp"))


def names(df) -> list[str]:
    return [r.name for r in df.collect()]


@pytest.fixture
def mixed(spark):
    return catalogue(
        spark,
        ("/files/example.txt", None),
        ("/files/example_20161202.txt", "2016-10-13"),
        ("/files/example_20161201.txt", "2016-10-12"),
    )


@pytest.fixture
def dated(spark):
    return catalogue(
        spark, ("a", "2016-10-11"), ("b", "2016-10-12"), ("c", "2016-10-13")
    )


def test_order(spark, mixed):
    assert names(order_slots(mixed)) == [
        "/files/example_20161201.txt",
        "/files/example_20161202.txt",
        "/files/example.txt",
    ]
    same = catalogue(spark, ("b", None), ("a", None), ("d", "2016-01-01"), ("c", "2016-01-01"))
    assert names(order_slots(same)) == ["c", "d", "a", "b"]
    assert names(order_slots(same.select("name"))) == ["a", "b", "c", "d"]


def test_filter_and_empty(mixed):
    assert len(names(matching(mixed, F.col("name").contains("2016")))) == 2

    @F.pandas_udf("boolean")
    def of_odd_length(names: pd.Series) -> pd.Series:
        return names.str.len() % 2 == 1

    assert {len(n) % 2 for n in names(matching(mixed, of_odd_length("name")))} == {1}
    nothing = empty_like(mixed)
    assert nothing.schema == mixed.schema
    assert one_slot_per_partition(nothing).count() == 0


def test_previous(spark, mixed):
    previous = catalogue(
        spark, ("/files/example.txt", None), ("/files/example_20161201.txt", "2000-01-01")
    )
    assert sorted(names(exclude_previous(mixed, previous))) == [
        "/files/example_20161201.txt",
        "/files/example_20161202.txt",
    ]


@pytest.mark.parametrize(
    ("from_date", "to_date", "count"),
    [
        ("2016-10-11 00:00:00", "2016-10-13 00:00:01", 3),
        (None, "2016-10-12 00:00:01", 2),
        ("2016-10-12 00:00:00", None, 2),
        (None, "2016-10-10 23:59:59", 0),
        ("2016-10-12", "2016-10-12", 0),
        (None, None, 3),
    ],
)
def test_dates(dated, from_date, to_date, count):
    assert between_dates(dated, from_date, to_date).count() == count


def test_undated_slots_need_open_bounds(mixed):
    assert between_dates(mixed).count() == 3
    assert between_dates(mixed, "2000-01-01").count() == 2
    assert between_dates(mixed, to_date="2100-01-01").count() == 2


def test_start_ranges(spark, mixed):
    def kept(start):
        return sorted(n[-12:] for n in names(apply_start(mixed, start)))

    everything = sorted(n[-12:] for n in names(mixed))
    assert kept(None) == everything
    assert kept(StartRange()) == everything
    assert kept(StartRange("2016-10-13")) == ["20161202.txt"]
    assert kept(StartRange("2016-10-12", ("/files/example_20161201.txt",))) == ["20161202.txt"]
    assert kept(StartRange(names=("/files/example.txt",))) == ["20161201.txt", "20161202.txt"]
    many = tuple(f"x{i}" for i in range(1500)) + ("/files/example.txt",)
    assert kept(StartRange(names=many)) == ["20161201.txt", "20161202.txt"]
    seen = mixed.filter("date IS NOT NULL")
    assert names(apply_start(mixed, StartRange(seen=seen))) == ["/files/example.txt"]
    token = StartRange("2016-10-12", ("a", "b"))
    assert StartRange.from_json(token.to_json()) == token


def test_positions_equal_row_number(spark):
    chance = random.Random(7)
    # One group holds most rows, one name is repeated a lot.
    rows = [
        (
            "hot" if chance.random() < 0.6 else f"g{chance.randrange(5)}",
            "same" if chance.random() < 0.4 else f"n{chance.randrange(10**6):06d}",
        )
        for _ in range(5000)
    ]
    df = spark.createDataFrame(rows, "g string, name string").repartition(5)
    placed = dense_positions(df, [F.col("name")], within=["g"]).collect()
    groups: dict[str, list[str]] = {}
    for g, n in sorted(rows):
        groups.setdefault(g, []).append(n)
    expected = {(g, i, n) for g, ns in groups.items() for i, n in enumerate(ns)}
    assert {(r.g, r.position, r.name) for r in placed} == expected
    assert len(placed) == len(rows)
    indexed = index_slots(df.select("name")).orderBy("slot_index").collect()
    assert [r.slot_index for r in indexed] == list(range(5000))
    assert [r.name for r in indexed] == sorted(n for _, n in rows)


def test_positions_beyond_the_broadcast_bound(spark, monkeypatch):
    import quayline.operators.ordering as ordering

    monkeypatch.setattr(ordering, "BROADCAST_ROWS", 0)
    rows = [(None if i % 3 == 0 else f"g{i % 3}", f"n{i:03d}") for i in range(300)]
    df = spark.createDataFrame(rows, "g string, name string")
    placed = dense_positions(df, [F.col("name")], within=["g"])
    spans = placed.groupBy("g").agg(F.max("position"), F.count_distinct("position")).collect()
    assert {tuple(r) for r in spans} == {(None, 99, 100), ("g1", 99, 100), ("g2", 99, 100)}


def test_one_partition_per_slot(spark):
    slots = spark.range(57).select(F.format_string("s%03d", "id").alias("name"))
    placed = one_slot_per_partition(slots)
    assert placed.rdd.getNumPartitions() == 57
    rows = placed.select("name", F.spark_partition_id().alias("p")).collect()
    assert sorted((r.p, r.name) for r in rows) == [(i, f"s{i:03d}") for i in range(57)]
    packed = one_slot_per_partition(slots, slots_per_partition=10)
    assert packed.rdd.getNumPartitions() == 6
    runs = packed.rdd.glom().map(lambda part: [r.name for r in part]).collect()
    assert runs == [[f"s{i:03d}" for i in range(a, min(a + 10, 57))] for a in range(0, 57, 10)]
    assert one_slot_per_partition(slots, max_partitions=20).rdd.getNumPartitions() == 19


def test_range_summary(spark, mixed):
    row = range_summary(mixed).select(F.col("range_date").cast("string"), "names").first()
    assert row[0] == "2016-10-12 00:00:00"
    assert row.names == names(order_slots(mixed))
    pieces = range_summary(mixed, names_per_row=2).orderBy("piece").collect()
    assert [(p.piece, p.n_names) for p in pieces] == [(0, 2), (1, 1)]
    assert range_summary(empty_like(mixed)).count() == 0
    later = mixed.union(catalogue(spark, ("new", "2016-10-12"), ("old", "2016-10-11")))
    rest = apply_start(later, resume_range(range_summary(mixed, names_per_row=2)))
    assert names(rest) == ["new"]
    assert apply_start(mixed, resume_range(range_summary(empty_like(mixed)))).count() == 3
    undated = range_summary(mixed.select("name")).first()
    assert undated.range_date is None
    assert undated.names == sorted(names(mixed))


def polls(spark, *rows):
    return spark.createDataFrame(rows, "poll int, name string")


def test_new_and_replayed_slots(spark):
    seen = polls(spark, (1, "a"), (1, "b"), (2, "a"), (3, "c"), (4, "b"), (5, "a"), (5, "c"))
    assert {tuple(r) for r in new_slots(seen).collect()} == {("a", 1), ("b", 1), ("c", 3)}
    # Restart at poll 4, remembering two polls: a and b are forgotten, c is not.
    back = replayed_slots(seen, F.lit(4), F.lit(2)).collect()
    assert {tuple(r) for r in back} == {("a", 1, 5), ("b", 1, 4)}


def test_descriptions_continue_over_rows(spark):
    selected = spark.createDataFrame(
        [(1, f"n{i}") for i in range(5)] + [(2, "z")], "poll int, name string"
    )
    rows = batch_descriptions(selected, names_per_row=2).orderBy("poll", "piece").collect()
    assert [(r.poll, r.piece, r.description) for r in rows] == [
        (1, 0, "n0\nn1"), (1, 1, "n2\nn3"), (1, 2, "n4"), (2, 0, "z"),
    ]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, tmp_path, dated):
    path = str(tmp_path / "catalogue")
    dated.withColumn("content", F.lit("x")).write.parquet(path)
    stored = spark.read.parquet(path)
    chosen = apply_start(
        between_dates(stored, "2016-10-12", "2016-10-14"), StartRange("2016-10-11", ("a",))
    ).select("name", "date")
    plan = plan_of(chosen)
    assert "GreaterThanOrEqual(date," in plan
    assert "LessThan(date," in plan
    assert "ReadSchema: struct<name:string,date:timestamp>" in plan
    assert names(chosen.orderBy("name")) == ["b", "c"]


def test_plans_stay_distributed(spark, mixed):
    """No cross join, and no window or sort over the rows of a catalogue in one task."""
    for df in (
        exclude_previous(mixed, mixed.limit(1)),
        apply_start(mixed, StartRange(seen=mixed.limit(1))),
        new_slots(mixed.withColumn("poll", F.lit(1))),
    ):
        plan = plan_of(df)
        assert "CartesianProduct" not in plan
        assert "BroadcastNestedLoopJoin" not in plan
        assert "Window" not in plan
    # The only unpartitioned window sees one row per partition of the sort.
    indexed = plan_of(index_slots(mixed))
    window = indexed[indexed.index("Window") :]
    assert "HashAggregate(keys=[_part" in window


def test_identity(spark):
    """The length does not tell slots apart, and a zoned bound means its moment."""
    slots = spark.createDataFrame(
        [("a", datetime(2024, 1, 1), 1), ("b", datetime(2024, 1, 1), 1)],
        "name string, date timestamp_ntz, length long",
    )
    before = spark.createDataFrame(
        [("a", datetime(2024, 1, 1), 2)], "name string, date timestamp_ntz, length long"
    )
    assert names(exclude_previous(slots, before)) == ["b"]
    with pytest.raises(ValueError, match="name"):
        exclude_previous(slots, before.select("length"))
    for bound, found in (("2024-01-01 01:00:00+02:00", 2), ("2024-01-01 03:00:00+02:00", 0),
                         (datetime(2024, 1, 1, 1, tzinfo=timezone(timedelta(hours=2))), 2),
                         ("2024-01-01", 2)):
        assert between_dates(slots, bound).count() == found
        assert apply_start(slots, StartRange(bound)).count() == found


def test_odd_names_resume(spark):
    mixed = catalogue(spark, ("a\nb", "2016-10-12"), ("c", "2016-10-13"))
    token = range_summary(mixed)
    later = mixed.union(catalogue(spark, ("a", "2016-10-12"), ("b", "2016-10-12")))
    assert names(apply_start(later, resume_range(token))) == ["a", "b"]


def test_packing_is_asked_for(spark):
    slots = spark.range(300).selectExpr("concat('s', id) AS name")
    assert one_slot_per_partition(slots).rdd.getNumPartitions() == 300
    assert one_slot_per_partition(slots, slots_per_partition=7).rdd.getNumPartitions() == 43
    bounded = one_slot_per_partition(slots, max_partitions=4)
    assert bounded.rdd.glom().map(len).collect() == [75] * 4
    sized = slots.selectExpr("name", "IF(name = 's5', 1000L, 10L) AS length")
    packed = one_slot_per_partition(sized, partition_bytes=100)
    lengths = [len(p) for p in packed.rdd.glom().collect()]
    assert sum(lengths) == 300 and max(lengths) <= 11
    with pytest.raises(ValueError, match="greater than 0"):
        one_slot_per_partition(slots, slots_per_partition=0)


def lists(placed) -> list[int]:
    """Partitions of the shuffles that deal slots out."""
    plan = placed._jdf.queryExecution().toString().partition("== Physical Plan ==")[2]
    found = re.findall(r"Exchange (?:SinglePartition|.*, (\d+)\)), REPARTITION_BY_NUM", plan)
    return [int(n or 1) for n in found]


@pytest.mark.parametrize(
    ("count", "codegen"), [(1, "true"), (20, "true"), (21, "true"), (53, "false"), (60, "true")]
)
def test_many_partitions_are_dealt_out_in_short_lists(spark, monkeypatch, count, codegen):
    monkeypatch.setattr(ordering, "LISTED_PARTITIONS", 20, raising=False)
    monkeypatch.setattr(ordering, "STRETCHES", 12, raising=False)
    slots = spark.range(count).select(F.format_string("s%03d", "id").alias("name"))
    spark.conf.set("spark.sql.codegen.wholeStage", codegen)
    try:
        placed = one_slot_per_partition(slots)
        assert max(lists(placed)) <= 20
        assert placed.rdd.getNumPartitions() == count and placed.columns == ["name", "slot_index"]
        rows = placed.select("name", F.spark_partition_id().alias("p")).collect()
        assert sorted((r.p, r.name) for r in rows) == [(i, f"s{i:03d}") for i in range(count)]
    finally:
        spark.conf.unset("spark.sql.codegen.wholeStage")


def test_more_slots_than_counted_are_kept(spark, monkeypatch):
    monkeypatch.setattr(ordering, "LISTED_PARTITIONS", 20, raising=False)
    monkeypatch.setattr(ordering, "STRETCHES", 12, raising=False)
    slots = spark.range(70).select(F.col("id").cast("string").alias("name"))
    for count in (53, 60):
        placed = one_slot_per_partition(slots, count=count)
        assert placed.rdd.getNumPartitions() == count and placed.count() == 70


def test_many_packed_partitions(spark, monkeypatch):
    monkeypatch.setattr(ordering, "LISTED_PARTITIONS", 20, raising=False)
    monkeypatch.setattr(ordering, "STRETCHES", 6, raising=False)
    slots = spark.range(200).select(F.format_string("s%03d", "id").alias("name"))
    packed = one_slot_per_partition(slots, slots_per_partition=7)
    assert max(lists(packed)) <= 20
    runs = packed.rdd.glom().map(lambda part: [r.name for r in part]).collect()
    assert runs == [[f"s{i:03d}" for i in range(a, min(a + 7, 200))] for a in range(0, 200, 7)]


def test_partitions_by_bytes_send_few_counters(spark, monkeypatch):
    """A sort takes the plan below it along to every task, and its counters come back."""
    monkeypatch.setattr(ordering, "LISTED_PARTITIONS", 20, raising=False)
    monkeypatch.setattr(ordering, "STRETCHES", 6, raising=False)
    slots = spark.range(200).selectExpr("format_string('s%03d', id) AS name", "id AS length")
    packed = one_slot_per_partition(slots, partition_bytes=300)
    plan = packed._jdf.queryExecution().toString().partition("== Physical Plan ==")[2]
    assert "Window" not in plan and "Aggregate" not in plan and max(lists(packed)) <= 20
    found = {r.name: r.p for r in packed.select("name", F.spark_partition_id().alias("p")).collect()}
    assert found == {f"s{i:03d}": i * (i - 1) // 2 // 300 for i in range(200)}
    runs = [r for r in packed.rdd.glom().map(lambda part: [x.name for x in part]).collect() if r]
    assert all(r == sorted(r) for r in runs)


@pytest.mark.parametrize(("count", "pack"), [(60, 1), (53, 1), (200, 7), (60, 2), (106, 2)])
def test_very_many_partitions_read_no_shuffle(spark, monkeypatch, count, pack):
    """Counters of a shuffle and of a sort would come back from every task."""
    for name, value in {"LISTED_PARTITIONS": 20, "COUNTED_PARTITIONS": 20, "STRETCHES": 6}.items():
        monkeypatch.setattr(ordering, name, value, raising=False)
    slots = spark.range(count).select(F.format_string("s%03d", "id").alias("name"))
    placed = one_slot_per_partition(slots, slots_per_partition=pack)
    plan = placed._jdf.queryExecution().toString().partition("== Physical Plan ==")[2]
    assert "Exchange" not in plan and "Sort" not in plan and placed.columns == ["name", "slot_index"]
    runs = placed.rdd.glom().map(lambda part: [r.name for r in part]).collect()
    expected = [f"s{i:03d}" for i in range(count)]
    assert runs == [expected[a : a + pack] for a in range(0, count, pack)]
    more = one_slot_per_partition(slots, count=count - 5)
    assert more.rdd.getNumPartitions() == count - 5 and more.count() == count


def test_very_many_partitions_by_bytes(spark, monkeypatch):
    for name, value in {"LISTED_PARTITIONS": 20, "COUNTED_PARTITIONS": 20, "STRETCHES": 6}.items():
        monkeypatch.setattr(ordering, name, value, raising=False)
    slots = spark.range(200).selectExpr("format_string('s%03d', id) AS name", "id AS length")
    packed = one_slot_per_partition(slots, partition_bytes=300)
    plan = packed._jdf.queryExecution().toString().partition("== Physical Plan ==")[2]
    assert "Exchange" not in plan and "Sort" not in plan
    parts = packed.rdd.glom().map(lambda part: [r.name for r in part]).collect()
    found = [(p, name) for p, part in enumerate(parts) for name in part]
    assert found == [(i * (i - 1) // 2 // 300, f"s{i:03d}") for i in range(200)]


@pytest.mark.parametrize(("count", "pack"), [(0, 1), (20, 1), (53, 1), (200, 7)])
def test_rows_of_partitions_run_in_steps(spark, monkeypatch, count, pack):
    """A task for every partition, and no job of more tasks than a step has."""
    for name, value in {"LISTED_PARTITIONS": 8, "COUNTED_PARTITIONS": 15, "STEP_PARTITIONS": 20}.items():
        monkeypatch.setattr(ordering, name, value)
    slots = spark.range(count).select(F.format_string("s%03d", "id").alias("name"))
    task = F.udf(lambda: TaskContext.get().taskAttemptId(), "long").asNondeterministic()
    steps = []

    def rows(placed, partition):
        steps.append(placed.rdd.getNumPartitions())
        return placed.select("name", "slot_index", partition.alias("partition_id"), task().alias("task"))

    found = sorted(ordering.rows_of_partitions(slots, rows, "name", pack).collect())
    partitions = -(-count // pack)
    expected = [min(20, partitions - first) for first in range(0, partitions, 20)]
    assert steps == (expected or [1])
    assert [tuple(r)[:3] for r in found] == [(f"s{i:03d}", i, i // pack) for i in range(count)]
    assert len({(r.partition_id, r.task) for r in found}) == len({r.task for r in found}) == partitions


@pytest.mark.parametrize(("query", "pack"), [("slot_partitions", 1), ("slot_partitions_packed", 7)])
def test_no_job_has_a_task_for_every_slot(spark, monkeypatch, tmp_path, query, pack):
    for name, value in {"LISTED_PARTITIONS": 8, "COUNTED_PARTITIONS": 15, "STEP_PARTITIONS": 20}.items():
        monkeypatch.setattr(ordering, name, value, raising=False)
    count = 20 * pack + 5
    (
        spark.range(count).selectExpr("id AS doc_id", "'en' AS lang", "concat('a\n', id) AS text")
        .write.parquet(f"{tmp_path}/documents.parquet")
    )
    spark.sparkContext.setJobGroup(query, query)
    try:
        rows = QUERIES[query](spark, str(tmp_path)).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted((r.slot_index, r.partition_id) for r in rows) == [(i, i // pack) for i in range(count)]
    tracker = spark.sparkContext.statusTracker()
    stages = [i for job in tracker.getJobIdsForGroup(query) for i in tracker.getJobInfo(job).stageIds]
    assert max(info.numTasks for i in stages if (info := tracker.getStageInfo(i))) == 20
