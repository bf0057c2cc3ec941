"""Filters of names, and names in blocks."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quayline import StartRange, apply_start, exclude_previous, packed_range, resume_packed
from quayline.operators import names as names_module
from quayline.operators.names import (
    likely_among,
    name_filter,
    pack_block,
    pack_names,
    unpack_block,
    unpack_names,
)

ODD = ["", "\n", "a\tb", "é", "é", "漢字", "😀", "a" * 10_000, "a\x00b", "../x", " ", "'", '"', "\U0010ffff"]


def frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string").repartition(5)


@pytest.mark.parametrize("count", [0, 1, 3, 4, 5, 1000, 20_000])
def test_filter_loses_nothing_and_cuts_most(spark, count):
    held = frame(spark, [f"slot_{i}" for i in range(count)])
    others = spark.range(100_000).select(F.concat(F.lit("slot_"), "id").alias("name"))
    found = likely_among(others, held, count)
    assert found.columns == ["name"]
    passed = {r.name for r in found.collect()}
    assert {f"slot_{i}" for i in range(count)} <= passed
    # Names that are not held pass by chance.
    assert len(passed) - count < 0.03 * 100_000


def test_filters_merge(spark):
    a, b = frame(spark, ["x", "y", None]), frame(spark, ["z", "x"])
    parts = name_filter(a, 16).unionByName(name_filter(b, 16))
    merged = {(r.word, r.bits) for r in parts.groupBy("word").agg(F.bit_or("bits").alias("bits")).collect()}
    assert merged == {(r.word, r.bits) for r in name_filter(a.unionByName(b), 16).collect()}


def test_rows_are_cut_before_they_move(spark, tmp_path, monkeypatch):
    """The filter is below the exchange of the anti join, and few rows reach that."""
    spark.range(200_000).select(F.concat(F.lit("n"), "id").alias("name")).write.parquet(f"{tmp_path}/old")
    old = spark.read.parquet(f"{tmp_path}/old")
    new = spark.range(199_000, 203_000).select(F.concat(F.lit("n"), "id").alias("name"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = exclude_previous(new, old, prefilter=True)
        assert {r.name for r in kept.collect()} == {f"n{i}" for i in range(200_000, 203_000)}
        plan = kept._jdf.queryExecution().executedPlan().toString()
        # The anti join exchanges its sides; the previous names come from a join with the filter.
        assert "LeftAnti" in plan and "BroadcastHashJoin" in plan
        cut = likely_among(old, new, 4000)
        assert cut.count() < 10_000
        assert apply_start(new, StartRange(seen=old), prefilter=True).count() == 3000
        # Too many names for a filter: the same slots by the join alone.
        monkeypatch.setattr(names_module, "FILTER_NAMES", 10)
        assert exclude_previous(new, old, prefilter=True).count() == 3000
        assert likely_among(old, new, 4000) is old
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_prefilter_keeps_the_rules(spark):
    """Nulls equal nulls, another date is another slot."""
    slots = spark.createDataFrame(
        [("a", "2024-01-01"), ("b", None), (None, None), ("c", "2024-01-02"), ("a", "2024-01-01")],
        "name string, date string",
    )
    old = spark.createDataFrame(
        [("a", "2024-01-01"), ("b", None), (None, None), ("c", "2024-01-03")], "name string, date string"
    )
    plain = sorted(exclude_previous(slots, old).collect())
    assert plain == sorted(exclude_previous(slots, old, prefilter=True).collect())
    assert [tuple(r) for r in plain] == [("c", "2024-01-02")]


def test_blocks():
    rng = random.Random(6)
    for _ in range(200):
        names = {"".join(rng.choices("ab/é漢\n", k=rng.randint(0, 300))) for _ in range(rng.randint(0, 40))}
        names = sorted(names | set(rng.sample(ODD, 4)))
        assert list(unpack_block(pack_block(names))) == names
    assert list(unpack_block(pack_block([]))) == []


@pytest.mark.parametrize("per_block", [1, 7, 1000])
def test_packed_names(spark, per_block):
    names = [f"2024/{i % 12}/file_{i:06}.csv" for i in range(3000)] + ODD + ODD + [None]
    blocks = pack_names(frame(spark, names), per_block)
    rows = blocks.collect()
    assert sorted(r.name for r in unpack_names(blocks).collect()) == sorted({n for n in names if n is not None})
    assert sum(r.n_names for r in rows) == 3000 + len(ODD)
    assert max(r.n_names for r in rows) <= per_block
    for r in rows:
        block = list(unpack_block(bytes(r.packed)))
        assert (block[0], block[-1], len(block)) == (r.first, r.last, r.n_names)
    if per_block == 1000:
        # Without the odd names, one of which is long: a few bytes a name instead of 24.
        plain = pack_names(frame(spark, names[:3000]), per_block)
        size = plain.agg(F.sum(F.octet_length("packed"))).first()[0]
        assert size / 3000 < 6
    assert pack_names(frame(spark, []).limit(0)).collect() == []


def test_packed_token(spark):
    slots = spark.createDataFrame(
        [("a\nb", "2024-01-02"), ("c", "2024-01-01"), ("d", None)], "name string, date string"
    ).withColumn("date", F.to_timestamp("date"))
    token = packed_range(slots)
    start = resume_packed(token)
    assert str(start.date).startswith("2024-01-01")
    more = slots.unionByName(
        spark.createDataFrame([("e", "2024-01-01"), ("f", "2023-01-01"), ("g", None)], "name string, date string")
        .withColumn("date", F.to_timestamp("date"))
    )
    assert [r.name for r in apply_start(more, start).collect()] == ["e"]
    assert [r.name for r in apply_start(more, start, prefilter=True).collect()] == ["e"]
    assert packed_range(slots.limit(0)).collect() == []
    undated = packed_range(slots.select("name"))
    assert {r.name for r in apply_start(more, resume_packed(undated)).collect()} == {"e", "f", "g"}
