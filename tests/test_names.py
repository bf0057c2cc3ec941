"""File names and URLs."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from quayline import DCM_TYPES, dcm_slots, dcm_type_of, parse_dcm_name, url_kind

ACTIVITY = "dcm_account411205_activity_20160927_20160928_050546_293409263.csv.gz"
CLICK = "dcm_account411205_click_2016092602_20160926_133141_292763957.csv.gz"
IMPRESSION = "dcm_account411205_impression_2016092603_20160926_131805_292768332.csv.gz"
FOREIGN = [
    "FOOO",
    "dcm_account411205_FOO_2016092603_20160926_131805_292768332.csv.gz",
    "AAA_BBB_CCC",
    "dcm_account411205_click_20160926_20160926_1_2.csv.gz",
    "dcm_account411205_activity_2016092603_20160926_1_2.csv.gz",
    "dcm_account_activity_20160927_1.csv.gz",
    "",
]


def listing(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def parsed(spark, *names, lenient=False):
    df = listing(spark, *names).select("name", parse_dcm_name(F.col("name"), lenient).alias("p"))
    return {
        r.name: (r.dcm_type, r.at)
        for r in df.select("name", "p.dcm_type", F.col("p.date").cast("string").alias("at")).collect()
    }


def test_names(spark):
    found = parsed(spark, ACTIVITY, CLICK, IMPRESSION, *FOREIGN)
    assert found[ACTIVITY] == ("activity", "2016-09-27 00:00:00")
    assert found[CLICK] == ("click", "2016-09-26 02:00:00")
    assert found[IMPRESSION] == ("impression", "2016-09-26 03:00:00")
    assert all(found[name] == (None, None) for name in FOREIGN)


def test_every_type(spark):
    assert len(DCM_TYPES) == 24
    stamps = {t: "2016092603" if t in ("click", "impression") else "20160926" for t in DCM_TYPES}
    names = {f"x/dcm_account1_{t}_{stamp}_rest": t for t, stamp in stamps.items()}
    assert {n: p[0] for n, p in parsed(spark, *names).items()} == names


def test_several_marked_parts(spark):
    """The type that comes first in the list wins, with its last part."""
    parts = [
        ("click", "2016010101"), ("activity", "20160102"), ("match_table_ads", "20160103"),
        ("activity", "20160104"), ("foo", "20160105"),
    ]
    names = {}
    for one in parts:
        for two in parts:
            for three in parts:
                chosen = (one, two, three)
                name = "_".join(f"dcm_account7_{t}_{d}" for t, d in chosen) + "_x"
                known = [(DCM_TYPES.index(t), -i, t) for i, (t, _) in enumerate(chosen)
                         if t in DCM_TYPES]
                best = min(known, default=None)
                names[name] = best and (best[2], chosen[-best[1]][1])
    for name, (kind, date) in parsed(spark, *names).items():
        expected = names[name]
        if expected is None:
            assert kind is None
        else:
            assert (kind, re.sub(r"\D", "", date)[: len(expected[1])]) == expected
    broken = "dcm_account7_click_2016010101_\ndcm_account7_activity_20160102_x"
    assert parsed(spark, broken)[broken] == (None, None)


def test_dates_outside_the_calendar(spark):
    day, hour = "dcm_account1_activity_20161345_x", "dcm_account1_click_2016123125_x"
    zero = "dcm_account1_activity_20160300_x"
    assert set(parsed(spark, day, hour, zero).values()) == {(None, None)}
    rolled = parsed(spark, day, hour, zero, ACTIVITY, *FOREIGN, lenient=True)
    assert rolled[day] == ("activity", "2017-02-14 00:00:00")
    assert rolled[hour] == ("click", "2017-01-01 01:00:00")
    assert rolled[zero] == ("activity", "2016-02-29 00:00:00")
    assert rolled[ACTIVITY] == ("activity", "2016-09-27 00:00:00")
    assert all(rolled[name] == (None, None) for name in FOREIGN)


def test_slots(spark):
    files = listing(spark, ACTIVITY, CLICK, IMPRESSION, *FOREIGN)
    assert sorted(r.dcm_type for r in dcm_slots(files).collect()) == [
        "activity", "click", "impression",
    ]
    some = dcm_slots(files, ["click"]).select("name", F.col("date").cast("string"), "dcm_type")
    assert [tuple(r) for r in some.collect()] == [(CLICK, "2016-09-26 02:00:00", "click")]
    assert dcm_slots(files, []).count() == 3


def test_lookup(spark):
    labels = listing(spark, "ACTIVITY", "MATCH_TABLE_SITES", "activity", "FOO")
    found = {r.name: r.t for r in labels.select("name", dcm_type_of(F.col("name")).alias("t")).collect()}
    assert found == {
        "ACTIVITY": "activity", "MATCH_TABLE_SITES": "match_table_sites", "activity": None, "FOO": None,
    }


@pytest.mark.parametrize(
    ("url", "kind"),
    [
        ("/FOO.txt", "local"),
        ("name:///FOO.txt", "local"),
        ("hdfs://127.0.0.1:50071/hdfs_files/example.txt", "hdfs"),
        ("hdfs://host/with space", "unsupported"),
        ("aaa:///FOO.txt", "unsupported"),
        ("name://?", "unsupported"),
        ("", "local"),
        ("hdfs://127.0.0.1:50071/a\n", "local"),
    ],
)
def test_url_kind(spark, url, kind):
    assert listing(spark, url).select(url_kind(F.col("name"))).first()[0] == kind
