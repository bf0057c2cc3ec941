"""Advertising data-transfer file names: type and date."""

from __future__ import annotations

import re
from datetime import UTC, datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a name is marked, and the file types in the order in which they are tried.
# Hourly types have dates of ten digits, yyyyMMddHH, the others of eight, yyyyMMdd.
MARK = "dcm_account"
HOURLY_TYPES = ("click", "impression")
DCM_TYPES = (
    "activity",
    "click",
    "impression",
    "match_table_activity_cats",
    "match_table_activity_types",
    "match_table_ad_placement_assignments",
    "match_table_ads",
    "match_table_advertisers",
    "match_table_browsers",
    "match_table_campaigns",
    "match_table_cities",
    "match_table_creative_ad_assignments",
    "match_table_creatives",
    "match_table_custom_creative_fields",
    "match_table_custom_floodlight_variables",
    "match_table_custom_rich_media",
    "match_table_designated_market_areas",
    "match_table_keyword_value",
    "match_table_operating_systems",
    "match_table_paid_search",
    "match_table_placement_cost",
    "match_table_placements",
    "match_table_sites",
    "match_table_states",
)

_DAILY = "|".join(t for t in DCM_TYPES if t not in HOURLY_TYPES)
_HOURLY = "|".join(HOURLY_TYPES)
# One marked part of a name: type and date digits.
SEGMENT = rf"{MARK}[0-9]+_(?:(?:{_HOURLY})_[0-9]{{10}}|(?:{_DAILY})_[0-9]{{8}})_"
SEGMENT_TYPE = rf"^{MARK}[0-9]+_([a-z_]+)_"
# A name is a single line.
LINE_BREAKS = ("\n", "\r", "\u0085", "\u2028", "\u2029")


def dcm_type_of(label: Column) -> Column:
    """The type behind an upper-case label such as ``CLICK``; null when there is none."""
    return F.when(label.isin([t.upper() for t in DCM_TYPES]), F.lower(label))


def _date(digits: Column, lenient: bool) -> Column:
    """The time ``yyyyMMdd`` or ``yyyyMMddHH`` names, by calendar arithmetic: a parser would raise,
    and catch, an exception for every date outside the calendar."""
    padded = F.rpad(digits, 10, "0")
    year, month, day, hour = (
        F.substring(padded, start, size).cast("int")
        for start, size in ((1, 4), (5, 2), (7, 2), (9, 2))
    )
    date = F.date_add(F.add_months(F.make_date(year, F.lit(1), F.lit(1)), month - 1), day - 1)
    hours = F.make_dt_interval(F.lit(0), hour)
    time = (date.cast("timestamp_ntz") + hours).cast("timestamp")
    if lenient:
        return time
    # A day that is not one of its month has rolled into another month.
    inside = (year > 0) & month.between(1, 12) & (F.month(date) == month) & (hour < 24)
    return F.when(inside, time)


def _deciding_part(name: Column) -> Column:
    """Of several marked parts: of the type listed first, the last one."""
    order = F.array(*[F.lit(t) for t in DCM_TYPES])
    ranked = F.transform(
        F.regexp_extract_all(name, F.lit(SEGMENT), F.lit(0)),
        lambda part, at: F.struct(
            F.array_position(order, F.regexp_extract(part, SEGMENT_TYPE, 1)).alias("rank"),
            (-at).alias("back"),
            part.alias("part"),
        ),
    )
    return F.coalesce(F.array_min(ranked)["part"], F.lit(""))


def parse_dcm_name(name: Column, lenient: bool = False) -> Column:
    """``struct<dcm_type string, date timestamp>`` of a file name; null when it does not parse.

    A date outside the calendar makes the name unparsable, unless ``lenient``: then months beyond
    December and days beyond the month roll over (20161345 is 2017-02-14).
    """
    one_line = ~reduce(or_, [F.contains(name, F.lit(c)) for c in LINE_BREAKS])
    # Names that hold the mark once need no arrays and stay in generated code.
    twice = F.contains(F.substr(name, F.instr(name, MARK) + 1), F.lit(MARK))
    part = F.when(twice, _deciding_part(name)).otherwise(F.regexp_extract(name, SEGMENT, 0))
    # dcm_account<number>_<type>_<digits>_
    after_number = F.locate("_", part, len(MARK) + 1)
    digits = F.substring_index(F.substr(part, F.lit(1), F.length(part) - 1), "_", -1)
    kind = F.substr(
        part, after_number + 1, F.length(part) - F.length(digits) - 2 - after_number
    )
    date = _date(digits, lenient)
    return F.when(
        one_line & (part != "") & date.isNotNull(),
        F.struct(kind.alias("dcm_type"), date.alias("date")),
    )


def parse_dcm(name: str) -> tuple[str, datetime] | None:
    """Type and date of one file name, by the rules of ``parse_dcm_name``: for listings, whose rows
    are made one by one."""
    if any(c in name for c in LINE_BREAKS):
        return None
    # dcm_account<number>_<type>_<digits>_
    parts = [p[len(MARK) : -1].split("_", 1)[1] for p in re.findall(SEGMENT, name)]
    ranked = [(DCM_TYPES.index(p.rpartition("_")[0]), -i, p) for i, p in enumerate(parts)]
    if not ranked:
        return None
    kind, _, digits = min(ranked)[2].rpartition("_")
    try:
        date = datetime.strptime(digits.ljust(10, "0"), "%Y%m%d%H").replace(tzinfo=UTC)
    except ValueError:
        return None
    return kind, date
