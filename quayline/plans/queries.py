"""One query per operator, over the given tables.  ``QUERIES`` and ``ORACLES`` share their keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayline.functions.dcm import DCM_TYPES, dcm_type_of, parse_dcm_name
from quayline.functions.text import split_lines
from quayline.functions.urls import url_kind
from quayline.operators.catalogue import (
    between_dates,
    dcm_slots,
    empty_like,
    exclude_previous,
    matching,
    read_catalogue,
)
from quayline.operators.ordering import (
    dense_positions,
    index_slots,
    one_slot_per_partition,
    rows_of_partitions,
)
from quayline.operators.payload import (
    fetch_payload,
    payload_lines,
    peek_lines,
    read_lines,
    read_metrics,
    slot_metrics,
    text_lines,
    write_lines,
)
from quayline.operators.polls import batch_descriptions, batch_report, new_slots, replayed_slots
from quayline.operators.ranges import (
    StartRange,
    apply_start,
    packed_range,
    range_summary,
    resume_packed,
    resume_range,
)
from quayline.plans.feeds import (
    PARTS_OF_DOCUMENTS,
    dcm_names,
    document_files,
    document_payload,
    document_slots,
    event_polls,
    gzipped,
    order_slots_feed,
    spread,
    table,
    wide_document_files,
    write_document_files,
)
from quayline.session import scratch_path, stored
from quayline.sources.datasource import register_sources
from quayline.sources.files import FilesConnector
from quayline.sources.hadoop import hadoop_lines
from quayline.streaming.slots import SlotStream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

FROM, TO = "1996-03-01 00:00:00", "1998-03-01 00:00:00"

# Tables of the oracle statements.
ORDERS = """orders_feed AS (
  SELECT 'order_' || o_orderkey AS name,
         CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END AS date,
         o_orderpriority AS priority
  FROM orders)"""
DOCS = """docs AS (
  SELECT 'doc_' || doc_id AS name,
         CASE WHEN doc_id % 10 <> 0
              THEN timestamp '2024-01-01 00:00:00' + (doc_id % 30) * interval 1 day END AS date,
         doc_id, lang, text
  FROM documents)"""
PARTS = r"""parts AS (
  SELECT name, date, doc_id, CASE WHEN text = '' THEN [] ELSE
    string_split_regex(regexp_replace(text, '(\r\n|\n|\r)$', ''), '\r\n|\n|\r') END AS p
  FROM docs)"""
LINES = f"""{DOCS}, {PARTS}, lines AS (
  SELECT name AS slot, date AS slot_date, unnest(range(len(p))) AS line_no, unnest(p) AS value
  FROM parts)"""
POLLS = """polls AS (
  SELECT date_trunc('day', ts)::timestamp AS poll, user_id || '_' || event_type AS name, ts AS date
  FROM events)"""
SELECTED = f"""{POLLS}, selected AS (
  SELECT name, min(poll) AS poll, min_by(date, (poll, date)) AS date FROM polls GROUP BY name)"""
DCM = """labelled AS (
  SELECT *, CASE event_type
    WHEN 'purchase' THEN 'activity_' || strftime(ts, '%Y%m%d')
    WHEN 'click' THEN 'click_' || strftime(ts, '%Y%m%d%H')
    WHEN 'view' THEN 'impression_' || strftime(ts, '%Y%m%d%H')
    WHEN 'signup' THEN 'match_table_' ||
      ['activity_cats', 'activity_types', 'ad_placement_assignments', 'ads', 'advertisers',
       'browsers', 'campaigns', 'cities', 'creative_ad_assignments', 'creatives',
       'custom_creative_fields', 'custom_floodlight_variables', 'custom_rich_media',
       'designated_market_areas', 'keyword_value', 'operating_systems', 'paid_search',
       'placement_cost', 'placements', 'sites', 'states'][user_id % 21 + 1]
      || '_' || strftime(ts, '%Y%m%d')
    ELSE 'FOO_' || strftime(ts, '%Y%m%d%H') END AS label
  FROM events), names AS (
  SELECT 'dcm_account' || user_id || '_' || label || '_' || strftime(ts, '%Y%m%d_%H%M%S')
         || '_' || event_id || '.csv.gz' AS name
  FROM labelled), cut AS (
  SELECT name, regexp_extract(name, '^.*dcm_account[0-9]+_(?:(click|impression)_([0-9]{10})|'
      || '(activity|match_table_[a-z_]+)_([0-9]{8}))_.*$',
    ['hour_type', 'hour', 'day_type', 'day']) AS m
  FROM names), parsed AS (
  SELECT name, coalesce(nullif(m.hour_type, ''), nullif(m.day_type, '')) AS dcm_type,
         coalesce(try_strptime(nullif(m.hour, ''), '%Y%m%d%H'),
                  try_strptime(nullif(m.day, ''), '%Y%m%d')) AS date
  FROM cut)"""


def query(name: str, oracle: str) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        ORACLES[name] = oracle
        return run

    return add


# Choosing slots


@query("slot_catalogue", f"WITH {ORDERS} SELECT name, date FROM orders_feed")
def slot_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_slots_feed(spark, sf_dir).select("name", "date")


@query(
    "slot_order_index",
    f"""WITH {ORDERS} SELECT name, date,
        row_number() OVER (ORDER BY date NULLS LAST, name) - 1 AS slot_index FROM orders_feed""",
)
def slot_order_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_slots(order_slots_feed(spark, sf_dir).select("name", "date"))


@query(
    "slot_order_plain",
    """SELECT 'order_' || o_orderkey AS name,
       row_number() OVER (ORDER BY 'order_' || o_orderkey) - 1 AS slot_index FROM orders""",
)
def slot_order_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_slots(order_slots_feed(spark, sf_dir).select("name"))


@query(
    "slot_filter",
    f"""WITH {ORDERS} SELECT name, date FROM orders_feed
        WHERE name LIKE 'order_1%' AND (date IS NULL OR month(date) = 12)""",
)
def slot_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = order_slots_feed(spark, sf_dir).select("name", "date")
    december = F.col("date").isNull() | (F.month("date") == 12)
    return matching(slots, F.col("name").startswith("order_1") & december)


@query(
    "slot_exclude_previous",
    f"""WITH {ORDERS}, previous AS (
          SELECT name, CASE WHEN priority LIKE '2%' THEN date + interval 1 day ELSE date END AS date
          FROM orders_feed WHERE priority < '4')
        SELECT name, date FROM orders_feed o WHERE NOT EXISTS (
          SELECT 1 FROM previous p WHERE p.name = o.name AND p.date IS NOT DISTINCT FROM o.date)""",
)
def slot_exclude_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = order_slots_feed(spark, sf_dir)
    moved = F.when(F.col("priority").startswith("2"), F.expr("date + interval 1 day"))
    previous = slots.filter("priority < '4'").select(
        "name", moved.otherwise(F.col("date")).alias("date")
    )
    return exclude_previous(slots.select("name", "date"), previous)


def _dated(name: str, from_date: str | None, to_date: str | None) -> None:
    bounds = [f"date >= timestamp '{from_date}'"] if from_date else []
    bounds += [f"date < timestamp '{to_date}'"] if to_date else []

    @query(
        name,
        f"WITH {ORDERS} SELECT name, date FROM orders_feed WHERE {' AND '.join(bounds) or 'true'}",
    )
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        slots = order_slots_feed(spark, sf_dir).select("name", "date")
        return between_dates(slots, from_date, to_date)


_dated("slot_date_range", FROM, TO)
_dated("slot_date_from", FROM, None)
_dated("slot_date_to", None, TO)
_dated("slot_date_open", None, None)


@query(
    "range_summary",
    f"""WITH {ORDERS}, placed AS (
          SELECT name, min(date) OVER () AS range_date,
                 row_number() OVER (ORDER BY date NULLS LAST, name) - 1 AS position
          FROM orders_feed)
        SELECT range_date, position // 1000 AS piece, count(*) AS n_names,
               string_agg(name, chr(10) ORDER BY position) AS names
        FROM placed GROUP BY ALL""",
)
def run_range_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = range_summary(order_slots_feed(spark, sf_dir).select("name", "date"))
    return token.withColumn("names", F.array_join("names", "\n"))


LINED = f"""{ORDERS}, lined AS (
  SELECT name || CASE WHEN priority LIKE '1%' THEN chr(10) || 'x' ELSE '' END AS name, date, priority,
         length(priority) AS length
  FROM orders_feed)"""


def _lined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots some of whose names hold a line break, with a length that tells nothing."""
    slots = order_slots_feed(spark, sf_dir)
    broken = F.when(F.col("priority").startswith("1"), "\nx").otherwise("")
    return slots.withColumn("name", F.concat("name", F.lit(broken))).withColumn(
        "length", F.length("priority")
    )


@query(
    "resume_odd_names",
    f"""WITH {LINED} SELECT name, date FROM lined WHERE date >=
          (SELECT min(date) FROM lined WHERE priority < '3')
        AND name NOT IN (SELECT name FROM lined WHERE priority < '3')""",
)
def resume_odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = _lined(spark, sf_dir)
    token = range_summary(slots.filter("priority < '3'").select("name", "date"))
    return apply_start(slots.select("name", "date"), resume_range(token))


@query(
    "resume_packed_names",
    f"""WITH {LINED} SELECT name, date FROM lined WHERE date >=
          (SELECT min(date) FROM lined WHERE priority < '3')
        AND name NOT IN (SELECT name FROM lined WHERE priority < '3')""",
)
def resume_packed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a packed token, whose names are cut by a filter before they are compared."""
    slots = _lined(spark, sf_dir)
    token = stored(packed_range(slots.filter("priority < '3'").select("name", "date")), "token")
    return apply_start(slots.select("name", "date"), resume_packed(token), prefilter=True)


@query(
    "exclude_prefiltered",
    f"WITH {LINED} SELECT name, date FROM lined WHERE priority >= '4' AND name LIKE 'order_1%'",
)
def exclude_prefiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some slots against far more previous ones."""
    slots = _lined(spark, sf_dir)
    some = slots.filter(F.col("name").startswith("order_1")).select("name", "date")
    return exclude_previous(some, slots.filter("priority < '4'"), prefilter=True)


@query(
    "exclude_other_lengths",
    f"WITH {LINED} SELECT name, date, length FROM lined WHERE priority >= '4'",
)
def exclude_other_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous slots of another length are the same slots."""
    slots = _lined(spark, sf_dir)
    before = slots.filter("priority < '4'").withColumn("length", F.col("length") + 1)
    return exclude_previous(slots.select("name", "date", "length"), before)


# Where a stream starts

FIRST_NAMES = ("order_1", "order_2", "order_3")


def _start(name: str, start: StartRange | None, condition: str) -> None:
    @query(name, f"WITH {ORDERS} SELECT name, date FROM orders_feed WHERE {condition}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return apply_start(order_slots_feed(spark, sf_dir).select("name", "date"), start)


_names = "name NOT IN ('order_1', 'order_2', 'order_3')"
_start("start_none", None, "true")
_start("start_date", StartRange(FROM), f"date >= timestamp '{FROM}'")
_start(
    "start_date_slots",
    StartRange(FROM, FIRST_NAMES),
    f"date >= timestamp '{FROM}' AND {_names}",
)
_start("start_slots", StartRange(names=FIRST_NAMES), _names)


@query(
    "start_resume",
    f"""WITH {ORDERS} SELECT name, date FROM orders_feed WHERE date >=
          (SELECT min(date) FROM orders_feed WHERE priority = '1-URGENT')
        AND name NOT IN (SELECT name FROM orders_feed WHERE priority = '1-URGENT')""",
)
def start_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Go on from the range of an earlier read, with its names as a table."""
    slots = order_slots_feed(spark, sf_dir)
    token = range_summary(slots.filter("priority = '1-URGENT'").select("name", "date"))
    return apply_start(slots.select("name", "date"), resume_range(token))


# What a stream selects


@query("new_slots_per_poll", f"WITH {SELECTED} SELECT name, poll, date FROM selected")
def new_slots_per_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_slots(event_polls(spark, sf_dir))


@query(
    "new_slots_from_start",
    f"""WITH {POLLS} SELECT name, min(poll) AS poll, min_by(date, (poll, date)) AS date
        FROM polls WHERE date >= timestamp '2024-01-10 12:00:00' AND name <> '1_click'
        GROUP BY name""",
)
def new_slots_from_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = StartRange("2024-01-10 12:00:00", ("1_click",))
    return new_slots(event_polls(spark, sf_dir), start)


@query(
    "late_slots_per_poll",
    f"""WITH {POLLS}, late AS (
          SELECT poll, name || '_late' AS name, date - interval 400 day AS date
          FROM polls WHERE name LIKE '%7_%'), everything AS (FROM polls UNION ALL FROM late)
        SELECT name, min(poll) AS poll, min_by(date, (poll, date)) AS date
        FROM everything GROUP BY name""",
)
def late_slots_per_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots that appear late with a date long before the poll are new all the same."""
    polls = event_polls(spark, sf_dir)
    late = polls.filter(F.col("name").like("%7_%")).select(
        "poll", F.concat("name", F.lit("_late")).alias("name"),
        F.expr("date - interval 400 days").alias("date"),
    )
    return new_slots(polls.unionByName(late))


@query(
    "replayed_after_restart",
    f"""WITH {POLLS} SELECT name, min(poll) AS first_poll,
          min(poll) FILTER (WHERE poll >= timestamp '2024-01-20') AS replayed_poll
        FROM polls GROUP BY name
        HAVING min(poll) < timestamp '2024-01-15' AND replayed_poll IS NOT NULL""",
)
def replayed_after_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    restart = F.expr("timestamp_ntz'2024-01-20 00:00:00'")
    horizon = F.expr("timestamp_ntz'2024-01-15 00:00:00'")
    return replayed_slots(event_polls(spark, sf_dir), restart, horizon)


@query(
    "batch_report",
    f"""WITH {DOCS}, {PARTS} SELECT date AS poll, count(*) AS n_slots,
          sum(len(p))::BIGINT AS n_lines, min(date) AS min_date, max(date) AS max_date
        FROM parts GROUP BY date""",
)
def run_batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    selected = document_slots(spark, sf_dir).select(
        F.col("date").alias("poll"),
        "name",
        "date",
        F.size(split_lines(F.col("text"))).cast("long").alias("n_lines"),
    )
    return batch_report(selected)


@query(
    "batch_descriptions",
    f"""WITH {SELECTED}, placed AS (
          SELECT poll, name,
                 row_number() OVER (PARTITION BY poll ORDER BY date NULLS LAST, name) - 1 AS position
          FROM selected)
        SELECT poll, position // 1000 AS piece, count(*) AS n_names,
               string_agg(name, chr(10) ORDER BY position) AS description
        FROM placed GROUP BY ALL""",
)
def run_batch_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_descriptions(new_slots(event_polls(spark, sf_dir)))


# Slots to lines


@query("slot_lines", f"WITH {LINES} SELECT slot, slot_date, line_no, value FROM lines")
def slot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_lines(document_slots(spark, sf_dir))


@query("slot_lines_gzip", f"WITH {LINES} SELECT slot, slot_date, line_no, value FROM lines")
def slot_lines_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_lines(document_payload(spark, sf_dir))


@query("slot_lines_charset", f"WITH {LINES} SELECT slot, slot_date, line_no, value FROM lines")
def slot_lines_charset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_lines(document_payload(spark, sf_dir, "UTF-16"), "UTF-16")


ENDED = """ended AS (
  SELECT name, date, doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE text || chr(10) END AS text FROM docs)"""


@query(
    "slot_lines_ended",
    f"""WITH {DOCS}, {ENDED}, {PARTS.replace("FROM docs", "FROM ended")}
        SELECT name AS slot, date AS slot_date, unnest(range(len(p))) AS line_no, unnest(p) AS value
        FROM parts""",
)
def slot_lines_ended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty contents have no line, and a line end behind the last line adds none, packed or not."""
    docs = spread(document_slots(spark, sf_dir), "name")
    text = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat("text", F.lit("\n")))
    payload = docs.withColumn("content", F.encode(text, "UTF-8"))
    return payload_lines(gzipped(payload, F.col("doc_id") % 2 == 0))


@query(
    "slot_lines_empty_scan",
    f"WITH {LINES} SELECT slot, slot_date, line_no, value FROM lines JOIN docs ON name = slot "
    "WHERE lang = 'en'",
)
def slot_lines_empty_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of some slots, and of a catalogue without slots, which has the same shape and no lines."""
    payload = document_payload(spark, sf_dir)
    english = document_slots(spark, sf_dir).filter("lang = 'en'").select("name")
    some = payload_lines(payload.join(english, "name", "left_semi"))
    return some.unionByName(payload_lines(empty_like(payload)))


@query("slot_lines_mixed_ends", f"WITH {LINES} SELECT slot, slot_date, line_no, value FROM lines")
def slot_lines_mixed_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three line ends give the same lines."""
    docs = spread(document_slots(spark, sf_dir), "name")
    ends = F.when(F.col("doc_id") % 3 == 0, "\r\n").when(F.col("doc_id") % 3 == 1, "\r")
    text = F.replace(F.col("text"), F.lit("\n"), ends.otherwise("\n"))
    payload = docs.withColumn("content", F.encode(text, "UTF-8"))
    return payload_lines(gzipped(payload, F.col("doc_id") % 2 == 0))


@query(
    "slot_partitions",
    f"""WITH {DOCS}, {PARTS} SELECT name AS slot, len(p) AS n_lines,
          row_number() OVER (ORDER BY date NULLS LAST, name) - 1 AS slot_index,
          row_number() OVER (ORDER BY date NULLS LAST, name) - 1 AS partition_id
        FROM parts""",
)
def slot_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = document_slots(spark, sf_dir).select(
        "name", "date", F.size(split_lines(F.col("text"))).cast("long").alias("n_lines")
    )

    def rows(placed: DataFrame, partition: Column) -> DataFrame:
        return placed.select(
            F.col("name").alias("slot"), "n_lines", "slot_index", partition.alias("partition_id")
        )

    return rows_of_partitions(slots, rows, "slot")


@query(
    "slot_partitions_packed",
    f"""WITH {DOCS} SELECT name AS slot,
          row_number() OVER (ORDER BY date NULLS LAST, name) - 1 AS slot_index,
          (row_number() OVER (ORDER BY date NULLS LAST, name) - 1) // 7 AS partition_id
        FROM docs""",
)
def slot_partitions_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = document_slots(spark, sf_dir).select("name", "date")

    def rows(placed: DataFrame, partition: Column) -> DataFrame:
        return placed.select(F.col("name").alias("slot"), "slot_index", partition.alias("partition_id"))

    return rows_of_partitions(slots, rows, "slot", slots_per_partition=7)


@query(
    "slot_partitions_bytes",
    f"""WITH {DOCS} SELECT name AS slot,
          coalesce(sum(strlen(text)) OVER (ORDER BY date NULLS LAST, name
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT // 100000 AS partition_id
        FROM docs""",
)
def slot_partitions_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = document_slots(spark, sf_dir).select(
        "name", "date", F.octet_length("text").alias("length")
    )
    return one_slot_per_partition(slots, partition_bytes=100_000).select(
        F.col("name").alias("slot"), F.spark_partition_id().cast("long").alias("partition_id")
    )


@query(
    "slot_metrics",
    f"""WITH {LINES} SELECT slot, count(*) AS records, sum(length(value))::BIGINT AS characters,
          sum(strlen(value))::BIGINT AS text_bytes FROM lines GROUP BY slot""",
)
def run_slot_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slot_metrics(payload_lines(document_payload(spark, sf_dir)))


@query("slot_text_roundtrip", f"WITH {LINES} SELECT value FROM lines")
def slot_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    write_lines(text_lines(document_slots(spark, sf_dir)), path)
    return spark.read.text(path)


@query(
    "slot_take",
    f"""WITH {LINES} SELECT slot, slot_date, line_no, value FROM lines
        ORDER BY slot_date NULLS LAST, slot, line_no LIMIT 10""",
)
def slot_take(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peek_lines(document_slots(spark, sf_dir), text_lines)


# Names and URLs


@query(
    "dcm_parse",
    f"""WITH {DCM} SELECT name, date, dcm_type FROM parsed
        WHERE dcm_type IS NOT NULL AND date IS NOT NULL""",
)
def dcm_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = dcm_slots(dcm_names(spark, sf_dir))
    return slots.withColumn("date", F.col("date").cast("timestamp_ntz"))


@query(
    "dcm_type_filter",
    f"""WITH {DCM} SELECT name, date, dcm_type FROM parsed
        WHERE dcm_type IN ('click', 'match_table_sites') AND date IS NOT NULL""",
)
def dcm_type_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = dcm_slots(dcm_names(spark, sf_dir), ["click", "match_table_sites"])
    return slots.withColumn("date", F.col("date").cast("timestamp_ntz"))


@query(
    "dcm_dates",
    """WITH parts AS (
         SELECT event_id, 2016 + event_id % 9 AS y, event_id % 20 AS m, event_id % 41 AS d
         FROM events)
       SELECT event_id, try_strptime(y || lpad(m::VARCHAR, 2, '0') || lpad(d::VARCHAR, 2, '0'),
                                     '%Y%m%d') AS strict_date,
         make_timestamp(y, 1, 1, 0, 0, 0) + to_months((m - 1)::INTEGER) + to_days((d - 1)::INTEGER)
           AS rolled_date
       FROM parts""",
)
def dcm_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates in and outside the calendar, dropped or rolled over."""
    number = F.col("event_id")
    digits = F.format_string("%d%02d%02d", 2016 + number % 9, number % 20, number % 41)
    name = F.concat(F.lit("dcm_account1_activity_"), digits, F.lit("_x"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        parse_dcm_name(name)["date"].cast("timestamp_ntz").alias("strict_date"),
        parse_dcm_name(name, lenient=True)["date"].cast("timestamp_ntz").alias("rolled_date"),
    )


@query(
    "dcm_type_lookup",
    f"""WITH labels AS (
          SELECT event_id, event_type, {list(DCM_TYPES)}[event_id % 26 + 1] AS label FROM events)
        SELECT event_id, event_type, label AS dcm_type,
          CASE WHEN event_type = 'click' THEN 'click' END AS event_dcm_type FROM labels""",
)
def dcm_type_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All labels of the list, and others, in turn."""
    known = F.array(*[F.lit(t.upper()) for t in DCM_TYPES])
    label = F.coalesce(F.get(known, (F.col("event_id") % 26).cast("int")), F.lit("OTHER"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        dcm_type_of(label).alias("dcm_type"),
        dcm_type_of(F.upper("event_type")).alias("event_dcm_type"),
    )


@query(
    "url_kind",
    r"""SELECT page_id, kind, count(*) AS n FROM (
          SELECT page_id, CASE
            WHEN regexp_full_match(u, 'hdfs://[.:\w]+[-_/.\w*]+') THEN 'hdfs'
            WHEN regexp_full_match(u, 'name://[-_/.\w*]+') THEN 'local'
            WHEN regexp_full_match(u, '\w+://.*') THEN 'unsupported'
            ELSE 'local' END AS kind
          FROM (SELECT page_id, unnest([url,
                  replace(replace(url, 'https://', 'hdfs://'), 'http://', 'name:///'),
                  regexp_replace(url, '^\w+://[^/]*', '')]) AS u FROM pages))
        GROUP BY page_id, kind""",
)
def run_url_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    moved = F.replace(
        F.replace(url, F.lit("https://"), F.lit("hdfs://")), F.lit("http://"), F.lit("name:///")
    )
    forms = F.array(url, moved, F.regexp_replace(url, r"^\w+://[^/]*", ""))
    urls = table(spark, sf_dir, "pages").select("page_id", F.explode(forms).alias("u"))
    kinds = urls.select("page_id", url_kind(F.col("u")).alias("kind"))
    return kinds.groupBy("page_id", "kind").agg(F.count(F.lit(1)).alias("n"))


# Connectors and streams


# Files hold the documents of a thousand ids each; a line says which line of which document it is.
FILED = f"""{LINES}, filed AS (
  SELECT CASE WHEN lang = 'en' THEN 'english' ELSE 'other' END AS part, doc_id // 1000 AS bucket,
         doc_id, line_no AS own_line, doc_id || chr(9) || line_no || chr(9) || value AS value
  FROM lines JOIN docs ON name = slot), numbered AS (
  SELECT part, bucket, value, doc_id, row_number() OVER (
    PARTITION BY part, bucket ORDER BY doc_id, own_line) - 1 AS line_no
  FROM filed)"""
SCANNED = f"WITH {FILED} SELECT part, bucket, line_no, value FROM numbered"


def _filed(lines: DataFrame) -> DataFrame:
    """Lines with what their slot's name says: the part and the bucket of documents."""
    name = F.regexp_extract(F.col("slot"), r"(english|other)/bucket=(\d+)/", 0)
    return lines.withColumn("part", F.substring_index(name, "/", 1)).withColumn(
        "bucket", F.regexp_extract(name, r"(\d+)/$", 1).cast("long")
    )


def _scanned(lines: DataFrame) -> DataFrame:
    return _filed(lines).select("part", "bucket", "line_no", "value")


def _files(path: str) -> FilesConnector:
    return FilesConnector(path, recursive=True, skipHidden=True, rootDepth=2)


@query("slots_source_scan", SCANNED)
def slots_source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scanned(read_lines(spark, _files(document_files(spark, sf_dir))))


@query("slots_split_scan", SCANNED)
def slots_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files, every plain one cut into ranges of 256 KiB for separate tasks."""
    files = _files(document_files(spark, sf_dir))
    return _scanned(read_lines(spark, files, split_bytes=256 << 10))


@query("slots_split_wide_scan", SCANNED)
def slots_split_wide_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines in UTF-16 of either byte order, in ranges of 256 KiB for separate tasks."""
    files = _files(wide_document_files(spark, sf_dir))
    return _scanned(read_lines(spark, files, charset="UTF-16", split_bytes=256 << 10))


@query("slots_where_scan", f"{SCANNED} WHERE part = 'english' AND bucket % 2 = 0")
def slots_where_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A condition on names that reaches the listing: folders that it rules out are not listed."""
    files = _files(document_files(spark, sf_dir))
    even = F.col("name").startswith("english/") & F.col("name").rlike(r"/bucket=\d*[02468]/")
    return _scanned(read_lines(spark, files, where=even))


@query("slots_ranges_scan", SCANNED)
def slots_ranges_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files as two large folders, each listed by tasks for ranges of names."""
    files = FilesConnector(document_files(spark, sf_dir), recursive=True, skipHidden=True, splitRows=2)
    return _scanned(read_lines(spark, files))


@query(
    "slots_read_metrics",
    f"""WITH {FILED} SELECT part, bucket, count(*) AS records, sum(length(value))::bigint AS characters,
          CASE WHEN part = 'other' THEN sum(strlen(value) + 1)::bigint END AS plain_bytes
        FROM numbered GROUP BY part, bucket""",
)
def slots_read_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What passed when each file was read; the bytes of gzipped ones are the compressor's affair."""
    files = _files(document_files(spark, sf_dir))
    found = _filed(read_metrics(read_catalogue(spark, files), files))
    plain = F.when(F.col("part") == "other", F.col("content_bytes"))
    return found.select("part", "bucket", "records", "characters", plain.alias("plain_bytes"))


@query("slots_hadoop_scan", SCANNED)
def slots_hadoop_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark's own reading of the files, in splits, with the numbers of the lines."""
    return _scanned(hadoop_lines(spark, document_files(spark, sf_dir), recursive=True))


@query("slots_payload_scan", SCANNED)
def slots_payload_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _files(document_files(spark, sf_dir))
    return _scanned(payload_lines(fetch_payload(read_catalogue(spark, files), files)))


@query("slots_stream_scan", SCANNED)
def slots_stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the files, a run, the other half, a second run from the same checkpoint."""
    base = scratch_path(spark, "stream")
    docs = document_slots(spark, sf_dir)
    stream = SlotStream(spark, _files(f"{base}/in"), f"{base}/polls", poll_interval_ms=1)
    lines = stream.lines()
    for part, chosen, packed in PARTS_OF_DOCUMENTS:
        write_document_files(docs.filter(chosen), f"{base}/in/{part}", packed)
        run = (
            lines.writeStream.format("parquet")
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{base}/out")
        )
        run.awaitTermination()
    return _scanned(spark.read.parquet(f"{base}/out"))


@query(
    "stream_horizon",
    f"{SCANNED} UNION ALL SELECT part, bucket, line_no, value FROM numbered WHERE part = 'english'",
)
def stream_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of a stream that remembers one batch before a restart: the files of the first batch
    are read again by the third run, those of the second are not."""
    base = scratch_path(spark, "horizon")
    docs = document_slots(spark, sf_dir)
    stream = SlotStream(
        spark, _files(f"{base}/in"), f"{base}/polls", poll_interval_ms=1, remember_batches=1
    )
    lines = stream.lines()
    for files in (*PARTS_OF_DOCUMENTS, None):
        if files is not None:
            part, chosen, packed = files
            write_document_files(docs.filter(chosen), f"{base}/in/{part}", packed)
        run = (
            lines.writeStream.format("parquet")
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{base}/out")
        )
        run.awaitTermination()
    return _scanned(spark.read.parquet(f"{base}/out"))


def _batches(spark: SparkSession, sf_dir: str) -> str:
    """Two streams, batch by batch with tables; the second goes on from the first one's slots."""
    base = scratch_path(spark, "batches")
    docs = document_slots(spark, sf_dir)
    for runs, (part, chosen, packed) in enumerate(PARTS_OF_DOCUMENTS):
        write_document_files(docs.filter(chosen), f"{base}/in/{part}", packed)
        start = StartRange(seen=spark.read.parquet(f"{base}/slots/run=0")) if runs else None
        stream = SlotStream(
            spark, _files(f"{base}/in"), f"{base}/polls{runs}", start, poll_interval_ms=1
        )
        run = (
            stream.for_each_batch(
                lambda lines, slots, batch_id: None,
                slot_table=f"{base}/slots/run={runs}",
                line_table=f"{base}/lines/run={runs}",
                report_table=f"{base}/reports/run={runs}",
            )
            .option("checkpointLocation", f"{base}/checkpoint{runs}")
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
    return base


@query("slots_batch_scan", SCANNED)
def slots_batch_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scanned(spark.read.parquet(f"{_batches(spark, sf_dir)}/lines"))


@query(
    "stream_order",
    f"WITH {FILED} SELECT part, bucket, line_no, true AS in_order FROM numbered",
)
def stream_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each line comes at its place in slot order, as a batch hands its lines on."""
    stream = SlotStream(
        spark, _files(document_files(spark, sf_dir)), scratch_path(spark, "polls"), poll_interval_ms=1
    )
    base = scratch_path(spark, "order")

    def keep(lines: DataFrame, slots: DataFrame, batch_id: int) -> None:
        # The partition of a row, and its place there.
        placed = lines.drop("value").withColumn("at", F.monotonically_increasing_id())
        placed.write.parquet(f"{base}/lines/batch={batch_id}")

    run = (
        stream.for_each_batch(keep)
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    lines = spark.read.parquet(f"{base}/lines")
    order = [F.col("slot_date"), F.col("slot"), F.col("line_no")]
    placed = dense_positions(lines, order, within=["batch"], name="wanted")
    placed = dense_positions(placed, [F.col("at")], within=["batch"], name="found")
    return _filed(placed).select(
        "part", "bucket", "line_no", (F.col("wanted") == F.col("found")).alias("in_order")
    )


@query(
    "stream_report",
    f"""WITH {FILED} SELECT part, count(DISTINCT bucket) AS n_slots, count(*) AS n_lines,
          array_to_string(list(DISTINCT bucket ORDER BY bucket), ',') AS buckets
        FROM numbered GROUP BY part""",
)
def stream_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the streams reported of their batches, by the part each of them read."""
    report = spark.read.parquet(f"{_batches(spark, sf_dir)}/reports")
    names = report.select("run", "batch_id", F.explode("names").alias("slot"))
    found = _filed(names).groupBy("run", "batch_id").agg(
        F.max("part").alias("part"),
        F.array_join(F.sort_array(F.collect_set("bucket")), ",").alias("buckets"),
    )
    counts = report.select("run", "batch_id", "n_slots", "n_lines").distinct()
    return counts.join(found, ["run", "batch_id"]).select("part", "n_slots", "n_lines", "buckets")


@query(
    "dcm_files_scan",
    f"""WITH {DCM}, files AS (
          SELECT DISTINCT regexp_extract(name, '^dcm_account[0-9]+_(.*_[0-9]+)_[0-9]{{8}}_', 1) AS label
          FROM names)
        SELECT DISTINCT 'dcm_account1_' || label || '_x' AS name, p.date, p.dcm_type
        FROM files f JOIN parsed p ON contains(p.name, '_' || f.label || '_')
        WHERE p.dcm_type IN ('click', 'activity') AND p.date IS NOT NULL""",
)
def dcm_files_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files named by type and date, listed through the format, which parses and filters them."""
    base = scratch_path(spark, "dcm")
    label = F.regexp_extract("name", r"^dcm_account[0-9]+_(.*_[0-9]+)_[0-9]{8}_", 1)
    files = dcm_names(spark, sf_dir).select(
        F.concat(F.lit("dcm_account1_"), label, F.lit("_x")).alias("file"),
        F.col("name").alias("value"),
    )
    files.repartition("file").write.partitionBy("file").text(base)
    register_sources(spark)
    listed = (
        spark.read.format("slots")
        .options(connector="dcm_files", path=base, recursive="true", skipHidden="true")
        .option("types", '["click", "activity"]')
        .load()
    )
    return listed.select(
        F.regexp_extract("name", "^file=([^/]*)/", 1).alias("name"),
        F.col("date").cast("timestamp_ntz").alias("date"),
        "dcm_type",
    ).distinct()
