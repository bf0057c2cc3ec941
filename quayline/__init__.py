"""Slot ingestion for PySpark.

A *slot* is one named object of a remote collection.  A catalogue of slots is a DataFrame; picking,
ordering, fetching and splitting slots are DataFrame operators that run on executors.
"""

import sys

from pyspark import cloudpickle

from quayline.functions.dcm import DCM_TYPES, dcm_type_of, parse_dcm_name
from quayline.functions.text import split_lines
from quayline.functions.urls import url_kind
from quayline.operators.catalogue import (
    between_dates,
    dcm_slots,
    empty_like,
    exclude_previous,
    matching,
    order_slots,
    read_catalogue,
)
from quayline.operators.ordering import dense_positions, index_slots, one_slot_per_partition
from quayline.operators.payload import (
    fetch_lines,
    fetch_payload,
    ordered_lines,
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
from quayline.session import build_session
from quayline.sources.base import Connector, Slot, SlotSourceError
from quayline.sources.datasource import register_sources
from quayline.sources.hadoop import hadoop_lines, hadoop_slots
from quayline.sources.wanted import Wanted
from quayline.streaming.slots import BatchReportListener, SlotStream

# Functions and connectors travel to executors by value, so workers need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "BatchReportListener",
    "Connector",
    "DCM_TYPES",
    "Slot",
    "SlotSourceError",
    "SlotStream",
    "StartRange",
    "Wanted",
    "apply_start",
    "batch_descriptions",
    "batch_report",
    "between_dates",
    "build_session",
    "dcm_slots",
    "dcm_type_of",
    "dense_positions",
    "empty_like",
    "exclude_previous",
    "fetch_lines",
    "fetch_payload",
    "hadoop_lines",
    "hadoop_slots",
    "index_slots",
    "matching",
    "new_slots",
    "one_slot_per_partition",
    "order_slots",
    "ordered_lines",
    "packed_range",
    "parse_dcm_name",
    "payload_lines",
    "peek_lines",
    "range_summary",
    "read_catalogue",
    "read_lines",
    "read_metrics",
    "register_sources",
    "replayed_slots",
    "resume_packed",
    "resume_range",
    "slot_metrics",
    "split_lines",
    "text_lines",
    "url_kind",
    "write_lines",
]
