"""What of a collection is wanted: bounds of names, dates and types that reach the listing."""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql.datasource import (
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
)


def after_prefix(prefix: str) -> str | None:
    """The least text, by code points, above all that start with ``prefix``; None if there is none."""
    for i in range(len(prefix) - 1, -1, -1):
        point = ord(prefix[i]) + 1
        # Surrogates are no characters.
        point = 0xE000 if 0xD800 <= point <= 0xDFFF else point
        if point <= 0x10FFFF:
            return prefix[:i] + chr(point)
    return None


def _moment(value: datetime) -> datetime:
    return value.astimezone(UTC) if value.tzinfo else value.replace(tzinfo=UTC)


@dataclass(frozen=True)
class Wanted:
    """Slots with names from ``low`` up to but not including ``high`` by code points, or among
    ``names``; dated from ``since`` up to and including ``until``; of one of ``types``.  What is None
    wants all.  It says what a listing may leave out, nothing else: a wider one does no harm.
    """

    low: str | None = None
    high: str | None = None
    names: tuple[str, ...] | None = None
    since: datetime | None = None
    until: datetime | None = None
    types: tuple[str, ...] | None = None

    @classmethod
    def prefixed(cls, prefix: str, **others) -> Wanted:  # noqa: ANN003
        return cls(low=prefix or None, high=after_prefix(prefix), **others)

    def both(self, other: Wanted) -> Wanted:
        """What both want."""

        def pick(a, b, better):  # noqa: ANN001, ANN202
            return b if a is None else a if b is None else better(a, b)

        def common(a: tuple, b: tuple) -> tuple:
            return tuple(x for x in a if x in set(b))

        return Wanted(
            pick(self.low, other.low, max),
            pick(self.high, other.high, min),
            pick(self.names, other.names, common),
            pick(self.since, other.since, max),
            pick(self.until, other.until, min),
            pick(self.types, other.types, common),
        )

    def name(self, name: str) -> bool:
        return (
            (self.low is None or name >= self.low)
            and (self.high is None or name < self.high)
            and (self.names is None or name in self.names)
        )

    def below(self, prefix: str) -> bool:
        """Whether a name that starts with ``prefix`` may be wanted."""
        end = after_prefix(prefix)
        return (
            (self.high is None or prefix < self.high)
            and (self.low is None or end is None or end > self.low)
            and (self.names is None or any(n.startswith(prefix) for n in self.names))
        )

    def row(self, row: tuple, columns: list[str]) -> bool:
        """Whether a row of a catalogue is wanted."""
        if not self.name(row[0]):
            return False
        if self.since is not None or self.until is not None:
            if row[1] is None:
                return False
            date = _moment(row[1])
            if self.since is not None and date < _moment(self.since):
                return False
            if self.until is not None and date > _moment(self.until):
                return False
        return self.types is None or "dcm_type" not in columns or (
            row[columns.index("dcm_type")] in self.types
        )

    def to_dict(self) -> dict:
        return json.loads(json.dumps(dataclasses.asdict(self), default=lambda d: d.isoformat()))

    @classmethod
    def from_dict(cls, fields: dict | None) -> Wanted | None:
        if fields is None:
            return None
        lists = {k: None if fields[k] is None else tuple(fields[k]) for k in ("names", "types")}
        dates = {
            k: None if fields[k] is None else datetime.fromisoformat(fields[k])
            for k in ("since", "until")
        }
        return cls(fields["low"], fields["high"], **lists, **dates)


def wanted_by(filters: Iterable[Filter]) -> Wanted:
    """What Spark's filters on a catalogue want; those that say nothing here are left to Spark."""
    found = Wanted()
    for one in filters:
        column = getattr(one, "attribute", None)
        value = getattr(one, "value", None)
        said = None
        if column == ("name",):
            if isinstance(one, EqualTo | EqualNullSafe) and isinstance(value, str):
                said = Wanted(names=(value,))
            elif isinstance(one, In):
                said = Wanted(names=tuple(v for v in one.value if isinstance(v, str)))
            elif isinstance(one, StringStartsWith):
                said = Wanted.prefixed(value)
            elif isinstance(one, GreaterThan | GreaterThanOrEqual):
                said = Wanted(low=value)
            elif isinstance(one, LessThan):
                said = Wanted(high=value)
            elif isinstance(one, LessThanOrEqual):
                said = Wanted(high=value + "\x00")
        elif column == ("date",) and isinstance(value, datetime):
            if isinstance(one, EqualTo | EqualNullSafe):
                said = Wanted(since=value, until=value)
            elif isinstance(one, GreaterThan | GreaterThanOrEqual):
                said = Wanted(since=value)
            elif isinstance(one, LessThan | LessThanOrEqual):
                said = Wanted(until=value)
        elif column == ("dcm_type",):
            if isinstance(one, EqualTo | EqualNullSafe) and isinstance(value, str):
                said = Wanted(types=(value,))
            elif isinstance(one, In):
                said = Wanted(types=tuple(v for v in one.value if isinstance(v, str)))
        if said is not None:
            found = found.both(said)
    return found
