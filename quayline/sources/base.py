"""The plug-in interface: a connector lists named slots and fetches one slot's bytes."""

from __future__ import annotations

import dataclasses
import json
import logging
import time
import zlib
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime
from typing import Any, ClassVar, NamedTuple, TypeVar

from quayline.sources.wanted import Wanted

log = logging.getLogger(__name__)

# Re-tries of a failing listing or fetch, and the pause between two attempts.
MAX_RETRIES = 3
RETRY_PAUSE_SECONDS = 0.1

SECRET_MARK = "***"
T = TypeVar("T")


class SlotSourceError(IOError):
    """A listing or a fetch that failed on every attempt."""


class Slot(NamedTuple):
    """One catalogue row.  ``date`` is an aware UTC datetime or None."""

    name: str
    date: datetime | None = None
    length: int | None = None


def require(**values: Any) -> None:
    """Reject missing and empty texts and non-positive numbers."""
    for field, value in values.items():
        if value is None or (isinstance(value, str) and not value):
            raise ValueError(f"{field} must not be empty")
        if isinstance(value, (int, float)) and not isinstance(value, bool) and value <= 0:
            raise ValueError(f"{field} must be greater than 0")


@dataclasses.dataclass(frozen=True)
class Connector(ABC):
    """Parameters of a remote collection.  Subclasses are frozen dataclasses.

    An instance is pickled to executors, where every task works with a copy of its own; clients are
    opened on demand and must not be created in ``__init__``.
    """

    def __post_init__(self) -> None:
        self.validate()

    def validate(self) -> None:
        """Raise ``ValueError`` for unusable parameters; called at construction."""

    def roots(self) -> Iterable[str]:
        """Parts of the collection that can be listed side by side, one task each.  Called in a
        task, and again after a failure."""
        return [""]

    def may_hold(self, root: str, wanted: Wanted) -> bool:
        """Whether a wanted slot may lie below ``root``; a root of which this is sure not is not listed."""
        return True

    def wanted_roots(self, wanted: Wanted) -> Iterable[str]:
        """The roots that may hold wanted slots."""
        return [root for root in self.roots() if self.may_hold(root, wanted)]

    def split(self, root: str) -> Iterable[str]:
        """Roots that together hold what ``root`` does, where it holds too much for one task."""
        return [root]

    @abstractmethod
    def list(self, root: str) -> Iterable[Slot]:
        """All slots below ``root``."""

    @abstractmethod
    def fetch(self, name: str) -> Iterable[bytes]:
        """The whole content of a slot, in chunks."""

    # Whether ``fetch_range`` works, so that a large plain-text slot can be read by several tasks.
    seekable: ClassVar[bool] = False
    # Names and kinds (string, timestamp, long, double, boolean) of the columns that ``refine`` adds
    # behind name, date and length.
    extra: ClassVar[tuple[tuple[str, str], ...]] = ()

    def refine(self, slot: Slot) -> tuple | None:
        """The catalogue's row of a listed slot, or None to leave it out, where names say more than
        the collection does.  Called for every row, wherever a listing is made."""
        return slot

    def change_token(self) -> str | None:
        """A cheap text that changes whenever a slot may have been added; None if only a listing can
        tell.  A stream asks for it at every poll."""
        return None

    def version(self, name: str) -> str | None:
        """What changes whenever a slot's content does, such as its size and time; None if unknown.
        Ranges of one slot are only put together if they saw the same version."""
        return None

    def size(self, name: str) -> int | None:
        """The present length of a slot; needed of connectors that can seek."""
        return None

    def fetch_range(self, name: str, start: int, stop: int | None = None) -> Iterable[bytes]:
        """The bytes of a slot from ``start`` up to ``stop`` or the end, in chunks."""
        raise NotImplementedError(f"{type(self).__name__} reads slots only as a whole")

    def close(self) -> None:
        """Release the client of this copy."""

    def fresh(self) -> Connector:
        """A copy without a client."""
        return dataclasses.replace(self)

    def __repr__(self) -> str:
        shown = ", ".join(
            f"{f.name}={SECRET_MARK if f.metadata.get('secret') else getattr(self, f.name)!r}"
            for f in dataclasses.fields(self)
        )
        return f"{type(self).__name__}({shown})"

    def to_json(self) -> str:
        return json.dumps(dataclasses.asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Connector:
        return cls(**json.loads(text))


def secret(default: Any = dataclasses.MISSING) -> Any:
    """A dataclass field left out of ``repr``."""
    return dataclasses.field(default=default, metadata={"secret": True}, repr=False)


def retrying(attempt: Callable[[], T], max_retries: int, what: str) -> T:
    """Call until it succeeds: ``max_retries`` re-tries after the first failure."""
    for left in range(max_retries, -1, -1):
        try:
            return attempt()
        except Exception as error:
            if not left:
                raise SlotSourceError(f"{what} failed after {max_retries} re-tries") from error
            log.warning("%s failed, %d re-tries left: %s", what, left, error)
            time.sleep(RETRY_PAUSE_SECONDS)
    raise AssertionError("unreachable")


class Fetcher:
    """Fetches slots one after the other over one client, which is replaced after a failure."""

    def __init__(self, template: Connector, max_retries: int) -> None:
        self._template = template
        self._max_retries = max_retries
        self._connector: Connector | None = None

    def _client(self) -> Connector:
        if self._connector is None:
            self._connector = self._template.fresh()
        return self._connector

    def _open(self, name: str, start: int, stop: int | None) -> Iterable[bytes]:
        if start == 0 and stop is None:
            return self._client().fetch(name)
        return self._client().fetch_range(name, start, stop)

    def about(self, name: str) -> tuple[int | None, str | None]:
        """Present size and version of a slot."""

        def ask() -> tuple[int | None, str | None]:
            try:
                return self._client().size(name), self._client().version(name)
            except Exception:
                self.close()
                raise

        return retrying(ask, self._max_retries, f"looking at slot {name}")

    def unchanged(self, name: str, version: str | None) -> None:
        """Fail unless the slot still has the version its ranges were made for."""
        if version is not None and self.about(name)[1] != version:
            raise _ChangedSlot(f"slot {name} changed while it was read in ranges")

    def chunks(self, name: str, start: int = 0, stop: int | None = None) -> Iterator[bytes]:
        """Content of a slot.  After a failure the slot is opened again and resumed.

        Bytes already handed on are read again and compared by checksum, so that an object which
        changed between two attempts fails the task instead of mixing two versions.
        """
        passed, checksum = 0, 0
        left = self._max_retries
        while True:
            try:
                again, seen = passed, 0
                for chunk in self._open(name, start, stop):
                    if again:
                        known, chunk = chunk[:again], chunk[again:]
                        again -= len(known)
                        seen = zlib.crc32(known, seen)
                        if not again and seen != checksum:
                            raise _ChangedSlot(f"slot {name} changed between two attempts")
                    if len(chunk):
                        passed += len(chunk)
                        checksum = zlib.crc32(chunk, checksum)
                        yield chunk
                if again:
                    raise _ChangedSlot(f"slot {name} became shorter between two attempts")
                return
            except _ChangedSlot:
                self.close()
                raise
            except Exception as error:
                self.close()
                if not left:
                    raise SlotSourceError(
                        f"fetching slot {name} failed after {self._max_retries} re-tries"
                    ) from error
                log.warning("fetching %s failed, %d re-tries left: %s", name, left, error)
                left -= 1
                time.sleep(RETRY_PAUSE_SECONDS)

    def close(self) -> None:
        connector, self._connector = self._connector, None
        if connector is not None:
            try:
                connector.close()
            except Exception as error:
                log.info("closing %r: %s", connector, error)


class _ChangedSlot(SlotSourceError):
    pass
