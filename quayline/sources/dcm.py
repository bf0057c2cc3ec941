"""Advertising data-transfer files in a bucket.

The listing is that of the bucket; type and date of each file come from its name.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import ClassVar

from quayline.functions.dcm import DCM_TYPES, parse_dcm
from quayline.sources.base import Connector, Slot
from quayline.sources.files import FilesConnector
from quayline.sources.gcs import GcsConnector


@dataclass(frozen=True, repr=False)
class DcmNames(Connector):
    """Refines a listing to files named by type and date.  ``types`` keeps only those types; none
    keeps all.  Names that do not parse are no slots."""

    types: tuple[str, ...] = ()

    extra: ClassVar[tuple[tuple[str, str], ...]] = (("dcm_type", "string"),)

    def validate(self) -> None:
        super().validate()
        unknown = set(self.types) - set(DCM_TYPES)
        if unknown:
            raise ValueError(f"unknown types: {sorted(unknown)}")

    def refine(self, slot: Slot) -> tuple | None:
        found = parse_dcm(slot.name)
        if found is None or (self.types and found[0] not in self.types):
            return None
        return slot.name, found[1], slot.length, found[0]


@dataclass(frozen=True, repr=False)
class DcmConnector(DcmNames, GcsConnector):
    """The files of a bucket."""


@dataclass(frozen=True, repr=False)
class DcmFilesConnector(DcmNames, FilesConnector):
    """The files of a folder, where a bucket has been copied to one."""
