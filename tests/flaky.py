"""A files connector that counts its calls and fails on purpose."""

from __future__ import annotations

import hashlib
import posixpath
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import cloudpickle

from quayline.sources.base import Slot
from quayline.sources.files import FilesConnector
from quayline.sources.location import open_location

# Workers cannot import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True, repr=False)
class FlakyFiles(FilesConnector):
    """The first ``listBadTries`` listings of a folder and the first ``fetchBadTries`` fetches of a
    slot fail, fetches in the middle of the content.

    Calls are counted by marker files in ``marks``, because every attempt uses a new connector.
    With ``splitInside``, the n-th listing shows only the first n files.
    """

    marks: str = ""
    listBadTries: int = 0
    fetchBadTries: int = 0
    splitInside: bool = False

    def _call(self, what: str) -> int:
        files, base = open_location(self.marks)
        folder = posixpath.join(base, hashlib.sha256(what.encode()).hexdigest()[:24])
        files.create_dir(folder, recursive=True)
        call = len(files.get_file_info(fs.FileSelector(folder)))
        with files.open_output_stream(posixpath.join(folder, str(call))):
            pass
        return call

    def list(self, root: str) -> Iterable[Slot]:
        call = self._call(f"list {root}")
        if call < self.listBadTries:
            raise OSError(f"listing {call} fails on purpose")
        slots = sorted(super().list(root))
        return slots[: call - self.listBadTries + 1] if self.splitInside else slots

    def fetch(self, name: str) -> Iterator[bytes]:
        fails = self._call(f"fetch {name}") < self.fetchBadTries
        for chunk in super().fetch(name):
            if fails:
                yield chunk[: len(chunk) // 2]
                break
            yield chunk
        if fails:
            raise OSError("fetch fails on purpose")
