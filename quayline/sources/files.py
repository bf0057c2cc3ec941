"""Files on any file system Arrow reads: local, ``hdfs://``, ``s3://``, ``gs://``, ``file://``."""

from __future__ import annotations

import os
import posixpath
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from typing import ClassVar

from pyarrow import fs

from quayline.sources.base import Connector, Slot, require
from quayline.sources.location import open_location
from quayline.sources.wanted import Wanted

CHUNK_BYTES = 4 << 20
EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
# Names kept to cut a folder into ranges, and what parts a folder from the ends of a range: no path
# holds that character.
SAMPLED = 4096
RANGE = "\x00"


@dataclass(frozen=True, repr=False)
class FilesConnector(Connector):
    """Every plain file of a folder is a slot dated by its modification time.

    With ``recursive``, slots are named by their path below ``path`` and each sub-folder is listed
    by a task of its own; ``rootDepth`` 2, 3, … takes sub-folders of sub-folders, for trees in which
    one branch holds much of everything.  ``skipHidden`` leaves out names that start with ``_`` or
    ``.`` at any level, as Spark's own readers do; unless asked for, every name is a slot.

    A batch listing cuts a local folder of more than ``splitRows`` files into ranges of names, each for a
    task that looks only at files of its range.
    """

    path: str = ""
    recursive: bool = False
    rootDepth: int = 1
    skipHidden: bool = False
    splitRows: int = 100_000

    seekable: ClassVar[bool] = True

    def validate(self) -> None:
        require(path=self.path, rootDepth=self.rootDepth, splitRows=self.splitRows)

    def file_system(self) -> tuple[fs.FileSystem, str]:
        return open_location(self.path)

    def _hidden(self, path: str) -> bool:
        return self.skipHidden and any(p.startswith(("_", ".")) for p in path.split("/"))

    def _info(self, name: str) -> fs.FileInfo:
        files, base = self.file_system()
        return files.get_file_info(posixpath.join(base, name))

    def size(self, name: str) -> int | None:
        return self._info(name).size

    def version(self, name: str) -> str | None:
        info = self._info(name)
        return f"{info.size}-{info.mtime_ns}"

    def roots(self) -> list[str]:
        return self._folders(lambda folder: True)

    def wanted_roots(self, wanted: Wanted) -> list[str]:
        """Folders that no wanted name begins with are not even looked into."""
        found = self._folders(lambda folder: wanted.below(f"{folder}/"))
        return [root for root in found if self.may_hold(root, wanted)]

    def may_hold(self, root: str, wanted: Wanted) -> bool:
        if root and not wanted.below(f"{root}/"):
            return False
        if not self.recursive or self._depth(root) == self.rootDepth:
            return True
        # The files of the folder itself: a name with a further slash is none of them.
        own = f"{root}/" if root else ""
        if wanted.names is not None:
            return any(n.startswith(own) and "/" not in n[len(own) :] for n in wanted.names)
        folder = (wanted.low or "").rpartition("/")[0]
        deeper = folder.startswith(own) and len(folder) > len(own)
        return not (deeper and wanted.high is not None and wanted.high <= f"{folder}0")

    def _folders(self, look_into: Callable[[str], bool]) -> list[str]:
        if not self.recursive:
            return [""]
        files, base = self.file_system()
        roots, level = [""], [""]
        for _ in range(self.rootDepth):
            level = [
                folder
                for root in level
                for info in files.get_file_info(fs.FileSelector(posixpath.join(base, root)))
                if info.type == fs.FileType.Directory and not self._hidden(info.base_name)
                and look_into(folder := posixpath.relpath(info.path, base))
            ]
            roots += sorted(level)
        return roots

    @staticmethod
    def _depth(root: str) -> int:
        return root.count("/") + 1 if root else 0

    def split(self, root: str) -> list[str]:
        """Ranges of names of about as many files each, from a sample of the names.  Names pass one by
        one; the sample is of bounded size."""
        files, base = self.file_system()
        if not isinstance(files, fs.LocalFileSystem):
            return [root]
        count, sample, limit = 0, [], 1 << 32
        for name, _ in self._local_files(base, root):
            count += 1
            if (drawn := zlib.crc32(name.encode("utf-8", "surrogateescape"))) < limit:
                sample.append((name, drawn))
                while len(sample) > SAMPLED:
                    limit //= 2
                    sample = [(n, d) for n, d in sample if d < limit]
        pieces = -(-count // self.splitRows)
        if pieces <= 1:
            return [root]
        names = sorted({n for n, _ in sample})
        cuts = sorted({names[i * len(names) // pieces] for i in range(1, pieces)})
        return [RANGE.join((root, *ends)) for ends in zip(["", *cuts], [*cuts, ""], strict=True)]

    def _local_files(self, base: str, root: str) -> Iterator[tuple[str, os.DirEntry]]:
        """Names and entries of the files of a root on a local disk, one after the other."""
        deep = self.recursive and self._depth(root) == self.rootDepth
        folders = [root]
        while folders:
            folder = folders.pop()
            with os.scandir(posixpath.join(base, folder)) as entries:
                for entry in entries:
                    name = posixpath.join(folder, entry.name)
                    if self._hidden(name):
                        continue
                    if entry.is_file():
                        yield name, entry
                    elif deep and entry.is_dir():
                        folders.append(name)

    def list(self, root: str) -> Iterable[Slot]:
        files, base = self.file_system()
        root, _, ends = root.partition(RANGE)
        if isinstance(files, fs.LocalFileSystem):
            low, _, high = ends.partition(RANGE)
            for name, entry in self._local_files(base, root):
                # Only files of the range are asked for their size and date.
                if name >= low and (not high or name < high):
                    try:
                        found = entry.stat()
                    except FileNotFoundError:
                        continue
                    date = EPOCH + timedelta(microseconds=found.st_mtime_ns // 1000)
                    yield Slot(name, date, found.st_size)
            return
        # Folders above the deepest roots are listed alone, the deepest with all below them.
        deep = self.recursive and self._depth(root) == self.rootDepth
        for info in files.get_file_info(
            fs.FileSelector(posixpath.join(base, root), recursive=deep)
        ):
            name = posixpath.relpath(info.path, base)
            if info.type == fs.FileType.File and not self._hidden(name):
                yield Slot(name, info.mtime, info.size)

    def fetch(self, name: str) -> Iterator[bytes]:
        files, base = self.file_system()
        # The content decides about compression, not the name.
        with files.open_input_stream(posixpath.join(base, name), compression=None) as source:
            while chunk := source.read(CHUNK_BYTES):
                yield chunk

    def fetch_range(self, name: str, start: int, stop: int | None = None) -> Iterator[bytes]:
        files, base = self.file_system()
        with files.open_input_file(posixpath.join(base, name)) as source:
            source.seek(start)
            left = source.size() - start if stop is None else stop - start
            while left > 0 and (chunk := source.read(min(left, CHUNK_BYTES))):
                left -= len(chunk)
                yield chunk
