"""Listings of polls, in a shared folder.

A folder per listing root holds its listing as of the polls that found it changed: the rows a batch
gets, and the names the polls after it need not send again.  A root that holds the same names as before
gets no new file.  The first file published for a poll stays: where two attempts of a task list at the
same time, both read back the same one.
"""

from __future__ import annotations

import hashlib
import json
import os
import posixpath
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs

from quayline.sources.base import Connector
from quayline.sources.buckets import HashedListing, StoredBuckets
from quayline.sources.listing import arrow_schema, list_pages
from quayline.sources.location import open_location
from quayline.sources.wanted import Wanted

FRESH = "fresh"
DIGEST = b"digest"


def root_key(root: str) -> str:
    return hashlib.sha256(root.encode()).hexdigest()[:32]


class PollLog:
    def __init__(self, location: str) -> None:
        self.location = location

    def _open(self) -> tuple[fs.FileSystem, str]:
        return open_location(self.location)

    # Polls and the roots they found new slots below

    def _polls(self, files: fs.FileSystem, base: str, kind: str = "polls") -> list[int]:
        found = files.get_file_info(fs.FileSelector(f"{base}/{kind}", allow_not_found=True))
        return [int(i.base_name[:-5]) for i in found if i.base_name.endswith(".json")]

    def latest(self) -> int:
        files, base = self._open()
        return max(self._polls(files, base), default=0)

    def write_poll(self, poll: int, roots: list[str], first: bool = False) -> None:
        """Enter a poll, the roots below which it found new slots, and whether it is the ``first`` one of a
        run."""
        files, base = self._open()
        files.create_dir(f"{base}/polls", recursive=True)
        with files.open_output_stream(f"{base}/polls/{poll}.json") as out:
            out.write(json.dumps({"roots": roots, "first": first}).encode())

    def roots(self, poll: int) -> list[str] | None:
        """The roots with new slots of a poll; None if the poll is not entered."""
        entry = self._entry("polls", poll)
        return None if entry is None else entry["roots"]

    def number(self, previous: int, poll: int) -> tuple[int, int]:
        """Number of the batch of a poll, which follows that of the poll ``previous``, and of the first
        batch of its run.  Only batches count: a poll for a query that was stopped meanwhile has none.
        A batch that is repeated has the number it had."""
        before, run = self._numbers(previous)
        own = before + 1
        run = own if (self._entry("polls", poll) or {}).get("first") else run
        files, base = self._open()
        files.create_dir(f"{base}/numbers", recursive=True)
        with files.open_output_stream(f"{base}/numbers/{poll}.json") as out:
            out.write(json.dumps({"number": own, "run": run}).encode())
        return own, run

    def _numbers(self, poll: int) -> tuple[int, int]:
        entry = self._entry("numbers", poll) or {}
        return entry.get("number", 0), entry.get("run", 0)

    def _entry(self, kind: str, poll: int) -> dict | None:
        files, base = self._open()
        path = f"{base}/{kind}/{poll}.json"
        if files.get_file_info(path).type != fs.FileType.File:
            return None
        with files.open_input_stream(path) as source:
            return json.loads(source.read())

    # Listings

    @staticmethod
    def _folder(base: str, root: str) -> str:
        return posixpath.join(base, f"root={root_key(root)}")

    def _versions(self, root: str) -> dict[int, str]:
        """The listings of a root, by poll: of each the earliest that was published."""
        files, base = self._open()
        found = files.get_file_info(
            fs.FileSelector(self._folder(base, root), allow_not_found=True)
        )
        versions: dict[int, tuple] = {}
        for info in found:
            if info.base_name.endswith(".arrow"):
                poll = int(info.base_name.split(".")[0])
                mine = (info.mtime_ns or 0, info.base_name, info.path)
                versions[poll] = min(versions.get(poll, mine), mine)
        return {poll: version[2] for poll, version in versions.items()}

    def has(self, poll: int, root: str) -> bool:
        return poll in self._versions(root)

    def write_once(
        self,
        poll: int,
        root: str,
        schema: pa.Schema,
        batches: Iterable[pa.RecordBatch],
    ) -> None:
        """Publish a listing.  On local disks a hard link makes the first one the only one.  Object
        stores replace what is there, so each attempt has a name of its own and the earliest counts.
        """
        files, base = self._open()
        folder = self._folder(base, root)
        files.create_dir(folder, recursive=True)
        draft = posixpath.join(folder, f"draft-{uuid.uuid4().hex}")
        with files.open_output_stream(draft) as out, pa.ipc.new_file(out, schema) as writer:
            for batch in batches:
                writer.write_batch(batch)
        if isinstance(files, fs.LocalFileSystem):
            try:
                os.link(draft, posixpath.join(folder, f"{poll}.arrow"))
            except FileExistsError:
                pass
            Path(draft).unlink()
        else:
            files.move(draft, posixpath.join(folder, f"{poll}.{uuid.uuid4().hex}.arrow"))

    @contextmanager
    def _reader(self, path: str) -> Iterator[pa.RecordBatchFileReader]:
        files, _ = self._open()
        with files.open_input_file(path) as source:
            yield pa.ipc.open_file(source)

    def read(self, poll: int, root: str) -> Iterator[pa.RecordBatch]:
        """The listing of a root that all attempts go by."""
        with self._reader(self._versions(root)[poll]) as reader:
            for i in range(reader.num_record_batches):
                yield reader.get_batch(i)

    def forget_before(self, poll: int) -> None:
        """Drop polls before ``poll``, whose batches are committed.  Their listings go when the next one
        of their root is written."""
        files, base = self._open()
        for kind in ("polls", "numbers"):
            for old in self._polls(files, base, kind):
                if old < poll:
                    files.delete_file(f"{base}/{kind}/{old}.json")

    def _forget_versions(self, root: str, previous: int) -> None:
        """Drop listings older than the one that was valid at ``previous``."""
        files, base = self._open()
        known = [poll for poll in self._versions(root) if poll <= previous]
        found = files.get_file_info(
            fs.FileSelector(self._folder(base, root), allow_not_found=True)
        )
        for info in found:
            if info.base_name.endswith(".arrow") and known:
                if int(info.base_name.split(".")[0]) < max(known):
                    files.delete_file(info.path)

    # Polling a root

    def poll_root(
        self,
        connector: Connector,
        max_retries: int,
        root: str,
        poll: int,
        previous: int | None,
        most: int | None = None,
        wanted: Wanted | None = None,
    ) -> tuple[int, bool]:
        """List a root and store what is new since the poll ``previous``; all of it if that is None.

        Gives the number of new slots and whether some were left out, because there were more than
        ``most``: the next poll finds those new again.  Where digests of all names agree with the
        stored listing, nothing is compared or written.
        """
        schema = arrow_schema(connector)
        listed = list_pages(connector, [root], max_retries, wanted)
        with HashedListing(listed, schema) as listing:
            versions = {} if previous is None else self._versions(root)
            before = [p for p in versions if p <= previous] if versions else []
            if not before:
                return self._store(listing, root, poll, None, most)
            with self._reader(versions[max(before)]) as reader:
                if reader.schema.metadata.get(DIGEST) == str(listing.digest).encode():
                    return 0, False
                found = self._store(listing, root, poll, StoredBuckets(reader), most)
        self._forget_versions(root, previous)
        return found

    def _store(
        self,
        listing: HashedListing,
        root: str,
        poll: int,
        known: StoredBuckets | None,
        most: int | None,
    ) -> tuple[int, bool]:
        new, cut = 0, False

        def marked() -> Iterator[pa.RecordBatch]:
            nonlocal new, cut
            for bucket, bits, rows in listing.buckets():
                if known is None:
                    fresh = pa.array([True] * rows.num_rows, pa.bool_())
                else:
                    held = pc.is_in(rows.column("name"), value_set=known.names(bucket, bits))
                    fresh = pc.invert(held)
                if most is not None:
                    rank = pc.cumulative_sum(fresh.cast(pa.int64()))
                    over = pc.and_(fresh, pc.greater(rank, most - new))
                    cut = cut or pc.any(over).as_py() or False
                    rows, fresh = rows.filter(pc.invert(over)), fresh.filter(pc.invert(over))
                new += pc.sum(fresh.cast(pa.int64())).as_py() or 0
                yield pa.RecordBatch.from_arrays([*rows.columns, fresh], schema=schema)

        # A listing that may be cut says no digest, so that the next poll compares names.
        digest = "" if most is not None and listing.rows > most else str(listing.digest)
        schema = listing.schema.append(pa.field(FRESH, pa.bool_()))
        schema = schema.with_metadata({DIGEST: digest.encode()})
        self.write_once(poll, root, schema, marked())
        # Another attempt may have published before.
        stored = sum(pc.sum(b.column(FRESH).cast(pa.int64())).as_py() or 0 for b in self.read(poll, root))
        return stored, cut
