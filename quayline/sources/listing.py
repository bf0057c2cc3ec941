"""Listings: made in tasks, in pages, whole or not at all."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa

from quayline.sources.base import Connector, retrying
from quayline.sources.wanted import Wanted

PAGE_ROWS = 20_000
LISTED = (("name", "string"), ("date", "timestamp"), ("length", "long"))
# Kinds of columns a connector may add.  Spark's session zone does not matter: instants are in UTC.
ARROW = {
    "string": pa.string(),
    "timestamp": pa.timestamp("us", "UTC"),
    "long": pa.int64(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
}


def catalogue_schema(connector: type[Connector] | Connector) -> str:
    """The columns of a connector's catalogue, as DDL."""
    return ", ".join(f"`{name}` {kind}" for name, kind in (*LISTED, *connector.extra))


def arrow_schema(connector: Connector) -> pa.Schema:
    return pa.schema([(name, ARROW[kind]) for name, kind in (*LISTED, *connector.extra)])


def pages(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    source = iter(rows)
    while page := list(islice(source, PAGE_ROWS)):
        columns = zip(*page, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )


def list_roots(
    template: Connector, max_retries: int, wanted: Wanted | None = None, split: bool = False
) -> list[str]:
    """The parts of the collection that may hold wanted slots, by a new copy of the connector per
    attempt.  ``split`` cuts those that hold too much for one task."""

    def attempt() -> list[str]:
        connector = template.fresh()
        try:
            roots = connector.roots() if wanted is None else connector.wanted_roots(wanted)
            return [part for root in roots for part in (connector.split(root) if split else [root])]
        finally:
            connector.close()

    return retrying(attempt, max_retries, f"listing parts of {template!r}")


def list_pages(
    template: Connector, roots: list[str], max_retries: int, wanted: Wanted | None = None
) -> Iterator[pa.RecordBatch]:
    """The refined listing of ``roots``, in pages, without what is not wanted.

    Pages leave only when the whole listing is there: until then they wait in a file of the task, not
    in memory, so that an attempt that fails half-way leaves nothing behind.
    """
    schema = arrow_schema(template)

    def attempt(root: str):
        connector = template.fresh()
        spool = tempfile.TemporaryFile()  # noqa: SIM115
        try:
            with pa.ipc.new_stream(spool, schema) as out:
                refined = (connector.refine(slot) for slot in connector.list(root))
                rows = (row for row in refined if row is not None)
                if wanted is not None:
                    rows = (row for row in rows if wanted.row(row, schema.names))
                for page in pages(rows, schema):
                    out.write_batch(page)
        except BaseException:
            spool.close()
            raise
        finally:
            connector.close()
        spool.seek(0)
        return spool

    spools = []
    try:
        for root in roots:
            what = f"listing {root or 'slots'} of {template!r}"
            spools.append(retrying(lambda root=root: attempt(root), max_retries, what))
        for spool in spools:
            yield from pa.ipc.open_stream(spool)
    finally:
        for spool in spools:
            spool.close()
