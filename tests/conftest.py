from __future__ import annotations

import gzip
import os
import sys
from datetime import UTC, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from quayline import build_session  # noqa: E402

FIVE = [f"LINE 00{i}" for i in range(1, 6)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def moment(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


class Folder:
    """A folder of slot files with chosen dates."""

    def __init__(self, path: Path) -> None:
        self.path = path
        path.mkdir(parents=True, exist_ok=True)

    def put(self, name: str, lines=None, date: str = "2016-12-01", packed: bool = False) -> None:
        content = lines if isinstance(lines, bytes) else "\n".join(
            lines if lines is not None else [f"{line} - {name}" for line in FIVE]
        ).encode()
        file = self.path / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(gzip.compress(content) if packed else content)
        stamp = moment(date).timestamp()
        os.utime(file, (stamp, stamp))


@pytest.fixture
def folder(tmp_path):
    return Folder(tmp_path / "in")
