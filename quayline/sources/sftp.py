"""SFTP servers.

Needs ``paramiko`` on the executors; it is not part of this environment, so the client is exercised
by tests through an injected stand-in, never against a real server.
"""

from __future__ import annotations

import errno
import stat
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from typing import Any

from quayline.sources.base import Connector, Slot, require, secret
from quayline.sources.location import as_file

CHUNK_BYTES = 1 << 20


@dataclass(frozen=True, repr=False)
class SftpConnector(Connector):
    """Every plain, readable file of ``directory`` is a slot dated by its modification time.

    Folders, links and files that cannot be opened are left out.  Log in by ``password`` or by
    ``privateKey`` (optionally encrypted).  The server must be in ``knownHosts`` or in the user's own
    list.  Key and list are URLs that every executor can read, or paths on every executor.  A file
    that is gone when fetched is an error.
    """

    host: str = ""
    port: int = 22
    directory: str = ""
    user: str = ""
    password: str | None = secret(None)
    privateKey: str | None = None
    privatePassword: str | None = secret(None)
    knownHosts: str | None = None
    timeout: int = 120_000

    def validate(self) -> None:
        require(
            host=self.host,
            port=self.port,
            directory=self.directory,
            user=self.user,
            timeout=self.timeout,
        )
        for name in ("privateKey", "knownHosts"):
            if getattr(self, name) is not None:
                require(**{name: getattr(self, name)})

    def connect(self) -> Any:
        try:
            import paramiko
        except ImportError as error:
            raise ImportError("SFTP needs the paramiko package on driver and executors") from error
        link = paramiko.SSHClient()
        link.load_system_host_keys()
        with as_file(self.knownHosts) as known:
            if known:
                link.load_host_keys(known)
        link.set_missing_host_key_policy(paramiko.RejectPolicy())
        with as_file(self.privateKey) as key:
            link.connect(
                self.host,
                self.port,
                username=self.user,
                password=self.password,
                key_filename=key,
                passphrase=self.privatePassword,
                timeout=self.timeout / 1000,
                look_for_keys=False,
                allow_agent=False,
            )
        return link

    def client(self) -> Any:
        """The SFTP channel of this copy, in ``directory``."""
        channel = self.__dict__.get("_channel")
        if channel is None:
            link = self.connect()
            object.__setattr__(self, "_link", link)
            channel = link.open_sftp()
            object.__setattr__(self, "_channel", channel)
            channel.chdir(self.directory)
        return channel

    def close(self) -> None:
        self.__dict__.pop("_channel", None)
        link = self.__dict__.pop("_link", None)
        if link is not None:
            link.close()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_link", "_channel")}

    def list(self, root: str) -> Iterable[Slot]:
        channel = self.client()
        for entry in channel.listdir_attr("."):
            if entry.st_mode is None:
                # The server does not say what it is: ask about this one.
                entry, name = channel.lstat(entry.filename), entry.filename
            else:
                name = entry.filename
            if not stat.S_ISREG(entry.st_mode or 0) or not self._opens(channel, name):
                continue
            stamp = entry.st_mtime
            date = None if stamp is None else datetime.fromtimestamp(stamp, UTC)
            yield Slot(name, date, entry.st_size)

    @staticmethod
    def _opens(channel: Any, name: str) -> bool:
        try:
            channel.open(name, "rb").close()
        except (PermissionError, FileNotFoundError):
            return False
        except OSError as error:
            # The client has no class of its own for these two replies of the server.  Anything
            # else, such as a lost connection, is a failed listing.
            if error.errno in (errno.EACCES, errno.ENOENT):
                return False
            raise
        return True

    def fetch(self, name: str) -> Iterator[bytes]:
        with self.client().open(name, "rb") as source:
            while chunk := source.read(CHUNK_BYTES):
                yield chunk
