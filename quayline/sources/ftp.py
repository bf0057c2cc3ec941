"""FTP servers, on the standard library's client.

No server may be started where this was written: the client is exercised by tests through an
injected stand-in, never against a real server.
"""

from __future__ import annotations

import base64
import ftplib
import socket
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

from quayline.sources.base import Connector, Slot, require, secret

CHUNK_BYTES = 1 << 20

# The reply that a file is not there, or not to be had, and those to unknown commands.
# 450 (busy) is not among them: it passes, and is tried again.
NO_SUCH_FILE = "550"
UNKNOWN_COMMAND = ("500", "501", "502", "504")


class ProxiedFtp(ftplib.FTP):
    """Control and data connections through an HTTP proxy's CONNECT."""

    def __init__(self, proxy: tuple[str, int], login: tuple[str, str] | None, timeout: float):
        super().__init__(timeout=timeout)
        self._proxy = proxy
        self._proxy_login = login

    def tunnel(self, host: str, port: int) -> socket.socket:
        link = socket.create_connection(self._proxy, self.timeout)
        lines = [f"CONNECT {host}:{port} HTTP/1.1", f"Host: {host}:{port}"]
        if self._proxy_login:
            token = base64.b64encode(":".join(self._proxy_login).encode()).decode()
            lines.append(f"Proxy-Authorization: Basic {token}")
        link.sendall("\r\n".join([*lines, "", ""]).encode())
        reply = b""
        # Byte by byte: what follows the blank line already belongs to the server.
        while not reply.endswith(b"\r\n\r\n"):
            byte = link.recv(1)
            if not byte:
                break
            reply += byte
        status = reply.split(b" ", 2)
        if len(status) < 2 or status[1] != b"200":
            link.close()
            raise OSError(f"proxy refused {host}:{port}: {reply[:80]!r}")
        return link

    def connect(self, host="", port=0, timeout=-999, source_address=None):  # noqa: ANN001, ANN201
        self.host, self.port = host, port
        self.sock = self.tunnel(host, port)
        self.af = self.sock.family
        self.file = self.sock.makefile("r", encoding=self.encoding)
        self.welcome = self.getresp()
        return self.welcome

    def ntransfercmd(self, cmd, rest=None):  # noqa: ANN001, ANN201
        link = self.tunnel(*self.makepasv())
        try:
            if rest is not None:
                self.sendcmd(f"REST {rest}")
            reply = self.sendcmd(cmd)
            if reply.startswith("2"):
                reply = self.getresp()
            if not reply.startswith("1"):
                raise ftplib.error_reply(reply)
        except BaseException:
            link.close()
            raise
        return link, None


@dataclass(frozen=True, repr=False)
class FtpConnector(Connector):
    """Every plain file of ``directory`` is a slot dated by its modification time.

    Timeouts are in milliseconds.  A file that is gone when it is fetched has no content; servers
    give the same reply for a file that may not be read, so ``failOnMissing`` makes it an error.
    """

    host: str = ""
    port: int = 21
    directory: str = ""
    user: str = ""
    password: str | None = secret(None)
    defaultTimeout: int = 120_000
    dataTimeout: int = 1_200_000
    activeMode: bool = False
    failOnMissing: bool = False
    proxyHost: str | None = None
    proxyPort: int = 80
    proxyUser: str | None = None
    proxyPassword: str | None = secret(None)

    def validate(self) -> None:
        require(
            host=self.host,
            port=self.port,
            directory=self.directory,
            user=self.user,
            defaultTimeout=self.defaultTimeout,
            dataTimeout=self.dataTimeout,
        )
        if self.proxyHost is not None:
            require(proxyHost=self.proxyHost, proxyPort=self.proxyPort)
            if self.activeMode:
                raise ValueError("activeMode cannot go through a proxy")

    def new_client(self) -> ftplib.FTP:
        timeout = self.defaultTimeout / 1000
        if self.proxyHost is None:
            return ftplib.FTP(timeout=timeout)
        login = (self.proxyUser, self.proxyPassword or "") if self.proxyUser else None
        return ProxiedFtp((self.proxyHost, self.proxyPort), login, timeout)

    def secure(self, client: ftplib.FTP) -> None:
        """Protect the session after login; plain FTP does not."""

    def client(self) -> ftplib.FTP:
        """The connected client of this copy, in ``directory``."""
        client = self.__dict__.get("_client")
        if client is None:
            client = self.new_client()
            object.__setattr__(self, "_client", client)
            client.connect(self.host, self.port)
            client.login(self.user, self.password or "")
            self.secure(client)
            client.set_pasv(not self.activeMode)
            client.timeout = self.dataTimeout / 1000
            client.cwd(self.directory)
        return client

    def close(self) -> None:
        client = self.__dict__.pop("_client", None)
        if client is not None:
            client.close()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_client"}

    def list(self, root: str) -> Iterable[Slot]:
        client = self.client()
        try:
            entries = list(client.mlsd(facts=["type", "modify", "size"]))
        except ftplib.error_perm as error:
            if not str(error).startswith(UNKNOWN_COMMAND):
                raise
            return self._list_by_name(client)
        return [
            Slot(name, _moment(facts.get("modify")), _size(facts.get("size")))
            for name, facts in entries
            if facts.get("type", "").lower() == "file"
        ]

    def _list_by_name(self, client: ftplib.FTP) -> list[Slot]:
        """For servers without MLSD: what has a modification time and a size is a plain file."""
        client.voidcmd("TYPE I")
        slots = []
        for name in client.nlst():
            try:
                size = client.size(name)
                stamp = client.sendcmd(f"MDTM {name}").split(" ", 1)[1]
            except ftplib.error_perm as error:
                if str(error).startswith(NO_SUCH_FILE):
                    continue  # a folder
                raise
            slots.append(Slot(name.rsplit("/", 1)[-1], _moment(stamp), size))
        return slots

    def fetch(self, name: str) -> Iterator[bytes]:
        client = self.client()
        client.voidcmd("TYPE I")
        try:
            link = client.transfercmd(f"RETR {name}")
        except ftplib.error_perm as error:
            if str(error).startswith(NO_SUCH_FILE) and not self.failOnMissing:
                return
            raise
        with link:
            while chunk := link.recv(CHUNK_BYTES):
                yield chunk
        client.voidresp()


def _moment(stamp: str | None) -> datetime | None:
    """``YYYYMMDDHHMMSS[.fff]``, always UTC in FTP."""
    if not stamp:
        return None
    whole, _, part = stamp.strip().partition(".")
    moment = datetime.strptime(whole, "%Y%m%d%H%M%S").replace(tzinfo=UTC)
    return moment.replace(microsecond=int(part[:6].ljust(6, "0"))) if part else moment


def _size(text: str | None) -> int | None:
    return int(text) if text else None
