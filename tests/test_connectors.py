"""Connector parameters, and remote protocols against stand-in clients."""

from __future__ import annotations

import errno
import ftplib
import io
import pickle
import os
import ssl
import stat
from datetime import UTC, datetime
from types import SimpleNamespace

import pytest
from pyarrow import fs

from quayline.sources.base import Slot
from quayline.sources.base import Fetcher
from quayline.sources.dcm import DcmConnector
from quayline.sources.files import FilesConnector
from quayline.sources.ftp import FtpConnector, ProxiedFtp
from quayline.sources.ftps import FtpsConnector
from quayline.sources.gcs import GcsConnector
from quayline.sources.location import as_file, open_location, read_bytes
from quayline.sources.sftp import SftpConnector

SERVER = {"host": "h", "directory": "d", "user": "u"}
GOOD = [
    (FilesConnector, {"path": "/x"}),
    (FtpConnector, SERVER),
    (FtpConnector, {**SERVER, "proxyHost": "p"}),
    (FtpsConnector, SERVER),
    (FtpsConnector, {**SERVER, "certFile": "c", "keyFile": "k", "caFile": "a"}),
    (SftpConnector, SERVER),
    (SftpConnector, {**SERVER, "privateKey": "k"}),
    (GcsConnector, {"bucket": "b"}),
    (DcmConnector, {"bucket": "b", "types": ("click",)}),
]
BAD = [
    (FilesConnector, {}),
    *[
        (cls, {**SERVER, **wrong})
        for cls in (FtpConnector, FtpsConnector, SftpConnector)
        for wrong in (
            {"host": ""}, {"host": None}, {"port": 0}, {"directory": ""}, {"directory": None},
            {"user": ""}, {"user": None},
        )
    ],
    *[
        (cls, {**SERVER, **wrong})
        for cls in (FtpConnector, FtpsConnector)
        for wrong in ({"defaultTimeout": 0}, {"dataTimeout": -1})
    ],
    (FtpConnector, {**SERVER, "proxyHost": ""}),
    (FtpConnector, {**SERVER, "proxyHost": "p", "activeMode": True}),
    (FtpsConnector, {**SERVER, "certFile": ""}),
    (FtpsConnector, {**SERVER, "caFile": ""}),
    (FtpsConnector, {**SERVER, "keyFile": "k"}),
    (SftpConnector, {**SERVER, "timeout": 0}),
    (SftpConnector, {**SERVER, "privateKey": ""}),
    (GcsConnector, {}),
    (GcsConnector, {"bucket": None}),
    (DcmConnector, {"bucket": ""}),
    (DcmConnector, {"bucket": "b", "types": ("CLICK",)}),
]


@pytest.mark.parametrize(("cls", "fields"), GOOD)
def test_good_parameters(cls, fields):
    connector = cls(**fields)
    assert cls.from_json(connector.to_json()).to_json() == connector.to_json()
    assert pickle.loads(pickle.dumps(connector)) == connector


@pytest.mark.parametrize(("cls", "fields"), BAD)
def test_bad_parameters(cls, fields):
    with pytest.raises(ValueError, match="must|needs|cannot|unknown"):
        cls(**fields)


def test_secrets_are_not_shown():
    for connector in (
        FtpConnector(**SERVER, password="hidden", proxyHost="p", proxyPassword="hidden"),
        FtpsConnector(**SERVER, password="hidden", keyPassword="hidden"),
        SftpConnector(**SERVER, password="hidden", privatePassword="hidden"),
        GcsConnector(
            bucket="b", access_token="hidden", tokenExpiration="2030-01-01T00:00:00+00:00"
        ),
    ):
        assert "hidden" not in repr(connector)
        assert "host='h'" in repr(connector) or "bucket='b'" in repr(connector)


def test_default_values():
    ftp, ftps, sftp = FtpConnector(**SERVER), FtpsConnector(**SERVER), SftpConnector(**SERVER)
    assert (ftp.port, ftp.defaultTimeout, ftp.dataTimeout) == (21, 120_000, 1_200_000)
    assert (ftps.port, ftps.defaultTimeout, ftps.dataTimeout) == (990, 120_000, 1_200_000)
    assert (sftp.port, sftp.timeout) == (22, 120_000)
    assert not ftp.activeMode


class FakeFtp:
    """What the connector uses of ``ftplib.FTP``, over a dict of files."""

    def __init__(self, files, folders=(), mlsd=True):
        self.files, self.folders, self.has_mlsd = files, folders, mlsd
        self.calls, self.closed = [], False

    def connect(self, host, port):
        self.calls.append(("connect", host, port))

    def login(self, user, password):
        if password != "right":
            raise ftplib.error_perm("530 Login incorrect")

    def set_pasv(self, on):
        self.calls.append(("pasv", on))

    def prot_p(self):
        self.calls.append(("prot_p",))

    def cwd(self, directory):
        if directory != "d":
            raise ftplib.error_perm("550 No such directory")

    def voidcmd(self, command):
        self.calls.append((command,))

    def voidresp(self):
        pass

    def mlsd(self, facts):
        if not self.has_mlsd:
            raise ftplib.error_perm("500 Unknown command")
        for name in self.folders:
            yield name, {"type": "dir", "modify": "20161201000000"}
        for name, (when, content) in self.files.items():
            yield name, {"type": "file", "modify": when, "size": str(len(content))}

    def nlst(self):
        return [*self.folders, *self.files]

    def size(self, name):
        if name in self.folders:
            raise ftplib.error_perm("550 Not a plain file")
        return len(self.files[name][1])

    def sendcmd(self, command):
        return f"213 {self.files[command.split(' ', 1)[1]][0]}"

    def transfercmd(self, command):
        name = command.removeprefix("RETR ")
        if name not in self.files:
            raise ftplib.error_perm("550 No such file")
        data = io.BytesIO(self.files[name][1])

        class Link:
            def recv(self, size):
                return data.read(min(size, 4))

            def __enter__(self):
                return self

            def __exit__(self, *_):
                pass

        return Link()

    def close(self):
        self.closed = True


FILES = {"a.txt": ("20161201000000", b"LINE 001\nLINE 002"), "b.txt": ("20161202010203.5", b"")}


def ftp_of(monkeypatch, cls, fake, **fields):
    monkeypatch.setattr(cls, "new_client", lambda self: fake)
    return cls(**{**SERVER, "password": "right", **fields})


@pytest.mark.parametrize("cls", [FtpConnector, FtpsConnector])
@pytest.mark.parametrize("mlsd", [True, False])
def test_ftp_listing(monkeypatch, cls, mlsd):
    fake = FakeFtp(FILES, folders=["sub"], mlsd=mlsd)
    connector = ftp_of(monkeypatch, cls, fake)
    assert list(connector.list("")) == [
        Slot("a.txt", datetime(2016, 12, 1, tzinfo=UTC), 17),
        Slot("b.txt", datetime(2016, 12, 2, 1, 2, 3, 500_000, tzinfo=UTC), 0),
    ]
    assert ("pasv", True) in fake.calls
    assert (("prot_p",) in fake.calls) == (cls is FtpsConnector)
    connector.close()
    assert fake.closed


@pytest.mark.parametrize("cls", [FtpConnector, FtpsConnector])
def test_ftp_fetch(monkeypatch, cls):
    connector = ftp_of(monkeypatch, cls, FakeFtp(FILES), activeMode=True)
    assert b"".join(connector.fetch("a.txt")) == FILES["a.txt"][1]
    assert ("TYPE I",) in connector.client().calls
    assert ("pasv", False) in connector.client().calls
    # A file that is gone is empty, unless that is asked to be an error.
    assert list(connector.fetch("gone.txt")) == []
    strict = ftp_of(monkeypatch, cls, FakeFtp(FILES), failOnMissing=True)
    with pytest.raises(ftplib.error_perm, match="550"):
        list(strict.fetch("gone.txt"))


def test_a_busy_file_is_tried_again(monkeypatch):
    fake, replies = FakeFtp(FILES), [ftplib.error_temp("450 File busy")]
    transfer = fake.transfercmd

    def busy(command):
        if replies:
            raise replies.pop()
        return transfer(command)

    fake.transfercmd = busy
    fetcher = Fetcher(ftp_of(monkeypatch, FtpConnector, fake), 1)
    assert b"".join(fetcher.chunks("a.txt")) == FILES["a.txt"][1]


def test_ftp_errors(monkeypatch):
    with pytest.raises(ftplib.error_perm, match="530"):
        list(ftp_of(monkeypatch, FtpConnector, FakeFtp(FILES), password="wrong").list(""))
    with pytest.raises(ftplib.error_perm, match="550"):
        list(ftp_of(monkeypatch, FtpConnector, FakeFtp(FILES), directory="other").list(""))


def test_ftp_client_kinds():
    assert type(FtpConnector(**SERVER).new_client()) is ftplib.FTP
    proxied = FtpConnector(**SERVER, proxyHost="p", proxyPort=8080, proxyUser="x").new_client()
    assert isinstance(proxied, ProxiedFtp)
    assert isinstance(FtpsConnector(**SERVER).new_client(), ftplib.FTP_TLS)


class FakeSocket:
    def __init__(self, reply):
        self.sent, self.reply, self.closed = b"", io.BytesIO(reply), False

    def sendall(self, data):
        self.sent += data

    def recv(self, size):
        return self.reply.read(size)

    def close(self):
        self.closed = True


def test_proxy_tunnel(monkeypatch):
    links = [
        FakeSocket(b"HTTP/1.1 200 OK\r\nVia: p\r\n\r\n220 ready"),
        FakeSocket(b"HTTP/1.1 407 Proxy Authentication Required\r\n\r\n"),
    ]
    goes_to = []
    monkeypatch.setattr(
        "quayline.sources.ftp.socket.create_connection",
        lambda address, timeout: goes_to.append(address) or links[len(goes_to) - 1],
    )
    client = ProxiedFtp(("p", 8080), ("x", "y"), 5)
    link = client.tunnel("h", 21)
    assert goes_to == [("p", 8080)]
    assert link.sent.startswith(b"CONNECT h:21 HTTP/1.1\r\n")
    assert b"Proxy-Authorization: Basic eDp5\r\n" in link.sent
    assert link.recv(100) == b"220 ready"  # nothing of the server's greeting is lost
    with pytest.raises(OSError, match="407"):
        client.tunnel("h", 21)
    assert links[1].closed


def test_ftps_checks_the_server_unless_told_not_to():
    context = FtpsConnector(**SERVER).context()
    assert context.verify_mode == ssl.CERT_REQUIRED
    assert context.check_hostname
    assert FtpsConnector(**SERVER, verify=False).context().verify_mode == ssl.CERT_NONE
    with pytest.raises(OSError):
        FtpsConnector(**SERVER, caFile="/no/such.pem").context()
    with pytest.raises(OSError):
        FtpsConnector(**SERVER, certFile="/no/such.pem").context()


class FakeSftp:
    def __init__(self, files):
        self.files, self.directory = files, None

    def chdir(self, directory):
        if directory != "d":
            raise FileNotFoundError(directory)
        self.directory = directory

    def listdir_attr(self, path):
        return [
            SimpleNamespace(filename=name, st_mode=mode, st_mtime=1480550400, st_size=len(content or b""))
            for name, (mode, content) in self.files.items()
        ]

    def open(self, name, mode):
        if name not in self.files:
            raise FileNotFoundError(name)
        content = self.files[name][1]
        if content is None:
            raise PermissionError(name)
        return io.BytesIO(content)


REMOTE = {
    "a.txt": (stat.S_IFREG | 0o644, b"LINE 001"),
    "sub": (stat.S_IFDIR | 0o755, b""),
    "link": (stat.S_IFLNK | 0o777, b""),
    "locked.txt": (stat.S_IFREG, None),
}


def sftp_of(monkeypatch, **fields):
    link = SimpleNamespace(open_sftp=lambda: FakeSftp(REMOTE), close=lambda: None)
    monkeypatch.setattr(SftpConnector, "connect", lambda self: link)
    return SftpConnector(**{**SERVER, **fields})


def test_sftp(monkeypatch):
    connector = sftp_of(monkeypatch)
    assert list(connector.list("")) == [Slot("a.txt", datetime(2016, 12, 1, tzinfo=UTC), 8)]
    assert b"".join(connector.fetch("a.txt")) == b"LINE 001"
    # Unlike FTP, a file that is gone is an error.
    with pytest.raises(FileNotFoundError):
        list(connector.fetch("gone.txt"))
    with pytest.raises(FileNotFoundError):
        list(sftp_of(monkeypatch, directory="other").list(""))
    connector.close()


def test_sftp_lost_connection_is_a_failed_listing(monkeypatch):
    connector = sftp_of(monkeypatch)
    channel = connector.client()

    def lost(name, mode):
        raise OSError("Socket is closed")

    monkeypatch.setattr(channel, "open", lost)
    with pytest.raises(OSError, match="closed"):
        list(connector.list(""))
    for number, found in ((errno.EACCES, 0), (errno.ENOENT, 0)):

        def refused(name, mode, number=number):
            raise OSError(number, "refused")

        monkeypatch.setattr(channel, "open", refused)
        assert len(list(connector.list(""))) == found


def test_sftp_server_that_sends_no_mode(monkeypatch):
    connector = sftp_of(monkeypatch)
    channel = connector.client()
    whole = {e.filename: e for e in channel.listdir_attr(".")}
    bare = [SimpleNamespace(filename=n, st_mode=None, st_mtime=None, st_size=None) for n in whole]
    monkeypatch.setattr(channel, "listdir_attr", lambda path: bare)
    channel.lstat = lambda name: whole[name]
    assert [s.name for s in connector.list("")] == ["a.txt"]


def test_keys_by_url(tmp_path):
    (tmp_path / "key").write_bytes(b"secret")
    with as_file(str(tmp_path / "key")) as path:
        assert path == str(tmp_path / "key")
    with as_file(f"file://{tmp_path}/key") as path:
        assert path != str(tmp_path / "key")
        with open(path, "rb") as file:
            assert file.read() == b"secret"
        assert os.stat(path).st_mode & 0o077 == 0
    assert not os.path.exists(path)
    with as_file(None) as path:
        assert path is None
    assert read_bytes(f"name://{tmp_path}/key") == b"secret"
    with pytest.raises(ValueError, match="unsupported scheme 'aaa'"):
        open_location("aaa:///FOO.txt")


def test_bucket_token():
    """The client itself, which wants a token's end with it."""
    connector = GcsConnector(
        bucket="b", access_token="t", tokenExpiration="2030-01-01T00:00:00+00:00"
    )
    assert isinstance(connector.file_system()[0], fs.GcsFileSystem)
    for fields in ({"access_token": "t"}, {"tokenExpiration": "2030-01-01T00:00:00+00:00"},
                   {"access_token": "t", "tokenExpiration": "2030-01-01T00:00:00"}):
        with pytest.raises(ValueError, match="together|zone"):
            GcsConnector(bucket="b", **fields)


def test_sftp_without_its_library():
    try:
        import paramiko  # noqa: F401
    except ImportError:
        with pytest.raises(ImportError, match="paramiko"):
            SftpConnector(**SERVER).connect()


def test_bucket_listing(monkeypatch, folder):
    """A local tree stands in for the bucket."""
    folder.put("FILE_B.txt", date="2019-12-27 01:00:00")
    folder.put("year/FILE_A.txt", [b"x"][0], date="2019-12-27")
    folder.put("_FILE_C.txt", date="2019-12-27 02:00:00")
    monkeypatch.setattr(
        GcsConnector,
        "file_system",
        lambda self: (fs.SubTreeFileSystem(str(folder.path.parent), fs.LocalFileSystem()), self.bucket),
    )
    connector = GcsConnector(bucket=folder.path.name)
    assert connector.roots() == ["", "year"]
    found = {s.name: s.date for root in connector.roots() for s in connector.list(root)}
    assert found == {
        "FILE_B.txt": datetime(2019, 12, 27, 1, tzinfo=UTC),
        "year/FILE_A.txt": datetime(2019, 12, 27, tzinfo=UTC),
        "_FILE_C.txt": datetime(2019, 12, 27, 2, tzinfo=UTC),
    }
    assert b"".join(connector.fetch("year/FILE_A.txt")) == b"x"
