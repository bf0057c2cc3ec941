"""FTP over TLS (explicit), with optional client certificate and own trusted authorities."""

from __future__ import annotations

import ftplib
import ssl
from dataclasses import dataclass

from quayline.sources.base import require, secret
from quayline.sources.ftp import FtpConnector
from quayline.sources.location import as_file, read_bytes


@dataclass(frozen=True, repr=False)
class FtpsConnector(FtpConnector):
    """As FTP, with both control and data connection encrypted.

    ``certFile`` / ``keyFile`` (PEM) identify the client; ``caFile`` replaces the system's
    authorities for checking the server.  All three are URLs that every executor can read, such as
    ``hdfs://`` ones, or paths on every executor.  ``verify`` off accepts any server.
    """

    port: int = 990
    certFile: str | None = None
    keyFile: str | None = None
    keyPassword: str | None = secret(None)
    caFile: str | None = None
    verify: bool = True

    def validate(self) -> None:
        super().validate()
        if self.proxyHost is not None:
            raise ValueError("an HTTP proxy is only supported for plain FTP")
        for name in ("certFile", "keyFile", "caFile"):
            if getattr(self, name) is not None:
                require(**{name: getattr(self, name)})
        if self.keyFile is not None and self.certFile is None:
            raise ValueError("keyFile needs certFile")

    def context(self) -> ssl.SSLContext:
        authorities = None if self.caFile is None else read_bytes(self.caFile).decode("ascii")
        context = ssl.create_default_context(cadata=authorities)
        if not self.verify:
            context.check_hostname = False
            context.verify_mode = ssl.CERT_NONE
        if self.certFile is not None:
            with as_file(self.certFile) as certificate, as_file(self.keyFile) as key:
                context.load_cert_chain(certificate, key, self.keyPassword)
        return context

    def new_client(self) -> ftplib.FTP:
        return ftplib.FTP_TLS(timeout=self.defaultTimeout / 1000, context=self.context())

    def secure(self, client: ftplib.FTP) -> None:
        client.prot_p()  # sends PBSZ 0 and PROT P
