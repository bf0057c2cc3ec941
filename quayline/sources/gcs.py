"""Objects of a Google Cloud Storage bucket.

Uses Arrow's own client, so no further library is needed.  Objects are dated by the time Arrow
reports, the last modification; objects there are replaced whole, so it is the creation of the
current version.  Not run against the service here: no network.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyarrow import fs

from quayline.sources.base import require, secret
from quayline.sources.files import FilesConnector


@dataclass(frozen=True, repr=False)
class GcsConnector(FilesConnector):
    """Every object of ``bucket`` is a slot, named by its whole key.

    Credentials: the machine's default ones, or an ``access_token`` with its ``tokenExpiration`` (an
    ISO 8601 time with a zone; the client asks for both), or none (``anonymous``).
    """

    bucket: str = ""
    access_token: str | None = secret(None)
    tokenExpiration: str | None = None
    anonymous: bool = False
    recursive: bool = True

    def validate(self) -> None:
        require(bucket=self.bucket, rootDepth=self.rootDepth, splitRows=self.splitRows)
        if (self.access_token is None) != (self.tokenExpiration is None):
            raise ValueError("access_token and tokenExpiration go together")
        if self.tokenExpiration is not None:
            if datetime.fromisoformat(self.tokenExpiration).tzinfo is None:
                raise ValueError("tokenExpiration needs a zone")
            if self.anonymous:
                raise ValueError("anonymous access takes no access_token")

    def file_system(self) -> tuple[fs.FileSystem, str]:
        options = {"anonymous": True} if self.anonymous else {}
        if self.access_token:
            options["access_token"] = self.access_token
            options["credential_token_expiration"] = datetime.fromisoformat(self.tokenExpiration)
        return fs.GcsFileSystem(**options), self.bucket.removeprefix("gs://").rstrip("/")
