"""Which file system a URL names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# URL patterns, matched against the whole URL.
HDFS_URL = r"^hdfs://[.:\w]+[-_/.\w*]+\z"
LOCAL_URL = r"^name://[-_/.\w*]+\z"
OTHER_URL = r"^\w+://.*\z"


def url_kind(url: Column) -> Column:
    """``hdfs``, ``local`` or ``unsupported``; a URL without a scheme is local."""
    return (
        F.when(url.rlike(HDFS_URL), "hdfs")
        .when(url.rlike(LOCAL_URL), "local")
        .when(url.rlike(OTHER_URL), "unsupported")
        .when(url.isNotNull(), "local")
    )
