"""File systems: Hadoop's on the driver, pyarrow's in the tasks."""

from __future__ import annotations

import re
from urllib.parse import quote

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path with its scheme."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = own.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return store, store.makeQualified(own)


def opened(path: str):
    """pyarrow's file system of a path as Spark spells it (``/a b``, ``file:/a b``, ``hdfs://host/a``, ``s3a://bucket/a``), and the path in it."""
    from pyarrow import fs

    scheme, rest = re.match(r"(?:(\w+):)?(.*)", path, re.DOTALL).groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + quote(rest))
