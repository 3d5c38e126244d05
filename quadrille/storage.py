"""Paths and file systems, for the few files that Spark itself does not open."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """Path with its scheme; a bare path lies in the cluster's default file system.

    Spark completes the path while it reports that something below it does not exist.
    """
    if path.startswith("file:") or "://" in path:
        return path
    absent = f"/absent-{uuid.uuid4().hex}"
    try:
        spark.read.format("binaryFile").load(path.rstrip("/") + absent)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return error.getMessageParameters()["path"].removesuffix(absent)
    return path


def open_filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow filesystem and path inside it for a path as Spark writes it."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    authority, slash, inner = rest.removeprefix("//").partition("/")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    filesystem, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return filesystem, base.rstrip("/") + slash + inner
