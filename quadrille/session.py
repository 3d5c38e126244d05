"""Session helpers: scratch folder, derived sessions and shipping the package."""

from __future__ import annotations

import hashlib
import io
import uuid
import zipfile
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession

from .storage import open_filesystem, qualified

_shipped: set[tuple[str, str]] = set()
_listing: WeakKeyDictionary[SparkSession, SparkSession] = WeakKeyDictionary()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder all executors share (``spark.checkpoint.dir``)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
    return f"{root.rstrip('/')}/quadrille/{label}-{uuid.uuid4().hex}"


def listing_session(spark: SparkSession) -> SparkSession:
    """Session for queries that look at file names or footers but not at file contents.

    Spark packs files into tasks by their size.  Such queries do not read the contents,
    so the size limit per task is lifted: the number of tasks then follows the number
    of cores, not the number of bytes that lie in the dataset.  The limit is a session
    setting, and the user's session must keep its own.
    """
    derived = _listing.get(spark)
    if derived is None:
        derived = _listing[spark] = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            derived.conf.set(key, value)
    derived.conf.set("spark.sql.files.maxPartitionBytes", "1024t")
    return derived


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, as ``--py-files`` would.

    The archive goes to the shared scratch folder, once per application.
    """
    package = Path(__file__).resolve().parent
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            entry = zipfile.ZipInfo(str(source.relative_to(package.parent)))
            archive.writestr(entry, source.read_bytes())
    digest = hashlib.sha256(buffer.getvalue()).hexdigest()[:16]
    key = (spark.sparkContext.applicationId, digest)
    if key in _shipped:
        return
    folder = qualified(spark, scratch_path(spark, "package"))
    filesystem, inner = open_filesystem(folder)
    filesystem.create_dir(inner, recursive=True)
    name = f"quadrille_{digest}.zip"
    with filesystem.open_output_stream(f"{inner}/{name}") as target:
        target.write(buffer.getvalue())
    spark.sparkContext.addPyFile(f"{folder}/{name}")
    _shipped.add(key)


def ship_to_active() -> None:
    """``ship_package`` for functions that see columns only."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        ship_package(spark)
