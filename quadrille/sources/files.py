"""File-level view of a dataset: part files, Hive partitions and Parquet footers.

The file table is a Spark scan that reads names only.  Listing runs inside Spark (a
parallel job for large trees), and everything derived from it is a DataFrame.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from posixpath import normpath

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import listing_session, ship_package
from ..storage import open_filesystem

# The folder name of a null partition value, and a partition segment.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
SEGMENT = r"([^/=]+=[^/]*)/"

_FOOTER_READERS = 16


def file_table(spark: SparkSession, path: str) -> DataFrame:
    """One row per Parquet file: ``path`` and ``length``; only file status is read."""
    reader = (
        listing_session(spark)
        .read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
    )
    try:
        return reader.load(path).select("path", "length")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Cannot locate the input path {path}.") from None
        raise


def list_part_files(
    spark: SparkSession, path: str, contains: list[str] | None = None
) -> DataFrame:
    """Part files of a dataset whose path contains all the given pieces of text.

    Raises ``ValueError`` when the path is missing, when pieces are asked of a single
    file, or when no part file is left.
    """
    if contains is not None and not isinstance(contains, list):
        raise ValueError("parquet_partitions must be a list")
    try:
        files = file_table(spark, path)
    except FileNotFoundError as error:
        raise ValueError(f"{error} It may be misspelt or not mounted here.") from None
    first = files.select("path").first()
    if contains and first and first["path"].endswith("/" + path.strip("/")):
        raise ValueError(
            f"{path} is one file, for which you cannot specify a parquet partition."
        )
    for piece in contains or []:
        files = files.where(F.col("path").contains(piece))
    if contains:
        first = files.select("path").first()
    if first is None:
        raise ValueError(
            f"No Parquet file lies below {path}"
            + (f" with {contains} in its path." if contains else ".")
        )
    return files


# --- Hive partitions --------------------------------------------------------------


def _root_length(first: str, path: str) -> int:
    """Length of the dataset root inside a file path as Spark writes it.

    The scheme may be written in several ways, so the root is found by its own name.
    Zero when ``path`` is the file itself.
    """
    inner = normpath(path.split(":", 1)[-1]).strip("/")
    at = first.find(f"/{inner}/")
    return at + 1 + len(inner) if at >= 0 else len(first)


def _root_end(files: DataFrame, path: str) -> tuple[int, str]:
    """Length of the dataset root in the paths of a file table, and one path below it."""
    first = files.select("path").first()
    if first is None:
        return 0, ""
    end = _root_length(first["path"], path)
    return end, first["path"][end:]


def partition_keys(
    spark: SparkSession, path: str, files: DataFrame | None = None
) -> list[str]:
    """Partition column names, outermost first; empty when not partitioned.

    ``files`` is the file table of the path, when the caller has listed it already.  All
    paths are looked at.
    """
    files = files or file_table(spark, path)
    keys = _key_list(_root_end(files, path)[0])
    return _one_nesting([row[0] for row in files.select(keys).distinct().collect()])


def segments(end: int) -> Column:
    """The ``key=value`` folders of a path below the root, which ends at ``end``."""
    below = F.substring(F.col("path"), F.lit(end + 1), F.length("path"))
    return F.regexp_extract_all(below, F.lit(SEGMENT), F.lit(1))


def _key_list(end: int) -> Column:
    return F.transform(segments(end), lambda s: F.substring_index(s, "=", 1))


def _one_nesting(lists: list[list[str]]) -> list[str]:
    """The longest list of keys, of which all others must be the beginning."""
    keys = max(lists, key=len, default=[])
    for other in lists:
        if other != keys[: len(other)]:
            raise ValueError(f"Partitions are nested as {keys} and as {other}.")
    return keys


@dataclass(frozen=True)
class Layout:
    """Partition keys of a dataset and the different schemas of its files."""

    keys: list[str]
    schemas: list[pa.Schema]


def dataset_layout(
    spark: SparkSession, path: str, files: DataFrame | None = None
) -> Layout:
    """Layout from the names and footers of all files, in one pass over them.

    ``files`` is the part of the file table that counts, all of it by default.  What
    reaches the driver are the different combinations, not the files.
    """
    files = files or file_table(spark, path)
    return layout_of(read_footers(files), _root_end(files, path)[0])


def root_length(files: DataFrame, path: str) -> int:
    """Length of the dataset root in the paths of a file table."""
    return _root_end(files, path)[0]


def layout_of(footers: DataFrame, end: int) -> Layout:
    """Layout of the files whose footers are given; their root ends at ``end``."""
    found = footers.select(_key_list(end).alias("keys"), "arrow_schema")
    rows = found.distinct().collect()
    schemas = dict.fromkeys(bytes(row["arrow_schema"]) for row in rows)
    return Layout(
        _one_nesting([row["keys"] for row in rows]),
        [pa.ipc.read_schema(pa.py_buffer(schema)) for schema in schemas],
    )


def segment_value(segment: Column) -> Column:
    """Value of a ``key=value`` folder name: unescaped, null for the null folder."""
    text = F.substring(segment, F.instr(segment, "=") + 1, F.length(segment))
    unescaped = F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.when(text != NULL_PARTITION, F.coalesce(unescaped, text))


def _depth(names: list[str]) -> Column:
    return sum((F.col(n).isNotNull().cast("int") for n in names), F.lit(0))


def list_partitions(
    spark: SparkSession, path: str, all_levels: bool = True, typed: bool = True
) -> DataFrame:
    """Distinct partitions of a dataset, with all their prefix levels or without.

    Columns: ``level`` (number of keys set), ``partition`` (the folder path as written,
    e.g. ``year=2023/month=01``) and one column per key.  With ``typed`` a key whose
    values are all digits becomes a ``decimal(38,0)``, so ``01`` reads as 1; a key with
    a longer value, which no number type holds, stays text.  Keys below the level
    are null.  Sorted by the path, a folder before those inside it.  Empty, without key
    columns, when the dataset is not partitioned.
    """
    files = file_table(spark, path)
    end = _root_end(files, path)[0]
    keys = partition_keys(spark, path, files)
    if not keys:
        return files.where(F.lit(False)).select(
            F.lit(0).alias("level"), F.lit("").alias("partition")
        )
    names = [f"segment_{i}" for i in range(len(keys))]
    folders = files.select(segments(end).alias("segments")).select(
        *[F.get("segments", F.lit(i)).alias(n) for i, n in enumerate(names)]
    )
    if all_levels:
        leaves = folders.rollup(*names).agg(F.grouping_id().alias("unset"))
        leaves = leaves.where(F.col("unset") < (1 << len(keys)) - 1)
        # a folder that ends above the last key is listed at its own level
        leaves = leaves.drop("unset").distinct().where(F.coalesce(*names).isNotNull())
        level = _depth(names)
    else:
        leaves = folders.distinct()
        level = _depth(names)
    values = {k: segment_value(F.col(n)) for k, n in zip(keys, names)}
    if typed:
        numeric = folders.agg(
            *[F.bool_and(v.rlike("^[0-9]{1,38}$")).alias(k) for k, v in values.items()]
        ).first()
        values = {
            k: v.cast("decimal(38,0)") if numeric[k] else v for k, v in values.items()
        }
    return leaves.select(
        level.cast("int").alias("level"),
        F.concat_ws("/", *names).alias("partition"),
        *[v.alias(k) for k, v in values.items()],
    ).orderBy("partition")


# --- footers ----------------------------------------------------------------------


def read_footers(files: DataFrame) -> DataFrame:
    """Footer facts of each file: ``path``, ``num_rows``, ``geo``, ``arrow_schema``.

    Only footers are read, on the executors, several at a time per task because the
    time goes into waiting for storage.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def footer(path: str) -> dict:
            filesystem, inner = open_filesystem(path)
            with filesystem.open_input_file(inner) as source:
                # Spark's timestamps are stored in a form that looks like nanoseconds
                facts = pq.ParquetFile(source, coerce_int96_timestamp_unit="us")
                geo = (facts.metadata.metadata or {}).get(b"geo")
                return {
                    "path": path,
                    "num_rows": facts.metadata.num_rows,
                    "geo": geo.decode("utf-8") if geo else None,
                    "arrow_schema": facts.schema_arrow.remove_metadata()
                    .serialize()
                    .to_pybytes(),
                }

        with ThreadPoolExecutor(_FOOTER_READERS) as pool:
            for batch in batches:
                rows = list(pool.map(footer, batch.column(0).to_pylist()))
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema(
        [
            ("path", pa.string()),
            ("num_rows", pa.int64()),
            ("geo", pa.string()),
            ("arrow_schema", pa.binary()),
        ]
    )
    ship_package(files.sparkSession)
    return files.select("path").mapInArrow(
        read, "path string, num_rows bigint, geo string, arrow_schema binary"
    )
