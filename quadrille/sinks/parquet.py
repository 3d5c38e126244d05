"""Parquet sinks: part files, Hive partitions, clustering and compaction."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cells import DEFAULT_ZOOM
from ..names import columns
from ..operators.rows import with_cell
from ..operators.schema import check_partition_columns
from ..session import scratch_path
from ..sources.files import file_table, read_footers

DEFAULT_ROWS_PER_FILE = 300_000
#: Rows that are weighed before a write whose files have a size in bytes.
MEASURED_ROWS = 50_000
_TASK = "__task"


def rebalanced(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Bring rows of one partition folder together, in tasks of similar size.

    The rebalance hint lets Spark look at the shuffled sizes: small keys share a task
    and a key that holds a large part of the data is split over many tasks, each with
    a file of its own.  The target size is
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    """
    return df.hint("rebalance", *columns(keys))


def _write_plain(df: DataFrame, path: str) -> None:
    df.write.option("compression", "snappy").parquet(path)


def measured_row_bytes(
    df: DataFrame, write: Callable[[DataFrame, str], None] = _write_plain
) -> float | None:
    """Bytes that a row takes in a file; None for a table without rows.

    ``MEASURED_ROWS`` rows, the first that Spark gives, are written and weighed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "weighed")
    write(df.limit(MEASURED_ROWS).coalesce(1), path)
    files = file_table(spark, path)
    size = files.agg(F.sum("length")).first()[0]
    rows = read_footers(files).agg(F.sum("num_rows")).first()[0]
    return size / rows if rows else None


def rows_of_bytes(
    df: DataFrame,
    file_bytes: int | None,
    rows_per_file: int,
    write: Callable[[DataFrame, str], None] = _write_plain,
) -> int:
    """Rows of a file of about ``file_bytes``, where that is given."""
    if file_bytes is None:
        return rows_per_file
    if file_bytes <= 0:
        raise ValueError(f"file_bytes must be positive, not {file_bytes}.")
    each = measured_row_bytes(df, write)
    return max(int(file_bytes / each), 1) if each else rows_per_file


def write_parquet(
    df: DataFrame,
    path: str,
    partition_columns: Sequence[str] | str | None = None,
    rows_per_file: int = DEFAULT_ROWS_PER_FILE,
    mode: str = "append",
    file_bytes: int | None = None,
) -> str:
    """Write Snappy part files of at most ``rows_per_file`` rows, or of ``file_bytes``.

    With ``file_bytes`` the rows of a file follow from measured bytes per row, whatever
    ``rows_per_file`` is.  Writing to an existing dataset adds parts to it;
    ``mode="errorifexists"`` refuses and ``mode="overwrite"`` replaces.  Without partition
    columns there is no shuffle.
    """
    keys = check_partition_columns(df, partition_columns)
    rows_per_file = rows_of_bytes(df, file_bytes, rows_per_file)
    arranged = rebalanced(df, keys) if keys else df
    writer = (
        arranged.write.mode(mode)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", rows_per_file)
    )
    if keys:
        writer = writer.partitionBy(*keys)
    writer.parquet(path)
    return path


def cluster_by_cell(
    df: DataFrame,
    zoom: int = DEFAULT_ZOOM,
    geometry: str = "geometry",
    partitions: int | None = None,
) -> DataFrame:
    """Order a feature table along the grid, so that files hold neighbouring cells.

    A reader that filters on ``cell`` then skips most files and row groups by their
    minima and maxima.  The range boundaries are drawn over the cell and the task a row
    comes from.  A crowded cell, or a crowd of equal rows, is so divided over several
    tasks; and unlike a random number the task number is the same when a lost task is
    run again.
    """
    keyed = with_cell(df, zoom, geometry).withColumn(_TASK, F.spark_partition_id())
    if partitions is not None:
        ranged = keyed.repartitionByRange(partitions, "cell", _TASK)
    else:
        ranged = keyed.repartitionByRange("cell", _TASK)
    return ranged.sortWithinPartitions("cell").drop(_TASK)
