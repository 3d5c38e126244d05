"""Parquet scans with Hive partitions."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from ..names import column
from .files import (
    NULL_PARTITION,
    Layout,
    dataset_layout,
    file_table,
    list_partitions,
    partition_keys,
    segment_value,
)

# Longest list of partitions put into an error message.
_PARTITIONS_SHOWN = 100


def _spark_type(arrow_type: pa.DataType) -> T.DataType | None:
    """Spark type a Parquet column of this Arrow type is read as; None if it cannot be."""
    if pa.types.is_time(arrow_type) or pa.types.is_float16(arrow_type):
        return None
    if pa.types.is_timestamp(arrow_type) and arrow_type.unit == "ns":
        return None
    unsigned = {
        pa.uint8(): T.ShortType(),
        pa.uint16(): T.IntegerType(),
        pa.uint32(): T.LongType(),
        pa.uint64(): T.DecimalType(20, 0),
    }
    if arrow_type in unsigned:
        return unsigned[arrow_type]
    if pa.types.is_duration(arrow_type):
        return T.LongType()
    if pa.types.is_dictionary(arrow_type):
        return _spark_type(arrow_type.value_type)
    children = [arrow_type.field(i).type for i in range(arrow_type.num_fields)]
    if any(_spark_type(child) is None for child in children):
        return None
    return from_arrow_type(arrow_type, prefer_timestamp_ntz=True)


def united_schema(layout: Layout) -> tuple[T.StructType, list[str]]:
    """Columns of all files, without those that Spark cannot read.

    The second value lists the columns left out.
    """
    united = pa.unify_schemas(layout.schemas, promote_options="permissive")
    types = {field.name: _spark_type(field.type) for field in united}
    readable = T.StructType(
        [T.StructField(n, t, True) for n, t in types.items() if t is not None]
    )
    return readable, [n for n, t in types.items() if t is None]


def _read(
    spark: SparkSession, path: str, layout: Layout, options: dict[str, str]
) -> DataFrame:
    """Rows of all files with the columns that any of them has."""
    readable, left_out = united_schema(layout) if layout.schemas else (None, [])
    reader = spark.read.options(**options)
    if left_out:
        warnings.warn(
            f"Columns of a type that cannot be read were left out: "
            f"{', '.join(left_out)}.",
            stacklevel=3,
        )
        return reader.schema(readable).parquet(path)
    if len(layout.schemas) > 1:
        return reader.option("mergeSchema", "true").parquet(path)
    return reader.parquet(path)


def scan_parquet(
    spark: SparkSession,
    path: str,
    hive: bool = True,
    columns: Sequence[str] | None = None,
    raw_partition_text: bool = False,
    layout: Layout | None = None,
) -> DataFrame:
    """Scan a dataset folder or a single part file.

    The columns are those of all files: one that a file lacks is null in its rows.
    With ``hive`` the ``key=value`` folders become columns; where a file holds a column
    of the same name the folder's value wins, and a warning says so.  With
    ``hive=False`` folder names are ignored and the values in the files are kept.
    ``raw_partition_text`` keeps folder values as text (``01`` stays ``01``).  ``layout``
    is that of the files that will be read, when the caller knows it.
    """
    layout = layout or dataset_layout(spark, path)
    options = {} if hive else {"recursiveFileLookup": "true"}
    df = _read(spark, path, layout, options)
    if hive:
        _warn_of_shadowed_columns(layout)
    if raw_partition_text:
        # a partition column whose type is given takes the folder's text unchanged
        df = spark.read.schema(_as_text(df.schema, layout.keys)).parquet(path)
    return df.select(*map(column, columns)) if columns is not None else df


def _as_text(schema: T.StructType, names: Sequence[str]) -> T.StructType:
    def retyped(f: T.StructField) -> T.StructField:
        data_type = T.StringType() if f.name in names else f.dataType
        return T.StructField(f.name, data_type, f.nullable, f.metadata)

    return T.StructType([retyped(f) for f in schema])


def _warn_of_shadowed_columns(layout: Layout) -> None:
    """Warn when a partition folder hides a column of the same name in the files."""
    stored = {name for schema in layout.schemas for name in schema.names}
    shadowed = sorted(set(layout.keys) & stored)
    if shadowed:
        warnings.warn(
            "Partition folders replace the values stored in the files for: "
            f"{', '.join(shadowed)}. Use hive=False to keep the stored values.",
            stacklevel=3,
        )


def parse_selector(selector: str) -> dict[str, str]:
    """``"year=2023/month=1"`` as a dict; both kinds of slash separate the pieces."""
    pieces = [p for p in selector.replace("\\", "/").split("/") if p]
    if not pieces or any("=" not in p for p in pieces):
        raise ValueError(
            f"A partition selector looks like key=value/key=value, not {selector!r}."
        )
    return dict(piece.split("=", 1) for piece in pieces)


def scan_partition(spark: SparkSession, path: str, selector: str) -> DataFrame:
    """Scan the partitions that match a selector such as ``"year=2023/month=1"``.

    Any subset of the keys may be given.  The condition is on partition columns only,
    so Spark opens no other folder.  ``ValueError`` when the dataset is not partitioned
    or has no such partition.
    """
    wanted = parse_selector(selector)
    files = file_table(spark, path)
    keys = partition_keys(spark, path, files)
    if not keys:
        raise ValueError(f"{path} has no partitions, so {selector!r} selects nothing.")
    present = set(wanted) <= set(keys)
    if not present or files_of_partitions(files, selector).isEmpty():
        available = list_partitions(spark, path, all_levels=False, typed=False)
        count = available.count()
        shown = [r["partition"] for r in available.limit(_PARTITIONS_SHOWN).collect()]
        raise ValueError(
            f"No partition matches {selector!r}. Of {count} partitions the first "
            f"{len(shown)} are {', '.join(sorted(shown))}; list_partitions gives all."
        )

    # only the footers of the selected files are opened
    selected = dataset_layout(spark, path, files_of_partitions(files, selector))
    df = scan_parquet(spark, path, layout=selected)
    types = dict(df.dtypes)
    for key, text in wanted.items():
        value = F.lit(text).try_cast(types[key])
        null = text == NULL_PARTITION
        df = df.where(column(key).isNull() if null else column(key) == value)
    return df


def files_of_partitions(files: DataFrame, selector: str) -> DataFrame:
    """Rows of a file table whose folders match a partition selector."""
    for key, text in parse_selector(selector).items():
        # the last folder of that key: one above the dataset does not count
        folder = F.regexp_extract("path", f"^.*/({re.escape(key)}=[^/]*)/", 1)
        files = files.where(_folder_matches(segment_value(folder), text))
    return files


def _folder_matches(value: Column, text: str) -> Column:
    """Folder value equals the text asked for, as text or as a number."""
    if text == NULL_PARTITION:
        return value.isNull()
    matches = value == text
    if text.isdigit():
        number = "decimal(38,0)"
        matches = matches | (value.try_cast(number) == F.lit(text).try_cast(number))
    return matches
