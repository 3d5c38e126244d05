"""Profiling aggregates: text lengths, extent, geometry kinds and counts.

Each is one pass with a partial aggregate per partition; what travels is one row per
partition, and only the columns asked for are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import envelope, is_empty, kind
from ..names import column, columns
from ..sources.geoparquet import geometry_type_name
from .schema import (
    DEFAULT_TEXT_LENGTH,
    complex_columns,
    field_type,
    safe_name,
    stringify_complex,
)

PROFILE_SCHEMA = (
    "field_name string, field_type string, field_alias string, field_length int"
)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def max_string_lengths(df: DataFrame) -> DataFrame:
    """One row: the greatest length in characters of each text column, nulls ignored.

    A column without any value gives 0.
    """
    names = string_columns(df)
    lengths = [
        F.coalesce(F.max(F.length(column(n))), F.lit(0)).alias(n) for n in names
    ]
    if not lengths:
        return df.sparkSession.createDataFrame([()], T.StructType([]))
    return df.agg(*lengths)


def max_complex_lengths(df: DataFrame) -> DataFrame:
    """One row: the greatest length of the JSON text of each nested column."""
    names = complex_columns(df)
    return max_string_lengths(stringify_complex(df.select(*columns(names))))


def dataset_bbox(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One row ``xmin, ymin, xmax, ymax``; null and empty geometries do not count."""
    return df.select(envelope(F.col(geometry)).alias("box")).agg(
        F.min("box.xmin").alias("xmin"),
        F.min("box.ymin").alias("ymin"),
        F.max("box.xmax").alias("xmax"),
        F.max("box.ymax").alias("ymax"),
    )


def geometry_kinds(
    df: DataFrame, geometry: str = "geometry", by: Sequence[str] = ()
) -> DataFrame:
    """``kinds``: the sorted kinds of geometry that occur (at most six), per group."""
    kinds = F.sort_array(F.collect_set(kind(F.col(geometry)))).alias("kinds")
    return df.groupBy(*columns(by)).agg(kinds)


def geometry_type_of(df: DataFrame, geometry: str = "geometry") -> str:
    """Feature type of a table, decided from its rows."""
    return geometry_type_name(geometry_kinds(df, geometry).first()["kinds"])


def row_counts(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One row: all rows, and those without a geometry or with an empty one."""
    counts = [F.count(F.lit(1)).alias("rows")]
    if geometry in df.columns:
        geom = F.col(geometry)
        counts += [
            F.count_if(geom.isNull()).alias("null_geometries"),
            F.count_if(is_empty(geom)).alias("empty_geometries"),
        ]
    return df.agg(*counts)


def profile_fields(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Schema table of a dataset: names, types, aliases and text lengths.

    Text lengths come from the data, in one aggregate; nested values count as their JSON
    text.  A column without any text gets 512.
    """
    attributes = df.drop(geometry)
    names = complex_columns(attributes)
    lengths = max_string_lengths(stringify_complex(attributes, names)).first()
    lengths = lengths.asDict() if lengths else {}
    rows = []
    for field in attributes.schema:
        name, of_type = field.name, field_type(field.dataType)
        length = lengths.get(name, 0) or DEFAULT_TEXT_LENGTH
        rows.append(
            (
                safe_name(name),
                of_type,
                field.metadata.get("alias", name),
                length if of_type == "TEXT" else None,
            )
        )
    if not rows:
        raise ValueError("The table has no attribute to describe.")
    return df.sparkSession.createDataFrame(rows, PROFILE_SCHEMA)
