"""Export: feature table to a Parquet dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from ..functions.cells import DEFAULT_ZOOM
from ..names import columns
from ..operators.schema import (
    check_export_format,
    check_partition_columns,
    drop_managed_fields,
    normalize_export_types,
)
from ..sinks.exports import (
    export_attributes,
    export_cells,
    export_geojson,
    export_xy,
    with_centroid,
)
from ..sinks.geoparquet import write_geoparquet
from ..sinks.parquet import DEFAULT_ROWS_PER_FILE, write_parquet


def export_features(
    source: DataFrame | str,
    path: str,
    partition_columns: Sequence[str] | str | None = None,
    include_geometry: bool = True,
    geometry_format: str | None = "GEOPARQUET",
    zoom: int = DEFAULT_ZOOM,
    rows_per_file: int = DEFAULT_ROWS_PER_FILE,
    *,
    oid: str | None = None,
    managed: Sequence[str] = (),
    where: Column | str | None = None,
    fields: Sequence[str] | None = None,
    mode: str = "append",
    file_bytes: int | None = None,
    include_centroids: bool = False,
    header: dict | None = None,
    covering: str | None = None,
    spark: SparkSession | None = None,
) -> str:
    """Write a feature table, or the table of the given name, as a Parquet dataset.

    ``geometry_format`` is ``GEOPARQUET``, ``XY`` (centroid), ``GEOJSON`` or ``CELL``.
    A table without a ``geometry`` column is written as plain attributes.  ``oid`` and
    ``managed`` name columns the feature store keeps for itself; they are left out.
    ``include_centroids`` adds the centroid as two numbers to the other representations.
    ``file_bytes`` is that of ``write_parquet``; ``header`` and ``covering`` are those of
    ``write_geoparquet`` and count for GeoParquet alone.
    """
    chosen = check_export_format(geometry_format)
    if isinstance(source, str):
        source = (spark or SparkSession.active()).table(source)
    df = drop_managed_fields(source, oid, rasters=managed)
    if where is not None:
        df = df.where(where)
    has_geometry = "geometry" in df.columns
    if fields is not None:
        df = df.select(*columns([*fields, *(["geometry"] if has_geometry else [])]))
    keys = check_partition_columns(df, partition_columns)
    df = normalize_export_types(df)
    if has_geometry and include_centroids and chosen != "XY":
        df = with_centroid(df)

    if has_geometry and include_geometry and chosen == "GEOPARQUET":
        return write_geoparquet(
            df,
            path,
            keys,
            rows_per_file,
            mode,
            header=header,
            covering=covering,
            file_bytes=file_bytes,
        )
    if has_geometry and not include_geometry:
        df = export_attributes(df)
    elif has_geometry and chosen == "XY":
        df = export_xy(df)
    elif has_geometry and chosen == "GEOJSON":
        df = export_geojson(df)
    elif has_geometry and chosen == "CELL":
        df = export_cells(df, zoom)
    return write_parquet(df, path, keys, rows_per_file, mode, file_bytes)
