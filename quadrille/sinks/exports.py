"""Geometry representations of an export, as projections of the feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import DEFAULT_ZOOM, cell_of_point, cells_of
from ..functions.geometry import as_geojson, centroid, first_point, kind, to_wgs84
from ..names import columns
from ..operators.profile import profile_fields
from ..sources.columns import srid_of

# Names of the geometry columns of an export.
X_COLUMN, Y_COLUMN = "x_lon", "y_lat"
GEOJSON_COLUMN = "geojson"
CELL_COLUMN = "cell_index"


def _attributes(df: DataFrame, geometry: str) -> list[Column]:
    return columns(c for c in df.columns if c != geometry)


def export_attributes(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Attributes without geometry."""
    return df.drop(geometry)


def with_centroid(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """The table with the centroid of its geometry as two numbers beside it.

    They are in the table's own reference system.
    """
    placed = df.withColumn("__centre", centroid(F.col(geometry)))
    centre = F.col("__centre")
    return placed.select(
        *columns(df.columns), centre["x"].alias(X_COLUMN), centre["y"].alias(Y_COLUMN)
    )


def export_xy(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Centroid coordinates as two numbers, in the table's own reference system."""
    return with_centroid(df, geometry).drop(geometry)


def export_geojson(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Geometry as GeoJSON text."""
    return df.select(
        *_attributes(df, geometry), as_geojson(F.col(geometry)).alias(GEOJSON_COLUMN)
    )


def cell_value(geom: Column, zoom: int) -> Column:
    """One cell id for a point, a JSON list of ids for other kinds, null for null."""
    point = first_point(geom)
    return F.when(
        kind(geom) == "Point", cell_of_point(point["x"], point["y"], zoom)
    ).otherwise(F.to_json(cells_of(geom, zoom)))


def export_cells(
    df: DataFrame, zoom: int = DEFAULT_ZOOM, geometry: str = "geometry"
) -> DataFrame:
    """Geometry as grid cells; coordinates are brought to longitude/latitude first."""
    geom = to_wgs84(F.col(geometry), srid_of(df, geometry))
    return df.select(
        *_attributes(df, geometry), cell_value(geom, zoom).alias(CELL_COLUMN)
    )


def write_schema_csv(
    df: DataFrame, path: str, geometry: str = "geometry", mode: str = "overwrite"
) -> str:
    """Profile a table and write its schema file: one CSV in the folder ``path``.

    The profile has one row per column, so a single file is all there is to write.
    """
    (
        profile_fields(df, geometry)
        .coalesce(1)
        .write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )
    return path
