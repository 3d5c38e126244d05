"""GeoParquet: footers as a table, and reading the primary geometry column."""

from __future__ import annotations

import json
import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import BOUNDS, DEFAULT_SRID, envelope, meets_window
from ..functions.wkb import from_wkb
from ..names import column, columns
from ..session import ship_package
from .columns import with_srid
from .files import file_table, read_footers
from .parquet import files_of_partitions, scan_parquet, scan_partition

_HEADER = (
    "version string, primary_column string, columns map<string,map<string,string>>"
)

# Reference-system names that mean longitude/latitude on WGS 84.
OGC_LON_LAT = ("OGC", "CRS84")
EPSG = "EPSG"
# Geometry families in order of precedence when a dataset mixes kinds.
FAMILIES = (
    ("MULTIPOINT", ("MultiPoint",)),
    ("POINT", ("Point",)),
    ("POLYLINE", ("MultiLineString", "LineString")),
    ("POLYGON", ("MultiPolygon", "Polygon")),
)


def geoparquet_footers(
    spark: SparkSession, path: str, selector: str | None = None
) -> DataFrame:
    """One row per file and geometry column of the ``geo`` footers of a dataset.

    With a ``selector`` (``"year=2023"``) only files of those partitions are looked at.

    Columns: ``file, num_rows, version, primary_column, column, encoding,
    geometry_types, crs, crs_given, bbox, covering``; ``crs`` and ``covering`` are JSON
    text, and ``crs_given`` tells a missing entry from an explicit null.  Files without a
    footer give no row.
    """
    files = file_table(spark, path)
    if selector is not None:
        files = files_of_partitions(files, selector)
    return geometry_entries(read_footers(files))


def geometry_entries(footers: DataFrame) -> DataFrame:
    """``geoparquet_footers`` of the files whose footers are given."""
    given = footers.where(F.col("geo").isNotNull())
    header = F.from_json("geo", _HEADER)
    entries = given.select("path", "num_rows", header.alias("header")).select(
        F.col("path").alias("file"),
        "num_rows",
        "header.version",
        "header.primary_column",
        F.explode("header.columns").alias("column", "facts"),
    )
    facts = F.col("facts")
    return entries.select(
        "file",
        "num_rows",
        "version",
        "primary_column",
        "column",
        facts["encoding"].alias("encoding"),
        F.from_json(facts["geometry_types"], "array<string>").alias("geometry_types"),
        facts["crs"].alias("crs"),
        F.map_contains_key(facts, "crs").alias("crs_given"),
        F.from_json(facts["bbox"], "array<double>").alias("bbox"),
        facts["covering"].alias("covering"),
    )


def bbox_from_footers(footers: DataFrame) -> DataFrame:
    """Extent of a dataset from the footers of its primary geometry column.

    One row ``xmin, ymin, xmax, ymax, headers``; ``headers`` counts the different
    footers apart from their extent.  More than one means that reference systems or
    geometry types differ between files; ``dataset_bbox_from_footers`` refuses that.
    """
    size = F.size("bbox")
    bound = F.col("bbox")
    # a bbox has four or, with heights, six numbers: minima first, then maxima
    half = (size / 2).cast("int")
    return (
        footers.where(F.col("column") == F.col("primary_column"))
        .select(
            F.get(bound, F.lit(0)).alias("xmin"),
            F.get(bound, F.lit(1)).alias("ymin"),
            F.get(bound, half).alias("xmax"),
            F.get(bound, half + 1).alias("ymax"),
            F.struct(
                "column", "encoding", F.sort_array("geometry_types"), "crs"
            ).alias("header"),
        )
        .agg(
            F.min("xmin").alias("xmin"),
            F.min("ymin").alias("ymin"),
            F.max("xmax").alias("xmax"),
            F.max("ymax").alias("ymax"),
            F.count_distinct(F.to_json("header")).alias("headers"),
        )
    )


def dataset_bbox_from_footers(spark: SparkSession, path: str) -> list[float]:
    """``[xmin, ymin, xmax, ymax]`` of a GeoParquet dataset without reading any data."""
    row = bbox_from_footers(geoparquet_footers(spark, path)).first()
    if row["headers"] > 1:
        raise ValueError(
            f"The files of {path} describe their geometry in {row['headers']} ways, so "
            "their extents cannot be united."
        )
    if row["xmin"] is None:
        raise ValueError(_NOT_GEOPARQUET)
    return [row["xmin"], row["ymin"], row["xmax"], row["ymax"]]


_NOT_GEOPARQUET = (
    "No footer describes a geometry: the dataset does not appear to be formatted as "
    "GeoParquet. Other sources of geometry are chosen by geometry_format."
)


# --- geometry type and reference system ----------------------------------------------


def resolve_geometry_type(kinds: Column) -> Column:
    """Feature type for a set of geometry kinds; null when none is supported.

    Multipoint wins over point, point over lines, lines over polygons.  Case is ignored.
    """
    lowered = F.transform(kinds, F.lower)
    result = F.lit(None).cast("string")
    for family, members in reversed(FAMILIES):
        present = F.arrays_overlap(lowered, F.array(*[F.lit(m.lower()) for m in members]))
        result = F.when(present, family).otherwise(result)
    return result


def geometry_type_name(kinds: list[str]) -> str:
    """``resolve_geometry_type`` for kinds that are already known on the driver."""
    lowered = {kind.lower() for kind in kinds}
    for family, members in FAMILIES:
        if lowered & {member.lower() for member in members}:
            return family
    if kinds:
        raise ValueError(
            f"Of the kinds {sorted(kinds)} none is a point, line or polygon, so the "
            "geometry is not supported."
        )
    raise ValueError("The footers list no kind of geometry.")


def srid_column() -> Column:
    """SRID of a footer row: CRS84 and a missing or nameless crs mean 4326.

    An explicit null means unknown and gives 0; a code of another authority gives null.
    """
    authority = F.get_json_object("crs", "$.id.authority")
    code = F.get_json_object("crs", "$.id.code")
    is_lon_lat = (authority == OGC_LON_LAT[0]) & (code == OGC_LON_LAT[1])
    return (
        F.when(~F.col("crs_given"), DEFAULT_SRID)
        .when(F.col("crs").isNull(), 0)
        .when(authority.isNull() | code.isNull(), DEFAULT_SRID)
        .when(is_lon_lat, DEFAULT_SRID)
        .when(authority == EPSG, code.try_cast("int"))
    )


def _is_read(chosen: str | None) -> Column:
    """Footer rows of the geometry column that is read: the chosen or the primary one."""
    return F.col("column") == (F.lit(chosen) if chosen else F.col("primary_column"))


def _srid_aggregates(chosen: str | None = None) -> list[Column]:
    """Aggregates over footer rows from which the column's one SRID is decided."""
    primary = _is_read(chosen)
    srid = F.when(primary, srid_column())
    named = F.get_json_object("crs", "$.id.code").isNotNull()
    return [
        F.count_if(primary).alias("n_primary"),
        F.min(srid).alias("srid_min"),
        F.max(srid).alias("srid_max"),
        F.max(F.when(primary & srid.isNull(), F.col("crs"))).alias("crs_unknown"),
        F.bool_and(F.when(primary, named)).alias("crs_named"),
    ]


def _decide_srid(row: Row) -> int:
    if row["crs_unknown"] is not None:
        raise ValueError(
            f"Only EPSG codes and OGC:CRS84 are known, not {row['crs_unknown']}."
        )
    if row["srid_min"] != row["srid_max"]:
        raise ValueError("The files of the dataset have different reference systems.")
    if not row["crs_named"] and row["srid_min"] == DEFAULT_SRID:
        warnings.warn(
            "No footer names a reference system; 4326 is assumed.",
            stacklevel=3,
        )
    return row["srid_min"]


def resolve_srid(footers: DataFrame, geometry_column: str | None = None) -> int:
    """The one SRID of a dataset's primary geometry column, or of the one given."""
    row = footers.agg(*_srid_aggregates(geometry_column)).first()
    if not row["n_primary"]:
        raise ValueError(_NOT_GEOPARQUET)
    return _decide_srid(row)


# --- reading ----------------------------------------------------------------------


@dataclass(frozen=True)
class GeoDataset:
    """What the footers of a GeoParquet dataset say."""

    primary_column: str
    geometry_columns: tuple[str, ...]
    kinds: tuple[str, ...]
    srid: int
    crs: str | None = None
    covering: str | None = None


def describe_geoparquet(
    spark: SparkSession,
    path: str,
    selector: str | None = None,
    geometry_column: str | None = None,
) -> GeoDataset | None:
    """Summarise the footers of all (selected) files; None when there are none.

    Kinds, encoding and reference system are those of the primary geometry column, or of
    the one given.
    """
    primary = _is_read(geometry_column)
    types = F.collect_set(F.when(primary, F.array_sort("geometry_types")))
    row = (
        geoparquet_footers(spark, path, selector)
        .agg(
            F.min("primary_column").alias("primary"),
            F.max("primary_column").alias("other_primary"),
            F.collect_set("column").alias("columns"),
            F.array_distinct(F.flatten(types)).alias("kinds"),
            F.collect_set(F.when(primary, F.col("encoding"))).alias("encodings"),
            F.max(F.when(primary, F.col("crs"))).alias("crs"),
            F.collect_set(F.when(primary, F.coalesce("covering", F.lit("")))).alias("covering"),
            *_srid_aggregates(geometry_column),
        )
        .first()
    )
    if row["primary"] is None:
        return None
    if row["primary"] != row["other_primary"]:
        raise ValueError("The files of the dataset name different primary columns.")
    if set(row["encodings"]) - {"WKB"}:
        raise ValueError(f"Geometry encodings {row['encodings']} are not supported.")
    return GeoDataset(
        row["primary"],
        (row["primary"], *sorted(set(row["columns"]) - {row["primary"]})),
        tuple(sorted(row["kinds"] or ())),
        _decide_srid(row) if row["n_primary"] else DEFAULT_SRID,
        row["crs"],
        _covering_column(row["covering"]),
    )


def _covering_column(entries: list[str]) -> str | None:
    """The struct column that holds the bounds of each row in all files, if one does."""
    if len(entries) != 1 or not entries[0]:
        return None
    paths = json.loads(entries[0]).get("bbox", {})
    name = (paths.get("xmin") or [None])[0]
    return name if all(paths.get(side) == [name, side] for side in BOUNDS) else None


def has_geoparquet_footer(spark: SparkSession, path: str) -> str | None:
    """Primary column that footers of a dataset name; None where no file has one.

    All files are looked at, in tasks.
    """
    primary = F.get_json_object("geo", "$.primary_column")
    is_object = F.get_json_object("geo", "$").startswith("{")
    row = (
        read_footers(file_table(spark, path))
        .agg(
            F.min(primary).alias("primary"),
            F.count_if(F.col("geo").isNotNull() & ~F.coalesce(is_object, F.lit(False))).alias("bad"),
        )
        .first()
    )
    if row["bad"]:
        warnings.warn(
            "A file has a geo footer that is not a JSON object; it is passed over.",
            stacklevel=2,
        )
    return row["primary"]


def geometry_name(
    df: DataFrame, dataset: GeoDataset | None, chosen: str | None = None
) -> str:
    """Name of the geometry column to read, after checking that it exists."""
    if dataset is None:
        raise ValueError(_NOT_GEOPARQUET)
    name = chosen or dataset.primary_column
    if name not in df.columns:
        raise ValueError(
            f"Geometry column '{name}' does not exist in the dataset schema, whose "
            f"columns are {', '.join(df.columns)}."
        )
    return name


def decode_geometry(
    df: DataFrame, name: str, dataset: GeoDataset, keep_wkb: str | None = None
) -> DataFrame:
    """Replace all geometry columns by the decoded one, ``geometry``.

    The other geometry columns drop out of the plan, so they are never read.  With
    ``keep_wkb`` the bytes stay under that name.
    """
    geometries = {*dataset.geometry_columns, name, dataset.covering}
    attributes = columns(c for c in df.columns if c not in geometries)
    raw = [column(name).alias(keep_wkb)] if keep_wkb else []
    decoded = df.select(*attributes, *raw, from_wkb(column(name)).alias("geometry"))
    return with_srid(decoded, dataset.srid, crs=dataset.crs)


def read_geoparquet(
    spark: SparkSession,
    path: str,
    geometry_column: str | None = None,
    selector: str | None = None,
    window: Sequence[float] | None = None,
) -> DataFrame:
    """Scan a GeoParquet dataset: its attributes and one ``geometry`` struct.

    The primary geometry column is decoded, or the one chosen.  Bytes that cannot be
    decoded give a null geometry.  With a ``window`` (see ``meets_window``) only features
    whose extent meets it are read; where the files have a covering column, row groups
    outside of it are skipped and other geometries are not decoded.
    """
    ship_package(spark)
    df = scan_partition(spark, path, selector) if selector else scan_parquet(spark, path)
    dataset = describe_geoparquet(spark, path, selector, geometry_column)
    name = geometry_name(df, dataset, geometry_column)
    if window is None:
        return decode_geometry(df, name, dataset)
    if dataset.covering is not None:
        met = df.where(meets_window(column(dataset.covering), window))
        return decode_geometry(met, name, dataset)
    found = decode_geometry(df, name, dataset)
    box = F.col("__box")
    placed = found.withColumn("__box", envelope(F.col("geometry")))
    return placed.where(meets_window(box, window)).drop("__box")
