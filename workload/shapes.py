"""Queries on geometry: extents, centroids, GeoJSON, reprojection and grid cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.functions.cells import (
    cell_of_point,
    cells_of_line,
    cells_of_polygon,
    tile_x,
    tile_y,
)
from quadrille.functions.geometry import (
    centroid,
    envelope,
    first_point,
    geometry,
    kind,
    make_polygon,
    to_web_mercator,
    to_wgs84,
)
from quadrille.functions.geometry import points as vertices
from quadrille.functions.wkb import from_wkb, to_wkb
from quadrille.operators.profile import dataset_bbox, geometry_kinds, row_counts
from quadrille.operators.rows import cell_cover, cell_rollup, dealt
from quadrille.sinks.exports import (
    export_attributes,
    export_cells,
    export_geojson,
    export_xy,
)
from quadrille.sources.columns import points_from_xy, polygons_from_cells
from quadrille.sources.geoparquet import resolve_geometry_type

from .inputs import (
    BAD_SQL,
    HALF,
    ONE,
    PTS_SQL,
    all_shapes,
    bad_coordinates,
    coordinates,
    corner,
    line_cells_sql,
    lines,
    point_cell_sql,
    points,
    square_cells_sql,
    squares,
    table,
    tile_fraction_x,
    tile_fraction_y,
    whole_tile,
)
from .registry import query

@query(
    "points_from_xy",
    f"WITH {PTS_SQL} SELECT k, lon, lat, 'Point' AS kind, lon AS x, lat AS y FROM pts",
)
def place_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = points_from_xy(coordinates(spark, sf_dir), "lon", "lat")
    point = first_point(F.col("geometry"))
    return df.select(
        "k",
        "lon",
        "lat",
        kind(F.col("geometry")).alias("kind"),
        point["x"].alias("x"),
        point["y"].alias("y"),
    )


@query(
    "null_geometry",
    f"""
WITH {BAD_SQL}
SELECT count(*) AS "rows", count(*)-count(lon) AS null_geometries,
       cast(0 AS bigint) AS empty_geometries, min(lon) AS xmin, max(lon) AS xmax,
       min(CASE WHEN lon IS NOT NULL THEN lat END) AS ymin,
       max(CASE WHEN lon IS NOT NULL THEN lat END) AS ymax
FROM bad
""",
)
def null_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without geometry are counted and stay out of the extent."""
    df = points_from_xy(bad_coordinates(spark, sf_dir), "lon", "lat")
    # both are one-row aggregates
    counts = row_counts(df).withColumn("one", F.lit(1))
    box = dataset_bbox(df).withColumn("one", F.lit(1))
    return counts.join(F.broadcast(box), "one").drop("one")


@query(
    "bbox",
    f"""
WITH {PTS_SQL}
SELECT min(lon) AS xmin, min(lat) AS ymin, max(lon+{ONE}) AS xmax,
       max(lat+{HALF}) AS ymax
FROM pts
""",
)
def bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_bbox(all_shapes(spark, sf_dir))


@query(
    "geometry_types",
    """
WITH kinds AS (
  SELECT c_nationkey AS nation, CASE
    WHEN c_acctbal > 9900 THEN 'MultiPoint' WHEN c_acctbal > 9800 THEN 'Point'
    WHEN c_acctbal > 9600 THEN 'LineString' ELSE 'Polygon' END AS kind
  FROM customer)
SELECT nation, array_to_string(list_sort(list(DISTINCT kind)), ',') AS kinds,
       CASE WHEN bool_or(kind = 'MultiPoint') THEN 'MULTIPOINT'
            WHEN bool_or(kind = 'Point') THEN 'POINT'
            WHEN bool_or(kind = 'LineString') THEN 'POLYLINE'
            ELSE 'POLYGON' END AS feature_type
FROM kinds GROUP BY nation
""",
)
def geometry_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature type of each nation's customers, whose shape depends on their balance."""
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "k")
    balance = F.col("c_acctbal")
    shape = (
        F.when(balance > 9900, "MultiPoint")
        .when(balance > 9800, "Point")
        .when(balance > 9600, "LineString")
        .otherwise("Polygon")
    )
    wanted = customer.select("k", F.col("c_nationkey").alias("nation"), shape.alias("s"))
    features = all_shapes(spark, sf_dir).join(wanted, "k")
    features = features.where(kind(F.col("geometry")) == F.col("s"))
    return geometry_kinds(features, by=["nation"]).select(
        "nation",
        F.array_join("kinds", ",").alias("kinds"),
        resolve_geometry_type(F.col("kinds")).alias("feature_type"),
    )


# --- representations --------------------------------------------------------------


@query(
    "export_xy",
    f"WITH {PTS_SQL} SELECT k, lon, lat, lon AS x_lon, lat AS y_lat FROM pts",
)
def xy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_xy(points(spark, sf_dir))


@query(
    "export_geojson",
    f"""
WITH {PTS_SQL},
bends AS (SELECT k, [[lon, lat], [lon+{HALF}, lat+{HALF}], [lon+{ONE}, lat]] AS c
          FROM pts),
rings AS (SELECT k, [[[lon, lat], [lon+{HALF}, lat], [lon+{HALF}, lat+{HALF}],
                      [lon, lat+{HALF}], [lon, lat]]] AS c FROM pts)
SELECT k, to_json({{'type': 'Point', 'coordinates': [lon, lat]}})::varchar AS geojson
FROM pts
UNION ALL SELECT k, to_json({{'type': 'MultiPoint', 'coordinates': c}})::varchar
FROM bends
UNION ALL SELECT k, to_json({{'type': 'LineString', 'coordinates': c}})::varchar
FROM bends
UNION ALL SELECT k, to_json({{'type': 'Polygon', 'coordinates': c}})::varchar
FROM rings
""",
)
def geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_geojson(all_shapes(spark, sf_dir).drop("lon", "lat"))


@query(
    "export_cells",
    f"""
WITH {PTS_SQL},{line_cells_sql(10)},{square_cells_sql(10)},
point_cells AS (
  SELECT k, {point_cell_sql('lon', 'lat', 10)} AS a,
         {point_cell_sql(f'lon+{HALF}', f'lat+{HALF}', 10)} AS b,
         {point_cell_sql(f'lon+{ONE}', 'lat', 10)} AS c
  FROM pts)
SELECT k, 'Point' AS kind, a AS cell_index FROM point_cells
UNION ALL
SELECT k, 'MultiPoint', to_json(list_sort(list_distinct([a, b, c])))::varchar
FROM point_cells
UNION ALL
SELECT k, 'LineString', to_json(list_sort(list(cell)))::varchar
FROM line_cells GROUP BY k
UNION ALL
SELECT pts.k, 'Polygon',
       coalesce(to_json(list_sort(list(cell) FILTER (cell IS NOT NULL)))::varchar, '[]')
FROM pts LEFT JOIN square_cells USING (k) GROUP BY pts.k
""",
)
def cell_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = all_shapes(spark, sf_dir).drop("lon", "lat")
    shapes = shapes.withColumn("kind", kind(F.col("geometry")))
    return export_cells(shapes, 10)


@query(
    "export_attributes", f"WITH {PTS_SQL} SELECT k, lon, lat FROM pts"
)
def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_attributes(points(spark, sf_dir))


@query(
    "centroid",
    f"""
WITH {PTS_SQL}, shapes AS (
SELECT k, 'Point' AS kind, lon AS x, lat AS y FROM pts
UNION ALL SELECT k, 'MultiPoint', lon+{HALF}, lat+{HALF}/3 FROM pts
UNION ALL SELECT k, 'LineString', lon+{HALF}, lat+{HALF}/2 FROM pts
UNION ALL SELECT k, 'Polygon', lon+{HALF}/2, lat+{HALF}/2 FROM pts)
SELECT k, kind, round(x, 6) AS x, round(y, 6) AS y FROM shapes
""",
)
def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    centre = centroid(F.col("geometry"))
    return all_shapes(spark, sf_dir).select(
        "k",
        kind(F.col("geometry")).alias("kind"),
        F.round(centre["x"], 6).alias("x"),
        F.round(centre["y"], 6).alias("y"),
    )


@query(
    "compound_shapes",
    f"""
WITH {PTS_SQL}, shapes AS (
SELECT k, 'MultiLineString' AS kind, lon+{HALF} AS x, lat+{HALF} AS y,
       lon AS xmin, lat AS ymin, lon+{ONE} AS xmax, lat+{ONE} AS ymax FROM pts
UNION ALL
SELECT k, 'MultiPolygon', lon+{HALF}/2*3, lat+{HALF}/2,
       lon, lat, lon+{ONE}+{HALF}, lat+{HALF} FROM pts
UNION ALL
SELECT k, 'Polygon', lon+{HALF}/8*7, lat+{HALF}/8*7, lon, lat, lon+{ONE}, lat+{ONE}
FROM pts)
SELECT k, kind, round(x, 6) AS x, round(y, 6) AS y, round(xmin, 6) AS xmin,
       round(ymin, 6) AS ymin, round(xmax, 6) AS xmax, round(ymax, 6) AS ymax
FROM shapes
""",
)
def shapes_of_several_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and polygons of several parts and a hole, through WKB and back.

    The hole is half as wide as its square, with its centre at 11/16 of either side, so
    the centroid moves to (1 * 1/2 - 1/4 * 11/16) / (3/4) = 7/16.
    """

    def square(dx: float, dy: float, side: float):
        corners = ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))
        return F.array(*[corner(dx + side * x, dy + side * y) for x, y in corners])

    lines_ = F.array(
        F.array(corner(0.0, 0.0), corner(1.0, 0.0)),
        F.array(corner(0.0, 1.0), corner(1.0, 1.0)),
    )
    shapes = F.array(
        geometry("MultiLineString", F.array(lines_)),
        geometry(
            "MultiPolygon",
            F.array(F.array(square(0.0, 0.0, 0.5)), F.array(square(1.0, 0.0, 0.5))),
        ),
        make_polygon(F.array(square(0.0, 0.0, 1.0), square(0.4375, 0.4375, 0.5))),
    )
    placed = dealt(coordinates(spark, sf_dir), "k")
    df = placed.select("k", F.explode(shapes).alias("shape"))
    back = df.select("k", from_wkb(to_wkb(F.col("shape"))).alias("geometry"))
    centre, box = centroid(F.col("geometry")), envelope(F.col("geometry"))
    return back.select(
        "k",
        kind(F.col("geometry")).alias("kind"),
        *[F.round(centre[c], 6).alias(c) for c in ("x", "y")],
        *[F.round(box[c], 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")],
    )


@query(
    "reproject",
    f"""
WITH {PTS_SQL}
SELECT k, round(radians(lon)*cast(6378137 AS double),3) AS easting,
       -- adding zero turns the negative zero at the equator into zero
       round(ln(tan(pi()/4+radians(lat)/2))*cast(6378137 AS double),3)+0 AS northing,
       round(lon, 6) AS lon, round(lat, 6) AS lat
FROM pts
""",
)
def reproject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To metres and back again."""
    metres = to_web_mercator(F.col("geometry"))
    moved = points(spark, sf_dir).select("k", metres.alias("metres"))
    there = first_point(F.col("metres"))
    back = first_point(to_wgs84(F.col("metres"), 3857))
    return moved.select(
        "k",
        F.round(there["x"], 3).alias("easting"),
        F.round(there["y"], 3).alias("northing"),
        F.round(back["x"], 6).alias("lon"),
        F.round(back["y"], 6).alias("lat"),
    )


# --- cells ------------------------------------------------------------------------

_ZOOM = 14


@query(
    "cell_index",
    f"""
WITH {PTS_SQL}
SELECT k, {whole_tile(tile_fraction_x('lon', _ZOOM), _ZOOM)} AS tile_x,
       {whole_tile(tile_fraction_y('lat', _ZOOM), _ZOOM)} AS tile_y,
       {point_cell_sql('lon', 'lat', _ZOOM)} AS cell
FROM pts
""",
)
def cell_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    lon, lat = F.col("lon"), F.col("lat")
    return coordinates(spark, sf_dir).select(
        "k",
        tile_x(lon, _ZOOM).alias("tile_x"),
        tile_y(lat, _ZOOM).alias("tile_y"),
        cell_of_point(lon, lat, _ZOOM).alias("cell"),
    )


@query(
    "cell_polygon",
    f"""
WITH {PTS_SQL}, tiles AS (
  SELECT k, {whole_tile(tile_fraction_x('lon', _ZOOM), _ZOOM)} AS tx,
         {whole_tile(tile_fraction_y('lat', _ZOOM), _ZOOM)} AS ty
  FROM pts), corners AS (
  SELECT k, cast(tx AS double)/{1 << _ZOOM}*360-180 AS west,
         cast(tx+1 AS double)/{1 << _ZOOM}*360-180 AS east,
         degrees(atan(sinh(pi()*(1-2*cast(ty AS double)/{1 << _ZOOM})))) AS north,
         degrees(atan(sinh(pi()*(1-2*cast(ty+1 AS double)/{1 << _ZOOM})))) AS south
  FROM tiles)
SELECT k, i, round(CASE WHEN i IN (1, 2) THEN east ELSE west END, 9) AS x,
       round(CASE WHEN i IN (2, 3) THEN north ELSE south END, 9) AS y
FROM (SELECT *, unnest([0, 1, 2, 3, 4]) AS i FROM corners)
""",
)
def cell_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = cell_of_point(F.col("lon"), F.col("lat"), _ZOOM)
    outlined = polygons_from_cells(
        coordinates(spark, sf_dir).withColumn("cell", cell), "cell"
    )
    corners = F.posexplode(vertices(F.col("geometry"))).alias("i", "corner")
    return outlined.select("k", corners).select(
        "k",
        "i",
        F.round("corner.x", 9).alias("x"),
        F.round("corner.y", 9).alias("y"),
    )


@query(
    "cells_of_line",
    f"WITH {PTS_SQL},{line_cells_sql(10)} SELECT k, cell FROM line_cells",
)
def line_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = cells_of_line(F.col("geometry"), 10)
    return lines(spark, sf_dir).select("k", F.explode(cells).alias("cell"))


@query(
    "cells_of_polygon",
    f"WITH {PTS_SQL},{square_cells_sql(10)} SELECT k, cell FROM square_cells",
)
def square_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = cells_of_polygon(F.col("geometry"), 10)
    return squares(spark, sf_dir).select("k", F.explode(cells).alias("cell"))


@query(
    "cell_cover",
    f"""
WITH {PTS_SQL},{line_cells_sql(12)},{square_cells_sql(12)}
SELECT k, 'Point' AS kind, {point_cell_sql('lon', 'lat', 12)} AS cell FROM pts
UNION ALL
SELECT DISTINCT k, 'MultiPoint', {point_cell_sql('x', 'y', 12)} FROM vertices
UNION ALL SELECT k, 'LineString', cell FROM line_cells
UNION ALL SELECT k, 'Polygon', cell FROM square_cells
""",
)
def cover_all_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per feature and cell."""
    shapes = all_shapes(spark, sf_dir).drop("lon", "lat")
    return cell_cover(shapes.withColumn("kind", kind(F.col("geometry"))), 12)


@query(
    "cell_rollup",
    f"""
WITH {PTS_SQL}, keyed AS (
  SELECT {point_cell_sql('lon', 'lat', 6)} AS cell, lon, lat FROM pts)
SELECT cell, count(*) AS features, min(lon) AS xmin, min(lat) AS ymin,
       max(lon) AS xmax, max(lat) AS ymax
FROM keyed GROUP BY cell
""",
)
def rollup_by_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cell_rollup(points(spark, sf_dir), 6)
