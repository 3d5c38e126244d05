"""Geometry columns.

Every geometry is one struct column, whatever its kind::

    struct<type: string, polys: array<array<array<struct<x: double, y: double>>>>>

``polys`` holds polygons -> rings (or paths) -> points.  Points, multipoints, lines and
single polygons use one outer element, multipolygons several.  With one schema for all
kinds, extent, centroid, GeoJSON and reprojection are plain Catalyst expressions, so they
stay in the JVM and need neither a shuffle nor a Python worker.

x is longitude (or easting) and y latitude (or northing) throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

GEOMETRY_TYPE = (
    "struct<type:string,polys:array<array<array<struct<x:double,y:double>>>>>"
)

# The geometry kinds and the sphere radius of EPSG:3857 in metres.
KINDS = (
    "Point",
    "MultiPoint",
    "LineString",
    "MultiLineString",
    "Polygon",
    "MultiPolygon",
)
EARTH_RADIUS = 6378137.0

DEFAULT_SRID = 4326
WEB_MERCATOR_SRID = 3857
UNKNOWN_SRID = 0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a variable.

    Catalyst would otherwise re-evaluate an expression at each place it is used inside a
    higher-order function, once per array element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- construction -----------------------------------------------------------------


def point_struct(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def geometry(kind: str, polys: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), polys.alias("polys"))


def make_point(x: Column, y: Column) -> Column:
    """Point, or null when either coordinate is null."""
    return F.when(
        x.isNotNull() & y.isNotNull(),
        geometry("Point", F.array(F.array(F.array(point_struct(x, y))))),
    )


def make_multipoint(points: Column) -> Column:
    """Multipoint from an array of ``struct<x, y>``."""
    return F.when(points.isNotNull(), geometry("MultiPoint", F.array(F.array(points))))


def make_line(points: Column) -> Column:
    """Line from an array of ``struct<x, y>``."""
    return F.when(points.isNotNull(), geometry("LineString", F.array(F.array(points))))


def make_polygon(rings: Column) -> Column:
    """Polygon from an array of rings; the first ring is the shell, the others holes."""
    return F.when(rings.isNotNull(), geometry("Polygon", F.array(rings)))


# --- parts ------------------------------------------------------------------------


def kind(geom: Column) -> Column:
    return geom["type"]


def parts(geom: Column) -> Column:
    """All rings or paths of a geometry."""
    return F.flatten(geom["polys"])


def points(geom: Column) -> Column:
    """All vertices of a geometry."""
    return F.flatten(parts(geom))


def first_point(geom: Column) -> Column:
    zero = F.lit(0)
    return F.get(F.get(F.get(geom["polys"], zero), zero), zero)


def is_empty(geom: Column) -> Column:
    """True for a geometry without any vertex; null for a null geometry."""
    return F.size(points(geom)) == 0


# --- extent -----------------------------------------------------------------------


#: Bounds of an extent, minima first.
BOUNDS = ("xmin", "ymin", "xmax", "ymax")


def meets_window(box: Column, window: Sequence[float]) -> Column:
    """Whether an extent meets a window ``xmin, ymin, xmax, ymax``; null for null bounds.

    A window whose western edge lies east of the eastern one goes across the antimeridian.
    The condition is on the bounds alone, so it reaches a Parquet scan.
    """
    west, south, east, north = (float(v) for v in window)
    if not south <= north:
        raise ValueError(f"The window {window!r} ends before it begins.")
    after = box["xmax"] >= F.lit(west)
    before = box["xmin"] <= F.lit(east)
    across = (after | before) if west > east else (after & before)
    return across & (box["ymax"] >= F.lit(south)) & (box["ymin"] <= F.lit(north))


def envelope(geom: Column) -> Column:
    """``struct<xmin, ymin, xmax, ymax>``; the bounds of a null or empty one are null.

    Reading ``.x`` of an array of structs is a plain field access on the array, so this
    has no lambda and stays inside whole-stage codegen, and without a condition around it
    Spark computes the array of vertices once for the four bounds.
    """
    xs, ys = points(geom)["x"], points(geom)["y"]
    return F.struct(
        F.array_min(xs).alias("xmin"),
        F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"),
        F.array_max(ys).alias("ymax"),
    )


# --- centroid ---------------------------------------------------------------------


def _mean_of_points(geom: Column) -> Column:
    total = F.aggregate(
        points(geom),
        F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("n")),
        lambda s, p: F.struct(
            (s["x"] + p["x"]).alias("x"),
            (s["y"] + p["y"]).alias("y"),
            (s["n"] + F.lit(1.0)).alias("n"),
        ),
    )
    return let(
        total,
        lambda t: F.when(t["n"] > 0, point_struct(t["x"] / t["n"], t["y"] / t["n"])),
    )


def _walk(path: Column, start: Column, weigh: Callable[..., Column]) -> Column:
    """Sum ``weight, weight * x, weight * y`` of the steps along a path.

    ``weigh(ax, ay, bx, by)`` gives a step's weight; its place is the sum of its two
    ends.  Points are taken relative to ``start``, so that shapes far from the origin do
    not lose their digits.  The running sum also carries the last point: one pass, no
    pairs built beforehand.
    """

    def state(w: Column, x: Column, y: Column, px: Column, py: Column) -> Column:
        named = {"w": w, "x": x, "y": y, "px": px, "py": py}
        return F.struct(*[value.alias(name) for name, value in named.items()])

    def step(s: Column, p: Column) -> Column:
        x, y = p["x"] - start["x"], p["y"] - start["y"]
        w = weigh(s["px"], s["py"], x, y)
        moved_x, moved_y = s["x"] + w * (s["px"] + x), s["y"] + w * (s["py"] + y)
        return state(s["w"] + w, moved_x, moved_y, x, y)

    return F.aggregate(path, state(*[F.lit(0.0)] * 5), step)


def _total(moments: Column) -> Column:
    """Sum an array of ``struct<w, x, y>``."""
    return F.aggregate(
        moments,
        F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y")),
        lambda s, m: F.struct(
            (s["w"] + m["w"]).alias("w"),
            (s["x"] + m["x"]).alias("x"),
            (s["y"] + m["y"]).alias("y"),
        ),
    )


def _weighted_mean(moments: Column, origin: Column, share: float) -> Column:
    """``origin`` plus the weighted mean; null without any weight."""
    return let(
        _total(moments),
        lambda t: F.when(
            t["w"] > 0,
            point_struct(
                origin["x"] + t["x"] / (t["w"] * share),
                origin["y"] + t["y"] / (t["w"] * share),
            ),
        ),
    )


def _line_centroid(geom: Column) -> Column:
    """Midpoints of the segments, weighted by length; null when all have no length."""

    def length(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
        return F.hypot(bx - ax, by - ay)

    def moment(path: Column, origin: Column) -> Column:
        # each path is walked from its own first point, then brought to the common one
        def moved(first: Column) -> Column:
            dx, dy = first["x"] - origin["x"], first["y"] - origin["y"]
            return let(
                _walk(path, first, length),
                lambda t: F.struct(
                    t["w"].alias("w"),
                    (t["x"] + t["w"] * dx * 2.0).alias("x"),
                    (t["y"] + t["w"] * dy * 2.0).alias("y"),
                ),
            )

        return let(F.get(path, F.lit(0)), moved)

    return let(
        first_point(geom),
        lambda origin: _weighted_mean(
            F.transform(parts(geom), lambda path: moment(path, origin)), origin, 2.0
        ),
    )


def _polygon_centroid(geom: Column) -> Column:
    """Area-weighted centroid; null when there is no area.

    Holes count negatively whatever their winding.
    """

    def cross(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
        return ax * by - bx * ay

    def moment(ring: Column, number: Column, origin: Column) -> Column:
        def oriented(t: Column) -> Column:
            sign = F.signum(t["w"]) * F.when(number == 0, 1.0).otherwise(-1.0)
            return F.struct(
                (t["w"] * sign).alias("w"),
                (t["x"] * sign).alias("x"),
                (t["y"] * sign).alias("y"),
            )

        # going on to the first point closes an open ring; a closed one stays the same
        closed = F.concat(ring, F.slice(ring, 1, 1))
        return let(_walk(closed, origin, cross), oriented)

    def moments(origin: Column) -> Column:
        return F.flatten(
            F.transform(
                geom["polys"],
                lambda poly: F.transform(poly, lambda ring, i: moment(ring, i, origin)),
            )
        )

    return let(
        first_point(geom),
        lambda origin: _weighted_mean(moments(origin), origin, 3.0),
    )


def centroid(geom: Column) -> Column:
    """``struct<x, y>``: the point itself, or the mean weighted by length or area.

    Lines without length and polygons without area fall back to the mean of the vertices.
    """
    weighted = F.when(
        kind(geom).isin("LineString", "MultiLineString"), _line_centroid(geom)
    ).when(kind(geom).isin("Polygon", "MultiPolygon"), _polygon_centroid(geom))
    return F.when(kind(geom) == "Point", first_point(geom)).otherwise(
        F.coalesce(weighted, _mean_of_points(geom))
    )


def centroid_x(geom: Column) -> Column:
    return centroid(geom)["x"]


def centroid_y(geom: Column) -> Column:
    return centroid(geom)["y"]


# --- reprojection -----------------------------------------------------------------


def _map_points(geom: Column, change: Callable[[Column], Column]) -> Column:
    polys = F.transform(
        geom["polys"],
        lambda poly: F.transform(poly, lambda part: F.transform(part, change)),
    )
    return F.when(
        geom.isNotNull(), F.struct(kind(geom).alias("type"), polys.alias("polys"))
    )


def to_wgs84(geom: Column, srid: int) -> Column:
    """Longitude/latitude from EPSG:3857; unchanged when already EPSG:4326."""
    if srid == DEFAULT_SRID:
        return geom
    if srid != WEB_MERCATOR_SRID:
        raise ValueError(f"Cannot reproject from SRID {srid}; use 4326 or 3857.")
    radius = F.lit(EARTH_RADIUS)
    return _map_points(
        geom,
        lambda p: point_struct(
            F.degrees(p["x"] / radius), F.degrees(F.atan(F.sinh(p["y"] / radius)))
        ),
    )


def to_web_mercator(geom: Column, srid: int = DEFAULT_SRID) -> Column:
    """EPSG:3857 metres from longitude/latitude; unchanged when already EPSG:3857."""
    if srid == WEB_MERCATOR_SRID:
        return geom
    if srid != DEFAULT_SRID:
        raise ValueError(f"Cannot reproject from SRID {srid}; use 4326 or 3857.")
    radius = F.lit(EARTH_RADIUS)
    return _map_points(
        geom,
        lambda p: point_struct(
            F.radians(p["x"]) * radius,
            F.ln(F.tan(F.pi() / 4 + F.radians(p["y"]) / 2)) * radius,
        ),
    )


# --- GeoJSON ----------------------------------------------------------------------


def as_geojson(geom: Column) -> Column:
    """GeoJSON text of any geometry kind; null for null."""

    def pair(p: Column) -> Column:
        return F.array(p["x"], p["y"])

    def path(part: Column) -> Column:
        return F.transform(part, pair)

    def paths(poly: Column) -> Column:
        return F.transform(poly, path)

    def text(coordinates: Column) -> Column:
        return F.to_json(
            F.struct(kind(geom).alias("type"), coordinates.alias("coordinates"))
        )

    first_poly = F.get(geom["polys"], F.lit(0))
    first_part = F.get(first_poly, F.lit(0))
    return (
        F.when(kind(geom) == "Point", text(pair(first_point(geom))))
        .when(kind(geom).isin("MultiPoint", "LineString"), text(path(first_part)))
        .when(kind(geom).isin("MultiLineString", "Polygon"), text(paths(first_poly)))
        .when(
            kind(geom) == "MultiPolygon", text(F.transform(geom["polys"], paths))
        )
    )
