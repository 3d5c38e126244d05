"""Feature tables derived from the given tables, as Spark frames and as SQL.

The given tables hold no geometry.  Each customer is placed on the map by arithmetic on
its key, written once and used by both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.functions.geometry import (
    make_line,
    make_multipoint,
    make_point,
    make_polygon,
    point_struct,
)
from quadrille.operators.rows import dealt
from quadrille.sources.columns import points_from_xy, with_srid

# casts keep Spark from reading the constants as decimals
LON = (
    "cast(((c_custkey*7919)%36000) AS double)/cast(100 AS double)-cast(180 AS double)"
)
LAT = (
    "cast(((c_custkey*104729)%17000) AS double)/cast(100 AS double)-cast(85 AS double)"
)
HALF = "cast(0.5 AS double)"
ONE = "cast(1.0 AS double)"

PTS_SQL = f"pts AS (SELECT c_custkey AS k, {LON} AS lon, {LAT} AS lat FROM customer)"

# customers in debt have no longitude; those of the first nations have a latitude that
# is twice too large, so that some of them lie off the map
BAD_SQL = f"""bad AS (
  SELECT c_custkey AS k,
         CASE WHEN c_acctbal >= 0 THEN {LON} END AS lon,
         CASE WHEN c_nationkey < 5 THEN ({LAT})*cast(2 AS double) ELSE {LAT} END AS lat
  FROM customer)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k, lon, lat`` of each customer."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS k", f"{LON} AS lon", f"{LAT} AS lat"
    )


def bad_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS k",
        f"CASE WHEN c_acctbal >= 0 THEN {LON} END AS lon",
        f"CASE WHEN c_nationkey < 5 THEN ({LAT})*cast(2 AS double) ELSE {LAT} END"
        " AS lat",
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points_from_xy(coordinates(spark, sf_dir), "lon", "lat")


def corner(dx: float, dy: float):
    return point_struct(F.col("lon") + F.lit(dx), F.col("lat") + F.lit(dy))


def _bend():
    return F.array(corner(0.0, 0.0), corner(0.5, 0.5), corner(1.0, 0.0))


def _square():
    steps = ((0.0, 0.0), (0.5, 0.0), (0.5, 0.5), (0.0, 0.5), (0.0, 0.0))
    return make_polygon(F.array(F.array(*[corner(x, y) for x, y in steps])))


def _shaped(spark: SparkSession, sf_dir: str, shape) -> DataFrame:
    df = dealt(coordinates(spark, sf_dir), "k").withColumn("geometry", shape)
    return with_srid(df, 4326)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of two segments per customer."""
    return _shaped(spark, sf_dir, make_line(_bend()))


def squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A closed square of half a degree per customer."""
    return _shaped(spark, sf_dir, _square())


def all_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point, three points, a line and a square per customer, in one scan."""
    shapes = F.array(
        make_point(F.col("lon"), F.col("lat")),
        make_multipoint(_bend()),
        make_line(_bend()),
        _square(),
    )
    return _shaped(spark, sf_dir, F.explode(shapes))


# --- SQL pieces -------------------------------------------------------------------



def tile_fraction_x(lon: str, zoom: int) -> str:
    return f"(({lon})+180)/360*{1 << zoom}"


def tile_fraction_y(lat: str, zoom: int) -> str:
    rad = f"radians({lat})"
    return f"(1-ln(tan({rad})+1/cos({rad}))/pi())/2*{1 << zoom}"


def whole_tile(fraction: str, zoom: int) -> str:
    last = (1 << zoom) - 1
    return f"least(greatest(cast(floor({fraction}) AS bigint), 0), {last})"


def quadkey_sql(x: str, y: str, zoom: int) -> str:
    """Quadkey of whole tile numbers, digit by digit."""
    bits = ",".join(str(i) for i in reversed(range(zoom)))
    digit = f"cast(2*((({y}) >> i) & 1) + ((({x}) >> i) & 1) AS varchar)"
    return f"array_to_string(list_transform([{bits}], lambda i: {digit}), '')"


def point_cell_sql(lon: str, lat: str, zoom: int) -> str:
    """Longitudes go round, so 180.5 is -179.5."""
    around = f"({lon})-360*floor((({lon})+180)/360)"
    return quadkey_sql(
        whole_tile(tile_fraction_x(around, zoom), zoom),
        whole_tile(tile_fraction_y(lat, zoom), zoom),
        zoom,
    )


def around_sql(x: str, zoom: int) -> str:
    """A whole column of tiles that may count on beyond the last one, in the grid."""
    side = 1 << zoom
    return f"((({x}) % {side}) + {side}) % {side}"


def line_cells_sql(zoom: int) -> str:
    """CTEs ending in ``line_cells(k, cell)``; needs ``pts``.

    Brute force: every tile of the box around a segment is tested for a stretch of the
    segment, from ``t0`` to ``t1``, that lies in it.  Tiles have no right and no lower
    border of their own; the outer rows reach to the poles.
    """
    fx, fy = tile_fraction_x, tile_fraction_y
    low, high = "cast('-inf' AS double)", "cast('inf' AS double)"

    def enters(start: str, step: str, near: str, far: str) -> str:
        border = f"CASE WHEN {step} > 0 THEN {near} ELSE {far} END"
        return f"CASE WHEN {step} = 0 THEN {low} ELSE (({border}) - {start}) / {step} END"

    def leaves(start: str, step: str, near: str, far: str) -> str:
        border = f"CASE WHEN {step} > 0 THEN {far} ELSE {near} END"
        return f"CASE WHEN {step} = 0 THEN {high} ELSE (({border}) - {start}) / {step} END"

    last = (1 << zoom) - 1
    top = f"CASE WHEN ty = 0 THEN {low} ELSE ty END"
    bottom = f"CASE WHEN ty = {last} THEN {high} ELSE ty + 1 END"

    def at(start: str, end: str) -> str:
        return (
            f"CASE t0 WHEN 0 THEN {start} WHEN 1 THEN {end}"
            f" ELSE {start} + ({end} - {start}) * t0 END"
        )

    return f"""
vertices AS (
  SELECT k, 0 AS i, lon AS x, lat AS y FROM pts
  UNION ALL SELECT k, 1, lon+{HALF}, lat+{HALF} FROM pts
  UNION ALL SELECT k, 2, lon+{ONE}, lat FROM pts),
placed AS (SELECT k, i, {fx('x', zoom)} AS fx, {fy('y', zoom)} AS fy FROM vertices),
segments AS (
  SELECT a.k, a.fx AS x0, a.fy AS y0, b.fx AS x1, b.fy AS y1
  FROM placed a JOIN placed b ON a.k = b.k AND b.i = a.i + 1),
boxes AS (
  SELECT *, unnest(range(cast(floor(least(x0, x1)) AS bigint),
                         cast(floor(greatest(x0, x1)) AS bigint) + 1)) AS tx
  FROM segments),
tested AS (
  SELECT *, unnest(range({whole_tile('least(y0, y1)', zoom)},
                         {whole_tile('greatest(y0, y1)', zoom)} + 1)) AS ty
  FROM boxes),
stretches AS (
  SELECT *,
    greatest(0, {enters('x0', '(x1 - x0)', 'tx', '(tx + 1)')},
             {enters('y0', '(y1 - y0)', top, bottom)}) AS t0,
    least(1, {leaves('x0', '(x1 - x0)', 'tx', '(tx + 1)')},
          {leaves('y0', '(y1 - y0)', top, bottom)}) AS t1
  FROM tested),
line_cells AS (
  SELECT DISTINCT k, {quadkey_sql(around_sql('tx', zoom), 'ty', zoom)} AS cell
  FROM stretches
  WHERE t0 < t1 OR (t0 = t1 AND floor({at('x0', 'x1')}) = tx
                    AND {whole_tile(at('y0', 'y1'), zoom)} = ty))"""


def square_cells_sql(zoom: int) -> str:
    """CTEs ending in ``square_cells(k, cell)``; needs ``pts``.

    Columns of tiles count on beyond the antimeridian and go round at the end.
    """
    side = 1 << zoom

    def column(lon: str) -> str:
        return f"cast(floor({tile_fraction_x(lon, zoom)}) AS bigint)"

    return f"""
ranges AS (
  SELECT k, lon, lat,
    {column('lon')} AS x0,
    {column(f'lon+{HALF}')} AS x1,
    {whole_tile(tile_fraction_y(f'lat+{HALF}', zoom), zoom)} AS y0,
    {whole_tile(tile_fraction_y('lat', zoom), zoom)} AS y1
  FROM pts),
columns_ AS (SELECT *, unnest(range(x0, x1+1)) AS tx FROM ranges),
tiles AS (SELECT *, unnest(range(y0, y1+1)) AS ty FROM columns_),
centres AS (
  SELECT k, lon, lat, tx, ty,
    cast(tx+0.5 AS double)/{side}*360-180 AS cx,
    degrees(atan(sinh(pi()*(1-2*cast(ty+0.5 AS double)/{side})))) AS cy
  FROM tiles),
square_cells AS (
  SELECT k, {quadkey_sql(around_sql('tx', zoom), 'ty', zoom)} AS cell FROM centres
  WHERE cx >= lon AND cx < lon+{HALF} AND cy >= lat AND cy < lat+{HALF})"""
