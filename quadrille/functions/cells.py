"""Grid cells.

The grid is the Web-Mercator quadtree.  A cell id is its quadkey: one digit 0-3 per zoom
level, so the parent at a coarser zoom is a prefix of the text, and text order follows
the Z-curve.  All functions are Catalyst expressions; those that cover lines and polygons
work inside one row, so they need no row key, no shuffle and no explode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import geometry, kind, let, make_point, point_struct, points

# Zoom 17 tiles are about 300 m wide at the equator.
DEFAULT_ZOOM = 17
# Thirty digits are about 4 cm; tile numbers then still fit an integer.
MAX_ZOOM = 30
# Beyond this latitude the projection diverges; the last tile row ends at 85.05 degrees.
_LATITUDE_LIMIT = 89.0


def _tiles_per_side(zoom: int) -> int:
    if not isinstance(zoom, int) or not 1 <= zoom <= MAX_ZOOM:
        raise ValueError(f"zoom must be an integer from 1 to {MAX_ZOOM}, not {zoom!r}.")
    return 1 << zoom


# --- tile arithmetic --------------------------------------------------------------


def tile_column(lon: Column, zoom: int) -> Column:
    """Fractional tile number counted from west to east."""
    side = F.lit(float(_tiles_per_side(zoom)))
    return (lon + F.lit(180.0)) / F.lit(360.0) * side


def tile_row(lat: Column, zoom: int) -> Column:
    """Fractional tile number counted from north to south, of a latitude not null."""
    side = F.lit(float(_tiles_per_side(zoom)))
    bounded = F.least(
        F.greatest(lat, F.lit(-_LATITUDE_LIMIT)), F.lit(_LATITUDE_LIMIT)
    )
    rad = F.radians(bounded)
    return (
        (F.lit(1.0) - F.ln(F.tan(rad) + F.lit(1.0) / F.cos(rad)) / F.pi())
        / F.lit(2.0)
        * side
    )


def _whole_tile(fraction: Column, zoom: int) -> Column:
    """Tile number of a fractional position that is not null, kept inside the grid."""
    last = F.lit(_tiles_per_side(zoom) - 1).cast("bigint")
    return F.least(F.greatest(F.floor(fraction), F.lit(0).cast("bigint")), last)


def tile_x(lon: Column, zoom: int) -> Column:
    """Tile number from west to east; null for null."""
    return F.when(lon.isNotNull(), _whole_tile(tile_column(lon, zoom), zoom))


def tile_y(lat: Column, zoom: int) -> Column:
    """Tile number from north to south; null for null."""
    return F.when(lat.isNotNull(), _whole_tile(tile_row(lat, zoom), zoom))


def tile_edge_lon(number: Column, side: Column) -> Column:
    """Longitude of a (fractional) tile column on a grid of ``side`` tiles."""
    return number / side * F.lit(360.0) - F.lit(180.0)


def tile_edge_lat(number: Column, side: Column) -> Column:
    """Latitude of a (fractional) tile row on a grid of ``side`` tiles."""
    return F.degrees(
        F.atan(F.sinh(F.pi() * (F.lit(1.0) - F.lit(2.0) * number / side)))
    )


def quadkey(x: Column, y: Column, zoom: int) -> Column:
    """Quadkey of a tile.

    A quadkey digit is ``x_bit + 2 * y_bit``.  Read as decimal numbers, the binary texts
    of x and y therefore add up digit by digit without any carry.
    """
    return quadkey_in_row(x, row_digits(y, zoom), zoom)


def _digits_type(zoom: int) -> str:
    return "bigint" if zoom <= 18 else "decimal(31,0)"


def row_digits(y: Column, zoom: int) -> Column:
    """What a row of tiles adds to the digits of its quadkeys."""
    number = _digits_type(zoom)
    return F.bin(y).cast(number) * F.lit(2).cast(number)


def quadkey_in_row(x: Column, digits: Column, zoom: int) -> Column:
    """Quadkey of a tile in the row whose ``row_digits`` are given."""
    number = F.bin(x).cast(_digits_type(zoom)) + digits
    return F.lpad(number.cast("string"), zoom, "0")


def is_cell(cell: Column) -> Column:
    """True when the text is a quadkey."""
    return cell.rlike(f"^[0-3]{{1,{MAX_ZOOM}}}$")


def parent_cell(cell: Column, zoom: int) -> Column:
    """The cell at a coarser zoom that contains the given cell."""
    _tiles_per_side(zoom)
    return F.when(F.length(cell) >= zoom, F.substring(cell, 1, zoom))


# --- cells of geometries ----------------------------------------------------------


def _tile_of_point(x: Column, y: Column, zoom: int) -> tuple[Column, Column]:
    turns = F.floor((x + F.lit(180.0)) / F.lit(360.0))
    inside = (F.abs(y) <= F.lit(90.0)) & (F.abs(x) < F.lit(float("inf")))
    around = F.when(inside, x - turns * F.lit(360.0))
    return tile_x(around, zoom), tile_y(F.when(inside, y), zoom)


def cell_of_point(x: Column, y: Column, zoom: int = DEFAULT_ZOOM) -> Column:
    """Cell id of a coordinate; null for a null part and for places off the globe.

    Longitudes go round, so 180.5 is -179.5 and 180 is -180.  The last row of cells
    reaches to the pole.
    """
    return quadkey(*_tile_of_point(x, y, zoom), zoom)


def cells_of_points(geom: Column, zoom: int = DEFAULT_ZOOM) -> Column:
    """Sorted distinct cell ids of all vertices on the globe."""
    cells = F.transform(points(geom), lambda p: cell_of_point(p["x"], p["y"], zoom))
    return F.sort_array(F.array_compact(F.array_distinct(cells)))


# Runs are the form in which covers of lines and polygons are made and carried from task
# to task: ``array<struct<row, first, last>>``, stretches of tiles in one row of the grid.
# They are sorted, do not overlap, and are few compared with their cells.
#
# The expressions are long, so they are written as SQL text, which the parser takes at
# once; building them from columns would cost a call to the JVM for each operator.


def _let_sql(name: str, value: str, body: str) -> str:
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _column_sql(lon: str, side: int) -> str:
    return f"(({lon} + 180D) / 360D * {side}D)"


def _row_sql(lat: str, side: int) -> str:
    rad = f"radians(least(greatest({lat}, -{_LATITUDE_LIMIT}D), {_LATITUDE_LIMIT}D))"
    return f"((1D - ln(tan({rad}) + 1D / cos({rad})) / pi()) / 2D * {side}D)"


def _run_sql(row: str, first: str, last: str) -> str:
    return f"struct({row} AS row, {first} AS first, {last} AS last)"


def point_runs(geom: Column, zoom: int = DEFAULT_ZOOM) -> Column:
    """Runs of one cell each, distinct, of all vertices on the globe; in no order."""

    def place(p: Column) -> Column:
        x, y = _tile_of_point(p["x"], p["y"], zoom)
        return F.shiftleft(y.cast("bigint"), 32) + x

    def run(place: Column) -> Column:
        number = place.bitwiseAND(F.lit(0xFFFFFFFF))
        row = F.shiftright(place, 32)
        return F.struct(row.alias("row"), number.alias("first"), number.alias("last"))

    # as numbers, which are told apart by hash and not pair by pair
    places = F.array_compact(F.array_distinct(F.transform(points(geom), place)))
    return F.transform(places, run)


def _of_geometry(geom: Column, body: str) -> Column:
    """The value of an SQL expression over the geometry ``g``."""
    # wrapped once, so that the geometry is evaluated once
    found = F.call_function("transform", F.array(geom), F.expr(f"g -> {body}"))
    return F.when(geom.isNotNull(), F.get(found, F.lit(0)))


def line_runs(geom: Column, zoom: int = DEFAULT_ZOOM) -> Column:
    """Runs of the cells that a line touches: every cell some point of it lies in.

    Segments are straight on the projected map and go the shorter way round the globe, so
    a line may cross the antimeridian, with longitudes that jump there or with ones that
    go on beyond 180.  A segment is followed from border to border of the rows it crosses,
    and what it touches between two borders is one run; the work grows with the rows.
    Vertices without finite coordinates are left out.
    """
    side = _tiles_per_side(zoom)

    def row_of(y: str) -> str:
        return f"least(greatest(floor({y}), 0L), {side - 1}L)"

    def at(border: str) -> str:
        return f"e.x0 + (e.x1 - e.x0) * ({border} - e.y0) / (e.y1 - e.y0)"

    # the lower border of a row belongs to the next one
    of_row = _let_sql(
        "s",
        f"struct(if(r = e.top, e.x0, {at('r')}) AS x0,"
        f" if(r = e.bottom, e.x1, {at('(r + 1)')}) AS x1)",
        _run_sql(
            "r",
            "floor(least(s.x0, s.x1))",
            "greatest(floor(s.x0), if(r = e.bottom, floor(s.x1), ceil(s.x1) - 1))",
        ),
    )
    segment = _let_sql(
        "far",
        _shorter_way_sql("a.x", "b.x", side),
        _let_sql(
            "e",
            "struct(if(a.y <= b.y, a.x, far) AS x0, least(a.y, b.y) AS y0,"
            " if(a.y <= b.y, far, a.x) AS x1, greatest(a.y, b.y) AS y1,"
            f" {row_of('least(a.y, b.y)')} AS top, {row_of('greatest(a.y, b.y)')} AS bottom)",
            f"transform(sequence(e.top, e.bottom), r -> {of_row})",
        ),
    )
    # a single vertex is a segment of its own
    begins = "slice(path, 1, greatest(size(path) - 1, least(size(path), 1)))"
    goes_on = "if(size(path) = 1, path, slice(path, 2, size(path)))"
    along = f"flatten(zip_with({begins}, {goes_on}, (a, b) -> {segment}))"
    finite = "abs(p.x) < double('infinity') AND abs(p.y) < double('infinity')"
    placed = f"""transform(filter(path, p -> {finite}),
        p -> struct({_column_sql("p.x", side)} AS x, {_row_sql("p.y", side)} AS y))"""
    paths = f"transform(flatten(g.polys), path -> {placed})"
    found = f"flatten(transform({paths}, path -> {along}))"
    wrapped = _let_sql("runs", found, _wrapped_sql(side))
    return _of_geometry(geom, _let_sql("runs", wrapped, _UNITED))


def _shorter_way_sql(x: str, other: str, turn: int) -> str:
    """``other`` moved by whole turns to within half a turn of ``x``.

    What is whole turns away stays, as a line once round the globe is meant as one.
    """
    gap = f"({other} - {x})"
    turns = f"round({gap} / {turn}D) * {turn}D"
    return f"if(abs({gap}) <= {turn / 2}D OR {gap} = {turns}, {other}, {other} - {turns})"


def _wrapped_sql(side: int) -> str:
    """``runs`` whose columns count on beyond the last one, brought into the grid."""
    last = f"{side - 1}L"
    near = _run_sql("r.row", "f", f"least(f + r.last - r.first, {last})")
    over = _run_sql("r.row", "0L", f"f + r.last - r.first - {side}L")
    inside = _let_sql(
        "f",
        f"pmod(r.first, {side}L)",
        f"""CASE WHEN r.last - r.first >= {last} THEN array({_run_sql("r.row", "0L", last)})
                 WHEN f + r.last - r.first <= {last} THEN array({near})
                 ELSE array({near}, {over}) END""",
    )
    outside = f"exists(runs, r -> r.first < 0 OR r.last > {last})"
    return f"if({outside}, flatten(transform(runs, r -> {inside})), runs)"


#: ``runs`` sorted, and merged where they overlap or touch.  A sweep: starts and ends are
#: sorted by themselves, and a gap lies where the n-th end comes before the next start.
#: Apart from sorting, the work is linear.  A place in the grid is one number, row first.
_UNITED = _let_sql(
    "w",
    """struct(sort_array(transform(runs, r -> shiftleft(r.row, 32) + r.first)) AS s,
              sort_array(transform(runs, r -> shiftleft(r.row, 32) + r.last + 1)) AS e)""",
    """zip_with(filter(w.s, (p, i) -> i = 0 OR get(w.e, i - 1) < p),
                filter(w.e, (p, i) -> i = size(w.e) - 1 OR p < get(w.s, i + 1)),
                (p, q) -> struct(shiftright(p, 32) AS row, p & 4294967295L AS first,
                                 (q - 1) & 4294967295L AS last))""",
)


def polygon_runs(geom: Column, zoom: int = DEFAULT_ZOOM) -> Column:
    """Runs of the cells whose centre lies in a polygon.

    Works by rows of tiles: every edge gives its crossings with the centre lines of the
    rows it spans; between each odd and the following even crossing of a row lie the
    cells inside (even-odd rule).  The work grows with the outline and the runs, not with
    the bounding box, and no candidate cell is ever tested and thrown away.

    A polygon may cross the antimeridian with longitudes that go on beyond 180, or with
    ones that jump there.  Shells are taken to be counterclockwise and holes clockwise: if
    an edge spans more than 180 degrees and the ring as it is written turns the other way,
    its edges go the shorter way round the globe.  Such a ring that goes round the globe
    covers the nearer pole.  A polygon with a ring that is 360 degrees wide, or wider, is
    taken as it is written and cut off at the antimeridian.
    """
    side = _tiles_per_side(zoom)
    last = f"{side - 1}L"
    north, south = (
        _row_sql(f"{pick}(a.y, b.y)", side) for pick in ("greatest", "least")
    )
    first_row = f"greatest(floor({north} - 0.5D) + 1, 0L)"

    def crossings(far: str) -> str:
        """Where the edge from ``a`` to ``b``, whose longitude is ``far``, meets rows."""
        lat = f"degrees(atan(sinh(pi() * (1D - 2D * (r + 0.5D) / {side}D))))"
        lon = f"(a.x + ({lat} - a.y) * ({far} - a.x) / (b.y - a.y))"
        # an edge between two centre lines (or a level one) spans no row
        return _let_sql(
            "s",
            f"struct({first_row} AS first, least(floor({south} - 0.5D), {last}) AS last)",
            f"""if(s.first <= s.last,
                   transform(sequence(s.first, s.last),
                             r -> struct(r AS row, {_column_sql(lon, side)} AS x)),
                   cast(array() AS array<struct<row:bigint,x:double>>))""",
        )

    # joining the last point to the first closes an open ring and is without effect on a
    # closed one
    following = "concat(slice(ring, 2, size(ring)), slice(ring, 1, 1))"

    def edges(value: str) -> str:
        return f"zip_with(ring, {following}, (a, b) -> {value})"

    # a ring with an edge of more than half a turn, of the direction that it would not have
    # if it lay as written; the first ring is the shell
    width = "(array_max(ring.x) - array_min(ring.x))"
    doubled = f"aggregate({edges('(b.x - a.x) * (b.y + a.y)')}, 0D, (t, v) -> t + v)"
    jumps = f"""({width} > 180D AND exists({edges('abs(b.x - a.x)')}, gap -> gap > 180D)
                 AND ({doubled} > -1e-6D) = (n = 0))"""

    # an edge on a grid without ends, and the first row south of where it meets the seam;
    # the same numbers decide the side of a crossing and that row
    lap = f"floor(c.x / {side}D)"
    ends = [_column_sql(f"if(a.y >= b.y, {x})", side) for x in ("a.x, far", "far, a.x")]
    around = _let_sql(
        "far",
        f"if(jump, {_shorter_way_sql('a.x', 'b.x', 360)}, b.x)",
        _let_sql(
            "m",
            f"struct({crossings('far')} AS met, floor({ends[0]} / {side}D) AS north,"
            f" floor({ends[1]} / {side}D) AS south, least({first_row}, {side}L) AS first)",
            f"""struct(
                transform(m.met, c -> struct(c.row AS row, c.x - {lap} * {side}D AS x)) AS met,
                if(m.north = m.south, cast(array() AS array<bigint>),
                   array(m.first + size(filter(m.met, c -> {lap} = m.north)))) AS seam)""",
        ),
    )
    # a point of the seam is inside if an odd number of edges meet the seam north of it;
    # an odd number in all means that the ring goes round the globe
    pole = f"if(aggregate(flatten(poly).y, 0D, (t, y) -> t + y) > 0, 0L, {side}L)"
    starts = _let_sql(
        "found",
        "flatten(edges.seam)",
        f"sort_array(if(size(found) % 2 = 1, concat(found, array({pole})), found))",
    )
    rows = """flatten(zip_with(filter(starts, (v, i) -> i % 2 = 0),
                               filter(starts, (v, i) -> i % 2 = 1),
        (v, w) -> if(v < w, sequence(v, w - 1), cast(array() AS array<bigint>))))"""
    borders = f"array(struct(r AS row, 0D AS x), struct(r AS row, {side}D AS x))"
    of_rings = f"""flatten(transform(poly, (ring, n) ->
                                     {_let_sql("jump", jumps, edges(around))}))"""
    toggles = _let_sql(
        "edges",
        of_rings,
        "concat(flatten(edges.met), "
        + _let_sql("starts", starts, f"flatten(transform({rows}, r -> {borders}))")
        + ")",
    )
    goes_around = f"""NOT exists(poly, ring -> {width} >= 360D)
        AND (exists(poly, ring -> array_min(ring.x) < -180D OR array_max(ring.x) > 180D)
             OR exists(transform(slice(poly, 1, 1), (ring, n) -> {jumps}), jump -> jump))"""
    written = edges(crossings("b.x"))
    as_written = f"flatten(flatten(transform(poly, ring -> {written})))"
    pair = _run_sql(
        "v.row",
        "greatest(ceil(v.x - 0.5D), 0L)",
        f"least(ceil(w.x - 0.5D) - 1, {last})",
    )
    of_polygon = _let_sql(
        "c",
        f"sort_array(if({goes_around}, {toggles}, {as_written}))",
        f"""filter(zip_with(filter(c, (v, i) -> i % 2 = 0), filter(c, (v, i) -> i % 2 = 1),
                            (v, w) -> {pair}), r -> r.first <= r.last)""",
    )
    found = f"flatten(transform(g.polys, poly -> {of_polygon}))"
    # the runs of one polygon are in order and apart already
    united = f"if(g.type = 'MultiPolygon', {_UNITED}, runs)"
    return _of_geometry(geom, _let_sql("runs", found, united))


def cell_runs(geom: Column, zoom: int = DEFAULT_ZOOM) -> Column:
    """Runs of any geometry, those of points in no order; null for null."""
    return (
        F.when(kind(geom).isin("Point", "MultiPoint"), point_runs(geom, zoom))
        .when(kind(geom).isin("LineString", "MultiLineString"), line_runs(geom, zoom))
        .when(kind(geom).isin("Polygon", "MultiPolygon"), polygon_runs(geom, zoom))
    )


def _cells_of_runs(runs: Column, zoom: int) -> Column:
    def cells_of_run(run: Column) -> Column:
        return let(
            row_digits(run["row"], zoom),
            lambda digits: F.transform(
                F.sequence(run["first"], run["last"]),
                lambda x: quadkey_in_row(x, digits, zoom),
            ),
        )

    return F.sort_array(F.flatten(F.transform(runs, cells_of_run)))


def cells_of_line(geom: Column, zoom: int = DEFAULT_ZOOM) -> Column:
    """Sorted distinct ids of the cells that a line touches (see ``line_runs``).

    The whole list is one value; ``cell_cover`` gives a row per cell.
    """
    return _cells_of_runs(line_runs(geom, zoom), zoom)


def cells_of_polygon(geom: Column, zoom: int = DEFAULT_ZOOM) -> Column:
    """Sorted ids of the cells whose centre lies in the polygon.

    The whole list is one value.  To cover large polygons with small cells, use
    ``cell_cover``, which gives a row per cell.
    """
    return _cells_of_runs(polygon_runs(geom, zoom), zoom)


def cells_of(geom: Column, zoom: int = DEFAULT_ZOOM) -> Column:
    """Array of the cell ids of any geometry; null for null."""
    return (
        F.when(kind(geom).isin("Point", "MultiPoint"), cells_of_points(geom, zoom))
        .when(
            kind(geom).isin("LineString", "MultiLineString"), cells_of_line(geom, zoom)
        )
        .when(
            kind(geom).isin("Polygon", "MultiPolygon"), cells_of_polygon(geom, zoom)
        )
    )


# --- geometries of cells ----------------------------------------------------------


def _tile_of(cell: Column) -> Column:
    """``struct<x, y, side>`` of a quadkey, from its digits read as two binary numbers."""

    def bits(digits: str) -> Column:
        return F.conv(F.translate(cell, "0123", digits), 2, 10).cast("double")

    side = F.pow(F.lit(2.0), F.length(cell))
    return F.struct(
        bits("0101").alias("x"), bits("0011").alias("y"), side.alias("side")
    )


def cell_polygon(cell: Column) -> Column:
    """Closed outline of a cell, anticlockwise from the south-west corner.

    Null when the text is not a cell id.
    """

    def outline(t: Column) -> Column:
        west = tile_edge_lon(t["x"], t["side"])
        east = tile_edge_lon(t["x"] + 1, t["side"])
        north = tile_edge_lat(t["y"], t["side"])
        south = tile_edge_lat(t["y"] + 1, t["side"])
        corners = [
            (west, south), (east, south), (east, north), (west, north), (west, south),
        ]
        ring = F.array(*[point_struct(x, y) for x, y in corners])
        return geometry("Polygon", F.array(F.array(ring)))

    return F.when(is_cell(cell), let(_tile_of(cell), outline))


def cell_centre(cell: Column) -> Column:
    """Centre point of a cell; null when the text is not a cell id."""
    return F.when(
        is_cell(cell),
        let(
            _tile_of(cell),
            lambda t: make_point(
                tile_edge_lon(t["x"] + 0.5, t["side"]),
                tile_edge_lat(t["y"] + 0.5, t["side"]),
            ),
        ),
    )
