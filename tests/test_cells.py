"""Cell functions against brute force on small fixtures."""

import json
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from shapes import EXAMPLES, frame

from quadrille.functions import cells as c
from quadrille.operators.rows import cell_cover, cell_rollup
from quadrille.sinks.exports import export_cells
from quadrille.sources.columns import polygons_from_cells
from workload import inputs


def fraction(lon, lat, zoom):
    rad = math.radians(max(-89.0, min(89.0, lat)))
    y = (1 - math.log(math.tan(rad) + 1 / math.cos(rad)) / math.pi) / 2
    return (lon + 180) / 360 * 2**zoom, y * 2**zoom


def key(x, y, zoom):
    last = 2**zoom - 1
    x, y = (min(max(math.floor(v), 0), last) for v in (x, y))
    return "".join(
        str(2 * (y >> i & 1) + (x >> i & 1)) for i in reversed(range(zoom))
    )


def cell_at(lon, lat, zoom):
    return key(*fraction(lon, lat, zoom), zoom)


def cell_around(lon, lat, zoom):
    """Longitude 180 is -180."""
    return cell_at(lon - 360 * math.floor((lon + 180) / 360), lat, zoom)


def inside(lon, lat, rings):
    """Even-odd rule, edge by edge."""
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > lat) != (y2 > lat):
                if lon < x1 + (lat - y1) * (x2 - x1) / (y2 - y1):
                    odd = not odd
    return odd


def polygon_cells(polys, zoom):
    """Test the centre of every tile of the world."""
    found = set()
    side = 2**zoom
    for ty in range(side):
        lat = math.degrees(math.atan(math.sinh(math.pi * (1 - 2 * (ty + 0.5) / side))))
        for tx in range(side):
            lon = (tx + 0.5) / side * 360 - 180
            if any(inside(lon, lat, rings) for rings in polys):
                found.add(key(tx, ty, zoom))
    return sorted(found)


def unwrapped(ring):
    """Longitudes that go on where those of the ring jump from 180 to -180."""
    out, turns = [], 0
    for k, (x, y) in enumerate(ring):
        if k:
            gap = x - ring[k - 1][0]
            turns -= round(gap / 360) if abs(gap) > 180 else 0
        out.append((x + 360 * turns, y))
    return out


def polygon_cells_around(rings, zoom):
    """Test every centre, and the same place some turns further, against each ring."""
    found = set()
    side = 2**zoom
    rings = [unwrapped(ring) for ring in rings]
    for ty in range(side):
        lat = math.degrees(math.atan(math.sinh(math.pi * (1 - 2 * (ty + 0.5) / side))))
        for tx in range(side):
            lon = (tx + 0.5) / side * 360 - 180
            hits = [inside(lon + 360 * k, lat, [r]) for r in rings for k in (-2, -1, 0, 1, 2)]
            if sum(hits) % 2:
                found.add(key(tx, ty, zoom))
    return sorted(found)


def line_cells(paths, zoom):
    """Test every tile of the box around each segment for a stretch of the segment in it.

    Columns count on where a segment crosses the antimeridian; the outer rows reach to
    the poles.
    """
    found = set()
    side = 2**zoom
    for path in paths:
        found |= {cell_around(x, y, zoom) for x, y in path}
        for a, b in zip(path, path[1:]):
            (x0, y0), (x1, y1) = fraction(*a, zoom), fraction(*b, zoom)
            if abs(x1 - x0) > side / 2:
                x1 -= side * round((x1 - x0) / side)
            low, high = sorted((x0, x1))
            tx = np.arange(math.floor(low), math.floor(high) + 1)[:, None]
            low, high = (min(max(math.floor(v), 0), side - 1) for v in sorted((y0, y1)))
            ty = np.arange(low, high + 1)[None, :]
            north = np.where(ty == 0, -np.inf, ty)
            south = np.where(ty == side - 1, np.inf, ty + 1)
            enter, leave = np.zeros((1, 1)), np.ones((1, 1))
            for start, step, near, far in ((x0, x1 - x0, tx, tx + 1), (y0, y1 - y0, north, south)):
                if step:
                    borders = (near - start) / step, (far - start) / step
                    enter = np.maximum(enter, np.minimum(*borders))
                    leave = np.minimum(leave, np.maximum(*borders))
            for i, j in zip(*np.nonzero(enter < leave)):
                found.add(key(int(tx[i, 0]) % side, int(ty[0, j]), zoom))
    return sorted(found)


def star(rng, centre, radius, corners):
    """A closed star-shaped ring; neighbouring corners differ much in distance."""
    ring = []
    for i in range(corners):
        angle = 2 * math.pi * i / corners
        r = radius * rng.uniform(0.2, 1.0)
        ring.append((centre[0] + r * math.cos(angle), centre[1] + r * math.sin(angle)))
    return ring + ring[:1]


def covers(spark, geometries, function, zoom):
    df = frame(spark, geometries)
    rows = df.select("id", function(F.col("geometry"), zoom).alias("v")).orderBy("id")
    return [r["v"] for r in rows.collect()]


def test_polygons_against_brute_force(spark):
    rng = random.Random(7)
    geometries = []
    for _ in range(12):
        centre = rng.uniform(-150, 150), rng.uniform(-70, 70)
        shell = star(rng, centre, 40, rng.randint(3, 25))
        hole = star(rng, centre, 6, 9)
        geometries.append(("Polygon", [[shell, hole]]))
    for zoom in (3, 5, 6):
        found = covers(spark, geometries, c.cells_of_polygon, zoom)
        assert found == [polygon_cells_around(polys[0], zoom) for _, polys in geometries]
    assert any(found)


def test_polygon_variants(spark):
    ring = [(-30.0, -20.0), (33.0, -21.0), (35.0, 44.0), (-31.0, 45.0)]
    closed = ring + ring[:1]
    overlapping = [(x + 20, y + 10) for x, y in closed]
    world = [(-200.0, -90.0), (200.0, -90.0), (200.0, 90.0), (-200.0, 90.0)]
    level = [(0.0, 0.0), (10.0, 0.0), (20.0, 0.0), (20.0, 30.0), (0.0, 30.0), (0.0, 0.0)]
    tiny = [(0.001, 0.001), (0.002, 0.001), (0.002, 0.002), (0.001, 0.001)]
    geometries = [
        ("Polygon", [[ring]]),
        ("Polygon", [[closed]]),
        ("Polygon", [[closed[::-1]]]),
        ("MultiPolygon", [[closed], [overlapping]]),
        ("Polygon", [[world]]),
        ("Polygon", [[level]]),
        ("Polygon", [[tiny]]),
        ("Polygon", []),
        None,
    ]
    found = covers(spark, geometries, c.cells_of_polygon, 4)
    assert found[0] == found[1] == found[2] == polygon_cells([[ring]], 4)
    assert found[3] == polygon_cells([[closed], [overlapping]], 4)
    assert len(found[4]) == 256
    assert found[5] == polygon_cells([[level]], 4)
    assert found[6:] == [[], [], None]


def test_members_of_a_multipolygon_are_united(spark):
    """Also when, against the rules, several members overlap or lie in one another."""
    rng = random.Random(13)
    geometries = []
    for members in (2, 3, 6):
        polys = [[star(rng, (rng.uniform(-60, 60), 10), 50, 12)] for _ in range(members)]
        geometries.append(("MultiPolygon", polys))
    big = [(-80.0, -60.0), (80.0, -60.0), (80.0, 60.0), (-80.0, 60.0), (-80.0, -60.0)]
    small = [(x / 3, y / 3) for x, y in big]
    geometries.append(("MultiPolygon", [[small], [big], [small]]))
    geometries.append(("MultiPolygon", [[small]]))
    geometries += [("MultiPolygon", []), None]
    found = covers(spark, geometries, c.cells_of_polygon, 6)
    expected = [polygon_cells(polys, 6) for _, polys in geometries[:-1]]
    assert found == [*expected, None]


def test_cover_gives_a_row_per_cell(spark):
    geometries = [*EXAMPLES.values(), None, ("Polygon", [])]
    df = frame(spark, geometries)
    rows = cell_cover(df, 8).collect()
    lists = covers(spark, geometries, c.cells_of, 8)
    expected = sorted((i, cell) for i, cells in enumerate(lists) for cell in cells or ())
    assert sorted((r["id"], r["cell"]) for r in rows) == expected


def test_cover_never_gathers_the_cells_of_a_large_polygon(spark):
    """Nearly a billion cells lie in this square; counting them by runs holds none of them."""
    half = [(-90.0, -60.0), (90.0, -60.0), (90.0, 60.0), (-90.0, 60.0), (-90.0, -60.0)]
    df = frame(spark, [("Polygon", [[half]])])
    runs = df.select(F.inline(c.polygon_runs(F.col("geometry"), 16)))
    row = runs.agg(F.count("*"), F.sum(F.col("last") - F.col("first") + 1)).first()
    north, south = (fraction(0, lat, 16)[1] for lat in (60, -60))
    rows = math.floor(south - 0.5) - math.floor(north - 0.5)
    assert tuple(row) == (rows, rows * 2**15)


def test_lines_against_brute_force(spark):
    rng = random.Random(11)

    def path(n):
        return [(rng.uniform(-180, 180), rng.uniform(-84, 84)) for _ in range(n)]

    geometries = [("LineString", [[path(n)]]) for n in (2, 3, 8, 20)]
    geometries.append(("MultiLineString", [[path(4), path(5)]]))
    geometries.append(("LineString", [[path(1)]]))
    geometries += [("LineString", []), None]
    for zoom in (1, 6, 9):
        found = covers(spark, geometries, c.cells_of_line, zoom)
        expected = [line_cells(polys[0], zoom) for _, polys in geometries[:6]]
        assert found == [*expected, [], None]


def test_lines_across_the_antimeridian(spark):
    lines_ = [
        [(179.9, 0.0), (181.0, 40.0)],
        [(179.9, 0.0), (-179.0, 40.0)],  # the same, written otherwise
        [(-179.9, 10.0), (179.5, -30.0), (-170.0, -80.0), (170.0, 86.0)],
        [(180.0, 5.0), (-180.0, 30.0)],  # once round the globe
        [(150.0, 5.0), (-150.0, 5.0)],
        [(-541.0, 20.0), (-539.0, 20.5)],
        [(0.0, 89.9), (0.0, -90.0)],
        [(-10.0, 95.0), (20.0, 88.0)],
        [(12.0, float("nan")), (13.0, 14.0), (float("inf"), 3.0)],
    ]
    geometries = [("LineString", [[path]]) for path in lines_]
    for zoom in (6, 8):
        found = covers(spark, geometries, c.cells_of_line, zoom)
        assert found[:3] == [line_cells([path], zoom) for path in lines_[:3]]
        assert found[4:8] == [line_cells([path], zoom) for path in lines_[4:8]]
        assert found[0] == found[1] and cell_around(181, 40, zoom) in found[0]
        # nothing beside the path: it leaves the east at 3.6 degrees north
        bits = [str.maketrans("0123", t) for t in ("0101", "0011")]
        tiles = [[int(k.translate(b), 2) for b in bits] for k in found[0]]
        assert {0, 2**zoom - 1} <= {x for x, _ in tiles} <= {0, 1, 2**zoom - 1}
        assert all(x == 0 or y >= math.floor(fraction(0, 3.7, zoom)[1]) for x, y in tiles)
        assert len(found[3]) >= 2**zoom
        assert found[8] == [cell_at(13.0, 14.0, zoom)]


def test_a_line_through_corners(spark):
    """Through a corner of four tiles: two of them are touched, and those beside are not."""
    side = 2**5
    west = -180 + 360 * 20 / side

    def lat(row):
        return math.degrees(math.atan(math.sinh(math.pi * (1 - 2 * row / side))))

    # half a tile before the corner to half a tile behind it, down and up
    half = 360 / side / 2
    down = [(west - half, lat(9.5)), (west + half, lat(10.5))]
    along = [(west - half, lat(9.25)), (west + 3 * half, lat(9.25))]
    found = covers(
        spark, [("LineString", [[p]]) for p in (down, down[::-1], along)], c.cells_of_line, 5
    )
    assert set(found[0]) >= {key(19, 9, 5), key(20, 10, 5)} and len(found[0]) <= 3
    assert set(found[1]) >= {key(19, 9, 5), key(20, 10, 5)} and len(found[1]) <= 3
    assert found[2] == sorted(key(x, 9, 5) for x in (19, 20, 21))


def test_polygons_across_the_antimeridian(spark):
    rng = random.Random(17)

    def wrapped(ring):
        return [(x - 360 * math.floor((x + 180) / 360), y) for x, y in ring]

    shells = [star(rng, (rng.choice([180, -180, 175]), rng.uniform(-60, 60)), 30, 15) for _ in range(6)]
    holes = [star(rng, (sum(x for x, _ in s) / len(s), s[0][1]), 4, 7)[::-1] for s in shells]
    geometries = [("Polygon", [[s, h]]) for s, h in zip(shells, holes)]
    geometries += [("Polygon", [[wrapped(s), wrapped(h)]]) for s, h in zip(shells, holes)]
    geometries += [("Polygon", [[s, wrapped(h)]]) for s, h in zip(shells, holes)]
    for zoom in (4, 6):
        found = covers(spark, geometries, c.cells_of_polygon, zoom)
        expected = [polygon_cells_around(polys[0], zoom) for _, polys in geometries[:6]]
        assert found[:6] == found[6:12] == found[12:] == expected
        sides = [{"west" if k[0] in "02" else "east" for k in cells} for cells in found]
        assert sum(len(names) == 2 for names in sides) >= 6


def test_polygons_at_the_seam(spark):
    def box(west, east, south=-20.0, north=20.0):
        return [(west, south), (east, south), (east, north), (west, north), (west, south)]

    hole = box(179.5, -179.5, -5.0, 5.0)[::-1]

    def cells(*bands):
        return sorted({cell for w, e in bands for cell in polygon_cells([[box(w, e)]], 5)})

    geometries = [
        ("Polygon", [[box(170.0, 180.0)]]),
        ("Polygon", [[box(-180.0, -160.0)]]),
        ("Polygon", [[box(170.0, 200.0)]]),
        ("Polygon", [[box(170.0, -160.0)]]),
        ("Polygon", [[box(-190.0, -160.0)]]),
        ("MultiPolygon", [[box(170.0, 180.0)], [box(-180.0, -160.0)]]),
        ("MultiPolygon", [[box(170.0, 200.0)], [box(150.0, -170.0)]]),
        ("Polygon", [[box(-180.0, 180.0)]]),
        ("Polygon", [[box(150.0, 210.0), hole]]),
        ("Polygon", [[box(150.0, -150.0), hole]]),
        ("Polygon", [[box(-170.0, 170.0)]]),
        ("Polygon", [[box(-185.0, 100.0)]]),
    ]
    found = covers(spark, geometries, c.cells_of_polygon, 5)
    both = cells((170, 180), (-180, -160))
    assert found[0] == cells((170, 180)) and found[1] == cells((-180, -160))
    assert found[2] == found[3] == found[5] == both
    assert found[4] == cells((170, 180), (-180, -160))
    assert found[6] == cells((150, 180), (-180, -160))
    assert len(found[7]) == 32 * len({k for k in polygon_cells([[box(0.0, 20.0)]], 5)}) / 2
    assert found[8] == found[9]
    assert found[8] == polygon_cells_around([box(150.0, 210.0), box(179.5, 180.5, -5.0, 5.0)], 5)
    assert found[10] == cells((-170, 170))
    assert found[11] == cells((-180, 100), (175, 180))


def test_rings_round_a_pole(spark):
    north = [(float(x), 70.0 + 5 * (x % 40 == 0)) for x in range(-170, 190, 20)]
    south = [(x, -y) for x, y in reversed(north)]
    found = covers(
        spark, [("Polygon", [[r + r[:1]]]) for r in (north, south)], c.cells_of_polygon, 5
    )
    for cells, sign in zip(found, (1, -1)):
        centres = [
            (x, y)
            for x in range(32)
            for y in range(32)
            if sign * math.degrees(math.atan(math.sinh(math.pi * (1 - (2 * y + 1) / 32)))) > 75
        ]
        assert {key(x, y, 5) for x, y in centres} <= set(cells)
        assert len(cells) < 32 * 8


def test_many_overlapping_runs_are_united_in_one_sweep(spark):
    """Merging rebuilds no list: ten times the members take about ten times as long."""

    def seconds(members):
        place = F.col("id") / F.lit(members) * 170
        ring = F.array(
            *[
                F.struct((place - 80 + x).alias("x"), F.lit(y).alias("y"))
                for x, y in ((0.0, 0.0), (3.0, 0.0), (3.0, 0.5), (0.0, 0.5), (0.0, 0.0))
            ]
        )
        rows = spark.range(members).agg(F.collect_list(F.array(ring)).alias("polys"))
        geom = F.struct(F.lit("MultiPolygon").alias("type"), F.col("polys"))
        runs = rows.select(F.explode(c.polygon_runs(geom, 11)).alias("r"))
        start = time.perf_counter()
        found = runs.select("r.*").collect()
        return time.perf_counter() - start, found

    seconds(100)
    few, _ = seconds(10_000)
    many, found = seconds(100_000)
    assert many < 40 * few + 2
    # one run in each row, from the first square to the last
    assert len(found) == len({r["row"] for r in found}) == 3
    assert {r["first"] for r in found} == {math.ceil(fraction(-80, 0, 11)[0] - 0.5)}


def test_cover_deals_the_runs_of_lines(spark):
    """A line round the globe at a fine zoom: cells are made from runs, in many tasks."""
    df = frame(spark, [("LineString", [[[(-170.0, 10.0), (0.0, 10.0), (170.0, 10.0)]]])])
    cover = cell_cover(df, 20)
    tasks = cover.groupBy(F.spark_partition_id()).count().collect()
    first, last = (math.floor(fraction(x, 10, 20)[0]) for x in (-170, 170))
    assert sum(r["count"] for r in tasks) == last - first + 1
    assert max(r["count"] for r in tasks) < 0.4 * (last - first)


def test_cover_of_long_and_many_runs(spark):
    """More stretches than a piece holds, runs longer than a stretch, and no runs."""
    band = [(-90.0, -1.0), (90.0, -1.0), (90.0, 1.0), (-90.0, 1.0), (-90.0, -1.0)]
    geometries = [("Polygon", [[band]]), ("LineString", [[[(1.0, -40.0), (2.0, 40.0)]]])]
    geometries += [("Polygon", []), ("MultiPoint", [[[]]]), None]
    df = frame(spark, geometries)
    found = cell_cover(df, 14).groupBy("id").agg(F.count("*"), F.count_distinct("cell"))
    lists = covers(spark, geometries, c.cells_of, 14)
    sizes = [(i, len(cells)) for i, cells in enumerate(lists) if cells]
    assert sorted((r[0], r[1]) for r in found.collect()) == sizes
    assert all(r[1] == r[2] for r in found.collect())
    assert sizes[0][1] > 4096 * 100


def test_cover_of_points(spark):
    """Equal cells once, none for places off the globe, longitudes go round."""
    odd = [(180.5, 1.0), (-179.5, 1.0), (0.0, 91.0), (math.nan, 0.0), (0.0, math.inf)]
    odd += [(math.inf, 0.0), (None, 1.0), (1.0, None), (0.0, 90.0), (0.0, -90.0)]
    geometries = [("MultiPoint", [[odd]]), *[("Point", [[[p]]]) for p in odd]]
    for zoom in (1, 18, 19, 30):
        rows = cell_cover(frame(spark, geometries), zoom).collect()
        lists = covers(spark, geometries, c.cells_of, zoom)
        expected = sorted((i, cell) for i, cells in enumerate(lists) for cell in cells)
        assert sorted((r["id"], r["cell"]) for r in rows) == expected


@pytest.mark.parametrize("shaped", [inputs.all_shapes, inputs.lines, inputs.squares])
def test_shapes_of_one_row_group_are_dealt_to_all_tasks(spark, shaped):
    df = shaped(spark, "/root/testdata/sf0.001")
    tasks = df.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_line_is_a_chain_of_neighbours(spark):
    line = ("LineString", [[[(-3.3, 1.1), (17.7, 9.2)]]])
    (cells,) = covers(spark, [line], c.cells_of_line, 8)
    tiles = sorted(
        (
            int(k.translate(str.maketrans("0123", "0101")), 2),
            int(k.translate(str.maketrans("0123", "0011")), 2),
        )
        for k in cells
    )
    for (x0, y0), (x1, y1) in zip(tiles, tiles[1:]):
        assert x1 - x0 <= 1 and abs(y1 - y0) <= 1


def test_points_at_all_zooms(spark):
    places = [(0.0, 0.0), (-180.0, 85.06), (180.0, -86.0), (12.34, 56.78), (7.0, 90.0)]
    df = spark.createDataFrame(places, "lon double, lat double")
    for zoom in (1, 17, 18, 19, 30):
        cell = c.cell_of_point(F.col("lon"), F.col("lat"), zoom)
        found = [r["v"] for r in df.select(cell.alias("v")).collect()]
        assert found == [cell_around(lon, lat, zoom) for lon, lat in places]


@pytest.mark.parametrize("zoom", [0, 31, -1, 1.5, "3"])
def test_zoom_is_checked(spark, zoom):
    with pytest.raises(ValueError, match="zoom"):
        c.cells_of_points(F.col("geometry"), zoom)


def test_cell_outlines_hold_their_points(spark):
    rng = random.Random(3)
    places = [(rng.uniform(-180, 180), rng.uniform(-85, 85)) for _ in range(200)]
    df = spark.createDataFrame(places, "lon double, lat double")
    cell = c.cell_of_point(F.col("lon"), F.col("lat"), 11)
    df = polygons_from_cells(df.withColumn("cell", cell), "cell")
    centre = c.cell_centre(F.col("cell"))["polys"][0][0][0]
    again = c.cell_of_point(centre["x"], centre["y"], 11).alias("again")
    for row in df.select("*", again).collect():
        ring = [(p["x"], p["y"]) for p in row["geometry"]["polys"][0][0]]
        assert ring[0] == ring[-1] and len(ring) == 5
        west, south = ring[0]
        east, north = ring[2]
        assert west <= row["lon"] < east and south <= row["lat"] <= north
        assert row["again"] == row["cell"]


def test_what_is_not_a_cell_gives_no_geometry(spark):
    texts = ["0123", "", "0124", "abc", "0" * 30, "0" * 31, None]
    df = spark.createDataFrame([(t,) for t in texts], "cell string")
    for build in ("polygon", "point"):
        rows = polygons_from_cells(df, "cell", build).collect()
        assert [r["geometry"] is not None for r in rows] == [
            True, False, False, False, True, False, False,
        ]
    with pytest.raises(ValueError, match="geometry_type must be"):
        polygons_from_cells(df, "cell", "circle")


def test_parent_cells(spark):
    df = spark.createDataFrame([("012301",), ("01",), (None,)], "cell string")
    rows = df.select(c.parent_cell(F.col("cell"), 3).alias("v")).collect()
    assert [r["v"] for r in rows] == ["012", None, None]


def test_export_cells_of_each_kind(spark):
    df = frame(spark, [*EXAMPLES.values(), None])
    found = [r["cell_index"] for r in export_cells(df, 7).orderBy("id").collect()]
    assert found[0] == cell_at(1.5, 2.5, 7)
    assert json.loads(found[1]) == sorted({cell_at(1, 2, 7), cell_at(3, 4, 7)})
    assert json.loads(found[2]) == line_cells(EXAMPLES["LineString"][1][0], 7)
    assert json.loads(found[3]) == line_cells(EXAMPLES["MultiLineString"][1][0], 7)
    assert json.loads(found[4]) == polygon_cells(EXAMPLES["Polygon"][1], 7)
    assert json.loads(found[5]) == polygon_cells(EXAMPLES["MultiPolygon"][1], 7)
    assert found[6] is None


def test_rollup_does_not_depend_on_partitioning(spark):
    rng = random.Random(5)
    geometries = [
        ("Point", [[[(rng.choice([1.0, rng.uniform(-90, 90)]), rng.uniform(0, 9))]]])
        for _ in range(300)
    ]
    df = frame(spark, [*geometries, None])
    results = [
        sorted(map(str, cell_rollup(df.repartition(n), 4).collect()))
        for n in (1, 4, 32)
    ]
    assert results[0] == results[1] == results[2]
    assert sum(r["features"] for r in cell_rollup(df, 4).collect()) == 301
