import json
import math

import pytest
from pyspark.sql import functions as F
from shapes import EXAMPLES, FAR, SQUARE, frame, plain

from quadrille.functions import geometry as g
from quadrille.functions.wkb import from_wkb, to_wkb
from quadrille.operators.profile import dataset_bbox, row_counts
from quadrille.operators.profile import geometry_type_of
from quadrille.sources.columns import reproject_to_wgs84


def values(df, column):
    rows = df.select("id", column.alias("v")).orderBy("id").collect()
    return [r["v"] for r in rows]


def test_envelopes(spark):
    df = frame(spark, [*EXAMPLES.values(), None])
    boxes = [tuple(b) for b in values(df, g.envelope(F.col("geometry")))]
    assert boxes == [
        (1.5, 2.5, 1.5, 2.5),
        (1.0, 2.0, 3.0, 4.0),
        (0.0, 0.0, 3.0, 5.0),
        (0.0, 0.0, 5.0, 8.0),
        (0.0, 0.0, 4.0, 4.0),
        (0.0, 0.0, 14.0, 24.0),
        (None,) * 4,
    ]
    assert tuple(dataset_bbox(df).first()) == (0.0, 0.0, 14.0, 24.0)


def test_centroids(spark):
    df = frame(spark, [*EXAMPLES.values(), None])
    found = [c and tuple(c) for c in values(df, g.centroid(F.col("geometry")))]
    holed = (16 * 2.0 - 1.5) / 15
    expected = [
        (1.5, 2.5),
        (2.0, 3.0),
        ((5 * 1.5 + 3.0) / 6, (5 * 2.0 + 4.5) / 6),
        ((0.5 + 15.0) / 4, 19.5 / 4),
        (holed, holed),
        ((15 * holed + 16 * 12) / 31, (15 * holed + 16 * 22) / 31),
        None,
    ]
    for mine, right in zip(found, expected):
        assert mine == (right if right is None else pytest.approx(right))


def test_winding_and_position_do_not_move_a_centroid(spark):
    shift = 1e6
    far = [(x / 1e3 + shift, y / 1e3 + shift) for x, y in SQUARE]
    df = frame(spark, [("Polygon", [[far]]), ("Polygon", [[far[::-1]]])])
    for c in values(df, g.centroid(F.col("geometry"))):
        assert c["x"] - shift == pytest.approx(2e-3, abs=1e-9)


def test_degenerate_shapes_have_the_mean_of_their_vertices(spark):
    flat = [(0.0, 0.0), (2.0, 0.0), (1.0, 0.0), (0.0, 0.0)]
    still = [(3.0, 3.0), (3.0, 3.0)]
    df = frame(spark, [("Polygon", [[flat]]), ("LineString", [[still]])])
    found = [tuple(c) for c in values(df, g.centroid(F.col("geometry")))]
    assert found == [(0.75, 0.0), (3.0, 3.0)]


def test_empty_geometries(spark):
    df = frame(spark, [("MultiPoint", []), ("Polygon", []), None])
    geom = F.col("geometry")
    assert values(df, g.is_empty(geom)) == [True, True, None]
    assert values(df, g.centroid(geom)) == [None] * 3
    assert tuple(dataset_bbox(df).first()) == (None,) * 4
    assert tuple(row_counts(df).first()) == (3, 1, 2)


def test_geojson(spark):
    df = frame(spark, [*EXAMPLES.values(), None])
    found = values(df, g.as_geojson(F.col("geometry")))
    assert found.pop() is None
    for text, (kind, polys) in zip(found, EXAMPLES.values()):
        parsed = json.loads(text)
        coordinates = {
            "Point": lambda: polys[0][0][0],
            "MultiPoint": lambda: polys[0][0],
            "LineString": lambda: polys[0][0],
            "MultiLineString": lambda: polys[0],
            "Polygon": lambda: polys[0],
            "MultiPolygon": lambda: polys,
        }[kind]()
        assert parsed == json.loads(json.dumps({"type": kind, "coordinates": coordinates}))


def test_reprojection_there_and_back(spark):
    df = frame(spark, [("Polygon", [[FAR]]), None])
    metres = df.withColumn("geometry", g.to_web_mercator(F.col("geometry")))
    corner = plain(values(metres, F.col("geometry"))[0])[1][0][0][1]
    assert corner[0] == pytest.approx(math.radians(14.0) * 6378137)
    metres = metres.withMetadata("geometry", {"srid": 3857})
    back = reproject_to_wgs84(metres)
    assert back.schema["geometry"].metadata["srid"] == 4326
    ring = plain(values(back, F.col("geometry"))[0])[1][0][0]
    assert [c for p in ring for c in p] == pytest.approx([c for p in FAR for c in p])
    assert values(back, F.col("geometry"))[1] is None


def test_unknown_reference_systems_are_refused():
    with pytest.raises(ValueError, match="2154"):
        g.to_wgs84(None, 2154)
    with pytest.raises(ValueError, match="2154"):
        g.to_web_mercator(None, 2154)


@pytest.mark.parametrize("kind", EXAMPLES)
def test_wkb_round_trip_in_spark(spark, kind):
    df = frame(spark, [EXAMPLES[kind], None, EXAMPLES[kind]])
    back = df.select("id", from_wkb(to_wkb(F.col("geometry"))).alias("geometry"))
    found = [plain(v) for v in values(back, F.col("geometry"))]
    assert found == [EXAMPLES[kind], None, EXAMPLES[kind]]


@pytest.mark.parametrize(
    ("kinds", "expected"),
    [
        (["Point"], "POINT"),
        (["Point", "MultiPoint"], "MULTIPOINT"),
        (["LineString", "MultiLineString"], "POLYLINE"),
        (["Polygon", "MultiPolygon"], "POLYGON"),
        (["Polygon", "LineString"], "POLYLINE"),
        (["Polygon", "Point"], "POINT"),
    ],
)
def test_feature_type_of_rows(spark, kinds, expected):
    assert geometry_type_of(frame(spark, [EXAMPLES[k] for k in kinds])) == expected
