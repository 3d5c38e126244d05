"""Small geometries for tests, as plain Python values and as frames."""

from __future__ import annotations

import json
import struct

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from quadrille.functions.geometry import GEOMETRY_TYPE


def as_struct(kind, polys):
    return {
        "type": kind,
        "polys": [[[{"x": x, "y": y} for x, y in part] for part in p] for p in polys],
    }


def frame(spark, geometries, srid=4326):
    """``id, geometry`` from ``(kind, polys)`` pairs; None gives a null geometry."""
    rows = [(i, None if g is None else as_struct(*g)) for i, g in enumerate(geometries)]
    df = spark.createDataFrame(rows, f"id bigint, geometry {GEOMETRY_TYPE}")
    return df.withMetadata("geometry", {"srid": srid})


def plain(value):
    """Row of a geometry as a ``(kind, polys)`` pair."""
    if value is None:
        return None
    polys = [[[(p["x"], p["y"]) for p in part] for part in q] for q in value["polys"]]
    return value["type"], polys


SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0), (1.0, 1.0)]
FAR = [(x + 10.0, y + 20.0) for x, y in SQUARE]

EXAMPLES = {
    "Point": ("Point", [[[(1.5, 2.5)]]]),
    "MultiPoint": ("MultiPoint", [[[(1.0, 2.0), (3.0, 4.0)]]]),
    "LineString": ("LineString", [[[(0.0, 0.0), (3.0, 4.0), (3.0, 5.0)]]]),
    "MultiLineString": (
        "MultiLineString",
        [[[(0.0, 0.0), (1.0, 0.0)], [(5.0, 5.0), (5.0, 8.0)]]],
    ),
    "Polygon": ("Polygon", [[SQUARE, HOLE]]),
    "MultiPolygon": ("MultiPolygon", [[SQUARE, HOLE], [FAR]]),
}


def wkb_point(x, y):
    return struct.pack("<BIdd", 1, 1, x, y)


def wkb_line(points):
    return struct.pack("<BII", 1, 2, len(points)) + np.array(points, "<f8").tobytes()


def wkb_polygon(ring):
    body = struct.pack("<I", len(ring)) + np.array(ring, "<f8").tobytes()
    return struct.pack("<BII", 1, 3, 1) + body


def geo_header(kinds=("Point",), column="geometry", crs="epsg:4326", bbox=None, **more):
    """A footer; ``crs`` is ``epsg:n``, a dict, None (explicit null) or ``missing``."""
    facts = {"encoding": "WKB", "geometry_types": list(kinds)}
    if crs != "missing":
        if isinstance(crs, str):
            code = int(crs.split(":")[1])
            crs = {"name": crs, "id": {"authority": "EPSG", "code": code}}
        facts["crs"] = crs
    if bbox:
        facts["bbox"] = bbox
    columns = {column: facts, **more}
    return {"version": "1.1.0", "primary_column": column, "columns": columns}


def write_file(path, columns, header=None):
    """One Parquet file of Arrow columns with a ``geo`` footer if a header is given."""
    path.parent.mkdir(parents=True, exist_ok=True)
    table = pa.table(columns)
    if header is not None:
        metadata = {b"geo": json.dumps(header).encode()}
        table = table.replace_schema_metadata(metadata)
    pq.write_table(table, path)


def feature_columns(count, encode, start=0):
    ids = list(range(start, start + count))
    return {
        "id": pa.array(ids, pa.int64()),
        "name": [f"Feature_{i}" for i in ids],
        "value": [i * 10.5 for i in ids],
        "geometry": pa.array([encode(i) for i in ids], pa.binary()),
    }


def point_at(i):
    return wkb_point(0.1 * i, 0.1 * i)


def line_at(i):
    return wkb_line([(0.1 * i, 0.1 * i), (0.1 * i + 1, 0.1 * i + 1)])


def polygon_at(i):
    a = 0.1 * i
    return wkb_polygon([(a, a), (a + 1, a), (a + 1, a + 1), (a, a + 1), (a, a)])
