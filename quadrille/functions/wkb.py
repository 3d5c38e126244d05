"""WKB at the edges: Arrow batches in and out of the geometry struct.

Spark has no access to the bytes of a double, so these two conversions run in Python
workers, one Arrow batch at a time and always as arrays: records of one path at once, the
others path by path in step.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..session import ship_to_active

from .geometry import GEOMETRY_TYPE, KINDS

# WKB geometry codes and the bits that mark extended WKB.
WKB_CODES = {
    "Point": 1,
    "LineString": 2,
    "Polygon": 3,
    "MultiPoint": 4,
    "MultiLineString": 5,
    "MultiPolygon": 6,
}
EWKB_SRID = 0x20000000

KINDS_BY_CODE = tuple(sorted(WKB_CODES, key=WKB_CODES.get))
# bytes before the coordinates of a point, a line and a polygon with one ring
_HEADER_BYTES = np.array([0, 5, 9, 13])
_VERTEX_BYTES = 16
# records below which a loop over their rings is faster than a round for each ring
_FEW = 8
_SIMPLE_KINDS = pa.array([None, "Point", "LineString", "Polygon"], pa.string())
_XY = pa.struct([("x", pa.float64()), ("y", pa.float64())])


def _integers(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Little-endian 32-bit integers at byte positions; those past the end are junk."""
    inside = np.minimum(at[:, None] + np.arange(4), max(len(raw) - 1, 0))
    return raw[inside].view("<u4").ravel().astype(np.int64)


class _SimpleRecords:
    """Which records of a batch are simple, and where their coordinates lie.

    ``code`` is the WKB code of a simple record, 0 for a null, -1 for any other record.
    """

    def __init__(self, data: pa.BinaryArray):
        ends = np.frombuffer(data.buffers()[1], np.int32)
        ends = ends[data.offset : data.offset + len(data) + 1].astype(np.int64)
        values = data.buffers()[2]
        raw = np.frombuffer(values, np.uint8) if values else np.empty(0, np.uint8)
        self.raw = raw[ends[0] : ends[-1]]
        self.starts = ends[:-1] - ends[0]
        self.lengths = np.diff(ends)
        present = np.array(data.is_valid(), dtype=bool)
        self.code = np.where(present, -1, 0)
        self.vertices = np.zeros(len(data), np.int64)
        if len(self.raw):
            self._classify(present)

    def _classify(self, present: np.ndarray) -> None:
        starts, lengths = self.starts, self.lengths
        little = self.raw[np.minimum(starts, len(self.raw) - 1)] == 1
        code = _integers(self.raw, starts + 1)
        first = _integers(self.raw, starts + 5)
        second = _integers(self.raw, starts + 9)
        one_ring = (code == 3) & (first == 1)
        vertices = np.select([code == 1, code == 2, one_ring], [1, first, second], 0)
        known = (vertices > 0) & little & present & (lengths >= 9)
        expected = _HEADER_BYTES[np.where(known, code, 0)] + vertices * _VERTEX_BYTES
        simple = known & (lengths == expected)
        self.code = np.where(simple, code, self.code)
        self.vertices = np.where(simple, vertices, 0)

    def coordinates(self) -> np.ndarray:
        """Vertices of all simple records, in order."""
        body = self.vertices * _VERTEX_BYTES
        runs = np.column_stack([self.lengths - body, body]).ravel()
        wanted = np.repeat(np.tile([False, True], len(body)), runs)
        return self.raw[wanted].view("<f8").reshape(-1, 2)


def _nested(ends: list, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _struct_array(kinds, polys, missing) -> pa.StructArray:
    return pa.StructArray.from_arrays(
        [kinds, polys], names=["type", "polys"], mask=pa.array(missing, pa.bool_())
    )


def _vertices(xy: np.ndarray) -> pa.StructArray:
    columns = [pa.array(np.ascontiguousarray(xy[:, i])) for i in (0, 1)]
    return pa.StructArray.from_arrays(columns, fields=list(_XY))


def _interleaved(simple: pa.Array, other: pa.Array, is_simple: np.ndarray) -> pa.Array:
    """Rows of two arrays in the order of the batch they were taken from."""
    if not len(other):
        return simple
    order = np.empty(len(is_simple), np.int64)
    order[is_simple] = np.arange(len(simple))
    order[~is_simple] = len(simple) + np.arange(len(other))
    return pa.concat_arrays([simple, other]).take(pa.array(order))


def decode_batch(data: pa.Array) -> pa.StructArray:
    """Geometry structs of a batch of WKB records; null where a record is unreadable."""
    data = data.cast(pa.binary())
    records = _SimpleRecords(data)
    xy = records.coordinates()
    # a point of NaNs is an empty one
    at = np.cumsum(records.vertices) - records.vertices
    rows = np.flatnonzero(records.code == 1)
    is_simple = records.code >= 0
    is_simple[rows[np.isnan(xy[at[rows]]).any(axis=1)]] = False
    simple = _decode_simple(records, xy, is_simple)
    others = data.filter(pa.array(~is_simple))
    return _interleaved(simple, _decode_nested(others), is_simple)


def _decode_simple(
    records: _SimpleRecords, xy: np.ndarray, chosen: np.ndarray
) -> pa.StructArray:
    if not chosen.all():
        xy = xy[np.repeat(chosen, records.vertices)]
    code, vertices = records.code[chosen], records.vertices[chosen]
    missing = code == 0
    single = np.arange(np.count_nonzero(~missing) + 1)
    point_ends = np.concatenate([[0], np.cumsum(vertices[~missing])])
    poly_ends = np.concatenate([[0], np.cumsum(~missing)])
    paths = _nested(point_ends, _vertices(xy))
    polys = _nested(poly_ends, _nested(single, paths))
    return _struct_array(_SIMPLE_KINDS.take(pa.array(code)), polys, missing)


class _Walk:
    """All records of a batch that are not simple, read in step.

    Every record has a cursor.  In a round each record that is not finished reads its next
    member header, if it is due, and its next path; what was read is kept as runs of
    vertices.  So a round is a few operations on arrays, and there are as many rounds as
    the record with the most paths has.  Points of a multipoint have a fixed size and are
    read at once.  A record that cannot be read is marked as bad and left.
    """

    def __init__(self, data: pa.BinaryArray):
        ends = np.frombuffer(data.buffers()[1], np.int32)
        ends = ends[data.offset : data.offset + len(data) + 1].astype(np.int64)
        values = data.buffers()[2]
        raw = np.frombuffer(values, np.uint8) if values else np.empty(0, np.uint8)
        # a pad, so that reading past the end needs no condition
        self.raw = np.concatenate([raw[ends[0] : ends[-1]], np.zeros(32, np.uint8)])
        self.at, self.end = ends[:-1] - ends[0], ends[1:] - ends[0]
        size = len(data)
        self.bad = np.zeros(size, bool)
        self.big = np.zeros(size, bool)
        self.members = np.zeros(size, np.int64)  # members not begun
        self.rings = np.zeros(size, np.int64)  # paths not read of the present member
        self.poly = np.zeros(size, np.int64)
        self.path = np.zeros(size, np.int64)
        self.polys = np.ones(size, np.int64)
        self.runs: list[np.ndarray] = []
        everything = np.arange(size)
        self.kind = np.zeros(size, np.int64)
        self.kind[:] = self._headers(everything)
        self._begin(everything)
        while True:
            (active,) = np.nonzero(~self.bad & ((self.members > 0) | (self.rings > 0)))
            if not len(active):
                break
            if len(active) <= _FEW:
                # arrays of so few records cost more than they save
                for row in active[self.rings[active] > 1]:
                    self._rest(row)
            self._round(active)
        self.bad |= self.at != self.end

    def _take(self, rows: np.ndarray, size: int) -> np.ndarray:
        """Where the next bytes of the records lie; those that are too short are bad."""
        at = self.at[rows]
        short = at + size > self.end[rows]
        self.bad[rows[short]] = True
        self.at[rows] = at + size
        return np.where(short, len(self.raw) - 32, at)

    def _numbers(self, rows: np.ndarray) -> np.ndarray:
        at = self._take(rows, 4)
        four = self.raw[at[:, None] + np.arange(4)]
        little, big = four.view("<u4").ravel(), four.view(">u4").ravel()
        return np.where(self.big[rows], big, little).astype(np.int64)

    def _headers(self, rows: np.ndarray) -> np.ndarray:
        """Byte order and kind at the cursors; 0 for kinds that are not read."""
        order = self.raw[self._take(rows, 1)]
        self.bad[rows[order > 1]] = True
        self.big[rows] = order == 0
        code = self._numbers(rows)
        extended = code & EWKB_SRID != 0
        if extended.any():
            self._numbers(rows[extended])
        code = code & ~EWKB_SRID
        unknown = (code < 1) | (code > 6)
        self.bad[rows[unknown]] = True
        return np.where(unknown, 0, code)

    def _counts(self, rows: np.ndarray, least: int) -> np.ndarray:
        """Counts at the cursors, of things that take ``least`` bytes or more each."""
        count = self._numbers(rows)
        self.bad[rows[count * least > self.end[rows] - self.at[rows]]] = True
        return np.where(self.bad[rows], 0, count)

    def _begin(self, rows: np.ndarray) -> None:
        rows = rows[~self.bad]
        kind = self.kind[rows]
        self.rings[rows[kind <= 2]] = 1
        polygons = rows[kind == 3]
        self.rings[polygons] = self._counts(polygons, 4)
        several = rows[kind >= 4]
        least = {4: 21, 5: 9, 6: 9}
        for code, size in least.items():
            own = several[self.kind[several] == code]
            self.members[own] = self._counts(own, size)
        areas = rows[kind == 6]
        self.polys[areas] = self.members[areas]
        self.poly[areas] = -1
        self._points(rows[kind == 4])

    def _points(self, rows: np.ndarray) -> None:
        """Multipoints whose members are all alike, as they nearly always are."""
        rows = rows[~self.bad[rows] & (self.members[rows] > 0)]
        alike = self.end[rows] - self.at[rows] == 21 * self.members[rows]
        rows = rows[alike]
        count = self.members[rows]
        at = np.repeat(self.at[rows] - 21 * (np.cumsum(count) - count), count)
        at += 21 * np.arange(len(at))
        owner = np.repeat(rows, count)
        head = self.raw[at[:, None] + np.arange(5)]
        little = (head == [1, 1, 0, 0, 0]).all(axis=1)
        big = (head == [0, 0, 0, 0, 1]).all(axis=1)
        other = np.zeros(len(self.bad), bool)
        other[owner[~(little | big)]] = True
        plain = ~other[owner]
        self._keep(owner[plain], at[plain] + 5, np.ones(plain.sum(), np.int64), big[plain])
        done = rows[~other[rows]]
        self.members[done] = 0
        self.at[done] = self.end[done]

    def _keep(self, rows, start, count, big) -> None:
        columns = [rows, self.poly[rows], self.path[rows], start, count, big]
        self.runs.append(np.stack([c.astype(np.int64) for c in columns], axis=1))

    def _rest(self, row: int) -> None:
        """All rings but one of the present member of a record."""
        at, end, many = int(self.at[row]), int(self.end[row]), int(self.rings[row]) - 1
        number = struct.Struct(">I" if self.big[row] else "<I")
        starts, counts = [], []
        while len(starts) < many:
            count = number.unpack_from(self.raw, at)[0]
            if at + 4 + count * _VERTEX_BYTES > end:
                break
            starts.append(at + 4)
            counts.append(count)
            at += 4 + count * _VERTEX_BYTES
        read = len(starts)
        self._keep(np.full(read, row), np.array(starts), np.array(counts), np.full(read, self.big[row]))
        if read:
            self.runs[-1][:, 2] += np.arange(read)
        self.at[row] = at
        self.rings[row] -= read
        self.path[row] += read

    def _round(self, active: np.ndarray) -> None:
        due = active[self.rings[active] == 0]
        if len(due):
            self.members[due] -= 1
            wanted = self.kind[due] - 3
            self.bad[due[self._headers(due) != wanted]] = True
            due = due[~self.bad[due]]
            areas = self.kind[due] == 6
            self.poly[due[areas]] += 1
            self.path[due[areas]] = 0
            self.rings[due[~areas]] = 1
            self.rings[due[areas]] = self._counts(due[areas], 4)
        rows = active[(self.rings[active] > 0) & ~self.bad[active]]
        if not len(rows):
            return
        single = (self.kind[rows] == 1) | (self.kind[rows] == 4)
        count = np.ones(len(rows), np.int64)
        count[~single] = self._counts(rows[~single], _VERTEX_BYTES)
        start = self._take(rows, count * _VERTEX_BYTES)
        self._keep(rows, start, count, self.big[rows])
        self.rings[rows] -= 1
        # the points of a multipoint are one path
        self.path[rows[self.kind[rows] != 4]] += 1


def _decode_nested(data: pa.BinaryArray) -> pa.StructArray:
    """Geometry structs of records of any kind."""
    walk = _Walk(data)
    size = len(data)
    runs = np.concatenate([np.empty((0, 6), np.int64), *walk.runs])
    runs = runs[~walk.bad[runs[:, 0]]]
    runs = runs[np.lexsort((runs[:, 3], runs[:, 0]))]
    row, poly, path, start, count, big = runs.T
    chosen = np.zeros(len(walk.raw) + 1, np.int32)
    np.add.at(chosen, start, 1)
    np.add.at(chosen, start + count * _VERTEX_BYTES, -1)
    xy = walk.raw[np.cumsum(chosen[:-1]) > 0].view("<f8").reshape(-1, 2).copy()
    turned = np.repeat(big > 0, count)
    xy[turned] = xy[turned].byteswap()

    # an empty point is written as two NaNs; without a vertex nothing is left of a record
    point = walk.kind[row] == 1
    first = np.cumsum(count) - count
    blank = point.copy()
    blank[point] = np.isnan(xy[first[point]]).all(axis=1)
    vertices = np.bincount(row, np.where(blank, 0, count), size).astype(np.int64)
    full = vertices > 0
    polys = np.where(full & ~walk.bad, walk.polys, 0)
    kept = full[row]
    xy = xy[np.repeat(kept, count)]
    row, poly, path, count = row[kept], poly[kept], path[kept], count[kept]

    poly_at = np.concatenate([[0], np.cumsum(polys)])
    number = poly_at[row] + poly
    fresh = np.ones(len(row), bool)
    fresh[1:] = (number[1:] != number[:-1]) | (path[1:] != path[:-1])
    paths = np.bincount(number[fresh], minlength=poly_at[-1])
    lengths = np.add.reduceat(count, np.nonzero(fresh)[0]) if len(row) else count
    ends = [np.concatenate([[0], np.cumsum(n)]) for n in (lengths, paths)]
    nested = _nested(poly_at, _nested(ends[1], _nested(ends[0], _vertices(xy))))
    kinds = pa.array([None, *KINDS_BY_CODE], pa.string())
    code = np.where(walk.bad, 0, walk.kind)
    return _struct_array(kinds.take(pa.array(code)), nested, walk.bad)


class _Nesting:
    """Numpy view of a batch of geometry structs."""

    def __init__(self, geoms: pa.StructArray):
        polys = geoms.field("polys")
        parts, paths = polys.values, polys.values.values
        self.kinds = geoms.field("type")
        # offsets of a sliced parent count from the start of its unsliced child
        self.poly_ends = np.asarray(polys.offsets)
        self.part_ends = np.asarray(parts.offsets)
        self.point_ends = np.asarray(paths.offsets)
        axes = [np.asarray(paths.values.field(a), dtype="<f8") for a in ("x", "y")]
        self.xy = np.column_stack(axes)


def encode_batch(geoms: pa.StructArray) -> pa.BinaryArray:
    """WKB records of a batch of geometry structs; null for null."""
    missing = np.array(geoms.is_null(), dtype=bool)
    nesting = _Nesting(geoms)
    present = nesting.kinds.filter(pa.array(~missing))
    unknown = set(present.unique().to_pylist()) - set(KINDS)
    if unknown:
        raise ValueError(f"Unknown geometry kinds: {sorted(map(str, unknown))}.")

    code = np.asarray(pc.index_in(nesting.kinds, _SIMPLE_KINDS[1:]).fill_null(-1)) + 1
    code = np.where(missing, 0, code)
    # a simple record has one polygon, one part and at least one vertex
    part = _only_child(nesting.poly_ends, nesting.part_ends)
    part = np.where(code > 0, part, -1)
    bounds = np.append(nesting.point_ends, nesting.point_ends[-1:])
    vertices = np.where(part >= 0, bounds[part + 1] - bounds[part], 0)
    is_simple = missing | ((vertices > 0) & ((code != 1) | (vertices == 1)))
    simple = _encode_simple(
        nesting, code[is_simple], bounds[part][is_simple], vertices[is_simple]
    )
    others = np.flatnonzero(~is_simple)
    return _interleaved(simple, _encode_nested(nesting, others), is_simple)


def _only_child(ends: np.ndarray, child_ends: np.ndarray) -> np.ndarray:
    """Index of the single grandchild of each row; -1 where there is not just one."""
    if len(child_ends) < 2:
        return np.full(len(ends) - 1, -1)
    child = np.minimum(ends[:-1], len(child_ends) - 2)
    single = (np.diff(ends) == 1) & (child_ends[child + 1] - child_ends[child] == 1)
    return np.where(single, child_ends[child], -1)


def _encode_simple(
    nesting: _Nesting, code: np.ndarray, first: np.ndarray, vertices: np.ndarray
) -> pa.BinaryArray:
    """Records of points, lines and one-ring polygons; code 0 stands for null."""
    vertices = np.where(code > 0, vertices, 0).astype(np.int64)
    header, body = _HEADER_BYTES[code], vertices * _VERTEX_BYTES
    heads = np.zeros((len(code), 13), np.uint8)
    heads[:, 0] = 1
    heads[:, 1] = code
    counts = vertices.astype("<u4")[:, None].view(np.uint8)
    heads[code == 2, 5:9] = counts[code == 2]
    heads[code == 3, 5] = 1
    heads[code == 3, 9:13] = counts[code == 3]

    runs = np.column_stack([header, body]).ravel()
    is_body = np.repeat(np.tile([False, True], len(code)), runs)
    records = np.empty(len(is_body), np.uint8)
    records[~is_body] = heads[np.arange(13) < header[:, None]]
    begin = np.cumsum(vertices) - vertices
    at = np.repeat(first - begin, vertices) + np.arange(vertices.sum())
    records[is_body] = nesting.xy[at].view(np.uint8).ravel()
    ends = np.concatenate([[0], np.cumsum(header + body)])
    if ends[-1] > np.iinfo(np.int32).max:
        raise ValueError("A batch of records exceeds 2 GiB; use smaller Arrow batches.")
    ends = ends.astype(np.int32)
    valid = pa.array(code > 0).buffers()[1]
    buffers = [valid, pa.py_buffer(ends), pa.py_buffer(records)]
    return pa.BinaryArray.from_buffers(pa.binary(), len(code), buffers)


def _spans(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of some ranges, one after the other, and the range of each."""
    owner = np.repeat(np.arange(len(first)), count)
    begin = np.cumsum(count) - count
    return np.arange(len(owner)) - begin[owner] + first[owner], owner


def _before(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _encode_nested(nesting: _Nesting, rows: np.ndarray) -> pa.BinaryArray:
    """Records of any kind, put together level by level.

    The places of all headers and vertices follow from running sums of their sizes.  A
    geometry that is not a multipolygon has one polygon, a line or point one path.
    """
    code = np.asarray(pc.index_in(nesting.kinds, pa.array(KINDS_BY_CODE)).fill_null(-1))
    code = code[rows].astype(np.int64) + 1
    many, single = code == 6, code <= 2
    n_polys = nesting.poly_ends[rows + 1] - nesting.poly_ends[rows]
    n_polys = np.where(many, n_polys, np.minimum(n_polys, 1))
    poly, row_of_poly = _spans(nesting.poly_ends[rows], n_polys)
    bounds = np.append(nesting.part_ends, nesting.part_ends[-1:])
    n_paths = bounds[poly + 1] - bounds[poly]
    n_paths = np.where(single[row_of_poly], np.minimum(n_paths, 1), n_paths)
    path, poly_of_path = _spans(bounds[poly], n_paths)
    row = row_of_poly[poly_of_path]
    kind = code[row]
    bounds = np.append(nesting.point_ends, nesting.point_ends[-1:])
    length = bounds[path + 1] - bounds[path]
    length = np.where(kind == 1, np.minimum(length, 1), length)

    # bytes before the vertices of a path, and of a whole path, by the code of its row
    lead = np.array([0, 0, 4, 4, 5, 9, 4])[kind]
    path_size = np.where(kind == 4, 21 * length, lead + _VERTEX_BYTES * length)
    per_row = [np.bincount(row, w, len(rows)).astype(np.int64) for w in (length, path_size)]
    points, bodies = per_row
    # an empty point is two NaNs, an empty line a count of zero
    pad = np.where((code == 1) & (points == 0), 16, 0)
    pad = np.where((code == 2) & (np.bincount(row, minlength=len(rows)) == 0), 4, pad)
    head = np.array([0, 5, 5, 9, 9, 9, 9])[code]
    poly_head = np.where(many[row_of_poly], 9, 0)
    size = head + pad + bodies + np.bincount(row_of_poly, poly_head, len(rows)).astype(np.int64)
    at_row = _before(size)
    if len(size) and at_row[-1] + size[-1] > np.iinfo(np.int32).max:
        raise ValueError("A batch of records exceeds 2 GiB; use smaller Arrow batches.")
    body = head + pad
    in_poly = np.bincount(poly_of_path, path_size, len(poly)).astype(np.int64)
    at_poly = np.cumsum(body)[row_of_poly] + _before(poly_head + in_poly)
    at_path = np.cumsum(body)[row] + np.cumsum(poly_head)[poly_of_path] + _before(path_size)

    out = np.zeros(int(size.sum()), np.uint8)

    def put(at: np.ndarray, numbers: np.ndarray) -> None:
        four = np.ascontiguousarray(numbers.astype("<u4"))[:, None].view(np.uint8)
        out[at[:, None] + np.arange(4)] = four

    def begin(at: np.ndarray, of_kind) -> None:
        out[at] = 1
        out[at + 1] = of_kind

    begin(at_row, code)
    counts = np.select(
        [code == 3, code == 4, code == 5, code == 6],
        [np.bincount(row, minlength=len(rows)), points, np.bincount(row, minlength=len(rows)), n_polys],
        0,
    )
    put(at_row[code >= 3] + 5, counts[code >= 3])
    blank = at_row[(code == 1) & (points == 0)] + 5
    out[blank[:, None] + np.arange(16)] = np.full(2, np.nan, "<f8").view(np.uint8)
    members = at_poly[poly_head > 0]
    begin(members, 3)
    put(members + 5, n_paths[poly_head > 0])
    lines = kind == 5
    begin(at_path[lines], 2)
    counted = (kind != 1) & (kind != 4)
    put(at_path[counted] + lead[counted] - 4, length[counted])

    # blocks of vertices: whole paths, but each point of a multipoint by itself
    each = np.where(kind == 4, length, 1)
    offset, owner = _spans(np.zeros(len(path), np.int64), each)
    at = at_path[owner] + lead[owner] + 21 * offset
    block = _VERTEX_BYTES * np.where(kind == 4, 1, length)[owner]
    begin(at[kind[owner] == 4] - 5, 1)
    chosen = np.zeros(len(out) + 1, np.int32)
    np.add.at(chosen, at, 1)
    np.add.at(chosen, at + block, -1)
    vertex = _spans(bounds[path], length)[0]
    out[np.cumsum(chosen[:-1]) > 0] = nesting.xy[vertex].view(np.uint8).ravel()
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(out)]
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), buffers)


def from_wkb(wkb: Column) -> Column:
    """Geometry of a WKB column; null where the bytes cannot be read."""
    ship_to_active()

    @arrow_udf(GEOMETRY_TYPE)
    def decode(data: pa.Array) -> pa.Array:
        return decode_batch(data)

    return decode(wkb)


def to_wkb(geom: Column) -> Column:
    """WKB of a geometry column."""

    ship_to_active()

    @arrow_udf("binary")
    def encode(data: pa.Array) -> pa.Array:
        return encode_batch(data)

    return encode(geom)


def wkb_kind(wkb: Column) -> Column:
    """Kind of geometry that a WKB record announces in its first five bytes.

    Needs no Python worker.  Null for codes that are not read, and for records that are
    too short; whether the rest of a record can be read is not looked at.
    """
    order = F.hex(F.substring(wkb, 1, 1))
    digits = F.hex(F.substring(wkb, 2, 4))
    turned = F.concat(*[F.substring(digits, at, 2) for at in (7, 5, 3, 1)])
    code = F.conv(F.when(order == "01", turned).when(order == "00", digits), 16, 10)
    plain = code.cast("bigint").bitwiseAND(F.lit((1 << 32) - 1 - EWKB_SRID))
    result = F.lit(None).cast("string")
    for name, number in WKB_CODES.items():
        result = F.when(plain == number, name).otherwise(result)
    return F.when(F.length(digits) == 8, result)
