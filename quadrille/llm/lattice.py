"""Near-duplicate vectors by hashing to points of the E8 lattice.

A table of the index projects vectors at random onto a few blocks of eight dimensions and
decodes each block to the nearest lattice point; the points are the vector's cell.  A
vector lies in its own cell and visits the neighbouring cells nearest to it, by replacing
the point of one block.  Two vectors are candidates if one visits, or lies in, the cell of
the other in some table.  Candidates are verified by their cosine.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    Forest,
    id_of,
    map_arrow,
    map_groups,
    paired_blocks,
    public_id,
    shuffle_width,
    stored,
)
from .components import connected_components

#: Index: tables, blocks of eight projected dimensions in each, the scale of the
#: projections, and the neighbouring cells visited in each block.  For pairs at a cosine
#: of exactly 0.98 one table finds about three quarters.
TABLES = 7
BLOCKS = 2
SCALE = 0.6
PROBES = 4


def _shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: the steps from a point to its neighbours."""
    steps = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            step = np.zeros(8)
            step[[i, j]] = a, b
            steps.append(step)
    for signs in itertools.product((0.5, -0.5), repeat=8):
        if sum(s < 0 for s in signs) % 2 == 0:
            steps.append(np.array(signs))
    return np.array(steps)


STEPS = _shortest_vectors()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest point with whole coordinates of even sum."""
    near = np.rint(x)
    error = x - near
    (odd,) = np.nonzero(near.sum(axis=1) % 2)
    worst = np.abs(error[odd]).argmax(axis=1)
    near[odd, worst] += np.where(error[odd, worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8, which is D8 together with D8 moved by a half."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def _mixed(key: np.ndarray) -> np.ndarray:
    key = (key ^ (key >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    key = (key ^ (key >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return key ^ (key >> np.uint64(33))


def _point_hash(points: np.ndarray, salt: int) -> np.ndarray:
    doubled = np.rint(points * 2).astype(np.int64).astype(np.uint64)
    key = np.full(len(points), salt * 2 + 1, np.uint64)
    for column in doubled.T:
        key = _mixed(key ^ (column * np.uint64(0x9E3779B97F4A7C15)))
    return key


def cells(unit: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Hash of the own cell and of the visited cells: one row per vector."""
    draw = np.random.default_rng([seed, table, unit.shape[1]])
    projected = unit @ draw.normal(0.0, SCALE, (unit.shape[1], 8 * BLOCKS))
    own, visits = [], []
    for b in range(BLOCKS):
        x = projected[:, 8 * b : 8 * b + 8]
        point = nearest_e8(x)
        own.append(_point_hash(point, b))
        # the nearest neighbours are the steps most in the direction of the rest
        toward = (x - point) @ STEPS.T
        chosen = np.argpartition(-toward, PROBES, axis=1)[:, :PROBES]
        visits.append(
            [_point_hash(point + STEPS[chosen[:, c]], b) for c in range(PROBES)]
        )
    salt = np.uint64((table + 1) * 0xD6E8FEB86659FD93 % (1 << 64))
    keys = [_mixed(np.bitwise_xor.reduce(own) ^ salt)]
    for b in range(BLOCKS):
        rest = np.bitwise_xor.reduce(own) ^ own[b]
        keys += [_mixed(rest ^ visit ^ salt) for visit in visits[b]]
    return np.stack(keys, axis=1).view(np.int64)


def _matrix(column) -> np.ndarray:
    """Vectors of equal length, from a list column, in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def near_vectors(
    embeddings: DataFrame,
    threshold: float = 0.98,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str | None = "label",
    seed: int = 1,
) -> DataFrame:
    """Links between vectors of equal label whose cosine is at least ``threshold``.

    One row per input row: the id, ``n_links`` (other rows linked directly),
    ``component_id`` (least id reachable by links, its own included) and ``kept`` (whether
    that is its own id).  Vectors that are null, empty, zero, or hold a null or a
    non-finite number, and rows whose label is null, link with nothing.  Vectors of
    different lengths do not link.  A null id sorts first.  Repeated rows, and other rows
    with equal vectors and labels, form a class and are compared once; they link with
    each other.  Other columns are not read.  An empty table gives no rows.

    The index finds the edges that connect classes.  All pairs inside a component are
    then counted by their cosine, in tasks of two blocks, so that links are exact there.
    """
    label = F.col(label_column) if label_column else F.lit(0)
    rows = embeddings.select(
        id_of(id_column).alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
        label.alias("label"),
    )
    sound = (
        F.col("label").isNotNull()
        & (F.size(F.coalesce("vector", F.array().cast("array<double>"))) > 0)
        & ~F.exists(
            "vector",
            lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
        )
        & F.exists("vector", lambda x: x != F.lit(0.0))
    )
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    usable = rows.where("sound").drop("sound")
    grouped = usable.groupBy("label", "vector").agg(
        F.count("*").alias("size"), F.min("id").alias("first")
    )
    classes = stored(
        grouped.withColumn("class", F.monotonically_increasing_id()), "classes"
    )
    edges = _index_edges(classes, threshold, seed)
    component = stored(connected_components(edges), "components")
    members = classes.join(component.withColumnRenamed("id", "class"), "class")
    links = _count_links(members, threshold)
    least = members.groupBy("component").agg(F.min("first").alias("least"))
    linked = (
        component.withColumnRenamed("id", "class")
        .join(links, "class", "left")
        .join(least, "component")
        .select("class", "links", "least")
    )
    found = classes.join(linked, "class", "left").select(
        "label",
        "vector",
        (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("least", "first").alias("component_id"),
    )
    result = usable.join(found, ["label", "vector"]).select(
        "id", "n_links", "component_id"
    )
    alone = rows.where("NOT sound").select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    return result.union(alone).select(
        public_id(F.col("id")).alias(id_column),
        "n_links",
        public_id(F.col("component_id")).alias("component_id"),
        (F.col("id") == F.col("component_id")).alias("kept"),
    )


def _index_edges(classes: DataFrame, threshold: float, seed: int) -> DataFrame:
    """Verified links that connect all candidates which are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                part = batch.filter(pa.array(lengths == length))
                unit = _unit(_matrix(part.column(1)))
                number = part.column(0).to_numpy()
                for t in range(TABLES):
                    keys = cells(unit, t, seed)
                    resident = np.zeros(keys.shape, bool)
                    resident[:, 0] = True
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(number, keys.shape[1])),
                            pa.array(keys.ravel()),
                            pa.array(resident.ravel()),
                            pa.array(np.full(keys.size, length, np.int32)),
                        ],
                        ["class", "cell", "resident", "length"],
                    )

    hashed = map_arrow(
        classes.select("class", "vector"),
        run,
        "class bigint, cell bigint, resident boolean, length int",
    )
    labelled = hashed.join(classes.select("class", "label"), "class")
    keyed = stored(
        labelled.select(
            "class",
            "resident",
            F.xxhash64("cell", "length", "label").alias("cell"),
        ),
        "cells",
    )
    shared = (
        keyed.groupBy("cell")
        .agg(F.count("*").alias("n"), F.max("resident").alias("lived"))
        .where("n > 1 AND lived")
        .select("cell")
    )
    met = keyed.join(shared, "cell").join(
        classes.select("class", "vector", "label"), "class"
    )
    dealt = paired_blocks(met, "cell", "class")
    partitions = shuffle_width(classes.sparkSession)

    def verify(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ends = np.append(starts[1:], rows.num_rows)
        a, b = [], []
        for start, end in zip(starts.tolist(), ends.tolist()):
            part = rows.slice(start, end - start)
            number = part["class"].to_numpy()
            label = part["label"].to_numpy(zero_copy_only=False)
            forest = Forest(len(number))
            lengths = part["vector"].combine_chunks().value_lengths()
            if len(number) < 2 or len(lengths.unique()) > 1:
                continue
            unit = _unit(_matrix(part["vector"]))
            for x, y in _links_in_tiles(unit, threshold):
                right = label[x] == label[y]
                forest.join(x[right], y[right])
            roots = forest.roots()
            (moved,) = np.nonzero(roots != np.arange(len(roots)))
            a.append(number[moved])
            b.append(number[roots[moved]])
        if a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"]
            )

    edges = map_groups(dealt, ["cell", "_i", "_j"], verify, "a bigint, b bigint", partitions)
    return edges.where("a <> b").distinct()


#: Rows of one step of a comparison, which bounds its memory.
TILE = 512


def _links_in_tiles(unit: np.ndarray, threshold: float):
    """Positions ``x < y`` of pairs whose cosine reaches the threshold."""
    for first in range(0, len(unit), TILE):
        cosine = unit[first : first + TILE] @ unit[first:].T
        x, y = np.nonzero(cosine >= threshold)
        upper = x < y
        yield x[upper] + first, y[upper] + first


def _count_links(members: DataFrame, threshold: float) -> DataFrame:
    """``class, links``: rows of other classes linked with it, each pair counted once."""
    dealt = paired_blocks(
        members.select("component", "class", "vector", "size"), "component", "class"
    )

    def count(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ends = np.append(starts[1:], rows.num_rows)
        numbers = rows["class"].to_numpy()
        sizes = rows["size"].to_numpy()
        own = rows["_own"].to_numpy()
        links = np.zeros(len(numbers), np.int64)
        for start, end in zip(starts.tolist(), ends.tolist()):
            unit = _unit(_matrix(rows["vector"].slice(start, end - start)))
            crossed = rows["_i"][start].as_py() != rows["_j"][start].as_py()
            block = own[start:end]
            for x, y in _links_in_tiles(unit, threshold):
                if crossed:
                    across = block[x] != block[y]
                    x, y = x[across], y[across]
                np.add.at(links, start + x, sizes[start + y])
                np.add.at(links, start + y, sizes[start + x])
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers), pa.array(links)], ["class", "links"]
        )

    counted = map_groups(
        dealt,
        ["component", "_i", "_j"],
        count,
        "class bigint, links bigint",
        shuffle_width(members.sparkSession),
    )
    return counted.groupBy("class").agg(F.sum("links").alias("links"))
