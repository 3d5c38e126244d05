"""Compression of vectors to short codes by Lloyd rounds over cover trees.

Components become whole numbers and vectors are cut into equal parts, each with a codebook
of its own.  Every task builds cover trees over the parts of its vectors, block by block,
once for all rounds (``cover_tree``).  In a round whole subtrees go to one entry where the
triangle inequality leaves no other, with their cumulative sums; only nodes that are
ambiguous are opened, down to exact comparisons of single parts.  All numbers are whole, so
results do not depend on how the rows are dealt to tasks.

The driver holds the codebooks and nothing else: a round sends it one sum per entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import cover_tree
from .common import map_arrow, stored

#: Vectors whose trees are built together, which bounds the memory of a step.
BLOCK_VECTORS = 8192
#: Steps of a component of 1.
SCALE = 256
#: Components beyond it count as it, so that 64 bits hold all sums and squares.
LARGEST = 1 << 24
#: Bytes of a row group of trees, which bounds what a reader holds.
TREE_GROUP = 16 << 20
#: A label with more than one row in so many is sent to all tasks; there are fewer of them.
HOT_LABELS = 100_000

_TREE = ("order", "first", "end", "radius", "child", "children")
_TREE_FIELDS = (
    "points array<int>, order array<int>, first array<int>, end array<int>,"
    " radius array<double>, child array<int>, children array<int>"
)


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    return np.clip(scaled, -LARGEST, LARGEST).astype(np.int64)


def _sound(rows: DataFrame) -> DataFrame:
    bad = F.exists(
        "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & ~bad)


def _planted(rows: DataFrame, parts: int, entries: int) -> tuple[DataFrame, np.ndarray | None]:
    """The rows of one length, and the parts of the first of them as codebooks."""
    order = [F.asc_nulls_last("id"), F.asc("vector")]
    usable = rows.where(F.size("vector") % parts == 0)
    least = usable.orderBy(*order).limit(1).collect()
    if not least:
        return usable, None
    usable = usable.where(F.size("vector") == len(least[0]["vector"]))
    first = usable.orderBy(*order).limit(entries).collect()
    numbers = whole_numbers(np.array([row["vector"] for row in first]))
    return usable, numbers.reshape(len(first), parts, -1).transpose(1, 0, 2)


def _trees(rows: DataFrame, parts: int) -> DataFrame:
    """One row per block of vectors: ids, labels and the trees of their parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_VECTORS):
                batch = whole.slice(at, BLOCK_VECTORS)
                size = batch.num_rows
                flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
                sets = whole_numbers(flat).reshape(size, parts, -1).transpose(1, 0, 2)
                forest = cover_tree.build(sets)
                arrays = [forest.points.ravel(), *[getattr(forest, name) for name in _TREE]]
                kinds = [np.float64 if a.dtype.kind == "f" else np.int32 for a in arrays]
                values = [
                    batch.column(0),
                    batch.column(1),
                    *[pa.array(a.astype(kind)) for a, kind in zip(arrays, kinds)],
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays([0, len(v)], v) for v in values],
                    ["ids", "labels", "points", *_TREE],
                )

    label = rows.schema["label"].dataType.simpleString()
    fields = f"ids array<bigint>, labels array<{label}>, {_TREE_FIELDS}"
    return map_arrow(rows.select("id", "label", "vector"), run, fields)


def _forests(batch: pa.RecordBatch, parts: int) -> Iterator[tuple[int, cover_tree.Forest]]:
    def column(name: str, row: int) -> np.ndarray:
        values = batch.column(name)[row].values.to_numpy(zero_copy_only=False)
        return values if values.dtype.kind == "f" else values.astype(np.int64)

    for row in range(batch.num_rows):
        tree = [column(name, row) for name in _TREE]
        points = column("points", row).reshape(len(tree[0]), -1)
        yield row, cover_tree.Forest(points, *tree, parts)


def _round(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one assignment of all parts; unused entries stay."""
    parts, entries, width = books.shape
    shared = trees.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        counts = np.zeros(parts * entries, np.int64)
        sums = np.zeros((parts * entries, width), np.int64)
        for batch in batches:
            for _, forest in _forests(batch, parts):
                plus = cover_tree.totals(forest, books)
                counts += plus[0]
                sums += plus[1]
        (used,) = np.nonzero(counts)
        total = np.concatenate([counts[used, None], sums[used]], axis=1)
        slot, place = np.meshgrid(used, np.arange(width + 1), indexing="ij")
        yield pa.RecordBatch.from_arrays(
            [pa.array(a.ravel()) for a in (slot, place, total)], ["slot", "place", "total"]
        )

    found = map_arrow(
        trees.select("points", *_TREE), run, "slot bigint, place bigint, total bigint"
    )
    # one row per component of the codebooks, and one per entry
    rows = found.groupBy("slot", "place").agg(F.sum("total").alias("total")).collect()
    total = np.zeros((parts * entries, width + 1), np.int64)
    for row in rows:
        total[row["slot"], row["place"]] = row["total"]
    used = total[:, 0] > 0
    out = books.reshape(parts * entries, width).copy()
    out[used] = total[used, 1:] // total[used, :1]
    return out.reshape(books.shape)


def _coded(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """``id, label, code, error`` of every vector."""
    parts = len(books)
    shared = trees.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = np.array([f"{n:02x}" for n in range(256)], "U2")
        for batch in batches:
            for row, forest in _forests(batch, parts):
                code, error = cover_tree.codes(forest, shared.value)
                text = np.ascontiguousarray(digits[code.T]).view(f"U{2 * parts}").ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[row].values,
                        batch.column("labels")[row].values,
                        pa.array(text, pa.string()),
                        pa.array(error.sum(axis=0)),
                    ],
                    ["id", "label", "code", "error"],
                )

    label = trees.schema["labels"].dataType.elementType.simpleString()
    return map_arrow(trees, run, f"id bigint, label {label}, code string, error bigint")


def _with_label_errors(coded: DataFrame) -> DataFrame:
    """Rows with the error of their label; frequent labels never meet in one task."""
    of = coded.groupBy("label").agg(
        F.sum("error").alias("label_error"), F.count("*").alias("rows")
    )
    of = stored(of.withColumnRenamed("label", "name"), "label_errors")
    total = of.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    frequent = F.col("rows") * HOT_LABELS > total
    # fewer than HOT_LABELS labels have more than that share of the rows
    hot = F.broadcast(of.where(frequent).select("name", "label_error"))
    met = coded.join(hot, F.col("label").eqNullSafe(F.col("name")), "left")
    done = met.where("label_error IS NOT NULL").drop("name")
    rest = met.where("label_error IS NULL").drop("name", "label_error")
    rare = of.where(~frequent).select("name", "label_error")
    late = rest.join(rare, F.col("label").eqNullSafe(F.col("name"))).drop("name")
    return done.unionByName(late)


def compress(
    embeddings: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """A code of ``parts`` entries for every vector, and the errors it leaves.

    One row per vector that is kept: the id, ``code`` (two hex digits per part), ``error``
    (squared distance to the entries, summed over the parts), ``label_error`` (of all
    vectors with an equal label; null labels are one) and ``codebooks_sha256`` (of the
    final components by part, entry and place).  Vectors that are null, empty or hold a
    null or a non-finite number are dropped; so are those whose length differs from that
    of the vector with the least id among those that can be cut.  With fewer vectors than
    ``entries`` a codebook has one entry per vector.  Components beyond ``LARGEST`` count
    as it.  Null ids come last; repeated rows are vectors of their own, those that share
    an id are ordered by their components.  Other columns are not read.  An empty table
    gives no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("A codebook has 1 to 256 entries, as a code has two digits for one.")
    rows = _sound(
        embeddings.select(
            F.col(id_column).try_cast("bigint").alias("id"),
            F.col(label_column).alias("label"),
            F.col(vector_column).cast("array<double>").alias("vector"),
        )
    )
    rows, books = _planted(rows, parts, entries)
    if books is None:
        coded, digest = rows.selectExpr(
            "id", "label", "'' AS code", "0L AS error", "0L AS label_error"
        ).where("false"), ""
    else:
        trees = stored(_trees(rows, parts), "trees", TREE_GROUP)
        for _ in range(rounds):
            books = _round(trees, books)
        coded = _with_label_errors(stored(_coded(trees, books), "codes"))
        numbers = ",".join(map(str, books.ravel().tolist()))
        digest = hashlib.sha256(numbers.encode()).hexdigest()
    return coded.select(
        F.col("id").alias(id_column),
        "code",
        "error",
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )
