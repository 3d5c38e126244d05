"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

#: White space between words: ASCII only, so that words are the same in every engine.
WORD_SPACE = " \t\n\x0b\f\r"

#: Stands for a null id inside the operators; sorts before every id in use.
NULL_ID = -(1 << 63)


def words_of(text: Column) -> Column:
    """Words between ASCII white space, as an array; an empty one for null."""
    spaced = F.translate(F.coalesce(text, F.lit("")), WORD_SPACE, " " * 6)
    return F.array_remove(F.split(spaced, " "), "")


def id_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("bigint"), F.lit(NULL_ID))


def public_id(column: Column) -> Column:
    return F.when(column != F.lit(NULL_ID), column)


def text_id(id_column: str, text_column: str) -> Column:
    """Id of a row; a null one becomes a number below all others, from the text.

    ``named`` turns it back.  Rows without an id are so told apart by their texts.
    """
    hashed = F.pmod(F.xxhash64(F.col(text_column)), F.lit(1 << 60))
    return F.coalesce(F.col(id_column).cast("bigint"), hashed + F.lit(-(1 << 63)))


def named(column: str) -> Column:
    return F.when(F.col(column) >= F.lit(-(1 << 62)), F.col(column))


def stored(df: DataFrame, label: str, group_bytes: int = 128 << 20) -> DataFrame:
    """The rows written to the shared folder and read again, which cuts the lineage.

    Later jobs then see one fixed set of rows, also after executors were lost.  Rows of
    some megabytes want row groups of fewer bytes.
    """
    path = scratch_path(df.sparkSession, label)
    write = df.write.option("compression", "zstd").option("parquet.block.size", group_bytes)
    write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that a task of ``gathered`` is worth, of numbers and sketches, and of texts.
GATHERED_ROWS = 1 << 15
GATHERED_TEXTS = 1 << 12


def gathered(df: DataFrame, rows: int, per_task: int = GATHERED_ROWS) -> DataFrame:
    """``df``, of about ``rows`` rows at most, in no more partitions than these fill.

    All rows come; partitions are put together, not dealt anew, and every core keeps one.
    A few rows in hundreds of shuffle partitions would become hundreds of files, each of
    which costs a task and, on a local disk, processes that set the file's permissions.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(cores, -(-rows // per_task)))


def map_arrow(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``mapInArrow`` in workers that can import this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def slices(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive parts whose texts hold about ``limit`` bytes.

    Bounds the memory of a step; every row comes, a long text in a part of its own.
    """
    if not batch.num_rows:
        return
    offsets = text_offsets(batch.column(column))
    first = 0
    while first < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), batch.num_rows)
        yield batch.slice(first, end - first)
        first = end


def text_offsets(array: pa.Array) -> np.ndarray:
    """Byte offsets of the values of a text or binary array, one more than rows."""
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    kind = np.int64 if wide else np.int32
    raw = np.frombuffer(array.buffers()[1], kind, array.offset + len(array) + 1)
    return raw[array.offset :].astype(np.int64)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_groups(
    df: DataFrame,
    keys: list[str],
    function: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]],
    schema: str,
    partitions: int,
) -> DataFrame:
    """``function(rows, starts)`` over whole groups of rows with equal keys.

    ``rows`` holds several whole groups one after the other and ``starts`` the first row
    of each.  A worker holds a few batches and the group that it is reading, so a group
    must have a bound of its own; ``paired_blocks`` gives one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            last = _tail_group(batch, keys)
            if held and not _same_key(held[0], batch, keys):
                yield from _call(held, keys, function)
                held = []
            if last:
                yield from _call([*held, batch.slice(0, last)], keys, function)
                held = []
            held.append(batch.slice(last))
        if held:
            yield from _call(held, keys, function)

    dealt = df.repartition(partitions, *keys).sortWithinPartitions(*keys)
    return map_arrow(dealt, run, schema)


def _columns(batch, keys) -> list[np.ndarray]:
    return [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    differs = np.zeros(len(columns[0]) - 1, bool)
    for column in columns:
        differs |= column[1:] != column[:-1]
    return np.concatenate([[0], np.nonzero(differs)[0] + 1])


def _tail_group(batch: pa.RecordBatch, keys: list[str]) -> int:
    return int(_changes(_columns(batch, keys))[-1])


def _same_key(a: pa.RecordBatch, b: pa.RecordBatch, keys: list[str]) -> bool:
    """Whether the first batch ends with the key with which the second begins."""
    return all(a.column(k)[-1].as_py() == b.column(k)[0].as_py() for k in keys)


def _call(batches, keys, function):
    rows = pa.Table.from_batches(batches).combine_chunks()
    yield from function(rows, _changes([rows[k].to_numpy() for k in keys]))


#: Members of a block; a task compares two blocks.
BLOCK = 2048
#: Weight of a block, where members differ in size.
BLOCK_WEIGHT = 2_000_000


def in_blocks(
    members: DataFrame, group: str, identity: str, weight: str | None = None
) -> DataFrame:
    """Members with ``_blocks``, the blocks of their group, and ``_own``, their block.

    A group is divided into blocks of about ``BLOCK`` members by the hash of their
    identity, and into smaller ones where their weights would exceed ``BLOCK_WEIGHT``.
    """
    heavy = F.sum(weight) / F.lit(BLOCK_WEIGHT) if weight else F.lit(0.0)
    number = F.ceil(F.greatest(F.count("*") / F.lit(BLOCK), heavy)).cast("int")
    blocks = members.groupBy(group).agg(number.alias("_blocks"))
    own = F.pmod(F.xxhash64(identity), F.col("_blocks")).cast("int")
    return members.join(blocks, group).withColumn("_own", own)


def block_tasks(dealt: DataFrame) -> DataFrame:
    """Members of ``in_blocks``, each in the tasks of its block.

    These are ``(_i, _j)`` for the block with every block of its group, so each pair of a
    group meets in exactly one task, pairs inside a block in the task ``_i = _j``.  No
    task holds more than two blocks, however large a group is, and no row stands for a
    pair.
    """
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return (
        dealt.withColumn("_other", other)
        .withColumn("_i", F.least("_own", "_other"))
        .withColumn("_j", F.greatest("_own", "_other"))
        .drop("_blocks", "_other")
    )


def paired_blocks(members: DataFrame, group: str, identity: str) -> DataFrame:
    """``block_tasks`` of ``in_blocks``."""
    return block_tasks(in_blocks(members, group, identity))


class Forest:
    """Union-find over the rows of a task, for arrays of pairs."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def join(self, x: np.ndarray, y: np.ndarray) -> None:
        while True:
            a, b = self.root[x], self.root[y]
            apart = a != b
            if not apart.any():
                return
            x, y, a, b = x[apart], y[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                above = self.root[self.root]
                if (above == self.root).all():
                    break
                self.root = above

    def roots(self) -> np.ndarray:
        return self.root
