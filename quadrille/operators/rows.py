"""Row operators: sampling, covering with cells and grouping by cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import (
    DEFAULT_ZOOM,
    cell_of_point,
    cell_runs,
    quadkey,
    quadkey_in_row,
    row_digits,
    tile_x,
    tile_y,
)
from ..functions.geometry import centroid, envelope, let
from ..names import columns
from ..session import scratch_path


#: Rows that are taken by one task; more are taken by many.
ONE_TASK = 100_000
_PLACE = "__place"
# fixed value: bits of ``monotonically_increasing_id`` that count within a task
_PLACE_BITS = 33


def sample_rows(
    df: DataFrame, count: int | None, order_by: Column | list[Column] | None = None
) -> DataFrame:
    """The first ``count`` rows, in any order or in the order given; None takes all.

    A large sample is cut by all tasks: the rows of each are counted, the running sum of
    the counts tells in which task the sample ends, and a condition on the place of a row
    keeps those before.  That needs tasks that get the same rows again, as those of a scan
    do; sorted rows are written with their places first.  The rows of a large sample come
    in no order.
    """
    if count is None:
        return df
    if order_by is not None:
        keys = order_by if isinstance(order_by, list) else [order_by]
        df = df.orderBy(*keys)
    if count <= ONE_TASK:
        return df.limit(count)
    placed = df.withColumn(_PLACE, F.monotonically_increasing_id())
    if order_by is not None:
        path = scratch_path(df.sparkSession, "places")
        placed.write.parquet(path)
        placed = df.sparkSession.read.schema(placed.schema).parquet(path)
    # all columns are read, as with fewer a shuffle before would be divided otherwise
    counted = (
        placed.groupBy(F.shiftright(_PLACE, _PLACE_BITS).alias("task"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.bit_xor(F.xxhash64(F.lit(0), *columns(_hashable(df)))).alias("read"),
        )
        .orderBy("task")
    )
    left = count
    for row in counted.select("task", "rows", "read").toLocalIterator():
        if row["rows"] >= left:
            end = (row["task"] << _PLACE_BITS) + left
            return placed.where(F.col(_PLACE) < F.lit(end)).drop(_PLACE)
        left -= row["rows"]
    return df


def _hashable(df: DataFrame) -> list[str]:
    """Columns that can be hashed; a map cannot."""
    return [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]


def with_cell(
    df: DataFrame,
    zoom: int = DEFAULT_ZOOM,
    geometry: str = "geometry",
    name: str = "cell",
) -> DataFrame:
    """Add the cell of each geometry's centroid."""
    centre = F.col("__centre")
    placed = df.withColumn("__centre", centroid(F.col(geometry)))
    cell = cell_of_point(centre["x"], centre["y"], zoom)
    return placed.withColumn(name, cell).drop("__centre")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt to all tasks by ``keys``, before work that is heavy per row.

    A scan has as many tasks as its bytes ask for, and no more than the row groups of its
    files.  Rows of a few numbers that turn into shapes, covers or centroids would leave
    all of that to one task or two.  Deal them while they are narrow, by a key with many
    values.  The number of partitions is fixed, as the bytes say nothing of the work.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(width, *columns(keys))


# Cells of a run that stay together when a cover is dealt out, and such stretches.
_STRETCH = 4096
_STRETCHES = 16


def _stretches(runs: Column) -> Column:
    """``runs`` with long ones cut into stretches."""

    def cut(run: Column) -> Column:
        step = F.lit(_STRETCH).cast("bigint")
        return F.transform(
            F.sequence(run["first"], run["last"], step),
            lambda first: F.struct(
                run["row"].alias("row"),
                first.alias("first"),
                F.least(first + step - 1, run["last"]).alias("last"),
            ),
        )

    is_long = F.exists(runs, lambda run: run["last"] - run["first"] >= F.lit(_STRETCH))
    return F.when(is_long, F.flatten(F.transform(runs, cut))).otherwise(runs)


def _pieces(stretches: Column) -> Column:
    """Lists of a limited number of stretches; most features have one."""
    starts = F.sequence(F.lit(1), F.size(stretches), F.lit(_STRETCHES))
    several = F.transform(starts, lambda i: F.slice(stretches, i, _STRETCHES))
    return F.when(F.size(stretches) > F.lit(_STRETCHES), several).when(
        F.size(stretches) > F.lit(0), F.array(stretches)
    )


def cell_cover(
    df: DataFrame, zoom: int = DEFAULT_ZOOM, geometry: str = "geometry"
) -> DataFrame:
    """One row per feature and cell: the attributes and ``cell``; no row for null.

    Features are unfolded in two steps, first into pieces of some stretches of cells and
    then into cells.  The pieces are dealt to all tasks in between, so a feature that
    covers a continent is divided, and no task ever holds all of its cells; a small one
    is a single row there.
    """
    geom = F.col(geometry)
    attributes = columns(c for c in df.columns if c != geometry)
    pieces = df.select(*attributes, cell_runs(geom, zoom).alias("__runs")).select(
        *attributes,
        F.explode(let(F.col("__runs"), lambda r: let(_stretches(r), _pieces))).alias(
            "__piece"
        ),
    )
    # a fixed number of partitions: the few bytes here say nothing of the cells to come
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretches = pieces.repartition(width).select(
        *attributes, F.inline("__piece").alias("__row", "__first", "__last")
    )
    tiles = stretches.select(
        *attributes,
        row_digits(F.col("__row"), zoom).alias("__digits"),
        F.explode(F.sequence("__first", "__last")).alias("__column"),
    )
    cell = quadkey_in_row(F.col("__column"), F.col("__digits"), zoom)
    return tiles.select(*attributes, cell.alias("cell"))


def cell_rollup(
    df: DataFrame, zoom: int = DEFAULT_ZOOM, geometry: str = "geometry"
) -> DataFrame:
    """Rows and extent per cell: ``cell, features, xmin, ymin, xmax, ymax``.

    Counts, minima and maxima are combined before the shuffle, so a cell that holds a
    third of all rows sends no more than one row per input partition.  The rows are
    grouped by tile numbers; the cell's text is made once per group.
    """
    geom, centre = F.col(geometry), F.col("centre")
    placed = df.select(centroid(geom).alias("centre"), envelope(geom).alias("box"))
    tiles = placed.groupBy(
        tile_x(centre["x"], zoom).alias("tile_x"),
        tile_y(centre["y"], zoom).alias("tile_y"),
    ).agg(
        F.count(F.lit(1)).alias("features"),
        F.min("box.xmin").alias("xmin"),
        F.min("box.ymin").alias("ymin"),
        F.max("box.xmax").alias("xmax"),
        F.max("box.ymax").alias("ymax"),
    )
    cell = quadkey(F.col("tile_x"), F.col("tile_y"), zoom)
    return tiles.select(cell.alias("cell"), *tiles.columns[2:])
