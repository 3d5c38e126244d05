"""Compaction of datasets with many small files.

Names and row counts of the files are a small table; the rows themselves are never
shuffled.  Small files of a folder are packed by their row counts, a task reads the files
of some packs one after the other, and Spark's writer makes and commits the files.  Files
that are large enough, and those with no other to be packed with, are copied as they are.
"""

from __future__ import annotations

import hashlib
import shutil
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import scratch_path, ship_package
from ..sources.files import (
    file_table,
    layout_of,
    read_footers,
    root_length,
    segment_value,
    segments,
)
from ..sources.geoparquet import geometry_entries
from ..sources.parquet import scan_parquet, united_schema
from ..storage import open_filesystem, qualified
from .geoparquet import dataset_exists, header_from_footers, save_geoparquet
from .parquet import DEFAULT_ROWS_PER_FILE

#: Rows read from a file at a time.
_BATCH_ROWS = 65_536
#: Packs that one task rewrites, and files that one task copies.
_PACKS_PER_TASK = 4
_COPY_BYTES = 8 << 20


def compact_dataset(
    spark: SparkSession,
    source: str,
    target: str,
    target_rows: int = DEFAULT_ROWS_PER_FILE,
    mode: str = "errorifexists",
) -> str:
    """Merge the small files of a dataset into files of up to ``target_rows`` rows.

    Files are merged within their Hive partition; those with more than half of
    ``target_rows`` rows stay as they are.  Partition folders keep their names, and
    GeoParquet files have their footer.  Geometry stays encoded: bytes are copied, not
    parsed.  The columns are those of all files.  A dataset with a column that Spark
    cannot read is refused, as it would be lost.
    """
    if mode == "errorifexists" and dataset_exists(spark, target):
        raise FileExistsError(f"The output path {target} exists already.")
    files = file_table(spark, source)
    end = root_length(files, source)
    footers = _kept(spark, read_footers(files), "footers")
    layout = layout_of(footers, end)
    lost = united_schema(layout)[1] if layout.schemas else []
    if lost:
        raise ValueError(f"Cannot rewrite columns of these types: {', '.join(lost)}.")
    header = header_from_footers(geometry_entries(footers))
    scan = scan_parquet(spark, source, raw_partition_text=True, layout=layout)

    packs = _kept(spark, _packed(footers, end, target_rows), "packs")
    merged = packs.where(F.size("paths") > 1)
    count = merged.count()
    if not count:
        # something is rewritten in any case, so that the target has its schema
        least = packs.agg(F.min_by("pack", F.struct("rows", "pack"))).first()[0]
        merged, count = packs.where(F.col("pack") == least), 1
    copied = packs.join(merged.select("pack"), "pack", "left_anti")
    rows = _rows_of(merged, count, layout.keys, scan.schema)
    mode = "append" if mode == "errorifexists" else mode
    if header is not None:
        save_geoparquet(rows, target, header, layout.keys, target_rows, mode)
    else:
        writer = (
            rows.write.mode(mode)
            .option("compression", "snappy")
            .option("maxRecordsPerFile", target_rows)
        )
        (writer.partitionBy(*layout.keys) if layout.keys else writer).parquet(target)
    _copy(copied, qualified(spark, target))
    return target


def _kept(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Facts on files, written once and read by several jobs."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _packed(footers: DataFrame, end: int, target_rows: int) -> DataFrame:
    """``pack, folder, segments, paths, rows``: the files that are merged into one.

    Files of a folder are taken in the order of their names and packed one after the
    other, as long as the next one fits; a task holds one pack at a time.
    """
    schema = "pack string, folder string, segments array<string>, paths array<string>, rows bigint"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder, keys, paths, rows = None, None, [], 0

        def done() -> pa.RecordBatch:
            name = hashlib.sha256(paths[0].encode()).hexdigest()
            row = {"pack": name, "folder": folder, "segments": keys, "paths": list(paths)}
            row["rows"] = rows
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        arrow = pa.schema(
            [
                ("pack", pa.string()),
                ("folder", pa.string()),
                ("segments", pa.list_(pa.string())),
                ("paths", pa.list_(pa.string())),
                ("rows", pa.int64()),
            ]
        )
        for batch in batches:
            for file in batch.to_pylist():
                large = file["num_rows"] * 2 > target_rows
                # a file without rows weighs something too, as its name is kept
                weight = max(file["num_rows"], 1)
                full = rows + weight > target_rows
                if paths and (file["folder"] != folder or full or large):
                    yield done()
                    paths, rows = [], 0
                folder, keys = file["folder"], file["segments"]
                paths.append(file["path"])
                rows += weight
                if large:
                    yield done()
                    paths, rows = [], 0
        if paths:
            yield done()

    placed = footers.select(
        "path", "num_rows", segments(end).alias("segments")
    ).withColumn("folder", F.array_join("segments", "/"))
    # large files first, so that they do not part the small ones
    large = F.col("num_rows") * 2 > F.lit(target_rows)
    ordered = placed.repartition("folder").sortWithinPartitions(
        "folder", large.desc(), "path"
    )
    return ordered.mapInArrow(pack, schema)


def _rows_of(
    packs: DataFrame, count: int, keys: list[str], schema: T.StructType
) -> DataFrame:
    """The rows of all files of the packs, with their partition values as text."""
    spark = packs.sparkSession
    # a list of packs for each task of the next job, which reads its own
    path = qualified(spark, scratch_path(spark, "pack-lists"))
    tasks = -(-count // _PACKS_PER_TASK)
    values = F.array(
        *[segment_value(F.get("segments", F.lit(i))) for i in range(len(keys))]
    ).cast("array<string>")
    listed = packs.select("folder", values.alias("values"), "paths")
    dealt = listed.repartitionByRange(tasks, "folder", "paths")
    dealt.withColumn("task", F.spark_partition_id()).write.partitionBy("task").parquet(path)
    ship_package(spark)

    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.column(0).to_pylist():
                for row in packs_of(task):
                    of_folder = dict(zip(keys, row["values"]))
                    for file in row["paths"]:
                        yield from _file_rows(file, of_folder)

    def packs_of(task: int) -> Iterator[dict]:
        filesystem, folder = open_filesystem(f"{path}/task={task}")
        # a task has no list where fewer would do
        selector = fs.FileSelector(folder, allow_not_found=True)
        for info in filesystem.get_file_info(selector):
            if info.path.endswith(".parquet"):
                with filesystem.open_input_file(info.path) as opened:
                    yield from pq.ParquetFile(opened).read().to_pylist()

    def _file_rows(file: str, of_folder: dict) -> Iterator[pa.RecordBatch]:
        filesystem, inner = open_filesystem(file)
        with filesystem.open_input_file(inner) as opened:
            facts = pq.ParquetFile(opened, coerce_int96_timestamp_unit="us")
            stored = set(facts.schema_arrow.names) - set(of_folder)
            for batch in facts.iter_batches(_BATCH_ROWS):
                columns = []
                for field in arrow:
                    if field.name in of_folder:
                        value = pa.scalar(of_folder[field.name], field.type)
                        columns.append(pa.repeat(value, batch.num_rows))
                    elif field.name in stored:
                        columns.append(_fitted(batch.column(field.name), field.type))
                    else:
                        columns.append(pa.nulls(batch.num_rows, field.type))
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return spark.range(0, tasks, 1, tasks).mapInArrow(read, schema)


def _fitted(array: pa.Array, kind: pa.DataType) -> pa.Array:
    """The values in the type of the united schema, in which fields may have been added."""
    if array.type == kind:
        return array
    if pa.types.is_struct(kind) and pa.types.is_struct(array.type):
        present = {f.name: i for i, f in enumerate(array.type)}
        children = [
            _fitted(array.field(present[f.name]), f.type)
            if f.name in present
            else pa.nulls(len(array), f.type)
            for f in kind
        ]
        return pa.StructArray.from_arrays(children, fields=list(kind), mask=array.is_null())
    if pa.types.is_list(kind) and pa.types.is_list(array.type):
        lengths = array.value_lengths().fill_null(0)
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), lengths]).to_numpy().cumsum()
        values = _fitted(array.flatten(), kind.value_type)
        return pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), values, type=kind, mask=array.is_null()
        )
    # stored nanoseconds are cut as Spark cuts them
    if pa.types.is_timestamp(kind):
        return array.cast(pa.timestamp("us", array.type.tz), safe=False).cast(kind)
    return array.cast(kind)


def _copy(packs: DataFrame, target: str) -> None:
    """Copy files that stay as they are to the same folder of the target, in tasks.

    The name of the copy follows from the path of the file, so a copy can be repeated.
    """

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            for row in batch.to_pylist():
                for file in row["paths"]:
                    filesystem, inner = open_filesystem(file)
                    mark = hashlib.sha256(file.encode()).hexdigest()[:16]
                    name = f"part-{mark}-{file.rsplit('/', 1)[-1]}"
                    folder = "/".join([target.rstrip("/"), *row["segments"]])
                    goal, place = open_filesystem(folder)
                    goal.create_dir(place, recursive=True)
                    with (
                        filesystem.open_input_stream(inner) as opened,
                        goal.open_output_stream(f"{place}/{name}") as output,
                    ):
                        shutil.copyfileobj(opened, output, _COPY_BYTES)
                    done += 1
        yield pa.RecordBatch.from_arrays([pa.array([done])], ["done"])

    listed = packs.select("segments", "paths")
    listed.mapInArrow(copy, "done bigint").agg(F.sum("done")).collect()
