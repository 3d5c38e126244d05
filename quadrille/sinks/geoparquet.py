"""GeoParquet sink.

Spark's own Parquet writer has no way to add key/value metadata to a footer, which
GeoParquet needs.  The files are therefore written by a Python data source: Spark
partitions and shuffles the rows and drives the commit, each task writes its Arrow
batches with pyarrow.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.geometry import (
    DEFAULT_SRID,
    GEOMETRY_TYPE,
    UNKNOWN_SRID,
    WEB_MERCATOR_SRID,
    BOUNDS,
    envelope,
    kind,
)
from ..functions.wkb import encode_batch
from ..names import column
from ..operators.schema import check_partition_columns
from ..session import ship_package
from ..sources.columns import geometry_field, srid_of
from ..sources.files import NULL_PARTITION, file_table
from ..storage import open_filesystem, qualified
from .parquet import DEFAULT_ROWS_PER_FILE, rebalanced, rows_of_bytes

GEOPARQUET_VERSION = "1.1.0"
FORMAT_NAME = "quadrille_geoparquet"

# Fixed value: footer key under which Spark stores and finds its own schema.
SPARK_SCHEMA_KEY = b"org.apache.spark.sql.parquet.row.metadata"

# Characters that Hive partition folders escape as %XX.
ESCAPED_IN_FOLDERS = frozenset('"#%\'*/:=?\\{[]^\x7f') | {chr(c) for c in range(1, 32)}

# PROJJSON of the two reference systems the engine can write.
_WGS84_DATUM = {
    "type": "GeodeticReferenceFrame",
    "name": "World Geodetic System 1984",
    "ellipsoid": {
        "name": "WGS 84",
        "semi_major_axis": 6378137,
        "inverse_flattening": 298.257223563,
    },
}
_DEGREE_AXES = {
    "subtype": "ellipsoidal",
    "axis": [
        {
            "name": "Geodetic latitude",
            "abbreviation": "Lat",
            "direction": "north",
            "unit": "degree",
        },
        {
            "name": "Geodetic longitude",
            "abbreviation": "Lon",
            "direction": "east",
            "unit": "degree",
        },
    ],
}
PROJJSON = {
    DEFAULT_SRID: {
        "$schema": "https://proj.org/schemas/v0.7/projjson.schema.json",
        "type": "GeographicCRS",
        "name": "WGS 84",
        "datum": _WGS84_DATUM,
        "coordinate_system": _DEGREE_AXES,
        "id": {"authority": "EPSG", "code": 4326},
    },
    WEB_MERCATOR_SRID: {
        "$schema": "https://proj.org/schemas/v0.7/projjson.schema.json",
        "type": "ProjectedCRS",
        "name": "WGS 84 / Pseudo-Mercator",
        "base_crs": {
            "name": "WGS 84",
            "datum": _WGS84_DATUM,
            "coordinate_system": _DEGREE_AXES,
            "id": {"authority": "EPSG", "code": 4326},
        },
        "conversion": {
            "name": "Popular Visualisation Pseudo-Mercator",
            "method": {
                "name": "Popular Visualisation Pseudo Mercator",
                "id": {"authority": "EPSG", "code": 1024},
            },
        },
        "coordinate_system": {
            "subtype": "Cartesian",
            "axis": [
                {
                    "name": "Easting",
                    "abbreviation": "X",
                    "direction": "east",
                    "unit": "metre",
                },
                {
                    "name": "Northing",
                    "abbreviation": "Y",
                    "direction": "north",
                    "unit": "metre",
                },
            ],
        },
        "id": {"authority": "EPSG", "code": 3857},
    },
}

# Rows collected before a row group is written.
_ROW_GROUP_ROWS = 122_880
_ROW_GROUP_BYTES = 128 << 20
_REMOVERS = 16
# Folder with the list of the accepted attempts; readers skip it.
_WRITTEN = "_written-"
_LIST = "attempts.txt"
# Name of the attempt in the name of a file: part-<job>-<attempt>-<number>.snappy.parquet
_ATTEMPT_IN_NAME = r"^part-[^-]+-(\d+-[^-]+)-"


# --- header -----------------------------------------------------------------------


def geoparquet_header(
    kinds: Sequence[str],
    srid: int = DEFAULT_SRID,
    bbox: Sequence[float] | None = None,
    column: str = "geometry",
    crs: str | None = None,
    covering: str | None = None,
) -> dict:
    """The ``geo`` footer of a file with one WKB geometry column.

    ``crs`` is the PROJJSON text of a system other than the two known ones, as it was
    read from another footer.  SRID 0 stands for an unknown system.  ``covering`` names
    the column with the extent of each row.
    """
    if srid in PROJJSON:
        system = PROJJSON[srid]
    elif crs is not None or srid == UNKNOWN_SRID:
        system = json.loads(crs) if crs else None
    else:
        raise ValueError(f"Cannot write SRID {srid} without its definition.")
    facts = {"encoding": "WKB", "geometry_types": sorted(kinds), "crs": system}
    if bbox is not None:
        facts["bbox"] = _checked_bbox(bbox)
    if covering is not None:
        facts["covering"] = covering_entry(covering)
    return {
        "version": GEOPARQUET_VERSION,
        "primary_column": column,
        "columns": {column: facts},
    }


def covering_entry(name: str) -> dict:
    """Where readers find the bounds of a row: the fields of the struct column."""
    return {"bbox": {side: [name, side] for side in BOUNDS}}


def _checked_bbox(bbox: Sequence[float]) -> list[float]:
    """Extent as the file format defines it: all minima, then all maxima, all finite.

    A western edge east of the eastern one means an extent across the antimeridian; the
    other axes have their minimum first.
    """
    values = [float(v) for v in bbox]
    axes, odd = divmod(len(values), 2)
    if odd or axes not in (2, 3) or not all(map(math.isfinite, values)):
        raise ValueError(f"An extent is 4 or 6 finite numbers, not {bbox!r}.")
    if any(low > high for low, high in zip(values[1:axes], values[axes + 1 :])):
        raise ValueError(f"The extent {bbox!r} ends before it begins.")
    return values


def header_of(df: DataFrame, geometry: str = "geometry") -> dict:
    """Header with the extent and the kinds of a whole table, in one aggregate pass.

    Only the geometry column is read for it.
    """
    geom = F.col(geometry)
    box = envelope(geom)
    row = df.agg(
        *[F.min(box[side]).alias(side) for side in ("xmin", "ymin")],
        *[F.max(box[side]).alias(side) for side in ("xmax", "ymax")],
        F.collect_set(kind(geom)).alias("kinds"),
    ).first()
    bbox = [row["xmin"], row["ymin"], row["xmax"], row["ymax"]]
    known = None if None in bbox else bbox
    metadata = geometry_field(df, geometry).metadata
    return geoparquet_header(
        row["kinds"], srid_of(df, geometry), known, crs=metadata.get("crs")
    )


def header_from_footers(footers: DataFrame) -> dict | None:
    """One header for all files of a GeoParquet dataset; None when it has no footer.

    Extents and geometry types are united.  Geometry columns keep their reference
    system, which must be the same in all files.
    """
    size = F.size("bbox")
    half = (size / 2).cast("int")
    low = [F.min(F.get("bbox", F.lit(i))) for i in (0, 1)]
    high = [F.max(F.get("bbox", half + i)) for i in (0, 1)]
    rows = (
        footers.groupBy("primary_column", "column", "encoding")
        .agg(
            F.count_distinct(F.coalesce("crs", F.lit(""))).alias("systems"),
            F.max("crs").alias("crs"),
            F.bool_and("crs_given").alias("crs_given"),
            F.array(*low, *high).alias("bbox"),
            F.min(F.coalesce("covering", F.lit(""))).alias("covering"),
            F.max(F.coalesce("covering", F.lit(""))).alias("other_covering"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("geometry_types"))))
            .alias("kinds"),
        )
        .collect()
    )
    if not rows:
        return None
    primaries = {r["primary_column"] for r in rows}
    if len(primaries) > 1 or any(r["systems"] > 1 for r in rows):
        raise ValueError("The files of the dataset do not share one geometry header.")
    columns = {}
    for row in rows:
        facts = {"encoding": row["encoding"], "geometry_types": row["kinds"] or []}
        if row["crs_given"]:
            facts["crs"] = json.loads(row["crs"]) if row["crs"] else None
        if None not in row["bbox"]:
            facts["bbox"] = row["bbox"]
        # a column that some files lack covers nothing
        if row["covering"] and row["covering"] == row["other_covering"]:
            facts["covering"] = json.loads(row["covering"])
        columns[row["column"]] = facts
    return {
        "version": GEOPARQUET_VERSION,
        "primary_column": primaries.pop(),
        "columns": columns,
    }


# --- write ------------------------------------------------------------------------


def write_geoparquet(
    df: DataFrame,
    path: str,
    partition_columns: Sequence[str] | str | None = None,
    rows_per_file: int = DEFAULT_ROWS_PER_FILE,
    mode: str = "append",
    geometry: str = "geometry",
    header: dict | None = None,
    covering: str | None = None,
    file_bytes: int | None = None,
) -> str:
    """Write a feature table as GeoParquet 1.1.

    Every file carries the extent and the kinds of the whole table.  They are computed
    first, in a pass over the geometry column; a caller who knows them hands in a
    ``header`` (see ``geoparquet_header``) and saves that pass.

    With ``covering`` a column of that name has the extent of each row, and the footer
    says so.  Readers that look for a window then skip the row groups that lie outside,
    most of them where the table is clustered (``cluster_by_cell``).  ``file_bytes`` is
    that of ``write_parquet``.
    """
    columns = check_partition_columns(df, partition_columns)
    found = geometry_field(df, geometry).dataType.simpleString()
    if found != GEOMETRY_TYPE:
        raise ValueError(f"Column '{geometry}' is not a geometry but {found}.")
    header = header or header_of(df, geometry)
    if covering is not None:
        if covering in df.columns:
            raise ValueError(f"The table has a column '{covering}' already.")
        geom = F.col(geometry)
        df = df.withColumn(covering, F.when(geom.isNotNull(), envelope(geom)))
        header = json.loads(json.dumps(header))
        header["columns"]["geometry"]["covering"] = covering_entry(covering)
    if geometry != "geometry":
        df = df.withColumnRenamed(geometry, "geometry")
    rows_per_file = rows_of_bytes(
        df, file_bytes, rows_per_file, lambda rows, to: save_geoparquet(rows, to, header)
    )
    arranged = rebalanced(df, columns) if columns else df
    return save_geoparquet(arranged, path, header, columns, rows_per_file, mode)


def save_geoparquet(
    df: DataFrame,
    path: str,
    header: dict,
    partition_columns: Sequence[str] = (),
    rows_per_file: int = DEFAULT_ROWS_PER_FILE,
    mode: str = "append",
) -> str:
    """Write a table whose geometry is a struct or WKB already, with a given header."""
    if mode not in ("append", "overwrite", "errorifexists"):
        raise ValueError(f"mode must be append, overwrite or errorifexists: {mode!r}.")
    spark = df.sparkSession
    if mode == "errorifexists" and dataset_exists(spark, path):
        raise FileExistsError(f"The output path {path} exists already.")
    _register(spark)
    keys = F.to_json(
        F.array(*[column(c).cast("string") for c in partition_columns]),
        {"ignoreNullFields": "false"},
    )
    body = df.drop(*partition_columns)
    if partition_columns:
        body = (
            df.withColumn(_KEY_COLUMN, keys)
            .drop(*partition_columns)
            .sortWithinPartitions(_KEY_COLUMN)
        )
    target, job = qualified(spark, path).rstrip("/"), uuid.uuid4().hex
    filesystem, root = open_filesystem(target)
    _remove_file(filesystem, f"{root}/_SUCCESS")
    (
        body.write.format(FORMAT_NAME)
        .mode("overwrite" if mode == "overwrite" else "append")
        .option("target", target)
        .option("job", job)
        .option("header", json.dumps(header))
        .option("partition_columns", json.dumps(list(partition_columns)))
        .option("rows_per_file", rows_per_file)
        .save()
    )
    keep_accepted(spark, target, job, mode == "overwrite")
    return path


def keep_accepted(spark: SparkSession, target: str, job: str, overwrite: bool) -> None:
    """Remove what a job's attempts left that Spark did not accept; old files, too, on
    overwrite.

    The names of the files tell their attempt, and a list in ``_written-<job>`` names the
    accepted ones.  Tasks remove the files, and it can be repeated.  In the end the list
    becomes ``_SUCCESS``.
    """
    filesystem, root = open_filesystem(target)
    accepted = f"{_WRITTEN}{job}"
    kept = spark.read.text(f"{target}/{accepted}").toDF("_attempt")
    name = F.substring_index("path", "/", -1)
    ours = name.startswith(f"part-{job}-")
    attempt = F.when(ours, F.regexp_extract(name, _ATTEMPT_IN_NAME, 1))
    files = file_table(spark, target).select("path", attempt.alias("_attempt"))
    if not overwrite:
        files = files.where("_attempt IS NOT NULL")
    unwanted = files.join(kept, "_attempt", "left_anti").select("path")
    _acting(unwanted, _remove)
    filesystem.move(f"{root}/{accepted}/{_LIST}", f"{root}/_SUCCESS")
    filesystem.delete_dir(f"{root}/{accepted}")


def _acting(names: DataFrame, action) -> None:
    """Run an action on each name, in tasks, several at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(_REMOVERS) as pool:
            for batch in batches:
                done = len(list(pool.map(action, batch.column(0).to_pylist())))
                yield pa.RecordBatch.from_arrays([pa.array([done])], ["done"])

    names.mapInArrow(run, "done bigint").agg(F.sum("done")).collect()


def _remove(path: str) -> None:
    _remove_file(*open_filesystem(path))


def _remove_file(filesystem: fs.FileSystem, path: str) -> None:
    if filesystem.get_file_info(path).type == fs.FileType.File:
        filesystem.delete_file(path)


def dataset_exists(spark: SparkSession, path: str) -> bool:
    """True when the path holds at least one visible Parquet file."""
    try:
        return not file_table(spark, path).isEmpty()
    except FileNotFoundError:
        return False


_KEY_COLUMN = "__partition_values"


def _register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(GeoParquetDataSource)


def _folder(names: list[str], key: str) -> str:
    """Hive folder of a JSON list of partition values."""

    def escaped(text: str) -> str:
        return "".join(
            f"%{ord(c):02X}" if c in ESCAPED_IN_FOLDERS else c for c in text
        )

    values = [NULL_PARTITION if v in (None, "") else escaped(v) for v in json.loads(key)]
    return "/".join(f"{escaped(n)}={v}" for n, v in zip(names, values))


@dataclass
class WrittenFiles(WriterCommitMessage):
    """The attempt of one task and the number of its files."""

    attempt: str
    files: int


class GeoParquetDataSource(DataSource):
    """Write-only data source behind ``write_geoparquet``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT_NAME

    def writer(self, schema: T.StructType, overwrite: bool) -> GeoParquetWriter:
        return GeoParquetWriter(dict(self.options), schema, overwrite)


class GeoParquetWriter(DataSourceArrowWriter):
    """Writes each task's rows to files of the dataset that are named after the attempt.

    A task writes under names that readers skip and takes the dot away when all its rows
    are written, as with Spark's own committer of version 2; ``_SUCCESS`` is absent until
    the whole table is there.  The commit lists the attempts that Spark accepted, a line
    for each task, and ``keep_accepted`` removes the files of others.

    The folder of the list exists while the job does.  A task that finds it gone after it
    has shown its files takes them back, so an aborted job shows nothing.
    """

    def __init__(self, options: dict, schema: T.StructType, overwrite: bool):
        self.target = options["target"].rstrip("/")
        self.job = options["job"]
        self.geo = options["header"].encode("utf-8")
        self.columns = json.loads(options["partition_columns"])
        self.rows_per_file = int(options["rows_per_file"])
        self.schema = schema
        self.overwrite = overwrite
        filesystem, root = open_filesystem(self.target)
        filesystem.create_dir(f"{root}/{_WRITTEN}{self.job}", recursive=True)

    # in the tasks

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFiles:
        attempt = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        output = self._output(attempt)
        try:
            for batch in iterator:
                for key, piece in self._split(batch):
                    folder = _folder(self.columns, key) if self.columns else ""
                    output.add(folder, self._encoded(piece))
            output.show()
            if not self._goes_on():
                raise RuntimeError("The write was aborted.")
        except BaseException:
            output.discard()
            raise
        return WrittenFiles(attempt, len(output.files))

    def _goes_on(self) -> bool:
        filesystem, root = open_filesystem(self.target)
        folder = filesystem.get_file_info(f"{root}/{_WRITTEN}{self.job}")
        return folder.type == fs.FileType.Directory

    def _output(self, attempt: str) -> _TaskOutput:
        filesystem, root = open_filesystem(self.target)
        stem = f"part-{self.job}-{attempt}"
        return _TaskOutput(filesystem, root, stem, self._footer(), self.rows_per_file)

    def _footer(self) -> dict[bytes, bytes]:
        """The ``geo`` header, and the schema that Spark keeps column metadata in."""

        def stored(f: T.StructField) -> T.StructField:
            data_type = T.BinaryType() if f.name == "geometry" else f.dataType
            return T.StructField(f.name, data_type, True, f.metadata)

        schema = T.StructType([stored(f) for f in self.schema if f.name != _KEY_COLUMN])
        return {b"geo": self.geo, SPARK_SCHEMA_KEY: schema.json().encode("utf-8")}

    def _split(self, batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
        """Runs of equal partition values; the rows come sorted by them."""
        if not self.columns:
            if batch.num_rows:
                yield "", batch
            return
        at = batch.schema.get_field_index(_KEY_COLUMN)
        runs = pc.run_end_encode(batch.column(at))
        body = batch.remove_column(at)
        start = 0
        for key, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
            yield key, body.slice(start, end - start)
            start = end

    def _encoded(self, batch: pa.RecordBatch) -> pa.Table:
        table = pa.Table.from_batches([batch])
        at = table.schema.get_field_index("geometry")
        if at >= 0 and pa.types.is_struct(table.schema.field(at).type):
            wkb = [encode_batch(c) for c in table.column(at).chunks]
            table = table.set_column(at, "geometry", pa.chunked_array(wkb, pa.binary()))
        return table

    # on the driver

    def commit(self, messages: list[WrittenFiles | None]) -> None:
        filesystem, root = open_filesystem(self.target)
        done = [m.attempt for m in messages if m is not None and m.files]
        if not done and not self.columns:
            done = [self._write_empty()]
        listed = f"{root}/{_WRITTEN}{self.job}/{_LIST}"
        with filesystem.open_output_stream(listed) as output:
            output.write("".join(f"{attempt}\n" for attempt in done).encode())

    def abort(self, messages: list[WrittenFiles | None]) -> None:
        """Files of tasks that had finished go; the others remove theirs."""
        filesystem, root = open_filesystem(self.target)
        if self._goes_on():
            filesystem.delete_dir(f"{root}/{_WRITTEN}{self.job}")
        selector = fs.FileSelector(root, allow_not_found=True, recursive=True)
        for info in filesystem.get_file_info(selector):
            if info.base_name.startswith(f"part-{self.job}-"):
                _remove_file(filesystem, info.path)

    def _write_empty(self) -> str:
        """A table without rows still gets a file, so that its schema can be read."""
        schema = to_arrow_schema(self.schema)
        at = schema.get_field_index("geometry")
        schema = schema.set(at, pa.field("geometry", pa.binary()))
        attempt = "00000-empty"
        output = self._output(attempt)
        output.add("", schema.empty_table())
        output.show()
        return attempt

class _TaskOutput:
    """One open file at a time; a new one for each folder and after enough rows."""

    def __init__(
        self,
        filesystem: fs.FileSystem,
        root: str,
        stem: str,
        footer: dict[bytes, bytes],
        rows_per_file: int,
    ):
        self.filesystem, self.root, self.stem = filesystem, root, stem
        self.footer, self.rows_per_file = footer, rows_per_file
        self.files: list[str] = []
        self.folder: str | None = None
        self.writer: pq.ParquetWriter | None = None
        self.pending: list[pa.Table] = []
        self.pending_rows = self.pending_bytes = self.file_rows = 0

    def add(self, folder: str, table: pa.Table) -> None:
        if folder != self.folder:
            self.close()
            self.folder = folder
        while True:
            if self.writer is None:
                self._open(table.schema)
            piece = table.slice(0, self.rows_per_file - self.file_rows)
            self.pending.append(piece)
            self.pending_rows += piece.num_rows
            self.pending_bytes += piece.nbytes
            self.file_rows += piece.num_rows
            full = self.pending_bytes >= _ROW_GROUP_BYTES
            if full or self.pending_rows >= _ROW_GROUP_ROWS:
                self._flush()
            if self.file_rows >= self.rows_per_file:
                self._finish()
            table = table.slice(piece.num_rows)
            if not table.num_rows:
                return

    def close(self) -> None:
        if self.writer is not None:
            self._finish()

    def show(self) -> None:
        """Finish, and give the files names that readers see."""
        self.close()
        for relative in self.files:
            self.filesystem.move(self._hidden(relative), f"{self.root}/{relative}")

    def discard(self) -> None:
        """Remove the files again, also the one that is open."""
        if self.writer is not None:
            self.writer.close()
        for relative in self.files:
            _remove_file(self.filesystem, self._hidden(relative))
            _remove_file(self.filesystem, f"{self.root}/{relative}")

    def _hidden(self, relative: str) -> str:
        folder, _, name = f"{self.root}/{relative}".rpartition("/")
        return f"{folder}/.{name}"

    def _open(self, schema: pa.Schema) -> None:
        name = f"{self.stem}-{len(self.files):05d}.snappy.parquet"
        relative = f"{self.folder}/{name}" if self.folder else name
        target = self._hidden(relative)
        self.filesystem.create_dir(target.rsplit("/", 1)[0], recursive=True)
        metadata = {**(schema.metadata or {}), **self.footer}
        self.writer = pq.ParquetWriter(
            target,
            schema.with_metadata(metadata),
            filesystem=self.filesystem,
            compression="snappy",
        )
        self.files.append(relative)

    def _flush(self) -> None:
        if self.pending:
            self.writer.write_table(
                pa.concat_tables(self.pending), row_group_size=_ROW_GROUP_ROWS
            )
        self.pending, self.pending_rows, self.pending_bytes = [], 0, 0

    def _finish(self) -> None:
        self._flush()
        self.writer.close()
        self.writer, self.file_rows = None, 0
