"""Queries over datasets written first: scans, partitions, sinks and GeoParquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.functions.geometry import BOUNDS, centroid, envelope, first_point, kind
from quadrille.functions.text import partition_fallback
from quadrille.functions.wkb import to_wkb
from quadrille.plans.export import export_features
from quadrille.plans.imports import import_features, read_stored
from quadrille.session import scratch_path
from quadrille.sinks.compact import compact_dataset
from quadrille.sinks.geoparquet import header_of, write_geoparquet
from quadrille.sinks.parquet import cluster_by_cell, write_parquet
from quadrille.sources.columns import points_from_wkb, points_from_xy
from quadrille.sources.files import list_part_files, list_partitions, read_footers
from quadrille.sources.geoparquet import (
    bbox_from_footers,
    geoparquet_footers,
    read_geoparquet,
)
from quadrille.sources.parquet import scan_parquet, scan_partition

from .inputs import (
    BAD_SQL,
    HALF,
    LAT,
    LON,
    ONE,
    PTS_SQL,
    all_shapes,
    bad_coordinates,
    coordinates,
    lines,
    point_cell_sql,
    points,
    squares,
    table,
)
from .registry import query


LINEITEM_KEYS = ["l_returnflag", "l_linestatus"]


# --- scans and plain sinks --------------------------------------------------------


@query("scan_parquet", "SELECT * FROM orders")
def scan_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir}/orders.parquet")


def _partitioned_lineitem(spark: SparkSession, sf_dir: str, label: str) -> str:
    lineitem = table(spark, sf_dir, "lineitem")
    return write_parquet(lineitem, scratch_path(spark, label), LINEITEM_KEYS)


@query(
    "partition_scan",
    "SELECT * FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'",
)
def scan_one_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _partitioned_lineitem(spark, sf_dir, "partition-scan")
    return scan_partition(spark, path, "l_returnflag=A/l_linestatus=F")


@query(
    "partition_list",
    """
WITH days AS (SELECT year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders)
SELECT CASE WHEN month IS NULL THEN 1 ELSE 2 END AS level,
       'year=' || year || coalesce('/month=' || month, '') AS partition,
       CAST(year AS DECIMAL(38,0)) AS year, CAST(month AS DECIMAL(38,0)) AS month
FROM days GROUP BY ROLLUP(year, month) HAVING year IS NOT NULL
""",
)
def list_order_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    )
    path = write_parquet(days, scratch_path(spark, "days"), ["year", "month"])
    return list_partitions(spark, path)


@query(
    "part_files",
    """
SELECT l_returnflag, l_linestatus, count(*) AS stored_rows
FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL
""",
)
def rows_in_part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts from the footers of the part files below matching folders."""
    path = _partitioned_lineitem(spark, sf_dir, "part-files")
    files = list_part_files(spark, path, contains=["l_linestatus=F"])
    folder = F.regexp_extract("path", "l_returnflag=([^/]+)/l_linestatus=([^/]+)/", 1)
    status = F.regexp_extract("path", "l_returnflag=([^/]+)/l_linestatus=([^/]+)/", 2)
    return (
        read_footers(files)
        .groupBy(folder.alias("l_returnflag"), status.alias("l_linestatus"))
        .agg(F.sum("num_rows").alias("stored_rows"))
    )


@query("write_roundtrip", "SELECT * FROM orders")
def write_and_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders")
    return scan_parquet(spark, write_parquet(orders, path, rows_per_file=5000))


@query("sized_roundtrip", "SELECT * FROM lineitem")
def write_files_of_bytes_and_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "sized")
    return scan_parquet(spark, write_parquet(lineitem, path, file_bytes=1 << 18))


@query("partition_roundtrip", "SELECT * FROM lineitem")
def write_and_scan_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_parquet(spark, _partitioned_lineitem(spark, sf_dir, "lineitem"))


@query("append_union", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "appended")
    for _ in range(2):
        write_parquet(table(spark, sf_dir, "orders"), path)
    return scan_parquet(spark, path)


@query(
    "partition_fallback",
    """
SELECT doc_id, text, source, n_chars,
       coalesce(nullif(lang, 'en'), '__unknown__') AS lang
FROM documents
""",
)
def fallback_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    lang = partition_fallback(F.nullif(F.col("lang"), F.lit("en")))
    path = scratch_path(spark, "languages")
    write_parquet(documents.withColumn("lang", lang), path, "lang")
    return scan_parquet(spark, path)


@query("compact_roundtrip", "SELECT * FROM lineitem")
def compact_small_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").repartition(8)
    source = scratch_path(spark, "small-files")
    write_parquet(lineitem, source, LINEITEM_KEYS, rows_per_file=2000)
    target = scratch_path(spark, "compacted")
    return scan_parquet(spark, compact_dataset(spark, source, target))


@query(
    "compact_evolved",
    """
SELECT l_orderkey, l_linenumber, l_returnflag,
       CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS l_shipdate,
       CASE WHEN l_linestatus <> 'F' THEN l_quantity END AS l_quantity
FROM lineitem
""",
)
def compact_files_of_two_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written at different times, each with a column that the other lacks."""
    lineitem = table(spark, sf_dir, "lineitem")
    source = scratch_path(spark, "evolved")
    common = ["l_orderkey", "l_linenumber", "l_returnflag"]
    for condition, own in (("= 'F'", "l_shipdate"), ("<> 'F'", "l_quantity")):
        part = lineitem.where(f"l_linestatus {condition}").select(*common, own)
        write_parquet(part, source, ["l_returnflag"], mode="append")
    target = scratch_path(spark, "evolved-compacted")
    return scan_parquet(spark, compact_dataset(spark, source, target))


@query(
    "cluster_roundtrip",
    f"WITH {PTS_SQL} SELECT k, lon, lat, {point_cell_sql('lon', 'lat', 8)} AS cell"
    " FROM pts",
)
def cluster_and_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered = cluster_by_cell(points(spark, sf_dir), 8)
    path = write_parquet(clustered.drop("geometry"), scratch_path(spark, "clustered"))
    return scan_parquet(spark, path)


# --- GeoParquet -------------------------------------------------------------------


def _geoparquet(spark: SparkSession, df: DataFrame, label: str, **options) -> str:
    return write_geoparquet(df, scratch_path(spark, label), **options)


@query(
    "geoparquet_roundtrip",
    f"WITH {PTS_SQL} SELECT k, lon, lat, 'Point' AS kind, lon AS x, lat AS y FROM pts",
)
def geoparquet_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _geoparquet(spark, points(spark, sf_dir), "points", rows_per_file=5000)
    point = centroid(F.col("geometry"))
    return read_geoparquet(spark, path).select(
        "k",
        "lon",
        "lat",
        kind(F.col("geometry")).alias("kind"),
        point["x"].alias("x"),
        point["y"].alias("y"),
    )


@query(
    "geoparquet_shapes",
    f"""
WITH {PTS_SQL}
SELECT k, 'Point' AS kind, 1 AS vertices, lon AS xmin, lat AS ymin, lon AS xmax,
       lat AS ymax FROM pts
UNION ALL SELECT k, 'MultiPoint', 3, lon, lat, lon+{ONE}, lat+{HALF} FROM pts
UNION ALL SELECT k, 'LineString', 3, lon, lat, lon+{ONE}, lat+{HALF} FROM pts
UNION ALL SELECT k, 'Polygon', 5, lon, lat, lon+{HALF}, lat+{HALF} FROM pts
""",
)
def geoparquet_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All kinds of geometry, written to partition folders and read back."""
    shapes = all_shapes(spark, sf_dir).drop("lon", "lat")
    shapes = shapes.withColumn("shape", kind(F.col("geometry")))
    path = _geoparquet(spark, shapes, "shapes", partition_columns="shape")
    geom = F.col("geometry")
    box = envelope(geom)
    return read_geoparquet(spark, path).select(
        "k",
        F.col("shape").alias("kind"),
        F.size(F.flatten(F.flatten(geom["polys"]))).alias("vertices"),
        *[box[side].alias(side) for side in ("xmin", "ymin", "xmax", "ymax")],
    )


@query(
    "geoparquet_footers",
    f"""
WITH {PTS_SQL}
SELECT '1.1.0' AS version, 'geometry' AS primary_column, 'geometry' AS "column",
       'WKB' AS encoding, 'LineString' AS kinds, min(lon) AS xmin, min(lat) AS ymin,
       max(lon+{ONE}) AS xmax, max(lat+{HALF}) AS ymax, count(*) AS stored_rows
FROM pts
""",
)
def footers_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file must carry the same header, with the extent of the whole table."""
    df = lines(spark, sf_dir).repartition(4)
    footers = geoparquet_footers(spark, _geoparquet(spark, df, "lines"))
    bounds = ("xmin", "ymin", "xmax", "ymax")
    header = ["version", "primary_column", "column", "encoding"]
    return (
        footers.select(
            *header,
            F.array_join("geometry_types", ",").alias("kinds"),
            *[F.get("bbox", F.lit(i)).alias(side) for i, side in enumerate(bounds)],
            "num_rows",
        )
        .groupBy(*header, "kinds", *bounds)
        .agg(F.sum("num_rows").alias("stored_rows"))
    )


@query(
    "footer_bbox",
    f"""
WITH {PTS_SQL}
SELECT min(lon) AS xmin, min(lat) AS ymin, max(lon+{HALF}) AS xmax,
       max(lat+{HALF}) AS ymax, cast(1 AS bigint) AS headers
FROM pts
""",
)
def bbox_of_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _geoparquet(spark, squares(spark, sf_dir).repartition(4), "squares")
    return bbox_from_footers(geoparquet_footers(spark, path))


_WINDOW = (-30.0, -20.0, 45.0, 50.0)


@query(
    "window_scan",
    f"""
WITH {PTS_SQL}
SELECT k, lon, lat, lon AS xmin, lat AS ymin, lon+{HALF} AS xmax, lat+{HALF} AS ymax
FROM pts WHERE lon <= 45 AND lon+{HALF} >= -30 AND lat <= 50 AND lat+{HALF} >= -20
""",
)
def squares_in_a_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clustered squares with an extent per row, of which a window is read."""
    placed = squares(spark, sf_dir)
    clustered = cluster_by_cell(placed, 8).drop("cell")
    # the header knows no order, so it is taken before the rows are sorted
    path = _geoparquet(
        spark,
        clustered,
        "covered",
        rows_per_file=2000,
        covering="bbox",
        header=header_of(placed),
    )
    box = envelope(F.col("geometry"))
    return read_geoparquet(spark, path, window=_WINDOW).select(
        "k", "lon", "lat", *[box[side].alias(side) for side in BOUNDS]
    )


@query("wkb_column", f"WITH {PTS_SQL} SELECT k, lon AS x, lat AS y FROM pts")
def points_of_wkb_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plain Parquet file with a WKB column and no ``geo`` footer."""
    encoded = points(spark, sf_dir).select("k", to_wkb(F.col("geometry")).alias("wkb"))
    path = write_parquet(encoded, scratch_path(spark, "wkb"))
    decoded = points_from_wkb(scan_parquet(spark, path), "wkb")
    point = centroid(F.col("geometry"))
    return decoded.select("k", point["x"].alias("x"), point["y"].alias("y"))


# --- entry points -----------------------------------------------------------------


@query(
    "import_xy",
    f"WITH {PTS_SQL} SELECT k, lon, lat, lon AS x, lat AS y FROM pts",
)
def import_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_parquet(coordinates(spark, sf_dir), scratch_path(spark, "coordinates"))
    loaded = import_features(spark, path, "COORDINATES", ["lon", "lat"])
    point = centroid(F.col("geometry"))
    return loaded.features.select(
        "k", "lon", "lat", point["x"].alias("x"), point["y"].alias("y")
    )


@query(
    "import_rejects",
    f"""
WITH {BAD_SQL}
SELECT k, lon, lat, 'latitude out of range' AS reject_reason FROM bad
WHERE lon IS NOT NULL AND abs(lat) > 90
""",
)
def import_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = bad_coordinates(spark, sf_dir)
    path = write_parquet(df, scratch_path(spark, "bad-coordinates"))
    loaded = import_features(spark, path, "COORDINATES", ["lon", "lat"])
    return loaded.rejected.select("k", "lon", "lat", "reject_reason")


@query(
    "import_store",
    f"""
WITH {BAD_SQL},
judged AS (
  SELECT k, lon, lat,
    CASE WHEN lon IS NOT NULL AND abs(lat) > 90 THEN 'latitude out of range' END AS reason
  FROM bad)
SELECT k, lon, lat, reason AS reject_reason,
       count(*) FILTER (reason IS NULL) OVER () AS added,
       count(*) FILTER (reason IS NOT NULL) OVER () AS failed
FROM judged
""",
)
def store_good_and_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of rows from one job, and the counts that it took on the way."""
    path = write_parquet(bad_coordinates(spark, sf_dir), scratch_path(spark, "bad-coordinates"))
    loaded = import_features(spark, path, "COORDINATES", ["lon", "lat"])
    target = scratch_path(spark, "stored")
    counts = loaded.store(target)
    features, rejected = read_stored(spark, target)
    columns = ["k", "lon", "lat"]
    return (
        features.select(*columns, F.lit(None).cast("string").alias("reject_reason"))
        .unionByName(rejected.select(*columns, "reject_reason"))
        .withColumn("added", F.lit(counts["added"]).cast("bigint"))
        .withColumn("failed", F.lit(counts["failed"]).cast("bigint"))
    )


@query(
    "export_import",
    """
WITH """
    + PTS_SQL
    + """
SELECT c_custkey AS custkey, c_mktsegment AS segment,
       round(c_acctbal, 2) AS balance, lon AS x, lat AS y
FROM customer JOIN pts ON c_custkey = k
""",
)
def export_and_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table to partitioned GeoParquet and back, by the two entry points."""
    customer = table(spark, sf_dir, "customer")
    placed = customer.selectExpr("*", f"{LON} AS lon", f"{LAT} AS lat")
    features = points_from_xy(placed, "lon", "lat").drop("lon", "lat")
    path = scratch_path(spark, "exported")
    export_features(features, path, partition_columns="c_mktsegment")
    loaded = import_features(spark, path)
    return loaded.features.where(F.col("geometry").isNotNull()).select(
        F.col("c_custkey").alias("custkey"),
        F.col("c_mktsegment").alias("segment"),
        F.round("c_acctbal", 2).alias("balance"),
        first_point(F.col("geometry"))["x"].alias("x"),
        first_point(F.col("geometry"))["y"].alias("y"),
    )
