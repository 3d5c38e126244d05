"""Plain Parquet sinks, clustering, compaction and exports."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from shapes import EXAMPLES, frame

from quadrille import export_features
from quadrille.operators.rows import sample_rows
from quadrille.operators.schema import check_export_format
from quadrille.sinks.compact import compact_dataset
from quadrille.sinks.geoparquet import write_geoparquet
from quadrille.sinks.parquet import cluster_by_cell, write_parquet
from quadrille.sources.geoparquet import geoparquet_footers, read_geoparquet
from quadrille.sources.parquet import scan_parquet


def files(folder):
    return sorted(Path(folder).rglob("*.parquet"))


def key_of(file):
    return file.parent.name


def test_rows_per_file(spark, folder):
    write_parquet(spark.range(0, 1000, 1, 1), folder, rows_per_file=300)
    assert sorted(pq.read_metadata(f).num_rows for f in files(folder)) == [
        100, 300, 300, 300,
    ]
    assert pq.read_metadata(files(folder)[0]).row_group(0).column(0).compression == (
        "SNAPPY"
    )


@pytest.mark.parametrize("kind", ["narrow", "wide", "geometry"])
def test_files_of_a_size(spark, folder, kind):
    """Rows of a few bytes and of thousands give files of about the same size."""
    from quadrille.sources.columns import points_from_xy

    if kind == "wide":
        parts = F.concat(*[F.sha2(F.concat(F.lit(str(i)), "id"), 512) for i in range(30)])
        df = spark.range(0, 3000, 1, 1).select("id", parts.alias("text"))
    else:
        df = spark.range(0, 400_000, 1, 1).select("id", F.xxhash64("id").alias("h"))
    target = 1_000_000
    if kind == "geometry":
        df = points_from_xy(df.withColumn("y", F.col("id") % 80 + 0.1), "id", "y")
        write_geoparquet(df, folder, file_bytes=target)
    else:
        write_parquet(df, folder, file_bytes=target)
    sizes = [f.stat().st_size for f in files(folder)]
    assert len(sizes) > 4
    assert sorted(sizes)[1] > 0.7 * target and max(sizes) < 1.3 * target
    assert scan_parquet(spark, folder).count() == df.count()


def test_size_of_an_empty_table(spark, folder):
    write_parquet(spark.range(0), folder, file_bytes=1000)
    assert scan_parquet(spark, folder).count() == 0
    with pytest.raises(ValueError, match="file_bytes"):
        write_parquet(spark.range(1), folder, file_bytes=0)


def test_modes(spark, folder):
    write_parquet(spark.range(10), folder)
    write_parquet(spark.range(10), folder)
    assert scan_parquet(spark, folder).count() == 20
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_parquet(spark.range(10), folder, mode="errorifexists")
    write_parquet(spark.range(3), folder, mode="overwrite")
    assert scan_parquet(spark, folder).count() == 3


def test_partition_columns_are_checked(spark, folder):
    with pytest.raises(ValueError, match="Cannot partition by nope"):
        write_parquet(spark.range(3), folder, ["id", "nope"])
    df = spark.range(9).withColumn("k", F.col("id") % 3)
    write_parquet(df, folder, "k")
    assert {key_of(f) for f in files(folder)} == {"k=0", "k=1", "k=2"}


def skewed(spark):
    """A third of the rows and more in one key, over many input partitions."""
    df = spark.range(0, 60_000, 1, 24).withColumn("pad", F.sha2(F.col("id").cast("string"), 512))
    key = F.when(F.col("id") % 2 == 0, "hot").otherwise((F.col("id") % 7).cast("string"))
    return df.withColumn("key", key)


@pytest.fixture
def small_tasks(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "256k")
    yield
    spark.conf.set(name, before)


def test_a_hot_partition_is_split_over_tasks(spark, folder, small_tasks):
    write_parquet(skewed(spark), folder, "key")
    hot = [f for f in files(folder) if key_of(f) == "key=hot"]
    assert len(hot) > 4
    assert scan_parquet(spark, folder).count() == 60_000


def test_a_hot_geoparquet_partition_is_split_over_tasks(spark, folder, small_tasks):
    from quadrille.sources.columns import points_from_xy

    df = points_from_xy(skewed(spark).withColumn("y", F.col("id") % 80), "id", "y")
    write_geoparquet(df, folder, "key")
    hot = [f for f in files(folder) if key_of(f) == "key=hot"]
    assert len(hot) > 4
    assert sum(pq.read_metadata(f).num_rows for f in files(folder)) == 60_000


def test_small_partitions_get_one_file_each(spark, folder):
    df = spark.range(0, 1000, 1, 20).withColumn("k", F.col("id") % 5)
    write_parquet(df, folder, "k")
    assert len(files(folder)) == 5


def test_clustering_narrows_the_files(spark, folder):
    df = spark.range(0, 4000, 1, 8).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") % 360 - 180.0).alias("x"),
        (F.col("id") % 80).cast("double").alias("y"),
    )
    from quadrille.sources.columns import points_from_xy

    clustered = cluster_by_cell(points_from_xy(df, "x", "y"), 6, partitions=8)
    write_parquet(clustered, folder)
    ranges, sizes = [], []
    for file in files(folder):
        meta = pq.read_metadata(file)
        sizes.append(meta.num_rows)
        at = meta.schema.to_arrow_schema().names.index("cell")
        # columns of the nested geometry come before the cell
        column = [
            meta.row_group(0).column(i)
            for i in range(meta.num_columns)
            if meta.row_group(0).column(i).path_in_schema == "cell"
        ][0]
        ranges.append((column.statistics.min, column.statistics.max))
        assert at >= 0
    ranges.sort()
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert sum(sizes) == 4000 and max(sizes) < 1000
    assert scan_parquet(spark, folder).select("id").distinct().count() == 4000


def test_clustering_divides_a_crowd_of_equal_rows(spark, folder):
    from quadrille.sources.columns import points_from_xy

    df = spark.range(0, 4000, 1, 16).selectExpr("7.0D x", "8.0D y")
    write_parquet(cluster_by_cell(points_from_xy(df, "x", "y"), 6, partitions=8), folder)
    sizes = [pq.read_metadata(f).num_rows for f in files(folder)]
    assert sum(sizes) == 4000 and len(sizes) >= 6 and max(sizes) <= 1000


# --- compaction -------------------------------------------------------------------


def test_compaction_keeps_rows_and_folder_names(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    df = spark.range(0, 600, 1, 6).selectExpr("id", "lpad(id % 3, 2, '0') AS month")
    for _ in range(3):
        write_parquet(df, source, "month", rows_per_file=20)
    assert len(files(source)) > 60
    compact_dataset(spark, source, target, target_rows=400)
    assert {key_of(f) for f in files(target)} == {"month=00", "month=01", "month=02"}
    per_folder = [pq.read_metadata(f).num_rows for f in files(target)]
    assert sorted(per_folder) == [200, 200, 200, 400, 400, 400]
    both = [
        sorted(map(tuple, scan_parquet(spark, p).collect())) for p in (source, target)
    ]
    assert both[0] == both[1]


def test_compaction_without_partitions(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    write_parquet(spark.range(0, 1000, 1, 50), source)
    compact_dataset(spark, source, target)
    assert len(files(source)) == 50 and len(files(target)) == 1
    assert scan_parquet(spark, target).count() == 1000


def test_compaction_of_geoparquet(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    for start in (0, 3):
        shapes = list(EXAMPLES.values())[start : start + 3]
        df = frame(spark, shapes).withColumn("k", F.lit("07")).repartition(3)
        write_geoparquet(df, source, "k")
    compact_dataset(spark, source, target)
    assert len(files(target)) == 1
    footer = geoparquet_footers(spark, target).first()
    assert footer["geometry_types"] == sorted(EXAMPLES)
    assert footer["bbox"] == [0.0, 0.0, 14.0, 24.0]
    before, after = (
        sorted(str(r["geometry"]) for r in read_geoparquet(spark, p).collect())
        for p in (source, target)
    )
    assert before == after


def test_large_files_stay_as_they_are(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    df = spark.range(0, 900, 1, 1).selectExpr("id", "CAST(id AS string) t", "id % 2 AS k")
    write_parquet(df, source, "k", rows_per_file=300)
    write_parquet(df.where("id < 90").repartition(5, "id"), source, "k", rows_per_file=5)
    large = {f.read_bytes() for f in files(source) if pq.read_metadata(f).num_rows > 100}
    compact_dataset(spark, source, target, target_rows=200)
    assert len(large) == 4
    assert large <= {f.read_bytes() for f in files(target)}
    sizes = sorted(pq.read_metadata(f).num_rows for f in files(target))
    assert sizes == [45, 45, 150, 150, 300, 300]
    assert sorted(scan_parquet(spark, target).collect()) == sorted(
        scan_parquet(spark, source).collect()
    )
    # nothing is left to merge, so all files but one are copied
    again = str(tmp_path / "c")
    compact_dataset(spark, target, again, target_rows=200)
    assert sorted(pq.read_metadata(f).num_rows for f in files(again)) == sizes
    with pytest.raises(FileExistsError):
        compact_dataset(spark, target, again)
    compact_dataset(spark, source, again, target_rows=200, mode="overwrite")
    assert sorted(pq.read_metadata(f).num_rows for f in files(again)) == sizes


def test_rows_are_not_shuffled_by_a_compaction(spark, tmp_path, monkeypatch):
    from quadrille.sinks import compact

    plans = []
    original = compact._rows_of

    def watched(*args):
        rows = original(*args)
        plans.append((rows._jdf.queryExecution().toString(), rows.rdd.getNumPartitions()))
        return rows

    monkeypatch.setattr(compact, "_rows_of", watched)
    source = str(tmp_path / "a")
    df = spark.range(0, 4000, 1, 40).selectExpr("id", "id % 10 AS k")
    write_parquet(df, source, "k", rows_per_file=10)
    compact_dataset(spark, source, str(tmp_path / "b"), target_rows=50)
    (plan, tasks) = plans[0]
    assert "MapInArrow" in plan and "Exchange" not in plan and tasks == 20
    assert sorted(pq.read_metadata(f).num_rows for f in files(tmp_path / "b")) == [50] * 80


def test_compaction_of_awkward_types(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    first = spark.sql(
        "SELECT 1 i, 1.25BD d, date'2024-01-02' day, timestamp'2024-01-02 03:04:05Z' ts,"
        " timestamp_ntz'2024-01-02 03:04:05' ntz, array(named_struct('a', 1), null) l,"
        " named_struct('x', 'é') s, X'0102' b, map('k', 1.5D) m, 'v' AS `dotted.name`,"
        " 'x/y=1 ' AS key"
    )
    second = spark.sql(
        "SELECT 2L i, array(named_struct('a', 1, 'c', true)) l, 3.0F f,"
        " named_struct('x', 'z', 'y', 7) s, CAST(NULL AS string) key"
    ).withColumn("i", F.col("i").cast("int"))
    for df in (first, first, second, second):
        write_parquet(df, source, "key")
    compact_dataset(spark, source, target)
    assert len(files(source)) == 4 and len(files(target)) == 2
    before, after = (
        scan_parquet(spark, p).select(sorted(f"`{c}`" for c in scan_parquet(spark, source).columns))
        for p in (source, target)
    )
    assert before.dtypes == after.dtypes
    assert sorted(map(str, before.collect())) == sorted(map(str, after.collect()))


# --- export -----------------------------------------------------------------------


@pytest.fixture
def features(spark):
    df = frame(spark, [*EXAMPLES.values(), None])
    return df.select(
        "id",
        (F.col("id") % 2).cast("int").alias("even"),
        F.lit(1.0).alias("shape_length"),
        "geometry",
    )


@pytest.mark.parametrize(
    ("geometry_format", "columns"),
    [
        ("GEOPARQUET", {"geometry"}),
        ("geoparquet", {"geometry"}),
        ("XY", {"x_lon", "y_lat"}),
        ("GEOJSON", {"geojson"}),
        ("json", {"geojson"}),
        ("CELL", {"cell_index"}),
    ],
)
@pytest.mark.parametrize("partition", [None, "even"])
def test_export_formats(spark, features, folder, geometry_format, columns, partition):
    export_features(
        features,
        folder,
        partition_columns=partition,
        geometry_format=geometry_format,
        zoom=9,
        managed=["shape_length"],
    )
    df = scan_parquet(spark, folder)
    assert set(df.columns) == {"id", "even"} | columns
    assert df.count() == 7
    folders = {key_of(f) for f in files(folder)}
    assert folders == ({"even=0", "even=1"} if partition else {"data"})
    has_footer = {b"geo" in pq.read_metadata(f).metadata for f in files(folder)}
    assert has_footer == {geometry_format.upper() == "GEOPARQUET"}


def test_export_options(spark, features, tmp_path):
    plain, chosen = str(tmp_path / "plain"), str(tmp_path / "chosen")
    export_features(features, plain, include_geometry=False, oid="id")
    assert scan_parquet(spark, plain).columns == ["even", "shape_length"]
    export_features(features, chosen, fields=["id"], where="id < 3")
    df = read_geoparquet(spark, chosen)
    assert df.columns == ["id", "geometry"] and df.count() == 3


def test_export_with_centroids(spark, features, tmp_path):
    for chosen in ("GEOPARQUET", "CELL", "GEOJSON", "XY"):
        path = str(tmp_path / chosen)
        export_features(
            features, path, geometry_format=chosen, include_centroids=True, zoom=6
        )
        df = scan_parquet(spark, path)
        assert {"x_lon", "y_lat"} <= set(df.columns)
        assert (df.where("id = 0").first()["x_lon"], df.columns.count("x_lon")) == (1.5, 1)
    path = str(tmp_path / "covered")
    header = {"version": "1.1.0", "primary_column": "geometry", "columns": {"geometry": {"encoding": "WKB", "geometry_types": []}}}
    export_features(features, path, header=header, covering="bbox", file_bytes=10_000_000)
    footer = geoparquet_footers(spark, path).first()
    assert footer["covering"] is not None and footer["bbox"] is None


def test_export_of_a_table_without_geometry(spark, folder):
    spark.range(5).write.mode("overwrite").saveAsTable("plain_rows")
    export_features("plain_rows", folder)
    assert scan_parquet(spark, folder).count() == 5


def test_export_format_names():
    assert check_export_format("json") == "GEOJSON"
    with pytest.raises(ValueError, match="not a format of its own"):
        check_export_format("wkb")
    for name in (None, "SHAPEFILE", ""):
        with pytest.raises(ValueError, match="geometry_format must be one of"):
            check_export_format(name)


def test_samples(spark):
    df = spark.range(50)
    assert sample_rows(df, None).count() == 50
    assert sample_rows(df, 7).count() == 7
    assert sample_rows(df, 0).count() == 0
    top = sample_rows(df, 3, F.col("id").desc()).collect()
    assert [r["id"] for r in top] == [49, 48, 47]


def test_large_samples_are_cut_by_many_tasks(spark):
    df = spark.range(0, 20_000_000, 1, 16).selectExpr("id", "id % 7 AS k")
    taken = sample_rows(df, 10_000_003)
    plan = taken._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and "Exchange" not in plan
    row = taken.agg(F.count("*").alias("n"), F.max("id").alias("last")).first()
    assert (row["n"], row["last"]) == (10_000_003, 10_000_002)
    by_task = taken.groupBy(F.spark_partition_id()).count().collect()
    assert len(by_task) == 9 and max(r["count"] for r in by_task) == 1_250_000
    assert sample_rows(df, 30_000_000).count() == 20_000_000


def test_large_ordered_and_shuffled_samples(spark):
    df = spark.range(0, 600_000, 1, 8).select("id", F.xxhash64("id").alias("h"))
    least = sample_rows(df, 250_000, F.col("h")).collect()
    expected = [r["h"] for r in df.orderBy("h").limit(250_000).collect()]
    assert sorted(r["h"] for r in least) == expected
    shuffled = df.groupBy("id", "h").agg(F.count("*").alias("n"))
    assert sample_rows(shuffled, 123_457).distinct().count() == 123_457
    assert sample_rows(df.withColumn("m", F.create_map("id", "h")), 100_001).count() == 100_001
