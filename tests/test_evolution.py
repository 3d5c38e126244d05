"""Datasets whose files differ, and places off the grid."""

import json
import os
import subprocess
import sys
import textwrap
import warnings
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quadrille.functions.cells import cell_of_point
from quadrille.functions.wkb import to_wkb
from quadrille.functions.geometry import make_point, make_polygon
from quadrille.operators.rows import cell_cover
from quadrille.plans.imports import import_features
from quadrille.sinks.compact import compact_dataset
from quadrille.sources.columns import srid_of
from quadrille.sources.files import list_partitions, partition_keys
from quadrille.sources.geoparquet import describe_geoparquet, read_geoparquet
from quadrille.sources.parquet import scan_parquet, scan_partition
from quadrille.sources.schema_csv import find_schema_file

ROOT = Path(__file__).resolve().parent.parent


def put(path, **columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path)


def test_columns_of_all_files(spark, tmp_path):
    root = tmp_path / "data"
    put(root / "k=1" / "a.parquet", id=[1, 2])
    put(root / "k=1" / "b.parquet", id=[3], extra=["x"])
    put(root / "k=2" / "c.parquet", more=[1.5], id=[4])
    expected = {(1, None, None, 1), (2, None, None, 1), (3, "x", None, 1), (4, None, 1.5, 2)}
    target = compact_dataset(spark, str(root), str(tmp_path / "compacted"))
    for path in (str(root), target):
        rows = scan_parquet(spark, path).select("id", "extra", "more", "k").collect()
        assert {tuple(r) for r in rows} == expected


def test_compaction_refuses_what_it_would_lose(spark, tmp_path):
    root = tmp_path / "data"
    put(root / "a.parquet", id=[1])
    put(root / "b.parquet", id=[2], at=pa.array([5], pa.time64("us")))
    with pytest.raises(ValueError, match="at"):
        compact_dataset(spark, str(root), str(tmp_path / "compacted"))
    with pytest.warns(UserWarning, match="left out: at"):
        assert scan_parquet(spark, str(root)).columns == ["id"]


def test_partition_values_of_any_length(spark, tmp_path):
    root, long = tmp_path / "data", "9" * 25
    put(root / f"code={long}" / "a.parquet", id=[1])
    put(root / "code=7" / "b.parquet", id=[2])
    listed = list_partitions(spark, str(root)).collect()
    assert [int(r["code"]) for r in listed] == [7, int(long)]
    assert scan_partition(spark, str(root), f"code={long}").count() == 1


def test_partitions_of_mixed_depth(spark, tmp_path):
    root = tmp_path / "data"
    put(root / "a=1" / "x.parquet", id=[1])
    put(root / "a=2" / "b=3" / "y.parquet", id=[2])
    assert partition_keys(spark, str(root)) == ["a", "b"]
    rows = list_partitions(spark, str(root), typed=False).collect()
    assert [(r["level"], r["partition"]) for r in rows] == [
        (1, "a=1"),
        (1, "a=2"),
        (2, "a=2/b=3"),
    ]
    put(root / "c=1" / "z.parquet", id=[3])
    with pytest.raises(ValueError, match="nested"):
        partition_keys(spark, str(root))


def test_longitudes_go_round(spark):
    rows = [(180.5, 10.0), (-179.5, 10.0), (500.0, 1.0), (140.0, 1.0), (0.0, 91.0)]
    rows += [(180.0, 0.0), (-180.0, 0.0), (float("nan"), 0.0), (float("inf"), 0.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    cells = [r[0] for r in df.select(cell_of_point(F.col("x"), F.col("y"), 6)).collect()]
    assert cells[0] == cells[1] and cells[2] == cells[3] and cells[5] == cells[6]
    assert cells[4] is cells[7] is cells[8] is None and None not in cells[:4]


@pytest.fixture
def two_geometries(spark, tmp_path):
    """Longitude and latitude in the primary column, metres in the other."""
    df = spark.range(3).select(
        "id",
        to_wkb(make_point(F.col("id") * 1.0, F.lit(2.0))).alias("geometry"),
        to_wkb(make_point(F.col("id") * 1000.0, F.lit(5.0))).alias("geometry2"),
    )
    table = df.toArrow()

    def facts(code):
        crs = {"id": {"authority": "EPSG", "code": code}}
        return {"encoding": "WKB", "geometry_types": ["Point"], "crs": crs}

    header = {
        "version": "1.1.0",
        "primary_column": "geometry",
        "columns": {"geometry": facts(4326), "geometry2": facts(3857)},
    }
    path = tmp_path / "two.parquet"
    pq.write_table(table.replace_schema_metadata({"geo": json.dumps(header)}), path)
    return str(path)


def test_reference_system_of_the_column_that_is_read(spark, two_geometries):
    assert srid_of(read_geoparquet(spark, two_geometries)) == 4326
    other = read_geoparquet(spark, two_geometries, "geometry2")
    assert srid_of(other) == 3857 and other.columns == ["id", "geometry"]
    scan = other.select("id", "geometry")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<id:bigint,geometry2:binary>" in scan
    dataset = describe_geoparquet(spark, two_geometries)
    assert dataset.geometry_columns == ("geometry", "geometry2")


def test_import_of_a_chosen_geometry(spark, two_geometries):
    with warnings.catch_warnings():
        warnings.simplefilter("error")  # geometry columns are no lost attributes
        loaded = import_features(spark, two_geometries, geometry_column="geometry2")
    assert loaded.srid == 3857
    assert {r["id"] for r in loaded.features.collect()} == {0, 1, 2}


def test_binary_attributes_are_named(spark, tmp_path):
    put(tmp_path / "a.parquet", x=[1.0], y=[2.0], raw=[b"1"])
    with pytest.warns(UserWarning, match="left out: raw"):
        import_features(spark, str(tmp_path), "COORDINATES", ("x", "y"))


def test_malformed_footer(spark, tmp_path):
    table = pa.table({"x": [1.0], "y": [2.0]}).replace_schema_metadata({"geo": "{no json"})
    pq.write_table(table, tmp_path / "a.parquet")
    with pytest.warns(UserWarning, match="not a JSON object"):
        loaded = import_features(spark, str(tmp_path), "COORDINATES", ("x", "y"))
    assert loaded.features.count() == 1


def test_entry_points_ship_the_package(tmp_path):
    """Each is the first call of an application whose workers cannot import it."""
    put(tmp_path / "data" / "a.parquet", id=[1])
    script = textwrap.dedent(
        f"""
        import sys
        sys.path.insert(0, {str(ROOT)!r})
        from pyspark.sql import SparkSession, functions as F
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
            .config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate())
        from quadrille.functions.wkb import from_wkb
        from quadrille.sinks.compact import compact_dataset
        if sys.argv[1] == "compact":
            compact_dataset(spark, {str(tmp_path / "data")!r}, {str(tmp_path / "out")!r})
        else:
            spark.range(1).select(from_wkb(F.lit(b"1"))).collect()
        """
    )
    (tmp_path / "script.py").write_text(script)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    for name in ("compact", "wkb"):
        done = subprocess.run(
            [sys.executable, "script.py", name],
            cwd=tmp_path,
            env=env,
            capture_output=True,
            text=True,
            timeout=120,
        )
        assert done.returncode == 0, done.stderr[-2000:]


def test_a_large_feature_is_divided(spark):
    """Its cells come from many tasks, although it is one row of one task."""
    ring = [(-170.0, -80.0), (170.0, -80.0), (170.0, 80.0), (-170.0, 80.0)]
    corners = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ring])
    df = spark.range(1).select("id", make_polygon(F.array(corners)).alias("geometry"))
    cover = cell_cover(df, 10)
    counts = cover.select("cell", F.spark_partition_id().alias("task"))
    by_task = {r["task"]: r["count"] for r in counts.groupBy("task").count().collect()}
    assert sum(by_task.values()) > 500_000
    assert max(by_task.values()) < 0.3 * sum(by_task.values())
    assert cover.select("cell").distinct().count() == sum(by_task.values())


def test_schema_beside_the_dataset(spark, tmp_path):
    put(tmp_path / "sites" / "a.parquet", x=[1.0], y=[2.0], name=["n"])
    path = str(tmp_path / "sites")
    assert find_schema_file(spark, path) is None
    (tmp_path / "schema").mkdir()
    (tmp_path / "schema" / "part-0.csv").write_text(
        "field_name,field_type,field_alias,field_length\nname,TEXT,Site name,77\n"
    )
    loaded = import_features(
        spark, path, "COORDINATES", ("x", "y"), discover_schema=True
    )
    assert loaded.features.schema["name"].metadata == {"alias": "Site name", "length": 77}
