"""Imports: each geometry source, its errors, types, lengths, partitions and rejects."""

import decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from shapes import (
    feature_columns,
    geo_header,
    line_at,
    plain,
    point_at,
    polygon_at,
    wkb_point,
    write_file,
)

from quadrille import create_schema, export_features, import_features
from quadrille.operators.schema import check_import_format
from quadrille.sinks.compact import compact_dataset
from quadrille.sources.schema_csv import load_schema_csv


def coordinates(tmp_path, x="longitude", y="latitude", count=50):
    ids = list(range(count))
    columns = {
        "id": ids,
        "name": [f"Feature_{i}" for i in ids],
        x: [0.1 * i - 122.0 for i in ids],
        y: [0.1 * i + 47.0 for i in ids],
        "value": [10.5 * i for i in ids],
    }
    write_file(tmp_path / "xy" / "part-0.parquet", columns)
    return str(tmp_path / "xy")


# --- GeoParquet -------------------------------------------------------------------


@pytest.mark.parametrize(
    ("kind", "encode", "count", "feature_type"),
    [
        ("Point", point_at, 50, "POINT"),
        ("LineString", line_at, 30, "POLYLINE"),
        ("Polygon", polygon_at, 40, "POLYGON"),
    ],
)
def test_geoparquet(spark, tmp_path, kind, encode, count, feature_type):
    path = tmp_path / "g" / "a.parquet"
    write_file(path, feature_columns(count, encode), geo_header([kind]))
    loaded = import_features(spark, str(tmp_path / "g"))
    assert (loaded.geometry_type, loaded.srid) == (feature_type, 4326)
    assert loaded.features.columns == ["id", "name", "value", "geometry"]
    rows = loaded.features.orderBy("id").collect()
    assert len(rows) == count and loaded.rejected.isEmpty()
    assert {r["geometry"]["type"] for r in rows} == {kind}
    assert plain(rows[3]["geometry"])[1][0][0][0] == (0.1 * 3, 0.1 * 3)


def test_other_reference_system_wins_over_the_argument(spark, tmp_path):
    path = tmp_path / "g" / "a.parquet"
    write_file(path, feature_columns(25, point_at), geo_header(crs="epsg:3857"))
    loaded = import_features(spark, str(path), srid=4326)
    assert loaded.srid == 3857
    assert loaded.features.schema["geometry"].metadata["srid"] == 3857


def test_geometry_type_without_a_listed_kind_comes_from_the_rows(spark, tmp_path):
    path = tmp_path / "g" / "a.parquet"
    write_file(path, feature_columns(5, line_at), geo_header([]))
    assert import_features(spark, str(path)).geometry_type == "POLYLINE"


def test_nested_columns_become_text(spark, tmp_path):
    columns = feature_columns(3, point_at)
    columns["tags"] = [["a", "b"], [], None]
    columns["metadata"] = [{"key": "v"}, {"key": None}, None]
    write_file(tmp_path / "g" / "a.parquet", columns, geo_header())
    features = import_features(spark, str(tmp_path / "g")).features
    assert dict(features.dtypes)["tags"] == dict(features.dtypes)["metadata"] == "string"
    rows = features.orderBy("id").collect()
    assert [r["tags"] for r in rows] == ['["a","b"]', "[]", None]
    assert [r["metadata"] for r in rows] == ['{"key":"v"}', '{"key":null}', None]
    assert features.schema["metadata"].metadata["length"] == 12


def test_text_lengths(spark, tmp_path):
    columns = feature_columns(3, point_at)
    columns["long_text"] = ["x" * 1000, "y" * 500, "ü" * 750]
    columns["empty"] = ["", None, ""]
    write_file(tmp_path / "g" / "a.parquet", columns, geo_header())
    schema = import_features(spark, str(tmp_path / "g")).features.schema
    assert schema["long_text"].metadata == {"alias": "long_text", "length": 1000}
    assert schema["empty"].metadata["length"] == 512
    assert "length" not in schema["id"].metadata


# --- partitions -------------------------------------------------------------------


@pytest.fixture
def partitioned(tmp_path):
    root = tmp_path / "p"
    for n, (year, month) in enumerate((y, m) for y in (2023, 2024) for m in (1, 2)):
        columns = feature_columns(10, point_at, n * 10)
        columns = {**columns, "year": [year] * 10, "month": [month] * 10}
        path = root / f"year={year}" / f"month={month}" / "part-0.parquet"
        write_file(path, columns, geo_header())
    return str(root)


@pytest.mark.filterwarnings("ignore:Partition folders")
@pytest.mark.parametrize(
    ("partitions", "count"),
    [(None, 40), ("year=2024", 20), ("year=2023/month=1", 10), ("month=2", 20)],
)
def test_partitions(spark, partitioned, partitions, count):
    loaded = import_features(spark, partitioned, partitions=partitions)
    assert loaded.features.count() == count
    assert {"year", "month"} <= set(loaded.features.columns)


@pytest.mark.filterwarnings("ignore:Partition folders")
def test_unknown_partition(spark, partitioned):
    with pytest.raises(ValueError, match="No partition matches"):
        import_features(spark, partitioned, partitions="year=1999")


# --- coordinates ------------------------------------------------------------------


@pytest.mark.parametrize("names", [("longitude", "latitude"), ("x_coord", "y_coord")])
def test_coordinates(spark, tmp_path, names):
    path = coordinates(tmp_path, *names)
    loaded = import_features(spark, path, "coordinates", names, srid="4326")
    assert (loaded.geometry_type, loaded.srid) == ("POINT", 4326)
    assert set(names) <= set(loaded.features.columns)
    rows = loaded.features.orderBy("id").collect()
    assert len(rows) == 50
    assert plain(rows[10]["geometry"])[1][0][0] == [(0.1 * 10 - 122.0, 0.1 * 10 + 47.0)]


def test_decimal_and_integer_coordinates(spark, tmp_path):
    columns = {
        "x": pa.array([decimal.Decimal("1.25")], pa.decimal128(8, 2)),
        "y": pa.array([7], pa.int8()),
    }
    write_file(tmp_path / "d" / "a.parquet", columns)
    loaded = import_features(spark, str(tmp_path / "d"), "COORDINATES", ["x", "y"])
    assert plain(loaded.features.first()["geometry"])[1] == [[[(1.25, 7.0)]]]


def test_coordinate_errors(spark, tmp_path):
    path = coordinates(tmp_path)
    with pytest.raises(ValueError, match="must provide an iterable"):
        import_features(spark, path, "COORDINATES", "longitude")
    with pytest.raises(ValueError, match="must provide an iterable"):
        import_features(spark, path, "COORDINATES", ["longitude"])
    with pytest.raises(
        ValueError, match="do not appear to be in the input parquet columns"
    ):
        import_features(spark, path, "COORDINATES", ["lon", "lat"])
    with pytest.raises(ValueError, match="does not appear to be a numeric type"):
        import_features(spark, path, "COORDINATES", ["name", "latitude"])


# --- cells and WKB ----------------------------------------------------------------


def cells(tmp_path, name="cell"):
    keys = ["0231", "1203", "3333", "0000", "2120"] * 4
    columns = {"id": list(range(20)), name: keys}
    write_file(tmp_path / "c" / "a.parquet", columns)
    return str(tmp_path / "c")


@pytest.mark.parametrize("name", ["cell", "h3_cell"])
def test_cells(spark, tmp_path, name):
    loaded = import_features(spark, cells(tmp_path, name), "CELL", name)
    assert loaded.geometry_type == "POLYGON"
    rows = loaded.features.collect()
    assert len(rows) == 20 and {r["geometry"]["type"] for r in rows} == {"Polygon"}
    assert name in loaded.features.columns


def test_cell_errors(spark, tmp_path):
    path = cells(tmp_path)
    with pytest.raises(ValueError, match="you must provide the geometry_column param"):
        import_features(spark, path, "CELL")
    with pytest.raises(
        ValueError, match="does not appear to be in the input parquet columns"
    ):
        import_features(spark, path, "CELL", "nope")


def test_wkb(spark, tmp_path):
    write_file(tmp_path / "w" / "a.parquet", feature_columns(20, polygon_at))
    path = str(tmp_path / "w")
    loaded = import_features(spark, path, "WKB", "geometry", srid=3857)
    assert (loaded.geometry_type, loaded.srid) == ("POLYGON", 3857)
    assert loaded.features.count() == 20
    with pytest.raises(ValueError, match="does not appear to be in the input"):
        import_features(spark, path, "WKB", "nope")


def test_format_errors(spark, tmp_path):
    path = coordinates(tmp_path)
    with pytest.raises(ValueError, match="geometry_format must be one of"):
        import_features(spark, path, "SHAPEFILE")
    with pytest.raises(ValueError, match="does not appear to be formatted as GeoParquet"):
        import_features(spark, path)
    assert check_import_format("cell") == "CELL"


def test_missing_primary_column(spark, tmp_path):
    header = geo_header(column="nonexistent_geom")
    write_file(tmp_path / "x" / "a.parquet", {"id": [1], "name": ["a"]}, header)
    with pytest.raises(ValueError, match="does not exist in the dataset schema"):
        import_features(spark, str(tmp_path / "x"))


def test_warning_when_geoparquet_is_read_otherwise(spark, tmp_path):
    columns = {**feature_columns(5, point_at), "x": [1.0] * 5, "y": [2.0] * 5}
    columns["cell"] = ["0"] * 5
    write_file(tmp_path / "g" / "a.parquet", columns, geo_header())
    path = str(tmp_path / "g")
    for geometry_format, column in (("COORDINATES", ["x", "y"]), ("CELL", "cell")):
        with pytest.warns(UserWarning, match="as GeoParquet does"):
            loaded = import_features(spark, path, geometry_format, column)
        assert loaded.features.count() == 5


def test_warning_when_any_file_has_a_footer(spark, tmp_path):
    columns = {**feature_columns(5, point_at), "x": [1.0] * 5, "y": [2.0] * 5}
    for name in "abcdefgh":
        write_file(tmp_path / "g" / f"{name}.parquet", columns)
    write_file(tmp_path / "g" / "z.parquet", columns, geo_header())
    with pytest.warns(UserWarning, match="as GeoParquet does"):
        import_features(spark, str(tmp_path / "g"), "COORDINATES", ["x", "y"])


# --- rejects, samples, filters ----------------------------------------------------


def test_rejects(spark, tmp_path):
    columns = feature_columns(6, point_at)
    records = [
        wkb_point(1, 2),
        b"rubbish",
        wkb_point(0, 91),
        None,
        wkb_point(float("inf"), 0),
        wkb_point(200, 10),
    ]
    columns["geometry"] = pa.array(records, pa.binary())
    write_file(tmp_path / "g" / "a.parquet", columns, geo_header())
    loaded = import_features(spark, str(tmp_path / "g"))
    assert sorted(r["id"] for r in loaded.features.collect()) == [0, 3, 5]
    assert {r["id"]: r["reject_reason"] for r in loaded.rejected.collect()} == {
        1: "geometry cannot be decoded",
        2: "latitude out of range",
        4: "coordinate is not a finite number",
    }


def test_bad_cells_are_rejected(spark, tmp_path):
    columns = {"id": [1, 2, 3], "cell": ["012", "xyz", None]}
    write_file(tmp_path / "c" / "a.parquet", columns)
    loaded = import_features(spark, str(tmp_path / "c"), "CELL", "cell")
    assert sorted(r["id"] for r in loaded.features.collect()) == [1, 3]
    assert [r["reject_reason"] for r in loaded.rejected.collect()] == ["not a cell id"]


@pytest.mark.parametrize(("sample", "count"), [(None, 50), (7, 7), (0, 0), (99, 50)])
def test_samples(spark, tmp_path, sample, count):
    path = coordinates(tmp_path)
    names = ["longitude", "latitude"]
    loaded = import_features(spark, path, "COORDINATES", names, sample_count=sample)
    assert loaded.features.count() == count


def test_filter_reaches_the_scan(spark, tmp_path, capsys):
    write_file(tmp_path / "g" / "a.parquet", feature_columns(50, point_at), geo_header())
    loaded = import_features(spark, str(tmp_path / "g"), where="value > 300")
    assert loaded.features.count() == 21
    loaded.features.where("id > 40").explain()
    plan = capsys.readouterr().out
    assert "GreaterThan(value,300.0)" in plan and "GreaterThan(id,40)" in plan
    assert plan.count("ArrowEvalPython") == 1


# --- names, types, schema files ---------------------------------------------------


@pytest.fixture
def odd_names(tmp_path):
    columns = {
        "1st": ["a", "bb"],
        "delta_x": [1, 2],
        "plain": ["ccc", None],
        "flag": [True, None],
        "dec": pa.array([decimal.Decimal("1.5"), None], pa.decimal128(5, 2)),
        "blob": pa.array([b"1", b"2"], pa.binary()),
        "x": [1.0, 2.0],
        "y": [3.0, 4.0],
    }
    write_file(tmp_path / "odd" / "a.parquet", columns)
    return str(tmp_path / "odd")


def test_names_and_types(spark, odd_names):
    features = import_features(spark, odd_names, "COORDINATES", ["x", "y"]).features
    assert features.dtypes[:-1] == [
        ("c1st", "string"),
        ("cdelta_x", "bigint"),
        ("plain", "string"),
        ("flag", "string"),
        ("dec", "double"),
        ("x", "double"),
        ("y", "double"),
    ]
    schema = features.schema
    assert schema["c1st"].metadata == {"alias": "1st", "length": 2}
    assert schema["flag"].metadata["length"] == 4
    assert [r["flag"] for r in features.collect()] == ["true", None]


def test_any_column_name(spark, tmp_path, folder):
    """Dots, blanks and backticks, from import to export and back."""
    columns = {
        "a.b": ["x", "y"],
        "ti`ck": [[1], [2, 3]],
        "the x": [1.0, 2.0],
        "the.y": [3.0, 4.0],
        "0.5": [1, 2],
    }
    write_file(tmp_path / "n" / "a.parquet", columns)
    path = str(tmp_path / "n")
    loaded = import_features(spark, path, "COORDINATES", ["the x", "the.y"])
    names = ["a.b", "ti`ck", "the x", "the.y", "c0.5", "geometry"]
    assert loaded.features.columns == names
    assert loaded.features.count() == 2 and loaded.rejected.isEmpty()
    create_schema(spark, path, str(tmp_path / "schema"))
    for geometry_format in ("GEOPARQUET", "XY", "GEOJSON", "CELL"):
        out = f"{folder}-{geometry_format}"
        export_features(
            loaded.features, out, "a.b", geometry_format=geometry_format, fields=names[:5]
        )
        assert set(names[:5]) <= set(spark.read.parquet(out).columns)
    again = import_features(spark, f"{folder}-GEOPARQUET", partitions="a.b=x")
    assert again.features.count() == 1
    assert set(again.features.columns) == set(names)


def test_schema_file_round_trip(spark, odd_names, tmp_path):
    path = create_schema(spark, odd_names, str(tmp_path / "schema"))
    rows = {r["field_name"]: r for r in load_schema_csv(spark, path).collect()}
    assert rows["c1st"]["field_alias"] == "1st" and rows["c1st"]["field_length"] == 2
    assert rows["plain"]["field_length"] == 3 and rows["blob"]["field_type"] == "TEXT"
    assert rows["cdelta_x"]["field_type"] == "LONG"
    assert rows["cdelta_x"]["field_length"] is None
    names = ["x", "y"]
    loaded = import_features(spark, odd_names, "COORDINATES", names, schema_file=path)
    assert loaded.features.schema["c1st"].metadata == {"alias": "1st", "length": 2}


def test_schema_file_by_hand(spark, odd_names, tmp_path):
    lines = [
        "field_name,field_type,field_alias,field_length,remark",
        'plain,String,"Plain, with ""quotes""",77.0,x',
        "1st,str,First,,",
        "unused,TEXT,Unused,5,",
    ]
    (tmp_path / "schema").mkdir()
    (tmp_path / "schema" / "fields.csv").write_text("\n".join(lines))
    table = load_schema_csv(spark, str(tmp_path / "schema"))
    assert {r["field_type"] for r in table.collect()} == {"TEXT"}
    with pytest.warns(UserWarning, match="without a length in the schema file.*flag"):
        loaded = import_features(
            spark, odd_names, "COORDINATES", ["x", "y"], tmp_path / "schema"
        )
    schema = loaded.features.schema
    assert schema["plain"].metadata == {"alias": 'Plain, with "quotes"', "length": 77}
    assert schema["c1st"].metadata == {"alias": "First", "length": 512}
    assert schema["flag"].metadata == {"alias": "flag", "length": 512}


def test_schema_file_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="output path"):
        create_schema(spark, "x")
    with pytest.raises(ValueError, match="input dataset"):
        create_schema(spark, None, str(tmp_path / "s"))
    with pytest.raises(FileNotFoundError):
        create_schema(spark, str(tmp_path / "nowhere"), str(tmp_path / "s"))
    (tmp_path / "bad.csv").write_text("field_name\na\n")
    with pytest.raises(ValueError, match="lacks the columns: field_type"):
        load_schema_csv(spark, str(tmp_path / "bad.csv"))


def test_save_as_table(spark, tmp_path):
    path = coordinates(tmp_path)
    loaded = import_features(spark, path, "COORDINATES", ["longitude", "latitude"])
    counts = loaded.save("imported", mode="overwrite", cluster_zoom=8)
    assert counts == {"added": 50, "failed": loaded.rejected.count()}
    saved = spark.table("imported")
    assert saved.count() == 50 and "cell" in saved.columns
    assert saved.schema["name"].metadata == {"alias": "name", "length": 10}


@pytest.fixture
def mixed(tmp_path):
    """100 rows, every fifth off the map."""
    columns = {
        "id": list(range(100)),
        "Odd Name!": [f"n{i}" for i in range(100)],
        "x": [float(i) for i in range(100)],
        "y": [95.0 if i % 5 == 0 else i / 2 for i in range(100)],
        "tags": [["a"] * (i % 3) for i in range(100)],
    }
    write_file(tmp_path / "mixed" / "a.parquet", columns)
    return str(tmp_path / "mixed")


@pytest.mark.parametrize("cluster_zoom", [None, 6])
def test_both_kinds_of_rows_are_counted_while_they_are_saved(spark, mixed, cluster_zoom):
    loaded = import_features(spark, mixed, "COORDINATES", ["x", "y"])
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("saving", "saving")
    counts = loaded.save("imported_mixed", mode="overwrite", cluster_zoom=cluster_zoom)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts == {"added": 80, "failed": 20}
    if cluster_zoom is None:
        assert len(jobs.getJobIdsForGroup("saving")) == 1
    saved = spark.table("imported_mixed")
    assert saved.count() == 80 and "reject_reason" not in saved.columns
    assert saved.drop("cell").dtypes == loaded.features.dtypes
    assert saved.schema["tags"].metadata == loaded.features.schema["tags"].metadata


def test_both_kinds_of_rows_are_stored_by_one_job(spark, mixed, folder):
    from quadrille.plans.imports import read_stored

    loaded = import_features(spark, mixed, "COORDINATES", ["x", "y"])
    plan = loaded.flagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert loaded.store(folder) == {"added": 80, "failed": 20}
    features, rejected = read_stored(spark, folder)
    assert features.exceptAll(loaded.features).isEmpty() and features.count() == 80
    assert {f.name: f.metadata for f in features.schema} == {
        f.name: f.metadata for f in loaded.features.schema
    }
    reasons = {r["reject_reason"] for r in rejected.collect()}
    assert reasons == {"latitude out of range"} and rejected.count() == 20
    ids = sorted(r["id"] for r in rejected.collect())
    assert ids == sorted(r["id"] for r in loaded.rejected.collect())
    # each reads its own folder only
    assert "PartitionFilters: [isnotnull(status" in features._jdf.queryExecution().toString()
    with pytest.raises(Exception, match="already exists"):
        loaded.store(folder)
    assert loaded.store(folder, mode="append") == {"added": 80, "failed": 20}


def test_a_sample_is_counted_too(spark, mixed):
    loaded = import_features(spark, mixed, "COORDINATES", ["x", "y"], sample_count=7)
    assert loaded.save("imported_sample", mode="overwrite") == {"added": 7, "failed": 20}


def test_alias_and_length_survive_export_and_compaction(spark, odd_names, folder):
    names = ["x", "y"]
    loaded = import_features(spark, odd_names, "COORDINATES", names)
    export_features(loaded.features, folder, "cdelta_x")
    compact_dataset(spark, folder, f"{folder}-compact")
    for path in (folder, f"{folder}-compact"):
        again = import_features(spark, path, profile_lengths=False).features
        for name in ("c1st", "plain", "flag"):
            expected = loaded.features.schema[name].metadata
            assert again.schema[name].metadata == expected
        assert sorted(again.drop("geometry").columns) == sorted(
            loaded.features.drop("geometry").columns
        )
        assert again.count() == 2


def test_export_then_import(spark, tmp_path):
    path = coordinates(tmp_path)
    loaded = import_features(spark, path, "COORDINATES", ["longitude", "latitude"])
    out = str(tmp_path / "out")
    export_features(loaded.features, out, geometry_format="GEOPARQUET")
    again = import_features(spark, out)
    assert again.features.drop("geometry").exceptAll(
        loaded.features.drop("geometry")
    ).isEmpty()
    assert again.features.where(F.col("geometry").isNull()).isEmpty()
