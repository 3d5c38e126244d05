"""Part files, Hive partitions and plain scans."""

import datetime
import decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from shapes import write_file

from quadrille.sinks.parquet import write_parquet
from quadrille.sources.files import (
    list_part_files,
    list_partitions,
    partition_keys,
    read_footers,
)
from quadrille.sources.parquet import parse_selector, scan_parquet, scan_partition
from quadrille.storage import open_filesystem, qualified


@pytest.fixture
def months(tmp_path):
    """``year=*/month=*`` with the keys also in the files, ten rows each."""
    root = tmp_path / "months"
    for year in (2023, 2024):
        for month in ("01", "02"):
            ids = list(range(10))
            columns = {
                "id": ids,
                "year": [year] * 10,
                "month": [int(month)] * 10,
                "value": [i * 1.5 for i in ids],
            }
            write_file(root / f"year={year}" / f"month={month}" / "p.parquet", columns)
    return str(root)


# --- part files -------------------------------------------------------------------


def test_part_files(spark, months):
    assert list_part_files(spark, months).count() == 4
    assert list_part_files(spark, months, ["year=2024"]).count() == 2
    assert list_part_files(spark, months, ["year=2024", "month=01"]).count() == 1
    one = list_part_files(spark, months, ["year=2024", "month=01"]).first()["path"]
    assert list_part_files(spark, one).count() == 1


def test_part_file_errors(spark, months, tmp_path):
    with pytest.raises(ValueError, match="Cannot locate the input path"):
        list_part_files(spark, str(tmp_path / "nowhere"))
    with pytest.raises(ValueError, match="parquet_partitions must be a list"):
        list_part_files(spark, months, "year=2024")
    with pytest.raises(ValueError, match="No Parquet file lies below"):
        list_part_files(spark, months, ["year=1999"])
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError, match="No Parquet file lies below"):
        list_part_files(spark, str(tmp_path / "empty"))
    one = f"{months}/year=2023/month=01/p.parquet"
    with pytest.raises(ValueError, match="cannot specify a parquet partition"):
        list_part_files(spark, one, ["year=2023"])


def test_footers_are_read_without_the_data(spark, months):
    rows = read_footers(list_part_files(spark, months)).collect()
    assert sorted(r["num_rows"] for r in rows) == [10] * 4
    assert all(r["geo"] is None for r in rows)


def test_qualified_paths(spark, tmp_path):
    assert qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert qualified(spark, "s3a://bucket/x") == "s3a://bucket/x"
    assert qualified(spark, "file:///tmp/x") == "file:///tmp/x"


def test_paths_inside_a_filesystem():
    assert open_filesystem("file:/tmp/a b/x=%20.parquet")[1] == "/tmp/a b/x=%20.parquet"
    assert open_filesystem("file:///tmp/x")[1] == "/tmp/x"
    assert open_filesystem("/tmp/x")[1] == "/tmp/x"


# --- partitions -------------------------------------------------------------------


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_partition_list(spark, months, prefix):
    rows = list_partitions(spark, prefix + months).orderBy("partition").collect()
    assert [(r["level"], r["partition"], r["year"], r["month"]) for r in rows] == [
        (1, "year=2023", 2023, None),
        (2, "year=2023/month=01", 2023, 1),
        (2, "year=2023/month=02", 2023, 2),
        (1, "year=2024", 2024, None),
        (2, "year=2024/month=01", 2024, 1),
        (2, "year=2024/month=02", 2024, 2),
    ]
    leaves = list_partitions(spark, months, all_levels=False, typed=False)
    assert {(r["year"], r["month"]) for r in leaves.collect()} == {
        (y, m) for y in ("2023", "2024") for m in ("01", "02")
    }
    assert partition_keys(spark, months) == ["year", "month"]


def test_no_partitions(spark, folder):
    write_parquet(spark.range(5), folder)
    assert list_partitions(spark, folder).count() == 0
    assert partition_keys(spark, folder) == []
    with pytest.raises(ValueError, match="has no partitions"):
        scan_partition(spark, folder, "year=2023")


def test_folders_above_the_dataset_are_not_partitions(spark, months):
    assert partition_keys(spark, f"{months}/year=2023") == ["month"]
    rows = list_partitions(spark, f"{months}/year=2023").collect()
    assert {r["partition"] for r in rows} == {"month=01", "month=02"}


@pytest.mark.filterwarnings("ignore:Partition folders")
def test_a_folder_of_the_same_key_above_the_dataset(spark, tmp_path):
    root = tmp_path / "year=1999" / "d"
    for year in (2023, 2024):
        write_file(root / f"year={year}" / "p.parquet", {"id": [year]})
    assert scan_partition(spark, str(root), "year=2023").first()["id"] == 2023
    with pytest.raises(ValueError, match="list_partitions gives all"):
        scan_partition(spark, str(root), "year=1999")


VALUES = ["a b", "x/y", "k=v", "50%", "é+ü", "q?*:", None, "07", "-1"]


def test_partition_values_with_special_characters(spark, folder):
    rows = [(i, v) for i, v in enumerate(VALUES)]
    write_parquet(spark.createDataFrame(rows, "id int, name string"), folder, "name")
    listed = {r["name"] for r in list_partitions(spark, folder).collect()}
    assert listed == set(VALUES)
    assert {(r["id"], r["name"]) for r in scan_parquet(spark, folder).collect()} == {
        *rows
    }
    found = scan_partition(spark, folder, "name=__HIVE_DEFAULT_PARTITION__").collect()
    assert [r["id"] for r in found] == [6]
    assert [r["id"] for r in scan_partition(spark, folder, "name=50%").collect()] == [3]


def test_scan_partition(spark, months):
    with pytest.warns(UserWarning, match="replace the values stored"):
        df = scan_partition(spark, months, "year=2023/month=1")
    assert df.count() == 10
    assert {(r["year"], r["month"]) for r in df.collect()} == {(2023, 1)}
    for selector, count in (("year=2024", 20), ("month=02", 20), ("month=2", 20)):
        with pytest.warns(UserWarning):
            assert scan_partition(spark, months, selector).count() == count


def test_keys_named_like_the_columns_of_the_listing(spark, folder):
    df = spark.sql("SELECT 1 id, 'a' level, 'b' partition, 'c' path")
    write_parquet(df, folder, ["level", "partition", "path"])
    assert scan_partition(spark, folder, "partition=b/level=a/path=c").count() == 1


@pytest.mark.parametrize("selector", ["year=1999", "day=1", "year=2023/month=7"])
def test_unknown_partitions(spark, months, selector):
    with pytest.raises(ValueError, match="partitions the first 4 are year=2023/"):
        scan_partition(spark, months, selector)


def test_selectors():
    assert parse_selector("year=2023/month=01") == {"year": "2023", "month": "01"}
    assert parse_selector("year=2023\\month=01") == {"year": "2023", "month": "01"}
    assert parse_selector("k=a=b") == {"k": "a=b"}
    for text in ("", "year", "year=1/month"):
        with pytest.raises(ValueError, match="key=value"):
            parse_selector(text)


def test_partition_condition_reaches_the_scan(spark, folder, capsys):
    df = spark.range(100).withColumn("part", F.col("id") % 4)
    write_parquet(df, folder, "part")
    scan_partition(spark, folder, "part=3").select("id").explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(part" in plan
    assert "ReadSchema: struct<id:bigint>" in plan


# --- scans ------------------------------------------------------------------------


def test_stored_values_or_folder_values(spark, tmp_path):
    root = tmp_path / "clash"
    write_file(root / "kind=1" / "p.parquet", {"id": [1, 2], "kind": ["one", "uno"]})
    with pytest.warns(UserWarning, match="replace the values stored in the files"):
        folders = scan_parquet(spark, str(root))
    assert {r["kind"] for r in folders.collect()} == {1}
    stored = scan_parquet(spark, str(root), hive=False)
    assert {r["kind"] for r in stored.collect()} == {"one", "uno"}


def test_raw_partition_text(spark, months):
    df = scan_parquet(spark, months, raw_partition_text=True)
    assert {r["month"] for r in df.select("month").distinct().collect()} == {"01", "02"}


def test_columns_and_missing_paths(spark, months, tmp_path):
    with pytest.warns(UserWarning):
        assert scan_parquet(spark, months, columns=["id"]).columns == ["id"]
    with pytest.raises(FileNotFoundError, match="Cannot locate"):
        scan_parquet(spark, str(tmp_path / "nowhere"))


def test_unreadable_columns_are_left_out(spark, tmp_path):
    day = datetime.date(2024, 5, 6)
    moment = datetime.datetime(2024, 5, 6, 7, 8, 9)
    columns = {
        "i8": pa.array([1], pa.int8()),
        "u8": pa.array([200], pa.uint8()),
        "u32": pa.array([4_000_000_000], pa.uint32()),
        "u64": pa.array([2**63], pa.uint64()),
        "t32": pa.array([1], pa.time32("ms")),
        "t64": pa.array([1], pa.time64("us")),
        "ns": pa.array([1], pa.timestamp("ns")),
        "half": pa.array([1.5], pa.float16()),
        "day": pa.array([day]),
        "us": pa.array([moment], pa.timestamp("us")),
        "utc": pa.array([moment], pa.timestamp("us", "UTC")),
        "dec": pa.array([decimal.Decimal("1.25")], pa.decimal128(10, 2)),
        "list": pa.array([[1, 2]]),
        "times": pa.array([[1]], pa.list_(pa.time32("ms"))),
        "text": pa.array(["x"], pa.large_string()),
    }
    write_file(tmp_path / "odd" / "part=1" / "p.parquet", columns)
    with pytest.warns(UserWarning, match="t32, t64, ns, half, times"):
        df = scan_parquet(spark, str(tmp_path / "odd"))
    row = df.first().asDict()
    assert row["u8"] == 200 and row["u32"] == 4_000_000_000 and row["u64"] == 2**63
    assert row["day"] == day and row["us"] == moment and row["part"] == 1
    assert row["dec"] == decimal.Decimal("1.25") and row["list"] == [1, 2]
    assert not {"t32", "t64", "ns", "half", "times"} & set(row)
