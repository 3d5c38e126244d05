"""Schema operators, profiles, rejects and text functions."""

import datetime
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from quadrille.functions.text import partition_fallback, slugify
from quadrille.operators import profile, quality, schema
from quadrille.session import scratch_path


def test_complex_columns(spark):
    df = spark.sql("SELECT 1 a, array(1) b, map('k', 2) c, named_struct('d', 3) d")
    assert schema.complex_columns(df) == ["b", "c", "d"]
    text = schema.stringify_complex(df).first()
    assert tuple(text) == (1, "[1]", '{"k":2}', '{"d":3}')
    some = schema.stringify_complex(df, ["b", "a", "nope"])
    assert [t for _, t in some.dtypes] == ["int", "string", "map<string,int>", "struct<d:int>"]


def test_null_members_stay_in_the_text(spark):
    df = spark.sql("SELECT named_struct('a', CAST(NULL AS int), 'b', array(null, 1)) s")
    assert schema.stringify_complex(df).first()["s"] == '{"a":null,"b":[null,1]}'


@pytest.mark.parametrize(
    ("name", "safe"),
    [("1a", "c1a"), ("delta", "cdelta"), ("delta_t", "cdelta_t"), ("Delta", "Delta"),
     ("a1", "a1"), ("٣x", "c٣x")],
)
def test_safe_names(name, safe):
    assert schema.safe_name(name) == safe


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, "x")], ["a.b", "2 c"])
    renamed = schema.safe_column_names(df)
    assert renamed.columns == ["a.b", "c2 c"]
    assert renamed.schema["c2 c"].metadata["alias"] == "2 c"


def test_alias_survives_parquet(spark, folder):
    df = schema.safe_column_names(spark.createDataFrame([(1,)], ["1a"]))
    df.write.parquet(folder)
    assert spark.read.parquet(folder).schema["c1a"].metadata == {"alias": "1a"}


TYPES = (
    "SELECT 1Y y, 2S s, 3 i, 4L l, 1.5F f, 2.5D d, 1.25BD dec, true o, 't' t, X'01' b,"
    " array(1) a, date'2024-01-02' day, timestamp_ntz'2024-01-02 03:04:05.678901' ntz,"
    " timestamp'2024-07-02 03:04:05.678901Z' ts, INTERVAL 1 DAY v, CAST(NULL AS timestamp_ntz) n"
)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_export_types(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = schema.normalize_export_types(spark.sql(TYPES))
        row = df.first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [t for _, t in df.dtypes] == [
        "smallint", "smallint", "bigint", "bigint", "float", "double", "double",
        "string", "string", "binary", "string", "timestamp_ntz", "timestamp_ntz",
        "timestamp_ntz", "string", "timestamp_ntz",
    ]
    assert row["ntz"] == datetime.datetime(2024, 1, 2, 3, 4, 5)
    hour = 3 if zone == "UTC" else 5
    assert row["ts"] == datetime.datetime(2024, 7, 2, hour, 4, 5)
    assert row["day"] == datetime.datetime(2024, 1, 2) and row["n"] is None


def test_import_types(spark):
    df = schema.normalize_import_types(spark.sql(TYPES).drop("b"))
    assert [t for _, t in df.dtypes] == [
        "int", "int", "int", "bigint", "double", "double", "double", "string", "string",
        "string", "date", "timestamp_ntz", "timestamp", "string", "timestamp_ntz",
    ]
    with pytest.raises(ValueError, match="Binary"):
        schema.normalize_import_types(spark.sql(TYPES))


def test_managed_fields(spark):
    df = spark.sql("SELECT 1 oid, 2 len, 3 area, 4 raster, 5 keep")
    left = schema.drop_managed_fields(df, "oid", "len", "area", ["raster"])
    assert left.columns == ["keep"]


def test_schema_join_prefers_the_safe_name(spark):
    df = schema.safe_column_names(spark.createDataFrame([("a", "b", "c")], ["1a", "b", "d"]))
    table = spark.createDataFrame(
        [
            ("c1a", "TEXT", "by name", 10),
            ("other", "TEXT", "1a", 20),
            ("zz", "TEXT", "b", 30),
            ("c1a", "TEXT", "zz twice", 11),
        ],
        profile.PROFILE_SCHEMA,
    )
    rows = schema.join_schema(schema.field_table(df), table).orderBy("position").collect()
    assert [(r["field_alias"], r["field_length"], r["listed"]) for r in rows] == [
        ("by name", 10, True),
        ("b", 30, True),
        ("d", 512, False),
    ]


# --- profile ----------------------------------------------------------------------


def test_lengths(spark):
    df = spark.createDataFrame(
        [("aé", None, [1], 5), (None, None, [1, 22], 6), ("", None, None, 7)],
        "t string, n string, a array<int>, i int",
    )
    assert profile.max_string_lengths(df).first().asDict() == {"t": 2, "n": 0}
    assert profile.max_complex_lengths(df).first().asDict() == {"a": 6}
    rows = [tuple(r) for r in profile.profile_fields(df).collect()]
    assert rows == [
        ("t", "TEXT", "t", 2),
        ("n", "TEXT", "n", 512),
        ("a", "TEXT", "a", 6),
        ("i", "INTEGER", "i", None),
    ]


def test_only_text_is_read_for_lengths(spark, folder, capsys):
    spark.sql("SELECT 'x' t, 1 a, 2.0D b").write.parquet(folder)
    profile.max_string_lengths(spark.read.parquet(folder)).explain()
    assert "ReadSchema: struct<t:string>" in capsys.readouterr().out


def test_tables_without_text(spark):
    rows = profile.profile_fields(spark.range(3)).collect()
    assert [tuple(r) for r in rows] == [("id", "LONG", "id", None)]
    with pytest.raises(ValueError, match="no attribute to describe"):
        profile.profile_fields(spark.range(3).withColumnRenamed("id", "geometry"))


# --- rejects ----------------------------------------------------------------------


def test_split_keeps_every_row(spark, folder):
    df = spark.range(100)
    rules = {"small": F.col("id") < 10, "even": F.col("id") % 2 == 0, "never": F.lit(None).cast("boolean")}
    split = quality.split_rejects(df, rules)
    reasons = split.rejected.groupBy("reject_reason").count().collect()
    assert {r[0]: r[1] for r in reasons} == {"small": 10, "even": 45}
    assert split.good.count() == 45 and split.good.columns == ["id"]


def test_counts_come_with_the_load(spark, folder):
    good, observation = quality.observe_counts(spark.range(100), {"small": F.col("id") < 10})
    good.write.parquet(folder)
    assert observation.get == {"added": 90, "failed": 10}


# --- text -------------------------------------------------------------------------


def reference_slug(text, separator="_"):
    plain = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
    slug = re.sub("[^a-z0-9]+", separator, plain.lower())
    return slug.strip(separator) if separator else slug


def test_slugs(spark):
    rng = random.Random(1)
    texts = [
        "Hello, World!", "  Straße nach Köln  ", "ÀÉÎÕÜ çñ", "ﬁne ½ ①②", "日本語 x",
        "ℌello 𝔘nicode 𝟚", "a__b--c", "___", "", "İstanbul", "100 % $ok$", "Ⅳ ㎏", "é",
    ]
    pool = [chr(c) for c in range(0x20, 0x2FFF) if not 0xD800 <= c < 0xE000]
    pool += [chr(c) for c in range(0xFB00, 0xFB07)] + [chr(c) for c in range(0x1D400, 0x1D7FF)]
    texts += ["".join(rng.choices(pool, k=12)) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    for separator in ("_", "-", "$", "__"):
        rows = df.select(slugify(F.col("t"), separator).alias("s")).orderBy("id").collect()
        for text, row in zip(texts, rows):
            assert row["s"] == reference_slug(text, separator), repr(text)


def test_null_slug(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(slugify(F.col("t")).alias("s")).first()["s"] is None


def test_partition_fallback(spark):
    df = spark.createDataFrame([("a",), ("",), ("  ",), (None,), (" b",)], "t string")
    rows = df.select(partition_fallback(F.col("t")).alias("v")).collect()
    assert [r["v"] for r in rows] == ["a", *["__unknown__"] * 3, " b"]


def test_scratch_folder_is_the_shared_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{root}/quadrille/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


class Settings:
    """Stands for a session of which only the settings matter."""

    def __init__(self, **values):
        self.values = {k.replace("_", "."): v for k, v in values.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_a_cluster_without_a_shared_folder_is_refused():
    for master in ("yarn", "local[2]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_path(Settings(spark_master=master), "x")
    shared = Settings(spark_master="yarn", spark_checkpoint_dir="hdfs://n/tmp/")
    assert scratch_path(shared, "x").startswith("hdfs://n/tmp/quadrille/x-")


def test_functions_work_on_streams(spark, folder, tmp_path):
    """The column functions keep no state, so a stream may use them."""
    from quadrille.functions.cells import cell_of_point

    spark.range(20).selectExpr("double(id) x", "double(id) y").write.parquet(folder)
    stream = spark.readStream.schema("x double, y double").parquet(folder)
    cells = stream.select(cell_of_point(F.col("x"), F.col("y"), 5).alias("cell"))
    query = (
        cells.writeStream.format("memory")
        .queryName("stream_cells")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(60)
    assert spark.table("stream_cells").where("length(cell) = 5").count() == 20
