"""Queries on attributes: types, names, lengths, schema files, filters and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.functions.text import slugify
from quadrille.operators.profile import (
    max_complex_lengths,
    max_string_lengths,
    profile_fields,
    row_counts,
)
from quadrille.operators.quality import coordinate_rules, split_rejects
from quadrille.operators.rows import sample_rows
from quadrille.operators.schema import (
    apply_schema,
    drop_managed_fields,
    field_table,
    join_schema,
    normalize_export_types,
    normalize_import_types,
    safe_column_names,
    stringify_complex,
)
from quadrille.plans.export import export_features
from quadrille.session import scratch_path
from quadrille.sinks.exports import write_schema_csv
from quadrille.sources.columns import points_from_xy
from quadrille.sources.parquet import scan_parquet
from quadrille.sources.schema_csv import load_schema_csv

from .inputs import BAD_SQL, bad_coordinates, table
from .registry import query


@query(
    "drop_fields",
    """
SELECT l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
       l_linestatus, l_shipdate
FROM lineitem
""",
)
def drop_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return drop_managed_fields(lineitem, "l_orderkey", "l_discount", "l_tax")


@query(
    "export_types",
    """
SELECT l_orderkey, l_partkey, l_suppkey, cast(l_linenumber AS bigint) AS l_linenumber,
       l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       l_shipdate
FROM lineitem
""",
)
def export_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_export_types(table(spark, sf_dir, "lineitem"))


@query(
    "export_types_events",
    """
SELECT event_id, date_trunc('second', ts) AS ts, user_id, event_type, value, props
FROM events
""",
)
def export_types_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps lose their fractions of a second."""
    return normalize_export_types(table(spark, sf_dir, "events"))


@query(
    "import_types",
    """
SELECT l_orderkey, l_linenumber,
       cast(cast(l_extendedprice AS decimal(12,2)) AS double) AS price,
       cast(cast(l_tax AS float) AS double) AS tax,
       CASE WHEN l_returnflag = 'R' THEN 'true' ELSE 'false' END AS returned,
       cast(l_shipdate AS date) AS ship_day, l_shipdate, l_linestatus
FROM lineitem
""",
)
def import_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small integers, decimals, floats and booleans take their feature types."""
    stored = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").cast("smallint").alias("l_linenumber"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_tax").cast("float").alias("tax"),
        (F.col("l_returnflag") == "R").alias("returned"),
        F.col("l_shipdate").cast("date").alias("ship_day"),
        "l_shipdate",
        "l_linestatus",
    )
    return normalize_import_types(stored)


def _renamed_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").toDF("1name", "delta_key", "plain")


@query(
    "safe_names",
    "SELECT n_nationkey AS c1name, n_name AS cdelta_key, n_regionkey AS plain"
    " FROM nation",
)
def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return safe_column_names(_renamed_nations(spark, sf_dir))


_EMBEDDING_TEXT = """
SELECT vec_id, label, to_json(list_transform(embedding,
         lambda x: cast(round(x*100) AS int)))::varchar AS embedding
FROM embeddings
"""


def _whole_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the SQL multiplies in the type of the components; an integer would make it a double
    hundred = F.lit(100).cast("float")
    scaled = F.transform("embedding", lambda x: F.round(x * hundred).cast("int"))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", scaled.alias("embedding")
    )


@query("complex_to_string", _EMBEDDING_TEXT)
def complex_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stringify_complex(_whole_embeddings(spark, sf_dir))


@query(
    "max_complex_lengths",
    f"SELECT cast(max(length(embedding)) AS int) AS embedding FROM ({_EMBEDDING_TEXT})",
)
def longest_complex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_complex_lengths(_whole_embeddings(spark, sf_dir))


@query(
    "max_string_lengths",
    """
SELECT cast(max(length(text)) AS int) AS text, cast(max(length(lang)) AS int) AS lang,
       cast(max(length(source)) AS int) AS source
FROM documents
""",
)
def longest_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_string_lengths(table(spark, sf_dir, "documents"))


@query(
    "where_filter",
    """
SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
WHERE l_quantity > 25 AND l_shipdate >= timestamp '1998-01-01'
""",
)
def where_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The condition of an export; only rows that meet it are in the files."""
    late = F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    path = export_features(
        table(spark, sf_dir, "lineitem"),
        scratch_path(spark, "filtered"),
        where=(F.col("l_quantity") > 25) & late,
        fields=["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"],
    )
    return scan_parquet(spark, path)


@query(
    "reject_split",
    f"""
WITH {BAD_SQL}
SELECT k, lon, lat, CASE
         WHEN lon IS NULL THEN 'longitude is missing'
         WHEN abs(lat) > 90 THEN 'latitude out of range' END AS reject_reason
FROM bad
""",
)
def reject_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and rejected rows together, so that no row may get lost."""
    df = points_from_xy(bad_coordinates(spark, sf_dir), "lon", "lat")
    rules = {
        "longitude is missing": F.col("lon").isNull(),
        **coordinate_rules(F.col("geometry")),
    }
    split = split_rejects(df, rules)
    columns = ["k", "lon", "lat", "reject_reason"]
    good = split.good.withColumn("reject_reason", F.lit(None).cast("string"))
    return good.select(*columns).unionAll(split.rejected.select(*columns))


@query(
    "row_count",
    'SELECT count(*) AS "rows" FROM orders',
)
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(table(spark, sf_dir, "orders"))


@query(
    "sample_rows",
    "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def sample_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return sample_rows(table(spark, sf_dir, "orders"), 100, order)


# --- schema files -----------------------------------------------------------------

_SCHEMA_ROWS = """
SELECT 'c1doc' AS field_name, 'LONG' AS field_type, '1doc' AS field_alias,
       NULL::int AS field_length
UNION ALL SELECT 'cdelta_text', 'TEXT', 'delta_text', max(length(text)) FROM documents
UNION ALL SELECT 'lang', 'TEXT', 'lang', max(length(lang)) FROM documents
UNION ALL SELECT 'source', 'TEXT', 'source', max(length(source)) FROM documents
UNION ALL SELECT 'n_chars', 'LONG', 'n_chars', NULL
"""
_SCHEMA_SQL = f"""
SELECT field_name, field_type, field_alias, cast(field_length AS int) AS field_length
FROM ({_SCHEMA_ROWS})
"""


def _renamed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("1doc"),
        F.col("text").alias("delta_text"),
        "lang",
        "source",
        "n_chars",
    )


@query("schema_csv", _SCHEMA_SQL)
def schema_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _renamed_documents(spark, sf_dir)
    path = write_schema_csv(documents, scratch_path(spark, "schema"))
    return load_schema_csv(spark, path)


@query(
    "schema_join",
    f"""
SELECT cast(row_number() OVER () - 1 AS int) AS position, field_name, field_type,
       field_alias, cast(field_length AS int) AS field_length, true AS listed
FROM ({_SCHEMA_ROWS})
""",
)
def schema_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the renamed table joined with the profile of the same table."""
    documents = _renamed_documents(spark, sf_dir)
    renamed = safe_column_names(documents)
    applied = apply_schema(renamed, profile_fields(documents))
    return join_schema(field_table(applied), profile_fields(documents))


# --- text -------------------------------------------------------------------------

@query(
    "slugify",
    """
SELECT 'nation' AS "table", n_nationkey::bigint AS id,
       trim(regexp_replace(lower(n_name), '[^a-z0-9]+', '_', 'g'), '_') AS slug
FROM nation
UNION ALL
SELECT 'part', p_partkey,
       trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_')
FROM part
""",
)
def slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    def of(name: str, key: str, text: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.lit(name).alias("table"),
            F.col(key).cast("bigint").alias("id"),
            slugify(F.col(text)).alias("slug"),
        )

    nations = of("nation", "n_nationkey", "n_name")
    return nations.unionAll(of("part", "p_partkey", "p_name"))
