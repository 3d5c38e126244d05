"""Schema files: CSV tables of field names, types, aliases and text lengths."""

from __future__ import annotations

from posixpath import dirname

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of a schema file, and type names that stand for text.
SCHEMA_COLUMNS = ("field_name", "field_type", "field_alias", "field_length")
TEXT_SYNONYMS = ("string", "str")
# Fixed value: the folder beside a dataset that holds its schema file.
SCHEMA_FOLDER = "schema"


def find_schema_file(spark: SparkSession, dataset: str) -> str | None:
    """The schema folder beside a dataset, when it holds a CSV file; None otherwise."""
    folder = f"{dirname(str(dataset).rstrip('/'))}/{SCHEMA_FOLDER}"
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
    try:
        return None if names.load(folder).select("path").isEmpty() else folder
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def load_schema_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a schema file, or all CSV files of a schema folder.

    Columns are found by their header name; type names for text become ``TEXT``.
    """
    raw = (
        spark.read.option("header", True)
        .option("pathGlobFilter", "*.csv")
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", True)
        .csv(str(path))
    )
    missing = [c for c in SCHEMA_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"The schema file lacks the columns: {', '.join(missing)}.")
    is_text = F.lower("field_type").isin(*TEXT_SYNONYMS)
    return raw.select(
        "field_name",
        F.when(is_text, "TEXT").otherwise(F.col("field_type")).alias("field_type"),
        "field_alias",
        # lengths written through a float column look like 512.0
        F.col("field_length").try_cast("double").cast("int").alias("field_length"),
    )
