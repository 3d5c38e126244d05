"""Schema file of a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sinks.exports import write_schema_csv
from ..sources.parquet import scan_parquet


def create_schema(
    spark: SparkSession,
    source: DataFrame | str | None = None,
    path: str | None = None,
) -> str:
    """Profile a Parquet dataset, a table or a frame into a schema file folder.

    A text that is the name of a table is read as one, any other text as a path.
    """
    if path is None:
        raise ValueError("An output path for the schema file is required.")
    if source is None:
        raise ValueError("You must provide an input dataset.")
    if isinstance(source, str):
        is_table = "/" not in source and spark.catalog.tableExists(source)
        source = spark.table(source) if is_table else scan_parquet(spark, source)
    return write_schema_csv(source, str(path))
