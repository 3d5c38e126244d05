"""Feature tables in partitioned Parquet and GeoParquet, on Spark."""

from .plans.export import export_features
from .plans.imports import ImportedFeatures, import_features
from .plans.schema_file import create_schema

__all__ = ["ImportedFeatures", "create_schema", "export_features", "import_features"]
