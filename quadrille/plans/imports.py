"""Import: Parquet dataset to a typed feature table."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import DEFAULT_SRID
from ..functions.wkb import wkb_kind
from ..names import column, columns
from ..operators.profile import (
    geometry_type_of,
    max_string_lengths,
    string_columns,
)
from ..operators.quality import (
    REASON,
    cell_rule,
    coordinate_rules,
    evaluated_once,
    flag_rejects,
    observed,
    split_rejects,
    wkb_rule,
)
from ..operators.rows import sample_rows
from ..operators.schema import (
    DEFAULT_TEXT_LENGTH,
    apply_schema,
    check_import_format,
    normalize_import_types,
    safe_column_names,
    with_field_facts,
)
from ..session import ship_package
from ..sinks.parquet import cluster_by_cell
from ..sources.columns import (
    check_cell_column,
    check_coordinate_columns,
    points_from_xy,
    polygons_from_cells,
    srid_of,
)
from ..sources.geoparquet import (
    GeoDataset,
    decode_geometry,
    describe_geoparquet,
    geometry_name,
    geometry_type_name,
    has_geoparquet_footer,
)
from ..sources.parquet import scan_parquet, scan_partition
from ..sources.schema_csv import find_schema_file, load_schema_csv

_WKB = "__wkb"


#: Folder key of ``ImportedFeatures.store``, and its values.
STATUS, ADDED, FAILED = "status", "added", "failed"


@dataclass(frozen=True)
class ImportedFeatures:
    """A feature table, the rows that were set aside, and the geometry's description.

    ``flagged`` has both kinds of rows, as features and with the reason for which a row
    was set aside; None when ``features`` is a sample.
    """

    features: DataFrame
    rejected: DataFrame
    geometry_type: str | None
    srid: int
    flagged: DataFrame | None = None

    def save(
        self, table: str, mode: str = "errorifexists", cluster_zoom: int | None = None
    ) -> dict[str, int]:
        """Save the features as a table, ordered along the grid when a zoom is given.

        Returns how many rows were ``added`` and how many ``failed``.  Both are counted
        while the rows are written, in the one pass over the source; only of a sample the
        failed rows are counted in a second one.
        """
        rows = self._both()
        if cluster_zoom is not None:
            rows = cluster_by_cell(rows, cluster_zoom)
        # counted last, as clustering also reads a sample of the rows
        rows, counts = observed(rows)
        good = rows.where(F.col(REASON).isNull()).drop(REASON)
        good.write.mode(mode).saveAsTable(table)
        return self._counted(counts.get)

    def store(self, path: str, mode: str = "errorifexists") -> dict[str, int]:
        """Write features and rejected rows as one dataset, in one job over the source.

        They lie in the folders ``status=added`` and ``status=failed``; the latter have a
        reason.  ``read_stored`` gives both back.  Returns the counts, as ``save`` does.
        """
        rows, counts = observed(self._both())
        status = F.when(F.col(REASON).isNull(), ADDED).otherwise(FAILED)
        write = rows.withColumn(STATUS, status).write.mode(mode)
        write.option("compression", "snappy").partitionBy(STATUS).parquet(path)
        return self._counted(counts.get)

    def _both(self) -> DataFrame:
        if self.flagged is not None:
            return self.flagged
        return self.features.withColumn(REASON, F.lit(None).cast("string"))

    def _counted(self, counts: dict[str, int]) -> dict[str, int]:
        failed = counts["failed"] if self.flagged is not None else self.rejected.count()
        return {"added": counts["added"], "failed": failed}


def read_stored(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Features and rejected rows of ``ImportedFeatures.store``; each reads its folder."""
    rows = spark.read.parquet(path)
    added, failed = (
        rows.where(F.col(STATUS) == kind).drop(STATUS) for kind in (ADDED, FAILED)
    )
    return added.drop(REASON), failed


def import_features(
    spark: SparkSession,
    path: str,
    geometry_format: str = "GEOPARQUET",
    geometry_column: Sequence[str] | str | None = None,
    schema_file: str | None = None,
    partitions: str | None = None,
    srid: int | str = DEFAULT_SRID,
    sample_count: int | None = None,
    *,
    where: Column | str | None = None,
    profile_lengths: bool = True,
    discover_schema: bool = False,
) -> ImportedFeatures:
    """Read a Parquet dataset as a feature table.

    ``geometry_format`` tells where the geometry comes from: ``GEOPARQUET`` (footer and
    primary column, or the ``geometry_column`` given), ``COORDINATES``
    (``geometry_column`` names x and y), ``CELL`` (one cell id column) or ``WKB`` (one
    binary column).  ``partitions`` selects Hive partitions, as in
    ``"year=2023/month=1"``.

    Attributes get their feature types and safe names; alias and text length are in the
    column metadata, from ``schema_file``, with ``discover_schema`` from the folder
    ``schema`` beside the dataset, or, with ``profile_lengths``, measured at once in one
    aggregate over the text columns.  Rows with an unreadable geometry or an impossible coordinate go to
    ``rejected``.  Apart from footers and the measured lengths nothing is read here.
    """
    chosen = check_import_format(geometry_format)
    ship_package(spark)
    if partitions is not None:
        df = scan_partition(spark, path, partitions)
    else:
        df = scan_parquet(spark, path)
    if where is not None:
        df = df.where(where)

    placed, kind, rules = _with_geometry(
        spark, path, df, chosen, geometry_column, int(srid), partitions
    )
    srid = srid_of(placed)
    rules = {**rules, **coordinate_rules(F.col("geometry"), srid)}
    split = split_rejects(placed, rules)
    good = _typed(split.good)
    if schema_file is None and discover_schema:
        schema_file = find_schema_file(spark, path)
    if schema_file is not None:
        good = apply_schema(good, load_schema_csv(spark, str(schema_file)))
    elif profile_lengths:
        good = _with_measured_lengths(good, df)
    flagged = None
    if sample_count is None:
        flagged = _described(flag_rejects(placed, rules), good)
    good = sample_rows(good, sample_count)
    return ImportedFeatures(good, split.rejected, kind, srid, flagged)


def _typed(placed: DataFrame) -> DataFrame:
    return normalize_import_types(safe_column_names(placed.drop(_WKB)))


def _described(flagged: DataFrame, good: DataFrame) -> DataFrame:
    """Flagged rows with the names, types and metadata of the good ones."""
    typed = _typed(flagged)
    # names can have changed, places have not
    at = [name for name in flagged.columns if name != _WKB].index(REASON)
    names = [name for name in typed.columns if name != typed.columns[at]]
    return typed.select(
        *[
            column(name).cast(field.dataType).alias(field.name, metadata=field.metadata)
            for name, field in zip(names, good.schema)
        ],
        column(typed.columns[at]).alias(REASON),
    )


def _with_geometry(
    spark: SparkSession,
    path: str,
    df: DataFrame,
    chosen: str,
    source: Sequence[str] | str | None,
    srid: int,
    partitions: str | None,
) -> tuple[DataFrame, str | None, dict[str, Column]]:
    """Frame with ``geometry``, its feature type, and the rules for a bad source value.

    Rules: null coordinates give a null geometry, which is accepted; a cell id or WKB
    value that cannot be read is not.
    """
    if chosen == "GEOPARQUET":
        dataset = describe_geoparquet(spark, path, partitions, source)
        name = geometry_name(df, dataset, source)
        decoded = decode_geometry(
            _without_binary(df, name, dataset.geometry_columns), name, dataset, _WKB
        )
        kinds = dataset.kinds
    else:
        primary = has_geoparquet_footer(spark, path)
        if primary is not None:
            warnings.warn(
                f"Footers name the geometry column '{primary}', as GeoParquet does, but "
                f"geometry_format is {chosen}.",
                stacklevel=3,
            )
        if chosen == "COORDINATES":
            x, y = check_coordinate_columns(df, source)
            return points_from_xy(_without_binary(df), x, y, srid), "POINT", {}
        if chosen == "CELL":
            name = check_cell_column(df, source)
            outlined = polygons_from_cells(_without_binary(df), name)
            return outlined, "POLYGON", cell_rule(column(name))
        if source not in df.columns:
            raise ValueError(
                f"WKB column '{source}' does not appear to be in the input parquet "
                f"columns, which are {', '.join(df.columns)}."
            )
        dataset = GeoDataset(source, (source,), (), srid)
        decoded = decode_geometry(_without_binary(df, source), source, dataset, _WKB)
        announced = F.sort_array(F.collect_set(wkb_kind(column(source))))
        kinds = df.agg(announced).first()[0]
    decoded = evaluated_once(decoded, "geometry")
    kind = geometry_type_name(kinds) if kinds else geometry_type_of(decoded)
    return decoded, kind, wkb_rule(F.col(_WKB), F.col("geometry"))


def _without_binary(
    df: DataFrame, keep: str | None = None, others: Sequence[str] = (), warn: bool = True
) -> DataFrame:
    """Leave out binary attributes, which a feature table cannot hold, with a warning."""
    binary = [n for n, t in df.dtypes if t == "binary" and n != keep]
    lost = [n for n in binary if n not in others]
    if lost and warn:
        warnings.warn(
            f"Binary columns cannot be attributes and are left out: {', '.join(lost)}.",
            stacklevel=4,
        )
    return df.drop(*binary)


def _with_measured_lengths(good: DataFrame, source: DataFrame) -> DataFrame:
    """Text lengths from the data, measured without touching the geometry."""
    names = [f.name for f in good.schema if f.name != "geometry"]
    attributes = normalize_import_types(safe_column_names(_without_binary(source, warn=False)))
    texts = [n for n in string_columns(attributes) if n in names]
    if not texts:
        return good
    measured = max_string_lengths(attributes.select(*columns(texts))).first()
    aliases = {f.name: f.metadata.get("alias", f.name) for f in good.schema}
    return with_field_facts(
        good, {n: (aliases[n], measured[n] or DEFAULT_TEXT_LENGTH) for n in texts}
    )
