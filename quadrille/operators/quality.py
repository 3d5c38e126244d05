"""Row quarantine: bad rows are set aside with a reason, the load goes on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.cells import is_cell
from ..functions.geometry import DEFAULT_SRID, points
from ..names import column, columns

REASON = "reject_reason"


@dataclass(frozen=True)
class Split:
    """Accepted and rejected rows of one frame; both are lazy."""

    good: DataFrame
    rejected: DataFrame


def reject_reason(rules: dict[str, Column]) -> Column:
    """Name of the first rule that is true for the row; null for a good row."""
    reasons = [F.when(broken, F.lit(name)) for name, broken in rules.items()]
    return F.coalesce(*reasons, F.lit(None).cast("string"))


def flag_rejects(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return df.withColumn(REASON, reject_reason(rules))


def split_rejects(df: DataFrame, rules: dict[str, Column]) -> Split:
    """Rows that break no rule, and the others with the reason."""
    flagged = flag_rejects(df, rules)
    return Split(
        flagged.where(F.col(REASON).isNull()).drop(REASON),
        flagged.where(F.col(REASON).isNotNull()),
    )


def evaluated_once(df: DataFrame, name: str) -> DataFrame:
    """Keep filters on a column from evaluating the Python function behind it again.

    Spark moves a filter below the projection it refers to and repeats the projected
    expression there, also when that is a Python function.  A generator with one element
    holds the filter back, while filters on the other columns still reach the scan.
    """
    metadata = next(f.metadata for f in df.schema if f.name == name)
    others = columns(c for c in df.columns if c != name)
    single = F.explode(F.array(column(name)))
    return df.select(*others, single.alias(name)).withMetadata(name, metadata)


def observe_counts(
    df: DataFrame, rules: dict[str, Column], name: str = "load"
) -> tuple[DataFrame, Observation]:
    """Good rows, and counts taken while they are written: ``added`` and ``failed``.

    The counts need no pass of their own; read ``observation.get`` after the action.
    """
    flagged, observation = observed(flag_rejects(df, rules), name)
    return flagged.where(F.col(REASON).isNull()).drop(REASON), observation


def observed(flagged: DataFrame, name: str = "load") -> tuple[DataFrame, Observation]:
    """Rows of ``flag_rejects``, with an observation that counts both kinds of them."""
    observation = Observation(name)
    rows = flagged.observe(
        observation,
        F.count_if(F.col(REASON).isNull()).alias("added"),
        F.count_if(F.col(REASON).isNotNull()).alias("failed"),
    )
    return rows, observation


# --- rules ------------------------------------------------------------------------


def coordinate_rules(geometry: Column, srid: int = DEFAULT_SRID) -> dict[str, Column]:
    """Rules for geometries that no map can hold; null geometries are accepted.

    The tests run over the vertices, one short expression each.  Written with the bounds
    of the extent they would repeat the geometry many times and grow the generated code
    beyond what the JVM compiles.
    """
    vertices = points(geometry)
    infinity = F.lit(float("inf"))

    def finite(v: Column) -> Column:
        return F.abs(v) < infinity

    rules = {
        "coordinate is not a finite number": F.exists(
            vertices, lambda p: ~(finite(p["x"]) & finite(p["y"]))
        )
    }
    if srid == DEFAULT_SRID:
        rules["latitude out of range"] = F.exists(
            vertices, lambda p: F.abs(p["y"]) > F.lit(90.0)
        )
        # one turn past the antimeridian is a way to cross it, more is an error
        rules["longitude out of range"] = F.exists(
            vertices, lambda p: F.abs(p["x"]) > F.lit(540.0)
        )
    return rules


def wkb_rule(wkb: Column, geometry: Column) -> dict[str, Column]:
    return {"geometry cannot be decoded": wkb.isNotNull() & geometry.isNull()}


def cell_rule(cell: Column) -> dict[str, Column]:
    return {"not a cell id": ~is_cell(cell)}
