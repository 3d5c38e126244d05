"""Queries whose rows are heavy do not leave them to the tasks of a small scan."""

import pytest
from pyspark.sql import functions as F

import workload
from quadrille.sinks import geoparquet

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["export_cells", "compound_shapes", "centroid"])
def test_rows_of_one_row_group_are_dealt_to_all_tasks(spark, name):
    found = workload.registered()[name](spark, SF_DIR)
    tasks = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_clustered_rows_are_sorted_once(spark, monkeypatch):
    """The header of the window query comes from the rows as they were before."""

    def sorted_again(*_):
        raise AssertionError("a pass over the sorted rows for the header")

    monkeypatch.setattr(geoparquet, "header_of", sorted_again)
    assert workload.registered()["window_scan"](spark, SF_DIR).count() > 0
