"""Every registered query gives the rows of its SQL."""

import compare
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import workload

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", workload.registered())
def test_query_equals_oracle(spark, connection, name):
    query, sql = workload.registered()[name], workload.oracles()[name]
    assert compare.differences(spark, connection, SF_DIR, query, sql) is None


def test_components_next_to_a_half(spark, tmp_path):
    """Products that round to a half in single precision and not in double."""
    near = np.arange(-60, 60, dtype=np.float32) / 100 + np.float32(0.005)
    near = np.concatenate([np.nextafter(near, np.float32(s)) for s in (-1, 1)] + [near])
    columns = {
        "vec_id": pa.array(range(len(near)), pa.int64()),
        "label": pa.array([0] * len(near), pa.int32()),
        "embedding": pa.array([[x] for x in near], pa.list_(pa.float32())),
    }
    pq.write_table(pa.table(columns), tmp_path / "embeddings.parquet")
    connection = compare.duckdb.connect()
    connection.execute(
        f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet'"
    )
    for name in ("complex_to_string", "max_complex_lengths"):
        query, sql = workload.registered()[name], workload.oracles()[name]
        assert compare.differences(spark, connection, str(tmp_path), query, sql) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
