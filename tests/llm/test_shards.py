from collections import Counter

import pytest
from llm_cases import awkward, frame
from pyspark.sql import functions as F

from quadrille.llm import shards

NAMES = [f"s{i}" for i in range(11)]


def test_slots_are_shared_evenly():
    owners = Counter(shards.fill_table(NAMES, 1009))
    assert max(owners.values()) - min(owners.values()) <= 1 and len(owners) == 11


def test_turns_follow_the_preferences():
    """Brute force: every turn takes the first free slot of the whole preference list."""
    import hashlib

    size, free = 101, set(range(101))
    lists = []
    for name in NAMES:
        d = hashlib.sha256(name.encode()).digest()
        first = int.from_bytes(d[:8], "big") % size
        step = int.from_bytes(d[8:16], "big") % (size - 1) + 1
        lists.append([(first + k * step) % size for k in range(size)])
        assert sorted(lists[-1]) == list(range(size))
    owner = [None] * size
    while free:
        for shard, order in enumerate(lists):
            slot = next((s for s in order if s in free), None)
            if slot is not None:
                owner[slot] = shard
                free.remove(slot)
    assert shards.fill_table(NAMES, size) == owner


def test_few_slots_move_when_a_shard_goes():
    before = shards.fill_table(NAMES, 10007)
    after = shards.fill_table(NAMES[:-1], 10007)
    moved = sum(a != b for a, b in zip(before, after) if a != 10)
    assert moved < 0.1 * len(before)


@pytest.mark.parametrize("names, size", [([], 7), (["a", "a"], 7), (["a"], 8)])
def test_bad_tables(names, size):
    with pytest.raises(ValueError):
        shards.fill_table(names, size)


def test_documents(spark):
    docs = frame(spark, awkward() + [(None, f"text {i}") for i in range(200)])
    out = shards.place_on_shards(docs, NAMES)
    assert out.count() == docs.count()
    assert set(out.columns) == set(docs.columns)  # slot and shard are replaced
    table = dict(enumerate(shards.fill_table(NAMES)))
    for row in out.collect():
        assert row["shard"] == NAMES[table[row["slot"]]]
    # rows without a key are spread
    assert out.where("doc_id IS NULL").select("shard").distinct().count() == 11
    assert out.where("doc_id = 4").select("shard").distinct().count() == 1
    assert "BroadcastHashJoin" in out._jdf.queryExecution().toString()


def test_written_shards(spark, folder):
    out = shards.place_on_shards(frame(spark, awkward(), clashes=False), NAMES)
    shards.write_shards(out, folder)
    back = spark.read.parquet(folder)
    assert back.groupBy("shard").count().orderBy("shard").collect() == (
        out.groupBy("shard").agg(F.count("*").alias("count")).orderBy("shard").collect()
    )


def test_empty_table(spark):
    assert shards.place_on_shards(frame(spark, []), NAMES).count() == 0
