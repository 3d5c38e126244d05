import random
import sys
from collections import Counter
from pathlib import Path

import pytest
from llm_cases import awkward, collected, copies, frame, prose
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from quadrille.llm import queries  # noqa: E402
from quadrille.llm.common import gathered  # noqa: E402


@pytest.fixture(scope="module")
def docs():
    r = random.Random(31)
    rows = awkward() + copies(5, base=30)
    passage = prose(r, 60)
    rows += [(3000 + k, f"{prose(r, 40)} {passage} {prose(r, 40)}") for k in range(12)]
    rows += [(4000, f"write to a.b@mail.example.com or +1 (555) 010-9999\n{prose(r, 70)}")]
    rows += [(4001, " ".join(f"ab{k}###" for k in range(90)))]
    return rows


def test_stages_keep_columns_and_decisions(spark, docs):
    table = frame(spark, docs)
    now = table
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, "unused").persist()
        assert now.schema.simpleString() == table.schema.simpleString()
        seen[name] = {}
        for i, text, n in collected(now, "doc_id", "text", "n_chars"):
            seen[name].setdefault(i, []).append(text)
            assert n == len(text)
    assert 4001 not in seen["quality"] and 2 not in seen["quality"]
    assert 4000 in seen["quality"] and 7 in seen["quality"]
    assert len(seen["quality"][4]) == 2
    # a row without an id sorts first, so it stands for its near copies 4 and 5
    assert len(seen["near_copies"][None]) == 1
    assert not {4, 5} & seen["near_copies"].keys()
    passage_holders = [i for i in seen["passages"] if i and 3000 <= i < 3012]
    lengths = {i: len(seen["passages"][i][0].split()) for i in passage_holders}
    assert lengths[3000] == 140 and all(lengths[i] == 80 for i in passage_holders[1:] if i > 3000)
    text = seen["personal_data"][4000][0]
    assert "[EMAIL]" in text and "[PHONE]" in text and "@" not in text
    packed = corpus_pipeline.STAGES[-1][1](spark, now, "unused")
    ids = {i for (i,) in collected(packed, "doc_id")}
    assert ids == {i for (i,) in collected(now, "doc_id")}


def test_near_copies_with_one_id(spark):
    r = random.Random(8)
    text, other, third = prose(r, 200), prose(r, 200), prose(r, 200)
    rows = [
        # a page crawled twice, and a third version with an id of its own
        (1, text),
        (1, text + " changed"),
        (2, text + " again"),
        # one row with this id is a near copy of 1, the others are not linked with it
        (3, "see " + text),
        (3, other),
        (3, third),
        (3, third),
        (4, ""),
        (4, None),
    ]
    out = corpus_pipeline.drop_near_copies(spark, frame(spark, rows), "unused")
    found = Counter(collected(out, "doc_id", "text"))
    assert sum(n for (i, _), n in found.items() if i == 1) == 1
    assert found.keys() <= set(rows)
    rest = {(i, t): n for (i, t), n in found.items() if i != 1}
    assert rest == {(3, other): 1, (3, third): 1, (4, ""): 1, (4, None): 1}


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    size = out.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    sizes = Counter(n for (n,) in collected(size, "n"))
    assert sizes.pop(2048) > 10
    assert all(n & (n - 1) == 0 and c == 1 for n, c in sizes.items())


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


@pytest.fixture
def many_partitions(spark):
    """More shuffle partitions than a small table has use for, and none put together."""
    keys = {
        "spark.sql.shuffle.partitions": "61",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield 61
    for k, v in before.items():
        spark.conf.set(k, v)


def _stored_files(spark, label):
    """Numbers of files of the tables stored under a label, by table."""
    root = Path(spark.conf.get("spark.checkpoint.dir")) / "quadrille"
    return {p.name: len(list(p.glob("part-*"))) for p in root.glob(f"{label}-*")}


def test_few_rows_fill_few_files(spark, docs, many_partitions):
    cores = spark.sparkContext.defaultParallelism
    assert cores < many_partitions
    labels = ("classes", "edges", "members", "links", "components")
    before = {label: _stored_files(spark, label) for label in labels}
    r = random.Random(17)
    table = frame(spark, docs + [(5000 + k, prose(r, 30)) for k in range(300)])
    single = corpus_pipeline.drop_near_copies(spark, table, "unused")
    assert single.rdd.getNumPartitions() <= cores
    for label in labels:
        now = _stored_files(spark, label)
        new = {k: n for k, n in now.items() if k not in before[label]}
        assert new and max(new.values()) <= cores, label
    kept = {i for (i,) in collected(single, "doc_id")}
    assert {5000 + k for k in range(300)} <= kept and not {4, 5} & kept
    # frames that have been written have few partitions, so start from the table
    for stage in (corpus_pipeline.drop_passages, corpus_pipeline.pack):
        made = stage(spark, table, "unused")
        assert made.rdd.getNumPartitions() <= cores
        assert kept <= {i for (i,) in collected(made, "doc_id")}


def test_gathered_keeps_rows_and_width(spark):
    rows = spark.range(0, 1000, 1, 40)
    cores = spark.sparkContext.defaultParallelism
    few = gathered(rows, 1000)
    assert few.rdd.getNumPartitions() == cores
    assert sorted(i for (i,) in few.collect()) == list(range(1000))
    # as many partitions as the rows fill, and never more than there were
    assert gathered(rows, 1000, 50).rdd.getNumPartitions() == 20
    assert gathered(rows, 1000, 1).rdd.getNumPartitions() == 40
