import hashlib
import random
from collections import Counter

import pytest
from llm_cases import awkward, collected, copies, frame, prose, words
from pyspark.sql import functions as F

from quadrille.llm import substrings
from quadrille.llm.common import text_id


def brute(rows, window):
    """Rows ``(id, words, removed, kept)``; rows with one id are one document."""
    places = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, own in split:
        for k in range(len(own) - window + 1):
            key = tuple(own[k : k + window])
            places[key] = min(places.get(key, (i, k)), (i, k))
    out = []
    for i, own in split:
        covered = set()
        for k in range(len(own) - window + 1):
            if places[tuple(own[k : k + window])] < (i, k):
                covered.update(range(k, k + window))
        kept = [w for k, w in enumerate(own) if k not in covered]
        out.append((i, len(own), len(covered), b" ".join(kept)))
    return out


def compare(spark, rows, window):
    docs = frame(spark, rows)
    ids = docs.select(text_id("doc_id", "text").alias("i"), "text").collect()
    expected = Counter(
        (i if i >= -(1 << 62) else None, n, gone, hashlib.sha256(kept).hexdigest())
        for i, n, gone, kept in brute([tuple(r) for r in ids], window)
    )
    out = substrings.drop_repeated_passages(docs, window)
    assert Counter(collected(out, "doc_id", "n_words", "n_removed", "kept_sha256")) == (
        expected
    )
    return sum(n * c for (_, _, n, _), c in expected.items())


@pytest.mark.parametrize("window", [1, 3, 10, 20, 45])
def test_documents(spark, window):
    assert compare(spark, awkward() + copies(window), window) > 0


def test_few_words_repeat_often(spark):
    r = random.Random(7)
    rows = [(k, words(r, r.randint(0, 120), 3)) for k in range(60)]
    rows += [(100 + k, "a b " * 40) for k in range(5)]
    compare(spark, rows, 20)


def test_several_slices(spark, monkeypatch):
    """Windows are settled inside a slice and between slices alike."""
    r = random.Random(8)
    passage = prose(r, 25)
    rows = [(k, f"{prose(r, 30)} {passage} {prose(r, 9)}") for k in range(300)]
    r.shuffle(rows)
    assert compare(spark, rows, 20) == 25 * 299


def test_kept_text_and_carried_columns(spark):
    docs = frame(spark, awkward())
    others = [c for c in docs.columns if c != "text"]
    out = substrings.drop_repeated_passages(docs, carry=others, keep_text=True)
    rows = out.select("row.*", "kept_text", "n_removed", "kept_sha256")
    assert Counter(rows.select(*others).collect()) == Counter(docs.select(*others).collect())
    texts = {t for _, t in awkward()}
    for row in rows.collect():
        if row["n_removed"] == 0:
            assert row["kept_text"] in texts
        else:
            digest = hashlib.sha256(row["kept_text"].encode()).hexdigest()
            assert digest == row["kept_sha256"]


def test_levels():
    assert substrings.levels(20) == [10, 20]
    assert substrings.levels(50) == [10, 20, 40, 50]
    assert substrings.levels(4) == [4]


def test_empty_table(spark):
    assert substrings.drop_repeated_passages(frame(spark, [])).count() == 0


def test_one_exchange_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = substrings.drop_repeated_passages(docs).agg(F.count("*"))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan or "ReusedQueryStage" in plan
