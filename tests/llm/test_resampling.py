import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import awkward, collected, frame, prose, words
from pyspark.sql import functions as F

from quadrille.llm import resampling
from quadrille.llm.words import word_hashes


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def brute_weights(rows, targets):
    """Log weights from counts in dictionaries."""
    grams = []
    for _, text in rows:
        own = (text or "").split()
        hashes, _ = word_hashes(pa.array([text or ""], pa.string()))
        assert len(hashes) == len((text or "").encode().split())
        from quadrille.llm.words import joined

        grams.append([*hashes, *joined(hashes[:-1], hashes[1:])])
        del own
    buckets = [[int(g) % resampling.BUCKETS for g in own] for own in grams]
    raw, target = Counter(), Counter()
    for (i, _), own in zip(rows, buckets):
        raw.update(own)
        if i in targets:
            target.update(own)
    plus = 0.1
    size = resampling.BUCKETS * plus

    def ratio(b):
        return math.log((target[b] + plus) / (target.total() + size)) - math.log(
            (raw[b] + plus) / (raw.total() + size)
        )

    return [
        sum(map(ratio, own)) / len(own) * resampling.LENGTH if own else None
        for own in buckets
    ]


def test_weights_and_sample(spark):
    r = random.Random(2)
    rows = awkward() + [(100 + k, words(r, 30) if k % 2 else prose(r, 30)) for k in range(80)]
    labels = labelled(spark, [(100 + k, k % 2, 0) for k in range(40)] + [(4, 1, 0), (None, 1, 0)])
    targets = {4, *range(101, 140, 2)}
    good = F.col("quality") == 1
    out = resampling.resample(frame(spark, rows), labels, good, share=0.4)
    found = collected(out, "doc_id", "log_weight", "key", "kept")
    expected = brute_weights(rows, targets)
    mine = sorted(w for _, w, *_ in found if w is not None)
    assert np.allclose(mine, sorted(w for w in expected if w is not None))
    assert sum(w is None for _, w, *_ in found) == sum(w is None for w in expected)
    keys = sorted((k for *_, k, _ in found if k is not None), reverse=True)
    last = keys[round(0.4 * len(keys)) - 1]
    assert all(kept == (key is not None and key >= last) for *_, key, kept in found)
    # texts like the target weigh more
    by_id = {i: w for i, w, *_ in found}
    assert np.mean([by_id[100 + k] for k in range(41, 80, 2)]) > np.mean(
        [by_id[100 + k] for k in range(40, 80, 2)]
    )


def test_gumbel_numbers(spark):
    """Equal weights: every text is as likely as another."""
    rows = [(k, "a b c") for k in range(4000)]
    out = resampling.resample(
        frame(spark, rows), labelled(spark, []), F.col("quality") == 1, share=0.25
    )
    noise = [k - w for w, k in collected(out, "log_weight", "key")]
    assert abs(np.mean(noise) - 0.5772) < 0.1 and abs(np.var(noise) - math.pi**2 / 6) < 0.2
    kept = [i for i, k in collected(out, "doc_id", "kept") if k]
    assert len(kept) == 1000 and abs(np.mean(kept) - 2000) < 120


@pytest.mark.parametrize("share", [0.0, 1.0, None])
def test_shares(spark, share):
    rows = [(k, "a b") for k in range(20)] + [(50, None)]
    out = resampling.resample(
        frame(spark, rows), labelled(spark, []), F.col("quality") == 1, share=share
    )
    assert out.where("kept").count() == (0 if share == 0.0 else 20)


def test_nth_largest(spark):
    r = random.Random(3)
    values = [r.choice([r.gauss(0, 1), 5.0, -1e9, 1e9]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    order = sorted(values, reverse=True)
    for n in (1, 2, 700, 1500, 2999):
        assert resampling._nth_largest(df, "v", n) == order[n - 1]


def test_held_out_accuracy(spark):
    """The model is fitted on even ids and judged on odd ones."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    out = resampling.resample(docs, labels.where("doc_id % 2 = 0"), good)
    odd = out.join(labels.where("doc_id % 2 = 1"), "doc_id").where("log_weight IS NOT NULL")
    rows = collected(odd, "log_weight", "quality")
    fine = [w for w, q in rows if q == 1]
    poor = [w for w, q in rows if q == 0]
    assert np.mean([a > b for a in fine for b in poor]) > 0.93


def test_empty_table(spark):
    out = resampling.resample(frame(spark, []), labelled(spark, []), F.col("quality") == 1)
    assert out.count() == 0
