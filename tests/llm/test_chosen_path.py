import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import awkward, collected, copies, frame, prose
from pyspark.sql import functions as F

from quadrille.llm import chosen_path, words
from quadrille.llm.common import Forest, text_id
from quadrille.llm.components import connected_components


def sets_of(rows, length=5):
    out = []
    for i, text in rows:
        own = (text or "").encode().split()
        if len(own) < length:
            out.append((i, {tuple(own)} if own else set()))
        else:
            out.append(
                (i, {tuple(own[k : k + length]) for k in range(len(own) - length + 1)})
            )
    return out


def components(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def brute(rows, threshold):
    sets = sets_of(rows)
    pairs = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if len(sets[a][1] & sets[b][1]) > 0
        and len(sets[a][1] & sets[b][1]) / len(sets[a][1] | sets[b][1]) >= threshold
    ]
    links = Counter(x for pair in pairs for x in pair)
    groups = components(len(sets), pairs)
    least = {}
    for g, (i, _) in zip(groups, sets):
        least[g] = min(least.get(g, i), i)
    return Counter(
        (i, links[k], least[groups[k]], least[groups[k]] == i)
        for k, (i, _) in enumerate(sets)
    )


def compare(spark, rows, threshold=0.8):
    docs = frame(spark, rows)
    known = docs.select(text_id("doc_id", "text").alias("i"), "text").collect()
    expected = brute([tuple(r) for r in known], threshold)
    out = chosen_path.near_documents(docs, threshold)
    found = Counter(collected(out, "row_id", "n_links", "component_id", "kept"))
    hidden = {
        (i, n, c if c >= -(1 << 62) else None, k): x for (i, n, c, k), x in expected.items()
    }
    assert found == hidden
    assert "doc_id" in out.columns
    return sum(n for _, n, *_ in expected)


@pytest.mark.parametrize("threshold", [0.8, 0.6])
def test_documents(spark, threshold):
    assert compare(spark, awkward() + copies(base=60), threshold) > 10


def test_large_groups_are_split_and_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr("quadrille.llm.common.BLOCK", 40)
    monkeypatch.setattr("quadrille.llm.common.BLOCK_WEIGHT", 3000)
    r = random.Random(12)
    base = prose(r, 150).split()
    rows = []
    for k in range(180):
        own = list(base)
        for _ in range(r.randint(0, 3)):
            own[r.randrange(len(own))] = f"new{r.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    assert compare(spark, rows) > 180


def test_a_common_passage_links_nothing(spark):
    r = random.Random(13)
    line = prose(r, 9)
    rows = [(k, line + "\n" + prose(r, 60)) for k in range(200)]
    assert compare(spark, rows) == 0


def test_shingles():
    rows = awkward() + copies(3)
    values, bounds = words.shingles(pa.array([t or "" for _, t in rows], pa.string()), 5)
    sizes = [len(s) for _, s in sets_of(rows)]
    assert np.diff(bounds).tolist() == sizes
    by_text = {}
    for (_, text), a, b in zip(rows, bounds[:-1], bounds[1:]):
        own = values[a:b]
        assert (own[1:] > own[:-1]).all()
        assert by_text.setdefault(text, own.tolist()) == own.tolist()


def test_runs_follow_the_recall():
    assert chosen_path.runs_for(0.5) < chosen_path.runs_for(0.99)
    runs = chosen_path.runs_for(0.999)
    for depth in range(1, chosen_path.DEPTH + 2):
        assert chosen_path.loss_of(runs, 0.8, 0.8, depth) <= 0.001
    assert chosen_path.loss_of(runs - 1, 0.8, 0.8) > 0.001
    with pytest.raises(ValueError, match="cannot reach"):
        chosen_path.runs_for(0.999999)


def test_loss_is_that_of_a_simulation():
    """Few runs, so that the loss can be counted."""
    r = np.random.default_rng(6)
    sampled = 1 / (0.8 * chosen_path.SKETCH)
    runs, trials, lost = 4, 20_000, 0
    for equal in r.binomial(chosen_path.SKETCH, 0.8, trials):
        together = np.ones(runs, np.int64)
        for _ in range(chosen_path.DEPTH + 1):
            together = r.binomial(together * equal, sampled)
        lost += equal < chosen_path.least_equal(0.8) or not together.any()
    assert lost / trials == pytest.approx(chosen_path.loss_of(runs, 0.8, 0.8), abs=0.02)


@pytest.mark.parametrize(("shared", "allowed"), [(80, 10), (85, 4)])
def test_recall_of_the_search(spark, monkeypatch, shared, allowed):
    """3000 pairs of sets at a similarity, in buckets that are split as often as can be."""
    monkeypatch.setattr(chosen_path, "SMALL", 1)
    r = np.random.default_rng(shared)
    rows, pairs = [], 3000
    for pair in range(pairs):
        values = r.integers(0, 1 << 63, 100, np.uint64)
        half = (100 - shared) // 2
        for side, drop in enumerate((slice(0, half), slice(half, 100 - shared))):
            own = np.sort(np.delete(values, drop))
            sketch = chosen_path._sketches(own, np.array([0, len(own)]))[0]
            rows.append((2 * pair + side, bytearray(sketch.tobytes())))
    classes = spark.createDataFrame(rows, "class long, sketch binary").repartition(8)
    edges = chosen_path._candidate_edges(classes, 0.8, chosen_path.runs_for(0.999))
    found = {(min(a, b), max(a, b)) for a, b in collected(edges, "a", "b")}
    missed = sum((2 * k, 2 * k + 1) not in found for k in range(pairs))
    assert missed <= allowed


def test_components(spark):
    r = random.Random(14)
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 50)]
    edges += [(r.randrange(200, 400), r.randrange(200, 400)) for _ in range(120)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = dict(collected(connected_components(df), "id", "component"))
    groups = components(400, [e for e in edges])
    assert found == {x: groups[x] for a, b in edges if a != b for x in (a, b)}


def test_empty_table(spark):
    assert chosen_path.near_documents(frame(spark, [])).count() == 0


def test_links_are_symmetric(spark):
    out = chosen_path.near_documents(frame(spark, copies(21)))
    total = out.agg(F.sum("n_links")).first()[0]
    assert total % 2 == 0 and total > 0


def test_forest():
    r = random.Random(15)
    for _ in range(50):
        n = r.randint(1, 60)
        forest, pairs = Forest(n), []
        for _ in range(4):
            more = [(r.randrange(n), r.randrange(n)) for _ in range(r.randint(0, n // 2))]
            x, y = np.array(more, np.int64).reshape(-1, 2).T
            forest.join(x, y)
            pairs += more
            assert forest.roots().tolist() == components(n, pairs)


def test_many_repeated_rows_bring_one_set(spark):
    """100 000 rows of one id and text, beside near copies and other texts of that id."""
    r = random.Random(12)
    text = prose(r, 60)
    near = text.split()
    near[30] = "other"
    rows = [(7, " ".join(near)), (7, prose(r, 50)), (8, " ".join(near)), (9, prose(r, 40))]
    many = spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    few = spark.createDataFrame(rows, "doc_id long, text string")
    out = chosen_path.near_documents(many.union(few).repartition(8))
    found = out.groupBy("doc_id", "n_links", "component_id", "kept").count().collect()
    assert {tuple(row) for row in found} == {
        (7, 100_001, 7, True, 100_001),
        (8, 100_001, 7, False, 1),
        (7, 0, 7, True, 1),
        (9, 0, 9, True, 1),
    }
