import hashlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import collected

from quadrille.llm import cover_codes, cover_tree

SCHEMA = "vec_id long, embedding array<float>, label string, id string, code string, ids string"


def lloyd(rows, parts=16, entries=64, rounds=2):
    """All parts against all entries, in Python's whole numbers."""

    def usable(v):
        return v and len(v) % parts == 0 and all(x is not None and np.isfinite(x) for x in v)

    rows = [r for r in rows if usable(r[1])]
    last = 1 << 62
    rows.sort(key=lambda r: (last if r[0] is None else r[0], list(r[1])))
    rows = [r for r in rows if len(r[1]) == len(rows[0][1])]
    ints = [
        [max(min(int(np.floor(float(np.float32(x)) * 256)), 1 << 24), -(1 << 24)) for x in v]
        for _, v, _ in rows
    ]
    width = len(ints[0]) // parts
    cut = [[v[k * width : k * width + width] for k in range(parts)] for v in ints]
    books = [[list(v[k]) for v in cut[:entries]] for k in range(parts)]

    def nearest(part, book):
        return min(
            (sum((a - b) ** 2 for a, b in zip(part, c)), j) for j, c in enumerate(book)
        )

    for _ in range(rounds):
        for k in range(parts):
            own = {}
            for v in cut:
                own.setdefault(nearest(v[k], books[k])[1], []).append(v[k])
            for j, members in own.items():
                books[k][j] = [sum(c) // len(members) for c in zip(*members)]
    out, by_label = [], Counter()
    for (number, _, label), v in zip(rows, cut):
        best = [nearest(v[k], books[k]) for k in range(parts)]
        error = sum(d for d, _ in best)
        by_label[label] += error
        out.append((number, "".join(f"{j:02x}" for _, j in best), error, label))
    digest = hashlib.sha256(
        ",".join(str(x) for book in books for c in book for x in c).encode()
    ).hexdigest()
    return Counter((n, code, e, by_label[label], digest) for n, code, e, label in out)


def vectors(seed, count=150, dimensions=32):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(9, dimensions)) / 5
    near = centres[r.integers(0, 9, count)] + r.normal(size=(count, dimensions)) / 40
    # copies, and components that tie
    near[::7] = near[0]
    near[1::11] = np.round(near[1::11] * 8) / 8
    return [(int(3 * k), v.tolist(), f"l{k % 3}") for k, v in enumerate(near)]


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, "?", "?", "?") for r in rows], SCHEMA).repartition(3)
    out = cover_codes.compress(df, **options)
    names = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert out.columns == names
    assert Counter(collected(out, *names)) == lloyd(rows, **options)


def test_clusters_and_awkward_vectors(spark):
    rows = vectors(1)
    some = rows[0][1]
    rows += [
        (-5, None, "l1"),
        (-4, [], "l1"),
        (-3, [float("nan")] + some[1:], "l0"),
        (-2, [float("inf")] + some[1:], "l0"),
        (-1, [None] + some[1:], "l0"),
        (-6, some[:7], "l0"),
        (2000, some[:16], "l0"),
        (2001, some, None),
        (2002, some[::-1], None),
        (2003, some, "l0"),
        (2003, some, "l0"),
        (2003, some[::-1], "l1"),
        (None, some[::-1], "l9"),
        (2005, [-1e30] + some[1:], "l9"),
        (2006, [0.0] * 32, "l9"),
    ]
    check(spark, rows)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(cover_codes, "BLOCK_VECTORS", 20)
    check(spark, vectors(2, 200))


@pytest.mark.parametrize("options", [{"parts": 4, "entries": 5}, {"parts": 1, "rounds": 4}])
def test_other_shapes(spark, options):
    check(spark, vectors(3, 120), **options)


def test_few_vectors(spark):
    check(spark, vectors(4, 5))
    check(spark, vectors(4, 1))


def test_rare_labels_are_joined(spark, monkeypatch):
    monkeypatch.setattr(cover_codes, "HOT_LABELS", 3)
    rows = [(k, v, None if k % 4 else f"own {k}") for k, v, _ in vectors(5)]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, None, "a")], [(1, [1.0, 2.0], "a")]])
def test_no_vectors(spark, rows):
    df = spark.createDataFrame([(*r, "?", "?", "?") for r in rows], SCHEMA)
    assert cover_codes.compress(df).count() == 0


def test_too_many_entries(spark):
    with pytest.raises(ValueError):
        cover_codes.compress(spark.createDataFrame([], SCHEMA), entries=257)


def sets(seed, trees=3, size=700, dimensions=3):
    r = np.random.default_rng(seed)
    points = r.integers(-400, 400, (trees, size, dimensions))
    points[0] //= 40  # many equal points
    points[1, : size // 2] += 5000
    points[2] = points[2, 0]
    return points


def test_covering_and_separation():
    points = sets(6)
    forest = cover_tree.build(points)
    flat = points.reshape(-1, 3)
    assert (flat[forest.order] == forest.points).all()
    assert (np.sort(forest.order) == np.arange(len(flat))).all()
    for k in range(len(forest.first)):
        own = forest.points[forest.first[k] : forest.end[k]]
        away = np.sqrt(((own - own[0]) ** 2).sum(axis=1))
        assert np.isclose(away.max(), forest.radius[k])
        if not forest.children[k]:
            assert len(own) <= cover_tree.LEAF or away.max() == 0
            continue
        below = range(forest.child[k], forest.child[k] + forest.children[k])
        assert forest.first[below[0]] == forest.first[k]
        assert forest.end[below[-1]] == forest.end[k]
        assert all(forest.end[a] == forest.first[a + 1] for a in below[:-1])
        half = 2.0 ** np.ceil(np.log2(away.max())) / 2
        assert forest.radius[list(below)].max() <= half
        heads = forest.points[forest.first[list(below)]]
        apart = np.sqrt(((heads[:, None] - heads[None]) ** 2).sum(axis=2))
        assert (apart + np.eye(len(heads)) * 1e9).min() > half


def test_whole_subtrees():
    """Far centres are decided high up in the tree, and sums are those of the points."""
    points = sets(7)
    forest = cover_tree.build(points)
    centres = np.array([[[0, 0, 0], [5000, 5000, 5000], [0, 0, 0]]] * 3)
    tree, entry, first, end = cover_tree.assign(forest, centres)
    assert (end - first).sum() == len(forest.points)
    assert (end - first)[tree == 1].max() > 100 and not (entry == 2).any()
    counts, sums = cover_tree.totals(forest, centres)
    code, error = cover_tree.codes(forest, centres)
    for t in range(3):
        square = ((points[t][:, None] - centres[t][None]) ** 2).sum(axis=2)
        assert (code[t] == square.argmin(axis=1)).all()
        assert (error[t] == square.min(axis=1)).all()
        for j in range(3):
            own = points[t][code[t] == j]
            assert counts[t * 3 + j] == len(own)
            assert (sums[t * 3 + j] == own.sum(axis=0)).all()
