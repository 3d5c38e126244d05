import itertools
from collections import Counter

import numpy as np
import pytest
from llm_cases import collected

from quadrille.llm import lattice

SCHEMA = "vec_id long, embedding array<float>, label int, kept string, class string"


def clusters(seed, groups=12, dimensions=64):
    r = np.random.default_rng(seed)
    rows, number = [], 0
    for g in range(groups):
        centre = r.normal(size=dimensions)
        centre /= np.linalg.norm(centre)
        for _ in range(r.integers(1, 25)):
            noise = r.normal(size=dimensions)
            vector = centre + noise / np.linalg.norm(noise) * r.choice([0.0, 0.1, 0.14, 0.2])
            rows.append((number, (vector * r.choice([1, 7])).tolist(), int(g % 3)))
            number += 3
    return rows


def brute(rows):
    def unit(vector):
        if vector is None or not vector or any(
            x is None or not np.isfinite(x) for x in vector
        ):
            return None
        vector = np.array(vector, np.float32).astype(float)
        return None if not vector.any() else vector / np.linalg.norm(vector)

    units = [unit(v) if label is not None else None for _, v, label in rows]
    n = len(rows)
    links, parent = Counter(), list(range(n))
    for a, b in itertools.combinations(range(n), 2):
        same = units[a] is not None and units[b] is not None
        if same and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b]):
            if units[a] @ units[b] >= 0.98:
                links.update((a, b))
                x, y = parent[a], parent[b]
                parent = [x if p == y else p for p in parent]
    least = {}
    order = [-(1 << 63) if i is None else i for i, *_ in rows]
    for k in range(n):
        least[parent[k]] = min(least.get(parent[k], order[k]), order[k])
    return Counter(
        (
            rows[k][0],
            links[k],
            None if least[parent[k]] == -(1 << 63) else least[parent[k]],
            least[parent[k]] == order[k],
        )
        for k in range(n)
    )


def compare(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    out = lattice.near_vectors(df)
    assert Counter(collected(out, "vec_id", "n_links", "component_id", "kept")) == brute(rows)


def test_clusters_and_awkward_vectors(spark):
    rows = clusters(1)
    some = rows[0][1]
    rows += [
        (2001, None, 1),
        (2002, [], 1),
        (2003, [0.0] * 64, 1),
        (2004, [0.0] * 64, 1),
        (2005, [float("nan")] + some[1:], 0),
        (2006, [float("inf")] + some[1:], 0),
        (2007, [None] + some[1:], 0),
        (2008, some, None),
        (2009, some, 0),
        (2009, some, 0),
        (None, some, 0),
        (2010, some[:8], 0),
        (2011, some[:8], 0),
        (2012, [x * 1e30 for x in some], 0),
        (2013, [-x for x in some], 0),
    ]
    compare(spark, rows)


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr("quadrille.llm.common.BLOCK", 5)
    compare(spark, clusters(2, groups=5))


def test_nearest_points():
    """Against all lattice points near the origin."""
    r = np.random.default_rng(3)
    x = r.uniform(-0.6, 0.6, size=(300, 8))
    points = [np.zeros(8), *lattice.STEPS]
    near = lattice.nearest_e8(x)
    best = np.min([((x - p) ** 2).sum(axis=1) for p in points], axis=0)
    assert np.allclose(((x - near) ** 2).sum(axis=1), best)
    doubled = near * 2
    assert (doubled == np.rint(doubled)).all() and (near.sum(axis=1) % 2 == 0).all()
    assert len(lattice.STEPS) == 240 and np.allclose((lattice.STEPS**2).sum(axis=1), 2)


def test_recall_of_the_index():
    """Pairs at a cosine of exactly 0.98 share a cell in some table."""
    r = np.random.default_rng(4)
    x = r.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = r.normal(size=x.shape)
    g -= (g * x).sum(axis=1, keepdims=True) * x
    g /= np.linalg.norm(g, axis=1, keepdims=True)
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * g
    met = np.zeros(len(x), bool)
    for t in range(lattice.TABLES):
        a, b = lattice.cells(x, t, 1), lattice.cells(y, t, 1)
        met |= (a[:, :1] == b).any(axis=1) | (b[:, :1] == a).any(axis=1)
    assert met.mean() > 0.995


@pytest.mark.parametrize("label", [None, "label"])
def test_empty_table(spark, label):
    df = spark.createDataFrame([], SCHEMA)
    assert lattice.near_vectors(df, label_column=label).count() == 0
