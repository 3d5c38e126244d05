import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from llm_cases import awkward, collected, copies, frame, words
from pyspark.sql import functions as F

from quadrille.llm import bag_search

ITEMS = "item_id long, text string, doc_id string, rank string, score string, term string"


def terms(text):
    folded = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(bag_search.TERM, folded)


def brute(rows, items, top=10):
    """Scores of all documents for all items."""
    bags = [Counter(terms(t)) for _, t in rows]
    lengths = [b.total() for b in bags]
    docs, length = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for (doc, _), bag, n in zip(rows, bags, lengths):
            m = 25 + 75 * n * docs // max(length, 1)
            score = 0
            for term in terms(text):
                tf = bag[term]
                if tf:
                    w = math.floor(1000 * math.log((2 * docs + 2) / (2 * df[term] + 1)))
                    score += w * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, -(1 << 63) if doc is None else doc, doc))
        for rank, (score, _, doc) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, doc, -score))
    return Counter(out)


def asked(spark, items):
    return spark.createDataFrame([(*r, "?", "?", "?", "?") for r in items], ITEMS)


def check(spark, rows, items, **options):
    out = bag_search.rank_documents(frame(spark, rows), asked(spark, items), **options)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    mine = Counter(collected(out, "item_id", "rank", "doc_id", "score"))
    assert mine == brute(rows, items, options.get("top", 10))


def queries(seed, count=25):
    r = random.Random(seed)
    return [(k, words(r, r.randint(1, 30), 120)) for k in range(count)]


def corpus(seed):
    r = random.Random(seed)
    rows = [(k, words(r, r.randint(1, 60), 150)) for k in range(150)]
    # copies, and other texts with equal bags
    for k in range(150, 330):
        text = rows[r.randrange(12)][1].split()
        r.shuffle(text)
        rows.append((k, " ".join(text).upper()))
    r.shuffle(rows)
    return rows


def test_scores_and_ties(spark):
    check(spark, corpus(1), queries(2))


def test_awkward_rows(spark):
    items = [
        (1, None),
        (2, ""),
        (3, "--- ///"),
        (4, "one two three one"),
        (4, "one two three one"),
        (None, "unnamed ÜNÏCÖDÉ Ünïcödé"),
        (5, "b　c"),
        (6, "nowhere at all"),
        (7, "same " * 40),
        (8, "w1 w2"),
    ]
    check(spark, awkward() + copies(3), items)


@pytest.mark.parametrize("top", [1, 3])
def test_fewer_places(spark, top):
    check(spark, corpus(4), queries(5, 8), top=top)


def test_blocks_and_large_sums(spark, monkeypatch):
    """Items in several blocks, no broadcast, and sums beyond double precision."""
    monkeypatch.setattr(bag_search, "BLOCK_TERMS", 60)
    monkeypatch.setattr(bag_search, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(bag_search, "_EXACT", 0)
    check(spark, corpus(6), queries(7, 12))


def test_small_steps(spark, monkeypatch):
    monkeypatch.setattr(bag_search, "STEP_BYTES", 300)
    check(spark, corpus(8), queries(9, 8))


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    """Bags are compared, so a hash that all share joins none."""
    original = bag_search.bags_of

    def one_hash(*args):
        return original(*args).withColumn("mark", F.lit(1).cast("bigint"))

    monkeypatch.setattr(bag_search, "bags_of", one_hash)
    check(spark, corpus(10), queries(11, 8))


def test_terms():
    texts = ["A-b", "", "c", "déjà VU.9", "--", "x"]
    found, counts = bag_search.term_arrays(pa.array(texts))
    assert found.to_pylist() == [t for text in texts for t in terms(text)]
    assert counts.tolist() == [len(terms(t)) for t in texts]
    part = pa.array(texts).slice(2, 2)
    assert bag_search.term_arrays(part)[0].to_pylist() == ["c", "déjà", "vu", "9"]


def test_terms_of_both_sides_agree(spark):
    rows = awkward()
    found = frame(spark, rows).select("text", bag_search.terms_of(F.col("text")).alias("t"))
    for row in found.collect():
        assert row["t"] == terms(row["text"])


def test_a_bag_is_scored_once(spark):
    """Copies are one class, whatever their number."""
    rows = [(k, "red green blue" if k % 2 else "Blue, green; red!") for k in range(500)]
    rows += [(1000 + k, "red yellow") for k in range(3)]
    items = bag_search._Items([{"item": 0, "terms": ["red", "green"]}])
    bags = bag_search.bags_of(frame(spark, rows), items, "doc_id", "text")
    assert bags.select("n", "bag").distinct().count() == 2
    check(spark, rows, [(1, "red green"), (2, "yellow")])


def test_empty_tables(spark):
    check(spark, [], queries(1, 3))
    check(spark, corpus(1), [])
    check(spark, [(1, None)], queries(1, 3))
