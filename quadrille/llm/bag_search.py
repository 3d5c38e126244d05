"""Ranked lexical search that scores equal bags of terms once.

Documents are restricted to the vocabulary of the items.  Those with the same term counts
in it and the same length number form a class: the rows are brought together by the hash
of the counts, and equal bytes, not equal hashes, make a class.  Every class is scored
once for every item that shares a term with it.  The best classes of an item are then
expanded to their members by ascending id.

Items are taken in blocks of bounded size, so that what is collected and broadcast (the
vocabulary of a block, its items and the weights of its terms) has a bound too; documents
are read once per block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, named, slices, stored, text_id, text_offsets

#: What a term consists of: ASCII letters and digits, and all other characters.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Terms, repeats included, of the items of a block.
BLOCK_TERMS = 2_000_000
#: Bytes of texts, or of bags, in one step of a task.
STEP_BYTES = 4 << 20
#: Bytes of bags that may be broadcast.
BROADCAST_BYTES = 64 << 20
#: Sums below it are exact in double precision.
_EXACT = 1 << 53

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_INK = np.zeros(256, bool)
_INK[128:] = True
_INK[48:58] = _INK[65:91] = _INK[97:123] = True


def terms_of(text: Column) -> Column:
    """Terms of a text, with A-Z in lower case; none for null."""
    folded = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))


def term_arrays(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts one after the other, and the number of terms of each text."""
    offsets = text_offsets(texts)
    first, last = int(offsets[0]), int(offsets[-1])
    if first == last:
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[first:last]
    ink = _INK[data]
    begins = ink.copy()
    begins[1:] &= ~ink[:-1]
    # texts lie next to each other with nothing between them
    inner = offsets[1:-1] - first
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] = ink[inner]
    before = np.concatenate([[0], np.cumsum(begins)])
    counts = np.diff(before[offsets - first])
    letters = _FOLD[data[ink]]
    starts = (np.cumsum(ink) - 1)[begins]
    bounds = np.append(starts, len(letters)).astype(np.int32)
    terms = pa.Array.from_buffers(
        pa.string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)]
    )
    return terms, counts


class _Items:
    """The items of a block: their vocabulary, and the terms of each as numbers."""

    def __init__(self, rows):
        self.number = [row["item"] for row in rows]
        self.terms = sorted({t for row in rows for t in row["terms"]})
        place = {t: k for k, t in enumerate(self.terms)}
        self.own = [
            np.unique(np.array([place[t] for t in row["terms"]], np.int64), return_counts=True)
            for row in rows
        ]


def bags_of(documents: DataFrame, items: _Items, id_column: str, text_column: str) -> DataFrame:
    """``id, n, bag, mark``: terms of each text, its counts in the vocabulary, their hash.

    A bag is a row of pairs of little-endian numbers, term and count, by term.
    """
    shared = documents.sparkSession.sparkContext.broadcast(items.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: k for k, t in enumerate(shared.value)}
        for whole in batches:
            for batch in slices(whole, 1, STEP_BYTES):
                terms, counts = term_arrays(batch.column(1))
                coded = terms.dictionary_encode()
                known = [place.get(t, -1) for t in coded.dictionary.to_pylist()]
                term = np.array([*known, -1], np.int64)[coded.indices.to_numpy()]
                text = np.repeat(np.arange(len(counts)), counts)
                inside = term >= 0
                key, tf = np.unique(
                    text[inside] * len(place) + term[inside], return_counts=True
                )
                pairs = np.empty((len(key), 2), "<u4")
                pairs[:, 0], pairs[:, 1] = key % max(len(place), 1), tf
                bounds = np.searchsorted(key, np.arange(len(counts) + 1) * len(place)) * 8
                bags = pa.Array.from_buffers(
                    pa.binary(),
                    len(counts),
                    [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(pairs)],
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts), bags], ["id", "n", "bag"]
                )

    rows = documents.select(
        text_id(id_column, text_column).alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    bags = map_arrow(rows, run, "id bigint, n bigint, bag binary")
    return bags.withColumn("mark", F.xxhash64("bag"))


def _entries(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of all pairs of an array of bags."""
    offsets = text_offsets(bags)
    pairs = np.frombuffer(bags.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    pairs = pairs.view("<u4").reshape(-1, 2).astype(np.int64)
    rows = np.repeat(np.arange(len(bags)), np.diff(offsets) // 8)
    return rows, pairs[:, 0], pairs[:, 1]


def _document_frequencies(classes: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for whole in batches:
            for batch in slices(whole, 0, STEP_BYTES):
                rows, term, _ = _entries(batch.column(0))
                np.add.at(total, term, batch.column(1).to_numpy()[rows])
        (found,) = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(total[found])], ["term", "df"]
        )

    counted = map_arrow(classes.select("bag", "size"), run, "term bigint, df bigint")
    out = np.zeros(terms, np.int64)
    # as many rows as the vocabulary of a block has terms
    for row in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row["term"]] = row["df"]
    return out


class _Best:
    """The best classes of an item so far, by score and then by the least id."""

    def __init__(self, top: int):
        self.top = top
        self.rows = np.empty((0, 3), np.int64)

    def add(self, score: np.ndarray, first: np.ndarray, number: np.ndarray) -> None:
        (found,) = np.nonzero(score > 0)
        if len(found) > self.top:
            least = np.partition(score[found], -self.top)[-self.top]
            found = found[score[found] >= least]
        fresh = np.stack([score[found], first[found], number[found]], axis=1)
        rows = np.concatenate([self.rows, fresh])
        order = np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0]))
        self.rows = rows[order[: self.top]]


def _best_classes(
    classes: DataFrame, items: _Items, weights: np.ndarray, top: int
) -> DataFrame:
    """``item, class, score, first``: the best classes of each item in each task."""
    # the largest score an item can give decides how sums are taken
    limits = [int((weights[t] * 1_000_000 * n).sum()) for t, n in items.own]
    shared = classes.sparkSession.sparkContext.broadcast(
        (items.number, items.own, weights, limits)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, own, weight, limit = shared.value
        best = [_Best(top) for _ in own]
        for whole in batches:
            for batch in slices(whole, 3, STEP_BYTES):
                number, first, m = (batch.column(c).to_numpy() for c in range(3))
                row, term, tf = _entries(batch.column(3))
                gain = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
                order = np.argsort(term, kind="stable")
                row, gain = row[order], gain[order]
                bounds = np.searchsorted(term[order], np.arange(len(weight) + 1))
                for k, (terms, repeats) in enumerate(own):
                    starts, ends = bounds[terms], bounds[terms + 1]
                    spans = [slice(a, b) for a, b in zip(starts, ends)]
                    if not spans or not (ends > starts).any():
                        continue
                    at = np.concatenate([row[s] for s in spans])
                    plus = np.concatenate([gain[s] for s in spans])
                    plus = plus * np.repeat(repeats, ends - starts)
                    if limit[k] < _EXACT:
                        score = np.bincount(at, plus, len(number)).astype(np.int64)
                    else:
                        score = np.zeros(len(number), np.int64)
                        np.add.at(score, at, plus)
                    best[k].add(score, first, number)
        rows = np.concatenate([b.rows for b in best] or [np.empty((0, 3), np.int64)])
        item = np.repeat(np.array(numbers, np.int64), [len(b.rows) for b in best])
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), *[pa.array(rows[:, c]) for c in (2, 0, 1)]],
            ["item", "class", "score", "first"],
        )

    schema = "item bigint, class bigint, score bigint, first bigint"
    return map_arrow(classes.select("class", "first", "m", "bag"), run, schema)


def _ranked(rows: DataFrame, group: str, top: int, *order: Column) -> DataFrame:
    """The first rows of each group, with their rank; tasks rank before the shuffle."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn("rank", place).where(F.col("rank") <= top)


def _search_block(
    documents: DataFrame, items: _Items, top: int, id_column: str, text_column: str
) -> DataFrame:
    """``item, rank, id, score`` for the items of a block."""
    bags = stored(bags_of(documents, items, id_column, text_column), "bags")
    total = bags.agg(
        F.count_if(F.col("n") > 0).alias("texts"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")
    ).first()
    texts, length = total["texts"], max(total["terms"], 1)
    # the product can exceed 64 bits, its quotient not
    m = F.expr(f"25 + cast(n AS decimal(18, 0)) * {75 * texts} div {length}")
    bags = bags.where(F.octet_length("bag") > 0).select("id", m.alias("m"), "mark", "bag")
    grouped = bags.groupBy("mark", "m", "bag").agg(
        F.min("id").alias("first"), F.count("*").alias("size")
    )
    classes = stored(grouped.withColumn("class", F.monotonically_increasing_id()), "bag_classes")
    df = _document_frequencies(classes, len(items.terms))
    weights = np.array(
        [math.floor(1000 * math.log((2 * texts + 2) / (2 * n + 1))) for n in df.tolist()], np.int64
    )
    found = _best_classes(classes, items, weights, top)
    best = _ranked(found, "item", top, F.desc("score"), F.asc("first"), F.asc("class"))
    best = stored(best.select("item", "class", "score"), "best_classes")
    # a class that is among the best by its least member can fill all places
    chosen = stored(
        classes.select("class", "mark", "m", "bag").join(
            best.select("class").distinct(), "class", "left_semi"
        ),
        "chosen_classes",
    )
    weight = chosen.agg(F.sum(F.octet_length("bag") + 64)).first()[0] or 0
    small = weight <= BROADCAST_BYTES
    members = bags.join(F.broadcast(chosen) if small else chosen, ["mark", "m", "bag"])
    members = _ranked(members.select("class", "id"), "class", top, F.asc("id"))
    listed = best.join(members.select("class", "id"), "class")
    ranked = _ranked(listed, "item", top, F.desc("score"), F.asc("id"))
    return ranked.select("item", "rank", "id", "score")


def rank_documents(
    documents: DataFrame,
    items: DataFrame,
    top: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The ``top`` documents with the highest scores for each item.

    One row per item and place: the item's id, ``rank`` (from 1), the document's id and
    ``score``; equal scores by ascending id, scores of 0 not at all.  A null text has no
    terms; an item without terms, or with none that a document holds, has no rows.  A
    null document id counts as smaller than the others and is ordered by its text.  Every
    row of ``items`` is an item of its own and every row of ``documents`` a document, also
    a repeated one.  Other columns are not read, so their names cannot clash.  An empty
    table on either side gives no rows.
    """
    asked = stored(
        items.select(F.col(item_column).alias("name"), terms_of(F.col(item_text)).alias("terms"))
        .where(F.size("terms") > 0)
        .withColumn("item", F.monotonically_increasing_id()),
        "items",
    )
    terms = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-terms // BLOCK_TERMS)
    block = F.pmod(F.xxhash64("item"), F.lit(max(blocks, 1)))
    found = []
    for number in range(blocks):
        rows = asked.where(block == number).select("item", "terms").collect()
        found.append(_search_block(documents, _Items(rows), top, id_column, text_column))
    if not found:
        nothing = "item bigint, rank int, id bigint, score bigint"
        found = [asked.sparkSession.createDataFrame([], nothing)]
    ranked = reduce(DataFrame.union, found)
    return ranked.join(asked.select("item", "name"), "item").select(
        F.col("name").alias(item_column), "rank", named("id").alias(id_column), "score"
    )
