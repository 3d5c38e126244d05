"""Removal of passages that occur earlier in the corpus.

Passages are windows of a number of words.  Windows are found level by level: short ones
first, and only places whose short windows are repeated are looked at with windows twice
as long, until the length asked for is reached or no place is left.  At the first level
each long window is stood for by the short window in it whose hash is least: equal long
windows have equal ones, so a window whose least short window is unique is unique.

Windows travel as arrays of hashes and places, dealt by the hash.  Equal windows of one
slice of the table are settled there, so a window that a third of all texts hold sends one
entry per slice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, map_groups, named, shuffle_width, slices, text_id
from .words import longer, sliding, window_hashes, within, word_hashes

#: Length of the windows of the first level, in words.
SHORTEST = 10
#: Bytes of text hashed at once.
STEP_BYTES = 4 << 20
#: Groups of documents per shuffle partition.  A group is held in memory, and each sends
#: one row of entries to every partition, so there are not many more than partitions.
GROUPS = 4

_ENTRIES = "bucket int, hashes binary, ids binary, starts binary"
_PLACES = "bucket int, ids binary, starts binary"

_NONE = np.uint64(np.iinfo(np.uint64).max)


def levels(window: int) -> list[int]:
    """Lengths from the shortest to the window, each at most twice the one before."""
    out = [min(SHORTEST, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


class _Slice:
    """Windows of some texts at one level."""

    def __init__(self, texts: pa.Array, ids: np.ndarray):
        self.words, self.bounds = word_hashes(texts)
        self.ids = ids
        self.count = len(self.words)
        self.text = np.repeat(np.arange(len(ids)), np.diff(self.bounds))

    def hashes(self, length: int) -> np.ndarray:
        """Hash of the window that begins at each word."""
        if self.count < length:
            return np.empty(0, np.uint64)
        return window_hashes(self.words, length)

    def least(self, short: np.ndarray, length: int, window: int):
        """Least hash of the short windows in each long window that lies in one text."""
        width = window - length + 1
        if len(short) < width:
            return np.empty(0, np.uint64), np.empty(0, bool)
        least = sliding(short, width, np.minimum)
        return least, within(self.bounds, window, len(least))

    def chosen(self, length: int, window: int) -> np.ndarray:
        """Places of short windows that are the least of some long window."""
        short = self.hashes(length)
        least, inside = self.least(short, length, window)
        width = window - length + 1
        spread = np.zeros(len(least) + 2 * (width - 1), np.uint64)
        spread[width - 1 : width - 1 + len(least)] = np.where(inside, least, 0)
        if not len(least):
            return np.empty(0, np.int64)
        most = sliding(spread, width, np.maximum)
        return np.nonzero((most == short) & (most > 0))[0]

    def places(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text = self.text[at]
        return self.ids[text], (at - self.bounds[text]).astype(np.int32)

    def marked(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Which words are among the places, given by document id and start."""
        marks = np.zeros(self.count, bool)
        order = np.argsort(ids, kind="stable")
        ids, starts = ids[order], starts[order]
        low = np.searchsorted(ids, self.ids, side="left")
        high = np.searchsorted(ids, self.ids, side="right")
        lengths = np.diff(self.bounds)
        for text in np.nonzero(high > low)[0]:
            own = starts[low[text] : high[text]]
            marks[self.bounds[text] + own[own < lengths[text]]] = True
        return marks


def _entries(hashes, ids, starts, buckets, last: bool) -> Iterator[pa.RecordBatch]:
    """Entries for the buckets of the hashes, and places that are settled here.

    At the last level the settled places are those after the first of their window; at
    earlier levels all places of a window that is repeated here, and an entry without a
    place (start -1) tells of it.
    """
    order = np.lexsort((starts, ids, hashes))
    hashes, ids, starts = hashes[order], ids[order], starts[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = hashes[1:] != hashes[:-1]
    group = np.cumsum(fresh) - 1
    (first,) = np.nonzero(fresh)
    if last:
        # a repeated row stands at the same place as the first and is not after it
        settled = (ids != ids[first][group]) | (starts != starts[first][group])
        sent = fresh
    else:
        settled = np.bincount(group, minlength=len(first))[group] > 1
        sent = fresh
        starts = starts.copy()
    settled_ids, settled_starts = ids[settled], starts[settled]
    if not last:
        starts[settled] = -1
    out = []
    if len(settled_ids):
        spread = int(settled_ids[0] % buckets)
        out.append((spread, b"", settled_ids.tobytes(), settled_starts.tobytes()))
    hashes, ids, starts = hashes[sent], ids[sent], starts[sent]
    # high bits tell the bucket, so that inside one all bits but these tell windows apart
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(int)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.nonzero(np.diff(cuts))[0].tolist():
        rows = order[cuts[b] : cuts[b + 1]]
        out.append((b, hashes[rows].tobytes(), ids[rows].tobytes(), starts[rows].tobytes()))
    if out:
        yield _batch(out, ("bucket", "hashes", "ids", "starts"))


def _batch(rows: list[tuple], names: Sequence[str]) -> pa.RecordBatch:
    kinds = [pa.int32()] + [pa.binary()] * (len(names) - 1)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], list(names)
    )


def _read(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _settle(entries: DataFrame, groups: int, last: bool, partitions: int) -> DataFrame:
    """Places of windows that are repeated, or at the last level not the first ones."""

    def run(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ends = np.append(starts[1:], rows.num_rows)
        for begin, end in zip(starts.tolist(), ends.tolist()):
            part = rows.slice(begin, end - begin)
            sent = pa.compute.greater(pa.compute.binary_length(part["hashes"]), 0)
            done = part.filter(pa.compute.invert(sent))
            part = part.filter(sent)
            hashes = _read(part["hashes"], np.uint64)
            ids, at = _read(part["ids"], np.int64), _read(part["starts"], np.int32)
            order = np.lexsort((at, ids, hashes))
            hashes, ids, at = hashes[order], ids[order], at[order]
            fresh = np.ones(len(hashes), bool)
            fresh[1:] = hashes[1:] != hashes[:-1]
            group = np.cumsum(fresh) - 1
            if last:
                (first,) = np.nonzero(fresh)
                found = (ids != ids[first][group]) | (at != at[first][group])
            else:
                weight = np.where(at < 0, 2.0, 1.0)
                found = (np.bincount(group, weight)[group] > 1) & (at >= 0)
            ids = np.concatenate([ids[found], _read(done["ids"], np.int64)])
            at = np.concatenate([at[found], _read(done["starts"], np.int32)])
            bucket = ids % groups
            order = np.lexsort((at, ids, bucket))
            bucket, ids, at = bucket[order], ids[order], at[order]
            cuts = np.searchsorted(bucket, np.arange(groups + 1))
            out = [
                (b, ids[cuts[b] : cuts[b + 1]].tobytes(), at[cuts[b] : cuts[b + 1]].tobytes())
                for b in np.nonzero(np.diff(cuts))[0].tolist()
            ]
            if out:
                yield _batch(out, ("bucket", "ids", "starts"))

    return map_groups(entries, ["bucket"], run, _PLACES, partitions)


def _prime(least: int) -> int:
    n = least
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _step_slices(table: pa.Table) -> Iterator[pa.RecordBatch]:
    for batch in table.to_batches():
        yield from slices(batch, 1, STEP_BYTES)


def drop_repeated_passages(
    documents: DataFrame,
    window: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: Sequence[str] = (),
    keep_text: bool = False,
) -> DataFrame:
    """Each text without the words of windows that also begin earlier in the corpus.

    Earlier means in a document with a smaller id, or in the same document at an earlier
    word.  Windows are judged on the input, not on what is left of it.  One row per input
    row: the id, ``n_words``, ``n_removed``, ``kept_sha256`` of the kept words joined by
    single spaces, with ``keep_text`` those words as ``kept_text`` (the text as it was if
    nothing is removed), and the columns named in ``carry`` in a struct ``row``.

    A null text has no words (its ``kept_text`` is null); a text shorter than the window
    keeps all.  Rows that share an id are one document: a window is not earlier than
    itself in a repeated row.  Rows with a null id come first and are told apart by their
    text.  An empty table gives no rows.

    The table is read once per level and once for the result, and shuffled by document
    once, as the passes share that exchange.
    """
    if window < 1:
        raise ValueError("A window has at least one word.")
    spark = documents.sparkSession
    partitions = shuffle_width(spark)
    buckets = partitions
    groups = _prime(partitions * GROUPS)
    rows = documents.select(
        text_id(id_column, text_column).alias("id"),
        F.col(text_column).alias("text"),
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []),
    ).withColumn("bucket", F.pmod("id", F.lit(groups)).cast("int"))
    lengths = levels(window)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, STEP_BYTES):
                part = _Slice(batch.column(1), batch.column(0).to_numpy())
                if len(lengths) == 1:
                    hashes = part.hashes(window)
                    (at,) = np.nonzero(within(part.bounds, window, len(hashes)))
                else:
                    hashes = part.hashes(lengths[0])
                    at = part.chosen(lengths[0], lengths[1])
                yield from _entries(
                    hashes[at], *part.places(at), buckets, len(lengths) == 1
                )

    plain = rows.select("id", F.coalesce("text", F.lit("")).alias("text"))
    found = _settle(
        map_arrow(plain, first, _ENTRIES), groups, len(lengths) == 1, partitions
    )
    keyed = rows.select(
        "id", F.coalesce("text", F.lit("")).alias("text"), "bucket"
    ).groupBy("bucket")
    for level in range(1, len(lengths)):
        entries = keyed.cogroup(found.groupBy("bucket")).applyInArrow(
            _extension(lengths, level, buckets), _ENTRIES
        )
        found = _settle(entries, groups, level == len(lengths) - 1, partitions)

    fields = "id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    if keep_text:
        fields += ", kept_text string"
    return _result(
        rows, keyed, found, window, fields, id_column, bool(carry), keep_text
    )


def _extension(lengths: list[int], level: int, buckets: int):
    """Entries of one level at the places that the level before has left."""
    before, length = lengths[level - 1], lengths[level]
    last = level == len(lengths) - 1

    def run(texts: pa.Table, places: pa.Table) -> pa.Table:
        ids, starts = _read(places["ids"], np.int64), _read(places["starts"], np.int32)
        out = []
        for batch in _step_slices(texts) if len(ids) else ():
            part = _Slice(batch.column(1), batch.column(0).to_numpy())
            short = part.hashes(before)
            marks = part.marked(ids, starts)[: len(short)]
            if not marks.any():
                continue
            if level == 1:
                least, inside = part.least(short, before, length)
                left = np.where(marks, short, _NONE)
                left = sliding(left, length - before + 1, np.minimum)
                (at,) = np.nonzero(inside & (left == least))
            else:
                shift = length - before
                both = marks[: max(0, len(marks) - shift)] & marks[shift:]
                both &= within(part.bounds, length, len(both))
                (at,) = np.nonzero(both)
            hashes = longer(short, before, length)
            out += _entries(hashes[at], *part.places(at), buckets, last)
        schema = pa.schema(
            [
                ("bucket", pa.int32()),
                ("hashes", pa.binary()),
                ("ids", pa.binary()),
                ("starts", pa.binary()),
            ]
        )
        return pa.Table.from_batches(out, schema)

    return run


def _result(rows, keyed, found, window, fields, id_column, carry, keep_text) -> DataFrame:
    def run(texts: pa.Table, places: pa.Table) -> pa.Table:
        ids, starts = _read(places["ids"], np.int64), _read(places["starts"], np.int32)
        order = np.lexsort((starts, ids))
        ids, starts = ids[order], starts[order]
        own = texts["id"].to_numpy()
        low = np.searchsorted(ids, own, side="left")
        high = np.searchsorted(ids, own, side="right")
        totals, removed, digests, kept_texts = [], [], [], []
        for text, a, b in zip(texts["text"], low.tolist(), high.tolist()):
            words = text.as_buffer().to_pybytes().split()
            n = len(words)
            if a < b and n >= window:
                edges = np.zeros(n + 1, np.int64)
                at = starts[a:b]
                at = np.unique(at[at <= n - window])
                edges[at] += 1
                edges[at + window] -= 1
                covered = np.cumsum(edges[:-1]) > 0
                words = [w for w, c in zip(words, covered.tolist()) if not c]
            kept = b" ".join(words)
            totals.append(n)
            removed.append(n - len(words))
            digests.append(hashlib.sha256(kept).hexdigest())
            if keep_text:
                same = len(words) == n
                kept_texts.append(text.as_py() if same else kept.decode())
        columns = [
            texts["id"],
            pa.array(totals, pa.int64()),
            pa.array(removed, pa.int64()),
            pa.array(digests, pa.string()),
        ]
        names = ["id", "n_words", "n_removed", "kept_sha256"]
        if keep_text:
            columns.append(pa.array(kept_texts, pa.string()))
            names.append("kept_text")
        if carry:
            columns += [texts["row"], texts["text_null"]]
            names += ["row", "text_null"]
        return pa.Table.from_arrays(columns, names)

    if carry:
        kind = rows.schema["row"].dataType.simpleString()
        fields += f", row {kind}, text_null boolean"
        keyed = rows.select(
            "id",
            F.coalesce("text", F.lit("")).alias("text"),
            "bucket",
            "row",
            F.col("text").isNull().alias("text_null"),
        ).groupBy("bucket")
    out = keyed.cogroup(found.groupBy("bucket")).applyInArrow(run, fields)
    if carry and keep_text:
        out = out.withColumn("kept_text", F.when(~F.col("text_null"), F.col("kept_text")))
    out = out.withColumn("id", named("id")).drop("text_null")
    return out.withColumnRenamed("id", id_column)
