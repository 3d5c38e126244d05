"""Packing of tokenized documents into sequences of a fixed length.

Documents are cut into windows of the capacity and a rest.  What is packed is not the
documents but the histogram of lengths, which has as many entries as the capacity however
many documents there are.  A window starts with the longest length that remains; a subset
sum over the other remaining lengths, held as bits of one integer, tells which sums can be
reached, and going back through its steps gives the counts of the multiset closest to the
capacity.  That multiset is used for as many windows as its lengths allow.  If it leaves
slack, a longer piece is cut to fill it and its rest returns to the histogram.  What
remains at the end is less than one window; it fills windows of sizes that are powers of
two.  So no sequence needs padding.

The plan then tells each piece its place from its length and its rank among the pieces of
that length.  Ranks come from counts per part of the table and length.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import map_arrow, slices, stored

#: Bytes of text that one step holds as token ids.
STEP_BYTES = 4 << 20
#: Words remembered between steps; beyond that the memory starts anew.
MEMORY = 1_000_000
#: Characters of these words; where words are not set apart a word is a whole text.
MEMORY_CHARS = 8 << 20


# --- the plan ---------------------------------------------------------------------


class Plan:
    """Places of all pieces, for a histogram ``{length: count}``.

    Intervals of ranks of one length share a row: ``first`` is the first rank,
    ``sequence`` the first sequence, ``per`` the pieces in each sequence, ``offset`` the
    place of the first of them, ``take`` the tokens that go there, and ``rest`` the rank
    that the cut-off rest of the first piece has among the pieces of its length.
    """

    FIELDS = ("length", "first", "sequence", "per", "offset", "take", "rest")

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = dict(counts)
        self.used = dict.fromkeys(counts, 0)
        self.sequences = 0
        rows: list[tuple[int, ...]] = []
        total = sum(length * count for length, count in counts.items())
        while total >= capacity:
            total -= capacity * self._fill(capacity, rows)
        for bit in reversed(range(total.bit_length())):
            if total >> bit & 1:
                self._fill(1 << bit, rows, once=True)
        rows.sort()
        columns = zip(*rows) if rows else [()] * len(self.FIELDS)
        for name, column in zip(self.FIELDS, columns):
            setattr(self, name, np.array(column, np.int64))

    def _fill(self, capacity: int, rows: list, once: bool = False) -> int:
        """Windows of one kind; how many of them."""
        chosen, slack = self._closest(capacity)
        cut = None
        if slack:
            spare = (n for n, c in self.left.items() if c > chosen.get(n, 0))
            cut = max(n for n in spare if n > slack)
        needs = dict(chosen)
        if cut:
            needs[cut] = needs.get(cut, 0) + 1
        times = 1 if once else min(self.left[n] // c for n, c in needs.items())
        offset = 0
        for length, per in sorted(chosen.items(), reverse=True):
            rows.append(
                (length, self.used[length], self.sequences, per, offset, length, -1)
            )
            self._use(length, per * times)
            offset += per * length
        if cut:
            rest = cut - slack
            first = self.used.setdefault(rest, 0) + self.left.get(rest, 0)
            if rest == cut:
                raise AssertionError("nothing was cut")
            rows.append((cut, self.used[cut], self.sequences, 1, offset, slack, first))
            self._use(cut, times)
            self.left[rest] = self.left.get(rest, 0) + times
        self.sequences += times
        return times

    def _use(self, length: int, count: int) -> None:
        self.used[length] += count
        self.left[length] -= count
        if not self.left[length]:
            del self.left[length]

    def _closest(self, capacity: int) -> tuple[dict[int, int], int]:
        """The multiset with the largest sum up to the capacity, and its slack."""
        fitting = sorted((n for n in self.left if n <= capacity), reverse=True)
        if not fitting:
            return {}, capacity
        seed = fitting[0]
        gap = capacity - seed
        reach, mask, steps = 1, (1 << (gap + 1)) - 1, []
        for length in fitting:
            if reach >> gap & 1:
                break
            if length > gap:
                continue
            free = min(self.left[length] - (length == seed), gap // length)
            share = 1
            while free > 0:
                share = min(share, free)
                steps.append((length, share, reach))
                reach |= (reach << (length * share)) & mask
                free -= share
                share *= 2
        at = reach.bit_length() - 1
        slack = gap - at
        chosen = {seed: 1}
        for length, share, before in reversed(steps):
            if not before >> at & 1:
                chosen[length] = chosen.get(length, 0) + share
                at -= length * share
        return chosen, slack

    def places(self, length: np.ndarray, rank: np.ndarray) -> Iterator[tuple]:
        """Parts of pieces: ``piece, begin, take, sequence, offset`` as arrays.

        The first arrays hold the first part of each piece, the next those of what was
        cut off, and so on.
        """
        # lengths are at most the capacity and ranks below 2**40
        keys = self.length << 40 | self.first
        piece, begin = np.arange(len(length)), np.zeros(len(length), np.int64)
        while len(piece):
            row = np.searchsorted(keys, length << 40 | rank, side="right") - 1
            nth = rank - self.first[row]
            per = self.per[row]
            take = self.take[row]
            sequence = self.sequence[row] + nth // per
            offset = self.offset[row] + nth % per * length
            yield piece, begin, take, sequence, offset
            (more,) = np.nonzero(self.rest[row] >= 0)
            piece, begin = piece[more], begin[more] + take[more]
            length = length[more] - take[more]
            rank = self.rest[row][more] + nth[more]


# --- tokens -----------------------------------------------------------------------

_SPACE = regex.compile(r"\p{White_Space}+")
_CONTROL = regex.compile("[\x1c-\x1f]")
#: Characters below this one are in composed form and have simple small letters.
_SIMPLE = "\u0250"
#: Marks that make one piece together at the end of a word.
_MARKS = ".,;:!?)]}*#$%&|"


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte: itself if printable, or else a new one."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


class _Numbers(dict):
    """Numbers of words in the order of their first use; 0 is the end of a text."""

    def __init__(self):
        super().__init__({"": 0})
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        number = self[word] = len(self)
        return number


class _Pieces(dict):
    """Ids of pieces."""

    def __init__(self, tokenize):
        super().__init__()
        self.tokenize = tokenize

    def __missing__(self, piece: str) -> list[int]:
        letters = piece
        if not (piece.isascii() and piece.isprintable()):
            letters = piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
        found = self[piece] = [token.id for token in self.tokenize(letters)]
        return found


class WordTokenizer:
    """Ids of texts by a tokenizer, with equal words tokenized once.

    A tokenizer that composes characters, folds white space and case, and then splits by
    a pattern without white space, never joins characters across white space.  Its
    texts fall into words, and simple words into pieces that go to its merges directly.
    Any other tokenizer gets whole texts.
    """

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        # the strings of special tokens are ordinary text in a document
        self.tokenizer.encode_special_tokens = True
        self.split = _word_pattern(json.loads(source))
        self._forget()

    def _forget(self) -> None:
        self.chars = 0
        self.number = _Numbers()
        self.pieces = _Pieces(self.tokenizer.model.tokenize)
        self.ids = np.empty(0, np.int64)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)

    def _learn(self, words: list[str]) -> list[list[int]]:
        self.chars += sum(map(len, words))
        found: list[list[int]] = []
        hard, pieces = [], self.pieces
        for word in words:
            if self.split is None or not (word.isascii() or max(word) < _SIMPLE):
                hard.append(len(found))
                found.append([])
                continue
            small = word.lower()
            core = small.rstrip(_MARKS)
            if core.isalpha():
                ids = pieces[core]
                if len(core) < len(small):
                    ids = ids + pieces[small[len(core) :]]
            else:
                ids = [i for p in self.split.findall(small) for i in pieces[p]]
            found.append(ids)
        encoded = self.tokenizer.encode_batch_fast(
            [words[k] for k in hard], add_special_tokens=False
        )
        for k, e in zip(hard, encoded):
            found[k] = e.ids
        return found

    def _words(self, text: str) -> list[str]:
        if self.split is None:
            return [text] if text else []
        if _CONTROL.search(text):
            return [w for w in _SPACE.split(text) if w]
        return text.split()

    def encode(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end``, and the bounds of the texts."""
        if len(self.number) > MEMORY or self.chars > MEMORY_CHARS:
            self._forget()
        number = self.number
        # the first number is that of the end of a text
        rows = [[0, *map(number.__getitem__, self._words(text))] for text in texts]
        fresh, number.fresh = number.fresh, []
        if fresh:
            found = self._learn(fresh)
            if len(fresh) == len(number) - 1:
                found.insert(0, [end])
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            starts = len(self.ids) + np.cumsum(lengths) - lengths
            flat = np.fromiter(chain.from_iterable(found), np.int64, int(lengths.sum()))
            self.ids = np.concatenate([self.ids, flat])
            self.starts = np.concatenate([self.starts, starts])
            self.lengths = np.concatenate([self.lengths, lengths])
        elif len(number) == 1 and not len(self.ids):
            self.ids, self.starts = np.array([end]), np.array([0])
            self.lengths = np.array([1])
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        chosen = np.fromiter(chain.from_iterable(rows), np.int64, int(sizes.sum()))
        # the end comes last
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        chosen = np.append(chosen[1:], 0)
        lengths = self.lengths[chosen]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[chosen] - (ends - lengths), lengths)
        ids = self.ids[shift + np.arange(len(shift))]
        return ids, np.concatenate([[0], ends])[bounds]


def _word_pattern(spec: dict) -> regex.Pattern | None:
    """The splitting pattern of a tokenizer of the kind described above."""
    steps = (spec.get("normalizer") or {}).get("normalizers") or []
    splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    space = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    known = steps == [{"type": "NFC"}, space, {"type": "Lowercase"}]
    if not known or [s["type"] for s in splits] != ["Split", "ByteLevel"]:
        return None
    pattern = splits[0]["pattern"].get("Regex", "")
    plain = splits[0]["behavior"] == "Removed" and splits[0]["invert"]
    whole = not (splits[1]["add_prefix_space"] or splits[1]["use_regex"])
    # the pieces that the marks at the end of a word make are those of this pattern
    if pattern == _PATTERN and plain and whole:
        return regex.compile(pattern)
    return None


#: The one pattern whose words are taken apart here.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_tokenizers: dict[int, WordTokenizer] = {}


def _pieces(
    documents: DataFrame,
    tokenizer_file: str,
    end_id: int,
    capacity: int,
    id_column: str,
    text_column: str,
) -> DataFrame:
    with open(tokenizer_file, encoding="utf-8") as file:
        source = file.read()
    from tokenizers import Tokenizer

    width = "<u2" if Tokenizer.from_str(source).get_vocab_size() <= 1 << 16 else "<u4"
    shared = documents.sparkSession.sparkContext.broadcast(source)
    key = zlib.crc32(source.encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _tokenizers:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            _tokenizers[key] = WordTokenizer(shared.value)
        part = TaskContext.get().partitionId()
        ranks = np.zeros(capacity + 1, np.int64)
        for whole in batches:
            for batch in slices(whole, 1, STEP_BYTES):
                ids, bounds = _tokenizers[key].encode(batch.column(1).to_pylist(), end_id)
                total = np.diff(bounds)
                cuts = -(-total // capacity)
                doc = np.repeat(np.arange(len(total)), cuts)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                start = nth * capacity
                length = np.minimum(total[doc] - start, capacity)
                rank = np.empty(len(doc), np.int64)
                # stable order: pieces of one length are ranked as they come
                order = np.argsort(length, kind="stable")
                kinds, first, many = np.unique(
                    length[order], return_index=True, return_counts=True
                )
                rank[order] = (
                    np.arange(len(order))
                    - np.repeat(first, many)
                    + np.repeat(ranks[kinds], many)
                )
                ranks[kinds] += many
                at = bounds[doc] + start
                parts = [ids[a : a + n] for a, n in zip(at, length)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(doc)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(total[doc]),
                        pa.array(np.full(len(doc), part, np.int64)),
                        pa.array(rank),
                        pa.array([zlib.crc32(p.astype("<u4")) for p in parts], pa.int64()),
                        pa.array([p.astype(width).tobytes() for p in parts], pa.binary()),
                    ],
                    ["id", "start", "length", "total", "part", "rank", "crc", "ids"],
                )

    rows = documents.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    fields = (
        "id bigint, start bigint, length bigint, total bigint, part bigint, rank bigint,"
        " crc bigint, ids binary"
    )
    return stored(map_arrow(rows, run, fields), "pieces").withColumn(
        "width", F.lit(width)
    )


# --- the operator -----------------------------------------------------------------

_PLACED = (
    "id bigint, start bigint, length bigint, crc bigint, total bigint, part bigint,"
    " whole bigint, rank bigint, begin bigint, sequence bigint, offset bigint"
)


def pack_documents(
    documents: DataFrame,
    tokenizer_file: str,
    capacity: int = 2048,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most ``capacity``.

    One row per piece: the document's id, ``start`` (its ids before the piece),
    ``length``, ``ids_crc32``, ``doc_tokens`` (with the end id), ``sequence_id``,
    ``offset`` and, with ``keep_ids``, ``ids`` as little-endian bytes.  All sequences are
    full but the last few, whose sizes are different powers of two.

    A null text counts as empty: it has the end id only.  Null ids and repeated rows are
    packed like any other row; an empty table gives no rows; columns other than the two
    are not read.  Tokens are written once to the shared folder.  The driver sees the
    histogram of lengths, at most ``capacity`` rows, and broadcasts the plan, whose size
    has a bound that depends on the capacity alone.
    """
    pieces = _pieces(documents, tokenizer_file, end_id, capacity, id_column, text_column)
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")
    )
    histogram = pieces.groupBy("length").count().collect()
    plan = Plan({r["length"]: r["count"] for r in histogram}, capacity)
    shared = documents.sparkSession.sparkContext.broadcast(plan)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {n: batch.column(n).to_numpy() for n in ("length", "rank", "shift")}
            rank = column["rank"] + column["shift"]
            for at, begin, take, sequence, offset in shared.value.places(
                column["length"], rank
            ):
                row = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        row.column("id"),
                        pa.array(row.column("start").to_numpy() + begin),
                        pa.array(take),
                        row.column("crc"),
                        row.column("total"),
                        row.column("part"),
                        row.column("length"),
                        row.column("rank"),
                        pa.array(begin),
                        pa.array(sequence),
                        pa.array(offset),
                    ],
                    [f.split()[0] for f in _PLACED.split(",")],
                )

    skinny = pieces.select("id", "start", "length", "total", "part", "rank", "crc")
    placed = map_arrow(skinny.join(offsets, ["part", "length"]), place, _PLACED)
    columns = [
        F.col("id").alias(id_column),
        "start",
        "length",
        F.col("crc").alias("ids_crc32"),
        F.col("total").alias("doc_tokens"),
        F.col("sequence").alias("sequence_id"),
        "offset",
    ]
    tokens = pieces.select(
        "part", F.col("length").alias("whole"), "rank", F.col("ids").alias("all"), "width"
    )
    if keep_ids:
        return _with_ids(placed.join(tokens, ["part", "whole", "rank"])).select(
            *columns, "ids"
        )
    # only pieces that were cut have ids of their own to digest
    whole = placed.where("length = whole").select(*columns)
    cut = placed.where("length < whole").drop("crc")
    cut = _with_ids(cut.join(tokens, ["part", "whole", "rank"]))
    return whole.unionByName(cut.select(*columns))


def _with_ids(placed: DataFrame) -> DataFrame:
    """``ids`` and ``crc`` of each part of a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = batch.column("width")[0].as_py() if batch.num_rows else "<u4"
            out = []
            for ids, begin, length in zip(
                batch.column("all").to_pylist(),
                batch.column("begin").to_pylist(),
                batch.column("length").to_pylist(),
            ):
                part = np.frombuffer(ids, width)[begin : begin + length]
                out.append(part.astype("<u4").tobytes())
            names = ["id", "start", "length", "total", "sequence", "offset"]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in names],
                    pa.array(list(map(zlib.crc32, out)), pa.int64()),
                    pa.array(out, pa.binary()),
                ],
                [*names, "crc", "ids"],
            )

    fields = (
        "id bigint, start bigint, length bigint, total bigint, sequence bigint,"
        " offset bigint, crc bigint, ids binary"
    )
    return map_arrow(placed, run, fields)
