"""Byte-level BPE: text to token ids by merge ranks, and back.

The distinct pieces of a batch are encoded together.  Pieces of similar length form a
matrix, one row per piece and one column per token, padded at the end.  In each round
every row merges its leftmost pair of least rank; as each row then loses one column, the
matrix stays dense by dropping the merged places, and rows without a pair leave it.
Ranks of pairs come from a hash table in numpy arrays.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices

#: Rows of a matrix have at most so many bytes.  A longer piece would need as many
#: rounds; it is merged in the same order by a heap instead.
MATRIX_WIDTH = 512
#: Bytes of text that one step holds as token ids.
STEP_BYTES = 4 << 20
#: Pieces of text remembered between steps; beyond that the memory starts anew.
MEMORY = 800_000
#: Characters of these pieces; where words are not set apart a piece is a whole text.
MEMORY_CHARS = 16 << 20

_NO_RANK = np.int32(np.iinfo(np.int32).max)


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines)
        return {base64.b64decode(p[0]): int(p[1]) for p in pairs if p}


class PairTable:
    """Rank of the token that two neighbouring tokens make, for arrays of pairs.

    Open addressing: an unused slot ends the search.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.shift = np.int64(max(ranks.values(), default=0)).item().bit_length()
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << self.shift | right)
                    values.append(rank)
        keys = np.array(keys, np.int64)
        self.bits = max(8, (len(keys) * 5).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NO_RANK, np.int32)
        waiting, slots = np.arange(len(keys)), self._slots(keys)
        while len(waiting):
            free = self.keys[slots] == -1
            taken, first = np.unique(slots[free], return_index=True)
            winners = waiting[free][first]
            self.keys[taken] = keys[winners]
            self.values[taken] = np.array(values, np.int32)[winners]
            left = self.keys[slots] != keys[waiting]
            waiting, slots = waiting[left], (slots[left] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << self.shift | right
        slots = self._slots(keys)
        held = self.keys[slots]
        out = np.where(held == keys, self.values[slots], _NO_RANK)
        (waiting,) = np.nonzero((held != keys) & (held != -1))
        while len(waiting):
            slots[waiting] = (slots[waiting] + 1) & self.mask
            held = self.keys[slots[waiting]]
            hit = held == keys[waiting]
            out[waiting[hit]] = self.values[slots[waiting[hit]]]
            waiting = waiting[~hit & (held != -1)]
        return out


class ByteBpe:
    """Encoder and decoder for one vocabulary and one splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.pairs = PairTable(ranks)
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self._forget()

    # --- pieces -------------------------------------------------------------------

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Token ids of each piece."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = np.array([rank], np.int32)
            elif len(piece) > MATRIX_WIDTH:
                out[i] = self._merge_by_heap(piece)
            elif piece:
                # widths grow by a quarter, so that at most a fifth of a row is padding
                n = len(piece)
                step = max(1, 1 << max(0, n.bit_length() - 3))
                buckets.setdefault(-(-n // step) * step, []).append(i)
        for width, rows in buckets.items():
            height = max(1, (1 << 21) // width)
            for start in range(0, len(rows), height):
                self._merge_matrix(pieces, rows[start : start + height], width, out)
        return out

    def _merge_matrix(self, pieces, rows, width, out) -> None:
        raw = b"".join(pieces[i].ljust(width, b"\0") for i in rows)
        lengths = np.fromiter((len(pieces[i]) for i in rows), np.int64, len(rows))
        bytes_ = np.frombuffer(raw, np.uint8).reshape(len(rows), width)
        place = np.arange(width)
        tokens = np.where(place < lengths[:, None], self.single[bytes_], -1)
        rows = np.array(rows)
        ranks = np.full((len(rows), width), _NO_RANK, np.int32)
        real = place[1:] < lengths[:, None]
        ranks[:, :-1][real] = self.pairs.find(tokens[:, :-1][real], tokens[:, 1:][real])
        while True:
            at = ranks.argmin(axis=1)
            every = np.arange(len(rows))
            least = ranks[every, at]
            done = least == _NO_RANK
            if done.any():
                for row, ids, n in zip(rows[done], tokens[done], lengths[done]):
                    out[row] = ids[:n].copy()
                live = ~done
                rows, lengths, at = rows[live], lengths[live], at[live]
                tokens, ranks, least = tokens[live], ranks[live], least[live]
                if not len(rows):
                    return
                used = int(lengths.max())
                tokens, ranks = tokens[:, :used], ranks[:, :used]
                every = np.arange(len(rows))
            # the right token of the pair goes, its left one becomes the merged token
            tokens[every, at] = least
            keep = np.ones(tokens.shape, bool)
            keep[every, at + 1] = False
            shape = (len(rows), tokens.shape[1] - 1)
            tokens, ranks = tokens[keep].reshape(shape), ranks[keep].reshape(shape)
            lengths = lengths - 1
            self._renew(tokens, ranks, lengths, every, at)
            before = at > 0
            self._renew(tokens, ranks, lengths, every[before], at[before] - 1)

    def _renew(self, tokens, ranks, lengths, rows, at) -> None:
        """Rank of the pairs that begin at the given places."""
        paired = at + 1 < lengths[rows]
        ranks[rows[~paired], at[~paired]] = _NO_RANK
        rows, at = rows[paired], at[paired]
        ranks[rows, at] = self.pairs.find(tokens[rows, at], tokens[rows, at + 1])

    def _merge_by_heap(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece; stale heap entries are passed over."""
        tokens = self.single[np.frombuffer(piece, np.uint8)]
        found = self.pairs.find(tokens[:-1], tokens[1:])
        rank_at = dict(enumerate(found.tolist()))
        heap = [(r, i) for i, r in rank_at.items() if r != _NO_RANK]
        heapq.heapify(heap)
        token, last = tokens.tolist(), len(tokens)
        after, before = list(range(1, last + 1)), list(range(-1, last - 1))
        while heap:
            rank, i = heapq.heappop(heap)
            if rank_at.get(i) != rank:
                continue
            gone = after[i]
            token[i], token[gone], after[i] = rank, -1, after[gone]
            rank_at.pop(gone, None)
            if after[i] < last:
                before[after[i]] = i
            for start in (i, before[i]):
                rank_at.pop(start, None)
                if start >= 0 and after[start] < last:
                    pair = self.ranks.get(
                        self.tokens[token[start]] + self.tokens[token[after[start]]]
                    )
                    if pair is not None:
                        rank_at[start] = pair
                        heapq.heappush(heap, (pair, start))
        return np.array([t for t in token if t >= 0], np.int32)

    # --- texts --------------------------------------------------------------------

    def _forget(self) -> None:
        self._chars = 0
        self._number: dict[str, int] = {}
        self._spaced: set[int] = set()
        self._ids = np.empty(0, np.int32)
        self._starts = np.empty(0, np.int64)
        self._lengths = np.empty(0, np.int64)

    def _learn(self, chunks: list[str]) -> None:
        """Encode chunks not met before and remember them."""
        self._chars += sum(map(len, chunks))
        owner, pieces = [], {}
        for i, chunk in enumerate(chunks):
            if not _INKED(chunk):
                self._spaced.add(len(self._starts) + i)
            for piece in self.pattern.findall(chunk):
                owner.append((i, pieces.setdefault(piece, len(pieces))))
        encoded = self.encode_pieces([p.encode() for p in pieces])
        parts = [encoded[p] for _, p in owner]
        lengths = np.zeros(len(chunks), np.int64)
        np.add.at(
            lengths,
            np.array([i for i, _ in owner], np.int64),
            np.array([len(p) for p in parts], np.int64),
        )
        starts = len(self._ids) + np.cumsum(lengths) - lengths
        self._ids = np.concatenate([self._ids, *parts])
        self._starts = np.concatenate([self._starts, starts])
        self._lengths = np.concatenate([self._lengths, lengths])

    def encode(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each.

        A single space between two characters that are no white space always begins a
        match of a pattern of this family, so a text falls into chunks there and equal
        chunks are encoded once.  Other texts are split by the pattern as a whole.
        """
        if len(self._number) > MEMORY or self._chars > MEMORY_CHARS:
            self._forget()
        number, fresh, known = self._number, [], len(self._number)

        def numbers(chunks: list[str]) -> list[int]:
            out = list(map(number.get, chunks))
            if None in out:
                for i, chunk in enumerate(chunks):
                    if out[i] is None:
                        out[i] = number.setdefault(chunk, len(number))
                        if out[i] == known + len(fresh):
                            fresh.append(chunk)
            return out

        texts = list(texts)
        rows = []
        for text in texts:
            head, *rest = text.split(" ")
            rows.append(numbers([head, *map(" ".__add__, rest)]) if text else [])
        if fresh:
            self._learn(fresh)
            fresh, known = [], len(number)
        for i, (text, row) in enumerate(zip(texts, rows)):
            if len(row) > 1 and not self._spaced.isdisjoint(row):
                rows[i] = numbers(self.pattern.findall(text))
        if fresh:
            self._learn(fresh)
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.fromiter((n for row in rows for n in row), np.int64, int(sizes.sum()))
        lengths = self._lengths[flat]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        shift = np.repeat(self._starts[flat] - (ends - lengths), lengths)
        ids = self._ids[shift + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
        return ids, np.diff(bounds)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


#: Whether a chunk, without the space before it, begins and ends with no white space.
_INKED = regex.compile(r" ?\S(?:.*\S)?", regex.DOTALL).fullmatch
_codecs: dict[str, ByteBpe] = {}


def codec(key: str, ranks: dict[bytes, int], pattern: str) -> ByteBpe:
    """The codec of this worker process, built once."""
    if key not in _codecs:
        _codecs[key] = ByteBpe(ranks, pattern)
    return _codecs[key]


def encode_documents(
    documents: DataFrame,
    rank_file: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """Token ids of each text, and the digests of the ids and of the decoded bytes.

    One row per input row: the id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``
    (lowercase hex; ids as little-endian unsigned 32-bit integers) and, with
    ``keep_ids``, ``ids`` (array<int>).  Other columns are not read, so their names
    cannot clash.  A null text counts as empty and has no tokens; null ids and repeated
    rows stay as they are; an empty table gives no rows.  A vocabulary without a token for
    some byte is refused.  The rank file is read by the driver; the table is bounded by
    the size of the vocabulary.
    """
    ranks = read_ranks(rank_file)
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("The vocabulary lacks single bytes, so texts could be lost.")
    shared = documents.sparkSession.sparkContext.broadcast(ranks)
    key = hashlib.sha256(
        repr((pattern, len(ranks), sorted(ranks.items())[:: len(ranks) // 64])).encode()
    ).hexdigest()
    fields = "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        fields += ", ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(key, shared.value, pattern)
        for whole in batches:
            for batch in slices(whole, 1, STEP_BYTES):
                ids, counts = bpe.encode(batch.column(1).to_pylist())
                ends = np.cumsum(counts)
                rows = [ids[e - n : e] for e, n in zip(ends, counts)]
                columns = [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    [hashlib.sha256(r.astype("<u4")).hexdigest() for r in rows],
                    [hashlib.sha256(bpe.decode(r)).hexdigest() for r in rows],
                ]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    bounds = np.concatenate([[0], ends]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(bounds, pa.array(ids)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(list(map(_array, columns)), names)

    rows = documents.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    return map_arrow(rows, run, fields).withColumnRenamed("id", id_column)


def decode_tokens(
    tokens: DataFrame, rank_file: str, id_column: str = "doc_id", ids_column: str = "ids"
) -> DataFrame:
    """Bytes of each row of token ids: the id and ``bytes``.

    Null stands for a null list and for a list with a null or an id outside the
    vocabulary; an empty list gives no bytes.
    """
    ranks = read_ranks(rank_file)
    shared = tokens.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {rank: token for token, rank in shared.value.items()}
        for batch in batches:
            out = []
            for ids in batch.column(1).to_pylist():
                parts = None if ids is None else [known.get(i) for i in ids]
                bad = parts is None or None in parts
                out.append(None if bad else b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary())], ["id", "bytes"]
            )

    rows = tokens.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(ids_column).alias("ids")
    )
    out = map_arrow(rows, run, "id bigint, bytes binary")
    return out.withColumnRenamed("id", id_column)


def _array(values):
    if isinstance(values, pa.Array):
        return values
    return pa.array(values, pa.string())
