"""Trigram indexes of texts, and the trigram queries that regular expressions imply.

A trigram is three neighbouring bytes of the UTF-8 text, with A-Z lower-cased.  A text
that holds a match of an expression holds certain trigrams; ``query_of`` derives them as
a Boolean query, and a text whose trigrams do not satisfy it cannot match.  Lower case on
both sides keeps that true for expressions that ignore the case of ASCII letters.

A query is ``ALL`` (nothing is mandatory), the number of a trigram, or
``("and" | "or", frozenset of queries)``.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable
from re import _constants as sre
from re import _parser

import numpy as np
import pyarrow as pa

from .common import text_offsets

ALL = ("and", frozenset())
#: Strings followed at once, and characters a class may have, before they count as any.
_WIDTH = 24

# --- queries ----------------------------------------------------------------------


def _both(*queries):
    parts = set()
    for q in queries:
        parts |= q[1] if isinstance(q, tuple) and q[0] == "and" else {q}
    return parts.pop() if len(parts) == 1 else ("and", frozenset(parts))


def _either(*queries):
    if ALL in queries:
        return ALL
    parts = set()
    for q in queries:
        parts |= q[1] if isinstance(q, tuple) and q[0] == "or" else {q}
    # what demands all that another part demands, and more, adds nothing
    demands = {q: _demands(q) for q in parts}
    parts = {q for q in parts if not any(demands[o] < demands[q] for o in parts)}
    return parts.pop() if len(parts) == 1 else ("or", frozenset(parts))


def _demands(query) -> frozenset:
    return query[1] if isinstance(query, tuple) and query[0] == "and" else frozenset([query])


def trigrams_of(text: bytes) -> list[int]:
    return [int.from_bytes(text[i : i + 3], "big") for i in range(len(text) - 2)]


def _holding(strings: frozenset[bytes]):
    """The query of texts that hold one of the strings."""
    return _either(*[_both(*trigrams_of(s)) if len(s) > 2 else ALL for s in strings])


class _Part:
    """What is known of all matches of a part of an expression.

    ``exact`` is the set of all matches, or None; every match begins with one of
    ``heads``, ends with one of ``tails`` and satisfies ``query``.
    """

    def __init__(self, exact, heads=None, tails=None, query=ALL):
        if exact is not None:
            heads = tails = exact
            if len(exact) > _WIDTH:
                exact, query = None, _both(query, _holding(heads))
        if exact is None:
            query = _both(query, _holding(heads), _holding(tails))
            heads = _few(frozenset(s[:2] for s in heads))
            tails = _few(frozenset(s[-2:] for s in tails))
        self.exact, self.heads, self.tails, self.query = exact, heads, tails, query

    def then(self, other: _Part) -> _Part:
        if self.exact is not None and other.exact is not None:
            return _Part(_crossed(self.exact, other.exact))
        heads, tails = self.heads, other.tails
        if self.exact is not None:
            heads = _crossed(self.exact, other.heads)
        if other.exact is not None:
            tails = _crossed(self.tails, other.exact)
        between = _holding(_crossed(self.tails, other.heads))
        return _Part(None, heads, tails, _both(self.query, other.query, between))

    def whole_query(self):
        return self.query if self.exact is None else _holding(self.exact)


def _few(strings: frozenset[bytes]) -> frozenset[bytes]:
    return strings if len(strings) <= _WIDTH else _EMPTY


def _crossed(left: frozenset[bytes], right: frozenset[bytes]) -> frozenset[bytes]:
    return frozenset(a + b for a, b in itertools.product(left, right))


_EMPTY = frozenset([b""])
_NOTHING = _Part(_EMPTY)
_ANYTHING = _Part(None, _EMPTY, _EMPTY)


def _folded(code: int) -> bytes:
    text = chr(code)
    return (text.lower() if text.isascii() else text).encode("utf-8", "surrogatepass")


def _of_class(items) -> _Part:
    found: set[bytes] = set()
    for kind, value in items:
        if kind is sre.LITERAL:
            found.add(_folded(value))
        elif kind is sre.RANGE and value[1] - value[0] <= 4 * _WIDTH:
            found.update(map(_folded, range(value[0], value[1] + 1)))
        else:
            return _ANYTHING
    return _Part(frozenset(found)) if found else _ANYTHING


def _one_of(parts: list[_Part]) -> _Part:
    if all(p.exact is not None for p in parts):
        return _Part(frozenset().union(*[p.exact for p in parts]))
    return _Part(
        None,
        frozenset().union(*[p.heads for p in parts]),
        frozenset().union(*[p.tails for p in parts]),
        _either(*[p.whole_query() for p in parts]),
    )


def _repeated(least: int, most, part: _Part) -> _Part:
    if least == 0:
        return _one_of([part, _NOTHING]) if most == 1 else _ANYTHING
    out = _NOTHING
    # a longer chain would only state more of the same trigrams
    for _ in range(min(least, 4)):
        out = out.then(part)
    return out if least == most and least <= 4 else out.then(_ANYTHING).then(
        _Part(None, part.heads, part.tails, part.query)
    )


def _of_sequence(items) -> _Part:
    out = _NOTHING
    for kind, value in items:
        if kind is sre.LITERAL:
            part = _Part(frozenset([_folded(value)]))
        elif kind is sre.IN:
            part = _of_class(value)
        elif kind is sre.BRANCH:
            part = _one_of([_of_sequence(branch) for branch in value[1]])
        elif kind is sre.SUBPATTERN:
            part = _of_sequence(value[-1])
        elif kind is sre.ATOMIC_GROUP:
            part = _of_sequence(value)
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            part = _repeated(value[0], value[1], _of_sequence(value[2]))
        elif kind in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
            part = _NOTHING
        else:  # any character, a negated class, a group again, a condition
            part = _ANYTHING
        out = out.then(part)
    return out


def query_of(pattern: str):
    """The trigram query that every text with a match of ``pattern`` satisfies."""
    flags = re.compile(pattern, re.ASCII).flags
    return _of_sequence(_parser.parse(pattern, flags)).whole_query()


def mentioned(query) -> set[int]:
    if isinstance(query, int):
        return {query}
    return set().union(*map(mentioned, query[1]))


def evaluate(query, posting: Callable, both: Callable, either: Callable):
    """The value of a query other than ``ALL`` from the postings of its trigrams."""
    if isinstance(query, int):
        return posting(query)
    parts = [evaluate(q, posting, both, either) for q in sorted(query[1], key=repr)]
    out = parts[0]
    for part in parts[1:]:
        out = both(out, part) if query[0] == "and" else either(out, part)
    return out


# --- an index ---------------------------------------------------------------------

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32


_STEP = 4 << 20


def _keys(raw: np.ndarray, first: int, ends: np.ndarray, wanted) -> np.ndarray:
    """Distinct numbers ``trigram << 32 | text`` of the bytes from ``first`` on."""
    code = _FOLD[raw]
    code = (code[:-2] << 16) | (code[1:-1] << 8) | code[2:]
    at = np.arange(len(code)) if wanted is None else np.nonzero(wanted[code])[0]
    text = np.searchsorted(ends, at + first, side="right")
    # three bytes that reach into the next text are none of either
    inside = at + first + 2 < ends[text] if len(at) else np.empty(0, bool)
    return np.unique((code[at[inside]].astype(np.int64) << 32) | text[inside])


class Segment:
    """Inverted index of a batch of texts: trigram to the sorted places of its texts.

    With ``wanted`` (a table of 2**24 flags) the index holds these trigrams only.
    """

    def __init__(self, texts: pa.Array, wanted: np.ndarray | None = None):
        self.size = len(texts)
        offsets = text_offsets(texts)
        first, last = int(offsets[0]), int(offsets[-1])
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[first:last] if last > first else b""
        ends = offsets[1:] - first
        # a long text comes in steps, which bounds the memory of each
        steps = [_keys(raw[k : k + _STEP + 2], k, ends, wanted) for k in range(0, len(raw), _STEP)]
        key = np.unique(np.concatenate([np.empty(0, np.int64), *steps]))
        self.text = key & 0xFFFFFFFF
        self.trigrams, self.start = np.unique(key >> 32, return_index=True)
        self.end = np.append(self.start, len(key))[1:]

    def posting(self, trigram: int) -> np.ndarray:
        at = int(np.searchsorted(self.trigrams, trigram))
        if at == len(self.trigrams) or self.trigrams[at] != trigram:
            return np.empty(0, np.int64)
        return self.text[self.start[at] : self.end[at]]

    def candidates(self, query) -> np.ndarray:
        """Sorted places of the texts that satisfy the query."""
        if query == ALL:
            return np.arange(self.size)
        return evaluate(
            query,
            self.posting,
            lambda a, b: np.intersect1d(a, b, assume_unique=True),
            np.union1d,
        )
