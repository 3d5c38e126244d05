"""Hashes of words and of windows of words, for whole batches of texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import WORD_SPACE, text_offsets

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[list(WORD_SPACE.encode())] = True
_BYTES = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)

#: Powers of the base and of its inverse, as long as the longest slice so far.
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> list[np.ndarray]:
    if len(_powers[0]) < size:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table, step = np.ones(1, np.uint64), base
            while len(table) < size:
                table = np.concatenate([table, table * np.uint64(step)])
                step = step * step & _MASK
            _powers[k] = table
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts, and the bounds of the texts among them.

    Words lie between ASCII white space.  A word's bytes are the digits of a number in
    modular arithmetic, taken from prefix sums over the whole slice, and then mixed.
    """
    offsets = text_offsets(texts)
    first, last = int(offsets[0]), int(offsets[-1])
    offsets = offsets - first
    if first == last:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[first:last]
    ink = ~_SPACE[data]
    starts_here, ends_here = ink.copy(), ink.copy()
    starts_here[1:] &= ~ink[:-1]
    ends_here[:-1] &= ~ink[1:]
    # texts lie next to each other without white space between them
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    starts_here[inner] = ink[inner]
    ends_here[inner - 1] = ink[inner - 1]
    starts, ends = np.nonzero(starts_here)[0], np.nonzero(ends_here)[0] + 1
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * power[: len(data)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * inverse[starts])
    return hashes, np.searchsorted(starts, offsets, side="left")


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(left * np.uint64(0xD1342543DE82EF95) + right)


def longer(hashes: np.ndarray, length: int, target: int) -> np.ndarray:
    """Hashes of windows of ``target`` words from those of ``length`` words.

    ``target`` is at most twice ``length``; the last places have no window.
    """
    shift = target - length
    return joined(hashes[: len(hashes) - shift], hashes[shift:])


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows, also of those that reach from one text into the next."""
    hashes, have = words, 1
    while have < length and len(words) >= length:
        target = min(2 * have, length)
        hashes, have = longer(hashes, have, target), target
    return hashes if have == length else np.empty(0, np.uint64)


def within(bounds: np.ndarray, length: int, count: int) -> np.ndarray:
    """Which of ``count`` windows lie in one text."""
    inside = np.zeros(count + 1, np.int64)
    first, end = bounds[:-1], np.maximum(bounds[1:] - length + 1, bounds[:-1])
    np.add.at(inside, np.minimum(first, count), 1)
    np.add.at(inside, np.minimum(end, count), -1)
    return np.cumsum(inside[:-1]) > 0


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of ``width`` neighbours, from the first of them on."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = pick(values[: len(values) - step], values[step:])
        have += step
    return values


def shingles(texts: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sets of window hashes: sorted distinct values of each text, and their bounds.

    A text with fewer words than a window has one shingle, all its words; a text without
    words has none.
    """
    words, bounds = word_hashes(texts)
    windows = window_hashes(words, length)
    inside = within(bounds, length, len(windows))
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(windows)][inside]
    values = windows[inside]
    sizes = np.diff(bounds)
    (brief,) = np.nonzero((sizes > 0) & (sizes < length))
    if len(brief):
        single = []
        for t in brief.tolist():
            h = words[bounds[t] : bounds[t] + 1]
            for k in range(bounds[t] + 1, bounds[t + 1]):
                h = joined(h, words[k : k + 1])
            single.append(mixed(h ^ np.uint64(sizes[t])))
        values = np.concatenate([values, *single])
        text = np.concatenate([text, brief])
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    values, text = values[fresh], text[fresh]
    return values, np.searchsorted(text, np.arange(len(bounds)))
