"""Simple-8b: whole numbers packed into 64-bit words.

The upper 4 bits of a word are its selector, which says how many values of how many bits the lower
60 hold. A selector of 0 is an escape: the word after it is one value of more than 60 bits, as it
is. Such a value never has 0 in its upper 4 bits, so escapes are found without reading in order.

Values are packed in blocks of BLOCK, each from a word of its own; the place of each block's first
word is kept, so a block can be read alone. The last word of a block may have room left, which is
zeros. Both ways work on all blocks at once.
"""

from __future__ import annotations

import numpy as np

BLOCK = 128
#: Fixed values of the format: how many values, and of how many bits, selectors 1 to 14 stand for.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.uint64)
_LIMITS = np.array([(1 << int(b)) - 1 for b in BITS[1:]], np.uint64)
_ESCAPE, _TOP = 15, np.uint64(60)


def _selectors(kinds: np.ndarray) -> np.ndarray:
    """For each place of each row, the selector of a word that begins there.

    ``kinds`` is the smallest selector that each value fits. A word may take n values if none of
    the next n (past the row's end all fit) needs a larger selector; the one with the most values
    is taken. Values that fit a selector's word fit that of each larger selector, so the number of
    selectors that they fit gives the smallest.
    """
    rows, width = kinds.shape
    fit = np.zeros((rows, width), np.int8)
    wide = np.ones((rows, width + 60), np.int8)
    wide[:, :width] = kinds
    for k in range(1, 15):
        good, have = wide <= k, 1
        while have < COUNTS[k]:
            more = int(min(have, COUNTS[k] - have))
            good[:, :-more] &= good[:, more:].copy()
            have += more
        fit += good[:, :width]
    return np.int8(_ESCAPE) - fit


_SMALL = (np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64)) + 1).astype(np.int8)


def _kinds(values: np.ndarray) -> np.ndarray:
    """The smallest selector that each value fits."""
    if values.max(initial=0) < len(_SMALL):
        return _SMALL[values]
    return (np.searchsorted(_LIMITS, values) + 1).astype(np.int8)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words (uint64) of whole numbers from 0 to 2^64 - 1, and the place of each block's first word."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    rows = -(-n // BLOCK)
    padded = np.zeros(rows * BLOCK + 60, np.uint64)
    padded[:n] = values
    kinds = _kinds(padded[: rows * BLOCK]).reshape(rows, BLOCK)
    choice = _selectors(kinds)
    step = np.where(choice == _ESCAPE, 1, COUNTS[np.minimum(choice, 14)])
    begins = np.zeros((rows, BLOCK), bool)
    row, at, left = np.arange(rows), np.zeros(rows, np.int64), np.minimum(BLOCK, n - BLOCK * np.arange(rows))
    while len(row):
        begins[row, at] = True
        at = at + step[row, at]
        on = at < left[row]
        row, at = row[on], at[on]
    places = np.flatnonzero(begins)
    selector = choice.ravel()[places]
    size = np.where(selector == _ESCAPE, 2, 1)
    target = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for k in np.unique(selector):
        which = selector == k
        at, to = places[which], target[which]
        if k == _ESCAPE:
            words[to + 1] = padded[at]
            continue
        left = np.minimum(BLOCK - at % BLOCK, n - at)
        short = bool((left < COUNTS[k]).any())
        word = np.full(len(at), np.uint64(k) << _TOP)
        for turn in range(COUNTS[k]):
            value = padded[at + turn] << np.uint64(turn * BITS[k])
            word |= np.where(left > turn, value, np.uint64(0)) if short else value
        words[to] = word
    return words, target[np.searchsorted(places, np.arange(rows) * BLOCK)]


def unpack(words: np.ndarray, first: np.ndarray, n: int, blocks: slice = slice(None)) -> np.ndarray:
    """The n values that were packed, or those of some ``blocks`` in a row."""
    begin, end, _ = blocks.indices(len(first))
    if begin >= end:
        return np.empty(0, np.uint64)
    edges = np.append(first, len(words))
    words, first = words[edges[begin] : edges[end]], edges[begin:end] - edges[begin]
    n = min(n, end * BLOCK) - begin * BLOCK
    selector = (words >> _TOP).astype(np.int64)
    escape = np.flatnonzero(selector == 0)
    raw = np.zeros(len(words), bool)
    raw[escape + 1] = True
    counts = np.where(raw, 1, COUNTS[np.minimum(selector, 14)])
    counts[escape] = 0
    block = np.cumsum(np.bincount(first, minlength=len(words))) - 1
    place = np.cumsum(counts) - counts
    place = place - place[first][block] + block * BLOCK
    stop = np.minimum((block + 1) * BLOCK, n)
    out = np.zeros(n, np.uint64)
    out[place[raw]] = words[raw]
    for k in np.unique(selector[~raw]):
        if k:
            which = np.flatnonzero((selector == k) & ~raw)
            turn = np.arange(COUNTS[k])
            to = place[which][:, None] + turn
            inside = to < stop[which][:, None]
            out[to[inside]] = ((words[which][:, None] >> (turn.astype(np.uint64) * BITS[k])) & _LIMITS[k - 1])[inside]
    return out
