"""Fragments of two tokenizations of one text, and how neighbours are put together.

A fragment holds the tokens of a byte range of a document: the open prefix (tokens up to the first
place where tokens of both tokenizers end), the closed groups between such places, and the open
suffix (tokens after the last). What it holds depends only on the tokens, not on how the range was
cut before, so ``a + (b + c)`` equals ``(a + b) + c``; ``Fragment()`` is neutral.

The ranges of the two tokenizers need not be the same: one may be ahead of the other at either end.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass, field

import numpy as np

_NONE = np.empty(0, np.int64)
#: A pair of ids in one number: A's above, B's below.
B_BITS = 20


@dataclass
class Tokens:
    """Ids in order, and the byte after each token's last, counted from the document's start."""

    ids: np.ndarray = field(default_factory=lambda: _NONE)
    ends: np.ndarray = field(default_factory=lambda: _NONE)

    def __add__(self, other: Tokens) -> Tokens:
        if not len(self.ids) or not len(other.ids):
            return self if len(self.ids) else other
        return Tokens(np.concatenate([self.ids, other.ids]), np.concatenate([self.ends, other.ends]))

    def cut(self, end: int) -> tuple[Tokens, Tokens]:
        """The tokens that end at or before ``end``, and the others."""
        n = int(np.searchsorted(self.ends, end, "right"))
        return Tokens(self.ids[:n], self.ends[:n]), Tokens(self.ids[n:], self.ends[n:])


def met(a: Tokens, b: Tokens) -> np.ndarray:
    """The places where tokens of both end."""
    if not len(a.ends) or not len(b.ends):
        return _NONE
    return a.ends[b.ends[np.minimum(np.searchsorted(b.ends, a.ends), len(b.ends) - 1)] == a.ends]


def linked(a: Tokens, b: Tokens) -> np.ndarray:
    """A number for each pair of tokens whose byte ranges overlap; both lists cover one range.

    Between two neighbouring ends lies just one token of each kind, and each pair that overlaps
    does so in one such stretch.
    """
    ends = np.union1d(a.ends, b.ends)
    return (a.ids[np.searchsorted(a.ends, ends)] << B_BITS) | b.ids[np.searchsorted(b.ends, ends)] if len(ends) else _NONE


@functools.lru_cache(maxsize=1)
def _names() -> dict[int, bytes]:
    """The text of an id and what follows it (0: a comma, 1: a bar, 2: a semicolon), by 4 times the id and that."""

    class Names(dict):
        def __missing__(self, key: int) -> bytes:
            self[key] = found = b"%d%c" % (key >> 2, b",|;"[key & 3])
            return found

    return Names()


def group_lines(a: Tokens, b: Tokens, common: np.ndarray) -> list[bytes]:
    """The groups that end at ``common``, as text with a semicolon after each."""
    if not len(common):
        return []
    parts = []
    for x, last in ((a, 1), (b, 2)):
        group = np.searchsorted(common, x.ends)
        follows = np.zeros(len(group), np.int64)
        follows[np.searchsorted(group, np.arange(len(common)), "right") - 1] = last
        parts.append((group, 4 * x.ids + follows))
    order = np.argsort(np.concatenate([2 * parts[0][0], 2 * parts[1][0] + 1]), kind="stable")
    names = list(map(_names().__getitem__, np.concatenate([parts[0][1], parts[1][1]])[order].tolist()))
    stops = np.cumsum(np.bincount(np.concatenate([parts[0][0], parts[1][0]]), minlength=len(common))).tolist()
    return [b"".join(names[i:j]) for i, j in zip([0, *stops[:-1]], stops, strict=True)]


def tallied(codes: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes and how often each comes."""
    found, where = np.unique(codes, return_inverse=True)
    return found, np.bincount(where, weights=times, minlength=len(found)).astype(np.int64)


@dataclass
class Fragment:
    prefix_a: Tokens = field(default_factory=Tokens)
    prefix_b: Tokens = field(default_factory=Tokens)
    #: Whether both tokenizers' tokens end together anywhere; without that all tokens are in the prefix.
    closed: bool = False
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    #: The closed groups, joined by semicolons; their links and how often each comes.
    text: bytes = b""
    codes: np.ndarray = field(default_factory=lambda: _NONE)
    times: np.ndarray = field(default_factory=lambda: _NONE)
    suffix_a: Tokens = field(default_factory=Tokens)
    suffix_b: Tokens = field(default_factory=Tokens)

    def __add__(self, other: Fragment) -> Fragment:
        if not self.closed:
            a, b = self.prefix_a + other.prefix_a, self.prefix_b + other.prefix_b
            left = fragment(a, b)
            if not other.closed:
                return left
            # all of a and b end where the other's first group does, so nothing is left open
            return Fragment(left.prefix_a, left.prefix_b, True, *_joined(left, other), other.suffix_a, other.suffix_b)
        middle = _closed_and_open(self.suffix_a + other.prefix_a, self.suffix_b + other.prefix_b)
        if other.closed:
            return Fragment(self.prefix_a, self.prefix_b, True, *_joined(self, middle, other), other.suffix_a, other.suffix_b)
        return Fragment(self.prefix_a, self.prefix_b, True, *_joined(self, middle), middle.suffix_a, middle.suffix_b)

    def whole(self) -> Fragment:
        """The document's groups, when all of its tokens are here: the first group is closed by its start."""
        return Fragment(closed=True) + self


def _joined(*parts: Fragment) -> tuple[int, int, int, bytes, np.ndarray, np.ndarray]:
    some = [x for x in parts if x.n_groups]
    codes, times = np.concatenate([_NONE, *[x.codes for x in some]]), np.concatenate([_NONE, *[x.times for x in some]])
    if len(some) > 1:
        codes, times = tallied(codes, times)
    return sum(x.n_a for x in some), sum(x.n_b for x in some), sum(x.n_groups for x in some), b";".join([x.text for x in some]), codes, times


def _closed_and_open(a: Tokens, b: Tokens) -> Fragment:
    """Tokens that begin together: all groups are closed, what is left is the suffix."""
    common = met(a, b)
    if not len(common):
        return Fragment(closed=True, suffix_a=a, suffix_b=b)
    (a, rest_a), (b, rest_b) = a.cut(common[-1]), b.cut(common[-1])
    codes, times = tallied(linked(a, b))
    return Fragment(Tokens(), Tokens(), True, len(a.ids), len(b.ids), len(common), b"".join(group_lines(a, b, common))[:-1], codes, times, rest_a, rest_b)


def fragment(a: Tokens, b: Tokens) -> Fragment:
    """The fragment of tokens of a byte range."""
    common = met(a, b)
    if not len(common):
        return Fragment(a, b)
    (prefix_a, a), (prefix_b, b) = a.cut(common[0]), b.cut(common[0])
    rest = _closed_and_open(a, b)
    rest.prefix_a, rest.prefix_b = prefix_a, prefix_b
    return rest
