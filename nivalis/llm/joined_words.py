"""Encoding many words in one call of a tokenizer that never joins tokens over the begin of a word."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from nivalis.llm.bpe import _SPACES

#: Words in one text.
WORDS = 256
_LEADING = frozenset(b"\t\n\x0b\x0c\r ")


class Numbers(dict):
    """A number for each word, in the order of their first use."""

    def __missing__(self, key: bytes) -> int:
        self[key] = found = len(self)
        return found


def _alone(word: bytes) -> bool:
    """Whether a word can't stand between others: it begins without white space or ends with some."""
    return word[0] not in _LEADING or word[-1] in _LEADING or (word[-1] > 127 and word.decode()[-1] in _SPACES)


def joined_ids(words: list[bytes], encode: Callable[[list[bytes]], list[list[int]]], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, one after another, and where each word's begin (and the last one's end).

    ``lengths`` are the bytes that each id stands for. Words go to ``encode`` joined, WORDS at a
    time; where a token does not end with a word, each word of that text is encoded by itself.
    """
    # the cheap test first: most words begin with white space and end with an ASCII character that is none
    alone = [not (33 <= w[-1] <= 126 and w[0] in _LEADING) and _alone(w) for w in words]
    single = [i for i, x in enumerate(alone) if x]
    kept = [i for i, x in enumerate(alone) if not x]
    parts = [kept[at : at + WORDS] for at in range(0, len(kept), WORDS)]
    found: list[tuple[list[int], np.ndarray, np.ndarray]] = []
    for part, ids in zip(parts, encode([b"".join([words[i] for i in part]) for part in parts]) if parts else [], strict=True):
        ids = np.array(ids, np.int64)
        ends, stops = np.cumsum(lengths[ids]), np.cumsum([len(words[i]) for i in part])
        cuts = np.searchsorted(ends, stops, "right")
        if len(ids) and cuts[0] and ends[-1] == stops[-1] and (ends[cuts - 1] == stops).all():
            found.append((part, ids, np.diff(cuts, prepend=0)))
        else:
            single += part
    if single:
        own = encode([words[i] for i in single])
        found.append((single, np.array([x for ids in own for x in ids], np.int64), np.array([len(ids) for ids in own], np.int64)))
    order = np.concatenate([np.empty(0, np.int64), *[np.array(part, np.int64) for part, *_ in found]])
    flat = np.concatenate([np.empty(0, np.int64), *[ids for _, ids, _ in found]])
    n = np.concatenate([np.empty(0, np.int64), *[x for *_, x in found]])
    back = np.argsort(order)
    first = (np.cumsum(n) - n)[back]
    sizes = n[back]
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    return flat[np.repeat(first - cuts[:-1], sizes) + np.arange(len(flat))], cuts
