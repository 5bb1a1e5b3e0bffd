"""Language-model scoring with a hierarchical Pitman-Yor model.

Tokens are the words of a text with A-Z in lower case, then one end. A token is drawn in the
restaurant of its context, which is the token before it (by its 64-bit hash; the start of a text
goes by the end before it); all context restaurants share one parent, the restaurant of single
words, and that one draws from a uniform choice among the words known and one unknown. The text's
score is the sum of log10 of the predictive probabilities, each averaged over samples of the
seating.

A seating is the number of tables of each (context, word), and of each word at the parent. A Gibbs
sweep visits all customers: it takes one out, who leaves an empty table with the
probability that a customer of so many at so many tables sits alone (a ratio of generalised
Stirling numbers), and seats that customer again given all others; after the first SINGLY of a dish
they go in groups, whose chances are those at the group's beginning. The first state comes from
seating all customers once, in groups that double. Random numbers are hashes of (word, context,
sweep, visit), so results don't depend on how the data is dealt.

Words belong to owners by hash. An owner has all of a word's counts by context, so the tables that
serve a word, and the customers they send to the parent, stay with it. The tables of a context are
added up by the owner of that context, which is its owner as a word, after each round of sweeps,
and sent back to the owners that asked. Within a round an owner goes by the totals of the round
before (the usual approximation when Gibbs sampling is distributed); the probabilities of a sample
use the totals of that sample, so they add up to 1. The driver sees only sums over all owners.

Texts are dealt into blocks (see ``blocks``). A block sends its distinct (context, word) pairs with
their training counts to the owners once, and gets back, for each pair, its customers and tables,
and, for each word, its count, its state at the parent and the tables of the restaurant that it is
the context of.

Defined cases: a null text is empty and has one token, the end; without training documents every
text has probability 1; a null id belongs to the training documents; repeated rows are counted
and scored as often as they come; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nivalis.llm import blocks
from nivalis.llm.common import documents, id_and_text, materialise, remainder
from nivalis.llm.words import mix, slice_hashes, word_bounds

#: Sweeps of the first round, and of the last before its samples; samples; customers of a dish that a sweep visits one by one.
SWEEPS, BURN_IN, SAMPLES, SINGLY = 2, 1, 2, 16
STRENGTH = 1.0
#: Customers up to which the chance to sit alone is exact.
EXACT = 256
_END = np.uint64(0x1F3A5C7E9B2D4F61)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

SENT = "kind int, owner int, block int, words binary, spread binary, contexts binary, counts binary"
#: Kinds of rows that are sent: a block's pairs; an owner's table, and the places there of each block's pairs; the
#: owner's state and sums for the driver; tables of contexts from the owner ``block``; their totals in the same order;
#: all totals of a contexts' owner; samples.
PAIRS, TABLE, PLACES, STATE, PART, REPLY, TOTALS, SAMPLED = range(8)


def _numbers(x: np.ndarray) -> bytes:
    """One byte for each number, and four more for each from 255 on; the reader knows how many there are."""
    return np.minimum(x, 255).astype("<u1").tobytes() + x[x >= 255].astype("<u4").tobytes()


def _from_numbers(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, "<u1", n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<u4", offset=n)
    return out


def _listed(x: np.ndarray) -> bytes:
    """How many hashes there are, each hash once, and the numbers of those that come, in two or four bytes each (all low bytes first)."""
    near, at = np.unique(x, return_inverse=True)
    size = 2 if len(near) <= 1 << 16 else 4
    planes = at.astype(f"<u{size}").view("<u1").reshape(-1, size).T
    return len(near).to_bytes(8, "little") + near.astype("<u8").tobytes() + zstandard.compress(planes.tobytes(), 1)


def _from_listed(data: bytes, n: int) -> np.ndarray:
    many = int.from_bytes(data[:8], "little")
    size = 2 if many <= 1 << 16 else 4
    planes = np.frombuffer(zstandard.decompress(data[8 + 8 * many :]), "<u1").reshape(size, n)
    return np.frombuffer(data, "<u8", many, 8)[np.ascontiguousarray(planes.T).view(f"<u{size}").reshape(n)]


def _rising(places: np.ndarray) -> bytes:
    """Places that rise, or are -1: which are not -1, and their steps."""
    known = places >= 0
    return zstandard.compress(np.packbits(known).tobytes() + _numbers(np.diff(places[known], prepend=0)), 1)


def _from_rising(data: bytes, n: int) -> np.ndarray:
    raw = zstandard.decompress(data)
    known = np.unpackbits(np.frombuffer(raw, "<u1", (n + 7) // 8), count=n).astype(bool)
    out = np.full(n, -1)
    out[known] = np.cumsum(_from_numbers(raw[(n + 7) // 8 :], int(known.sum())))
    return out


def _row(kind: int, owner: int, block: int, words: bytes = b"", spread: bytes = b"", contexts: bytes = b"", counts: bytes = b"") -> dict:
    return {"kind": kind, "owner": owner, "block": block, "words": words, "spread": spread, "contexts": contexts, "counts": counts}


def _sent(rows: list[dict]) -> pa.Table:
    kinds = [*[pa.int32()] * 3, *[pa.binary()] * 4]
    return pa.Table.from_pylist(rows, schema=pa.schema(list(zip(_row(0, 0, 0), kinds, strict=True))))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of texts (as hashes), each text ended, and the number of tokens of each text."""
    data = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    start, end = word_bounds(data)
    first = np.cumsum([0, *[len(t) + 1 for t in texts]])
    per_text = np.diff(np.searchsorted(start, first))
    of_text = np.repeat(np.arange(len(texts)), per_text)
    out = np.full(len(start) + len(texts), _END)
    out[np.arange(len(start)) + of_text] = slice_hashes(data, start, end)
    return out, per_text + 1


@dataclass
class Table:
    """Counts of (word, context) pairs, sorted by word and context; ``word`` numbers into ``words``, contexts are hashes."""

    words: np.ndarray
    word: np.ndarray
    context: np.ndarray
    count: np.ndarray

    @staticmethod
    def numbered(words: np.ndarray, word: np.ndarray, contexts: np.ndarray, context: np.ndarray, counts: np.ndarray) -> tuple[Table, np.ndarray]:
        n = max(1, len(contexts))
        pairs, pair = np.unique(word * n + context, return_inverse=True)
        return Table(words, pairs // n, contexts[pairs % n], np.bincount(pair, counts, len(pairs)).astype(np.int64)), pair

    @staticmethod
    def read(row: dict) -> Table:
        words = np.frombuffer(row["words"], "<u8")
        spread = _from_numbers(row["spread"], len(words))
        word = np.repeat(np.arange(len(words)), spread)
        return Table(words, word, _from_listed(row["contexts"], len(word)), _from_numbers(zstandard.decompress(row["counts"]), len(word)))

    def part(self, chosen: np.ndarray) -> Table:
        """The table of some of the words."""
        pairs = np.flatnonzero(chosen[self.word])
        number = np.cumsum(chosen) - 1
        return Table(self.words[chosen], number[self.word[pairs]], self.context[pairs], self.count[pairs])

    def row(self, kind: int, owner: int, block: int) -> dict:
        spread = np.bincount(self.word, minlength=len(self.words))
        return _row(kind, owner, block, self.words.astype("<u8").tobytes(), _numbers(spread), _listed(self.context), zstandard.compress(_numbers(self.count), 1))

    @functools.cached_property
    def seen(self) -> np.ndarray:
        """The count of each word."""
        return np.bincount(self.word, self.count, len(self.words)).astype(np.int64)

    @functools.cached_property
    def keys(self) -> np.ndarray:
        """A hash of each pair."""
        return mix(self.words[self.word] + mix(self.context))

    @functools.cached_property
    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct contexts, and the number of each pair's."""
        return np.unique(self.context, return_inverse=True)


@dataclass
class Totals:
    """What all owners share: token and word totals, and the discounts; and a state's customers and tables at the parent."""

    tokens: int
    words: int
    discount: float
    parent_discount: float
    all_customers: float
    all_tables: float


@functools.lru_cache(maxsize=4)
def _alone_table(discount: float) -> np.ndarray:
    """[n, t]: the chance that a customer of n at t tables sits alone, for n up to EXACT."""
    out, t = np.zeros((EXACT + 1, EXACT + 1)), np.arange(EXACT + 2)
    out[1, 1] = 1.0
    v = np.zeros(EXACT + 2)  # v[t] = S(n, t) / S(n, t - 1), of n customers at t tables
    for n in range(1, EXACT):
        out[n + 1, 2:] = 1 / (1 + (n - discount * t[2:-1]) * v[2:-1])
        out[n + 1, n + 2 :] = 0
        below = np.divide(1, v[1:-1], out=np.zeros(EXACT), where=v[1:-1] > 0)
        with np.errstate(divide="ignore"):
            v[2:] = np.where(t[2:] <= n + 1, (1 + (n - discount * t[2:]) * v[2:]) / (below + n - discount * t[1:-1]), 0)
    return out


def alone(customers: np.ndarray, tables: np.ndarray, discount: float) -> np.ndarray:
    """The chance that one of the customers sits alone; beyond EXACT customers its limit for many."""
    small = customers <= EXACT
    exact = _alone_table(discount)[np.where(small, customers, 0), np.where(small, tables, 0)]
    return np.where(small, exact, discount * (tables - 1) / np.maximum(customers, 1))


def _uniform(keys: np.ndarray, *turn: int) -> np.ndarray:
    salt = np.zeros(1, np.uint64)
    for x in turn:
        salt = mix(salt + np.uint64(x + 1))
    return (mix(keys ^ salt) >> np.uint64(11)) * 2.0**-53


def seat(customers: np.ndarray, fresh: np.ndarray, discount: float, keys: np.ndarray, seed: int) -> np.ndarray:
    """Tables after seating the customers of each dish; ``fresh`` weighs a new table. From 64 on they come in groups that double."""
    tables = (customers > 0).astype(np.int64)
    seated, own = 1, np.flatnonzero(customers > 1)
    while len(own):
        group = 1 if seated < 64 else seated
        size = np.minimum(group, customers[own] - seated)
        joined = seated + (size - 1) / 2 - discount * tables[own]
        chance = fresh[own] / (fresh[own] + joined)
        tables[own] += np.floor(size * chance + _uniform(keys[own], seed, seated)).astype(np.int64)
        seated += group
        own = own[customers[own] > seated]
    return tables


def _drawn(n: np.ndarray, chance: np.ndarray, keys: np.ndarray, *turn: int) -> np.ndarray:
    """How many of n succeed: drawn from the Poisson distribution of the mean, beyond a mean of 16 from the normal one."""
    mean, u = n * chance, _uniform(keys, *turn, 0)
    wide = np.sqrt(np.maximum(mean * (1 - chance), 0)) * np.sqrt(-2 * np.log(np.maximum(u, 2.0**-53))) * np.cos(2 * np.pi * _uniform(keys, *turn, 1))
    out = np.where(mean > 16, np.rint(mean + wide), 0)
    few = np.flatnonzero(mean <= 16)
    term, k = np.exp(-mean[few]), 0
    below = term.copy()
    while len(few):
        left = (u[few] >= below) & (k < 64)
        few, term, below, k = few[left], term[left], below[left], k + 1
        out[few] = k
        term = term * mean[few] / k
        below = below + term
    return np.minimum(out, n).astype(np.int64)


def reseat(customers: np.ndarray, tables: np.ndarray, total: np.ndarray | float, base: np.ndarray | float, discount: float, keys: np.ndarray, seed: int) -> np.ndarray:
    """Tables after a Gibbs sweep: all customers of each dish are taken out and seated again, the first SINGLY one by one, the others in groups of an eighth of those before.

    ``total`` are the tables of each dish's restaurant, ``base`` the dish's probability above. Of a
    group, those that leave an empty table and those that open one are drawn at its beginning.
    """
    out = tables.copy()
    total, base = (np.broadcast_to(np.asarray(x, float), customers.shape) for x in (total, base))
    visited, visit, own = 0, 0, np.flatnonzero(customers > 1)
    while len(own):
        n, t = customers[own], out[own]
        fresh = lambda t: (STRENGTH + discount * np.maximum(total[own] + t - tables[own], 0)) * base[own]  # noqa: B023, E731
        group = 1 if visited < SINGLY else visited // 8
        if group == 1:
            t = t - (_uniform(keys[own], seed, 2 * visit) < alone(n, t, discount))
            chance = fresh(t) / (fresh(t) + n - 1 - discount * t)
            out[own] = t + (_uniform(keys[own], seed, 2 * visit + 1) < chance)
        else:
            size = np.minimum(group, n - visited)
            gone = alone(n, t, discount)
            # a customer comes to t tables, or to one less
            chance = fresh(t - gone) / (fresh(t - gone) + n - 1 - discount * (t - gone))
            out[own] = np.clip(t - _drawn(size, gone, keys[own], seed, 2 * visit) + _drawn(size, chance, keys[own], seed, 2 * visit + 1), 1, n)
        visited, visit = visited + group, visit + 1
        own = own[customers[own] > visited]
    return out


def parent_probability(customers: np.ndarray, tables: np.ndarray, totals: Totals) -> np.ndarray:
    uniform = (STRENGTH + totals.parent_discount * totals.all_tables) / (totals.words + 1)
    return (np.maximum(customers - totals.parent_discount * tables, 0) + uniform) / (STRENGTH + totals.all_customers)


def sweep(table: Table, by_pair: np.ndarray, tables: np.ndarray, above: np.ndarray, totals: Totals, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables of each pair, and each word's customers and tables at the parent, after one more sweep; ``by_pair`` has the tables of each pair's context."""
    customers = np.bincount(table.word, tables, len(table.words)).astype(np.int64)
    base = parent_probability(customers, above, totals)
    tables = reseat(table.count, tables, by_pair, base[table.word], totals.discount, table.keys, seed)
    customers = np.bincount(table.word, tables, len(table.words)).astype(np.int64)
    above = reseat(customers, np.minimum(above, customers), totals.all_tables, 1 / (totals.words + 1), totals.parent_discount, table.words, seed)
    return tables, customers, above


def _pages(table: pa.Table) -> tuple[list[tuple[list, list, np.ndarray, np.ndarray]], np.ndarray]:
    """The ids, folds, tokens and sizes of each page of a block, and the block's distinct tokens."""
    pages = [(ids, folds, *tokens(texts)) for ids, folds, texts in blocks.read(table)]
    return pages, np.unique(np.concatenate([np.unique(words) for _, _, words, _ in pages]))


def _find(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The places in the sorted known of the wanted, all of which are there; each distinct one is looked up once."""
    each, at = np.unique(wanted, return_inverse=True)
    return np.searchsorted(known, each)[at]


def _pair_keys(words: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The pair of each token of whole texts, as a number: by word, then by context."""
    word = _find(known, words)
    return word * len(known) + np.concatenate([np.searchsorted(known, [_END]), word[:-1]])


def _pairs(owners: int):
    def send(table: pa.Table) -> pa.Table:
        pages, known = _pages(table)
        parts = []
        for _, folds, words, sizes in pages:
            keys, at = np.unique(_pair_keys(words, known), return_inverse=True)
            parts.append((keys, np.bincount(at, np.repeat(np.array(folds) == 0, sizes), len(keys))))
        keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        keys, at = np.unique(keys, return_inverse=True)
        own = Table(known, keys // len(known), known[keys % len(known)], np.bincount(at, counts, len(keys)).astype(np.int64))
        owner = (known % np.uint64(owners)).astype(np.int64)
        return _sent([own.part(owner == o).row(PAIRS, o, table["block"][0].as_py()) for o in np.unique(owner).tolist()])

    return send


def _places(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The places of the wanted in the sorted known; -1 if not there."""
    if not len(known):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[at] == wanted, at, -1)


def _merge(table: pa.Table) -> pa.Table:
    """An owner's table of what its blocks have counted, and the places there of each block's words and pairs."""
    rows = table.to_pylist()
    parts = [Table.read(r) for r in rows]
    words, word = np.unique(np.concatenate([p.words[p.word] for p in parts]), return_inverse=True)
    contexts, context = np.unique(np.concatenate([p.context for p in parts]), return_inverse=True)
    merged, pair = Table.numbered(words, word, contexts, context, np.concatenate([p.count for p in parts]))
    trained = merged.count > 0
    place = np.where(trained, np.cumsum(trained) - 1, -1)[pair]
    merged = Table(words, merged.word[trained], merged.context[trained], merged.count[trained]).part(merged.seen > 0)
    out, at = [merged.row(TABLE, rows[0]["owner"], -1)], 0
    for row, part in zip(rows, parts, strict=True):
        n = len(part.word)
        sizes = np.array([len(part.words), n], "<i8").tobytes()
        out.append(_row(PLACES, row["owner"], row["block"], _rising(_places(merged.words, part.words)), _rising(place[at : at + n]), sizes))
        at += n
    return _sent(out)


def _parts(table: Table, owner: int, owners: int, *tables: np.ndarray) -> list[dict]:
    """The tables of an owner's contexts, by samples, for the contexts' owners."""
    near, context = table.near
    own = [np.bincount(context, t, len(near)).astype(np.int64) for t in tables]
    to = (near % np.uint64(owners)).astype(np.int64)
    return [_row(PART, o, owner, spread=bytes([len(own)]), contexts=near[to == o].tobytes(), counts=_numbers(np.concatenate([x[to == o] for x in own]))) for o in np.unique(to).tolist()]


def _start(owners: int):
    """Each pair begins with one table."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                table = Table.read(row)
                served = np.bincount(table.word, minlength=len(table.words))
                sums = [table.count.sum(), len(table.words), (table.count == 1).sum(), (table.count == 2).sum(), (served == 1).sum(), (served == 2).sum(), len(table.word)]
                state = _row(STATE, row["owner"], -1, counts=np.array(sums, "<i8").tobytes())
                yield from _sent([state, *_parts(table, row["owner"], owners, np.ones(len(table.word)))]).to_batches()

    return start


def _add_up(table: pa.Table) -> pa.Table:
    """The totals of one owner's contexts, and a reply to each owner that sent a part."""
    rows = table.to_pylist()
    parts = [np.frombuffer(r["contexts"], "<u8") for r in rows]
    samples = rows[0]["spread"][0]
    near, context = np.unique(np.concatenate(parts), return_inverse=True)
    counts = np.concatenate([_from_numbers(r["counts"], samples * len(p)).reshape(samples, -1) for r, p in zip(rows, parts, strict=True)], axis=1)
    sums = np.stack([np.bincount(context, x, len(near)).astype(np.int64) for x in counts])
    own = np.split(sums[0][context], np.cumsum([len(p) for p in parts])[:-1])
    out = [_row(REPLY, r["block"], r["owner"], counts=_numbers(x)) for r, x in zip(rows, own, strict=True)]
    return _sent([*out, _row(TOTALS, rows[0]["owner"], -1, contexts=near.tobytes(), counts=_numbers(sums.ravel()))])


def _known(rows: list[dict], owners: int) -> tuple[Table, np.ndarray, dict]:
    """An owner's table, the tables of each pair's context, and the other rows by kind."""
    own = {r["kind"]: r for r in rows}
    if TABLE not in own:
        none = np.empty(0, np.int64)
        return Table(np.empty(0, np.uint64), none, np.empty(0, np.uint64), none), none, own
    table = Table.read(own[TABLE])
    near, context = table.near
    of, by_context = (near % np.uint64(owners)).astype(np.int64), np.zeros(len(near))
    for r in rows:
        if r["kind"] == REPLY:
            chosen = of == r["block"]
            by_context[chosen] = _from_numbers(r["counts"], int(chosen.sum()))
    return table, by_context[context], own


def _first(totals: Totals, owners: int):
    """The first round: all are seated, then SWEEPS sweeps."""

    def first(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own, by_pair, _ = _known(rows, owners)
        one = np.ones(len(own.words), np.int64)
        base = parent_probability(np.bincount(own.word, minlength=len(own.words)), one, totals)
        tables = seat(own.count, (STRENGTH + totals.discount * by_pair) * base[own.word], totals.discount, own.keys, 0)
        customers = np.bincount(own.word, tables, len(own.words)).astype(np.int64)
        above = seat(customers, np.full(len(customers), (STRENGTH + totals.parent_discount * totals.all_tables) / (totals.words + 1)), totals.parent_discount, own.words, 0)
        for i in range(SWEEPS):
            tables, customers, above = sweep(own, by_pair, tables, above, totals, 1 + i)
        sums = np.array([customers.sum(), above.sum()], "<i8").tobytes()
        return _sent([_row(STATE, rows[0]["owner"], -1, _numbers(tables[own.count > 1]), _numbers(above), counts=sums), *_parts(own, rows[0]["owner"], owners, tables)])

    return first


def _last(totals: Totals, owners: int):
    """The last round: BURN_IN sweeps, then a sample after each of SAMPLES."""

    def last(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own, by_pair, found = _known(rows, owners)
        many = own.count > 1
        tables, above = np.ones(len(own.count), np.int64), np.empty(0, np.int64)
        if STATE in found:
            tables[many] = _from_numbers(found[STATE]["words"], int(many.sum()))
            above = _from_numbers(found[STATE]["spread"], len(own.words))
        samples = []
        for i in range(BURN_IN + SAMPLES):
            tables, customers, above = sweep(own, by_pair, tables, above, totals, 1 + SWEEPS + i)
            samples.append((tables, customers, above))
        tables, customers, above = zip(*samples[BURN_IN:], strict=True)
        sums = np.array([x.sum() for pair in zip(customers, above, strict=True) for x in pair], "<i8").tobytes()
        state = _row(SAMPLED, rows[0]["owner"], -1, _numbers(sum(tables)[many]), _numbers(np.concatenate(customers)), _numbers(np.concatenate(above)), sums)
        return _sent([state, *_parts(own, rows[0]["owner"], owners, *tables)])

    return last


def _totalled(said: DataFrame) -> DataFrame:
    return said.where(F.col("kind") == PART).groupBy("owner").applyInArrow(_add_up, SENT)


def _summed(said: DataFrame, kind: int, n: int) -> list[int]:
    """The owners' sums for the driver, n of each owner."""
    found = said.where(F.col("kind") == kind).select("counts").collect()
    return np.sum([np.frombuffer(r[0], "<i8") for r in found], axis=0).tolist() if found else [0] * n


def train(owned: DataFrame, owners: int) -> tuple[DataFrame, list[Totals]]:
    """What owners know after all rounds (samples, and their contexts' totals), and the totals of each sample."""
    table = owned.where(F.col("kind") == TABLE)
    said = materialise(table.mapInArrow(_start(owners), SENT))
    size, words, *rare, pairs = _summed(said, STATE, 7)
    discount = lambda a, b: min(0.95, max(0.05, a / max(a + 2 * b, 1)))
    shared = (size, words, discount(*rare[:2]), discount(*rare[2:]))
    replies = lambda said: _totalled(said).where(F.col("kind") == REPLY)
    said = materialise(table.unionByName(replies(said)).groupBy("owner").applyInArrow(_first(Totals(*shared, float(pairs), float(words)), owners), SENT))
    totals = Totals(*shared, *map(float, _summed(said, STATE, 2)))
    known = table.unionByName(said.where(F.col("kind") == STATE)).unionByName(replies(said))
    said = materialise(known.groupBy("owner").applyInArrow(_last(totals, owners), SENT))
    sums = _summed(said, SAMPLED, 2 * SAMPLES)
    samples = [Totals(*shared, float(sums[2 * i]), float(sums[2 * i + 1])) for i in range(SAMPLES)]
    return said.where(F.col("kind") == SAMPLED).unionByName(_totalled(said).where(F.col("kind") == TOTALS)), samples


ANSWERS = "block int, owner int, customers binary, tables binary, words binary"


def _answer(table: pa.Table) -> pa.Table:
    """For each block's pairs their customers and tables (of all samples); for its words the count, and for each sample customers and tables at the parent, and tables as a context."""
    rows = table.to_pylist()
    own = {r["kind"]: r for r in rows}
    known = Table.read(own[TABLE])
    n, many = len(known.words), known.count > 1
    tables = np.append(np.full(len(known.count), SAMPLES), 0)
    tables[:-1][many] = _from_numbers(own[SAMPLED]["words"], int(many.sum()))
    state = np.zeros((1 + 3 * SAMPLES, n + 1), np.int64)
    state[0, :-1] = known.seen
    state[1 : 1 + SAMPLES, :-1] = _from_numbers(own[SAMPLED]["spread"], SAMPLES * n).reshape(SAMPLES, n)
    state[1 + SAMPLES : 1 + 2 * SAMPLES, :-1] = _from_numbers(own[SAMPLED]["contexts"], SAMPLES * n).reshape(SAMPLES, n)
    if TOTALS in own:
        contexts = np.frombuffer(own[TOTALS]["contexts"], "<u8")
        state[1 + 2 * SAMPLES :, _places(known.words, contexts)] = _from_numbers(own[TOTALS]["counts"], SAMPLES * len(contexts)).reshape(SAMPLES, -1)
    customers = np.append(known.count, 0)
    out = []
    for r in rows:
        if r["kind"] == PLACES:
            words, pairs = np.frombuffer(r["contexts"], "<i8").tolist()
            word, pair = _from_rising(r["words"], words), _from_rising(r["spread"], pairs)
            # pairs of one customer have a table in each sample, which goes without saying
            many = customers[pair] > 1
            packed = [zstandard.compress(_numbers(x), 1) for x in (customers[pair], tables[pair][many], state[:, word].ravel())]
            out.append({"block": r["block"], "owner": r["owner"], "customers": packed[0], "tables": packed[1], "words": packed[2]})
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 3]
    return pa.Table.from_pylist(out, schema=pa.schema(list(zip(["block", "owner", "customers", "tables", "words"], kinds, strict=True))))


def _logs(table: Table, answers: list[dict], owners: int, samples: list[Totals]) -> tuple[np.ndarray, np.ndarray]:
    """log10 of the probability of each pair of a block, and the count of each word."""
    owner = (table.words % np.uint64(owners)).astype(np.int64)
    customers, tables = np.zeros(len(table.word), np.int64), np.zeros(len(table.word))
    state = np.zeros((1 + 3 * SAMPLES, len(table.words)), np.int64)
    for got in answers:
        chosen = owner == got["owner"]
        pairs = np.flatnonzero(chosen[table.word])
        customers[pairs] = _from_numbers(zstandard.decompress(got["customers"]), len(pairs))
        many = pairs[customers[pairs] > 1]
        tables[pairs] = np.where(customers[pairs] > 0, SAMPLES, 0)
        tables[many] = _from_numbers(zstandard.decompress(got["tables"]), len(many))
        state[:, chosen] = _from_numbers(zstandard.decompress(got["words"]), len(state) * int(chosen.sum())).reshape(len(state), -1)
    one = samples[0]
    context = np.searchsorted(table.words, table.context)  # each context is a word of the block, or the end
    total = (customers - one.discount * tables / SAMPLES).astype(float)
    for i, totals in enumerate(samples):
        base = parent_probability(state[1 + i], state[1 + SAMPLES + i], totals)
        total += (STRENGTH + one.discount * state[1 + 2 * SAMPLES + i][context]) * base[table.word] / SAMPLES
    return np.log10(total / (STRENGTH + state[0][context])), state[0]


def score(texts: DataFrame, by_token: bool = False) -> DataFrame:
    """Scores all rows of (doc_id, fold, text), learning from those of fold 0; ``by_token`` adds logs, the log10 probability of each token."""
    n = blocks.count(texts)
    owners = n
    packed = blocks.pages(texts, n)
    owned = materialise(packed.groupBy("block").applyInArrow(_pairs(owners), SENT).groupBy("owner").applyInArrow(_merge, SENT))
    known, samples = train(owned, owners)
    answers = owned.unionByName(known).groupBy("owner").applyInArrow(_answer, ANSWERS)
    fields = ["doc_id long", "held_out boolean", "n_tokens long", "n_known long", "train_tokens long", "base_score double", "score double", "perplexity double", *(["logs array<double>"] if by_token else [])]

    def finish(table: pa.Table, own: pa.Table) -> pa.Table:
        pages, known = _pages(table)
        keys = np.unique(np.concatenate([np.unique(_pair_keys(words, known)) for _, _, words, _ in pages]))
        word = keys // len(known)
        by_pair, seen = _logs(Table(known, word, known[keys % len(known)], np.empty(0, np.int64)), own.to_pylist(), owners, samples)
        out = []
        for ids, folds, words, sizes in pages:
            at = _find(keys, _pair_keys(words, known))
            logs, c = by_pair[at], seen[word[at]]
            first = np.cumsum(sizes) - sizes
            base = np.log10((c + 0.5) / (samples[0].tokens + 0.5 * (samples[0].words + 1)))
            total = np.add.reduceat(logs, first)
            columns = [
                pa.array(ids, pa.int64()),
                pa.array([f == 1 for f in folds], pa.bool_()),
                pa.array(sizes, pa.int64()),
                pa.array(np.add.reduceat((c > 0).astype(np.int64), first), pa.int64()),
                pa.array(np.full(len(ids), samples[0].tokens), pa.int64()),
                pa.array(np.add.reduceat(base, first)),
                pa.array(total),
                pa.array(10.0 ** np.minimum(-total / sizes, 300)),
            ]
            if by_token:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(first, len(logs)), pa.int32()), pa.array(logs)))
            out.append(pa.table(columns, names=[x.split()[0] for x in fields]))
        return pa.concat_tables(out)

    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, ", ".join(fields))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = id_and_text(documents(spark, sf_dir))
    return score(texts.withColumn("fold", (remainder(F.col("doc_id"), 5) == 1).cast("int")))
