"""Where two tokenizations of a text agree: groups, links between their tokens, and how common each link is.

Texts are cut into words at a space after something that is not white space. Neither tokenizer ever
joins tokens over such a place, so both end there, and the groups and links of a distinct word are
found once in each worker, however often the word comes.

A text of over LONG bytes is dealt over tasks in byte ranges of about PART. Each tokenizer's range
ends where it is safe for that one (A: white space; B: a space), so the two ranges differ at both
ends. Each task makes its range a fragment (``token_fragments``); fragments of a document are put
together FAN at a time, in as many rounds as the longest document needs.

Counts: a page of about PAGE_BYTES of text sends one row for each distinct pair of ids in it; pairs
are summed over all pages, the highest of each B id is found, and the sums go back to the pages that
asked. So what crosses the network grows with the distinct pairs of a page, not with its links.

Defined cases: a null or empty text has no tokens, nor has a text that B cannot give back (it holds
U+2581, say): zeros, and '' for the digest; special tokens' strings are plain text; rows that repeat
a doc_id, and a null doc_id, are documents of their own; no documents: no rows; other columns are
ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nivalis.llm.bpe import _WIDE, Packed, default_path, pieces
from nivalis.llm.common import NO_ID, documents, id_and_text, materialise
from nivalis.llm.joined_words import Numbers, joined_ids
from nivalis.llm.token_fragments import B_BITS, Fragment, Tokens, fragment, group_lines, linked, met, tallied

#: Bytes of text in a page; bytes from which a text is dealt over tasks, and in a part of it; fragments put together at once.
PAGE_BYTES, LONG, PART, FAN = 4 << 20, 1 << 20, 256 << 10, 16
#: Bytes of text that are split at once (no more than LONG), words tokenized in one call, and bytes that a worker keeps of the words it knows.
GROUP, CALL, KNOWN_BYTES = 1 << 20, 8192, 64 << 20

#: A space after what is not white space, in texts without white space beyond ASCII and in any text.
_CUT, _CUT_ANY, _PLAIN = re.compile(rb"(?<=[^\t-\r ])(?= )"), re.compile(rb"(?<=[!-~])(?= )"), re.compile(rb"[\t-\r ] ")
#: Where the ranges of A and of B may end in any text.
_A_END, _B_END = re.compile(rb"(?<=[!-~])[\t-\r ]"), re.compile(rb"(?<=[!-~]) ")

#: Packed arrays: documents, the words of each, and the links of each distinct word.
PAGE = {"page": "long", "ids": "binary", "n_a": "binary", "n_b": "binary", "n_groups": "binary", "n_links": "binary", "digests": "binary", "n_words": "binary", "words": "binary", "n_codes": "binary", "codes": "binary", "times": "binary"}
#: A part of a long text: its bytes from A's begin to B's end, and B's begin and A's end in them.
RANGE = {"doc": "long", "doc_id": "long", "part": "int", "n_parts": "int", "at": "long", "b_begin": "int", "a_end": "int", "text": "binary"}
_TOKENS = ["prefix_a", "prefix_b", "suffix_a", "suffix_b"]
FRAGMENT = {"doc": "long", "doc_id": "long", "part": "int", "good": "boolean", "closed": "boolean", "n_a": "long", "n_b": "long", "n_groups": "long", "text": "binary", "codes": "binary", "times": "binary"}
FRAGMENT |= {f"{x}_{y}": "binary" for x in _TOKENS for y in ("ids", "ends")}
RESULT = {"doc_id": "long", "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "n_best": "long", "count_sum": "long", "groups_sha256": "string"}

_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}


def _ddl(schema: dict[str, str]) -> str:
    return ", ".join(f"{k} {v}" for k, v in schema.items())


def _batch(rows: list[dict], schema: dict[str, str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([(k, _KINDS[v]) for k, v in schema.items()]))


def _table(rows: list[dict], schema: dict[str, str]) -> pa.Table:
    return pa.Table.from_batches([_batch(rows, schema)])


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Tokenizers:
    """Both tokenizers, and the bytes of each of their ids."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a), sentencepiece.SentencePieceProcessor(model_file=b)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.space = self.b.piece_to_id("▁")
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", x) for x in names):
            raise ValueError("a piece goes over the begin of a word")
        parts = [bytes([int(x[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", x) else x.replace("▁", " ").encode() for x in names]
        self.a_bytes, self.b_bytes = pieces(a), Packed(np.array([len(x) for x in parts]), np.frombuffer(b"".join(parts), np.uint8))

    def encode_a(self, texts: list[bytes]) -> list[list[int]]:
        return [x.ids for x in self.a.encode_batch_fast([x.decode() for x in texts], add_special_tokens=False)]

    def encode_b(self, texts: list[bytes]) -> list[list[int]]:
        """Of texts that begin with a space, which B puts there itself, but not before an empty text."""
        found = self.b.encode([x[1:].decode() for x in texts], num_threads=1)
        return [ids if len(x) > 1 else [self.space] for ids, x in zip(found, texts, strict=True)]

    def tokens(self, of: Packed, found: list[list[int]], at: int = 0) -> Tokens:
        ids = np.array([i for x in found for i in x], np.int64)
        return Tokens(ids, at + np.cumsum(of.lengths[ids]))


@functools.lru_cache(maxsize=2)
def tokenizers(a: str, b: str) -> Tokenizers:
    return Tokenizers(a, b)


def split(text: bytes) -> list[bytes]:
    """The words of a text that follows a space, each without the space that it begins with."""
    if _WIDE.search(text):
        return [x[1:] for x in _CUT_ANY.split(b" " + text)]
    if text[:1] != b" " and not _PLAIN.search(text):
        return text.split(b" ")
    return [x[1:] for x in _CUT.split(b" " + text)]


class Words:
    """The groups and links of the words that this worker met lately, by number."""

    def __init__(self, both: Tokenizers):
        self.both = both
        self.clear()

    def clear(self) -> None:
        self.number, self.held = Numbers(), 0
        #: A word's groups as text, each with a semicolon after it; its tokens of A, of B and its groups; its links.
        self.texts: list[bytes] = []
        self.sizes, self.bad = np.empty((0, 3), np.int64), np.empty(0, bool)
        self.codes = Packed(np.empty(0, np.int64), np.empty(0, np.int64))

    def numbers(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """The numbers of the words of each text; new ones are looked up together."""
        look, before = self.number.__getitem__, len(self.number)
        found = [np.fromiter(map(look, words), np.int64) for words in texts]
        new = list(itertools.islice(self.number, before, None))
        for at in range(0, len(new), CALL):
            self._add([b" " + w for w in new[at : at + CALL]])
        return found

    def _add(self, words: list[bytes]) -> None:
        both = self.both
        (a_ids, a_cuts), (b_ids, b_cuts) = joined_ids(words, both.encode_a, both.a_bytes.lengths), joined_ids(words, both.encode_b, both.b_bytes.lengths)
        good = self._good(words, a_ids, a_cuts, b_ids, b_cuts)
        n_a, n_b = np.diff(a_cuts) * good, np.diff(b_cuts) * good
        a, b = (Tokens(ids, np.cumsum(of.lengths[ids])) for ids, of in ((a_ids[np.repeat(good, np.diff(a_cuts))], both.a_bytes), (b_ids[np.repeat(good, np.diff(b_cuts))], both.b_bytes)))
        common, links = met(a, b), linked(a, b)
        lines = group_lines(a, b, common)
        ends = np.cumsum(np.array([len(w) for w in words], np.int64) * good)
        cut = lambda n: np.diff(n, prepend=0)
        n_groups = cut(np.searchsorted(common, ends, "right"))
        n_links = n_a + n_b - n_groups  # an end of either is a link's end, and the common ones are the groups'
        to = np.cumsum(n_groups).tolist()
        texts = [b"".join(lines[i:j]) for i, j in zip([0, *to[:-1]], to, strict=True)]
        self.texts += texts
        self.sizes = np.concatenate([self.sizes, np.column_stack([n_a, n_b, n_groups])])
        self.bad = np.concatenate([self.bad, ~good])
        self.codes = Packed(np.concatenate([self.codes.lengths, n_links]), np.concatenate([self.codes.flat, links]))
        self.held += 250 * len(words) + int(ends[-1]) + sum(map(len, texts)) + links.nbytes

    def _good(self, words: list[bytes], a_ids: np.ndarray, a_cuts: np.ndarray, b_ids: np.ndarray, b_cuts: np.ndarray) -> np.ndarray:
        """Whether both tokenizers give a word's bytes back."""
        whole, sizes = b"".join(words), np.array([len(w) for w in words], np.int64)
        good = np.ones(len(words), bool)
        for ids, cuts, of in ((a_ids, a_cuts, self.both.a_bytes), (b_ids, b_cuts, self.both.b_bytes)):
            data = of.joined(ids).tobytes()
            if data != whole:
                ends = np.concatenate([[0], np.cumsum(of.lengths[ids])])[cuts]
                good &= np.array([data[i:j] == w for i, j, w in zip(ends[:-1].tolist(), ends[1:].tolist(), words, strict=True)])
            elif (np.concatenate([[0], np.cumsum(of.lengths[ids])])[cuts[1:]] != np.cumsum(sizes)).any():
                raise AssertionError("tokens over the begin of a word")
        return good

    def text(self, numbers: np.ndarray) -> bytes:
        return b"".join(map(self.texts.__getitem__, numbers.tolist()))[:-1]

    def closed(self, numbers: np.ndarray) -> Fragment:
        """Words in a row; both tokenizers end before the first."""
        if not len(numbers):
            return Fragment()
        n_a, n_b, n_groups = self.sizes[numbers].sum(axis=0).tolist()
        codes, times = tallied(self.codes.joined(numbers))
        return Fragment(Tokens(), Tokens(), True, n_a, n_b, n_groups, self.text(numbers), codes, times)


_words: dict[tuple[str, str], Words] = {}


def _known(a: str, b: str) -> Words:
    return _words.setdefault((a, b), Words(tokenizers(a, b)))


class Page:
    """Documents to be packed into a row."""

    def __init__(self):
        self.size, self.rows = 0, []

    def add(self, doc_id: int | None, sizes: tuple[int, int, int, int], digest: bytes, numbers: np.ndarray, size: int) -> None:
        self.rows.append((NO_ID if doc_id is None else doc_id, *sizes, digest, numbers))
        self.size += size

    def packed(self, codes_of: Packed, times: np.ndarray | None = None) -> dict:
        """One row; ``times`` if the links of the words come more than once each (all words are in use then), else it is empty."""
        ids, n_a, n_b, n_groups, n_links, digests, numbers = zip(*self.rows, strict=True)
        words = np.concatenate(numbers).astype(np.int64)
        own = np.unique(words)
        # numbers of two bytes where they fit
        place = np.zeros(int(own[-1]) + 1 if len(own) else 0, "<u2" if len(own) <= 1 << 16 else "<u4")
        place[own] = np.arange(len(own))
        flat = codes_of.joined(own)
        times = flat[:0] if times is None else times
        binary = {"ids": ids, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links}
        row = {k: np.array(v, "<i8").tobytes() for k, v in binary.items()}
        row |= {"page": uuid.uuid4().int >> 65, "digests": b"".join(digests), "n_words": np.array([len(x) for x in numbers], "<i8").tobytes(), "words": place[words].tobytes()}
        return row | {"n_codes": codes_of.lengths[own].astype("<i4").tobytes(), "codes": flat.tobytes(), "times": times.tobytes()}


NOTHING = ((0, 0, 0, 0), bytes(32), np.empty(0, np.int64))


def _ranges(text: bytes, size: int) -> Iterator[dict]:
    """The parts of a long text that follows a space."""
    text, at, ends = b" " + text, 0, [(0, 0)]
    while at < len(text):
        a = _A_END.search(text, at + size)
        b = _B_END.search(text, a.start()) if a else None
        at = b.start() if b else len(text)
        ends.append((a.start(), at) if b else (at, at))
    for part, ((a0, b0), (a1, b1)) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        yield {"part": part, "n_parts": len(ends) - 1, "at": a0, "b_begin": b0 - a0, "a_end": a1 - a0, "text": text[a0:b1]}


def _grouped(batch: pa.RecordBatch, most: int) -> Iterator[list[tuple[int | None, bytes]]]:
    """The documents of a batch, some at a time: up to so many bytes, or one longer text."""
    group: list[tuple[int | None, bytes]] = []
    size = 0
    for doc_id, x in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
        text = x.as_buffer().to_pybytes()
        if group and size + len(text) > most:
            yield group
            group, size = [], 0
        group.append((doc_id, text))
        size += len(text)
    if group:
        yield group


def _dealt(a: str, b: str):
    """Pages of the short documents, and the parts of the long ones."""
    schema = PAGE | RANGE

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, page = _known(a, b), Page()
        for batch in batches:
            for docs in _grouped(batch, GROUP):
                if len(docs[0][1]) > LONG:  # alone in its group
                    doc = uuid.uuid4().int >> 65
                    for part in _ranges(docs[0][1], PART):
                        yield _batch([part | {"doc": doc, "doc_id": docs[0][0]}], schema)
                    continue
                for (doc_id, text), numbers in zip(docs, known.numbers([split(text) if text else [] for _, text in docs]), strict=True):
                    if not len(numbers) or known.bad[numbers].any():
                        page.add(doc_id, *NOTHING, len(text))
                        continue
                    n_a, n_b, n_groups = known.sizes[numbers].sum(axis=0).tolist()
                    page.add(doc_id, (n_a, n_b, n_groups, n_a + n_b - n_groups), hashlib.sha256(known.text(numbers)).digest(), numbers.astype(np.int32), len(text))
                if page.size > PAGE_BYTES or known.held > KNOWN_BYTES:
                    if page.rows:
                        yield _batch([page.packed(known.codes)], schema)
                        page = Page()
                    if known.held > KNOWN_BYTES:
                        known.clear()
        if page.rows:
            yield _batch([page.packed(known.codes)], schema)
        known.clear()  # the worker goes on with other work

    return deal


def _to_row(x: Fragment) -> dict:
    row = {"closed": x.closed, "n_a": x.n_a, "n_b": x.n_b, "n_groups": x.n_groups, "text": x.text, "codes": x.codes.tobytes(), "times": x.times.tobytes()}
    return row | {f"{k}_{y}": getattr(getattr(x, k), y).astype(np.int64).tobytes() for k in _TOKENS for y in ("ids", "ends")}


def _from_row(row: dict) -> Fragment:
    read = lambda name: np.frombuffer(row[name], np.int64)
    sides = {k: Tokens(read(f"{k}_ids"), read(f"{k}_ends")) for k in _TOKENS}
    return Fragment(closed=row["closed"], n_a=row["n_a"], n_b=row["n_b"], n_groups=row["n_groups"], text=row["text"], codes=read("codes"), times=read("times"), **sides)


def part_fragment(known: Words, text: bytes, at: int, b_begin: int, a_end: int) -> Fragment | None:
    """The fragment of a part; None if B does not give its bytes back.

    The part is what A alone has at its begin, the words that both have whole, and what is left of
    A and of B, which has more.
    """
    both = known.both
    middle = text.rfind(b" ", b_begin + 1, a_end) if a_end < len(text) else len(text)
    while b_begin < middle < len(text) and not 33 <= text[middle - 1] <= 126:
        middle = text.rfind(b" ", b_begin + 1, middle)
    middle = max(middle, b_begin)
    lead = both.tokens(both.a_bytes, both.encode_a([text[:b_begin]]), at) if b_begin else Tokens()
    total = Fragment(prefix_a=lead)
    if middle > b_begin:
        words = split(text[b_begin + 1 : middle])
        (numbers,) = known.numbers([words])
        if known.bad[numbers].any():
            return None
        first = b" " + words[0]
        a, b = both.tokens(both.a_bytes, both.encode_a([first]), at + b_begin), both.tokens(both.b_bytes, both.encode_b([first]), at + b_begin)
        total = total + fragment(a, b) + known.closed(numbers[1:])
    a_rest, b_rest = text[middle:a_end], text[middle:]
    found_a, found_b = both.encode_a([a_rest]) if a_rest else [[]], both.encode_b([b_rest]) if b_rest else [[]]
    if both.b_bytes.joined(np.array(found_b[0], np.int64)).tobytes() != b_rest:
        return None
    return total + fragment(both.tokens(both.a_bytes, found_a, at + middle), both.tokens(both.b_bytes, found_b, at + middle))


def _fragments(a: str, b: str):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(a, b)
        for batch in batches:
            for row in batch.to_pylist():
                found = part_fragment(known, row["text"], row["at"], row["b_begin"], row["a_end"])
                yield _batch([{"doc": row["doc"], "doc_id": row["doc_id"], "part": row["part"], "good": found is not None} | _to_row(found or Fragment())], FRAGMENT)
                if known.held > KNOWN_BYTES:
                    known.clear()

    return make


def _put_together(fan: int):
    def add(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        good = all(r["good"] for r in rows)
        total = functools.reduce(Fragment.__add__, map(_from_row, rows)) if good else Fragment()
        return _table([{"doc": rows[0]["doc"], "doc_id": rows[0]["doc_id"], "part": rows[0]["part"] // fan, "good": good} | _to_row(total)], FRAGMENT)

    return add


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A page for each long document: all its links are those of one word."""
    for batch in batches:
        for row in batch.to_pylist():
            page, whole = Page(), _from_row(row).whole()
            if row["good"]:
                page.add(row["doc_id"], (whole.n_a, whole.n_b, whole.n_groups, int(whole.times.sum())), hashlib.sha256(whole.text).digest(), np.zeros(1, np.int64), 0)
            else:
                page.add(row["doc_id"], *NOTHING, 0)
                whole = Fragment()
            yield _batch([page.packed(Packed(np.array([len(whole.codes)]), whole.codes), whole.times)], PAGE)


def _pages(docs: DataFrame, a: str, b: str) -> DataFrame:
    dealt = materialise(id_and_text(docs).mapInArrow(_dealt(a, b), _ddl(PAGE | RANGE)), large_rows=True)
    pages, ranges = dealt.where("part IS NULL").select(*PAGE), dealt.where("part IS NOT NULL").select(*RANGE)
    longest = ranges.agg(F.max("n_parts")).first()[0]
    if longest is None:
        return pages
    found = ranges.repartition("doc", "part").mapInArrow(_fragments(a, b), _ddl(FRAGMENT))
    while longest > 1:
        found = found.groupBy("doc", F.floor(F.col("part") / FAN).alias("next")).applyInArrow(_put_together(FAN), _ddl(FRAGMENT))
        longest = -(-longest // FAN)
    return pages.unionByName(materialise(found.mapInArrow(_finished, _ddl(PAGE)), large_rows=True))


def _read(row: dict, name: str, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(row[name], kind)


def _words_of(row: dict) -> np.ndarray:
    return _read(row, "words", "<u2" if len(row["n_codes"]) <= 4 << 16 else "<u4")


def _times_of(row: dict) -> np.ndarray | int:
    return _read(row, "times") if row["times"] else 1


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """page, code and n: the links of each page."""
    for batch in batches:
        for row in batch.to_pylist():
            n_codes = _read(row, "n_codes", "<i4")
            met = np.bincount(_words_of(row), minlength=len(n_codes))
            codes, n = tallied(_read(row, "codes"), np.repeat(met, n_codes) * _times_of(row))
            for at in range(0, len(codes), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes[part]), row["page"])), pa.array(codes[part]), pa.array(n[part])], names=["page", "code", "n"])


def _summed(pages: pa.Table, answers: pa.Table) -> pa.Table:
    """The rows of the documents of a page, with what the corpus says of their links."""
    code, count, best = (answers[x].to_numpy() for x in ("code", "count", "best"))
    order = np.argsort(code)
    code, count, best = code[order], count[order], best[order]
    out = []
    for row in pages.to_pylist():
        place = np.searchsorted(code, _read(row, "codes"))
        times, n_codes = _times_of(row), _read(row, "n_codes", "<i4")
        by_word = np.repeat(np.arange(len(n_codes)), n_codes)
        sums = [np.zeros(len(n_codes), np.int64) for _ in range(2)]
        np.add.at(sums[0], by_word, times * best[place])
        np.add.at(sums[1], by_word, times * count[place])
        n_words, words = _read(row, "n_words"), _words_of(row)
        edges = np.concatenate([[0], np.cumsum(n_words)])
        n_best, count_sum = (np.diff(np.concatenate([[0], np.cumsum(x[words])])[edges]) for x in sums)
        ids, digests = _read(row, "ids"), row["digests"]
        sizes = [_read(row, x) for x in ("n_a", "n_b", "n_groups", "n_links")]
        for i, values in enumerate(zip(*[x.tolist() for x in (ids, *sizes, n_best, count_sum)], strict=True)):
            doc_id, n_a, *rest = values
            out.append((None if doc_id == NO_ID else doc_id, n_a, *rest, digests[32 * i : 32 * i + 32].hex() if n_a else ""))
    return pa.table([pa.array(list(x), _KINDS[k]) for x, k in zip(zip(*out, strict=True), RESULT.values(), strict=True)], names=list(RESULT))


def align(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each document."""
    pages = _pages(docs, a or default_path(), b or piece_path())
    # one row for each page and distinct pair in it
    pairs = pages.select("page", "words", "n_codes", "codes", "times").mapInArrow(_pairs, "page long, code long, n long")
    counts = pairs.groupBy("code").agg(F.sum("n").alias("count"))
    # a B id has no more pairs than A has ids
    highest = F.max("count").over(Window.partitionBy(F.col("code").bitwiseAND((1 << B_BITS) - 1)))
    counts = counts.select("code", "count", (F.col("count") == highest).cast("int").alias("best"))
    answers = pairs.select("page", "code").join(counts, "code")
    return pages.groupBy("page").cogroup(answers.groupBy("page")).applyInArrow(_summed, _ddl(RESULT))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir))
