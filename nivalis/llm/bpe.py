"""Byte-level BPE encoding and decoding through a table of distinct words.

Texts are split where white space follows something else, so a word carries the white space
before it. The tokenizer never merges across these places: encoding the words one by one gives
the ids of the whole text. Each block of texts sends its distinct words to their owners, each
owner encodes a word once however many blocks hold it, and the ids come back in the order of the
block's words and are joined to the texts by position. Decoding joins each id to its piece, whose
table has a row for each entry of the vocabulary and is held in every task.

An owner keeps the ids of its last CACHED words, so its memory does not grow with the data; past
that it may encode a word again. A block is encoded and decoded page by page.

Defined cases: a null text is empty and has no ids; a null id or repeated rows are encoded like
any other, one result for each row; the string of a special token in a text becomes that token,
as the tokenizer's own encode does; other columns are ignored.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nivalis.llm import blocks
from nivalis.llm.common import bounded_batches, documents, id_and_text

#: White space: in ASCII, and (as UTF-8, and as characters) all of Unicode's.
_WORD = re.compile(rb"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
_WIDE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_SPACES = "\t-\r \x85\xa0  -     　"
_WIDE_WORD = re.compile(f"[{_SPACES}]*[^{_SPACES}]+|[{_SPACES}]+")

#: Words encoded in one call, words whose ids an owner keeps, and tokens decoded at once.
CALL, CACHED, TOKENS = 4096, 500_000, 1 << 18

WORDS = pa.struct([("n", pa.int32()), ("sizes", pa.binary()), ("data", pa.binary())])


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


class Packed:
    """Many short arrays in one: the first place, the length, and the values of all."""

    def __init__(self, lengths: np.ndarray, flat: np.ndarray):
        self.lengths, self.flat = lengths.astype(np.int64), flat
        self.first = np.cumsum(self.lengths) - self.lengths

    def joined(self, which: np.ndarray) -> np.ndarray:
        """The values of the arrays ``which``, one after another."""
        n = self.lengths[which]
        ends = np.cumsum(n)
        return self.flat[np.repeat(self.first[which] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]


@functools.lru_cache(maxsize=4)
def pieces(path: str) -> Packed:
    """The bytes of each id. In the vocabulary, bytes that do not print stand as characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    known = tokenizer(path)
    names = (known.id_to_token(i) or "" for i in range(known.get_vocab_size(with_added_tokens=True)))
    parts = [bytes(of[c] for c in name) if all(c in of for c in name) else name.encode() for name in names]
    return Packed(np.array([len(x) for x in parts]), np.frombuffer(b"".join(parts), np.uint8))


def decoded(ids: np.ndarray, path: str) -> Iterator[str]:
    """The text of ids, in parts."""
    reader = codecs.getincrementaldecoder("utf-8")("replace")
    for at in range(0, len(ids), TOKENS):
        yield reader.decode(pieces(path).joined(ids[at : at + TOKENS]).tobytes())
    yield reader.decode(b"", final=True)


def split_words(text: bytes) -> list[bytes]:
    """The words of a text, each with the white space before it; joined they are the text."""
    if _WIDE.search(text):
        return [x.encode() for x in _WIDE_WORD.findall(text.decode())]
    return _WORD.findall(text)


def _by_owner(words: Iterable[bytes], n: int) -> dict[int, list[bytes]]:
    dealt: dict[int, list[bytes]] = {}
    for word in sorted(words):
        dealt.setdefault(blocks.owner(word, n), []).append(word)
    return dealt


def _distinct(table: pa.Table) -> set[bytes]:
    found: set[bytes] = set()
    for _, _, texts in blocks.read(table):
        for text in texts:
            found.update(split_words(text))
    return found


def _indexed(table: pa.Table) -> tuple[dict[bytes, int], list[tuple[list, list[np.ndarray]]]]:
    """A number for each word of a block; and for each page its ids and the words of each text by number."""
    number: dict[bytes, int] = {}
    out = []
    for doc_ids, _, texts in blocks.read(table):
        out.append((doc_ids, [np.array([number.setdefault(w, len(number)) for w in split_words(x)], np.int32) for x in texts]))
    return number, out


def _numbers(x: list[int]) -> bytes:
    """One byte for each number, or four for all if one is large; the reader knows how many there are."""
    return np.array(x, "<u4" if max(x, default=0) > 255 else "<u1").tobytes()


def _from_numbers(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u4" if len(data) > n else "<u1")


def _squeezed(words: list[bytes]) -> dict:
    return {"n": len(words), "sizes": _numbers([len(w) for w in words]), "data": zstandard.compress(b"".join(words), 3)}


def _words(row: dict) -> list[bytes]:
    ends = np.cumsum(_from_numbers(row["sizes"], row["n"]), dtype=np.int64).tolist()
    data = zstandard.decompress(row["data"])
    return [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _sent(n: int):
    def send(table: pa.Table) -> pa.Table:
        dealt = _by_owner(_distinct(table), n)
        return pa.table(
            [pa.array(list(dealt), pa.int32()), pa.array([table["block"][0].as_py()] * len(dealt), pa.int32()), pa.array([_squeezed(x) for x in dealt.values()], WORDS)],
            names=["owner", "block", "words"],
        )

    return send


def _encoded(path: str):
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bytes] = {}
        for batch in batches:
            for row in batch.to_pylist():
                words = _words(row["words"])
                new = [w for w in words if w not in known]
                if len(known) + len(new) > CACHED:
                    known, new = {}, words
                for at in range(0, len(new), CALL):
                    part = new[at : at + CALL]
                    found = tokenizer(path).encode_batch([w.decode() for w in part], add_special_tokens=False)
                    known |= {w: np.array(x.ids, "<u4").tobytes() for w, x in zip(part, found, strict=True)}
                ids = np.frombuffer(b"".join([known[w] for w in words]), "<u4")
                small = ids.astype("<u2") if ids.max(initial=0) < 1 << 16 else ids
                columns = [[row["block"]], [row["owner"]], [_numbers([len(known[w]) // 4 for w in words])], [small.tobytes()]]
                kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["block", "owner", "counts", "ids"])

    return answer


def _answered(number: dict[bytes, int], answers: pa.Table, n: int) -> tuple[Packed, np.ndarray]:
    """The ids of a block's words as their owners sent them, and the place there of each number."""
    dealt = _by_owner(number, n)
    place, counts, flat, at = np.zeros(len(number), np.int64), [], [], 0
    for row in answers.to_pylist():
        own = dealt[row["owner"]]
        place[[number[w] for w in own]] = np.arange(at, at + len(own))
        counts.append(_from_numbers(row["counts"], len(own)).astype(np.int64))
        flat.append(np.frombuffer(row["ids"], "<u2" if len(row["ids"]) == 2 * counts[-1].sum() else "<u4").astype("<u4"))
        at += len(own)
    none = np.empty(0, "<u4")
    return Packed(np.concatenate([none, *counts]), np.concatenate([none, *flat])), place


def _joined(texts: DataFrame, path: str, result: Callable[[np.ndarray], tuple], fields: list[tuple[str, pa.DataType]], schema: str) -> DataFrame:
    """doc_id and result(ids) of each document, which has the columns ``fields``."""
    n = blocks.count(texts)
    packed = blocks.pages(texts.withColumn("fold", F.lit(0)), n)
    sent = packed.groupBy("block").applyInArrow(_sent(n), "owner int, block int, words struct<n:int,sizes:binary,data:binary>")
    answers = sent.repartition(n, "owner").mapInArrow(_encoded(path), "block int, owner int, counts binary, ids binary")

    def join(table: pa.Table, own: pa.Table) -> pa.Table:
        number, read = _indexed(table)
        ids, place = _answered(number, own, n)
        rows = [(doc_id, *result(ids.joined(place[words]))) for doc_ids, texts in read for doc_id, words in zip(doc_ids, texts, strict=True)]
        kinds = [("doc_id", pa.int64()), *fields]
        return pa.table([pa.array(list(x), k) for x, (_, k) in zip(zip(*rows, strict=True), kinds, strict=True)], names=[name for name, _ in kinds])

    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(join, schema)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (array<int>) of each document."""
    return _joined(id_and_text(docs), path or default_path(), lambda ids: (ids.astype("<i4"),), [("ids", pa.list_(pa.int32()))], "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of each row of (doc_id, ids), through the table of pieces."""
    path = path or default_path()
    bounded_batches(encoded.sparkSession)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["".join(decoded(np.array(ids or [], np.int64), path)) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(look_up, "doc_id long, text string")


def encoding_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document."""
    path = path or default_path()

    def digests(ids: np.ndarray) -> tuple[int, str, str]:
        text = hashlib.sha256()
        for part in decoded(ids, path):
            text.update(part.encode())
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), text.hexdigest()

    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    return _joined(id_and_text(docs), path, digests, fields, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_report(documents(spark, sf_dir))
