"""Language identification: averaged embeddings of hashed subwords and a linear softmax.

The subwords of a text are its byte strings of 1 to 4 bytes (ASCII letters in lower case, each
run of other ASCII characters as one blank). Each is hashed to a bucket with an embedding; a text
is the mean of its embeddings, and a linear softmax gives the languages. Both are trained by
stochastic gradient descent in numpy. To score, embeddings and softmax weights are multiplied
once, so a text costs one lookup for each subword.

Scores are calibrated with a temperature, and the score under which a prediction should be
rejected is set so that at most FALSE_REJECTS of the right held-back predictions fall under it.

Training reads at most SAMPLE rows and SAMPLE_BYTES of text for each language (those with the
smallest hash of the id; no task sees more of a language than about that many); predictions cover
every document and its whole text.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and rejected; without
training rows every text is ``und``; of languages that score alike the first by name is taken; a
null or repeated id is no obstacle; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nivalis.llm.common import bounded_batches, documents, remainder, sample_texts

SAMPLE, SAMPLE_BYTES = 1500, 16 << 20
EPOCHS, RATE = 5, 0.5
BUCKETS, WIDTH, LONGEST = 1 << 15, 16, 4
FALSE_REJECTS = 0.005
#: Subwords are looked up in slices of so many bytes.
SLICE = 1 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32
_FOLD[65:91] += 32


def folded(text: bytes) -> np.ndarray:
    data = _FOLD[np.frombuffer(text, np.uint8)]
    return data[np.concatenate([[True], (data[1:] != 32) | (data[:-1] != 32)])] if len(data) else data


def buckets(data: np.ndarray, starts: int) -> np.ndarray:
    """The buckets of all subwords of a folded text that begin at one of the first ``starts`` bytes."""
    out = []
    h = np.zeros(len(data), np.uint32)
    for n in range(LONGEST):
        if len(data) <= n:
            break
        h = (h[: len(data) - n] + data[n:] + np.uint32(1)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        out.append((h[:starts] + np.uint32(n * 0x5EBCA6B)) >> np.uint32(7) & np.uint32(BUCKETS - 1))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def slices(text: bytes) -> Iterator[np.ndarray]:
    """The buckets of all subwords of a text, in parts."""
    data = folded(text)
    for at in range(0, len(data), SLICE):
        yield buckets(data[at : at + SLICE + LONGEST - 1], SLICE)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (BUCKETS, languages): embeddings times softmax weights
    bias: np.ndarray
    temperature: float
    limit: float

    def logits(self, text: bytes) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for own in slices(text):
            times = np.bincount(own, minlength=BUCKETS) if len(own) > BUCKETS else None
            total += times @ self.table if times is not None else self.table[own].sum(axis=0)
            n += len(own)
        return total / max(n, 1) + self.bias

    def scores(self, texts: list[bytes]) -> np.ndarray:
        z = np.array([self.logits(t) for t in texts]).reshape(-1, len(self.languages)) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def fit(texts: list[bytes], langs: list[str], seed: int = 1) -> Model | None:
    languages = sorted(set(langs))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    y = np.array([languages.index(x) for x in langs])
    rows = [np.unique(np.concatenate([np.empty(0, np.uint32), *slices(t)]), return_counts=True) for t in texts]
    held = rng.random(len(rows)) < 0.2
    e, w, b = rng.normal(0, 0.1, (BUCKETS, WIDTH)), np.zeros((WIDTH, len(languages))), np.zeros(len(languages))
    w += rng.normal(0, 0.1, w.shape)
    own = np.flatnonzero(~held)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(own):
            ids, times = rows[i]
            if not len(ids):
                continue
            share = (times / times.sum())[:, None]
            mean = (e[ids] * share).sum(axis=0)
            z = mean @ w + b
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = w @ p
            w -= rate * np.outer(mean, p)
            b -= rate * 0.1 * p
            e[ids] -= rate * np.sqrt(len(ids)) * share * back
    model = Model(languages, (e @ w).astype(np.float64), b, 1.0, 0.0)
    back = np.flatnonzero(held)
    if len(back):
        z = np.array([model.logits(texts[i]) for i in back])

        def loss(t: float) -> float:
            s = z / t
            s = s - s.max(axis=1, keepdims=True)
            return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(back)), y[back]]).mean())

        model.temperature = min((2.0**k for k in np.arange(-4, 4.1, 0.25)), key=loss)
        p = model.scores([texts[i] for i in back])
        right = p.argmax(axis=1) == y[back]
        if right.any():
            model.limit = float(np.quantile(p.max(axis=1)[right], FALSE_REJECTS))
    return model


def fit_on(docs: DataFrame, allowed, sample: int = SAMPLE) -> Model | None:
    """A model fitted on at most ``sample`` documents of each language, among those ``allowed``."""
    docs = docs.where(allowed & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("lang").cast("string").alias("label")).distinct()
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    # the smallest hashes lie below this share of all; a fifth and a hundred more leave room for chance
    share = F.shiftrightunsigned(F.xxhash64("id"), 11) / F.lit(2.0**53)
    few = rows.join(F.broadcast(counts), "label").where(share * F.col("n") < 1.2 * sample + 100)
    first = F.row_number().over(Window.partitionBy("label").orderBy(share, "id"))
    chosen = few.withColumn("first", first).where(F.col("first") <= sample).select("id", "label")
    found = sample_texts(docs, chosen, SAMPLE_BYTES)
    return fit([t.encode() for t in found["text"]], found["label"].to_list())


def predict(docs: DataFrame, model: Model | None, fold) -> DataFrame:
    """doc_id, held_out (from ``fold``), lang_pred, score and rejected of each document."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = batch["lettered"].to_numpy(zero_copy_only=False)
            texts = [x.as_buffer().to_pybytes() if y else b"" for x, y in zip(batch["text"], lettered, strict=True)]
            if model is None:
                found, best = ["und"] * len(texts), np.zeros(len(texts))
            else:
                p = model.scores(texts)
                found = [model.languages[i] if y else "und" for i, y in zip(p.argmax(axis=1), lettered, strict=True)]
                best = np.where(lettered, p.max(axis=1), 0.0)
            rejected = best < model.limit if model else np.ones(len(texts), bool)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(found, pa.string()), pa.array(best), pa.array(rejected | (best == 0))], names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    bounded_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fold.alias("held_out"), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    return rows.mapInArrow(report, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = remainder(F.col("doc_id"), 4) == 2
    return predict(docs, fit_on(docs, ~held), held)
