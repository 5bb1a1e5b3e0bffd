"""Quality classifier by compression with two dictionaries.

One zstandard dictionary is built from texts labelled good, one from texts labelled bad. A text
resembles the class whose dictionary shortens it more: the difference of its two compressed
sizes, per byte of text, is calibrated by logistic regression to the probability of label 1.

Fitting reads at most SAMPLE labelled rows and SAMPLE_BYTES of whole text of each label (those with
the smallest hash of the id), half for the dictionaries and half for the calibration, from rows
whose fold is not ``skip``; scores cover every document and its whole text.

Defined cases: a null text is empty; empty texts score the share of label 1 among labelled empty
texts, drawn towards the share among all by one row's weight (without any, that share); without
labelled rows of both kinds every score is the share of label 1 (0.5 without any); rows whose id
is null or repeated get their own results; an id that ``labels`` repeats counts once for each
label; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nivalis.llm.common import bounded_batches, documents, labels, remainder, sample_texts

SAMPLE, SAMPLE_BYTES, PIECE = 4000, 16 << 20, 400
DICTIONARY_BYTES, LEVEL = 112_640, 3
CUT = 0.3


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False)


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    empty: float  # the score of an empty text

    def features(self, texts: list[bytes]) -> np.ndarray:
        """For each text, its size difference per byte, as it is and by its length."""
        if not self.good:
            return np.zeros((len(texts), 2))
        good, bad = _compressor(self.good), _compressor(self.bad)
        length = np.array([len(x) for x in texts], float)
        saved = np.array([len(bad.compress(x)) - len(good.compress(x)) for x in texts], float)
        per_byte = saved / np.maximum(length, 1)
        return np.stack([per_byte * 10, per_byte * np.log1p(length)], axis=1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        z = self.features(texts) @ np.array(self.weights[1:]) + self.weights[0]
        return np.where([len(x) > 0 for x in texts], 1 / (1 + np.exp(-np.clip(z, -30, 30))), self.empty)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Intercept and weights by Newton's method, lightly held to 0."""
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    w, hold = np.zeros(x.shape[1]), np.diag([1e-6, *[0.05] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold, x.T @ (y - p) - hold @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _dictionary(texts: list[bytes]) -> bytes:
    pieces = [t[i : i + PIECE] for t in texts for i in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few samples to choose from: the texts themselves serve
        return b"".join(pieces)[-DICTIONARY_BYTES:]


def fit(texts: list[bytes], good: np.ndarray, calibrate: np.ndarray) -> Model:
    """Dictionaries from the rows not in ``calibrate``, weights from those in it."""
    share = float(good.mean()) if len(good) else 0.5
    full = np.array([len(t) > 0 for t in texts], bool)
    empty = float((good[~full].sum() + share) / ((~full).sum() + 1))
    own = {label: [t for t, g, c in zip(texts, good, calibrate, strict=True) if g == label and not c and t] for label in (True, False)}
    if not own[True] or not own[False]:
        return Model(b"", b"", (float(np.log((share + 1e-3) / (1 - share + 1e-3))), 0.0, 0.0), empty)
    held = calibrate & full
    held = held if len(set(good[held].tolist())) == 2 else full
    model = Model(_dictionary(own[True]), _dictionary(own[False]), (), empty)
    x = model.features([t for t, h in zip(texts, held, strict=True) if h])
    model.weights = tuple(_logistic(x, good[held].astype(float)).tolist())
    return model


def fit_on_labels(docs: DataFrame, marks: DataFrame, allowed=None, sample: int = SAMPLE) -> Model:
    """A model fitted on at most ``sample`` rows of each label; ``allowed`` is a condition on ``id``."""
    marks = marks.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("label")).distinct()
    if allowed is not None:
        marks = marks.where(allowed)
    order = [F.xxhash64("id"), F.col("id")]
    marks = marks.where("label = 1").orderBy(*order).limit(sample).unionByName(marks.where("label = 0").orderBy(*order).limit(sample))
    found = sample_texts(docs, marks, SAMPLE_BYTES)
    held = np.array([crc32(str(i).encode(), 3) % 2 == 0 for i in found["id"]], bool)
    return fit([t.encode() for t in found["text"]], found["label"].to_numpy() == 1, held)


def score(docs: DataFrame, model: Model, fold) -> DataFrame:
    """doc_id, held_out (from the column ``fold``), score and predicted of each document."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores([x.as_buffer().to_pybytes() if x.is_valid else b"" for x in batch["text"]])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(scores), pa.array((scores >= CUT).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fold.alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(report, "doc_id long, held_out boolean, score double, predicted int")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit_on_labels(docs, labels(spark, sf_dir), remainder(F.col("id"), 5) != 0)
    return score(docs, model, remainder(F.col("doc_id"), 5) == 0)
