"""Toxicity by compression distance: two zstandard dictionaries and calibrated thresholds.

Both dictionaries are learned from a bounded sample of labelled texts (`SAMPLE` rows of each
class, of a longer text `TEXT_BYTES` spread evenly over it), without near copies, which would make any of their words look typical of a class:

* the ordinary one is trained on windows of ordinary texts, at most `TRAIN_WINDOWS` of them,
  spread evenly over all ordinary texts of the sample;
* the toxic one is made of what toxic texts repeat and ordinary texts lack, in front of the
  ordinary content, so that on ordinary windows both compress alike and only toxic material
  makes a difference.

Every text is cut into windows of about 160 bytes, at blanks, and each window is compressed
with both.  The gain of a window is the number of bytes by which the toxic dictionary is
better.  A logistic curve over the gains of a text (mean, largest, share and number above a
threshold) is fitted on texts that took no part in making the dictionaries.

Defined results: a null text is the empty text and has no windows, so its score is that of no
gains; without labelled rows of both classes every score is 0; equal rows are scored each;
null ids are kept; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventgauge.llm.shared import fold, labelled_sample, steps, texts

#: Labelled rows of each class that are used at most.
SAMPLE = 4000
#: Bytes of a labelled text that are used at most.
TEXT_BYTES = 32 << 10
#: Windows the ordinary dictionary is trained on at most.
TRAIN_WINDOWS = 60_000
WINDOW = 160
ORDINARY_BYTES = 110_000
TOXIC_BYTES = 16 << 10
GAIN = 3
LEVEL = 8
WORD = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    """The lower-cased text in windows that end at the first blank after `size` bytes."""
    data, out, start = text.lower().encode(), [], 0
    while start < len(data):
        stop = data.find(b" ", start + size)
        stop = len(data) if stop < 0 else stop
        out.append(data[start:stop])
        start = stop
    return out


def evenly(items: Sequence, most: int) -> list:
    """All of a list, or as many as allowed at equal distances."""
    return list(items) if len(items) <= most else [items[i * len(items) // most] for i in range(most)]


def spread(text: str, most: int = TEXT_BYTES) -> str:
    """The text, or pieces of the size of a window from all over it."""
    data = text.encode()
    if len(data) <= most:
        return text
    starts = evenly(range(0, len(data), WINDOW), max(1, most // (WINDOW + 1)))
    return b" ".join(data[s : s + WINDOW] for s in starts).decode(errors="ignore")


@dataclass(frozen=True)
class Model:
    """The two dictionaries and the logistic curve; small, so it goes to every task."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...] = ()

    def gains(self, text: str) -> np.ndarray:
        ordinary, toxic = _compressors(self)
        return np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows(text)])

    def score(self, text: str) -> float:
        if not self.weights:
            return 0.0
        z = float(np.dot(self.weights, features(self.gains(text))))
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


_HELD: dict[tuple[bytes, bytes], tuple] = {}


def _compressors(model: Model) -> tuple:
    key = (model.ordinary, model.toxic)
    if key not in _HELD:
        _HELD.clear()
        made = []
        for content in (model.ordinary, model.toxic + model.ordinary):
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            options = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, dict_size=len(content), source_size=WINDOW, min_match=4, write_content_size=False,
                write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            )
            data.precompute_compress(compression_params=options)
            made.append(zstandard.ZstdCompressor(dict_data=data, compression_params=options))
        _HELD[key] = tuple(made)
    return _HELD[key]


def features(gains: np.ndarray) -> np.ndarray:
    if not len(gains):
        return np.array([1.0, 0, 0, 0, 0])
    high = gains >= GAIN
    return np.array([1.0, gains.mean(), gains.max() / 4, high.mean() * 4, np.log1p(high.sum())])


def _words(text: str) -> list[bytes]:
    return WORD.findall(text.lower().encode())


def without_near_copies(given: list[str]) -> list[str]:
    """Texts that share none of four minima over their five-word shingles with an earlier one."""
    seen: set[tuple[int, int]] = set()
    out = []
    for text in given:
        words = _words(text)
        shingles = [b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
        minima = {(s, min(zlib.crc32(x, s) for x in shingles)) for s in range(4)}
        if not minima & seen:
            out.append(text)
        seen |= minima
    return out


def dictionaries(toxic: list[str], ordinary: list[str]) -> Model:
    in_toxic: Counter = Counter()
    in_ordinary: Counter = Counter()
    for text in toxic:
        in_toxic.update(set(_words(text)))
    for text in ordinary:
        in_ordinary.update(set(_words(text)))
    least = max(2, 0.004 * len(toxic))
    own = [
        w for w, n in in_toxic.items()
        if n >= least and n / len(toxic) > 8 * (in_ordinary[w] + 1) / len(ordinary)
    ]
    # What is most frequent comes last, nearest to the window.
    own.sort(key=lambda w: (in_toxic[w], w))
    content = (b" " + b" ".join(own) + b" ")[-TOXIC_BYTES:]
    samples = evenly([w for text in ordinary for w in windows(text)], TRAIN_WINDOWS)
    try:
        base = zstandard.train_dictionary(ORDINARY_BYTES, samples).as_bytes()[-ORDINARY_BYTES:]
    except (zstandard.ZstdError, ValueError):  # too little to train on
        base = b"".join(samples)[-ORDINARY_BYTES:]
    return Model(base or b" ", content)


def logistic(rows: np.ndarray, labels: np.ndarray, penalty: float = 0.3, rounds: int = 30) -> np.ndarray:
    """Newton's method for a logistic regression with a small quadratic penalty."""
    weights = np.zeros(rows.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (labels - p) - penalty * weights
        curve = (rows * (p * (1 - p) + 1e-9)[:, None]).T @ rows + penalty * np.eye(len(weights))
        weights = weights + np.linalg.solve(curve, slope)
    return weights


def train(rows: list[tuple[int, str, int]]) -> Model:
    """A model from (id, text, label) rows; every third text is kept for the calibration."""
    rows = sorted(rows, key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0]))
    kept = {k: without_near_copies([r[1] for r in rows if r[2] == k]) for k in (0, 1)}
    if min(map(len, kept.values())) < 3:
        return Model(b" ", b" ")
    model = dictionaries(*([t for i, t in enumerate(kept[k]) if i % 3] for k in (1, 0)))
    held = [(t, k) for k in (0, 1) for t in kept[k][::3]]
    data = np.array([features(model.gains(t)) for t, _ in held])
    weights = logistic(data, np.array([k for _, k in held], float))
    return Model(model.ordinary, model.toxic, tuple(weights.tolist()))


def fitted(documents: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> Model:
    """Learned from the labels of the rows outside the held-out fold."""
    sample = labelled_sample(documents, labels, "toxic", per_class, fold("doc_id") != 0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            bounded = pa.array([spread(t) for t in batch.column("text").to_pylist()], pa.string())
            columns = [batch.column("doc_id"), bounded, batch.column("label")]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "label"])

    rows = sample.select("doc_id", "text", "label").mapInArrow(work, "doc_id long, text string, label int").collect()
    return train([(r["doc_id"], r["text"], r["label"]) for r in rows])


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            scores = [model.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    found = texts(documents).mapInArrow(work, "doc_id long, score double")
    return found.select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def ordinary_documents(documents: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns; no shuffle."""
    names = documents.columns
    place = names.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, names[place]):
            keep = [model.score(t or "") < 0.5 for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(work, documents.schema)
