"""Language-model scores: the probability of a text over all its segmentations into pieces.

1. Every scan batch becomes one row: the ids of its documents, its distinct words, and its
   tokens as codes of those words.  Texts never move; what moves are distinct words of batches.
2. Words are dealt by hash to buckets, where their training counts of all batches are added up.
3. The weights of the pieces start from the scores of the given vocabulary and take expected
   counts over all training words (forward-backward in log space), which come to the driver as
   one number a piece.
4. In each bucket the log-space forward recursion gives every distinct word its probability,
   the sum over all its segmentations; batches get counts and probabilities of their words
   back and add them up for each document.

The model's probability of a text is the product over its words and the end of the text.

Defined results: a null text is the empty text and has one token, the end; without training
documents all counts are 0; rows with equal ids are scored each; a null id counts as empty text
for the fold; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventgauge.llm.lattice import Lattice, vocabulary
from eventgauge.llm.shared import fold, steps, stored, texts

CHUNK_BYTES = 8 << 20
#: Bytes of text per bucket of words, on average.
BUCKET_BYTES = 16 << 20
LEAST_BUCKETS = 64
#: Rounds of expected counts.
ROUNDS = 2
#: Words whose lattices are built at once.
LATTICE_WORDS = 60_000
#: Weight of the given vocabulary in the learned weights, in pieces.
PRIOR = 1000.0
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def joined_words(words: list[bytes]) -> bytes:
    """Words hold no white space, so a line each is enough."""
    return zstandard.ZstdCompressor(level=1).compress(b"\n".join(words))


def split_words(data: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    return raw.split(b"\n") if raw else []


CHUNKS = (
    "chunk long, ids array<long>, sizes binary, tokens binary, bucket array<int>, words array<binary>,"
    " counts array<binary>"
)


def chunks(documents: DataFrame, buckets: int) -> DataFrame:
    """One row per batch of documents; codes of tokens count its words bucket by bucket."""
    rows = texts(documents).withColumn("train", fold("doc_id") != 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, limit=CHUNK_BYTES):
            found: dict[bytes, int] = {}
            number = itertools.count()
            sizes, codes, train = [], [], []
            for text, trains in zip(batch.column("text").to_pylist(), batch.column("train").to_pylist(), strict=True):
                words = text.encode().translate(LOWER).split()
                codes.append(np.fromiter(map(found.setdefault, words, number), np.int64, len(words)))
                sizes.append(len(words))
                train.append(trains)
            sizes = np.array(sizes, np.int64)
            words = list(found)
            home = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
            order = np.argsort(home, kind="stable")
            # The code of a word is its place among the words in order of buckets.
            place = np.empty(len(words), np.int64)
            place[order] = np.arange(len(words))
            marks = np.fromiter(found.values(), np.int64, len(words))
            flat = np.concatenate(codes) if codes else np.zeros(0, np.int64)
            flat = place[np.searchsorted(marks, flat)] if len(words) else flat
            trained = np.repeat(np.array(train, bool), sizes)
            counts = np.bincount(flat[trained], minlength=len(words))
            # Only the buckets at hand are looked at, so a batch's work does not grow with the input.
            used, starts = np.unique(home[order], return_index=True)
            cuts = [*starts.tolist(), len(words)]
            spans = [slice(a, b) for a, b in itertools.pairwise(cuts)] if len(words) else []
            parts = [[words[i] for i in order[span]] for span in spans]
            name = int.from_bytes(np.random.default_rng().bytes(8), "little", signed=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name], pa.int64()), pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([packed(sizes.astype(np.uint32))], pa.binary()), pa.array([packed(flat.astype(np.uint32))], pa.binary()),
                    pa.array([used.tolist()], pa.list_(pa.int32())), pa.array([[joined_words(p) for p in parts]], pa.list_(pa.binary())),
                    pa.array([[packed(counts[span].astype(np.uint32)) for span in spans]], pa.list_(pa.binary())),
                ],
                [x.split()[0] for x in CHUNKS.split(", ")],
            )

    return rows.mapInArrow(work, CHUNKS)


def requests(held: DataFrame) -> DataFrame:
    """chunk, bucket, words, counts: what each chunk has of each bucket."""
    one = F.explode(F.arrays_zip("bucket", "words", "counts")).alias("x")
    return held.select("chunk", one).select("chunk", "x.bucket", "x.words", "x.counts")


def word_counts(asked: DataFrame) -> DataFrame:
    """bucket, words, counts: the distinct words of each bucket and their training counts."""

    def work(key: tuple, group: pa.Table) -> pa.Table:
        total: dict[bytes, int] = {}
        for batch in group.to_batches():
            for words, counts in zip(batch.column("words"), batch.column("counts"), strict=True):
                for w, c in zip(split_words(words.as_py()), unpacked(counts.as_py(), np.uint32).tolist(), strict=True):
                    total[w] = total.get(w, 0) + c
        words = sorted(total)
        counts = np.array([total[w] for w in words], np.int64)
        return pa.Table.from_arrays(
            [
                pa.array([key[0].as_py()], pa.int32()), pa.array([joined_words(words)], pa.binary()),
                pa.array([packed(counts)], pa.binary()), pa.array([int(counts.sum())], pa.int64()),
                pa.array([int((counts > 0).sum())], pa.int64()),
            ],
            ["bucket", "words", "counts", "tokens", "types"],
        )

    schema = "bucket int, words binary, counts binary, tokens long, types long"
    return asked.select("bucket", "words", "counts").groupBy("bucket").applyInArrow(work, schema)


def _lattices(words: list[bytes], path: str) -> Iterator[tuple[slice, Lattice]]:
    for start in range(0, len(words), LATTICE_WORDS):
        part = slice(start, start + LATTICE_WORDS)
        yield part, Lattice.of([w.decode() for w in words[part]], vocabulary(path))


def expected_counts(table: DataFrame, path: str, weights: np.ndarray) -> dict[int, float]:
    """Expected uses of each piece in the training words, summed over all buckets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = vocabulary(path)
        total = np.zeros(len(given.pieces))
        for batch in batches:
            for words, counts in zip(batch.column("words"), batch.column("counts"), strict=True):
                counts = unpacked(counts.as_py(), np.int64)
                listed = split_words(words.as_py())
                trained = np.flatnonzero(counts > 0)
                counts = counts[trained]
                for part, lattice in _lattices([listed[i] for i in trained.tolist()], path):
                    scores = lattice.scores(given, weights)
                    back, front = lattice.backward(scores), lattice.forward(scores)
                    node_word = np.searchsorted(lattice.roots, lattice.start, side="right") - 1
                    use = np.exp(front[lattice.start] + scores + back[lattice.stop] - back[lattice.roots][node_word])
                    use *= counts[part][node_word]
                    plain = lattice.piece >= 0
                    total += np.bincount(lattice.piece[plain], use[plain], len(total))
                    for code in np.unique(lattice.codes[~plain]).tolist():
                        mass = use[~plain & (lattice.codes == code)].sum()
                        np.add.at(total, given.byte[list(chr(code).encode())], mass)
        places = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(total[places])], ["piece", "uses"])

    found = table.select("words", "counts").mapInArrow(work, "piece long, uses double")
    return {r["piece"]: r["uses"] for r in found.groupBy("piece").agg(F.sum("uses").alias("uses")).collect()}


def learned(table: DataFrame, path: str, documents: int, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Log weights of the pieces and of the end of a text."""
    given = vocabulary(path)
    weights = given.weights
    prior = PRIOR * np.exp(given.weights)
    for _ in range(rounds):
        uses = prior.copy()
        for piece, n in expected_counts(table, path, weights).items():
            uses[piece] += n
        total = uses.sum() + documents + 1
        with np.errstate(divide="ignore"):
            weights = np.log(uses) - np.log(total)
    return weights, float(np.log((documents + 1) / total))


def answers(asked: DataFrame, table: DataFrame, path: str, weights: np.ndarray) -> DataFrame:
    """chunk, bucket, counts, scores (natural logs): what a chunk wants to know of its words."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = vocabulary(path)
        for batch in batches:
            made = []
            for words in batch.column("words"):
                listed = split_words(words.as_py())
                out = np.zeros(len(listed), np.float32)
                for part, lattice in _lattices(listed, path):
                    out[part] = lattice.backward(lattice.scores(given, weights))[lattice.roots]
                made.append(packed(out))
            yield pa.RecordBatch.from_arrays(
                [batch.column("bucket"), batch.column("words"), batch.column("counts"), pa.array(made, pa.binary())],
                ["bucket", "words", "counts", "scores"],
            )

    def reply(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        known, counts, scores, made = {}, None, None, []
        for batch in right.to_batches():
            if batch.num_rows:
                words = split_words(batch.column("words")[0].as_py())
                known = dict(zip(words, range(len(words)), strict=True))
                counts = unpacked(batch.column("counts")[0].as_py(), np.int64)
                scores = unpacked(batch.column("scores")[0].as_py(), np.float32)
        for chunk, words in zip(left.column("chunk").to_pylist(), left.column("words").to_pylist(), strict=True):
            places = np.array([known[w] for w in split_words(words)], np.int64)
            made.append((chunk, key[0].as_py(), packed(counts[places]), packed(scores[places])))
        columns = list(zip(*made, strict=True)) or [()] * 4
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        return pa.Table.from_arrays(arrays, ["chunk", "bucket", "counts", "scores"])

    scored = table.select("bucket", "words", "counts").mapInArrow(
        score, "bucket int, words binary, counts binary, scores binary"
    )
    return asked.select("chunk", "bucket", "words").groupBy("bucket").cogroup(scored.groupBy("bucket")).applyInArrow(
        reply, "chunk long, bucket int, counts binary, scores binary"
    )


SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def scored(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    size = texts(documents).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    held = stored(chunks(documents, max(LEAST_BUCKETS, size // BUCKET_BYTES)), "chunks")
    asked = requests(held)
    table = stored(word_counts(asked), "words")
    sums = table.agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).first()
    trained = documents.filter(fold("doc_id") != 1).select(F.lit(1)).count()
    total = (sums["tokens"] or 0) + trained
    types = (sums["types"] or 0) + (trained > 0)
    weights, end = learned(table, path, trained)
    replies = stored(answers(asked, table, path, weights), "answers")
    scale = total + 0.5 * (types + 1)
    end_base = float(np.log10((trained + 0.5) / scale))

    def work(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        columns = (right.column(c).to_pylist() for c in ("bucket", "counts", "scores"))
        told = sorted(zip(*columns, strict=True))
        counts = np.concatenate([np.zeros(0, np.int64), *(unpacked(c, np.int64) for _, c, _ in told)])
        scores = np.concatenate([np.zeros(0), *(unpacked(s, np.float32) for _, _, s in told)])
        base = np.log10((counts + 0.5) / scale)
        made = []
        for ids, sizes, tokens in zip(*(left.column(c).to_pylist() for c in ("ids", "sizes", "tokens")), strict=True):
            sizes, tokens = unpacked(sizes, np.uint32).astype(np.int64), unpacked(tokens, np.uint32)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            sums = [np.bincount(owner, v[tokens], len(sizes)) for v in (counts > 0, base, scores)]
            known = sums[0].astype(np.int64) + (trained > 0)
            made.append([ids, sizes + 1, known, sums[1] + end_base, (sums[2] + end) / np.log(10)])
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        columns = [np.concatenate(c) if k else [x for part in c for x in part] for k, c in enumerate(zip(*made, strict=True))]
        arrays = [pa.array(c, t) for c, t in zip(columns or [()] * 5, kinds, strict=True)]
        return pa.Table.from_arrays(arrays, [x.split()[0] for x in SCORES.split(", ")])

    pairs = held.select("chunk", "ids", "sizes", "tokens").groupBy("chunk").cogroup(replies.groupBy("chunk"))
    return pairs.applyInArrow(work, SCORES).select(
        "doc_id", (fold("doc_id") == 1).alias("held_out"), "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), "base_score", "score",
    )
