"""Alignment of two tokenizations of the same text, and how often tokens meet.

Both tokenizers spell the same bytes (a blank and the text).  Per document the list of byte
offsets where tokens end is sorted, so the offsets where both end are found by a galloping
intersection: each end of the shorter list is searched in the longer one by steps of doubling
width from the place of an earlier end, then by halving.  All documents of a slice take their
steps together in numpy.  Common ends cut the tokens into groups.  The ranks of two neighbouring
ends differ by the range of tokens of the other side that the token between them overlaps, so no
pair is ever tested.

On Spark: a slice of documents becomes one stored row with its distinct linked id pairs, their
counts and, per document, which of them it holds.  Pairs are summed over the corpus by key (a
slice has each pair once, so a pair that a third of all links share is as rare as the slices),
the totals go back to the slices, and each document adds up its own.

Defined results: a null or empty text, and one that a tokenizer does not spell back byte for
byte (such as one with U+2581), has no tokens and zeros; special strings inside texts are plain
text; equal rows and null ids are kept; an empty table gives no rows; further columns are
ignored.  A text longer than a slice is cut where both tokenizers are certain to cut, and its
parts are aligned one after another, so memory does not grow with it beyond the text itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventgauge.llm.bpe_codec import ForcedBoundaryCodec, codec, string_array
from eventgauge.llm.shared import flat_bytes, ragged, steps, stored, texts

#: Bytes of text aligned at once.
STEP = 2 << 20
#: Tokens written out at once.
WRITTEN = 1 << 17
#: Every so many ends one is searched from the start of its list, the others from its place.
STRIDE = 16
BLANK = 0x20


class PieceCodec:
    """Encodes with a `sentencepiece` model, once for each distinct word of a slice.

    No piece of such a model holds a blank behind another character, so no merge crosses the
    place before a blank: the same forced boundary as for byte pairs.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        held = []
        for i in range(self.size):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                held.append(bytes([int(piece[3:-1], 16)]))
            else:
                held.append(piece.replace("▁", " ").encode())
            if " " in piece.replace("▁", " ").lstrip(" ") and not self.model.is_control(i):
                raise ValueError(f"piece {piece!r} holds a blank behind another character")
        self.lengths = np.array([len(p) for p in held], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)])
        self.spelling = np.frombuffer(b"".join(held), np.uint8)
        self.blank = self.model.piece_to_id("▁")

    def encode(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of texts that each begin with the added blank, where they begin, and whether spelled back."""
        cut = np.zeros(len(flat) + 1, bool)
        cut[1:-1] = (flat[1:] == BLANK) & (flat[:-1] != BLANK)
        cut[offsets] = True
        starts = np.flatnonzero(cut)
        coded = string_array(flat, starts).dictionary_encode()
        codes, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        # The model adds the blank itself; it gives nothing for a lone one.
        words = [x[1:].decode() for x in distinct.to_pylist()]
        found = [x or [self.blank] for x in self.model.encode(words, num_threads=1)]
        begins = np.concatenate([[0], np.cumsum([len(x) for x in found])])
        ids = np.fromiter((i for x in found for i in x), np.int32, begins[-1])
        own, own_begins = flat_bytes(distinct)
        said, said_begins = ragged(self.spelling, self.begins, ids)
        sizes = np.diff(said_begins[begins])
        equal = sizes == np.diff(own_begins)
        both = np.flatnonzero(equal)
        left, at = ragged(own, own_begins, both)
        right, _ = ragged(said, said_begins[begins], both)
        if len(left):
            equal[both] = np.logical_and.reduceat(left == right, at[:-1])
        ids, ends = ragged(ids, begins, codes)
        at = np.searchsorted(starts, offsets)
        wrong = np.concatenate([[0], np.cumsum(~equal[codes])])
        return ids, ends[at], wrong[at[1:]] == wrong[at[:-1]]


_PIECES: dict[str, PieceCodec] = {}


def piece_codec(path: str) -> PieceCodec:
    if path not in _PIECES:
        _PIECES[path] = PieceCodec(path)
    return _PIECES[path]


def galloped(ends: np.ndarray, values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """For each end, the first place from `start` to `stop` whose value is no less.

    All values before `start` must be smaller.  Steps double until a value is no less, then the
    last step is halved; ends that are done drop out.
    """
    low, high = start.copy(), stop.copy()
    going, width = np.flatnonzero(low < high), 1
    while len(going):
        probe = low[going] + width - 1
        inside = probe < stop[going]
        less = np.zeros(len(going), bool)
        less[inside] = values[probe[inside]] < ends[going[inside]]
        over = inside & ~less
        high[going[over]] = probe[over]
        low[going[less]] = probe[less] + 1
        going, width = going[less], width * 2
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) // 2
        less = values[middle] < ends[going]
        low[going[less]] = middle[less] + 1
        high[going[~less]] = middle[~less]
        going = going[low[going] < high[going]]
    return low


def intersected(short: np.ndarray, own: np.ndarray, long: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each short end in the long list of its document, and whether it ends there too.

    `own` and `other` are the n + 1 places where the lists of n documents begin.
    """
    document = np.repeat(np.arange(len(own) - 1), np.diff(own))
    stop = other[1:][document]
    inside = np.arange(len(short)) - own[:-1][document]
    place = np.zeros(len(short), np.int64)
    anchors = np.flatnonzero(inside % STRIDE == 0)
    place[anchors] = galloped(short[anchors], long, other[:-1][document[anchors]], stop[anchors])
    rest = np.flatnonzero(inside % STRIDE)
    place[rest] = galloped(short[rest], long, place[rest - inside[rest] % STRIDE], stop[rest])
    return place, long[place] == short


@dataclass
class Aligned:
    """Token groups and links of some texts, in flat arrays with one entry a text, a token or a link."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    #: Linked pairs (id of A times the size of B's vocabulary, plus id of B), text by text.
    links: np.ndarray
    #: The groups written out; those of text k lie from groups_at[k] to groups_at[k + 1], with a mark behind.
    groups: memoryview
    groups_at: np.ndarray


class Aligner:
    def __init__(self, byte_path: str, piece_path: str):
        self.a: ForcedBoundaryCodec = codec(byte_path, specials=False)
        self.b: PieceCodec = piece_codec(piece_path)
        # Every id with each mark that may follow it, one after another: A's, then B's.
        marked = [f"{i}{m}".encode() for size, marks in ((self.a.size, ",|"), (self.b.size, ",;")) for i in range(size) for m in marks]
        self.marked_at = np.concatenate([[0], np.cumsum([len(x) for x in marked])])
        self.marked = np.frombuffer(b"".join(marked), np.uint8)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A's and B's ids of texts with their blank, the places where texts begin, and which have tokens."""
        flat, offsets = flat_bytes(column)
        b, b_at, told = self.b.encode(flat, offsets)
        told &= np.diff(offsets) > 1
        chosen = np.flatnonzero(told)
        a, a_at = self.a.encode(column.take(pa.array(chosen)))
        b, b_at = ragged(b, b_at, chosen)
        return a, a_at, b, b_at, told

    def align(self, a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray) -> Aligned:
        n_a, n_b = np.diff(a_at), np.diff(b_at)
        a_ends, b_ends = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        a_common, b_common = np.zeros(len(a), bool), np.zeros(len(b), bool)
        first, second, owner = [], [], []
        for swap in (False, True):
            drives = np.flatnonzero((n_b < n_a) if swap else (n_a <= n_b))
            sides = ((b_ends, b_at, b_common), (a_ends, a_at, a_common)) if swap else ((a_ends, a_at, a_common), (b_ends, b_at, b_common))
            (short, own, short_common), (long, other, long_common) = sides
            # The lists of these documents alone, and where their tokens stand among all.
            mine, begins = ragged(np.arange(len(short)), own, drives)
            theirs, other_begins = ragged(np.arange(len(long)), other, drives)
            place, common = intersected(short[mine], begins, long[theirs], other_begins)
            short_common[mine[common]] = True
            long_common[theirs[place[common]]] = True
            # Overlapped tokens: from behind the end before, to the one that holds this end.
            start = np.zeros(len(mine), np.int64)
            start[1:] = place[:-1] + common[:-1]
            width = place - start + 1
            after = np.cumsum(width)
            over = np.arange(after[-1] if len(after) else 0) + np.repeat(start - (after - width), width)
            pair = (np.repeat(mine, width), theirs[over])
            first.append(pair[swap])
            second.append(pair[not swap])
            owner.append(np.repeat(np.repeat(drives, np.diff(begins)), width))
        owner = np.concatenate(owner)
        links = a[np.concatenate(first)].astype(np.int64) * self.b.size + b[np.concatenate(second)]
        order = np.argsort(owner, kind="stable")
        # Groups in order: A's tokens of a group, then B's.
        a_group, b_group = np.cumsum(a_common) - a_common, np.cumsum(b_common) - b_common
        a_stop, b_stop = np.flatnonzero(a_common) + 1, np.flatnonzero(b_common) + 1
        written = np.zeros(len(a) + len(b), np.int64)
        written[np.arange(len(a)) + np.concatenate([[0], b_stop])[a_group]] = 2 * a.astype(np.int64) + a_common
        written[np.arange(len(b)) + a_stop[b_group]] = 2 * (self.a.size + b.astype(np.int64)) + b_common
        ends = np.concatenate([[0], np.cumsum(np.diff(self.marked_at)[written])])
        groups = np.empty(ends[-1], np.uint8)
        for k in range(0, len(written), WRITTEN):
            part, _ = ragged(self.marked, self.marked_at, written[k : k + WRITTEN])
            groups[ends[k] : ends[k] + len(part)] = part
        counted = np.concatenate([[0], np.cumsum(a_common)])
        return Aligned(
            n_a, n_b, counted[a_at[1:]] - counted[a_at[:-1]], np.bincount(owner, minlength=len(n_a)),
            links[order], memoryview(groups), ends[a_at + b_at],
        )

    def sections(self, text: str, limit: int) -> Iterator[pa.Array]:
        """A long text with its blank, cut before blanks where both tokenizers cut for certain."""
        column = pa.array([" " + text], pa.large_string())
        flat, offsets = flat_bytes(column)
        places = self.a.certain_cuts(flat, offsets)[1:-1]
        places = np.append(places[flat[places] == BLANK], len(flat))
        start = 0
        while start < len(flat):
            stop = int(places[max(np.searchsorted(places, start + limit, "right") - 1, np.searchsorted(places, start, "right"))])
            yield string_array(flat[start:stop], np.array([0, stop - start])).cast(pa.string())
            start = stop


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    if (byte_path, piece_path) not in _ALIGNERS:
        _ALIGNERS[byte_path, piece_path] = Aligner(byte_path, piece_path)
    return _ALIGNERS[byte_path, piece_path]


SLICE = (
    "slice long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, held array<long>, pairs array<long>, times array<long>, links binary"
)


class Slice:
    """What is known of the documents of one slice: their digests and which pairs they hold."""

    def __init__(self) -> None:
        self.documents: list[tuple] = []
        self.held: list[np.ndarray] = []
        self.numbers: list[np.ndarray] = []
        self.links: list[np.ndarray] = []

    def row(self, number: int) -> pa.RecordBatch:
        links = np.concatenate([np.zeros(0, np.int64), *self.links])
        codes, pairs = pd.factorize(links)
        owner = np.repeat(np.concatenate([np.zeros(0, np.int64), *self.numbers]), np.concatenate([np.zeros(0, np.int64), *self.held]))
        # Distinct (document, pair) with their counts; codes of a document rise, so store the steps.
        width = max(len(pairs), 1)
        found, times = np.unique(owner * width + codes, return_counts=True)
        document, code = found // width, found % width
        step = np.diff(code, prepend=0)
        step[np.diff(document, prepend=-1) > 0] = code[np.diff(document, prepend=-1) > 0]
        blob = np.concatenate([step, times]).astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
        columns = list(zip(*self.documents, strict=True))
        kinds = [pa.int64()] * 5 + [pa.string()]
        lists = [pa.array([list(c)], pa.list_(t)) for c, t in zip(columns, kinds, strict=True)]
        more = [np.bincount(document, minlength=len(self.documents)), pairs, np.bincount(codes, minlength=len(pairs))]
        lists += [pa.array([x], pa.list_(pa.int64())) for x in more]
        blob = pa.array([zstandard.ZstdCompressor(3).compress(blob)], pa.binary())
        names = [x.split()[0] for x in SLICE.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists, blob], names)


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Steps of codes and their counts."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    both = np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64)
    return both[: len(both) // 2], both[len(both) // 2 :]


def slices(documents: DataFrame, byte_path: str, piece_path: str, limit: int = STEP) -> DataFrame:
    """One row for each slice of about `limit` bytes of text."""

    def whole(held: Aligner, piece: pa.RecordBatch) -> Slice:
        out = Slice()
        column = pc.binary_join_element_wise("", piece.column("text"), " ")
        a, a_at, b, b_at, told = held.encode(column)
        found = held.align(a, a_at, b, b_at)
        at = np.cumsum(told) - 1
        for k, (identity, has) in enumerate(zip(piece.column("doc_id").to_pylist(), told.tolist(), strict=True)):
            i = at[k]
            if not has:
                out.documents.append((identity, 0, 0, 0, 0, ""))
                continue
            digest = hashlib.sha256(found.groups[found.groups_at[i] : found.groups_at[i + 1] - 1]).hexdigest()
            out.documents.append((identity, found.n_a[i], found.n_b[i], found.n_groups[i], found.n_links[i], digest))
        out.held, out.links, out.numbers = [found.n_links], [found.links], [np.flatnonzero(told)]
        return out

    def in_sections(held: Aligner, identity: int | None, text: str) -> Slice:
        out, digest, total = Slice(), hashlib.sha256(), np.zeros(4, np.int64)
        mark = b""
        for section in held.sections(text, limit):
            a, a_at, b, b_at, told = held.encode(section)
            if not told.all():
                empty = Slice()
                empty.documents.append((identity, 0, 0, 0, 0, ""))
                return empty
            found = held.align(a, a_at, b, b_at)
            digest.update(mark + bytes(found.groups[:-1]))
            mark = b";"
            total += [found.n_a[0], found.n_b[0], found.n_groups[0], found.n_links[0]]
            distinct, times = np.unique(found.links, return_counts=True)
            out.links.append(np.repeat(distinct, times))
            out.held.append(found.n_links)
            out.numbers.append(np.zeros(1, np.int64))
        out.documents.append((identity, *total.tolist(), digest.hexdigest()))
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = aligner(byte_path, piece_path), TaskContext.get().partitionId() << 33
        for piece in steps(batches, limit=limit):
            first = piece.column("text")[0]
            if piece.num_rows == 1 and len(first.as_buffer()) > limit:
                found = in_sections(held, piece.column("doc_id")[0].as_py(), first.as_py())
            else:
                found = whole(held, piece)
            yield found.row(number)
            number += 1

    return texts(documents).mapInArrow(work, SLICE)


def pair_totals(held: DataFrame, pieces: int) -> DataFrame:
    """pair, total, best: links of each id pair in the corpus, and whether its B id has no pair with more."""
    said = held.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("x.pairs", "x.times")
    totals = said.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("total"))
    piece = F.pmod(F.col("pair"), F.lit(pieces))
    highest = totals.groupBy(piece.alias("piece")).agg(F.max("total").alias("highest"))
    # At most as many rows as B has ids.
    joined = totals.withColumn("piece", piece).join(F.broadcast(highest), "piece")
    return joined.select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))


ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def aligned(documents: DataFrame, byte_path: str, piece_path: str, limit: int = STEP) -> DataFrame:
    """One row a document with its counts, what its links count in the corpus, and the digest of its groups."""
    pieces = piece_codec(piece_path).size
    held = stored(slices(documents, byte_path, piece_path, limit), "alignment")
    totals = pair_totals(held, pieces)
    wanted = held.select("slice", F.posexplode("pairs").alias("code", "pair"))
    told = wanted.join(totals, "pair").select(F.col("slice").alias("of"), "code", "total", "best")

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        code = right.column("code").to_numpy()
        total, best = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        total[code] = right.column("total").to_numpy()
        best[code] = right.column("best").to_numpy()
        for row in left.to_pylist():
            step, times = unpacked(row["links"])
            sizes = np.array(row["held"], np.int64)
            # Codes are sums of steps within each document.
            sums, ends = np.cumsum(step), np.concatenate([[0], np.cumsum(sizes)])
            before = np.concatenate([[0], sums])[ends[:-1]]
            mine = sums - np.repeat(before, sizes)
            def per_document(values: np.ndarray) -> np.ndarray:
                added = np.concatenate([[0], np.cumsum(values[mine] * times)])[ends]
                return np.diff(added)
            columns = [row[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
            rows.append([*columns, per_document(best), per_document(total), row["groups_sha256"]])
        kinds = [pa.int64()] * 7 + [pa.string()]
        names = [x.split()[0] for x in ALIGNED.split(", ")]
        made = [pa.concat_arrays([pa.array(r[k], kinds[k]) for r in rows]) if rows else pa.array([], kinds[k]) for k in range(8)]
        return pa.table(made, names=names)

    documents_of = held.select("slice", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "held", "links")
    return documents_of.groupBy("slice").cogroup(told.groupBy("of")).applyInArrow(work, ALIGNED)
