"""Best-fit packing of token pieces into sequences of a fixed length.

1. Documents become ids, longer ones are cut, and each piece is described by a narrow row.
2. The histogram of piece lengths (at most `capacity` rows, whatever the input) goes to the
   driver.  There the configuration linear program "fewest sequences that hold all pieces" is
   solved by multiplicative weights.  Every length has a price, which falls with the share of
   its pieces that has been served.  A knapsack dynamic program prices all rooms at once, and
   for each length that lags the dearest configuration with it is used fractionally.  Phases
   follow until the average of all uses is within `GAP` of the bound that the prices prove.
3. The average is rounded, dearest configurations by the best prices only; what it leaves is
   packed by best fit, decreasing, on counts of lengths.  Which configurations count as dear
   enough is chosen by the number of sequences that results.
4. Every piece gets a rank among the pieces of its length, and the rank names its sequence and
   place.  Ranks are counted within salted buckets, so a length that a third of all pieces
   share is spread over all tasks.

Defined results: a null text is the empty text, whose one piece is the end token; equal rows
are packed as separate documents, in an order fixed by (id, piece, checksum); null ids come
first in that order; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventgauge.llm.shared import steps, stored, texts

CAPACITY = 1024
END = 2
#: Pieces in a bucket of ranks, on average.
BUCKET_ROWS = 20_000
LEAST_BUCKETS = 64
#: Bytes of text a worker encodes at once.
BATCH_BYTES = 6 << 20
#: Phases of the multiplicative weights at most; each serves all pieces once more.
ROUNDS = 60
#: The phases end when the fractional solution is this close to the proven bound.
GAP = 0.01
#: How fast a price falls with the share served, in the first phase.
RATE = 0.3
#: How far below the dearest a configuration may be to be rounded; the best of these is kept.
SLACK = (1e-9, 0.001, 0.002, 0.005, 0.02, 1.0)

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordEncoder:
    """The token ids of a `tokenizers` file with a byte-level BPE, for many whole texts at once.

    The tokenizer never joins a character that is not white space with a blank after it, so
    the parts between single blanks can be encoded on their own, and repeated parts once: the
    distinct parts of a batch are encoded as one text and cut by the lengths of their tokens.
    A text in which white space touches a blank is encoded whole, and so is one that holds the
    string of a special token, which becomes its id.  The merges run in `tiktoken`, which gives
    the same ids from the same vocabulary several times faster.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        characters = sorted(ByteLevel.alphabet())
        given = Tokenizer.from_file(path)
        vocabulary = given.get_vocab(with_added_tokens=True)
        special = {t.content: k for k, t in given.get_added_tokens_decoder().items()}
        # The byte a character of the vocabulary stands for: printable ones for themselves,
        # the others in order from code point 256.
        own = {c: ord(c) for c in characters if ord(c) < 256}
        others = [b for b in range(256) if b not in own.values()]
        own |= dict(zip((c for c in characters if ord(c) >= 256), others, strict=True))
        ranks = {bytes(own[c] for c in k): v for k, v in vocabulary.items() if all(c in own for c in k) and k not in special}
        self.coder = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        self.odd = "|".join([r"[\s\p{Z}\x1c-\x1f\x{85}\x0b] ", "^ ", " $", *(re.escape(x) for x in special)])
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for k, v in ranks.items():
            self.sizes[v] = len(k)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.coder.encode(text, allowed_special="all"), np.uint32)

    def _parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct parts, each a blank and what follows it, and where each begins."""
        joined = b"".join(parts.cast(pa.binary()).to_pylist())
        ids = self._whole(joined.decode())
        ends = np.cumsum(pc.binary_length(parts).to_numpy(False), dtype=np.int64)
        at = np.searchsorted(np.cumsum(self.sizes[ids]), ends, side="right")
        return ids, np.concatenate([[0], at])

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a string column without nulls."""
        odd = pc.match_substring_regex(column, self.odd).to_numpy(False)
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(column)
        plain = np.flatnonzero(~odd)
        if len(plain):
            split = pc.split_pattern(column.take(pa.array(plain)), " ")
            flat, bounds = split.flatten(), split.offsets.to_numpy().astype(np.int64)
            bounds -= bounds[0]
            rest = np.ones(len(flat), bool)
            rest[bounds[:-1]] = False
            first = [self._whole(x) for x in flat.filter(pa.array(~rest)).to_pylist()]
            coded = flat.filter(pa.array(rest)).dictionary_encode()
            blank = pa.scalar(" ", coded.dictionary.type)
            ids, ends = self._parts(pc.binary_join_element_wise("", coded.dictionary, blank))
            codes = coded.indices.to_numpy().astype(np.int64)
            sizes = (ends[1:] - ends[:-1])[codes]
            after = np.cumsum(sizes)
            shift = np.repeat(ends[codes] - (after - sizes), sizes)
            flat_ids = ids[np.arange(len(shift)) + shift]
            # Without its first part a text has one part less for each text before it.
            cuts = np.concatenate([[0], after])[bounds - np.arange(len(bounds))]
            for k, place in enumerate(plain):
                out[place] = np.concatenate([first[k], flat_ids[cuts[k] : cuts[k + 1]]])
        for place in np.flatnonzero(odd):
            out[place] = self._whole(column[int(place)].as_py())
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def cut(size: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: the first may be shorter, the rest are full."""
    first = size % capacity or min(size, capacity)
    return [(0, first), *((s, capacity) for s in range(first, size, capacity))]


def pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in steps(batches, limit=BATCH_BYTES):
            rows = []
            for key, ids in zip(batch.column("doc_id").to_pylist(), coder.encode(batch.column("text")), strict=True):
                data = memoryview(np.append(ids, np.uint32(end)).astype("<u4").tobytes())
                for k, (start, length) in enumerate(cut(len(ids) + 1, capacity)):
                    rows.append((key, k, start, length, zlib.crc32(data[4 * start : 4 * (start + length)])))
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return texts(documents).mapInArrow(work, PIECES)


def room_values(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The highest total price of pieces in each room from 0 to `capacity`: a knapsack by dynamic programming."""
    best = np.zeros(capacity + 1)
    usable = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(int(lengths[0]), capacity + 1):
        n = usable[room]
        best[room] = max(best[room - 1], (best[room - lengths[:n]] + prices[:n]).max())
    return best


def dearest(
    prices: np.ndarray, lengths: np.ndarray, limits: np.ndarray, capacity: int,
    values: np.ndarray | None = None, first: int | None = None,
) -> dict[int, int]:
    """The configuration of the highest total price, among those with the length `first` if it is given.

    `values` are those of the rooms at about these prices.  Lengths without a price are left out.
    """
    best = room_values(prices, lengths, capacity) if values is None else values
    counts: dict[int, int] = defaultdict(int)
    room = capacity
    if first is not None:
        counts[first] += 1
        room -= int(lengths[first])
    while n := int(np.searchsorted(lengths, room, side="right")):
        top = int(np.argmax(np.where(prices[:n] > 0, best[room - lengths[:n]] + prices[:n], -1.0)))
        if prices[top] <= 0:
            break
        counts[top] += 1
        room -= int(lengths[top])
    return {k: min(v, int(limits[k])) for k, v in counts.items()}


def proven(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """A bound on the number of sequences, and prices at which no configuration costs more than 1.

    Either the share of a sequence, or, for some length up to the half: nothing for what is
    shorter and 1 for what leaves no room for it.
    """
    share = lengths / capacity
    found = [share, np.where(2 * lengths == capacity, 0.5, (2 * lengths > capacity).astype(float))]
    for low in lengths[2 * lengths <= capacity].tolist():
        found.append(np.where(lengths > capacity - low, 1.0, np.where(lengths >= low, share, 0.0)))
    bounds = [float((counts * p).sum()) for p in found]
    k = int(np.argmax(bounds))
    return bounds[k], found[k]


Configuration = tuple[tuple[int, int], ...]


def fractional(
    lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS
) -> tuple[dict[Configuration, float], float, np.ndarray]:
    """Configurations and how often to use each to cover all pieces, the proven bound, and its prices.

    Multiplicative weights on the covering constraints.  In phase t every length is served t
    times over: the dearest configuration with it is used until one of its lengths is a whole
    phase ahead, which takes that length out of the rest of the phase.
    """
    served, used, total = np.zeros(len(lengths)), defaultdict(float), 0.0
    bound, dual = proven(lengths, counts, capacity)
    base = dual + 0.001 * lengths / capacity
    longest_first = np.argsort(-lengths).tolist()
    for phase in range(1, rounds + 1):
        rate = RATE / np.sqrt(phase)
        prices = base * np.exp(-rate * (served - served.mean()))
        values = room_values(prices, lengths, capacity)
        if (shown := float((counts * prices).sum() / values[capacity])) > bound:
            bound, dual = shown, prices / values[capacity]
        live = np.where(served < phase + 1 - 1e-9, prices, 0.0)
        for first in longest_first:
            while served[first] < phase - 1e-9:
                config = dearest(live, lengths, counts, capacity, values, first)
                times = min(((phase if k == first else phase + 1) - served[k]) * counts[k] / v for k, v in config.items())
                used[tuple(sorted(config.items()))] += times
                total += times
                for k, v in config.items():
                    served[k] += v * times / counts[k]
                    live[k] = base[k] * np.exp(-rate * (served[k] - phase + 0.5)) if served[k] < phase + 1 - 1e-9 else 0.0
        if total / served.min() <= (1 + GAP) * bound:
            break
    return {c: n / served.min() for c, n in used.items()}, bound, dual


def rounded(
    used: list[tuple[Configuration, float]], counts: np.ndarray
) -> tuple[dict[Configuration, int], np.ndarray]:
    """Whole uses of configurations, and the pieces left: each use is due when the sum of all reaches a whole number."""
    left, out, due = counts.copy(), {}, 0.0
    for config, n in used:
        due += n
        if times := min(int(due), *(int(left[k]) // v for k, v in config)):
            out[config] = times
            for k, v in config:
                left[k] -= times * v
        due -= int(due)
    return out, left


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """Configurations (length to number of pieces) and their number of sequences.

    The rounded linear program first; best fit, decreasing, for the rest.
    """
    held = {k: v for k, v in histogram.items() if v > 0}
    whole = held.pop(capacity, 0)
    full = [({capacity: 1}, whole)] if whole else []
    if not held or not rounds:
        return full + best_fit(held, capacity)
    lengths = np.array(sorted(held))
    counts = np.array([held[k] for k in lengths.tolist()])
    used, _, dual = fractional(lengths, counts, capacity, rounds)
    often = sorted(used.items(), key=lambda c: (-c[1], c[0]))
    worth = [sum(dual[k] * v for k, v in config) for config, _ in often]
    made = []
    for slack in SLACK:
        uses, left = rounded([c for c, w in zip(often, worth, strict=True) if w >= 1 - slack], counts)
        program = [({int(lengths[k]): v for k, v in config}, n) for config, n in uses.items()]
        rest = best_fit({int(k): int(v) for k, v in zip(lengths, left, strict=True) if v}, capacity)
        made.append((sum(n for _, n in program + rest), int(left.sum()), program + rest))
    return full + min(made, key=lambda m: m[:2])[2]


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best fit, decreasing, on counts of lengths: configurations and their number of sequences."""
    out: dict[Configuration, int] = defaultdict(int)
    # Best fit on classes of equal open sequences: free space -> contents -> number.
    free: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            room = min((r for r, held in free.items() if r >= length and held), default=0)
            if not room:
                # As many new sequences as this length fills, each as full as it can be.
                each = capacity // length
                whole, rest = divmod(n, each)
                if whole:
                    free[capacity - each * length][(length,) * each] += whole
                if rest:
                    free[capacity - rest * length][(length,) * rest] += 1
                n = 0
                continue
            contents, m = next(iter(free[room].items()))
            take = min(n, m)
            if take == m:
                del free[room][contents]
            else:
                free[room][contents] = m - take
            free[room - length][(*contents, length)] += take
            n -= take
    for held in free.values():
        for contents, n in held.items():
            sizes = sorted(set(contents))
            out[tuple((s, contents.count(s)) for s in sizes)] += n
    return [(dict(c), n) for c, n in out.items()]


def segments(planned: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, the first rank, first sequence, pieces a sequence and offset of its segments."""
    found: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    served: dict[int, int] = defaultdict(int)
    sequence = 0
    for config, n in planned:
        offset = 0
        for length, v in sorted(config.items(), reverse=True):
            found[length].append((served[length], sequence, v, offset))
            served[length] += n * v
            offset += length * v
        sequence += n
    return {k: tuple(np.array(c, np.int64) for c in zip(*v, strict=True)) for k, v in found.items()}


def packed(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset."""
    rows = stored(cut_pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = segments(plan(histogram, capacity))
    buckets = max(LEAST_BUCKETS, -(-sum(histogram.values()) // BUCKET_ROWS))
    salted = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    ordered = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        salted.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
        .select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    ranked = salted.withColumn("within", F.row_number().over(ordered) - 1).join(offsets, ["length", "bucket"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("within").to_numpy() + batch.column("base").to_numpy()
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths):
                mine = np.flatnonzero(lengths == length)
                first, start, each, begin = places[int(length)]
                k = np.searchsorted(first, ranks[mine], side="right") - 1
                inside = ranks[mine] - first[k]
                sequence[mine] = start[k] + inside // each[k]
                offset[mine] = begin[k] + inside % each[k] * length
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kept = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "within", "base")
    return kept.mapInArrow(place, f"{PIECES}, sequence_id long, offset long")


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    return packed(pieces(documents, tokenizer, capacity, end), capacity)


def sequences(places: DataFrame, documents: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """sequence_id and its token ids, built from the rows of `packed` (ids must be unique)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in steps(batches):
            found = [np.append(x, np.uint32(end)).astype(np.int32) for x in coder.encode(batch.column("text"))]
            ids = pa.array(found, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    coded = texts(documents).mapInArrow(work, "doc_id long, ids array<int>")
    part = F.slice("ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int"))
    joined = places.join(coded, "doc_id").select("sequence_id", "offset", part.alias("ids"))
    held = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(F.flatten(F.transform(held, lambda x: x["ids"])).alias("ids"))
