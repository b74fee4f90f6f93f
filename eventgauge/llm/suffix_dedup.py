"""Removal of long repeated byte strings with suffix arrays.

A byte goes if a string of `length` bytes that covers it also starts anywhere else.

1. Anchors.  Every window of `length` bytes picks the leftmost least of the hashed 32-byte
   grams inside it.  Equal windows pick equal grams at the same place, so windows can only be
   equal if their anchors are.  The windows of a text that pick one anchor are neighbours and
   form a run; only (anchor, text, run) rows move, about one for 85 bytes.
2. Anchors seen once are done with.  For the others the bytes of their runs (368 at most) are
   cut from the texts; equal pieces become one with a count, before and after the shuffle.
3. Shards.  Pieces are dealt by anchor.  A shard leaves out windows whose middle part (179
   bytes or so, at one place from the anchor) is in no other piece of the anchor.  It sorts the
   suffixes of what is left by Larsson-Sadakane refinement, takes the common prefixes of
   neighbours with Kasai's rule, run in all pieces side by side, and finds the windows that
   occur twice.
4. An anchor with very many different pieces is split over several shards.  Those sort all their
   suffixes and also return their distinct windows as sorted keys; key ranges of all shards are merged by binary search.
5. Runs found go back to the texts that hold the piece, in salted cells, and are cut out.

Defined results: a null text is empty; texts shorter than `length` lose nothing; equal rows
are texts of their own, so each repeats the other; null ids are kept; an empty table gives no
rows; further columns are ignored (and kept by `without_repeats`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventgauge.llm.shared import LAST, CELLS, flat_bytes, matched, mixed, quoted, steps, stored, texts, told

LENGTH = 200
GRAM = 32
#: Windows handled at once, few enough for a processor's cache; a place in one shares a word of
#: 32 bits with its hash.
SECTION = 1 << 15
PLACE_BITS = 16
#: Parts into which the distances of a window from its anchor are cut.
PARTS = 8
#: Bytes of distinct pieces a shard sorts, on average, and different pieces of one anchor in it.
SHARD_BYTES = 1 << 20
SHARD_PIECES = 8192
LEAST_SHARDS = 48
#: Rows of sorted keys a merging task holds at most, on average.
MERGE_ROWS = 500_000


def gram_hashes(flat: np.ndarray) -> np.ndarray:
    """32 bits for the 32 bytes at every place, by doubling; the last 31 places are cut off."""
    h, width = mixed(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)[flat], 1
    factor = 0x9E3779B1
    while width < GRAM:
        h = h[:-width] * np.uint32(factor) + h[width:]
        factor = factor * factor & (2**32 - 1)
        width *= 2
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    return h


def gram_names(flat: np.ndarray, places: np.ndarray) -> np.ndarray:
    """64 bits for the 32 bytes at the given places."""
    if not len(places):
        return np.zeros(0, np.uint64)
    words = np.lib.stride_tricks.sliding_window_view(flat, GRAM)[places].view(np.uint64)
    names = np.zeros(len(places), np.uint64)
    for k in range(words.shape[1]):
        names = mixed(names * np.uint64(0x9E3779B97F4A7C15) + words[:, k] + np.uint64(1))
    return names


def runs(
    flat: np.ndarray, offsets: np.ndarray, length: int = LENGTH, section: int = SECTION
) -> tuple[np.ndarray, ...]:
    """text, first window, number of windows and anchor of every run of windows."""
    text, first, windows, place = placed_runs(flat, offsets, length, section)
    return text, first, windows, gram_names(flat, place + first + offsets[text])


def placed_runs(flat: np.ndarray, offsets: np.ndarray, length: int, section: int = SECTION) -> tuple[np.ndarray, ...]:
    """text, first window, number of windows, and bytes from the first window to the anchor, of every run.

    The windows are handled a section at a time, which bounds the memory and the places inside
    one; a run that goes on in the next section is put together again.
    """
    section = min(section, SECTION)
    made = [(np.zeros(0, np.int64),) * 4]
    for begin in range(0, len(flat) - length + 1, section):
        data = flat[begin : begin + section + length - 1]
        # The texts that have bytes here.
        low = np.searchsorted(offsets, begin, "right") - 1
        bounds = offsets[low : np.searchsorted(offsets, begin + len(data)) + 1]
        text, at, windows, chosen = section_runs(data, np.clip(bounds - begin, 0, len(data)), length)
        made.append((text + low, at + begin, windows, chosen + begin))
    text, at, windows, chosen = (np.concatenate(c) for c in zip(*made, strict=True))
    new = np.ones(len(text), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
    begins = np.flatnonzero(new)
    windows = np.add.reduceat(windows, begins) if len(begins) else windows
    text, at, chosen = text[begins], at[begins], chosen[begins]
    return text, at - offsets[text], windows, chosen - at


def section_runs(flat: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """text, first window, number of windows and place of the anchor of the runs of one section."""
    places = np.uint32((1 << PLACE_BITS) - 1)
    hashes = gram_hashes(flat)
    least = (hashes & ~places) | np.arange(len(hashes), dtype=np.uint32)
    span, width = length - GRAM + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[: width - span], least[span - width :])
    least &= places
    changes = np.flatnonzero(least[1:] != least[:-1]) + 1
    # A text begins a run, and so does each change inside it.
    long = np.flatnonzero(np.diff(offsets) >= length)
    if not len(long):
        return (np.zeros(0, np.int64),) * 4
    starts, stops = offsets[long], offsets[long + 1] - length + 1
    of = np.searchsorted(starts, changes, "right") - 1
    changes = changes[(of >= 0) & (changes > starts[of]) & (changes < stops[of])]
    at = np.sort(np.concatenate([starts, changes]))
    of = np.searchsorted(starts, at, "right") - 1
    ends = np.minimum(np.append(at[1:], len(flat)), stops[of])
    return long[of], at, ends - at, least[at].astype(np.int64)


def suffix_array(data: np.ndarray, room: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes with at least `depth` bytes of room, in the order of those bytes; 8-byte keys.

    Larsson-Sadakane: suffixes are sorted by eight bytes; groups that are not yet sorted are
    refined by the ranks of the suffixes 8, 16, 32, ... bytes further on.  A suffix takes part
    in a round only if its piece still has the bytes that the round compares.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(depth + 16, np.uint8)])
    keys = np.zeros(n + depth + 8, np.uint64)
    for k in range(8):
        keys |= padded[k : k + len(keys)].astype(np.uint64) << np.uint64(56 - 8 * k)
    order = np.argsort(keys[:n]).astype(np.int32)
    room = room.astype(np.int32)
    ordered = keys[order]
    first = np.ones(n, bool)
    first[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    # From here on only suffixes that still take part, group after group.
    active, width = order, 8
    while width < depth:
        step = min(width, depth - width)
        active = active[room[active] >= width + step]
        group = rank[active]
        # Groups of one are sorted.
        alone = np.ones(len(group), bool)
        alone[1:] &= group[1:] != group[:-1]
        alone[:-1] &= group[1:] != group[:-1]
        active, group = active[~alone], group[~alone]
        if not len(active):
            break
        both = (group.astype(np.int64) << 32) | rank[active + step]
        by = np.argsort(both)
        active, both = active[by], both[by]
        new = np.ones(len(both), bool)
        new[1:] = both[1:] != both[:-1]
        group = both >> 32
        begins = np.ones(len(both), bool)
        begins[1:] = group[1:] != group[:-1]
        place = np.arange(len(both))
        inside = place - np.maximum.accumulate(np.where(begins, place, 0))
        rank[active] = np.maximum.accumulate(np.where(new, group + inside, 0))
        width += step
    usable = np.flatnonzero(room >= depth)
    return usable[np.argsort(rank[usable], kind="stable")], keys


def common_prefixes(
    order: np.ndarray, keys: np.ndarray, starts: np.ndarray, windows: np.ndarray, size: int, most: int
) -> np.ndarray:
    """For each suffix of `order` the bytes (at most `most`) in common with the one before it.

    Kasai: the suffix one byte further on shares at least one byte less, if the neighbour's next
    suffix is still before it (suffixes equal over the sorted depth stand in any order).  The
    first `windows` suffixes of all pieces are walked side by side, eight bytes a comparison.
    """
    out = np.zeros(len(order), np.int64)
    rank = np.full(size + 1, size + 1, np.int64)
    rank[order] = np.arange(len(order))
    by = np.argsort(-windows, kind="stable")
    starts, windows = starts[by], windows[by]
    held = np.zeros(len(starts), np.int64)
    neighbour = np.full(len(starts), size - 1, np.int64)
    for step in range(int(windows[0]) if len(windows) else 0):
        lanes = int(np.searchsorted(-windows, -step, side="left"))
        here = starts[:lanes] + step
        before = rank[here]
        other = order[np.maximum(before - 1, 0)]
        same = np.maximum(held[:lanes] - 1, 0)
        same[(before == 0) | (rank[neighbour[:lanes] + 1] >= before)] = 0
        going = np.flatnonzero((same < most) & (before > 0))
        while len(going):
            at = same[going]
            x = keys[here[going] + at] ^ keys[other[going] + at]
            # Equal leading bytes, from the highest bit that differs; without the bit below it rounds to itself.
            at += (64 - np.frexp((x & ~(x >> np.uint64(1))).astype(np.float64))[1]) >> 3
            same[going] = at
            going = going[(x == 0) & (at < most)]
        held[:lanes], neighbour[:lanes] = same, other
        out[before] = np.minimum(same, most)
    return out


def likely_windows(
    pieces: list[bytes], counts: np.ndarray, anchor: np.ndarray, place: np.ndarray, length: int = LENGTH
) -> tuple[np.ndarray, np.ndarray]:
    """For each piece the first window that may occur twice and the one after the last; no other does.

    Equal windows begin equally far before their anchor.  Those that begin from b to e - 1 bytes
    before it all hold the bytes from b before to length - e + 1 behind its beginning, so one of
    them can only occur twice if these occur twice with the anchor.
    """
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces], np.int64)
    starts, windows = np.cumsum(sizes) - sizes, sizes - length + 1
    factor = 0x9E3779B97F4A7C15
    power = np.cumprod(np.full(len(data) + 1, factor, np.uint64))
    back = np.cumprod(np.full(len(data) + 1, pow(factor, -1, 2**64), np.uint64))
    table = mixed(np.arange(1, 257, dtype=np.uint64))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * power[:-1], out=sums[1:])
    low, high = windows.copy(), np.zeros(len(pieces), np.int64)
    cuts = np.linspace(0, length - GRAM + 1, PARTS + 1).astype(int).tolist()
    for b, e in zip(cuts, cuts[1:]):
        first, stop = np.maximum(place - e + 1, 0), np.minimum(place - b + 1, windows)
        here = np.flatnonzero(first < stop)
        begin = (starts + place)[here] - b
        core = (sums[begin + b + length - e + 1] - sums[begin]) * back[begin]
        _, same = np.unique(mixed(core) + anchor[here].view(np.uint64), return_inverse=True)
        here = here[np.bincount(same, counts[here])[same] >= 2]
        low[here] = np.minimum(low[here], first[here])
        high[here] = np.maximum(high[here], stop[here])
    return low, high


def repeated_windows(
    pieces: list[bytes], counts: np.ndarray, length: int = LENGTH
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each piece the windows that occur twice, and those that stand for their equals here."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces], np.int64)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(pieces)), sizes)
    inside = np.arange(len(data)) - starts[owner]
    order, keys = suffix_array(data, sizes[owner] - inside, length)
    common = common_prefixes(order, keys, starts, sizes - length + 1, len(data), length)
    interval = np.cumsum(common < length) - 1
    weight = np.bincount(interval, counts[owner[order]])
    twice, stands = np.zeros(len(data), bool), np.zeros(len(data), bool)
    often = weight[interval] >= 2
    twice[order[often]] = True
    stands[order[(common < length) | ~often]] = True
    split = lambda mask: np.split(inside[mask], np.searchsorted(np.flatnonzero(mask), starts[1:]))
    return split(twice), split(stands)


def ranges(places: np.ndarray) -> list[int]:
    """first, last, first, last, ... of the runs of neighbouring numbers."""
    if not len(places):
        return []
    cuts = np.flatnonzero(np.diff(places) != 1)
    firsts, lasts = places[np.append(0, cuts + 1)], places[np.append(cuts, len(places) - 1)]
    return np.stack([firsts, lasts], axis=1).ravel().tolist()


def numbered(documents: DataFrame) -> DataFrame:
    """doc_id, text and the key that names both."""
    return texts(documents).withColumn("key", _key(F.col("doc_id"), F.col("text")))


def _key(identifier: Column, text: Column) -> Column:
    return F.xxhash64(F.coalesce(identifier, F.lit(LAST)), text)


def anchors(rows: DataFrame, length: int) -> DataFrame:
    """anchor, key, place (first window, number of windows, bytes to the anchor) of every run."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            flat, offsets = flat_bytes(batch.column("text"))
            text, first, windows, place = placed_runs(flat, offsets, length)
            anchor = gram_names(flat, place + first + offsets[text])
            keys = batch.column("key").to_numpy()[text]
            packed = first << 18 | windows << 9 | place
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(keys), pa.array(packed)], ["anchor", "key", "place"]
            )

    return rows.select("key", "text").mapInArrow(work, "anchor long, key long, place long")


#: Pieces that are handed on at once.
PIECES = 1 << 16


def cut_pieces(held: DataFrame, length: int, whole: bool) -> DataFrame:
    """The runs of each text with a digest that names their bytes, and the bytes if `whole`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            flat, offsets = flat_bytes(batch.column("text"))
            found = batch.column("runs")
            packed = found.flatten().field("place").to_numpy()
            text = np.repeat(np.arange(len(batch)), found.value_lengths().to_numpy())
            first = packed >> 18
            begins = offsets[text] + first
            ends = begins + (packed >> 9 & 511) + length - 1
            data = flat.tobytes()
            for k in range(0, len(packed), PIECES):
                part = slice(k, k + PIECES)
                pieces = [data[a:b] for a, b in zip(begins[part].tolist(), ends[part].tolist(), strict=True)]
                digests = [hashlib.blake2b(p, digest_size=16).digest() for p in pieces]
                columns = {
                    "anchor": found.flatten().field("anchor")[part],
                    "piece": pa.array(digests, pa.binary()),
                    "key": batch.column("key").take(pa.array(text[part])),
                    "first": pa.array(first[part].astype(np.int32)),
                }
                if whole:
                    columns["place"] = pa.array((packed[part] & 511).astype(np.int32))
                    columns["content"] = pa.array(pieces, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    schema = "anchor long, piece binary, key long, first int" + (", place int, content binary" if whole else "")
    return held.select("key", "text", "runs").mapInArrow(work, schema)


def found_in_shards(distinct: DataFrame, length: int, shard_pieces: int) -> DataFrame:
    """piece, runs: the windows of each distinct piece that occur twice anywhere."""
    total = distinct.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    shards = max(LEAST_SHARDS, int(total // SHARD_BYTES) + 1)
    sizes = stored(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("pieces")), "sizes")
    # The only piece of an anchor: its windows differ from each other, so they occur as often as it does.
    ends = distinct.filter("n > 1").select("anchor", "piece", (F.octet_length("content") - length).cast("int").alias("end"))
    whole = matched(ends, sizes, "anchor", "pieces").filter("pieces = 1").select("piece", F.array(F.lit(0), "end").alias("runs"))
    several = matched(distinct, sizes.filter("pieces > 1"), "anchor", "pieces")
    parts = F.ceil(F.col("pieces") / shard_pieces).cast("int")
    dealt = several.withColumn(
        "part", F.when(F.col("pieces") > shard_pieces, F.pmod(F.xxhash64("piece"), parts).cast("int")).otherwise(-1)
    )
    # A split anchor has shards of its own, so equal parts of others do not meet in one task.
    spread = F.when(F.col("part") < 0, F.pmod(F.xxhash64("anchor"), F.lit(shards))).otherwise(
        F.xxhash64("anchor", "part")
    )

    def work(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("anchor")
        pieces, counts = group["content"].tolist(), group["n"].to_numpy()
        if (group["part"] < 0).all():
            low, high = likely_windows(pieces, counts, group["anchor"].to_numpy(), group["place"].to_numpy(), length)
            some = low < high
            group, counts, low, high = group[some], counts[some], low[some], high[some]
            pieces = [p[a : b + length - 1] for p, a, b in zip(group["content"], low.tolist(), high.tolist(), strict=True)]
        else:
            low = np.zeros(len(pieces), np.int64)
        twice, stands = repeated_windows(pieces, counts, length) if pieces else ([], [])
        out = []
        for row, start, windows, own in zip(group.itertuples(), low.tolist(), twice, stands, strict=True):
            keys = []
            if row.part >= 0:
                keys = [
                    int.from_bytes(hashlib.blake2b(row.content[w : w + length], digest_size=8).digest(), "little", signed=True)
                    for w in own.tolist()
                ]
            if len(windows) or keys:
                out.append((row.piece, row.part, ranges(windows + start), own.tolist() if keys else [], keys))
        return pd.DataFrame(out, columns=["piece", "part", "runs", "windows", "keys"])

    schema = "piece binary, part int, runs array<int>, windows array<int>, keys array<long>"
    sorted_ = dealt.withColumn("shard", spread).select("shard", "anchor", "piece", "part", "n", "place", "content")
    found = stored(sorted_.groupBy("shard").applyInPandas(work, schema), "shards")
    inside = found.filter(F.size("runs") > 0).select("piece", "runs")
    return inside.unionByName(merged(found)).unionByName(whole)


def merged(found: DataFrame) -> DataFrame:
    """piece, runs: windows of split anchors that another shard has as well.

    Every shard gives the sorted keys of its distinct windows; a task takes one range of keys
    and looks each of them up in all by binary search.
    """
    keyed = found.filter(F.size("keys") > 0).select(
        "piece", F.explode(F.arrays_zip("windows", "keys")).alias("w")
    ).select("piece", F.col("w.windows").alias("window"), F.col("w.keys").alias("key"))
    ranges_ = max(LEAST_SHARDS, keyed.count() // MERGE_ROWS + 1)

    def work(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key", kind="stable")
        keys = group["key"].to_numpy()
        more = np.searchsorted(keys, keys, "right") - np.searchsorted(keys, keys, "left") > 1
        return group.loc[more, ["piece", "window"]]

    task = F.pmod(F.col("key"), F.lit(int(ranges_))).cast("int")
    again = keyed.withColumn("task", task).groupBy("task").applyInPandas(work, "piece binary, window int")
    return again.select("piece", F.array("window", "window").alias("runs"))


def spans(documents: DataFrame, length: int = LENGTH, shard_pieces: int = SHARD_PIECES) -> tuple[DataFrame, DataFrame]:
    """The texts that hold repeated anchors (key, text), and their spans (key, spans)."""
    rows = numbered(documents)
    marked = stored(anchors(rows, length), "anchors")
    often = stored(marked.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "often")
    lists = matched(marked, often, "anchor", "n").groupBy("key").agg(F.collect_set(F.struct("anchor", "place")).alias("runs"))
    held = stored(rows.join(lists, "key").select("key", "text", "runs"), "texts")
    pieces = cut_pieces(held, length, whole=True).groupBy("anchor", "piece")
    distinct = stored(
        pieces.agg(F.first("place").alias("place"), F.first("content").alias("content"), F.count(F.lit(1)).alias("n")), "pieces"
    )
    found = stored(found_in_shards(distinct, length, shard_pieces), "found")
    facts = found.groupBy("piece").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    # Read twice below, so named from the texts once more only, and stored without their content.
    owners = cut_pieces(held, length, whole=False)
    own = stored(owners.select("piece", "key", "first", F.pmod("key", F.lit(CELLS)).cast("int").alias("cell")), "owners")
    placed = told(own, facts, "piece")
    shifted = F.transform("runs", lambda x, i: x + F.col("first") + F.when(i % 2 == 1, length).otherwise(0))
    grouped = placed.select("key", shifted.alias("spans")).groupBy("key").agg(
        F.flatten(F.collect_list("spans")).alias("spans")
    )
    return held, grouped


def _merged_spans(flat: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(flat[::2], flat[1::2], strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _kept(data: bytes, removed: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in removed:
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]])


def removed(documents: DataFrame, length: int = LENGTH, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    held, found = spans(documents, length, shard_pieces)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("key", "text", "spans"))
            for key, text, flat in zip(*columns, strict=True):
                gone = _merged_spans(flat)
                rest = _kept(text.encode(), gone)
                rows.append((key, sum(b - a for a, b in gone), len(gone), hashlib.sha256(rest).hexdigest()))
            columns = list(zip(*rows, strict=True))
            kinds, names = [pa.int64(), pa.int64(), pa.int64(), pa.string()], ["key", "n_removed", "n_spans", "sha"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    joined = held.select("key", "text").join(found, "key")
    cut = joined.mapInArrow(work, "key long, n_removed long, n_spans long, sha string").dropDuplicates(["key"])
    whole = numbered(documents).select(
        "doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("own")
    )
    return whole.join(cut, "key", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("sha", "own").alias("kept_sha256"),
    )


def whole_characters(data: bytes, removed_spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans drawn in to the characters they cover whole."""
    out = []
    for a, b in removed_spans:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def without_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with repeated strings cut out of `text` (characters cut whole or not at all).

    `n_chars`, where there is one, is counted anew; other columns stay as they are.
    """
    held, found = spans(documents, length)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            columns = (batch.column(c).to_pylist() for c in ("text", "spans"))
            made = []
            for text, flat in zip(*columns, strict=True):
                data = text.encode()
                made.append(_kept(data, whole_characters(data, _merged_spans(flat))).decode())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(made, pa.string())], ["key", "cut"])

    cut = held.select("key", "text").join(found, "key").mapInArrow(work, "key long, cut string")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The row travels whole in a column of its own, so none of its names can clash.
    keyed = documents.select(
        F.struct(*[F.col(quoted(c)) for c in documents.columns]).alias("row"),
        _key(F.col("doc_id").cast("long"), text).alias("key"),
    )
    joined = keyed.join(cut.dropDuplicates(["key"]), "key", "left")
    own = {c: F.col("row").getField(c) for c in documents.columns}
    changed = {"text": F.coalesce(F.col("cut"), own["text"])}
    if "n_chars" in documents.columns:
        changed["n_chars"] = F.when(F.col("cut").isNull(), own["n_chars"]).otherwise(
            F.length("cut").cast(documents.schema["n_chars"].dataType)
        )
    return joined.select(*[changed.get(c, own[c]).alias(c) for c in documents.columns])
