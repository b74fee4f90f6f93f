"""Byte-level BPE encoding and decoding by forced boundaries.

A byte pair that occurs inside no token of the vocabulary can never be bridged by a merge, so it
is a certain cut: what lies on both sides is encoded on its own and the ids are joined.

1. Texts are cut before they are split into words.  Such a cut must also be certain for the
   word pattern: the character before it is no white space (the pattern looks ahead from white
   space only) and the one after it is no apostrophe (only those begin contractions).  Most
   texts fall into words this way, and each distinct fragment of a batch is encoded once.
2. Distinct fragments are split by the tokenizer's own word pattern, and again at forced pairs.
3. The fragments are merged together, one numpy step for the lowest-ranked pair of all of them.
   A fragment longer than `LONG` bytes is merged by a heap instead; the ids are the same.

Strings of special tokens are taken out first, as the library does, unless `specials` is false.

Defined results: a null text is the empty text and has no ids; unknown ids are left out when
decoding and bytes that are no UTF-8 become U+FFFD, both as in the library; a null list of ids
is the empty text; equal rows and null document ids are kept; an empty table gives no rows;
further columns are ignored.  Memory: a slice of `STEP` bytes of text, or one longer text alone.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventgauge.llm.shared import SPACE_BYTES, flat_bytes, ragged, steps, texts

#: Bytes of text encoded at once.
STEP = 2 << 20
#: Fragments of more bytes are merged by a heap.
LONG = 512
NEVER = np.iinfo(np.int32).max
#: Letters of which every version of the word pattern knows that they are letters.
WORD = r"^ ?[A-Za-zÀ-ÖØ-öø-ɏ]+$"
#: The contractions of the word pattern, whose letters stay together.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def string_array(flat: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Pieces of a byte array as a binary column, without a copy; `starts` ends with the length."""
    wide = len(flat) >= 1 << 31
    offsets = starts.astype(np.int64 if wide else np.int32)
    kind = pa.large_binary() if wide else pa.binary()
    return pa.Array.from_buffers(kind, len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])


class ForcedBoundaryCodec:
    """Encodes and decodes whole texts with a `tokenizers` file that holds a byte-level BPE."""

    def __init__(self, path: str, specials: bool = True):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        tokenizer = Tokenizer.from_file(path)
        described = json.loads(tokenizer.to_str())
        self.words = tokenizer.pre_tokenizer
        added = {t["content"]: t["id"] for t in described["added_tokens"]}
        vocabulary, merges = described["model"]["vocab"], described["model"]["merges"]
        # The byte of each character of the vocabulary: printable ones stand for themselves, the
        # others are numbered from code point 256 on.
        alphabet = sorted(ByteLevel.alphabet())
        byte = {c: ord(c) for c in alphabet if ord(c) < 256}
        byte |= dict(zip((c for c in alphabet if ord(c) >= 256), sorted(set(range(256)) - set(byte.values())), strict=True))
        spelled = {i: bytes(byte[c] for c in t) for t, i in vocabulary.items() if t not in added}
        self.size = max([*spelled, *added.values()]) + 1
        self.special = {t.encode(): i for t, i in added.items()}
        held = [spelled.get(i, b"") for i in range(self.size)]
        for t, i in self.special.items():
            held[i] = t
        self.lengths = np.array([len(t) for t in held], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.spelling = np.frombuffer(b"".join(held), np.uint8)
        self.special = self.special if specials else {}

        single = {t[0]: i for i, t in spelled.items() if len(t) == 1}
        self.single = np.array([single[b] for b in range(256)], np.int32)
        keys, made = [], []
        for left, right in merges:
            keys.append(vocabulary[left] * self.size + vocabulary[right])
            made.append(vocabulary[left + right])
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = np.array(keys, np.int64)[order], order.astype(np.int32)
        self.made = np.array(made, np.int32)
        self.rank_of = dict(zip(keys, range(len(keys)), strict=True))

        inside = np.zeros((256, 256), bool)
        for t in [*spelled.values(), *(c.encode() for c in CONTRACTIONS)]:
            b = np.frombuffer(t, np.uint8)
            inside[b[:-1], b[1:]] = True
        self.forced = ~inside
        first = self.ranks_of(np.repeat(self.single, 256), np.tile(self.single, 256))
        self.first = first.reshape(256, 256)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair of ids, `NEVER` where there is none."""
        wanted = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NEVER)

    def certain_cuts(self, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Places (the last is the end) where texts may be cut before words are known."""
        cut = np.zeros(len(flat) + 1, bool)
        if len(flat) > 1:
            before, after = flat[:-1], flat[1:]
            cut[1:-1] = self.forced[before, after]
            # A character ends here that may be white space, by its last two bytes.
            wide = np.isin(flat[:-2], np.array([0xC2, 0x9A, 0x80, 0x81], np.uint8)) & (before[1:] >= 0x80)
            cut[2:-1] &= ~wide
            loose = SPACE_BYTES.copy()
            loose[[*range(0x1C, 0x20), 0x27]] = True
            cut[1:-1] &= ~loose[before] & ((after & 0xC0) != 0x80) & (after != 0x27)
        for special in self.special:
            held = flat.tobytes()
            place = held.find(special)
            while place >= 0:
                end = place + len(special)
                # A match must not reach from one text into the next.
                if np.searchsorted(offsets, place, "right") == np.searchsorted(offsets, end, "left"):
                    cut[place + 1 : end] = False
                    cut[[place, end]] = True
                    place = held.find(special, end)
                else:
                    place = held.find(special, place + 1)
        cut[offsets] = True
        return np.flatnonzero(cut)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts of a string column without nulls, and the n + 1 places they begin."""
        flat, offsets = flat_bytes(column)
        if not len(flat):
            return np.zeros(0, np.int32), np.zeros(len(column) + 1, np.int64)
        starts = self.certain_cuts(flat, offsets)
        coded = string_array(flat, starts).dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        ids, begins = self.fragments(coded.dictionary)
        out, ends = ragged(ids, begins, codes)
        return out, ends[np.searchsorted(starts, offsets)]

    def fragments(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct fragments, and the n + 1 places they begin."""
        flat, offsets = flat_bytes(distinct)
        cut = np.zeros(len(flat) + 1, bool)
        cut[offsets] = True
        cut[1:-1] |= self.forced[flat[:-1], flat[1:]]
        special = np.full(len(distinct), -1, np.int64)
        for text, identity in self.special.items():
            special[pc.equal(distinct, pa.scalar(text, distinct.type)).to_numpy(False)] = identity
        letters = distinct.cast(pa.large_string() if distinct.type == pa.large_binary() else pa.string())
        several = ~pc.match_substring_regex(letters, WORD).to_numpy(False) & (special < 0)
        several &= np.diff(offsets) > 1
        at = np.flatnonzero(several)
        for start, text in zip(offsets[at].tolist(), letters.take(pa.array(at)).to_pylist(), strict=True):
            for word, _ in self.words.pre_tokenize_str(text):
                start += len(word)
                cut[start] = True
        starts = np.flatnonzero(cut)
        ids, begins = self.merged(flat, starts)
        begins = begins[np.searchsorted(starts, offsets)]
        for place in np.flatnonzero(special >= 0).tolist():
            ids[begins[place]] = special[place]
            ids[begins[place] + 1 : begins[place + 1]] = -1
        if (special >= 0).any():
            kept = np.concatenate([[0], np.cumsum(ids >= 0)])
            ids, begins = ids[ids >= 0], kept[begins]
        return ids, begins

    def merged(self, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of independent fragments of a byte array, and the n + 1 places they begin."""
        lengths = np.diff(starts)
        sizes = np.ones(len(lengths), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for k in np.flatnonzero(lengths > LONG).tolist():
            found = self._heap(self.single[flat[starts[k] : starts[k + 1]]].tolist())
            done.append((np.array([k]), np.array(found, np.int32)))
            sizes[k] = len(found)
        active = np.flatnonzero(lengths <= LONG)
        held, _ = ragged(flat, starts, active)
        symbols, lengths = self.single[held], lengths[active]
        ranks = np.full(len(symbols), NEVER, np.int32)
        ranks[:-1] = self.first[held[:-1], held[1:]]
        while len(active):
            begins = np.cumsum(lengths) - lengths
            ranks[begins + lengths - 1] = NEVER
            least = np.minimum.reduceat(ranks, begins)
            over = least == NEVER
            if over.any():
                whole = np.repeat(over, lengths)
                done.append((active[over], symbols[whole]))
                sizes[active[over]] = lengths[over]
                active, lengths, least = active[~over], lengths[~over], least[~over]
                symbols, ranks = symbols[~whole], ranks[~whole]
                if not len(active):
                    break
            at = np.flatnonzero(ranks == np.repeat(least, lengths))
            # Of pairs that overlap (the same symbol again and again) every other one is merged.
            fresh = np.ones(len(at), bool)
            fresh[1:] = at[1:] != at[:-1] + 1
            runs = np.flatnonzero(fresh)
            at = at[(np.arange(len(at)) - runs[np.cumsum(fresh) - 1]) % 2 == 0]
            owner = np.repeat(np.arange(len(active)), lengths)[at]
            symbols[at] = self.made[ranks[at]]
            kept = np.ones(len(symbols), bool)
            kept[at + 1] = False
            lengths = lengths - np.bincount(owner, minlength=len(active))
            place = np.cumsum(kept) - 1
            symbols, ranks = symbols[kept], ranks[kept]
            changed = np.zeros(len(symbols) + 1, bool)
            changed[place[at]] = changed[place[at] - 1] = True
            touched = np.flatnonzero(changed[:-2])
            ranks[touched] = self.ranks_of(symbols[touched], symbols[touched + 1])
            # A pair across two fragments is no pair; their ends are reset at the next step.
        begins = np.concatenate([[0], np.cumsum(sizes)])
        out = np.zeros(begins[-1], np.int32)
        for which, found in done:
            spread = sizes[which]
            shift = np.repeat(begins[which] - (np.cumsum(spread) - spread), spread)
            out[np.arange(len(found)) + shift] = found
        return out, begins

    def _heap(self, symbols: list[int]) -> list[int]:
        """One long fragment: the lowest rank first, from the left among equals."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def rank(left: int, right: int) -> int | None:
            return self.rank_of.get(symbols[left] * self.size + symbols[right])

        queue = [(r, k, symbols[k], symbols[k + 1]) for k in range(n - 1) if (r := rank(k, k + 1)) is not None]
        heapq.heapify(queue)
        while queue:
            r, k, left, right = heapq.heappop(queue)
            nxt = after[k]
            if symbols[k] != left or nxt >= n or symbols[nxt] != right:
                continue
            symbols[k], symbols[nxt] = int(self.made[r]), -1
            after[k] = after[nxt]
            if after[k] < n:
                before[after[k]] = k
                if (r := rank(k, after[k])) is not None:
                    heapq.heappush(queue, (r, k, symbols[k], symbols[after[k]]))
            if before[k] >= 0 and (r := rank(before[k], k)) is not None:
                heapq.heappush(queue, (r, before[k], symbols[before[k]], symbols[k]))
        return [s for s in symbols if s >= 0]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of lists of ids."""
        known = (ids >= 0) & (ids < self.size)
        if not known.all():
            offsets = np.concatenate([[0], np.cumsum(known)])[offsets]
            ids = ids[known]
        ends = np.concatenate([[0], np.cumsum(self.lengths[ids])])[offsets]
        flat, _ = ragged(self.spelling, np.append(self.begins, len(self.spelling)), ids)
        found = string_array(flat, ends)
        try:
            return found.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([x.decode("utf-8", "replace") for x in found.to_pylist()], pa.large_string())


_CODECS: dict[tuple[str, bool], ForcedBoundaryCodec] = {}


def codec(path: str, specials: bool = True) -> ForcedBoundaryCodec:
    """The codec of a file, made once a worker."""
    if (path, specials) not in _CODECS:
        _CODECS[path, specials] = ForcedBoundaryCodec(path, specials)
    return _CODECS[path, specials]


def encoded(documents: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every whole text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = codec(path)
        for piece in steps(batches, limit=STEP):
            ids, offsets = held.encode(piece.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), lists], ["doc_id", "ids"])

    return texts(documents, id_column, text_column).mapInArrow(work, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and ids as given, and the text that the ids spell."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = codec(path)
        for batch in batches:
            lists = batch.column("ids")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(False)
            ids = pc.fill_null(pc.list_flatten(lists), -1).to_numpy(False)
            offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            text = held.decode(ids, offsets).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, text], ["doc_id", "ids", "text"])

    return rows.select("doc_id", "ids").mapInArrow(work, "doc_id long, ids array<int>, text string")


def coded(documents: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`decoded` of `encoded`, by one worker a task: doc_id, ids and the text that the ids spell."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = codec(path)
        for piece in steps(batches, limit=STEP):
            ids, offsets = held.encode(piece.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            text = held.decode(ids, offsets).cast(pa.string())
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), lists, text], ["doc_id", "ids", "text"])

    return texts(documents, id_column, text_column).mapInArrow(work, "doc_id long, ids array<int>, text string")


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of encoded and decoded rows."""
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
