"""Segmentation lattices of many words at once over the pieces of a SentencePiece vocabulary.

A word is the word boundary mark and the characters up to the next blank.  Its nodes are the
places between characters, its edges the pieces that match there.  A character that is no piece
itself is spelled by its UTF-8 byte pieces, as one edge.  Pieces with a mark anywhere but at
their start are left out, so the lattice of a text is the chain of those of its words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from eventgauge.llm.shared import mixed

MARK = "▁"
_FACTOR = 0x9E3779B97F4A7C15


class Vocabulary:
    """The pieces of a model, with log weights from its scores.

    The scores of the model are ranks of merges; a piece of rank r gets the weight of Zipf's
    law, -log(r + 2.7), normalised over all pieces.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.model, n = model, model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.byte = np.full(256, -1, np.int64)
        plain = []
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and MARK not in piece[1:]:
                plain.append(i)
        ranks = np.array([-model.get_score(i) for i in range(n)])
        weights = np.full(n, -np.inf)
        used = np.array([*plain, *self.byte[self.byte >= 0]])
        # Byte pieces have no merge rank; they count as the last.
        ranks[self.byte[self.byte >= 0]] = ranks[plain].max() + 1
        weights[used] = -np.log(ranks[used] + 2.7)
        self.weights = weights - np.log(np.exp(weights[used]).sum())
        # Hashes of all pieces and of all their beginnings, by length.
        self.longest = max(len(self.pieces[i]) for i in plain)
        table: list[dict[int, int]] = [{} for _ in range(self.longest + 1)]
        for i in plain:
            codes = np.array([ord(c) for c in self.pieces[i]], np.uint64)
            sums = np.cumsum(mixed(codes + np.uint64(1)) * _powers(len(codes)))
            for k, h in enumerate(sums.tolist(), 1):
                table[k].setdefault(h, -1)
            table[len(codes)][int(sums[-1])] = i
        self.hashes = [np.array(sorted(t), np.uint64) for t in table]
        self.ids = [np.array([t[h] for h in sorted(t)], np.int64) for t in table]
        self.one = np.zeros(0x110000, bool)
        self.one[[ord(self.pieces[i]) for i in plain if len(self.pieces[i]) == 1]] = True
        self.decoded = [p.replace(MARK, " ").encode() for p in self.pieces]
        for value, i in enumerate(self.byte.tolist()):
            if i >= 0:
                self.decoded[i] = bytes([value])
        self.spelled = pa.array(self.decoded, pa.large_binary())


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, _FACTOR, np.uint64))


@dataclass
class Lattice:
    """Nodes of all words end to end (length + 1 each); edges sorted by the node they leave."""

    roots: np.ndarray
    ends: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    piece: np.ndarray
    codes: np.ndarray
    first: np.ndarray
    after: np.ndarray

    @classmethod
    def of(cls, words: list[str], vocabulary: Vocabulary) -> Lattice:
        """`words` without their marks."""
        sizes = np.array([len(w) + 1 for w in words], np.int64)
        codes = np.frombuffer((MARK + MARK.join(words)).encode("utf-32-le"), np.uint32) if words else np.zeros(0, np.uint32)
        starts = np.cumsum(sizes) - sizes
        word = np.repeat(np.arange(len(words)), sizes)
        left = np.repeat(starts + sizes, sizes) - np.arange(len(codes))
        spelled = mixed(codes.astype(np.uint64) + np.uint64(1))
        powers = _powers(max(1, vocabulary.longest))
        active = np.arange(len(codes))
        sums = np.zeros(len(codes), np.uint64)
        begin, length, piece = [], [], []
        for k in range(1, vocabulary.longest + 1):
            fits = left[active] >= k
            active, sums = active[fits], sums[fits]
            if not len(active):
                break
            sums = sums + spelled[active + k - 1] * powers[k - 1]
            at = np.minimum(np.searchsorted(vocabulary.hashes[k], sums), len(vocabulary.hashes[k]) - 1)
            known = vocabulary.hashes[k][at] == sums
            active, sums, at = active[known], sums[known], at[known]
            ids = vocabulary.ids[k][at]
            whole = ids >= 0
            begin.append(active[whole])
            length.append(np.full(int(whole.sum()), k))
            piece.append(ids[whole])
        # The other characters are spelled by bytes: piece -1.
        odd = np.flatnonzero(~vocabulary.one[codes])
        begin.append(odd)
        length.append(np.ones(len(odd), np.int64))
        piece.append(np.full(len(odd), -1))
        begin, length, piece = map(np.concatenate, (begin, length, piece))
        by = np.argsort(begin, kind="stable")
        begin, length, piece = begin[by], length[by], piece[by]
        # Node numbers count one more place for every word before.
        start = begin + word[begin] if len(begin) else begin
        nodes = len(codes) + len(words)
        counts = np.bincount(start, minlength=nodes)
        after = np.cumsum(counts)
        roots = starts + np.arange(len(words))
        return cls(roots, roots + sizes, start, start + length, piece, codes[begin], after - counts, after)

    def scores(self, vocabulary: Vocabulary, weights: np.ndarray) -> np.ndarray:
        """The log weight of every edge."""
        out = weights[np.maximum(self.piece, 0)].astype(float)
        spelled = np.flatnonzero(self.piece < 0)
        if len(spelled):
            codes, back = np.unique(self.codes[spelled], return_inverse=True)
            each = [weights[vocabulary.byte[list(_utf8(c))]].sum() for c in codes.tolist()]
            out[spelled] = np.array(each)[back]
        return out

    def _levels(self, distance: np.ndarray, node: np.ndarray) -> list[np.ndarray]:
        """Edges by the distance of one of their nodes, ascending, those of a node together."""
        d = distance[node]
        if node is self.start and len(d) and d.max() < 32767:  # edges are sorted by it; a stable radix sort will do
            by = np.argsort(d.astype(np.int16), kind="stable")
        else:
            by = np.lexsort((node, d))
        cuts = np.flatnonzero(np.diff(d[by])) + 1
        return np.split(by, cuts) if len(by) else []

    def backward(self, scores: np.ndarray) -> np.ndarray:
        """For every node the log weight of all ways from it to the end of its word."""
        n = len(self.first)
        distance = np.repeat(self.ends, np.diff(np.append(self.roots, n))) - np.arange(n)
        out = np.full(n, -np.inf)
        out[self.ends] = 0.0
        for edges in self._levels(distance, self.start):
            _gather(out, scores[edges] + out[self.stop[edges]], self.start[edges])
        return out

    def forward(self, scores: np.ndarray) -> np.ndarray:
        """For every node the log weight of all ways to it from the start of its word."""
        n = len(self.first)
        distance = np.arange(n) - np.repeat(self.roots, np.diff(np.append(self.roots, n)))
        out = np.full(n, -np.inf)
        out[self.roots] = 0.0
        for edges in self._levels(distance, self.stop):
            _gather(out, scores[edges] + out[self.start[edges]], self.stop[edges])
        return out


def _utf8(code: int) -> bytes:
    return chr(code).encode("utf-8", "surrogatepass")


def _gather(out: np.ndarray, values: np.ndarray, nodes: np.ndarray) -> None:
    """out[node] = log of the sum of exp(values) of its edges; edges of a node are neighbours."""
    first = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
    top = np.maximum.reduceat(values, first)
    sizes = np.diff(np.append(first, len(nodes)))
    out[nodes[first]] = top + np.log(np.add.reduceat(np.exp(values - np.repeat(top, sizes)), first))


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]
