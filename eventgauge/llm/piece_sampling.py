"""SentencePiece encoding and decoding, and distinct sampled segmentations of whole texts.

The k samples of a text are a Gumbel top-k without replacement over all its segmentations,
found by a perturbed A-star search: backward sums over the lattice make the bound of every
region of segmentations exact, so a region's largest perturbed log-probability is drawn at once
and only the k best regions are ever opened.  A region is "as sample A up to a step, there a
different piece"; opening it draws the rest of the way by the exact conditional probabilities.

Every sample has its log-probability, its perturbed value, and its inclusion probability given
the largest perturbed value left out.  Random numbers are a hash of the row's id and text, the
sample and the place, so results do not depend on partitioning or retries.

Defined results: a null text is the empty text, which has one segmentation without pieces;
a text with fewer than k segmentations gives them all, with inclusion 1; equal rows give equal
samples; a null id counts as the largest number for the seed; an empty table gives no rows;
further columns are ignored.  Runs of blanks are spelled by single marks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventgauge.llm.lattice import Lattice, Vocabulary, vocabulary
from eventgauge.llm.shared import LAST, mixed, steps, texts

SAMPLES = 2
BATCH_BYTES = 6 << 20
#: Steps so far below the best can never have the largest perturbed value.
SPREAD = 41.0
_STEP = np.uint64(0x9E3779B97F4A7C15)


def uniforms(seeds: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that depend on a seed and a number only."""
    bits = mixed(seeds ^ mixed(numbers.astype(np.uint64) * _STEP + np.uint64(1)))
    return ((bits >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


class Sampler:
    """Draws ways from nodes to the ends of their words."""

    def __init__(self, words: list[str], given: Vocabulary, weights: np.ndarray):
        self.lattice = Lattice.of(words, given)
        scores = self.lattice.scores(given, weights)
        back = self.lattice.backward(scores)
        self.log_chance = scores + back[self.lattice.stop] - back[self.lattice.start]
        # Up to and with each edge, the chance of the edges of its node; at most 1 at the last.  A
        # node's are added up on their own: one running sum's rounding would depend on the batch.
        self.reached = np.exp(self.log_chance)
        first, after = self.lattice.first, self.lattice.after
        edge = first[after - first > 1] + 1
        last = after[after - first > 1] - 1
        while len(edge):
            self.reached[edge] += self.reached[edge - 1]
            more = edge < last
            edge, last = edge[more] + 1, last[more]
        self.reached[after[after > first] - 1] = 2.0
        self.is_end = np.zeros(len(self.lattice.first), bool)
        self.is_end[self.lattice.ends] = True

    def ways(self, nodes: np.ndarray, seeds: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
        """Edges from each node to the end of its word, end to end, and how many for each.

        What a node draws depends on its seed and the salt, not on its place among the nodes.
        """
        places = np.flatnonzero(~self.is_end[nodes])
        at = nodes[places]
        found, owner = [], []
        steps_ = np.zeros(len(nodes), np.int64)
        step = 0
        while len(places):
            u = uniforms(seeds[places], np.array([step + (salt << 40)]))
            edge = self.lattice.first[at]
            going = np.flatnonzero(self.reached[edge] < u)
            while len(going):
                edge[going] += 1
                going = going[self.reached[edge[going]] < u[going]]
            found.append(edge)
            owner.append(places)
            steps_[places] += 1
            at = self.lattice.stop[edge]
            on = ~self.is_end[at]
            places, at = places[on], at[on]
            step += 1
        edges = np.zeros(int(steps_.sum()), np.int64)
        begins = np.cumsum(steps_) - steps_
        for step, (places, edge) in enumerate(zip(owner, found, strict=True)):
            edges[begins[places] + step] = edge
        return edges, steps_


def _truncated(location: np.ndarray, u: np.ndarray, top: float) -> np.ndarray:
    """Gumbel variables of the locations, given that none is above `top`."""
    with np.errstate(divide="ignore", over="ignore"):
        free = location - np.log(-np.log(u))
        return -np.logaddexp(-top, -free)


class Searches:
    """The regions of all texts of a batch.  A sample is a list of edges; its regions are its steps."""

    def __init__(self, sampler: Sampler, seeds: np.ndarray):
        self.sampler, self.seeds = sampler, seeds
        n = len(seeds)
        self.samples: list[list[np.ndarray]] = [[] for _ in range(n)]
        self.value: list[list[float]] = [[] for _ in range(n)]
        #: Minus the log-chance of the steps before each step, and of all.
        self.cost: list[list[np.ndarray]] = [[] for _ in range(n)]
        #: The values of the regions, and the step of the first one.
        self.open: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(n)]
        self.barred: list[dict[tuple[int, int], list[int]]] = [{} for _ in range(n)]

    def add(self, who: list[int], edges: np.ndarray, bounds: np.ndarray, value: np.ndarray, since: np.ndarray) -> None:
        """A new sample for each text of `who`; its steps from `since` on become regions."""
        if not len(who):
            return
        number = len(self.samples[who[0]])
        starts, sizes = bounds[:-1], np.diff(bounds)
        chances = self.sampler.log_chance[edges]
        cost = np.zeros(len(edges) + len(who))
        for n, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            np.cumsum(chances[a:b], out=cost[a + n + 1 : b + n + 1])
        np.subtract(0.0, cost, out=cost)
        shift = starts + np.arange(len(who))

        def located(first: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Log-chances of "as the sample up to the step, there a different piece"; steps and texts."""
            counts = after - first
            text = np.repeat(np.arange(len(counts)), counts)
            step = np.arange(len(text)) + np.repeat(first - np.cumsum(counts) + counts, counts)
            own = chances[starts[text] + step]
            with np.errstate(divide="ignore"):
                other = np.log(-np.expm1(np.minimum(own, 0.0)))
            return np.where(own > -1e-12, -np.inf, other) - cost[shift[text] + step], step, text

        # A uniform number of 52 bits moves a location by -3.6 to 36.7, so a step whose location
        # (at most its prefix) is 41 below another's cannot win: its regions are never opened.
        end, most = since.copy(), np.full(len(who), -np.inf)
        left = np.flatnonzero(end < sizes)
        while len(left):
            grown = np.maximum(end + 128, 4 * (end - since) + since)
            end[left] = np.minimum(sizes, grown)[left]
            after = since.copy()
            after[left] = end[left]
            location, _, text = located(since, after)
            np.maximum.at(most, text, location)
            left = left[(end[left] < sizes[left]) & ~np.isfinite(most[left])]
        for n in np.flatnonzero(np.isfinite(most)).tolist():
            paid = cost[shift[n] : shift[n] + sizes[n]]
            end[n] = max(since[n], int(np.searchsorted(paid, SPREAD - most[n], side="right")))
        location, step, text = located(since, end)
        u = uniforms(self.seeds[who][text], step + ((number + 1) << 44))
        held = _truncated(location, u, value[text])
        held[~np.isfinite(location)] = -np.inf
        cuts = np.concatenate([[0], np.cumsum(end - since)]).tolist()
        for n, owner in enumerate(who):
            self.samples[owner].append(edges[bounds[n] : bounds[n + 1]])
            self.value[owner].append(float(value[n]))
            self.cost[owner].append(cost[shift[n] : shift[n] + sizes[n] + 1])
            self.open[owner].append((int(since[n]), held[cuts[n] : cuts[n + 1]]))

    def best(self, n: int) -> tuple[float, int, int]:
        """The largest value of a region of a text, its sample and its step."""
        out = (-np.inf, -1, -1)
        for k, (since, held) in enumerate(self.open[n]):
            if len(held):
                step = int(held.argmax())
                if held[step] > out[0]:
                    out = (float(held[step]), k, since + step)
        return out

    def enter(self, regions: list[tuple[int, float, int, int]]) -> list[int]:
        """Choose another edge in each region (text, value, sample, step) and close or narrow the region."""
        number = (len(self.samples[regions[0][0]]) << 44) + (1 << 43)
        who = np.array([r[0] for r in regions])
        u, narrowed = (uniforms(self.seeds[who], np.full(len(who), number + x)) for x in (0, 1))
        lattice, log_chance = self.sampler.lattice, self.sampler.log_chance
        chosen, location = [], np.full(len(who), -np.inf)
        for at, (n, _, k, step) in enumerate(regions):
            own = int(self.samples[n][k][step])
            barred = self.barred[n].setdefault((k, step), [own])
            node = lattice.start[own]
            edges = [e for e in range(int(lattice.first[node]), int(lattice.after[node])) if e not in barred]
            chances = np.exp(log_chance[edges])
            place = min(int(np.searchsorted(chances.cumsum(), u[at] * chances.sum())), len(edges) - 1)
            chosen.append(edges[place])
            barred.append(edges[place])
            rest = np.delete(chances, place).sum()
            if rest > 0:
                location[at] = np.log(rest) - self.cost[n][k][step]
        values = _truncated(location, narrowed, np.array([r[1] for r in regions]))
        values[~np.isfinite(location)] = -np.inf
        for (n, _, k, step), value in zip(regions, values, strict=True):
            since, held = self.open[n][k]
            held[step - since] = value
        return chosen


def sample_batch(
    batch_texts: list[str], seeds: list[int], k: int, given: Vocabulary, weights: np.ndarray
) -> Iterator[tuple[int, int, np.ndarray, float, float, float]]:
    """(text, sample, piece ids, log-probability, perturbed value, inclusion probability)."""
    parts = pc.split_pattern(pa.array(batch_texts, pa.large_string()), " ")
    coded = parts.flatten().dictionary_encode()
    flat, bounds = coded.indices.to_numpy().astype(np.int64), parts.offsets.to_numpy()
    # An empty text has no word, though splitting gives it one empty part.
    full = np.array([bool(t) for t in batch_texts], bool)
    sampler = Sampler(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), given, weights)
    lattice = sampler.lattice
    seed_of = np.array(seeds, np.uint64)
    searches = Searches(sampler, seed_of)
    spelled = bool((lattice.piece < 0).any())

    def drawn(nodes: np.ndarray, counts: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        """The ways from the nodes of all texts, and the places where texts begin; seeds differ by place."""
        bounds = np.concatenate([[0], np.cumsum(counts)])
        ranks = np.arange(len(nodes)) - np.repeat(bounds[:-1], counts)
        edges, taken = sampler.ways(nodes, mixed(np.repeat(seed_of, counts) ^ ranks.astype(np.uint64)), number)
        return edges, np.concatenate([[0], np.cumsum(taken)])[bounds]

    # First samples: all words of all texts.
    sizes = np.where(full, np.diff(bounds), 0)
    roots = lattice.roots[flat[np.repeat(full, np.diff(bounds))]]
    words = np.concatenate([[0], np.cumsum(sizes)])
    ids, who = [], list(range(len(seeds)))
    edges, cuts = drawn(roots, sizes, 0)
    u = uniforms(seed_of, np.full(len(seeds), 1 << 60))
    searches.add(who, edges, cuts, -np.log(-np.log(u)), np.zeros(len(seeds), np.int64))
    ids.append(dict(zip(who, _ids(edges, cuts, spelled, lattice, given), strict=True)))
    for number in range(1, k):
        regions = []
        for n in range(len(seeds)):
            value, parent, step = searches.best(n)
            if np.isfinite(value):
                regions.append((n, value, parent, step))
        if not regions:
            break
        entered = searches.enter(regions)
        nodes, counts = [], np.zeros(len(seeds), np.int64)
        for (n, _, parent, step), edge in zip(regions, entered, strict=True):
            # The word of the step: as many words end before it in the parent sample.
            passed = int(sampler.is_end[lattice.stop[searches.samples[n][parent][:step]]].sum())
            nodes += [lattice.stop[edge : edge + 1], roots[words[n] + passed + 1 : words[n + 1]]]
            counts[n] = words[n + 1] - words[n] - passed
        rest, cuts = drawn(np.concatenate(nodes), counts, number)
        whole = []
        for (n, _, parent, step), edge in zip(regions, entered, strict=True):
            whole += [searches.samples[n][parent][:step], [edge], rest[cuts[n] : cuts[n + 1]]]
        who, values, _, since = (list(x) for x in zip(*regions, strict=True))
        cuts = np.concatenate([[0], np.cumsum(np.array([len(x) for x in whole]).reshape(-1, 3).sum(axis=1))])
        edges = np.concatenate(whole).astype(np.int64)
        searches.add(who, edges, cuts, np.array(values), np.array(since) + 1)
        ids.append(dict(zip(who, _ids(edges, cuts, spelled, lattice, given), strict=True)))
    for n, samples in enumerate(searches.cost):
        left = searches.best(n)[0]
        for number, cost in enumerate(samples):
            log_chance = 0.0 - float(cost[-1])
            inclusion = float(-np.expm1(-np.exp(min(log_chance - left, 700.0)))) if np.isfinite(left) else 1.0
            yield n, number, ids[number][n], log_chance, searches.value[n][number], inclusion


def _ids(edges: np.ndarray, cuts: np.ndarray, spelled: bool, lattice: Lattice, given: Vocabulary) -> list[np.ndarray]:
    """The piece ids of ways between cuts; a character that is no piece gives those of its bytes."""
    ids = lattice.piece[edges]
    places = np.flatnonzero(ids < 0) if spelled else ids[:0]
    if len(places):
        codes, back = np.unique(lattice.codes[edges[places]], return_inverse=True)
        each = [given.byte[list(chr(c).encode())] for c in codes.tolist()]
        sizes = np.ones(len(ids), np.int64)
        sizes[places] = np.array([len(x) for x in each])[back]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = np.repeat(ids, sizes)
        for k, part in enumerate(each):
            at = ends[places[back == k]]
            for b, value in enumerate(part.tolist()):
                ids[at + b] = value
        cuts = ends[cuts]
    return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def decode(ids: np.ndarray, given: Vocabulary) -> str:
    """The text of piece ids: marks are blanks, and the first one is dropped."""
    # Taken pieces lie end to end in one buffer.
    taken = given.spelled.take(pa.array(ids, pa.int64()))
    _, ends, held = taken.buffers()
    size = int(np.frombuffer(ends, np.int64, len(taken) + 1)[-1]) if len(taken) else 0
    return held.slice(0, size).to_pybytes()[1:].decode() if size else ""


SCHEMA = (
    "doc_id long, sample int, n_pieces int, ids_crc32 long, log_prob double, score double, inclusion double,"
    " round_trip boolean"
)


def sampled(documents: DataFrame, path: str, k: int = SAMPLES, with_ids: bool = False) -> DataFrame:
    """Up to k distinct segmentations of every text; with `with_ids` also their ids."""
    rows = texts(documents).withColumn("seed", F.xxhash64(F.coalesce("doc_id", F.lit(LAST)), "text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = vocabulary(path)
        for batch in steps(batches, limit=BATCH_BYTES):
            listed, keys = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            seeds = batch.column("seed").to_numpy().view(np.uint64).tolist()
            made = []
            for n, number, ids, chance, value, inclusion in sample_batch(listed, seeds, k, given, given.weights):
                same = decode(ids, given) == listed[n]
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                row = (keys[n], number, len(ids), crc, chance, value, inclusion, same)
                made.append((*row, ids.astype(np.int32)) if with_ids else row)
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), *[pa.float64()] * 3, pa.bool_(), pa.list_(pa.int32())]
            names = [*(x.split()[0] for x in SCHEMA.split(", ")), "ids"]
            columns = list(zip(*made, strict=True))
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])

    return rows.mapInArrow(work, SCHEMA + (", ids array<int>" if with_ids else ""))


def encoded(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, ids: the one segmentation the model itself prefers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(path).model
        for batch in steps(batches):
            ids = model.encode(batch.column("text").to_pylist(), num_threads=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return texts(documents).mapInArrow(work, "doc_id long, ids array<int>")


def decoded(coded: DataFrame, path: str) -> DataFrame:
    """doc_id, text from doc_id, ids; null ids give the empty text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = vocabulary(path)
        for batch in batches:
            found = [decode(np.array(x or [], np.int64), given) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(work, "doc_id long, text string")
