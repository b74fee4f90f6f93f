"""Near-duplicate join: five-word shingles, Jaccard similarity of at least 0.8.

1. Documents with equal shingle sets form one node; everything further happens on nodes.
2. MinHash bands propose candidates: a pair of similarity 0.8 shares none of the 40 bands of
   six minima with a probability of 5e-6.  Only (band key, node) rows move.
3. Candidate nodes are dealt to groups: small components of the candidate graph as a whole,
   large ones by band key, and a band key with very many nodes by pairs of chunks, so no task
   holds more than two chunks.  A pair is looked at in one group only.
4. In a group, candidate pairs are pruned by Bayes: their minima are compared block by block,
   and a pair goes when the posterior probability that its similarity reaches the threshold
   falls below a tolerance.  The rest is verified exactly on the sets.
5. A group returns, for each node, its number of links and one edge to the root of its part:
   as many rows as nodes, however many links there are.  Components of these edges are the
   classes.

Defined results: a null text is the empty text; a text without words is alone in its class;
a text of fewer than five words has one shingle, all its words; null ids come last and are
kept; equal rows are returned each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventgauge.llm.components import components
from eventgauge.llm.shared import LAST, cell, flat_bytes, matched, quoted, steps, stored, texts, told
from eventgauge.llm.words import MinHash, shingle_sets

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 6
BLOCK = 30
TOLERANCE = 1e-9
#: Nodes of a chunk; a group holds two chunks at most.
CHUNK = 1024
#: Shingles whose sets a task holds, on average.
TASK_SHINGLES = 1_000_000
LEAST_TASKS = 48


def least_matches(threshold: float, tolerance: float, size: int, block: int) -> list[int]:
    """For each block end, the fewest equal minima with which a pair goes on.

    With a uniform prior, m of n equal minima leave the similarity Beta(m + 1, n - m + 1)
    distributed; its mass above t is the chance of at most m hits in n + 1 trials of chance t.
    """
    out = []
    for n in range(block, size + 1, block):
        mass, m = 0.0, -1
        while mass < tolerance:
            m += 1
            mass += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def signed(documents: DataFrame) -> DataFrame:
    """doc_id, node, n (shingles), keys (one a band)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(BANDS, ROWS)
        for batch in steps(batches):
            sets = shingle_sets(*flat_bytes(batch.column("text")), SHINGLE)
            keys = hasher.keys(np.stack([hasher.signature(s) for s in sets]))
            ends = pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([node_of(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(ends, pa.array(keys.ravel())),
                ],
                ["doc_id", "node", "n", "keys"],
            )

    return texts(documents).mapInArrow(work, "doc_id long, node long, n long, keys array<long>")


def candidates(nodes: DataFrame) -> DataFrame:
    """key, node, size, least of every band key that at least two nodes share."""
    pairs = nodes.select("node", F.explode("keys").alias("key"))
    shared = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("least")).filter("size > 1")
    return matched(pairs, stored(shared, "shared"), "key", "size")


def node_sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, copies, keys, signature, shingles of the wanted nodes (least, node, copies)."""
    keyed = texts(documents).select(F.coalesce("doc_id", F.lit(LAST)).alias("least"), "text")
    joined = keyed.join(wanted, "least").select("node", "copies", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(BANDS, ROWS)
        for batch in steps(batches):
            sets = shingle_sets(*flat_bytes(batch.column("text")), SHINGLE)
            rows = []
            for node, copies, s in zip(*(batch.column(c).to_pylist() for c in ("node", "copies")), sets, strict=True):
                if node_of(s) == node:  # an id may stand for more than one text
                    signature = hasher.signature(s)
                    rows.append((node, copies, hasher.keys(signature)[0].tobytes(), signature.tobytes(), s.tobytes()))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            names = ["node", "copies", "keys", "signature", "shingles"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return joined.mapInArrow(work, "node long, copies long, keys binary, signature binary, shingles binary")


def similar_pairs(
    keys: np.ndarray, signatures: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, band: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i from left, j from right, i < j where both hold both) of at least the threshold.

    `band` is -1 for pairs that share any band, else pairs are taken that share this band and
    none before it.
    """
    fewest = least_matches(THRESHOLD, TOLERANCE, signatures.shape[1], BLOCK)
    sizes = np.array([len(s) for s in sets])
    found: list[np.ndarray] = []
    for start in range(0, len(left), 256):
        rows = left[start : start + 256]
        if band < 0:
            near = np.zeros((len(rows), len(right)), bool)
            for b in range(keys.shape[1]):
                near |= keys[rows, b][:, None] == keys[right, b]
        else:
            near = keys[rows, band][:, None] == keys[right, band]
            for b in range(band):
                near &= keys[rows, b][:, None] != keys[right, b]
        if left is right:
            near &= rows[:, None] < right
        i, j = np.nonzero(near)
        i, j = rows[i], right[j]
        # Sets whose sizes differ too much cannot reach the threshold.
        fits = np.minimum(sizes[i], sizes[j]) >= THRESHOLD * np.maximum(sizes[i], sizes[j]) - 1e-9
        i, j = i[fits], j[fits]
        equal = np.zeros(len(i), np.int64)
        for k, least in enumerate(fewest):
            part = slice(k * BLOCK, (k + 1) * BLOCK)
            for a in range(0, len(i), 100_000):
                z = slice(a, a + 100_000)
                equal[z] += (signatures[i[z], part] == signatures[j[z], part]).sum(axis=1)
            on = equal >= least
            i, j, equal = i[on], j[on], equal[on]
        exact = np.zeros(len(i), bool)
        for p, (a, b) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
            x, y = (sets[a], sets[b]) if len(sets[a]) <= len(sets[b]) else (sets[b], sets[a])
            at = np.searchsorted(y, x)
            both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
            exact[p] = both >= THRESHOLD * (len(x) + len(y) - both) - 1e-9
        found.append(np.stack([i[exact], j[exact]]))
    whole = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return whole[0], whole[1]


def roots(n: int, i: np.ndarray, j: np.ndarray) -> list[int]:
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


LINKS = "node long, root long, links long, documents long"


def compared(group: pd.DataFrame) -> pd.DataFrame:
    """One row per node of a task's groups: its links in the group and the root of its part."""
    out = []
    for (_, band, first, second), rows in group.groupby(["part", "band", "first", "second"], sort=True):
        rows = rows.drop_duplicates("node").sort_values("node")
        keys = np.stack([np.frombuffer(x, np.int64) for x in rows["keys"]])
        signatures = np.stack([np.frombuffer(x, np.uint32) for x in rows["signature"]])
        sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
        everyone = np.arange(len(rows))
        if first == second:
            i, j = similar_pairs(keys, signatures, sets, everyone, everyone, int(band))
        else:
            mine = rows["chunk"].to_numpy()
            i, j = similar_pairs(
                keys, signatures, sets, everyone[mine == first], everyone[mine == second], int(band)
            )
        copies, nodes = rows["copies"].to_numpy(), rows["node"].to_numpy()
        links = np.bincount(i, minlength=len(rows)) + np.bincount(j, minlength=len(rows))
        documents = np.bincount(i, copies[j], len(rows)) + np.bincount(j, copies[i], len(rows))
        root = nodes[np.array(roots(len(rows), i, j), np.int64)]
        out.append(pd.DataFrame({"node": nodes, "root": root, "links": links, "documents": documents.astype(np.int64)}))
    return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in LINKS.split(", ")})


def links(documents: DataFrame, nodes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """node, root, links, documents; `nodes` has node, least, copies, n, keys."""
    members = stored(candidates(nodes.filter("n > 0")), "candidates")
    found = stored(components(members.select(F.col("node").alias("u"), F.col("least").alias("v"))), "parts")
    everyone = stored(
        members.select("node").distinct().join(found.withColumnRenamed("u", "node"), "node", "left")
        .select("node", F.coalesce("root", "node").alias("part")), "members",
    )
    sizes = everyone.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    wanted = everyone.join(nodes.select("node", "least", "copies"), "node").select("node", "least", "copies")
    sets = stored(node_sets(documents, wanted), "sets")
    small = everyone.join(sizes.filter(F.col("size") <= chunk), "part").select(
        "node", "part", F.lit(-1).alias("band"), *(F.lit(0).alias(c) for c in ("first", "second", "chunk"))
    )
    # Large components: by band key, and by pairs of chunks where a key has too many nodes.
    large = everyone.join(sizes.filter(F.col("size") > chunk).select("part"), "part").select("node")
    banded = nodes.select("node", F.posexplode("keys").alias("band", "key")).join(large, "node")
    keyed = banded.join(members.select("key", "node", "size"), ["key", "node"])
    parts = F.ceil(F.col("size") / chunk).cast("int")
    keyed = keyed.withColumn("parts", parts).withColumn("chunk", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    keyed = keyed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "node", F.col("key").alias("part"), "band",
        F.least("chunk", "other").alias("first"), F.greatest("chunk", "other").alias("second"), "chunk",
    )
    shingles = sets.agg(F.sum(F.octet_length("shingles") / 8)).first()[0] or 0
    tasks = max(LEAST_TASKS, int(shingles // TASK_SHINGLES) + 1)
    dealt = small.unionByName(keyed).withColumn(
        "task", F.pmod(F.xxhash64("part", "first", "second"), F.lit(tasks)).cast("int")
    )
    return dealt.join(sets, "node").groupBy("task").applyInPandas(compared, LINKS)


def joined(documents: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, class_id, copy_of, n_copies, n_links, n_linked_documents.

    class_id is the smallest id of the documents linked to it directly or through others,
    copy_of the smallest id with the same shingle set, n_links the number of other shingle sets
    of at least the threshold, n_linked_documents the number of their documents.
    """
    rows = stored(signed(documents), "signed")
    nodes = stored(
        rows.groupBy("node").agg(
            F.min(F.coalesce("doc_id", F.lit(LAST))).alias("least"), F.count(F.lit(1)).alias("copies"),
            F.first("n").alias("n"), F.first("keys").alias("keys"),
        ), "nodes",
    )
    found = stored(links(documents, nodes, chunk), "links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"), F.sum("documents").alias("documents"))
    edges = found.filter("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))
    classes = components(edges).withColumnRenamed("u", "node")
    known = (
        nodes.select("node", "least", "copies", "n").join(counts, "node", "left").join(classes, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    known = stored(known, "known")
    first = known.groupBy("root").agg(F.min("least").alias("class_least"))
    facts = known.join(first, "root").select("node", "least", "copies", "n", "links", "documents", "class_least")
    shown = lambda c: F.when(F.col(c) < LAST, F.col(c))
    alone = F.col("n") == 0
    return told(rows.select("doc_id", "node", cell().alias("cell")), facts, "node").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(shown("class_least")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(shown("least")).alias("copy_of"),
        F.when(alone, F.lit(1)).otherwise(F.col("copies")).cast("long").alias("n_copies"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
        F.coalesce("documents", F.lit(0)).alias("n_linked_documents"),
    )


def one_of_each(documents: DataFrame) -> DataFrame:
    """The document with the smallest id of each class, with all columns.

    Rows that share an id, null included, stay or go together: they stay if one of them would.
    """
    same = F.coalesce("doc_id", F.lit(LAST)) == F.coalesce("class_id", F.lit(LAST))
    stay = joined(documents).filter(same).select(F.coalesce("doc_id", F.lit(LAST)).alias("id")).distinct()
    # The row travels whole in a column of its own, so none of its names can clash.
    keyed = documents.select(
        F.struct(*[F.col(quoted(c)) for c in documents.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"),
    )
    return keyed.join(stay, "id", "left_semi").select("row.*")
