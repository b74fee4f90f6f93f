"""Exact duplicates: digests of a batch screened by the filters of an immutable snapshot.

A snapshot is a table of distinct digests in buckets with one static binary-fuse filter per
bucket.  A new batch is first grouped by digest (duplicates inside the batch); its distinct
digests then pass the filter of their bucket.  What the filter denies is new.  What it lets
through joins the exact bucket, where all 32 bytes of the digest and the byte length are
compared, so false positives of the filter change nothing.

Only digests move, never texts.  A digest that a third of all rows share is first grouped in
1024 salted cells and then over at most as many cells.

Defined results: a null text is the empty text; rows with equal text and equal id are all
returned and one of them is kept; a null id comes after all others, and of several null ids
one is kept; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventgauge.llm.shared import LAST, SPACE, cell, mixed, quoted, stored, texts

#: Digests a bucket holds on average; one filter of about 1.2 bytes a digest is built in a task.
BUCKET_KEYS = 50_000
LEAST_BUCKETS = 48


class BinaryFuseFilter:
    """A static three-wise binary-fuse filter with one-byte fingerprints over 64-bit keys."""

    def __init__(self, seed: int, segment: int, segments: int, cells: np.ndarray):
        self.seed, self.segment, self.segments, self.cells = seed, segment, segments, cells

    @staticmethod
    def _places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        h = mixed(keys + np.uint64(seed))
        first = ((h >> np.uint64(32)) * np.uint64(segments * segment)) >> np.uint64(32)
        mask = np.uint64(segment - 1)
        second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
        third = (first + np.uint64(2 * segment)) ^ (h & mask)
        prints = ((h ^ (h >> np.uint64(32))) & np.uint64(255)).astype(np.uint8)
        return np.stack([first, second, third]).astype(np.int64), prints

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuseFilter:
        """Peel cells that one key touches, round by round, and assign in reverse."""
        keys = np.unique(keys.astype(np.uint64))
        n = max(2, len(keys))
        segment = 1 << min(18, max(2, int(math.log(n) / math.log(3.33) + 2.25)))
        factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
        for attempt in range(200):
            room = int(n * factor * (1.0 + 0.05 * attempt))
            segments = max(1, -(-room // segment) - 2)
            seed = (0x9E3779B97F4A7C15 * (attempt + 1)) & (2**64 - 1)
            places, prints = cls._places(keys, seed, segment, segments)
            size = (segments + 2) * segment
            counts = np.bincount(places.ravel(), minlength=size)
            sums = np.bincount(
                places.ravel(), weights=np.tile(np.arange(len(keys), dtype=np.float64), 3), minlength=size
            ).astype(np.int64)
            rounds, left = [], len(keys)
            while left:
                single = np.flatnonzero(counts == 1)
                if not len(single):
                    break
                owners, at = np.unique(sums[single], return_index=True)
                rounds.append((owners, single[at]))
                gone = places[:, owners]
                np.subtract.at(counts, gone.ravel(), 1)
                np.subtract.at(sums, gone.ravel(), np.tile(owners, 3))
                left -= len(owners)
            if left:
                continue
            cells = np.zeros(size, np.uint8)
            for owners, at in reversed(rounds):
                around = cells[places[:, owners]]
                cells[at] = 0
                value = prints[owners] ^ around[0] ^ around[1] ^ around[2]
                cells[at] = value
            return cls(seed, segment, segments, cells)
        raise RuntimeError("no binary-fuse filter found")

    def has(self, keys: np.ndarray) -> np.ndarray:
        places, prints = self._places(keys.astype(np.uint64), self.seed, self.segment, self.segments)
        found = self.cells[places]
        return (found[0] ^ found[1] ^ found[2]) == prints

    def pack(self) -> bytes:
        head = np.array([self.seed, self.segment, self.segments], np.uint64)
        return head.tobytes() + self.cells.tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> BinaryFuseFilter:
        seed, segment, segments = (int(x) for x in np.frombuffer(data, np.uint64, 3))
        return cls(seed, segment, segments, np.frombuffer(data, np.uint8, offset=24))


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, f"{SPACE}+", " ")


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, SHA-256 of the normalised text, its length in bytes, and the salted cell."""
    rows = texts(documents).select("doc_id", normalised(F.col("text")).alias("text"))
    return rows.select(
        "doc_id",
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        F.octet_length("text").cast("long").alias("length"),
        cell().alias("cell"),
    )


def cells(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest", "length", "cell").agg(
        F.min(F.coalesce("doc_id", F.lit(LAST))).alias("least"), F.count(F.lit(1)).alias("n")
    )


def classes(grouped: DataFrame) -> DataFrame:
    """One row per distinct text: its smallest id and number of rows."""
    return grouped.groupBy("digest", "length").agg(F.min("least").alias("least"), F.sum("n").alias("n"))


def _key(prefix: Column) -> Column:
    return F.conv(F.hex(prefix), 16, -10).cast("long")


def bucketed(distinct: DataFrame, buckets: int) -> DataFrame:
    """Adds the 64-bit key the filters hold and the bucket."""
    return distinct.withColumn("key", _key(F.substring("digest", 1, 8))).withColumn(
        "bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")
    )


def build_filters(snapshot: DataFrame) -> DataFrame:
    """bucket, filter: one filter per bucket of a snapshot with the columns of `bucketed`."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        packed = BinaryFuseFilter.build(group["key"].to_numpy().view(np.uint64)).pack()
        return pd.DataFrame({"bucket": group["bucket"].iloc[:1], "filter": [packed]})

    return snapshot.select("bucket", "key").groupBy("bucket").applyInPandas(build, "bucket int, filter binary")


def screen(batch: DataFrame, filters: DataFrame) -> DataFrame:
    """The batch with a column `seen`: false where the snapshot surely lacks the digest."""

    def test(rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        keys = rows["key"].to_numpy().view(np.uint64)
        seen = BinaryFuseFilter.unpack(held["filter"].iloc[0]).has(keys) if len(held) else np.zeros(len(keys), bool)
        return rows.assign(seen=seen)

    schema = "digest binary, length long, least long, n long, key long, bucket int, seen boolean"
    columns = ["digest", "length", "least", "n", "key", "bucket"]
    return batch.select(*columns).groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(test, schema)


def exact_duplicates(snapshot_rows: DataFrame, batch_rows: DataFrame, buckets: int) -> DataFrame:
    """digest, length, least, n over both sides; `snapshot_rows` and `batch_rows` come from `cells`."""
    snapshot = stored(bucketed(classes(snapshot_rows), buckets), "snapshot")
    filters = stored(build_filters(snapshot), "filters")
    batch = stored(screen(bucketed(classes(batch_rows), buckets), filters), "screened")
    old = snapshot.select(
        "bucket", "key", F.col("digest").alias("old_digest"), F.col("length").alias("old_length"),
        F.col("least").alias("old_least"), F.col("n").alias("old_n"),
    )
    same = (F.col("digest") == F.col("old_digest")) & (F.col("length") == F.col("old_length"))
    found = stored(batch.filter("seen").join(old, ["bucket", "key"]).filter(same), "positives")
    new = batch.join(found.select("digest", "length"), ["digest", "length"], "left_anti")
    grown = found.select("digest", "length", F.col("least").alias("new_least"), F.col("n").alias("new_n"))
    known = snapshot.join(grown, ["digest", "length"], "left").select(
        "digest", "length",
        F.least("least", F.coalesce("new_least", "least")).alias("least"),
        (F.col("n") + F.coalesce("new_n", F.lit(0))).alias("n"),
    )
    return known.unionByName(new.select("digest", "length", "least", "n"))


def deduplicated(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The lower half of the ids is the snapshot, the upper half the new batch.
    """
    rows = stored(digests(documents), "digests")
    middle = rows.approxQuantile("doc_id", [0.5], 0.01) or [0.0]
    lower = F.coalesce(F.col("doc_id") <= F.lit(int(middle[0])), F.lit(False))
    grouped = stored(cells(rows.filter(lower)).withColumn("old", F.lit(True)).unionByName(
        cells(rows.filter(~lower)).withColumn("old", F.lit(False))), "cells")
    buckets = max(LEAST_BUCKETS, -(-grouped.count() // BUCKET_KEYS))
    found = exact_duplicates(grouped.filter("old"), grouped.filter(~F.col("old")), buckets)
    settled = (
        grouped.select("digest", "length", "cell").distinct()
        .join(found, ["digest", "length"])
        .withColumnRenamed("n", "group_size")
    )
    # Rows with one text and one id share a cell; they become one row with a count.
    counted = rows.groupBy("digest", "length", "cell", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    return (
        counted.join(settled, ["digest", "length", "cell"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(
            "doc_id",
            F.when(F.col("least") < LAST, F.col("least")).alias("keep_id"),
            "group_size",
            ((F.col("copy") == 1) & (F.coalesce("doc_id", F.lit(LAST)) == F.col("least"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def without_duplicates(documents: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    stay = deduplicated(documents).filter("kept").select(
        F.coalesce("doc_id", F.lit(LAST)).alias("id"), F.col("text_sha256").alias("sha")
    )
    # The row travels whole in a column of its own, so none of its names can clash.
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = documents.select(
        F.struct(*[F.col(quoted(c)) for c in documents.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"),
        F.sha2(normalised(text).cast("binary"), 256).alias("sha"),
    )
    # The window needs no shuffle of its own: the join has dealt and sorted the rows by its keys.
    first = F.row_number().over(Window.partitionBy("id", "sha").orderBy("id"))
    joined = keyed.join(stay.distinct(), ["id", "sha"]).withColumn("first", first)
    return joined.filter("first = 1").select("row.*")


SQL = r"""
with d as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, min(doc_id) over (partition by text_sha256) as keep_id,
  count(*) over (partition by text_sha256) as group_size,
  row_number() over (partition by text_sha256 order by doc_id) = 1 as kept, text_sha256
from d"""
