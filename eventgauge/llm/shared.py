"""What the operators share: reading, stored intermediate tables, batches, folds."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step of a Python worker handles at once (a longer text alone).
STEP_BYTES = 2 << 20
#: The white space that separates words everywhere here.
SPACE = r"[\x20\x09-\x0D]"
SPACE_BYTES = np.zeros(256, bool)
SPACE_BYTES[[0x20, *range(0x09, 0x0E)]] = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines share: spark.checkpoint.dir, or a temporary one where it is unset.

    A temporary folder is one machine's own, so it serves a local session only.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isEmpty():
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
            held = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = held.get()
    return folder.rstrip("/")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame into the shared folder and read it back.

    This cuts the lineage: a lost executor costs a read of the table, not the work above it.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def quoted(name: str) -> str:
    """A column name as a reference, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def texts(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id and the whole text, null as empty; all other columns are left unread."""
    return documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )


def fold(identifier: Column | str) -> Column:
    """crc32 of the id as text, modulo five; a null id counts as empty text."""
    column = F.col(identifier) if isinstance(identifier, str) else identifier
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % 5


def steps(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = STEP_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about `limit` bytes of one string column."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column without nulls, and the n + 1 places where its values begin."""
    array = column.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def ragged(values: np.ndarray, starts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen pieces of an array one after another, and the n + 1 places where they begin.

    Piece k lies from starts[k] to starts[k + 1].
    """
    sizes = np.diff(starts)[chosen]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    shift = np.repeat(starts[chosen] - ends[:-1], sizes)
    return values[np.arange(ends[-1]) + shift], ends


def mixed(keys: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix of unsigned integers (the finalizer of MurmurHash3)."""
    keys = keys ^ (keys >> np.uint64(33))
    keys = keys * np.uint64(0xFF51AFD7ED558CCD)
    keys = keys ^ (keys >> np.uint64(33))
    keys = keys * np.uint64(0xC4CEB9FE1A85EC53)
    return keys ^ (keys >> np.uint64(33))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, per_class: int, keep: Column | None = None
) -> DataFrame:
    """The documents of at most `per_class` labelled rows of each class, with the label.

    The rows are those with the smallest hashes of their ids, so the choice does not depend on
    order or partitioning.  At most two times `per_class` ids are broadcast; null labels and
    null ids do not count, and of repeated labels of one id the smallest is used.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"))
    known = known if keep is None else known.filter(keep)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.filter(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    return texts(documents).join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")


#: Rows with a null id come after all others.
LAST = (1 << 63) - 1
#: Salted cells a key's rows are dealt to.
CELLS = 1024


def cell(identifier: str = "doc_id") -> Column:
    return F.pmod(F.xxhash64(F.coalesce(identifier, F.lit(LAST))), F.lit(CELLS)).cast("int")


def told(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Rows (with a column `cell`) joined to the facts of their key, which are unique by key.

    A key that a third of the rows share is dealt by its cells: first each (key, cell) gets the
    facts, then each row those of its (key, cell).
    """
    cells = rows.select(key, "cell").distinct().join(facts, key)
    return rows.join(cells, [key, "cell"])


#: Keys that may be broadcast: each holds more than one row in so many.
HOT_KEYS = 4096


def matched(rows: DataFrame, facts: DataFrame, key: str, size: str) -> DataFrame:
    """Rows joined to the stored facts of their key, one a key; `size` is a key's number of rows.

    A key with more than one row in HOT_KEYS of all stays where its rows are: fewer than HOT_KEYS
    keys are so and these are broadcast.  The others are shuffled by key, so no task gets more
    than that share of the rows from one key.
    """
    bound = (facts.agg(F.sum(size)).first()[0] or 0) // HOT_KEYS
    hot = F.broadcast(facts.filter(F.col(size) > bound))
    rest = rows.join(hot.select(key), key, "left_anti").join(facts.filter(F.col(size) <= bound), key)
    return rows.join(hot, key).unionByName(rest)
