"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

An archive is `skippable frame (dictionary) | frame | frame | ...`; each frame holds one record.
The reader takes the dictionary from the first frame, decodes one frame at a time in bounded
memory, and validates the version line, the needed headers, the content length and, where a
record has a payload, its digest.

Archives are rows (archive, bytes) of a stored table, each the whole of one file: Spark writes
and reads them with its own committers in any store, and a lost task leaves no half-written file
behind.  A row is at most `ARCHIVE_BYTES` of payloads and one more page, so archives are read
where they lie, without moving them.  `read_files` reads files that other tools wrote.

Html moves once: pages and the narrow rows that say which page a repeated payload refers to are
dealt by page together, and the writer meets the fact just before its pages.

Defined results: a null html is the empty payload; equal pages are records of their own; a null
page_id comes before all others when the largest is sought, and of several rows that tie for
the largest one is the response; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventgauge.llm.shared import steps, stored

SKIPPABLE = 0x184D2A5D
VERSION = b"WARC/1.1"
NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-target-uri")
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of html after which the next archive begins.
ARCHIVE_BYTES = 8 << 20
#: Bytes of records decoded before they are handed on.
STEP_BYTES = 1 << 20
#: Bytes of html a writing task is given on average, and the most tasks there are.
TASK_BYTES = 32 << 20
TASKS = 20_000
#: The dictionary is trained on the first so many bytes of an archive's payloads.
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 32 << 10
LEAST = -(1 << 63)
CELLS = 1024


class WarcError(ValueError):
    """A record or an archive that breaks the format."""


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str, payload: bytes, digest: str, size: int, refers: str | None) -> bytes:
    """A response record, or a revisit record (without the payload) when `refers` is given."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if refers is not None else http + payload
    head = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page is None else page}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", " ".join(url.split())),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers is not None:
        head[4:4] = [("WARC-Refers-To", f"<urn:page:{refers}>"), ("WARC-Profile", PROFILE)]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record; raises WarcError if it is not well formed."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] != VERSION:
        raise WarcError(f"no {VERSION.decode()} line or no end of headers: {data[:40]!r}")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise WarcError(f"not a header: {line[:60]!r}")
        headers[name.strip().lower().decode()] = value.strip().decode()
    if missing := [x for x in NEEDED if x not in headers]:
        raise WarcError(f"missing headers: {missing}")
    if not headers["content-length"].isdigit():
        raise WarcError("the content length is not a number")
    length = int(headers["content-length"])
    if rest[length:] != b"\r\n\r\n":
        raise WarcError(f"the block is not {length} bytes and an empty line")
    http, found, payload = rest[:length].partition(b"\r\n\r\n")
    sizes = [x.partition(b":")[2].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if not found or len(sizes) != 1 or not sizes[0].isdigit():
        raise WarcError("no HTTP headers with one content length")
    size = int(sizes[0])
    kind, digest = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise WarcError("the payload differs from its length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in headers):
        raise WarcError("a revisit record has a payload or refers to nothing")
    if kind not in ("response", "revisit"):
        raise WarcError(f"unknown record type {kind}")
    page = headers["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")
    refers = headers.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">")
    return {
        "page_id": int(page) if page else None, "url": headers["warc-target-uri"], "payload": payload,
        "payload_bytes": size, "payload_digest": digest, "record_type": kind,
        "refers_to": int(refers) if refers else None,
    }


def trained(samples: list[bytes]) -> bytes:
    """A dictionary, or none where there is too little to train on."""
    if len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def leading_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary


def frames(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The decoded records of one archive whose bytes come in chunks of any size."""
    held = b""
    for chunk in chunks:
        held += chunk
        if len(held) >= 8:
            break
    if not held:
        return
    if len(held) < 8:
        raise WarcError("the archive ends inside its first frame")
    magic, size = struct.unpack_from("<II", held)
    if magic != SKIPPABLE:
        raise WarcError("the archive does not begin with a dictionary frame")
    while len(held) < 8 + size:
        chunk = next(chunks, None)
        if chunk is None:
            raise WarcError("the archive ends inside its dictionary")
        held += chunk
    dictionary, held = held[8 : 8 + size], held[8 + size :]
    if dictionary[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary frame may itself be compressed
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    reader = zstandard.ZstdDecompressor(
        dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    )
    frame, decoded = reader.decompressobj(), []
    while True:
        if held:
            decoded.append(frame.decompress(held))
            held = b""
            if frame.eof:
                yield b"".join(decoded)
                held, frame, decoded = frame.unused_data, reader.decompressobj(), []
                fresh = not held
            else:
                fresh = False
            continue
        chunk = next(chunks, None)
        if chunk is None:
            if decoded and not fresh:
                raise WarcError("the archive ends inside a frame")
            return
        held = chunk


def numbered(pages: DataFrame) -> DataFrame:
    """page_id, url, html (null: empty) and the SHA-1 of the html."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        html.alias("html"),
        F.unhex(F.sha1(html.cast("binary"))).alias("sha"),
        F.octet_length(html).cast("long").alias("size"),
    )


def responses(rows: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, refers: for each page that repeats a payload, the page it refers to.

    Payloads are counted in salted cells first, so one that a third of the pages share is
    spread; only digests move.
    """
    narrow = rows.select(
        F.coalesce("page_id", F.lit(LEAST)).alias("page"), "sha", "size",
        F.pmod(F.xxhash64("page_id"), F.lit(CELLS)).cast("int").alias("cell"),
    ).filter(F.col("size") >= least_bytes)
    cells = narrow.groupBy("sha", "size", "cell").agg(F.max("page").alias("page"), F.count(F.lit(1)).alias("n"))
    largest = cells.groupBy("sha", "size").agg(F.max("page").alias("refers"), F.sum("n").alias("n")).filter("n > 1")
    each = cells.select("sha", "size", "cell").join(largest, ["sha", "size"]).select("sha", "size", "cell", "refers")
    return narrow.join(each, ["sha", "size", "cell"]).select("page", "sha", "refers").distinct()


def archives(pages: DataFrame, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """archive, bytes of the written archives."""
    rows = numbered(pages)
    total = rows.agg(F.sum("size")).first()[0] or 0
    page, none = F.coalesce("page_id", F.lit(LEAST)), F.lit(None)
    html = rows.select(
        page.alias("page"), "sha", F.lit(1).alias("place"), "page_id", "url", "html", none.cast("long").alias("refers")
    )
    facts = responses(rows, least_bytes).select(
        "page", "sha", F.lit(0).alias("place"), none.cast("long").alias("page_id"), none.cast("string").alias("url"),
        none.cast("string").alias("html"), "refers",
    )
    tasks = int(min(TASKS, max(12, -(-total // TASK_BYTES))))
    order = ["page", "sha", "place", "url"]
    dealt = html.unionByName(facts).repartition(tasks, "page").sortWithinPartitions(*order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        buffer, waiting, size, writer = bytearray(), [], 0, None
        known, refers = None, None

        def begin() -> None:
            nonlocal writer, waiting
            dictionary = trained([x[2] for x in waiting])
            data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
            writer = zstandard.ZstdCompressor(level=3, dict_data=data, write_content_size=True)
            buffer.extend(leading_frame(dictionary))
            for x in waiting:
                put(*x)
            waiting = []

        def put(page: int | None, url: str, payload: bytes, refers: int | None) -> None:
            shown = None if refers is None else "" if refers == LEAST else str(refers)
            buffer.extend(writer.compress(record(page, url, payload, base32_sha1(payload), len(payload), shown)))

        def closed() -> pa.RecordBatch:
            nonlocal number, writer, size
            if writer is None:
                begin()
            out = pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([bytes(buffer)], pa.binary())], ["archive", "bytes"]
            )
            number, writer, size = number + 1, None, 0
            buffer.clear()
            return out

        names = ("page", "sha", "place", "page_id", "url", "html", "refers")
        for batch in steps(batches, "html"):
            for key, sha, place, page, url, html, target in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if place == 0:
                    known, refers = (key, sha), target
                    continue
                payload, other = html.encode(), None
                if (key, sha) == known:
                    # Of rows that tie for the page referred to, the first is the response.
                    other, known = (refers, known) if refers != key else (None, (key, sha, "told"))
                elif known == (key, sha, "told"):
                    other = refers
                size += len(payload)
                if writer is None:
                    waiting.append((page, url, payload, other))
                    if size >= SAMPLE_BYTES:
                        begin()
                else:
                    put(page, url, payload, other)
                if size >= archive_bytes:
                    yield closed()
        if waiting or buffer:
            yield closed()

    return dealt.mapInArrow(work, "archive long, bytes binary")


RECORDS = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string,"
    " refers_to long"
)


def read(written: DataFrame, payloads: bool = True) -> DataFrame:
    """The validated records of whole archives given as `bytes`, in any rows.

    Each archive is decoded where it is read, frame by frame.
    """
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                held = memoryview(batch.column("bytes")[k].as_buffer())
                chunks = (bytes(held[i : i + STEP_BYTES]) for i in range(0, len(held), STEP_BYTES))
                made, size = [], 0
                for data in frames(chunks):
                    found = parse(data)
                    size += len(data)
                    if not payloads:
                        found["payload"] = None
                    made.append(tuple(found[x] for x in names))
                    if size > STEP_BYTES:
                        yield _batch(made, kinds, names)
                        made, size = [], 0
                if made:
                    yield _batch(made, kinds, names)

    return written.select(F.coalesce("bytes", F.lit(b"")).alias("bytes")).mapInArrow(work, RECORDS)


def read_files(spark: SparkSession, paths: str | list[str], payloads: bool = True) -> DataFrame:
    """The validated records of `.warc.zst` files in any store Spark reads; folders and globs too."""
    found = spark.read.format("binaryFile").load(paths)
    return read(found.select(F.col("content").alias("bytes")), payloads)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def write_and_read(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, read from stored archives."""
    written = stored(archives(pages, least_bytes), "archives")
    return read(written, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
