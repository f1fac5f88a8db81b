"""Web archives with one Zstandard frame per record and a dictionary trained on the archive's own records."""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorgraph.llm.rows import small_batches
from sensorgraph.operators.storage import stored

#: Bytes of records per archive before compression; a task holds one archive at a time.
ARCHIVE_BYTES = 16 << 20
#: The dictionary is fitted on evenly spaced records of its archive, up to this many bytes of each and in all.
DICTIONARY_BYTES, SAMPLE_BYTES, SAMPLE_RECORD_BYTES = 64 << 10, 2 << 20, 32 << 10
#: Fixed values of the formats: skippable frame that holds a dictionary, plain Zstandard frame, revisit profile.
DICTIONARY_FRAME, ZSTD_FRAME = 0x184D2A5D, 0xFD2FB528
REVISIT = "http://netpreservation.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("5b0cbb0c-5a4b-4b86-9d2a-2f6d1a0f7c11")


def payload_of(column: Column) -> Column:
    return F.encode(F.coalesce(column, F.lit("")), "UTF-8")


def deduplicated(pages: DataFrame, id_col: str, payload_col: str, url_col: str, least: int) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: the page whose equal payload is kept, null for a response.

    Only ids and digests are grouped. The revisits are written and joined by id, so a payload with very many copies does
    not meet in one task and its pages are moved only if the revisits are too large to broadcast.
    """
    payload = payload_of(F.col(payload_col))
    url = F.coalesce(F.col(url_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    short = rows.where(F.octet_length("payload") >= least).select("page_id", "digest")
    first = short.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where(F.col("n") > 1)
    again = short.join(stored(first.drop("n"), "first-pages"), "digest").where(F.col("page_id") != F.col("refers_to"))
    return rows.join(stored(again.distinct(), "revisits"), ["page_id", "digest"], "left")


def _record_id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, str(page))}>"


def _record(page: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _record_id(page),
        "WARC-Date": date,
        "WARC-Target-URI": re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if page is not None:
        fields["X-Page-Id"] = str(page)
    block = http + payload
    if refers_to is not None:
        block = http
        fields |= {"WARC-Profile": REVISIT, "WARC-Refers-To": _record_id(refers_to), "X-Refers-To-Page-Id": str(refers_to)}
    fields["Content-Length"] = str(len(block))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _compressed(records: list[bytes], level: int) -> bytes:
    """An archive: the dictionary in a leading skippable frame, if there is enough to train one, then a frame a record."""
    import zstandard

    size = sum(min(len(r), SAMPLE_RECORD_BYTES) for r in records)
    sample = [r[:SAMPLE_RECORD_BYTES] for r in records[:: max(1, -(-size // SAMPLE_BYTES))]]
    dictionary, parts = None, []
    if len(sample) >= 16:
        try:
            dictionary = zstandard.train_dictionary(min(DICTIONARY_BYTES, size // 8), sample, k=256, d=8)
            dictionary.precompute_compress(level=level)
        except zstandard.ZstdError:  # too little or too uniform text for a dictionary
            dictionary = None
    if dictionary is not None:
        packed = zstandard.ZstdCompressor(level=level).compress(dictionary.as_bytes())
        parts.append(struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed)
    writer = zstandard.ZstdCompressor(level=level, dict_data=dictionary)
    parts += [writer.compress(r) for r in records]
    return b"".join(parts)


def _files(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    payload_col: str = "html",
    url_col: str = "url",
    least_revisit_bytes: int = 100,
    archive_bytes: int = ARCHIVE_BYTES,
    level: int = 6,
    date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Writes a record per row into ``*.warc.zst`` files below ``folder``; returns their manifest (``archive, records``).

    ``folder`` is a place that all executors reach (a path or URI known to Arrow's file systems). Of equal payloads of
    at least ``least_revisit_bytes`` the smallest id is a response and the others are revisits of it; shorter payloads
    are responses. Null payload is empty, null url is ""; a row without id is always a response; rows that repeat an id
    and payload are all responses if the id is the smallest; an empty table gives an empty manifest. File names carry
    the task attempt and only the manifest tells which count, so a repeated task leaves no double records.
    """
    small_batches(pages.sparkSession)
    rows = deduplicated(pages, id_col, payload_col, url_col, least_revisit_bytes)
    rows = rows.select("page_id", "url", "payload", "digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, place = _files(folder)
        system.create_dir(place, recursive=True)
        records, size, number = [], 0, 0

        def close() -> pa.RecordBatch:
            nonlocal records, size, number
            name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{number:05d}.warc.zst"
            with system.open_output_stream(f"{place}/{name}", compression=None) as out:
                out.write(_compressed(records, level))
            out = pa.record_batch([[f"{folder}/{name}"], pa.array([len(records)], pa.int64())], ["archive", "records"])
            records, size, number = [], 0, number + 1
            return out

        for batch in batches:
            for page, url, payload, digest, refers_to in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                records.append(_record(page, url, payload, digest, refers_to, date))
                size += len(records[-1])
                if size >= archive_bytes:
                    yield close()
        if records:
            yield close()

    return stored(rows.mapInArrow(run, "archive string, records long"), "archives")


def _frames(raw: bytes) -> Iterator[bytes]:
    """Records of an archive, each frame decompressed by itself."""
    import zstandard

    reader, at = zstandard.ZstdDecompressor(), 0
    while at < len(raw):
        magic, size = struct.unpack_from("<II", raw, at)
        if magic == DICTIONARY_FRAME and at == 0:
            content = raw[8 : 8 + size]
            if struct.unpack_from("<I", content)[0] == ZSTD_FRAME:
                content = zstandard.ZstdDecompressor().decompress(content)
            reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            at += 8 + size
            continue
        frame, record, step = reader.decompressobj(), [], 4096
        while not frame.eof:
            part = raw[at : at + step]
            if not part:
                raise ValueError("an archive ends within a record")
            record.append(frame.decompress(part))
            at += len(part) - len(frame.unused_data)
            step = min(4 * step, 1 << 20)
        yield b"".join(record)


def _parsed(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    page, refers = (int(fields[k]) if k in fields else None for k in ("X-Page-Id", "X-Refers-To-Page-Id"))
    return page, fields["WARC-Target-URI"], kind, size, digest, refers, payload if kind == "response" else None


def read_archives(manifest: DataFrame) -> DataFrame:
    """A row per record: ``page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload``.

    Payloads of responses are checked against their digest; a revisit has none, its length and digest are those of the
    full payload. A task reads one archive at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = _files(path)
                with system.open_input_file(place) as file:
                    raw = file.read()
                rows: list[tuple] = []
                for record in _frames(raw):
                    rows.append(_parsed(record))
                    if len(rows) == 1000:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows = []
                if rows:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    kinds = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
    # Archives are dealt out one by one: a scan of the manifest alone would give them all to few tasks.
    return manifest.select("archive").repartition(F.col("archive")).mapInArrow(run, kinds)
