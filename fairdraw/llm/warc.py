"""Pages in WARC files, read back as a table of chunks.

A record holds a page's address and its payload as an HTTP response, or, where
an earlier page has the same payload, only its digest and a reference (revisit
record, identical-payload-digest profile). Each record is a gzip member of its
own, so reading can start at any record; the manifest, a table, has an entry
point every ``UNIT`` bytes. Payloads pass in pieces of ``CHUNK`` bytes on both
ways, with a running digest; a record becomes one row per chunk when read, and
no task holds more of an archive than a chunk, whatever the size of a record.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairdraw.llm.storage import attempt_name, filesystem, new_folder, published, written

CHUNK, UNIT = 256 << 10, 8 << 20
#: Smaller payloads are stored again: a reference would save nothing.
LEAST_BYTES = 100
#: Pages carry no date of their own.
DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_NAME = "urn:page:"
# What would end or blur a header line.
_ESCAPED = {c: f"%{c:02X}" for c in (*range(33), 127)}

MANIFEST = "file string, place long, records long"
CHUNKS = (
    "file string, place long, record_no int, chunk_no int, page_id long, url string, record_type string,"
    " refers_to long, payload_bytes long, payload_digest string, data binary, data_bytes long, digest string"
)


def _fields(page: dict, size: int) -> list[tuple[str, str]]:
    revisit = page["refers_to"] is not None
    out = [("WARC-Type", "revisit" if revisit else "response")]
    out.append(("WARC-Record-ID", f"<{_NAME}{'' if page['page_id'] is None else page['page_id']}>"))
    out.append(("WARC-Date", DATE))
    if page["url"] is not None:
        out.append(("WARC-Target-URI", page["url"].translate(_ESCAPED)))
    out.append(("WARC-Payload-Digest", f"sha256:{page['digest']}"))
    out.append(("WARC-Payload-Length", str(page["payload_bytes"])))
    if revisit:
        out += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{_NAME}{page['refers_to']}>")]
    return [*out, ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(size))]


def _write_record(stream, page: dict, payload: pa.Buffer) -> int:
    """Append a record as one gzip member; its size."""
    revisit = page["refers_to"] is not None
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in _fields(page, 0 if revisit else len(_HTTP) + payload.size))
    packer, size = zlib.compressobj(6, zlib.DEFLATED, 31), 0
    pieces = [head.encode() + b"\r\n"]
    if not revisit:
        pieces.append(_HTTP)
    for piece in pieces:
        size += stream.write(packer.compress(piece))
    if not revisit:
        digest = hashlib.sha256()
        for low in range(0, payload.size, CHUNK):
            piece = payload.slice(low, min(CHUNK, payload.size - low)).to_pybytes()
            digest.update(piece)
            size += stream.write(packer.compress(piece))
        if digest.hexdigest() != page["digest"]:
            raise ValueError("a payload changed while it was written")
    return size + stream.write(packer.compress(b"\r\n\r\n") + packer.flush())


def revisits(pages: DataFrame) -> DataFrame:
    """``page_id, digest, refers_to`` of the pages whose payload an earlier page
    has. Payloads stay where they are; their digests are grouped."""
    narrow = pages.where(f"payload_bytes >= {LEAST_BYTES}").select("page_id", "digest")
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    several = first.where("n > 1 and refers_to is not null").drop("n")
    return narrow.join(several, "digest").where("not (page_id <=> refers_to)").select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``page_id, url, payload, payload_bytes, digest, refers_to`` as
    archives, one per task, and return the manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = attempt_name(f"pages-{TaskContext.get().partitionId():06d}", "warc.gz")
        batches = (b for b in batches if b.num_rows)
        batch = next(batches, None)
        if batch is None:
            return
        places, counts, at = [0], [0], 0
        with published(folder, name) as stream:
            while batch is not None:
                payloads = batch.column("payload")
                for page, payload in zip(batch.drop_columns(["payload"]).to_pylist(), payloads, strict=True):
                    if at - places[-1] >= UNIT:
                        places.append(at)
                        counts.append(0)
                    at += _write_record(stream, page, payload.as_buffer())
                    counts[-1] += 1
                batch = next(batches, None)
        yield pa.RecordBatch.from_pydict(
            {"file": [name] * len(places), "place": places, "records": counts},
            schema=pa.schema([("file", pa.string()), ("place", pa.int64()), ("records", pa.int64())]),
        )

    return pages.select("page_id", "url", "payload", "payload_bytes", "digest", "refers_to").mapInArrow(run, MANIFEST)


def _head(reader: io.BufferedReader) -> dict[str, str]:
    line = reader.readline()
    if line != b"WARC/1.1\r\n":
        raise ValueError("not a record")
    fields = {}
    while (line := reader.readline()) != b"\r\n":
        key, _, value = line.decode().partition(":")
        fields[key.lower()] = value.strip()
    return fields


def _number(name: str) -> int | None:
    digits = name.strip("<>").removeprefix(_NAME)
    return int(digits) if digits else None


def _read_record(reader: io.BufferedReader) -> Iterator[dict]:
    """The chunks of the record that starts here."""
    fields = _head(reader)
    left = int(fields["content-length"])
    record = {
        "page_id": _number(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "refers_to": _number(fields["warc-refers-to"]) if "warc-refers-to" in fields else None,
        "payload_bytes": int(fields["warc-payload-length"]),
        "payload_digest": fields["warc-payload-digest"].removeprefix("sha256:"),
    }
    if left:
        while True:
            line = reader.readline()
            left -= len(line)
            if line == b"\r\n":
                break
    digest, number = hashlib.sha256(), 0
    while left or not number:
        data = reader.read(min(CHUNK, left))
        if left and not data:
            raise ValueError("a record ends early")
        left -= len(data)
        digest.update(data)
        yield record | {"chunk_no": number, "data": data, "data_bytes": len(data), "digest": digest.hexdigest()}
        number += 1
    if reader.read(4) != b"\r\n\r\n":
        raise ValueError("a record goes on beyond its length")


def read_archives(manifest: DataFrame, folder: str, partitions: int, data: bool = True) -> DataFrame:
    """All records as chunks: ``file, place, record_no, chunk_no`` tell a chunk
    apart; ``digest`` is that of the payload up to and with the chunk. Without
    ``data`` the bytes are left out."""
    schema = pa.schema(
        [("file", pa.string()), ("place", pa.int64()), ("record_no", pa.int32()), ("chunk_no", pa.int32())]
        + [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("data", pa.binary())]
        + [("data_bytes", pa.int64()), ("digest", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in (u for batch in batches for u in batch.to_pylist()):
            where, path = filesystem(f"{folder}/{unit['file']}")
            out, size = [], 0
            with where.open_input_file(path) as stream:
                stream.seek(unit["place"])
                reader = io.BufferedReader(gzip.GzipFile(fileobj=stream), CHUNK)
                for number in range(unit["records"]):
                    for chunk in _read_record(reader):
                        out.append(chunk | {"file": unit["file"], "place": unit["place"], "record_no": number})
                        size += 200 + (chunk["data_bytes"] if data else 0)
                        if not data:
                            out[-1]["data"] = None
                        if size >= 4 * CHUNK:
                            yield pa.RecordBatch.from_pylist(out, schema=schema)
                            out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return manifest.repartition(partitions, "file", "place").mapInArrow(run, CHUNKS)


def records(chunks: DataFrame) -> DataFrame:
    """The records of a table of chunks, their payloads checked by length and digest."""
    damaged = "raise_error(concat('damaged payload of page ', coalesce(cast(page_id as string), 'null')))"
    whole = "record_type = 'revisit' or (payload_bytes = n and payload_digest = digest)"
    found = chunks.groupBy("file", "place", "record_no").agg(
        *[F.first(c).alias(c) for c in ("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest")],
        F.sum("data_bytes").alias("n"),
        F.max_by("digest", "chunk_no").alias("digest"),
    )
    return found.withColumn("payload_digest", F.expr(f"if({whole}, payload_digest, {damaged})")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write a record per row of ``pages`` and read the archives back: ``page_id,
    payload_bytes, payload_digest, record_type, refers_to``.

    A null payload is an empty one. Of records with equal payloads of at least
    ``LEAST_BYTES`` the one with the smallest ``page_id`` is the response; rows
    that repeat that id with that payload are responses too. Rows without id
    revisit it, or are responses if no row of their payload has an id. A null
    ``url`` is left out; blanks and control characters in one are escaped. An empty table gives no archive and no row. Only
    ``page_id``, ``url`` and ``html`` are read.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    pages = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.expr("cast(coalesce(cast(html as string), '') as binary)").alias("payload"),
    ).withColumns({"payload_bytes": F.expr("cast(octet_length(payload) as long)"), "digest": F.expr("sha2(payload, 256)")})
    again = written(revisits(pages), folder, "revisits")
    renamed = again.selectExpr("page_id as __page", "digest as __digest", "refers_to")
    # By the size of what was written, few references are broadcast and whole
    # pages stay where they are; many are joined by a shuffle on both keys.
    joined = pages.join(renamed, F.expr("page_id <=> __page and digest = __digest"), "left")
    manifest = written(write_archives(joined, f"{folder}/archives"), folder, "manifest", rows=128)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), manifest.rdd.getNumPartitions())
    return records(read_archives(manifest, f"{folder}/archives", partitions, data=False))
