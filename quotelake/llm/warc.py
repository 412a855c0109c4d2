"""WARC archives: one gzip member per record, written once per payload and read in sequence."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm.arrow import sliced
from quotelake.llm.scratch import materialised, open_store
from quotelake.session import scratch_path

CHUNK = 1 << 16
DATE = "2000-01-01T00:00:00Z"  # the pages carry no time of capture
_ID = re.compile(r"<urn:page:(-?\d+)>")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, n: int) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page-{n}')}>"


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, number: int = 0) -> bytes:
    """One record as a gzip member: a response with its payload, or a revisit of another page's."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _record_id(page_id, number),
        "WARC-Date": DATE,
        "WARC-Target-URI": " ".join((url or "").split()),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
        "X-Payload-Length": str(len(payload)),
    }
    if refers_to is not None:
        fields["WARC-Refers-To"] = _record_id(refers_to, 0)
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + squeeze.flush()


class Corrupt(ValueError):
    """An archive that is cut off, or a record that does not match its length or digest."""


def _members(read) -> Iterator[Iterator[bytes]]:
    """The members of an archive, each as an iterator over its inflated bytes."""
    waiting = read(CHUNK)
    while waiting:
        inflate = zlib.decompressobj(31)

        def pieces():
            nonlocal waiting
            while not inflate.eof:
                if not waiting and not (waiting := read(CHUNK)):
                    raise Corrupt("the archive ends inside a record")
                try:
                    out = inflate.decompress(waiting, CHUNK)
                except zlib.error as e:
                    raise Corrupt(str(e)) from e
                waiting = inflate.unconsumed_tail or inflate.unused_data
                if out:
                    yield out
            waiting = waiting or read(CHUNK)

        yield pieces()


def records(read) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record; ``read(n)`` gives the next bytes.  One record is held at a time."""
    for pieces in _members(read):
        data = bytearray()
        fields: dict[str, str] | None = None
        need = 0
        for piece in pieces:
            data += piece
            if fields is None and (end := data.find(b"\r\n\r\n")) >= 0:
                version, *lines = bytes(data[:end]).decode().split("\r\n")
                if not version.startswith("WARC/"):
                    raise Corrupt(f"not a WARC record: {version[:20]!r}")
                fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
                need = int(fields["content-length"])
                del data[: end + 4]
        if fields is None or bytes(data[need:]) != b"\r\n\r\n":
            raise Corrupt("a record does not have its content length")
        block = bytes(data[:need])
        if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{digest(block)}":
            raise Corrupt(f"digest of {fields.get('warc-record-id')}")
        yield fields, block


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Write a partition to one archive; it takes its name when it is whole, so a repeated task replaces it."""
    context = TaskContext.get()
    store, base = open_store(folder)
    store.create_dir(base, recursive=True)
    name = f"{base}/part-{context.partitionId():06d}.warc.gz"
    draft = f"{base}/.draft-{context.partitionId():06d}-{context.taskAttemptId()}"
    number = 0
    out = None
    for batch in sliced(batches):
        for page, url, html, refers in zip(*(batch.column(i).to_pylist() for i in range(4))):
            out = out or store.open_output_stream(draft, compression=None)
            out.write(member(page, url, (html or "").encode(), refers, (context.partitionId() << 40) + number))
            number += 1
    if out is not None:
        out.close()
        store.move(draft, name)
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name.rsplit('/', 1)[1]}"]), pa.array([number], pa.int64())], ["path", "records"])


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) and return (path, records) of the archives.

    Of pages with equal payloads of at least ``min_bytes`` the one with the largest page_id is the response
    and the others revisit it.  A null html is an empty payload.  A page without
    id cannot be referred to: such pages are revisits if an equal page has an id, else
    responses.  Repeated rows of the largest id are all responses.  Other columns are ignored.
    """
    key = F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256)
    long = F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes
    groups = pages.filter(long).groupBy(key.alias("_key")).agg(F.max("page_id").alias("_first"), F.count("*").alias("_n"))
    # only payloads that occur again; a table of its own lets Spark size the join
    again = materialised(groups.filter("_n > 1 and _first is not null").select("_key", "_first"), "payloads")
    rows = pages.select("page_id", "url", "html", key.alias("_own"), long.alias("_long"))
    rows = rows.join(again, (F.col("_own") == F.col("_key")) & F.col("_long"), "left")
    refers = F.when(~F.col("_first").eqNullSafe(F.col("page_id")), F.col("_first"))
    done = rows.select("page_id", "url", "html", refers.alias("refers")).mapInArrow(lambda b: _write(b, folder), "path string, records bigint")
    return materialised(done, "archives")


_FIELDS = "record_id string, record_type string, url string, page_id bigint, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    page = lambda text: int(m[1]) if (m := _ID.fullmatch(text or "")) else None
    names = [f.split()[0] for f in _FIELDS.split(", ")]
    types = [pa.string()] * 3 + [pa.int64()] * 2 + [pa.string(), pa.int64(), pa.binary()]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, place = open_store(path)
            rows, size = [], 0
            with store.open_input_stream(place, compression=None) as stream:
                for fields, block in records(stream.read):
                    payload = block.partition(b"\r\n\r\n")[2]
                    own = fields["warc-payload-digest"].removeprefix("sha1:")
                    if fields["warc-type"] == "response" and own != digest(payload):
                        raise Corrupt(f"payload digest of {fields['warc-record-id']} in {path}")
                    n = len(payload) if fields["warc-type"] == "response" else int(fields["x-payload-length"])
                    rows.append((fields["warc-record-id"], fields["warc-type"], fields["warc-target-uri"], page(fields["warc-record-id"]), n, own, page(fields.get("warc-refers-to")), payload if payloads else None))
                    size += len(payload) if payloads else 0
                    if len(rows) == 2000 or size > 1 << 24:
                        yield out(rows)
                        rows, size = [], 0
            if rows:
                yield out(rows)


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives in ``files`` (path), one task per archive, in file order.

    A cut off archive, a wrong length or a wrong digest is an error.
    """
    n = max(1, files.count())
    return files.select("path").repartition(n).mapInArrow(lambda b: _read(b, payloads), _FIELDS)


def archive_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "llm-warc")
