"""WARC archives: writing, normalising whole-file gzip streams, and reading by offset.

``write_archives`` turns pages into archives that are one gzip stream each, the way a plain ``gzip``
of a WARC file makes them: nothing in them can be read without inflating all before it. ``normalise``
inflates each such stream once, front to back, and writes every record as a gzip member of its own,
with a sidecar index of offsets beside the archive and as a table. ``read_records`` fetches single
members by that index.

Equal payloads of at least ``min_revisit`` bytes are kept once: the record with the largest page id
holds the payload, the others are revisits that refer to it. Only digests are compared, and only the
largest id of each digest that occurs twice is joined back.

A task streams: it holds a batch of pages or a chunk of an archive, whatever the archive's length.
Archive names carry the task attempt, and only attempts that Spark commits are in the tables of
archives and of offsets, so a task that is lost and run again leaves no double.

Defined cases: a null payload is empty; a null address or id leaves its header out; rows that share
the largest id of a digest are all responses; a group without any id is all responses; repeated rows
give a record each; an empty table gives no archive and an empty result. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import for_python, written

# --- fixed values: the format -----------------------------------------------------------------------
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = 16 + zlib.MAX_WBITS
BREAK = b"\r\n"

# --- parameters -------------------------------------------------------------------------------------
MIN_REVISIT = 1000
ARCHIVE_BYTES = 256 << 20   # of records, before compression
CHUNK = 1 << 20
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"  # of every record, so that reruns write the same
PAGE_URN = "urn:page:"

ARCHIVES = "path string, records long"
INDEX = "path string, offset long, length long, record_id string, record_type string"


def with_record_types(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Add payload, its size and digest, the record type and the page that a revisit refers to."""
    df = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary")
                      .alias("payload"))
    df = df.withColumns({"payload_bytes": F.octet_length("payload").cast("long"),
                         "payload_digest": F.sha1("payload")})
    repeated = df.where(F.col("payload_bytes") >= min_revisit).groupBy("payload_digest").agg(
        F.max("page_id").alias("_holder"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    joined = df.join(repeated, "payload_digest", "left")
    again = F.col("_holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_holder"))
    return joined.select(
        "page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "payload_bytes",
        "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("_holder")).alias("refers_to"))


def record(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) -> bytes:
    """One record: header, HTTP header, and for a response the payload."""
    http = BREAK.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
                       b"Content-Length: %d" % payload_bytes, b"", b""])
    block = http + (bytes(payload) if record_type == "response" else b"")
    digest = base64.b32encode(bytes.fromhex(payload_digest)).decode()
    headers = [("WARC-Type", record_type), ("WARC-Date", DATE),
               ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Length", str(len(block)))]
    if page_id is not None:
        headers.append(("WARC-Record-ID", f"<{PAGE_URN}{page_id}>"))
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)
        headers.append(("WARC-Target-URI", safe))
    if record_type == "revisit":
        headers += [("WARC-Profile", REVISIT_PROFILE),
                    ("WARC-Refers-To", f"<{PAGE_URN}{refers_to}>")]
    lines = [VERSION, *[f"{k}: {v}".encode() for k, v in headers], b"", b""]
    return BREAK.join(lines) + block + BREAK + BREAK


def _place(root: str):
    """File system and path of a folder that all executors share."""
    from pyarrow import fs

    if re.match(r"file:/(?!/)", root):
        root = "file://" + root[len("file:"):]
    system, path = fs.FileSystem.from_uri(root)
    system.create_dir(path, recursive=True)
    return system, path


def _archive_name() -> str:
    task = TaskContext.get()
    return f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"


def write_archives(records: DataFrame, root: str, archive_bytes: int = ARCHIVE_BYTES,
                   level: int = LEVEL) -> DataFrame:
    """Write rows of ``with_record_types`` as archives of one gzip stream each; returns the table of
    archives."""
    for_python(records.sparkSession)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, folder = _place(root)
        out = squeeze = path = None
        size = count = 0
        for rows in batches:
            for row in rows.itertuples(index=False):
                if out is None:
                    path = posixpath.join(folder, _archive_name())
                    out = system.open_output_stream(path, compression=None)
                    squeeze = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                    size = count = 0
                data = record(*row)
                out.write(squeeze.compress(data))
                size, count = size + len(data), count + 1
                if size >= archive_bytes:
                    out.write(squeeze.flush())
                    out.close()
                    yield pd.DataFrame({"path": [path], "records": [count]})
                    out = None
        if out is not None:
            out.write(squeeze.flush())
            out.close()
            yield pd.DataFrame({"path": [path], "records": [count]})

    # Ids as text: pandas has no whole numbers beside nulls.
    ordered = records.select(F.col("page_id").cast("string"), "url", "payload", "payload_bytes",
                             "payload_digest", "record_type", F.col("refers_to").cast("string"))
    return written(ordered.mapInPandas(write, ARCHIVES), f"{root}-archives")


def inflated(source, chunk: int = CHUNK) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, in chunks."""
    inflate = zlib.decompressobj(GZIP)
    while data := source.read(chunk):
        while data:
            if inflate.eof:
                inflate = zlib.decompressobj(GZIP)
            part = inflate.decompress(data, chunk)
            if part:
                yield part
            data = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
    rest = b"" if inflate.eof else inflate.flush()
    if rest:
        yield rest
    if not inflate.eof:
        raise ValueError("the archive ends within its gzip stream")


def split_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """Headers of each record and its bytes, header and trailing breaks included, in pieces.

    The pieces of a record must be taken before the next record is asked for.
    """
    held = bytearray()

    def more() -> bool:
        part = next(chunks, None)
        if part:
            held.extend(part)
        return part is not None

    while True:
        while (end := held.find(BREAK + BREAK)) < 0:
            if not more():
                if held.strip():
                    raise ValueError("the archive ends within a record's header")
                return
        head = bytes(held[:end + 4])
        headers = parse_headers(head)
        left = int(headers["content-length"]) + 4

        def pieces(head=head, left=left):
            yield head
            del held[:len(head)]
            while left:
                if not held and not more():
                    raise ValueError("the archive ends within a record")
                part = bytes(held[:left])
                del held[:left]
                left -= len(part)
                yield part
        yield headers, pieces()


def parse_headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


def normalise(archives: DataFrame, root: str, level: int = LEVEL) -> DataFrame:
    """Rewrite archives (column ``path``) with one gzip member per record; returns the table of
    offsets, which also stands as ``<archive>.idx`` beside each archive."""
    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, folder = _place(root)
        for rows in batches:
            for source in rows["path"]:
                path = posixpath.join(folder, _archive_name())
                offset, found = 0, []
                with system.open_input_stream(source, compression=None) as read, \
                        system.open_output_stream(path, compression=None) as out, \
                        system.open_output_stream(path + ".idx", compression=None) as index:
                    for headers, pieces in split_records(inflated(read)):
                        squeeze, length = zlib.compressobj(level, zlib.DEFLATED, GZIP), 0
                        for piece in pieces:
                            part = squeeze.compress(piece)
                            length += len(part)
                            out.write(part)
                        part = squeeze.flush()
                        out.write(part)
                        length += len(part)
                        entry = (path, offset, length, headers.get("warc-record-id"),
                                 headers.get("warc-type"))
                        index.write(json.dumps(entry[1:]).encode() + b"\n")
                        found.append(entry)
                        offset += length
                        if len(found) >= 10_000:
                            yield pd.DataFrame(found, columns=COLUMNS)
                            found = []
                yield pd.DataFrame(found, columns=COLUMNS)

    # One archive is one stream and so one task; there are as many as the writer made.
    alone = archives.select("path").repartitionByRange(max(1, archives.count()), "path")
    return written(alone.mapInPandas(rewrite, INDEX), f"{root}-index")


COLUMNS = ["path", "offset", "length", "record_id", "record_type"]
RECORD = ("page_id string, payload_bytes long, payload_digest string, record_type string, "
          "refers_to string, target_uri string, intact boolean")


def _urn_id(value: str | None) -> str | None:
    return value[len(PAGE_URN) + 1:-1] if value else None


def parse_record(data: bytes):
    """Fields of one record of this module's archives, and whether its payload has its digest."""
    end = data.index(BREAK + BREAK) + 4
    headers = parse_headers(data[:end])
    block = data[end:end + int(headers["content-length"])]
    http_end = block.index(BREAK + BREAK) + 4
    payload = block[http_end:]
    size = int(parse_headers(block[:http_end])["content-length"])
    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
    intact = headers["warc-type"] == "revisit" or (
        size == len(payload) and hashlib.sha1(payload).hexdigest() == digest)
    return (_urn_id(headers.get("warc-record-id")), size, digest, headers["warc-type"],
            _urn_id(headers.get("warc-refers-to")), headers.get("warc-target-uri"), intact)


def read_records(index: DataFrame, root: str, span: int = 8 << 20) -> DataFrame:
    """Read the records that a table of offsets names, each by its own offset; ``root`` names the file
    system that holds the archives. There is a task for every ``span`` bytes of archives, however small
    the index is."""
    for_python(index.sparkSession)

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, _ = _place(root)
        open_path, source = None, None
        for rows in batches:
            found = []
            for path, offset, length in zip(rows["path"], rows["offset"], rows["length"]):
                if path != open_path:
                    if source is not None:
                        source.close()
                    open_path, source = path, system.open_input_file(path)
                source.seek(offset)
                found.append(parse_record(zlib.decompress(source.read(length), GZIP)))
            yield pd.DataFrame(found, columns=[c.split()[0] for c in RECORD.split(", ")])
        if source is not None:
            source.close()

    part = F.floor(F.col("offset") / span)
    total = index.agg(F.sum("length")).first()[0] or 0
    near = index.select("path", "offset", "length").repartition(
        max(1, -(-total // span)), "path", part).sortWithinPartitions("path", "offset")
    return near.mapInPandas(fetch, RECORD).withColumns({
        "page_id": F.col("page_id").cast("long"), "refers_to": F.col("refers_to").cast("long")})


def archived(pages: DataFrame, root: str, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write pages to archives, normalise these, and read them back."""
    whole = write_archives(with_record_types(pages, min_revisit), f"{root}/whole")
    return read_records(normalise(whole, f"{root}/members"), root)
