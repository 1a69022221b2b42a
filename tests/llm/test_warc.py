import gzip
import hashlib
import io
import json
import zlib

import pytest
from brute import as_dicts, rows

from tripmill.llm import queries, warc
from tripmill.session import fresh_folder


def expected(pages):
    """(id, bytes, digest, type, refers) by the contract."""
    out = []
    payloads = [(p, (h or "").encode()) for p, h in pages]
    for page, data in payloads:
        ids = [q for q, other in payloads if other == data and q is not None]
        holder = max(ids, default=None)
        again = len(data) >= 1000 and holder is not None and page != holder
        out.append((page, len(data), hashlib.sha1(data).hexdigest(),
                    "revisit" if again else "response", holder if again else None))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"],
                    r["refers_to"]) for r in as_dicts(df)), key=repr)


def test_every_page_comes_back(spark, sf_dir):
    df = queries.op7_gzip_normaliser(spark, sf_dir)
    assert found(df) == expected([(p["page_id"], p["html"]) for p in rows(sf_dir, "pages")])
    assert all(r["intact"] for r in as_dicts(df))


def test_defined_cases(spark):
    big, other = "x" * 1000, "é" * 600
    pages = [(1, "u", big), (2, "u", big), (9, None, big), (None, "u", big), (3, "u", None),
             (4, "u", ""), (5, "a\r\nWARC-Type: evil", "small"), (6, "u", "small"), (7, "u", other),
             (7, "u", other), (8, "u", other), (None, "u", "z" * 2000), (None, "u", "z" * 2000),
             (2 ** 62, "u", "\r\n\r\nWARC/1.1\r\n\r\n" + "y" * 900_000)]
    df = spark.createDataFrame([(p, u, h, b"x") for p, u, h in pages],
                               "page_id long, url string, html string, payload binary")
    got = warc.archived(df, fresh_folder(spark, "warc"))
    assert found(got) == expected([(p, h) for p, _, h in pages])
    assert all(r["intact"] for r in as_dicts(got))
    assert warc.archived(df.limit(0), fresh_folder(spark, "warc")).count() == 0


def test_normalised_archives_are_readable_member_by_member(spark, sf_dir):
    root = fresh_folder(spark, "warc")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    whole = warc.write_archives(warc.with_record_types(pages), f"{root}/whole", archive_bytes=20_000)
    assert whole.count() > 2
    for r in whole.collect():
        data = open(r.path, "rb").read()
        stream = zlib.decompressobj(warc.GZIP)
        stream.decompress(data)
        assert stream.eof and not stream.unused_data  # one member for the whole file
    index = warc.normalise(whole, f"{root}/members").orderBy("path", "offset").collect()
    by_path = {}
    for r in index:
        by_path.setdefault(r.path, []).append(r)
    for path, entries in by_path.items():
        data = open(path, "rb").read()
        at = 0
        for line, r in zip(open(path + ".idx"), entries, strict=True):
            assert r.offset == at and json.loads(line)[:2] == [r.offset, r.length]
            record = zlib.decompress(data[at:at + r.length], warc.GZIP)
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            at += r.length
        assert at == len(data)
    before = b"".join(sorted(gzip.open(r.path).read() for r in whole.collect()))
    after = b"".join(sorted(gzip.open(p).read() for p in by_path))
    assert before == after


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_streams_of_any_chunk_and_many_members(chunk):
    records = [warc.record("1", "u", b"p" * n, n, hashlib.sha1(b"p" * n).hexdigest(), "response",
                           None) for n in (0, 10, 5000)]
    data = gzip.compress(records[0] + records[1]) + gzip.compress(records[2])
    got = [b"".join(pieces) for _, pieces in
           warc.split_records(warc.inflated(io.BytesIO(data), chunk))]
    assert got == records


def test_a_cut_archive_is_an_error():
    data = gzip.compress(b"WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n" * 50)
    with pytest.raises(ValueError):
        list(warc.inflated(io.BytesIO(data[:-12])))
