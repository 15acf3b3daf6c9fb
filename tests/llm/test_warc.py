import gzip
import hashlib
import json
import os

import pytest

from fathomkit.llm.warc import archived, normalise, read_records, with_kinds, write_monolithic
from fathomkit.session import fresh_path, hold


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, n_bytes string")


@pytest.fixture(scope="module")
def odd_pages(spark):
    long, short = "ä" * 600, "b" * 999
    rows = [
        (1, "http://a/1", long), (2, None, long), (3, "http://a/3 x\ny", long), (3, "http://a/3", long), (4, "u", short),
        (5, "u", short), (6, "u", None), (7, "u", ""), (None, "u", long), (8, "u", "z" * 2_000_000),
        (9, "u", "WARC/1.1\r\n\r\n" * 200),
    ]
    return pages(spark, [(*r, "x", "y") for r in rows]).repartition(2)


def test_kinds_sizes_and_digests(odd_pages):
    got = sorted(((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0)
                  for r in archived(odd_pages).collect()))
    want = []
    for r in odd_pages.collect():
        raw = (r.html or "").encode()
        copy = len(raw) >= 1000 and r.html.startswith("ä") and r.page_id != 3
        want.append((r.page_id is None, r.page_id or 0, len(raw), hashlib.sha1(raw).hexdigest(),
                     "revisit" if copy else "response", 3 if copy else 0))
    assert got == sorted(want)


def test_members_and_sidecar(spark, odd_pages):
    folder = fresh_path(spark, "warc-test")
    manifest = hold(write_monolithic(with_kinds(odd_pages), f"{folder}/monolithic", roll=3000))
    assert manifest.count() > 2
    index = hold(normalise(manifest, f"{folder}/members"))
    assert index.count() == odd_pages.count() == sum(r.records for r in manifest.collect())
    whole = b"".join(gzip.open(r.path.removeprefix("file:")).read() for r in manifest.orderBy("path").collect())
    again = b""
    for archive in sorted({r.archive for r in index.collect()}):
        path = archive.removeprefix("file:")
        raw = open(path, "rb").read()
        lines = [json.loads(x) for x in open(f"{path}.idx")]
        assert sum(x["length"] for x in lines) == os.path.getsize(path)
        for x in lines:
            part = gzip.decompress(raw[x["offset"]: x["offset"] + x["length"]])
            assert part.startswith(b"WARC/1.1\r\n") and part.endswith(b"\r\n\r\n")
        again += gzip.decompress(raw)
    assert len(again) == len(whole)
    assert read_records(index.where("record_type = 'revisit'")).count() == 3


def test_empty_table(odd_pages):
    assert archived(odd_pages.where("false")).collect() == []
