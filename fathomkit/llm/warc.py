"""WARC archives: writing, normalising monolithic gzip files, reading by offset.

A monolithic archive is one gzip stream over all its records, so nothing in it can be reached without inflating all
before it. The normaliser inflates each such file once, block by block, rewrites every record as a gzip member of its
own, and writes a sidecar index (JSON lines) of offset and length. The index is also a table, by which any number of
tasks then read single records. A file is one task's work, as one stream can be inflated in no other way; a record
passes through in blocks, so memory does not follow its size.

Files are written through ``pyarrow.fs`` below the shared folder of the session. Each attempt of a task writes a name
of its own and only what the committed attempt returned is in the manifest, so a lost executor leaves no half file in
the result.

Defined cases: a null payload is an empty one; null ids and urls are kept as missing header fields; a payload of any
length passes; rows repeated with the same id are records of their own, and all those that carry the largest id of a
group of equal payloads are responses; other columns are ignored; an empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import json
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomkit.llm.jobs import query, table
from fathomkit.session import fresh_path, hold

LEAST_REVISIT_BYTES = 1000
ROLL_BYTES = 256 << 20
BLOCK = 1 << 18
READ_TASK_BYTES = 32 << 20

# Header texts of the archive format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2020-01-01T00:00:00Z"
GZIP = 31


def _open(uri: str):
    return pafs.FileSystem.from_uri(uri)


def with_kinds(pages: DataFrame, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest and refers_to (null: response).

    Only digests that occur under several ids are joined back, so where copies are few the pages are not shuffled.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("digest", F.sha1("payload")).withColumn("n_bytes", F.octet_length("payload").cast("long"))
    copies = hold(
        rows.where(F.col("n_bytes") >= least).groupBy("digest", "n_bytes")
        .agg(F.max("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    return rows.join(copies, ["digest", "n_bytes"], "left").select(
        "page_id", "url", "payload", "digest", "n_bytes",
        F.when(~F.col("first_id").eqNullSafe(F.col("page_id")), F.col("first_id")).alias("refers_to"),
    )


def _base32(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def _record(page_id, url, payload: bytes, digest: str, n_bytes: int, refers_to) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n_bytes
    body = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", RECORD_DATE),
        ("WARC-Payload-Digest", f"sha1:{_base32(digest)}"),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-Id", str(refers_to))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return head + b"\r\n" + body + b"\r\n\r\n"


def write_monolithic(records: DataFrame, folder: str, roll: int = ROLL_BYTES) -> DataFrame:
    """Writes the rows of ``with_kinds`` as archives of one gzip stream each; returns (path, records, bytes)."""

    def write(batches):
        out = deflate = None
        path, n, size = "", 0, 0
        done = []

        def close():
            out.write(deflate.flush())
            out.close()
            done.append((path, n, size))

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if out is None:
                    path, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    fs, at = _open(path)
                    fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
                    out, deflate = fs.open_output_stream(at, compression=None), zlib.compressobj(6, zlib.DEFLATED, GZIP)
                raw = _record(*row)
                out.write(deflate.compress(raw))
                n, size = n + 1, size + len(raw)
                if size >= roll:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
            names=["path", "records", "bytes"],
        )

    return records.select("page_id", "url", "payload", "digest", "n_bytes", "refers_to").mapInArrow(
        write, "path string, records long, bytes long",
    )


class Inflated:
    """The bytes of a gzip file with one or more members, in blocks."""

    def __init__(self, source):
        self.source, self.inflate, self.buffer, self.ended = source, zlib.decompressobj(GZIP), b"", False

    def more(self) -> bool:
        while not self.ended:
            raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            raw = raw or self.source.read(BLOCK)
            if not raw:
                if not self.inflate.eof:
                    raise ValueError("the gzip stream ends within a member")
                self.ended = True
                return False
            if self.inflate.eof:
                self.inflate = zlib.decompressobj(GZIP)
            got = self.inflate.decompress(raw, BLOCK)
            if got:
                self.buffer += got
                return True
        return False

    def head(self) -> bytes | None:
        """Up to and with the next empty line; None at the end of the file."""
        while (at := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self.more():
                if self.buffer.strip():
                    raise ValueError("the archive ends within a header")
                return None
        got, self.buffer = self.buffer[: at + 4], self.buffer[at + 4:]
        return got

    def body(self, n: int):
        """The next ``n`` bytes, block by block."""
        while n:
            if not self.buffer and not self.more():
                raise ValueError("the archive ends within a record")
            got, self.buffer = self.buffer[:n], self.buffer[n:]
            n -= len(got)
            yield got


def header_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def _normalise(path: str, target: str):
    """Rewrites one archive; yields (offset, length, fields) of the records as they lie in ``target``."""
    fs, at = _open(path)
    to_fs, to = _open(target)
    to_fs.create_dir(to.rsplit("/", 1)[0], recursive=True)
    offset = 0
    with (
        fs.open_input_stream(at, compression=None) as source, to_fs.open_output_stream(to, compression=None) as out,
        to_fs.open_output_stream(f"{to}.idx", compression=None) as sidecar,
    ):
        archive = Inflated(source)
        while (head := archive.head()) is not None:
            fields, deflate, length = header_fields(head), zlib.compressobj(6, zlib.DEFLATED, GZIP), 0
            blocks = itertools.chain([head], archive.body(int(fields["content-length"]) + 4))
            for part in itertools.chain(map(deflate.compress, blocks), map(deflate.flush, [zlib.Z_FINISH])):
                length += len(part)
                out.write(part)
            line = {"offset": offset, "length": length, "type": fields.get("warc-type"),
                    "id": fields.get("warc-record-id"), "uri": fields.get("warc-target-uri")}
            sidecar.write(json.dumps(line).encode() + b"\n")
            yield offset, length, fields
            offset += length


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """One member per record and a sidecar per archive; returns the index (archive, offset, length, record_type).

    ``archives`` has a column path. They are dealt out evenly, one stream per task as far as there are tasks.
    """

    def rewrite(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                target = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                rows = [(target, o, n, f.get("warc-type")) for o, n, f in _normalise(path, target)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in
                     enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))],
                    names=["archive", "offset", "length", "record_type"],
                )

    n = max(1, archives.count())
    return archives.select("path").repartitionByRange(n, "path").mapInArrow(
        rewrite, "archive string, offset long, length long, record_type string",
    )


def read_records(index: DataFrame) -> DataFrame:
    """The records at the places of ``index``, with payload size and digest; a digest is checked against its header."""

    def read(batches):
        name, source = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if archive != name:
                    if source is not None:
                        source.close()
                    fs, at = _open(archive)
                    name, source = archive, fs.open_input_file(at)
                source.seek(offset)
                raw = zlib.decompress(source.read(length), GZIP)
                head, _, rest = raw.partition(b"\r\n\r\n")
                fields = header_fields(head)
                http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
                digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                n_bytes = len(payload)
                if fields["warc-type"] == "revisit":
                    n_bytes = next(int(x[15:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                elif hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"{archive} at {offset}: the payload is not the one that was written")
                ids = [fields.get(k) for k in ("x-page-id", "x-refers-to-page-id")]
                ids = [None if x is None else int(x) for x in ids]
                rows.append((ids[0], n_bytes, digest, fields["warc-type"], ids[1], archive, offset, length))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                     "archive", "offset", "length"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)
        if source is not None:
            source.close()

    size = index.agg(F.sum("length"), F.countDistinct("archive")).first()
    n = max(1, size[1] or 0, (size[0] or 0) // READ_TASK_BYTES)
    placed = index.select("archive", "offset", "length").repartitionByRange(n, "archive", "offset")
    return placed.sortWithinPartitions("archive", "offset").mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
              "archive string, offset long, length long",
    )


def archived(pages: DataFrame, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Pages through a monolithic archive and its normalised form, as read back from there."""
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    manifest = hold(write_monolithic(with_kinds(pages, least), f"{folder}/monolithic"))
    index = hold(normalise(manifest, f"{folder}/members"))
    return read_records(index)


@query("op7_warc_normaliser", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
FROM m""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = archived(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
