"""WARC archives with an index written first, read back by coalesced byte ranges.

Each task writes gzip members, one per record, to its own file in the shared folder and returns
the index rows: file, offset, length, URL and digest. The index is a table; a selection of it is
sorted by file and offset, neighbouring ranges are read at once, and every record's digest is
tested. A file's name holds the attempt that wrote it, so a repeated task never mixes with another
and the index names only what its own attempt finished.

Defined cases: null html is an empty payload; a null url is written as an empty target; a null
page_id is written as such and never chosen as the copy that stays while another id exists; rows
that repeat the smallest page_id of a group are all responses; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, join_groups, materialize, new_path

INDEX = "page_id long, file string, offset long, length long, url string, digest string, record_type string"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
#: Smallest payload that a revisit may stand for; bytes of one archive file; widest gap and largest range of one read;
#: archive bytes that one task reads.
MIN_REVISIT, FILE_BYTES, GAP, RANGE, SHARE = 100, 1 << 30, 64 << 10, 8 << 20, 16 << 20
#: Pages carry no date, so records hold this one.
DATE = "2000-01-01T00:00:00Z"


def record(page_id: int | None, url: str, payload: bytes, digest: str, first: int | None) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP head alone, whose Content-Length still tells the payload's size."""
    kind = "response" if first is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if first is None else http
    fields = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {''.join(url.split())}", f"WARC-Payload-Digest: sha256:{digest}"]
    if first is not None:
        fields += [f"WARC-Refers-To: <urn:page:{first}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Fields, HTTP head and payload of one record; raises when a length or digest is wrong."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    size = int(fields["Content-Length"])
    if not version.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    if fields["WARC-Type"] == "response" and f"sha256:{hashlib.sha256(payload).hexdigest()}" != fields["WARC-Payload-Digest"]:
        raise ValueError("payload digest is wrong")
    return fields, http, payload


def classify(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest and first_id (null for what will be a response)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    groups = rows.where(F.octet_length("payload") >= MIN_REVISIT).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_id"))
    groups = materialize(groups.where("n > 1"), "warc-copies")
    many = groups.count()
    joined = rows.join(F.broadcast(groups), "digest", "left") if many <= 100_000 else join_groups(rows, groups, "digest", "n", rows.count())
    return joined.select("page_id", "url", "payload", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("first_id"))


def write_archives(pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, str]:
    """Write every page; the index table, and the folder of the archives."""
    spark = pages.sparkSession
    arrow_limits(spark)
    folder = folder or new_path(spark, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        try:
            for b in batches:
                rows = []
                for page_id, url, payload, digest, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(name, compression=None)
                    packed = gzip.compress(record(page_id, url, payload, digest, first), 3, mtime=0)
                    out.write(packed)
                    rows.append((page_id, name, at, len(packed), url, digest, "response" if first is None else "revisit"))
                    at += len(packed)
                if rows:
                    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["page_id", "file", "offset", "length", "url", "digest", "record_type"])
        finally:
            if out is not None:
                out.close()

    index = classify(pages).mapInArrow(run, INDEX)
    return materialize(index, "warc-index"), folder


def ranges(rows: Iterator[dict]) -> Iterator[list[dict]]:
    """Runs of index rows (sorted by file and offset) that one read covers."""
    run: list[dict] = []
    for r in rows:
        if run and (r["file"] != run[0]["file"] or r["offset"] - run[-1]["offset"] - run[-1]["length"] > GAP or r["offset"] + r["length"] - run[0]["offset"] > RANGE):
            yield run
            run = []
        run.append(r)
    if run:
        yield run


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that an index, or any selection of it, names."""
    arrow_limits(index.sparkSession)

    def one(data: bytes) -> tuple:
        fields, http, payload = parse(zlib.decompress(data, 31))
        number = lambda f: None if (x := fields.get(f, "<urn:page:None>")[10:-1]) == "None" else int(x)
        size = int(http.rpartition(b"Content-Length: ")[2])
        if fields["WARC-Type"] == "response" and size != len(payload):
            raise ValueError("payload length is wrong")
        return number("WARC-Record-ID"), size, fields["WARC-Payload-Digest"].partition(":")[2], fields["WARC-Type"], number("WARC-Refers-To"), fields["WARC-Target-URI"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for b in batches:
            rows = []
            for group in ranges(iter(b.to_pylist())):
                with store.open_input_file(group[0]["file"]) as f:
                    start = group[0]["offset"]
                    data = f.read_at(group[-1]["offset"] + group[-1]["length"] - start, start)
                rows += [one(data[r["offset"] - start : r["offset"] - start + r["length"]]) for r in group]
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"])

    # A number that is given is kept: an index row is small, but the record it names need not be.
    shares = max(1, -(-(index.agg(F.sum("length")).first()[0] or 0) // SHARE))
    picked = index.select("file", "offset", "length").repartitionByRange(shares, "file", "offset").sortWithinPartitions("file", "offset")
    return picked.mapInArrow(run, READ)


def warc_report(pages: DataFrame) -> DataFrame:
    """Write all pages, then read all records back."""
    index, folder = write_archives(pages)
    return read_records(index, folder)
