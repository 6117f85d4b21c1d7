"""A content-addressed WARC archive: payload bytes once by digest, exact record headers apart.

Two tables in the shared folder: ``payloads`` (digest, deflated bytes) and ``records`` (the
header bytes of every record, its payload's digest). Joining them gives back every record
byte by byte; reading tests each payload against its digest.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, text_bytes

DATE = "2024-01-01T00:00:00Z"


def _describe(pages: DataFrame, with_payload: bool) -> DataFrame:
    """(page_id, url, digest, sha1, n[, body]) of each page; digest: SHA-256 of the payload."""
    schema = "page_id long, url string, digest binary, sha1 string, n long" + ", body binary" * with_payload

    def run(batches):
        for b in batches:
            data, off = text_bytes(b.column(2))
            raw, at = data.tobytes(), off.tolist()
            parts = [raw[i:j] for i, j in zip(at, at[1:], strict=False)]
            cols = [b.column(0), b.column(1), pa.array([hashlib.sha256(x).digest() for x in parts], pa.binary()), pa.array([base64.b32encode(hashlib.sha1(x).digest()).decode() for x in parts], pa.string()), pa.array([len(x) for x in parts], pa.int64())]
            names = ["page_id", "url", "digest", "sha1", "n"]
            if with_payload:
                cols.append(pa.array([zlib.compress(x, 6) for x in parts], pa.binary()))
                names.append("body")
            yield pa.RecordBatch.from_arrays(cols, names)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, schema)


def record_id(row, page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row}\n{page_id}')}>"


def header(kind: str, row, page_id, url: str, sha1: str, n: int, refers: tuple | None) -> bytes:
    """The exact header block of one WARC/1.1 record."""
    clean = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(row, page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {clean}", f"WARC-Payload-Digest: sha1:{sha1}"]
    if refers is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(*refers)}", f"X-Refers-To-Page: {'' if refers[1] is None else refers[1]}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"X-Payload-Length: {n}", f"Content-Length: {n if refers is None else 0}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def fields(head: bytes) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if ": " in x)


def write(pages: DataFrame, least: int = 0) -> tuple[DataFrame, DataFrame]:
    """Archive every row of pages (page_id, url, html); returns the tables (records, payloads).

    Null html is an empty payload; null urls and ids are kept (a null id comes last in order).
    Of equal payloads of at least ``least`` bytes the smallest page_id is the response and the
    others revisit it; of repeated ids with equal payload one row is the response. Smaller
    payloads are responses each, though their bytes are still stored once.
    """
    marked = stage(_describe(pages, False).withColumn("row", F.monotonically_increasing_id()), "described")
    order = F.struct(F.col("page_id").isNull().alias("z"), "page_id", "row")
    first = marked.groupBy("digest").agg(F.min(order).alias("first"))
    joined = marked.join(first, "digest")
    revisit = (F.col("n") >= least) & (F.col("row") != F.col("first.row"))
    plain = joined.select("row", "page_id", "url", "digest", "sha1", "n", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("kind"), F.col("first.page_id").alias("refers"), F.col("first.row").alias("refers_row"))

    def heads(batches):
        for b in batches:
            r = b.to_pydict()
            # a revisit of a null id still names it: the empty string
            cols = (r[c] for c in ("row", "page_id", "url", "sha1", "n", "kind", "refers", "refers_row"))
            head = [header(k, i, p, u, s, n, (at, f) if k == "revisit" else None) for i, p, u, s, n, k, f, at in zip(*cols, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(3), pa.array(head, pa.binary())], ["page_id", "digest", "header"])

    records = stage(plain.mapInArrow(heads, "page_id long, digest binary, header binary"), "records")
    keep = first.select(F.col("first.page_id").alias("page_id"), F.col("digest").alias("want"))
    bodies = _describe(pages, True)
    stored = bodies.join(keep, bodies.page_id.eqNullSafe(keep.page_id) & (bodies.digest == keep.want), "left_semi").select("digest", "body").dropDuplicates(["digest"])  # repeated rows
    payloads = stage(stored, "payloads", "none")
    return records, payloads


def _inflate(digest: bytes, body: bytes) -> bytes:
    raw = zlib.decompress(body)
    if hashlib.sha256(raw).digest() != digest:
        raise ValueError("WARC: a stored payload does not have its digest")
    return raw


def verify(payloads: DataFrame) -> DataFrame:
    """(digest, n, sha1) of each stored payload, read back and tested; damage raises."""

    def run(batches):
        for b in batches:
            raw = [_inflate(d, x) for d, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array([base64.b32encode(hashlib.sha1(x).digest()).decode() for x in raw], pa.string())], ["digest", "n", "sha1"])

    return payloads.select("digest", "body").mapInArrow(run, "digest binary, n long, sha1 string").groupBy("digest").agg(F.first("n").alias("n"), F.first("sha1").alias("sha1"))


def index(records: DataFrame, payloads: DataFrame) -> DataFrame:
    """One row per record, from its header and its verified payload."""
    both = records.join(verify(payloads), "digest")

    def run(batches):
        for b in batches:
            found = [fields(h) for h in b.column(1).to_pylist()]
            for f, n, s in zip(found, b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if f["WARC-Payload-Digest"] != f"sha1:{s}" or int(f["X-Payload-Length"]) != n:
                    raise ValueError("WARC: header and payload disagree")
            refers = [f.get("X-Refers-To-Page") for f in found]
            cols = [b.column(0), b.column(2), b.column(3), pa.array([f["WARC-Type"] for f in found], pa.string()), pa.array([int(x) if x else None for x in refers], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return both.select("page_id", "header", "n", "sha1").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def restore(records: DataFrame, payloads: DataFrame) -> DataFrame:
    """(page_id, record, payload): each record's exact bytes and its full payload, also for revisits."""

    def run(batches):
        for b in batches:
            raw = [_inflate(d, x) for d, x in zip(b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True)]
            heads = b.column(2).to_pylist()
            record = [h + (b"" if b"\r\nWARC-Type: revisit\r\n" in h else x) + b"\r\n\r\n" for h, x in zip(heads, raw, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(record, pa.binary()), pa.array(raw, pa.binary())], ["page_id", "record", "payload"])

    one = payloads.groupBy("digest").agg(F.first("body").alias("body"))
    return records.join(one, "digest").select("page_id", "digest", "header", "body").mapInArrow(run, "page_id long, record binary, payload binary")
