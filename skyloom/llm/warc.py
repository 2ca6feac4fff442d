"""WARC archives: writing responses and revisits in segments, and reading them back whole.

Writing: one string per record, written by Spark's text sink with the record terminator as
line separator, so each part file is a valid WARC file in any store that Spark can reach.
Reading: files are parsed by their lengths (never by searching for separators); continuation
records are grouped by their origin's identifier, ordered by segment number, checked against
the total length, and chunked transfer framing is decoded.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.common import durable, new_path

SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
FILE_RECORDS = 4_000
DATE = "2026-01-01T00:00:00Z"
MIN_REVISIT_BYTES = 0
END = "\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _cuts(text: str, most: int) -> list[str]:
    """Parts of at most ``most`` UTF-8 bytes (one character at least), cut between characters."""
    parts, raw, at = [], text.encode("utf-8"), 0
    while at < len(raw):
        end = min(at + most, len(raw))
        while end < len(raw) and end > at + 1 and raw[end] & 0xC0 == 0x80:
            end -= 1
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end += 1
        parts.append(raw[at:end].decode("utf-8"))
        at = end
    return parts


def chunked(body: str, most: int = CHUNK_BYTES) -> str:
    return "".join(f"{len(p.encode('utf-8')):x}\r\n{p}\r\n" for p in _cuts(body, most)) + "0\r\n\r\n"


def dechunk(raw: bytes) -> bytes:
    """The body of chunked transfer framing (extensions and trailers are passed over)."""
    out, at = [], 0
    while True:
        eol = raw.index(b"\r\n", at)
        size = int(raw[at:eol].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        at = eol + 2
        if raw[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(raw[at : at + size])
        at += size + 2


def _record(headers: list[tuple[str, object]], block: str) -> str:
    lines = [f"{k}: {v}" for k, v in headers if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block.encode('utf-8'))}"]) + "\r\n\r\n" + block


def records(record_id: str, url: str | None, html: str, kind: str, digest: str, refers_to: str | None) -> list[str]:
    """The record, or its first segment and continuations."""
    uri = quote(url, safe=":/?#[]@!$&'()*+,;=%-._~") if url else None
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<{refers_to}>")]
        return [_record(head, "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")]
    long = len(html) > CHUNK_BYTES
    framing = "Transfer-Encoding: chunked" if long else f"Content-Length: {len(html.encode('utf-8'))}"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{framing}\r\n\r\n" + (chunked(html) if long else html)
    parts = _cuts(block, SEGMENT_BYTES)
    if len(parts) == 1:
        return [_record(head, block)]
    out, total = [_record([*head, ("WARC-Segment-Number", 1)], parts[0])], len(block.encode("utf-8"))
    for k, part in enumerate(parts[1:], 2):
        last = total if k == len(parts) else None
        out.append(_record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{record_id}:{k}>"), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", f"<{record_id}>"), ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", last)], part))
    return out


def _digests(batches):
    for batch in batches:
        raw = [(h or "").encode("utf-8") for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("page_id", "row", "check")), pa.array([len(r) for r in raw], pa.int64()), pa.array([payload_digest(r) for r in raw])],
            names=["page_id", "row", "check", "payload_bytes", "digest"],
        )


def _written(batches):
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            name = lambda page, *own: f"urn:page:{'' if page is None else page}:{'.'.join(map(str, own))}"
            refers = name(row["target"], row["target_row"], row["target_check"], 0) if row["kind"] == "revisit" else None
            out += records(name(row["page_id"], row["row"], row["check"], row["copy"]), row["url"], row["html"] or "", row["kind"], row["digest"], refers)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])


def write_warc(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write a record per row (page_id, url, html) as gzip-compressed WARC files under ``path``.

    Of rows with equal payloads of at least ``min_revisit_bytes`` the one with the largest
    page_id (then the largest row hashes) is the response and the others revisit it;
    rows with a smaller payload are all responses.  Rows that are equal in full are told apart by number; one of
    them is the response, where any is.  A null html is empty, a null page_id sorts first.
    """
    numbered = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    numbered = numbered.withColumns({"row": F.xxhash64("page_id", "url", "html"), "check": F.xxhash64(F.lit(1), "page_id", "url", "html")})
    key = ["row", "check"]  # 128 bits
    digests = numbered.select("page_id", *key, "html").mapInArrow(_digests, "page_id long, row long, check long, payload_bytes long, digest string")
    digests = durable(digests.groupBy("page_id", *key, "payload_bytes", "digest").agg(F.count("*").alias("copies")), "digests")
    top = F.max(F.struct(F.coalesce("page_id", F.lit(-(2**63))).alias("p"), *key)).alias("top")
    shared = digests.where(F.col("payload_bytes") >= min_revisit_bytes).groupBy("digest").agg(top)
    chosen = digests.join(shared, "digest", "left").select(
        *key, "digest", "copies", F.col("top.row").alias("target_row"), F.col("top.check").alias("target_check"), F.when(F.col("top.p") != -(2**63), F.col("top.p")).alias("target")
    )
    own = F.col("target_row").isNull() | ((F.col("target_row") == F.col("row")) & (F.col("target_check") == F.col("check")))
    chosen = chosen.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    kind = F.when(own & (F.col("target_row").isNull() | (F.col("copy") == 0)), "response").otherwise("revisit")
    chosen = chosen.withColumn("kind", kind)
    once = numbered.dropDuplicates(key)
    full = once.join(chosen, key).select("page_id", *key, "url", F.when(F.col("kind") == "response", F.col("html")).alias("html"), "digest", "kind", "target", "target_row", "target_check", "copy")
    # A line is a segment of at most SEGMENT_BYTES and its headers, so a file stays below 100 MB.
    full.mapInArrow(_written, "value string").write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def parse(raw: bytes):
    """(headers, block) of every record of a WARC file."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        version, *lines = raw[at:end].decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(headers["content-length"])
        yield headers, raw[end + 4 : end + 4 + size]
        at = end + 4 + size
        while raw[at : at + 2] == b"\r\n":
            at += 2


def http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip().lower() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    if fields.get(b"transfer-encoding") == b"chunked":
        return dechunk(body)
    if b"content-length" in fields and len(body) != int(fields[b"content-length"]):
        raise ValueError("the body is not as long as its header says")
    return body


_FIELDS = "record string, origin string, segment int, total long, kind string, digest string, refers string, block binary"


def _parsed(batches):
    for batch in batches:
        for content in batch.column("content"):
            raw = content.as_py()
            raw = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
            rows = []
            for h, block in parse(raw):
                name = h["warc-record-id"].strip("<>")
                rows.append((name, h.get("warc-segment-origin-id", name).strip("<>"), int(h.get("warc-segment-number", 0)), int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None, h["warc-type"], h.get("warc-payload-digest", "").removeprefix("sha1:") or None, h.get("warc-refers-to", "").strip("<>") or None, block))
                if len(rows) == 500:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)


def _batch(rows):
    types = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary())
    names = ["record", "origin", "segment", "total", "kind", "digest", "refers", "block"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _payloads(batches):
    for batch in batches:
        out = []
        for kind, digest, block in zip(*(batch.column(c).to_pylist() for c in ("kind", "digest", "block")), strict=True):
            payload = http_payload(block)
            if kind == "response" and payload_digest(payload) != digest:
                raise ValueError("a payload does not have the digest of its record")
            out.append(payload)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("record", "kind", "digest", "refers")), pa.array(out, pa.binary())], names=["record", "kind", "digest", "refers", "payload"])


def _joined(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("segment")
    block, total = b"".join(pdf.block), pdf.total.dropna()
    if list(pdf.segment) != list(range(1, len(pdf) + 1)) or len(total) != 1 or int(total.iloc[0]) != len(block):
        raise ValueError(f"segments of {pdf.origin.iloc[0]} are missing, repeated or not as long as stated")
    first = pdf.iloc[:1]
    return pd.DataFrame({"record": first.origin.to_numpy(), "kind": first.kind.to_numpy(), "digest": first.digest.to_numpy(), "refers": first.refers.to_numpy(), "block": [block]})


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """record, kind, digest, refers, payload of every response and revisit under ``path``.

    A record's segments may lie in any files; they are grouped by origin identifier, so a
    group is one record.  Missing, repeated or short segments raise an error.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    found = files.mapInArrow(_parsed, _FIELDS)
    whole = found.where("segment = 0").select("record", "kind", "digest", "refers", "block")
    joined = found.where("segment > 0").groupBy("origin").applyInPandas(_joined, "record string, kind string, digest string, refers string, block binary")
    return whole.unionByName(joined).mapInArrow(_payloads, "record string, kind string, digest string, refers string, payload binary")


def round_trip(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES, path: str | None = None) -> DataFrame:
    """Write the pages as WARC, read the archives back, one row per page from what was read.

    page_id, payload_bytes, payload_digest, record_type, refers_to.  A revisit's payload is that
    of the response that it names.  An empty table writes an empty archive.  Rows equal in all
    three columns are written and returned each.
    """
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    write_warc(pages, path, min_revisit_bytes)
    back = read_warc(spark, path).select("record", "kind", "digest", "refers", F.octet_length("payload").cast("long").alias("size"))
    back = durable(back, "records")
    sizes = back.where("kind = 'response'").select(F.col("record").alias("refers"), F.col("size").alias("full")).dropDuplicates(["refers"])
    page = lambda c: F.split(c, ":")[2].try_cast("long")
    return back.join(sizes, "refers", "left").select(
        page(F.col("record")).alias("page_id"),
        F.when(F.col("kind") == "revisit", F.col("full")).otherwise(F.col("size")).alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        page(F.col("refers")).alias("refers_to"),
    )
