"""Operator 8 -- WARC archives with segmented records.

Writing: pages whose payloads (of at least ``dedup_bytes``) are equal share one
full record, that of the largest id; the others are ``revisit`` records that
refer to it. A response holds an HTTP head and the payload in chunked transfer
framing; blocks longer than ``segment_bytes`` are cut, the rest following as
``continuation`` records that may lie in any archive file.

Reading: archives are parsed record by record by their Content-Length.
Continuation records are grouped by the id of their origin, ordered by segment
number and joined; numbering and the stated total length are verified, then the
chunked framing is decoded, of which the payload's digest must agree with the
one stated. Revisits take over from the response they refer to.

Archives are written by Spark's text writer into the shared folder (one record
per row, gzip per file) and read back as binary files, so any store works.
Payloads are UTF-8 bytes; null and empty html are payloads of no bytes. Null
ids and urls are allowed, repeated rows are records of their own (among equal
ids the later row is the response). An empty table gives an empty result. Other
input columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import batches, stage, table
from lamina.session import scratch_path

DEDUP_BYTES = 1000
SEGMENT_BYTES = 16_384
CHUNK_BYTES = 1024
FILE_RECORDS = 2_048  # no record is longer than a segment and its head, so this bounds a file

CRLF = b"\r\n"
_HEAD = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Transfer-Encoding: chunked", b"", b""])
_DATE = "1970-01-01T00:00:00Z"  # records carry no clock: equal pages give equal archives


class ArchiveError(ValueError):
    """An archive or a record in it is not intact."""


# --- framing (helpers inside a task) --------------------------------------

def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(c), c) for c in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Decode chunked transfer framing (chunk extensions and trailers allowed)."""
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        if end < 0:
            raise ArchiveError("chunk size is cut off")
        try:
            size = int(body[at:end].split(b";")[0].strip(), 16)
        except ValueError as e:
            raise ArchiveError("chunk size is not hexadecimal") from e
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != CRLF:
            raise ArchiveError("chunk is cut off")
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    head, mark, body = block.partition(CRLF + CRLF)
    if not mark:
        raise ArchiveError("HTTP head is cut off")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head) else body


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One WARC record without its closing CRLF CRLF (the writer's line separator)."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        end = data.find(CRLF + CRLF, at)
        if end < 0 or not data.startswith(b"WARC/1.", at):
            raise ArchiveError("record head is not intact")
        head = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
        start = end + 4
        stop = start + int(head["Content-Length"])
        if data[stop : stop + 4] != CRLF + CRLF:
            raise ArchiveError("record is cut off")
        yield head, data[start:stop]
        at = stop + 4


def reassemble(segments: list[tuple[int, int | None, bytes]]) -> bytes:
    """The block of a record from its (number, total length or None, part) segments."""
    segments = sorted(segments, key=lambda s: s[0])
    if [s[0] for s in segments] != list(range(1, len(segments) + 1)):
        raise ArchiveError("a segment is missing or repeated")
    block = b"".join(s[2] for s in segments)
    if len(segments) > 1 and segments[-1][1] != len(block):
        raise ArchiveError("segments do not add up to the stated total length")
    return block


def _record_id(uid: int) -> str:
    h = hashlib.sha1(b"lamina-page-%d" % uid).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-8{h[17:20]}-{h[20:32]}>"


def _uri(url: str | None, uid: int) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:lamina:page:{uid}"


# --- writing --------------------------------------------------------------

def _with_roles(pages: DataFrame, id_col: str, url_col: str, html_col: str, dedup_bytes: int) -> DataFrame:
    """``(uid, id, url, html, digest, bytes, owner)``; ``owner(id, uid)`` is the record of the full payload."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"),
        F.col(url_col).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"),
        F.octet_length(html).cast("long").alias("bytes"))
    copies = (
        rows.filter(F.col("bytes") >= dedup_bytes).groupBy("digest", "bytes")
        .agg(F.max(F.struct("id", "uid")).alias("owner"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    return rows.join(copies, ["digest", "bytes"], "left")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   dedup_bytes: int = DEDUP_BYTES, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
                   file_records: int = FILE_RECORDS) -> None:
    """Write ``pages`` as gzipped WARC files under ``path``."""

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches(frames):
            out = []
            for uid, page, url, html, digest, size, owner in zip(*(pdf[c] for c in (
                    "uid", "id", "url", "html", "digest", "bytes", "owner"))):
                page = None if pd.isna(page) else str(int(page))
                fields = [("WARC-Record-ID", _record_id(uid)), ("WARC-Date", _DATE), ("WARC-Target-URI", _uri(url, uid)),
                          ("X-Page-ID", page), ("WARC-Payload-Digest", f"sha1:{digest}")]
                if owner is not None and owner["uid"] != uid:
                    full = None if pd.isna(owner["id"]) else str(int(owner["id"]))
                    out.append(record([
                        ("WARC-Type", "revisit"), *fields, ("WARC-Refers-To", _record_id(owner["uid"])),
                        ("X-Refers-To-Page-ID", full), ("X-Payload-Length", str(size)),
                        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")], b""))
                    continue
                block = _HEAD + chunked(html.encode("utf-8", "surrogatepass"), chunk_bytes)
                cuts = range(0, len(block), segment_bytes)
                for n, at in enumerate(cuts, 1):
                    part = block[at : at + segment_bytes]
                    whole = [("WARC-Segment-Total-Length", str(len(block)))] if n == len(cuts) > 1 else []
                    if n == 1:
                        first = [("WARC-Segment-Number", "1")] if len(cuts) > 1 else []
                        out.append(record([("WARC-Type", "response"), *fields, *first], part))
                    else:
                        out.append(record([
                            ("WARC-Type", "continuation"), ("WARC-Record-ID", _record_id(-uid * 1_000_003 - n)),
                            ("WARC-Date", _DATE), ("WARC-Target-URI", _uri(url, uid)),
                            ("WARC-Segment-Origin-ID", _record_id(uid)), ("WARC-Segment-Number", str(n)), *whole], part))
            yield pd.DataFrame({"record": out})

    records = _with_roles(pages, id_col, url_col, html_col, dedup_bytes).mapInPandas(build, "record binary")
    (
        records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n")
        .option("compression", "gzip").option("maxRecordsPerFile", file_records).text(path)
    )


# --- reading --------------------------------------------------------------

_PARSED = ("type string, record_id string, page_id long, digest string, refers_to string, refers_to_page long, "
           "origin string, number int, total long, block binary")


def read_records(spark, path: str) -> DataFrame:
    """Every record of the archives under ``path``."""
    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches(frames):
            for content in pdf["content"]:
                rows = []
                for head, block in parse_archive(gzip.decompress(content)):
                    whole = lambda k, h=head: int(h[k]) if k in h else None
                    rows.append((
                        head["WARC-Type"], head["WARC-Record-ID"], whole("X-Page-ID"),
                        head.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None, head.get("WARC-Refers-To"),
                        whole("X-Refers-To-Page-ID"), head.get("WARC-Segment-Origin-ID", head["WARC-Record-ID"]),
                        whole("WARC-Segment-Number"), whole("WARC-Segment-Total-Length"), block))
                frame = pd.DataFrame(rows, columns=[c.split()[0] for c in _PARSED.split(", ")])
                for c in ("page_id", "refers_to_page", "total"):
                    frame[c] = frame[c].astype("Int64")
                frame["number"] = frame["number"].astype("Int32")
                yield frame

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInPandas(parse, _PARSED)


def read_archives(spark, path: str, payloads: bool = True) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, payload)`` of every page.

    ``payload`` is null for revisits, and left out without ``payloads``. Raises
    ``ArchiveError`` in the task for a record that is not intact. Only
    segmented records are shuffled.
    """
    parsed = read_records(spark, path)
    head = F.struct("page_id", "digest")
    part = F.struct(F.coalesce("number", F.lit(1)).alias("number"), "total", "block")
    cut = parsed.filter("type = 'continuation' or type = 'response' and number is not null").groupBy("origin").agg(
        F.max(F.when(F.col("type") == "response", head)).alias("head"), F.collect_list(part).alias("parts"))
    uncut = parsed.filter("type = 'response' and number is null").select(
        "origin", head.alias("head"), F.array(part).alias("parts"))
    parts = uncut.unionByName(cut)

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches(frames):
            out = []
            for origin, head, parts in zip(pdf["origin"], pdf["head"], pdf["parts"]):
                if head is None:
                    raise ArchiveError(f"no first segment of {origin}")
                payload = http_payload(reassemble([
                    (p["number"], None if p["total"] is None or np.isnan(p["total"]) else int(p["total"]), p["block"])
                    for p in parts]))
                digest = hashlib.sha1(payload).hexdigest()
                if digest != head["digest"]:
                    raise ArchiveError(f"payload of {origin} differs from its stated digest")
                out.append((origin, head["page_id"], len(payload), digest, payload))
            frame = pd.DataFrame(out, columns=["record_id", "page_id", "payload_bytes", "payload_digest", "payload"])
            frame["page_id"] = frame["page_id"].astype("Int64")
            yield frame

    whole = parts.mapInPandas(
        join, "record_id string, page_id long, payload_bytes long, payload_digest string, payload binary")
    full = stage(whole if payloads else whole.drop("payload"), "warc_payloads")
    visits = parsed.filter("type = 'revisit'").select(
        F.col("page_id").alias("own"), F.col("digest").alias("stated"), "refers_to", "refers_to_page")
    again = visits.join(
        full.select(F.col("record_id").alias("refers_to"), "payload_bytes", "payload_digest"), "refers_to", "left")
    intact = F.when(F.col("stated") == F.col("payload_digest"), F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("revisit of a payload that the archives do not hold: "), F.col("stated"))))
    return full.drop("record_id").withColumns({
        "record_type": F.lit("response"), "refers_to": F.lit(None).cast("long"),
    }).unionByName(again.select(
        F.col("own").alias("page_id"), "payload_bytes", intact.alias("payload_digest"),
        F.lit("revisit").alias("record_type"), F.col("refers_to_page").alias("refers_to")), allowMissingColumns=True)


def op8_warc_segments(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path, payloads=False)


OP8_SQL = f"""
with p as (select row_number() over () as r, page_id, coalesce(html, '') as html from pages),
d as (select *, strlen(html) as bytes, sha1(html) as digest from p),
o as (select *, first_value(r) over w as owner, first_value(page_id) over w as owner_page from d
  window w as (partition by digest, bytes order by page_id desc nulls last, r desc))
select page_id, bytes::bigint as payload_bytes, digest as payload_digest,
  case when bytes >= {DEDUP_BYTES} and owner <> r then 'revisit' else 'response' end as record_type,
  case when bytes >= {DEDUP_BYTES} and owner <> r then owner_page end as refers_to
from o
"""
