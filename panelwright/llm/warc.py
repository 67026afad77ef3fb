"""WARC: writes pages as segmented, chunked records and reassembles them from the archives."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelwright.operators.joins import join_aggregate
from panelwright.session import new_folder, sized, stored

SEGMENT, CHUNK = 64 * 1024, 16 * 1024
# Records of an archive file; with the segment size this bounds what a reading task holds.
FILE_RECORDS = 2_000
SMALLEST_REVISIT = 1000
_DATE = "1970-01-01T00:00:00Z"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def chunked(body: bytes, size: int = CHUNK) -> bytes:
    """A body in chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(body[a : a + size]), body[a : a + size]) for a in range(0, len(body), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(data: bytes) -> bytes:
    """The body of chunked transfer framing; chunk extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = data.index(b"\r\n", at)
        size = int(data[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if len(data) < at + size + 2 or data[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut short")
        out.append(data[at : at + size])
        at += size + 2


def body_of(http: bytes) -> tuple[bytes, dict[str, str]]:
    """The payload of an HTTP response block, and its headers by lower-case name."""
    head, _, body = http.partition(b"\r\n\r\n")
    headers = _headers(head)
    return (dechunked(body) if headers.get("transfer-encoding", "").lower() == "chunked" else body), headers


def _headers(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def _record(kind: str, own: str, url: str, block: bytes, more: dict[str, str]) -> bytes:
    lines = {"WARC-Type": kind, "WARC-Record-ID": own, "WARC-Date": _DATE, "WARC-Target-URI": url}
    lines |= {"Content-Type": "application/http; msgtype=response", **more, "Content-Length": str(len(block))}
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines.items()) + "\r\n").encode() + block


def records_of(own: str, url: str | None, payload: bytes, digest: str, refers: str | None, segment: int) -> Iterator[bytes]:
    """The records of one page: a revisit without payload, or a response and its continuations."""
    url = _CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", url or "about:blank")
    named = {"WARC-Payload-Digest": f"sha1:{digest}"}
    if refers is not None:
        profile = {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": refers}
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
        yield _record("revisit", own, url, http.encode(), named | profile)
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment:
        yield _record("response", own, url, block, named)
        return
    starts = range(0, len(block), segment)
    for number, a in enumerate(starts, 1):
        more = {"WARC-Segment-Number": str(number)}
        more |= named if number == 1 else {"WARC-Segment-Origin-ID": own}
        more |= {"WARC-Segment-Total-Length": str(len(block))} if number == len(starts) else {}
        name = own if number == 1 else f"{own[:-1]}:{number}>"
        yield _record("response" if number == 1 else "continuation", name, url, block[a : a + segment], more)


def revisits(pages: DataFrame, key: str, smallest: int = SMALLEST_REVISIT) -> DataFrame:
    """(_place, refers_to, _refers_place) of the rows whose payload an earlier-named row already holds.

    Of rows with equal payloads of at least ``smallest`` bytes the one with the largest key is the original,
    of several with that key the first in the table. Only digests are grouped and shuffled.
    """
    narrow = stored(pages.select("_place", F.col(key).alias("_key"), "_digest", "_bytes").filter(F.col("_bytes") >= smallest), "payloads")
    groups = narrow.groupBy("_digest", "_bytes").agg(
        F.max(F.struct("_key", (-F.col("_place")).alias("p"))).alias("_top"), F.count("*").alias("_rows")).filter("_rows > 1")
    hit = join_aggregate(narrow, groups, ["_digest", "_bytes"], "_rows", "inner", "payload-groups")
    return hit.select("_place", F.col("_top._key").alias("refers_to"), (-F.col("_top.p")).alias("_refers_place")).filter(
        F.col("_place") != F.col("_refers_place"))


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", segment: int = SEGMENT) -> None:
    """Writes gzipped archives, one record per page and its continuations, to a new folder.

    A null payload is empty, a null url is about:blank. Rows are named by
    their key and a number, so repeated rows keep records of their own. Spark's own writer puts the two
    line ends behind each record, so any store that Spark writes to will do.
    """
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    placed = pages.select(F.monotonically_increasing_id().alias("_place"), F.col(key).alias("_key"), F.col(url).alias("_url"), body.alias("_body"))
    # Stored with their places, as places worked out in another scan may differ (``session.numbered``).
    placed = stored(placed.withColumn("_digest", F.sha1("_body")).withColumn("_bytes", F.length("_body").cast("long")), "numbered")
    known = sized(revisits(placed.withColumnRenamed("_key", key), key), "revisits")
    work = placed.join(known, "_place", "left").select("_place", "_key", "_url", "_body", "_digest", "refers_to", "_refers_place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                out = []
                for place, own, link, payload, digest, to, at in zip(*[c.to_pylist() for c in batch.slice(first, 64).columns], strict=True):
                    refers = None if at is None else f"<urn:page:{to}:{at}>"
                    out += records_of(f"<urn:page:{own}:{place}>", link, payload, digest, refers, segment)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    work.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\r\n\r\n").option(
        "compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(folder)


def _inflated(data: bytes) -> bytes:
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out) if out else data


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an archive; raises where a record is cut short."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        headers = _headers(data[at:end])
        start = end + 4
        at = start + int(headers["content-length"])
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield headers, data[start:at]
        at += 4


_READ = "record_id string, record_type string, target_uri string, refers_to_id string, payload_digest string, payload_bytes long, payload binary"


def _finished(headers: dict[str, str], block: bytes) -> tuple:
    payload, http = body_of(block)
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if headers["warc-type"] == "revisit":
        return (headers["warc-record-id"], "revisit", headers.get("warc-target-uri"), headers.get("warc-refers-to"), digest,
                int(http["content-length"]), None)
    if digest != hashlib.sha1(payload).hexdigest():
        raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
    return headers["warc-record-id"], headers["warc-type"], headers.get("warc-target-uri"), None, digest, len(payload), payload


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]
    names = ["record_id", "record_type", "target_uri", "refers_to_id", "payload_digest", "payload_bytes", "payload"]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per response or revisit of all archives, payloads whole and checked against their digests.

    Records of one segment are decoded where they are read. Segments are grouped by the identifier of
    their origin, ordered by number and put together; their total length must be the announced one.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for k in range(batch.num_rows):
                whole, parts = [], []
                for headers, block in parse(_inflated(batch.column(0)[k].as_py())):
                    if "warc-segment-number" in headers:
                        total = headers.get("warc-segment-total-length")
                        parts.append((headers.get("warc-segment-origin-id", headers["warc-record-id"]), int(headers["warc-segment-number"]),
                                      total and int(total), None if "warc-segment-origin-id" in headers else "\r\n".join(f"{n}: {v}" for n, v in headers.items()), block))
                    else:
                        whole.append(_finished(headers, block))
                    if len(whole) + len(parts) >= 64:
                        yield _both(whole, parts, kinds)
                        whole, parts = [], []
                yield _both(whole, parts, kinds)

    def _both(whole: list[tuple], parts: list[tuple], kinds: list) -> pa.RecordBatch:
        empty = [(None,) * 7] * len(parts)
        left = _batch(whole + empty)
        right = [pa.array([None] * len(whole) + [p[c] for p in parts], kind) for c, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([*left.columns, *right], [*left.schema.names, "_origin", "_number", "_total", "_head", "_block"])

    # Stored once, as both the whole records and the segments are taken from it.
    records = stored(files.mapInArrow(run, f"{_READ}, _origin string, _number int, _total long, _head string, _block binary"), "records")
    grouped = records.filter("_origin IS NOT NULL").groupBy("_origin").agg(
        F.max("_total").alias("total"), F.max("_head").alias("head"), F.collect_list(F.struct("_number", "_block")).alias("segments"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                total, head, segments = (batch.column(c)[k].as_py() for c in (1, 2, 3))
                segments.sort(key=lambda s: s["_number"])
                block = b"".join(s["_block"] for s in segments)
                if head is None or [s["_number"] for s in segments] != [*range(1, len(segments) + 1)] or total != len(block):
                    raise ValueError(f"segments of {batch.column(0)[k]} are not complete")
                yield _batch([_finished(_headers(f"\r\n{head}".encode()), block)])

    whole = records.filter("_origin IS NULL").select(*[c.split()[0] for c in _READ.split(", ")])
    return whole.unionByName(grouped.select("_origin", "total", "head", "segments").mapInArrow(join, _READ))


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", segment: int = SEGMENT) -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to) as read back from freshly written archives."""
    spark = pages.sparkSession
    kind = pages.select(F.col(key)).schema[0].dataType.simpleString()
    folder = new_folder(spark, "archives")
    write(pages, folder, key, url, html, segment)

    def named(column: str) -> Column:
        return F.regexp_extract(column, r"^<urn:page:(.*):-?\d+>$", 1)

    own, to = named("record_id"), named("refers_to_id")
    return read(spark, folder).select(
        F.when(own != "None", own).cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type",
        F.when(to != "None", to).cast(kind).alias("refers_to"))
