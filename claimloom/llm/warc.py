"""Web archives: pages are written as WARC records and read back as one nested row per capture.

``write_pages`` writes a request, a response or revisit, and a metadata record per page, in this order. The
records are plain WARC/1.1 text, so Spark's text sink writes them, with the end of a record as its line
separator; a file is one gzip stream or, with ``compression="none"``, plain. Of pages with equal payloads of
at least ``least`` bytes, told apart by SHA-256, the one with the largest page_id carries the payload, the
others are revisits that refer to it. Each payload is shuffled once, whatever the number of its pages.

``read_records`` reads archives of any writer (plain, one gzip stream, or one gzip member per record).
A file is read by one task. ``assemble`` joins what belongs to a capture, which is a response or revisit
with the requests and metadata records that are concurrent to it: they name the capture in WARC-Concurrent-To,
or the capture names them. ``resolve_revisits`` looks up the capture that a revisit refers to.

Null and empty html is an empty payload. A null page_id is the smallest one and has no field in the metadata
record. Repeated rows are captures of their own: copies are numbered, and the last copy of the largest
(page_id, url) carries the payload; a null url comes first. An empty table gives an archive without records.
White space in a URL is written percent-encoded. Extra columns are ignored. A file that is not a sequence of
whole records raises ValueError.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import pa_schema
from claimloom.session import stored, work_path

CRLF = "\r\n"
END = CRLF * 2
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PER_BLOCK = 4096
RECORDS = (
    "path string, place bigint, record_id string, type string, uri string, date string, concurrent_to array<string>, "
    "refers_to string, payload_digest string, start_line string, fields map<string,string>, payload_bytes bigint, payload_sha1 string, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a text or binary column in upper-case base32: 20 bits, so 5 hex digits, are 4 letters."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), HEX32, BASE32)


def record_id(*parts: Column) -> Column:
    """A name-based identifier."""
    named = F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("v"), p.cast("string")), F.lit("n")) for p in parts])
    return F.regexp_replace(F.md5(named), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def warc_record(kind: str | Column, name: Column, block: Column, content_type: str, date: str, **headers: Column) -> Column:
    """A record as text, without the end that separates records; headers that are null are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    fields = {"WARC-Type": kind, "WARC-Record-ID": name, "WARC-Date": F.lit(date), **{k.replace("_", "-"): v for k, v in headers.items()}}
    fields |= {"Content-Type": F.lit(content_type), "Content-Length": F.octet_length(block).cast("string")}
    lines = [F.concat(F.lit(f"{k}: "), v) for k, v in fields.items()]
    return F.concat(F.concat_ws(CRLF, F.lit("WARC/1.1"), *lines), F.lit(END), block)


def page_captures(pages: DataFrame, least: int = 0) -> DataFrame:
    """A row per page with its payload's digests, its copy number, and the page that carries the payload.

    Pages alike in all columns are counted, not collected, and numbered in blocks.
    """
    html = F.coalesce("html", F.lit(""))
    known = pages.select(
        "page_id",
        "url",
        F.sha2(html, 256).alias("sha256"),
        base32_sha1(html).alias("sha1"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        F.when(F.octet_length(html) < least, html).alias("short"),
    )
    groups = stored(known.groupBy(*known.columns).agg(F.count("*").alias("n")), "warc-groups")
    heads = groups.where(F.col("short").isNull()).groupBy("sha256").agg(F.max(F.struct("page_id", "url", "n")).alias("head"))
    blocks = groups.join(heads, "sha256", "left").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / PER_BLOCK))))
    first = F.col("block") * PER_BLOCK + 1
    dealt = blocks.repartition("page_id", "url", "sha256", "block")
    copies = dealt.withColumn("copy", F.explode(F.sequence(first, F.least(F.col("n"), first + PER_BLOCK - 1))))
    carries = F.col("head").isNull() | F.struct("page_id", "url", F.col("copy").alias("n")).eqNullSafe(F.col("head"))
    return copies.withColumn("carries", carries).drop("block", "n")


def write_pages(pages: DataFrame, path: str, least: int = 0, date: str = "2024-01-01T00:00:00Z", compression: str = "gzip", records_per_file: int = 20_000) -> None:
    """Write the archives of a table of pages (page_id, url, html) to a folder."""
    captures = stored(page_captures(pages, least), "warc-captures")
    html = F.coalesce("html", F.lit(""))
    payloads = pages.where(F.octet_length(html) >= least).groupBy(F.sha2(html, 256).alias("sha256")).agg(F.first(html).alias("payload"))
    whole = F.col("carries") & F.col("head").isNotNull()
    rows = captures.where(whole).join(payloads, "sha256").unionByName(captures.where(~whole).withColumn("payload", F.col("short")))

    uri = F.col("url")
    for mark in "\t\n\r ":
        uri = F.replace(uri, F.lit(mark), F.lit(f"%{ord(mark):02X}"))
    named = rows.withColumns(
        {
            "uri": uri,
            "name": record_id(F.lit("capture"), F.col("page_id"), F.col("url"), F.col("sha256"), F.col("copy")),
            "refers": record_id(F.lit("capture"), F.col("head.page_id"), F.col("head.url"), F.col("sha256"), F.col("head.n")),
        }
    )
    host = F.regexp_extract("uri", "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    target = F.regexp_extract("uri", "^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^#]*)", 1)
    asked = F.concat(F.lit("GET "), F.when(target.startswith("/"), target).otherwise(F.concat(F.lit("/"), F.coalesce(target, F.lit("")))), F.lit(" HTTP/1.1\r\nHost: "), F.coalesce(host, F.lit("")), F.lit(END))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    page = F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit(""))
    concurrent = {"WARC_Target_URI": F.col("uri"), "WARC_Concurrent_To": F.col("name")}
    revisit = ~F.col("carries")
    answered = warc_record(
        F.when(revisit, "revisit").otherwise("response"),
        F.col("name"),
        F.when(revisit, head).otherwise(F.concat(head, F.coalesce("payload", F.lit("")))),
        "application/http;msgtype=response",
        date,
        WARC_Target_URI=F.col("uri"),
        WARC_Payload_Digest=F.concat(F.lit("sha1:"), F.col("sha1")),
        WARC_Profile=F.when(revisit, F.lit(PROFILE)),
        WARC_Refers_To=F.when(revisit, F.col("refers")),
    )
    request = warc_record("request", record_id(F.lit("request"), F.col("name")), asked, "application/http;msgtype=request", date, **concurrent)
    metadata = warc_record("metadata", record_id(F.lit("metadata"), F.col("name")), page, "application/warc-fields", date, **concurrent)
    records = named.select(F.explode(F.array(request, answered, metadata)).alias("value"))
    records.write.option("lineSep", END).option("compression", compression).option("maxRecordsPerFile", records_per_file).text(path)


def inflated(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of a plain or gzip file with any number of members, piece by piece."""
    view = memoryview(content)
    if content[:2] != b"\x1f\x8b":
        yield from (bytes(view[k : k + step]) for k in range(0, len(view), step))
        return
    place = 0
    while place < len(view):
        member = zlib.decompressobj(zlib.MAX_WBITS | 16)
        while not member.eof:
            if place >= len(view):
                raise ValueError("the gzip stream ends early")
            # what is left over of the input is read again
            yield member.decompress(view[place : place + step])
            place = min(place + step, len(view)) - len(member.unused_data)


def raw_records(content: bytes) -> Iterator[tuple[int, dict[str, list[str]], bytes]]:
    """(place, headers, block) of each record of a file; places count the bytes of the plain stream."""
    pieces, have, place = inflated(content), bytearray(), 0

    def more() -> bool:
        piece = next(filter(None, pieces), b"")
        have.extend(piece)
        return bool(piece)

    while True:
        while (have or more()) and have[0] in b"\r\n":
            del have[0]
            place += 1
        if not have:
            return
        while (end := have.find(b"\r\n\r\n")) < 0:
            if not more():
                raise ValueError(f"the record at {place} has no end of headers")
        version, *lines = have[:end].decode("utf-8", "replace").split(CRLF)
        headers: dict[str, list[str]] = {}
        for line in lines:
            name, _, value = line.partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        if not version.startswith("WARC/") or "content-length" not in headers:
            raise ValueError(f"no record at {place}")
        until = end + 4 + int(headers["content-length"][0])
        while len(have) < until:
            if not more():
                raise ValueError(f"the record at {place} ends early")
        yield place, headers, bytes(memoryview(have)[end + 4 : until])
        del have[:until]
        place += until


def parsed(headers: dict[str, list[str]], block: bytes, payloads: bool) -> dict:
    """The columns of a record behind its path and place."""
    one = {k: v[0] for k, v in headers.items()}
    kind, payload, start, fields = one.get("warc-type"), block, None, {}
    content_type = one.get("content-type", "").lower()
    lines: list[str] = []
    if content_type.startswith("application/http"):
        top, _, payload = block.partition(b"\r\n\r\n")
        start, *lines = top.decode("utf-8", "replace").split(CRLF)
    elif content_type.startswith("application/warc-fields"):
        lines, payload = block.decode("utf-8", "replace").split(CRLF), b""
    for line in lines:
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    digest = one.get("warc-payload-digest")
    return {
        "record_id": one.get("warc-record-id"),
        "type": kind,
        "uri": one.get("warc-target-uri"),
        "date": one.get("warc-date"),
        "concurrent_to": headers.get("warc-concurrent-to", []),
        "refers_to": one.get("warc-refers-to"),
        "payload_digest": digest.removeprefix("sha1:") if digest else None,
        "start_line": start,
        "fields": list(fields.items()),
        "payload_bytes": len(payload),
        "payload_sha1": base64.b32encode(hashlib.sha1(payload).digest()).decode(),
        "payload": payload if payloads else None,
    }


def read_records(spark: SparkSession, path: str, payloads: bool = True, size: int = 4 << 20) -> DataFrame:
    """A row per record of the archives below a folder; without ``payloads`` that column is null."""
    kinds = pa_schema(spark, RECORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                where = batch.column(0)[k].as_py()
                try:
                    for place, headers, block in raw_records(batch.column(1)[k].as_py()):
                        rows.append({"path": where, "place": place} | parsed(headers, block, payloads))
                        held += 1000 + (len(block) if payloads else 0)
                        if held > size:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                            rows, held = [], 0
                except ValueError as error:
                    raise ValueError(f"{where}: {error}") from error
        yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(run, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit with its requests and metadata records.

    What is concurrent to a capture is one cell of it, so it has to fit in a row. Records that are concurrent
    to no capture are left out.
    """
    captures = records.where(F.col("type").isin("response", "revisit"))
    others = records.where(F.col("type").isin("request", "metadata"))
    part = F.struct("record_id", "start_line", "fields").alias("part")
    naming = others.select(F.explode("concurrent_to").alias("capture_id"), "record_id", "type", part)
    named = captures.select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("record_id"))
    links = naming.unionByName(named.join(others.select("record_id", "type", part), "record_id"))

    def parts(kind: str) -> Column:
        # a link may be told from both sides; maps cannot be compared, so sort by the id
        cells = F.collect_list(F.when(F.col("type") == kind, F.col("part")))
        return F.array_sort(cells, lambda a, b: F.when(a.record_id < b.record_id, -1).when(a.record_id > b.record_id, 1).otherwise(0))

    joined = links.dropDuplicates(["capture_id", "record_id"]).groupBy("capture_id").agg(parts("request").alias("requests"), parts("metadata").alias("metadata"))
    answers = captures.select(
        F.col("record_id").alias("capture_id"),
        F.col("type").alias("record_type"),
        "uri",
        "date",
        "refers_to",
        F.struct("start_line", "fields", "payload_digest", "payload_bytes", "payload_sha1", "payload").alias("response"),
    )
    return answers.join(joined, "capture_id", "left")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to, a page_id, of every capture.

    The size and digest of a payload are measured where it stands: at the capture that a revisit refers to.
    """
    page = F.element_at(F.element_at("metadata", 1)["fields"], "page-id").cast("long")
    slim = stored(
        captures.select(
            "capture_id",
            "record_type",
            "refers_to",
            F.when(F.size("metadata") > 0, page).alias("page_id"),
            F.col("response.payload_bytes").alias("payload_bytes"),
            F.col("response.payload_sha1").alias("payload_digest"),
        ),
        "warc-read",
    )
    heads = slim.where("record_type = 'response'").select(F.col("capture_id").alias("refers_to"), F.struct("page_id", "payload_bytes", "payload_digest").alias("head"))
    responses = slim.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    revisits = slim.where("record_type = 'revisit'").join(heads, "refers_to", "left")
    return responses.unionByName(revisits.select("page_id", "head.payload_bytes", "head.payload_digest", "record_type", F.col("head.page_id").alias("refers_to")))


def archive_pages(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write the archives of some pages to the shared folder, read them, and say what each capture is."""
    path = work_path(pages.sparkSession, "warc")
    write_pages(pages, path, least)
    records = stored(read_records(pages.sparkSession, path, payloads=False), "warc-records")
    return resolve_revisits(assemble(records))
