"""WARC archives: writing captures as request, response (or revisit) and metadata records, reading archives back, and
assembling the records of a capture through their concurrent-to identifiers into one nested row.

Archives are written and read by Spark's own file sources, so they can lie in any store Spark reaches. A record's
header and payload are text in UTF-8; one file is a gzip stream of whole records.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm.common import stage

#: Payloads shorter than this are never deduplicated.
MIN_REVISIT = 100
_CRLF = "\r\n"


def _uuid(*parts: Column | str) -> Column:
    """A record id made of what it identifies: a retried task writes the same one."""
    h = F.md5(F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("?")) for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4)) for x in (h.substr(a, n), F.lit("-"))], h.substr(21, 12), F.lit(">"))


def _header(fields: list[tuple[str, Column | str | None]]) -> Column:
    """Header lines; those with a null value are left out. Line breaks in values become spaces."""
    rows = [F.concat(F.lit(f"{k}: "), F.lit(v) if isinstance(v, str) else F.regexp_replace(v, "[\r\n]+", " "), F.lit(_CRLF)) for k, v in fields]
    return F.concat(F.lit("WARC/1.1" + _CRLF), *[F.coalesce(r, F.lit("")) for r in rows], F.lit(_CRLF))


def captures(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """One row per page row: page_id, url, html, n (bytes), digest, capture (names equal rows), copy (numbers them), first
    (the capture and page that this one revisits; null for a response).

    Of rows with equal payloads of enough bytes one is the response: that with the smallest page_id (null ones last),
    then the smallest capture, then copy 0. Only digests are grouped and joined, never payloads by digest: a payload
    that a third of the pages share makes a hot digest. Its minimum is combined before the shuffle, and the join back
    on digests reads staged tables, so adaptive execution splits the hot key. Payloads are then shuffled once, by
    capture; equal rows are counted before that shuffle and numbered after it.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    signed = pages.select("page_id", "url", "html", F.octet_length(body).cast("long").alias("n"), F.sha2(body, 256).alias("digest"))
    signed = signed.withColumn("capture", F.md5(F.to_json(F.struct("page_id", "digest", "url", F.col("html").isNull().alias("none")))))
    slim = stage(spark, signed.where(F.col("n") >= MIN_REVISIT).select("capture", "page_id", F.unhex("digest").alias("key")), "warc-digests")
    least = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "capture"))
    first = stage(spark, slim.groupBy("key").agg(least.alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies"), "warc-first")
    later = slim.join(first, "key").select("capture", F.struct("first.capture", "first.page_id").alias("first")).distinct()
    rows = signed.groupBy("capture", "page_id", "url", "n", "digest").agg(F.first("html").alias("html"), F.count("*").alias("copies")).join(later, "capture", "left")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies")
    return rows.withColumn("first", F.when((F.col("first.capture") != F.col("capture")) | (F.col("copy") > 0), F.col("first")))


def write(spark: SparkSession, pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", bytes_per_file: int = 64 << 20) -> None:
    """Write pages (page_id, url, html; further columns are not read) as archives below path.

    One request, one response or revisit and one metadata record per row; equal rows have records of their own. Null
    html is an empty payload; null urls and page ids are left out of the records. A revisit names the record it refers
    to. bytes_per_file is what an archive has of payload on average, before compression.
    """
    rows = captures(spark, pages)
    size = pages.agg(F.avg(F.coalesce(F.octet_length("html"), F.lit(0)))).first()[0] or 0
    response, request, meta = (_uuid(kind, F.col("capture"), F.col("copy")) for kind in ("response", "request", "metadata"))
    body = F.coalesce(F.col("html"), F.lit(""))
    revisit = F.col("first").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "), F.col("n").cast("string"), F.lit(_CRLF * 2))
    main_block = F.when(revisit, http).otherwise(F.concat(http, body))
    get = F.concat(F.lit("GET "), F.coalesce(F.regexp_replace("url", r"\s", "%20"), F.lit("/")), F.lit(f" HTTP/1.1{_CRLF * 2}"))
    facts = F.concat(F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(_CRLF)), F.lit("")), F.lit("source: crawl" + _CRLF))

    def record(kind: Column | str, own: Column, block: Column, content: str, more: list) -> Column:
        return F.concat(_header([("WARC-Type", kind), ("WARC-Record-ID", own), *more, ("WARC-Target-URI", F.col("url")), ("WARC-Date", date), ("Content-Type", content), ("Content-Length", F.octet_length(block).cast("string"))]), block)

    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    profile = ("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))
    refers = ("WARC-Refers-To", F.when(revisit, _uuid("response", F.col("first.capture"), F.lit(0).cast("long"))))
    records = F.array(
        record("request", request, get, "application/http;msgtype=request", [("WARC-Concurrent-To", response)]),
        record(F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), response, main_block, "application/http;msgtype=response", [digest, profile, refers]),
        record("metadata", meta, facts, "application/warc-fields", [("WARC-Concurrent-To", response)]),
    )
    out = rows.select(F.explode(records).alias("value"))
    out.write.option("lineSep", _CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", 3 * max(1, int(bytes_per_file / (size + 500)))).text(path)


class _Records:
    """Splits a stream of bytes into records by their Content-Length; holds one record at a time."""

    def __init__(self) -> None:
        self.rest = bytearray()

    def feed(self, data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        self.rest += data
        at = 0
        while True:
            while self.rest[at : at + 2] == b"\r\n":  # blank lines between records
                at += 2
            if (end := self.rest.find(b"\r\n\r\n", at)) < 0:
                break
            lines = bytes(self.rest[at:end]).decode("utf-8", "replace").split(_CRLF)
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            stop = end + 4 + int(fields.get("content-length", 0))
            if not lines[0].startswith("WARC/") or len(self.rest) < stop:
                if not lines[0].startswith("WARC/"):
                    raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
                break
            yield fields, bytes(self.rest[end + 4 : stop])
            at = stop
        del self.rest[:at]

    def close(self, name: str | None) -> None:
        """Call at the end of an archive: what is left over is a record cut off."""
        if self.rest.strip():
            raise ValueError(f"{name} ends within a record")


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of all archives below path, plain or gzip (one member or many).

    Columns: type, record_id, concurrent_to, refers_to, target_uri, date, declared_digest, http_length, payload_bytes
    and payload_digest (of what was read; null where the record has no payload of its own), facts (the block of a
    metadata record as a map), and payload, if asked for. Fields that a record lacks are null; repeated records are
    rows like any other; no archive gives no rows. An archive that ends within a record raises.

    Files named .gz are streamed through Spark's text source, cut at blank lines and put together again: a task holds
    one record, however large the archive. Others are read as one piece each.
    """
    schema = "type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, declared_digest string, http_length bigint, payload_bytes bigint, payload_digest string, facts map<string,string>" + ", payload binary" * payload
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.string()] * 7 + [pa.int64()] * 2 + [pa.string(), pa.map_(pa.string(), pa.string())] + [pa.binary()] * payload

    def parsed(fields: dict[str, str], block: bytes) -> tuple:
        kind = fields.get("warc-type")
        body, length, facts, digest = None, None, None, None
        if kind in ("response", "revisit"):
            head, _, body = block.partition(b"\r\n\r\n")
            m = re.search(rb"(?im)^content-length:\s*(\d+)", head)
            length = int(m[1]) if m else None
            if kind == "revisit":
                body = None
            else:
                digest = hashlib.sha256(body).hexdigest()
        elif kind == "metadata":
            facts = [(k.strip(), v.strip()) for k, s, v in (x.partition(":") for x in block.decode("utf-8", "replace").split(_CRLF)) if s]
        row = (kind, *(fields.get(k) for k in ("warc-record-id", "warc-concurrent-to", "warc-refers-to", "warc-target-uri", "warc-date", "warc-payload-digest")), length, None if body is None else len(body), digest, facts)
        return (*row, body) if payload else row

    def rows_of(pieces: Iterator[tuple[str, bytes]]) -> Iterator[pa.RecordBatch]:
        """pieces: name of the archive and bytes of it, in order."""
        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        rows, held, records, current = [], 0, _Records(), None
        for name, data in pieces:
            if name != current:
                records.close(current)
                current, records = name, _Records()
            for fields, block in records.feed(data):
                rows.append(parsed(fields, block))
                held += len(block) if payload else 0
                if len(rows) >= 4096 or held > 4 << 20:
                    yield out(rows)
                    rows, held = [], 0
        records.close(current)
        if rows:
            yield out(rows)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                view = memoryview(content.as_buffer())
                packed = bytes(view[:2]) == b"\x1f\x8b"
                inflate = zlib.decompressobj(31)
                for at in range(0, len(view), 1 << 18):
                    data = bytes(view[at : at + (1 << 18)])
                    while data:
                        if packed:
                            plain = inflate.decompress(data, 1 << 20)
                            data = inflate.unconsumed_tail
                            if inflate.eof:
                                data, inflate = inflate.unused_data, zlib.decompressobj(31)
                        else:
                            plain, data = data, b""
                        yield name, plain

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        for b in batches:
            for name, piece in zip(b.column(0).to_pylist(), b.column(1)):
                yield name, piece.as_buffer().to_pybytes() + b"\r\n\r\n"

    name = F.col("_metadata.file_path")
    text = spark.read.option("lineSep", _CRLF * 2).option("pathGlobFilter", "*.gz").text(path).select(name, F.col("value").cast("binary"))
    binary = spark.read.format("binaryFile").option("pathGlobFilter", "{*[!z],*[!g]z}").load(path).select(name, "content")
    return text.mapInArrow(lambda b: rows_of(streamed(b)), schema).union(binary.mapInArrow(lambda b: rows_of(whole(b)), schema))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the records that are concurrent to the same response (or revisit), with it.

    Columns: capture_id, request, main (the response or revisit), metadata: each a struct of the record's columns, or
    null where the archive has no such record. Of records repeated with their id, one stays; records with neither id are
    one capture; other kinds of record (warcinfo) are captures with no main record.
    """
    own = F.struct(*[F.col(c) for c in records.columns])
    pick = lambda *kinds: F.first(F.when(F.col("type").isin(*kinds), own), ignorenulls=True)
    key = F.when(F.col("type").isin("response", "revisit"), F.col("record_id")).otherwise(F.coalesce("concurrent_to", "record_id"))
    return records.groupBy(key.alias("capture_id")).agg(pick("request").alias("request"), pick("response", "revisit").alias("main"), pick("metadata").alias("metadata"))


def with_referred(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Adds refers_to: the page_id of the record that a revisit names. pages: page_id, record_id, refers_to_record and further columns.

    Only revisits are joined; a record that a third of the pages revisit is a hot key of that join, whose sides are read
    from a staged table, so adaptive execution splits it. A revisit of a record that is not there has a null.
    """
    own = stage(spark, pages, "warc-pages")
    target = own.where("refers_to_record IS NULL AND record_id IS NOT NULL").select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"))
    found = own.where("refers_to_record IS NOT NULL").join(target, "refers_to_record", "left").select(*own.columns, "refers_to")
    return found.union(own.where("refers_to_record IS NULL").withColumn("refers_to", F.lit(None).cast(own.schema["page_id"].dataType)))
