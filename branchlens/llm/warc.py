"""WARC archives: records with chunked bodies, segments and revisits, written and read back.

Writing. Every page is one record: a *response* with an HTTP head and its payload in chunked
transfer framing, or, where an equal payload of at least ``MIN_REVISIT`` bytes is stored
under a smaller page id, a *revisit* that names that response. A block longer than
``SEGMENT`` bytes is cut: the first piece stays in the response (segment 1), the others are
*continuation* records with the origin's record id and their segment number, the last one
with the total length. Pieces may end inside a character or a chunk head. A record is built
by built-in functions as one value, Spark's text writer puts it into gzip files with the
four bytes that end a record as line separator.

Reading. Spark's text reader cuts an archive at ``WARC/1.`` and streams the pieces of a file
in order; a piece that is shorter than its record's Content-Length was cut inside the block
(or in a head) and is joined with the next ones, so the literal may occur anywhere.

Segment reassembly. Segments are grouped by the identifier of their origin (a shuffle),
ordered by segment number and joined; numbers must run from 1 without a gap and the bytes
must equal the total length. Then the HTTP head is taken off, the chunks are decoded and
the SHA-256 of the payload is compared with the record's digest. Revisits are joined to
their responses by record id. What fails is not dropped: its ``fault`` says why (cut short,
segments, length, chunks, digest, no response).

Scale: no page is shuffled to be written; only digests and ids are counted, and the digests
that occur more than once are written before pages are joined to them. A task holds one
record. With ``payloads=False`` only the blocks of segmented records are shuffled.

Edge cases: null html is an empty payload, null urls and ids are left out of the record and
come back as null; a null page id is larger than all others; of rows that agree in page id
and payload one is the response (the smallest url, nulls last; equal rows are told apart by
counting them); empty tables write no records and read back as no rows; other columns are
not looked at. Archives of other writers: gzip of one or many members, WARC 1.0 and 1.1;
where an uncompressed file is larger than a read split, its blocks must not hold ``WARC/1.``.
"""

from __future__ import annotations

import datetime as dt
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .tables import bound_batches, materialise

SEGMENT = 16 << 10
CHUNK = 4 << 10
MIN_REVISIT = 100
HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSION = "WARC/1."
_BATCH_BYTES = 4 << 20


def _record_id(*parts: Column | str) -> Column:
    """A name-based identifier in the form of a UUID."""
    named = F.md5(F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(named, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def _kinds(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, size, kind): a response or a revisit for each page."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).select(
        "page_id", "url", "payload", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("size"))
    place = F.struct(F.isnull("page_id"), "page_id", F.isnull("url"), "url", "n")
    firsts = materialise(
        rows.where(F.col("size") >= MIN_REVISIT).groupBy("digest", "page_id", "url").agg(F.count("*").alias("n"))
        .groupBy("digest").agg(F.min(place).alias("first"), F.sum("n").alias("total")).where("total > 1")
        .select(F.col("digest").alias("_digest"), F.col("first.page_id").alias("_page"), F.col("first.url").alias("_url"),
                F.col("first.n").alias("_n")), "warc-firsts")
    joined = rows.join(firsts, rows["digest"] == firsts["_digest"], "left")
    first = F.col("page_id").eqNullSafe(F.col("_page")) & F.col("url").eqNullSafe(F.col("_url"))
    kind = F.when(F.isnull("_digest"), "response").when(~first, "revisit").when(F.col("_n") == 1, "response")
    columns = ["page_id", "url", "payload", "digest", "size"]
    told = joined.select(*columns, kind.alias("kind"))
    # Equal rows, of which one is the response: counted, then written out again.
    alike = (told.where("kind IS NULL").groupBy("digest", "page_id", "url", "size")
             .agg(F.any_value("payload").alias("payload"), F.count("*").alias("n"))
             .select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
             .select(*columns, F.when(F.col("copy") == 1, "response").otherwise("revisit").alias("kind")))
    return told.where("kind IS NOT NULL").unionByName(alike)


def records(pages: DataFrame, captured: str, segment: int = SEGMENT, chunk: int = CHUNK) -> DataFrame:
    """(record): every WARC record of the pages without the four bytes that end it."""
    rows = _kinds(pages).withColumn("row", F.monotonically_increasing_id())
    shared = F.col("size") >= MIN_REVISIT  # at most one response has that digest
    response_id = _record_id("response", F.col("digest"))
    own = F.when((F.col("kind") == "response") & shared, response_id).otherwise(
        _record_id("page", F.col("digest"), F.col("row")))
    chunks = F.transform(
        F.when(F.col("size") > 0, F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / chunk))).otherwise(
            F.array().cast("array<bigint>")),
        lambda i: F.concat(F.lower(F.hex(F.least(F.lit(chunk).cast("long"), F.col("size") - i * chunk))), F.lit("\r\n"),
                           F.substring("payload", (i * chunk + 1).cast("int"), F.lit(chunk)).cast("string"), F.lit("\r\n")))
    block = F.when(F.col("kind") == "response", F.concat(F.lit(HEAD), F.array_join(chunks, ""), F.lit("0\r\n\r\n"))) \
        .otherwise(F.lit(HEAD)).cast("binary")
    whole = rows.select("page_id", "url", "digest", "kind", own.alias("own"), response_id.alias("response"),
                        block.alias("block")).withColumn("total", F.octet_length("block"))
    pieces = F.greatest(F.lit(1), F.ceil(F.col("total") / segment)).cast("int")
    cut = whole.withColumn("pieces", pieces).select("*", F.explode(F.sequence(F.lit(1), F.col("pieces"))).alias("number"))
    cut = cut.withColumn("body", F.substring("block", (F.col("number") - 1) * segment + 1, F.lit(segment)))
    origin, split = F.col("number") == 1, F.col("pieces") > 1

    def line(name: str, value: Column, present: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
        return F.coalesce(text if present is None else F.when(present, text), F.lit(""))

    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    head = F.concat(
        F.lit(f"{_VERSION}1\r\n"),
        line("WARC-Type", F.when(origin, F.col("kind")).otherwise("continuation")),
        line("WARC-Record-ID", F.when(origin, F.col("own")).otherwise(
            _record_id("segment", F.col("own"), F.col("number")))),
        line("WARC-Date", F.lit(captured)), line("WARC-Target-URI", url), line("Page-ID", F.col("page_id"), origin),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest"), origin),
        line("WARC-Refers-To", F.col("response"), F.col("kind") == "revisit"),
        line("WARC-Profile", F.lit(PROFILE), F.col("kind") == "revisit"),
        line("WARC-Segment-Number", F.col("number"), split), line("WARC-Segment-Origin-ID", F.col("own"), ~origin),
        line("WARC-Segment-Total-Length", F.col("total"), split & (F.col("number") == F.col("pieces"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("body")), F.lit("\r\n"))
    return cut.select(F.concat(head, F.col("body").cast("string")).alias("record"))


def write_archives(pages: DataFrame, path: str, captured: str | None = None, segment: int = SEGMENT,
                   chunk: int = CHUNK) -> None:
    """Write the pages' records as gzip WARC files under ``path``."""
    captured = captured or f"{dt.datetime.now(dt.timezone.utc):%Y-%m-%dT%H:%M:%SZ}"
    records(pages, captured, segment, chunk).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


_FIELDS = [("record_id", "string"), ("type", "string"), ("page_id", "bigint"), ("refers", "string"), ("origin", "string"),
           ("number", "int"), ("total", "bigint"), ("digest", "string"), ("block", "binary"), ("size", "bigint"),
           ("found_digest", "string"), ("fault", "string")]
_DDL = ", ".join(f"{n} {t}" for n, t in _FIELDS)
_ARROW = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[t])
                    for n, t in _FIELDS])


def _batches(rows):
    """Arrow batches of bounded bytes from dictionaries."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r["block"] or b"") + 300
        if size >= _BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)


class _Record:
    """One record while its bytes arrive, from behind the version prefix on."""

    def __init__(self, piece: bytes):
        self.parts, self.size, self.need, self.fields = [], 0, None, {}
        self.add(piece)

    def add(self, piece: bytes) -> None:
        self.parts.append(piece)
        self.size += len(piece)
        if self.need is None:
            joined = b"".join(self.parts)
            self.parts = [joined]
            end = joined.find(b"\r\n\r\n")
            if end >= 0:
                for line in joined[:end].split(b"\r\n")[1:]:
                    name, _, value = line.partition(b":")
                    self.fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
                self.need = end + 4 + int(self.fields.get("content-length", "0"))
                self.start = end + 4

    @property
    def whole(self) -> bool:
        return self.need is not None and self.size >= self.need

    def row(self) -> dict:
        get = self.fields.get
        number, page, total = get("warc-segment-number"), get("page-id"), get("warc-segment-total-length")
        digest = get("warc-payload-digest", "")
        return {"record_id": get("warc-record-id"), "type": get("warc-type"), "page_id": int(page) if page else None,
                "refers": get("warc-refers-to"), "number": int(number) if number else None,
                "origin": (get("warc-segment-origin-id") or get("warc-record-id")) if number else None,
                "total": int(total) if total else None,
                "digest": digest.removeprefix("sha256:") if digest.startswith("sha256:") else None,
                "block": b"".join(self.parts)[self.start: self.need] if self.whole else None, "size": None,
                "found_digest": None, "fault": None if self.whole else "cut short"}


def _parsed(batches):
    """Rows of all records from (file, bytes between two version prefixes), in file order."""
    file, record = None, None
    for b in batches:
        for name, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if name != file:
                if record is not None:
                    yield record.row()
                file, record = name, None
                continue  # what stands before the first version prefix
            if record is None:
                record = _Record(piece)
            else:
                record.add(_VERSION.encode() + piece)
            if record.whole:
                yield record.row()
                record = None
    if record is not None:
        yield record.row()


def unchunked(body: bytes) -> bytes | None:
    """The bytes inside chunked transfer framing; None where the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].partition(b";")[0], 16)
        except ValueError:
            return None
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if size < 0 or body[at + size: at + size + 2] != b"\r\n":
            return None
        parts.append(body[at: at + size])
        at += size + 2


def _payload(block: bytes) -> bytes | None:
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None
    chunked = any(x.partition(b":")[0].strip().lower() == b"transfer-encoding" and b"chunked" in x.lower()
                  for x in head.split(b"\r\n")[1:])
    return unchunked(body) if chunked else body


def _decoded(row: dict, payloads: bool) -> dict:
    """A whole response's row with its payload (in ``block``), its size and digest."""
    if row["type"] != "response" or row["fault"]:
        return {**row, "block": None}
    payload = _payload(row["block"])
    if payload is None:
        return {**row, "block": None, "fault": "chunks"}
    found = hashlib.sha256(payload).hexdigest()
    return {**row, "block": payload if payloads else None, "size": len(payload), "found_digest": found,
            "fault": "digest" if row["digest"] not in (None, found) else None}


def _joined(pieces: list[dict], payloads: bool) -> dict:
    """One record from the segments that name the same origin, in order."""
    head = pieces[0]
    if any(p["fault"] for p in pieces):
        return {**head, "block": None, "fault": next(p["fault"] for p in pieces if p["fault"])}
    if [p["number"] for p in pieces] != list(range(1, len(pieces) + 1)) or pieces[-1]["total"] is None:
        return {**head, "block": None, "fault": "segments"}
    block = b"".join(p["block"] for p in pieces)
    if len(block) != pieces[-1]["total"]:
        return {**head, "block": None, "fault": "length"}
    return _decoded({**head, "block": block}, payloads)


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records under ``path``, reassembled and decoded: ``block`` is the payload."""
    bound_batches(spark)
    pieces = (spark.read.option("lineSep", _VERSION).text(path)
              .select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece")))

    def parse(batches):
        return _batches(r if r["number"] is not None else _decoded(r, payloads) for r in _parsed(batches))

    def assemble(batches):
        def rows():
            held = []
            for b in batches:
                for r in b.to_pylist():
                    if held and r["origin"] != held[0]["origin"]:
                        yield _joined(held, payloads)
                        held = []
                    if r["origin"] is None:
                        yield r
                    else:
                        held.append(r)
            if held:
                yield _joined(held, payloads)
        return _batches(rows())

    # Whole records have no origin; they are dealt by their own id.
    return (pieces.mapInArrow(parse, _DDL).repartition(F.coalesce("origin", "record_id"))
            .sortWithinPartitions("origin", "number").mapInArrow(assemble, _DDL))


def read_pages(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per page: page_id, payload (null without ``payloads``), payload_bytes,
    payload_digest, record_type, refers_to, fault. Revisits have their response's payload."""
    found = materialise(read_records(spark, path, payloads), "warc-records")
    responses = found.where("type = 'response'")
    revisits = found.where("type = 'revisit'").select(
        F.col("page_id").alias("page"), "refers", F.col("digest").alias("named"), F.col("fault").alias("broken"))
    source = responses.select("record_id", "page_id", "block", "size", "found_digest", "fault")
    joined = revisits.join(source, F.col("refers") == F.col("record_id"), "left")
    fault = F.coalesce("broken", F.when(F.isnull("record_id"), "no response"), "fault",
                       F.when(F.col("named") != F.col("found_digest"), "digest"))
    return responses.select(
        "page_id", F.col("block").alias("payload"), F.col("size").alias("payload_bytes"),
        F.col("found_digest").alias("payload_digest"), F.lit("response").alias("record_type"),
        F.lit(None).cast("bigint").alias("refers_to"), "fault").unionByName(joined.select(
            F.col("page").alias("page_id"), F.col("block").alias("payload"), F.col("size").alias("payload_bytes"),
            F.coalesce("named", "found_digest").alias("payload_digest"), F.lit("revisit").alias("record_type"),
            F.col("page_id").alias("refers_to"), fault.alias("fault")))
