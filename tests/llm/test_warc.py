import gzip
import hashlib
import random

from branchlens.llm import warc as W
from branchlens.llm.queries import op11_warc
from branchlens.llm.tables import table
from branchlens.session import scratch_path

COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
DATE = "2020-01-02T03:04:05Z"


def brute(rows):
    """rows: (page_id, html)."""
    out, seen = [], {}
    for i, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        body = (html or "").encode()
        again = len(body) >= 100 and body in seen
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response",
                    seen[body] if again else None))
        seen.setdefault(body, i)
    return sorted(out, key=str)


def folder(spark):
    return f"{scratch_path(spark, 'warc-test')}/files"


def back(spark, path):
    rows = W.read_pages(spark, path).collect()
    assert all(r.fault is None for r in rows)
    return rows


def digest_rows(rows):
    return sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=str)


def pages(spark, rows):
    return spark.createDataFrame([(i, f"http://e.org/{n % 3}", h, "x", 5) for n, (i, h) in enumerate(rows)],
                                 "page_id long, url string, html string, kind string, size int")


def test_round_trip_of_any_text(spark):
    """Payloads that hold versions, empty lines, parts of versions and long characters."""
    rng = random.Random(3)
    bits = ["WARC/1.", "WARC/1.1\r\n", "\r\n\r\n", "WWARC/1.0", "0\r\n\r\n", "é", "漢字", "\U0001f600", "x", "\x00", "WARC/", "\r"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 400)))) for i in range(80)]
    path = folder(spark)
    W.write_archives(pages(spark, rows), path, DATE, segment=333, chunk=50)
    got = back(spark, path)
    assert digest_rows(got) == brute(rows)
    assert sorted((r.page_id, bytes(r.payload)) for r in got) == [(i, h.encode()) for i, h in rows]


def test_segments_in_other_files_and_out_of_order(spark):
    rows = [(i, chr(97 + i) * (200 * i)) for i in range(12)]
    path = folder(spark)
    records = W.records(pages(spark, rows), DATE, segment=150, chunk=64)
    records.orderBy(W.F.xxhash64("record")).repartition(5).write.option("lineSep", "\r\n\r\n") \
        .option("compression", "gzip").text(path)
    assert digest_rows(back(spark, path)) == brute(rows)


def test_edges(spark):
    same = "<p>" + "equal " * 40
    rows = [(4, same), (2, same), (2, same), (2, same), (None, same), (None, same), (None, None), (None, ""), (7, None),
            (8, "x" * 99), (9, "x" * 99), (10, "é" * 50), (11, "é" * 50), (12, "long " * 400_000), (12, "other")]
    path = folder(spark)
    W.write_archives(pages(spark, rows), path)
    got = back(spark, path)
    assert digest_rows(got) == brute(rows)
    assert {bytes(r.payload) for r in got if r.record_type == "revisit"} == {same.encode(), ("é" * 50).encode()}
    empty = folder(spark)
    W.write_archives(pages(spark, rows).limit(0), empty)
    assert W.read_pages(spark, empty).collect() == []


def test_records_carry_the_standard_fields(spark):
    rows = [(1, "a" * 500), (2, "a" * 500)]
    got = sorted(bytes(r.record).decode() for r in W.records(pages(spark, rows), DATE, segment=400).select(
        W.F.col("record").cast("binary").alias("record")).collect())
    kinds = {}
    for r in got:
        head, _, body = r.partition("\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.split("\r\n")[1:])
        assert r.startswith("WARC/1.1\r\n") and int(fields["Content-Length"]) == len(body) and fields["WARC-Date"] == DATE
        kinds.setdefault(fields["WARC-Type"], []).append(fields)
    (first,), (rest,), (again,) = kinds["response"], kinds["continuation"], kinds["revisit"]
    assert first["WARC-Segment-Number"] == "1" and rest["WARC-Segment-Number"] == "2"
    assert rest["WARC-Segment-Origin-ID"] == first["WARC-Record-ID"] == again["WARC-Refers-To"]
    assert int(rest["WARC-Segment-Total-Length"]) == int(first["Content-Length"]) + int(rest["Content-Length"])
    assert len({f["WARC-Record-ID"] for k in kinds.values() for f in k}) == 3


def record(kind, block, number=None, total=None, name="a", origin=None, length=None, version=1, digest=None):
    head = [f"WARC/1.{version}", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", "page-id: 3"]
    head += [f"WARC-Segment-Number: {number}"] * (number is not None) + [f"WARC-Segment-Origin-ID: <{origin}>"] * (origin is not None)
    head += [f"WARC-Segment-Total-Length: {total}"] * (total is not None) + [f"WARC-Payload-Digest: sha256:{digest}"] * (digest is not None)
    return ("\r\n".join([*head, f"Content-Length: {len(block) if length is None else length}"]) + "\r\n\r\n" + block + "\r\n\r\n").encode()


def read(spark, tmp_path, name, *members):
    (tmp_path / f"{name}.warc.gz").write_bytes(b"".join(gzip.compress(m) for m in members))
    return W.read_pages(spark, str(tmp_path / f"{name}.warc.gz")).collect()


def test_archives_of_other_writers(spark, tmp_path):
    """WARC 1.0, many gzip members, plain bodies, records of other types."""
    (row,) = read(spark, tmp_path, "plain", record("warcinfo", "software: x", name="i", version=0),
                  record("response", "HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\nbody", version=0))
    assert (bytes(row.payload), row.payload_bytes, row.fault) == (b"body", 4, None)
    (row,) = read(spark, tmp_path, "ext", record("response", "HTTP/1.1 200 OK\r\ntransfer-encoding: Chunked\r\n\r\n"
                                                 "3;x=1\r\nabc\r\nA\r\n0123456789\r\n0\r\nTrailer: 1\r\n\r\n"))
    assert bytes(row.payload) == b"abc0123456789"


def test_faults_are_named_and_kept(spark, tmp_path):
    chunked = "HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"

    def fault(name, *members):
        (row,) = read(spark, tmp_path, name, *members)
        return row.fault

    whole = chunked + "3\r\nabc\r\n0\r\n\r\n"
    first, rest = whole[:20], whole[20:]
    good = [record("response", first, 1), record("continuation", rest, 2, len(whole), "b", "a")]
    assert fault("good", *reversed(good)) is None
    assert fault("missing", good[0]) == "segments"
    assert fault("twice", *good, good[1]) == "segments"
    assert fault("total", good[0], record("continuation", rest, 2, len(whole) + 1, "b", "a")) == "length"
    assert fault("cut", record("response", first, length=500)) == "cut short"
    assert fault("chunk", record("response", chunked + "9\r\nabc\r\n0\r\n\r\n")) == "chunks"
    assert fault("digest", record("response", whole, digest="00")) == "digest"
    assert fault("alone", record("revisit", "HTTP/1.1 200 OK\r\n\r\n", digest="00")) == "no response"


def test_op11_on_the_table(spark, sf_dir):
    rows = [(r.page_id, r.html) for r in table(spark, sf_dir, "pages").collect()]
    assert digest_rows(op11_warc(spark, sf_dir).collect()) == brute(rows)
