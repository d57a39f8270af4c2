"""WARC archives: write captures as records, read records, assemble transactions.

``write_warc`` writes a request, a response (or revisit) and a metadata record for each capture, joined
by WARC-Concurrent-To. Of captures with equal payloads of at least ``revisit_bytes`` the one with the
largest key is the response; the others are revisit records, which hold the HTTP header alone
and refer to it. ``read_warc`` parses records of any WARC file by their Content-Length.
``assemble`` joins records of a transaction by concurrent-to into one nested row per capture.

Archives are gzip files of bounded size, written and read by Spark's own sources, so a failed task leaves no half
archive behind: captures are written in classes by their size, and the larger they are the fewer share a file.
A file is one gzip member, so its records are read in order.

Defined results: a null payload counts as empty; a null url is written empty, line breaks in it as
%0A; a null key counts as the smallest; repeated rows are captures of their own, of which one is the
response; records without a partner give null or empty fields, each one without any id a row of its own; no rows give
no archive and no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm.components import components
from loamline.llm.scratch import materialize
from loamline.sources.shared import workspace

REVISIT_BYTES = 1000
#: Payload bytes up to which captures are of a class, and how many of them share a file: 128 MB at most, or one capture.
CLASSES = ((1 << 16, 2000), (1 << 20, 128), (1 << 24, 8), (None, 1))
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CRLF = "\r\n"
#: The header that a record may have several times.
REPEATED = "warc-concurrent-to"

RECORD = (
    "record_type string, record_id string, concurrent_to array<string>, refers_to string, target_uri string, date string, "
    "http_head string, payload binary, payload_bytes bigint, payload_digest string, digest_ok boolean, fields map<string,string>"
)


def _record(kind: str, record_id: Column, more: list[tuple[str, Column]], content_type: str, block: Column, date: str) -> Column:
    """One record without the two line ends that follow it; a null header is left out."""
    head = [F.lit(f"WARC/1.1{_CRLF}WARC-Type: {kind}{_CRLF}WARC-Date: {date}{_CRLF}WARC-Record-ID: <"), record_id, F.lit(f">{_CRLF}")]
    for name, value in more:
        head.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF)), F.lit("")))
    head += [F.lit(f"Content-Type: {content_type}{_CRLF}Content-Length: "), F.octet_length(block).cast("string"), F.lit(_CRLF * 2)]
    return F.concat(*head, block)


def write_warc(pages: DataFrame, path: str, *, key: str = "page_id", url: str = "url", payload: str = "html", date: str = "2024-01-01T00:00:00Z", revisit_bytes: int = REVISIT_BYTES) -> None:
    """Write the captures of ``pages`` as gzip-compressed WARC 1.1 files under ``path``."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(key).cast("long").alias("key"), F.regexp_replace(F.coalesce(F.col(url), F.lit("")), "\r\n|\r|\n", "%0A").alias("url"), body.alias("body"),
        F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("n"),
    )
    rows = materialize(rows, "captures")  # the numbers are fixed from here
    # one row per payload that occurs twice or more: what its revisits refer to
    long = rows.where(F.col("bytes") >= revisit_bytes)
    largest = long.groupBy("digest").agg(F.count("*").alias("times"), F.max(F.struct("key", "n")).alias("x")).where("times > 1")
    largest = materialize(largest.select(F.col("digest").alias("d"), F.col("x.key").alias("to_key"), F.col("x.n").alias("to_n")), "payloads")
    rows = rows.join(largest, (F.col("digest") == F.col("d")) & (F.col("bytes") >= revisit_bytes), "left")

    name = lambda k, n, kind: F.concat(F.lit("urn:capture:"), F.coalesce(k.cast("string"), F.lit("")), F.lit(":"), n.cast("string"), F.lit(f":{kind}"))
    own = name(F.col("key"), F.col("n"), "response")
    revisit = F.col("to_n").isNotNull() & (F.col("to_n") != F.col("n"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(_CRLF * 2))
    uri = ("WARC-Target-URI", F.col("url"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    beside = ("WARC-Concurrent-To", F.concat(F.lit("<"), own, F.lit(">")))
    refers = [("WARC-Refers-To", F.concat(F.lit("<"), name(F.col("to_key"), F.col("to_n"), "response"), F.lit(">"))), ("WARC-Profile", F.lit(PROFILE))]
    response = "application/http;msgtype=response"
    main = F.when(revisit, _record("revisit", own, [uri, digest, *refers], response, http, date)).otherwise(
        _record("response", own, [uri, digest], response, F.concat(http, F.col("body")), date)
    )
    asked = F.concat(F.lit("GET "), F.col("url"), F.lit(f" HTTP/1.1{_CRLF * 2}"))
    request = _record("request", name(F.col("key"), F.col("n"), "request"), [uri, beside], "application/http;msgtype=request", asked, date)
    facts = F.concat(F.lit("capture-key: "), F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(_CRLF))
    metadata = _record("metadata", name(F.col("key"), F.col("n"), "metadata"), [uri, beside], "application/warc-fields", facts, date)
    lines = rows.select("bytes", F.concat(request, F.lit(_CRLF * 2), main, F.lit(_CRLF * 2), metadata).alias("value"))
    longest = rows.agg(F.max("bytes")).first()[0]
    least = 0
    for most, share in CLASSES:
        if least > (longest or 0):  # the first class makes the folder, even without rows
            break
        some = F.col("bytes") >= least if most is None else F.col("bytes").between(least, most - 1)
        # a record ends with two line ends, which the writer puts after each row
        part = lines.where(some).select("value").write.option("lineSep", _CRLF * 2).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
        part.option("maxRecordsPerFile", share).mode("append").text(path)
        least = most


def parse_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record of an uncompressed WARC stream; repeats of the header that may have some are joined by spaces."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            name, value = name.decode("latin-1").strip().lower(), value.decode("utf-8", "replace").strip()
            head[name] = f"{head[name]} {value}" if name == REPEATED and name in head else value
        yield head, stream.read(int(head.get("content-length", 0)))


def _row(head: dict[str, str], block: bytes, with_payload: bool) -> dict:
    """A record as a row: the payload of HTTP records is what follows their header."""
    kind = head.get("warc-type")
    plain = lambda x: x[1:-1] if x and x[0] == "<" else x
    row = {
        "record_type": kind, "record_id": plain(head.get("warc-record-id")), "concurrent_to": [plain(x) for x in head.get(REPEATED, "").split()], "refers_to": plain(head.get("warc-refers-to")),
        "target_uri": head.get("warc-target-uri"), "date": head.get("warc-date"), "http_head": None, "payload": None, "payload_bytes": None, "payload_digest": None, "digest_ok": None,
        "fields": None,
    }
    stated = head.get("warc-payload-digest", "").rpartition(":")[2] or None
    if head.get("content-type", "").startswith("application/http"):
        at = block.find(b"\r\n\r\n")
        at = len(block) if at < 0 else at + 4
        row["http_head"] = block[:at].decode("latin-1")
        if kind == "revisit":  # the payload is elsewhere; its size is in the HTTP header
            size = [x.partition(":")[2] for x in row["http_head"].split(_CRLF) if x.lower().startswith("content-length:")]
            row["payload_bytes"], row["payload_digest"] = (int(size[0]) if size else None), stated
        else:
            body = memoryview(block)[at:]
            row["payload_bytes"], row["payload_digest"] = len(body), hashlib.sha1(body).hexdigest()
            row["digest_ok"] = None if stated is None else stated == row["payload_digest"]
            row["payload"] = bytes(body) if with_payload else None
    elif head.get("content-type", "").startswith("application/warc-fields"):
        lines = [x.partition(":") for x in block.decode("utf-8", "replace").split(_CRLF) if ":" in x]
        row["fields"] = [(a.strip(), b.strip()) for a, _, b in lines]
    return row


_ARROW = pa.schema(
    [
        ("record_type", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
        ("http_head", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_ok", pa.bool_()),
        ("fields", pa.map_(pa.string(), pa.string())),
    ]
)


def read_warc(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """A row per record of the WARC files (.warc or .gz) under ``path``; digests are of the payloads as read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_buffer()
                raw = io.BytesIO(data)
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 18) if bytes(data[:2]) == b"\x1f\x8b" else raw
                rows, size = [], 0
                for head, block in parse_records(stream):
                    rows.append(_row(head, block, with_payload))
                    size += len(block)
                    if len(rows) >= 2000 or with_payload and size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(read, RECORD)


def _captures(records: DataFrame, main: Column) -> DataFrame:
    """``records`` with the capture_id of the set of records that they are linked to, in either direction and over any number of steps.

    The set is called by its smallest main record, or by its smallest record. In the usual case, when requests and metadata each name one
    main record and that names none, the name is at hand; else the sets are components.
    """
    ids = materialize(records.where("record_id IS NOT NULL").select(F.col("record_id").alias("id"), F.array_distinct("concurrent_to").alias("to"), main.alias("main")), "ids")
    links = ids.select("id", "main", F.size("to").alias("n"), F.explode("to").alias("to"))
    mains = ids.where("main").select(F.col("id").alias("to"))
    odd = links.where("main OR n > 1").select("to").unionByName(links.where("NOT main AND n = 1").select("to").join(mains, "to", "left_anti"))
    if odd.isEmpty():
        return records.withColumn("capture_id", F.when(main, F.col("record_id")).otherwise(F.coalesce(F.get("concurrent_to", F.lit(0)), "record_id")))
    roots = components(links, "id", "to")
    of = ids.groupBy(F.col("id").alias("node")).agg(F.max("main").alias("main"))
    named = roots.join(of, "node", "left").groupBy("root").agg(F.min(F.struct(~F.coalesce("main", F.lit(False)), "node"))["node"].alias("capture_id"))
    found = roots.join(named, "root").select(F.col("node").alias("_node"), "capture_id")
    # a record without an id goes where its first link leads
    at = F.coalesce("record_id", F.get("concurrent_to", F.lit(0)))
    return records.withColumn("_at", at).join(found, F.col("_at") == F.col("_node"), "left").withColumn("capture_id", F.coalesce("capture_id", "_at")).drop("_at", "_node")


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: capture_id, the response, revisit or resource record, its requests, its metadata, and further main records.

    Records belong together that concurrent-to links connect, whichever of the two names the other and over any number of steps.
    Of several main records of a set, or of one id, the first by date, id and digest is ``response``, the others stand in ``more``. Sets without a
    main record make rows with a null ``response``; a record without any id makes a row of its own.
    """
    main = F.col("record_type").isin("response", "revisit", "resource")
    keyed = _captures(records, main)
    whole = F.struct(*[F.col(c) for c in records.columns if c != "capture_id"])
    rank = lambda r: F.struct(*[F.coalesce(r[c], F.lit("")) for c in ("date", "record_id", "payload_digest")])
    order = lambda a, b: F.when(rank(a) < rank(b), -1).when(rank(a) > rank(b), 1).otherwise(0)
    sets = lambda all_: [F.get(all_, F.lit(0)).alias("response"), "requests", "metadata", F.slice(all_, 2, F.greatest(F.size(all_) - 1, F.lit(0))).alias("more")]
    part = lambda kind: F.collect_list(F.when(kind, whole))
    request, metadata = F.col("record_type") == "request", F.col("record_type") == "metadata"
    met = keyed.where("capture_id IS NOT NULL").groupBy("capture_id").agg(part(main).alias("mains"), part(request).alias("requests"), part(metadata).alias("metadata"))
    met = met.select("capture_id", *sets(F.array_sort("mains", order)))
    alone = lambda kind: F.array_compact(F.array(F.when(kind, whole)))
    lone = keyed.where("capture_id IS NULL").select("capture_id", alone(main).alias("mains"), alone(request).alias("requests"), alone(metadata).alias("metadata"))
    return met.unionByName(lone.select("capture_id", *sets(F.col("mains"))))


def archive(pages: DataFrame, **options) -> DataFrame:
    """Records of ``pages`` written to new archives in the shared folder and read back, without payloads."""
    spark = pages.sparkSession
    path = workspace(spark, "warc")
    write_warc(pages, path, **options)
    return read_warc(spark, path, with_payload=False)
