"""WARC archives: a writer with segmentation and revisits, and a reader that puts segments together."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecforge.session import scratch_path

CRLF = b"\r\n"
# The digits of Spark's conv() in base 32, and those of RFC 4648.
CONV_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
RFC_32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HTTP_CHUNKED = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                b"Transfer-Encoding: chunked\r\n\r\n")

SEGMENT_BYTES = 32 << 10     # longest record block
CHUNK_BYTES = 8 << 10        # longest chunk of the transfer framing
RECORDS_PER_FILE = 4096      # with SEGMENT_BYTES this bounds an archive to 128 MiB before compression
MAX_RECORD_BYTES = 1 << 30   # a Spark cell holds no more than 2 GiB


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1; 40 bits (10 hex digits, 8 base32 digits) at a time."""
    digest = F.sha1(payload)
    return F.concat(*[F.translate(F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0"),
                                  CONV_32, RFC_32) for i in range(4)])


# -- writing ------------------------------------------------------------------------------

def _chunked(payload: bytes, size: int) -> bytes:
    out = [b"%x\r\n%s\r\n" % (len(part), part)
           for part in (payload[i:i + size] for i in range(0, len(payload), size))]
    return b"".join([*out, b"0\r\n\r\n"])


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without its closing CRLF CRLF, which the text sink adds to each row."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + CRLF + CRLF + block


def _records(row: dict, unique: str, segment_bytes: int, chunk_bytes: int, date: str):
    key, digest, url = row["key"], row["digest"], row["url"]
    payload = row["payload"] or b""
    name = f"urn:row:{'' if key is None else key}:{digest}"
    if key is None or (row["copies"] or 0) > 1:
        name += f":{unique}"
    common = [("WARC-Date", date), ("WARC-Record-ID", f"<{name}>"), ("X-Row-Key", key),
              ("WARC-Target-URI", None if url is None else quote(url, safe="%/:=&?~#+!$,;'@()*[]")),
              ("WARC-Payload-Digest", f"sha1:{digest}")]
    if row["winner"] is not None and row["winner"] != key:
        yield _record([("WARC-Type", "revisit"), *common, ("X-Refers-To-Key", row["winner"]),
                       ("WARC-Refers-To", f"<urn:row:{row['winner']}:{digest}>"),
                       ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                       ("Content-Type", "application/http;msgtype=response")],
                      b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload))
        return
    block = HTTP_CHUNKED + _chunked(payload, chunk_bytes)
    kind = ("Content-Type", "application/http;msgtype=response")
    if len(block) <= segment_bytes:
        yield _record([("WARC-Type", "response"), *common, kind], block)
        return
    count = -(-len(block) // segment_bytes)
    for n in range(1, count + 1):
        part = block[(n - 1) * segment_bytes:n * segment_bytes]
        if n == 1:
            yield _record([("WARC-Type", "response"), *common, kind, ("WARC-Segment-Number", 1)], part)
        else:
            yield _record([("WARC-Type", "continuation"), ("WARC-Date", date),
                           ("WARC-Record-ID", f"<{name}:segment-{n}>"),
                           ("WARC-Segment-Origin-ID", f"<{name}>"), ("WARC-Segment-Number", n),
                           ("WARC-Segment-Total-Length", len(block) if n == count else None)], part)


def write_warc(pages: DataFrame, path: str, key_col: str, url_col: str, payload_col: str,
               min_revisit_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES,
               chunk_bytes: int = CHUNK_BYTES, records_per_file: int = RECORDS_PER_FILE,
               date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one logical record per row of ``pages`` as gzip-compressed WARC 1.1 archives under ``path``.

    Of the rows with equal payloads of at least ``min_revisit_bytes`` bytes the one with the
    largest key is a response and the others are revisits of it. Payloads are sent in chunked
    transfer framing; a block longer than ``segment_bytes`` is cut into a first record and
    continuation records. Only digests and keys are shuffled to find equal payloads; the table of
    repeated ones is written, so Spark broadcasts it only if its known size permits and otherwise
    sorts and splits hot digests.

    A null payload is empty and a null url leaves its header out. A null key is never the
    largest; if all keys of equal payloads are null, all are responses. Rows that repeat key and
    payload are each written (under distinct record ids). Other columns are not read.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key_col).cast("string").alias("key"), F.col(key_col).alias("order_key"),
                        F.col(url_col).alias("url"), payload.alias("payload"),
                        sha1_base32(payload).alias("digest"), F.length(payload).alias("n_bytes"))
    repeated = scratch_path(spark, "warc-repeated")
    (rows.filter(F.col("n_bytes") >= min_revisit_bytes)
     .groupBy("digest", "order_key").agg(F.count("*").alias("n"))
     .groupBy("digest").agg(F.max(F.struct("order_key", "n")).alias("top"), F.sum("n").alias("rows"))
     .filter("rows > 1")
     .select("digest", F.col("top.order_key").cast("string").alias("winner"), F.col("top.n").alias("copies"))
     .write.parquet(repeated))
    joined = (rows.join(spark.read.parquet(repeated), "digest", "left")
              .select("key", "url", "payload", "digest",
                      F.expr(f"CASE WHEN n_bytes >= {int(min_revisit_bytes)} THEN winner END").alias("winner"),
                      "copies"))

    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            out, held = [], 0
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                n += 1
                made = list(_records(row, f"{part}-{n}", segment_bytes, chunk_bytes, date))
                out += made
                held += sum(map(len, made))
                if held > 4 << 20:
                    yield pa.record_batch([pa.array(out, pa.binary())], ["record"])
                    out, held = [], 0
            yield pa.record_batch([pa.array(out, pa.binary())], ["record"])

    # The text sink writes the bytes of a string as they are, and CRLF CRLF after each row.
    (joined.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


# -- reading ------------------------------------------------------------------------------

def _headers(read) -> dict[str, str]:
    found: dict[str, str] = {}
    while (line := read()) not in (b"", CRLF, b"\n"):
        name, _, value = line.partition(b":")
        found[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return found


def _parse(content: bytes):
    """``(headers, block)`` of every record; a cut-off record has a shorter block than it tells."""
    raw = io.BytesIO(content)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else raw
    while line := stream.readline():
        if line.startswith(b"WARC/"):
            headers = _headers(stream.readline)
            length = int(headers.get("content-length") or 0)
            yield headers, stream.read(length), length


def decode_http(block: bytes) -> tuple[bytes, str]:
    """Payload of an HTTP response block, and ``ok`` or what is wrong with its framing."""
    stream = io.BytesIO(block)
    if not stream.readline().startswith(b"HTTP/"):
        return block, "ok"
    headers = _headers(stream.readline)
    if "chunked" not in headers.get("transfer-encoding", "").lower():
        return stream.read(), "ok"
    parts = []
    while True:
        size, _, _ = stream.readline().strip().partition(b";")
        try:
            n = int(size, 16)
        except ValueError:
            return b"".join(parts), "bad framing"
        if n == 0:
            return b"".join(parts), "ok"
        part = stream.read(n)
        parts.append(part)
        if len(part) < n or stream.readline() != CRLF:
            return b"".join(parts), "bad framing"


def _payload(block: bytes, digest: str | None):
    """``(payload, bytes, digest, status)``; the digest is that of the bytes found."""
    payload, status = decode_http(block)
    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if status == "ok" and digest and digest != found:
        status = "bad digest"
    return payload, len(payload), found, status


RECORD = ("record_id string, record_type string, key string, target_uri string, refers_to string, "
          "refers_to_key string, payload binary, payload_bytes long, payload_digest string, status string")
SEGMENT = ("origin string, n int, total long, record_type string, key string, target_uri string, "
           "digest string, cut boolean, block binary")


def _told(headers: dict) -> str | None:
    algorithm, _, value = headers.get("warc-payload-digest", "").partition(":")
    return value if algorithm.lower() == "sha1" else None


def _whole(headers, block, length):
    common = [headers.get("warc-record-id"), headers.get("warc-type"), headers.get("x-row-key"),
              headers.get("warc-target-uri"), headers.get("warc-refers-to"), headers.get("x-refers-to-key")]
    if headers.get("warc-type") == "revisit":  # no payload of its own: its headers tell size and digest
        stream = io.BytesIO(block)
        stream.readline()
        size = _headers(stream.readline).get("content-length")
        return [*common, None, None if size is None else int(size), _told(headers), "ok"]
    payload, n, digest, status = _payload(block, _told(headers))
    return [*common, payload, n, digest, "truncated" if len(block) < length else status]


def _segment(headers, block, length):
    return [headers.get("warc-segment-origin-id") or headers.get("warc-record-id"),
            int(headers["warc-segment-number"]),
            int(headers["warc-segment-total-length"]) if "warc-segment-total-length" in headers else None,
            headers.get("warc-type"), headers.get("x-row-key"), headers.get("warc-target-uri"),
            _told(headers), len(block) < length, block]


def _scan(files: DataFrame, segments: bool) -> DataFrame:
    schema = SEGMENT if segments else RECORD
    names = [x.split()[0] for x in schema.split(",")]
    kinds = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    types = [kinds[x.split()[1]] for x in schema.split(",")]

    def batch(rows):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def run(batches):
        for given in batches:
            for content in given.column(0):
                rows, held = [], 0
                for headers, block, length in _parse(content.as_py() or b""):
                    if ("warc-segment-number" in headers) != segments or headers.get("warc-type") == "warcinfo":
                        continue
                    rows.append((_segment if segments else _whole)(headers, block, length))
                    held += len(block)
                    if held > 4 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    return files.mapInArrow(run, schema)


def reassemble(segments: DataFrame, max_record_bytes: int = MAX_RECORD_BYTES) -> DataFrame:
    """Logical records from segment rows: grouped by origin id, ordered by segment number.

    A record is whole if its segments are numbered 1 to n without gaps, the last tells the total
    length and the blocks' lengths add up to it; then its block is joined and decoded. Otherwise
    its status is ``incomplete`` and nothing of it is collected (``too long`` beyond
    ``max_record_bytes``, what a Spark cell can hold). A segment number that is met twice counts once.
    """
    numbered = (segments.repartition("origin").groupBy("origin", "n")
                .agg(F.min("block").alias("block"), F.max("total").alias("total"),
                     F.max("record_type").alias("record_type"), F.max("key").alias("key"),
                     F.max("target_uri").alias("target_uri"), F.max("digest").alias("digest"),
                     F.max("cut").alias("cut")))
    first = F.col("n") == 1
    told = numbered.groupBy("origin").agg(
        F.max(F.when(first, F.col("record_type"))).alias("record_type"),
        F.max(F.when(first, F.col("key"))).alias("key"),
        F.max(F.when(first, F.col("target_uri"))).alias("target_uri"),
        F.max(F.when(first, F.col("digest"))).alias("digest"),
        F.sum(F.length("block").cast("long")).alias("n_bytes"), F.max("total").alias("total"),
        (F.count("*") == F.max("n")).alias("gapless"), F.min("n").alias("least"), F.max("cut").alias("cut"))
    told = told.withColumn("verdict", F.expr(
        "CASE WHEN NOT gapless OR least <> 1 OR cut OR total IS NULL OR n_bytes <> total THEN 'incomplete' "
        f"WHEN n_bytes > {int(max_record_bytes)} THEN 'too long' ELSE 'ok' END"))
    blocks = (numbered.join(told.filter("verdict = 'ok'").select("origin"), "origin", "left_semi")
              .groupBy("origin").agg(F.sort_array(F.collect_list(F.struct("n", "block"))).alias("parts")))
    found = (told.join(blocks, "origin", "left")
             .select("origin", "record_type", "key", "target_uri", "digest", "verdict", "parts.block"))

    def run(batches):
        for given in batches:
            rows = []
            for row in given.to_pylist():
                payload, n, digest, status = None, None, row["digest"], row["verdict"]
                if status == "ok":
                    payload, n, digest, status = _payload(b"".join(row["block"]), row["digest"])
                rows.append([row["origin"], row["record_type"], row["key"], row["target_uri"], None, None,
                             payload, n, digest, status])
            if rows:
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.string()] * 6 + [pa.binary(), pa.int64()]
                                                    + [pa.string()] * 2)],
                    [x.split()[0] for x in RECORD.split(",")])

    return found.mapInArrow(run, RECORD)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every logical record of the archives (gzip or plain) under ``path``, as ``RECORD`` rows.

    Records are found by their content lengths. Whole records are decoded where they are read;
    only segments are shuffled, by origin. ``status`` is ``ok``, ``truncated`` (the file ends
    inside the record), ``incomplete`` or ``too long`` (see :func:`reassemble`), ``bad framing`` or
    ``bad digest``. A revisit has no payload, but the size and digest that it tells. A file is
    read whole by one task (2 GiB at most), so archives should be of bounded size.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return _scan(files, False).unionByName(reassemble(_scan(files, True)))
