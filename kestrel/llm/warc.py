"""WARC archives: writing captures and assembling them again (operator 5).

``write_archives`` writes three records for every page (request, response or
revisit, metadata) as gzipped WARC/1.1 text through Spark's text writer: a row
is a record, the record separator is the line separator. ``read_records``
parses archives file by file; ``assemble`` brings the records of a capture
together through WARC-Concurrent-To and returns one nested row per capture.

Of pages with equal payloads of at least ``MIN_REVISIT_BYTES`` bytes the one
with the largest page_id is stored, the others are revisits of it.

Defined cases: null html is an empty payload; small equal payloads are all
responses; rows that repeat the stored page_id of a payload are responses
themselves; a payload whose page_ids are all null is never revisited; a null
url gives no target URI; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.storage import broadcast_if_small, materialize, scratch_path

MIN_REVISIT_BYTES = 1000
MAX_BROADCAST_ROWS = 100_000
#: rows of one archive file (a third of it captures), so that a file fits a task
RECORDS_PER_FILE = 6000
WARC_DATE = "2024-01-01T00:00:00Z"
EOL, END = "\r\n", "\r\n\r\n"

RECORD_SCHEMA = ("archive string, position long, record_id string, warc_type string, concurrent_to string, "
                 "refers_to string, target_uri string, payload_digest string, payload_bytes long, page_id long, "
                 "payload string")


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"), F.lit(">"))


def _record(kind: str | Column, record_id: Column, headers: list[Column], block: Column) -> Column:
    """One record; headers that are null are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = F.concat_ws(EOL, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind),
                       F.concat(F.lit("WARC-Record-ID: "), record_id), F.lit(f"WARC-Date: {WARC_DATE}"), *headers,
                       F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(head, F.lit(END), block)


def captures(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_bytes, digest, stored): ``stored`` is
    the page_id to revisit, null for a response."""
    base = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    base = (base.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
            .withColumn("payload_bytes", F.octet_length("payload").cast("long")))
    groups = (base.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES).groupBy("digest", "payload_bytes")
              .agg(F.max("page_id").alias("stored"), F.count(F.lit(1)).alias("n"))
              .where((F.col("n") > 1) & F.col("stored").isNotNull()).drop("n"))
    groups = materialize(groups, "equal-payloads")
    j = base.join(broadcast_if_small(groups, MAX_BROADCAST_ROWS), ["digest", "payload_bytes"], "left")
    return j.withColumn("in_group", F.col("stored").isNotNull()).withColumn(
        "stored", F.when(~F.col("stored").eqNullSafe(F.col("page_id")), F.col("stored")))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write every page's records below ``path``."""
    c = captures(pages).withColumn("uid", F.monotonically_increasing_id())
    stored_id = lambda page: _uuid(F.lit("stored"), page, F.col("digest"))
    # the id of a stored response follows from page_id and digest, so that revisits can name it
    is_stored = F.col("in_group") & F.col("stored").isNull()
    rid = F.when(is_stored, stored_id(F.col("page_id"))).otherwise(
        _uuid(F.lit("capture"), F.col("page_id"), F.col("digest"), F.col("uid")))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    target = F.when(uri.isNotNull(), F.concat(F.lit("WARC-Target-URI: "), uri))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"))
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), F.col("rid"))
    revisit = F.col("stored").isNotNull()
    main = _record(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), F.col("rid"),
        [target, digest,
         F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), stored_id(F.col("stored")))),
         F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
         F.lit("Content-Type: application/http;msgtype=response")],
        F.when(revisit, http).otherwise(F.concat(http, F.col("payload"))))
    request = _record("request", _uuid(F.lit("request"), F.col("rid"), F.col("uid")),
                      [target, concurrent, F.lit("Content-Type: application/http;msgtype=request")],
                      F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(f" HTTP/1.1{END}")))
    meta = _record("metadata", _uuid(F.lit("metadata"), F.col("rid"), F.col("uid")),
                   [target, concurrent, F.lit("Content-Type: application/warc-fields")],
                   F.when(F.col("page_id").isNull(), F.lit("")).otherwise(
                       F.concat(F.lit("page_id: "), F.col("page_id").cast("string"), F.lit(EOL))))
    (c.withColumn("rid", rid).select(F.explode(F.array(request, main, meta)).alias("value"))
     .write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def _records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(position, headers, block) of each record of one unpacked archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split(EOL)
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        n = int(headers["content-length"])
        yield at, headers, data[end + 4:end + 4 + n]
        at = end + 4 + n + len(END)


def _parse(path: str, data: bytes, with_payload: bool) -> Iterator[tuple]:
    for at, h, block in _records(data):
        kind, digest, size, page, payload = h["warc-type"], None, None, None, None
        if kind in ("response", "revisit"):
            head, _, body = block.partition(b"\r\n\r\n")
            if kind == "response":  # of the bytes that are there, not of what the header says
                digest, size = hashlib.sha1(body).hexdigest(), len(body)
                payload = body.decode("utf-8") if with_payload else None
            else:
                digest = h["warc-payload-digest"].removeprefix("sha1:")
                size = next(int(x.partition(b":")[2]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        elif kind == "metadata":
            page = next((int(x.partition(b":")[2]) for x in block.split(b"\r\n") if x.startswith(b"page_id:")), None)
        yield (path, at, h["warc-record-id"], kind, h.get("warc-concurrent-to"), h.get("warc-refers-to"),
               h.get("warc-target-uri"), digest, size, page, payload)


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Every record of the archives below ``path``."""
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]

    def parse(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                unpacked = zlib.decompress(content, wbits=31) if name.endswith(".gz") else bytes(content)
                rows, held = [], 0
                for r in _parse(name, unpacked, with_payload):
                    rows.append(r)
                    held += len(r[-1] or "")
                    if len(rows) >= 5000 or held > 16_000_000:
                        yield _frame(rows, names)
                        rows, held = [], 0
                if rows:
                    yield _frame(rows, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInPandas(parse, RECORD_SCHEMA)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=names)
    return pdf.astype({"payload_bytes": "Int64", "page_id": "Int64"})


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: (capture_id, page_id, request, response,
    metadata). The three kinds meet in one shuffle on the identifier that
    request and metadata name as concurrent. A stored page that was written
    several times under one identifier comes back as often."""
    fields = [f for f in records.columns if f not in ("warc_type", "page_id")]
    one = lambda *kinds: F.first(F.when(F.col("warc_type").isin(*kinds), F.struct(*fields, "warc_type")), ignorenulls=True)
    main = F.col("warc_type").isin("response", "revisit")
    g = (records.withColumn("capture_id", F.when(main, F.col("record_id")).otherwise(F.col("concurrent_to")))
         .groupBy("capture_id")
         .agg(F.max("page_id").alias("page_id"), one("request").alias("request"), one("response", "revisit").alias("response"),
              one("metadata").alias("metadata"), F.count(F.when(main, 1)).alias("copies")))
    return g.where("copies > 0").withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).drop("copies", "copy")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the archives, read them back, and report every page."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    nested = materialize(assemble(read_records(spark, path, with_payload=False)).select(
        "capture_id", "page_id", F.col("response.warc_type").alias("record_type"), "response.payload_bytes",
        "response.payload_digest", F.col("response.refers_to").alias("refers_id")), "captures")
    stored = nested.where("record_type = 'response'").select(
        F.col("capture_id").alias("refers_id"), F.col("page_id").alias("refers_to"))
    named = materialize(nested.where("refers_id IS NOT NULL").select("refers_id").distinct(), "named")
    stored = materialize(stored.join(broadcast_if_small(named, MAX_BROADCAST_ROWS), "refers_id", "left_semi").distinct(), "stored")
    return (nested.join(broadcast_if_small(stored, MAX_BROADCAST_ROWS), "refers_id", "left")
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
