"""WARC archives: writing captures, reading records, assembling transactions.

A capture is a request, a response (or a revisit, if an equal payload is in the
archive already) and a metadata record. Request and metadata name the response in
``WARC-Concurrent-To``. Archives are written by Spark's text writer, so any
Hadoop file system will do: a record is one value, and its closing line breaks
are the line separator. They are gzip files, which Spark never splits; the reader
gets each file's lines in order and follows ``Content-Length``, whatever the
payload holds. Records stream through the tasks; no file is held whole.

Equal payloads are found by SHA-1 and size: the largest page id of each is taken
by a map-side aggregate and joined back, so a payload that a third of the pages
share is one row per task, and the join splits it (its rows are single pages).

Defined cases: NULL html is an empty payload; a NULL url or page id is written as
an empty field and comes back as NULL; repeated rows are captures of their own;
a capture without a request or metadata record has NULL there; request or
metadata records whose response is missing form no capture; an empty table gives
no rows.
"""

import base64
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlog.llm.frames import MERGE, bounded_batches
from visitlog.session import new_shared_path, stage

MIN_REVISIT_BYTES = 1000
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"
PAGE_HEADER = "X-Page-ID"
RECORD_SCHEMA = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("target_uri", T.StringType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("concurrent_to", T.ArrayType(T.StringType())),
    T.StructField("refers_to", T.StringType()),
    T.StructField("block", T.BinaryType()),
    T.StructField("payload", T.BinaryType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()),
])


def base32_digest(hex_digest):
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def hex_digest(header):
    """Bare lower-case hex of a ``sha1:`` header in base 32 or hex."""
    value = header.partition(":")[2]
    return base64.b32decode(value).hex() if len(value) == 32 else value.lower()


def with_revisits(pages, min_bytes=MIN_REVISIT_BYTES):
    """Pages of ``page_id, url, html`` with their digest, size, and the page that
    they revisit (NULL if they are a response)."""
    html = F.coalesce(F.col("html"), F.lit(""))
    digest, size = F.sha1(html.cast("binary")), F.octet_length(html).cast("long")
    last = (
        pages.select(digest.alias("d"), size.alias("n"), "page_id")
        .filter(F.col("n") >= min_bytes)
        .groupBy("d", "n")
        .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )
    marked = pages.select("page_id", "url", html.alias("html"), digest.alias("digest"), size.alias("size"))
    joined = marked.join(
        last.hint(MERGE), (F.col("digest") == F.col("d")) & (F.col("size") == F.col("n")), "left"
    )
    older = F.col("page_id").isNull() | (F.col("page_id") < F.col("last"))
    return joined.select(
        "page_id", "url", "html", "digest", "size", F.when(older, F.col("last")).alias("original")
    )


def _header(*lines):
    return EOL.join(lines) + EOL + EOL


def record_id(kind, page, digest):
    """The same for every try of a task: made from what is captured."""
    name = f"{kind}|{page}|{digest}".encode()
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(name).digest()[:16], version=5)}>"


def _records(page_id, url, html, digest, original):
    """The three records of a capture, each without its last line break."""
    page = "" if page_id is None else str(page_id)
    url = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    size = len(html.encode("utf-8", "surrogatepass"))
    block = _header("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {size}")
    main = [("WARC-Payload-Digest", base32_digest(digest)), ("Content-Type", "application/http; msgtype=response")]
    kind, own = ("response", "response") if original is None else ("revisit", "revisit")
    if original is None:
        block += html
    else:
        main += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id("response", original, digest))]
    capture = record_id(own, page, digest)
    link = ("WARC-Concurrent-To", capture)
    request = _header("GET / HTTP/1.1", "Accept: */*")
    for name, record, headers, body in (
        (record_id("request", page, digest), "request",
         [link, ("Content-Type", "application/http; msgtype=request")], request),
        (capture, kind, main, block),
        (record_id("metadata", page, digest), "metadata",
         [link, ("Content-Type", "application/warc-fields")], f"fetchTimeMs: 0{EOL}"),
    ):
        fields = [("WARC-Type", record), ("WARC-Record-ID", name), ("WARC-Date", DATE), ("WARC-Target-URI", url),
                  (PAGE_HEADER, page), *headers, ("Content-Length", str(len(body.encode("utf-8", "surrogatepass"))))]
        yield "WARC/1.1" + EOL + _header(*[f"{k}: {v}" for k, v in fields]) + body + EOL


def write_archives(pages, path, min_bytes=MIN_REVISIT_BYTES):
    """Write the captures of ``pages`` (``page_id, url, html``) as archives in ``path``."""

    def task(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                rows = batch.slice(begin, 64).to_pylist()
                out = [
                    record
                    for r in rows
                    for record in _records(r["page_id"], r["url"], r["html"], r["digest"], r["original"])
                ]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    bounded_batches(pages)
    records = with_revisits(pages, min_bytes).drop("size").mapInArrow(task, "value string")
    records.write.option("lineSep", EOL).option("compression", "gzip").text(path)


class RecordReader:
    """Takes the lines of archives, gives their records."""

    def __init__(self):
        self.begin()

    def begin(self):
        self.headers, self.body, self.missing = None, None, 0

    def feed(self, line):
        """The next line; a record if the line completes one."""
        if self.body is not None:
            self.body.append(line)
            self.missing -= len(line)
            if self.missing > 0:
                self.body.append(b"\r\n")
                self.missing -= 2
        elif self.headers is None:
            if line.startswith(b"WARC/"):
                self.headers = []
            return None
        elif line:
            name, _, value = line.partition(b":")
            self.headers.append((name.decode("utf-8", "replace").lower(), value.strip().decode("utf-8", "replace")))
            return None
        else:
            self.body = []
            self.missing = next((int(v) for k, v in self.headers if k == "content-length" and v.isdigit()), 0)
        if self.missing > 0:
            return None
        record = self.headers, b"".join(self.body)
        self.begin()
        return record


def record_row(headers, block, bodies=True):
    """A record as a row of :data:`RECORD_SCHEMA`, on demand without block and payload."""
    first = {}
    for name, value in headers:
        first.setdefault(name, value)
    kind = first.get("warc-type")
    row = {
        "record_id": first.get("warc-record-id"),
        "record_type": kind,
        "target_uri": first.get("warc-target-uri") or None,
        "headers": list(first.items()),
        "concurrent_to": [v for k, v in headers if k == "warc-concurrent-to"],
        "refers_to": first.get("warc-refers-to"),
        "block": block if bodies else None,
        "payload": None,
        "payload_bytes": None,
        "payload_digest": hex_digest(first["warc-payload-digest"]) if "warc-payload-digest" in first else None,
    }
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        row |= {"payload": payload if bodies else None, "payload_bytes": len(payload), "payload_digest": hashlib.sha1(payload).hexdigest()}
    return row


def read_records(spark, path, kinds=None, bodies=True):
    """One row per record of the archives in ``path``, of the ``kinds`` given.

    The digest of a response is computed from its payload, not taken from a header.
    Without ``bodies`` the bytes themselves are left out."""
    lines = spark.read.option("lineSep", EOL).text(path)
    bounded_batches(lines)
    lines = lines.select(F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"))

    def task(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(RECORD_SCHEMA)
        reader, file, rows, size = RecordReader(), None, [], 0
        for batch in batches:
            for line, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != file:
                    reader.begin()
                    file = name
                record = reader.feed(line)
                if record is None:
                    continue
                row = record_row(*record, bodies)
                if kinds is None or row["record_type"] in kinds:
                    rows.append(row)
                    size += len(row["block"] or b"")
                if size > 4 << 20 or len(rows) >= 2000:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return lines.mapInArrow(task, RECORD_SCHEMA)


def assemble(spark, path, payloads=False):
    """One nested row per capture: ``capture`` (response or revisit), ``request`` and
    ``metadata`` (structs of a record; NULL if missing), and ``original``, the id,
    headers and payload size of the response that a revisit refers to. With
    ``payloads`` there is the column ``payload`` too, the original's for a revisit.

    A request or metadata record belongs to the captures that it is concurrent to,
    or that are concurrent to it; of several the one with the smallest id stays.
    The archives are read once, their headers and digests are staged for the joins,
    and only ``payloads`` reads them again."""
    records = stage(read_records(spark, path, bodies=False).drop("block", "payload"), "records")
    record = F.struct(*records.columns)
    main = records.filter("record_type IN ('response', 'revisit')")
    side = records.filter("record_type IN ('request', 'metadata')").select("record_id", "concurrent_to", record.alias("side"))
    forward = side.select(F.explode("concurrent_to").alias("of"), "side")
    backward = main.select(F.explode("concurrent_to").alias("side_id"), F.col("record_id").alias("of")).join(
        side.select(F.col("record_id").alias("side_id"), "side"), "side_id"
    )
    kind, name = F.col("side.record_type"), F.col("side.record_id")
    pick = [F.min_by(F.when(kind == k, F.col("side")), F.when(kind == k, name)).alias(k) for k in ("request", "metadata")]
    sides = forward.unionByName(backward.select("of", "side")).groupBy("of").agg(*pick)
    originals = (
        main.filter("record_type = 'response'")
        .groupBy(F.col("record_id").alias("original_id"))
        .agg(F.first(F.struct("record_id", "headers", "payload_bytes")).alias("original"))
    )
    # A response looks for itself: a NULL key would send all responses to one task.
    refers = F.col("capture.refers_to")
    out = (
        main.select(record.alias("capture"))
        .join(sides, F.col("capture.record_id") == F.col("of"), "left")
        .join(originals, F.coalesce(refers, "capture.record_id") == F.col("original_id"), "left")
        .select("capture", "request", "metadata", F.when(refers.isNotNull(), F.col("original")).alias("original"))
    )
    if not payloads:
        return out
    bodies = read_records(spark, path, ("response",)).groupBy(F.col("record_id").alias("body_id")).agg(
        F.first("payload").alias("payload")
    )
    wanted = F.coalesce("original.record_id", "capture.record_id")
    return out.join(bodies.hint(MERGE), wanted == F.col("body_id"), "left").drop("body_id")


def capture_pages(pages, path=None, id_col="page_id", url_col="url", html_col="html"):
    """Write ``pages`` as archives, read them back, and return one row per page."""
    spark = pages.sparkSession
    kind = pages.select(f"`{id_col}`").dtypes[0][1]
    path = path or new_shared_path(spark, "warc")
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        F.col(f"`{html_col}`").cast("string").alias("html"),
    )
    write_archives(rows, path)

    def page(record):
        return F.nullif(F.col(record)["headers"][PAGE_HEADER.lower()], F.lit("")).cast(kind)

    captures = assemble(spark, path)
    return captures.select(
        page("capture").alias("page_id"),
        F.coalesce("capture.payload_bytes", "original.payload_bytes").alias("payload_bytes"),
        F.col("capture.payload_digest").alias("payload_digest"),
        F.col("capture.record_type").alias("record_type"),
        F.when(F.col("capture.record_type") == "revisit", page("original")).alias("refers_to"),
        F.col("capture.target_uri").alias("url"),
        F.col("request").isNotNull().alias("has_request"),
        F.col("metadata").isNotNull().alias("has_metadata"),
    )
