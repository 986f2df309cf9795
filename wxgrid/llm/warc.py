"""WARC archives, one gzip member per record, written and read in splits.

Writing: every page's response record is compressed where the page lies, so
only compressed members are shuffled.  Equal payloads are told by SHA-1 and
size (a partial aggregate, so a payload that a third of the pages hold is one
row per task); the copies meet its largest page under ``SALTS`` salts and
become revisit records of it.  Members are written by Spark's text sink, whose
separator is the zero byte that ends a member of less than 16 MB, so archives
are plain sequences of members; a larger member is followed by one zero byte
of padding, which gzip readers skip.

Reading: Spark's text source splits archives by byte ranges and scans each for
the gzip magic (``lineSep``); a range owns the members that start in it and
reads its last one beyond its end.  A candidate counts if it decodes to a WARC
header.  Magic bytes within a member are no start: the member goes on until its
stream ends.  Where a range ends within an open member (such bytes right at a
border) or starts with no candidate that decodes, its file is read once more in
order, by the records of all its ranges.

Defined cases: a null payload is empty; a null url leaves out its field; line
breaks, spaces and other bytes than visible ASCII in a url are percent-encoded;
a null page_id is never the largest of its group unless all are null; rows that
repeat the largest page_id and its payload are responses each; members that
break off or do not decode come back with status ``broken``; an empty table
gives no records; other columns are not read.  Archive names must not end in
the suffix of a compression codec, or Spark unpacks them itself.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, scratch, written

#: Fixed values of the formats: start of a gzip member (magic, deflate) and of
#: a record, and the profile of revisits.
MAGIC = b"\x1f\x8b\x08"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SALTS = 16
RECORDS_PER_FILE = 200_000
DATE = "1970-01-01T00:00:00Z"


def member(data: bytes) -> bytes:
    """One gzip member without a time stamp: a task run again writes the same."""
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def unpadded(m: bytes) -> bytes:
    """What is written before the sink's zero byte."""
    return m[:-1] if m.endswith(b"\0") else m


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _record(kind: str, fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *fields, ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _http(n_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()


def _uri(url: str | None) -> str | None:
    return None if url is None else urllib.parse.quote(url, safe="".join(chr(c) for c in range(33, 127)))


def _named(page_id, url, digest: str, date: str) -> list[tuple[str, object]]:
    return [("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date), ("WARC-Target-URI", _uri(url)),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-Id", page_id)]


RESPONSES = "page_id long, url string, sha1 string, n long, member binary"


def _responses(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, url, sha1, n, payload in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "sha1", "n", "payload"))):
                out.append(unpadded(member(_record("response", _named(page_id, url, base32(sha1), date), _http(n) + payload))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "sha1", "n")), pa.array(out, pa.binary())],
                                             names=["page_id", "url", "sha1", "n", "member"])

    return run


def _revisits(date: str):
    """Rows with a ``top`` become revisits of it; the others pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = batch.column("member").to_pylist()
            rows = [batch.column(c).to_pylist() for c in ("page_id", "url", "sha1", "n", "top", "top_url")]
            for k, top in enumerate(rows[4]):
                if top is None:
                    continue
                page_id, url, digest, n = rows[0][k], rows[1][k], base32(rows[2][k]), rows[3][k]
                fields = _named(page_id, url, digest, date) + [
                    ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(top, digest)), ("WARC-Refers-To-Target-URI", _uri(rows[5][k])),
                    ("WARC-Refers-To-Date", date), ("X-Refers-To-Page-Id", top)]
                out[k] = unpadded(member(_record("revisit", fields, _http(n))))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    return run


def write(pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url", payload: str = "html", date: str = DATE,
          records_per_file: int = RECORDS_PER_FILE) -> None:
    """Archive ``pages`` below ``path``."""
    bounded_batches(pages.sparkSession)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload")) \
        .withColumns({"sha1": F.sha1("payload"), "n": F.octet_length("payload").cast("long")})
    tops = rows.groupBy("sha1", "n").agg(F.max(F.struct("page_id", "url")).alias("t"), F.count("*").alias("copies")).where("copies > 1") \
        .select("sha1", "n", F.col("t.page_id").alias("top"), F.col("t.url").alias("top_url"),
                F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    made = rows.mapInArrow(_responses(date), RESPONSES).withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    both = made.join(tops, ["sha1", "n", "salt"], "left")
    older = F.col("page_id").isNull() | (F.col("page_id") < F.col("top"))
    both = both.select("page_id", "url", "sha1", "n", "member", F.when(older, F.col("top")).alias("top"), "top_url")
    records = both.mapInArrow(_revisits(date), "member binary")
    records.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0") \
        .option("maxRecordsPerFile", records_per_file).text(path)


class Member:
    """A member that is being decoded."""

    def __init__(self) -> None:
        self.stream, self.parts, self.broken = zlib.decompressobj(31), [], False

    def starts(self, data: bytes) -> bool | None:
        """Decode a candidate's first bytes; is it a record?  ``None``: so few
        bytes stand before the next magic that it may be."""
        try:
            head = self.stream.decompress(data, 64)
        except zlib.error:
            return False
        self.parts.append(head)
        if len(head) < 5 and not self.stream.eof:
            return None if b"WARC/".startswith(head) else False
        if not head.startswith(b"WARC/"):
            return False
        self.feed(self.stream.unconsumed_tail)
        return True

    def feed(self, data: bytes) -> None:
        try:
            if not self.stream.eof:
                self.parts.append(self.stream.decompress(data))
        except zlib.error:
            self.broken = True

    @property
    def done(self) -> bool:
        return self.broken or self.stream.eof


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """(fields by lower-case name, block) of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        fields[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    if not size.isdigit() or len(rest) < int(size):
        raise ValueError("no whole block")
    return fields, rest[:int(size)]


def http(block: bytes) -> tuple[dict[str, str], bytes]:
    """(fields by lower-case name, payload) of an HTTP message."""
    head, _, payload = block.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        fields[k.strip().lower().decode("latin-1")] = v.strip().decode("latin-1")
    return fields, payload


RECORD = ("path string, begin long, status string, type string, record_id string, target_uri string, page_id long, "
          "payload_bytes long, payload_digest string, digest_ok boolean, refers_to string, refers_to_page long, headers map<string,string>, payload binary")
_SCHEMA = pa.schema([("path", pa.string()), ("begin", pa.int64()), ("status", pa.string()), ("type", pa.string()), ("record_id", pa.string()),
                     ("target_uri", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("digest_ok", pa.bool_()), ("refers_to", pa.string()), ("refers_to_page", pa.int64()),
                     ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])


def _number(s: str | None) -> int | None:
    return int(s) if s is not None and s.lstrip("-").isdigit() else None


def _row(path: str, begin: int, m: Member, payloads: bool) -> tuple:
    none = (None,) * 11
    if m.broken or not m.stream.eof:
        return (path, begin, "broken", *none)
    try:
        f, block = parse(b"".join(m.parts))
    except ValueError:
        return (path, begin, "broken", *none)
    told = f.get("warc-payload-digest", "").removeprefix("sha1:") or None
    n = digest = ok = payload = None
    if f.get("content-type", "").startswith("application/http"):
        inner, payload = http(block)
        if f.get("warc-type") == "revisit":
            n, digest, payload = _number(inner.get("content-length")), told, None
        else:
            n, digest = len(payload), base32(hashlib.sha1(payload).hexdigest())
            ok = told is None or told == digest
    return (path, begin, "ok", f.get("warc-type"), f.get("warc-record-id"), f.get("warc-target-uri"), _number(f.get("x-page-id")), n, digest, ok,
            f.get("warc-refers-to"), _number(f.get("x-refers-to-page-id")), list(f.items()), payload if payloads else None)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def _owned(payloads: bool, in_order: bool):
    """Records of byte ranges; ``in_order``: a file's ranges follow each other
    and are one sequence, else each range stands for itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        at: tuple | None = None  # the sequence being read
        begin, open_, fresh = 0, None, False

        def closed() -> list[tuple]:
            if open_ is None:
                return []
            return [_row(at[0], begin, open_, payloads)] if in_order else [(at[0], begin, "open", *(None,) * 11)]

        for batch in batches:
            for path, start, value in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), batch.column("value")):
                key = (path,) if in_order else (path, start)
                if key != at:
                    rows += closed()
                    at, open_, fresh = key, None, start == 0
                    first = True
                if fresh:  # what stands before the file's first member
                    fresh = False
                    continue
                data = MAGIC + value.as_py()
                if open_ is not None:
                    open_.feed(data)
                else:
                    m = Member()
                    is_start = m.starts(data)
                    if first and not is_start and not in_order:  # maybe the end of the last range's member
                        rows.append((path, start, "head", *(None,) * 11))
                    if is_start is False:
                        continue
                    open_, begin = m, start
                first = False
                if open_.done:
                    rows.append(_row(path, begin, open_, payloads))
                    held += len(rows[-1][-1] or b"")
                    open_ = None
                if len(rows) >= 4096 or held > 8 << 20:
                    yield _batch(rows)
                    rows, held = [], 0
        rows += closed()
        if rows:
            yield _batch(rows)

    return run


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """(path, start, value): what follows each gzip magic, by the byte range
    that it starts in, in order within a range."""
    raw = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))


def read(spark: SparkSession, path: str, *, payloads: bool = True) -> DataFrame:
    """RECORD rows of the archives at ``path``."""
    bounded_batches(spark)
    found = candidates(spark, path)
    alone = written(found.mapInArrow(_owned(False, False), RECORD), "warc-records")
    torn = alone.where(F.col("status").isin("open", "head")).select("path").distinct()
    whole = alone if not payloads else found.mapInArrow(_owned(True, False), RECORD)
    if torn.isEmpty():
        return whole
    again = found.withColumn("at", F.monotonically_increasing_id()).join(torn, "path", "left_semi") \
        .repartition("path").sortWithinPartitions("path", "start", "at").drop("at")
    return whole.join(torn, "path", "left_anti").select(*whole.columns).unionByName(again.mapInArrow(_owned(payloads, True), RECORD))


def report(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write(pages, path)
    return read(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                                                    F.col("refers_to_page").alias("refers_to"))
