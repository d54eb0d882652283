"""WARC archives: a writer of one gzip member per record, and a splittable reader.

Reader: files are cut into byte ranges; a task scans its range for the gzip magic, takes a candidate for a
member only if it decodes to a WARC header, and owns the records that start inside its range, reading on past
its end for the last. So one archive of any size is read by many tasks without an index.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, stored

MAGIC = b"\x1f\x8b\x08"
#: Records of payloads below this many bytes are never revisits.
MIN_REVISIT = 100
#: A payload that more than one of this many records hold is hot; so there are fewer hot payloads than this.
HOT_SHARE = 100_000
READ = "path string, start long, record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary, digest_ok boolean"


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI in the shared store."""
    if uri.startswith("file:") and not uri.startswith("file:///"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def with_revisits(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", hot_share: int = HOT_SHARE) -> DataFrame:
    """Record plan: record_id, target_uri, payload, payload_bytes, payload_digest, record_type, refers_to.

    Of records with equal payloads of at least 100 bytes the one with the smallest id is the response and the
    others revisit it; rows that repeat this smallest id are responses too. Null payloads are empty ones, a null
    URL is empty, null ids come after all others. Digests that repeat are stored with their first id; hot ones,
    of which there are fewer than `hot_share`, are broadcast, so that their records stay where they are, and only
    other records look theirs up by a shuffle, if that table is too large to broadcast. `pages` must be a stored table.
    Ids are longs.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("record_id"), F.coalesce(F.col(url_col), F.lit("")).alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256))
    firsts = rows.filter(F.col("payload_bytes") >= MIN_REVISIT).groupBy("payload_digest").agg(F.min("record_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    firsts = stored(firsts.filter("n > 1"), "first-records")
    hot = F.col("n") * hot_share > pages.count()
    often = firsts.filter(hot).select("payload_digest", F.col("first_id").alias("often_id"), F.lit(True).alias("often"))
    seldom = firsts.filter(~hot).select(F.col("payload_digest").alias("sought"), F.col("first_id").alias("seldom_id"))
    # records without a lookup get keys of their own: NULL keys would meet in one task
    sought = F.when(F.col("often").isNull() & (F.col("payload_bytes") >= MIN_REVISIT), F.col("payload_digest"))
    joined = rows.join(F.broadcast(often), "payload_digest", "left").withColumn("sought", F.coalesce(sought, F.concat(F.lit("-"), F.monotonically_increasing_id())))
    joined = joined.join(seldom, "sought", "left").withColumn("first_id", F.coalesce("often_id", "seldom_id"))
    revisit = F.col("first_id").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "record_id", "target_uri", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def record_bytes(record_id, uri: str, payload: bytes, size: int, digest: str, kind: str, refers_to) -> bytes:
    """One gzip member; a revisit carries the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if record_id is None else record_id}>", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {quote(uri, safe=':/?#[]@!$&()*+,;=%~')}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write_warc(records: DataFrame, path: str) -> DataFrame:
    """Writes the records of `with_revisits` below `path`, one archive per partition; returns file, records, bytes.

    A task writes to a name of its own attempt and then renames it to its partition's name, so a retried task
    replaces its file by the same records. An empty partition writes no file. Call an action on the result.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get()
        store, base = open_store(path)
        store.create_dir(base, recursive=True)
        name = f"part-{at.partitionId():06d}.warc.gz"
        draft, n, size, out = f"{base}/_draft-{at.taskAttemptId()}-{name}", 0, 0, None
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("record_id", "target_uri", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")]
            for row in zip(*cols, strict=True):
                out = out or store.open_output_stream(draft, compression=None)
                member = record_bytes(*row)
                out.write(member)
                n, size = n + 1, size + len(member)
        if out:
            out.close()
            store.move(draft, f"{base}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([n], pa.int64()), "bytes": pa.array([size], pa.int64())})

    return records.mapInArrow(write, "file string, records long, bytes long")


class Members:
    """Reads gzip members of a stored file from any offset on, a block at a time."""

    BLOCK = 1 << 18

    def __init__(self, path: str, start: int):
        store, at = open_store(path)
        self.file = store.open_input_file(at)
        self.size, self.base, self.held = self.file.size(), start, b""

    def fill(self, upto: int) -> bool:
        """Holds the bytes up to offset `upto`, if the file has them."""
        while self.base + len(self.held) < upto:
            at = self.base + len(self.held)
            more = self.file.read_at(min(self.BLOCK, self.size - at), at) if at < self.size else b""
            if not more:
                return False
            self.held += more
        return True

    def find(self, at: int, end: int) -> int:
        """The first magic that starts in [at, end), or -1."""
        while at < end:
            self.drop(at)
            self.fill(min(at + self.BLOCK, end) + 2)
            i = self.held.find(MAGIC, 0, min(len(self.held), end - self.base + 2))
            if i >= 0:
                return self.base + i
            at = max(at + 1, self.base + len(self.held) - 2) if self.base + len(self.held) < self.size else end
        return -1

    def drop(self, at: int) -> None:
        if at > self.base:
            self.held, self.base = (self.held[at - self.base :], at) if at <= self.base + len(self.held) else (b"", at)

    def decode(self, at: int) -> tuple[bytes, int] | None:
        """The whole member at `at` and the offset after it; None if it isn't a member that holds a WARC record."""
        self.drop(at)
        un, out, fed = zlib.decompressobj(31), [], at
        try:
            while not un.eof:
                self.fill(fed + 1)
                piece = self.held[fed - self.base :]
                if not piece:
                    return None
                out.append(un.decompress(piece))
                fed += len(piece)
                if len(out) == 1 and not out[0][:5] == b"WARC/"[: len(out[0][:5])]:
                    return None
        except zlib.error:
            return None
        record = b"".join(out)
        return (record, fed - len(un.unused_data)) if record.startswith(b"WARC/") else None


def parse_record(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
    block = rest[: int(fields["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    urn = lambda x: x.removeprefix("<urn:page:").removesuffix(">") if x else None
    claimed = fields.get("warc-payload-digest", "").rpartition(":")[2]
    whole = fields["warc-type"] == "response"
    digest = hashlib.sha256(payload).hexdigest() if whole else claimed
    return {
        "record_id": urn(fields.get("warc-record-id")) or None, "record_type": fields["warc-type"], "target_uri": unquote(fields.get("warc-target-uri", "")), "refers_to": urn(fields.get("warc-refers-to")),
        "payload_bytes": len(payload) if whole else int(fields.get("x-payload-length", 0)), "payload_digest": digest, "payload": payload if whole else None, "digest_ok": digest == claimed,
    }


def read_warc(spark: SparkSession, path: str, *, range_bytes: int = 8 << 20, pattern: str = "*.warc.gz") -> DataFrame:
    """The records of all archives below `path`: file path, start offset, headers, payload and its digest.

    Ranges of `range_bytes` are dealt evenly over tasks; only file names and lengths are listed first. An
    archive without records gives no rows; bytes that are no WARC member are passed over.
    """
    names = pa.schema([("path", pa.string()), ("start", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("digest_ok", pa.bool_())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for file, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end")), strict=True):
                members, at = Members(file, start), start
                while (at := members.find(at, end)) >= 0:
                    if (got := members.decode(at)) is None:
                        at += 1
                        continue
                    rows.append({"path": file, "start": at} | parse_record(got[0]))
                    held, at = held + len(got[0]), got[1]
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, names)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", F.col("length"))
    starts = files.filter("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    ranges = starts.select("path", "start", F.least(F.col("start") + range_bytes, F.col("length")).alias("end"))
    dealt = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "start")
    return dealt.mapInArrow(read, READ)


def warc_query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = scratch(spark, "warc")
    written = write_warc(with_revisits(pages), path).agg(F.sum("records")).first()[0]
    if not written:
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    records = read_warc(spark, path)
    return records.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
  q AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM q
"""
