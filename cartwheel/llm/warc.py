"""WARC archives: a writer that stores equal payloads once, and a splittable reader.

Writer: each task writes archives of gzip members, one record a member, under names of its own in a
shared folder, and reports them in a manifest. Only archives in the manifest count, so files of a
task that was lost or run twice are never read.

Reader: archives are cut into byte ranges. The task of a range looks for the gzip magic from the
range's start, and takes a position for a member only if it inflates without fault to a record whose
headers decode and whose length is as declared. It owns the records that start inside its range and
reads the last one to its end. Positions of false magic bytes are passed over.

Cases: null html is an empty payload; null url leaves out the target; null page_id is kept; of
repeated rows (same page_id, equal payload) one is the response and the others revisit it; equal
payloads under one page_id with different urls go to the largest url; other columns are not read;
an empty table gives no archive and an empty result. One record at a time is held in memory.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel.llm.common import record, slices, stage
from cartwheel.session import scratch_path

# Fixed values of the two formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
EOL = b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ID = "urn:page:"
ROLL = 256 << 20
RANGE = 4 << 20
BLOCK = 1 << 20


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id, url, payload: bytes | None, digest: str, size: int, refers_to) -> bytes:
    """One gzip member: a response, or a revisit if ``payload`` is None."""
    kind = "revisit" if payload is None else "response"
    http = EOL.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
                     b"Content-Length: %d" % size, b"", b""])
    block = http + (payload or b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{ID}{page_id}>"),
            ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("X-Payload-Length", str(size)), ("Content-Length", str(len(block))),
            ("Content-Type", "application/http;msgtype=response")]
    if url is not None:
        head.append(("WARC-Target-URI",
                     url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")))
    if payload is None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{ID}{refers_to}>")]
    data = VERSION + EOL + b"".join(f"{k}: {v}".encode() + EOL for k, v in head) + EOL + block
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data + EOL + EOL) + pack.flush()


def parse_record(data: bytes) -> tuple[dict, bytes] | None:
    """(headers, block) of an inflated member, or None if it isn't a whole record."""
    end = data.find(EOL + EOL)
    if not data.startswith(b"WARC/1.") or end < 0:
        return None
    head: dict[str, str] = {}
    for line in data[:end].split(EOL)[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        try:
            head[name.decode("ascii").lower()] = value.strip().decode("utf-8")
        except UnicodeDecodeError:
            return None
    length = head.get("content-length", "")
    if "warc-type" not in head or not length.isdigit() \
            or len(data) != end + 4 + int(length) + 4 or not data.endswith(EOL + EOL):
        return None
    return head, data[end + 4:-4]


def plan_records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest (hex), size, refers_to of every record to write.

    Pages meet by digest as narrow rows; a payload is moved only if it is a response, by its page.
    """
    full = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    # one string names a row's page, payload and url, so that joins and groups share a shuffle
    full = full.withColumn("digest", F.sha1("payload")).withColumn("key", F.sha2(F.concat_ws(
        "|", F.coalesce(F.col("page_id").cast("string"), F.lit("")), "digest",
        F.when(F.col("url").isNull(), "").otherwise(F.concat(F.lit("="), "url"))), 256))
    narrow = (full.select("key", "page_id", "url", "digest",
                          F.octet_length("payload").cast("long").alias("size"))
              .groupBy("key").agg(*[F.first(c).alias(c) for c in ("page_id", "url", "digest",
                                                                  "size")],
                                  F.count("*").alias("times")))
    copies = (narrow.groupBy("digest")
              .agg(F.max(F.struct("page_id", "url")).alias("kept"), F.sum("times").alias("all"))
              .filter("all > 1").select("digest", "kept"))
    decided = stage(narrow.join(copies, "digest", "left").withColumn(
        "is_kept", F.col("kept").isNull()
        | F.col("kept").eqNullSafe(F.struct("page_id", "url"))), "warc-plan")
    keep = decided.filter("is_kept")
    same = ["page_id", "url", "digest", "size"]
    bodies = (full.select("key", "payload").join(keep.select("key", *same), "key").groupBy("key")
              .agg(F.first("payload").alias("payload"), *[F.first(c).alias(c) for c in same])
              .select(*same, "payload", F.lit(None).cast("long").alias("refers_to"),
                      F.lit(False).alias("revisit")))
    again = F.col("times") - F.when(F.col("is_kept"), 1).otherwise(0)
    revisits = (decided.filter(again > 0)
                .select(*same, F.lit(None).cast("binary").alias("payload"),
                        F.coalesce(F.col("kept")["page_id"], F.col("page_id")).alias("refers_to"),
                        F.explode(F.sequence(F.lit(1), again.cast("int"))).alias("n"))
                .withColumn("revisit", F.lit(True)).drop("n"))
    return bodies.unionByName(revisits)


def write_archives(records: DataFrame, folder: str, roll: int = ROLL) -> DataFrame:
    """Writes the rows of ``plan_records``; the manifest: path, bytes, records."""
    schema = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        out, size, rows, name = None, 0, 0, ""
        for batch in slices(batches, 64):
            for r in batch.to_pylist():
                if out is None:
                    name, size, rows = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                digest = base64.b32encode(bytes.fromhex(r["digest"])).decode()
                data = record_bytes(r["page_id"], r["url"],
                                    None if r["revisit"] else r["payload"] or b"",
                                    digest, r["size"], r["refers_to"])
                out.write(data)
                size, rows = size + len(data), rows + 1
                if size >= roll:
                    out.close()
                    yield record(schema, [[f"{folder}/{name}"], [size], [rows]])
                    out = None
        if out is not None:
            out.close()
            yield record(schema, [[f"{folder}/{name}"], [size], [rows]])

    return stage(records.mapInArrow(write, "path string, bytes long, records long"), "manifest")


class _Blocks:
    """Bytes of an open file by position, read in blocks."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.data = file, size, 0, b""

    def get(self, at: int) -> bytes:
        """Some bytes from ``at`` on; empty at the end of the file."""
        if not self.at <= at < self.at + len(self.data):
            self.file.seek(at)
            self.at, self.data = at, self.file.read(min(BLOCK, max(0, self.size - at)))
        return self.data[at - self.at:]

    def find_magic(self, at: int, end: int) -> int:
        """First position in [at, end) where the magic starts, or -1."""
        while at < end:
            data = self.get(at)
            if len(data) < len(MAGIC):
                self.file.seek(at)
                self.at, self.data = at, self.file.read(min(BLOCK, self.size - at))
                data = self.data
                if len(data) < len(MAGIC):
                    return -1
            found = data.find(MAGIC)
            if found >= 0:
                return at + found if at + found < end else -1
            at += len(data) - len(MAGIC) + 1
        return -1

    def member(self, at: int) -> tuple[dict, bytes, int] | None:
        """The record of the member at a position and the position behind it, if it is one."""
        inflate, parts, begin = zlib.decompressobj(31), [], at
        try:
            while not inflate.eof:
                data = self.get(at)
                if not data:
                    return None
                parts.append(inflate.decompress(data))
                at += len(data) - len(inflate.unused_data)
                if len(parts) == 1 and not VERSION.startswith(parts[0][:7]):
                    return None
        except zlib.error:
            return None
        parsed = parse_record(b"".join(parts))
        return None if parsed is None or at == begin else (*parsed, at)


def records_in_range(file, size: int, begin: int, end: int) -> Iterator[tuple[int, dict, bytes]]:
    """(position, headers, block) of the records that start in [begin, end)."""
    blocks = _Blocks(file, size)
    at = begin
    while (at := blocks.find_magic(at, min(end, size))) >= 0:
        found = blocks.member(at)
        if found is None:
            at += 1
        else:
            yield at, found[0], found[1]
            at = found[2]


def read_archives(spark: SparkSession, manifest: DataFrame, split: int = RANGE) -> DataFrame:
    """page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to per record."""
    total = manifest.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    tasks = max(1, min(total // (32 << 20) + spark.sparkContext.defaultParallelism, 100_000))
    ranges = (manifest.select("path", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)),
        F.lit(split).cast("long"))).alias("begin")).repartition(int(tasks), "path", "begin"))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64())])

    def number(value: str | None):
        value = (value or "").strip("<>").removeprefix(ID)
        return int(value) if value.lstrip("-").isdigit() else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                store, path = pafs.FileSystem.from_uri(r["path"])
                rows, held = [], 0
                with store.open_input_file(path) as file:
                    for _, head, block in records_in_range(file, r["bytes"], r["begin"],
                                                           r["begin"] + split):
                        revisit = head["warc-type"] == "revisit"
                        payload = None if revisit else block[block.find(EOL + EOL) + 4:]
                        url = head.get("warc-target-uri")
                        rows.append((
                            number(head.get("warc-record-id")), url and url.replace(
                                "%0D", "\r").replace("%0A", "\n").replace("%25", "%"),
                            head["warc-type"], payload,
                            int(head["x-payload-length"]) if revisit else len(payload),
                            head["warc-payload-digest"].removeprefix("sha1:") if revisit
                            else base32_sha1(payload),
                            number(head.get("warc-refers-to"))))
                        held += len(block)
                        if held > 8 << 20 or len(rows) >= 512:
                            yield record(schema, [list(c) for c in zip(*rows)])
                            rows, held = [], 0
                if rows:
                    yield record(schema, [list(c) for c in zip(*rows)])

    return ranges.mapInArrow(read, "page_id long, url string, record_type string, payload binary, "
                                   "payload_bytes long, payload_digest string, refers_to long")


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with scheme and host. A bare path means the cluster's default file system, as it
    does for tables written by Spark, and not each machine's own disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return file_uri(path.makeQualified(store.getUri(), store.getWorkingDirectory()).toString())


def file_uri(folder: str) -> str:
    """``file:/x`` as ``file:///x``, the form that other libraries read; others as they are."""
    return f"file://{folder[5:]}" if folder.startswith("file:/") and not folder.startswith(
        "file://") else folder


def write_and_read(pages: DataFrame, split: int = RANGE) -> DataFrame:
    """Writes an archive record per page to the shared folder and reads all of them back."""
    spark = pages.sparkSession
    folder = qualified(spark, scratch_path(spark, "warc"))
    # the manifest's table is made first and with it the folder
    spark.createDataFrame([], "path string").write.parquet(f"{folder}/made")
    manifest = write_archives(plan_records(pages), folder)
    return read_archives(spark, manifest, split)
