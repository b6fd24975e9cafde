"""WARC: one gzip member a record, written by executors and read back record by record."""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import new_place, parts_for, settings

#: Payloads under this many bytes are never revisited.
LEAST_BYTES = 100
#: An archive is closed once it holds this many compressed bytes.
ARCHIVE_BYTES = 16 << 20
#: Every record bears one date, so that archives of equal pages are equal.
DATE = "2024-01-01T00:00:00Z"
CRLF = b"\r\n"

READ = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("payload", T.BinaryType()),
])


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record as one gzip member. A revisit has no payload; its length and digest stay in the header."""
    url = "".join((url or "").split())
    name = uuid.uuid5(uuid.NAMESPACE_OID, f"{page_id}\n{url}\n{digest}\n{refers_to}")
    block = b"" if refers_to is not None else payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {DATE}"]
    head += [f"WARC-Target-URI: {url}"] * bool(url) + [f"WARC-Page-ID: {page_id}"] * (page_id is not None)
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To-Page-ID: {refers_to}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: text/html", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + CRLF * 2 + block + CRLF * 2) + packer.flush()


def members(stream: BinaryIO, step: int = 1 << 16) -> Iterator[bytes]:
    """The gzip members of an archive, read and inflated step by step."""
    rest = stream.read(step)
    while rest:
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if not rest:
                raise ValueError("the archive ends within a gzip member")
            parts.append(inflate.decompress(rest))
            rest = inflate.unused_data if inflate.eof else stream.read(step)
        yield b"".join(parts)
        rest = rest or stream.read(step)


def parse_record(member: bytes) -> tuple:
    """A row of READ. Raises ValueError if framing or digest is wrong."""
    head, mark, rest = member.partition(CRLF * 2)
    lines = head.decode().split("\r\n")
    if not mark or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    length = int(fields["Content-Length"])
    if rest[length:] != CRLF * 2:
        raise ValueError("the block isn't as long as Content-Length says")
    payload, digest = rest[:length], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind, full = fields["WARC-Type"], int(fields["WARC-Payload-Length"])
    if kind == "response" and (full != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("the payload isn't what its digest says")
    number = lambda k: int(fields[k]) if k in fields else None
    return number("WARC-Page-ID"), fields.get("WARC-Target-URI"), kind, number("WARC-Refers-To-Page-ID"), full, digest, payload if kind == "response" else None


def planned(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, refers_to: equal payloads are found by their digest; only
    digests that occur twice are joined back, as a skewed join that adaptive execution splits."""
    own = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha2("payload", 256))
    first = own.where(F.length("payload") >= LEAST_BYTES).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("digest_"), "first_id")
    return own.join(first, own.digest == F.col("digest_"), "left").select("page_id", "url", "payload", "digest", F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first_id")), F.col("first_id")).alias("refers_to"))


def write_warc(pages: DataFrame, place: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for every page (page_id, url, html) into archives under place, and return a
    table of the archives (path, records). Of equal payloads of LEAST_BYTES or more the smallest
    page_id is the response and the others revisit it; rows that repeat that very page_id are
    responses too. Null html is an empty payload; null page_id and null url leave their field out
    (a null page_id is never the smallest). Every task attempt writes under a name of its own, and
    only archives of attempts that Spark commits are listed, so lost executors leave no doubles."""
    spark = pages.sparkSession
    folder = f"{place}/archives"
    spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(folder))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        stem, done, out, size, n, made = f"{root}/part-{task.partitionId():06d}-{task.taskAttemptId()}", [], None, 0, 0, 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")), strict=True):
                if out is None:
                    out = store.open_output_stream(f"{stem}-{made:05d}.warc.gz", compression=None)
                data = record_bytes(*row)
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{stem}-{made:05d}.warc.gz", n))
                    out, size, n, made = None, 0, 0, made + 1
        if out is not None:
            out.close()
            done.append((f"{stem}-{made:05d}.warc.gz", n))
        yield pa.RecordBatch.from_arrays([pa.array([x.rsplit("/", 1)[1] for x, _ in done], pa.string()), pa.array([k for _, k in done], pa.int64())], ["name", "records"])

    with settings(spark):
        planned(pages).mapInArrow(write, "name string, records long").write.parquet(f"{place}/manifest")
    return spark.read.schema("name string, records long").parquet(f"{place}/manifest").select(F.concat(F.lit(f"{folder}/"), "name").alias("path"), "records")


SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
#: Rows, and bytes of payload, that the reader gives back at once.
MOST_ROWS, MOST_BYTES = 500, 4 << 20


def parsed(stream: BinaryIO, payloads: bool) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    held = 0
    for member in members(stream):
        row = parse_record(member)
        rows.append(row if payloads else (*row[:-1], None))
        held += len(rows[-1][-1] or b"")
        if len(rows) >= MOST_ROWS or held >= MOST_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SCHEMA, strict=True)], schema=SCHEMA)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SCHEMA, strict=True)], schema=SCHEMA)


def read_warc(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """A row of READ for every record of the archives (path, as write_warc() lists them); executors
    open the archives themselves, so neither names nor records pass through the driver. A broken frame
    or digest fails the job. Without payloads that column is null, and only headers leave the reader."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for path in batch.column(0):
                store, name = fs.FileSystem.from_uri(path.as_py())
                with store.open_input_stream(name, compression=None) as stream:
                    yield from parsed(stream, payloads)

    return archives.select("path").repartition(parts_for(archives.sparkSession), "path").mapInArrow(read, READ)


def read_folder(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """read_warc() of all *.warc.gz under a folder in any store that Spark reads: Spark opens the
    archives, and each is held as a whole while it is read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                yield from parsed(io.BytesIO(data.as_py()), payloads)

    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.warc.gz").load(folder).select("content").mapInArrow(read, READ)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Archive pages, read the archives back, and return what the reader found, a row a page. An
    empty table makes no archive and gives no rows; columns other than page_id, url and html are
    not looked at."""
    listed = write_warc(pages, new_place(pages.sparkSession, "warc"))
    return read_warc(listed, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
