"""WARC archives as tables of payload chunks.

No step holds a whole record.  ``chunk_table`` gives a row for every ``CHUNK``
bytes of a payload (record number, chunk number, bytes, where they start, the
SHA-1 of the payload up to and with this chunk, carried from row to row, and
whether the payload ends here), so the last row of a record has its length
and digest.  ``verdicts`` compares those last rows: of records with equal
payloads (length and SHA-1) of ``least`` bytes or more the one with the
largest id is a response and the others revisit it; a null id is smaller than
any other, and of equal ids the first row is the response.

``write_archives`` gathers the chunks of responses and a single row for each
revisit by record, in order, and every task streams them into archives of
about ``ARCHIVE`` bytes (WARC/1.1; a gzip member for each record), which it
closes between records.  The rows that it returns name the archives; only
those of finished tasks are listed, so what a lost task left behind is never
read.  ``read_chunks`` streams the archives back into the same chunk rows,
digests computed anew, and fails where one differs from the record's header.

Archives are opened by pyarrow's file systems below ``spark.checkpoint.dir``
or a folder that is given (local paths, file:, hdfs:, s3:, gs:).

Defined results: a null payload is empty; a null url is left out; repeated
rows are records of their own; other columns are ignored; an empty table
gives no archives and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propval.llm.store import written
from propval.session import ensure_checkpoint_dir

CHUNK = 8192                               # bytes of payload in a row: 10,000 rows of an Arrow batch stay below 100 MB
READ = 1 << 16                             # bytes read from an archive at once
ARCHIVE = 1 << 28
DATE = "1970-01-01T00:00:00Z"              # of records whose table has no date
MOST_HEAD = 1 << 20                        # a header block that is longer is damaged

# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_chunks(df: DataFrame, payload: str, kept: list[str]) -> DataFrame:
    """df's columns ``kept`` and ``record``, with a row for every chunk of the
    payload, those of a record together and in order."""
    body = F.encode(F.coalesce(payload, F.lit("")), "UTF-8") if dict(df.dtypes)[payload] == "string" else F.coalesce(payload, F.lit(b""))
    rows = df.select(F.monotonically_increasing_id().alias("record"), *kept, body.alias("_body"))
    last = F.floor((F.greatest(F.octet_length("_body"), F.lit(1)) - 1) / CHUNK).cast("long")
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("chunk")
    return rows.select("*", F.octet_length("_body").cast("long").alias("_size"), chunk).select(
        "record", *kept, "chunk", (F.col("chunk") * CHUNK).alias("start"),
        F.expr(f"substring(_body, cast(chunk * {CHUNK} as int) + 1, {CHUNK})").alias("data"),
        (F.col("chunk") == F.floor((F.greatest("_size", F.lit(1)) - 1) / CHUNK)).alias("last"))


def with_digests(chunks: DataFrame) -> DataFrame:
    """chunks with the SHA-1 of each record's payload so far: one running
    digest a task, whose rows have each record's chunks together and in order."""
    def run(batches):
        running = hashlib.sha1()
        for batch in batches:
            digests = []
            for n, data in zip(batch.column("chunk").to_pylist(), batch.column("data"), strict=True):
                if n == 0:
                    running = hashlib.sha1()
                running.update(data.as_buffer())
                digests.append(running.digest())
            yield batch.append_column("sha1", pa.array(digests, pa.binary()))
    return chunks.mapInArrow(run, T.StructType([*chunks.schema.fields, T.StructField("sha1", T.BinaryType())]))


def chunk_table(df: DataFrame, payload: str, kept: list[str]) -> DataFrame:
    """The chunk rows of df's payloads, written; records are numbered."""
    return written(with_digests(payload_chunks(df, payload, kept)))


def verdicts(chunks: DataFrame, record_id: str, least: int) -> DataFrame:
    """For every record of the chunk table: payload_bytes, sha1, record_type
    and, for a revisit, the record and id that it refers to."""
    heads = chunks.where("last").select("record", F.col(record_id).alias("id"), (F.col("start") + F.octet_length("data")).alias("payload_bytes"), "sha1")
    leaders = written(heads.where(F.col("payload_bytes") >= least).groupBy("sha1", "payload_bytes").agg(
        F.max(F.struct("id", (-F.col("record")).alias("back"))).alias("one")))
    one = leaders.select("sha1", "payload_bytes", (-F.col("one.back")).alias("to_record"), F.col("one.id").alias("to_id"))
    both = heads.join(one, ["sha1", "payload_bytes"], "left")
    is_revisit = F.coalesce(F.col("to_record") != F.col("record"), F.lit(False))
    return both.select("record", "id", "payload_bytes", "sha1", F.when(is_revisit, "revisit").otherwise("response").alias("record_type"),
                       F.when(is_revisit, F.col("to_record")).alias("to_record"), F.when(is_revisit, F.col("to_id")).alias("to_id"))


def _uri(record: int, record_id) -> str:
    """Names a record by its number and its table's id (none if that is null)."""
    return f"<urn:record:{record}{'' if record_id is None else ':' + urllib.parse.quote(str(record_id), safe='')}>"


_URI = re.compile(r"<urn:record:(\d+)(?::([^>]*))?>")


def _of_uri(uri: str) -> tuple[int, str | None]:
    found = _URI.fullmatch(uri)
    return int(found[1]), None if found[2] is None else urllib.parse.unquote(found[2])


def _base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record_head(row: dict) -> bytes:
    """The WARC header and the HTTP header of a record."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['payload_bytes']}\r\n\r\n").encode()
    body = row["payload_bytes"] if row["record_type"] == "response" else 0
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", _uri(row["record"], row["id"])), ("WARC-Date", DATE)]
    if row["url"] is not None:                             # control characters and blanks can't stand in a header
        fields.append(("WARC-Target-URI", urllib.parse.quote(row["url"], safe="%:/?#[]@!$&'()*+,;=~-._")))
    fields += [("WARC-Payload-Digest", "sha1:" + _base32(row["sha1"])), ("Content-Type", "application/http; msgtype=response"),
               ("Content-Length", len(http) + body)]
    if row["record_type"] == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _uri(row["to_record"], row["to_id"]))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + http


def _folder(folder: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(folder if re.match(r"\w+:", folder) else f"file://{folder}")
    system.create_dir(path, recursive=True)
    return system, path


class _Archive:
    """An archive that is being written: a gzip member for each record."""

    def __init__(self, system: fs.FileSystem, path: str):
        self.path, self.records, self.bytes = path, 0, 0
        self.file, self.member = system.open_output_stream(path, compression=None), None

    def _put(self, data: bytes) -> None:
        self.bytes += len(data)
        self.file.write(data)

    def begin(self, head: bytes) -> None:
        self.member = zlib.compressobj(6, zlib.DEFLATED, 31)
        self.records += 1
        self._put(self.member.compress(head))

    def add(self, data: pa.Buffer) -> None:
        self._put(self.member.compress(data))

    def end(self) -> None:
        self._put(self.member.compress(b"\r\n\r\n") + self.member.flush())


ARCHIVES = "path string, records long, bytes long"


def write_archives(chunks: DataFrame, of_record: DataFrame, folder: str | None = None) -> DataFrame:
    """(path, records, bytes) of the archives, written; chunks has the column
    ``url``, of_record is ``verdicts``."""
    spark: SparkSession = chunks.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/archives/{uuid.uuid4().hex}"
    most = ARCHIVE
    rows = chunks.select("record", "chunk", "url", "data", "last").join(of_record, "record").where("record_type = 'response' or last")
    rows = rows.withColumn("data", F.when(F.col("record_type") == "response", F.col("data"))).sortWithinPartitions("record", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, archive, system, at, path, open_record = [], None, None, None, None, None

        def closed():
            archive.file.close()
            return archive.path, archive.records, archive.bytes
        for batch in batches:
            heads = batch.drop_columns(["data"])
            record, last = batch.column("record").to_pylist(), batch.column("last").to_pylist()
            for i, data in enumerate(batch.column("data")):
                if record[i] != open_record:
                    if archive is not None and archive.bytes >= most:
                        done.append(closed())
                        archive = None
                    if archive is None:
                        if system is None:
                            system, at = _folder(folder)
                        path = f"{at}/{uuid.uuid4().hex}.warc.gz"          # a name of its own for each attempt of a task
                        archive = _Archive(system, path)
                    archive.begin(record_head({c: heads.column(c)[i].as_py() for c in heads.schema.names}))
                    open_record = record[i]
                if data.is_valid:
                    archive.add(data.as_buffer())
                if last[i]:
                    archive.end()
                    open_record = None
        if archive is not None:
            done.append(closed())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=["path", "records", "bytes"])
    return written(rows.mapInArrow(run, ARCHIVES).withColumn("folder", F.lit(folder)))


class _Members:
    """The bytes of an archive's gzip members, one after the other, as a
    stream that never holds more than READ bytes and a header block."""

    def __init__(self, file):
        self.file, self.raw, self.held = file, b"", bytearray()
        self.member, self.started = zlib.decompressobj(31), False

    def more(self) -> bool:
        """Appends up to READ bytes; false at the end of the archive."""
        while True:
            if not self.raw:
                self.raw = bytes(self.file.read(READ))
                if not self.raw:
                    if self.member.eof or not self.started:
                        return False
                    raise ValueError("the archive ends within a record")
            if self.member.eof:
                self.member = zlib.decompressobj(31)
            self.started = True
            out = self.member.decompress(self.raw, READ)
            self.raw = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            if out:
                self.held += out
                return True

    def block(self) -> bytes | None:
        """Up to and with the next empty line; none at the end."""
        at = 0
        while (to := self.held.find(b"\r\n\r\n", max(0, at - 3))) < 0:
            at = len(self.held)
            if at > MOST_HEAD:
                raise ValueError("a header block has no end")
            if not self.more():
                if at:
                    raise ValueError("the archive ends within a header")
                return None
        out = bytes(self.held[:to + 4])
        del self.held[:to + 4]
        return out

    def take(self, most: int) -> bytes:
        """The next bytes, exactly ``most``."""
        while len(self.held) < most:
            if not self.more():
                raise ValueError("the archive ends within a record")
        out = bytes(self.held[:most])
        del self.held[:most]
        return out


def _fields(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8").split("\r\n")[1:-2]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def records(file) -> Iterator[tuple[dict, int, int, bytes, bytes, bool]]:
    """(head, chunk number, start, data, SHA-1 so far, last) of every chunk of
    every record of an open archive; a revisit has one chunk without data."""
    stream = _Members(file)
    while (block := stream.block()) is not None:
        if not block.startswith(b"WARC/1."):
            raise ValueError(f"no record begins with {block[:20]!r}")
        head = _fields(block)
        http = stream.block() or b""
        left = int(head["content-length"]) - len(http)
        head["payload-length"] = _fields(http)["content-length"]
        running, chunk, start = hashlib.sha1(), 0, 0
        while left or not chunk:
            data = stream.take(min(left, CHUNK))
            running.update(data)
            left -= len(data)
            yield head, chunk, start, data, running.digest(), not left
            chunk, start = chunk + 1, start + len(data)
        if head["warc-type"] == "response" and "sha1:" + _base32(running.digest()) != head["warc-payload-digest"]:
            raise ValueError(f"the payload of {head['warc-record-id']} differs from its digest")
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError(f"{head['warc-record-id']} has no end")


READ_ROWS = ("record long, id string, url string, record_type string, to_record long, to_id string, payload_bytes long, "
             "payload_digest string, chunk long, start long, data binary, sha1 binary, last boolean")


def read_chunks(archives: DataFrame, data: bool = True) -> DataFrame:
    """The chunk rows of all records of the archives (``write_archives``), with
    the heads of their records; without ``data`` only each record's last row,
    its data null.  Ids are text."""
    names = [c.split()[0] for c in READ_ROWS.split(", ")]
    schema = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}[c.split()[1]])
                        for n, c in zip(names, READ_ROWS.split(", "), strict=True)])

    def rows(path, folder):
        system, _ = _folder(folder)
        with system.open_input_stream(path, compression=None) as file:
            for head, chunk, start, body, sha1, last in records(file):
                if not (data or last):
                    continue
                record, own_id = _of_uri(head["warc-record-id"])
                to_record, to_id = _of_uri(head["warc-refers-to"]) if "warc-refers-to" in head else (None, None)
                yield (record, own_id, head.get("warc-target-uri"), head["warc-type"], to_record, to_id, int(head["payload-length"]),
                       head["warc-payload-digest"].removeprefix("sha1:"), chunk, start, body if data else None, sha1, last)

    def run(batches):
        held = []
        for batch in batches:
            for path, folder in zip(batch.column("path").to_pylist(), batch.column("folder").to_pylist(), strict=True):
                for row in rows(path, folder):
                    held.append(row)
                    if len(held) == 1024:
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
                        held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
    one_each = archives.select("path", "folder").repartition(max(1, archives.count()), "path")      # archives are large: one a task
    return one_each.mapInArrow(run, READ_ROWS)


def archived(df: DataFrame, record_id: str, url: str, payload: str, least: int = 0, folder: str | None = None) -> DataFrame:
    """Writes df as archives; their paths.  Payloads of less than ``least``
    bytes are never revisits."""
    named = df.select(F.col(record_id).alias("id"), F.col(url).alias("url"), F.col(payload).alias("payload"))
    chunks = chunk_table(named, "payload", ["id", "url"])
    return write_archives(chunks, written(verdicts(chunks, "id", least)), folder)


def pages_digest(pages: DataFrame) -> DataFrame:
    """What the archives of a table of pages give back, a row for each page."""
    heads = read_chunks(archived(pages, "page_id", "url", "html"), data=False)
    kind = dict(pages.dtypes)["page_id"]
    return heads.select(F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("to_id").cast(kind).alias("refers_to"))


ORACLE = """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
groups AS (
  SELECT page_id, payload_bytes, ('0x' || unnest([hex[1:5], hex[6:10], hex[11:15], hex[16:20], hex[21:25], hex[26:30], hex[31:35], hex[36:40]]))::INT AS v,
    unnest(range(8)) AS nth, hex FROM hashed),
letters AS (
  SELECT page_id, payload_bytes, hex, string_agg(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(v >> 15) + 1] || 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((v >> 10) & 31) + 1]
    || 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((v >> 5) & 31) + 1] || 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(v & 31) + 1], '' ORDER BY nth) AS payload_digest
  FROM groups GROUP BY page_id, payload_bytes, hex),
named AS (SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS one FROM letters)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = one THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = one THEN NULL ELSE one END AS refers_to
FROM named
"""
