"""WARC archives: written by Spark, indexed first, read by byte ranges.

Every record is a gzip member of its own, so an archive is one valid
multi-member gzip file.  The task that has a record appends it to its open
archive, and begins another before one would pass its bounded size.  The
offset of a record is the running sum of the lengths before it: the same task
returns the index (archive, offset, length, URL, digest per record), which
needs no second read.  Spark commits the index, and the archives are those
that it names: every attempt of a task writes files of its own, so what a lost
or repeated attempt left is in no index.  Payloads cross one shuffle,
compressed, and are stored in the archives alone.
A read takes selected index rows, sorts their ranges by archive and offset,
joins ranges with small gaps and reads each joined range once.

Defined results: null html is an empty payload, a null url the empty URL;
of records with equal payloads the one with the smallest page_id is the
response (rows that tie on it are responses each; so are rows whose group
has no page_id), others are revisits without a payload.  Extra columns are
ignored, an empty table gives no record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .common import arrow_rows, materialise, shared_path, ship

ARCHIVE_BYTES = 64 << 20      # of an archive at most (a longer record is an archive alone)
READ_BLOCK = 8 << 20          # ranges of one block of an archive are read by one task
GAP = 64 << 10                # smaller gaps between wanted ranges are read through
RUN = 8 << 20                 # longest joined range (a single record may be longer)
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
LEVEL = 4                     # of compression

INDEX = "archive string, offset long, length long, url string, payload_digest string, page_id long, record_type string"
READ = ("page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, "
        "refers_to long, digest_ok boolean")


def base32_of_hex(hexed: Column) -> Column:
    """Base 32 (RFC 4648, upper case) of a 40-digit SHA-1: five hex digits
    are four base-32 digits."""
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


@F.arrow_udf(BinaryType())
def _packed(html: pa.Array) -> pa.Array:
    return pa.array([zlib.compress(x.as_py().encode(), 1) for x in html], pa.binary())


def _member(head: str, packed: bytes | None) -> bytes:
    """The gzip member of a record: its head, then the payload if it has one."""
    payload = b"" if packed is None else zlib.decompress(packed)
    return gzip.compress(head.encode() + payload + END.encode(), LEVEL, mtime=0)


def records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Record metadata per page, and the payload of the responses.

    Which record is the response is settled on light rows (id, URL, digest,
    size).  Payloads are thinned to one per digest before they are shuffled,
    then joined to the responses alone.  Payloads below ``min_revisit_bytes``
    are never referred to and stay with their rows."""
    key = ["payload_digest", "payload_bytes"]
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("html").cast("long"),
                             "payload_digest": base32_of_hex(F.sha1(F.col("html").cast("binary")))})
    small = F.col("payload_bytes") < min_revisit_bytes
    light = materialise(rows.where(~small).select("page_id", "url", *key), "warc-light")
    # written: read back it has no partitioning of its own, so adaptive execution may split a payload that many pages share
    firsts = materialise(light.groupBy(*key).agg(F.min("page_id").alias("first_id")), "warc-firsts")
    revisit = F.coalesce(F.col("page_id") > F.col("first_id"), F.col("page_id").isNull() & F.col("first_id").isNotNull())
    typed = materialise(light.join(firsts, key, "left").select(
        "page_id", "url", *key, F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to")), "warc-typed")
    packed = rows.withColumn("packed", _packed("html"))
    payloads = packed.where(~small).groupBy(*key).agg(F.first("packed").alias("packed"))
    names = ["page_id", "url", "packed", *key, "record_type", "refers_to"]
    out = (typed.where("record_type = 'response'").join(payloads, key).select(*names)
           .unionByName(typed.where("record_type = 'revisit'").withColumn("packed", F.lit(None).cast("binary")).select(*names)))
    if min_revisit_bytes > 0:
        own = {"record_type": F.lit("response"), "refers_to": F.lit(None).cast("long")}
        out = out.unionByName(packed.where(small).withColumns(own).select(*names))
    return out


def _urn(page: Column) -> Column:
    text = F.md5(F.concat(F.lit("page "), F.coalesce(page.cast("string"), F.lit("-"))).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(text, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def http_head() -> Column:
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))


def _kept_bytes() -> Column:
    return F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(F.lit(0))


def record_head(date: str = DATE) -> Column:
    """A record up to its payload.  Line ends inside a URL are
    percent-encoded, so a header stays one line."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", _urn(F.col("page_id"))),
        line("WARC-Date", F.lit(date)), line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(F.col("record_type") == "response", F.lit("")).otherwise(F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
            line("WARC-Refers-To", _urn(F.col("refers_to"))),
            line("X-Refers-To-Page", F.col("refers_to").cast("string")))),
        line("X-Page", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.octet_length(http_head()) + _kept_bytes()).cast("string")), F.lit("\r\n"), http_head())


def _store(path: str) -> tuple:
    """The file system of a path as Spark names it, and the path there."""
    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _writer(folder: str, archive_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Appends a partition's records to archives of its own; returns their index rows."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        names = [x.split()[0] for x in INDEX.split(", ")]
        file, name, end = None, "", 0
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                spots = []
                for head, packed in zip(batch.column("head"), batch.column("packed")):
                    member = _member(head.as_py(), packed.as_py())
                    if file is None or end + len(member) > archive_bytes:
                        if file is not None:
                            file.close()
                        name, end = f"{uuid.uuid4().hex}.warc.gz", 0
                        file = store.open_output_stream(f"{root}/{name}", compression=None)     # members are compressed already
                    file.write(member)
                    spots.append((f"{folder}/{name}", end, len(member)))
                    end += len(member)
                own = [pa.array(c, k) for c, k in zip(zip(*spots), (pa.string(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([*own, *map(batch.column, names[3:])], names=names)
        finally:
            if file is not None:
                file.close()

    return write


def write_archives(pages: DataFrame, min_revisit_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives; returns the index: archive, offset, length, url,
    payload_digest, page_id, record_type."""
    spark = pages.sparkSession
    ship(spark)
    root = shared_path(spark, "warc")
    made = (records(pages, min_revisit_bytes).withColumn("head", record_head())
            .select("head", "packed", "url", "payload_digest", "page_id", "record_type"))
    arrow_rows(INDEX, _writer(f"{root}/archives", archive_bytes), made).write.parquet(f"{root}/index")
    return spark.read.schema(INDEX).parquet(f"{root}/index")


def joined_ranges(ranges: list[tuple[int, int]], gap: int = GAP, run: int = RUN) -> list[tuple[int, int, list[int]]]:
    """Sorted (offset, length) ranges -> (offset, length, members)."""
    out: list[tuple[int, int, list[int]]] = []
    for k, (offset, length) in enumerate(ranges):
        if out and offset - (out[-1][0] + out[-1][1]) <= gap and offset + length - out[-1][0] <= run:
            first, had, members = out[-1]
            members.append(k)
            out[-1] = (first, max(had, offset + length - first), members)
        else:
            out.append((offset, length, [k]))
    return out


def parse_record(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no record at this offset")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(http.rpartition(b"Content-Length: ")[2])
    response = fields["WARC-Type"] == "response"
    own = base64.b32encode(hashlib.sha1(payload).digest()).decode() if response else digest
    page, refers = fields["X-Page"], fields.get("X-Refers-To-Page")
    return (int(page) if page else None, fields["WARC-Target-URI"], fields["WARC-Type"], payload if response else None,
            len(payload) if response else size, own, int(refers) if refers else None, own == digest)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    names = [x.split()[0] for x in READ.split(", ")]
    for batch in batches:
        archives = np.asarray(batch.column("archive").to_pylist(), dtype=object)
        offsets, lengths = batch.column("offset").to_pylist(), batch.column("length").to_pylist()
        for archive in dict.fromkeys(archives.tolist()):
            rows = np.flatnonzero(archives == archive).tolist()
            rows.sort(key=offsets.__getitem__)
            store, path = _store(archive)
            with store.open_input_file(path) as file:
                for first, size, members in joined_ranges([(offsets[r], lengths[r]) for r in rows]):
                    data = file.read_at(size, first)
                    found = [parse_record(gzip.decompress(data[offsets[r] - first:offsets[r] - first + lengths[r]]))
                             for r in (rows[m] for m in members)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)


def read_records(index: DataFrame) -> DataFrame:
    """The records of the given index rows, whatever selection they are."""
    spots = index.select("archive", "offset", "length", F.floor(F.col("offset") / READ_BLOCK).alias("block"))
    size = index.agg(F.sum("length").alias("n")).first().n or 0
    spots = (spots.repartition(max(1, math.ceil(size / READ_BLOCK)), "archive", "block")
             .sortWithinPartitions("archive", "block", "offset"))
    return arrow_rows(READ, _read, spots.select("archive", "offset", "length"))
