"""Pages as WARC archives, written and read by way of an index.

**Writing.**  Each task streams its pages into archives of its own (one gzip
member a record, a new archive after ``archive_bytes``) in a shared folder, and
returns one index row a record: archive, offset, length, URL, digest, id, type.
Spark writes these rows as Parquet.  The index is what commits: an archive of a
lost or repeated task attempt has a name of its own that no index row mentions,
so every page is in exactly one indexed record whatever tasks were run again.

Of pages with equal payloads of at least ``revisit_bytes`` bytes the one with
the smallest id is a ``response`` record; the others are ``revisit`` records
that refer to it and hold no payload.  Which payloads repeat is counted first by
digest (a map-side aggregate of narrow rows); only the repeated digests are
joined with the pages.  They are broadcast while there are at most
``BROADCAST_DIGESTS`` of them, else joined by a shuffle that adaptive execution
splits; in the usual case no payload is shuffled at all.

**Reading.**  Reading starts from index rows (all or a selection).  They are
range-partitioned and sorted by archive and offset; a task joins neighbouring
byte ranges into one read (gaps up to ``gap`` bytes are read over, a read has
about ``most`` bytes) and cuts the records out of it.  Each payload is checked
against the digest in its header.

Nulls: a null text is the empty payload; a null URL has no header line; a null
id is written as the empty id and, where its payload is repeated by pages with
ids, it is a revisit.  Repeated rows: rows with the smallest id itself are all
responses.  Very long payloads are one record each and held one at a time (with
its compressed form).  Other columns, whatever their names, are not written.
Empty tables give an empty index and no records.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campanula.session import checkpoint_dir, materialize, shuffle_partitions

from .common import whole_text

BROADCAST_DIGESTS = 300_000
READ_TASK_BYTES = 128 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NEWLINE = b"\r\n"

INDEX_SCHEMA = T.StructType([
    T.StructField("archive", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("url", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("page_id", T.StringType()),
    T.StructField("record_type", T.StringType())])

RECORD_SCHEMA = T.StructType([
    T.StructField("page_id", T.StringType()), T.StructField("url", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("refers_to", T.StringType()), T.StructField("payload", T.BinaryType())])


def open_store(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder (local, HDFS, object store) and the path on it."""
    if ":" not in folder:
        folder = "file://" + os.path.abspath(folder)
    folder = re.sub(r"^file:/+", "file:///", folder)
    folder = re.sub(r"^s3[an]:", "s3:", folder)
    return pafs.FileSystem.from_uri(folder.rstrip("/"))


# -- one record --------------------------------------------------------------

def _record_id(page_id: str | None, digest: str) -> str:
    return f"<urn:x-page:{quote(page_id or '', safe='')}:{'-' if page_id is None else digest[:16]}>"


def _page_of(record_id: str) -> str | None:
    page_id, mark = record_id.strip("<>").split(":")[2:4]
    return None if mark == "-" else unquote(page_id)


def _header_url(url: str) -> str:
    """A URL fit for a header line: white space and control characters as %XX."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _lines(first: str, fields: dict[str, object]) -> bytes:
    return "".join([first, *(f"\r\n{k}: {v}" for k, v in fields.items() if v is not None)]).encode("utf-8", "replace") + 2 * _NEWLINE


def record_bytes(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One response record, or a revisit record where ``refers_to`` names a page."""
    http = _lines("HTTP/1.1 200 OK", {"Content-Type": "text/html; charset=utf-8", "Content-Length": len(payload)})
    block = http if refers_to is not None else http + payload
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": _record_id(page_id, digest),
        "WARC-Date": date, "WARC-Target-URI": None if url is None else _header_url(url),
        "WARC-Payload-Digest": f"sha256:{digest}", "WARC-Profile": None if refers_to is None else REVISIT_PROFILE,
        "WARC-Refers-To": None if refers_to is None else _record_id(refers_to, digest),
        "Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    return _lines("WARC/1.1", head) + block + 2 * _NEWLINE


def parse_record(data: bytes) -> dict:
    """The fields of one uncompressed record; a damaged one is an error."""
    head, _, rest = data.partition(2 * _NEWLINE)
    version, *lines = head.decode("utf-8").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if not version.startswith("WARC/") or rest[size:] != 2 * _NEWLINE:
        raise ValueError("damaged record")
    out = {"record_type": fields["WARC-Type"], "url": fields.get("WARC-Target-URI")}
    if out["record_type"] not in ("response", "revisit"):
        return out
    http, _, payload = rest[:size].partition(2 * _NEWLINE)
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    out |= {"page_id": _page_of(fields["WARC-Record-ID"]), "payload_digest": digest, "refers_to": None, "payload": None,
            "payload_bytes": int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])}
    if out["record_type"] == "revisit":
        out["refers_to"] = _page_of(fields["WARC-Refers-To"])
    else:
        out["payload"] = payload
        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != out["payload_bytes"]:
            raise ValueError("payload does not match its digest")
    return out


def _gzip(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


# -- writing -----------------------------------------------------------------

def with_record_types(pages: DataFrame, id_col: str, revisit_bytes: int) -> DataFrame:
    """``pages`` (with ``__digest`` and ``__bytes``) and ``__refers_to``: the id of the response, null for responses."""
    copies = materialize(pages.where(F.col("__bytes") >= revisit_bytes).groupBy("__digest")
                         .agg(F.min(id_col).alias("__first"), F.count(F.lit(1)).alias("__n"))
                         .where("__n > 1").drop("__n"))
    if copies.count() <= BROADCAST_DIGESTS:
        copies = F.broadcast(copies)
    later = F.col("__first").isNotNull() & (F.col(id_col).isNull() | (F.col(id_col) > F.col("__first")))
    return pages.join(copies, "__digest", "left").withColumn("__refers_to", F.when(later, F.col("__first"))).drop("__first")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   revisit_bytes: int = 100, archive_bytes: int = 256 << 20, level: int = 6,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write all pages as archives below ``folder``; returns the index, a table at ``folder/index``."""
    rows = pages.select(F.col(id_col), F.col(url_col).cast("string").alias("__url"), whole_text(html_col).cast("binary").alias("__payload"))
    rows = rows.withColumn("__digest", F.sha2("__payload", 256)).withColumn("__bytes", F.octet_length("__payload"))
    rows = with_record_types(rows, id_col, revisit_bytes).select(
        F.col(id_col).cast("string"), "__url", "__payload", "__digest", F.col("__refers_to").cast("string"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        out, name, size = None, None, 0
        try:
            for batch in batches:
                index: list[tuple] = []
                for i in range(batch.num_rows):
                    page_id, url, payload, digest, refers_to = (c[i].as_py() for c in batch.columns)
                    if out is None or size >= archive_bytes:
                        if out is not None:
                            out.close()
                        store.create_dir(f"{root}/archives", recursive=True)
                        name, size = f"archives/{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    data = _gzip(record_bytes(page_id, url, payload, digest, refers_to, date), level)
                    out.write(data)
                    index.append((name, size, len(data), url, digest, page_id, "response" if refers_to is None else "revisit"))
                    size += len(data)
                yield _batch(index, INDEX_SCHEMA)
        finally:
            if out is not None:
                out.close()

    path = f"{folder.rstrip('/')}/index"
    rows.mapInArrow(write, INDEX_SCHEMA).write.mode("errorifexists").parquet(path)
    return pages.sparkSession.read.schema(INDEX_SCHEMA).parquet(path)


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[f.dataType.simpleString()]) for c, f in zip(columns, schema)], names=schema.names)


# -- reading -----------------------------------------------------------------

def joined_ranges(rows: list[tuple[str, int, int]], gap: int, most: int) -> Iterator[list[tuple[str, int, int]]]:
    """Sorted (archive, offset, length) rows cut into groups of one read each."""
    group: list[tuple[str, int, int]] = []
    end = 0
    for archive, offset, length in rows:
        if group and (archive != group[0][0] or offset > end + gap or offset + length - group[0][1] > most):
            yield group
            group = []
        end = max(end, offset + length) if group else offset + length
        group.append((archive, offset, length))
    if group:
        yield group


def read_records(index: DataFrame, folder: str, payload: bool = True, gap: int = 64 << 10, most: int = 8 << 20) -> DataFrame:
    """The records of the given index rows, by joined byte-range reads.

    ``index`` is what ``write_archives`` returned, or any selection of its rows.
    A revisit has a null payload (see ``whole_records``); ``payload=False``
    checks payloads but leaves them out.
    """
    total = index.agg(F.sum("length")).first()[0] or 0
    parts = max(shuffle_partitions(index.sparkSession), -(-total // READ_TASK_BYTES))
    schema = RECORD_SCHEMA if payload else T.StructType(RECORD_SCHEMA.fields[:-1])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        name, source = None, None
        out: list[tuple] = []
        held = 0
        for batch in batches:
            for group in joined_ranges(list(zip(*(c.to_pylist() for c in batch.columns))), gap, most):
                if group[0][0] != name:
                    name = group[0][0]
                    source = store.open_input_file(f"{root}/{name}")
                start = group[0][1]
                data = source.read_at(max(o + n for _, o, n in group) - start, start)
                for _, offset, length in group:
                    try:
                        record = parse_record(zlib.decompress(data[offset - start:offset - start + length], 31))
                    except (ValueError, zlib.error, KeyError, IndexError) as e:
                        raise ValueError(f"{name} at {offset}: {e}") from e
                    out.append(tuple(record.get(f) for f in schema.names))
                    held += len(record.get("payload") or b"") if payload else 0
                    if held >= 4 * most or len(out) >= 4096:
                        yield _batch(out, schema)
                        out, held = [], 0
        yield _batch(out, schema)

    rows = index.select("archive", "offset", "length").repartitionByRange(int(parts), "archive", "offset") \
                .sortWithinPartitions("archive", "offset")
    return rows.mapInArrow(read, schema)


def whole_records(index: DataFrame, selected: DataFrame, folder: str) -> DataFrame:
    """Records of the selected index rows, revisits with the payload of the record they refer to."""
    wanted = selected.where(F.col("record_type") == "revisit").select("digest").distinct()
    place = F.struct("archive", "offset", "length")
    originals = (index.where(F.col("record_type") == "response").join(wanted, "digest", "left_semi")
                 .groupBy("digest").agg(F.min(place).alias("p")).select("p.*"))
    payloads = read_records(originals, folder).select("payload_digest", F.col("payload").alias("__payload"))
    records = read_records(selected, folder)
    return (records.join(payloads, "payload_digest", "left")
            .withColumn("payload", F.coalesce("payload", "__payload")).select(*RECORD_SCHEMA.names))


def archive_digest(spark: SparkSession, pages: DataFrame, folder: str | None = None, id_col: str = "page_id") -> DataFrame:
    """Write all pages, read all records back and report what the archives say."""
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/campanula_warc/{uuid.uuid4().hex}"
    kind = pages.schema[id_col].dataType
    index = write_archives(pages, folder, id_col=id_col)
    return read_records(index, folder, payload=False).select(
        F.col("page_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))


def oracle_sql() -> str:
    return """
WITH p AS (SELECT page_id, COALESCE(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM d),
r AS (SELECT *, first_id IS NOT NULL AND (page_id IS NULL OR page_id > first_id) AS again FROM f)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first_id END AS refers_to
FROM r"""
