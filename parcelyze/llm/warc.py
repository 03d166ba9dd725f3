"""A deterministic, sharded WARC writer and its reader.

Pages are range-partitioned and sorted by id (rows with one id: by payload
digest). Every task streams its pages into files of one gzip member per record and
starts a new file once the compressed size passes ``file_bytes``; headers, record
ids and digests are computed anew from the payload, so the same pages give the
same bytes. Files are written under temporary names and committed with a manifest
(see ``files``).

Of records with equal payloads of at least ``least`` bytes the one with the
largest id is a response and the others revisit it. Which ones do so is worked
out on ids and digests alone; a mark per revisiting page is then sorted in front
of the page, so the pages are shuffled once and joined with nothing.

A NULL payload is empty. Rows with a NULL id are responses and nothing refers to
them; rows that repeat a response (same id, same payload) are responses too.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files
from .common import materialize, row_slices

_CRLF = b"\r\n"
#: Fixed value: the WARC/1.1 profile of a revisit with the same payload.
_SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uri(text) -> str:
    """A header value on one line."""
    return " ".join((text or "urn:unknown").split()) or "urn:unknown"


def record_id(page_id, digest: str, n: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{digest}|{n}')}>"


def _record(fields: list, block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    raw = head.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + _CRLF * 2
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def page_record(page_id, url, payload: bytes, digest: str, refers_to, date: str, n: int = 0) -> bytes:
    """A response, or a revisit of page ``refers_to`` that keeps the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    return _record([
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest, n)),
        ("WARC-Date", date), ("WARC-Target-URI", _uri(url)), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
        ("WARC-Profile", None if refers_to is None else _SAME_PAYLOAD),
        ("WARC-Refers-To", None if refers_to is None else record_id(refers_to, digest, 0)),
        ("Page-Id", page_id), ("Refers-To-Page-Id", refers_to)], block)


def info_record(date: str, software: str = "parcelyze") -> bytes:
    block = f"software: {software}\r\nformat: WARC File Format 1.1\r\n".encode()
    return _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("info", software, 0)),
                    ("WARC-Date", date), ("Content-Type", "application/warc-fields")], block)


def revisits(pages: DataFrame, least: int) -> DataFrame:
    """(id, digest, refers_to) of the pages that revisit another one."""
    d = (pages.filter(F.col("id").isNotNull() & (F.octet_length("payload") >= least))
         .select("id", F.sha1("payload").alias("digest")))
    last = d.groupBy("digest").agg(F.max("id").alias("refers_to"), F.min("id").alias("low")).filter("low < refers_to")
    return (d.join(last.select("digest", "refers_to"), "digest").filter("id < refers_to")
            .select("id", "digest", "refers_to").distinct())


def write(pages: DataFrame, folder: str, id_col="page_id", url_col="url", payload_col="html", least: int = 1000,
          file_bytes: int = 16 << 20, date: str = "2000-01-01T00:00:00Z") -> list:
    """Write the archives into ``folder``; returns the manifest. Runs two jobs."""
    p = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    marks = materialize(revisits(p, least), "warc-revisits")
    rows = p.withColumn("digest", F.sha1("payload")).withColumn("refers_to", F.lit(None).cast("long"))
    every = rows.unionByName(marks, allowMissingColumns=True)
    ordered = every.repartitionByRange("id", "digest").sortWithinPartitions(
        "id", "digest", F.col("refers_to").asc_nulls_last())

    def run(batches):
        fs, root = files.resolve(folder)
        part, out, done, mark, last, n = TaskContext.get().partitionId(), None, [], None, None, 0

        def shut():
            out.close()
            done.append((part, len(done), name, records, size))
        for whole in batches:
            for b in row_slices(whole, "payload", 4 << 20):
                for page, url, payload, digest, refers in zip(
                        *(b.column(c).to_pylist() for c in ("id", "url", "payload", "digest", "refers_to"))):
                    if refers is not None:
                        mark = (page, digest, refers)
                        continue
                    n = n + 1 if last == (page, digest) else 0          # repeated rows get ids of their own
                    last = (page, digest)
                    to = mark[2] if mark is not None and mark[:2] == (page, digest) else None
                    if out is None:
                        name, records = files.temporary_name(".warc.gz"), 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                        head = info_record(date)
                        out.write(head)
                        size = len(head)
                    raw = page_record(page, url, payload, digest, to, date, n)
                    out.write(raw)
                    records, size = records + 1, size + len(raw)
                    if size >= file_bytes:
                        shut()
                        out = None
        if out is not None:
            shut()
        cols = list(zip(*done)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                                         names=["part", "seq", "temporary", "records", "bytes"])

    listed = ordered.select("id", "url", "payload", "digest", "refers_to").mapInArrow(
        run, "part long, seq long, temporary string, records long, bytes long").collect()      # one row per file
    return files.commit(folder, [
        {**r.asDict(), "name": f"pages-{r['part']:06d}-{r['seq']:04d}.warc.gz"}
        for r in sorted(listed, key=lambda r: (r["part"], r["seq"]))])


def _members(f, step: int = 1 << 20):
    """The uncompressed gzip members of a file, one at a time."""
    rest, z, got = b"", zlib.decompressobj(31), []
    while True:
        if not rest:
            rest = f.read(step)
            if not rest:
                if got:
                    raise ValueError("a record ends in mid-member")
                return
        got.append(z.decompress(rest))
        rest = z.unused_data
        if z.eof:
            yield b"".join(got)
            z, got = zlib.decompressobj(31), []


def parse(raw: bytes):
    """(header fields, block) of one record."""
    at = raw.index(_CRLF * 2)
    lines = raw[:at].decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = raw[at + 4:at + 4 + int(fields["Content-Length"])]
    if not lines[0].startswith("WARC/") or raw[at + 4 + len(block):] != _CRLF * 2:
        raise ValueError("not a WARC record")
    return fields, block


def read(spark, folder: str) -> DataFrame:
    """One row per page record of the committed archives: page_id, record_type,
    refers_to, payload_bytes, payload_digest, payload (NULL for a revisit). Digests
    are checked; a damaged record is an error."""
    schema = "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    names = [(e["name"],) for e in files.manifest(folder)]
    if not names:
        return spark.createDataFrame([], schema)

    def run(batches):
        fs, root = files.resolve(folder)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        cols = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=cols)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as f:
                    for fields, block in map(parse, _members(f)):
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        at = block.index(_CRLF * 2) + 4
                        size = int(dict(x.split(": ", 1) for x in block[:at - 4].decode().split("\r\n")[1:])["Content-Length"])
                        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                        payload = block[at:] if kind == "response" else None
                        if payload is not None and (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
                            raise ValueError(f"digest of {fields['WARC-Record-ID']} in {name}")
                        page, to = fields.get("Page-Id"), fields.get("Refers-To-Page-Id")
                        rows.append((None if page is None else int(page), kind, None if to is None else int(to),
                                     size, digest, payload))
                        held += len(block)
                        if held > 4 << 20:
                            yield out(rows)
                            rows, held = [], 0
                if rows:
                    yield out(rows)

    return spark.createDataFrame(names, "name string").repartition(len(names)).mapInArrow(run, schema)
