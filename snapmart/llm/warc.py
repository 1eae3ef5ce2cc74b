"""WARC archives of web pages, and a normaliser for archives that are one gzip stream.

Random access to a WARC file needs every record to be a gzip member of its own. Writers that send a whole
file through one compressor (monolithic files) break that. The normaliser inflates such a file once from
front to back, writes every record as its own member into a new file, and beside it a sidecar index with
the offset and length of each member. Records are held one at a time, so files may be of any size.

``archive_pages`` is the whole way: pages are written as monolithic files, one or more a task; payloads that
occur again are found over all files by their SHA-256 (the response is the record with the smallest page id,
the others revisit it); the normaliser turns those into revisit records while it rewrites them.
``read_archives`` reads the archives back, record by record through the index, and checks each.

Files are written by tasks through the file system that their address names, under names no other attempt
uses. Which files count is what the written tables (committed by Spark) say; a lost or doubled attempt leaves
files that nothing refers to. Equal payloads meet as (digest, smallest record) only. A digest that holds over
a thousandth of all records is joined by broadcast (at most 1,000 rows), so no task gets a hot payload's records.

Defined results: null html is an empty payload. A null page id counts as the largest; a response or revisit of
a page with a null id has a null there. Rows that repeat id and payload are records each, one of them the
response. Columns other than the id, the address and the html are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import stored
from snapmart.session import scratch_path

#: Payloads below this many bytes are never revisits.
LEAST_BYTES = 100
#: A monolithic file is closed after this many bytes of records.
ROLL_BYTES = 128_000_000
#: Bytes inflated at a time.
STEP = 1 << 20
LEVEL = 6
#: A digest is hot with more than one in this many of the records.
HOT_SHARE = 1000
DATE = "1970-01-01T00:00:00Z"
#: Fixed values of the format.
VERSION, GAP, END = b"WARC/1.1", b"\r\n\r\n", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_COLUMNS = "file string, ordinal bigint, page_id string, payload_digest string, payload_bytes bigint"
ARCHIVE_COLUMNS = "archive string, sidecar string, records bigint"


def file_system(address: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system and path of an address (``file:/x``, ``hdfs://...``, or a plain path)."""
    return arrow_fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", address))


# -- records -------------------------------------------------------------------------------------

def record_id(page_id, file: str, ordinal: int) -> str:
    """Names the page and the place where the record was first written."""
    page = "" if page_id is None else quote(str(page_id), safe="")
    return f"<urn:page:{page}:{file.rsplit('/', 1)[-1].removesuffix('.warc.gz')}:{ordinal}>"


def page_of(name: str | None) -> str | None:
    return unquote(name.split(":")[2]) or None if name else None


def record(kind: str, name: str, url: str | None, digest: str, block: bytes, date: str = DATE,
           more: dict[str, str] | None = None) -> bytes:
    fields = {"WARC-Type": kind, "WARC-Record-ID": name, "WARC-Date": date}
    if url:
        fields["WARC-Target-URI"] = re.sub(r"[\r\n\0]", lambda m: quote(m[0]), url)
    fields |= {"WARC-Payload-Digest": digest, **(more or {}), "Content-Type": "application/http;msgtype=response",
               "Content-Length": str(len(block))}
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode() + b"\r\n"
    return head + block + END


def http_head(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()


def fields_of(head: bytes) -> dict[str, str]:
    """Names in lower case; a line that starts with a space continues the one before."""
    lines = re.sub(rb"\r\n[ \t]+", b" ", head).decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def revisit_of(head: bytes, block: bytes, refers_to: str) -> bytes:
    """The revisit record that takes a response's place: its own headers, no payload."""
    f = fields_of(head)
    return record("revisit", f["warc-record-id"], f.get("warc-target-uri"), f["warc-payload-digest"],
                  block[:block.index(GAP) + len(GAP)], f["warc-date"],
                  {"WARC-Profile": PROFILE, "WARC-Refers-To": refers_to})


def inflated(file) -> Iterator[bytes]:
    """The content of a gzip file in steps, whether it is one member or many."""
    gzip, data = zlib.decompressobj(31), b""
    fresh = True
    while data or (data := file.read(STEP)):
        out = gzip.decompress(data, STEP)
        fresh = False
        if out:
            yield out
        data = gzip.unconsumed_tail
        if gzip.eof:
            data, gzip, fresh = gzip.unused_data, zlib.decompressobj(31), True
    if not fresh:
        while out := gzip.decompress(gzip.unconsumed_tail, STEP):
            yield out
        if not gzip.eof:
            raise ValueError("the gzip stream ends early")


class Records:
    """(head, block) of the records of a byte stream, one after another."""

    def __init__(self, steps: Iterator[bytes]):
        self.steps, self.held = steps, bytearray()

    def fill(self, size: int) -> bool:
        while len(self.held) < size:
            step = next(self.steps, None)
            if step is None:
                return False
            self.held += step
        return True

    def take(self, size: int) -> bytes:
        if not self.fill(size):
            raise ValueError("the archive ends within a record")
        out = bytes(self.held[:size])
        del self.held[:size]
        return out

    def __iter__(self) -> Iterator[tuple[bytes, bytes]]:
        while self.fill(1):
            seen = 0
            while (end := self.held.find(GAP, max(0, seen - len(GAP)))) < 0:
                seen = len(self.held)
                if not self.fill(seen + 1):
                    raise ValueError("the archive ends within a header")
            head = self.take(end + len(GAP))[:end]
            if not head.startswith(b"WARC/"):
                raise ValueError("no WARC record where one should start")
            block = self.take(int(fields_of(head)["content-length"]))
            if self.take(len(END)) != END:
                raise ValueError("a record is longer than its header says")
            yield head, block


# -- writing -------------------------------------------------------------------------------------

def write_monolithic(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, date: str = DATE,
                     id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write every page as a response record into files that are one gzip stream each; one row per record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = None
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                file = file or Monolith(folder)
                payload = (html or "").encode()
                digest = hashlib.sha256(payload).hexdigest()
                name = record_id(page_id, file.address, file.records)
                rows.append((file.address, file.records, page_id, digest, len(payload)))
                file.add(record("response", name, url, f"sha256:{digest}", http_head(len(payload)) + payload, date))
                if file.size >= roll_bytes:
                    file = file.close()
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()])],
                    ["file", "ordinal", "page_id", "payload_digest", "payload_bytes"])
        if file:
            file.close()

    columns = [F.col(id_col).cast("string"), F.col(url_col).cast("string"), F.col(html_col)]
    return stored(pages.select(*columns).mapInArrow(run, RECORD_COLUMNS), "warc_records")


class Monolith:
    """A file that is one gzip stream."""

    def __init__(self, folder: str):
        self.address = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        where, path = file_system(self.address)
        where.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out, self.gzip = where.open_output_stream(path, compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        self.records = self.size = 0

    def add(self, data: bytes) -> None:
        self.out.write(self.gzip.compress(data))
        self.records += 1
        self.size += len(data)

    def close(self) -> None:
        self.out.write(self.gzip.flush())
        self.out.close()


def revisits(records: DataFrame, id_type: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(file, ordinal, refers_to): the records whose payload another record holds as a response."""
    page = F.col("page_id").cast(id_type)
    large = records.where(F.col("payload_bytes") >= least_bytes)
    first = F.min(F.struct(page.isNull().alias("last"), page.alias("page"), F.col("page_id").alias("name"), "file", "ordinal"))
    again = stored(large.groupBy("payload_digest").agg(F.count("*").alias("n"), first.alias("first"))
                   .where("n > 1"), "warc_again")
    total = records.count()
    hot, rest = again.where(F.col("n") * HOT_SHARE > total), again.where(F.col("n") * HOT_SHARE <= total)
    hot = F.broadcast(hot.drop("n"))  # fewer than HOT_SHARE rows
    found = large.join(hot, "payload_digest").unionByName(
        large.join(hot.select("payload_digest"), "payload_digest", "left_anti").join(rest.drop("n"), "payload_digest"))
    own = (F.col("file") == F.col("first.file")) & (F.col("ordinal") == F.col("first.ordinal"))
    return found.where(~own).select(
        "file", "ordinal", F.col("first.name").alias("page"), F.col("first.file").alias("in_file"),
        F.col("first.ordinal").alias("at"))


# -- the normaliser ------------------------------------------------------------------------------

def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite monolithic files with one member a record and a sidecar index each; one row per new file.

    ``files`` has ``file`` and, where records shall become revisits, ``changes``: an array of (ordinal, page,
    in_file, at) of the records and of the responses they refer to.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, changes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                refers = {c["ordinal"]: record_id(c["page"], c["in_file"], c["at"]) for c in changes or ()}
                archive = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                n = rewrite(file, archive, f"{archive}.index", refers)
                yield pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([f"{archive}.index"]), pa.array([n])],
                                                 ["archive", "sidecar", "records"])

    if "changes" not in files.columns:
        files = files.withColumn("changes", F.lit(None).cast(
            "array<struct<ordinal:bigint,page:string,in_file:string,at:bigint>>"))
    each = max(1, files.count())  # a file is a task's work; few rows would else share one task
    return stored(files.select("file", "changes").repartitionByRange(each, "file").mapInArrow(run, ARCHIVE_COLUMNS), "warc_archives")


def rewrite(file: str, archive: str, index: str, refers: dict[int, str]) -> int:
    """One file: inflate it once, write each record as a member and its place into the index."""
    source, path = file_system(file)
    target, to = file_system(archive)
    target.create_dir(to.rsplit("/", 1)[0], recursive=True)
    offset = n = 0
    with source.open_input_stream(path, compression=None) as whole, \
            target.open_output_stream(to, compression=None) as out, \
            target.open_output_stream(file_system(index)[1], compression=None) as places:
        for n, (head, block) in enumerate(Records(inflated(whole)), 1):
            data = revisit_of(head, block, refers[n - 1]) if n - 1 in refers else head + GAP + block + END
            gzip = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            member = gzip.compress(data) + gzip.flush()
            out.write(member)
            f = fields_of(head)
            places.write(json.dumps({"offset": offset, "length": len(member), "id": f.get("warc-record-id"),
                                     "type": "revisit" if n - 1 in refers else f["warc-type"],
                                     "digest": f.get("warc-payload-digest")}).encode() + b"\n")
            offset += len(member)
    return n


# -- reading -------------------------------------------------------------------------------------

def read_index(index: str) -> list[dict]:
    where, path = file_system(index)
    with where.open_input_stream(path, compression=None) as file:
        return [json.loads(line) for line in file.read().splitlines()]


def read_record(file, place: dict) -> tuple[dict[str, str], bytes]:
    """Fields and block of the record at a place of the index, which must be one whole member."""
    file.seek(place["offset"])
    gzip = zlib.decompressobj(31)
    data = gzip.decompress(file.read(place["length"]))
    if not gzip.eof or gzip.unused_data:
        raise ValueError("the index does not give the bounds of a member")
    (head, block), = Records(iter([data]))
    fields = fields_of(head)
    if fields.get("warc-record-id") != place["id"]:
        raise ValueError("the index names another record")
    return fields, block


def read_archives(archives: DataFrame, id_type: str = "bigint") -> DataFrame:
    """One row per response or revisit of normalised archives, each read by itself through the index: page_id,
    payload_bytes, payload_digest, record_type, refers_to, url, html (null in a revisit)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page", "payload_bytes", "payload_digest", "record_type", "refers", "url", "html"]
        types = [pa.string(), pa.int64(), *[pa.string()] * 5]
        for batch in batches:
            for archive, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                where, path = file_system(archive)
                rows, held = [], 0
                with where.open_input_file(path) as file:
                    for place in read_index(index):
                        if place["type"] not in ("response", "revisit"):
                            continue
                        fields, block = read_record(file, place)
                        rows.append(described(fields, block))
                        held += len(block)
                        if held > 8 * STEP:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    read = archives.select("archive", "sidecar").mapInArrow(
        run, "page string, payload_bytes bigint, payload_digest string, record_type string, refers string, "
             "url string, html string")
    return read.select(F.col("page").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers").cast(id_type).alias("refers_to"), "url", "html")


def described(fields: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(GAP)
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    size, kind = int(fields_of(head)["content-length"]), fields["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['warc-record-id']} is not the one that was written")
    return (page_of(fields["warc-record-id"]), size, digest, kind, page_of(fields.get("warc-refers-to")),
            fields.get("warc-target-uri"), payload.decode("utf-8", "replace") if kind == "response" else None)


# -- operator ------------------------------------------------------------------------------------

def archive_pages(pages: DataFrame, folder: str | None = None, least_bytes: int = LEAST_BYTES,
                  roll_bytes: int = ROLL_BYTES, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """Write pages as monolithic files, find equal payloads, and normalise: (archive, sidecar, records)."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    records = write_monolithic(pages, f"{folder}/monolithic", roll_bytes, DATE, id_col, url_col, html_col)
    change = F.struct("ordinal", "page", "in_file", "at")
    changes = revisits(records, pages.schema[id_col].dataType.simpleString(), least_bytes).groupBy("file").agg(
        F.collect_list(change).alias("changes"))  # a file is bounded by roll_bytes
    files = records.groupBy("file").agg(F.max("ordinal").alias("last")).join(changes, "file", "left")
    return normalise(stored(files, "warc_files"), f"{folder}/archives")


def archived_pages(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """Pages written to archives and read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    archives = archive_pages(pages, id_col=id_col, **options)
    return read_archives(archives, pages.schema[id_col].dataType.simpleString()).drop("url", "html")
