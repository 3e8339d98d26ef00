"""WARC archives: a writer, and a Python data source that reads them.

Each record is a gzip member of its own, with the member's length in the extra field that
the WARC standard proposes for skipping. The reader plans whole files, packed into
partitions by size, takes conditions on the record type and on headers, parses the header
of a record first, and passes over the rest of a record that is not wanted without
inflating it.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull

from reelhouse.operators.joins import hot_join

from .common import pick, shared_folder, written
from .files import attempt_name, filesystem

# Names of headers and the extra field of the WARC standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SKIP = b"sl"

SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, payload_digest string, "
    "content_type string, block_bytes long, headers map<string,string>, payload binary"
)
_COLUMNS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest", "content_type": "Content-Type",
}
_READ = 1 << 16


def record(headers: dict[str, str], block: bytes) -> bytes:
    """An uncompressed record."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """``data`` as one gzip member that tells its compressed and its inflated length."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    extra = _SKIP + struct.pack("<HII", 8, 0, 0)
    size = 10 + 2 + len(extra) + len(body) + 8
    extra = _SKIP + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", len(extra))
    return head + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class _Source:
    """A file as a stream of records.

    Of records that are not wanted, ``skipped`` counts bytes of the file that were passed
    over without being read, and ``undecoded`` bytes of the blocks that were not inflated.
    """

    def __init__(self, file, compressed: bool) -> None:
        self.file, self.compressed, self.skipped, self.undecoded = file, compressed, 0, 0
        self.size = file.size()

    def records(self, wanted) -> Iterator[tuple[dict[str, str], bytes | None]]:
        at = 0
        while at < self.size:
            self.file.seek(at)
            part = _Member(self.file, at) if self.compressed else _Plain(self.file, at)
            headers = part.headers()
            if headers is None:
                return
            length = int(headers.get("Content-Length", 0))
            block = part.block(length) if wanted(headers) else None
            if block is None and self.compressed and part.length:
                self.undecoded += length - len(part.data) + part.body
            end = part.end(length)
            if block is None:
                self.skipped += end - part.read_to
            yield headers, block
            at = end


def _parsed(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    out: dict[str, str] = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        out.setdefault(name.strip(), value.strip())
    return out


class _Plain:
    def __init__(self, file, at: int) -> None:
        self.file, self.at, self.data, self.read_to = file, at, b"", at

    def _more(self) -> bool:
        got = self.file.read(_READ)
        self.data += got
        self.read_to += len(got)
        return bool(got)

    def headers(self) -> dict[str, str] | None:
        while (cut := self.data.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.data.strip():
                    raise ValueError("a record's header is cut off")
                return None
        self.body = cut + 4
        return _parsed(self.data[:cut])

    def block(self, length: int) -> bytes:
        while len(self.data) < self.body + length:
            if not self._more():
                raise ValueError("a record is cut off")
        return self.data[self.body : self.body + length]

    def end(self, length: int) -> int:
        return self.at + self.body + length + 4


class _Member:
    def __init__(self, file, at: int) -> None:
        self.file, self.at, self.read_to = file, at, at
        head = self._take(12)
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError("not a gzip member")
        self.length, flags = None, head[3]
        if flags & 4:
            (extra_length,) = struct.unpack_from("<H", head, 10)
            extra, i = self._take(extra_length), 0
            while i + 4 <= len(extra):
                (n,) = struct.unpack_from("<H", extra, i + 2)
                if extra[i : i + 2] == _SKIP and n == 8:
                    self.length = struct.unpack_from("<I", extra, i + 4)[0]
                i += 4 + n
            rest = b""
        else:
            rest = head[10:]
        # Other optional fields are left to the library: it gets the whole member in that case.
        self.raw = zlib.decompressobj(-15) if flags in (0, 4) else zlib.decompressobj(31)
        self.pending = rest
        if flags not in (0, 4):
            self.file.seek(at)
            self.read_to, self.pending, self.length = at, b"", None
        self.trailer = 8 if flags in (0, 4) else 0
        self.data = b""

    def _take(self, n: int) -> bytes:
        got = self.file.read(n)
        self.read_to += len(got)
        return got

    def _more(self, most: int) -> bool:
        if self.raw.eof:
            return False
        if not self.pending:
            want = _READ if self.length is None else min(_READ, self.at + self.length - self.read_to)
            self.pending = self._take(max(1, want))
            if not self.pending:
                raise ValueError("a record is cut off")
        self.data += self.raw.decompress(self.pending, most)
        self.pending = self.raw.unconsumed_tail
        return True

    def headers(self) -> dict[str, str] | None:
        while (cut := self.data.find(b"\r\n\r\n")) < 0:
            if not self._more(2048):
                if self.data.strip():
                    raise ValueError("a record's header is cut off")
                return None
        self.body = cut + 4
        return _parsed(self.data[:cut])

    def block(self, length: int) -> bytes:
        parts, have = [self.data[self.body :]], len(self.data) - self.body
        self.data = b""
        while have < length:
            if not self._more(_READ * 16):
                raise ValueError("a record is cut off")
            parts.append(self.data)
            have += len(self.data)
            self.data = b""
        return b"".join(parts)[:length]

    def end(self, length: int) -> int:
        if self.length:
            return self.at + self.length
        while not self.raw.eof:
            self.data = b""
            self._more(_READ * 16)
        return self.read_to - len(self.raw.unused_data) + self.trailer


@dataclass
class _Files(InputPartition):
    files: list[str]

    def __init__(self, files: list[str]) -> None:
        self.files = files


class WarcSource(DataSource):
    """``spark.read.format("warc")``.

    Options: ``path`` (a folder or file), ``files`` (a JSON list of files in the folder,
    all with a WARC name by default), ``payload`` (``false``: payloads are null and never
    decoded), ``partition_bytes`` (files packed into one partition), ``headers`` (a JSON
    object: the allowed values of each header named, any value if the list is empty).
    With ``pushdown`` (``true``, and ``spark.sql.python.filterPushdown.enabled``) conditions
    of the form ``column = value`` or ``column IN (…)`` on the header columns are taken over
    from the query. Spark then keeps the reader with its conditions, so a DataFrame loaded
    so must serve one query only; ``headers`` has no such effect.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        options = dict(self.options)
        return PushingWarcReader(options) if options.get("pushdown", "false").lower() == "true" else WarcReader(options)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder = options["path"]
        self.names = json.loads(options["files"]) if "files" in options else None
        self.payload = options.get("payload", "true").lower() != "false"
        self.partition_bytes = int(options.get("partition_bytes", 128 << 20))
        self.slices = int(options.get("slices", 1))
        self.allowed = [(h, frozenset(values)) for h, values in json.loads(options.get("headers", "{}")).items()]

    def wanted(self, headers: dict[str, str]) -> bool:
        return all(h in headers and (not values or headers[h] in values) for h, values in self.allowed)

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, path = filesystem(self.folder)
        if self.names is not None:
            infos = store.get_file_info([f"{path}/{n}" for n in self.names])
        elif store.get_file_info(path).type == fs.FileType.File:
            infos = [store.get_file_info(path)]
        else:
            infos = [i for i in store.get_file_info(fs.FileSelector(path)) if i.path.endswith((".warc", ".warc.gz"))]
        out: list[InputPartition] = []
        own, size = [], 0
        most = min(self.partition_bytes, max(1 << 20, sum(i.size for i in infos) // self.slices))
        for info in sorted(infos, key=lambda i: i.path):
            if own and size + info.size > most:
                out.append(_Files(own))
                own, size = [], 0
            own.append(info.path)
            size += info.size
        return [*out, _Files(own)] if own or not out else out

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(self.folder)
        take = self.wanted if self.payload else (lambda headers: False)
        rows, size = [], 0
        for name in partition.files:
            with store.open_input_file(name) as file:
                for headers, block in _Source(file, name.endswith(".gz")).records(take):
                    if not self.wanted(headers):
                        continue
                    payload = None if block is None else payload_of(headers, block)
                    rows.append((headers, payload))
                    size += len(payload or b"") + 500
                    if size > 4 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)


class PushingWarcReader(WarcReader):
    """A reader that also takes conditions over from the query."""

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            header = _COLUMNS.get(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
            if header and isinstance(f, EqualTo) and isinstance(f.value, str):
                self.allowed.append((header, frozenset([f.value])))
            elif header and isinstance(f, In):
                self.allowed.append((header, frozenset(v for v in f.value if v is not None)))
            elif header and isinstance(f, IsNotNull):
                self.allowed.append((header, frozenset()))
            else:
                yield f


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The block without the head of an HTTP message."""
    if headers.get("Content-Type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _batch(rows: list[tuple[dict[str, str], bytes | None]]) -> pa.RecordBatch:
    columns = [pa.array([h.get(name) for h, _ in rows], pa.string()) for name in _COLUMNS.values()]
    columns.append(pa.array([int(h.get("Content-Length", 0)) for h, _ in rows], pa.int64()))
    columns.append(pa.array([list(h.items()) for h, _ in rows], pa.map_(pa.string(), pa.string())))
    columns.append(pa.array([p for _, p in rows], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=[*_COLUMNS, "block_bytes", "headers", "payload"])


# What the heads of the two kinds of records have.
RESPONSES = {"WARC-Type": ["response"]}
REVISITS = {"WARC-Type": ["revisit"], "WARC-Refers-To": []}


@dataclass(frozen=True)
class Archive:
    """``least_revisit`` is the smallest payload, in bytes, that a later record refers to instead of holding it again."""

    least_revisit: int = 100
    date: str = "2000-01-01T00:00:00Z"


def classified(pages: DataFrame, archive: Archive = Archive()) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest`` and ``refers_to`` for each row of ``pages``.

    Of rows with equal payloads of at least ``least_revisit`` bytes, that with the smallest
    id is the response, and the others refer to it; a null id is passed over for the
    smallest and rows that repeat the smallest id are responses too. A null html is empty.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pick(pages, "page_id", "url", "html").select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= archive.least_revisit)
    first = large.groupBy("digest").agg(F.min("page_id").alias("first"))
    found = hot_join(rows, first, ["digest"], "left")
    other = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return found.withColumn("refers_to", F.when(other, F.col("first"))).drop("first")


def write_archives(pages: DataFrame, archive: Archive = Archive()) -> tuple[str, DataFrame]:
    """Write a record for each row of ``pages``; gives the folder, and a table of the files of finished tasks."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    date = archive.date

    def uri(page_id) -> str:
        return f"<urn:page:{'' if page_id is None else page_id}>"

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = filesystem(folder)
        store.create_dir(path, recursive=True)
        name, out, n = attempt_name("pages", TaskContext.get().partitionId(), ".warc.gz"), None, 0
        for part in parts:
            if out is None:
                out = store.open_output_stream(f"{path}/{name}", compression=None)
            for page_id, url, payload, digest, refers_to in zip(*[part[c] for c in ("page_id", "url", "payload", "digest", "refers_to")]):
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
                headers = {
                    "WARC-Type": "response" if refers_to is None else "revisit",
                    "WARC-Record-ID": uri(page_id),
                    "WARC-Date": date,
                    "WARC-Target-URI": " ".join((url or "").split()),
                    "Content-Type": "application/http; msgtype=response",
                    "WARC-Payload-Digest": f"sha256:{digest}",
                    "X-Payload-Length": str(len(payload)),
                }
                if refers_to is not None:
                    headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": uri(refers_to)}
                out.write(member(record(headers, http + (payload if refers_to is None else b""))))
                n += 1
        if out is not None:
            out.close()
            yield pd.DataFrame({"file": [name], "records": [n]})

    rows = classified(pages, archive)
    text = [F.col(c).cast("string").alias(c) for c in ("page_id", "url")]
    rows = rows.select(*text, "payload", "digest", F.col("refers_to").cast("string").alias("refers_to"))
    return folder, written(rows.mapInPandas(write, "file string, records long"), "warc-files")


def read_archives(
    spark: SparkSession, folder: str, files: list[str] | None = None, headers: Mapping[str, list[str]] | None = None, **options: str
) -> DataFrame:
    """The records in ``folder`` whose headers have the values asked for; the others are passed over by the reader.

    Files are read together up to ``partition_bytes``, and less where the session has cores for more tasks.
    """
    spark.dataSource.register(WarcSource)
    reader = spark.read.format("warc").options(**{"slices": str(spark.sparkContext.defaultParallelism), **options})
    if headers is not None:
        reader = reader.option("headers", json.dumps(headers))
    if files is not None:
        reader = reader.option("files", json.dumps(files))
    return reader.load(folder)


def round_trip(pages: DataFrame, archive: Archive = Archive()) -> DataFrame:
    """Write ``pages`` as archives and read them back.

    Gives ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type`` and
    ``refers_to`` for each row. Responses and revisits are two loads, each with a condition
    on the heads that the reader applies before it decodes a payload. Length and digest of a
    response are taken from its payload as read. Revisits are loaded without payloads, so
    the responses between them are passed over undecoded; their heads tell of the full one.
    """
    spark = pages.sparkSession
    folder, files = write_archives(pages, archive)
    names = [r["file"] for r in files.select("file").collect()]  # one per task
    kind = pages.schema["page_id"].dataType
    id_of = lambda uri: F.nullif(F.regexp_extract(uri, "^<urn:page:(.*)>$", 1), F.lit("")).cast(kind)
    responses = read_archives(spark, folder, names, RESPONSES).select(
        id_of(F.col("record_id")).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        F.lit(None).cast(kind).alias("refers_to"),
    )
    revisits = read_archives(spark, folder, names, REVISITS, payload="false").select(
        id_of(F.col("record_id")).alias("page_id"),
        F.col("headers")["X-Payload-Length"].cast("long").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"),
        "record_type",
        id_of(F.col("refers_to")).alias("refers_to"),
    )
    return responses.unionByName(revisits)
