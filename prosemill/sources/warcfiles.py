"""WARC files as a Spark data source: read in several tasks a file, by ranges that an index names, and written with an index.

A compressed WARC file is a row of gzip members, one a record. So a file can be cut at any byte: a task takes the members
that begin in its part, the first of them found by the mark of a member whose content begins as a record does. Files are
reached through pyarrow, by path or URI, on the executors; the driver only lists them.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from prosemill.session import ship

SCHEMA = "filename string, offset long, length long, warc_type string, url string, warc_date string, payload binary"
_ARROW = pa.schema([("filename", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("warc_type", pa.string()), ("url", pa.string()), ("warc_date", pa.string()), ("payload", pa.binary())])
_MEMBER = b"\x1f\x8b\x08"
_STEP = 1 << 18
_BATCH = 4 << 20
_HEADER = 1 << 20  # bytes; a longer header is none


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or of a local path, and the path in it."""
    return fs.FileSystem.from_uri(path) if re.match(r"[A-Za-z][\w+.-]*:", path) else (fs.LocalFileSystem(), path)


class Member:
    """The content of one gzip member, inflated as it is read; end is known when all of it was."""

    def __init__(self, file, at: int, data: bytes = b""):
        """data: what was read of the file from at on."""
        self.file, self.at, self.end = file, at, None
        self.inflater, self.data, self.fed = zlib.decompressobj(31), data, at + len(data)

    def read(self, n: int) -> bytes:
        out = []
        while n > 0 and self.end is None:
            data = self.data or self.inflater.unconsumed_tail
            self.data = b""
            if not data:
                self.file.seek(self.fed)
                data = self.file.read(_STEP)
                self.fed += len(data)
                if not data:
                    raise zlib.error("the member is cut off")
            out.append(self.inflater.decompress(data, n))
            n -= len(out[-1])
            if self.inflater.eof:
                self.end = self.fed - len(self.inflater.unused_data)
        return b"".join(out)

    def following(self) -> Member | None:
        """The member that begins where this one ends, from what was read already."""
        if self.end is None:
            return None
        data = self.inflater.unused_data
        if len(data) < len(_MEMBER):
            self.file.seek(self.end)
            data = self.file.read(_STEP)
        return Member(self.file, self.end, data) if data.startswith(_MEMBER) else None


def next_member(file, at: int, end: int) -> int | None:
    """Where the first member of a record begins, from at on and before end."""
    while at < end:
        file.seek(at)
        data = file.read(min(_STEP, end - at) + len(_MEMBER) - 1)
        k = data.find(_MEMBER)
        while k >= 0:
            try:
                if Member(file, at + k).read(5) == b"WARC/":
                    return at + k
            except zlib.error:
                pass
            k = data.find(_MEMBER, k + 1)
        at += _STEP
    return None


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-cased name, payload) of each record of a stream; what ends early or has no length is an error."""
    rest = b""
    while True:
        rest = rest.lstrip(b"\r\n")
        while not (head := re.search(rb"\r?\n\r?\n", rest)):
            if len(rest) >= 5 and not rest.startswith(b"WARC/") or len(rest) > _HEADER:
                raise ValueError("not a record")
            more = stream.read(1 << 16)
            if not more:
                break
            rest = (rest + more).lstrip(b"\r\n")
        if not head:
            if rest.strip():
                raise ValueError("a record ends in its header")
            return
        first, *lines = rest[: head.start()].decode("utf-8", "replace").splitlines()
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        if not first.startswith("WARC/") or not fields.get("content-length", "").isdigit():
            raise ValueError("not a record")
        size = int(fields["content-length"])
        parts, have = [rest[head.end() : head.end() + size]], min(size, len(rest) - head.end())
        rest = rest[head.end() + size :]
        while have < size:
            more = stream.read(size - have)
            if not more:
                raise ValueError("a record ends in its payload")
            parts.append(more)
            have += len(more)
        yield fields, b"".join(parts)


def _row(filename: str, offset: int, length: int | None, fields: dict[str, str], payload: bytes) -> tuple:
    return filename, offset, length, fields.get("warc-type"), fields.get("warc-target-uri"), fields.get("warc-date"), payload


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches of about 4 MB, so that a few long records don't pile up."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1]) + 256
        if size >= _BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _ARROW.types)], schema=_ARROW)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _ARROW.types)], schema=_ARROW)


def _of_stream(filename: str, at: int, stream, types: frozenset | None, lenient: bool) -> Iterator[tuple]:
    """Rows of a member or a plain file. The length is the member's if the record is alone in it, else null."""
    first, n = None, 0
    try:
        for fields, payload in records(stream):
            if first:
                yield first
                first = None
            n += 1
            if types is None or fields.get("warc-type") in types:
                row = _row(filename, at, None, fields, payload)
                if n > 1:
                    yield row
                else:
                    first = row
    except (ValueError, zlib.error) as e:
        if not lenient:
            raise ValueError(f"{filename} at {at}: {e}") from e
    if first:
        yield _row(filename, at, stream.end - at if getattr(stream, "end", None) else None, {}, b"")[:3] + first[3:]


@dataclass
class Part(InputPartition):
    filename: str
    start: int
    end: int


class WarcReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        if "path" not in options:
            raise ValueError("warc: load() needs a path")
        self.path = options["path"]
        self.split = int(options.get("splitBytes", 64 << 20))
        self.types = frozenset(options["types"].split(",")) if options.get("types") else None
        self.lenient = options.get("mode", "FAILFAST").upper() == "DROPMALFORMED"

    def partitions(self) -> list[Part]:
        """Parts of splitBytes of each compressed file (0: whole files); other files are read whole. Hidden files are none."""
        system, path = _opened(self.path)
        found = system.get_file_info(path)
        if found.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [found] if found.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path, recursive=True))
        out = []
        for f in sorted(files, key=lambda f: f.path):
            below = f.path[len(path) :] if f is not found else f.base_name
            if f.type != fs.FileType.File or re.search(r"(^|/)[_.]", below.lstrip("/")) or not re.search(r"\.(warc|wet|wat)(\.gz)?$", f.path):
                continue
            step = self.split if self.split > 0 and f.path.endswith(".gz") else max(1, f.size)
            out += [Part(f.path, a, min(f.size, a + step)) for a in range(0, f.size, step)]
        return out

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        return _batches(self._rows(part))

    def _rows(self, part: Part | None) -> Iterator[tuple]:
        if part is None:  # a source without files
            return
        with _opened(self.path)[0].open_input_file(part.filename) as file:
            if not part.filename.endswith(".gz"):
                yield from _of_stream(part.filename, 0, file, self.types, self.lenient)
                return
            at = 0 if part.start == 0 and not self.lenient else next_member(file, part.start, part.end)
            member = None if at is None else Member(file, at)
            while member and member.at < part.end:
                at = member.at
                yield from _of_stream(part.filename, at, member, self.types, self.lenient)
                # After a damaged member, or bytes that are none, the next is looked for.
                whole, member = member.end, member.following()
                if member is None and (at := next_member(file, whole or at + 1, part.end)) is not None:
                    member = Member(file, at)


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceWriter):
    """One file a task, with an index (JSON lines) beside it; both have hidden names until the job commits."""

    def __init__(self, options: Mapping[str, str]):
        self.path = options["path"]

    def write(self, rows) -> Written:
        system, root = _opened(self.path)
        system.create_dir(root, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        at, lines = 0, []
        with system.open_output_stream(f"{root}/_{name}", compression=None) as out:
            for row in rows:
                r = row.asDict()
                payload = bytes(r["payload"] or b"")
                fields = {"WARC-Type": r["warc_type"], "WARC-Target-URI": r["url"], "WARC-Date": r["warc_date"], "Content-Length": len(payload)}
                # A line end in a field would end the field; one is a space.
                head = "".join(f"{k}: {re.sub(r'[\r\n]+', ' ', str(v))}\r\n" for k, v in fields.items() if v is not None)
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = packer.compress(b"WARC/1.0\r\n" + head.encode() + b"\r\n" + payload + b"\r\n\r\n") + packer.flush()
                out.write(data)
                if r["warc_type"] == "response":
                    stamp = re.sub(r"\D", "", r["warc_date"] or "")[:14]
                    lines.append(json.dumps({"url": r["url"], "timestamp": stamp, "status": "200", "mime": "text/html", "filename": name, "offset": str(at), "length": str(len(data))}))
                at += len(data)
        with system.open_output_stream(f"{root}/_{name}.index", compression=None) as out:
            out.write("".join(line + "\n" for line in lines).encode())
        return Written([name, f"{name}.index"])

    def _each(self, messages, act) -> None:
        system, root = _opened(self.path)
        for m in messages:
            for name in m.names if m else []:
                act(system, f"{root}/_{name}", f"{root}/{name}")

    def commit(self, messages) -> None:
        self._each(messages, lambda system, hidden, name: system.move(hidden, name))

    def abort(self, messages) -> None:
        self._each(messages, lambda system, hidden, _: system.delete_file(hidden))


class WarcSource(DataSource):
    """Options: path; splitBytes (64 MB; 0: whole files); types (record types, by comma); mode (FAILFAST, DROPMALFORMED).

    Rows: file, place and length of the member (length null where unknown), type, URL, date, payload. A file whose
    records hold whole compressed WARC files needs splitBytes 0, as a cut inside such a record would find the inner ones.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("warc: only append")
        return WarcWriter(self.options)


def read_warc(spark: SparkSession, path: str, **options) -> DataFrame:
    """Records of WARC files at path.

    Give wanted record types as types, so that others make no rows. Tests in the query aren't handed to the reader: Spark
    keeps what one query pushed into a Python source for all other queries on the same frame (seen in 4.1), which would lose rows.
    """
    ship(spark)
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").options(**options).load(path)


def write_warc(df: DataFrame, path: str) -> None:
    """Appends records (warc_type, url, warc_date, payload) as compressed files, each with its index."""
    ship(df.sparkSession)
    df.sparkSession.dataSource.register(WarcSource)
    df.select("warc_type", "url", "warc_date", F.col("payload").cast("binary").alias("payload")).write.format("warc").mode("append").save(path)


def ranged_records(index: DataFrame, root: str, part: int = 64 << 20, lenient: bool = False) -> DataFrame:
    """The records that lines of an index (filename, offset, length) name, from files below root; repeated lines read once.

    Lines meet by file and stretch of part bytes and are read in order, so a file is opened once for each stretch and a
    very large file is many tasks. A range that holds no whole record is an error (lenient: gives no row). Lines with a null are left out.
    """
    ship(index.sparkSession)
    named = index.select("filename", "offset", "length").where("filename IS NOT NULL AND offset >= 0 AND length > 0").distinct()
    parts = named.repartition("filename", F.expr(f"offset div {part}")).sortWithinPartitions("filename", "offset")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        system, base = _opened(root)
        name, file = None, None
        for batch in batches:
            for filename, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if filename != name:
                    if file:
                        file.close()
                    name, file = filename, system.open_input_file(f"{base.rstrip('/')}/{filename}")
                try:
                    for fields, payload in records(Member(pa.BufferReader(file.read_at(length, offset)), 0)):
                        yield _row(filename, offset, length, fields, payload)
                except (ValueError, zlib.error) as e:
                    if not lenient:
                        raise ValueError(f"{filename} at {offset}: {e}") from e
        if file:
            file.close()

    return parts.mapInArrow(lambda batches: _batches(rows(batches)), SCHEMA)
