"""WARC archives as a Spark data source, and a web-page archive in which equal payloads are stored once.

    read_warc(spark, folder, "warc_type string, warc_target_uri string, payload binary").where("warc_type = 'response'")
    write_warc(records, folder)

A column named after a header (``warc_record_id`` for ``WARC-Record-ID``) holds
that header, as text or as a number. Predicates on such columns are pushed down:
a record's headers are parsed first, and the payload of a record that they rule
out, or of any record when no ``payload`` column is asked for, is neither
inflated nor read. Each record of a ``.warc.gz`` file is a gzip member of its own;
members written here state their length in the standard's ``sl`` extra field, so
that the reader jumps over the rest of them. Other files are inflated to the end
of the member, plain ``.warc`` files are jumped by Content-Length.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import IntegerType, LongType, MapType, StructType

from lodestay.llm.common import shared_folder, stored

#: Columns that are no headers: the payload and its length, the HTTP head, all headers, where the record lies.
OTHER_COLUMNS = ("payload", "payload_length", "http_status", "http_headers", "headers", "file", "offset")
DEFAULT_SCHEMA = (
    "warc_type string, warc_record_id string, warc_date string, warc_target_uri string, warc_payload_digest string, "
    "warc_refers_to string, content_type string, content_length long, http_status int, payload_length long, "
    "headers map<string,string>, http_headers map<string,string>, file string, offset long, payload binary")
#: Fixed by the WARC 1.1 standard.
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

READ_BYTES = 64 << 10
#: Uncompressed bytes of a batch handed to Spark, about; a longer payload is alone in one.
BATCH_BYTES = 4 << 20


def header_of(column: str) -> str:
    """The header, in lower case, that a column of this name holds."""
    return column.lower().replace("_", "-")


def named_header(column: str) -> str:
    """The header as the standard writes it: WARC-Record-ID, Content-Type."""
    fixed = {"warc": "WARC", "id": "ID", "uri": "URI", "ip": "IP"}
    return "-".join(fixed.get(w, w.capitalize()) for w in column.lower().split("_"))


# ---- files -------------------------------------------------------------------------------------------------------


class _Plain:
    """The bytes of an uncompressed file from a record on."""

    def __init__(self, file, offset: int):
        self.file, self.at, self.held = file, offset, b""

    def more(self) -> bool:
        self.file.seek(self.at)
        got = self.file.read(READ_BYTES)
        self.held, self.at = self.held + got, self.at + len(got)
        return bool(got)

    def until(self, mark: bytes) -> bytes | None:
        """The bytes up to and with ``mark``; None at the end of the file."""
        start = 0
        while (found := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                return None
        found += len(mark)
        out, self.held = self.held[:found], self.held[found:]
        return out

    def take(self, n: int) -> bytes:
        parts, have = [self.held], len(self.held)
        while have < n and self.more_into(parts):
            have += len(parts[-1])
        whole = b"".join(parts)
        out, self.held = whole[:n], whole[n:]
        return out

    def more_into(self, parts: list[bytes]) -> bool:
        self.held = b""
        got = self.more()
        parts.append(self.held)
        return got

    def skip(self, n: int) -> None:
        if n <= len(self.held):
            self.held = self.held[n:]
        else:
            self.at += n - len(self.held)
            self.held = b""

    def next_record(self) -> int:
        return self.at - len(self.held)


class _Member(_Plain):
    """The inflated bytes of one gzip member."""

    def __init__(self, file, offset: int):
        super().__init__(file, offset)
        self.start, self.length, self.ended = offset, _stated_length(file, offset), False
        self.zip = zlib.decompressobj(wbits=31)

    def more(self) -> bool:
        while not self.ended:
            raw = self.zip.unconsumed_tail
            if not raw:
                self.file.seek(self.at)
                raw = self.file.read(READ_BYTES)
                self.at += len(raw)
                if not raw:
                    raise ValueError("the file ends inside a gzip member")
            got = self.zip.decompress(raw, 4 * READ_BYTES)
            self.ended = self.zip.eof
            if got:
                self.held += got
                return True
        return False

    def skip(self, n: int) -> None:
        while n > len(self.held):
            n, self.held = n - len(self.held), b""
            if not self.more():
                return
        self.held = self.held[n:]

    def next_record(self) -> int:
        if self.length:
            return self.start + self.length
        while not self.ended:
            self.held = b""
            self.more()
        return self.at - len(self.zip.unused_data)


def _stated_length(file, offset: int) -> int:
    """The length that the ``sl`` extra field states for the gzip member, 0 without one."""
    file.seek(offset)
    head = file.read(12)
    if len(head) < 12 or not head[3] & 4:
        return 0
    extra, at = file.read(struct.unpack("<H", head[10:12])[0]), 0
    while at + 4 <= len(extra):
        n = struct.unpack("<H", extra[at + 2:at + 4])[0]
        if extra[at:at + 2] == b"sl" and n == 8:
            return struct.unpack("<I", extra[at + 4:at + 8])[0]
        at += 4 + n
    return 0


def _fields(block: bytes) -> dict[str, str]:
    """Header lines by lower-case name; lines that go on with white space are joined, the first of equal names counts."""
    out: dict[str, str] = {}
    last = None
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        last = None
        if colon and name.strip().lower() not in out:
            last = name.strip().lower()
            out[last] = value.strip()
    return out


@dataclass
class Record:
    """A record's headers; its payload is read when asked for, and only then."""

    headers: dict[str, str]
    offset: int
    source: _Plain
    _left: int
    _http: tuple[int | None, dict[str, str]] | None = field(default=None)

    @property
    def http(self) -> tuple[int | None, dict[str, str]]:
        """Status and headers of an HTTP record's head, which stands before the payload."""
        if self._http is None:
            self._http = (None, {})
            if self.headers.get("content-type", "").lower().startswith("application/http") and self._left:
                head = self.source.until(b"\r\n\r\n")
                if head is None or len(head) > self._left:
                    raise ValueError("an HTTP record without an end of its head")
                self._left -= len(head)
                words = head.split(b"\r\n", 1)[0].split()
                status = int(words[1]) if len(words) > 1 and words[0].startswith(b"HTTP/") and words[1].isdigit() else None
                self._http = (status, _fields(head))
        return self._http

    @property
    def payload_length(self) -> int | None:
        """Of the payload that the record stands for: a revisit has none itself and states the length in its HTTP head."""
        http = self.http[1]
        if self.headers.get("warc-type") == "revisit":
            return _number(http.get("content-length"))
        return self._left

    def payload(self) -> bytes | None:
        if self.headers.get("warc-type") == "revisit":
            return None
        self.http  # stands before it
        got, n = self.source.take(self._left), self._left
        if len(got) < n:
            raise ValueError("the file ends inside a record")
        self._left = 0
        return got


def _number(value: str | None) -> int | None:
    return int(value) if value is not None and value.lstrip("-").isdigit() and value.isascii() else None


def records(file, compressed: bool) -> Iterator[Record]:
    """The records of an open file, one after another; whatever of a record was not read is jumped."""
    at, end = 0, file.size()
    while at < end:
        source = _Member(file, at) if compressed else _Plain(file, at)
        head = source.until(b"\r\n\r\n")
        if head is None or not head.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = _fields(head)
        n = _number(headers.get("content-length"))
        if n is None or n < 0:
            raise ValueError(f"a record without Content-Length at byte {at}")
        record = Record(headers, at, source, n)
        yield record
        if not compressed:
            source.skip(record._left + 4)
        at = source.next_record()


# ---- predicates --------------------------------------------------------------------------------------------------

_TESTS: dict[type, Callable] = {
    EqualTo: lambda v, x: v == x, In: lambda v, x: v in x, GreaterThan: lambda v, x: v > x,
    GreaterThanOrEqual: lambda v, x: v >= x, LessThan: lambda v, x: v < x, LessThanOrEqual: lambda v, x: v <= x,
    StringStartsWith: lambda v, x: v.startswith(x), StringEndsWith: lambda v, x: v.endswith(x),
    StringContains: lambda v, x: x in v,
}


@dataclass(frozen=True)
class HeaderTest:
    """A predicate on a header, to be decided before anything behind the headers is read."""

    header: str
    number: bool
    kind: type
    value: object
    negated: bool

    def passes(self, headers: dict[str, str]) -> bool:
        v = headers.get(self.header)
        v = _number(v) if self.number else v
        if self.kind in (IsNull, IsNotNull):
            return ((v is None) == (self.kind is IsNull)) != self.negated
        return v is not None and _TESTS[self.kind](v, self.value) != self.negated


def header_test(given: Filter, schema: StructType) -> HeaderTest | None:
    """The test that ``given`` is, None if it does not speak of one header column."""
    negated = isinstance(given, Not)
    inner = given.child if negated else given
    column = getattr(inner, "attribute", ())
    if len(column) != 1 or column[0].lower() in OTHER_COLUMNS or type(inner) not in (*_TESTS, IsNull, IsNotNull):
        return None
    kind = next(f.dataType for f in schema if f.name.lower() == column[0].lower())
    value = getattr(inner, "value", None)
    if value is None and type(inner) not in (IsNull, IsNotNull):
        return None
    if isinstance(inner, In) and any(v is None for v in value):
        return None
    return HeaderTest(header_of(column[0]), isinstance(kind, (LongType, IntegerType)), type(inner), value, negated)


# ---- the data source ---------------------------------------------------------------------------------------------


@dataclass
class FilePartition(InputPartition):
    files: list[str]


class WarcReader(DataSourceReader):
    """Files in partitions of about ``partition_bytes``; a file is read by one task, record by record."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.options, self.tests = schema, dict(options), []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for given in filters:
            test = header_test(given, self.schema)
            if test is None:
                yield given
            else:
                self.tests.append(test)

    def partitions(self) -> Sequence[InputPartition]:
        fs, path = pafs.FileSystem.from_uri(self.options["path"])
        info = fs.get_file_info(path)
        if info.type == pafs.FileType.File:
            return [FilePartition([path])]
        found = fs.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True))
        lists = [f for f in found if f.base_name.startswith("_committed-")]
        files = {f.path: f.size for f in found if f.base_name.endswith((".warc", ".warc.gz")) and f.size}
        if lists:  # what a task left that ran twice or failed is in no list
            named = set()
            for f in lists:
                with fs.open_input_file(f.path) as opened:
                    folder = f.path.rsplit("/", 1)[0]
                    named |= {f"{folder}/{n}" for n in json.loads(opened.read())}
            missing = named - {f.path for f in found}
            if missing:
                raise ValueError(f"archive files are missing: {sorted(missing)[:3]}")
            files = {p: n for p, n in files.items() if p in named}
        most, packed, size = int(self.options.get("partition_bytes", 64 << 20)), [], 0
        for p in sorted(files):
            if not packed or size + files[p] > most:
                packed.append([])
                size = 0
            packed[-1].append(p)
            size += files[p]
        return [FilePartition(p) for p in packed] or [FilePartition([])]

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.options["path"])
        kinds = pa.schema([(f.name, _arrow(f.dataType)) for f in self.schema])
        columns, size = [[] for _ in self.schema], 0
        for path in partition.files:
            with fs.open_input_file(path) as file:
                try:
                    for record in records(file, path.endswith(".gz")):
                        if not all(t.passes(record.headers) for t in self.tests):
                            continue
                        for out, f in zip(columns, self.schema):
                            out.append(value := self.value(record, f, path))
                            size += len(value) if isinstance(value, bytes) else 64
                        if size > BATCH_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.types)], schema=kinds)
                            columns, size = [[] for _ in self.schema], 0
                except (ValueError, zlib.error) as bad:
                    raise ValueError(f"{path}: {bad}") from bad
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.types)], schema=kinds)

    def value(self, record: Record, column, path: str):
        name = column.name.lower()
        if name not in OTHER_COLUMNS:
            v = record.headers.get(header_of(name))
            return _number(v) if isinstance(column.dataType, (LongType, IntegerType)) else v
        if name == "payload":
            record.payload_length  # is known before the payload is taken
            return record.payload()
        return {
            "payload_length": lambda: record.payload_length, "http_status": lambda: record.http[0],
            "http_headers": lambda: list(record.http[1].items()), "headers": lambda: list(record.headers.items()),
            "file": lambda: path, "offset": lambda: record.offset,
        }[name]()


def _arrow(kind) -> pa.DataType:
    if isinstance(kind, MapType):
        return pa.map_(pa.string(), pa.string())
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[kind.simpleString()]


@dataclass
class FilesWritten(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Each task writes files of about ``file_bytes``; the driver lists those of the tasks that count."""

    def __init__(self, schema: StructType, options: dict[str, str], overwrite: bool):
        self.columns, self.options, self.overwrite = [f.name.lower() for f in schema], dict(options), overwrite
        if "warc_type" not in self.columns or "payload" not in self.columns:
            raise ValueError("records need the columns warc_type and payload")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, path = pafs.FileSystem.from_uri(self.options["path"])
        fs.create_dir(path, recursive=True)
        most, level = int(self.options.get("file_bytes", 256 << 20)), int(self.options.get("level", 6))
        names, out, size = [], None, 0
        at = {c: k for k, c in enumerate(self.columns)}
        headers = [(c, named_header(c)) for c in self.columns if c not in OTHER_COLUMNS and c != "content_length"]
        for batch in iterator:
            for k in range(batch.num_rows):
                row = {c: batch.column(i)[k].as_py() for c, i in at.items()}
                if out is None or size >= most:
                    if out:
                        out.close()
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = fs.open_output_stream(f"{path}/{names[-1]}", compression=None), 0
                member = packed(record_bytes([(h, row[c]) for c, h in headers], row["payload"], row.get("payload_length")), level)
                out.write(member)
                size += len(member)
        if out:
            out.close()
        return FilesWritten(names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, path = pafs.FileSystem.from_uri(self.options["path"])
        fs.create_dir(path, recursive=True)
        name = f"_committed-{uuid.uuid4().hex}.json"
        old = [f.path for f in fs.get_file_info(pafs.FileSelector(path)) if f.base_name.startswith("_committed-")] if self.overwrite else []
        with fs.open_output_stream(f"{path}/{name}", compression=None) as out:
            out.write(json.dumps([n for m in messages if m for n in m.files]).encode())
        for f in old:  # the files they list stay and are read no more
            fs.delete_file(f)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, path = pafs.FileSystem.from_uri(self.options["path"])
        for n in (n for m in messages if m for n in m.files):
            fs.delete_file(f"{path}/{n}")


def record_bytes(headers: list[tuple[str, object]], payload: bytes | None, payload_length: int | None) -> bytes:
    """A record with an HTTP head in front of the payload; a revisit has the head alone."""
    payload = payload or b""
    revisit = any(h == "WARC-Type" and v == "revisit" for h, v in headers)
    n = payload_length if revisit and payload_length is not None else len(payload)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n
    lines = [VERSION]
    for h, v in headers:
        if v is not None:  # a line break would begin another header
            lines.append(f"{h}: {v}".replace("\r", "%0D").replace("\n", "%0A").encode())
    body = b"" if revisit else payload
    lines.append(b"Content-Length: %d" % (len(block) + len(body)))
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + body + b"\r\n\r\n"


def packed(record: bytes, level: int) -> bytes:
    """A gzip member that states its length in the ``sl`` extra field."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(record) + squeeze.flush()
    n = 12 + 12 + len(body) + 8
    stated = n if n < 1 << 32 else 0  # 0: the length is not stated
    extra = b"sl" + struct.pack("<HII", 8, stated, len(record) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04" + struct.pack("<IBB", 0, 0, 255) + struct.pack("<H", len(extra))
    return head + extra + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


class WarcDataSource(DataSource):
    """``spark.read.format("warc")``; ``path`` is any that ``pyarrow.fs`` opens."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return DEFAULT_SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(schema, self.options, overwrite)


def read_warc(spark: SparkSession, path: str, schema: str = DEFAULT_SCHEMA, **options) -> DataFrame:
    """The records below ``path``, with the columns asked for; turns on the session's pushdown to Python sources.

    A header that a record lacks is null, as is a number that is none, and the
    payload of a revisit. A folder without archives, or one that is not there,
    has no records; a file that is no WARC, or ends inside a record, is an
    error that names it. A record is read by one task, its payload (2 GB at
    most) only if it is asked for and the predicates keep the record.
    """
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").schema(schema).options(**options).load(path)


def write_warc(rows: DataFrame, path: str, **options) -> None:
    """One record for each row: ``warc_type`` and ``payload``, any headers by column name, ``payload_length`` of revisits."""
    rows.sparkSession.dataSource.register(WarcDataSource)
    rows.write.format("warc").mode("append").options(**options).save(path)


# ---- an archive of pages -----------------------------------------------------------------------------------------

#: A group of copies of one row is written out in runs of this many, so that no array of the whole group is built.
COPIES = 1 << 16


def page_records(
    pages: DataFrame, least_bytes: int = 100, page_id: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """The records of an archive: of equal payloads of ``least_bytes`` or more one is a response, the others revisit it.

    That one has the smallest page_id, a missing one coming last, then the
    smallest url; of rows that are equal in all three, one. Null html is an
    empty payload. Other columns are not read.

    Ids and digests meet in a narrow table first. The payloads are shuffled
    once, by page and digest, where a hot payload is spread over its pages.
    """
    keyed = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"))
    keyed = keyed.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    # missing values come last in this order
    place = F.struct(F.col("page_id").isNull(), "page_id", F.col("url").isNull(), "url")
    long_ones = keyed.where(F.length("payload") >= least_bytes).select("page_id", "url", "digest")
    narrow = stored(long_ones.groupBy("page_id", "url", "digest").agg(F.count("*").alias("n")), "payloads")
    first = narrow.groupBy("digest").agg(F.min(place).alias("first"), F.sum("n").alias("total")).where("total > 1")
    marks = narrow.join(first, "digest").select("page_id", "url", "digest", "first")
    none = F.lit(None)
    rows = keyed.select("*", none.cast(marks.schema["first"].dataType).alias("first"), F.lit(1).alias("row")).unionByName(
        marks.select("page_id", "url", "digest", "first", none.cast("binary").alias("payload"), F.lit(0).alias("row")))
    groups = rows.groupBy("page_id", "url", "digest").agg(
        F.first("payload", ignorenulls=True).alias("payload"), F.sum("row").alias("n"), F.max("first").alias("first"))
    runs = groups.withColumn("run", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES))))
    last = F.least(F.col("n"), (F.col("run") + 1) * COPIES)
    copies = runs.withColumn("copy", F.explode(F.sequence(F.col("run") * COPIES + 1, last)))
    response = F.col("first").isNull() | ((F.col("first") == place) & (F.col("copy") == 1))
    text = F.lower(F.hex("digest"))

    def record_id(where, copy) -> F.Column:
        """The same for the same page, so that a job that runs again writes the same records."""
        name = F.md5(F.concat_ws("|", where["page_id"].cast("string"), where["url"], text, copy.cast("string")))
        parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))

    own = F.struct("page_id", "url")
    return copies.select(
        F.when(response, "response").otherwise("revisit").alias("warc_type"),
        record_id(own, F.col("copy")).alias("warc_record_id"), F.lit("1970-01-01T00:00:00Z").alias("warc_date"),
        F.col("url").alias("warc_target_uri"), F.lit("application/http; msgtype=response").alias("content_type"),
        F.concat(F.lit("sha256:"), text).alias("warc_payload_digest"), F.col("page_id").alias("warc_page_id"),
        F.when(~response, F.lit(SAME_PAYLOAD)).alias("warc_profile"),
        F.when(~response, record_id(F.col("first"), F.lit(1))).alias("warc_refers_to"),
        F.when(~response, F.col("first.page_id")).alias("warc_refers_to_page_id"),
        F.length("payload").cast("long").alias("payload_length"), F.when(response, F.col("payload")).alias("payload"))


def archived(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each record of an archive of pages.

    Of responses length and digest are those of the payload read back; revisits are read by their headers alone.
    """
    heads = "warc_type string, warc_page_id long, warc_payload_digest string, warc_refers_to_page_id long, payload_length long"
    full = read_warc(spark, folder, f"{heads}, payload binary").where("warc_type = 'response'")
    revisits = read_warc(spark, folder, heads).where("warc_type = 'revisit'")
    return full.select(
        F.col("warc_page_id").alias("page_id"), F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), F.col("warc_type").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"),
    ).unionAll(revisits.select(
        "warc_page_id", "payload_length", F.substring_index("warc_payload_digest", ":", -1), "warc_type", "warc_refers_to_page_id"))


def round_trip(pages: DataFrame, least_bytes: int = 100, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the pages to an archive in the shared folder and read it back: one row for each page."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    write_warc(page_records(pages, least_bytes, page_id, url, html), folder)
    return archived(spark, folder)
