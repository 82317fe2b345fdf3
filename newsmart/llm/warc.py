"""Pages as WARC archives with a two-level capture index, and pages read back through that index.

Archives: one file a task, written by Spark's text writer, so that Spark's commit leaves no half files. A line is
one WARC/1.1 record as a gzip member of its own, the line separator is an empty gzip member; so a file is a
normal compressed WARC. A payload of at least `least` bytes that several pages have is stored once, in the
response of the smallest page id; the other pages' records are revisits, which name that response and carry its
HTTP header. Record ids are urn:pages:<page_id>.

Index: every archive is scanned as a stream for the place of each record. Captures are sorted by key (host names
reversed, then port, path and query) in ranges; each range is a file of gzip members that hold up to BLOCK_LINES
captures or about BLOCK_BYTES each, a directory with the first key of every block, and a footer of fixed length
with the directory's place. Keys in the directory are cut to KEY_BYTES.

Looking up: the first key of each index file is known to every task (one row for about FILE_LINES captures). A
binary search in these gives the files, one in a file's directory gives the blocks, which may be many for one
key; blocks are dealt over the tasks, read as ranges of bytes, and searched once more. The captures found are
dealt by file and place, and neighbouring records are read in one range. Files are read with pyarrow's file
systems, from the shared folder only.

Null html is an empty payload. A null or empty url has no target header and the empty key; blanks and control
characters of a url are written in percent form. A page without id is a record with the id urn:pages:null; it
comes back with a null id and is never what others refer to. Rows that repeat the smallest id are responses
each, other repeated rows revisits. Empty tables give no archive and no rows. Other columns aren't read.
A record whose payload doesn't have the digest that its header names is a ValueError. A page id must be an
integer.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.llm.arrow import SLICE_BYTES, Stage, slices

#: Smaller payloads are always stored.
LEAST = 100
#: Date of records whose pages have none.
DATE = "1970-01-01T00:00:00Z"
LEVEL = 4
BLOCK_LINES, BLOCK_BYTES, FILE_LINES = 1024, 1 << 20, 1 << 18
#: Bytes of a key in the directory.
KEY_BYTES = 256
#: Bytes read at once while scanning and for neighbouring records; a gap up to this long is read too.
_SCAN, _SPAN, _GAP = 1 << 16, 4 << 20, 1 << 14

_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile("[\x00-\x20\x7f]")
_URL = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*|\[[^\]]*\])(?::(\d*))?([/?][^#]*)?(?:#.*)?$", re.S)


def member(raw: bytes, level: int = LEVEL) -> bytes:
    out = zlib.compressobj(level, zlib.DEFLATED, 31)
    return out.compress(raw) + out.flush()


EMPTY = member(b"")


def clean_url(url: str | None) -> str:
    return _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url or "")


def url_key(url: str | None) -> str:
    """The url with its host's names reversed, without scheme, user, default port and fragment."""
    url = clean_url(url)
    found = _URL.match(url)
    if not found:
        return url.split("#", 1)[0]
    host, port, path = found[1].lower(), found[2], found[3] or "/"
    port = "" if port in (None, "", "80", "443") else f":{port}"
    return f"{','.join(reversed(host.split('.')))}{port}){'' if path[0] == '/' else '/'}{path}"


# ---------------------------------------------------------------- writing


def _record(kind: str, record: str, block: bytes, more: list[str]) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record}>", f"WARC-Date: {DATE}", *more]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def page_record(page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None, refers_url: str | None) -> bytes:
    """A response, or a revisit where refers is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    name = f"urn:pages:{'null' if page is None else page}"
    more = [f"WARC-Target-URI: {clean_url(url)}"] if url else []
    more += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response"]
    if refers is None:
        return _record("response", name, http + payload, more)
    more += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <urn:pages:{refers}>"]
    more += [f"WARC-Refers-To-Target-URI: {clean_url(refers_url)}"] if refers_url else []
    return _record("revisit", name, http, more)


def _write_members(df: DataFrame, path: str) -> None:
    """df's only column, bytes of gzip members, as one file a task."""
    (only,) = df.columns
    text = df.select(F.col(only).cast("string").alias("value"))
    text.write.option("lineSep", EMPTY.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)


def write_archives(
    stage: Stage, pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST
) -> str:
    """Writes a record for each row of pages; the folder of the archives."""
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    narrow = rows.where(F.octet_length("payload") >= least).select("digest", "page", "url")
    groups = narrow.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min("page").alias("first"), F.min_by("url", "page").alias("first_url")
    )
    # what is shared is a small table as a rule; where it isn't, the join is a shuffle that splits hot digests
    shared = stage.save(groups.where("n > 1 AND first IS NOT NULL").drop("n"), "shared")
    joined = rows.join(shared, "digest", "left")
    refers = F.when(F.col("page").isNull() | (F.col("page") != F.col("first")), F.col("first"))
    records = joined.select("page", "url", "payload", "digest", refers.alias("refers"), "first_url")
    info = _record("warcinfo", "urn:pages:archive", b"format: WARC File Format 1.1\r\n", ["Content-Type: application/warc-fields"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [member(info)], 0
        any_rows = False
        for whole in batches:
            for batch in slices(whole, "payload"):
                for page, link, payload, digest, first, first_url in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    any_rows = True
                    out.append(member(page_record(page, link, payload, digest, first, first_url)))
                    size += len(out[-1])
                    if size >= SLICE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])
                        out, size = [], 0
        if out and any_rows:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    _write_members(records.mapInArrow(run, "member binary"), stage.path("archives"))
    return stage.path("archives")


# ---------------------------------------------------------------- reading bytes


class Files:
    """Open files of the shared folder, the latest few kept."""

    def __init__(self, most: int = 8) -> None:
        self.open: OrderedDict[str, pa.NativeFile] = OrderedDict()
        self.most = most

    def get(self, path: str) -> pa.NativeFile:
        if path not in self.open:
            self.open[path] = open_input(path)
            if len(self.open) > self.most:
                self.open.popitem(last=False)[1].close()
        self.open.move_to_end(path)
        return self.open[path]

    def read(self, path: str, offset: int, length: int) -> bytes:
        file = self.get(path)
        file.seek(offset)
        return file.read(length)


def open_input(path: str) -> pa.NativeFile:
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return system.open_input_file(inner)


def members(read: Callable[[int], bytes], keep: Callable[[bytes], bool]) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, first bytes) of each gzip member that isn't empty; a member's bytes are kept until `keep` says no."""
    at, rest, ended = 0, b"", False
    while True:
        unpack, head, done, used, some = zlib.decompressobj(31), b"", False, 0, False
        while not unpack.eof:
            if not rest:
                rest = read(_SCAN)
                if not rest:
                    ended = True
                    break
            part = unpack.decompress(rest, _SCAN)
            left = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
            used += len(rest) - len(left)
            rest = left
            some = some or bool(part)
            if not done:
                head += part
                done = not keep(head)
        if ended:
            if used:
                raise ValueError("an archive ends within a record")
            return
        if some:
            yield at, used, head
        at += used


def headers(raw: bytes) -> tuple[dict[str, str], int]:
    """The named fields of a record (names in lower case), and where its block begins."""
    stop = raw.index(b"\r\n\r\n")
    fields = (line.split(": ", 1) for line in raw[:stop].decode("utf-8", "replace").split("\r\n")[1:])
    return {f[0].lower(): f[1] if len(f) > 1 else "" for f in fields}, stop + 4


# ---------------------------------------------------------------- index


@dataclass(frozen=True)
class Index:
    """The files of an index: first keys (cut), paths and lengths in the order of keys, and the archives' paths."""

    first: list[bytes]
    paths: list[str]
    lengths: list[int]
    archives: list[str]


def _listing(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "length")
    return sorted((r.path, r.length) for r in files.where("length > 0").collect())


def _tasks(spark: SparkSession, n: int, size: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // size))


def captures(spark: SparkSession, archives: list[str]) -> DataFrame:
    """key, archive (its number), offset and length of every page record, by a scan of the archives."""
    files = spark.createDataFrame(list(enumerate(archives)), "archive int, path string").coalesce(1).repartition(len(archives))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows: list[tuple] = []
                with open_input(path) as file:
                    for offset, length, head in members(file.read, lambda x: b"\r\n\r\n" not in x):
                        fields, _ = headers(head)
                        if fields["warc-type"] != "warcinfo":
                            rows.append((url_key(fields.get("warc-target-uri")).encode(), number, offset, length))
                        if len(rows) >= 1 << 13:
                            yield _captures(rows)
                            rows = []
                yield _captures(rows)

    return files.mapInArrow(run, "key binary, archive int, offset bigint, length bigint")


def _captures(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int32(), pa.int64(), pa.int64())
    columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["key", "archive", "offset", "length"])


def _footer(place: int) -> bytes:
    return member(b"%020d" % place, 0)


_FOOTER = len(_footer(0)) + len(EMPTY)


def index_members(lines: Iterator[tuple[bytes, int, int, int]]) -> Iterator[bytes]:
    """Blocks of sorted captures, then the directory, then the footer."""
    directory: list[bytes] = []
    at, block, size, first = 0, [], 0, b""

    def close() -> bytes:
        nonlocal at
        packed = member(b"".join(block))
        directory.append(b"%s %d %d\n" % (first[:KEY_BYTES], at, len(packed)))
        at += len(packed) + len(EMPTY)
        return packed

    for key, archive, offset, length in lines:
        if not block:
            first = key
        block.append(b"%s %d %d %d\n" % (key, archive, offset, length))
        size += len(block[-1])
        if len(block) == BLOCK_LINES or size >= BLOCK_BYTES:
            yield close()
            block, size = [], 0
    if block:
        yield close()
    if directory:
        yield member(b"".join(directory))
        yield _footer(at)


def read_directory(files: Files, path: str, length: int) -> list[tuple[bytes, int, int]]:
    """(first key, offset, length) of each block of an index file."""
    place = int(zlib.decompress(files.read(path, length - _FOOTER, _FOOTER - len(EMPTY)), 31))
    raw = zlib.decompressobj(31).decompress(files.read(path, place, length - _FOOTER - place))
    lines = (line.rsplit(b" ", 2) for line in raw.splitlines())
    return [(key, int(offset), int(size)) for key, offset, size in lines]


def build_index(stage: Stage, archives: str) -> Index:
    """Scans the archives of a folder and writes the index of their captures."""
    spark = stage.spark
    paths = [p for p, _ in _listing(spark, archives)]
    if not paths:
        return Index([], [], [], [])
    rows = stage.save(captures(spark, paths), "captures")
    ranges = _tasks(spark, rows.count(), FILE_LINES)
    ordered = rows.repartitionByRange(ranges, "key", "archive", "offset").sortWithinPartitions("key", "archive", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (line for b in batches for line in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for packed in index_members(lines):
            yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["member"])

    _write_members(ordered.mapInArrow(run, "member binary"), stage.path("index"))
    return open_index(spark, stage.path("index"), paths)


def open_index(spark: SparkSession, folder: str, archives: list[str]) -> Index:
    """The index files of a folder with their first keys, one row a file."""
    files = _listing(spark, folder)
    listed = spark.createDataFrame(files, "path string, length bigint").repartition(_tasks(spark, len(files), 64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = Files()
        for batch in batches:
            keys = [read_directory(opened, p, n)[0][0] for p, n in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=["path", "length", "first"])

    # names of parts rise with their ranges, so files that begin with the same cut key stay in order
    rows = sorted((bytes(r.first), r.path, r.length) for r in listed.mapInArrow(run, "path string, length bigint, first binary").collect())
    return Index([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], archives)


def _may_hold(first: list[bytes], key: bytes) -> range:
    """Places in a sorted list of first keys (cut) behind which the key may stand."""
    cut = key[:KEY_BYTES]
    return range(max(bisect_left(first, cut) - 1, 0), bisect_right(first, cut))


def lookup(index: Index, keys: DataFrame) -> DataFrame:
    """archive, offset and length of every capture under the keys, distinct values of the column key (binary)."""
    spark = keys.sparkSession
    sent = spark.sparkContext.broadcast(index)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, files = sent.value, Files()
        known: OrderedDict[int, tuple[list[bytes], list[tuple[int, int]]]] = OrderedDict()
        for batch in batches:
            out: list[tuple] = []
            for key in batch.column(0).to_pylist():
                for f in _may_hold(own.first, key):
                    if f not in known:
                        entries = read_directory(files, own.paths[f], own.lengths[f])
                        known[f] = [e[0] for e in entries], [e[1:] for e in entries]
                        if len(known) > 8:
                            known.popitem(last=False)
                    first, places = known[f]
                    out += [(key, f, *places[b]) for b in _may_hold(first, key)]
                if len(out) >= 1 << 13:
                    yield _blocks(out)
                    out = []
            yield _blocks(out)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, files = sent.value, Files()
        last, first, lines = None, [], []
        for batch in batches:
            out: list[tuple] = []
            for key, f, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last != (f, offset):
                    last = f, offset
                    raw = zlib.decompress(files.read(own.paths[f], offset, length), 31)
                    lines = [line.rsplit(b" ", 3) for line in raw.splitlines()]
                    first = [line[0] for line in lines]
                for i in range(bisect_left(first, key), bisect_right(first, key)):
                    out.append((key, *map(int, lines[i][1:])))
                if len(out) >= 1 << 13:
                    yield _captures(out)
                    out = []
            yield _captures(out)

    asked = keys.select("key").repartitionByRange(n, "key").sortWithinPartitions("key")
    where = asked.mapInArrow(blocks, "key binary, file int, offset bigint, length bigint")
    dealt = where.repartition(n, "file", F.shiftright("offset", 20)).sortWithinPartitions("file", "offset", "key")
    return dealt.mapInArrow(found, "key binary, archive int, offset bigint, length bigint").drop("key")


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int32(), pa.int64(), pa.int64())
    columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["key", "file", "offset", "length"])


# ---------------------------------------------------------------- reading records


def ranges(rows: Iterator[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """Rows (file, offset, length), sorted, in runs that are worth reading at once."""
    run: list[tuple[int, int, int]] = []
    for row in rows:
        if run:
            end = run[-1][1] + run[-1][2]
            if row[0] != run[0][0] or row[1] - end > _GAP or row[1] + row[2] - run[0][1] > _SPAN:
                yield run
                run = []
        run.append(row)
    if run:
        yield run


def parse(packed: bytes) -> tuple[int | None, int, str, str, int | None, str, bytes]:
    """(page_id, payload's length, its digest, type, page referred to, url, payload that is stored) of a record."""
    raw = zlib.decompressobj(31).decompress(packed)
    fields, begin = headers(raw)
    block = raw[begin : begin + int(fields["content-length"])]
    http, payload_at = headers(block)
    payload, kind = block[payload_at:], fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {fields['warc-record-id']} doesn't have its digest")
    page, refers = (_page(fields.get(name)) for name in ("warc-record-id", "warc-refers-to"))
    return page, int(http["content-length"]), digest, kind, refers, fields.get("warc-target-uri", ""), payload


def _page(record: str | None) -> int | None:
    name = record[len("<urn:pages:") : -1] if record else "null"
    return None if name == "null" else int(name)


_RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_records(index: Index, found: DataFrame, payloads: bool = False) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the captures; with url and payload if wanted."""
    spark = found.sparkSession
    sent = spark.sparkContext.broadcast(index.archives)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.select("archive", "offset", "length").repartition(n, "archive", F.shiftright("offset", 22))
    schema = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        + [("url", pa.string()), ("payload", pa.binary())] * payloads
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, files = sent.value, Files()
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        out, size = [], 0
        for part in ranges(rows):
            begin, end = part[0][1], part[-1][1] + part[-1][2]
            raw = files.read(paths[part[0][0]], begin, end - begin)
            for _, offset, length in part:
                record = parse(raw[offset - begin : offset - begin + length])
                out.append(record[: len(schema)])
                size += len(record[-1]) if payloads else 100
                if size >= SLICE_BYTES:
                    yield _rows(out, schema)
                    out, size = [], 0
        yield _rows(out, schema)

    return dealt.sortWithinPartitions("archive", "offset").mapInArrow(run, _RECORD + ", url string, payload binary" * payloads)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def url_keys(pages: DataFrame, url: str = "url") -> DataFrame:
    """The distinct keys of a column of urls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u).encode() for u in batch.column(0).to_pylist()], pa.binary())], names=["key"])

    return pages.select(F.col(url).cast("string").alias("url")).distinct().mapInArrow(run, "key binary").distinct()


def archive(pages: DataFrame) -> tuple[Stage, Index]:
    """Archives and index of pages (page_id, url, html), below spark.checkpoint.dir."""
    stage = Stage(pages.sparkSession, "warc")
    return stage, build_index(stage, write_archives(stage, pages))


def archived_pages(pages: DataFrame) -> DataFrame:
    """Every page as read back from its archives, by looking up the pages' urls in the capture index."""
    _, index = archive(pages)
    return read_records(index, lookup(index, url_keys(pages)))
