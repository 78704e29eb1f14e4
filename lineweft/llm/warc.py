"""Web archives as ZIP packages: records and their index are stored members, read by ranges.

Writing: pages become WARC records, each a gzip member of ``archive/data.warc.gz``, with one
line each in ``indexes/index.cdxj``. Of pages with equal payloads one is a response, the
others revisit it and carry no payload. A task writes archives of bounded size under names
of its own attempt and returns them as rows; those that Spark has committed in the list of
archives are the ones that count, so a repeated or lost task does no harm.

Reading: the central directory names the stored members, the index names the records, and
records are read as ranges of the file, neighbours in one request. An archive without index
is scanned for its records. Rows of ranges are sorted by place over all tasks, so one large
archive is read by many. What cannot be read is a row with ``error``.

Null payloads count as empty, null URLs and ids have no header and come back as null. Equal
payloads of ``least_bytes`` or more: the largest id is the response, a null id ranks below
every other; of rows with the same id any one of them. Other columns are not touched.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweft.llm.zipfiles import StoredWriter, content_start, located, members
from lineweft.session import cut_lineage

_DATA, _INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # that of RFC 4122 for URLs
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = 16 + zlib.MAX_WBITS
#: Ranges closer than this are read together, up to so many bytes at once.
_GAP, _TOGETHER = 1 << 16, 8 << 20
_OUT_BYTES, _ROWS = 8 << 20, 10_000


def _name(kind: str, of: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{kind}/{of}')}>"


def _block(payload: bytes, whole: int) -> bytes:
    """An HTTP response; ``whole`` is the length of the payload even where it is left out."""
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % whole + payload


def _header_value(value: str) -> str:
    return quote(value, safe=":/?#[]@!$&'()*+,;=%-._~ ")


def record(row: dict, date: str, own: str) -> bytes:
    """A record of ``row`` (id, url, payload, sha1, response: whether one, of: the response's id)."""
    revisit = row["of_row"] is not None
    block = _block(b"" if revisit else row["payload"], len(row["payload"]))
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    key = row["of_row"] if revisit else row["row"]
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {own}",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {_header_value(row['url'])}")
    if row["id"] is not None:
        lines.append(f"X-Source-Id: {quote(row['id'])}")
    if revisit:
        lines += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {_name('row', f'{row["run"]}/{key}')}"]
        if row["of_id"] is not None:
            lines.append(f"X-Refers-To-Source-Id: {quote(row['of_id'])}")
    return "\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n"


def url_key(url: str | None) -> str:
    """Sort key of a URL: the host's labels from the last to the first, then path and query."""
    try:
        parts = urlsplit((url or "").lower())
        host = parts.hostname or ""
    except ValueError:
        return _header_value(f"){url}").replace(" ", "%20")
    rest = f"{parts.path or '/'}{'?' + parts.query if parts.query else ''}"
    return _header_value(f"{','.join(reversed(host.split('.')))}){rest}").replace(" ", "%20")


def _decided(pages: DataFrame, id: str, url: str, html: str, least_bytes: int, salts: int) -> DataFrame:
    """Rows with a number of their own, and of which row they are a revisit."""
    payload = F.coalesce(F.col(html), F.lit(""))
    numbered = cut_lineage(
        pages.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id).alias("id"),
            F.col(url).cast("string").alias("url"),
            payload.alias("payload"),
            F.unhex(F.sha2(payload, 256)).alias("digest"),
            (F.octet_length(payload) >= least_bytes).alias("large"),
        )
    )
    first = F.max(F.struct(F.col("id").isNotNull().alias("known"), "id", "row")).alias("first")
    repeated = numbered.where("large").groupBy("digest").agg(first, F.count("*").alias("n")).where("n > 1")
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    answers = repeated.select("digest", F.col("first.id").alias("of_id"), F.col("first.row").alias("of_row"), every_salt)
    # Small payloads meet nothing: they get keys that no answer has.
    salt = F.when(F.col("large"), F.pmod("row", F.lit(salts))).otherwise(-1 - F.pmod("row", F.lit(1 << 20)))
    joined = numbered.withColumn("salt", salt.cast("int")).join(answers, ["digest", "salt"], "left")
    is_other = F.col("of_row").isNotNull() & (F.col("of_row") != F.col("row"))
    return joined.select(
        "row",
        F.col("id").cast("string").alias("id"),
        "url",
        F.encode("payload", "UTF-8").alias("payload"),
        F.sha1(F.encode("payload", "UTF-8")).alias("sha1"),
        F.when(is_other, F.col("of_id").cast("string")).alias("of_id"),
        F.when(is_other, F.col("of_row")).alias("of_row"),
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 1000,
    archive_bytes: int = 64 << 20,
    zip64: bool = False,
    date: str = "2000-01-01T00:00:00Z",
    level: int = 1,
    salts: int = 16,
) -> DataFrame:
    """Write all pages as records in archives below ``folder`` and return the archives that count: path, records, bytes.

    ``folder`` is one that all tasks reach, of a kind that pyarrow opens (file, HDFS, S3, GCS).
    ``date`` is the records' date, the same in every run.
    """
    stamp = "".join(c for c in date if c.isdigit())
    base, run = f"{folder.rstrip('/')}/archives", uuid.uuid4().hex

    def archives(batches):
        context = TaskContext.get()
        files, root = located(base)
        files.create_dir(root, recursive=True)
        stem, no, writer = f"{context.partitionId():06d}-{context.taskAttemptId()}", 0, None

        def finish():
            writer.finish()
            writer.begin(_INDEX)
            for line in sorted(lines):
                writer.write(line)
            writer.finish()
            writer.close()
            size = stream.tell()
            stream.close()
            return pa.RecordBatch.from_pydict({"path": [f"{base}/{name}"], "records": [len(lines)], "bytes": [size]})

        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in batch.schema.names} | {"run": run}
                if writer is None:
                    name, lines, filled = f"{stem}-{no:04d}.wacz", [], 0
                    stream = files.open_output_stream(f"{root}/{name}")
                    writer, no = StoredWriter(stream, zip64), no + 1
                    writer.begin(_DATA)
                press = zlib.compressobj(level, zlib.DEFLATED, _GZIP)
                data = press.compress(record(row, date, _name("row", f"{run}/{row['row']}"))) + press.flush()
                start = writer.write(data)
                entry = {
                    "url": row["url"], "mime": "text/html", "status": "200", "digest": f"sha1:{row['sha1']}",
                    "offset": str(start), "length": str(len(data)), "filename": _DATA.rpartition("/")[2],
                }
                lines.append(f"{url_key(row['url'])} {stamp} {json.dumps(entry)}\n".encode())
                filled += len(data)
                if filled >= archive_bytes:
                    yield finish()
                    writer = None
        if writer is not None:
            yield finish()

    decided = _decided(pages, id, url, html, least_bytes, salts)
    listed = decided.mapInArrow(archives, "path string, records bigint, bytes bigint")
    return cut_lineage(listed)


def _spread(archives: DataFrame, path: str) -> DataFrame:
    """One row per archive, dealt over the tasks, as a file listing may lie in one partition."""
    return archives.select(F.col(path).alias("path")).repartition(F.xxhash64("path"))


def archive_members(archives: DataFrame, path: str = "path") -> DataFrame:
    """Members of archives as their central directories have them; an archive that cannot be read is a row with ``error``."""

    def listed(batches):
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                rows: list[tuple] = []
                try:
                    files, place = located(uri)
                    with files.open_input_file(place) as file:
                        for m in members(file):
                            start = content_start(file, m) if m.stored else None
                            rows.append((uri, m.name, m.method, m.encrypted, start, m.size, None))
                            if len(rows) == _ROWS:
                                yield _table(rows, _MEMBERS)
                                rows = []
                except (OSError, ValueError) as e:
                    rows.append((uri, None, None, None, None, None, f"{type(e).__name__}: {e}"))
                yield _table(rows, _MEMBERS)

    kinds = "path string, name string, method int, encrypted boolean, start bigint, size bigint, error string"
    return _spread(archives, path).mapInArrow(listed, kinds)


_MEMBERS = pa.schema(
    [("path", pa.string()), ("name", pa.string()), ("method", pa.int32()), ("encrypted", pa.bool_()),
     ("start", pa.int64()), ("size", pa.int64()), ("error", pa.string())]
)
_RANGES = pa.schema([("path", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("error", pa.string())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _lines(file, start: int, size: int) -> Iterator[bytes]:
    """Lines of a range of a file, read in pieces."""
    rest, at = b"", start
    while at < start + size:
        file.seek(at)
        data = file.read(min(1 << 20, start + size - at))
        if not data:
            raise ValueError("the index is cut off")
        at += len(data)
        *whole, rest = (rest + data).split(b"\n")
        yield from whole
    if rest:
        yield rest


class _Pieces:
    """Bytes of a range of a file, from its front, a bounded part at a time."""

    def __init__(self, file, start: int, size: int):
        self.file, self.at, self.end, self.data = file, start, start + size, b""

    def more(self) -> bool:
        if self.at >= self.end:
            return False
        self.file.seek(self.at)
        got = self.file.read(min(1 << 20, self.end - self.at))
        self.at += len(got)
        self.data += got
        return bool(got)


def scanned(file, start: int, size: int) -> Iterator[tuple[int, int]]:
    """Places and lengths of the records of a member without index, gzip members or plain records."""
    pieces, at = _Pieces(file, start, size), start
    while pieces.data or pieces.more():
        n = 0
        if len(pieces.data) < 2:
            pieces.more()
        if pieces.data[:2] == b"\x1f\x8b":
            plain = zlib.decompressobj(_GZIP)
            while not plain.eof:
                if not pieces.data and not pieces.more():
                    raise ValueError("a record is cut off")
                n += len(pieces.data)
                plain.decompress(pieces.data)
                n -= len(plain.unused_data)
                pieces.data = plain.unused_data
        else:
            while (ends := pieces.data.find(b"\r\n\r\n")) < 0:
                if not pieces.more():
                    raise ValueError("a record is cut off")
            n = left = ends + 4 + int(_headers(pieces.data[:ends])["content-length"]) + 4
            while left > len(pieces.data):
                left -= len(pieces.data)
                pieces.data = b""
                if not pieces.more():
                    raise ValueError("a record is cut off")
            pieces.data = pieces.data[left:]
        yield at, n
        at += n


def record_ranges(archives: DataFrame, path: str = "path") -> DataFrame:
    """Where the records of archives lie: path, start, length, error.

    Each index line names its data member by the last part of its name. Data members that
    no index names are scanned. Compressed or encrypted ones, damaged archives and lines that
    point outside their member give an error row. Of a directory only the data and index
    members are kept in memory.
    """

    def ranges(batches):
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                rows = []
                for row in _archive_ranges(uri):
                    rows.append(row)
                    if len(rows) == _ROWS:
                        yield _table(rows, _RANGES)
                        rows = []
                yield _table(rows, _RANGES)

    return _spread(archives, path).mapInArrow(ranges, "path string, start bigint, length bigint, error string")


def _archive_ranges(path: str) -> Iterator[tuple]:
    try:
        files, place = located(path)
        with files.open_input_file(place) as file:
            data, indexes, named = {}, [], set()
            for m in members(file):
                if not m.name.lower().endswith((".warc", ".warc.gz", ".cdx", ".cdxj")):
                    continue
                if not m.stored:
                    yield path, None, None, f"{m.name} is not stored"
                elif m.name.lower().endswith((".cdx", ".cdxj")):
                    indexes.append((content_start(file, m), m.size))
                else:
                    data[m.name] = (content_start(file, m), m.size)
            by_last = {name.rpartition("/")[2]: name for name in data}
            for line in (line for index in indexes for line in _lines(file, *index)):
                entry = json.loads(line[line.find(b"{") :]) if b"{" in line else {}
                name = by_last.get(str(entry.get("filename", "")).rpartition("/")[2])
                if name:
                    named.add(name)
                    start, length = int(entry["offset"]), int(entry["length"])
                    inside = start >= 0 and length > 0 and start + length <= data[name][1]
                    yield path, data[name][0] + start, length, None if inside else "outside its member"
            for name, (start, size) in data.items():
                if name not in named:
                    for place, length in scanned(file, start, size):
                        yield path, place, length, None
    except (OSError, ValueError, KeyError, zlib.error) as e:
        yield path, None, None, f"{type(e).__name__}: {e}"


def _headers(data: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in data.split(b"\r\n")[1:])
    return {k.strip().lower().decode("latin-1"): v.strip().decode(errors="replace") for k, _, v in pairs}


def parsed(data: bytes) -> dict:
    """Fields of one record, packed or plain; raises ValueError where it is damaged."""
    if data[:2] == b"\x1f\x8b":
        data = zlib.decompress(data, _GZIP)
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    headers = _headers(head)
    block = rest[: int(headers["content-length"])]
    if len(block) < int(headers["content-length"]):
        raise ValueError("a record is cut off")
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = headers.get("warc-type", "")
    whole = int(_headers(http).get("content-length", len(payload))) if kind == "revisit" else len(payload)
    known = headers.get("warc-payload-digest", "").partition(":")[2]
    known = known.lower() if len(known) == 40 else base64.b32decode(known).hex()
    if kind != "revisit":
        digest = hashlib.sha1(payload).hexdigest()
        if known and known != digest:
            raise ValueError("the payload is not that of its digest")
        known = digest
    return {"headers": headers, "record_type": kind, "payload_bytes": whole, "payload_digest": known, "payload": payload}


def read_records(ranges: DataFrame, payloads: bool = True) -> DataFrame:
    """Records read by ranges: path, start, headers, record_type, payload_bytes, payload_digest, payload, error.

    Bytes and digest are those of the full payload, also for revisits, which have none of
    their own. ``payloads=False`` leaves ``payload`` null and saves its way out of the task.
    """
    out = pa.schema(
        [("path", pa.string()), ("start", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())),
         ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("payload", pa.binary()), ("error", pa.string())]
    )

    def joined(batches) -> Iterator[tuple[str, int, list[tuple[int, int]], str | None]]:
        """Neighbouring ranges of a file, as far as they are read together."""
        path, first, parts = None, 0, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["error"] is not None:
                    yield r["path"], r["start"], [], r["error"]
                    continue
                last = sum(parts[-1]) if parts else 0
                end = r["start"] + r["length"]
                if parts and (r["path"] != path or r["start"] - last > _GAP or end - first > _TOGETHER):
                    yield path, first, parts, None
                    parts = []
                if not parts:
                    path, first = r["path"], r["start"]
                parts.append((r["start"], r["length"]))
        if parts:
            yield path, first, parts, None

    def records(batches):
        rows, filled, opened, file = [], 0, None, None
        for path, first, parts, error in joined(batches):
            if error is not None:
                rows.append((path, first, None, None, None, None, None, error))
                continue
            try:
                if path != opened:
                    files, place = located(path)
                    file, opened = files.open_input_file(place), path
                file.seek(first)
                data = file.read(max(s + n for s, n in parts) - first)
            except (OSError, ValueError) as e:
                rows += [(path, s, None, None, None, None, None, f"{type(e).__name__}: {e}") for s, _ in parts]
                continue
            for s, n in parts:
                try:
                    r = parsed(data[s - first : s - first + n])
                except (ValueError, KeyError, zlib.error) as e:
                    rows.append((path, s, None, None, None, None, None, f"{type(e).__name__}: {e}"))
                    continue
                payload = r["payload"] if payloads else None
                fields = (r["record_type"], r["payload_bytes"], r["payload_digest"], payload, None)
                rows.append((path, s, list(r["headers"].items()), *fields))
                filled += 1000 + len(payload or b"")
                if filled >= _OUT_BYTES:
                    yield _table(rows, out)
                    rows, filled = [], 0
        yield _table(rows, out)

    placed = ranges.repartitionByRange("path", "start").sortWithinPartitions("path", "start")
    return placed.mapInArrow(
        records,
        "path string, start bigint, headers map<string,string>, record_type string, payload_bytes bigint, "
        "payload_digest string, payload binary, error string",
    )


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of archives, from a table of their paths."""
    return read_records(record_ranges(archives), payloads)


def source_id(record_headers: str = "headers", name: str = "x-source-id"):
    """The id a record was written for, as text; null where it had none."""
    return F.url_decode(F.replace(F.col(record_headers).getItem(name), F.lit("+"), F.lit("%2B")))
