"""WARC archives of pages: written with deduplication, segments and chunked transfer framing, and read back."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import pick, shared_folder, stored

#: Bytes of a record's block in one segment, of a chunk of the transfer coding, and of an archive before the next.
SEGMENT, CHUNK, ARCHIVE = 1 << 16, 1 << 14, 64 << 20

#: Tasks that read archives, at most; each then reads several.
READERS = 20_000

HTTP_OK = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
#: What flows between reading and joining: a page's columns, then a segment's.
FLOW = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
        "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary(), "origin": pa.string(),
        "number": pa.int32(), "total": pa.int64(), "refers": pa.string(), "block": pa.binary()}
FLOW_SCHEMA = ", ".join(f"{name} {str(kind).replace('int64', 'long').replace('int32', 'int')}" for name, kind in FLOW.items())


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes) -> bytes:
    """A body in chunked transfer coding."""
    parts = []
    for lo in range(0, len(payload), CHUNK):
        part = payload[lo:lo + CHUNK]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        parts.append(body[end + 2:end + 2 + size])
        if len(parts[-1]) != size or body[end + 2 + size:end + 4 + size] != b"\r\n":
            raise ValueError("a chunk is shorter than it says")
        at = end + 4 + size


def member(headers: dict[str, object], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    raw = f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None) -> list[bytes]:
    """The records of a page: a revisit without payload, or a response in one or more segments."""
    own = digest(payload)
    name = f"<urn:page:{page_id}:{own}>"
    # A line break would end the header; such characters are percent-encoded, as in any address.
    uri = None if url is None else "".join(c if c > " " and c != "%" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
    common = {"WARC-Target-URI": uri, "WARC-Payload-Digest": f"sha1:{own}", "Content-Type": "application/http;msgtype=response"}
    if first is not None:
        head = HTTP_OK + b"Content-Length: %d\r\n\r\n" % len(payload)
        return [member({"WARC-Type": "revisit", "WARC-Record-ID": name, "WARC-Refers-To": f"<urn:page:{first}:{own}>",
                        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", **common}, head)]
    block = HTTP_OK + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    cuts = range(0, len(block), SEGMENT)
    out = []
    for number, lo in enumerate(cuts, 1):
        headers = {"WARC-Type": "response", "WARC-Record-ID": name, **common} if number == 1 else {
            "WARC-Type": "continuation", "WARC-Record-ID": f"{name[:-1]}:{number}>", "WARC-Segment-Origin-ID": name}
        if len(cuts) > 1:
            headers["WARC-Segment-Number"] = number
        if number == len(cuts) > 1:
            headers["WARC-Segment-Total-Length"] = len(block)
        out.append(member(headers, block[lo:lo + SEGMENT]))
    return out


def place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pyarrow.fs.FileSystem.from_uri(path)


def first_pages(pages: DataFrame, least: int = 0) -> DataFrame:
    """For each page whose payload has at least ``least`` bytes and also belongs to a smaller page_id: that one."""
    known = pages.select("page_id", "payload").where(F.octet_length("payload") >= least).select(
        "page_id", F.sha1(F.col("payload").cast("binary")).alias("sha1"))
    first = known.groupBy("sha1").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
    return known.join(first.where("first < last").drop("last"), "sha1").where("page_id > first").distinct()


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write (page_id, url, html) as WARC files under ``folder``; returns the list of files, (path, records).

    Equal payloads of at least ``least`` bytes are kept once, by the smallest page_id; others become revisits of it.
    Tasks write under names of their own and list what they wrote, so files of lost attempts are never read.
    Null html is an empty payload, a null url has no header, pages without page_id are always responses, a repeated
    row is written as often as it occurs. Other columns are ignored.
    """
    pages = pick(pages, "page_id", "url", "html").select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    keyed = pages.withColumn("sha1", F.sha1(F.col("payload").cast("binary")))
    marked = keyed.join(first_pages(pages, least), ["page_id", "sha1"], "left").select("page_id", "url", "payload", "first")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, root = place(folder)
        store.create_dir(root, recursive=True)
        out, size, records, number, listed = None, 0, 0, 0, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                for part in record(row[0], row[1], row[2].encode(), row[3]):
                    if out is None or size >= ARCHIVE:
                        if out is not None:
                            out.close()
                            listed.append((name, records))
                        name = f"{folder}/pages-{task.partitionId()}-{task.taskAttemptId()}-{number}.warc.gz"
                        out, size, records, number = store.open_output_stream(place(name)[1], compression=None), 0, 0, number + 1
                    out.write(part)
                    size, records = size + len(part), records + 1
        if out is not None:
            out.close()
            listed.append((name, records))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in listed], pa.string()), pa.array([x[1] for x in listed], pa.int64())],
                                         ["path", "records"])

    return stored(marked.mapInArrow(run, "path string, records long"))


def members(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record in a stream of gzip members, holding one record at a time."""
    waiting = b""
    unpacker, parts = None, []
    while True:
        data = waiting or stream.read(1 << 20)
        waiting = b""
        if not data:
            if unpacker is not None:
                raise ValueError("an archive ends within a record")
            return
        unpacker = unpacker or zlib.decompressobj(31)
        parts.append(unpacker.decompress(data))
        if unpacker.eof:
            waiting, unpacker = unpacker.unused_data, None
            head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
            parts = []
            lines = head.decode().split("\r\n")
            headers = dict(line.split(": ", 1) for line in lines[1:])
            size = int(headers["Content-Length"])
            if not lines[0].startswith("WARC/") or rest[size:] != b"\r\n\r\n":
                raise ValueError("a record is not as long as it says")
            yield headers, rest[:size]


def read_archives(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """The pages in archives listed as (path): page_id, url, payload_bytes, payload_digest, record_type, refers_to and,
    with ``with_payload``, payload (null for revisits).

    Records are parsed where their file is read. Segments, which may lie in any file, meet by the identifier of their
    origin and come in order of their number; a task holds one record at a time. The total length, the transfer coding
    and the payload's digest are verified; a violation raises ValueError. An empty list gives no rows.
    """
    def emit(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * len(FLOW)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, FLOW.values())], list(FLOW))

    def finish(kind: str, origin: str, refers: str | None, url: str | None, claimed: str, block: bytes) -> tuple:
        head, _, body = block.partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        payload = unchunked(body) if fields.get(b"Transfer-Encoding") == b"chunked" else body
        own = claimed.removeprefix("sha1:")
        size = int(fields[b"Content-Length"]) if kind == "revisit" else len(payload)
        if kind != "revisit" and digest(payload) != own:
            raise ValueError(f"the payload of {origin} has another digest")
        return (page_number(origin), None if url is None else unquote(url), size, own, kind, page_number(refers),
                payload if with_payload and kind != "revisit" else None)

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole records as pages, segments as they are."""
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, inside = place(path)
                rows, held = [], 0
                with store.open_input_stream(inside, compression=None) as stream:
                    for h, block in members(stream):
                        number, total = h.get("WARC-Segment-Number"), h.get("WARC-Segment-Total-Length")
                        origin = h.get("WARC-Segment-Origin-ID", h["WARC-Record-ID"])
                        about = h["WARC-Type"], origin, h.get("WARC-Refers-To"), h.get("WARC-Target-URI"), h.get("WARC-Payload-Digest")
                        if number is None:
                            rows.append((*finish(*about, block), origin, 0, None, None, None))
                        else:
                            rows.append((None, about[3], None, about[4], about[0], None, None, origin, int(number),
                                         None if total is None else int(total), about[2], block))
                        held += len(block)
                        if held > 4 << 20:
                            yield emit(rows)
                            rows, held = [], 0
                yield emit(rows)

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pages as they are; segments, sorted by origin and number, become pages."""
        names = list(FLOW)
        column = {name: k for k, name in enumerate(names)}
        origin, firsts, blocks, total = None, [], {}, None

        def close() -> list[tuple]:
            block = b"".join(blocks[n] for n in sorted(blocks))
            if sorted(blocks) != list(range(1, len(blocks) + 1)) or not firsts or len(block) != total:
                raise ValueError(f"segments of {origin} are missing: {len(block)} of {total} bytes")
            # One page for each copy of a repeated row.
            return [(*finish(*first, block), *[None] * 5) for first in firsts]

        for batch in batches:
            rows = []
            for row in zip(*(batch.column(name).to_pylist() for name in names)):
                name, number = row[column["origin"]], row[column["number"]]
                if not number:
                    rows.append(row)
                    continue
                if name != origin:
                    rows += close() if origin is not None else []
                    origin, firsts, blocks, total = name, [], {}, None
                if number == 1:
                    firsts.append((row[column["record_type"]], name, row[column["refers"]], row[column["url"]],
                                   row[column["payload_digest"]]))
                blocks.setdefault(number, row[column["block"]])
                total = total if row[column["total"]] is None else row[column["total"]]
            yield emit(rows)
        if origin is not None:
            yield emit(close())

    # Dealt by number, which adaptive execution leaves alone, however short the list is in bytes.
    paths = pick(files, "path")
    flow = paths.repartition(max(1, min(paths.count(), READERS))).mapInArrow(parse, FLOW_SCHEMA)
    met = flow.repartition("origin").sortWithinPartitions("origin", "number").mapInArrow(joined, FLOW_SCHEMA)
    found = met.drop("origin", "number", "total", "refers", "block")
    return found if with_payload else found.drop("payload")


def page_number(name: str | None) -> int | None:
    """The page_id in a record's identifier."""
    number = None if name is None else name.split(":")[2]
    return None if number in (None, "None") else int(number)


def archived(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write pages to archives in the shared folder and read them back without the payloads."""
    files = write_archives(pages, shared_folder(pages.sparkSession), least)
    return read_archives(files, with_payload=False).drop("url")
