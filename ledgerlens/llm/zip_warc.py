"""WARC records in ZIP packages: a writer, and a reader that takes records out by byte ranges.

A package holds ``archive/data.warc.gz`` (one gzip member per record) and ``indexes/index.cdxj``, both stored,
not deflated, so a record's place in the package is its member's place plus its offset. The reader parses the
end records (ZIP64 too) and the central directory, then the index, and reads records by range.

Tasks write and read packages through the file system of their URI (``pyarrow.fs``), never a local folder on a
cluster. File names are unique per attempt and only the manifest of finished tasks names them, so a lost or
repeated task leaves no wrong record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payload and index bytes after which a task starts another package.
PACKAGE_BYTES = 32 << 20
#: Groups of equal payloads that may be broadcast (some 100 bytes each); more are joined by shuffle.
BROADCAST_GROUPS = 50_000
#: Records are range-read together while they follow each other, up to so many bytes.
READ_AHEAD = 4 << 20

# writing -----------------------------------------------------------------------------------------------------


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    digits = urn.strip().removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def warc_record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One record; a revisit holds the HTTP headers only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _urn(page_id),
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else quote(url, safe="%/:=&?~#+!$,;'@()*[]"),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Profile": None if refers_to is None else PROFILE,
        "WARC-Refers-To": None if refers_to is None else _urn(refers_to),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


class _Package:
    """One package being written, front to back."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.wacz"
        system, path = fs.FileSystem.from_uri(self.uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self._out = system.open_output_stream(path)
        self._zip = zipfile.ZipFile(self._out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self._data = self._zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self._index: list[str] = []
        self.size, self._offset = 0, 0

    def add(self, page_id, url, payload, digest, refers_to, date) -> None:
        record = gzip.compress(warc_record(page_id, url, payload, digest, refers_to, date), 5, mtime=0)
        self._data.write(record)
        place = {"offset": self._offset, "length": len(record), "digest": digest, "url": url}
        line = f"{_urn(page_id)} {json.dumps(place)}\n"
        self._index.append(line)
        self._offset += len(record)
        self.size += len(payload) + len(line)

    def close(self) -> tuple[str, int]:
        self._data.close()
        self._zip.writestr(zipfile.ZipInfo(INDEX), "".join(self._index))
        self._zip.close()
        self._out.close()
        return self.uri, len(self._index)


def _write(folder: str, date: str, limit: int):
    def run(batches):
        package = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")]
            for page_id, url, html, refers_to in zip(*columns):
                payload = (html or "").encode("utf-8")
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                package = package or _Package(folder)
                package.add(page_id, url, payload, digest, refers_to, date)
                if package.size >= limit:
                    yield _manifest([package.close()])
                    package = None
        if package:
            yield _manifest([package.close()])

    return run


def _manifest(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())],
        names=["package", "records"],
    )


def _told_by_page(keyed: DataFrame, kept: DataFrame) -> DataFrame:
    """``response`` beside each page. Digests meet without the html, which is dealt by page and payload only."""
    theirs = keyed.select("page_id", "payload").join(kept, "payload").distinct()
    same = F.col("p.payload").eqNullSafe(F.col("t.payload")) & F.col("p.page_id").eqNullSafe(F.col("t.page_id"))
    return keyed.alias("p").join(theirs.alias("t"), same, "left").select("p.*", "t.response")


def write_packages(
    pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
    package_bytes: int = PACKAGE_BYTES, broadcast_groups: int = BROADCAST_GROUPS,
) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) and returns the written manifest ``(package, records)``.

    Of records with equal payloads of at least ``min_bytes``, the largest page_id's is the response and the
    others revisit it; rows that share that page_id are all responses, as are groups without any page_id.
    A null html is an empty payload, a null url is left out. An empty table writes no package.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    keyed = rows.withColumn("payload", F.sha2("html", 256))
    kept = materialize(
        keyed.where(F.octet_length("html") >= min_bytes)
        .groupBy("payload")
        .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 and response is not null")
        .select("payload", "response"),
        "equal-payloads",
    )
    if kept.count() <= broadcast_groups:
        # The pages stay where they lie.
        told = keyed.join(F.broadcast(kept), "payload", "left")
    else:
        told = _told_by_page(keyed, kept)
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    return materialize(
        told.select("page_id", "url", "html", refers.alias("refers_to")).mapInArrow(
            _write(folder, date, package_bytes), "package string, records long"
        ),
        "packages",
    )


# reading -----------------------------------------------------------------------------------------------------


class ZipDirectory:
    """Members of a ZIP file, read from its end by ranges."""

    def __init__(self, source):
        self._source, self._size = source, source.size()
        self.members = self._directory()

    def read(self, start: int, length: int) -> bytes:
        self._source.seek(start)
        return self._source.read(length)

    def _end_record(self) -> tuple[int, int, int]:
        """Entries, size and offset of the central directory."""
        tail_at = max(0, self._size - 65_557)
        tail = self.read(tail_at, self._size - tail_at)
        at = tail.rfind(b"PK\x05\x06")
        while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
            at = tail.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ValueError("no end of central directory: not a ZIP file")
        entries, size, offset = struct.unpack_from("<10xHII", tail, at)[0:3]
        locator_at = tail_at + at - 20
        if locator_at >= 0:
            locator = self.read(locator_at, 20)
            if locator[:4] == b"PK\x06\x07":
                record = self.read(struct.unpack_from("<8xQ", locator)[0], 56)
                if record[:4] != b"PK\x06\x06":
                    raise ValueError("broken ZIP64 end record")
                entries, size, offset = struct.unpack_from("<32xQQQ", record)
        return entries, size, offset

    def _directory(self) -> dict[str, tuple[int, int, int]]:
        """Name: offset of the local header, stored size, method."""
        entries, size, offset = self._end_record()
        data, at, members = self.read(offset, size), 0, {}
        for _ in range(entries):
            if data[at : at + 4] != b"PK\x01\x02":
                raise ValueError("broken central directory")
            method, packed, full, names, extras, comments, local = struct.unpack_from("<10xH8xIIHHH8xI", data, at)
            name = data[at + 46 : at + 46 + names].decode("utf-8")
            extra = data[at + 46 + names : at + 46 + names + extras]
            wide = iter(self._zip64_values(extra))
            full = next(wide) if full == 0xFFFFFFFF else full
            packed = next(wide) if packed == 0xFFFFFFFF else packed
            local = next(wide) if local == 0xFFFFFFFF else local
            members[name] = (local, packed, method)
            at += 46 + names + extras + comments
        return members

    @staticmethod
    def _zip64_values(extra: bytes) -> list[int]:
        at = 0
        while at + 4 <= len(extra):
            kind, length = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                return list(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            at += 4 + length
        return []

    def locate(self, name: str) -> tuple[int, int]:
        """Where a stored member's bytes begin, and how many there are."""
        local, size, method = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is not stored, so its records have no place of their own")
        header = self.read(local, 30)
        if header[:4] != b"PK\x03\x04":
            raise ValueError("broken local header")
        names, extras = struct.unpack_from("<26xHH", header)
        return local + 30 + names + extras, size


def _places(directory: ZipDirectory) -> list[tuple[int, int]]:
    start, size = directory.locate(INDEX)
    lines = directory.read(start, size).decode("utf-8").splitlines()
    places = [json.loads(line.partition(" ")[2]) for line in lines]
    return sorted((p["offset"], p["length"]) for p in places)


def read_records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every indexed record; neighbours are fetched by one range."""
    directory = ZipDirectory(source)
    base, _ = directory.locate(DATA)
    run: list[tuple[int, int]] = []
    for place in [*_places(directory), None]:
        if run and (place is None or place[0] != sum(run[-1]) or sum(place) - run[0][0] > READ_AHEAD):
            data = directory.read(base + run[0][0], sum(run[-1]) - run[0][0])
            for offset, length in run:
                at = offset - run[0][0]
                yield parse_record(gzip.decompress(data[at : at + length]))
            run = []
        if place:
            run.append(place)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k: v.strip() for k, _, v in (line.partition(":") for line in lines)}
    return headers, rest[: int(headers["Content-Length"])]


_READ = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    + [("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.string())]
)


def _row(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    http, _, body = block.partition(b"\r\n\r\n")
    length = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
    return (
        _page(headers["WARC-Record-ID"]),
        headers.get("WARC-Target-URI"),
        length,
        digest,
        kind,
        _page(headers["WARC-Refers-To"]) if kind == "revisit" else None,
        body.decode("utf-8") if with_payload and kind == "response" else None,
    )


def _read(with_payload: bool):
    def run(batches):
        for batch in batches:
            for uri in batch.column("package").to_pylist():
                system, path = fs.FileSystem.from_uri(uri)
                rows, held = [], 0
                with system.open_input_file(path) as source:
                    for headers, block in read_records(source):
                        rows.append(_row(headers, block, with_payload))
                        held += len(block) if with_payload else 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist([dict(zip(_READ.names, r)) for r in rows], schema=_READ)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(_READ.names, r)) for r in rows], schema=_READ)

    return run


def read_packages(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """A row per record of the packages in ``manifest.package``: ids, payload size and digest, type, payload.

    A package is one task's work, its records are read by ranges and checked against their digests. Revisits
    have no payload of their own (null). Without packages the result is empty.
    """
    spread = manifest.select("package").repartition(max(1, manifest.count()), "package")
    return spread.mapInArrow(
        _read(with_payload),
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "payload string",
    )


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes the pages into fresh packages in the shared folder and reads them back."""
    manifest = write_packages(pages, scratch_path(pages.sparkSession, "warc"), min_bytes)
    return read_packages(manifest, with_payload=False)
