"""Legacy ARC archives: writing, parsing and conversion to WARC.

An ARC file starts with a ``filedesc`` version block that names the version of
its record header lines; each record is a header line of space-separated
fields, the declared number of bytes, and a newline:

* version 1: URL, IP address, archive date, content type, length
* version 2: URL, IP address, archive date, content type, result code,
  checksum, location, offset, file name, length

The converter synthesises what WARC needs and ARC lacks: record identifiers
(name-based UUIDs of the archive position), ISO timestamps, record types and
SHA-256 payload digests. Equal payloads of at least ``min_revisit`` bytes are
stored once; the other records become ``revisit`` records that refer to it.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fsio
from .common import run_dir, spread, written

#: The header line fields of both versions.
VERSION_FIELDS = {
    "1": ("url", "ip", "date", "mime", "length"),
    "2": ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"),
}
#: Fixed value: profile of a revisit by equal payload digest.
IDENTICAL = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


@dataclass
class ArcRecord:
    fields: dict[str, str]
    offset: int
    body: bytes

    def payload(self) -> tuple[bytes, bytes]:
        """(HTTP header block with its blank line or empty, payload)."""
        if self.body.startswith(b"HTTP/"):
            for mark in (b"\r\n\r\n", b"\n\n"):
                if (at := self.body.find(mark)) >= 0:
                    return self.body[: at + len(mark)], self.body[at + len(mark) :]
        return b"", self.body


class _Members:
    """Bytes of a file that is plain or a series of gzip members, read without holding more than is asked for."""

    def __init__(self, file):
        self.file, self.held, self.pos = file, b"", 0
        self.gz = file.read(2) == b"\x1f\x8b"
        file.seek(0)
        self.more = zlib.decompressobj(31) if self.gz else None
        self.raw = b""

    def _fill(self) -> bool:
        if not self.gz:
            got = self.file.read(1 << 16)
            self.held += got
            return bool(got)
        while True:
            if not self.raw:
                self.raw = self.file.read(1 << 16)
                if not self.raw:
                    return False
            if self.more.eof:
                self.more = zlib.decompressobj(31)
            out = self.more.decompress(self.raw)
            self.raw = self.more.unused_data if self.more.eof else b""
            if out:
                self.held += out
                return True

    def line(self) -> bytes:
        while (at := self.held.find(b"\n")) < 0 and self._fill():
            pass
        n = at + 1 if at >= 0 else len(self.held)
        out, self.held = self.held[:n], self.held[n:]
        self.pos += n
        return out

    def take(self, n: int) -> bytes:
        parts, have = [self.held[:n]], min(n, len(self.held))
        self.held = self.held[n:]
        while have < n and self._fill():
            part = self.held[: n - have]
            self.held = self.held[n - have :]
            parts.append(part)
            have += len(part)
        if have < n:
            raise ValueError(f"record declares {n} bytes, {have} are left")
        self.pos += n
        return b"".join(parts)


def parse_arc(file) -> Iterator[ArcRecord]:
    """Records of an ARC file, by the version that its first block names and each line's declared length."""
    data = _Members(file)
    fields = VERSION_FIELDS["1"]
    while line := data.line():
        if not line.strip():
            continue
        offset = data.pos - len(line)
        parts = line.decode("utf-8", "surrogateescape").rstrip("\r\n").split(" ")
        if parts[0].startswith("filedesc:"):
            body = data.take(int(parts[-1]))
            version = body.split(b"\n", 1)[0].split(b" ")[0].decode()
            if version not in VERSION_FIELDS:
                raise ValueError(f"unknown ARC version {version!r}")
            fields = VERSION_FIELDS[version]
            continue
        if len(parts) != len(fields):
            raise ValueError(f"header line has {len(parts)} fields, not {len(fields)}")
        named = dict(zip(fields, parts, strict=True))
        yield ArcRecord(named, offset, data.take(int(named["length"])))


def _quote(url: str | None) -> str:
    """A URL as one header field: bytes up to the blank, and those beyond ASCII, are percent-encoded."""
    return "".join(chr(b) if 32 < b < 127 else f"%{b:02X}" for b in (url or "").encode("utf-8", "surrogatepass"))


def arc_version_block(name: str, version: str, date: str) -> bytes:
    body = f"{version} 0 tidemark\n".encode() + (" ".join(f.title() for f in VERSION_FIELDS[version]) + "\n").encode()
    if version == "1":
        line = f"filedesc://{name} 0.0.0.0 {date} text/plain {len(body)}\n"
    else:
        line = f"filedesc://{name} 0.0.0.0 {date} text/plain 200 - - 0 {name} {len(body)}\n"
    return line.encode() + body + b"\n"


def arc_record(url: str, date: str, mime: str, body: bytes, version: str, name: str, offset: int) -> bytes:
    if version == "1":
        line = f"{url} 0.0.0.0 {date} {mime} {len(body)}\n"
    else:
        line = f"{url} 0.0.0.0 {date} {mime} 200 {hashlib.md5(body).hexdigest()} - {offset} {name} {len(body)}\n"
    return line.encode() + body + b"\n"


def _gz(data: bytes) -> bytes:
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "20240101000000", archive_bytes: int = 8 << 20) -> DataFrame:
    """Write pages as ARC archives (versions 1 and 2 in turn); returns the manifest (archive uri, records).

    A record's body is an HTTP response whose header block carries the page id
    and the payload's length. Null html is an empty payload, a null URL an
    empty-path URN. An archive ends once it holds ``archive_bytes``.
    """
    folder = f"{run_dir(pages.sparkSession)}/arc"
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))

    def write(batches):
        count, done = 0, []

        def records():
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    yield from batch.slice(at, 64).to_pylist()

        source = records()
        row = next(source, None)
        while row is not None:
            version = "12"[count % 2]
            name = f"pages-{count:05d}.arc.gz"
            with fsio.create(folder, f"arc{count:05d}", ".arc.gz") as (uri, out):
                head = arc_version_block(name, version, date)
                out.write(_gz(head))
                offset, n = len(head), 0
                while row is not None and offset < archive_bytes:
                    payload = (row["html"] or "").encode("utf-8", "surrogatepass")
                    own = "" if row["id"] is None else str(row["id"])
                    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\nX-Page-Id: {own}\r\n\r\n".encode()
                    data = arc_record(_quote(row["url"]) or "urn:page:", date, "text/html", http + payload, version, name, offset)
                    out.write(_gz(data))
                    offset += len(data)
                    n += 1
                    row = next(source, None)
            done.append((uri, n))
            count += 1
            yield pa.RecordBatch.from_pydict({"archive": [uri], "records": pa.array([n], pa.int64())})

    return written(rows.mapInArrow(write, "archive string, records long"), "arc-manifest")


def _http_field(http: bytes, name: bytes) -> str | None:
    for line in http.split(b"\r\n"):
        key, _, value = line.partition(b":")
        if key.strip().lower() == name:
            return value.strip().decode("latin-1") or None
    return None


def index_arc(manifest: DataFrame) -> DataFrame:
    """(archive, offset, page_id, bytes, digest) of every record; payloads stay in the archives."""

    def index(batches):
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                out = {"archive": [], "offset": [], "page_id": [], "bytes": [], "digest": []}
                with fsio.reading(uri) as file:
                    for r in parse_arc(file):
                        http, payload = r.payload()
                        own = _http_field(http, b"x-page-id")
                        for k, v in zip(out, (uri, r.offset, int(own) if own else None, len(payload), hashlib.sha256(payload).hexdigest()), strict=True):
                            out[k].append(v)
                yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.string() if k in ("archive", "digest") else pa.int64()) for k, v in out.items()})

    return spread(manifest.select("archive"), "archive").mapInArrow(index, "archive string, offset long, page_id long, bytes long, digest string")


def plan_revisits(index: DataFrame, min_revisit: int = 100) -> DataFrame:
    """The records that become revisits: (archive, offset, to_archive, to_offset).

    Of equal payloads of at least ``min_revisit`` bytes the smallest page id
    (then archive position) stays; null ids come last. The first of each
    payload is an aggregate with partial sums; joining it back is a
    skew-splittable equi-join, and only payloads that repeat take part.
    """
    big = index.where(F.col("bytes") >= min_revisit)
    first = big.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct(F.col("page_id").isNull().alias("no"), "page_id", "archive", "offset")).alias("k"))
    first = first.where("n > 1").select("digest", F.col("k.archive").alias("to_archive"), F.col("k.offset").alias("to_offset"))
    hit = big.select("archive", "offset", "digest").join(first, "digest")
    return hit.where("archive <> to_archive or offset <> to_offset").drop("digest")


def record_id(archive: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset}')}>"


def warc_record(kind: str, ident: str, date: str, extra: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", ident), ("WARC-Date", date), *extra, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "surrogateescape") + b"\r\n" + block + b"\r\n\r\n"


def warc_date(date: str) -> str:
    """ARC's YYYYMMDDhhmmss (or a leading part of it) as an ISO timestamp."""
    d = date + "00000101000000"[len(date) :] if date.isdigit() and len(date) < 14 else date
    return f"{d[0:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def convert(manifest: DataFrame, min_revisit: int = 100) -> DataFrame:
    """Write one WARC file for each ARC archive; returns the manifest (warc uri, records)."""
    folder = f"{run_dir(manifest.sparkSession)}/warc"
    plan = plan_revisits(written(index_arc(manifest), "arc-index"), min_revisit)

    def of_archive(key, arcs, links):
        archive = key[0].as_py()
        to = {o: (a, p) for o, a, p in zip(*(links.column(c).to_pylist() for c in ("offset", "to_archive", "to_offset")), strict=True)}
        n = 0
        with fsio.create(folder, "warc", ".warc.gz") as (uri, out):
            info = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
            out.write(_gz(warc_record("warcinfo", record_id(archive, -1), warc_date("2024"), [("Content-Type", "application/warc-fields")], info)))
            with fsio.reading(archive) as file:
                for r in parse_arc(file):
                    http, payload = r.payload()
                    extra = [("WARC-Target-URI", r.fields["url"]), ("WARC-IP-Address", r.fields["ip"])]
                    extra.append(("WARC-Payload-Digest", "sha256:" + hashlib.sha256(payload).hexdigest()))
                    block = http + payload
                    kind = "response" if http else "resource"
                    extra.append(("Content-Type", "application/http; msgtype=response" if http else r.fields["mime"]))
                    if r.offset in to:
                        kind, block = "revisit", http
                        extra += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", record_id(*to[r.offset]))]
                    out.write(_gz(warc_record(kind, record_id(archive, r.offset), warc_date(r.fields["date"]), extra, block)))
                    n += 1
        return pa.table({"warc": [uri], "records": pa.array([n], pa.int64())})

    n = manifest.count()
    arcs, links = spread(manifest.select("archive"), "archive", rows=n), spread(plan, "archive", rows=n)
    done = arcs.groupBy("archive").cogroup(links.groupBy("archive")).applyInArrow(of_archive, "warc string, records long")
    return written(done, "warc-manifest")


def parse_warc(file) -> Iterator[tuple[dict[str, str], bytes]]:
    """(named header fields in lower case, block) of every record."""
    data = _Members(file)
    while line := data.line():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("record does not start with a version line")
        fields = {}
        while (line := data.line()).strip():
            key, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            fields[key.strip().lower()] = value.strip()
        yield fields, data.take(int(fields["content-length"]))


def read_warc(manifest: DataFrame) -> DataFrame:
    """Every response and revisit record, read from the files.

    Columns page_id, record_id, refers_to_id, record_type, target_uri,
    payload_bytes, payload_digest. A response's digest and size are those of
    the payload read; a revisit's are the declared digest and HTTP content
    length, as its payload is kept with the record it refers to.
    """

    def read(batches):
        for batch in batches:
            for uri in batch.column("warc").to_pylist():
                rows = []
                with fsio.reading(uri) as file:
                    for fields, block in parse_warc(file):
                        kind = fields["warc-type"]
                        if kind not in ("response", "revisit", "resource"):
                            continue
                        http, payload = ArcRecord({}, 0, block).payload()
                        own = _http_field(http, b"x-page-id")
                        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                        told = fields["warc-payload-digest"].removeprefix("sha256:")
                        if kind == "revisit":
                            size, digest = int(_http_field(http, b"content-length") or 0), told
                        elif digest != told:
                            raise ValueError(f"payload digest of {fields['warc-record-id']} differs")
                        rows.append((int(own) if own else None, fields["warc-record-id"], fields.get("warc-refers-to"), kind, fields["warc-target-uri"], size, digest))
                cols = list(zip(*rows, strict=True)) or [()] * 7
                names = ("page_id", "record_id", "refers_to_id", "record_type", "target_uri", "payload_bytes", "payload_digest")
                yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64() if k in ("page_id", "payload_bytes") else pa.string()) for k, v in zip(names, cols, strict=True)})

    schema = "page_id long, record_id string, refers_to_id string, record_type string, target_uri string, payload_bytes long, payload_digest string"
    return spread(manifest.select("warc"), "warc").mapInArrow(read, schema)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = 100) -> DataFrame:
    """Pages to ARC, ARC to WARC, WARC read back: one row per page.

    Returns (page_id, payload_bytes, payload_digest, record_type, refers_to,
    target_uri). Null ids, URLs and html are carried (empty payload); repeated
    rows are records of their own, the first by archive position being the
    response; records of an equal id refer to each other like any others. An
    empty table gives an empty result. Other columns are ignored.
    """
    records = written(read_warc(convert(write_arc(pages, id_col, url_col, html_col), min_revisit)), "warc-records")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri"]
    revisits = records.where("refers_to_id is not null")
    cited = revisits.select(F.col("refers_to_id").alias("cited")).distinct()
    named = records.select("record_id", F.col("page_id").alias("refers_to")).join(cited, F.col("record_id") == F.col("cited")).select("cited", "refers_to")
    plain = records.where("refers_to_id is null").withColumn("refers_to", F.lit(None).cast("long"))
    return plain.select(*cols).union(revisits.join(named, F.col("refers_to_id") == F.col("cited")).select(*cols))
