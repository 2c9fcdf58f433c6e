"""WARC records in ZIP archives: writing with payload deduplication, and reading in place.

An archive is a ZIP file whose members are stored, not compressed: ``archive/data.warc.gz``
holds the records, each a gzip member of its own, and ``indexes/index.jsonl`` one line
per record with its place. A reader
finds both through the central directory (ZIP64 included) and reads records by byte
range; nothing is extracted. Files are reached through pyarrow's file systems, so
the folder may be any URI these know.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import zipfile
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import shared_folder, stored

MIN_REVISIT_BYTES = 100
# An archive is closed at the first record beyond this size.
ARCHIVE_BYTES = 32 << 20
# Records whose places fall into the same stretch are read by one task.
STRETCH_BYTES = 8 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Fixed values of the ZIP format: signatures and the layouts that follow them.
END, END64, LOCATOR64, CENTRAL, LOCAL = (
    b"PK\x05\x06",
    b"PK\x06\x06",
    b"PK\x06\x07",
    b"PK\x01\x02",
    b"PK\x03\x04",
)
END_LAYOUT = struct.Struct("<4s4H2LH")
LOCATOR64_LAYOUT = struct.Struct("<4sLQL")
END64_LAYOUT = struct.Struct("<4sQ2H2L4Q")
CENTRAL_LAYOUT = struct.Struct("<4s6H3L5H2L")
LOCAL_LAYOUT = struct.Struct("<4s5H3L2H")
MAX32, MAX16, ZIP64_EXTRA = 0xFFFFFFFF, 0xFFFF, 1


# --- ZIP --------------------------------------------------------------------------


def read_range(source, offset: int, length: int) -> bytes:
    """Exactly these bytes of a random access file."""
    source.seek(offset)
    data = source.read(length)
    if len(data) != length:
        raise ValueError(f"the archive ends within {length} bytes at {offset}")
    return data


def _directory_place(source, size: int) -> tuple[int, int, int]:
    """Offset, length and entries of the central directory, from the end records."""
    tail_size = min(size, END_LAYOUT.size + MAX16 + LOCATOR64_LAYOUT.size)
    tail = read_range(source, size - tail_size, tail_size)
    at = len(tail) - END_LAYOUT.size
    while at >= 0:
        at = tail.rfind(END, 0, at + len(END))
        if at < 0:
            break
        fields = END_LAYOUT.unpack_from(tail, at)
        if at + END_LAYOUT.size + fields[7] == len(tail):  # the comment reaches the end
            break
        at -= 1
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    entries, length, offset = fields[4], fields[5], fields[6]
    before = at - LOCATOR64_LAYOUT.size
    if before >= 0 and tail[before : before + 4] == LOCATOR64:
        place = LOCATOR64_LAYOUT.unpack_from(tail, before)[2]
        end64 = END64_LAYOUT.unpack(read_range(source, place, END64_LAYOUT.size))
        if end64[0] != END64:
            raise ValueError("no ZIP64 end record where its locator points")
        entries, length, offset = end64[7], end64[8], end64[9]
    return offset, length, entries


def members(source, size: int) -> dict[str, tuple[int, int]]:
    """(offset, length) of the data of every stored member, by name.

    Sizes and places come from the central directory, with those of the ZIP64 field where
    32 bits are too few. Compressed or encrypted members cannot be read by range and
    are left out.
    """
    offset, length, entries = _directory_place(source, size)
    directory = read_range(source, offset, length)
    found, at = {}, 0
    for _ in range(entries):
        entry = CENTRAL_LAYOUT.unpack_from(directory, at)
        if entry[0] != CENTRAL:
            raise ValueError("broken ZIP directory")
        flags, method, packed, full = entry[3], entry[4], entry[8], entry[9]
        name_size, extra_size, comment_size, header = entry[10], entry[11], entry[12], entry[16]
        at += CENTRAL_LAYOUT.size
        name = directory[at : at + name_size].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + name_size : at + name_size + extra_size]
        at += name_size + extra_size + comment_size
        wide = _zip64_values(extra)
        if full == MAX32:
            full = next(wide)
        if packed == MAX32:
            packed = next(wide)
        if header == MAX32:
            header = next(wide)
        if method == zipfile.ZIP_STORED and not flags & 1:
            local = LOCAL_LAYOUT.unpack(read_range(source, header, LOCAL_LAYOUT.size))
            if local[0] != LOCAL:
                raise ValueError(f"no member where the directory places {name}")
            found[name] = (header + LOCAL_LAYOUT.size + local[9] + local[10], full)
    return found


def _zip64_values(extra: bytes) -> Iterator[int]:
    """The 64-bit numbers of the ZIP64 field, in their order."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<2H", extra, at)
        if kind == ZIP64_EXTRA:
            count = length // 8
            yield from struct.unpack_from(f"<{count}Q", extra, at + 4)
            return
        at += 4 + length


# --- WARC -------------------------------------------------------------------------


def record_bytes(page: dict) -> bytes:
    """The WARC record of one page: a response with its payload, or a revisit without."""
    payload = page["payload"]
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    revisit = page["record_type"] == "revisit"
    body = http if revisit else http + payload
    fields = [
        ("WARC-Type", page["record_type"]),
        ("WARC-Record-ID", f"<urn:page:{_id_text(page['page_id'])}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
    ]
    if page["url"] is not None:
        # White space and control characters would end the header line.
        fields.append(("WARC-Target-URI", quote(page["url"], safe="!#$%&'()*+,/:;=?@[]~")))
    fields += [
        ("WARC-Payload-Digest", f"sha256:{page['digest']}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(body))),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", f"<urn:page:{_id_text(page['refers_to'])}>"),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode("utf-8") + body + b"\r\n\r\n"


def _id_text(page_id: str | None) -> str:
    return "none" if page_id is None else page_id


def _id_of(text: str | None) -> str | None:
    number = (text or "").removeprefix("<urn:page:").removesuffix(">")
    return None if number in ("", "none") else number


def parse_record(data: bytes) -> dict:
    """Type, ids, target, digest and payload of a record.

    A revisit has no payload: its length and digest are those its headers tell. The
    digest of a response is computed from its bytes and has to equal the header's.
    """
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = dict(
        line.split(": ", 1) for line in http.decode("latin-1").split("\r\n")[1:]
    )
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "revisit":
        size = int(told["Content-Length"])
    else:
        size = len(payload)
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not fit its digest")
    return {
        "page_id": _id_of(fields["WARC-Record-ID"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": _id_of(fields.get("WARC-Refers-To")),
        "target": fields.get("WARC-Target-URI"),
        "payload": payload if fields["WARC-Type"] != "revisit" else None,
    }


# --- Spark ------------------------------------------------------------------------


def with_record_types(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, digest, record_type, refers_to`` per page.

    Of pages with equal payloads of ``MIN_REVISIT_BYTES`` or more, those with the smallest
    page_id are responses and the others revisit it. A null html is an empty payload. Pages
    without an id can be no one's response, and stay responses themselves.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    told = pages.select("page_id", "url", payload.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    # Only digests that occur again are joined: most pages meet no partner and are not
    # copied, and a hot digest is one row here.
    first = (
        told.where(F.length("payload") >= MIN_REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 and first_id is not null")
        .select("digest", "first_id")
    )
    later = F.coalesce(F.col("page_id") > F.col("first_id"), F.lit(False))
    return told.join(first, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(later, "revisit").otherwise("response").alias("record_type"),
        F.when(later, F.col("first_id")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write the records of each partition to archives; (path, bytes, records) per archive.

    An attempt writes names of its own, and only archives of attempts that ended well are
    in the table returned: a task that is run again leaves at most an unused file.
    """

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        done, archive = [], None
        for batch in batches:
            for page in batch.to_dict("records"):
                if archive is None:
                    archive = _Archive(system, f"{root}/{attempt}-{len(done)}.zip")
                archive.add(page)
                if archive.bytes >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        yield pd.DataFrame(done, columns=["path", "bytes", "records"])

    # Ids as text: pandas would turn a number column with nulls into floating point.
    texts = records.withColumns({n: F.col(n).cast("string") for n in ("page_id", "refers_to")})
    return texts.mapInPandas(written, "path string, bytes long, records long")


class _Archive:
    """One archive being written in a single pass, as object stores need it."""

    def __init__(self, system: fs.FileSystem, path: str):
        self.path, self.bytes, self.lines = path, 0, []
        self.out = system.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(DATA, "w", force_zip64=True)

    def add(self, page: dict) -> None:
        record = gzip.compress(record_bytes(page), mtime=0)
        self.data.write(record)
        place = {"offset": self.bytes, "length": len(record), "digest": page["digest"]}
        self.lines.append(json.dumps(place))
        self.bytes += len(record)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(INDEX, "\n".join(self.lines))
        self.zip.close()
        size = self.out.tell()
        self.out.close()
        return self.path, size, len(self.lines)


def read_index(archives: DataFrame, folder: str) -> DataFrame:
    """(path, offset, length) of every record, the offset counted from the archive's start."""

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch["path"]:
                with system.open_input_file(path) as source:
                    found = members(source, source.size())
                    start, _ = found[DATA]
                    lines = read_range(source, *found[INDEX]).decode().splitlines()
                rows = pd.DataFrame(map(json.loads, lines), columns=["offset", "length"])
                yield pd.DataFrame(
                    {"path": path, "offset": rows["offset"] + start, "length": rows["length"]}
                )

    return archives.select("path").mapInPandas(places, "path string, offset long, length long")


def read_records(index: DataFrame, folder: str, payload: bool = False) -> DataFrame:
    """The parsed records at the places of ``index``, by range reads.

    Places are dealt out by stretches of an archive, so one huge archive is read by many
    tasks. ``target``, and ``payload`` if asked for, follow the columns of the contract.
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target"]
    kinds = ["string", "long", "string", "string", "string", "string"]
    if payload:
        names, kinds = [*names, "payload"], [*kinds, "binary"]
    schema = ", ".join(f"{name} {kind}" for name, kind in zip(names, kinds))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            rows = []
            for path, places in batch.groupby("path"):
                with system.open_input_file(path) as source:
                    for offset, length in zip(places["offset"], places["length"]):
                        record = parse_record(gzip.decompress(read_range(source, offset, length)))
                        rows.append([record[name] for name in names])
            yield pd.DataFrame(rows, columns=names)

    stretch = F.floor(F.col("offset") / STRETCH_BYTES)
    records = index.repartition("path", stretch).mapInPandas(read, schema)
    return records.withColumns({n: F.col(n).cast("long") for n in ("page_id", "refers_to")})


def archive_round_trip(pages: DataFrame, payload: bool = False) -> DataFrame:
    """Write a record per page to archives in the shared folder and read them back.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to`` and ``target`` per
    page; repeated rows are records each, and an empty table writes no archive. The
    archives stay in the folder, as the result is read from them.
    """
    folder = f"{shared_folder(pages.sparkSession)}/archives"
    archives = stored(write_archives(with_record_types(pages), folder))
    index = read_index(archives.repartition("path"), folder)
    return read_records(index, folder, payload)
