"""Web archives as seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each with whole WARC records, and ends in a
skippable frame with the seek table (compressed and plain size of each frame, then a footer).
Bundles are the rows of a table in shared storage, so they are committed with the job and survive
lost executors; the index maps a record to its bundle, frame and place in the frame, and one
record is read by unpacking one frame.  Equal payloads are stored once, the others as revisits.
Responses are written first, so that a revisit can name the record that it refers to.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import uuid
from collections.abc import Iterator

import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettera.llm.common import map_batches, stored
from lettera.operators.joins import left_lookup

#: Fixed values of the seekable format: marks of a skippable frame and of the footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 16 << 20
LEAST_BYTES = 1000


def record(page: int | None, name: str, url: str, payload: bytes | None, size: int, digest: str,
           refers: str | None) -> bytes:
    """One WARC/1.1 record; a revisit has headers only and names the record it refers to."""
    sha = base64.b32encode(bytes.fromhex(digest)).decode()
    revisit, body = refers is not None, payload or b""
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{name}>", "WARC-Date: 1970-01-01T00:00:00Z",
        "WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if c <= " " else c for c in url),
        f"WARC-Payload-Digest: sha1:{sha}", f"X-Page-ID: {'' if page is None else page}",
        f"X-Payload-Length: {size}", "Content-Type: text/html;charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    if revisit:
        head.insert(5, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.insert(6, f"WARC-Refers-To: <urn:uuid:{refers}>")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, body and the end of the record that begins at ``at``."""
    end = raw.index(b"\r\n\r\n", at)
    first, *lines = raw[at:end].decode("utf-8", "surrogatepass").split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not the begin of a record")
    head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    size = int(head["Content-Length"])
    body = raw[end + 4 : end + 4 + size]
    if raw[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
        raise ValueError("a record doesn't end where it says")
    return head, body, end + 8 + size


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame with sizes (compressed, plain) and the footer."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frames_of(bundle: bytes) -> list[tuple[int, int, int]]:
    """Offset, compressed and plain size of each frame, by the seek table at the end."""
    count, flags, mark = struct.unpack("<IBI", bundle[-9:])
    if mark != SEEKABLE or flags:
        raise ValueError("no seek table")
    table, out, at = bundle[-9 - 8 * count : -9], [], 0
    for packed, plain in struct.iter_unpack("<II", table):
        out.append((at, packed, plain))
        at += packed
    return out


def unpack(bundle: bytes, frame: int) -> bytes:
    """The records of one frame; no other is touched."""
    at, packed, plain = frames_of(bundle)[frame]
    return zstandard.ZstdDecompressor().decompress(bundle[at : at + packed], max_output_size=plain)


def payload_of(html: Column) -> Column:
    return F.encode(F.coalesce(html.cast("string"), F.lit("")), "UTF-8")


def marked(pages: DataFrame) -> DataFrame:
    """``pages`` with payload, digest and, for revisits, ``refers``.

    Of equal payloads of ``LEAST_BYTES`` or more the largest page_id is the response and the
    others refer to it; rows that repeat that very page_id are responses too.  A null page_id
    never is referred to; if a payload has null ids only, all its rows are responses.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        payload_of(F.col("html")).alias("payload"),
    )
    digests = rows.select("page_id", F.sha1("payload").alias("digest"), F.length("payload").alias("n"))
    largest = (
        digests.filter(F.col("n") >= LEAST_BYTES).groupBy("digest")
        .agg(F.max("page_id").alias("last"), F.count("*").alias("c"))
        .filter((F.col("c") > 1) & F.col("last").isNotNull()).select("digest", "last")
    )
    return rows.withColumn("digest", F.sha1("payload")).join(largest, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
        .alias("refers"),
    )


ENTRY = "struct<record_id:string,page_id:long,digest:string,frame:int,start:long,length:long>"


def _bundles(rows: DataFrame, run: uuid.UUID, level: int) -> DataFrame:
    """Stored bundles of ``rows`` (page_id, url, payload, size, digest, refers) and their entries."""
    def work(batches) -> Iterator[dict]:
        pack = zstandard.ZstdCompressor(level=level, write_content_size=True)
        frames: list[bytes] = []
        sizes: list[tuple[int, int]] = []
        entries: list[dict] = []
        raw = bytearray()
        task, count = TaskContext.get().partitionId(), 0
        name = uuid.uuid5(run, f"{task}\n{count}")

        def close_frame() -> None:
            if raw:
                frames.append(pack.compress(bytes(raw)))
                sizes.append((len(frames[-1]), len(raw)))
                raw.clear()

        def bundle() -> dict:
            close_frame()
            out = {"bundle": str(name), "bytes": b"".join([*frames, seek_table(sizes)]), "entries": list(entries)}
            frames.clear(), sizes.clear(), entries.clear()
            return out

        for batch in batches:
            for row in batch.to_pylist():
                rid = str(uuid.uuid5(name, str(len(entries))))
                data = record(row["page_id"], rid, row["url"] or "", row["payload"], row["size"],
                              row["digest"], row["refers"])
                entries.append({"record_id": rid, "page_id": row["page_id"], "digest": row["digest"],
                                "frame": len(frames), "start": len(raw), "length": len(data)})
                raw += data
                if len(raw) >= FRAME_BYTES:
                    close_frame()
                    if sum(s for s, _ in sizes) >= BUNDLE_BYTES:
                        yield bundle()
                        count += 1
                        name = uuid.uuid5(run, f"{task}\n{count}")
        if entries:
            yield bundle()

    return stored(
        map_batches(rows, work, f"bundle string, bytes binary, entries array<{ENTRY}>", rows=1),
        "warc-bundles",
    )


def write_archives(pages: DataFrame, level: int = 3) -> tuple[DataFrame, DataFrame]:
    """The stored bundles (bundle, bytes) and index (record_id, page_id, bundle, frame, start, length).

    Frames hold whole records of about ``FRAME_BYTES``, bundles frames of about ``BUNDLE_BYTES``
    (a longer record has a frame of its own).  No pages: no bundles.  A bundle is named by this
    call, its task and a count within the task, and a record by its bundle and its place there,
    so repeated rows have names of their own; what is stored keeps its names.  Responses come
    first; where rows repeat a response, its revisits refer to the one with the least name.
    """
    rows, run = marked(pages), uuid.uuid4()
    size = F.length("payload").alias("size")
    responses = _bundles(
        rows.filter(F.col("refers").isNull()).select(
            "page_id", "url", "payload", size, "digest", F.lit(None).cast("string").alias("refers")
        ),
        run, level,
    )
    again = stored(
        rows.filter(F.col("refers").isNotNull()).select("page_id", "url", size, "digest", "refers"),
        "warc-revisits",
    )
    names = responses.select(F.explode("entries").alias("e")).groupBy(
        F.col("e.digest").alias("digest"), F.col("e.page_id").alias("refers")
    ).agg(F.min("e.record_id").alias("name"))
    revisits = _bundles(
        left_lookup(again, names, ["digest", "refers"], split_hot=True).select(
            "page_id", "url", F.lit(None).cast("binary").alias("payload"), "size", "digest",
            F.col("name").alias("refers"),
        ),
        uuid.uuid5(run, "revisits"), level,
    )
    every = responses.unionByName(revisits)
    index = every.select("bundle", F.explode("entries").alias("e")).select(
        "e.record_id", "e.page_id", "bundle", "e.frame", "e.start", "e.length"
    )
    return every.select("bundle", "bytes"), index


RECORD = (
    "record_id string, page_id long, url string, record_type string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary"
)


def read_archives(bundles: DataFrame) -> DataFrame:
    """Every record of ``bundles``: record_id, page_id, url, record_type, refers_to (a record_id),
    payload_bytes, payload_digest (hex), payload (null for a revisit)."""
    def work(batches) -> Iterator[dict]:
        for batch in batches:
            for item in batch.column(0):
                data = item.as_buffer().to_pybytes()
                for frame in range(len(frames_of(data))):
                    raw, at = unpack(data, frame), 0
                    while at < len(raw):
                        head, body, at = parse(raw, at)
                        yield _row(head, body)

    return map_batches(
        bundles.select("bytes"), work,
        RECORD, rows=64,
    )


def _row(head: dict[str, str], body: bytes) -> dict:
    """A record as a row; the digest of a response is checked against its payload."""
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    revisit = head["WARC-Type"] == "revisit"
    if not revisit and hashlib.sha1(body).hexdigest() != digest:
        raise ValueError("a payload doesn't match its digest")
    return {
        "record_id": head["WARC-Record-ID"][10:-1], "url": head["WARC-Target-URI"],
        "page_id": int(head["X-Page-ID"]) if head["X-Page-ID"] else None,
        "record_type": head["WARC-Type"],
        "refers_to": head["WARC-Refers-To"][10:-1] if revisit else None,
        "payload_bytes": int(head["X-Payload-Length"]) if revisit else len(body),
        "payload_digest": digest, "payload": None if revisit else body,
    }


def read_records(bundles: DataFrame, index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records whose ``record_id`` is in ``wanted``, by the index: only their frames are unpacked.

    A bundle meets the places asked for in it as one row, and each of its frames is unpacked once.
    """
    def work(batches) -> Iterator[dict]:
        for batch in batches:
            for item, places in zip(*batch.columns, strict=True):
                data, opened = item.as_buffer().to_pybytes(), None
                for place in sorted(places.as_py(), key=lambda p: (p["frame"], p["start"])):
                    if opened != place["frame"]:
                        opened, raw = place["frame"], unpack(data, place["frame"])
                    head, body, _ = parse(raw, place["start"])
                    yield _row(head, body)

    places = (
        index.join(wanted.select("record_id").distinct(), "record_id", "left_semi")
        .groupBy("bundle").agg(F.collect_list(F.struct("frame", "start")).alias("places"))
    )
    return map_batches(bundles.join(places, "bundle").select("bytes", "places"), work, RECORD, rows=64)


def write_files(bundles: DataFrame, folder: str) -> None:
    """Each bundle as ``<bundle>.warc.zst`` in ``folder``, which all executors must share.

    A file gets its name only once it is whole, so a repeated task does no harm.
    """
    if "://" in folder or not os.path.isabs(folder):
        raise ValueError("name an absolute path in storage that all executors mount")

    def work(batches) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                part = os.path.join(folder, f".{row['bundle']}.{uuid.uuid4().hex}")
                with open(part, "wb") as out:
                    out.write(row["bytes"])
                os.replace(part, os.path.join(folder, f"{row['bundle']}.warc.zst"))
                yield {"bundle": row["bundle"]}

    map_batches(bundles, work, "bundle string").write.format("noop").mode("overwrite").save()


def archived(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) written to archives and read back, without the payloads.

    What a revisit tells of its payload, and ``refers_to``, the page it repeats, are read from the
    record that it names, which is found by the index.
    """
    bundles, index = write_archives(pages)
    rows = stored(
        read_archives(bundles).drop("payload", "url").withColumnRenamed("refers_to", "name"), "warc-rows"
    )
    named = rows.filter(F.col("name").isNotNull()).select(F.col("name").alias("record_id"))
    originals = read_records(bundles, index, named).select(
        F.col("record_id").alias("name"), F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("bytes"), F.col("payload_digest").alias("digest"),
    )
    return left_lookup(rows, originals, ["name"], split_hot=True).select(
        "page_id", F.coalesce("bytes", "payload_bytes").alias("payload_bytes"),
        F.coalesce("digest", "payload_digest").alias("payload_digest"), "record_type", "refers_to",
    )
