"""WARC archives: written as whole-file gzip streams, normalised to one gzip member a record, and read back.

`write_archives` makes archives as many crawlers leave them: one gzip stream for the whole file, in which no record
can be reached without inflating all before it. `normalise` inflates such a file once from front to end, with bounded
buffers, writes each record as a gzip member of its own, and puts an index (offset and length of each member) beside
it. `read_records` then reaches every record by its offset.

Of pages with equal payloads of at least `MIN_SHARED` bytes the one with the smallest page_id holds the payload, and
the others refer to it.

Cases: a null html is an empty payload; a null url leaves the target out, control characters in a url are escaped.
Pages without an id are written too; in a group they refer to the smallest id, and a group without any id consists of
responses. Repeated rows with the smallest id are all responses. An empty table gives no archive and no rows. Other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm import shared_files
from answerloom.session import new_folder, write_and_reload

MIN_SHARED = 100
#: An archive is closed once it holds so many bytes before compression.
ARCHIVE_BYTES = 64 << 20
LEVEL = 6
#: A digest of which many pages have copies is dealt to so many tasks.
SALTS = 16

ONE_MEMBER = 31  # zlib's window bits for a gzip stream
CONTROL = re.compile(r"[\x00-\x20\x7f]")
INDEX = pa.schema([("page_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])


def with_references(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest and refers_to of each page.

    Only digests that several pages share are joined, salted, so a group of any size is dealt evenly.
    """
    plain = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    plain = plain.withColumn("digest", F.sha2(F.encode("payload", "utf-8"), 256))
    shared = (
        plain.where(F.octet_length("payload") >= MIN_SHARED).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("pages"))
        .where("pages > 1 AND first IS NOT NULL")
        .select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = plain.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    return salted.join(shared, ["digest", "salt"], "left").select(
        "page_id", "url", "payload", "digest",
        F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record; a revisit keeps the HTTP header of its page, and so its length, but no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        escaped = CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {escaped}")
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def _page(uri: str | None) -> int | None:
    return int(uri.strip("<>").rpartition(":")[2]) if uri else None


def parse_record(whole: bytes) -> tuple:
    """page_id, payload_bytes, payload_digest, record_type, refers_to. A response's payload is measured and hashed."""
    at = whole.index(b"\r\n\r\n")
    head = parse_head(whole[:at])
    block = memoryview(whole)[at + 4 : at + 4 + int(head["content-length"])]
    http_end = whole.index(b"\r\n\r\n", at + 4) - (at + 4) + 4
    named = int(re.search(rb"\r\nContent-Length: (\d+)", bytes(block[:http_end]))[1])
    stated = head["warc-payload-digest"].removeprefix("sha256:")
    kind, page, target = head["warc-type"], _page(head.get("warc-record-id")), _page(head.get("warc-refers-to"))
    if kind == "response":
        payload = block[http_end:]
        found = hashlib.sha256(payload).hexdigest()
        if (len(payload), found) != (named, stated):
            raise ValueError(f"page {page}: the payload differs from its header")
    return page, named, stated, kind, target


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Monolithic gzip archives of the pages from `with_references`; their paths."""
    shared_files.make_folder(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        rows = (x for b in batches for x in zip(*(c.to_pylist() for c in b.columns), strict=True))
        row = next(rows, None)
        while row is not None:
            path, size = f"{folder}/pages-{task:06d}-{number:04d}.warc.gz", 0
            with shared_files.created(path) as out:
                stream = zlib.compressobj(LEVEL, zlib.DEFLATED, ONE_MEMBER)
                while row is not None and size < ARCHIVE_BYTES:
                    page_id, url, payload, digest, refers_to = row
                    data = record(page_id, url, payload.encode(), digest, refers_to)
                    size += len(data)
                    out.write(stream.compress(data))
                    row = next(rows, None)
                out.write(stream.flush())
            yield pa.RecordBatch.from_pydict({"path": [path]})
            number += 1

    return pages.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(run, "path string")


def inflated_records(source: pa.NativeFile, chunk: int = 1 << 20) -> Iterator[bytes]:
    """Records of a gzip file, whatever its members, inflated once; a chunk and one record are held at a time."""
    stream, held = zlib.decompressobj(ONE_MEMBER), bytearray()
    need = 0
    while block := source.read(chunk):
        while block:
            held += stream.decompress(block)
            block = stream.unused_data
            if block:  # the next member
                stream = zlib.decompressobj(ONE_MEMBER)
        start = 0
        while True:
            if not need:
                end = held.find(b"\r\n\r\n", start)
                if end < 0:
                    break
                need = end + 4 - start + int(parse_head(bytes(held[start:end]))["content-length"]) + 4
            if len(held) - start < need:
                break
            yield bytes(held[start : start + need])
            start, need = start + need, 0
        del held[:start]
    if held or need:
        raise ValueError("the archive ends within a record")


def normalise_file(path: str, target: str) -> int:
    """Rewrite one archive with a member a record and an index beside it; the number of records."""
    ids, offsets, lengths, at = [], [], [], 0
    with shared_files.streamed(path) as source, shared_files.created(target) as out:
        for whole in inflated_records(source):
            member = zlib.compressobj(LEVEL, zlib.DEFLATED, ONE_MEMBER)
            data = member.compress(whole) + member.flush()
            out.write(data)
            ids.append(_page(parse_head(whole[: whole.index(b"\r\n\r\n")]).get("warc-record-id")))
            offsets.append(at)
            lengths.append(len(data))
            at += len(data)
    with shared_files.created(f"{target}.index") as out, pa.ipc.new_file(out, INDEX) as sink:
        sink.write(pa.record_batch([pa.array(ids, pa.int64()), pa.array(offsets, pa.int64()),
                                    pa.array(lengths, pa.int64())], schema=INDEX))
    return len(ids)


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """path and records of each rewritten archive."""
    shared_files.make_folder(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                target = f"{folder}/{path.rpartition('/')[2]}"
                yield pa.RecordBatch.from_pydict({"path": [target], "records": [normalise_file(path, target)]})

    return archives.select("path").mapInArrow(run, "path string, records long")


READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                  ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_record(archive: pa.NativeFile, offset: int, length: int) -> bytes:
    archive.seek(offset)
    return zlib.decompress(archive.read(length), ONE_MEMBER)


def read_records(archives: DataFrame, rows: int = 2000) -> DataFrame:
    """Every record of normalised archives, each reached by its place in the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with shared_files.opened(f"{path}.index") as index:
                    places = pa.ipc.open_file(index).read_all()
                spans = list(zip(places["offset"].to_pylist(), places["length"].to_pylist(), strict=True))
                with shared_files.opened(path) as archive:
                    for i in range(0, len(spans), rows):
                        found = [parse_record(read_record(archive, *span)) for span in spans[i : i + rows]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), READ, strict=True)],
                            schema=READ)

    return archives.select("path").mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write, normalise and read back all pages; one row per page from the archives."""
    spark = pages.sparkSession
    written = write_and_reload(write_archives(with_references(pages), new_folder(spark, "warc-whole")), "warc-paths")
    tasks = spark.sparkContext.defaultParallelism * 4
    rewritten = write_and_reload(
        normalise(written.repartition(tasks, "path"), new_folder(spark, "warc-members")), "warc-paths")
    return read_records(rewritten.repartition(tasks, "path"))
