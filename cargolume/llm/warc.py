"""Web archives as seekable Zstandard bundles.

Records are grouped into independent frames of about `FRAME` bytes; a bundle is its frames and, as a footer, the
seek table of the Zstandard seekable format (a skippable frame with the sizes of all frames). The index maps each
record identifier to bundle, frame and the offset within the frame, so one record is read by one frame.

A payload that occurs several times is stored once: the record with the largest page_id is the response, the others
are revisits, whose HTTP head still states the full payload's length.

Every task writes bundles under fresh names and returns their index; only bundles that the stored index names are
read, so what a lost or repeated task left behind does no harm. Files go through Arrow's file systems to the shared
folder, whatever store that is, and are read back by Spark.

Defined results: a null html is an empty payload; a null page_id is written as such and counts as smallest; a null
url gives a record without target, blanks and control characters in a url are percent-encoded; rows with equal page_id and payload are each written; an empty table gives an
empty index and no rows.
"""

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolume.llm.common import query, stored, table
from cargolume.session import fresh_path

FRAME = 256 << 10
BUNDLE = 16 << 20
DATE = "1970-01-01T00:00:00Z"  # pages carry no date
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

CONTROL = re.compile(r"[\x00-\x20\x7f]")

INDEX = "record_id string, bundle string, frame int, offset long, length long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, bundle string, frame int, offset long"


def name_of(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(name: str | None):
    value = name and name.removeprefix("<urn:page:").removesuffix(">")
    return None if value in (None, "null") else int(value)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, refers_to, revisit: bool) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name_of(page_id)), ("WARC-Date", DATE),
            ("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(block)))]
    if url is not None:
        head.insert(2, ("WARC-Target-URI", CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", url)))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", name_of(refers_to))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """Header fields and block of the record at `at`, and where the next one begins."""
    end = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:end].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no record at {at}")
    head = dict(x.split(": ", 1) for x in lines)
    start, size = end + 4, int(head["Content-Length"])
    if data[start + size:start + size + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at {at} is not closed")
    return head, data[start:start + size], start + size + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *x) for x in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frames(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of each frame, by the bundle's seek table."""
    count, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE:
        raise ValueError("the bundle has no seek table")
    out, at = [], 0
    for k in range(count):
        packed, size = struct.unpack_from("<II", bundle, len(bundle) - 9 - 8 * (count - k))
        out.append((at, packed, size))
        at += packed
    return out


def frame_bytes(bundle: bytes, frame: int) -> bytes:
    at, packed, size = frames(bundle)[frame]
    return zstandard.ZstdDecompressor().decompress(bundle[at:at + packed], max_output_size=size)


class Bundle:
    """Frames being gathered for one file."""

    def __init__(self):
        self.name, self.sizes, self.packed, self.open, self.index, self.written = f"{uuid.uuid4().hex}.warc.zst", [], [], [], [], 0
        self.held, self.press = 0, zstandard.ZstdCompressor(level=3)

    def add(self, name: str, data: bytes):
        self.index.append((name, self.name, len(self.packed), self.held, len(data)))
        self.open.append(data)
        self.held += len(data)
        if self.held >= FRAME:
            self.close_frame()

    def close_frame(self):
        if self.open:
            packed = self.press.compress(b"".join(self.open))
            self.sizes.append((len(packed), self.held))
            self.packed.append(packed)
            self.written += self.held
            self.open, self.held = [], 0

    def store(self, folder: str):
        self.close_frame()
        store, root = fs.FileSystem.from_uri(folder)
        with store.open_output_stream(f"{root}/{self.name}", compression=None) as out:
            for packed in self.packed:
                out.write(packed)
            out.write(seek_table(self.sizes))
        columns = zip(*self.index)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()))],
            ["record_id", "bundle", "frame", "offset", "length"])


def with_kinds(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, refers_to and revisit: of equal payloads the largest page_id is the response."""
    p = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("key", F.sha2("payload", 256))
    kept = p.groupBy("key").agg(F.max("page_id").alias("refers_to"))
    return p.join(kept, "key").select("page_id", "url", "payload", "refers_to", (~F.col("page_id").eqNullSafe(F.col("refers_to"))).alias("revisit"))


def write_bundles(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record per page and returns the stored index."""

    def run(batches):
        bundle = None
        for batch in batches:
            for page_id, url, payload, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                bundle = bundle or Bundle()
                bundle.add(name_of(page_id), record(page_id, url, payload, refers_to, revisit))
                if bundle.written >= BUNDLE:
                    yield bundle.store(folder)
                    bundle = None
        if bundle:
            yield bundle.store(folder)

    spark = pages.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)
    return stored(with_kinds(pages).mapInArrow(run, INDEX), "warc-index")


def read_records(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """One row per record of the bundles that the index names, each found where the index says; checks every payload."""

    def run(batches):
        for batch in batches:
            for path, content in zip(*(c.to_pylist() for c in batch.columns)):
                bundle = path.rsplit("/", 1)[1]
                for k in range(len(frames(content))):
                    data, at, rows = frame_bytes(content, k), 0, []
                    while at < len(data):
                        head, block, after = parse(data, at)
                        http, payload = block.split(b"\r\n\r\n", 1)
                        size = int(http.decode().rsplit("Content-Length: ", 1)[1].split("\r\n")[0])
                        stated, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
                        if kind == "response" and (len(payload) != size or digest(payload) != stated):
                            raise ValueError(f"payload of {head['WARC-Record-ID']} differs from its digest")
                        url = head.get("WARC-Target-URI")
                        rows.append((page_of(head["WARC-Record-ID"]), url, size, stated, kind, page_of(head.get("WARC-Refers-To")), bundle, k, at))
                        at = after
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names)

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64()]
    names = [x.split()[0] for x in RECORD.split(", ")]
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(run, RECORD).join(index.select("bundle", "frame", "offset"), ["bundle", "frame", "offset"], "left_semi")


def archive(pages: DataFrame) -> DataFrame:
    """Writes all pages, reads the bundles back: a row per record."""
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    return read_records(spark, folder, write_bundles(pages, folder))


SQL = """
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (k // 4) AS INT), 5) AS INT) >> CAST(15 - 5 * (k % 4) AS INT)) & 31) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h,
  max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages)
"""


@query("op5_warc", SQL)
def op5_warc(spark, folder):
    return archive(table(spark, folder, "pages", "page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
