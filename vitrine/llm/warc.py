"""WARC archives in Zstandard: one frame per record, behind a dictionary in a leading skippable frame.

Writing.  Pages with equal payloads (by SHA-1) are told apart first: the smallest page id of a payload of at least
``least_bytes`` is its ``response``, the others are ``revisit`` records that name it and carry no payload; smaller
payloads are all responses.  The smallest ids are taken by digest and salt, then by digest, and return by digest
and salt, so no group of equal payloads meets in one task.  Every task then writes archives of about
``archive_bytes`` in the shared folder, each named anew, and lists them in a manifest that Spark commits: files of
a lost or repeated task are in no manifest and are never read.

An archive is a skippable frame (magic 0x184D2A5D) that holds the Zstandard dictionary, raw or itself a frame, then
a frame with a ``warcinfo`` record, then a frame for every record.  The dictionary is trained on at most
``DICTIONARY_PAGES`` payloads (their first ``DICTIONARY_CHARS`` characters); without enough of them there is none.

Reading.  Archives come as binary files through Spark.  Frame lengths are read from the block headers, one frame
is decoded at a time, and every record is held to: one record a frame, known version, the named fields that a
record must have, each once, Content-Length equal to the block and followed by two line ends, the HTTP
Content-Length equal to the payload, and block and payload digests that match.  A record that fails is returned
with what could be read and a ``problem``; a damaged frame ends its archive with a problem row.

Defined results: a null payload is empty; a null url becomes a ``urn:page:`` name; white space and control
characters of a url are percent-encoded; rows with a null id are revisits of a smaller id where there is one, else
responses; repeated rows (same id, same payload) are all responses or all revisits; other columns are not used; an
empty table gives no archives and no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sampling import hash_sample
from ..session import ensure_checkpoint_dir

ARCHIVE_BYTES = 8 << 20        # an archive is closed at this size
DICTIONARY_PAGES, DICTIONARY_CHARS, DICTIONARY_BYTES = 1000, 4096, 32 << 10
SALTS = 64                     # parts that a group of equal payloads is dealt over
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the formats.
DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
VERSIONS = ("WARC/1.0", "WARC/1.1")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
CRLF = b"\r\n"


class Damaged(ValueError):
    """What is wrong with a record or a frame."""


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ------------------------------------------------------------------ frames
def frame_length(data: memoryview, at: int) -> int:
    """Bytes of the Zstandard frame at ``at``, from its header and block headers."""
    try:
        flags = data[at + 4]
        single, check = flags >> 5 & 1, flags >> 2 & 1
        size_bytes = (single, 2, 4, 8)[flags >> 6]
        end = at + 5 + (not single) + (0, 1, 2, 4)[flags & 3] + size_bytes
        while True:
            head = data[end] | data[end + 1] << 8 | data[end + 2] << 16
            end += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
            if head & 1:
                break
    except IndexError:
        raise Damaged("truncated frame") from None
    end += 4 * check
    if end > len(data):
        raise Damaged("truncated frame")
    return end - at


def dictionary_frame(dictionary: bytes, level: int = 19) -> bytes:
    """The leading skippable frame; the dictionary is compressed where that is shorter."""
    import zstandard
    packed = zstandard.ZstdCompressor(level=level).compress(dictionary)
    held = min(packed, dictionary, key=len)
    return struct.pack("<II", DICTIONARY_MAGIC, len(held)) + held


def frames(data: bytes, limit: int = 1 << 31) -> Iterator[tuple[int, int, bytes]]:
    """``(offset, bytes, content)`` of every frame of an archive, decoded one at a time with the archive's dictionary."""
    import zstandard
    view, at, decoder = memoryview(data), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        if len(data) - at < 8:
            raise Damaged("truncated frame")
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE:
            if at + 8 + size > len(data):
                raise Damaged("truncated skippable frame")
            if at == 0 and magic == DICTIONARY_MAGIC:
                held = data[8: 8 + size]
                if held[:4] == struct.pack("<I", FRAME_MAGIC):
                    try:
                        held = zstandard.ZstdDecompressor().decompress(held, max_output_size=limit)
                    except zstandard.ZstdError as e:
                        raise Damaged(f"dictionary: {e}") from None
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise Damaged("not a Zstandard frame")
        size = frame_length(view, at)
        try:
            known = zstandard.frame_content_size(view[at: at + size])
            frame = view[at: at + size]
            content = decoder.decompress(frame) if known >= 0 else decoder.decompressobj().decompress(frame)
        except zstandard.ZstdError as e:
            raise Damaged(f"frame: {e}") from None
        yield at, size, content
        at += size


# ------------------------------------------------------------------ records
def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + CRLF + block + CRLF + CRLF


def page_name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def target(url: str | None, page_id: int | None) -> str:
    """The url as one header value: white space and control characters percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f-\x9f]|\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url) if url else page_name(page_id)[1:-1]


def page_record(page_id: int | None, url: str | None, payload: bytes, sha1: str, size: int, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A response with its payload, or a revisit that keeps the HTTP header alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", page_name(page_id)), ("WARC-Date", date),
              ("WARC-Target-URI", target(url, page_id)), ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("WARC-Payload-Digest", f"sha1:{sha1}")]
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", page_name(refers_to))]
    return record(fields, block)


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """``(fields by lower-case name, block)`` of the one record that a frame holds."""
    end = content.find(CRLF + CRLF)
    if end < 0:
        raise Damaged("no end of the record header")
    try:
        version, *lines = content[:end].decode("utf-8").split("\r\n")
    except UnicodeDecodeError:
        raise Damaged("header is not UTF-8") from None
    if version not in VERSIONS:
        raise Damaged("unknown version")
    fields: dict[str, str] = {}
    last = ""
    for line in lines:
        if line[:1] in (" ", "\t") and last:  # a folded line
            fields[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        last = name.strip().lower()
        if not colon or not last:
            raise Damaged("malformed header line")
        if last in fields and last != "warc-concurrent-to":
            raise Damaged(f"repeated field {last}")
        fields[last] = value.strip()
    for name in REQUIRED:
        if not fields.get(name):
            raise Damaged(f"no field {name}")
    if not re.fullmatch(r"[0-9]+", fields["content-length"], re.A):
        raise Damaged("Content-Length is not a number")
    if not re.fullmatch(r"<[^<>\s]+>", fields["warc-record-id"]):
        raise Damaged("malformed WARC-Record-ID")
    if not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?Z", fields["warc-date"], re.A):
        raise Damaged("malformed WARC-Date")
    start = end + 4
    stop = start + int(fields["content-length"])
    if content[stop: stop + 4] != CRLF + CRLF or stop > len(content) - 4:
        raise Damaged("Content-Length does not meet the end of the block")
    if len(content) != stop + 4:
        raise Damaged("more than one record in a frame")
    return fields, content[start:stop]


def judged(fields: dict[str, str], block: bytes) -> dict:
    """Payload and references of a parsed record, with digests and lengths checked."""
    kind = fields["warc-type"].lower()
    out = {"record_type": kind, "record_id": fields["warc-record-id"][1:-1], "target_uri": fields.get("warc-target-uri")}
    stated = fields.get("warc-block-digest")
    if stated and stated.lower().startswith("sha1:") and stated[5:].upper() != digest(block):
        raise Damaged("block digest differs")
    if kind not in ("response", "revisit"):
        return out
    payload, length = block, len(block)
    if fields.get("content-type", "").replace(" ", "").lower().startswith("application/http"):
        head, end, payload = block.partition(CRLF + CRLF)
        if not end or not head.startswith(b"HTTP/"):
            raise Damaged("malformed HTTP header")
        told = re.search(rb"(?mi)^content-length:[ \t]*([0-9]+)[ \t]*\r?$", head)
        length = int(told[1]) if told else len(payload)
    elif kind == "revisit":
        length = None
    stated = fields.get("warc-payload-digest", "")
    sha1 = stated[5:].upper() if stated.lower().startswith("sha1:") else None
    if kind == "revisit":
        refers = fields.get("warc-refers-to", "")
        if not re.fullmatch(r"<[^<>\s]+>", refers) or not sha1 or "warc-profile" not in fields:
            raise Damaged("a revisit without profile, payload digest or the record it refers to")
        if payload and length is not None:
            raise Damaged("a revisit with a payload")
        return out | {"payload_bytes": length, "payload_digest": sha1, "refers_to": refers[1:-1], "payload": None}
    if length != len(payload):
        raise Damaged("HTTP Content-Length differs from the payload")
    if sha1 and sha1 != digest(payload):
        raise Damaged("payload digest differs")
    return out | {"payload_bytes": length, "payload_digest": digest(payload), "payload": payload}


# ------------------------------------------------------------------ writing
def told_apart(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, sha1 (binary), payload_bytes, first`` of every page; ``first`` is the smallest id with an
    equal payload (null: none, or the payload is below ``least_bytes``).  A revisit's payload is null."""
    base = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8").alias("payload"))
    base = (base.withColumn("sha1", F.unhex(F.sha1("payload"))).withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
            .withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))))
    small = base.select("sha1", "salt", "page_id").groupBy("sha1", "salt").agg(F.min("page_id").alias("least"))
    first = small.groupBy("sha1").agg(F.min("least").alias("first"))
    back = small.select("sha1", "salt").join(first, "sha1")  # at most SALTS rows a digest
    found = base.join(back, ["sha1", "salt"]).withColumn("first", F.when(F.col("payload_bytes") >= least_bytes, F.col("first")))
    keep = F.col("first").isNull() | (F.col("page_id") == F.col("first"))
    return found.select("page_id", "url", F.when(keep, F.col("payload")).alias("payload"), "sha1", "payload_bytes", "first")


def train_dictionary(pages: DataFrame, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from at most ``DICTIONARY_PAGES`` payloads (those with the smallest hashes); empty where they are too few."""
    import zstandard
    texts = pages.where(F.length("html") > 0)
    rows = hash_sample(texts, ["page_id", "url"], F.left("html", F.lit(DICTIONARY_CHARS)), DICTIONARY_PAGES, texts.count())
    samples = [r.encode() for r in rows]
    try:
        return zstandard.train_dictionary(min(size, max(sum(map(len, samples)) // 8, 256)), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _write_kernel(folder: str, dictionary: bytes, archive_bytes: int, date: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=True)
        info = packer.compress(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
                                       ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        lead = (dictionary_frame(dictionary) if dictionary else b"") + info
        parts: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{root}/{name}", compression=None) as f:  # (it would pack .zst once more)
                f.write(lead + b"".join(parts))
            row = [[name], [len(parts)], [len(lead) + size]]
            return pa.RecordBatch.from_arrays([pa.array(row[0]), *(pa.array(x, pa.int64()) for x in row[1:])], names=["file", "records", "bytes"])
        for b in batches:
            for i in range(b.num_rows):
                page_id, url, payload, sha1, n, first = (b.column(k)[i].as_py() for k in range(6))
                revisit = payload is None
                parts.append(packer.compress(page_record(page_id, url, payload or b"", base64.b32encode(sha1).decode(), n, first, revisit, date)))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield close()
                    parts, size = [], 0
        if parts:
            yield close()
    return run


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> DataFrame:
    """Write ``(page_id, url, html)`` as archives under ``folder`` (shared by driver and executors); returns the
    committed manifest ``(file, records, bytes)``, stored beside them."""
    spark = pages.sparkSession
    from pyarrow import fs
    store, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    store.create_dir(f"{root}/archives")
    kernel = _write_kernel(f"{folder}/archives", train_dictionary(pages), archive_bytes, date)
    told_apart(pages, least_bytes).mapInArrow(kernel, "file string, records bigint, bytes bigint").write.parquet(f"{folder}/manifest")
    return spark.read.schema("file string, records bigint, bytes bigint").parquet(f"{folder}/manifest")


# ------------------------------------------------------------------ reading
_READ = {"file": pa.string(), "offset": pa.int64(), "frame_bytes": pa.int64(), "record_id": pa.string(), "record_type": pa.string(),
         "target_uri": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.string(),
         "payload": pa.binary(), "problem": pa.string()}
_READ_DDL = ("file string, offset bigint, frame_bytes bigint, record_id string, record_type string, target_uri string, payload_bytes bigint, "
             "payload_digest string, refers_to string, payload binary, problem string")
_ROWS_BYTES = 8 << 20  # payload bytes of an output batch


def read_archive(data: bytes) -> Iterator[dict]:
    """The records of one archive, in order."""
    offset = 0
    try:
        for offset, size, content in frames(data):
            row = {"offset": offset, "frame_bytes": size}
            try:
                fields, block = parse(content)
                row |= {"record_type": fields["warc-type"].lower(), "record_id": fields["warc-record-id"][1:-1]}
                row |= judged(fields, block)
            except Damaged as e:
                row["problem"] = str(e)
            yield row
            offset += size
    except Damaged as e:
        yield {"offset": offset, "problem": str(e)}


def _read_kernel(keep_payload: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(list(_READ.items()))
        for b in batches:
            for i in range(b.num_rows):
                path, rows, size = b.column(0)[i].as_py(), [], 0
                for row in read_archive(b.column(1)[i].as_py()):
                    if not keep_payload:
                        row["payload"] = None
                    rows.append(row | {"file": path.rsplit("/", 1)[-1]})
                    size += len(row.get("payload") or b"") + 200
                    if size >= _ROWS_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in _READ.items()], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in _READ.items()], schema=schema)
    return run


def read_archives(spark: SparkSession, folder: str, keep_payload: bool = True) -> DataFrame:
    """Records of the archives that the manifest under ``folder`` lists."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(f"{folder}/archives").select("path", "content")
    files = files.withColumn("file", F.element_at(F.split("path", "/"), -1))
    listed = spark.read.schema("file string, records bigint, bytes bigint").parquet(f"{folder}/manifest").select("file")
    return files.join(listed, "file", "left_semi").select("path", "content").mapInArrow(_read_kernel(keep_payload), _READ_DDL)


def unresolved(records: DataFrame) -> DataFrame:
    """Claims of revisits (record, digest, length) that no sound response bears out.  Claims are made distinct first, so a
    response with many revisits is no hot key."""
    sound = records.where("problem IS NULL")
    claims = sound.where("record_type = 'revisit'").select(F.col("refers_to").alias("record_id"), "payload_digest", "payload_bytes").distinct()
    return claims.join(sound.where("record_type = 'response'").select("record_id", "payload_digest", "payload_bytes"),
                       ["record_id", "payload_digest", "payload_bytes"], "left_anti")


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write all pages as archives in the shared folder, read them back, and return what the archives say of every page.

    A problem record or a revisit without its response fails the job."""
    spark = pages.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder, least_bytes)
    records = read_archives(spark, folder, keep_payload=False)
    broken = unresolved(records).agg(F.count(F.lit(1)).alias("n")).select((F.col("n") == 0).alias("ok")).first()["ok"]
    if not broken:
        raise Damaged("a revisit refers to no response with its digest and length")
    number = lambda c: F.expr(f"try_cast(substring_index({c}, ':', -1) AS bigint)")
    problem = F.col("problem").isNotNull()
    kind = F.when(problem, F.raise_error(F.concat_ws(": ", "file", "problem")).cast("string")).otherwise(F.col("record_type"))
    return (records.where("record_type IS NULL OR record_type <> 'warcinfo'")
            .select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", kind.alias("record_type"), number("refers_to").alias("refers_to")))
