"""WARC archives of Zstandard frames: writer and validating reader.

An archive is a leading skippable frame that carries the dictionary (magic
0x184D2A5D), then one Zstandard frame per record. Archives are written by
Spark's own writer, so a lost task is simply run again and the files land in any
store that Spark can write to: a task emits one row per archive and the text
sink writes its bytes as they are. The sink needs a line separator after each
row; it is an empty skippable frame, which every Zstandard reader passes over.

Reading: every file is one row of ``binaryFile`` (archives are cut at
``archive_bytes``, far below Spark's 2 GB limit for one value). The reader loads
the dictionary, decodes frame by frame, and checks for every record: the version line, the
required headers, Content-Length against the decoded block, the closing blank
lines, exactly one record in a frame, the HTTP Content-Length and the payload digest. The
first fault raises ``WarcError`` with file and offset, or, with
``on_error="report"``, becomes a row with ``error`` set; later frames of the file
are still read when the faulty frame's end is known.

Rules: a NULL payload is empty; a NULL or empty url gives no WARC-Target-URI; of records with
equal payloads of at least ``revisit_bytes`` bytes those with the largest id are
responses (so rows that repeat that id are all responses) and the others
revisit it; a NULL id counts as smaller than any number; an empty table gives
no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import col, released, scratch_path

DICT_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
SEPARATOR = struct.pack("<II", 0x184D2A50, 0)  # an empty skippable frame, all ASCII
STEP = 4096
_ESCAPED = "%(0[0-9A-F]|1[0-9A-F]|20|7F|25)"  # what the writer escapes in a url
_REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
READ_SCHEMA = ("file string, offset bigint, page_id bigint, url string, record_type string, refers_to bigint, "
               "payload_bytes bigint, payload_digest string, payload binary, error string")


class WarcError(ValueError):
    pass


def plan_records(pages: DataFrame, id_col: str, url_col: str, payload: Column, revisit_bytes: int = 1000) -> DataFrame:
    """``(page_id, url, payload, refers_to)``: which record revisits which.

    Payloads meet by digest only: one row per digest that occurs twice is
    joined back, and AQE splits a digest that many pages share."""
    body = F.coalesce(payload, F.lit("").cast("binary"))
    p = pages.select(col(id_col).cast("bigint").alias("page_id"), col(url_col).cast("string").alias("url"),
                     body.alias("payload"))
    size = F.octet_length("payload")
    key = F.when(size >= revisit_bytes, F.concat(F.sha2("payload", 256), F.lit(":"), size.cast("string")))
    p = p.withColumn("_key", key)
    groups = (p.where("_key is not null").groupBy(F.col("_key").alias("_of"))
              .agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    j = p.join(groups, F.col("_key") == F.col("_of"), "left")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("_first")), None).otherwise(F.col("_first"))
    return j.select("page_id", "url", "payload", refers.alias("refers_to"))


def _record(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url:
        # Header values hold no line breaks: they are percent-encoded.
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: {digest}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or none where the samples are too few or alike."""
    try:
        return zstandard.train_dictionary(size, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b""


def _writer(archive_bytes: int, dict_bytes: int, samples: int, level: int, date: str):
    def archive(records):
        d = dictionary(records[:samples], dict_bytes) if len(records) >= 16 else b""
        c = (zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=True)
             if d else zstandard.ZstdCompressor(level=level, write_checksum=True))
        lead = struct.pack("<II", DICT_MAGIC, len(d)) + d if d else b""
        return pa.RecordBatch.from_pydict({"archive": pa.array([lead + b"".join(map(c.compress, records))], pa.binary())})

    @released

    def run(batches):
        held, n = [], 0
        for b in batches:
            for i in range(b.num_rows):
                r = [b.column(k)[i].as_py() for k in range(4)]
                held.append(_record(*r, date))
                n += len(held[-1])
                if n >= archive_bytes:
                    yield archive(held)
                    held, n = [], 0
        if held:
            yield archive(held)

    return run


def write_archives(records: DataFrame, path: str, archive_bytes: int = 32 << 20, dict_bytes: int = 16 << 10,
                   samples: int = 256, level: int = 3, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``plan_records`` rows as archives of about ``archive_bytes`` before
    compression (a longer record gets an archive of its own). Each archive's
    dictionary is trained on its first ``samples`` records."""
    rows = records.select("page_id", "url", "payload", "refers_to").mapInArrow(
        _writer(archive_bytes, dict_bytes, samples, level, date), "archive binary")
    (rows.select(F.col("archive").cast("string").alias("value")).write.mode("overwrite")
     .option("lineSep", SEPARATOR.decode("ascii")).option("maxRecordsPerFile", 1).option("compression", "none").text(path))


def frames(data: bytes):
    """(offset, end, decoded bytes or WarcError) for each record frame."""
    pos, decoder = 0, zstandard.ZstdDecompressor()
    while pos < len(data):
        if len(data) - pos < 8:
            yield pos, len(data), WarcError("truncated frame header")
            return
        magic, size = struct.unpack_from("<II", data, pos)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if pos + 8 + size > len(data):
                yield pos, len(data), WarcError("truncated skippable frame")
                return
            if magic == DICT_MAGIC:
                if pos:
                    yield pos, pos + 8 + size, WarcError("dictionary frame is not the first frame")
                else:
                    try:
                        decoder = zstandard.ZstdDecompressor(dict_data=_load(data[8:8 + size]))
                    except zstandard.ZstdError as e:
                        yield pos, len(data), WarcError(f"bad dictionary: {e}")
                        return
            pos += 8 + size
            continue
        if magic != FRAME_MAGIC:
            yield pos, len(data), WarcError("not a Zstandard frame")
            return
        d, parts, end = decoder.decompressobj(), [], pos
        try:
            while not d.eof and end < len(data):  # small steps: what lies behind the frame is copied back
                step = data[end:end + STEP]
                parts.append(d.decompress(step))
                end += len(step)
        except zstandard.ZstdError as e:
            yield pos, len(data), WarcError(f"frame: {e}")
            return
        if not d.eof:
            yield pos, len(data), WarcError("truncated frame")
            return
        end -= len(d.unused_data)
        out = b"".join(parts)
        yield pos, end, out
        pos = end


def _load(raw: bytes) -> zstandard.ZstdCompressionDict:
    """The dictionary may itself be one compressed frame."""
    if raw[:4] == struct.pack("<I", FRAME_MAGIC):
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    return zstandard.ZstdCompressionDict(raw)


def _headers(raw: bytes, first: bytes) -> dict:
    lines = raw.split(b"\r\n")
    if not re.fullmatch(first, lines[0]):
        raise WarcError(f"bad first line {lines[0][:40]!r}")
    out = {}
    for x in lines[1:]:
        k, colon, v = x.partition(b":")
        if not colon or not k.strip():
            raise WarcError(f"bad header line {x[:40]!r}")
        out[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
    return out


def _length(h: dict) -> int:
    v = h.get("content-length", "")
    if not re.fullmatch(r"[0-9]+", v):
        raise WarcError(f"bad Content-Length {v!r}")
    return int(v)


def _id(uri: str):
    m = re.fullmatch(r"<urn:page:(-?[0-9]*)>", uri)
    if not m:
        raise WarcError(f"unknown record id {uri[:60]!r}")
    return int(m[1]) if m[1] else None


def parse_record(rec: bytes) -> dict:
    """One decoded frame as a row, or WarcError."""
    head, gap, rest = rec.partition(b"\r\n\r\n")
    if not gap:
        raise WarcError("no end of headers")
    h = _headers(head, rb"WARC/1\.[01]")
    if missing := [k for k in _REQUIRED if k not in h]:
        raise WarcError(f"missing {', '.join(missing)}")
    n = _length(h)
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise WarcError(f"Content-Length {n} does not fit the {len(rest)} bytes after the headers")
    if h["warc-type"] not in ("response", "revisit"):
        raise WarcError(f"unknown WARC-Type {h['warc-type'][:40]!r}")
    http, gap, payload = rest[:n].partition(b"\r\n\r\n")
    if not gap:
        raise WarcError("no end of HTTP headers")
    size = _length(_headers(http, rb"HTTP/1\.[01] [0-9]{3}.*"))
    label, _, b32 = h.get("warc-payload-digest", "").partition(":")
    try:
        digest = base64.b32decode(b32)
    except ValueError:
        digest = b""
    if label != "sha1" or len(digest) != 20:
        raise WarcError("bad WARC-Payload-Digest")
    revisit = h["warc-type"] == "revisit"
    if revisit and (payload or "warc-refers-to" not in h):
        raise WarcError("a revisit carries a payload or refers to nothing")
    if not revisit and (len(payload) != size or hashlib.sha1(payload).digest() != digest):
        raise WarcError("payload does not fit its length or digest")
    url = h.get("warc-target-uri")
    return {"page_id": _id(h["warc-record-id"]), "url": url and re.sub(_ESCAPED, lambda m: chr(int(m[1], 16)), url),
            "record_type": h["warc-type"], "refers_to": _id(h["warc-refers-to"]) if revisit else None,
            "payload_bytes": size, "payload_digest": digest.hex(), "payload": None if revisit else payload}


def _reader(on_error: str, payloads: bool):
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
    schema = pa.schema([(n, t) for n, t in zip(names, [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                                                       pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()])])

    @released

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                file, data = b.column(0)[k].as_py(), b.column(1)[k].as_py()
                rows, held = [], 0
                for off, _, got in frames(data):
                    row = dict.fromkeys(names) | {"file": file, "offset": off}
                    try:
                        if isinstance(got, WarcError):
                            raise got
                        row |= parse_record(got)
                    except WarcError as e:
                        if on_error == "raise":
                            raise WarcError(f"{file} at {off}: {e}") from None
                        row["error"] = str(e)
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    held += len(row["payload"] or b"") + 200
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_archives(spark, path: str, on_error: str = "raise", payloads: bool = True) -> DataFrame:
    """Every record of the archives under ``path``; see the module's rules."""
    if on_error not in ("raise", "report"):
        raise ValueError("on_error: raise or report")
    files = spark.read.format("binaryFile").load(path).select("path", "content").where("length(content) > 0")
    return files.mapInArrow(_reader(on_error, payloads), READ_SCHEMA)


def roundtrip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(plan_records(pages, id_col, url_col, F.encode(col(html_col), "UTF-8")), path)
    return read_archives(spark, path, payloads=False)
