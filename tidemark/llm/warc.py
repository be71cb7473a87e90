"""WARC archives with Zstandard, one frame per record and a shared dictionary.

Layout of an archive: a skippable frame (magic 0x184D2A5D) that holds the
dictionary, then one Zstandard frame per WARC record.  The reader loads the
dictionary from the leading skippable frame (raw, or itself a Zstandard
frame), walks the frame headers to find each record's end, decodes one frame
at a time and validates version, headers, lengths and digests.

Archives are rows of a Parquet table ``(archive, n_records, data)``, written
by tasks with Spark's writer, so they work on any file system and a task can
be run again; ``read_archives`` also reads ``.warc.zst`` files by path.

Equal payloads: the record with the largest key is a ``response``, the others
are ``revisit`` records that refer to it.  A null payload is an empty one, a
null URL leaves the header out.  Rows repeated with the largest key are all
responses.  Keys of any type come back as they were (escaped in the headers;
a null key has a name of its own).  An empty table gives no archives and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hash_sample, map_arrow, written

FRAME_MAGIC = 0xFD2FB528
DICT_FRAME_MAGIC = 0x184D2A5D
NO_KEY = "<urn:no-page>"
_URL_SAFE = "!#$%&'()*+,/:;=?@[]~"
_SAFE = "!#$&'()*+,/:;=?@[]~"  # without the percent sign, so that keys come back as they were
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def frame_end(data, at: int) -> int:
    """End of the frame (skippable or not) that begins at ``at``, from its headers alone."""
    magic = int.from_bytes(data[at : at + 4], "little")
    if 0x184D2A50 <= magic <= 0x184D2A5F:
        end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
    elif magic == FRAME_MAGIC:
        head = data[at + 4]
        single = head >> 5 & 1
        pos = at + 5 + (0 if single else 1) + (0, 1, 2, 4)[head & 3] + ((1 if single else 0), 2, 4, 8)[head >> 6]
        last = 0
        while not last:
            if pos + 3 > len(data):
                raise ValueError(f"truncated block header at {pos}")
            block = int.from_bytes(data[pos : pos + 3], "little")
            last, kind, size = block & 1, block >> 1 & 3, block >> 3
            if kind == 3:
                raise ValueError(f"reserved block type at {pos}")
            pos += 3 + (1 if kind == 1 else size)
        end = pos + 4 * (head >> 2 & 1)
    else:
        raise ValueError(f"no Zstandard frame at {at}")
    if end > len(data):
        raise ValueError(f"truncated frame at {at}")
    return end


def load_dictionary(data) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary of the leading skippable frame, if there is one, and where the records begin."""
    if len(data) < 8 or int.from_bytes(data[:4], "little") != DICT_FRAME_MAGIC:
        return None, 0
    end = frame_end(data, 0)
    body = bytes(data[8:end])
    if body[:4] == struct.pack("<I", FRAME_MAGIC):
        body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
    return zstandard.ZstdCompressionDict(body), end


def train_dictionary(samples: list[bytes], size: int = 16_384) -> bytes:
    """A dictionary from sample payloads; empty where there is too little to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _urn(key) -> str:
    """A key as a header value: control characters and all but ASCII escaped; null has a name of its own."""
    return NO_KEY if key is None else f"<urn:page:{quote(str(key), safe=_SAFE)}>"


def _bare(urn: str | None) -> str | None:
    if urn is None or urn == NO_KEY:
        return None
    return unquote(urn[10:-1]) if urn.startswith("<urn:page:") else urn.removesuffix(">")


def page_record(key, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """One response or (``refers_to`` given) revisit record."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _urn(key)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe=_URL_SAFE)))
    headers += [("WARC-Payload-Digest", digest), ("Content-Type", "application/http;msgtype=response")]
    if refers_to is not None:
        headers += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _record(headers, block + (payload if refers_to is None else b""))


def parse_record(raw: bytes) -> dict:
    """Headers, block and payload of one decoded record, after validation."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not sep or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError(f"no WARC version line: {lines[0][:40]!r}")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"bad header line {line[:60]!r}")
        headers[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ValueError(f"header {name} is missing")
    n = int(headers["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"{headers['warc-record-id']}: {len(rest) - 4} bytes of block, Content-Length {n}")
    block = rest[:n]
    out = {"headers": headers, "block": block, "type": headers["warc-type"]}
    if out["type"] in ("response", "revisit"):
        http, sep, body = block.partition(b"\r\n\r\n")
        length = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
        if not sep or length is None:
            raise ValueError(f"{headers['warc-record-id']}: bad HTTP block")
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        if out["type"] == "response":
            if length != len(body):
                raise ValueError(f"{headers['warc-record-id']}: payload of {len(body)} bytes, {length} stated")
            if base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                raise ValueError(f"{headers['warc-record-id']}: payload digest differs")
        out |= {"payload": body, "payload_bytes": length, "payload_digest": digest}
    return out


def read_records(data) -> Iterator[dict]:
    """The records of one archive, one decoded frame at a time."""
    view = memoryview(data)
    dictionary, at = load_dictionary(view)
    unpack = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(view):
        end = frame_end(view, at)
        if int.from_bytes(view[at : at + 4], "little") == FRAME_MAGIC:
            yield parse_record(unpack.decompressobj().decompress(view[at:end]))
        at = end


def with_revisits(df: DataFrame, key: str, url: str, html: str, min_bytes: int = 0) -> DataFrame:
    """``_key, _url, _payload, _refers_to``: the key of the response that a revisit repeats, else null.

    The payload groups are counted by digest with partial aggregation; the
    join back to the rows is an inner join that Spark can split where one
    payload has a large share of all rows.
    """
    src = df.select(F.col(key).alias("_key"), F.col(url).alias("_url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("_payload"))
    src = src.withColumn("_digest", F.sha1("_payload")).withColumn("_bytes", F.octet_length("_payload"))
    best = src.groupBy("_digest", "_bytes").agg(F.max("_key").alias("_best"))
    both = src.join(best, ["_digest", "_bytes"])
    again = (F.col("_bytes") >= min_bytes) & F.col("_best").isNotNull() & ~F.col("_key").eqNullSafe(F.col("_best"))
    return both.select("_key", "_url", "_payload", F.when(again, F.col("_best")).alias("_refers_to"))


def write_archives(
    df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0,
    archive_bytes: int = 2 << 20, sample_rows: int = 128, sample_chars: int = 32_768, date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Archives of about ``archive_bytes`` uncompressed: ``(archive string, n_records int, data binary)``.

    The dictionary is trained on the driver from a bounded sample
    (``sample_rows`` rows, ``sample_chars`` characters of each); it affects
    sizes only, never content.
    """
    filled = df.select(F.col(key).cast("string").alias("k"), F.substring(F.col(html), 1, sample_chars).alias("t")).where("t != ''")
    sample = hash_sample(filled, df.count(), sample_rows, 4 * sample_rows * sample_chars, ["k", "t"], "t")
    dictionary = train_dictionary([r.t.encode("utf-8", "surrogatepass") for r in sample.collect()])
    rows = with_revisits(df, key, url, html, min_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstandard.ZstdCompressor(level=3, dict_data=d, write_checksum=True)
        lead = struct.pack("<II", DICT_FRAME_MAGIC, len(dictionary)) + dictionary if dictionary else b""
        parts: list[bytes] = []
        size = 0

        def close():
            data = lead + b"".join(parts)
            name = hashlib.sha1(data).hexdigest()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(parts)], pa.int32()), pa.array([data], pa.binary())], ["archive", "n_records", "data"])

        for b in batches:
            for i in range(b.num_rows):
                k, u, payload, ref = (b.column(j)[i].as_py() for j in range(4))
                raw = page_record(k, u, payload, ref, date)
                parts.append(pack.compress(raw))
                size += len(raw)
                if size >= archive_bytes:
                    yield close()
                    parts, size = [], 0
        if parts:
            yield close()

    return map_arrow(rows, run, "archive string, n_records int, data binary")


def read_archives(archives: DataFrame, data: str = "data") -> DataFrame:
    """Rows of the response and revisit records in archive rows:
    ``record_id, url, payload_bytes, payload_digest, record_type, refers_to, payload``."""
    names = ["record_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive in b.column(0):
                rows: list[tuple] = []
                for r in read_records(archive.as_buffer()):
                    if r["type"] in ("response", "revisit"):
                        h = r["headers"]
                        rows.append((_bare(h["warc-record-id"]), h.get("warc-target-uri"), r["payload_bytes"], r["payload_digest"], r["type"], _bare(h.get("warc-refers-to")), r["payload"] if r["type"] == "response" else None))
                cols = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    return map_arrow(archives.select(F.col(data)), run, "record_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Records of the ``.warc.zst`` files at ``path`` on any file system that Spark reads."""
    return read_archives(spark.read.format("binaryFile").load(path).select(F.col("content").alias("data")))


def round_trip(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, tag: str = "warc") -> DataFrame:
    """Write the archives to the shared folder, read them back: one row per input row."""
    kind = df.schema[key].dataType.simpleString()
    archives = written(write_archives(df, key, url, html, min_bytes), tag)
    return read_archives(archives).select(F.col("record_id").cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
