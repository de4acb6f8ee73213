"""WARC archives with one Zstandard frame per record and a dictionary in the leading skippable frame.

A file begins with a skippable frame (magic 0x184D2A5D) that holds the dictionary, plain or itself compressed; after it every
record is a frame of its own. The reader loads the dictionary, decodes frame by frame and checks version, headers, lengths and
digests; a damaged file raises. Repeats of a payload are stored as revisits of the page with the smallest id.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlake.llm import files
from firmlake.llm.common import draw, give_back, small_batches
from firmlake.session import write_and_read

SKIPPABLE = 0x184D2A5D
PLAIN_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DICTIONARY_BYTES, SAMPLE_PAGES, SAMPLE_BYTES = 64 << 10, 400, 16 << 10  # the dictionary is fitted on pages up to that length
LEAST_PAYLOAD = 100
FILE_BYTES = 16 << 20  # a file closes after the record that reaches it
CHUNK = 16 << 10


def train_dictionary(pages: DataFrame, payload: str = "payload") -> bytes:
    """Dictionary from at most ``SAMPLE_PAGES`` payloads of at most ``SAMPLE_BYTES``, drawn by their hash; empty where they do not suffice."""
    some = draw(pages.select(payload).where(F.octet_length(payload).between(1, SAMPLE_BYTES)), SAMPLE_PAGES, payload)
    samples = [bytes(r[0]) for r in some.collect()]
    if len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(512, sum(map(len, samples)) // 10)), samples).as_bytes()
    except zstandard.ZstdError:  # too little to learn from
        return b""


def _header_value(text: str) -> str:
    """Blanks and control characters, which would end a header line, as %XX."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    block = b"" if revisit else payload
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>",
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else _header_value(url),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "WARC-Profile": PROFILE if revisit else None,
        "X-Page-ID": None if page_id is None else str(page_id),
        "X-Refers-To-Page-ID": str(refers_to) if revisit else None,
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "text/html; charset=utf-8",
        "Content-Length": str(len(block)),
    }
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record; ValueError where it breaks the format."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] != VERSION:
        raise ValueError("no WARC record")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ValueError("broken header line")
        headers[name.strip().lower().decode("ascii")] = value.strip().decode()
    if not {"warc-type", "warc-record-id", "warc-date", "content-length"} <= headers.keys():
        raise ValueError("required header missing")
    if not headers["content-length"].isdigit() or len(rest) != int(headers["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError("length differs")
    block = rest[:-4]
    stated = headers.get("warc-block-digest")
    if stated and stated != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError("block digest differs")
    if headers["warc-type"] == "response":
        if headers.get("warc-payload-digest", stated) != stated or headers.get("x-payload-length", headers["content-length"]) != headers["content-length"]:
            raise ValueError("payload differs")
    elif headers["warc-type"] == "revisit" and (block or headers.get("warc-profile") != PROFILE):
        raise ValueError("broken revisit")
    return headers, block


def dictionary_frame(dictionary: bytes) -> bytes:
    """The leading skippable frame; the dictionary inside is compressed."""
    packed = zstandard.ZstdCompressor(level=9).compress(dictionary)
    return struct.pack("<II", SKIPPABLE, len(packed)) + packed


def _exactly(stream, size: int) -> bytes:
    data = stream.read(size)
    if len(data) != size:
        raise ValueError("file ends inside a frame")
    return data


def frames(stream) -> Iterator[bytes]:
    """Content of each frame of an archive, one record at a time."""
    rest, dictionary = stream.read(4), None
    if len(rest) == 4 and struct.unpack("<I", rest)[0] == SKIPPABLE:
        (size,) = struct.unpack("<I", _exactly(stream, 4))
        held = _exactly(stream, size)
        if held[:4] == PLAIN_MAGIC:
            held = zstandard.ZstdDecompressor().decompress(held)
        dictionary, rest = zstandard.ZstdCompressionDict(held), b""
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while rest := rest or stream.read(CHUNK):
        while len(rest) < 18 and (more := stream.read(CHUNK)):  # a frame's header
            rest += more
        stated = zstandard.frame_content_size(rest)
        frame, parts = decoder.decompressobj(), []
        while True:
            parts.append(frame.decompress(rest))
            if frame.eof:
                rest = frame.unused_data
                break
            if not (rest := stream.read(CHUNK)):
                raise ValueError("file ends inside a frame")
        content = b"".join(parts)
        if stated not in (-1, len(content)):
            raise ValueError("frame length differs")
        yield content


def _write(folder: str, dictionary: bytes, date: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=known, write_checksum=True)
        part, made, out, n = TaskContext.get().partitionId(), 0, None, 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"file": [out.close()], "records": pa.array([n], pa.int64())})

        for batch in batches:
            for i in range(batch.num_rows):
                x = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if out is None:
                    out, n = files.Written(folder, f"{part:06d}-{made:06d}.warc.zst"), 0
                    if dictionary:
                        out.write(dictionary_frame(dictionary))
                out.write(packer.compress(record(x["page_id"], x["url"], x["payload"], x["digest"], x["refers_to"], x["revisit"], date)))
                n += 1
                if out.size >= file_bytes:
                    yield close()
                    out, made = None, made + 1
        if out is not None:
            yield close()

    return give_back(run)


def write_archives(pages: DataFrame, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as archives in the shared folder and returns one row per file: file, records.

    A null html is an empty payload; a null url or page_id leaves its header out. Of payloads of at least ``LEAST_PAYLOAD`` bytes
    that are equal, the rows with the smallest page_id are responses and all others revisit it; where none has an id, all are
    responses. Other columns are ignored; an empty table writes no file.
    """
    small_batches(pages.sparkSession)
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= LEAST_PAYLOAD)
    # stored, so that the join below can split the rows of a payload with very many copies
    repeated = write_and_read(large.groupBy("digest").agg(F.min("page_id").alias("lead"), F.count("*").alias("n")).where("n > 1 and lead is not null").drop("n"), "repeats")
    joined = rows.join(repeated, "digest", "left")
    revisit = F.col("lead").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("lead"))
    placed = joined.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("lead")).alias("refers_to"), revisit.alias("revisit"))
    folder = files.shared_folder(pages.sparkSession, "warc")
    dictionary = train_dictionary(rows)
    return write_and_read(placed.mapInArrow(_write(folder, dictionary, date, file_bytes), "file string, records long"), "archives")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def whole(value: str | None) -> int | None:
        return None if value is None else int(value)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), kinds, strict=True)], names=[n for n, _ in kinds])

    for batch in batches:
        for uri in batch.column("file").to_pylist():
            system, path = files.place(uri)
            rows, held = [], 0
            with system.open_input_stream(path, compression=None, buffer_size=1 << 20) as stream:
                for content in frames(stream):
                    h, block = parse(content)
                    rows.append((whole(h.get("x-page-id")), h.get("warc-target-uri"), h["warc-type"], whole(h.get("x-payload-length", h["content-length"])), (h.get("warc-payload-digest") or "").removeprefix("sha256:"), whole(h.get("x-refers-to-page-id")), block))
                    held += len(content)
                    if held > 4 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
            if rows:
                yield batch_of(rows)


def read_archives(listed: DataFrame) -> DataFrame:
    """One row per record: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload (empty for revisits)."""
    dealt = files.one_task_each(listed.select("file"), "file")
    return dealt.mapInArrow(give_back(_read), "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Archives in a folder, by name."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select(F.col("path").alias("file"))
