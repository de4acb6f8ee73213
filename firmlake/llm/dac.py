"""Token-ID output as directly addressable codes.

An id is cut into chunks of ``WIDTHS`` bits, lowest first. Level 0 holds the first chunk of every id, level 1 the second chunk of
those ids that need one, and so on. Each level carries a bitmap that says which of its ids continue, with the number of set bits
before every block of ``BLOCK`` ids (the rank directory). An id at position i is read from chunk i of level 0, then from chunk
rank(i) of level 1, ...: no block is decoded.

File: magic, number of documents, number of ids, number of levels; documents' ids and validity, documents' ends; per level its
width, count, packed chunks, bitmap and rank directory; CRC-32 of all that precedes.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmlake.llm import files, pieces
from firmlake.llm.common import give_back, small_batches
from firmlake.session import write_and_read

MAGIC = b"FLDAC\x00\x00\x01"
WIDTHS = (12, 4, 8, 8)  # 32 bits in all; ids below 4096 take one chunk
BLOCK = 512
IDS_PER_FILE = 2_000_000  # a file closes after the document that reaches it
TEXT_AT_ONCE = 8 << 20  # bytes of text tokenized together; a longer document goes alone
KNOWN_PIECES = 2_000_000  # about 60 MB a worker


def pack(values: np.ndarray, width: int) -> bytes:
    """Chunks of 4, 8 or 12 bits, without gaps."""
    if width == 8:
        return values.astype(np.uint8).tobytes()
    if width == 4:
        v = np.append(values, np.zeros(len(values) % 2, values.dtype)).astype(np.uint8).reshape(-1, 2)
        return (v[:, 0] | (v[:, 1] << 4)).tobytes()
    v = np.append(values, np.zeros(len(values) % 2, values.dtype)).astype(np.uint16).reshape(-1, 2)
    out = np.empty((len(v), 3), np.uint8)
    out[:, 0], out[:, 1], out[:, 2] = v[:, 0] & 255, (v[:, 0] >> 8) | ((v[:, 1] & 15) << 4), v[:, 1] >> 4
    return out.tobytes()


def unpack(data: np.ndarray, width: int, count: int) -> np.ndarray:
    if width == 8:
        return data[:count].astype(np.uint32)
    if width == 4:
        return np.stack([data & 15, data >> 4], 1).reshape(-1)[:count].astype(np.uint32)
    b = data.reshape(-1, 3).astype(np.uint32)
    return np.stack([b[:, 0] | ((b[:, 1] & 15) << 8), (b[:, 1] >> 4) | (b[:, 2] << 4)], 1).reshape(-1)[:count]


def packed_size(width: int, count: int) -> int:
    return count if width == 8 else (count + 1) // 2 * (1 if width == 4 else 3)


def encode(ids: np.ndarray, docs: list[int | None], ends: np.ndarray) -> bytes:
    """One file: all ids, the documents' own ids and where each document ends."""
    parts, rest = [], ids.astype(np.uint32)
    levels = 0
    for width in WIDTHS:
        more = rest >> np.uint32(width) > 0
        bits = np.packbits(more, bitorder="little")
        blocks = np.add.reduceat(more, np.arange(0, len(more), BLOCK)) if len(more) else np.empty(0)
        directory = np.concatenate([[0], np.cumsum(blocks)]).astype("<u8")
        parts += [struct.pack("<BQ", width, len(rest)), pack(rest & np.uint32((1 << width) - 1), width), bits.tobytes(), directory.tobytes()]
        levels += 1
        rest = rest[more] >> np.uint32(width)
        if not len(rest):
            break
    known = np.array([0 if d is None else d for d in docs], "<i8").tobytes() + np.array([d is not None for d in docs], np.uint8).tobytes()
    head = MAGIC + struct.pack("<QQB", len(docs), len(ids), levels) + known + ends.astype("<u8").tobytes()
    body = b"".join([head, *parts])
    return body + struct.pack("<I", zlib.crc32(body))


class Codes:
    """A file's content; raises ValueError where it is damaged."""

    def __init__(self, data: bytes):
        if len(data) < 29 or data[:8] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        if zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("checksum differs")
        n, self.count, levels = struct.unpack_from("<QQB", data, 8)
        at = 25
        ids, valid = np.frombuffer(data, "<i8", n, at), np.frombuffer(data, np.uint8, n, at + 8 * n)
        self.docs = [int(d) if ok else None for d, ok in zip(ids, valid, strict=True)]
        self.ends = np.frombuffer(data, "<u8", n, at + 9 * n)
        at += 17 * n
        self.levels = []
        for _ in range(levels):
            width, count = struct.unpack_from("<BQ", data, at)
            at += 9
            chunks = np.frombuffer(data, np.uint8, packed_size(width, count), at)
            at += len(chunks)
            bits = np.frombuffer(data, np.uint8, (count + 7) // 8, at)
            at += len(bits)
            directory = np.frombuffer(data, "<u8", -(-count // BLOCK) + 1, at)
            at += directory.nbytes
            self.levels.append((width, count, chunks, bits, directory))
        if at != len(data) - 4:
            raise ValueError("length differs")

    def __getitem__(self, i: int) -> int:
        """The id at position ``i`` of the file, by chunk and rank alone."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        value = shift = 0
        for width, _, chunks, bits, directory in self.levels:
            if width == 8:
                chunk = int(chunks[i])
            elif width == 4:
                chunk = int(chunks[i // 2]) >> (4 * (i % 2)) & 15
            else:
                a, b, c = (int(x) for x in chunks[i // 2 * 3 : i // 2 * 3 + 3])
                chunk = (b >> 4 | c << 4) if i % 2 else (a | (b & 15) << 8)
            value |= chunk << shift
            shift += width
            if not bits[i // 8] >> (i % 8) & 1:
                return value
            block = i // BLOCK
            inside = np.unpackbits(bits[block * BLOCK // 8 : i // 8 + 1], bitorder="little")[: i - block * BLOCK]
            i = int(directory[block]) + int(inside.sum())
        return value

    def all(self) -> np.ndarray:
        value = np.zeros(self.count, np.uint32)
        at, shift = np.arange(self.count), 0
        for width, count, chunks, bits, _ in self.levels:
            value[at] |= unpack(chunks, width, count) << np.uint32(shift)
            shift += width
            at = at[np.unpackbits(bits, count=count, bitorder="little").astype(bool)]
        return value


class Pieces:
    """Ids of texts by way of their pieces, each distinct one encoded once (see ``pieces``)."""

    def __init__(self, tokenizer_file: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.end_id = end_id
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.lengths = np.ones(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.lengths[number] = len(token)  # one character stands for one byte
        self.memory = pieces.Memory(KNOWN_PIECES)
        #: strings that the tokenizer cuts out of any text
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _distinct(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces; those that begin with a blank and may be followed by one are encoded together."""
        joined = pieces.ends_safely(found) & pc.starts_with(found, " ").to_numpy(zero_copy_only=False)
        for token in self.added:
            joined &= ~pc.match_substring(found, token).to_numpy(zero_copy_only=False)
        some = found.filter(pa.array(joined))
        sizes = np.diff(pieces.buffers_of(some)[0])
        ids = pieces.ids_of_joined(self._plain, some.to_pylist(), sizes, self.lengths)
        return pieces.merge_parts(joined, ids, pieces.flat_ids(self._plain(found.filter(pa.array(~joined)).to_pylist())))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids with the end id after each text, and the number of ids of each text."""
        if not len(texts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        found, per_text = pieces.cut(texts)
        coded = found.dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        ids, counts = self.memory.ids(coded.dictionary, self._distinct)
        starts, n = np.cumsum(counts) - counts, counts[codes]
        sizes = np.diff(np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(per_text)])]) + 1
        out = np.full(int(sizes.sum()), self.end_id, np.uint32)
        inside = np.ones(len(out), bool)
        inside[np.cumsum(sizes) - 1] = False
        out[inside] = ids[pieces.expand(starts[codes], n)]
        return out, sizes


def slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most ``most`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


_PIECES: dict[tuple[str, int], Pieces] = {}  # kept by a worker from task to task


def _write(folder: str, tokenizer_file: str, end_id: int, ids_per_file: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _PIECES.setdefault((tokenizer_file, end_id), None) or Pieces(tokenizer_file, end_id)
        _PIECES[tokenizer_file, end_id] = encoder
        part, made = TaskContext.get().partitionId(), 0
        ids, docs, lengths, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            out = files.Written(folder, f"{part:06d}-{made:06d}.dac")
            out.write(encode(np.concatenate(ids), docs, np.cumsum(np.concatenate(lengths))))
            uri = out.close()
            return pa.RecordBatch.from_pydict({"file": [uri], "part": pa.array([part], pa.int32()), "number": pa.array([made], pa.int32()), "ids": pa.array([held], pa.int64())})

        def gathered() -> Iterator[tuple[pa.Array, list]]:
            """Rows of several batches together: the more text, the fewer distinct pieces of it."""
            some, size = [], 0
            for batch in batches:
                some.append(batch)
                size += batch.column("text").nbytes
                if size >= TEXT_AT_ONCE:
                    yield rows(some)
                    some, size = [], 0
            if some:
                yield rows(some)

        def rows(some: list[pa.RecordBatch]) -> tuple[pa.Array, list]:
            table = pa.Table.from_batches(some)
            return pc.fill_null(table.column("text"), "").combine_chunks(), table.column("doc_id").to_pylist()

        for texts, numbers in gathered():
            for a, b in slices(texts, TEXT_AT_ONCE):
                some, sizes = encoder.encode(texts.slice(a, b - a))
                ids.append(some)
                lengths.append(sizes)
                docs += numbers[a:b]
                held += len(some)
                if held >= ids_per_file:
                    yield close()
                    ids, docs, lengths, held, made = [], [], [], 0, made + 1
        if docs:
            yield close()

    return give_back(run)


def write_tokens(docs: DataFrame, tokenizer_file: str, end_id: int = 0, ids_per_file: int = IDS_PER_FILE) -> DataFrame:
    """Writes ``docs`` (doc_id, text) in ascending doc_id order and returns one row per file: file, part, number, ids.

    The documents are range partitioned by doc_id and sorted in place. Equal doc_ids stand in order of their texts; rows without
    doc_id come first. A null or empty text is just the end id. Other columns are ignored; an empty table writes no file.
    """
    small_batches(docs.sparkSession)
    folder = files.shared_folder(docs.sparkSession, "tokens")
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("text")]
    ranged = docs.select("doc_id", "text").repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    written = ranged.mapInArrow(_write(folder, tokenizer_file, end_id, ids_per_file), "file string, part int, number int, ids long")
    return write_and_read(written, "token-files")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            codes = Codes(files.read_bytes(row["file"]))
            all_ids, ends = codes.all().astype("<u4"), codes.ends.astype(np.int64)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            sums = [zlib.crc32(all_ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(codes.docs, pa.int64()), "start": pa.array(starts + row["before"], pa.int64()), "n_tokens": pa.array(ends - starts, pa.int64()),
                    "ids_crc32": pa.array(sums, pa.int64()), "file": [row["file"]] * len(ends), "place": pa.array(starts, pa.int64()),
                }
            )


def read_tokens(listed: DataFrame) -> DataFrame:
    """One row per document of the files that ``write_tokens`` has listed: doc_id, start, n_tokens, ids_crc32, file, place.

    start counts the ids of all documents before it, place those before it in its own file. A damaged file raises.
    """
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = listed.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    return files.one_task_each(placed, "file").mapInArrow(
        give_back(_read), "doc_id long, start long, n_tokens long, ids_crc32 long, file string, place long"
    )
