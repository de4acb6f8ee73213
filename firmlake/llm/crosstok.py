"""Alignment of two tokenizers' tokens, by lockstep merging of their byte ranges.

Texts are encoded by both tokenizers. All documents of a batch are merged together: one state vector holds each document's place in A
and in B, and a step links the two tokens that stand there, moves on whichever ends first (both where they end together, which is a
cut), and drops the documents that are through. Every step is a few NumPy operations over all documents that are left.

What is linked is kept per slice of about ``TEXT_AT_ONCE`` bytes in a file of the shared folder. Spark adds up the distinct id
pairs of the slices, and hands each slice the corpus-wide counts of its own pairs; no document's links are shuffled.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlake.llm import files, pieces
from firmlake.llm.common import give_back, small_batches
from firmlake.session import write_and_read

TEXT_AT_ONCE = 4 << 20  # bytes of text of one slice; a longer document is a slice of its own
KNOWN_PIECES = 1_000_000  # about 30 MB a worker and tokenizer
SPACE = "▁"


def bytes_of_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible ones for themselves, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Side:
    """One tokenizer: bytes of its ids, and ids of pieces that begin with a blank."""

    def __init__(self, entries: list[bytes]):
        self.bytes = pa.array(entries, pa.large_binary())
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.memory = pieces.Memory(KNOWN_PIECES)

    def _single(self, listed: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def encode(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in order, and how many each has."""
        raise NotImplementedError

    def whole(self, text: str) -> list[int]:
        return self._single([" " + text])[0]


class ByteLevel(Side):
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are plain text
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        value = bytes_of_characters()
        entries = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            entries[number] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
        super().__init__(entries)

    def _single(self, listed: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(listed, add_special_tokens=False)]

    def encode(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        safe = pieces.ends_safely(found)
        listed, sizes = found.to_pylist(), np.diff(pieces.buffers_of(found)[0])
        ids, counts = pieces.ids_of_joined(self._single, [p for p, s in zip(listed, safe.tolist(), strict=True) if s], sizes[safe], self.lengths)
        alone = pieces.flat_ids(self._single([p for p, s in zip(listed, safe.tolist(), strict=True) if not s]))
        return pieces.merge_parts(safe, (ids, counts), alone)


class Pieces(Side):
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        #: pieces with a blank inside would cross a cut
        self.crossing = any(SPACE in n.lstrip(SPACE) for n in names)
        entries = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        super().__init__(entries)

    def _single(self, listed: list[str]) -> list[list[int]]:
        return self.model.encode([p[1:] for p in listed], num_threads=1)  # it adds the first blank

    def encode(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return pieces.flat_ids(self._single(found.to_pylist()))


def equal_bytes(side: Side, ids: np.ndarray, counts: np.ndarray, found: pa.Array) -> np.ndarray:
    """Whether the joined bytes of each piece's ids are the piece."""
    joined = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]), side.bytes.take(pa.array(ids)))
    return pc.equal(pc.binary_join(joined, pa.scalar(b"", pa.large_binary())), found.cast(pa.large_binary())).to_numpy(zero_copy_only=False)


class Tokens:
    """Tokens of one tokenizer for all documents of a batch, in order."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, lengths: np.ndarray):
        self.ids, self.counts = ids, counts
        self.ends = np.cumsum(lengths[ids])  # over the batch: documents have the same bytes on both sides
        self.first = np.cumsum(counts) - counts


def _spread(distinct: pa.Array, codes: np.ndarray, per_text: np.ndarray, side: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts, the number of each text's, and whether each text's bytes are met."""
    ids, counts = side.memory.ids(distinct, side.encode)
    good = equal_bytes(side, ids, counts, distinct)
    starts, n = np.cumsum(counts) - counts, counts[codes]
    edges = np.concatenate([[0], np.cumsum(per_text)])
    per = np.diff(np.concatenate([[0], np.cumsum(n)])[edges])
    fine = np.add.reduceat(~good[codes], edges[:-1]) == 0 if len(per_text) else np.empty(0, bool)
    return ids[pieces.expand(starts[codes], n)], per, fine


def encode_both(texts: pa.Array, a: Side, b: Side) -> tuple[Tokens, Tokens, np.ndarray]:
    """Tokens of a blank and each text by both tokenizers; none for empty texts and where bytes are not met. Places of the others."""
    some = np.flatnonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0)
    spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts.take(pa.array(some)).cast(pa.large_string()), pa.scalar(" ", pa.large_string()))
    found, per_text = pieces.cut(spaced)
    coded = found.dictionary_encode()
    codes, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    sides = []
    for side in (a, b):
        ids, per, fine = _spread(distinct, codes, per_text, side)
        if not fine.all() or getattr(side, "crossing", False):
            ids, per, fine = _again(spaced, ids, per, fine, side)
        sides.append((ids, per, fine, side.lengths))
    met = sides[0][2] & sides[1][2]
    tokens = [Tokens(ids[np.repeat(met, per)], per[met], lengths) for ids, per, _, lengths in sides]
    return tokens[0], tokens[1], some[met]


def _again(spaced: pa.Array, ids: np.ndarray, per: np.ndarray, fine: np.ndarray, side: Side):
    """Texts whose pieces are not met, encoded as they are."""
    redo = np.flatnonzero(~fine) if not getattr(side, "crossing", False) else np.arange(len(per))
    edges = np.cumsum(per) - per
    parts = [ids[s : s + n] for s, n in zip(edges, per, strict=True)]
    fine = fine.copy()
    for i in redo.tolist():
        text = spaced[i].as_py()
        parts[i] = np.array(side.whole(text[1:]), np.uint32)
        fine[i] = b"".join(side.bytes.take(pa.array(parts[i])).to_pylist()) == text.encode()
    return np.concatenate(parts), np.array([len(p) for p in parts], np.int64), fine


def lockstep(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links as places in A and in B, step by step, and whether each token of A and of B ends at a cut."""
    at_a, at_b = a.first.copy(), b.first.copy()
    end = a.first + a.counts
    cut_a, cut_b = np.zeros(len(a.ids), bool), np.zeros(len(b.ids), bool)
    links_a, links_b = [], []
    while len(at_a):
        links_a.append(at_a.astype(np.int32))
        links_b.append(at_b.astype(np.int32))
        end_a, end_b = a.ends[at_a], b.ends[at_b]
        both = end_a == end_b
        cut_a[at_a[both]] = True
        cut_b[at_b[both]] = True
        at_a = at_a + (end_a <= end_b)
        at_b = at_b + (end_b <= end_a)
        left = at_a < end
        if not left.all():  # finished documents go
            at_a, at_b, end = at_a[left], at_b[left], end[left]
    none = np.empty(0, np.int32)
    return np.concatenate(links_a or [none]), np.concatenate(links_b or [none]), cut_a, cut_b


class Texts:
    """Decimal ids with the sign that follows them: A ``,`` or ``|``, B ``,`` or ``;``."""

    def __init__(self, n_a: int, n_b: int):
        self.n_a = n_a
        rows = [f"{i}{sign}" for i in range(n_a) for sign in ",|"] + [f"{i}{sign}" for i in range(n_b) for sign in ",;"]
        self.table = pa.array(rows, pa.large_string())

    def digests(self, a: Tokens, b: Tokens, cut_a: np.ndarray, cut_b: np.ndarray) -> list[str]:
        """SHA-256 of each document's groups."""
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        last_a, last_b = np.flatnonzero(cut_a), np.flatnonzero(cut_b)
        first_b = np.concatenate([[0], last_b + 1])
        merged = np.empty(len(a.ids) + len(b.ids), np.int64)
        merged[np.arange(len(a.ids)) + first_b[group_a]] = a.ids.astype(np.int64) * 2 + cut_a
        merged[np.arange(len(b.ids)) + last_a[group_b] + 1] = 2 * self.n_a + b.ids.astype(np.int64) * 2 + cut_b
        shown = self.table.take(pa.array(merged))
        offsets, data = pieces.buffers_of(shown)
        edges = offsets[np.concatenate([[0], np.cumsum(a.counts + b.counts)])]
        held = memoryview(data)
        return [hashlib.sha256(held[s : max(s, e - 1)]).hexdigest() for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


_SIDES: dict[tuple[str, str], tuple[ByteLevel, Pieces, Texts]] = {}  # kept by a worker from task to task


def _sides(file_a: str, file_b: str) -> tuple[ByteLevel, Pieces, Texts]:
    if (file_a, file_b) not in _SIDES:
        a, b = ByteLevel(file_a), Pieces(file_b)
        _SIDES[file_a, file_b] = a, b, Texts(len(a.lengths), len(b.lengths))
    return _SIDES[file_a, file_b]


def align(doc_ids: pa.Array, texts: pa.Array, a: Side, b: Side, shown: Texts) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """One row per document with its distinct pairs (A id * ids of B + B id) and how often each is linked; all pairs and their counts."""
    tokens_a, tokens_b, met = encode_both(texts, a, b)
    links_a, links_b, cut_a, cut_b = lockstep(tokens_a, tokens_b)
    n, width = len(texts), len(b.lengths)
    doc_of = np.repeat(np.arange(len(met)), tokens_a.counts)
    pair = tokens_a.ids[links_a].astype(np.int64) * width + tokens_b.ids[links_b]
    doc = doc_of[links_a]
    n_links = np.bincount(doc, minlength=len(met))
    known, place, totals = np.unique(pair, return_inverse=True, return_counts=True)
    keyed, times = np.unique(doc * max(1, len(known)) + place, return_counts=True)
    per_doc = np.bincount(keyed // max(1, len(known)), minlength=len(met))

    def full(values: np.ndarray) -> np.ndarray:
        out = np.zeros(n, np.int64)
        out[met] = values
        return out

    digests = np.full(n, "", object)
    digests[met] = shown.digests(tokens_a, tokens_b, cut_a, cut_b)
    cuts = np.add.reduceat(cut_a, tokens_a.first) if len(met) else np.empty(0, np.int64)
    edges = np.concatenate([[0], np.cumsum(full(per_doc))]).astype(np.int32)
    table = pa.table(
        {
            "doc_id": doc_ids.cast(pa.int64()), "n_a": full(tokens_a.counts), "n_b": full(tokens_b.counts), "n_groups": full(cuts), "n_links": full(n_links),
            "groups_sha256": pa.array(digests, pa.string()),
            "pairs": pa.ListArray.from_arrays(edges, pa.array((keyed % max(1, len(known))).astype(np.int32))),
            "times": pa.ListArray.from_arrays(edges, pa.array(times.astype(np.int32))),
        }
    )
    return table, known, totals


def _slice_files(folder: str, file_a: str, file_b: str, at_once: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, shown = _sides(file_a, file_b)
        part, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            table, known, totals = align(rows.column("doc_id").combine_chunks(), pc.fill_null(rows.column("text"), "").combine_chunks(), a, b, shown)
            out = files.Written(folder, f"{part:06d}-{made:06d}.arrow")
            sink = pa.BufferOutputStream()
            with pa.ipc.new_file(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(table)
            out.write(sink.getvalue())
            uri = out.close()
            pair = pa.concat_arrays([pa.array(known, pa.int64()), pa.array([None], pa.int64())])  # the last row says that there is the file
            return pa.RecordBatch.from_pydict({"file": pa.array([uri]).dictionary_encode().dictionary.take(pa.array(np.zeros(len(pair), np.int32))), "pair": pair, "n": pa.array(np.append(totals, 0), pa.int64())})

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            start = 0
            for i, own in enumerate(sizes.tolist()):
                if size and size + own > at_once:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    yield close()
                    start, held, size, made = i, [], 0, made + 1
                size += own
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield close()

    return give_back(run)


def _totals(key, table):
    """Documents of one slice with the corpus-wide counts of its pairs, which come in order of the pairs' places."""
    rows = pa.ipc.open_file(pa.BufferReader(files.read_bytes(key[0].as_py()))).read_all()
    known = table.filter(pc.is_valid(table.column("pair"))).sort_by("pair")
    count, best = (known.column(c).to_numpy() for c in ("count", "best"))
    place, times = (rows.column(c).combine_chunks() for c in ("pairs", "times"))
    at, n = place.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    edges = place.offsets.to_numpy().astype(np.int64)
    summed = lambda values: np.diff(np.concatenate([[0], np.cumsum(values)])[edges])
    kept = rows.drop_columns(["pairs", "times"])
    return kept.append_column("n_best", pa.array(summed(n * best[at]), pa.int64())).append_column("count_sum", pa.array(summed(n * count[at]), pa.int64()))


def aligned_documents(docs: DataFrame, file_a: str, file_b: str, at_once: int = TEXT_AT_ONCE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) for each row of ``docs`` (doc_id, text).

    A is the byte-level tokenizer of ``file_a``, B the piece model of ``file_b``, both on a blank and the text. n_groups counts the
    stretches between places where tokens of both end, n_links pairs of tokens whose bytes overlap. A pair of ids counts as often as it is
    linked in all documents: count_sum adds that up over a document's links, n_best are the links whose count is the highest of
    their B id. Null and empty texts and those whose bytes either tokenizer changes have zeros and an empty groups_sha256, and
    add nothing to the counts. Repeated rows and rows without doc_id are documents like others. Other columns are ignored; an
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = files.shared_folder(spark, "aligned")
    cut = docs.select("doc_id", "text").mapInArrow(_slice_files(folder, file_a, file_b, at_once), "file string, pair long, n long")
    slices = write_and_read(cut, "slice-pairs")
    width = len_b(file_b)
    counts = write_and_read(slices.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    highest = counts.groupBy(F.pmod("pair", F.lit(width)).alias("b")).agg(F.max("count").alias("highest"))
    marked = counts.withColumn("b", F.pmod("pair", F.lit(width))).join(highest, "b")
    marked = marked.select("pair", "count", (F.col("count") == F.col("highest")).cast("long").alias("best"))
    known = slices.select("file", "pair").join(marked, "pair", "left")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return known.groupBy("file").applyInArrow(_totals, schema)


def len_b(file_b: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=file_b).get_piece_size()
