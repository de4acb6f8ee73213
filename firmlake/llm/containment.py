"""Benchmark decontamination: size-partitioned MinHash containment search.

The smallest hash of an item under a random permutation belongs to one of its shingles, each equally likely; a document holds
that shingle with the probability of its containment, whatever the document's own length. An item is therefore kept as the
shingles that hold its minima under ``MINIMA`` permutations, and the items are partitioned by size in powers of two: a document
looks up the minima of those partitions only whose items it is long enough to contain. Items with enough minima in the document
are candidates, and each is confirmed on the full sets of shingles. An item of fewer words than a shingle is looked up among the
document's runs of as many words, one pass for each such number of words in the block.

A signature of the document itself, as used to index short sets, cannot work here: an item of 30 shingles inside a document of
20,000 has a Jaccard similarity of 0.0015, and no feasible number of bands would find it.

Items are the query set. They go to the documents in blocks of a proven size, one pass for each block; no document is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlake.llm.common import U64, WordHashes, mix, shingle_set, shingles, small_batches, words_of

MINIMA = 16
MISS = 1e-6  # chance to overlook an item that is contained just enough
ITEM_BYTES = 8 << 20  # text of the items in one block
FILTER_BITS = 20
FOUND = "array<struct<item_id:bigint,n_item_shingles:bigint,n_shared:bigint>>"


def needed_hits(minima: int, percent: int, miss: float) -> int:
    """Most hits that may be asked for while an item at ``percent`` containment is missed with probability ``miss`` at most."""
    p, below = percent / 100, 0.0
    for hits in range(minima):
        below += comb(minima, hits) * p**hits * (1 - p) ** (minima - hits)
        if below > miss:
            return max(1, hits)
    return minima


class ItemIndex:
    """Minima of the items of one block, by size partition."""

    def __init__(self, items: list[tuple[int | None, bytes]], words: int, percent: int, minima: int = MINIMA, miss: float = MISS):
        known = WordHashes()
        self.words, self.percent = words, percent
        self.ids, self.sets = [], []
        short: dict[int, dict[int, list[int | None]]] = {}
        for number, text in items:
            own = known.of(words_of(text))
            if 0 < len(own) < words:
                short.setdefault(len(own), {}).setdefault(int(shingles(own, words)[0]), []).append(number)
            elif len(found := shingle_set(own, words)):
                self.ids.append(number)
                self.sets.append(found)
        self.need = needed_hits(minima, percent, miss)
        factors = mix(np.arange(7, 7 + minima, dtype=U64)) | U64(1)
        minimum = [np.array([s[np.argmin(f * s)] for f in factors], U64) for s in self.sets]
        item = np.repeat(np.arange(len(self.sets)), minima)
        flat = np.concatenate(minimum) if minimum else np.empty(0, U64)
        #: least number of shingles that a document must have to contain an item of the partition
        partition = np.array([len(s).bit_length() for s in self.sets], np.int64)[item] if len(flat) else item
        self.partitions = []
        for size in np.unique(partition):
            own = np.flatnonzero(partition == size)
            order = own[np.argsort(flat[own], kind="stable")]
            least = ceil(int(1 << (size - 1)) * percent / 100)
            bits = np.zeros(1 << FILTER_BITS, bool)
            bits[flat[order] >> U64(64 - FILTER_BITS)] = True
            self.partitions.append((least, flat[order], item[order], bits))
        #: number of words, hashes in order and the items of each
        self.short = [(size, np.sort(np.fromiter(by, U64, len(by))), by) for size, by in sorted(short.items())]

    def find(self, text: np.ndarray) -> list[tuple[int | None, int, int]]:
        """(item, its shingles, shared shingles) of the items that a text with these hashes of words contains."""
        out = []
        for size, values, by in self.short:
            if len(text) >= size:
                for value in np.intersect1d(values, shingles(text, size)).tolist():
                    out += [(number, 1, 1) for number in by[value]]
        hashes = shingles(text, self.words)
        hits: dict[int, int] = {}
        for least, values, items, bits in self.partitions:
            if len(hashes) < least:
                continue
            likely = np.unique(hashes[bits[hashes >> U64(64 - FILTER_BITS)]])
            for a, b in zip(np.searchsorted(values, likely, "left"), np.searchsorted(values, likely, "right"), strict=True):
                for i in items[a:b].tolist():  # an item's shingle may be its minimum more than once, and counts as often
                    hits[i] = hits.get(i, 0) + 1
        own = None
        for i in sorted(i for i, n in hits.items() if n >= self.need):
            own = np.unique(hashes) if own is None else own
            shared = len(np.intersect1d(self.sets[i], own, assume_unique=True))
            if 100 * shared >= self.percent * len(self.sets[i]):
                out.append((self.ids[i], len(self.sets[i]), shared))
        return out



def _finder(spark: SparkSession, items: list[tuple[int | None, bytes]], words: int, percent: int):
    block = spark.sparkContext.broadcast(items)  # on the driver's disk from here on, not in its memory

    @F.arrow_udf(FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index, known = ItemIndex(block.value, words, percent), WordHashes()  # once for all batches of a task
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("n_item_shingles", pa.int64()), ("n_shared", pa.int64())]))
        for texts in batches:
            rows = [
                [{"item_id": i, "n_item_shingles": n, "n_shared": k} for i, n, k in index.find(known.of(words_of(text.as_py())))]
                for text in texts
            ]
            yield pa.array(rows, kind)

    return found


def items_in(items: DataFrame, words: int = 5, percent: int = 80, block_bytes: int = ITEM_BYTES) -> list:
    """Functions of a binary text, one for each block of ``items`` (item_id, text) of at most ``block_bytes`` of text or a single item.

    The driver holds one block at a time: it packs it and hands it over as a broadcast, from which each task builds its index
    once. Null and blank items are left out.
    """
    spark = items.sparkSession
    small_batches(spark)
    blocks, block, held = [], [], 0
    rows = items.where("text is not null").select("item_id", F.col("text").cast("binary").alias("text")).orderBy("item_id", "text")
    for row in rows.toLocalIterator():
        if block and held + len(row.text) > block_bytes:
            blocks.append(_finder(spark, block, words, percent))
            block, held = [], 0
        block.append((row.item_id, bytes(row.text)))
        held += len(row.text)
    return [*blocks, _finder(spark, block, words, percent)]


def contained_items(docs: DataFrame, items: DataFrame, words: int = 5, percent: int = 80, block_bytes: int = ITEM_BYTES) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared, containment): each document with each item that it contains.

    An item is contained when ``percent`` of its distinct shingles of ``words`` words are in the document; an item with fewer words
    is one shingle, contained where a text has its words in a row. Null and blank texts contain nothing and are contained nowhere;
    ids may be null; repeated rows of either table are reported each. Other columns are ignored.
    """
    text = F.col("text").cast("binary")
    parts = [docs.select("doc_id", F.explode(find(text)).alias("found")) for find in items_in(items, words, percent, block_bytes)]
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    return every.select("doc_id", "found.*", (F.col("found.n_shared") / F.col("found.n_item_shingles")).alias("containment"))


def contains_any(items: DataFrame, text: Column, words: int = 5, percent: int = 80, block_bytes: int = ITEM_BYTES) -> Column:
    """True where a text contains an item; false for null texts."""
    any_of = F.lit(False)
    for find in items_in(items, words, percent, block_bytes):
        any_of = any_of | (F.size(find(text.cast("binary"))) > 0)
    return any_of
