"""MinHash near-dedup by min-max hashing.

Every permutation is evaluated once and gives two signature values: its smallest and its largest hash over the shingles of a
text. Both ends of a permutation agree for two texts with the probability of their Jaccard similarity, so 64 evaluations give
128 values. They are banded; texts that share a band are candidates, and each link is confirmed on the full sets of shingles.

Texts with the same words are one class and are signed once. Classes that buckets hold together form groups. A group of up to
``BLOCK`` classes is compared in one task, to which each set of shingles goes once. In larger groups every class is first compared
with the smallest one of its bucket, and what these links do not join yet is compared in blocks. A task gives back a spanning
forest, never all pairs, so a bucket that holds a third of the rows is spread over many tasks and its output stays in
proportion to its rows. A set learns its group where it is made, or by one shuffle where there are more than ``SENT`` of them, so
that it is shuffled to its group alone. Stored steps go as soon as nothing reads them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlake.llm.common import U64, WordHashes, components, give_back, id_filter, list_array, may_hold, mix, shingle_set, signed, small_batches, words_of
from firmlake.session import drop_stored, write_and_read

PERMUTATIONS = 64
ROWS_PER_BAND = 5  # 25 bands of 5: a pair at similarity 0.8 shares none with probability 5e-5
BLOCK = 256
LANE = 65_536  # shingles multiplied at a time
SENT = 250_000  # a table of classes and their groups up to this size is sent to all tasks; a larger one is shuffled


def multipliers(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)


def min_max_signature(shingle_hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Smallest and largest value under each multiplication, 2 * len(factors) values."""
    low = np.full(len(factors), np.iinfo(U64).max, U64)
    high = np.zeros(len(factors), U64)
    step = max(1, LANE // len(factors))
    for at in range(0, len(shingle_hashes), step):
        values = factors[:, None] * shingle_hashes[None, at : at + step]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_hashes(signature: np.ndarray, rows: int) -> np.ndarray:
    bands = len(signature) // rows
    table = signature[: bands * rows].reshape(bands, rows)
    total = mix(np.arange(bands, dtype=U64))
    for at in range(rows):
        total = mix(total * U64(0x9E3779B97F4A7C15) + table[:, at])
    return total


def _sign(words: int, permutations: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, factors = WordHashes(), multipliers(permutations)
        for batch in batches:
            sizes, keys, bands = [], [], []
            for text in batch.column("text"):
                found = words_of(text.as_py())
                distinct = shingle_set(known.of(found), words)
                sizes.append(len(distinct))
                keys.append(hashlib.blake2b(b" ".join(found), digest_size=16).digest() if found else None)
                bands.append(signed(band_hashes(min_max_signature(distinct, factors), rows)) if found else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), list_array(bands)],
                names=["doc_id", "n_shingles", "key", "bands"],
            )

    return give_back(run)


def _sets(words: int, marks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            batch = batch.filter(pa.array(may_hold(marks.value, batch.column("doc_id").to_numpy(zero_copy_only=False))))
            parts = [signed(shingle_set(known.of(words_of(text.as_py())), words)) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), list_array(parts)], names=["id", "shingles"])

    return give_back(run)


def _shared_members(marks):
    """(bucket, id) of each class and bucket that may hold another class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("bands")
            buckets, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
            held = may_hold(marks.value, buckets)
            ids = np.repeat(batch.column("id").to_numpy(), sizes)[held]
            yield pa.RecordBatch.from_arrays([pa.array(buckets[held]), pa.array(ids)], names=["bucket", "id"])

    return give_back(run)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two ascending arrays of distinct values."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (small + large - shared)


def _block_links(percent: int):
    def run(keys, table):
        left, right = table.column("left").to_numpy(), table.column("right").to_numpy()
        ids, own = table.column("id").to_numpy(), table.column("component").to_numpy()
        sets = [np.asarray(x.values) for x in table.column("shingles")]
        block = table.column("block").to_numpy()
        same = left[0] == right[0]
        root: dict[int, int] = {int(c): int(c) for c in own}

        def top(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        firsts = range(len(ids)) if same else np.flatnonzero(block == left[0]).tolist()
        seconds = None if same else np.flatnonzero(block == right[0]).tolist()
        found = []
        for i in firsts:
            for j in range(i + 1, len(ids)) if same else seconds:
                a, b = top(int(own[i])), top(int(own[j]))
                if a != b and similar(sets[i], sets[j], percent):
                    root[max(a, b)] = min(a, b)
                    found.append((int(ids[i]), int(ids[j])))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    return run


def _group_links(percent: int):
    def run(key, table):
        table = table.sort_by("id")
        ids, sets = table.column("id").to_pylist(), [np.asarray(x.values) for x in table.column("shingles")]
        root = list(range(len(ids)))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        found = []
        for i in range(len(ids)):
            for j in range(i + 1, len(ids)):
                a, b = top(i), top(j)
                if a != b and similar(sets[i], sets[j], percent):
                    root[max(a, b)] = min(a, b)
                    found.append((ids[i], ids[j]))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    return run


def _large_links(candidates: DataFrame, sets: DataFrame, percent: int, block: int) -> tuple[DataFrame, ...]:
    """Links (a, b) within buckets of large groups, and what was stored for them.

    Every class is first compared with the smallest one of its bucket; what that does not join is compared in blocks.
    """
    pairs = candidates.where("id > lead").select("lead", "id").distinct()
    both = pairs.join(sets, "id").join(sets.select(F.col("id").alias("lead"), F.col("shingles").alias("of_lead")), "lead")
    common, sizes = F.size(F.array_intersect("shingles", "of_lead")), F.size("shingles") + F.size("of_lead")
    plausible = F.least(F.size("shingles"), F.size("of_lead")) * 100 >= F.greatest(F.size("shingles"), F.size("of_lead")) * percent
    linked = both.where(plausible).where(common * 100 >= (sizes - common) * percent)
    # the same text twice under one smallest doc_id needs no link; classes of one doc_id are joined by sharing the id
    direct = write_and_read(linked.select(F.col("lead").alias("a"), F.col("id").alias("b")), "links")
    joined = write_and_read(components(direct), "components")

    placed = candidates.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_buckets = write_and_read(
        placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n")).where("x < y").select("bucket", F.ceil(F.col("n") / block).alias("blocks")),
        "open-buckets",
    )
    units = (
        placed.drop("n").join(open_buckets, "bucket")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .select("bucket", "id", "component", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    )
    compared = units.join(sets, "id").groupBy("bucket", "left", "right").applyInArrow(_block_links(percent), "a long, b long")
    compared = write_and_read(compared, "links")
    return direct.union(compared), direct, joined, open_buckets, compared


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    permutations: int = PERMUTATIONS,
    rows: int = ROWS_PER_BAND,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text; other columns are ignored).

    Null and blank texts have no shingles and link with nothing. Rows that share a doc_id count as one document, each with its
    own n_shingles. Rows without doc_id link with nothing, their component_id is null and kept is false. Texts of any length
    are taken whole; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    source = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    signs = write_and_read(
        source.mapInArrow(_sign(words, permutations, rows), "doc_id long, n_shingles long, key binary, bands array<long>"), "signatures"
    )
    usable = signs.where("doc_id is not null and key is not null")
    classes = write_and_read(usable.groupBy("key").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")), "classes")
    members = classes.select("id", F.xxhash64("key").alias("mark"), F.explode("bands").alias("bucket"))
    shared = write_and_read(
        members.groupBy("bucket").agg(F.min("id").alias("lead"), F.max("id").alias("last"), F.count("*").alias("n"), F.bit_xor("mark").alias("mark")).where("lead < last"),
        "buckets",
    )
    # only members of these buckets are shuffled again, and few others
    marks = docs.sparkSession.sparkContext.broadcast(id_filter(shared.select("bucket")))
    # buckets of the same members are compared once
    shared = write_and_read(shared.groupBy("n", "mark", "lead", "last").agg(F.min("bucket").alias("bucket")), "buckets")
    members = classes.select("id", "bands").mapInArrow(_shared_members(marks), "bucket long, id long")
    candidates = write_and_read(members.join(shared, "bucket").select("bucket", "lead", "id", "n"), "candidates")

    # classes that buckets hold together, directly or by others: most of these groups are small, and each set goes to its group once
    together = write_and_read(components(candidates.where("id > lead").select(F.col("lead").alias("a"), F.col("id").alias("b"))), "together")
    large = together.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > block).select("component")
    large = write_and_read(large, "large-groups")
    placed = together.join(large.withColumn("is_large", F.lit(True)), "component", "left")
    placed = write_and_read(placed.select("id", "component", F.col("is_large").isNotNull().alias("is_large")), "placed")
    # no text is shuffled: a filter of bounded size leaves out most of those that are not wanted, the join all others
    marks = docs.sparkSession.sparkContext.broadcast(id_filter(placed.select("id")))
    sets = source.where("doc_id is not null").mapInArrow(_sets(words, marks), "id long, shingles array<long>")
    sets = write_and_read(sets.join(F.broadcast(placed) if placed.count() <= SENT else placed, "id"), "shingles")
    in_groups = sets.where("not is_large").select("id", "shingles", "component")
    links = write_and_read(in_groups.groupBy("component").applyInArrow(_group_links(percent), "a long, b long"), "links")
    stored = [together, large, placed, links]
    if not large.isEmpty():
        rest = write_and_read(candidates.join(placed.where("is_large").select("id"), "id", "left_semi"), "candidates")
        more = _large_links(rest, sets.where("is_large").select("id", "shingles"), percent, block)
        links, stored = links.union(more[0]), [*stored, rest, *more]
    final = write_and_read(components(links), "components")
    drop_stored(sets, shared, candidates, *stored)

    groups = classes.select("key", "id").join(final, "id", "left").select("key", F.coalesce("component", "id").alias("component_id"))
    groups = write_and_read(groups, "groups")
    drop_stored(final, classes)
    result = signs.select("doc_id", "n_shingles", "key").join(groups, "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    result = result.select("doc_id", "n_shingles", component.alias("component_id"))
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
