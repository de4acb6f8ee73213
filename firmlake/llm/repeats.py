"""Repeated passages by common-prefix intervals of a sparse enhanced suffix array.

A window of ``length`` bytes is filed under its minimizer, the ``GRAM`` bytes with the smallest hash in it (the first of equals).
Equal windows have the same minimizer at the same place, so a text is cut into runs of windows that share one, the anchor. Only
anchors whose bytes stand in the corpus more than once go on. Runs with equal surroundings are one class: a class with several
members is repeated as a whole. What remains are the ends of repeats, where surroundings differ.

The classes of an anchor are suffixes of one bucket: sorted by the bytes from the anchor on they form a sparse suffix array. A stack
scan over its common prefixes yields the tree of intervals; in each interval the same scan over the reversed bytes before the
anchor yields the left extensions. An interval whose members differ on both sides is a maximal repeat with all its occurrences.

A bucket with very many different surroundings is not gathered: hashes of groups of its windows are counted by Spark, and only
groups that some classes share in part are split further.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlake.llm.common import GOLDEN, MIX_1, U64, give_back, mix, small_batches
from firmlake.session import write_and_read

LENGTH = 400
GRAM = 48
PIECE = 1 << 20  # windows handled at a time in a long text
PLACES = U64((1 << 21) - 1)
GATHERED = 512  # classes of a bucket that one task compares; larger buckets are counted by groups of windows
STEPS = (36, 6, 1)  # windows of a group, each a multiple of the next


class Powers:
    """Powers of an odd factor and of its inverse modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            inverse = U64(pow(int(MIX_1), -1, 1 << 64))
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, U64), np.full(size - 1, f, U64)])) for f in (MIX_1, inverse))
        return self.up[:n], self.down[:n]


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(values)
    blocks = -(-n // width)
    table = np.full(blocks * width, np.iinfo(U64).max, U64)
    table[:n] = values
    table = table.reshape(blocks, width)
    before = np.minimum.accumulate(table, axis=1).ravel()
    after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def runs(data: bytes, powers: Powers, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, first window start, last window start, hash of the anchor) in order of place."""
    for base in range(0, len(data) - length + 1, PIECE):
        piece = np.frombuffer(data, np.uint8, min(PIECE + length - 1, len(data) - base), base)
        up, down = powers.upto(len(piece))
        total = np.concatenate([np.zeros(1, U64), np.cumsum((piece.astype(U64) + U64(1)) * up)])
        grams = len(piece) - gram + 1
        hashed = mix((total[gram:] - total[:-gram]) * down[:grams] + GOLDEN)
        ranked = (hashed & ~PLACES) | np.arange(grams, dtype=U64)
        anchor = (sliding_minimum(ranked, length - gram + 1) & PLACES).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
        last = np.append(first[1:], len(anchor)) - 1
        at = anchor[first]
        yield from zip((at + base).tolist(), (first + base).tolist(), (last + base).tolist(), hashed[at].view(np.int64).tolist(), strict=True)


def signed_hash(data: bytes, seed: int) -> int:
    value = xxhash.xxh3_64_intdigest(data, seed)
    return value - (1 << 64) if value >> 63 else value


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            docs, keys, cols = [], [], [[], [], [], [], []]
            for number, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), batch.column("text"), strict=True):
                data = text.as_py()
                for at, lo, hi, gram in runs(data, powers, length):
                    docs.append(number)
                    keys.append(key)
                    for column, value in zip(cols, (at, lo, hi, gram, signed_hash(data[lo : hi + length], at - lo)), strict=True):
                        column.append(value)
                if len(docs) > 50_000:
                    yield batch_of(docs, keys, cols)
                    docs, keys, cols = [], [], [[], [], [], [], []]
            yield batch_of(docs, keys, cols)

    def batch_of(docs, keys, cols) -> pa.RecordBatch:
        arrays = [pa.array(docs, pa.int64()), pa.array(keys, pa.binary()), *(pa.array(c, pa.int64()) for c in cols)]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "key", "at", "lo", "hi", "gram", "around"])

    return give_back(run)


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] agrees, a[:high] does not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def intervals(shared: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of each common-prefix interval, from the common prefixes of neighbours; a stack scan."""
    stack: list[tuple[int, int]] = []  # depth, first
    for i, depth in enumerate([*shared, 0]):
        first = i
        while stack and stack[-1][0] > depth:
            top, first = stack.pop()
            yield top, first, i
        if depth and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def maximal_repeats(left: list[bytes], right: list[bytes], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes before the anchor, bytes from it on, members) of each maximal repeat of at least ``length`` bytes.

    left holds the reversed bytes before the anchor of each member, right the bytes from the anchor on.
    """
    order = sorted(range(len(right)), key=right.__getitem__)
    shared = [common(right[a], right[b]) for a, b in zip(order, order[1:])]
    for depth, first, last in intervals(shared):
        members = range(first, last + 1)
        reach = max(len(left[order[i]]) for i in members)
        if depth + reach < length:
            continue
        by_left = sorted(members, key=lambda i: left[order[i]])
        agree = [common(left[order[a]], left[order[b]]) for a, b in zip(by_left, by_left[1:])]
        found = list(intervals(agree))
        if min(agree) == 0:  # together they share the bytes from the anchor on alone
            found.append((0, 0, len(by_left) - 1))
        for before, a, b in found:
            if before + depth < length:
                continue
            own = sorted(by_left[a : b + 1])
            # right-maximal: the members differ right after ``depth``
            if min(shared[own[0] : own[-1]]) == depth:
                yield before, depth, [order[i] for i in own]


def _bucket(rows: list[dict], length: int) -> dict[int, list[tuple[int, int]]]:
    """Repeated window starts (first, last, counted from the anchor backwards) of each single member."""
    left = [r["span"][: r["before"]][::-1] for r in rows]
    right = [r["span"][r["before"] :] for r in rows]
    out: dict[int, list[tuple[int, int]]] = {}
    for before, depth, members in maximal_repeats(left, right, length):
        for i in members:
            if rows[i]["n"] == 1:
                first, last = max(-before, -rows[i]["before"]), min(depth - length, rows[i]["width"] - rows[i]["before"])
                if first <= last:
                    out.setdefault(i, []).append((first, last))
    return out


RANGES = "key binary, first long, last long"


def _ranges(rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
    keys, first, last = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "first": pa.array(first, pa.int64()), "last": pa.array(last, pa.int64())})


def _compare(length: int):
    """Buckets stand together in a task's rows; one is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, gram, out = [], None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["gram"] != gram:
                    out += solved(bucket)
                    bucket, gram = [], row["gram"]
                bucket.append(row)
            if len(out) > 10_000:
                yield _ranges(out)
                out = []
        yield _ranges(out + solved(bucket))

    def solved(bucket: list[dict]) -> list[tuple[bytes, int, int]]:
        if len(bucket) < 2:
            return []
        return [(bucket[i]["key"], bucket[i]["at"] + a, bucket[i]["at"] + b) for i, found in _bucket(bucket, length).items() for a, b in found]

    return give_back(run)


def _spans(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("gram", "n", "m", "at", "before", "width")
        for batch in batches:
            rows, spans, keys = [], [], []
            for text, key, wanted in zip(batch.column("text"), batch.column("key").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                data = text.as_py()
                for w in wanted:
                    rows.append((w["gram"], w["n"], w["m"], w["at"], w["at"] - w["lo"], w["hi"] - w["lo"]))
                    spans.append(data[w["lo"] : w["hi"] + length])
                    keys.append(key)
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *(pa.array(c, pa.int64()) for c in columns), pa.array(spans, pa.binary())], names=["key", *names, "span"])

    return give_back(run)


def _pieces(length: int, step: int, above: int):
    """For each asked group of ``step`` neighbouring windows (by bytes before the anchor, from ``group`` on): hashes of the bytes
    that all of its windows hold and of all bytes that they cover, the latter unlike any other where the class lacks some windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                high, span = r["before"], r["span"]
                low = high - r["width"]
                asked = range(low - low % step, high + 1, step) if r["open"] is None else (g for top in r["open"] for g in range(top, top + above, step) if g + step > low and g <= high)
                alone = digest(r["key"] + b"%d %d" % (r["at"], high), b"alone")
                for g in asked:
                    last = min(g + step - 1, length - GRAM)
                    own = digest(span[high - last : high + length - g]) if low <= g and last <= high else alone
                    rows.append((r["key"], r["gram"], r["n"], r["at"], high, g, last, digest(span[high - g : high + length - last]), own))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "gram", "n", "at", "before", "group", "last", "core", "whole"])

    kinds = [pa.binary(), *[pa.int64()] * 6, pa.binary(), pa.binary()]
    return give_back(run)


PIECES = "key binary, gram long, n long, at long, before long, group long, last long, core binary, whole binary"


def digest(data: bytes, person: bytes = b"") -> bytes:
    return hashlib.blake2b(data, digest_size=16, person=person).digest()


def counted_ranges(spans: DataFrame, length: int) -> DataFrame:
    """Repeated windows (key, first, last) of the classes of very large buckets, by counting hashes of groups of windows.

    Where two classes agree in all bytes that a group covers, the whole group is repeated; where no other class has the bytes
    common to its windows, none of it is. Only groups between the two are split, one class for each content of theirs.
    """
    one = ["key", "gram", "at", "before"]
    asked, above, found = spans.withColumn("open", F.lit(None).cast("array<bigint>")), 0, []
    for step in STEPS:
        pieces = write_and_read(asked.select(*one, "n", "width", "span", "open").mapInArrow(_pieces(length, step, above), PIECES), "pieces")
        same = write_and_read(pieces.groupBy("gram", "group", "core", "whole").agg(F.count("*").alias("k"), F.min(F.struct("key", "at", "before")).alias("one")), "contents")
        repeated = pieces.where("n = 1").join(same.where("k > 1").select("gram", "group", "whole"), ["gram", "group", "whole"])
        found.append(repeated.select("key", (F.col("at") - F.col("last")).alias("first"), (F.col("at") - F.col("group")).alias("last")))
        if step > 1:
            split = same.groupBy("gram", "group", "core").agg(F.count("*").alias("contents")).where("contents > 1").drop("contents")
            open_groups = same.join(split, ["gram", "group", "core"]).select("one.*", "gram", "group").groupBy(*one).agg(F.collect_list("group").alias("open"))
            asked, above = spans.join(open_groups, one), step
    return reduce(DataFrame.union, found)


def repeated_ranges(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, first, last): runs of starts of repeated windows, from texts (doc_id, key, text as bytes); key names equal texts."""
    small_batches(texts.sparkSession)
    anchors = write_and_read(texts.mapInArrow(_anchors(length), "doc_id long, key binary, at long, lo long, hi long, gram long, around long"), "anchors")
    often = write_and_read(anchors.groupBy("gram").agg(F.count("*").alias("times")).where("times > 1"), "grams")
    shared = write_and_read(anchors.join(often.select("gram"), "gram"), "shared")
    found = F.min(F.struct("doc_id", "key", "at", "lo", "hi")).alias("one")
    classes = write_and_read(shared.groupBy("gram", "around").agg(F.count("*").alias("n"), found), "classes")
    whole = shared.join(classes.where("n > 1").select("gram", "around"), ["gram", "around"]).select("key", F.col("lo").alias("first"), F.col("hi").alias("last"))

    buckets = write_and_read(classes.groupBy("gram").agg(F.count("*").alias("m"), F.min("n").alias("fewest")).where("m > 1 and fewest = 1").drop("fewest"), "buckets")
    ends = classes.join(buckets, "gram").select("one.*", "gram", "n", "m")
    wanted = write_and_read(ends.groupBy("doc_id", "key").agg(F.collect_list(F.struct("gram", "n", "m", "at", "lo", "hi")).alias("wanted")), "wanted")
    asked = texts.join(wanted.withColumnRenamed("doc_id", "d"), (texts["key"] == wanted["key"]) & F.col("doc_id").eqNullSafe(F.col("d"))).select("text", wanted["key"], "wanted")
    spans = write_and_read(asked.mapInArrow(_spans(length), "key binary, gram long, n long, m long, at long, before long, width long, span binary"), "spans")
    small = spans.where(F.col("m") <= GATHERED).repartition("gram").sortWithinPartitions("gram").mapInArrow(_compare(length), RANGES)
    large = counted_ranges(spans.where(F.col("m") > GATHERED), length)
    return whole.union(small).union(large)


CUT = "struct<n_removed:bigint,n_spans:bigint,kept:binary,first:array<bigint>,last:array<bigint>>"


def _cut(texts: pa.Array, firsts: pa.Array, lasts: pa.Array, lengths: pa.Array) -> pa.Array:
    rows = []
    for text, first, last, length in zip(texts, firsts, lasts, lengths.to_pylist(), strict=True):
        if not len(first):
            rows.append(None)
            continue
        data = text.as_py()
        a, b = np.asarray(first.values, np.int64), np.asarray(last.values, np.int64) + length
        change = np.bincount(a, minlength=len(data) + 1) - np.bincount(b, minlength=len(data) + 1)
        gone = np.cumsum(change[: len(data)]) > 0
        edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        rows.append({"n_removed": int(gone.sum()), "n_spans": len(starts), "kept": kept, "first": starts.tolist(), "last": (ends - 1).tolist()})
    return pa.array(rows, pa.struct([("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("first", pa.list_(pa.int64())), ("last", pa.list_(pa.int64()))]))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, spans) for each row of ``docs`` (doc_id, text); kept is what remains, as bytes.

    A byte goes when it is covered by ``length`` bytes of its text that also start anywhere else, in the same text or another one;
    all judged on the input. Null texts are empty; texts shorter than ``length`` stay whole. Repeated rows are repeats of each
    other; doc_ids may be null or shared. Other columns are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("key", F.unhex(F.substring(F.sha2("text", 256), 1, 32)))
    ranges = repeated_ranges(rows.where(F.octet_length("text") >= length), length)
    per_text = ranges.distinct().groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("found"))
    per_text = write_and_read(per_text, "ranges")
    joined = rows.join(per_text, "key", "left")
    none = F.array().cast("array<bigint>")
    cut = F.when(F.col("found").isNotNull(), F.arrow_udf(_cut, CUT)("text", F.coalesce("found.first", none), F.coalesce("found.last", none), F.lit(length).cast("bigint")))
    result = joined.select("doc_id", "text", cut.alias("cut"))
    spans = F.arrays_zip("cut.first", "cut.last")
    return result.select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.coalesce("cut.n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("cut.n_spans", F.lit(0)).cast("bigint").alias("n_spans"), F.coalesce("cut.kept", "text").alias("kept"), spans.alias("spans"),
    )
