"""LM scoring by logistic context mixing, and the base model it is compared with.

A text is scored as its tokens: words with A-Z lower-cased, each closed by an end byte, and one more end byte for the text. Every
byte is eight binary decisions. Five contexts predict each decision: none, the last one, two and three bytes of the token, and the
whole token so far. Their predictions, as log odds, are added up with weights that are gated by how much the two longest
contexts have seen; an adaptive map of the mixed prediction refines the result. A text's score is the sum over its bits.

Contexts never reach beyond a token, so a token's score depends on the token alone: each distinct token is scored once, and texts
look their tokens up. The counts of tokens are all that the contexts need of the corpus; they are counted over all training texts.
Counts of the short contexts lie in tables, those of two and three bytes hashed, with four slots or more for each counted
decision. The whole token so far is counted exactly: in byte order, tokens that begin alike lie together, so that a token needs
just the sums of the runs around it, found in ranges of tokens, and what other ranges add to the runs at the ends of its own.
Gates and map learn online from every counted token, each occurrence predicted from all the others, in parallel runs whose
weights are averaged.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlake.llm.common import GOLDEN, U64, give_back, list_array, mix, small_batches, words_of
from firmlake.session import write_and_read

SLOTS = (8, 16, 18, 20)  # least bits of the table of each short context
CHUNK = 1 << 16
MANY_UNITS = 200_000  # distinct ones that a task counts before it passes them on
UNITS_AT_ONCE = 4_000
LEARNT_AT_ONCE = 500
KNOWN_UNITS = 250_000
RANGE = (100_000, 1 << 24)  # wanted tokens, and bytes, of a range of tokens in byte order
STATES = (12, 6)  # how much a context has seen
MAP = 33  # places of the adaptive map between log odds -8 and 8
FREQUENT = 200_000  # most base tokens whose counts and scores go to every task; those of all others are joined
PRIOR = 0.4
RUNS = 32
NODES = mix(np.arange(256, dtype=U64) * GOLDEN)  # added to a context's hash for each of its decisions


def units_of(text: bytes | None) -> list[bytes]:
    """The tokens of a text, with a blank, which no token has, for the byte that ends units: so no unit goes on where another ends."""
    words = words_of(text)
    return [w.replace(b"\0", b" ") for w in words] if text and b"\0" in text else words


def laid_out(units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """The bytes with those that close the units, the unit and place of each, and the one, two and three bytes before it."""
    data = np.frombuffer(b"".join(u + b"\0" for u in units), np.uint8)
    sizes = np.array([len(u) + 1 for u in units])
    place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    padded = np.concatenate([np.zeros(3, np.int64), data.astype(np.int64)])
    return data, np.repeat(np.arange(len(units)), sizes), place, [np.where(place >= k, padded[3 - k : len(data) + 3 - k], 0) for k in (1, 2, 3)]


def decisions(units: list[bytes], sizes: tuple[int, ...]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Unit of each byte, slots of each short context (bytes x 8) in tables of ``sizes`` bits, and the bits (bytes x 8)."""
    data, unit, _, back = laid_out(units)
    node = (data[:, None].astype(np.int64) | 256) >> np.arange(8, 0, -1)[None, :]
    bits = (data[:, None] >> np.arange(7, -1, -1)[None, :]) & 1
    contexts = [None, None, back[0] | back[1] << 8 | 1 << 24, back[0] | back[1] << 8 | back[2] << 16 | 1 << 25]
    slots, apart = [node, back[0][:, None] << 8 | node], NODES[node]
    for k in (2, 3):
        own = mix(contexts[k].astype(U64) * GOLDEN + U64(k))
        slots.append(((own[:, None] + apart) >> U64(64 - sizes[k])).view(np.int64))
    return unit, slots, bits


class Contexts:
    """Decisions seen in each slot, and how many were 1, side by side: one read of a large table fetches both."""

    def __init__(self, sizes: tuple[int, ...] = SLOTS, kind: type = np.float32):
        self.sizes = sizes
        self.counts = [np.zeros((1 << b, 2), kind) for b in sizes]

    def add(self, units: list[bytes], counts: np.ndarray) -> None:
        unit, slots, bits = decisions(units, self.sizes)
        weight, up = np.repeat(counts[unit].astype(float), 8), bits.ravel().astype(bool)
        for table, at in zip(self.counts, slots, strict=True):
            at, flat = at.ravel(), table.reshape(-1)
            np.add.at(flat, 2 * at, weight)
            np.add.at(flat, 2 * at[up] + 1, weight[up])

    def predict(self, slots: list[np.ndarray], far: tuple[np.ndarray, np.ndarray], own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of 1 for each context (contexts x decisions) and the gate. far: how often the whole unit so far was seen at each
        decision, and with a 1; own: bits to leave out, where they are counted."""
        odds = np.empty((len(self.sizes) + 1, len(far[0])), np.float32)
        for c in range(len(odds)):
            if c < len(slots):
                both = self.counts[c].view(np.complex64).reshape(-1).take(slots[c].ravel())
                n, k = both.real, both.imag
            else:
                n, k = (x.astype(np.float32) for x in far)
            if own is not None:
                n = np.maximum(n - np.float32(1), 0)
                k = np.clip(k - own.astype(np.float32), 0, n)
            np.log((k + np.float32(PRIOR)) / (np.maximum(n - k, 0) + np.float32(PRIOR)), out=odds[c])
            if c == 3:
                before = np.log2(n + np.float32(1))
        a, b = STATES
        gate = np.minimum(np.log2(n + np.float32(1)), a - 1).astype(np.int64) * b + np.minimum(before / 2, b - 1).astype(np.int64)
        return np.clip(odds, -12, 12, out=odds), gate


def shared_bits(a: bytes, b: bytes) -> int:
    """Bits that two closed units have in common at their beginnings."""
    size = min(len(a), len(b))
    differ = np.frombuffer(a, np.uint8, size) ^ np.frombuffer(b, np.uint8, size)
    at = int((differ != 0).argmax()) if size else 0
    return 8 * size if not size or not differ[at] else 8 * at + 8 - int(differ[at]).bit_length()


def shared_with_previous(units: list[bytes]) -> np.ndarray:
    """``shared_bits`` of each unit with the one before it; 0 for the first."""
    shared = np.zeros(len(units), np.int64)
    data, _, place, _ = laid_out(units)
    data = data.astype(np.int64)
    first = np.flatnonzero(place == 0)
    least = np.minimum(np.diff(first), np.diff(np.append(first, len(data)))[1:])
    going = np.arange(1, len(units))
    for at in range(64):
        ended = least[going - 1] == at
        shared[going[ended]] = 8 * at
        going = going[~ended]
        differ = data[first[going] + at] ^ data[first[going - 1] + at]
        other = differ > 0
        shared[going[other]] = 8 * at + 7 - np.log2(differ[other]).astype(np.int64)
        going = going[~other]
        if not len(going):
            break
    for i in going:
        shared[i] = shared_bits(units[i - 1] + b"\0", units[i] + b"\0")
    return shared


def weights_by(shared: np.ndarray, n: np.ndarray) -> dict[int, int]:
    found, at = np.unique(shared, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, at, n)
    return dict(zip(found.tolist(), total.tolist(), strict=True))


def runs_of(units: list[bytes], n: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray, np.ndarray]:
    """Of distinct units in byte order: how often all units that share a unit's first bits were counted, as (offsets, upto, weight),
    where a weight holds for up to so many bits; and the bits that each unit shares with the first and the last one."""
    shared, whole = shared_with_previous(units), np.array([8 * len(u) + 8 for u in units])
    left = np.minimum.accumulate(np.append(whole[:1], shared[1:]))
    right = np.minimum.accumulate(np.append(whole[-1:], shared[:0:-1]))[::-1]
    most = np.maximum(shared, np.append(shared[1:], 0))
    who, upto, weight = [], [], []
    # one run of units at first, cut where less is shared; units that share nothing further drop out
    going, last = np.arange(len(units)), -1
    for level in np.unique(shared[1:]).tolist():
        going = going[most[going] >= level]
        start = shared[going] <= last
        start[0] = True
        group = np.cumsum(start) - 1
        total = np.add.reduceat(n[going], np.flatnonzero(start))
        who.append(going)
        upto.append(np.full(len(going), level))
        weight.append(total[group])
        last = level
    who, upto, weight = np.concatenate([*who, np.arange(len(units))]), np.concatenate([*upto, whole]), np.concatenate([*weight, n])
    order = np.argsort(who, kind="stable")
    who, upto, weight = who[order], upto[order], weight[order]
    again = np.append((who[1:] == who[:-1]) & (weight[1:] == weight[:-1]), False)
    who, upto, weight = who[~again], upto[~again], weight[~again]
    return (np.searchsorted(who, np.arange(len(units) + 1)), upto, weight), left, right


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``runs_of`` a task's units, and in a last row what other ranges need to know of it and the runs of four bytes in it."""
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    rows = pa.Table.from_batches(tables).combine_chunks()
    units, n = rows.column("unit").to_pylist(), rows.column("n").to_numpy()
    part = TaskContext.get().partitionId()
    (offsets, upto, weight), left, right = runs_of(units, n)
    for at in range(0, len(units), UNITS_AT_ONCE):
        end = min(at + UNITS_AT_ONCE, len(units))
        own = pa.array(offsets[at : end + 1] - offsets[at], pa.int32())
        some = rows.slice(at, end - at).combine_chunks()
        some = [some.column(c).chunk(0) for c in ("unit", "token", "n")]
        inner = slice(offsets[at], offsets[end])
        yield pa.RecordBatch.from_arrays(
            [*some, pa.array(np.full(end - at, part), pa.int32()), pa.array(left[at:end], pa.int64()), pa.array(right[at:end], pa.int64()),
             pa.ListArray.from_arrays(own, pa.array(upto[inner], pa.int64())), pa.ListArray.from_arrays(own, pa.array(weight[inner], pa.int64())),
             pa.nulls(end - at, pa.binary()), pa.nulls(end - at, pa.list_(pa.int64()))],
            names=RANGED_NAMES,
        )
    found = np.empty(0, np.int64)
    for some in portions([u for u, k in zip(units, n.tolist(), strict=True) if k], 10 * UNITS_AT_ONCE):
        data, _, _, back = laid_out(some)
        found = np.union1d(found, data.astype(np.int64) | back[0] << 8 | back[1] << 16 | back[2] << 24)
    ends = pickle.dumps((units[0] + b"\0", units[-1] + b"\0", weights_by(left, n), weights_by(right, n)))
    last = [None] * 3 + [part] + [None] * 4 + [ends, found.tolist()]
    kinds = [pa.binary(), *[pa.int64()] * 2, pa.int32(), *[pa.int64()] * 2, *[pa.list_(pa.int64())] * 2, pa.binary(), pa.list_(pa.int64())]
    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(last, kinds, strict=True)], names=RANGED_NAMES)


RANGED = "unit binary, token long, n long, part int, left long, right long, upto array<long>, weight array<long>, ends binary, four array<long>"
RANGED_NAMES = [c.split(" ")[0] for c in RANGED.split(", ")]


Outside = tuple[tuple[np.ndarray, np.ndarray, np.ndarray], ...]


def beyond(ranges: list[tuple[int, tuple]]) -> Outside:
    """For each range (number, what it told): how often units of the ranges before it share so many bits or more with its first
    unit, and those of the ranges after it with its last; either as (start and size by number, all sums)."""
    ranges = sorted(ranges, key=lambda r: r[1][0])
    out: dict[int, list[np.ndarray]] = {number: [] for number, _ in ranges}

    def carried(told: dict[int, int], outside: dict[int, int], through: int, across: int) -> dict[int, int]:
        total: Counter = Counter()
        for shared, k in told.items():
            total[min(shared, across)] += k
        for shared, k in outside.items():
            total[min(shared, through, across)] += k
        return dict(total)

    def sums(by: dict[int, int]) -> np.ndarray:
        dense = np.zeros(max(by, default=-1) + 1, np.int64)
        for shared, k in by.items():
            dense[shared] += k
        return dense[::-1].cumsum()[::-1]

    for step in (1, -1):
        outside: dict[int, int] = {}
        ordered = ranges[::step]
        for i, (number, own) in enumerate(ordered):
            if i:
                first, last, by_first, by_last = before = ordered[i - 1][1]
                pair = (before[1], own[0]) if step == 1 else (own[1], before[0])
                outside = carried(by_last if step == 1 else by_first, outside, shared_bits(first, last), shared_bits(*pair))
            out[number].append(sums(outside))
    sides = []
    for side in range(2):
        by_number = [out[i][side] if i in out else np.empty(0, np.int64) for i in range(max(out, default=-1) + 1)]
        sizes = np.array([len(x) for x in by_number], np.int64)
        sides.append((np.cumsum(sizes) - sizes, sizes, np.concatenate([np.empty(0, np.int64), *by_number])))
    return tuple(sides)


def far_counts(batch: pa.RecordBatch, others: Outside, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often the whole unit so far was seen at each decision of the batch's units, and with a 1."""
    lists, upto = batch.column("upto"), batch.column("upto").flatten().to_numpy()
    sizes = np.diff(lists.offsets.to_numpy())
    first = np.cumsum(sizes) - sizes
    run = np.diff(upto, prepend=0)
    run[first] = upto[first] + 1
    seen = np.repeat(batch.column("weight").flatten().to_numpy(), run)
    values = upto[first + sizes - 1] + 1  # one more than the unit's decisions
    start = np.cumsum(values) - values
    part = batch.column("part").to_numpy()
    for (of_part, known, sums), shared in zip(others, ("left", "right"), strict=True):
        levels = np.minimum(batch.column(shared).to_numpy() + 1, known[part])
        level = np.arange(levels.sum()) - np.repeat(np.cumsum(levels) - levels, levels)
        seen[np.repeat(start, levels) + level] += sums[np.repeat(of_part[part], levels) + level]
    inside = np.ones(len(seen), bool)
    inside[start + values - 1] = False
    here = np.flatnonzero(inside)
    return seen[here], np.where(bits.ravel() == 1, seen[here + 1], seen[here] - seen[here + 1])


class Mixer:
    def __init__(self):
        self.weights = np.tile([0.0, 0.0, 0.1, 0.3, 0.6], (STATES[0] * STATES[1], 1))
        self.seen = np.full((256, MAP), 0.5)
        self.ones = np.tile(self.seen[0] / (1 + np.exp(-np.linspace(-8, 8, MAP))), (256, 1))
        self.steps = 0

    def _mixed(self, odds: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.clip(sum(np.ascontiguousarray(w).take(gate) * own for w, own in zip(self.weights.T, odds, strict=True)), -16, 16)

    @staticmethod
    def _place(z: np.ndarray) -> np.ndarray:
        return np.clip(np.rint((z + 8) * (MAP - 1) / 16), 0, MAP - 1).astype(np.int64)

    def learn(self, odds: np.ndarray, gate: np.ndarray, node: np.ndarray, bits: np.ndarray, weight: np.ndarray) -> None:
        z = self._mixed(odds, gate)
        p = 1 / (1 + np.exp(-z))
        self.steps += 1
        rate = 1 / self.steps**0.4
        error, curve = weight * (bits - p), weight * p * (1 - p)
        for k in range(len(odds)):
            up = np.bincount(gate, error * odds[k], len(self.weights))
            bend = np.bincount(gate, curve * odds[k] ** 2 * len(odds), len(self.weights))
            self.weights[:, k] += rate * up / (bend + weight.mean() * 5)
        at = node * MAP + self._place(z)
        self.seen += np.bincount(at, weight, 256 * MAP).reshape(256, MAP)
        self.ones += np.bincount(at, weight * bits, 256 * MAP).reshape(256, MAP)

    def log10(self, odds: np.ndarray, gate: np.ndarray, node: np.ndarray, bits: np.ndarray) -> np.ndarray:
        z = self._mixed(odds, gate)
        refined = (self.ones / self.seen)[node, self._place(z)]
        p = np.clip((1 / (1 + np.exp(-z)) + refined) / 2, 1e-7, 1 - 1e-7)
        return np.log10(np.where(bits == 1, p, 1 - p))


def portions(units: list[bytes], most: int = UNITS_AT_ONCE) -> Iterator[list[bytes]]:
    """Units in portions of a bounded number of bytes; a longer unit goes alone."""
    some, held = [], 0
    for u in units:
        if some and (len(some) >= most or held + len(u) > 16 * most):
            yield some
            some, held = [], 0
        some.append(u)
        held += len(u)
    if some:
        yield some


def token_key(token: bytes) -> int:
    """64-bit key of a token, as Spark's xxhash64 gives it; the empty one is the end of a text."""
    value = xxhash.xxh64_intdigest(token, 42)
    return value - (1 << 64) if value >> 63 else value


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units of all texts, counted in those that are learnt from."""
    units = Counter()

    def some() -> pa.RecordBatch:
        rows = {"unit": pa.array(list(units), pa.binary()), "n": pa.array(list(units.values()), pa.int64())}
        units.clear()
        return pa.RecordBatch.from_pydict(rows)

    for batch in batches:
        for text, learnt in zip(batch.column("text"), batch.column("learnt").to_pylist(), strict=True):
            own = units_of(text.as_py())
            if learnt:
                units.update(own)
                units[b""] += 1
            else:
                for word in {b"", *own}:
                    units.setdefault(word, 0)
        if len(units) > MANY_UNITS:
            yield some()
    if units:
        yield some()


def pieces(batch: pa.RecordBatch, most: int) -> Iterator[tuple[list[bytes], pa.RecordBatch]]:
    """A batch's units in portions, with their rows."""
    at = 0
    for some in portions(batch.column("unit").to_pylist(), most):
        yield some, batch.slice(at, len(some))
        at += len(some)


def _tables(sizes: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Contexts(sizes, np.float64)
        for batch in batches:
            for some, rows in pieces(batch, UNITS_AT_ONCE):
                held.add(some, rows.column("n").to_numpy())
        for k, table in enumerate(held.counts):
            for at in range(0, len(table), CHUNK):
                seen, ones = table[at : at + CHUNK].astype(np.float32).T
                if seen.any():
                    yield _parts([(k, at, seen, ones)])

    return give_back(run)


def _parts(rows: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "context": pa.array([r[0] for r in rows], pa.int32()), "place": pa.array([r[1] for r in rows], pa.int32()),
        "seen": pa.array([r[2].tobytes() for r in rows], pa.binary()), "ones": pa.array([r[3].tobytes() for r in rows], pa.binary()),
    })


PARTS = "context int, place int, seen binary, ones binary"


def _added(kind: str):
    """Sums the parts of a task by (context, place) as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                own = [np.frombuffer(r["seen"], kind), np.frombuffer(r["ones"], kind)]
                key = r["context"], r["place"]
                held[key] = [a + b for a, b in zip(held[key], own, strict=True)] if key in held else own
        for (k, at), (seen, ones) in held.items():
            yield _parts([(k, at, seen, ones)])

    return run


def _learn(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, others = sent.value
        mixer, total = Mixer(), 0.0
        for batch in batches:
            for some, rows in pieces(batch, LEARNT_AT_ONCE):
                unit, slots, bits = decisions(some, contexts.sizes)
                odds, gate = contexts.predict(slots, far_counts(rows, others, bits), bits.ravel())
                weight = np.repeat(rows.column("n").to_numpy().astype(float)[unit], 8)
                mixer.learn(odds, gate, slots[0].ravel(), bits.ravel(), weight)
                total += weight.sum()
        if total:
            yield _parts([(0, 0, mixer.weights.ravel() * total, np.array([total])), (1, 0, mixer.seen.ravel(), mixer.ones.ravel())])

    return give_back(run)


def _judge(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, others, mixer = sent.value
        for batch in batches:
            for some, rows in pieces(batch, UNITS_AT_ONCE):
                unit, slots, bits = decisions(some, contexts.sizes)
                odds, gate = contexts.predict(slots, far_counts(rows, others, bits))
                per_bit = mixer.log10(odds, gate, slots[0].ravel(), bits.ravel())
                value = np.bincount(unit, per_bit.reshape(-1, 8).sum(1), len(some))
                yield pa.RecordBatch.from_arrays([rows.column("token"), rows.column("n"), pa.array(value, pa.float64())], names=["token", "n", "value"])

    return give_back(run)


def decided_nodes(four: DataFrame) -> int:
    """Distinct decisions, each told by the bytes before it and the bits of its own byte, of runs of bytes whose last is their own."""
    sets = four.groupBy(F.shiftright("four", 8).alias("before")).agg(F.collect_set(F.col("four").bitwiseAND(255)).alias("own"))
    nodes = " + ".join(f"size(array_distinct(transform(own, x -> shiftright(x, {k}))))" for k in range(1, 9))
    return sets.agg(F.coalesce(F.sum(F.expr(nodes)), F.lit(0))).first()[0]


def table_sizes(four: DataFrame) -> tuple[int, ...]:
    """Bits of each table, for four slots or more per distinct counted decision; from the runs of four bytes (four)."""
    middle, longest = (decided_nodes(four.select(F.col("four").bitwiseAND((1 << bits) - 1).alias("four"))) for bits in (24, 32))
    return (*SLOTS[:2], *(max(least, (4 * n - 1).bit_length()) for least, n in zip(SLOTS[2:], (middle, longest), strict=True)))


def in_ranges(units: DataFrame) -> DataFrame:
    """Rows of ``RANGED`` for the distinct units (unit, token, n)."""
    n, size = units.agg(F.count("*"), F.coalesce(F.sum(F.length("unit")), F.lit(0))).first()
    ranges = max(1, -(-n // RANGE[0]), -(-size // RANGE[1]))
    return write_and_read(units.repartitionByRange(ranges, "unit").sortWithinPartitions("unit").mapInArrow(give_back(_ranges), RANGED), "ranges")


def train(texts: DataFrame) -> DataFrame:
    """Count and score (token: key, n, value: log10 of the probability) of each distinct token of ``texts`` (text: bytes, not null; learnt)."""
    spark = texts.sparkSession
    small_batches(spark)
    counted = texts.select("text", "learnt").mapInArrow(give_back(_count), "unit binary, n long")
    units = write_and_read(counted.groupBy("unit").agg(F.sum("n").alias("n")).select("unit", F.xxhash64("unit").alias("token"), "n"), "counts")
    ranged = in_ranges(units)
    others = beyond([(r.part, pickle.loads(r.ends)) for r in ranged.where("ends is not null").select("part", "ends").collect()])
    sizes = table_sizes(ranged.where("ends is not null").select(F.explode("four").alias("four")))
    learnt = units.where("n > 0").select("unit", "n")
    parts = learnt.mapInArrow(_tables(sizes), PARTS).repartition("context", "place").mapInArrow(give_back(_added("<f4")), PARTS)
    contexts = Contexts(sizes)
    for r in parts.toArrow().to_pylist():
        seen, ones = np.frombuffer(r["seen"], np.float32), np.frombuffer(r["ones"], np.float32)
        contexts.counts[r["context"]][r["place"] : r["place"] + len(seen)] = np.stack([seen, ones], 1)
    rows = ranged.where("ends is null").select("unit", "token", "n", "part", "left", "right", "upto", "weight")
    sent = spark.sparkContext.broadcast((contexts, others))
    # in an order that has nothing to do with the bytes, as the weights follow what comes last
    dealt = rows.where("n > 0").repartition(RUNS, "token").sortWithinPartitions("token")
    runs = dealt.mapInArrow(_learn(sent), PARTS)
    mixer = Mixer()
    weights, mass, seen, ones = np.zeros(mixer.weights.size), 0.0, np.zeros(mixer.seen.size), np.zeros(mixer.seen.size)
    for r in runs.collect():
        a, b = np.frombuffer(r["seen"], "<f8"), np.frombuffer(r["ones"], "<f8")
        if r["context"] == 0:
            weights, mass = weights + a, mass + b[0]
        else:
            seen, ones = seen + a, ones + b
    if mass:
        mixer.weights = (weights / mass).reshape(mixer.weights.shape)
        mixer.seen, mixer.ones = seen.reshape(mixer.seen.shape), ones.reshape(mixer.ones.shape)
    model = spark.sparkContext.broadcast((contexts, others, mixer))
    return write_and_read(rows.mapInArrow(_judge(model), "token long, n long, value double"), "scores")


def frequent(tokens: DataFrame, most: int = FREQUENT) -> tuple[int, pa.Table]:
    """Least count so that at most ``most`` tokens reach it, and the rows of these tokens."""
    level = F.floor(F.log2("n") * 8).cast("int")
    sizes = tokens.groupBy(level.alias("level")).agg(F.count("*").alias("k"), F.min("n").alias("least")).orderBy(F.desc("level")).collect()
    taken, least = 0, 1 << 62
    for r in sizes:
        taken += r["k"]
        if taken > most:
            break
        least = r["least"]
    return least, tokens.where(F.col("n") >= least).toArrow()


class Places(dict):
    """Place of a word's token in a table of keys, or behind the table's end for one that is not in it, whose key ``cold`` then has."""

    def __init__(self, keys: np.ndarray):
        super().__init__()
        self.table = {key: at for at, key in enumerate(keys.tolist())}
        self.cold: list[int] = []

    def __missing__(self, word: bytes) -> int:
        key = token_key(word)
        at = self.table.get(key)
        if at is None:
            at = len(self.table) + len(self.cold)
            self.cold.append(key)
        self[word] = at
        return at

    def of(self, texts: list[list[bytes]]) -> np.ndarray:
        """Places of all words of the texts; what was learnt of words goes once there are ``KNOWN_UNITS``."""
        if len(self) >= KNOWN_UNITS:
            self.clear()
            self.cold.clear()
        return np.fromiter(map(self.__getitem__, chain.from_iterable(texts)), np.int64, sum(map(len, texts)))


def _score(table, denominator: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, value = table.value
        places, known, cost = Places(keys), n > 0, np.log10((n + 0.1) / denominator)
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            units = [[*units_of(t), b""] for t in texts]
            n_tokens = np.array([len(u) for u in units], np.int64)
            at, row = places.of(units), np.repeat(np.arange(len(texts)), n_tokens)
            seen = at < len(keys)
            often, of = at[seen], row[seen]
            n_known = np.bincount(of[known[often]], minlength=len(texts))
            base, score = (np.bincount(of, x[often], len(texts)) for x in (cost, value))
            # the others of each text, with how often it has them
            cold, times = np.unique(row[~seen] << 40 | at[~seen] - len(keys), return_counts=True)
            ends = np.searchsorted(cold >> 40, np.arange(len(texts) + 1)).tolist()
            rare = np.array(places.cold, np.int64)[cold & (1 << 40) - 1]
            rare, times = ([x[a:b] for a, b in zip(ends, ends[1:])] for x in (rare, times))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(n_tokens), pa.array(n_known.astype(np.int64)), pa.array(base, pa.float64()),
                 pa.array(score, pa.float64()), pa.array([len(t) for t in texts], pa.int64()), list_array(rare), list_array(times)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "n_bytes", "rare", "rare_n"],
            )

    return give_back(run)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long, rare array<long>, rare_n array<long>"


def score(docs: DataFrame, folds: int = 10) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for each row of ``docs`` (doc_id, text).

    Rows whose crc32(doc_id as text) mod ``folds`` is 0 are held out; rows without doc_id are neither learnt from nor held out.
    Null and empty texts are just their end. Repeated rows count and are scored one by one; other columns are ignored. Without
    training texts each bit costs one bit, and the base score is 0. bits_per_byte, over the bytes of the
    text as it is, is null for empty texts.
    """
    spark = docs.sparkSession
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    rows = docs.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    tokens = train(rows.withColumn("learnt", F.expr("doc_id is not null and not held_out")))
    total, distinct = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    denominator = total + 0.1 * (distinct + 1)
    least, often = frequent(tokens)
    table = spark.sparkContext.broadcast(tuple(often.column(c).to_numpy() for c in ("token", "n", "value")))
    scored = write_and_read(rows.mapInArrow(_score(table, denominator), SCORED), "scored").withColumn("row", F.monotonically_increasing_id())
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("one")).select("row", F.col("one.rare").alias("token"), F.col("one.rare_n").alias("k"))
    joined = rare.join(tokens.where(F.col("n") < least), "token", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    cost = F.col("k") * F.log10((F.col("c") + 0.1) / denominator)
    added = joined.groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("known"), F.sum(cost).alias("cost"), F.sum(F.col("k") * F.col("value")).alias("value"))
    result = scored.drop("rare", "rare_n").join(added, "row", "left").withColumn("score", F.col("score") + F.coalesce("value", F.lit(0.0)))
    return result.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("cost", F.lit(0.0))).alias("base_score"), "score",
        F.when(F.col("n_bytes") > 0, -F.col("score") / F.log10(F.lit(2.0)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
