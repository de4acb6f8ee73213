"""Embedding near-dedup on an inverted multi-index.

A unit vector is cut in halves, and each half has a codebook of its own; a pair of centroids is a cell of the product grid, so K
centroids a half give K * K cells. Every vector lives in the cell of its nearest centroids. Its neighbours are looked for in the
cells nearest to it, in the order of the multi-sequence traversal (both lists of half distances are walked together, smallest
sum first). How many cells are visited follows from the target recall: of vectors that the codebooks were not trained on, drawn
by hash as well, copies turned in random directions to exactly the wanted cosine must land in a visited cell, or the first vector
in one that they visit. Visits are raised up to that number, if need be to all cells. The training sample grows with the
codebooks. Each candidate is verified by its cosine in double precision.

Equal vectors are one class, told by a 128-bit digest. The visited cells of a vector are not written out: they are those up to
its reach, a sum of half distances between the last visited cell and the next, and are found again from it wherever they are
needed. Centroids of a half that lie together are a group, and a pair of groups is a region of the grid. A vector goes to a region
once, however many of its cells it visits, packed with others and in its own precision. A region is cut into blocks of its
residents and of its visitors, so that one with a third of all vectors is many tasks; a task holds residents and lets visitors
stream past, cell by cell, and gives back counts and a spanning forest, so no pairs are written out. Regions are worked off in
rounds, whose shuffles are bounded by the size of the vectors and removed after each. A link that both ends can find is counted
once for each end.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlake.llm.common import U64, components, draw, give_back, mix
from firmlake.session import drop_stored, settings, write_and_read

SAMPLE = 8192  # least vectors that the codebooks are trained on, drawn by hash
POINTS = 64  # least ones for a centroid, so 65,536 vectors at most
PROBES = 2048  # other vectors, that the number of visited cells is fitted on; at most a fifth of all
PER_CELL = 24  # classes wanted in a cell
CENTROIDS = (4, 1024)  # least and most of a half
ROUNDS = 12
TARGET_RECALL = 0.99
BLOCK = 2048  # side of a matrix product
GAP = 1e-10  # least distance of a reach from the sums on both sides: far above what their rounding can be
RESIDENT_BYTES = 96 << 20  # vectors that a task holds
VISITOR_BYTES = (3 << 20, 160 << 20)  # least and most that stream past them
CHUNK_BYTES = 24 << 20  # of those, compared at once
PAIRS = 1 << 22  # of a visitor and a cell, at most, when cells are looked up
UNITS = 16  # tasks wanted of a round, where there is enough for them
ROUND_BYTES = 256 << 20  # a round's vectors, or ROUND_SHARE of all where that is more
ROUND_SHARE = 2.25
GROUPS = 32  # of the centroids of a half, at most
PIECE_BYTES = 128 << 10
#: shuffles of a query go when it ends, not when the driver happens to collect its garbage; packs come in batches of bounded size
SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def fit_codebook(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means of the rows; fewer centroids where there are fewer points."""
    chance = np.random.default_rng(seed)
    centres = points[chance.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = np.concatenate([half_distances(points[at : at + 4096], centres).argmin(1) for at in range(0, len(points), 4096)])
        n = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, points)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


def half_distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]


def paired_distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points**2).sum(1) - 2 * (points * centres).sum(1) + (centres**2).sum(1)


def multi_sequence(first: np.ndarray, second: np.ndarray, most: int) -> list[tuple[int, int]]:
    """The ``most`` pairs of places with the smallest sums of two ascending lists, smallest first."""
    heap, seen, out = [(first[0] + second[0], 0, 0)], {(0, 0)}, []
    while heap and len(out) < most:
        _, i, j = heapq.heappop(heap)
        out.append((i, j))
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(first) and b < len(second) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (first[a] + second[b], a, b))
    return out


class MultiIndex:
    def __init__(self, left: np.ndarray, right: np.ndarray, visits: int):
        self.left, self.right, self.visits = left, right, visits

    def parts(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.left.shape[1]
        return half_distances(unit[:, :cut], self.left), half_distances(unit[:, cut:], self.right)

    def home(self, unit: np.ndarray) -> np.ndarray:
        a, b = self.parts(unit)
        return a.argmin(1).astype(np.int64) * len(self.right) + b.argmin(1)

    def ranks(self, unit: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Place of one cell in the traversal of each vector, from 1 on."""
        a, b = self.parts(unit)
        wanted = a[np.arange(len(a)), cells // len(self.right)] + b[np.arange(len(b)), cells % len(self.right)]
        return np.array([int((a[i][:, None] + b[i][None, :] < wanted[i] - 1e-12).sum()) + 1 for i in range(len(a))])

    def reaches(self, a: np.ndarray, b: np.ndarray, spare: int = 16) -> np.ndarray:
        """For each row of half distances a sum that the visited cells do not exceed and no others reach.

        All rows are walked at once: of the first ``n`` pairs of a traversal each has places with (i + 1) * (j + 1) <= n. Cells as far
        away as the last one are visited, too.
        """
        p, q = a.shape[1], b.shape[1]
        n = min(self.visits + spare, p * q)
        if self.visits >= p * q:
            return np.full(len(a), np.inf)
        near_a, near_b = (np.sort(x if n >= x.shape[1] else np.partition(x, n - 1, axis=1)[:, :n], axis=1) for x in (a, b))
        i, j = np.nonzero(np.outer(np.arange(1, near_a.shape[1] + 1), np.arange(1, near_b.shape[1] + 1)) <= n)
        last, out = self.visits - 1, np.empty(len(a))
        step = max(1, PAIRS // 2 // len(i))
        for at in range(0, len(a), step):
            sums = np.partition(near_a[at : at + step, i] + near_b[at : at + step, j], (last, n - 1), axis=1)[:, last:n]
            sums.sort(axis=1)
            apart = np.diff(sums, axis=1) > GAP
            rows, first = np.arange(len(sums)), apart.argmax(1)
            out[at : at + step] = (sums[rows, first] + sums[rows, first + 1]) / 2
            for row in np.flatnonzero(~apart.any(1)) + at:
                out[row] = reach_of(np.sort(a[row]), np.sort(b[row]), self.visits)
        return out


def reach_of(first: np.ndarray, second: np.ndarray, visits: int) -> float:
    """A sum between that of the pair at place ``visits`` or later and the next, walked on until the two differ."""
    most = visits
    while most < len(first) * len(second):
        most *= 4
        i, j = np.array(multi_sequence(first, second, most)).T
        sums = (first[i] + second[j])[visits - 1 :]
        apart = np.flatnonzero(np.diff(sums) > GAP)
        if len(apart):
            return float(sums[apart[0]] + sums[apart[0] + 1]) / 2
    return np.inf


@dataclass(frozen=True)
class Regions:
    """Groups of the centroids of each half, as arrays of their numbers; region g * len(right) + h is that of the groups g and h."""

    left: list[np.ndarray]
    right: list[np.ndarray]

    def visited(self, a: np.ndarray, b: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """A column for each region: whether some cell of it is visited."""
        first, second = (np.stack([x[:, own].min(1) for own in groups], 1) for x, groups in ((a, self.left), (b, self.right)))
        return (first[:, :, None] + second[:, None, :] <= reach[:, None, None]).reshape(len(a), -1)

    def of_cells(self, index: MultiIndex) -> np.ndarray:
        place = [np.empty(sum(map(len, groups)), np.int64) for groups in (self.left, self.right)]
        for at, groups in zip(place, (self.left, self.right), strict=True):
            for g, own in enumerate(groups):
                at[own] = g
        return (place[0][:, None] * len(self.right) + place[1][None, :]).ravel()


def fit_regions(index: MultiIndex, n_bytes: int) -> Regions:
    """As many regions as it takes for about ``RESIDENT_BYTES`` in each, ``GROUPS`` a half at most."""

    def groups(centres: np.ndarray, k: int) -> list[np.ndarray]:
        near = half_distances(centres, fit_codebook(centres, k, 4)).argmin(1) if centres.shape[1] else np.zeros(len(centres), np.int64)
        return [np.flatnonzero(near == g) for g in np.unique(near)]

    wanted = -(-n_bytes // RESIDENT_BYTES)
    left = min(int(np.ceil(np.sqrt(wanted))), GROUPS, len(index.left))
    right = min(-(-wanted // left), GROUPS, len(index.right))
    left = min(-(-wanted // right), GROUPS, len(index.left))
    return Regions(groups(index.left, left), groups(index.right, right))


def centroids(classes: int) -> int:
    """Of a half, for about ``PER_CELL`` classes a cell."""
    return int(np.clip(round(np.sqrt(classes / PER_CELL)), *CENTROIDS))


def sample_size(classes: int) -> int:
    """Vectors to draw: those to train on and the probes."""
    return max(SAMPLE, POINTS * centroids(classes)) + PROBES


def fit_index(sample: np.ndarray, classes: int, cosine: float, recall: float = TARGET_RECALL) -> MultiIndex:
    """Codebooks for about ``PER_CELL`` classes a cell, and the visits that reach ``recall`` at ``cosine`` on vectors held out from them."""
    k = centroids(classes)
    cut = max(1, sample.shape[1] // 2)
    chance = np.random.default_rng(3)
    dealt = chance.permutation(len(sample))
    held = min(PROBES, len(sample) // 5)
    # of fewer than five vectors none can be held out
    probes, points = (sample[dealt[:held]], sample[dealt[held:]]) if held else (sample, sample)
    left = fit_codebook(points[:, :cut], k, 1)
    right = fit_codebook(points[:, cut:], k, 2) if sample.shape[1] > cut else np.zeros((1, 0))
    left, right = (x[np.sort(np.unique(x, axis=0, return_index=True)[1])] if x.shape[1] else x for x in (left, right))  # equal halves
    index = MultiIndex(left, right, 1)
    turn = chance.normal(size=probes.shape)
    turn -= (turn * probes).sum(1)[:, None] * probes
    length = np.linalg.norm(turn, axis=1)[:, None]
    other = cosine * probes + np.sqrt(1 - cosine**2) * np.divide(turn, length, out=np.zeros_like(turn), where=length > 0)
    # rank of the neighbour's home among the cells of the probe: those with a smaller sum of distances come first. A link is found
    # where either end visits the other's home, so the better of the two ranks counts
    order = np.minimum(index.ranks(probes, index.home(other)), index.ranks(other, index.home(probes)))
    # a share of so many probes is uncertain: two standard errors more than wanted
    sure = min(1.0, recall + 2 * np.sqrt(recall * (1 - recall) / len(order)))
    visits = int(np.quantile(order, sure, method="higher"))
    return MultiIndex(left, right, max(1, min(visits, len(left) * len(right))))


def unit_rows(values: np.ndarray) -> np.ndarray:
    m = values.astype(np.float64)
    m /= np.abs(m).max(1)[:, None]  # so that squares neither vanish nor overflow
    return m / np.linalg.norm(m, axis=1)[:, None]


def rows_of(column: pa.Array, kind: str) -> np.ndarray:
    """The vectors of a binary column, all of one length, without a copy."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].view(kind).reshape(len(column), -1)


DIGEST = "id long, high long, low long, size int"


def _digest(kind: str, with_vectors: bool):
    """Digest and length of each usable vector: not null, not empty, only finite components, not all zero. Others have a null length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            at = column.offsets.to_numpy().astype(np.int64)
            at, values = at - at[0], column.values[int(at[0]) : int(at[-1])]
            values = values.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(kind) + np.zeros(1, kind)  # -0.0 is 0.0
            sizes = np.diff(at)
            count = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[at])
            good = column.is_valid().to_numpy(zero_copy_only=False) & (count(~np.isfinite(values)) == 0) & (count(values != 0) > 0)
            held = np.flatnonzero(good)
            cut = [values[at[i] : at[i + 1]].tobytes() for i in held]
            digests = np.zeros((len(batch), 2), np.int64)
            digests[held] = np.frombuffer(b"".join(blake2b(x, digest_size=16).digest() for x in cut), np.int64).reshape(-1, 2)
            found = {"id": batch.column("vec_id"), "high": pa.array(digests[:, 0]), "low": pa.array(digests[:, 1]), "size": pa.array(sizes.astype(np.int32), mask=~good)}
            if with_vectors:
                found = {k: v.take(pa.array(held)) for k, v in found.items()} | {"vector": pa.array(cut, pa.binary())}
            yield pa.RecordBatch.from_pydict(found)

    return run


PLACED = "high long, low long, size int, id long, n long, vector binary, home long, reach double, region int, regions binary"


def _place(index: MultiIndex, regions: Regions, kind: str):
    """The home of each vector, its reach, the region of its home and a bit for each region that it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_cells = regions.of_cells(index)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                a, b = index.parts(unit_rows(rows_of(part.column("vector"), kind)))
                home = a.argmin(1).astype(np.int64) * len(index.right) + b.argmin(1)
                reach = index.reaches(a, b)
                bits = np.packbits(regions.visited(a, b, reach), axis=1, bitorder="little")
                found = {name: part.column(name) for name in ("high", "low", "size", "id", "n", "vector")}
                found |= {"home": pa.array(home), "reach": pa.array(reach), "region": pa.array(of_cells[home].astype(np.int32))}
                yield pa.RecordBatch.from_pydict(found | {"regions": pa.array([x.tobytes() for x in bits], pa.binary())})

    return give_back(run)


def _count(regions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        residents, visitors = np.zeros(regions, np.int64), np.zeros(regions, np.int64)
        for batch in batches:
            residents += np.bincount(batch.column("region").to_numpy(), minlength=regions)
            visitors += np.unpackbits(rows_of(batch.column("regions"), "u1"), axis=1, bitorder="little").sum(0, dtype=np.int64)[:regions]
        yield pa.RecordBatch.from_pydict({"region": pa.array(np.arange(regions)), "residents": pa.array(residents), "visitors": pa.array(visitors)})

    return run


@dataclass(frozen=True)
class Share:
    """One of ``blocks`` blocks of a region's residents in a round: units from ``first`` on are it and one block of visitors each."""

    region: int
    blocks: int
    block: int
    visitors: int
    first: int = 0


def rounds_of(shares: list[tuple[Share, int]], most: int) -> list[list[Share]]:
    """Shares, with the bytes that they deal out, in rounds of ``most`` bytes or one share."""
    out, held, first = [], most, 0
    for share, n_bytes in shares:
        if held + n_bytes > most:
            out.append([])
            held = first = 0
        out[-1].append(replace(share, first=first))
        held += n_bytes
        first += share.visitors
    return out


HEAD = 32  # bytes of a packed vector besides itself: id, n, home, reach


def _deal(shares: list[Share], kind: str):
    """Residents and visitors of the regions of a round, packed for each unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            vectors, region = rows_of(batch.column("vector"), kind), batch.column("region").to_numpy()
            heads = [np.ascontiguousarray(batch.column(name).to_numpy()) for name in ("id", "n", "home", "reach")]
            bits = rows_of(batch.column("regions"), "u1")
            dealt = mix(heads[0].view(U64))
            step = max(1, PIECE_BYTES // (HEAD + vectors.itemsize * vectors.shape[1]))
            units, visit, packs, held = [], [], [], 0

            def out() -> pa.RecordBatch:
                return pa.RecordBatch.from_pydict({"unit": pa.array(units, pa.int32()), "visit": pa.array(visit, pa.bool_()), "pack": pa.array(packs, pa.binary())})  # noqa: B023

            for share in shares:
                come = np.flatnonzero(bits[:, share.region >> 3] >> (share.region & 7) & 1)
                stay = np.flatnonzero(region == share.region)
                stay = stay[(dealt[stay] >> U64(32)) % U64(share.blocks) == share.block]
                block = dealt[come] % U64(share.visitors)
                every = range(share.first, share.first + share.visitors)
                parts = [([unit], True, come[block == k] if share.visitors > 1 else come) for k, unit in enumerate(every)]
                for to, comes, rows in [*parts, (every, False, stay)]:
                    for at in range(0, len(rows), step):
                        packed = b"".join([x.take(rows[at : at + step], axis=0).tobytes() for x in (*heads, vectors)])
                        for unit in to:
                            units.append(unit)
                            visit.append(comes)
                            packs.append(packed)
                            held += len(packed)
                            if held > 4 << 20:
                                yield out()
                                units, visit, packs, held = [], [], [], 0
            if units:
                yield out()

    return run


class Packed:
    """Vectors of some packs, which are used up, so that hardly more than one copy is held."""

    def __init__(self, packs: list[bytes], size: int, kind: str):
        width = HEAD + size * np.dtype(kind).itemsize
        rows = sum(map(len, packs)) // width
        self.ids, self.n, self.home = (np.empty(rows, np.int64) for _ in range(3))
        self.reach, self.vectors = np.empty(rows), np.empty((rows, size), kind)
        while packs:
            pack = packs.pop()
            n = len(pack) // width
            rows -= n
            for k, x in enumerate((self.ids, self.n, self.home, self.reach)):
                x[rows : rows + n] = np.frombuffer(pack, x.dtype, n, 8 * n * k)
            self.vectors[rows : rows + n] = np.frombuffer(pack, kind, n * size, HEAD * n).reshape(n, size)

    def unit(self, rows: np.ndarray | slice) -> np.ndarray:
        return unit_rows(self.vectors[rows])


def places(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of what is true; faster than nonzero, which goes through all places of a matrix."""
    return np.divmod(np.flatnonzero(flags), max(1, flags.shape[1]))


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a row and a column that connect all that ``linked`` connects, hardly more of them than rows and columns."""
    if np.count_nonzero(linked) <= sum(linked.shape):
        return np.nonzero(linked)
    top, rows, columns = np.arange(linked.shape[1]), [], []
    for i in np.flatnonzero(linked.any(1)):
        tops = top[linked[i]]
        first = tops[0]
        rows.append(i)
        columns.append(first)
        for other in np.unique(tops[tops != first]):
            rows.append(i)
            columns.append(other)
            top[top == other] = first
    return np.array(rows), np.array(columns)


class Unit:
    """A block of a region's residents, which visitors of the region stream past."""

    def __init__(self, index: MultiIndex, left: np.ndarray, right: np.ndarray, residents: Packed, cosine: float, block: int):
        self.index, self.left, self.right, self.cosine, self.block = index, left, right, cosine, block
        place = np.full(len(index.left), -1), np.full(len(index.right), -1)
        place[0][left], place[1][right] = np.arange(len(left)), np.arange(len(right))
        cell = place[0][residents.home // len(index.right)] * len(right) + place[1][residents.home % len(index.right)]
        self.here, self.order = residents, cell.argsort(kind="stable").astype(np.int32)
        self.starts = np.searchsorted(cell[self.order], np.arange(len(left) * len(right) + 1))
        self.credit = np.zeros(len(cell))
        self.peak, self.scale = np.empty(len(cell)), np.empty(len(cell))  # a vector by both is one of unit length
        for at in range(0, len(cell), 4096):
            values = residents.vectors[at : at + 4096].astype(np.float64)
            self.peak[at : at + 4096] = np.abs(values).max(1)
            self.scale[at : at + 4096] = 1 / np.linalg.norm(values / self.peak[at : at + 4096, None], axis=1)
        # what a product of single precision can be off, twice
        self.margin = 2 * (residents.vectors.shape[1] + 8) * 2.0**-24

    def visits(self, come: Packed) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the visitors and the cells with residents that they visit, in the order of the cells, some visitors at a time."""
        cut, wide, who, cells, held = self.index.left.shape[1], len(self.right), [], [], 0

        def ordered() -> tuple[np.ndarray, np.ndarray]:
            cell = np.concatenate(cells)
            order = cell.argsort(kind="stable")
            return np.concatenate(who)[order], cell[order]

        for at in range(0, len(come.ids), 1024):
            unit, reach = unit_rows(come.vectors[at : at + 1024]), come.reach[at : at + 1024]
            a, b = half_distances(unit[:, :cut], self.index.left[self.left]), half_distances(unit[:, cut:], self.index.right[self.right])
            v, i = places(a <= (reach - b.min(1))[:, None])
            step = max(1, PAIRS // 2 // wide)
            for k in range(0, len(v), step):
                own, rest = v[k : k + step], i[k : k + step]
                pair, j = places(b.take(own, axis=0) <= (reach[own] - a[own, rest])[:, None])
                cell = rest[pair] * wide + j
                lived = self.starts[cell] < self.starts[cell + 1]
                who.append((own[pair[lived]] + at).astype(np.int32))
                cells.append(cell[lived].astype(np.uint16 if len(self.starts) <= 1 << 16 else np.int64))
                held += len(who[-1])
                if held > PAIRS:
                    yield ordered()
                    who, cells, held = [], [], 0
        if held:
            yield ordered()

    def compare(self, come: Packed) -> pa.RecordBatch:
        """Counts of the visitors, and links; the counts of the residents are kept until all visitors have come."""
        found, edges, pairs, held = np.zeros(len(come.ids)), [], [], 0
        unit = np.concatenate([come.unit(slice(at, at + 4096)).astype(np.float32) for at in range(0, len(found), 4096)])
        low = np.float32(self.cosine - self.margin)
        for who, cells in self.visits(come):
            at = 0
            for end in np.append(np.flatnonzero(np.diff(cells)) + 1, len(cells)).tolist():
                first, last = self.starts[int(cells[at]) : int(cells[at]) + 2].tolist()
                for r in range(first, last, self.block):
                    residents = self.order[r : min(r + self.block, last)]
                    there = (self.here.vectors.take(residents, axis=0) / self.peak[residents, None] * self.scale[residents, None]).astype(np.float32).T
                    for v in range(at, end, self.block):
                        visitors = who[v : min(v + self.block, end)]
                        near = unit.take(visitors, axis=0) @ there  # take is faster than an index
                        if near.max() < low:
                            continue
                        i, j = places(near >= low)
                        if len(i) > 4 * sum(near.shape):
                            edges.append(self._many(near, come, visitors, residents, found))
                            continue
                        pairs.append((visitors[i], residents[j], near[i, j]))
                        held += len(i)
                        if held > PAIRS // 32:
                            edges.append(self._few(pairs, come, found))
                            pairs, held = [], 0
                at = end
        if pairs:
            edges.append(self._few(pairs, come, found))
        one, two = (np.concatenate([e[k] for e in edges] or [np.empty(0, np.int64)]) for k in (0, 1))
        met = np.flatnonzero(found)
        links = np.concatenate([found[met].astype(np.int64), np.zeros(len(one), np.int64)])
        other = pa.array(np.concatenate([np.zeros(len(met), np.int64), two]), mask=np.arange(len(links)) < len(met))
        return pa.RecordBatch.from_pydict({"id": pa.array(np.concatenate([come.ids[met], one])), "links": pa.array(links), "other": other})

    def _exact(self, come: Packed, visitors: np.ndarray, residents: np.ndarray) -> np.ndarray:
        parts = [slice(at, at + 4096) for at in range(0, len(visitors), 4096)]
        return np.concatenate([np.einsum("ij,ij->i", come.unit(visitors[k]), self.here.unit(residents[k])) for k in parts] or [np.empty(0)]) >= self.cosine

    def _few(self, pairs: list, come: Packed, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Adds links to the counts of both ends and gives back ends of links that connect the same."""
        here, index = self.here, self.index
        visitors, residents, near = (np.concatenate(x) for x in zip(*pairs, strict=True))
        sure = near >= np.float32(self.cosine + self.margin)
        sure[~sure] = self._exact(come, visitors[~sure], residents[~sure])
        sure &= come.ids[visitors] != here.ids[residents]
        visitors, residents = visitors[sure], residents[sure]
        np.add.at(found, visitors, here.n[residents])
        # a resident is credited here unless it visits the home of the visitor, where the pair is met again
        cut, goes = index.left.shape[1], np.empty(len(visitors), bool)
        for at in range(0, len(visitors), 4096):
            k = slice(at, at + 4096)
            unit, home = here.unit(residents[k]), come.home[visitors[k]]
            away = paired_distances(unit[:, :cut], index.left[home // len(index.right)]) + paired_distances(unit[:, cut:], index.right[home % len(index.right)])
            goes[k] = away <= here.reach[residents[k]]
        np.add.at(self.credit, residents[~goes], come.n[visitors[~goes]])
        one, two = come.ids[visitors], here.ids[residents]
        wanted = ~goes | (one > two)
        return one[wanted], two[wanted]

    def _many(self, near: np.ndarray, come: Packed, visitors: np.ndarray, residents: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for a block of which much is linked, with a spanning forest of the links."""
        here, index = self.here, self.index
        linked = near >= np.float32(self.cosine + self.margin)
        i, j = places((near >= np.float32(self.cosine - self.margin)) & ~linked)
        linked[i, j] = self._exact(come, visitors[i], residents[j])
        linked &= come.ids[visitors][:, None] != here.ids[residents][None, :]
        found[visitors] += linked @ here.n[residents].astype(np.float64)
        kinds, kind = np.unique(come.home[visitors], return_inverse=True)
        cut, unit = index.left.shape[1], here.unit(residents)
        away = half_distances(unit[:, :cut], index.left[kinds // len(index.right)]) + half_distances(unit[:, cut:], index.right[kinds % len(index.right)])
        goes = (away <= here.reach[residents][:, None]).T[kind]
        self.credit[residents] += come.n[visitors].astype(np.float64) @ (linked & ~goes)
        i, j = forest(linked & (~goes | (come.ids[visitors][:, None] > here.ids[residents][None, :])))
        return come.ids[visitors[i]], here.ids[residents[j]]

    def credits(self) -> pa.RecordBatch:
        met = np.flatnonzero(self.credit)
        return pa.RecordBatch.from_pydict({"id": pa.array(self.here.ids[met]), "links": pa.array(self.credit[met].astype(np.int64)), "other": pa.nulls(len(met), pa.int64())})


LINKS = "id long, links long, other long"


def _compare(index: MultiIndex, regions: Regions, shares: list[Share], cosine: float, kind: str, size: int):
    """Counts to be added up, and links of a spanning forest where other is not null. Units come one after another, residents first."""
    sides = BLOCK, CHUNK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, chunk = sides
        firsts = np.array([share.first for share in shares])
        current, unit, residents, packs, held = None, None, [], [], 0

        def start() -> Unit:
            g, h = divmod(shares[int(firsts.searchsorted(current, "right")) - 1].region, len(regions.right))
            return Unit(index, regions.left[g], regions.right[h], Packed(residents, size, kind), cosine, block)

        def finish() -> Iterator[pa.RecordBatch]:
            if unit is not None:
                if packs:
                    yield unit.compare(Packed(packs, size, kind))
                yield unit.credits()

        for batch in batches:
            for number, visit, pack in zip(batch.column("unit").to_pylist(), batch.column("visit").to_pylist(), batch.column("pack"), strict=True):
                if number != current:
                    yield from finish()
                    current, unit, residents, packs, held = number, None, [], [], 0
                if not visit:
                    residents.append(pack.as_py())
                elif residents or unit is not None:  # without residents there is nothing to find
                    if unit is None:
                        unit, residents = start(), []
                    packs.append(pack.as_py())
                    held += len(packs[-1])
                    if held >= chunk:
                        yield unit.compare(Packed(packs, size, kind))
                        packs, held = [], 0
        yield from finish()

    return give_back(run)


def near_duplicate_vectors(vectors: DataFrame, cosine: float = 0.9, recall: float = TARGET_RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding).

    n_links counts the other vectors at ``cosine`` or more, component_id is the smallest vec_id that links reach. Null, empty and
    zero vectors and those with null or non-finite components link with nothing; so do rows without vec_id, whose component is
    null. Vectors of different lengths are never linked. Rows that share a vec_id are counted as rows and are one member. Other
    columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    single = vectors.schema["embedding"].dataType.elementType.typeName() == "float"
    kind, element = ("f4", "float") if single else ("f8", "double")
    rows = vectors.select("vec_id", F.col("embedding").cast(f"array<{element}>").alias("embedding"))
    with settings(spark, SETTINGS):
        digested = rows.where("vec_id is not null").mapInArrow(_digest(kind, True), f"{DIGEST}, vector binary")
        classes = digested.groupBy("high", "low", "size").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.first("vector").alias("vector"))
        classes = write_and_read(classes, "vectors")
        sizes = classes.groupBy("size").agg(F.count("*").alias("n")).collect()  # one row per length of vectors
        fitted = []
        for size, n in sorted((r["size"], r["n"]) for r in sizes):
            own = classes.where(F.col("size") == size)
            sample = draw(own, sample_size(n), "id").select("vector").toArrow()
            index = fit_index(unit_rows(rows_of(sample.column("vector").combine_chunks(), kind)), n, cosine, recall)
            regions = fit_regions(index, n * size * np.dtype(kind).itemsize)
            part = own.select("high", "low", "size", "id", "n", "vector").mapInArrow(_place(index, regions, kind), PLACED)
            fitted.append((write_and_read(part, "placed"), index, regions, size, n))
        drop_stored(classes)
        if fitted:
            placed = reduce(DataFrame.union, [part for part, *_ in fitted])
            found = reduce(DataFrame.union, [_links(part, index, regions, cosine, kind, size, n) for part, index, regions, size, n in fitted])
        else:
            placed, found = spark.createDataFrame([], PLACED), spark.createDataFrame([], LINKS)
        joined = components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
        counts = found.groupBy("id").agg(F.sum("links").alias("links"))
        judged = placed.select("high", "low", "size", "id", "n").join(counts, "id", "left").join(joined, "id", "left")
        judged = judged.select("high", "low", "size", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "id").alias("component"))
        # stored, so that the join below can split the rows of a vector with very many copies
        judged = write_and_read(judged, "judged")
        drop_stored(placed, found)
    every = rows.mapInArrow(_digest(kind, False), DIGEST).withColumnRenamed("id", "vec_id")
    every = every.withColumn("size", F.when(F.col("vec_id").isNotNull(), F.col("size")))
    result = every.join(judged, ["high", "low", "size"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    result = result.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"))
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _links(placed: DataFrame, index: MultiIndex, regions: Regions, cosine: float, kind: str, size: int, classes: int) -> DataFrame:
    """(id, links, other): counts to be added up, and links of a spanning forest where other is not null."""
    spark = placed.sparkSession
    n_regions, width = len(regions.left) * len(regions.right), HEAD + size * np.dtype(kind).itemsize
    counts = placed.select("region", "regions").mapInArrow(_count(n_regions), "region long, residents long, visitors long")
    counts = counts.groupBy("region").agg(F.sum("residents").alias("residents"), F.sum("visitors").alias("visitors")).collect()  # a row per region
    a_round = max(ROUND_BYTES, int(ROUND_SHARE * classes * width))
    most = int(np.clip(min(a_round, sum(r.visitors for r in counts) * width) // UNITS, *VISITOR_BYTES))
    shares = []
    for r in sorted(counts):
        blocks, visitors = -(-r.residents * width // RESIDENT_BYTES), -(-r.visitors * width // most)
        shares += [(Share(r.region, blocks, k, visitors), width * (r.visitors + r.residents * visitors // blocks)) for k in range(blocks)]
    stored = []
    for own in rounds_of(shares, a_round):
        dealt = placed.select("id", "n", "vector", "home", "reach", "region", "regions").mapInArrow(_deal(own, kind), "unit int, visit boolean, pack binary")
        dealt = dealt.repartitionById(max(2, own[-1].first + own[-1].visitors), "unit").sortWithinPartitions("unit", "visit")
        stored.append(write_and_read(dealt.mapInArrow(_compare(index, regions, own, cosine, kind, size), LINKS), "links"))
    return reduce(DataFrame.union, stored)
