"""Hard negatives by segment summaries.

Components are whole numbers. A vector is cut into segments; of each one its mean and its deviation are kept. The inner product over
a segment of d components lies within ``d * (mean * mean' ± deviation * deviation')``, so the sums over the segments bound a score.
Pairs whose bounds leave them a chance are refined with shorter segments, level by level (``LEVELS``); scores of what is left are
exact.

Anchors are stored in blocks that all tasks read one by one; each task holds its own rows and compares them with every block, so rows
are not shuffled and a task hands on at most as many partners as asked for, for each anchor. The first pass finds the positives, the
second the negatives below and near each positive's score.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmlake.llm import files
from firmlake.llm.common import give_back
from firmlake.session import write_and_read

SCALE = 256  # component x becomes floor(SCALE * x)
LEVELS = (4, 16)  # segments of a vector, level by level; a vector with fewer components stops earlier
ROWS_PER_TASK = 8192
ANCHORS_PER_BLOCK = 512
PAIRS_AT_ONCE = 1 << 16
EXACT = 1 << 53  # sums below it are exact in doubles
LARGEST = 1e150  # of a scaled component: its square is a double
LONG = np.iinfo(np.int64)


class Vectors:
    """Vectors of one length with the summaries of all levels."""

    def __init__(self, values: np.ndarray):
        self.values, self.largest = values, float(np.abs(values).max(initial=0.0))
        n, width = values.shape
        self.levels = []
        for count in LEVELS:
            if count < width:
                edges = np.linspace(0, width, count + 1).astype(np.int64)[:-1]
                sizes = np.diff(np.append(edges, width)).astype(np.float64)
                sums = np.add.reduceat(values, edges, axis=1)
                spread = np.maximum(np.add.reduceat(values * values, edges, axis=1) - sums * sums / sizes, 0.0)
                # mean * sqrt(d) and deviation * sqrt(d), so that plain products give d * mean * mean'
                self.levels.append((sums / np.sqrt(sizes), np.sqrt(spread)))

    def bounds(self, level: int, other: "Vectors", mine: np.ndarray, its: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of the score of each pair (mine, its), widened by what rounding can lose."""
        (mean, deviation), (mean_2, deviation_2) = self.levels[level], other.levels[level]
        middle = np.einsum("ij,ij->i", mean[mine], mean_2[its])
        reach = np.einsum("ij,ij->i", deviation[mine], deviation_2[its])
        slack = 1e-9 * (np.abs(middle) + reach + self.largest * other.largest * self.values.shape[1]) + 0.5
        ends = float(LONG.min), float(LONG.max)
        return np.clip(middle - reach - slack, *ends), np.clip(middle + reach + slack, *ends)

    def scores(self, other: "Vectors", mine: np.ndarray, its: np.ndarray) -> np.ndarray:
        """Exact inner products; those beyond 64 bits become the nearest long."""
        if self.largest * other.largest * self.values.shape[1] < EXACT:
            return np.einsum("ij,ij->i", self.values[mine], other.values[its]).astype(np.int64)
        whole = lambda v: [int(x) for x in v]
        pairs = zip(self.values[mine].tolist(), other.values[its].tolist(), strict=True)
        exact = (sum(a * b for a, b in zip(whole(x), whole(y), strict=True)) for x, y in pairs)
        return np.array([min(max(s, LONG.min), LONG.max) for s in exact], np.int64)


def vectors_of(column: pa.Array, width: int) -> Vectors:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = np.asarray(flat.flatten(), np.float64).reshape(-1, width)
    return Vectors(values)


def _kth_highest(values: np.ndarray, owner: np.ndarray, owners: int, k: int) -> np.ndarray:
    """For each owner the k-th highest of its values, -inf where it has fewer."""
    order = np.lexsort((-values, owner))
    starts = np.searchsorted(owner[order], np.arange(owners))
    at = starts + k - 1
    ends = np.append(starts[1:], len(order))
    out = np.full(owners, -np.inf)
    has = at < ends
    out[has] = values[order][at[has]]
    return out


def _first(owner: np.ndarray, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each owner: higher scores first, then smaller vec_id, then row."""
    order = np.lexsort((row, vec_id, -score, owner))
    mine = owner[order]
    rank = np.arange(len(order)) - np.searchsorted(mine, mine)
    return order[rank < k]


class Rows:
    def __init__(self, table: pa.Table, width: int):
        self.row, self.id, self.label = (table.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        self.vectors = vectors_of(table.column("vector"), width)


def _refine(anchors: Rows, rows: Rows, a: np.ndarray, r: np.ndarray, keep: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that ``keep`` (anchors' places, lower, upper) leaves at every level, with their exact scores."""
    for level in range(len(anchors.vectors.levels)):
        left = keep(a, *anchors.vectors.bounds(level, rows.vectors, a, r))
        a, r = a[left], r[left]
    return a, r, anchors.vectors.scores(rows.vectors, a, r)


def _positives(anchors: Rows, rows: Rows, k: int) -> dict[str, np.ndarray]:
    """Each anchor's first k rows of its label, itself left out."""
    same = (anchors.label[:, None] == rows.label[None, :]) & (anchors.row[:, None] != rows.row[None, :])
    a, r = np.nonzero(same)

    def keep(at, lower, upper):
        return upper >= _kth_highest(lower, at, len(anchors.row), k)[at]

    a, r, score = _refine(anchors, rows, a, r, keep)
    top = _first(a, score, rows.id[r], rows.row[r], k)
    a, r = a[top], r[top]
    return {"anchor_row": anchors.row[a], "anchor_id": anchors.id[a], "anchor_label": anchors.label[a], "row": rows.row[r], "vec_id": rows.id[r], "score": score[top]}


class Wanted:
    """Positives of a block's anchors and the scores that their negatives may have."""

    def __init__(self, anchors: Rows, table: pa.Table, percent: int):
        place = {int(x): i for i, x in enumerate(anchors.row)}
        self.anchor = np.array([place[x] for x in table.column("anchor_row").to_pylist()], np.int64)
        self.row, self.id, self.high = (table.column(c).to_numpy() for c in ("row", "vec_id", "score"))
        low = [-(-percent * int(x) // 100) for x in self.high]  # 100 * score >= percent * positive
        self.low = np.array([min(max(x, LONG.min), LONG.max) for x in low], np.int64)
        # what may serve any positive of an anchor
        self.least = np.full(len(anchors.row), np.inf)
        self.most = np.full(len(anchors.row), -np.inf)
        fits = self.low <= self.high
        np.minimum.at(self.least, self.anchor[fits], self.low[fits].astype(np.float64))
        np.maximum.at(self.most, self.anchor[fits], self.high[fits].astype(np.float64))


def _negatives(anchors: Rows, rows: Rows, wanted: Wanted, k: int) -> dict[str, np.ndarray]:
    """For each positive its first k rows of other labels within its range."""
    a, r = np.nonzero((anchors.label[:, None] != rows.label[None, :]) & np.isfinite(wanted.least)[:, None])
    wide = 1 + 1e-9 * np.maximum(np.abs(wanted.least), np.abs(wanted.most))
    least, most = wanted.least - np.where(np.isfinite(wide), wide, 0), wanted.most + np.where(np.isfinite(wide), wide, 0)

    def keep(at, lower, upper):
        return (upper >= least[at]) & (lower <= most[at])

    a, r, score = _refine(anchors, rows, a, r, keep)
    order = np.argsort(a, kind="stable")
    a, r, score = a[order], r[order], score[order]
    starts, ends = np.searchsorted(a, wanted.anchor), np.searchsorted(a, wanted.anchor, side="right")
    n = ends - starts
    p = np.repeat(np.arange(len(wanted.anchor)), n)
    at = np.arange(n.sum()) + np.repeat(starts - np.cumsum(n) + n, n)
    fits = (score[at] >= wanted.low[p]) & (score[at] <= wanted.high[p])
    p, at = p[fits], at[fits]
    top = _first(p, score[at], rows.id[r[at]], rows.row[r[at]], k)
    p, at = p[top], at[top]
    return {
        "anchor_row": anchors.row[a[at]], "anchor_id": anchors.id[a[at]], "positive_row": wanted.row[p], "positive_id": wanted.id[p],
        "row": rows.row[r[at]], "vec_id": rows.id[r[at]], "positive_score": wanted.high[p], "score": score[at],
    }


def _merged(parts: list[dict[str, np.ndarray]], owners: tuple[str, ...], k: int) -> pa.RecordBatch | None:
    """The first k of each owner among the parts."""
    parts = [p for p in parts if len(p["row"])]
    if not parts:
        return None
    every = {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}
    _, owner = np.unique(np.stack([every[c] for c in owners], 1), axis=0, return_inverse=True)
    top = _first(owner.reshape(-1), every["score"], every["vec_id"], every["row"], k)
    return pa.RecordBatch.from_pydict({name: pa.array(v[top].astype(np.int64, copy=False)) for name, v in every.items()})


def _read(uri: str) -> pa.Table:
    return pa.ipc.open_file(pa.BufferReader(files.read_bytes(uri))).read_all()


def _compare(blocks: list[str], width: int, k: int, percent: int | None):
    """A task's rows against all blocks of anchors; ``blocks`` are files, read one at a time."""
    owners = ("anchor_row",) if percent is None else ("anchor_row", "positive_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = Rows(pa.Table.from_batches(held), width)
        for uri in blocks:
            table = _read(uri)
            found = []
            step = max(1, PAIRS_AT_ONCE // len(rows.row))
            anchors_only = table.select(["row", "vec_id", "label", "vector"])
            for at in range(0, table.num_rows, step):
                anchors = Rows(anchors_only.slice(at, step), width)
                if percent is None:
                    found.append(_positives(anchors, rows, k))
                else:
                    listed = pa.concat_tables([pa.Table.from_pylist(x or [], POSITIVE) for x in table.slice(at, step).column("positives").to_pylist()])
                    found.append(_negatives(anchors, rows, Wanted(anchors, listed, percent), k))
            out = _merged(found, owners, k)
            if out is not None:
                yield out

    return give_back(run)


POSITIVE = pa.schema([("anchor_row", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _store(folder: str):
    def run(key, table: pa.Table) -> pa.Table:
        out = files.Written(folder, f"block-{uuid.uuid4().hex}")
        sink = pa.BufferOutputStream()
        with pa.ipc.new_file(sink, table.schema) as writer:
            writer.write_table(table)
        out.write(sink.getvalue().to_pybytes())
        return pa.table({"file": [out.close()]})

    return run


def _stored(anchors: DataFrame, name: str) -> list[str]:
    """Names of the files that hold ``anchors`` in blocks of about ``ANCHORS_PER_BLOCK``."""
    blocks = max(1, -(-anchors.count() // ANCHORS_PER_BLOCK))
    folder = files.shared_folder(anchors.sparkSession, name)
    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    written = dealt.groupBy("block").applyInArrow(lambda key, table: _store(folder)(key, table.drop_columns(["block"])), "file string")
    return sorted(r["file"] for r in write_and_read(written, "anchor-files").collect())  # one name per block


def usable(label: str, vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(label).isNotNull() & F.col(vector).isNotNull() & finite, F.lit(False))


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, percent: int = 80) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors of ``vectors`` (vec_id, embedding, label).

    Anchors are rows whose vec_id is divisible by ``every``. Positives are an anchor's first ``positives`` other rows of its label,
    negatives of a positive the first ``negatives`` rows of other labels with percent * positive <= 100 * score <= 100 * positive;
    higher scores come first, then smaller vec_ids.

    Rows without vec_id, label or vector and those with a null or non-finite component take no part; vectors of different lengths
    never meet, empty ones score 0. Rows that share a vec_id count one by one, so a repeated anchor gives repeated rows and may be
    its own copy's positive. A score beyond 64 bits becomes the nearest long;
    scaled components stop at 1e150. Other columns are ignored; an empty table or one
    without anchors gives an empty result.
    """
    spark = vectors.sparkSession
    good = vectors.where(F.col("vec_id").isNotNull() & usable("label", "embedding"))
    scaled = F.transform("embedding", lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), x.cast("double") * float(SCALE))))
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < float(EXACT), F.floor(x).cast("double")).otherwise(x))  # larger doubles are whole
    kept = good.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("vector"))
    rows = write_and_read(kept.withColumn("row", F.monotonically_increasing_id()), "vectors")
    found = None
    sizes = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n")).collect()  # one row per length of vectors
    for width, n in sorted(map(tuple, sizes)):
        part = _mine(rows.where(F.size("vector") == width), width, n, every, positives, negatives, percent)
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return found


def _first_of(found: DataFrame, owners: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*owners).orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _mine(rows: DataFrame, width: int, n: int, every: int, positives: int, negatives: int, percent: int) -> DataFrame:
    if width == 0:
        rows = rows.withColumn("vector", F.array(F.lit(0.0)))
        width = 1
    anchors = rows.where(F.col("vec_id") % every == 0).select("row", "vec_id", "label", "vector")
    dealt = rows.repartition(max(1, -(-n // ROWS_PER_TASK)))
    first = _compare(_stored(anchors, "anchors"), width, positives, None)
    names = "anchor_row long, anchor_id long, anchor_label long, row long, vec_id long, score long"
    best = write_and_read(_first_of(dealt.mapInArrow(first, names), ["anchor_row"], positives), "positives")
    listed = best.groupBy("anchor_row").agg(F.collect_list(F.struct("anchor_row", "row", "vec_id", "score")).alias("positives"))  # a few each
    with_positives = anchors.join(listed.withColumnRenamed("anchor_row", "row"), "row")
    second = _compare(_stored(with_positives, "anchors"), width, negatives, percent)
    names = "anchor_row long, anchor_id long, positive_row long, positive_id long, row long, vec_id long, positive_score long, score long"
    ranked = _first_of(dealt.mapInArrow(second, names), ["anchor_row", "positive_row"], negatives)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
