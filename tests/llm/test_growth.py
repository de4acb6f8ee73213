"""Steps whose shuffles or time once grew faster than the input."""

import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from firmlake.llm import contextmix, minhash, mixing, multiindex


@pytest.fixture
def no_small_tables(spark):
    """Every table counts as too large to be sent to all tasks, unless the code asks for it."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_mixed_shuffles_no_rows(spark, monkeypatch, no_small_tables):
    rows = [(i, f"w {i} " * (i % 40), f"s{i % 4}" if i % 5 else None) for i in range(900)]
    rows += [(1, "a b c", "s0")] * 70 + [(None, "a b", "s1")] * 30 + [(2000, None, "s2"), (2001, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    source = spark.createDataFrame(docs.collect(), docs.schema)  # read alike by all runs
    want = Counter()
    for r in mixing.mix(source, group=16).select("row.doc_id", "row.text", "row.source", "copies").collect():
        want[r.doc_id, r.text, r.source] += r.copies
    assert set(want.values()) - {0, 1, 2, 3}  # repeated rows, too
    found = mixing.mixed(source, group=16)
    assert "Exchange hashpartitioning" not in plan_of(found) and "SortMergeJoin" not in plan_of(found)
    assert Counter(map(tuple, found.collect())) == +want
    monkeypatch.setattr(mixing, "BITMAP_BYTES", -1)
    assert Counter(map(tuple, mixing.mixed(source, group=16).collect())) == +want


def test_bitmaps_hold_the_copies_of_each_row(spark):
    copies = {i: zlib.crc32(b"%d" % i) % 4 for i in [0, 1, 7, 8, 32767, 32768, 32769, 65535, 1 << 33, (1 << 33) + 32767, (5 << 33) + 40000]}
    uids = spark.createDataFrame(list(copies.items()), "uid long, copies int")
    every = uids.withColumn("block", mixing.F.shiftright("uid", mixing.BLOCK_BITS)).drop("copies")
    both = every.join(mixing._bitmaps(uids), "block", "left").selectExpr("uid", f"{mixing._bit('low')} + 2 * {mixing._bit('high')} AS copies")
    assert {r.uid: r.copies for r in both.collect()} == copies


def test_sets_are_shuffled_to_their_group_alone(spark, monkeypatch, no_small_tables):
    chance = random.Random(3)
    texts = [" ".join(chance.choices([f"w{i}" for i in range(400)], k=60)) for _ in range(40)]
    texts += [f"{t} more{i}" for i, t in enumerate(texts)] + texts[:5]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plans, keep = [], minhash.write_and_read

    def kept(df, name):
        plans.append((name, plan_of(df)))
        return keep(df, name)

    monkeypatch.setattr(minhash, "write_and_read", kept)
    result = {tuple(r) for r in minhash.near_duplicates(docs).collect()}
    assert {d: c for d, _, c, _ in result} == {i: i % 40 if i < 80 else i - 80 for i in range(85)}
    carrying = [p for name, p in plans if name in ("shingles", "links") and "shingles" in p]
    assert carrying and sum(p.count("Exchange hashpartitioning") for p in carrying) == 1
    monkeypatch.setattr(minhash, "SENT", 0)
    assert {tuple(r) for r in minhash.near_duplicates(docs).collect()} == result


def test_units_of_many_ranges_are_looked_up_together(spark, monkeypatch):
    """Rows come in an order unlike that of the bytes, so each batch holds units of all ranges."""
    chance = random.Random(2)
    units = list({bytes(chance.choices(b"abc\xc3", k=chance.randrange(6))) for _ in range(150)})
    n = {u: chance.randrange(4) for u in units}
    monkeypatch.setattr(contextmix, "RANGE", (3, 1 << 24))
    rows = contextmix.in_ranges(spark.createDataFrame([(bytearray(u), i, n[u]) for i, u in enumerate(units)], "unit binary, token long, n long"))
    others = contextmix.beyond([(r.part, contextmix.pickle.loads(r.ends)) for r in rows.where("ends is not null").collect()])
    assert len(others) == 2 and all(isinstance(x, np.ndarray) for side in others for x in side)
    coded = {u: "".join(f"{x:08b}" for x in u + b"\0") for u in units}
    table = rows.where("ends is null").drop("ends", "four").toArrow().take(pa.array(chance.sample(range(len(units)), len(units)))).combine_chunks()
    for batch in table.to_batches():
        some = batch.column("unit").to_pylist()
        seen, ones = contextmix.far_counts(batch, others, contextmix.decisions(some, contextmix.SLOTS)[2])
        begins = [coded[u][:i] for u in some for i in range(len(coded[u]))]
        assert seen.tolist() == [sum(n[u] for u in units if coded[u].startswith(b)) for b in begins]
        assert ones.tolist() == [sum(n[u] for u in units if coded[u].startswith(b + "1")) for b in begins]


def test_places_of_words_beyond_what_is_remembered(monkeypatch):
    monkeypatch.setattr(contextmix, "KNOWN_UNITS", 6)
    words = [b"w%d" % i for i in range(20)]
    keys = np.array([contextmix.token_key(w) for w in words[:9]], np.int64)
    places = contextmix.Places(keys)
    for start in (0, 7, 3, 14, 0):
        texts = [words[start : start + 4], [], words[start + 2 : start + 6]]
        at = places.of(texts).tolist()
        found = [keys[i] if i < len(keys) else places.cold[i - len(keys)] for i in at]
        assert found == [contextmix.token_key(w) for t in texts for w in t]
        assert len(places) <= 12


def test_decisions_are_counted_without_a_row_for_each(spark, monkeypatch):
    chance = random.Random(6)
    fours = [chance.randrange(1 << chance.choice([9, 16, 32])) for _ in range(3000)]
    four = spark.createDataFrame([(x,) for x in fours + fours[:500]], "four long")
    nodes = lambda mask: len({((x & mask) >> 8, (x & 255 | 256) >> k) for x in fours for k in range(1, 9)})
    assert contextmix.decided_nodes(four) == nodes(-1)
    assert contextmix.decided_nodes(four.limit(0)) == 0
    monkeypatch.setattr(contextmix, "SLOTS", (8, 16, 2, 2))
    assert contextmix.table_sizes(four) == (8, 16, *((4 * nodes(mask) - 1).bit_length() for mask in (0xFFFFFF, -1)))
    assert contextmix.table_sizes(four.limit(0)) == (8, 16, 2, 2)


def vectors_near_each_other(chance) -> np.ndarray:
    """Lone vectors, small groups around 0.9 and one large group of near copies."""
    lone = chance.normal(size=(300, 24))
    groups = np.repeat(chance.normal(size=(60, 24)), 5, axis=0) + chance.normal(size=(300, 24)) * 0.3
    return np.concatenate([lone, groups, chance.normal(size=24) + chance.normal(size=(200, 24)) * 0.05, lone[:40]]).astype(np.float32)


def linked_vectors(vectors: np.ndarray) -> dict:
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    least, before = np.arange(len(unit)), None
    while before is None or (least != before).any():
        before, least = least, np.minimum(least, np.where(linked, least[None, :], len(unit)).min(1))
    return {i: (int(linked[i].sum()), int(least[i]), bool(least[i] == i)) for i in range(len(unit))}


@pytest.mark.parametrize("element", ["float", "double"])
def test_vectors_are_compared_in_rounds_and_blocks(spark, monkeypatch, element):
    vectors = vectors_near_each_other(np.random.default_rng(4))
    want = linked_vectors(vectors)
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], f"vec_id long, embedding array<{element}>").repartition(3)
    rounds, keep = [], multiindex.write_and_read
    monkeypatch.setattr(multiindex, "write_and_read", lambda df, name: rounds.append(name) or keep(df, name))
    monkeypatch.setattr(multiindex, "TARGET_RECALL", 1.0)
    for resident, visitor, round_, block, chunk, pairs in ((96 << 20, (3 << 20, 4 << 20), 1 << 28, 2048, 1 << 20, 1 << 22), (20_000, (9_000, 9_000), 1, 16, 3_000, 512)):
        rounds.clear()
        for name, value in {"RESIDENT_BYTES": resident, "VISITOR_BYTES": visitor, "ROUND_BYTES": round_, "ROUND_SHARE": 0, "BLOCK": block, "CHUNK_BYTES": chunk, "PAIRS": pairs}.items():
            monkeypatch.setattr(multiindex, name, value)
        got = multiindex.near_duplicate_vectors(rows, recall=1.0).collect()
        assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == want
        assert rounds.count("links") > 4 if round_ == 1 else rounds.count("links") == 1


def test_shuffles_of_vectors_stay_small(spark, monkeypatch):
    """Vectors once went with all their visits to each visited cell, and the files stayed."""
    vectors = np.random.default_rng(5).normal(size=(3000, 64)).astype(np.float32)
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    began, most, keep = time.time() * 1000, [], multiindex.write_and_read

    def kept(df, name):
        stored = keep(df, name)
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        files = [files.apply(i) for i in range(files.size())]
        most.append(sum(f.length() for f in files if f.getName().startswith("shuffle_") and f.lastModified() >= began))
        return stored

    monkeypatch.setattr(multiindex, "write_and_read", kept)
    result = multiindex.near_duplicate_vectors(rows)
    assert max(most) <= 4 * vectors.nbytes
    assert result.where("n_links = 0 and kept").count() == len(vectors)


def test_reach_tells_the_cells_of_the_traversal():
    chance = np.random.default_rng(6)
    unit = multiindex.unit_rows(chance.normal(size=(40, 8)))
    index = multiindex.MultiIndex(chance.normal(size=(9, 4)), chance.normal(size=(7, 4)), 1)
    regions = multiindex.Regions([np.array([0, 2, 4, 8]), np.array([1, 3, 5, 6, 7])], [np.array([3, 4]), np.array([0, 1, 2]), np.array([5, 6])])
    of_cells = regions.of_cells(index)
    assert of_cells[0 * 7 + 0] == 1 and of_cells[8 * 7 + 3] == 0 and of_cells[7 * 7 + 6] == 5
    for visits in (1, 5, 20, 62, 63):
        index.visits = visits
        a, b = index.parts(unit)
        reach = index.reaches(a, b, spare=3)
        seen = regions.visited(a, b, reach)
        for i in range(len(unit)):
            first, second = a[i].argsort(), b[i].argsort()
            want = {(int(first[x]), int(second[y])) for x, y in multiindex.multi_sequence(a[i][first], b[i][second], visits)}
            assert {(int(x), int(y)) for x, y in zip(*np.nonzero(a[i][:, None] + b[i][None, :] <= reach[i]), strict=True)} == want
            assert set(np.flatnonzero(seen[i])) == {int(of_cells[x * 7 + y]) for x, y in want}


def test_reach_takes_all_cells_that_are_as_far_away():
    index = multiindex.MultiIndex(np.zeros((6, 1)), np.zeros((5, 1)), 3)
    a, b = np.array([[0.0, 1, 1, 1, 1, 9], [0.0, 0, 0, 0, 0, 0]]), np.array([[0.0, 0, 0, 0, 9], [0.0, 0, 0, 0, 0]])
    reach = index.reaches(a, b, spare=2)
    assert [(x[:, None] + y[None, :] <= r).sum() for x, y, r in zip(a, b, reach, strict=True)] == [4, 30]
