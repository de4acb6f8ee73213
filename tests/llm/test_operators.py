"""Every corpus operator on small hand-made tables, against brute force."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmlake.llm import containment, contextmix, dac, files, minhash, mixing, multiindex, repeats, reputation, toxicity, warc
from firmlake.llm.common import components, words_of
from firmlake.llm.queries import tokenizer_file

DOCS = "doc_id long, text string, source string, component_id string, size string, id int"


def document_frame(spark, rows):
    """Extra columns carry names that the operators use themselves."""
    return spark.createDataFrame([(d, t, s, "x", None, 7) for d, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def texts():
    chance = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(chance.choices(words, k=chance.choice([3, 40, 120, 400]))) for _ in range(25)]
    out = []
    for i, t in enumerate(base):
        out.append(t)
        parts = t.split(" ")
        for k in range(i % 4):
            changed = list(parts)
            changed[chance.randrange(len(changed))] = f"new{k}"
            out.append(" ".join(changed))
        if i % 5 == 0:
            out += [t, t.upper()]
    shared = "Ünder " + " ".join(chance.choices(words, k=130))
    out += [f"{chance.random()} {shared} {i}" for i in range(6)]
    return [None, "", " \n\t", "One", "one", "a b c", "x" * 1500, "ab" * 900, *out]


def brute_components(ids, linked):
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        if linked(a, b):
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {i: top(i) for i in ids}


def shingle_sets(texts, size):
    out = {}
    for i, t in texts:
        w = words_of(None if t is None else t.encode())
        out[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    return out


@pytest.mark.parametrize("block", [2, 256])
def test_near_duplicates(spark, texts, block):
    rows = list(enumerate(texts))
    sets = shingle_sets(rows, 4)
    want = brute_components(list(sets), lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    docs = document_frame(spark, [(i, t, "s") for i, t in rows] + [(None, texts[-1], None)])
    got = minhash.near_duplicates(docs, words=4, block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, False)]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, 101 + i) for i in range(50)] + [(7, 7), (None, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 10 for i in range(10, 41)}, **{i: 100 for i in range(100, 151)}}


def test_repeats(spark, texts):
    rows = list(enumerate(texts)) + [(None, texts[-1])]
    data = [(t or "").encode() for _, t in rows]
    windows = Counter(x[i : i + 400] for x in data for i in range(len(x) - 399))
    for gathered in (repeats.GATHERED, 1):  # compared in a task, and counted by Spark
        before, repeats.GATHERED = repeats.GATHERED, gathered
        got = repeats.remove_repeats(document_frame(spark, [(i, t, "s") for i, t in rows])).collect()
        repeats.GATHERED = before
        found = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got)
        want = Counter()
        for (i, _), x in zip(rows, data, strict=True):
            gone = bytearray(len(x))
            for k in range(len(x) - 399):
                if windows[x[k : k + 400]] > 1:
                    gone[k : k + 400] = b"\1" * 400
            want[i, len(x), sum(gone), sum(1 for run in bytes(gone).split(b"\0") if run), bytes(b for b, g in zip(x, gone, strict=True) if not g)] += 1
        assert found == want
    assert repeats.remove_repeats(document_frame(spark, [])).count() == 0


def test_maximal_repeats_name_all_occurrences():
    left, right = [b"cba", b"cbx", b"zzz"], [b"hello world", b"hello there", b"hello w"]
    found = {(before, depth, tuple(sorted(m))) for before, depth, m in repeats.maximal_repeats(left, right, 6)}
    assert found == {(0, 6, (0, 1, 2)), (2, 6, (0, 1)), (0, 7, (0, 2))}


def test_contained_items(spark, texts):
    long_text = " ".join(f"n{i}" for i in range(20_000))
    rows = [*enumerate(texts), (900, long_text + " " + texts[-1] + " end"), (None, texts[-2])]
    items = [(1, texts[-1]), (2, texts[20]), (3, "a b c"), (4, None), (5, " "), (None, texts[-2]), (7, " ".join(f"n{i}" for i in range(500, 540)))]
    docs = document_frame(spark, [(i, t, "s") for i, t in rows])
    got = Counter()
    table = spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (8 << 20, 100):  # one block, and one for each item
        found = containment.contained_items(docs, table, block_bytes=block_bytes).collect()
        got = Counter((r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in found)
        of_docs, of_items = shingle_sets(list(enumerate(t for _, t in rows)), 5), shingle_sets(list(enumerate(t for _, t in items)), 5)
        want = Counter()
        for a, b in itertools.product(range(len(rows)), range(len(items))):
            if of_items[b] and 100 * len(of_docs[a] & of_items[b]) >= 80 * len(of_items[b]):
                want[rows[a][0], items[b][0], len(of_items[b]), len(of_docs[a] & of_items[b])] += 1
        assert got == want
    assert containment.contained_items(docs, table.limit(0)).count() == 0


def test_vectors(spark):
    chance = np.random.default_rng(2)
    base = chance.normal(size=(40, 16))
    vectors = [v + chance.normal(size=16) * s for v in base for s in (0, 0, 0.05, 0.1, 0.2)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    rows += [(1000 + i, v) for i, v in enumerate(bad)] + [(2000, [1.0, 2.0]), (2001, [2.0, 4.0]), (None, rows[0][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("component", F.lit(1))
    unit = {}
    for i, v in rows:
        if i is not None and i not in range(1000, 1006):
            x = np.array(v, np.float32).astype(float)
            unit[i] = x / np.linalg.norm(x)
    link = lambda a, b: len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9
    want = brute_components(list(unit), link)
    n = {a: sum(a != b and link(a, b) for b in unit) for a in unit}
    for block in (512, 3):
        before, multiindex.BLOCK = multiindex.BLOCK, block
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in multiindex.near_duplicate_vectors(frame).collect()}
        multiindex.BLOCK = before
        assert got == {**{i: (n[i], want[i], want[i] == i) for i in unit}, **{1000 + i: (0, 1000 + i, True) for i in range(6)}, None: (0, None, False)}
    assert multiindex.near_duplicate_vectors(frame.limit(0)).count() == 0


def test_multi_sequence_visits_the_nearest_cells_first():
    chance = np.random.default_rng(1)
    a, b = np.sort(chance.random(9)), np.sort(chance.random(7))
    want = sorted((a[i] + b[j]) for i in range(9) for j in range(7))[:20]
    assert np.allclose([a[i] + b[j] for i, j in multiindex.multi_sequence(a, b, 20)], want)


def test_items_shorter_than_a_shingle_are_found_in_longer_texts(spark):
    texts = ["x y A b c z q", "a b", "a b c", "b c", "a x b c y w v u", "c", None, " ", "c a b c d"]
    items = [(1, "a B c"), (2, "c"), (3, "b c"), (4, "a b"), (None, "b c"), (6, "a b c d"), (7, "a x b c y")]
    docs, table = document_frame(spark, [(i, t, "s") for i, t in enumerate(texts)]), spark.createDataFrame(items, "item_id long, text string")
    want = Counter((d, i) for d, t in enumerate(texts) for i, item in items if f" {item.lower()} " in f" {(t or '').lower()} ")
    for block_bytes in (8 << 20, 1):
        found = containment.contained_items(docs, table, block_bytes=block_bytes).collect()
        assert Counter((r.doc_id, r.item_id) for r in found) == want and {(r.n_item_shingles, r.n_shared) for r in found} == {(1, 1)}


@pytest.mark.parametrize("k", [32, 64])
def test_visited_cells_reach_the_recall_on_vectors_not_fitted_on(k):
    chance = np.random.default_rng(k)
    unit = lambda x: x / np.linalg.norm(x, axis=1)[:, None]
    classes = k * k * multiindex.PER_CELL
    index = multiindex.fit_index(unit(chance.normal(size=(8192, 64))), classes, 0.9)
    one, turn = unit(chance.normal(size=(2000, 64))), chance.normal(size=(2000, 64))
    other = 0.9 * one + np.sqrt(1 - 0.9**2) * unit(turn - (turn * one).sum(1)[:, None] * one)
    ranks = np.minimum(index.ranks(one, index.home(other)), index.ranks(other, index.home(one)))
    assert (ranks <= index.visits).mean() >= 0.985


def test_mix(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 37)), f"s{i % 3}") for i in range(600)]
    rows += [(None, "a b", None), (None, "a b", None), (5000, None, "empty"), (5001, "", "empty"), (5002, "x " * 4000, "s0")]
    docs = document_frame(spark, rows)
    build = lambda: mixing.mix(docs, group=16).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()
    got = build()
    assert Counter(map(tuple, got)) == Counter(map(tuple, build()))
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((d, s, len((t or "").split())) for d, t, s in rows)
    weights = dict(zip(["empty", "s0", "s1", "s2", None], [1, 2, 3, 1, 2], strict=True))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    total, capped = sum(sizes.values()), set()
    while True:
        share = (total - sum(3 * sizes[s] for s in capped)) / sum(w for s, w in weights.items() if s not in capped)
        over = {s for s, w in weights.items() if s not in capped and w * share >= 3 * sizes[s]}
        if not over:
            break
        capped |= over
    for r in got:
        assert 0 <= r.copies <= 3
        assert r.target == pytest.approx(min(3 * sizes[r.source], weights[r.source] * share))
        assert r.source_size == sizes[r.source]
    for s in ("s1", "s2"):
        taken = sum(r.copies * r.size for r in got if r.source == s)
        assert abs(taken - next(r.target for r in got if r.source == s)) < 80
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_takes_repeated_rows_as_one_unit(spark):
    rows = [(1, "a b c", "hot")] * 6000 + [(None, "a b", "hot")] * 500 + [(i, "w " * (1 + i % 50), "hot") for i in range(2, 2000)]
    rows += [(i, "v " * (i % 90), "cold") for i in range(9000, 9600)] + [(1, "a b c", "cold")] * 2
    docs = document_frame(spark, rows).repartition(7)
    got = mixing.mix(docs, group=32).select("row.doc_id", "row.source", "row.text", "size", "target", "copies").collect()
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(rows)
    copies: dict = {}
    for r in got:
        copies.setdefault((r.doc_id, r.text, r.source), Counter())[r.copies] += 1
    for unit in copies.values():
        assert max(unit) - min(unit) <= 1 and max(unit) <= 3
    for source in ("hot", "cold"):
        taken = sum(r.copies * r.size for r in got if r.source == source)
        assert abs(taken - next(r.target for r in got if r.source == source)) <= 100
    repeated, words = copies[1, "a b c", "hot"], sum(len(t.split()) for _, t, s in rows if s == "hot")
    share = next(r.target for r in got if r.source == "hot") / words
    assert abs(sum(c * n for c, n in repeated.items()) - 6000 * share) < 1
    again = mixing.mix(docs.repartition(3), group=32).select("row.doc_id", "row.source", "row.text", "copies").collect()
    assert Counter((r.doc_id, r.source, r.text, r.copies) for r in got) == Counter(map(tuple, again))


def test_mix_carries_no_texts_through_the_duels(spark):
    docs = document_frame(spark, [(i, f"w {i} " * (i % 40), f"s{i % 2}") for i in range(300)])
    plan = mixing.mix(docs).select("row.doc_id", "copies")._jdf.queryExecution().executedPlan().toString()
    assert "text" not in "".join(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "Python" not in plan and "InArrow" not in plan


def test_tokens_round_trip(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file())
    odd = ["two  blanks", "tab\t and\n line", "  x", "<|endoftext|> y", " lead", "trail ", "it's 12 o'clock.\n"]
    rows = [(i, t, "s") for i, t in enumerate([*texts, *odd])] + [(3, "again", None), (None, "no id", None)]
    listed = dac.write_tokens(document_frame(spark, rows), tokenizer_file(), ids_per_file=1000)
    got = sorted(dac.read_tokens(listed).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, *sorted(d for d, _, _ in rows if d is not None)]
    start = 0
    want = Counter()
    for d, t, _ in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want[d, len(ids), zlib.crc32(ids.tobytes())] += 1
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert dac.read_tokens(dac.write_tokens(document_frame(spark, []), tokenizer_file())).count() == 0


def test_codes_give_any_id_directly_and_refuse_damage():
    chance = np.random.default_rng(4)
    ids = np.concatenate([chance.integers(0, 4096, 3000), chance.integers(0, 1 << 16, 2000), chance.integers(0, 1 << 32, 50)]).astype(np.uint32)
    data = dac.encode(ids, [1, None], np.array([5000, 5050]))
    codes = dac.Codes(data)
    assert (codes.all() == ids).all() and [codes[i] for i in range(0, 5050, 7)] == ids[::7].tolist() and codes.docs == [1, None]
    with pytest.raises(ValueError):
        dac.Codes(data[:-20] + bytes([data[-20] ^ 1]) + data[-19:])


def test_archives(spark):
    page = "<p>" + "long " * 60
    rows = [(5, "http://a/ b", page), (3, None, page), (9, "http://c", page), (None, "http://d", page), (1, "u", "short"), (2, "u\r\nX: y", "short"), (4, "e", None), (6, "e", "")]
    rows += [(100 + i, "http://x", f"<html>{i} ü " + "text " * i) for i in range(60)]
    listed = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x")), file_bytes=2000)
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(listed).collect())
    want = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = html == page and i != 3
        want[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None] += 1
    assert got == want
    uri = listed.orderBy(F.desc("records")).first().file
    data = files.read_bytes(uri)
    assert data[:4] == b"\x5d\x2a\x4d\x18"  # the dictionary leads
    system, path = files.place(uri)
    with pytest.raises(ValueError), system.open_input_stream(path, compression=None) as stream:
        import io

        list(warc.frames(io.BytesIO(stream.read()[:-5])))
    with pytest.raises(ValueError):
        warc.parse(warc.record(1, "u", b"abc", "d", None, False, "now")[:-5] + b"x\r\n\r\n")
    assert warc.read_archives(warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


def test_reputation_shrinks_and_rules_win(spark):
    pages = [(i, f"http://bad{i % 2}.evil.com/{i}") for i in range(60)] + [(100 + i, f"http://g{i}.good.com/") for i in range(40)]
    pages += [(300, "http://new.evil.com/"), (301, "http://one.good.com/x"), (302, None), (303, "nohost"), (304, "HTTP://A.EVIL.com/ok/x?y"), (None, "http://bad0.evil.com/")]
    labels = [(i, 1) for i in range(60)] + [(100 + i, 0) for i in range(40)] + [(301, 1), (301, None), (None, 1)]
    rules = [("evil.com", "/ok/", "allow"), ("com", "/ok/", "block")]
    got = reputation.judge(
        spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad int"), spark.createDataFrame(rules, "host string, path string, verdict string")
    ).collect()
    verdict = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert verdict[0][3] == "block" and verdict[None][3] == "block" and verdict[100][3] == "allow"
    assert verdict[301] == ("one.good.com", "/x", None, "allow")  # one bad page alone does not block a host
    assert verdict[302] == ("", "", None, "allow") == verdict[303]
    assert verdict[304] == ("a.evil.com", "/ok/x", "evil.com/ok/", "allow")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert reputation.judge(empty, spark.createDataFrame([], "page_id long, bad int"), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0


def test_toxicity_finds_the_sentence(spark):
    chance = random.Random(3)
    plain = [f"word{i}" for i in range(200)]
    sentence = lambda: " ".join(chance.choices(plain, k=8)) + ". "
    rows, labels = [], []
    for i in range(300):
        parts = [sentence() for _ in range(chance.randint(1, 12))]
        if i % 4 == 0:
            parts.insert(chance.randint(0, len(parts)), "you vile wretch of a thing. ")
        rows.append((i, "".join(parts), "s"))
        labels.append((i, int(i % 4 == 0)))
    docs = document_frame(spark, [*rows, (901, None, None), (902, "", None), (None, "you vile wretch", None)])
    model = toxicity.train(docs, spark.createDataFrame([*labels[:200], (None, 1), (5, None)], "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    held = range(200, 300)
    assert sum(got[i].predicted == (i % 4 == 0) for i in held) >= 98
    text = rows[204][1]
    span = got[204].spans[0]
    assert "wretch" in text.encode()[span.start : span.end].decode()
    assert got[901].score == got[902].score == 0.0 and got[None].predicted == 1
    untaught = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.predicted for r in toxicity.score_documents(docs, untaught).collect()} == {0}


def test_context_mixing(spark, texts):
    import math

    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, "alone", None)]
    got = {r.doc_id: r for r in contextmix.score(document_frame(spark, rows)).collect()}
    tokens = {d: [*words_of((t or "").encode()), b""] for d, t, _ in rows}
    counts = Counter()
    for d, own in tokens.items():
        if d is not None and zlib.crc32(str(d).encode()) % 10:
            counts.update(own)
    total = sum(counts.values())
    for d, own in tokens.items():
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (len(counts) + 1))) for t in own)
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[t] > 0 for t in own), total)
        assert r.base_score == pytest.approx(base) and r.score < 0
        assert r.held_out == (d is not None and zlib.crc32(str(d).encode()) % 10 == 0)
    assert got[20].bits_per_byte < 4 and contextmix.score(document_frame(spark, [])).count() == 0


def test_rare_tokens_score_as_if_all_were_frequent(spark, texts, monkeypatch):
    docs = document_frame(spark, [(i, t, "s") for i, t in enumerate(texts)])
    found = contextmix.frequent
    score = lambda: {r.doc_id: (r.n_tokens, r.n_known, r.base_score, r.score) for r in contextmix.score(docs).collect()}
    want = score()
    monkeypatch.setattr(contextmix, "frequent", lambda tokens: found(tokens, 20))
    got = score()
    assert got.keys() == want.keys() and all(got[d] == pytest.approx(want[d], rel=1e-4) for d in want)


@pytest.mark.parametrize("wanted", [1000, 9])
def test_whole_units_so_far_are_counted_exactly(spark, monkeypatch, wanted):
    chance = random.Random(1)
    long = b"q" * 90
    units = list({bytes(chance.choices(b" abc\xc3", k=chance.randrange(7))) for _ in range(150)} | {long + bytes([x]) for x in range(97, 101)} | {long, long[:40]})
    n = {u: chance.randrange(4) for u in units}
    monkeypatch.setattr(contextmix, "RANGE", (wanted, 1 << 24))
    rows = contextmix.in_ranges(spark.createDataFrame([(bytearray(u), i, n[u]) for i, u in enumerate(units)], "unit binary, token long, n long"))
    told = [(r.part, contextmix.pickle.loads(r.ends)) for r in rows.where("ends is not null").collect()]
    assert (len(told) > 5) == (wanted == 9)
    others = contextmix.beyond(told)
    coded = {u: "".join(f"{x:08b}" for x in u + b"\0") for u in units}
    seen_units = set()
    for batch in rows.where("ends is null").drop("ends", "four").toArrow().to_batches():
        for some, own in contextmix.pieces(batch, 7):
            seen, ones = contextmix.far_counts(own, others, contextmix.decisions(some, contextmix.SLOTS)[2])
            begins = [coded[u][:i] for u in some for i in range(len(coded[u]))]
            assert seen.tolist() == [sum(n[u] for u in units if coded[u].startswith(b)) for b in begins]
            assert ones.tolist() == [sum(n[u] for u in units if coded[u].startswith(b + "1")) for b in begins]
            seen_units.update(some)
    assert seen_units == set(units)
    four = rows.where("ends is not null").select(F.explode("four").alias("four"))
    runs = {(b"\0\0\0" + u + b"\0")[i : i + 4] for u in units if n[u] for i in range(len(u) + 1)}
    assert {int(r.four).to_bytes(4, "big") for r in four.distinct().collect()} == runs


def test_tables_of_short_contexts_grow_with_what_is_counted(spark):
    four = spark.range(1 << 17).select((F.col("id") * 256 + F.pmod(F.hash("id"), F.lit(256))).alias("four"))
    assert contextmix.table_sizes(four)[3] == 22 and contextmix.table_sizes(four.limit(5)) == contextmix.SLOTS
