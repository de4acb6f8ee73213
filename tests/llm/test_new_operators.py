"""License scan, hard negatives and alignment of tokenizers on hand-made tables, against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from firmlake.llm import common, crosstok, dac, hardnegatives, licenses, pieces
from firmlake.llm.queries import tokenizer_file
from firmlake.session import write_and_read

DOCS = "doc_id long, text string, words string, row string, blocks int, digest string"


def docs_of(spark, rows):
    """Extra columns carry names that the operators use themselves."""
    return spark.createDataFrame([(d, t, "x", None, 7, "y") for d, t in rows], DOCS)


def brute_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if (c.isascii() and c.isalnum()) or not c.isascii():
            word += c.lower() if c.isascii() else c
        elif word:
            out.append(word)
            word = ""
    return out


def brute_scan(text, templates, percent):
    words = brute_words(text)
    places, base, met, best = [], set(), set(), 0.0
    for label, phrase in licenses.PHRASES:
        p = phrase.split(" ")
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    blocks = Counter()
    for number, (label, template) in enumerate(templates):
        tokens = brute_words(template)
        if not tokens:
            continue
        span = 1
        while span < len(tokens):
            span *= 2
        for start in range(0, len(words), span):
            shared = set(tokens) & set(words[start : start + 2 * span])
            if 100 * len(shared) >= percent * len(set(tokens)):
                blocks[label, number, start, len(words[start : start + 2 * span]), len(shared), len(shared) / len(set(tokens))] += 1
                met.add(label)
                best = max(best, len(shared) / len(set(tokens)))
    digest = len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | met)), 1.0 if base else best
    return digest, blocks


@pytest.fixture(scope="module")
def license_texts():
    chance = random.Random(3)
    common = [f"w{i}" for i in range(40)] + ["the", "under", "license", "this", "of"]
    texts = [None, "", " \n..", "MIT", "mit-LICENSE", "Mit licensé", "x mit license y\nApache  License. mit license", "ünder the mít license", "mit " * 400 + "license"]
    for i in range(60):
        words = chance.choices(common, k=chance.choice([3, 30, 90, 300]))
        for _ in range(i % 3):
            notice = brute_words(chance.choice(licenses.TEMPLATES)[1])
            if chance.random() < 0.5:
                notice[chance.randrange(len(notice))] = "other"
            at = chance.randrange(len(words))
            words[at:at] = notice
        texts.append(chance.choice([" ", "\n", ", "]).join(words))
    return [*texts, texts[-1]]


@pytest.mark.parametrize("percent", [60, 90, 100])
def test_license_scan(spark, license_texts, percent):
    templates = [*licenses.TEMPLATES, ("none", "..."), ("one", "w7")]
    rows = [*enumerate(license_texts), (None, license_texts[-1]), (None, license_texts[-1]), (3, "mit license")]
    want = Counter((d, *brute_scan(t, templates, percent)[0]) for d, t in rows)
    assert Counter(map(tuple, licenses.scan(docs_of(spark, rows), templates, percent).collect())) == want
    blocks = Counter()
    for d, t in rows:
        for block, n in brute_scan(t, templates, percent)[1].items():
            blocks[(d, *block)] += n
    assert Counter(map(tuple, licenses.license_blocks(docs_of(spark, rows), templates, percent).collect())) == blocks


def test_license_scan_of_empty_tables_and_bad_parameters(spark):
    assert licenses.scan(docs_of(spark, [])).count() == 0
    got = licenses.scan(docs_of(spark, [(1, "mit license")]), templates=[]).first()
    assert (got.labels, got.score) == ("mit", 1.0)
    assert licenses.license_blocks(docs_of(spark, [(1, "mit license")]), templates=[]).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(docs_of(spark, []), percent=0)


def test_license_scan_of_a_very_long_text(spark):
    text = "lorem " * 300_000 + "released under the MIT license" + " ipsum" * 5
    got = licenses.scan(docs_of(spark, [(1, text)])).first()
    assert (got.n_words, got.first_word, got.labels) == (300_010, 300_003, "mit")


VECTORS = "vec_id long, embedding array<double>, label int, row int, vector string, score string"


def brute_negatives(rows, every, k, percent):
    good = [(v, [int(np.floor(float(x) * 256)) for x in e], c) for v, e, c in rows if None not in (v, e, c) and all(x is not None and np.isfinite(x) for x in e)]
    clip = lambda s: min(max(s, -(2**63)), 2**63 - 1)
    out = Counter()
    for i, (anchor, e, c) in enumerate(good):
        if anchor % every:
            continue
        scored = [(clip(sum(a * b for a, b in zip(e, f))), v, j, d) for j, (v, f, d) in enumerate(good) if j != i and len(f) == len(e)]
        scored.sort(key=lambda s: (-s[0], s[1], s[2]))
        for high, positive, _, _ in [s for s in scored if s[3] == c][:k]:
            fits = [s for s in scored if s[3] != c and percent * high <= 100 * s[0] <= 100 * high][:k]
            for rank, (score, v, _, _) in enumerate(fits, 1):
                out[anchor, positive, rank, v, high, score] += 1
    return out


def test_hard_negatives(spark, monkeypatch):
    chance = np.random.default_rng(7)
    base = chance.normal(size=(40, 24))
    rows = []
    for i in range(400):
        v = base[i % 40] + chance.normal(scale=0.3, size=24)
        rows.append((i, v.tolist(), int(chance.integers(0, 4)) if i % 11 else None))
    rows += [(500, rows[3][1], 1), (501, rows[3][1], 2), (510, None, 1), (520, [None, *rows[1][1][1:]], 1), (530, [float("nan"), *rows[1][1][1:]], 2), (None, rows[5][1], 1)]
    rows += [(540 + i, [0.0] * 24, i % 3) for i in range(20)]  # ties
    rows += [(600 + i, chance.normal(size=5).tolist(), i % 2) for i in range(30)]  # another length
    rows += [(700 + i, [], i % 2) for i in range(12)]
    rows += [(800, rows[0][1], 1), (800, rows[0][1], 1)]  # a repeated anchor
    frame = spark.createDataFrame([(v, e, c, 1, "x", None) for v, e, c in rows], VECTORS)
    want = brute_negatives(rows, 10, 5, 80)
    assert len(want) > 200
    names = "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    get = lambda df: Counter(tuple(r[n] for n in names) for r in df.collect())
    assert get(hardnegatives.hard_negatives(frame, every=10)) == want
    for name, small in (("ROWS_PER_TASK", 64), ("ANCHORS_PER_BLOCK", 7), ("PAIRS_AT_ONCE", 100)):
        monkeypatch.setattr(hardnegatives, name, small)
    assert get(hardnegatives.hard_negatives(frame, every=10)) == want
    assert hardnegatives.hard_negatives(frame.limit(0)).count() == 0
    assert hardnegatives.hard_negatives(frame.where("vec_id between 1 and 9"), every=10).count() == 0


def test_hard_negatives_of_very_large_components(spark):
    rows = [(i * 10, [1e15 * (i + 1), 3.5], i % 2) for i in range(6)] + [(1, [1e300, 1.0], 0), (2, [-1e300, 1.0], 1)]
    frame = spark.createDataFrame([(v, e, c, 1, "x", None) for v, e, c in rows], VECTORS)
    got = hardnegatives.hard_negatives(frame, every=10).collect()
    assert got and all(-(2**63) <= r.negative_score <= r.positive_score < 2**63 for r in got)


def test_bounds_hold_at_every_level():
    chance = np.random.default_rng(1)
    for width in (1, 3, 5, 16, 64, 100):
        a, b = (hardnegatives.Vectors(np.floor(chance.normal(scale=s, size=(50, width)))) for s in (300, 2))
        mine, its = (x.reshape(-1) for x in np.indices((50, 50)))
        exact = a.scores(b, mine, its)
        assert exact.tolist() == (a.values @ b.values.T).reshape(-1).astype(int).tolist()
        for level in range(len(a.levels)):
            low, high = a.bounds(level, b, mine, its)
            assert (low <= exact).all() and (exact <= high).all()


ODD_TEXTS = [
    None, "", " ", "  ", "\n", "a", " lead", "trail ", "trail  ", "a  b\n c", "é à　x y", "<s> x </s> <unk> y", "x<|endoftext|> <|endoftext|> y", "a▁b ▁ c", "x" * 900,
    "한국 어 문장", "🙂 🙂 x", "tab\t x\ty", "a\u0085 b", "a  b", "a\x1f b \x00 c", "don't 'll x's", "é é", "हिन्दी में पाठ", "ﬁ ⅷ ½", "​ ​", "a  b", "ق ا ل", "1 22 333 4,444.5",
]


def byte_tokens():
    a, b = Tokenizer.from_file(tokenizer_file()), sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    a.encode_special_tokens = True
    value = crosstok.bytes_of_characters()
    names = {i: bytes(value[c] for c in t) if all(c in value for c in t) else t.encode() for t, i in a.get_vocab().items()}

    def of_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    def run(text):
        whole = (" " + (text or "")).encode()
        ids = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        held = [names[i] for i in ids[0]], [of_b(i) for i in ids[1]]
        if not text or b"".join(held[0]) != whole or b"".join(held[1]) != whole:
            return [], []
        return [list(zip(i, np.cumsum([len(x) for x in h]).tolist(), [len(x) for x in h])) for i, h in zip(ids, held)]

    return run


def brute_alignment(texts):
    """Per text: tokens, groups as text, links as id pairs, by comparing byte ranges."""
    run, out, count = byte_tokens(), [], Counter()
    for text in texts:
        a, b = run(text)
        links, first = [], 0
        for i, end, size in a:
            while first < len(b) and b[first][1] <= end - size:
                first += 1
            j = first
            while j < len(b) and b[j][1] - b[j][2] < end:
                links.append((i, b[j][0]))
                j += 1
        common = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups, low = [], 0
        for c in common:
            groups.append("|".join(",".join(str(i) for i, e, _ in side if low < e <= c) for side in (a, b)))
            low = c
        count.update(links)
        out.append((len(a), len(b), groups, links))
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [
        (n_a, n_b, len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "", sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links))
        for n_a, n_b, groups, links in out
    ]


@pytest.mark.parametrize("at_once", [crosstok.TEXT_AT_ONCE, 200])
def test_alignment(spark, at_once):
    chance = random.Random(9)
    words = [w for t in ODD_TEXTS if t for w in t.split(" ")] + ["the", "of", "and", "tokens", "naïve"]
    texts = [*ODD_TEXTS, *(chance.choice([" ", "  ", " \n"]).join(chance.choices(words, k=chance.choice([2, 20, 60]))) for _ in range(60)), "the of the"]
    rows = [*enumerate(texts), (None, texts[-1]), (5, texts[-1])]
    got = crosstok.aligned_documents(docs_of(spark, rows), tokenizer_file(), tokenizer_file("piece_bpe_32k.model"), at_once).collect()
    want = brute_alignment([t for _, t in rows])
    assert Counter(map(tuple, got)) == Counter((d, *w) for (d, _), w in zip(rows, want, strict=True))
    assert sum(w[0] == 0 for w in want) > 3


def test_alignment_of_an_empty_table(spark):
    files = tokenizer_file(), tokenizer_file("piece_bpe_32k.model")
    assert crosstok.aligned_documents(docs_of(spark, []), *files).count() == 0
    nothing = crosstok.aligned_documents(docs_of(spark, [(1, None), (2, "")]), *files).collect()
    assert sorted(map(tuple, nothing)) == [(1, 0, 0, 0, 0, "", 0, 0), (2, 0, 0, 0, 0, "", 0, 0)]


def test_pieces_give_the_ids_of_whole_texts():
    chance = random.Random(2)
    words = [w for t in ODD_TEXTS if t for w in t.split(" ")]
    texts = [t or "" for t in ODD_TEXTS] + [chance.choice([" ", "  ", "\n ", " \t"]).join(chance.choices(words, k=30)) for _ in range(200)]
    encoder = dac.Pieces(tokenizer_file(), 0)
    want = [[*e.ids, 0] for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # the second time from memory
        ids, sizes = encoder.encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
    found, per_text = pieces.cut(pa.array(texts))
    parts = found.to_pylist()
    assert ["".join(parts[e - n : e]) for e, n in zip(np.cumsum(per_text).tolist(), per_text.tolist(), strict=True)] == texts


@pytest.mark.parametrize("bits", [(16, 26), (3, 3)])  # the second lets most others pass
def test_rows_without_ids(spark, monkeypatch, bits):
    monkeypatch.setattr(common, "FILTER_BITS", bits)
    rows = spark.createDataFrame([(i % 300 if i % 7 else None, f"t{i}") for i in range(900)], "doc_id long, text string")
    for gone in ([], [0], list(range(0, 300, 3))):
        ids = write_and_read(spark.createDataFrame([(g,) for g in gone], "doc_id long"), "gone")
        got = Counter(map(tuple, common.without_ids(rows, "doc_id", ids).collect()))
        assert got == Counter(tuple(r) for r in rows.collect() if r.doc_id not in gone)
