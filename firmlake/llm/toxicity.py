"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A linear model over hashed words and word beginnings scores each sentence, and the document's
probability is the noisy-or of its sentences: 1 - prod(1 - p). Only documents have labels; the gradient passes through the
noisy-or to the sentences that explain the label, so the model also tells where the offence is.

The weights are a fixed number of floats. They are fitted on at most ``POSITIVES`` + ``NEGATIVES`` labelled documents, drawn by
the hash of their ids; every document is scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlake.llm.common import draw, give_back, small_batches

POSITIVES, NEGATIVES = 1500, 4500  # bound of the labelled sample
BITS = 18
BEGINNINGS = (3, 4, 5)  # characters
SEEN_IN = 2
STEPS, RATE, DECAY = 100, 0.08, 2e-5
THRESHOLD = 0.7
KNOWN = 100_000
SENTENCE = re.compile(rb"[^.!?\n]+")
TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff']+")


def word_features(word: bytes) -> list[int]:
    """Slots of a word: itself and its beginnings."""
    text = word.decode("utf-8", "replace")
    names = [f"={text}", *(f"{n}{text[:n]}" if len(text) >= n else f"={text}" for n in BEGINNINGS)]
    return [xxhash.xxh3_64_intdigest(name) & ((1 << BITS) - 1) for name in names]


def sentences(text: bytes | None) -> Iterator[tuple[int, int, list[bytes]]]:
    """Start and end in bytes and the words of each sentence that has any."""
    for found in SENTENCE.finditer(text or b""):
        if words := TOKEN.findall(found[0].lower()):
            yield found.start(), found.end(), words


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


class Model:
    """Weights of the slots and a bias; ``score`` gives P(toxic) and the sentences behind it."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.known: dict[bytes, float] = {}

    def __reduce__(self):
        return Model, (self.weights, self.bias)

    def word(self, word: bytes) -> float:
        value = self.known.get(word)
        if value is None:
            value = float(self.weights[word_features(word)].sum())
            if len(self.known) < KNOWN:
                self.known[word] = value
        return value

    def score(self, text: bytes | None, above: float = 0.5) -> tuple[float, list[tuple[int, int, float]]]:
        spans, logits, word = [], [], self.word
        for start, end, words in sentences(text):
            spans.append((start, end))
            logits.append(self.bias + sum(map(word, words)))
        if not spans:
            return 0.0, []
        z = np.array(logits)
        p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        total = float(-np.expm1(-softplus(z).sum()))
        return min(1.0, max(0.0, total)), [(*spans[i], float(p[i])) for i in np.flatnonzero(p >= above)]


def fit(texts: list[bytes], labels: list[int]) -> Model:
    """Full-batch Adam on the noisy-or likelihood; without both labels nothing is toxic."""
    if len(set(labels)) < 2:
        return Model(np.zeros(1 << BITS, np.float32), -30.0)
    vocabulary: dict[bytes, int] = {}
    words, sizes, bags = [], [], []
    for bag, text in enumerate(texts):
        for _, _, found in sentences(text):
            words += [vocabulary.setdefault(w, len(vocabulary)) for w in found]
            sizes.append(len(found))
            bags.append(bag)
    word, size, bag = np.array(words, np.int32), np.array(sizes), np.array(bags)
    begin = np.cumsum(size) - size
    slots = np.array([word_features(w) for w in vocabulary], np.int64)
    # a slot counts when two documents have it; what a single document has would just name that document
    documents = np.zeros(1 << BITS, np.int32)
    for own in np.split(word, np.flatnonzero(np.diff(np.repeat(bag, size))) + 1):
        documents[np.unique(slots[own])] += 1
    active = documents >= SEEN_IN
    y = np.array(labels, float)
    share = y.mean()
    # both labels weigh in, the rarer one with the root of its odds
    importance = np.where(y > 0, np.sqrt((1 - share) / share), 1.0)
    importance /= importance.sum()
    weights, bias = np.zeros(1 << BITS), -4.0 - np.log(max(1.0, len(size) / len(texts)))
    m, v, mb, vb = np.zeros_like(weights), np.zeros_like(weights), 0.0, 0.0
    for step in range(1, STEPS + 1):
        z = bias + np.add.reduceat(weights[slots].sum(1)[word], begin)
        none = np.bincount(bag, softplus(z), len(y))  # -log of the chance that no sentence is toxic
        p = -np.expm1(-none)
        outer = importance * (1 - y / np.maximum(p, 1e-9))
        dz = outer[bag] / (1 + np.exp(-np.clip(z, -60, 60)))
        per_word = np.bincount(word, np.repeat(dz, size), len(slots))
        grad = np.bincount(slots.ravel(), np.repeat(per_word, slots.shape[1]), len(weights)) * active + DECAY * weights
        gb = dz.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        rate = RATE * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        weights -= rate * m / (np.sqrt(v) + 1e-6)
        bias -= rate * mb / (np.sqrt(vb) + 1e-6)
    return Model(weights.astype(np.float32), float(bias))


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> Model:
    """Fits on ``labels`` (doc_id, toxic 0/1) of ``docs`` (doc_id, text); a document with both labels counts as toxic.

    Labels without id, value or document are not used; of repeated documents each row is an example.
    """
    small_batches(docs.sparkSession)
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    chosen = None
    for value, most in ((1, positives), (0, negatives)):
        some = draw(known.where(F.col("toxic") == value), most, "doc_id")
        chosen = some if chosen is None else chosen.union(some)
    # a proven size: at most positives + negatives ids, and one task for as many documents
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = rows.select("doc_id", F.coalesce("text", F.lit(b"")).alias("text"), "toxic").repartition(1).sortWithinPartitions("doc_id", "text")
    found = sample.mapInArrow(give_back(_fit), "weights binary, bias double").first()
    return Model(np.frombuffer(found.weights, np.float32), found.bias) if found else fit([], [])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, labels = [], []
    for batch in batches:
        texts += batch.column("text").to_pylist()
        labels += batch.column("toxic").to_pylist()
    model = fit(texts, labels)
    yield pa.RecordBatch.from_pydict({"weights": [model.weights.tobytes()], "bias": [model.bias]})


def scorer(model: Model):
    """Function of a binary text: score and the offending sentences as start, end (bytes) and their own score."""

    @F.arrow_udf("struct<score:double,spans:array<struct<start:bigint,end:bigint,score:double>>>")
    def scored(texts: pa.Array) -> pa.Array:
        found = [model.score(t.as_py()) for t in texts]
        spans = [[{"start": a, "end": b, "score": p} for a, b, p in s] for _, s in found]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        return pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.float64()), pa.array(spans, kind)], ["score", "spans"])

    return scored


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted, spans) for each row of ``docs``; null, empty and wordless texts score 0. Other columns are ignored."""
    found = docs.select("doc_id", scorer(model)(F.col("text").cast("binary")).alias("found"))
    return found.select("doc_id", "found.score", (F.col("found.score") >= threshold).cast("int").alias("predicted"), "found.spans")


def is_toxic(model: Model, text: Column, threshold: float = THRESHOLD) -> Column:
    return scorer(model)(text.cast("binary"))["score"] >= threshold
