"""Toxicity by subword embeddings.

A word is the bag of its character n-grams (with its edges), hashed to
buckets; every bucket has a vector.  The vectors of a stretch of a few words
are averaged and go into a linear softmax of two classes; vectors and softmax are trained
together by gradient descent.  A misspelt word shares most of its n-grams, and
so its vectors, with the word it stands for.

Labels are of documents, and a toxic one may hold a single such word among
thousands.  So a document is its stretches of ``WORDS`` words, all of them, and is as toxic
as the worst: in training, a toxic document teaches with its highest stretch,
which is chosen anew every round, and a clean one with all of its stretches.  Last, a
logistic curve over the documents' highest stretches turns them into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS = 4
ORDERS = (3, 4, 5, 6)
BUCKET_BITS = 17
CHUNK_BYTES = 1 << 20
EDGE = 32
CLEAN_BIAS = 4.0  # what has no known n-gram is taken for clean

_KEPT = np.full(256, EDGE, np.uint8)
for _byte in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):  # digits, letters, UTF-8
    _KEPT[_byte] = _byte
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Bags:
    """N-grams of several texts: bucket and stretch of each, document of each stretch."""

    bucket: np.ndarray
    stretch: np.ndarray
    document: np.ndarray


def bags(texts: list[str | None]) -> Bags:
    """All n-grams of whole texts; a text without words has no stretch."""
    parts = [b" " + (t or "").lower().encode() + b" " for t in texts]
    letters = _KEPT[np.frombuffer(b"".join(parts), np.uint8)]
    ends = np.cumsum([len(p) for p in parts])
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    keep = np.ones(len(letters), bool)
    keep[1:] = (letters[1:] != EDGE) | (letters[:-1] != EDGE)
    keep[ends[:-1]] = True  # every text begins with an edge of its own
    letters, owner = letters[keep], owner[keep]
    edge = letters == EDGE
    # a word is named by the number of edges before it; words are counted from their text's first
    word = np.cumsum(edge)
    begins = edge.copy()
    begins[:-1] &= ~edge[1:]
    if len(begins):
        begins[-1] = False
    word_owner = owner[begins]
    first = np.searchsorted(word_owner, np.arange(len(parts)))
    place = np.arange(len(word_owner)) - first[word_owner] if len(word_owner) else np.zeros(0, int)
    opens = place % WORDS == 0
    stretch_of_word = np.cumsum(opens) - 1
    document = word_owner[opens]
    number = np.cumsum(begins) - 1  # of the word that a letter belongs to
    buckets, stretches = [], []
    wide = letters.astype(np.uint64)
    for order in ORDERS:
        n = len(letters) - order + 1
        if n <= 0:
            continue
        inside = np.ones(n, bool)
        value = np.full(n, order, np.uint64)
        for i in range(order):
            value = value * np.uint64(257) + wide[i : n + i]
            if 0 < i < order - 1:
                inside &= ~edge[i : n + i]
        at = np.flatnonzero(inside)
        hashed = value[at] * _FACTOR
        buckets.append((hashed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
        stretches.append(stretch_of_word[number[at + 1]])
    if not buckets:
        return Bags(np.zeros(0, np.int32), np.zeros(0, np.int64), document)
    return Bags(np.concatenate(buckets), np.concatenate(stretches), document)


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK_BYTES``, one text at least."""
    at = 0
    while at < len(texts):
        size, stop = 0, at
        while stop < len(texts) and (stop == at or size + len(texts[stop] or "") <= CHUNK_BYTES):
            size += len(texts[stop] or "")
            stop += 1
        yield at, stop
        at = stop


@dataclass
class Sample:
    """N-grams of the training texts by stretch: those of stretch i begin at ``starts[i]``."""

    bucket: np.ndarray
    starts: np.ndarray
    document: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Sample:
        buckets, counts, documents = [], [], []
        for at, stop in _chunks(texts):
            found = bags(texts[at:stop])
            buckets.append(found.bucket[np.argsort(found.stretch, kind="stable")])
            counts.append(np.bincount(found.stretch, minlength=len(found.document)))
            documents.append(found.document + at)
        sizes = np.concatenate([np.zeros(1, int), *counts])
        return cls(np.concatenate(buckets), np.cumsum(sizes), np.concatenate(documents))

    def means(self, weight: np.ndarray, some: int = 1 << 14) -> np.ndarray:
        """Average weight of each stretch, some stretches at a time."""
        total = np.empty(len(self.document))
        for at in range(0, len(total), some):
            own = self.starts[at : at + some + 1]
            total[at : at + some] = np.add.reduceat(weight[self.bucket[own[0] : own[-1]]], own[:-1] - own[0])
        return total / np.diff(self.starts)

    def documents_of(self, bucket_bits: int, chosen: np.ndarray) -> np.ndarray:
        """How many of the chosen documents each bucket occurs in."""
        counts = np.zeros(1 << bucket_bits, np.int64)
        firsts = np.searchsorted(self.document, np.flatnonzero(chosen))
        lasts = np.searchsorted(self.document, np.flatnonzero(chosen), side="right")
        for first, last in zip(self.starts[firsts], self.starts[lasts]):
            counts[np.unique(self.bucket[first:last])] += 1
        return counts


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class Model:
    """``weight``: difference of the two classes' logits by bucket; ``bias`` of a
    stretch; ``slope`` and ``level`` of the curve over documents."""

    weight: np.ndarray
    bias: float
    slope: float
    level: float

    def stretches(self, found: Bags) -> np.ndarray:
        n = len(found.document)
        total = np.bincount(found.stretch, self.weight[found.bucket], n)
        count = np.bincount(found.stretch, minlength=n)
        return total / np.maximum(count, 1) + self.bias

    def highest(self, texts: list[str | None]) -> np.ndarray:
        """The highest stretch's logit; a text without words has the bias."""
        best = np.full(len(texts), self.bias)
        for at, stop in _chunks(texts):
            found = bags(texts[at:stop])
            part = np.full(stop - at, -np.inf)
            np.maximum.at(part, found.document, self.stretches(found))
            best[at:stop] = np.where(np.isinf(part), self.bias, part)
        return best

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        return _sigmoid(self.slope * self.highest(texts) + self.level)


def train(
    texts: list[str],
    toxic: np.ndarray,
    *,
    size: int = 4,
    rounds: int = 6,
    epochs: int = 2,
    batch: int = 512,
    rate: float = 1.0,
    clean_per_toxic: int = 20,
    dropout: float = 0.5,
    seed: int = 7,
) -> Model:
    """Vectors and softmax from labelled texts, then the curve."""
    toxic = np.asarray(toxic).astype(bool)
    if toxic.all() or not toxic.any():
        share = float(toxic.mean()) if len(toxic) else 0.0
        level = 40.0 if share else -40.0
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), 0.0, 1.0, level)
    found = Sample.of(texts)
    bucket, starts, counts = found.bucket, found.starts, np.diff(found.starts)
    label = toxic[found.document]
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (1 << BUCKET_BITS, size))
    softmax, bias = rng.normal(0, 0.5, (size, 2)), np.array([CLEAN_BIAS, 0.0])
    gathered = np.full(1 << BUCKET_BITS, 1e-3)  # squared gradients by bucket

    # To begin with: by how much more often a bucket occurs in toxic documents.
    hit, miss = found.documents_of(BUCKET_BITS, toxic), found.documents_of(BUCKET_BITS, ~toxic)
    odds = np.log((hit + 0.5) / toxic.sum()) - np.log((miss + 0.5) / (~toxic).sum())
    odds[hit < 3] = 0
    value = found.means(odds)

    clean = np.flatnonzero(~label)
    for turn in range(rounds):
        # the highest stretch of every toxic document
        ranked = np.lexsort((-value, found.document))
        leading = ranked[np.unique(found.document[ranked], return_index=True)[1]]
        positive = leading[toxic[found.document[leading]]]
        some = min(len(clean), clean_per_toxic * len(positive))
        hard = clean[np.argsort(-value[clean], kind="stable")[: some // 2]]
        chosen = np.concatenate([hard, rng.choice(clean, some - len(hard), replace=False)])
        for _ in range(epochs):
            lot = rng.permutation(np.concatenate([np.repeat(positive, 4), chosen]))
            for at in range(0, len(lot), batch):
                own = lot[at : at + batch]
                sizes = counts[own]
                inside = np.repeat(starts[own] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
                row = np.repeat(np.arange(len(own)), sizes)
                # some n-grams are left out, so that a word is known by any part of it
                kept = rng.random(len(row)) >= dropout
                row, used = row[kept], bucket[inside[kept]]
                sizes = np.maximum(np.bincount(row, minlength=len(own)), 1)
                mean = np.stack([np.bincount(row, vectors[used, d], len(own)) for d in range(size)], 1) / sizes[:, None]
                logits = mean @ softmax + bias
                p = np.exp(logits - logits.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(own)), label[own].astype(int)] -= 1
                back = (p @ softmax.T) / sizes[:, None]
                touched, where = np.unique(used, return_inverse=True)
                step = np.stack([np.bincount(where, back[row, d], len(touched)) for d in range(size)], 1)
                gathered[touched] += (step**2).sum(1)
                vectors[touched] -= rate * step / np.sqrt(gathered[touched])[:, None]
                softmax -= rate * 0.1 * (mean.T @ p) / len(own)
                bias -= rate * 0.1 * p.mean(0)
        weight = vectors @ (softmax[:, 1] - softmax[:, 0])
        value = found.means(weight)
    model = Model(weight.astype(np.float32), float(bias[1] - bias[0]), 1.0, 0.0)
    slope, level = _curve(model.highest(texts), toxic)
    return Model(model.weight, model.bias, slope, level)


def _curve(x: np.ndarray, toxic: np.ndarray, steps: int = 50, ridge: float = 1e-2) -> tuple[float, float]:
    """Logistic regression of the label on one number, by Newton's steps."""
    spread = x.std() or 1.0
    rows = np.stack([(x - x.mean()) / spread, np.ones(len(x))], 1)
    w = np.zeros(2)
    for _ in range(steps):
        p = _sigmoid(rows @ w)
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + ridge * np.eye(2)
        w -= np.linalg.solve(hessian, rows.T @ (p - toxic) + ridge * w)
    return float(w[0] / spread), float(w[1] - w[0] * x.mean() / spread)


# --- Spark -----------------------------------------------------------------


def learn(
    docs: DataFrame,
    labels: DataFrame,
    *,
    where: Column | None = None,
    toxic_rows: int = 1500,
    clean_rows: int = 2500,
    chars_per_row: int = 8_000,
    longest_share: int = 16,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> Model:
    """A model from a bounded sample of labelled rows, by smallest hash of the id.

    At most ``toxic_rows`` and ``clean_rows`` rows of the two labels reach the
    driver, and ``chars_per_row`` times as many characters.  Texts are whole, as a label is of all
    of a text: rows beyond that many characters, and those that alone hold over
    a ``longest_share``th of them, are left out.  ``where`` is a condition on
    ``labels``.  NULL ids and labels teach nothing.
    """
    known = labels.select(F.col(id_column).alias("__id"), (F.col(label_column) == 1).alias("__toxic"))
    if where is not None:
        known = labels.where(where).select(F.col(id_column).alias("__id"), (F.col(label_column) == 1).alias("__toxic"))
    limit = F.when(F.col("__toxic"), toxic_rows).otherwise(clean_rows)
    place = Window.partitionBy("__toxic").orderBy(F.xxhash64("__id"), "__id")
    top = max(toxic_rows, clean_rows)

    def sample(rows: DataFrame, order) -> DataFrame:
        ranked = rows.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= top)
        return ranked.where(F.col("__place") <= limit).drop("__place")

    chosen = sample(known.where("__id IS NOT NULL AND __toxic IS NOT NULL").distinct(), place)
    texts = docs.select(F.col(id_column).alias("__id"), F.col(text_column).cast("string").alias("__text"))
    chars = limit * F.lit(chars_per_row)
    rows = texts.join(F.broadcast(chosen), "__id").where(F.length("__text") * F.lit(longest_share) <= chars)  # a few thousand ids
    order = Window.partitionBy("__toxic").orderBy(F.xxhash64("__id"), "__id", "__text")
    rows = sample(rows, order)
    upto = F.sum(F.length("__text")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("__upto", upto).where(F.col("__upto") <= chars).drop("__upto")
    found = rows.orderBy("__id", "__toxic", "__text").collect()
    return train([r["__text"] for r in found], np.array([r["__toxic"] for r in found], bool))


def score(
    docs: DataFrame, model: Model, *, text_column: str = "text", score_column: str = "score", predicted_column: str = "predicted"
) -> DataFrame:
    """``docs`` without the text, with a probability and whether it is at least a half (1 or 0).

    Whole texts are scored, all stretches of them.  NULL and empty texts have
    the score of a text without words.  Columns of the results' names are
    replaced, others and repeated rows are passed on, and an empty table gives no rows.  A very
    long text is scored in one piece, at some hundred bytes of memory per character.
    """
    kept = [c for c in docs.columns if c not in (text_column, score_column, predicted_column)]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.probabilities(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(found, pa.float64()), pa.array(found >= 0.5).cast(pa.int32())],
                names=[*kept, score_column, predicted_column],
            )

    schema = docs.select(kept).schema.add(score_column, "double").add(predicted_column, "integer")
    return docs.select(F.col(text_column).cast("string"), *kept).mapInArrow(run, schema)
