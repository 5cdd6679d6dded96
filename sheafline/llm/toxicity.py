"""Toxicity scores from averaged subword embeddings and a linear softmax.

Words are bags of hashed character n-grams, so a misspelling shares most vectors
with the word it hides.  The embeddings and the softmax are trained together in
numpy.  A long document is mostly harmless words, so the model averages over windows
of a few words; which windows of a toxic document carry the label is learned by
alternating: train, keep the worst window of each toxic document, train again.  A small
logistic layer turns the window values of a document into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.llm.common import bounded_batches, without, written

THRESHOLD = 0.3
WINDOW = 12
GRAMS = (3, 4, 5)
BUCKETS = 1 << 16
DIMENSION = 4
# The training sample: about so many documents of each class, picked by a hash of
# their id, about so many characters of them, and no document above the last bound.
SAMPLE_DOCUMENTS = {1: 1200, 0: 1800}
SAMPLE_CHARACTERS = 5_000_000
SAMPLE_LONGEST = 100_000
# Words remembered per task, and words looked up at a time.
CACHE_WORDS = 300_000
LOOKUP_WORDS = 50_000
# N-grams of about so few toxic documents are learned more slowly.
RARE_DOCUMENTS = 8
SEED = 20240229

_STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…–—¡¿"


# Odd multipliers of the n-gram hash, one per position.
_STEPS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


def plain(word):
    return word.lower().strip(_STRIP)


def word_buckets(words):
    """(bucket, number of the word) of every feature of ``words``.

    A word's features are itself and the 3- to 5-byte pieces of ``<word>`` in UTF-8,
    hashed for all words at once.
    """
    coded = [b"<" + plain(w).encode("utf-8", "replace") + b">" for w in words]
    sizes = np.array([len(c) for c in coded], dtype=np.int64)
    data = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint64) + np.uint64(1)
    start = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(words)), sizes)
    offset = np.arange(len(data)) - start[word]
    left = sizes[word] - offset
    whole = np.add.reduceat(data * _STEPS[offset % 64] * (offset // 64 * 2 + 1).astype(np.uint64), start)
    hashes, owners = [whole], [np.arange(len(words))]
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        piece = np.full(len(at), n, np.uint64)
        for i in range(n):
            piece += data[at + i] * _STEPS[i + 8]
        hashes.append(piece)
        owners.append(word[at])
    mixed = np.concatenate(hashes)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(40)).astype(np.int64) % BUCKETS, np.concatenate(owners)


def told_apart(words):
    """``words`` without repetitions of the word just before: a stutter is one word."""
    return [w for i, w in enumerate(words) if i == 0 or w != words[i - 1]]


def windows(n):
    """Bounds of the windows over ``n`` words; the last one reaches back to be full."""
    starts = np.arange(0, max(1, n - WINDOW + 1), WINDOW // 2)
    if n > WINDOW and starts[-1] + WINDOW < n:
        starts = np.append(starts, n - WINDOW)
    return starts, np.minimum(starts + WINDOW, n)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def _summary(values):
    """Document features from window values: the worst, the mean of the worst four, the count."""
    if len(values) == 0:
        return [0.0, 0.0, 0.0]
    top = np.sort(values)[::-1][:4]
    return [float(top[0]), float(top.mean()), float(np.log(len(values)))]


class _Adam:
    """Adam steps.  ``damping`` shortens the steps of weights whose gradient is small next to
    the largest one: n-grams of one document would otherwise be learned by heart."""

    def __init__(self, shape, rate, damping=0.0):
        self.m, self.v, self.t, self.rate, self.damping = np.zeros(shape), np.zeros(shape), 0, rate, damping

    def step(self, weights, grad):
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * grad
        self.v = 0.999 * self.v + 0.001 * grad**2
        floor = self.damping * np.abs(grad).max() if self.damping else 1e-8
        weights -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + floor + 1e-12)


class _Bags:
    """Windows of the training documents as index arrays."""

    def __init__(self, texts):
        number, ids, bounds, self.owner = {}, [], [np.zeros((0, 2), np.int64)], []
        for doc, text in enumerate(texts):
            words = told_apart(text.split())
            if not words:
                continue
            low, high = windows(len(words))
            bounds.append(np.stack([low, high], 1) + len(ids))
            self.owner += [doc] * len(low)
            ids += [number.setdefault(w, len(number)) for w in words]
        self.ids = np.array(ids, dtype=np.int64)
        self.bounds, self.owner = np.concatenate(bounds), np.array(self.owner, dtype=np.int64)
        self.flat, self.word = word_buckets(list(number)) if number else (np.zeros(0, np.int64),) * 2
        self.sizes = np.bincount(self.word, minlength=len(number))

    def _window_sums(self, per_word):
        total = np.concatenate([np.zeros((1, per_word.shape[1])), np.cumsum(per_word[self.ids], 0)])
        return total[self.bounds[:, 1]] - total[self.bounds[:, 0]]

    def averages(self, vectors):
        words = np.stack([np.bincount(self.word, v[self.flat], len(self.sizes)) for v in vectors.T], 1)
        self.count = self._window_sums(self.sizes[:, None].astype(float))
        return self._window_sums(words) / self.count

    def back(self, grad):
        """Gradient of the bucket vectors from the gradient of the averages."""
        grad = grad / self.count
        delta = np.zeros((len(self.ids) + 1, grad.shape[1]))
        for d in range(grad.shape[1]):
            delta[:, d] = np.bincount(self.bounds[:, 0], grad[:, d], len(self.ids) + 1)
            delta[:, d] -= np.bincount(self.bounds[:, 1], grad[:, d], len(self.ids) + 1)
        per_place = np.cumsum(delta[:-1], 0)
        out = np.empty((BUCKETS, grad.shape[1]))
        for d in range(grad.shape[1]):
            per_word = np.bincount(self.ids, per_place[:, d], len(self.sizes))
            out[:, d] = np.bincount(self.flat, per_word[self.word], BUCKETS)
        return out


def _fit_windows(bags, toxic, rounds):
    """Train embeddings and softmax together; returns per-bucket values and the bias."""
    rng = np.random.default_rng(SEED)
    vectors = rng.normal(0, 0.1, (BUCKETS, DIMENSION))
    weights, bias = rng.normal(0, 0.5, (DIMENSION, 2)), np.zeros(2)
    damping = min(0.3, RARE_DOCUMENTS / max(1, toxic.sum()))
    moves = [(_Adam(vectors.shape, 0.4, damping), vectors), (_Adam(weights.shape, 0.05), weights), (_Adam(2, 0.05), bias)]
    label = toxic[bags.owner]
    chosen = np.ones(len(label), bool)
    for round_, steps in enumerate(rounds):
        positive = label & chosen
        share = np.where(positive, 0.5 / max(1, positive.sum()), np.where(label, 0.0, 0.5 / max(1, (~label).sum())))
        for _ in range(steps):
            average = bags.averages(vectors)
            z = average @ weights + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            slope = (p - np.stack([~label, label], 1)) * share[:, None]
            grads = (bags.back(slope @ weights.T), average.T @ slope, slope.sum(0))
            for (adam, value), grad in zip(moves, grads):
                adam.step(value, grad)
        value = bags.averages(vectors) @ (weights[:, 1] - weights[:, 0])
        if round_ + 1 < len(rounds):
            worst = np.full(len(toxic), -np.inf)
            np.maximum.at(worst, bags.owner, value)
            chosen = value >= worst[bags.owner]
    return vectors @ (weights[:, 1] - weights[:, 0]), float(bias[1] - bias[0])


def _fit_layer(x, y, weight):
    """Weighted logistic regression by Newton steps with a small ridge."""
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-6] = 1.0  # a constant feature says nothing
    z = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], 1)
    w = np.zeros(z.shape[1])
    for _ in range(25):
        p = _sigmoid(z @ w)
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(hessian, z.T @ (weight * (p - y)) + 1e-2 * w)
    return np.concatenate([w[:-1] / scale, [w[-1] - (w[:-1] * mean / scale).sum()]])


class ToxicityModel:
    """One value per n-gram bucket, a bias, and the document layer."""

    def __init__(self, values, bias, layer):
        self.values, self.bias, self.layer = values.astype(np.float32), bias, layer

    @classmethod
    def train(cls, texts, labels, class_weight=(1.0, 1.0)):
        """Fit on texts with 0/1 labels; ``class_weight`` undoes the sampling of a class.

        Two thirds of the texts train the windows and the rest the document layer,
        which would otherwise see values the windows have memorised.
        """
        toxic = np.array(labels, dtype=bool)
        if not toxic.any() or toxic.all():
            rate = float(toxic.mean()) if len(toxic) else 0.0
            odds = np.log((rate * 0.98 + 0.01) / (1 - rate * 0.98 - 0.01))
            return cls(np.zeros(BUCKETS), 0.0, np.array([0.0, 0.0, 0.0, odds]))
        place = np.arange(len(toxic))
        apart = place % 3 == 2 if min(toxic.sum(), (~toxic).sum()) >= 30 else np.zeros(len(toxic), bool)
        first = place[~apart]
        values, bias = _fit_windows(_Bags([texts[i] for i in first]), toxic[first], (12, 12, 12))
        model = cls(values, bias, None)
        rest = place[apart] if apart.any() else place
        scores = WordValues(model)
        x = scores.summaries([texts[i] for i in rest])
        weight = np.where(toxic[rest], class_weight[1], class_weight[0])
        model.layer = _fit_layer(x, toxic[rest].astype(float), weight / weight.mean())
        return model


class WordValues:
    """Sum of bucket values and number of buckets per word, remembered between texts."""

    def __init__(self, model):
        self.model, self.place = model, {}
        self.sums, self.sizes = np.zeros(0), np.zeros(0)

    def learn(self, words):
        """Look up the words not seen yet."""
        seen = dict.fromkeys(words)
        if len(self.place) > CACHE_WORDS:
            self.place, self.sums, self.sizes = {}, np.zeros(0), np.zeros(0)
        new = [w for w in seen if w not in self.place]
        if not new:
            return
        buckets, owner = word_buckets(new)
        self.place.update(zip(new, range(len(self.sums), len(self.sums) + len(new))))
        self.sums = np.concatenate([self.sums, np.bincount(owner, self.model.values[buckets], len(new))])
        self.sizes = np.concatenate([self.sizes, np.bincount(owner, minlength=len(new))])

    def windows(self, words):
        """Value of each window; every word must have been learned."""
        if not words:
            return np.zeros(0)
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        at = at[np.concatenate([[True], at[1:] != at[:-1]])]
        low, high = windows(len(at))
        sums, sizes = (np.concatenate([[0.0], np.cumsum(v[at])]) for v in (self.sums, self.sizes))
        return (sums[high] - sums[low]) / (sizes[high] - sizes[low]) + self.model.bias

    def summaries(self, texts):
        """Document features, looking words up for some texts at a time."""
        out, batch, size = [], [], 0
        for i, text in enumerate(texts):
            words = (text or "").split()
            batch.append(words)
            size += len(words)
            if size >= LOOKUP_WORDS or i + 1 == len(texts):
                self.learn(w for words in batch for w in words)
                out += [_summary(self.windows(words)) for words in batch]
                batch, size = [], 0
        return np.array(out).reshape(-1, 3)

    def score(self, texts):
        return _sigmoid(self.summaries(texts) @ self.model.layer[:-1] + self.model.layer[-1])


def fit(docs, labels, doc_id="doc_id", text="text", label="toxic"):
    """Train on a bounded sample of the documents that ``labels`` covers.

    A first pass counts documents and characters of each class, without moving text;
    the share of labels whose hash passes then follows from the bounds above, so the
    sample does not grow with the tables, and only its texts are joined.  Rows without
    text, or with a label other than 0 and 1, are left out; with no rows, or one class
    only, the model gives every document the same score.
    """
    told = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where("label IN (0, 1)")
    rows = docs.select(F.col(doc_id).alias("id"), F.make_valid_utf8(F.col(text)).alias("text"))
    usable = rows.where(F.length("text") <= SAMPLE_LONGEST)
    totals = (
        usable.select("id", F.length("text").alias("size")).join(told, "id")
        .groupBy("label").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()
    )
    share = {r["label"]: min(1.0, SAMPLE_DOCUMENTS[r["label"]] / r["n"], SAMPLE_CHARACTERS / max(1, r["size"])) for r in totals}
    limit = F.coalesce(*[F.when(F.col("label") == k, F.lit(int(v * (1 << 20)))) for k, v in share.items()], F.lit(0))
    picked = written(told.where(F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 20)) < limit), "labelled-sample")
    # About SAMPLE_DOCUMENTS ids whatever the input, so the texts need not move to meet them.
    sample = [(r["text"], r["label"]) for r in usable.join(F.broadcast(picked), "id").select("text", "label").collect()]
    sample.sort()
    np.random.default_rng(SEED).shuffle(sample)
    weight = tuple(1.0 / share[k] if share.get(k) else 1.0 for k in (0, 1))
    return ToxicityModel.train([s[0] for s in sample], [s[1] for s in sample], weight)


def _scorer(spark, model):
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        values = WordValues(shared.value)
        for text in parts:
            yield pd.Series(values.score(list(text)))

    return scored


def score(docs, model, text="text", threshold=THRESHOLD):
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Every window of every whole text counts.  Null and empty texts get the score of a
    document without windows; bytes that are not UTF-8 count as replacement characters;
    repeated rows get equal scores; columns with these names are replaced.  Only the text is an input.  Narrow; the broadcast model has a fixed size.
    """
    scored = _scorer(bounded_batches(docs).sparkSession, model)(F.coalesce(F.make_valid_utf8(F.col(text)), F.lit("")))
    out = without(docs, "score", "predicted").withColumn("score", scored)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs, model, text="text", threshold=THRESHOLD):
    """``docs`` with a score below ``threshold``, all columns as they are."""
    scored = _scorer(bounded_batches(docs).sparkSession, model)(F.coalesce(F.make_valid_utf8(F.col(text)), F.lit("")))
    return docs.withColumn("__toxicity", scored).where(F.col("__toxicity") < threshold).drop("__toxicity")
