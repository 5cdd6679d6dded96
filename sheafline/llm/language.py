"""Language identification with character language models.

One interpolated Kneser-Ney model per language over the characters of single words.
Spark counts the character n-grams of all learnable documents and derives adjusted
counts, discounts and back-off weights, held in one sorted hash array with a column per
language.  Where the n-grams of a language are more than a broadcast may hold, those below
a count go, and what they held of a context falls to its back-off, so that every
context still sums to one.  A text goes to the language with the lowest cross-entropy per
character, and is marked as rejected when even that one is higher than a calibrated bound
for a text of its length; the calibration takes every learnable document.
"""

from __future__ import annotations

import copy
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sheafline.llm.common import bounded_batches, held_out, without, written
from sheafline.session import temporary_folders

ORDER = 4
EDGE = " "
UNDETERMINED = "und"
# Longer runs of letters (scripts without spaces) are modelled in pieces of this length.
PIECE = 32
# Most n-grams a model may hold, over all languages together; about 20 bytes each and language.
MODEL_TOTAL = 3_000_000
# Counts up to this have bins of their own; above, each doubling has so many bins.
EXACT = 1024
BINS_PER_DOUBLING = 64
# Tail of the documents learned from that the calibration rejects, and the sharpnesses it tries.
REJECTED_TAIL = 0.001
HEATS = tuple(2.0**k for k in range(-4, 7))
# Bins of the calibration's histograms, to a unit of the inverse hyperbolic sine: absolute
# around 0, relative far from it.
CALIBRATION_BINS = 1 << 14
# Characters beyond which a text's own topic, not its length, decides how far it strays.
STRAY = 400
# Distinct words held per language while counting, and remembered while scoring.
COUNT_WORDS = 100_000
CACHE_WORDS = 300_000
LOOKUP_WORDS = 50_000

_NOT_LETTERS = {c: " " for c in range(0x250) if not chr(c).isalpha()}
_ASCII_LETTERS = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(0x100))


def raw_parts(text):
    """Lower-case text cut at all ASCII characters but letters, as UTF-8."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_ASCII_LETTERS).split()


def words_of(part):
    """Words of one part: it may still hold signs and spaces beyond ASCII."""
    if part.isascii():
        return [part.decode("ascii")]
    words = part.decode("utf-8", "surrogatepass").translate(_NOT_LETTERS).split()
    return [w for w in words if w.isalpha() or any(map(str.isalpha, w))]


def letter_words(text):
    """Lower-case runs of letters; marks beyond Latin stay inside their word."""
    return [w for part in raw_parts(text) for w in words_of(part)]


def pieces(word):
    return [word[i : i + PIECE] for i in range(0, len(word), PIECE)]


def coded(words):
    """Code points of `` word word ... `` with an edge on both sides of each word.

    Returns the points, the number of the word at each place, and the offset in it.
    """
    sizes = np.array([len(w) + 2 for w in words], dtype=np.int64)
    text = EDGE + (EDGE + EDGE).join(words) + EDGE
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), sizes)
    return points, word, np.arange(len(points)) - (np.cumsum(sizes) - sizes)[word]


def gram_hash(points, at, n):
    """64-bit hash of the ``n`` characters that end at each place."""
    h = np.full(len(at), n * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for back in range(n):
        h = (h ^ points[at - back]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    return h


def gram_counts(words, weights):
    """(n-gram, count) of all n-grams inside the edged words, each word counted ``weights`` times."""
    points, word, offset = coded(words)
    weights = np.asarray(weights, dtype=np.float64)
    grams, counts = [], []
    for n in range(1, ORDER + 1):
        at = np.flatnonzero(offset >= max(n - 1, 1))
        _, first, group = np.unique(gram_hash(points, at, n), return_index=True, return_inverse=True)
        counts.append(np.bincount(group, weights[word[at]]))
        places = at[first]
        cells = np.stack([points[places - back].astype(np.uint32) for back in range(n - 1, -1, -1)], 1)
        grams += np.ascontiguousarray(cells).view(f"<U{n}")[:, 0].tolist()
    return grams, np.concatenate(counts).astype(np.int64)


def _count_partition(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen = defaultdict(Counter)

    def emit(lang):
        words = Counter()
        for part, n in seen.pop(lang).items():
            for word in words_of(part):
                for piece in pieces(word):
                    words[piece] += n
        if words:
            grams, counts = gram_counts(list(words), list(words.values()))
            yield pd.DataFrame({"lang": lang, "gram": grams, "n": counts})

    for frame in frames:
        for lang, text in zip(frame["lang"], frame["text"]):
            seen[lang].update(raw_parts(text))
            if len(seen[lang]) >= COUNT_WORDS:
                yield from emit(lang)
    for lang in list(seen):
        yield from emit(lang)


def adjusted_counts(learn):
    """(lang, gram, size, ctx, n, adj) over all rows of ``learn`` (lang, text).

    The highest order and n-grams at the start of a word keep their counts; for any
    other, ``adj`` is the number of different characters seen before it.
    """
    partial = learn.mapInPandas(_count_partition, "lang string, gram string, n long")
    size = F.char_length("gram")
    grams = written(partial.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams").withColumn("size", size)
    longer = grams.where("size > 1").select("lang", F.expr("substring(gram, 2)").alias("gram"))
    before = longer.groupBy("lang", "gram").agg(F.count("*").alias("before"))
    raw = (F.col("size") == ORDER) | F.startswith("gram", F.lit(EDGE)) & (F.col("size") > 1)
    return grams.join(before, ["lang", "gram"], "left").select(
        "lang", "gram", "size", "n",
        F.expr("substring(gram, 1, size - 1)").alias("ctx"),
        F.when(raw, F.col("n")).otherwise(F.coalesce("before", "n")).alias("adj"),
    )


def least_counts(counts, total=MODEL_TOTAL):
    """{language: count} an n-gram needs to be kept, so that at most ``total`` are over all languages.

    From the histogram of counts, a bounded number of rows per language: the most frequent
    bins of each language, as long as they fit into its share.
    """
    above = F.floor((F.log2(F.greatest("n", F.lit(EXACT))) - np.log2(EXACT)) * BINS_PER_DOUBLING) + EXACT + 1
    bins = counts.groupBy("lang", F.when(F.col("n") <= EXACT, F.col("n")).otherwise(above).alias("bin"))
    found = defaultdict(list)
    for row in bins.agg(F.count("*").alias("grams"), F.min("n").alias("least")).collect():
        found[row["lang"]].append((row["least"], row["grams"]))
    least = {}
    for lang, histogram in found.items():
        room, least[lang] = total // len(found), max(n for n, _ in histogram) + 1
        for n, grams in sorted(histogram, reverse=True):
            room -= grams
            if room < 0:
                break
            least[lang] = n
    return least


def model_rows(counts, least):
    """(lang, gram, alpha, weight): discounted share in its context, back-off weight as a context.

    Discounts follow from the numbers of n-grams seen once and twice, per language and
    size.  Only n-grams with the ``least`` count of their language stay (a context is never
    rarer than what follows it); the weight of a context is what they leave of it.
    """
    ones = counts.groupBy("lang", "size").agg(
        F.sum((F.col("adj") == 1).cast("long")).alias("n1"), F.sum((F.col("adj") == 2).cast("long")).alias("n2")
    )
    discount = F.coalesce(F.try_divide("n1", F.col("n1") + 2 * F.col("n2")), F.lit(0.5))
    rates = ones.select("lang", "size", F.least(F.greatest(discount, F.lit(0.1)), F.lit(0.95)).alias("d"))
    context = (
        counts.groupBy("lang", "size", "ctx").agg(F.sum("adj").alias("total")).join(rates, ["lang", "size"]).drop("size")
    )
    enough = F.lit(False)
    for lang, n in least.items():
        enough = enough | (F.col("lang") == lang) & (F.col("n") >= n)
    alpha = counts.where(enough).join(context, ["lang", "ctx"]).select(
        "lang", "ctx", "gram", (F.greatest(F.col("adj") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("alpha")
    )
    left = alpha.groupBy("lang", F.col("ctx").alias("gram")).agg(
        F.greatest(1 - F.sum("alpha"), F.lit(0.0)).alias("weight")
    )
    return alpha.drop("ctx").join(left, ["lang", "gram"], "full").select(
        "lang", "gram", F.coalesce("alpha", F.lit(0.0)).alias("alpha"), F.coalesce("weight", F.lit(1.0)).alias("weight")
    )


class LanguageModel:
    """Sorted n-gram hashes with share and back-off weight per language."""

    def __init__(self, frame):
        self.langs = sorted(set(frame["lang"]))
        column = frame["lang"].map({lang: i for i, lang in enumerate(self.langs)}).to_numpy(np.int64)
        hashes = np.zeros(len(frame), np.uint64)
        sizes = frame["gram"].str.len().to_numpy()
        for n in range(1, ORDER + 1):
            at = np.flatnonzero(sizes == n)
            points = np.frombuffer("".join(frame["gram"].iloc[at]).encode("utf-32-le", "replace"), np.uint32)
            hashes[at] = gram_hash(points.astype(np.uint64), np.arange(n - 1, n * len(at), n), n)
        shape = (len(self.langs),)
        self.hashes, row = np.unique(hashes[sizes > 0], return_inverse=True)
        self.alpha = np.zeros((len(self.hashes) + 1, *shape), np.float32)  # the last row: not kept
        self.weight = np.ones((len(self.hashes) + 1, *shape), np.float32)
        some = frame[sizes > 0]
        self.alpha[row, column[sizes > 0]] = some["alpha"]
        self.weight[row, column[sizes > 0]] = some["weight"]
        self.root = np.ones(shape, np.float32)
        none = frame[sizes == 0]
        self.root[column[sizes == 0]] = none["weight"]
        letters = frame[sizes == 1].groupby("lang").size()
        self.floor = 1.0 / (1.0 + np.array([letters.get(lang, 0) for lang in self.langs], dtype=float).max(initial=1))
        self.mean, self.spread, self.bound, self.heat = np.zeros(shape), np.ones(shape), np.inf, 1.0

    def log_probability(self, words):
        """(word, language) sums of the natural log probability of each character and the end."""
        points, word, offset = coded(words)
        p = self.root * self.floor
        p = np.broadcast_to(p, (len(points), len(self.langs))).copy()
        before = None
        for n in range(1, ORDER + 1):
            h = gram_hash(points, np.arange(n - 1, len(points)), n)
            at = np.searchsorted(self.hashes, h)
            at[at == len(self.hashes)] = 0
            here = np.full(len(points), len(self.hashes))
            if len(self.hashes):
                here[n - 1 :] = np.where(self.hashes[at] == h, at, len(self.hashes))
            fits = np.flatnonzero(offset >= max(n - 1, 1))
            weight = 1.0 if before is None else self.weight[before[fits - 1]]
            p[fits] = self.alpha[here[fits]] + weight * p[fits]
            before = here
        logs = np.log(np.maximum(p, 1e-12))
        logs[offset == 0] = 0.0
        starts = np.flatnonzero(offset == 0)
        return np.add.reduceat(logs, starts, axis=0)

    def decide(self, entropy, n):
        """(language, score, rejected) of texts from their cross-entropies and character counts."""
        entropy, n = np.asarray(entropy), np.asarray(n, dtype=float)
        best = entropy.argmin(1)
        lead = -self.heat * np.sqrt(n)[:, None] * (entropy - entropy.min(1, keepdims=True))
        share = np.exp(np.maximum(lead, -700))
        score = share[np.arange(len(n)), best] / share.sum(1)
        return best, score, self.excess(entropy, best, n) > self.bound

    def excess(self, entropy, which, n):
        """How far the entropy under a language is above its mean, in spreads for that length."""
        return (entropy[np.arange(len(n)), which] - self.mean[which]) / self.spread[which] * np.sqrt(n / (1 + n / STRAY))

    def without_grams(self):
        """A copy that holds only what :meth:`decide` needs."""
        small = copy.copy(self)
        small.hashes = small.alpha = small.weight = None
        return small


class WordEntropies:
    """Part of a text -> log probability per language and length, remembered between texts."""

    def __init__(self, model):
        self.model = model
        self._reset()

    def _reset(self):
        self.place, self.logs = {}, np.zeros((0, len(self.model.langs)))
        self.sizes = np.zeros(0)

    def _learn(self, parts):
        if len(self.place) > CACHE_WORDS:
            self._reset()
        new = [p for p in dict.fromkeys(parts) if p not in self.place]
        if not new:
            return
        split = [[p for word in words_of(part) for p in pieces(word)] for part in new]
        owner = np.repeat(np.arange(len(new)), [len(s) for s in split])
        flat = [p for s in split for p in s]
        logs, size = np.zeros((len(new), len(self.model.langs))), np.zeros(len(new))
        if flat:
            np.add.at(logs, owner, self.model.log_probability(flat))
            size = np.bincount(owner, [len(p) + 1 for p in flat], len(new))
        self.place.update(zip(new, range(len(self.sizes), len(self.sizes) + len(new))))
        self.logs, self.sizes = np.concatenate([self.logs, logs]), np.concatenate([self.sizes, size])

    def entropies(self, texts):
        """Cross-entropy per character and language, and the number of characters; 0 without letters."""
        entropy, size = np.zeros((len(texts), len(self.model.langs))), np.zeros(len(texts))
        batch, total = [], 0
        for i, text in enumerate(texts):
            parts = raw_parts(text or "")
            batch.append((i, parts))
            total += len(parts)
            if total >= LOOKUP_WORDS or i + 1 == len(texts):
                self._learn(p for _, parts in batch for p in parts)
                for j, parts in batch:
                    at = np.fromiter(map(self.place.__getitem__, parts), np.int64, len(parts))
                    size[j] = self.sizes[at].sum()
                    if size[j]:
                        entropy[j] = -self.logs[at].sum(0) / size[j]
                batch, total = [], 0
        return entropy, size


def learnable(docs, doc_id="doc_id", text="text", lang="lang"):
    """Rows with text and language that are not held out."""
    return docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & ~held_out(doc_id))


def train(docs, doc_id="doc_id", text="text", lang="lang"):
    """The model of all learnable rows, not calibrated.

    Counting shuffles (lang, n-gram, count), combined per task first; at most MODEL_TOTAL
    n-grams reach the driver.
    """
    learn = learnable(bounded_batches(docs), doc_id, text, lang)
    texts = learn.select(F.col(lang).alias("lang"), F.make_valid_utf8(F.col(text)).alias("text"))
    with temporary_folders(docs.sparkSession):
        counts = written(adjusted_counts(texts), "language-counts")
        frame = model_rows(counts, least_counts(counts)).toPandas()
    return LanguageModel(frame)


def with_entropies(docs, model, text="text"):
    """``docs`` with ``__entropy`` (cross-entropy per character, by language) and ``__n`` (characters).  Narrow."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("__entropy array<double>, __n double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = WordEntropies(shared.value)
        for part in parts:
            entropy, n = words.entropies(list(part))
            yield pd.DataFrame({"__entropy": list(entropy), "__n": n})

    whole = F.coalesce(F.make_valid_utf8(F.col(text)), F.lit(""))
    found = bounded_batches(docs).withColumn("__found", scored(whole))
    return found.select("*", "__found.*").drop("__found")


def quantiles(rows, value, share, by):
    """{key: (quantile, number of rows)} of ``value``, over all rows.

    From a histogram with a bounded number of bins per key, each known by its least value:
    exact where a bin holds one value, else too low by less than a bin.
    """
    bins = rows.groupBy(by.alias("key"), F.floor(F.asinh(value) * CALIBRATION_BINS).alias("bin"))
    found = defaultdict(list)
    for row in bins.agg(F.min(value).alias("least"), F.count("*").alias("rows")).collect():
        found[row["key"]].append((row["least"], row["rows"]))
    quantile = {}
    for key, histogram in found.items():
        values, counts = map(np.array, zip(*sorted(histogram)))
        ends = counts.cumsum()
        place = share * (ends[-1] - 1)
        low, high = values[np.searchsorted(ends, [np.floor(place), np.ceil(place)], side="right")]
        quantile[key] = float(low + (high - low) * (place % 1)), int(ends[-1])
    return quantile


def calibrated(model, scored, lang="lang"):
    """The model with means, spreads, rejection bound and sharpness from all rows of ``scored``.

    ``scored`` are learnable rows of :func:`with_entropies`; it is read three times.  Each
    language has a median and a median deviation, found from histograms like the bound.
    """
    model = copy.copy(model)
    if not model.langs:
        return model
    place = F.array_position(F.array(*map(F.lit, model.langs)), F.col(lang))
    known = scored.where((F.col("__n") > 0) & (place > 0)).select(
        (place - 1).cast("int").alias("truth"), F.col("__entropy").alias("entropy"), F.col("__n").alias("n")
    )
    known = known.withColumn("own", F.get("entropy", F.col("truth")))
    reach = F.sqrt(F.col("n") / (1 + F.col("n") / STRAY))
    model.mean, model.spread = model.mean.copy(), model.spread.copy()

    def by_language(values):
        return F.get(F.array(*map(F.lit, values.tolist())), F.col("truth"))

    enough = {i: q for i, (q, rows) in quantiles(known, F.col("own"), 0.5, F.col("truth")).items() if rows >= 3}
    for i, middle in enough.items():
        model.mean[i] = middle
    off = F.col("own") - by_language(model.mean)
    for i, (middle, _) in quantiles(known, F.abs(off) * reach, 0.5, F.col("truth")).items():
        if i in enough:
            model.spread[i] = max(middle * 1.4826, 1e-3)
    excess = off / by_language(model.spread) * reach
    found = quantiles(known, excess, 1 - REJECTED_TAIL, F.lit(0))
    if not found:
        return model
    model.bound = found[0][0]
    low = F.array_min("entropy")

    def cost(heat):
        def lead(entropy):
            return -heat * F.sqrt("n") * (entropy - low)

        shares = F.transform("entropy", lambda e: F.exp(F.greatest(lead(e), F.lit(-700.0))))
        return F.avg(F.log(F.aggregate(shares, F.lit(0.0), lambda total, share: total + share)) - lead(F.col("own")))

    costs = known.agg(*[cost(heat).alias(f"cost{i}") for i, heat in enumerate(HEATS)]).first()
    model.heat = HEATS[int(np.argmin(list(costs)))]
    return model


def fit(docs, doc_id="doc_id", text="text", lang="lang"):
    """Train and calibrate on every row with text and language that is not held out.

    Texts are read twice, to count and to score them.  What reaches the driver is bounded:
    at most MODEL_TOTAL n-grams, and histograms.
    """
    model = train(docs, doc_id, text, lang)
    learn = learnable(docs, doc_id, text, lang).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    with temporary_folders(docs.sparkSession):
        scored = written(with_entropies(learn, model).drop("text"), "language-scores")
        return calibrated(model, scored)


def _verdicts(model, entropy, n):
    """RESULT of texts from their cross-entropies and character counts."""
    langs, scores = np.full(len(n), UNDETERMINED, dtype=object), np.zeros(len(n))
    rejections, lowest = np.ones(len(n), bool), np.full(len(n), np.nan)
    some = np.flatnonzero(n > 0)
    if len(some) and model.langs:
        best, scores[some], rejections[some] = model.decide(entropy[some], n[some])
        langs[some] = np.array(model.langs, dtype=object)[best]
        lowest[some] = entropy[some, best]
    out = pd.DataFrame({"score": scores, "rejected": rejections, "cross_entropy": lowest})
    out.insert(0, "lang_pred", pd.Series(langs, dtype=object))
    return out


RESULT = "lang_pred string, score double, rejected boolean, cross_entropy double"


def identify(docs, model, text="text"):
    """``docs`` with ``lang_pred``, ``score`` (0 to 1), ``rejected`` and ``cross_entropy``.

    ``lang_pred`` is a learned language, or ``und`` with score 0 for texts that are null
    or have no letter, and for every text when nothing was learned.  Whole texts count and
    only they are looked at; ties go to the language that sorts first; repeated rows repeat;
    columns with these names are replaced.  Narrow; the broadcast model is bounded by
    MODEL_TOTAL n-grams.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def predicted(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        words = WordEntropies(model)
        for part in parts:
            yield _verdicts(model, *words.entropies(list(part)))

    names = [part.split()[0] for part in RESULT.split(", ")]
    found = without(bounded_batches(docs), *names, "__found").withColumn("__found", predicted(F.coalesce(F.make_valid_utf8(F.col(text)), F.lit(""))))
    return found.select("*", *[F.col("__found")[c].alias(c) for c in names]).drop("__found")


def identify_own(docs, doc_id="doc_id", text="text", lang="lang"):
    """:func:`identify` on the rows of ``docs`` with the model :func:`fit` learns from them, without ``text``.

    Each text is scored once, for the calibration and for its result; the scores are written
    as a table.
    """
    model = train(docs, doc_id, text, lang)
    names = [part.split()[0] for part in RESULT.split(", ")]
    rows = without(docs, *names)
    scored = written(with_entropies(rows, model, text).drop(text), "language-scores")
    learned = scored.where(F.col(lang).isNotNull() & ~held_out(doc_id))
    small = calibrated(model, learned, lang).without_grams()

    @F.pandas_udf(RESULT)
    def predicted(entropy: pd.Series, n: pd.Series) -> pd.DataFrame:
        table = np.array(entropy.tolist(), dtype=float).reshape(len(n), len(small.langs))
        return _verdicts(small, table, n.to_numpy())

    found = scored.withColumn("__found", predicted("__entropy", "__n"))
    return found.select(*rows.drop(text).columns, *[F.col("__found")[c].alias(c) for c in names])
