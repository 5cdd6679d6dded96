"""Hard negatives by exact products in a residue number system.

Anchors and rows are whole numbers.  A product of two blocks is made once per prime of a
few below 256: residues are multiplied as float32 matrices, which is exact as long as
a partial sum stays below 2**24, and Chinese remaindering gives the signed scores.  The
number of primes follows from the largest score a pair of blocks can have.

Two passes over (shard of rows, block of anchors) tasks: the first keeps each anchor's
best rows of its own label, the second, for each of these, the best rows of other labels
whose score lies in the window below it.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheafline.llm.common import written

POSITIVES = 5
NEGATIVES = 3
# A negative's score in per cent of the positive's.
LOWEST = 50
HIGHEST = 95
SCALE = 256
# Rows per shard, anchors per block, and both sides of the scores held at once.
SHARD_ROWS = 8192
BLOCK_ANCHORS = 4096
TILE_ROWS = 1024
TILE_ANCHORS = 512
# Residues are below 2**7 in size, so that so many products add up exactly in float32.
PRIMES = [p for p in range(255, 2, -1) if all(p % q for q in range(2, math.isqrt(p) + 1))]
EXACT_TERMS = (1 << 24) // (max(PRIMES) // 2) ** 2
SEED = 29
# Scores are held as longs up to this size; larger ones are cut to it.
MOST = 1 << 62


def scaled(vectors):
    """floor(256 x) of every component, in whole doubles without negative zeros."""
    return np.floor(SCALE * np.array(vectors.tolist(), dtype=np.float64)) + 0.0


def residues(x, prime):
    """Residues of whole doubles, of at most half the prime in size, as float32."""
    rest = np.fmod(x, prime)
    half = prime // 2
    return (rest - prime * (rest > half) + prime * (rest < -half)).astype(np.float32)


def primes_for(bound):
    """The first primes whose product tells apart all whole numbers of at most ``bound`` in size; None if all are too few."""
    product = 1
    for n, prime in enumerate(PRIMES):
        if product > 2 * bound:
            return PRIMES[:n]
        product *= prime
    return None


class Side:
    """One side of products: whole vectors and, once asked for, their residues."""

    def __init__(self, x):
        self.x, self.kept = x, {}

    def peak(self):
        return [int(v) for v in np.abs(self.x).max(0, initial=0.0)]

    def modulo(self, prime):
        if prime not in self.kept:
            self.kept[prime] = residues(self.x, prime)
        return self.kept[prime]


def modular_product(left, right, prime):
    """``left @ right.T`` modulo ``prime`` for float32 residues, as longs from 0."""
    total = 0
    for at in range(0, left.shape[1], EXACT_TERMS):
        part = left[:, at : at + EXACT_TERMS] @ right[:, at : at + EXACT_TERMS].T
        total = total + part.astype(np.int64)
    return total % prime if left.shape[1] else np.zeros((len(left), len(right)), np.int64)


def remaindered(parts, primes):
    """The signed numbers with these residues, digit by digit in the mixed radix of the primes."""
    product = math.prod(primes)
    kind = np.int64 if product < MOST else object
    value, radix = parts[0].astype(kind), primes[0]
    for part, prime in zip(parts[1:], primes[1:]):
        digit = (part - (value % prime).astype(np.int64)) * pow(radix, -1, prime) % prime
        value = value + digit.astype(kind) * radix
        radix *= prime
    signed = np.where(value > product // 2, value - product, value)
    return signed if kind is np.int64 else np.clip(signed, -MOST, MOST).astype(np.int64)


def exact_scores(left, right, rows=slice(None), columns=slice(None), primes=None):
    """Inner products of some rows of two :class:`Side`, as longs."""
    primes = primes or primes_for(sum(a * b for a, b in zip(left.peak(), right.peak())))
    if primes is None:
        # Components of such a size that the primes do not reach: plain whole numbers.
        whole = [np.array([[int(v) for v in row] for row in x], dtype=object) for x in (left.x[rows], right.x[columns])]
        return np.clip(whole[0] @ whole[1].T, -MOST, MOST).astype(np.int64)
    parts = [modular_product(left.modulo(p)[rows], right.modulo(p)[columns], p) for p in primes or [PRIMES[0]]]
    return remaindered(parts, primes or [PRIMES[0]])


def tiles(left, right):
    """(slice of the left rows, slice of the right rows, their scores), in bounded pieces."""
    primes = primes_for(sum(a * b for a, b in zip(left.peak(), right.peak())))
    for i in range(0, len(left.x), TILE_ANCHORS):
        for j in range(0, len(right.x), TILE_ROWS):
            rows, columns = slice(i, i + TILE_ANCHORS), slice(j, j + TILE_ROWS)
            yield rows, columns, exact_scores(left, right, rows, columns, primes)


def best(score, allowed, k):
    """(row, column, score) of the ``k`` highest allowed scores of each row; ties to the first column."""
    score = np.where(allowed, score, -MOST - 1)
    every, found = np.arange(len(score)), []
    for _ in range(min(k, score.shape[1])):
        column = score.argmax(1)
        value = score[every, column]
        some = value >= -MOST
        if not some.any():
            break
        found.append((every[some], column[some], value[some]))
        score[every, column] = -MOST - 1
    return [np.concatenate(part) for part in zip(*found)] if found else [np.zeros(0, np.int64)] * 3


def _by(frame, *keys):
    return {key if len(keys) > 1 else key[0]: part for key, part in frame.groupby(list(keys), sort=False)}


def _leading(frame, group, id_, mark, k):
    """The ``k`` first rows per group by score, then id; what a task sends on."""
    ordered = frame.sort_values([*group, "score", id_, mark], ascending=[True] * len(group) + [False, True, True])
    return ordered.groupby(group, sort=False).head(k)


def usable(vectors, vec_id, vector, label):
    """Rows that take part, each with a mark of its own."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), x.alias("x"), finite.alias("ok")
    )
    kept = rows.where("id IS NOT NULL AND label IS NOT NULL AND ok").drop("ok")
    return written(kept.withColumn("mark", F.monotonically_increasing_id()), "rows")


def _grid(anchors, rows):
    """Both sides dealt to (shard, block) tasks: anchors go to every shard, rows to every block of anchors."""
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    blocks = max(1, -(-anchors.count() // BLOCK_ANCHORS))
    part = lambda n, seed: F.pmod(F.xxhash64("mark", F.lit(SEED + seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("block", part(blocks, 0)).withColumn("shard", every(shards))
    right = rows.withColumn("shard", part(shards, 1)).withColumn("block", every(blocks))
    return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))


POSITIVE_TYPE = "anchor long, anchor_id long, mark long, id long, score long"


def _positives(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
    asked, held = (side.assign(size=side["x"].map(len)) for side in (asked, held.sort_values(["id", "mark"])))
    candidates, out = _by(held, "size", "label"), []
    for key, part in _by(asked, "size", "label").items():
        if key not in candidates:
            continue
        own = candidates[key]
        ids, marks, anchors = own["id"].to_numpy(), own["mark"].to_numpy(), part["id"].to_numpy()
        for rows, columns, score in tiles(Side(scaled(part["x"])), Side(scaled(own["x"]))):
            a, r, value = best(score, anchors[rows, None] != ids[None, columns], POSITIVES)
            out.append(
                pd.DataFrame({
                    "anchor": part["mark"].to_numpy()[rows][a], "anchor_id": anchors[rows][a],
                    "mark": marks[columns][r], "id": ids[columns][r], "score": value,
                })
            )
    if not out:
        return pd.DataFrame({c.split()[0]: [] for c in POSITIVE_TYPE.split(", ")}, dtype="int64")
    return _leading(pd.concat(out), ["anchor"], "id", "mark", POSITIVES)


NEGATIVE_TYPE = (
    "anchor long, anchor_id long, positive long, positive_id long, positive_score long, mark long, id long, score long"
)


def _negatives(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
    asked, held = (side.assign(size=side["x"].map(len)) for side in (asked, held.sort_values(["id", "mark"])))
    candidates, out = _by(held, "size"), []
    for key, part in _by(asked, "size").items():
        if key not in candidates:
            continue
        own = candidates[key]
        ids, marks, labels = (own[c].to_numpy() for c in ("id", "mark", "label"))
        # Positives of each anchor by place; windows without one are empty.
        places = [[dict(p.asDict() if hasattr(p, "asDict") else p) for p in ps] for ps in part["positives"]]
        lows, highs = (np.full((len(part), POSITIVES), v, np.int64) for v in (1, 0))
        for at, positives in enumerate(places):
            for k, p in enumerate(positives):
                score = int(p["score"])
                lows[at, k], highs[at, k] = -(-score * LOWEST // 100), score * HIGHEST // 100
        for rows, columns, score in tiles(Side(scaled(part["x"])), Side(scaled(own["x"]))):
            other = part["label"].to_numpy()[rows, None] != labels[None, columns]
            for k in range(POSITIVES):
                inside = other & (score >= lows[rows, k, None]) & (score <= highs[rows, k, None])
                if not inside.any():
                    continue
                a, r, value = best(score, inside, NEGATIVES)
                chosen = [places[rows.start + i][k] for i in a]
                out.append(
                    pd.DataFrame({
                        "anchor": part["mark"].to_numpy()[rows][a], "anchor_id": part["id"].to_numpy()[rows][a],
                        "positive": [p["mark"] for p in chosen], "positive_id": [p["id"] for p in chosen],
                        "positive_score": [p["score"] for p in chosen],
                        "mark": marks[columns][r], "id": ids[columns][r], "score": value,
                    })
                )
    if not out:
        return pd.DataFrame({c.split()[0]: [] for c in NEGATIVE_TYPE.split(", ")}, dtype="int64")
    return _leading(pd.concat(out), ["anchor", "positive"], "id", "mark", NEGATIVES)


def _first(found, group, k):
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "id", "mark")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_hard_negatives(vectors, vec_id="vec_id", vector="embedding", label="label", anchors=None):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor's windows.

    ``anchors`` is a condition on ``id`` and ``label``, by default ids divisible by 50.  An
    anchor's positives are the 5 best other rows of its label, and each positive gets the 3
    best rows of other labels that score 50 to 95 per cent of it; fewer are all returned.
    Scores are inner products of floor(256 x); equal ones rank by the smaller id.  Rows
    without id, label or vector, or with null or non-finite components, take no part.
    Vectors of different length have no score; empty ones have score 0 with each other.
    Repeated rows of an id are rows of their own, but never positives of that id.  An
    empty table gives an empty result; other columns are not read.  Scores above 2**62 in
    size are cut to it.
    """
    rows = usable(vectors, vec_id, vector, label)
    asked = rows.where(F.expr("id % 50 = 0") if anchors is None else anchors)
    found = _grid(asked, rows).applyInPandas(_positives, POSITIVE_TYPE)
    positives = written(_first(found, ["anchor"], POSITIVES), "positives")
    # At most POSITIVES entries a group.
    each = positives.groupBy("anchor").agg(F.collect_list(F.struct("mark", "id", "score")).alias("positives"))
    windows = written(asked.join(each, F.col("mark") == F.col("anchor")).drop("anchor"), "windows")
    mined = _first(_grid(windows, rows).applyInPandas(_negatives, NEGATIVE_TYPE), ["anchor", "positive"], NEGATIVES)
    return mined.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
