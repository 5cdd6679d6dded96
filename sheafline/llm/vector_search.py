"""Exact top-k inner products by ball trees.

Candidates are dealt to shards by a hash, queries to blocks; every (shard, block) is one
task.  It builds a ball tree over its shard and passes the queries of its block down
together: a node is entered by the queries whose bound ``q.c + |q| r`` still reaches
their k-th score, the child with the larger bound first.  The k-th score is shared: it
starts from the scores of a small sample of candidates that every query has seen, and
rises as a task goes on.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheafline.llm.common import written

TOP = 5
SCALE = 256
# Rows per shard and queries per block; candidates in the sample, which is broadcast.
SHARD_ROWS = 8192
BLOCK_QUERIES = 2048
SAMPLE = 1024
LEAF = 64
SEED = 13
LONG_MAX = (1 << 63) - 1


def scaled(vectors):
    """floor(256 x) of every component, in whole doubles."""
    return np.floor(SCALE * np.array(vectors.tolist(), dtype=np.float64))


def products(left, right):
    """Exact inner products as longs; those beyond the range of a long are cut to it."""
    peak = np.abs(left).max(initial=0.0) * np.abs(right).max(initial=0.0) * max(1, left.shape[1])
    if peak < 2.0**53:
        return (left @ right.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in side], dtype=object).reshape(side.shape) for side in (left, right)]
    return np.array(
        [[max(-LONG_MAX - 1, min(LONG_MAX, int(sum(a * b for a, b in zip(p, q))))) for q in whole[1]] for p in whole[0]],
        dtype=np.int64,
    ).reshape(len(left), len(right))


class Ball:
    __slots__ = ("centre", "radius", "rows", "parts")

    def __init__(self, x, rows):
        self.centre = x[rows].mean(0)
        self.radius = float(np.sqrt(((x[rows] - self.centre) ** 2).sum(1).max()))
        self.rows, self.parts = rows, ()


def ball_tree(x):
    """Root of a ball tree over the rows of ``x``: each ball is split between two far rows."""
    root = Ball(x, np.arange(len(x)))
    todo = [root]
    while todo:
        ball = todo.pop()
        if len(ball.rows) <= LEAF or ball.radius == 0:
            continue
        own = x[ball.rows]
        far = own[((own - ball.centre) ** 2).sum(1).argmax()]
        axis = own[((own - far) ** 2).sum(1).argmax()] - far
        place = own @ axis
        order = np.argsort(place, kind="stable")
        half = len(order) // 2
        ball.parts = (Ball(x, ball.rows[order[:half]]), Ball(x, ball.rows[order[half:]]))
        todo += ball.parts
    return root


class Best:
    """The k best candidates of each query so far."""

    def __init__(self, ids, floor, k):
        self.ids = ids
        self.score = np.full((len(ids), k), -LONG_MAX - 1, np.int64)
        self.who = np.full((len(ids), k), LONG_MAX, np.int64)
        self.filled = np.zeros((len(ids), k), bool)
        self.floor = floor

    def least(self):
        """Score a candidate must reach: the k-th so far, or the shared one if that is higher."""
        return np.maximum(np.where(self.filled[:, -1], self.score[:, -1], -LONG_MAX - 1), self.floor)

    def add(self, at, ids, scores):
        real = (ids[None, :] != self.ids[at][:, None]) & (scores >= self.floor[at][:, None])
        score = np.concatenate([self.score[at], np.where(real, scores, -LONG_MAX - 1)], 1)
        who = np.concatenate([self.who[at], np.where(real, ids[None, :], LONG_MAX)], 1)
        filled = np.concatenate([self.filled[at], real], 1)
        # Larger scores first, then smaller ids; -score - 1 cannot overflow.
        order = np.lexsort((who, -1 - score, ~filled), axis=1)[:, : self.score.shape[1]]
        self.score[at] = np.take_along_axis(score, order, 1)
        self.who[at] = np.take_along_axis(who, order, 1)
        self.filled[at] = np.take_along_axis(filled, order, 1)


def search(queries, query_ids, floor, x, ids, k):
    """:class:`Best` of all queries over the candidates ``x``."""
    best = Best(query_ids, floor, k)
    length = np.sqrt((queries**2).sum(1))

    def bound(ball, at):
        upper = queries[at] @ ball.centre + length[at] * ball.radius
        return upper + np.abs(upper) * 1e-9 + 1e-6 * (1 + length[at] * 1e-3)

    todo = [(ball_tree(x), np.arange(len(queries)))]
    while todo:
        ball, at = todo.pop()
        at = at[bound(ball, at) >= best.least()[at]]
        if not len(at):
            continue
        if not ball.parts:
            best.add(at, ids[ball.rows], products(queries[at], x[ball.rows]))
            continue
        # The child most queries prefer is taken up next.
        todo += [(part, at) for part in sorted(ball.parts, key=lambda part: bound(part, at).sum())]
    return best


def _by_length(frame):
    sizes = frame["x"].map(len)
    return {n: frame[sizes == n] for n in sizes.unique()}


def top_products(vectors, vec_id="vec_id", vector="embedding", queries=None, k=TOP):
    """(query_id, rank, vec_id, score) of the ``k`` highest inner products of each query.

    ``queries`` is a condition on the rows, by default ids divisible by 50; candidates are
    all rows but those with the query's id and vectors of another length.  Fewer than ``k``
    candidates are all returned; equal scores rank by the smaller id.  Rows without id, and
    vectors that are null or hold null or non-finite components, take no part; a zero
    vector does.  Repeated rows of one id are candidates each.  Empty in, empty out.
    """
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), x.alias("x"), finite.alias("ok"))
    rows = written(rows.where("id IS NOT NULL AND ok AND size(x) > 0").drop("ok"), "candidates")
    asked = rows.where(F.expr("id % 50 = 0") if queries is None else queries)
    total, wanted = rows.count(), asked.count()
    shards, blocks = max(1, -(-total // SHARD_ROWS)), max(1, -(-wanted // BLOCK_QUERIES))
    share = int(min(1.0, SAMPLE / max(1, total)) * (1 << 30))
    sample = rows.where(F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 30)) < share).toPandas()
    seen = vectors.sparkSession.sparkContext.broadcast({n: (scaled(p["x"]), p["id"].to_numpy()) for n, p in _by_length(sample).items()})

    def start(frames):
        for frame in frames:
            floor = pd.Series(-LONG_MAX - 1, index=frame.index, dtype="int64")
            for n, part in _by_length(frame).items():
                if n in seen.value:
                    x, ids = seen.value[n]
                    best = Best(part["id"].to_numpy(), np.full(len(part), -LONG_MAX - 1), k)
                    best.add(np.arange(len(part)), ids, products(scaled(part["x"]), x))
                    floor[part.index] = best.least()
            yield frame.assign(floor=floor)

    type_ = rows.schema["x"].dataType.simpleString()
    opened = asked.mapInPandas(start, f"id long, x {type_}, floor long")
    block = F.pmod(F.xxhash64("id", F.lit(SEED + 1)), F.lit(blocks)).cast("int")
    shard = F.pmod(F.xxhash64("id", F.lit(SEED + 2)), F.lit(shards)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = opened.withColumn("block", block).withColumn("shard", every(shards))
    right = rows.withColumn("shard", shard).withColumn("block", every(blocks))

    def task(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out, held = [], _by_length(held)
        for n, part in _by_length(asked).items():
            if n in held:
                ids = held[n]["id"].to_numpy()
                best = search(scaled(part["x"]), part["id"].to_numpy(), part["floor"].to_numpy(), scaled(held[n]["x"]), ids, k)
                q, place = np.nonzero(best.filled)
                out.append(pd.DataFrame({"query_id": best.ids[q], "vec_id": best.who[q, place], "score": best.score[q, place]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(
        task, "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
