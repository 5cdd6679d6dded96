"""Vectors close in angle, by cover trees traversed in pairs.

On unit vectors a cosine bound is a distance bound ``t``.  Vectors of one label are laid
out in cells around pivots; a vector visits another cell only if the covering radius of
the cell and the distances to both pivots allow a partner there.  Each cell is
cut in slices of bounded size, and each pair of slices is one task: it builds a cover
tree per slice (nested levels, the radius halves from one to the next) and walks both
trees at once.  A pair of nodes whose centres are farther apart than both covering
radii plus ``t`` is dropped whole; one that is closer than ``t`` less both radii is
linked whole without listing its pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sheafline.llm.common import written
from sheafline.llm.components import _lookup, connected_components, unique_side

COSINE = 0.98
# Vectors per cell aimed at, most pivots in all (they are broadcast), vectors per slice.
CELL = 4096
PIVOTS = 4096
SLICE = 2048
LEAF = 24
MARGIN = 1e-7
SEED = 5


class Node:
    __slots__ = ("centre", "radius", "members", "children")

    def __init__(self, centre, radius, members, children=()):
        self.centre, self.radius, self.members, self.children = centre, radius, members, children


def cover_tree(x):
    """Root of a cover tree over the rows of ``x`` (unit vectors)."""

    def grow(centre, members, distance, reach):
        radius = float(distance.max())
        node = Node(centre, radius, members)
        if len(members) <= LEAF or radius <= 1e-9:
            return node
        while reach >= radius:
            reach /= 2
        node.children = []
        rest, near, at = members, distance, centre
        while len(rest):
            inside = near <= reach
            node.children.append((at, rest[inside], near[inside], reach))
            rest = rest[~inside]
            if len(rest):
                at = rest[0]
                near = np.sqrt(np.maximum(2 - 2 * (x[rest] @ x[at]), 0))
                near[0] = 0.0
        return node

    everything = np.arange(len(x))
    distance = np.sqrt(np.maximum(2 - 2 * (x @ x[0]), 0))
    distance[0] = 0.0
    root = grow(0, everything, distance, 2.0)
    todo = [root]
    while todo:
        node = todo.pop()
        if node.children:
            node.children = [grow(*child) for child in node.children]
            todo += node.children
    return root


class Links:
    """Links found between numbered vectors: weights per vector, and what is connected."""

    def __init__(self, weight):
        self.weight, self.count = weight, np.zeros(len(weight), np.int64)
        self.ends = []

    def pairs(self, i, j):
        np.add.at(self.count, i, self.weight[j])
        np.add.at(self.count, j, self.weight[i])
        self.ends.append((i, j))

    def whole(self, a, b):
        """Every vector of ``a`` with every one of ``b``; with the same array, all pairs inside."""
        own = a is b
        self.count[a] += self.weight[b].sum() - (self.weight[a] if own else 0)
        if not own:
            self.count[b] += self.weight[a].sum()
        both = a if own else np.concatenate([a, b])
        self.ends.append((np.full(len(both), both[0]), both))

    def roots(self, ids):
        """Smallest id each vector is connected to."""
        low = ids.copy()
        if self.ends:
            i, j = (np.concatenate([e[k] for e in self.ends]) for k in (0, 1))
            while True:
                was = low.copy()
                np.minimum.at(low, i, low[j])
                np.minimum.at(low, j, low[i])
                if (was == low).all():
                    break
        return low


def link(x, left, right, links, cosine):
    """Add all links between the tree nodes ``left`` and ``right`` over the rows of ``x``."""
    t = np.sqrt(2 - 2 * cosine)
    todo = [(left, right)]
    while todo:
        a, b = todo.pop()
        if a is b and 2 * a.radius <= t - MARGIN:
            links.whole(a.members, a.members)
            continue
        if not a.children and not b.children:
            hit = x[a.members] @ x[b.members].T >= cosine
            i, j = np.nonzero(np.triu(hit, 1) if a is b else hit)
            if len(i):
                links.pairs(a.members[i], b.members[j])
            continue
        ca = a.children or [a]
        cb = b.children or [b]
        product = x[[c.centre for c in ca]] @ x[[c.centre for c in cb]].T
        gap = np.sqrt(np.maximum(2 - 2 * product, 0))
        reach = np.array([c.radius for c in ca])[:, None] + np.array([c.radius for c in cb])[None, :]
        near = gap - reach <= t + MARGIN
        if a is b:
            near = np.triu(near)
        for i, j in zip(*np.nonzero(near)):
            if gap[i, j] + reach[i, j] <= t - MARGIN and ca[i] is not cb[j]:
                links.whole(ca[i].members, cb[j].members)
            else:
                todo.append((ca[i], cb[j]))


def _unit(vectors):
    x = np.array(vectors.tolist(), dtype=np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def usable(vector):
    """Column condition: a vector with a direction."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(x.isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def _distances(x, centres):
    return np.sqrt(np.maximum(2 - 2 * (x @ centres.T), 0))


def _by_space(frame, pivots):
    """(rows, unit vectors, pivots of their space) for each (label, dimension) in a frame."""
    for key, part in frame.groupby(["label", "dim"], sort=False):
        yield part, _unit(part["x"]), pivots.get(key)


def lay_out(nodes, cosine):
    """(label, dim, cell, home, node, weight, x): every node in its cell and in those it visits.

    The partner of a visit is always at home in the cell with the smaller number.
    """
    t = float(np.sqrt(2 - 2 * cosine))
    total = max(1, nodes.count())
    share = int(min(1 / CELL, PIVOTS / total) * (1 << 30))
    picked = nodes.where(F.pmod(F.xxhash64("node", F.lit(SEED)), F.lit(1 << 30)) < share).select("label", "dim", "x", "node")
    pivots = {k: _unit(p.sort_values("node")["x"]) for k, p in picked.toPandas().groupby(["label", "dim"])}
    shared = nodes.sparkSession.sparkContext.broadcast(pivots)

    def settle(frames):
        for frame in frames:
            for part, x, centres in _by_space(frame, shared.value):
                d = _distances(x, centres) if centres is not None else np.full((len(x), 1), 2.0)
                home = d.argmin(1)
                yield part.assign(cell=home, away=d[np.arange(len(x)), home])

    schema = "label int, dim int, node long, weight long, x array<double>"
    homes = written(nodes.select("label", "dim", "node", "weight", "x").mapInPandas(settle, f"{schema}, cell int, away double"), "cells")
    # One row per pivot at most: spaces without pivots have a single cell and no visits.
    several = homes.groupBy("label", "dim", "cell").agg(F.max("away").alias("radius")).where("radius < 2")
    radius = {(r["label"], r["dim"], r["cell"]): r["radius"] for r in several.collect()} if pivots else {}
    reach = nodes.sparkSession.sparkContext.broadcast(radius)

    def visit(frames):
        for frame in frames:
            yield frame.drop(columns="away").assign(home=True)
            for part, x, centres in _by_space(frame, shared.value):
                if centres is None or len(centres) < 2:
                    continue
                d = _distances(x, centres)
                key = (part["label"].iloc[0], part["dim"].iloc[0])
                radii = np.array([reach.value.get((*key, c), -10.0) for c in range(len(centres))])
                own = part["away"].to_numpy()[:, None]
                goes = (d - own <= 2 * t + MARGIN) & (d <= radii[None, :] + t + MARGIN)
                goes &= np.arange(len(centres))[None, :] < part["cell"].to_numpy()[:, None]
                i, cell = np.nonzero(goes)
                if len(i):
                    yield part.drop(columns="away").iloc[i].assign(cell=cell, home=False)

    return homes.mapInPandas(visit, f"{schema}, cell int, home boolean")


def close_pairs(placed, cosine):
    """(node, links, root): links counted with weights, and a smaller node it is connected to."""
    cells = unique_side(placed, ["label", "dim", "cell"], n=F.count("*"))
    cut = placed.join(cells.withColumn("slices", F.ceil(F.col("n") / SLICE).cast("int")), ["label", "dim", "cell"])
    slice_ = F.pmod(F.xxhash64("node", F.lit(SEED + 1)), F.col("slices")).cast("int")
    spread = cut.withColumn("slice", slice_).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    keyed = spread.withColumns({"i": F.least("slice", "other"), "j": F.greatest("slice", "other")})

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node", ignore_index=True)
        x, ids = _unit(group["x"]), group["node"].to_numpy()
        links = Links(group["weight"].to_numpy())
        sides = {}
        for side in {int(group["i"].iloc[0]), int(group["j"].iloc[0])}:
            for home in (True, False):
                at = np.flatnonzero((group["slice"] == side) & (group["home"] == home))
                if len(at):
                    sides[side, home] = _shifted(cover_tree(x[at]), at)
        one, two = int(group["i"].iloc[0]), int(group["j"].iloc[0])
        for p, q in ((True, True), (True, False), (False, True)):
            if one == two and (p, q) == (False, True):
                continue
            if (one, p) in sides and (two, q) in sides:
                link(x, sides[one, p], sides[two, q], links, cosine)
        low = links.roots(ids)
        some = links.count > 0
        return pd.DataFrame({"node": ids[some], "links": links.count[some], "root": low[some]})

    columns = ["label", "dim", "cell", "i", "j"]
    work = keyed.select(*columns, "slice", "home", "node", "weight", "x")
    return work.groupBy(*columns).applyInPandas(walk, "node long, links long, root long")


def _shifted(root, at):
    """The tree with the numbers of its rows replaced by ``at``."""
    todo = [root]
    while todo:
        node = todo.pop()
        node.centre, node.members = at[node.centre], at[node.members]
        todo += node.children
    return root


def group_close_vectors(vectors, vec_id="vec_id", vector="embedding", label="label", cosine=COSINE):
    """One row per vector: (id, n_links, component, kept).

    Two vectors are linked when their labels are equal and not null, their lengths agree
    and their cosine in double precision is at least ``cosine``.  ``component`` is the
    smallest id reachable, itself included.  Vectors that are null, zero or hold null or
    non-finite components, and those without label, have no links; rows without id have
    none either, no component, and are kept.  Equal vectors of a label are one node with
    a weight, so copies cost no pairs.  Repeated rows count as vectors of their own; an
    empty table gives an empty result.  Ids are integers, labels fit an int.
    """
    rows = vectors.select(
        F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("x")
    )
    part = F.col("id").isNotNull() & F.col("label").isNotNull() & usable("x")
    marked = rows.where(part).withColumns({"h1": F.xxhash64(F.lit(1), "x"), "h2": F.xxhash64(F.lit(2), "x")})
    same = ["label", "h1", "h2"]
    classes = unique_side(marked, same, node=F.min("id"), weight=F.count("*"))
    own = F.when(F.col("id") == F.col("node"), F.col("x"))
    members = written(marked.join(classes, same).select("id", "label", "node", "weight", own.alias("x")), "vectors")
    nodes = (
        members.where("x IS NOT NULL").dropDuplicates(["node"])
        .select(F.col("label").cast("int").alias("label"), F.size("x").alias("dim"), "node", "weight", "x")
    )
    found = written(close_pairs(lay_out(written(nodes, "nodes"), cosine), cosine), "links")
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = unique_side(found, ["node"], links=F.sum("links"))
    named = members.join(counts, "node", "left").select(
        "id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.col("node").alias("component")
    )
    linked = _lookup(named, "component", roots)
    alone = rows.where(~part).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component"), F.lit(True)))
