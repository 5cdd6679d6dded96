"""Near-duplicate documents by MinHash with tensored banding.

A document gets a few small collections of minhashes.  The key of a table is a pair of
collections, so ``m`` collections serve ``m (m - 1) / 2`` tables: 48 minhashes do the
work of 720 at a threshold of 0.85.  Documents that meet in a table are candidates; every link is confirmed on
the full shingle sets, and whatever a table leaves undecided is compared exhaustively
in blocks, so no link between documents that meet anywhere is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from sheafline.llm.common import bounded_batches, written
from sheafline.llm.components import _lookup, connected_components, unique_side
from sheafline.session import finished

# Shingle length in words and similarity in percent, unless a caller says otherwise.
SHINGLE = 5
PERCENT = 80
# Minhashes per collection, and how likely a pair of documents just similar enough may
# miss all tables; the number of collections follows (:func:`collections_for`).
COLLECTION_SIZE = 3
MISSED = 1e-5
# Most documents, and about how many shingles, on either side of one exhaustive
# comparison; parts a star is split in.
BLOCK = 1024
BLOCK_SHINGLES = 500_000
STAR_PARTS = 64
CACHE_WORDS = 400_000
SEED = 41

_rng = np.random.default_rng(SEED)
_ODD = _rng.integers(1, 1 << 63, 128 * COLLECTION_SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def missed(similarity, collections, size=COLLECTION_SIZE):
    """Chance that two documents of this similarity share no table."""
    p = similarity**size
    return (1 - p) ** collections + collections * p * (1 - p) ** (collections - 1)


def collections_for(percent):
    """Fewest collections that miss no more than allowed: 16 for 85 per cent, 21 for 80."""
    return next((m for m in range(2, 128) if missed(percent / 100, m) <= MISSED), 128)


class WordHashes(dict):
    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(values):
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


def shingle_set(text, k, hashes):
    """Sorted 64-bit hashes of the distinct ``k``-word shingles of a whole text.

    Words are runs without ASCII space, A-Z in lower case; fewer than ``k`` words make
    one shingle, none make an empty set.
    """
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(k, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        out = out * _STEP[0] + h[i : len(words) - width + 1 + i] * _STEP[i % 62 + 1]
    return np.unique(_mixed(out))


def sketch(values, collections):
    """One value per collection, each a hash of its minhashes."""
    odd = _ODD[: collections * COLLECTION_SIZE, None]
    low = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(values), 4096):
        h = values[start : start + 4096] * odd
        h ^= h >> np.uint64(32)
        low = np.minimum(low, h.min(1))
    low = low.reshape(collections, COLLECTION_SIZE)
    out = np.zeros(collections, np.uint64)
    for i in range(COLLECTION_SIZE):
        out = _mixed(out * _STEP[0] + low[:, i] * _STEP[i + 1])
    return out.view(np.int64)


def signatures(docs, k, collections):
    """(id, n, f1, f2, sketch): size, 128-bit print and sketch of every row's shingle set."""

    @F.pandas_udf("n long, f1 long, f2 long, sketch array<long>")
    def signed(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for part in parts:
            rows = []
            for text in part:
                s = shingle_set(text, k, hashes)
                prints = [int(v.sum(dtype=np.uint64).view(np.int64)) for v in (_mixed(s), _mixed(s * _STEP[63]))]
                rows.append((len(s), *prints, sketch(s, collections) if len(s) else np.zeros(0, np.int64)))
            yield pd.DataFrame(rows, columns=["n", "f1", "f2", "sketch"])

    return docs.select("id", signed(F.coalesce("text", F.lit(""))).alias("s")).select("id", "s.*")


def shared_keys(rows, key):
    """The rows whose ``key`` occurs on more than one node, with its smallest and largest node and count."""
    groups = unique_side(rows, [key], low=F.min("node"), high=F.max("node"), n=F.count("*")).where("low < high")
    # Unfolded rows are many more than size estimates say, so neither side may be broadcast.
    return rows.join(groups.hint("merge"), key)


def collection_rows(nodes, *others):
    """(key, node) for each collection of each node, and further columns."""
    parts = nodes.select("node", *others, F.posexplode("sketch").alias("i", "c"))
    return parts.select(F.xxhash64("i", "c").alias("key"), "node", *others)


def table_rows(nodes, collections):
    """(key, node) for each pair of collections of each node."""
    pairs = list(combinations(range(collections), 2))
    one, two = (F.array(*[F.lit(p[i]) for p in pairs]) for i in (0, 1))
    places = nodes.select("node", "sketch", F.explode(F.sequence(F.lit(0), F.lit(len(pairs) - 1))).alias("t"))
    return places.select(F.xxhash64("t", F.col("sketch")[one[F.col("t")]], F.col("sketch")[two[F.col("t")]]).alias("key"), "node")


def candidates(nodes, collections):
    """Rows (key, node, low, high, n) of the tables in which a node meets another.

    Only nodes that share two collections can share a table, so the pairs of collections
    are formed for those alone.
    """
    shared = shared_keys(collection_rows(nodes), "key").groupBy("node").agg(F.count("*").alias("c")).where("c > 1")
    return shared_keys(table_rows(nodes.join(shared.select("node"), "node"), collections), "key")


def confirm_stars(edges, texts, k, percent):
    """The edges (a, b) whose documents are similar enough, on full sets.

    Every text travels once per edge end ``b`` and once per part of a star around ``a``;
    a task streams the ends past the one centre it holds.
    """
    part = F.pmod(F.xxhash64("b"), F.lit(STAR_PARTS)).cast("int")
    ends = edges.withColumn("part", part)
    outer = ends.join(texts.withColumnRenamed("node", "b"), "b").select("a", "part", "b", "text")
    inner = ends.select("a", "part").distinct().join(texts.withColumnRenamed("node", "a"), "a")
    rows = outer.union(inner.select("a", "part", F.col("a").alias("b"), "text"))
    # The centre sorts first: it is the smaller of every pair.
    laid = rows.repartition("a", "part").sortWithinPartitions("a", "part", "b")

    def confirmed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, centre, held = WordHashes(), None, None
        for frame in frames:
            found = []
            for a, b, text in zip(frame["a"], frame["b"], frame["text"]):
                if a == b:
                    if centre != a:
                        centre, held = a, shingle_set(text, k, hashes)
                    continue
                other = shingle_set(text, k, hashes)
                if min(len(held), len(other)) * 100 >= percent * max(len(held), len(other)):
                    both = len(np.intersect1d(held, other, assume_unique=True))
                    if 100 * both >= percent * (len(held) + len(other) - both):
                        found.append((a, b))
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return laid.mapInPandas(confirmed, "a long, b long")


def similar_pairs(left, right, percent):
    """Boolean matrix of the pairs of sets that are similar enough."""
    sizes = [np.array([len(s) for s in side], dtype=np.int64) for side in (left, right)]
    flat = np.concatenate([*left, *right]) if left or right else np.zeros(0, np.uint64)
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(left) + len(right)), np.concatenate(sizes))
    often = count[column] > 1
    row, column = row[often], column[often]
    order = np.argsort(column, kind="stable")
    row, column = row[order], np.unique(column[order], return_inverse=True)[1]
    both = np.zeros((len(left), len(right)), np.float32)
    width = 8192
    cuts = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + width, width))
    for i, (start, stop) in enumerate(zip(cuts[:-1], cuts[1:])):
        cells = np.zeros((len(left) + len(right), width), np.float32)
        cells[row[start:stop], column[start:stop] - i * width] = 1
        both += cells[: len(left)] @ cells[len(left) :].T
    return 100 * both >= percent * (sizes[0][:, None] + sizes[1][None, :] - both)


def compare_blocks(nodes, known, texts, k, percent):
    """Confirmed edges inside every collection value among ``nodes`` (node, n, sketch).

    Every pair of documents of different known components that shares a collection is
    compared.  A value held by many documents is cut in blocks of bounded size and each
    pair of blocks is one group; of the links found in a group a spanning forest is
    returned.
    """
    rows = _lookup(collection_rows(nodes, "n").withColumn("component", F.col("node")), "component", known)
    mixed = unique_side(
        rows, ["key"], docs=F.count("*"), size=F.sum("n"), c1=F.min("component"), c2=F.max("component")
    ).where("c1 < c2")
    blocks = F.ceil(F.greatest(F.col("docs") / BLOCK, F.col("size") / BLOCK_SHINGLES)).cast("int")
    mixed = mixed.withColumn("blocks", blocks)
    placed = rows.join(mixed.select("key", "blocks"), "key").withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = placed.withColumn("other", other).select(
        "key", "node", "component", "block",
        F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
    )
    filled = spread.join(texts, "node")

    def compared(group: pd.DataFrame) -> pd.DataFrame:
        hashes = WordHashes()
        x, y = int(group["x"].iloc[0]), int(group["y"].iloc[0])
        sides = [group[group["block"] == v] for v in ((x, y) if x != y else (x, x))]
        sets = [[shingle_set(t, k, hashes) for t in side["text"]] for side in sides]
        similar = similar_pairs(sets[0], sets[1] if x != y else sets[0], percent)
        similar &= sides[0]["component"].to_numpy()[:, None] != sides[1]["component"].to_numpy()[None, :]
        found, root = [], {}

        def top(v):
            while root.get(v, v) != v:
                v = root[v]
            return v

        ids = [side["node"].tolist() for side in sides]
        for i, j in zip(*np.nonzero(similar)):
            u, v = top(ids[0][i]), top(ids[1][j])
            if u != v:
                root[max(u, v)] = min(u, v)
                found.append((ids[0][i], ids[1][j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return filled.groupBy("key", "x", "y").applyInPandas(compared, "a long, b long")


def group_near_duplicates(docs, k=SHINGLE, percent=PERCENT, doc_id="doc_id", text="text"):
    """One row per document: (id, n_shingles, component, kept).

    Linked are documents with at least ``percent`` per cent of the shingles of both in
    common; ``component`` is the smallest id reachable through links, ``kept`` marks it.
    Texts that are null or have no words have an empty set and no link.  Documents with
    equal sets are one node from the start, whatever their number.  Ids are integers; rows
    with one id count as one document, and rows without id have no component, link with
    nothing and are kept.  Bytes that are not UTF-8 count as replacement characters.  Candidates come from all documents; no bucket is capped.
    """
    return finished(
        docs.sparkSession, "near-duplicate-groups", lambda: _grouped(bounded_batches(docs), k, percent, doc_id, text)
    )


def _grouped(docs, k, percent, doc_id, text):
    """Result of :func:`group_near_duplicates`, from stage tables."""
    collections = collections_for(percent)
    rows = docs.select(F.col(doc_id).alias("id"), F.make_valid_utf8(F.col(text)).alias("text"))
    signed = written(signatures(rows, k, collections), "signatures")
    usable = signed.where("n > 0 AND id IS NOT NULL")
    classes = unique_side(usable, ["f1", "f2"], node=F.min("id"))
    members = written(usable.join(classes, ["f1", "f2"]).select("id", "n", "node", F.when(F.col("id") == F.col("node"), F.col("sketch")).alias("sketch")), "classes")
    nodes = members.where("sketch IS NOT NULL").select("node", "n", "sketch")
    met = written(candidates(nodes, collections), "candidates")
    stars = written(met.where("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    involved = written(
        stars.select(F.col("a").alias("node")).union(stars.select("b")).distinct(), "involved"
    )
    texts = written(rows.withColumnRenamed("id", "node").where("node IS NOT NULL").join(involved, "node"), "texts")
    one = connected_components(confirm_stars(stars, texts, k, percent))
    # Tables with three or more nodes may hold pairs that no star has tried.
    open_ = _lookup(met.where("n > 2").select("key", "node").withColumn("component", F.col("node")), "component", one)
    undecided = unique_side(open_, ["key"], c1=F.min("component"), c2=F.max("component")).where("c1 < c2")
    left = written(open_.join(undecided.select("key"), "key").select("node").distinct(), "undecided")
    more = compare_blocks(nodes.join(left, "node"), one, texts.join(left, "node"), k, percent)
    joined = _lookup(_lookup(more, "a", one), "b", one)
    two = connected_components(joined)
    links = _lookup(one, "component", two).union(
        two.join(one.select("node"), "node", "left_anti")
    )
    named = _lookup(members.select("id", "n", F.col("node").alias("component")), "component", links)
    rest = signed.where("NOT (n > 0 AND id IS NOT NULL)").select("id", "n", F.col("id").alias("component"))
    return named.unionByName(rest).select(
        "id", F.col("n").alias("n_shingles"), "component",
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs, k=SHINGLE, percent=PERCENT, doc_id="doc_id", text="text"):
    """``docs`` less every document that is linked to one with a smaller id."""
    groups = group_near_duplicates(docs, k, percent, doc_id, text)
    gone = groups.where("NOT kept").select(F.col("id").alias(doc_id)).distinct()
    return docs.join(written(gone, "near-duplicates"), doc_id, "left_anti")
