"""Mixing sources to target weights, in DataFrame functions only.

The words of each source form one stream, cut into blocks of a fixed number of words.
Every output shard draws how many of its slots each source fills: a multinomial draw by
the targets, after which a last shard evens out what chance left of them.  The slots of
a source are numbered through all shards; slot number ``i`` of a source with ``n`` blocks
belongs to pass ``i div n`` and takes the block a pseudorandom permutation of that pass
puts at ``i mod n``.  Blocks then meet slots by an equality join on (source, block).
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheafline.llm.common import WORD, word_count, written

WEIGHTS = (5, 2, 1)
# Size of the mix over the size of the input, and most passes over a source.
SHARE = 1.5
PASSES = 2
BLOCK_WORDS = 64
SHARD_SLOTS = 65_536
# Slots a task unfolds, and how many of one source at a time.
SLOTS_PER_TASK = 65_536
PIECE = 4096
# Parts a source's stream is laid out in, so that no source needs one task.
LANES = 4096
# Rounds of the swap-or-not shuffle.
ROUNDS = 12
SEED = 1009


def source_targets(sized, weights=WEIGHTS, share=SHARE, passes=PASSES):
    """One row per source: number, size, weight, target and number of blocks.

    Sources count by code point with null last.  A target is its weight times a common
    level, but at most ``passes`` times the source's size; the level is the one at which
    all targets add up to ``share`` times all words.  With sources in the order in which
    they reach their limits, it is the largest of the levels that follow from fixing
    each beginning of that order.
    """
    total = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    place = F.row_number().over(by_name)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place - 1) % len(weights) + 1)
    named = total.select("source", "source_size", place.alias("s"), weight.alias("weight"))
    all_rows = Window.partitionBy()
    before = Window.orderBy(F.col("limit") / F.col("weight"), "s").rowsBetween(Window.unboundedPreceding, -1)
    level = named.withColumn("limit", F.col("source_size") * float(passes)).select(
        "*",
        (
            (F.sum("source_size").over(all_rows) * share - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
            / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        ).alias("level"),
    )
    target = F.least(F.col("limit"), F.col("weight") * F.max("level").over(all_rows))
    return level.select(
        "source", "s", "source_size", "weight", target.alias("target"),
        F.ceil(F.col("source_size") / BLOCK_WORDS).alias("blocks"),
    )


def place_documents(sized, targets):
    """Documents with words, their source's row, and the place of their first word."""
    known = sized.where("size > 0").withColumn("lane", F.pmod(F.xxhash64("id", "mark"), F.lit(LANES)))
    known = known.alias("d").join(targets.alias("t"), F.expr("d.source <=> t.source")).drop(F.col("t.source"))
    lanes = known.groupBy("s", "lane").agg(F.sum("size").alias("lane_size"))
    ahead = Window.partitionBy("s").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = lanes.select("s", "lane", F.coalesce(F.sum("lane_size").over(ahead), F.lit(0)).alias("lane_start"))
    within = Window.partitionBy("s", "lane").orderBy("id", "mark", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (
        known.withColumn("offset", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(starts, ["s", "lane"])
        .withColumn("start", F.col("offset") + F.col("lane_start"))
        .drop("lane", "offset", "lane_start")
    )


def fragments(placed):
    """One row per document and block it touches: first word in the document, and number of words."""
    size = F.lit(BLOCK_WORDS)
    end = F.col("start") + F.col("size")
    cut = placed.select(
        "*", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((end - 1) / size))).alias("block")
    )
    first = F.greatest(F.col("start"), F.col("block") * size)
    last = F.least(end, (F.col("block") + 1) * size)
    return cut.withColumns({"first": first - F.col("start"), "words": last - first})


def slot_numbers(targets):
    """(s, blocks, low, high, slots) of every source that takes part, on the driver.

    ``low`` and ``high`` are the source's part of the unit interval, ``slots`` what it
    fills of all slots; a row per source, like the weights of the mix themselves.
    """
    rows = targets.where("source_size > 0 AND target > 0").select("s", "blocks", "source_size", "target").collect()
    rows.sort(key=lambda r: r["s"])
    ends = list(accumulate(r["target"] * r["blocks"] / r["source_size"] for r in rows))
    starts = [0.0, *ends[:-1]]
    number = [round(high) - round(low) for low, high in zip(starts, ends)]
    if rows and not sum(number):
        number[-1] = 1
    return [
        (r["s"], r["blocks"], low / ends[-1], high / ends[-1], n) for r, low, high, n in zip(rows, starts, ends, number)
    ]


def tasks_for(slots):
    return max(1, -(-slots // SLOTS_PER_TASK))


def shard_draws(targets, seed=SEED):
    """(s, blocks, shard, slots, first): how many slots of each shard a source fills.

    Every slot of a shard draws its source by the targets, which makes the counts of
    a shard multinomial.  What chance gave a source beyond its target is taken off its last
    shards; what others still lack then forms the last shard.  ``first`` numbers the
    source's slots through the shards.
    """
    spark, sources = targets.sparkSession, slot_numbers(targets)
    number = sum(n for *_, n in sources)
    lows = F.array(*[F.lit(low) for _, _, low, _, _ in sources] or [F.lit(0.0)])
    variate = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 40)) / float(1 << 40)
    # The last source whose part of the unit interval begins at or below the variate.
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, len(sources).bit_length())))])

    def nearer(at, step):
        there = at + step
        return F.when((there < len(sources)) & (F.get(lows, there) <= F.col("variate")), there).otherwise(at)

    slots = spark.range(0, number, 1, tasks_for(number)).withColumn("variate", variate)
    drawn = slots.select(
        F.floor(F.col("id") / SHARD_SLOTS).alias("shard"), F.aggregate(halves, F.lit(0), nearer).alias("place")
    )
    counts = drawn.groupBy("place", "shard").agg(F.count("*").alias("count"))
    kinds = {"place": "int", "s": "int", "blocks": "long", "wanted": "long"}
    rows = [(i, s, blocks, n) for i, (s, blocks, _, _, n) in enumerate(sources)]
    cells = [F.struct(*[F.lit(v).cast(k).alias(c) for v, (c, k) in zip(row, kinds.items())]) for row in rows]
    none = F.array().cast(f"array<struct<{', '.join(f'{c}: {k}' for c, k in kinds.items())}>>")
    # As literals: rows handed over by createDataFrame would pass through a Python worker.
    known = spark.range(1).select(F.inline(F.array(*cells) if cells else none))
    ahead = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    cells = written(counts.withColumn("first", F.coalesce(F.sum("count").over(ahead), F.lit(0))), "draws")
    kept = cells.join(known, "place").withColumn("slots", F.least("count", F.col("wanted") - F.col("first")))
    got = cells.groupBy("place").agg(F.sum("count").alias("got"))
    rest = known.join(got, "place", "left").withColumn("first", F.coalesce("got", F.lit(0)))
    last = F.lit(-(-number // SHARD_SLOTS)).cast("long")
    columns = ("s", "blocks", "shard", "slots", "first")
    lacking = rest.withColumn("shard", last).withColumn("slots", F.col("wanted") - F.col("first"))
    return kept.select(*columns).unionByName(lacking.select(*columns)).where("slots > 0")


def drawn_blocks(draws, passes=PASSES, seed=SEED):
    """(s, shard, pass, block): the block in each slot; no block twice in a pass.

    A swap-or-not shuffle: every round pairs ``x`` with ``key - x`` and a hash of the pair
    decides whether to swap, which permutes the blocks whatever their number.  Slots
    beyond ``passes`` passes over a source, which rounding can leave, stay empty.  Slots
    unfold in pieces of bounded size, dealt to as many tasks as their number asks for.
    """
    draws = written(draws, "cells")
    number = draws.agg(F.sum("slots")).first()[0] or 0
    cells = draws.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    low = F.greatest(F.col("first"), F.col("blocks") * F.col("pass"))
    high = F.least(F.col("first") + F.col("slots"), F.col("blocks") * (F.col("pass") + 1))
    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    keys = F.transform(rounds, lambda r: F.pmod(F.xxhash64(F.lit(seed), r, "s", "pass"), "blocks"))
    pieces = (
        cells.withColumns({"low": low, "high": high})
        .where("low < high")
        .withColumn("from", F.explode(F.sequence(F.col("low"), F.col("high") - 1, F.lit(PIECE).cast("long"))))
        .select("s", "shard", "pass", "blocks", "from", F.least(F.col("high"), F.col("from") + PIECE).alias("to"))
        .repartition(tasks_for(number), "s", "from")
    )
    slots = pieces.withColumn("keys", keys).select(
        "s", "shard", "pass", "blocks", "keys", F.explode(F.sequence(F.col("from"), F.col("to") - 1)).alias("i")
    )

    def swap(x, key):
        other = F.pmod(key - x, F.col("blocks"))
        coin = F.xxhash64(key, "s", "pass", F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(coin, other).otherwise(x)

    return slots.select("s", "shard", "pass", F.aggregate("keys", F.expr("i % blocks"), swap).alias("block"))


def _sized(docs, doc_id, text, source, mark):
    """Ids, sources and sizes as a table: texts are read once, the layout reads this often."""
    sized = docs.select(
        F.col(doc_id).alias("id"), F.col(source).alias("source"), word_count(text).alias("size"), mark.alias("mark")
    )
    return written(sized, "sizes")


def _drawn_fragments(sized, targets, seed):
    placed = written(place_documents(sized, targets), "places")
    # A few rows per source unfold into all slots, which size estimates do not see: without
    # the hint Spark would broadcast them.
    drawn = drawn_blocks(shard_draws(targets, seed), seed=seed).hint("merge")
    return placed, fragments(placed).join(drawn, ["s", "block"])


def mix(docs, doc_id="doc_id", text="text", source="source", seed=SEED):
    """One row per document: (doc_id, size, source_size, target, taken).

    ``size`` counts words, ``taken`` the words of the document the mix takes, repeats
    counted: at most twice its size.  A null text has no words; a null source is a
    source of its own, the last; documents without words take no part and get 0.
    Repeated rows are mixed each for themselves.  An empty table gives an empty result.
    Only ids, sources and sizes are shuffled, never texts; a source with most of the
    rows is laid out in LANES parts.  Equal input and seed give equal results.
    """
    sized = _sized(docs, doc_id, text, source, F.xxhash64(F.col(text)))
    targets = written(source_targets(sized), "targets")
    placed, drawn = _drawn_fragments(sized, targets, seed)
    used = drawn.groupBy("s", "start").agg(F.sum("words").alias("taken"))
    full = placed.join(used, ["s", "start"], "left").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )
    bare = sized.where("size = 0").alias("d").join(targets.alias("t"), F.expr("d.source <=> t.source"))
    return full.unionByName(
        bare.select(F.col("id").alias("doc_id"), "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    )


def mixed_texts(docs, doc_id="doc_id", text="text", source="source", length=None, seed=SEED):
    """The mix as rows of ``docs``: one per document and pass in which it is drawn.

    A document drawn whole in a pass keeps its text as it is; of one drawn in part the
    runs of words drawn remain, each run on a line of its own, and the column named by
    ``length`` gets the new number of characters.  All other columns stay.  Texts move
    once, to meet what was drawn from them.
    """
    own = docs.columns
    rows = docs.select(
        F.struct(*own).alias("row"),
        F.col(doc_id).alias("id"),
        F.col(source).alias("source"),
        word_count(text).alias("size"),
        F.xxhash64(*own).alias("mark"),
        F.monotonically_increasing_id().alias("at"),
    )
    # Numbers of rows hold once they are stored.
    rows = written(rows, "marked")
    sized = rows.drop("row")
    _, drawn = _drawn_fragments(sized, written(source_targets(sized), "targets"), seed)
    runs = drawn.groupBy("at", "pass").agg(
        F.sum("words").alias("taken"), F.array_sort(F.collect_list(F.struct("first", "words"))).alias("runs")
    )
    met = rows.join(runs.hint("merge"), "at").withColumn("whole", F.col("taken") == F.col("size"))
    words = F.when(~F.col("whole"), F.regexp_extract_all(F.col("row")[text], F.lit(WORD), F.lit(0)))

    def piece(split, run, i):
        before = F.get(F.col("runs"), i - 1)
        gap = F.when(i == 0, "").when(before["first"] + before["words"] == run["first"], " ").otherwise("\n")
        own = F.slice(split, run["first"].cast("int") + 1, run["words"].cast("int"))
        return F.concat(gap, F.array_join(own, " "))

    def pieces(split):
        return F.array_join(F.transform("runs", lambda run, i: piece(split, run, i)), "")

    # The words are the argument of a function: as a column of its own the split would be
    # moved into the function over runs and repeated for each of them.
    cut = F.get(F.transform(F.array(words), pieces), F.lit(0))
    made = met.withColumn("cut", F.when(F.col("whole"), F.col("row")[text]).otherwise(cut))
    changed = {text: F.col("cut")}
    if length is not None:
        old = F.col("row")[length]
        new = F.char_length("cut").cast(docs.schema[length].dataType)
        changed[length] = F.when(F.col("whole") | old.isNull(), old).otherwise(new)
    return made.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in own])
