"""Archives, mixture and packing: round trips, invariants and brute force."""

import base64
import hashlib
import time
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafline.llm import mixture, packing, warc
from sheafline.session import shared_folder
from tests.conftest import plan_of

PAGES = "page_id long, url string, html string, record string, digest int"


def round_trip(spark, rows, **options):
    path = shared_folder(spark, "test-archives")
    warc.write_archives(spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES).repartition(2), path, **options)
    return path, warc.read_records(spark, path)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
TRICKY = [
    (1, "http://a", "<p>plain</p>"),
    (2, "http://b\r\nWARC-Type: x", FAKE),
    (3, None, f"x{FAKE}{FAKE}WARC/1."),
    (4, "http://c", "WARC/1.0\r\nContent-Length: 99999\r\n\r\n"),
    (5, "http://d", None),
    (6, "http://e", "é\r\n\r\nWARC/1.1\r\n" * 40),
    (7, "http://f", "<p>plain</p>"),
    (8, "http://g", ""),
    (9, "http://h", "WARC/1.WARC/1.WARC/1."),
    (None, "http://i", "<p>plain</p>"),
    (None, "http://j", "alone"),
]


@pytest.mark.parametrize("block", ["128m", "97b"])
def test_records_survive_magic_in_payloads(spark, block):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for key in before:
            spark.conf.set(key, block)
        path, records = round_trip(spark, TRICKY)
        lines = warc.verified_lines(spark, path)
        payloads = {(r["path"], r["start"]): bytes(r["payload"]) for r in warc.read_payloads(spark, path, lines).collect()}
        rows = records.collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(rows) == len(TRICKY)
    want = {i: (html or "") for i, _, html in TRICKY}
    for r in rows:
        assert r["payload_digest"] == digest(payloads[r["path"], r["start"]].decode())
        if r["record_type"] == "response":
            assert r["digest"] == r["payload_digest"]
            if r["record_id"] is not None:
                assert payloads[r["path"], r["start"]].decode() == want[r["record_id"]]
                assert r["payload_bytes"] == len(want[r["record_id"]].encode())
    kinds = Counter((r["record_id"], r["record_type"], r["refers_to"]) for r in rows)
    assert kinds[7, "revisit", 1] == 1 and kinds[8, "revisit", 5] == 1 and kinds[None, "revisit", 1] == 1
    assert kinds[None, "response", None] == 1 and sum(1 for k in kinds if k[1] == "revisit") == 3
    resolved = {r["record_id"]: r for r in warc.resolve_revisits(records).collect() if r["record_id"]}
    assert resolved[7]["payload_bytes"] == 12 and resolved[7]["payload_digest"] == digest("<p>plain</p>")


def test_small_payloads_are_all_responses(spark):
    _, records = round_trip(spark, [(1, "", "ab"), (2, "", "ab"), (3, "", "abcdef"), (4, "", "abcdef")], smallest=4)
    assert {(r["record_id"], r["record_type"]) for r in records.collect()} == {
        (1, "response"), (2, "response"), (3, "response"), (4, "revisit")
    }


def test_empty_archives_and_repeated_rows(spark):
    assert round_trip(spark, [])[1].count() == 0
    _, records = round_trip(spark, [(3, "u", "same")] * 2 + [(5, "u", "same")])
    assert Counter((r["record_id"], r["record_type"]) for r in records.collect()) == {(3, "response"): 2, (5, "revisit"): 1}


def test_broken_chain_keeps_what_precedes(spark, tmp_path):
    good = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    (tmp_path / "a.warc").write_text(good + good.replace("Length: 2", "Length: 1") + good, newline="")
    (tmp_path / "b.warc").write_text("junk" + good, newline="")
    got = warc.read_records(spark, f"file://{tmp_path}").collect()
    assert [(r["start"], r["payload_bytes"]) for r in got] == [(0, 2)] or sorted(r["start"] for r in got)[0] == 0
    assert all("b.warc" not in r["path"] for r in got)


def test_lines_after_a_broken_chain_belong_to_no_record(spark, tmp_path):
    head = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: {}\r\n\r\n"
    split = head.format(20) + "abcWARC/1.0defghijkl" + "\r\n\r\n"
    broken = head.format(3) + "longer than it says\r\n\r\n"
    (tmp_path / "a.warc").write_text(split + broken + split * 50, newline="")
    lines = warc.verified_lines(spark, f"file://{tmp_path}")
    owned = warc._owned(lines).groupBy("owner").count().collect()
    assert {r["owner"]: r["count"] for r in owned} == {0: 2, len(split): 1}
    got = warc.split_payloads(spark, f"file://{tmp_path}", lines).collect()
    assert bytes(next(r for r in got if r["start"] == 0)["payload"]) == b"abcWARC/1.0defghijkl"


DOCS = "doc_id long, text string, source string, size int, s string, start int, target string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, 0, "", 0, "") for i, t, s in rows], DOCS)


def level_targets(sizes, share=1.5, passes=2.0):
    """The rule as stated: share by weight, stop at the limit, share the excess again."""
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target, full = {}, set()
    while True:
        left = share * sum(sizes.values()) - sum(passes * sizes[s] for s in full)
        open_ = sum(weight[s] for s in sizes if s not in full)
        target = {s: passes * sizes[s] if s in full else left * weight[s] / open_ for s in sizes}
        over = {s for s in sizes if s not in full and target[s] > passes * sizes[s]}
        if not over:
            return target
        full |= over


def test_mixture_meets_targets(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 900))), f"s{i % 7}" if i % 3 else "s0") for i in range(300)]
    rows += [(1000, "x " * 30_000, "s3"), (1001, None, "s1"), (1002, " \n", "s2"), (1003, "a b", None), (1003, "a b", None)]
    rows += [(None, "c d e", "é"), (None, "c d e", "é"), (1004, "z", "\U0001f600"), (1005, "z", "￿")]
    docs = docs_of(spark, rows)
    mixed = mixture.mix(docs)
    got = mixed.collect()
    assert Counter(got) == Counter(mixture.mix(docs).collect())
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _, _ in rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    source = {i: s for i, _, s in rows}
    want, taken = level_targets(sizes), Counter()
    for r in got:
        assert r["source_size"] == sizes[source[r["doc_id"]]] and 0 <= r["taken"] <= 2 * r["size"]
        assert r["target"] == pytest.approx(want[source[r["doc_id"]]])
        taken[source[r["doc_id"]]] += r["taken"]
    for s, n in want.items():
        if sizes[s] > 5000:
            assert taken[s] == pytest.approx(n, rel=0.03)
    plan = plan_of(mixed)
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_blocks_are_drawn_once_per_pass(spark):
    rows = [(i, "w " * 640, f"s{i % 3}") for i in range(60)]
    sized = mixture._sized(docs_of(spark, rows), "doc_id", "text", "source", F.lit(0))
    targets = mixture.source_targets(sized)
    drawn = mixture.drawn_blocks(mixture.shard_draws(targets)).collect()
    blocks = {r["s"]: r["blocks"] for r in targets.collect()}
    assert len({(r["s"], r["pass"], r["block"]) for r in drawn}) == len(drawn)
    assert all(0 <= r["block"] < blocks[r["s"]] for r in drawn)
    first = sorted(r["block"] for r in drawn if r["s"] == 1 and r["pass"] == 0)
    assert first == list(range(blocks[1]))


def test_draws_are_multinomial_and_meet_the_targets(spark, monkeypatch):
    monkeypatch.setattr(mixture, "SHARD_SLOTS", 100)
    rows = [(i, "w " * 640, f"s{i % 4}") for i in range(800)]
    targets = mixture.source_targets(mixture._sized(docs_of(spark, rows), "doc_id", "text", "source", F.lit(0)))
    sources = mixture.slot_numbers(targets)
    draws = mixture.shard_draws(targets).collect()
    wanted = {s: n for s, _, _, _, n in sources}
    total, shards = sum(wanted.values()), {r["shard"] for r in draws}
    assert Counter({s: sum(r["slots"] for r in draws if r["s"] == s) for s in wanted}) == wanted
    for s in wanted:
        own = sorted((r["shard"], r["first"], r["slots"]) for r in draws if r["s"] == s)
        assert [f for _, f, _ in own] == [sum(n for _, _, n in own[:k]) for k in range(len(own))]
    # Shards before the first correction are whole, and their counts spread as chance has it.
    whole = [k for k in shards if k < 0.9 * total / 100]
    for s, _, low, high, _ in sources:
        counts = np.array([sum(r["slots"] for r in draws if (r["s"], r["shard"]) == (s, k)) for k in whole])
        p = high - low
        assert abs(counts.mean() - 100 * p) < 4 * np.sqrt(100 * p * (1 - p) / len(whole))
        assert 0.6 < counts.var() / (100 * p * (1 - p)) < 1.6


def test_slots_unfold_in_many_tasks(spark, monkeypatch):
    rows = [(i, "w " * 640, "hot" if i % 9 else f"s{i % 4}") for i in range(200)]
    targets = mixture.source_targets(mixture._sized(docs_of(spark, rows), "doc_id", "text", "source", F.lit(0)))
    few = Counter(mixture.drawn_blocks(mixture.shard_draws(targets)).collect())
    monkeypatch.setattr(mixture, "SLOTS_PER_TASK", 200)
    monkeypatch.setattr(mixture, "PIECE", 50)
    drawn = mixture.drawn_blocks(mixture.shard_draws(targets))
    sizes = [r["count"] for r in drawn.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 5 and max(sizes) < sum(sizes) / 3 and Counter(drawn.collect()) == few


def test_words_taken_are_those_of_the_drawn_blocks(spark):
    rng = np.random.default_rng(11)
    rows = [(i, "w " * int(rng.integers(1, 300)), f"s{i % 3}") for i in range(150)]
    docs = docs_of(spark, rows)
    sized = mixture._sized(docs, "doc_id", "text", "source", F.xxhash64("text"))
    targets = mixture.source_targets(sized)
    placed, drawn = mixture._drawn_fragments(sized, targets, mixture.SEED)
    blocks = Counter((r["s"], r["block"]) for r in mixture.drawn_blocks(mixture.shard_draws(targets)).collect())
    layout, want = {}, Counter()
    for r in placed.collect():
        for word in range(r["start"], r["start"] + r["size"]):
            assert layout.setdefault((r["s"], word), r["id"]) == r["id"]
            want[r["id"]] += blocks[r["s"], word // mixture.BLOCK_WORDS]
    got = Counter({r["doc_id"]: r["taken"] for r in mixture.mix(docs).collect()})
    assert got == Counter({i: want[i] for i, _, _ in rows})


def test_mixed_texts_carry_what_is_taken(spark):
    rows = [(i, "  ".join(f"d{i}w{j}" for j in range(50 + 37 * (i % 9))), f"s{i % 4}") for i in range(80)] + [(90, None, "s1"), (91, "", "s2")]
    docs = docs_of(spark, rows + rows[:1])
    taken = Counter()
    for r in mixture.mix(docs).collect():
        taken[r["doc_id"]] += r["taken"]
    texts, words = dict((i, t) for i, t, _ in rows), Counter()
    made = mixture.mixed_texts(docs, length="size")
    assert made.columns == docs.columns
    for r in made.collect():
        own = texts[r["doc_id"]].split()
        place = [own.index(w) for w in r["text"].split()]
        assert place == sorted(place)
        assert r["text"] == texts[r["doc_id"]] or len(place) < len(own) and r["size"] == len(r["text"])
        words[r["doc_id"]] += len(place)
    # Two equal rows are two documents; together they carry what both have taken.
    assert sum(words.values()) == sum(taken.values())


def test_long_texts_are_cut_in_linear_time(spark):
    def seconds(n):
        docs = docs_of(spark, [(1, " ".join(f"w{i}" for i in range(n)), "s"), (2, "v " * 100, "s")])
        started = time.perf_counter()
        rows = mixture.mixed_texts(docs, length="size").collect()
        words = [w for r in rows if r["doc_id"] == 1 for w in r["text"].split()]
        assert abs(len(words) - 1.5 * n) < 0.1 * n + 200
        return time.perf_counter() - started

    seconds(1_000)
    assert seconds(200_000) < 10 + 3 * seconds(20_000)


def test_mixture_of_nothing(spark):
    empty = docs_of(spark, [(1, "a", "s")]).limit(0)
    assert mixture.mix(empty).count() == 0 and mixture.mixed_texts(empty).count() == 0
    bare = docs_of(spark, [(1, None, "s"), (2, "", None)])
    assert [(r["size"], r["taken"]) for r in mixture.mix(bare).collect()] == [(0, 0)] * 2


def test_bounds_are_optimal():
    rng = np.random.default_rng(8)
    for buckets in (1, 2, 3, 40):
        lengths = np.sort(rng.integers(0, 30, 60))
        values, number = np.unique(lengths, return_counts=True)
        bounds = packing.best_bounds(number.astype(float), (values * number).astype(float), values.astype(float), buckets)

        def padding(ends):
            return sum(min(e for e in ends if e >= n) - n for n in lengths)

        pick = min(buckets, len(values)) - 1
        best = min(padding([*c, values[-1]]) for c in combinations(values[:-1], pick)) if pick < 4 else 0
        assert padding(bounds) == best and len(bounds) <= buckets
    assert packing.best_bounds(*[np.zeros(0)] * 3) == []


def test_bins_grow_with_lengths(spark):
    got = spark.range(0, 300_000, 7).select(packing.length_bin(F.col("id")).alias("b"), "id").orderBy("id").toPandas()
    assert got["b"].is_monotonic_increasing and got["b"].max() < 2000 and (got["b"][:100] == got["id"][:100]).all()


@pytest.mark.parametrize("budget", [10, 400])
def test_batches_fit_the_budget(spark, budget):
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(0, 60)), "s") for i in range(500)] + [(7, "a b", "s")] * 3 + [(None, None, None), (1, "w " * 5000, "s")]
    docs = docs_of(spark, rows).withColumns({"bucket": F.lit("old"), "length": F.lit("old")})
    got = packing.pack(docs, buckets=5, budget=budget).toPandas()
    assert len(got) == len(rows) and sorted(got["length"]) == sorted(len((t or "").split()) for _, t, _ in rows)
    assert (got["padding"] == got["bucket_length"] - got["length"]).all() and (got["padding"] >= 0).all()
    for (bucket, batch), part in got.groupby(["bucket", "batch"]):
        room = max(1, budget // max(1, part["bucket_length"].iloc[0]))
        assert sorted(part["slot"]) == list(range(len(part))) and len(part) <= room
        last = got[got["bucket"] == bucket]["batch"].max()
        assert len(part) == room or batch == last
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_keeps_all_columns_and_measures_once(spark):
    docs = spark.createDataFrame([(1, "a b", 5, 6, 7)] * 2 + [(2, None, 5, 6, 7)], "doc_id long, text string, __mark int, order int, ROW int")
    got = packing.pack(docs)
    assert got.columns == [*docs.columns, "length", "bucket", "bucket_length", "batch", "slot", "padding"]
    assert sorted((r["doc_id"], r["__mark"], r["order"], r["ROW"], r["length"]) for r in got.collect()) == [(1, 5, 6, 7, 2)] * 2 + [(2, 5, 6, 7, 0)]
    # Texts are measured before they are stored; what is numbered and joined reads the sizes.
    plan = plan_of(packing.pack(docs))
    assert "regexp" not in plan, plan
    assert "BroadcastExchange" in plan
    # The caller's measure may be one of the columns that are replaced.
    assert {r["length"] for r in packing.pack(docs.withColumn("length", F.lit(9)), length=F.col("length")).collect()} == {9}
