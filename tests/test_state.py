"""Streams with state: windows over elements, idle windows, replays, fan-out, replacing, the guard."""

import datetime as dt
import json
import os
import random
import time
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline import session
from sheafline.operators import joins
from sheafline.plans import state
from sheafline.plans.state import wait_until_idle
from sheafline.schemas import BROKER_ROW
from sheafline.sinks.fanout import committed_batches, read_fan_out, start_fan_out
from sheafline.sinks.tables import stream_layer
from sheafline.sinks.versions import VersionedTable, newest_documents, start_replacing
from sheafline.streaming import guard, replays, windows

AVAILABLE = {"availableNow": True}
DAY = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def append(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


ITEM = "tenant string, at timestamp, word string, n int"


def items(*rows):
    return [(t, DAY + dt.timedelta(seconds=s), w, n) for t, s, w, n in rows]


def listed(keys, bounds, elements):
    """Every element again, with its place, to see that none is lost or changed."""
    for i, (word, n) in enumerate(elements):
        yield i, word, n


LISTED = T.StructType().add("place", "integer").add("word", "string").add("n", "integer")


def run_listed(spark, path, out, check):
    stream = spark.readStream.schema(ITEM).option("maxFilesPerTrigger", 1).parquet(path)
    done = windows.process_windows(stream, listed, LISTED, ("word", "n"), ts="at", keys=("tenant",))
    stream_layer(done, out, check, AVAILABLE).awaitTermination()
    rows = spark.read.schema(done.schema).parquet(out).select(F.unix_timestamp("window_start").alias("s"), "tenant", "word", "n").collect()
    return Counter((r["s"] - int(DAY.timestamp()), r["tenant"], r["word"], r["n"]) for r in rows)


def test_window_elements_with_nulls_late_rows_and_a_restart(spark, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    append(spark, path, items(("a", 1, "x", None), ("a", 1, "x", None), (None, 2, None, 5), ("a", 66, "y", 7)), ITEM)
    first = Counter({(0, "a", "x", None): 2, (0, None, None, 5): 1})
    assert run_listed(spark, path, out, check) == first
    # The row at second 3 belongs to a closed window; the window of second 66 was left open.
    append(spark, path, items(("a", 3, "late", 1), ("a", 70, "z", 8), ("b", 200, "w", 9)), ITEM)
    assert run_listed(spark, path, out, check) == first + Counter({(60, "a", "y", 7): 1, (60, "a", "z", 8): 1})


def counted(keys, bounds, elements):
    yield (sum(1 for _ in elements),)


def test_hot_windows_in_lanes(spark, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    count = T.StructType().add("n", "long")
    seen = str(tmp_path / "parts")

    def noted(keys, bounds, parts):
        parts = list(parts)
        with open(seen, "a") as file:
            file.write(f"{keys[0]} {len(parts)}\n")
        yield (sum(n for (n,) in parts),)

    def run():
        stream = spark.readStream.schema(ITEM).option("maxFilesPerTrigger", 1).parquet(path)
        done = windows.process_windows(stream, counted, count, ("word",), ts="at", keys=("tenant",), lanes=3, merge=noted)
        stream_layer(done, out, check, AVAILABLE).awaitTermination()
        rows = spark.read.schema(done.schema).parquet(out).select(F.unix_timestamp("window_start").alias("s"), "tenant", "n").collect()
        return Counter((r["s"] - int(DAY.timestamp()), r["tenant"], r["n"]) for r in rows)

    append(spark, path, items(*[("hot", 1, "x", 1)] * 300, ("cold", 2, "x", 1), ("hot", 66, "y", 1)), ITEM)
    first = Counter([(0, "hot", 300), (0, "cold", 1)])
    assert run() == first
    append(spark, path, items(*[("hot", 70, "x", 1)] * 200, ("hot", 3, "late", 1), ("hot", 300, "x", 1)), ITEM)
    assert run() == first + Counter([(60, "hot", 201)])
    parts = [line.split() for line in open(seen).read().splitlines()]
    assert sorted(parts) == [["cold", "1"], ["hot", "3"], ["hot", "3"]]
    with pytest.raises(ValueError):
        windows.process_windows(None, counted, count, (), lanes=2)


def test_widths():
    assert windows.width_ms("30 seconds") == 30_000 and windows.width_ms("1 hour") == 3_600_000
    for bad in ("0 seconds", "1 fortnight", "-1 seconds"):
        with pytest.raises(ValueError):
            windows.width_ms(bad)


def test_a_function_may_yield_more_rows_than_a_batch(monkeypatch):
    monkeypatch.setattr(windows, "ROWS_PER_BATCH", 3)
    assert [len(f) for f in windows._frames(((i,) for i in range(7)), ["n"])] == [3, 3, 1]


def message(tenant, chunk, second):
    value = json.dumps({"company_id": tenant, "chunk_id": chunk}) if chunk is not None else "not json"
    return (None, value, "t", 0, 0, DAY + dt.timedelta(seconds=second))


def test_windows_close_while_nothing_arrives(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    append(spark, path, [message("a", "1", 0), message("a", "2", 0), message(None, "3", 0)], BROKER_ROW)
    counts = windows.idle_processing_counts(spark.readStream.schema(BROKER_ROW).parquet(path), "1 second")
    query = stream_layer(counts, out, str(tmp_path / "check"), {"processingTime": "200 milliseconds"})

    def emitted(total):
        ends = time.monotonic() + 90
        while time.monotonic() < ends:
            rows = spark.read.schema(counts.schema).parquet(out).collect() if (tmp_path / "out/_spark_metadata").exists() else []
            if sum(r["chunk_count"] for r in rows) >= total:
                return rows
            time.sleep(0.3)
        raise AssertionError("the window stayed open")

    try:
        rows = emitted(3)
        assert Counter((r["company_id"], r["chunk_count"]) for r in rows) == {("a", 2): 1, (None, 1): 1}
        assert {(r["window_end"] - r["window_start"]).total_seconds() for r in rows} == {1.0}
        time.sleep(2)
        assert len(emitted(3)) == 2
        append(spark, path, [message("a", "4", 0)], BROKER_ROW)
        assert len(emitted(4)) == 3
    finally:
        query.stop()


def run_unique(spark, path, out, check):
    stream = spark.readStream.schema(BROKER_ROW).option("maxFilesPerTrigger", 1).parquet(path)
    unique = replays.drop_replayed_messages(stream, delay="1 minute")
    query = stream_layer(unique, out, check, AVAILABLE)
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    return Counter(r["value"] for r in spark.read.schema(unique.schema).parquet(out).collect()), held


def test_replays_pass_once_and_are_forgotten(spark, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    first = [message("a", str(i), i) for i in range(20)] + [message("a", None, 5)]
    append(spark, path, first, BROKER_ROW)
    append(spark, path, [message("a", str(i), i + 30) for i in range(20)] + [message("a", None, 31)], BROKER_ROW)
    got, _ = run_unique(spark, path, out, check)
    assert set(got.values()) == {1} and len(got) == 21
    # After a restart the same messages are still known; much later ids are forgotten again.
    append(spark, path, first, BROKER_ROW)
    append(spark, path, [message("a", f"later {i}", 4000 + i) for i in range(3)], BROKER_ROW)
    append(spark, path, [message("a", "last", 9000)], BROKER_ROW)
    got, held = run_unique(spark, path, out, check)
    assert set(got.values()) == {1} and len(got) == 25
    assert held[-1] <= 1 < max(held)


def test_rows_without_ids_are_compared_whole(spark, tmp_path):
    path = str(tmp_path / "in")
    schema = "chunk_id string, text string, at timestamp"
    append(spark, path, [(None, "x", DAY), (None, "x", DAY), (None, "y", DAY), ("1", "x", DAY), ("1", "z", DAY)], schema)
    unique = replays.drop_replays(spark.readStream.schema(schema).parquet(path), ts="at")
    stream_layer(unique, str(tmp_path / "out"), str(tmp_path / "check"), AVAILABLE).awaitTermination()
    rows = spark.read.schema(schema).parquet(str(tmp_path / "out")).collect()
    assert Counter(r["chunk_id"] for r in rows) == {None: 2, "1": 1}


NUMBERS = "n long"


def test_fan_out_survives_a_death_between_two_writes(spark, tmp_path):
    path, root, check = (str(tmp_path / n) for n in ("in", "tables", "check"))
    deaths = [1]

    def odd(batch):
        if batch.where("n = 13").count() and deaths:
            deaths.pop()
            raise RuntimeError("killed")
        return batch.where("n % 2 = 1")

    outputs = {"even": lambda b: b.where("n % 2 = 0"), "odd": odd, "sums": lambda b: b.agg(F.sum("n").alias("n"))}

    def run():
        stream = spark.readStream.schema(NUMBERS).option("maxFilesPerTrigger", 1).parquet(path)
        query = start_fan_out(stream, outputs, root, check, AVAILABLE)
        query.awaitTermination()

    def numbers(name):
        return Counter(r["n"] for r in read_fan_out(spark, root, name, T.StructType().add("n", "long")).collect())

    append(spark, path, [(i,) for i in range(10)], NUMBERS)
    run()
    append(spark, path, [(i,) for i in range(10, 20)], NUMBERS)
    with pytest.raises(Exception, match="killed"):
        run()
    # The first output of the dead batch is written, yet no reader sees any of it.
    assert (tmp_path / "tables/even/batch_id=1").exists()
    assert numbers("even") == Counter(range(0, 10, 2)) and numbers("sums") == Counter([45])
    run()
    assert numbers("even") == Counter(range(0, 20, 2)) and numbers("odd") == Counter(range(1, 20, 2))
    assert numbers("sums") == Counter([45, 145])
    assert sorted(r["batch_id"] for r in committed_batches(spark, root).collect()) == [0, 1]
    with pytest.raises(ValueError):
        start_fan_out(None, {"_commits": odd}, root, check)


CHUNKS = T.StructType().add("company_id", "string").add("document_id", "string").add("text", "string")


def rows_of(table):
    return Counter((r["company_id"], r["document_id"], r["text"]) for r in table.read().collect())


def test_replacing_rewrites_touched_buckets_only(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), CHUNKS, buckets=8)
    assert rows_of(table) == Counter()
    frame = lambda rows: spark.createDataFrame(rows, CHUNKS)
    old = frame([("c", str(i), f"{i} old {k}") for i in range(30) for k in range(2)])
    table.replace(old, old, 0)
    before = table.current()[1]
    new = frame([("c", "3", "new"), ("c", "4", "new")])
    table.replace(frame([("c", "3", ""), ("c", "4", ""), ("c", "5", "")]), new, 1)
    want = Counter({("c", str(i), f"{i} old {k}"): 1 for i in range(30) if i not in (3, 4, 5) for k in range(2)})
    want += Counter({("c", "3", "new"): 1, ("c", "4", "new"): 1})
    assert rows_of(table) == want
    moved = {b for b, v in table.current()[1].items() if v == 1}
    assert 1 <= len(moved) <= 3 and {b: v for b, v in table.current()[1].items() if v == 0}.items() <= before.items()
    # A batch that is repeated changes nothing, whatever it holds.
    table.replace(old, old, 1)
    assert rows_of(table) == want
    assert table.drop_old_versions(keep=1) == len(moved) and rows_of(table) == want
    # A bucket may become empty.
    table.replace(old, old.limit(0), 2)
    assert rows_of(table) == Counter()


def test_a_batch_that_died_before_its_commit_is_invisible(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"), CHUNKS, buckets=2)
    one = spark.createDataFrame([("c", "1", "one")], CHUNKS)
    table.replace(one, one, 0)
    two = spark.createDataFrame([("c", "1", "two"), (None, "2", "two")], CHUNKS)

    def die(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "_commit", die)
        with pytest.raises(RuntimeError):
            table.replace(two, two, 1)
    assert rows_of(table) == Counter([("c", "1", "one")])
    table.replace(two, two, 1)
    assert rows_of(table) == Counter([("c", "1", "two"), (None, "2", "two")])


def test_newest_documents(spark):
    schema = "company_id string, document_id string, text string, updated_at int"
    rows = [("c", "1", "a", 1), ("c", "1", "b", 2), ("c", "1", "b", 2), ("c", "2", "x", None), (None, "1", "n", 1), (None, "1", "m", 0)]
    got = newest_documents(spark.createDataFrame(rows, schema), "updated_at").collect()
    assert sorted((r["document_id"], r["text"]) for r in got) == [("1", "b"), ("1", "n"), ("2", "x")]


def test_replacing_stream_with_restart(spark, tmp_path):
    schema = "company_id string, document_id string, text string, updated_at int"
    path, table = str(tmp_path / "in"), VersionedTable(spark, str(tmp_path / "t"), CHUNKS, buckets=4)

    def words(batch):
        return batch.select("company_id", "document_id", F.explode(F.split("text", " ")).alias("text")).where("text <> ''")

    def run():
        stream = spark.readStream.schema(schema).parquet(path)
        start_replacing(stream, table, words, str(tmp_path / "check"), trigger=AVAILABLE).awaitTermination()
        return rows_of(table)

    append(spark, path, [("c", "1", "a b", 1), ("c", "2", "x", 1), ("c", "3", "y", 1)], schema)
    assert run() == Counter([("c", "1", "a"), ("c", "1", "b"), ("c", "2", "x"), ("c", "3", "y")])
    append(spark, path, [("c", "1", "stale", 1), ("c", "1", "z", 2), ("c", "2", "", 2)], schema)
    assert run() == Counter([("c", "1", "z"), ("c", "3", "y")])


UPLOAD = "document_id string, company_id string, filename string, arrival long"
CHANGE = "document_id string, company_id string, filename string, status string, at long"


def run_guard(spark, work, uploads, changes=(), existing=None):
    append(spark, f"{work}/uploads", uploads, UPLOAD)
    append(spark, f"{work}/changes", list(changes), CHANGE)
    known = spark.createDataFrame(existing, "document_id string, company_id string, filename string, status string") if existing else None
    verdicts = guard.guard_uploads(
        spark.readStream.schema(UPLOAD).parquet(f"{work}/uploads"), spark.readStream.schema(CHANGE).parquet(f"{work}/changes"), known
    )
    stream_layer(verdicts, f"{work}/out", f"{work}/check", AVAILABLE).awaitTermination()
    return spark.read.schema(verdicts.schema).parquet(f"{work}/out").collect()


def test_guard_reopens_names_of_failed_documents(spark, tmp_path):
    existing = [("old", "c", "taken", "processed"), ("bad", "c", "free", "error"), ("bad", "c", "both", "error"), ("good", "c", "both", None)]
    work = str(tmp_path)
    first = [("1", "c", "taken", 1), ("2", "c", "free", 2), ("3", "c", "free", 3), ("4", "c", "both", 4), ("5", None, "x", 5), ("5", None, "x", 5),
             ("6", "c", "n", None), ("7", "c", "n", 9), ("8", "c", "same", 1), ("8", "c", "same", 1), (None, "c", "nameless", 1)]
    rows = run_guard(spark, work, first, existing=existing)
    accepted = Counter((r["document_id"], r["filename"]) for r in rows if r["accepted"])
    assert accepted == Counter([("2", "free"), ("5", "x"), ("5", "x"), ("7", "n"), ("8", "same"), (None, "nameless")])
    assert len(rows) == len(first) and {r["arrival"] for r in rows if r["document_id"] == "6"} == {None}
    # Changes count before the uploads of their batch; an older one changes nothing.
    changes = [("old", "c", "taken", "error", 5), ("2", "c", "free", "error", 9), ("2", "c", "free", "processed", 8), ("8", "c", "same", "processed", 3)]
    second = [("9", "c", "taken", 20), ("10", "c", "free", 21), ("11", "c", "same", 22), ("2", "c", "free", 23)]
    rows = run_guard(spark, work, second, changes, existing)
    assert {r["document_id"]: r["accepted"] for r in rows if r["arrival"] and r["arrival"] >= 20} == {"9": True, "10": True, "11": False, "2": False}
    # A name can be freed and taken by the same document again.
    rows = run_guard(spark, work, [("10", "c", "free", 30), ("12", "c", "free", 31)], [("10", "c", "free", "error", 25)], existing)
    assert {r["document_id"]: r["accepted"] for r in rows if r["arrival"] and r["arrival"] >= 30} == {"10": True, "12": False}


@pytest.mark.parametrize("seed", [1, 2])
def test_guard_agrees_with_the_batch_guard_over_any_cut(spark, tmp_path, seed):
    rng = random.Random(seed)
    uploads = [(str(rng.randrange(30)), rng.choice("ab"), f"f{rng.randrange(12)}", rng.randrange(40)) for _ in range(80)]
    existing = [(f"e{i}", rng.choice("ab"), f"f{rng.randrange(12)}", rng.choice(["error", "processed"])) for i in range(8)]
    stored = spark.createDataFrame(existing, "document_id string, company_id string, filename string, status string")
    flagged = joins.flag_duplicates(spark.createDataFrame(uploads, UPLOAD), stored, "arrival").collect()
    want = Counter((r["document_id"], r["company_id"], r["filename"], r["arrival"], r["accepted"]) for r in flagged)
    cuts = sorted(rng.sample(range(1, 40), 2))
    for low, high in zip([0, *cuts], [*cuts, 40]):
        rows = run_guard(spark, str(tmp_path), [u for u in uploads if low <= u[3] < high], (), existing)
    assert Counter((r["document_id"], r["company_id"], r["filename"], r["arrival"], r["accepted"]) for r in rows) == want


class Kept:
    """Map and value states of one group, and how often they were called."""

    def __init__(self):
        self.map, self.value, self.calls = {}, None, 0

    def getMapState(self, *args):
        return self

    def getValueState(self, *args):
        return Single(self)

    def getValue(self, key):
        self.calls += 1
        return self.map.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.map[key] = value


class Single:
    def __init__(self, kept):
        self.kept = kept

    def get(self):
        self.kept.calls += 1
        return self.kept.value

    def update(self, value):
        self.kept.calls += 1
        self.kept.value = value


GUARDED = ["bucket", "document_id", "company_id", "filename", "at", "status"]


def judge(kept, rows, frame_rows, existing=()):
    """Verdicts of one micro-batch on the rows of one bucket, by a processor of its own."""
    judged = guard.NameGuard()
    judged.init(kept)
    if existing:
        judged.handleInitialState((0,), pd.DataFrame(existing, columns=["document_id", "company_id", "filename", "status"]), None)
    frames = (pd.DataFrame(rows[i : i + frame_rows], columns=GUARDED) for i in range(0, len(rows), frame_rows))
    return pd.concat([pd.DataFrame(), *judged.handleInputRows((0,), frames, None)])


def test_the_store_is_not_asked_for_every_name():
    kept, n = Kept(), 20_000
    uploads = [(0, f"d{i}", "c", f"f{i}", 1, None) for i in range(n)]
    assert judge(kept, uploads, 1000)["accepted"].sum() == n
    # 40,000 entries lie in about 160 pages; each is read at most and written a few times.
    assert kept.calls < n / 20 and max(len(v[0]) for v in kept.map.values()) < 100_000
    # One upload among all these names touches the pages of that name only.
    kept.calls = 0
    late = [(0, "x", "c", "f7", 2, None), (0, "d9", "c", "f9", 2, "error"), (0, "y", "c", "f9", 3, None)]
    assert judge(kept, late, 10)["accepted"].tolist() == [False, True]
    assert kept.calls < 20


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_guard_agrees_with_a_plain_one(monkeypatch, seed):
    monkeypatch.setattr(guard, "PAGE", 4)
    monkeypatch.setattr(guard, "HELD", 2)
    monkeypatch.setattr(guard, "ROWS_PER_BATCH", 7)
    rng, kept, holders = random.Random(seed), Kept(), {}

    def hold(name, document, active, at):
        known = holders.setdefault(name, {})
        if document not in known or known[document][1] <= at:
            known[document] = active, at

    def document():
        return rng.choice([None, "", "d:1", "1:d", *(f"d{i}" for i in range(12))])

    # Names that would be one if their parts were only put together.
    names = [(c, f) for c in ("a", "1:a", "a1", "") for f in ("", "1", "1:a", "é", "0:", *(f"f{i}" for i in range(8)))]
    existing = [(document(), *rng.choice(names), rng.choice(["error", "processed", None])) for _ in range(40)]
    for d, c, f, status in existing:
        if status != "error" or (d or "") not in holders.get((c, f), {}):
            hold((c, f), d or "", status != "error", guard.FIRST)
    for step in range(6):
        changes = [(0, document(), *rng.choice(names), at, rng.choice(["error", "processed"])) for at in rng.sample(range(step * 50, 500), 60)]
        uploads = [(0, document(), *rng.choice(names), rng.choice([guard.LAST, *range(30)]), None) for _ in range(150)]
        rows = rng.sample(changes + uploads, 210)
        got = judge(kept, rows, 50, existing if step == 0 else ())
        for _, d, c, f, at, status in rows:
            if status is not None:
                hold((c, f), d or "", status != "error", at)
        free = {name for name in names if not any(active for active, _ in holders.get(name, {}).values())}
        want = Counter()
        for name in names:
            asked = sorted(((at, d or "") for _, d, c, f, at, s in rows if s is None and (c, f) == name))
            want += Counter((d, *name, at, i == 0 and name in free) for i, (at, d) in enumerate(asked))
            if asked and name in free:
                known = holders.setdefault(name, {})
                known[asked[0][1]] = True, known.get(asked[0][1], (False, guard.FIRST))[1]
        assert Counter((r.document_id or "", r.company_id, r.filename, r.arrival, r.accepted) for r in got.itertuples()) == want
    assert len(kept.map) > 50


def test_names_that_share_a_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(guard, "BUCKETS", 1)
    existing = [(f"e{i}", "c", f"f{i}", "error" if i % 2 else "processed") for i in range(20)]
    first = [(f"{k}", "c", f"f{i}", 10 * i + k) for i in range(40) for k in range(3)]
    rows = run_guard(spark, str(tmp_path), first, existing=existing)
    held = {f"f{i}" for i in range(0, 20, 2)}
    assert Counter((r["document_id"], r["filename"]) for r in rows if r["accepted"]) == Counter(("0", f"f{i}") for i in range(40) if f"f{i}" not in held)
    assert Counter((r["document_id"], r["filename"], r["arrival"]) for r in rows) == Counter((d, f, a) for d, _, f, a in first)
    changes = [("0", "c", f"f{i}", "error", 1000) for i in range(30, 40)]
    rows = run_guard(spark, str(tmp_path), [("late", "c", f"f{i}", None) for i in range(40)], changes, existing)
    late = {r["filename"]: r for r in rows if r["document_id"] == "late"}
    assert {f for f, r in late.items() if r["accepted"]} == {f"f{i}" for i in range(30, 40)}
    assert len(late) == 40 and {r["arrival"] for r in late.values()} == {None}


@pytest.fixture
def plain(spark):
    """A session with Spark's default state store."""
    other = spark.newSession()
    store = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    other.conf.set("spark.sql.streaming.stateStore.providerClass", store)
    return other


def test_guard_on_a_plain_session(plain, tmp_path):
    append(plain, str(tmp_path / "uploads"), [("d1", "a", "x", 2), ("d2", "a", "x", 1), ("d3", None, "x", 3)], UPLOAD)
    stream = plain.readStream.schema(UPLOAD).parquet(str(tmp_path / "uploads"))
    verdicts = guard.guard_uploads(stream)
    stream_layer(verdicts, str(tmp_path / "out"), str(tmp_path / "check"), AVAILABLE).awaitTermination()
    rows = plain.read.schema(verdicts.schema).parquet(str(tmp_path / "out")).collect()
    assert {r["document_id"]: r["accepted"] for r in rows} == {"d1": False, "d2": True, "d3": True}


def test_processors_name_the_package_only_while_they_are_given(plain, monkeypatch, tmp_path):
    environment = plain.sparkContext.environment
    before = dict(environment)
    monkeypatch.setattr(session, "PACKAGE_ROOT", str(tmp_path))
    with session.stateful_processors(plain):
        assert str(tmp_path) in environment["PYTHONPATH"].split(os.pathsep)
    assert environment == before
    assert plain.conf.get(session.STATE_STORE).endswith("RocksDBStateStoreProvider")
    plain.conf.set(session.STATE_STORE, "some.other.Store")
    with session.stateful_processors(plain):
        assert plain.conf.get(session.STATE_STORE) == "some.other.Store"


def test_window_elements_on_a_plain_session(plain, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    append(plain, path, items(("a", 1, "x", 1), ("a", 66, "y", 7)), ITEM)
    assert run_listed(plain, path, out, check) == Counter({(0, "a", "x", 1): 1})


def test_idle_windows_on_a_plain_session(plain, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    append(plain, path, [message("a", "1", 0), message("a", "2", 0)], BROKER_ROW)
    counts = windows.idle_processing_counts(plain.readStream.schema(BROKER_ROW).parquet(path), "1 second")
    query = stream_layer(counts, out, str(tmp_path / "check"), {"processingTime": "200 milliseconds"})
    try:
        wait_until_idle(query)
    finally:
        query.stop()
    rows = plain.read.schema(counts.schema).parquet(out).collect()
    assert [(r["company_id"], r["chunk_count"]) for r in rows] == [("a", 2)]


class Told:
    """A query that reports these states one after the other, the last one for ever."""

    isActive = True

    def __init__(self, *told):
        self.told = list(told)

    @property
    def lastProgress(self):
        return self.told.pop(0) if len(self.told) > 1 else self.told[0]

    def exception(self):
        return None


def test_patience_begins_when_the_input_is_read(monkeypatch):
    clock = iter(range(0, 10**6, 200))
    monkeypatch.setattr(state.time, "monotonic", lambda: next(clock))
    monkeypatch.setattr(state.time, "sleep", lambda _: None)
    told = lambda batch, rows, held: {"batchId": batch, "numInputRows": rows, "stateOperators": [{"numRowsTotal": held}]}
    wait_until_idle(Told(None, None, None, None, told(0, 5, 2), told(1, 5, 2), told(2, 5, 2), told(3, 0, 0)))
    with pytest.raises(TimeoutError):
        wait_until_idle(Told(told(0, 5, 2), told(1, 0, 2)))
