"""The fold of document states against a plain one, however the log is cut."""

import datetime as dt
import random
from collections import Counter

import pytest

from sheafline.operators import progress

SCHEMA = "company_id string, document_id string, status string, ts timestamp, seq long, chunk_count long, error_message string"
NOW = dt.datetime(2024, 1, 1, 12)
BIG = 1_800_000_000_000_000_000


def at(second):
    return None if second is None else NOW + dt.timedelta(seconds=second)


def plain(rows):
    """Rows with what they did, and the state of each document, one change after another."""
    order = lambda r: [(v is not None, v) for v in r[3:5]] + [(v is not None, v or "") for v in (r[2],)] + [(v is not None, v or 0) for v in (r[5],)] + [(v is not None, v or "") for v in (r[6],)]
    out, states = [], {}
    for row in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: (r[0], r[1], order(r))):
        held = states.setdefault(row[:2], {"state": None, "chunks": None, "message": None, "illegal": 0})
        legal = row[2] in progress.LEGAL_STEPS[held["state"]]
        out.append((*row[:3], row[4], held["state"], legal))
        if legal:
            held["state"], held["message"] = row[2], row[6] if row[2] == "error" else None
            held["chunks"] = row[5] if row[2] == "processed" else held["chunks"]
        else:
            held["illegal"] += 1
    out += [(*r[:3], r[4], None, False) for r in rows if r[0] is None or r[1] is None]
    return Counter(out), {k: (h["state"], h["chunks"], h["message"], h["illegal"]) for k, h in states.items()}


def run(spark, rows):
    steps = progress.status_steps(spark.createDataFrame(rows, SCHEMA))
    got = Counter((r["company_id"], r["document_id"], r["status"], r["seq"], r["before"], r["legal"]) for r in steps.collect())
    done = {(r["company_id"], r["document_id"]): (r["status"], r["chunk_count"], r["error_message"], r["n_illegal"]) for r in progress.document_progress(steps).collect()}
    return got, done


@pytest.mark.parametrize("part", [7, 50_000])
def test_equals_a_plain_fold(spark, monkeypatch, part):
    rng = random.Random(part)
    monkeypatch.setattr(progress, "PART_ROWS", part)
    states = ["pending", "uploaded", "processing", "processed", "error"]
    rows = []
    for i in range(400):
        # One document has most of the changes, so that it lies in many parts.
        document = "hot" if rng.random() < 0.6 else str(rng.randrange(12))
        status = rng.choice([*states, *states[:3], "indexed", None])
        second = None if rng.random() < 0.03 else rng.randrange(200)
        seq = None if rng.random() < 0.1 else BIG + rng.randrange(5)
        rows.append((rng.choice("ab"), document, status, at(second), seq, rng.randrange(9), f"m{rng.randrange(3)}"))
    rows += rows[:20]
    assert run(spark, rows) == plain(rows)


def test_late_illegal_and_unnamed_changes(spark):
    rows = [
        ("c", "1", "processed", at(40), 4, 7, None), ("c", "1", "pending", at(10), 1, None, None),
        ("c", "1", "processing", at(30), 3, None, None), ("c", "1", "uploaded", at(20), 2, None, None),
        ("c", "1", "error", at(50), 5, None, "too late"), ("c", "2", "processed", at(1), 1, 3, None),
        ("c", "3", "pending", at(1), None, None, None), ("c", "3", "error", at(2), None, None, "broken"),
        (None, "4", "pending", at(1), 1, None, None), ("c", None, "pending", at(1), 1, None, None), ("c", "5", "odd", at(1), 1, None, None),
    ]
    steps = progress.status_steps(spark.createDataFrame(rows, SCHEMA))
    reasons = Counter((r["document_id"], r["reason"]) for r in steps.collect())
    assert reasons["1", None] == 4 and reasons["1", "illegal_step"] == 1 and reasons["2", "illegal_step"] == 1
    assert reasons["4", "no_document"] == reasons[None, "no_document"] == reasons["5", "unknown_state"] == 1
    done = {r["document_id"]: r for r in progress.document_progress(steps).collect()}
    assert set(done) == {"1", "2", "3", "5"}
    assert (done["1"]["status"], done["1"]["chunk_count"], done["1"]["error_message"], done["1"]["n_illegal"]) == ("processed", 7, None, 1)
    assert (done["3"]["status"], done["3"]["error_message"], done["3"]["updated_at"]) == ("error", "broken", at(2))
    assert done["2"]["status"] is None and done["5"]["status"] is None
    assert run(spark, []) == (Counter(), {})


def test_other_steps(spark):
    steps = {None: ("a",), "a": ("b",), "b": ("a",)}
    rows = [("c", "1", s, at(i), i, None, None) for i, s in enumerate("abbaab")]
    got = progress.status_steps(spark.createDataFrame(rows, SCHEMA), steps).orderBy("seq").collect()
    assert [r["legal"] for r in got] == [True, True, False, True, False, True]
