"""Keyed state with a lifetime equals a plain walk over the drops, whatever the ticks."""

import datetime as dt
import random

import pyarrow as pa

from broadsheet import schemas
from broadsheet.operators import articles as A
from broadsheet.streaming import jobs, keyed

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "k STRING, at TIMESTAMP, o INT, tags ARRAY<STRING>, is_new INT"


def plain(ticks, days, sliding=False, inclusive=False, known=()):
    entries, out = dict(known), []
    last = {}
    for tick in ticks:
        for k, at, o, tags, n in tick:
            if k is not None and at is not None:
                best = last.get((k, at))
                if best is None or (o is not None, o or 0) >= (best[0] is not None, best[0] or 0):
                    last[k, at] = (o, n)
    for (k, at), (o, n) in sorted(last.items(), key=lambda x: x[0][1]):
        age = (at - entries[k]).days if k in entries else None
        repeat = age is not None and (age < days or (inclusive and age == days))
        if not repeat or sliding:
            entries[k] = at
        out.append((k, at, o, n, repeat))
    return sorted(out, key=str)


def run(spark, tmp_path, ticks, **how):
    for tick in ticks:
        df = spark.createDataFrame(tick, SCHEMA)
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = jobs.landed(spark, str(tmp_path / "in"), df.schema)
        keyed.store_keyed(keyed.with_lifetime(stream, "k", "at", ["o"], **how), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.columns == ["k", "at", "o", "tags", "is_new", "is_repeat"]
    return sorted(((r["k"], r["at"].replace(tzinfo=dt.timezone.utc), r["o"], r["is_new"], r["is_repeat"]) for r in got.collect()), key=str)


def made(seed, gaps):
    rng, day, ticks = random.Random(seed), 0, []
    for gap in gaps:
        day += gap
        at = START + dt.timedelta(days=day)
        rows = [(f"k{rng.randint(0, 9)}", at, rng.randint(0, 5) if i else None, ["x", None], 0) for i in range(12)]
        # A hot key, and rows that have no key or no time. Equal order means equal rows.
        rows += [("hot", at, i % 7, None, i % 7) for i in range(300)] + [(None, at, 1, [], 0), ("k1", None, 1, [], 0)]
        ticks.append(rows)
    return ticks


def test_let_in_refused_and_back_after_the_lifetime(spark, tmp_path):
    ticks = made(1, [0, 3, 4, 1, 6, 7])
    assert run(spark, tmp_path, ticks, lifetime=dt.timedelta(days=7)) == plain(ticks, 7)
    hot = [r[4] for r in sorted(plain(ticks, 7), key=lambda r: str(r[1])) if r[0] == "hot"]
    assert hot == [False, True, False, True, False, False]


def test_sliding_and_inclusive_with_known_state(spark, tmp_path):
    ticks = made(2, [0, 5, 5, 6])
    before = START - dt.timedelta(days=5)
    known = spark.createDataFrame([("hot", before), ("hot", before - dt.timedelta(days=9)), (None, before)], "k STRING, at TIMESTAMP")
    got = run(spark, tmp_path, ticks, lifetime=dt.timedelta(days=5), sliding=True, inclusive=True, known=known)
    assert got == plain(ticks, 5, True, True, {"hot": before})


def test_one_batch_of_several_drops_and_expired_entries_go(spark, tmp_path):
    ticks = made(3, [0, 2, 7, 9])
    together = [[row for tick in ticks for row in tick]]
    assert run(spark, tmp_path, together, lifetime=dt.timedelta(days=7)) == plain(ticks, 7)
    # Much later: the watermark passes every end, and the store holds the last keys alone.
    later = [[("z", START + dt.timedelta(days=d), 0, [], 0)] for d in (100, 200)]
    run(spark, tmp_path, later, lifetime=dt.timedelta(days=7))
    state = spark.read.format("statestore").option("path", str(tmp_path / "cp")).option("stateVarName", "entry").load()
    assert {r["key"]["k"] for r in state.select("key").collect()} == {"z"}


def test_threads_take_over_a_log(spark, tmp_path):
    rows = [(f"t{i}", f"https://www.reddit.com/r/a/{i % 3}", "", "s", None, 0, i, START) for i in range(6)]
    rows += [("t", "https://example.com", "", "s", None, 0, 9, START), ("t", None, "", "s", None, 0, 10, START)]
    df = spark.createDataFrame(rows, f"{schemas.ARTICLE.simpleString()[7:-1]}, seen_at TIMESTAMP")
    df.write.parquet(str(tmp_path / "in"))
    known = spark.createDataFrame([(rows[0][1], START - dt.timedelta(days=6)), (rows[1][1], START - dt.timedelta(days=7))], "link STRING, at TIMESTAMP")
    keyed.keyed_threads(jobs.landed(spark, str(tmp_path / "in"), df.schema), str(tmp_path / "out"), str(tmp_path / "cp"), "seen_at", known=known)
    got = spark.read.schema(schemas.THREAD).parquet(str(tmp_path / "out")).collect()
    assert sorted((r["title"], r["fetched_at"]) for r in got) == [("t4", START.replace(tzinfo=None)), ("t5", START.replace(tzinfo=None))]
    assert A.thread_articles(df).count() == 6


def test_state_by_buckets_gives_what_state_by_keys_gives(spark, tmp_path):
    """Two buckets for all keys; later the watermark passes every end and the store holds the last keys alone."""
    ticks = made(4, [0, 3, 4, 6])
    for i, how in enumerate((dict(), dict(sliding=True, inclusive=True))):
        path = tmp_path / str(i)
        assert run(spark, path, ticks, lifetime=dt.timedelta(days=7), buckets=2, **how) == plain(ticks, 7, **how)
    later = [[(k, START + dt.timedelta(days=d), 0, [], 0) for k in ("z", *"abcdefgh")] for d in (100, 200)]
    run(spark, path, later, lifetime=dt.timedelta(days=7), buckets=2, **how)
    state = spark.read.format("statestore").option("path", str(path / "cp")).option("stateVarName", "entries").load()
    held = [r["value"]["entries"] for r in state.collect()]
    assert sorted(k for h in held for k in pa.ipc.open_stream(bytes(h)).read_all().column("key").to_pylist()) == sorted(("z", *"abcdefgh"))
    assert len(held) <= 2
