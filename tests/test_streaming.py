"""Incremental runs equal batch runs, and failed or repeated runs leave no double effect."""

import datetime as dt
import random

from pyspark.sql import functions as F

from broadsheet import schemas
from broadsheet.operators import articles as A
from broadsheet.operators import state as S
from broadsheet.plans.daily import StateLog, run_daily, run_sweep_merge, signal_history
from broadsheet.streaming import jobs

DAYS = [f"2024-01-{d:02d} 06:00:00" for d in range(10, 22)]


def count_by_source(new):
    return new.groupBy("source").agg(F.count("*").alias("n"))


def drops(spark, seed=11):
    rng = random.Random(seed)
    for _ in DAYS:
        rows = [(f"t{rng.randint(0, 9)}", f"https://www.reddit.com/r/a/{rng.randint(0, 5)}", "", "s", None, 0, i) for i in range(8)]
        yield spark.createDataFrame(rows, schemas.ARTICLE)


def test_log_equals_upserts_applied_day_by_day(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"))
    sent, threads = {}, {}
    for run, (day, df) in enumerate(zip(DAYS[:5], drops(spark))):
        now = dt.datetime.fromisoformat(day)
        rows = A.with_article_key(df).orderBy("feed_pos").collect()
        sent = {k: v for k, v in sent.items() if v > now - dt.timedelta(days=2)}
        # A horizon of two days on the plain side, applied to the log below.
        new = [r for r in rows if r["article_key"] not in sent]
        state = S.retained(log.read("sent", schemas.SENT, run), "sent_at", day, 2)
        got = A.not_sent(A.with_article_key(df), state).collect()
        assert sorted(r["feed_pos"] for r in got) == sorted(r["feed_pos"] for r in new)
        sent.update({r["article_key"]: now for r in new})
        offered = A.with_article_key(df).join(spark.createDataFrame([(r["feed_pos"],) for r in new] or [(-1,)], "feed_pos BIGINT"), "feed_pos", "left_semi")
        log.write(S.mark_sent(spark.createDataFrame([], schemas.SENT), offered, day), "sent", run, day)
        log.commit(run)


def test_undelivered_and_repeated_runs(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"))
    day, df = DAYS[0], next(drops(spark))
    assert not run_daily(log, df, 1, day, count_by_source, deliver=lambda published: False)
    assert log.sent(9, day).count() == 0 and log.threads(9, day).count() == 0
    for _ in range(2):
        assert run_daily(log, df, 2, day, count_by_source)
    keys = A.with_article_key(df).select("article_key").distinct().count()
    assert log.read("sent", schemas.SENT, 9).count() == keys == log.sent(9, day).count()
    assert run_daily(log, df, 3, day, count_by_source)
    assert spark.read.parquet(log.path("digests", 3)).count() == 0
    # The first build of a link stays, a second run adds nothing.
    assert log.read("threads", schemas.THREAD, 9).count() == df.select("link").distinct().count()


def test_stream_of_drops_equals_batch_runs(spark, tmp_path):
    batch, stream = StateLog(spark, str(tmp_path / "batch")), StateLog(spark, str(tmp_path / "stream"))
    landing = tmp_path / "landing"
    for run, (day, df) in enumerate(zip(DAYS[:3], drops(spark, 5))):
        run_daily(batch, df, run, day, count_by_source)
        df.coalesce(1).write.mode("append").parquet(str(landing))
    source = jobs.landed(spark, str(landing), schemas.ARTICLE, files_per_batch=1)
    jobs.daily_stream(source, stream, str(tmp_path / "cp"), lambda i: DAYS[i], count_by_source)
    for log in (batch, stream):
        assert log.committed(99).count() == 3
    want = sorted(map(str, batch.sent(99, DAYS[3]).collect()))
    assert sorted(map(str, stream.sent(99, DAYS[3]).collect())) == want
    assert sorted(map(str, stream.threads(99, DAYS[3]).collect())) == sorted(map(str, batch.threads(99, DAYS[3]).collect()))


def test_bounded_dedup_and_daily_counts(spark, tmp_path):
    rows = [("a", dt.datetime(2024, 1, 1, 1), "s"), ("a", dt.datetime(2024, 1, 1, 2), "s"), ("b", dt.datetime(2024, 1, 4), "s")]
    df = spark.createDataFrame(rows, "article_key STRING, ts TIMESTAMP, source STRING")
    df.write.parquet(str(tmp_path / "in"))
    jobs.dedup_within(jobs.landed(spark, str(tmp_path / "in"), df.schema), str(tmp_path / "out"), str(tmp_path / "cp1"), "ts")
    assert sorted(r["article_key"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
    jobs.daily_counts(jobs.landed(spark, str(tmp_path / "in"), df.schema), str(tmp_path / "counts"), str(tmp_path / "cp2"), "ts")
    counts = spark.read.parquet(str(tmp_path / "counts"))
    assert [(str(r["day"])[:10], r["n_rows"]) for r in counts.collect()] == [("2024-01-01", 2)]
    days = counts.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "source", "n_rows")
    assert [tuple(r) for r in jobs.silent_sources(days, ["s", "quiet"]).select("day", "source").collect()] == [("2024-01-01", "quiet")]


def test_two_ticks_neither_lose_nor_repeat(spark, tmp_path):
    landing, out, log = str(tmp_path / "in"), str(tmp_path / "out"), StateLog(spark, str(tmp_path / "log"))
    rows = [[("a", "1"), ("b", "2")], [("c", "3"), ("a", "1")], [("d", "4")]]
    seen = []
    for tick, part in enumerate(rows):
        df = spark.createDataFrame([(t, link, "", "s", None, 0, i) for i, (t, link) in enumerate(part)], schemas.ARTICLE)
        df.coalesce(1).write.mode("append").parquet(landing)
        jobs.ingest(jobs.landed(spark, landing, schemas.ARTICLE), out, str(tmp_path / "cp-ingest"))
        jobs.daily_stream(jobs.landed(spark, landing, schemas.ARTICLE), log, str(tmp_path / "cp-daily"), lambda i: DAYS[i], count_by_source)
        seen.append(sorted(r["title"] for r in spark.read.parquet(log.path("offered", tick)).collect()))
    assert sorted(r["title"] for r in spark.read.parquet(out).collect()) == ["a", "a", "b", "c", "d"]
    assert seen == [["a", "b"], ["c"], ["d"]]
    assert log.committed(99).count() == 3


def test_undelivered_run_leaves_no_folder_and_sweep_waits_for_delivery(spark, tmp_path):
    log, df = StateLog(spark, str(tmp_path / "log")), next(drops(spark))
    signals = spark.createDataFrame([tuple(f"x{i}" for i in range(len(schemas.SIGNAL) - 1)) + ((1, 0),)], schemas.SIGNAL)
    assert not run_daily(log, df, 1, DAYS[0], count_by_source, deliver=lambda published: False, signals=signals)
    assert [p for p in (tmp_path / "log").rglob("*.parquet")] == []
    assert run_daily(log, df, 2, DAYS[0], count_by_source, signals=signals)
    assert log.read("signals", schemas.SIGNAL, 3).count() == log.read("fresh", schemas.SIGNAL, 3).count() == 1
    assert run_sweep_merge(log, signals, 3, DAYS[1], deliver=lambda fresh: False) is None
    assert log.read("signals", schemas.SIGNAL, 9).count() == 1


def test_old_state_folders_are_not_read(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"))
    for run, day in enumerate(DAYS):
        run_daily(log, next(drops(spark, run)), run, day, count_by_source)
    plan = log.sent(99, DAYS[-1])._jdf.queryExecution().executedPlan().toString()
    assert "(day#" in plan[plan.index("PartitionFilters"):]
    read = {f.split("/day=")[1][:10] for f in log.sent(99, DAYS[-1]).inputFiles() if "/day=" in f}
    assert read and log.sent(99, DAYS[-1]).count() > 0


def test_days_without_any_row_are_reported(spark):
    counts = spark.createDataFrame([("2024-01-01", "s", 1), ("2024-01-03", "s", 1)], "day STRING, source STRING, n_rows BIGINT")
    got = sorted(tuple(r) for r in jobs.silent_sources(counts, ["s", "q"]).select("day", "source").collect())
    assert got == [("2024-01-01", "q"), ("2024-01-02", "q"), ("2024-01-02", "s"), ("2024-01-03", "q")]


def test_a_key_comes_back_after_the_horizon(spark, tmp_path):
    got = []
    for day in (1, 2, 20, 40, 41):
        row = [("a", dt.datetime(2024, 1, 1) + dt.timedelta(days=day))]
        spark.createDataFrame(row, "article_key STRING, ts TIMESTAMP").write.mode("append").parquet(str(tmp_path / "in"))
        source = jobs.landed(spark, str(tmp_path / "in"), spark.createDataFrame(row, "article_key STRING, ts TIMESTAMP").schema)
        jobs.dedup_within(source, str(tmp_path / "out"), str(tmp_path / "cp"), "ts")
        got.append(spark.read.parquet(str(tmp_path / "out")).count())
    assert got[0] == got[1] == 1 and got[-1] >= 2


def _signal(i, date="2024-01-10", summary=""):
    names = schemas.SIGNAL.fieldNames()
    return tuple({"id": f"i{i}", "date": date, "summary": summary, "seq": (1, i)}.get(n, "x") for n in names)


def _signals(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.SIGNAL)


def test_jobs_on_one_root_do_not_see_each_others_failed_runs(spark, tmp_path):
    root, df = str(tmp_path / "log"), next(drops(spark))
    daily, sweep = StateLog(spark, root), StateLog(spark, root, "sweep")
    sent = A.with_article_key(df).selectExpr("article_key", "title", "link", "source", "TIMESTAMP_NTZ '2024-01-10 06:00:00' AS sent_at")
    daily.write(sent, "sent", 5, DAYS[0])  # dies before its commit
    assert run_sweep_merge(sweep, _signals(spark, _signal(1)), 5, DAYS[0]) is not None
    assert daily.sent(9, DAYS[1]).count() == 0
    assert daily.read("signals", schemas.SIGNAL, 5).count() == 1  # committed by the other job
    # Threads of equal run ids lie beside each other.
    source = str(tmp_path / "in")
    df.coalesce(1).write.parquet(source)
    jobs.threads_stream(jobs.landed(spark, source, schemas.ARTICLE), daily, str(tmp_path / "cp"), lambda i: DAYS[i])
    known = daily.threads(9, DAYS[0]).count()
    assert known > 0 and run_daily(daily, df, 0, DAYS[0], count_by_source)
    assert daily.threads(9, DAYS[0]).count() == known and daily.of_job("threads").committed(9).count() == 3


def _state(log, as_of):
    history = signal_history(log, 99, as_of).drop("first_seen")
    return [sorted(map(str, df.collect())) for df in (log.sent(99, as_of), log.threads(99, as_of), history)]


def test_snapshots_keep_rows_and_readers_and_bound_files(spark, tmp_path):
    log, plain = StateLog(spark, str(tmp_path / "log")), StateLog(spark, str(tmp_path / "plain"))
    days = DAYS[:6]
    for run, (day, df) in enumerate(zip(days, drops(spark, 7))):
        for x in (log, plain):
            run_daily(x, df, run, day, count_by_source, signals=_signals(spark, _signal(run % 4, day[:10], day), _signal(100 + run, day[:10])))
        if run % 2:
            reader = log.read("sent", schemas.SENT, 99)
            rows = sorted(map(str, reader.collect()))
            assert log.compact(day) is not None
            # A reader that began before the snapshot reads on.
            assert sorted(map(str, reader.collect())) == rows
    assert _state(log, days[-1]) == _state(plain, days[-1])
    order = lambda x: [r["id"] for r in signal_history(x, 99, days[-1]).orderBy("first_seen").collect()]
    assert order(log) == order(plain)
    # Old runs, markers and snapshots are gone: what the last snapshot but one covers is read by nobody.
    assert len(list((tmp_path / "log" / "commits").rglob("run=*"))) == 3
    assert len(list((tmp_path / "log" / "snapshots").glob("id=*"))) == 2
    assert len(log.sent(99, days[-1]).inputFiles()) < len(plain.sent(99, days[-1]).inputFiles())


def test_a_snapshot_without_a_pointer_changes_nothing(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"))
    for run, (day, df) in enumerate(zip(DAYS[:3], drops(spark, 8))):
        run_daily(log, df, run, day, count_by_source)
    want = _state(log, DAYS[3])
    # Died before its pointer: the half-written snapshot is overwritten by the next try.
    log.read("sent", schemas.SENT, 99).limit(1).write.parquet(log._snapshot(1, "sent"))
    assert _state(log, DAYS[3]) == want
    assert log.compact(DAYS[3]) == 1 and _state(log, DAYS[3]) == want
    assert log.compact(DAYS[3]) is None


def test_a_stream_takes_the_sweep_behind_the_same_delivery(spark, tmp_path):
    log, source = StateLog(spark, str(tmp_path / "log")), str(tmp_path / "in")
    for df in list(drops(spark))[:2]:
        df.coalesce(1).write.mode("append").parquet(source)
    stream = jobs.landed(spark, source, schemas.ARTICLE, files_per_batch=1)
    jobs.daily_stream(stream, log, str(tmp_path / "cp"), lambda i: DAYS[i], count_by_source,
                      deliver=lambda published: published.count() >= 0, sweep_of=lambda i: _signals(spark, _signal(i)) if i == 1 else None)
    assert [r["run"] for r in log.read("signals", schemas.SIGNAL, 9).collect()] == [1]
