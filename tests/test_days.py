"""Days close once, feeds without rows are reported once, and nothing reopens."""

import datetime as dt

from pyspark.sql import functions as F

from broadsheet.plans.statelog import StateLog
from broadsheet.streaming import days


def drop(spark, *rows):
    made = [(s, None if d is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=d)) for s, d in rows]
    return spark.createDataFrame(made, "source STRING, ts TIMESTAMP_NTZ").withColumn("ts", F.col("ts").cast("timestamp"))


def feeds(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "source STRING")


def closed(log):
    got = [(r["date"].day, r["source"], r["n_rows"], r["alert"]) for r in days.closed_days(log).collect()]
    return sorted(got, key=str)


def test_each_day_closes_once_over_ticks(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"), "days")
    expected = feeds(spark, "a", "b", "b", None)
    step = lambda run, *rows, **how: days.close_days(log, drop(spark, *rows), run, expected, "ts", **how)
    step(0)  # nothing has ever come
    step(1, ("a", None))
    assert closed(log) == []
    step(2, ("a", 0.5), ("a", 0.6), ("x", 0.1), (None, 0.2), ("a", 1.2), ("b", None))
    assert closed(log) == []
    step(3, ("b", 1.5), ("a", 2.1))  # day 1 closes: one day behind day 3
    first = [(1, "a", 2, None), (1, "b", 0, "no articles"), (1, "x", 1, None), (1, None, 1, None)]
    assert closed(log) == sorted(first, key=str)
    step(4)
    step(5, ("a", 0.7), ("b", 2.2), ("a", 5.0))  # late for day 1; days 2 to 4 close, 4 empty
    rest = [(2, "a", 1, None), (2, "b", 1, None), (3, "a", 1, None), (3, "b", 1, None), (4, "a", 0, "no articles"), (4, "b", 0, "no articles")]
    assert closed(log) == sorted(first + rest, key=str)
    assert [tuple(r)[1:3] for r in log.read("late", days.LATE, 9).collect()] == [("a", 1)]
    # The carry holds open days alone.
    assert {r["date"].day for r in log.read("open", days.OPEN, 9).filter("run = 5").collect()} == {6}


def test_a_run_that_died_or_repeats_changes_nothing(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"), "days")
    expected, first, second = feeds(spark, "a"), drop(spark, ("a", 0.5)), drop(spark, ("a", 1.0), ("a", 3.5))
    days.close_days(log, first, 0, expected, "ts")
    # Died before its commit, with other rows than the next try has.
    log.write(spark.createDataFrame([(dt.date(2024, 1, 1), "a", 9, None)], days.CLOSED), "closed", 1)
    assert closed(log) == []
    for _ in range(2):
        days.close_days(log, second, 1, expected, "ts")
        assert closed(log) == [(1, "a", 1, None), (2, "a", 1, None)]


def test_future_rows_wait_for_their_day(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"), "days")
    days.close_days(log, drop(spark, ("a", 0.5), ("a", 400.0)), 0, feeds(spark, "a"), "ts", as_of="2024-01-01 18:00:00")
    assert closed(log) == []
    days.close_days(log, drop(spark, ("a", 2.5)), 1, feeds(spark, "a"), "ts", as_of="2024-01-03 18:00:00")
    assert closed(log) == [(1, "a", 1, None)]
    assert log.read("open", days.OPEN, 9).filter("run = 1").agg(F.sum("n_rows")).collect()[0][0] == 2
