"""The daily job: state, intake, threads, dedup, curation, publication, commit.

State is a log of runs (``plans/statelog.py``): a run reads what was committed before
it, appends what it learned and writes its commit marker last, after delivery. A run
that failed anywhere shows in no later one, and one that is repeated overwrites its
own folders with the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.times import moment
from ..operators import articles as A
from ..operators import state as S
from ..session import remove
from .ordered import last_wins
from .statelog import StateLog, appeared, first_day

__all__ = ["StateLog", "run_daily", "run_sweep_merge", "signal_history"]


def run_daily(
    log: StateLog,
    articles: DataFrame,
    run: int,
    as_of,
    digest_of: Callable[[DataFrame], DataFrame],
    deliver: Callable[[DataFrame], bool] = lambda published: True,
    max_threads: int = S.MAX_THREADS,
    signals: DataFrame | None = None,
) -> bool:
    """One run over taken-in articles. True when it delivered and committed.

    ``digest_of`` turns the new articles into digest rows. Threads are built
    before the dedup, from all articles. Everything offered to the digest is
    marked as sent, not only what the digest kept. ``signals`` is the sweep of
    this run, if one was due: its history, threads and sent keys all become
    visible by the one commit behind the delivery, or not at all.

    The offered rows are written once and read back, so what is marked as sent is
    what was delivered even if the input changes meanwhile.
    """
    keyed = A.with_article_key(articles)
    log.write(A.not_sent(keyed, log.sent(run, as_of)), "offered", run)
    new = log.written("offered", run)
    log.write(digest_of(new), "digests", run)
    if signals is not None:
        _write_sweep(log, signals, run, as_of)
    if not deliver(log.written("digests", run)):
        for table in ("offered", "digests", "signals", "fresh", "sweep_runs"):
            remove(log.spark, log.path(table, run, as_of))
        return False

    offered = last_wins(
        new.select("article_key", "title", "link", "source", "feed_ord", "feed_pos"),
        ["article_key"], F.struct("feed_ord", "feed_pos"),
    )
    sent = offered.select("article_key", "title", "link", "source", moment(as_of).alias("sent_at"))
    log.write(sent, "sent", run, as_of)
    cached = log.threads(run, as_of)
    picked = S.uncached_threads(keyed.withColumn("_run", F.lit(0)), cached, ["_run"], max_threads).drop("_run")
    built = S.build_threads(last_wins(picked, ["link"], F.struct("feed_ord", "feed_pos")), as_of)
    log.write(built, "threads", run, as_of)
    log.commit(run)
    return True


def _write_sweep(log: StateLog, signals: DataFrame, run: int, as_of) -> None:
    """Signals, the fresh ones among them and the run stamp, not yet visible."""
    from ..operators.signals import fresh_signals

    log.write(signals.select(*schemas.SIGNAL.fieldNames()), "signals", run, as_of)
    prior = log.read("signals", schemas.SIGNAL, run, first_day(as_of, S.SIGNAL_DAYS)).drop("run", "day")
    log.write(fresh_signals(log.written("signals", run, as_of), prior), "fresh", run)
    stamp = log.spark.range(1).select(
        F.date_format(moment(as_of), "yyyy-MM-dd").alias("last_run_date"), F.lit(str(run)).alias("last_batch")
    )
    log.write(stamp, "sweep_runs", run)


def run_sweep_merge(log: StateLog, signals: DataFrame, run: int, as_of, deliver: Callable[[DataFrame], bool] = lambda fresh: True) -> DataFrame | None:
    """A sweep on its own: append to the signal log and commit once ``deliver`` took the fresh signals.

    Returns the fresh signals, or None where they were not delivered.
    """
    _write_sweep(log, signals, run, as_of)
    fresh = log.written("fresh", run)
    if not deliver(fresh):
        for table in ("signals", "fresh", "sweep_runs"):
            remove(log.spark, log.path(table, run, as_of))
        return None
    log.commit(run)
    return fresh


def signal_history(log: StateLog, before: int, as_of, days: int = S.SIGNAL_DAYS) -> DataFrame:
    """The rolling history as the merge defines it, read out of the log; sweeps before its first day are not read."""
    rows = log.read("signals", schemas.SIGNAL, before, first_day(as_of, days)).filter(F.coalesce("id", F.lit("")) != "")
    merged = last_wins(rows, ["id"], appeared(), first_seen="first_seen").drop("run", "day")
    cutoff = F.date_format(moment(as_of) - F.expr(f"INTERVAL '{int(days)}' DAY"), "yyyy-MM-dd")
    return merged.filter(F.coalesce("date", F.lit("")) >= cutoff)
