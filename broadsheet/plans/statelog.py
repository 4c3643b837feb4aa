"""State as a log of runs, with snapshots that keep it short.

Every run of a job appends what it learned under its own folder and a commit marker
is written last; folders and markers carry the job's name, so jobs that share a root
and a run id do not touch each other's rows. A reader sees the runs of its own job
before its own run and all committed runs of other jobs. A run that is repeated
overwrites its folders with the same rows.

``compact`` folds committed runs into a snapshot: entries that have outlived their
horizon go and those that no reader can see any more, because a later or earlier one
of the same key wins. A pointer, written last, says up to which run of each job the snapshot stands
for the log, and readers take the snapshot and the later runs. Folders and markers that a
snapshot covers are deleted with the next one, so a reader that began before a snapshot
ends unharmed. A run that a snapshot covers can't be repeated, so the last runs of
each job stay out of it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import state as S
from ..session import remove
from ..sources.scans import state_table
from .ordered import last_wins

RUN = [T.StructField("job", T.StringType()), T.StructField("run", T.LongType())]
DAY = T.StructField("day", T.DateType())
#: Tables read by age: their folders start with the day of the run.
DATED = ("sent", "threads", "signals")


def day_of(as_of: str | date) -> str:
    return as_of.isoformat()[:10] if isinstance(as_of, date) else str(as_of)[:10]


def first_day(as_of: str | date, days: int) -> str:
    return (date.fromisoformat(day_of(as_of)) - timedelta(days=days)).isoformat()


@dataclass(frozen=True)
class StateLog:
    """State tables under one folder, as one job sees them."""

    spark: SparkSession
    root: str
    job: str = "daily"

    def of_job(self, job: str) -> StateLog:
        """The same log as another job writes to it."""
        return replace(self, job=job)

    def path(self, table: str, run: int | None = None, as_of=None) -> str:
        day = f"/day={day_of(as_of)}" if table in DATED and run is not None else ""
        return f"{self.root}/{table}{day}" + ("" if run is None else f"/job={self.job}/run={run}")

    def _pointers(self) -> list[tuple[int, dict[str, int]]]:
        """Snapshots by number, each with the last run of every job that it stands for. One row per snapshot and job."""
        schema = T.StructType([T.StructField("covers", T.StringType()), T.StructField("upto", T.LongType()), T.StructField("id", T.LongType())])
        found: dict[int, dict[str, int]] = {}
        for r in state_table(self.spark, f"{self.root}/pointers", schema).collect():
            found.setdefault(r.id, {})[r.covers] = r.upto
        return sorted(found.items())

    def _visible(self, before: int) -> Column:
        return (F.col("job") != self.job) | (F.col("run") < before)

    @staticmethod
    def _later(covers: dict[str, int]) -> Column:
        """Not in a snapshot."""
        later = F.lit(True)
        for job, upto in covers.items():
            later = later & ((F.col("job") != job) | (F.col("run") > upto))
        return later

    def _committed(self, before: int, covers: dict[str, int]) -> DataFrame:
        markers = state_table(self.spark, f"{self.root}/commits", T.StructType(RUN))
        return markers.filter(self._visible(before) & self._later(covers)).select("job", "run")

    def committed(self, before: int) -> DataFrame:
        """Committed runs that are not folded into a snapshot."""
        pointers = self._pointers()
        return self._committed(before, pointers[-1][1] if pointers else {})

    def _rows(self, table: str, schema: T.StructType, before: int, since, pointer: tuple[int, dict[str, int]] | None) -> DataFrame:
        covers = pointer[1] if pointer else {}
        days = [DAY] if table in DATED else []

        def seen(path: str) -> DataFrame:
            rows = state_table(self.spark, path, T.StructType([*schema.fields, *days, *RUN])).filter(self._visible(before))
            return rows.filter(F.col("day") >= F.lit(since).cast("date")) if since is not None and days else rows

        live = seen(self.path(table)).filter(self._later(covers)).join(self._committed(before, covers), ["job", "run"], "left_semi")
        rows = live.select(*schema.fieldNames(), *[d.name for d in days], "job", "run")
        return rows.unionByName(seen(self._snapshot(pointer[0], table))) if pointer else rows

    def read(self, table: str, schema: T.StructType, before: int, since=None) -> DataFrame:
        """Rows of committed runs that this job sees before a run of its own; ``run`` and, for dated tables, ``day`` included.

        Run, job and day filters prune folders. ``since`` leaves out runs of earlier days.
        """
        pointers = self._pointers()
        return self._rows(table, schema, before, since, pointers[-1] if pointers else None).drop("job")

    def write(self, df: DataFrame, table: str, run: int, as_of=None) -> None:
        df.write.mode("overwrite").parquet(self.path(table, run, as_of))

    def written(self, table: str, run: int, as_of=None) -> DataFrame:
        """What this run has written itself, committed or not."""
        return self.spark.read.parquet(self.path(table, run, as_of))

    def commit(self, run: int) -> None:
        """Make a run visible. The marker folder itself carries the job and the run id."""
        self.spark.range(1).write.mode("overwrite").parquet(self.path("commits", run))

    def sent(self, before: int, as_of) -> DataFrame:
        """Retained sent keys, newest entry per key."""
        rows = S.retained(self.read("sent", schemas.SENT, before, first_day(as_of, S.SENT_DAYS)), "sent_at", as_of)
        return last_wins(rows.drop("day"), ["article_key"], newest_sent()).drop("run")

    def threads(self, before: int, as_of) -> DataFrame:
        """Retained threads; the first build of a link stays."""
        rows = S.retained(self.read("threads", schemas.THREAD, before, first_day(as_of, S.SENT_DAYS)), "fetched_at", as_of)
        return last_wins(rows.drop("day"), ["url"], first_build()).drop("run")

    # ------------------------------------------------------------ snapshots

    def _snapshot(self, number: int, table: str) -> str:
        return f"{self.root}/snapshots/id={number}/{table}"

    def compact(self, as_of, keep: int = 1) -> int | None:
        """Fold all committed runs but the last ``keep`` of each job into a new snapshot; its number, or None if there is nothing to fold."""
        pointers = self._pointers()
        now = pointers[-1] if pointers else None
        covers = dict(now[1]) if now else {}
        latest = self._committed(2**62, covers).filter(F.col("run").isNotNull())
        # One row per job: the run behind which only the last ones stay.
        behind = latest.groupBy("job").agg(F.sort_array(F.collect_list("run"), asc=False).alias("runs")).collect()
        upto = {r.job: r.runs[keep] for r in behind if len(r.runs) > keep}
        if not upto:
            return None
        covers |= upto
        number = (now[0] if now else 0) + 1
        every = StateLog(self.spark, self.root, job="")
        for table, (schema, days, folded) in FOLDED.items():
            since = first_day(as_of, days) if days else None
            rows = every._rows(table, schema, 0, since, now).filter(~self._later(covers))
            folded(rows, as_of).write.mode("overwrite").parquet(self._snapshot(number, table))
        pointer = self.spark.createDataFrame(sorted(covers.items()), "covers string, upto bigint")
        pointer.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/pointers/id={number}")
        # What the snapshot before this one covers is read by nobody that starts now or began since.
        if now:
            self._drop(now[1])
        for old, _ in pointers[:-1]:
            remove(self.spark, f"{self.root}/pointers/id={old}")
            remove(self.spark, f"{self.root}/snapshots/id={old}")
        return number

    def _drop(self, covers: dict[str, int]) -> None:
        """Delete the folders and markers of covered runs."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for table in [*FOLDED, "commits", "offered", "digests", "sweep_runs"]:
            for job, upto in covers.items():
                runs = hadoop.Path(f"{self.root}/{table}{'/day=*' if table in DATED else ''}/job={job}/run=*")
                for status in runs.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(runs) or []:
                    path = status.getPath()
                    if int(path.getName().removeprefix("run=")) <= upto and not (table == "sweep_runs" and path.getName() == f"run={upto}"):
                        remove(self.spark, path.toString())


def newest_sent() -> Column:
    return F.struct("sent_at", "run")


def first_build() -> Column:
    return F.struct(-F.unix_micros(F.col("fetched_at").cast("timestamp")), -F.col("run"))


def appeared() -> Column:
    """Place of a signal in the whole history."""
    return F.struct("day", "run", "seq")


def _newest_sent(rows: DataFrame, as_of) -> DataFrame:
    return last_wins(S.retained(rows, "sent_at", as_of), ["article_key"], newest_sent())


def _first_builds(rows: DataFrame, as_of) -> DataFrame:
    return last_wins(S.retained(rows, "fetched_at", as_of), ["url"], first_build())


def _outer_signals(rows: DataFrame, as_of) -> DataFrame:
    """Of each id the last signal, whose values stand, and the first, whose place stands."""
    row = F.struct(*rows.columns)
    both = rows.filter(F.coalesce("id", F.lit("")) != "").groupBy("id").agg(F.max_by(row, appeared()).alias("b"), F.min_by(row, appeared()).alias("a"))
    return both.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("r")).select("r.*")


def _as_they_are(rows: DataFrame, as_of) -> DataFrame:
    return rows


#: Tables that snapshots hold: shape, horizon in days, and what stays of their rows.
FOLDED = {
    "sent": (schemas.SENT, S.SENT_DAYS, _newest_sent),
    "threads": (schemas.THREAD, S.SENT_DAYS, _first_builds),
    "signals": (schemas.SIGNAL, S.SIGNAL_DAYS, _outer_signals),
    "fresh": (schemas.SIGNAL, None, _as_they_are),
}
