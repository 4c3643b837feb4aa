"""Keyed state with a lifetime, held by the stream itself in its state store.

The state log answers the same question for batch runs by joining its history. Here
every key keeps the time it was last let in, in the partitioned state store, so a
tick reads and writes the entries of the keys it meets and no history at all.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..functions.times import from_epoch
from ..operators import articles as A
from ..operators import state as S
from .jobs import ingest

#: Event time in microseconds and the bucket of the key, next to the columns of the stream.
_MICROS, _BUCKET = "_seen_micros", "_bucket"
#: Buckets of the signals' ids.
BUCKETS = 1024


def with_lifetime(
    stream: DataFrame, key: str, seen: str, order: Sequence[str], lifetime: dt.timedelta,
    sliding: bool = False, inclusive: bool = False, known: DataFrame | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """One row per key and ``seen`` time with ``is_repeat``: was the key let in within the lifetime before.

    ``seen`` is the time a drop landed, the same for all its rows; of rows that share key
    and time the last by ``order`` stays (nulls first; of equal ones any). A key that was let in is
    a repeat while it is younger than ``lifetime`` (or just as old, if ``inclusive``); then it
    is let in again. A repeat does not extend the stay of its key unless ``sliding``. Rows without
    key or time are left out. ``known`` (key, ``at``) is state to start from, taken by the
    first batch of a new checkpoint.

    Times are event times, so a replay gives what the first run gave, however late
    it comes. An entry goes when the watermark, one lifetime behind the newest row, has
    passed its end: the store holds the keys of two lifetimes. A row more than one lifetime
    older than the newest of earlier batches is late and is left out.

    Copies collapse before the shuffle in every batch of rows of a task, so little of a key
    with a third of all rows travels; a key holds one row per time in memory.

    With ``buckets`` the store holds the entries of that many groups of keys, not of each key. A
    call to the store costs far more than an entry, so this is the way for streams that meet
    many keys in a batch. A task holds one bucket's entries and rows at a time, so the number grows
    with the keys; it is fixed with the checkpoint, and such a stream takes no ``known``.
    """
    if buckets and known is not None:
        raise ValueError("state by buckets starts empty")
    columns, names = stream.columns, [*order]
    span = lifetime // dt.timedelta(microseconds=1)

    # What tasks run is defined in here, so it travels by value and needs no package there.
    def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            sorting = [(n, "ascending") for n in names] or [(_MICROS, "ascending")]
            table = table.take(pc.sort_indices(table, sort_keys=sorting, null_placement="at_start"))
            places = table.select([key, _MICROS]).append_column("_place", pa.array(np.arange(table.num_rows)))
            last = places.group_by([key, _MICROS]).aggregate([("_place", "max")]).column("_place_max")
            yield from table.take(last).combine_chunks().to_batches()

    def place(row: Row) -> list:
        return [(False,) if row[n] is None else (True, row[n]) for n in names]

    class Lifetime(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.entry = handle.getValueState("entry", "at LONG")

        def _end(self, at: int) -> int:
            """Milliseconds after which nothing is younger or as old as the lifetime."""
            return (at + span) // 1000 + 1

        def _let_in(self, at: int) -> None:
            self.entry.update((at,))
            self.handle.registerTimer(self._end(at))

        def handleInitialState(self, key, initialState, timerValues) -> None:
            self._let_in(initialState["at"])

        def handleInputRows(self, key, rows, timerValues):
            last: dict = {}
            for row in rows:
                best = last.get(row[_MICROS])
                if best is None or place(row) >= place(best):
                    last[row[_MICROS]] = row
            entry = self.entry.get()[0] if self.entry.exists() else None
            before = entry
            for at in sorted(last):
                age = None if entry is None else at - entry
                repeat = age is not None and (age < span or (inclusive and age == span))
                if not repeat or (sliding and at > entry):
                    entry = at
                yield Row(**{c: last[at][c] for c in columns}, is_repeat=repeat)
            if entry != before:
                self._let_in(entry)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            # A key that was let in again has a later timer of its own.
            if self.entry.exists() and self._end(self.entry.get()[0]) <= expiredTimerInfo.getExpiryTimeInMs():
                self.entry.clear()
            return iter([])

        def close(self) -> None:
            pass

    class Buckets(StatefulProcessor):
        """The same for all keys of a bucket at once: few calls to the store, whatever the number of keys."""

        def init(self, handle) -> None:
            self.handle = handle
            self.state = handle.getValueState("entries", "entries BINARY")

        def _end(self, at: int) -> int:
            """Milliseconds after which nothing is younger or as old as the lifetime."""
            return (at + span) // 1000 + 1

        def _entries(self, now: int = -(1 << 62)) -> dict:
            """When each key of the bucket was let in, without those whose lifetime is over."""
            held = self.state.get()
            if held is None or held[0] is None:
                return {}
            keys, at = pa.ipc.open_stream(bytes(held[0])).read_all().columns
            return {k: a for k, a in zip(keys.to_pylist(), at.to_pylist()) if self._end(a) > now}

        def _keep(self, entries: dict) -> None:
            if not entries:
                self.state.clear()
                return
            table = pa.table({"key": pa.array(list(entries)), "at": pa.array(list(entries.values()), pa.int64())})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            self.state.update((sink.getvalue().to_pybytes(),))
            self.handle.registerTimer(self._end(max(entries.values())))

        def handleInputRows(self, bucket, rows, timerValues):
            last: dict = {}
            for row in rows:
                at = (row[_MICROS], row[key])
                best = last.get(at)
                if best is None or place(row) >= place(best):
                    last[at] = row
            entries = self._entries(timerValues.getCurrentWatermarkInMs())
            for at, k in sorted(last, key=lambda x: x[0]):
                entry = entries.get(k)
                age = None if entry is None else at - entry
                repeat = age is not None and (age < span or (inclusive and age == span))
                if not repeat or (sliding and at > entry):
                    entries[k] = at
                row = last[at, k]
                yield Row(**{c: row[c] for c in columns}, is_repeat=repeat)
            self._keep(entries)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            # A bucket that was met again has a later timer of its own.
            held = self._entries()
            if held and self._end(max(held.values())) <= expiredTimerInfo.getExpiryTimeInMs():
                self.state.clear()
            return iter([])

        def close(self) -> None:
            pass

    rows = stream.filter(F.col(key).isNotNull() & F.col(seen).isNotNull()).withColumn(_MICROS, F.unix_micros(seen))
    few = rows.mapInArrow(collapsed, rows.schema).withWatermark(seen, f"{span // 1_000_000} seconds")
    start = None
    if known is not None:
        start = known.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.unix_micros("at")).alias("at")).groupBy(key)
    schema = T.StructType([*stream.schema.fields, T.StructField("is_repeat", T.BooleanType())])
    if buckets:
        dealt = few.withColumn(_BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)))
        return dealt.groupBy(_BUCKET).transformWithState(Buckets(), schema, "Append", "EventTime")
    return few.groupBy(key).transformWithState(Lifetime(), schema, "Append", "EventTime", start)


#: What queries with keyed state run with, whatever the session names for others. Entries whose lifetime is over
#: go with the next tick: a batch without rows would start every task of the state once more for nothing else.
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def store_keyed(marked: DataFrame, out: str, checkpoint: str) -> None:
    """Append a stream of ``with_lifetime``, with the settings that keyed state needs."""
    conf = marked.sparkSession.conf
    before = {name: conf.get(name) for name in _SETTINGS}
    try:
        for name, value in _SETTINGS.items():
            conf.set(name, value)
        ingest(marked, out, checkpoint)
    finally:
        for name, value in before.items():
            conf.set(name, value)


def keyed_threads(
    stream: DataFrame, out: str, checkpoint: str, seen: str, days: int = S.SENT_DAYS, known: DataFrame | None = None
) -> None:
    """Insert-if-absent per link with a lifetime, without a log: appends the threads of links not let in for ``days`` days.

    ``known`` (``link``, ``at``) takes over the threads of a log.
    """
    marked = with_lifetime(
        A.thread_articles(stream), "link", seen, ["feed_ord", "feed_pos"], dt.timedelta(days=days), known=known)
    new = marked.filter(~F.col("is_repeat"))
    store_keyed(S.build_threads(new, from_epoch(F.unix_seconds(seen))), out, checkpoint)


def keyed_signals(stream: DataFrame, out: str, checkpoint: str, seen: str, days: int = S.SIGNAL_DAYS) -> None:
    """Appends the last report of every signal and sweep, told apart by ``is_repeat``; each report renews the stay of its id."""
    flat = stream.withColumns({"payload_seq": F.col("seq.payload_seq"), "pos": F.col("seq.pos")}).drop("seq")
    store_keyed(with_lifetime(flat, "id", seen, ["payload_seq", "pos"], dt.timedelta(days=days), sliding=True, inclusive=True, buckets=BUCKETS), out, checkpoint)
