"""The first copy of each event by its own time, whichever copy arrives first."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_WATERMARK, _BUCKET = "_watermark", "_bucket"


class FirstCopy(StatefulProcessor):
    """Holds the earliest copy of an id until no earlier one can come, then the id alone until its repeats are over.

    Times are microseconds, what an id waits for is in milliseconds: its copy's event time, later the end of its
    repeats. A group is an id, or several where ``shared`` names the id's column. Every call to the state goes to the
    JVM and back, so a group has one value, read and written once a batch, and one timer for what comes first in it.
    """

    def __init__(self, schema: T.StructType, time: str, repeats: int, shared: str | None = None):
        self.schema, self.time, self.repeats, self.shared = schema, time, repeats, shared
        self.names, self.place = schema.names, schema.names.index(time)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # An id that is not its group's key, when it is waited for, and the copy until it is passed on.
        kind = T.StringType() if self.shared is None else self.schema[self.shared].dataType
        entry = T.StructType().add("id", kind).add("ends", T.LongType()).add("copy", self.schema)
        self.timer = handle.getValueState("timer", T.StructType().add("ends", T.LongType()).add("held", T.ArrayType(entry)))

    def _order(self, copy: tuple) -> tuple:
        return copy[self.place], repr(copy)

    def _read(self) -> tuple[int | None, dict[str, tuple]]:
        """When the group's timer ends, and (id, ends, copy) by the id's printed form, as not all ids can be hashed."""
        ends, held = self.timer.get() or (None, [])
        return ends, {repr(id): (id, at, copy and tuple(copy)) for id, at, copy in held}

    def _write(self, before: int | None, held: dict[str, tuple]) -> None:
        if not held:
            self.timer.clear()
            return
        ends = min(at for _, at, _ in held.values())
        if ends != before:
            self.handle.registerTimer(ends)
        self.timer.update((ends, list(held.values())))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        ends, held = self._read()
        changed = False
        for row in rows:
            new = tuple(row[name] for name in self.names)
            id = None if self.shared is None else row[self.shared]
            name, at = repr(id), new[self.place] // 1000
            _, until, copy = held.get(name, (id, None, new))
            if copy is None:
                after = id, max(until, at + self.repeats), None
            else:
                after = (id, at, new) if until is None or self._order(new) < self._order(copy) else held[name]
            if after != held.get(name):
                held[name], changed = after, True
        if changed:
            if ends is not None and ends != min(at for _, at, _ in held.values()):
                self.handle.deleteTimer(ends)
            self._write(ends, held)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        _, held = self._read()
        over = max(expiredTimerInfo.getExpiryTimeInMs() + 1, timerValues.getCurrentWatermarkInMs())
        for name, (id, ends, copy) in list(held.items()):
            if ends < over:
                if copy is None:
                    del held[name]
                else:
                    held[name] = id, ends + self.repeats, None
                    yield Row(**dict(zip(self.names, copy)))
        self._write(None, held)

    def close(self) -> None:
        pass


def first_copies(
    df: DataFrame, key: str = "id", time: str = "event_time", delay: str = "10 minutes", buckets: int | None = None
) -> DataFrame:
    """Pass the copy of the earliest event time of each id, once the watermark has passed that time.

    The watermark is ``delay`` behind the newest event; copies behind it are late and count as none. An id is
    remembered for ``delay`` after its copy was passed and after every repeat, then its state is gone. Of copies of one
    time the least by content counts. Rows without an id or a time are dropped. A query has to be started with state
    in RocksDB (``session.rocksdb_state``). All copies of an id meet in one task; where arrival order will do,
    ``jobs.drop_repeats_stream`` thins them out before.

    Each id has a state of its own, which costs several calls to the state store for every id of a batch. With
    ``buckets`` the ids are dealt into that many groups by a hash and a group's ids are read and written together: far
    faster where a batch touches many ids, wasteful where it touches few of many. A checkpoint keeps its number.
    """
    repeats = df.sparkSession.range(1).select(F.expr(f"cast(interval {delay} as interval day to second)")).first()[0]
    kept = df.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).withWatermark(time, delay)
    # Python's times depend on the zone of the worker, numbers do not.
    times = [field.name for field in df.schema.fields if isinstance(field.dataType, T.TimestampType)]
    packed = kept.withColumn(_WATERMARK, F.col(time)).withColumns({name: F.unix_micros(name) for name in times})
    schema = packed.drop(_WATERMARK).schema
    if buckets is not None:
        packed = packed.withColumn(_BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)))
    first = packed.groupBy(key if buckets is None else _BUCKET).transformWithState(
        statefulProcessor=FirstCopy(schema, time, repeats // timedelta(milliseconds=1), None if buckets is None else key),
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime",
    )
    return first.withColumns({name: F.timestamp_micros(name) for name in times})
