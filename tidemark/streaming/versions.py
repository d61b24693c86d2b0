"""Version history of a stream from state per key, without looking at any table.

Each key's state is its open version and the rows that still wait for the watermark. When the watermark has
passed a row's time no earlier one can come, and the row is settled: it goes on with the open version, or
closes it and opens the next. A timer settles what waits, and closes the version of a key that was silent
for ``expire``; nothing of such a key stays in the state. What is written is a log of versions that opened and
versions that closed, appended only; ``versions_of`` reads it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tidemark.functions.audit import instant
from tidemark.operators.common import has_null, require_columns
from tidemark.operators.history import position
from tidemark.operators.scd2 import Versions

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SALT, AT, TO, LATE = "_salt", "_at", "_to", "is_late"
SALTS = 64


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in RocksDB, which user-defined state needs."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def same(a: Sequence, b: Sequence) -> bool:
    """Equal values; a NULL equals a NULL and a NaN a NaN."""
    return all(x == y or (x != x and y != y) for x, y in zip(a, b, strict=True))


class VersionKeeper(StatefulProcessor):
    """The open version of a key and its rows that wait for the watermark. Times are in microseconds."""

    def __init__(self, tracked: StructType, expire: int | None, names: list[str]):
        self.tracked, self.expire, self.names = tracked, expire, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        times = [StructField(n, LongType()) for n in ("since", "seen")]
        self.open = handle.getValueState("open", StructType([*self.tracked, *times, StructField("told", BooleanType())]))
        self.waiting = handle.getListState("waiting", StructType([*self.tracked, StructField("at", LongType())]))
        self.wake = handle.getValueState("wake", StructType([StructField("at", LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        width = len(self.tracked)
        state = self.open.get()
        fresh = []
        for row in rows:
            values, at = tuple(row[-width - 1 : -1]), row[-1]
            if at is None or any(k is None for k in key[:-1]):
                yield self.told(key, values, at, None, late=True)
            elif state is None and at <= mark:
                # nothing is known any more of what was before the watermark
                yield self.told(key, values, at, None, late=True)
            elif state is not None and at <= state[width + 1]:
                if at < state[width] or not same(values, state[:width]):
                    yield self.told(key, values, at, None, late=True)
            else:
                fresh.append((*values, at))
        if fresh:
            self.waiting.appendList(fresh)
        yield from self.settled(key, mark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self.settled(key, timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass

    def told(self, key, values, since, until, late=False) -> Row:
        return Row(**dict(zip(self.names, (*key[:-1], *values, since, until, late), strict=True)))

    def settled(self, key, mark: int) -> Iterator[Row]:
        """Places the rows that the watermark has passed, in the order of their times."""
        width = len(self.tracked)
        rows = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        ready = sorted((r for r in rows if r[-1] <= mark), key=lambda r: (r[-1], repr(r)))
        later = [r for r in rows if r[-1] > mark]
        current = tuple(self.open.get()) if self.open.exists() else None
        values, since, seen, told = (current[:width], *current[width:]) if current else (None, None, None, False)
        for row in ready:
            new, at = row[:width], row[-1]
            if values is not None and self.expire is not None and at > seen + self.expire:
                yield self.told(key, values, since, seen + self.expire)
                values = None
            if values is not None and same(new, values):
                seen = max(seen, at)
            elif values is not None and at <= since:
                yield self.told(key, new, at, None, late=True)  # a second state at one time
            else:
                if values is not None:
                    yield self.told(key, values, since, at)
                values, since, seen, told = new, at, at, False
        if values is not None and self.expire is not None and seen + self.expire <= mark:
            yield self.told(key, values, since, seen + self.expire)
            values = None
        if values is None:
            self.open.clear()
        else:
            if not told:
                yield self.told(key, values, since, None)
            self.open.update((*values, since, seen, True))
        if ready:
            if later:
                self.waiting.put(later)
            else:
                self.waiting.clear()
        due = [r[-1] for r in later] + ([seen + self.expire] if values is not None and self.expire is not None else [])
        self.set_timer(min(due) if due else None)

    def set_timer(self, at: int | None) -> None:
        """One timer for each key: at the next row that waits, or when the key has been silent for long."""
        new = None if at is None else -(-at // 1000)
        old = self.wake.get()[0] if self.wake.exists() else None
        if new == old:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        if new is None:
            self.wake.clear()
        else:
            self.handle.registerTimer(new)
            self.wake.update((new,))


def time_of(micros: Column) -> Column:
    """A TIMESTAMP_NTZ from microseconds, whatever the session's time zone."""
    seconds = (micros.cast("decimal(24,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def stream_versions(
    stream: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str,
    delay: str,
    expire_seconds: float | None = None,
    versions: Versions = Versions(),
) -> DataFrame:
    """The stream's version events: keys, tracked, version columns, ``is_late``.

    A row per version that opened (current, with the end of time) and one per version that closed, at most
    one of each; what opens and closes at once gives the second only. Rows come in any order if they
    are at most ``delay`` behind the newest; of rows beyond, those that can no longer be placed
    come out with ``is_late``, and so do rows without a key or time and a second state of a key at one time.
    A key that is silent for ``expire_seconds`` has its version closed that long after its last row.

    Start the stream within ``state_on_disk``. A task holds the rows of one key that wait for the watermark, so
    ``delay`` and the size of a micro-batch bound its memory.
    """
    require_columns(stream, [*keys, *tracked, ts], "the stream")
    kind = stream.schema[ts].dataType
    rows = stream.withColumn("_event_time", F.col(ts).cast("timestamp")).withWatermark("_event_time", delay)
    # without the watermark's column Spark leaves late rows in: the keeper says what becomes of them
    salt = F.when(has_null(keys), F.pmod(F.xxhash64(*tracked, ts), F.lit(SALTS))).otherwise(F.lit(0))
    rows = rows.select(*keys, salt.cast("long").alias(SALT), *tracked, position(F.col(ts), kind).alias(AT))
    values = StructType([StructField(n, rows.schema[n].dataType) for n in tracked])
    out = StructType(
        [*(StructField(n, rows.schema[n].dataType) for n in keys), *values, StructField(AT, LongType()), StructField(TO, LongType()), StructField(LATE, BooleanType())]
    )
    keeper = VersionKeeper(values, None if expire_seconds is None else int(expire_seconds * 1_000_000), out.names)
    events = rows.groupBy(*keys, SALT).transformWithState(keeper, out, "append", "EventTime")
    current = F.col(TO).isNull() & ~F.col(LATE)
    end = F.when(F.col(TO).isNull(), instant(versions.end_of_time)).otherwise(time_of(F.col(TO)))
    return events.select(
        *keys, *tracked, time_of(F.col(AT)).alias(versions.valid_from), end.alias(versions.valid_to), current.alias(versions.is_current), LATE
    )


def versions_of(log: DataFrame, keys: Sequence[str], tracked: Sequence[str], versions: Versions = Versions()) -> DataFrame:
    """The history that a log of version events stands for: of each version its closing, if it has closed."""
    end = F.min(versions.valid_to).alias(versions.valid_to)
    placed = log.where(~F.col(LATE)).groupBy(*keys, versions.valid_from).agg(end, *[F.any_value(n).alias(n) for n in tracked])
    return placed.select(
        *keys, *tracked, versions.valid_from, versions.valid_to, (F.col(versions.valid_to) == instant(versions.end_of_time)).alias(versions.is_current)
    )
