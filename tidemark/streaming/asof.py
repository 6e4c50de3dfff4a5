"""The event-time as-of join on streams, on Spark's own keyed state.

Left rows wait in the state of their key until the watermark has passed their time, when
every version that can apply has arrived; a timer then joins them. Versions that a newer one
below the watermark supersedes leave the state with that.

A call to the state, and each element that goes into it, costs far more than a row. So what a
micro-batch brings is appended in chunks, an array a column, and a timer puts it in order.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

# Rows go into the state this many at a time, as one element.
CHUNK = 1000
_NONE = -(2**63)


def _timer_of(time: int) -> int:
    """The first millisecond, as watermarks count, that is not before a microsecond."""
    return -(-time // 1000)


class AsofProcessor(StatefulProcessor):
    """State of one key: waiting left rows, versions as they arrived, and the versions that
    were held when a timer last put them in order.

    A watermark says that everything up to it has arrived. A left row that comes later is
    joined at once, to the versions still held: at least those from the watermark on and the
    newest one before it.
    """

    def __init__(self, left: StructType, right: StructType, arrival: str, keep_alone: bool):
        self.left, self.right, self.arrival, self.keep_alone = left, right, arrival, keep_alone

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        time = StructField("_time", LongType())
        self.waiting = handle.getListState("waiting", _columns(StructType([time, *self.left])))
        self.arrived = handle.getListState("arrived", _columns(StructType([time, *self.right])))
        self.versions = handle.getListState("versions", StructType([time, *self.right]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        lefts, rights, first, last = [], [], None, None
        for row in rows:
            time = row["_time"]
            if row["_side"] == "left":
                lefts.append((time, *row["_left"].values()))
                first = time if first is None else min(first, time)
                if len(lefts) == CHUNK:
                    self.waiting.appendList(_chunks(lefts))
                    lefts = []
            else:
                rights.append((time, *row["_right"].values()))
                last = time if last is None else max(last, time)
                if len(rights) == CHUNK:
                    self.arrived.appendList(_chunks(rights))
                    rights = []
        if lefts:
            self.waiting.appendList(_chunks(lefts))
        if rights:
            self.arrived.appendList(_chunks(rights))
        # A timer for the first row that waits; without one, for the versions to be cleared.
        self.handle.registerTimer(_timer_of(last if first is None else first))
        return iter(())

    def _held(self) -> tuple[list[tuple], bool]:
        """The versions by time, one each, and whether some have newly arrived."""
        place, held, came = self.right.names.index(self.arrival), {}, False
        for time, *version in self.versions.get():
            held[time] = version
        for time, *version in _rows(self.arrived.get()):
            came = True
            if time not in held or _later(version[place], held[time][place]):
                held[time] = version
        return [(time, *held[time]) for time in sorted(held)], came

    def _forget(self, held: list[tuple], came: bool, watermark: int) -> None:
        """Drop the versions that a newer one before the watermark supersedes."""
        passed = bisect_left([time for time, *_ in held], watermark * 1000)
        if came or passed > 1:
            self.versions.put(held[max(passed - 1, 0) :])
        if came:
            self.arrived.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        held, came = self._held()
        times = [time for time, *_ in held]
        names = [*self.left.names, *self.right.names]
        rest, found, waited = [], [], False
        for time, *left in _rows(self.waiting.get()):
            waited = True
            if _timer_of(time) > watermark:
                rest.append((time, *left))
                continue
            at = bisect_right(times, time)
            if at or self.keep_alone:
                version = held[at - 1][1:] if at else (None,) * len(self.right)
                found.append(Row(**dict(zip(names, [*left, *version]))))
        if rest:
            self.waiting.put(_chunks(rest))
            self.handle.registerTimer(_timer_of(min(row[0] for row in rest)))
        elif waited:
            self.waiting.clear()
        self._forget(held, came, watermark)
        return iter(found)

    def close(self) -> None:
        pass


def _columns(row: StructType) -> StructType:
    """A chunk of such rows: an array for each column."""
    return StructType([StructField(field.name, ArrayType(field.dataType)) for field in row])


def _chunks(rows: list[tuple]) -> list[tuple]:
    return [
        tuple(list(column) for column in zip(*rows[at : at + CHUNK]))
        for at in range(0, len(rows), CHUNK)
    ]


def _rows(chunks: Iterator) -> Iterator[tuple]:
    for chunk in chunks:
        yield from zip(*chunk)


def _later(one, other) -> bool:
    return other is None or (one is not None and one >= other)


def asof_join_stream(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    arrival: str,
    how: str = "inner",
    delay: str = "0 seconds",
    splits: int = 1,
) -> DataFrame:
    """Left columns and the right columns of the version in force, in append mode.

    The watermark is the lesser of the newest times of the two sides, less ``delay``; rows
    that it has passed come out. Of two versions of one key and time the one with the larger
    ``arrival`` wins. Rows without key or time are dropped. ``left`` also keeps rows before
    the first version. Left rows of a key are dealt out to ``splits`` groups, each of which
    holds the key's versions: what a hot key needs, as a key's group is one task's work.
    """
    if how not in ("inner", "left") or splits < 1:
        raise ValueError("how is inner or left, and splits at least 1")
    names = {"left": left.columns, "right": [c for c in right.columns if c not in keys]}
    clash = set(names["left"]).intersection(names["right"])
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    times = {"left": left_time, "right": right_time}
    kinds = {
        "left": StructType([left.schema[c] for c in names["left"]]),
        "right": StructType([right.schema[c] for c in names["right"]]),
    }
    # Times travel as microseconds: a column that carries the watermark would make Spark
    # drop late rows before they get here.
    state = {
        side: StructType([StructField(f.name, LongType()) if f.name == times[side] else f for f in kind])
        for side, kind in kinds.items()
    }

    def side(name: str, df: DataFrame, group: Column) -> DataFrame:
        micros = F.unix_micros(F.col(times[name]).cast("timestamp"))
        df = df.withColumn(times[name], F.col(times[name]).cast("timestamp"))
        df = df.withWatermark(times[name], delay)
        row = F.struct(*[micros.alias(c) if c == times[name] else F.col(f"`{c}`") for c in names[name]])
        other = "right" if name == "left" else "left"
        rows = df.select(
            *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
            group.alias("_group"),
            F.lit(name).alias("_side"),
            micros.alias("_time"),
            row.alias(f"_{name}"),
            F.lit(None).cast(state[other].simpleString()).alias(f"_{other}"),
        )
        known = F.col("_time").isNotNull()
        for i in range(len(keys)):
            known &= F.col(f"_key{i}").isNotNull()
        return rows.filter(known)

    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(splits)).cast("int")
    copied = F.explode(F.sequence(F.lit(0), F.lit(splits - 1)))
    lines = side("left", left, dealt).unionByName(side("right", right, copied))
    by = [*[f"_key{i}" for i in range(len(keys))], "_group"]
    out = StructType([*state["left"], *state["right"]])
    found = lines.groupBy(*by).transformWithState(
        AsofProcessor(state["left"], state["right"], arrival, how == "left"), out, "Append", "EventTime"
    )
    for name in ("left", "right"):
        kind = kinds[name][times[name]].dataType
        found = found.withColumn(times[name], F.timestamp_micros(times[name]).cast(kind))
    return found.select(*names["left"], *names["right"])
