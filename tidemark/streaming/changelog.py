"""Changelogs on streams, record by record."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, StructField, StructType


class RetractProcessor(StatefulProcessor):
    """Keeps the row that a key has last added. A record that changes it retracts that row
    and adds the new one."""

    def __init__(self, keys: StructType, values: StructType, place: StructType):
        self.keys, self.values, self.place = keys, values, place
        self.names = ["is_add", *keys.names, *values.names, *place.names]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", self.values)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.last.get()
        held = before
        records = [(tuple(r["_place"].values()), tuple(r["_values"].values())) for r in rows]
        records.sort(key=lambda record: [(v is not None, v) for v in record[0]])
        for place, values in records:
            old = held or (None,) * len(self.values)
            new = tuple(o if n is None else n for o, n in zip(old, values))
            if new == held:
                continue
            if held is not None:
                yield self._row(False, key, held, place)
            yield self._row(True, key, new, place)
            held = new
        if held is not None and held != before:
            self.last.update(held)

    def _row(self, is_add: bool, key: tuple, values: tuple, place: tuple) -> Row:
        return Row(**dict(zip(self.names, [is_add, *key, *values, *place])))

    def close(self) -> None:
        pass


def retract_stream(
    records: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """``(is_add, keys, values, order)``: what each record changes, in append mode.

    The row of a key holds the last value of each column that is not NULL. A record that
    leaves it as it is gives nothing; any other one gives a retract of the row before, if
    there is one, and an add, both with the record's ``order``. Records of a key are taken
    by ``order`` within a micro-batch and by micro-batch first; a micro-batch's records of
    one key are one task's work, which the source's rate limit bounds. Adds and retracts
    fold with ``operators.changelog.apply_changelog``.
    """
    kinds = [StructType([records.schema[c] for c in columns]) for columns in (keys, values, order)]
    rows = records.select(
        *keys, F.struct(*values).alias("_values"), F.struct(*order).alias("_place")
    )
    out = StructType([StructField("is_add", BooleanType()), *[f for kind in kinds for f in kind]])
    return rows.groupBy(*keys).transformWithState(RetractProcessor(*kinds), out, "Append", "None")
