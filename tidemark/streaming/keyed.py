"""Per-key state on streams, for a caller's function.

Counts and sums need none of this: ``operators.keyed.keyed_totals`` is an updating
aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tidemark.schemas import parse_ddl

# (state or None, rows of the key) -> (state, one output row per row)
KeyedFunction = Callable[[tuple | None, pd.DataFrame], tuple[tuple, pd.DataFrame]]


class KeyedMap(StatefulProcessor):
    """Runs the function on the rows of a key as they come, chunk by chunk."""

    def __init__(self, function: KeyedFunction, state: str, names: list[str] | None = None):
        self.function, self.schema, self.schema_names = function, state, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", self.schema)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        if len(initialState) > 1:
            raise ValueError("a key can have one state to start from")
        values = initialState[self.schema_names].iloc[0].tolist()
        self.state.update(tuple(values))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self.state.get()
        for chunk in rows:
            state, made = self.function(state, chunk)
            if len(made) != len(chunk):
                raise ValueError("the function must return a row for every row")
            yield made
        if state is not None:
            self.state.update(state)

    def close(self) -> None:
        pass


def keyed_map_stream(
    df: DataFrame,
    key: str,
    function: KeyedFunction,
    state: str,
    output: StructType | str,
    start: DataFrame | None = None,
) -> DataFrame:
    """``function`` over the rows of each key with its state: a row out for each row in.

    ``start`` is a batch table of the key and the columns of ``state``, a row a key at most:
    the states that the stream begins with when it is first started.

    ``state`` and ``output`` are schemas; the function sees all columns of ``df``. A key
    has one state and so one task: split it by the function's own means if it is heavy.
    The session must use the RocksDB state store.
    """
    rows = df.withColumn("state_key", F.col(key))
    names = parse_ddl(state).names
    if start is not None:
        start = start.select(F.col(key).alias("state_key"), *names).groupBy("state_key")
    return rows.groupBy("state_key").transformWithStateInPandas(
        statefulProcessor=KeyedMap(function, state, names),
        outputStructType=output,
        outputMode="Append",
        timeMode="None",
        initialState=start,
    )
