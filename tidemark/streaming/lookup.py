"""Lookups on streams: the table is read anew for every micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tidemark.operators.latest import latest_states
from tidemark.operators.lookup import asked_rows, lookup_join
from tidemark.sinks.upsert import BucketTable
from tidemark.streaming.run import BatchSink

LoadTable = Callable[[], DataFrame]


def lookup_sink(
    load_table: LoadTable,
    row_key: str,
    table_key: str,
    fields: dict[str, str],
    then: BatchSink,
    how: str = "left",
) -> BatchSink:
    """A ``foreachBatch`` sink that joins the table of the moment and hands on the rows.

    A change of the table affects later micro-batches only. Of the table, only rows
    that the micro-batch's distinct keys ask for take part in the join.
    """

    def on_batch(rows: DataFrame, batch_id: int) -> None:
        table = asked_rows(rows, load_table(), row_key, table_key)
        then(lookup_join(rows, table, row_key, table_key, how, fields), batch_id)

    return on_batch


def latest_sink(
    target: BucketTable,
    key: str,
    values: Sequence[str],
    order: Sequence[str],
    time: str,
) -> BatchSink:
    """Keeps the latest values and the first and last arrival (prefix ``t``) per key."""

    def on_batch(rows: DataFrame, batch_id: int) -> None:
        target.put(latest_states(rows, [key], values, order, {time: "t"}), batch_id)

    return on_batch
