"""One stream to several sinks."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame

from tidemark.operators.routing import route
from tidemark.streaming.run import BatchSink


class Branch(NamedTuple):
    name: str
    condition: Column | None  # None takes every row
    sink: BatchSink


def route_sink(branches: Sequence[Branch]) -> BatchSink:
    """A ``foreachBatch`` sink that hands each branch its rows of the micro-batch.

    The micro-batch is read once and kept for all branches, which go in order. Each sink
    gets the number of the micro-batch and must have one effect for it however often it
    comes, as ``batch_writer`` and the keyed tables have: after a failure in one sink Spark
    repeats the micro-batch, and the sinks before it are given the same rows again.
    """
    names = [branch.name for branch in branches]
    if len(set(names)) < len(names) or not names:
        raise ValueError(f"branches need names of their own: {names}")

    def on_batch(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            parts = route(rows, {branch.name: branch.condition for branch in branches})
            for branch in branches:
                branch.sink(parts[branch.name], batch_id)
        finally:
            rows.unpersist()

    return on_batch
