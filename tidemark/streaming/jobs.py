"""Jobs that run on: settings from a file, a timed trigger, and counts of what went by."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.session import read_text
from tidemark.streaming.run import BatchSink


@dataclass(frozen=True)
class JobSettings:
    """What a job needs to run: where its progress is kept and how often it looks."""

    checkpoint: str
    trigger_millis: int = 5000

    def __post_init__(self) -> None:
        if not self.checkpoint:
            raise ValueError("checkpoint.dir is required")
        if self.trigger_millis < 1:
            raise ValueError("checkpoint.interval must be at least 1 millisecond")


def parse_properties(text: str) -> dict[str, str]:
    """``key=value`` lines; blank lines and those that start with # or ! are left out."""
    pairs = {}
    for line in text.splitlines():
        line = line.strip()
        if line and line[0] not in "#!":
            key, found, value = line.partition("=")
            if not found:
                raise ValueError(f"no value in {line!r}")
            pairs[key.strip()] = value.strip()
    return pairs


def read_settings(spark: SparkSession, path: str) -> JobSettings:
    """Settings from a properties file on any file system that Spark reads:
    ``checkpoint.dir`` and ``checkpoint.interval`` in milliseconds."""
    pairs = parse_properties(read_text(spark, path))
    interval = pairs.get("checkpoint.interval", str(JobSettings.trigger_millis))
    return JobSettings(pairs.get("checkpoint.dir", ""), int(interval))


def start_job(
    result: DataFrame, sink: BatchSink, settings: JobSettings, name: str, mode: str = "append"
) -> StreamingQuery:
    """Start the job under its name; it resumes from its checkpoint where there is one."""
    writer = result.writeStream.outputMode(mode).foreachBatch(sink).queryName(name)
    writer = writer.option("checkpointLocation", settings.checkpoint)
    return writer.trigger(processingTime=f"{settings.trigger_millis} milliseconds").start()


def counted(df: DataFrame, name: str, **conditions: Column) -> DataFrame:
    """``df`` unchanged, while ``name.rows`` and a count for each condition are observed."""
    counts = [F.count_if(condition).alias(key) for key, condition in conditions.items()]
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *counts)


class JobCounts(StreamingQueryListener):
    """Sums over a job's micro-batches: ``input`` rows, ``late`` rows that a stateful
    operator dropped, and what :func:`counted` observes, by ``name.key``.

    Spark reports progress after a micro-batch, on a thread of its own; a repeated
    micro-batch counts again.
    """

    def __init__(self, name: str):
        self.name, self.counts, self.batches = name, Counter(), 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.name:
            return
        self.batches += 1
        self.counts["input"] += max(progress.numInputRows, 0)
        self.counts["late"] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        for observed, row in progress.observedMetrics.items():
            for key, value in row.asDict().items():
                self.counts[f"{observed}.{key}"] += value or 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
