"""Starting streams that take what is there and stop, and feeding folders as topics."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import file_system, make_folder, session_conf

BatchSink = Callable[[DataFrame, int], None]


def with_watermark(df: DataFrame, time: str, delay: str = "0 seconds") -> DataFrame:
    """Declare how late rows may come; by default not at all.

    The watermark is the newest event time of the finished micro-batches less the
    delay. A zone-free time is read in the session zone, as watermarks need instants.
    """
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def run_available(
    result: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    mode: str = "append",
) -> None:
    """Process what the source holds and stop; the next run resumes from there."""
    query = (
        result.writeStream.outputMode(mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def batch_writer(path: str) -> BatchSink:
    """A sink for rows that are only ever added: one partition per micro-batch.

    A repeated micro-batch replaces its own partition.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        (
            rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )

    return write


@contextmanager
def joins_by_measure(spark: SparkSession, rows: DataFrame) -> Iterator[None]:
    """Inside a sink, joins of ``rows`` broadcast what has been measured as small, if anything.

    Spark takes the size of a micro-batch from the input that it reads. What comes out of the
    state may be any number of rows, and would go through the driver whole. Here all sides are
    shuffled first; then the settings of ``spark``, the caller's session, say what is small
    and whether there is measuring at all, which streams with state are planned without.
    """
    adaptive, limit = "spark.sql.adaptive", "autoBroadcastJoinThreshold"
    small = spark.conf.get(f"{adaptive}.{limit}", None) or spark.conf.get(f"spark.sql.{limit}")
    settings = {
        f"spark.sql.{limit}": "-1",
        f"{adaptive}.{limit}": small,
        f"{adaptive}.enabled": spark.conf.get(f"{adaptive}.enabled"),
    }
    with session_conf(rows.sparkSession, settings):
        yield


class Feed:
    """A folder that stands in for a topic: rows are added, a stream reads them."""

    def __init__(self, spark: SparkSession, path: str, schema):
        self.spark = spark
        self.path = path
        self.schema = schema
        make_folder(spark, path)

    def add(self, rows: DataFrame) -> None:
        rows.select(*[f.name for f in self.schema]).write.mode("append").parquet(self.path)

    def stage(self, rows: DataFrame, part: Column) -> None:
        """Write rows beside the folder, once, by the number ``part`` of the stretch in which
        they are to arrive."""
        placed = rows.select(*[f.name for f in self.schema], part.cast("int").alias("_part"))
        # Files of a few stretches are open at a time, so that rows need not be sorted.
        with session_conf(self.spark, {"spark.sql.maxConcurrentOutputFileWriters": "8"}):
            placed.write.partitionBy("_part").parquet(f"{self.path}-staged")

    def release(self, part: int) -> None:
        """The staged rows of a stretch arrive; one without rows brings nothing."""
        fs, staged = file_system(self.spark, f"{self.path}-staged/_part={part}")
        _, arrived = file_system(self.spark, f"{self.path}/stretch-{part}")
        if fs.exists(staged) and not fs.rename(staged, arrived):
            raise OSError(f"stretch {part} is in {self.path} already")

    def stream(self) -> DataFrame:
        reader = self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true")
        return reader.parquet(self.path)


def stretches(df: DataFrame, time: str, cuts: Sequence[str]) -> list[DataFrame]:
    """The rows before the first cut, between the cuts, and from the last one on; rows
    without a time are among the last."""
    moments = [F.lit(cut).cast("timestamp") for cut in cuts]
    parts = [df.filter(F.col(time) < moments[0])]
    for start, end in zip(moments, moments[1:]):
        parts.append(df.filter((F.col(time) >= start) & (F.col(time) < end)))
    parts.append(df.filter((F.col(time) >= moments[-1]) | F.col(time).isNull()))
    return parts
