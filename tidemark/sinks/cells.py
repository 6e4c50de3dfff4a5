"""A sink for wide-column cells that buffers, stages and commits.

Spark's Python data source writer runs in each task: it buffers cells by size, rows and time
and flushes them into files of the task's attempt, in a folder that readers do not see. The
driver commits a batch once all tasks are done: the folder of the batch appears whole, with
the files of the successful attempts only. A batch that comes again replaces itself.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tidemark.schemas import CELLS
from tidemark.sinks.widecolumn import WriteOptions
from tidemark.streaming.run import BatchSink

FORMAT = "tidemark_cells"
_COLUMNS = pa.schema(
    [*[(name, pa.string()) for name in ("rowkey", "family", "qualifier", "value")], ("version", pa.int64())]
)
# What a buffer holds at most where the options do not say.
FLUSH_ROWS, FLUSH_BYTES = 100_000, 16_777_216


@dataclass
class Flushed(WriterCommitMessage):
    """The files of one task's attempt."""

    files: list[str]


class CellWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.batch = f"batch={int(options['batch'])}"
        self.staged = f"_staged/{self.batch}/{uuid.uuid4().hex}"
        limits = [(options.get(f"flush{name}"), least) for name, least in (("rows", FLUSH_ROWS), ("bytes", FLUSH_BYTES))]
        self.rows, self.bytes = [int(value or least) for value, least in limits]
        millis = options.get("flushmillis")
        self.seconds = int(millis) / 1000 if millis else float("inf")

    def _folder(self) -> tuple[pyarrow.fs.FileSystem, str]:
        system, root = pyarrow.fs.FileSystem.from_uri(self.path) if ":" in self.path else (
            pyarrow.fs.LocalFileSystem(), self.path
        )
        return system, root.rstrip("/")

    def write(self, iterator: Iterator[Row]) -> Flushed:
        task = TaskContext.get()
        stem = f"{task.partitionId():05d}-{task.taskAttemptId()}"
        system, root = self._folder()
        files: list[str] = []
        buffer: list[tuple] = []
        size, since = 0, time.monotonic()

        def flush() -> None:
            nonlocal size, since
            if buffer:
                if not files:
                    system.create_dir(f"{root}/{self.staged}", recursive=True)
                files.append(f"{stem}-{len(files):05d}.parquet")
                columns = [pa.array(column, field.type) for column, field in zip(zip(*buffer), _COLUMNS)]
                with system.open_output_stream(f"{root}/{self.staged}/{files[-1]}") as out:
                    pq.write_table(pa.Table.from_arrays(columns, schema=_COLUMNS), out)
                buffer.clear()
            size, since = 0, time.monotonic()

        try:
            for row in iterator:
                cell = tuple(row[name] for name in _COLUMNS.names)
                buffer.append(cell)
                size += 8 + sum(len(text) for text in cell[:4] if text is not None)
                late = time.monotonic() - since >= self.seconds
                if late or len(buffer) >= self.rows or size >= self.bytes:
                    flush()
            flush()
        except BaseException:
            for name in files:
                system.delete_file(f"{root}/{self.staged}/{name}")
            raise
        return Flushed(files)

    def commit(self, messages: list[Flushed | None]) -> None:
        system, root = self._folder()
        good = {name for message in messages if message for name in message.files}
        staged = f"{root}/{self.staged}"
        if good:
            for found in system.get_file_info(pyarrow.fs.FileSelector(staged)):
                if found.base_name not in good:  # of an attempt that failed or came second
                    system.delete_file(found.path)
        final = f"{root}/{self.batch}"
        if system.get_file_info(final).type != pyarrow.fs.FileType.NotFound:
            system.delete_dir(final)
        if good:
            system.move(staged, final)
        self._clean()

    def abort(self, messages: list[Flushed | None]) -> None:
        self._clean()

    def _clean(self) -> None:
        """Drop what is staged for the batch, also by runs of it that were given up: a task
        of theirs may have gone on for a while."""
        system, root = self._folder()
        staged = f"{root}/_staged/{self.batch}"
        if system.get_file_info(staged).type != pyarrow.fs.FileType.NotFound:
            system.delete_dir(staged)


class CellSource(DataSource):
    """Written by :func:`cell_sink`; the folders of its batches are plain parquet."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return CELLS

    def writer(self, schema, overwrite: bool) -> CellWriter:
        missing = set(_COLUMNS.names).difference(schema.names)
        if missing:
            raise ValueError(f"cells lack {sorted(missing)}")
        return CellWriter({key.lower(): value for key, value in self.options.items()})


def cell_sink(path: str, options: WriteOptions) -> BatchSink:
    """A ``foreachBatch`` sink of cells under ``path``, flushed as ``options`` say.

    A failed batch leaves nothing that readers see, and a repeated one has one effect.
    ``path`` must be a folder that all executors can write.
    """
    flush = {"flushRows": options.flush_rows, "flushBytes": options.flush_bytes, "flushMillis": options.flush_millis}
    given = {name: str(value) for name, value in flush.items() if value is not None}

    def on_batch(cells: DataFrame, batch_id: int) -> None:
        cells.sparkSession.dataSource.register(CellSource)
        writer = cells.write.format(FORMAT).mode("append").options(**given)
        writer.option("batch", str(batch_id)).option("path", path).save()

    return on_batch


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """All cells of the batches committed so far."""
    return spark.read.schema(f"{CELLS}, batch BIGINT").parquet(path).drop("batch")
