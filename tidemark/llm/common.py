"""What several operators share: reading tables, working through Arrow batches."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import delete_path, new_folder

# A word, in the regular expressions of Java and Python alike.
WORD = r"[^\x20\x09-\x0D]+"

# A task works on a batch in blocks of about this many bytes of text, so that its
# arrays stay small whatever the batch holds. A longer text is a block of its own.
BLOCK_BYTES = 2_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_table(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, and what
    a lost executor held is read again instead of being made again."""
    path = new_folder(df.sparkSession, purpose)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables of ``shared_table`` once all that is made of them is written."""
    for table in tables:
        for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
            delete_path(table.sparkSession, folder)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results are written: it does so
    when the driver's garbage collector finds that nothing refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow column as UTF-8 bytes."""
    return column.cast(pa.large_binary()).to_pylist()


def byte_blocks(sizes: Iterable[int], limit: int = BLOCK_BYTES) -> Iterator[slice]:
    """Runs of rows of about ``limit`` bytes each, at least one row."""
    start = total = 0
    count = 0
    for count, size in enumerate(sizes, 1):
        total += size
        if total >= limit:
            yield slice(start, count)
            start, total = count, 0
    if start < count:
        yield slice(start, count)


def text_blocks(
    batch: pa.RecordBatch, at: int, limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of a batch of about ``limit`` bytes of text in column ``at``, with the texts.

    Only the texts of one slice are Python objects at a time, however long a batch is.
    """
    sizes = pc.binary_length(batch.column(at)).fill_null(0).to_pylist()
    for block in byte_blocks(sizes, limit):
        part = batch.slice(block.start, block.stop - block.start)
        yield part, text_bytes(part.column(at))


def map_texts(
    df: DataFrame,
    id_col: str,
    text_col: str,
    fields: str,
    work: Callable[[list[bytes | None]], dict[str, list]],
    keep: Sequence[str] = (),
) -> DataFrame:
    """One output row per input row: the id, the columns ``keep`` as they are and those
    that ``work`` makes of the texts.

    ``work`` gets the texts of a block as bytes, None for null, and returns a list per
    column of ``fields`` (a DDL string). Other columns of ``df`` are not read.
    """
    source = df.select(df[id_col], df[text_col], *(df[name] for name in keep))
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_blocks(batch, 1):
                kept = {name: part.column(at) for at, name in enumerate(keep, 2)}
                yield pa.RecordBatch.from_pydict({id_col: part.column(0)} | kept | work(texts))

    return source.mapInArrow(run, f"{own}, {fields}")


def mix64(values: np.ndarray) -> np.ndarray:
    """A fixed 64-bit mixing of integers (the finalizer of splitmix64)."""
    x = values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
