"""Small helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.session import scratch_path, stage

__all__ = [
    "WORD_SEPARATOR",
    "id_and_text",
    "new_folder",
    "one_task_each",
    "open_for_reading",
    "open_for_writing",
    "read_table",
    "release_memory",
    "stage",
    "text_key",
    "text_slices",
    "unit_hash",
    "word_blocks",
    "word_count",
    "words_of",
]

# Words are separated by ASCII white space only: space and the codes 9 to 13.
WORD_SEPARATOR = r"[\x20\x09-\x0D]+"
_SEPARATORS = " \t\n\x0b\x0c\r"
_BLOCK_BYTES = 1 << 20
SLICE_BYTES = 1 << 22
MOST_FILE_TASKS = 20_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator needs, under names that cannot clash."""
    return docs.select(
        docs[id_col].cast("long").alias("id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def trimmed(text: Column) -> Column:
    return F.trim(F.coalesce(text, F.lit("")), F.lit(_SEPARATORS))


def words_of(text: Column) -> Column:
    """Array of words; NULL and blank text give an empty array."""
    bare = trimmed(text)
    none = F.array().cast("array<string>")
    return F.when(bare == "", none).otherwise(F.split(bare, WORD_SEPARATOR))


def word_count(text: Column) -> Column:
    bare = trimmed(text)
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, WORD_SEPARATOR))).cast("long")


def text_key(text: Column) -> Column:
    """64-bit key that tells the texts of rows with the same id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def word_blocks(data: bytes):
    """Lists of words of a UTF-8 text, a bounded number of bytes at a time.

    ``bytes.split`` splits at exactly the separators above.
    """
    if len(data) <= _BLOCK_BYTES:
        yield data.split()
        return
    rest = b""
    for at in range(0, len(data), _BLOCK_BYTES):
        block = rest + data[at : at + _BLOCK_BYTES]
        words = block.split()
        rest = b""
        if words and not block[-1:].isspace() and at + _BLOCK_BYTES < len(data):
            rest = words.pop()
        yield words


def release_memory() -> None:
    """Give back what the allocators of a Python worker keep after large texts."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str | int, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a bounded number of bytes; a longer text is one slice."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for at, size in enumerate(sizes):
            if at > start and total + size > most:
                yield batch.slice(start, at - start)
                start, total = at, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


def unit_hash(*parts: object) -> float:
    """A repeatable number in [0, 1) for the given values."""
    text = "\x1f".join(map(str, parts)).encode()
    return (zlib.crc32(text) * 2654435761 % 2**32) / 2**32


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, for files that tasks write themselves."""
    path = scratch_path(spark, label)
    filesystem, at = pafs.FileSystem.from_uri(path)
    filesystem.create_dir(at, recursive=True)
    return path


def one_task_each(files: DataFrame, column: str = "path") -> DataFrame:
    """Deal rows that stand for files to as many tasks as there are files.

    The rows are few and small, so without a number adaptive execution would
    put them all into one task.
    """
    return files.repartition(min(max(files.count(), 1), MOST_FILE_TASKS), column)


def open_for_writing(path: str) -> pa.NativeFile:
    filesystem, at = pafs.FileSystem.from_uri(path)
    return filesystem.open_output_stream(at)


def open_for_reading(path: str) -> pa.NativeFile:
    filesystem, at = pafs.FileSystem.from_uri(path)
    return filesystem.open_input_file(at)
