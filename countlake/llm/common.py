"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the characters that separate words.
SPACES = " \t\n\x0b\x0c\r"
#: Fixed value: a word, as a Java pattern.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that Python tasks work on at a time, unless one row alone is longer.
PIECE_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def without_spaces(text: Column) -> Column:
    """``text`` less every separating character."""
    return F.translate(text, SPACES, "")


def word_count(text: Column) -> Column:
    """Number of words; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_sizes(column: pa.Array) -> list[int]:
    """Bytes of each value of a string or binary column, 0 for null."""
    return [n or 0 for n in pc.binary_length(column).to_pylist()]


def pieces(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes in ``column``, but one row at least.

    A column of whole numbers gives the bytes of a row itself.
    """
    for batch in batches:
        start = held = 0
        sizes = batch.column(column)
        for row, size in enumerate(
            sizes.to_pylist() if pa.types.is_integer(sizes.type) else byte_sizes(sizes)
        ):
            if row > start and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def _release_memory() -> None:
    """Gives memory that a Python worker has no more use for back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def releasing(
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, with its memory given back when a task begins and ends.

    Workers are used again by later stages; what a task leaves behind would
    stay until the job ends.
    """

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _release_memory()
        try:
            yield from run(batches)
        finally:
            _release_memory()

    return task
