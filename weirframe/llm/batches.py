"""Arrow record batches in tasks: bounded slices, column values, words as numbers."""

from __future__ import annotations

import contextlib
import ctypes
import sys
from collections.abc import Callable, Iterator
from types import ModuleType
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of text that a task holds as Python objects at a time.
SLICE_BYTES = 2 << 20
#: Rows of an Arrow batch with whole texts.
BATCH_ROWS = 500
WORKER_STORE = "weirframe_worker_store"


def kept_in_worker(name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a worker process and used by its later tasks too."""
    store = sys.modules.setdefault(WORKER_STORE, ModuleType(WORKER_STORE)).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for a job whose worker processes go on to other jobs.

    It drops what earlier jobs kept in the worker, and gives free memory back after each batch.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.modules.pop(WORKER_STORE, None)
        give_back()
        yield from run(returning(batches))

    return task


def returning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; free memory is given back before each further one."""
    for batch in batches:
        yield batch
        del batch
        give_back()


def give_back() -> None:
    """Return free memory to the system, which Arrow's pool and the allocator would hold beside the JVM's."""
    pa.default_memory_pool().release_unused()
    # Only the GNU library has this call.
    with contextlib.suppress(AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def small_batches(frame: DataFrame) -> DataFrame:
    """The frame, after limiting its session's Arrow batches to ``BATCH_ROWS`` rows.

    The JVM and the worker hold a batch each way, and rows with texts are large.
    """
    conf, name = frame.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return frame


def unused(frame: DataFrame, name: str) -> str:
    """A column name that ``frame`` does not have yet."""
    taken = {column.lower() for column in frame.columns}
    while name in taken:
        name = f"{name}_"
    return name


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``limit`` bytes in ``column`` (one row at least)."""
    if not batch.num_rows:
        return
    sizes = np.array(
        [0 if size is None else size for size in _byte_lengths(batch.column(column))], dtype=np.int64
    )
    start, filled = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and filled + size > limit:
            yield batch.slice(start, row - start)
            start, filled = row, 0
        filled += size
    yield batch.slice(start)


def _byte_lengths(column: pa.Array) -> list[int | None]:
    import pyarrow.compute as pc

    return pc.binary_length(column).to_pylist()


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """Values of a text column, null as empty."""
    return [value or "" for value in batch.column(column).to_pylist()]


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 of a text column, null as empty."""
    values = batch.column(column)
    kind = pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()
    return [value or b"" for value in values.cast(kind).to_pylist()]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble (the finaliser of splitmix64)."""
    x = values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered(words: list) -> tuple[list, np.ndarray]:
    """Distinct words in order of appearance, and the number of each word in that list."""
    distinct = list(dict.fromkeys(words))
    number = dict(zip(distinct, range(len(distinct)), strict=True))
    return distinct, np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def starts_of(sizes: np.ndarray) -> np.ndarray:
    """Where each run of a concatenation begins, and the total as the last entry."""
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
