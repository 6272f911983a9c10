"""Small helpers for Arrow functions: rows in slices of bounded bytes, and texts as UTF-8."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc


def slices(batches: Iterator[pa.RecordBatch], column: str | Callable[[pa.RecordBatch], pa.Array], most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the column's bytes stay under most, unless one row alone has more."""
    for batch in batches:
        values = column(batch) if callable(column) else batch.column(column)
        sizes = pc.fill_null(pc.binary_length(values), 0).to_pylist()
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if total and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if len(sizes) > start:
            yield batch.slice(start)


def strings(column: pa.Array) -> pa.Array:
    """Texts without nulls, which become empty; of ill-formed UTF-8 each wrong sequence becomes U+FFFD."""
    column = pc.fill_null(column, "")
    try:
        column.validate(full=True)
    except pa.ArrowInvalid:
        column = pa.array([x.decode(errors="replace") for x in column.cast(pa.binary()).to_pylist()], column.type)
    return column


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as well-formed UTF-8 bytes; null becomes empty."""
    return strings(column).cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def settle() -> None:
    """Gives memory that this worker no longer uses back to the system; the next task may be another operator's."""
    pa.set_memory_pool(pa.system_memory_pool())
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows with large values one at a time, so that only one of them is held as Python objects.

    Frees what the worker keeps for other operators, and has Arrow give freed memory back to the system.
    """
    from sunweave.llm.tokens import forget

    forget()
    settle()
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
    settle()
