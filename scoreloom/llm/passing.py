"""Columns that an operator passes on without looking at them."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def veiled(rows: DataFrame) -> tuple[DataFrame, dict[str, str], Callable[..., DataFrame]]:
    """The rows under names that no operator uses, these names, and the way back.

    The way back takes a result and the names of new columns; a new column replaces a given one of
    its name.
    """
    names = {c: f"p{i}_" for i, c in enumerate(rows.columns)}

    def back(result: DataFrame, *new: str) -> DataFrame:
        return result.select(*[F.col(p).alias(c) for c, p in names.items() if c not in new], *new)

    return rows.toDF(*names.values()), names, back


def tidy() -> None:
    """Give memory that a worker has freed back to the machine; workers serve one stage after the other."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)
