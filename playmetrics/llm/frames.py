"""Small helpers for frames."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def give_back_memory() -> None:
    """Return freed memory to the system, in a Python worker that goes on to the next task.

    Arrow's and the C library's allocators keep freed pages, and so would grow with every task.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass
