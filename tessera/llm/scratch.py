"""Helpers of the operators; ``Scratch`` holds intermediate tables in the shared folder."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.scratch import Scratch

__all__ = ["Scratch", "broadcast_up_to", "forget_shuffles", "releasing", "text_column"]


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function that gives its memory back to the system when the task ends. Python workers
    live on between stages; what they had remembered would count against the executor all along."""

    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)

    return task


def forget_shuffles(spark) -> None:
    """Have Spark delete the shuffle files of jobs that are done. It does so once the driver's heap is
    collected, which a driver with little to remember may not do before the disks are full."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        jvm.System.gc()


def text_column(df: DataFrame, name: str = "text"):
    """The text, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def broadcast_up_to(df: DataFrame, rows: int, bound: int) -> DataFrame:
    """A broadcast hint when ``rows``, a counted size, is within ``bound``; beyond it Spark chooses
    the join by the sizes it sees and splits skewed keys."""
    return F.broadcast(df) if rows <= bound else df
