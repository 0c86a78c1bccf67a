"""Tables written between steps, in the folder that all executors share."""

from __future__ import annotations

import ctypes
import gc
import sys
import types

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.session import shared_folder, written  # noqa: F401 - used by the operators


def columns_of(df: DataFrame) -> dict:
    """The columns of a result of bounded size as numpy arrays, by way of Arrow; what the way took is
    given back."""
    import numpy as np

    found = df.toArrow()
    out = {name: np.array(found[name].to_numpy()) for name in found.column_names}
    del found
    give_back()
    return out


def give_back() -> None:
    """Memory that arrays have left goes back to the machine: Arrow's pool and, where the C library
    has it, the heap's free pages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def kept_by_worker(key, make):
    """What ``make`` returns, made once in a Python worker and kept for its later tasks.

    Task functions arrive pickled with globals of their own, so what should outlive a task is
    held by a module of the process.
    """
    holder = sys.modules.setdefault("tessera_worker", types.ModuleType("tessera_worker"))
    found = holder.__dict__.setdefault("kept", {})
    if key not in found:
        found[key] = make()
    return found[key]
