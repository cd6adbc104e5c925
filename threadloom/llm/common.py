"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
import uuid

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from threadloom.sources.shared import materialise, remove, shared_dir

__all__ = ["give_back", "lower_ascii", "materialise", "new_path", "remove", "shared_dir", "unused", "worker_cache"]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else, unlike ``lower``."""
    return F.translate(text, _UPPER, _LOWER)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/threadloom/{name}-{uuid.uuid4().hex}"


def unused(columns: list[str], name: str) -> str:
    """``name`` behind as many underscores as set it apart from ``columns``, in any case of letters."""
    taken = {c.lower() for c in columns}
    name = f"_{name}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def worker_cache(owner: str) -> dict:
    """What a Python worker keeps for an operator from task to task, such as a loaded vocabulary. What it kept for another one goes first, so that a worker that serves several stages never holds the tables of two."""
    held = sys.modules.setdefault("_threadloom_worker", types.ModuleType("_threadloom_worker")).__dict__
    if held.get("owner") != owner:
        if "owner" in held:
            held.pop("kept").clear()
            give_back()
        held |= {"owner": owner, "kept": {}}
    return held["kept"]


def give_back() -> None:
    """Returns memory that is free within this process to the system, as far as the allocators can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):
        trim(0)
