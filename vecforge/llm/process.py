"""State that outlives a task in its Python worker process."""

from __future__ import annotations

import sys
from types import ModuleType

HOLDER = "vecforge_process_state"


def process_wide(name: str, make):
    """The object that an earlier task of this worker made under ``name``, or a new one.

    Functions of this package reach executors by value, so their module globals are new in each
    task; a worker serves one task at a time, so what is kept here is never used by two.
    """
    held = sys.modules.setdefault(HOLDER, ModuleType(HOLDER)).__dict__
    if name not in held:
        held[name] = make()
    return held[name]


def give_back() -> None:
    """Return freed memory to the system at the end of a task: its worker stays, idle or for another stage."""
    import ctypes

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it, other C libraries may not
    if trim is not None:
        trim(0)
