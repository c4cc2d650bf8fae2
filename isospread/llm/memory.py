"""Memory of Python workers between tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

from isospread.llm.words import forget_powers


def give_back(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The task's function, after which freed memory goes back to the operating system.

    Workers outlive their tasks, and the C library keeps what numpy and Arrow have freed; several
    idle workers beside an executor then hold memory that nobody uses. Tables of powers for the
    hashes, some tens of MB, go too.
    """

    def run(inputs: Iterator) -> Iterator:
        try:
            yield from work(inputs)
        finally:
            forget_powers()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run
