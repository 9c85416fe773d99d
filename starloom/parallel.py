"""Concurrent Spark jobs from the driver.

Independent steps (dimension builds, source writes, validation checks) are
submitted from a long-lived thread pool so their small jobs overlap on the
cluster. The threads live for the whole process: each keeps its JVM
connection, so none is opened or torn down per run.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait

_POOL: ThreadPoolExecutor | None = None
MAX_WORKERS = 8
_NAME = "starloom"


def run_parallel(tasks: dict[str, Callable[[], object]]) -> dict[str, object]:
    """Run independent steps concurrently; results by name. All steps end
    before this returns: the first error is raised once the others are done,
    so nothing goes on writing behind a failed run. A call from a step itself
    runs its tasks one after another (the pool's threads may all be taken)."""
    global _POOL
    if threading.current_thread().name.startswith(_NAME):
        return {name: fn() for name, fn in tasks.items()}
    if _POOL is None:
        _POOL = ThreadPoolExecutor(max_workers=MAX_WORKERS, thread_name_prefix=_NAME)
    futures = {name: _POOL.submit(fn) for name, fn in tasks.items()}
    wait(futures.values())
    return {name: f.result() for name, f in futures.items()}
