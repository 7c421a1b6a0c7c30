"""Reading ahead inside a task: what comes next is fetched by threads while the present item is worked on."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from itertools import islice
from typing import Any

#: Items that are fetched, or about to be, beyond the one that was handed out; and threads that fetch.
DEPTH, THREADS = 8, 4


def ahead(items: Iterable, fetch: Callable[[Any], Any], depth: int = DEPTH, threads: int = THREADS) -> Iterator[tuple[Any, Any, Exception | None]]:
    """(item, fetched, problem) in the order of ``items``, with at most ``depth`` items fetched ahead.

    A fetch that fails hands on its exception with its item, and the rest goes on.  Closing the iterator
    early cancels what has not begun and waits for what has, so no thread outlives it.
    """
    items, pending = iter(items), deque[tuple[Any, Future]]()
    pool = ThreadPoolExecutor(min(threads, max(1, depth)), thread_name_prefix="read-ahead")
    try:
        pending.extend((item, pool.submit(fetch, item)) for item in islice(items, max(1, depth)))
        while pending:
            item, future = pending.popleft()
            problem = future.exception()
            pending.extend((more, pool.submit(fetch, more)) for more in islice(items, 1))
            yield item, None if problem else future.result(), problem
    finally:
        pool.shutdown(wait=True, cancel_futures=True)
