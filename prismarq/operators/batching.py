"""Backends that take several images in one call, under passes that are written for one image.

The images of a group are worked on in threads of their own.  A pass that calls its backend
waits; when all images wait, or are done, the calls of each backend go out together, in the order of the
images, from the task's own thread.  So a model is never called from two threads, and
every pass gains batches without knowing of them.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from typing import Any


def batch_size(backend: Any) -> int:
    """Calls that a backend takes at once: its ``batch``, if it has ``many``, else 1."""
    return max(1, int(getattr(backend, "batch", 1))) if hasattr(backend, "many") else 1


def call_many(backend: Any, calls: Sequence[tuple]) -> list[tuple[Any, Exception | None]]:
    """(result, problem) of each call; if a batch fails, its calls are made one by one, so that one image spoils no other."""
    size, many = batch_size(backend), getattr(backend, "many", None) or (lambda own: [backend(*args) for args in own])
    out: list[tuple[Any, Exception | None]] = []
    for i in range(0, len(calls), size):
        own = list(calls[i : i + size])
        try:
            results = list(many(own))
            if len(results) != len(own):
                raise RuntimeError(f"{len(own)} calls gave {len(results)} results")
            out += [(r, None) for r in results]
        except Exception as problem:
            out += [(None, problem)] if len(own) == 1 else [x for one in own for x in call_many(backend, [one])]
    return out


def alone(backend: Any) -> Callable:
    """A backend as a function of one call."""

    def call(*args):
        ((result, problem),) = call_many(backend, [args])
        if problem is not None:
            raise problem
        return result

    return call if hasattr(backend, "many") else backend


class Group:
    """Functions that run side by side and whose backend calls go out together."""

    def __init__(self) -> None:
        self.ready = threading.Condition()
        self.live = 0
        self.waiting: dict[int, tuple[Any, tuple]] = {}  # seat -> (backend, arguments)
        self.answers: dict[int, tuple[Any, Exception | None]] = {}

    def call(self, seat: int, backend: Any, args: tuple) -> Any:
        with self.ready:
            self.waiting[seat] = (backend, args)
            self.ready.notify_all()
            self.ready.wait_for(lambda: seat in self.answers)
            result, problem = self.answers.pop(seat)
        if problem is not None:
            raise problem
        return result

    def run(self, works: Sequence[Callable[[Callable[[Any], Callable]], Any]]) -> list[Any]:
        """Results of ``works``, in order; each gets a function that wraps a backend.  Works handle their own errors."""
        results: list[Any] = [None] * len(works)

        def seat(k: int) -> None:
            try:
                results[k] = works[k](lambda backend: lambda *args: self.call(k, backend, args))
            finally:
                with self.ready:
                    self.live -= 1
                    self.ready.notify_all()

        self.live = len(works)
        threads = [threading.Thread(target=seat, args=(k,), name=f"image-{k}", daemon=True) for k in range(len(works))]
        for t in threads:
            t.start()
        while True:
            with self.ready:
                self.ready.wait_for(lambda: len(self.waiting) >= self.live)
                if not self.live:
                    break
                asked, self.waiting = sorted(self.waiting.items()), {}
            for backend in {id(b): b for _, (b, _) in asked}.values():
                seats = [(k, args) for k, (b, args) in asked if b is backend]
                for (k, _), answer in zip(seats, call_many(backend, [args for _, args in seats]), strict=True):
                    with self.ready:
                        self.answers[k] = answer
            with self.ready:
                self.ready.notify_all()
        for t in threads:
            t.join()
        return results
