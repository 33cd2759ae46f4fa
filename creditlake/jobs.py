"""Submitting independent Spark jobs together."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from contextvars import copy_context
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

# Small jobs leave most of a cluster idle; a few at a time keep it busy.
AT_ONCE = 4


def together(jobs: Sequence[Callable[[], T]], at_once: int = AT_ONCE) -> list[T]:
    """Run the jobs, up to ``at_once`` at a time, and return their results in order.

    Job groups and other local properties of the caller hold for all of them.
    The first failure is raised, and jobs that have not started do not start.
    """
    session = SparkSession.getActiveSession()
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        futures = [pool.submit(_inherited(session, job)) for job in jobs]
        done, open_ = wait(futures, return_when=FIRST_EXCEPTION)
        failed = next((f for f in done if f.exception() is not None), None)
        if failed is not None:
            for future in open_:
                future.cancel()
            raise failed.exception()
        return [f.result() for f in futures]


def _inherited(session: SparkSession | None, job: Callable[[], T]) -> Callable[[], T]:
    """The job with the caller's local properties and staging scope."""
    context = copy_context()
    if session is None:
        return lambda: context.run(job)
    return inheritable_thread_target(session)(lambda: context.run(job))
