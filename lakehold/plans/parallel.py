"""Run independent Spark actions from driver threads so their stages share the cluster
(small dimension tables overlap with big fact tables instead of queueing behind them)."""
from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

MAX_WORKERS = 8


def run_all(fns: list[Callable], max_workers: int = MAX_WORKERS) -> list:
    """Results of ``fns`` run concurrently. Each target is wrapped so the JVM thread pinned
    to the Python thread is released when it ends and the caller's job properties carry over."""
    if len(fns) <= 1:
        return [f() for f in fns]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(fns))) as pool:
        futures = [pool.submit(wrap(f)) for f in fns]
        return [f.result() for f in futures]


def wrap(f: Callable) -> Callable:
    """Thread target that releases its pinned JVM thread when done."""
    from pyspark.sql import SparkSession
    from pyspark.util import inheritable_thread_target
    # the active session is thread-local; inside a worker fall back to the default session
    session = SparkSession.getActiveSession() or getattr(SparkSession, "_instantiatedSession", None)
    return inheritable_thread_target(session)(f) if session is not None else inheritable_thread_target(f)
