"""Tasks with dependencies: what is ready runs side by side, a failed task is tried again, one run at a time."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from contextlib import contextmanager

from pyspark.sql import SparkSession


def run_tasks(
    tasks: Mapping[str, Callable[[], object]], depends: Mapping[str, Sequence[str]], retries: int = 1, pause: float = 120.0, workers: int = 4,
    log: Callable[[str], None] = print,
) -> dict[str, float]:
    """Seconds of each task, in the order in which they ended.

    A task starts once all it needs has ended. One that fails is tried ``retries`` times more after ``pause`` seconds; then
    nothing new starts, what runs is waited for, and the error is raised.
    """
    unknown = {d for t in tasks for d in depends.get(t, ())} - set(tasks)
    if unknown:
        raise ValueError(f"unknown tasks: {sorted(unknown)}")
    took: dict[str, float] = {}

    def attempt(name: str) -> float:
        start = time.perf_counter()
        for again in range(retries + 1):
            try:
                tasks[name]()
                return time.perf_counter() - start
            except Exception as e:
                if again == retries:
                    raise
                log(f"{name}: {e}; tried again in {pause:.0f} s")
                time.sleep(pause)
        raise AssertionError

    running: dict[Future, str] = {}
    failed: BaseException | None = None
    with ThreadPoolExecutor(workers) as pool:
        while len(took) < len(tasks):
            begun = {*took, *running.values()}
            if failed is None:
                for name in tasks:
                    if name not in begun and all(d in took for d in depends.get(name, ())):
                        running[pool.submit(attempt, name)] = name
            if not running:
                break
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(done)
                if done.exception() is not None:
                    failed = failed or done.exception()
                else:
                    took[name] = done.result()
                    log(f"{name}: {took[name]:.1f} s")
    if failed is not None:
        raise failed
    if len(took) < len(tasks):
        raise ValueError(f"tasks wait for each other: {sorted(set(tasks) - set(took))}")
    return took


@contextmanager
def only_run(spark: SparkSession, folder: str) -> Iterator[None]:
    """Holds a mark in ``folder`` while the block runs; raises if another run holds it. A run that was killed leaves it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_running")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.createNewFile(path):
        raise RuntimeError(f"another run is under way: {path}")
    try:
        yield
    finally:
        fs.delete(path, False)
