"""Independent writes of one batch side by side, so that a short one does not
leave the executors idle while the driver plans the next."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def run_together(spark: SparkSession, tasks: Sequence[Callable[[], None]]) -> None:
    """Run all tasks; the first failure is raised once all have ended."""
    if not tasks:
        return
    with ThreadPoolExecutor(len(tasks)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
    for done in running:
        done.result()
