"""Independent loads side by side."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, FIRST_EXCEPTION, Future, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

LOADS_AT_ONCE = 4


def side_by_side(spark: SparkSession, loads: Iterable[Callable[[], object]], at_once: int = LOADS_AT_ONCE) -> list:
    """Run the loads in up to ``at_once`` driver threads and return their results in the given order.

    The threads only submit jobs; Spark shares the executors among them. After
    an error nothing new starts, what runs is waited for, and the error is raised.
    """
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(load)) for load in loads]
        ended, waiting = wait(running, return_when=FIRST_EXCEPTION)
        for load in waiting:
            load.cancel()
    for load in running:
        if not load.cancelled() and load.exception():
            raise load.exception()
    return [load.result() for load in running]


def levels_of(waits: Mapping[str, Iterable[str]]) -> dict[str, int]:
    """The level of each name in a work list: 0 if it waits for nothing, else one more than the highest it waits for."""
    level: dict[str, int] = {}
    left = {name: set(others) for name, others in waits.items()}
    while left:
        ready = [name for name, others in left.items() if not others]
        if not ready:
            raise ValueError(f"{', '.join(sorted(left))} wait for each other in a cycle")
        for name in ready:
            level[name] = max((level[other] + 1 for other in waits[name]), default=0)
            del left[name]
        for others in left.values():
            others.difference_update(ready)
    return level


def as_ready(
    spark: SparkSession,
    waits: Mapping[str, Iterable[str]],
    loads: Mapping[str, Callable[[], object]],
    at_once: int = LOADS_AT_ONCE,
) -> None:
    """Run each load as soon as those it waits for have ended, up to ``at_once`` at a time in driver threads.

    After an error nothing new starts, what runs is waited for, and the first error is raised.
    """
    opened = {name: set(others) for name, others in waits.items()}
    followers = defaultdict(list)
    for name, others in opened.items():
        for other in others:
            followers[other].append(name)
    ready = [name for name, others in opened.items() if not others]
    running: dict[Future, str] = {}
    error = None
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        while running or (ready and error is None):
            while ready and error is None and len(running) < max(1, at_once):
                name = ready.pop(0)
                running[pool.submit(inheritable_thread_target(spark)(loads[name]))] = name
            ended, _ = wait(running, return_when=FIRST_COMPLETED)
            for load in ended:
                name = running.pop(load)
                error = error or load.exception()
                for follower in followers[name]:
                    opened[follower].discard(name)
                    if not opened[follower]:
                        ready.append(follower)
    if error is not None:
        raise error
