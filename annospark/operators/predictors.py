"""Predictors of a Python worker: a few at a time, kept from task to task and closed when others need their place."""

from __future__ import annotations

import warnings
from collections import OrderedDict
from collections.abc import Callable
from typing import Any

from pyspark.resource import ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import SparkSession


class Pool:
    """Predictors by key, the one used last at the end. A Python worker runs one task at a time, so none is in use when ``get`` is
    called."""

    def __init__(self) -> None:
        self._held: OrderedDict[str, Any] = OrderedDict()

    def __len__(self) -> int:
        return len(self._held)

    def get(self, key: str, make: Callable[[], Any], most: int = 1) -> Any:
        """The predictor of ``key``, made where it isn't held. Before one is made, those unused for the longest go until it is one of
        ``most``, so that two models never need memory at once where one is allowed."""
        if most < 1:
            raise ValueError("a worker needs room for one predictor")
        if key not in self._held:
            while len(self._held) >= most:
                self.release(next(iter(self._held)))
            self._held[key] = make()
        self._held.move_to_end(key)
        return self._held[key]

    def release(self, key: str) -> None:
        """Let a predictor go; its ``close()`` is called if it has one. An error there is a warning, since the next model can't help it."""
        close = getattr(self._held.pop(key, None), "close", None)
        if close is not None:
            try:
                close()
            except Exception as x:
                warnings.warn(f"a predictor did not close: {x}", stacklevel=2)


#: The pool of this Python worker. Spark ends workers that are idle for a minute, and their predictors with them.
POOL = Pool()


def gpu_profile(gpus: float = 1.0, cpus: int = 1) -> ResourceProfile:
    """Stage-level scheduling: each task holds ``gpus`` of an executor's GPUs (below 1: tasks share one)."""
    return ResourceProfileBuilder().require(TaskResourceRequests().cpus(cpus).resource("gpu", gpus)).build


def session_profile(spark: SparkSession, gpus: float = 1.0) -> ResourceProfile | None:
    """``gpu_profile`` where the session's executors have GPUs (``spark.executor.resource.gpu.amount``), else None: tasks go by cores."""
    return gpu_profile(gpus) if int(spark.sparkContext.getConf().get("spark.executor.resource.gpu.amount", "0")) else None
