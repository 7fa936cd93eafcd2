"""How requests to a service are spread over tasks, paced and tried again."""

from __future__ import annotations

import math
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

#: Statuses of answers after which the same request may succeed: the quota is used up, or the server is at fault for now.
AGAIN = (429, 500, 502, 503, 504)


class ServiceError(RuntimeError):
    """A service's answer that is none, with its status."""

    def __init__(self, status: int, text: str = ""):
        super().__init__(f"status {status}: {text[:300]}")
        self.status = status


def may_pass(error: Exception) -> bool:
    """Whether a request may succeed when it is tried again: not if the service refused it, or its answer or the request is malformed."""
    if isinstance(error, ServiceError):
        return error.status in AGAIN
    return not isinstance(error, ValueError)


class Slots:
    """Waits until a request of one lane may begin. Time is cut into slots of 1 / rate seconds that the lanes own in turn, so that all
    lanes together begin at most `rate` requests a second, however many run at once and whenever their tasks begin; clocks must agree."""

    def __init__(self, rate: float, lanes: int, lane: int, now: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.lanes, self.lane, self.now, self.sleep = rate, lanes, lane % lanes, now, sleep
        self.turn = -1

    def __call__(self) -> None:
        if self.rate <= 0:
            return
        at = self.now()
        self.turn = max(self.turn + 1, math.ceil((at * self.rate - self.lane) / self.lanes))
        begin = (self.turn * self.lanes + self.lane) / self.rate
        if begin > at:
            self.sleep(begin - at)


def spread(rows: DataFrame, lanes: int, rate: float, *keys: str) -> DataFrame:
    """rows dealt to `lanes` tasks by a hash of keys, if there is a rate to keep or lanes are asked for; else as they are."""
    return rows.repartition(max(1, lanes), *keys) if rate > 0 or lanes > 0 else rows


def this_lane(rate: float, lanes: int) -> Slots:
    """The slots of the task that asks, after spread()."""
    from pyspark import TaskContext

    context = TaskContext.get()
    return Slots(rate, max(1, lanes), context.partitionId() if context else 0)
