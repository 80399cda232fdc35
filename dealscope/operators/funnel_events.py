"""How far each user gets through an ordered funnel of events within a time limit, as a table function.

The function gets each user's rows ordered by time (``TABLE(...) PARTITION BY user ORDER BY time``) and keeps one
number per step, so a user with many events is streamed, never held.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

STEPS = ("view", "click", "purchase")


class _Furthest:
    """For each step the latest start from which it was reached in time; the last one counts.  A later start is never
    worse, so one per step is enough."""

    def __init__(self):
        self._user, self._starts, self._best, self._steps, self._limit = None, [], 0, (), 0

    def eval(self, row, steps: str, limit: int):
        if not self._steps:
            self._steps, self._limit = tuple(steps.split("\n")), limit
            self._starts = [None] * len(self._steps)
        self._user, at, name = row["user"], row["at"], row["name"]
        for i in range(len(self._steps) - 1, -1, -1):       # an event serves as one step after another event
            if name != self._steps[i]:
                continue
            start = at if i == 0 else self._starts[i - 1]
            if start is not None and at - start <= self._limit:
                self._starts[i] = start
                self._best = max(self._best, i + 1)

    def terminate(self):
        if self._steps:
            yield self._user, self._best


def furthest_step(events: DataFrame, user: str, at: str, name: str, limit: int, steps: Sequence[str] = STEPS,
                  order: Sequence[str] = ()) -> DataFrame:
    """user, step: the number of funnel steps that a user did one after the other, the last within ``limit`` of the
    first (0: not even the first).  Events are ordered by ``at`` (a whole number) and ``order``."""
    ship_package(events.sparkSession)
    kind = events.schema[user].dataType.simpleString()
    reach = F.udtf(_Furthest, returnType=f"user {kind}, step int", useArrow=True)
    real = events.where(F.col(at).isNotNull()).select(F.col(user).alias("user"), F.col(at).alias("at"), F.col(name).alias("name"),
                                                      *[F.col(c).alias(f"tie{i}") for i, c in enumerate(order)])
    table = real.asTable().partitionBy("user").orderBy("at", *[f"tie{i}" for i in range(len(order))])
    return reach(table, F.lit("\n".join(steps)), F.lit(limit))


def step_counts(furthest: DataFrame, steps: Sequence[str] = STEPS) -> DataFrame:
    """position, step, users that reached it, and their share of those that did the first."""
    rows = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(s).alias("step"), F.count_if(F.col("step") > i).alias("users"))
                     for i, s in enumerate(steps)])
    counts = furthest.agg(rows.alias("rows"), F.count_if(F.col("step") > 0).alias("first")).select(F.inline("rows"), "first")
    return counts.select("position", "step", "users", F.try_divide(F.col("users").cast("double"), F.col("first")).alias("share"))
