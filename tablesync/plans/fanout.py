"""Many tables at a time, one Spark job chain each; one failing table does not stop the rest."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Generic, TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

DEFAULT_WIDTH = 5

Item = TypeVar("Item")
Result = TypeVar("Result")


@dataclass(frozen=True)
class Outcome(Generic[Item, Result]):
    item: Item
    result: Result | None
    error: str | None

    @property
    def ok(self) -> bool:
        return self.error is None


def raise_failed(outcomes: Iterable[Outcome]) -> None:
    """Raise if any outcome is a failure, naming all of them."""
    failed = [f"{o.item}: {o.error}" for o in outcomes if not o.ok]
    if failed:
        raise RuntimeError(f"{len(failed)} failed: " + "; ".join(failed))


def fan_out(
    spark: SparkSession, items: Iterable[Item], work: Callable[[Item], Result], width: int = DEFAULT_WIDTH
) -> list[Outcome]:
    """Run ``work`` for every item, ``width`` at once, and report each outcome."""

    def guarded(item: Item) -> Outcome:
        try:
            return Outcome(item, work(item), None)
        except Exception as failure:  # every kind of failure becomes that table's outcome
            return Outcome(item, None, f"{type(failure).__name__}: {failure}")

    with ThreadPoolExecutor(max_workers=width) as pool:
        return list(pool.map(inheritable_thread_target(spark)(guarded), items))
