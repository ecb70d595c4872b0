"""Linear recurrences e <- decay * e + input as window sums.

Exponential and Wilder averages are both of this form. Within a block of days the recurrence has a
closed form, a running sum of input * decay**-k scaled by decay**k, where k counts the steps taken in
the block. What earlier blocks leave behind is a short list of (steps, value) pairs, at most one per
block, which is folded into the carry of the next block. All terms keep their sign, so nothing
cancels, and no Python runs per row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from .windows import BLOCK, block_window, ticker_window

MAX_BLOCK_DAYS = 1000
# decay ** -days has to stay a finite double, whose natural logarithm ends near 709.
MAX_EXPONENT = 650.0


@dataclass(frozen=True)
class Scan:
    """One recurrence: result column, step counter column, input expression, decay.

    The result is NULL while the count in ``started`` is zero. ``carry`` names the field of a carried state that
    holds the value before the first row.
    """

    name: str
    steps: str
    value: Column
    decay: float
    started: str | None = None
    carry: str | None = None


def block_days(decays: list[float]) -> int:
    steepest = min(decays, default=1.0)
    if steepest >= 1.0:
        return MAX_BLOCK_DAYS
    return max(1, min(MAX_BLOCK_DAYS, int(MAX_EXPONENT / -math.log(steepest))))


def block_end() -> Column:
    return F.lead(BLOCK).over(ticker_window()) != F.col(BLOCK)


def local_values(scans: list[Scan]) -> dict[str, Column]:
    """Value of each recurrence at every row as if its block began from zero."""
    return {
        f"_local_{s.name}": F.pow(F.lit(s.decay), F.col(s.steps))
        * F.sum(s.value * F.pow(F.lit(s.decay), -F.col(s.steps))).over(block_window())
        for s in scans
    }


def finished_blocks(scans: list[Scan]) -> dict[str, Column]:
    """The last row of each earlier block, oldest first."""
    counters = sorted({s.steps for s in scans})
    state = F.struct(*counters, *[f"_local_{s.name}" for s in scans])
    before = ticker_window().rowsBetween(Window.unboundedPreceding, -1)
    return {"_blocks": F.collect_list(F.when(F.col("_block_end"), state)).over(before)}


def results(scans: list[Scan], carry: str | None = None) -> dict[str, Column]:
    """The values themselves; ``carry`` is the column with the state to go on from, if there is one."""
    return {s.name: _result(s, carry) for s in scans}


def _result(s: Scan, carry: str | None) -> Column:
    before = F.coalesce(F.col(f"{carry}.{s.carry}"), F.lit(0.0)) if carry and s.carry else F.lit(0.0)
    folded = F.aggregate(
        "_blocks",
        before,
        lambda acc, end: acc * F.pow(F.lit(s.decay), end[s.steps]) + end[f"_local_{s.name}"],
    )
    value = F.col(f"_local_{s.name}") + folded * F.pow(F.lit(s.decay), F.col(s.steps))
    return F.when(F.col(s.started) > 0, value) if s.started else value
