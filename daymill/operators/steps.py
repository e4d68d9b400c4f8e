"""Cleaning steps that count as they filter.

The counts are observed metrics: they are gathered by the tasks that run the query anyway and come
with its first action, a write for instance, so no job is run for them. Counting needs all rows, so
Spark does not push the steps' conditions below the place where it counts; choose that place behind the
pruning by period. A task that is run again, after a lost executor, may count its rows again.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daymill.operators.rules import Rule


@dataclass(frozen=True)
class Step:
    """A condition rows must pass; null does not pass."""

    name: str
    condition: Column

    @property
    def passes(self) -> Column:
        return F.coalesce(self.condition, F.lit(False))


def rule_steps(rules: Sequence[Rule]) -> list[Step]:
    return [Step(f"{rule.column} {rule.compare} {rule.bound:g}", rule.condition()) for rule in rules]


def apply_steps(df: DataFrame, steps: Sequence[Step], observation: Observation | None = None) -> DataFrame:
    """Rows that pass every step, counted by ``observation`` if there is one."""
    if observation is not None:
        df = watch_steps(df, steps, observation)
    return df.filter(reduce(operator.and_, (step.condition for step in steps))) if steps else df


def watch_steps(df: DataFrame, steps: Sequence[Step], observation: Observation) -> DataFrame:
    """All rows; ``observation`` counts them, and those failing each step, in any case and as the first."""
    return df.observe(observation, *_counts(steps))


def _counts(steps: Sequence[Step]) -> list[Column]:
    counts, before = [F.count(F.lit(1)).alias("num_rows")], F.lit(True)
    for k, step in enumerate(steps):
        counts.append(F.count_if(~step.passes).alias(f"failed_{k}"))
        counts.append(F.count_if(before & ~step.passes).alias(f"first_{k}"))
        before = before & step.passes
    return counts


def step_report(spark: SparkSession, steps: Sequence[Step], observation: Observation) -> DataFrame:
    """position, step, num_failed, num_failed_first, num_left of each step; position 0 is the input.

    Only after an action on the counted rows; before, this waits for one.
    """
    found = observation.get
    left = found.get("num_rows", 0)
    rows = [(0, "input", 0, 0, left)]
    for k, step in enumerate(steps):
        first = found.get(f"first_{k}", 0)
        left -= first
        rows.append((k + 1, step.name, found.get(f"failed_{k}", 0), first, left))
    return spark.createDataFrame(rows, "position int, step string, num_failed long, num_failed_first long, num_left long")
