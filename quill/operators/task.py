"""Tasks as data: a source, a projection to examples, and a grading column.

A user adds a task by building a ``Task``; readers in ``sources.tasks`` and graders in
``evals`` serve as its parts. ``examples`` gives the union of several tasks' examples and
``evaluate`` one plan that grades all their completions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quill.operators.corpus import slice_view, with_index

Grade = Callable[[Column, Column, Column], Column]


@dataclass(frozen=True)
class Task:
    """``example`` maps the source's columns to ``prompt``, ``reference`` and ``letters`` (an array of
    strings, null where answers are free); ``grade(reference, completion, letters)`` is
    a boolean column. Examples are numbered from 0 in the order of ``key``; ``start``,
    ``stop`` and ``step`` make the task a view of every step-th of them."""
    name: str
    source: DataFrame
    key: str
    example: dict[str, Column]
    grade: Grade
    start: int = 0
    stop: int | None = None
    step: int = 1

    def examples(self) -> DataFrame:
        """(task, idx, prompt, reference, letters)."""
        columns = {"letters": F.lit(None).cast("array<string>")} | self.example
        rows = with_index(self.source.select(self.key, *(c.alias(n) for n, c in columns.items())), [self.key], out="__at")
        view = slice_view(rows, "__at", self.start, self.stop, self.step)
        idx = F.floor((F.col("__at") - self.start) / self.step).cast("bigint")
        return view.select(F.lit(self.name).alias("task"), idx.alias("idx"), "prompt", "reference", "letters")


def examples(tasks: Sequence[Task]) -> DataFrame:
    names = [t.name for t in tasks]
    if len(set(names)) < len(names):
        raise ValueError(f"tasks need different names: {names}")
    return reduce(DataFrame.unionByName, [t.examples() for t in tasks])


def graded(tasks: Sequence[Task], completions: DataFrame) -> DataFrame:
    """``completions`` (task, idx, sample_no, completion) with ``is_correct``; a completion of an
    unknown example is left out, a null one is wrong."""
    met = completions.join(examples(tasks).drop("prompt"), ["task", "idx"])
    right = reduce(lambda c, t: c.when(F.col("task") == t.name, t.grade(F.col("reference"), F.col("completion"), F.col("letters"))),
                   tasks[1:], F.when(F.col("task") == tasks[0].name, tasks[0].grade(F.col("reference"), F.col("completion"), F.col("letters"))))
    return met.withColumn("is_correct", F.col("completion").isNotNull() & F.coalesce(right, F.lit(False))).drop("reference", "letters")


def evaluate(tasks: Sequence[Task], completions: DataFrame) -> DataFrame:
    """(task, n, mean, any): examples with completions, mean share of right samples, and share of
    examples with any right sample."""
    per = graded(tasks, completions).groupBy("task", "idx").agg(F.avg(F.col("is_correct").cast("double")).alias("m"), F.max("is_correct").alias("a"))
    return per.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("m"), 6).alias("mean"), F.round(F.avg(F.col("a").cast("double")), 6).alias("any"))
