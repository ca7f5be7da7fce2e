"""What an export run keeps while it writes, so that a run that died goes on where it stopped.

A run stages its readings once, in time order, and plans steps: stretches of whole store periods
of one table. The plan appears as one file when the staging is complete. Each step that is written
leaves a marker. A repeated run with the same key finds the plan and writes the steps without a
marker from what was staged, whatever has arrived in the tables since."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meterloom.sources import files
from meterloom.sources.scratch import discard


@dataclass(frozen=True)
class Step:
    """Readings of one table with start <= time < end, dates or None for no bound."""

    table: str
    start: str | None
    end: str | None


def steps_of(table: str, sizes: list[tuple[str, int]], rows_per_step: int) -> list[Step]:
    """Consecutive periods (first date, readings) in steps of rows_per_step readings or one period,
    whichever is more. Together the steps have no bound."""
    starts, held = [], 0
    for first, n in sorted(sizes):
        if not starts or held + n > rows_per_step:
            starts.append(first)
            held = 0
        held += n
    bounds = [None, *starts[1:], None]
    return [Step(table, start, end) for start, end in zip(bounds, bounds[1:])]


@dataclass(frozen=True)
class RunJournal:
    spark: SparkSession
    path: str

    @property
    def staged_at(self) -> str:
        return f"{self.path}/staged"

    @property
    def entities_at(self) -> str:
        return f"{self.path}/entities"

    def is_planned(self) -> bool:
        return files.exists(self.spark, f"{self.path}/plan.json")

    def clear(self) -> None:
        discard(self.spark, self.path)

    def plan(self, steps: list[Step], counters: dict[str, int], schema: T.StructType) -> None:
        rows = [[s.table, s.start, s.end] for s in steps]
        plan = {"steps": rows, "counters": counters, "schema": json.loads(schema.json())}
        files.write_text(self.spark, f"{self.path}/plan.json", json.dumps(plan))

    def _planned(self) -> dict:
        return json.loads(files.read_text(self.spark, f"{self.path}/plan.json"))

    def steps(self) -> list[Step]:
        return [Step(*row) for row in self._planned()["steps"]]

    def counters(self) -> dict[str, int]:
        return self._planned()["counters"]

    def staged(self) -> DataFrame:
        """Without readings there is no file to take the schema from, so the plan has it."""
        schema = T.StructType.fromJson(self._planned()["schema"])
        return self.spark.read.schema(schema).parquet(self.staged_at)

    def written(self) -> set[int]:
        names = files.children(self.spark, f"{self.path}/written")
        return {int(n) for n in names if n.isdigit()}

    def note_written(self, step: int) -> None:
        files.write_text(self.spark, f"{self.path}/written/{step}", "")
