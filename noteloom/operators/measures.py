"""Figures of records, taken by the job that writes them."""

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation

from noteloom import contract as C
from noteloom.operators.clean import nonempty, removed_records
from noteloom.operators.quality import presence_counts


@dataclass(frozen=True)
class Figures:
    """What the summary, the overall completion, the mean score and the filter report of records."""

    counts: Mapping[str, int]

    @property
    def total(self) -> int:
        return self.counts["total"]

    @property
    def removed(self) -> int:
        """Records without any content."""
        return self.counts["removed"]

    @property
    def kept(self) -> int:
        return self.total - self.removed

    def percentage(self, field: str) -> float:
        return self.counts[field] / self.total * 100

    @property
    def completion_rate(self) -> float:
        filled = sum(self.counts[f] for f in C.FIELDS)
        return filled / (self.total * len(C.FIELDS)) * 100 if self.total else 0.0

    @property
    def mean_score(self) -> float:
        score = 0.0
        for field, weight in C.FIELD_WEIGHTS.items():
            score += weight * self.counts[f"present_{field}"]
        return score / self.total if self.total else 0.0

    def top_fields(self, n: int = 5) -> list[tuple[str, int, float]]:
        """Field, count and percentage of the fields that are populated most; none of no records."""
        if not self.total:
            return []
        rows = [(f, self.counts[f], self.percentage(f)) for f in C.FIELDS]
        return sorted(rows, key=lambda row: -row[2])[:n]


class Measured:
    """Records on their way to a sink; the figures are there once a job has written them."""

    def __init__(self, records: DataFrame):
        self._observation = Observation()
        columns: dict[str, Column] = presence_counts(records) | {"removed": removed_records()}
        self.records = records.observe(self._observation, *[c.alias(n) for n, c in columns.items()])

    def nonempty(self) -> DataFrame:
        """The records with content; those removed are counted all the same."""
        return nonempty(self.records)

    def figures(self) -> Figures:
        return Figures(self._observation.get)
