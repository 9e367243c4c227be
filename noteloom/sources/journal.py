"""Answers kept call by call, before the job that makes the calls is done.

A run's journal is a folder. Each attempt of a task adds the calls it makes to a file of its own,
one JSON line a call, so what was paid for outlives the task, the job and the driver. A line that
was torn off by a dying task does not end in the mark that a whole one ends in, and is dropped.
"""

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noteloom.schemas import RESPONSES
from noteloom.sources.files import Lines, bytes_in_task, names_in_task

WHOLE = "whole"
_LINE = T.StructType([*RESPONSES.fields, T.StructField(WHOLE, T.BooleanType())])


class Journal:
    """The part of a run's journal that one task writes."""

    def __init__(self, uri: str, partition: int):
        self.uri, self.partition = uri, partition
        self._lines = Lines(uri, f"part-{partition}")

    def earlier(self) -> dict[tuple, list[dict]]:
        """What an earlier attempt of this task was answered: all calls of the batches that have a
        good answer, by batch and prompt."""
        found: dict[tuple, list[dict]] = {}
        for name in names_in_task(self.uri):
            if not re.fullmatch(rf"part-{self.partition}-[0-9a-f]+", name):
                continue
            for line in bytes_in_task(self.uri, name).splitlines():
                try:
                    row = json.loads(line)
                except ValueError:
                    continue
                if isinstance(row, dict) and row.pop(WHOLE, False):
                    found.setdefault((row["batch_id"], row["prompt_digest"]), []).append(row)
        return {key: rows for key, rows in found.items() if any(r["error"] is None for r in rows)}

    def add(self, row: dict) -> None:
        self._lines.add(json.dumps(row | {WHOLE: True}).encode())

    def close(self) -> None:
        self._lines.close()


def journal_rows(spark: SparkSession, uri: str) -> DataFrame:
    """All whole calls of a run's journal."""
    row = F.from_json("value", _LINE).alias("row")
    return (
        spark.read.text(uri)
        .select(row)
        .where(F.coalesce(F.col(f"row.{WHOLE}"), F.lit(False)))
        .select(*[f"row.{name}" for name in RESPONSES.fieldNames()])
    )
