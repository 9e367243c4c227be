"""Buckets of neighbouring ids: a global order without one sort of everything in one place."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteloom.llm.common import in_slices

ERROR = 0.002  # rank error of the bucket bounds, as a share of all rows


@dataclass(frozen=True)
class Buckets:
    """Ascending bounds: bucket i holds the ids from bounds[i-1] up to, but without, bounds[i].

    The list lives on the driver; its length is a number of tasks, not of rows. Rows without
    an id are in the first bucket.
    """

    bounds: tuple[int, ...]

    @classmethod
    def of(cls, df: DataFrame, column: str, per_slice: int = 2) -> "Buckets":
        n = in_slices(df) * per_slice
        ids = df.select(F.col(column).cast("long").alias("id")).where("id is not null")
        found = ids.approxQuantile("id", [i / n for i in range(1, n)], min(ERROR, 0.2 / n))
        return cls(tuple(sorted({int(v) for v in found})))

    def number(self, column: Column) -> Column:
        """The bucket of an id, as a balanced tree of comparisons."""

        def tree(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            middle = (low + high) // 2
            return F.when(column >= self.bounds[middle], tree(middle + 1, high)).otherwise(tree(low, middle))

        return tree(0, len(self.bounds))
