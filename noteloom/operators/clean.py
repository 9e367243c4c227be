"""Cleaning and filtering of extracted records."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteloom import contract as C
from noteloom.functions.text import clean, nonblank


def cleaned(records: DataFrame) -> DataFrame:
    """The seven fields cleaned and first, other columns after them as they are."""
    fields = [
        clean(F.col(f) if f in records.columns else F.lit(None)).alias(f) for f in C.FIELDS
    ]
    return records.select(*fields, *[c for c in records.columns if c not in C.FIELDS])


def has_content() -> Column:
    return reduce(or_, [nonblank(F.col(f)) for f in C.FIELDS])


def nonempty(records: DataFrame) -> DataFrame:
    """Records with at least one field that is not blank."""
    return records.filter(has_content())


def removed_records() -> Column:
    """Number of records that ``nonempty`` removes."""
    return F.count_if(~has_content())


def removed_count(records: DataFrame) -> DataFrame:
    return records.agg(removed_records().alias("removed"))
