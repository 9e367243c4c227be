"""Score of a record and agreement of diagnosis codes."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from noteloom.contract import CODE_CATEGORY_LENGTH, FIELD_WEIGHTS
from noteloom.functions.text import nonblank


def documentation_score(
    weights: Mapping[str, float] = FIELD_WEIGHTS, nan_fields: Column | None = None
) -> Column:
    """Sum of the weights of present fields, capped at 1.

    Added strictly from left to right: the rounding noise of doubles is part of the value.
    A field listed in ``nan_fields`` held a JSON NaN and is absent.
    """
    score = F.lit(0.0)
    for field, weight in weights.items():
        present = nonblank(F.col(field))
        if nan_fields is not None:
            present &= ~F.coalesce(F.array_contains(nan_fields, field), F.lit(False))
        score = score + F.when(present, F.lit(weight)).otherwise(F.lit(0.0))
    return F.least(score, F.lit(1.0))


def populated(field: str, falsy_fields: Column | None = None) -> Column:
    """Whether a field counts as populated; JSON 0, false, [] and {} do not."""
    counts = nonblank(F.col(field))
    if falsy_fields is not None:
        counts &= ~F.coalesce(F.array_contains(falsy_fields, field), F.lit(False))
    return counts


def _normalized(code: Column) -> Column:
    return F.upper(F.replace(code, F.lit(" "), F.lit("")))


def icd10_agreement(predicted: Column, actual: Column) -> Column:
    given = F.coalesce((predicted != "") & (actual != ""), F.lit(False))
    ours, theirs = _normalized(predicted), _normalized(actual)
    category = F.substring(theirs, 1, CODE_CATEGORY_LENGTH)
    return (
        F.when(~given, "N/A")
        .when(ours == theirs, "Correct")
        .when(F.startswith(ours, category), "Partial")
        .otherwise("Incorrect")
    )
