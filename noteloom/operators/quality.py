"""Scores, validation, summaries and agreement."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteloom import contract as C
from noteloom.functions.quality import documentation_score, icd10_agreement, populated
from noteloom.functions.text import label_of


def _column(df: DataFrame, name: str) -> Column | None:
    return F.col(name) if name in df.columns else None


def with_score(records: DataFrame) -> DataFrame:
    score = documentation_score(nan_fields=_column(records, "nan_fields"))
    return records.withColumn(C.SCORE_COLUMN, score)


def validated(records: DataFrame) -> DataFrame:
    """``missing`` fields of each record and whether it is ``valid``: an object that has all
    seven keys, with or without a value. Reads the columns is_object and keys."""
    required = F.array(*[F.lit(f) for f in C.FIELDS])
    missing = F.array_except(required, F.coalesce("keys", F.array().cast("array<string>")))
    return records.withColumns(
        {"missing": missing, "valid": F.col("is_object") & (F.size(missing) == 0)}
    )


def validation_totals(checked: DataFrame) -> DataFrame:
    """One row; no records at all is not valid."""
    return checked.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("valid").alias("valid"),
        F.coalesce(F.bool_and("valid"), F.lit(False)).alias("all_valid"),
    )


def _counts(records: DataFrame) -> DataFrame:
    """One row: number of records and of populated values per field."""
    falsy = _column(records, "falsy_fields")
    return records.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(populated(f, falsy)).alias(f) for f in C.FIELDS],
    )


def field_summary(records: DataFrame) -> DataFrame:
    """Per field: order, label, count and percentage of records; no rows for no records."""
    per_field = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                F.lit(i).alias("field_ord"),
                F.col(f).alias("cnt"),
            )
            for i, f in enumerate(C.FIELDS)
        ]
    )
    return (
        _counts(records)
        .filter("total > 0")
        .select("total", F.inline(per_field))
        .select(
            "field",
            "field_ord",
            label_of(F.col("field")).alias("label"),
            "cnt",
            (F.col("cnt") / F.col("total") * 100).alias("pct"),
        )
    )


def overall_completion(records: DataFrame) -> DataFrame:
    """One row: records and the share of populated values among all; zeros for no records."""
    filled = sum((F.col(f) for f in C.FIELDS[1:]), F.col(C.FIELDS[0]))
    rate = F.when(F.col("total") > 0, filled / (F.col("total") * len(C.FIELDS)) * 100)
    return _counts(records).select(
        F.col("total").alias("total_records"),
        F.coalesce(rate, F.lit(0.0)).alias("completion_rate"),
    )


def top_fields(summary: DataFrame, n: int = 5) -> DataFrame:
    return summary.orderBy(F.desc("pct"), "field_ord").limit(n)


def with_agreement(df: DataFrame, predicted: str = "ai_code", actual: str = "ICD10_code") -> DataFrame:
    return df.withColumn("agreement", icd10_agreement(F.col(predicted), F.col(actual)))


def agreement_counts(agreed: DataFrame) -> DataFrame:
    """Rows per agreement label, and the share of Correct among comparable rows."""
    counts = agreed.agg(
        *[F.count_if(F.col("agreement") == label).alias(label) for label in C.AGREEMENT_LABELS]
    )
    comparable = F.col("Correct") + F.col("Partial") + F.col("Incorrect")
    rate = F.coalesce(F.try_divide(F.col("Correct"), comparable), F.lit(0.0))
    per_label = F.array(
        *[
            F.struct(F.lit(label).alias("agreement"), F.col(f"`{label}`").alias("cnt"))
            for label in C.AGREEMENT_LABELS
        ]
    )
    return counts.select(F.inline(per_label), rate.alias("accuracy"))


def quality_metrics(report: DataFrame, records: DataFrame, responses: DataFrame) -> DataFrame:
    """One row: success rate over notes, completion, mean score and notes per minute.

    The mean score is the weighted sum of populated counts, in field order: unlike an
    average of doubles it does not depend on the order rows arrive in.
    """
    notes = report.agg(
        F.coalesce(F.sum("n_notes"), F.lit(0)).alias("notes"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("n_notes"))), F.lit(0)).alias("extracted"),
    )
    present = with_presence_counts(records)
    score = F.lit(0.0)
    for field, weight in C.FIELD_WEIGHTS.items():
        score = score + F.lit(weight) * F.col(f"present_{field}")
    time_spent = responses.agg(F.sum("elapsed_ms").alias("elapsed_ms"))
    filled = sum((F.col(f) for f in C.FIELDS[1:]), F.col(C.FIELDS[0]))

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    sides = notes.unionByName(present, True).unionByName(time_spent, True)
    one_row = sides.agg(*[F.max(c).alias(c) for c in sides.columns])
    return one_row.select(
        "notes",
        (share(F.col("extracted"), F.col("notes")) * 100).alias("success_rate"),
        (share(filled, F.col("total") * len(C.FIELDS)) * 100).alias("completion_rate"),
        share(score, F.col("total")).alias("mean_score"),
        F.try_divide(F.col("notes") * 60000, F.col("elapsed_ms")).alias("notes_per_minute"),
    )


def presence_counts(records: DataFrame) -> dict[str, Column]:
    """Number of records, of populated values as in the summary, and of present ones as in the score."""
    falsy, nan = _column(records, "falsy_fields"), _column(records, "nan_fields")
    return (
        {"total": F.count(F.lit(1))}
        | {f: F.count_if(populated(f, falsy)) for f in C.FIELDS}
        | {f"present_{f}": F.count_if(populated(f, nan)) for f in C.FIELDS}
    )


def with_presence_counts(records: DataFrame) -> DataFrame:
    """One row: populated counts as in the summary, and present counts as in the score."""
    return records.agg(*[count.alias(name) for name, count in presence_counts(records).items()])
