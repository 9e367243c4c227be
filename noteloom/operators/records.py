"""Responses to one record per note."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noteloom import contract as C
from noteloom.functions.responses import attempt_failed, keys_of, normalized, parsed
from noteloom.functions.text import nonblank


ROW = "response_row"


def parsed_attempts(responses: DataFrame, extras: str = "merge") -> DataFrame:
    """responses with strategy, records and whether the attempt counts.

    A failing record fails its whole attempt, which is decided here on the response's own
    row: no grouping is needed for it.
    """
    return (
        responses.withColumn("_parsed", parsed(F.col("raw")))
        .withColumns(
            {
                "strategy": F.col("_parsed.strategy"),
                "records": F.col("_parsed.records"),
                "ok": ~attempt_failed(F.col("_parsed"), extras),
            }
        )
        .drop("_parsed", "raw")
    )


def repaired_records(attempts: DataFrame) -> DataFrame:
    """One row per record found in a response: its position and its entries."""
    return attempts.select(
        "batch_id", "attempt", "strategy", F.posexplode("records").alias("rec_pos", "_record")
    ).select(
        "batch_id",
        "attempt",
        "strategy",
        "rec_pos",
        F.col("_record.is_object").alias("is_object"),
        F.col("_record.entries").alias("entries"),
    )


def first_ok(attempts: DataFrame, max_attempts: int = C.MAX_ATTEMPTS) -> DataFrame:
    """The first attempt of each batch that counts, within ``max_attempts``."""
    usable = _usable(attempts, max_attempts)
    order = Window.partitionBy("batch_id").orderBy("attempt")
    return usable.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def first_ok_of_stored(attempts: DataFrame, max_attempts: int = C.MAX_ATTEMPTS) -> DataFrame:
    """The same for attempts that are written, with their row number ``response_row``.

    The first one is found on numbers alone, for which the table is read a second time; the
    parsed records stay where they are as long as these numbers are few enough to be broadcast.
    """
    usable = _usable(attempts, max_attempts)
    number = F.min(F.struct("attempt", ROW)).alias("first")
    first = usable.groupBy("batch_id").agg(number).select("batch_id", "first.*")
    return usable.join(first, ["batch_id", "attempt", ROW], "left_semi").drop(ROW)


def _usable(attempts: DataFrame, max_attempts: int) -> DataFrame:
    return attempts.filter(F.col("ok") & (F.col("attempt") <= max_attempts))


def normalized_records(records: DataFrame) -> DataFrame:
    """The contract's fields of every record that is an object."""
    return records.filter("is_object").select(
        *[c for c in records.columns if c not in ("is_object", "entries")],
        *normalized(F.col("entries")),
    )


def records_for_notes(
    batched: DataFrame, records: DataFrame, align: str = "position", note: str = "Note"
) -> DataFrame:
    """Exactly one record per note: record j goes to note j of its batch, missing ones are
    blank and surplus ones drop.

    ``align="nonblank"`` gives record j to the j-th note that is not blank, since blank
    notes are left out of the prompt.
    """
    if align == "position":
        notes = batched.withColumn("_slot", F.col("pos_in_batch"))
    elif align == "nonblank":
        filled = nonblank(F.col(note))
        order = Window.partitionBy("batch_id").orderBy("pos_in_batch")
        notes = batched.withColumn(
            "_slot", F.when(filled, F.sum(F.when(filled, 1).otherwise(0)).over(order) - 1)
        )
    else:
        raise ValueError("align must be 'position' or 'nonblank'")
    found = records.withColumnRenamed("rec_pos", "_slot").drop("attempt", "strategy")
    texts = (*C.FIELDS, C.EXTRA_COLUMN)
    joined = notes.join(found, ["batch_id", "_slot"], "left")
    return joined.select(
        *batched.columns,
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in texts],
        *[c for c in ("falsy_fields", "nan_fields") if c in found.columns],
    )


def batch_report(
    batched: DataFrame, attempts: DataFrame, max_attempts: int = C.MAX_ATTEMPTS
) -> DataFrame:
    """Per batch: size, outcome, attempts made, strategy and number of records found."""
    sizes = batched.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_notes"))
    ok_attempt = F.when(F.col("ok"), F.col("attempt"))
    outcomes = (
        attempts.filter(F.col("attempt") <= max_attempts)
        .select("batch_id", "attempt", "ok", "strategy", F.size("records").alias("n_records"))
        .groupBy("batch_id")
        .agg(
            F.count(F.lit(1)).alias("tried"),
            F.min(ok_attempt).alias("attempt"),
            F.min_by("strategy", ok_attempt).alias("strategy"),
            F.min_by("n_records", ok_attempt).alias("n_records"),
        )
    )
    return sizes.join(outcomes, "batch_id", "left").select(
        "batch_id",
        (F.col("batch_id") + 1).alias("batch_number"),
        "n_notes",
        F.col("attempt").isNotNull().alias("ok"),
        F.coalesce("attempt", "tried", F.lit(0)).cast("bigint").alias("attempts"),
        F.coalesce("strategy", F.lit(0)).alias("strategy"),
        F.coalesce("n_records", F.lit(0)).alias("n_records"),
    )


def batch_totals(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("total_batches"),
        F.count_if("ok").alias("successful"),
        F.count_if(~F.col("ok")).alias("failed"),
    )


def usage_totals(responses: DataFrame) -> DataFrame:
    return responses.agg(
        F.count(F.lit(1)).alias("calls"),
        F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("prompt_tokens"),
        F.coalesce(F.sum("completion_tokens"), F.lit(0)).alias("completion_tokens"),
    )


def with_keys(records: DataFrame) -> DataFrame:
    """Key names of each record, as validation wants them."""
    return records.withColumn("keys", keys_of(F.col("entries")))
