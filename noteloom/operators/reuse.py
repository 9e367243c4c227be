"""Answers found again note by note.

Batch numbers follow row numbers, so one late note moves all later ones to other batches, whose
prompts are new. An index of the notes that prompts held lets a note take its record from the
response to an earlier prompt, and only notes that no answered prompt held are batched and asked.
A note is the same if everything that a prompt shows of it is, under the same wording.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteloom.functions.prompts import note_block
from noteloom.operators.extract import ANSWERED
from noteloom.operators.notes import with_row_id

DIGEST = "note_digest"
MARK = "note_mark"  # of a written row: what is joined by it needs no text and no unique row_id


def note_digest(
    note: Column, name: Column | None, code: Column | None, header: str, footer: str, system: str
) -> Column:
    """What a prompt shows of a note, but its number, with the wording around it; null for a blank one."""
    block = note_block(F.lit(0), note, name, code)
    wording = F.lit("\u0000".join((system, header, footer, "")))
    return F.when(block.isNotNull(), F.sha2(F.concat(wording, block), 256))


def note_positions(batched: DataFrame, asked: DataFrame) -> DataFrame:
    """Which prompt holds each row's note, and which record of a response is its own; no note of
    ``batched`` is blank."""
    placed = batched.select("row_id", "batch_id", DIGEST, F.col("pos_in_batch").alias("rec_pos"))
    return placed.join(asked.select(*ANSWERED), "batch_id").select("row_id", DIGEST, *ANSWERED, "rec_pos")


def with_earlier_answer(rows: DataFrame, index: DataFrame, responses: DataFrame) -> DataFrame:
    """``rows`` with batch_id, prompt_digest and rec_pos of one good answer to their note, or nulls."""
    good = responses.filter(F.col("error").isNull() & F.col("raw").isNotNull()).select(*ANSWERED).distinct()
    columns = ["prompt_digest", "batch_id", "rec_pos"]
    known = (
        index.join(good, ANSWERED, "left_semi")
        .groupBy(DIGEST)
        .agg(F.min(F.struct(*columns)).alias("first"))
        .select(DIGEST, "first.*")
    )
    return rows.join(known, DIGEST, "left")


def to_ask(rows: DataFrame) -> DataFrame:
    """The rows whose note still needs an answer, numbered in their order by ``rest_id``."""
    rest = rows.where(F.col(DIGEST).isNotNull() & F.col("prompt_digest").isNull()).drop("prompt_digest", "batch_id", "rec_pos")
    # Numbers alone are sorted, not the notes.
    numbers = with_row_id(rest.select("row_id"), [F.asc("row_id")], "rest_id")
    return rest.join(numbers, "row_id")


def in_one_numbering(placed: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Batches of several runs, whose numbers repeat, under new numbers in rows and responses."""
    batches = placed.select(*ANSWERED).where(F.col("prompt_digest").isNotNull()).distinct()
    numbers = with_row_id(batches, [F.asc("prompt_digest"), F.asc("batch_id")], "new_batch")

    def renamed(df: DataFrame, how: str) -> DataFrame:
        return df.join(numbers, ANSWERED, how).drop("batch_id").withColumnRenamed("new_batch", "batch_id")

    return renamed(placed, "left"), renamed(responses, "inner")
