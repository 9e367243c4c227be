"""Batches of notes as prompts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noteloom import contract as C
from noteloom.functions.prompts import note_block, prompt_digest, prompt_text, response_token_budget
from noteloom.operators.notes import PART


def batch_prompts(
    batched: DataFrame,
    note: str = "Note",
    billing_name: str | None = None,
    billing_code: str | None = None,
    header: str = C.PROMPT_HEADER,
    footer: str = C.PROMPT_FOOTER,
    system: str = C.SYSTEM_PROMPT,
) -> DataFrame:
    """prompts(batch_id, n_notes, user_prompt, max_tokens, prompt_digest).

    A group is one batch and so never holds more than the batch size. Rows that lie in parts of
    whole batches, which the column ``PART`` tells, stay where they are.
    """
    placed = [PART] if PART in batched.columns else []
    name, code = (F.col(c) if c else None for c in (billing_name, billing_code))
    block = note_block(F.col("pos_in_batch"), F.col(note), name, code)
    blocks = batched.select(*placed, "batch_id", "pos_in_batch", block.alias("block"))
    if not placed:
        blocks = blocks.repartition("batch_id")  # collecting before the shuffle would sort and save nothing
    return (
        blocks.groupBy(*placed, "batch_id")
        .agg(
            F.count(F.lit(1)).alias("n_notes"),
            F.array_sort(F.collect_list(F.struct("pos_in_batch", "block")))["block"].alias("blocks"),
        )
        .select(
            "batch_id", "n_notes", prompt_text(F.col("blocks"), header, footer).alias("user_prompt")
        )
        .withColumn("max_tokens", response_token_budget(F.col("user_prompt")))
        .withColumn("prompt_digest", prompt_digest(F.lit(system), F.col("user_prompt")))
    )


def prompt_of(notes: list[str], header: str = C.PROMPT_HEADER, footer: str = C.PROMPT_FOOTER) -> str:
    """The prompt of a given list of notes, for callers outside a job."""
    if not notes:
        return C.NO_NOTES_PROMPT
    blocks = [
        C.NOTE_HEADING.format(number=i) + "\n" + note.strip()
        for i, note in enumerate(notes, start=1)
        if note.strip()
    ]
    return "\n\n".join([header, "\n\n".join(blocks), footer])
