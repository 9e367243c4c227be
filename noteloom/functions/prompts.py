"""Rendering of notes into prompt text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from noteloom import contract as C
from noteloom.functions.text import or_empty, strip


def note_block(
    position: Column, note: Column, name: Column | None = None, code: Column | None = None
) -> Column:
    """One note under its 1-based number, with billing lines where a name or code is given.

    Null for a blank note: it is left out of the prompt but keeps its number.
    """
    before, after = C.NOTE_HEADING.split("{number}")
    text = strip(or_empty(note))
    block = F.concat(F.lit(before), (position + 1).cast("string"), F.lit(after + "\n"), text)
    if name is not None or code is not None:
        name = or_empty(name) if name is not None else F.lit("")
        code = or_empty(code) if code is not None else F.lit("")
        lines = F.concat(
            F.when(name != "", F.concat(F.lit("\n" + C.BILLING_NAME_LINE), name)).otherwise(""),
            F.when(code != "", F.concat(F.lit("\n" + C.BILLING_CODE_LINE), code)).otherwise(""),
        )
        block = F.when(
            lines != "", F.concat(block, F.lit("\n\n" + C.BILLING_HEADING), lines)
        ).otherwise(block)
    return F.when(text != "", block)


def prompt_text(
    blocks: Column, header: str = C.PROMPT_HEADER, footer: str = C.PROMPT_FOOTER
) -> Column:
    """Blocks joined by blank lines between a header and a footer; nulls are skipped."""
    return F.concat(
        F.lit(header + "\n\n"), F.array_join(blocks, "\n\n"), F.lit("\n\n" + footer)
    )


def prompt_digest(system: Column, prompt: Column) -> Column:
    """What a response has to answer, in 64 letters: both prompts, with a mark between them."""
    return F.sha2(F.concat(system, F.lit("\u0000"), prompt), 256)


def response_token_budget(prompt: Column) -> Column:
    estimated = F.floor(F.length(prompt) / C.CHARS_PER_TOKEN)
    return F.least(
        F.lit(C.MAX_RESPONSE_TOKENS).cast("bigint"),
        F.greatest(
            F.lit(C.MIN_RESPONSE_TOKENS).cast("bigint"), estimated * C.TOKENS_PER_INPUT_TOKEN
        ),
    )
