"""Cue-based field extraction: the labels of the note contract applied with native columns."""

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteloom import contract as C
from noteloom.functions.text import WS_CHARS, or_empty

# Control characters used as marks inside the working text; removed from notes first.
SEGMENT, VALUE = "\u0001", "\u0002"


def _any_of(words) -> str:
    """Alternation, longest first, so that a label never hides a longer one."""
    return "|".join(re.escape(w).replace("\\ ", " ") for w in sorted(words, key=len, reverse=True))


ALL_LABELS = [label for labels in C.FIELD_LABELS.values() for label in labels]
_LONGEST_LABEL = max(map(len, ALL_LABELS))
# A label stands right before a colon: it is looked for there alone, in the few characters that
# it can have and the one before it.
LABEL_AT_END = rf"(?i)(?<![A-Za-z0-9])({_any_of(ALL_LABELS)})\z"
_BLANKS = " \t"
ALLERGY_PATTERN = rf"(?i)(^|[^A-Za-z])({_any_of(C.ALLERGY_CUES)})($|[^A-Za-z])"
EXAMINATION_PATTERN = rf"(?i)(^|[^A-Za-z])({_any_of(C.EXAMINATION_CUES)})($|[^A-Za-z])"
KNOWN_CASE_PATTERN = rf"(?i)(^|[^A-Za-z])((?:{_any_of(C.KNOWN_CASE_CUES)}) [^;.,\n]+)"
BACKGROUND_PATTERN = rf"(?i)(^|[^A-Za-z])((?:{_any_of(C.BACKGROUND_CUES)}) [^;.,\n]+)"
# Case matters here, but only within (?-i:...): without the flag in front, Java's matcher
# takes ten times as long on this pattern.
OBSTETRIC_PATTERN = r"(?i)(^|[^A-Za-z0-9])((?-i:[PG])[0-9]+(?:\+[0-9]+)?)"
COMPLETION_PATTERN = rf"(?i)(^|[^A-Za-z])({_any_of(C.COMPLETION_CUES)})($|[^A-Za-z])"

# Bare cues of each field, looked for in the lead and in the segments of other fields. Beside
# each pattern stands a hint that every match satisfies: plain words, one of which is in the
# lowered text, or a short pattern. Hints are tried on the whole note first; most notes fail
# them all, which costs far less to find out, and are not searched any further.
BARE_CUES = {
    "History": ((KNOWN_CASE_PATTERN, C.KNOWN_CASE_CUES), (OBSTETRIC_PATTERN, "[PG][0-9]")),
    "Allergy": ((ALLERGY_PATTERN, ("nk", "allerg")),),
    "Comorbidities": ((BACKGROUND_PATTERN, C.BACKGROUND_CUES),),
    "Clinical_Examination": ((EXAMINATION_PATTERN, C.EXAMINATION_CUES),),
}
_CUES = [(f"{name}_{i}", *cue) for name, cues in BARE_CUES.items() for i, cue in enumerate(cues)]


def _hinted(text: Column, lowered: Column, hint: str | tuple[str, ...]) -> Column:
    if isinstance(hint, str):
        return F.rlike(text, F.lit(hint))
    return reduce(or_, [F.contains(lowered, F.lit(word.lower())) for word in hint])


def _tidy(text: Column) -> Column:
    return F.rtrim(F.ltrim(text, F.lit(WS_CHARS)), F.lit(WS_CHARS + ";,."))


def _found(text: Column, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(2)), _tidy)


def _without_marks(note: Column) -> Column:
    marked = F.contains(note, F.lit(SEGMENT)) | F.contains(note, F.lit(VALUE))
    return F.when(marked, F.translate(note, SEGMENT + VALUE, "")).otherwise(note)


def _with_label_marked(piece: Column) -> Column:
    """The text before a colon, with marks around the label it ends in, or with its colon."""
    trimmed = F.rtrim(piece, F.lit(_BLANKS))
    label = F.regexp_extract(F.right(trimmed, F.lit(_LONGEST_LABEL + 1)), LABEL_AT_END, 1)
    before = F.substring(trimmed, F.lit(1), F.length(trimmed) - F.length(label))
    marked = F.concat(before, F.lit(SEGMENT), label, F.lit(VALUE))
    return F.when(label != "", marked).otherwise(F.concat(piece, F.lit(":")))


def _marked(plain: Column) -> Column:
    pieces = F.split(plain, ":")
    last = F.size(pieces)
    ends = F.transform(F.slice(pieces, F.lit(1), last - 1), _with_label_marked)
    return F.when(
        F.contains(plain, F.lit(":")), F.concat(F.array_join(ends, ""), F.get(pieces, last - 1))
    ).otherwise(plain)


def _cut(part: Column, i: Column) -> Column:
    """One part of the marked text as struct<label, raw>; the part before any label has none."""
    label = F.when(i > 0, F.substring_index(part, VALUE, 1))
    return F.struct(label.alias("label"), F.substring_index(part, VALUE, -1).alias("raw"))


def _described(part: Column) -> Column:
    """The part with its field and its text as a field value."""
    label, text = part["label"], part["raw"]
    field = F.lit(None).cast("string")
    for name, labels in C.FIELD_LABELS.items():
        field = F.when(F.lower(label).isin(*[x.lower() for x in labels]), name).otherwise(field)
    return F.struct(
        field.alias("field"), label.alias("label"), text.alias("raw"), _tidy(text).alias("value")
    )


def _searched(hints: Column):
    """For a part: what each pattern finds in it, as far as the note's hints allow any."""

    def of(part: Column) -> Column:
        found = [part[c].alias(c) for c in ("field", "label", "raw", "value")]
        for name, pattern, hint in _CUES:
            here = hints[name] & _hinted(part["raw"], F.lower(part["raw"]), hint)
            found.append(F.when(here, _found(part["raw"], pattern)).otherwise(F.array()).alias(name))
        return F.struct(*found, hints["completion"].alias("may_be_completed"))

    return of


def plain_note(note: Column) -> Column:
    return _without_marks(or_empty(note))


def note_hints(plain: Column, lowered: Column) -> Column:
    """struct of booleans: which cues the note can hold."""
    hints = [_hinted(plain, lowered, hint).alias(name) for name, _, hint in _CUES]
    return F.struct(*hints, _hinted(plain, lowered, C.COMPLETION_CUES).alias("completion"))


def segments(plain: Column, hints: Column) -> Column:
    """array<struct<field, label, raw, value, ...>>, one element per segment, and the text
    before any label first. What the bare-cue patterns find in a segment stands in
    ``<field>_0``, ``<field>_1``."""
    parts = F.split(_marked(plain), SEGMENT)
    # One step per function: what a step computes, the next one reads several times.
    for step in (_cut, _described, _searched(hints)):
        parts = F.transform(parts, step)
    return parts


def lead(parts: Column) -> Column:
    """Text before the first label, without the allergy and examination cues in it."""
    first = parts[0]
    text = first["raw"]
    for name, pattern in (("Allergy_0", ALLERGY_PATTERN), ("Clinical_Examination_0", EXAMINATION_PATTERN)):
        text = F.when(F.size(first[name]) > 0, F.regexp_replace(text, pattern, "$1$3")).otherwise(text)
    return _tidy(text)


def _labelled(parts: Column, field: str) -> Column:
    """Segments of a field, in note order."""
    own = F.filter(parts, lambda p: (p["field"] == field) & (p["value"] != ""))
    if field in C.LABELLED_FIELDS:
        return F.transform(own, lambda p: F.concat(p["label"], F.lit(": "), p["value"]))
    return F.transform(own, lambda p: p["value"])


def _bare(parts: Column, field: str) -> list[Column]:
    """Bare cues of a field found outside its own segments, in note order."""
    others = F.filter(parts, lambda p: ~F.equal_null(p["field"], F.lit(field)))
    found = [f"{field}_{i}" for i in range(len(BARE_CUES.get(field, ())))]
    return [F.flatten(others[name]) for name in found]


def with_cues(notes: DataFrame, note: str, parts: str = "_parts", lead_text: str = "_lead") -> DataFrame:
    """``notes`` with the segments and the lead of each, column by column: what one step
    computes, the next one reads several times."""
    steps = {
        "_plain": plain_note(F.col(note)),
        "_lowered": F.lower(F.col("_plain")),
        "_hints": note_hints(F.col("_plain"), F.col("_lowered")),
        parts: segments(F.col("_plain"), F.col("_hints")),
        lead_text: lead(F.col(parts)),
    }
    found = notes
    for name, column in steps.items():
        found = found.withColumn(name, column)
    return found.drop("_plain", "_lowered", "_hints")


def cue_fields(
    parts: Column,
    lead_text: Column,
    billing_name: Column | None = None,
    billing_code: Column | None = None,
) -> list[Column]:
    """The seven fields from the segments and the lead of a note."""
    is_procedure = (
        (F.size(parts) == 1)
        & parts[0]["may_be_completed"]
        & F.rlike(lead_text, F.lit(COMPLETION_PATTERN))
    )
    nothing = F.array().cast("array<string>")
    lead_list = F.when(lead_text != "", F.array(lead_text)).otherwise(nothing)

    found = {field: [_labelled(parts, field), *_bare(parts, field)] for field in C.FIELDS}
    found["Chief_Complain"].insert(0, F.when(is_procedure, nothing).otherwise(lead_list))
    found["Treatment_Plan"].insert(0, F.when(is_procedure, lead_list).otherwise(nothing))
    fields = {f: F.array_join(F.concat(*found[f]), "; ") for f in C.FIELDS}
    if billing_name is not None or billing_code is not None:
        given = [F.nullif(c, F.lit("")) for c in (billing_name, billing_code) if c is not None]
        fields["Diagnosis"] = F.coalesce(
            F.nullif(fields["Diagnosis"], F.lit("")), *given, F.lit("")
        )
    return [fields[f].alias(f) for f in C.FIELDS]
