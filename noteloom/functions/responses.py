"""Reading records out of free-form model responses.

Which strategy applies depends on what Python's ``json`` accepts, and Spark's JSON
functions accept other texts (they ignore a tail, for one). So the parse itself is one
Arrow UDF; every step after it is a native column.
"""

import json
import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from noteloom import contract as C
from noteloom.functions.text import nonblank
from noteloom.schemas import PARSED_RESPONSE

_SQUARE = re.compile(r"[\[\]]")
_CURLY = re.compile(r"[{}]")
MAX_ARRAY_DEPTH = 2


def _outer_span(text, opener, closer):
    start, end = text.find(opener), text.rfind(closer)
    return text[start : end + 1] if -1 < start < end else None


def array_span(text):
    """Leftmost bracketed array at most two levels deep, else first `[` to last `]`.

    One pass with a stack of (start, levels below): a regular expression would back up
    from every unclosed bracket.
    """
    open_arrays, best = [], None
    for bracket in _SQUARE.finditer(text):
        if bracket.group() == "[":
            open_arrays.append([bracket.start(), 0])
        elif open_arrays:
            start, below = open_arrays.pop()
            depth = below + 1
            if open_arrays:
                open_arrays[-1][1] = max(open_arrays[-1][1], depth)
            if depth <= MAX_ARRAY_DEPTH and (best is None or start < best[0]):
                best = (start, bracket.end())
    return text[slice(*best)] if best else _outer_span(text, "[", "]")


def object_span(text):
    """First `{` to last `}`, if that span has as many of one as of the other."""
    span = _outer_span(text, "{", "}")
    return span if span and span.count("{") == span.count("}") else None


def balanced_span(text, brackets):
    """From the first opening bracket to where it closes; quotes are not honoured."""
    depth = start = 0
    for bracket in brackets.finditer(text):
        if bracket.group() in "[{":
            start = start if depth else bracket.start()
            depth += 1
        elif depth:
            depth -= 1
            if not depth:
                return text[start : bracket.end()]
    return None


def line_span(text):
    """The array or object found from the first line that begins like one.

    Brackets are counted once, not again from every line: an object reaches from its line to
    the last closing bracket, and an array that is not found from one line, for want of a
    closing bracket, is not found from a later one.
    """
    last = text.rfind("}")
    opened, closed = (text.count(bracket, 0, last + 1) for bracket in "{}")
    offset, arrays = 0, True
    for line in text.split("\n"):
        first = line.strip()[:1]
        start = offset + line.find(first) if first else offset
        if first == "[" and arrays:
            span = array_span(text[offset:])
            if span:
                return span
            arrays = False
        elif first == "{" and start < last and opened == closed:
            return text[start : last + 1]
        opened -= line.count("{")
        closed -= line.count("}")
        offset += len(line) + 1
    return None


def unfenced(text):
    opener = next((f for f in C.FENCE_OPENERS if text.startswith(f)), "")
    return text.removeprefix(opener).removesuffix(C.FENCE_CLOSER).strip()


# Strategy number -> candidate text. Tried in this order; the first result that is not
# empty wins. Strategy 3 alone takes the parsed list as it stands.
STRATEGIES = (
    (1, lambda text: text),
    (2, unfenced),
    (3, array_span),
    (4, object_span),
    (5, lambda text: balanced_span(text, _SQUARE) or balanced_span(text, _CURLY)),
    (6, line_span),
)
TAKES_ANY_LIST = 3


def _all_objects(value):
    return isinstance(value, list) and all(isinstance(item, dict) for item in value)


def unwrap(data):
    """Records held by a parsed document: a list, a known wrapper, or a single record."""
    if isinstance(data, dict):
        for key in C.WRAPPER_KEYS:
            if isinstance(data.get(key), list):
                return data[key]
        if len(data.keys() & set(C.FIELDS)) >= C.MIN_RECORD_FIELDS:
            return [data]
        return next(filter(_all_objects, data.values()), [data])
    return data if _all_objects(data) else []


def parse(raw):
    """(strategy, records) of one response; (0, []) if no strategy applies."""
    text = (raw or "").strip()
    for strategy, candidate_of in STRATEGIES if text else ():
        candidate = candidate_of(text)
        if not candidate or (strategy == 2 and candidate == text):
            continue
        try:
            data = json.loads(candidate)
        except json.JSONDecodeError:
            continue
        except (ValueError, RecursionError):  # too many digits, nested too deep
            break
        records = data if strategy == TAKES_ANY_LIST else unwrap(data)
        if records or strategy == TAKES_ANY_LIST:
            return strategy, records
    return 0, []


def _texts(values):
    """A string array; half a surrogate pair, which JSON may hold, becomes a question mark."""
    try:
        return pa.array(values, pa.string())
    except UnicodeEncodeError:
        whole = [v if v is None else v.encode("utf-8", "replace").decode("utf-8") for v in values]
        return pa.array(whole, pa.string())


def _as_text(value):
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _list_of(struct_type, columns, ends):
    fields = list(struct_type.value_type)
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, fields=fields), struct_type
    )


_ARROW_TYPE = to_arrow_type(PARSED_RESPONSE)


@F.arrow_udf(PARSED_RESPONSE)
def _parse_responses(raw: pa.Array) -> pa.Array:
    """Columns are filled directly: a Python object per entry would cost more than the JSON."""
    found = [parse(text) for text in raw.to_pylist()]
    records = [record for _, held in found for record in held]
    items = [list(r.items()) if isinstance(r, dict) else [] for r in records]
    values = [value for item in items for _, value in item]
    records_type = _ARROW_TYPE.field("records").type
    entries_type = records_type.value_type.field("entries").type
    entries = _list_of(
        entries_type,
        [
            _texts([key for item in items for key, _ in item]),
            _texts([_as_text(value) for value in values]),
            pa.array([not value for value in values], pa.bool_()),
            pa.array([value != value for value in values], pa.bool_()),
        ],
        [0, *accumulate(map(len, items))],
    )
    is_object = pa.array([isinstance(r, dict) for r in records], pa.bool_())
    held_records = _list_of(
        records_type, [is_object, entries], [0, *accumulate(len(held) for _, held in found)]
    )
    strategies = pa.array([strategy for strategy, _ in found], pa.int32())
    return pa.StructArray.from_arrays([strategies, held_records], fields=list(_ARROW_TYPE))


# Parsing gives the same result every time; called non-deterministic, it is not repeated for
# a filter that the planner would otherwise move below it.
_parse_once = _parse_responses.asNondeterministic()


def parsed(raw: Column) -> Column:
    """struct<strategy, records> of a response text."""
    return _parse_once(raw)


def attempt_failed(parsed_response: Column, extras: str = "merge") -> Column:
    """Whether an attempt is lost as a whole: no record, a record that is no object, or,
    with ``extras="observed"``, any key outside the contract that carries a value."""
    records = parsed_response["records"]
    failed = (F.size(records) == 0) | F.exists(records, lambda r: ~r["is_object"])
    if extras == "observed":
        failed |= F.exists(records, lambda r: F.exists(r["entries"], _is_extra))
    elif extras != "merge":
        raise ValueError("extras must be 'merge' or 'observed'")
    return failed


def _is_extra(entry: Column) -> Column:
    return ~entry["key"].isin(*C.FIELDS) & ~entry["falsy"] & nonblank(entry["text"])


def normalized(entries: Column) -> list[Column]:
    """The seven fields as text, the extra keys joined into one column, and the flags."""

    def text_of(field):
        # No map of the entries: two keys that differ in half a surrogate pair only are equal here.
        found = F.filter(entries, lambda e: e["key"] == field)
        return F.coalesce(F.get(found, F.lit(0))["text"], F.lit("")).alias(field)

    fields = [text_of(field) for field in C.FIELDS]
    extra = F.array_join(
        F.transform(
            F.filter(entries, _is_extra), lambda e: F.concat(e["key"], F.lit(": "), e["text"])
        ),
        "; ",
    ).alias(C.EXTRA_COLUMN)

    def flagged(flag):
        return F.transform(F.filter(entries, lambda e: e[flag]), lambda e: e["key"])

    return [*fields, extra, flagged("falsy").alias("falsy_fields"), flagged("nan").alias("nan_fields")]


def keys_of(entries: Column) -> Column:
    return F.transform(entries, lambda e: e["key"])
