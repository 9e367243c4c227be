"""The repair ladder case by case, and the parts of it against plain definitions."""

import time

import pyarrow as pa
import pytest
from support import plan_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from noteloom import contract as C
from noteloom.functions import responses as R
from noteloom.operators import records
from noteloom.session import configure, fresh_path

# raw response, strategy, records found, and why the attempt fails (None: it counts)
CASES = [
    ('{"results":[{"Chief_Complain":"x","Diagnosis":"y"}]}', 1, 1, None),
    ('```json\n{"results":[{"Chief_Complain":"x"}]}\n```', 2, 1, None),
    ('Here: [{"Chief_Complain":"x"}] ok', 3, 1, None),
    ('Sure: {"Chief_Complain":"x","History":"","Allergy":""} done', 4, 1, None),
    ('note } {"Chief_Complain":"x"} }', 5, 1, None),
    ('Note [see {]\n{"Chief_Complain":"x"}', 6, 1, None),
    ('{"results":[{"Chief_Complain":"x"},{"Chief', 0, 0, "merge"),
    ("[1,2]", 3, 2, "merge"),
    ("{}", 1, 1, None),
    ('see [1]: {"results":[{"Chief_Complain":"x"}]}', 3, 1, "merge"),
    ('{"results":[{"Allergies":"NKDA"}]}', 1, 1, "observed"),
    ('{"results":[{"Allergies":""}]}', 1, 1, None),
    ('{"results":[{"Diagnosis":null}]}', 1, 1, None),
    ('{"results":[{"Diagnosis":["a","b"]}]}', 1, 1, None),
    ('{"items":[{"Diagnosis":"x"}]}', 1, 1, None),
    ('"text"', 0, 0, "merge"),
    ('{"data":[],"results":"x","records":[{"Diagnosis":"x"}]}', 3, 0, "merge"),
    ('{"results":{"Chief_Complain":"x"}}', 1, 1, "observed"),
    (" \n\t ", 0, 0, "merge"),
    ("x [[[1]]] y", 3, 1, "merge"),
    ('{"Diagnosis":"x"} tail', 4, 1, None),
    # beyond the table: what Python's reader takes or refuses
    ('{"Diagnosis":NaN,"Allergy":0,"History":[]}', 1, 1, None),
    ('{"Diagnosis":"a","Diagnosis":"b"}', 1, 1, None),
    ('{"Diagnosis":"\\ud800"}', 1, 1, None),
    ('{"Diagnosis":' + "9" * 5000 + "}", 0, 0, "merge"),
    ("[" * 100_000, 0, 0, "merge"),
    ('{"a":' * 60_000 + "1" + "}" * 60_000, 0, 0, "merge"),
    ("[" + ",".join(["1"] * 20_000), 0, 0, "merge"),
    (None, 0, 0, "merge"),
    (' {"Diagnosis":"x"} ', 1, 1, None),
    ('```\n[{"Diagnosis":"x"}]```', 2, 1, None),
    ('{"notes":[1],"Diagnosis":"x"}', 1, 1, "merge"),
    ('{"Diagnosis":"x","History":"","Allergy":"","list":[{"a":1}]}', 1, 1, "observed"),
    ('{"Diagnosis":"x","list":[]}', 3, 0, "merge"),
]


@pytest.fixture(scope="module")
def attempts(spark):
    rows = [(i, 1, raw) for i, (raw, *_) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "batch_id bigint, attempt int, raw string")
    both = {
        mode: {r.batch_id: r for r in records.parsed_attempts(df, mode).collect()}
        for mode in ("merge", "observed")
    }
    return df, both


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(attempts, i):
    _, both = attempts
    _, strategy, n_records, fails = CASES[i]
    merge, observed = both["merge"][i], both["observed"][i]
    assert (merge.strategy, len(merge.records)) == (strategy, n_records)
    assert merge.ok == (fails != "merge")
    assert observed.ok == (fails is None)


def _normalized(spark, raw):
    df = spark.createDataFrame([(0, 1, raw)], "batch_id bigint, attempt int, raw string")
    found = records.repaired_records(records.first_ok(records.parsed_attempts(df)))
    return records.normalized_records(found).collect()


def test_normalized_values(spark):
    [row] = _normalized(
        spark,
        '{"Diagnosis":["a","é"],"Allergy":0,"History":null,"Comorbidities":NaN,"Treatment_Plan":{},'
        '"Extra":"x","Blank":" \\u00a0","Zero":0,"Flag":true,"List":[1]}',
    )
    assert row.Diagnosis == '["a", "é"]'
    assert (row.Allergy, row.History, row.Comorbidities, row.Treatment_Plan) == ("0", "", "NaN", "{}")
    assert row.Plan_Text == "Extra: x; Flag: true; List: [1]"
    assert {"Allergy", "Treatment_Plan", "History"} <= set(row.falsy_fields)
    assert row.nan_fields == ["Comorbidities"]


def test_last_duplicate_key_wins(spark):
    [row] = _normalized(spark, '{"Diagnosis":"a","Diagnosis":"b"}')
    assert row.Diagnosis == "b"


def test_half_a_surrogate_pair_is_storable(spark):
    [row] = _normalized(spark, '{"Diagnosis":"a\\ud800b"}')
    assert row.Diagnosis == "a?b"


def test_keys_that_differ_in_half_a_pair_only(spark):
    for raw in ('{"\\ud800":"a","\\ud801":"b","Diagnosis":"c"}', '{"\\ud800":"a","?":"b","Diagnosis":"c"}'):
        [row] = _normalized(spark, raw)
        assert (row.Diagnosis, row.Plan_Text) == ("c", "?: a; ?: b")


def closed_arrays(text):
    """(start, end, depth) of every `[` with its closing `]`."""
    for start, character in enumerate(text):
        level = deepest = 0
        for end in range(start, len(text)) if character == "[" else ():
            level += (text[end] == "[") - (text[end] == "]")
            deepest = max(deepest, level)
            if not level:
                yield start, end + 1, deepest
                break


@given(st.text(alphabet="[]ab\n", max_size=40))
@settings(max_examples=2000, deadline=None)
def test_array_span_is_the_leftmost_shallow_array(text):
    shallow = [text[a:b] for a, b, depth in closed_arrays(text) if depth <= 2]
    first, last = text.find("["), text.rfind("]")
    outer = text[first : last + 1] if first != -1 and last > first else None
    assert R.array_span(text) == (shallow[0] if shallow else outer)


@given(st.text(alphabet="{}[] a\n", max_size=40))
@settings(max_examples=2000, deadline=None)
def test_line_span_is_that_of_the_first_line_that_has_one(text):
    lines, found = text.split("\n"), None
    for i, line in enumerate(lines):
        rest = "\n".join(lines[i:])
        span = {"[": R.array_span, "{": R.object_span}.get(line.strip()[:1], lambda rest: None)(rest)
        found = found or span
    assert R.line_span(text) == found


def test_a_long_response_of_open_braces_is_quick():
    began = time.perf_counter()
    for text in ("{x\n" * 350_000, "[x\n" * 350_000, "{x\n" * 350_000 + "}"):
        assert R.parse(text) == (0, [])
    assert time.perf_counter() - began < 5


@given(st.text(alphabet="{}ab\n", max_size=30))
@settings(max_examples=500, deadline=None)
def test_object_and_balanced_spans(text):
    span = R.object_span(text)
    if span:
        assert text.count(span) and span.count("{") == span.count("}")
        assert span == text[text.index("{") : text.rindex("}") + 1]
    balanced = R.balanced_span(text, R._CURLY)
    starts = [
        text[text.index("{") : end + 1]
        for end in range(len(text))
        if "{" in text[: end + 1]
        and text[text.index("{") : end + 1].count("{") == text[text.index("{") : end + 1].count("}")
    ]
    assert balanced == (starts[0] if starts else None)


def test_parse_is_evaluated_once_per_response(spark):
    df = spark.range(3).select(F.col("id").alias("batch_id"), F.lit(1).alias("attempt"), F.lit("{}").alias("raw"))
    found = records.normalized_records(records.repaired_records(records.first_ok(records.parsed_attempts(df))))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert plan.count("_parse_responses(") <= 2  # the operator and its result column


def test_records_stay_while_the_first_good_attempt_is_found(spark):
    rows = [(0, 2, "[{}]"), (0, 1, "x"), (0, 3, "[{}]"), (1, 1, "[{}]"), (1, 1, "[{},{}]")]
    df = spark.createDataFrame(rows, "batch_id bigint, attempt int, raw string").coalesce(1)
    attempts = records.parsed_attempts(df).withColumn(records.ROW, F.monotonically_increasing_id())
    path = fresh_path(spark, "attempts")
    attempts.write.parquet(path)
    chosen = records.first_ok_of_stored(spark.read.parquet(path))
    found = chosen.select("batch_id", "attempt", F.size("records").alias("n")).orderBy("batch_id").collect()
    assert [tuple(r) for r in found] == [(0, 2, 1), (1, 1, 1)]
    plan = plan_of(chosen)
    assert "Window" not in plan
    moved = [node for node in plan.split("\n\n") if node.strip().split("\n")[0].split(") ")[-1] in ("Sort", "Exchange")]
    assert moved and all("records" not in node for node in moved)


def test_wrapper_order():
    assert R.unwrap({"records": [1], "results": [2]}) == [2]
    assert R.unwrap({"x": [{}], "y": 1}) == [{}]
    assert R.unwrap({f: "" for f in C.FIELDS[:3]} | {"x": [{}]})[0].keys() >= set(C.FIELDS[:3])
    assert R.unwrap(3) == [] and R.unwrap([]) == [] and R.unwrap([1]) == []


def test_a_worker_is_handed_few_responses_at_a_time(spark):
    """Each holds whole texts, so memory would follow how many there are, up to the default of 10,000."""

    @F.arrow_udf("int")
    def handed(raw: pa.Array) -> pa.Array:
        return pa.array([len(raw)] * len(raw), pa.int32())

    def largest(rows, size):
        raw = F.repeat(F.lit("x"), F.lit(size))
        return spark.range(0, rows, 1, 1).select(handed(raw).alias("n")).agg(F.max("n")).first()[0]

    configure(spark)
    assert largest(3000, 5) <= 500
    assert largest(300, 200_000) * 200_000 <= 16 << 20
