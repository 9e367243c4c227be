import pytest
from pyspark.sql import functions as F

from noteloom import contract as C
from noteloom.functions import quality, text
from noteloom.functions.cues import cue_fields, with_cues
from noteloom.functions.prompts import note_block, response_token_budget
from noteloom.operators import clean as cleaning
from noteloom.operators import quality as quality_ops


def values(spark, items, expression):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


CLEAN = [
    (None, ""),
    ("  a\n\n b\t c ", "a b c"),
    ("- item", "item"),
    ("*  a", "a"),
    ("•", ""),
    ("-- x", "- x"),
    ("-5 mg", "5 mg"),
    (" x\x1c", "x"),
    ("a 　b", "a b"),
    ("a-b", "a-b"),
    (" \x85 ", ""),
]


def test_clean(spark):
    assert values(spark, [x for x, _ in CLEAN], text.clean) == [y for _, y in CLEAN]


def test_white_space_is_pythons(spark):
    points = [i for i in range(1, 0x10000) if not 0xD800 <= i <= 0xDFFF]
    df = spark.createDataFrame([(i, chr(i)) for i in points], "i int, x string")
    found = df.filter(~text.nonblank(F.col("x"))).select("i", text.strip(F.col("x"))).collect()
    assert {r[0] for r in found} == {i for i in points if chr(i).isspace()}
    assert all(r[1] == "" for r in found)
    assert df.filter(text.strip(F.col("x")) == "").count() == len(found)


def test_score_adds_in_field_order(spark):
    expected = [0.0, 0.2, 0.35, 0.44999999999999996, 0.5499999999999999, 0.75, 0.9, 1.0]
    rows = [tuple("x" if i < n else "  " for i in range(7)) for n in range(8)]
    df = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in C.FIELDS))
    assert [r[0] for r in df.select(quality.documentation_score()).collect()] == expected


def test_presence_of_json_values(spark):
    """0 and {} are present for the score but do not count as populated; NaN the other way."""
    schema = ", ".join(f"{f} string" for f in C.FIELDS) + ", falsy_fields array<string>, nan_fields array<string>"
    row = ("0", "{}", "NaN", "", "", "", "", ["Chief_Complain", "History", "Diagnosis"], ["Allergy"])
    df = spark.createDataFrame([row], schema)
    assert quality_ops.with_score(df).first()[C.SCORE_COLUMN] == pytest.approx(0.35)
    counts = {r.field: r.cnt for r in quality_ops.field_summary(df).collect()}
    assert [counts[f] for f in C.FIELDS] == [0, 0, 1, 0, 0, 0, 0]


AGREEMENT = [
    ("J45.0", "j45.0 ", "Correct"),
    ("J45.9", "J45.0", "Partial"),
    ("J450", "J45.0", "Partial"),
    ("K21", "J45", "Incorrect"),
    ("J", "J45.0", "Incorrect"),
    ("J45", "J", "Partial"),
    (None, "J45", "N/A"),
    ("", "J45", "N/A"),
    ("J45", None, "N/A"),
    ("J45", "", "N/A"),
    ("J45", "  ", "Partial"),
    ("  ", "  ", "Correct"),
    ("J45.0\t", "J45.0", "Partial"),
]


def test_icd10_agreement(spark):
    df = spark.createDataFrame(AGREEMENT, "ai_code string, ICD10_code string, expected string")
    wrong = quality_ops.with_agreement(df).filter("agreement != expected")
    assert wrong.collect() == []
    counts = {r.agreement: (r.cnt, r.accuracy) for r in quality_ops.agreement_counts(quality_ops.with_agreement(df)).collect()}
    assert counts == {"Correct": (2, 2 / 9), "Partial": (5, 2 / 9), "Incorrect": (2, 2 / 9), "N/A": (4, 2 / 9)}


def test_labels(spark):
    assert values(spark, list(C.FIELDS), text.label_of) == [f.replace("_", " ").title() for f in C.FIELDS]


def test_empty_inputs(spark):
    schema = ", ".join(f"{f} string" for f in C.FIELDS)
    none = spark.createDataFrame([], schema)
    assert quality_ops.field_summary(none).collect() == []
    assert quality_ops.overall_completion(none).first().asDict() == {"total_records": 0, "completion_rate": 0.0}
    checked = quality_ops.validated(spark.createDataFrame([], "is_object boolean, keys array<string>"))
    assert quality_ops.validation_totals(checked).first().asDict() == {"total": 0, "valid": 0, "all_valid": False}
    assert cleaning.removed_count(none).first()[0] == 0


def test_validation_needs_keys_not_values(spark):
    rows = [(True, list(C.FIELDS)), (True, [*C.FIELDS[1:], "x"]), (False, list(C.FIELDS)), (True, None)]
    df = spark.createDataFrame(rows, "is_object boolean, keys array<string>")
    checked = [(r.valid, r.missing) for r in quality_ops.validated(df).collect()]
    assert checked == [(True, []), (False, ["Chief_Complain"]), (False, []), (False, list(C.FIELDS))]


def test_cleaned_keeps_other_columns_after_the_fields(spark):
    df = spark.createDataFrame([(1, " a  b ", "x")], "id int, History string, note string")
    row = cleaning.cleaned(df).first()
    assert list(row.asDict()) == [*C.FIELDS, "id", "note"]
    assert (row.History, row.Allergy, row.note) == ("a b", "", "x")


def test_note_block(spark):
    df = spark.createDataFrame(
        [
            (0, " a ", None, None),
            (1, "  ", "n", "c"),
            (2, "b", "Asthma", ""),
            (3, "c", "", "J45"),
            (4, "d", "Asthma", "J45"),
        ],
        "pos int, note string, name string, code string",
    )
    blocks = [r[0] for r in df.orderBy("pos").select(note_block(F.col("pos"), F.col("note"), F.col("name"), F.col("code"))).collect()]
    heading = "\n\n" + C.BILLING_HEADING
    assert blocks == [
        "**Note 1:**\na",
        None,
        f"**Note 3:**\nb{heading}\n- Billing Diagnosis: Asthma",
        f"**Note 4:**\nc{heading}\n- Billing ICD-10: J45",
        f"**Note 5:**\nd{heading}\n- Billing Diagnosis: Asthma\n- Billing ICD-10: J45",
    ]


def test_token_budget(spark):
    found = values(spark, ["é" * n for n in (100, 4000, 4004, 4007, 20000)], response_token_budget)
    assert found == [2000, 2000, 2002, 2002, 8192]


CUES = [
    (
        "CC: cough. PMH: k/c of DM on Synjardy; Meds: Metformin. Allergies: NKDA; O/E: chest clear, no edema."
        " Dx: Asthma. Plan: review",
        {
            "Chief_Complain": "cough",
            "History": "PMH: k/c of DM on Synjardy; Meds: Metformin",
            "Allergy": "NKDA",
            "Comorbidities": "k/c of DM on Synjardy",
            "Clinical_Examination": "O/E: chest clear, no edema",
            "Diagnosis": "Asthma",
            "Treatment_Plan": "review",
        },
    ),
    ("NKDA", {"Allergy": "NKDA"}),
    ("Scaling and polishing are completed", {"Treatment_Plan": "Scaling and polishing are completed"}),
    ("Irregular vaginal bleeding", {"Chief_Complain": "Irregular vaginal bleeding"}),
    ("P2+1; 2CS", {"Chief_Complain": "P2+1; 2CS", "History": "P2+1"}),
    ("Systems NAD. Rx: rest; F/U: 3 months", {"Clinical_Examination": "Systems NAD", "Treatment_Plan": "rest; 3 months"}),
    ("CC:PMH: HTN", {"History": "PMH: HTN"}),
    ("CVS: S1S2 heard; Resp: Clear", {"Clinical_Examination": "CVS: S1S2 heard; Resp: Clear"}),
    ("seen at 10:30, abcc: no label", {"Chief_Complain": "seen at 10:30, abcc: no label"}),
    ("cough, background of asthma, allergy free", {
        "Chief_Complain": "cough, background of asthma", "Comorbidities": "background of asthma", "Allergy": "allergy free"}),
    ("No known drug allergies; Impression: Eczema, both hands", {"Allergy": "No known drug allergies", "Diagnosis": "Eczema, both hands"}),
    ("a\u0001b\u0002c", {"Chief_Complain": "abc"}),
    ("a\tDx \t: flu; Dx\n: no label; 10:30 CC:PMH:HTN", {
        "Chief_Complain": "a", "Diagnosis": "flu; Dx\n: no label; 10:30", "History": "PMH: HTN"}),
    ("(Dx:flu)Plan :rest", {"Chief_Complain": "(", "Diagnosis": "flu)", "Treatment_Plan": "rest"}),
    ("xDx: a 5Plan: b éRx: c", {"Chief_Complain": "xDx: a 5Plan: b é", "Treatment_Plan": "c"}),
    (None, {}),
    ("  ", {}),
]


def test_cue_cases(spark):
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(CUES)], "i int, x string")
    parts = with_cues(df, "x", "p", "l")
    for row in parts.select("i", *cue_fields(F.col("p"), F.col("l"))).collect():
        found = {f: row[f] for f in C.FIELDS if row[f]}
        assert found == CUES[row.i][1], CUES[row.i][0]


def test_every_match_satisfies_its_hint(spark):
    from noteloom.functions.cues import BARE_CUES, _hinted

    cues = [*C.ALLERGY_CUES, *C.EXAMINATION_CUES, *[f"{c} x" for c in C.BACKGROUND_CUES], "P1", "G12+3"]
    texts = [before + cue + after for cue in cues for before in ("", " ", "(") for after in ("", ".", " z")]
    texts += [text.upper() for text in texts]
    df = spark.createDataFrame([(t, t.lower()) for t in texts], "raw string, lowered string")
    for pattern, hint in (pair for pairs in BARE_CUES.values() for pair in pairs):
        matched = df.filter(F.rlike("raw", F.lit(pattern)))
        assert matched.count() > 0
        assert matched.filter(~_hinted(F.col("raw"), F.col("lowered"), hint)).collect() == []


def test_billing_fills_a_missing_diagnosis(spark):
    rows = [("cough", "Asthma", "J45"), ("cough", "", "J45"), ("cough", None, None), ("Dx: Flu", "Asthma", "J45")]
    df = spark.createDataFrame(rows, "x string, name string, code string")
    parts = with_cues(df, "x", "p", "l")
    fields = cue_fields(F.col("p"), F.col("l"), F.col("name"), F.col("code"))
    assert [r.Diagnosis for r in parts.select(*fields).collect()] == ["Asthma", "J45", "", "Flu"]
