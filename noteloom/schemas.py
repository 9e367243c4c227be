"""Explicit schemas: nothing in this package infers a schema from data."""

from pyspark.sql import types as T

from noteloom.contract import COHORT_COLUMNS, EXTRA_COLUMN, FIELDS, SCORE_COLUMN

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(columns: str) -> T.StructType:
    """A schema from "name type, ..."; unlike DDL parsing it needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Star schema of the billing warehouse, one entry per table.
STAR_TABLES = {
    "fact_billing": _struct(
        "Service_Date timestamp_ntz, patient_id bigint, Episode_key bigint, Company_Key bigint,"
        " Doctor_Key bigint, PatientEpisodeType_Key bigint, Organization_Key bigint"
    ),
    "dim_company": _struct("Company_Key bigint, CashAccounts string"),
    "dim_clinical_notes": _struct("Episode_key bigint, Note string"),
    "dim_diagnosis": _struct("Episode_Key bigint, ICDDiagnoseCode string"),
    "dim_staff": _struct(
        "Staff_Key bigint, Staff_name string, degree_key bigint, category_desc string"
    ),
    "dim_patient_episode_type": _struct(
        "PatientEpisodeType_Key bigint, Unified_ShortName string"
    ),
    "dim_organization": _struct("OrganizationKey bigint, ShortName string"),
}

_COHORT_TYPES = {
    "FormattedDate": T.TimestampNTZType(),
    "Patient_Code": T.LongType(),
    "Episode_key": T.LongType(),
}
COHORT = T.StructType(
    [T.StructField(c, _COHORT_TYPES.get(c, T.StringType())) for c in COHORT_COLUMNS]
)

# The seam between prompts and records: one row per attempt. The digest of the prompt says
# which notes a response answers; batch numbers start anew in every run.
RESPONSES = _struct(
    "batch_id bigint, prompt_digest string, attempt int, raw string, error string,"
    " prompt_tokens bigint, completion_tokens bigint, elapsed_ms bigint"
)

# Which notes a prompt held: record ``rec_pos`` of a response to it is the note's.
NOTE_INDEX = _struct("note_digest string, batch_id bigint, prompt_digest string, rec_pos int")

# Values of a source that do not have the type of their column.
REJECTS = _struct("source string, row_key string, column string, value string")

# One parsed record: its keys in order. `falsy` and `nan` keep what text alone would lose.
ENTRY = _struct("key string, text string, falsy boolean, nan boolean")
RECORD = T.StructType(
    [
        T.StructField("is_object", T.BooleanType()),
        T.StructField("entries", T.ArrayType(ENTRY)),
    ]
)
PARSED_RESPONSE = T.StructType(
    [
        T.StructField("strategy", T.IntegerType()),
        T.StructField("records", T.ArrayType(RECORD)),
    ]
)

RESULTS = T.StructType(
    [T.StructField("row_id", T.LongType())]
    + list(COHORT.fields)
    + [T.StructField(f, T.StringType()) for f in (*FIELDS, EXTRA_COLUMN)]
    + [T.StructField(SCORE_COLUMN, T.DoubleType())]
)
