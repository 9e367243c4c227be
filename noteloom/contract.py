"""Names, weights, formats and word lists that results depend on.

Nothing here is computed from data. Every other module imports these names, so the
seven fields, their order and their weights are stated exactly once.
"""

# --- fixed values: the seven extracted fields in canonical order -----------------
# The order breaks ties in the top-fields report and fixes the floating-point
# summation order of the documentation score.
FIELDS = (
    "Chief_Complain",
    "History",
    "Allergy",
    "Comorbidities",
    "Clinical_Examination",
    "Diagnosis",
    "Treatment_Plan",
)

# --- fixed values: weight of a populated field in the documentation score --------
FIELD_WEIGHTS = {
    "Chief_Complain": 0.20,
    "History": 0.15,
    "Allergy": 0.10,
    "Comorbidities": 0.10,
    "Clinical_Examination": 0.20,
    "Diagnosis": 0.15,
    "Treatment_Plan": 0.10,
}
SCORE_COLUMN = "Documentation_Appropriateness"
EXTRA_COLUMN = "Plan_Text"

# --- fixed values: cohort result columns -----------------------------------------
COHORT_COLUMNS = (
    "FormattedDate",
    "Doctor_Name",
    "Patient_Code",
    "Episode_key",
    "Note",
    "ICD10_code",
    "ShortName",
)
CREDIT_ACCOUNT = "Credit"
OUTPATIENT_TYPE = "OPD"
DOCTOR_WORD = "doctor"

# --- fixed values: batching, retry and token budget ------------------------------
BATCH_SIZE = 3
MAX_ROWS = 1000
MAX_ATTEMPTS = 3
RATE_LIMIT_SECONDS = 1.0
CHARS_PER_TOKEN = 4
TOKENS_PER_INPUT_TOKEN = 2
MIN_RESPONSE_TOKENS = 2000
MAX_RESPONSE_TOKENS = 8192

# --- fixed values: response wrappers and the single-record rule ------------------
WRAPPER_KEYS = ("results", "data", "notes", "extracted_features", "records")
MIN_RECORD_FIELDS = 3  # 30 % of seven fields, rounded up
FENCE_OPENERS = ("```json", "```")
FENCE_CLOSER = "```"

# --- fixed values: prompt formats ------------------------------------------------
NOTE_HEADING = "**Note {number}:**"
BILLING_HEADING = "**BILLING INFORMATION (for reference):**"
BILLING_NAME_LINE = "- Billing Diagnosis: "
BILLING_CODE_LINE = "- Billing ICD-10: "
NO_NOTES_PROMPT = "No clinical notes provided."

# --- fixed values: agreement labels of diagnosis codes ---------------------------
AGREEMENT_LABELS = ("Correct", "Partial", "Incorrect", "N/A")
CODE_CATEGORY_LENGTH = 3

# --- fixed values: note labels and bare cues per field ---------------------------
# A label is followed by a colon and opens a segment that runs to the next label.
FIELD_LABELS = {
    "Chief_Complain": ("CC", "C/O", "Chief Complaint", "Presenting with", "Patient complains of"),
    "History": ("PMH", "PSH", "FH", "SH", "Meds"),
    "Allergy": ("Allergies", "Allergy"),
    "Comorbidities": ("Comorbidities",),
    "Clinical_Examination": (
        "O/E", "PE", "Examination", "On examination",
        "CVS", "Resp", "CNS", "Abdomen", "MSK",
    ),
    "Diagnosis": ("Diagnosis", "Dx", "Impression", "Assessment"),
    "Treatment_Plan": ("Plan", "Rx", "Management", "F/U", "Follow up", "Referral", "Instructions"),
}
# Fields whose segments keep their label, as in "PMH: HTN; Meds: Metformin".
LABELLED_FIELDS = ("History", "Clinical_Examination")
ALLERGY_CUES = (
    "NKDA", "NKA", "no allergy", "no known drug allergies", "no known allergies", "allergy free",
)
EXAMINATION_CUES = ("Systems NAD",)
KNOWN_CASE_CUES = ("k/c of", "known case of")
BACKGROUND_CUES = ("k/c of", "known case of", "background of")
COMPLETION_CUES = ("completed", "done")

# --- our own wording of the extraction contract ----------------------------------
# Sent to the model, never part of a result; both can be replaced per run.
SYSTEM_PROMPT = """\
You read outpatient clinical notes and file what they say under seven headings.

Headings, and the labels that usually introduce them:
""" + "\n".join(
    f"- {field}: {', '.join(labels)}" for field, labels in FIELD_LABELS.items()
) + """

How to fill them:
- Quote the note. Keep its wording, abbreviations and units; add nothing of your own.
- Join several findings under one heading with "; ".
- A stated absence (such as NKDA or Systems NAD) is a finding and is recorded.
- Laboratory and imaging results are not examination findings; dates of visits are not history.
- A billing code, where given, may supply the diagnosis only if the note states none.
- A heading the note says nothing about gets an empty string, never null.
- However short a note is, something of it lands under a heading.

Answer with one JSON object {"results": [...]} holding one object per note, in the order of
the notes. Each object has exactly the seven headings as keys. Write no other text.
"""
PROMPT_HEADER = "File the outpatient notes below under the seven headings."
PROMPT_FOOTER = (
    "One object per numbered note, same order, inside {\"results\": [...]}.\n"
    "Keys: " + ", ".join(FIELDS) + ".\n"
    "Join several findings with \"; \". Reply with the JSON object alone."
)
