"""The registered queries in SQL for DuckDB, written independently of the Spark plans."""

from noteloom import contract as C
from noteloom.functions.text import WS
from noteloom.plans.fixture_views import STAR, with_views

ORACLES: dict[str, str] = {}


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _add(name: str, views: list[str], query: str) -> None:
    ORACLES[name] = with_views(views, query)


def strip(text: str) -> str:
    return rf"regexp_replace({text}, '\A[{WS}]+|[{WS}]+\z', '', 'g')"


def present(field: str) -> str:
    return f"({strip(f'coalesce({field}, {literal(str())})')} <> '')"


# --- cohort ---------------------------------------------------------------------------

LATEST = 'ORDER BY "FormattedDate" DESC NULLS LAST, "ShortName" ASC NULLS LAST'


def cohort_sql(window: str) -> str:
    """The fan-out as a whole, then the latest row of each group."""
    return f"""
    SELECT * FROM (
      SELECT b.Service_Date AS "FormattedDate", s.Staff_name AS "Doctor_Name",
             b.patient_id AS "Patient_Code", b.Episode_key AS "Episode_key", n.Note AS "Note",
             d.ICDDiagnoseCode AS "ICD10_code", g.ShortName AS "ShortName"
      FROM fact_billing b
      JOIN dim_company c ON c.Company_Key = b.Company_Key AND c.CashAccounts = 'Credit'
      JOIN dim_patient_episode_type t ON t.PatientEpisodeType_Key = b.PatientEpisodeType_Key
           AND t.Unified_ShortName = 'OPD'
      JOIN dim_staff s ON s.Staff_Key = b.Doctor_Key
      JOIN dim_clinical_notes n ON n.Episode_key = b.Episode_key AND n.Note IS NOT NULL
      LEFT JOIN dim_diagnosis d ON d.Episode_Key = b.Episode_key
      LEFT JOIN dim_organization g ON g.OrganizationKey = b.Organization_Key
      WHERE {window}
        AND s.degree_key IN (SELECT degree_key FROM dim_staff WHERE lower(category_desc) LIKE '%doctor%')
    ) rows
    QUALIFY row_number() OVER (
      PARTITION BY "Doctor_Name", "Patient_Code", "Episode_key", "Note", "ICD10_code" {LATEST}) = 1"""


ALL_DATES = "b.Service_Date >= TIMESTAMP '1995-01-01' AND b.Service_Date < TIMESTAMP '2002-01-01'"
NEWEST = """ORDER BY "FormattedDate" DESC NULLS LAST, "Doctor_Name" NULLS LAST, "Patient_Code" NULLS LAST,
  "Episode_key" NULLS LAST, "Note" NULLS LAST, "ICD10_code" NULLS LAST, "ShortName" NULLS LAST"""
STAR_VIEWS = list(STAR)

_add("cohort_latest_opd_notes", STAR_VIEWS, cohort_sql(ALL_DATES))
_add("cohort_day_slice", STAR_VIEWS, cohort_sql("CAST(b.Service_Date AS DATE) = DATE '1996-04-29' - 1"))
_add("cohort_one_organization", STAR_VIEWS, cohort_sql(f"{ALL_DATES} AND b.Organization_Key = 1"))
_add("cohort_rolling_window", ["fact_billing", "dim_clinical_notes"], """
    SELECT b.patient_id AS "Patient_ID", n.Note AS "Clinical_Notes", b.Service_Date AS "Visit_Date"
    FROM fact_billing b JOIN dim_clinical_notes n ON n.Episode_key = b.Episode_key
    WHERE n.Note IS NOT NULL AND b.Service_Date >= TIMESTAMP '1997-01-15 12:00:00' - INTERVAL 30 DAY
    ORDER BY 3 DESC NULLS LAST, 1 NULLS LAST, 2 NULLS LAST LIMIT 1000""")
_add("join_company_credit", ["fact_billing", "dim_company"], """
    SELECT b.Service_Date, b.patient_id, b.Episode_key, b.Company_Key, c.CashAccounts
    FROM fact_billing b LEFT JOIN dim_company c ON c.Company_Key = b.Company_Key
    WHERE c.CashAccounts = 'Credit'""")
_add("join_notes_fanout", ["fact_billing", "dim_clinical_notes"], """
    SELECT b.Service_Date, b.Episode_key, b.Doctor_Key, n.Note
    FROM fact_billing b LEFT JOIN dim_clinical_notes n ON n.Episode_key = b.Episode_key
    WHERE n.Note IS NOT NULL""")
_add("join_diagnosis_left", ["fact_billing", "dim_diagnosis"], """
    SELECT b.Service_Date, b.Episode_key, b.Doctor_Key, d.ICDDiagnoseCode
    FROM fact_billing b LEFT JOIN dim_diagnosis d ON d.Episode_Key = b.Episode_key""")
_add("join_staff", ["fact_billing", "dim_staff"], """
    SELECT b.Service_Date, b.Episode_key, b.Doctor_Key, s.Staff_name, s.degree_key
    FROM fact_billing b JOIN dim_staff s ON s.Staff_Key = b.Doctor_Key""")
_add("join_episode_type", ["fact_billing", "dim_patient_episode_type"], """
    SELECT b.Service_Date, b.Episode_key, b.Doctor_Key, t.Unified_ShortName
    FROM fact_billing b LEFT JOIN dim_patient_episode_type t
      ON t.PatientEpisodeType_Key = b.PatientEpisodeType_Key
    WHERE t.Unified_ShortName = 'OPD'""")
_add("join_organization_left", ["fact_billing", "dim_organization"], """
    SELECT b.Service_Date, b.Episode_key, b.Organization_Key, g.ShortName
    FROM fact_billing b LEFT JOIN dim_organization g ON g.OrganizationKey = b.Organization_Key""")
_add("exists_doctor_degree", ["fact_billing", "dim_staff"], """
    SELECT b.Service_Date, b.Episode_key, s.Staff_Key, s.Staff_name, s.category_desc
    FROM fact_billing b JOIN dim_staff s ON s.Staff_Key = b.Doctor_Key
    WHERE EXISTS (SELECT 1 FROM dim_staff o
                  WHERE o.degree_key = s.degree_key AND lower(o.category_desc) LIKE '%doctor%')""")
_add("like_doctor", ["dim_staff"], "SELECT * FROM dim_staff WHERE lower(category_desc) LIKE '%doctor%'")
_add("dedup_latest", STAR_VIEWS, """
    SELECT * FROM (
      SELECT b.Service_Date AS "FormattedDate", s.Staff_name AS "Doctor_Name",
             b.patient_id AS "Patient_Code", b.Episode_key AS "Episode_key", n.Note AS "Note",
             d.ICDDiagnoseCode AS "ICD10_code", g.ShortName AS "ShortName"
      FROM fact_billing b JOIN dim_staff s ON s.Staff_Key = b.Doctor_Key
      JOIN dim_clinical_notes n ON n.Episode_key = b.Episode_key AND n.Note IS NOT NULL
      LEFT JOIN dim_diagnosis d ON d.Episode_Key = b.Episode_key
      LEFT JOIN dim_organization g ON g.OrganizationKey = b.Organization_Key) rows
    QUALIFY row_number() OVER (
      PARTITION BY "Doctor_Name", "Patient_Code", "Episode_key", "Note", "ICD10_code"
      ORDER BY "FormattedDate" DESC NULLS LAST, "ShortName" ASC NULLS LAST) = 1""")
_add("topn_latest", STAR_VIEWS, f"SELECT * FROM ({cohort_sql(ALL_DATES)}) c {NEWEST} LIMIT 10")
_add("cap_rows", STAR_VIEWS, f"SELECT * FROM ({cohort_sql(ALL_DATES)}) c {NEWEST} LIMIT 1000")

_add("cohort_ignore_case", [*STAR_VIEWS, "mixed_case_company", "mixed_case_type", "mixed_case_staff"], f"""
    SELECT DISTINCT "FormattedDate", doctor, "Patient_Code", "Episode_key", "ICD10_code" FROM (
      SELECT b.Service_Date AS "FormattedDate", lower(rtrim(s.Staff_name)) AS doctor,
             b.patient_id AS "Patient_Code", b.Episode_key AS "Episode_key", n.Note AS note,
             d.ICDDiagnoseCode AS "ICD10_code"
      FROM fact_billing b
      JOIN mixed_case_company c ON c.Company_Key = b.Company_Key AND lower(rtrim(c.CashAccounts)) = 'credit'
      JOIN mixed_case_type t ON t.PatientEpisodeType_Key = b.PatientEpisodeType_Key
           AND lower(rtrim(t.Unified_ShortName)) = 'opd'
      JOIN mixed_case_staff s ON s.Staff_Key = b.Doctor_Key
      JOIN dim_clinical_notes n ON n.Episode_key = b.Episode_key AND n.Note IS NOT NULL
      LEFT JOIN dim_diagnosis d ON d.Episode_Key = b.Episode_key
      WHERE {ALL_DATES}
        AND s.degree_key IN (SELECT degree_key FROM mixed_case_staff WHERE lower(category_desc) LIKE '%doctor%')) rows
    QUALIFY "FormattedDate" = max("FormattedDate") OVER (
      PARTITION BY doctor, "Patient_Code", "Episode_key", lower(rtrim(note)), lower(rtrim("ICD10_code")))""")
_add("cohort_from_query_file", ["fact_billing", "dim_clinical_notes"], """
    SELECT b.Service_Date, b.patient_id, n.Note
    FROM fact_billing b JOIN dim_clinical_notes n ON n.Episode_key = b.Episode_key
    WHERE year(b.Service_Date) = 1996 AND n.Note IS NOT NULL""")

# --- notes and prompts ----------------------------------------------------------------

NUMBERED_NOTES = """
    SELECT row_number() OVER (ORDER BY Episode_key, sha256(Note)) - 1 AS row_id, Episode_key, Note
    FROM (SELECT Episode_key, coalesce(Note, '') AS Note FROM dim_clinical_notes) t"""
BATCHED_DOCUMENTS = "SELECT note_id AS row_id, Note, diagnosis_name, icd10_code FROM cue_notes"

_add("notes_as_text", ["dim_clinical_notes"],
     "SELECT Episode_key, coalesce(Note, '') AS Note FROM dim_clinical_notes")
_add("note_batches", ["dim_clinical_notes"], f"""
    SELECT row_id, row_id // 3 AS batch_id, CAST(row_id % 3 AS INTEGER) AS pos_in_batch, Episode_key, Note
    FROM ({NUMBERED_NOTES}) n""")


def prompts_sql(numbered: str, billing: bool) -> str:
    context = ""
    if billing:
        context = f"""|| CASE WHEN coalesce(diagnosis_name, '') = '' AND coalesce(icd10_code, '') = '' THEN ''
            ELSE {literal(chr(10) * 2 + C.BILLING_HEADING)}
              || CASE WHEN coalesce(diagnosis_name, '') = '' THEN ''
                      ELSE {literal(chr(10) + C.BILLING_NAME_LINE)} || diagnosis_name END
              || CASE WHEN coalesce(icd10_code, '') = '' THEN ''
                      ELSE {literal(chr(10) + C.BILLING_CODE_LINE)} || icd10_code END END"""
    blank = strip("coalesce(Note, '')")
    return f"""
    SELECT row_id // 3 AS batch_id, count(*) AS n_notes,
           {literal(C.PROMPT_HEADER + chr(10) * 2)}
           || coalesce(string_agg('**Note ' || (row_id % 3 + 1) || ':**' || chr(10) || {blank} {context},
                chr(10) || chr(10) ORDER BY row_id) FILTER (WHERE {blank} <> ''), '')
           || {literal(chr(10) * 2 + C.PROMPT_FOOTER)} AS user_prompt
    FROM ({numbered}) n GROUP BY row_id // 3"""


_add("batch_prompts", ["dim_clinical_notes"], prompts_sql(NUMBERED_NOTES, False))
_add("batch_prompts_billing", ["cue_notes"], prompts_sql(BATCHED_DOCUMENTS, True))
_add("token_budget", ["cue_notes"], f"""
    SELECT batch_id, length(user_prompt) AS prompt_chars,
           CASE WHEN length(user_prompt) // 4 * 2 > 8192 THEN 8192
                WHEN length(user_prompt) // 4 * 2 < 2000 THEN 2000
                ELSE length(user_prompt) // 4 * 2 END AS max_tokens
    FROM ({prompts_sql(BATCHED_DOCUMENTS, False)}) p""")

# --- responses: what the construction of each kind implies ------------------------------

FOUND = """
    SELECT batch_id, attempt, kind, words,
           CASE kind WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN 5
                     WHEN 5 THEN 0 ELSE 1 END AS strategy,
           CASE kind WHEN 0 THEN 3 WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 1 WHEN 4 THEN 1
                     WHEN 5 THEN 0 WHEN 6 THEN 3 ELSE 4 END AS n_records
    FROM responses"""
RECORD_SLOTS = f"""
    SELECT f.batch_id, f.attempt, f.strategy, f.kind, CAST(p.pos AS INTEGER) AS rec_pos,
           (f.kind = 6 AND p.pos = 2) AS is_extra,
           'c' || f.batch_id || '_' || (CASE WHEN p.pos = 3 THEN 0 ELSE p.pos END) AS complaint,
           CASE WHEN p.pos IN (0, 3) THEN f.words END AS history
    FROM ({FOUND}) f JOIN (SELECT unnest([0, 1, 2, 3]) AS pos) p ON p.pos < f.n_records"""
FAILS_MERGED, FAILS_OBSERVED = "kind = 5", "kind IN (5, 6)"


def first_attempt(source: str, fails: str) -> str:
    return f"""SELECT * FROM ({source}) s WHERE NOT ({fails})
               QUALIFY attempt = min(attempt) OVER (PARTITION BY batch_id)"""


def normalized_sql(fails: str) -> str:
    return f"""
    SELECT batch_id, attempt, rec_pos,
           CASE WHEN is_extra THEN '' ELSE complaint END AS "Chief_Complain",
           coalesce(history, '') AS "History",
           CASE WHEN is_extra THEN '' ELSE 'NKDA' END AS "Allergy", '' AS "Comorbidities",
           '' AS "Clinical_Examination", '' AS "Diagnosis", '' AS "Treatment_Plan",
           CASE WHEN is_extra THEN 'Allergies: NKDA' ELSE '' END AS "Plan_Text"
    FROM ({first_attempt(RECORD_SLOTS, fails)}) r"""


def aligned_sql(fails: str, notes: str = "SELECT doc_id, doc_id % 3 AS slot FROM documents") -> str:
    fields = ", ".join(f"coalesce(r.\"{f}\", '') AS \"{f}\"" for f in C.FIELDS)
    return f"""
    SELECT n.doc_id AS row_id, n.doc_id // 3 AS batch_id, CAST(n.doc_id % 3 AS INTEGER) AS pos_in_batch,
           {fields}
    FROM ({notes}) n LEFT JOIN ({normalized_sql(fails)}) r
      ON r.batch_id = n.doc_id // 3 AND r.rec_pos = n.slot"""


def report_sql(fails: str) -> str:
    return f"""
    SELECT n.batch_id, n.batch_id + 1 AS batch_number, n.n_notes, c.attempt IS NOT NULL AS ok,
           CAST(coalesce(c.attempt, t.tried, 0) AS BIGINT) AS attempts,
           coalesce(c.strategy, 0) AS strategy, coalesce(c.n_records, 0) AS n_records
    FROM (SELECT doc_id // 3 AS batch_id, count(*) AS n_notes FROM documents GROUP BY 1) n
    LEFT JOIN (SELECT batch_id, count(*) AS tried FROM responses GROUP BY 1) t ON t.batch_id = n.batch_id
    LEFT JOIN ({first_attempt(FOUND, fails)}) c ON c.batch_id = n.batch_id"""


_add("repair_strategy", ["responses"],
     f"SELECT batch_id, attempt, strategy, n_records FROM ({FOUND}) f")
_add("repair_records", ["responses"], f"""
    SELECT batch_id, attempt, rec_pos, TRUE AS is_object,
           CASE WHEN is_extra THEN 'Allergies=NKDA'
                WHEN history IS NOT NULL THEN 'Chief_Complain=' || complaint || '|History=' || history || '|Allergy=NKDA'
                ELSE 'Chief_Complain=' || complaint || '|Allergy=NKDA' END AS content
    FROM ({RECORD_SLOTS}) r""")
_add("unwrap_records", [], """
    SELECT doc_id AS batch_id,
           CASE doc_id % 14 WHEN 4 THEN 1 WHEN 10 THEN 0 WHEN 11 THEN 2 WHEN 12 THEN 6 WHEN 13 THEN 4
                            ELSE 1 END AS strategy,
           CASE doc_id % 14 WHEN 1 THEN 2 WHEN 4 THEN 2 WHEN 5 THEN 2 WHEN 10 THEN 0 ELSE 1 END AS n_records,
           doc_id % 14 NOT IN (4, 10) AS ok,
           CASE doc_id % 14 WHEN 1 THEN one || '||' || one WHEN 4 THEN '||' || one
                            WHEN 5 THEN one || '||' || one WHEN 6 THEN one || '|History=|Allergy=' || lang
                            WHEN 9 THEN 'results=' || document WHEN 10 THEN '' ELSE one END AS content
    FROM (SELECT doc_id, lang, 'Chief_Complain=' || translate(text, '[]{}', '()()') AS one,
                 '{"Chief_Complain": ' || CAST(to_json(translate(text, '[]{}', '()()')) AS VARCHAR) || '}' AS document
          FROM documents) d""")
_add("normalize_merge", ["responses"], normalized_sql(FAILS_MERGED))
_add("normalize_observed", ["responses"], normalized_sql(FAILS_OBSERVED))
_add("fix_count", ["responses"], aligned_sql(FAILS_MERGED))
_add("fix_count_nonblank", ["responses", "cue_notes"], aligned_sql(FAILS_MERGED, f"""
    SELECT note_id AS doc_id, CASE WHEN {present("Note")} THEN
             count(*) FILTER (WHERE {present("Note")}) OVER (PARTITION BY note_id // 3 ORDER BY note_id) - 1 END AS slot
    FROM cue_notes"""))
_add("resolve_attempts", ["responses"], f"""
    SELECT batch_id, attempt, strategy, n_records FROM ({first_attempt(FOUND, FAILS_OBSERVED)}) c""")
_add("batch_report", ["responses"], report_sql(FAILS_OBSERVED))
_add("batch_totals", ["responses"], f"""
    SELECT count(*) AS total_batches, count(*) FILTER (WHERE ok) AS successful,
           count(*) FILTER (WHERE NOT ok) AS failed FROM ({report_sql(FAILS_OBSERVED)}) r""")
_add("responses_of_another_day", ["next_day_notes"], """
    SELECT note_id AS row_id,
           CASE WHEN note_id // 3 % 2 = 0 THEN 'first day ' || (note_id // 3) ELSE '' END AS "Allergy"
    FROM next_day_notes""")
_add("pending_after_failure", ["cue_notes"], """
    SELECT note_id // 3 AS batch_id, count(*) AS n_notes FROM cue_notes
    WHERE note_id // 3 % 4 <> 0 GROUP BY note_id // 3""")
_add("model_attempts", ["cue_notes"], f"""
    SELECT batch_id, CAST(attempt AS INTEGER) AS attempt,
           CASE WHEN error IS NULL OR kind = 2 THEN CASE kind WHEN 2 THEN ' '
                ELSE '{{"results":[{{"Allergy":"' || chars || '"}}]}}' END
                WHEN kind = 3 THEN 'I would rather not.' END AS raw, error
    FROM (SELECT *, CASE WHEN kind = 0 OR (kind = 1 AND attempt = 1) THEN 'RuntimeError: down'
                         WHEN kind = 2 THEN 'empty response' WHEN kind = 3 THEN 'no records' END AS error
          FROM (SELECT batch_id, length(user_prompt) AS chars, length(user_prompt) % 5 AS kind
                FROM ({prompts_sql(BATCHED_DOCUMENTS, False)}) p) k,
               (SELECT unnest([1, 2, 3]) AS attempt) a
          WHERE attempt <= CASE kind WHEN 4 THEN 1 WHEN 1 THEN 2 ELSE 3 END) t""")
_add("answers_after_lost_task", ["cue_notes"], f"""
    SELECT batch_id, CAST(1 AS INTEGER) AS attempt, '{{"results":[{{"Allergy":"' || length(user_prompt) || '"}}]}}' AS raw
    FROM ({prompts_sql(BATCHED_DOCUMENTS, False)}) p""")
_add("late_notes", ["late_notes", "unique_notes"], """
    SELECT n.row_id, CASE WHEN n.Note IS NULL THEN '' ELSE told END AS "Allergy"
    FROM late_notes n LEFT JOIN (
      SELECT row_id, 'second ' || (r // 3) || '.' || (r % 3) AS told
      FROM (SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS r FROM late_notes
            WHERE Note IS NOT NULL AND row_id % 50 = 7)
      UNION ALL
      SELECT row_id, 'first ' || (r // 3) || '.' || (r % 3)
      FROM (SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS r FROM unique_notes WHERE Note IS NOT NULL)
      WHERE row_id % 50 <> 7) t USING (row_id)""")
_add("usage_totals", ["billed_responses"], """
    SELECT count(*) AS calls, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
           CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens FROM billed_responses""")


def weighted(counts: str) -> str:
    total = "CAST(0.0 AS DOUBLE)"
    for field, weight in C.FIELD_WEIGHTS.items():
        total = f"({total} + CAST({weight} AS DOUBLE) * {counts.format(field=field)})"
    return total


_FILLED = " + ".join(f"n_{f}" for f in C.FIELDS)
_add("quality_metrics", ["billed_responses"], f"""
    SELECT notes, CAST(extracted AS DOUBLE) / notes * 100 AS success_rate,
           CAST({_FILLED} AS DOUBLE) / (total * 7) * 100 AS completion_rate,
           {weighted('n_{field}')} / total AS mean_score,
           CAST(notes * 60000 AS DOUBLE) / elapsed_ms AS notes_per_minute
    FROM (SELECT count(*) AS total, {", ".join(f"count(*) FILTER (WHERE {present(f)}) AS n_{f}" for f in C.FIELDS)}
          FROM ({aligned_sql(FAILS_OBSERVED)}) a) a,
         (SELECT CAST(sum(n_notes) AS BIGINT) AS notes,
                 CAST(sum(n_notes) FILTER (WHERE ok) AS BIGINT) AS extracted
          FROM ({report_sql(FAILS_OBSERVED)}) r) b,
         (SELECT CAST(sum(elapsed_ms) AS BIGINT) AS elapsed_ms FROM billed_responses) t""")

# --- cue rules: what the construction of each note implies -------------------------------


def tidy(text: str) -> str:
    return rf"regexp_replace({text}, '\A[{WS}]+|[{WS};,.]+\z', '', 'g')"


COMPLETED = r"regexp_matches({text}, '(?i)(^|[^A-Za-z])(completed|done)($|[^A-Za-z])')"


def lead_fields(lead: str) -> dict[str, str]:
    """A note of one segment is a complaint, or a procedure if it says that one is done."""
    done = COMPLETED.format(text=lead)
    return {
        "Chief_Complain": f"CASE WHEN {done} THEN '' ELSE {lead} END",
        "Treatment_Plan": f"CASE WHEN {done} THEN {lead} ELSE '' END",
    }


TEXT = "d.text"
SPELLED = {  # kind of note -> its fields
    "0": {
        "Chief_Complain": tidy(TEXT),
        "History": "'PMH: k/c of ' || d.lang || ', stable; Meds: ' || d.source",
        "Allergy": "'NKDA'",
        "Comorbidities": "'k/c of ' || d.lang",
        "Treatment_Plan": "'review'",
    },
    "1": {
        "Chief_Complain": tidy(TEXT),
        "Clinical_Examination": "'O/E: Systems NAD'",
        "Diagnosis": "d.source",
    },
    "2": lead_fields(tidy(f"('cough since ' || d.source || '  ' || {TEXT})")) | {"Allergy": "'NKDA'"},
    "3": {"Treatment_Plan": tidy(f"({TEXT} || ' scaling completed')")},
    "4": {
        "History": "'PMH: ' || " + tidy(f"({TEXT} || '; background of ' || d.lang || '; P2+1')"),
        "Comorbidities": "'background of ' || d.lang",
        "Treatment_Plan": "'2w'",
    },
    "5": {},
    "6": {
        "Clinical_Examination": "'cvs: S1S2; Resp: clear'",
        "Diagnosis": tidy(TEXT),
        "Treatment_Plan": "d.source || '; more at 10:30'",
    },
    "7": {"Chief_Complain": tidy(TEXT), "Diagnosis": tidy(TEXT)},
    "15": lead_fields(tidy(TEXT)),
}


def spelled(field: str) -> str:
    """The field's value by the kind of its note."""
    cases = " ".join(f"WHEN {kind} THEN {found[field]}" for kind, found in SPELLED.items() if field in found)
    kind = "CASE WHEN d.doc_id % 16 = 15 THEN 15 ELSE d.doc_id % 8 END"
    return f"CASE {kind} {cases} ELSE '' END" if cases else "''"


_add("cue_fields", [], f"""
    SELECT d.doc_id AS note_id, {", ".join(f'{spelled(f)} AS "{f}"' for f in C.FIELDS)} FROM documents d""")
_add("cue_fields_billing", ["cue_notes"], f"""
    SELECT d.doc_id AS note_id,
           coalesce(nullif({spelled("Diagnosis")}, ''), nullif(c.diagnosis_name, ''), nullif(c.icd10_code, ''), '') AS "Diagnosis"
    FROM documents d JOIN cue_notes c ON c.note_id = d.doc_id""")


def star_cues_sql(source: str, kept: str) -> str:
    """Fields of the star's notes: whole documents, or a follow-up line with its label."""
    lead = tidy("coalesce(Note, '')")
    found = lead_fields(lead)
    follow_up = "starts_with(Note, 'F/U: ')"
    values = {f: "''" for f in C.FIELDS} | {
        "Chief_Complain": f"CASE WHEN {follow_up} THEN '' ELSE {found['Chief_Complain']} END",
        "Treatment_Plan": f"CASE WHEN {follow_up} THEN {tidy('substring(Note, 6)')} ELSE {found['Treatment_Plan']} END",
    }
    fields = ", ".join(f'{v} AS "{f}"' for f, v in values.items())
    return f"SELECT {kept}, {fields} FROM ({source}) s"


# --- quality --------------------------------------------------------------------------

SCORE = f"least({weighted('CASE WHEN p_{field} THEN 1 ELSE 0 END')}, 1.0)"


def scored(source: str, kept: str) -> str:
    flags = ", ".join(f"{present(f)} AS p_{f}" for f in C.FIELDS)
    return f"""SELECT {kept}, CAST({SCORE} AS DOUBLE) AS "{C.SCORE_COLUMN}"
               FROM (SELECT *, {flags} FROM ({source}) s) t"""


SUMMARY = "\n UNION ALL ".join(
    f"SELECT '{f}' AS field, {i} AS field_ord, {literal(f.replace('_', ' '))} AS label,"
    f" count(*) FILTER (WHERE {present(f)}) AS cnt,"
    f" CAST(count(*) FILTER (WHERE {present(f)}) AS DOUBLE) / count(*) * 100 AS pct FROM records"
    for i, f in enumerate(C.FIELDS)
)
MISSING = """CASE WHEN History IS NULL AND Clinical_Examination IS NULL THEN 'History,Clinical_Examination'
                  WHEN History IS NULL THEN 'History'
                  WHEN Clinical_Examination IS NULL THEN 'Clinical_Examination' ELSE '' END"""
AGREED = r"""
    SELECT *, CASE WHEN coalesce(ai_code, '') = '' OR coalesce("ICD10_code", '') = '' THEN 'N/A'
                   WHEN upper(replace(ai_code, ' ', '')) = upper(replace("ICD10_code", ' ', '')) THEN 'Correct'
                   WHEN starts_with(upper(replace(ai_code, ' ', '')),
                                    left(upper(replace("ICD10_code", ' ', '')), 3)) THEN 'Partial'
                   ELSE 'Incorrect' END AS agreement
    FROM code_pairs"""

_add("opd_score", ["records"], scored("SELECT * FROM records", "note_id"))
_add("validate_records", ["records"],
     f"SELECT note_id, {MISSING} = '' AS valid, {MISSING} AS missing FROM records")
_add("validation_totals", ["records"], f"""
    SELECT count(*) AS total, count(*) FILTER (WHERE {MISSING} = '') AS valid,
           coalesce(bool_and({MISSING} = ''), FALSE) AS all_valid FROM records""")
_add("field_summary", ["records"], f"SELECT field, field_ord, cnt, pct FROM ({SUMMARY}) s")
_add("field_labels", ["records"], f"SELECT field, label, cnt FROM ({SUMMARY}) s")
_add("overall_completion", ["records"], f"""
    SELECT (SELECT count(*) FROM records) AS total_records,
           CAST(sum(cnt) AS DOUBLE) / ((SELECT count(*) FROM records) * 7) * 100 AS completion_rate
    FROM ({SUMMARY}) s""")
_add("top5_fields", ["records"],
     f"SELECT field, cnt, pct FROM ({SUMMARY}) s ORDER BY pct DESC, field_ord LIMIT 5")
_add("icd10_agreement", ["code_pairs"], AGREED)
_add("icd10_agreement_counts", ["code_pairs"], f"""
    SELECT l.agreement, (SELECT count(*) FROM ({AGREED}) a WHERE a.agreement = l.agreement) AS cnt,
           (SELECT CAST(count(*) FILTER (WHERE agreement = 'Correct') AS DOUBLE)
                   / count(*) FILTER (WHERE agreement <> 'N/A') FROM ({AGREED}) a) AS accuracy
    FROM (SELECT unnest(['Correct', 'Partial', 'Incorrect', 'N/A']) AS agreement) l""")

# --- cleaning, merging, writing -------------------------------------------------------


def cleaned(field: str) -> str:
    line = rf"regexp_replace({strip(f'coalesce({field}, {literal(str())})')}, '[{WS}]+', ' ', 'g')"
    return rf"""regexp_replace({line}, '\A[-*•][ ]*', '') AS "{field}" """


_CONTENT = " OR ".join(present(f) for f in C.FIELDS)
_add("clean_records", ["long_records"],
     f"SELECT {', '.join(cleaned(f) for f in C.FIELDS)}, note_id, lang FROM long_records")
_add("filter_nonempty", ["sparse_records"], f"SELECT * FROM sparse_records WHERE {_CONTENT}")
_add("removed_count", ["sparse_records"],
     f"SELECT count(*) FILTER (WHERE NOT ({_CONTENT})) AS removed FROM sparse_records")
_add("merge_by_row", ["dim_clinical_notes", "dim_diagnosis"], f"""
    SELECT coalesce(l.row_id, r.row_id) AS row_id, l.Episode_key, l.Note, r.Coded_episode, r.ICDDiagnoseCode
    FROM ({NUMBERED_NOTES}) l FULL JOIN (
      SELECT row_number() OVER (ORDER BY Episode_Key, ICDDiagnoseCode) - 1 AS row_id,
             Episode_Key AS Coded_episode, ICDDiagnoseCode FROM dim_diagnosis) r ON r.row_id = l.row_id""")
_add("append_roundtrip", ["records"], f"""
    SELECT t.* FROM ({scored("SELECT * FROM records", "* EXCLUDE (" + ", ".join("p_" + f for f in C.FIELDS) + ")")}) t,
           (SELECT unnest([1, 2])) twice""")
_add("replace_day", ["records"], f"""
    SELECT *, CAST(note_id % 3 AS VARCHAR) AS service_day
    FROM ({scored("SELECT * FROM records", "* EXCLUDE (" + ", ".join("p_" + f for f in C.FIELDS) + ")")}) t
    WHERE note_id % 3 = 2 OR note_id % 6 = 0""")
_add("replace_that_fails", ["records"], f"""
    SELECT *, CAST(note_id % 3 AS VARCHAR) AS service_day
    FROM ({scored("SELECT * FROM records", "* EXCLUDE (" + ", ".join("p_" + f for f in C.FIELDS) + ")")}) t
    WHERE note_id % 3 <> 0 OR note_id % 2 = 0""")
_add("append_once", ["records"], f"""
    SELECT t.* FROM ({scored("SELECT * FROM records", "* EXCLUDE (" + ", ".join("p_" + f for f in C.FIELDS) + ")")}) t,
           (SELECT unnest(['monday', 'tuesday'])) runs""")
_add("measured_during_write", ["sparse_records"], f"""
    SELECT total - removed AS written, total, removed, {", ".join(f"n_{f} AS {f}" for f in C.FIELDS)},
           CAST({" + ".join(f"n_{f}" for f in C.FIELDS)} AS DOUBLE) / (total * 7) * 100 AS completion_rate,
           {weighted('n_{field}')} / total AS mean_score
    FROM (SELECT count(*) AS total, count(*) FILTER (WHERE NOT ({_CONTENT})) AS removed,
                 {", ".join(f"count(*) FILTER (WHERE {present(f)}) AS n_{f}" for f in C.FIELDS)} FROM sparse_records) c""")
WRONG_VALUES = """
    SELECT 'fact_billing' AS source, Episode_key AS row_key, column_name AS "column", value FROM (
      SELECT Episode_key, unnest(['Service_Date', 'patient_id', 'Company_Key', 'Doctor_Key']) AS column_name,
             unnest([Service_Date, patient_id, Company_Key, Doctor_Key]) AS value,
             unnest([TRY_CAST(Service_Date AS TIMESTAMP) IS NULL, TRY_CAST(patient_id AS BIGINT) IS NULL,
                     TRY_CAST(Company_Key AS BIGINT) IS NULL, TRY_CAST(Doctor_Key AS BIGINT) IS NULL]) AS wrong
      FROM text_billing) v WHERE wrong AND value IS NOT NULL"""
_add("rejected_values", ["text_billing"], WRONG_VALUES)
_add("accepted_rows", ["text_billing"], f"""
    SELECT TRY_CAST(Service_Date AS TIMESTAMP) AS Service_Date, count(*) AS n,
           CAST(sum(TRY_CAST(patient_id AS BIGINT)) AS BIGINT) AS patients, CAST(NULL AS VARCHAR) AS lost_column
    FROM text_billing
    WHERE TRY_CAST(Service_Date AS TIMESTAMP) IS NOT NULL AND TRY_CAST(patient_id AS BIGINT) IS NOT NULL
      AND (Company_Key IS NULL OR TRY_CAST(Company_Key AS BIGINT) IS NOT NULL) AND TRY_CAST(Doctor_Key AS BIGINT) IS NOT NULL
    GROUP BY 1
    UNION ALL SELECT NULL, count(*), NULL, "column" FROM ({WRONG_VALUES}) w GROUP BY 4""")
_add("json_export", ["records"], "SELECT '{\"note_id\":' || note_id || " + " || ".join(
    f"',\"{f}\":' || CASE WHEN {f} IS NULL THEN 'null' ELSE CAST(to_json({f}) AS VARCHAR) END" for f in C.FIELDS
) + " || '}' AS record_json FROM records")

# --- the whole run --------------------------------------------------------------------

NUMBERED_COHORT = f"""
    SELECT row_number() OVER (ORDER BY "FormattedDate" DESC NULLS LAST, "Doctor_Name" NULLS LAST,
             "Patient_Code" NULLS LAST, "Episode_key" NULLS LAST, "ICD10_code" NULLS LAST,
             "ShortName" NULLS LAST, sha256("Note")) - 1 AS row_id, *
    FROM ({cohort_sql(ALL_DATES)}) c"""
_COHORT_LIST = "row_id, " + ", ".join(f'"{c}"' for c in C.COHORT_COLUMNS)
_FIELD_LIST = ", ".join(f'"{f}"' for f in C.FIELDS)
_add("end_to_end_results", STAR_VIEWS, scored(
    star_cues_sql(NUMBERED_COHORT, _COHORT_LIST), f"{_COHORT_LIST}, {_FIELD_LIST}"))
_add("end_to_end_totals", STAR_VIEWS, f"""
    SELECT (count(*) + 2) // 3 AS total_batches, (count(*) + 2) // 3 AS successful, CAST(0 AS BIGINT) AS failed,
           count(*) AS total, count(*) AS valid, TRUE AS all_valid
    FROM ({cohort_sql(ALL_DATES)}) c""")
