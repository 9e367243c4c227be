"""Test inputs derived from the given tables, as SQL that runs in Spark and in DuckDB.

``{name}`` stands for a table or an earlier view; literal braces are doubled.
"""

from pyspark.sql import DataFrame, SparkSession


TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

STAR = {
    "fact_billing": """
        SELECT l.l_shipdate AS Service_Date, o.o_custkey AS patient_id, o.o_orderkey AS Episode_key,
               o.o_custkey % 6 AS Company_Key, l.l_suppkey % 10 AS Doctor_Key,
               CAST(substring(o.o_orderpriority, 1, 1) AS INT) AS PatientEpisodeType_Key,
               o.o_orderkey % 30 AS Organization_Key
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    "dim_company": """
        SELECT r_regionkey AS Company_Key,
               CASE WHEN r_regionkey IN (0, 1, 2) THEN 'Credit' ELSE 'Cash' END AS CashAccounts
        FROM {region}""",
    "dim_patient_episode_type": """
        SELECT r_regionkey + 1 AS PatientEpisodeType_Key,
               CASE WHEN r_regionkey < 3 THEN 'OPD' WHEN r_regionkey = 3 THEN 'IPD' ELSE 'ER' END
                 AS Unified_ShortName
        FROM {region}""",
    "dim_organization": """
        SELECT n_nationkey AS OrganizationKey, n_name AS ShortName FROM {nation}""",
    "dim_staff": """
        SELECT s_suppkey AS Staff_Key, s_name AS Staff_name,
               CASE WHEN s_suppkey % 11 = 9 THEN NULL ELSE s_suppkey % 7 END AS degree_key,
               CASE WHEN s_suppkey % 7 IN (0, 2, 4) AND s_suppkey % 3 = 0 THEN 'Consultant DOCTOR'
                    WHEN s_suppkey % 2 = 0 THEN 'Nurse' ELSE NULL END AS category_desc
        FROM {supplier}""",
    "dim_clinical_notes": """
        SELECT doc_id AS Episode_key, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE text END AS Note
        FROM {documents}
        UNION ALL
        SELECT doc_id, concat('F/U: ', source) FROM {documents} WHERE doc_id % 5 = 0""",
    "dim_diagnosis": """
        SELECT p_partkey % 600 AS Episode_Key,
               concat(chr(CAST(65 + p_partkey % 26 AS INT)),
                      lpad(CAST(p_partkey * 7 % 100 AS VARCHAR(10)), 2, '0'),
                      '.', CAST(p_partkey % 10 AS VARCHAR(10))) AS ICDDiagnoseCode
        FROM {part}""",
}

OTHER = {
    # The seven fields, with nulls, blanks, bullets and runs of spaces.
    "records": """
        SELECT doc_id AS note_id, source AS Chief_Complain,
               CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '   '
                    ELSE concat('- PMH:  ', lang, '   known ', text) END AS History,
               CASE WHEN doc_id % 4 = 0 THEN 'NKDA' ELSE '' END AS Allergy,
               CASE WHEN doc_id % 5 = 0 THEN '* DM' ELSE '' END AS Comorbidities,
               CASE WHEN n_chars % 2 = 0 THEN concat('Systems NAD ', text) ELSE NULL END AS Clinical_Examination,
               CASE WHEN n_chars % 3 = 0 THEN concat('Dx ', lang) ELSE '' END AS Diagnosis,
               CASE WHEN doc_id % 7 = 0 THEN 'F/U 2w' ELSE '' END AS Treatment_Plan
        FROM {documents}""",
    # As above, with some records that are blank throughout.
    "sparse_records": """
        SELECT note_id, CASE WHEN note_id % 10 = 1 THEN '' ELSE Chief_Complain END AS Chief_Complain,
               History, Allergy, Comorbidities, Clinical_Examination, Diagnosis, Treatment_Plan
        FROM {records}""",
    # Whole documents as field values, for cleaning.
    "long_records": """
        SELECT doc_id AS note_id, concat(chr(160), text, chr(10), chr(10), ' end ', chr(9)) AS Chief_Complain,
               CASE WHEN doc_id % 3 = 0 THEN concat('* ', text) ELSE concat('-- ', source) END AS History,
               CASE WHEN doc_id % 4 = 0 THEN '-' ELSE concat('•  ', lang) END AS Allergy,
               CASE WHEN doc_id % 5 = 0 THEN NULL ELSE concat(chr(28), source, chr(133)) END AS Comorbidities,
               concat('-5 mg \u2003', lang) AS Clinical_Examination,
               '\u3000' AS Diagnosis,
               source AS Treatment_Plan, lang
        FROM {documents}""",
    # One response per batch of three documents, in eight forms; a second attempt for some. The
    # first record holds the text of the batch's first document, without quotes and brackets.
    "responses": """
        SELECT b AS batch_id, a AS attempt, k AS kind, words, CASE k
          WHEN 0 THEN concat('{{"results":[', r0, ',', r1, ',', r2, ']}}')
          WHEN 1 THEN concat('```json', chr(10), '{{"results":[', r0, ',', r1, ',', r2, ']}}', chr(10), '```')
          WHEN 2 THEN concat('Here: [', r0, ',', r1, '] ok')
          WHEN 3 THEN concat('Sure: ', r0, ' done')
          WHEN 4 THEN concat('note }} ', r0, ' }}')
          WHEN 5 THEN concat('{{"results":[', r0, ',{{"Chief')
          WHEN 6 THEN concat('{{"results":[', r0, ',', r1, ',{{"Allergies":"NKDA"}}]}}')
          ELSE concat('{{"results":[', r0, ',', r1, ',', r2, ',', r0, ']}}') END AS raw
        FROM (SELECT b, a, words, CASE WHEN a = 2 THEN 0 ELSE b % 8 END AS k,
                     concat('{{"Chief_Complain":"c', CAST(b AS VARCHAR(20)), '_0","History":"', words, '","Allergy":"NKDA"}}') AS r0,
                     concat('{{"Chief_Complain":"c', CAST(b AS VARCHAR(20)), '_1","Allergy":"NKDA"}}') AS r1,
                     concat('{{"Chief_Complain":"c', CAST(b AS VARCHAR(20)), '_2","Allergy":"NKDA"}}') AS r2
              FROM (SELECT b, 1 AS a, words FROM {first_words}
                    UNION ALL SELECT b, 2 AS a, words FROM {first_words} WHERE b % 16 IN (5, 6)) y) z""",
    "first_words": """
        SELECT CAST(floor(doc_id / 3) AS BIGINT) AS b,
               translate(coalesce(min_by(text, doc_id), ''),
                         concat(chr(34), chr(92), chr(10), chr(9), chr(13), chr(96), '[]{{}}'),
                         concat(chr(39), '/', '   ', chr(39), '()()')) AS words
        FROM {documents} GROUP BY CAST(floor(doc_id / 3) AS BIGINT)""",
    # The same with usage and timing, as a model would report them.
    "billed_responses": """
        SELECT batch_id, attempt, raw, CAST(length(raw) * 3 AS BIGINT) AS prompt_tokens,
               CAST(length(raw) AS BIGINT) AS completion_tokens,
               CAST(100 + batch_id % 50 AS BIGINT) AS elapsed_ms
        FROM {responses}""",
    # Pairs of predicted and recorded codes covering every kind of agreement.
    "code_pairs": """
        SELECT p_partkey AS pair_id,
               CASE p_partkey % 9 WHEN 0 THEN lower(code) WHEN 1 THEN concat(' ', code, ' ')
                    WHEN 2 THEN replace(code, '.', '') WHEN 3 THEN concat(substring(code, 1, 4), 'X')
                    WHEN 4 THEN substring(code, 1, 1) WHEN 5 THEN NULL WHEN 6 THEN ''
                    WHEN 7 THEN concat(code, chr(9)) ELSE '  ' END AS ai_code,
               CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  '
                    WHEN 3 THEN substring(code, 1, 1) ELSE code END AS ICD10_code
        FROM (SELECT p_partkey,
                     concat(chr(CAST(65 + p_partkey % 26 AS INT)),
                            lpad(CAST(p_partkey * 7 % 100 AS VARCHAR(10)), 2, '0'), '.',
                            CAST(p_partkey % 10 AS VARCHAR(10))) AS code
              FROM {part}) c""",
    # Whole documents with labels and cues around them.
    "cue_notes": """
        SELECT doc_id AS note_id, source AS diagnosis_name,
               CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '' ELSE concat('J', lang) END AS icd10_code,
               CASE doc_id % 8
                 WHEN 0 THEN concat(text, chr(10), 'PMH: k/c of ', lang, ', stable; Meds: ', source, '. Allergies: NKDA; Plan: review')
                 WHEN 1 THEN concat('CC: ', text, ' O/E: Systems NAD. Dx: ', source, '.')
                 WHEN 2 THEN concat('cough since ', source, ' NKDA ', text)
                 WHEN 3 THEN concat(text, ' scaling completed')
                 WHEN 4 THEN concat('C/O:PMH:', text, '; background of ', lang, '; P2+1 ', chr(10), 'F/U: 2w')
                 WHEN 5 THEN CASE WHEN doc_id % 16 = 5 THEN NULL ELSE concat(' ', chr(160), chr(10)) END
                 WHEN 6 THEN concat('cvs: S1S2; Resp: clear; impression: ', text, ' rx: ', source, '; Rx: more at 10:30')
                 ELSE CASE WHEN doc_id % 16 = 7 THEN concat(text, ' Dx: ', text) ELSE text END END AS Note
        FROM {documents}""",
    # The notes of the next day: the same numbers, other words in every second batch.
    "next_day_notes": """
        SELECT note_id, CASE WHEN CAST(floor(note_id / 3) AS BIGINT) % 2 = 1 THEN concat('Day 2. ', coalesce(Note, '')) ELSE Note END AS Note
        FROM {cue_notes}""",
    # Notes that are all different, some of them blank, and the same with some written anew.
    "unique_notes": """
        SELECT doc_id AS row_id,
               CASE WHEN doc_id % 8 = 5 THEN NULL ELSE concat('No. ', CAST(doc_id AS VARCHAR(20)), ' ', coalesce(text, '')) END AS Note
        FROM {documents}""",
    "late_notes": """
        SELECT row_id, CASE WHEN row_id % 50 = 7 AND Note IS NOT NULL THEN concat(Note, ' (late)') ELSE Note END AS Note FROM {unique_notes}""",
    # Billing lines as text, with values that are no days and no numbers.
    "text_billing": """
        SELECT CASE WHEN Episode_key % 101 = 7 THEN 'not a day' WHEN Episode_key % 101 = 9 THEN '1995-13-01 00:00:00'
                    ELSE CAST(Service_Date AS VARCHAR(30)) END AS Service_Date,
               CASE WHEN Episode_key % 103 = 5 THEN concat('P', CAST(patient_id AS VARCHAR(20)))
                    ELSE CAST(patient_id AS VARCHAR(20)) END AS patient_id,
               CAST(Episode_key AS VARCHAR(20)) AS Episode_key,
               CASE WHEN Episode_key % 107 = 1 THEN '' WHEN Episode_key % 107 = 2 THEN NULL
                    ELSE CAST(Company_Key AS VARCHAR(20)) END AS Company_Key,
               CASE WHEN Episode_key % 101 = 7 THEN 'n/a' ELSE CAST(Doctor_Key AS VARCHAR(20)) END AS Doctor_Key,
               CAST(PatientEpisodeType_Key AS VARCHAR(20)) AS PatientEpisodeType_Key,
               CAST(Organization_Key AS VARCHAR(20)) AS Organization_Key
        FROM {fact_billing}""",
    # The star's texts in mixed case and with trailing spaces.
    "mixed_case_company": """
        SELECT Company_Key, CASE Company_Key % 3 WHEN 0 THEN 'CREDIT' WHEN 1 THEN concat(lower(CashAccounts), '  ')
                                 ELSE CashAccounts END AS CashAccounts
        FROM {dim_company}""",
    "mixed_case_type": """
        SELECT PatientEpisodeType_Key,
               CASE WHEN PatientEpisodeType_Key % 2 = 0 THEN concat(lower(Unified_ShortName), ' ') ELSE Unified_ShortName END
                 AS Unified_ShortName
        FROM {dim_patient_episode_type}""",
    "mixed_case_staff": """
        SELECT Staff_Key, CASE WHEN Staff_Key % 2 = 0 THEN upper(concat('Dr. ', CAST(Staff_Key % 4 AS VARCHAR(10)), 'x '))
                               ELSE concat('dr. ', CAST(Staff_Key % 4 AS VARCHAR(10)), 'X') END AS Staff_name,
               degree_key, category_desc
        FROM {dim_staff}""",
}

VIEWS = STAR | OTHER


class Fixture:
    """The given tables and derived views of one folder, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._known = spark, folder.rstrip("/"), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self._view(VIEWS[name]) if name in VIEWS else self._table(name)
        return self._known[name]

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    def _view(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{name: self[name] for name in _names_in(text)})

    def star(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in STAR}


def _names_in(text: str) -> list[str]:
    return [name for name in (*TABLES, *VIEWS) if "{" + name + "}" in text]


def with_views(names: list[str], query: str) -> str:
    """``query`` after the WITH clauses of the views it needs, for DuckDB."""
    needed: dict[str, str] = {}

    def add(name: str) -> None:
        if name in VIEWS and name not in needed:
            for inner in _names_in(VIEWS[name]):
                add(inner)
            needed[name] = VIEWS[name].format(**{n: n for n in _names_in(VIEWS[name])})

    for name in names:
        add(name)
    clauses = ",\n".join(f"{name} AS ({text})" for name, text in needed.items())
    return f"WITH {clauses}\n{query}" if clauses else query


